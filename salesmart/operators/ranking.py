"""Exact RANK / ROW_NUMBER without a single-task window.

``rank() over (partition by year order by net desc)`` is a window whose
partition holds a whole year: on a large table one task would sort billions
of rows. Here the same numbers come from a distributed plan:

* ``row_number``: a global ``orderBy(partition cols, order cols, tie-breakers)`` - range-partitioned, so even one hot
  key value is split across tasks. The rows are written with their place (task, position) to the shared checkpoint
  folder, compressed, which cuts the lineage. Row counts per task (and group) give each task's offset; a row's number is
  offset + position.
* ``rank`` = the number of rows of the group with a smaller place, plus one, and so the same for equal values. Only
  the distinct values and their counts are sorted and summed up as above; the rows themselves, which are wide, are
  written once, and meet the ranks on (group, value). A hot value is one row among the values, and AQE splits it in the join.

When the input is provably small (the caller says so), a plain window is used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.session import materialize

COMPRESSION = "zstd"
_POS_BITS = 33  # monotonically_increasing_id: partition id << 33 | position


def _ordered(cols: Sequence[tuple[str, bool]]) -> list[Column]:
    return [F.col(c).desc_nulls_last() if desc else F.col(c).asc_nulls_first() for c, desc in cols]


def rank_over(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[tuple[str, bool]],
              out: str = "rank", method: str = "rank",
              tie_breakers: Sequence[str] = (), small: bool = False) -> DataFrame:
    """Add ``out`` = RANK()/ROW_NUMBER() over (partition_by, order_by).

    ``order_by`` is a list of (column, descending). ``tie_breakers`` complete
    the order into a total one (required for ``row_number``). Rows are carried
    through the sort whole, so null keys and repeated rows keep their number.
    """
    if method not in ("rank", "row_number"):
        raise ValueError(method)
    full_order = list(order_by) + [(c, False) for c in tie_breakers]
    if small:
        w = Window.partitionBy(*partition_by).orderBy(*_ordered(full_order if method == "row_number" else order_by))
        fn = F.rank() if method == "rank" else F.row_number()
        return df.withColumn(out, fn.over(w))

    if method == "row_number":
        rows = _placed(df, partition_by, full_order)
        before = _before(rows, partition_by, F.count(F.lit(1)), F.min("_pos"))
        number = F.col("_off") + F.col("_pos") - F.col("_start") + 1
        return _with_places(rows, before, partition_by).withColumn(out, number.cast("int")).select(*df.columns, out)

    keys = list(partition_by) + [c for c, _ in order_by]
    df = materialize(df, "rank-rows", compression=COMPRESSION)   # read twice, computed once
    values = _placed(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), partition_by, order_by)
    before = _before(values, partition_by, F.sum("_n"), F.min("_pos"))
    in_task = (Window.partitionBy("_pid", *partition_by).orderBy("_pos")
               .rowsBetween(Window.unboundedPreceding, -1))
    ranks = (_with_places(values, before, partition_by)
             .select(*[F.col(k).alias(f"_k_{i}") for i, k in enumerate(keys)],
                     (F.col("_off") + F.coalesce(F.sum("_n").over(in_task), F.lit(0)) + 1).cast("int").alias(out)))
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & df[k].eqNullSafe(ranks[f"_k_{i}"])
    return df.join(ranks, cond).select(*[df[c] for c in df.columns], out)


def _placed(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[tuple[str, bool]]) -> DataFrame:
    """Rows in the global order, written with their task (``_pid``) and their position in it (``_pos``)."""
    mid = F.monotonically_increasing_id()
    rows = df.orderBy(*[F.col(c).asc_nulls_first() for c in partition_by], *_ordered(order_by)).select(
        "*", F.shiftright(mid, _POS_BITS).alias("_pid"), mid.bitwiseAND(F.lit((1 << _POS_BITS) - 1)).alias("_pos"))
    return materialize(rows, "sorted", compression=COMPRESSION)


def _before(rows: DataFrame, partition_by: Sequence[str], amount: Column, start: Column) -> DataFrame:
    """Per task and group: ``_off``, the amount of the group in the tasks before, and the group's first position."""
    per = rows.groupBy("_pid", *partition_by).agg(amount.alias("_t"), start.alias("_start"))
    earlier = Window.partitionBy(*partition_by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    off = per.withColumn("_off", F.sum("_t").over(earlier)).drop("_t")
    return off.withColumn("_off", F.coalesce("_off", F.lit(0)))


def _with_places(rows: DataFrame, before: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    if not partition_by:     # one row per task
        return rows.join(F.broadcast(before), "_pid")
    # written, so that Spark knows the size: a row per task and one per group
    alias = {c: f"_g_{i}" for i, c in enumerate(["_pid", *partition_by])}
    b = materialize(before.withColumnsRenamed(alias), "sorted-offsets")
    cond = F.lit(True)
    for c, a in alias.items():
        cond = cond & rows[c].eqNullSafe(b[a])
    return rows.join(b, cond).drop(*alias.values())


def running_total(df: DataFrame, value: str, order_by: Sequence[tuple[str, bool]], out: str = "running_total",
                  tie_breakers: Sequence[str] = ()) -> DataFrame:
    """Cumulative SUM(value) in a global order (ROWS UNBOUNDED PRECEDING .. CURRENT ROW).

    Same plan shape as ``row_number`` above: range-partitioned sort, written,
    per-partition totals -> offsets, then a running sum *inside* each
    physical partition (a task-sized window) plus its offset.
    """
    rows = _placed(df, [], list(order_by) + [(c, False) for c in tie_breakers])
    before = _before(rows, [], F.sum(value), F.min("_pos"))
    within = Window.partitionBy("_pid").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    res = _with_places(rows, before, []).withColumn(out, F.col("_off") + F.sum(value).over(within))
    return res.select(*df.columns, out)

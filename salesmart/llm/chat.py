"""Chat formatting by cumulative-snapshot collapse (method 4, DataFrame functions only).

A chat log often stores every state of a conversation: each longer one repeats a shorter one from the
start. Every turn gets a rolling prefix hash, the running sums (four of 34 bits) of a hash of
position, role and text. A conversation whose whole hash is a proper prefix of another one is
dropped by an anti-join; of conversations that are equal the smallest conv_id stays, with their
number. What stays is rendered as ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn.

Turns are ordered by turn (null first), then role, then text. Rows that repeat one (same conv_id,
turn, role and text) count once; they are dropped by a grouped distinct before any window. A null role or text counts as ''. Rows with a null conv_id form
one conversation of that id. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import prepare, save

_PARTS = ["p0", "p1", "p2", "p3"]


def _turns(conversations: DataFrame) -> DataFrame:
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                                F.coalesce("text", F.lit("")).alias("text"))
    # before any window: a conversation of mostly repeats is reduced in every task
    return rows.distinct()


def prefixes(conversations: DataFrame) -> DataFrame:
    """conv_id, k (turns so far), n (all turns), p0..p3: the rolling hash after each turn."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turns = _turns(conversations).withColumn("k", F.row_number().over(order))
    hashed = turns.select("conv_id", "turn", "role", "text", "k", *[
        F.shiftrightunsigned(F.xxhash64(F.lit(i), "k", "role", "text"), 30).alias(f"h{i}") for i in range(4)])
    rolled = hashed.select("conv_id", "k", *[F.sum(f"h{i}").over(so_far).alias(p) for i, p in enumerate(_PARTS)])
    return rolled.withColumn("n", F.max("k").over(Window.partitionBy("conv_id")))


def collapse(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies of the maximal conversations."""
    rows = save(prefixes(conversations), "chat-prefixes")
    whole = rows.where("k = n").groupBy("k", *_PARTS).agg(F.min("conv_id").alias("conv_id"),
                                                          F.count("*").alias("n_copies"))
    inner = rows.where("k < n").select("k", *_PARTS).distinct()
    return (whole.join(inner, ["k", *_PARTS], "left_anti")
            .select("conv_id", F.col("k").cast("long").alias("n_turns"), "n_copies"))


def render(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies, text: the maximal conversations in the chat format."""
    prepare(conversations.sparkSession)
    kept = save(collapse(conversations), "chat-kept")
    turns = _turns(conversations)
    part = F.concat(F.lit("<|im_start|>"), "role", F.lit("\n"), "text", F.lit("<|im_end|>\n"))
    own = turns.join(kept.select(F.col("conv_id").alias("own_id"), "n_turns", "n_copies"),
                     F.col("conv_id").eqNullSafe(F.col("own_id")))
    lines = own.groupBy("conv_id", "n_turns", "n_copies").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text", part.alias("part")))).alias("parts"))
    return lines.select("conv_id", "n_turns", "n_copies", F.array_join(F.col("parts.part"), "").alias("text"))


RENDER_SQL = r"""
WITH turns AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
numbered AS (
  SELECT conv_id, row_number() OVER w AS k,
         count(*) OVER (PARTITION BY conv_id) AS n,
         string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '') OVER w AS body,
         string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER w AS prefix
  FROM turns
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
whole AS (
  SELECT prefix, min(conv_id) AS conv_id, count(*) AS n_copies, min(n) AS n_turns, min(body) AS text
  FROM numbered WHERE k = n GROUP BY prefix)
SELECT conv_id, n_turns, n_copies, text FROM whole
WHERE prefix NOT IN (SELECT prefix FROM numbered WHERE k < n)
"""

"""Mixing sources to target weights by iterative proportional fitting (method 1, DataFrame functions only).

Token mass is raked to three marginals: source, language and topic. Topics come from the whole text
(:func:`topic`). Language and topic targets are parameters; categories that they do not name form
``other`` and keep their share. Source targets are the sources' token shares to the power
``TEMPERATURE``, so that a dominant source gives way to small ones.

A cell's calibrated mass is its token mass times a source, a language and a topic factor, without a
limit. ``RATE`` is the token budget, and rate times factor is how often a document of the cell is wanted
(``weight``). With ``hold_budget`` the rate stays as it is: a weight of up to 1 is a probability, a larger one
means copies, its whole part and one more by the fraction, at most ``MOST_COPIES``. So a stray document of a
rare kind with a large target is repeated a few times and falls short (:func:`marginals` tells by how much),
and all others keep their weights. Without it the rate is lowered to 1 over the largest factor of a
cell that has mass: no copies, exact shares, as small a sample as that takes. Documents are drawn by a
hash of seed and doc_id.

One row per source holds its mass in each (language, topic) cell, at most as many cells as the
targets name. The source's factor follows from the others inside the row. A cycle is one global
aggregate (pre-summed in every task) of the cells' sums, from which the language and topic factors
follow; the driver only sees these few sums. Cycles end when language and topic shares are within
``TOLERANCE`` of their targets (the source shares then hold by construction). Targets that no factors
can meet (a topic that only stands in one source, say) end once ``STALL`` cycles gain less than a
twentieth, or after ``CYCLES`` cycles, with a warning that names the rest.
:func:`marginals` gives target, fitted and expected share of each category.

Null and empty texts have no tokens: they have no mass, but get their cell's probability like any
document. Null source or language counts as the value ''. Rows of one doc_id (null: '') are drawn
alike. An empty table gives an empty result. Extra columns are ignored by :func:`calibrate`, and
kept by :func:`sample`.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import prepare, save, unused

LANG_TARGETS = {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15}
TOPIC_TARGETS = {"prose": 0.70, "brief": 0.10, "table": 0.10, "licensed": 0.10}
TEMPERATURE = 0.5
RATE = 0.5
#: Copies of a document at most, where the budget is held.
MOST_COPIES = 4
TOLERANCE = 1e-6
CYCLES = 200
STALL = 10
SEED = "mix-1"
OTHER = "other"


@dataclass(frozen=True)
class Targets:
    """Shares that languages and topics are to have, power of the sources' shares, token budget, most copies."""
    lang: dict[str, float] = field(default_factory=lambda: dict(LANG_TARGETS))
    topic: dict[str, float] = field(default_factory=lambda: dict(TOPIC_TARGETS))
    temperature: float = TEMPERATURE
    rate: float = RATE
    most_copies: int = MOST_COPIES


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def topic(text: Column, tokens: Column) -> Column:
    """Kind of text: table (cells between bars), licensed (names a licence), brief (under 100 tokens), prose."""
    whole = F.coalesce(text, F.lit(""))
    return (F.when(F.contains(whole, F.lit(" | ")), "table")
            .when(F.contains(F.lower(whole), F.lit("licen")), "licensed")
            .when(tokens < 100, "brief").otherwise("prose"))


def _named(col: Column, targets: dict[str, float]) -> Column:
    return F.when(col.isin(*targets), col).otherwise(OTHER)


def _described(docs: DataFrame) -> DataFrame:
    tokens = n_tokens(F.col("text"))
    out = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("source"),
                      F.coalesce("lang", F.lit("")).alias("lang"), F.col("text"), tokens.alias("n_tokens"))
    return out.select("doc_id", "source", "lang", topic(F.col("text"), F.col("n_tokens")).alias("topic"), "n_tokens")


def _full_targets(targets: dict[str, float], mass: dict[str, float]) -> dict[str, float]:
    """Shares of the categories that have mass, ``other`` at its own share, summing to 1."""
    total = sum(mass.values())
    rest = mass.get(OTHER, 0.0) / total
    live = {k: v for k, v in targets.items() if mass.get(k, 0.0) > 0}
    scale = sum(live.values())
    out = {k: (1 - rest) * v / scale for k, v in live.items()}
    return out | ({OTHER: rest} if rest > 0 else {})


class Fit(NamedTuple):
    """Fitted factors: by_source has source, fit (a factor for each (language, topic) cell), has_mass (for each cell),
    own (mass) and target (share times total mass)."""
    by_source: DataFrame
    rate: float
    cycles: int
    residual: float
    shares: list[tuple[str, str, float, float]]


def factors(described: DataFrame, targets: Targets = Targets(), hold_budget: bool = False) -> Fit | None:
    """The fit; shares are (axis, category, target, fitted) of language and topic. None if there is no mass."""
    cells = [(a, b) for a in [*targets.lang, OTHER] for b in [*targets.topic, OTHER]]
    lang, kind = _named(F.col("lang"), targets.lang), _named(F.col("topic"), targets.topic)
    mass = described.groupBy("source").agg(*[
        F.sum(F.when((lang == a) & (kind == b), F.col("n_tokens")).otherwise(0)).cast("double").alias(f"m{i}")
        for i, (a, b) in enumerate(cells)])
    rows = save(mass.withColumn("m", F.array(*[f"m{i}" for i in range(len(cells))]))
                .withColumn("own", F.aggregate("m", F.lit(0.0), lambda s, x: s + x))
                .select("source", "m", "own"), "mix-sources")
    sums = rows.agg(F.sum("own").alias("t"), F.sum(F.pow("own", F.lit(targets.temperature))).alias("z"),
                    *[F.sum(F.col("m")[i]).alias(f"m{i}") for i in range(len(cells))]).first()
    total = sums["t"] or 0.0
    if total <= 0:
        return None

    def marginal(axis: int, values: list[float]) -> dict[str, float]:
        out: dict[str, float] = {}
        for cell, v in zip(cells, values, strict=True):
            out[cell[axis]] = out.get(cell[axis], 0.0) + v
        return out

    base = [sums[f"m{i}"] for i in range(len(cells))]
    want = [_full_targets(t, marginal(axis, base)) for axis, t in enumerate((targets.lang, targets.topic))]
    fit: list[dict[str, float]] = [dict.fromkeys(w, 1.0) for w in want]
    target = F.pow("own", F.lit(targets.temperature)) / F.lit(float(sums["z"])) * F.lit(float(total))
    dot = F.lit(0.0)

    def with_source_factor() -> DataFrame:
        """s: the source's factor that meets its target, given the few other factors (literals)."""
        both = F.array(*[F.lit(fit[0].get(a, 0.0) * fit[1].get(b, 0.0)) for a, b in cells])
        now = F.aggregate(F.zip_with("m", both, lambda m, f: m * f), dot, lambda x, y: x + y)
        return (rows.withColumn("target", target).withColumn("both", both).withColumn("now", now)
                .withColumn("s", F.when(F.col("now") > 0, F.col("target") / F.col("now")).otherwise(0.0)))

    cycles, history = 0, []
    while True:
        state = with_source_factor()
        w = state.select(F.expr("posexplode(zip_with(m, both, (x, f) -> x * f * s))").alias("cell", "w"))
        got = {r["cell"]: r["w"] for r in w.groupBy("cell").agg(F.sum("w").alias("w")).collect()}
        sums_now = [got[i] for i in range(len(cells))]
        mass_now = sum(sums_now)
        shares = [(axis, k, want[i][k], v / mass_now) for i, axis in enumerate(("lang", "topic"))
                  for k, v in marginal(i, sums_now).items() if k in want[i]]
        residual = max(abs(x[2] - x[3]) for x in shares)
        history.append(residual)
        if residual <= TOLERANCE or cycles == CYCLES or (cycles >= STALL and residual > 0.95 * history[-1 - STALL]):
            break
        cycles += 1
        for axis in (0, 1):
            now = marginal(axis, sums_now)
            step = {k: want[axis][k] * mass_now / now[k] if now[k] > 0 else 1.0 for k in fit[axis]}
            fit[axis] = {k: f * step[k] for k, f in fit[axis].items()}
            sums_now = [v * step.get(cell[axis], 0.0) for cell, v in zip(cells, sums_now, strict=True)]
    if residual > TOLERANCE:
        warnings.warn(f"mixing: after {cycles} cycles a share is still {residual:.6f} from its target", stacklevel=2)
    by_source = save(state.select("source", "own", "target", F.transform("m", lambda m: m > 0).alias("has_mass"),
                                  F.transform("both", lambda x: x * F.col("s")).alias("fit")), "mix-factors")
    rate = targets.rate
    if not hold_budget:
        wanted = F.zip_with("fit", "has_mass", lambda f, has: F.when(has, f))
        rate = min(rate, 1.0 / by_source.agg(F.max(F.array_max(wanted))).first()[0])
    return Fit(by_source, rate, cycles, residual, shares)


def _weight(fit: Column, cell: Column, rate: float, most: float) -> Column:
    """How often a document of the cell is wanted; only cells without mass can have a factor above most / rate."""
    return F.round(F.least(F.lit(float(most)), F.lit(rate) * F.coalesce(F.element_at(fit, cell), F.lit(0.0))), 9)


def marginals(docs: DataFrame, targets: Targets = Targets(), hold_budget: bool = False) -> DataFrame:
    """axis, category, target, fitted, expected: shares of token mass wanted, fitted, and expected of the sample."""
    spark = docs.sparkSession
    prepare(spark)
    rows = save(_described(docs), "mix-rows")
    fitted = factors(rows, targets, hold_budget)
    schema = "axis string, category string, target double, fitted double"
    if fitted is None:
        return spark.createDataFrame([], schema + ", expected double")
    own = fitted.by_source.where("own > 0")
    total = own.agg(F.sum("own")).first()[0]
    share = F.col("target") / F.lit(float(total))
    wanted = own.select(F.lit("source").alias("axis"), F.col("source").alias("category"), share.alias("target"),
                        share.alias("fitted")).unionByName(spark.createDataFrame(fitted.shares, schema))
    drawn = _drawn(rows, fitted, targets, hold_budget).withColumn("mass", F.col("weight") * F.col("n_tokens"))
    axes = F.array(*[F.struct(F.lit(axis).alias("axis"), c.alias("category")) for axis, c in (
        ("source", F.col("source")), ("lang", _named(F.col("lang"), targets.lang)),
        ("topic", _named(F.col("topic"), targets.topic)))])
    mass = drawn.select(F.explode(axes).alias("a"), "mass").groupBy("a").agg(F.sum("mass").alias("mass"))
    all_mass = drawn.agg(F.sum("mass")).first()[0] or 1.0
    expected = mass.select("a.axis", "a.category", (F.col("mass") / F.lit(float(all_mass))).alias("expected"))
    return wanted.join(expected, ["axis", "category"], "left")


def _cell_index(lang: Column, kind: Column, targets: Targets) -> Column:
    """Position of a row's (language, topic) cell in the array of factors, from 1."""
    def place(col: Column, names: dict[str, float]) -> Column:
        return F.coalesce(*[F.when(col == n, F.lit(i)) for i, n in enumerate(names)], F.lit(len(names)))

    return (place(lang, targets.lang) * (len(targets.topic) + 1) + place(kind, targets.topic) + 1).cast("int")


def _uniform() -> Column:
    digest = F.md5(F.concat_ws(":", F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(16**12))


def _copies(weight: Column) -> Column:
    """The weight's whole part, and one more with the probability of its fraction."""
    whole = F.floor(weight)
    return (whole + F.when(_uniform() < weight - whole, 1).otherwise(0)).cast("int")


def _drawn(rows: DataFrame, fitted: Fit | None, targets: Targets, hold_budget: bool) -> DataFrame:
    """``rows`` (doc_id, source, lang, topic, ...) with ``weight`` and ``copies``."""
    if fitted is None:
        out = rows.withColumn("weight", F.lit(float(targets.rate)))
    else:
        cell = _cell_index(F.col("lang"), F.col("topic"), targets)
        weight = _weight(F.col("fit"), cell, fitted.rate, targets.most_copies if hold_budget else 1)
        out = rows.join(fitted.by_source.select("source", "fit"), "source", "left").withColumn("weight", weight).drop("fit")
    return out.withColumn("copies", _copies(F.col("weight")))


def calibrate(docs: DataFrame, targets: Targets = Targets(), hold_budget: bool = False) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, prob (of at least one copy), weight (copies expected), copies, sampled."""
    prepare(docs.sparkSession)
    rows = save(_described(docs), "mix-rows")
    out = _drawn(rows, factors(rows, targets, hold_budget), targets, hold_budget)
    return out.select("doc_id", "source", "lang", "topic", "n_tokens", F.least(F.lit(1.0), "weight").alias("prob"),
                      "weight", "copies", (F.col("copies") > 0).alias("sampled"))


def sample(docs: DataFrame, targets: Targets = Targets(), hold_budget: bool = False) -> DataFrame:
    """The sampled documents of ``docs``, all columns; as many rows as copies."""
    prepare(docs.sparkSession)
    fitted = factors(save(_described(docs), "mix-rows"), targets, hold_budget)
    if fitted is None:
        return docs.where(_uniform() < targets.rate)
    # names that no column of the documents has
    key, kind, fit, again = (unused(docs, n) for n in ("mix_source", "mix_topic", "mix_fit", "mix_copy"))
    rate, most = fitted.rate, targets.most_copies if hold_budget else 1
    fitted = fitted.by_source.select(F.col("source").alias(key), F.col("fit").alias(fit))
    with_topic = docs.withColumn(kind, topic(F.col("text"), n_tokens(F.col("text"))))
    cell = _cell_index(F.coalesce("lang", F.lit("")), F.col(kind), targets)
    joined = with_topic.join(fitted, F.coalesce(with_topic["source"], F.lit("")) == fitted[key], "left")
    copies = _copies(_weight(F.col(fit), cell, rate, most))
    return joined.withColumn(again, F.explode(F.array_repeat(F.lit(1), copies))).select(*docs.columns)

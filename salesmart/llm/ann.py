"""Approximate nearest neighbours: 2-stable projections in a kd-tree with a chi-square stop (method 10).

Vectors are projected on ``DIMS`` Gaussian directions. For a pair at distance d the squared
projected distance is d^2 times a chi-square variable of ``DIMS`` degrees of freedom. A query takes
points by growing projected distance and verifies them on the original vectors; once a projected
lower bound exceeds ``quantile * d_k^2`` (d_k: distance of the k-th best so far), every unseen
nearer point would need a chi-square value beyond its ``1 - MISS`` quantile, and the search stops.

The upper levels of the kd-tree are fitted on a bounded sample (``SAMPLE`` rows, smallest hash of
vec_id); every row is indexed: routed to its cell, whose true bounding box is then aggregated from
all rows. Cells that hold many rows (repeated vectors) are split by a hash, and so are the queries
of a cell, so that a task compares at most about ``CELL`` rows with ``BLOCK`` queries. Round one
searches a query's own cell, round two the other cells that the stopping test leaves open.

Vectors that are null, zero, of another length than most, or that hold null or non-finite
components take no part, nor do rows with a null vec_id. Rows that repeat a vec_id act as one vector
at its smallest distance. Ties in distance go to the smaller vec_id. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import prepare, save

DIMS = 8
MISS = 0.005
SAMPLE = 20_000
CELL, BLOCK, LEAF = 4096, 1024, 64
FOUND = "query_id long, vec_id long, score double"


def chi_square_quantile(p: float, dims: int = DIMS) -> float:
    """p-quantile of the chi-square distribution with an even number of degrees of freedom."""
    def below(x: float) -> float:
        term, total = 1.0, 1.0
        for j in range(1, dims // 2):
            term *= x / 2 / j
            total += term
        return 1 - math.exp(-x / 2) * total
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if below(mid) < p else (low, mid)
    return high


def directions(length: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(11)).standard_normal((length, DIMS))


def _split(points: np.ndarray, leaf: int) -> list[np.ndarray]:
    """kd-tree leaves (index arrays): median splits on the widest dimension; equal points stay together."""
    todo, leaves = [np.arange(len(points))], []
    while todo:
        own = todo.pop()
        if own.size > leaf:
            values = points[own]
            axis = int(np.argmax(values.max(0) - values.min(0)))
            order = np.argsort(values[:, axis], kind="stable")
            half = own.size // 2
            todo += [own[order[:half]], own[order[half:]]]
        elif own.size:
            leaves.append(own)
    return leaves


def fit_tree(points: np.ndarray, leaves: int) -> list[tuple[int, float, int, int]]:
    """Routing tree: nodes (axis, threshold, left, right); a child below 0 is cell ``-child - 1``."""
    nodes: list[list] = []
    cells = 0

    def grow(own: np.ndarray, want: int) -> int:
        nonlocal cells
        spread = points[own].max(0) - points[own].min(0) if own.size else np.zeros(DIMS)
        if want <= 1 or own.size < 2 or spread.max() <= 0:
            cells += 1
            return -cells
        axis = int(np.argmax(spread))
        cut = float(np.median(points[own, axis]))
        left = points[own, axis] < cut
        if not left.any() or left.all():
            cut = float(points[own, axis].mean())
            left = points[own, axis] < cut
        if not left.any() or left.all():
            cells += 1
            return -cells
        at = len(nodes)
        nodes.append([axis, cut, 0, 0])
        nodes[at][2] = grow(own[left], want // 2)
        nodes[at][3] = grow(own[~left], want - want // 2)
        return at

    root = grow(np.arange(len(points)), leaves)
    return [tuple(n) for n in nodes] if root >= 0 else []


def route(points: np.ndarray, nodes: list[tuple[int, float, int, int]]) -> np.ndarray:
    """Cell number of each point."""
    if not nodes:
        return np.zeros(len(points), dtype=np.int64)
    axis, cut, left, right = (np.array(x) for x in zip(*nodes, strict=True))
    at = np.zeros(len(points), dtype=np.int64)
    live = np.arange(len(points))
    while live.size:
        n = at[live]
        at[live] = np.where(points[live, axis[n]] < cut[n], left[n], right[n])
        live = live[at[live] >= 0]
    return -at - 1


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in column])


def _search(k: int, stop: float):
    """cogroup function: rows of a cell and the queries that visit it -> each query's best k."""

    def run(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or queries.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        ids, x = rows["vec_id"].to_numpy(), _matrix(rows["embedding"])
        a = directions(x.shape[1])
        low = x @ a
        leaves = _split(low, LEAF)
        lo, hi = (np.stack([f(low[own], axis=0) for own in leaves]) for f in (np.min, np.max))
        out = []
        for qid, q, bound in zip(queries["query_id"], _matrix(queries["embedding"]), queries["bound"], strict=True):
            p = q @ a
            near = (np.maximum(np.maximum(lo - p, p - hi), 0) ** 2).sum(1)
            best_d, best_i = np.empty(0), np.empty(0, dtype=np.int64)
            for leaf in np.argsort(near, kind="stable"):
                if near[leaf] > stop * bound * bound:
                    break
                own = leaves[leaf]
                d = np.sqrt(((x[own] - q) ** 2).sum(1))
                other = ids[own] != qid
                best_d, best_i = np.concatenate([best_d, d[other]]), np.concatenate([best_i, ids[own][other]])
                order = np.lexsort((best_i, best_d))[:k]
                best_d, best_i = best_d[order], best_i[order]
                if best_d.size == k:
                    bound = min(bound, best_d[-1])
            out.append(pd.DataFrame({"query_id": qid, "vec_id": best_i, "score": best_d}))
        return pd.concat(out)

    return run


def _valid(vectors: DataFrame) -> DataFrame:
    fine = (F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)
            & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
            & F.exists("embedding", lambda x: x != 0))
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(fine)
    usual = (rows.groupBy(F.size("embedding").alias("n")).agg(F.count("*").alias("c"))
             .orderBy(F.desc("c"), F.desc("n")).first())
    return rows.where(F.size("embedding") == (usual["n"] if usual else -1))


def nearest(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose vec_id is divisible by ``every``, its k nearest."""
    spark = vectors.sparkSession
    prepare(spark)
    rows = _valid(vectors)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("embedding").toPandas()["embedding"]
    total = rows.count()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    points = _matrix(sample)
    a = directions(points.shape[1])
    nodes = fit_tree(points @ a, max(1, min(len(points) // 16, math.ceil(total / CELL))))

    def place(batches):
        for pdf in batches:
            if len(pdf):
                low = _matrix(pdf["embedding"]) @ a
                yield pdf.assign(cell=route(low, nodes), low=list(low))

    placed = save(rows.mapInPandas(place, "vec_id long, embedding array<double>, cell long, low array<double>"),
                  "ann-cells")
    # one row for each cell of the sample's tree: bounded by SAMPLE / 16
    boxes = (placed.groupBy("cell").agg(
        F.count("*").alias("n"), *[f(F.col("low")[i]).alias(f"{w}{i}") for i in range(DIMS)
                                   for w, f in (("lo", F.min), ("hi", F.max))]).toPandas().sort_values("cell"))
    cells = boxes["cell"].to_numpy()
    lo, hi = (boxes[[f"{w}{i}" for i in range(DIMS)]].to_numpy() for w in ("lo", "hi"))
    salts = spark.createDataFrame(pd.DataFrame({"cell": cells, "salts": np.ceil(boxes["n"] / CELL).astype("int64")}))
    stop = chi_square_quantile(1 - MISS)
    queries = placed.where(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "query_id")

    def search(visits: DataFrame, name: str) -> DataFrame:
        """visits: query_id, embedding, bound, cell."""
        plan = (visits.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("blocks"))
                .join(F.broadcast(salts), "cell"))  # at most SAMPLE / 16 rows
        plan = F.broadcast(plan)
        some = (placed.select("cell", "vec_id", "embedding").join(plan, "cell")
                .withColumn("salt", F.pmod(F.xxhash64("vec_id"), "salts"))
                .withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)"))))
        asked = (visits.join(plan, "cell").withColumn("block", F.pmod(F.xxhash64("query_id", F.lit(1)), "blocks"))
                 .withColumn("salt", F.explode(F.expr("sequence(0L, salts - 1)"))))
        keys = ["cell", "salt", "block"]
        found = (some.select(*keys, "vec_id", "embedding").groupBy(*keys)
                 .cogroup(asked.select(*[F.col(c).alias(c) for c in (*keys, "query_id", "embedding", "bound")])
                          .groupBy(*keys))
                 .applyInPandas(_search(k, stop), FOUND))
        return save(found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score")), name)

    def best(found: DataFrame) -> DataFrame:
        order = F.expr("row_number() over (partition by query_id order by score, vec_id)")
        return found.withColumn("rank", order).where(F.col("rank") <= k)

    home = search(queries.select("query_id", "embedding", F.lit(float("inf")).alias("bound"), "cell"), "ann-home")
    reach = best(home).groupBy("query_id").agg(F.max("score").alias("d"), F.count("*").alias("n"))
    reach = reach.select("query_id", F.when(F.col("n") == k, F.col("d")).otherwise(float("inf")).alias("bound"))

    def open_cells(batches):
        for pdf in batches:
            if len(pdf):
                p = _matrix(pdf["low"])[:, None, :]
                near = (np.maximum(np.maximum(lo[None] - p, p - hi[None]), 0) ** 2).sum(2)
                keep = near <= stop * pdf["bound"].to_numpy()[:, None] ** 2
                keep &= cells[None, :] != pdf["cell"].to_numpy()[:, None]
                yield pdf[["query_id", "embedding", "bound"]].assign(cells=[cells[m] for m in keep])

    visits = (queries.join(reach, "query_id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
              .mapInPandas(open_cells, "query_id long, embedding array<double>, bound double, cells array<long>")
              .select("query_id", "embedding", "bound", F.explode("cells").alias("cell")))
    away = search(save(visits, "ann-visits"), "ann-away")
    both = home.unionByName(away).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return best(both).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

"""Merkle manifest of the documents, with a persistent tree of versions (method 11).

A row's leaf is the hash of its fields. Per lang, leaves ascend by doc_id, and every ``FAN`` consecutive nodes
become their hash until one node, the subroot, remains; subroots ordered by lang give the root the same way.
The tree is built in aligned blocks of ``FAN ** LEVELS`` nodes, each in one task, and their roots are the nodes
of the next distributed round. A claimed leaf creates a version of the tree: inside its block only the
ancestors of the leaf are copied, every other node is shared, and above the block the version continues along
the block's path through the upper rounds, which is found once for all versions in it. Nothing is collected:
a task sees a block, and a lang of any size is numbered by a range-partitioned sort.

Null fields hash as ``-``. Rows with a null doc_id come first in their lang, rows of one doc_id are ordered by
their leaf, and a null lang is a lang of its own, ordered first; repeated rows are leaves of their own. A null
text stays null when it is claimed. An empty table has no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import discard, prepare, save

FAN, LEVELS = 8, 3
BLOCK = FAN**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(parts: str) -> str:
    return hashlib.sha256(parts.encode()).hexdigest()


def leaf(text: Column | None = None) -> Column:
    """Hash of a row's fields, with ``text`` in place of its own text if given."""
    def part(name: str) -> Column:
        value = (text if name == "text" and text is not None else F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[part(f) for f in FIELDS]), 256)


def tampered() -> Column:
    """The text, its A-Z lower-cased in a third of the rows by doc_id."""
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return F.when(third, F.translate("text", string.ascii_uppercase, string.ascii_lowercase)).otherwise(F.col("text"))


class Block:
    """The nodes above at most BLOCK consecutive nodes, of which the whole run has ``n``."""

    def __init__(self, nodes: list[str], n: int):
        self.levels = [nodes]
        while n > 1 and len(self.levels) <= LEVELS:
            below = self.levels[-1]
            self.levels.append([digest("".join(below[i: i + FAN])) for i in range(0, len(below), FAN)])
            n = -(-n // FAN)

    def siblings(self, i: int) -> Iterator[tuple[str, str]]:
        """Left and right siblings of node i and of its ancestors, below the block's root."""
        for level in self.levels[:-1]:
            start, at = i // FAN * FAN, i % FAN
            run = level[start: start + FAN]
            yield "".join(run[:at]), "".join(run[at + 1:])
            i //= FAN

    def version(self, i: int, node: str) -> list[str]:
        """The copied path of a version in which node i is ``node``: it, then its new ancestors, the root last."""
        path = [node]
        for left, right in self.siblings(i):
            path.append(digest(left + path[-1] + right))
        return path


def _numbered(rows: DataFrame, *order: str) -> DataFrame:
    """``pos`` from 0 and ``n``, the count, in each ``key``: a range-partitioned sort, then offsets by partition."""
    placed = save(rows.repartitionByRange("key", *order).sortWithinPartitions("key", *order)
                  .withColumn("mid", F.monotonically_increasing_id()).withColumn("part", F.shiftright("mid", 33)),
                  "merkle-sorted")
    parts = placed.groupBy("key", "part").agg(F.min("mid").alias("first"), F.count("*").alias("k"))
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("key", "part", (F.col("first") - F.coalesce(F.sum("k").over(before), F.lit(0))).alias("shift"),
                          F.sum("k").over(Window.partitionBy("key")).alias("n"))
    return (placed.join(starts, ["key", "part"]).withColumn("pos", F.col("mid") - F.col("shift"))
            .drop("mid", "part", "shift"))


def _roots(key: tuple, group: pa.Table) -> pa.Table:
    """One block -> the node above it."""
    group = group.sort_by("pos")
    n = group.column("n")[0].as_py()
    top = Block(group.column("digest").to_pylist(), n).levels[-1][0]
    return pa.table({"key": [key[0].as_py()], "pos": [key[1].as_py()], "n": [-(-n // BLOCK)], "digest": [top]},
                    schema=_NODE)


_NODE = pa.schema([("key", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("digest", pa.string())])
_PATH = "key string, pos long, path array<struct<left:string,right:string>>"


def _rounds(nodes: DataFrame) -> list[DataFrame]:
    """The nodes, the roots of their blocks, the roots of those, and so on until every key has one node."""
    out = [nodes]
    while (out[-1].agg(F.max("n")).first()[0] or 0) > 1:
        out.append(save(out[-1].select("key", "pos", "n", "digest")
                        .groupBy("key", F.expr(f"pos div {BLOCK}").alias("block")).applyInArrow(_roots, "key string, pos long, n long, digest string"), "merkle-round"))
    return out


def _block(nodes: pa.Table) -> tuple[pa.Table, Block]:
    nodes = nodes.sort_by("pos")
    return nodes, Block(nodes.column("digest").to_pylist(), nodes.column("n")[0].as_py())


def _paths(nodes: pa.Table, above: pa.Table) -> pa.Table:
    """Siblings of each node of a block, then of the block's root."""
    nodes, block = _block(nodes)
    rest = above.column("path")[0].as_py()
    paths = [[{"left": x, "right": y} for x, y in block.siblings(i)] + rest for i in range(nodes.num_rows)]
    return pa.table({"key": nodes.column("key"), "pos": nodes.column("pos"),
                     "path": pa.array(paths, pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())])))})


def _together(nodes: DataFrame, above: DataFrame, f: Callable, schema: str) -> DataFrame:
    """``f`` over each block with the row of ``above`` that belongs to the block's root."""
    return (nodes.withColumn("block", F.expr(f"pos div {BLOCK}")).groupBy("key", "block")
            .cogroup(above.withColumn("block", F.col("pos")).groupBy("key", "block")).applyInArrow(f, schema))


def _descend(rounds: list[DataFrame], top: DataFrame) -> DataFrame:
    """key, pos, path of the roots of the first round's blocks, from the paths of the last round's nodes."""
    paths = top
    for nodes in reversed(rounds[1:-1]):
        paths = save(_together(nodes.select("key", "pos", "n", "digest"), paths, _paths, _PATH), "merkle-paths")
    return paths


def manifest(docs: DataFrame, claimed: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Two tables: the leaves (doc_id, key, pos, n, digest, claim) and, for each of their blocks, its way up
    (key, pos, path, subroot, root). ``claimed`` is the text whose leaf is the claim, the row's own by default."""
    prepare(docs.sparkSession)
    key = F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-")).alias("key")  # '-' sorts before '='
    rows = save(docs.select("doc_id", key, leaf().alias("digest"), leaf(claimed).alias("claim")), "merkle-leaves")
    leaves = save(_numbered(rows, "doc_id", "digest", "claim"), "merkle-numbered")
    discard(rows)
    below = _rounds(leaves)
    subroots = below[-1].select(F.col("key").alias("lang_key"), F.lit("").alias("key"), F.col("digest"))
    top = save(_numbered(subroots, "lang_key"), "merkle-subroots")
    above = _rounds(top)
    # from the root down: a lang's path is its subroot's; with one block in a lang that is the block's path
    whole = above[-1].select("key", "pos", F.expr("cast(array() as array<struct<left:string,right:string>>)").alias("path"))
    if len(above) > 1:
        whole = save(_together(top.select("key", "pos", "n", "digest"), _descend(above, whole), _paths, _PATH), "merkle-top")
    langs = (top.join(whole, ["key", "pos"]).join(above[-1].select("key", F.col("digest").alias("root")), "key")
             .select(F.col("lang_key").alias("key"), F.lit(0).cast("long").alias("pos"), "path",
                     F.col("digest").alias("subroot"), "root"))
    ways = _descend(below, langs.select("key", "pos", "path"))
    if len(below) == 1:  # single leaves: each is its subroot
        ways = langs.select("key", "pos", "path")
    return leaves, save(ways.join(langs.select("key", "subroot", "root"), "key"), "merkle-ways")


def audit(docs: DataFrame, claimed: Column) -> DataFrame:
    """Each row's proof, and the version of the tree that its claimed text makes.

    doc_id, leaf, subroot, root, proof_sha256 (of the siblings up to the root), copied (the version's new nodes:
    claimed leaf, its ancestors in the block), folded_root (the version's root), verified (it is the root).
    """
    leaves, ways = manifest(docs, claimed)

    def versions(nodes: pa.Table, above: pa.Table) -> pa.Table:
        nodes, block = _block(nodes)
        way, subroot, root = (above.column(c)[0].as_py() for c in ("path", "subroot", "root"))
        rest = "".join(x["left"] + x["right"] for x in way)
        proof, copied, folded = [], [], []
        for i, claim in enumerate(nodes.column("claim").to_pylist()):
            path = block.version(i, claim)
            node = path[-1]
            for x in way:
                node = digest(x["left"] + node + x["right"])
            proof.append(digest("".join(x + y for x, y in block.siblings(i)) + rest))
            copied.append(path)
            folded.append(node)
        n = nodes.num_rows
        return pa.table({"doc_id": nodes.column("doc_id"), "leaf": nodes.column("digest"), "subroot": [subroot] * n,
                         "root": [root] * n, "proof_sha256": proof, "copied": pa.array(copied, pa.list_(pa.string())),
                         "folded_root": folded, "verified": [x == root for x in folded]})

    return _together(leaves, ways, versions, "doc_id long, leaf string, subroot string, root string, "
                     "proof_sha256 string, copied array<string>, folded_root string, verified boolean")


#: DuckDB SQL of the query's rows.
AUDIT_SQL = r"""
WITH RECURSIVE f AS (
  SELECT *, CASE WHEN text IS NULL THEN '-' ELSE octet_length(encode(text)) || ':' || text END AS t,
         CASE WHEN text IS NULL THEN '-' ELSE octet_length(encode(text)) || ':'
              || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END AS low,
         coalesce(length(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
         || coalesce(octet_length(encode(source)) || ':' || source, '-')
         || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
         || coalesce(length(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head
  FROM documents),
-- the checksum of doc_id's digits, a bit at a time
crc(doc_id, s, i, c) AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR), 0, CAST(4294967295 AS BIGINT) FROM (SELECT DISTINCT doc_id FROM documents)
  UNION ALL
  SELECT doc_id, s, i + 1, CASE WHEN b & 1 = 1 THEN xor(b >> 1, 3988292384) ELSE b >> 1 END
  FROM (SELECT *, CASE WHEN i % 8 = 0 THEN xor(c, CAST(ascii(substr(s, i // 8 + 1, 1)) AS BIGINT)) ELSE c END AS b
        FROM crc WHERE i < 8 * length(s))),
third AS (SELECT doc_id FROM crc WHERE i = 8 * length(s) AND xor(c, 4294967295) % 3 = 0),
leaves AS (
  SELECT row_number() OVER () AS r, doc_id, lang, sha256(head || t) AS leaf,
         CASE WHEN doc_id IN (SELECT doc_id FROM third) THEN sha256(head || low) ELSE sha256(head || t) END AS claim
  FROM f),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         COUNT(*) OVER (PARTITION BY lang) AS n FROM leaves),
nodes(lang, level, pos, n, h) AS (
  SELECT lang, 0, pos, n, leaf FROM placed
  UNION ALL
  SELECT lang, level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY lang, level, pos // 8, n),
langs AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS pos, COUNT(*) OVER () AS n
  FROM nodes WHERE n = 1),
tops(level, pos, n, h) AS (
  SELECT 0, pos, n, subroot FROM langs
  UNION ALL
  SELECT level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos))
  FROM tops WHERE n > 1 GROUP BY level, pos // 8, n),
runs AS (SELECT lang, level, pos // 8 AS run, list(h ORDER BY pos) AS hs FROM nodes WHERE n > 1 GROUP BY ALL),
top_runs AS (SELECT level, pos // 8 AS run, list(h ORDER BY pos) AS hs FROM tops WHERE n > 1 GROUP BY ALL),
steps AS (
  SELECT r, level, hs, pos // CAST(8 ** level AS BIGINT) % 8 AS spot
  FROM placed p JOIN runs u ON u.lang IS NOT DISTINCT FROM p.lang AND u.run = p.pos // CAST(8 ** (level + 1) AS BIGINT)
  UNION ALL
  SELECT r, 1000 + level, hs, l.pos // CAST(8 ** level AS BIGINT) % 8
  FROM placed p JOIN langs l ON l.lang IS NOT DISTINCT FROM p.lang
  JOIN top_runs u ON u.run = l.pos // CAST(8 ** (level + 1) AS BIGINT)),
ways AS (
  SELECT r, row_number() OVER (PARTITION BY r ORDER BY level) AS k, array_to_string(hs[:spot], '') AS lhs,
         array_to_string(hs[spot + 2:], '') AS rhs FROM steps),
fold(r, k, h) AS (
  SELECT r, CAST(0 AS BIGINT), claim FROM leaves
  UNION ALL
  SELECT f.r, w.k, sha256(lhs || f.h || rhs) FROM fold f JOIN ways w ON w.r = f.r AND w.k = f.k + 1),
proofs AS (SELECT r, string_agg(lhs || rhs, '' ORDER BY k) AS p, MAX(k) AS k FROM ways GROUP BY r),
final AS (
  SELECT l.doc_id, l.leaf, g.subroot, (SELECT h FROM tops WHERE n = 1) AS root,
         sha256(coalesce(p.p, '')) AS proof_sha256, f.h AS folded_root
  FROM leaves l JOIN langs g ON g.lang IS NOT DISTINCT FROM l.lang LEFT JOIN proofs p USING (r)
  JOIN fold f ON f.r = l.r AND f.k = coalesce(p.k, 0))
SELECT *, folded_root = root AS verified FROM final"""

"""Language identification with segmentation-marginalised unigrams (method 9).

Each language has a probability for every piece of a fixed public vocabulary. A text is a sequence
of words (lower case, runs without white space, each with a leading space mark); a word's
probability is the sum over all its segmentations into pieces, by the forward algorithm; a text's
log-likelihood is the sum over its words. The language with the largest likelihood (equal priors)
is predicted, ``score`` is its posterior.

Probabilities are learned by expectation-maximisation (forward-backward piece counts, ``ROUNDS``
rounds) on a bounded, documented sample of the learning rows: per language the ``SAMPLE`` rows with
the smallest hash of doc_id. Whole texts are read when learning and when predicting. A run without
spaces is scored in blocks of ``BLOCK`` bytes (the marginalisation restarts there), which keeps the
sums in range for any length; bytes outside the vocabulary have a fixed small probability.

Texts that are null or hold no letter get ``und`` and score 0. Without any learning row every text
gets ``und``. Ties go to the language that sorts first. Rows with a null doc_id count as doc_id ''
for the fold. Repeated rows are predicted like any other. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import prepare, save
from salesmart.llm.textkernel import INVERSE, NOT_SPACE, hash_words, mix, powers, prefix_sums, spans

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLE = 600
SALTS = 64
ROUNDS = 3
BLOCK, LONGEST = 31, 16
BYTE_P, SMOOTH = 1e-6, 0.05
CACHED_WORDS = 300_000
UNKNOWN = "und"
_TABLE = 1 << 22


def read_pieces(path: str = VOCABULARY) -> list[bytes]:
    """The vocabulary's pieces as UTF-8 bytes, lower case, the space mark as a space."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = set()
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        piece = model.id_to_piece(i).replace("▁", " ").lower()
        if " " not in piece[1:] and 0 < len(piece.encode()) <= LONGEST:
            found.add(piece.encode())
    return sorted(found)


class Pieces:
    """Vectorised lookup of byte substrings in the vocabulary."""

    def __init__(self, pieces: list[bytes]):
        size = np.array([len(p) for p in pieces])
        at = np.cumsum(size) - size
        sums = prefix_sums(np.frombuffer(b"".join(pieces), dtype=np.uint8))
        h = mix((sums[at + size] - sums[at]) * powers(INVERSE, int(at[-1]))[at] + size.astype(np.uint64))
        order = np.argsort(h)
        self.keys, self.ids = h[order], order.astype(np.int32)
        self.filled = np.zeros(_TABLE, dtype=bool)
        self.filled[self.keys >> np.uint64(42)] = True

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece ids of substring hashes; -1 where the substring is no piece."""
        out = np.full(h.shape, -1, dtype=np.int32)
        maybe = np.flatnonzero(self.filled[h >> np.uint64(42)])
        at = np.minimum(np.searchsorted(self.keys, h[maybe]), self.keys.size - 1)
        same = self.keys[at] == h[maybe]
        out[maybe[same]] = self.ids[at[same]]
        return out


def segment_ids(words: np.ndarray, pieces: Pieces) -> dict[tuple[int, int], np.ndarray]:
    """(start, end) -> piece id of that substring of each word (words of one length)."""
    n, length = words.shape
    sums = prefix_sums(words.ravel())
    base = np.arange(n, dtype=np.int64) * length
    inverse = powers(INVERSE, int(n * length))
    out = {}
    for s in range(length):
        scale = inverse[base + s]
        for e in range(s + 1, min(length, s + LONGEST) + 1):
            ids = pieces.find(mix((sums[base + e] - sums[base + s]) * scale + np.uint64(e - s)))
            if (ids >= 0).any():
                out[s, e] = ids
    return out


def forward(words: np.ndarray, ids: dict, prob: np.ndarray) -> np.ndarray:
    """alpha[pos, word, language]: probability of the first ``pos`` bytes, summed over segmentations."""
    n, length = words.shape
    alpha = np.zeros((length + 1, n, prob.shape[1]))
    alpha[0] = 1
    for e in range(1, length + 1):
        alpha[e] = alpha[e - 1] * BYTE_P
        for s in range(max(0, e - LONGEST), e):
            own = ids.get((s, e))
            if own is not None:
                alpha[e] += alpha[s] * prob[own]  # the last row of prob is zero: no piece
    return alpha


def expected_counts(words: np.ndarray, weight: np.ndarray, lang: int, pieces: Pieces, prob: np.ndarray,
                    counts: np.ndarray) -> None:
    """Adds each piece's expected number of uses in the words (of one length, one language)."""
    ids = segment_ids(words, pieces)
    one = prob[:, lang: lang + 1]
    alpha = forward(words, ids, one)[:, :, 0]
    length = words.shape[1]
    beta = np.zeros_like(alpha)
    beta[length] = 1
    for s in range(length - 1, -1, -1):
        beta[s] = beta[s + 1] * BYTE_P
        for e in range(s + 1, min(length, s + LONGEST) + 1):
            own = ids.get((s, e))
            if own is not None:
                beta[s] += beta[e] * one[own, 0]
    scale = weight / alpha[length]
    found, uses = [], []
    for (s, e), own in ids.items():
        hit = np.flatnonzero(own >= 0)
        found.append(own[hit])
        uses.append((alpha[s] * one[own, 0] * beta[e] * scale)[hit])
    if found:
        counts[:, lang] += np.bincount(np.concatenate(found), np.concatenate(uses), minlength=counts.shape[0])


def _blocks(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word blocks of at most BLOCK bytes: starts, ends, and whether a word begins there."""
    starts, ends = spans(buf, NOT_SPACE)
    parts = -(-(ends - starts) // BLOCK)
    if starts.size and parts.max() > 1:
        word = np.repeat(np.arange(starts.size), parts)
        inner = np.arange(word.size) - np.repeat(np.cumsum(parts) - parts, parts)
        s = starts[word] + inner * BLOCK
        return s, np.minimum(s + BLOCK, ends[word]), inner == 0
    return starts, ends, np.ones(starts.size, dtype=bool)


def _by_length(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray):
    """Groups of equally long blocks as byte matrices (with the leading space): (positions, matrix)."""
    kind = (ends - starts) * 2 + first
    for k in np.unique(kind):
        own = np.flatnonzero(kind == k)
        n = int(k) // 2
        m = buf[starts[own][:, None] + np.arange(n)]
        if k & 1:
            m = np.concatenate([np.full((own.size, 1), 32, dtype=np.uint8), m], axis=1)
        for i in range(0, own.size, 20_000):
            yield own[i: i + 20_000], m[i: i + 20_000]


def _joined(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Tables of at least ``rows`` rows (the last may be shorter)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


class Scorer:
    """Log-likelihoods of texts, with a bounded cache of word scores in each Python worker."""

    def __init__(self, pieces: Pieces, prob: np.ndarray):
        self.pieces, self.prob, self.cache = pieces, prob, {}
        self.rows = np.empty((CACHED_WORDS, prob.shape[1]))

    def words(self, buf: np.ndarray, keys: np.ndarray, starts, ends, first) -> np.ndarray:
        """Log-probabilities of distinct blocks."""
        out = np.empty((keys.size, self.prob.shape[1]))
        slot = np.fromiter((self.cache.get(k, -1) for k in keys.tolist()), dtype=np.int64, count=keys.size)
        known = slot >= 0
        out[known] = self.rows[slot[known]]
        new = np.flatnonzero(~known)
        for own, m in _by_length(buf, starts[new], ends[new], first[new]):
            out[new[own]] = np.log(forward(m, segment_ids(m, self.pieces), self.prob)[-1])
        free = new[: CACHED_WORDS - len(self.cache)]
        at = len(self.cache)
        self.rows[at: at + free.size] = out[free]
        self.cache.update(zip(keys[free].tolist(), range(at, at + free.size), strict=True))
        return out

    def texts(self, texts: list[bytes | None]) -> np.ndarray:
        """Log-likelihood of each text and language."""
        total = np.zeros((len(texts), self.prob.shape[1]))
        group, size = [], 0
        for i, data in enumerate(texts):
            if data:
                group.append(i)
                size += len(data)
            if group and (size > 1 << 20 or i + 1 == len(texts)):
                buf = np.frombuffer(b" ".join(texts[j] for j in group), dtype=np.uint8)
                ends_at = np.cumsum([len(texts[j]) + 1 for j in group])
                starts, ends, first = _blocks(buf)
                if starts.size:
                    keys = mix(hash_words(buf, starts, ends) + first)
                    uniq, at, back = np.unique(keys, return_index=True, return_inverse=True)
                    score = self.words(buf, uniq, starts[at], ends[at], first[at])[back]
                    doc = np.searchsorted(ends_at, starts, side="right")
                    for c in range(score.shape[1]):
                        total[group, c] += np.bincount(doc, score[:, c], minlength=len(group))
                group, size = [], 0
        return total


def _fold(modulus: int):
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(modulus))


def fit(learn: DataFrame, path: str = VOCABULARY) -> tuple[list[str], list[bytes], np.ndarray]:
    """learn: text (binary, lower case), lang, doc_id -> languages, pieces, probabilities."""
    spark = learn.sparkSession
    pieces = read_pieces(path)
    shared = spark.sparkContext.broadcast(pieces)  # the fixed vocabulary
    # in SALTS parts a language first, so that the last ranking reads a bounded number of rows
    part = F.expr(f"row_number() over (partition by lang, pmod(h, {SALTS}) order by h, doc_id)")
    order = F.expr("row_number() over (partition by lang order by h, doc_id)")
    ids = (learn.select("lang", "doc_id", F.xxhash64("doc_id").alias("h"))
           .withColumn("r", part).where(F.col("r") <= SAMPLE)
           .withColumn("r", order).where(F.col("r") <= SAMPLE).select("lang", "doc_id").distinct())
    ids = save(ids, "lang-ids")
    langs = sorted(r["lang"] for r in ids.select("lang").distinct().collect())
    number = {x: i for i, x in enumerate(langs)}
    if not langs:
        return [], pieces, np.zeros((len(pieces) + 1, 0))

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out_l, out_w, out_f, out_n = [], [], [], []
            for lang, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                buf = np.frombuffer(data or b"", dtype=np.uint8)
                if not buf.size:
                    continue
                starts, ends, first = _blocks(buf)
                seen: dict = {}
                for s, e, f in zip(starts.tolist(), ends.tolist(), first.tolist(), strict=True):
                    key = (data[s:e], f)
                    seen[key] = seen.get(key, 0) + 1
                for (w, f), n in seen.items():
                    out_l.append(number[lang])
                    out_w.append(w)
                    out_f.append(f)
                    out_n.append(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out_l, pa.int32()), pa.array(out_w, pa.binary()), pa.array(out_f, pa.bool_()),
                 pa.array(out_n, pa.int64())], names=["lang", "word", "first", "n"])

    # at most SAMPLE rows a language: a bounded table
    sample = learn.join(F.broadcast(ids), ["lang", "doc_id"], "left_semi").select("lang", "text")
    words = save(sample.mapInArrow(count_words, "lang int, word binary, first boolean, n long")
                 .groupBy("lang", "word", "first").agg(F.sum("n").alias("n")), "lang-words")
    size = len(pieces)
    prob = np.full((size + 1, len(langs)), 1.0 / size)
    prob[size] = 0
    for _ in range(ROUNDS):
        current = spark.sparkContext.broadcast(prob)

        def expect(batches: Iterator[pa.RecordBatch], current=current) -> Iterator[pa.RecordBatch]:
            table = Pieces(shared.value)
            counts = np.zeros((len(shared.value), current.value.shape[1]))
            for part in _joined(batches, 50_000):
                lang, n = part.column(0).to_numpy(), part.column(3).to_numpy().astype(float)
                word = part.column(1).to_pylist()
                first = part.column(2).to_numpy()
                buf = np.frombuffer(b"".join(word), dtype=np.uint8)
                ends = np.cumsum([len(w) for w in word])
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                for c in np.unique(lang):
                    mine = np.flatnonzero(lang == c)
                    for own, m in _by_length(buf, starts[mine], ends[mine], first[mine]):
                        expected_counts(m, n[mine[own]], int(c), table, current.value, counts)
            piece, c = np.nonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(piece.astype(np.int32)), pa.array(c.astype(np.int32)),
                                              pa.array(counts[piece, c])], names=["piece", "lang", "n"])

        got = (words.mapInArrow(expect, "piece int, lang int, n double")
               .groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas())  # vocabulary x languages
        counts = np.zeros((size, len(langs)))
        counts[got["piece"].to_numpy(), got["lang"].to_numpy()] = got["n"].to_numpy()
        prob = np.zeros((size + 1, len(langs)))
        prob[:size] = (counts + SMOOTH) / (counts.sum(0) + SMOOTH * size)
    return langs, pieces, prob


def identify(docs: DataFrame, path: str = VOCABULARY, folds: int = 4, held: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score; one row for each row of ``docs``."""
    spark = docs.sparkSession
    prepare(spark)
    out_fold = _fold(folds) == held
    lower = F.lower("text").cast("binary")
    learn = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~out_fold)
    langs, pieces, prob = fit(learn.select("doc_id", "lang", lower.alias("text")), path)
    rows = docs.select("doc_id", out_fold.alias("held_out"),
                       F.when(F.col("text").rlike(r"\p{L}"), lower).alias("text"))
    if not langs:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    model = spark.sparkContext.broadcast((langs, pieces, prob))  # vocabulary x languages

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, vocabulary, p = model.value
        scorer = Scorer(Pieces(vocabulary), p)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            ll = scorer.texts(texts)
            best = ll.argmax(1)
            score = 1 / np.exp(ll - ll.max(1, keepdims=True)).sum(1)
            lang = [names[b] if t else UNKNOWN for b, t in zip(best.tolist(), texts, strict=True)]
            score[[not t for t in texts]] = 0
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lang), pa.array(score)],
                                             names=["doc_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double")

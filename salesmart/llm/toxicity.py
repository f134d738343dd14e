"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks (method 8).

Words are compared by the gap-weighted subsequence kernel of Lodhi et al. (subsequences of three
letters, each skipped letter costs a factor ``DECAY``), so that an insult keeps most of its
similarity when letters are inserted, left out or followed by another ending. Punctuation inside a
word is skipped, and a run of three or more single letters ("i d i o t") also counts as one word.

Landmarks are words tied to the toxic label by their document counts, chosen greedily so that no two
are close. A word's features are its kernel values with the landmarks times K_mm^(-1/2) (Nyström);
a linear squared-hinge machine separates witness words of toxic documents' sentences from words of
clean ones. A sentence's margin is that of its strongest word (multiple-instance reading of labelled
sentences), a document is scored by a logistic function of its two strongest margins, over all its
sentences. The kernel is taken as 0 for a landmark if the word has under half of its neighbouring
letter pairs (up to two letters may stand between them in the word).

Learning reads a bounded, documented sample: the ``SAMPLE`` labelled rows of the learning folds with
the smallest hash of doc_id, whole texts. Scoring reads every whole text; words longer than
``WINDOW`` letters are read in overlapping windows.

Null and empty texts, and texts without letters, get the score of a document without any suspicious
word. Labels that are null teach nothing; a document labelled twice is toxic if one row says so.
Without both classes in the sample, every score is the share of toxic rows (0 if there are none).
A null doc_id counts as '' for the fold. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import prepare, save
from salesmart.llm.textkernel import NOT_SPACE, hash_words, spans

SAMPLE = 8000
LANDMARKS, CLEAN_LANDMARKS = 36, 24
CLOSE = 0.62
DECAY, LENGTH = 0.6, 3
WINDOW, STEP = 20, 10
BEGIN, END = "(", ")"
OVERLAP, GAP = 0.5, 2
CANDIDATES, POSITIVES, NEGATIVES = 500, 1500, 12_000
CACHED_WORDS = 300_000
NO_WORD = -2.0
_LETTERS = re.compile(r"[\W\d_]+")


def windows(word: str) -> list[str]:
    """The word without punctuation and digits, its begin and end marked, in pieces of at most WINDOW letters."""
    word = _LETTERS.sub("", word)
    if len(word) < LENGTH:
        return []
    word = BEGIN + word + END
    if len(word) <= WINDOW:
        return [word]
    return [word[i: i + WINDOW] for i in range(0, len(word) - WINDOW + STEP, STEP)]


def codes(words: list[str], width: int = WINDOW) -> np.ndarray:
    return np.array(words, dtype=f"U{width}").view(np.uint32).reshape(len(words), width)


def subsequence_kernel(t: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Gap-weighted kernel of each pair of rows (letter codes, 0 pads), for subsequences of LENGTH."""
    n, m = t.shape
    place = DECAY ** np.arange(m, dtype=np.float64)
    run = np.ones((n, m + 1))  # K'_0 at the previous letter of s; K'_q by q below
    total = np.zeros(n)
    prime = [run] + [np.zeros((n, m + 1)) for _ in range(LENGTH - 1)]
    for i in range(s.shape[1]):
        same = (t == s[:, i, None]) & (t != 0)
        if not same.any():
            if not s[:, i:].any():
                break
            for q in range(1, LENGTH):
                prime[q] = prime[q] * DECAY
            continue
        total += DECAY * DECAY * (same * prime[LENGTH - 1][:, :m]).sum(1)
        for q in range(LENGTH - 1, 0, -1):
            x = DECAY * DECAY * same * prime[q - 1][:, :m]
            prime[q] = prime[q] * DECAY
            prime[q][:, 1:] += np.cumsum(x / place, axis=1) * place
    return total


class Landmarks:
    """Kernel features of words against fixed landmark words."""

    def __init__(self, words: list[str]):
        self.words = words
        self.codes = codes(words)
        self.self_k = subsequence_kernel(self.codes, self.codes)
        near = self._pairs(self.codes, 1)
        self.pairs = near.T.copy()
        self.need = np.ceil(OVERLAP * near.sum(1))

    @staticmethod
    def _pairs(c: np.ndarray, reach: int) -> np.ndarray:
        """Which hashed letter pairs, at most ``reach`` apart, each row of codes has (0 or 1)."""
        out = np.zeros((len(c), 257), dtype=np.float32)
        row = np.arange(len(c))[:, None]
        for gap in range(1, reach + 1):
            slot = (c[:, :-gap] * np.uint32(2654435761) + c[:, gap:] * np.uint32(40503)) >> np.uint32(7) & np.uint32(255)
            out[row, np.where(c[:, gap:] == 0, np.uint32(256), slot)] = 1
        return out[:, :256]

    def kernel(self, words: list[str]) -> np.ndarray:
        """Normalised kernel values, words x landmarks."""
        out = np.zeros((len(words), len(self.words)))
        if not words:
            return out
        c = codes(words)
        common = self._pairs(c, 1 + GAP) @ self.pairs >= self.need
        size = (c != 0).sum(1)
        for low, high in ((0, 8), (8, 12), (12, WINDOW)):
            w, k = np.nonzero(common & ((size > low) & (size <= high))[:, None])
            for i in range(0, w.size, 20_000):
                a, b = w[i: i + 20_000], k[i: i + 20_000]
                own = np.unique(a)
                norm = np.zeros(len(words))
                norm[own] = subsequence_kernel(c[own][:, :high], c[own][:, :high])
                value = subsequence_kernel(c[a][:, :high], self.codes[b])
                out[a, b] = value / np.sqrt(np.maximum(norm[a] * self.self_k[b], 1e-30))
        return out


def words_of(data: bytes | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """buf, starts, ends, hashes of the words; and the joined runs of single letters."""
    buf = np.frombuffer(data or b"", dtype=np.uint8)
    starts, ends = spans(buf, NOT_SPACE)
    single = np.flatnonzero(np.append(ends - starts == 1, False))
    joined = []
    if single.size >= 3:
        for run in np.split(single, np.flatnonzero(np.diff(single) != 1) + 1):
            if run.size >= 3:
                joined.append(buf[starts[run]].tobytes())
    return buf, starts, ends, hash_words(buf, starts, ends), joined


class Model:
    """Landmarks, Nyström projection folded into one weight vector, and the logistic scale."""

    def __init__(self, landmarks: list[str], weight: np.ndarray, bias: float, scale=(0.0, 0.0, 0.0)):
        self.landmarks, self.weight, self.bias, self.scale = Landmarks(landmarks), weight, bias, scale
        self.cache: dict[int, float] = {}

    def word_margins(self, words: list[str]) -> np.ndarray:
        """Margin of each word: its strongest window."""
        parts = [windows(w) for w in words]
        flat = [p for ps in parts for p in ps]
        k = self.landmarks.kernel(flat)
        margin = np.where(k.any(1), k @ self.weight + self.bias, NO_WORD)
        out = np.full(len(words), NO_WORD)
        np.maximum.at(out, np.repeat(np.arange(len(words)), [len(p) for p in parts]), margin)
        return np.maximum(out, NO_WORD)

    def top_two(self, texts: list[bytes | None]) -> np.ndarray:
        """The two strongest word margins of each text, strongest first."""
        docs = [words_of(t) for t in texts]
        new: dict[int, bytes] = {}
        for buf, starts, ends, h, _ in docs:
            for i, key in zip(*(x.tolist() for x in np.unique(h, return_index=True)[::-1]), strict=True):
                if key not in self.cache and key not in new:
                    new[key] = buf[starts[i]: ends[i]].tobytes()
        fresh = dict(zip(new, self.word_margins([w.decode("utf-8", "ignore") for w in new.values()]).tolist(),
                         strict=True))
        out = np.full((len(texts), 2), NO_WORD)
        for d, (_, _, _, h, joined) in enumerate(docs):
            if h.size:
                own, times = np.unique(h, return_counts=True)
                margins = np.array([fresh[k] if k in fresh else self.cache[k] for k in own.tolist()])
                top = np.argsort(-margins, kind="stable")[:2]
                best = np.repeat(margins[top], np.minimum(times[top], 2)).tolist()
                best += self.word_margins([j.decode("utf-8", "ignore") for j in joined]).tolist()
                best = sorted(best, reverse=True)[:2]
                out[d, : len(best)] = best
        for k, m in fresh.items():
            if len(self.cache) >= CACHED_WORDS:
                break
            self.cache[k] = m
        return out

    def score(self, top: np.ndarray) -> np.ndarray:
        b, w1, w2 = self.scale
        return 1 / (1 + np.exp(-np.clip(b + w1 * top[:, 0] + w2 * top[:, 1], -30, 30)))


def fit_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> tuple[np.ndarray, float]:
    """Linear squared-hinge machine by Newton steps on the active rows (y: -1 or 1)."""
    z = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    for _ in range(50):
        gap = 1 - y * (z @ w)
        live = gap > 0
        if not live.any():
            break
        zl, cl = z[live], weight[live]
        hess = (zl * cl[:, None]).T @ zl + ridge * np.eye(z.shape[1])
        grad = -(zl * (cl * y[live] * gap[live])[:, None]).sum(0) + ridge * w
        step = np.linalg.solve(hess, grad)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> tuple[float, float, float]:
    """Ridge logistic regression on two margins (y: 0 or 1)."""
    z = np.hstack([np.ones((len(x), 1)), x])
    c = np.full(len(y), 100 / len(y))
    w = np.zeros(3)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (c * (p - y)) + ridge * w
        hess = (z * (c * p * (1 - p))[:, None]).T @ z + ridge * np.eye(3)
        step = np.linalg.solve(hess, grad)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def _spread(words: list[str], most: int) -> list[str]:
    """The first words in order of which no two are close."""
    chosen: list[str] = []
    for word in words:
        if len(chosen) == most:
            break
        if not chosen or Landmarks(chosen).kernel([word]).max() < CLOSE:
            chosen.append(word)
    return chosen


def _fold(modulus: int):
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(modulus))


def _sentence_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(toxic, text) -> each distinct word of the text, in windows."""
    for batch in batches:
        toxic, word = [], []
        for label, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            raw = (data or b"").decode("utf-8", "ignore").split()
            joined = [j.decode() for j in words_of(data)[4] if j.isascii()]
            for w in {p for t in {*raw, *joined} for p in windows(t)}:
                toxic.append(label)
                word.append(w)
        yield pa.RecordBatch.from_arrays([pa.array(toxic, pa.int32()), pa.array(word, pa.string())],
                                         names=["toxic", "word"])


def fit(learn: DataFrame, labels: DataFrame) -> Model | float:
    """learn: doc_id, text (binary, lower case) of the learning folds. The share of toxic rows if one class only."""
    marks = (labels.where("toxic is not null and doc_id is not null").groupBy("doc_id")
             .agg(F.max("toxic").cast("int").alias("toxic")))
    # bounded: SAMPLE rows
    ids = marks.where(_fold(5) != 0).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    ids = save(ids, "toxic-ids")
    rows = save(learn.join(F.broadcast(ids), "doc_id").select("toxic", "text"), "toxic-rows")
    shares = rows.agg(F.avg("toxic").alias("p"), F.count("*").alias("n")).first()
    if not shares["n"] or shares["p"] in (0.0, 1.0):
        return float(shares["p"] or 0.0)
    base = shares["p"]
    words = save(rows.mapInArrow(_sentence_words, "toxic int, word string").groupBy("word")
                 .agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")), "toxic-words")
    # words whose toxic count cannot be chance: base**t under 1e-5, hardly any clean use
    sure = int(np.ceil(np.log(1e-5) / np.log(base))) if base < 1 else 1
    strong = ((F.col("t") >= sure) & (F.col("c") <= 0.02 * F.col("t"))) if base < 0.9 else F.lit(False)
    top = [r["word"] for r in words.where(strong).orderBy(F.desc("t"), "word").limit(CANDIDATES).collect()]
    if not top:
        return float(base)
    chosen = _spread(top, LANDMARKS)
    spark = learn.sparkSession
    shared = spark.sparkContext.broadcast(chosen)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = Landmarks(shared.value)
        for batch in batches:
            near = marks.kernel(batch.column(0).to_pylist()).max(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near)], names=["word", "t", "c", "near"])

    known = save(words.mapInArrow(features, "word string, t long, c long, near double")
                 .where("near > 0"), "toxic-features")
    good = known.where(strong).orderBy(F.desc("t"), "word").limit(POSITIVES).toPandas()
    bad = known.where("t <= c").orderBy(F.desc("near"), "word").limit(NEGATIVES).toPandas()
    # clean landmarks beside the toxic ones: the clean words that come closest to them
    chosen = chosen + _spread([w for w in bad["word"] if w not in chosen][:CANDIDATES], CLEAN_LANDMARKS)
    lm = Landmarks(chosen)
    gram = lm.kernel(chosen)
    value, vector = np.linalg.eigh((gram + gram.T) / 2)
    root = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-2))) @ vector.T
    x = lm.kernel([*good["word"], *bad["word"]]) @ root
    y = np.r_[np.ones(len(good)), -np.ones(len(bad))]
    uses = np.sqrt(np.r_[good["t"], bad["c"]].astype(float))
    uses[y > 0] *= 0.5 / uses[y > 0].sum()
    uses[y < 0] *= 0.5 / max(uses[y < 0].sum(), 1e-9)
    w, bias = fit_svm(x, y, uses)
    if not len(bad):
        bias = bias - 1.0
    model = Model(chosen, root @ w, bias)
    told = spark.sparkContext.broadcast((chosen, root @ w, bias))

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*told.value)
        for batch in batches:
            m = own.top_two(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(m[:, 0]), pa.array(m[:, 1])],
                                             names=["toxic", "m1", "m2"])

    seen = rows.mapInArrow(margins, "toxic int, m1 double, m2 double").toPandas()  # SAMPLE rows at most
    model.scale = fit_logistic(seen[["m1", "m2"]].to_numpy(), seen["toxic"].to_numpy().astype(float))
    return model


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: one row for each row of ``docs``."""
    spark = docs.sparkSession
    prepare(spark)
    lower = F.lower("text").cast("binary")
    learn = docs.where(F.col("doc_id").isNotNull() & (_fold(5) != 0)).select("doc_id", lower.alias("text"))
    model = fit(learn, labels)
    rows = docs.select("doc_id", (_fold(5) == 0).alias("held_out"), lower.alias("text"))
    if isinstance(model, float):
        out = rows.select("doc_id", "held_out", F.lit(model).alias("score"))
    else:
        told = spark.sparkContext.broadcast((model.landmarks.words, model.weight, model.bias, model.scale))

        def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = Model(*told.value)
            for batch in batches:
                s = own.score(own.top_two(batch.column(2).to_pylist()))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s)],
                                                 names=["doc_id", "held_out", "score"])

        out = rows.mapInArrow(predict, "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents of ``docs`` (all columns) that are not predicted toxic."""
    spark = docs.sparkSession
    prepare(spark)
    lower = F.lower("text").cast("binary")
    learn = docs.where(F.col("doc_id").isNotNull() & (_fold(5) != 0)).select("doc_id", lower.alias("text"))
    model = fit(learn, labels)
    if isinstance(model, float):
        return docs  # nothing learned, nothing rejected
    told = spark.sparkContext.broadcast((model.landmarks.words, model.weight, model.bias, model.scale))
    @F.pandas_udf("boolean")
    def toxic(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Model(*told.value)
        for texts in parts:
            yield pd.Series(own.score(own.top_two(texts.tolist())) >= 0.5)

    return docs.where(~toxic(lower))

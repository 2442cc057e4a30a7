"""Quality classifier: random-indexing word vectors, pooled per document, and a small
two-layer network with temperature-calibrated probabilities.

* Every word falls into one of ``buckets`` hash buckets; each bucket has a fixed
  sparse random index vector. A bucket's word vector is the sum of the index vectors
  of its neighbours (two words to either side) over all documents of the corpus,
  summed per partition and then over partitions.
* A document is the mean and the spread of its words' vectors, with the shares of
  word shapes (case, digits, punctuation) and how often words repeat.
* A network with one hidden layer is fitted on a bounded sample of labelled documents
  (``max_labelled``, chosen by hash of the id); a temperature fitted on a part of it
  that the network has not seen turns its outputs into calibrated probabilities.

Sizes on the driver and in broadcasts are bounded by parameters: ``buckets * dims``
numbers of word vectors and ``max_labelled`` pooled documents.

Defined results: null text counts as empty; empty texts get a score like any other;
documents whose id is null are scored and never held out; repeated rows are scored
each; where there are no labels of both kinds the score is the share of label 1 (0.5
without any); an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelstride.llm.common import text_of, written

SHAPES = 12
_WORD = re.compile(r"\w+|[^\w\s]+")
#: Words that one worker process remembers the bucket of.
REMEMBERED_WORDS = 200_000


def _shape(word: str) -> int:
    """Kind of word: 0-3 letters by case, 4-5 with digits, 6-9 punctuation by length."""
    if word.isalpha():
        if word.islower():
            return 0
        if word.isupper():
            return 2 if len(word) > 1 else 1
        return 1 if word[1:].islower() else 3
    if word.isdigit():
        return 4
    if any(c.isalnum() for c in word):
        return 5
    return 5 + min(len(word), 4)


class _Codes(dict):
    """Word -> bucket + buckets * shape, remembered up to a bound."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, word: str) -> int:
        code = zlib.crc32(word.encode()) % self.buckets + self.buckets * _shape(word)
        if len(self) < REMEMBERED_WORDS:
            self[word] = code
        return code


_codes: dict[int, _Codes] = {}


def words(texts: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all words of the texts, where each text ends, and letters of each text."""
    known = _codes.setdefault(buckets, _Codes(buckets))
    codes, ends = [], []
    for t in texts:
        codes += map(known.__getitem__, _WORD.findall(t))
        ends.append(len(codes))
    return (np.array(codes, np.int64), np.array(ends, np.int64),
            np.array([len(t) for t in texts], np.int64))


def index_vectors(buckets: int, dims: int, nonzero: int = 4, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """For each bucket the places of its non-zero elements and their signs."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, dims, (buckets, nonzero)), rng.choice([-1.0, 1.0], (buckets, nonzero))


def _batches(batches: Iterator[pa.RecordBatch], column: int, rows: int = 256):
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part, part.column(column).to_pylist()


def word_vectors(docs: DataFrame, buckets: int, dims: int, window: int = 2, seed: int = 0) -> np.ndarray:
    """Unit vectors of all buckets from the contexts of the whole corpus."""
    names = [f"v{i}" for i in range(dims)]

    def sums(batches):
        place, sign = index_vectors(buckets, dims, seed=seed)
        total = np.zeros(buckets * dims)
        for _, texts in _batches(batches, 0):
            codes, ends, _ = words(texts, buckets)
            word = codes % buckets
            doc = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
            for off in range(1, window + 1):
                same = np.flatnonzero(doc[off:] == doc[:-off])
                for a, b in ((same, same + off), (same + off, same)):
                    cell = (word[a] * dims)[:, None] + place[word[b]]
                    total += np.bincount(cell.ravel(), sign[word[b]].ravel(), buckets * dims)
        table = total.reshape(buckets, dims)
        met = np.flatnonzero(np.abs(table).sum(1))
        for at in range(0, len(met), 4096):
            some = met[at:at + 4096]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), *[pa.array(table[some, i]) for i in range(dims)]],
                names=["bucket", *names])

    summed = (docs.select("text").mapInArrow(sums, ", ".join(["bucket int", *[f"{n} double" for n in names]]))
              .groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names]))
    out = np.zeros((buckets, dims))
    for r in summed.collect():  # bounded: one row for each bucket
        out[r[0]] = r[1:]
    length = np.linalg.norm(out, axis=1, keepdims=True)
    out = np.divide(out, length, out=np.zeros_like(out), where=length > 0)
    return (out - out[length[:, 0] > 0].mean(0) if (length > 0).any() else out).astype(np.float32)


def pool(texts: list[str], vectors: np.ndarray) -> np.ndarray:
    """A row of features for each text."""
    buckets, dims = vectors.shape
    codes, ends, chars = words(texts, buckets)
    n = np.diff(ends, prepend=0)
    starts, some = ends - n, n > 0
    word, shape = codes % buckets, codes // buckets
    count = np.maximum(n, 1)[:, None]
    out = np.zeros((len(texts), 2 * dims + SHAPES + 4), np.float32)
    if some.any():
        met = vectors[word]
        mean = np.add.reduceat(met, starts[some], axis=0) / count[some]
        square = np.add.reduceat(met * met, starts[some], axis=0) / count[some]
        out[some, :dims] = mean
        out[some, dims:2 * dims] = np.sqrt(np.maximum(square - mean * mean, 0))
    doc = np.repeat(np.arange(len(texts)), n)
    tail = out[:, 2 * dims:]
    tail[:, :SHAPES] = np.bincount(doc * SHAPES + shape, minlength=len(texts) * SHAPES).reshape(-1, SHAPES) / count
    pair = np.unique(doc * np.int64(buckets) + word) // buckets
    tail[:, SHAPES] = np.bincount(pair, minlength=len(texts)) / count[:, 0]  # distinct words
    again = (word[1:] == word[:-1]) & (doc[1:] == doc[:-1])
    tail[:, SHAPES + 1] = np.bincount(doc[1:][again], minlength=len(texts)) / count[:, 0]
    tail[:, SHAPES + 2] = np.log1p(n)
    tail[:, SHAPES + 3] = np.log1p(chars / np.maximum(n, 1))
    return out


class Network:
    """Two-layer network on standardised features; logits over a fitted temperature."""

    def __init__(self, width: int, hidden: int = 32, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.w1 = rng.normal(0, 1 / np.sqrt(width), (width, hidden))
        self.b1 = np.zeros(hidden)
        self.w2 = rng.normal(0, 1 / np.sqrt(hidden), hidden)
        self.b2 = np.zeros(1)
        self.mean, self.scale, self.temperature = np.zeros(width), np.ones(width), 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 60, batch: int = 128, rate: float = 3e-3,
            decay: float = 1e-4, seed: int = 0) -> Network:
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(x))
        check, train = order[:len(x) // 5], order[len(x) // 5:]
        self.mean, self.scale = x[train].mean(0), x[train].std(0) + 1e-6
        weights = [self.w1, self.b1, self.w2, self.b2]
        first, second, t = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
        for _ in range(epochs):
            rng.shuffle(train)
            for at in range(0, len(train), batch):
                some = train[at:at + batch]
                z = np.clip((x[some] - self.mean) / self.scale, -8, 8)
                h = np.tanh(z @ self.w1 + self.b1)
                miss = (1 / (1 + np.exp(-np.clip(h @ self.w2 + self.b2, -40, 40))) - y[some]) / len(some)
                back = np.outer(miss, self.w2) * (1 - h * h)
                grads = [z.T @ back + decay * self.w1, back.sum(0), h.T @ miss + decay * self.w2, miss.sum(keepdims=True)]
                t += 1
                for w, g, m, v in zip(weights, grads, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        out, label = self.logits(x[check]), y[check]

        def loss(temperature: float) -> float:
            s = out / temperature
            return float(np.mean(np.logaddexp(0, s) - label * s))

        low, high = np.log(0.25), np.log(16.0)
        for _ in range(40):  # golden section: the loss is unimodal in the temperature
            a, b = high - 0.618 * (high - low), low + 0.618 * (high - low)
            low, high = (low, b) if loss(np.exp(a)) < loss(np.exp(b)) else (a, high)
        if len(check):
            self.temperature = float(np.exp((low + high) / 2))
        return self


def held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", buckets: int = 1 << 14, dims: int = 32,
             max_labelled: int = 20_000, seed: int = 0) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (probability of label 1), ``predicted``."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    vectors = word_vectors(src, buckets, dims, seed=seed)
    width = 2 * dims + SHAPES + 4

    def pooled(batches):
        for part, texts in _batches(batches, 1, rows=32):  # few, so that their vectors stay in the cache
            rows = pool(texts, vectors)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * width), pa.array(rows.ravel()))
            yield pa.RecordBatch.from_arrays([part.column(0), flat], names=["doc_id", "features"])

    table = written(src.mapInArrow(pooled, "doc_id long, features array<float>"), "features")

    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.max(label_col).cast("double").alias("label"))
             .where(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id")
             .limit(max_labelled))
    # bounded: at most max_labelled rows are broadcast and come to the driver
    rows = (table.join(F.broadcast(known), "doc_id").groupBy("doc_id")
            .agg(F.min("features").alias("features"), F.max("label").alias("label")).collect())
    rows.sort(key=lambda r: r.doc_id)
    x = np.array([r.features for r in rows], np.float64).reshape(len(rows), width)
    y = np.array([float(r.label > 0) for r in rows])
    network = Network(width, seed=seed).fit(x, y, seed=seed) if 0 < y.sum() < len(y) else None
    prior = float(y.mean()) if len(y) else 0.5

    def scored(batches):
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
            s = network.scores(x) if network else np.full(len(x), prior)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s)], names=["doc_id", "score"])

    return (table.mapInArrow(scored, "doc_id long, score double")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")))


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.5, id_col: str = "doc_id",
              text_col: str = "text", **options) -> DataFrame:
    """The documents whose score is at least ``least``, with all their columns. Rows
    that share an id stay if any of them does."""
    good = (classify(docs, labels, id_col, text_col, **options).where(F.col("score") >= least)
            .select(F.col("doc_id").alias("_good")).distinct())
    return docs.join(good, F.col(id_col).cast("long").eqNullSafe(F.col("_good")), "left_semi")

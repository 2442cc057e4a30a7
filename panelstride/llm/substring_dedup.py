"""Removal of long repeated passages by compacting a de Bruijn graph of word k-mers.

Every window of ``k`` words is an edge of the graph (between its first and last
``k - 1`` words). Edges that occur once are of no interest, and the others are never
listed one by one:

1. Consecutive windows that share their minimizer (the first place of the smallest
   hash among the short word groups inside a window) form a run; equal windows have
   equal minimizers, so a minimizer met once in the corpus rules out its whole run. Only the minimizer, a
   hash of the run's words and its coordinates are shuffled.
2. Equal runs with several occurrences are stretches of repeated edges. Joins compare
   what precedes and follows them: where neither branches, runs are compacted to one
   path, named by its source coordinates (its first occurrence).
3. The documents concerned digest the words of each path's occurrence, and list the
   windows of runs that are not repeated as a whole but share a minimizer with
   another. Digests and window hashes are compared over the corpus: a span counts as
   repeated only if the words at its coordinates are those of another occurrence.
4. Words covered by a verified span go.

Texts are shuffled once; those of documents with candidates a second time.

Defined results: null text counts as empty; a text of fewer than ``k`` words loses
nothing; windows are judged on the input; a window that starts twice in one document,
or in two rows repeated with the same id, is repeated; a null id is kept; an empty
table gives no rows; further columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelstride.llm.common import text_of, written

#: Odd factors of the two polynomial hashes.
FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers_to(factor: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the factor and of its inverse modulo 2**64."""
    if factor not in _powers or len(_powers[factor][0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        out = []
        for f in (factor, pow(factor, -1, 1 << 64)):
            p = np.ones(size, np.uint64)
            p[1:] = np.uint64(f)
            out.append(np.cumprod(p, dtype=np.uint64))
        _powers[factor] = tuple(out)
    return _powers[factor]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class Words:
    """The words of several texts (split as bytes: at ASCII white space only) one after
    the other, with hashes of any stretch."""

    def __init__(self, split: list[list[bytes]]):
        self.words = [w for ws in split for w in ws]
        n = np.array([len(ws) for ws in split], np.int64)
        self.ends = np.cumsum(n)
        self.begins = self.ends - n
        n = len(self.words)
        digest = xxhash.xxh64_digest
        h = np.frombuffer(b"".join([digest(w, 7) for w in self.words]), np.uint64)
        self.sums = []
        for f in FACTORS:
            power, _ = _powers_to(f, n + 1)
            self.sums.append(np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * power[:n], dtype=np.uint64))))

    def hashes(self, which: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        _, inverse = _powers_to(FACTORS[which], len(self.words) + 1)
        s = self.sums[which]
        return _mixed((s[ends] - s[starts]) * inverse[starts])

    def minimizers(self, k: int, group: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts of all windows inside one text, the minimizer of each and its place."""
        n = len(self.words)
        if n < k:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        at = np.arange(n - group + 1)
        low, width, span = self.hashes(0, at, at + group), 1, k - group + 1
        while width < span:
            step = min(width, span - width)
            later = low[step:] < low[:-step]
            low = np.where(later, low[step:], low[:-step])
            at = np.where(later, at[step:], at[:-step])
            width += step
        text = np.repeat(np.arange(len(self.ends)), np.diff(self.ends, prepend=0))
        starts = np.flatnonzero(text[:n - k + 1] == text[k - 1:])
        return starts, low[starts], at[starts]

    def runs(self, k: int, group: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text, first window inside it, number of windows, minimizer and hash of each run."""
        starts, low, place = self.minimizers(k, group)
        new = np.ones(len(starts), bool)
        new[1:] = (np.diff(starts) != 1) | (place[1:] != place[:-1])
        first = np.flatnonzero(new)
        n = np.diff(np.append(first, len(starts)))
        begin = starts[first]
        h = self.hashes(1, begin, begin + n + k - 1) + n.astype(np.uint64) * np.uint64(FACTORS[0])
        text = np.searchsorted(self.ends, begin, side="right")
        return text, begin - self.begins[text], n, low[first], h


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 64):
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def run_table(src: DataFrame, k: int, group: int) -> DataFrame:
    """All runs of the corpus: ``doc``, ``th``, ``start``, ``n``, ``m``, ``h``."""
    def each(batches):
        for part in _parts(batches):
            words = Words([t.split() for t in part.column(2).cast(pa.binary()).to_pylist()])
            text, start, n, low, h = words.runs(k, group)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(text)), part.column(1).take(pa.array(text)),
                 pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)), _signed(low), _signed(h)],
                names=["doc", "th", "start", "n", "m", "h"])

    return src.select("doc", "th", "text").mapInArrow(each, "doc long, th long, start int, n int, m long, h long")


def _whole(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Runs repeated as a whole, and runs whose windows must be compared one by one."""
    several = written(
        found.groupBy("m").agg(F.count(F.lit(1)).alias("times"), F.min("h").alias("low"), F.max("h").alias("high"))
        .where("times > 1").select("m", (F.col("low") == F.col("high")).alias("one")), "minimizers")
    met = written(found.join(several, "m"), "candidates")
    mixed = met.where(~F.col("one"))
    equal = written(mixed.groupBy("m", "h").agg(
        F.count(F.lit(1)).alias("times"), F.min(F.struct("doc", "th", "start")).alias("source")), "equal_runs")
    told = written(mixed.join(equal, ["m", "h"]), "mixed_runs")
    columns = ["doc", "th", "start", "n", "m", "h"]
    whole = met.where("one").select(columns).unionByName(told.where("times > 1").select(columns))
    # of equal runs the first occurrence alone lists its windows, known to be repeated
    single = told.where((F.col("times") == 1) | (F.struct("doc", "th", "start") == F.col("source"))).select(
        *columns, (F.col("times") > 1).alias("known"))
    return whole, single


def _paths(whole: DataFrame) -> DataFrame:
    """Occurrences of compacted paths: ``doc``, ``th``, ``start``, ``n``, ``m``, ``h``
    (of the path's first run)."""
    order = Window.partitionBy("doc", "th").orderBy("start", "m", "h")
    this = F.struct("m", "h")

    def beside(step: int) -> Column:
        """The run directly before or after this one; null where there is none."""
        other = F.lead(F.struct("start", "n", "m", "h"), step) if step > 0 else F.lag(F.struct("start", "n", "m", "h"), -step)
        other = other.over(order)
        touches = (other.start == F.col("start") + F.col("n")) if step > 0 else (other.start + other.n == F.col("start"))
        return F.when(touches, F.struct(other.m.alias("m"), other.h.alias("h")))

    told = whole.withColumn("after", beside(1)).withColumn("before", beside(-1))

    def only(column: str) -> Column:
        """The value if all occurrences have it."""
        same = (F.count(column) == F.count(F.lit(1))) & (F.min(column) == F.max(column))
        return F.when(same, F.min(column))

    nodes = written(told.groupBy("m", "h").agg(
        F.min(F.struct("doc", "th", "start")).alias("source"), F.max("n").alias("n"),
        only("after").alias("after"), only("before").alias("before")), "runs")
    # a run goes on its predecessor's path if neither branches on the side they share
    ahead = nodes.where("after IS NOT NULL").select(
        F.col("after.m").alias("to_m"), F.col("after.h").alias("to_h"), F.struct("m", "h").alias("from"),
        F.struct("source.doc", "source.th", (F.col("source.start") + F.col("n")).alias("start")).alias("place"))
    linked = nodes.join(ahead, (F.col("m") == F.col("to_m")) & (F.col("h") == F.col("to_h"))
                        & (F.col("before") == F.col("from")), "left").withColumn(
        "on", F.coalesce(F.col("source") == F.col("place"), F.lit(False)))
    along = Window.partitionBy("source.doc", "source.th").orderBy("source.start", "m", "h")
    chains = (linked.withColumn("path", F.sum(F.when(F.col("on"), 0).otherwise(1)).over(along))
              .groupBy("source.doc", "source.th", "path")
              .agg(F.min_by(this, F.struct("source.start", F.col("on"))).alias("head"), F.sum("n").cast("int").alias("n")))
    heads = written(chains.select("head.m", "head.h", "n"), "paths")
    return whole.drop("n").join(heads, ["m", "h"])


MARK = "struct<kind:int,start:int,n:int,a:bigint,b:bigint,d1:bigint,d2:bigint>"
PATH, WINDOW, KNOWN = 0, 1, 2


def _marks(split: list[list[bytes]], todo: pa.ListArray, k: int) -> tuple[pa.StructArray, np.ndarray]:
    """The marks of some documents one after the other, and how many each has."""
    doc = np.repeat(np.arange(len(split)), [0 if x is None else x for x in pc.list_value_length(todo).to_pylist()])
    kind, start, n, a, b = (c.to_numpy(zero_copy_only=False) for c in todo.flatten().flatten())
    whole = np.flatnonzero(kind == PATH)
    digests = [hashlib.blake2b(b" ".join(split[doc[i]][start[i]:start[i] + n[i] + k - 1]), digest_size=16).digest()
               for i in whole.tolist()]
    d = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)

    # windows: only the documents that have any are hashed, all of their windows at once
    runs = np.flatnonzero(kind != PATH)
    some, at = np.unique(doc[runs], return_inverse=True)
    words = Words([split[i] for i in some.tolist()])
    run = np.repeat(np.arange(len(runs)), n[runs])
    within = np.arange(len(run)) - np.repeat(np.cumsum(n[runs]) - n[runs], n[runs])
    begin = words.begins[at[run]] + start[runs[run]] + within
    # with the minimizer, from the other polynomial, 128 bits say which window it is
    hashes = words.hashes(1, begin, begin + k).view(np.int64)

    of = runs[run]
    columns = {
        "kind": np.concatenate((kind[whole], kind[of])), "start": np.concatenate((start[whole], start[of] + within)),
        "n": np.concatenate((n[whole], np.ones(len(of), n.dtype))), "a": np.concatenate((a[whole], a[of])),
        "b": np.concatenate((b[whole], b[of])), "d1": np.concatenate((d[:, 0], hashes)),
        "d2": np.concatenate((d[:, 1], np.zeros(len(of), np.int64)))}
    owner = np.concatenate((doc[whole], doc[of]))
    order = np.argsort(owner, kind="stable")
    kinds = {c: pa.int32() if c in ("kind", "start", "n") else pa.int64() for c in columns}
    return (pa.StructArray.from_arrays([pa.array(v[order], kinds[c]) for c, v in columns.items()], names=list(columns)),
            np.bincount(owner, minlength=len(split)))


def _marked(joined: DataFrame, k: int) -> DataFrame:
    """Documents without candidates are done; the others keep their text and get a
    mark for each path occurrence and each window to compare."""
    def each(batches):
        for part in _parts(batches):
            texts = part.column(3).cast(pa.binary()).to_pylist()
            split = [t.split() for t in texts]
            marks, count = _marks(split, part.column(4), k)
            done = (count == 0).tolist()
            sha = [hashlib.sha256(b" ".join(ws)).hexdigest() if d else None for ws, d in zip(split, done, strict=True)]
            ends = np.concatenate(([0], np.cumsum(count))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), part.column(2), pa.array([len(ws) for ws in split], pa.int64()),
                 pa.array(sha, pa.string()),
                 pa.array([None if d else t for t, d in zip(texts, done, strict=True)], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends), marks)],
                names=["doc", "th", "doc_id", "n_words", "kept_sha256", "text", "marks"])

    return joined.select("doc", "th", "doc_id", "text", "todo").mapInArrow(
        each, f"doc long, th long, doc_id long, n_words long, kept_sha256 string, text binary, marks array<{MARK}>")


def _cut(joined: DataFrame, k: int) -> DataFrame:
    def each(batches):
        for part in _parts(batches):
            removed, sha = [], []
            for text, spans in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                words = text.split()
                edge = np.zeros(len(words) + 1, np.int64)
                for s in spans or []:
                    edge[s["start"]] += 1
                    edge[s["start"] + s["n"] + k - 1] -= 1
                gone = np.cumsum(edge[:-1]) > 0
                removed.append(int(gone.sum()))
                sha.append(hashlib.sha256(b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(removed, pa.int64()), pa.array(sha, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return joined.select("doc_id", "n_words", "text", "spans").mapInArrow(
        each, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, k: int = 35, group: int = 8, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256``
    (of the words that stay, joined by one space)."""
    text = text_of(text_col)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                      F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("doc"),
                      F.xxhash64(text).alias("th"), text.alias("text"))
    whole, single = _whole(written(run_table(src, k, group), "all_runs"))
    paths = _paths(whole)
    todo = (paths.select("doc", "th", F.struct(F.lit(PATH).alias("kind"), "start", "n", F.col("m").alias("a"), F.col("h").alias("b")).alias("t"))
            .unionByName(single.select("doc", "th", F.struct(
                F.when(F.col("known"), KNOWN).otherwise(WINDOW).alias("kind"), "start", "n",
                F.col("m").alias("a"), F.lit(0).cast("long").alias("b")).alias("t")))
            .groupBy("doc", "th").agg(F.collect_set("t").alias("todo")))  # of one document: bounded by its length
    table = written(_marked(src.join(written(todo, "todo"), ["doc", "th"], "left"), k), "marked")

    marks = table.select("doc", "th", F.explode("marks").alias("x")).select("doc", "th", "x.*")
    same = ["kind", "a", "b", "d1", "d2"]
    # a window of a run known to be repeated counts for two
    keyed = marks.withColumn("weight", F.when(F.col("kind") == KNOWN, 2).otherwise(1)).withColumn(
        "kind", F.when(F.col("kind") == PATH, PATH).otherwise(WINDOW))
    repeated = written(keyed.groupBy(same).agg(F.sum("weight").alias("times")).where("times > 1").drop("times"), "repeated")
    spans = (keyed.where("weight = 1").join(repeated, same)
             .groupBy("doc", "th").agg(F.collect_set(F.struct("start", "n")).alias("spans")))  # of one document
    open_ = table.where("text IS NOT NULL")
    cut = _cut(open_.join(written(spans, "spans"), ["doc", "th"], "left"), k)
    return (table.where("text IS NULL").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256")
            .unionByName(cut))

"""Best-fit packing of tokenised documents into sequences by linear grouping.

Lengths are whole numbers up to the sequence length, so the packing problem is its
histogram of lengths: one count for each length, however many documents there are.
The plan is made from that histogram (bounded by the sequence length, never by the
documents) and says for every length which ranks go to which sequences:

1. large lengths, longest first, are cut into groups of equal cardinality and rounded
   up to the longest of their group, which leaves a few sizes;
2. for these sizes the best configurations of a sequence are found by column
   generation (Gilmore and Gomory), and each is used a whole number of times;
3. the slots of the configurations are filled with actual documents, which are never
   longer than the rounded size;
4. what is left, longest first, goes to the tightest gap that takes it.

Spark tokenises, cuts, ranks the pieces inside their length and looks up each piece's
place in the plan. Tokens are counted and hashed where they are made and never moved.

Defined results: null text counts as empty; an empty text is one piece with the end
id alone; repeated rows are packed as often as they occur; a null id is kept as null;
an empty table gives no rows; further columns of the input are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import islice
from unicodedata import is_normalized

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelstride.llm.common import rank_in_class, text_of, written

#: Words, and parts of words, that one worker process remembers (under 200 bytes each);
#: others are encoded each time.
REMEMBERED_WORDS, REMEMBERED_PARTS = 250_000, 250_000

#: A word of letters (or what is not ASCII), then ASCII punctuation without apostrophe.
_PARTS = re.compile(rb"([A-Za-z\x80-\xff]+)([!-&(-/:-@\[-`{-~]*)")

_memory: dict[str, tuple] = {}


def _tokenizer(path: str):
    """The tokenizer, its merges, and this process's memory of encoded words and parts."""
    if path not in _memory:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        _memory[path] = (tokenizer, _Merges(tokenizer), {}, {})
    return _memory[path]


def _remember(memory: dict, fresh: dict, most: int) -> None:
    memory.update(islice(fresh.items(), max(0, most - len(memory))))


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Merges(dict):
    """Encodes a word of letters alone: there only the tokenizer's lower case, its byte
    alphabet (asked from it for each new character) and its merges matter."""

    def __init__(self, tokenizer):
        super().__init__()
        self.alphabet, self.merge = tokenizer.pre_tokenizer.pre_tokenize_str, tokenizer.model.tokenize

    def __missing__(self, char: str) -> str:
        self[char] = "".join(piece for piece, _ in self.alphabet(char))
        return self[char]

    def encode(self, letters: str) -> bytes:
        return _packed([t.id for t in self.merge("".join([self[c] for c in letters]))])


def _encode_words(words: set[bytes], tokenizer, merges: _Merges, words_known: dict[bytes, bytes],
                  known: dict[str, bytes]) -> dict[bytes, bytes]:
    """The ids of distinct words.

    The tokenizer cuts a word where letters end and punctuation begins, so a word is
    encoded as these two parts, of which there are fewer.
    """
    cut, plain, rest = {}, set(), set()
    for w in words:
        m = _PARTS.fullmatch(w)
        head, tail = (m[1].decode(), m[2].decode()) if m else (w.decode(), "")
        simple = head.isascii()
        low = head.lower() if simple else "".join([c.lower() for c in head])
        if low.isalpha() and (simple or is_normalized("NFC", head)):
            head = low
            plain.add(low)
        else:  # anything else is encoded as it stands
            head, tail = w.decode(), ""
            rest.add(head)
        if tail:
            rest.add(tail)
        cut[w] = head, tail
    fresh = {p: merges.encode(p) for p in plain if p not in known} | {"": b""}
    rest = [p for p in rest if p not in known and p not in fresh]
    for p, e in zip(rest, tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
        fresh[p] = _packed(e.ids)
    out = {w: (known[a] if a in known else fresh[a]) + (known[b] if b in known else fresh[b]) for w, (a, b) in cut.items()}
    # most words never come again: those whose letters have been met before are worth their place
    _remember(words_known, {w: out[w] for w, (a, _) in cut.items() if a in known}, REMEMBERED_WORDS)
    _remember(known, fresh, REMEMBERED_PARTS)
    return out


def encode(texts: list[bytes], path: str) -> list[bytes]:
    """Each text's ids as little-endian unsigned 32-bit numbers.

    The tokenizer drops white space and no token crosses it, so words between ASCII
    white space are encoded by themselves, each distinct one once.
    """
    tokenizer, merges, known, parts = _tokenizer(path)
    split = [t.split() for t in texts]
    found = [list(map(known.get, ws)) for ws in split]
    gaps = [(ids, ws, [k for k, x in enumerate(ids) if x is None])
            for ids, ws in zip(found, split, strict=True) if None in ids]
    fresh = _encode_words({ws[k] for _, ws, at in gaps for k in at}, tokenizer, merges, known, parts)
    for ids, ws, at in gaps:
        for k in at:
            ids[k] = fresh[ws[k]]
    return [b"".join(ids) for ids in found]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's pieces of at most ``capacity`` ids, the end id included."""
    end = np.array([end_id], "<u4").tobytes()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column(1).cast(pa.binary()).to_pylist()
                rows = []
                for doc, ids in zip(part.column(0).to_pylist(), encode(texts, tokenizer), strict=True):
                    ids += end
                    for k, start in enumerate(range(0, len(ids), 4 * capacity)):
                        cut = ids[start:start + 4 * capacity]
                        rows.append((doc, k, start // 4, len(cut) // 4, zlib.crc32(cut)))
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()),
                     *[pa.array(c, pa.int64()) for c in cols[2:]]],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return src.mapInArrow(each, PIECES)


def configurations(sizes: list[int], demand: list[int], capacity: int,
                   max_columns: int = 500) -> list[tuple[tuple[int, ...], float]]:
    """(copies of each size in one sequence, times used) that cover ``demand`` with as
    few sequences as a fractional solution needs: revised simplex whose columns are
    found by a knapsack over the capacity."""
    m = len(sizes)
    most = [capacity // s for s in sizes]
    columns = [tuple(most[j] if i == j else 0 for i in range(m)) for j in range(m)]
    inverse, need = np.diag([1.0 / n for n in most]), np.array(demand, float)  # of a diagonal basis
    for _ in range(max_columns):
        price = inverse.sum(0)  # each sequence costs one
        worth, taken = np.zeros(capacity + 1), []
        for j, s in enumerate(sizes):
            if price[j] <= 1e-12:
                continue
            for _ in range(capacity // s):
                better = np.zeros(capacity + 1, bool)
                better[s:] = worth[:-s] + price[j] > worth[s:] + 1e-12
                if not better.any():
                    break
                worth = np.where(better, np.concatenate((np.zeros(s), worth[:-s])) + price[j], worth)
                taken.append((j, better))
        if worth[capacity] <= 1 + 1e-9:
            break
        column, room = np.zeros(m), capacity
        for j, better in reversed(taken):
            if better[room]:
                column[j] += 1
                room -= sizes[j]
        used, step = (inverse * need).sum(1), (inverse * column).sum(1)  # BLAS threads don't go with a JVM
        ratio = np.where(step > 1e-9, np.maximum(used, 0) / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        columns[out] = tuple(int(x) for x in column)
        pivot = inverse[out] / step[out]
        inverse = inverse - np.outer(step, pivot)
        inverse[out] = pivot
    return list(zip(columns, (inverse * need).sum(1).tolist(), strict=True))


class Plan:
    """Places for each length's ranks: rows of (length, first rank, pieces in a
    sequence, first sequence, ids already in it).

    Rounding up wastes up to a group's width for each large piece, so groups are many
    and only lengths over ``large`` of the capacity count as large: the others fill what
    is left to the last id."""

    def __init__(self, counts: dict[int, int], capacity: int, groups: int = 256, large: float = 1 / 3):
        self.capacity, self.rows, self.bins = capacity, [], 0
        self.gaps: dict[int, list[list[int]]] = {}  # room left -> runs of [first sequence, sequences]
        self.rank = dict.fromkeys(counts, 0)
        self.left = dict(counts)
        self._configure([n for n in sorted(counts, reverse=True) if capacity * large < n < capacity], groups)
        for length in sorted(self.left, reverse=True):
            self._best_fit(length)

    def _put(self, length: int, each: int, first: int, bins: int, n: int, gap: int) -> int:
        """``n`` pieces, ``each`` to a sequence, into a run whose room is ``gap``."""
        self.rows.append((length, self.rank[length], each, first, self.capacity - gap))
        self.rank[length] += n
        self.left[length] -= n
        return gap - each * length

    def _configure(self, lengths: list[int], groups: int) -> None:
        total = sum(self.left[n] for n in lengths)
        if not total:
            return
        per = -(-total // groups)
        queues, sizes, demand = [], [], []
        room = 0
        for n in lengths:  # longest first; a length may fall into several groups
            rest = self.left[n]
            while rest:
                if not room:
                    queues.append([])
                    sizes.append(n)  # rounded up to the longest
                    demand.append(0)
                    room = per
                take = min(rest, room)
                queues[-1].append([n, take])
                demand[-1] += take
                rest, room = rest - take, room - take
        for column, times in configurations(sizes, demand, self.capacity):
            times = int(times + 1e-6)
            if not times:
                continue
            runs = [(self.bins, times, self.capacity)]
            self.bins += times
            for j, copies in enumerate(column):
                for _ in range(copies):
                    runs = self._fill(runs, queues[j])
            for first, bins, gap in runs:
                self.gaps.setdefault(gap, []).append([first, bins])

    def _fill(self, runs: list[tuple[int, int, int]], queue: list[list[int]]) -> list[tuple[int, int, int]]:
        """One piece of the group for each sequence of the runs, while there are any."""
        out = []
        for first, bins, gap in runs:
            while bins and queue:
                length, n = queue[0]
                take = min(n, bins)
                out.append((first, take, self._put(length, 1, first, take, take, gap)))
                first, bins = first + take, bins - take
                queue[0][1] -= take
                if not queue[0][1]:
                    queue.pop(0)
            if bins:
                out.append((first, bins, gap))
        return out

    def _best_fit(self, length: int) -> None:
        while self.left[length]:
            n = self.left[length]
            gap = min((g for g in self.gaps if g >= length), default=0)
            if not gap:
                gap, bins = self.capacity, -(-n // (self.capacity // length))
                self.gaps[gap] = [[self.bins, bins]]
                self.bins += bins
            runs = self.gaps[gap]
            first, bins = runs.pop()
            if not runs:
                del self.gaps[gap]
            each = min(n, gap // length)
            whole = min(bins, n // each)
            rest = self._put(length, each, first, whole, each * whole, gap)
            self.gaps.setdefault(rest, []).append([first, whole])
            if bins > whole:
                self.gaps.setdefault(gap, []).append([first + whole, bins - whole])


def pack(found: DataFrame, capacity: int = 4096, groups: int = 256, large: float = 1 / 3) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a written table of pieces."""
    # bounded: a row for each length up to the capacity
    counts = {r[0]: r[1] for r in found.groupBy("length").count().collect()}
    rows = sorted(Plan(counts, capacity, groups, large).rows)
    length, rank, each, first, fill = (np.array(c, np.int64) for c in (zip(*rows, strict=True) if rows else [[]] * 5))
    step = np.int64(1) << 48
    at = length * step + rank

    @F.pandas_udf("sequence_id long, offset long")
    def place(n: pd.Series, r: pd.Series) -> pd.DataFrame:
        n, r = n.to_numpy(np.int64), r.to_numpy(np.int64)
        k = np.searchsorted(at, n * step + r, side="right") - 1
        past = r - rank[k]
        return pd.DataFrame({"sequence_id": first[k] + past // each[k],
                             "offset": fill[k] + past % each[k] * n})

    ranked = rank_in_class(found, "length", ["doc_id", "piece", "ids_crc32"])
    return (ranked.withColumn("_at", place("length", "rank"))
            .select(*found.columns, F.col("_at.sequence_id").alias("sequence_id"),
                    F.col("_at.offset").alias("offset")))


def best_fit_packing(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1,
                     groups: int = 256, large: float = 1 / 3,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``,
    ``sequence_id``, ``offset``."""
    found = written(pieces(docs, tokenizer, capacity, end_id, id_col, text_col), "pieces")
    return pack(found, capacity, groups, large)

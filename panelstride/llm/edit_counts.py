"""Token counts that follow edits: a segment tree of pre-tokens for each document.

The tokenizer's pattern cuts a text into pre-tokens and each pre-token is encoded by
itself, so a document's count is a sum. The tree's leaves are runs of pre-tokens with
their characters, tokens and pre-tokens; every inner node holds the sums of its two
children. An edit descends by characters to the leaves it touches, cuts and encodes
only these and, for context, whatever follows until the new cuts fall on the old end
of a leaf again; then only the sums above the touched leaves change.

Trees are columns of a table (three arrays), so they can be stored and edited later.

Defined results: null text counts as empty (no tokens); positions and lengths count
code points; an edit that begins or ends outside the text is moved to its end; null
edits and null replacements insert nothing; edits apply one after the other; a null
id is kept; repeated rows are counted each; an empty table gives no rows; further
columns of the input are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelstride.llm.common import text_of

#: How far behind a pre-token's end its cut may depend on the text.
LOOKAHEAD = 2
#: Pre-tokens that one worker process remembers the length of.
REMEMBERED = 400_000


class Counter(dict):
    """Pre-token -> number of tokens, remembered up to a bound."""

    def __init__(self, ranks_path: str, pattern: str):
        super().__init__()
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encode = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks,
                                        special_tokens={}).encode_ordinary
        self.pattern = regex.compile(pattern)

    def __missing__(self, pre_token: str) -> int:
        n = len(self.encode(pre_token))
        if len(self) < REMEMBERED:
            self[pre_token] = n
        return n


_counters: dict[tuple[str, str], Counter] = {}


def counter(ranks_path: str, pattern: str) -> Counter:
    key = (ranks_path, pattern)
    if key not in _counters:
        _counters[key] = Counter(ranks_path, pattern)
    return _counters[key]


class Tree:
    """Sums of characters, tokens and pre-tokens; node ``k`` has the children ``2k``
    and ``2k + 1``, the leaves are the second half."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray, pre_tokens: np.ndarray):
        self.sums = np.stack([chars, tokens, pre_tokens])

    @classmethod
    def build(cls, text: str, count: Counter, leaf: int = 64) -> Tree:
        found = count.pattern.findall(text)
        chars = np.fromiter(map(len, found), np.int64, len(found))
        tokens = np.array([count[p] for p in found], np.int64)
        starts = np.arange(0, len(found), leaf)
        leaves = max(1, 1 << max(0, len(starts) - 1).bit_length())
        sums = np.zeros((3, 2 * leaves), np.int64)
        if len(found):
            ones = np.ones(len(found), np.int64)
            for row, values in zip(sums, (chars, tokens, ones), strict=True):
                row[leaves:leaves + len(starts)] = np.add.reduceat(values, starts)
        while leaves > 1:
            half = leaves // 2
            sums[:, half:leaves] = sums[:, leaves:2 * leaves:2] + sums[:, leaves + 1:2 * leaves:2]
            leaves = half
        return cls(*sums)

    @property
    def total(self) -> tuple[int, int, int]:
        return tuple(int(x) for x in self.sums[:, 1])

    def find(self, position: int) -> tuple[int, int]:
        """The leaf that holds the character (the last leaf behind the end), and where
        the leaf begins."""
        chars, node, begin, leaves = self.sums[0], 1, 0, self.sums.shape[1] // 2
        while node < leaves:
            node *= 2
            if position >= begin + chars[node] and begin + chars[node] < begin + chars[node // 2]:
                begin += int(chars[node])
                node += 1
        return node, begin

    def put(self, node: int, values: tuple[int, int, int]) -> None:
        more = np.array(values) - self.sums[:, node]
        while node and more.any():
            self.sums[:, node] += more
            node //= 2

    def edit(self, text: str, start: int, length: int, replacement: str, count: Counter) -> tuple[str, int]:
        """The edited text and how many pre-tokens were encoded for it."""
        start = min(max(start, 0), len(text))
        end = min(start + max(length, 0), len(text))
        new = text[:start] + replacement + text[end:]
        shift = len(new) - len(text)
        first, begin = self.find(max(0, start - LOOKAHEAD - 1))
        last, at = self.find(end)
        stop = at + int(self.sums[0, last])
        leaves = self.sums.shape[1] // 2
        chars = tokens = pre_tokens = 0
        for m in count.pattern.finditer(new, begin):
            while m.end() > stop + shift and last < 2 * leaves - 1:
                last += 1  # the cuts have not met: one leaf more
                stop += int(self.sums[0, last])
            chars += m.end() - m.start()
            tokens += count[m.group()]
            pre_tokens += 1
            if m.end() == stop + shift and m.end() >= end + shift:
                break
        for node in range(first, last + 1):
            self.put(node, (0, 0, 0))
        self.put(first, (chars, tokens, pre_tokens))
        return new, pre_tokens


TREE = "chars array<long>, tokens array<long>, pre_tokens array<long>"


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64)))


def trees(docs: DataFrame, ranks_path: str, pattern: str, leaf: int = 64, id_col: str = "doc_id",
          text_col: str = "text", keep: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id``, ``text``, the tree's arrays, and the columns of ``keep``."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"),
                      *[c.alias(name) for name, c in (keep or {}).items()])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(ranks_path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                built = [Tree.build(t, count, leaf).sums for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *[_lists([b[k] for b in built]) for k in range(3)]],
                    names=[*part.schema.names, "chars", "tokens", "pre_tokens"])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in src.schema.fields)
    return src.mapInArrow(each, f"{kept}, {TREE}")


def apply_edits(table: DataFrame, ranks_path: str, pattern: str, edits: str = "edits") -> DataFrame:
    """Edit the documents of ``trees``: column ``edits`` is an array of (start, length,
    replacement). Gives ``doc_id``, ``n_tokens`` and ``n_pre_tokens`` before,
    ``edited_*`` after, ``encoded`` (pre-tokens encoded for the edits), the edited
    ``text`` and tree."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(ranks_path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                arrays = [[np.array(x.values.to_numpy(zero_copy_only=False)) for x in part.column(k)] for k in (3, 4, 5)]
                out, built = [], []
                for doc, text, changes, *sums in zip(*[part.column(k).to_pylist() for k in range(3)], *arrays, strict=True):
                    tree, n = Tree(*sums), 0
                    before = tree.total
                    for e in changes or []:
                        if e is not None:
                            text, more = tree.edit(text, e["start"] or 0, e["length"] or 0, e["replacement"] or "", count)
                            n += more
                    out.append((doc, *before, *tree.total, n, text))
                    built.append(tree.sums)
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(c, pa.int64()) for c in cols[:8]], pa.array(cols[8], pa.string()),
                     *[_lists([b[k] for b in built]) for k in range(3)]],
                    names=[*names, "text", "chars", "tokens", "pre_tokens"])

    names = ["doc_id", "n_chars", "n_tokens", "n_pre_tokens", "edited_chars", "edited_tokens",
             "edited_pre_tokens", "encoded"]
    return table.select("doc_id", "text", edits, "chars", "tokens", "pre_tokens").mapInArrow(
        each, ", ".join(f"{n} long" for n in names) + f", text string, {TREE}")

"""Cross-tokenizer alignment by external spill counting.

Each text is encoded by a byte-level BPE (A) and a sentence piece model (B), both over a
space and the text. Where tokens of both end at one byte they are *linked* and a *group*
ends. How often two ids are linked over the whole corpus says which id of A an id of B
goes with; every document is told how many of its links are such best ones.

* One pass encodes and aligns. A link is a number, B's id before A's, so numbers sort
  side-major. A task collects links with their documents; each ``SPILL_LINKS`` of them
  are sorted, dealt to radix classes of B's id and kept as a zstd run per class: a
  directory of its pairs with their counts, and its pair-document records. A document
  is never split between runs.
* Pairs are counted by k-way heap merges of directories, some ``FAN_IN`` runs of one
  class at a time however many there are, so a pair that is everywhere is no task's
  alone; the merges' counts are summed by Spark, where a pair has one row for each merge.
  B's ids' maxima are taken from the sums.
* Linked tokens end together, so one's bytes end in the other's: there are fewer pairs
  than bytes in both vocabularies (times the ids that share bytes), whatever the corpus.
  The counts are therefore broadcast, and a second pass streams each run's records back
  to its documents, without a shuffle.

Both tokenizers are asked for words, each distinct one once while it is remembered: no
token of either crosses from a character that isn't white space to a space (checked on
B's vocabulary and A's pre-tokenizer when they are loaded; else whole texts are encoded).

Defined results: null and empty texts, and texts that the tokens of A or B don't spell
byte for byte, have no tokens, zeros everywhere and an empty digest; null ids are kept;
repeated rows count and are counted each; an empty table gives no rows; further columns
of the input are ignored.
"""

from __future__ import annotations

import heapq
import json
import os
import struct
from collections.abc import Iterable, Iterator
from hashlib import sha256
from itertools import chain, groupby, islice
from operator import itemgetter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelstride.llm.common import text_of, written

#: Links that a task holds before it spills them as a run.
SPILL_LINKS = 2_000_000
#: Documents of a run fit into so many bits.
DOC_BITS = 23
RADIX = 8
FAN_IN = 16
#: Words that one worker process remembers of late, twice, and the longest of them.
REMEMBERED, REMEMBERED_CHARS = 120_000, 40

# Fixed value: how byte-level BPE cuts a text before it merges.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_aligners: dict[tuple[str, str], Aligner] = {}


def byte_alphabet() -> dict[str, int]:
    """The printable characters that byte-level BPE writes for the 256 bytes: printable
    Latin-1 stands for itself, the others follow from U+0100 on in their order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def piece_bytes(piece: str) -> bytes:
    """A sentence piece's bytes: U+2581 is a space, ``<0xHH>`` a byte."""
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


class Aligner:
    """Both tokenizers, and what one process remembers of words."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        alphabet = byte_alphabet()
        self.a_bytes = {i: bytes([alphabet[c] for c in t]) if all(c in alphabet for c in t) else t.encode()
                        for t, i in self.a.get_vocab().items()}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [piece_bytes(p) for p in pieces]
        self.shift = max(self.a_bytes, default=0).bit_length()
        if self.shift + len(pieces).bit_length() + DOC_BITS > 63:
            raise ValueError("the vocabularies are too large")
        first = str(self.a.pre_tokenizer)
        self.by_words = (first.startswith("ByteLevel(add_prefix_space=False") and "use_regex=True" in first
                         and self.a.normalizer is None
                         and not any("▁" in p.lstrip("▁") for p in pieces))
        self.a_text, self.b_text = ([str(i) for i in range(n)] for n in (max(self.a_bytes, default=-1) + 1, len(pieces)))
        self.a_length = np.zeros(len(self.a_text), np.int64)
        self.a_length[list(self.a_bytes)] = list(map(len, self.a_bytes.values()))
        self.b_length = np.array(list(map(len, self.b_bytes)), np.int64)
        # a token's text with what may stand behind it in the list of groups
        self.texts = np.array([t + end for texts, ends in ((self.a_text, ",|"), (self.b_text, ",;\n")) for end in ends for t in texts],
                              object)
        self.fast = self._ranked(a_path) if self.by_words else None
        self.known: dict[str, tuple] = {}
        self.earlier: dict[str, tuple] = {}

    def segments(self, text: str) -> list[str]:
        """The text cut before spaces that follow anything but white space; each segment
        is without its leading space."""
        if not self.by_words:
            return [text]
        out, glued = [], []
        for w in text.split(" "):
            if glued:
                glued.append(w)
                if w and not w[-1].isspace():
                    out.append(" ".join(glued))
                    glued = []
            elif w and not w[-1].isspace():
                out.append(w)
            else:
                glued = [w]
        if glued == [""] and out:  # B has no space alone for an empty segment
            out[-1] += " "
        elif glued:
            out.append(" ".join(glued))
        return out

    def _ranked(self, a_path: str):
        """A as ranks, which encodes long texts faster; if its ids follow its merges."""
        with open(a_path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = [model["vocab"]["".join(p)] for p in pairs]
        if ids != list(range(256, 256 + len(ids))) or not all(len(self.a_bytes[i]) == 1 for i in range(256)):
            return None
        import tiktoken

        ranks = {self.a_bytes[i]: i for i in range(256 + len(ids))}
        return tiktoken.Encoding("a", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={}) if len(ranks) == 256 + len(ids) else None

    def align_many(self, segments: list[str]) -> list[tuple | None]:
        """:meth:`align` of distinct segments: those that end in no white space as one text
        of A, each by itself for B, and all groups found at once."""
        plain = [s for s in segments if s and not s[-1].isspace()] if self.fast else []
        found = dict(zip(plain, self._align_joined(plain) or [], strict=False)) if plain else {}
        rest = [s for s in segments if s not in found]
        if rest:
            a = self.a.encode_batch_fast([" " + s for s in rest], add_special_tokens=False)
            found.update(zip(rest, map(self.align, rest, [x.ids for x in a], self.b.encode(rest, num_threads=1)), strict=True))
        return [found[s] for s in segments]

    def _align_joined(self, words: list[str]) -> list[tuple] | None:
        """None if the tokens don't spell the words."""
        text = " " + " ".join(words)
        a = self.fast.encode_ordinary(text)
        b = list(chain.from_iterable(self.b.encode(words, num_threads=1)))
        want = text.encode()
        if b"".join(map(self.a_bytes.__getitem__, a)) != want or b"".join(map(self.b_bytes.__getitem__, b)) != want:
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        end_a, end_b = np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b])
        cuts = np.intersect1d(end_a, end_b, assume_unique=True)
        words_end = np.cumsum([1 + len(w.encode()) for w in words])
        last = np.searchsorted(cuts, words_end)  # each word's last group
        if last[-1] >= len(cuts) or (cuts[last] != words_end).any():
            return None
        at_a, at_b = np.searchsorted(end_a, cuts), np.searchsorted(end_b, cuts)
        links = (b[at_b] << self.shift | a[at_a]).tobytes()

        size_a, size_b = len(self.a_text), len(self.b_text)
        text_a, text_b = a.copy(), b + 2 * size_a
        text_a[at_a] += size_a  # behind a group's last token of A
        text_b[at_b] += size_b
        text_b[at_b[last]] += size_b
        order = np.argsort(np.concatenate((np.searchsorted(cuts, end_a) * 2, np.searchsorted(cuts, end_b) * 2 + 1)), kind="stable")
        groups = "".join(self.texts[np.concatenate((text_a, text_b))[order]].tolist()).split("\n")
        n_a, n_b, n = (np.diff(x[last] + 1, prepend=0).tolist() for x in (at_a, at_b, np.arange(len(cuts))))
        ends = (8 * (last + 1)).tolist()
        return [(x, y, t, k, links[e - 8 * k:e]) for x, y, t, k, e in zip(n_a, n_b, groups, n, ends, strict=False)]

    def align(self, segment: str, a: list[int], b: list[int]) -> tuple | None:
        """Tokens of A and of B, groups as text, number of groups, links; None if the
        tokens don't spell the segment."""
        a_bytes, b_bytes, want = self.a_bytes, self.b_bytes, b" " + segment.encode()
        if b"".join([a_bytes[i] for i in a]) != want or b"".join([b_bytes[i] for i in b]) != want:
            return None
        a_text, b_text, n, m = self.a_text, self.b_text, len(a), len(b)
        if n == 1 or m == 1:
            text = ",".join([a_text[i] for i in a]) + "|" + ",".join([b_text[i] for i in b])
            return n, m, text, 1, struct.pack("<q", b[-1] << self.shift | a[-1])
        a_length, b_length = self.a_length, self.b_length
        groups, links, i, j, first_a, first_b = [], [], 0, 0, 0, 0
        end_a, end_b = a_length[a[0]], b_length[b[0]]
        while True:
            if end_a < end_b:
                i += 1
                end_a += a_length[a[i]]
            elif end_b < end_a:
                j += 1
                end_b += b_length[b[j]]
            else:
                i, j = i + 1, j + 1
                groups.append(",".join([a_text[x] for x in a[first_a:i]]) + "|" + ",".join([b_text[x] for x in b[first_b:j]]))
                links.append(b[j - 1] << self.shift | a[i - 1])
                if i == n:
                    break
                first_a, first_b = i, j
                end_a += a_length[a[i]]
                end_b += b_length[b[j]]
        return n, m, ";".join(groups), len(groups), struct.pack(f"<{len(links)}q", *links)

    def look_up(self, texts: list[list[str]]) -> list[list[tuple | None]]:
        """Each text's segments, aligned. Words met of late are remembered: when the memory
        is full it becomes the earlier one, from which what is met again returns."""
        known, earlier = self.known, self.earlier
        found = [list(map(known.get, segments)) for segments in texts]
        gaps = [(f, segments, [k for k, x in enumerate(f) if x is None])
                for f, segments in zip(found, texts, strict=True) if None in f]
        missing = {segments[k] for _, segments, at in gaps for k in at}
        made = {s: earlier[s] for s in missing if s in earlier}
        fresh = sorted(missing - made.keys())
        for at in range(0, len(fresh), 4096):
            part = fresh[at:at + 4096]
            made.update(zip(part, self.align_many(part), strict=True))
        for f, segments, at in gaps:
            for k in at:
                f[k] = made[segments[k]]
        if len(known) + len(made) > REMEMBERED:
            self.earlier, self.known = known, {}
            known = self.known
        room = max(0, REMEMBERED - len(known))
        known.update(islice(((s, x) for s, x in made.items() if x is not None and len(s) <= REMEMBERED_CHARS), room))
        return found


def aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


# --- runs ---------------------------------------------------------------------------


def packed(*columns: np.ndarray) -> bytes:
    """Columns of equal length as one zstd frame, byte planes apart."""
    n = len(columns[0])
    planes = b"".join([np.ascontiguousarray(c, "<i8").view(np.uint8).reshape(n, 8).T.tobytes() for c in columns])
    return zstandard.ZstdCompressor(level=3).compress(len(columns).to_bytes(2, "little") + planes)


def unpacked(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    count = int.from_bytes(raw[:2], "little")
    planes = np.frombuffer(raw, np.uint8, offset=2).reshape(count, 8, -1)
    return [np.ascontiguousarray(p.T).view("<i8").ravel() for p in planes]


def spill(links: list[bytes], rows: list[int], b_of) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """(radix class, directory, records, rows) of one run: its pairs with their counts and
    numbers of records; documents and counts by pair; the documents' row numbers."""
    sizes = [len(x) // 8 for x in links]
    every = np.frombuffer(b"".join(links), np.int64) << DOC_BITS | np.repeat(np.arange(len(rows)), sizes)
    every = np.sort(every)
    new = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1])))
    times = np.diff(np.append(new, len(every)))
    pair, doc = every[new] >> DOC_BITS, every[new] & ((1 << DOC_BITS) - 1)
    kind = b_of(pair) % RADIX
    for r in range(RADIX):
        mine = np.flatnonzero(kind == r)
        if not len(mine):
            continue
        p, d, t = pair[mine], doc[mine], times[mine]
        begin = np.flatnonzero(np.concatenate(([True], p[1:] != p[:-1])))
        step = np.diff(d, prepend=0)
        step[begin] = d[begin]  # documents ascend inside a pair
        keys = p[begin]
        yield (r, packed(np.diff(keys, prepend=0), np.add.reduceat(t, begin), np.diff(np.append(begin, len(p)))),
               packed(step, t), packed(np.diff(np.array(rows, np.int64), prepend=0)))


def directory(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (ascending), their counts and their numbers of records."""
    keys, counts, records = unpacked(blob)
    return np.cumsum(keys), counts, records


def merged(directories: Iterable[bytes]) -> Iterator[tuple[int, int]]:
    """(pair, count) in side-major order over some runs, by a heap of their heads."""
    heads = []
    for blob in directories:
        keys, counts, _ = directory(blob)
        heads.append(zip(keys.tolist(), counts.tolist(), strict=True))
    for key, same in groupby(heapq.merge(*heads), itemgetter(0)):
        yield key, sum(c for _, c in same)


RECORDS = ("row long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, "
           "radix int, directory binary, records binary, rows binary")
NAMES = [c.split()[0] for c in RECORDS.split(", ")]


def aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
            spill_links: int = SPILL_LINKS) -> DataFrame:
    """Rows of documents (``radix`` is null) and of runs (``radix`` and the rest are not)."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(a_path, b_path)
        schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                            ("n_groups", pa.int64()), ("groups_sha256", pa.string()), ("radix", pa.int32()),
                            ("directory", pa.binary()), ("records", pa.binary()), ("rows", pa.binary())])
        links, rows, held = [], [], 0

        def out(table: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(dict(zip(NAMES, map(list, zip(*table, strict=True)), strict=True)), schema)

        def runs() -> Iterator[pa.RecordBatch]:
            for r, pairs, records, ids in spill(links, rows, lambda p: p >> both.shift):
                yield out([(rows[0], None, None, None, None, None, r, pairs, records, ids)])

        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                texts = part.column(2).to_pylist()
                found = both.look_up([both.segments(t) if t else [] for t in texts])
                table = []
                for row, doc, parts in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), found, strict=True):
                    if not parts or None in parts:
                        table.append((row, doc, 0, 0, 0, "", None, None, None, None))
                        continue
                    n_a, n_b, groups, n, mine = zip(*parts, strict=True)
                    table.append((row, doc, sum(n_a), sum(n_b), sum(n), sha256(";".join(groups).encode()).hexdigest(),
                                  None, None, None, None))
                    links.append(b"".join(mine))
                    rows.append(row)
                    held += sum(n)
                    if held >= spill_links or len(rows) >> DOC_BITS:
                        yield from runs()
                        links, rows, held = [], [], 0
                yield out(table)
        if rows:
            yield from runs()

    src = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                      text_of(text_col).alias("text"))
    return src.mapInArrow(each, RECORDS)


def pair_counts(runs: DataFrame) -> DataFrame:
    """``pair``, ``n`` over all runs: merges of about ``FAN_IN`` runs of one radix class."""
    most = runs.groupBy("radix").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    merges = max(1, -(-most // FAN_IN))

    def merge(found: pa.Table) -> pa.Table:
        pairs = list(merged(found["directory"].to_pylist()))
        keys, counts = zip(*pairs, strict=True)
        return pa.table([pa.array(keys, pa.int64()), pa.array(counts, pa.int64())], names=["pair", "n"])

    return (runs.select("radix", F.pmod(F.xxhash64("row"), F.lit(merges)).alias("merge"), "directory")
            .groupBy("radix", "merge").applyInArrow(lambda found: merge(found), "pair long, n long")
            .groupBy("pair").agg(F.sum("n").alias("n")))


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
          spill_links: int = SPILL_LINKS) -> DataFrame:
    """One row per document: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``,
    ``n_best``, ``count_sum``, ``groups_sha256``."""
    spark = docs.sparkSession
    found = written(aligned(docs, a_path, b_path, id_col, text_col, spill_links), "alignments")
    runs = found.where("radix IS NOT NULL")
    shift = aligner(a_path, b_path).shift
    counts = written(pair_counts(runs.select("row", "radix", "directory")), "pairs")
    best = (counts.groupBy(F.shiftright("pair", shift).alias("b")).agg(F.max("n").alias("most")))
    joined = counts.join(best, F.shiftright(counts["pair"], shift) == best["b"]).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    whole = joined.toArrow().sort_by("pair")  # bounded by the vocabularies' bytes
    table = spark.sparkContext.broadcast(tuple(whole[c].to_numpy() for c in ("pair", "n", "best")))

    def contributions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, top = table.value

        def out(rows, hits, sums):
            return pa.RecordBatch.from_arrays([pa.array(rows), pa.array(hits), pa.array(sums)],
                                              names=["row", "n_best", "count_sum"])

        run, rows = None, None
        for batch in batches:
            for k in range(batch.num_rows):  # a run's radix classes follow one another
                first, pairs_blob, records_blob, rows_blob = (batch.column(c)[k].as_py() for c in range(4))
                if first != run:
                    if run is not None:
                        yield out(rows, hits, sums)
                    run, rows = first, np.cumsum(unpacked(rows_blob)[0])
                    hits, sums = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
                keys, _, records = directory(pairs_blob)
                at = np.searchsorted(pairs, keys)
                step, times = unpacked(records_blob)
                ends = np.cumsum(records)
                total = np.cumsum(step)
                before = np.concatenate(([0], total[ends[:-1] - 1]))  # documents count anew in each pair
                doc = total - np.repeat(before, records)
                np.add.at(sums, doc, times * np.repeat(n[at], records))
                np.add.at(hits, doc, times * np.repeat(top[at], records))
        if run is not None:
            yield out(rows, hits, sums)

    back = (runs.select("row", "directory", "records", "rows")
            .mapInArrow(contributions, "row long, n_best long, count_sum long")
            .groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))
    zero = F.lit(0).cast("long")
    return (found.where("radix IS NULL").select("row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256")
            .join(back, "row", "left")
            .select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
                    F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"),
                    "groups_sha256"))

"""SimHash near-duplicates, with candidates from the pigeonring principle.

The 64 bits lie on a ring of 8 segments. If two fingerprints differ in at most
``d`` bits, then from some segment on every chain of 1, 2, ... 8 consecutive
segments differs in at most its proportional share, ``floor(length * d / 8)`` bits.
For ``d = 3`` the shares are 0 0 1 1 1 2 2 3: two segments agree exactly and of the
next three two agree, so 24 join keys of 32 exact bits find every pair; the whole
chain of shares is checked inside the join, before the Hamming distance.

Only distinct fingerprints are joined: copies, however many, are one row. In a
bucket with many fingerprints no pairs are made at all; its members meet at
fingerprints one bit from one side and two from the other, which keeps the
components the same with a fixed number of rows for each member.

Defined results: null text counts as empty; a text with no words has fingerprint
zero and links like any other; with fewer words than a shingle the whole sequence is
the only shingle; ``component_id`` is the smallest id reachable (null ids are never
smallest); repeated rows keep their own output row; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelstride.llm.common import components, text_of, written

SEGMENTS, WIDTH = 8, 8


def simhash(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of the text's word shingles, as a signed integer."""
    words = text.lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], seed) for a, b in
                       zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist(), strict=True)],
                      dtype="<u8")
    ones = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3) -> DataFrame:
    """``doc_id``, ``bits`` (signed 64-bit SimHash) of every document."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            bits = [simhash(t.as_py(), shingle) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(bits, pa.int64())], names=["doc_id", "bits"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return src.mapInArrow(each, "doc_id long, bits long")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _segments(*which: int) -> int:
    return _signed(sum(((1 << WIDTH) - 1) << WIDTH * (s % SEGMENTS) for s in set(which)))


def join_keys(distance: int) -> list[tuple[int, int]]:
    """(first segment, mask of the bits that must agree) of every join key.

    The longest chain that may differ in one bit is longer than its exact beginning
    by some segments, of which at most one differs.
    """
    share = [n * distance // SEGMENTS for n in range(1, SEGMENTS + 1)]
    exact, near = share.count(0), share.count(0) + share.count(1)
    if not exact:
        raise ValueError(f"distance must be below {SEGMENTS}")
    keys = []
    for i in range(SEGMENTS):
        head, rest = range(i, i + exact), range(i + exact, i + near)
        for some in combinations(rest, max(0, len(rest) - 1)):
            keys.append((i, _segments(*head, *some)))
    return keys


def links(nodes: DataFrame, distance: int = 3, direct_limit: int = 256) -> DataFrame:
    """Edges ``a < b`` between distinct fingerprints (column ``bits``) which have the
    same components as all pairs at Hamming distance ``distance`` or less.

    Buckets of up to ``direct_limit`` members list their pairs; larger ones meet at
    intermediate fingerprints.
    """
    spark = nodes.sparkSession
    keys = join_keys(distance)
    share = [n * distance // SEGMENTS for n in range(1, SEGMENTS + 1)]
    blocks = nodes.select("bits", F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), F.col("bits").bitwiseAND(F.lit(mask)).alias("key"))
        for k, (_, mask) in enumerate(keys)])).alias("b")).select("bits", "b.k", "b.key")
    crowded = written(blocks.groupBy("k", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    members = written(blocks.join(crowded, ["k", "key"]), "members")

    few = members.where(F.col("n") <= direct_limit)
    left = few.select("k", "key", F.col("bits").alias("a"))
    right = few.select("k", "key", F.col("bits").alias("b"))
    diff = F.col("a").bitwiseXOR(F.col("b"))

    def chain(i: int):
        ok = F.lit(True)
        for n, most in enumerate(share, 1):
            ok &= F.bit_count(diff.bitwiseAND(F.lit(_segments(*range(i, i + n))))) <= most
        return ok

    # each pair only from the first key that finds it
    first = F.coalesce(*[F.when((diff.bitwiseAND(F.lit(mask)) == 0) & chain(i), F.lit(k))
                         for k, (i, mask) in enumerate(keys)])
    pairs = (left.join(right, ["k", "key"])
             .where((F.col("a") < F.col("b")) & (F.bit_count(diff) <= distance) & (first == F.col("k")))
             .select("a", "b"))

    many = members.where(F.col("n") > direct_limit)
    if many.isEmpty():
        return pairs
    near, far = distance // 2, distance - distance // 2
    steps = []  # bounded: for each key every way to flip at most ``far`` of its free bits
    for k, (_, mask) in enumerate(keys):
        free = [p for p in range(64) if not (mask >> p) & 1]
        steps += [(k, _signed(sum(1 << p for p in some)), n)
                  for n in range(far + 1) for some in combinations(free, n)]
    flips = spark.createDataFrame(steps, "k int, flip long, n_flips int")
    met = many.join(F.broadcast(flips), "k").select(
        "k", F.col("bits").bitwiseXOR(F.col("flip")).alias("at"), "bits", "n_flips")
    hubs = (met.where(F.col("n_flips") <= near).groupBy("k", "at").agg(F.min("bits").alias("hub")))
    spokes = (met.join(written(hubs, "hubs"), ["k", "at"]).where("hub <> bits")
              .select(F.least("hub", "bits").alias("a"), F.greatest("hub", "bits").alias("b")).distinct())
    return pairs.unionByName(spokes)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, distance: int = 3, direct_limit: int = 256) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (16 hex digits),
    ``component_id`` (the smallest id that its chain of links reaches, itself included)."""
    table = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = written(table.groupBy("bits").agg(F.min("doc_id").alias("low")), "nodes")
    found = components(links(nodes.select("bits"), distance, direct_limit))
    label = nodes.join(found.withColumnRenamed("node", "bits"), "bits", "left").select(
        "bits", "low", F.coalesce("root", "bits").alias("root"))
    label = written(label, "labels")
    lowest = written(label.groupBy("root").agg(F.min("low").alias("component_id")), "lowest")
    named = written(label.join(lowest, "root").select("bits", "component_id"), "named")
    return table.join(named, "bits").select(
        "doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         **options) -> DataFrame:
    """The documents that stay, with all their columns: of each group the one with the
    smallest id. Rows without an id stay only where their whole group has none."""
    found = near_duplicates(docs, id_col, text_col, **options)
    keep = found.where(F.col("component_id").eqNullSafe(F.col("doc_id"))).select(
        F.col("doc_id").alias("_keep")).distinct()
    return docs.join(keep, F.col(id_col).eqNullSafe(F.col("_keep")), "left_semi")

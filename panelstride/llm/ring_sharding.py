"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard stands at many points of a ring. A row's key hashes to a point and the
row belongs to the next shard point clockwise; where that shard is full the row goes
on to the next one that is not. A shard takes rows of its own arcs before those that
overflow from others, and an arc's rows in the order of their keys' hashes, so where a
row ends depends on counts alone: how many rows each arc has. These counts (one for each
ring point, whatever the input) go to the driver, which lets the overflow run round the
ring and returns, for each arc, which ranks go to which shard and slot. Spark ranks
the rows inside their arc and looks the ranks up.

The key is the text: copies land on one point, have consecutive ranks, and stay together
but where a shard is full. A row's rank is its key's offset in the arc, from running
counts over distinct keys in a fixed number of ranges of the hash, plus its rank among
its copies, so other rows never change the order of an arc, however many there are. With ``slack = 0`` capacities sum up to the rows exactly, so every shard is
filled and counts differ by one at most (law ``rows``); with more slack fewer rows
overflow and fewer move when a shard is added.

Defined results: null text counts as empty text for its key and has no bytes; a null
id is kept; repeated rows are placed one by one; an empty table gives no rows; further
columns of the input are ignored.
"""

from __future__ import annotations

import math
from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelstride.llm.common import text_of, written


def ring(shards: int, points: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Sorted places of all virtual nodes and the shard of each."""
    at = {xxhash.xxh64_intdigest(f"{s}:{v}", seed) - (1 << 63): s
          for s in range(shards) for v in range(points)}
    places = sorted(at)
    return np.array(places, np.int64), np.array([at[p] for p in places], np.int64)


def capacities(total: int, shards: int, slack: float = 0.0) -> list[int]:
    """Most rows of each shard: their even share, plus ``slack`` of it."""
    if slack > 0:
        return [math.ceil((1 + slack) * total / shards)] * shards
    return [total // shards + (s < total % shards) for s in range(shards)]


def flows(counts: list[int], owner: list[int], room: list[int]) -> list[tuple[int, int, int, int]]:
    """(arc, first rank, shard, first slot) for every stretch of an arc's ranks.

    Round by round what is left of each arc is offered to the next shard point
    clockwise. A stretch ends its arc or fills its shard, so there are at most as many
    stretches as arcs and shards together.
    """
    free, used = list(room), [0] * len(room)
    rest, done, out = list(counts), [0] * len(counts), []
    arcs = len(counts)
    for step in range(arcs):
        if not any(rest):
            break
        for arc in range(arcs):
            shard = owner[(arc + step) % arcs]
            take = min(rest[arc], free[shard])
            if take:
                out.append((arc, done[arc], shard, used[shard]))
                rest[arc] -= take
                done[arc] += take
                free[shard] -= take
                used[shard] += take
    if any(rest):
        raise ValueError("the shards' capacities don't hold all rows")
    return out


def key_ranks(rows: DataFrame, starts: np.ndarray, ranges: int = 256, copies: int = 256) -> DataFrame:
    """Add ``rank``, 0-based and gapless inside each ``arc``: by key (``_key``, a signed
    hash), copies by ``doc_id``'s hash. ``rows`` is a written table.

    Keys are counted, and running counts over distinct keys are taken in ``ranges`` equal
    parts of each arc and over the parts' totals. A key with many rows is cut by the hash
    of the id into blocks of about ``copies`` rows, so no task ranks all of them.
    """
    ends = starts.astype(np.uint64)  # numbers on the ring, modulo 2 ** 64
    begins = np.roll(ends, 1) + np.uint64(1)  # an arc begins behind the point before it
    span = (ends - begins) // np.uint64(ranges) + np.uint64(1)

    @F.pandas_udf("int")
    def range_of(arc: pd.Series, key: pd.Series) -> pd.Series:
        a = arc.to_numpy(np.int64)
        return pd.Series(((key.to_numpy(np.int64).astype(np.uint64) - begins[a]) // span[a]).astype(np.int32))

    keys = written(rows.groupBy("arc", "_key").agg(F.count(F.lit(1)).alias("_n")), "keys")
    keys = written(keys.withColumn("_range", range_of("arc", "_key")), "key_ranges")
    inside = Window.partitionBy("arc", "_range").orderBy("_key")
    before = Window.partitionBy("arc").orderBy("_range")
    parts = keys.groupBy("arc", "_range").agg(F.sum("_n").alias("_m")).withColumn(
        "_past", F.sum("_m").over(before) - F.col("_m")).drop("_m")
    first = (keys.withColumn("_at", F.sum("_n").over(inside) - F.col("_n")).join(parts, ["arc", "_range"])
             .select("arc", "_key", "_n", (F.col("_past") + F.col("_at")).alias("_first")))
    first = written(first, "key_offsets")

    order = Window.partitionBy("_key", "_block").orderBy(F.xxhash64("doc_id"), "doc_id")
    cut = rows.join(first, ["arc", "_key"]).withColumn(
        "_block", F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("_n") / copies)))
    several = cut.where("_n > 1")
    blocks = (several.groupBy("_key", "_block").agg(F.count(F.lit(1)).alias("_m"))
              .withColumn("_past", F.sum("_m").over(Window.partitionBy("_key").orderBy("_block")) - F.col("_m")).drop("_m"))
    placed = (several.withColumn("_row", F.row_number().over(order) - 1).join(blocks, ["_key", "_block"])
              .withColumn("rank", F.col("_first") + F.col("_past") + F.col("_row")))
    alone = cut.where("_n = 1").withColumn("rank", F.col("_first"))
    names = [*rows.columns, "rank"]
    return alone.select(names).unionByName(placed.select(names))


def shard(docs: DataFrame, shards: int = 24, points: int = 64, slack: float = 0.0, seed: int = 0,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``size`` (bytes of the text plus 8),
    ``text_crc32``, ``arc``, ``home_shard`` (its shard if none were full), ``shard``,
    ``slot`` (gapless from 0 inside the shard)."""
    places, owner = ring(shards, points, seed)

    @F.pandas_udf("long")
    def arc_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(places, key.to_numpy(np.int64)) % len(places))

    text = text_of(text_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("_key"))
    rows = written(rows.withColumn("arc", arc_of("_key")), "rows")

    # bounded: a count for each virtual node
    found = dict(rows.groupBy("arc").count().collect())
    counts = [found.get(a, 0) for a in range(len(places))]
    plan = sorted(flows(counts, owner.tolist(), capacities(sum(counts), shards, slack)))
    stretch = np.array(plan or [(0, 0, 0, 0)], np.int64)
    begins = np.array([0, *accumulate(counts)], np.int64)  # ranks over all arcs, one after the other
    at = begins[stretch[:, 0]] + stretch[:, 1]

    @F.pandas_udf("shard int, slot long")
    def place(arc: pd.Series, rank: pd.Series) -> pd.DataFrame:
        arc, rank = arc.to_numpy(np.int64), rank.to_numpy(np.int64)
        k = np.searchsorted(at, begins[arc] + rank, side="right") - 1
        return pd.DataFrame({"shard": stretch[k, 2], "slot": stretch[k, 3] + rank - stretch[k, 1]})

    @F.pandas_udf("int")
    def home(arc: pd.Series) -> pd.Series:
        return pd.Series(owner[arc.to_numpy(np.int64)])

    ranked = key_ranks(rows, places)
    return (ranked.withColumn("_at", place("arc", "rank")).withColumn("home_shard", home("arc"))
            .select("doc_id", "size", "text_crc32", "arc", "home_shard",
                    F.col("_at.shard").alias("shard"), F.col("_at.slot").alias("slot")))

"""Helpers that several corpus operators share: tables on shared storage (``written``),
ranks inside large classes, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelstride.session import shared_table


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table on shared storage, in the session's codec."""
    return shared_table(df, name, codec=None)


def text_of(column: str = "text") -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def rank_in_class(df: DataFrame, cls: str, order: list[str], block_rows: int = 256) -> DataFrame:
    """Add ``rank``, 0-based and gapless inside each value of ``cls``.

    A class may hold any share of the rows: it is cut by hash into blocks of about
    ``block_rows`` rows, rows are numbered inside a block, and the blocks' counts
    give each block its offset. The number of classes must be bounded (its counts
    are broadcast); ``df`` is read three times and so should be a written table.
    """
    # bounded: one row for each class, which callers bound by construction
    counts = df.groupBy(cls).agg(F.count(F.lit(1)).alias("_n"))
    blocks = F.ceil(F.col("_n") / F.lit(block_rows)).cast("long")
    cut = df.join(F.broadcast(counts), cls).withColumn(
        "_block", F.pmod(F.xxhash64(*order), blocks)).drop("_n")
    before = Window.partitionBy(cls).orderBy("_block")
    offsets = (cut.groupBy(cls, "_block").agg(F.count(F.lit(1)).alias("_m"))
               .withColumn("_offset", F.sum("_m").over(before) - F.col("_m")).drop("_m"))
    inside = Window.partitionBy(cls, "_block").orderBy(*order)
    return (cut.withColumn("_row", F.row_number().over(inside))
            .join(offsets, [cls, "_block"])
            .withColumn("rank", F.col("_offset") + F.col("_row") - F.lit(1))
            .drop("_block", "_offset", "_row"))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (``a``, ``b`` of any orderable type).

    Returns ``node``, ``root`` (the smallest node of its component) for every node
    that has an edge. Alternates large-star and small-star steps (Kiveris et al.,
    2014): each is one grouped minimum, pre-aggregated before its shuffle, and a
    join. Every round is written to shared storage; it stops when a round changes
    nothing.
    """
    def stars(e: DataFrame) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = written(both.groupBy("u").agg(F.min("v").alias("_v")).select(
            "u", F.least("u", "_v").alias("low")), "lowest")  # a table, so that a hot join key can be split
        large = (both.where("v > u").join(low, "u").where("v <> low")
                 .select(F.col("low").alias("a"), F.col("v").alias("b")))
        large = written(large, "large")
        down = written(large.groupBy("b").agg(F.min("a").alias("low")), "down")
        return (large.join(down, "b")
                .select(F.col("low").alias("a"), F.explode(F.array("a", "b")).alias("b"))
                .where("a < b").distinct())

    def mark(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))"),
                     F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 31)))).first()

    current = written(edges.where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    seen = mark(current)
    for _ in range(max_rounds):
        current = written(stars(current), "edges")
        now = mark(current)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("connected components did not settle")
    roots = current.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    return current.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(roots)

"""Profiling aggregates: counts, ranges, shares, availability.

All are hash aggregates with map-side partial aggregation; results are one row
per group. Shares are computed over the already-aggregated rows (a handful of
groups), never over the input.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_table


def value_shares(df: DataFrame, col: str, by: list[str] | None = None) -> DataFrame:
    """Count and relative frequency of each value of ``col`` (within ``by`` groups).

    The counts are written once; totals are a second aggregate over them, so a column
    of very many values meets in no single task."""
    by = by or []
    counts = shared_table(df.groupBy(*by, col).agg(F.count(F.lit(1)).alias("n")), "value_counts")
    if by:
        keys = [F.col(k).alias(f"__{k}") for k in by]
        totals = counts.groupBy(*keys).agg(F.sum("n").alias("__total"))
        same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in by])
        out = counts.join(totals, same)
    else:
        out = counts.withColumn("__total", F.lit(counts.agg(F.sum("n")).first()[0]))
    return out.select(*by, col, "n", (F.col("n").cast("double") / F.col("__total")).alias("share"))


def panel_profile(df: DataFrame, entity: str = "ticker", time: str = "date") -> DataFrame:
    """Row count, column count, date range and number of distinct entities (A1, A2)."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        F.min(time).alias("first_date"),
        F.max(time).alias("last_date"),
        F.count_distinct(entity).alias("entities"),
    )


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct non-null values."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def first_available(df: DataFrame, entity: str = "ticker", time: str = "date",
                    name: str = "first_available_date") -> DataFrame:
    """First date per entity."""
    return df.groupBy(entity).agg(F.min(time).alias(name))


def availability(df: DataFrame, entity: str = "ticker", time: str = "date") -> DataFrame:
    """First date, last date and number of dated rows per entity, earliest first.

    The rows of entities are written once: the sort samples its input before it deals it
    out, and where ``df`` is grouped by entity already, ``df`` would be computed twice."""
    found = df.groupBy(entity).agg(F.min(time).alias("first_available_date"),
                                   F.max(time).alias("latest_available_date"),
                                   F.count(time).alias("observations"))
    return shared_table(found, "availability").orderBy("first_available_date", entity)

"""Time-based train / validation / test split (M1, A4, A5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_CUTS


def split_label(time: str = "date", cuts: tuple[str, str] = DEFAULT_CUTS) -> Column:
    """``train`` before the first cut, ``valid`` up to the second, ``test`` after;
    a null date belongs to none."""
    d = F.col(time)
    c1, c2 = (F.to_date(F.lit(c)) for c in cuts)
    return F.when(d < c1, "train").when(d < c2, "valid").when(d >= c2, "test")


def time_split(df: DataFrame, time: str = "date", cuts: tuple[str, str] = DEFAULT_CUTS,
               name: str = "split") -> DataFrame:
    return df.withColumn(name, split_label(time, cuts))


def split_part(df: DataFrame, part: str, time: str = "date",
               cuts: tuple[str, str] = DEFAULT_CUTS) -> DataFrame:
    """Rows of one split, as a plain date-range filter (pushes down to the scan)."""
    d = F.col(time)
    c1, c2 = (F.to_date(F.lit(c)) for c in cuts)
    cond = {"train": d < c1, "valid": (d >= c1) & (d < c2), "test": d >= c2}[part]
    return df.where(cond)


def split_sizes(df: DataFrame, time: str = "date", cuts: tuple[str, str] = DEFAULT_CUTS) -> DataFrame:
    return (time_split(df, time, cuts).where(F.col("split").isNotNull())
            .groupBy("split").agg(F.count(F.lit(1)).alias("rows")))

"""Registry of named queries: a Spark builder and (optionally) its oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: QueryFn
    sql: str | None
    doc: str


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with its oracle SQL."""

    def wrap(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, (fn.__doc__ or "").strip())
        return fn

    return wrap


def round_scaled(c, digits: int):
    """Half-away-from-zero rounding of ``c * 10^digits`` (the binary value, not its
    text), keeping the sign of a value that rounds to zero, as C's ``round`` does."""
    scale = float(10 ** digits)
    y = c * F.lit(scale)
    near = F.rint(F.abs(y))  # a half goes to the even neighbour
    up = F.when(F.abs(y) - near == 0.5, near + 1).otherwise(near)
    return F.signum(y) * up / F.lit(scale)


def round_doubles(df: DataFrame, digits: int = 6, overrides: dict[str, int] | None = None) -> DataFrame:
    """Round every DOUBLE column (the oracle compare convention), per-column overrides allowed."""
    overrides = overrides or {}
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            out.append(round_scaled(F.col(f.name), overrides.get(f.name, digits)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)

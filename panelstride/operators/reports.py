"""Report tables: latest rows, month-end resampling, rebased index, performance
summary, top-N, ranking, availability (W11-W13, J1, A6-A8, T1-T6, P15, P16, P20).

"Last row per group" is an aggregate (``max`` over a struct that leads with the
time column), which Spark pre-aggregates on the map side; the normalised index
needs the first value per entity, a window over the already-resampled rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import CLASS_LABELS, PanelColumns
from ..functions.numeric import half_even, safe_div
from ..session import shared_table

COLS = PanelColumns()


def last_per_group(df: DataFrame, group: Sequence[str], time: str) -> DataFrame:
    """The row with the greatest ``time`` in each group (ties: greatest remaining columns)."""
    rest = [c for c in df.columns if c not in group and c != time]
    picked = df.groupBy(*group).agg(F.max(F.struct(time, *rest)).alias("__row"))
    return picked.select(*group, *[F.col(f"__row.{c}").alias(c) for c in [time, *rest]]).select(*df.columns)


def latest_rows(df: DataFrame, cols: PanelColumns = COLS) -> DataFrame:
    """Latest dated row per entity (W11); rows without a date are ignored."""
    return last_per_group(df.where(F.col(cols.time).isNotNull()), [cols.entity], cols.time)


def resample(df: DataFrame, freq: str = "monthly", cols: PanelColumns = COLS,
             out: str = "plot_date") -> DataFrame:
    """``monthly``: last row per (entity, month) stamped with the month start;
    ``daily``: every row, ``plot_date`` = date (W12)."""
    if freq.lower() == "daily":
        return df.withColumn(out, F.col(cols.time))
    return _last_of_month(df, cols, out).select(*df.columns, out)


def _last_of_month(df: DataFrame, cols: PanelColumns, out: str, *more: Column) -> DataFrame:
    """The row with the greatest time of each (entity, month), with further aggregates."""
    rest = [c for c in df.columns if c not in (cols.entity, cols.time) and not c.startswith("__")]
    picked = (df.withColumn(out, F.trunc(cols.time, "MM")).groupBy(cols.entity, out)
              .agg(F.max(F.struct(cols.time, *rest)).alias("__row"), *more))
    return picked.select(cols.entity, out, *[c for c in picked.columns if c not in (cols.entity, out, "__row")],
                         *[F.col(f"__row.{c}").alias(c) for c in [cols.time, *rest]])


def _rebased_in_window(rows: DataFrame, cols: PanelColumns) -> DataFrame:
    """At most a row a month for each entity: the window is bounded by the calendar."""
    whole = (Window.partitionBy(cols.entity).orderBy("plot_date")
             .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return rows.withColumns({
        "normalized_close": safe_div(F.col(cols.price), F.first(cols.price).over(whole)) * F.lit(100.0),
        "first_available_date": F.min("__first").over(whole),
    }).drop("__first")


def entity_filter(df: DataFrame, entities, entity: str = "ticker") -> DataFrame:
    """Keep rows of the given entities (P15): a Python list becomes ``isin``; a
    DataFrame of entities becomes a left-semi join (no size assumption)."""
    if isinstance(entities, DataFrame):
        return df.join(entities.select(entity).distinct(), entity, "left_semi")
    return df.where(F.col(entity).isin(list(entities)))


def normalised_index(df: DataFrame, entities=None, freq: str = "monthly",
                     cols: PanelColumns = COLS) -> DataFrame:
    """Close rebased to 100 at each entity's first plotted row, after resampling (W13),
    with each entity's first available date (A6, J1).

    The universe filter is on the entity, so an entity's first available date in
    the filtered rows equals the one in the unfiltered data. Monthly rows (one a month
    for each entity) are finished by one window per entity, which carries the first
    date along; daily rows take the first close and date from a grouped aggregate, so
    that no window holds an entity's whole history. For that the daily rows are written
    once, with all columns they come with.
    """
    chosen = df if entities is None else entity_filter(df, entities, cols.entity)
    chosen = chosen.where(F.col(cols.time).isNotNull())
    if freq.lower() == "daily":
        rows = shared_table(chosen, "daily").withColumn("plot_date", F.col(cols.time))
        base = rows.groupBy(cols.entity).agg(F.min_by(cols.price, "plot_date").alias("__base"),
                                             F.min(cols.time).alias("first_available_date"))
        index = safe_div(F.col(cols.price), F.col("__base")) * F.lit(100.0)
        rows = rows.join(base, cols.entity).withColumn("normalized_close", index).drop("__base")
    else:
        rows = _rebased_in_window(_last_of_month(chosen, cols, "plot_date", F.min(cols.time).alias("__first")), cols)
    return (
        rows.withColumn("plot_date_str", F.date_format("plot_date", "yyyy-MM-dd"))
        .withColumn("first_available_date_str", F.date_format("first_available_date", "yyyy-MM-dd"))
    )


def performance_summary(index_df: DataFrame, cols: PanelColumns = COLS) -> DataFrame:
    """First/last per entity by plot date, total return %, half-even rounded, best first."""
    return rounded_summary(raw_summary(index_df, cols), cols)


def raw_summary(index_df: DataFrame, cols: PanelColumns = COLS) -> DataFrame:
    """The summary before rounding: rank and cut on this."""
    t = "plot_date"
    return index_df.groupBy(cols.entity).agg(
        F.min("first_available_date").alias("first_available_date"),
        F.max(t).alias("latest_date"),
        F.min_by(cols.price, t).alias("start_close"),
        F.max_by(cols.price, t).alias("latest_close"),
        F.max_by("normalized_close", t).alias("latest_normalized_index"),
    ).withColumn("total_return_pct", F.col("latest_normalized_index") - F.lit(100.0))


def rounded_summary(summary: DataFrame, cols: PanelColumns = COLS, n: int | None = None) -> DataFrame:
    """Sorted by the exact index, cut to the first ``n`` where asked, then rounded."""
    rounded = {c: half_even(c, 2) for c in
               ("start_close", "latest_close", "latest_normalized_index", "total_return_pct")}
    names = summary.columns
    kept = summary.withColumn("__exact", F.col("latest_normalized_index"))
    kept = top_n(kept, "__exact", n, cols.entity) if n else kept
    return kept.withColumns(rounded).orderBy(F.col("__exact").desc_nulls_last(), cols.entity).select(*names)


def top_n(df: DataFrame, by: str, n: int, tie: str = "ticker", ascending: bool = False) -> DataFrame:
    """First ``n`` rows by ``by`` (nulls last), ties by ``tie``."""
    key = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    return df.orderBy(key, F.col(tie)).limit(n)


def class_label(pred: str = "predicted_class") -> Column:
    expr = None
    for k, text in CLASS_LABELS.items():
        expr = (F.when(F.col(pred) == k, text) if expr is None
                else expr.when(F.col(pred) == k, text))
    return expr


def pick_universe(latest_pred: DataFrame, mode: str = "top", n: int = 20, entities: Iterable[str] = (),
                  default: int = 8, cols: PanelColumns = COLS) -> DataFrame:
    """The entities to compare (P15): ``top``: the ``n`` with the highest predicted
    probability; ``selected``: the given ones that exist, or the ``default`` highest
    where none is given; ``all``: every one."""
    chosen = list(entities)
    if mode == "top" or (mode == "selected" and not chosen):
        first = n if mode == "top" else default
        return top_n(latest_pred, "predicted_probability", first, cols.entity).select(cols.entity)
    if mode not in ("selected", "all"):
        raise ValueError(f"unknown mode {mode!r}")
    names = latest_pred.select(cols.entity).distinct()
    return names.where(F.col(cols.entity).isin(chosen)) if mode == "selected" else names


def ranking(latest_pred: DataFrame, n: int = 25, cols: PanelColumns = COLS,
            features: Iterable[str] = ("return_20d", "volatility_20d", "volume_ratio_20d")) -> DataFrame:
    """Prediction ranking: probability in %, half-even to 2 places, top ``n``."""
    out = latest_pred.select(
        cols.entity,
        F.col(cols.time).alias("latest_date"),
        F.col(cols.price).alias("latest_close"),
        half_even(F.col("predicted_probability") * F.lit(100.0), 2).alias("predicted_probability_pct"),
        "prediction_label",
        *features,
        F.col("predicted_probability").alias("__p"),
    )
    return out.orderBy(F.col("__p").desc_nulls_last(), cols.entity).limit(n).drop("__p")


def feature_pairs(df: DataFrame, features: Sequence[str], ids: Sequence[str] = ("ticker", "date"),
                  name: str = "feature", value: str = "value") -> DataFrame:
    """One row per (ids, feature) with the value as DOUBLE (P20)."""
    cast = df.select(*ids, *[F.col(f).cast("double").alias(f) for f in features])
    return cast.unpivot(list(ids), list(features), name, value)


def earliest_latest(latest: DataFrame, cols: PanelColumns = COLS) -> DataFrame:
    """Among latest rows, the entity whose latest date is earliest."""
    return latest.orderBy(F.col(cols.time).asc_nulls_last(), cols.entity).limit(1)


def preview(df: DataFrame, n: int = 10, order: Sequence[str] = ("ticker", "date")) -> DataFrame:
    """First ``n`` rows in a stated order (T1, T5): deterministic, planned as a top-N."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)

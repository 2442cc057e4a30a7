"""Look-back features, forward returns and the outperformance label.

All windows share one partitioning (entity) and one order (time) with
*row* frames, so Catalyst plans a single Exchange + Sort for the whole
feature set and stacks two Window operators on top of it: the forward fill is
folded into the look-back frames (``lag(ffill(x), k)`` is the last non-null
``x`` up to ``k`` rows back), and a second pass adds the volatility of 1-row
returns and puts the moving averages together from sums of a few rows each
(:func:`mean_of_chunks`). After the
(entity, time) dedupe of silver, a window partition holds at most one row per
calendar day of that entity, so its size is bounded by the calendar, not by
the data volume.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce
from math import gcd
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import NOTEBOOK, FeatureConfig, PanelColumns
from ..functions.numeric import ratio_minus_one, safe_div
from ..session import drop_tables_of, shared_table


Keys = tuple[str, ...] | None


def entity_window(cols: PanelColumns = PanelColumns(), keys: Keys = None):
    """Rows of one entity (or of one entity segment, ``keys``) in time order, rows of the
    same time in the order of the columns of ``cols.ties``."""
    return Window.partitionBy(*(keys or (cols.entity,))).orderBy(cols.time, *cols.ties)


def trailing(n: int, cols: PanelColumns = PanelColumns(), keys: Keys = None):
    """The last ``n`` rows up to and including the current one."""
    return entity_window(cols, keys).rowsBetween(-(n - 1), 0)


def pct_change(c: str, k: int, cols: PanelColumns = PanelColumns(), filled: str | None = None,
               keys: Keys = None) -> Column:
    """``x / x.shift(k) - 1`` per entity; ``filled`` names an already forward-filled column."""
    base = F.col(filled or c)
    return ratio_minus_one(base, F.lag(base, k).over(entity_window(cols, keys)))


def rolling_full(agg, c: str, n: int, cols: PanelColumns = PanelColumns(), keys: Keys = None) -> Column:
    """``agg`` over the trailing ``n`` rows, only where all ``n`` values are non-null."""
    w = trailing(n, cols, keys)
    return F.when(F.count(F.col(c)).over(w) == n, agg(F.col(c)).over(w))


def chunk_sum(c: str, n: int, cols: PanelColumns = PanelColumns(), keys: Keys = None) -> Column:
    """Sum over the trailing ``n`` rows, only where all ``n`` values are non-null."""
    return rolling_full(F.sum, c, n, cols, keys)


def mean_of_chunks(chunk: str, size: int, n: int, cols: PanelColumns = PanelColumns(), keys: Keys = None) -> Column:
    """Mean over the trailing ``n`` rows from a column of :func:`chunk_sum` over ``size`` of
    them: its values at this row and every ``size`` rows back. Equals :func:`rolling_full` of
    the average up to the order of the sum: nothing is subtracted, and a null in any chunk
    gives null."""
    w = entity_window(cols, keys)
    return reduce(add, [F.lag(chunk, k).over(w) if k else F.col(chunk) for k in range(0, n, size)]) / F.lit(float(n))


def chunk_size(windows: Sequence[int]) -> int | None:
    """The rows of a chunk that all ``windows`` are made of, where that saves work: a frame
    goes over all its rows for each row, a lag costs about as much as three of them."""
    size = gcd(*windows)
    lags = {k for n in windows for k in range(size, n, size)}
    return size if size + 3 * len(lags) < sum(set(windows)) else None


def forward_return(c: str, h: int, cols: PanelColumns = PanelColumns(), keys: Keys = None) -> Column:
    """``x.shift(-h) / x - 1`` per entity (no fill)."""
    return ratio_minus_one(F.lead(F.col(c), h).over(entity_window(cols, keys)), F.col(c))


def _fill_name(c: str) -> str:
    return f"__ffill_{c}"


def build_features(df: DataFrame, cfg: FeatureConfig = NOTEBOOK, segmented: bool = False,
                   segments: int | None = None) -> DataFrame:
    """Add every look-back feature, the forward returns and the label.

    Rows are not filtered here; see :func:`build_gold` for the row rules.
    Missing volume or FX input columns give null features.

    ``segmented``: whether an entity may have more rows than the calendar has days
    (raw rows without the dedupe, intraday rows). Entities are then windowed in time
    segments of bounded size (exact; see :func:`_segmented`). It is a property of the
    input that the caller states, not a matter of its size; ``segments`` sets how many
    ranges the rows are dealt to (default: the session's shuffle partitions).
    """
    cfg = cfg.with_(cols=cfg.cols.present_in(df.columns))
    if segmented:
        return _segmented(df, cfg, segments)
    return _features(df, cfg)


def _fill_columns(df: DataFrame, cfg: FeatureConfig) -> list[str]:
    c = cfg.cols
    if cfg.fill != "ffill":
        return []
    return [col for col in (c.price, c.fx, c.benchmark) if col in df.columns]


def _features(df: DataFrame, cfg: FeatureConfig, keys: Keys = None,
              prefilled: dict[str, str] | None = None) -> DataFrame:
    c = cfg.cols
    present = set(df.columns)

    fill_inline = prefilled is None and cfg.fill == "ffill"
    filled, out = (dict(prefilled), df) if prefilled is not None else ({}, df)

    def change(col: str, k: int) -> Column:
        if col not in present:
            return F.lit(None).cast("double")
        if fill_inline:
            # lag(ffill(x), k) == last non-null x up to k rows back: the fill and
            # every lag evaluate in one Window operator over the same frame order
            w = entity_window(c, keys)
            now = F.last(F.col(col), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
            back = F.last(F.col(col), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -k))
            return ratio_minus_one(now, back)
        return pct_change(col, k, c, filled.get(col), keys)

    stage2: dict[str, Column] = {}
    for k in cfg.return_periods:
        stage2[cfg.return_name(k)] = change(c.price, k)
    # ratios to a moving average: (column, the average's rows)
    averaged = {cfg.ma_ratio(n): (c.price, n) for n in cfg.ma_windows}
    if c.volume in present:
        averaged[cfg.volume_ratio] = (c.volume, cfg.volume_window)
    else:
        stage2[cfg.volume_ratio] = F.lit(None).cast("double")
    # sums of integers or decimals stay as they are; only doubles are summed in chunks
    size = chunk_size([n for _, n in averaged.values()]) if averaged else None
    chunked = {x for x, _ in averaged.values() if size and df.schema[x].dataType.typeName() == "double"}
    for name, (x, n) in averaged.items():
        if x not in chunked:
            stage2[name] = safe_div(F.col(x), rolling_full(F.avg, x, n, c, keys))
    stage2 |= {f"__sum_{x}": chunk_sum(x, size, c, keys) for x in sorted(chunked)}
    stage2[cfg.fx_return] = change(c.fx, cfg.market_period)
    stage2[cfg.benchmark_return] = change(c.benchmark, cfg.market_period)
    stage2[cfg.future_return] = forward_return(c.price, cfg.horizon, c, keys)
    stage2[cfg.future_benchmark_return] = forward_return(c.benchmark, cfg.horizon, c, keys)
    out = out.withColumns(stage2)

    one_day = cfg.return_name(1)
    if one_day not in out.columns:  # volatility is defined on 1-row returns
        out = out.withColumn(one_day, change(c.price, 1))
    out = out.withColumns({
        cfg.volatility: rolling_full(F.stddev_samp, one_day, cfg.volatility_window, c, keys),
        cfg.label: outperform_label(cfg.future_return, cfg.future_benchmark_return),
        **{name: safe_div(F.col(x), mean_of_chunks(f"__sum_{x}", size, n, c, keys))
           for name, (x, n) in averaged.items() if x in chunked},
    })
    return out.drop(*filled.values(), *[f"__sum_{x}" for x in chunked])


def halo_sizes(cfg: FeatureConfig) -> tuple[int, int]:
    """Rows of context each feature needs before and after a row."""
    back = max(max(cfg.return_periods), max(cfg.ma_windows) - 1, cfg.volume_window - 1,
               cfg.volatility_window, cfg.market_period)
    return back, cfg.horizon


def _segmented(df: DataFrame, cfg: FeatureConfig, segments: int | None = None) -> DataFrame:
    """Features for panels where one entity may hold a large share of all rows.

    1. Rows are dealt to sorted ranges of (entity, time, ties) and written: Spark's
       sampled ranges come out even, whatever share an entity or a date has. An entity's
       rows inside one range are a segment.
    2. A table of one row per segment gives the rows before it and the last known value
       of each forward-filled column; with them every row gets its position and its
       filled values, which are written once.
    3. A segment's windows need ``back`` rows before it and ``horizon`` rows behind it.
       Positions say which rows these are; an equi-join on blocks of positions brings
       them, from however many segments they lie in. Context rows are dropped at the end.

    Every result equals :func:`build_features` without segments.
    """
    c = cfg.cols
    e, order = c.entity, (c.time, *c.ties)
    back, fwd = halo_sizes(cfg)
    block = max(back, fwd, 1)
    fills = _fill_columns(df, cfg)
    filled = {f: _fill_name(f) for f in fills}

    ranges = [segments] if segments else []
    dealt = shared_table(df.repartitionByRange(*ranges, e, *order)
                         .withColumn("__seg", F.spark_partition_id()), "segments")
    keys = [e, "__seg"]
    before = Window.partitionBy(e).orderBy("__seg").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (dealt.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__size"),
        *[F.max_by(F.col(f), F.when(F.col(f).isNotNull(), F.struct(*order))).alias(f"__last_{f}") for f in fills])
        .select(F.col(e).alias("__e"), F.col("__seg").alias("__s"), "__size",
                F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start"),
                *[F.last(f"__last_{f}", ignorenulls=True).over(before).alias(f"__carry_{f}") for f in fills]))
    sizes = shared_table(sizes, "segment_sizes")
    same = F.col(e).eqNullSafe(F.col("__e")) & (F.col("__seg") == F.col("__s"))
    inside = Window.partitionBy(*keys).orderBy(*order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    rows = (dealt.withColumn("__row", F.row_number().over(inside) - 1)
            .withColumns({f"__here_{f}": F.last(F.col(f), ignorenulls=True).over(so_far) for f in fills})
            .join(sizes, same)
            .withColumns({filled[f]: F.coalesce(f"__here_{f}", f"__carry_{f}") for f in fills})
            .withColumn("__pos", F.col("__start") + F.col("__row"))
            .select(*df.columns, "__seg", "__pos", *filled.values()))
    rows = shared_table(rows, "positions")
    drop_tables_of(dealt)

    # the stretches of positions that each segment needs around it, cut into blocks
    end = F.col("__start") + F.col("__size")
    needs = (sizes.withColumn("__span", F.explode(F.array(
        F.struct((F.col("__start") - back).alias("low"), (F.col("__start") - 1).alias("high")),
        F.struct(end.alias("low"), (end + fwd - 1).alias("high")))))
        .select(F.col("__e"), F.col("__s"), F.col("__span.low").alias("__low"), F.col("__span.high").alias("__high"))
        .withColumn("__block", F.explode(F.sequence(F.floor(F.col("__low") / block), F.floor(F.col("__high") / block)))))
    context = (rows.drop("__seg").withColumn("__b", F.floor(F.col("__pos") / block))
               .join(needs, F.col(e).eqNullSafe(F.col("__e")) & (F.col("__b") == F.col("__block"))
                     & F.col("__pos").between(F.col("__low"), F.col("__high")))
               .select(*df.columns, F.col("__s").alias("__seg"), "__pos", *filled.values(), F.lit(True).alias("__ctx")))
    both = rows.withColumn("__ctx", F.lit(False)).unionByName(context)
    by_position = cfg.with_(cols=replace(c, ties=("__pos",)))
    out = _features(both, by_position, keys=(e, "__seg"), prefilled=filled).where(~F.col("__ctx"))
    new = [x for x in out.columns if x not in df.columns and not x.startswith("__")]
    return out.select(*df.columns, *new)


def outperform_label(own: str, benchmark: str) -> Column:
    """1 where the entity's forward return is strictly above the benchmark's, else 0
    (a null on either side compares false)."""
    return F.coalesce((F.col(own) > F.col(benchmark)).cast("int"), F.lit(0))


def gold_columns(df: DataFrame, cfg: FeatureConfig = NOTEBOOK) -> list[str]:
    """Base columns, then features (then ``extra_cols``), keeping only those present."""
    wanted = [*cfg.base_columns, *cfg.features, *cfg.extra_cols]
    seen, cols = set(), []
    for name in wanted:
        if name in df.columns and name not in seen:
            seen.add(name)
            cols.append(name)
    return cols


def _gold_inputs(df: DataFrame, cfg: FeatureConfig) -> list[str]:
    """Columns that gold's columns or the order of its rows depend on."""
    c = cfg.cols
    used = {c.entity, c.time, *c.ties, c.price, c.benchmark, c.fx, c.volume,
            *cfg.base_columns, *cfg.features, *cfg.extra_cols}
    return [x for x in df.columns if x in used]


def build_gold(panel: DataFrame, cfg: FeatureConfig = NOTEBOOK, segmented: bool = False,
               segments: int | None = None) -> DataFrame:
    """Silver-shaped panel -> gold table under the configured row rules.

    1. drop rows missing any ``cfg.required`` column (before features),
    2. features + label,
    3. ordered projection,
    4. ``gold_rule="all"``: every gold column non-null; ``"required"``: the
       model's feature and forward-return columns non-null. Division never
       produces inf here, so the script chain's inf pass is implied.
    """
    base = panel.na.drop(subset=[r for r in cfg.required if r in panel.columns])
    if segmented:  # its written tables can't be pruned by what is read of the result
        base = base.select(*_gold_inputs(base, cfg))
    feats = build_features(base, cfg, segmented, segments)
    gold = feats.select(*gold_columns(feats, cfg))
    if cfg.gold_rule == "all":
        return gold.na.drop(how="any")
    return gold.na.drop(subset=[r for r in cfg.model_required if r in gold.columns])

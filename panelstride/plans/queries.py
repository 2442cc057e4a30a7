"""The registered queries: one per operator of the inventory, each built from
library operators on inputs derived from the given tables, each (where SQL can
say it) paired with an independent DuckDB oracle.

Doubles are rounded to 6 places on both sides (``round_doubles`` /
``round(x, 6)``; both round ``x * 10^6`` half away from zero), except where a
column says otherwise.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.numeric import clean_numeric
from ..functions.text import (
    entity_from_filename,
    normalise_header,
    normalise_header_dictionary,
    parse_date_lenient,
    parse_day_first,
)
from ..operators import cleaning, metrics, models, profile, reports, splits, stats
from ..session import drop_tables_of, moved_table, shared_table
from ..sources import files, tables
from ..streaming import ingest as streaming
from ..operators import features as feat
from ..operators.models import LinearScorer, fit_impute_scale, score, select_best
from . import fixtures as fx
from . import pipeline
from . import oracle_sql as O
from .catalog import query, round_doubles, round_scaled

NOTEBOOK = C.NOTEBOOK
FEATURES = list(C.FEATURE_COLUMNS)
LABEL = "target_outperform_20d"
# The given tables span 1995-2001, so the fixture queries cut there; the
# library default stays at the source's 2021 / 2023 cuts.
CUTS = ("1999-01-01", "2001-01-01")
SPLIT_SQL = O.SPLIT.format(c1=CUTS[0], c2=CUTS[1])

# Fixed-coefficient scorer of the oracle fixture (not a fitted model): lets every
# step after a fit be checked exactly.
FIXED_SCORER = LinearScorer(4.0, (("price_to_ma20", -2.0), ("price_to_ma50", -2.0),
                                  ("volume_ratio_20d", 0.05)), digits=4)
# Alternative fixed scorers for the model-selection query.
ALT_SCORERS = {
    "fixed_ma": FIXED_SCORER,
    "fixed_momentum": LinearScorer(0.0, (("return_20d", 1.0),), digits=4),
    "fixed_reversal": LinearScorer(0.0, (("return_5d", -1.0), ("price_to_ma20", -1.0)), digits=4),
}


def _sql_scorer(s: LinearScorer) -> str:
    z = repr(float(s.intercept))
    for name, w in s.weights:
        z += f" + ({float(w)!r}) * {name}"
    return f"round(1 / (1 + exp(-({z}))), {s.digits})"


# ------------------------------------------------------------------ shared inputs


def gold(spark: SparkSession, sf_dir: str, cfg: C.FeatureConfig = NOTEBOOK) -> DataFrame:
    return feat.build_gold(fx.panel(spark, sf_dir), cfg)


def _segmented_gold(panel: DataFrame) -> DataFrame:
    """Gold by segments, which are written: the panel is not read again."""
    out = feat.build_gold(panel, C.LOCAL, segmented=True).select(LOCAL_COLS)
    drop_tables_of(panel)
    return out


def panel_features(spark: SparkSession, sf_dir: str, cfg: C.FeatureConfig = NOTEBOOK) -> DataFrame:
    return feat.build_features(fx.panel(spark, sf_dir), cfg)


def scored_gold(spark: SparkSession, sf_dir: str, cfg: C.FeatureConfig = NOTEBOOK) -> DataFrame:
    return score(gold(spark, sf_dir, cfg), FIXED_SCORER)


def latest_predictions_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = reports.latest_rows(gold(spark, sf_dir))
    return score(latest, FIXED_SCORER).withColumn("prediction_label", reports.class_label())


G = O.gold_ctes()
SC = f"""{G}, scored as (select *, {_sql_scorer(FIXED_SCORER)} as p from gold),
pred as (select *, case when p > 0.5 then 1 else 0 end as predicted_class, {SPLIT_SQL} as split from scored)"""
LATEST = f"""{SC}, latest as (select * from (select *, row_number() over (partition by ticker order by date desc) as rn
  from pred) where rn = 1)"""


def _r6_list(cols: list[str], keep: tuple[str, ...] = ()) -> str:
    return ", ".join(c if c in keep else O.r6(c) for c in cols)


# ------------------------------------------------------------------ gold / features

GOLD_COLS = [c.strip() for c in O.GOLD_COLS.split(",")]


@query("gold_features", f"with {G} select "
       f"{_r6_list(GOLD_COLS, ('date', 'ticker', 'target_outperform_20d'))} from gold")
def q_gold_features(spark, sf_dir):
    """Gold table under the notebook rules."""
    return round_doubles(gold(spark, sf_dir))


@query("gold_features_segmented", f"with {G} select "
       f"{_r6_list(GOLD_COLS, ('date', 'ticker', 'target_outperform_20d'))} from gold")
def q_gold_features_segmented(spark, sf_dir):
    """Gold table with the rows dealt to 64 sorted ranges, so that entities are cut into
    segments which are windowed in parallel with context rows: the path for entities of
    any size must give the same table (W1-W9)."""
    return round_doubles(feat.build_gold(fx.panel(spark, sf_dir), NOTEBOOK, segmented=True, segments=64))


@query("bronze_to_gold", f"with {G} select "
       f"{_r6_list(GOLD_COLS, ('date', 'ticker', 'target_outperform_20d'))} from gold")
def q_bronze_to_gold(spark, sf_dir):
    """The whole chain from raw text: header rule on the column names, rename, strict
    day-first dates, decimal-comma numbers, dedupe, null rule, features, gold
    (P1, P3, P4, P7, U2, P9, W1-W14, P11). Equals the gold table built from typed input."""
    bronze = cleaning.normalise_columns(fx.raw_panel(spark, sf_dir))
    silver = cleaning.build_silver(bronze)
    return round_doubles(feat.build_gold(silver, NOTEBOOK))


LOCAL_COLS = [*GOLD_COLS, "bist100", "return_1d"]
LOCAL_KEEP = ("date", "ticker", LABEL)


def _local_sql(panel: str = "panel", ctes: str = "", order: str = "date") -> str:
    return (f"with {O.PANEL}{ctes}, {O.features_cte(panel, order=order)} "
            f"select {_r6_list(LOCAL_COLS, LOCAL_KEEP)} from feat where {O.REQUIRED_NOT_NULL}")


@query("gold_features_local", _local_sql())
def q_gold_features_local(spark, sf_dir):
    """Gold rows and all columns under the script chain's rules."""
    return round_doubles(gold(spark, sf_dir, C.LOCAL).select(LOCAL_COLS))


@query("gold_local_null_benchmark", _local_sql("kept", """,
kept as (select * replace (case when day(date) % 11 = 0 then null else bist100 end as bist100) from panel
  where day(date) % 11 <> 0)"""))
def q_gold_local_null_benchmark(spark, sf_dir):
    """Rows without a benchmark go before the features are computed (P10)."""
    p = fx.panel(spark, sf_dir).withColumn("bist100", F.when(F.dayofmonth("date") % 11 != 0, F.col("bist100")))
    return round_doubles(feat.build_gold(p, C.LOCAL).select(LOCAL_COLS))


@query("gold_local_duplicates", _local_sql("twice", """,
twice as (select *, 'a' as source_file from panel union all
  select * replace (close * 1.25 as close, volume + 1 as volume), 'b' from panel where day(date) % 2 = 0)""",
       "date, source_file"))
def q_gold_local_duplicates(spark, sf_dir):
    """Two files with the same dates and no dedupe: rows of one date are in the order of
    their files, whatever the layout (P12, W1-W9)."""
    p = fx.panel(spark, sf_dir)
    more = p.where(F.dayofmonth("date") % 2 == 0).withColumns({"close": F.col("close") * 1.25, "volume": F.col("volume") + 1})
    both = p.withColumn("source_file", F.lit("a")).unionByName(more.withColumn("source_file", F.lit("b")))
    return round_doubles(_segmented_gold(both))


@query("gold_features_nofill", f"with {O.PANEL}, {O.features_cte(fill=False)}, gold as (select * from feat "
       f"where {O.REQUIRED_NOT_NULL}) select date, ticker, round(return_20d, 6) as return_20d, "
       "round(usdtry_return_20d, 6) as usdtry_return_20d from gold")
def q_gold_features_nofill(spark, sf_dir):
    """Gold rows without forward fill inside percentage changes (W2 switched off)."""
    g = gold(spark, sf_dir, C.LOCAL.with_(fill="none"))
    return round_doubles(g.select("date", "ticker", "return_20d", "usdtry_return_20d"))


FEAT = f"{O.PANEL}, {O.features_cte()}"


def _feature_query(name: str, cols: list[str], doc: str):
    @query(name, f"with {FEAT} select ticker, date, {_r6_list(cols, (LABEL,))} from feat")
    def q(spark, sf_dir):
        return round_doubles(panel_features(spark, sf_dir).select("ticker", "date", *cols))

    q.__doc__ = doc
    return q


_feature_query("returns", ["return_1d", "return_5d", "return_20d"],
               "Percentage changes over 1, 5, 20 rows on the forward-filled close (W1, W2).")
_feature_query("volatility_20d", ["volatility_20d"],
               "Rolling sample std of 1-row returns, all 20 required (W3).")
_feature_query("moving_average_ratios", ["price_to_ma20", "price_to_ma50"],
               "Close over its full-window 20/50-row moving averages (W4, W5).")
_feature_query("volume_ratio", ["volume_ratio_20d"], "Volume over its 20-row average (W6).")
_feature_query("fx_benchmark_returns", ["usdtry_return_20d", "bist100_return_20d"],
               "20-row returns of the FX and benchmark series within each entity (W7, W8).")
_feature_query("forward_returns", ["future_return_20d", "future_bist100_return_20d", LABEL],
               "Forward 20-row returns (no fill) and the outperformance label (W9, W14).")


@query("label_distribution", f"""with {G},
c as (select target_outperform_20d, count(*) as n from gold group by target_outperform_20d)
select target_outperform_20d, n, round(cast(n as double) / sum(n) over (), 6) as share from c""")
def q_label_distribution(spark, sf_dir):
    """Relative frequency of each label in gold (A3)."""
    return round_doubles(profile.value_shares(gold(spark, sf_dir), LABEL))


@query("label_distribution_all", f"""with {FEAT},
c as (select target_outperform_20d, count(*) as n from feat group by target_outperform_20d)
select target_outperform_20d, n, round(cast(n as double) / sum(n) over (), 6) as share from c""")
def q_label_distribution_all(spark, sf_dir):
    """Label shares before the gold row filter: a missing forward return counts as 0 (A3)."""
    return round_doubles(profile.value_shares(panel_features(spark, sf_dir), LABEL))


@query("label_by_split", f"""with {G},
c as (select {SPLIT_SQL} as split, target_outperform_20d, count(*) as n from gold group by all)
select split, target_outperform_20d, n, round(cast(n as double) / sum(n) over (partition by split), 6) as share
from c where split is not null""")
def q_label_by_split(spark, sf_dir):
    """Label distribution per train/valid/test split (A4)."""
    g = splits.time_split(gold(spark, sf_dir), cuts=CUTS).where(F.col("split").isNotNull())
    return round_doubles(profile.value_shares(g, LABEL, by=["split"]))


@query("split_sizes", f"with {G} select split, count(*) as rows from "
       f"(select {SPLIT_SQL} as split from gold) where split is not null group by split")
def q_split_sizes(spark, sf_dir):
    """Rows per time split (M1, A5)."""
    return splits.split_sizes(gold(spark, sf_dir), cuts=CUTS)


# ------------------------------------------------------------------ cleaning


def _header_oracle() -> tuple[str, str]:
    picks = ", ".join("'" + h.replace("'", "''") + "'" for h in fx.RAW_HEADERS)
    base = (f"with h as (select p_partkey, case when p_size % 3 = 0 then [{picks}][p_partkey % "
            f"{len(fx.RAW_HEADERS)} + 1] else concat([{picks}][p_partkey % {len(fx.RAW_HEADERS)} + 1], ' ', "
            "p_brand) end as raw_header from part)")
    generic = (f"{base} select p_partkey, raw_header, trim(regexp_replace(lower(strip_accents(replace(replace("
               "raw_header, 'ı', 'i'), 'İ', 'i'))), '[^a-z0-9]+', '_', 'g'), '_') as header from h")
    cases = " ".join("when '" + k.replace("'", "''") + f"' then '{v}'" for k, v in C.HEADER_DICTIONARY.items())
    strip = "regexp_replace(raw_header, '^[\\s\\x{00a0}]+|[\\s\\x{00a0}]+$', '', 'g')"
    dictionary = (f"{base} select p_partkey, raw_header, coalesce(case {strip} {cases} end, "
                  f"trim(regexp_replace(lower(translate({strip}, '{C.HEADER_FOLD_FROM}', "
                  f"'{C.HEADER_FOLD_TO}')), '[^a-z0-9]+', '_', 'g'), '_')) as header from h")
    return generic, dictionary


HEADER_GENERIC_SQL, HEADER_DICT_SQL = _header_oracle()


@query("normalise_header", HEADER_GENERIC_SQL)
def q_normalise_header(spark, sf_dir):
    """Generic header rule on header text: trim, i-fold, accent fold, lower, snake."""
    h = fx.header_text(spark, sf_dir)
    return h.select("p_partkey", "raw_header", normalise_header("raw_header").alias("header"))


@query("normalise_header_dictionary", HEADER_DICT_SQL)
def q_normalise_header_dictionary(spark, sf_dir):
    """Dictionary-first header rule with the pairwise letter fold fallback."""
    h = fx.header_text(spark, sf_dir)
    return h.select("p_partkey", "raw_header", normalise_header_dictionary("raw_header").alias("header"))


@query("entity_from_filename", """with f as (
  select 'customer' as origin, concat('raw/', c_mktsegment, '2011010120260422.xlsx') as file_name from customer
  union all select 'part', concat(cast(p_partkey as varchar), '.xlsx') from part),
s as (select *, regexp_replace(regexp_extract(file_name, '([^/]*)$', 1), '\\.[^.]*$', '') as stem from f)
select origin, file_name, case when regexp_extract(stem, '^([A-Z]+)', 1) = '' then stem
  else regexp_extract(stem, '^([A-Z]+)', 1) end as ticker from s""")
def q_entity_from_filename(spark, sf_dir):
    """Entity key from a file name: leading capitals of the stem, else the stem."""
    f = fx.file_names(spark, sf_dir)
    return f.select("origin", "file_name", entity_from_filename("file_name").alias("ticker"))


DATE_SQL = r"""with d as (select l_orderkey, l_linenumber, case
  when l_linenumber = 1 then strftime(l_shipdate, '%d-%m-%Y')
  when l_linenumber = 2 then strftime(l_shipdate, '%Y-%m-%d')
  when l_linenumber = 3 then strftime(l_shipdate, '%d.%m.%Y')
  when l_linenumber = 4 then concat_ws('/', day(l_shipdate), month(l_shipdate), year(l_shipdate))
  when l_linenumber = 5 and l_orderkey % 2 = 0 then strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S')
  when l_linenumber = 5 then concat(strftime(l_shipdate, '%d-%m-%Y'), ' 00:00:00')
  when l_linenumber = 6 and l_orderkey % 2 = 0 then strftime(l_shipdate, '%Y/%m/%d')
  when l_linenumber = 6 then 'n/a' else '31-31-2020' end as raw_date from lineitem),
t as (select *, regexp_extract(trim(raw_date), '^([^\sT]+)', 1) as h from d)
select l_orderkey, l_linenumber, raw_date,
  case when regexp_matches(trim(raw_date), '^\d{2}-\d{2}-\d{4}$')
    then cast(try_strptime(trim(raw_date), '%d-%m-%Y') as date) end as date_strict,
  cast(coalesce(
    case when regexp_matches(h, '^\d{2}-\d{2}-\d{4}$') then try_strptime(h, '%d-%m-%Y') end,
    case when regexp_matches(h, '^\d{2}\.\d{2}\.\d{4}$') then try_strptime(h, '%d.%m.%Y') end,
    case when regexp_matches(h, '^\d{2}/\d{2}/\d{4}$') then try_strptime(h, '%d/%m/%Y') end,
    case when regexp_matches(h, '^\d{4}-\d{2}-\d{2}$') then try_strptime(h, '%Y-%m-%d') end,
    case when regexp_matches(h, '^\d{4}/\d{2}/\d{2}$') then try_strptime(h, '%Y/%m/%d') end,
    case when regexp_matches(h, '^\d{1,2}-\d{1,2}-\d{4}$') then try_strptime(h, '%d-%m-%Y') end,
    case when regexp_matches(h, '^\d{1,2}\.\d{1,2}\.\d{4}$') then try_strptime(h, '%d.%m.%Y') end,
    case when regexp_matches(h, '^\d{1,2}/\d{1,2}/\d{4}$') then try_strptime(h, '%d/%m/%Y') end
  ) as date) as date_lenient from t"""


@query("clean_dates", DATE_SQL)
def q_clean_dates(spark, sf_dir):
    """Strict day-first parsing and lenient multi-format parsing; failures are null."""
    d = fx.date_text(spark, sf_dir)
    return d.select("l_orderkey", "l_linenumber", "raw_date",
                    parse_day_first("raw_date").alias("date_strict"),
                    parse_date_lenient("raw_date").alias("date_lenient"))


NUM_SQL = """with t as (select l_orderkey, l_linenumber, case
  when l_linenumber = 1 then replace(cast(cast(l_extendedprice as decimal(18,2)) as varchar), '.', ',')
  when l_linenumber = 2 then concat(chr(160), cast(cast(l_extendedprice as decimal(18,2)) as varchar), ' ')
  when l_linenumber = 3 then concat('1.', replace(cast(cast(l_extendedprice as decimal(18,2)) as varchar), '.', ','))
  when l_linenumber = 4 then ['nan', 'None', '12d', '1.5f', '0x1p3', '1e', '--1'][l_orderkey % 7 + 1]
  when l_linenumber = 5 then ''
  when l_linenumber = 6 then concat(chr(160), ' ', replace(cast(cast(l_extendedprice as decimal(18,2)) as varchar), '.', ','))
  else cast(cast(l_extendedprice as decimal(18,2)) as varchar) end as raw_value from lineitem),
v as (select *, try_cast(replace(replace(replace(raw_value, ',', '.'), ' ', ''), chr(160), '') as double) as x from t)
select l_orderkey, l_linenumber, raw_value, round(case when isfinite(x) and l_linenumber <> 4 then x end, 6) as value
from v"""


@query("clean_numbers", NUM_SQL)
def q_clean_numbers(spark, sf_dir):
    """Decimal-comma, padded and junk number text to DOUBLE; junk and NaN to null."""
    t = fx.bronze_number_text(spark, sf_dir)
    return round_doubles(t.select("l_orderkey", "l_linenumber", "raw_value",
                                  clean_numeric("raw_value").alias("value")))


BRONZE_T = O.BRONZE.replace("l_suppkey, l_orderkey, l_linenumber from lineitem)",
                            "l_suppkey, l_orderkey, l_linenumber from lineitem),\n"
                            "bronze_t as (select *, regexp_extract(source_file, '^([A-Z]+)', 1) as ticker from bronze)")
PARSED = f"""{BRONZE_T},
parsed as (select case when regexp_matches(trim(tarih), '^\\d{{2}}-\\d{{2}}-\\d{{4}}$')
    then cast(try_strptime(trim(tarih), '%d-%m-%Y') as date) end as date,
  try_cast(replace(replace(replace(kapanis_tl, ',', '.'), ' ', ''), chr(160), '') as double) as close,
  ticker, source_file, l_suppkey, l_orderkey, l_linenumber from bronze_t)"""


def bronze_renamed(spark, sf_dir):
    return cleaning.cast_silver(cleaning.rename_present(fx.bronze(spark, sf_dir)))


@query("rename_cast_silver", f"with {PARSED} select date, round(close, 6) as close, ticker, source_file, "
       "l_suppkey, l_orderkey, l_linenumber from parsed")
def q_rename_cast_silver(spark, sf_dir):
    """Rename bronze headers to silver names, parse day-first dates, cast numbers."""
    return round_doubles(bronze_renamed(spark, sf_dir).select(
        "date", "close", "ticker", "source_file", "l_suppkey", "l_orderkey", "l_linenumber"))


SILVER_ORDER_BY = ("source_file", "l_orderkey", "l_linenumber", "l_suppkey", "close")


@query("dedupe_silver", f"""with {PARSED},
ranked as (select *, row_number() over (partition by date, ticker order by source_file, l_orderkey,
  l_linenumber, l_suppkey, close) as rn from parsed)
select date, round(close, 6) as close, ticker, source_file, l_suppkey, l_orderkey, l_linenumber
from ranked where rn = 1 and date is not null and ticker is not null and close is not null""")
def q_dedupe_silver(spark, sf_dir):
    """Silver build: one row per (date, ticker), then drop incomplete rows."""
    silver = cleaning.build_silver(fx.bronze(spark, sf_dir), order_by=SILVER_ORDER_BY)
    return round_doubles(silver.select("date", "close", "ticker", "source_file", "l_suppkey",
                                       "l_orderkey", "l_linenumber"))


@query("dedupe_null_ties", f"""with {PARSED},
twice as (select * from parsed union all select * replace (null as close) from parsed where l_orderkey % 2 = 0),
ranked as (select *, row_number() over (partition by date, ticker order by source_file, close nulls last, l_suppkey,
  l_orderkey, l_linenumber) as rn from twice)
select date, round(close, 6) as close, ticker, source_file, l_suppkey, l_orderkey, l_linenumber
from ranked where rn = 1 and date is not null and ticker is not null and close is not null""")
def q_dedupe_null_ties(spark, sf_dir):
    """Rows that tie on the dedupe order, some without a close: the key keeps a row with
    values (U2, P9)."""
    b = fx.bronze(spark, sf_dir)
    empty = b.where(F.col("l_orderkey") % 2 == 0).withColumn("kapanis_tl", F.lit(None).cast("string"))
    silver = cleaning.build_silver(b.unionByName(empty))
    return round_doubles(silver.select("date", "close", "ticker", "source_file", "l_suppkey",
                                       "l_orderkey", "l_linenumber"))


@query("required_fields", f"with {PARSED} select date, round(close, 6) as close, ticker, l_orderkey, "
       "l_linenumber from parsed where date is not null and ticker is not null and close is not null")
def q_required_fields(spark, sf_dir):
    """Drop rows missing date, ticker or close, without dedupe."""
    kept = cleaning.drop_incomplete(bronze_renamed(spark, sf_dir), ("date", "ticker", "close"))
    return round_doubles(kept.select("date", "close", "ticker", "l_orderkey", "l_linenumber"))


@query("union_by_name", f"""with {O.BRONZE}
select tarih, kapanis_tl, source_file, l_orderkey, l_linenumber, cast(null as bigint) as l_suppkey
from bronze where l_linenumber <= 3
union all
select tarih, cast(null as varchar), source_file, l_orderkey, l_linenumber, l_suppkey
from bronze where l_linenumber > 3""")
def q_union_by_name(spark, sf_dir):
    """Stack two header layouts by name; missing columns are null."""
    b = fx.bronze(spark, sf_dir)
    first = b.where(F.col("l_linenumber") <= 3).select("tarih", "kapanis_tl", "source_file",
                                                       "l_orderkey", "l_linenumber")
    second = b.where(F.col("l_linenumber") > 3).select("l_suppkey", "source_file", "tarih",
                                                       "l_linenumber", "l_orderkey")
    return cleaning.union_all_by_name([first, second])


# ------------------------------------------------------------------ profiling


@query("panel_profile", f"with {O.PANEL} select count(*) as rows, 14 as columns, min(date) as first_date, "
       "max(date) as last_date, count(distinct ticker) as entities from panel")
def q_panel_profile(spark, sf_dir):
    """Row count, column count, date range, distinct entities of the panel (A1, A2)."""
    return profile.panel_profile(fx.panel(spark, sf_dir))


@query("gold_profile", f"with {G} select count(*) as rows, 21 as columns, min(date) as first_date, "
       "max(date) as last_date, count(distinct ticker) as entities from gold")
def q_gold_profile(spark, sf_dir):
    """The same profile of the gold table (A1, A2)."""
    return profile.panel_profile(gold(spark, sf_dir))


@query("distinct_tickers", f"with {G} select distinct ticker from gold where ticker is not null")
def q_distinct_tickers(spark, sf_dir):
    """Sorted distinct entities."""
    return profile.distinct_values(gold(spark, sf_dir), "ticker")


@query("first_available", f"with {G} select ticker, min(date) as first_available_date from gold group by ticker")
def q_first_available(spark, sf_dir):
    """First available date per entity."""
    return profile.first_available(gold(spark, sf_dir))


@query("availability", f"with {G} select ticker, min(date) as first_available_date, "
       "max(date) as latest_available_date, count(date) as observations from gold group by ticker")
def q_availability(spark, sf_dir):
    """Availability per entity: first, last date and observations."""
    return profile.availability(gold(spark, sf_dir))


# ------------------------------------------------------------------ reports

ME = f"""{G}, me as (select * from (select *, cast(date_trunc('month', date) as date) as plot_date,
  row_number() over (partition by ticker, date_trunc('month', date) order by date desc) as rn from gold) where rn = 1)"""


@query("month_end", f"with {ME} select ticker, plot_date, date, round(close, 6) as close from me")
def q_month_end(spark, sf_dir):
    """Last row per (entity, month), stamped with the month start."""
    rows = reports.resample(closes(spark, sf_dir), "monthly")
    return round_doubles(rows.select("ticker", "plot_date", "date", "close"))


def closes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the index and the month ends need of gold's rows."""
    return gold(spark, sf_dir).select("ticker", "date", "close")


def _index_sql(src: str) -> str:
    return f"""first_dates as (select ticker, min(date) as first_available_date from gold group by ticker),
idx as (select c.*, close / first_value(close) over (partition by ticker order by plot_date) * 100 as normalized_close
  from {src} c),
comp as (select idx.*, f.first_available_date, strftime(plot_date, '%Y-%m-%d') as plot_date_str,
  strftime(f.first_available_date, '%Y-%m-%d') as first_available_date_str
  from idx left join first_dates f using (ticker))"""


INDEX_COLS = ["ticker", "plot_date", "close", "normalized_close", "first_available_date", "plot_date_str",
              "first_available_date_str"]
INDEX_SQL_COLS = ("ticker, plot_date, round(close, 6) as close, round(normalized_close, 6) as normalized_close, "
                  "first_available_date, plot_date_str, first_available_date_str")
IDX_MONTHLY = f"{ME}, {_index_sql('me')}"
IDX_DAILY = f"{G}, daily as (select *, date as plot_date from gold), {_index_sql('daily')}"


@query("normalised_index_monthly", f"with {IDX_MONTHLY} select {INDEX_SQL_COLS} from comp")
def q_normalised_index_monthly(spark, sf_dir):
    """Month-end close rebased to 100 per entity, with first available dates."""
    return round_doubles(reports.normalised_index(closes(spark, sf_dir), freq="monthly").select(*INDEX_COLS))


@query("normalised_index_daily", f"with {IDX_DAILY} select {INDEX_SQL_COLS} from comp")
def q_normalised_index_daily(spark, sf_dir):
    """Daily close rebased to 100 per entity."""
    return round_doubles(reports.normalised_index(closes(spark, sf_dir), freq="daily").select(*INDEX_COLS))


SUMMARY = f"""{IDX_MONTHLY}, summ as (select ticker, min(first_available_date) as first_available_date,
  max(plot_date) as latest_date, arg_min(close, plot_date) as start_close, arg_max(close, plot_date) as latest_close,
  arg_max(normalized_close, plot_date) as latest_normalized_index from comp group by ticker),
perf as (select ticker, first_available_date, latest_date, round_even(start_close, 2) as start_close,
  round_even(latest_close, 2) as latest_close, round_even(latest_normalized_index, 2) as latest_normalized_index,
  round_even(latest_normalized_index - 100, 2) as total_return_pct, latest_normalized_index as raw_idx from summ)"""
PERF_COLS = ("ticker, first_available_date, latest_date, start_close, latest_close, latest_normalized_index, "
             "total_return_pct")


def summary_df(spark, sf_dir):
    """The summary before rounding."""
    return reports.raw_summary(reports.normalised_index(closes(spark, sf_dir), freq="monthly"))


@query("performance_summary", f"with {SUMMARY} select {PERF_COLS} from perf")
def q_performance_summary(spark, sf_dir):
    """First/last close and index per entity, total return %, half-even to 2 places."""
    return reports.performance_summary(reports.normalised_index(closes(spark, sf_dir), freq="monthly"))


@query("top_performers", f"with {SUMMARY} select {PERF_COLS} from perf "
       "order by raw_idx desc nulls last, ticker limit 20")
def q_top_performers(spark, sf_dir):
    """Top 20 entities by latest normalised index."""
    return reports.rounded_summary(summary_df(spark, sf_dir), n=20)


@query("best_performer", f"with {SUMMARY} select {PERF_COLS} from perf "
       "order by raw_idx desc nulls last, ticker limit 1")
def q_best_performer(spark, sf_dir):
    """Best historical performer (T4)."""
    return reports.rounded_summary(summary_df(spark, sf_dir), n=1)


def two_closes(spark, sf_dir, first, last) -> DataFrame:
    """Two month-ends for each supplier, with the given closes."""
    s = fx.table(spark, sf_dir, "supplier")
    days = F.array(F.struct(F.to_date(F.lit("2000-01-31")).alias("date"), first.cast("double").alias("close")),
                   F.struct(F.to_date(F.lit("2000-02-29")).alias("date"), last.cast("double").alias("close")))
    return s.select(F.col("s_name").alias("ticker"), F.explode(days).alias("x")).select("ticker", "x.date", "x.close")


@query("top_performers_close_race", """with s as (select s_name as ticker, 100 + s_suppkey * 0.00001::double as c from supplier)
select ticker, date '2000-01-31' as first_available_date, date '2000-02-01' as latest_date, 100.0::double as start_close,
  round_even(c, 2) as latest_close, round_even(c / 100 * 100, 2) as latest_normalized_index,
  round_even(c / 100 * 100 - 100, 2) as total_return_pct from s order by c desc limit 5""")
def q_top_performers_close_race(spark, sf_dir):
    """Indexes that differ only behind the rounded places: rank first, then round."""
    index = reports.normalised_index(two_closes(spark, sf_dir, F.lit(100.0), F.col("s_suppkey") * 0.00001 + 100))
    return reports.rounded_summary(reports.raw_summary(index), n=5)


@query("index_zero_base", """with s as (select s_name as ticker, case when s_suppkey % 5 = 0 then 0.0::double else 50.0::double end as a,
  s_suppkey::double as b from supplier), r as (
  select ticker, date '2000-01-31' as date, a as close, case when a <> 0 then a / a * 100 end as normalized_close from s
  union all select ticker, date '2000-02-29', b, case when a <> 0 then b / a * 100 end from s)
select ticker, date, round(close, 6) as close, round(normalized_close, 6) as normalized_close from r""")
def q_index_zero_base(spark, sf_dir):
    """A first close of zero has no index: null, not an error."""
    closes = two_closes(spark, sf_dir, F.when(F.col("s_suppkey") % 5 == 0, 0.0).otherwise(50.0), F.col("s_suppkey"))
    return round_doubles(reports.normalised_index(closes).select("ticker", "date", "close", "normalized_close"))


@query("latest_rows", f"""with {G}, l as (select *, row_number() over (partition by ticker order by date desc) as rn
from gold) select {_r6_list(GOLD_COLS, ('date', 'ticker', 'target_outperform_20d'))} from l where rn = 1""")
def q_latest_rows(spark, sf_dir):
    """Latest row per entity."""
    return round_doubles(reports.latest_rows(gold(spark, sf_dir)))


def _pairs_sql() -> str:
    parts = [f"select ticker, date, '{f}' as feature, round(cast({f} as double), 6) as value from latest"
             for f in FEATURES]
    return f"""with {G}, latest as (select * from (select *, row_number() over (partition by ticker
order by date desc) as rn from gold) where rn = 1) """ + " union all ".join(parts)


@query("latest_feature_pairs", _pairs_sql())
def q_latest_feature_pairs(spark, sf_dir):
    """Latest feature values per entity as (feature, value) rows (P20)."""
    latest = reports.latest_rows(gold(spark, sf_dir))
    return round_doubles(reports.feature_pairs(latest, FEATURES))


@query("ticker_series", f"with {G} select date, ticker, round(close, 6) as close from gold "
       "where ticker = (select min(ticker) from gold)")
def q_ticker_series(spark, sf_dir):
    """Price history of the default (first sorted) entity: a point filter."""
    g = shared_table(gold(spark, sf_dir), "gold")
    first = g.agg(F.min("ticker")).first()[0]  # one value, which is pushed into the scan below
    return round_doubles(g.where(F.col("ticker") == F.lit(first)).select("date", "ticker", "close"))


@query("universe_filter", f"""with {LATEST},
top as (select ticker from latest order by p desc, ticker limit 20)
select ticker, date, round(close, 6) as close from gold where ticker in (select ticker from top)""")
def q_universe_filter(spark, sf_dir):
    """Rows of the 20 entities with the highest latest predicted probability."""
    g = shared_table(gold(spark, sf_dir), "gold")  # read by the latest-row ranking and by the filter
    top = reports.pick_universe(score(reports.latest_rows(g), FIXED_SCORER), "top", 20)
    return round_doubles(reports.entity_filter(g, top).select("ticker", "date", "close"))


@query("universe_modes", f"""with {LATEST}, ranked as (select ticker, row_number() over (order by p desc, ticker) as r from latest)
select 'top' as mode, ticker from ranked where r <= 20 union all select 'selected_default', ticker from ranked where r <= 8
union all select 'selected', ticker from ranked where ticker in ('Supplier#000000002', 'Supplier#000000005', 'none')
union all select 'all', ticker from ranked""")
def q_universe_modes(spark, sf_dir):
    """The ways to choose the entities to compare (P15): best predicted, the default of a
    selection, given names, all."""
    latest = shared_table(score(reports.latest_rows(gold(spark, sf_dir)), FIXED_SCORER), "latest")
    picks = {"top": ("top", ()), "selected_default": ("selected", ()),
             "selected": ("selected", ("Supplier#000000002", "Supplier#000000005", "none")), "all": ("all", ())}
    return cleaning.union_all_by_name([
        reports.pick_universe(latest, mode, 20, names).select(F.lit(name).alias("mode"), "ticker")
        for name, (mode, names) in picks.items()])


# ------------------------------------------------------------------ train-fitted statistics

TRAIN = f"{G}, train as (select * from gold where date < date '{CUTS[0]}')"
LONG_TRAIN = "long_train as (" + " union all ".join(
    f"select '{f}' as feature, cast({f} as double) as value from train where {f} is not null"
    for f in FEATURES) + ")"
BIG = ("volume", "market_cap_mn_tl", "market_cap_mn_usd", "free_float_market_cap_mn_tl",
       "free_float_market_cap_mn_usd", "capital_mn_tl")


def train_df(spark, sf_dir):
    return splits.split_part(gold(spark, sf_dir), "train", cuts=CUTS)


@query("train_medians", f"with {TRAIN}, {LONG_TRAIN} select feature, round(quantile_cont(value, 0.5), 6) as value, "
       "count(*) as n from long_train group by feature")
def q_train_medians(spark, sf_dir):
    """Exact median of each feature on the training split."""
    return round_doubles(stats.exact_quantiles(train_df(spark, sf_dir), FEATURES, 0.5))


@query("train_scaling", f"with {TRAIN}, {LONG_TRAIN} select feature, "
       "case when feature in (" + ", ".join(f"'{b}'" for b in BIG) + ") then round(avg(value), 2) "
       "else round(avg(value), 6) end as mean, case when feature in (" + ", ".join(f"'{b}'" for b in BIG)
       + ") then round(stddev_pop(value), 2) else round(stddev_pop(value), 6) end as std "
       "from long_train group by feature")
def q_train_scaling(spark, sf_dir):
    """Mean and population std of each feature on the training split.

    Columns in the millions are compared at 2 places: summation order differs
    between engines in the last bits."""
    s = stats.mean_std(train_df(spark, sf_dir), FEATURES)
    big = F.col("feature").isin(list(BIG))

    def rnd(c):
        return F.when(big, round_scaled(F.col(c), 2)).otherwise(round_scaled(F.col(c), 6)).alias(c)

    return s.select("feature", rnd("mean"), rnd("std"))


@query("class_weights", f"with {TRAIN}, c as (select target_outperform_20d, count(*) as n_class from train group by all) "
       "select target_outperform_20d, n_class, round(cast(sum(n_class) over () as double) / "
       "(count(*) over () * n_class), 6) as weight from c")
def q_class_weights(spark, sf_dir):
    """Balanced class weights n / (k * n_class) on the training split."""
    return round_doubles(stats.class_weights(train_df(spark, sf_dir)))


def _impute_scale_sql() -> str:
    med = f"med as (select feature, quantile_cont(value, 0.5) as m from long_train group by feature)"
    imputed = "imp as (" + " union all ".join(
        f"select '{f}' as feature, coalesce(cast({f} as double), (select m from med where feature = '{f}')) as value "
        f"from train" for f in FEATURES) + ")"
    ms = ("ms as (select feature, avg(value) as mu, case when stddev_pop(value) > 0 then stddev_pop(value) "
          "else 1 end as sd from imp group by feature)")
    cols = ", ".join(
        f"round((coalesce(cast({f} as double), (select m from med where feature = '{f}')) - "
        f"(select mu from ms where feature = '{f}')) / (select sd from ms where feature = '{f}'), 6) as {f}"
        for f in FEATURES)
    return (f"with {TRAIN}, {LONG_TRAIN}, {med}, {imputed}, {ms} select ticker, date, {cols} "
            f"from gold where date >= date '{CUTS[1]}'")


@query("impute_scale", _impute_scale_sql())
def q_impute_scale(spark, sf_dir):
    """Median imputation and standard scaling fitted on train, applied to test (M3, M4)."""
    g = shared_table(gold(spark, sf_dir), "gold")  # read by the median, the scaling fit and the test rows
    model = fit_impute_scale(splits.split_part(g, "train", cuts=CUTS), FEATURES, impute=True, scale=True)
    test = splits.split_part(g, "test", cuts=CUTS)
    return round_doubles(model.apply(test).select("ticker", "date", *FEATURES))


# ------------------------------------------------------------------ scoring and reports on scores


@query("linear_score", f"with {SC} select ticker, date, p as predicted_probability, predicted_class from pred")
def q_linear_score(spark, sf_dir):
    """Probability and class from a coefficient table as a column expression (M9)."""
    s = scored_gold(spark, sf_dir)
    return s.select("ticker", "date", "predicted_probability", "predicted_class")


LP_COLS = "ticker, date, round(close, 6) as close, p as predicted_probability, predicted_class, " \
          "case predicted_class when 1 then 'Outperform' else 'Not Outperform' end as prediction_label"


@query("latest_predictions", f"with {LATEST} select {LP_COLS} from latest")
def q_latest_predictions(spark, sf_dir):
    """Latest row per entity, scored and labelled, highest probability first."""
    lp = latest_predictions_df(spark, sf_dir)
    out = lp.select("ticker", "date", "close", "predicted_probability", "predicted_class", "prediction_label")
    return round_doubles(out).orderBy(F.col("predicted_probability").desc_nulls_last(), "ticker")


@query("prediction_ranking", f"""with {LATEST} select ticker, date as latest_date, round(close, 6) as latest_close,
  round_even(p * 100, 2) as predicted_probability_pct,
  case predicted_class when 1 then 'Outperform' else 'Not Outperform' end as prediction_label,
  round(return_20d, 6) as return_20d, round(volatility_20d, 6) as volatility_20d,
  round(volume_ratio_20d, 6) as volume_ratio_20d from latest order by p desc, ticker limit 25""")
def q_prediction_ranking(spark, sf_dir):
    """Top-25 ranking with probability in % (half-even, 2 places) and three features."""
    r = reports.ranking(latest_predictions_df(spark, sf_dir), 25)
    return round_doubles(r, overrides={"predicted_probability_pct": 2})


@query("test_predictions", f"""with {O.PANEL}, {O.features_cte()},
gold as (select *, {_sql_scorer(FIXED_SCORER)} as p from feat where {O.ALL_GOLD_NOT_NULL} and bist100 is not null)
select date, ticker, round(close, 6) as close, round(bist100, 6) as bist100,
  round(future_return_20d, 6) as future_return_20d, round(future_bist100_return_20d, 6) as future_bist100_return_20d,
  target_outperform_20d, p as predicted_probability, case when p > 0.5 then 1 else 0 end as predicted_class,
  'fixed_ma' as model_name from gold where date >= date '{CUTS[1]}'""")
def q_test_predictions(spark, sf_dir):
    """Test-split prediction table with the benchmark level and model name."""
    g = gold(spark, sf_dir, NOTEBOOK.with_(extra_cols=("bist100",)))
    t = score(splits.split_part(g, "test", cuts=CUTS), FIXED_SCORER)
    out = t.select("date", "ticker", "close", "bist100", "future_return_20d", "future_bist100_return_20d",
                   LABEL, "predicted_probability", "predicted_class", F.lit("fixed_ma").alias("model_name"))
    return round_doubles(out)


@query("smoke_sample", f"with {LATEST} select {LP_COLS} from latest order by date, ticker limit 1")
def q_smoke_sample(spark, sf_dir):
    """Among latest rows, the entity whose latest date is earliest, scored."""
    lp = latest_predictions_df(spark, sf_dir)
    s = reports.earliest_latest(lp)
    return round_doubles(s.select("ticker", "date", "close", "predicted_probability", "predicted_class",
                                  "prediction_label"))


# ------------------------------------------------------------------ evaluation


def _split_scored(spark, sf_dir):
    s = scored_gold(spark, sf_dir).withColumnRenamed("predicted_probability", "p")
    return splits.time_split(s, cuts=CUTS).where(F.col("split").isNotNull())


@query("classification_metrics", f"""with {SC}, c as (select split,
  count(*) filter (where target_outperform_20d = 1 and predicted_class = 1) as tp,
  count(*) filter (where target_outperform_20d = 0 and predicted_class = 1) as fp,
  count(*) filter (where target_outperform_20d = 0 and predicted_class = 0) as tn,
  count(*) filter (where target_outperform_20d = 1 and predicted_class = 0) as fn, count(*) as n
  from pred where split is not null group by split)
select split, round(coalesce(cast(tp + tn as double) / nullif(n, 0), 0), 6) as accuracy,
  round(coalesce(cast(tp as double) / nullif(tp + fp, 0), 0), 6) as precision,
  round(coalesce(cast(tp as double) / nullif(tp + fn, 0), 0), 6) as recall,
  round(coalesce(cast(2 * tp as double) / nullif(2 * tp + fp + fn, 0), 0), 6) as f1, n as support from c""")
def q_classification_metrics(spark, sf_dir):
    """Accuracy, precision, recall, F1 per split; zero denominators give 0."""
    return round_doubles(metrics.classification_metrics(_split_scored(spark, sf_dir), by=["split"]))


@query("confusion_matrix", f"""with {SC}, a as (select * from (values (0), (1)) v(actual)),
p as (select * from (values (0), (1)) v(predicted)), sp as (select distinct split from pred where split is not null),
c as (select split, target_outperform_20d as actual, predicted_class as predicted, count(*) as n from pred
  where split is not null group by all)
select sp.split, a.actual, p.predicted, coalesce(c.n, 0) as n from sp, a, p
left join c on c.split = sp.split and c.actual = a.actual and c.predicted = p.predicted""")
def q_confusion_matrix(spark, sf_dir):
    """2x2 confusion counts per split with zero cells kept."""
    return metrics.confusion_matrix(_split_scored(spark, sf_dir), by=["split"])


@query("classification_report", f"""with {SC}, c as (select
  count(*) filter (where target_outperform_20d = 1 and predicted_class = 1) as tp,
  count(*) filter (where target_outperform_20d = 0 and predicted_class = 1) as fp,
  count(*) filter (where target_outperform_20d = 0 and predicted_class = 0) as tn,
  count(*) filter (where target_outperform_20d = 1 and predicted_class = 0) as fn, count(*) as n
  from pred where split = 'test'),
mm as (select *, coalesce(tp / nullif(cast(tp + fp as double), 0), 0) as p1,
  coalesce(tp / nullif(cast(tp + fn as double), 0), 0) as r1,
  coalesce(2 * tp / nullif(cast(2 * tp + fp + fn as double), 0), 0) as f1,
  coalesce(tn / nullif(cast(tn + fn as double), 0), 0) as p0,
  coalesce(tn / nullif(cast(tn + fp as double), 0), 0) as r0,
  coalesce(2 * tn / nullif(cast(2 * tn + fn + fp as double), 0), 0) as f0,
  coalesce((tp + fn) / nullif(cast(n as double), 0), 0) as w1, coalesce((tn + fp) / nullif(cast(n as double), 0), 0) as w0
  from c)
select '0' as row, round(p0, 6) as precision, round(r0, 6) as recall, round(f0, 6) as f1, tn + fp as support from mm
union all select '1', round(p1, 6), round(r1, 6), round(f1, 6), tp + fn from mm
union all select 'accuracy', null, null, round(coalesce((tp + tn) / nullif(cast(n as double), 0), 0), 6), n from mm
union all select 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), n from mm
union all select 'weighted avg', round(p0 * w0 + p1 * w1, 6), round(r0 * w0 + r1 * w1, 6), round(f0 * w0 + f1 * w1, 6), n
from mm""")
def q_classification_report(spark, sf_dir):
    """Per-class report with accuracy, macro and weighted averages on the test split."""
    test = _split_scored(spark, sf_dir).where(F.col("split") == "test")
    return round_doubles(metrics.classification_report(test))


def _auc_sql(src: str, by: str | None) -> str:
    part = f"partition by {by} " if by else ""
    grp = f"{by}, " if by else ""
    return f"""ps as (select {grp}p, count(*) filter (where target_outperform_20d = 1) as pos,
  count(*) filter (where target_outperform_20d = 0) as neg from {src} where p is not null group by all),
cum as (select *, coalesce(sum(neg) over ({part}order by p rows between unbounded preceding and 1 preceding), 0) as below
  from ps),
auc as (select {grp}cast(sum(cast(pos as hugeint) * (2 * cast(below as hugeint) + neg)) as double)
  / (2.0 * cast(sum(pos) as double) * cast(sum(neg) as double)) as roc_auc from cum {'group by ' + by if by else ''})"""


@query("roc_auc", f"with {SC}, {_auc_sql('pred', None)} select round(roc_auc, 6) as roc_auc from auc")
def q_roc_auc(spark, sf_dir):
    """Exact ROC-AUC of the fixed scorer over all gold rows, ties counted half."""
    s = scored_gold(spark, sf_dir).withColumnRenamed("predicted_probability", "p")
    return round_doubles(metrics.roc_auc(s))


@query("roc_auc_by_split", f"with {SC}, {_auc_sql('pred', 'split')} select split, round(roc_auc, 6) as roc_auc "
       "from auc where split is not null")
def q_roc_auc_by_split(spark, sf_dir):
    """Exact ROC-AUC per split (A10)."""
    return round_doubles(metrics.roc_auc(_split_scored(spark, sf_dir), by=["split"]))


def _select_best_sql() -> str:
    cand = " union all ".join(
        f"select '{n}' as model, {i} as priority, target_outperform_20d, {_sql_scorer(s)} as p from valid"
        for i, (n, s) in enumerate(ALT_SCORERS.items()))
    return f"""with {G}, valid as (select * from gold where date >= date '{CUTS[0]}'
  and date < date '{CUTS[1]}'), cands as ({cand}), {_auc_sql('cands', 'model')},
ranked as (select auc.model, auc.roc_auc, c.priority from auc join (select distinct model, priority from cands) c
  using (model))
select model, round(roc_auc, 6) as validation_roc_auc from ranked order by roc_auc desc, priority limit 1"""


@query("select_best", _select_best_sql())
def q_select_best(spark, sf_dir):
    """Candidate with the best validation ROC-AUC; earlier candidate wins ties (M7, M8).

    All candidates are scored in one pass over the validation rows (one row per
    (row, candidate) via ``explode``) and their AUCs come from one grouped
    aggregate."""
    valid = splits.split_part(gold(spark, sf_dir), "valid", cuts=CUTS)
    cands = F.array(*[F.struct(F.lit(n).alias("model"), s.probability().alias("p"))
                      for n, s in ALT_SCORERS.items()])
    long = valid.select(LABEL, F.explode(cands).alias("c")).select(LABEL, "c.model", "c.p")
    table = metrics.roc_auc(long, by=["model"]).withColumnRenamed("roc_auc", "validation_roc_auc")
    return round_doubles(select_best(table, list(ALT_SCORERS)))


@query("feature_catalog", f"with {G}, long as (" + " union all ".join(
    f"select {i + 1} as position, '{f}' as feature, count({f}) as observations from gold"
    for i, f in enumerate(FEATURES)) + ") select * from long")
def q_feature_catalog(spark, sf_dir):
    """Model feature list with positions and non-null counts in gold."""
    counts = stats.per_column(gold(spark, sf_dir), FEATURES, observations=F.count)
    base = tables.scratch_path(spark, "catalog")
    tables.write_feature_catalog(spark, FEATURES, base)
    names = tables.read_feature_catalog(spark, base)
    pos = F.array_position(F.array(*map(F.lit, names)), F.col("feature")).cast("int")
    return counts.select(pos.alias("position"), "feature", "observations")


# ------------------------------------------------------------------ fitted models
#
# A fit's numbers depend on the optimiser, so these queries return properties that any
# right fit has: the rows it scores, and statements that must be true.


def _train_valid_test(spark, sf_dir, cfg=NOTEBOOK):
    # fitted, then scored: compute the windows once, and write what the models read
    g = moved_table(gold(spark, sf_dir, cfg).select("ticker", "date", *FEATURES, LABEL), "gold")
    return tuple(splits.split_part(g, p, cuts=CUTS) for p in ("train", "valid", "test"))


def _scored_properties(model, test: DataFrame) -> DataFrame:
    """Each test row's key with: is the score a probability, does the class follow it."""
    p = F.col("predicted_probability")
    return models.predict(model, test).select(
        "ticker", "date", p.between(0.0, 1.0).alias("is_probability"),
        (F.col("predicted_class") == (p > 0.5).cast("int")).alias("class_follows"))


def _facts(spark, facts: dict[str, bool]) -> DataFrame:
    return spark.createDataFrame([(k, None, bool(v), bool(v)) for k, v in facts.items()],
                                 "ticker string, date date, is_probability boolean, class_follows boolean")


def _fit_sql(facts) -> str:
    rows = " union all ".join(f"select '{f}', null, true, true" for f in facts)
    return (f"with {G} select ticker, date, true as is_probability, true as class_follows from gold "
            f"where date >= date '{CUTS[1]}' union all {rows}")


@query("fit_logistic", _fit_sql([f"gradient {f}" for f in (*FEATURES, "(intercept)")]))
def q_fit_logistic(spark, sf_dir):
    """Scaled L2 logistic regression (C = 1) fitted on train, scored on test: at the
    optimum of 1/2 |w|^2 + sum of log-losses the gradient is zero in every feature
    (M2, M4, M5, M9)."""
    train, _, test = _train_valid_test(spark, sf_dir)
    model = models.fit_candidate(train, models.NOTEBOOK_CANDIDATES[0], FEATURES)
    lr = model.stages[-1]
    scored = model.transform(train)
    miss = vector_to_array("__prob")[1] - F.col(LABEL)
    inputs = [F.col(f"{f}__in") for f in FEATURES] + [F.lit(1.0)]
    sums = scored.agg(F.count(F.lit(1)).alias("n"), *[F.sum(miss * x).alias(f"g{i}") for i, x in enumerate(inputs)]).first()
    penalty = [*lr.coefficients.toArray().tolist(), 0.0]
    facts = {f"gradient {f}": abs(sums[f"g{i}"] + penalty[i]) < 1e-4 * sums["n"]
             for i, f in enumerate((*FEATURES, "(intercept)"))}
    return _scored_properties(model, test).unionByName(_facts(spark, facts))


@query("fit_forest", _fit_sql(["100 trees", "depth up to 8", "sqrt features", "splits on the features"]))
def q_fit_forest(spark, sf_dir):
    """Random forest (100 trees, depth 8, sqrt features) fitted on train, scored on test (M6, M9)."""
    train, _, test = _train_valid_test(spark, sf_dir)
    model = models.fit_candidate(train, models.NOTEBOOK_CANDIDATES[1], FEATURES)
    forest = model.stages[-1]
    facts = {"100 trees": forest.getNumTrees == 100, "depth up to 8": max(t.depth for t in forest.trees) <= 8,
             "sqrt features": forest.getFeatureSubsetStrategy() == "sqrt",
             "splits on the features": forest.numFeatures == len(FEATURES) and forest.featureImportances.numNonzeros() > 0}
    return _scored_properties(model, test).unionByName(_facts(spark, facts))


def _run_sql(runs, gold_rule: str) -> str:
    """Keys of the run table; values where they are counts of the input."""
    sizes = ", ".join(f"(select count(*) from {src} where {SPLIT_SQL} = '{p}') as {p}"
                      for src in ("gold",) for p in ("train", "valid", "test"))
    params = [("model_name", "'{run}'"), ("target", f"'{LABEL}'"), ("train_rows", "train"), ("validation_rows", "valid"),
              ("test_rows", "test"), ("num_features", f"{len(FEATURES)}"), ("features", "'" + ",".join(FEATURES) + "'")]
    names = [f"{part}_{m}" for part in ("validation", "test") for m in ("accuracy", "precision", "recall", "f1", "roc_auc")]
    rows = []
    for run in runs:
        rows += [f"select '{run}' as run, 'param' as kind, '{k}' as key, cast({v.format(run=run)} as varchar) as value from n"
                 for k, v in params]
        rows += [f"select '{run}', 'metric', '{m}', 'a share' from n" for m in names]
    rows.append("select 'selection', 'param', 'best_model', 'best by validation' from n")
    return f"with {O.gold_ctes(rule=gold_rule)}, n as (select {sizes}) " + " union all ".join(rows)


def _metrics_again(result) -> dict[tuple[str, str], float]:
    """(run, metric) -> its value from the scored rows, by other formulas than the library's
    (the AUC's own query has an oracle)."""
    out = {}
    for (run, part), rows in result.scored.items():
        y, p = F.col(LABEL).cast("double"), F.col("predicted_class").cast("double")
        r = rows.agg(F.avg((y == p).cast("double")).alias("accuracy"), F.coalesce(F.try_divide(F.sum(y * p), F.sum(p)), F.lit(0.0)).alias("precision"),
                     F.coalesce(F.try_divide(F.sum(y * p), F.sum(y)), F.lit(0.0)).alias("recall")).first()
        both = r["precision"] + r["recall"]
        values = {**r.asDict(), "f1": 2 * r["precision"] * r["recall"] / both if both else 0.0,
                  "roc_auc": metrics.roc_auc(rows, LABEL, "predicted_probability").first()["roc_auc"]}
        out |= {(run, f"{part}_{k}"): v for k, v in values.items()}
    return out


def _checked_runs(result, order, tie) -> DataFrame:
    """The run table with each metric's value replaced by what it must be, if it is the
    scored rows' own metric, and the selection compared with the table of metrics."""
    best = select_best(result.metrics, order, tie).first()["model"]
    again = F.create_map(*[F.lit(x) for (run, k), v in _metrics_again(result).items() for x in (f"{run} {k}", v)])
    value = F.col("value").try_cast("double")
    right = value.between(0.0, 1.0) & (F.abs(value - F.try_element_at(again, F.concat_ws(" ", "run", "key"))) < 1e-12)
    told = (F.when((F.col("kind") == "metric") & right, "a share")
            .when((F.col("key") == "best_model") & (F.col("value") == best), "best by validation")
            .otherwise(F.col("value")))
    return result.runs.select("run", "kind", "key", told.alias("value"))


@query("run_table", _run_sql([c.name for c in models.NOTEBOOK_CANDIDATES], "all"))
def q_run_table(spark, sf_dir):
    """Fit every candidate, evaluate on valid and test, pick the best by validation AUC:
    the long run table with the selection recorded (M7, M8, M13)."""
    train, valid, test = _train_valid_test(spark, sf_dir)
    result = pipeline.train_and_select(spark, train, valid, test, models.NOTEBOOK_CANDIDATES,
                                       FEATURES, tie="first")
    return _checked_runs(result, [c.name for c in models.NOTEBOOK_CANDIDATES], "first")


@query("run_table_local", _run_sql([c.name for c in models.LOCAL_CANDIDATES], "required") + f"""
union all select 'confusion matrix', 'rows', 'test', cast(test as varchar) from n
union all select 'report', 'rows', 'test', cast(test as varchar) from n
union all select 'predictions', 'rows', 'test', cast(test as varchar) from n
union all select 'feature list', 'rows', 'names', '{",".join(FEATURES)}' from n""")
def q_run_table_local(spark, sf_dir):
    """The script chain from raw text with its own candidates (imputed, balanced, the
    later of equals): run table, and the sizes of its test tables and exports
    (M3, M5-M8, M12, M13, A11, A12, S9, S10)."""
    base = tables.scratch_path(spark, "script")
    bronze = cleaning.normalise_columns(fx.raw_panel(spark, sf_dir), rule="dictionary")
    out = pipeline.script_chain(spark, bronze, base, cuts=CUTS)
    runs = _checked_runs(out.result, [c.name for c in models.LOCAL_CANDIDATES], "last")
    names = ",".join(tables.read_feature_catalog(spark, f"{base}/feature_columns"))
    total = out.report.where("row = 'accuracy'").select("support")
    sizes = [("confusion matrix", out.confusion.agg(F.sum("n").alias("n"))), ("report", total),
             ("predictions", out.predictions.agg(F.count(F.lit(1)).alias("n")))]
    extra = [df.select(F.lit(k).alias("run"), F.lit("rows").alias("kind"), F.lit("test").alias("key"),
                       F.col(df.columns[0]).cast("string").alias("value")) for k, df in sizes]
    extra.append(spark.createDataFrame([("feature list", "rows", "names", names)], runs.schema))
    return cleaning.union_all_by_name([runs, *extra])


@query("read_write_roundtrip", f"with {G} select "
       f"{_r6_list(GOLD_COLS, ('date', 'ticker', 'target_outperform_20d'))} from gold")
def q_read_write_roundtrip(spark, sf_dir):
    """Gold through a managed table (``saveAsTable``, ``spark.table``) and a CSV export
    read back with an explicit schema; a fitted model and the feature list, saved and
    reloaded, must score every row as before, else rows are missing here (S6-S11)."""
    base = tables.scratch_path(spark, "roundtrip")
    name = f"panelstride_gold_{base.rsplit('-', 1)[-1]}"
    built = gold(spark, sf_dir)
    tables.write_table(built, name)
    drop_tables_of(built)
    try:
        back = tables.read_table(spark, name)
        tables.export_csv(back, f"{base}/gold_csv", compression="gzip")
        schema = back.schema
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    # the fit reads it twice and the scoring once: the text is parsed once
    again = shared_table(tables.read_csv(spark, f"{base}/gold_csv", schema), "gold_again")
    tables.write_feature_catalog(spark, FEATURES, f"{base}/features")
    features = tables.read_feature_catalog(spark, f"{base}/features")
    train = splits.split_part(again, "train", cuts=CUTS)
    quick = models.Candidate("quick", "logistic", max_iter=5)
    model = models.fit_candidate(train, quick, features)
    models.save_model(model, f"{base}/model")
    loaded = models.load_model(f"{base}/model")
    both = models.predict(loaded, models.predict(model, again, "p_before", "c_before"))
    same = both.where((F.col("p_before") == F.col("predicted_probability")) & (F.col("c_before") == F.col("predicted_class")))
    return round_doubles(same.select(GOLD_COLS))


@query("load_gold", f"with {G} select date, ticker, round(close, 6) as close, round(return_20d, 6) as return_20d, "
       "cast(target_outperform_20d as double) as target_outperform_20d from gold where day(date) % 7 <> 0 and day(date) % 5 <> 0")
def q_load_gold(spark, sf_dir):
    """The exported gold CSV as the serving side loads it: unreadable dates and missing
    closes are dropped (S6, P5, P9)."""
    base = tables.scratch_path(spark, "serving")
    day = F.dayofmonth("date")
    broken = gold(spark, sf_dir).withColumn("close", F.when(day % 5 != 0, F.col("close"))).withColumn(
        "date", F.when(day % 7 != 0, F.date_format("date", "yyyy-MM-dd")).otherwise("not a date"))
    tables.export_csv(broken, f"{base}/gold_csv", compression="gzip")
    drop_tables_of(broken)
    loaded = pipeline.load_gold(spark, f"{base}/gold_csv")
    return round_doubles(loaded.select("date", "ticker", "close", "return_20d", LABEL))


@query("ingest_files", f"with {BRONZE_T} select tarih, kapanis_tl, source_file, ticker, l_suppkey, l_orderkey, "
       "l_linenumber from bronze_t")
def q_ingest_files(spark, sf_dir):
    """Directory ingest: the bronze rows are written as one CSV folder per source file in
    two header layouts, then read back grouped by layout and stacked by name, with
    the entity taken from the file location (S1-S3, S5, S9, U1)."""
    b = fx.bronze(spark, sf_dir).drop("ticker")
    root = tables.scratch_path(spark, "ingest")
    first = b.where(F.col("l_linenumber") <= 3).select("source_file", "tarih", "kapanis_tl", "l_suppkey",
                                                       "l_orderkey", "l_linenumber")
    second = b.where(F.col("l_linenumber") > 3).select("source_file", "l_linenumber", "l_orderkey",
                                                       "l_suppkey", "kapanis_tl", "tarih")
    for i, part in enumerate((first, second)):
        (part.write.mode("overwrite").option("header", True)
         .partitionBy("source_file").csv(f"{root}/layout{i}"))
    got, _ = files.ingest_files(spark, root, "csv", entity_from="directory")
    return got.select("tarih", "kapanis_tl", "source_file", "ticker",
                      F.col("l_suppkey").cast("bigint").alias("l_suppkey"),
                      F.col("l_orderkey").cast("bigint").alias("l_orderkey"),
                      F.col("l_linenumber").cast("int").alias("l_linenumber"))


# Files of the workbook queries: a source file's rows in workbooks of 500 orders; every
# ninth workbook is cut off and can't be read.
WORKBOOKS = """books as (select *, l_orderkey // 500 as part,
  replace(source_file, '.xlsx', concat('_', cast(l_orderkey // 500 as varchar), '.xlsx')) as book,
  (l_orderkey // 500 + l_suppkey % 26) % 9 = 0 as broken from bronze_t)"""


@query("ingest_workbooks", f"with {BRONZE_T}, {WORKBOOKS} select tarih, kapanis_tl, book as source_file, ticker, "
       "cast(l_suppkey as varchar) as l_suppkey, cast(l_orderkey as varchar) as l_orderkey, "
       "cast(l_linenumber as varchar) as l_linenumber from books where not broken")
def q_ingest_workbooks(spark, sf_dir):
    """Workbooks written in tasks from the bronze rows, decoded in tasks and stacked by
    name; files that can't be read give no rows (S1-S4, U1)."""
    bronze, _ = files.ingest_files(spark, fx.workbooks(spark, sf_dir), "xlsx")
    return bronze.select("tarih", "kapanis_tl", "source_file", "ticker", "l_suppkey", "l_orderkey", "l_linenumber")


@query("ingest_errors", f"with {BRONZE_T}, {WORKBOOKS} select distinct book as source_file, 'BadZipFile' as kind "
       "from books where broken")
def q_ingest_errors(spark, sf_dir):
    """The files that could not be read, with the kind of error."""
    _, errors = files.ingest_files(spark, fx.workbooks(spark, sf_dir), "xlsx")
    return errors.select("source_file", F.substring_index("error", ":", 1).alias("kind"))


@query("preview_gold", f"with {G} select {_r6_list(GOLD_COLS, ('date', 'ticker', 'target_outperform_20d'))} "
       "from gold order by ticker, date limit 10")
def q_preview_gold(spark, sf_dir):
    """First rows of gold in (ticker, date) order: a deterministic preview."""
    return round_doubles(reports.preview(gold(spark, sf_dir), 10))


@query("stream_ingest", f"with {BRONZE_T} select tarih, kapanis_tl, source_file, ticker, l_suppkey, l_orderkey, "
       "l_linenumber from bronze_t")
def q_stream_ingest(spark, sf_dir):
    """The same per-source-file CSV folders picked up incrementally by a Structured
    Streaming file source into an exactly-once Parquet sink (S1, incremental)."""
    b = fx.bronze(spark, sf_dir).drop("ticker")
    root = tables.scratch_path(spark, "stream")
    cols = ["tarih", "kapanis_tl", "l_suppkey", "l_orderkey", "l_linenumber"]
    (b.select("source_file", *cols).write.mode("overwrite")
     .option("header", True).partitionBy("source_file").csv(f"{root}/landing"))
    got = streaming.ingest_available(spark, f"{root}/landing", cols, f"{root}/bronze",
                                     f"{root}/_checkpoint", entity_from="directory")
    return got.select("tarih", "kapanis_tl", "source_file", "ticker",
                      F.col("l_suppkey").cast("bigint").alias("l_suppkey"),
                      F.col("l_orderkey").cast("bigint").alias("l_orderkey"),
                      F.col("l_linenumber").cast("int").alias("l_linenumber"))


@query("clean_all_columns", f"with {O.PANEL} select strftime(date, '%d-%m-%Y') as tarih, ticker, "
       "concat(ticker, '.xlsx') as source_file, round(close, 6) as kapanis_tl, round(min_price, 6) as min_tl, round(max_price, 6) as max_tl, round(avg_price, 6) as aof_tl, round(volume, 6) as hacim_tl, round(capital_mn_tl, 6) as sermaye_mn_tl, round(usdtry, 6) as usdtry, round(bist100, 6) as bist_100, round(market_cap_mn_tl, 6) as piyasadegeri_mn_tl, round(market_cap_mn_usd, 6) as piyasadegeri_mn_usd, round(free_float_market_cap_mn_tl, 6) as halkaacik_pd_mn_tl, round(free_float_market_cap_mn_usd, 6) as halkaacik_pd_mn_usd from panel")
def q_clean_all_columns(spark, sf_dir):
    """Lenient number parsing of every column except date, entity and file name, on raw
    decimal-comma text with normalised headers (P1, P8)."""
    bronze = cleaning.normalise_columns(fx.raw_panel(spark, sf_dir))
    return round_doubles(cleaning.clean_numbers(bronze, exclude=("tarih", "ticker", "source_file")))


@query("features_missing_inputs", f"with {FEAT} select ticker, date, round(return_20d, 6) as return_20d, "
       "cast(null as double) as volume_ratio_20d, cast(null as double) as usdtry_return_20d from feat")
def q_features_missing_inputs(spark, sf_dir):
    """A panel without volume and FX columns: those features are null, the rest unchanged."""
    p = fx.panel(spark, sf_dir).drop("volume", "usdtry")
    out = feat.build_features(p, NOTEBOOK)
    return round_doubles(out.select("ticker", "date", "return_20d", "volume_ratio_20d", "usdtry_return_20d"))


@query("bronze_to_gold_local", _local_sql())
def q_bronze_to_gold_local(spark, sf_dir):
    """The script chain from raw text: dictionary-first header rule, lenient dates and
    numbers, no dedupe, benchmark required before features, required-columns gold rule
    (P2, P5, P8, P10, P12)."""
    bronze = cleaning.normalise_columns(fx.raw_panel(spark, sf_dir), rule="dictionary")
    silver = cleaning.build_silver(bronze, lenient_dates=True, deduplicate=False, required=())
    return round_doubles(_segmented_gold(silver))

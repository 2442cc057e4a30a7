"""Independent DuckDB SQL for the correctness gate.

These strings are only read by the oracle check (DuckDB over the same parquet
tables); the Spark side never runs them. They are written from the stated
semantics, not from the Spark code, so that a shared mistake is unlikely.
"""

from __future__ import annotations

# CTE list: li, s, m, fx, panel (silver-shaped daily panel)
PANEL = """
li as (select l_suppkey, cast(l_shipdate as date) as date, cast(l_extendedprice as decimal(18,2)) as p,
       cast(l_quantity as decimal(18,2)) as q, l_extendedprice / l_quantity as u from lineitem),
s as (select l_suppkey, date, cast(sum(p) as double) / cast(sum(q) as double) as close, min(u) as min_price,
      max(u) as max_price, cast(sum(p) as double) / count(*) as avg_price, cast(sum(q) as double) as volume
      from li group by l_suppkey, date),
m as (select date, cast(sum(p) as double) / cast(sum(q) as double) as bist100 from li group by date),
fx as (select cast(o_orderdate as date) as date,
       cast(sum(cast(o_totalprice as decimal(18,2))) as double) / count(*) / 100000 as usdtry
       from orders group by cast(o_orderdate as date)),
panel as (select s.date, close, min_price, max_price, avg_price, volume, s_acctbal as capital_mn_tl, usdtry, bist100,
  close * s_acctbal as market_cap_mn_tl, close * s_acctbal / usdtry as market_cap_mn_usd,
  close * s_acctbal / 2 as free_float_market_cap_mn_tl, close * s_acctbal / usdtry / 2 as free_float_market_cap_mn_usd,
  s_name as ticker
  from s join m on s.date = m.date join supplier on s_suppkey = l_suppkey left join fx on s.date = fx.date)
"""


def features_cte(source: str = "panel", fill: bool = True, name: str = "feat", order: str = "date") -> str:
    """CTE list ``{name}_f, {name}_r, {name}`` with every feature, forward return and label."""
    if fill:
        fcols = ("last_value(close ignore nulls) over up as f_close, "
                 "last_value(usdtry ignore nulls) over up as f_usdtry, "
                 "last_value(bist100 ignore nulls) over up as f_bist100")
    else:
        fcols = "close as f_close, usdtry as f_usdtry, bist100 as f_bist100"
    return f"""
{name}_f as (select *, {fcols} from {source}
  window up as (partition by ticker order by {order} rows between unbounded preceding and current row)),
{name}_r as (select *,
  f_close / nullif(lag(f_close, 1) over w, 0) - 1 as return_1d,
  f_close / nullif(lag(f_close, 5) over w, 0) - 1 as return_5d,
  f_close / nullif(lag(f_close, 20) over w, 0) - 1 as return_20d,
  f_usdtry / nullif(lag(f_usdtry, 20) over w, 0) - 1 as usdtry_return_20d,
  f_bist100 / nullif(lag(f_bist100, 20) over w, 0) - 1 as bist100_return_20d,
  lead(close, 20) over w / nullif(close, 0) - 1 as future_return_20d,
  lead(bist100, 20) over w / nullif(bist100, 0) - 1 as future_bist100_return_20d,
  close / nullif(case when count(close) over w20 = 20 then avg(close) over w20 end, 0) as price_to_ma20,
  close / nullif(case when count(close) over w50 = 50 then avg(close) over w50 end, 0) as price_to_ma50,
  volume / nullif(case when count(volume) over w20 = 20 then avg(volume) over w20 end, 0) as volume_ratio_20d
  from {name}_f
  window w as (partition by ticker order by {order}),
    w20 as (partition by ticker order by {order} rows between 19 preceding and current row),
    w50 as (partition by ticker order by {order} rows between 49 preceding and current row)),
{name} as (select *,
  case when count(return_1d) over w20 = 20 then stddev_samp(return_1d) over w20 end as volatility_20d,
  case when future_return_20d > future_bist100_return_20d then 1 else 0 end as target_outperform_20d
  from {name}_r
  window w20 as (partition by ticker order by {order} rows between 19 preceding and current row))
"""


GOLD_COLS = """date, ticker, close, future_return_20d, future_bist100_return_20d, target_outperform_20d,
  return_5d, return_20d, volatility_20d, volume_ratio_20d, price_to_ma20, price_to_ma50, usdtry_return_20d,
  bist100_return_20d, volume, usdtry, market_cap_mn_tl, market_cap_mn_usd, free_float_market_cap_mn_tl,
  free_float_market_cap_mn_usd, capital_mn_tl"""

REQUIRED_NOT_NULL = """return_5d is not null and return_20d is not null and volatility_20d is not null
  and volume_ratio_20d is not null and price_to_ma20 is not null and price_to_ma50 is not null
  and usdtry_return_20d is not null and bist100_return_20d is not null and future_return_20d is not null
  and future_bist100_return_20d is not null"""

ALL_GOLD_NOT_NULL = REQUIRED_NOT_NULL + """ and date is not null and ticker is not null and close is not null
  and volume is not null and usdtry is not null and market_cap_mn_tl is not null and market_cap_mn_usd is not null
  and free_float_market_cap_mn_tl is not null and free_float_market_cap_mn_usd is not null
  and capital_mn_tl is not null"""


def gold_ctes(fill: bool = True, rule: str = "all") -> str:
    """``PANEL`` + features + ``gold`` (notebook rule ``all`` or script rule ``required``)."""
    where = ALL_GOLD_NOT_NULL if rule == "all" else REQUIRED_NOT_NULL
    return f"""{PANEL},
{features_cte(fill=fill)},
gold as (select {GOLD_COLS} from feat where {where})"""


SPLIT = """case when date < date '{c1}' then 'train' when date < date '{c2}' then 'valid'
  when date >= date '{c2}' then 'test' end"""

BRONZE = """
bronze as (select
  case when l_linenumber = 7 then '31-31-2020' else strftime(l_shipdate, '%d-%m-%Y') end as tarih,
  replace(cast(cast(l_extendedprice as decimal(18,2)) as varchar), '.', ',') as kapanis_tl,
  concat('SUP', chr(cast(65 + l_suppkey % 26 as int)), '2011010120260422.xlsx') as source_file,
  l_suppkey, l_orderkey, l_linenumber from lineitem)
"""


def r6(col: str, alias: str | None = None, digits: int = 6) -> str:
    return f"round({col}, {digits}) as {alias or col}"

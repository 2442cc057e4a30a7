"""Window semantics: forward fill, full-window gating, shift vs fill, label, row rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelstride.config import NOTEBOOK, FeatureConfig, PanelColumns
from panelstride.operators import features as feat

D0 = dt.date(2020, 1, 1)


def frame(spark, closes, ticker="A", bench=None, fx=None, volume=None):
    rows = []
    for i, c in enumerate(closes):
        rows.append((D0 + dt.timedelta(days=i), ticker, c,
                     (bench or [100.0 + i for _ in closes])[i] if bench is not False else 100.0,
                     (fx or [1.0 + i / 100 for _ in closes])[i],
                     (volume or [10.0 for _ in closes])[i]))
    return spark.createDataFrame(rows, "date date, ticker string, close double, bist100 double, "
                                       "usdtry double, volume double")


def col(df, name):
    return [r[name] for r in df.orderBy("ticker", "date").collect()]


def test_pct_change_forward_fill(spark):
    df = frame(spark, [1.0, None, 2.0, 0.0, 4.0])
    out = feat.build_features(df, NOTEBOOK.with_(return_periods=(1,)))
    assert col(out, "return_1d") == [None, 0.0, 1.0, -1.0, None]


def test_pct_change_without_fill(spark):
    df = frame(spark, [1.0, None, 2.0, 0.0, 4.0])
    out = feat.build_features(df, NOTEBOOK.with_(return_periods=(1,), fill="none"))
    assert col(out, "return_1d") == [None, None, None, -1.0, None]


def test_rolling_requires_full_window(spark):
    df = spark.createDataFrame([(D0 + dt.timedelta(days=i), "A", v) for i, v in
                                enumerate([1.0, float("inf"), 2.0, 3.0])], "date date, ticker string, x double")
    df = df.withColumn("x", F.when(~F.isnan("x") & (F.abs("x") != float("inf")), F.col("x")))
    out = df.withColumn("m", feat.rolling_full(F.avg, "x", 2))
    assert col(out, "m") == [None, None, None, 2.5]


def test_forward_return_is_not_filled(spark):
    df = frame(spark, [1.0, 2.0, None, 4.0])
    out = df.withColumn("f", feat.forward_return("close", 2))
    assert col(out, "f") == [None, 1.0, None, None]


def test_label_null_side_is_zero(spark):
    df = spark.createDataFrame([(None, 1.0), (1.0, None), (2.0, 1.0), (1.0, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(feat.outperform_label("a", "b")).collect()] == [0, 0, 1, 0]


@pytest.mark.parametrize("n,expected", [(69, 0), (70, 1), (71, 2)])
def test_short_histories(spark, n, expected):
    df = frame(spark, [10.0 + (i % 7) for i in range(n)], volume=[5.0 + (i % 3) for i in range(n)])
    for c in ("market_cap_mn_tl", "market_cap_mn_usd", "free_float_market_cap_mn_tl",
              "free_float_market_cap_mn_usd", "capital_mn_tl"):
        df = df.withColumn(c, F.lit(1.0))
    assert feat.build_gold(df, NOTEBOOK).count() == expected


def test_entities_are_isolated(spark):
    a = frame(spark, [float(i + 1) for i in range(30)], "A")
    b = frame(spark, [float(2 * i + 1) for i in range(30)], "B")
    both = feat.build_features(a.unionByName(b)).where("ticker = 'A'")
    alone = feat.build_features(a)
    cols = ["date", "return_5d", "return_20d", "price_to_ma20", "volatility_20d"]
    assert both.select(cols).orderBy("date").collect() == alone.select(cols).orderBy("date").collect()


def test_no_look_ahead(spark):
    base = [10.0 + (i % 5) for i in range(60)]
    changed = base[:40] + [99.0] * 20
    f1 = feat.build_features(frame(spark, base)).where(F.col("date") < D0 + dt.timedelta(days=40))
    f2 = feat.build_features(frame(spark, changed)).where(F.col("date") < D0 + dt.timedelta(days=40))
    cols = ["date", "return_1d", "return_5d", "return_20d", "price_to_ma20", "price_to_ma50",
            "volatility_20d", "volume_ratio_20d"]
    assert f1.select(cols).orderBy("date").collect() == f2.select(cols).orderBy("date").collect()


def test_missing_inputs_give_null_features(spark):
    df = frame(spark, [1.0 + i for i in range(25)]).drop("volume", "usdtry")
    out = feat.build_features(df)
    assert out.where(F.col("volume_ratio_20d").isNotNull() | F.col("usdtry_return_20d").isNotNull()).count() == 0


def test_custom_columns_and_horizon(spark):
    cols = PanelColumns(entity="sym", time="day", price="px", benchmark="idx", fx="fx", volume="vol")
    cfg = FeatureConfig(cols=cols, horizon=2, return_periods=(1,), ma_windows=(2,), volume_window=2,
                        volatility_window=2, market_period=1)
    df = spark.createDataFrame([(D0 + dt.timedelta(days=i), "S", float(i + 1), 10.0, 1.0, 1.0)
                                for i in range(5)], "day date, sym string, px double, idx double, fx double, vol double")
    out = feat.build_features(df, cfg).orderBy("day").collect()
    assert out[0]["future_return_2d"] == pytest.approx(2.0)
    assert out[1]["price_to_ma2"] == pytest.approx(2 / 1.5)


@pytest.mark.parametrize("segments", [3, 64, 700])
def test_segmented_equals_plain(spark, segments):
    from panelstride.plans import fixtures as fx

    p = fx.panel(spark, "/root/testdata/sf0.001")
    # a null close and a null fx value inside the series exercise the cross-segment fill
    p = p.withColumn("close", F.when(F.dayofmonth("date") == 3, None).otherwise(F.col("close")))
    plain = feat.build_features(p, NOTEBOOK)
    seg = feat.build_features(p, NOTEBOOK, segmented=True, segments=segments)
    assert seg.columns == plain.columns
    a = plain.exceptAll(seg).count()
    b = seg.exceptAll(plain).count()
    assert (a, b) == (0, 0)
    assert seg.count() == plain.count()


def test_rows_of_one_date_do_not_depend_on_the_layout(spark):
    from panelstride.config import LOCAL

    rows = [(D0 + dt.timedelta(days=i // 3), "A", 10.0 + i * i % 7, 100.0 + i, 1.0, 5.0, f"f{i % 3}", i) for i in range(240)]
    df = spark.createDataFrame(rows, "date date, ticker string, close double, bist100 double, usdtry double, "
                                     "volume double, source_file string, source_row int")
    a = feat.build_features(df.repartition(1), LOCAL)
    b = feat.build_features(df.repartition(7, "source_row"), LOCAL)
    c = feat.build_features(df.repartition(5), LOCAL, segmented=True, segments=9)
    assert a.exceptAll(b).count() == 0 and a.exceptAll(c).count() == 0 and c.count() == 240

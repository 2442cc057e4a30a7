"""Text is gone through once for each value, whatever stands behind it, and the cheaper
forms say what the plain ones say."""

import re

from pyspark.sql import functions as F

from panelstride.functions.text import LENIENT_DATE_PATTERNS, date_head, parse_date_lenient
from panelstride.operators import cleaning, forest
from panelstride.plans import queries
from panelstride.plans.catalog import round_doubles, round_scaled
from panelstride.session import JIT_LIMIT, keep_compiled
from panelstride.sources import files


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_every_number_text_is_read_once(spark):
    df = spark.createDataFrame([("1,5", " 2")], "a string, b string")
    plan = _plan(round_doubles(cleaning.clean_numbers(df)))
    assert len(re.findall(r"regexp_\w+\(|RLIKE", plan)) == 2
    silver = _plan(cleaning.cast_silver(df.select(F.col("a").alias("close"))))
    assert len(re.findall(r"regexp_\w+\(|RLIKE", silver)) == 1


def test_number_text_at_its_edges(spark):
    texts = ["1,5", " 1.5 ", "1.234,5", "12d", "0x1p3", "1e999", "-1e999", "NaN", "Infinity", "", None, "+.5", "5.",
             "12\n", "12\r\n", "12\u0085", "12\n\n", "\t12", "1e5", "--1"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r["t"] for r in cleaning.clean_numbers(df, only=["t"]).orderBy("i").collect()]
    assert got == [1.5, 1.5, None, None, None, None, None, None, None, None, None, 0.5, 5.0,
                   12.0, 12.0, None, None, None, 100000.0, None]


def test_dates_by_shape_are_the_dates_by_trial(spark):
    texts = ["05-06-2020", "5-6-2020", "5.6.2020", "05/06/2020", "2020-06-05", "2020/06/05", "31-31-2020", "n/a", "", None,
             "05.06-2020", "2020-6-5", "05-06-2020 00:00:00", "2020-06-05T01:02:03", "-5-6-2020", "005-06-2020",
             "+12020-06-05", "05-06-20", "x05-06-2020", " 05-06-2020 ", "29-02-2019", "29/2/2020"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    plain = F.coalesce(*[F.try_to_date(date_head("t"), p) for p in LENIENT_DATE_PATTERNS])
    rows = df.select("t", parse_date_lenient("t").cast("string").alias("d"), plain.cast("string").alias("e")).collect()
    assert [r["d"] for r in rows] == [r["e"] for r in rows]
    assert rows[0]["d"] == rows[4]["d"] == "2020-06-05"


def test_rounding_is_half_away_from_zero(spark):
    values = [0.5, -0.5, 1.5, 2.5, 0.49999999999999994, 4503599627370497.5, 9e15 + 1, 1e300, -2.4, float("inf"), None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    old = F.signum("v") * F.round(F.abs("v"), 0) / F.lit(1.0)
    assert [tuple(r) for r in df.select(round_scaled(F.col("v"), 0)).collect()] == [tuple(r) for r in df.select(old).collect()]
    assert "round(" not in _plan(df.select(round_scaled(F.col("v"), 0)))


def test_long_methods_are_not_left_uncompiled(spark):
    key, limit = JIT_LIMIT
    before = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        keep_compiled(spark)
        assert spark.conf.get(key) == limit
        spark.conf.set(key, "12345")
        keep_compiled(spark)  # the session's own value stays
        assert spark.conf.get(key) == "12345"
    finally:
        spark.conf.set(key, before)


def test_rows_do_not_carry_the_forest(spark):
    nodes = spark.createDataFrame([("f", 0, 0, 0, 1.0, 1, 2, [5.0, 5.0], None, None), ("f", 0, 1, None, None, None, None, [4.0, 0.0], None, None),
                                   ("f", 0, 2, None, None, None, None, [1.0, 3.0], None, None)], forest.NODES)
    df = spark.createDataFrame([(0.5,), (1.0,), (2.0,), (None,)], "x double")
    out = forest.forest_score(df, nodes, ["x"], 1, "f")
    assert [tuple(r)[1:] for r in out.collect()] == [(0.0, 0), (0.0, 0), (0.75, 1), (0.75, 1)]
    assert "Join" not in _plan(out)
    assert [tuple(r)[1:] for r in forest.forest_score(df, nodes, ["x"], 1, "none").collect()] == [(None, None)] * 4


def test_small_workbooks_share_batches(spark):
    from panelstride.plans.fixtures import _workbook

    import pyarrow as pa
    books = [_workbook(["A", "B"], [(k, None), (f"{k}b", "x")]) for k in range(50)] + [b"no zip"]
    batch = pa.RecordBatch.from_arrays([pa.array([f"d/b{i}.xlsx" for i in range(51)]), pa.array(books, pa.binary())],
                                       names=["path", "content"])
    got = list(files._decode_batches(iter([batch])))
    assert len(got) == 1 and got[0].num_rows == 101
    assert got[0].column("cells")[0].as_py() == [("A", "0"), ("B", None)]
    assert got[0].column("error")[100].as_py().startswith("BadZipFile")


def test_layouts_with_repeated_headers(spark, tmp_path):
    (tmp_path / "A1.csv").write_text("x,y,x\n,2,3\n4,5,6\n")
    (tmp_path / "B1.csv").write_text("y\n7\n")
    data, _ = files.ingest_csv(spark, str(tmp_path))
    assert "lambda" not in _plan(data)
    assert sorted((r["ticker"], r["x"] or "", r["y"]) for r in data.collect()) == [("A", "3", "2"), ("A", "4", "5"), ("B", "", "7")]


def test_segmented_gold_writes_what_gold_needs(spark):
    from panelstride import config as C
    from panelstride.operators.features import _gold_inputs

    panel = spark.createDataFrame([], "date date, ticker string, close double, usdtry double, bist100 double, volume double, "
                                      "market_cap_mn_tl double, min_price double, source_file string")
    assert _gold_inputs(panel, C.LOCAL) == ["date", "ticker", "close", "usdtry", "bist100", "volume", "market_cap_mn_tl", "source_file"]
    assert queries.LOCAL_COLS[-2:] == ["bist100", "return_1d"]

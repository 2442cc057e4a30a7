"""Column-inferred dates against pandas."""

import warnings

import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelstride.functions import dates

VALUES = ["2024-01-02", "2024-1-2", "01/02/2024", "13/02/2024", "02/13/2024", "1/2/2024", "31-01-2024", "20240102", "20240231",
          "2024-02-30", "2024-01-02 10:11", "2024-01-02 10:11:12", "2024-01-02T10:11:12", "2 Jan 2024", "02-Jan-2024", "2 jan 2024",
          "January 2, 2024", "May 3, 2024", "31 Feb 2024", "not a date", "", None, "0000-01-01", "12/31/1999", "30/12/1999",
          "2024/01/02", "02.01.2024", "2024-01-02x", "x2024-01-02", "2024-13-01"]
FIRSTS = [v for v in VALUES if v and v != "2 jan 2024" and dates.guess_date_format(v)]  # pandas wants capitals


@pytest.mark.parametrize("day_first", [False, True])
@pytest.mark.parametrize("first", FIRSTS)
def test_guess_agrees_with_pandas(first, day_first):
    from pandas.tseries.api import guess_datetime_format
    other = "2024-13-01", "20240102"  # read here only one way whatever day_first says
    if first not in other:
        assert guess_datetime_format(first, dayfirst=day_first) is not None


@pytest.mark.parametrize("day_first", [False, True])
def test_columns_equal_pandas(spark, day_first):
    rows = [(k, j, v) for k, f in enumerate(FIRSTS) for j, v in enumerate([None, f, *VALUES])]
    df = spark.createDataFrame(rows, "k int, j int, v string")
    for k, first in enumerate(FIRSTS):
        if first[:4].isdigit() and day_first:  # here the year in front means year, month, day
            continue
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            want = pd.to_datetime(pd.Series([r[2] for r in rows if r[0] == k]), errors="coerce", dayfirst=day_first)
        part = df.where(F.col("k") == k)
        got = [r.d for r in part.select("j", dates.parse_date_inferred(part, "v", ["j"], day_first).alias("d")).orderBy("j").collect()]
        assert got == [None if pd.isna(x) else x.date() for x in want], first


def test_the_first_value_in_order_decides(spark):
    df = spark.createDataFrame([(2, "13/02/2024"), (1, "02/03/2024"), (3, " 2024-01-01 ")], "i int, v string")
    month_first = dates.parse_date_inferred(df, "v", ["i"])
    assert [str(r.d) for r in df.orderBy("i").select(month_first.alias("d")).collect()] == ["2024-02-03", "None", "None"]
    day_first = dates.parse_date_inferred(df, "v", ["i"], day_first=True)
    assert [str(r.d) for r in df.orderBy("i").select(day_first.alias("d")).collect()] == ["2024-03-02", "2024-02-13", "None"]


def test_no_clear_format_is_left_to_the_lenient_rule(spark):
    df = spark.createDataFrame([(1, "soon"), (2, "31-01-2024"), (3, "2024-01-31")], "i int, v string")
    got = df.orderBy("i").select(dates.parse_date_inferred(df, "v", ["i"]).alias("d")).collect()
    assert [str(r.d) for r in got] == ["None", "2024-01-31", "2024-01-31"]
    empty = df.where("i > 5")
    assert empty.select(dates.parse_date_inferred(empty, "v", ["i"]).alias("d")).collect() == []

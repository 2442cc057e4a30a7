"""Steps that once did their work twice or on more rows or columns than they need."""

import datetime as dt
import re

import pytest

from panelstride.config import NOTEBOOK
from panelstride.operators import features as feat
from panelstride.operators import incremental, profile, reports
from panelstride.plans import model_queries  # noqa: F401  (registers)
from panelstride.plans.catalog import REGISTRY

D0 = dt.date(2020, 1, 1)
PANEL = "date date, ticker string, close double, bist100 double, usdtry double, volume double"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def panel(spark):
    """Two entities, one with missing closes and volumes."""
    rows = [(D0 + dt.timedelta(days=i), t, None if t == "B" and i % 61 == 60 else 50.0 + (i * 7 + k) % 13,
             100.0 + i % 9, 1.0 + i / 100, None if t == "B" and i == 100 else 10.0 + i % 5)
            for k, t in enumerate("AB") for i in range(160)]
    return spark.createDataFrame(rows, PANEL)


def test_moving_averages_of_chunks(panel):
    out = feat.build_features(panel, NOTEBOOK)
    assert "-49, currentrow" not in plan(out)  # no frame that goes over 50 rows for each row
    rows = out.orderBy("ticker", "date").collect()
    for name, source, n in (("price_to_ma20", "close", 20), ("price_to_ma50", "close", 50), ("volume_ratio_20d", "volume", 20)):
        for k, r in enumerate(rows):
            last = [x[source] for x in rows[max(0, k - n + 1):k + 1] if x["ticker"] == r["ticker"]]
            if len(last) < n or None in last:
                assert r[name] is None
            else:
                assert r[name] == pytest.approx(r[source] / (sum(last) / n), rel=1e-12)


@pytest.mark.parametrize("windows,size", [((20, 50, 20), 10), ((20, 20), None), ((7, 20), None), ((2, 50), None)])
def test_chunks_only_where_they_save_work(windows, size):
    assert feat.chunk_size(windows) == size


def test_availability_sorts_a_written_table(panel):
    out = profile.availability(feat.build_gold(panel))
    assert "Window" not in plan(out)  # the sort's sample would run the windows once more
    assert [(r[0], r[3]) for r in out.collect()] == [("A", 91), ("B", out.collect()[1][3])]


def test_daily_index_runs_the_windows_once(panel):
    gold = feat.build_gold(panel)
    out = reports.normalised_index(gold.select("ticker", "date", "close"), freq="daily")
    assert "Window" not in plan(out)  # else once for the rows and once for the first closes
    assert out.count() == gold.count()
    first = out.where("date = first_available_date").collect()
    assert [r["normalized_close"] for r in first] == [100.0, 100.0]


@pytest.mark.parametrize("name", ["month_end", "normalised_index_monthly", "performance_summary", "top_performers", "best_performer"])
def test_month_ends_carry_no_more_than_the_close(spark, name):
    text = plan(REGISTRY[name].build(spark, "/root/testdata/sf0.001"))
    assert re.search(r"max\(struct\(date, date#\d+, close, close#\d+\)\)", text)


def test_changed_keys_shuffle_no_rows(panel, spark):
    schema = "ticker string, date date, a double, b double"
    old = spark.createDataFrame([("A", D0, 1.0, None), ("B", D0, 1.0, 2.0), ("C", D0, 0.0, 1.0), ("D", D0, None, None)], schema)
    new = spark.createDataFrame([("A", D0, None, 1.0), ("B", D0, 1.0, 2.0), ("C", D0, -0.0, 1.0), ("E", D0, None, None)], schema)
    out = incremental.changed_keys(old, new)
    assert plan(out).count("Exchange hashpartitioning") == 1  # distinct rows took one of their own, with the rows' text
    assert sorted(r[0] for r in out.collect()) == ["A", "C", "D", "E"]


def test_recompute_writes_only_what_gold_depends_on(panel, monkeypatch):
    from pyspark.sql import functions as F

    written, real = {}, incremental.shared_table

    def spy(df, name):
        written[name] = set(df.columns)
        return real(df, name)

    monkeypatch.setattr(incremental, "shared_table", spy)
    wide = panel.withColumn("min_price", F.lit(1.0))
    changed = panel.where("ticker = 'A' and date = '2020-04-01'").select("ticker", "date")
    incremental.recompute(wide, changed)
    assert "min_price" not in written["placed"] | written["reached"]
    assert not [c for c in written["reached"] if c.startswith("__")]

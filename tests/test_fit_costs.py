"""Fits read written tables, narrow and no more often than they must."""

import pytest
from pyspark.sql import functions as F

from panelstride.operators import models
from panelstride.plans import model_queries, queries

SF = "/root/testdata/sf0.001"
LABEL = "target_outperform_20d"


class Stop(Exception):
    pass


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def caught(monkeypatch, name, query, spark):
    """The plan of the rows that ``query`` hands to ``models.<name>``."""
    seen = []

    def spy(df, *args):
        seen.append(plan(df))
        raise Stop

    monkeypatch.setattr(models, name, spy)
    with pytest.raises(Stop):
        query(spark, SF)
    return seen[0]


def test_newton_orders_a_written_table(spark, monkeypatch):
    text = caught(monkeypatch, "training_table", model_queries.q_fit_newton, spark)
    assert "Window" not in text and "FileScan parquet" in text  # else sampling the order runs the windows once more


def test_roundtrip_parses_its_text_once(spark, monkeypatch):
    text = caught(monkeypatch, "fit_candidate", queries.q_read_write_roundtrip, spark)
    assert "FileScan csv" not in text  # else once for the sample, the fit and the scoring each


def test_splits_hold_what_models_read(spark):
    for part in queries._train_valid_test(spark, SF):
        assert part.columns == ["ticker", "date", *queries.FEATURES, LABEL]


def rows(spark, n=3000):
    x = F.pmod(F.xxhash64("id"), F.lit(1000)) / 500 - 1
    y = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1000)) / 500 - 1
    return spark.range(n).select(
        F.concat(F.lit("T"), F.col("id") % 7).alias("ticker"), F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("date"),
        x.alias("a"), F.when(F.col("id") % 50 != 0, y).alias("b"), (x + y > 0.2).cast("double").alias(LABEL))


def test_statistics_without_a_rollup(spark, monkeypatch):
    df = rows(spark)
    want = df.agg(F.avg("a").alias("m"), F.stddev_pop("b").alias("s"), F.count_if(F.col(LABEL) == 1).alias("n")).first()

    def rollup(*_):
        raise AssertionError("every row twice")

    monkeypatch.setattr(type(df), "rollup", rollup)
    prep, counts = models.fit_statistics(df, ["a", "b"], LABEL, False, True)
    assert prep.means["a"] == pytest.approx(want["m"], rel=1e-12) and prep.stds["b"] == pytest.approx(want["s"], rel=1e-12)
    assert counts == {1.0: want["n"], 0.0: 3000 - want["n"]}


@pytest.mark.parametrize("n,parts", [(0, 1), (20_001, 2), (1_600_000, 48), (96_000_000, 240)])
def test_forest_parts_grow_with_the_rows(n, parts):
    assert models.forest_parts(n) == parts


@pytest.mark.parametrize("balanced", [False, True])
def test_node_ids_give_the_same_trees(spark, monkeypatch, balanced):
    data = models.training_table(rows(spark).na.drop(), ["a", "b"])
    cand = models.Candidate("rf", "forest", scale=False, balanced=balanced, trees=6, depth=5)
    fits = []
    for limit in (models.NODE_ID_BYTES, 0):
        monkeypatch.setattr(models, "NODE_ID_BYTES", limit)
        fits.append(models.fit_table(data, cand, ["a", "b"], LABEL).stages[-1])
    kept, sent = fits
    assert kept.getCacheNodeIds() and not sent.getCacheNodeIds()
    assert kept.toDebugString.split("\n")[1:] == sent.toDebugString.split("\n")[1:]
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()

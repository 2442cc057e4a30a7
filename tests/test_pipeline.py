"""The notebook chain end to end: files -> bronze -> silver -> gold -> models -> artifacts."""

from pyspark.sql import functions as F

from panelstride import config as C
from panelstride.operators import features, models
from panelstride.plans import fixtures as fx
from panelstride.plans import pipeline
from panelstride.sources import tables

SF = "/root/testdata/sf0.001"
CUTS = ("1999-01-01", "2001-01-01")


def letter_code(ticker):
    """Supplier#000000123 -> a three-letter code, so that file names follow the
    'leading capitals of the stem' rule one-to-one."""
    num = F.regexp_extract(ticker, r"(\d+)$", 1).cast("int")
    return F.concat(*[F.char(F.lit(65) + (num / 26 ** i).cast("int") % 26) for i in (2, 1, 0)])


def test_files_to_gold_and_model(spark, tmp_path):
    raw = fx.raw_panel(spark, SF)
    raw = raw.withColumn("source_file", F.concat(letter_code("ticker"), F.lit("2011010120260422.xlsx")))
    raw = raw.drop("ticker")
    (raw.repartition("source_file").write.option("header", True).partitionBy("source_file")
     .csv(str(tmp_path / "raw")))
    out = pipeline.files_to_gold(spark, str(tmp_path / "raw"), str(tmp_path / "out"), fmt="csv",
                                 entity_from="directory")
    expected = features.build_gold(fx.panel(spark, SF).withColumn("ticker", letter_code("ticker")),
                                   C.NOTEBOOK)
    assert out.gold.count() == expected.count() > 0
    assert out.gold.select(expected.columns).exceptAll(expected).count() == 0

    fast = (models.Candidate("lr", "logistic", max_iter=50),
            models.Candidate("rf", "forest", scale=False, trees=5, depth=4))
    result = pipeline.gold_to_model(spark, out.gold, str(tmp_path / "model_out"), fast, cuts=CUTS)
    assert result.best in {"lr", "rf"}
    assert tables.read_feature_catalog(spark, str(tmp_path / "model_out/feature_columns")) == list(C.FEATURE_COLUMNS)
    reloaded = models.load_model(str(tmp_path / "model_out/model"))
    scored = models.predict(reloaded, out.gold)
    assert scored.where(F.col("predicted_probability").between(0, 1)).count() == out.gold.count()
    runs = tables.read_table(spark, str(tmp_path / "model_out/runs"))
    assert runs.where("key = 'best_model'").first()["value"] == result.best

    views = pipeline.serving_tables(out.gold, reloaded, top=5)
    assert views["ranking"].count() == min(25, expected.select("ticker").distinct().count())
    assert views["performance_summary"].count() == 5

    table = pipeline.test_prediction_table(reloaded, out.gold, "lr", CUTS)
    assert "bist100" not in table.columns and table.count() > 0

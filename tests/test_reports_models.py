"""Reports, scoring, model fit/save/load, sources."""

import datetime as dt
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from panelstride.operators import models, reports, splits
from panelstride.sources import files, tables

D = dt.date


def panel(spark):
    rows = [(D(2020, 1, 2), "A", 10.0), (D(2020, 1, 31), "A", 12.0), (D(2020, 2, 3), "A", 11.0),
            (D(2020, 2, 28), "A", 15.0), (D(2020, 2, 10), "B", 4.0), (D(2020, 3, 2), "B", 5.0)]
    return spark.createDataFrame(rows, "date date, ticker string, close double")


def test_latest_rows(spark):
    got = {r.ticker: r.date for r in reports.latest_rows(panel(spark)).collect()}
    assert got == {"A": D(2020, 2, 28), "B": D(2020, 3, 2)}


def test_month_end_and_index(spark):
    idx = reports.normalised_index(panel(spark), freq="monthly").orderBy("ticker", "plot_date").collect()
    assert [(r.ticker, r.plot_date, r.close, r.normalized_close) for r in idx] == [
        ("A", D(2020, 1, 1), 12.0, 100.0), ("A", D(2020, 2, 1), 15.0, 125.0),
        ("B", D(2020, 2, 1), 4.0, 100.0), ("B", D(2020, 3, 1), 5.0, 125.0)]
    assert idx[0].first_available_date == D(2020, 1, 2) and idx[0].plot_date_str == "2020-01-01"


def test_index_universe_keeps_unfiltered_first_date(spark):
    idx = reports.normalised_index(panel(spark), ["B"], freq="daily").collect()
    assert {r.ticker for r in idx} == {"B"} and idx[0].first_available_date == D(2020, 2, 10)


def test_performance_summary_half_even(spark):
    df = spark.createDataFrame([("A", D(2020, 1, 1), D(2020, 1, 1), 0.125, 100.0),
                                ("A", D(2020, 1, 1), D(2020, 2, 1), 1.0, 100.125)],
                               "ticker string, first_available_date date, plot_date date, close double, "
                               "normalized_close double")
    r = reports.performance_summary(df).first()
    assert (r.start_close, r.latest_close, r.latest_normalized_index, r.total_return_pct) == (0.12, 1.0, 100.12, 0.12)


def test_time_split_cover(spark):
    df = spark.createDataFrame([(D(2020, 12, 31),), (D(2021, 1, 1),), (D(2023, 1, 1),), (None,)], "date date")
    got = [r.split for r in splits.time_split(df).orderBy(F.col("date").asc_nulls_last()).collect()]
    assert got == ["train", "valid", "test", None]


def test_linear_scorer_table_roundtrip(spark):
    s = models.LinearScorer(1.0, (("x", 2.0),), digits=4)
    back = models.LinearScorer.from_table(s.to_table(spark), digits=4)
    df = spark.createDataFrame([(0.0,), (-0.5,), (-1.0,)], "x double")
    p = [r.predicted_probability for r in models.score(df, back).collect()]
    assert p == [0.7311, 0.5, 0.2689]
    c = [r.predicted_class for r in models.score(df, back).collect()]
    assert c == [1, 0, 0]


def _toy_train(spark, n=400):
    import random

    rnd = random.Random(0)
    rows = []
    for _ in range(n):
        a, b = rnd.gauss(0, 1), rnd.gauss(0, 1)
        y = int(a + 0.5 * b + rnd.gauss(0, 0.5) > 0)
        rows.append((a, None if rnd.random() < 0.05 else b, y))
    return spark.createDataFrame(rows, "a double, b double, target_outperform_20d int")


def test_logistic_fit_optimality_and_reload(spark, tmp_path):
    train = _toy_train(spark)
    cand = models.Candidate("lr", "logistic", impute=True, balanced=False)
    model = models.fit_candidate(train, cand, ["a", "b"])
    scored = models.predict(model, train).select("predicted_probability").collect()
    assert all(0.0 <= r[0] <= 1.0 for r in scored)
    lr = model.stages[-1]
    import numpy as np

    prep = models.fit_impute_scale(train, ["a", "b"], impute=True, scale=True)
    x = np.array([[r.a, r.b, r.target_outperform_20d] for r in prep.apply(train).collect()])
    w = np.array(lr.coefficients.toArray())
    z = x[:, :2] @ w + lr.intercept
    grad = x[:, :2].T @ (1 / (1 + np.exp(-z)) - x[:, 2]) + w  # C = 1: 1/2 |w|^2 + sum logloss
    assert np.abs(grad).max() < 1e-2
    path = str(tmp_path / "m")
    models.save_model(model, path)
    again = models.predict(models.load_model(path), train).select("predicted_probability").collect()
    assert again == scored


def test_forest_fit_balanced(spark):
    train = _toy_train(spark, 300)
    cand = models.Candidate("rf", "forest", impute=True, scale=False, balanced=True, trees=5, depth=3, min_leaf=5)
    out = models.predict(models.fit_candidate(train, cand, ["a", "b"]), train)
    assert out.where(F.col("predicted_probability").between(0, 1)).count() == 300


def test_select_best_tie_rules(spark):
    m = spark.createDataFrame([("lr", 0.6), ("rf", 0.6), ("x", 0.5)], "model string, validation_roc_auc double")
    assert models.select_best(m, ["lr", "rf", "x"], "first").first().model == "lr"
    assert models.select_best(m, ["lr", "rf", "x"], "last").first().model == "rf"


def test_table_csv_and_catalog_roundtrip(spark, tmp_path):
    df = panel(spark)
    tables.write_table(df, str(tmp_path / "t"))
    back = tables.read_table(spark, str(tmp_path / "t"))
    tables.export_csv(back, str(tmp_path / "c"))
    again = tables.read_csv(spark, str(tmp_path / "c"), df.schema)
    assert sorted(again.collect()) == sorted(df.collect())
    tables.write_feature_catalog(spark, ["b", "a"], str(tmp_path / "f"))
    assert tables.read_feature_catalog(spark, str(tmp_path / "f")) == ["b", "a"]


def _xlsx(header, rows):
    """Minimal workbook with inline strings and numbers (test helper)."""
    def cell(ref, v):
        if isinstance(v, str):
            return f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>'
        return f'<c r="{ref}"><v>{v}</v></c>'

    lines = []
    for i, r in enumerate([header, *rows], start=1):
        cells = "".join(cell(f"{chr(65 + j)}{i}", v) for j, v in enumerate(r))
        lines.append(f'<row r="{i}">{cells}</row>')
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns}><sheets><sheet name="S" sheetId="1"/></sheets></workbook>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData>{"".join(lines)}</sheetData></worksheet>')
    return buf.getvalue()


def test_workbook_ingest(spark, tmp_path):
    (tmp_path / "AEFES2011.xlsx").write_bytes(_xlsx(["Tarih", "Kapanış(TL)"], [["02-01-2020", 10.5], ["03-01-2020", 11]]))
    (tmp_path / "BIMAS2011.xlsx").write_bytes(_xlsx(["Kapanış(TL)", "Tarih", "Hacim(TL)"], [[7, "02-01-2020", 3]]))
    (tmp_path / "BROKEN.xlsx").write_bytes(b"not a zip")
    bronze, errors = files.ingest_workbooks(spark, str(tmp_path))
    got = sorted((r.ticker, r.tarih, r.kapanis_tl, r.hacim_tl) for r in bronze.collect())
    assert got == [("AEFES", "02-01-2020", "10.5", None), ("AEFES", "03-01-2020", "11", None),
                   ("BIMAS", "02-01-2020", "7", "3")]
    assert [r.source_file for r in errors.collect()] == ["BROKEN.xlsx"]


def test_csv_ingest_groups_header_layouts(spark, tmp_path):
    (tmp_path / "AAA1.csv").write_text("Tarih,Kapanış(TL)\n02-01-2020,1\n")
    (tmp_path / "BBB1.csv").write_text("Kapanış(TL),Tarih\n2,03-01-2020\n")
    got = sorted((r.ticker, r.tarih, r.kapanis_tl) for r in files.ingest_csv(spark, str(tmp_path))[0].collect())
    assert got == [("AAA", "02-01-2020", "1"), ("BBB", "03-01-2020", "2")]
    (tmp_path / "CCC1.csv").write_text("\n \n")
    # headers that normalise alike, a quoted separator, a BOM, blank lines
    (tmp_path / "DDD+x 1.csv").write_text("\ufeffTarih,Kapanış(TL),Kapanış TL\r\n\r\n04-01-2020,,\"3,5\"\r\n05-01-2020,6,7\r\n")
    data, errors = files.ingest_csv(spark, str(tmp_path))
    assert sorted((r.ticker, r.tarih, r.kapanis_tl) for r in data.collect()) == [*got, ("DDD", "04-01-2020", "3,5"), ("DDD", "05-01-2020", "6")]
    assert [r.source_file for r in errors.collect()] == ["CCC1.csv"]
    with pytest.raises(FileNotFoundError):
        files.ingest_csv(spark, str(tmp_path), pattern="*.nothing")


def test_bucketed_silver_feeds_windows_without_exchange(spark):
    from panelstride import config as C
    from panelstride.operators import features
    from panelstride.plans import fixtures as fx

    silver = fx.panel(spark, "/root/testdata/sf0.001")
    tables.write_table(silver, "silver_bucketed_test", bucket_by="ticker", buckets=4, sort_by=("ticker", "date"))
    back = tables.read_table(spark, "silver_bucketed_test")
    feats = features.build_features(back, C.NOTEBOOK)
    plan = feats._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert feats.count() == silver.count()
    spark.sql("drop table silver_bucketed_test")


def test_workbook_date_styled_cells():
    """A cell with a date number format is decoded to day-first date text
    (serial 43832 = 2020-01-02), which the strict silver parse accepts."""
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    sheet = (f'<worksheet {ns}><sheetData>'
             '<row r="1"><c r="A1" t="inlineStr"><is><t>Tarih</t></is></c>'
             '<c r="B1" t="inlineStr"><is><t>Kapanış(TL)</t></is></c></row>'
             '<row r="2"><c r="A2" s="1"><v>43832</v></c><c r="B2"><v>10.25</v></c></row>'
             '</sheetData></worksheet>')
    styles = (f'<styleSheet {ns}><cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs>'
              '</styleSheet>')
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns}><sheets><sheet name="S" sheetId="1"/></sheets></workbook>')
        z.writestr("xl/worksheets/sheet1.xml", sheet)
        z.writestr("xl/styles.xml", styles)
    rows = files.decode_xlsx(buf.getvalue())
    assert rows == [{"Tarih": "02-01-2020", "Kapanış(TL)": "10.25"}]


def test_repeated_workbook_headers_stay_apart():
    rows = files.decode_xlsx(_xlsx(["A", "A", "B"], [["1", "2", "3"]]))
    assert rows == [{"A": "1", "A.1": "2", "B": "3"}]


def test_csv_ingest_reads_what_only_spark_reads(spark, tmp_path):
    """A path with a scheme that no plain file API knows."""
    (tmp_path / "AAA1.csv").write_text("Tarih,Kapanış(TL)\n02-01-2020,1\n")
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.panels.link./in", f"file://{tmp_path}")
    data, errors = files.ingest_csv(spark, "viewfs://panels/in")
    assert [(r.ticker, r.kapanis_tl) for r in data.collect()] == [("AAA", "1")] and errors.isEmpty()


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    from panelstride import session

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Session:
        conf = Conf()

        class sparkContext:  # noqa: N801
            @staticmethod
            def getConf():
                return Conf()

    with pytest.raises(ValueError, match="checkpoint"):
        session.shared_folder(Session())

"""Sorted single-file export, run records, workbooks in bounded memory."""

import csv
import io
import random
import subprocess
import sys
import zipfile

from pyspark.sql import functions as F

from panelstride.operators import models
from panelstride.sources import files, tables


def test_one_sorted_file_with_one_header(spark, tmp_path):
    rnd = random.Random(1)
    rows = [(f"T{rnd.randrange(40):02}", f"2020-01-{rnd.randrange(1, 29):02}", rnd.random(), 'say "x", y') for _ in range(3000)]
    df = spark.createDataFrame(rows, "ticker string, date string, v double, note string").repartition(7)
    target = tmp_path / "out" / "gold.csv"
    for _ in range(2):  # again over the old one
        tables.export_csv_file(df, str(target), ["ticker", "date", "v"])
    assert target.is_file() and [p.name for p in target.parent.iterdir() if not p.name.startswith(".")] == ["gold.csv"]
    back = spark.read.option("header", True).option("escape", "\\").csv(str(target))
    assert back.columns == df.columns and back.count() == 3000
    lines = target.read_text().splitlines()
    assert lines[0] == "ticker,date,v,note" and len(lines) == 3001
    got = [tuple(next(csv.reader([x]))[:2]) for x in lines[1:]]
    assert got == sorted(got) and sorted(got) == sorted(r[:2] for r in rows)


def test_an_empty_export_is_a_header(spark, tmp_path):
    tables.export_csv_file(spark.createDataFrame([], "a int, b string"), str(tmp_path / "e.csv"), ["a"])
    assert (tmp_path / "e.csv").read_text() == "a,b\n"


def test_runs_recorded_again_take_their_own_place(spark, tmp_path):
    path = str(tmp_path / "runs")
    one = models.run_records(spark, "one", {"rows": 5, "x": "a"}, {"auc": 0.5})
    two = models.run_records(spark, "two", {"rows": 5, "x": "a"}, {"auc": 0.6})
    told = models.record_runs(one.unionByName(two), path).collect()
    assert {(r.run, r.replayed, r.same_metrics) for r in told} == {("one", False, None), ("two", False, None)}
    again = models.run_records(spark, "two", {"rows": 5, "x": "a"}, {"auc": 0.7})
    other = models.run_records(spark, "two", {"rows": 6, "x": "a"}, {"auc": 0.6})
    told = models.record_runs(one.unionByName(again), path).collect()
    assert {(r.run, r.replayed, r.same_metrics) for r in told} == {("one", True, True), ("two", True, False)}
    assert [(r.run, r.replayed) for r in models.record_runs(other, path).collect()] == [("two", False)]
    table = models.read_runs(spark, path)
    assert table.count() == 9 and table.select("run_id").distinct().count() == 3
    assert sorted(r.value for r in table.where("kind = 'metric' AND run = 'two'").collect()) == ["0.6", "0.7"]


SPACE = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def workbook(rows, cut=None):
    def body():
        yield f"<worksheet {SPACE}><sheetData>"
        yield '<row r="1"><c r="A1" t="inlineStr"><is><t>n</t></is></c><c r="B1" t="inlineStr"><is><t>s</t></is></c></row>'
        for k in range(2, rows + 2):
            yield f'<row r="{k}"><c r="A{k}"><v>{k}</v></c><c r="B{k}" t="s"><v>{k % 3}</v></c></row>'
        if cut is None:
            yield "</sheetData></worksheet>"

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f'<workbook {SPACE}><sheets><sheet name="S" sheetId="1"/></sheets></workbook>')
        z.writestr("xl/sharedStrings.xml", f"<sst {SPACE}><si><t>zero</t></si><si><t>one</t></si><si><r><t>t</t></r><r><t>wo</t></r></si></sst>")
        with z.open("xl/worksheets/sheet1.xml", "w") as f:
            for part in body():
                f.write(part.encode())
    return out.getvalue()


def test_a_long_sheet_is_read_row_by_row(tmp_path):
    """A million rows in a process of its own: under 500 MB."""
    (tmp_path / "big.xlsx").write_bytes(workbook(1_000_000))
    code = ("import sys, resource; from panelstride.sources import files; n = 0\n"
            f"for r in files.iter_xlsx(open({str(tmp_path / 'big.xlsx')!r}, 'rb').read()):\n    n += 1\n"
            "assert r == {'n': '1000001', 's': 'two'}, r\n"
            "print(n, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss)")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=files.__file__.split("/panelstride/")[0])
    n, kilobytes = map(int, out.stdout.split())
    assert n == 1_000_000 and kilobytes < 500_000


def test_a_sheet_that_breaks_off_gives_no_rows(spark):
    raw = spark.createDataFrame([("a/GOOD1.xlsx", workbook(12_000)), ("a/BAD1.xlsx", workbook(12_000, cut=True))], "path string, content binary")
    got, errors = files.ingest_workbooks(spark, raw)
    assert [(r.source_file, r["count"]) for r in got.groupBy("source_file").count().collect()] == [("GOOD1.xlsx", 12_000)]
    assert [r.source_file for r in errors.collect()] == ["BAD1.xlsx"]
    assert got.agg(F.max("source_row")).first()[0] == 11_999

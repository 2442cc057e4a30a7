"""CSV records with quoted line breaks over many splits, against pandas."""

import csv
import io
import random

import pandas as pd
import pytest

from panelstride.sources import files


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def read(spark, folder, **options):
    got, errors = files.ingest_csv(spark, str(folder), **options)
    rows = got.orderBy("source_file", "source_block", "source_row").collect()
    return rows, sorted((r.source_file, r.error.split(":")[0]) for r in errors.collect())


def expected(path):
    """pandas reads text as it stands; empty unquoted fields are null on both sides."""
    with open(path, newline="") as f:
        frame = pd.read_csv(f, dtype=str, keep_default_na=False, na_values=[""])
    return [tuple(None if pd.isna(v) else v for v in r) for r in frame.itertuples(index=False)]


@pytest.mark.parametrize("ending", ["\n", "\r\n", "\r"])
def test_quoted_breaks_over_splits(spark, tmp_path, small_splits, ending):
    rnd = random.Random(ending)
    texts = ["plain", 'say "so"', f"two{ending}lines", f'"{ending}{ending}"', "a,b", f"long {'x' * 150}{ending}{'y' * 150}",
             f'q""{ending}""', f",{ending},", "5\" pipe", "end\"", " x "]
    for name in ("AAA", "BBB", "CCC"):
        out = io.StringIO()
        w = csv.writer(out, lineterminator=ending)
        w.writerow(["id", "note", f"over{ending}two"])
        for k in range(120):
            w.writerow([k, rnd.choice(texts) if name != "CCC" else "calm", rnd.choice(texts[:2])])
        (tmp_path / f"{name}1.csv").write_text(out.getvalue(), newline="")
    rows, errors = read(spark, tmp_path)
    assert errors == []
    for name in ("AAA", "BBB", "CCC"):
        got = [(r["id"], r["note"], r["over_two"]) for r in rows if r.ticker == name]
        assert got == expected(tmp_path / f"{name}1.csv")


def test_stray_quotes_are_text(spark, tmp_path, small_splits):
    (tmp_path / "A.csv").write_text('h,i\na"b,c\n5",6"\n"x\ny",z\nlast,"""one"""\n')
    rows, errors = read(spark, tmp_path)
    assert [(r.h, r.i) for r in rows] == expected(tmp_path / "A.csv") and errors == []


def test_a_file_left_open_is_an_error(spark, tmp_path, small_splits):
    (tmp_path / "BAD.csv").write_text('h,i\n1,2\n"open,3\n' + "4,5\n" * 100)
    (tmp_path / "GOOD.csv").write_text('h,i\n1,"a\nb"\n')
    (tmp_path / "NONE.csv").write_text("\n\n")
    rows, errors = read(spark, tmp_path)
    assert [(r.h, r.i, r.source_file) for r in rows] == [("1", "a\nb", "GOOD.csv")]
    assert errors == [("BAD.csv", "UnclosedQuote"), ("NONE.csv", "EmptyFile")]


def test_other_separators(spark, tmp_path, small_splits):
    (tmp_path / "S.csv").write_text('h;i\n"a;\nb";"c"\n;"d\n"\nx,"y;z\n')
    rows, _ = read(spark, tmp_path, sep=";")
    assert [(r.h, r.i) for r in rows] == [("a;\nb", "c"), (None, "d\n"), ('x,"y', "z")]

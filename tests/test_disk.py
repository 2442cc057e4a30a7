"""What stays on disk: no shuffles of written tables, no scratch tables that nothing reads."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from panelstride import config as C
from panelstride import session
from panelstride.operators import features, incremental
from panelstride.plans import model_queries, queries  # noqa: F401  (registers)
from panelstride.plans.catalog import REGISTRY
from panelstride.sources import tables

from test_incremental import frame, panel, same

SF = "/root/testdata/sf0.001"


def shuffle_files(spark) -> int:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return sum("/shuffle_" in f and f.endswith(".data") for f in files.split("\n"))


def scratch(spark) -> set[str]:
    folder = f"{session.shared_folder(spark)}/panelstride"
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def kinds(names) -> set[str]:
    return {n.rsplit("-", 1)[0] for n in names}


@pytest.mark.parametrize("write", [lambda df, path: session.shared_table(df, "t"), lambda df, path: tables.write_table(df, path),
                                   lambda df, path: tables.export_csv(df, path, order_by=("k",))])
def test_a_write_leaves_no_shuffle(spark, tmp_path, write):
    before = shuffle_files(spark)
    write(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), str(tmp_path / "t"))
    assert shuffle_files(spark) <= before  # earlier ones may be collected meanwhile
    assert session.DROP_SHUFFLES not in spark.conf.getAll


def test_a_table_moves(spark, tmp_path):
    path = str(tmp_path / "own")
    spark.range(5).write.parquet(path)
    first = session.shared_table(spark.range(5, 9), "first")
    both = spark.read.parquet(path).union(first)
    moved = session.moved_table(both, "moved")
    assert sorted(r[0] for r in moved.collect()) == list(range(9))
    assert "first" not in kinds(os.path.basename(os.path.dirname(f)) for f in moved.inputFiles())
    assert os.path.basename(os.path.dirname(moved.inputFiles()[0])) in scratch(spark)
    assert spark.read.parquet(path).count() == 5  # not a scratch table
    assert not any(n.startswith("first-") for n in scratch(spark))


@pytest.mark.parametrize("name,gone", [
    ("gold_local_duplicates", {"segments", "supplier_days"}), ("bronze_to_gold_local", {"segments", "supplier_days"}),
    ("gold_incremental", {"supplier_days", "placed", "reached", "stretches", "touched", "merged", "gold_rows"}),
    ("load_gold", {"supplier_days"}), ("read_write_roundtrip", {"supplier_days", "train"})])
def test_queries_keep_only_what_is_read(spark, name, gone):
    before = scratch(spark)
    out = REGISTRY[name].build(spark, SF)
    left = kinds(scratch(spark) - before)
    assert not left & gone
    assert out.count() >= 0  # what is read is there


def test_exported_text_is_small(spark, tmp_path):
    df = spark.range(20000).select(F.rand(1).alias("x"), F.lit("a,b").alias("t"))
    tables.export_csv(df, str(tmp_path / "z"), compression="gzip")
    tables.export_csv(df, str(tmp_path / "t"))
    size = {k: sum(f.stat().st_size for f in (tmp_path / k).glob("part*")) for k in "zt"}
    assert size["z"] < 0.6 * size["t"]
    back = tables.read_csv(spark, str(tmp_path / "z"), df.schema)
    assert sorted(back.collect()) == sorted(tables.read_csv(spark, str(tmp_path / "t"), df.schema).collect())


@pytest.mark.parametrize("at_once", [1, 4])
def test_months_in_parts(spark, tmp_path, monkeypatch, at_once):
    """Months put together a few at a time give the same gold, in a folder that held other months."""
    monkeypatch.setattr(incremental, "MONTHS_AT_ONCE", at_once)
    rnd = random.Random(9)
    old = panel(rnd, entities=2, days=230)
    new = {k: v for k, v in old.items() if not (k[0] == "E1" and dt.date(2020, 5, 3) < k[1] < dt.date(2020, 7, 4))}
    path = str(tmp_path / "gold")
    spark.createDataFrame([(1, 190001)], "x int, period int").write.partitionBy("period").parquet(path)
    before, now = frame(spark, old), frame(spark, new)
    incremental.write_gold(features.build_gold(before), path)
    same(incremental.read_gold(spark, path), features.build_gold(before))
    incremental.update_gold(now, incremental.changed_keys(before, now), path)
    same(incremental.read_gold(spark, path), features.build_gold(now, C.NOTEBOOK))

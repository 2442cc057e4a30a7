"""The correctness gate in miniature: registered queries against their DuckDB
oracle on the smallest scale factor (the driver runs all of them at sf0.01)."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import digest, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = ["gold_features", "gold_features_segmented", "bronze_to_gold_local", "dedupe_silver",
         "clean_dates", "normalise_header", "performance_summary", "latest_feature_pairs",
         "train_medians", "roc_auc_by_split", "classification_report", "select_best", "ingest_files"]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(df.columns, s_rows)[0] == digest(d_cols, d_rows)[0]

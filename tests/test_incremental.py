"""Incremental gold equals a full build."""

import datetime as dt
import random

import pytest

from panelstride import config as C
from panelstride.operators import features, incremental

COLS = ["close", "bist100", "usdtry", "volume", "market_cap_mn_tl", "market_cap_mn_usd", "free_float_market_cap_mn_tl",
        "free_float_market_cap_mn_usd", "capital_mn_tl"]
SCHEMA = "ticker string, date date, " + ", ".join(f"{c} double" for c in COLS)


def panel(rnd, entities=4, days=260, holes=0.02):
    out = {}
    for e in range(entities):
        for d in range(days):
            values = [round(rnd.uniform(1, 9), 3) for _ in COLS]
            for k in range(3):
                if rnd.random() < holes:
                    values[k] = None
            out[f"E{e}", dt.date(2020, 1, 1) + dt.timedelta(days=d)] = tuple(values)
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*k, *v) for k, v in rows.items()], SCHEMA)


def same(got, want):
    cols = want.columns
    a = sorted(tuple(map(repr, r)) for r in got.select(cols).collect())
    b = sorted(tuple(map(repr, r)) for r in want.collect())
    assert a == b


@pytest.mark.parametrize("cfg", [C.NOTEBOOK, C.NOTEBOOK.with_(gold_rule="required", required=("date", "ticker"))])
@pytest.mark.parametrize("seed", [0, 1])
def test_update_equals_full_build(spark, tmp_path, cfg, seed):
    rnd = random.Random(seed)
    old = panel(rnd, holes=0.05)
    new = dict(old)
    keys = sorted(old)
    for k in rnd.sample(keys, 4):  # corrections
        new[k] = (new[k][0] and new[k][0] * 2, None, *new[k][2:])
    for k in rnd.sample(keys, 3):
        del new[k]
    for d in range(25):  # appended days of one entity, a new entity, a day before all others
        new["E1", dt.date(2020, 9, 20) + dt.timedelta(days=d)] = tuple(float(d + 1) for _ in COLS)
        new["E9", dt.date(2020, 3, 1) + dt.timedelta(days=d)] = tuple(float(d + 2) for _ in COLS)
    new["E2", dt.date(2019, 12, 30)] = tuple(5.0 for _ in COLS)
    before, now = frame(spark, old), frame(spark, new)
    path = str(tmp_path / "gold")
    incremental.write_gold(features.build_gold(before, cfg), path, cfg)
    changed = incremental.changed_keys(before, now, cfg)
    assert {(r.ticker, r.date) for r in changed.collect()} == {k for k in {*old, *new} if old.get(k) != new.get(k)}
    incremental.update_gold(now, changed, path, cfg)
    same(incremental.read_gold(spark, path), features.build_gold(now, cfg))


def test_a_small_change_reaches_a_few_rows(spark):
    rows = panel(random.Random(3), entities=3, days=400, holes=0)
    df = frame(spark, rows)
    changed = spark.createDataFrame([("E1", dt.date(2020, 7, 1))], "ticker string, date date")
    gold, touched = incremental.recompute(df, changed)
    assert touched.count() == 20 + 1 + 49 and gold.count() == touched.count()
    assert {r.ticker for r in touched.collect()} == {"E1"}


def test_months_without_rows_go(spark, tmp_path):
    rows = panel(random.Random(4), entities=1, days=300, holes=0)
    path = str(tmp_path / "gold")
    incremental.write_gold(features.build_gold(frame(spark, rows)), path)
    rest = {k: v for k, v in rows.items() if k[1] < dt.date(2020, 5, 1)}
    now = frame(spark, rest)
    changed = frame(spark, {k: v for k, v in rows.items() if k not in rest}).select("ticker", "date")
    written = incremental.update_gold(now, changed, path)
    assert max(written) >= 202010
    same(incremental.read_gold(spark, path), features.build_gold(now))
    assert incremental.update_gold(now, changed.limit(0), path) == []
    same(incremental.read_gold(spark, path), features.build_gold(now))

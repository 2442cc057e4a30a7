"""The pipeline stage by stage against plain versions, and the registered queries."""

from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from panelstride.llm import quality
from panelstride.llm.catalog import ORACLES, QUERIES
from panelstride.llm.common import written

from .test_dedup_ops import brute_components, brute_simhash
from .test_layout_ops import brute_mix

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = entry.queries()
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert names["pipeline"].__wrapped__ is corpus_pipeline.run
    assert set(QUERIES) <= set(names) and set(ORACLES) <= set(entry.oracle_sql())
    assert [k for k, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "exact dedup", "SimHash near-dedup", "mixing sources to target weights", "best-fit packing"]


@pytest.fixture(scope="module")
def stages(spark):
    """The rows before the first stage and after each."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = written(stage(spark, docs, SF), f"stage{k}")
        out.append(docs)
    return [x.collect() for x in out], [x.columns for x in out]


def test_columns(stages):
    _, columns = stages
    assert all(c == columns[0] for c in columns[:-1])


def test_quality_stage(spark, stages):
    (docs, kept, *_), _ = stages
    scores = quality.classify(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r.doc_id for r in scores.collect() if r.score >= 0.5}
    assert {r.doc_id for r in kept} == good and len(kept) == len(good)


def test_exact_stage(stages):
    (_, before, after, *_), _ = stages
    want = {}
    for r in before:
        want[r.text or ""] = max(want.get(r.text or "", -1), r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(want.values())


def test_near_stage(stages):
    (_, _, before, after, *_), _ = stages
    found = brute_components({r.doc_id: brute_simhash(r.text) for r in before})
    assert sorted(r.doc_id for r in after) == sorted({root for root in found.values()})


def test_mixing_stage(stages):
    (*_, before, after, _), _ = stages
    _, drawn = brute_mix([(r.doc_id, r.text, r.source) for r in before], 1.5)
    assert Counter(r.doc_id for r in after) == Counter(i for i, _, _ in drawn)
    texts = {r.doc_id: r.text for r in before}
    assert all(r.text == texts[r.doc_id] for r in after)


def test_packing_stage(stages):
    from tokenizers import Tokenizer

    (*_, before, after), _ = stages
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for r in before:
        n = len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1
        want.update((r.doc_id, k, s, min(4096, n - s)) for k, s in enumerate(range(0, n, 4096)))
    assert Counter((r.doc_id, r.piece, r.start, r.length) for r in after) == want
    inside = defaultdict(list)
    for r in after:
        inside[r.sequence_id].append((r.offset, r.length))
    for x in inside.values():
        at = np.cumsum([0, *(n for _, n in sorted(x))])
        assert [o for o, _ in sorted(x)] == at[:-1].tolist() and at[-1] <= 4096
    total = sum(r.length for r in after)
    assert len(inside) <= 1.02 * total / 4096 + 2


def test_odd_documents_pass_all_stages(spark):
    rows = [(1, None, "en", "a", 0, "x"), (2, "", "en", "a", 0, "x"), (3, "w " * 9000, None, None, None, None),
            (3, "w " * 9000, None, None, None, None), (None, "no id at all", "de", "b", 12, "y"), (4, "b", "fr", "b", 1, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string")
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "odd")
    assert docs.count() > 0
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        none = written(stage(spark, none, SF), "none")
    assert none.count() == 0


def test_run_gives_the_stages_rows(spark, stages):
    rows, _ = stages
    got = corpus_pipeline.run(spark, SF)
    assert Counter((r.doc_id, r.piece, r.start, r.length) for r in got.collect()) == Counter(
        (r.doc_id, r.piece, r.start, r.length) for r in rows[-1])

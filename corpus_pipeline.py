"""A corpus pipeline of the operators in ``panelstride.llm``.

``STAGES`` are applied in order to ``documents``; each gets all rows that its
predecessor kept, written as Parquet and read again. All but the last return the
columns of ``documents``:

1. documents that the quality classifier rejects go;
2. of equal texts the one with the largest id stays;
3. of each group of SimHash near-duplicates the one with the smallest id stays;
4. sources are mixed: every document stays, those of small sources may come twice,
   as far as the limit on repetition allows;
5. the rows are packed into sequences: a row for each piece.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers

from panelstride.llm import exact_dedup, mixing, packing, quality, simhash_dedup
from panelstride.llm.common import written
from panelstride.session import ship_package


def _stage(function):
    """The stage, once the executors' Python can import the package."""
    @wraps(function)
    def apply(spark, docs, sf_dir):
        ship_package(spark)
        return function(spark, docs, sf_dir)

    return apply


@_stage
def quality_classifier(spark, docs, sf_dir):
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@_stage
def exact(spark, docs, sf_dir):
    return exact_dedup.drop_exact_duplicates(docs)


@_stage
def near(spark, docs, sf_dir):
    return simhash_dedup.drop_near_duplicates(docs, shingle=3, distance=3)


@_stage
def source_mixing(spark, docs, sf_dir):
    return mixing.mixed_documents(docs, max_epochs=1.5)


@_stage
def best_fit_packing(spark, docs, sf_dir):
    return packing.best_fit_packing(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=1)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact),
    ("SimHash near-dedup", near),
    ("mixing sources to target weights", source_mixing),
    ("best-fit packing", best_fit_packing),
]

#: SQL can't express the learned, SimHash and packing stages; tests/llm compare the
#: pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)

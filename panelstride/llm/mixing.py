"""Mixing sources to target weights by temperature.

A source's weight is its share of all tokens raised to an exponent, normalised: 1
keeps the shares, 0 makes all sources equal. The exponent is found by bisection (31
points of the interval at once, in one aggregate over the table of sources) as the
smallest one that meets a limit on repetition, or the one that gives the weights a
target entropy.

The weights are realised as budgeted block permutations. A source's documents are
repeated in epochs, each a permutation of its own (by a hash of epoch and id), until
the source's token budget is used up; the mixture is cut into blocks, each of which
takes the same share of every source's budget. Running token counts inside a source
come from hash ranges of the permutation: sums of the ranges first, then rows inside
a range, so a source that holds a third of all rows is no larger task than another.

DataFrame functions only: no Python runs on executors.

Defined results: null text counts as empty; a null source is the source named by the
empty string; documents without tokens take no budget; a source without any tokens
has weight 0 and its documents come once; a null id is hashed as the empty string;
repeated rows are drawn as often as they occur; an empty table gives no rows; further
columns of the input are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelstride.llm.common import text_of, written

#: Relative room for rounding when a running count is held against a budget.
ROUNDING = 1e-9
WORD = r"[^\x20\x09-\x0D]+"


def _place(seed: int, epoch: Column, doc: Column) -> Column:
    """A document's place in its epoch's permutation: 32 hex digits."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"),
                             F.coalesce(doc.cast("string"), F.lit(""))).cast("binary"))


def token_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source") -> DataFrame:
    """``doc_id``, ``source``, ``n_tokens`` (words) of every document."""
    return docs.select(F.col(id_col).alias("doc_id"), _source(source_col).alias("source"),
                       F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias("n_tokens"))


def _source(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def exponent(sources: DataFrame, max_epochs: float | None = None, entropy: float | None = None,
             budget_share: float | None = None, highest: float = 1.0, rounds: int = 9) -> float:
    """The smallest exponent in [0, ``highest``] that meets the target, within
    ``highest / 32**rounds``; ``highest`` where none does.

    ``sources`` has ``share`` (above 0, sum 1). ``max_epochs`` limits how often any
    source is repeated; ``entropy`` (nats) is the largest the weights may have, which
    is met with equality where it lies between the ends. ``budget_share`` is the token
    budget over all tokens; None is the smallest with which no source is cut.
    """
    if (max_epochs is None) == (entropy is None):
        raise ValueError("give max_epochs or entropy")
    p, x = F.col("share"), F.col("x")

    def measure(points: list[float]) -> list[bool]:
        rows = (sources.select("share", F.explode(F.array(*map(F.lit, points))).alias("x"))
                .groupBy("x").agg(F.sum(F.pow(p, x)).alias("z"),
                                  F.sum(F.pow(p, x) * F.log(p)).alias("s"),
                                  F.max(F.pow(p, x - 1)).alias("up"),
                                  F.max(F.pow(p, 1 - x)).alias("down")).collect())
        met = {}
        for r in rows:
            if entropy is not None:
                met[r.x] = math.log(r.z) - r.x * r.s / r.z <= entropy
            else:
                most = r.up * r.down if budget_share is None else budget_share * r.up / r.z
                met[r.x] = most <= max_epochs * (1 + ROUNDING)
        return [met.get(x, True) for x in points]

    low, high = 0.0, highest
    if measure([low])[0]:
        return low
    for _ in range(rounds):
        points = [low + (high - low) * k / 32 for k in range(1, 32)]
        met = measure(points)
        first = met.index(True) if True in met else 31
        low, high = (points[first - 1] if first else low), (points[first] if first < 31 else high)
    return high


def weights(tokens: DataFrame, max_epochs: float | None = None, entropy: float | None = None,
            budget_tokens: int | None = None) -> DataFrame:
    """One row per source: ``tokens``, ``share``, ``weight``, ``budget`` (tokens to
    draw), ``epochs`` (how often the source is gone through, whole or not)."""
    sums = written(tokens.groupBy("source").agg(F.sum("n_tokens").alias("tokens")), "sources")
    total = sums.agg(F.sum("tokens")).first()[0] or 0
    some = sums.where("tokens > 0").withColumn("share", F.col("tokens") / F.lit(total))
    x = exponent(some, max_epochs, entropy, budget_tokens / total if budget_tokens and total else None)
    z = some.agg(F.sum(F.pow("share", F.lit(x)))).first()[0] or 1.0
    some = some.withColumn("weight", F.pow("share", F.lit(x)) / F.lit(z))
    if budget_tokens is None:
        budget_tokens = some.agg(F.max(F.col("tokens") / F.col("weight"))).first()[0] or 0.0
    some = some.withColumn("budget", F.col("weight") * F.lit(float(budget_tokens)))
    none = sums.where("tokens = 0").select(
        "source", "tokens", F.lit(0.0).alias("share"), F.lit(0.0).alias("weight"), F.lit(0.0).alias("budget"))
    return written(
        some.select("source", "tokens", "share", "weight", "budget").unionByName(none)
        .withColumn("epochs", F.when(F.col("tokens") > 0, F.col("budget") / F.col("tokens")).otherwise(1.0)),
        "weights")


def draw(tokens: DataFrame, weighted: DataFrame, block_tokens: int = 1_000_000, seed: int = 0,
         range_rows: int = 256) -> DataFrame:
    """One row for every time a document is drawn: ``doc_id``, ``source``,
    ``n_tokens``, ``epoch``, ``place`` (order inside the epoch), ``block``.

    ``tokens`` is read twice and so should be a written table.
    """
    blocks = F.greatest(F.lit(1.0), F.ceil(F.lit(_total(weighted)) / F.lit(float(block_tokens))))
    sized = weighted.join(tokens.groupBy("source").agg(F.count(F.lit(1)).alias("n")), "source").select(
        "source", "tokens", "budget", F.ceil(F.col("epochs") - ROUNDING).cast("int").alias("rounds"),
        F.ceil(F.col("n") / F.lit(range_rows)).cast("long").alias("ranges"))
    rows = (tokens.join(written(sized, "sized"), "source")
            .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.greatest(F.col("rounds"), F.lit(1)) - 1)))
            .withColumn("place", _place(seed, F.col("epoch"), F.col("doc_id")))
            # the place's first 10 digits, dealt to the source's ranges in order
            .withColumn("range", F.floor(F.conv(F.substring("place", 1, 10), 16, 10).cast("double")
                                         * F.col("ranges") / F.lit(float(1 << 40))).cast("long")))
    rows = written(rows, "epochs")
    key = ["source", "epoch", "range"]
    before = Window.partitionBy("source", "epoch").orderBy("range")
    sums = written(rows.groupBy(*key).agg(F.sum("n_tokens").alias("_sum"))
                   .withColumn("_past", F.sum("_sum").over(before) - F.col("_sum")).drop("_sum"), "ranges")
    inside = Window.partitionBy(*key).orderBy("place", "doc_id", "n_tokens").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    end = (F.col("epoch") * F.col("tokens") + F.col("_past") + F.col("_run")).cast("double")
    per_block = F.col("budget") / blocks
    return (rows.withColumn("_run", F.sum("n_tokens").over(inside)).join(sums, key)
            .withColumn("_end", end).where(F.col("_end") <= F.col("budget") * F.lit(1 + ROUNDING))
            .select("doc_id", "source", "n_tokens", "epoch", "place",
                    F.when(F.col("budget") > 0, F.least(
                        F.floor((F.col("_end") - F.col("n_tokens")) / per_block), blocks - 1))
                    .otherwise(0).cast("long").alias("block")))


def _total(weighted: DataFrame) -> float:
    return float(weighted.agg(F.sum("budget")).first()[0] or 0.0)


def mix(docs: DataFrame, max_epochs: float | None = None, entropy: float | None = None,
        budget_tokens: int | None = None, block_tokens: int = 1_000_000, seed: int = 0,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Draw the mixture: the rows of ``draw`` with their source's ``weight``."""
    tokens = written(token_table(docs, id_col, text_col, source_col), "tokens")
    weighted = weights(tokens, max_epochs, entropy, budget_tokens)
    return draw(tokens, weighted, block_tokens, seed).join(weighted.select("source", "weight"), "source")


def mixed_documents(docs: DataFrame, max_epochs: float | None = None, entropy: float | None = None,
                    budget_tokens: int | None = None, seed: int = 0, id_col: str = "doc_id",
                    text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents themselves, each as often as it is drawn, with all their columns.

    A source's last epoch is a prefix of its permutation, so the last place drawn says
    for every document whether it belongs to it: texts are not shuffled.
    """
    tokens = written(token_table(docs, id_col, text_col, source_col), "tokens")
    weighted = weights(tokens, max_epochs, entropy, budget_tokens)
    ends = (draw(tokens, weighted, seed=seed).groupBy("source", "epoch").agg(F.max("place").alias("until"))
            .groupBy("source").agg(F.max_by("until", "epoch").alias("_until"), F.max("epoch").alias("_last"))
            .withColumnRenamed("source", "_source"))
    told = docs.withColumn("_key", _source(source_col)).join(
        written(ends, "ends"), F.col("_key") == F.col("_source"))
    drawn = told.withColumn("_epoch", F.explode(F.sequence(F.lit(0), F.col("_last"))))
    return (drawn.where((F.col("_epoch") < F.col("_last"))
                        | (_place(seed, F.col("_epoch"), F.col(id_col)) <= F.col("_until")))
            .select(*docs.columns))

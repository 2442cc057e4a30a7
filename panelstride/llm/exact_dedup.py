"""Exact duplicates from content-defined chunk recipes.

A text is cut where its own content says so (a local pattern, between a smallest
and a largest chunk length), so equal passages give equal chunks wherever they
stand. Each distinct chunk is moved once, to verify that its identifier belongs to
it alone; from then on a document is its recipe, the ordered list of its chunks'
identifiers, and only recipes are shuffled, grouped and compared.

DataFrame functions only: no Python runs on executors.

Defined results: null text counts as empty; an empty text has the empty recipe and
empty texts are copies of each other; a null id is smaller than any id; of rows
repeated with the same id and text one is kept; an empty table gives no rows;
further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelstride.llm.common import text_of, written

#: A chunk may end behind a vowel, one of these consonants and white space.
CUT = r"(?<=[aeiouAEIOU][nrtsNRTS][\s\p{P}])"


def chunks(text: Column, min_chars: int = 512, max_chars: int = 4096) -> Column:
    """The text's chunks in order; joined they are the text again."""
    pattern = rf"(?s).{{{min_chars},{max_chars}}}?{CUT}|.{{1,{max_chars}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _identifier(chunk: Column, width: int, bits: int) -> list[Column]:
    """``width`` independent hashes of the chunk, ``bits`` bits of each."""
    seeded = [chunk if k == 0 else F.concat(F.lit(f"{k}\x00"), chunk) for k in range(width)]
    return [F.shiftrightunsigned(F.xxhash64(c), 64 - bits) if bits < 64 else F.xxhash64(c)
            for c in seeded]


def verified_width(docs: DataFrame, text: Column, bits: int = 64, max_width: int = 16, **cut) -> int:
    """The smallest number of hashes with which no two different chunks of the corpus
    share an identifier. Each distinct chunk is shuffled once for each width tried;
    with 64 bits one is nearly always enough."""
    for width in range(1, max_width + 1):
        ids = [c.alias(f"id{k}") for k, c in enumerate(_identifier(F.col("chunk"), width, bits))]
        distinct = (docs.select(F.explode(F.array_distinct(chunks(text, **cut))).alias("chunk"))
                    .select(*ids, "chunk").distinct())
        clash = distinct.groupBy(*[f"id{k}" for k in range(width)]).count().where("count > 1")
        if clash.isEmpty():
            return width
    raise RuntimeError("chunk identifiers still clash")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     bits: int = 64, **cut) -> DataFrame:
    """One row per document: ``doc_id``, ``keep_id`` (the largest id among equal
    texts), ``group_size``, ``kept``, ``text_sha256``, ``n_chunks``."""
    src = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    width = verified_width(src, F.col("text"), bits=bits, **cut)
    recipe = F.flatten(F.transform(chunks(F.col("text"), **cut),
                                   lambda c: F.array(*_identifier(c, width, bits))))
    table = written(src.select(
        "doc_id", F.sha2("text", 256).alias("text_sha256"), recipe.alias("recipe"),
        F.monotonically_increasing_id().alias("_row")), "recipes")
    groups = written(
        table.groupBy("recipe").agg(F.max(F.struct("doc_id", "_row")).alias("keep"),
                                    F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
        .select("recipe", F.col("keep.doc_id").alias("keep_id"),
                F.col("keep._row").alias("_keep_row"), "group_size"), "groups")
    alone = F.col("group_size").isNull()
    return table.join(groups, "recipe", "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.when(alone, F.lit(True)).otherwise(F.col("_row") == F.col("_keep_row")).alias("kept"),
        "text_sha256",
        (F.size("recipe") / F.lit(width)).cast("int").alias("n_chunks"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          **options) -> DataFrame:
    """The documents that stay, with all their columns: one row for each distinct text."""
    found = written(exact_duplicates(docs, id_col, text_col, **options)
                    .select("doc_id", "keep_id", "kept", "text_sha256"), "duplicates")
    keep = found.where("kept").select(F.col("doc_id").alias("_keep"), F.col("text_sha256").alias("_same"))
    told = docs.withColumn("_sha", F.sha2(text_of(text_col), 256))
    stay = told.join(keep, F.col(id_col).eqNullSafe(F.col("_keep"))
                     & (F.col("_sha") == F.col("_same")), "left_semi")
    # rows repeated with id and text: rare, so only their own rows are shuffled again
    repeated = found.where(~F.col("kept") & F.col("doc_id").eqNullSafe(F.col("keep_id"))).select(
        F.col("text_sha256").alias("_sha")).distinct()
    if not repeated.isEmpty():
        stay = stay.join(repeated, "_sha", "left_anti").unionByName(
            stay.join(repeated, "_sha", "left_semi").dropDuplicates([id_col, "_sha"]))
    return stay.drop("_sha")

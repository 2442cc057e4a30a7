"""Benchmark decontamination with a distributed positional inverted index.

* ``postings`` stores where each term stands in each training document: a row for each
  token, and one for the end of each document. The table lies document by document, so
  it is made without a shuffle; it may be held to the terms that a test set asks for.
* A window is a run of consecutive words of a test item. Its terms are ranked by how
  often the index has them, rarest first; a window with a term that the index lacks
  can't occur and goes.
* Exact phrases: a posting of a term at the term's place in the window says where the
  window would start. These offset-adjusted lists are intersected from the two rarest
  terms on: both come from one scan of the index, and starts where only one of them
  stands fall away (for the most part before the shuffle, since a document's postings
  lie together). The lists of all other terms are read for what is left alone.
* Proximity: with ``slop`` every term may stand up to so many words before or behind
  its place, counted from the rarest term. Each list is then entered at ``2 slop + 1``
  places, so this is an equality join too.

Everything is DataFrame functions. The terms asked for and the ranked windows are
broadcast only if a count of them says that they are small (``BROADCAST_BYTES``), the
documents with starts left likewise; else Spark shuffles.

Words are lower-cased (A-Z) runs of ASCII letters, digits and characters beyond ASCII.

Defined results: null text has no words and is never contaminated; a null id is kept; a
null item id counts as the empty string; items that share an id are one item with the
windows of all of them; an item without words has no window; rows that share id and
text get the same result each; empty tables give no rows or no hits; further columns of
the inputs are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelstride.llm.common import text_of, written

#: A table is broadcast only up to this size.
BROADCAST_BYTES = 32 << 20
#: Terms no word can be equal to: the end of a document, and of one without an id.
END, END_NULL = " ", "  "
DOC = ["doc_id", "text_hash"]


def small(table: DataFrame, *strings: str) -> DataFrame:
    """``table`` (written) with a broadcast hint if it is known to be small: by its rows,
    up to ten numbers each, and its strings' bytes."""
    size = reduce(lambda a, b: a + b, [F.octet_length(s) for s in strings], F.lit(80))
    found = table.agg(F.sum(size.cast("long"))).first()[0] or 0
    return F.broadcast(table) if found <= BROADCAST_BYTES else table


def split_words(text: Column) -> Column:
    """Words in order, with an empty string at either end where the text begins or ends
    between words."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.split(F.translate(text, upper, upper.lower()), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text: Column) -> Column:
    return F.filter(split_words(text), lambda w: w != "")


def windows(items: DataFrame, size: int = 10, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id`` (string), ``terms``: every run of ``size`` words, or all words if there
    are fewer."""
    w = F.col("_words")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(w) - size + 1))
    return (items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item_id"),
                         words(text_of(text_col)).alias("_words"))
            .where(F.size(w) > 0)
            .select("item_id", F.explode(F.transform(starts, lambda s: F.slice(w, s, size))).alias("terms"))
            .distinct())


def lexicon(asked: DataFrame) -> DataFrame:
    """``term``, ``term_id`` of all terms of windows, and of the two ends."""
    terms = asked.select(F.explode("terms").alias("term")).distinct()
    ends = asked.sparkSession.range(1).select(F.explode(F.array(F.lit(END), F.lit(END_NULL))).alias("term"))
    return written(terms.withColumn("term_id", F.monotonically_increasing_id())
                   .unionByName(ends.withColumn("term_id", F.when(F.col("term") == END, F.lit(-1)).otherwise(F.lit(-2)).cast("long"))),
                   "lexicon")


def postings(docs: DataFrame, terms: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index: ``doc_id``, ``text_hash``, ``pos`` (from 0) and ``term``, or ``term_id``
    if it is held to a ``lexicon``. A document's end has its number of words as ``pos``."""
    text, doc = text_of(text_col), F.col(id_col).cast("long")
    w = F.col("_words")
    lead = (F.element_at(w, 1) == "").cast("int")
    tail = ((F.element_at(w, -1) == "") & (F.size(w) > 1)).cast("int")
    rows = (docs.select(
        F.coalesce(doc, F.lit(-(1 << 63))).alias("doc_id"),
        # equal for equal texts of one id alone, and apart for a null id
        F.xxhash64(text, doc.isNull()).alias("text_hash"),
        F.when(doc.isNull(), F.lit(END_NULL)).otherwise(F.lit(END)).alias("_end"),
        split_words(text).alias("_words"))
        .withColumn("_lead", lead).withColumn("_n", F.size(w) - lead - tail)
        .select(*DOC, "_lead", "_n", F.posexplode(F.concat(w, F.array("_end"))).alias("_at", "term"))
        .where("term <> ''")
        .select(*DOC, F.least(F.col("_at") - F.col("_lead"), F.col("_n")).alias("pos"), "term"))
    if terms is not None:
        rows = rows.join(small(terms, "term"), "term").drop("term")
    return written(rows, "postings")


def ranked_windows(asked: DataFrame, terms: DataFrame, index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The windows that the index may hold, each distinct one once: ``window``, ``rank`` (0
    for the rarest term), ``term_id``, ``offset``, ``n`` (words); and ``window``,
    ``item_id``, ``n``."""
    named = written(asked.groupBy("terms").agg(F.collect_set("item_id").alias("items"))
                    .withColumn("window", F.monotonically_increasing_id())
                    .withColumn("n", F.size("terms")), "windows")
    often = index.groupBy("term_id").agg(F.count(F.lit(1)).alias("often"))
    known = written(terms.join(often, "term_id"), "frequencies")
    found = (named.select("window", "n", F.posexplode("terms").alias("offset", "term"))
             .join(small(known, "term"), "term")
             .groupBy("window", "n").agg(F.array_sort(F.collect_list(F.struct("often", "offset", "term_id"))).alias("_by"))
             .where(F.size("_by") == F.col("n"))
             .select("window", "n", F.posexplode("_by").alias("rank", "_t"))
             .select("window", "rank", "_t.term_id", "_t.offset", "n"))
    return written(found, "ranked"), named.select("window", F.explode("items").alias("item_id"), "n")


def occurrences(index: DataFrame, ranked: DataFrame, slop: int = 0) -> DataFrame:
    """``doc_id``, ``text_hash``, ``window``, ``start``, ``n`` for every place where all of
    a window's terms stand, up to ``slop`` words off their places counted from the rarest."""
    longest = ranked.agg(F.max("n")).first()[0] or 0
    if longest > 62:
        raise ValueError("a window has 62 words at most")
    together = 2 if slop == 0 else 1
    key = [*DOC, "window", "start"]
    bit = F.expr("shiftleft(1L, rank)")

    first = small(written(ranked.where(F.col("rank") < together), "rarest"))
    starts = (index.join(first, "term_id").withColumn("start", F.col("pos") - F.col("offset"))
              .where(F.lit(slop > 0) | (F.col("start") >= 0))
              .groupBy(*key, "n").agg(F.bit_or(bit).alias("_met"))
              .where(F.col("_met") == F.expr(f"shiftleft(1L, least(n, {together})) - 1")).drop("_met"))
    starts = written(starts, "starts")

    later = small(written(ranked.where(F.col("rank") >= together).drop("n"), "later"))
    places = F.sequence(F.lit(-slop), F.lit(slop))
    wanted = (starts.join(later, "window")
              .select(*key, "n", "rank", "term_id", F.explode(F.transform(
                  places, lambda off: F.col("start") + F.col("offset") + off)).alias("pos")))
    at = small(written(starts.select(*DOC).distinct(), "documents"))
    met = (wanted.join(index.join(at, DOC, "left_semi"), [*DOC, "pos", "term_id"])
           .groupBy(*key, "n").agg(F.bit_or(bit).alias("_met"))
           .where(F.col("_met") == F.expr(f"shiftleft(1L, n) - shiftleft(1L, {together})")).drop("_met"))
    return starts.where(F.col("n") <= together).unionByName(met)


def matches(docs: DataFrame, items: DataFrame, size: int = 10, slop: int = 0, id_col: str = "doc_id",
            item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id``, ``doc_id``, ``start``, ``n``: every occurrence of an item's window in a
    document (a null id as the smallest long); with ``slop`` every proximity match."""
    asked = written(windows(items, size, item_col, text_col), "asked")
    terms = lexicon(asked)
    index = postings(docs, terms, id_col, text_col)
    ranked, owners = ranked_windows(asked, terms, index)
    found = occurrences(index, ranked, slop)
    return found.join(owners.drop("n"), "window").select("item_id", "doc_id", "start", "n")


def decontaminate(docs: DataFrame, items: DataFrame, size: int = 10, id_col: str = "doc_id",
                  item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_hit`` (words inside an occurrence
    of a window), ``n_items``, ``items_sha256`` (of their ids, sorted, comma-joined),
    ``contaminated``, ``items``."""
    asked = written(windows(items, size, item_col, text_col), "asked")
    terms = lexicon(asked)
    index = postings(docs, terms, id_col, text_col)
    ranked, owners = ranked_windows(asked, terms, index)
    found = written(occurrences(index, ranked), "occurrences")

    hit = (found.select(*DOC, F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("pos")).distinct()
           .groupBy(*DOC).agg(F.count(F.lit(1)).alias("n_hit")))
    named = (found.select(*DOC, "window").distinct().join(owners.drop("n"), "window")
             .groupBy(*DOC).agg(F.array_sort(F.collect_set("item_id")).alias("items")))
    ends = index.where("term_id < 0").withColumnRenamed("pos", "n_words")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return (ends.join(hit, DOC, "left").join(named, DOC, "left").select(
        F.when(F.col("term_id") == -1, F.col("doc_id")).alias("doc_id"),
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ",").cast("binary"), 256).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
        listed.alias("items")))

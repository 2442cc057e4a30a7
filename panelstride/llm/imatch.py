"""I-Match fingerprints: distinct terms inside a band of inverse document frequency,
sorted, hashed over several randomised subsets of the lexicon.

The lexicon holds the terms that a share of at least ``low`` and at most ``high`` of
all documents contain. A document with ``d`` distinct terms on average gives at most
``d / low`` such terms, whatever the corpus, so the lexicon is bounded and goes into
the plan as a set (and the terms above the band, fewer still, as another). Subset ``i``
holds the lexicon's terms whose MD5 has a zero at hex digit ``i`` (32 subsets of 1/16 of
the lexicon), subset ``32 + i`` those with zeros at digits ``i`` and ``i + 1`` (31 subsets
of 1/256, for long texts). A fingerprint is four hex digits for every subset; likeness is
the share of equal entries among the subsets that either text has an entry of.

An entry hashes all terms that the text has of the subset. Where it has none, one of the
first 32 subsets takes a single term from outside the band, so short texts have a
fingerprint too: terms outside are dealt to these subsets by their MD5, and a subset takes
rare terms before common ones, then the one with the smallest MD5. The rule holds for
each subset by itself, so a term more or less changes the entries it belongs to and no
others. What then has no entry is dots.

DataFrame functions only: no Python runs on executors.

Defined results: null text counts as empty; texts without terms have the fingerprint
of dots and are alike (1.0); the next document is the one with the next larger id
(repeated ids in the order of their texts' hash), after the last the first; a row
without an id has no next document, so its edit only cuts and ``near_next`` is null;
an empty table gives no rows; further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelstride.llm.common import text_of, written

SUBSETS = 63


def terms(text: Column) -> Column:
    """Distinct lower-case runs of letters and digits."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != ""))


def lexicon(docs: DataFrame, low: float, high: float) -> tuple[list[str], list[str]]:
    """Terms of ``docs`` (column ``text``) inside the band, and those above it; bounded, see
    above."""
    n = docs.count()
    found = (docs.select(F.explode(terms(F.col("text"))).alias("t")).groupBy("t").count()
             .where(F.col("count") >= max(1.0, low * n))
             .select("t", (F.col("count") <= high * n).alias("inside")).collect())
    return sorted(r.t for r in found if r.inside), sorted(r.t for r in found if not r.inside)


def _named(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def entries(text: Column, words: list[str], common: list[str]) -> Column:
    """The fingerprint as an array: an entry for each subset."""
    def among(t: Column, some: list[str]) -> Column:
        return t.isin(some) if some else F.lit(False)

    # the zeros of a term's MD5 as bits, the first digit the lowest
    def zero_bits(t: Column) -> Column:
        digits = F.translate(F.md5(t.cast("binary")), "123456789abcdef0", "0000000000000001")
        return F.conv(F.reverse(digits), 2, 10).cast("long")

    def digest(kept: Column) -> Column:
        return F.substring(F.md5(kept.cast("binary")), 1, 4)

    def outside_firsts(outside: Column) -> Column:
        """Of the terms dealt to each subset the first by band and MD5: code -> entry.
        The subset is the MD5's first byte modulo 32. Terms are sorted as texts of subset
        (two characters), band, MD5 and term."""
        def dealt(t: Column) -> Column:
            return _named(F.md5(t.cast("binary")), lambda h: F.concat(
                F.translate(F.substring(h, 1, 1), "0123456789abcdef", "0101010101010101"), F.substring(h, 2, 1),
                F.when(among(t, common), F.lit("2")).otherwise(F.lit("1")), h, t))

        def firsts(told: Column) -> Column:
            return F.filter(told, lambda x, k: (k == 0) | (F.substring(F.get(told, k - 1), 1, 2) != F.substring(x, 1, 2)))

        return F.map_from_entries(F.transform(
            _named(F.sort_array(F.transform(outside, dealt)), firsts), lambda x: F.struct(F.substring(x, 1, 2).alias("code"), digest(x.substr(F.lit(36), F.length(x))).alias("entry"))))

    def hashed(told: Column, firsts: Column) -> Column:
        def entry(kept: Column, other: Column) -> Column:
            return F.when(F.size(kept) == 0, other).otherwise(digest(F.concat_ws(" ", F.transform(kept, lambda x: x.t))))

        def with_bit(terms_: Column, i: Column) -> Column:
            return F.filter(terms_, lambda x: F.getbit(x.m, i) == 1)

        def subset(terms_: Column, i: Column) -> Column:
            code = F.concat(F.floor(i / 16).cast("string"), F.lower(F.hex(i % 16)))
            other = F.coalesce(F.try_element_at(firsts, code), F.lit("...."))
            one = _named(with_bit(terms_, i), lambda some: F.struct(some.alias("some"), entry(some, other).alias("one")))
            return _named(one, lambda o: F.struct(o.one.alias("one"), F.when(F.size(o.some) == 0, F.lit("....")).otherwise(
                _named(with_bit(o.some, i + 1), lambda kept: entry(kept, F.lit("....")))).alias("two")))

        both = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: subset(told, i))
        return _named(both, lambda x: F.concat(F.transform(x, lambda b: b.one),
                                               F.slice(F.transform(x, lambda b: b.two), 1, SUBSETS - 32)))

    def split(told: Column) -> Column:
        inside = F.transform(F.sort_array(F.transform(F.filter(told, lambda x: x["w"]), lambda x: x["t"])),
                             lambda t: F.struct(t.alias("t"), zero_bits(t).alias("m")))
        outside = F.transform(F.filter(told, lambda x: ~x["w"]), lambda x: x["t"])
        return _named(F.struct(inside.alias("inside"), outside_firsts(outside).alias("firsts")),
                      lambda x: hashed(x["inside"], x["firsts"]))

    return _named(F.transform(terms(text), lambda t: F.struct(t.alias("t"), among(t, words).alias("w"))), split)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal entries among those that either has terms of; 1 without any."""
    some = F.size(F.filter(F.arrays_zip(a.alias("a"), b.alias("b")), lambda x: (x.a != "....") | (x.b != "....")))
    same = F.size(F.filter(F.arrays_zip(a.alias("a"), b.alias("b")), lambda x: (x.a == x.b) & (x.a != "....")))
    return F.when(some == 0, F.lit(1.0)).otherwise(same / some)


def next_keys(keys: DataFrame, column: str) -> DataFrame:
    """For each distinct key the next larger one (``next``), after the last the first.

    Keys are dealt to sorted ranges, neighbours are found inside a range, and only one
    row for each range, as many as there are partitions, is ordered as a whole.
    """
    dealt = written(keys.select(F.col(column).alias("key")).distinct().repartitionByRange("key")
                    .withColumn("part", F.spark_partition_id()), "ranges")
    ends = dealt.groupBy("part").agg(F.min("key").alias("low"))
    whole = Window.orderBy("low")
    ends = ends.select("part", F.coalesce(F.lead("low").over(whole), F.first("low").over(
        whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("after"))
    inside = Window.partitionBy("part").orderBy("key")
    return (dealt.withColumn("_next", F.lead("key").over(inside)).join(F.broadcast(ends), "part")  # a row per partition
            .select("key", F.coalesce("_next", "after").alias("next")))


def edited_text(text: Column, after: Column) -> Column:
    """The last quarter of the text replaced by as much of the beginning of ``after``."""
    n = F.char_length(text)
    quarter = F.floor(n / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - quarter), F.substring(after, F.lit(1), quarter))


def fingerprints(docs: DataFrame, low: float = 0.005, high: float = 0.02,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_chars``, ``fingerprint`` of every document."""
    src = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    words, common = lexicon(src, low, high)
    return src.select("doc_id", F.char_length("text").cast("long").alias("n_chars"),
                      F.concat_ws("", entries(F.col("text"), words, common)).alias("fingerprint"))


def edit_likeness(docs: DataFrame, low: float = 0.005, high: float = 0.02,
                  id_col: str = "doc_id", text_col: str = "text", group_ids: int = 256) -> DataFrame:
    """Fingerprints of every document and of its edited text (its last quarter replaced
    from the next document), and how like they are: ``doc_id``, ``n_chars``,
    ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``,
    ``near_next``.

    Texts are shuffled once, by runs of ``group_ids`` consecutive ids; inside a run the
    next text is at hand, and only the runs' first and last texts meet in a join.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    words, common = lexicon(src, low, high)

    def fingerprint(text: Column) -> Column:
        return entries(text, words, common)

    told = src.where("doc_id IS NOT NULL").select(
        "doc_id", "text", fingerprint(F.col("text")).alias("f"),
        F.floor(F.col("doc_id") / group_ids).cast("long").alias("run"))
    run = Window.partitionBy("run").orderBy("doc_id", F.xxhash64("text"))
    near = (told.withColumn("after", F.lead("text").over(run)).withColumn("after_f", F.lead("f").over(run))
            .withColumn("first", F.lag("doc_id").over(run).isNull()))

    def compared(df: DataFrame) -> DataFrame:
        e = df.withColumn("edited", edited_text(F.col("text"), F.col("after")))
        return e.withColumn("ef", F.when(F.col("after").isNotNull(), fingerprint(F.col("edited")))).select(
            "doc_id", F.char_length("text").cast("long").alias("n_chars"),
            F.sha2("edited", 256).alias("edited_sha256"), F.concat_ws("", "f").alias("fingerprint"),
            F.when(F.col("ef").isNotNull(), F.concat_ws("", "ef")).alias("edited_fingerprint"),
            likeness(F.col("f"), F.col("ef")).alias("near_edited"),
            likeness(F.col("f"), F.col("after_f")).alias("near_next"),
            *[c for c in ("run", "first", "text", "f") if c in df.columns])

    last = F.col("edited_fingerprint").isNull()
    table = written(compared(near).withColumn("last", last)
                    .withColumn("text", F.when(F.col("first") | F.col("last"), F.col("text")))
                    .withColumn("f", F.when(F.col("first") | F.col("last"), F.col("f"))), "fingerprints")
    # one first and one last text for each run
    begins = table.where("first").select(F.col("run").alias("next"), F.col("text").alias("after"), F.col("f").alias("after_f"))
    tails = table.where("last").select("doc_id", "text", "f", "run").join(
        next_keys(table.where("first"), "run").withColumnRenamed("key", "run"), "run").join(begins, "next")
    alone = src.where("doc_id IS NULL").select(
        "doc_id", "text", fingerprint(F.col("text")).alias("f"), F.lit("").alias("after"),
        F.lit(None).cast("array<string>").alias("after_f"))
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    no_next = compared(alone).withColumn("near_next", F.lit(None).cast("double"))
    return (table.where(~F.col("last")).select(names)
            .unionByName(compared(tails).select(names)).unionByName(no_next.select(names)))

"""Records of CSV files whose quoted fields may hold line breaks.

A text split knows neither whether it begins inside quotes nor where its last record
ends, so records are found in three steps:

1. Every physical line is a function of one bit: does it end inside quotes if it begins
   outside, and if it begins inside? A line without quotes changes nothing.
2. These functions are composed along each split, and the splits' compositions along
   each file (a row for each split), which gives the bit at the start of every split and
   so at the start of every line. A record begins at each line that begins outside.
3. Lines of one record, in whichever splits they lie, are put together again.

Steps 2 and 3 are taken by the files that have a line left open, other files cost
nothing but a look at their lines' bits. Quotes follow RFC 4180: one at the beginning of
a field opens it, a doubled one inside stands for itself, any other is text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_table

UNCLOSED = "UnclosedQuote: the file ends inside a quoted field"


def physical_lines(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Every line with its file, the block it lies in, its order there and the line break
    behind it (LF, CR LF or CR)."""
    text = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
            .option("lineSep", "\n").text(path))
    crlf = F.col("value").endswith("\r")
    whole = F.when(crlf, F.expr("substring(value, 1, char_length(value) - 1)")).otherwise(F.col("value"))
    last = F.when(crlf, F.lit("\r\n")).otherwise(F.lit("\n"))
    cut = F.split(whole, "\r", -1)  # files with CR alone
    lines = F.transform(cut, lambda v, i: F.struct(
        v.alias("value"), F.when(i + 1 < F.size(cut), F.lit("\r")).otherwise(last).alias("ending")))
    return (text.select(F.explode(F.when(F.contains(whole, F.lit("\r")), lines).otherwise(
        F.array(F.struct(whole.alias("value"), last.alias("ending"))))).alias("line"),
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("source_block"))
        .select("line.value", "line.ending", "path", "source_block",
                F.monotonically_increasing_id().alias("source_row")))


def _ends_inside(pieces: Column, start: Column, sep: str) -> Column:
    """Whether a line is left open. ``pieces`` are the texts between its quotes; the state
    behind each quote and its piece: 0 text, 1 a field may begin, 2 inside quotes, 4 behind
    a quote that closes the field unless another follows."""
    def step(state: Column, piece: Column) -> Column:
        return (F.when(state.isin(1, 4), F.lit(2))
                .when((state == 2) & (piece == ""), F.lit(4))
                .when(piece.endswith(sep), F.lit(1)).otherwise(F.lit(0)))

    return F.aggregate(F.slice(pieces, F.lit(2), F.size(pieces)), start, step) == 2


def line_functions(lines: DataFrame, sep: str) -> DataFrame:
    """Add ``from_out`` and ``from_in``: does the line end inside quotes if it begins
    outside, inside?"""
    pieces, quoted = F.split("value", '"', -1), F.contains(F.col("value"), F.lit('"'))
    first = F.element_at(pieces, 1)
    begin = F.when((first == "") | first.endswith(sep), F.lit(1)).otherwise(F.lit(0))
    return lines.withColumns({"from_out": F.when(quoted, _ends_inside(pieces, begin, sep)).otherwise(F.lit(False)),
                              "from_in": F.when(quoted, _ends_inside(pieces, F.lit(2), sep)).otherwise(F.lit(True))})


def _composed(df: DataFrame, window) -> DataFrame:
    """Add ``__odd`` and ``__base``: the functions up to each row, composed, map a bit ``x``
    to ``coalesce(__base, x) xor __odd``. Rows that map both bits to one set the base,
    rows that exchange them flip the parity."""
    flips = (F.col("from_out") & ~F.col("from_in")).cast("int")
    odd = df.withColumn("__odd", F.pmod(F.sum(flips).over(window), F.lit(2)) == 1)
    fixed = F.when(F.col("from_out") == F.col("from_in"), F.col("from_out") != F.col("__odd"))
    return odd.withColumn("__base", F.last(fixed, ignorenulls=True).over(window))


def _after(start: Column) -> Column:
    return F.coalesce(F.col("__base"), start) != F.col("__odd")


def _assembled(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records of ``lines`` (with their functions), and the files that end inside quotes."""
    split = ["path", "source_block"]
    along = Window.partitionBy(*split).orderBy("source_row")
    files = Window.partitionBy("path").orderBy("source_block")
    earlier = files.rowsBetween(Window.unboundedPreceding, -1)
    inside = shared_table(_composed(lines, along), "csv_states")

    ends = (inside.groupBy(*split).agg(F.max_by(F.struct("__base", "__odd"), "source_row").alias("f"))
            .select(*split, F.col("f.__base").alias("__base"), F.col("f.__odd").alias("__odd")))
    ends = ends.select(*split, _after(F.lit(False)).alias("from_out"), _after(F.lit(True)).alias("from_in"))
    states = (_composed(ends, files).withColumn("__end", _after(F.lit(False)))
              .select(*split, "__end", F.lag("__end", 1, False).over(files).alias("__start")))
    unclosed = states.groupBy("path").agg(F.max_by("__end", "source_block").alias("open")).where("open").select("path")

    known = (inside.join(states.drop("__end"), split).withColumn("__after", _after(F.col("__start")))
             .withColumn("__before", F.coalesce(F.lag("__after").over(along), F.col("__start")))
             .withColumn("__record", F.last(F.when(~F.col("__before"), F.col("source_row")), ignorenulls=True).over(along)))
    known = shared_table(known.drop("__base", "__odd", "from_out", "from_in", "__start"), "csv_lines_known")
    # a split that begins inside a record belongs to the last record begun before it
    begun = (known.groupBy(*split).agg(F.max_by("__record", "source_row").alias("__r"))
             .select(*split, F.last("__r", ignorenulls=True).over(earlier).alias("__carried")))
    alone = known.where(~F.col("__before") & ~F.col("__after"))
    several = (known.where(F.col("__before") | F.col("__after")).join(begun, split)
               .withColumn("__record", F.coalesce("__record", "__carried")))
    parts = F.array_sort(F.collect_list(F.struct("source_block", "source_row", "value", "ending")))
    joined = several.groupBy("path", "__record").agg(parts.alias("p"))
    text = F.array_join(F.transform("p", lambda x, i: F.when(i + 1 < F.size("p"), F.concat(x["value"], x["ending"]))
                                    .otherwise(x["value"])), "")
    first = F.element_at("p", 1)
    columns = ["value", "path", "source_block", "source_row"]
    records = alone.select(*columns).unionByName(joined.select(
        text.alias("value"), "path", first["source_block"].alias("source_block"), first["source_row"].alias("source_row")))
    return records.join(unclosed, "path", "left_anti"), unclosed


def csv_records(spark: SparkSession, path: str, pattern: str, sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """``(records, unclosed)``: ``value``, ``path``, ``source_block``, ``source_row`` (of the
    record's first line), and ``path`` of files that end inside a quoted field, of which
    no record is given."""
    lines = shared_table(line_functions(physical_lines(spark, path, pattern), sep), "csv_lines")
    opened = shared_table(lines.where("from_out").select("path").distinct(), "csv_opened")
    plain = lines.join(opened, "path", "left_anti").select("value", "path", "source_block", "source_row")
    if opened.isEmpty():
        return plain, opened
    records, unclosed = _assembled(lines.join(opened, "path", "left_semi"))
    unclosed = shared_table(unclosed, "csv_unclosed")
    return shared_table(plain.unionByName(records), "csv_records"), unclosed

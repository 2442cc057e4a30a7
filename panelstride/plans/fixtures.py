"""Panel-shaped inputs derived from the given TPC-H-style tables.

The source pipeline reads per-security files that are not available; these
builders derive equivalent inputs from ``lineitem``, ``orders``, ``supplier``,
``customer`` and ``part`` so that every query's work grows with those tables.

Plan notes (scale):
* ``lineitem`` is scanned once: its exact decimal sums per (supplier, day), a plain
  hash aggregate with map-side partial aggregation, are written to shared storage and
  summed again per day for the market series.
* All joins are left to Catalyst and AQE, which broadcast only under the measured
  threshold.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import entity_from_filename
from ..session import shared_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _dec(c) -> F.Column:
    return F.col(c).cast("decimal(18,2)")


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver-shaped daily panel: one row per (supplier name, ship day)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        F.to_date("l_shipdate").alias("date"),
        _dec("l_extendedprice").alias("p"),
        _dec("l_quantity").alias("q"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("u"),
    )
    sums = shared_table(li.groupBy("l_suppkey", "date").agg(
        F.sum("p").alias("p"), F.sum("q").alias("q"), F.count(F.lit(1)).alias("n"),
        F.min("u").alias("min_price"), F.max("u").alias("max_price")), "supplier_days")
    per_day = sums.select(
        "l_suppkey", "date", "min_price", "max_price",
        (F.col("p").cast("double") / F.col("q").cast("double")).alias("close"),
        (F.col("p").cast("double") / F.col("n")).alias("avg_price"),
        F.col("q").cast("double").alias("volume"))
    market = sums.groupBy("date").agg(
        (F.sum("p").cast("double") / F.sum("q").cast("double")).alias("bist100"))
    fx = (
        table(spark, sf_dir, "orders")
        .select(F.to_date("o_orderdate").alias("date"), _dec("o_totalprice").alias("t"))
        .groupBy("date")
        .agg((F.sum("t").cast("double") / F.count(F.lit(1)) / 100000).alias("usdtry"))
    )
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("ticker"),
        F.col("s_acctbal").alias("capital_mn_tl"))
    cap = F.col("close") * F.col("capital_mn_tl")
    return (
        per_day.join(market, "date")
        .join(supplier, "l_suppkey")
        .join(fx, "date", "left")
        .select(
            "date", "close", "min_price", "max_price", "avg_price", "volume", "capital_mn_tl",
            "usdtry", "bist100",
            cap.alias("market_cap_mn_tl"),
            (cap / F.col("usdtry")).alias("market_cap_mn_usd"),
            (cap / 2).alias("free_float_market_cap_mn_tl"),
            (cap / F.col("usdtry") / 2).alias("free_float_market_cap_mn_usd"),
            "ticker",
        )
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped rows with messy text: day-first date text (with an impossible
    date on every seventh line), decimal-comma prices and a file name per row."""
    li = table(spark, sf_dir, "lineitem")
    day_text = F.when(F.col("l_linenumber") == 7, F.lit("31-31-2020")).otherwise(
        F.date_format("l_shipdate", "dd-MM-yyyy"))
    price_text = F.replace(_dec("l_extendedprice").cast("string"), F.lit("."), F.lit(","))
    letter = F.char(F.lit(65) + F.col("l_suppkey") % 26)
    source_file = F.concat(F.lit("SUP"), letter, F.lit("2011010120260422.xlsx"))
    return li.select(
        day_text.alias("tarih"),
        price_text.alias("kapanis_tl"),
        source_file.alias("source_file"),
        entity_from_filename(source_file).alias("ticker"),
        "l_suppkey", "l_orderkey", "l_linenumber",
    )


def _workbook(header: list[str], rows: list[tuple]) -> bytes:
    """A flat workbook of text cells: the least that the format asks for."""
    def line(n: int, values) -> str:
        cells = "".join([f'<c r="{chr(65 + i)}{n}" t="inlineStr"><is><t>{v}</t></is></c>' for i, v in enumerate(values) if v is not None])
        return f'<row r="{n}">{cells}</row>'

    space = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    body = "".join(line(n, values) for n, values in enumerate([header, *rows], 1))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f'<workbook {space}><sheets><sheet name="S" sheetId="1"/></sheets></workbook>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {space}><sheetData>{body}</sheetData></worksheet>")
    return out.getvalue()


def workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(path, content)`` of workbooks made in tasks from the bronze rows: one for each
    source file and 500 orders (so of bounded size), every ninth cut off in the middle."""
    header = ["Tarih", "Kapanış(TL)", "l_suppkey", "l_orderkey", "l_linenumber"]
    fields = ["tarih", "kapanis_tl", "l_suppkey", "l_orderkey", "l_linenumber"]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):  # a few workbooks at a time
                some, contents = batch.slice(start, 64), []
                for cut, *columns in zip(*(some.column(c).to_pylist() for c in ("cut", *fields))):
                    data = _workbook(header, list(zip(*columns)))
                    contents.append(data[:len(data) // 2] if cut else data)
                yield pa.RecordBatch.from_arrays([some.column("path"), pa.array(contents, pa.binary())], names=["path", "content"])

    part = F.floor(F.col("l_orderkey") / 500).cast("long")
    book = F.replace("source_file", F.lit(".xlsx"), F.concat(F.lit("_"), part.cast("string"), F.lit(".xlsx")))
    rows = bronze(spark, sf_dir).withColumns({"part": part, "book": book}).where(F.col("book").isNotNull())
    cut = (F.col("part") + F.col("l_suppkey") % 26) % 9 == 0  # the same in all rows of a book
    books = rows.groupBy("book").agg(F.first(cut).alias("cut"), F.collect_list(F.struct(*fields)).alias("rows"))
    return books.select(F.concat(F.lit("memory/"), "book").alias("path"), "cut", *[F.col(f"rows.{c}").alias(c) for c in fields]
                        ).mapInArrow(make, "path string, content binary")


# Text that is no number: two words, then forms that some parsers accept.
JUNK_NUMBERS = ("nan", "None", "12d", "1.5f", "0x1p3", "1e", "--1")


def bronze_number_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number text in the shapes found in exported workbooks, one shape per line
    number: decimal comma, padded with blanks and no-break spaces, with both
    separators, the words ``nan``/``None``, empty, and plain."""
    li = table(spark, sf_dir, "lineitem")
    plain = _dec("l_extendedprice").cast("string")
    comma = F.replace(plain, F.lit("."), F.lit(","))
    shape = F.col("l_linenumber")
    text = (
        F.when(shape == 1, comma)
        .when(shape == 2, F.concat(F.lit("\u00a0"), plain, F.lit(" ")))
        .when(shape == 3, F.concat(F.lit("1."), comma))
        .when(shape == 4, F.element_at(F.array(*map(F.lit, JUNK_NUMBERS)),
                                       (F.col("l_orderkey") % len(JUNK_NUMBERS) + 1).cast("int")))
        .when(shape == 5, F.lit(""))
        .when(shape == 6, F.concat(F.lit("\u00a0 "), comma))
        .otherwise(plain)
    )
    return li.select("l_orderkey", "l_linenumber", text.alias("raw_value"))


def date_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date text in several shapes, one per line number: day-first with dashes,
    ISO, dotted, slashed without padding, with a time of day, junk, impossible."""
    li = table(spark, sf_dir, "lineitem")
    d = F.col("l_shipdate")
    n = F.col("l_linenumber")
    text = (
        F.when(n == 1, F.date_format(d, "dd-MM-yyyy"))
        .when(n == 2, F.date_format(d, "yyyy-MM-dd"))
        .when(n == 3, F.date_format(d, "dd.MM.yyyy"))
        .when(n == 4, F.concat_ws("/", F.dayofmonth(d), F.month(d), F.year(d)))
        .when(n == 5, F.when(F.col("l_orderkey") % 2 == 0, F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss"))
              .otherwise(F.concat(F.date_format(d, "dd-MM-yyyy"), F.lit(" 00:00:00"))))
        .when(n == 6, F.when(F.col("l_orderkey") % 2 == 0, F.date_format(d, "yyyy/MM/dd")).otherwise(F.lit("n/a")))
        .otherwise(F.lit("31-31-2020"))
    )
    return li.select("l_orderkey", "l_linenumber", text.alias("raw_date"))


# Header text samples: raw workbook headers (fixed fixture values), picked per
# part and suffixed with the part's brand on two rows out of three.
RAW_HEADERS = (
    "Tarih", "Kapanış(TL)", "Min(TL)", "Max(TL)", "AOF(TL)", "Hacim(TL)",
    " Halkaaçık PD(mn TL)", "İşlem Ğ", "PiyasaDeğeri(mn USD)", "BIST 100", "USDTRY",
    "Sermaye(mn TL)", "PD/DD",
    # accents as marks of their own, white space of other kinds at the ends
    "PiyasaDeg\u0306eri(mn TL)", "Tarih\n", "\u00a0Kapanış(TL)\t", "İs\u0327lem", "BIST\u00a0100",
)


def header_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    pick = F.element_at(F.array(*[F.lit(h) for h in RAW_HEADERS]),
                        (F.col("p_partkey") % len(RAW_HEADERS) + 1).cast("int"))
    text = F.when(F.col("p_size") % 3 == 0, pick).otherwise(F.concat(pick, F.lit(" "), F.col("p_brand")))
    return part.select("p_partkey", text.alias("raw_header"))


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workbook-like file names: segment + date range (letters lead) from customer,
    bare numbers from part (no leading letters)."""
    a = table(spark, sf_dir, "customer").select(
        F.lit("customer").alias("origin"),
        F.concat(F.lit("raw/"), F.col("c_mktsegment"), F.lit("2011010120260422.xlsx")).alias("file_name"))
    b = table(spark, sf_dir, "part").select(
        F.lit("part").alias("origin"),
        F.concat(F.col("p_partkey").cast("string"), F.lit(".xlsx")).alias("file_name"))
    return a.unionByName(b)


# Raw workbook headers of the panel's columns (fixed fixture values), in the
# order of ``panel``'s columns.
RAW_PANEL_HEADERS = {
    "date": "Tarih",
    "close": "Kapanış(TL)",
    "min_price": "Min(TL)",
    "max_price": "Max(TL)",
    "avg_price": "AOF(TL)",
    "volume": "Hacim(TL)",
    "capital_mn_tl": "Sermaye(mn TL)",
    "usdtry": "USDTRY",
    "bist100": "BIST 100",
    "market_cap_mn_tl": "PiyasaDeğeri(mn TL)",
    "market_cap_mn_usd": "PiyasaDeğeri(mn USD)",
    "free_float_market_cap_mn_tl": "HalkaAçık PD(mn TL)",
    "free_float_market_cap_mn_usd": "HalkaAçık PD(mn USD)",
}


def raw_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel as raw workbook text: source header names, day-first dates and
    decimal-comma numbers, plus the entity and file name columns ingest adds."""
    p = panel(spark, sf_dir)
    cols = [F.date_format("date", "dd-MM-yyyy").alias(RAW_PANEL_HEADERS["date"])]
    for name, header in RAW_PANEL_HEADERS.items():
        if name != "date":
            cols.append(F.replace(F.col(name).cast("string"), F.lit("."), F.lit(",")).alias(header))
    return p.select(*cols, "ticker", F.concat("ticker", F.lit(".xlsx")).alias("source_file"))

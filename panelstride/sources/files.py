"""Directory ingest: one file per entity, entity key in the file name.

* CSV: lines are read by Spark's text source, from whatever storage it reads, with the
  file each line lies in, and put together to records where quoted fields hold line
  breaks (``csv_records``); a file's first record is its header. Values find their
  columns by the (normalised) names of their own file's header, so files of any layouts
  stack by name, and only the distinct headers come to the driver.
* Workbooks (``.xlsx``): ``binaryFile`` + ``mapInPandas``, one decode per file
  inside the tasks. Each sheet row becomes a ``map<header, text>``, so
  workbooks with different headers stack by name without a schema pass.
* Both return ``(data, errors)``: files that give no rows for a reason become rows of
  ``errors`` (``source_file``, ``error``) instead of failing the job.

``source_block`` and ``source_row`` keep a row's place in its file.
"""

from __future__ import annotations

import csv
import functools
import io
import re
import zipfile
from collections.abc import Iterator
from datetime import date, timedelta
from xml.etree import ElementTree as ET

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import entity_from_filename, header_name, header_name_dictionary
from ..session import shared_table
from .csv_records import UNCLOSED, csv_records

HEADER_RULES = {"generic": header_name, "dictionary": header_name_dictionary}


def list_files(spark: SparkSession, path: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """``(path, length, modificationTime, file_path)`` of the matching files (the last as
    ``_metadata`` has it); no content is read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", str(recursive).lower()).load(path)
            .select("path", "length", "modificationTime", "_metadata.file_path"))


def _name_from(path: Column, entity_from: str) -> Column:
    """``file``: the file's name; ``directory``: the folder's (``key=NAME`` or ``NAME``)."""
    if entity_from == "directory":
        return F.regexp_extract(path, r"([^/=]+)/[^/]*$", 1)
    return F.substring_index(path, "/", -1)


def ingest_csv(spark: SparkSession, path: str, pattern: str = "*.csv", sep: str = ",",
               header_rule: str = "generic", entity_from: str = "file") -> tuple[DataFrame, DataFrame]:
    """Stack every CSV under ``path``; columns by (normalised) header name, text kept
    as text; ``source_file`` and ``ticker`` from the file name (S1-S5, U1).

    Headers of one file that normalise alike are one column, the first value that is
    there. ``entity_from="directory"`` takes the name from the parent folder
    (``.../key=NAME/part-0.csv`` or ``.../NAME/part-0.csv``). Quoted fields may hold
    separators, line breaks of any kind and doubled quotes. Files without a header line
    (Spark's sources pass over files of no bytes at all) and files that end inside
    quotes are in the second result."""
    lines, unclosed = csv_records(spark, path, pattern, sep)
    first = lines.where((F.col("source_block") == 0) & (F.trim("value") != ""))
    headers = shared_table(
        first.groupBy("path").agg(F.min_by("value", "source_row").alias("header"), F.min("source_row").alias("__first"))
        .withColumn("header", F.regexp_replace("header", "^\ufeff", "")), "csv_headers")
    listed = list_files(spark, path, pattern).select(F.col("file_path").alias("path"))
    name = _name_from(F.col("path"), entity_from).alias("source_file")
    errors = (listed.join(headers, "path", "left_anti").join(unclosed, "path", "left_anti")
              .select(name, F.lit("EmptyFile: no header line").alias("error"))
              .unionByName(unclosed.select(name, F.lit(UNCLOSED).alias("error"))))

    layouts = [r["header"] for r in headers.select("header").distinct().collect()]  # one for each layout
    if not layouts:
        if errors.isEmpty():
            raise FileNotFoundError(f"no files matching {pattern} under {path}")
        return spark.createDataFrame([], "source_file string, ticker string"), errors
    rule = HEADER_RULES[header_rule]
    names = {h: [rule(c) or f"column_{i}" for i, c in enumerate(next(csv.reader([h], delimiter=sep)))] for h in layouts}
    width = max(map(len, names.values()))
    columns = [c for c in dict.fromkeys(c for h in sorted(names) for c in names[h]) if c not in ("source_file", "ticker")]
    places = {h: {c: [i for i, n in enumerate(names[h]) if n == c] for c in columns} for h in layouts}
    slots = [(c, k) for c in columns for k in range(max(len(p[c]) for p in places.values()))]
    known = spark.createDataFrame(  # as many as layouts; where each column's values stand in a record
        [(h, [p[c][k] if k < len(p[c]) else None for c, k in slots]) for h, p in places.items()], "header string, at array<int>")
    values = F.from_csv("value", ", ".join(f"c{i} string" for i in range(width)),
                        {"sep": sep, "escape": '"', "multiLine": "true"})
    rows = (lines.join(headers, "path").join(known, "header")
            .where((F.col("source_row") != F.col("__first")) & (F.trim("value") != ""))
            .withColumn("__v", values)
            .withColumn("__cells", F.array(*[F.col(f"__v.c{i}") for i in range(width)])))

    def cell(c: str) -> Column:
        return F.coalesce(*[F.get("__cells", F.get("at", F.lit(j))) for j, (x, _) in enumerate(slots) if x == c]).alias(c)

    data = rows.select(*map(cell, columns), name, "source_block", "source_row")
    return data.withColumn("ticker", entity_from_filename(F.col("source_file"))), errors


def ingest_files(spark: SparkSession, path: str, fmt: str = "xlsx", **options) -> tuple[DataFrame, DataFrame]:
    """``(data, errors)`` of all files of a format (``csv`` or ``xlsx``) under ``path``."""
    return {"csv": ingest_csv, "xlsx": ingest_workbooks}[fmt](spark, path, **options)


# ------------------------------------------------------------------ workbooks

_C, _V, _T = (f"{{http://schemas.openxmlformats.org/spreadsheetml/2006/main}}{x}" for x in "cvt")
_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_DATE_FMT_IDS = set(range(14, 23)) | {45, 46, 47}


def _col_index(ref: str) -> int:
    return _letters_index(ref.rstrip("0123456789"))


@functools.lru_cache(maxsize=1 << 15)  # a sheet has 16,384 columns
def _letters_index(letters: str) -> int:
    n = 0
    for ch in re.match(r"[A-Z]+", letters).group(0):
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _excel_date(serial: float) -> str:
    """A date-formatted cell as day-first text, the form the silver step parses
    (strict ``dd-MM-yyyy``), so true date cells and date text land alike."""
    return (date(1899, 12, 30) + timedelta(days=int(float(serial)))).strftime("%d-%m-%Y")


def _elements(z: zipfile.ZipFile, name: str, tag: str, parent: str) -> Iterator[ET.Element]:
    """The elements ``tag`` below ``parent``, one after the other; each is forgotten before
    the next one is read."""
    tag, parent = f"{{{_NS['m']}}}{tag}", f"{{{_NS['m']}}}{parent}"
    holder = None
    with z.open(name) as f:
        for event, el in ET.iterparse(f, events=("start", "end")):
            if event == "start" and el.tag == parent:
                holder = el
            elif event == "end" and el.tag == tag:
                yield el
                if holder is not None:
                    holder.clear()


def _text_of(el: ET.Element) -> str:
    return "".join([t.text or "" for t in el.iter(_T)])


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    """Places of the cell formats that show a date."""
    if "xl/styles.xml" not in z.namelist():
        return set()
    st = ET.fromstring(z.read("xl/styles.xml"))
    custom = {int(f.get("numFmtId")): f.get("formatCode", "") for f in st.findall("m:numFmts/m:numFmt", _NS)}
    out = set()
    for i, xf in enumerate(st.findall("m:cellXfs/m:xf", _NS)):
        fid = int(xf.get("numFmtId", "0"))
        code = custom.get(fid, "").lower()
        if fid in _DATE_FMT_IDS or ("y" in code and "d" in code):
            out.add(i)
    return out


def _first_sheet(z: zipfile.ZipFile) -> str:
    first = ET.fromstring(z.read("xl/workbook.xml")).find("m:sheets/m:sheet", _NS)
    if first is not None and "xl/_rels/workbook.xml.rels" in z.namelist():
        for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels")):
            if r.get("Id") == first.get(_REL):
                target = r.get("Target").lstrip("/")
                return target if target.startswith("xl/") else f"xl/{target}"
    return "xl/worksheets/sheet1.xml"


def _cells(row: ET.Element, shared: list[str], dates: set[int]) -> list[str | None]:
    values: dict[int, str | None] = {}
    for c in row.findall(_C):
        kind = c.get("t")
        if kind == "inlineStr":
            values[_col_index(c.get("r"))] = _text_of(c)
            continue
        v, style = c.find(_V), int(c.get("s", "0"))
        if kind == "s" and v is not None:
            text = shared[int(v.text)]
        elif v is None:
            text = None
        elif kind is None and style in dates:
            text = _excel_date(v.text)
        else:
            text = v.text
        values[_col_index(c.get("r"))] = text
    return [values.get(i) for i in range(max(values) + 1 if values else 0)]


def iter_xlsx(data: bytes) -> Iterator[dict[str, str | None]]:
    """First sheet of a workbook as ``{header: text}`` rows (flat sheets only), read row by
    row: what is held at a time is the file, its shared strings and one row."""
    z = zipfile.ZipFile(io.BytesIO(data))
    shared = []
    if "xl/sharedStrings.xml" in z.namelist():
        shared = [_text_of(si) for si in _elements(z, "xl/sharedStrings.xml", "si", "sst")]
    dates = _date_styles(z)
    header: list[str] | None = None
    for row in _elements(z, _first_sheet(z), "row", "sheetData"):
        cells = _cells(row, shared, dates)
        if header is None:
            header = []
            for i, h in enumerate(cells):
                name = str(h) if h is not None else f"column_{i}"
                same = sum(x == name or x.startswith(f"{name}.") and x[len(name) + 1:].isdigit() for x in header)
                header.append(f"{name}.{same}" if same else name)  # a repeated header stays a column of its own
        else:
            yield {h: (cells[i] if i < len(cells) else None) for i, h in enumerate(header)}


def decode_xlsx(data: bytes) -> list[dict[str, str | None]]:
    """All rows of :func:`iter_xlsx`."""
    return list(iter_xlsx(data))


WORKBOOK_ROWS = "source_file string, row_number int, cells map<string,string>, error string"
#: Rows of a sheet that a task holds at a time.
SHEET_ROWS = 5000


_WORKBOOK_ARROW = pa.schema([("source_file", pa.string()), ("row_number", pa.int32()),
                             ("cells", pa.map_(pa.string(), pa.string())), ("error", pa.string())])


def _sheet_batch(part: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), f.type) for c, f in zip(zip(*part), _WORKBOOK_ARROW)], schema=_WORKBOOK_ARROW)


def _decode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part: list[tuple] = []  # rows of one workbook or of many small ones
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content")):
            name = path.as_py().rsplit("/", 1)[-1]
            try:
                for i, cells in enumerate(iter_xlsx(content.as_py())):
                    part.append((name, i, list(cells.items()), None))
                    if len(part) == SHEET_ROWS:
                        yield _sheet_batch(part)
                        part = []
            except Exception as e:  # noqa: BLE001 - a bad file becomes an error row (S4)
                part.append((name, -1, None, f"{type(e).__name__}: {e}"))
    if part:
        yield _sheet_batch(part)


def decode_workbooks(raw: DataFrame) -> DataFrame:
    """``(path, content)`` -> a row for each sheet row, and one for each file that fails
    (whose rows before the failure count for nothing)."""
    return raw.select("path", "content").mapInArrow(_decode_batches, WORKBOOK_ROWS)


def read_workbooks(spark: SparkSession, path: str, pattern: str = "*.xlsx") -> DataFrame:
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", "true").load(path).select("path", "content"))


def ingest_workbooks(spark: SparkSession, path: str | DataFrame, pattern: str = "*.xlsx",
                     header_rule: str = "generic") -> tuple[DataFrame, DataFrame]:
    """Workbooks -> bronze: one column per (normalised) header found, union by name;
    ``ticker`` and ``source_file`` from the file name. ``path`` is a folder or a frame
    of ``(path, content)``. Every workbook is decoded once. Returns ``(bronze, errors)``."""
    raw = path if isinstance(path, DataFrame) else read_workbooks(spark, path, pattern)
    decoded = shared_table(decode_workbooks(raw), "workbook_rows")
    errors = decoded.where("error IS NOT NULL").select("source_file", "error")
    rows = decoded.where("error IS NULL").join(errors.select("source_file"), "source_file", "left_anti")
    keys = [r["k"] for r in rows.select(F.explode(F.map_keys("cells")).alias("k")).distinct().collect()]
    if not keys and errors.isEmpty():
        raise FileNotFoundError(f"no workbooks matching {pattern} under {path}")
    cols = {}
    for k in sorted(keys):
        cols.setdefault(HEADER_RULES[header_rule](k), []).append(F.col("cells").getItem(k))
    bronze = rows.select(*[F.coalesce(*v).alias(n) for n, v in cols.items()],
                         "source_file", F.lit(0).cast("long").alias("source_block"),
                         F.col("row_number").cast("long").alias("source_row"),
                         entity_from_filename(F.col("source_file")).alias("ticker"))
    return bronze, errors

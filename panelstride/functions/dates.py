"""Date columns whose one format is told by their first value (P5).

``guess_date_format`` reads a format off one text; ``infer_date_format`` finds a column's
first value in a given order (one aggregate, one row to the driver); ``parse_date_as``
parses strictly by that format and gives null for everything else. So a column is never
read half day-first and half month-first, as it can be when every value is tried alone.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._cols import as_col
from .text import parse_date_lenient, strip_space

# English month names.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october",
          "november", "december")

#: What a part of a format matches, without anchors.
_MATCH = {"year": r"(?!0000)\d{4}", "month": r"1[0-2]|0?[1-9]", "day": r"3[01]|[12]\d|0?[1-9]",
          "full": "|".join(MONTHS), "short": "|".join(m[:3] for m in MONTHS),
          "month2": r"1[0-2]|0[1-9]", "day2": r"3[01]|[12]\d|0[1-9]"}
_CLOCK = r"(?:2[0-3]|[01]?\d):[0-5]?\d"
_HALF_CLOCK = r"(?:1[0-2]|0?[1-9]):[0-5]?\d"
_SECONDS = r":[0-5]?\d"
_FRACTION = r"\.\d{1,9}"
_ZONE = r"(?:Z|[+-]\d\d:?[0-5]\d)"

#: A text's date and, behind white space or a T, its time of day.
_SHAPE = re.compile(r"""(?P<date>.*?)
    (?:(?P<gap>T|\s+)(?P<clock>\d{1,2}:\d\d)(?P<seconds>:\d\d)?(?P<fraction>\.\d{1,9})?
       (?P<half>\s*[AaPp][Mm])?(?P<zone>Z|[+-]\d\d:?\d\d)?)?""", re.VERBOSE)


@dataclass(frozen=True)
class DateFormat:
    """``parts`` of the date in order (``year``, ``month``, ``day``, ``full``, ``short`` or
    literal text) and a pattern of what stands behind it."""

    parts: tuple[tuple[str, str], ...]
    tail: str = ""

    @property
    def pattern(self) -> str:
        return "^" + "".join(re.escape(text) if kind == "text" else f"({_MATCH[kind]})" for kind, text in self.parts) + self.tail + "$"

    @property
    def kinds(self) -> list[str]:
        return [kind for kind, _ in self.parts if kind != "text"]


def _numeric_order(numbers: list[str], day_first: bool) -> tuple[str, ...] | None:
    """Which of three numbers is what."""
    if len(numbers[0]) == 4 and max(map(len, numbers[1:])) <= 2:
        return ("year", "month", "day") if int(numbers[1]) <= 12 else None
    if len(numbers[2]) != 4 or max(map(len, numbers[:2])) > 2:
        return None
    a, b = int(numbers[0]), int(numbers[1])
    if a > 12 and b > 12:
        return None
    if a > 12 or (day_first and b <= 12):
        return ("day", "month", "year")
    return ("month", "day", "year")


def _real_date(parts: list[tuple[str, str]], tokens: list[str]) -> bool:
    found = {kind: token for (kind, _), token in zip(parts, tokens, strict=True)}
    name = found.get("full", found.get("short"))
    month = [m[:3] for m in MONTHS].index(name[:3].lower()) + 1 if name else int(found.get("month", found.get("month2")))
    try:
        date(int(found["year"]), month, int(found.get("day", found.get("day2"))))
    except ValueError:
        return False
    return True


def guess_date_format(text: str | None, day_first: bool = False) -> DateFormat | None:
    """The format of one text, or None where it has none that is clear: four-digit years,
    months as numbers or English names, an optional time of day. Of two numbers that
    could both be the month the first is, unless ``day_first``."""
    shape = _SHAPE.fullmatch((text or "").strip())
    if not shape or not shape["date"]:
        return None
    tokens = re.findall(r"\d+|[A-Za-z]+|[^\dA-Za-z]+", shape["date"])
    numbers = [t for t in tokens if t.isdigit()]
    names = [t.lower() for t in tokens if t.isalpha()]
    if any(t in MONTHS or t in (m[:3] for m in MONTHS) for t in names):
        if len(names) != 1 or len(numbers) != 2:
            return None
        name = "full" if names[0] in MONTHS else "short"  # May is read as a whole name
        years = [len(n) == 4 for n in numbers]
        if sum(years) != 1 or len(numbers[years.index(False)]) > 2:
            return None
        kinds = iter(["year" if y else "day" for y in years])
        parts = [(name, "") if t.isalpha() else (next(kinds), "") if t.isdigit() else ("text", t) for t in tokens]
    elif names:
        return None
    elif len(tokens) == 1 and len(tokens[0]) == 8:
        parts = [("year", ""), ("month2", ""), ("day2", "")]
        tokens = [tokens[0][:4], tokens[0][4:6], tokens[0][6:]]
    elif len(numbers) == 3 and len(tokens) == 5:
        order = _numeric_order(numbers, day_first)
        if order is None:
            return None
        kinds = iter(order)
        parts = [(next(kinds), "") if t.isdigit() else ("text", t) for t in tokens]
    else:
        return None
    if not tokens[0].isalnum() or not tokens[-1].isalnum() or not _real_date(parts, tokens):
        return None
    tail = ""
    if shape["clock"]:
        clock = _HALF_CLOCK if shape["half"] else _CLOCK
        if not re.fullmatch(clock, shape["clock"]):
            return None
        gap = "T" if shape["gap"] == "T" else re.escape(shape["gap"])
        tail = gap + clock + (_SECONDS if shape["seconds"] else "") + (_FRACTION if shape["fraction"] else "")
        if shape["half"]:
            tail += re.escape(shape["half"][:-2]) + "[AaPp][Mm]"
        tail += _ZONE if shape["zone"] else ""
    return DateFormat(tuple(parts), tail)


def infer_date_format(df: DataFrame, column: str, order_by: Sequence[str], day_first: bool = False) -> DateFormat | None:
    """The format of the first value that is there, in the order of ``order_by``."""
    text = strip_space(F.col(column).cast("string"))
    first = (df.where(F.col(column).isNotNull() & (text != ""))
             .agg(F.min_by(text, F.struct(*order_by))).first())
    return guess_date_format(first[0], day_first)


def parse_date_as(c, fmt: DateFormat) -> Column:
    """DATE by one format, upper and lower case alike; anything else is null."""
    text, pattern = strip_space(as_col(c).cast("string")), f"(?i){fmt.pattern}"
    found = {kind[:5] if kind.endswith("2") else kind: F.regexp_extract(text, pattern, k)
             for k, kind in enumerate(fmt.kinds, 1)}
    name = found.get("full", found.get("short"))
    if name is not None:
        month = F.array_position(F.array(*[F.lit(m[:3]) for m in MONTHS]), F.lower(F.substring(name, 1, 3))).cast("string")
    else:
        month = next(v for k, v in found.items() if k.startswith("month"))
    day = next(v for k, v in found.items() if k.startswith("day"))
    iso = F.concat_ws("-", found["year"], F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    return F.when(text.rlike(pattern), F.try_to_date(iso, "yyyy-MM-dd"))


def parse_date_inferred(df: DataFrame, column: str, order_by: Sequence[str], day_first: bool = False) -> Column:
    """The column parsed by the format of its first value. A first value without a clear
    format leaves every value to ``parse_date_lenient``."""
    fmt = infer_date_format(df, column, order_by, day_first)
    return parse_date_lenient(column) if fmt is None else parse_date_as(column, fmt)

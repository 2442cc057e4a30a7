"""Header, file-name and date-text functions.

Every function has a Column form (runs inside whole-stage codegen on the
executors) and, where names of columns are concerned, a plain-string form for
driver-side schema metadata.
"""

from __future__ import annotations

import functools
import re
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import HEADER_DICTIONARY, HEADER_FOLD_FROM, HEADER_FOLD_TO
from ._cols import as_col

#: White space of any kind, as ``str.strip`` knows it.
_SPACE = r"[\s\p{Z}\x{1c}-\x{1f}\x{85}]"
#: What a header keeps: each run is a word, words are joined by one underscore.
_HEADER_WORD = "[a-z0-9]+"


@functools.lru_cache(maxsize=1)
def fold_table() -> dict[str, str]:
    """Character -> its compatibility decomposition without marks, for every code point
    where they differ, from the Unicode database; a mark's is empty. Both the Column and
    the string rules fold with this one table."""
    table = {}
    for ch in map(chr, range(0x80, sys.maxunicode + 1)):  # ASCII stands for itself
        plain = "".join(c for c in unicodedata.normalize("NFKD", ch) if not _is_mark(c))
        if plain != ch:
            table[ch] = plain
    return table


def _is_mark(ch: str) -> bool:  # combining marks
    return unicodedata.combining(ch) != 0


def fold_text(text: str) -> str:
    """String form of :func:`accent_fold`."""
    table = fold_table()
    return "".join([table.get(ch, ch) for ch in text])


def _translated(c: Column, table: dict[str, str]) -> Column:
    """Characters exchanged for at most one other each."""
    ordered = sorted(table, key=lambda ch: (not table[ch], ch))  # what is dropped comes last
    return F.translate(c, "".join(ordered), "".join(table[ch] for ch in ordered))


@functools.lru_cache(maxsize=1)
def _fold_parts() -> tuple[dict[str, str], str, list[dict[str, str]]]:
    """The table by length: characters that become one or none; those that become several,
    and for each place of the result its letter."""
    table = fold_table()
    single = {ch: plain for ch, plain in table.items() if len(plain) < 2}
    several = {ch: plain for ch, plain in table.items() if len(plain) > 1}
    places = [{ch: plain[k:k + 1] for ch, plain in several.items()} for k in range(max(map(len, several.values())))]
    return single, "".join(several), places


def accent_fold(c) -> Column:
    """Characters of any script as their compatibility decomposition without marks: no
    accents, whether these are part of a character or stand behind it; ligatures, wide,
    circled and mathematical forms become plain. One pass looks up every character that
    becomes several; texts without such a one don't take it."""
    single, several, places = _fold_parts()
    text = as_col(c)
    plain = _translated(text, single)

    def spelt(ch: Column) -> Column:
        letters = F.concat(*[_translated(ch, place) for place in places])
        return F.when(F.translate(ch, several, "") == "", letters).otherwise(ch)

    whole = F.array_join(F.transform(F.regexp_extract_all(plain, F.lit("(?s)(.)")), spelt), "")
    return F.when(F.translate(plain, several, "") == plain, plain).otherwise(whole)


def strip_space(c) -> Column:
    """White space of any kind removed from both ends."""
    return F.regexp_replace(as_col(c), f"^{_SPACE}+|{_SPACE}+$", "")


def _header_words(c: Column) -> Column:
    return F.array_join(F.regexp_extract_all(F.lower(c), F.lit(f"({_HEADER_WORD})")), "_")


def _header_words_of(text: str) -> str:
    return "_".join(re.findall(_HEADER_WORD, text.lower()))


def normalise_header(c) -> Column:
    """Generic header rule: the words of the accent-folded header in lower case, joined
    by underscores; a dotless i counts as i."""
    return _header_words(accent_fold(F.translate(as_col(c), "ı", "i")))


def header_name(name: str) -> str:
    """String form of :func:`normalise_header`, for column names on the driver."""
    return _header_words_of(fold_text(str(name).replace("ı", "i")))


def normalise_header_dictionary(c) -> Column:
    """Script-chain header rule: a known header has its name; the words of any other,
    after the fixed letter pairs, are joined by underscores."""
    known = F.create_map(*[F.lit(x) for pair in HEADER_DICTIONARY.items() for x in pair])
    header = strip_space(c)
    return F.coalesce(F.try_element_at(known, header),
                      _header_words(F.translate(header, HEADER_FOLD_FROM, HEADER_FOLD_TO)))


def header_name_dictionary(name: str) -> str:
    """String form of :func:`normalise_header_dictionary`, for column names."""
    header = str(name).strip()
    pairs = str.maketrans(HEADER_FOLD_FROM, HEADER_FOLD_TO)
    return HEADER_DICTIONARY.get(header) or _header_words_of(header.translate(pairs))


# -- file names and dates ---------------------------------------------------

def file_stem(path) -> Column:
    """Base name without its last extension (``a/b/XYZ2011.xlsx`` -> ``XYZ2011``);
    a leading dot alone is not an extension (``.xlsx`` stays ``.xlsx``)."""
    base = F.substring_index(as_col(path), "/", -1)
    ext_len = F.length(F.substring_index(base, ".", -1)) + 1
    has_ext = F.instr(base.substr(F.lit(2), F.length(base)), ".") > 0
    return F.when(has_ext, base.substr(F.lit(1), F.length(base) - ext_len)).otherwise(base)


def entity_from_filename(path) -> Column:
    """Leading upper-case letters of the file stem; the whole stem when there are none."""
    stem = file_stem(path)
    letters = F.regexp_extract(stem, r"^([A-Z]+)", 1)
    return F.when(letters == "", stem).otherwise(letters)


def parse_day_first(c, pattern: str = "dd-MM-yyyy") -> Column:
    """Strict day-first date text -> DATE; anything else -> null."""
    return F.try_to_date(F.trim(as_col(c).cast("string")), pattern)


LENIENT_DATE_PATTERNS = ("dd-MM-yyyy", "dd.MM.yyyy", "dd/MM/yyyy", "yyyy-MM-dd", "yyyy/MM/dd",
                         "d-M-yyyy", "d.M.yyyy", "d/M/yyyy")
#: What a text of a pattern looks like, and maybe others: a parser that fails raises an
#: error inside, which costs many times the look.
_DATE_SHAPES = {p: s for sep, rx in (("-", "-"), (".", "\\."), ("/", "/")) for p, s in (
    (f"dd{sep}MM{sep}yyyy", f"^\\d\\d{rx}\\d\\d{rx}"), (f"yyyy{sep}MM{sep}dd", f"\\d{rx}\\d\\d{rx}\\d\\d$"),
    (f"d{sep}M{sep}yyyy", f"^\\d+{rx}\\d+{rx}"))}


def parse_date_lenient(c, patterns: tuple[str, ...] = LENIENT_DATE_PATTERNS) -> Column:
    """Day-first or ISO date text (first pattern that parses wins); failures -> null.

    A time of day behind white space or a ``T`` is dropped; a DATE or TIMESTAMP input is
    truncated to its day.
    """
    return parse_date_head(date_head(c), patterns)


def date_head(c) -> Column:
    """Date text without white space around it and without a time of day."""
    return F.regexp_extract(strip_space(as_col(c).cast("string")), r"^([^\sT]+)", 1)


def parse_date_head(head: Column, patterns: tuple[str, ...] = LENIENT_DATE_PATTERNS) -> Column:
    """The text of :func:`date_head` -> DATE; the first pattern that parses wins."""
    def one(p: str) -> Column:
        parsed, shape = F.try_to_date(head, p), _DATE_SHAPES.get(p)
        return F.when(head.rlike(shape), parsed) if shape else parsed

    return F.coalesce(*map(one, patterns))

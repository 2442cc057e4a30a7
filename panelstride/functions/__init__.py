"""Column-level functions (JVM-side expressions)."""

from .numeric import clean_numeric, finite_or_null, half_even, ratio_minus_one, safe_div
from .text import (
    accent_fold,
    entity_from_filename,
    file_stem,
    header_name,
    header_name_dictionary,
    normalise_header,
    normalise_header_dictionary,
    parse_date_lenient,
    parse_day_first,
)

__all__ = [
    "accent_fold", "clean_numeric", "entity_from_filename", "file_stem", "finite_or_null",
    "half_even", "header_name", "header_name_dictionary", "normalise_header",
    "normalise_header_dictionary", "parse_date_lenient", "parse_day_first", "ratio_minus_one",
    "safe_div",
]

"""Text cleaning on JVM built-ins."""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import as_col


@functools.lru_cache(maxsize=1)
def _accent_pairs() -> tuple[str, str]:
    """Latin letters whose decomposition is one ASCII letter plus marks.

    The marks themselves come last and have no counterpart, so they vanish.
    """
    src, dst = [], []
    for cp in range(0xC0, 0x1F00):
        parts = unicodedata.normalize("NFKD", chr(cp))
        plain = "".join(p for p in parts if not unicodedata.combining(p))
        if len(plain) == 1 and plain != chr(cp) and plain.isascii():
            src.append(chr(cp))
            dst.append(plain)
    marks = "".join(chr(cp) for cp in range(0x300, 0x370))
    return "".join(src) + marks, "".join(dst)


def strip_accents(c: str | Column) -> Column:
    return F.translate(as_col(c), *_accent_pairs())


def normalize_text(c: str | Column, ascii_only: bool = True) -> Column:
    """Lower case, single blanks, no accents; by default ASCII only.

    Text that is ASCII already, told by its byte length, skips the costly
    part.
    """
    low = F.lower(as_col(c))
    blanks = r"\s{2,}|[^\S ]"
    plain = F.trim(F.regexp_replace(low, blanks, " "))
    other = strip_accents(F.trim(F.regexp_replace(low, "(?U)" + blanks, " ")))
    if ascii_only:
        other = F.regexp_replace(other, r"[^\x00-\x7F]+", "")
    return F.when(F.octet_length(low) == F.length(low), plain).otherwise(other)


def extract_digits(c: str | Column) -> Column:
    """First run of digits, or null."""
    return F.nullif(F.regexp_extract(as_col(c), r"(\d+)", 1), F.lit(""))


def clean_username(c: str | Column, domain: str) -> Column:
    """Drop the mail domain, dots to blanks, title case."""
    return F.initcap(F.replace(F.replace(as_col(c), F.lit(domain), F.lit("")), F.lit("."), F.lit(" ")))


def capitalize_first(c: str | Column) -> Column:
    col = as_col(c)
    return F.concat(F.upper(F.substring(col, 1, 1)), F.lower(F.substr(col, F.lit(2))))


def format_phone(c: str | Column, country: str = "509") -> Column:
    """Local eight-digit numbers as ``+CCC xxxx xxxx``.

    Eleven digits with the country code are regrouped, nine or ten digits keep
    their first eight, anything else stays as written.
    """
    col = as_col(c).cast("string")
    digits = F.regexp_replace(col, r"\D", "")

    def grouped(start: int) -> Column:
        return F.concat(F.lit(f"+{country} "), F.substring(digits, start, 4), F.lit(" "), F.substring(digits, start + 4, 4))

    size = F.length(digits)
    return (
        F.when(size == 8, grouped(1))
        .when((size == 11) & digits.startswith(country), grouped(len(country) + 1))
        .when(size.between(9, 10), grouped(1))
        .otherwise(col)
    )


def strip_label_code(c: str | Column) -> Column:
    """``1-some_label`` to ``Some Label``."""
    no_code = F.regexp_replace(as_col(c), r"^\s*\d+\s*-?\s*", "")
    words = F.regexp_replace(no_code, r"[^\p{L}\p{N}]+", " ")
    return F.initcap(F.trim(words))


def site_from_code(c: str | Column, length: int | None = 8, sep: str | None = None) -> Column:
    """Site part of a code: the first characters, or the part before ``sep``."""
    col = as_col(c)
    if sep is not None:
        return F.trim(F.split_part(col, F.lit(sep), F.lit(1)))
    return F.substring(col, 1, length)


def zone_from_prefix(c: str | Column, zones: Mapping[str, str], default: str = "Autre") -> Column:
    """Zone named by the first character of a user name."""
    first = F.substring(as_col(c), 1, 1)
    return decode(first, zones, default)


def decode(c: str | Column, labels: Mapping, default=None, keep_unknown: bool = False) -> Column:
    """Label of a coded value; unknown codes pass through or get ``default``."""
    col = as_col(c)
    out = None
    for code, label in labels.items():
        out = F.when(col == F.lit(code), F.lit(label)) if out is None else out.when(col == F.lit(code), F.lit(label))
    if keep_unknown:
        return out.otherwise(col.cast("string"))
    return out.otherwise(F.lit(default))


def recode_values(c: str | Column, from_values: Sequence, to_value) -> Column:
    """Whole-value recode: listed values become ``to_value``, others stay."""
    col = as_col(c)
    return F.when(col.isin(*from_values), F.lit(to_value)).otherwise(col)

"""Canonical keys and tolerant parsing."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _accents() -> tuple[str, str]:
    """Latin letters with marks and the letters without, by decomposition."""
    pairs = [(chr(c), unicodedata.normalize("NFD", chr(c))[0]) for c in range(0xC0, 0x250)]
    pairs = [(a, b) for a, b in pairs if a != b and b.isascii()]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


ACCENTED, PLAIN = _accents()


def strip_accents(c: Column) -> Column:
    return F.translate(c, ACCENTED, PLAIN)


def plain_upper(c: Column) -> Column:
    """Trimmed, without accents, upper case; blanks inside stay."""
    return F.upper(strip_accents(F.trim(c)))


def canonical_key(c: str | Column) -> Column:
    """One spelling for texts that differ in blanks, accents, case or a final dot;
    null for texts of which nothing is left."""
    c = F.col(c) if isinstance(c, str) else c
    folded = F.upper(strip_accents(F.trim(F.regexp_replace(c, r"\s+", " "))))
    return F.nullif(F.regexp_replace(folded, "[ .]+$", ""), F.lit(""))


def surrogate(*keys: Column) -> Column:
    """MD5 of keys joined by bars, nulls as empty."""
    return F.md5(F.concat_ws("|", *(F.coalesce(k, F.lit("")) for k in keys)))


#: Date formats by the name that a file's entry carries.
DATE_FORMATS = {"yyyy/mm/dd": "y/M/d", "dd/mm/yyyy": "d/M/y"}


def parse_date_by_format(c: Column, fmt: Column) -> Column:
    """The date of a text in the format that its file declares, else null."""
    out = F.lit(None).cast("date")
    for name, pattern in DATE_FORMATS.items():
        out = F.when(fmt == name, F.try_to_date(c, pattern)).otherwise(out)
    return out


def parse_date_any(c: Column) -> Column:
    """The date by the first format that fits."""
    return F.coalesce(*(F.try_to_date(c, p) for p in DATE_FORMATS.values()))


def date_format_of(c: Column) -> Column:
    """The name of the first format that fits, else 'none'."""
    out = F.lit("none")
    for name, pattern in reversed(DATE_FORMATS.items()):
        out = F.when(F.try_to_date(c, pattern).isNotNull(), name).otherwise(out)
    return out


def in_box(lat: Column, lon: Column, south: float, north: float, west: float, east: float) -> Column:
    """Whether a place lies in a box; false for missing coordinates."""
    return F.coalesce(lat.between(south, north) & lon.between(west, east), F.lit(False))


def bit_set(mask: Column, bit: int) -> Column:
    return F.shiftright(mask, bit).bitwiseAND(F.lit(1)) == 1

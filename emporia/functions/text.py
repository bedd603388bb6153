"""Text cleaning and typed parsing of feed columns.

All of these are built-in Column expressions (JVM side, whole-stage codegen);
none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day-first feed format (style 105); time and seconds optional.
DMY_PATTERN = "dd-MM-yyyy[ HH:mm[:ss]]"
MONEY_TYPE = "decimal(10,2)"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: str | Column) -> Column:
    """Blank or empty text -> NULL, otherwise trimmed (blanks only, both sides)."""
    t = F.trim(_col(c))
    return F.when(t != F.lit(""), t)


def to_int(c: str | Column) -> Column:
    """Integer parse; text that is not an integer (``'1.5'``, ``'n/a'``, ``''``) gives NULL."""
    return F.trim(_col(c)).try_cast("int")


def to_dec(c: str | Column, dtype: str = MONEY_TYPE) -> Column:
    """Decimal parse of cleaned text; unparsable or overflowing text gives NULL."""
    return clean_text(c).try_cast(dtype)


def parse_dmy(c: str | Column) -> Column:
    """``DD-MM-YYYY HH:MM`` text -> zone-less timestamp; bad text or impossible dates give NULL."""
    return F.try_to_timestamp(clean_text(c), F.lit(DMY_PATTERN)).cast("timestamp_ntz")


def first_upper(c: str | Column) -> Column:
    """First letter of the trimmed text upper-case, the rest lower (not word-wise initcap)."""
    t = F.trim(_col(c))
    return F.concat(F.upper(F.substring(t, 1, 1)), F.lower(F.substring(t, 2, 2147483647)))

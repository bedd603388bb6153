"""Column profile of a text feed (OP-Q12): one pass over the feed, driven by its schema.

For every column: rows, NULLs, blanks (text of blanks only), values that its type cannot parse, and
the number of distinct values from Spark's HyperLogLog++ sketch (relative standard deviation
``error``, 2 % unless given; bounded memory per column).  All columns are aggregated in one job with
map-side partial results and then turned into rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.functions.measures import count_when
from emporia.functions.text import clean_text, parse_dmy, to_dec, to_int

PARSERS = {"int": to_int, "decimal": to_dec, "time": parse_dmy}
ERROR = 0.02


def unparsable(column: str, kind: str | None) -> Column:
    """True for a value that is there and is not of the column's kind (text parses always)."""
    if kind is None:
        return F.lit(False)
    return clean_text(column).isNotNull() & PARSERS[kind](column).isNull()


def profile(df: DataFrame, columns: tuple[str, ...], kinds: dict[str, str], error: float = ERROR) -> DataFrame:
    """column_name, rows, nulls, blanks, unparsable, distinct_estimate: one row per column of ``columns``."""
    facts = [F.struct(
        F.lit(c).alias("column_name"),
        F.count(F.lit(1)).cast("long").alias("rows"),
        count_when(F.col(c).isNull()).alias("nulls"),
        count_when(F.trim(c) == "").alias("blanks"),
        count_when(unparsable(c, kinds.get(c))).alias("unparsable"),
        F.approx_count_distinct(c, error).cast("long").alias("distinct_estimate")) for c in columns]
    return df.agg(F.array(*facts).alias("f")).select(F.inline("f"))

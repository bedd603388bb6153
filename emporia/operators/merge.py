"""MERGE (upsert) for Parquet tables (OP-V06, OP-G01/G02 core, OP-S11).

Parquet has no in-place UPDATE, so a merge produces the *next version* of the
table: ``target FULL OUTER JOIN changes USING (keys)`` with an explicit
presence marker on each side.  The marker (not ``coalesce(new, old)``)
decides every column, so an update to NULL overwrites the old value.

Semantics, as in SQL ``MERGE ... WHEN MATCHED [AND changed] THEN UPDATE
... WHEN NOT MATCHED THEN INSERT``; rows only in the target are carried
unchanged (never deleted).  ``_action`` tells each output row's fate so the
writer can count inserted/updated rows in the same pass (``Observation``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IN_T, IN_C = "_in_target", "_in_changes"
ACTION = "_action"  # 'insert' | 'update' | 'keep'


def null_safe_differs(columns: list[str], defaults: dict[str, object] | None = None,
                      t: str = "t", c: str = "c") -> Column:
    """Change test ``ISNULL(t.x, d) <> ISNULL(c.x, d)`` OR-ed over columns.

    With a default the NULL and the default compare equal (the reference's
    ISNULL form); without one, NULL-safe inequality is used.
    """
    defaults = defaults or {}
    out = F.lit(False)
    for col in columns:
        a, b = F.col(f"{t}.{col}"), F.col(f"{c}.{col}")
        if col in defaults:
            d = F.lit(defaults[col])
            out = out | (F.coalesce(a, d) != F.coalesce(b, d))
        else:
            out = out | ~a.eqNullSafe(b)
    return out


def merge(target: DataFrame, changes: DataFrame, keys: list[str], columns: list[str],
          update_columns: list[str], batch_ts: dt.datetime,
          matched_condition: Column | None = None,
          carried_columns: list[str] | None = None) -> DataFrame:
    """Upsert ``changes`` into ``target``.

    ``columns``: business columns of the table (keys included).
    ``update_columns``: overwritten on a match (others are frozen after insert).
    ``matched_condition``: extra guard for updates, over aliases ``t`` / ``c``.
    ``carried_columns``: columns of the target kept as is (e.g. a surrogate key);
    an inserted row takes them from ``changes``.
    Audit: ``created_at`` set on insert, ``updated_at`` set on update.
    """
    ts = F.lit(batch_ts).cast("timestamp_ntz")
    carried = carried_columns or []
    c_df = changes.select(*columns, *carried).withColumn(IN_C, F.lit(True))

    def t_(col):
        return F.col(f"t.{col}")

    def c_(col):
        return F.col(f"c.{col}")

    cond = F.lit(True)
    for k in keys:
        cond = cond & (t_(k) == c_(k))
    joined = target.withColumn(IN_T, F.lit(True)).alias("t").join(c_df.alias("c"), cond, "full_outer")
    in_t, in_c = t_(IN_T).isNotNull(), c_(IN_C).isNotNull()
    upd = in_t & in_c & (matched_condition if matched_condition is not None else F.lit(True))
    ins = in_c & ~in_t
    out = [F.when(upd | ins if col in update_columns and col not in keys else ins, c_(col)).otherwise(t_(col)).alias(col)
           for col in [*columns, *carried]]
    out.append(F.when(ins, ts).otherwise(t_("created_at")).alias("created_at"))
    out.append(F.when(upd, ts).otherwise(t_("updated_at")).alias("updated_at"))
    out.append(F.when(ins, "insert").when(upd, "update").otherwise("keep").alias(ACTION))
    return joined.select(*out)


def insert_all(changes: DataFrame, columns: list[str], batch_ts: dt.datetime) -> DataFrame:
    """Merge into an empty target: every row is an insert (no join needed)."""
    ts = F.lit(batch_ts).cast("timestamp_ntz")
    return changes.select(*columns, ts.alias("created_at"),
                          F.lit(None).cast("timestamp_ntz").alias("updated_at"),
                          F.lit("insert").alias(ACTION))

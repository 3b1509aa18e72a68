"""Typing of all-text result sets (as a remote SQL engine returns them).

``to_text`` renders every cell as a string ('' for null; times keep their
fraction).  ``infer_column_types`` decides per column, in ONE aggregation over
all columns: timestamp if every non-empty cell is a date or a date-time with or
without a fraction of a second (a year alone is a number), else number
(bigint when every cell is integral, double otherwise), else string; then one
select applies the casts.  Only the per-column flags (one row) reach the
driver, since the output schema has to be known before the plan is built.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A date, or a date-time, with or without a fraction of a second; as a pattern and as a format.
TIME_TEXT = r"^\d{4}-\d{2}-\d{2}( \d{2}:\d{2}:\d{2}(\.\d{1,6})?)?$"
TIME_FORMAT = "yyyy-MM-dd[ HH:mm:ss[.SSSSSS]]"


def to_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])


def _as_ts(c):
    # wall-clock time, so no session time zone can shift it
    return F.when(F.col(c).rlike(TIME_TEXT), F.col(c).try_cast("timestamp_ntz"))


def _as_double(c):
    return F.col(c).try_cast("double")


def _as_long(c):
    return F.col(c).try_cast("bigint")


def infer_column_types(df: DataFrame) -> DataFrame:
    cols = df.columns
    if not cols:
        return df
    checks = []
    for c in cols:
        filled = F.col(c) != ""
        checks += [
            F.count_if(filled & _as_ts(c).isNull()).alias(f"{c}__not_ts"),
            F.count_if(filled & _as_double(c).isNull()).alias(f"{c}__not_num"),
            F.count_if(filled & _as_long(c).isNull()).alias(f"{c}__not_int"),
        ]
    flags = df.agg(*checks).first().asDict()
    out = []
    for c in cols:
        blank = F.col(c) == ""
        if flags[f"{c}__not_ts"] == 0:
            out.append(F.when(blank, None).otherwise(_as_ts(c)).alias(c))
        elif flags[f"{c}__not_int"] == 0:
            out.append(F.when(blank, None).otherwise(_as_long(c)).alias(c))
        elif flags[f"{c}__not_num"] == 0:
            out.append(F.when(blank, None).otherwise(_as_double(c)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def typed_result(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Fixed typing: timestamp columns parsed as dates or date-times, others cast."""
    out = []
    for c in df.columns:
        t = types.get(c)
        col = F.when(F.col(c) == "", None).otherwise(F.col(c))
        if t is None:
            out.append(F.col(c))
        elif t.startswith("timestamp"):
            out.append(F.to_timestamp_ntz(col, F.lit(TIME_FORMAT)).alias(c))
        else:
            out.append(col.cast(t).alias(c))
    return df.select(*out)

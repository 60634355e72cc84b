"""Column expressions that reproduce the reference's R semantics.

Every helper returns a ``Column`` built from built-in functions, so it stays inside
whole-stage codegen. Rule numbers refer to SURVEY §1.3.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ge_not_nan(c: str | Column, threshold) -> Column:
    """``x >= t`` as R evaluates it in a subset: NA and NaN rows drop out (G1)."""
    x = col(c)
    return (x >= F.lit(threshold)) & ~F.isnan(x)


def count_na(c: str | Column) -> Column:
    """``sum(is.na(x))``."""
    return F.count_if(col(c).isNull())


def count_pattern_mismatch(c: str | Column, pattern: str) -> Column:
    """``sum(!grepl(p, x))``: grepl on NA is FALSE, so NA counts as a mismatch."""
    x = col(c)
    return F.count_if(x.isNull() | ~x.rlike(pattern))


def count_out_of_range(c: str | Column, lo, hi) -> Column:
    """``sum(x < lo | x > hi, na.rm=TRUE)``: NA and NaN are not counted (G1)."""
    x = col(c)
    return F.count_if(((x < F.lit(lo)) | (x > F.lit(hi))) & ~F.isnan(x))


def count_not_in(c: str | Column, values: Iterable) -> Column:
    """``sum(!x %in% v)``: NA is not in a set without NA, so it counts."""
    x = col(c)
    vals = list(values)
    return F.count_if(x.isNull() | ~x.isin(vals))


def unique_n(c: str | Column) -> Column:
    """``data.table::uniqueN``: distinct values with NA counted as one."""
    x = col(c)
    return F.count_distinct(x) + F.coalesce(F.max(x.isNull().cast("long")), F.lit(0))


def pct_1dp(num: Column, den: Column) -> Column:
    """``round(100 * num / den, 1)`` with R's ties-to-even and NULL for 0/0."""
    return F.bround(F.try_divide(num * F.lit(100.0), den.cast("double")), 1)


def is_in(df: DataFrame, df_col: str, ref: DataFrame, ref_col: str) -> DataFrame:
    """Rows of ``df`` whose ``df_col`` occurs in ``ref[ref_col]`` (R ``%in%``, G5).

    Null-safe equality so a null key matches a null in the reference set. The
    reference side is reduced to distinct keys (a partial aggregate before any
    shuffle); the planner broadcasts it only when its measured size is under
    ``spark.sql.autoBroadcastJoinThreshold``, otherwise it is a shuffled semi
    join whose hot keys adaptive execution splits.
    """
    keys = ref.select(F.col(ref_col).alias("__key")).distinct()
    return df.join(keys, df[df_col].eqNullSafe(keys["__key"]), "left_semi")


def regex_any(patterns: Iterable[str]) -> str:
    """``paste(x, collapse='|')`` + ``ignore.case=TRUE`` as a Java regex."""
    return "(?i)(" + "|".join(patterns) + ")"


def matches_text_or_array(c: str, dtype: T.DataType, pattern: str) -> Column:
    """TRUE when a string, or any element of an array of strings, matches ``pattern``.

    Null (or no match with a null element) is FALSE, never NULL (G8).
    """
    x = F.col(c)
    if isinstance(dtype, T.ArrayType):
        hit = F.exists(x, lambda e: e.rlike(pattern))
    else:
        hit = x.cast("string").rlike(pattern)
    return F.coalesce(hit, F.lit(False))


def field_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    """Case-sensitive presence check."""
    have = set(df.columns)
    return [c for c in required if c not in have]

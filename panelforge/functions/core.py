"""Null/NaN-safe scalar expressions shared by the operators.

Every function returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColLike = Column | str


def _c(c: ColLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: ColLike) -> Column:
    """NaN and NULL are the same 'missing' value (pandas semantics)."""
    c = _c(c)
    return F.when(~F.isnan(c), c)


def r6(c: ColLike) -> Column:
    """Round a double to 6 decimals (output convention of every checked query)."""
    return F.round(_c(c).cast("double") + 1e-9, 6)


def safe_div(num: ColLike, den: ColLike) -> Column:
    """Division returning NULL for a zero/NULL denominator (ANSI-safe)."""
    return F.try_divide(_c(num), _c(den))


def safe_float(c: ColLike) -> Column:
    """String/number -> double; '' and unparsable strings -> NULL."""
    s = F.trim(_c(c).cast("string"))
    return F.when(s != "", s).try_cast("double")


def safe_timestamp(c: ColLike) -> Column:
    """ISO string -> TIMESTAMP_NTZ; '' / NULL / unparsable -> NULL."""
    c = _c(c).cast("string")
    return F.try_to_timestamp(F.when(F.trim(c) != "", F.regexp_replace(c, "Z$", ""))).cast("timestamp_ntz")


def signed_log1p(c: ColLike) -> Column:
    c = _c(c)
    return F.signum(c) * F.log1p(F.abs(c))


def signed_expm1(c: ColLike) -> Column:
    c = _c(c)
    return F.signum(c) * F.expm1(F.abs(c))


def clamp(c: ColLike, lo: ColLike | float, hi: ColLike | float) -> Column:
    lo_c = lo if isinstance(lo, Column) else F.lit(lo)
    hi_c = hi if isinstance(hi, Column) else F.lit(hi)
    return F.greatest(lo_c, F.least(hi_c, _c(c)))

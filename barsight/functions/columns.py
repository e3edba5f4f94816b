"""Column expressions shared by the operators (projections, predicates, P1-P16).

Everything here returns ``Column`` objects or applies a ``select`` — no Python
runs per row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OHLCV = ["open", "high", "low", "close", "volume"]


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def div(a, b) -> Column:
    """Division that yields NULL where the reference would get Inf/NaN (rule 1)."""
    return F.try_divide(c(a), c(b))


def round_half_up(x, digits: int = 4) -> Column:
    """floor(x*10^d + 0.5)/10^d — the same arithmetic is used in the oracle SQL,
    so both engines round identically (and -0.0 cannot appear)."""
    scale = float(10 ** digits)
    return (F.floor(c(x) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)).cast("double")


def normalise_columns(df: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """Apply renames, then lower-case every column name (dots become '_')."""
    renames = renames or {}
    cols = []
    for name in df.columns:
        new = renames.get(name, name).lower().replace(".", "_")
        cols.append(F.col(f"`{name}`").alias(new))
    return df.select(*cols)


def to_date_col(x) -> Column:
    """A date, NULL where the value is none."""
    return c(x).try_cast("date")


def coerce_float(df: DataFrame, cols: list[str], narrow: bool = True) -> DataFrame:
    """Non-numeric -> NULL, optionally narrowed to float32.

    float32 overflow gives +-Inf, which P4 turns into NULL."""
    out = []
    for name in df.columns:
        if name in cols:
            v = F.col(name).try_cast("double")
            if narrow:
                v = v.cast("float").cast("double")
            out.append(v.alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)


def finite_or_null(x) -> Column:
    v = c(x)
    return F.when(F.isnan(v) | (F.abs(v) == F.lit(float("inf"))), F.lit(None)).otherwise(v)


def null_nonfinite(df: DataFrame, cols: list[str]) -> DataFrame:
    """NaN and +-Inf become NULL."""
    return df.select(*[finite_or_null(n).alias(n) if n in cols else F.col(n) for n in df.columns])


def complete_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    """P5: drop rows with a NULL in any of ``cols``."""
    return df.dropna(subset=list(cols))


def all_not_null(cols: list[str]) -> Column:
    """P10: conjunction of IS NOT NULL over ``cols``."""
    return reduce(lambda a, b: a & b, [F.col(x).isNotNull() for x in cols], F.lit(True))


def is_missing(name: str, dtype) -> Column:
    """P7 rule for one field: NULL, '' or [] is missing; 0 and false are present."""
    from pyspark.sql.types import ArrayType, StringType
    v = F.col(name)
    if isinstance(dtype, StringType):
        return v.isNull() | (v == F.lit(""))
    if isinstance(dtype, ArrayType):
        return v.isNull() | (F.size(v) == 0)
    return v.isNull()

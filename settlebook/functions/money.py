"""Money helpers: exact decimals inside, one output type at the edges."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
TOTAL = T.DecimalType(28, 2)


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """Major units as DECIMAL(18,2); DOUBLE inputs are rounded once, here."""
    return col_of(c).cast(MONEY)


def dec_lit(value: str, precision: int = 10, scale: int | None = None) -> Column:
    d = Decimal(value)
    s = max(-d.as_tuple().exponent, 0) if scale is None else scale
    return F.lit(value).cast(T.DecimalType(precision, s))


def cents_to_units(c) -> Column:
    """Integer cents -> DECIMAL(28,2) major units (exact)."""
    return (col_of(c).cast(T.DecimalType(38, 0)) / F.lit(100)).cast(TOTAL)


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Cast every DECIMAL column to DOUBLE (exact values rounded once at the end)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            out.append(F.col(f"`{f.name}`").cast("double").alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)

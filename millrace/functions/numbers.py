"""Numeric column expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Share of the price still paid per customer tier.
TIER_MULTIPLIER = {"gold": 0.8, "silver": 0.9}


def money(column: str | Column, scale: int = 2) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.cast(f"decimal(18,{scale})")


def to_number(column: str | Column, kind: str = "int") -> Column:
    """The trimmed text as a number, null when it is none."""
    column = F.col(column) if isinstance(column, str) else column
    return F.trim(column).try_cast(kind)


def divide(a: Column, b: Column) -> tuple[Column, Column]:
    """``(quotient, error)``: a quotient or, for a zero divisor, an error; neither if an operand is null."""
    return F.try_divide(a, b), F.when(b == 0, F.lit("Division by zero"))


def round_to(column: Column, step: str = "0.05") -> Column:
    """Nearest multiple of ``step``, halves up, in cents."""
    unit = F.lit(step).cast("decimal(6,4)")
    steps = F.floor(column.cast("decimal(18,4)") / unit + F.lit("0.5").cast("decimal(2,1)"))
    return F.round(steps.cast("decimal(18,0)") * unit, 2).cast("decimal(18,2)")


def tier_price(price: Column, tier: Column) -> Column:
    factor = F.lit(1.0)
    for name, multiplier in TIER_MULTIPLIER.items():
        factor = F.when(F.lower(tier) == name, F.lit(multiplier)).otherwise(factor)
    return price * factor


def convert_temperature(value: Column, scale: Column) -> Column:
    """Celsius to Fahrenheit and back; an unknown scale leaves the value as it is."""
    return (
        F.when(F.lower(scale) == "c", value * 9.0 / 5.0 + 32.0)
        .when(F.lower(scale) == "f", (value - 32.0) * 5.0 / 9.0)
        .otherwise(value)
    )


def age_band(age: Column) -> Column:
    """The band of an age; a null age has none."""
    return (
        F.when(age < 25, "15-24")
        .when(age < 35, "25-34")
        .when(age < 45, "35-44")
        .when(age < 55, "45-54")
        .when(age < 65, "55-64")
        .when(age >= 65, "65+")
    )


def age_band_udf():
    """The same bands as a vectorised UDF, for sessions that register it with SQL."""

    @F.pandas_udf("string")
    def band(age: pd.Series) -> pd.Series:
        edges = [-float("inf"), 25, 35, 45, 55, 65, float("inf")]
        names = ["15-24", "25-34", "35-44", "45-54", "55-64", "65+"]
        return pd.cut(age, edges, right=False, labels=names).astype(object).where(age.notna(), None)

    return band

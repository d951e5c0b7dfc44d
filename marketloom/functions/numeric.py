"""Exact ratios and rounding: decimals up to one division, one rounding, then double."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

_NUMERATOR = T.DecimalType(28, 6)
_COUNT = T.DecimalType(18, 0)
_MONEY = T.DecimalType(24, 6)


def ratio(num: Column, den: Column, digits: int, factor: int = 1, money: bool = False) -> Column:
    """``factor * num / den`` half-up at ``digits`` places, null where ``den`` is 0 or null.

    The divisor is a count unless ``money`` says that it has decimals; the quotient keeps 16 places
    (10 for money) before it is rounded.
    """
    top = (num * F.lit(factor)).cast(_NUMERATOR)
    kind = _MONEY if money else _COUNT
    return F.round(top / F.nullif(den.cast(kind), F.lit(0).cast(kind)), digits).cast("double")


def percent(num: Column, den: Column, digits: int = 2, money: bool = False) -> Column:
    return ratio(num, den, digits, 100, money)


def mean_of(column: Column, digits: int) -> Column:
    """Aggregate: the mean over non-null values, half-up at ``digits`` places."""
    return ratio(F.sum(column), F.count(column), digits)


def plain_types(df: DataFrame) -> DataFrame:
    """Decimals as double and narrow integers as bigint, for readers that know no decimals (CSV, JSON)."""
    target = {"decimal": "double", "int": "bigint", "smallint": "bigint", "tinyint": "bigint", "float": "double"}
    columns = []
    for field in df.schema:
        kind = "decimal" if isinstance(field.dataType, T.DecimalType) else field.dataType.simpleString()
        columns.append(F.col(field.name).cast(target[kind]).alias(field.name) if kind in target else F.col(field.name))
    return df.select(*columns)

"""Cleaning of clinical columns: category codes, coercion, ranges, defaults."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType, StringType

from vitalgrid.functions.columns import finite, flag, to_number
from vitalgrid.schemas import (
    CATEGORY_CODES,
    CLINICAL_FEATURES,
    LABEL,
    NOT_FEATURES,
    THAL_RECODE,
    VALID_RANGES,
)


def category_code(value: Column, codes: Mapping[str, int]) -> Column:
    """Code of a category text; text that is a number passes through, the rest is null."""
    table = F.create_map(*[
        F.lit(x) for text, code in codes.items() for x in (text, float(code))
    ])
    return F.coalesce(
        F.try_element_at(table, F.lower(F.trim(value.cast("string")))), to_number(value)
    )


def as_number(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    if isinstance(kind, NumericType):
        return finite(F.col(column).cast("double"))
    if isinstance(kind, StringType):
        return to_number(F.col(column))
    return F.col(column).try_cast("double")


def map_categories(df: DataFrame, tables: Mapping[str, Mapping[str, int]] = CATEGORY_CODES) -> DataFrame:
    present = {name: codes for name, codes in tables.items() if name in df.columns}
    return df.withColumns({name: category_code(F.col(name), codes) for name, codes in present.items()})


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({name: as_number(df, name) for name in columns if name in df.columns})


def clamp(value: Column, low: float, high: float) -> Column:
    """Value moved into `[low, high]`; null stays null."""
    low, high = F.lit(float(low)), F.lit(float(high))
    return F.when(value < low, low).when(value > high, high).otherwise(value)


def recode(value: Column, table: Mapping[float, float]) -> Column:
    result = value
    for old, new in table.items():
        result = F.when(value == float(old), F.lit(float(new))).otherwise(result)
    return result


def clamp_ranges(df: DataFrame, ranges: Mapping[str, tuple[float, float]] = VALID_RANGES) -> DataFrame:
    def bounded(name):
        value = F.col(name)
        if name == "thal":
            value = recode(value, THAL_RECODE)
        return clamp(value, *ranges[name])

    return df.withColumns({name: bounded(name) for name in ranges if name in df.columns})


def binary_label(value: Column) -> Column:
    """1 where the grade is above zero, else 0."""
    return flag(value > 0)


def fill_defaults(df: DataFrame, columns: Sequence[str], default: float = 0.0) -> DataFrame:
    """NaN and null become the default."""
    def filled(name):
        value = F.col(name)
        if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
            value = finite(value)
        return F.coalesce(value, F.lit(default))

    return df.withColumns({name: filled(name) for name in columns if name in df.columns})


def select_features(df: DataFrame, wanted: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The wanted columns in order; those that are absent come as 0."""
    present = set(df.columns)
    return df.select(
        *[F.col(f"`{name}`") for name in keep],
        *[
            F.col(f"`{name}`") if name in present else F.lit(0.0).alias(name)
            for name in wanted
        ],
    )


def validate(df: DataFrame) -> DataFrame:
    """Category codes, numeric coercion and valid ranges in one projection chain."""
    measured = [c for c in CLINICAL_FEATURES if c not in CATEGORY_CODES]
    return clamp_ranges(coerce_numeric(map_categories(df), measured))


def route_by_label(df: DataFrame, label: str = LABEL) -> tuple[DataFrame, DataFrame]:
    """(rows to score, rows to train on)."""
    return df.filter(F.col(label).isNull()), df.filter(F.col(label).isNotNull())


def drop_identifiers(df: DataFrame, *more: str) -> DataFrame:
    return df.drop(*NOT_FEATURES, *more)

"""Small column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for a missing value.
NULL_TOKENS = ["", "nan", '"nan"', "none", "null", "na", "n/a", "?"]
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def rounded(value, digits: int = 6) -> Column:
    """Rounded double; adding zero turns -0.0 into 0.0."""
    return F.round(F.col(value) if isinstance(value, str) else value, digits) + F.lit(0.0)


def finite(value: Column) -> Column:
    """NaN becomes null, so that comparisons and aggregates treat it as missing."""
    return F.nanvl(value, F.lit(None).cast("double"))


def clean_text(value: Column) -> Column:
    """Trimmed lower-case text; tokens that mean "missing" become null."""
    text = F.lower(F.trim(value.cast("string")))
    return F.when(~text.isin(NULL_TOKENS), text)


def to_number(value: Column) -> Column:
    """Double from text; anything that is not a plain number becomes null."""
    text = F.trim(value.cast("string"))
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, 0 where the denominator is not positive."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(condition, 1).otherwise(0)

"""Risk features of a cleaned clinical row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.functions.columns import flag


def banded(value: Column, *limits: float) -> Column:
    """Index of the first limit above the value; past the last one, the number of limits."""
    result = F.when(value < limits[0], 0)
    for index, limit in enumerate(limits[1:], 1):
        result = result.when(value < limit, index)
    return result.otherwise(len(limits))


def hr_reserve(peak: Column, age: Column) -> Column:
    """Reached share of the age-predicted peak heart rate."""
    predicted = 220 - age
    return F.when(predicted > 0, peak / predicted).otherwise(F.lit(0.0))


def risk_factors(sex: Column, age: Column, chol: Column, pressure: Column) -> Column:
    return flag(sex == 1) + flag(age > 55) + flag(chol > 240) + flag(pressure > 140)


def feature_columns(present) -> dict[str, Column]:
    """New columns that the present ones allow, in a fixed order."""
    present = set(present)
    c = F.col
    rules: list[tuple[set[str], dict[str, Column]]] = [
        ({"age"}, {
            "age_group": banded(c("age"), 45, 55, 65),
            "elderly": flag(c("age") >= 65),
        }),
        ({"chol"}, {
            "chol_risk": banded(c("chol"), 200, 240),
            "high_chol": flag(c("chol") >= 240),
        }),
        ({"trestbps"}, {
            "bp_category": banded(c("trestbps"), 120, 140),
            "hypertension": flag(c("trestbps") >= 140),
        }),
        ({"thalch", "age"}, {
            "hr_reserve": hr_reserve(c("thalch"), c("age")),
            "low_hr_reserve": flag(hr_reserve(c("thalch"), c("age")) < 0.8),
        }),
        ({"cp"}, {
            "typical_angina": flag(c("cp") == 3),
            "asymptomatic": flag(c("cp") == 0),
        }),
        ({"exang", "oldpeak"}, {
            "exercise_intolerance": flag((c("exang") == 1) & (c("oldpeak") > 1)),
        }),
        ({"oldpeak"}, {"significant_st_depression": flag(c("oldpeak") > 2)}),
        ({"sex", "age", "chol", "trestbps"}, {
            "total_risk_factors": risk_factors(c("sex"), c("age"), c("chol"), c("trestbps")),
            "high_risk": flag(risk_factors(c("sex"), c("age"), c("chol"), c("trestbps")) >= 3),
        }),
        ({"thal"}, {
            "thal_normal": flag(c("thal") == 3),
            "thal_defect": flag(c("thal").isin(6.0, 7.0)),
        }),
    ]
    return {
        name: column
        for needed, columns in rules
        if needed <= present
        for name, column in columns.items()
    }


def add_risk_features(df: DataFrame) -> DataFrame:
    return df.withColumns(feature_columns(df.columns))

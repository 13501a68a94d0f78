"""Schemas, column lists and fixed tables of the clinical and the energy data."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _struct(*fields) -> StructType:
    return StructType([StructField(name, kind(), True) for name, kind in fields])


CLINICAL_EVENT = _struct(
    ("id", IntegerType),
    ("age", IntegerType),
    ("sex", StringType),
    ("cp", StringType),
    ("trestbps", DoubleType),
    ("chol", DoubleType),
    ("fbs", BooleanType),
    ("restecg", StringType),
    ("thalch", DoubleType),
    ("exang", BooleanType),
    ("oldpeak", DoubleType),
    ("slope", StringType),
    ("ca", DoubleType),
    ("thal", StringType),
    ("num", IntegerType),
)

# Wire form of the same event: text where producers disagree about the JSON type.
CLINICAL_EVENT_LENIENT = _struct(*[(field.name, StringType) for field in CLINICAL_EVENT])

# Headered CSV form: one more column, the source tag.
CLINICAL_CSV = _struct(
    ("id", LongType),
    ("dataset", StringType),
    ("age", DoubleType),
    ("sex", StringType),
    ("cp", StringType),
    ("trestbps", DoubleType),
    ("chol", DoubleType),
    ("fbs", StringType),
    ("restecg", StringType),
    ("thalch", DoubleType),
    ("exang", StringType),
    ("oldpeak", DoubleType),
    ("slope", StringType),
    ("ca", DoubleType),
    ("thal", StringType),
    ("num", IntegerType),
)

METERS = [
    "use [kW]", "gen [kW]", "House overall [kW]", "Dishwasher [kW]", "Furnace 1 [kW]",
    "Furnace 2 [kW]", "Home office [kW]", "Fridge [kW]", "Wine cellar [kW]", "Garage door [kW]",
    "Kitchen 12 [kW]", "Kitchen 14 [kW]", "Kitchen 38 [kW]", "Barn [kW]", "Well [kW]",
    "Microwave [kW]", "Living room [kW]", "Solar [kW]",
]
WEATHER = ["temperature", "humidity", "pressure", "windSpeed"]

ENERGY_EVENT = _struct(
    ("time", LongType),
    *[(name, DoubleType) for name in METERS],
    ("data_type", StringType),
    *[(name, DoubleType) for name in WEATHER],
)
ENERGY_FEATURES = METERS[:8] + WEATHER
ENERGY_TARGET = "use [kW]"

CLINICAL_FEATURES = [
    "age", "sex", "cp", "trestbps", "chol", "fbs", "restecg",
    "thalch", "exang", "oldpeak", "slope", "ca", "thal",
]
ENGINEERED_FEATURES = [
    "age_group", "elderly", "chol_risk", "high_chol", "bp_category", "hypertension",
    "hr_reserve", "low_hr_reserve", "typical_angina", "asymptomatic", "exercise_intolerance",
    "significant_st_depression", "total_risk_factors", "high_risk", "thal_normal", "thal_defect",
]
TEXT_CATEGORIES = ["sex", "cp", "restecg", "slope", "thal"]
JITTERED = ["age", "trestbps", "chol", "thalch", "oldpeak", "ca"]
LABEL = "num"
NOT_FEATURES = ["id", "dataset"]

# Codes of the category texts, after trim and lower.
CATEGORY_CODES = {
    "sex": {"male": 1, "female": 0, "m": 1, "f": 0},
    "cp": {
        "typical angina": 3, "atypical angina": 2, "non-anginal pain": 1, "non-anginal": 1,
        "asymptomatic": 0, "asympt": 0,
    },
    "fbs": {"true": 1, "false": 0},
    "restecg": {
        "normal": 0, "st-t abnormality": 1, "st-t": 1, "lv hypertrophy": 2, "lv": 2,
    },
    "exang": {"true": 1, "false": 0},
    "slope": {"upsloping": 0, "up": 0, "flat": 1, "downsloping": 2, "down": 2},
    "thal": {
        "normal": 3, "fixed defect": 6, "fixed": 6, "reversable defect": 7,
        "reversible defect": 7, "reversable": 7, "reversible": 7,
    },
}

# Valid range per clinical column.
VALID_RANGES = {
    "age": (0, 120), "sex": (0, 1), "cp": (0, 3), "trestbps": (80, 200), "chol": (100, 600),
    "fbs": (0, 1), "restecg": (0, 2), "thalch": (60, 220), "exang": (0, 1), "oldpeak": (0, 10),
    "slope": (0, 2), "ca": (0, 3), "thal": (3, 7),
}

# Defect codes of an older coding scheme.
THAL_RECODE = {1: 6, 2: 7}

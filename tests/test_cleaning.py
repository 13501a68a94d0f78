"""Cleaning on hand-written rows with expected values."""

from pyspark.sql import functions as F

from vitalgrid.functions import cleaning, features, scoring
from vitalgrid.functions.columns import rounded
from vitalgrid.operators import encoding
from vitalgrid.schemas import CLINICAL_EVENT, ENERGY_FEATURES, ENGINEERED_FEATURES
from vitalgrid.sources import messages

ROWS = [
    # id, age, sex, cp, trestbps, chol, fbs, restecg, thalch, exang, oldpeak, slope, ca, thal, num
    (1, 65.0, "Male", "typical angina", 140.0, 250.0, "True", "normal", 150.0, "True", 2.5, "upsloping", 1.0, "fixed defect", 1),
    (2, 45.0, "Female", "atypical angina", 120.0, 200.0, "False", "normal", 170.0, "False", 1.0, "flat", 0.0, "normal", 0),
    (3, 55.0, "Male", "non-anginal pain", 130.0, 220.0, "False", "abnormal", 160.0, "True", 2.0, "downsloping", 2.0, "reversible defect", None),
    (4, 400.0, " M ", "2", 20.0, float("nan"), '"nan"', "ST-T", 500.0, "?", -3.0, "UP", 9.0, "1", 3),
]
SCHEMA = (
    "id int, age double, sex string, cp string, trestbps double, chol double, fbs string,"
    " restecg string, thalch double, exang string, oldpeak double, slope string, ca double,"
    " thal string, num int"
)


def frame(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_validated_values(spark):
    got = {r["id"]: r for r in cleaning.validate(frame(spark)).collect()}
    first = got[1]
    assert (first["sex"], first["cp"], first["fbs"], first["restecg"], first["exang"], first["slope"], first["thal"]) == (1, 3, 1, 0, 1, 0, 6)
    assert got[3]["restecg"] is None and got[3]["cp"] == 1 and got[3]["thal"] == 7
    odd = got[4]
    assert (odd["age"], odd["sex"], odd["cp"], odd["trestbps"]) == (120, 1, 2, 80)
    assert odd["chol"] is None and odd["fbs"] is None and odd["exang"] is None
    assert (odd["restecg"], odd["thalch"], odd["oldpeak"], odd["slope"], odd["ca"], odd["thal"]) == (1, 220, 0, 0, 3, 6)


def test_clamp_is_idempotent(spark):
    once = cleaning.validate(frame(spark))
    assert cleaning.clamp_ranges(once).collect() == once.collect()


def test_risk_features(spark):
    rows = features.add_risk_features(cleaning.validate(frame(spark))).collect()
    assert set(ENGINEERED_FEATURES) <= set(rows[0].asDict())
    first = next(r for r in rows if r["id"] == 1)
    assert (first["age_group"], first["elderly"], first["chol_risk"], first["bp_category"]) == (3, 1, 2, 2)
    assert abs(first["hr_reserve"] - 150 / 155) < 1e-12 and first["low_hr_reserve"] == 0
    assert (first["total_risk_factors"], first["high_risk"]) == (3, 1)
    assert (first["exercise_intolerance"], first["significant_st_depression"], first["thal_defect"]) == (1, 1, 1)


def test_features_follow_the_columns_present(spark):
    made = features.feature_columns(["age", "thalch"])
    assert set(made) == {"age_group", "elderly", "hr_reserve", "low_hr_reserve"}


def test_unknown_category_falls_back_per_row(spark):
    known = spark.createDataFrame([("b",), ("a",), ("c",), (None,), ("c",)], "x string")
    fitted = encoding.Dictionary.of(encoding.fit_dictionary(known, ["x"]))
    rows = spark.createDataFrame([(1, "a"), (2, "c"), (3, "zzz"), (4, None)], "id int, x string")
    codes = {r["id"]: r["x"] for r in encoding.encode(rows, ["x"], fitted).collect()}
    assert codes == {1: 0, 2: 2, 3: 0, 4: 3}
    frequent = encoding.most_frequent(known, ["x"])
    codes = {r["id"]: r["x"] for r in encoding.encode(rows, ["x"], fitted, fallback=frequent).collect()}
    assert codes[3] == 2
    stored = encoding.Dictionary.of(encoding.fit_dictionary(known, ["x"]), limit=2)
    assert stored.entries is None
    assert {r["id"]: r["x"] for r in encoding.encode(rows, ["x"], stored).collect()} == {1: 0, 2: 2, 3: 0, 4: 3}


def test_zero_deviation_scales_by_one(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 2.0), (5.0, 4.0)], "a double, b double")
    scale = encoding.collect_scale(encoding.fit_scale(df, ["a", "b"]))
    assert scale["a"] == (5.0, 1.0) and abs(scale["b"][1] - 1.247219) < 1e-6


def test_tiers(spark):
    df = spark.createDataFrame([(0.71,), (0.7,), (0.31,), (0.3,)], "p double")
    assert [r[0] for r in df.select(scoring.risk_tier(F.col("p"))).collect()] == ["High", "Medium", "Medium", "Low"]
    errors = spark.createDataFrame([(2.0, 4.0), (2.0, 0.0), (2.0, -1.0)], "e double, a double")
    assert [r[0] for r in errors.select(scoring.percent_error(F.col("e"), F.col("a"))).collect()] == [50.0, 0.0, 0.0]


def test_clinical_messages(spark):
    texts = [
        '{"id": 1, "age": 63.0, "sex": "Male", "chol": NaN, "fbs": "TRUE", "thal": NaN, "num": 0}',
        '{"id": "2", "age": "41", "fbs": false, "chol": "204", "thal": "normal", "extra": 1}',
        "no json at all",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    good, bad = messages.split_corrupt(messages.decode_clinical(df))
    assert bad.count() == 1
    rows = {r["id"]: r for r in good.collect()}
    assert good.schema == CLINICAL_EVENT
    assert rows[1]["age"] == 63 and rows[1]["chol"] is None and rows[1]["fbs"] is True
    assert rows[1]["thal"] is None and rows[1]["num"] == 0
    assert rows[2]["chol"] == 204.0 and rows[2]["fbs"] is False and rows[2]["num"] is None


def test_energy_columns(spark):
    df = spark.createDataFrame([(1.0, float("nan"))], "`use [kW]` double, `gen [kW]` double")
    filled = cleaning.fill_defaults(df, ["use [kW]", "gen [kW]"])
    weather = messages.derive_weather(filled, "use [kW]")
    row = cleaning.select_features(weather, ENERGY_FEATURES).first()
    assert len(row) == 12 and row["gen [kW]"] == 0 and row["temperature"] == 25 and row["Fridge [kW]"] == 0
    assert messages.derive_weather(weather, "use [kW]") is weather


def test_rounded_has_no_negative_zero(spark):
    value = spark.range(1).select(rounded(F.lit(-1e-9)).alias("x")).first()["x"]
    assert str(value) == "0.0"

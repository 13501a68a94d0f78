"""The same results as plain SQL over the given tables, one statement per query."""

from __future__ import annotations

PATIENTS = """
SELECT o_orderkey AS id,
  CASE o_custkey % 3 WHEN 0 THEN 'site_a' WHEN 1 THEN 'site_b' ELSE 'site_c' END AS dataset,
  CAST(25 + (o_orderkey * 7) % 110 AS DOUBLE) AS age,
  CASE (o_orderkey * 13) % 5 WHEN 0 THEN 'Male' WHEN 1 THEN ' male ' WHEN 2 THEN 'Female' WHEN 3 THEN 'F' END AS sex,
  CASE (o_orderkey * 3 + o_custkey) % 7 WHEN 0 THEN 'typical angina' WHEN 1 THEN 'atypical angina' WHEN 2 THEN 'non-anginal'
    WHEN 3 THEN 'asymptomatic' WHEN 4 THEN 'Asympt' WHEN 5 THEN '2' ELSE '9' END AS cp,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(70 + o_custkey % 150 AS DOUBLE) END AS trestbps,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(80 + CAST(floor(o_totalprice / 900) AS INT) AS DOUBLE) END AS chol,
  CASE o_orderkey % 4 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'FALSE' WHEN 2 THEN 'true' ELSE 'nan' END AS fbs,
  CASE o_custkey % 4 WHEN 0 THEN 'normal' WHEN 1 THEN 'ST-T abnormality' WHEN 2 THEN 'lv hypertrophy' ELSE 'abnormal' END AS restecg,
  CAST(50 + (o_orderkey * 11 + o_custkey) % 190 AS DOUBLE) AS thalch,
  CASE (o_orderkey + o_custkey) % 3 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'FALSE' END AS exang,
  CAST((o_orderkey * 31) % 120 AS DOUBLE) / 10 - 1 AS oldpeak,
  CASE (o_orderkey * 5 + o_custkey) % 4 WHEN 0 THEN 'upsloping' WHEN 1 THEN 'flat' WHEN 2 THEN 'down' ELSE 'unknown' END AS slope,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_custkey % 6 AS DOUBLE) END AS ca,
  CASE (o_orderkey * 7 + o_custkey) % 6 WHEN 0 THEN 'normal' WHEN 1 THEN 'fixed' WHEN 2 THEN 'reversable defect'
    WHEN 3 THEN 'reversible' WHEN 4 THEN '1' ELSE 'nan' END AS thal,
  CASE WHEN o_orderkey % 10 = 9 THEN NULL ELSE CAST(greatest(0, (CASE WHEN (o_orderkey * 7) % 110 > 50 THEN 1 ELSE 0 END)
    + (CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END) + (CASE WHEN o_custkey % 3 = 0 THEN 2 ELSE 0 END) - 1) AS INT) END AS num
FROM orders
"""

SERIES = "SELECT user_id AS series_id, event_id, ts AS time, event_type AS data_type, value AS use_kw FROM events"

SCORED = """
SELECT id, y, CAST(score100 AS DOUBLE) / 100 AS score, CASE WHEN score100 > 50 THEN 1 ELSE 0 END AS pred
FROM (
  SELECT o_orderkey AS id, CASE WHEN o_totalprice > 300000 THEN 1 ELSE 0 END AS y,
    (CASE WHEN o_totalprice > 300000 THEN 30 ELSE 0 END) + (o_orderkey * 37 + o_custkey) % 70 AS score100
  FROM orders) t
"""

IMPORTANCES = """
SELECT p_brand AS feature, CASE WHEN p_brand < 'Brand#3' THEN 'clinical' ELSE 'engineered' END AS kind,
  CAST(sum(p_size) AS BIGINT) AS weight
FROM part GROUP BY p_brand
"""

DOCS = """
SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""

FEATURES = [
    "age", "sex", "cp", "trestbps", "chol", "fbs", "restecg", "thalch", "exang", "oldpeak",
    "slope", "ca", "thal",
]
TEXTS = ["sex", "cp", "restecg", "slope", "thal"]
MEASURED = ["age", "trestbps", "chol", "thalch", "oldpeak", "ca"]


def r6(expression: str) -> str:
    return f"(round({expression}, 6) + CAST(0 AS DOUBLE))"


def rounded_list(columns, expression="{c}") -> str:
    return ", ".join(f"{r6(expression.format(c=c))} AS {c}" for c in columns)


def number(text: str) -> str:
    return f"nullif(TRY_CAST({text} AS DOUBLE), CAST('nan' AS DOUBLE))"


MAPPED = f"""
SELECT id, dataset, num, age, trestbps, chol, thalch, oldpeak, ca,
  CASE lower(trim(sex)) WHEN 'male' THEN 1 WHEN 'm' THEN 1 WHEN 'female' THEN 0 WHEN 'f' THEN 0
    ELSE {number('sex')} END AS sex,
  CASE lower(trim(cp)) WHEN 'typical angina' THEN 3 WHEN 'atypical angina' THEN 2
    WHEN 'non-anginal pain' THEN 1 WHEN 'non-anginal' THEN 1 WHEN 'asymptomatic' THEN 0 WHEN 'asympt' THEN 0
    ELSE {number('cp')} END AS cp,
  CASE lower(trim(fbs)) WHEN 'true' THEN 1 WHEN 'false' THEN 0 ELSE {number('fbs')} END AS fbs,
  CASE lower(trim(restecg)) WHEN 'normal' THEN 0 WHEN 'st-t abnormality' THEN 1 WHEN 'st-t' THEN 1
    WHEN 'lv hypertrophy' THEN 2 WHEN 'lv' THEN 2 ELSE {number('restecg')} END AS restecg,
  CASE lower(trim(exang)) WHEN 'true' THEN 1 WHEN 'false' THEN 0 ELSE {number('exang')} END AS exang,
  CASE lower(trim(slope)) WHEN 'upsloping' THEN 0 WHEN 'up' THEN 0 WHEN 'flat' THEN 1
    WHEN 'downsloping' THEN 2 WHEN 'down' THEN 2 ELSE {number('slope')} END AS slope,
  CASE lower(trim(thal)) WHEN 'normal' THEN 3 WHEN 'fixed defect' THEN 6 WHEN 'fixed' THEN 6
    WHEN 'reversable defect' THEN 7 WHEN 'reversible defect' THEN 7 WHEN 'reversable' THEN 7 WHEN 'reversible' THEN 7
    ELSE {number('thal')} END AS thal
FROM patients
"""

RANGES = {
    "age": (0, 120), "sex": (0, 1), "cp": (0, 3), "trestbps": (80, 200), "chol": (100, 600),
    "fbs": (0, 1), "restecg": (0, 2), "thalch": (60, 220), "exang": (0, 1), "oldpeak": (0, 10),
    "slope": (0, 2), "ca": (0, 3), "thal": (3, 7),
}


def _clamped(c: str) -> str:
    low, high = RANGES[c]
    value = "CASE thal WHEN 1 THEN 6 WHEN 2 THEN 7 ELSE thal END" if c == "thal" else c
    return (
        f"CASE WHEN {c} IS NULL THEN NULL ELSE CAST(least(greatest({value}, {low}), {high}) AS DOUBLE) END AS {c}"
    )


CLAMPED = (
    "SELECT id, dataset, num, CASE WHEN num > 0 THEN 1 ELSE 0 END AS label, "
    + ", ".join(_clamped(c) for c in FEATURES) + " FROM mapped"
)
IMPUTED = (
    "SELECT id, dataset, num, label, "
    + ", ".join(f"coalesce({c}, (SELECT median({c}) FROM clamped)) AS {c}" for c in FEATURES)
    + " FROM clamped"
)

ENGINEERED = {
    "age_group": "CASE WHEN age < 45 THEN 0 WHEN age < 55 THEN 1 WHEN age < 65 THEN 2 ELSE 3 END",
    "elderly": "CASE WHEN age >= 65 THEN 1 ELSE 0 END",
    "chol_risk": "CASE WHEN chol < 200 THEN 0 WHEN chol < 240 THEN 1 ELSE 2 END",
    "high_chol": "CASE WHEN chol >= 240 THEN 1 ELSE 0 END",
    "bp_category": "CASE WHEN trestbps < 120 THEN 0 WHEN trestbps < 140 THEN 1 ELSE 2 END",
    "hypertension": "CASE WHEN trestbps >= 140 THEN 1 ELSE 0 END",
    "hr_reserve": r6("CASE WHEN 220 - age > 0 THEN thalch / (220 - age) ELSE 0 END"),
    "low_hr_reserve": "CASE WHEN (CASE WHEN 220 - age > 0 THEN thalch / (220 - age) ELSE 0 END) < 0.8 THEN 1 ELSE 0 END",
    "typical_angina": "CASE WHEN cp = 3 THEN 1 ELSE 0 END",
    "asymptomatic": "CASE WHEN cp = 0 THEN 1 ELSE 0 END",
    "exercise_intolerance": "CASE WHEN exang = 1 AND oldpeak > 1 THEN 1 ELSE 0 END",
    "significant_st_depression": "CASE WHEN oldpeak > 2 THEN 1 ELSE 0 END",
    "total_risk_factors": "(CASE WHEN sex = 1 THEN 1 ELSE 0 END) + (CASE WHEN age > 55 THEN 1 ELSE 0 END)"
    " + (CASE WHEN chol > 240 THEN 1 ELSE 0 END) + (CASE WHEN trestbps > 140 THEN 1 ELSE 0 END)",
    "high_risk": "CASE WHEN (CASE WHEN sex = 1 THEN 1 ELSE 0 END) + (CASE WHEN age > 55 THEN 1 ELSE 0 END)"
    " + (CASE WHEN chol > 240 THEN 1 ELSE 0 END) + (CASE WHEN trestbps > 140 THEN 1 ELSE 0 END) >= 3 THEN 1 ELSE 0 END",
    "thal_normal": "CASE WHEN thal = 3 THEN 1 ELSE 0 END",
    "thal_defect": "CASE WHEN thal IN (6, 7) THEN 1 ELSE 0 END",
}

FORECASTS = """
SELECT series_id, event_id, time, data_type, actual, predicted, abs(predicted - actual) AS error,
  CASE WHEN actual > 0 THEN abs(predicted - actual) / actual * 100 ELSE 0 END AS error_pct
FROM (
  SELECT series_id, event_id, time, data_type, use_kw AS actual,
    lag(use_kw) OVER (PARTITION BY series_id ORDER BY time, event_id) AS predicted
  FROM series) t
WHERE predicted IS NOT NULL
"""

PARTS = {
    "patients": PATIENTS, "mapped": MAPPED, "clamped": CLAMPED, "imputed": IMPUTED,
    "series": SERIES, "scored": SCORED, "importances": IMPORTANCES, "docs": DOCS,
    "forecasts": FORECASTS,
}
NEEDS = {
    "mapped": ["patients"], "clamped": ["patients", "mapped"],
    "imputed": ["patients", "mapped", "clamped"], "forecasts": ["series"],
}


def over(*names: str, select: str, more: dict[str, str] | None = None) -> str:
    """A statement over the named views (with those they need) and further ones."""
    wanted: list[str] = []
    for name in names:
        for part in [*NEEDS.get(name, []), name]:
            if part not in wanted:
                wanted.append(part)
    views = {name: PARTS[name] for name in wanted} | (more or {})
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in views.items()) + "\n" + select


def engineered(names, source: str) -> str:
    return "SELECT id, " + ", ".join(f"{ENGINEERED[c]} AS {c}" for c in names) + f" FROM {source}"


def union_all(parts) -> str:
    return "\nUNION ALL\n".join(parts)


CENTS = "CAST(CAST(round(x * 100) AS BIGINT) AS VARCHAR)"


def sequence_text(values: str) -> str:
    return f"array_to_string(list_transform({values}, lambda x: {CENTS}), ',')"


POSITIONS = """
SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY time, event_id) AS rn,
  count(*) OVER (PARTITION BY series_id) AS n FROM series
"""
LABELLED = "SELECT *, CASE WHEN num > 0 THEN 1 ELSE 0 END AS label FROM patients WHERE num IS NOT NULL"
BLOCKS = """
SELECT * FROM (
  SELECT *, CAST(floor((rn - 1) / 5) AS BIGINT) AS block, count(*) OVER () AS total FROM (
    SELECT *, row_number() OVER (ORDER BY id) AS rn FROM labelled) a) b
WHERE block < floor(total / 5)
"""
THRESHOLDS = """
SELECT score AS threshold,
  sum(sum(y)) OVER (ORDER BY score DESC) AS tp, sum(sum(1 - y)) OVER (ORDER BY score DESC) AS fp,
  sum(sum(y)) OVER () AS p, sum(sum(1 - y)) OVER () AS n, sum(y) AS pos, sum(1 - y) AS neg
FROM scored GROUP BY score
"""
AUC = "sum(pos * (n - fp + neg / 2.0)) / max(p) / max(n)"


def ratio(a: str, b: str) -> str:
    return f"(CASE WHEN {b} > 0 THEN CAST({a} AS DOUBLE) / {b} ELSE 0 END)"


def _report() -> str:
    def f1(p, r):
        return ratio(f"2 * {p} * {r}", f"({p} + {r})")

    rows = []
    for c in (0, 1):
        p, r = ratio(f"hit{c}", f"said{c}"), ratio(f"hit{c}", f"support{c}")
        rows.append(f"SELECT '{c}' AS class, {p} AS precision, {r} AS recall, {f1(p, r)} AS f1, support{c} AS support FROM counts")
    more = {
        "counts": "SELECT count(*) AS total, " + ", ".join(
            f"count(*) FILTER (WHERE y = {c} AND pred = {c}) AS hit{c}, count(*) FILTER (WHERE pred = {c}) AS said{c},"
            f" count(*) FILTER (WHERE y = {c}) AS support{c}" for c in (0, 1)
        ) + " FROM scored",
        "classes": union_all(rows),
        "averages": (
            "SELECT 'accuracy' AS class, CAST(hit0 + hit1 AS DOUBLE) / total AS precision, CAST(hit0 + hit1 AS DOUBLE) / total AS recall,"
            " CAST(hit0 + hit1 AS DOUBLE) / total AS f1, total AS support FROM counts UNION ALL"
            " SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM classes UNION ALL"
            " SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),"
            " sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM classes"
        ),
    }
    select = (
        f"SELECT class, {rounded_list(['precision', 'recall', 'f1'])}, CAST(support AS BIGINT) AS support"
        " FROM (SELECT * FROM classes UNION ALL SELECT * FROM averages) t"
    )
    return over("scored", more=more, select=select)


def _evaluate() -> str:
    more = {
        "c": "SELECT count(*) FILTER (WHERE y=0 AND pred=0) AS tn, count(*) FILTER (WHERE y=0 AND pred=1) AS fp,"
        " count(*) FILTER (WHERE y=1 AND pred=0) AS fn, count(*) FILTER (WHERE y=1 AND pred=1) AS tp FROM scored",
        "t": THRESHOLDS,
    }
    precision, recall = ratio("tp", "(tp + fp)"), ratio("tp", "(tp + fn)")
    values = {
        "accuracy": "CAST(tp + tn AS DOUBLE) / (tn + fp + fn + tp)",
        "precision": precision, "recall": recall,
        "f1": ratio(f"2 * {precision} * {recall}", f"({precision} + {recall})"),
        "specificity": ratio("tn", "(tn + fp)"),
        "tn": "CAST(tn AS DOUBLE)", "fp": "CAST(fp AS DOUBLE)",
        "fn": "CAST(fn AS DOUBLE)", "tp": "CAST(tp AS DOUBLE)",
    }
    parts = [f"SELECT '{k}' AS metric, {r6(v)} AS value FROM c" for k, v in values.items()]
    parts.append(f"SELECT 'auc', {r6(AUC)} FROM t")
    return over("scored", more=more, select=union_all(parts))


BOARD_PARTS = {
    "folded": "SELECT y, score, (row_number() OVER (PARTITION BY y ORDER BY md5(CAST(id AS VARCHAR)), id) - 1) % 5 AS fold FROM scored",
    "models": "SELECT * FROM (VALUES ('fine', 100), ('tenths', 10), ('quarters', 4)) v(model, steps)",
    "coarse": "SELECT model, y, fold, floor(score * steps + 1e-9) / steps AS score FROM folded CROSS JOIN models",
    "rows_": "SELECT model, fold, y, score, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS pred FROM coarse",
    "acc": "SELECT model, avg(CASE WHEN y = pred THEN 1.0 ELSE 0.0 END) AS accuracy FROM rows_ GROUP BY model",
    "folds": "SELECT model, fold, avg(CASE WHEN y = pred THEN 1.0 ELSE 0.0 END) AS accuracy FROM rows_ GROUP BY model, fold",
    "dev": "SELECT model, stddev_pop(accuracy) AS cv_std FROM folds GROUP BY model",
    "t": "SELECT model, sum(y) AS pos, sum(1 - y) AS neg,"
    " sum(sum(1 - y)) OVER (PARTITION BY model ORDER BY score DESC) AS fp,"
    " sum(sum(y)) OVER (PARTITION BY model) AS p, sum(sum(1 - y)) OVER (PARTITION BY model) AS n"
    " FROM rows_ GROUP BY model, score",
    "aucs": f"SELECT model, {AUC} AS auc FROM t GROUP BY model",
    "board": f"SELECT acc.model, {r6('accuracy')} AS accuracy, {r6('auc')} AS auc, {r6('cv_std')} AS cv_std"
    " FROM acc JOIN aucs ON acc.model = aucs.model JOIN dev ON acc.model = dev.model",
}

PREVIEW = union_all(
    f"SELECT '{c}' AS \"column\", value FROM (SELECT DISTINCT {c} AS value FROM patients WHERE {c} IS NOT NULL ORDER BY 1 LIMIT 5) x"
    for c in [*TEXTS, "fbs", "exang"]
)
DICTIONARY = union_all(
    f"SELECT '{c}' AS \"column\", value, CAST(row_number() OVER (ORDER BY value) - 1 AS BIGINT) AS code"
    f" FROM (SELECT DISTINCT coalesce({c}, 'unknown') AS value FROM {{source}}) x" for c in TEXTS
)
PATIENT_TYPES = {
    "id": "bigint", "dataset": "string", "age": "double", "sex": "string", "cp": "string",
    "trestbps": "double", "chol": "double", "fbs": "string", "restecg": "string",
    "thalch": "double", "exang": "string", "oldpeak": "double", "slope": "string", "ca": "double",
    "thal": "string", "num": "int",
}
DOC_COLUMNS = ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]


def _preprocess() -> str:
    numeric = MEASURED + ["fbs", "exang"]
    joins = "".join(
        f" LEFT JOIN dict d_{c} ON d_{c}.\"column\" = '{c}' AND d_{c}.value = coalesce(p.{c}, 'unknown')" for c in TEXTS
    )
    more = {
        "dict": DICTIONARY.format(source="patients"),
        "raw": "SELECT p.id, " + ", ".join(f"p.{c}" for c in MEASURED) + ", m.fbs, m.exang, "
        + ", ".join(f"coalesce(d_{c}.code, 0) AS {c}" for c in TEXTS)
        + " FROM patients p JOIN mapped m ON p.id = m.id" + joins,
        "filled": "SELECT id, " + ", ".join(f"coalesce({c}, (SELECT median({c}) FROM raw)) AS {c}" for c in numeric)
        + ", " + ", ".join(TEXTS) + " FROM raw",
    }
    return over("mapped", more=more, select=_scaled("filled", numeric + TEXTS))


def _scaled(source: str, columns) -> str:
    stats = ", ".join(
        f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS s_{c}" for c in columns
    )
    values = ", ".join(f"{r6(f'({c} - m_{c}) / s_{c}')} AS {c}" for c in columns)
    return f"SELECT id, {values} FROM {source} CROSS JOIN (SELECT {stats} FROM {source}) s"


def _unit(column: str) -> str:
    digest = f"md5(concat_ws('|', CAST(id AS VARCHAR), '{column}', CAST(copy AS VARCHAR)))"
    return f"(CAST(CAST('0x' || substr({digest}, 1, 8) AS BIGINT) AS DOUBLE) / 2147483648.0 - 1.0)"


def _augment() -> str:
    def copies(shift, label, scale):
        values = ", ".join(
            f"{r6(f'CASE WHEN {c} IS NULL THEN NULL ELSE greatest(0, {c} * (1.0 + {scale} * {_unit(c)})) END')} AS {c}"
            for c in MEASURED
        )
        return f"id + {shift} + copy AS id, block, {label} AS label, 1 AS synthetic, {values}"

    more = {
        "labelled": LABELLED,
        "blocks": BLOCKS,
        "placed": "SELECT id, block, label, " + ", ".join(MEASURED) + ","
        " row_number() OVER (PARTITION BY block ORDER BY id) AS place,"
        " count(*) OVER (PARTITION BY block) AS n, sum(label) OVER (PARTITION BY block) AS ones FROM blocks",
    }
    select = union_all([
        f"SELECT id, block, label, 0 AS synthetic, {rounded_list(MEASURED)} FROM blocks",
        f"SELECT {copies(10000, '1 - label', 0.05)} FROM (SELECT *, place - 1 AS copy FROM placed"
        " WHERE (ones = 0 OR ones = n) AND place <= greatest(2, n // 2)) a",
        f"SELECT {copies(20000, 'label', 0.03)} FROM (SELECT placed.*, k.copy FROM placed CROSS JOIN (VALUES (0), (1)) k(copy)"
        " WHERE (n - ones = 1 AND label = 0) OR (ones = 1 AND n - ones <> 1 AND label = 1)) b",
    ])
    return over("patients", more=more, select=select)


def _bayes(train: str, keys: str, rows: str, on: str) -> dict[str, str]:
    """Views `stats`, `floors` and `best` of a Gaussian model per value of `keys`."""
    lead = f"{keys}, " if keys else ""
    long = union_all(f"SELECT {lead}label, '{c}' AS f, {c} AS x FROM {train}" for c in FEATURES)
    by_key = f"PARTITION BY {keys}" if keys else ""
    long_rows = union_all(f"SELECT id, {'fold, ' if keys else ''}'{c}' AS f, {c} AS x FROM {rows}" for c in FEATURES)
    return {
        "long": long,
        "stats": f"SELECT {lead}label, f, avg(x) AS m, var_pop(x) AS v, count(*) AS n FROM long GROUP BY {lead}label, f",
        "spread": f"SELECT {lead}f, var_pop(x) AS v FROM long GROUP BY {lead}f",
        "floors": f"SELECT {lead}1e-9 * max(v) AS eps FROM spread" + (f" GROUP BY {keys}" if keys else ""),
        "priors": f"SELECT {lead}label, ln(CAST(n AS DOUBLE) / sum(n) OVER ({by_key})) AS prior"
        f" FROM (SELECT DISTINCT {lead}label, n FROM stats) q",
        "long_rows": long_rows,
        "scores": f"SELECT r.id, s.label, max(p.prior) - 0.5 * sum(ln(2 * pi() * (s.v + e.eps)) + (r.x - s.m) * (r.x - s.m) / (s.v + e.eps)) AS score"
        f" FROM long_rows r JOIN stats s ON r.f = s.f{on.format(a='s')}"
        f" JOIN floors e ON true{on.format(a='e')} JOIN priors p ON p.label = s.label{on.format(a='p')}"
        " GROUP BY r.id, s.label",
        "best": "SELECT id, label AS predicted FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, label) AS rn FROM scores) q WHERE rn = 1",
    }


FOLDED = {
    "folded": "SELECT *, (row_number() OVER (PARTITION BY label ORDER BY md5(CAST(id AS VARCHAR)), id) - 1) % 5 AS fold"
    " FROM imputed WHERE num IS NOT NULL",
    "others": "SELECT k.held, f.* FROM folded f JOIN (SELECT DISTINCT fold AS held FROM folded) k ON f.fold <> k.held",
}
FOLD_ROWS = FOLDED | _bayes("others", "held", "folded", " AND {a}.held = r.fold") | {
    "per_fold": "SELECT CAST(f.fold AS INTEGER) AS fold, count(*) AS rows, avg(CASE WHEN b.predicted = f.label THEN 1.0 ELSE 0.0 END) AS accuracy"
    " FROM folded f JOIN best b ON f.id = b.id GROUP BY f.fold",
}

DISTANCES = """
SELECT a.vec_id, b.vec_id AS neighbour, b.label,
  sqrt(list_sum(list_transform(list_zip(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS distance
FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id
"""
NEAREST = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbour) AS rank FROM distances) q WHERE rank <= 5
"""


def _missing(source: str, columns, tag: str, doubles=()) -> str:
    return union_all(
        f"SELECT '{tag}' AS source, '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL"
        + (f" OR isnan({c})" if c in doubles else "") + f") AS missing FROM {source}"
        for c in columns
    )


DOUBLES = [c for c, t in PATIENT_TYPES.items() if t == "double"]

ORACLES = {
    # sources
    "scan_csv": over("patients", select="SELECT " + ", ".join(PATIENT_TYPES) + " FROM patients"),
    "head_n": over("patients", select="SELECT id, dataset, age, num FROM patients ORDER BY id LIMIT 100"),
    "json_decode": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "json_encode": over("patients", select=(
        "SELECT CAST(id AS VARCHAR) AS key, id, " + ", ".join(f"coalesce({c}, 0) AS {c}" for c in MEASURED)
        + ", sex, cp, thal, num, 'clinical' AS data_type FROM patients")),
    "pair_emit": over("patients", more={
        "numbered": "SELECT *, row_number() OVER (ORDER BY id) - 1 AS i FROM patients",
        "versions": "SELECT * FROM (VALUES (1), (2)) t(version)",
    }, select="SELECT id, age, CASE WHEN version = 2 THEN num END AS num, CAST(i // 100 + 1 AS BIGINT) AS pair_id, version,"
        " 'pair_' || CAST(i // 100 + 1 AS VARCHAR) || '_v' || CAST(version AS VARCHAR) || '_' || CAST(i AS VARCHAR) AS key"
        " FROM numbered CROSS JOIN versions"),
    "multi_source_union": over("patients", "docs", select=(
        "SELECT 'clinical' AS source, id, age, CAST(NULL AS BIGINT) AS n_chars, num AS label FROM patients UNION ALL"
        " SELECT 'documents', doc_id, NULL, n_chars, quality FROM docs")),
    "ingest_tally": (
        "WITH m AS (SELECT 'events' AS batch, props AS v FROM events UNION ALL SELECT 'documents', text FROM documents)"
        " SELECT batch, count(*) FILTER (WHERE json_valid(v)) AS sent, count(*) FILTER (WHERE NOT json_valid(v)) AS failed,"
        f" {r6('avg(CASE WHEN json_valid(v) THEN 1.0 ELSE 0.0 END)')} AS rate FROM m GROUP BY batch"),
    # cleaning and features
    "select_features": over("patients", select="SELECT id, age, chol, CAST(0 AS DOUBLE) AS bmi, trestbps, oldpeak FROM patients"),
    "route_by_label": over("patients", "docs", select=(
        "SELECT 'clinical' AS source, id, CASE WHEN num IS NULL THEN 'score' ELSE 'train' END AS route FROM patients UNION ALL"
        " SELECT 'documents', doc_id, CASE WHEN quality IS NULL THEN 'score' ELSE 'train' END FROM docs")),
    "fill_defaults": over("patients", select="SELECT id, coalesce(trestbps, 0) AS trestbps, coalesce(chol, 0) AS chol, coalesce(ca, 0) AS ca FROM patients"),
    "binarize_label": over("patients", select="SELECT id, CASE WHEN num > 0 THEN 1 ELSE 0 END AS label FROM patients"),
    "coerce_numeric": over("patients", select=(
        f"SELECT id, age, {number('cp')} AS cp, {number('fbs')} AS fbs, {number('thal')} AS thal, trestbps FROM patients")),
    "map_categories": over("mapped", select="SELECT id, sex, cp, fbs, restecg, exang, slope, thal FROM mapped"),
    "clamp_ranges": over("clamped", select="SELECT id, " + ", ".join(FEATURES) + " FROM clamped"),
    "bucketize": over("clamped", select=engineered(["age_group", "chol_risk", "bp_category"], "clamped")),
    "risk_flags": over("clamped", select=engineered([
        "elderly", "high_chol", "hypertension", "typical_angina", "asymptomatic",
        "significant_st_depression", "thal_normal", "thal_defect", "exercise_intolerance"], "clamped")),
    "hr_reserve": over("clamped", select=engineered(["hr_reserve", "low_hr_reserve"], "clamped")),
    "risk_score": over("clamped", select=engineered(["total_risk_factors", "high_risk"], "clamped")),
    "feature_engineering": over("imputed", select=engineered(list(ENGINEERED), "imputed")),
    "clean_and_engineer": over("imputed", select=(
        f"SELECT id, {rounded_list(FEATURES)}, "
        + ", ".join(f"{ENGINEERED[c]} AS {c}" for c in ("age_group", "total_risk_factors", "thal_defect"))
        + ", label FROM imputed")),
    # encoding
    "label_encode": over("patients", select=DICTIONARY.format(source="patients")),
    "label_encode_transform": over("patients", more={
        "tidy": "SELECT " + ", ".join(f"lower(trim({c})) AS {c}" for c in TEXTS) + " FROM patients",
        "dict": DICTIONARY.format(source="tidy"),
    }, select="SELECT p.id, " + ", ".join(f"coalesce(d_{c}.code, 0) AS {c}_code" for c in TEXTS) + " FROM patients p" + "".join(
        f" LEFT JOIN dict d_{c} ON d_{c}.\"column\" = '{c}' AND d_{c}.value = coalesce(p.{c}, 'unknown')" for c in TEXTS)),
    "median_impute": over("imputed", select=f"SELECT id, {rounded_list(FEATURES)} FROM imputed"),
    "standard_scale_fit": over("imputed", select=union_all(
        f"SELECT '{c}' AS feature, {r6(f'avg({c})')} AS mean,"
        f" {r6(f'CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END')} AS std FROM imputed" for c in FEATURES)),
    "standard_scale": over("imputed", select=_scaled("imputed", FEATURES)),
    "preprocess": _preprocess(),
    # profiles
    "row_count": over("patients", select="SELECT count(*) AS n FROM patients"),
    "class_distribution": over("patients", select="SELECT num, count(*) AS n FROM patients GROUP BY num"),
    "source_distribution": over("patients", select="SELECT dataset, count(*) AS n FROM patients GROUP BY dataset"),
    "minority_class": over("patients", select="SELECT num, count(*) AS n FROM patients WHERE num IS NOT NULL GROUP BY num ORDER BY n, num LIMIT 1"),
    "missing_profile": over("patients", "docs", select=union_all([
        _missing("patients", PATIENT_TYPES, "clinical", DOUBLES), _missing("docs", DOC_COLUMNS, "documents")])),
    "describe": over("patients", select=union_all(
        f"SELECT '{c}' AS \"column\", count({c}) AS n, {r6(f'avg({c})')} AS mean, {r6(f'stddev_samp({c})')} AS std, {r6(f'min({c})')} AS low,"
        f" {r6(f'quantile_cont({c}, 0.25)')} AS q25, {r6(f'quantile_cont({c}, 0.5)')} AS q50, {r6(f'quantile_cont({c}, 0.75)')} AS q75,"
        f" {r6(f'max({c})')} AS high FROM patients" for c in MEASURED)),
    "schema_profile": over("patients", select=union_all(
        f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count({c}) AS n_values, count(DISTINCT {c}) AS n_distinct, '{t}' AS type FROM patients"
        for c, t in PATIENT_TYPES.items())),
    "distinct_preview": over("patients", select=PREVIEW),
    "training_check": over("patients", select=(
        "SELECT CASE WHEN count(*) = 0 THEN 'error: no data' WHEN count(DISTINCT num) > 1 THEN 'data_prepared' ELSE 'warning: single class' END AS status,"
        " count(*) AS num_samples, CAST(13 AS BIGINT) AS num_features FROM patients WHERE num IS NOT NULL")),
    # splits
    "train_blocks": over("patients", more={"labelled": LABELLED, "blocks": BLOCKS}, select="SELECT id, label, block FROM blocks"),
    "stratified_split": over("patients", more={"labelled": LABELLED}, select=(
        "SELECT id, label, CASE WHEN rn <= ceil(n * 0.2) THEN 'test' ELSE 'train' END AS part FROM ("
        "SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(id AS VARCHAR)), id) AS rn,"
        " count(*) OVER (PARTITION BY label) AS n FROM labelled) t")),
    "stratified_kfold": over("patients", more={"labelled": LABELLED}, select=(
        "SELECT id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY md5(CAST(id AS VARCHAR)), id) - 1) % 5 AS INTEGER) AS fold FROM labelled")),
    "augment_minority": _augment(),
    # closed-form models
    "gaussian_nb": over("imputed", more={"train": "SELECT * FROM imputed WHERE num IS NOT NULL"} | _bayes("train", "", "imputed", ""),
        select="SELECT id, predicted FROM best"),
    "cv_fold_accuracy": over("imputed", more=FOLD_ROWS, select=f"SELECT fold, rows, {r6('accuracy')} AS accuracy FROM per_fold"),
    "cv_summary": over("imputed", more=FOLD_ROWS, select=f"SELECT count(*) AS folds, {r6('avg(accuracy)')} AS mean, {r6('stddev_pop(accuracy)')} AS std FROM per_fold"),
    "knn_topk": f"WITH distances AS ({DISTANCES}), nearest AS ({NEAREST}) SELECT vec_id, CAST(rank AS INTEGER) AS rank, neighbour, {r6('distance')} AS distance FROM nearest",
    "knn_classify": f"WITH distances AS ({DISTANCES}), nearest AS ({NEAREST})," """
closest AS (SELECT *, min(distance) OVER (PARTITION BY vec_id) AS least FROM nearest),
votes AS (SELECT vec_id, label, sum(CASE WHEN least > 0 THEN 1 / distance WHEN distance = 0 THEN 1 ELSE 0 END) AS weight FROM closest GROUP BY vec_id, label)
SELECT vec_id, label AS predicted FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY weight DESC, label) AS rn FROM votes) q WHERE rn = 1""",
    # series
    "tail_n": over("series", select="SELECT event_id, series_id, use_kw FROM series ORDER BY time DESC, event_id DESC LIMIT 1000"),
    "filter_type": over("series", select="SELECT event_id, series_id, use_kw FROM series WHERE data_type = 'purchase'"),
    "derive_weather": over("series", select=(
        f"SELECT event_id, {r6('20 + use_kw * 5')} AS temperature, {r6('60 + use_kw * 10')} AS humidity,"
        f" {r6('1013 + use_kw * 2')} AS pressure, {r6('5 + use_kw * 3')} AS \"windSpeed\" FROM series")),
    "epoch_format": over("series", select="SELECT event_id, CAST(floor(epoch(time)) AS BIGINT) AS epoch, strftime(time, '%H:%M:%S') AS clock FROM series"),
    "downsample": over("series", more={"pos": POSITIONS}, select="SELECT event_id, series_id, use_kw FROM pos WHERE (rn - 1) % 10 = 0"),
    "sliding_sequence": over("series", more={
        "pos": POSITIONS,
        "w": "SELECT series_id, event_id, rn, list(use_kw) OVER (PARTITION BY series_id ORDER BY time, event_id ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) AS s FROM pos",
    }, select=f"SELECT series_id, event_id, {sequence_text('s')} AS sequence FROM w WHERE rn >= 60"),
    "next_step_target": over("series", more={
        "pos": POSITIONS,
        "w": "SELECT series_id, event_id, rn, use_kw, list(use_kw) OVER (PARTITION BY series_id ORDER BY time, event_id ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING) AS s FROM pos",
    }, select=f"SELECT series_id, event_id, {sequence_text('s')} AS sequence, use_kw AS target FROM w WHERE rn > 60"),
    "latest_sequence": over("series", more={"pos": POSITIONS}, select=(
        "SELECT series_id, event_id, sequence FROM (SELECT series_id, arg_max(event_id, rn) AS event_id,"
        f" {sequence_text('list(use_kw ORDER BY rn)')} AS sequence FROM pos WHERE rn > n - 60 AND n >= 60 GROUP BY series_id) t")),
    "bounded_history": over("series", more={"pos": POSITIONS}, select="SELECT series_id, event_id, use_kw FROM pos WHERE rn > n - 70"),
    "retrain_marks": over("forecasts", select=(
        "SELECT data_type, event_id, rn AS position, CAST(rn // 100 AS BIGINT) AS run FROM ("
        "SELECT *, row_number() OVER (PARTITION BY data_type ORDER BY time, event_id) AS rn FROM forecasts) t WHERE rn % 100 = 0")),
    "chrono_split": over("series", more={"pos": POSITIONS}, select=(
        "SELECT series_id, event_id, CASE WHEN rn > n - ceil(n * 0.2) THEN 'test' ELSE 'train' END AS part FROM pos")),
    "recent_k": over("forecasts", select=f"SELECT event_id, actual, predicted, {r6('error')} AS error FROM forecasts ORDER BY time DESC, event_id DESC LIMIT 10"),
    "forecast_baseline": over("forecasts", select="SELECT series_id, event_id, actual, predicted FROM forecasts"),
    "forecast_error": over("forecasts", select=f"SELECT event_id, actual, predicted, {r6('error')} AS error, {r6('error_pct')} AS error_pct FROM forecasts"),
    "forecast_metrics": over("forecasts", select=(
        f"SELECT count(*) AS n, {r6('avg(error)')} AS mae, {r6('sqrt(avg(error * error))')} AS rmse, {r6('avg(error_pct)')} AS mape,"
        f" {r6('max(error)')} AS max_error, {r6('min(error)')} AS min_error FROM forecasts")),
    "series_stats": over("forecasts", select=union_all(
        f"SELECT '{c}' AS \"column\", {r6(f'avg({c})')} AS mean, {r6(f'median({c})')} AS median, {r6(f'stddev_samp({c})')} AS std,"
        f" {r6(f'min({c})')} AS low, {r6(f'max({c})')} AS high FROM forecasts" for c in ("actual", "predicted"))),
    "alert_tier": over("forecasts", select=(
        "SELECT event_id, CASE WHEN predicted > 100 THEN 'high' WHEN predicted > 50 THEN 'medium' ELSE 'normal' END AS tier FROM forecasts")),
    "cold_start_gate": over("series", select=(
        "SELECT data_type, count(*) AS n, max(CASE WHEN rn = 160 THEN event_id END) AS opened_by, CASE WHEN count(*) >= 160 THEN 1 ELSE 0 END AS ready FROM ("
        "SELECT *, row_number() OVER (PARTITION BY data_type ORDER BY time, event_id) AS rn FROM series) t GROUP BY data_type")),
    "prediction_log": over("forecasts", select=f"SELECT event_id, actual, predicted, {r6('error')} AS error, {r6('error_pct')} AS error_pct FROM forecasts"),
    # evaluation
    "risk_tier": over("scored", select="SELECT id, CASE WHEN score > 0.7 THEN 'High' WHEN score > 0.3 THEN 'Medium' ELSE 'Low' END AS tier FROM scored"),
    "accuracy": over("scored", select=f"SELECT {r6('avg(CASE WHEN y = pred THEN 1.0 ELSE 0.0 END)')} AS accuracy FROM scored"),
    "confusion_matrix": over("scored", select=(
        "SELECT y AS actual, count(*) FILTER (WHERE pred = 0) AS predicted_0, count(*) FILTER (WHERE pred = 1) AS predicted_1 FROM scored GROUP BY y")),
    "diagnostic_rates": over("scored", more={
        "c": "SELECT count(*) FILTER (WHERE y=0 AND pred=0) AS tn, count(*) FILTER (WHERE y=0 AND pred=1) AS fp,"
        " count(*) FILTER (WHERE y=1 AND pred=0) AS fn, count(*) FILTER (WHERE y=1 AND pred=1) AS tp FROM scored"},
        select=f"SELECT tn, fp, fn, tp, {r6(ratio('tp', '(tp + fn)'))} AS sensitivity, {r6(ratio('tn', '(tn + fp)'))} AS specificity,"
        f" {r6(ratio('tp', '(tp + fp)'))} AS ppv, {r6(ratio('tn', '(tn + fn)'))} AS npv FROM c"),
    "classification_report": _report(),
    "roc_auc": over("scored", more={"t": THRESHOLDS}, select=f"SELECT {r6(AUC)} AS auc FROM t"),
    "roc_curve": over("scored", more={"t": THRESHOLDS}, select=(
        f"SELECT threshold, {r6('CAST(fp AS DOUBLE) / n')} AS fpr, {r6('CAST(tp AS DOUBLE) / p')} AS tpr FROM t UNION ALL SELECT NULL, 0, 0")),
    "pr_curve": over("scored", more={"t": THRESHOLDS}, select=(
        f"SELECT threshold, {r6('CAST(tp AS DOUBLE) / (tp + fp)')} AS precision, {r6('CAST(tp AS DOUBLE) / p')} AS recall FROM t UNION ALL SELECT NULL, 1, 0")),
    "prob_histogram": over("scored", more={
        "lim": "SELECT y, min(score) AS lo, max(score) AS hi FROM scored GROUP BY y"}, select=(
        "SELECT s.y, CAST(least(floor(CASE WHEN hi > lo THEN (score - lo) / (hi - lo) * 20 ELSE 0 END), 19) AS BIGINT) AS bin, count(*) AS n"
        " FROM scored s JOIN lim ON s.y = lim.y GROUP BY 1, 2")),
    "evaluate": _evaluate(),
    "leaderboard": over("scored", more=BOARD_PARTS, select=f"SELECT model, accuracy, auc, {r6('0.5 * accuracy + 0.5 * auc')} AS rank_score FROM board"),
    "quality_band": over("scored", more=BOARD_PARTS, select=(
        "SELECT model, CASE WHEN accuracy >= 0.9 THEN 'excellent' WHEN accuracy >= 0.85 THEN 'very good' WHEN accuracy >= 0.8 THEN 'good' ELSE 'needs improvement' END AS accuracy_band,"
        " CASE WHEN cv_std <= 0.02 THEN 'very stable' WHEN cv_std <= 0.05 THEN 'stable' ELSE 'variable' END AS stability_band,"
        " CASE WHEN accuracy >= 0.85 THEN 'recommended' WHEN accuracy >= 0.8 THEN 'with oversight' ELSE 'improve first' END AS use_band FROM board")),
    "importance_topk": over("importances", select="SELECT feature, kind, weight FROM importances ORDER BY weight DESC, feature LIMIT 10"),
    "topk_others": over("importances", more={
        "r": "SELECT *, row_number() OVER (ORDER BY weight DESC, feature) AS rn FROM importances"}, select=(
        "SELECT feature, weight FROM r WHERE rn <= 8 UNION ALL SELECT 'Others', CAST(coalesce(sum(weight), 0) AS BIGINT) FROM r WHERE rn > 8")),
    "importance_by_group": over("importances", select=(
        f"SELECT kind, CAST(sum(weight) AS BIGINT) AS weight, {r6('CAST(sum(weight) AS DOUBLE) / (SELECT sum(weight) FROM importances)')} AS share FROM importances GROUP BY kind")),
    "feature_label_join": "SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id",
    # streams
    "stream_source": over("series", select="SELECT CAST(event_id AS VARCHAR) AS key, series_id, event_id, data_type, use_kw FROM series"),
    "stream_append": over("series", select="SELECT series_id, event_id, use_kw FROM series WHERE data_type = 'purchase'"),
    "stream_metrics": over("forecasts", select=(
        f"SELECT count(*) AS n, {r6('avg(error)')} AS mae, {r6('sqrt(avg(error * error))')} AS rmse, {r6('avg(error_pct)')} AS mape,"
        f" {r6('max(error)')} AS max_error, {r6('min(error)')} AS min_error FROM forecasts")),
    "dual_stream": over("patients", select=(
        "SELECT 'to_score' AS route, count(*) AS rows FROM patients WHERE num IS NULL UNION ALL"
        " SELECT 'to_train', count(*) FROM patients WHERE num IS NOT NULL UNION ALL"
        " SELECT 'quarantine', count(*) FROM documents")),
    "stream_train_blocks": over("patients", more={"labelled": LABELLED, "blocks": BLOCKS}, select="SELECT id, block FROM blocks"),
}
ORACLES["report"] = (
    f"SELECT 'evaluation' AS section, metric AS name, value FROM ({_evaluate()}) e UNION ALL "
    "SELECT 'matrix', 'actual_' || y || '_predicted_' || p, CAST(count(*) FILTER (WHERE pred = p) AS DOUBLE)"
    f" FROM ({SCORED}) s CROSS JOIN (VALUES (0), (1)) v(p) GROUP BY y, p"
)
ORACLES["stream_sequence"] = ORACLES["sliding_sequence"]
ORACLES["stream_state_sequence"] = over("series", more={
    "pos": POSITIONS,
    "w": "SELECT series_id, event_id, rn, list(use_kw) OVER (PARTITION BY series_id ORDER BY time, event_id ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) AS s FROM pos",
}, select=f"SELECT series_id, event_id, rn AS position, rn >= 160 AS warm, {sequence_text('s')} AS sequence FROM w WHERE rn >= 60")


# Models have no SQL form; their queries tell what SQL can: which rows get a result, whether it is
# valid, and whether a model beats the majority class.
_TEST_ROWS = (
    "SELECT id, label FROM (SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(id AS VARCHAR)), id) AS rn,"
    " count(*) OVER (PARTITION BY label) AS n FROM labelled) t WHERE rn <= ceil(n * 0.2)"
)
MODELS = [
    "random_forest", "gradient_boosting", "logistic_regression", "rbf_svc", "knn", "naive_bayes", "decision_tree", "mlp",
]
for _query in ("rf", "gbt", "logreg", "rbf_svc", "dtree", "mlp", "knn"):
    ORACLES[f"{_query}_scores"] = over("patients", more={"labelled": LABELLED, "test": _TEST_ROWS}, select=(
        "SELECT id, label, TRUE AS valid, CAST(NULL AS BOOLEAN) AS beats_majority FROM test UNION ALL SELECT NULL, NULL, NULL, TRUE"))
ORACLES["compare_models"] = union_all(f"SELECT '{m}' AS model, TRUE AS valid" for m in MODELS)
ORACLES["grid_search"] = union_all(
    f"SELECT 'numTrees={t}, maxDepth={d}, minInstancesPerNode={m}, featureSubsetStrategy=sqrt' AS parameters, TRUE AS valid"
    for t in (50, 100) for d in (30, 10) for m in (1, 2))
ORACLES["batch_score"] = over("patients", select="SELECT id, TRUE AS valid FROM patients WHERE num IS NULL")
ORACLES["stream_score"] = over("patients", select="SELECT id, 1 AS model_version, TRUE AS valid FROM patients WHERE num IS NULL")
ORACLES["model_roundtrip"] = over("patients", select="SELECT count(*) AS rows, CAST(0 AS BIGINT) AS different FROM patients")
ORACLES["retrain"] = over("patients", select=union_all(
    f"SELECT {v} AS version, '{mode}' AS mode, count(*) AS rows, TRUE AS valid FROM patients WHERE num IS NOT NULL"
    for v, mode in ((1, "initial"), (2, "retrain"), (3, "incremental"))))
ORACLES["stream_models"] = "SELECT 1 AS version, 'initial' AS mode UNION ALL SELECT 2, 'retrain'"
ORACLES["full_analysis"] = (
    union_all(f"SELECT 'missing' AS section, '{c}' AS name, TRUE AS valid" for c in [*FEATURES, *ENGINEERED])
    + f"\nUNION ALL SELECT 'metric', metric, TRUE FROM ({_evaluate()}) e\nUNION ALL\n"
    + union_all(f"SELECT 'importance', '{c}', TRUE" for c in [*FEATURES, *ENGINEERED])
    + "\nUNION ALL\n" + union_all(f"SELECT 'ranking', '{m}', TRUE" for m in MODELS)
    + "\nUNION ALL SELECT 'version', '1', TRUE"
)
ORACLES["forecast"] = over("series", more={"pos": POSITIONS}, select=(
    "SELECT series_id, event_id, use_kw AS actual, TRUE AS valid FROM pos WHERE rn > 60 AND rn > n - ceil((n - 60) * 0.2)"))
_PAST = "SELECT series_id, CAST(n - ceil(n * 0.2) AS BIGINT) AS n FROM pos WHERE rn = 1"
_RUNS = " UNION ALL ".join(
    f"SELECT {run} AS run, CAST(sum(greatest(n - 60 - ceil((n - 60) * 0.2), 0)) AS BIGINT) AS samples FROM {source}"
    for run, source in ((1, "past"), (2, "whole")))
ORACLES["training_history"] = over("series", more={
    "pos": POSITIONS, "past": _PAST, "whole": "SELECT series_id, n FROM pos WHERE rn = 1", "runs": _RUNS,
}, select="SELECT run, samples, TRUE AS valid FROM runs WHERE samples > 0")
ORACLES["forecast_retrain"] = over("series", more={
    "pos": POSITIONS, "past": _PAST, "whole": "SELECT series_id, n FROM pos WHERE rn = 1", "runs": _RUNS,
}, select=(
    "SELECT p.series_id, p.event_id, r.run AS version, TRUE AS valid FROM pos p CROSS JOIN runs r"
    " WHERE p.rn = p.n AND p.n >= 60 AND r.samples > 0"))
ORACLES["energy_forecast"] = ORACLES["forecast"]
_EVENT = (
    "[use_kw, " + ", ".join(f"use_kw * CAST({i / 10} AS DOUBLE)" for i in range(1, 8))
    + ", 20.0 + use_kw * 5, 60.0 + use_kw * 10, 1013.0 + use_kw * 2, 5.0 + use_kw * 3]"
)
ORACLES["energy_windows"] = over("series", more={
    "pos": POSITIONS,
    "w": f"SELECT series_id, event_id, rn, use_kw, list({_EVENT}) OVER (PARTITION BY series_id ORDER BY time, event_id ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING) AS s FROM pos",
}, select=f"SELECT series_id, event_id, {sequence_text('flatten(s)')} AS sequence, use_kw AS target FROM w WHERE rn > 60")

# Additive forecasts: a fit on one reading has the closed form of a regression line, shrunk by the
# penalty on its standardised slope.
_PAIRS = (
    "SELECT *, lag(use_kw) OVER (PARTITION BY series_id ORDER BY time, event_id) AS x FROM pos"
)
_SHRUNK = "regr_slope(use_kw, x) / 1.001"
ORACLES["additive_forecast"] = over("series", more={
    "pos": POSITIONS, "pairs": f"SELECT * FROM ({_PAIRS}) q WHERE rn > 1",
    "fit": f"SELECT {_SHRUNK} AS slope, avg(use_kw) - {_SHRUNK} * avg(x) AS base FROM pairs WHERE x IS NOT NULL AND use_kw IS NOT NULL",
    "loss": "SELECT avg((use_kw - base - slope * x) * (use_kw - base - slope * x)) AS loss FROM pairs CROSS JOIN fit",
}, select=(
    f"SELECT series_id, event_id, {r6('base + slope * x')} AS predicted, round(loss, 4) AS loss"
    " FROM pairs CROSS JOIN fit CROSS JOIN loss"))
ORACLES["forecast_moments"] = over("series", more={
    "pos": POSITIONS,
    "w": "SELECT rn, use_kw, list(use_kw) OVER (PARTITION BY series_id ORDER BY time, event_id ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING) AS s FROM pos",
    "x": "SELECT list_prepend(CAST(1 AS DOUBLE), list_append(s, use_kw)) AS r FROM w WHERE rn > 60",
    "ij": "SELECT i, j FROM range(62) a(i), range(62) b(j) WHERE i <= j",
}, select="SELECT CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, round(sum(r[i + 1] * r[j + 1]), 4) AS total FROM x, ij GROUP BY i, j")

# The stream in ten equal spans of time: a model appears with the batch that completes 100 windows,
# and again with every batch that completes another 100 forecasts.
_STREAM = {
    "pos": POSITIONS,
    "span": "SELECT min(epoch_us(time)) AS lo, max(epoch_us(time)) AS hi FROM series",
    "cut": "SELECT i, lo + (hi - lo) * i // 10 AS at FROM span, range(1, 10) t(i)",
    "sliced": "SELECT p.*, (SELECT count(*) FROM cut WHERE epoch_us(p.time) > cut.at) AS slice,"
    " lag(use_kw) OVER (PARTITION BY series_id ORDER BY time, event_id) AS x FROM pos p",
}


def _stream_versions(steps: int) -> dict[str, str]:
    return _STREAM | {
        "per": f"SELECT b.i AS slice, count(s.rn) AS n FROM range(10) b(i) LEFT JOIN sliced s ON s.slice = b.i AND s.rn > {steps} GROUP BY b.i",
        "upto": "SELECT slice, n, sum(n) OVER (ORDER BY slice) AS total FROM per",
        "opened": "SELECT min(slice) AS first FROM upto WHERE total >= 100",
        "made": "SELECT slice, sum(n) OVER (ORDER BY slice) AS done, n FROM upto, opened WHERE slice > first",
        "due": "SELECT first AS slice FROM opened WHERE first IS NOT NULL UNION ALL"
        " SELECT slice FROM made WHERE done // 100 > (done - n) // 100",
        "versions": "SELECT p.slice, CAST(max(d.slice) + 1 AS INTEGER) AS version FROM per p JOIN due d ON d.slice < p.slice GROUP BY p.slice",
        "asked": f"SELECT s.*, v.version FROM sliced s JOIN versions v ON s.slice = v.slice WHERE s.rn > {steps}",
    }


ORACLES["stream_forecast_rows"] = over("series", more=_stream_versions(5), select=(
    "SELECT series_id, event_id, strftime(time, '%H:%M:%S') AS clock, use_kw AS actual, version AS model_version FROM asked"))
ORACLES["stream_additive"] = over("series", more=_stream_versions(1) | {
    "fit": f"SELECT v.version, {_SHRUNK} AS slope, avg(use_kw) - {_SHRUNK} * avg(x) AS base"
    " FROM (SELECT DISTINCT version FROM versions) v JOIN sliced s ON s.slice < v.version WHERE s.rn > 1 GROUP BY v.version",
    "told": "SELECT a.*, base + slope * x AS predicted FROM asked a JOIN fit USING (version)",
    "judged": "SELECT *, abs(predicted - use_kw) AS error FROM told",
}, select=(
    f"SELECT series_id, event_id, use_kw AS actual, {r6('predicted')} AS predicted, {r6('error')} AS error,"
    f" {r6('CASE WHEN use_kw > 0 THEN error / use_kw * 100 ELSE 0 END')} AS error_pct,"
    " CASE WHEN predicted > 100 THEN 'high' WHEN predicted > 50 THEN 'medium' ELSE 'normal' END AS tier,"
    " version AS model_version FROM judged"))

# What is told while rows are written or streamed, and what sketches merge exactly.
ORACLES["observed_tally"] = (
    "WITH m AS (SELECT props AS v FROM events UNION ALL SELECT text FROM documents)"
    " SELECT count(*) FILTER (WHERE json_valid(v)) AS sent, count(*) FILTER (WHERE NOT json_valid(v)) AS failed FROM m"
)
ORACLES["stream_progress"] = over("patients", more={
    "span": "SELECT min(id) AS lo, max(id) AS hi FROM patients",
}, select=(
    "SELECT CAST(id > lo + (hi - lo) // 2 AS BIGINT) AS batch_id, count(*) AS sent, CAST(0 AS BIGINT) AS failed FROM patients, span GROUP BY 1"
    " UNION ALL SELECT 2, count(*) FILTER (WHERE json_valid(text)), count(*) FILTER (WHERE NOT json_valid(text)) FROM documents"))
ORACLES["sketch_parts"] = over("patients", select=union_all(
    f"SELECT '{c}' AS \"column\", '{t}' AS type, count(*) AS n_rows, count({c}) AS n_values, "
    + ", ".join(
        (f"{r6(f'{f}({c})')}" if t in ("bigint", "int", "double") else "CAST(NULL AS DOUBLE)") + f" AS {name}"
        for f, name in (("avg", "mean"), ("stddev_samp", "std"), ("min", "low"), ("max", "high")))
    + " FROM patients" for c, t in PATIENT_TYPES.items()))

ORACLES["chrono_split_three"] = over("series", more={
    "pos": POSITIONS, "b": "SELECT *, n - ceil(n * 0.2) AS before FROM pos",
}, select=(
    "SELECT series_id, event_id, CASE WHEN rn > before THEN 'test' WHEN rn > before - ceil(before * 0.1) THEN 'validation' ELSE 'train' END AS part FROM b"))

ORACLES["pipeline_roundtrip"] = ORACLES["model_roundtrip"]
ORACLES["pipeline_folds"] = over("patients", select=(
    "SELECT CAST((rn - 1) % 5 AS INTEGER) AS fold, count(*) AS rows, TRUE AS valid FROM ("
    "SELECT row_number() OVER (PARTITION BY num > 0 ORDER BY md5(CAST(id AS VARCHAR)), id) AS rn FROM patients WHERE num IS NOT NULL) t GROUP BY 1"))


def _bayes_scores() -> str:
    names = [*FEATURES, *ENGINEERED]
    raw = ENGINEERED | {"hr_reserve": "CASE WHEN 220 - age > 0 THEN thalch / (220 - age) ELSE 0 END"}
    columns = ", ".join(f"CAST({raw.get(c, c)} AS DOUBLE) AS {c}" for c in names)
    moments = ", ".join(f"avg({c}) AS m_{c}, var_pop({c}) AS v_{c}" for c in names)
    widest = "greatest(" + ", ".join(f"var_pop({c})" for c in names) + ")"
    terms = " - ".join(
        f"0.5 * (ln(2 * pi() * (v_{c} + floor_)) + (t.{c} - m_{c}) * (t.{c} - m_{c}) / (v_{c} + floor_))" for c in names
    )
    return over("imputed", more={
        "known": f"SELECT id, label, {columns} FROM imputed WHERE num IS NOT NULL",
        "placed": "SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(id AS VARCHAR)), id) <= ceil(count(*) OVER (PARTITION BY label) * 0.2) AS test FROM known",
        "class": f"SELECT label AS y, count(*) AS rows, {moments} FROM placed WHERE NOT test GROUP BY label",
        "all_": f"SELECT count(*) AS total, 1e-9 * {widest} AS floor_ FROM placed WHERE NOT test",
        "likely": f"SELECT t.id, t.label, y, ln(CAST(rows AS DOUBLE) / total) - {terms} AS s FROM placed t, class, all_ WHERE test",
        "both_": "SELECT id, label, max(CASE WHEN y = 1 THEN s END) - max(CASE WHEN y = 0 THEN s END) AS d FROM likely GROUP BY id, label",
        "p": "SELECT id, label, CASE WHEN d > 0 THEN 1 / (1 + exp(-least(d, 700))) ELSE exp(greatest(d, -700)) / (1 + exp(greatest(d, -700))) END AS p FROM both_",
    }, select=(
        f"SELECT id, label, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS prediction, {r6('p')} AS probability,"
        " CASE WHEN p > 0.7 THEN 'High' WHEN p > 0.3 THEN 'Medium' ELSE 'Low' END AS risk_level FROM p"))


ORACLES["nb_scores"] = _bayes_scores()

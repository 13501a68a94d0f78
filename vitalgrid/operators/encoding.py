"""Fitted preprocessing: category dictionaries, medians, scales."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.functions.columns import finite, to_number
from vitalgrid.operators.ordered import row_positions, text_buckets
from vitalgrid.operators.quantiles import exact_medians
from vitalgrid.schemas import TEXT_CATEGORIES
from vitalgrid.session import new_folder

# A dictionary up to this size is broadcast; a larger one is joined as a table.
DICTIONARY_LIMIT = 20_000
# Bytes of the longest text in a dictionary that the driver holds.
TEXT_BYTES = 1_024


def category_text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("unknown"))


def fit_dictionary(df: DataFrame, columns: Sequence[str], rows_per_bucket: int | None = None) -> DataFrame:
    """`(column, value, code)`: sorted distinct texts of each column, numbered from 0."""
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), category_text(F.col(c)).alias("value")) for c in columns
    ])
    values = df.select(F.explode(cells).alias("cell")).select("cell.*").distinct()
    numbered = row_positions(text_buckets(values, "value", rows_per_bucket), ["value"], ["column"])
    return numbered.select("column", "value", (F.col("position") - 1).cast("bigint").alias("code"))


def most_frequent(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Most frequent text per column, ties to the alphabetically first."""
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), category_text(F.col(c)).alias("value")) for c in columns
    ])
    counts = df.select(F.explode(cells).alias("cell")).select("cell.*").groupBy("column", "value").count()
    best = counts.groupBy("column").agg(
        F.min_by("value", F.struct(-F.col("count"), F.col("value"))).alias("value")
    )
    return {row["column"]: row["value"] for row in best.collect()}


@dataclass
class Dictionary:
    """A fitted dictionary: entries on the driver up to `DICTIONARY_LIMIT`, else a stored table."""

    entries: dict[str, dict[str, int]] | None
    table: DataFrame | None = None

    @classmethod
    def of(cls, fitted: DataFrame, limit: int | None = None) -> Dictionary:
        limit = limit or DICTIONARY_LIMIT
        # A text beyond TEXT_BYTES comes as a null, so that the head is bounded in bytes too.
        short = F.when(F.octet_length("value") <= TEXT_BYTES, F.col("value")).alias("value")
        head = fitted.select("column", short, "code").limit(limit + 1).collect()
        if len(head) <= limit and all(row["value"] is not None for row in head):
            entries: dict[str, dict[str, int]] = {}
            for row in head:
                entries.setdefault(row["column"], {})[row["value"]] = row["code"]
            return cls(entries)
        spark = fitted.sparkSession
        folder = new_folder(spark, "dictionary")
        fitted.write.parquet(folder)
        return cls(None, spark.read.parquet(folder))

    def lookup(self, spark: SparkSession, column: str) -> DataFrame:
        if self.entries is None:
            return self.table.filter(F.col("column") == column).select(
                F.col("value").alias("_text"), F.col("code").alias("_code")
            )
        codes = self.entries.get(column, {})
        local = pa.table({
            "_text": pa.array(list(codes), pa.string()),
            "_code": pa.array(list(codes.values()), pa.int64()),
        })
        return F.broadcast(spark.createDataFrame(local))

    def code(self, column: str, value: str | None) -> int:
        if value is None:
            return 0
        if self.entries is not None:
            return self.entries.get(column, {}).get(value, 0)
        row = self.table.filter((F.col("column") == column) & (F.col("value") == value)).first()
        return row["code"] if row else 0


def encode(
    df: DataFrame,
    columns: Sequence[str],
    dictionary: Dictionary,
    suffix: str = "",
    fallback: Mapping[str, str] | None = None,
) -> DataFrame:
    """Text to code per row; a text that the dictionary lacks gets the first (or given) class.

    A dictionary of checked size is broadcast; a larger one is joined as a table, where the
    adaptive skew join splits frequent texts.
    """
    for name in columns:
        default = dictionary.code(name, (fallback or {}).get(name))
        kept = [F.col(f"`{c}`") for c in df.columns if c != f"{name}{suffix}"]
        df = (
            df.join(
                dictionary.lookup(df.sparkSession, name),
                category_text(F.col(name)) == F.col("_text"), "left",
            )
            .select(*kept, F.coalesce("_code", F.lit(default)).cast("bigint").alias(f"{name}{suffix}"))
        )
    return df


def impute(df: DataFrame, medians: Mapping[str, float | None]) -> DataFrame:
    """Null cells get the fitted median; a column without one stays null."""
    return df.withColumns({
        c: F.coalesce(F.col(c), F.lit(m)) for c, m in medians.items() if m is not None and c in df.columns
    })


def fit_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`(feature, mean, std)` with the population deviation; a zero deviation counts as 1."""
    row = df.agg(*[
        stat(F.col(f"`{c}`").cast("double")).alias(f"{tag}{i}")
        for i, c in enumerate(columns)
        for tag, stat in (("m", F.avg), ("s", F.stddev_pop))
    ])
    entries = F.array(*[
        F.struct(
            F.lit(c).alias("feature"),
            F.col(f"m{i}").alias("mean"),
            F.when(F.col(f"s{i}") == 0, F.lit(1.0)).otherwise(F.col(f"s{i}")).alias("std"),
        )
        for i, c in enumerate(columns)
    ])
    return row.select(F.explode(entries).alias("e")).select("e.*")


def collect_scale(scale: DataFrame) -> dict[str, tuple[float, float]]:
    """One entry per feature: as many rows as the table has columns."""
    return {row["feature"]: (row["mean"], row["std"]) for row in scale.collect()}


def scaled(value: Column, mean_std: tuple[float, float]) -> Column:
    return (value.cast("double") - F.lit(mean_std[0])) / F.lit(mean_std[1])


def standard_scale(df: DataFrame, scale: Mapping[str, tuple[float, float]]) -> DataFrame:
    """`(x - mean) / std` with fitted literals: no join, no shuffle."""
    return df.withColumns({c: scaled(F.col(f"`{c}`"), s) for c, s in scale.items() if c in df.columns})


def inverse_scale(value: Column, mean_std: tuple[float, float]) -> Column:
    return value * F.lit(mean_std[1]) + F.lit(mean_std[0])


@dataclass
class Preprocessor:
    """Encode text columns, fill medians, scale: fitted once, applied to any later rows."""

    numeric: list[str]
    categories: list[str] = field(default_factory=lambda: list(TEXT_CATEGORIES))
    fallback: str = "first"
    scale: bool = True
    dictionary: Dictionary | None = None
    fallbacks: dict[str, str] = field(default_factory=dict)
    medians: dict[str, float | None] = field(default_factory=dict)
    scales: dict[str, tuple[float, float]] = field(default_factory=dict)

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *self.categories]

    def _numbers(self, df: DataFrame) -> DataFrame:
        absent = [c for c in self.features if c not in df.columns]
        df = df.withColumns({c: F.lit(0.0) for c in absent}) if absent else df
        text = {name for name, kind in df.dtypes if kind == "string"}
        return df.withColumns({
            c: (to_number(F.col(c)) if c in text else finite(F.col(c).cast("double")))
            for c in self.numeric
        })

    def fit(self, df: DataFrame) -> Preprocessor:
        numbers = self._numbers(df)
        if self.fallback == "most_frequent":
            self.fallbacks = most_frequent(df, self.categories)
        if self.categories:
            self.dictionary = Dictionary.of(fit_dictionary(df, self.categories))
        self.medians = exact_medians(numbers, self.numeric)
        filled = self._encoded(impute(numbers, self.medians))
        self.scales = collect_scale(fit_scale(filled, self.features)) if self.scale else {}
        return self

    def _encoded(self, df: DataFrame) -> DataFrame:
        if not self.categories:
            return df
        return encode(df, self.categories, self.dictionary, fallback=self.fallbacks)

    def transform(self, df: DataFrame) -> DataFrame:
        coded = self._encoded(impute(self._numbers(df), self.medians))
        return standard_scale(coded, self.scales) if self.scale else coded

    def describe(self) -> dict:
        """Everything fitted, as plain values; a stored dictionary table is left out."""
        entries = self.dictionary.entries if self.dictionary else None
        return {
            "numeric": self.numeric, "categories": self.categories, "fallback": self.fallback,
            "scale": self.scale, "fallbacks": self.fallbacks, "medians": self.medians,
            "scales": {c: list(s) for c, s in self.scales.items()}, "entries": entries,
        }

    @classmethod
    def from_description(cls, described: dict) -> Preprocessor:
        described = dict(described)
        entries = described.pop("entries")
        scales = {c: tuple(s) for c, s in described.pop("scales").items()}
        return cls(
            **described, scales=scales, dictionary=None if entries is None else Dictionary(entries)
        )

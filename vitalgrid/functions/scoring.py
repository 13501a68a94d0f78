"""Tiers and errors of predictions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tier(value: Column, high: float, medium: float, names: tuple[str, str, str]) -> Column:
    return F.when(value > high, names[0]).when(value > medium, names[1]).otherwise(names[2])


def risk_tier(probability: Column, high: float = 0.7, medium: float = 0.3) -> Column:
    return tier(probability, high, medium, ("High", "Medium", "Low"))


def alert_tier(forecast: Column, high: float = 1.5, medium: float = 1.0) -> Column:
    return tier(forecast, high, medium, ("high", "medium", "normal"))


def absolute_error(predicted: Column, actual: Column) -> Column:
    return F.abs(predicted - actual)


def percent_error(error: Column, actual: Column) -> Column:
    """Error in percent of the actual value; 0 where that is not positive."""
    return F.when(actual > 0, error / actual * 100).otherwise(F.lit(0.0))


def clock_text(epoch_seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(epoch_seconds), "HH:mm:ss")


def accuracy_band(accuracy: Column) -> Column:
    return (
        F.when(accuracy >= 0.90, "excellent")
        .when(accuracy >= 0.85, "very good")
        .when(accuracy >= 0.80, "good")
        .otherwise("needs improvement")
    )


def stability_band(deviation: Column) -> Column:
    return (
        F.when(deviation <= 0.02, "very stable")
        .when(deviation <= 0.05, "stable")
        .otherwise("variable")
    )


def use_band(accuracy: Column) -> Column:
    return (
        F.when(accuracy >= 0.85, "recommended")
        .when(accuracy >= 0.80, "with oversight")
        .otherwise("improve first")
    )

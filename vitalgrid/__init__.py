"""Tabular and sensor analytics on Spark: cleaning, features, forecasts, models, streams."""

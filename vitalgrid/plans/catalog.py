"""All registered queries by name."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from vitalgrid.plans import clinical, energy, evaluation, learning, streams
from vitalgrid.plans.oracles import ORACLES
from vitalgrid.session import configure, ship

Query = Callable[[SparkSession, str], DataFrame]


def _configured(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(ship(configure(spark)), folder)

    return run


def queries() -> dict[str, Query]:
    modules = (clinical, energy, evaluation, learning, streams)
    return {name: _configured(f) for module in modules for name, f in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)

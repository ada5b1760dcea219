"""The list of registered queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from zonecraft.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(tune(spark), str(sf_dir).rstrip("/"))

        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        run.__module_of__ = build.__module__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register

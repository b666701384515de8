"""Registered queries: name, Spark builder and, where SQL can say it, the check's SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from geoloom import session

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(session.prepare(spark), sf_dir)

        run.__name__ = build.__name__
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if check is not None:
            CHECKS[name] = check
        return build

    return register

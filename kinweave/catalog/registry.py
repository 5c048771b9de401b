"""Registry of runnable queries: name, covered operators, Spark plan, equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from kinweave.catalog.context import Context


@dataclass(frozen=True)
class Query:
    name: str
    operators: str
    build: Callable[[Context], DataFrame]
    sql: str | None = None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return self.build(Context(spark, sf_dir))


QUERIES: dict[str, Query] = {}


def register(name: str, operators: str, sql: str | None = None):
    def add(build):
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = Query(name, operators, build, sql)
        return build
    return add

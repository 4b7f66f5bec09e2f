"""Named queries over the standard tables, each with the equivalent SQL where SQL can say it."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Build
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Build], Build]:
    """Register a query under its function name."""

    def register(build: Build) -> Build:
        REGISTRY[build.__name__] = Query(build, sql)
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def load() -> dict[str, Query]:
    from weftwork.catalog import (  # noqa: F401
        celltables,
        configuration,
        cooccurrence,
        dossiers,
        elements,
        expressions,
        jobs,
        outputs,
        selections,
        streams,
    )

    return REGISTRY

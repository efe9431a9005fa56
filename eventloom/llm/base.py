"""Registry and shared plumbing of the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.sources.files import scratch_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the equivalent DuckDB statement, if SQL can express it."""

    def register(build):
        QUERIES[name] = build
        if sql is not None:
            CHECKS[name] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to a new folder in the shared checkpoint folder and go on from those files.

    Like a checkpoint, this cuts the lineage and survives lost executors; unlike one, it is compressed
    and columns can be pruned when it is read.
    """
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lower_ascii(column: str | Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

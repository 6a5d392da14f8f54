"""Registered queries of the package and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, oracle: str | None = None):
    def register(fn):
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn
    return register


def values(spark: SparkSession, columns: str, rows: list[tuple]) -> DataFrame:
    """A few constant rows as a frame of expressions."""
    fields = [c.strip().split() for c in columns.split(",")]
    structs = [F.struct(*[F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(row, fields)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

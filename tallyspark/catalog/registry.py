"""Registered queries: a Spark callable and, where SQL can say it, the same question as plain SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..plans.books import Books
from .oracle_tables import TABLES

QUERIES: dict[str, Callable[[Books], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, oracle: str | None = None):
    def register(fn):
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = with_tables(oracle)
        return fn
    return register


def with_tables(sql: str) -> str:
    """Prefix the SQL with the derived tables it names, and those they name in turn."""
    needed: set[str] = set()
    frontier = sql
    while True:
        found = {n for n in TABLES if n not in needed and re.search(rf"\b{n}\b", frontier)}
        if not found:
            break
        needed |= found
        frontier = " ".join(TABLES[n] for n in found)
    if not needed:
        return sql
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({TABLES[n]})" for n in TABLES if n in needed)
    stripped = sql.strip()
    if stripped[:15].lower() == "with recursive ":
        return f"WITH RECURSIVE {ctes},\n{stripped[15:]}"
    if stripped[:5].lower() == "with ":
        return f"WITH {ctes},\n{stripped[5:]}"
    return f"WITH {ctes}\n{stripped}"


def present(df: DataFrame) -> DataFrame:
    """One decimal width for all amounts, so both engines declare the same result type."""
    return df.select(*[
        F.col(f"`{f.name}`").cast(T.DecimalType(38, f.dataType.scale)).alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def as_callable(fn) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(fn(Books(spark, sf_dir)))
    run.__name__ = getattr(fn, "__name__", "query")
    return run

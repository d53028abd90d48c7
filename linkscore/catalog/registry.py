"""Registry of the queries the entry point offers."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from linkscore.catalog.data import ctes, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given and derived tables of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __call__(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)


def query(name: str, oracle: str | None = None):
    """Register ``fn(tables)`` under ``name`` with its checking SQL."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return wrap


def sql(names: Sequence[str], steps: Mapping[str, str], final: str, once: Sequence[str] = (), recursive: bool = True) -> str:
    """Checking SQL: derived tables, named steps, final select; ``once`` names steps that are not to be merged into others."""
    parts = [f"{n} AS {'MATERIALIZED ' * (n in once)}({ctes(n)})" for n in names]
    parts += [f"{n} AS {'MATERIALIZED ' * (n in once)}({q})" for n, q in steps.items()]
    return ("WITH " + "RECURSIVE " * recursive + ",\n".join(parts) + "\n" if parts else "") + final

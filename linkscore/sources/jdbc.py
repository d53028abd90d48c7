"""Relational tables in and out."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def range_predicates(column: str, lower: int, upper: int, num_partitions: int) -> list[str]:
    """WHERE clauses that split a table by ranges of a whole-number column.

    The bounds only set the stride: smaller values and NULL go to the first
    clause, larger ones to the last, so every row is read exactly once.
    """
    n = max(1, min(num_partitions, upper - lower))
    if n == 1:
        return ["1 = 1"]
    borders = [lower + (upper - lower) * i // n for i in range(1, n)]
    first = f"{column} < {borders[0]} OR {column} IS NULL"
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(borders, borders[1:])]
    return [first, *middle, f"{column} >= {borders[-1]}"]


def range_number(column: str, lower: int, upper: int, num_partitions: int) -> Column:
    """Which of the clauses a row satisfies."""
    clauses = range_predicates(column, lower, upper, num_partitions)
    expr = F.when(F.expr(clauses[0]), F.lit(0))
    for i, clause in enumerate(clauses[1:], 1):
        expr = expr.when(F.expr(clause), F.lit(i))
    return expr


def options(url: str, table: str, properties: Mapping[str, str] | None = None, fetch_size: int = 10_000) -> dict[str, str]:
    return {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **(properties or {})}


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    num_partitions: int | None = None,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Whole table, or one task per range of ``column``."""
    props = {k: v for k, v in options(url, table, properties).items() if k not in ("url", "dbtable")}
    if column is None:
        return spark.read.jdbc(url, table, properties=props)
    return spark.read.jdbc(url, table, predicates=range_predicates(column, lower, upper, num_partitions), properties=props)


def jdbc_to_files(spark: SparkSession, url: str, table: str, path: str, fmt: str = "json", **ranges) -> None:
    read_table(spark, url, table, **ranges).write.mode("overwrite").format(fmt).save(path)


def files_to_jdbc(
    spark: SparkSession, path: str, url: str, table: str, mode: str = "overwrite", fmt: str = "json",
    properties: Mapping[str, str] | None = None, connections: int = 32,
) -> None:
    """Folder to table; the number of writing connections is bounded."""
    df = spark.read.format(fmt).load(path)
    df.write.mode(mode).option("numPartitions", connections).jdbc(url, table, properties=dict(properties or {}))


def append_jdbc(
    df: DataFrame, url: str, table: str, on_error: str = "log", properties: Mapping[str, str] | None = None
) -> bool:
    """Append a result; with ``on_error="log"`` a failure is reported and the job goes on."""
    try:
        df.write.mode("append").jdbc(url, table, properties=dict(properties or {}))
        return True
    except Exception as error:
        if on_error != "log":
            raise
        log.error("append to %s failed: %s", table, error)
        return False

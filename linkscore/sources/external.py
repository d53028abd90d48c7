"""External results read in parallel: one task per window or range, each asking the source for its own share.

A reader is given a function that fetches one share, ``fetch(skip, limit)`` or
``fetch(low, high)``, and is planned as a Python data source whose partitions are the
shares. So no row is read before its task runs, none twice, and a lost task asks
again for its share alone. The functions here fetch from Parquet files; one for any
other store needs only to answer the same question.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

Fetch = Callable[..., Iterator[pa.RecordBatch]]


def _read_shares(spark: SparkSession, fetch: Fetch, schema: T.StructType, shares: Sequence[tuple], number: str) -> DataFrame:
    """Rows of all shares with the number of theirs; a task per share."""
    whole = T.StructType([*schema.fields, T.StructField(number, T.IntegerType())])
    name = f"external_{uuid.uuid4().hex[:12]}"

    class Share(InputPartition):
        def __init__(self, nth: int, bounds: tuple):
            self.nth, self.bounds = nth, bounds

    class Reader(DataSourceReader):
        def partitions(self) -> list[InputPartition]:
            return [Share(i, bounds) for i, bounds in enumerate(shares)]

        def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
            for batch in fetch(*partition.bounds):
                nth = pa.array([partition.nth] * batch.num_rows, pa.int32())
                yield pa.RecordBatch.from_arrays([*batch.columns, nth], names=[*batch.schema.names, number])

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> T.StructType:
            return whole

        def reader(self, schema: T.StructType) -> DataSourceReader:
            return Reader()

    if not shares:
        return spark.createDataFrame([], whole)
    spark.dataSource.register(Source)
    return spark.read.format(name).load()


def read_external_windows(spark: SparkSession, fetch: Fetch, schema: T.StructType, windows: Sequence[tuple[int, int]]) -> DataFrame:
    """Rows of every ``(skip, limit)`` window (limit -1: all that follow), with the number of the ``window``."""
    return _read_shares(spark, fetch, schema, [*windows], "window")


def range_bounds(lower: int, upper: int, num_partitions: int) -> list[tuple[int | None, int | None]]:
    """Half-open ranges; the bounds set only the stride, so the first and last are open and the first takes what has no value."""
    n = max(1, min(num_partitions, upper - lower))
    borders = [lower + (upper - lower) * i // n for i in range(1, n)]
    return [*zip([None, *borders], [*borders, None])]


def read_external_ranges(spark: SparkSession, fetch: Fetch, schema: T.StructType, lower: int, upper: int, num_partitions: int) -> DataFrame:
    """Rows of every range of a column, with the number of the ``part``."""
    return _read_shares(spark, fetch, schema, range_bounds(lower, upper, num_partitions), "part")


# --- shares of Parquet files -----------------------------------------------


def _local(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class ParquetWindows:
    """``fetch(skip, limit)`` over files in order: opens only the row groups that the window meets."""

    files: list[tuple[str, int]]  # path, rows
    columns: list[str]

    def __call__(self, skip: int, limit: int) -> Iterator[pa.RecordBatch]:
        left = sum(n for _, n in self.files) - skip if limit < 0 else limit
        for path, rows in self.files:
            if skip >= rows or left <= 0:
                skip = max(0, skip - rows)
                continue
            system, name = _local(path)
            with pq.ParquetFile(name, filesystem=system) as file:
                for group in range(file.num_row_groups):
                    size = file.metadata.row_group(group).num_rows
                    if skip >= size or left <= 0:
                        skip = max(0, skip - size)
                        continue
                    table = file.read_row_group(group, self.columns).slice(skip, left)
                    skip, left = 0, left - table.num_rows
                    yield from table.to_batches(max_chunksize=10_000)


def parquet_windows(df: DataFrame, columns: Sequence[str]) -> ParquetWindows:
    """The files behind a table that was read from Parquet, in the order of their names, with their rows."""
    counts = df.groupBy(F.input_file_name().alias("path")).count()
    return ParquetWindows(sorted((r["path"], r["count"]) for r in counts.collect()), list(columns))


@dataclass
class ParquetRanges:
    """``fetch(low, high)`` over files: row groups whose statistics rule the range out are skipped."""

    files: list[str]
    column: str
    columns: list[str]

    def __call__(self, low: int | None, high: int | None) -> Iterator[pa.RecordBatch]:
        value = pc.field(self.column)
        inside = [value >= low] * (low is not None) + [value < high] * (high is not None)
        hit = inside[0] if inside else ds.scalar(True)
        for more in inside[1:]:
            hit = hit & more
        if low is None:
            hit = hit | value.is_null()
        for path in self.files:
            system, name = _local(path)
            yield from ds.dataset(name, filesystem=system).to_batches(columns=self.columns, filter=hit)


def parquet_ranges(df: DataFrame, column: str, columns: Sequence[str]) -> ParquetRanges:
    return ParquetRanges(sorted(df.inputFiles()), column, list(columns))

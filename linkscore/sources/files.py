"""Moving tables between files, tables and folders."""

from __future__ import annotations

import logging
import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkscore.ordered import number_rows
from linkscore.runtime import shuffle_width, stored

log = logging.getLogger(__name__)
FORMATS = ("json", "parquet")


def _check(fmt: str) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"format {fmt!r} is not one of {FORMATS}")


def load_files_to_table(
    spark: SparkSession,
    path: str,
    table: str,
    fmt: str = "json",
    schema: T.StructType | None = None,
    location: str | None = None,
) -> None:
    """Load a folder and overwrite a table. Give a schema to spare the inference scan."""
    _check(fmt)
    reader = spark.read.format(fmt)
    df = (reader.schema(schema) if schema is not None else reader).load(path)
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", location) if location else writer).saveAsTable(table)


def table_to_files(df: DataFrame, path: str, fmt: str = "json") -> None:
    _check(fmt)
    df.write.mode("overwrite").format(fmt).save(path)


def csv_to_table(
    spark: SparkSession,
    paths: str | Sequence[str],
    table: str | None = None,
    header: bool = True,
    schema: T.StructType | str | None = None,
    location: str | None = None,
) -> DataFrame:
    """Read one or many CSV folders; all columns are text unless a schema is given."""
    reader = spark.read.option("header", header)
    df = (reader.schema(schema) if schema is not None else reader).csv(paths)
    if table is None:
        return df
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", location) if location else writer).saveAsTable(table)
    return spark.table(table)


def table_to_parquet(df: DataFrame, path: str, files: int | None = None) -> None:
    """Columnar copy; a wanted file count is met by one even repartition."""
    (df if files is None else df.repartition(files)).write.mode("overwrite").parquet(path)


def read_edge_list(
    spark: SparkSession, path: str, sep: str = ",", src: int = 1, dst: int = 2, weight: int | None = None
) -> DataFrame:
    """Edges from delimited text by column position; the weight defaults to 1."""
    last = max(src, dst, weight or 0)
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(last + 1)])
    rows = spark.read.schema(schema).option("sep", sep).csv(path)
    w = F.lit(1.0) if weight is None else F.coalesce(F.col(f"c{weight}").cast("double"), F.lit(1.0))
    return rows.select(F.col(f"c{src}").cast("long").alias("src"), F.col(f"c{dst}").cast("long").alias("dst"), w.alias("weight"))


def append_partitioned(
    df: DataFrame, path: str, by: str = "dt", replace: bool = False, days: Sequence[str] = (), files: int | None = None
) -> None:
    """Add rows to a folder partitioned by day.

    ``replace`` overwrites the days present in ``df``, which makes a repeated
    daily run harmless; ``days`` names days to replace even where ``df`` has no
    row of them. A day is written by as many tasks as a shuffle has, or ``files``.
    """
    spread = F.pmod(F.xxhash64(*df.columns), F.lit(files or shuffle_width(df.sparkSession)))
    writer = df.repartition(by, spread).write.partitionBy(by)
    if not replace:
        writer.mode("append").parquet(path)
        return
    for day in days:
        _remove(df.sparkSession, f"{path}/{by}={day}")
    writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def compact_partition(spark: SparkSession, path: str, day: str, target_files: int, by: str = "dt") -> None:
    """Rewrite one day's small files as ``target_files``; other days are not touched.

    The day is first copied to the shared folder, so a lost job leaves either
    the old files or the new ones.
    """
    one = spark.read.parquet(path).where(F.col(by) == F.lit(day).cast("date"))
    copy = stored(one.repartition(target_files), "compact")
    copy.repartition(target_files).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def save_assignment(df: DataFrame, path: str, files: int = 10, drop_self: bool = True, id_col: str = "id", label: str = "label") -> None:
    """``id,label`` text sorted by label in ``files`` files."""
    rows = df.where(F.col(id_col) != F.col(label)) if drop_self else df
    order = [F.col(label), F.col(id_col)]
    rows.select(id_col, label).repartitionByRange(files, *order).sortWithinPartitions(*order).write.mode("overwrite").csv(path)


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """Labelled sparse vectors; the format's own reader checks ascending 1-based indices."""
    reader = spark.read.format("libsvm")
    return (reader.option("numFeatures", num_features) if num_features else reader).load(path)


def plan_windows(partitions: int = 1, batch: int | None = None, rows: int | None = None) -> list[tuple[int, int]]:
    """(skip, limit) windows that cover a result of ``rows`` rows, for reading it in parallel.

    A window holds ``batch`` rows, or an even share of the rows where no batch is
    given. Rows beyond ``partitions`` windows get windows of their own. Where the
    number of rows is unknown, ``partitions`` full windows are planned; with
    neither number there is one window without a limit.
    """
    if rows is None:
        return [(0, -1)] if batch is None else [(i * batch, batch) for i in range(partitions)]
    size = max(1, math.ceil(rows / partitions) if batch is None else batch)
    return [(skip, min(size, rows - skip)) for skip in range(0, rows, size)]


def read_windows(df: DataFrame, order: Sequence[str], windows: Sequence[tuple[int, int]]) -> DataFrame:
    """Rows of every window with its number; the windows lie in order without overlap."""
    if not windows:
        return df.limit(0).withColumn("window", F.lit(0))
    batch = windows[0][1]
    numbered = number_rows(df, [F.col(c) for c in order], "_n")
    at = F.floor((F.col("_n") - 1) / F.lit(batch)).cast("int")
    end = windows[-1][0] + windows[-1][1]
    return numbered.where(F.col("_n") <= end).withColumn("window", at).drop("_n")


def to_json_batches(df: DataFrame, order: Sequence[str], batch_rows: int = 1_000) -> DataFrame:
    """(batch, payload): JSON arrays of at most ``batch_rows`` records in the given order.

    A whole table as one text would have to fit one task and the driver, so
    the message is cut into arrays of bounded length.
    """
    numbered = number_rows(df, [F.col(c) for c in order], "_n")
    record = F.struct(F.col("_n"), F.struct(*df.columns).alias("r"))
    grouped = numbered.groupBy(F.floor((F.col("_n") - 1) / batch_rows).cast("long").alias("batch")).agg(
        F.sort_array(F.collect_list(record)).alias("rows")
    )
    return grouped.select("batch", F.to_json(F.transform("rows", lambda x: x["r"])).alias("payload"))


def score_with_failure_log(
    df: DataFrame, fn: Callable[[DataFrame], DataFrame], fail_path: str, keys: Sequence[str]
) -> DataFrame | None:
    """Run a scoring step that writes its result; on failure keep the batch's keys."""
    try:
        return fn(df)
    except Exception as error:  # the batch is recorded and the job goes on
        log.error("scoring failed: %s", error)
        df.select(*keys).write.mode("append").parquet(fail_path)
        return None


def commit_history(current: DataFrame, root: str, version: str) -> None:
    """Write the next history version; called last, so a failed run is repeated.

    Readers take the newest complete version (see :func:`latest_history`), and
    writing the same version again replaces only that version.
    """
    current.write.mode("overwrite").parquet(f"{root}/version={version}")


def _versions(spark: SparkSession, root: str) -> list[str]:
    """Folders of the versions that finished, oldest first."""
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return []
    found = [status.getPath() for status in fs.listStatus(base)]
    return sorted(p.toString() for p in found if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def latest_history(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The newest history version that finished, or an empty table."""
    found = _versions(spark, root)
    return spark.read.schema(schema).parquet(found[-1]) if found else spark.createDataFrame([], schema)


def whole_history(spark: SparkSession, root: str, schema: T.StructType, without: str | None = None) -> DataFrame:
    """All finished versions together, for a history kept as increments.

    ``without`` leaves one version out, so that its run can be repeated.
    """
    found = [p for p in _versions(spark, root) if without is None or not p.endswith(f"/version={without}")]
    return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)

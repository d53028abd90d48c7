"""Session settings, lineage cuts and the shared scratch folder."""

from __future__ import annotations

import atexit
import logging
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)
_OWN: set[str] = set()
_PLACES: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()  # folder of each stored table


def local_session(app: str = "linkscore", cpus: str = "8") -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    A temporary folder is used only where the setting is absent *and* the
    master is local, as in tests.
    """
    conf = spark.sparkContext.getConf()
    folder = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="linkscore-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the application's own part of the shared folder.

    That part goes when the application ends in good order; results read from it
    until then. What a crashed application leaves carries its id.
    """
    root = f"{shared_folder(spark).rstrip('/')}/linkscore-{spark.sparkContext.applicationId}"
    if root not in _OWN:
        _OWN.add(root)
        atexit.register(_remove, spark, root)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def _remove(spark: SparkSession, path: str) -> None:
    try:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception as error:  # the session may be gone already
        log.debug("%s stays: %s", path, error)


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably and forget its lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def dealt(df: DataFrame) -> DataFrame:
    """As :func:`cut`, with the partitioning and order of ``df`` kept: joins and groups by its columns do not shuffle or sort the rows again.

    An adaptive plan does not tell how its rows are dealt out, so this one is not adaptive.
    """
    conf, key = df.sparkSession.conf, "spark.sql.adaptive.enabled"
    before = conf.get(key)
    conf.set(key, "false")
    try:
        return cut(df)
    finally:
        conf.set(key, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Used instead of :func:`cut` where later steps profit from column pruning
    and from size statistics in join planning.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _PLACES[out] = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the folder of a :func:`stored` table that no later step reads, as that of an earlier round; other frames stay."""
    path = _PLACES.pop(df, None)
    if path is not None:
        _remove(df.sparkSession, path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))

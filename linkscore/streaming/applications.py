"""Keeping the association graph up to date from a stream of application messages.

The store holds two kinds of rows, nodes and relationships, in buckets by the hash of
their key. A batch only ever writes its own folder, a file for each bucket of its
keys, so a replay replaces it with the same rows. Reading merges a bucket's files
(latest values win), and a reader of given keys opens the buckets of these alone.
:func:`compact` writes such merges down. The job does so for some buckets with each
batch, by turns, so a batch never rewrites the whole store and a bucket has no more
files than batches between two of its merges.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader, StreamingQuery

from linkscore.functions.clean import clean_entity, clean_text, parse_application

log = logging.getLogger(__name__)
# Texts a message must contain to be an application.
MARKERS = ("generalApply_CreditLoan", "logNo")
DEFAULT = "00000"  # fixed value: stands for a missing field of a notice
# Message field -> (node label, relationship, cleaning rule).
ENTITIES = {
    "certno": ("Identification", "identification", "text"),
    "mobile": ("Mobile", "applymymobile", "text"),
    "contactmobile": ("Mobile", "relativemobile", "text"),
    "emergencymobile": ("Mobile", "recommend", "text"),
    "email": ("Email", "email", "email"),
    "termid": ("Terminal", "terminal", "text"),
    "loan_pan": ("BankCard", "bankcard", "text"),
    "companyname": ("Company", "company", "text"),
    "companyaddress": ("CompanyAddress", "companyaddress", "text"),
}
COMPACT_EVERY = 16  # micro-batches between two merges of a bucket
BUCKETS = 16  # of each kind; a store keeps the number that it began with
KEYS = {"nodes": ("label", "key"), "rels": ("orderno",)}
NODE_SCHEMA = "label string, key string, insert_time string, user_id string, batch_id long"
REL_SCHEMA = "orderno string, rel string, label string, key string, batch_id long"


def read_applications(
    spark: SparkSession, source: str = "parquet", schema: str = "msg_id long, body string", per_trigger: int = 1_000,
    clamp_to_earliest: bool = False, **opts: str
) -> DataFrame:
    """Stream of messages with a ``body`` column.

    ``source="kafka"`` takes the usual options (servers, topic) and starts at
    the earliest offset unless told otherwise; any file format works the same
    way with ``path``. Intake per trigger is bounded in both cases. Offsets that
    the broker no longer holds end the query; ``clamp_to_earliest`` goes on from
    the earliest one that is left, and says so.
    """
    reader: DataStreamReader = spark.readStream.format(source)
    if source == "kafka":
        opts = {"startingOffsets": "earliest", "maxOffsetsPerTrigger": str(per_trigger), "failOnDataLoss": "true", **opts}
        if clamp_to_earliest:
            opts["failOnDataLoss"] = "false"
            log.warning("messages that are no longer held will be skipped: going on from the earliest offset left")
        loaded = reader.options(**opts).load()
        return loaded.select(F.col("value").cast("string").alias("body"), F.col("timestamp").alias("sent_at"))
    return reader.schema(schema).option("maxFilesPerTrigger", per_trigger).options(**opts).load()


def only_applications(messages: DataFrame, body: str = "body") -> DataFrame:
    cond = F.lit(True)
    for marker in MARKERS:
        cond = cond & F.col(body).contains(marker)
    return messages.where(cond)


def parse_stream(messages: DataFrame, body: str = "body") -> DataFrame:
    """Fields of every message, entities cleaned by kind; unreadable ones are NULL.

    A missing insert time becomes the time the message was sent, where the source
    tells (``sent_at``), and stays missing elsewhere: a replay gives the same rows.
    """
    sent = F.date_format("sent_at", "yyyy-MM-dd HH:mm:ss") if "sent_at" in messages.columns else F.lit(None).cast("string")
    out = parse_application(messages, body, sent)
    return out.withColumns(
        {f: F.when(F.col("orderno").isNotNull(), clean_entity(F.col(f), rule)) for f, (_, _, rule) in ENTITIES.items()}
    )


def split_bad(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readable messages and the rest."""
    good = F.coalesce(clean_text(F.col("orderno")) != "", F.lit(False))
    return parsed.where(good), parsed.where(~good)


def graph_rows(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and relationships of parsed messages, one row each."""
    entries = F.filter(
        F.array(
            *[
                F.struct(F.lit(rel).alias("rel"), F.lit(label).alias("label"), F.col(f).alias("key"))
                for f, (label, rel, _) in ENTITIES.items()
            ]
        ),
        lambda e: F.coalesce(e["key"] != "", F.lit(False)),
    )
    rels = parsed.select("orderno", F.explode(entries).alias("e")).select("orderno", "e.rel", "e.label", "e.key").distinct()
    latest = F.max(F.struct("insert_time", F.col("userid").alias("user_id")))
    own = (
        parsed.groupBy(F.col("orderno").alias("key"))
        .agg(latest.alias("p"))
        .select(F.lit("ApplyInfo").alias("label"), "key", "p.insert_time", "p.user_id")
    )
    others = rels.select("label", "key").distinct()
    return own.unionByName(others, allowMissingColumns=True), rels


def bucket(name: str) -> Column:
    """Bucket of a row of ``nodes`` or ``rels``."""
    return F.pmod(F.xxhash64(*KEYS[name]), F.lit(BUCKETS)).cast("int")


def side_by_side(*writes: Callable[[], None]) -> None:
    """Run independent writes of a batch at the same time; the first failure fails the batch, once all have ended."""
    with ThreadPoolExecutor(len(writes)) as pool:
        for done in [pool.submit(inheritable_thread_target(w)) for w in writes]:
            done.result()


def _write_bucketed(rows: DataFrame, name: str, path: str) -> None:
    bucketed = rows.withColumn("bucket", bucket(name)).repartition("bucket")
    bucketed.write.mode("overwrite").partitionBy("bucket").parquet(path)


def upsert_graph(batch: DataFrame, batch_id: int, store: str) -> None:
    """Write the batch's own version of its nodes and relationships, a file for each bucket of theirs."""
    kinds = zip(("nodes", "rels"), graph_rows(batch))
    side_by_side(*[partial(_write_bucketed, rows, name, f"{store}/{name}/batch_id={batch_id}") for name, rows in kinds])


def notify(batch: DataFrame, batch_id: int, path: str) -> None:
    """Downstream notices of a batch as JSON lines."""
    fields = {"orderno": "orderno", "insert_time": "insert_time", "cert_no": "certno"}
    filled = F.struct(
        *[F.when(F.coalesce(F.col(c), F.lit("")) == "", F.lit(DEFAULT)).otherwise(F.col(c)).alias(n) for n, c in fields.items()]
    )
    batch.select(F.to_json(filled).alias("value")).write.mode("overwrite").text(f"{path}/batch_id={batch_id}")


def handle_batch(store: str, notices: str, bad: str, compact_every: int | None = COMPACT_EVERY) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` step: split, upsert, notify, keep unreadable messages.

    With a batch the buckets whose turn it is are merged up to the batch before,
    which can no longer be replayed; every bucket's turn comes once in
    ``compact_every`` batches. The parts of a step write to folders of their own, at
    the same time.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_stream(only_applications(batch)).persist()
        good, broken = split_bad(parsed)
        due = [b for b in range(BUCKETS) if compact_every and b % compact_every == batch_id % compact_every]
        keep = partial(broken.select("body").write.mode("overwrite").text, f"{bad}/batch_id={batch_id}")
        try:
            # the merge ends with the batch before, so it does not meet what this one writes
            side_by_side(
                partial(upsert_graph, good, batch_id, store),
                partial(notify, good, batch_id, notices),
                keep,
                *[partial(compact, batch.sparkSession, store, batch_id - 1, due) for _ in (due if batch_id else [])[:1]],
            )
        finally:
            parsed.unpersist()

    return step


def run(
    messages: DataFrame,
    store: str,
    notices: str,
    bad: str,
    checkpoint: str,
    interval: str | None = "500 milliseconds",
    compact_every: int | None = COMPACT_EVERY,
) -> StreamingQuery:
    """Start the job; offsets live in ``checkpoint``. ``interval=None`` drains the source and stops."""
    writer = messages.writeStream.foreachBatch(handle_batch(store, notices, bad, compact_every)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)
    return writer.start()


def _folders(spark: SparkSession, path: str) -> list:
    """Numbered folders ``name=<n>`` below a path: (n, path), and the file system."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.listStatus(root)] if fs.exists(root) else []
    return [(int(p.getName().split("=")[1]), p) for p in found if "=" in p.getName()], fs


def files_of(spark: SparkSession, store: str, name: str, buckets: Sequence[int] | None = None) -> tuple[dict, list]:
    """What a reader of the buckets opens: the newest merge by bucket ``{bucket: (upto, folder)}``, and the batches after it ``(batch, bucket, folder)``."""
    wanted = set(range(BUCKETS) if buckets is None else buckets)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    base: dict[int, tuple] = {}
    merges, fs = _folders(spark, f"{store}/base/{name}")
    for upto, folder in sorted(merges, key=lambda m: m[0]):
        if fs.exists(path(folder, "_SUCCESS")):
            base |= {b: (upto, p) for b, p in _folders(spark, folder.toString())[0] if b in wanted}
    later = []
    for batch_id, folder in _folders(spark, f"{store}/{name}")[0]:
        later += [(batch_id, b, p) for b, p in _folders(spark, folder.toString())[0] if b in wanted and batch_id > base.get(b, (-1,))[0]]
    return base, later


def _merge_nodes(rows: DataFrame) -> DataFrame:
    last = F.max(F.struct("batch_id", "insert_time", "user_id")).alias("p")
    return rows.groupBy("label", "key").agg(last).select("label", "key", "p.insert_time", "p.user_id", "p.batch_id")


def _merge_rels(rows: DataFrame) -> DataFrame:
    return rows.groupBy("orderno", "rel", "label", "key").agg(F.max("batch_id").alias("batch_id"))


_KINDS = {"nodes": (NODE_SCHEMA, _merge_nodes), "rels": (REL_SCHEMA, _merge_rels)}


def _rows(spark: SparkSession, store: str, name: str, buckets: Sequence[int] | None = None, upto: int | None = None) -> DataFrame:
    """The newest merges of the buckets and the batches after them, up to a batch if one is given; files beyond are not opened."""
    schema = _KINDS[name][0]
    base, later = files_of(spark, store, name, buckets)
    later = [f for f in later if upto is None or f[0] <= upto]
    parts = []
    if base:
        parts.append(spark.read.schema(schema).parquet(*[p.toString() for _, p in base.values()]))
    if later:
        read = spark.read.option("basePath", f"{store}/{name}").schema(f"{schema}, bucket int")
        parts.append(read.parquet(*[p.toString() for *_, p in later]).drop("bucket"))
    if not parts:
        return spark.createDataFrame([], schema)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _read(spark: SparkSession, store: str, name: str, keys: Sequence[tuple] | None) -> DataFrame:
    merge = _KINDS[name][1]
    if keys is None:
        return merge(_rows(spark, store, name))
    asked = spark.createDataFrame([*keys], ", ".join(f"{c} string" for c in KEYS[name]))
    buckets = [r[0] for r in asked.select(bucket(name)).distinct().collect()]
    return merge(_rows(spark, store, name, buckets).join(F.broadcast(asked), [*KEYS[name]], "left_semi"))


def read_nodes(spark: SparkSession, store: str, keys: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """One row per node, values of the latest batch that set them; of the given (label, key) alone, if any are given."""
    return _read(spark, store, "nodes", keys)


def read_rels(spark: SparkSession, store: str, orders: Sequence[str] | None = None) -> DataFrame:
    """Relationships, each once; those of the given applications alone, if any are given."""
    return _read(spark, store, "rels", None if orders is None else [(o,) for o in orders])


def compact(spark: SparkSession, store: str, upto: int, buckets: Sequence[int] | None = None) -> None:
    """Merge buckets (all by default) up to a batch, and remove what the merge replaces.

    Later batches stay as they are. Old files go only after the merge is complete, so
    a lost one is simply repeated, and one that is complete is not made again.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    due = list(range(BUCKETS)) if buckets is None else list(buckets)
    for name, (_, merge) in _KINDS.items():
        target = f"{store}/base/{name}/upto={upto}"
        merges, fs = _folders(spark, f"{store}/base/{name}")
        if not any(n == upto and fs.exists(path(p, "_SUCCESS")) for n, p in merges):
            rows = merge(_rows(spark, store, name, due, upto).where(F.col("batch_id") <= upto))
            rows.withColumn("bucket", bucket(name)).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(target)
        for root, last in ((f"{store}/{name}", upto), (f"{store}/base/{name}", upto - 1)):
            for n, folder in _folders(spark, root)[0]:
                if n > last:
                    continue
                own = _folders(spark, folder.toString())[0]
                for b, p in own:
                    if b in due:
                        fs.delete(p, True)
                if all(b in due for b, _ in own):
                    fs.delete(folder, True)

"""Queries of the streaming family: drain the messages, read the result back."""

from __future__ import annotations

from pyspark.sql import functions as F

from linkscore.catalog.cleaning import parsed_sql
from linkscore.catalog.registry import query, sql
from linkscore.runtime import scratch_path
from linkscore.streaming import applications as R


def _source(t, files: int = 6) -> str:
    folder = scratch_path(t.spark, "messages")
    t("messages").repartition(files, "msg_id").write.parquet(folder)
    return folder


def _drain(t, transform, name: str):
    """Run a stateless stream to its end and read what it wrote."""
    out = scratch_path(t.spark, name)
    stream = transform(R.read_applications(t.spark, path=_source(t), per_trigger=2))
    schema = stream.schema
    (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", scratch_path(t.spark, "offsets"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return t.spark.read.schema(schema).parquet(out)


def run_stream(t):
    """The whole job; returns its folders."""
    paths = {n: scratch_path(t.spark, n) for n in ("store", "notices", "bad", "checkpoint")}
    messages = R.read_applications(t.spark, path=_source(t), per_trigger=2)
    R.run(messages, **paths, interval=None).awaitTermination()
    return paths


APPS = {
    "app": "SELECT * FROM messages WHERE contains(body, 'generalApply_CreditLoan') AND contains(body, 'logNo')",
    "raw": parsed_sql("app"),
    "good": "SELECT *, lower(email) AS mail FROM raw WHERE orderno IS NOT NULL",
    "rels": """SELECT orderno, 'identification' AS rel, 'Identification' AS label, certno AS key FROM good UNION
      SELECT orderno, 'applymymobile', 'Mobile', mobile FROM good UNION
      SELECT orderno, 'email', 'Email', mail FROM good UNION SELECT orderno, 'terminal', 'Terminal', termid FROM good""",
}


@query("r01_read_applications", sql(["messages"], {}, "SELECT msg_id, body FROM messages"))
def _(t):
    return _drain(t, lambda s: s, "all")


@query("r02_only_applications", sql(["messages"], APPS, "SELECT msg_id, body FROM app"))
def _(t):
    return _drain(t, R.only_applications, "apps")


COLS = ["orderno", "insert_time", "termid", "userid", "mobile", "certno"]


@query("r03_parse_stream", sql(["messages"], APPS, f"SELECT msg_id, {', '.join(COLS)}, lower(email) AS email FROM raw"))
def _(t):
    return _drain(t, lambda s: R.parse_stream(R.only_applications(s)).select("msg_id", *COLS, "email"), "parsed")


@query("r04_graph_relationships", sql(["messages"], APPS, "SELECT * FROM rels"))
def _(t):
    return R.read_rels(t.spark, run_stream(t)["store"]).drop("batch_id")


@query(
    "r04_graph_nodes",
    sql(["messages"], APPS, "SELECT 'ApplyInfo' AS label, orderno AS key, insert_time, userid AS user_id FROM good UNION ALL "
        "SELECT DISTINCT label, key, NULL, NULL FROM rels"),
)
def _(t):
    return R.read_nodes(t.spark, run_stream(t)["store"]).drop("batch_id")


@query(
    "r05_notify",
    sql(["messages"], APPS, "SELECT orderno, insert_time, certno AS cert_no FROM good"),
)
def _(t):
    lines = t.spark.read.text(run_stream(t)["notices"]).select("value")
    return lines.select(F.from_json("value", "orderno string, insert_time string, cert_no string").alias("n")).select("n.*")


@query("r06_bad_messages", sql(["messages"], APPS, "SELECT body AS value FROM raw WHERE orderno IS NULL"))
def _(t):
    return t.spark.read.text(run_stream(t)["bad"]).select("value")


@query("r07_restart", sql(["messages"], APPS, "SELECT * FROM rels"))
def _(t):
    """Half of the files, a restart from the checkpoint, the rest; the store is merged after every second batch."""
    paths = {n: scratch_path(t.spark, n) for n in ("store", "notices", "bad", "checkpoint")}
    folder = scratch_path(t.spark, "messages")
    half = F.col("msg_id") < t("messages").agg((F.max("msg_id") / 2).alias("m")).scalar()
    for part in (half, ~half):
        t("messages").where(part).repartition(3, "msg_id").write.mode("append").parquet(folder)
        messages = R.read_applications(t.spark, path=folder, per_trigger=1)
        R.run(messages, **paths, interval=None, compact_every=2).awaitTermination()
    return R.read_rels(t.spark, paths["store"]).drop("batch_id")

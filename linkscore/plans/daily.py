"""One day's run: graph, hop export, counters, scores, history."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkscore.operators import association as A
from linkscore.operators import features as X
from linkscore.operators.train import score_batch
from linkscore.runtime import stored
from linkscore.sources.files import commit_history, whole_history


@dataclass
class Folders:
    """Everything the run keeps lies below one shared root."""

    root: str

    def __getattr__(self, name: str) -> str:
        return f"{self.root}/{name}"


def daily_run(
    spark: SparkSession,
    day: str,
    applications: DataFrame,
    edges: DataFrame,
    folders: Folders,
    model: PipelineModel | str | None = None,
    max_degree: int | None = None,
) -> DataFrame:
    """Process every application up to the end of ``day`` that no other run has processed.

    Applications that arrive late and those of skipped days are part of the
    increment, with all links that are earlier than themselves. Each output is a
    folder of the run, partitioned by the application's own day; a repeated run
    replaces its folder, also by nothing. History gets the increment, last, so a
    lost run is simply run again. Returns the features, or scores with ``model``.
    """
    before = F.lit(day).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
    known = applications.where(F.col("apply_time") < before).select("order_id", "cert_no", "apply_time")
    history = whole_history(spark, folders.history, known.select("order_id").schema, without=day)
    today = stored(A.increment(known, history, "order_id"), "increment")
    seen = edges.where(F.col("app_time") < before)

    def written(df: DataFrame, name: str) -> DataFrame:
        path = f"{getattr(folders, name)}/run={day}"
        df.write.mode("overwrite").partitionBy("dt").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    seeds = today.select(F.col("order_id").alias("app_id"))
    one = written(A.one_hop(seen, max_degree=max_degree, seeds=seeds), "one_hop")
    two = written(A.two_hop(one, seen, max_degree), "two_hop")
    detail = A.association_detail(one, two, applications, today)
    wide = X.association_features(today.select(F.col("order_id").alias("order_src")), detail)
    times = today.select(F.col("order_id").alias("order_src"), "apply_time")
    wide = X.attach_context(wide, X.path_signatures(detail), times)
    result = wide = written(wide.withColumn("dt", F.to_date("apply_time")), "features")
    if model is not None:
        scored = score_batch(wide, model, "order_src", "apply_time", X.ALL_COUNTERS)
        result = written(scored.withColumn("dt", F.to_date("apply_time")), "scores")
    commit_history(today.select("order_id"), folders.history, day)
    return result

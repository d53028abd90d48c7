"""Queries of the source and sink family; every one writes and reads back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from linkscore.catalog.association import INC, WEEK, _increment
from linkscore.catalog.registry import query, sql
from linkscore.runtime import cut, scratch_path
from linkscore.sources import external as X
from linkscore.sources import files as S
from linkscore.sources import graphstore as G
from linkscore.sources import jdbc as J

CUSTOMER = "SELECT * FROM customer"


@query("s01_load_files_to_table", CUSTOMER)
def _(t):
    folder = scratch_path(t.spark, "json")
    S.table_to_files(t("customer"), folder)
    name = f"loaded_{uuid.uuid4().hex[:8]}"
    S.load_files_to_table(t.spark, folder, name, "json", t("customer").schema, scratch_path(t.spark, name))
    return t.spark.table(name)


@query(
    "s03_range_reads",
    "WITH r AS (SELECT CASE WHEN o_orderkey < 2000 + 1000 THEN 0 ELSE least(9, (o_orderkey - 2000) // 1000) END AS part FROM orders) "
    "SELECT CAST(part AS INT) AS part, count(*) AS n FROM r GROUP BY part",
)
def _(t):
    part = J.range_number("o_orderkey", 2000, 12000, 10)
    return t("orders").groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))


@query("s04_table_to_files", "SELECT * FROM supplier")
def _(t):
    folder = scratch_path(t.spark, "json")
    S.table_to_files(t("supplier"), folder)
    return t.spark.read.schema(t("supplier").schema).json(folder)


@query("s07_csv_to_table", "SELECT * FROM part UNION ALL SELECT * FROM part")
def _(t):
    folders = [scratch_path(t.spark, "csv") for _ in range(2)]
    for f in folders:
        t("part").write.option("header", True).csv(f)
    name = f"csv_{uuid.uuid4().hex[:8]}"
    return S.csv_to_table(t.spark, folders, name, True, t("part").schema, scratch_path(t.spark, name))


@query("s08_table_to_parquet", "SELECT * , 5 AS files FROM orders")
def _(t):
    folder = scratch_path(t.spark, "parquet")
    S.table_to_parquet(t("orders"), folder, 5)
    back = t.spark.read.parquet(folder)
    files = back.select(F.input_file_name().alias("f")).distinct().count()
    return back.withColumn("files", F.lit(files))


@query("s09_read_edge_list", sql(["calls"], {}, "SELECT src, dst, CAST(weight AS DOUBLE) AS weight FROM calls"))
def _(t):
    folder = scratch_path(t.spark, "edges")
    t("calls").select(F.concat_ws("-", "src", "dst").alias("id"), "src", "dst", "weight").write.option("sep", "\u0001").csv(folder)
    return S.read_edge_list(t.spark, folder, "\u0001", weight=3)


DAYS = "SELECT order_id, type, CAST(date_trunc('year', apply_time) AS DATE) AS dt FROM applications"


def _days(t):
    return t("applications").select("order_id", "type", F.trunc("apply_time", "year").alias("dt"))


@query("s10_append_partitioned", sql(["applications"], {"d": DAYS}, "SELECT * FROM d"))
def _(t):
    folder = scratch_path(t.spark, "days")
    rows = _days(t)
    S.append_partitioned(rows.where("type <> 'pass'"), folder)
    S.append_partitioned(rows.where("type = 'pass'"), folder)
    return t.spark.read.parquet(folder)


@query(
    "s11_compact_partition",
    sql(["applications"], {"d": DAYS}, "SELECT dt, count(*) AS rows, CASE WHEN dt = DATE '1998-01-01' THEN 1 ELSE CAST(count(DISTINCT type = 'pass') AS INT) END AS files FROM d GROUP BY dt"),
)
def _(t):
    folder = scratch_path(t.spark, "days")
    for part in ("type <> 'pass'", "type = 'pass'"):
        _days(t).where(part).repartition("dt").write.mode("append").partitionBy("dt").parquet(folder)
    S.compact_partition(t.spark, folder, "1998-01-01", 1)
    back = t.spark.read.parquet(folder).withColumn("f", F.input_file_name())
    return back.groupBy("dt").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("f").cast("int").alias("files"))


@query(
    "s12_save_assignment",
    "SELECT o_orderkey AS id, o_custkey AS label FROM orders WHERE o_orderkey <> o_custkey",
)
def _(t):
    folder = scratch_path(t.spark, "labels")
    S.save_assignment(t("orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("label")), folder)
    return t.spark.read.schema("id long, label long").csv(folder)


@query("s13_read_libsvm", sql(["credit"], {}, "SELECT CAST(y AS DOUBLE) AS label, round(price, 2) AS f1, round(balance, 2) AS f2 FROM credit"))
def _(t):
    from pyspark.ml.functions import vector_to_array

    folder = scratch_path(t.spark, "libsvm")
    line = F.format_string("%d 1:%.2f 2:%.2f", "y", "price", "balance")
    t("credit").select(line.alias("value")).write.text(folder)
    rows = S.read_libsvm(t.spark, folder, 2).withColumn("a", vector_to_array("features"))
    return rows.select("label", F.col("a")[0].alias("f1"), F.col("a")[1].alias("f2"))


@query(
    "s14_read_windows",
    "WITH n AS (SELECT count(*) AS n FROM events), b AS (SELECT (n + 6) // 7 AS size FROM n), "
    "r AS (SELECT event_id, CAST((row_number() OVER (ORDER BY event_id) - 1) // (SELECT size FROM b) AS INT) AS w FROM events) "
    "SELECT w AS \"window\", count(*) AS n, min(event_id) AS first, max(event_id) AS last FROM r GROUP BY w",
)
def _(t):
    events = t("events").select("event_id")
    windows = S.plan_windows(partitions=7, rows=events.count())
    read = S.read_windows(events, ["event_id"], windows)
    return read.groupBy("window").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first"), F.max("event_id").alias("last"))


@query(
    "s14_external_windows",
    "WITH n AS (SELECT count(*) AS n FROM events), b AS (SELECT (n + 6) // 7 AS size FROM n), "
    "r AS (SELECT event_id, value, CAST((row_number() OVER (ORDER BY event_id) - 1) // (SELECT size FROM b) AS INT) AS w FROM events) "
    "SELECT w AS \"window\", count(*) AS n, min(event_id) AS first, max(event_id) AS last, round(sum(value), 4) AS value, CAST(1 AS BIGINT) AS tasks FROM r GROUP BY w",
)
def _(t):
    """Each window is fetched by a task of its own, which opens only what the window meets."""
    events = t("events").select("event_id", "value")
    windows = S.plan_windows(partitions=7, rows=events.count())
    read = X.read_external_windows(t.spark, X.parquet_windows(events, events.columns), events.schema, windows)
    return read.withColumn("task", F.spark_partition_id()).groupBy("window").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first"), F.max("event_id").alias("last"),
        F.round(F.sum("value"), 4).alias("value"), F.countDistinct("task").alias("tasks"),
    )


@query(
    "s03_external_ranges",
    "WITH r AS (SELECT CASE WHEN o_orderkey < 2000 + 1000 THEN 0 ELSE least(9, (o_orderkey - 2000) // 1000) END AS part FROM orders) "
    "SELECT CAST(part AS INT) AS part, count(*) AS n, CAST(1 AS BIGINT) AS tasks FROM r GROUP BY part",
)
def _(t):
    orders = t("orders").select("o_orderkey", "o_totalprice")
    fetch = X.parquet_ranges(orders, "o_orderkey", orders.columns)
    read = X.read_external_ranges(t.spark, fetch, orders.schema, 2000, 12000, 10)
    return read.withColumn("task", F.spark_partition_id()).groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("task").alias("tasks"))


GRAPH = {
    "nodes": "SELECT c_custkey AS id, 'Customer' AS label, c_acctbal AS value FROM customer UNION ALL SELECT -1 - s_suppkey, 'Supplier', s_acctbal FROM supplier",
    "rels": "SELECT src, dst, CASE WHEN weight > 1 THEN 'OFTEN' ELSE 'ONCE' END AS type, CASE WHEN weight > 2 THEN CAST(weight AS DOUBLE) END AS value FROM calls",
}


def graph(t):
    nodes = t("customer").select(F.col("c_custkey").alias("id"), F.lit("Customer").alias("label"), F.col("c_acctbal").alias("value")).unionAll(
        t("supplier").select(-1 - F.col("s_suppkey"), F.lit("Supplier"), "s_acctbal")
    )
    weight = F.col("weight")
    rels = t("calls").select(
        "src", "dst", F.when(weight > 1, "OFTEN").otherwise("ONCE").alias("type"), F.when(weight > 2, weight.cast("double")).alias("value")
    )
    return nodes, rels


EDGES = "SELECT DISTINCT src, dst, coalesce(r.value, 1.0) AS value FROM rels r JOIN nodes a ON a.id = src AND a.label = 'Customer' JOIN nodes b ON b.id = dst AND b.label = 'Supplier' WHERE type IN ('OFTEN')"


@query("s15_load_pattern_edges", sql(["calls"], {**GRAPH, "e": EDGES}, "SELECT * FROM e"))
def _(t):
    return G.load_pattern(*graph(t), "Customer", ["OFTEN"], "Supplier")[1]


@query("s15_load_pattern_vertices", sql(["calls"], {**GRAPH, "e": EDGES}, "SELECT DISTINCT n.id, n.value FROM nodes n JOIN (SELECT src AS id FROM e UNION SELECT dst FROM e) x USING (id)"))
def _(t):
    return G.load_pattern(*graph(t), "Customer", ["OFTEN"], "Supplier")[0]


MERGE = {
    **GRAPH,
    "batch": "SELECT o_custkey AS src, -1 - CAST(o_orderkey % 150 AS BIGINT) AS dst, o_totalprice AS value FROM orders",
    "offer": "SELECT src, dst, min(value) AS value FROM batch GROUP BY src, dst",
}


def _merged(t):
    batch = t("orders").select(F.col("o_custkey").alias("src"), (-1 - F.col("o_orderkey") % 150).alias("dst"), F.col("o_totalprice").alias("value"))
    return G.merge_edges(*graph(t), batch, "Customer", "Supplier", "ONCE")


@query(
    "s16_merge_edges",
    sql(["calls"], MERGE, "SELECT src, dst, type, value FROM rels UNION ALL SELECT src, dst, 'ONCE', value FROM offer o "
        "WHERE NOT EXISTS (SELECT 1 FROM rels r WHERE r.src = o.src AND r.dst = o.dst AND r.type = 'ONCE')"),
)
def _(t):
    return _merged(t)[1]


@query(
    "s16_merge_nodes",
    sql(["calls"], MERGE, "SELECT id, label, value FROM nodes UNION ALL SELECT id, label, NULL FROM (SELECT src AS id, 'Customer' AS label FROM batch UNION SELECT dst, 'Supplier' FROM batch) x "
        "WHERE NOT EXISTS (SELECT 1 FROM nodes n WHERE n.id = x.id AND n.label = x.label)"),
)
def _(t):
    return _merged(t)[0]


VALUES = "SELECT o_custkey AS id, sum(o_totalprice) AS value FROM orders GROUP BY o_custkey"


def _values(t):
    return t("orders").groupBy(F.col("o_custkey").alias("id")).agg(F.sum("o_totalprice").alias("value"))


@query("s17_update_values", sql(["calls"], {**GRAPH, "v": VALUES}, "SELECT n.id, n.label, round(coalesce(v.value, n.value), 2) AS value FROM nodes n LEFT JOIN v USING (id)"))
def _(t):
    out = G.update_values(graph(t)[0], _values(t))[0]
    return out.withColumn("value", F.round("value", 2))


@query("s17_update_count", sql(["calls"], {**GRAPH, "v": VALUES}, "SELECT count(*) AS updated FROM nodes JOIN v USING (id)"))
def _(t):
    return G.update_values(graph(t)[0], _values(t))[1]


@query(
    "s18_to_json_batches",
    "WITH r AS (SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderstatus AS status, CAST(o_custkey AS VARCHAR) AS cert_no, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS batch, o_orderkey AS k FROM orders) "
    "SELECT batch, concat('[', string_agg(concat('{\"key\":', k, ',\"order_id\":\"', order_id, '\",\"status\":\"', status, '\",\"cert_no\":\"', cert_no, '\"}'), ',' ORDER BY k), ']') AS payload FROM r GROUP BY batch",
)
def _(t):
    rows = t("orders").select(
        F.col("o_orderkey").alias("key"), F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_orderstatus").alias("status"), F.col("o_custkey").cast("string").alias("cert_no")
    )
    return S.to_json_batches(rows, ["key"], 1000)


@query("s19_score_with_failure_log", sql(["applications"], {"inc": INC}, "SELECT order_id, apply_time FROM inc"))
def _(t):
    folder = scratch_path(t.spark, "failed")
    batch = cut(_increment(t))

    def score(df):
        # a step that cannot succeed: the scores of an absent model folder
        return df.sparkSession.read.parquet(scratch_path(df.sparkSession, "no-model"))

    S.score_with_failure_log(batch, score, folder, ["order_id", "apply_time"])
    return t.spark.read.parquet(folder)


@query(
    "j03_commit_history",
    sql(["applications"], {}, f"SELECT order_id, cert_no FROM applications WHERE apply_time <= TIMESTAMP '{WEEK[1]}'"),
)
def _(t):
    root = scratch_path(t.spark, "history")
    apps = t("applications").select("order_id", "cert_no", "apply_time")
    for version, end in (("1998-06-01", WEEK[0]), ("1998-06-08", WEEK[1])):
        S.commit_history(apps.where(F.col("apply_time") <= F.lit(end).cast("timestamp_ntz")).drop("apply_time"), root, version)
    return S.latest_history(t.spark, root, apps.drop("apply_time").schema)

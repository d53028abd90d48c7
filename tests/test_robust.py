"""Ordinary and awkward data: constants, one class, gaps, late rows, long chains, hot entities."""

from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkscore.operators import aggregates as A
from linkscore.operators import association as AS
from linkscore.operators import binning as B
from linkscore.operators import evaluate as E
from linkscore.operators import features as X
from linkscore.operators import graph as G
from linkscore.operators import knn as K
from linkscore.operators import linear as L
from linkscore.operators import louvain as LV
from linkscore.operators import mining as M
from linkscore.operators import prepare as P
from linkscore.operators import similarity as S
from linkscore.plans.daily import Folders, daily_run
from linkscore.runtime import shared_folder
from linkscore.sources import files
from linkscore.streaming import applications as R


@pytest.fixture(scope="module")
def constant(spark):
    return spark.createDataFrame([(i, 4.0, float(i)) for i in range(6)] + [(9, None, 1.0)], "id long, x double, v double")


def test_constant_columns(spark, constant):
    rows = A.histogram(constant, "x", 5).collect()
    assert [(r["bin"], r["count"], r["density"]) for r in rows] == [(0, 6, None)]
    for fn in (P.min_max, P.standardize, P.robust_scale):
        assert [r["x"] for r in fn(constant, ["x", "v"]).orderBy("id").collect()] == [0.0] * 6 + [None]
    assert L.lwlr(constant.dropna(), "x", "v", [4.0], 1.0).first()["predicted"] == pytest.approx(2.5)


def test_points_on_a_line(spark):
    pts = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(8)], "id long, vec array<double>")
    edges = {(r["src"], r["dst"]) for r in K.knn_graph(pts, 1).collect()}
    assert edges and all(abs(a - b) == 1 for a, b in edges)


@pytest.mark.parametrize("y", [0, 1])
def test_one_class_only(spark, y):
    df = spark.createDataFrame([(i, i / 10, y) for i in range(8)], "id long, score double, y int")
    curve = E.threshold_curve(df, "score", "y").collect()
    assert all((r["recall"] is None) == (y == 0) for r in curve)
    assert all((r["fpr"] is None) == (y == 1) for r in E.roc(df, "score", "y").collect())
    assert E.auc_rank(df, "score", "y").first()[0] is None and E.areas(df, "score", "y").first()["auroc"] is None
    assert E.ks_table(df, "score", "y", "id", 4).count() == 4 and E.lift_table(df, "score", "y", "id", 4).count() == 4
    bins = spark.createDataFrame([("v", i, 5 * (1 - y), 5 * y) for i in (1, 2, 3)], "var string, bin int, n0 long, n1 long")
    for method in B.METHODS:
        assert B.split_merit(bins, method).count() == 2 and B.binning_merit(bins, method).count() == 1


def test_ratings_without_length(spark):
    df = spark.createDataFrame([(1, 1, 0.0), (1, 2, 3.0), (2, 1, 0.0), (2, 2, 1.0), (2, 3, -1.0), (3, 2, 1.0)], "user_id long, item_id long, rating double")
    sims = {(r["item_a"], r["item_b"]): r["similarity"] for r in S.item_similarity(df, "cosine").collect()}
    assert sims[1, 2] is None
    assert S.recommend(df, 3).count() >= 0


def test_empty_bins_and_columns(spark):
    df = spark.createDataFrame([(0.0, None, 0), (0.1, None, 1), (9.9, None, 1), (10.0, None, 0)], "x double, gone double, y int")
    raw = B.bin_counts(df, ["x", "gone"], "y")
    assert {r[0] for r in raw.select("var").distinct().collect()} == {"x"}
    for method in B.METHODS:
        assert B.split_merit(raw, method).count() == 99
    assert B.bin_counts(df, ["gone"], "y").count() == 0


def test_text_ids(spark):
    ids = spark.createDataFrame([(" A17",), ("B2 ",)], "order_src string")
    block = spark.createDataFrame([("A17", 3)], "order_src string, order_cnt long")
    got = {r["order_src"]: r["order_cnt_x"] for r in X.merge_features(ids, [(block, "_x")]).collect()}
    assert got == {"A17": 3, "B2": 0}


def test_windows_cover_every_row():
    for partitions in (1, 2, 3, 7):
        for batch in (None, 1, 4, 10):
            for rows in (0, 1, 9, 35):
                plan = files.plan_windows(partitions, batch, rows)
                assert [i for skip, limit in plan for i in range(skip, skip + limit)] == list(range(rows))


def test_long_itemsets(spark):
    df = spark.createDataFrame([(b, i) for b in range(3) for i in range(6)] + [(9, 0)], "basket long, item long")
    sets = M.apriori(df, 0.7).collect()
    assert len(sets) == 2**6 - 1 and max(r["size"] for r in sets) == 6
    assert max(r["size"] for r in M.apriori(df, 0.7, max_size=2).collect()) == 2


def test_far_landmarks(spark):
    path = spark.range(130).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    far = G.landmark_distances(path, spark.createDataFrame([(0,)], "id long"))
    assert far.agg(F.max("distance")).first()[0] == 130


def test_hot_entity_is_kept(spark):
    """A third of all applications share one device: every link counts, whatever the blocks."""
    n = 300
    edges = spark.range(n).select(
        F.lit(9).alias("entity_type"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("d"), (F.col("id") % 40).cast("string"))).alias("entity_value"),
        F.col("id").alias("app_id"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_interval(days=F.col("id").cast("int"))).alias("app_time"),
    )
    seeds = spark.createDataFrame([(299 - 299 % 3,), (200,)], "app_id long")
    one = AS.one_hop(edges, seeds=seeds)
    two = AS.two_hop(one, edges)
    rows = [tuple(r) for r in edges.select("entity_value", "app_id").collect()]
    by = {}
    for v, a in rows:
        by.setdefault(v, []).append(a)
    of = {a: v for v, a in rows}
    want1 = {(a, b) for a in (297, 200) for b in by[of[a]] if b < a}
    assert {(r["a_order"], r["b_order"]) for r in one.collect()} == want1
    want2 = {(a, b, c) for a, b in want1 for c in by[of[b]] if c not in (a, b) and c < a}
    assert {(r["a_order"], r["b_order"], r["c_order"]) for r in two.collect()} == want2


def test_many_categories(spark):
    df = spark.range(200_000).select((F.col("id") % 100_000).alias("c"), (F.col("id") % 100_000 >= 60_000).cast("int").alias("y"))
    got = B.reduce_categories(df, "c", "y", method=1, mmax=2).groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.sum("n1").alias("bad"))
    assert {(r["grp"], r["n"], r["bad"]) for r in got.collect()} == {(1, 60_000, 0), (2, 40_000, 80_000)}


@pytest.mark.parametrize("method", [1, 2, 3, 4])
def test_category_search_is_the_greedy_one(spark, method):
    rng = np.random.default_rng(method)
    rows = [(f"c{c:02d}", int(v)) for c in range(17) for v in rng.random(int(rng.integers(5, 40))) < rng.random()]
    got = {r["value"]: (r["grp"], r["n0"], r["n1"]) for r in B.reduce_categories(spark.createDataFrame(rows, "c string, y int"), "c", "y", method, 5).collect()}
    order = sorted(got, key=lambda v: (got[v][2] / (got[v][1] + got[v][2]), v))
    want = B.greedy_groups(np.array([got[v][1] for v in order]), np.array([got[v][2] for v in order]), method, 5)
    assert [got[v][0] for v in order] == list(want)


def test_model_tree_has_linear_leaves(spark):
    df = spark.range(400).select((F.col("id") % 40).cast("double").alias("x"), ((F.col("id") * 7) % 11).cast("double").alias("z"))
    df = df.withColumn("y", F.when(F.col("x") < 20, 3 * F.col("x") - F.col("z")).otherwise(100 - F.col("x") + 2 * F.col("z")))
    tree = M.model_tree(df, ["x", "z"], "y", 2)
    root = next(r for r in tree if r["node"] == "")
    assert (root["column"], root["value"]) == ("x", 19.0)
    assert df.withColumn("p", M.predict_model_tree(tree, ["x", "z"])).where("abs(p - y) > 1e-6").count() == 0


def test_bisecting_keeps_rows_in_their_half(spark):
    xs = [0.0, 1.0, 2.0, 10.0, 11.0, 12.0, 30.0, 31.0]
    df = spark.createDataFrame([(x, 0.0) for x in xs], "x double, y double")
    centres, rows = M.bisect_clusters(df, ["x", "y"], 3)
    groups = {}
    for r in rows.collect():
        groups.setdefault(r["cluster"], []).append(r["x"])
    assert sorted(map(sorted, groups.values())) == [xs[:3], xs[3:6], xs[6:]]
    assert sorted(c[0] for c in centres) == [1.0, 11.0, 30.5]


def test_halving_goes_on_while_rows_change(spark):
    """A split that takes more than ten rounds; a given number of rounds still holds."""
    xs = np.exp(np.random.default_rng(1).normal(size=2000))
    halves, centres, rounds = None, [xs.min(), xs.max()], 0
    while halves is None or ((abs(xs - centres[0]) > abs(xs - centres[1])) != halves).any():
        halves = abs(xs - centres[0]) > abs(xs - centres[1])
        centres = [xs[~halves].mean(), xs[halves].mean()]
        rounds += 1
    assert rounds > 10
    df = spark.createDataFrame([(float(x), 0.0) for x in xs], "x double, y double").cache()
    got, rows = M.bisect_clusters(df, ["x", "y"], 2)
    assert [c[0] for c in got] == pytest.approx(centres)
    assert rows.where("cluster = 1").count() == halves.sum()
    start = [[xs.min(), 0.0], [xs.max(), 0.0]]
    assert M.lloyd(df, ["x", "y"], start, 2) != M.lloyd(df, ["x", "y"], start, 3)


def test_louvain_levels_never_lose_quality(spark):
    """Cliques in a ring: several levels, quality rising, the last one that of the result."""
    edges = []
    for c in range(12):
        ids = range(5 * c, 5 * c + 5)
        edges += [(a, b, 1.0) for a in ids for b in ids if a < b] + [(5 * c, (5 * c + 7) % 60, 0.2)]
    df = spark.createDataFrame(edges, "src long, dst long, weight double")
    member, q = LV.louvain(df)
    assert q == sorted(q) and q[-1] > 0.5
    found = G.modularity(df, member.withColumnRenamed("community", "label"), "weight").first()[0]
    assert found == pytest.approx(q[-1], abs=1e-6)


def _daily_inputs(spark):
    rows = [
        (1, "p", "2024-01-01 08:00:00"), (2, "p", "2024-01-02 09:00:00"), (3, "q", "2024-01-02 23:59:59.5"),
        (4, "p", "2024-01-03 10:00:00"), (5, "q", "2024-01-03 00:00:00"), (6, "p", "2024-01-05 12:00:00"),
    ]
    apps = spark.createDataFrame(rows, "order_id long, cert_no string, apply_time string").selectExpr(
        "order_id", "cert_no", "CAST(apply_time AS timestamp_ntz) AS apply_time", "'normal' AS performance", "'pass' AS type",
        "1 AS current_due_day", "1 AS history_due_day", "0 AS label",
    )
    edges = apps.selectExpr("9 AS entity_type", "'dev' AS entity_value", "order_id AS app_id", "apply_time AS app_time")
    return apps, edges


def test_daily_run_misses_nothing(spark, tmp_path):
    """A late application, one in the last half second, a skipped day, an empty repeat."""
    apps, edges = _daily_inputs(spark)
    folders = Folders(str(tmp_path))
    on_time = apps.where("order_id <> 2")
    daily_run(spark, "2024-01-01", on_time, edges, folders)
    daily_run(spark, "2024-01-02", on_time, edges, folders)
    daily_run(spark, "2024-01-03", apps, edges, folders)
    daily_run(spark, "2024-01-05", apps, edges, folders)

    def features():
        return spark.read.parquet(folders.features)

    assert sorted(r[0] for r in features().select("order_src").collect()) == [1, 2, 3, 4, 5, 6]
    assert {(r["run"].isoformat(), r["order_src"]) for r in features().collect()} >= {("2024-01-03", 2), ("2024-01-02", 3)}
    assert features().where("order_src = 2").first()["dt"].isoformat() == "2024-01-02"
    hops = spark.read.parquet(folders.one_hop)
    assert {(r["a_order"], r["b_order"]) for r in hops.collect()} == {(a, b) for a, ta in _times(apps) for b, tb in _times(apps) if tb < ta}
    # the same run again gives the same; a run whose rows are gone leaves nothing behind
    before = sorted(map(str, features().collect()))
    daily_run(spark, "2024-01-03", apps, edges, folders)
    assert sorted(map(str, features().collect())) == before
    daily_run(spark, "2024-01-05", apps.where("order_id <> 6"), edges, folders)
    assert features().where("order_src = 6").count() == 0


def _times(apps):
    return [(r["order_id"], r["apply_time"]) for r in apps.collect()]


def test_replaced_day_without_rows(spark, tmp_path):
    path = f"{tmp_path}/days"
    rows = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "v long, dt string")
    files.append_partitioned(rows, path)
    files.append_partitioned(rows.where("v = 9"), path, replace=True, days=["2024-01-02"])
    assert [r["v"] for r in spark.read.parquet(path).collect()] == [1]


def _message(i, when=None):
    import json

    apply = {"orderId": str(i), "termId": f"T{i % 3}"} | ({"insertTime": when} if when else {})
    return json.dumps({"kind": "generalApply_CreditLoan", "logNo": str(i), "cLoanApply": json.dumps(apply), "cApplyUser": json.dumps({"userId": str(i)})})


def test_stream_store_stays_small(spark, tmp_path):
    """Merges inside the job, some buckets after each batch, bound the files; a replayed batch and a missing time change nothing."""
    src, store = f"{tmp_path}/src", f"{tmp_path}/store"
    for part in range(7):
        rows = [(10 * part + j, _message(10 * part + j, None if j else "2024-01-01 00:00:00")) for j in range(4)]
        spark.createDataFrame(rows, "msg_id long, body string").coalesce(1).write.mode("append").parquet(src)
    messages = R.read_applications(spark, path=src, per_trigger=1)
    R.run(messages, store, f"{tmp_path}/n", f"{tmp_path}/b", f"{tmp_path}/c", interval=None, compact_every=2).awaitTermination()
    for name in ("nodes", "rels"):
        base, later = R.files_of(spark, store, name)
        counts = Counter(b for _, b, _ in later)
        assert base and max(counts.values()) <= 2  # a bucket's batches since its last merge
        assert len([p for p in (tmp_path / "store" / "base" / name).iterdir() if "=" in p.name]) <= 2
        assert len([p for p in (tmp_path / "store" / name).iterdir() if "=" in p.name]) <= 3
    own = R.read_rels(spark, store, ["31", "32"])
    assert sorted(map(str, own.collect())) == sorted(map(str, R.read_rels(spark, store).where("orderno IN ('31', '32')").collect()))
    assert len({p.split("bucket=")[1].split("/")[0] for p in own.inputFiles()}) <= 2
    (one,) = R.read_nodes(spark, store, [("ApplyInfo", "10")]).collect()
    assert (one.key, one.insert_time) == ("10", "2024-01-01 00:00:00")
    before = sorted(map(str, R.read_nodes(spark, store).collect()))
    assert R.read_rels(spark, store).select("orderno").distinct().count() == 28
    assert R.read_nodes(spark, store).where("label = 'ApplyInfo' AND insert_time IS NOT NULL").count() == 7
    R.handle_batch(store, f"{tmp_path}/n", f"{tmp_path}/b", None)(spark.read.parquet(src).where("msg_id < 4"), 0)
    assert sorted(map(str, R.read_nodes(spark, store).collect())) == before
    rels = sorted(map(str, R.read_rels(spark, store).drop("batch_id").collect()))
    R.compact(spark, store, 6)
    R.compact(spark, store, 6)  # repeated
    assert not R.files_of(spark, store, "rels")[1]
    assert sorted(map(str, R.read_rels(spark, store).drop("batch_id").collect())) == rels
    assert sorted(map(str, R.read_nodes(spark, store).collect())) == before


def test_lost_offsets_end_the_query_by_default(monkeypatch):
    seen = {}

    class Reader:
        def options(self, **opts):
            seen.update(opts)
            raise StopIteration

    class Session:
        class readStream:  # noqa: N801
            @staticmethod
            def format(source):
                return Reader()

    for clamp, want in ((False, "true"), (True, "false")):
        with pytest.raises(StopIteration):
            R.read_applications(Session(), "kafka", clamp_to_earliest=clamp, subscribe="x")
        assert seen["failOnDataLoss"] == want


def test_loops_leave_no_earlier_rounds(spark):
    """Of a long loop's written rounds, only what the result reads stays on the shared folder."""
    def folders(prefix):
        root = Path(shared_folder(spark)) / f"linkscore-{spark.sparkContext.applicationId}"
        return {p.name for p in root.glob(f"{prefix}-*")} if root.exists() else set()

    chain = spark.createDataFrame([(i, i + 1) for i in range(60)], "src long, dst long")
    before = folders("round")
    found = G.connected_components(chain)
    assert len(folders("round") - before) == 1
    assert {r.component for r in found.collect()} == {0}

    cliques = [(a, b, 1.0) for k in range(4) for a in range(5 * k, 5 * k + 5) for b in range(a + 1, 5 * k + 5)]
    edges = spark.createDataFrame([*cliques, (4, 5, 1.0), (9, 10, 1.0), (14, 15, 1.0)], "src long, dst long, weight double")
    before = folders("louvain")
    member, qualities = LV.louvain(edges)
    # a level keeps its state, the summed edges, the vertices after it and the assignment
    assert len(folders("louvain") - before) <= 4 * len(qualities) + 3
    groups = {r.id: r.community for r in member.collect()}
    assert len(groups) == 20 and all(len({groups[v] for v in range(5 * k, 5 * k + 5)}) == 1 for k in range(4))

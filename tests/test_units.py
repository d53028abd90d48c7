"""Small inputs with answers worked out by hand or by a plain model."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkscore.functions.clean import is_phone
from linkscore.operators import aggregates as A
from linkscore.operators import binning as B
from linkscore.operators import evaluate as E
from linkscore.operators import graph as G
from linkscore.operators import linear as L
from linkscore.operators import louvain as LV
from linkscore.operators import mining as M
from linkscore.operators import prepare as P
from linkscore.operators import similarity as S
from linkscore.operators import text as T
from linkscore.operators import train as TR
from linkscore.operators.knn import knn_classify
from linkscore.operators.woe import require_binary
from linkscore.sources import files, jdbc


def test_grouped_mean(spark):
    df = spark.createDataFrame([("a", 4.5), ("a", 2.4), ("b", 1.8), ("b", None)], "name string, num double")
    got = {r[0]: (r[1], r[2]) for r in df.groupBy("name").agg(A.avg5(F.col("num")), A.avg5(F.col("num"), True)).collect()}
    assert got == {"a": (3.45, 3.45), "b": (1.8, 0.9)}


def test_array_mean(spark):
    df = spark.createDataFrame([([1.0, 4.5],), ([2.0, 2.4],), ([3.0, 1.8],)], "num array<double>")
    assert np.allclose(df.agg(A.array_avg(F.col("num"), 2)).first()[0], [2.0, 2.9])
    short = df.unionByName(spark.createDataFrame([([6.0],)], "num array<double>"))
    assert np.allclose(short.agg(A.array_avg(F.col("num"), 2)).first()[0], [3.0, 2.9])


def test_phone_modes(spark):
    df = spark.createDataFrame([("13812345678",), ("17012345678",), ("18112345678",), ("15412345678",), ("0755-28001234",), ("12x",)], "n string")
    got = [tuple(r) for r in df.select(is_phone(F.col("n"), "strict"), is_phone(F.col("n"))).collect()]
    assert got == [(True, True), (False, True), (False, True), (False, False), (True, True), (False, False)]


def test_baskets(spark):
    data = [[1, 3, 4], [2, 3, 5], [1, 2, 3, 5], [2, 5]]
    df = spark.createDataFrame([(b, i) for b, items in enumerate(data) for i in items], "basket long, item long")
    want = [[1], [1, 3], [2], [2, 3], [2, 3, 5], [2, 5], [3], [3, 5], [5]]
    sets = M.apriori(df, 0.5)
    assert sorted(r["items"] for r in sets.collect()) == want
    assert sorted(r["items"] for r in M.fp_growth(df, 2).collect()) == want
    sure = {(tuple(r["antecedent"]), tuple(r["consequent"])) for r in M.rules(sets, 0.99).collect()}
    assert sure == {((1,), (3,)), ((2,), (5,)), ((5,), (2,)), ((2, 3), (5,)), ((3, 5), (2,))}


def test_four_points(spark):
    train = spark.createDataFrame([(0, [1.0, 1.1], "A"), (1, [1.0, 1.0], "A"), (2, [0.0, 0.0], "B"), (3, [0.0, 0.1], "B")], "id long, vec array<double>, label string")
    query = spark.createDataFrame([(9, [0.0, 0.0])], "id long, vec array<double>")
    assert knn_classify(train, query, 3).collect()[0]["label"] == "B"


def two_groups(spark):
    """A dense group 1-5, a dense group 6-9, one bridge."""
    e = list(itertools.combinations(range(1, 6), 2)) + list(itertools.combinations(range(6, 10), 2)) + [(5, 6)]
    return spark.createDataFrame([(a, b, 1.0) for a, b in e], "src long, dst long, weight double")


def test_louvain_finds_both_groups(spark, tmp_path):
    edges = two_groups(spark)
    member, q = LV.louvain(edges, out_dir=str(tmp_path))
    groups = {}
    for r in member.collect():
        groups.setdefault(r["community"], set()).add(r["id"])
    assert sorted(map(sorted, groups.values())) == [[1, 2, 3, 4, 5], [6, 7, 8, 9]]
    labels = member.withColumnRenamed("community", "label")
    alone = member.select("id", F.col("id").alias("label"))
    assert G.modularity(edges, labels, "weight").first()[0] > G.modularity(edges, alone, "weight").first()[0]
    assert q[-1] > 0 and spark.read.parquet(f"{tmp_path}/quality").count() == len(q)


def test_compressed_weights(spark):
    edges = two_groups(spark)
    state = LV.initial_state(edges).withColumn("community", F.when(F.col("id") <= 5, 1).otherwise(6).cast("long"))
    small, between = LV.compress(state, edges)
    got = {r["id"]: (r["internal"], r["node"]) for r in small.collect()}
    assert got == {1: (20.0, 1.0), 6: (12.0, 1.0)} and between.count() == 1


def test_components_and_pscan(spark):
    edges = two_groups(spark)
    assert G.connected_components(edges).select("component").distinct().count() == 1
    got = {r["id"]: r["component"] for r in G.pscan(edges, 0.5).collect()}
    assert got == {**{i: 1 for i in range(1, 6)}, **{i: 6 for i in range(6, 10)}}


def test_pagerank_settles(spark):
    ring = spark.range(6).select(F.col("id").alias("src"), ((F.col("id") + 1) % 6).alias("dst"))
    ranks = [r["rank"] for r in G.pagerank(ring, tol=1e-6).collect()]
    assert np.allclose(ranks, 1.0)


def test_power_clusters(spark):
    got = {r["id"]: r["cluster"] for r in G.power_clusters(two_groups(spark), 2, 15).collect()}
    assert set(got) == set(range(1, 10)) and len(set(got.values())) <= 2


def test_bfs_on_a_path(spark):
    path = spark.range(9).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    seeds = spark.createDataFrame([(0,)], "id long")
    got = sorted((r["hop"], r["id"]) for r in G.neighbourhood(path, seeds, 4).collect())
    assert got == [(i, i) for i in range(5)]
    assert [r["path"] for r in G.reach_exactly(path, 3, seeds).collect()] == [[0, 1, 2, 3]]


def test_iterate_stops_early(spark):
    path = spark.range(4).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    values = spark.range(5).select("id", (10 - F.col("id")).alias("value"))
    got = {r["id"]: r["value"] for r in G.iterate(values, path, lambda v: v, F.max, F.greatest, 50).collect()}
    assert set(got.values()) == {10}


def test_ssl_keeps_known_labels(spark):
    edges = spark.createDataFrame([(1, 2, 1.0), (2, 3, 1.0), (4, 3, 3.0)], "src long, dst long, weight double")
    v = spark.createDataFrame([(1, 7), (2, None), (3, None), (4, 5)], "id long, label int")
    got = {r["id"]: r["label"] for r in G.ssl_propagate(v, edges, 5).collect()}
    assert got == {1: 7, 2: 7, 3: 5, 4: 5}


def test_empty_bins_fold_into_neighbours(spark):
    bins = [("v", 1, 0.0, 1.0, 3, 0, 3), ("v", 2, 1.0, 2.0, 0, 0, 0), ("v", 3, 2.0, 3.0, 2, 4, 6), ("v", 4, 3.0, 4.0, 0, 2, 2)]
    got = B.merge_empty(spark.createDataFrame(bins, B.BINS)).collect()
    assert [(r["lower"], r["upper"], r["n0"], r["n1"]) for r in got] == [(0.0, 4.0, 5, 6)]


@pytest.mark.parametrize("method", [1, 2, 3, 4])
def test_greedy_groups_take_the_best_first_cut(method):
    rng = np.random.default_rng(method)
    n0, n1 = rng.integers(1, 50, 9), rng.integers(1, 50, 9)
    got = B.greedy_groups(n0, n1, method, 2)
    best = max(range(1, 9), key=lambda k: B.merit_of([n0[:k].sum(), n0[k:].sum()], [n1[:k].sum(), n1[k:].sum()], method))
    assert list(got) == [1] * best + [2] * (9 - best)


def test_optimal_bins_cover_all_rows(spark):
    df = spark.range(2000).select(F.col("id").cast("double").alias("x"), (F.pmod(F.xxhash64("id"), F.lit(10)) < F.when(F.col("id") < 700, 2).otherwise(7)).cast("int").alias("y"))
    bins = B.optimal_bins(df, ["x"], "y", method=4, mmax=3).orderBy("newbin").collect()
    assert sum(r["total"] for r in bins) == 2000 and len(bins) <= 3
    assert any(abs(r["upper"] - 700) < 30 for r in bins)


def test_category_groups_follow_bad_rate(spark):
    rows = [(c, int(i < bad)) for c, bad in (("p", 1), ("q", 9), ("r", 2), ("s", 8)) for i in range(10)]
    got = {r["value"]: r["grp"] for r in B.reduce_categories(spark.createDataFrame(rows, "c string, y int"), "c", "y", mmax=2).collect()}
    assert got == {"p": 1, "r": 1, "q": 2, "s": 2}


def test_target_must_be_binary(spark):
    require_binary(spark.createDataFrame([(0,), (1,)], "y int"), "y")
    for bad in ([(0,), (2,)], [(1,), (1,)], [(0,), (1,), (None,)]):
        with pytest.raises(ValueError):
            require_binary(spark.createDataFrame(bad, "y int"), "y")


def test_ks_tiles_are_even(spark):
    df = spark.range(105).select("id", F.lit(0.5).alias("score"), (F.col("id") % 2).cast("int").alias("y"))
    got = E.ks_table(df, "score", "y", "id", 20).collect()
    assert sum(r["pos"] + r["neg"] for r in got) == 105
    assert {r["pos"] + r["neg"] for r in got} <= {5, 6}


def test_adaboost_on_five_points(spark):
    pts = [(1.0, 2.1, 1), (2.0, 1.1, 1), (1.3, 1.0, -1), (1.0, 1.0, -1), (2.0, 1.0, 1)]
    df = spark.createDataFrame(pts, "a double, b double, y int")
    stumps = L.adaboost_stumps(df, "y", ["a", "b"], 9)
    assert abs(stumps[0]["error"] - 0.2) < 1e-9
    wrong = df.withColumn("s", F.signum(L.stump_score(stumps))).where("s <> y").count()
    assert wrong == 0


def test_linear_solvers(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 2))
    y = 3 + x @ [2.0, -1.0]
    df = spark.createDataFrame([(i, float(a), float(b), float(v)) for i, ((a, b), v) in enumerate(zip(x, y))], "id long, a double, b double, y double")
    got = {r["column"]: r["coef"] for r in L.ols(df, "y", ["a", "b"]).collect()}
    assert np.allclose([got["const"], got["a"], got["b"]], [3, 2, -1])
    ridge, lam, errors = L.ridge_path(df, "y", ["a", "b"], "id")
    assert lam == math.exp(-10) and len(errors) == 30
    side = df.withColumn("side", F.when(F.col("a") > 0, 1).otherwise(-1))
    u = L.proximal_svm(side, "side", ["a", "b"], 10.0)
    e = np.column_stack([x, -np.ones(300)])
    d = np.where(x[:, 0] > 0, 1.0, -1.0)
    assert np.allclose((np.eye(3) / 10 + e.T @ e) @ u, e.T @ d)
    w = L.pegasos(side, "side", ["a", "b"], 0.1, 20)
    assert w[0] > abs(w[1])


def test_pca_scores_are_uncorrelated(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(200, 3)) @ rng.normal(size=(3, 3))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    out, var = L.pca_project(df, ["a", "b", "c"], 3)
    assert abs(out.select(F.corr("pc1", "pc2")).first()[0]) < 1e-9
    assert out.where("abs(a - a_back) > 1e-9").count() == 0
    assert [r["variance"] for r in var.orderBy("pc").collect()] == sorted((r["variance"] for r in var.collect()), reverse=True)


def test_logit_matches_newton(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(800, 2))
    y = (rng.random(800) < 1 / (1 + np.exp(-(0.4 + x @ [1.0, -0.7])))).astype(int)
    df = spark.createDataFrame([(float(a), float(b), int(v)) for (a, b), v in zip(x, y)] + [(None, 1.0, 0)], "a double, b double, y int")
    m = TR.Logit(df, "y", ["a", "b"])
    e, w = np.column_stack([np.ones(800), x]), np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-e @ w))
        h = e.T @ (e * (p * (1 - p))[:, None])
        w = w + np.linalg.solve(h, e.T @ (y - p))
    assert np.allclose(m.coef, w, atol=1e-5) and np.allclose(m.covariance(), np.linalg.inv(h), atol=1e-5)
    assert np.allclose(m.se, np.sqrt(np.diag(np.linalg.inv(h))), atol=1e-5)
    assert m.fit_eval()["lr_p"] < 1e-6
    assert TR.stepwise(df, "y", ["a", "b"], "backward") == ["a", "b"]


def test_chi_square_tail():
    assert abs(TR.chi2_upper(3.841458820694124, 1) - 0.05) < 1e-9
    assert abs(TR.chi2_upper(5.991464547107979, 2) - 0.05) < 1e-9
    assert abs(TR.chi2_upper(7.814727903251179, 3) - 0.05) < 1e-9


def test_tree_growth_and_pruning(spark):
    df = spark.range(400).select((F.col("id") % 40).cast("double").alias("x"), F.when(F.col("id") % 40 < 20, 1.0).otherwise(9.0).alias("y"))
    nodes = M.reg_tree(df, ["x"], "y", 2).collect()
    root = next(r for r in nodes if r["node"] == "")
    assert root["value"] == 19.0 and {r["mean"] for r in nodes if len(r["node"]) == 1} == {1.0, 9.0}
    assert df.withColumn("p", M.predict_tree(df, nodes, ["x"])).where("p <> y").count() == 0
    flat = spark.createDataFrame([(5.0, 5.0), (30.0, 5.0)], "x double, y double")
    assert [r["node"] for r in M.prune(nodes, flat, ["x"], "y")] == [""]


def test_id3_splits_on_the_informative_column(spark):
    df = spark.createDataFrame([("a", "m", 1), ("a", "n", 1), ("b", "m", 0), ("b", "n", 0)], "u string, v string, y int")
    tree = {r["node"]: r["column"] for r in M.id3(df, ["u", "v"], "y", 2).collect()}
    assert tree == {"": "u", "/u=a": None, "/u=b": None}


def test_tree_bins_find_the_step(spark):
    df = spark.range(1000).select(F.col("id").alias("x"), (F.col("id") > 500).cast("int").alias("y"))
    cuts = TR.tree_bins(df, "x", "y")
    assert len(cuts) == 1 and abs(cuts[0] - 500) < 5


def test_sweep_is_every_cell_of_the_whole_grid(spark):
    """The registered grid is the reference's; cells are near those of MLlib, which draws other samples and other bins.

    That they equal fits of their own is tested with the booster itself (test_models).
    """
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.regression import GBTRegressor

    from linkscore.catalog.training import DEPTHS, TREES

    assert (*TREES,) == (*range(5, 151),) and (*DEPTHS,) == (*range(4, 21),)
    df = spark.range(900).select("id", (F.col("id") * 37 % 101).cast("double").alias("x"), (F.col("id") * 13 % 7).cast("double").alias("z"))
    df = df.withColumn("y", F.col("x") * F.col("z") + F.col("x") % 5).cache()
    got = {(r.trees, r.depth): r.rmse for r in TR.sweep_gbt(df, ["x", "z"], "y", "id", [2, 3, 6], [2, 4]).collect()}
    assert len(got) == 6
    a, b = TR.split(TR.with_features(df, ["x", "z"], "y"), "id")
    for (n, depth), rmse in got.items():
        model = GBTRegressor(maxIter=n, maxDepth=depth, subsamplingRate=0.8, minInstancesPerNode=50, seed=11).fit(a.persist())
        assert RegressionEvaluator().evaluate(model.transform(b)) == pytest.approx(rmse, rel=0.05)


def test_bisecting_separates_blobs(spark):
    df = spark.createDataFrame([(float(c + i), 0.0) for c in (0, 100, 400) for i in range(10)], "x double, y double")
    assert sorted(round(c[0], 1) for c in M.bisecting(df, ["x", "y"], 3)) == [4.5, 104.5, 404.5]


def test_reduced_recommendation_matches_full_svd(spark):
    rng = np.random.default_rng(8)
    a = rng.integers(0, 6, size=(12, 7)).astype(float)
    df = spark.createDataFrame([(u, i, float(a[u, i])) for u in range(12) for i in range(7) if a[u, i]], "user_id long, item_id long, rating double")
    got = {(r["user_id"], r["item_id"]): r["predicted"] for r in S.recommend_reduced(df, 7, 4).collect()}
    v = np.linalg.svd(a)[2][:4].T
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    sim = 0.5 + 0.5 * unit @ unit.T
    for (u, i), p in got.items():
        rated = a[u] > 0
        assert not rated[i] and abs(p - (sim[i, rated] @ a[u, rated]) / sim[i, rated].sum()) < 1e-3


def test_naive_bayes_on_posts(spark):
    posts = [(0, "nice dog lovely help", 0), (1, "stupid worthless garbage", 1), (2, "lovely dog please", 0), (3, "stupid garbage quit", 1)]
    df = spark.createDataFrame(posts, "id long, text string, y int")
    occ = T.words(df, "id", "text", keep=("y",))
    model, priors = T.nb_fit(occ, df, "id", "y")
    new = spark.createDataFrame([(8, "lovely dog"), (9, "stupid garbage")], "id long, text string")
    got = {r["id"]: r["predicted"] for r in T.nb_predict(T.words(new, "id", "text"), model, priors, "id").collect()}
    assert got == {8: 0, 9: 1}


def test_undersample_is_balanced(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    assert {r[0]: r[1] for r in A.undersample(df, "y", "id").groupBy("y").count().collect()} == {0: 100, 1: 100}


def test_one_hot_drops_the_last_level(spark):
    df = spark.createDataFrame([(0,), (1,), (2,)], "i long")
    assert [list(r["onehot"]) for r in P.one_hot(df, "i", 3).orderBy("i").collect()] == [[1.0, 0.0], [0.0, 1.0], [0.0, 0.0]]


def test_windows():
    assert files.plan_windows() == [(0, -1)]
    assert files.plan_windows(partitions=3, rows=10) == [(0, 4), (4, 4), (8, 2)]
    assert files.plan_windows(batch=4, rows=9) == [(0, 4), (4, 4), (8, 1)]
    assert files.plan_windows(partitions=2, batch=5) == [(0, 5), (5, 5)]


def test_range_predicates_cover_everything(spark):
    df = spark.createDataFrame([(v,) for v in [None, -5, 0, 10, 11, 29, 30, 999]], "v int")
    clauses = jdbc.range_predicates("v", 0, 30, 3)
    assert sum(df.where(c).count() for c in clauses) == df.count()
    assert jdbc.options("jdbc:x:y", "t")["dbtable"] == "t"


def test_failed_append_is_reported(spark):
    assert jdbc.append_jdbc(spark.range(1), "jdbc:none://nowhere", "t") is False
    with pytest.raises(Exception):
        jdbc.append_jdbc(spark.range(1), "jdbc:none://nowhere", "t", on_error="raise")


def test_unknown_format_fails(spark, tmp_path):
    with pytest.raises(ValueError):
        files.load_files_to_table(spark, str(tmp_path), "x", "orc2")

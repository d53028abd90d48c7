"""Split groups must give the same rows as plain operations."""

import numpy as np
from pyspark.sql import functions as F

from linkscore.operators import graph as G
from linkscore.operators.aggregates import reduce_with_rejects
from linkscore.operators.knn import knn_join
from linkscore.ordered import number_rows, percentiles, running_sums
from linkscore.skew import blocked_pairs, salted_join


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def hot(spark, n=600):
    """A third of the rows share key 0."""
    return spark.range(n).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"))


def test_salted_join(spark):
    big = hot(spark)
    other = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    for how in ("inner", "left"):
        plain = big.join(other, "k", how).select("k", "id", "v")
        split = salted_join(big, other, ["k"], F.col("id"), how, rows_per_block=20).select("k", "id", "v")
        key = lambda r: tuple(-1 if x is None else x for x in r)
        assert sorted(plain.collect(), key=key) == sorted(split.collect(), key=key)


def test_blocked_pairs(spark):
    df = hot(spark, 150).select(F.col("k").alias("g"), F.col("id").alias("item"))
    a, b = df.select("g", F.col("item").alias("a")), df.select("g", F.col("item").alias("b"))
    plain = a.join(b, "g").where("a < b").select("g", "a", "b")
    got = blocked_pairs(df, "g", "item", rows_per_block=7).select("g", "item_a", "item_b")
    assert rows(plain) == rows(got)


def test_number_rows_with_ties(spark):
    df = hot(spark)
    got = number_rows(df, [F.col("k"), F.col("id")], "n").orderBy("n").collect()
    assert [r["n"] for r in got] == list(range(1, 601))
    assert [(r["k"], r["id"]) for r in got] == sorted((r["k"], r["id"]) for r in got)


def test_running_sums_over_groups(spark):
    df = hot(spark)
    got = {(r["k"], r["id"]): r["s"] for r in running_sums(df, [F.col("id")], {"s": "id"}, by=["k"]).collect()}
    total = {}
    for k, i in sorted(got):
        total[k] = total.get(k, 0) + i
        assert got[k, i] == total[k]


def test_percentiles_of_a_hot_group(spark):
    df = hot(spark).select("k", F.col("id").cast("double").alias("v"))
    got = {r["k"]: r["q"] for r in percentiles(df, "v", {"q": 0.37}, by=["k"]).collect()}
    values = {}
    for r in df.collect():
        values.setdefault(r["k"], []).append(r["v"])
    for k, v in values.items():
        assert abs(got[k] - np.quantile(v, 0.37)) < 1e-9


def test_reduce_with_rejects(spark):
    out = reduce_with_rejects(hot(spark), "k", ["id"])
    assert out.count() == 600 and out.where("kept").count() == hot(spark).select("k").distinct().count()


def brute(q, p, k, skip_self):
    out = []
    for i, v in q:
        d = sorted((float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum())), j) for j, w in p if not (skip_self and i == j))
        out += [(i, j) for _, j in d[:k]]
    return sorted(out)


def test_knn_join_is_exact_with_copies(spark):
    rng = np.random.default_rng(3)
    pts = [(i, [0.5, 0.5, 0.5] if i % 3 == 0 else rng.random(3).round(3).tolist()) for i in range(240)]
    df = spark.createDataFrame(pts, "id long, vec array<double>")
    got = sorted((r["query"], r["point"]) for r in knn_join(df, df, 4, exclude_self=True, n_pivots=7).collect())
    assert got == brute(pts, pts, 4, True)
    few = df.where("id < 30")
    got = sorted((r["query"], r["point"]) for r in knn_join(df, few, 3, n_pivots=5).collect())
    assert got == brute(pts, [p for p in pts if p[0] < 30], 3, False)


def test_knn_join_in_bands(spark, monkeypatch):
    import linkscore.operators.knn as K

    monkeypatch.setattr(K, "ROWS_PER_BAND", 5)
    rng = np.random.default_rng(4)
    pts = [(i, rng.random(12).tolist()) for i in range(150)]
    df = spark.createDataFrame(pts, "id long, vec array<double>")
    got = sorted((r["query"], r["point"]) for r in K.knn_join(df, df, 3, exclude_self=True, n_pivots=4).collect())
    assert got == brute(pts, pts, 3, True)


def test_knn_join_in_two_levels(spark, monkeypatch):
    """Crowded cells with pivots of their own, several bands, parts and blocks; one cell holds most points."""
    import linkscore.operators.knn as K

    for name, value in (("ROWS_PER_BAND", 6), ("LEAF_ROWS", 12), ("QUERY_BLOCK", 15), ("CELL_BLOCK", 40)):
        monkeypatch.setattr(K, name, value)
    rng = np.random.default_rng(5)
    pts = [(i, (rng.random(4) * (0.1 if i % 3 else 1)).round(3).tolist()) for i in range(200)]
    pts += [(1000 + i, [0.3, 0.3, 0.3, 0.3 + (i % 2) * 1e-3]) for i in range(40)]
    df = spark.createDataFrame(pts, "id long, vec array<double>")
    got = sorted((r["query"], r["point"]) for r in K.knn_join(df, df, 4, exclude_self=True, n_pivots=3).collect())
    assert got == brute(pts, pts, 4, True)
    both = df.withColumn("g", F.explode(F.array(F.lit(1), F.lit(2))))
    half = both.where("g = 1 OR id % 2 = 0")
    got = sorted((r["g"], r["query"], r["point"]) for r in K.knn_join(both, half, 2, on=["g"]).collect())
    want = [(1, q, p) for q, p in brute(pts, pts, 2, False)]
    want += [(2, q, p) for q, p in brute(pts, [p for p in pts if p[0] % 2 == 0], 2, False)]
    assert got == sorted(want)


def test_knn_rows_that_travel(spark, monkeypatch):
    """Ten times the points: they travel once for each block of visits to their band, never to all blocks."""
    import linkscore.operators.knn as K

    monkeypatch.setattr(K, "QUERY_BLOCK", 2_000)
    rng = np.random.default_rng(6)
    copies = {}
    for n in (3_000, 30_000):
        df = spark.createDataFrame([(i, rng.random(2).tolist()) for i in range(n)], "id long, vec array<double>").repartition(4)
        routes = K.Routes(df.withColumnRenamed("id", "rep"), df, 3)
        visits, points = routes.visits.count(), routes.points.count()
        assert points <= n + visits * 2 * K.ROWS_PER_BAND / K.QUERY_BLOCK
        copies[n] = points / n, visits / n
        assert points <= visits
    assert copies[30_000][0] < 10  # not the fifteen blocks that the queries make
    assert copies[30_000][1] < 30  # visits a query, of 30,000 / 1,000 bands and more


def test_knn_looks_closely_at_few_pairs(monkeypatch):
    """a matrix product leaves a few pairs for the exact distances; ties, copies and far points give the same rows."""
    import numpy as np
    import pandas as pd

    import linkscore.operators.knn as K

    rng = np.random.default_rng(6)
    points = np.vstack([rng.normal(size=(500, 16)), np.full((9, 16), 0.5), rng.integers(0, 2, size=(300, 16)) + 1e6]).astype(float)
    asked = np.vstack([points[::3], points[::50] + 0.1])
    d = np.sqrt(((asked[:, None, :] - points[None, :, :]) ** 2).sum(axis=2))
    near = np.argsort(d, axis=1, kind="stable")[:, :4]
    bounds = np.where(np.arange(len(asked)) % 2, 1e300, np.take_along_axis(d, near, 1)[:, 2])
    want = [(q, k, d[q, k]) for q in range(len(asked)) for k in near[q] if d[q, k] <= bounds[q]]
    looked = []
    plain = K._distances
    monkeypatch.setattr(K, "_distances", lambda a, b: looked.append(len(a)) or plain(a, b))
    left = pd.DataFrame({"rep": np.arange(len(asked)), "vec": list(asked), "bound": bounds})
    right = pd.DataFrame({"point": np.arange(len(points)), "_pvec": list(points)})
    got = K._nearest_of_block([], 4)(left, right.sample(frac=1, random_state=1))
    assert list(got.itertuples(index=False, name=None)) == want
    looked.clear()
    K._nearest_of_block([], 4)(left[:167], right[:500])
    assert sum(looked) < 10 * 167


def test_knn_without_points(spark):
    none = spark.createDataFrame([], "id long, vec array<double>")
    some = spark.createDataFrame([(1, [0.0, 1.0])], "id long, vec array<double>")
    assert knn_join(some, none, 3).count() == 0 and knn_join(none, some, 3).count() == 0
    assert knn_join(some, none, 3).columns == knn_join(some, some, 3).columns


def test_blocked_edges_send_everything(spark):
    star = spark.range(1, 200).select(F.lit(0).cast("long").alias("src"), F.col("id").alias("dst"))
    und = G.both_ways(star)
    split = G.blocked(und, rows_per_block=11)
    assert split.hot is not None
    state = G.vertices_of(star).select(F.col("id").alias("src"), (F.col("id") + 1).alias("v"))
    assert rows(split.send(state).select("src", "dst", "v")) == rows(und.join(state, "src").select("src", "dst", "v"))

"""Many bins, many levels, windows and ranges of external results, stepwise models: against plain versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkscore.operators import binning as B
from linkscore.operators import prepare as P
from linkscore.operators import train as T
from linkscore.sources import external as X
from linkscore.sources import files


def plain_bin(v, bins):
    return 0 if v is None else max((b for b, lo, hi in bins if lo <= v <= hi), default=0)


@pytest.mark.parametrize("tree", [500, 3])
def test_bins_overlap_touch_and_leave_gaps(spark, monkeypatch, tree):
    monkeypatch.setattr(B, "TREE_BINS", tree)
    monkeypatch.setattr(B, "BUCKETS", 4)
    rng = random.Random(4)
    bins = [(1, 0.0, 2.0), (2, 2.0, 3.0), (3, 5.0, 5.0), (4, 1.0, 9.0), (5, 2.5, 2.75), (6, 20.0, 19.0), (7, 11.0, 12.0), (8, 12.0, 14.0), (9, 13.0, 13.0)]
    bins += [(10 + i, float(x), x + rng.choice([0.0, 0.5, 3.0])) for i, x in enumerate(rng.sample(range(30, 90), 25))]
    values = [None, float("nan"), -1.0, 200.0, *[i / 4 for i in range(-2, 400)]]
    table = spark.createDataFrame(bins, "bin int, lower double, upper double")
    rows = spark.createDataFrame(list(enumerate(values)), "id int, v double")
    got = {r.id: r.v_BIN for r in B.apply_bins(rows, "v", table).collect()}
    assert got == {i: plain_bin(v, bins) for i, v in enumerate(values)}


@pytest.mark.parametrize("bins", [[], [(4, 1.0, 1.0)]])
def test_hardly_any_bins(spark, bins):
    table = spark.createDataFrame(bins, "bin int, lower double, upper double")
    rows = spark.createDataFrame([(1, 1.0), (2, 1.5), (3, None)], "id int, v double")
    assert {r.id: r.b for r in B.apply_bins(rows, "v", table, "b").collect()} == {1: 4 if bins else 0, 2: 0, 3: 0}


def test_a_million_levels(spark):
    """Levels are rows of a table, so a million of them are neither columns nor a list on the driver."""
    df = spark.range(1_000_000).select("id", F.format_string("v%07d", 999_999 - F.col("id")).alias("v"), (F.col("id") % 3).cast("string").alias("w"))
    out, codes = P.dummy_vectors(df, ["v", "w"], drop={"w": "1"})
    assert codes.count() == 1_000_002
    assert out.columns == ["id", "dummies"]
    d = F.col("dummies")
    wrong = out.where((d["size"] != 1_000_002) | (d["indices"][0] != 999_999 - F.col("id")) | (F.size(d["values"]) != F.when(F.col("id") % 3 == 1, 1).otherwise(2)))
    assert wrong.count() == 0
    assert out.where("id % 3 = 2").select(F.min(d["indices"][1])).first()[0] == 1_000_001


def test_dummy_vectors_of_little(spark):
    df = spark.createDataFrame([(1, None, "b"), (2, "a", None)], "id int, x string, y string")
    out, _ = P.dummy_vectors(df, ["x", "y"])
    assert {r.id: (r.dummies["size"], r.dummies["indices"]) for r in out.collect()} == {1: (2, [1]), 2: (2, [0])}
    none, codes = P.dummy_vectors(df.limit(0), ["x"])
    assert none.count() == 0 and codes.count() == 0


@pytest.fixture(scope="module")
def pages(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('pages')}/rows"
    spark.range(0, 1000, 1, 4).select("id", (F.col("id") * 2).alias("v")).write.option("parquet.block.size", 600).parquet(path)
    return spark.read.parquet(path)


def test_external_windows(spark, pages):
    """Every window is a task; windows cross files, and the last takes what is left."""
    fetch = X.parquet_windows(pages, pages.columns)
    assert sum(n for _, n in fetch.files) == 1000
    for windows in (files.plan_windows(7, rows=1000), files.plan_windows(3, batch=50), [(0, -1)], [(990, 100), (1000, 5)]):
        got = X.read_external_windows(spark, fetch, pages.schema, windows)
        assert got.rdd.getNumPartitions() == len(windows)
        assert got.select("window", F.spark_partition_id().alias("p")).distinct().count() <= len(windows)
        rows = {(r.window, r.id) for r in got.collect()}
        assert rows == {(w, i) for w, (skip, limit) in enumerate(windows) for i in range(1000)[skip : None if limit < 0 else skip + limit]}
    assert X.read_external_windows(spark, fetch, pages.schema, []).count() == 0


def test_a_window_reads_only_its_share():
    read = []

    class Spy(X.ParquetWindows):
        def __call__(self, skip, limit):
            for batch in super().__call__(skip, limit):
                read.append(batch.num_rows)
                yield batch

    fetch = Spy([("/root/testdata/sf0.01/events.parquet", 10_000)], ["event_id"])
    got = [i for b in fetch(2_000, 1_500) for i in b["event_id"].to_pylist()]
    assert len(got) == 1_500 == sum(read)


def test_external_ranges(spark, pages):
    with_null = pages.unionByName(spark.createDataFrame([(None, 5)], "id long, v long"))
    path = pages.inputFiles()[0].rsplit("/", 1)[0] + "-null"
    with_null.write.mode("overwrite").parquet(path)
    table = spark.read.parquet(path)
    got = X.read_external_ranges(spark, X.parquet_ranges(table, "id", table.columns), table.schema, 100, 500, 4)
    assert got.rdd.getNumPartitions() == 4
    counts = {r.part: r["count"] for r in got.groupBy("part").count().collect()}
    assert counts == {0: 201, 1: 100, 2: 100, 3: 600}
    assert X.range_bounds(5, 6, 8) == [(None, None)]


def logistic(x, t):
    z = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-z @ b))
        b += np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z, z.T @ (t - p))
    eta = z @ b
    se = np.sqrt(np.diag(np.linalg.inv((z * (p * (1 - p))[:, None]).T @ z)))
    return b, se, -2 * (t * eta - np.logaddexp(0, eta)).sum()


def test_stepwise_against_fits_one_by_one(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 5))
    t = (rng.random(600) < 1 / (1 + np.exp(-(1.5 * x[:, 2] - 0.8 * x[:, 0] + 0.4 * x[:, 4])))).astype(int)
    names = ["a", "b", "c", "d", "e"]
    df = spark.createDataFrame([(int(y), *map(float, r)) for y, r in zip(t, x)], "y int, " + ", ".join(f"{n} double" for n in names))
    df = df.unionByName(spark.createDataFrame([(1, None, 1.0, 1.0, 1.0, 1.0)], df.schema))
    fits = T.fit_side_by_side(df.dropna(), "y", [["a"], ["c", "e"], []])
    for (coef, _, deviance), at in zip(fits, ([0], [2, 4], [])):
        b, _, d = logistic(x[:, at], t)
        assert np.allclose(coef, b, atol=1e-7) and deviance == pytest.approx(d)
    chosen, left = [], list(range(5))
    best = logistic(x[:, []], t)[2]
    while left:
        deviance, j = min((logistic(x[:, [*chosen, j]], t)[2], j) for j in left)
        if deviance >= best:
            break
        best = deviance
        chosen.append(j)
        left.remove(j)
    assert T.stepwise(df, "y", names) == [names[j] for j in chosen]
    kept = list(range(5))
    while kept:
        b, se, _ = logistic(x[:, kept], t)
        z, j = min((abs(v / s), j) for v, s, j in zip(b[1:], se[1:], kept))
        if T._upper_normal(z) <= 0.05:
            break
        kept.remove(j)
    assert T.stepwise(df, "y", names, "backward") == [names[j] for j in kept]

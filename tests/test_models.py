"""Boosted sweeps, reduced recommendations and stepwise models against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkscore.operators import aggregates, boosting, linear, prepare, similarity, train


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 3)).round(2)
    y = ((x[:, 0] * x[:, 1] + rng.normal(size=1500) * 0.4) > 0).astype(int)
    rows = [(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))]
    rows += [(5000, None, 1.0, None, 1), (5001, 0.5, 0.5, 0.5, None)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y int").cache()


TRAIN = "id % 5 < 3"


def cells(df):
    return {(r.trees, r.depth): (r.rmse, r.auc) for r in df.collect()}


def test_sweep_cells_equal_single_fits(table):
    xs = ["a", "b", "c"]
    grid = cells(boosting.sweep(table, xs, "y", "id", F.expr(TRAIN), [2, 5, 7], [1, 3, 6]))
    assert len(grid) == 9
    for trees, depth in ((2, 1), (5, 3), (7, 6)):
        assert cells(boosting.sweep(table, xs, "y", "id", F.expr(TRAIN), [trees], [depth])) == {(trees, depth): grid[trees, depth]}
    assert min(r for r, _ in grid.values()) < 0.45 and max(a for _, a in grid.values()) > 0.8


def test_sweep_in_shared_passes(table, monkeypatch):
    """Rows beyond the bound stay where they are, and the same trees grow."""
    xs = ["a", "b", "c"]
    want = cells(boosting.sweep(table, xs, "y", "id", F.expr(TRAIN), [1, 2, 3], [1, 3]))
    monkeypatch.setattr(boosting, "MAX_CELLS", 10)
    monkeypatch.setattr(boosting, "STRIDE", 2)
    got = cells(boosting.sweep(table, xs, "y", "id", F.expr(TRAIN), [1, 2, 3], [1, 3]))
    assert got.keys() == want.keys()
    for cell, (rmse, auc) in want.items():
        assert got[cell] == (pytest.approx(rmse, abs=1e-9), pytest.approx(auc, abs=1e-9))


def test_tree_against_exhaustive_search():
    rng = np.random.default_rng(3)
    bins = rng.integers(0, 6, (300, 2))
    y = (bins[:, 0] > 2) * 1.0 + (bins[:, 1] > 3) * 0.5 + rng.normal(size=300) * 0.1
    tree, leaf = boosting.grow(bins, np.ones(300), y, 2, 6, 10)

    def search(rows, depth):
        best = None
        for f in range(2):
            for c in range(5):
                left, right = rows[bins[rows, f] <= c], rows[bins[rows, f] > c]
                if len(left) >= 10 and len(right) >= 10:
                    gain = round(y[rows].var() * len(rows) - y[left].var() * len(left) - y[right].var() * len(right), 9)
                    if gain > 0 and (best is None or gain > best[0]):
                        best = gain, left, right
        if depth == 0 or best is None:
            return {int(r): y[rows].mean() for r in rows}
        return {**search(best[1], depth - 1), **search(best[2], depth - 1)}

    want = search(np.arange(300), 2)
    assert np.allclose(np.array(tree.value)[leaf], [want[i] for i in range(300)])
    assert np.allclose(tree.predict(bins), np.array(tree.value)[leaf])


def test_area_counts_ties_half():
    score, y = np.array([0.1, 0.5, 0.5, 0.9]), np.array([0, 1, 0, 1.0])
    pairs = [(a > b) + (a == b) / 2 for a, p in zip(score, y) for b, q in zip(score, y) if p == 1 and q == 0]
    assert boosting.area(score, y, 1 - y) == pytest.approx(np.mean(pairs))
    assert boosting.area(score, y * 0, 1 - y) is None


def test_sweep_without_rows_or_signal(spark, table):
    none = boosting.sweep(table.limit(0), ["a"], "y", "id", F.expr(TRAIN), [1], [2])
    assert none.count() == 0
    flat = table.where("y IS NOT NULL").withColumn("y", F.lit(1))
    (cell,) = boosting.sweep(flat, ["a"], "y", "id", F.expr(TRAIN), [3], [2]).collect()
    assert cell.rmse == pytest.approx(0) and cell.auc is None


@pytest.fixture(scope="module")
def ratings():
    rng = np.random.default_rng(9)
    left, right = rng.random((60, 3)), rng.random((25, 3))
    grid = (left @ right.T * 3 + rng.random((60, 25))).round(1)
    grid[rng.random(grid.shape) < 0.6] = 0
    return grid


def plain_reduced(grid, n, rank):
    v = np.linalg.svd(grid, full_matrices=False)[2][:rank].T
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    sims = 0.5 + 0.5 * unit @ unit.T
    return plain_best(grid, n, lambda u, i, own: (sims[i, own] @ grid[u, own]) / sims[i, own].sum())


def plain_best(grid, n, predict):
    out = []
    for u in range(len(grid)):
        own = np.flatnonzero(grid[u])
        scored = [(-round(predict(u, i, own), 9), i) for i in range(grid.shape[1]) if grid[u, i] == 0 and len(own)]
        out += [(u, i, k + 1, round(-p, 6)) for k, (p, i) in enumerate(sorted(scored)[:n])]
    return sorted(out)


@pytest.mark.parametrize(("users", "items"), [(500, 4000), (7, 4)])
def test_reduced_recommendations_against_dense_svd(spark, monkeypatch, ratings, users, items):
    monkeypatch.setattr(similarity, "BLOCK_USERS", users)
    monkeypatch.setattr(similarity, "TILE_ITEMS", items)
    rows = [(u, i, float(ratings[u, i])) for u, i in zip(*map(np.ndarray.tolist, np.nonzero(ratings)))]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating double")
    got = similarity.recommend_reduced(df, 4, 3).collect()
    want = plain_reduced(ratings, 4, 3)
    got = sorted((r.user_id, r.item_id, r.rank, r.predicted) for r in got)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want], atol=1e-5)


def test_reduced_recommendations_in_small_parts(spark, monkeypatch, ratings):
    """ratings travel packed by user, not as rows; parts, chunks, pieces and cells of any size give the same."""
    rows = [(u, i, float(ratings[u, i])) for u, i in zip(*map(np.ndarray.tolist, np.nonzero(ratings)))]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating double")
    for name, value in {"PART_RATINGS": 150, "CHUNK_RATINGS": 20, "WIDE_USERS": 11, "WIDE_ITEMS": 9, "PIECE_USERS": 4, "PIECE_ITEMS": 3, "SAMPLE_ITEMS": 5, "CELLS": 4}.items():
        monkeypatch.setattr(similarity, name, value)
    plan = similarity.PackedRatings(df).image(df.select("item_id").distinct().withColumn("x", F.array(F.lit(1.0))), "x", 1)
    assert "hashpartitioning(user_id" not in plan._jdf.queryExecution().executedPlan().toString()
    assert {r.item_id: r.image[0] for r in plan.collect()} == pytest.approx(dict(enumerate(ratings.T @ ratings.sum(axis=1))))
    got = sorted((r.user_id, r.item_id, r.rank, r.predicted) for r in similarity.recommend_reduced(df, 4, 3).collect())
    want = plain_reduced(ratings, 4, 3)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want], atol=1e-5)


def test_tile_leaves_out_only_what_cannot_be_best():
    """predictions of whole cells are ruled out, with ties and rated items, and the rows are those of all predictions."""
    rng = np.random.default_rng(4)
    unit = rng.normal(size=(3000, 3)) * 0.3 + np.array([1, 0, 0])
    unit[::7] = unit[3]
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    tile = similarity._Tile(np.arange(3000), unit)
    row, own = np.repeat(np.arange(40), 25), rng.integers(0, 3000, 1000)
    stars = rng.integers(1, 6, 1000).astype(float)
    total, count = np.bincount(row, stars), np.bincount(row) * 1.0
    r, u = np.add.reduceat(unit[own] * stars[:, None], np.arange(0, 1000, 25)), np.add.reduceat(unit[own], np.arange(0, 1000, 25))
    p = np.round((total[:, None] + r @ unit.T) / (count[:, None] + u @ unit.T), 9)
    p[row, own] = -np.inf
    want = {(a, b) for a in range(40) for b in np.argsort(-p[a], kind="stable")[:3]}
    at, items, _ = tile.best(total, count, r, u, row, own, 3)
    assert set(zip(at.tolist(), items.tolist())) == want


def test_reduced_recommendations_of_little(spark):
    schema = "user_id long, item_id long, rating double"
    assert similarity.recommend_reduced(spark.createDataFrame([], schema)).count() == 0
    one = spark.createDataFrame([(1, 1, 2.0), (1, 2, 3.0), (2, 1, 1.0)], schema)
    assert [(r.user_id, r.item_id) for r in similarity.recommend_reduced(one).collect()] == [(2, 2)]


def test_recommendations_in_tiles(spark, monkeypatch, ratings):
    """Blocks and tiles of any size give the same; a hot item has no more rows than others."""
    rows = [(u, i, float(ratings[u, i])) for u, i in zip(*map(np.ndarray.tolist, np.nonzero(ratings)))]
    rows = [r for r in rows if r[1]] + [(u, 0, 1.0) for u in range(60)]  # all have rated item 0
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating double")
    key = lambda r: (r.user_id, r.rank, r.item_id, round(r.predicted, 9))
    want = sorted(map(key, similarity.recommend(df, 3).collect()))
    for name, value in (("BLOCK_USERS", 9), ("TILE_ITEMS", 5), ("TILE_LINKS", 90)):
        monkeypatch.setattr(similarity, name, value)
    assert sorted(map(key, similarity.recommend(df, 3).collect())) == want


def test_similar_items_are_not_copied_for_few_users(spark, monkeypatch, ratings):
    """similar items travel once for each block of ratings, as lists, not once for some users."""
    copies, plain = [], similarity._every
    monkeypatch.setattr(similarity, "_every", lambda n: copies.append(n) or plain(n))
    monkeypatch.setattr(similarity, "BLOCK_USERS", 9)
    rows = [(u, i, float(ratings[u, i])) for u, i in zip(*map(np.ndarray.tolist, np.nonzero(ratings)))]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating double")
    key = lambda r: (r.user_id, r.rank, r.item_id, round(r.predicted, 9))
    want = sorted(map(key, similarity.recommend(df, 3).collect()))
    assert min(copies) == 1
    monkeypatch.setattr(similarity, "BLOCK_RATINGS", 50)
    monkeypatch.setattr(similarity, "PIECE_CELLS", 30)
    assert sorted(map(key, similarity.recommend(df, 3).collect())) == want


def test_balanced_training_keeps_both_classes_for_the_test(spark):
    """With one positive in twenty, the sample's smallest draws must not all go to the fit."""
    rng = np.random.default_rng(5)
    y = (np.arange(4000) % 20 == 0).astype(int)
    x = rng.normal(size=4000) + y
    df = spark.createDataFrame([(i, float(a), int(t)) for i, (a, t) in enumerate(zip(x, y))], "id long, x double, y int")
    model, auc = train.train_balanced(df, ["x"], "y", "id")
    assert 0.6 < auc < 0.95
    taken = aggregates.undersample(df, "y", "id")
    held = train.scores(model, train.split(taken, "id", 0.7, 12)[1], ["x"]).select("score", "y").toPandas()
    pos, neg = held.score[held.y == 1].to_numpy(), held.score[held.y == 0].to_numpy()
    wins = (pos[:, None] > neg).sum() + (pos[:, None] == neg).sum() / 2
    assert auc == pytest.approx(wins / len(pos) / len(neg), abs=1e-12)


def test_folds_by_key_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(8)
    rows = [(i, float(a), float(2 * a + e)) for i, (a, e) in enumerate(rng.normal(size=(600, 2)))]
    df = spark.createDataFrame(rows, "id long, x double, t double")
    once = [tuple(r) for r in train.linear_cv(df, ["x"], "t", "ridge", [0.01, 1.0], key="id").collect()]
    again = [tuple(r) for r in train.linear_cv(df.repartition(7, "x"), ["x"], "t", "ridge", [0.01, 1.0], key="id").collect()]
    assert [a for a, _ in once] == [0.01, 1.0] == [a for a, _ in again]
    assert [e for _, e in once] == pytest.approx([e for _, e in again], abs=1e-9)


def test_directions_have_a_sign(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 3)) * [3.0, 2.0, 1.0] @ np.linalg.qr(rng.normal(size=(3, 3)))[0]
    want = np.linalg.eigh(np.cov(x.T))[1][:, ::-1]
    want = want * np.sign(want[np.abs(want).argmax(axis=0), range(3)])
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    scores = np.array(linear.pca_project(df, ["a", "b", "c"], 2)[0].select("pc1", "pc2").collect())
    assert np.allclose(scores, (x - x.mean(axis=0)) @ want[:, :2], atol=1e-9)
    vectors = prepare.assemble(df, ["a", "b", "c"], "v")
    found = np.array([r["pca"].toArray() for r in prepare.pca(vectors, "v", 2).select("pca").collect()])
    assert np.allclose(found, x @ want[:, :2], atol=1e-9)

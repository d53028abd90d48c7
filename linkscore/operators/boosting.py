"""Boosted regression trees on a binned table, a whole grid of tree counts and depths at once.

Features are cut into at most ``bins`` bins once. A tree sees only bins, so a level of
it needs one histogram a node: rows and residuals by feature and bin. A boosted model
of many trees holds those of fewer, hence one chain of trees per depth gives all cells
of the grid, and the chains of all depths share their passes.

Rows with equal bins are never told apart, but for the trees' samples and the target,
and these enter as sums. Where no more than ``MAX_CELLS`` different rows of bins exist,
the table is summed up to them first and every chain is grown in a task of its own.
Beyond, rows stay where they are: each level of all chains is one pass that sums
histograms by node, and only splits reach the driver. Both ways grow the same trees.
"""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkscore.ordered import running_sums
from linkscore.runtime import discard, stored

MAX_CELLS = 32_768  # different rows of bins that one task grows a chain over, at most about 80 MB
STRIDE = 10  # trees after which shared passes write the rows' predictions anew
PRIME = (1 << 31) - 1
RESULT = "trees int, depth int, rmse double, auc double, cpu_seconds double"


@dataclass(frozen=True)
class Boosting:
    """Settings of the training job. The first tree has weight 1, the others ``rate``."""

    trees: int = 150
    least: int = 50  # rows of a leaf
    sample: float = 0.8  # of the rows, drawn anew for each tree
    rate: float = 0.1
    bins: int = 32
    seed: int = 11

    def draws(self) -> np.ndarray:
        """Two numbers a tree: row ``d`` is drawn where ``(d * a + b) mod PRIME`` is below the sample's share."""
        return np.random.default_rng(self.seed).integers(1, PRIME, (self.trees, 2))

    def weight(self, tree: int) -> float:
        return 1.0 if tree == 0 else self.rate


@dataclass
class Tree:
    """Nodes in the order of their making; the right child follows the left one."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, values: tuple[float, float]) -> None:
        self.feature[node], self.cut[node], self.left[node] = feature, cut, len(self.value)
        for value in values:
            self.feature.append(-1)
            self.cut.append(0)
            self.left.append(0)
            self.value.append(value)

    def step(self, bins: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Where rows at these nodes go next; those at leaves stay."""
        feature, cut, left = (np.array(x)[node] for x in (self.feature, self.cut, self.left))
        inner = feature >= 0
        right = bins[np.arange(len(bins)), np.maximum(feature, 0)] > cut
        return np.where(inner, left + right, node)

    def predict(self, bins: np.ndarray) -> np.ndarray:
        node = np.zeros(len(bins), np.int64)
        while True:
            new = self.step(bins, node)
            if (new == node).all():
                return np.array(self.value)[node]
            node = new


def histograms(bins: np.ndarray, slot: np.ndarray, n: np.ndarray, s: np.ndarray, n_slots: int, n_bins: int) -> np.ndarray:
    """Rows and sums of the target by slot, feature and bin; slot -1 counts nowhere."""
    keep = slot >= 0
    width = bins.shape[1]
    at = ((slot[keep, None] * width + np.arange(width)) * n_bins + bins[keep]).ravel()
    size = n_slots * width * n_bins
    both = [np.bincount(at, np.repeat(x[keep], width), size).reshape(n_slots, width, n_bins) for x in (n, s)]
    return np.stack(both, 1)


def best_splits(hists: np.ndarray, least: int) -> list[tuple[float, float, int, int, float, float]]:
    """By slot: rows, their mean, feature (-1: none), last bin of the left side, means of both sides.

    The split with the largest fall of variance; of equal ones the first feature and
    the lowest cut. Gains are compared after rounding, so that the order of summing
    does not decide.
    """
    n, s = np.cumsum(hists[:, 0], 2), np.cumsum(hists[:, 1], 2)
    all_n, all_s = n[:, :1, -1:], s[:, :1, -1:]
    rest_n, rest_s = all_n - n, all_s - s
    fits = (n >= least) & (rest_n >= least)
    with np.errstate(divide="ignore", invalid="ignore"):
        means = np.where(n > 0, s / n, 0), np.where(rest_n > 0, rest_s / rest_n, 0)
        whole = np.where(all_n > 0, all_s / all_n, 0)
        gain = np.where(fits, n * (means[0] - whole) ** 2 + rest_n * (means[1] - whole) ** 2, 0) / np.maximum(all_n, 1)
    gain = np.where(gain > 1e-14, np.round(gain / np.maximum(gain.max((1, 2), keepdims=True), 1e-300), 9), 0)
    flat = gain.reshape(len(hists), -1).argmax(1)
    feature, cut = flat // hists.shape[3], flat % hists.shape[3]
    out = []
    for i, (f, c) in enumerate(zip(feature.tolist(), cut.tolist())):
        found = gain[i, f, c] > 0
        out.append((float(all_n[i, 0, 0]), float(whole[i, 0, 0]), f if found else -1, c, float(means[0][i, f, c]), float(means[1][i, f, c])))
    return out


def grow(bins: np.ndarray, n: np.ndarray, s: np.ndarray, depth: int, n_bins: int, least: int) -> tuple[Tree, np.ndarray]:
    """A tree on rows that stand for ``n`` with sum ``s`` of the target, and every row's leaf."""
    tree, node = Tree(), np.zeros(len(bins), np.int64)
    frontier = [0]
    for level in range(depth + 1):
        slots = np.full(len(tree.value), -1)
        slots[frontier] = np.arange(len(frontier))
        found = best_splits(histograms(bins, slots[node], n, s, len(frontier), n_bins), least)
        if level == 0:
            tree.value[0] = found[0][1]
        made = []
        for at, (_, _, feature, cut, *values) in zip(frontier, found):
            if feature >= 0 and level < depth:
                made += [len(tree.value), len(tree.value) + 1]
                tree.split(at, feature, cut, tuple(values))
        if not made:
            return tree, node
        node = tree.step(bins, node)
        frontier = made
    return tree, node


def area(score: np.ndarray, positive: np.ndarray, negative: np.ndarray) -> float | None:
    """Area under the ROC curve of scores that stand for so many rows of either class; ties count half."""
    order = np.argsort(score, kind="stable")
    score, positive, negative = score[order], positive[order], negative[order]
    head = np.flatnonzero(np.concatenate([[True], score[1:] != score[:-1]]))
    p, q = np.add.reduceat(positive, head), np.add.reduceat(negative, head)
    if not p.sum() or not q.sum():
        return None
    return float((p * (np.cumsum(q) - q / 2)).sum() / (p.sum() * q.sum()))


def _chain(settings: Boosting, trees: list[int], binary: bool):
    """Arrow function for the cells of one depth: all trees of its chain, and the errors after each asked-for one."""

    def work(key: tuple, table: pa.Table) -> pa.Table:
        begun, depth = time.process_time(), key[0].as_py()
        table = table.sort_by([("id", "ascending")])
        stack = lambda c: np.array(table[c].to_pylist(), float)
        bins, n, s = stack("bins").astype(np.int64), stack("n"), stack("s")
        test_n, test_y, test_yy = (table[c].to_numpy() for c in ("test_n", "test_y", "test_yy"))
        score, out = np.zeros(len(bins)), []
        for t in range(max(trees)):
            target = s[:, t] if t == 0 else 2 * (s[:, t] - n[:, t] * score)  # the loss is the square of the error
            tree, leaf = grow(bins, n[:, t], target, depth, settings.bins, settings.least)
            score = score + settings.weight(t) * np.array(tree.value)[leaf]
            if t + 1 in wanted:
                square = (test_yy - 2 * score * test_y + score**2 * test_n).sum()
                rmse = float(np.sqrt(max(0.0, square) / test_n.sum())) if test_n.sum() else None
                out.append((t + 1, depth, rmse, area(score, test_y, test_n - test_y) if binary else None, time.process_time() - begun))
        kinds = pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64()
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=[c.split()[0] for c in RESULT.split(", ")])

    wanted = set(trees)
    return work


def _binned(df: DataFrame, xs: Sequence[str], y: str, key: str, train: Column, settings: Boosting) -> DataFrame:
    """Stored rows ``bins, draw, y, test``; missing features are 0, borders are quantiles of the training rows."""
    values = {f"x{i}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for i, c in enumerate(xs)}
    rows = df.select(F.pmod(F.xxhash64(key), F.lit(PRIME)).alias("draw"), F.col(y).cast("double").alias("y"), (~train).alias("test"), *[c.alias(x) for x, c in values.items()])
    rows = stored(rows.where("y IS NOT NULL AND test IS NOT NULL"), "rows")
    shares = [i / settings.bins for i in range(1, settings.bins)]
    borders = rows.where("NOT test").approxQuantile(list(values), shares, 0.001)

    def bin_of(x: str, own: list[float]) -> Column:
        return F.size(F.filter(F.array(*[F.lit(b) for b in sorted(set(own))]).cast("array<double>"), lambda b: b < F.col(x)))

    bins = [bin_of(x, own) for x, own in zip(values, borders)]
    return stored(rows.select(F.array(*bins).alias("bins"), "draw", "y", "test"), "bins")


def _cells(rows: DataFrame, settings: Boosting) -> DataFrame:
    """Sums by different row of bins: ``n, s`` by tree over the tree's sample, ``test_n, test_y, test_yy``."""
    draws = settings.draws()
    a, b = (F.get(F.lit(draws[:, i].tolist()), F.col("t")) for i in (0, 1))
    drawn = F.pmod(F.col("draw") * a + b, F.lit(PRIME)) < int(settings.sample * PRIME)
    by_tree = rows.where("NOT test").withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(settings.trees - 1)))).where(drawn)
    sums = by_tree.groupBy("bins", "t").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"))
    by_cell = sums.groupBy("bins").agg(F.map_from_entries(F.collect_list(F.struct("t", F.struct("n", "s")))).alias("sums"))
    test = rows.where("test").groupBy("bins").agg(F.count(F.lit(1)).alias("test_n"), F.sum("y").alias("test_y"), F.sum(F.col("y") * F.col("y")).alias("test_yy"))
    every = F.sequence(F.lit(0), F.lit(settings.trees - 1))
    column = lambda c: F.transform(every, lambda t: F.coalesce(F.try_element_at("sums", t)[c].cast("double"), F.lit(0.0))).alias(c)
    both = by_cell.join(test, "bins", "full").select("bins", column("n"), column("s"), *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in ("test_n", "test_y", "test_yy")])
    return both.withColumn("id", F.xxhash64("bins"))


def sweep(
    df: DataFrame, xs: Sequence[str], y: str, key: str, train: Column, trees: Sequence[int], depths: Sequence[int], settings: Boosting | None = None
) -> DataFrame:
    """``trees, depth, rmse, auc, cpu_seconds``: every cell of the grid, trained where ``train`` holds and measured on the rest.

    A cell is what a fit of that many trees and that depth alone would give.
    ``cpu_seconds`` is the time that growing and measuring the chain took up to that
    cell, null where chains shared their passes; ``auc`` is null unless the target is
    0 or 1 and both occur. Rows without target or ``train`` are left out; no training
    rows give a model that predicts 0.
    """
    settings = settings or Boosting(trees=max(trees))
    trees, depths = sorted(set(trees)), sorted(set(depths))
    rows = _binned(df, xs, y, key, train, settings)
    binary = not rows.where("y NOT IN (0, 1)").limit(1).count()
    if rows.select("bins").distinct().count() > MAX_CELLS:
        return _shared(rows, len(xs), trees, depths, settings, binary)
    every = F.explode(F.lit(depths)).alias("depth")
    return stored(_cells(rows, settings).select("*", every).groupBy("depth").applyInArrow(_chain(settings, trees, binary), RESULT), "sweep")


# --- rows beyond MAX_CELLS: chains share their passes ---------------------


def _arrays(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bins = batch["bins"].flatten().to_numpy().astype(np.int64).reshape(-1, width)
    return bins, batch["draw"].to_numpy(), batch["y"].to_numpy()


def _scored(batch: pa.RecordBatch, bins: np.ndarray, chains: int, grown: list[tuple[float, list[Tree]]]) -> np.ndarray:
    """Predictions by row and chain: those written, and the trees grown since."""
    score = batch["score"].flatten().to_numpy().reshape(-1, chains).copy()
    for weight, trees in grown:
        for chain, tree in enumerate(trees):
            score[:, chain] += weight * tree.predict(bins)
    return score


def _level(settings: Boosting, width: int, t: int, grown: list, growing: list[Tree], frontiers: list[list[int]]):
    """Arrow function: a task's histograms of all open nodes, ``chain, node, hist``."""
    a, b = settings.draws()[t].tolist()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            bins, draw, y = _arrays(batch, width)
            drawn = (draw * a + b) % PRIME < int(settings.sample * PRIME)
            score = _scored(batch, bins, len(growing), grown)[drawn]
            bins, y = bins[drawn], y[drawn]
            for chain, frontier in enumerate(frontiers):
                if frontier:
                    tree, node = growing[chain], np.zeros(len(bins), np.int64)
                    while (new := tree.step(bins, node)).tolist() != node.tolist():
                        node = new
                    slots = np.full(len(tree.value), -1)
                    slots[frontier] = np.arange(len(frontier))
                    target = y if t == 0 else 2 * (y - score[:, chain])
                    hist = histograms(bins, slots[node], np.ones(len(y)), target, len(frontier), settings.bins)
                    sums[chain] = sums.get(chain, 0) + hist
        found = [(chain, node, hist.tobytes()) for chain, hists in sums.items() for node, hist in zip(frontiers[chain], hists)]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), (pa.int32(), pa.int32(), pa.binary()))], names=["chain", "node", "hist"])

    return work


SPLIT = "chain int, node int, n double, mean double, feature int, cut int, left double, right double"


def _splits(settings: Boosting, width: int):
    def work(key: tuple, table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x).reshape(1, 2, width, settings.bins) for x in table["hist"].to_pylist()]
        row = (key[0].as_py(), key[1].as_py(), *best_splits(np.sum(parts, axis=0), settings.least)[0])
        kinds = pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int32(), pa.int32(), pa.float64(), pa.float64()
        return pa.Table.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=[c.split()[0] for c in SPLIT.split(", ")])

    return work


def _errors(settings: Boosting, width: int, chains: int, first: int, grown: list, wanted: set[int]):
    """Arrow function: predictions for the test rows after each asked-for tree of the stride."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, _, y = _arrays(batch, width)
            score = _scored(batch, bins, chains, [])
            for i, (weight, trees) in enumerate(grown):
                for chain, tree in enumerate(trees):
                    score[:, chain] += weight * tree.predict(bins)
                if first + i + 1 in wanted:
                    columns = np.full(len(y) * chains, first + i + 1), np.tile(np.arange(chains), len(y)), score.ravel(), np.repeat(y, chains)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["trees", "chain", "score", "y"])

    return work


def _advanced(width: int, chains: int, grown: list):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, _, _ = _arrays(batch, width)
            score = pa.array(_scored(batch, bins, chains, grown).tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], score], names=batch.schema.names)

    return work


def _shared(rows: DataFrame, width: int, trees: list[int], depths: list[int], settings: Boosting, binary: bool) -> DataFrame:
    chains, wanted = len(depths), set(trees)
    state = rows.withColumn("score", F.array_repeat(F.lit(0.0), chains))
    grown: list[tuple[float, list[Tree]]] = []  # since ``state`` was written
    found = None
    for t in range(max(trees)):
        growing, frontiers = [Tree() for _ in depths], [[0] for _ in depths]
        for level in range(max(depths) + 1):
            open_nodes = [f if level <= d else [] for f, d in zip(frontiers, depths)]
            if not any(open_nodes):
                break
            hists = state.where("NOT test").mapInArrow(_level(settings, width, t, grown, growing, open_nodes), "chain int, node int, hist binary")
            frontiers = [[] for _ in depths]
            # a row for each open node, no more than the training rows over ``least``
            for r in sorted(hists.groupBy("chain", "node").applyInArrow(_splits(settings, width), SPLIT).collect()):
                tree = growing[r.chain]
                if level == 0:
                    tree.value[0] = r.mean
                if r.feature >= 0 and level < depths[r.chain]:
                    frontiers[r.chain] += [len(tree.value), len(tree.value) + 1]
                    tree.split(r.node, r.feature, r.cut, (r.left, r.right))
        grown = [*grown, (settings.weight(t), growing)]
        if len(grown) == STRIDE or t + 1 == max(trees):
            scores = state.where("test").mapInArrow(_errors(settings, width, chains, t + 1 - len(grown), grown, wanted), "trees long, chain long, score double, y double")
            errors = _measured(scores, binary)
            found = errors if found is None else found.unionByName(errors)
            old, state = state, stored(state.mapInArrow(_advanced(width, chains, grown), state.schema), "scores")
            discard(old)  # measured already; the binned table of the first stride stays
            grown = []
    depth = F.get(F.lit(depths), F.col("chain").cast("int")).alias("depth")
    return found.select(F.col("trees").cast("int").alias("trees"), depth, "rmse", "auc", F.lit(None).cast("double").alias("cpu_seconds"))


def _measured(scores: DataFrame, binary: bool) -> DataFrame:
    """``trees, chain, rmse, auc``; equal scores are counted before they are ordered."""
    square = F.sum((F.col("y") - F.col("score")) * (F.col("y") - F.col("score")))
    counts = scores.groupBy("trees", "chain", "score").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos"), square.alias("square"))
    counts = stored(counts.withColumn("neg", F.col("n") - F.col("pos")), "counts")
    below = running_sums(counts, [F.col("score")], {"upto": "neg"}, ["trees", "chain"])
    ranked = F.sum(F.col("pos") * (F.col("upto") - F.col("neg") / 2))
    auc = F.try_divide(ranked, F.sum("pos") * F.sum("neg")) if binary else F.lit(None).cast("double")
    return stored(below.groupBy("trees", "chain").agg(F.sqrt(F.sum("square") / F.sum("n")).alias("rmse"), auc.alias("auc")), "errors")

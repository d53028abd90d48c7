"""Near-duplicate vectors through an inverted multi-index.

Unit vectors are cut into halves with a codebook each; a pair of codewords is a cell
of the product grid, and every vector lies in the cell of its nearest codewords. A
vector looks for its neighbours in its own cell and in the cells that the
multi-sequence order brings next: pairs of codewords by rising sum of their squared
distances beyond the borders of the vector's own codewords. It stops where a
neighbour at the threshold lies further on with a chance of less than
``1 - target``; that border is measured on the sample which the codebooks are
learnt from. All pairs that meet are verified by their cosine in double precision.

Equal vectors are one node. Vectors that meet in a cell beyond ``BLOCK`` are cut into
blocks whose pairs are verified in tasks of their own; such a task returns sums of
links and a root by vector, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkscore.llm.components import components
from linkscore.runtime import stored

THRESHOLD = 0.98
TARGET = 0.999  # share of the neighbours at the threshold whose cell is to be visited
SAMPLE = 8_192  # vectors that codebooks are learnt from and borders measured on
CELL_ROWS = 256  # of the largest label, on average
MAX_WORDS = 1_024  # of a codebook
ROUNDS = 12
BLOCK = 1_024  # vectors of one side of a verification
SEED = 11


def units(vectors: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of length 1, in double precision."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    rows = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    rows = rows / np.abs(rows).max(axis=1, initial=0.0, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _squares(rows: np.ndarray, words: np.ndarray) -> np.ndarray:
    return (rows**2).sum(1)[:, None] + (words**2).sum(1) - 2 * rows @ words.T


def _codebook(rows: np.ndarray, n_words: int, rng: np.random.Generator) -> np.ndarray:
    words = rows[rng.choice(len(rows), n_words, replace=False)]
    for _ in range(ROUNDS):
        near = _squares(rows, words).argmin(1)
        size = np.bincount(near, minlength=n_words)
        sums = np.zeros_like(words)
        np.add.at(sums, near, rows)
        words = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], words)
    return words


def _leaders(rows: np.ndarray, threshold: float) -> np.ndarray:
    """Rows that no earlier one is linked with: a crowd of near copies gets one codeword, not many."""
    keep = np.ones(len(rows), bool)
    for start in range(0, len(rows), BLOCK):
        stop = start + BLOCK
        near = rows[start:stop] @ rows[:stop].T >= threshold
        near &= np.arange(start, start + len(near))[:, None] > np.arange(near.shape[1])
        keep[start:stop] = ~near.any(1)
    return rows[keep]


@dataclass
class Grid:
    """Codebooks of both halves, and how far beyond the own cell neighbours are sought."""

    words: tuple[np.ndarray, np.ndarray]
    border: float = 0.0

    def _beyond(self, rows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """By half: the nearest word, and to each word's cell the squared distance (at least, by the plane between the two)."""
        out, at = [], self.words[0].shape[1]
        for half, words in ((rows[:, :at], self.words[0]), (rows[:, at:], self.words[1])):
            square = _squares(half, words)
            near = square.argmin(1)
            apart = np.sqrt(np.maximum(_squares(words, words), 0))[near]
            plane = (square - square.min(1, keepdims=True)) / np.maximum(2 * apart, 1e-12)
            plane[np.arange(len(rows)), near] = 0
            out.append((near, plane**2))
        return out

    def cells(self, rows: np.ndarray) -> np.ndarray:
        (a, _), (b, _) = self._beyond(rows)
        return a * len(self.words[1]) + b

    def distance(self, rows: np.ndarray, others: np.ndarray) -> np.ndarray:
        """How far beyond a row's own cell the cell of its partner begins."""
        (_, x), (_, y) = self._beyond(rows)
        (a, _), (b, _) = self._beyond(others)
        i = np.arange(len(rows))
        return x[i, a] + y[i, b]

    def visits(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and cell of each visit up to the border.

        Both halves are sorted; the cells that multi-sequence traversal reaches are
        the pairs under a staircase, which is walked for all rows at once.
        """
        (_, x), (_, y) = self._beyond(rows)
        order_x, order_y = x.argsort(1, kind="stable"), y.argsort(1, kind="stable")
        x, y = np.take_along_axis(x, order_x, 1), np.take_along_axis(y, order_y, 1)
        row, cell = [], []
        for i in range(x.shape[1]):
            left = np.flatnonzero(x[:, i] <= self.border)
            if not len(left):
                break
            own, j = np.nonzero(x[left, i, None] + y[left] <= self.border)
            row.append(left[own])
            cell.append(order_x[left[own], i] * len(self.words[1]) + order_y[left[own], j])
        return np.concatenate(row), np.concatenate(cell)


def learn_grid(sample: np.ndarray, n_words: int, threshold: float = THRESHOLD, target: float = TARGET) -> Grid:
    """Codebooks of ``sample`` (unit rows), and the border within which ``target`` of all neighbours are found.

    The neighbours are the sample's rows turned in a random direction until their
    cosine is the threshold, the furthest that links reach.
    """
    rng = np.random.default_rng(SEED)
    at = sample.shape[1] // 2
    n_words = min(n_words, len(sample))
    grid = Grid((_codebook(sample[:, :at], n_words, rng), _codebook(sample[:, at:], n_words, rng)))
    turn = rng.normal(size=sample.shape)
    turn -= (turn * sample).sum(1, keepdims=True) * sample
    size = np.linalg.norm(turn, axis=1, keepdims=True)
    turn = np.where(size > 1e-9, turn / np.maximum(size, 1e-9), 0)
    if n_words > 1:
        apart = grid.distance(sample, threshold * sample + np.sqrt(1 - threshold**2) * turn)
        grid.border = float(np.quantile(apart, target, method="higher"))
    return grid


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _place(grids: dict[int, Grid]):
    """Own cell first, then the visited cells of a higher number: a pair meets in the higher of its cells."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                table = batch.slice(start, BLOCK)
                dims = table["dim"].to_numpy()
                cells: list[list[int]] = [[0]] * table.num_rows
                for dim in np.unique(dims).tolist():
                    if (grid := grids.get(dim)) is None:
                        continue
                    at = np.flatnonzero(dims == dim)
                    rows = units(table["embedding"].take(pa.array(at)))
                    own = grid.cells(rows)
                    row, cell = grid.visits(rows)
                    further = cell > own[row]
                    for i, c in zip(at.tolist(), own.tolist()):
                        cells[i] = [c]
                    for i, c in zip(at[row[further]].tolist(), cell[further].tolist()):
                        cells[i].append(c)
                yield pa.RecordBatch.from_arrays([*table.columns, pa.array(cells, pa.list_(pa.int32()))], names=[*table.schema.names, "cells"])

    return work


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest number that the links ``i, j`` connect each of ``n`` to."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _verify(threshold: float):
    def work(key: tuple, table: pa.Table) -> pa.Table:
        a, b = key[3].as_py(), key[4].as_py()
        table = table.sort_by("node")
        rows = units(table["embedding"])
        node, copies, own, block = (table[c].to_numpy() for c in ("node", "copies", "own", "block"))
        left, right = np.flatnonzero(block == a), np.flatnonzero(block == b)
        links, found = np.zeros(len(node), np.int64), []
        for start in range(0, len(left), 256):
            some = left[start : start + 256]
            hit = (rows[some] @ rows[right].T >= threshold) & (own[some][:, None] | own[right])
            if a == b:
                hit &= some[:, None] < right
            x, y = np.nonzero(hit)
            x, y = some[x], right[y]
            links += np.bincount(x, copies[y], len(node)).astype(np.int64) + np.bincount(y, copies[x], len(node)).astype(np.int64)
            # a forest of what is linked so far stands for the links
            i = np.concatenate([x, *[f[0] for f in found]])
            j = np.concatenate([y, *[f[1] for f in found]])
            root = _roots(len(node), i, j)
            found = [(np.flatnonzero(root != np.arange(len(node))), root[root != np.arange(len(node))])]
        root = np.arange(len(node))
        for i, r in found:
            root[i] = r
        keep = links > 0
        return pa.Table.from_arrays([pa.array(node[keep]), pa.array(links[keep]), pa.array(node[root[keep]])], names=["node", "links", "root"])

    return work


def grids_of(nodes: DataFrame, threshold: float = THRESHOLD, target: float = TARGET) -> dict[int, Grid]:
    """A grid by length of the vectors, learnt from about ``SAMPLE`` of all different ones.

    Codebooks grow with the root of the largest label's vectors. Lengths that the
    sample lacks have no grid: their vectors all meet in one cell, in blocks.
    """
    n, most = nodes.groupBy("label", "dim").count().agg(F.sum("count"), F.max("count")).first()
    n_words = min(MAX_WORDS, int(np.ceil(np.sqrt((most or 0) / CELL_ROWS))))
    if n_words < 2:
        return {}
    share = min(1.0, SAMPLE / n)
    drawn = nodes.select("dim", "embedding", F.xxhash64(F.lit(SEED), "key_a").alias("draw"))
    drawn = drawn.where(F.pmod("draw", F.lit(1 << 40)) < int(share * (1 << 40))).toArrow().sort_by("draw")
    out = {}
    for dim in np.unique(drawn["dim"].to_numpy()).tolist():
        sample = units(drawn.filter(pc.equal(drawn["dim"], dim))["embedding"])
        out[dim] = learn_grid(_leaders(sample, threshold), n_words, threshold, target)
    return out


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, target: float = TARGET) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors`` (``vec_id, embedding, label``).

    Rows of one label and length link when their cosine is at least ``threshold``.
    Null vectors, those that hold null, NaN or infinity, zero vectors and rows without
    a label link with nothing. Equal vectors link with each other, rows of one
    ``vec_id`` are rows of their own. ``component_id`` is the smallest ``vec_id`` that
    links reach (null where none of them has one), ``kept`` tells whether it is the
    row's own. Other columns do not count; no rows give none.
    """
    vector, label = F.col("embedding"), F.col("label").cast("string")
    rows = stored(
        vectors.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("vec_id").cast("long").alias("vec_id"),
            label.alias("label"),
            F.size("embedding").alias("dim"),
            vector.alias("embedding"),
            (_usable(vector) & label.isNotNull()).alias("usable"),
            F.xxhash64(label, vector).alias("key_a"),  # vectors are equal where both keys are
            F.xxhash64(F.lit(SEED), label, vector).alias("key_b"),
        ),
        "vectors",
    )
    usable = rows.where("usable")
    keys = usable.groupBy("key_a", "key_b").agg(F.min("row").alias("row"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
    nodes = stored(usable.drop("key_a", "key_b", "vec_id", "usable").join(keys, "row").withColumnRenamed("row", "node"), "nodes")
    seen = nodes.select("node", "label", "dim", "embedding", "copies")
    schema = seen.withColumn("cells", F.lit(None).cast("array<int>")).schema
    placed = stored(seen.mapInArrow(_place(grids_of(nodes, threshold, target)), schema), "cells")

    meet = F.explode("cells").alias("cell")
    blocks = placed.select("label", "dim", meet).groupBy("label", "dim", "cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    met = placed.select("*", meet).join(blocks, ["label", "dim", "cell"])
    block = F.pmod(F.xxhash64("node"), "blocks").cast("int")
    met = met.withColumns({"block": block, "own": F.col("cell") == F.col("cells")[0]}).drop("cells")
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b")
    met = met.select("label", "dim", "cell", *pair, "node", "copies", "own", "block", "embedding")
    found = stored(met.groupBy("label", "dim", "cell", "a", "b").applyInArrow(_verify(threshold), "node long, links long, root long"), "links")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = stored(components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))), "roots")
    own = nodes.select("node", "key_a", "key_b", "copies", "least").join(links, "node", "left").join(roots, "node", "left")
    own = own.withColumn("root", F.coalesce("root", "node"))
    least = own.groupBy("root").agg(F.min("least").alias("component_id"))
    told = own.join(least, "root").select(
        "key_a", "key_b", F.lit(True).alias("usable"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    out = rows.select("vec_id", "key_a", "key_b", "usable").join(told, ["key_a", "key_b", "usable"], "left")
    component = F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )

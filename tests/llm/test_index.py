"""Manifest, embedding index and lexical search against brute force."""

import heapq
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkscore.llm import lexical, merkle, multiindex
from tests.llm import cases

DOCS = cases.documents()
PROOF = "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, cases.SCHEMA).repartition(5).cache()


def rows(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("leaves", [1, 2, 16, 17, 33, 255, 256, 257, 300, 4096])
def test_positions_in_the_log(leaves):
    levels = merkle.height(leaves)
    level = [bytes([i % 256, i // 256]) * 16 for i in range(leaves)]
    log = merkle.append_nodes(level, levels)
    for nth in range(levels + 1):
        for i, digest in enumerate(level):
            at = 32 * merkle.position(nth, i, leaves, levels)
            assert log[at : at + 32] == digest
        level = [merkle.node_hash(b"".join(level[i : i + 16])) for i in range(0, len(level), 16)]


def test_manifest(docs):
    assert rows(merkle.manifest_proofs(docs), *PROOF) == cases.merkle(DOCS)


def test_manifest_clashing_names_and_none(spark, docs):
    odd = docs.withColumns({c: F.lit(1) for c in ("tree", "leaf", "digest", "ordinal", "total", "row", "pos", "path", "up")})
    assert rows(merkle.manifest_proofs(odd), *PROOF) == cases.merkle(DOCS)
    assert merkle.manifest_proofs(spark.createDataFrame([], cases.SCHEMA)).count() == 0


def test_manifest_of_several_tiers(spark):
    """A source larger than a builder, and more sources than a builder takes."""
    rng = random.Random(1)
    data = [(i, f"Text {i}", "en", rng.choice("abc") if i % 3 else "hot", None) for i in range(9000)]
    data += [(i, "X\n" * 3, "en", f"s{i}", 3) for i in range(9000, 13_200)] + [(5, "Same", None, "hot", 1)] * 40
    out = merkle.manifest_proofs(spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long"))
    assert rows(out, *PROOF) == cases.merkle(data)


ITEMS = [(1, DOCS[1][1][:90]), (2, "one two TWO"), (3, None), (4, ""), (5, "\n.;-"), (6, "nowhere-to_be found one"), (None, "one"), (2, "ONE two one"), (7, DOCS[9][1])]


@pytest.mark.parametrize(("block_bytes", "group_terms"), [(lexical.BLOCK_BYTES, lexical.GROUP_TERMS), (3_000, 40)])
def test_ranked_search(spark, docs, block_bytes, group_terms):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = rows(lexical.search(docs, items, 10, block_bytes, group_terms), "item_id", "rank", "doc_id", "score")
    assert got == cases.ranked(DOCS, ITEMS)


def test_ranked_search_clashing_names_and_none(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    odd = {c: F.lit(1) for c in ("query", "terms", "counts", "rank", "score", "n_docs", "term", "df")}
    got = rows(lexical.search(docs.withColumns(odd), items.withColumns(odd), 3), "item_id", "rank", "doc_id", "score")
    assert got == cases.ranked(DOCS, ITEMS, 3)
    assert lexical.search(spark.createDataFrame([], cases.SCHEMA), items).count() == 0
    assert lexical.search(docs, items.limit(0)).count() == 0


def test_accumulators_stop_and_stay_exact():
    rng = np.random.default_rng(4)
    stopped = 0
    for _ in range(200):
        n, k = int(rng.integers(1, 300)), int(rng.integers(1, 12))
        postings, most, total = [], [], np.zeros(n, np.int64)
        for weight in np.sort(rng.integers(0, 2000, 12))[::-1]:
            own = np.flatnonzero(rng.random(n) < rng.random())
            add = weight * rng.integers(1, 5, len(own))
            total[own] += add
            postings.append((own, add) if len(own) else None)
            most.append(int(add.max(initial=0)))
        got, created = lexical.accumulate(postings, most, n, k, 0)
        stopped += created < len(postings)
        best = np.sort(total)[::-1][min(k, n) - 1]
        assert (got[(total >= best) & (total > 0)] == total[(total >= best) & (total > 0)]).all()
        assert ((got == total) | (got == 0)).all()
    assert stopped > 20


VECTORS = "vec_id long, embedding array<float>, label int, copies int, cell int, node string"


def vectors(n=1500, dim=12, seed=3):
    rng = np.random.default_rng(seed)
    data = []
    for i in range(n):
        x = rng.normal(size=dim)
        if i % 3 == 0 and data:  # near others, and chains of them
            x = np.array(data[rng.integers(len(data))][1]) + rng.normal(size=dim) * rng.choice([0, 0.02, 0.1, 0.2])
        data.append((i, x.astype(np.float32).tolist(), int(rng.integers(0, 3)) if i % 5 else 0))
    base = rng.normal(size=dim)
    data += [(5000 + i, (base + rng.normal(size=dim) * 0.12).astype(np.float32).tolist(), 1) for i in range(150)]
    data += [(6000 + i, data[5][1], data[5][2]) for i in range(40)]
    odd = [None, [], [0.0] * dim, [1.0] * (dim - 1) + [None], [1.0] * (dim - 1) + [float("nan")], [float("inf")] * dim, [1.0, 2.0], [2.0, 4.0], [3.0], [-1.0], [7.0]]
    data += [(7000 + i, x, 1) for i, x in enumerate(odd)]
    data += [(8000, data[7][1], None), (None, data[7][1], data[7][2]), (None, base.tolist(), 2), data[9], data[9], (9, [5.0] * dim, 2)]
    return [(a, b if b is None else [x if x is None else float(np.float32(x)) for x in b], c) for a, b, c in data]


@pytest.mark.parametrize(("cell_rows", "block", "threshold"), [(multiindex.CELL_ROWS, multiindex.BLOCK, 0.98), (6, 40, 0.98), (6, 10_000, 0.9)])
def test_near_vectors(spark, monkeypatch, cell_rows, block, threshold):
    """With every cell visited that a neighbour can lie in, rows equal brute force; else nearly all do."""
    monkeypatch.setattr(multiindex, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(multiindex, "BLOCK", block)
    data = vectors()
    table = spark.createDataFrame([(*r, 1, 2, "x") for r in data], VECTORS).repartition(4)
    want = cases.near_vectors(data, threshold)
    assert rows(multiindex.near_vectors(table, threshold, 1.0), *RESULT) == want
    missed = want - rows(multiindex.near_vectors(table, threshold), *RESULT)
    assert sum(missed.values()) <= 0.02 * sum(want.values())


RESULT = "vec_id", "n_links", "component_id", "kept"


def test_near_vectors_none(spark):
    assert multiindex.near_vectors(spark.createDataFrame([], VECTORS)).count() == 0
    lone = spark.createDataFrame([(3, [1.0, 2.0], 1, 1, 1, "x")], VECTORS)
    assert rows(multiindex.near_vectors(lone), *RESULT) == {(3, 0, 3, True): 1}


def test_multi_sequence_order():
    """The staircase holds what popping cells by their sum reaches, and a border of all its pairs."""
    rng = np.random.default_rng(1)
    sample = rng.normal(size=(800, 16))
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    grid = multiindex.learn_grid(sample, 9, 0.9, 0.95)
    assert grid.border > 0
    row, cell = grid.visits(sample[:50])
    (_, x), (_, y) = grid._beyond(sample[:50])
    for i in range(50):
        a, b = np.sort(x[i]), np.sort(y[i])
        todo, reached = [(a[0] + b[0], 0, 0)], set()
        while todo:
            far, p, q = heapq.heappop(todo)
            if far > grid.border or (p, q) in reached:
                continue
            reached.add((p, q))
            todo_more = [(p + 1, q), (p, q + 1)]
            for u, v in todo_more:
                if u < len(a) and v < len(b):
                    heapq.heappush(todo, (a[u] + b[v], u, v))
        own = cell[row == i]
        assert len(own) == len(set(own.tolist())) == len(reached)
        assert grid.cells(sample[i : i + 1])[0] in own

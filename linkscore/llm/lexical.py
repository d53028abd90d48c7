"""Ranked lexical search: every document against a set of queries, term at a time.

The corpus becomes an inverted index in blocks of documents, a row per block, which
holds the postings of the queries' terms. Each block is searched by accumulators:
a query's terms come rarest first, every posting adds to its document's accumulator,
and new accumulators are only created while the largest scores that the remaining
terms could add up to may still reach the kth partial score. From then on the
survivors alone are updated, exactly. The kth score of the blocks that a task has
searched before counts as well. The best of all tasks are merged in the end.

Statistics (documents, their lengths, documents by term) cover the whole corpus and
are sums by block. Queries come in groups of at most ``GROUP_TERMS`` terms, each
searched in a pass of its own; a group is all that a task or the driver ever holds.
Terms are told apart by 64 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkscore.llm.batches import counted, new_powers, slices
from linkscore.llm.decontaminate import plain_words
from linkscore.runtime import stored

K = 10
B = 75  # weight of a document's length, in hundredths
BLOCK_BYTES = 8 << 20
GROUP_TERMS = 1_000_000  # terms of the queries of one pass, about 30 MB

QUERIES = "query long, item_id long, terms array<long>, counts array<long>"
#: ``term`` holds places in the vocabulary; ``docs[first[i]:first[i + 1]]`` are the rows with ``term[i]``.
BLOCK = (
    "doc_id array<long>, length array<long>, n_docs long, n_terms long, "
    "term array<int>, df array<long>, docs array<int>, tf array<long>"
)
HITS = "query long, item_id long, doc_id long, score long"


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = new_powers()
    for batch in batches:
        for table in slices(batch):
            words = plain_words(table, powers)
            terms, counts = [], []
            for a, b in zip(words.first, words.first[1:]):
                own, n = counted(words.hash[a:b].view(np.int64))
                terms.append(own.tolist())
                counts.append(n.tolist())
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (terms, counts)]
            yield pa.RecordBatch.from_arrays([*(table[c].combine_chunks() for c in ("query", "item_id")), *lists], names=["query", "item_id", "terms", "counts"])


class _Block:
    """Documents of one block and their postings, as they come in."""

    def __init__(self) -> None:
        self.ids: list[pa.Array] = []
        self.length: list[np.ndarray] = []
        self.term: list[np.ndarray] = []
        self.docs: list[np.ndarray] = []
        self.tf: list[np.ndarray] = []
        self.n_docs = self.n_bytes = 0

    def add(self, table: pa.Table, vocabulary: np.ndarray, powers) -> None:
        words = plain_words(table, powers)
        length = np.diff(words.first)
        place = np.minimum(np.searchsorted(vocabulary, words.hash), len(vocabulary) - 1)
        known = np.flatnonzero(vocabulary[place] == words.hash)
        text = np.searchsorted(words.first, known, "right") - 1
        number = np.cumsum(length > 0) - 1  # rows without terms are no documents
        keys, tf = counted(place[known] << 32 | number[text])
        self.term.append(keys >> 32)
        self.docs.append((keys & 0xFFFFFFFF) + self.n_docs)
        self.tf.append(tf)
        self.ids.append(table["doc_id"].combine_chunks().filter(pa.array(length > 0)))
        self.length.append(length[length > 0])
        self.n_docs += int((length > 0).sum())
        self.n_bytes += len(words.raw)

    def row(self) -> pa.RecordBatch:
        term, docs, tf, length = (np.concatenate(x) for x in (self.term, self.docs, self.tf, self.length))
        order = np.argsort(term, kind="stable")
        own, df = counted(term)
        whole = lambda x, t: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x.cast(t) if isinstance(x, pa.Array) else pa.array(x, t))
        n = pa.array([self.n_docs], pa.int64()), pa.array([int(length.sum())], pa.int64())
        long, short = pa.int64(), pa.int32()
        columns = [whole(pa.concat_arrays(self.ids), long), whole(length, long), *n, whole(own, short), whole(df, long), whole(docs[order], short), whole(tf[order], long)]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in BLOCK.split(", ")])


def index_blocks(docs: DataFrame, vocabulary: np.ndarray, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row (``BLOCK``) for about ``block_bytes`` of text: lengths of all documents, postings of the vocabulary (sorted hashes)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, block = new_powers(), _Block()
        for batch in batches:
            for table in slices(batch):
                block.add(table, vocabulary, powers)
                if block.n_bytes >= block_bytes:
                    yield block.row()
                    block = _Block()
        if block.n_docs:
            yield block.row()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(work, BLOCK)


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_factor(length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    top = int(length.max(initial=0)) * B * n_docs
    if top < 1 << 62:
        return 100 - B + length * (B * n_docs) // n_terms
    return np.array([100 - B + B * n * n_docs // n_terms for n in length.tolist()], np.int64)


@dataclass
class Query:
    number: int
    item_id: int | None
    terms: np.ndarray  # places in the vocabulary, rarest first
    weight: np.ndarray  # of each term, times its repeats in the query


def queries_of(rows: list, vocabulary: np.ndarray, df: np.ndarray, n_docs: int) -> list[Query]:
    out = []
    for r in rows:
        place = np.searchsorted(vocabulary, np.array(r["terms"], np.int64).view(np.uint64))
        found = np.flatnonzero(df[place] > 0)
        order = found[np.lexsort((place[found], df[place[found]]))]
        weight = [term_weight(n_docs, int(df[place[i]])) * r["counts"][i] for i in order]
        out.append(Query(r["query"], r["item_id"], place[order], np.array(weight, np.int64)))
    return out


def accumulate(postings: list[tuple[np.ndarray, np.ndarray] | None], most: list[int], n_docs: int, k: int, kth: int) -> tuple[np.ndarray, int]:
    """Accumulators of one query over one block, and how many terms could create them.

    ``postings`` has rows and scores by term, rarest first, ``most`` each term's
    largest score, ``kth`` the kth score known so far. Every document that could be
    among the k best, ties included, has its exact score.
    """
    scores = np.zeros(n_docs, np.int64)
    rest = sum(most)
    for nth, (own, bound) in enumerate(zip(postings, most)):
        if rest < kth:  # what is new from here on stays below k others
            for later in postings[nth:]:
                if later is not None:
                    docs, add = later
                    alive = scores[docs] > 0
                    scores[docs[alive]] += add[alive]
            return scores, nth
        rest -= bound
        if own is not None:
            scores[own[0]] += own[1]
            if n_docs >= k and rest < scores.max():
                kth = max(kth, int(np.partition(scores, n_docs - k)[n_docs - k]))
    return scores, len(postings)


class _Best:
    """The k best documents of a query among those offered; equal scores by id, none last."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    def kth(self) -> int:
        return self.rows[-1][0] if len(self.rows) == self.k else 0

    def offer(self, scores: np.ndarray, ids: pa.Array) -> None:
        found = np.flatnonzero(scores > max(0, self.kth() - 1))
        if len(found) > self.k:
            own = scores[found]
            found = found[own >= np.partition(own, len(own) - self.k)[len(own) - self.k]]
        if len(found):
            more = zip(scores[found].tolist(), ids.take(pa.array(found)).to_pylist())
            self.rows = sorted([*self.rows, *more], key=lambda r: (-r[0], r[1] is None, r[1] or 0))[: self.k]


def search_blocks(batches: Iterator[pa.RecordBatch], queries: list[Query], size: int, n_docs: int, n_terms: int, k: int) -> Iterator[pa.RecordBatch]:
    """The k best of a task's blocks for each query (``HITS``); ``size`` is that of the vocabulary."""
    best = [_Best(k) for _ in queries]
    for batch in batches:
        for i in range(batch.num_rows):
            block = {c: batch.column(c)[i].values for c in ("doc_id", "length", "term", "df", "docs", "tf")}
            length, term, df, docs, tf = (block[c].to_numpy() for c in ("length", "term", "df", "docs", "tf"))
            if not len(term):
                continue
            impact = 1_000_000_000 * tf // (1000 * tf + 8 * length_factor(length, n_docs, n_terms)[docs])
            first = np.concatenate([[0], np.cumsum(df)])
            largest = np.maximum.reduceat(impact, first[:-1])
            place = np.full(size, -1)
            place[term] = np.arange(len(term))
            for query, own in zip(queries, best):
                at = place[query.terms].tolist()
                weight = query.weight.tolist()
                postings = [(docs[first[t] : first[t + 1]], w * impact[first[t] : first[t + 1]]) if t >= 0 else None for t, w in zip(at, weight)]
                most = [int(largest[t]) * w if t >= 0 else 0 for t, w in zip(at, weight)]
                if sum(most) >= max(1, own.kth()):
                    own.offer(accumulate(postings, most, len(length), k, own.kth())[0], block["doc_id"])
    hits = [(q.number, q.item_id, doc, score) for q, own in zip(queries, best) for score, doc in own.rows]
    if hits:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*hits)], names=[c.split()[0] for c in HITS.split(", ")])


def search(docs: DataFrame, queries: DataFrame, k: int = K, block_bytes: int = BLOCK_BYTES, group_terms: int = GROUP_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best rows of ``docs`` for each row of ``queries`` (``item_id, text``).

    Scores are integers: a term's weight times its saturated frequency, lengths
    normalised; only scores above 0 count, equal ones ascend by ``doc_id`` (none
    last). Null texts and texts without a term hold nothing, as queries they find
    nothing. Rows are independent: repeated ids are documents, or queries, of their
    own. A text beyond ``block_bytes`` is a block alone. Without documents or
    queries there are no rows; other columns do not count.
    """
    spark = docs.sparkSession
    asked = queries.select(F.monotonically_increasing_id().alias("query"), F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    asked = stored(asked.mapInArrow(_query_terms, QUERIES).where("size(terms) > 0"), "queries")
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    n_groups = -(-int(total) // group_terms)
    hits = spark.createDataFrame([], HITS)
    for group in range(n_groups):
        rows = asked.where(F.pmod(F.xxhash64("query"), F.lit(n_groups)) == group).collect()
        if not rows:
            continue
        vocabulary = np.unique(np.concatenate([np.array(r["terms"], np.int64) for r in rows]).view(np.uint64))
        blocks = stored(index_blocks(docs, vocabulary, block_bytes), "index")
        n_docs, n_terms = blocks.agg(F.sum("n_docs"), F.sum("n_terms")).first()
        if not n_docs:
            continue
        df = np.zeros(len(vocabulary), np.int64)
        by_term = blocks.select(F.explode(F.arrays_zip("term", "df")).alias("x")).groupBy("x.term").agg(F.sum("x.df").alias("df"))
        found = by_term.toArrow()  # no more rows than the vocabulary has
        df[found["term"].to_numpy()] = found["df"].to_numpy()
        known = queries_of(rows, vocabulary, df, n_docs)
        size = len(vocabulary)

        def work(batches, known=known, size=size, n_docs=n_docs, n_terms=n_terms):
            yield from search_blocks(batches, known, size, n_docs, n_terms, k)

        hits = hits.unionByName(blocks.mapInArrow(work, HITS))
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")

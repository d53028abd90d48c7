"""Benchmark decontamination: BM25 over test items, every training passage as a query.

Test items are indexed as an inverted index with block maxima. Each document is
cut into overlapping passages; a passage is scored against the items in three
steps that only ever skip what cannot reach the threshold, as WAND does with
block maxima, here for all passages of a batch at once:

1. the sum of its terms' largest weights over all items,
2. for each block of items, the sum of their largest weights in that block,
3. the exact score of the items in the blocks that are left.

Scores are divided by the item's score against itself, so one threshold serves
items of all lengths. What is retrieved is checked: shingles of the item's
question and of its answer must both be found near the passage.

The index is broadcast in shards of bounded size. A benchmark beyond one shard
takes more passes over the documents, one shard at a time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkscore.llm.batches import Words, distinct, new_powers, run_index, slices, text_bytes
from linkscore.runtime import stored

K1, B = 1.2, 0.75
THRESHOLD = 0.5  # of an item's score against itself
OVERLAP = 0.5  # share of the question's and of the answer's shingles
SHINGLE = 3
BLOCK_ITEMS = 16
SHARD_POSTINGS = 1_000_000  # terms of the items in one broadcast index, about 30 MB

_PLAIN = np.full(256, 32, np.uint8)  # letters, digits and all beyond ASCII count; the rest parts words
_PLAIN[128:] = np.arange(128, 256)
for _c in b"0123456789abcdefghijklmnopqrstuvwxyz":
    _PLAIN[_c] = _c
_PLAIN[65:91] = np.arange(97, 123)


def plain_words(table: pa.Table, powers) -> Words:
    raw, offsets = text_bytes(table["text"])
    return Words(_PLAIN[raw], offsets, powers)


def question_words(text: str, n_words: int, before: int | None) -> int:
    """Words of an item that are its question: up to the last question mark if text follows, else three quarters."""
    if before is not None and 0 < before < n_words:
        return before
    return max(1, n_words - max(1, n_words // 4))


@dataclass
class Level:
    """Items of up to ``segment`` words, as postings by term and block."""

    segment: int
    items: np.ndarray  # index into the shard's items, by own number
    most: np.ndarray  # by term: largest weight
    block_at: np.ndarray  # by term: its blocks
    block: np.ndarray
    block_most: np.ndarray
    post_at: np.ndarray  # by entry of ``block``: its postings
    post_item: np.ndarray
    post_weight: np.ndarray


@dataclass
class Index:
    """A shard: vocabulary, items, and one ``Level`` per length class."""

    terms: np.ndarray  # sorted hashes
    ids: list[int]
    words: list[np.ndarray]
    split: list[int]
    levels: list[Level]


def build(rows: Sequence) -> Index:
    """Index of items given as ``item_id, words, split, terms, weights`` (weights relative to the own score)."""
    rows = sorted(rows, key=lambda r: (len(r["words"]), r["item_id"], r["words"]))
    words = [np.array(r["words"], np.int64).view(np.uint64) for r in rows]
    term = np.concatenate([np.array(r["terms"], np.int64).view(np.uint64) for r in rows]) if rows else np.zeros(0, np.uint64)
    weight = np.concatenate([np.array(r["weights"], np.float64) for r in rows]) if rows else np.zeros(0)
    item = np.repeat(np.arange(len(rows)), [len(r["terms"]) for r in rows])
    terms, term = np.unique(term, return_inverse=True)
    classes = np.array([max(8, 1 << (len(w) - 1).bit_length()) for w in words], np.int64)
    levels = []
    for segment in sorted(set(classes.tolist())):
        own = np.flatnonzero(classes == segment)
        number = np.full(len(rows), -1)
        number[own] = np.arange(len(own))
        chosen = number[item] >= 0
        t, i, w = term[chosen], number[item[chosen]], weight[chosen]
        order = np.lexsort((i, t))
        t, i, w = t[order], i[order], w[order]
        block = i // BLOCK_ITEMS
        head = np.flatnonzero(np.concatenate([[True], (t[1:] != t[:-1]) | (block[1:] != block[:-1])]))
        most = np.zeros(len(terms))
        np.maximum.at(most, t, w)
        levels.append(
            Level(
                segment, own, most, np.searchsorted(t[head], np.arange(len(terms) + 1)), block[head],
                np.maximum.reduceat(w, head), np.append(head, len(t)), i, w,
            )
        )
    return Index(terms, [r["item_id"] for r in rows], words, [r["split"] for r in rows], levels)


def _pairs(level: Level, group: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (group, term)."""
    both = distinct(group.astype(np.int64) << 32 | term)
    return both >> 32, both & 0xFFFFFFFF


def retrieve(level: Level, words: Words, term: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All (text, first word of the passage, item of the level, score) at or above the threshold.

    ``term`` is each word's number in the vocabulary, -1 if none. A passage is
    two neighbouring segments, so every stretch as long as an item lies whole in
    one; the last segment of a text forms a passage with the one before it.
    """
    size = level.segment
    count = np.diff(words.first)
    n_segments = -(-count // size)
    at = np.concatenate([[0], np.cumsum(n_segments)])
    known = np.flatnonzero(term >= 0)
    text_of = np.searchsorted(words.first, known, "right") - 1
    seg, t = _pairs(level, at[text_of] + (known - words.first[text_of]) // size, term[known])
    bound = np.bincount(seg, level.most[t], at[-1] + 1)
    # passage i: segments i and i + 1, or i alone where its text has but one
    last = np.zeros(at[-1] + 1, bool)
    last[at[1:][n_segments > 0] - 1] = True
    alone = np.zeros(at[-1] + 1, bool)
    alone[at[:-1][n_segments == 1]] = True
    top = bound[:-1] + np.where(last[:-1], 0, bound[1:])
    passage = np.flatnonzero((top >= threshold) & (~last[:-1] | alone[:-1]))
    none = np.zeros(0, np.int64)
    if not len(passage):
        return none, none, none, np.zeros(0)
    seg_at = np.searchsorted(seg, np.arange(at[-1] + 2))
    stop = np.where(last[passage], passage + 1, passage + 2)
    width = seg_at[stop] - seg_at[passage]
    which, t = _pairs(level, np.repeat(np.arange(len(passage)), width), t[run_index(seg_at[passage], width)])
    width = level.block_at[t + 1] - level.block_at[t]
    entry = run_index(level.block_at[t], width)
    which = np.repeat(which, width)
    n_blocks = -(-len(level.items) // BLOCK_ITEMS)
    cell = which * n_blocks + level.block[entry]
    cells, inverse = np.unique(cell, return_inverse=True)
    good = np.bincount(inverse, level.block_most[entry], len(cells)) >= threshold
    chosen = good[inverse]
    entry, which = entry[chosen], which[chosen]
    width = level.post_at[entry + 1] - level.post_at[entry]
    post = run_index(level.post_at[entry], width)
    cell = np.repeat(which, width) * len(level.items) + level.post_item[post]
    cells, inverse = np.unique(cell, return_inverse=True)
    score = np.bincount(inverse, level.post_weight[post], len(cells))
    hit = score >= threshold - 1e-9
    cells, score = cells[hit], score[hit]
    found = passage[cells // len(level.items)]
    text = np.searchsorted(at, found, "right") - 1
    return text, words.first[text] + (found - at[text]) * size, cells % len(level.items), score


def _shingles(words: np.ndarray) -> set[tuple[int, ...]]:
    own = words.tolist()
    n = min(SHINGLE, len(own))
    return {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()


def overlaps(item: np.ndarray, split: int, near: np.ndarray) -> tuple[float, float]:
    """Shares of the question's and the answer's shingles that occur in ``near``."""
    out = []
    for part in (item[:split], item[split:]):
        own = _shingles(part)
        n = min(SHINGLE, len(part))
        words = near.tolist()
        there = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
        out.append(len(own & there) / len(own) if own else 1.0)
    return out[0], out[1]


def matches(index: Index, table: pa.Table, powers, threshold: float, overlap: float) -> list[tuple[int, int, float, float, float]]:
    """Verified (text, item number, best score, question and answer overlap) of the texts of a piece."""
    words = plain_words(table, powers)
    place = np.minimum(np.searchsorted(index.terms, words.hash), max(len(index.terms) - 1, 0))
    term = np.where(index.terms[place] == words.hash, place, -1) if len(index.terms) else np.full(len(words.hash), -1)
    best: dict[tuple[int, int], tuple[float, float, float]] = {}
    for level in index.levels:
        for text, start, own, score in zip(*(x.tolist() for x in retrieve(level, words, term, threshold))):
            number = int(level.items[own])
            low = max(int(words.first[text]), start - level.segment)
            high = min(int(words.first[text + 1]), start + 3 * level.segment)
            question, answer = overlaps(index.words[number], index.split[number], words.hash[low:high])
            if question >= overlap and answer >= overlap:
                best[text, number] = max(best.get((text, number), (0.0, 0.0, 0.0)), (score, question, answer))
    return [(*key, *value) for key, value in sorted(best.items())]


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = new_powers()
    for batch in batches:
        for table in slices(batch):
            words = plain_words(table, powers)
            texts = table["text"].to_pylist()
            lists, splits = [], []
            for i, text in enumerate(texts):
                own = words.hash[words.first[i] : words.first[i + 1]].view(np.int64)
                mark = text.rfind("?")
                before = None
                if mark >= 0:
                    end = words.offsets[i] + len(text[: mark + 1].encode())
                    before = int((words.start[words.first[i] : words.first[i + 1]] < end).sum())
                lists.append(own)
                splits.append(question_words(text, len(own), before))
            yield pa.RecordBatch.from_arrays(
                [table["item_id"].cast(pa.int64()).combine_chunks(), pa.array([x.tolist() for x in lists], pa.list_(pa.int64())), pa.array(splits, pa.int64())],
                names=["item_id", "words", "split"],
            )


def index_shards(benchmark: DataFrame, shard_postings: int = SHARD_POSTINGS) -> Iterator[tuple[Index, bool]]:
    """The inverted index, shard by shard, and whether more follow; statistics over all items, computed by Spark.

    Items without id, text or words are left out; repeated rows count once. The next
    shard is built when it is asked for, so the driver holds one at a time if what
    was made with the last one has been written by then.
    """
    clean = benchmark.select("item_id", "text").where("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    items = stored(clean.mapInArrow(_item_words, "item_id long, words array<long>, split long").where("size(words) > 0"), "items")
    if items.isEmpty():
        return
    length = F.size("words")
    n, average, total = items.agg(F.count(F.lit(1)), F.avg(length), F.sum(F.size(F.array_distinct("words")))).first()
    terms = items.select("item_id", "words", length.alias("len"), F.explode("words").alias("term")).groupBy("item_id", "words", "len", "term").agg(F.count(F.lit(1)).alias("tf"))
    frequency = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(1 + (F.lit(float(n)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / float(average)))
    weighted = (
        terms.join(frequency, "term")
        .withColumn("weight", weight)
        .groupBy("item_id", "words")
        .agg(F.collect_list(F.struct("term", "weight")).alias("own"), F.sum("weight").alias("total"))
    )
    rows = items.join(weighted, ["item_id", "words"]).select(
        "item_id",
        "words",
        "split",
        F.col("own.term").alias("terms"),
        F.transform("own.weight", lambda w: w / F.col("total")).alias("weights"),
        F.pmod(F.xxhash64("item_id", "words"), F.lit(max(1, -(-int(total) // shard_postings)))).alias("shard"),
    )
    rows = stored(rows, "index")
    count = max(1, -(-int(total) // shard_postings))
    for s in range(count):
        yield build(rows.where(F.col("shard") == s).collect()), s + 1 < count  # each about shard_postings large


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap`` of every row and item found in it.

    Null and empty texts hold nothing; texts of any length are searched whole. Rows are independent: repeated ids give
    repeated rows, other columns are left out. No documents or no items give no
    rows.
    """
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    found = docs.sparkSession.createDataFrame([], schema)
    for index, more in index_shards(benchmark):

        def work(batches: Iterator[pa.RecordBatch], own: Index = index) -> Iterator[pa.RecordBatch]:
            powers = new_powers()
            for batch in batches:
                for table in slices(batch):
                    hits = matches(own, table, powers, threshold, overlap)
                    if hits:
                        text, item, *scores = zip(*hits)
                        ids = table["doc_id"].cast(pa.int64()).combine_chunks().take(pa.array(text))
                        yield pa.RecordBatch.from_arrays(
                            [ids, pa.array([own.ids[i] for i in item], pa.int64()), *[pa.array(x, pa.float64()) for x in scores]],
                            names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"],
                        )

        hits = docs.select("doc_id", "text").mapInArrow(work, schema)
        found = found.unionByName(stored(hits, "hits") if more else hits)
    return found


def decontaminate(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item; rules as in :func:`contaminated`."""
    for index, more in index_shards(benchmark):

        def work(batches: Iterator[pa.RecordBatch], own: Index = index) -> Iterator[pa.RecordBatch]:
            powers = new_powers()
            for batch in batches:
                for table in slices(batch):
                    clean = np.ones(table.num_rows, bool)
                    clean[[hit[0] for hit in matches(own, table, powers, threshold, overlap)]] = False
                    yield from table.filter(pa.array(clean)).to_batches()

        docs = docs.mapInArrow(work, docs.schema)
        docs = stored(docs, "clean") if more else docs
    return docs

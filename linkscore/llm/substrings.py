"""Removal of word spans that an earlier document holds, by suffix automata.

A span of at least ``window`` words is repeated if every window of it is. Windows
are dealt out by their minimiser, the smallest hash of the short word grams in
them: equal windows have equal minimisers, and consecutive windows that share
one travel as one run of words. Runs whose minimiser only one document holds are
dropped at once. A minimiser whose runs are all equal needs no search either.
The runs of the others go to shards; each shard builds a suffix automaton of its
runs in order of their documents and takes their matching statistics, which name
the first document of every window.

The corpus is its own reference here, so the automata are not broadcast: a shard
holds only runs whose minimisers belong to it, and the runs to be matched come
to it. A minimiser with very many runs is split further, by whole windows: equal
windows are merged with their first document on the way, so a passage that many
documents share between different neighbours comes to an automaton once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkscore.llm.batches import Words, mix, new_powers, run_index, slices, text_bytes
from linkscore.runtime import stored

WINDOW = 13
SEED = 5  # words of the grams that minimisers are taken from
BLOCK_BYTES = 8 << 20  # text of one group of documents
SHARD_RUNS = 4_000  # runs of one automaton
LAST = 2**63 - 1  # a missing doc_id: after all others


class Automaton:
    """Suffix automaton of word sequences, each state with the first document that has its words.

    Sequences are added in ascending order of their documents.
    """

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.first = [0]

    def add(self, words: Sequence[int], doc: int) -> None:
        nxt, link, length, first = self.next, self.link, self.length, self.first
        last = 0
        for w in words:
            q = nxt[last].get(w)
            if q is not None and length[q] == length[last] + 1:
                last = q
                continue
            if q is None:
                new = len(nxt)
                nxt.append({})
                link.append(0)
                length.append(length[last] + 1)
                first.append(doc)
                p = last
                while p >= 0 and w not in nxt[p]:
                    nxt[p][w] = new
                    p = link[p]
                last = new
                if p < 0:
                    continue
                q = nxt[p][w]
                if length[q] == length[p] + 1:
                    link[new] = q
                    continue
                link[new] = self._split(p, q, w)
            else:
                last = self._split(last, q, w)

    def _split(self, p: int, q: int, w: int) -> int:
        """A state for the shorter words of q that p leads to."""
        nxt, link = self.next, self.link
        twin = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        self.length.append(self.length[p] + 1)
        self.first.append(self.first[q])
        link[q] = twin
        while p >= 0 and nxt[p].get(w) == q:
            nxt[p][w] = twin
            p = link[p]
        return twin

    def firsts(self, words: Sequence[int], window: int) -> list[int]:
        """For each window of the words, the first document that has it (-1: none)."""
        nxt, link, length, first = self.next, self.link, self.length, self.first
        out, state, matched = [], 0, 0
        for i, w in enumerate(words):
            while state and w not in nxt[state]:
                state = link[state]
                matched = length[state]
            if w in nxt[state]:
                state = nxt[state][w]
                matched += 1
            while state and length[link[state]] >= window:
                state = link[state]
                matched = length[state]
            if i >= window - 1:
                out.append(first[state] if matched >= window else -1)
        return out


class Runs:
    """Maximal stretches of consecutive windows with one minimiser, in all texts of a piece.

    ``start`` and ``count`` of the windows (by number of their first word),
    ``doc`` the text, ``seed`` the minimiser, ``key`` a hash of the words.
    """

    def __init__(self, words: Words, window: int, seed: int):
        total = len(words.hash)
        count = np.maximum(np.diff(words.first) - (window - 1), 0)
        at = run_index(words.first[:-1], count)
        if not len(at):
            self.start = self.count = self.doc = np.zeros(0, np.int64)
            self.seed = self.key = np.zeros(0, np.uint64)
            return
        grams = np.zeros(total, np.uint64)
        grams[: total - seed + 1] = _gram(words.hash, seed)
        width = window - seed + 1
        reach = total - width + 1
        least, place = grams[:reach].copy(), np.arange(reach)
        for j in range(1, width):
            other = grams[j : j + reach]
            lower = other < least
            least[lower] = other[lower]
            place[lower] = np.flatnonzero(lower) + j
        place = place[at]
        new = np.concatenate([[True], (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)])
        head = np.flatnonzero(new)
        self.start = at[head]
        self.count = np.diff(np.append(head, len(at)))
        self.doc = np.searchsorted(words.first, self.start, "right") - 1
        self.seed = grams[place[head]]
        whole = _gram(words.hash, window)
        last = self.start + self.count - 1
        self.key = mix(mix(whole[self.start] + self.count.astype(np.uint64)) ^ whole[last])


def _gram(hashes: np.ndarray, n: int) -> np.ndarray:
    total = max(len(hashes) - n + 1, 0)
    key = np.zeros(total, np.uint64)
    for i in range(n):
        key *= np.uint64(0xD6E8FEB86659FD93)
        key += hashes[i : i + total]
    return mix(key)


def _rank(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(LAST))


def _batch(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns.values()], names=list(columns))


def _seed_rows(window: int, seed: int):
    """Arrow function: minimisers with the least and greatest document of a piece."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = new_powers()
        for batch in batches:
            for table in slices(batch):
                runs = Runs(Words(*text_bytes(table["text"]), powers), window, seed)
                doc = table["rank"].to_numpy()[runs.doc]
                order = np.argsort(runs.seed, kind="stable")
                key, doc = runs.seed[order].view(np.int64), doc[order]
                if len(key):
                    head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                    yield _batch({"seed": key[head], "low": np.minimum.reduceat(doc, head), "high": np.maximum.reduceat(doc, head)})

    return work


def _run_rows(window: int, seed: int):
    """Arrow function: every distinct run of each row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = new_powers()
        for batch in batches:
            for table in slices(batch):
                runs = Runs(Words(*text_bytes(table["text"]), powers), window, seed)
                # a text of one word over and over has the same run many times
                _, once = np.unique(mix(runs.doc.astype(np.uint64)) ^ runs.key, return_index=True)
                if len(once):
                    doc = runs.doc[once]
                    names = {c: table[c].to_numpy()[doc] for c in ("rank", "print")}
                    yield _batch({"seed": runs.seed[once].view(np.int64), "run": runs.key[once].view(np.int64), **names})

    return work


def _run_words(window: int, seed: int):
    """Arrow function for a block: the word hashes of the asked-for runs."""

    def work(rows: pa.Table, asked: pa.Table) -> pa.Table:
        powers = new_powers()
        wanted = np.unique(asked["run"].to_numpy())
        found: dict[str, list] = {"run": [], "seed": [], "words": []}
        met: set[int] = set()
        for table in slices(rows) if len(wanted) else ():
            words = Words(*text_bytes(table["text"]), powers)
            runs = Runs(words, window, seed)
            key = runs.key.view(np.int64)
            hit = np.flatnonzero(np.isin(key, wanted))
            for i in hit.tolist():
                k = int(key[i])
                if k not in met:
                    met.add(k)
                    a = runs.start[i]
                    found["run"].append(k)
                    found["seed"].append(int(runs.seed[i : i + 1].view(np.int64)[0]))
                    found["words"].append(words.hash[a : a + runs.count[i] + window - 1].tobytes())
        return pa.table(
            {"run": pa.array(found["run"], pa.int64()), "seed": pa.array(found["seed"], pa.int64()), "words": pa.array(found["words"], pa.binary())}
        )

    return work


def _dealt(window: int):
    """Arrow function: runs for the shards; those of a crowded minimiser as single windows, dealt out by their words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"shard": [], "part": [], "run": [], "at": [], "first": [], "words": []}
            for row in batch.to_pylist():
                words = np.frombuffer(row["words"], np.uint64)
                if row["parts"] == 1:
                    pieces = [(0, 0, row["words"])]
                else:
                    part = _gram(words, window) % np.uint64(row["parts"])
                    pieces = [(int(p) + 1, j, words[j : j + window].tobytes()) for j, p in enumerate(part)]
                for part, j, raw in pieces:
                    for name, value in (("shard", row["shard"] if part == 0 else row["seed"]), ("part", part), ("run", row["run"]), ("at", j), ("first", row["first"]), ("words", raw)):
                        out[name].append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[c], pa.binary() if c == "words" else pa.int64()) for c in out], names=list(out)
            )

    return work


def _match(window: int):
    """Arrow function for a shard: the first document of every window of its runs."""

    def work(table: pa.Table) -> pa.Table:
        first = table["first"].to_numpy()
        order = np.argsort(first, kind="stable")
        texts = [np.frombuffer(x, np.uint64).tolist() for x in table["words"].to_pylist()]
        automaton = Automaton()
        for i in order.tolist():
            automaton.add(texts[i], int(first[i]))
        found = [automaton.firsts(t, window) for t in texts]
        return pa.table({"run": table["run"], "at": table["at"], "firsts": pa.array(found, pa.list_(pa.int64()))})

    return work


def _name(rank: np.ndarray, print_: np.ndarray, run: np.ndarray) -> np.ndarray:
    """One number for a document and a run."""
    return mix(mix(rank) ^ print_ ^ run)


def _keep(window: int, seed: int):
    """Arrow function for a block: what is left of each text."""

    def work(rows: pa.Table, masks: pa.Table) -> pa.Table:
        powers = new_powers()
        name = _name(*(masks[c].to_numpy().view(np.uint64) for c in ("rank", "print", "run")))
        order = np.argsort(name)
        name, mask = name[order], masks["mask"].to_numpy()[order]
        ids, n_words, n_removed, texts = [], [], [], []
        for table in slices(rows):
            words = Words(*text_bytes(table["text"]), powers)
            runs = Runs(words, window, seed)
            gone = np.zeros(len(words.hash) + 1, np.int64)
            if len(name) and len(runs.start):
                own = _name(*(table[c].to_numpy().view(np.uint64)[runs.doc] for c in ("rank", "print")), runs.key)
                at = np.minimum(np.searchsorted(name, own), len(name) - 1)
                bits = np.where(name[at] == own, mask[at], 0)
                for j in range(window - seed + 1):
                    hit = runs.start[((bits >> j) & 1 == 1) & (runs.count > j)] + j  # no word twice
                    gone[hit] += 1
                    gone[hit + window] -= 1
            stays = np.cumsum(gone[:-1]) == 0
            raw = words.raw.tobytes()
            for i in range(table.num_rows):
                a, b = words.first[i], words.first[i + 1]
                kept = np.flatnonzero(stays[a:b]) + a
                if len(kept) == b - a:
                    text = b" ".join(raw[words.offsets[i] : words.offsets[i + 1]].split())
                else:
                    text = b" ".join([raw[s:e] for s, e in zip(words.start[kept].tolist(), words.end[kept].tolist())])
                n_words.append(int(b - a))
                n_removed.append(int(b - a) - len(kept))
                texts.append(text)
            ids.append(table["doc_id"].combine_chunks())
        return pa.table(
            {
                "doc_id": pa.chunked_array(ids, pa.int64()),
                "n_words": pa.array(n_words, pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()),
                "text": pa.array(texts, pa.binary()).cast(pa.string()),
            }
        )

    return work


def remove_repeated(
    docs: DataFrame, window: int = WINDOW, seed: int = SEED, block_bytes: int = BLOCK_BYTES, shard_runs: int = SHARD_RUNS
) -> DataFrame:
    """``doc_id, n_words, n_removed, text`` of every row, ``text`` the kept words joined by one space.

    A word goes if a window of ``window`` consecutive words covers it whose words
    also start in a document with a smaller ``doc_id``, judged on the input.
    Words are compared unchanged (by 64-bit hashes). A null text has no words; a
    row without id comes after all others; rows with the same id do not see each
    other. Texts of any length are read whole. Other columns are left out, no rows
    give no rows.
    """
    missing = F.col("doc_id").isNull()
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        _rank(F.col("doc_id")).alias("rank"),
        F.when(missing, F.xxhash64("text")).otherwise(0).alias("print"),  # rows without id need not share a block
        F.col("text").cast("string").alias("text"),
    )
    text = own.select("rank", "print", "text")
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-int(size) // block_bytes))
    block = F.pmod(F.xxhash64("rank", "print"), F.lit(n_blocks)).cast("int").alias("block")

    seeds = stored(
        text.mapInArrow(_seed_rows(window, seed), "seed long, low long, high long")
        .groupBy("seed")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .where("low < high")
        .select("seed", "low"),
        "seeds",
    )
    runs = stored(text.mapInArrow(_run_rows(window, seed), "seed long, run long, rank long, print long").join(seeds, "seed"), "runs")
    by_run = runs.groupBy("seed", "run").agg(F.min(F.struct("rank", "print")).alias("f"))
    by_run = stored(by_run.select("seed", "run", F.col("f.rank").alias("first"), F.col("f.print").alias("print")), "by-run")
    many = stored(
        by_run.groupBy("seed").agg(F.count(F.lit(1)).alias("runs")).where("runs > 1"), "many"
    )
    several = stored(by_run.join(many, "seed"), "several")
    total = several.count()
    asked = several.select("run", F.col("first").alias("rank"), "print").select("run", block)
    found = own.select("rank", "text", block).groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(_run_words(window, seed), "run long, seed long, words binary")
    shards = max(1, -(-total // shard_runs))
    parts = F.when(F.col("runs") <= shard_runs, F.lit(1)).otherwise(F.ceil(F.col("runs") * (window - seed) / shard_runs))
    worded = found.select("run", "words").join(several, "run").select(
        "seed", "run", "first", "words", parts.cast("long").alias("parts"), F.pmod(F.xxhash64("seed"), F.lit(shards)).alias("shard")
    )
    crowded = not many.where(F.col("runs") > shard_runs).isEmpty()
    if crowded:
        worded = stored(worded, "worded")
    dealt = worded.mapInArrow(_dealt(window), "shard long, part long, run long, at long, first long, words binary")
    told = "run long, at long, firsts array<long>"
    firsts = dealt.where("part = 0").groupBy("shard", "part").applyInArrow(_match(window), told)
    if crowded:
        place = ["shard", "part", "words"]
        windows = stored(dealt.where("part > 0"), "windows")
        merged = windows.groupBy(*place).agg(F.min("first").alias("first")).withColumns({"run": F.monotonically_increasing_id(), "at": F.lit(0).cast("long")})
        merged = stored(merged, "merged")
        judged = merged.groupBy("shard", "part").applyInArrow(_match(window), told).select(F.col("run").alias("nth"), "firsts")
        by_window = merged.select(*place, F.col("run").alias("nth")).join(judged, "nth")
        firsts = firsts.unionByName(windows.select("run", "at", *place).join(by_window, place).select("run", "at", "firsts"))
    firsts = stored(firsts, "firsts")
    every = (1 << (window - seed + 1)) - 1
    single = (
        runs.join(many, "seed", "left_anti").where("rank > low").select("rank", "print", "run", F.lit(every).cast("long").alias("mask"))
    )
    bit = F.transform("firsts", lambda x, i: F.when(x < F.col("rank"), F.expr("shiftleft(1L, CAST(at AS INT))") * F.pow(F.lit(2), i).cast("long")).otherwise(F.lit(0).cast("long")))
    searched = (
        runs.select("rank", "print", "run")
        .join(firsts, "run")
        .select("rank", "print", "run", F.aggregate(bit, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x)).alias("mask"))
        .where("mask <> 0")
        .groupBy("rank", "print", "run")
        .agg(F.bit_or("mask").alias("mask"))
    )
    masks = single.unionByName(searched).select("rank", "print", "run", "mask", block)
    return (
        own.select("doc_id", "rank", "print", "text", block)
        .groupBy("block")
        .cogroup(masks.groupBy("block"))
        .applyInArrow(_keep(window, seed), "doc_id long, n_words long, n_removed long, text string")
    )

"""N-gram Jaccard join with PartEnum signatures, and the components of its links.

Sets of word shingles whose Jaccard similarity reaches a threshold differ in few
elements, for their size. Sizes are cut into bands; a band's greatest difference
k is known. The shingle domain is split into parts, and subsets of parts are the
signatures: with k + 2 parts some pair of parts is free of differences, and with
k + 1 + e single parts at least e + 1 are. So similar sets of a band share
signatures, and a set may leave out its e most common ones: what it has left
still meets every similar set. A set that shares no more than e signatures with
all others is done with.

Only distinct sets are joined. Each is first compared with the partners it
shares most signatures with; components of the links found are built; the pairs
that share a signature and still lie apart are compared next, so no link that
matters for a component is lost. Members of a large bucket are compared inside
tasks, block by block, by bit sketches whose distance never exceeds the true
one. What passes is decided by exact similarity of whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, exp

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkscore.llm.batches import Words, distinct, mix, new_powers, slices, text_bytes
from linkscore.llm.components import components
from linkscore.runtime import stored

WIDTH = 1.3  # largest size over smallest of a band
FEW = 5  # up to so many differences, signatures are pairs of parts
LARGE = 32  # sets of a bucket whose pairs may be rows; beyond, they are compared inside tasks
BLOCK = 512  # sets of a large bucket that one side of a task holds

# filled as needed inside a task: tables, not cached functions, as those would be sent by name alone
_BANDS: list[tuple[int, int]] = [(1, 1)]
_MET: dict[tuple[int, int], tuple[int, ...]] = {}
_PLANS: dict[tuple[int, int], tuple[int, int, int, np.ndarray] | None] = {}


def band(nth: int) -> tuple[int, int]:
    """Least and largest set size of the nth band."""
    while len(_BANDS) <= nth:
        low = _BANDS[-1][1] + 1
        _BANDS.append((low, int(low * WIDTH)))
    return _BANDS[nth]


def bands_of(size: int, percent: int) -> tuple[int, ...]:
    """Bands in which a set of this size meets its equals and smaller partners."""
    if (size, percent) not in _MET:
        _MET[size, percent] = _bands_of(size, percent)
    return _MET[size, percent]


def _bands_of(size: int, percent: int) -> tuple[int, ...]:
    least = -(-size * percent // 100)
    nth = 0
    while band(nth)[1] < least:
        nth += 1
    out = [nth]
    while band(out[-1])[1] < size:
        out.append(out[-1] + 1)
    return tuple(out)


def most_different(total: int, percent: int) -> int:
    """Most elements in which two sets of ``total`` elements together may differ."""
    return total * (100 - percent) // (100 + percent)


def plan(nth: int, percent: int) -> tuple[int, int, int, np.ndarray] | None:
    """Parts, parts of a subset, spare parts and the salts of a band's signatures.

    None where only equal sets reach the threshold. The spare parts outnumber
    those that are likely to be empty in the band's smallest sets.
    """
    if (nth, percent) not in _PLANS:
        _PLANS[nth, percent] = _plan(nth, percent)
    return _PLANS[nth, percent]


def _plan(nth: int, percent: int) -> tuple[int, int, int, np.ndarray] | None:
    low, high = band(nth)
    k = most_different(high + high * 100 // percent, percent)
    if k == 0:
        return None
    if k <= FEW:
        parts, chosen, spare = k + 2, 2, 0
        count = parts * (parts - 1) // 2
    else:
        spare = 2 + k // 16
        for _ in range(4):
            empty = (k + 1 + spare) * exp(-low / (k + 1 + spare))
            spare = 2 + k // 16 + ceil(empty + 2 * empty**0.5)
        parts = count = k + 1 + spare
        chosen = 1
    salts = mix(np.arange(count, dtype=np.uint64) + np.uint64((nth + 1) << 40))
    return parts, chosen, spare, salts


def signatures(elements: np.ndarray, percent: int) -> list[tuple[int, np.ndarray, int]]:
    """(band, signatures, how many of the most common may be left out) of sorted distinct hashes.

    Empty parts stand at the end of the order, so they are the first to be left
    out; only a set with more of them than parts are spare keeps them.
    """
    out = []
    sums = None
    for nth in bands_of(len(elements), percent):
        made = plan(nth, percent)
        if made is None:
            continue
        parts, chosen, spare, salts = made
        if sums is None:
            sums = np.zeros(len(elements) + 1, np.uint64)
            np.cumsum(mix(elements), dtype=np.uint64, out=sums[1:])
        borders = np.arange(1, parts, dtype=np.uint64) * np.uint64((1 << 64) // parts)
        cuts = np.concatenate([[0], np.searchsorted(elements, borders), [len(elements)]])
        value, count = sums[cuts[1:]] - sums[cuts[:-1]], np.diff(cuts)
        if chosen == 2:
            i, j = np.triu_indices(parts, 1)
            value, count = mix(value[i]) + value[j], count[i] + count[j]
        keys = mix(value ^ salts)
        filled = count > 0
        empty = int((~filled).sum())
        if empty > spare:
            out.append((nth, keys, 0))
        else:
            out.append((nth, keys[filled], spare - empty))
    return out


def sketch(elements: np.ndarray) -> np.ndarray:
    """Parity of the number of elements in each of a power of two of bins, two per element or more.

    Two sketches differ in no more bins than their sets differ in elements.
    Halves laid over each other give the sketch with half the bins.
    """
    bins = max(64, 1 << (2 * len(elements) - 1).bit_length())
    odd = np.bincount((elements & np.uint64(bins - 1)).astype(np.int64), minlength=bins) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def fold(bits: np.ndarray, words: int) -> np.ndarray:
    """Sketches (rows) with their bins halved until they are ``words`` long."""
    while bits.shape[1] > words:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def shingle_sets(table: pa.Table, n: int, powers) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text, A-Z lower-cased.

    A text of fewer than ``n`` words has one shingle, all its words; one without
    words has none.
    """
    raw, offsets = text_bytes(table["text"])
    words = Words(raw, offsets, powers, lower=True)
    keys, bounds = words.grams(n)
    out = []
    for i in range(table.num_rows):
        own = keys[bounds[i] : bounds[i + 1]]
        if len(own) == 0 and words.first[i] < words.first[i + 1]:
            short = words.hash[words.first[i] : words.first[i + 1]]
            own = mix(np.array([int(sum(int(h) * 0x9E3779B97F4A7C15 ** (j + 1) for j, h in enumerate(short))) + len(short) & (1 << 64) - 1], np.uint64))
        out.append(distinct(own))
    return out


def set_hash(elements: np.ndarray) -> int:
    """64 bits that name a set; 0 for the empty one."""
    if not len(elements):
        return 0
    total = mix(elements + np.uint64(0x632BE59BD9B4E019)).sum(dtype=np.uint64, keepdims=True)
    return int(mix(total + np.uint64(len(elements))).view(np.int64)[0])


def _named(n: int):
    """Arrow function: every row's set size and node."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = new_powers()
        for batch in batches:
            for table in slices(batch):
                sets = shingle_sets(table, n, powers)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[table[c].combine_chunks() for c in ("doc_id", "anon", "handle", "print")],
                        pa.array([len(x) for x in sets], pa.int64()),
                        pa.array([set_hash(x) for x in sets], pa.int64()),
                    ],
                    names=["doc_id", "anon", "handle", "print", "n_shingles", "node"],
                )

    return work


def _signed(n: int, percent: int):
    """Arrow function: the signatures of every set, once per task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = new_powers()
        met: set[int] = set()
        for batch in batches:
            for table in slices(batch):
                keys, nodes, extra = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
                for own in shingle_sets(table, n, powers):
                    node = set_hash(own)
                    if node in met or not len(own):
                        continue
                    met.add(node)
                    for nth, found, drop in signatures(own, percent):
                        keys.append(found.view(np.int64))
                        nodes.append(np.full(len(found), node))
                        extra.append(np.full(len(found), nth << 20 | min(drop, (1 << 20) - 1), np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in (keys, nodes, extra)], names=["key", "node", "extra"]
                )

    return work


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    borders = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(borders), pa.array(np.concatenate([np.zeros(0, np.int64), *arrays])))


def _sets_of(n: int):
    """Arrow function: set and sketch of each asked-for node, once; the rows of a handle come together."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = new_powers()
        met: set[int] = set()
        for batch in batches:
            for table in slices(batch):
                nodes, sets = [], []
                for node, own in zip(table["node"].to_pylist(), shingle_sets(table, n, powers)):
                    if node not in met and set_hash(own) == node:
                        met.add(node)
                        nodes.append(node)
                        sets.append(own)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(nodes, pa.int64()),
                        pa.array([len(x) for x in sets], pa.int64()),
                        _lists([x.view(np.int64) for x in sets]),
                        _lists([sketch(x).view(np.int64) for x in sets]),
                    ],
                    names=["node", "n", "items", "bits"],
                )

    return work


def _near_pairs(percent: int, nearest: int | None):
    """Arrow function for two blocks of a bucket: pairs in different components whose sketches allow a link.

    With ``nearest``, each set gets only so many partners, the nearest first.
    """

    def work(table: pa.Table) -> pa.Table:
        side = table["side"].to_numpy()  # 2: of a block that is met with itself
        left, right = (table.filter(pa.array((side == s) | (side == 2))) for s in (0, 1))
        out_a, out_b = [], []
        if len(left) and len(right):
            words = min(len(x) for x in table["bits"].to_pylist())
            n, root, node, bits = [], [], [], []
            for part in (left, right):
                rows = [np.array(x, np.int64).view(np.uint64) for x in part["bits"].to_pylist()]
                bits.append(np.concatenate([fold(x[None, :], words) for x in rows]))
                n.append(part["n"].to_numpy())
                root.append(part["root"].to_numpy())
                node.append(part["node"].to_numpy())
            for i in range(len(node[0])):
                apart = np.bitwise_count(bits[1] ^ bits[0][i]).sum(1)
                limit = (n[1] + n[0][i]) * (100 - percent) // (100 + percent)
                hit = np.flatnonzero((apart <= limit) & (root[1] != root[0][i]))
                if nearest is not None and len(hit) > nearest:
                    hit = hit[np.argsort(apart[hit], kind="stable")[:nearest]]
                out_a.append(np.full(len(hit), node[0][i]))
                out_b.append(node[1][hit])
        a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (out_a, out_b))
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return work


def _handles(docs: DataFrame) -> DataFrame:
    """Rows by id, or by the hash of their text where they have none; ``print`` tells texts of one id apart."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_names(), F.col("text").cast("string").alias("text"))


def _names() -> list[Column]:
    own, text = F.col("doc_id").cast("long"), F.xxhash64("text")
    return [own.isNull().alias("anon"), F.when(own.isNull(), text).otherwise(own).alias("handle"), text.alias("print")]


def similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose sets reach the threshold, with intersection and union.

    Sketches rule out most other pairs before any whole set is moved.
    """

    def side(name: str, column: str, to: str) -> DataFrame:
        return sets.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"), F.col(column).alias(to))

    short = F.least(F.size("_x"), F.size("_y"))

    def folded(c: str):
        half = (F.size(c) / 2).cast("int")
        over = F.zip_with(F.slice(c, 1, half), F.slice(c, half + 1, half), lambda u, v: u.bitwiseXOR(v))
        return F.when(F.size(c) > short, over).otherwise(F.col(c))

    apart = F.aggregate(
        F.zip_with(folded("_x"), folded("_y"), lambda u, v: F.bit_count(u.bitwiseXOR(v))), F.lit(0), lambda t, x: t + x
    )
    seen = pairs.join(side("a", "bits", "_x"), "a").join(side("b", "bits", "_y"), "b")
    # bins that cannot be laid over each other rule nothing out
    near = seen.where(F.coalesce(apart, F.lit(0)) * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent)).select("a", "b")
    both = near.join(side("a", "items", "_x"), "a").join(side("b", "items", "_y"), "b")
    common = F.size(F.array_intersect("_x", "_y"))
    return both.select("a", "b", common.alias("common"), (F.col("n_a") + F.col("n_b") - common).alias("whole")).where(
        100 * F.col("common") >= percent * F.col("whole")
    )


def _grouped(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Every row with its set (``doc_id, anon, handle, print, n_shingles, node``), and each set's first row and ``root``."""
    handles = _handles(docs)
    rows = stored(
        handles.mapInArrow(_named(n), "doc_id long, anon boolean, handle long, print long, n_shingles long, node long"), "sets"
    )
    first = F.min(F.struct("anon", "handle", "print")).alias("first")
    nodes = stored(rows.where("n_shingles > 0").groupBy("node").agg(first), "nodes")
    links = candidate_links(nodes, handles, n, percent)
    return rows, nodes.join(components(links), "node", "left").select("node", F.coalesce("root", "node").alias("root"), "first")


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, node``: one row per row of ``docs``.

    Rows link when ``100 * |intersection| >= percent * |union|`` of their sets of
    distinct ``n``-word shingles. ``component_id`` is the smallest ``doc_id`` that
    links reach, the own one included; ``node`` names the set, so rows with equal
    sets have equal nodes (told apart by 64-bit hashes). Null texts and texts
    without words have no shingles and are linked with nothing; texts of any length
    count whole. Rows without an id take part; their component is null if it holds
    no id. Repeated ids stay, other columns are left out, no rows give no rows.
    """
    rows, named = _grouped(docs, n, percent)
    named = named.withColumn("id", F.when(~F.col("first.anon"), F.col("first.handle")))
    least = named.groupBy("root").agg(F.min("id").alias("component_id"))
    by_node = stored(named.join(least, "root").select("node", "component_id"), "components")
    full, empty = rows.where("n_shingles > 0"), rows.where("n_shingles = 0")
    return (
        full.join(by_node, "node")
        .select("doc_id", "n_shingles", "component_id", "node")
        .unionByName(empty.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "node"))
    )


def shared_signatures(handles: DataFrame, n: int, percent: int) -> DataFrame:
    """``key, node, df``: the signatures by which a set can meet a similar one.

    ``df`` is how many rows hold the signature. Signatures that one set alone
    holds are dropped, and of a set's others the ``drop`` most common ones.
    """
    key = Window.partitionBy("key")
    held = (
        handles.select("text")
        .mapInArrow(_signed(n, percent), "key long, node long, extra int")
        .withColumn("df", F.count(F.lit(1)).over(key))
        .withColumn("_first", F.min("node").over(key))
        .withColumn("_last", F.max("node").over(key))
        .where("_first <> _last")
        .groupBy("key", "node")
        .agg(F.max("extra").alias("extra"), F.max("df").alias("df"))
    )
    common = Window.partitionBy("node", F.shiftright("extra", 20)).orderBy(F.desc("df"), F.desc("key"))
    return (
        held.withColumn("_nth", F.row_number().over(common))
        .where(F.col("_nth") > F.col("extra").bitwiseAND(F.lit((1 << 20) - 1)))
        .select("key", "node", "df")
    )


def candidate_links(nodes: DataFrame, handles: DataFrame, n: int, percent: int) -> DataFrame:
    """Links ``a, b`` between nodes that give the components of all links."""
    key = Window.partitionBy("key")
    shared = stored(
        shared_signatures(handles, n, percent)
        .withColumn("low", F.min("node").over(key))
        .withColumn("high", F.max("node").over(key))
        .where("low <> high"),
        "shared",
    )
    asked = shared.select("node").distinct().join(nodes, "node").select("node", "first.anon", "first.handle")
    sets = stored(
        handles.join(asked, ["anon", "handle"])
        .select("node", "text")
        .mapInArrow(_sets_of(n), "node long, n long, items array<long>, bits array<long>"),
        "items",
    )
    # first the two partners of each set with which it shares most
    hubs = shared.select("node", F.explode(F.array("low", "high")).alias("hub")).where("node <> hub")
    count = hubs.groupBy("node", "hub", (F.col("node") > F.col("hub")).alias("up")).count()
    best = count.groupBy("node", "up").agg(F.max_by("hub", F.struct("count", "hub")).alias("hub"))
    pairs = best.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    tried = stored(pairs, "pairs")
    links = stored(similar(tried, sets, percent).select("a", "b"), "links")
    # then what shares a signature and still lies apart, the nearest first, all of it in the end
    for nearest in (2, 16, None):
        roots = components(links)
        parts = shared.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
        apart = stored(
            parts.withColumn("size", F.count(F.lit(1)).over(key))
            .withColumn("_low", F.min("root").over(key))
            .withColumn("_high", F.max("root").over(key))
            .where("_low <> _high")
            .select("key", "node", "root", "size"),
            "apart",
        )
        if apart.isEmpty():
            break
        more = _row_pairs(apart).unionByName(_block_pairs(apart, sets, percent, nearest)).distinct()
        pairs = stored(more.join(tried, ["a", "b"], "left_anti"), "pairs")
        tried = tried.unionByName(pairs)
        links = links.unionByName(stored(similar(pairs, sets, percent).select("a", "b"), "links"))
    return links


def _row_pairs(apart: DataFrame) -> DataFrame:
    """Pairs of a bucket of few sets that lie in different components."""
    few = apart.where(F.col("size") <= LARGE)
    other = few.select("key", F.col("node").alias("b"), F.col("root").alias("_root"))
    return few.join(other, "key").where("root <> _root AND node < b").select(F.col("node").alias("a"), "b")


def _block_pairs(apart: DataFrame, sets: DataFrame, percent: int, nearest: int | None) -> DataFrame:
    """Pairs of buckets of many sets that may link: cut into blocks, every two blocks met in a task."""
    many = apart.where(F.col("size") > LARGE).join(sets.select("node", "n", "bits"), "node")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    laid = many.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    sided = laid.select(
        "key",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        F.when(F.col("own") == F.col("other"), 2).otherwise((F.col("own") > F.col("other")).cast("int")).alias("side"),
        "node", "root", "n", "bits",
    )
    return sided.groupBy("key", "i", "j").applyInArrow(_near_pairs(percent, nearest), "a long, b long")


def deduplicate(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, that stay: one of each component.

    It is the row with the smallest ``doc_id``, rows without one last; of several
    texts with that id the one with the smallest hash, of equal rows any. Rows
    without words link with nothing and stay, repeated ones included.
    """
    _, named = _grouped(docs, n, percent)
    stays = named.groupBy("root").agg(F.min("first").alias("first")).select("first.*")
    keys = ["anon", "handle", "print"]
    # the row travels as one column, so names of the input cannot clash with those used here
    laid = docs.select(F.struct("*").alias("row"), *_names(), F.coalesce(F.col("text").cast("string").rlike(r"[^ \t-\r]"), F.lit(False)).alias("worded"))
    kept = laid.where("worded").join(stays, keys, "left_semi").dropDuplicates(keys)
    return kept.select("row").unionByName(laid.where("NOT worded").select("row")).select("row.*")

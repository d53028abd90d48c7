"""Item similarities and recommendations from ratings (user_id, item_id, rating)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkscore.runtime import discard, shuffle_width, stored
from linkscore.skew import block_counts, salted_join

KINDS = ("euclid", "pearson", "cosine")
LIST_ROWS = 2_000  # ratings of a user that travel as one list
ROWS_PER_TASK = 2_000_000  # pairs that one task makes out of lists


def _pairs_by_item(ratings: DataFrame) -> DataFrame:
    """(item_id_a, rating_a, item_id_b, rating_b) for ``item_id_a < item_id_b`` of a user, placed by ``item_id_a``; or by it and ``_part``, where an item is split."""
    rated = ratings.select("user_id", "item_id", "rating").where("user_id IS NOT NULL AND item_id IS NOT NULL")
    rated = stored(rated.withColumn("_blk", F.lit(0)), "rated")
    need = stored(block_counts(rated, ["user_id"], LIST_ROWS), "need")
    if not need.isEmpty():
        blk = F.coalesce(F.pmod(F.xxhash64("item_id"), F.col("_blocks")).cast("int"), F.lit(0))
        rated = rated.join(need, "user_id", "left").withColumn("_blk", blk).drop("_blocks")
    lists = rated.groupBy("user_id", "_blk").agg(F.sort_array(F.collect_list(F.struct("item_id", "rating"))).alias("_list"))
    lists = stored(lists, "lists")  # read for the sizes and for the pairs
    later = F.filter("_list", lambda x: x["item_id"] > F.col("item_id_a"))
    if need.isEmpty():  # every user has one list
        one = lists.select(F.explode("_list").alias("_a"), "_list")
    else:
        one = salted_join(rated.select("user_id", F.struct("item_id", "rating").alias("_a")), lists.select("user_id", "_list"), ["user_id"], F.col("_a"))
    sent = one.select(F.col("_a.item_id").alias("item_id_a"), F.col("_a.rating").alias("rating_a"), "_list").withColumn("_list", later)
    sent = sent.where(F.size("_list") > 0)
    rows = stored(sent.groupBy("item_id_a").agg(F.sum(F.size("_list")).alias("_rows")), "rows")
    split = rows.where(F.col("_rows") > ROWS_PER_TASK).select("item_id_a", F.ceil(F.col("_rows") / ROWS_PER_TASK).cast("int").alias("_parts"))
    tasks = max(shuffle_width(ratings.sparkSession), (rows.agg(F.sum("_rows")).first()[0] or 0) // ROWS_PER_TASK + 1)
    place = ["item_id_a"]  # a constant part would be a key that the placing does not know, and the sums would travel once more
    if not split.isEmpty():
        place.append("_part")
        parts = F.coalesce("_parts", F.lit(1))
        sent = sent.join(split, "item_id_a", "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
        mine = F.filter("_list", lambda x: F.pmod(F.xxhash64(x["item_id"]), parts) == F.col("_part"))
        sent = sent.withColumn("_list", F.when(parts == 1, F.col("_list")).otherwise(mine)).drop("_parts")
    # plain arrays take half the bytes of an array of structs
    plain = sent.select(*place, "rating_a", F.col("_list.item_id").alias("item_id_b"), F.col("_list.rating").alias("rating_b"))
    zipped = F.explode(F.arrays_zip("item_id_b", "rating_b")).alias("_b")
    here = plain.repartition(tasks, *place).select(*place, "rating_a", zipped)
    return here.select(*place, "rating_a", "_b.item_id_b", "_b.rating_b")


def item_similarity(ratings: DataFrame, kind: str = "cosine") -> DataFrame:
    """(item_a, item_b, n, similarity), ``item_a < item_b``, over users who rated both.

    All three measures come from the same sums. A user's ratings go to the items as
    lists and become pairs only in the task that sums them; the lists of a user with very
    many ratings and the pairs of an item with very many are cut into blocks. Pearson is
    1.0 below three common users and missing where a side does not vary.
    """
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}")
    pairs = _pairs_by_item(ratings)
    a, b = F.col("rating_a"), F.col("rating_b")
    # a pair is in one part only, and its part is where the rows are: this shuffles nothing
    sums = pairs.groupBy(*[c for c in pairs.columns if not c.startswith("rating")]).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((a - b) * (a - b)).alias("dd"),
        F.sum(a).alias("sa"),
        F.sum(b).alias("sb"),
        F.sum(a * b).alias("ab"),
        F.sum(a * a).alias("aa"),
        F.sum(b * b).alias("bb"),
    )
    n = F.col("n")
    if kind == "euclid":
        sim = 1 / (1 + F.sqrt("dd"))
    elif kind == "cosine":
        sim = 0.5 + 0.5 * F.try_divide(F.col("ab"), F.sqrt("aa") * F.sqrt("bb"))  # NULL without length
    else:
        va, vb = n * F.col("aa") - F.col("sa") * F.col("sa"), n * F.col("bb") - F.col("sb") * F.col("sb")
        corr = F.when((va > 0) & (vb > 0), (n * F.col("ab") - F.col("sa") * F.col("sb")) / F.sqrt(va * vb))
        sim = F.when(n < 3, F.lit(1.0)).otherwise(0.5 + 0.5 * corr)
    return sums.select(F.col("item_id_a").alias("item_a"), F.col("item_id_b").alias("item_b"), "n", sim.alias("similarity"))


# --- recommendations ------------------------------------------------------
#
# Users are cut into blocks and items into tiles. A task scores the users of one block
# for the items of one tile, some users at a time, and gives each user's best ``n`` of them, so
# neither votes nor predictions are ever rows; the best of all tiles are merged. Ratings and
# similar items travel as lists, ratings once for each tile and similar items once for each
# block, so both are as large as a task's memory allows and no larger.

BLOCK_USERS = 500  # no block of reduced recommendations has fewer users, but for few users
BLOCK_RATINGS = 4_000_000
TILE_ITEMS = 4_000
TILE_LINKS = 2_000_000  # similar items that a tile's items have
PIECE_CELLS = 2_000_000  # users by items that are scored at once
SCORED = "user_id long, item_id long, predicted double"


def _best_of_tile(users: np.ndarray, items: np.ndarray, top: np.ndarray, bottom: np.ndarray, open_: np.ndarray, n: int) -> pd.DataFrame:
    """Best ``n`` items of each user by ``top / bottom``, rounded; ties to the smaller item."""
    with np.errstate(divide="ignore", invalid="ignore"):
        p = np.where(open_, top / bottom, -np.inf)
    rank = np.argsort(-np.round(p, 9), axis=1, kind="stable")[:, :n]  # items ascend
    best = np.take_along_axis(p, rank, 1)
    u, i = np.nonzero(np.isfinite(best))
    return pd.DataFrame({"user_id": users[u], "item_id": items[rank[u, i]], "predicted": best[u, i]})


def _ranked(found: DataFrame, n: int) -> DataFrame:
    best = Window.partitionBy("user_id").orderBy(F.desc(F.round("predicted", 9)), "item_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)


def _blocks(total: int, size: int) -> int:
    return max(1, -(-total // size))


def _numbered(c: str, n: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(n)).cast("int")


def _every(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


def _tile_of(items: np.ndarray, tiles: int) -> np.ndarray:
    mixed = items.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(tiles)).astype(np.int64)


TILED = "tile int, own boolean, one long, many array<long>, sims array<double>"


def _by_tile(tiles: int):
    """Arrow function: an item's similar items for the tile that holds it (``own``) and, cut into pieces, for the tiles that hold them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for one, many, sims in zip(batch["one"].to_numpy(), batch["many"], batch["sims"]):
                many, sims = many.values.to_numpy(), sims.values.to_numpy()
                out.append((int(_tile_of(np.array([one]), tiles)[0]), True, one, many, sims))
                tile = _tile_of(many, tiles)
                order = np.argsort(tile, kind="stable")
                tile, many, sims = tile[order], many[order], sims[order]
                first = np.flatnonzero(np.append(True, tile[1:] != tile[:-1]))
                for a, b in zip(first, [*first[1:], len(tile)]):
                    out.append((int(tile[a]), False, one, many[a:b], sims[a:b]))
            if out:
                types = [pa.int32(), pa.bool_(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["tile", "own", "one", "many", "sims"])

    return work


def _flat(table: pa.Table, one: str, *many: str) -> list[np.ndarray]:
    """A column repeated for the lists beside it, and these lists end to end."""
    lists = [table[c].combine_chunks() for c in many]
    width = lists[0].value_lengths().to_numpy(zero_copy_only=False)
    return [np.repeat(table[one].to_numpy(), width), *[x.flatten().to_numpy(zero_copy_only=False) for x in lists]]


def _vote(n: int):
    """Arrow function of a block's ratings and the similar items of a tile: each user's best unrated items of the tile."""

    def best(user: np.ndarray, item: np.ndarray, rating: np.ndarray, known: np.ndarray, place: np.ndarray, sims: np.ndarray, items: np.ndarray) -> pd.DataFrame:
        users, row = np.unique(user, return_inverse=True)
        first, last = np.searchsorted(known, item, "left"), np.searchsorted(known, item, "right")
        size = len(users) * len(items)
        top, bottom, count = np.zeros(size), np.zeros(size), np.zeros(size, np.int64)
        votes = last - first
        cuts = np.flatnonzero(np.diff(np.cumsum(votes) // 1_000_000)) + 1  # votes of a piece, about 30 MB
        for a, b in zip([0, *cuts], [*cuts, len(item)]):
            width = votes[a:b]
            ends = np.cumsum(width)
            link = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first[a:b] - (ends - width), width)
            at = np.repeat(row[a:b], width) * len(items) + place[link]
            top += np.bincount(at, sims[link] * np.repeat(rating[a:b], width), size)
            bottom += np.bincount(at, sims[link], size)
            count += np.bincount(at, minlength=size)
        open_ = (count > 0) & (bottom != 0)
        own = np.searchsorted(items, item)
        there = (own < len(items)) & (items[np.minimum(own, len(items) - 1)] == item)
        open_[row[there] * len(items) + own[there]] = False
        grid = lambda x: x.reshape(len(users), len(items))
        return _best_of_tile(users, items, grid(top), grid(bottom), grid(open_), n)

    def work(rated: pa.Table, links: pa.Table) -> pa.Table:
        out = [pd.DataFrame({"user_id": np.array([], np.int64), "item_id": np.array([], np.int64), "predicted": np.array([], float)})]
        if len(rated) and len(links):
            user, item, rating = _flat(rated, "user_id", "items", "ratings")
            order = np.argsort(user, kind="stable")
            user, item, rating = user[order], item[order], rating[order]
            one, many, sims = _flat(links, "one", "many", "sims")
            own = np.repeat(links["own"].to_numpy(), links["many"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False))
            known, others = np.where(own, many, one), np.where(own, one, many)
            order = np.argsort(known, kind="stable")
            known, sims = known[order], sims[order]
            items, place = np.unique(others[order], return_inverse=True)
            starts = np.flatnonzero(np.append(True, user[1:] != user[:-1]))
            cuts = [*starts[:: max(1, PIECE_CELLS // len(items))], len(user)]
            out += [best(user[a:b], item[a:b], rating[a:b], known, place, sims, items) for a, b in zip(cuts, cuts[1:])]
        return pa.Table.from_pandas(pd.concat(out, ignore_index=True), preserve_index=False)

    return work


def recommend(ratings: DataFrame, n: int = 3, kind: str = "cosine") -> DataFrame:
    """(user_id, item_id, predicted, rank): best unrated items per user.

    The prediction is the mean of the user's ratings weighted by similarity; there is
    none where the weights sum to 0. Ratings go to the tiles, similar items to the
    blocks; a hot item's votes are summed where they arise.
    """
    rated = stored(ratings.select(F.col("user_id").cast("long"), F.col("item_id").cast("long"), F.col("rating").cast("double")).dropna(), "ratings")
    similar = item_similarity(rated, kind).where(F.col("similarity").isNotNull())
    # an item's pairs are where they were summed, and become lists there
    lists = similar.groupBy("item_a").agg(F.collect_list(F.struct("item_b", "similarity")).alias("l"))
    lists = stored(lists.select(F.col("item_a").alias("one"), F.col("l.item_b").alias("many"), F.col("l.similarity").alias("sims")), "similar")
    items, total = rated.agg(F.approx_count_distinct("item_id"), F.count(F.lit(1))).first()
    links = 2 * (lists.agg(F.sum(F.size("many"))).first()[0] or 0)
    blocks = _blocks(total, BLOCK_RATINGS)
    cores = ratings.sparkSession.sparkContext.defaultParallelism
    tiles = max(_blocks(items, TILE_ITEMS), _blocks(links, TILE_LINKS), min(_blocks(2 * cores, blocks), max(items, 1)))
    # the votes of a task are not in proportion to its bytes, by which tasks would be merged, and few tasks share a place
    place = [4 * blocks * tiles, "block", "tile"]
    whose = rated.withColumn("_cut", _numbered("item_id", _blocks(total, BLOCK_RATINGS)))  # no list holds more than a block's share
    whose = whose.groupBy("user_id", "_cut").agg(F.collect_list(F.struct("item_id", "rating")).alias("l"))
    whose = whose.select("user_id", F.col("l.item_id").alias("items"), F.col("l.rating").alias("ratings"))
    left = whose.withColumns({"block": _numbered("user_id", blocks), "tile": _every(tiles)}).repartition(*place)
    right = lists.mapInArrow(_by_tile(tiles), TILED).withColumn("block", _every(blocks)).repartition(*place)
    found = left.groupBy("block", "tile").cogroup(right.groupBy("block", "tile")).applyInArrow(_vote(n), SCORED)
    return _ranked(found, n)


OVERSAMPLE = 6
MOST_ROUNDS = 200
SETTLED = 1e-12  # relative change of the singular values' squares that ends the iteration
STATE = "item_id long, x array<double>, mx array<double>, p array<double>, mp array<double>, r array<double>, mr array<double>"


def _stack(batch: pa.RecordBatch, *names: str) -> np.ndarray:
    """Array columns side by side, a row per item."""
    return np.hstack([batch[c].flatten().to_numpy().reshape(batch.num_rows, -1) for c in names])


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's part of the products of the basis ``[x, r, p]`` with itself and with its images."""
    total = None
    for batch in batches:
        basis, images = _stack(batch, "x", "r", "p"), _stack(batch, "mx", "mr", "mp")
        own = np.stack([basis.T @ basis, basis.T @ images]).ravel()
        total = own if total is None else total + own
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["i", "v"])


def _combined(c: np.ndarray, squares: np.ndarray, k: int):
    """Arrow function: new vectors ``basis @ c``, the directions they went, their images and residuals."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            basis, images = _stack(batch, "x", "r", "p"), _stack(batch, "mx", "mr", "mp")
            x, mx = basis @ c, images @ c
            new = [x, mx, basis[:, k:] @ c[k:], images[:, k:] @ c[k:], mx - x * squares]
            yield pa.RecordBatch.from_arrays([batch["item_id"], *[pa.array(v.tolist(), pa.list_(pa.float64())) for v in new]], names=["item_id", "x", "mx", "p", "mp", "r"])

    return work


PART_RATINGS = 1_000_000  # ratings of the users that one task sends vectors through
CHUNK_RATINGS = 200_000  # ratings of one packed row, but for a single user's
PACKED = "part int, items array<long>, first binary, cols binary, vals binary"


def _pack(table: pa.Table) -> pa.Table:
    """Ratings of a part as rows of many users; ``cols`` number the part's items, which the first row lists."""
    user = table["user_id"].to_numpy()
    order = np.argsort(user, kind="stable")
    user, vals = user[order], table["rating"].to_numpy()[order]
    items, cols = np.unique(table["item_id"].to_numpy()[order], return_inverse=True)
    cols = cols.astype(np.int32)
    starts = np.flatnonzero(np.append(True, user[1:] != user[:-1]))
    cuts = np.flatnonzero(np.diff(starts // CHUNK_RATINGS)) + 1
    rows = []
    for a, b in zip([0, *cuts], [*cuts, len(starts)]):
        lo, hi = starts[a], starts[b] if b < len(starts) else len(user)
        rows.append([[] if a else items.tolist(), (starts[a:b] - lo).tobytes(), cols[lo:hi].tobytes(), vals[lo:hi].tobytes()])
    part = pa.array([table["part"][0].as_py()] * len(rows), pa.int32())
    types = [pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
    return pa.table([part, *[pa.array(c, t) for c, t in zip(zip(*rows), types)]], names=["part", "items", "first", "cols", "vals"])


def _there_and_back(k: int):
    """Arrow function of a part's packed ratings and the vectors of its items: what its users send back to the items."""

    def work(packed: pa.Table, vectors: pa.Table) -> pa.Table:
        vectors = vectors.sort_by("item_id")
        x = vectors["x"].combine_chunks().flatten().to_numpy().reshape(-1, k)
        out = np.zeros((k, len(x)))
        for first, cols, vals in zip(packed["first"], packed["cols"], packed["vals"]):
            first = np.frombuffer(first.as_buffer(), np.int64)
            cols, weight = np.frombuffer(cols.as_buffer(), np.int32), np.frombuffer(vals.as_buffer())[:, None]
            ahead = np.add.reduceat(x[cols] * weight, first, axis=0)  # a row per user
            back = np.repeat(ahead, np.diff(np.append(first, len(cols))), axis=0) * weight
            for i in range(k):
                out[i] += np.bincount(cols, back[:, i], len(x))
        return pa.table([vectors["item_id"], *map(pa.array, out)], names=["item_id", *[f"b{i}" for i in range(k)]])

    return work


class PackedRatings:
    """Ratings packed by their users. A round deals out these bytes and, once for each part, vectors and their images, never ratings as rows."""

    def __init__(self, ratings: DataFrame):
        # the matrix has the sum where a user rated an item repeatedly, so no user has more entries than there are items
        entries = ratings.groupBy(F.col("user_id").cast("long").alias("user_id"), F.col("item_id").cast("long").alias("item_id"))
        entries = stored(entries.agg(F.sum("rating").cast("double").alias("rating")), "entries")
        parts = _blocks(entries.count(), PART_RATINGS)
        # neighbouring users often share items, and a part asks for its own items only
        marked = entries.repartitionByRange(parts, "user_id").withColumn("part", F.spark_partition_id())
        packed = marked.groupBy("part").applyInArrow(_pack, PACKED)
        self.rows = stored(packed, "packed")
        self.needs = stored(self.rows.select("part", F.explode("items").alias("item_id")), "needs")
        self.rows = self.rows.select("part", "first", "cols", "vals")

    def image(self, vectors: DataFrame, c: str, k: int) -> DataFrame:
        """(item_id, image): the vectors in column ``c`` sent to the users by their ratings and back."""
        names = [f"b{i}" for i in range(k)]
        asked = self.needs.join(vectors.select("item_id", F.col(c).alias("x")), "item_id")
        schema = ", ".join(["item_id long", *[f"{b} double" for b in names]])
        back = self.rows.groupBy("part").cogroup(asked.groupBy("part")).applyInArrow(_there_and_back(k), schema)
        return back.groupBy("item_id").agg(F.array(*[F.sum(b) for b in names]).alias("image"))


def _ritz(gram: np.ndarray, image: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest squares inside the basis, and the combinations of its columns that have them."""
    size = np.sqrt(np.maximum(np.diag(gram), 0))
    scale = np.divide(1.0, size, out=np.zeros_like(size), where=size > 1e-150)
    g, h = gram * scale[:, None] * scale, image * scale[:, None] * scale
    values, vectors = np.linalg.eigh((g + g.T) / 2)
    keep = values > 1e-12 * max(values.max(), 1e-300)  # directions that are not there twice
    base = vectors[:, keep] / np.sqrt(values[keep])
    inner = base.T @ ((h + h.T) / 2) @ base
    squares, turn = np.linalg.eigh(inner)
    c = scale[:, None] * (base @ turn[:, ::-1][:, :k])
    missing = k - c.shape[1]
    return np.append(squares[::-1][:k], np.zeros(max(0, missing))), np.hstack([c, np.zeros((len(c), max(0, missing)))])


def right_vectors(ratings: DataFrame, rank: int) -> DataFrame:
    """(item_id, v): the first ``rank`` right singular vectors of the user-item matrix.

    Blocks of vectors are tables; of their few columns only products reach the
    driver. Ratings are packed. A round sends the residuals to the users and back, and takes the best
    vectors out of the current ones, their residuals and the last directions
    (locally optimal block iteration). It ends when the squares of the singular values
    have settled, or raises.
    """
    items = ratings.select("item_id").distinct()
    k = min(items.count(), rank + OVERSAMPLE)
    if not k:
        return items.withColumn("v", F.array().cast("array<double>"))
    start = F.array(*[F.pmod(F.xxhash64(F.lit(i), "item_id"), F.lit(2_000_003)) / F.lit(1_000_001.5) - 1 for i in range(k)])
    nothing = F.array_repeat(F.lit(0.0), k)
    seeds = items.select("item_id", start.alias("x"))
    packed = PackedRatings(ratings)
    images = seeds.join(packed.image(seeds, "x", k), "item_id")
    state = stored(images.select("item_id", "x", F.col("image").alias("mx"), *[nothing.alias(c) for c in ("p", "mp", "r", "mr")]), "vectors")
    before = None
    for _ in range(MOST_ROUNDS):
        parts = state.mapInArrow(_grams, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow().sort_by("i")
        gram, image = parts["v"].to_numpy().reshape(2, 3 * k, 3 * k)
        squares, c = _ritz(gram, image, k)
        new = state.mapInArrow(_combined(c, squares, k), STATE.removesuffix(", mr array<double>"))
        first = squares[:rank]
        if before is not None and np.allclose(first, before, rtol=SETTLED, atol=SETTLED * first.max()):
            return new.select("item_id", F.slice("x", 1, min(rank, k)).alias("v"))
        before = first
        sent = packed.image(new, "r", k).withColumnRenamed("image", "mr")
        old, state = state, stored(new.join(sent, "item_id"), "vectors")
        discard(old)
    raise RuntimeError(f"singular values did not settle in {MOST_ROUNDS} rounds")


WIDE_USERS = 20_000  # users of a block of reduced recommendations
WIDE_RATINGS = 2_000_000  # ratings of such a block
WIDE_ITEMS = 50_000  # items of a tile that meets such blocks
PIECE_USERS = 2_000  # users of a block that are scored at once
PIECE_ITEMS = 500  # items that are scored at once
SAMPLE_ITEMS = 1_000  # items that give a first floor of a user's best
CELLS = 256


class _Tile:
    """Items of a tile in cells of near vectors, each with a centre and a radius."""

    def __init__(self, items: np.ndarray, unit: np.ndarray):
        order = np.argsort(items)
        self.items, unit = items[order], unit[order]
        self.unit = unit
        pivots = unit[:: -(-len(unit) // CELLS)]
        near = np.concatenate([np.einsum("ik,ck->ic", unit[lo : lo + 10_000], pivots).argmax(axis=1) for lo in range(0, len(unit), 10_000)])
        self.at = np.argsort(near, kind="stable")
        self.back = np.argsort(self.at)
        first = np.flatnonzero(np.append(True, np.diff(near[self.at]) > 0))
        self.cells = [(lo, min(lo + PIECE_ITEMS, b)) for a, b in zip(first, [*first[1:], len(unit)]) for lo in range(a, b, PIECE_ITEMS)]
        self.sorted = np.ascontiguousarray(unit[self.at].T)
        self.centre = np.array([self.sorted[:, a:b].mean(axis=1) for a, b in self.cells])
        self.radius = np.array([np.sqrt(((self.sorted[:, a:b].T - c) ** 2).sum(axis=1).max()) for (a, b), c in zip(self.cells, self.centre)])
        self.sample = np.arange(0, len(unit), -(-len(unit) // SAMPLE_ITEMS))

    def best(self, total: np.ndarray, count: np.ndarray, r: np.ndarray, u: np.ndarray, row: np.ndarray, own: np.ndarray, n: int):
        """(row, item, prediction) of the best ``n`` items of each user but for the (``row``, ``own``) that are rated.

        What predicts ``t`` or more has ``total - t * count + (r - t * u) @ vector >= 0``, which the
        centre and the radius of a cell can rule out for all its items.
        """

        def predicted(who, vectors):
            # not a matrix product, whose threads would be more than the task's core
            top, bottom = np.einsum("uk,ki->ui", r[who], vectors), np.einsum("uk,ki->ui", u[who], vectors)
            top += total[who, None]
            bottom += count[who, None]
            with np.errstate(divide="ignore", invalid="ignore"):
                return np.fmax(np.where(bottom > 0, top / bottom, -np.inf), -np.inf)

        def below(floor):  # rounding changes no order beyond this
            return np.where(np.isfinite(floor), floor - 2e-9 - 1e-9 * np.abs(floor), -np.inf)

        def reach(c, t):
            g = r - t[:, None] * u
            length = np.sqrt((g * g).sum(axis=1))
            near = total - t * count + 1e-9 * (np.abs(total) + np.abs(t) * count + length + 1)
            return near + (g * self.centre[c]).sum(axis=1) + length * self.radius[c]

        users = len(total)
        first = predicted(np.arange(users), self.unit[self.sample].T)
        place = np.searchsorted(self.sample, own)
        there = np.flatnonzero(self.sample[np.minimum(place, len(self.sample) - 1)] == own)
        first[row[there], place[there]] = -np.inf
        t = below(np.partition(first, -n, axis=1)[:, -n]) if len(self.sample) >= n else np.full(users, -np.inf)
        own = self.back[own]
        order = np.argsort(own, kind="stable")
        row, own = row[order], own[order]
        best, items, rounded = np.full((users, n), -np.inf), np.full((users, n), len(self.items)), np.full((users, n), -np.inf)
        index = np.empty(users, np.int64)
        promise = np.array([reach(c, np.where(np.isfinite(t), t, 0.0)).sum() for c in range(len(self.cells))])
        for c in np.argsort(-promise, kind="stable"):
            a, b = self.cells[c]
            known = np.isfinite(t)
            who = np.flatnonzero(~known | (reach(c, np.where(known, t, 0.0)) >= 0))
            p = predicted(who, self.sorted[:, a:b])
            index[:] = -1
            index[who] = np.arange(len(who))
            lo, hi = np.searchsorted(own, [a, b])
            at = index[row[lo:hi]]
            p[at[at >= 0], own[lo:hi][at >= 0] - a] = -np.inf
            hit = np.flatnonzero((p >= t[who, None]).any(axis=1))
            if not len(hit):
                continue
            who, p = who[hit], p[hit]
            q, rows = np.round(p, 9), np.arange(len(hit))
            found = np.empty((len(hit), min(n, b - a)), np.int64)
            values = np.empty(found.shape)
            for k in range(found.shape[1]):  # the items of a cell ascend
                found[:, k] = j = q.argmax(axis=1)
                values[:, k] = q[rows, j]
                q[rows, j] = -np.inf
            all_ = [np.hstack(x) for x in ((rounded[who], values), (items[who], self.at[a + found]), (best[who], np.take_along_axis(p, found, 1)))]
            order = np.lexsort((all_[1], -all_[0]), axis=-1)[:, :n]
            rounded[who], items[who], best[who] = (np.take_along_axis(x, order, 1) for x in all_)
            t[who] = np.maximum(t[who], below(rounded[who, -1]))
        x, k = np.nonzero(np.isfinite(rounded))  # beyond, places are filled with anything
        return x, self.items[items[x, k]], best[x, k]


def _score(n: int, width: int):
    """Function of a block's users with their ratings and a tile of items: each user's best unrated items of the tile."""
    names = [f"v{i}" for i in range(width)]

    def work(rated: pd.DataFrame, tile: pd.DataFrame) -> pd.DataFrame:
        if not len(rated) or not len(tile):
            return pd.DataFrame({"user_id": [], "item_id": [], "predicted": []})
        tile = _Tile(tile["item_id"].to_numpy(), tile[names].to_numpy(float))
        whole = rated["item_id"].isna().to_numpy()  # the user's sums; the other rows are rated items of the tile
        sums = rated[whole].drop_duplicates("user_id").sort_values("user_id")
        users = sums["user_id"].to_numpy()
        total, count = sums["total"].to_numpy(float), sums["count"].to_numpy(float)
        r, u = (sums[[f"{c}{i}" for i in range(width)]].to_numpy(float) for c in "ru")
        row = np.searchsorted(users, rated["user_id"].to_numpy()[~whole])
        own = np.searchsorted(tile.items, rated["item_id"].to_numpy()[~whole].astype(np.int64))
        order = np.argsort(row, kind="stable")
        row, own = row[order], own[order]
        out = []
        for lo in range(0, len(users), PIECE_USERS):
            now = slice(lo, lo + PIECE_USERS)
            a, b = np.searchsorted(row, [lo, lo + PIECE_USERS])
            at, item, p = tile.best(total[now], count[now], r[now], u[now], row[a:b] - lo, own[a:b], n)
            out.append(pd.DataFrame({"user_id": users[now][at], "item_id": item, "predicted": p}))
        return pd.concat(out, ignore_index=True)

    return work


def recommend_reduced(ratings: DataFrame, n: int = 3, rank: int = 4) -> DataFrame:
    """Like :func:`recommend` with cosine similarity of items reduced to ``rank`` dimensions.

    The item vectors are the first right singular vectors. As the similarity is
    linear in the unit vectors, a user's predictions for a tile of items are one small
    matrix product of the user's sums, and whole cells of near items are ruled out at once.
    """
    rated = stored(ratings.select("user_id", "item_id", "rating").dropna(), "ratings")
    vectors = right_vectors(rated, rank)
    width = rank
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda t, x: t + x * x))
    part = [F.coalesce(F.try_divide(F.get("v", F.lit(i)), norm), F.lit(0.0)).alias(f"v{i}") for i in range(width)]
    unit = stored(vectors.select("item_id", *part), "unit")
    sums = rated.join(unit, "item_id").groupBy("user_id").agg(
        F.sum("rating").alias("total"),
        F.count(F.lit(1)).cast("double").alias("count"),
        *[F.sum(F.col("rating") * F.col(f"v{i}")).alias(f"r{i}") for i in range(width)],
        *[F.sum(f"v{i}").alias(f"u{i}") for i in range(width)],
    )
    users, items, all_ = rated.agg(F.approx_count_distinct("user_id"), F.approx_count_distinct("item_id"), F.count(F.lit(1))).first()
    tasks = _blocks(users, max(BLOCK_USERS, -(-users // shuffle_width(ratings.sparkSession))))  # not fewer than the session's, but for few users
    blocks = max(_blocks(users, WIDE_USERS), _blocks(all_, WIDE_RATINGS), tasks)
    tiles = _blocks(items, WIDE_ITEMS)
    block = _numbered("user_id", blocks)
    tile = _numbered("item_id", tiles)
    left = sums.withColumns({"block": block, "tile": _every(tiles)}).unionByName(
        rated.select("user_id", "item_id").withColumns({"block": block, "tile": tile}), allowMissingColumns=True
    )
    right = unit.withColumns({"tile": tile, "block": _every(blocks)})
    place = [blocks * tiles, "block", "tile"]  # the work is not in proportion to the bytes, by which tasks would be merged
    left, right = left.repartition(*place), right.repartition(*place)
    found = left.groupBy("block", "tile").cogroup(right.groupBy("block", "tile")).applyInPandas(_score(n, width), SCORED)
    return _ranked(found, n)

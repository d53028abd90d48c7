"""Prediction by partial matching over bytes, trained on the corpus and applied to it.

The model is the trie of all byte contexts up to ``ORDER``, kept as tables of
context, next symbol and count. The probability of a symbol starts at the longest
known context; a symbol not seen there costs an escape (method C) and is looked
for one byte shorter, where the symbols of the longer context are excluded.

Every distinct gram (``ORDER`` bytes and a symbol) gets its log probability once,
by joins along the orders. Documents meet their grams block by block: a block's
distinct grams go out, packed into parts by key, and their values come back in
the same packing, so neither the trie nor the counts are ever broadcast or held
by one task. Beyond ``TEAM`` blocks the parts of a team of blocks are merged first
and cut finer, team by team, until one team holds all; values come back the same
way. So a block sends out a bounded number of rows, whatever the size of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkscore.llm.batches import _LOWER, Lookup, Words, counted, distinct, new_powers, slices, text_bytes
from linkscore.llm.blocks import in_blocks
from linkscore.llm.language import id_bucket
from linkscore.runtime import stored

ORDER = 5  # bytes of context; a gram of ORDER + 1 bytes fits a long
START, END = 0xFE, 0xFF  # no byte of UTF-8
SYMBOLS = 256
BLOCK_BYTES = 32 << 20  # text of a block
TEAM = 64  # blocks, or teams, whose parts one task merges; about as many finer parts does it make


def grams(raw: np.ndarray, offsets: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Packed grams of all positions, each text closed by ``END``, and their bounds by text."""
    size = np.diff(offsets) + order + 1  # start marks, bytes, end mark
    at = np.concatenate([[0], np.cumsum(size)])
    total = int(at[-1])
    body, whole = np.ones(total, bool), np.ones(total, bool)
    for i in range(order):
        body[at[:-1] + i] = False
        whole[at[1:] - 1 - i] = False  # grams that would reach into the next text
    body[at[1:] - 1] = False
    laid = np.full(total + 8, START, np.uint8)
    laid[:total][body] = _LOWER[raw]
    laid[at[1:] - 1] = END
    eight = np.ndarray((total,), ">u8", laid.data, 0, (1,))  # the eight bytes from each position on
    packed = eight.astype(np.uint64)[whole] >> np.uint64(8 * (7 - order))
    return packed.view(np.int64), np.concatenate([[0], np.cumsum(size - order)])


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of several sorted lists and the sums of their counts."""
    if len(keys) == 1:
        return keys[0], counts[0]
    key, count = np.concatenate([np.zeros(0, np.int64), *keys]), np.concatenate([np.zeros(0, np.int64), *counts])
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    new = np.flatnonzero(np.concatenate([np.ones(min(1, len(key)), bool), key[1:] != key[:-1]]))
    return key[new], np.add.reduceat(count, new) if len(new) else count


class _Counts:
    """Distinct keys with their counts in training rows, merged whenever the lists have doubled."""

    def __init__(self) -> None:
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.merged = 0

    def add(self, key: np.ndarray, learnt: np.ndarray) -> None:
        seen, times = counted(key[learnt])
        other = distinct(key[~learnt])
        self.keys += [seen, other]
        self.counts += [times, np.zeros(len(other), np.int64)]
        if sum(map(len, self.keys)) > 2 * self.merged + 500_000:
            self.result()

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        key, count = _merged(self.keys, self.counts)
        self.keys, self.counts, self.merged = [key], [count], len(key)
        return key, count


def pack(values: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, as their upper bytes are much alike."""
    planes = values.view(np.uint8).reshape(len(values), -1).T if len(values) else values
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(raw: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return planes.reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind).ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences."""
    return pack(np.diff(keys, prepend=np.int64(0)))


def unpack_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(unpack(raw, np.int64))


PACKED = "block long, is_gram boolean, part int, keys binary, vals binary"
COUNTED = f"{PACKED}, wide boolean"  # counts of a team may need 64 bits


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.bool_(), pa.int32(), pa.binary(), pa.binary(), pa.bool_())
    columns = list(zip(*rows)) or [()] * 6
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], names=["block", "is_gram", "part", "keys", "vals", "wide"]
    )


def _dictionaries(order: int, parts: int):
    """Arrow function: distinct grams and word hashes of each block with their counts in training rows, in parts."""

    def flush(block: int, own: dict[bool, _Counts]) -> pa.RecordBatch:
        rows = []
        for is_gram, counts in own.items():
            key, count = counts.result()
            part = (key % parts).astype(np.int32)
            at = np.argsort(part, kind="stable")
            key, count, part = key[at], count[at], part[at]
            for p, a, b in zip(*_runs(part)):
                rows.append((block, is_gram, p, pack_keys(key[a:b]), pack(count[a:b].astype(np.int32)), False))
        return _batch(rows)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = new_powers()
        block, own = None, {True: _Counts(), False: _Counts()}
        for batch in batches:
            blocks = batch["block"].to_numpy()
            for b, first, last in zip(*_runs(blocks)):
                if block is not None and b != block:
                    yield flush(block, own)
                    own = {True: _Counts(), False: _Counts()}
                block = b
                for table in slices(batch.slice(first, last - first)):
                    raw, offsets = text_bytes(table["text"])
                    learnt = ~table["held_out"].to_numpy()
                    key, bounds = grams(raw, offsets, order)
                    own[True].add(key, np.repeat(learnt, np.diff(bounds)))
                    words = Words(raw, offsets, powers, lower=True)
                    own[False].add(words.hash.view(np.int64), np.repeat(learnt, np.diff(words.first)))
        if block is not None:
            yield flush(block, own)

    return work


def _runs(values: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    """Each run of equal values: value, first and end position."""
    head = np.flatnonzero(np.concatenate([np.ones(min(1, len(values)), bool), values[1:] != values[:-1]]))
    return values[head].tolist(), head.tolist(), np.append(head[1:], len(values)).tolist() if len(head) else []


def _totals(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Keys by row of a part, and all its distinct keys with their counts in all blocks."""
    keys = [unpack_keys(x) for x in table["keys"].to_pylist()]
    counts = [unpack(x, np.int64 if wide else np.int32).astype(np.int64) for x, wide in zip(table["vals"].to_pylist(), table["wide"].to_pylist())]
    return keys, *_merged(keys, counts)


def _merge(parts: int):
    """Arrow function: a part of a team's blocks as one dictionary, cut into finer parts."""

    def work(table: pa.Table) -> pa.Table:
        _, key, count = _totals(table)
        part = (key % parts).astype(np.int32)
        at = np.argsort(part, kind="stable")
        key, count, part = key[at], count[at], part[at]
        team, is_gram = table["team"][0].as_py(), table["is_gram"][0].as_py()
        return pa.Table.from_batches([_batch([(team, is_gram, p, pack_keys(key[a:b]), pack(count[a:b]), True) for p, a, b in zip(*_runs(part))])])

    return work


def _hand_down(rows: pa.Table, upper: pa.Table) -> pa.Table:
    """A part of a team's blocks, with the values that its finer parts have got."""
    kind = np.float64 if rows["is_gram"][0].as_py() else np.int64
    key = np.concatenate([unpack_keys(x) for x in upper["keys"].to_pylist()])
    value = np.concatenate([unpack(x, kind) for x in upper["vals"].to_pylist()])
    at = np.argsort(key)
    key, value = key[at], value[at]
    values = [pack(value[np.searchsorted(key, unpack_keys(x))]) for x in rows["keys"].to_pylist()]
    return rows.select(["block", "is_gram", "part", "keys"]).append_column("vals", pa.array(values, pa.binary()))


def _climb(packed: DataFrame, n_blocks: int) -> tuple[list[DataFrame], list[int]]:
    """Dictionaries by level, the blocks' first, and the parts of each level.

    Parts are odd in number, so that the last byte of a gram does not choose its
    part, and those of a level divide those of the next.
    """
    levels, parts, units = [packed], [_first_parts(n_blocks)], n_blocks
    while units > TEAM:
        units = -(-units // TEAM)
        parts.append(parts[-1] * (TEAM - 1 | 1))
        levels[-1] = levels[-1].withColumn("team", F.pmod(F.xxhash64("block"), F.lit(units)))
        levels.append(stored(levels[-1].groupBy("team", "is_gram", "part").applyInArrow(_merge(parts[-1]), COUNTED), "packed"))
    return levels, parts


def _first_parts(n_blocks: int) -> int:
    return max(8, min(n_blocks, TEAM)) | 1


def _descend(model: DataFrame, levels: list[DataFrame], parts: list[int]) -> DataFrame:
    """The values of the last level's dictionaries, for those of the blocks."""
    for level, width in zip(reversed(levels[:-1]), reversed(parts[:-1])):
        upper = model.select(F.col("block").alias("team"), "is_gram", F.pmod("part", F.lit(width)).alias("part"), "keys", "vals")
        keys = "team", "is_gram", "part"
        model = stored(level.drop("vals", "wide").groupBy(*keys).cogroup(upper.groupBy(*keys)).applyInArrow(_hand_down, PACKED), "model")
    return model


def _gram_counts(table: pa.Table) -> pa.Table:
    """A part's distinct grams with their counts."""
    _, key, count = _totals(table)
    return pa.table({"key": key, "n": count})


def _word_counts(table: pa.Table) -> pa.Table:
    """A part's rows with the words' counts in all blocks, and the part's own totals."""
    keys, key, count = _totals(table)
    values = [pack(count[np.searchsorted(key, k)].astype(np.int64)) for k in keys]
    total, kinds = int(count.sum()), int((count > 0).sum())
    return table.drop_columns(["vals", "wide"]).append_column("vals", pa.array(values, pa.binary())).append_column(
        "total", pa.array([total] * len(keys), pa.int64())
    ).append_column("kinds", pa.array([kinds] * len(keys), pa.int64()))


def _gram_values(rows: pa.Table, scores: pa.Table) -> pa.Table:
    """A part's rows with the grams' scores."""
    key, score = scores["key"].to_numpy(), scores["score"].to_numpy()
    at = np.argsort(key)
    key, score = key[at], score[at]
    values = [pack(score[np.searchsorted(key, unpack_keys(x))].astype(np.float64)) for x in rows["keys"].to_pylist()]
    return rows.append_column("vals", pa.array(values, pa.binary()))


def _log(x: Column) -> Column:
    return F.log10(x.cast("double"))


def gram_scores(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """``key, score``: log10 probability of each distinct gram's symbol after its context.

    ``counts`` has ``key, n``, every gram once, ``n`` 0 where it is only to be
    scored. For a context c of length k with count N and Q distinct symbols the
    escape is Q / (N + Q). When a search arrives at length k from its longer
    context d, the symbols of d are excluded there: N falls by their counts, Q by
    their number. ``chain`` adds up the escapes from a context down to the empty
    one, so the escapes between two lengths are a difference.
    """
    mask = lambda bytes_: F.lit((1 << (8 * bytes_)) - 1)
    tries: list[DataFrame] = [None] * (order + 1)  # by length: ctx, sym, n
    known = counts.where("n > 0").select(
        F.shiftright("key", 8).alias("ctx"), F.col("key").bitwiseAND(mask(1)).alias("sym"), "n"
    )
    tries[order] = known
    for k in range(order - 1, -1, -1):
        tries[k] = stored(
            tries[k + 1].groupBy(F.col("ctx").bitwiseAND(mask(k)).alias("ctx"), "sym").agg(F.sum("n").alias("n")), "trie"
        )
    # contexts: total, distinct; below: denominator on arrival one byte shorter, and the chain of escapes
    contexts: list[DataFrame] = [None] * (order + 1)
    base = tries[0].groupBy("ctx").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
    contexts[0] = base.select("ctx", "total", "kinds", F.lit(None).cast("long").alias("below"), F.lit(0.0).alias("chain"))
    for k in range(1, order + 1):
        upper = tries[k - 1].select(F.col("ctx").alias("up"), F.col("sym").alias("_sym"), F.col("n").alias("up_n"))
        own = (
            tries[k]
            .withColumn("up", F.col("ctx").bitwiseAND(mask(k - 1)))
            .join(upper.withColumnRenamed("_sym", "sym"), ["up", "sym"])
            .groupBy("ctx", "up")
            .agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"), F.sum("up_n").alias("hidden"))
        )
        parent = contexts[k - 1].select(
            F.col("ctx").alias("up"), F.col("total").alias("p_total"), F.col("kinds").alias("p_kinds"), F.col("chain").alias("p_chain")
        )
        below = F.col("p_total") - F.col("hidden") + F.col("p_kinds") - F.col("kinds")
        escape = F.when(below > 0, _log(F.col("p_kinds") - F.col("kinds")) - _log(below)).otherwise(0.0)
        contexts[k] = stored(
            own.join(parent, "up").select(
                "ctx", "total", "kinds", below.alias("below"), (F.col("p_chain") + escape).alias("chain")
            ),
            "contexts",
        )
    # grams known at the full length
    top = contexts[order].select("ctx", "total", "kinds", "chain")
    whole = counts.withColumn("ctx", F.shiftright("key", 8)).join(top, "ctx", "left")
    seen = whole.where("n > 0").select("key", (_log(F.col("n")) - _log(F.col("total") + F.col("kinds"))).alias("score"))
    out = [seen]
    # the others go down: ``cost`` holds the escape of the longest known context, ``from_chain`` its chain
    rest = stored(
        whole.where("n = 0").select(
            "key",
            (_log(F.col("kinds")) - _log(F.col("total") + F.col("kinds"))).alias("cost"),
            F.col("chain").alias("from_chain"),
            F.col("chain").alias("last_chain"),
            F.lit(None).cast("long").alias("arrive"),
        ),
        "rest",
    )
    for k in range(order, -1, -1):
        if k < order:
            node = contexts[k].select("ctx", "total", "kinds", "chain", F.col("below").alias("next_below"))
            step = (
                rest.withColumn("ctx", F.shiftright("key", 8).bitwiseAND(mask(k)))
                .join(node, "ctx", "left")
                .withColumn("sym", F.col("key").bitwiseAND(mask(1)))
                .join(tries[k].withColumnRenamed("n", "times"), ["ctx", "sym"], "left")
            )
            total = F.col("total") + F.col("kinds")
            # first known context: no exclusion; later ones: ``arrive`` is the denominator after exclusion
            reached = F.when(F.col("cost").isNull(), _log(F.col("times")) - _log(total)).otherwise(
                F.col("cost") + F.col("from_chain") - F.col("last_chain") + _log(F.col("times")) - _log(F.col("arrive"))
            )
            fresh = F.col("cost").isNull() & F.col("total").isNotNull()
            step = stored(
                step.select(
                    "key",
                    F.when(F.col("times").isNotNull(), reached).alias("score"),
                    F.when(fresh, _log(F.col("kinds")) - _log(total)).otherwise(F.col("cost")).alias("cost"),
                    F.when(fresh, F.col("chain")).otherwise(F.col("from_chain")).alias("from_chain"),
                    F.coalesce("chain", "last_chain").alias("last_chain"),
                    F.col("next_below").alias("arrive"),
                ),
                "rest",
            )
            out.append(step.where("score IS NOT NULL").select("key", "score"))
            rest = step.where("score IS NULL").drop("score")
        else:
            rest = rest.join(
                contexts[k].select(F.col("ctx").alias("_ctx"), F.col("below").alias("_below")),
                F.shiftright("key", 8) == F.col("_ctx"),
                "left",
            ).select("key", "cost", "from_chain", "last_chain", F.col("_below").alias("arrive"))
    # shorter than the empty context: the symbols that no training text has, all alike
    kinds = contexts[0].agg(F.max("kinds")).first()[0] or 0
    alike = float(np.log10(max(1, SYMBOLS - kinds)))
    unseen = rest.select("key", (F.coalesce(F.col("cost") + F.col("from_chain"), F.lit(0.0)) - alike).alias("score"))
    out.append(unseen)
    scored = out[0]
    for more in out[1:]:
        scored = scored.unionByName(more)
    return scored


def _block_lookup(model: pa.Table, is_gram: bool, kind: type) -> Lookup:
    own = model.filter(model["is_gram"] if is_gram else pc.invert(model["is_gram"]))
    # keys first, so that their parts are gone when the values come
    keys = np.concatenate([np.zeros(0, np.int64), *[unpack_keys(x) for x in own["keys"].to_pylist()]])
    at = np.argsort(keys)
    keys = keys[at]
    values = np.concatenate([np.zeros(0, kind), *[unpack(x, kind) for x in own["vals"].to_pylist()]])
    return Lookup(keys, values[at])


def _score_block(order: int):
    """Arrow function for one block: its rows, its grams' scores, its words' training counts."""

    def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        run = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
        return run[bounds[1:]] - run[bounds[:-1]]

    def work(rows: pa.Table, model: pa.Table) -> pa.Table:
        powers = new_powers()
        gram_score, word_count = _block_lookup(model, True, np.float64), _block_lookup(model, False, np.int64)
        out = []
        for table in slices(rows):
            raw, offsets = text_bytes(table["text"])
            own, bounds = grams(raw, offsets, order)
            words = Words(raw, offsets, powers, lower=True)
            count = word_count(words.hash.view(np.int64))
            out.append(
                pa.table(
                    {
                        "doc_id": table["doc_id"],
                        "held_out": table["held_out"],
                        "n_words": np.diff(words.first),
                        "known_words": sums(count > 0, words.first).astype(np.int64),
                        "word_logs": sums(np.log10(count + 1.0), words.first),
                        "score": sums(gram_score(own), bounds),
                    }
                )
            )
        return pa.concat_tables(out) if out else _EMPTY

    return work


_EMPTY = pa.table(
    {
        "doc_id": pa.array([], pa.int64()),
        "held_out": pa.array([], pa.bool_()),
        "n_words": pa.array([], pa.int64()),
        "known_words": pa.array([], pa.int64()),
        "word_logs": pa.array([], pa.float64()),
        "score": pa.array([], pa.float64()),
    }
)


def score_documents(docs: DataFrame, order: int = ORDER, block_bytes: int = BLOCK_BYTES, hold_out: tuple[int, int] = (7, 2)) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Rows whose ``crc32`` of the id as text leaves ``hold_out`` are scored but not
    learnt from (a missing id counts as empty text). ``base_score`` is the sum of
    ``log10((c + 1) / (N + 1 * (V + 1)))`` over the words and one end token;
    words are told apart by 64-bit hashes. ``score`` is the log10 probability of
    the text's bytes with A-Z lower-cased and an end mark. A null text is an empty
    one. Without training rows every symbol is equally likely. Repeated ids stay
    apart, texts of any length count whole, other columns are left out, no rows give
    no rows.
    """
    modulus, rest = hold_out
    rows = in_blocks(docs.select("doc_id", "text"), block_bytes).withColumn(
        "held_out", id_bucket(F.col("doc_id"), modulus) == rest
    )
    n_blocks = rows.select("block").distinct().count()
    work = _dictionaries(order, _first_parts(n_blocks))
    levels, widths = _climb(stored(rows.select("block", "held_out", "text").mapInArrow(work, COUNTED), "packed"), n_blocks)
    packed, parts = levels[-1], widths[-1]
    gram_rows, word_rows = packed.where("is_gram"), packed.where("NOT is_gram")
    counts = stored(gram_rows.groupBy("part").applyInArrow(_gram_counts, "key long, n long"), "counts")
    scores = gram_scores(counts, order).withColumn("part", (F.col("key") % parts).cast("int"))
    gram_model = (
        gram_rows.drop("vals", "wide").groupBy("part").cogroup(scores.groupBy("part")).applyInArrow(_gram_values, PACKED)
    )
    word_model = stored(
        word_rows.groupBy("part").applyInArrow(_word_counts, f"{PACKED}, total long, kinds long"), "vocabulary"
    )
    totals = word_model.groupBy("part").agg(F.max("total").alias("total"), F.max("kinds").alias("kinds"))
    totals = totals.agg(F.sum("total").alias("words"), F.sum("kinds").alias("kinds")).first()
    ends = rows.where(~F.col("held_out")).count()
    n, v = int(totals["words"] or 0) + ends, int(totals["kinds"] or 0) + (1 if ends else 0)
    model = _descend(gram_model.unionByName(word_model.drop("total", "kinds")), levels, widths)
    scored = (
        rows.select("block", "doc_id", "held_out", "text")
        .groupBy("block")
        .cogroup(model.groupBy("block"))
        .applyInArrow(
            _score_block(order),
            "doc_id long, held_out boolean, n_words long, known_words long, word_logs double, score double",
        )
    )
    end_log, scale = float(np.log10(ends + 1)), float(np.log10(n + v + 1))
    tokens = F.col("n_words") + 1
    return scored.select(
        "doc_id",
        "held_out",
        tokens.alias("n_tokens"),
        (F.col("known_words") + F.lit(1 if ends else 0)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("word_logs") + F.lit(end_log) - tokens * F.lit(scale)).alias("base_score"),
        "score",
    )

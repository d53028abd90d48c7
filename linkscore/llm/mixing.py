"""Mixing sources to target weights by Sainte-Lague apportionment, in DataFrame functions only.

Targets are in words. The mix is made of blocks of equal size: the blocks go to
sources, and those of a source to its shards, by highest quotients
``weight / (2 k + 1)``. A shard lays its documents on a ring in seeded order and
takes its blocks one after the other from a seeded start, round and round.
A large source has many shards, so no task orders more than one shard.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkscore.runtime import stored

BLOCK_WORDS = 32
SHARD_WORDS = 1_000_000
WEIGHTS = (3, 1, 2)
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """``source, source_size`` -> ``nth, weight, target``.

    Sources take weights in turn by code point, null last, and share 150% of all
    sizes by weight. A target stops at twice its source's size; the excess goes
    to the others by weight. The sources that stop are those of the smallest
    ``size / weight``; they are found with prefix sums in whole numbers, which
    gives the same as sharing again and again. One row per source, one window.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    ranked = sources.withColumn("nth", F.row_number().over(order)).withColumn(
        "weight", F.element_at(cycle, ((F.col("nth") - 1) % len(weights) + 1).cast("int"))
    )
    cap = F.col("source_size") * 2
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), "nth").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = (
        ranked.withColumn("_all", F.sum("source_size").over(every))
        .withColumn("_weights", F.sum("weight").over(every))
        .withColumn("_cap_before", F.coalesce(F.sum(cap).over(by_ratio), F.lit(0)))
        .withColumn("_weight_before", F.coalesce(F.sum("weight").over(by_ratio), F.lit(0)))
    )
    full = 2 * cap * (F.col("_weights") - F.col("_weight_before")) <= F.col("weight") * (
        3 * F.col("_all") - 2 * F.col("_cap_before")
    )
    level = before.withColumn("_full", full)
    capped = F.when(F.col("_full"), cap).otherwise(0)
    held = F.when(F.col("_full"), F.col("weight")).otherwise(0)
    rest = level.withColumn("_left", 3 * F.col("_all") - 2 * F.sum(capped).over(every)).withColumn(
        "_share", 2 * (F.col("_weights") - F.sum(held).over(every))
    )
    target = F.when(F.col("_full"), cap.cast("double")).otherwise(
        F.try_divide((F.col("weight") * F.col("_left")).cast("double"), F.col("_share").cast("double"))
    )
    return rest.select("source", "source_size", "nth", "weight", target.alias("target"))


def apportion(parties: DataFrame, by: Sequence[str], party: str, weight: str, seats: str, name: str) -> DataFrame:
    """Sainte-Lague: add ``name``, the seats of each ``party`` out of the ``seats`` of its group ``by``.

    ``weight`` is a double, ``seats`` one number per group. Rounded shares are
    within half a seat each; only the seats that are still missing (or too many)
    are ranked by quotient. With n parties a party of share s gets at most
    ``(missing + n) * s + 1`` of them, so about 2.5 n quotients are ranked
    whatever the number of seats. Ties go to the smaller party.
    """
    group = Window.partitionBy(*by)
    share = F.coalesce(F.try_divide(F.col(weight), F.sum(weight).over(group)), F.lit(0.0))
    start = parties.withColumn("_share", share).withColumn(
        "_seats", F.floor(F.col("_share") * F.col(seats) + F.lit(0.5)).cast("long")
    )
    start = start.withColumn("_missing", F.col(seats) - F.sum("_seats").over(group)).withColumn(
        "_n", F.count(F.lit(1)).over(group)
    )
    reach = F.ceil((F.abs("_missing") + F.col("_n")) * F.col("_share")).cast("long") + 1
    low = F.when(F.col("_missing") > 0, F.col("_seats")).otherwise(F.greatest(F.lit(0), F.col("_seats") - reach))
    high = F.when(F.col("_missing") > 0, F.col("_seats") + reach - 1).otherwise(F.col("_seats") - 1)
    quotients = (
        start.where((F.col("_missing") != 0) & (F.col(weight) > 0) & (low <= high))
        .select(*by, party, "_missing", F.col(weight).alias("_w"), F.explode(F.sequence(low, high)).alias("_k"))
        .withColumn("_q", F.col("_w") / (2 * F.col("_k") + 1))
    )
    best = Window.partitionBy(*by).orderBy(F.col("_q").desc(), party)
    worst = Window.partitionBy(*by).orderBy(F.col("_q"), F.col(party).desc())
    moved = (
        quotients.withColumn(
            "_nth",
            F.when(F.col("_missing") > 0, F.row_number().over(best)).otherwise(F.row_number().over(worst)),
        )
        .where(F.col("_nth") <= F.abs("_missing"))
        .groupBy(*by, party)
        .agg(F.sum(F.signum("_missing")).cast("long").alias("_moved"))
    )
    return (
        start.join(moved, [*by, party], "left")
        .withColumn(name, F.col("_seats") + F.coalesce("_moved", F.lit(0)))
        .select(*parties.columns, name)
    )


def _number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def mix(
    docs: DataFrame,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: str = SEED,
    weights: Sequence[int] = WEIGHTS,
) -> DataFrame:
    """How many words of each document the mix takes.

    Returns ``doc_id, source, size, source_size, target, taken``, one row per row
    of ``docs``. A source's ``taken`` differs from its target by rounding to
    blocks: one block per source and, at the limit of twice the size, one per
    shard. No row is taken more than twice over. Null text has size 0; a null
    source is a source; rows of equal ``doc_id`` and size are interchangeable, so
    reruns give the same rows. Texts of any length count whole. Other columns are
    left out, also those named like the result's. No rows give no rows.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key))
    sizes = stored(
        docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size")),
        "sizes",
    )
    totals = source_targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), weights)
    seats = F.floor((3 * F.sum("source_size").over(Window.partitionBy()) + block_words) / (2 * block_words))
    quotas = apportion(
        totals.withColumn("_all", F.lit(0)).withColumn("_total", seats.cast("long")), ["_all"], "nth", "target", "_total", "blocks"
    )
    sources = stored(
        quotas.select(
            "source",
            "nth",
            "source_size",
            "target",
            F.least("blocks", F.floor(2 * F.col("source_size") / block_words).cast("long")).alias("blocks"),
            F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long").alias("shards"),
        ),
        "sources",
    )
    placed = (
        sizes.withColumnRenamed("source", "_source")
        .join(sources, F.col("_source").eqNullSafe(F.col("source")))
        .withColumn("_digest", digest)
        .withColumn("shard", _number(F.col("_digest")) % F.col("shards"))
    )
    shard_sizes = placed.groupBy("nth", "shard").agg(
        F.sum("size").alias("shard_size"), F.max("blocks").alias("blocks")
    )
    shard_quotas = apportion(
        shard_sizes.withColumn("_weight", F.col("shard_size").cast("double")), ["nth"], "shard", "_weight", "blocks", "_quota"
    )
    words = F.least("_quota", F.floor(2 * F.col("shard_size") / block_words).cast("long")) * block_words
    ring = _number(F.md5(F.concat_ws(":", F.lit(seed), F.col("nth"), F.col("shard"))))
    rings = stored(
        shard_quotas.select(
            "nth",
            "shard",
            "shard_size",
            F.coalesce(F.try_divide(words, F.col("shard_size")).cast("long"), F.lit(0)).alias("rounds"),
            F.coalesce(F.try_mod(words, F.col("shard_size")), F.lit(0)).alias("rest"),
            (ring % F.greatest(F.lit(1), F.floor(F.col("shard_size") / block_words)) * block_words).alias("begin"),
        ),
        "rings",
    )
    order = Window.partitionBy("nth", "shard").orderBy("_digest", "doc_id", "size")
    laid = placed.withColumn("_to", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn(
        "_from", F.col("_to") - F.col("size")
    )
    stop = F.col("begin") + F.col("rest")
    zero = F.lit(0)
    straight = F.greatest(zero, F.least(F.col("_to"), stop) - F.greatest(F.col("_from"), F.col("begin")))
    wrapped = F.greatest(zero, F.least(F.col("_to"), stop - F.col("shard_size")) - F.col("_from"))
    return laid.join(rings, ["nth", "shard"]).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("rounds") * F.col("size") + straight + wrapped).cast("long").alias("taken"),
    )

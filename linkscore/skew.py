"""Joins and pairings whose hot keys are spread over many tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkscore.runtime import cut, shuffle_width, stored

HOT_ROWS = 200_000  # rows of one key that one task may take
PAIRS_PER_TASK = 10_000_000  # rows of a join that one task makes


def block_counts(df: DataFrame, keys: Sequence[str], rows_per_block: int) -> DataFrame:
    """Keys holding more than ``rows_per_block`` rows, with the blocks they need.

    At most ``rows / rows_per_block`` keys can qualify.
    """
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > rows_per_block)
        .select(*keys, F.ceil(F.col("_rows") / rows_per_block).cast("int").alias("_blocks"))
    )


def salted_join(
    big: DataFrame,
    other: DataFrame,
    keys: Sequence[str],
    spread: Column,
    how: str = "inner",
    rows_per_block: int = HOT_ROWS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi-join in which ``big`` rows of a hot key are split into blocks.

    ``spread`` is a column of ``big`` whose hash chooses the block; the rows
    of ``other`` are repeated once per block of their key. Works for inner
    and left joins (``big`` on the left). The hot keys come from a pass over
    ``big`` of its own: give a table that is written, or the list itself (``hot``,
    as :func:`block_counts` makes it) where it is known.
    """
    keys = list(keys)
    if hot is None:
        hot = cut(block_counts(big, keys, rows_per_block))  # few rows, needed on both sides
    if hot.isEmpty():  # nothing to split: the planner's own join
        return big.join(other, keys, how)
    left = (
        big.join(hot, keys, "left")
        .withColumn(
            "_salt",
            F.when(F.col("_blocks").isNull(), F.lit(0)).otherwise(
                F.pmod(F.xxhash64(spread), F.col("_blocks")).cast("int")
            ),
        )
        .drop("_blocks")
    )
    right = (
        other.join(hot, keys, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_blocks"), F.lit(1)) - 1)))
        .drop("_blocks")
    )
    return left.join(right, keys + ["_salt"], how).drop("_salt")


def grid_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_spread: Column, right_spread: Column
) -> DataFrame:
    """Inner equi-join whose result may be far larger than its sides.

    The rows of a key are split by what the key makes, not by what it holds: both sides are
    cut into blocks, every block of one meets every block of the other, and there are as many
    tasks as the result needs. Both sides are read twice, so give written tables.
    """
    keys = list(keys)
    sides = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_l")).join(right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_r")), keys)
    made = stored(sides.withColumn("_made", F.col("_l").cast("double") * F.col("_r")), "made")
    wide = F.col("_made") > PAIRS_PER_TASK
    rows = F.sqrt(F.lit(float(PAIRS_PER_TASK)))  # a square block has the least copies; no block is longer than HOT_ROWS
    length = F.least(F.lit(float(HOT_ROWS)), F.greatest(rows, PAIRS_PER_TASK / F.least("_l", "_r")))
    cuts = made.where(wide).select(*keys, *[F.ceil(F.col(c) / length).cast("int").alias(f"{c}n") for c in ("_l", "_r")])
    tasks = max(shuffle_width(left.sparkSession), int((made.agg(F.sum("_made")).first()[0] or 0) // PAIRS_PER_TASK) + 1)
    if cuts.isEmpty():
        return left.repartition(tasks, *keys).join(right.repartition(tasks, *keys), keys)
    block = lambda spread, n: F.coalesce(F.pmod(F.xxhash64(spread), F.col(n)).cast("int"), F.lit(0))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.coalesce(F.col(n), F.lit(1)) - 1))
    place = [*keys, "_i", "_j"]
    a = left.join(cuts, keys, "left").withColumn("_i", block(left_spread, "_ln")).withColumn("_j", every("_rn")).drop("_ln", "_rn")
    b = right.join(cuts, keys, "left").withColumn("_j", block(right_spread, "_rn")).withColumn("_i", every("_ln")).drop("_ln", "_rn")
    return a.repartition(tasks, *place).join(b.repartition(tasks, *place), place).drop("_i", "_j")


def blocked_pairs(
    df: DataFrame,
    group: str,
    item: str,
    payload: Sequence[str] = (),
    rows_per_block: int = 2_000,
) -> DataFrame:
    """Item pairs ``a < b`` that share a group, for co-occurrence counting.

    A large group is cut into item blocks; every block pair is joined in a
    task of its own, and the caller aggregates the pairs right away.
    """
    need = block_counts(df, [group], rows_per_block)
    spread = df.join(need, [group], "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
    own = F.pmod(F.xxhash64(item), F.col("_blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    left = spread.select(
        group,
        F.col(item).alias(f"{item}_a"),
        *[F.col(c).alias(f"{c}_a") for c in payload],
        own.alias("_i"),
        other.alias("_j"),
    )
    right = spread.select(
        group,
        F.col(item).alias(f"{item}_b"),
        *[F.col(c).alias(f"{c}_b") for c in payload],
        own.alias("_j"),
        other.alias("_i"),
    )
    pairs = left.join(right, [group, "_i", "_j"]).where(F.col(f"{item}_a") < F.col(f"{item}_b"))
    return pairs.drop("_i", "_j")

"""Global order without a one-task window.

Row numbers, running sums and exact percentiles over a whole table are built
from a range partitioning plus one small offset per range, so no task ever
sees more than one range of the rows, however the keys are distributed: the
range bounds use *all* order columns, and a unique last column therefore
splits a value that a third of the rows share.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkscore.runtime import cut, shuffle_width

_LOCAL = (1 << 33) - 1  # low bits of monotonically_increasing_id


def _ranges(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    n = shuffle_width(df.sparkSession)
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    # the range bounds are sampled per job, hence one materialisation
    return cut(ranged.withColumn("_pos", F.monotonically_increasing_id()))


def number_rows(df: DataFrame, order: Sequence[Column], name: str = "row_no") -> DataFrame:
    """Add a gap-free 1-based row number in the given total order."""
    ranged = _ranges(df, order)
    part = F.shiftright(F.col("_pos"), 33).cast("int")
    sizes = {r[0]: r[1] for r in ranged.groupBy(part).count().collect()}  # one row per range
    offsets, seen = [], 0
    for p in range(max(sizes, default=-1) + 1):
        offsets.append(seen)
        seen += sizes.get(p, 0)
    if not offsets:
        return ranged.drop("_pos").withColumn(name, F.lit(0).cast("long"))
    offset = F.array(*[F.lit(o).cast("long") for o in offsets])[part]
    return ranged.withColumn(
        name, offset + F.col("_pos").bitwiseAND(F.lit(_LOCAL)) + 1
    ).drop("_pos")


def running_sums(
    df: DataFrame,
    order: Sequence[Column],
    sums: Mapping[str, str],
    by: Sequence[str] = (),
) -> DataFrame:
    """Inclusive running sums ``{new column: source column}`` per ``by`` group.

    ``order`` must be a total order inside a group. A group may span many
    ranges; only the groups that cross a range border need an offset, and
    there are fewer of those than ranges, which bounds the broadcast.
    """
    by = list(by)
    ranged = _ranges(df, [F.col(c) for c in by] + list(order)).withColumn(
        "_part", F.shiftright(F.col("_pos"), 33).cast("int")
    )
    local = Window.partitionBy("_part", *by).orderBy("_pos")
    out = ranged
    for new, old in sums.items():
        out = out.withColumn(new, F.sum(old).over(local))
    totals = ranged.groupBy("_part", *by).agg(
        *[F.sum(old).alias(f"_o_{new}") for new, old in sums.items()]
    )
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_part",
        *[F.col(c).alias(f"_g_{c}") for c in by],
        *[F.sum(f"_o_{new}").over(before).alias(f"_b_{new}") for new in sums],
        F.row_number().over(Window.partitionBy(*by).orderBy("_part")).alias("_nth"),
    ).where("_nth > 1").withColumnRenamed("_part", "_p")
    match = F.col("_part") == F.col("_p")
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    out = out.join(F.broadcast(offsets), match, "left")
    for new in sums:
        out = out.withColumn(new, F.col(new) + F.coalesce(F.col(f"_b_{new}"), F.lit(0)))
    return out.select(*df.columns, *sums)


def percentiles(
    df: DataFrame, value: str, probs: Mapping[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact linearly interpolated percentiles of ``value``, one row per group.

    Works on value counts (combined before the shuffle), so repeated values
    cost nothing and no group is gathered in one task.
    """
    by = list(by)
    keyed = df if by else df.withColumn("_all", F.lit(1))
    keys = by or ["_all"]
    counts = keyed.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(
        F.count(F.lit(1)).alias("_n")
    )
    run = running_sums(counts, [F.col(value)], {"_cum": "_n"}, keys)
    totals = counts.groupBy(*keys).agg(F.sum("_n").alias("_total"))
    run = run.join(totals, keys)
    picks = []
    for name, p in probs.items():
        at = (F.col("_total") - 1) * F.lit(float(p))
        picks.append(F.min(F.when(F.col("_cum") > F.floor(at), F.col(value))).alias(f"_lo_{name}"))
        picks.append(F.min(F.when(F.col("_cum") > F.ceil(at), F.col(value))).alias(f"_hi_{name}"))
    agg = run.groupBy(*keys).agg(F.max("_total").alias("_total"), *picks)
    outs = []
    for name, p in probs.items():
        at = (F.col("_total") - 1) * F.lit(float(p))
        lo, hi = F.col(f"_lo_{name}").cast("double"), F.col(f"_hi_{name}").cast("double")
        outs.append((lo + (hi - lo) * (at - F.floor(at))).alias(name))
    return agg.select(*by, *outs)

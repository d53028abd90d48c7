"""Weight of evidence and information value of category columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkscore.runtime import cut

EPS = 1e-7  # fixed value: stands in for a zero rate


def require_binary(df: DataFrame, y: str) -> None:
    """Raise unless ``y`` has exactly two distinct values, 0 and 1."""
    row = df.agg(
        F.min(y).alias("lo"),
        F.max(y).alias("hi"),
        F.count(F.when(F.col(y).isNull() | ~F.col(y).isin(0, 1), 1)).alias("other"),
    ).first()
    if row["other"] or row["lo"] != 0 or row["hi"] != 1:
        raise ValueError(f"column {y!r} must hold both 0 and 1 and nothing else")


def _rate(part: Column, total: Column) -> Column:
    share = part / total
    return F.when(share == 0, F.lit(EPS)).otherwise(share)


def woe_table(df: DataFrame, x: str, y: str) -> DataFrame:
    """Counts, weight of evidence and value per category of ``x``.

    The totals are a scalar subquery over the same partial counts, so the
    categories may be many without a one-task window.
    """
    counts = df.groupBy(x).agg(F.sum(y).cast("long").alias("event"), F.sum(1 - F.col(y)).cast("long").alias("nonevent"))
    totals = df.agg(F.struct(F.sum(y).alias("e"), F.sum(1 - F.col(y)).alias("n"))).scalar()
    event, nonevent = _rate(F.col("event"), totals["e"]), _rate(F.col("nonevent"), totals["n"])
    return counts.withColumn("woe", F.log(event / nonevent)).withColumn("iv", (event - nonevent) * F.col("woe"))


def woe_long(df: DataFrame, cols: Sequence[str], y: str) -> DataFrame:
    """``woe_table`` of many columns at once: (column, value, event, nonevent, woe, iv)."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols]))
    counts = (
        df.select(F.col(y).alias("_y"), pairs.alias("p"))
        .groupBy("p.column", "p.value")
        .agg(F.sum("_y").cast("long").alias("event"), F.sum(1 - F.col("_y")).cast("long").alias("nonevent"))
    )
    totals = df.agg(F.struct(F.sum(y).alias("e"), F.sum(1 - F.col(y)).alias("n"))).scalar()
    event, nonevent = _rate(F.col("event"), totals["e"]), _rate(F.col("nonevent"), totals["n"])
    return counts.withColumn("woe", F.log(event / nonevent)).withColumn("iv", (event - nonevent) * F.col("woe"))


def information_values(long: DataFrame) -> DataFrame:
    return long.groupBy("column").agg(F.sum("iv").alias("iv"))


def woe_transform(df: DataFrame, cols: Sequence[str], y: str, max_map: int = 500) -> tuple[DataFrame, DataFrame]:
    """Add ``<column>_WOE`` for every column; also return the long WOE table.

    One aggregation serves all columns. Maps of at most ``max_map`` entries in
    all become literal expressions and cost no join; beyond that every column
    is joined to its map, whose size the adaptive planner measures.
    """
    long = cut(woe_long(df, cols, y))
    entries = long.select("column", "value", "woe").limit(max_map + 1).collect()
    out = df
    for c in cols:
        key = F.col(c).cast("string")
        if len(entries) <= max_map:
            hit = F.lit(None).cast("double")
            for r in entries:
                if r["column"] == c:
                    hit = F.when(key.eqNullSafe(F.lit(r["value"])), F.lit(r["woe"])).otherwise(hit)
            out = out.withColumn(f"{c}_WOE", hit)
        else:
            part = long.where(F.col("column") == c).select(F.col("value").alias("_v"), F.col("woe").alias(f"{c}_WOE"))
            out = out.join(part, key.eqNullSafe(F.col("_v")), "left").drop("_v")
    return out, long

"""Score points and scoring with a card."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def scale(base: float = 600, odds: float = 60, pdo: float = 20) -> tuple[float, float]:
    beta = pdo / math.log(2)
    return base - beta * math.log(odds), beta


def scorecard(coefs: DataFrame, woe: DataFrame, base: float = 600, odds: float = 60, pdo: float = 20) -> DataFrame:
    """(column, value, points) from coefficients (column, coef) and WOE rows.

    The base row has the column ``basePoints`` and comes from the coefficient
    named ``const``. Halves are rounded to even.
    """
    alpha, beta = scale(base, odds, pdo)
    start = coefs.where(F.col("column") == "const").select(
        F.lit("basePoints").alias("column"),
        F.lit("-").alias("value"),
        F.bround(F.lit(alpha) - F.lit(beta) * F.col("coef"), 0).cast("long").alias("points"),
    )
    rows = woe.join(coefs, "column").select(
        "column", "value", F.bround(-F.lit(beta) * F.col("woe") * F.col("coef"), 0).cast("long").alias("points")
    )
    return start.unionByName(rows)


def score_with_card(df: DataFrame, card: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Sum of points per application; a value the card does not know adds nothing.

    The columns are unpivoted and joined to the card once; points of a row are
    summed map-side first because all its values lie in one task.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols]))
    start = card.where(F.col("column") == "basePoints").agg(F.max("points")).scalar()
    points = card.where(F.col("column") != "basePoints").select(
        F.col("column").alias("_c"), F.col("value").alias("_v"), "points"
    )
    long = df.select(F.col(key), pairs.alias("p"))
    hit = (F.col("p.column") == F.col("_c")) & F.col("p.value").eqNullSafe(F.col("_v"))
    return (
        long.join(points, hit, "left")
        .groupBy(key)
        .agg((F.coalesce(F.sum("points"), F.lit(0)) + F.coalesce(start, F.lit(0))).alias("score"))
    )

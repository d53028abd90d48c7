"""The whole score card: bins, WOE, selection, model, evaluation, points."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkscore.operators.binning import apply_bins, apply_category_map, optimal_bins, reduce_categories
from linkscore.operators.card import scorecard
from linkscore.operators.evaluate import areas, ks_table
from linkscore.operators.train import Logit, split, stepwise
from linkscore.operators.woe import require_binary, woe_transform
from linkscore.runtime import cut


@dataclass
class Scorecard:
    card: DataFrame
    ks: DataFrame
    areas: DataFrame
    chosen: list[str]
    scored: DataFrame


def build_scorecard(
    df: DataFrame, key: str, y: str, measures: Sequence[str], categories: Sequence[str], method: int = 4, mmax: int = 5, seed: int = 11
) -> Scorecard:
    """Measures are binned and categories reduced, all by the target; the model
    is chosen backward on 70 % of the rows and judged on the rest."""
    require_binary(df, y)
    data = df.select(key, y, *measures, *categories)
    bins = cut(optimal_bins(data, measures, y, method, mmax))
    for c in measures:
        own = bins.where(F.col("var") == c).select(F.col("newbin").alias("bin"), "lower", "upper")
        data = apply_bins(data, c, own)
    for c in categories:
        data = apply_category_map(data, c, cut(reduce_categories(df, c, y, method, mmax)))
    binned = [f"{c}_BIN" for c in [*measures, *categories]]
    data = cut(data.select(key, y, *binned))
    weighted, maps = woe_transform(data, binned, y)
    weighted = cut(weighted)
    fit_part, test_part = split(weighted, key, 0.7, seed)
    names = [f"{c}_WOE" for c in binned]
    chosen = stepwise(fit_part, y, names, "backward") or names
    model = Logit(fit_part, y, chosen)
    spark = df.sparkSession
    coefs = [("const", model.coef[0])] + [(n[: -len("_WOE")], b) for n, b in zip(chosen, model.coef[1:])]
    card = scorecard(spark.createDataFrame(coefs, "column string, coef double"), maps)
    scored = model.predict(test_part).select(key, y, "p")
    return Scorecard(card, ks_table(scored, "p", y, key), areas(scored, "p", y), chosen, model.predict(weighted).select(key, y, "p"))

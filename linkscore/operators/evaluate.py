"""Model evaluation tables: curves, KS, lift, confusion, folds."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkscore.operators.prepare import uniform
from linkscore.ordered import number_rows, running_sums


def _cumulative(df: DataFrame, score: str, y: str, descending: bool = True) -> DataFrame:
    """(score, pos, n, cum_pos, cum_n, all_pos, all_n), one row per distinct score."""
    counts = df.groupBy(F.col(score).alias("threshold")).agg(
        F.sum(y).cast("long").alias("pos"), F.count(F.lit(1)).alias("n")
    )
    order = F.col("threshold").desc() if descending else F.col("threshold").asc()
    run = running_sums(counts, [order], {"cum_pos": "pos", "cum_n": "n"})
    totals = df.agg(F.struct(F.sum(y).cast("long").alias("p"), F.count(F.lit(1)).alias("n"))).scalar()
    return run.withColumn("all_pos", totals["p"]).withColumn("all_n", totals["n"])


def threshold_curve(df: DataFrame, score: str, y: str, beta: float = 0.5) -> DataFrame:
    """Precision, recall, F1 and F-beta at every distinct score; without positives recall is NULL and both F are 0."""
    c = _cumulative(df, score, y)
    p, r = F.col("cum_pos") / F.col("cum_n"), F.try_divide("cum_pos", "all_pos")

    def f(b: float) -> Column:
        return F.when(p + r > 0, (1 + b * b) * p * r / (b * b * p + r)).otherwise(F.lit(0.0))

    return c.select("threshold", p.alias("precision"), r.alias("recall"), f(1.0).alias("f1"), f(beta).alias("f_beta"))


def roc(df: DataFrame, score: str, y: str) -> DataFrame:
    """False and true positive rate at every distinct score; the rate of an absent class is NULL."""
    c = _cumulative(df, score, y)
    neg, cum_neg = F.col("all_n") - F.col("all_pos"), F.col("cum_n") - F.col("cum_pos")
    return c.select("threshold", F.try_divide(cum_neg, neg).alias("fpr"), F.try_divide("cum_pos", "all_pos").alias("tpr"))


def pr(df: DataFrame, score: str, y: str) -> DataFrame:
    return threshold_curve(df, score, y).select("threshold", "recall", "precision")


def areas(df: DataFrame, score: str, y: str) -> DataFrame:
    """Area under the ROC and the precision-recall curve, trapezoid rule.

    A point's predecessor follows from its own counts, so no lag over the
    whole curve is needed. The precision-recall curve starts at recall 0 with
    the first point's precision. With one class only there is no area (NULL).
    """
    c = _cumulative(df, score, y)
    neg = F.col("n") - F.col("pos")
    before_pos, before_n = F.col("cum_pos") - F.col("pos"), F.col("cum_n") - F.col("n")
    roc_part = neg * (before_pos + F.col("cum_pos")) / 2
    prec = F.col("cum_pos") / F.col("cum_n")
    before_prec = F.when(before_n > 0, before_pos / F.greatest(before_n, F.lit(1))).otherwise(prec)
    pr_part = F.col("pos") * (prec + before_prec) / 2
    p, n = F.max("all_pos"), F.max("all_n") - F.max("all_pos")
    return c.agg(F.try_divide(F.sum(roc_part), p * n).alias("auroc"), F.try_divide(F.sum(pr_part), p).alias("auprc"))


def auc_rank(df: DataFrame, score: str, y: str) -> DataFrame:
    """AUC as the share of (positive, negative) pairs in right order, ties half; NULL without such pairs."""
    c = _cumulative(df, score, y, descending=False)
    neg = F.col("n") - F.col("pos")
    below = F.col("cum_n") - F.col("cum_pos") - neg
    wins = F.sum(F.col("pos") * (below + neg / 2))
    p = F.max("all_pos")
    return c.agg(F.try_divide(wins, p * (F.max("all_n") - p)).alias("auc"))


def best_threshold(curve: DataFrame) -> DataFrame:
    """Threshold of the largest F1; the smallest threshold wins a tie."""
    best = F.max(F.struct(F.round("f1", 9).alias("f1"), (-F.col("threshold")).alias("t")))
    return curve.agg(best.alias("b")).select((-F.col("b.t")).alias("threshold"), F.col("b.f1").alias("f1"))


def _tiles(df: DataFrame, score: str, y: str, key: str, k: int, descending: bool) -> DataFrame:
    """Positives and rows per equal tile; ``k`` rows."""
    order = F.col(score).desc() if descending else F.col(score).asc()
    ranked = number_rows(df.select(score, y, key), [order, F.col(key)], "_nth")
    n = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    tile = (F.floor((F.col("_nth") - 1) * k / n) + 1).cast("int")
    return ranked.groupBy(tile.alias("tile")).agg(F.sum(y).cast("long").alias("pos"), F.count(F.lit(1)).alias("n"))


def ks_table(df: DataFrame, score: str, y: str, key: str, k: int = 20) -> DataFrame:
    """KS table over ``k`` equal tiles of the ascending score; shares of an absent class are NULL."""
    t = _tiles(df, score, y, key, k, descending=False).withColumn("neg", F.col("n") - F.col("pos"))
    whole = Window.partitionBy()  # k rows
    run = Window.orderBy("tile")
    out = t.withColumn("pos_share", F.try_divide(F.col("pos"), F.sum("pos").over(whole))).withColumn(
        "neg_share", F.try_divide(F.col("neg"), F.sum("neg").over(whole))
    )
    out = out.withColumn("pos_cum", F.try_divide(F.sum("pos").over(run), F.sum("pos").over(whole))).withColumn(
        "neg_cum", F.try_divide(F.sum("neg").over(run), F.sum("neg").over(whole))
    )
    out = out.withColumn("ks", F.col("neg_cum") - F.col("pos_cum"))
    return out.drop("n")


def lift_table(df: DataFrame, score: str, y: str, key: str, k: int = 10) -> DataFrame:
    """Lift and Lorenz figures over ``k`` equal tiles of the descending score."""
    t = _tiles(df, score, y, key, k, descending=True)
    whole, run = Window.partitionBy(), Window.orderBy("tile")  # k rows
    share = F.try_divide(F.col("pos"), F.sum("pos").over(whole))
    return t.select(
        "tile",
        "pos",
        share.alias("pos_share"),
        F.try_divide(F.sum("pos").over(run), F.sum("pos").over(whole)).alias("pos_cum"),
        F.lit(1.0 / k).alias("random_share"),
        (F.col("tile") / F.lit(k)).alias("random_cum"),
        (share * k).alias("lift"),
    )


def confusion(df: DataFrame, pred: str, y: str, classes: Sequence = (0, 1), normalize: bool = False) -> DataFrame:
    """Counts of actual class (rows) by predicted class (columns ``pred_<class>``)."""
    counts = [F.count(F.when(F.col(pred) == c, 1)) for c in classes]
    total = F.count(F.lit(1))
    return df.groupBy(y).agg(
        *[(n / total if normalize else n).alias(f"pred_{c}") for n, c in zip(counts, classes)]
    )


def regression_errors(df: DataFrame, pred: str, y: str) -> DataFrame:
    d = F.col(pred) - F.col(y)
    return df.agg(F.avg(d * d).alias("mse"), F.sqrt(F.avg(d * d)).alias("rmse"), F.sum(d * d).alias("rss"))


def accuracy(df: DataFrame, pred: str, y: str) -> DataFrame:
    hit = F.avg((F.col(pred) == F.col(y)).cast("double"))
    return df.agg(hit.alias("accuracy"), (1 - hit).alias("error_rate"))


def assign_folds(df: DataFrame, key: str, k: int, seed: int = 11) -> DataFrame:
    """Reproducible fold number from a seeded hash of the key; no shuffle."""
    text = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    number = F.conv(F.substring(text, 1, 8), 16, 10).cast("long")
    return df.withColumn("fold", F.pmod(number, F.lit(k)).cast("int"))


def compare_models(models: Mapping[str, object], df: DataFrame, key: str, k: int = 5, seed: int = 11) -> DataFrame:
    """Mean and deviation of test AUC per estimator over ``k`` folds, best first.

    Estimators take ``features``/``label`` columns. Each fit is a Spark job
    over the cached folds; only the k scores per model reach the driver.
    """
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    spark = df.sparkSession
    folded = assign_folds(df, key, k, seed).persist()
    rows = []
    for name, est in models.items():
        scores = []
        for f in range(k):
            model = est.fit(folded.where(F.col("fold") != f))
            scores.append(BinaryClassificationEvaluator().evaluate(model.transform(folded.where(F.col("fold") == f))))
        mean = sum(scores) / k
        rows.append((name, mean, (sum((s - mean) ** 2 for s in scores) / k) ** 0.5))
    folded.unpersist()
    rows.sort(key=lambda r: (-r[1], r[0]))
    return spark.createDataFrame(rows, "model string, mean_auc double, sd_auc double")


Fit = Callable[[DataFrame], Callable[[DataFrame], DataFrame]]  # training rows -> adds ``predicted``


def fold_scores(df: DataFrame, fit: Fit, y: str, key: str, k: int = 5, seed: int = 11) -> DataFrame:
    """(fold, n, recall, precision, rmse) of a model fitted on the other folds, one row per fold.

    Recall and precision take ``predicted = 1`` as positive and are NULL without
    a case; ``rmse`` serves regressions. Each fold is one fit and one aggregation.
    """
    out = None
    folded = assign_folds(df, key, k, seed).persist()
    for f in range(k):
        apply = fit(folded.where(F.col("fold") != f).drop("fold"))
        one = _errors(apply(folded.where(F.col("fold") == f)), y).select(F.lit(f).alias("fold"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def _errors(scored: DataFrame, y: str) -> DataFrame:
    hit = F.sum(((F.col("predicted") == 1) & (F.col(y) == 1)).cast("long"))
    d = F.col("predicted").cast("double") - F.col(y).cast("double")
    return scored.agg(
        F.count(F.lit(1)).alias("n"),
        F.try_divide(hit, F.sum((F.col(y) == 1).cast("long"))).alias("recall"),
        F.try_divide(hit, F.sum((F.col("predicted") == 1).cast("long"))).alias("precision"),
        F.sqrt(F.avg(d * d)).alias("rmse"),
    )


def compare_parameters(
    df: DataFrame, params: Sequence[float], fit: Callable[[float], Fit], y: str, key: str, k: int = 5, seed: int = 11
) -> DataFrame:
    """(param, mean_recall, mean_rmse, sd_rmse, best) over ``k`` folds per parameter.

    ``best`` marks the parameter of the largest mean recall, the smallest one on
    a tie. One row per parameter.
    """
    rows = None
    for p in params:
        folds = fold_scores(df, fit(p), y, key, k, seed)
        one = folds.agg(F.avg("recall").alias("mean_recall"), F.avg("rmse").alias("mean_rmse"), F.stddev_pop("rmse").alias("sd_rmse"))
        one = one.select(F.lit(float(p)).alias("param"), "*")
        rows = one if rows is None else rows.unionByName(one)
    top = Window.orderBy(F.desc(F.round("mean_recall", 9)), "param")  # one row per parameter
    return rows.withColumn("best", F.row_number().over(top) == 1)


def shuffle_split(df: DataFrame, key: str, fit: Fit, y: str, times: int = 10, test: float = 0.1, seed: int = 11) -> DataFrame:
    """(split, n, recall, precision, rmse): ``times`` independent splits with a share of ``test`` rows held out."""
    out = None
    for i in range(times):
        low = uniform(F.col(key), seed + i) < test
        one = _errors(fit(df.where(~low))(df.where(low)), y).select(F.lit(i).alias("split"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def importance(spark, model, names: Sequence[str], at_least: float = 0.0) -> DataFrame:
    """Feature importances of a tree model, largest first, cut at a threshold."""
    rows = [(n, float(v)) for n, v in zip(names, model.featureImportances.toArray()) if v >= at_least]
    rows.sort(key=lambda r: (-r[1], r[0]))
    return spark.createDataFrame(rows, "feature string, importance double")

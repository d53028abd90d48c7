"""Queries of the model evaluation family."""

from __future__ import annotations

from pyspark.sql import functions as F

from linkscore.catalog.aggregates import rounded
from linkscore.catalog.registry import query, sql
from linkscore.operators import evaluate as E

CURVE = {
    "d": "SELECT score AS threshold, sum(y) AS pos, count(*) AS n FROM scored GROUP BY score",
    "c": """SELECT threshold, pos, n, sum(pos) OVER w AS cp, sum(n) OVER w AS cn, sum(pos) OVER () AS ap, sum(n) OVER () AS an
      FROM d WINDOW w AS (ORDER BY threshold DESC)""",
    "q": "SELECT *, cp / cn AS p, cp / ap AS r FROM c",
    "f": """SELECT threshold, p, r, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1,
      CASE WHEN p + r > 0 THEN 1.25 * p * r / (0.25 * p + r) ELSE 0 END AS fb FROM q""",
    "a": """SELECT *, lag(cp, 1, 0) OVER (ORDER BY threshold DESC) AS bp, lag(cn, 1, 0) OVER (ORDER BY threshold DESC) AS bn FROM c""",
}
R = "round({0}, 8) + 0.0 AS {1}"


@query(
    "e01_threshold_curve",
    sql(["scored"], CURVE, "SELECT threshold, " + ", ".join(
        R.format(a, b) for a, b in (("p", "precision"), ("r", "recall"), ("f1", "f1"), ("fb", "f_beta"))) + " FROM f"),
)
def _(t):
    return rounded(E.threshold_curve(t("scored"), "score", "y"), 8, "precision", "recall", "f1", "f_beta")


@query("e02_roc", sql(["scored"], CURVE, "SELECT threshold, round((cn - cp) / (an - ap), 8) AS fpr, round(cp / ap, 8) AS tpr FROM c"))
def _(t):
    return rounded(E.roc(t("scored"), "score", "y"), 8, "fpr", "tpr")


@query("e02_pr", sql(["scored"], CURVE, "SELECT threshold, round(r, 8) AS recall, round(p, 8) AS precision FROM q"))
def _(t):
    return rounded(E.pr(t("scored"), "score", "y"), 8, "recall", "precision")


@query(
    "e02_areas",
    sql(["scored"], CURVE, """SELECT round(sum((cn - cp - (bn - bp)) * (cp + bp) / 2.0) / max(ap) / (max(an) - max(ap)), 8) AS auroc,
    round(sum((cp - bp) * (cp / cn + CASE WHEN bn > 0 THEN bp / bn ELSE cp / cn END) / 2) / max(ap), 8) AS auprc FROM a"""),
)
def _(t):
    return rounded(E.areas(t("scored"), "score", "y"), 8, "auroc", "auprc")


@query("e03_best_threshold", sql(["scored"], CURVE, "SELECT threshold, round(f1, 9) AS f1 FROM f ORDER BY round(f1, 9) DESC, threshold LIMIT 1"))
def _(t):
    return E.best_threshold(E.threshold_curve(t("scored"), "score", "y"))


def _tile(k: int, order: str) -> dict:
    return {
        "r": f"SELECT y, CAST(floor((row_number() OVER (ORDER BY score {order}, id) - 1) * {k} / (SELECT count(*) FROM scored)) AS INT) + 1 AS tile FROM scored",
        "g": "SELECT tile, CAST(sum(y) AS BIGINT) AS pos, count(*) - CAST(sum(y) AS BIGINT) AS neg FROM r GROUP BY tile",
        "s": """SELECT tile, pos, neg, pos / sum(pos) OVER () AS ps, neg / sum(neg) OVER () AS ns,
          sum(pos) OVER (ORDER BY tile) / sum(pos) OVER () AS pc, sum(neg) OVER (ORDER BY tile) / sum(neg) OVER () AS nc FROM g""",
    }


@query(
    "e04_ks_table",
    sql(["scored"], _tile(20, "ASC"), """SELECT tile, pos, neg, round(ps, 8) AS pos_share, round(ns, 8) AS neg_share, round(pc, 8) AS pos_cum,
    round(nc, 8) AS neg_cum, round(nc - pc, 8) + 0.0 AS ks FROM s"""),
)
def _(t):
    return rounded(E.ks_table(t("scored"), "score", "y", "id"), 8, "pos_share", "neg_share", "pos_cum", "neg_cum", "ks")


@query(
    "e05_lift_table",
    sql(["scored"], _tile(10, "DESC"), """SELECT tile, pos, round(ps, 8) AS pos_share, round(pc, 8) AS pos_cum, 0.1::DOUBLE AS random_share,
    round(tile / 10, 8) AS random_cum, round(ps * 10, 8) AS lift FROM s"""),
)
def _(t):
    return rounded(E.lift_table(t("scored"), "score", "y", "id"), 8, "pos_share", "pos_cum", "random_cum", "lift")


PRED = {"p": "SELECT *, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS pred FROM scored"}


def _pred(t):
    return t("scored").withColumn("pred", (F.col("score") > 0.5).cast("int"))


@query("e06_confusion", sql(["scored"], PRED, "SELECT y, count(CASE WHEN pred = 0 THEN 1 END) AS pred_0, count(CASE WHEN pred = 1 THEN 1 END) AS pred_1 FROM p GROUP BY y"))
def _(t):
    return E.confusion(_pred(t), "pred", "y")


@query(
    "e06_confusion_share",
    sql(["scored"], PRED, "SELECT y, round(count(CASE WHEN pred = 0 THEN 1 END) / count(*), 8) AS pred_0, round(count(CASE WHEN pred = 1 THEN 1 END) / count(*), 8) AS pred_1 FROM p GROUP BY y"),
)
def _(t):
    return rounded(E.confusion(_pred(t), "pred", "y", normalize=True), 8, "pred_0", "pred_1")


@query(
    "e07_regression_errors",
    sql(["scored"], {}, "SELECT round(avg((score - y) ** 2), 8) AS mse, round(sqrt(avg((score - y) ** 2)), 8) AS rmse, round(sum((score - y) ** 2), 4) AS rss FROM scored"),
)
def _(t):
    return rounded(rounded(E.regression_errors(t("scored"), "score", "y"), 8, "mse", "rmse"), 4, "rss")


@query(
    "e07_accuracy",
    sql(["scored"], PRED, "SELECT round(avg(CAST(pred = y AS INT)), 8) AS accuracy, round(1 - avg(CAST(pred = y AS INT)), 8) AS error_rate FROM p"),
)
def _(t):
    return rounded(E.accuracy(_pred(t), "pred", "y"), 8, "accuracy", "error_rate")


@query(
    "e08_auc_rank",
    sql(["scored"], {
        "g": "SELECT score, sum(y) AS pos, sum(1 - y) AS neg FROM scored GROUP BY score",
        "w": "SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g"},
        "SELECT round(sum(pos * (below + neg / 2)) / sum(pos) / sum(neg), 8) AS auc FROM w"),
)
def _(t):
    return rounded(E.auc_rank(t("scored"), "score", "y"), 8, "auc")


@query(
    "e09_assign_folds",
    "SELECT o_orderkey, CAST(CAST('0x' || substr(md5(concat(CAST(o_orderkey AS STRING), '|11')), 1, 8) AS BIGINT) % 5 AS INT) AS fold FROM orders",
)
def _(t):
    return E.assign_folds(t("orders").select("o_orderkey"), "o_orderkey", 5)

"""Linear models whose work on the rows is one aggregation per fit or round."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkscore.operators.evaluate import assign_folds


def _value(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def normal_sums(df: DataFrame, xs: Sequence[Column | str], y: Column | str, by: Column | None = None) -> dict:
    """Sums of products of the columns and the target: {group: (XtX, Xty, yty, n)}.

    p*(p+1)/2 partial sums per task; one row per group reaches the driver.
    """
    cols = [_value(c) for c in xs]
    t = _value(y)
    p = len(cols)
    aggs = [F.sum(cols[i] * cols[j]).alias(f"g{i}_{j}") for i in range(p) for j in range(i, p)]
    aggs += [F.sum(c * t).alias(f"t{i}") for i, c in enumerate(cols)]
    aggs += [F.sum(t * t).alias("yy"), F.count(t).alias("n")]
    group = F.lit(0) if by is None else by
    out = {}
    for r in df.groupBy(group.alias("_g")).agg(*aggs).collect():
        g = np.zeros((p, p))
        for i in range(p):
            for j in range(i, p):
                g[i, j] = g[j, i] = r[f"g{i}_{j}"]
        out[r["_g"]] = (g, np.array([r[f"t{i}"] for i in range(p)]), r["yy"], r["n"])
    return out


def ols(df: DataFrame, y: str, xs: Sequence[str]) -> DataFrame:
    """(column, coef) of least squares with an intercept, by the normal equations.

    The columns are centred in the same pass order as their means, which keeps
    the equations well conditioned.
    """
    means = df.agg(*[F.avg(c).alias(c) for c in [*xs, y]]).first()
    g, t, _, _ = normal_sums(df, [_value(c) - means[c] for c in xs], _value(y) - means[y])[0]
    if np.linalg.matrix_rank(g) < len(xs):
        raise ValueError("the columns are linearly dependent")
    w = np.linalg.solve(g, t)
    start = means[y] - sum(wi * means[c] for wi, c in zip(w, xs))
    rows = [("const", float(start)), *[(c, float(v)) for c, v in zip(xs, w)]]
    return df.sparkSession.createDataFrame(rows, "column string, coef double")


def ridge_path(df: DataFrame, y: str, xs: Sequence[str], key: str, splits: int = 10, lambdas: int = 30, seed: int = 11):
    """Best of ``exp(i - 10)`` by mean test error over random 90/10 splits.

    Rows are assigned to tenths once; the sums of each tenth suffice for every
    split and every lambda. Columns are centred and divided by their variance.
    Returns (rows of (column, coef) in input units, lambda, errors).
    """
    s = df.agg(*[e.alias(f"{n}_{c}") for c in [*xs, y] for n, e in (("m", F.avg(c)), ("v", F.var_pop(c)))]).first()
    cols = [(_value(c) - s[f"m_{c}"]) / s[f"v_{c}"] for c in xs]
    parts = normal_sums(assign_folds(df, key, splits, seed), cols, _value(y) - s[f"m_{y}"], by=F.col("fold"))
    whole = [sum(p[i] for p in parts.values()) for i in range(2)]
    grid = [math.exp(i - 10) for i in range(lambdas)]
    errors = []
    for lam in grid:
        total = 0.0
        for g, t, yy, _n in parts.values():
            w = np.linalg.solve(whole[0] - g + lam * np.eye(len(xs)), whole[1] - t)
            total += yy - 2 * w @ t + w @ g @ w
        errors.append(total / len(parts))
    best = int(np.argmin(errors))
    w = np.linalg.solve(whole[0] + grid[best] * np.eye(len(xs)), whole[1])
    real = [wi / s[f"v_{c}"] for wi, c in zip(w, xs)]
    start = s[f"m_{y}"] - sum(r * s[f"m_{c}"] for r, c in zip(real, xs))
    rows = [("const", float(start)), *[(c, float(r)) for c, r in zip(xs, real)]]
    return df.sparkSession.createDataFrame(rows, "column string, coef double"), grid[best], errors


def lwlr(df: DataFrame, x: str, y: str, at: Sequence[float], k: float) -> DataFrame:
    """(x, predicted): locally weighted line at the given points, kernel exp(-d^2 / 2k^2).

    The points are a short literal list. Each row adds its weighted sums to
    every point map-side, so the shuffle carries one row per point and task.
    """
    w = F.exp(-F.pow(_value(x) - F.col("at"), 2) / (2.0 * k * k))
    xs, ys = _value(x) - F.col("at"), _value(y)
    sums = (
        df.select("*", F.explode(F.array(*[F.lit(float(a)) for a in at])).alias("at"))
        .groupBy("at")
        .agg(
            F.sum(w).alias("s"), F.sum(w * xs).alias("sx"), F.sum(w * ys).alias("sy"),
            F.sum(w * xs * xs).alias("sxx"), F.sum(w * xs * ys).alias("sxy"),
        )
    )
    det = F.col("s") * F.col("sxx") - F.col("sx") * F.col("sx")
    # the line is written around the point itself, so its value there is the intercept;
    # where all rows lie at one place there is no line and the weighted mean stands in
    return sums.select(F.col("at").alias("x"), F.coalesce(F.try_divide(F.col("sxx") * F.col("sy") - F.col("sx") * F.col("sxy"), det), F.try_divide("sy", "s")).alias("predicted"))


def _dot(xs: Sequence[Column], w: Sequence[float]) -> Column:
    total = F.lit(0.0)
    for c, v in zip(xs, w):
        total = total + c * F.lit(float(v))
    return total


def logistic_ascent(df: DataFrame, y: str, xs: Sequence[Column | str], alpha: float, rounds: int, mean: bool = False) -> list[float]:
    """Full-batch gradient ascent from weights 1; ``mean`` divides the gradient by the rows."""
    cols, t = [_value(c) for c in xs], _value(y)
    w = [1.0] * len(cols)
    for _ in range(rounds):
        err = t - 1.0 / (1.0 + F.exp(-_dot(cols, w)))
        r = df.agg(*[(F.avg if mean else F.sum)(c * err).alias(f"g{i}") for i, c in enumerate(cols)]).first()
        w = [v + alpha * r[f"g{i}"] for i, v in enumerate(w)]
    return w


def pegasos(df: DataFrame, y: str, xs: Sequence[Column | str], lam: float, rounds: int) -> list[float]:
    """Linear SVM by sub-gradient steps over all rows; ``y`` is -1 or 1."""
    cols, t = [_value(c) for c in xs], _value(y)
    n = df.count()
    w = [0.0] * len(cols)
    for step in range(1, rounds + 1):
        wrong = t * _dot(cols, w) < 1.0
        r = df.agg(*[F.sum(F.when(wrong, t * c).otherwise(0.0)).alias(f"g{i}") for i, c in enumerate(cols)]).first()
        w = [(1.0 - 1.0 / step) * v + r[f"g{i}"] / (lam * step) / n for i, v in enumerate(w)]
    return w


def proximal_svm(df: DataFrame, y: str, xs: Sequence[Column | str], mu: float) -> np.ndarray:
    """(weights…, threshold) with (I/mu + EtE) u = EtDe, E = [x, -1]; ``y`` is -1 or 1."""
    cols = [_value(c) for c in xs] + [F.lit(-1.0)]
    g, t, _, _ = normal_sums(df, cols, y)[0]
    return np.linalg.solve(np.eye(len(cols)) / mu + g, t)


def adaboost_stumps(df: DataFrame, y: str, xs: Sequence[str], rounds: int, steps: int = 10) -> list[dict]:
    """Weighted decision stumps; ``y`` is -1 or 1.

    All thresholds of all columns are sums of one aggregation per round. Row
    weights follow from the stumps found so far, so no state is kept.
    """
    t = _value(y)
    ends = df.agg(*[e.cast("double").alias(f"{c}__{n}") for c in xs for n, e in (("lo", F.min(c)), ("hi", F.max(c)))]).first()
    cuts = []
    for c in xs:
        lo, hi = ends[f"{c}__lo"], ends[f"{c}__hi"]
        cuts += [(c, lo + j * (hi - lo) / steps) for j in range(-1, steps + 1)]
    found: list[dict] = []
    weight = F.lit(1.0)
    for _ in range(rounds):
        # "below": at or below the threshold means -1
        said = [F.when(_value(c) <= v, -1.0).otherwise(1.0) for c, v in cuts]
        r = df.agg(F.sum(weight).alias("all"), *[F.sum(F.when(s != t, weight).otherwise(0.0)).alias(f"e{i}") for i, s in enumerate(said)]).first()
        best = None
        for i, (c, v) in enumerate(cuts):
            wrong = r[f"e{i}"] / r["all"]
            for side, err in (("below", wrong), ("above", 1.0 - wrong)):
                if best is None or err < best["error"]:
                    best = {"column": c, "value": v, "side": side, "error": err, "at": i}
        alpha = 0.5 * math.log((1.0 - best["error"]) / max(best["error"], 1e-16))
        best["alpha"] = alpha
        sign = said[best["at"]] * (1.0 if best["side"] == "below" else -1.0)
        weight = weight * F.exp(-F.lit(alpha) * t * sign)
        found.append(best)
        if best["error"] < 1e-12:
            break
    return found


def stump_score(stumps: Sequence[dict]) -> Column:
    total = F.lit(0.0)
    for s in stumps:
        low = F.when(_value(s["column"]) <= s["value"], -1.0).otherwise(1.0)
        total = total + F.lit(s["alpha"] if s["side"] == "below" else -s["alpha"]) * low
    return total


def pca_project(df: DataFrame, cols: Sequence[str], n: int) -> tuple[DataFrame, DataFrame]:
    """Scores ``pc1..n`` with reconstructed columns ``<col>_back``, and the variances.

    The covariance is one aggregation; the small eigen problem is solved once. The
    largest entry of a direction is positive, so that runs agree on its sign.
    """
    means = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
    centred = [_value(c) - means[c] for c in cols]
    g, _, _, rows = normal_sums(df, centred, F.lit(0.0))[0]
    values, vectors = np.linalg.eigh(g / (rows - 1))
    order = np.argsort(values)[::-1][:n]
    v = vectors[:, order]
    v = v * np.sign(np.take_along_axis(v, np.abs(v).argmax(axis=0)[None, :], axis=0))
    scores = [_dot(centred, v[:, j]) for j in range(n)]
    out = df.select("*", *[s.alias(f"pc{j + 1}") for j, s in enumerate(scores)])
    back = [(F.lit(means[c]) + _dot([F.col(f"pc{j + 1}") for j in range(n)], v[i])).alias(f"{c}_back") for i, c in enumerate(cols)]
    variances = df.sparkSession.createDataFrame([(j + 1, float(values[o])) for j, o in enumerate(order)], "pc int, variance double")
    return out.select("*", *back), variances

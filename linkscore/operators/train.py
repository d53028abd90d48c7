"""Training and batch scoring with MLlib, and the logistic regression of the score card."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml import classification as C
from pyspark.ml import regression as R
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkscore.operators.aggregates import undersample
from linkscore.operators.boosting import sweep
from linkscore.operators.evaluate import assign_folds, auc_rank
from linkscore.operators.prepare import uniform

# Tree settings of the training jobs.
SETTINGS: dict[str, dict[str, Any]] = {
    "tree_classify": {"impurity": "gini", "maxDepth": 5, "maxBins": 32},
    "tree_regress": {"impurity": "variance", "maxDepth": 5, "maxBins": 32},
    "forest_classify": {"numTrees": 3, "maxDepth": 4, "maxBins": 32, "seed": 11},
    "forest_regress": {"numTrees": 6, "maxDepth": 4, "maxBins": 32, "seed": 11},
    "gbt_classify": {"maxIter": 3, "maxDepth": 5, "seed": 11},
    "gbt_regress": {"maxIter": 30, "maxDepth": 6, "minInstancesPerNode": 50, "seed": 11},
}


def split(df: DataFrame, key: str, share: float = 0.6, seed: int = 11) -> tuple[DataFrame, DataFrame]:
    """Reproducible split by a hash of the key: the same rows whatever the partitioning."""
    low = uniform(F.col(key), seed) < share
    return df.where(low), df.where(~low)


def with_features(df: DataFrame, xs: Sequence[str], y: str) -> DataFrame:
    filled = df.withColumns({f"_x{i}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for i, c in enumerate(xs)})
    names = [f"_x{i}" for i in range(len(xs))]
    out = VectorAssembler(inputCols=names, outputCol="features").transform(filled).drop(*names)
    return out.withColumn("label", F.col(y).cast("double"))


def estimator(kind: str, **settings):
    """``logistic``, ``nb``, or ``tree``/``forest``/``gbt`` with ``_classify``/``_regress``."""
    if kind == "logistic":
        return C.LogisticRegression(**{"maxIter": 100, **settings})
    if kind == "nb":
        return C.NaiveBayes(**{"modelType": "multinomial", "smoothing": 1.0, **settings})
    classes = {
        "tree_classify": C.DecisionTreeClassifier, "tree_regress": R.DecisionTreeRegressor,
        "forest_classify": C.RandomForestClassifier, "forest_regress": R.RandomForestRegressor,
        "gbt_classify": C.GBTClassifier, "gbt_regress": R.GBTRegressor,
    }
    return classes[kind](**{**SETTINGS[kind], **settings})


def train(df: DataFrame, kind: str, xs: Sequence[str], y: str, **settings) -> PipelineModel:
    """A pipeline that assembles the features and fits the estimator."""
    filled = df.fillna(0, list(xs)).withColumn("label", F.col(y).cast("double"))
    steps = [VectorAssembler(inputCols=list(xs), outputCol="features", handleInvalid="keep"), estimator(kind, **settings)]
    return Pipeline(stages=steps).fit(filled)


def scores(model: PipelineModel, df: DataFrame, xs: Sequence[str]) -> DataFrame:
    """Add ``score``: probability of class 1, or the prediction of a regression."""
    out = model.transform(df.fillna(0, list(xs)))
    if "probability" in out.columns:
        score = vector_to_array("probability")[1]
    else:
        score = F.col("prediction")
    return out.withColumn("score", score.cast("double"))


def score_batch(df: DataFrame, model: PipelineModel | str, key: str, time_col: str, xs: Sequence[str]) -> DataFrame:
    """(key, time, score) of every row with a model or a saved model's folder."""
    fitted = PipelineModel.load(model) if isinstance(model, str) else model
    return scores(fitted, df, xs).select(key, time_col, "score")


def train_balanced(df: DataFrame, xs: Sequence[str], y: str, key: str, n: int | None = None, seed: int = 11, drop_last: int = 0):
    """Logistic model on a class-balanced sample and its exact AUC on the held-out share.

    The sample and the split draw by different seeds: a sample keeps the smallest
    draws of the larger class, so the same draw would leave few of them to the test.
    """
    used = list(xs[: len(xs) - drop_last])
    train_part, test_part = split(undersample(df, y, key, n, seed), key, 0.7, seed + 1)
    model = train(train_part, "logistic", used, y)
    return model, auc_rank(scores(model, test_part, used), "score", y).first()["auc"]


def train_and_score_all(df: DataFrame, xs: Sequence[str], y: str, key: str) -> DataFrame:
    """(key, forest, gbt, tree): three regressions trained on one table, every row scored."""
    out = df
    models = {"forest": "forest_regress", "gbt": "gbt_regress", "tree": "tree_regress"}
    for name, kind in models.items():
        settings = {"maxIter": 9, "maxDepth": 4} if name == "gbt" else {}  # fixed values: settings of this job
        model = train(df, kind, xs, y, **settings)
        out = scores(model, out, xs).withColumnRenamed("score", name).drop("features", "prediction")
    return out.select(key, *models)


def sweep_gbt(df: DataFrame, xs: Sequence[str], y: str, key: str, trees: Sequence[int], depths: Sequence[int]) -> DataFrame:
    """(trees, depth, rmse, auc, cpu_seconds): every cell of the grid on a 60/40 split, as if fitted by itself."""
    return sweep(df, xs, y, key, uniform(F.col(key), 11) < 0.6, trees, depths)


def linear_cv(df: DataFrame, xs: Sequence[str], y: str, kind: str, alphas: Sequence[float], folds: int = 3, key: str | None = None) -> DataFrame:
    """(alpha, rmse) of ridge, lasso or elastic net by cross-validation, best first.

    Folds follow a hash of ``key``, the same whatever the partitioning; without a
    key they are drawn.
    """
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    lr = R.LinearRegression(elasticNetParam={"ridge": 0.0, "lasso": 1.0, "elastic": 0.5}[kind])
    grid = ParamGridBuilder().addGrid(lr.regParam, list(alphas)).build()
    cv = CrossValidator(estimator=lr, estimatorParamMaps=grid, evaluator=RegressionEvaluator(), numFolds=folds, seed=11, parallelism=2)
    if key is not None:
        df, cv = assign_folds(df, key, folds), cv.setFoldCol("fold")
    fitted = cv.fit(with_features(df, xs, y))
    rows = sorted(zip(map(float, alphas), map(float, fitted.avgMetrics)), key=lambda r: r[1])
    return df.sparkSession.createDataFrame(rows, "alpha double, rmse double")


def tree_bins(df: DataFrame, col: str, y: str, depth: int = 3) -> list[float]:
    """Cut points of an entropy tree on one column, ascending."""
    model = C.DecisionTreeClassifier(impurity="entropy", maxDepth=depth).fit(with_features(df, [col], y))
    cuts = []

    def walk(node):
        if node.numDescendants() > 0:
            cuts.append(node.split().threshold())
            walk(node.leftChild())
            walk(node.rightChild())

    walk(model._java_obj.rootNode())
    return sorted(set(cuts))


# --- logistic regression with inference ----------------------------------

PARAMS = "column string, coef double, se double, z double, wald double, p double, low double, high double"


def _upper_normal(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def chi2_upper(x: float, df: int) -> float:
    """Upper tail of the chi-square distribution for a whole number of degrees."""
    if x <= 0 or df <= 0:
        return 1.0
    if df % 2:
        total, term = math.erfc(math.sqrt(x / 2)), math.sqrt(2 * x / math.pi) * math.exp(-x / 2)
        for k in range(1, df, 2):
            total += term
            term *= x / (k + 2)
        return total
    total, term = 0.0, math.exp(-x / 2)
    for k in range(1, df // 2 + 1):
        total += term
        term *= x / (2 * k)
    return total


class Logit:
    """A fitted binomial model with its inference; rows with missing values are dropped."""

    def __init__(self, df: DataFrame, y: str, xs: Sequence[str]):
        self.y, self.xs = y, list(xs)
        self.rows = df.dropna(subset=[y, *xs])
        data = VectorAssembler(inputCols=self.xs, outputCol="_features").transform(
            self.rows.withColumn("_label", F.col(y).cast("double"))
        )
        glr = R.GeneralizedLinearRegression(family="binomial", link="logit", featuresCol="_features", labelCol="_label", maxIter=50, tol=1e-8)
        self.model = glr.fit(data)
        s = self.model.summary
        self.coef = [self.model.intercept, *self.model.coefficients.toArray().tolist()]
        se = s.coefficientStandardErrors
        self.se = [se[-1], *se[:-1]]
        self.deviance, self.null_deviance, self.aic, self.n = s.deviance, s.nullDeviance, s.aic, s.numInstances

    @property
    def pseudo_r2(self) -> float:
        return 1.0 - self.deviance / self.null_deviance

    def params(self) -> list[tuple]:
        out = []
        for name, b, se in zip(["const", *self.xs], self.coef, self.se):
            z = b / se
            out.append((name, b, se, z, z * z, _upper_normal(z), b - 1.959963984540054 * se, b + 1.959963984540054 * se))
        return out

    def fit_eval(self) -> dict[str, float]:
        k, lr = len(self.xs), self.null_deviance - self.deviance
        return {
            "aic_null": self.null_deviance + 2, "aic": self.aic,
            "bic_null": self.null_deviance + math.log(self.n), "bic": self.deviance + (k + 1) * math.log(self.n),
            "m2logl_null": self.null_deviance, "m2logl": self.deviance,
            "mcfadden": self.pseudo_r2, "lr_chi2": lr, "lr_df": float(k), "lr_p": chi2_upper(lr, k),
        }

    def predict(self, df: DataFrame) -> DataFrame:
        z = F.lit(float(self.coef[0]))
        for c, b in zip(self.xs, self.coef[1:]):
            z = z + F.col(c) * F.lit(float(b))
        return df.withColumn("p", 1.0 / (1.0 + F.exp(-z)))

    def residuals(self, df: DataFrame) -> DataFrame:
        """Predicted probability with response, Pearson and deviance residuals."""
        out = self.predict(df)
        p, t = F.col("p"), F.col(self.y).cast("double")
        dev = F.when(t == 1, F.sqrt(-2 * F.log(p))).otherwise(-F.sqrt(-2 * F.log(1 - p)))
        return out.select("*", (t - p).alias("response"), ((t - p) / F.sqrt(p * (1 - p))).alias("pearson"), dev.alias("deviance"))

    def covariance(self) -> np.ndarray:
        """Of the coefficients, intercept first: one aggregation of weighted products."""
        from linkscore.operators.linear import normal_sums

        rows = self.predict(self.rows)
        w = F.sqrt(F.col("p") * (1 - F.col("p")))
        g, _, _, _ = normal_sums(rows, [w, *[w * F.col(c) for c in self.xs]], F.lit(0.0))[0]
        return np.linalg.inv(g)


def logit(df: DataFrame, y: str, xs: Sequence[str]) -> DataFrame:
    return df.sparkSession.createDataFrame(Logit(df, y, xs).params(), PARAMS)


NEWTON_ROUNDS = 50


def fit_side_by_side(df: DataFrame, y: str, models: Sequence[Sequence[str]]) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """Coefficients (constant first), information matrix and deviance of many logistic models of one table.

    All models take their Newton steps together: a pass sums the gradient, the
    information and the likelihood of each, one row per model and task, and as many
    passes as the slowest model needs serve all. Rows must not hold missing values.
    """
    names = sorted({c for m in models for c in m})
    places = [[0, *[names.index(c) + 1 for c in m]] for m in models]
    data = df.select(F.col(y).cast("double").alias("_y"), *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(names)])

    def sums(coefs: list[np.ndarray]):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = [np.zeros(len(at) * (len(at) + 1) + 1) for at in places]
            for batch in batches:
                t = batch["_y"].to_numpy()
                x = np.column_stack([np.ones(batch.num_rows), *[c.to_numpy() for c in batch.columns[1:]]])
                for own, at, coef in zip(total, places, coefs):
                    z = x[:, at]
                    eta = z @ coef
                    p = 1 / (1 + np.exp(-np.clip(eta, -700, 700)))
                    information = (z * (p * (1 - p))[:, None]).T @ z
                    likelihood = (t * eta - np.logaddexp(0, eta)).sum()
                    own += np.concatenate([z.T @ (t - p), information.ravel(), [likelihood]])
            model = np.repeat(np.arange(len(total)), [len(v) for v in total])
            at = np.concatenate([np.arange(len(v)) for v in total])
            yield pa.RecordBatch.from_arrays([pa.array(model), pa.array(at), pa.array(np.concatenate(total))], names=["model", "i", "v"])

        return data.mapInArrow(work, "model long, i long, v double").groupBy("model", "i").agg(F.sum("v").alias("v"))

    coefs = [np.zeros(len(at)) for at in places]
    before = [math.inf] * len(models)
    for _ in range(NEWTON_ROUNDS):
        found = sums(coefs).toArrow().sort_by([("model", "ascending"), ("i", "ascending")])
        model, value = found["model"].to_numpy(), found["v"].to_numpy()
        deviance, information = [], []
        for m, at in enumerate(places):
            own, k = value[model == m], len(at)
            information.append(own[k : k + k * k].reshape(k, k))
            deviance.append(-2 * float(own[-1]))
            if abs(deviance[m] - before[m]) > 1e-10 * (abs(deviance[m]) + 0.1):
                coefs[m] = coefs[m] + np.linalg.lstsq(information[m], own[:k], rcond=None)[0]
        if all(abs(d - b) <= 1e-10 * (abs(d) + 0.1) for d, b in zip(deviance, before)):
            break
        before = deviance
    return [*zip(coefs, information, deviance)]


def stepwise(df: DataFrame, y: str, xs: Sequence[str], direction: str = "forward", sls: float = 0.05) -> list[str]:
    """Forward by pseudo R², or backward dropping the largest p above ``sls``; of equal ones the last by name.

    Forward, the models of all candidates are fitted side by side; backward, the
    Wald tests of all columns come from the one information matrix of the step.
    """
    data = df.select(y, *xs).dropna().persist()
    try:
        if direction == "backward":
            left = list(xs)
            while left:
                coef, information, _ = fit_side_by_side(data, y, [left])[0]
                se = np.sqrt(np.diag(np.linalg.pinv(information)))[1:]
                p, name = max((_upper_normal(b / s) if s > 0 else 1.0, c) for b, s, c in zip(coef[1:], se, left))
                if p <= sls:
                    break
                left.remove(name)
            return left
        chosen: list[str] = []
        best = 0.0
        null = fit_side_by_side(data, y, [[]])[0][2]
        while len(chosen) < len(xs):
            open_ = [c for c in xs if c not in chosen]
            fits = fit_side_by_side(data, y, [[*chosen, c] for c in open_])
            score, name = max((1 - deviance / null if null else 0.0, c) for (_, _, deviance), c in zip(fits, open_))
            if score <= best:
                break
            best = score
            chosen.append(name)
        return chosen
    finally:
        data.unpersist()


def report(spark, figures: Mapping[str, float]) -> DataFrame:
    return spark.createDataFrame([(k, float(v)) for k, v in figures.items()], "figure string, value double")

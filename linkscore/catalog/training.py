"""Queries of the training family and the composed jobs."""

from __future__ import annotations

from itertools import combinations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from linkscore.catalog.aggregates import rounded
from linkscore.catalog.association import BASE, STEPS, WIDE_STEPS, _one
from linkscore.catalog.association import sql as hop_sql
from linkscore.catalog.registry import query, sql
from linkscore.catalog.scorecard import ALPHA, BETA, category_steps, optimal_once, optimal_steps
from linkscore.catalog.solving import newton, newton_subsets, products, solve, upper_normal
from linkscore.operators import evaluate as E
from linkscore.operators import features as X
from linkscore.operators import linear as L
from linkscore.operators import train as T
from linkscore.plans.daily import Folders, daily_run
from linkscore.plans.scorecard import build_scorecard
from linkscore.runtime import cut, scratch_path, stored
from linkscore.sources.files import commit_history

XS = ["price", "balance", "rank"]


def credit(t):
    """Numeric columns with a usable signal for the target."""
    rank = F.substring("priority", 1, 1).cast("int")
    base = t("credit").select("id", "y", "day", "price", "balance", rank.alias("rank"))
    return base


@query(
    "m01_split",
    "SELECT o_orderkey, CASE WHEN CAST(CAST('0x' || substr(md5(concat(CAST(o_orderkey AS STRING), '|11')), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 < 0.6 THEN 'train' ELSE 'test' END AS part FROM orders",
)
def _(t):
    a, b = T.split(t("orders").select("o_orderkey"), "o_orderkey")
    return a.withColumn("part", F.lit("train")).unionByName(b.withColumn("part", F.lit("test")))


#: price and balance in units that keep the elimination well conditioned; the fitted probabilities do not depend on them
PLAIN = {"d": "SELECT id, y, day, price / 100000 AS a, balance / 1000 AS b, CAST(substr(priority, 1, 1) AS INT) AS c FROM credit"}


def newton_once(rounds: int, tag: str = "") -> list[str]:
    return [f"{tag}fitted", *[f"{tag}s{r}" for r in range(1, rounds + 1)], *[f"{tag}beta{r}" for r in range(rounds + 1)]]


@query("m02_logistic", sql(["credit"], {**PLAIN, **newton("d", ["a", "b", "c"], "y", 9)}, "SELECT id, day, round(p, 4) AS score FROM fitted", once=["d", *newton_once(9)]))
def _(t):
    df = credit(t)
    return rounded(T.score_batch(df, T.train(df, "logistic", XS, "y", tol=1e-13), "id", "day", XS), 4, "score")


def _trained(kind, **settings):
    def run(t):
        df = credit(t)
        model = T.train(df, kind, XS, "y", **settings)
        return T.score_batch(df, model, "id", "day", XS)

    return run


for _name, _kind, _settings in (
    ("m03_tree_classify", "tree_classify", {}),
    ("m03_tree_regress", "tree_regress", {}),
    ("m04_forest_classify", "forest_classify", {}),
    ("m04_forest_regress", "forest_regress", {}),
    ("m05_gbt_classify", "gbt_classify", {}),
    ("m05_gbt_regress", "gbt_regress", {}),
):
    query(_name)(_trained(_kind, **_settings))


def bayes_sql() -> str:
    """Smoothed shares of each column in the sums of a class, and the posterior of class 1."""
    xs = {"price": "price", "balance": "balance + 2000", "rank": "CAST(substr(priority, 1, 1) AS INT)"}
    theta = [f"ln(max(CASE WHEN y = {k} THEN {c} END) + 1) - ln(max(CASE WHEN y = {k} THEN price + balance + rank END) + {len(xs)}) AS t{k}_{c}" for k in (0, 1) for c in xs]
    steps = {
        "d": "SELECT id, y, day, " + ", ".join(f"{e} AS {c}" for c, e in xs.items()) + " FROM credit",
        "s": "SELECT y, count(*) AS n, " + ", ".join(f"sum({c}) AS {c}" for c in xs) + " FROM d GROUP BY y",
        "w": f"SELECT ln(max(CASE WHEN y = 1 THEN n END) + 1) - ln(max(CASE WHEN y = 0 THEN n END) + 1) AS prior, {', '.join(theta)} FROM s",
    }
    margin = " + ".join(f"{c} * (t1_{c} - t0_{c})" for c in xs)
    return sql(["credit"], steps, f"SELECT id, day, round(1 / (1 + exp(greatest(-700, least(700, -(prior + {margin}))))), 5) + 0.0 AS score FROM d, w", once=("w",))


@query("m06_naive_bayes", bayes_sql())
def _(t):
    df = credit(t).withColumn("balance", F.col("balance") + 2000)
    return rounded(T.score_batch(df, T.train(df, "nb", XS, "y"), "id", "day", XS), 5, "score").withColumn("score", F.col("score") + 0.0)


TREES, DEPTHS = range(5, 151), range(4, 21)  # fixed values: the grid of the training job


@query("m07_sweep_gbt")
def _(t):
    return T.sweep_gbt(credit(t), XS, "y", "id", TREES, DEPTHS)


def balanced_sql() -> str:
    """The sample of both classes, the model of its training share, and pairs in right order in the rest."""
    steps = {
        "v": "SELECT *, row_number() OVER (PARTITION BY y ORDER BY md5(concat(CAST(id AS STRING), '|11')), id) AS r FROM credit",
        "k": "SELECT least(sum(y), sum(1 - y)) AS k FROM credit",
        "e": """SELECT id, y, price / 100000 AS a, balance / 1000 AS b, CAST(substr(priority, 1, 1) AS INT) AS c,
          CAST(CAST('0x' || substr(md5(concat(CAST(id AS STRING), '|12')), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 < 0.7 AS fit FROM v, k WHERE r <= k""",
        "d": "SELECT * FROM e WHERE fit",
        **newton("d", ["a", "b", "c"], "y", 9),
        "g": "SELECT c1 * a + c2 * b + c3 * c AS score, sum(y) AS pos, sum(1 - y) AS neg FROM e, beta9 WHERE NOT fit GROUP BY 1",
        "o": "SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g",
    }
    return sql(["credit"], steps, "SELECT 'auc' AS figure, round(sum(pos * (below + neg / 2)) / sum(pos) / sum(neg), 5) AS value FROM o", once=["e", "d", *newton_once(9)])


@query("m08_train_balanced", balanced_sql())
def _(t):
    _model, auc = T.train_balanced(credit(t), XS, "y", "id")
    return rounded(T.report(t.spark, {"auc": auc}), 5, "value")


@query("m09_score_batch")
def _(t):
    df = credit(t)
    folder = scratch_path(t.spark, "model")
    T.train(df, "tree_regress", XS, "y").write().save(folder)
    return T.score_batch(df, folder, "id", "day", XS)


@query("m09_score_saved", sql(["credit"], {**PLAIN, **newton("d", ["a", "b", "c"], "y", 9)}, "SELECT id, day, round(p, 4) AS score FROM fitted", once=["d", *newton_once(9)]))
def _(t):
    """A saved model with a formula that SQL can repeat, read back by its folder."""
    df = credit(t)
    folder = scratch_path(t.spark, "model")
    T.train(df, "logistic", XS, "y", tol=1e-13).write().save(folder)
    return rounded(T.score_batch(df, folder, "id", "day", XS), 4, "score")


@query("m10_train_and_score_all")
def _(t):
    return T.train_and_score_all(credit(t), XS, "y", "id")


@query("m11_tree_bins")
def _(t):
    word_length = F.col("n_chars") / F.size(F.split("text", " "))
    rated = t("documents").join(t("labels"), "doc_id").select(word_length.alias("word_length"), "quality")
    cuts = T.tree_bins(rated, "word_length", "quality")
    return t.spark.createDataFrame([(i + 1, c) for i, c in enumerate(cuts)], "cut int, value double")


@query(
    "m12_ols",
    "SELECT 'l_quantity' AS \"column\", round(regr_slope(l_extendedprice, l_quantity), 4) AS coef FROM lineitem UNION ALL SELECT 'const', round(regr_intercept(l_extendedprice, l_quantity), 3) FROM lineitem",
)
def _(t):
    out = L.ols(t("lineitem"), "l_extendedprice", ["l_quantity"])
    return out.withColumn("coef", F.when(F.col("column") == "const", F.round("coef", 3)).otherwise(F.round("coef", 4)))


RIDGE = ["l_quantity", "l_discount", "l_tax"]


def ridge_sql() -> str:
    """Sums by tenth, the error of every tenth for every lambda, and the best lambda's fit on all rows."""
    three = range(3)
    z = [f"({c} - m{i}) / v{i}" for i, c in enumerate(RIDGE)]
    t = "(l_extendedprice - my)"
    sums = ", ".join(f"sum(({z[i]}) * ({z[j]})) AS g{i}{j}" for i in three for j in three)
    sums += ", " + ", ".join(f"sum(({z[i]}) * {t}) AS t{i}" for i in three) + f", sum({t} * {t}) AS yy"
    names = [f"g{i}{j}" for i in three for j in three] + [f"t{i}" for i in three]
    left = ", ".join(f"w.g{i}{j} - f.g{i}{j} + {'lam' if i == j else '0'} AS a{i}_{j}" for i in three for j in three)
    right = ", ".join(f"w.t{i} - f.t{i} AS b{i}_g" for i in three)
    steps = {
        "st": "SELECT " + ", ".join(f"avg({c}) AS m{i}, var_pop({c}) AS v{i}" for i, c in enumerate(RIDGE)) + ", avg(l_extendedprice) AS my FROM lineitem",
        "rw": "SELECT *, CAST('0x' || substr(md5(concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '|11')), 1, 8) AS BIGINT) % 10 AS fold FROM lineitem, st",
        "f": f"SELECT fold, {sums} FROM rw GROUP BY fold",
        "w": "SELECT " + ", ".join(f"sum({n}) AS {n}" for n in names) + " FROM f",
        "lm": "SELECT i, exp(i - 10.0) AS lam FROM range(0, 30) r(i)",
        "sy": f"SELECT i, fold, yy, {', '.join(f'f.{n} AS {n}' for n in names)}, {left}, {right} FROM f, w, lm",
        **solve("sy", 3, ["g"], ["i", "fold", "yy", *names]),
        "er": "SELECT i, avg(yy - 2 * (" + " + ".join(f"x{i}_g * t{i}" for i in three) + ") + "
        + " + ".join(f"x{i}_g * x{j}_g * g{i}{j}" for i in three for j in three) + ") AS err FROM sy_x GROUP BY i",
        "bt": "SELECT lam FROM er JOIN lm USING (i) ORDER BY err, i LIMIT 1",
        "fin": "SELECT " + ", ".join(f"g{i}{j} + {'lam' if i == j else '0'} AS a{i}_{j}" for i in three for j in three) + ", "
        + ", ".join(f"t{i} AS b{i}_g" for i in three) + " FROM w, bt",
        **solve("fin", 3, ["g"]),
    }
    rows = [f"SELECT '{c}' AS \"column\", round(x{i}_g / v{i}, 2) + 0.0 AS coef FROM fin_x, st" for i, c in enumerate(RIDGE)]
    rows.append("SELECT 'const', round(my - " + " - ".join(f"x{i}_g / v{i} * m{i}" for i in three) + ", 2) + 0.0 FROM fin_x, st")
    return sql([], steps, " UNION ALL ".join(rows), once=("rw", "f", "w", "sy", "er"))


@query("m13_ridge_path", ridge_sql())
def _(t):
    lines = t("lineitem").withColumn("key", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    return rounded(L.ridge_path(lines, "l_extendedprice", RIDGE, "key")[0], 2, "coef").withColumn("coef", F.col("coef") + 0.0)


POINTS = [5.0, 15.0, 25.0, 35.0, 45.0]


@query(
    "m14_lwlr",
    sql([], {
        "p": "SELECT unnest([5.0, 15.0, 25.0, 35.0, 45.0])::DOUBLE AS a",
        "w": "SELECT a, l_quantity - a AS x, l_extendedprice AS y, exp(-((l_quantity - a) ** 2) / 50.0) AS w FROM lineitem, p",
        "s": "SELECT a, sum(w) AS s, sum(w * x) AS sx, sum(w * y) AS sy, sum(w * x * x) AS sxx, sum(w * x * y) AS sxy FROM w GROUP BY a"},
        "SELECT a AS x, round((sxx * sy - sx * sxy) / (s * sxx - sx * sx), 3) AS predicted FROM s"),
)
def _(t):
    return rounded(L.lwlr(t("lineitem"), "l_quantity", "l_extendedprice", POINTS, 5.0), 3, "predicted")


def _sided(t):
    return credit(t).select(
        "id", (F.col("y") * 2 - 1).alias("side"), "y", (F.col("price") / 500000).alias("a"), (F.col("balance") / 10000).alias("b"), (F.col("rank") / 5.0).alias("c")
    )


SIDED = {
    "d": "SELECT id, y, y * 2 - 1 AS side, price / 500000 AS a, balance / 10000 AS b, CAST(substr(priority, 1, 1) AS INT) / 5.0 AS c FROM credit",
}


def stumps_sql(rounds: int) -> str:
    """Errors of all thresholds, the best stump and new weights, round by round."""
    ends = " UNION ALL ".join(f"SELECT {i} AS c, min({x}) AS lo, max({x}) AS hi FROM d" for i, x in enumerate("abc"))
    steps = {
        **SIDED,
        "en": ends,
        "ct": "SELECT c, c * 12 + j + 1 AS i, lo + j * (hi - lo) / 10 AS v FROM en, range(-1, 11) r(j)",
        "d0": "SELECT id, side, a, b, c, 1.0::DOUBLE AS w, 0.0::DOUBLE AS score FROM d",
    }
    for r in range(1, rounds + 1):
        said = "CASE WHEN CASE k.c WHEN 0 THEN a WHEN 1 THEN b ELSE d.c END <= v THEN -1 ELSE 1 END"
        steps[f"e{r}"] = f"SELECT k.i, k.c, v, sum(CASE WHEN {said} <> side THEN w ELSE 0 END) / sum(w) AS err FROM d{r - 1} d, ct k GROUP BY k.i, k.c, v"
        steps[f"k{r}"] = f"""SELECT c, v, sgn, 0.5 * ln((1 - err) / greatest(err, 1e-16)) AS alpha FROM (
          SELECT i, c, v, err, 1 AS sgn FROM e{r} UNION ALL SELECT i, c, v, 1 - err, -1 FROM e{r}) ORDER BY err, i, sgn DESC LIMIT 1"""
        sign = said + " * sgn"
        steps[f"d{r}"] = f"SELECT id, side, a, b, d.c, w * exp(-alpha * side * {sign}) AS w, score + alpha * {sign} AS score FROM d{r - 1} d, k{r} k"
    return sql(["credit"], steps, f"SELECT id, round(score, 6) + 0.0 AS score FROM d{rounds}", once=[s for s in steps if s[0] in "edk" and s != "en"])


@query("m15_adaboost_stumps", stumps_sql(4))
def _(t):
    df = cut(_sided(t))
    stumps = L.adaboost_stumps(df, "side", ["a", "b", "c"], 4)
    return df.select("id", (F.round(L.stump_score(stumps), 6) + 0.0).alias("score"))


def pegasos_sql(rounds: int, lam: float) -> dict:
    steps = {**SIDED, "w0": "SELECT 0.0::DOUBLE AS wa, 0.0::DOUBLE AS wb, 0.0::DOUBLE AS wc"}
    for r in range(1, rounds + 1):
        g = {k: f"sum(CASE WHEN side * (a * wa + b * wb + c * wc) < 1 THEN side * {k} ELSE 0 END)" for k in "abc"}
        steps[f"w{r}"] = "SELECT " + ", ".join(f"(1 - 1.0 / {r}) * min(w{k}) + {g[k]} / ({lam} * {r}) / count(*) AS w{k}" for k in "abc") + f" FROM d, w{r - 1}"
    return steps


def _weights(t, w, digits):
    return t.spark.createDataFrame([tuple(round(float(v), digits) for v in w)], "wa double, wb double, wc double")


@query("m16_pegasos", sql(["credit"], pegasos_sql(3, 0.5), "SELECT round(wa, 6) AS wa, round(wb, 6) AS wb, round(wc, 6) AS wc FROM w3"))
def _(t):
    return _weights(t, L.pegasos(cut(_sided(t)), "side", ["a", "b", "c"], 0.5, 3), 6)


def proximal_sql(mu: float) -> str:
    xs = ["a", "b", "c", "-1.0"]
    sums = {**SIDED, "g": f"SELECT {products(xs)}, " + ", ".join(f"sum(({x}) * side) AS b{i}_g" for i, x in enumerate(xs)) + " FROM d"}
    ridge = ", ".join(f"a{i}_{j} + {1 / mu if i == j else 0} AS a{i}_{j}" for i in range(4) for j in range(4))
    sums["m"] = f"SELECT {ridge}, {', '.join(f'b{i}_g' for i in range(4))} FROM g"
    rows = " UNION ALL ".join(f"SELECT CAST({i} AS INT) AS position, round(x{i}_g, 7) AS value FROM m_x" for i in range(4))
    return sql(["credit"], {**sums, **solve("m", 4, ["g"])}, rows, once=("g",))


@query("m17_proximal_svm", proximal_sql(0.1))
def _(t):
    u = L.proximal_svm(_sided(t), "side", ["a", "b", "c"], 0.1)
    return t.spark.createDataFrame([(i, round(float(v), 7)) for i, v in enumerate(u)], "position int, value double")


def ascent_sql(rounds: int, alpha: float) -> dict:
    steps = {**SIDED, "w0": "SELECT 1.0::DOUBLE AS wa, 1.0::DOUBLE AS wb, 1.0::DOUBLE AS wc"}
    for r in range(1, rounds + 1):
        e = "(y - 1 / (1 + exp(-(a * wa + b * wb + c * wc))))"
        steps[f"w{r}"] = "SELECT " + ", ".join(f"min(w{k}) + {alpha} * avg({k} * {e}) AS w{k}" for k in "abc") + f" FROM d, w{r - 1}"
    return steps


@query("m18_logistic_ascent", sql(["credit"], ascent_sql(5, 0.5), "SELECT round(wa, 6) AS wa, round(wb, 6) AS wb, round(wc, 6) AS wc FROM w5"))
def _(t):
    return _weights(t, L.logistic_ascent(cut(_sided(t)), "y", ["a", "b", "c"], 0.5, 5, mean=True), 6)


ALPHAS = [0.1, 100.0]


def lasso_sql(sweeps: int = 12) -> str:
    """Moments by fold, coordinate descent on the standardised moments of the other folds, the error in the fold from its moments."""
    k = range(len(RIDGE))
    pairs = [(i, j) for i in k for j in k if i <= j]
    names = {"n": "1", "sy": "l_extendedprice", "yy": "l_extendedprice * l_extendedprice"}
    names |= {f"s{i}": RIDGE[i] for i in k} | {f"t{i}": f"{RIDGE[i]} * l_extendedprice" for i in k} | {f"g{i}{j}": f"{RIDGE[i]} * {RIDGE[j]}" for i, j in pairs}
    keep = ", ".join(names)
    rest = {m: f"(w.{m} - f.{m})" for m in names}
    spread = lambda two, a, b: f"({rest[two]} / {rest['n']} - {rest[a]} / {rest['n']} * {rest[b]} / {rest['n']})"
    sd = {i: f"sqrt({spread(f'g{i}{i}', f's{i}', f's{i}')})" for i in k}
    sdy = f"sqrt({spread('yy', 'sy', 'sy')})"
    columns = [f"f.{m} AS {m}" for m in names] + [f"{sd[i]} AS d{i}" for i in k] + [f"{sdy} AS dy", f"{rest['sy']} / {rest['n']} AS my"]
    columns += [f"{rest[f's{i}']} / {rest['n']} AS m{i}" for i in k]
    columns += [f"{spread(f'g{i}{j}', f's{i}', f's{j}')} / {sd[i]} / {sd[j]} AS r{i}{j}" for i, j in pairs if i < j]
    columns += [f"{spread(f't{i}', f's{i}', 'sy')} / {sd[i]} / {sdy} AS c{i}" for i in k] + [f"0.0::DOUBLE AS w{i}" for i in k]
    steps = {
        "f": "SELECT CAST('0x' || substr(md5(concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '|11')), 1, 8) AS BIGINT) % 3 AS fold, "
        + ", ".join(f"CAST(sum({e}) AS DOUBLE) AS {m}" for m, e in names.items()) + " FROM lineitem GROUP BY 1",
        "w": "SELECT " + ", ".join(f"sum({m}) AS {m}" for m in names) + " FROM f",
        "al": f"SELECT unnest({ALPHAS})::DOUBLE AS alpha",
        "x0": f"SELECT alpha, fold, {', '.join(columns)} FROM f, w, al",
    }
    at = 0
    for _ in range(sweeps):
        for i in k:
            pull = f"(c{i} - " + " - ".join(f"r{min(i, j)}{max(i, j)} * w{j}" for j in k if j != i) + ")"
            steps[f"x{at + 1}"] = f"SELECT * REPLACE (sign({pull}) * greatest(abs({pull}) - alpha / dy, 0) AS w{i}) FROM x{at}"
            at += 1
    steps["cf"] = f"SELECT alpha, {keep}, " + ", ".join(f"w{i} * dy / d{i} AS b{i}" for i in k) + ", my - " + " - ".join(f"w{i} * dy / d{i} * m{i}" for i in k) + f" AS b FROM x{at}"
    square = "yy + b * b * n - 2 * b * sy + " + " + ".join(f"2 * b * b{i} * s{i} - 2 * b{i} * t{i}" for i in k)
    square += " + " + " + ".join(f"{1 if i == j else 2} * b{i} * b{j} * g{i}{j}" for i, j in pairs)
    return sql([], steps, f"SELECT alpha, round(avg(sqrt(({square}) / n)), 2) AS rmse FROM cf GROUP BY alpha", once=("f", "w", "x0"))


@query("m19_linear_cv", lasso_sql())
def _(t):
    lines = t("lineitem").withColumn("key", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    return rounded(T.linear_cv(lines, RIDGE, "l_extendedprice", "lasso", ALPHAS, key="key"), 2, "rmse")


def pca_sql(rounds: int = 60) -> str:
    """Two directions by power iteration on the covariance, the second kept orthogonal to the first."""
    xs = {"x": "l_quantity", "y": "l_extendedprice", "z": "l_discount"}

    def times(v: str) -> str:
        return ", ".join(" + ".join(f"covar_{min(a, b)}{max(a, b)} * {v}{b}" for b in xs) + f" AS n{a}" for a in xs)

    def steps(name: str, inner: str) -> str:
        size = "sqrt(nx * nx + ny * ny + nz * nz)"
        return f"SELECT 0 AS step, 1.0::DOUBLE AS vx, 1.0::DOUBLE AS vy, 1.0::DOUBLE AS vz UNION ALL SELECT step + 1, nx / {size}, ny / {size}, nz / {size} FROM ({inner}) WHERE step < {rounds}"

    def signed(name: str) -> str:
        return f"SELECT vx * s AS vx, vy * s AS vy, vz * s AS vz FROM (SELECT *, sign(CASE greatest(abs(vx), abs(vy), abs(vz)) WHEN abs(vx) THEN vx WHEN abs(vy) THEN vy ELSE vz END) AS s FROM {name} WHERE step = {rounds})"

    turned = f"SELECT step, {times('v')} FROM second, m"
    flat = ", ".join(f"n{a} - (nx * f.vx + ny * f.vy + nz * f.vz) * f.v{a} AS n{a}" for a in xs)
    parts = {
        "m": "SELECT " + ", ".join(f"avg({c}) AS mean_{a}" for a, c in xs.items()) + ", "
        + ", ".join(f"covar_samp({xs[a]}, {xs[b]}) AS covar_{a}{b}" for a in xs for b in xs if a <= b) + " FROM lineitem",
        "first": steps("first", f"SELECT step, {times('v')} FROM first, m"),
        "f": signed("first"),
        "second": steps("second", f"SELECT step, {flat} FROM ({turned}), f"),
        "g": signed("second"),
    }
    score = lambda v: " + ".join(f"({c} - mean_{a}) * {v}.v{a}" for a, c in xs.items())
    return sql([], parts, f"SELECT l_orderkey, l_linenumber, round({score('f')}, 4) + 0.0 AS pc1, round({score('g')}, 4) + 0.0 AS pc2 FROM lineitem, m, f, g", once=("m", "f", "g"))


@query("t13_pca_project", pca_sql())
def _(t):
    out, _variances = L.pca_project(t("lineitem"), ["l_quantity", "l_extendedprice", "l_discount"], 2)
    return out.select("l_orderkey", "l_linenumber", *[(F.round(c, 4) + 0.0).alias(c) for c in ("pc1", "pc2")])


WX = ["price_k", "balance_k", "rank"]


def _logit_rows(t):
    return credit(t).select("id", "y", (F.col("price") / 1000).alias("price_k"), (F.col("balance") / 1000).alias("balance_k"), "rank")


LOGIT = {
    "d": "SELECT id, y, price / 1000 AS price_k, balance / 1000 AS balance_k, CAST(substr(priority, 1, 1) AS INT) AS rank FROM credit",
    **newton("d", WX, "y", 9),
}
LOGIT_ONCE = ["d", "fitted", "info", *[f"{n}{r}" for n in "ps" for r in range(1, 10)], *[f"beta{r}" for r in range(10)]]


def logit_sql() -> str:
    rows = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", c{i} AS coef, sqrt(x{i}_{i}) AS se FROM beta9, info_x" for i, c in enumerate(["const", *WX]))
    final = f"""SELECT "column", round(coef, 6) AS coef, round(se, 7) AS se, round(coef / se, 4) AS z, round((coef / se) ** 2, 3) AS wald,
      round({upper_normal('coef / se')}, 6) + 0.0 AS p, round(coef - 1.959963984540054 * se, 6) AS low, round(coef + 1.959963984540054 * se, 6) AS high FROM q"""
    return sql(["credit"], {**LOGIT, "q": rows}, final, once=LOGIT_ONCE)


@query("w15_logit", logit_sql())
def _(t):
    out = T.logit(_logit_rows(t), "y", WX)
    for digits, columns in ((6, ("coef", "p", "low", "high")), (7, ("se",)), (4, ("z",)), (3, ("wald",))):
        out = rounded(out, digits, *columns)
    return out.withColumn("p", F.col("p") + 0.0)


def fit_eval_sql() -> str:
    k = len(WX)
    figures = {
        "aic_null": "nul + 2", "aic": f"dev + 2 * {k + 1}", "bic_null": "nul + ln(n)", "bic": f"dev + {k + 1} * ln(n)",
        "m2logl_null": "nul", "m2logl": "dev", "mcfadden": "1 - dev / nul", "lr_chi2": "nul - dev", "lr_df": f"{k}.0",
        "lr_p": upper_normal("sqrt(nul - dev)") + " + sqrt(2 * (nul - dev) / pi()) * exp(-(nul - dev) / 2)",
    }
    steps = {
        **LOGIT,
        "q": "SELECT count(*) AS n, -2 * sum(CASE WHEN y = 1 THEN ln(p) ELSE ln(1 - p) END) AS dev, -2 * (sum(y) * ln(avg(y)) + sum(1 - y) * ln(1 - avg(y))) AS nul FROM fitted",
    }
    rows = " UNION ALL ".join(f"SELECT '{name}' AS figure, round({e}, 5) + 0.0 AS value FROM q" for name, e in figures.items())
    return sql(["credit"], steps, rows, once=[*LOGIT_ONCE, "q"])


@query("w16_fit_eval", fit_eval_sql())
def _(t):
    return rounded(T.report(t.spark, T.Logit(_logit_rows(t), "y", WX).fit_eval()), 5, "value").withColumn("value", F.col("value") + 0.0)


@query(
    "w17_residuals",
    sql(["credit"], LOGIT, """SELECT id, round(p, 5) AS p, round(y - p, 5) AS response, round((y - p) / sqrt(p * (1 - p)), 5) AS pearson,
      round(CASE WHEN y = 1 THEN sqrt(-2 * ln(p)) ELSE -sqrt(-2 * ln(1 - p)) END, 5) AS deviance FROM fitted""", once=LOGIT_ONCE),
)
def _(t):
    df = _logit_rows(t)
    return rounded(T.Logit(df, "y", WX).residuals(df).select("id", "p", "response", "pearson", "deviance"), 5, "p", "response", "pearson", "deviance")


def stepwise_sql(rounds: int = 9) -> str:
    """Deviances of the models of all subsets of the columns, and the way from one to the next."""
    subsets = [s for k in range(1, len(WX) + 1) for s in combinations(range(len(WX)), k)]
    tags = {s: "m" + "".join(map(str, s)) + "_" for s in subsets}
    steps = {"d": LOGIT["d"]}
    for s in subsets:
        steps |= newton("d", [WX[i] for i in s], "y", rounds, tags[s])
    dev = "-2 * sum(CASE WHEN y = 1 THEN ln(p) ELSE ln(1 - p) END)"
    rows = [f"SELECT [{', '.join(repr(WX[i]) for i in s)}] AS members, {dev} AS deviance FROM {tags[s]}fitted" for s in subsets]
    rows.append("SELECT []::VARCHAR[], -2 * (sum(y) * ln(avg(y)) + sum(1 - y) * ln(1 - avg(y))) FROM d")
    steps["dv"] = " UNION ALL ".join(rows)
    steps["way"] = """SELECT 0 AS step, ''::VARCHAR AS "column", members, deviance FROM dv WHERE len(members) = 0
      UNION ALL SELECT * FROM (SELECT w.step + 1, list_filter(dv.members, lambda c: NOT list_contains(w.members, c))[1] AS added, dv.members, dv.deviance
        FROM way w JOIN dv ON len(dv.members) = w.step + 1 AND list_has_all(dv.members, w.members) AND dv.deviance < w.deviance
        ORDER BY dv.deviance, added DESC LIMIT 1)"""
    once = ["d", "dv", *[n for s in subsets for n in newton_once(rounds, tags[s])]]
    return sql(["credit"], steps, 'SELECT CAST(step AS INT) AS step, "column" FROM way WHERE step > 0', once=once)


@query("w18_stepwise", stepwise_sql())
def _(t):
    chosen = T.stepwise(_logit_rows(t), "y", WX, "forward")
    return t.spark.createDataFrame([(i + 1, c) for i, c in enumerate(chosen)], "step int, column string")


MEASURES, CATEGORIES = ["price", "balance"], ["priority", "nation"]


def build_sql(rounds: int = 9) -> str:
    """Bins, groups and weights of evidence; models of all subsets of the columns; the way down from all of them; points."""
    cols = [*MEASURES, *CATEGORIES]
    steps = optimal_steps(MEASURES)
    once = optimal_once(MEASURES)
    for c in CATEGORIES:
        steps |= category_steps(c, f"_{c}_")
        once += [f"r_{c}_", *[f"b_{c}_{s}" for s in range(5)]]
    place = [f"(SELECT newbin FROM o_{c}, (SELECT min({c}) AS lo, max({c}) AS hi FROM credit) WHERE least(floor((d.{c} - lo) / ((hi - lo) / 100)), 99) + 1 BETWEEN first AND last) AS {c}" for c in MEASURES]
    place += [f"(SELECT count(*) FROM b_{c}_4 b JOIN r_{c}_ r ON b.k < r.k WHERE r.value = d.{c}) AS {c}" for c in CATEGORIES]
    steps["laid"] = f"SELECT id, y, {', '.join(place)} FROM credit d"
    steps["long"] = " UNION ALL ".join(f"SELECT '{c}' AS col, {c} AS value, y AS e, 1 - y AS n FROM laid" for c in cols)
    part = lambda v, total: f"(CASE WHEN sum({v}) = 0 THEN 1e-7 ELSE sum({v}) / (SELECT sum({total}) FROM laid) END)"
    steps["maps"] = f"SELECT col, value, ln({part('e', 'y')} / {part('n', '1 - y')}) AS woe FROM long GROUP BY col, value"
    steps["d"] = "SELECT y, " + ", ".join(f"m{i}.woe AS w{i}" for i in range(len(cols))) + " FROM laid " + " ".join(
        f"JOIN maps m{i} ON m{i}.col = '{c}' AND m{i}.value = laid.{c}" for i, c in enumerate(cols)
    ) + " WHERE CAST(CAST('0x' || substr(md5(concat(CAST(id AS STRING), '|11')), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 < 0.7"
    steps |= newton_subsets("d", [f"w{i}" for i in range(len(cols))], "y", rounds)
    # materialised steps keep expressions flat
    once += ["laid", "maps", "d", "fit", "info", *[f"{n}{r}" for n in ("s", "beta") for r in range(1, rounds + 1)]]
    once += [f"{n}_{i}" for n in ("info", *[f"s{r}" for r in range(1, rounds + 1)]) for i in (1, 3)]
    steps["wz"] = " UNION ALL ".join(
        f"SELECT m, {i} AS nth, '{c}' AS col, c{i + 1} AS coef, abs(c{i + 1}) / sqrt(v{i + 1}) AS z FROM fit WHERE (m >> {i}) & 1 = 1" for i, c in enumerate(cols)
    )
    every = 2 ** len(cols) - 1
    steps["way"] = f"""SELECT 0 AS step, {every}::BIGINT AS m UNION ALL SELECT step + 1, w.m - (1 << q.weak) FROM way w JOIN (
        SELECT m, arg_min(nth, {{'z': z, 'later': -ord(col)}}) AS weak, min(z) AS z FROM wz GROUP BY m) q ON q.m = w.m WHERE z < 1.959963984540054"""
    steps["best"] = f"SELECT CASE WHEN m = 0 THEN {every} ELSE m END AS m FROM way ORDER BY step DESC LIMIT 1"
    steps["chosen"] = "SELECT col, coef FROM wz JOIN best USING (m) UNION ALL SELECT 'const', c0 FROM fit JOIN best USING (m)"
    final = f"""SELECT 'basePoints' AS "column", '-' AS value, CAST(round_even({ALPHA!r}::DOUBLE - {BETA!r}::DOUBLE * coef, 0) AS BIGINT) AS points FROM chosen WHERE col = 'const'
      UNION ALL SELECT concat(col, '_BIN'), CAST(CAST(value AS BIGINT) AS VARCHAR), CAST(round_even(-{BETA!r}::DOUBLE * woe * coef, 0) AS BIGINT) FROM maps JOIN chosen USING (col)"""
    return sql(["credit"], steps, final, once=once)


@query("w19_build_scorecard", build_sql())
def _(t):
    return build_scorecard(t("credit"), "id", "y", MEASURES, CATEGORIES).card


@query("e09_compare_models")
def _(t):
    df = T.with_features(credit(t), XS, "y")
    models = {"logistic": T.estimator("logistic"), "tree": T.estimator("tree_classify")}
    return E.compare_models(models, df, "id", 3)


# a rule fitted like a model: positive above a share of the mean score of the positive training rows
PARAMS = (0.5, 0.9, 1.0, 1.2)


def _rule(share: float):
    def fit(train):
        centre = train.where("y = 1").agg(F.avg("score").alias("m")).scalar()
        return lambda rows: rows.withColumn("predicted", (F.col("score") >= F.lit(share) * centre).cast("int"))

    return fit


def _errors_sql(by: str) -> str:
    return f"""SELECT {by}, count(*) AS n, sum(CASE WHEN predicted = 1 AND y = 1 THEN 1 ELSE 0 END) / sum(y) AS recall,
      sum(CASE WHEN predicted = 1 AND y = 1 THEN 1 ELSE 0 END) / sum(predicted) AS precision, sqrt(avg((predicted - y) ** 2)) AS rmse
      FROM s GROUP BY {by}"""


@query(
    "e09_compare_parameters",
    sql(
        ["scored"],
        {
            "f": "SELECT *, CAST('0x' || substr(md5(concat(CAST(id AS STRING), '|11')), 1, 8) AS BIGINT) % 5 AS fold FROM scored",
            "k": "SELECT DISTINCT fold FROM f",
            "c": "SELECT k.fold, avg(score) AS centre FROM k JOIN f ON f.fold <> k.fold WHERE y = 1 GROUP BY k.fold",
            "s": f"SELECT param, f.fold, y, CASE WHEN score >= param * centre THEN 1 ELSE 0 END AS predicted FROM f JOIN c ON c.fold = f.fold, (SELECT unnest([{', '.join(f'{p}::DOUBLE' for p in PARAMS)}]) AS param)",
            "e": _errors_sql("param, fold"),
            "m": "SELECT param, avg(recall) AS mean_recall, avg(rmse) AS mean_rmse, stddev_pop(rmse) AS sd_rmse FROM e GROUP BY param",
        },
        "SELECT param, round(mean_recall, 8) AS mean_recall, round(mean_rmse, 8) AS mean_rmse, round(sd_rmse, 8) AS sd_rmse, "
        "row_number() OVER (ORDER BY round(mean_recall, 9) DESC, param) = 1 AS best FROM m",
    ),
)
def _(t):
    return rounded(E.compare_parameters(t("scored"), PARAMS, _rule, "y", "id"), 8, "mean_recall", "mean_rmse", "sd_rmse")


@query(
    "e09_shuffle_split",
    sql(
        ["scored"],
        {
            "f": "SELECT *, CAST(CAST('0x' || substr(md5(concat(CAST(id AS STRING), '|', CAST(11 + split AS STRING))), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 < 0.1 AS held FROM scored, range(0, 10) r(split)",
            "c": "SELECT split, avg(score) AS centre FROM f WHERE NOT held AND y = 1 GROUP BY split",
            "s": "SELECT f.split, y, CASE WHEN score >= centre THEN 1 ELSE 0 END AS predicted FROM f JOIN c ON c.split = f.split WHERE held",
            "e": _errors_sql("split"),
        },
        "SELECT CAST(split AS INT) AS split, n, round(recall, 8) AS recall, round(precision, 8) AS precision, round(rmse, 8) AS rmse FROM e",
    ),
)
def _(t):
    return rounded(E.shuffle_split(t("scored"), "id", _rule(1.0), "y"), 8, "recall", "precision", "rmse")


@query("e10_importance")
def _(t):
    model = T.train(credit(t), "forest_regress", XS, "y").stages[-1]
    return E.importance(t.spark, model, XS)


# A linear rule stands for a trained model: what it gives can be written in SQL.
RULE = " + ".join(f"{i} * {c}" for i, c in enumerate(X.ALL_COUNTERS, 1))
RUNS = ("1998-06-01", "1998-06-02", "1998-06-03")
# from the first run's day to the last one's, with all their earlier links
DAILY = {
    **STEPS,
    "one": _one(RUNS[0], "1998-06-04").replace("a.app_time BETWEEN", "a.app_time < TIMESTAMP '1998-06-04 00:00:00' AND a.app_time BETWEEN"),
    "inc": "SELECT * FROM applications WHERE apply_time >= TIMESTAMP '1998-06-01 00:00:00' AND apply_time < TIMESTAMP '1998-06-04 00:00:00'",
    **{k: v for k, v in WIDE_STEPS.items() if k not in STEPS},
}


@query(
    "r08_daily_run",
    hop_sql(BASE, DAILY, f"SELECT order_src, {', '.join(X.ALL_COUNTERS)}, CAST(i.apply_time AS DATE) AS dt, CAST({RULE} AS DOUBLE) AS score "
        "FROM wide JOIN inc i ON i.order_id = order_src"),
)
def _(t):
    """Three days, the first with applications that arrive a day late, the second run twice."""
    folders = Folders(scratch_path(t.spark, "daily"))
    apps, edges = t("applications"), stored(t("app_edges"), "edges")
    model = PipelineModel([SQLTransformer(statement=f"SELECT *, CAST({RULE} AS DOUBLE) AS prediction FROM __THIS__")])
    old = apps.where(F.col("apply_time") < F.lit(RUNS[0]).cast("timestamp_ntz")).select("order_id")
    commit_history(old, folders.history, "1998-05-31")
    late = (F.to_date("apply_time") == F.lit(RUNS[0]).cast("date")) & (F.col("order_id") % 3 == 0)
    daily_run(t.spark, RUNS[0], apps.where(~late), edges, folders, model)
    for day in (*RUNS[1:], RUNS[1]):
        daily_run(t.spark, day, apps, edges, folders, model)
    wide = t.spark.read.parquet(folders.features).select("order_src", *X.ALL_COUNTERS)
    scores = t.spark.read.parquet(folders.scores).select("order_src", "dt", "score")
    return wide.join(scores, "order_src")

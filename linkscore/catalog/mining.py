"""Queries of the text, mining and similarity families."""

from __future__ import annotations

from pyspark.sql import functions as F

from linkscore.catalog.aggregates import rounded
from linkscore.catalog.registry import query, sql
from linkscore.operators import mining as M
from linkscore.operators import similarity as S
from linkscore.operators import text as T
from linkscore.runtime import cut

TOKENS = r"list_filter(regexp_split_to_array(lower(text), '\W+'), lambda w: length(w) >= 3)"
WORDS = {
    "occ": f"SELECT doc_id, unnest({TOKENS}) AS word FROM documents",
    "lab": f"SELECT d.doc_id, toxic, unnest({TOKENS}) AS word FROM documents d JOIN labels USING (doc_id)",
    "vocab": "SELECT word, count(*) AS total, count(DISTINCT doc_id) AS docs FROM occ GROUP BY word",
}


def _labelled(t):
    return t("documents").join(t("labels").select("doc_id", "toxic"), "doc_id")


@query("t02_tokens", sql([], {}, f"SELECT doc_id, array_to_string({TOKENS}, ' ') AS tokens FROM documents"))
def _(t):
    return t("documents").select("doc_id", F.array_join(T.tokens(F.col("text")), " ").alias("tokens"))


@query("t03_vocabulary", sql([], WORDS, "SELECT * FROM vocab"))
def _(t):
    return T.vocabulary(T.words(t("documents"), "doc_id", "text"), "doc_id")


@query("t03_bag_of_words", sql([], WORDS, "SELECT doc_id, word, count(*) AS n FROM occ GROUP BY doc_id, word"))
def _(t):
    return T.bag_of_words(T.words(t("documents"), "doc_id", "text"), "doc_id")


NB = {
    **WORDS,
    "st": "SELECT DISTINCT doc_id, toxic, word FROM lab",
    "cn": "SELECT word, count(CASE WHEN toxic = 0 THEN 1 END) AS n0, count(CASE WHEN toxic = 1 THEN 1 END) AS n1 FROM st GROUP BY word",
    "md": "SELECT word, ln((n0 + 1) / ((SELECT sum(n0) FROM cn) + 2)) AS lp0, ln((n1 + 1) / ((SELECT sum(n1) FROM cn) + 2)) AS lp1 FROM cn",
    "pr": "SELECT ln(1 - avg(toxic)) AS p0, ln(avg(toxic)) AS p1 FROM documents JOIN labels USING (doc_id)",
    "sc": "SELECT doc_id, sum(lp0) + (SELECT p0 FROM pr) AS s0, sum(lp1) + (SELECT p1 FROM pr) AS s1 FROM (SELECT DISTINCT doc_id, word FROM occ) JOIN md USING (word) GROUP BY doc_id",
}


def _model(t):
    docs = _labelled(t)
    return T.nb_fit(T.words(docs, "doc_id", "text", keep=("toxic",)), docs, "doc_id", "toxic")


@query("t04_nb_fit", sql([], NB, "SELECT word, round(lp0, 8) AS lp0, round(lp1, 8) AS lp1 FROM md"))
def _(t):
    return rounded(_model(t)[0], 8, "lp0", "lp1")


@query("t04_nb_predict", sql([], NB, "SELECT doc_id, round(s0, 5) AS s0, round(s1, 5) AS s1, CASE WHEN s1 > s0 THEN 1 ELSE 0 END AS predicted FROM sc"))
def _(t):
    model, priors = _model(t)
    return rounded(T.nb_predict(T.words(t("documents"), "doc_id", "text"), cut(model), priors, "doc_id"), 5, "s0", "s1")


@query("t05_top_words", sql([], WORDS, "SELECT word, total, docs FROM vocab ORDER BY total DESC, word LIMIT 30"))
def _(t):
    return T.top_words(T.vocabulary(T.words(t("documents"), "doc_id", "text"), "doc_id"))


@query(
    "t05_without_top_words",
    sql([], {"occ": WORDS["occ"], "vocab": WORDS["vocab"], "rk": "SELECT word, total, row_number() OVER (ORDER BY total DESC, word) AS nth FROM vocab"},
        "SELECT word, total FROM rk WHERE nth > 30", once=("occ", "vocab", "rk"), recursive=False),
)
def _(t):
    occ = T.words(t("documents"), "doc_id", "text")
    rest = T.without_top_words(occ, T.vocabulary(occ, "doc_id"))
    return rest.groupBy("word").agg(F.count(F.lit(1)).alias("total"))


@query(
    "t05_top_indicative",
    sql([], {**NB, "lg": "SELECT 0 AS cls, word, lp0 AS lp FROM md UNION ALL SELECT 1, word, lp1 FROM md"},
        "SELECT cls, CAST(row_number() OVER (PARTITION BY cls ORDER BY lp DESC, word) AS INT) AS rank, word, round(lp, 8) AS lp FROM lg WHERE lp > -6"),
)
def _(t):
    return rounded(T.top_indicative(_model(t)[0]), 8, "lp")


@query("t06_spam_model")
def _(t):
    docs = _labelled(t).select("doc_id", "text", "toxic")
    return T.spam_model(docs, "text", "toxic").transform(docs).select("doc_id", "toxic", "prediction")


GAIN_COLS = ["priority", "segment", "nation"]


@query("t07_entropy", sql(["credit"], {"c": "SELECT count(*) AS n FROM credit GROUP BY priority"}, "SELECT round(sum(-(n / (SELECT sum(n) FROM c)) * log2(n / (SELECT sum(n) FROM c))), 8) AS entropy FROM c"))
def _(t):
    return rounded(M.entropy(t("credit"), "priority"), 8, "entropy")


@query(
    "t07_info_gain",
    sql(
        ["credit"],
        {
            "lg": " UNION ALL ".join(f"SELECT '{c}' AS col, {c} AS v, y FROM credit" for c in GAIN_COLS),
            "cv": "SELECT col, v, y, count(*) AS n, sum(count(*)) OVER (PARTITION BY col, v) AS nv, sum(count(*)) OVER (PARTITION BY col) AS na FROM lg GROUP BY col, v, y",
            "cy": "SELECT col, y, sum(n) AS ny, max(na) AS na FROM cv GROUP BY col, y",
            "w": "SELECT col, sum(-(ny / na) * log2(ny / na)) AS h FROM cy GROUP BY col",
        },
        "SELECT w.col AS \"column\", round(min(w.h) - sum(-n * log2(n / nv)) / max(na), 8) + 0.0 AS gain FROM cv JOIN w USING (col) GROUP BY w.col",
    ),
)
def _(t):
    return rounded(M.info_gain(t("credit"), GAIN_COLS, "y"), 8, "gain")


def _id3_gains(rows: str, by: str) -> str:
    """Information gain of both columns per node."""
    return f"""SELECT node, col, sum(h) - max(rest) AS gain FROM (
      SELECT z.node, z.col, -(ny / n) * log2(ny / n) AS h, rest FROM (
        SELECT node, col, y, count(*) AS ny, sum(count(*)) OVER (PARTITION BY node, col) AS n FROM {rows} GROUP BY node, col, y) z
      JOIN (SELECT node, col, sum(-c * log2(c / nv)) / sum(c) AS rest FROM (
        SELECT node, col, v, y, count(*) AS c, sum(count(*)) OVER (PARTITION BY node, col, v) AS nv FROM {rows} GROUP BY node, col, v, y)
        GROUP BY node, col) q ON q.node = z.node AND q.col = z.col) GROUP BY node, col"""


def _id3_nodes(rows: str) -> str:
    """Size and majority class (the smallest on a tie) of each node."""
    return f"""SELECT node, y AS prediction, CAST(total AS BIGINT) AS size FROM (SELECT node, y, row_number() OVER (PARTITION BY node ORDER BY count(*) DESC, y) AS nth,
      sum(count(*)) OVER (PARTITION BY node) AS total FROM {rows} GROUP BY node, y) WHERE nth = 1"""


ID3 = {
    "x0": "SELECT '' AS node, priority, segment, y FROM credit",
    "l0": "SELECT node, 'priority' AS col, priority AS v, y FROM x0 UNION ALL SELECT node, 'segment', segment, y FROM x0",
    "k0": _id3_gains("l0", "col"),
    "s0": "SELECT node, col FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY round(gain, 9) DESC, col) AS nth FROM k0 WHERE gain > 1e-12) WHERE nth = 1",
    "x1": "SELECT concat('/', col, '=', CASE col WHEN 'priority' THEN priority ELSE segment END) AS node, col AS used, priority, segment, y FROM x0 JOIN s0 ON s0.node = x0.node",
    "l1": "SELECT node, 'priority' AS col, priority AS v, y FROM x1 WHERE used <> 'priority' UNION ALL SELECT node, 'segment', segment, y FROM x1 WHERE used <> 'segment'",
    "k1": _id3_gains("l1", "col"),
    "s1": "SELECT node, col FROM k1 WHERE gain > 1e-12",
    "x2": "SELECT concat(x1.node, '/', col, '=', CASE col WHEN 'priority' THEN priority ELSE segment END) AS node, y FROM x1 JOIN s1 ON s1.node = x1.node",
    "n": f"SELECT n0.node, col, prediction, size FROM ({_id3_nodes('x0')}) n0 LEFT JOIN s0 ON s0.node = n0.node UNION ALL "
    f"SELECT n1.node, col, prediction, size FROM ({_id3_nodes('x1')}) n1 LEFT JOIN s1 ON s1.node = n1.node UNION ALL "
    f"SELECT n2.node, NULL, prediction, size FROM ({_id3_nodes('x2')}) n2",
}


@query("t07_id3", sql(["credit"], ID3, 'SELECT node, col AS "column", prediction, size FROM n'))
def _(t):
    return M.id3(t("credit"), ["priority", "segment"], "y", 2)


@query(
    "t08_regression_split",
    """WITH lg AS (SELECT 'l_quantity' AS col, l_quantity AS x, l_extendedprice AS y FROM lineitem UNION ALL SELECT 'l_discount', l_discount, l_extendedprice FROM lineitem),
    g AS (SELECT col, x, count(*) AS n, sum(y) AS s FROM lg GROUP BY col, x),
    r AS (SELECT col, x, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER (PARTITION BY col) AS na, sum(s) OVER (PARTITION BY col) AS sa FROM g WINDOW w AS (PARTITION BY col ORDER BY x))
    SELECT col AS "column", x AS value, round((sl * sl / nl + (sa - sl) * (sa - sl) / (na - nl) - sa * sa / na) / 1e6, 0) AS gain FROM r WHERE nl < na ORDER BY 3 DESC LIMIT 1""",
)
def _(t):
    best = M.regression_split(t("lineitem"), ["l_quantity", "l_discount"], "l_extendedprice")
    return best.withColumn("gain", F.round(F.col("gain") / 1e6, 0))


def _tree_sql(depth: int) -> dict:
    """A level per step: all cuts by running sums, the best one per node, rows handed to the halves."""
    out = {"x0": "SELECT l_quantity AS a, l_discount AS b, l_extendedprice AS y, '' AS node FROM lineitem"}
    for s in range(depth):
        out[f"g{s}"] = f"""SELECT node, col, x, count(*) AS n, sum(y) AS s FROM (SELECT node, 'l_quantity' AS col, a AS x, y FROM x{s}
          UNION ALL SELECT node, 'l_discount', b, y FROM x{s}) GROUP BY node, col, x"""
        out[f"r{s}"] = f"""SELECT node, col, x, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER v AS na, sum(s) OVER v AS sa
          FROM g{s} WINDOW w AS (PARTITION BY node, col ORDER BY x), v AS (PARTITION BY node, col)"""
        out[f"c{s}"] = f"""SELECT node, col, x, sl * sl / nl + (sa - sl) * (sa - sl) / (na - nl) - sa * sa / na AS gain
          FROM r{s} WHERE nl < na AND nl >= 4 AND na - nl >= 4"""
        out[f"s{s}"] = f"SELECT node, col, x FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, col DESC, x DESC) AS nth FROM c{s} WHERE gain >= 1) WHERE nth = 1"
        out[f"x{s + 1}"] = f"SELECT a, b, y, concat(t.node, CASE WHEN CASE col WHEN 'l_quantity' THEN a ELSE b END <= x THEN 'L' ELSE 'R' END) AS node FROM x{s} t JOIN s{s} ON s{s}.node = t.node"
    levels = [f"SELECT t.node, any_value(col) AS col, any_value(x) AS x, count(*) AS n, avg(y) AS mean FROM x{s} t LEFT JOIN s{s} ON s{s}.node = t.node GROUP BY t.node" for s in range(depth)]
    out["t"] = " UNION ALL ".join([*levels, f"SELECT node, NULL, NULL, count(*), avg(y) FROM x{depth} GROUP BY node"])
    return out


@query(
    "t08_reg_tree",
    sql([], _tree_sql(3), 'SELECT node, col AS "column", x AS value, n, round(mean, 4) AS mean FROM t', once=tuple(f"{k}{s}" for s in range(4) for k in "xs")),
)
def _(t):
    return rounded(M.reg_tree(t("lineitem"), ["l_quantity", "l_discount"], "l_extendedprice", 3), 4, "mean")


TREE_COLS = ["l_quantity", "l_discount"]


@query("t08_model_tree")
def _(t):
    lines = t("lineitem")
    tree = M.model_tree(lines, TREE_COLS, "l_extendedprice", 2)
    rows = [(r["node"], r["column"], r["value"], r["n"], r["coef"]) for r in tree]
    return t.spark.createDataFrame(rows, "node string, column string, value double, n long, coef array<double>")


@query("t08_pruned_tree")
def _(t):
    """A tree grown on the odd orders, pruned on the even ones."""
    lines = t("lineitem")
    grown = M.reg_tree(lines.where("l_orderkey % 2 = 1"), TREE_COLS, "l_extendedprice", 3).collect()
    kept = M.prune(grown, lines.where("l_orderkey % 2 = 0"), TREE_COLS, "l_extendedprice")
    rows = [(r["node"], r["column"], r["value"], r["n"], r["mean"]) for r in kept]
    return t.spark.createDataFrame(rows, "node string, column string, value double, n long, mean double")


CENTRES = [[10.0, 20000.0], [25.0, 40000.0], [40.0, 80000.0]]


def _lloyd_sql(rounds: int) -> dict:
    steps = {"c0": "SELECT * FROM (VALUES " + ", ".join(f"({i}, {a}::DOUBLE, {b}::DOUBLE)" for i, (a, b) in enumerate(CENTRES)) + ") v(k, a, b)"}
    for r in range(rounds + 1):
        steps[f"a{r}"] = (
            f"SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS x, l_extendedprice AS z, arg_min(k, sqrt((l_quantity - a) ** 2 + (l_extendedprice - b) ** 2)) AS k "
            f"FROM (SELECT *, row_number() OVER () AS rn FROM lineitem), c{r} GROUP BY rn, l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice"
        )
        steps[f"c{r + 1}"] = f"SELECT k, avg(x) AS a, avg(z) AS b FROM a{r} GROUP BY k"
    return steps


@query("t09_kmeans_rounds", sql([], _lloyd_sql(2), "SELECT CAST(k AS INT) AS cluster, count(*) AS n, round(avg(x), 4) AS quantity, round(avg(z), 2) AS price FROM a2 GROUP BY k"))
def _(t):
    cols = ["l_quantity", "l_extendedprice"]
    centres = M.lloyd(t("lineitem"), cols, CENTRES, 2)
    placed = M.assign(t("lineitem"), cols, centres)
    return placed.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("l_quantity"), 4).alias("quantity"), F.round(F.avg("l_extendedprice"), 2).alias("price")
    )


def bisecting_sql(rounds: int = 60) -> str:
    """Halves of all points, then of each half, by two-means from the corners; the half that saves more is split for good."""
    km = lambda p: f"acos(least(1, greatest(-1, sin(radians(lat)) * sin(radians({p}lat)) + cos(radians(lat)) * cos(radians({p}lat)) * cos(radians({p}lon - lon))))) * 6371.0"
    right = f"({km('b')} < {km('a')})"

    def halves(n: int) -> dict:
        """Centres of the two halves of each part of ``pt<n>``, and the parts' errors before and after."""
        side = lambda which, c: f"coalesce(avg(CASE WHEN {'NOT ' * (which == 'a')}{right} THEN {c} END), max({which}{c}))"
        return {
            f"l{n}": f"""SELECT 0 AS step, part, min(lat) AS alat, min(lon) AS alon, max(lat) AS blat, max(lon) AS blon FROM pt{n} GROUP BY part
              UNION ALL SELECT step + 1, part, {side('a', 'lat')}, {side('a', 'lon')}, {side('b', 'lat')}, {side('b', 'lon')}
              FROM l{n} JOIN pt{n} USING (part) WHERE step < {rounds} GROUP BY step, part""",
            f"c{n}": f"SELECT * FROM l{n} JOIN (SELECT part, avg(lat) AS mlat, avg(lon) AS mlon FROM pt{n} GROUP BY part) USING (part) WHERE step = {rounds}",
            f"h{n}": f"SELECT *, {right} AS far, {km('m')} AS before, least({km('a')}, {km('b')}) AS after FROM pt{n} JOIN c{n} USING (part)",
        }

    steps = {
        "pt0": "SELECT c_custkey, c_nationkey * 3.0::DOUBLE - 40 AS lat, c_acctbal / 100 AS lon, 0 AS part FROM customer",
        **halves(0),
        "pt1": "SELECT c_custkey, lat, lon, CAST(far AS INT) AS part FROM h0",
        **halves(1),
        "best": "SELECT part FROM h1 GROUP BY part ORDER BY sum(before * before) - sum(after * after) DESC, part LIMIT 1",
    }
    final = "SELECT c_custkey, lat, lon, CAST(CASE WHEN far AND part = (SELECT part FROM best) THEN 2 ELSE part END AS INT) AS cluster FROM h1"
    return sql([], steps, final, once=("pt0", "pt1", "h0", "h1"))


@query("t09_bisecting_kmeans", bisecting_sql())
def _(t):
    cols = ["lat", "lon"]
    pts = t("customer").select("c_custkey", (F.col("c_nationkey") * 3.0 - 40).alias("lat"), (F.col("c_acctbal") / 100).alias("lon"))
    return M.bisect_clusters(pts, cols, 3, dist=M.great_circle)[1]


SUPPORT = 0.015
SETS = {
    "n": "SELECT count(DISTINCT basket) AS n FROM baskets",
    # all subsets of a basket, so sets of any length are counted
    "grown": "SELECT basket, [item] AS items FROM baskets UNION ALL SELECT g.basket, list_append(g.items, b.item) FROM grown g JOIN baskets b ON b.basket = g.basket AND b.item > g.items[len(g.items)]",
    "f": f"SELECT items, count(*) AS n FROM grown GROUP BY items HAVING count(*) >= {SUPPORT} * (SELECT n FROM n)",
}
ITEMS = "array_to_string(items, ',') AS items"


@query("t10_apriori", sql(["baskets"], SETS, f"SELECT {ITEMS}, CAST(len(items) AS INT) AS size, n, round(n / (SELECT n FROM n), 8) AS support FROM f"))
def _(t):
    out = M.apriori(t("baskets"), SUPPORT)
    return rounded(out.withColumn("items", F.array_join("items", ",")), 8, "support")


@query(
    "t11_rules",
    sql(["baskets"], {**SETS, "r": """SELECT a.items AS ante, list_filter(f.items, lambda x: NOT list_contains(a.items, x)) AS cons, f.n / a.n AS conf
      FROM f JOIN f a ON len(a.items) < len(f.items) AND list_has_all(f.items, a.items)"""},
        "SELECT array_to_string(ante, ',') AS antecedent, array_to_string(cons, ',') AS consequent, round(conf, 8) AS confidence FROM r WHERE conf >= 0.1"),
)
def _(t):
    found = M.rules(cut(M.apriori(t("baskets"), SUPPORT)), 0.1)
    out = found.select(F.array_join("antecedent", ",").alias("antecedent"), F.array_join("consequent", ",").alias("consequent"), "confidence")
    return rounded(out, 8, "confidence")


@query(
    "t12_fp_growth",
    sql(["baskets"], {k: v.replace(f"{SUPPORT} * (SELECT n FROM n)", "225") for k, v in SETS.items()}, f"SELECT {ITEMS}, CAST(len(items) AS INT) AS size, n FROM f"),
)
def _(t):
    return M.fp_growth(t("baskets"), 225).withColumn("items", F.array_join("items", ","))


PAIR = {
    "pr": "SELECT a.item_id AS ia, b.item_id AS ib, a.rating AS x, b.rating AS y FROM ratings a JOIN ratings b ON a.user_id = b.user_id AND a.item_id < b.item_id",
    "sm": "SELECT ia, ib, count(*) AS n, sum((x - y) * (x - y)) AS dd, sum(x) AS sx, sum(y) AS sy, sum(x * y) AS xy, sum(x * x) AS xx, sum(y * y) AS yy FROM pr GROUP BY ia, ib",
    "cs": "SELECT ia, ib, n, 0.5 + 0.5 * xy / (sqrt(xx) * sqrt(yy)) AS s FROM sm",
}
SIMS = {
    "euclid": "1 / (1 + sqrt(dd))",
    "cosine": "0.5 + 0.5 * xy / (sqrt(xx) * sqrt(yy))",
    "pearson": "CASE WHEN n < 3 THEN 1.0 ELSE 0.5 + 0.5 * CASE WHEN n * xx - sx * sx > 0 AND n * yy - sy * sy > 0 THEN (n * xy - sx * sy) / sqrt((n * xx - sx * sx) * (n * yy - sy * sy)) END END",
}
for _kind, _expr in SIMS.items():

    def _sim(t, kind=_kind):
        return rounded(S.item_similarity(t("ratings"), kind), 8, "similarity")

    query(f"t14_similarity_{_kind}", sql(["ratings"], PAIR, f"SELECT ia AS item_a, ib AS item_b, n, round({_expr}, 8) + 0.0 AS similarity FROM sm"))(_sim)


@query(
    "t15_recommend",
    sql(
        ["ratings"],
        {
            **PAIR,
            "sy": "SELECT ia AS item_id, ib AS other, s FROM cs UNION ALL SELECT ib, ia, s FROM cs",
            "pd": "SELECT user_id, other AS item_id, sum(s * rating) / sum(s) AS p FROM ratings JOIN sy USING (item_id) GROUP BY user_id, other",
            "op": "SELECT * FROM pd WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.user_id = pd.user_id AND r.item_id = pd.item_id)",
        },
        "SELECT user_id, item_id, predicted, rank FROM (SELECT user_id, item_id, round(p, 6) AS predicted, CAST(row_number() OVER (PARTITION BY user_id ORDER BY round(p, 9) DESC, item_id) AS INT) AS rank FROM op) WHERE rank <= 3",
    ),
)
def _(t):
    return rounded(S.recommend(t("ratings"), 3), 6, "predicted")


@query("t16_recommend_reduced")
def _(t):
    return S.recommend_reduced(t("ratings"), 3, 4)

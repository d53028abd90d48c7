"""Queries of the scorecard family that SQL can check."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from linkscore.catalog.aggregates import rounded
from linkscore.catalog.registry import query, sql
from linkscore.operators import binning as B
from linkscore.operators import card as C
from linkscore.operators import woe as W
from linkscore.runtime import cut

CATS = ["priority", "segment", "nation"]


def _woe_of(source: str, key: str) -> str:
    return f"""SELECT {key}, e AS event, n AS nonevent, ln(er / nr) AS woe, (er - nr) * ln(er / nr) AS iv FROM (
      SELECT {key}, e, n, CASE WHEN e = 0 THEN 1e-7 ELSE e / (SELECT sum(y) FROM credit) END AS er,
      CASE WHEN n = 0 THEN 1e-7 ELSE n / (SELECT sum(1 - y) FROM credit) END AS nr
      FROM (SELECT {key}, CAST(sum(y) AS BIGINT) AS e, CAST(sum(1 - y) AS BIGINT) AS n FROM {source} GROUP BY {key}))"""


LONG = {
    "long": " UNION ALL ".join(f"SELECT '{c}' AS col, {c} AS value, y, id FROM credit" for c in CATS),
    "maps": _woe_of("long", "col, value"),
}


@query("w02_woe_table", sql(["credit"], {"w": _woe_of("credit", "priority")}, "SELECT priority, event, nonevent, round(woe, 7) AS woe, round(iv, 9) AS iv FROM w"))
def _(t):
    return rounded(rounded(W.woe_table(t("credit"), "priority", "y"), 7, "woe"), 9, "iv")


@query(
    "w03_information_values",
    sql(["credit"], LONG, "SELECT col AS \"column\", round(sum(iv), 8) AS iv FROM maps GROUP BY col"),
)
def _(t):
    return rounded(W.information_values(W.woe_long(t("credit"), CATS, "y")), 8, "iv")


@query(
    "w04_woe_transform",
    sql(["credit"], LONG, "SELECT id, " + ", ".join(f"round(m{i}.woe, 7) + 0.0 AS \"{c}_WOE\"" for i, c in enumerate(CATS)) + " FROM credit "
        + " ".join(f"JOIN maps m{i} ON m{i}.col = '{c}' AND m{i}.value = {c}" for i, c in enumerate(CATS))),
)
def _(t):
    out, _maps = W.woe_transform(t("credit"), CATS, "y")
    names = [f"{c}_WOE" for c in CATS]
    return rounded(out.select("id", *names), 7, *names)


def grid(col: str, table: str = "credit", m: int = 100) -> str:
    return f"""SELECT CAST(i AS INT) AS bin, lo + (i - 1) * (hi - lo) / {m} - CASE WHEN i = 1 THEN 0.0001 ELSE 0 END AS lower,
      lo + i * ((hi - lo) / {m}) + CASE WHEN i = {m} THEN 0.0001 ELSE 0 END AS upper
      FROM (SELECT min({col}) AS lo, max({col}) AS hi FROM {table}), range(1, {m + 1}) r(i)"""


@query("w05_equal_width_bins", sql(["credit"], {"g": grid("price")}, "SELECT bin, round(lower, 5) AS lower, round(upper, 5) AS upper FROM g"))
def _(t):
    return rounded(B.equal_width_bins(t("credit"), "price"), 5, "lower", "upper")


@query(
    "w06_apply_bins",
    sql(["credit"], {"b": "SELECT * FROM (VALUES (1, 1000.0, 100000.0), (2, 100000.0, 250000.0), (3, 250000.0, 400000.0)) v(bin, lower, upper)"},
        "SELECT id, coalesce((SELECT max(bin) FROM b WHERE price BETWEEN lower AND upper), 0) AS \"price_BIN\" FROM credit"),
)
def _(t):
    bins = t.spark.createDataFrame([(1, 1000.0, 100000.0), (2, 100000.0, 250000.0), (3, 250000.0, 400000.0)], "bin int, lower double, upper double")
    return B.apply_bins(t("credit"), "price", bins).select("id", "price_BIN")


@query(
    "w06_many_bins",
    sql(["credit"], {"g": "SELECT bin, lower, upper FROM (" + grid("price", m=100_000) + ")"},
        "SELECT id, CAST(CASE WHEN price <= upper THEN bin ELSE 0 END AS INT) AS \"price_BIN\" FROM credit ASOF JOIN g ON price >= lower"),
)
def _(t):
    """A hundred thousand bins."""
    return B.apply_bins(t("credit"), "price", B.equal_width_bins(t("credit"), "price", 0.00001)).select("id", "price_BIN")


@query(
    "w01_require_binary",
    sql(["credit"], {}, " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {e}) = 2 AND min({e}) = 0 AND max({e}) = 1 AND count({e}) = count(*) AS ok FROM credit"
        for c, e in (("y", "y"), ("all_bad", "y * 0 + 1"), ("code", "CAST(nation AS INT)"), ("gap", "CASE WHEN id % 3 = 0 THEN NULL ELSE y END"))
    )),
)
def _(t):
    df = t("credit").select("y", (F.col("y") * 0 + 1).alias("all_bad"), F.col("nation").cast("int").alias("code"), F.when(F.col("id") % 3 != 0, F.col("y")).alias("gap"))
    found = []
    for c in df.columns:
        try:
            W.require_binary(df, c)
            found.append((c, True))
        except ValueError:
            found.append((c, False))
    return t.spark.createDataFrame(found, "column string, ok boolean")


def binned(col: str) -> str:
    return f"""SELECT '{col}' AS var, least(CAST(floor(({col} - lo) / ((hi - lo) / 100)) AS INT), 99) + 1 AS bin, y
      FROM credit, (SELECT min({col}) AS lo, max({col}) AS hi FROM credit)"""


COUNTS = {
    "x": binned("price") + " UNION ALL " + binned("balance"),
    "k": "SELECT var, bin, sum(1 - y) AS n0, sum(y) AS n1 FROM x GROUP BY var, bin",
    "g": "SELECT var, CAST(i AS INT) AS bin FROM (SELECT DISTINCT var FROM x), range(1, 101) r(i)",
    "counts": """SELECT g.var, g.bin, CAST(coalesce(n0, 0) AS BIGINT) AS n0, CAST(coalesce(n1, 0) AS BIGINT) AS n1
      FROM g LEFT JOIN k ON k.var = g.var AND k.bin = g.bin""",
}


@query("w07_bin_counts", sql(["credit"], COUNTS, "SELECT var, bin, n0, n1, n0 + n1 AS total FROM counts"))
def _(t):
    return B.bin_counts(t("credit"), ["price", "balance"], "y").drop("lower", "upper")


# A thousand narrow bins leave some without one of the classes; from the left, bins are
# joined until both are there, and what is left over at the end joins the bin before.
NARROW = {
    **{k: v.replace("/ 100)", "/ 1000)").replace("99)", "999)").replace("range(1, 101)", "range(1, 1001)") for k, v in COUNTS.items()},
    "lined": "SELECT * FROM counts",
    "fold": """SELECT var, bin, 1 AS grp, n0, n1, n0 AS s0, n1 AS s1 FROM lined WHERE bin = 1 UNION ALL
      SELECT c.var, c.bin, CASE WHEN s0 > 0 AND s1 > 0 THEN grp + 1 ELSE grp END, c.n0, c.n1,
      CASE WHEN s0 > 0 AND s1 > 0 THEN c.n0 ELSE s0 + c.n0 END, CASE WHEN s0 > 0 AND s1 > 0 THEN c.n1 ELSE s1 + c.n1 END
      FROM fold f JOIN lined c ON c.var = f.var AND c.bin = f.bin + 1""",
    "joined": "SELECT var, grp, max(bin) AS last, sum(n0) AS n0, sum(n1) AS n1, max(grp) OVER (PARTITION BY var) AS groups FROM fold GROUP BY var, grp",
    "closed": "SELECT var, CASE WHEN grp = groups AND grp > 1 AND (n0 = 0 OR n1 = 0) THEN grp - 1 ELSE grp END AS bin, n0, n1 FROM joined",
}


@query(
    "w07_merge_empty",
    sql(["credit"], NARROW, "SELECT var, CAST(bin AS INT) AS bin, CAST(sum(n0) AS BIGINT) AS n0, CAST(sum(n1) AS BIGINT) AS n1, "
        "CAST(sum(n0 + n1) AS BIGINT) AS total FROM closed GROUP BY var, bin"),
)
def _(t):
    return B.merge_empty(B.bin_counts(t("credit"), ["price", "balance"], "y", acc=0.001)).drop("lower", "upper")


# the raw bins, some of them without a class or without any row
CUTS = {
    "s": """SELECT var, bin AS cut, CAST(sum(n0) OVER w AS DOUBLE) AS l0, CAST(sum(n1) OVER w AS DOUBLE) AS l1,
      CAST(sum(n0) OVER v AS DOUBLE) AS a0, CAST(sum(n1) OVER v AS DOUBLE) AS a1, max(bin) OVER v AS last
      FROM counts WINDOW w AS (PARTITION BY var ORDER BY bin), v AS (PARTITION BY var)""",
    "c": "SELECT *, a0 - l0 AS u0, a1 - l1 AS u1, a0 + a1 AS n FROM s WHERE cut < last",
}


def gini(a, b):
    return f"coalesce(1 - ({a} * {a} + {b} * {b}) / nullif(({a} + {b}) * ({a} + {b}), 0), 0)"


def ent(a, b):
    term = "CASE WHEN {0} > 0 THEN -({0} / ({1} + {2})) * log2({0} / ({1} + {2})) ELSE 0 END"
    return f"({term.format(a, a, b)} + {term.format(b, a, b)})"


def chi2(a, b):
    e0, e1 = f"(({a} + {b}) * a0 / n)", f"(({a} + {b}) * a1 / n)"
    return f"(coalesce(({a} - {e0}) ** 2 / nullif({e0}, 0), 0) + coalesce(({b} - {e1}) ** 2 / nullif({e1}, 0), 0))"


def iv(a, b):
    return f"(CASE WHEN {a} > 0 AND {b} > 0 THEN ({a} / a0 - {b} / a1) * ln(({a} * a1) / ({b} * a0)) END)"


def impurity(form):
    return f"1 - ((l0 + l1) * {form('l0', 'l1')} + (u0 + u1) * {form('u0', 'u1')}) / (n * {form('a0', 'a1')})"


MERITS = {
    1: impurity(gini),
    2: impurity(ent),
    3: chi2("l0", "l1") + " + " + chi2("u0", "u1"),
    4: iv("l0", "l1") + " + " + iv("u0", "u1"),
}


def _each(t, merit, methods):
    fine = cut(B.bin_counts(t("credit"), ["price", "balance"], "y").select("var", "bin", "n0", "n1"))
    out = None
    for m in methods:
        part = rounded(merit(fine, m).withColumn("method", F.lit(m)), 8, "merit")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "w08_split_merit",
    sql(["credit"], {**COUNTS, **CUTS}, " UNION ALL ".join(f"SELECT var, {m} AS method, cut, round({e}, 8) + 0.0 AS merit FROM c" for m, e in MERITS.items())),
)
def _(t):
    return _each(t, B.split_merit, MERITS)


WHOLE = {
    "b": """SELECT var, CAST(n0 AS DOUBLE) AS n0, CAST(n1 AS DOUBLE) AS n1, CAST(sum(n0) OVER v AS DOUBLE) AS a0,
      CAST(sum(n1) OVER v AS DOUBLE) AS a1, CAST(sum(n0 + n1) OVER v AS DOUBLE) AS n FROM counts WINDOW v AS (PARTITION BY var)""",
}
WHOLE_MERITS = {
    1: f"1 - sum((n0 + n1) * {gini('n0', 'n1')}) / (max(n) * {gini('max(a0)', 'max(a1)')})",
    2: f"1 - sum((n0 + n1) * {ent('n0', 'n1')}) / (max(n) * {ent('max(a0)', 'max(a1)')})",
    3: f"sum({chi2('n0', 'n1')})",
    4: f"sum({iv('n0', 'n1')})",
}


@query(
    "w09_binning_merit",
    sql(["credit"], {**COUNTS, **WHOLE}, " UNION ALL ".join(f"SELECT var, {m} AS method, round({e}, 8) + 0.0 AS merit FROM b GROUP BY var" for m, e in WHOLE_MERITS.items())),
)
def _(t):
    return _each(t, B.binning_merit, WHOLE_MERITS)


def _greedy(steps: int, tag: str = "") -> dict:
    """Greedy cuts of ``r<tag>`` one after the other: best cut of each group, then the one best for the whole partition."""
    part = "CASE WHEN {0} > 0 AND {1} > 0 THEN ({0} / {2} - {1} / {3}) * ln(({0} * {3}) / ({1} * {2})) END"
    rows = f"r{tag}"
    out = {f"b{tag}0": f"SELECT 0 AS k, 0.0::DOUBLE AS c0, 0.0::DOUBLE AS c1 UNION ALL SELECT max(k), max(c0), max(c1) FROM {rows}"}
    for n in range(steps):
        s = f"{tag}{n}"
        out[f"g{s}"] = f"SELECT k AS lo, c0 AS l0, c1 AS l1, lead(k) OVER w AS hi, lead(c0) OVER w AS h0, lead(c1) OVER w AS h1 FROM b{s} WINDOW w AS (ORDER BY k)"
        out[f"m{s}"] = (
            f"SELECT lo, k, c0, c1, {part.format('(c0 - l0)', '(c1 - l1)', '(h0 - l0)', '(h1 - l1)')} + "
            f"{part.format('(h0 - c0)', '(h1 - c1)', '(h0 - l0)', '(h1 - l1)')} AS merit FROM {rows} JOIN g{s} ON k > lo AND k < hi"
        )
        out[f"p{s}"] = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lo ORDER BY merit DESC, k) AS nth FROM m{s} WHERE merit > 0) WHERE nth = 1"
        out[f"u{s}"] = f"SELECT p.k AS cand, b.k, b.c0, b.c1 FROM p{s} p, b{s} b UNION ALL SELECT k, k, c0, c1 FROM p{s}"
        out[f"d{s}"] = f"SELECT cand, c0 - lag(c0) OVER w AS d0, c1 - lag(c1) OVER w AS d1, max(c0) OVER (PARTITION BY cand) AS a0, max(c1) OVER (PARTITION BY cand) AS a1 FROM u{s} WINDOW w AS (PARTITION BY cand ORDER BY k)"
        out[f"v{s}"] = f"SELECT cand, sum({part.format('d0', 'd1', 'a0', 'a1')}) AS merit FROM d{s} WHERE d0 IS NOT NULL GROUP BY cand"
        out[f"b{tag}{n + 1}"] = f"SELECT * FROM b{s} UNION ALL SELECT k, c0, c1 FROM {rows} WHERE k = (SELECT cand FROM v{s} ORDER BY merit DESC, cand LIMIT 1)"
    return out


def optimal_steps(cols: list[str]) -> dict:
    """A hundred bins, those without a class joined, cut greedily: ``o_<col>`` has the narrow bins of each new one."""
    steps = {k: v.replace("/ 1000)", "/ 100)").replace("999)", "99)").replace("range(1, 1001)", "range(1, 101)") for k, v in NARROW.items()}
    steps["joined"] = steps["joined"].replace("max(bin) AS last", "min(bin) AS first, max(bin) AS last")
    steps["closed"] = steps["closed"].replace("AS bin, n0", "AS bin, first, last, n0")
    for c in cols:
        w = "ORDER BY bin ROWS UNBOUNDED PRECEDING"
        steps[f"r_{c}_"] = f"""SELECT bin AS k, first, last, n0, n1, CAST(sum(n0) OVER ({w}) AS DOUBLE) AS c0, CAST(sum(n1) OVER ({w}) AS DOUBLE) AS c1
          FROM (SELECT bin, min(first) AS first, max(last) AS last, sum(n0) AS n0, sum(n1) AS n1 FROM closed WHERE var = '{c}' GROUP BY bin)"""
        steps |= _greedy(4, f"_{c}_")
        steps[f"o_{c}"] = f"""SELECT newbin, min(first) AS first, max(last) AS last, sum(n0) AS n0, sum(n1) AS n1
          FROM (SELECT *, (SELECT count(*) FROM b_{c}_4 b WHERE b.k < r.k) AS newbin FROM r_{c}_ r) GROUP BY newbin"""
    return steps


def optimal_once(cols: list[str]) -> list[str]:
    return ["closed", *[n for c in cols for n in (f"o_{c}", f"r_{c}_", *[f"b_{c}_{s}" for s in range(5)])]]


def optimal_sql(cols: list[str]) -> str:
    """Borders follow from the first and last narrow bin."""
    rows = [
        f"""SELECT '{c}' AS var, newbin, lo + (first - 1) * (hi - lo) / 100 - CASE WHEN first = 1 THEN 0.0001 ELSE 0 END AS lower,
          lo + last * (hi - lo) / 100 + CASE WHEN last = 100 THEN 0.0001 ELSE 0 END AS upper, n0, n1 FROM o_{c}, (SELECT min({c}) AS lo, max({c}) AS hi FROM credit)"""
        for c in cols
    ]
    final = f"""SELECT var, CAST(newbin AS INT) AS newbin, round(lower, 5) AS lower, round(upper, 5) AS upper, CAST(n0 AS BIGINT) AS n0, CAST(n1 AS BIGINT) AS n1,
      CAST(n0 + n1 AS BIGINT) AS total FROM ({' UNION ALL '.join(rows)})"""
    return sql(["credit"], optimal_steps(cols), final, once=optimal_once(cols))


@query("w10_optimal_bins", optimal_sql(["price", "balance"]))
def _(t):
    return rounded(B.optimal_bins(t("credit"), ["price", "balance"], "y"), 5, "lower", "upper")


def category_steps(col: str, tag: str = "") -> dict:
    """Categories ordered by rate in ``r<tag>``, cut greedily; ``b<tag>4`` has the borders."""
    return {
        f"cat{tag}": f"SELECT {col} AS value, CAST(sum(1 - y) AS DOUBLE) AS n0, CAST(sum(y) AS DOUBLE) AS n1 FROM credit GROUP BY {col}",
        f"r{tag}": f"""SELECT *, row_number() OVER w AS k, sum(n0) OVER w AS c0, sum(n1) OVER w AS c1 FROM cat{tag}
          WINDOW w AS (ORDER BY n1 / (n0 + n1), value ROWS UNBOUNDED PRECEDING)""",
        **_greedy(4, tag),
    }


@query(
    "w11_reduce_categories",
    sql(["credit"], category_steps("nation"), "SELECT value, CAST((SELECT count(*) FROM b4 WHERE b4.k < r.k) AS INT) AS grp, CAST(n0 AS BIGINT) AS n0, CAST(n1 AS BIGINT) AS n1 FROM r",
        once=("r", *[f"b{s}" for s in range(5)])),
)
def _(t):
    return B.reduce_categories(t("credit"), "nation", "y")


GROUPS = {
    "cats": "SELECT nation AS value, CAST(1 + CAST(nation AS INT) % 4 AS INT) AS grp FROM credit GROUP BY nation",
}


def _groups(t):
    return t("credit").select(F.col("nation").alias("value")).distinct().withColumn("grp", (F.col("value").cast("int") % 4 + 1).cast("int"))


@query("w12_apply_category_map", sql(["credit"], GROUPS, "SELECT id, grp AS \"nation_BIN\" FROM credit LEFT JOIN cats ON value = nation"))
def _(t):
    return B.apply_category_map(t("credit"), "nation", _groups(t)).select("id", "nation_BIN")


@query("w12_group_labels", sql(["credit"], GROUPS, "SELECT grp, concat(array_to_string(list_sort(list(value)), ';'), ';') AS categories FROM cats GROUP BY grp"))
def _(t):
    return B.group_labels(_groups(t))


COEFS = [("const", -1.25), ("priority", -0.8), ("segment", 1.1), ("nation", 0.65)]
BETA = 20 / math.log(2)
ALPHA = 600 - BETA * math.log(60)
CARD = {
    **LONG,
    "coefs": "SELECT * FROM (VALUES " + ", ".join(f"('{c}', {v}::DOUBLE)" for c, v in COEFS) + ") v(col, coef)",
    "card": f"""SELECT 'basePoints' AS col, '-' AS value, CAST(round_even({ALPHA!r}::DOUBLE - {BETA!r}::DOUBLE * coef, 0) AS BIGINT) AS points FROM coefs WHERE col = 'const'
      UNION ALL SELECT m.col, value, CAST(round_even(-{BETA!r}::DOUBLE * woe * coef, 0) AS BIGINT) FROM maps m JOIN coefs USING (col)""",
}


def _card(t):
    coefs = t.spark.createDataFrame(COEFS, "column string, coef double")
    return C.scorecard(coefs, W.woe_long(t("credit"), CATS, "y"))


@query("w13_scorecard", sql(["credit"], CARD, "SELECT col AS \"column\", value, points FROM card"))
def _(t):
    return _card(t)


@query(
    "w14_score_with_card",
    sql(["credit"], CARD, "SELECT l.id, CAST(sum(c.points) AS BIGINT) + (SELECT points FROM card WHERE col = 'basePoints') AS score "
        "FROM long l JOIN card c ON c.col = l.col AND c.value = l.value GROUP BY l.id"),
)
def _(t):
    return C.score_with_card(t("credit"), cut(_card(t)), "id", CATS)

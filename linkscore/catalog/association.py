"""Queries of the association family: edges, hops, detail and risk counters."""

from __future__ import annotations

from pyspark.sql import functions as F

from linkscore.catalog import registry
from linkscore.catalog.registry import Tables, query
from linkscore.operators import association as A
from linkscore.operators import features as X
from linkscore.operators.woe import woe_table
from linkscore.runtime import stored


def sql(names, steps, final: str) -> str:
    """Hops and their detail are worked out one after the other; merged, all applications would be joined with all."""
    return registry.sql(names, steps, final, once=("kept", "one", "two", "inc", "near", "detail"))


# The export window is the operator's own parameter: one weekly run.
WEEK = ("1998-06-01", "1998-06-08")
DEGREE = 40

HUBS = {
    "kept": f"""SELECT * FROM app_edges WHERE (entity_type, entity_value) NOT IN
      (SELECT entity_type, entity_value FROM app_edges GROUP BY 1, 2 HAVING count(*) >= {DEGREE})""",
}


EVERY = {"kept": "SELECT * FROM app_edges"}


def _one(start: str, end: str) -> str:
    return f"""SELECT DISTINCT a.app_time AS a_time, a.app_id AS a_order, a.entity_value AS value1,
      a.entity_type AS type1, b.app_time AS b_time, b.app_id AS b_order, CAST(a.app_time AS DATE) AS dt
      FROM kept a JOIN kept b USING (entity_type, entity_value)
      WHERE a.app_time BETWEEN TIMESTAMP '{start} 00:00:00' AND TIMESTAMP '{end} 00:00:00'
      AND a.app_time > b.app_time AND a.app_id <> b.app_id"""


TWO = """SELECT DISTINCT o.a_time, o.a_order, o.value1, o.type1, o.b_time, o.b_order,
  v.entity_value AS value2, v.entity_type AS type2, t.app_time AS c_time, t.app_id AS c_order, o.dt
  FROM one o JOIN kept v ON v.app_id = o.b_order
  JOIN kept t ON t.entity_type = v.entity_type AND t.entity_value = v.entity_value
  WHERE t.app_id <> o.a_order AND t.app_id <> o.b_order AND o.a_time > t.app_time"""

INC = f"""SELECT * FROM applications WHERE apply_time <= TIMESTAMP '{WEEK[1]} 00:00:00'
  AND order_id NOT IN (SELECT order_id FROM applications WHERE apply_time < TIMESTAMP '{WEEK[0]} 00:00:00')"""


def _perf(n: int) -> str:
    return ", ".join(f"p{n}.{c} AS {c}{n}" for c in A.PERFORMANCE)


def _nulls(n: int) -> str:
    return ", ".join(f"NULL AS {c}{n}" for c in A.PERFORMANCE)


NEAR = f"""SELECT i.order_id AS order_src, i.cert_no AS cert_no_src, i.apply_time AS apply_time_src,
  two.type1 AS edge1, value1, b_order, {_perf(1)}, two.type2 AS edge3, value2, c_order
  FROM two JOIN inc i ON i.order_id = a_order JOIN applications p1 ON p1.order_id = b_order"""

DETAIL = f"""SELECT 2 AS degree_type, order_src, cert_no_src, apply_time_src,
  edge1, value1, edge1 AS edge2, b_order AS order1, {', '.join(f'{c}1' for c in A.PERFORMANCE)},
  edge3, value2, edge3 AS edge4, c_order AS order2, {_perf(2)}
  FROM near JOIN applications p2 ON p2.order_id = c_order
  UNION ALL
  SELECT 1, i.order_id, i.cert_no, i.apply_time, type1, value1, type1, b_order, {_perf(1)},
  NULL, NULL, NULL, NULL, {_nulls(2)}
  FROM one JOIN inc i ON i.order_id = a_order JOIN applications p1 ON p1.order_id = b_order"""

STEPS = {**EVERY, "one": _one(*WEEK), "two": TWO, "inc": INC, "near": NEAR, "detail": DETAIL}
BASE = ["applications", "app_edges"]


def _increment(t: Tables):
    apps = t("applications")
    current = apps.where(F.col("apply_time") <= F.lit(WEEK[1]).cast("timestamp_ntz"))
    history = apps.where(F.col("apply_time") < F.lit(WEEK[0]).cast("timestamp_ntz"))
    return A.increment(current, history, "order_id")


def _hops(t: Tables, performance=None, inc=None):
    edges = stored(t("app_edges"), "edges")  # the given tables are read once for all hops
    one = stored(A.one_hop(edges, *WEEK), "one_hop")
    return one, A.two_hop(one, edges, performance=performance, inc=inc)


def _detail(t: Tables):
    inc = stored(_increment(t), "increment")
    one, two = _hops(t, t("applications"), inc)
    return A.association_detail(one, two, t("applications"), inc)


def _ids(t: Tables):
    return _increment(t).select(F.col("order_id").alias("order_src"))


# --- edges -------------------------------------------------------------
RAW_SPEC = {c: A.ENTITY_TYPES[c] for c in ("loan_pan", "recommend", "device_id", "cert_no", "email", "mobile", "emergency_mobile", "contact_mobile")}


@query(
    "g01_application_edges",
    sql(
        ["raw_apps"],
        {},
        " UNION ".join(
            f"SELECT {code} AS entity_type, {c} AS entity_value, order_id AS app_id, insert_time AS app_time "
            f"FROM raw_apps WHERE trim({c}) <> ''"
            for c, code in RAW_SPEC.items()
        ),
    ),
)
def _(t):
    return A.application_edges(t("raw_apps"), RAW_SPEC)


@query(
    "g02_phone_edges",
    sql(
        ["raw_apps"],
        {
            "p": " UNION ".join(
                f"SELECT CAST(order_id AS STRING) AS src, {c} AS dst FROM raw_apps WHERE order_id <> 0 AND {c} <> '0'"
                for c in ("mobile", "contact_mobile", "emergency_mobile", "recommend")
            )
        },
        "SELECT src, dst FROM p UNION SELECT dst AS src, src AS dst FROM p",
    ),
)
def _(t):
    return A.phone_edges(t("raw_apps"), ["mobile", "contact_mobile", "emergency_mobile", "recommend"])


@query(
    "g03_call_edges",
    "SELECT DISTINCT o_custkey AS src, l_suppkey AS dst FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
    "WHERE o_custkey <> 0 AND l_suppkey <> 0",
)
def _(t):
    lines = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return A.call_edges(lines, "o_custkey", "l_suppkey")


@query(
    "g04_degrees",
    sql(
        ["calls"],
        {"e": "SELECT src AS id, 0 AS i, 1 AS o FROM calls UNION ALL SELECT dst, 1, 0 FROM calls"},
        "SELECT id, CAST(sum(i) AS BIGINT) AS in_degree, CAST(sum(o) AS BIGINT) AS out_degree, "
        "CAST(sum(i) + sum(o) AS BIGINT) AS degree FROM e GROUP BY id",
    ),
)
def _(t):
    return A.degrees(t("calls"))


@query("g04_drop_hubs", sql(["app_edges"], HUBS, "SELECT * FROM kept"))
def _(t):
    return A.drop_hubs(t("app_edges"), DEGREE)


ALL_TIME = ("1995-01-01", "2001-08-01")


@query("g05_one_hop", sql(["app_edges"], {**EVERY, "one": _one(*ALL_TIME)}, "SELECT * FROM one"))
def _(t):
    return A.one_hop(stored(t("app_edges"), "edges"), *ALL_TIME)


@query("g06_two_hop", sql(["app_edges"], {**EVERY, "one": _one(*WEEK), "two": TWO}, "SELECT * FROM two"))
def _(t):
    return _hops(t)[1]


# --- joins -------------------------------------------------------------
@query(
    "j01_assemble_applications",
    """WITH a AS (SELECT o_orderkey AS order_id, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS day, o_totalprice AS amount FROM orders),
    d AS (SELECT l_orderkey AS order_id, min(l_partkey) AS device FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1),
    u AS (SELECT c_custkey AS user_id, c_name AS user_name FROM customer WHERE c_acctbal > 0)
    SELECT a.order_id, a.user_id, a.day, a.amount, d.device, u.user_name FROM a LEFT JOIN d USING (order_id) LEFT JOIN u USING (user_id)
    WHERE a.day = DATE '1998-06-03'""",
)
def _(t):
    apply = t("orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.to_date("o_orderdate").alias("day"),
        F.col("o_totalprice").alias("amount"),
    )
    device = t("lineitem").where("l_returnflag <> 'N'").groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.min("l_partkey").alias("device")
    )
    user = t("customer").where("c_acctbal > 0").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("user_name")
    )
    return A.assemble_applications(apply, device, user, "1998-06-03")


@query("j02_increment", sql(["applications"], {"inc": INC}, "SELECT * FROM inc"))
def _(t):
    return _increment(t)


@query("j04_association_detail", sql(BASE, STEPS, "SELECT * FROM detail"))
def _(t):
    return _detail(t)


# --- counters ----------------------------------------------------------
def _scope_sql(hop: int, scope: str) -> str:
    if hop == 2:
        return "degree_type = 2 AND apply_time_src > apply_time1 AND apply_time_src > apply_time2"
    op = "=" if scope == "self" else "<>"
    return f"degree_type = 1 AND apply_time_src > apply_time1 AND cert_no_src {op} cert_no1"


def _count_sql(hop: int, scope: str) -> str:
    n = hop
    return f"""SELECT order_src, count(DISTINCT order{n}) AS order_cnt, count(DISTINCT cert_no{n}) AS id_cnt,
    count(DISTINCT CASE WHEN label{n} = 1 THEN order{n} END) AS black_cnt,
    count(DISTINCT CASE WHEN performance{n} = 'q_refuse' THEN order{n} END) AS q_refuse_cnt,
    count(DISTINCT CASE WHEN type{n} = 'pass' THEN order{n} END) AS pass_cnt
    FROM detail WHERE {_scope_sql(hop, scope)} GROUP BY order_src"""


def _overdue_sql(hop: int, scope: str) -> str:
    n = hop
    parts = []
    for suffix, col in (("", "current_due_day"), ("_ls", "history_due_day")):
        for name, cond in (("overdue0", "<= 0"), ("overdue3", "> 3"), ("overdue30", "> 30")):
            parts.append(f"count(DISTINCT CASE WHEN {col}{n} {cond} THEN order{n} END) AS {name}{suffix}")
    return f"SELECT order_src, {', '.join(parts)} FROM detail WHERE {_scope_sql(hop, scope)} AND type{n} = 'pass' GROUP BY order_src"


for _name, _hop, _scope_name, _kind in (
    ("a01_count_self", 1, "self", "count"),
    ("a02_overdue_self", 1, "self", "overdue"),
    ("a03_count_other", 1, "other", "count"),
    ("a04_overdue_other", 1, "other", "overdue"),
    ("a05_count_two_hop", 2, "all", "count"),
    ("a06_overdue_two_hop", 2, "all", "overdue"),
):

    def _block(t, hop=_hop, scope=_scope_name, kind=_kind):
        fn = X.count_block if kind == "count" else X.overdue_block
        return fn(_detail(t), hop, scope)

    query(_name, sql(BASE, STEPS, (_count_sql if _kind == "count" else _overdue_sql)(_hop, _scope_name)))(_block)

BLOCKS_SQL = {
    "b1": _count_sql(1, "self"), "b2": _overdue_sql(1, "self"),
    "b3": _count_sql(1, "other"), "b4": _overdue_sql(1, "other"),
    "b5": _count_sql(2, "all"), "b6": _overdue_sql(2, "all"),
}


def _wide_sql() -> str:
    cols = []
    for i, (titles, suffix) in enumerate(
        [(t, s) for s in X.SCOPES.values() for t in (X.COUNT_TITLES, X.OVERDUE_TITLES)], 1
    ):
        cols += [f"coalesce(b{i}.{c}, 0) AS {c}{suffix}" for c in titles]
    joins = " ".join(f"LEFT JOIN b{i} ON b{i}.order_src = ids.order_src" for i in range(1, 7))
    return f"SELECT ids.order_src, {', '.join(cols)} FROM ids {joins}"


WIDE_STEPS = {**STEPS, **BLOCKS_SQL, "ids": "SELECT DISTINCT order_id AS order_src FROM inc", "wide": _wide_sql()}
SIG_STEPS = {
    "paths": """SELECT order_src, concat(edge1, '|', edge2) AS signature, 1 AS depth FROM detail
      WHERE degree_type = 1 AND apply_time_src > apply_time1 AND label1 = 1
      UNION ALL SELECT order_src, concat(edge1, '|', edge2, '|', edge3, '|', edge4), 2 FROM detail
      WHERE degree_type = 2 AND apply_time_src > apply_time1 AND apply_time_src > apply_time2 AND label2 = 1""",
    "sig": "SELECT order_src, array_to_string(list_sort(list(DISTINCT signature)), ',') AS signature FROM paths GROUP BY 1",
    "depths": "SELECT order_src, max(depth) AS depth FROM paths GROUP BY 1",
    "edges": "SELECT DISTINCT order_src, signature AS edge FROM paths",
    "marked": "SELECT e.edge, a.label AS y FROM edges e JOIN applications a ON a.order_id = e.order_src",
    "woe": """SELECT edge, ln(greatest(CAST(sum(y) AS DOUBLE) / (SELECT sum(y) FROM marked), 1e-7)
      / greatest(CAST(sum(1 - y) AS DOUBLE) / (SELECT sum(1 - y) FROM marked), 1e-7)) AS woe FROM marked GROUP BY edge""",
    "stats": """SELECT order_src, round(sum(woe), 6) + 0.0 AS edge_woe_sum, round(max(woe), 6) + 0.0 AS edge_woe_max,
      round(min(woe), 6) + 0.0 AS edge_woe_min FROM edges JOIN woe USING (edge) GROUP BY order_src""",
}


@query("j05_merge_features", sql(BASE, WIDE_STEPS, "SELECT * FROM wide"))
def _(t):
    detail = _detail(t)
    return X.merge_features(_ids(t), X.all_blocks(detail))


@query("a00_association_features", sql(BASE, WIDE_STEPS, "SELECT * FROM wide"))
def association_features(t):
    return X.association_features(_ids(t), _detail(t))


@query(
    "a07_pivot_titles",
    sql(BASE, {**STEPS, "b": _count_sql(1, "other")}, "SELECT * FROM b"),
)
def _(t):
    long = X.to_long(X.count_block(_detail(t), 1, "other"), X.COUNT_TITLES)
    return X.pivot_titles(long, X.COUNT_TITLES)


@query(
    "a08_drop_all_zero",
    sql(BASE, WIDE_STEPS, f"SELECT * FROM wide WHERE greatest({', '.join(X.ALL_COUNTERS)}) > 0"),
)
def _(t):
    return X.drop_all_zero(association_features(t), X.ALL_COUNTERS)


@query("a09_path_signatures", sql(BASE, {**STEPS, **SIG_STEPS}, "SELECT * FROM sig"))
def _(t):
    return X.path_signatures(_detail(t))


@query("a10_max_depth", sql(BASE, {**STEPS, **SIG_STEPS}, "SELECT * FROM depths"))
def _(t):
    return X.max_depth(X.black_paths(_detail(t)))


@query(
    "p16_edge_signature",
    sql(BASE, {**STEPS, **SIG_STEPS}, "SELECT order_src, signature, depth, count(*) AS n FROM paths GROUP BY ALL"),
)
def _(t):
    return X.black_paths(_detail(t)).groupBy("order_src", "signature", "depth").agg(F.count(F.lit(1)).alias("n"))


def _paths(detail):
    """Distinct paths to tagged applications: few rows, from which signatures, weights and depths are taken, so the hops are made once for them."""
    return stored(X.black_paths(detail).distinct(), "paths")


def _woe_stats(t, paths):
    edges = paths.select("order_src", F.col("signature").alias("edge")).distinct()
    marked = edges.join(t("applications").select(F.col("order_id").alias("order_src"), "label"), "order_src")
    woe = woe_table(marked, "edge", "label").select("edge", "woe")
    stats = X.edge_woe_stats(edges, woe)
    return stats.select("order_src", *[(F.round(c, 6) + 0.0).alias(c) for c in stats.columns[1:]])


@query("a11_edge_woe_stats", sql(BASE, {**STEPS, **SIG_STEPS}, "SELECT * FROM stats"))
def _(t):
    return _woe_stats(t, _paths(_detail(t)))


def _context(t, detail, sig):
    times = _increment(t).select(F.col("order_id").alias("order_src"), "apply_time")
    return X.attach_context(X.association_features(_ids(t), detail), sig, times)


CONTEXT = "SELECT w.*, s.signature, i.apply_time FROM wide w LEFT JOIN sig s USING (order_src) JOIN inc i ON i.order_id = w.order_src"


@query("j06_attach_context", sql(BASE, {**WIDE_STEPS, **SIG_STEPS}, CONTEXT))
def _(t):
    detail = _detail(t)
    return _context(t, detail, X.path_signatures(detail))


@query(
    "j07_final_features",
    sql(
        BASE,
        {**WIDE_STEPS, **SIG_STEPS, "ctx": CONTEXT},
        "SELECT ctx.*, edge_woe_sum, edge_woe_max, edge_woe_min, depth FROM ctx LEFT JOIN stats USING (order_src) LEFT JOIN depths USING (order_src)",
    ),
)
def final_features(t):
    detail = _detail(t)
    paths = _paths(detail)
    return X.final_features(_context(t, detail, X.signatures_of(paths)), _woe_stats(t, paths), X.max_depth(paths))


# --- graph assembly and tagged links -----------------------------------
@query(
    "j08_graph_from_rows",
    sql(
        ["raw_apps"],
        {
            "e": "SELECT DISTINCT CAST(order_id AS STRING) AS src, mobile AS dst, 'mobile' AS kind FROM raw_apps UNION "
            "SELECT DISTINCT CAST(order_id AS STRING), email, 'email' FROM raw_apps WHERE trim(email) <> ''",
            "v": "SELECT CAST(order_id AS STRING) AS id, 'order_id' AS kind, insert_time AS attr FROM raw_apps "
            "UNION ALL SELECT dst, kind, NULL FROM e",
        },
        "SELECT 'v' AS part, id AS a, min(kind) AS b, min(attr) AS c FROM v GROUP BY id UNION ALL SELECT 'e', src, dst, kind FROM e",
    ),
)
def _(t):
    v, e = A.graph_from_rows(t("raw_apps"), "order_id", ["mobile", "email"], "insert_time")
    return v.select(F.lit("v").alias("part"), F.col("id").alias("a"), F.col("kind").alias("b"), F.col("attr").alias("c")).unionAll(
        e.select(F.lit("e").alias("part"), "src", "dst", "kind")
    )


@query(
    "j09_union_sources",
    sql(
        ["calls"],
        {},
        "SELECT src, dst FROM calls UNION SELECT o_orderkey, o_custkey FROM orders UNION SELECT o_custkey, o_orderkey FROM orders",
    ),
)
def _(t):
    own = t("orders")
    return A.union_sources(
        t("calls").select("src", "dst"),
        own.select(F.col("o_orderkey").alias("src"), F.col("o_custkey").alias("dst")),
        own.select(F.col("o_custkey").alias("src"), F.col("o_orderkey").alias("dst")),
    )


# relations of an application: phones of several kinds and an e-mail address
RELS = {
    "rels": """SELECT order_id, 'applymymobile' AS rel, mobile AS content FROM raw_apps
      UNION SELECT order_id, 'emergencymobile', concat('13', substr(mobile, 3)) FROM raw_apps
      UNION SELECT order_id, 'email', email FROM raw_apps WHERE trim(email) <> ''
      UNION SELECT order_id, 'relativemobile', contact_mobile FROM raw_apps""",
    "nodes": "SELECT content, CASE WHEN content LIKE '%77' THEN 1 ELSE 0 END AS tagged FROM rels GROUP BY content",
}
TAG_TYPES = ["applymymobile", "emergencymobile", "email"]
TAG_LIST = "('applymymobile', 'emergencymobile', 'email')"


def _rels(t):
    raw = t("raw_apps")
    parts = F.array(
        F.struct(F.lit("applymymobile").alias("rel"), F.col("mobile").alias("content")),
        F.struct(F.lit("emergencymobile").alias("rel"), F.concat(F.lit("13"), F.expr("substr(mobile, 3)")).alias("content")),
        F.struct(F.lit("email").alias("rel"), F.col("email").alias("content")),
        F.struct(F.lit("relativemobile").alias("rel"), F.col("contact_mobile").alias("content")),
    )
    rels = raw.select("order_id", F.explode(parts).alias("p")).select("order_id", "p.rel", "p.content").where("trim(content) <> ''").distinct()
    rels = stored(rels, "rels")  # read for the nodes and for every leg
    nodes = rels.groupBy("content").agg(F.max(F.col("content").like("%77").cast("int")).alias("tagged"))
    return nodes, rels


@query(
    "j10_tagged_links",
    sql(
        ["raw_apps"],
        RELS,
        f"SELECT DISTINCT 0 AS degree_type, r.content AS tagging_edge, rel AS edge0, order_id AS apply0 FROM rels r "
        f"JOIN nodes n ON n.content = r.content WHERE tagged = 1 AND rel IN {TAG_LIST}",
    ),
)
def _(t):
    nodes, rels = _rels(t)
    return A.tagged_links(nodes, rels, TAG_TYPES)


@query(
    "j11_tagged_one_hop",
    sql(
        ["raw_apps"],
        {
            **RELS,
            "legs": f"SELECT *, CASE WHEN rel IN ('applymymobile','emergencymobile') THEN 'phone' ELSE rel END AS fam FROM rels WHERE rel IN {TAG_LIST}",
        },
        """SELECT DISTINCT 1 AS degree_type, a.content AS tagging_edge, a.rel AS edge0, a.order_id AS apply0,
        b.rel AS edge1, b.content AS entity1, c.rel AS edge2, c.order_id AS apply1
        FROM legs a JOIN nodes n ON n.content = a.content AND n.tagged = 1
        JOIN legs b ON b.order_id = a.order_id AND NOT (b.rel = a.rel AND b.content = a.content)
        JOIN legs c ON c.content = b.content AND c.fam = b.fam
        WHERE NOT (c.order_id = b.order_id AND c.rel = b.rel)
        AND NOT (c.order_id = a.order_id AND c.rel = a.rel AND c.content = a.content)""",
    ),
)
def _(t):
    nodes, rels = _rels(t)
    return A.tagged_one_hop(nodes, rels, TAG_TYPES)

"""Queries of the graph family; loops are checked by SQL with one step per round."""

from __future__ import annotations

from pyspark.sql import functions as F

from linkscore.catalog.aggregates import rounded
from linkscore.catalog.association import WEEK
from linkscore.catalog.registry import query, sql
from linkscore.operators import association as A
from linkscore.operators import graph as G
from linkscore.operators import knn as K
from linkscore.operators import louvain as L
from linkscore.runtime import cut, scratch_path

# --- walks ---------------------------------------------------------------
def _named(edges):
    return edges.select(F.concat_ws(":", "entity_type", "entity_value").alias("entity"), F.col("app_id").alias("app"), "app_time", "entity_type")


@query(
    "g07_paths",
    sql(
        ["app_edges"],
        {
            "e": "SELECT concat(CAST(entity_type AS STRING), ':', entity_value) AS entity, app_id AS app, entity_type, app_time FROM app_edges",
            "p1": "SELECT entity, app FROM e WHERE entity_type IN (9, 10) AND app_time BETWEEN TIMESTAMP '{0}' AND TIMESTAMP '{1}'".format(*WEEK),
            "p2": "SELECT p1.entity AS seed, p1.app, e.entity FROM p1 JOIN e ON e.app = p1.app WHERE e.entity <> p1.entity",
        },
        "SELECT seed, concat(seed, '>', CAST(p2.app AS STRING), '>', p2.entity, '>', CAST(e.app AS STRING)) AS path, CAST(2 AS BIGINT) AS apps "
        "FROM p2 JOIN e ON e.entity = p2.entity WHERE e.app <> p2.app",
        once=("e", "p1", "p2"),
        recursive=False,
    ),
)
def _(t):
    kept = cut(_named(t("app_edges")))
    starts = kept.where(A.in_window(F.col("app_time"), *WEEK) & F.col("entity_type").isin(9, 10))
    out = G.paths(kept, starts, 3)
    return out.select("seed", F.array_join("path", ">").alias("path"), F.size("apps").cast("long").alias("apps"))


# customers at the two ends of the nation list are the seeds of the walks
SEEDS = "SELECT c_custkey * 4 AS id FROM customer WHERE c_nationkey = 7 AND c_mktsegment = 'BUILDING'"


def _seeds(t):
    return t("customer").where("c_nationkey = 7 AND c_mktsegment = 'BUILDING'").select((F.col("c_custkey") * 4).alias("id"))


def bfs_sql(hops: int, und: str = "u") -> dict:
    """min hop per (seed, id), one step per hop"""
    steps = {"h0": "SELECT id AS seed, id, 0 AS hop FROM seeds"}
    for h in range(1, hops + 1):
        steps[f"h{h}"] = (
            f"SELECT seed, id, min(hop) AS hop FROM (SELECT * FROM h{h - 1} UNION ALL SELECT seed, dst, {h} FROM h{h - 1} "
            f"JOIN {und} ON src = id WHERE hop = {h - 1}) GROUP BY seed, id"
        )
    return steps


UND = {"u": "SELECT src, dst FROM entity_edges UNION SELECT dst, src FROM entity_edges"}


@query("g08_neighbourhood", sql(["entity_edges"], {**UND, "seeds": SEEDS, **bfs_sql(2)}, "SELECT seed, hop, id FROM h2"))
def _(t):
    return G.neighbourhood(t("entity_edges"), _seeds(t), 2)


LOW = {
    "deg": "SELECT src FROM u GROUP BY src HAVING count(*) > 300",
    "lowu": "SELECT src, dst FROM u WHERE src NOT IN (SELECT src FROM deg) AND dst NOT IN (SELECT src FROM deg)",
}


@query("g08_neighbourhood_without_hubs", sql(["entity_edges"], {**UND, **LOW, "seeds": SEEDS, **bfs_sql(3, "lowu")}, "SELECT seed, hop, id FROM h3"))
def _(t):
    return G.neighbourhood(t("entity_edges"), _seeds(t), 3, max_degree=300)


ATTRS = "SELECT c_custkey * 4 AS id, c_nationkey AS attr FROM customer UNION ALL SELECT p_partkey * 4 + 1, p_size % 25 FROM part UNION ALL SELECT s_suppkey * 4 + 2, s_nationkey FROM supplier"


def _attrs(t):
    return (
        t("customer").select((F.col("c_custkey") * 4).alias("id"), F.col("c_nationkey").alias("attr"))
        .unionAll(t("part").select(F.col("p_partkey") * 4 + 1, F.col("p_size") % 25))
        .unionAll(t("supplier").select(F.col("s_suppkey") * 4 + 2, "s_nationkey"))
    )


@query(
    "g09_neighbour_attrs",
    sql(["entity_edges"], {**UND, "seeds": SEEDS, **bfs_sql(2), "attrs": ATTRS}, "SELECT DISTINCT seed, hop, attr FROM h2 JOIN attrs USING (id)"),
)
def _(t):
    return G.neighbour_attrs(G.neighbourhood(t("entity_edges"), _seeds(t), 2), _attrs(t))


@query(
    "g10_filtered_neighbourhood",
    sql(
        ["entity_edges"],
        {**UND, "seeds": SEEDS, "attrs": ATTRS,
         "fu": "SELECT src, dst FROM u JOIN attrs a ON a.id = src JOIN attrs b ON b.id = dst WHERE abs(a.attr - b.attr) <= 2", **bfs_sql(3, "fu")},
        "SELECT seed, hop, id FROM h3",
    ),
)
def _(t):
    near = lambda a, b: F.abs(a - b) <= 2
    return G.neighbourhood(t("entity_edges"), _seeds(t), 3, attrs=_attrs(t), edge_filter=near)


@query(
    "g11_reach_exactly",
    sql(
        ["entity_edges"],
        {"d": "SELECT a.src AS seed, b.dst AS id, min(a.dst) AS mid FROM entity_edges a JOIN entity_edges b ON b.src = a.dst GROUP BY 1, 2"},
        "SELECT seed, id, concat(seed, '>', mid, '>', id) AS path FROM d WHERE seed <> id AND NOT EXISTS (SELECT 1 FROM entity_edges e WHERE e.src = seed AND e.dst = id)",
    ),
)
def _(t):
    out = G.reach_exactly(t("entity_edges"), 2)
    return out.select("seed", "id", F.array_join(F.transform("path", lambda x: x.cast("string")), ">").alias("path"))


def max_sql(rounds: int) -> dict:
    steps = {"v0": "SELECT c_custkey * 4 AS id, c_acctbal AS value FROM customer UNION ALL SELECT p_partkey * 4 + 1, p_retailprice FROM part UNION ALL SELECT s_suppkey * 4 + 2, s_acctbal FROM supplier"}
    for r in range(1, rounds + 1):
        steps[f"v{r}"] = (
            f"SELECT v.id, greatest(v.value, coalesce(m.value, v.value)) AS value FROM v{r - 1} v LEFT JOIN "
            f"(SELECT dst AS id, max(value) AS value FROM v{r - 1} JOIN u ON src = id GROUP BY dst) m USING (id)"
        )
    return steps


@query("g12_iterate", sql(["entity_edges"], {**UND, **max_sql(1)}, "SELECT id, value FROM v1"))
def _(t):
    values = (
        t("customer").select((F.col("c_custkey") * 4).alias("id"), F.col("c_acctbal").alias("value"))
        .unionAll(t("part").select(F.col("p_partkey") * 4 + 1, "p_retailprice"))
        .unionAll(t("supplier").select(F.col("s_suppkey") * 4 + 2, "s_acctbal"))
    )
    return G.iterate(values, t("entity_edges"), lambda v: v, F.max, F.greatest, 1, "both")


# --- ranking -------------------------------------------------------------
def pagerank_sql(rounds: int, edges: str = "links") -> dict:
    steps = {
        "o": f"SELECT src AS id, count(*) AS n FROM {edges} GROUP BY src",
        "r0": f"SELECT id, 1.0::DOUBLE AS rank FROM (SELECT src AS id FROM {edges} UNION SELECT dst FROM {edges})",
    }
    for r in range(1, rounds + 1):
        steps[f"r{r}"] = (
            f"SELECT v.id, 0.15 + 0.85 * coalesce(s, 0) AS rank FROM r{r - 1} v LEFT JOIN (SELECT dst AS id, sum(rank / n) AS s "
            f"FROM {edges} JOIN r{r - 1} a ON a.id = src JOIN o ON o.id = src GROUP BY dst) m USING (id)"
        )
    return steps


@query("g13_pagerank", sql(["links"], pagerank_sql(10), "SELECT id, round(rank, 5) AS rank FROM r10"))
def _(t):
    return rounded(G.pagerank(t("links"), rounds=10), 5, "rank")


SETTLED = {
    "o": "SELECT src AS id, count(*) AS n FROM links GROUP BY src",
    "r": """SELECT 0 AS round, id, 1.0::DOUBLE AS rank, 1.0::DOUBLE AS moved FROM (SELECT src AS id FROM links UNION SELECT dst FROM links)
      UNION ALL SELECT round, id, rank, max(abs(rank - old)) OVER () FROM (
        SELECT v.round + 1 AS round, v.id, v.rank AS old, 0.15 + 0.85 * coalesce(m.s, 0) AS rank FROM r v LEFT JOIN
          (SELECT dst AS id, sum(rank / n) AS s FROM links JOIN r a ON a.id = src JOIN o ON o.id = src GROUP BY dst) m ON m.id = v.id
        WHERE v.moved > 0.001)""",
}


@query("g14_pagerank_tolerance", sql(["links"], SETTLED, "SELECT id, round(rank, 5) AS rank FROM r WHERE round = (SELECT max(round) FROM r)", once=("links", "o")))
def _(t):
    return rounded(G.pagerank(t("links"), tol=1e-3), 5, "rank")


def hits_sql(rounds: int) -> dict:
    steps = {"h0": "SELECT id, 1.0::DOUBLE AS v FROM (SELECT src AS id FROM links UNION SELECT dst FROM links)"}
    for r in range(1, rounds + 1):
        for new, old, a, b in ((f"a{r}", f"h{r - 1}", "src", "dst"), (f"h{r}", f"a{r}", "dst", "src")):
            steps[f"{new}x"] = f"SELECT h0.id, coalesce(s, 0) AS v FROM h0 LEFT JOIN (SELECT {b} AS id, sum(v) AS s FROM links JOIN {old} x ON x.id = {a} GROUP BY {b}) m USING (id)"
            steps[new] = f"SELECT id, v / (SELECT sum(v) FROM {new}x) AS v FROM {new}x"
    return steps


@query("g26_hits", sql(["links"], hits_sql(4), "SELECT h.id, round(h.v, 8) AS hub, round(a.v, 8) AS authority FROM h4 h JOIN a4 a USING (id)"))
def _(t):
    return rounded(G.hits(t("links"), 4), 8, "hub", "authority")


LANDMARKS = "SELECT s_suppkey * 4 + 2 AS id FROM supplier WHERE s_nationkey = 3"


@query("g26_landmark_distances", sql(["entity_edges"], {**UND, "seeds": LANDMARKS, **bfs_sql(4)}, "SELECT id, seed AS landmark, hop AS distance FROM h4"))
def _(t):
    return G.landmark_distances(t("entity_edges"), t("supplier").where("s_nationkey = 3").select((F.col("s_suppkey") * 4 + 2).alias("id")))


@query(
    "g26_closeness",
    sql(["entity_edges"], {**UND, "seeds": LANDMARKS, **bfs_sql(4)},
        "SELECT id, round(CASE WHEN avg(hop) > 0 THEN 1.0 / avg(hop) ELSE 0 END, 8) AS closeness FROM h4 GROUP BY id"),
)
def _(t):
    marks = t("supplier").where("s_nationkey = 3").select((F.col("s_suppkey") * 4 + 2).alias("id"))
    return rounded(G.closeness(G.landmark_distances(t("entity_edges"), marks)), 8, "closeness")


# --- similarity and communities -----------------------------------------
COMMON = {
    **UND,
    "dg": "SELECT src AS id, count(*) AS deg FROM u GROUP BY src",
    "cm": "SELECT e.src, e.dst, count(b.dst) AS common FROM entity_edges e JOIN u a ON a.src = e.src LEFT JOIN u b ON b.src = e.dst AND b.dst = a.dst GROUP BY e.src, e.dst",
    "sim": "SELECT least(c.src, c.dst) AS src, greatest(c.src, c.dst) AS dst, common, x.deg AS dx, y.deg AS dy FROM cm c JOIN dg x ON x.id = c.src JOIN dg y ON y.id = c.dst",
}


@query("g26_jaccard", sql(["entity_edges"], COMMON, "SELECT src, dst, round(common / (dx + dy - common), 8) AS similarity FROM sim"))
def _(t):
    return rounded(G.jaccard(t("entity_edges")), 8, "similarity")


@query("g17_structural_similarity", sql(["entity_edges"], COMMON, "SELECT src, dst, round((common + 2) / sqrt((dx + 1) * (dy + 1)), 8) AS similarity FROM sim"))
def _(t):
    return rounded(G.structural_similarity(t("entity_edges")), 8, "similarity")


EPS = 0.22


def components_sql(edges: str, ids: str, rounds: int) -> dict:
    steps = {"bw": f"SELECT src, dst FROM {edges} UNION SELECT dst, src FROM {edges}", "c0": f"SELECT DISTINCT id, id AS c FROM {ids}"}
    for r in range(1, rounds + 1):
        steps[f"m{r}"] = f"SELECT v.id, least(v.c, coalesce(m.c, v.c)) AS c FROM c{r - 1} v LEFT JOIN (SELECT dst AS id, min(c) AS c FROM c{r - 1} JOIN bw ON src = id GROUP BY dst) m USING (id)"
        steps[f"c{r}"] = f"SELECT a.id, b.c FROM m{r} a JOIN m{r} b ON b.id = a.c"
    return steps


@query(
    "g17_pscan",
    sql(["entity_edges"], {**COMMON, "strong": f"SELECT src, dst FROM sim WHERE (common + 2) / sqrt((dx + 1) * (dy + 1)) > {EPS}", **components_sql("strong", "dg", 12)},
        "SELECT id, c AS component FROM c12"),
)
def _(t):
    return G.pscan(t("entity_edges"), EPS)


def lpa_sql(rounds: int) -> dict:
    steps = {**{"u": "SELECT src, dst FROM calls UNION SELECT dst, src FROM calls"}, "l0": "SELECT DISTINCT src AS id, src AS label FROM u"}
    for r in range(1, rounds + 1):
        steps[f"l{r}"] = (
            f"SELECT id, label FROM (SELECT dst AS id, label, row_number() OVER (PARTITION BY dst ORDER BY count(*) DESC, label) AS rk "
            f"FROM l{r - 1} JOIN u ON src = id GROUP BY dst, label) WHERE rk = 1"
        )
    return steps


@query("g15_label_propagation", sql(["calls"], lpa_sql(5), "SELECT id, label FROM l5"))
def _(t):
    return G.label_propagation(t("calls"), 5)


@query(
    "g16_coarse_labels",
    sql(["entity_edges"], {**UND, **{f"c{r}": (
        "SELECT DISTINCT src AS id, src AS label FROM u" if r == 0 else
        f"SELECT id, min(label) AS label FROM (SELECT id, label FROM c{r - 1} UNION ALL SELECT dst, label FROM c{r - 1} JOIN u ON src = id) GROUP BY id") for r in range(2)}},
        "SELECT id, label FROM c1 WHERE id <> label"),
)
def _(t):
    return G.coarse_labels(t("entity_edges"), 1)


@query(
    "g18_modularity",
    sql(
        ["calls"],
        {
            "lb": "SELECT c_custkey AS id, c_nationkey AS label FROM customer UNION ALL SELECT -1 - s_suppkey, s_nationkey FROM supplier",
            "m": "SELECT a.label AS la, b.label AS lb, weight AS w FROM calls JOIN lb a ON a.id = src JOIN lb b ON b.id = dst",
            "d": "SELECT c, sum(w) AS deg FROM (SELECT la AS c, w FROM m UNION ALL SELECT lb, w FROM m) GROUP BY c",
        },
        "SELECT round((SELECT sum(w) FROM m WHERE la = lb) / (SELECT sum(w) FROM m) - (SELECT sum(deg * deg) FROM d) / (4.0 * (SELECT sum(w) FROM m) * (SELECT sum(w) FROM m)), 8) AS q",
    ),
)
def _(t):
    labels = t("customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("label")).unionAll(
        t("supplier").select(-1 - F.col("s_suppkey"), "s_nationkey")
    )
    return rounded(G.modularity(t("calls"), labels, "weight"), 8, "q")


def call_graph(t):
    return t("calls").select("src", "dst", F.col("weight").cast("double").alias("weight"))


def level_sql(k: int) -> dict:
    """A level on vertices ``v<k>`` and edges ``e<k>`` (both ways): half passes, downward and upward in turn, with the moves and idle passes so far.

    ``z<k>`` is the state after it, ``go<k>`` its quality and whether another level follows.
    """
    gained = f"k_in + CASE WHEN a.near = x.c THEN x.internal ELSE 0 END - (x.node + x.internal) * (sigma - CASE WHEN a.near = x.c THEN x.node + x.internal ELSE 0 END) / total"
    around = "SELECT dst AS id, y.c AS near, sum(w) AS k_in FROM e{0} JOIN {1} y ON y.id = e{0}.src GROUP BY dst, y.c"
    sums = "SELECT c, sum(node + internal) AS sigma FROM {0} GROUP BY c"
    own = "a.internal + sum(CASE WHEN x.near = a.c THEN k_in ELSE 0 END)"
    before = f"(SELECT q FROM go{k - 1})" if k else "-1"
    return {
        f"total{k}": f"SELECT sum(node + internal) AS total FROM v{k}",
        f"s{k}": f"""SELECT 0 AS half, id, id AS c, node, internal, 0::BIGINT AS went, 0::BIGINT AS last, 0 AS idle, false AS done FROM v{k}
      UNION ALL SELECT half, id, c, node, internal, went,
        CASE WHEN half % 2 = 0 THEN before + went ELSE last END,
        CASE WHEN half % 2 = 0 AND last - before - went <= 1 THEN idle + 1 ELSE idle END,
        half % 2 = 0 AND (before + went = 0 OR idle + CAST(last - before - went <= 1 AS INT) > 1)
      FROM (SELECT half, id, CASE WHEN goes THEN near ELSE c END AS c, node, internal, before, last, idle, CAST(sum(CAST(goes AS INT)) OVER () AS BIGINT) AS went
        FROM (SELECT v.half + 1 AS half, v.id, v.c, v.node, v.internal, v.went AS before, v.last, v.idle, b.near,
            coalesce(CASE WHEN v.half % 2 = 0 THEN b.near < v.c ELSE b.near > v.c END, false) AS goes
          FROM s{k} v LEFT JOIN (
            SELECT id, max({{'gain': gain, 'near': near}}).near AS near FROM (
              SELECT a.id, a.near, {gained} AS gain FROM ({around.format(k, f"s{k}")}) a
              JOIN s{k} x ON x.id = a.id JOIN ({sums.format(f"s{k}")}) z ON z.c = a.near, total{k})
            WHERE gain > 0 GROUP BY id) b ON b.id = v.id
          WHERE NOT v.done))""",
        f"z{k}": f"SELECT * FROM s{k} WHERE half = (SELECT max(half) FROM s{k})",
        f"q{k}": f"""SELECT {own} AS k_in, max(sigma) AS sigma, max(a.node + a.internal) AS k_i FROM z{k} a JOIN ({around.format(k, f"z{k}")}) x ON x.id = a.id
          JOIN ({sums.format(f"z{k}")}) y ON y.c = a.c GROUP BY a.id, a.internal""",
        f"go{k}": f"""SELECT coalesce(sum(greatest(k_in / total - sigma * k_i / total / total, 0)), 0) AS q,
          (SELECT max(half) FROM z{k}) > 4 AND coalesce(sum(greatest(k_in / total - sigma * k_i / total / total, 0)), 0) > {before} + 0.001 AS further FROM q{k}, total{k}""",
        f"b{k}": f"""SELECT least(x.c, y.c) AS src, greatest(x.c, y.c) AS dst, sum(w) AS w FROM e{k} JOIN z{k} x ON x.id = src JOIN z{k} y ON y.id = dst
          WHERE (SELECT further FROM go{k}) GROUP BY 1, 2""",
        f"e{k + 1}": f"SELECT src, dst, w / 2 AS w FROM b{k} WHERE src <> dst UNION ALL SELECT dst, src, w / 2 FROM b{k} WHERE src <> dst",
        f"v{k + 1}": f"""SELECT a.c AS id, a.internal + coalesce(w, 0) AS internal, coalesce(node, 0) AS node FROM (SELECT c, sum(internal) AS internal FROM z{k} GROUP BY c) a
          LEFT JOIN b{k} b ON b.src = a.c AND b.dst = a.c LEFT JOIN (SELECT src, sum(w) AS node FROM e{k + 1} GROUP BY src) d ON d.src = a.c
          WHERE EXISTS (FROM e{k + 1})""",
    }


def louvain_sql(levels: int) -> dict:
    """Levels one after the other, each empty where the one before was the last; ``m`` has the communities of the input's vertices."""
    steps = {
        "e0": "SELECT src, dst, CAST(weight AS DOUBLE) AS w FROM calls UNION ALL SELECT dst, src, weight FROM calls",
        "v0": "SELECT src AS id, 0.0::DOUBLE AS internal, sum(w) AS node FROM e0 GROUP BY src",
    }
    member = "SELECT id, c FROM z0"
    for k in range(levels):
        steps |= level_sql(k)
        if k:
            member = f"SELECT m.id, coalesce(z{k}.c, m.c) AS c FROM ({member}) m LEFT JOIN z{k} ON z{k}.id = m.c"
    return {**steps, "m": member}


LEVELS = louvain_sql(6)
LEVELS_ONCE = ["calls", *[n for n in LEVELS if n != "m" and n[0] != "s"]]


@query("g19_louvain_level", sql(["calls"], louvain_sql(1), "SELECT id, c AS community FROM z0", once=LEVELS_ONCE))
def _(t):
    edges = cut(call_graph(t))
    _q, state, _passes = L.louvain_level(L.initial_state(edges), edges)
    return state.select("id", "community")


@query("g20_louvain", sql(["calls"], LEVELS, "SELECT id, c AS community FROM m", once=LEVELS_ONCE))
def _(t):
    return L.louvain(call_graph(t))[0]


@query(
    "g20_louvain_quality",
    sql(
        ["calls"],
        {"ids": "SELECT src AS id FROM calls UNION SELECT dst FROM calls"},
        "SELECT count(*) AS vertices, (SELECT CAST(sum(weight) AS DOUBLE) FROM calls) AS weight, true AS each_once, true AS never_falls, true AS is_modularity, true AS better_than_alone FROM ids",
    ),
)
def _(t):
    """What holds of every run: each vertex in one community, q never falling, and the last q that of the written assignment."""
    edges = call_graph(t)
    member, qualities = L.louvain(edges)
    member = cut(member)
    labels = member.select("id", F.col("community").alias("label"))
    q = G.modularity(edges, labels, "weight").first()[0]
    alone = G.modularity(edges, member.select("id", F.col("id").alias("label")), "weight").first()[0]
    rises = all(b >= a - 1e-12 for a, b in zip(qualities, qualities[1:]))
    counts = member.agg(F.count(F.lit(1)).alias("vertices"), (F.countDistinct("id") == F.count(F.lit(1))).alias("each_once"))
    weight = edges.agg(F.sum("weight").alias("weight")).first()[0]
    return counts.select(
        "vertices", F.lit(weight).alias("weight"), "each_once", F.lit(rises).alias("never_falls"),
        F.lit(abs(q - qualities[-1]) < 1e-9).alias("is_modularity"), F.lit(q > alone).alias("better_than_alone"),
    )


@query(
    "g21_louvain_levels",
    sql(
        ["calls"],
        LEVELS,
        " UNION ALL ".join(
            f"SELECT CAST({k} AS INT) AS level, count(*) AS vertices, count(DISTINCT c) AS communities, (SELECT sum(w) / 2 FROM e{k}) AS weight, (SELECT round(q, 8) FROM go{k}) AS q FROM z{k} HAVING count(*) > 0"
            for k in range(6)
        ),
        once=LEVELS_ONCE,
    ),
)
def _(t):
    """What a run keeps of each level: vertices, edges between them and quality."""
    folder = scratch_path(t.spark, "louvain")
    _, qualities = L.louvain(call_graph(t), out_dir=folder)
    quality = t.spark.read.schema("q double, level int").parquet(f"{folder}/quality").select("level", "q")
    sizes = None
    for level in range(len(qualities)):
        read = t.spark.read.parquet(f"{folder}/level_{level}/vertices")
        links = t.spark.read.parquet(f"{folder}/level_{level}/edges")
        one = read.agg(F.count(F.lit(1)).alias("vertices"), F.countDistinct("community").alias("communities")).select(
            F.lit(level).alias("level"), "vertices", "communities"
        ).join(links.agg(F.sum("weight").alias("weight")).withColumn("level", F.lit(level)), "level")
        sizes = one if sizes is None else sizes.unionByName(one)
    return rounded(sizes.join(quality, "level"), 8, "q")


@query("g22_power_clusters")
def _(t):
    return G.power_clusters(t("calls"), 4, 10)


# --- neighbours of points ------------------------------------------------
def points(t):
    e = F.col("embedding")
    return t("embeddings").select(
        F.col("vec_id").alias("id"), F.array(e[0].cast("double"), e[1].cast("double")).alias("vec"), "label"
    )


def vectors(t):
    """Embeddings in all their dimensions."""
    return t("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"), "label")


def knn_sql(k: int, cells: int = 3) -> dict:
    grids = " UNION ALL ".join(
        f"SELECT id, x, y, {i} AS grid, CAST(floor((x - x0) / (x1 - x0) * {cells - 1} + {o}) * {cells} + floor((y - y0) / (y1 - y0) * {cells - 1} + {o}) AS BIGINT) AS cell FROM pt, ext"
        for i, o in enumerate((0.0, 0.5))
    )
    return {
        "pt": "SELECT vec_id AS id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, label FROM embeddings",
        "ext": "SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM pt",
        "gr": grids,
        "pr": "SELECT a.id AS src, b.id AS dst, a.grid, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) AS d FROM gr a JOIN gr b ON a.grid = b.grid AND a.cell = b.cell AND a.id <> b.id",
        "nn": f"SELECT DISTINCT src, dst, 1 / (1 + d) AS w FROM (SELECT *, row_number() OVER (PARTITION BY grid, src ORDER BY d, dst) AS r FROM pr) WHERE r <= {k}",
        "kg": f"SELECT src, dst, w AS weight FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY w DESC, dst) AS r FROM nn) WHERE r <= {k}",
    }


@query("g23_knn_graph", sql([], knn_sql(5), "SELECT src, dst, round(weight, 9) AS weight FROM kg"))
def _(t):
    return rounded(K.knn_graph(points(t).drop("label"), 5), 9, "weight")


KNOWN = "CASE WHEN id % 10 = 0 THEN label END"


def ssl_sql(rounds: int) -> dict:
    steps = {
        **knn_sql(5),
        "wu": "SELECT src, dst, sum(weight) AS weight FROM (SELECT src, dst, weight FROM kg UNION ALL SELECT dst, src, weight FROM kg) GROUP BY src, dst",
        "s0": f"SELECT id, {KNOWN} AS label FROM pt",
    }
    for r in range(1, rounds + 1):
        steps[f"w{r}"] = (
            f"SELECT id, label FROM (SELECT dst AS id, label, row_number() OVER (PARTITION BY dst ORDER BY round(sum(weight), 9) DESC, label) AS rk "
            f"FROM s{r - 1} JOIN wu ON src = id WHERE label IS NOT NULL GROUP BY dst, label) WHERE rk = 1"
        )
        steps[f"s{r}"] = f"SELECT s.id, coalesce(s.label, w.label) AS label FROM s{r - 1} s LEFT JOIN w{r} w USING (id)"
    return steps


def _half_labelled(t):
    return points(t).withColumn("label", F.when(F.col("id") % 10 == 0, F.col("label")))


@query("g24_ssl_propagate", sql([], ssl_sql(6), "SELECT id, label FROM s6"))
def _(t):
    pts = _half_labelled(t)
    return G.ssl_propagate(pts.select("id", "label"), cut(K.knn_graph(pts.drop("label"), 5)), 6)


@query(
    "g25_nearest_label",
    """WITH kn AS (SELECT vec_id AS id, embedding::DOUBLE[64] AS v, label FROM embeddings WHERE vec_id % 10 = 0 AND label IS NOT NULL)
    SELECT id, label FROM (SELECT q.vec_id AS id, p.label, row_number() OVER (PARTITION BY q.vec_id
      ORDER BY array_distance(q.embedding::DOUBLE[64], p.v), p.id) AS r FROM embeddings q JOIN kn p ON TRUE) WHERE r = 1""",
)
def _(t):
    vecs = vectors(t)
    return K.nearest_label(vecs.withColumn("label", F.when(F.col("id") % 10 == 0, F.col("label"))), vecs.select("id", "vec"))


@query(
    "t01_knn_classify",
    """WITH d AS (SELECT a.vec_id AS id, b.vec_id AS other, b.label, array_distance(a.embedding::DOUBLE[64], b.embedding::DOUBLE[64]) AS d
      FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
    n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, other) AS r FROM d) WHERE r <= 5),
    v AS (SELECT id, label, row_number() OVER (PARTITION BY id ORDER BY count(*) DESC, label) AS r FROM n GROUP BY id, label)
    SELECT id, label FROM v WHERE r = 1""",
)
def _(t):
    vecs = vectors(t)
    return K.knn_classify(vecs, vecs.select("id", "vec"), 5, exclude_self=True)

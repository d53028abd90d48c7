"""What travels between tasks is counted, and the rows are compared with plain Python."""

import itertools
import re

import pytest
from pyspark.sql import functions as F

from linkscore.operators import graph as G


def complete(spark, n):
    return spark.createDataFrame(list(itertools.combinations(range(n), 2)), "src long, dst long")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def sent(monkeypatch):
    """Rows of every message table."""
    counts = []
    plain = G.BlockedEdges.send

    def counting(self, state):
        out = plain(self, state)
        counts.append(out.count())
        return out

    monkeypatch.setattr(G.BlockedEdges, "send", counting)
    return counts


def test_pairs_of_neighbours_are_never_rows(spark):
    """lists of neighbours meet, pairs of them are not looked up one by one."""
    got = G.common_neighbours(complete(spark, 12).union(spark.createDataFrame([(0, 50), (50, 51)], "src long, dst long")))
    plan = plan_of(got)
    assert "array_intersect" in plan and not re.search(r"hashpartitioning\(a#\d+L?, b#", plan)
    want = {(a, b): 10 for a, b in itertools.combinations(range(12), 2)} | {(0, 50): 0, (50, 51): 0}
    assert {(r["src"], r["dst"]): r["common"] for r in got.collect()} == want


def test_lists_travel_to_the_seeds(spark, sent, monkeypatch):
    """two steps on 3 x 20 x 40 edges are 2,400 paths, but 60 lists; split seeds give the same rows."""
    edges = [(a, 100 + b) for a in range(3) for b in range(20)] + [(100 + b, 1000 + c) for b in range(20) for c in range(40)]
    df = spark.createDataFrame(edges, "src long, dst long")
    want = sorted((a, 1000 + c, [a, 100, 1000 + c]) for a in range(3) for c in range(40))
    seeds = spark.createDataFrame([(a,) for a in range(3)], "id long")
    assert sorted(map(tuple, G.reach_exactly(df, 2, seeds).collect())) == want
    assert max(sent) <= 60
    monkeypatch.setattr(G, "ROWS_PER_TASK", 70)
    monkeypatch.setattr(G, "LIST_ROWS", 7)
    assert sorted(map(tuple, G.reach_exactly(df, 2, seeds).collect())) == want
    ring = spark.createDataFrame([(i, (i + s) % 9) for i in range(9) for s in (1, 2)], "src long, dst long")
    got = {(r["seed"], r["id"]): r["path"] for r in G.reach_exactly(ring, 3).collect()}
    assert len(got) == 18 and got[0, 6] == [0, 2, 4, 6] and got[0, 5] == [0, 1, 3, 5]


def test_seeds_travel_together(spark, sent, monkeypatch):
    """70 seeds go along an edge as two numbers, not as 70 rows."""
    n = 70
    full = complete(spark, n)
    ids = G.vertices_of(full)
    got = {(r["seed"], r["id"]): r["hop"] for r in G.neighbourhood(full, ids, None).collect()}
    assert got == {(a, b): int(a != b) for a in range(n) for b in range(n)}
    assert max(sent) <= 2 * n * (n - 1)
    monkeypatch.setattr(G, "MOST_LEVELS", 3)
    chain = spark.createDataFrame([(i, i + 1) for i in range(9)], "src long, dst long")
    seeds = spark.createDataFrame([(0,), (4,), (None,), (77,)], "id long")
    got = {(r["seed"], r["id"]): r["hop"] for r in G.neighbourhood(chain, seeds, None).collect()}
    assert got == {(s, i): abs(s - i) for s in (0, 4) for i in range(10)} | {(77, 77): 0, (None, None): 0}


def test_two_hops_do_not_travel(spark):
    """Nothing is shuffled after the join that makes the hops; duplicates and repeated performances count as before."""
    from linkscore.operators import association as A

    edges = spark.createDataFrame(
        [(10, "x", 1, "2020-01-05"), (10, "x", 2, "2020-01-02"), (10, "x", 2, "2020-01-02"), (9, "d", 2, "2020-01-02"),
         (9, "d", 3, "2020-01-01"), (9, "d", 4, "2020-01-09"), (9, None, 1, "2020-01-05"), (9, "d", None, "2020-01-01"), (9, "d", 3, "2020-01-03")],
        "entity_type int, entity_value string, app_id long, app_time string",
    ).withColumn("app_time", F.to_timestamp("app_time").cast("timestamp_ntz"))
    one = A.one_hop(edges, "2020-01-04", "2020-01-06")
    performance = spark.createDataFrame(
        [(i, p, 7, "pass", 1, i, 100 + i, 1) for i, p in ((1, "a"), (2, "b"), (2, "b"), (3, "c"), (3, "d"), (4, "e"))],
        "order_id long, performance string, apply_time long, type string, history_due_day int, current_due_day long, cert_no long, label int",
    )
    inc = performance.where("order_id = 1")
    plain = A.two_hop(one, edges)
    carried = A.two_hop(one, edges, performance=performance, inc=inc)
    detail = A.association_detail(one.limit(0), carried, performance, inc).where("degree_type = 2")
    for df in (one, plain, carried):
        assert "Exchange" not in plan_of(df).split("Join")[0]
    assert [(r["a_order"], r["b_order"]) for r in one.collect()] == [(1, 2)]
    assert sorted((r["b_order"], r["c_order"], r["c_time"].day) for r in plain.collect()) == [(2, 3, 1), (2, 3, 3)]
    want = A.association_detail(one.limit(0), plain, performance, inc).where("degree_type = 2")
    got = sorted(map(tuple, detail.collect()), key=repr)
    assert detail.columns == want.columns and len(got) == 8 and got == sorted(map(tuple, want.collect()), key=repr)


def test_ratings_travel_as_lists(spark, monkeypatch):
    """pairs of ratings are not shuffled; blocks of lists and of items give the same sums, repeated ratings included."""
    from linkscore.operators import similarity as S

    rows = [(u, i, float((u * 7 + i * 3) % 5 + 1)) for u in range(12) for i in range(15) if (u + i) % 4] + [(0, 1, 2.0), (1, None, 3.0), (None, 2, 1.0), (2, 3, None)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating double")
    want = {}
    for u, i, r in rows:
        for v, j, q in rows:
            if None not in (u, i, j) and u == v and i < j:
                want.setdefault((i, j), []).append(None if None in (r, q) else (r - q) ** 2)
    want = {k: (len(v), round(1 / (1 + sum(x for x in v if x is not None) ** 0.5), 9)) for k, v in want.items()}
    for user_rows, task_rows in ((2_000, 2_000_000), (4, 20)):
        monkeypatch.setattr(S, "LIST_ROWS", user_rows, raising=False)
        monkeypatch.setattr(S, "ROWS_PER_TASK", task_rows, raising=False)
        got = S.item_similarity(df, "euclid")
        assert {(r["item_a"], r["item_b"]): (r["n"], round(r["similarity"], 9)) for r in got.collect()} == want
        assert not re.search(r"hashpartitioning\(item_id_a#\d+L?, (_part#\d+, )?item_id_b#", plan_of(got))


def test_sums_of_pairs_do_not_travel(spark, monkeypatch):
    """no shuffle by both items, whether or not an item is split."""
    from linkscore.operators import similarity as S

    df = spark.createDataFrame([(u, i, float((u + i) % 5)) for u in range(9) for i in range(8)], "user_id long, item_id long, rating double")
    for task_rows in (2_000_000, 20):
        monkeypatch.setattr(S, "ROWS_PER_TASK", task_rows)
        got = S.item_similarity(df, "cosine")
        assert not re.search(r"hashpartitioning\([^)]*item_id_b", plan_of(got))
        assert [r["n"] for r in got.collect()] == [9] * 28


def test_tagged_hops_do_not_travel(spark, monkeypatch):
    """nothing is shuffled after the join that makes the hops, and an entity of very many is cut on both sides."""
    from linkscore import skew
    from linkscore.operators import association as A

    rows = [(o, "email", "NULL") for o in range(30)] + [(o, "applymymobile", f"1{o % 5}") for o in range(30)]
    rows += [(o, "emergencymobile", f"1{o % 7}") for o in range(20)] + [(3, "email", "NULL"), (None, "email", "NULL"), (4, "email", None)]
    rels = spark.createDataFrame(rows, "order_id long, rel string, content string")
    nodes = spark.createDataFrame([("11", 1), ("12", 1), ("12", 1), ("13", 0), (None, 1)], "content string, tagged int")
    allowed = ["email", "applymymobile", "emergencymobile"]
    legs = {r for r in rows if None not in r}
    family = lambda r: "email" if r == "email" else "phone"
    want = {
        (1, ca, ra, a, rb, cb, rc, c)
        for a, ra, ca in legs if ca in ("11", "12")
        for b, rb, cb in legs if b == a and (rb, cb) != (ra, ca)
        for c, rc, cc in legs if cc == cb and family(rc) == family(rb) and (c, rc) != (b, rb) and (c, rc, cb) != (a, ra, ca)
    }
    for most in (10_000_000, 16):
        monkeypatch.setattr(skew, "PAIRS_PER_TASK", most, raising=False)
        got = A.tagged_one_hop(nodes, rels, allowed)
        assert "Exchange" not in plan_of(got).split("Join")[0]
        got = list(map(tuple, got.collect()))
        assert len(got) == len(want) and set(got) == want


def test_links_travel_once(spark):
    """Links go to the place of their person at once; repeated performances and missing numbers count as before."""
    from linkscore.operators import features as X

    def seen(n, **more):
        return {f"order{n}": 5, f"cert_no{n}": 50, f"apply_time{n}": 1, f"label{n}": 0, f"type{n}": "pass", f"performance{n}": "q_refuse",
                f"current_due_day{n}": 4, f"history_due_day{n}": None} | {f"{c}{n}": v for c, v in more.items()}

    two = {"degree_type": 2, "order_src": 1, "cert_no_src": 7, "apply_time_src": 9, "edge1": 9, "edge2": 9, "edge3": 10, "edge4": 10, "value2": "x"}
    rows = [
        two | seen(1) | seen(2), two | seen(1, order=6) | seen(2), two | {"value2": "y"} | seen(1) | seen(2),  # one link
        two | seen(1) | seen(2, order=8, label=1, type=None), two | seen(1) | seen(2, order=8, label=1, current_due_day=40),
        two | seen(1) | seen(2, order=9, cert_no=None, current_due_day=None), two | seen(1) | seen(2, apply_time=9),
        two | {"degree_type": 1, "value2": None} | seen(1, cert_no=7), two | {"degree_type": 1} | seen(1, cert_no=None), two | {"degree_type": 1} | seen(1),
    ]
    names = sorted({c for r in rows for c in r})
    text = {c for c in names if c.startswith(("type", "performance", "value"))}
    detail = spark.createDataFrame([tuple(r.get(c) for c in names) for r in rows], ", ".join(f"{c} {'string' if c in text else 'long'}" for c in names))
    ids = spark.createDataFrame([(1,), (2,)], "order_src long")
    wide = X.association_features(ids, detail)
    for df in (wide, X.count_block(detail, 2, "all"), X.overdue_block(detail, 2, "all")):
        assert not re.search(r"hashpartitioning\(order_src#\d+L?, (scope#\d+, )?cert#\d+L?, \d+\), ENSURE", plan_of(df))
    got = {r["order_src"]: r.asDict() for r in wide.collect()}
    assert [got[1][c] for c in ("order_cnt_2", "id_cnt_2", "black_cnt_2", "q_refuse_cnt_2", "pass_cnt_2", "overdue0_2", "overdue3_2", "overdue30_2", "overdue3_ls_2")] == [4, 1, 2, 4, 3, 0, 2, 1, 0]
    assert (got[1]["order_cnt_self"], got[1]["order_cnt"], got[1]["id_cnt"], got[1]["overdue3"]) == (1, 1, 1, 1)
    assert set(got[2].values()) == {0, 2}
    merged = {r["order_src"]: r.asDict() for r in X.merge_features(ids, X.all_blocks(detail)).collect()}
    assert merged == {k: {c: v[c] for c in merged[k]} for k, v in got.items()}
    assert [tuple(r) for r in X.path_signatures(detail).collect()] == [(1, "9|9|10|10")]


@pytest.fixture
def unbroadcast(spark):
    """Tables as on large inputs, where no side of a join is broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield spark
    spark.conf.set(key, before)


def test_copies_meet_where_the_join_needs_them(unbroadcast):
    """dropping repeated rows takes no shuffle of its own before either hop."""
    from linkscore.operators import association as A

    spark = unbroadcast
    edges = spark.createDataFrame(
        [(9, "d", 1, "2020-01-05"), (9, "d", 2, "2020-01-02"), (9, "d", 2, "2020-01-02"), (10, "x", 2, "2020-01-02"),
         (10, "x", 3, "2020-01-01"), (10, "x", 3, "2020-01-01"), (10, "x", None, "2020-01-01"), (None, "x", 3, "2020-01-01")],
        "entity_type int, entity_value string, app_id long, app_time string",
    ).withColumn("app_time", F.to_timestamp("app_time").cast("timestamp_ntz"))
    performance = spark.createDataFrame(
        [(i, "p", 7, "pass", 1, i, 100 + i, 1) for i in (1, 2, 3)],
        "order_id long, performance string, apply_time long, type string, history_due_day int, current_due_day long, cert_no long, label int",
    )
    one = A.one_hop(edges, "2020-01-04", "2020-01-06")
    plain = A.two_hop(one, edges)
    carried = A.two_hop(one, edges, performance=performance, inc=performance)
    for df, most in ((one, 5), (plain, 4), (carried, 10)):
        assert plan_of(df).count("Exchange") <= most
    assert [(r["a_order"], r["b_order"]) for r in one.collect()] == [(1, 2)]
    for df in (plain, carried):
        assert [(r["a_order"], r["b_order"], r["c_order"], r["type2"]) for r in df.collect()] == [(1, 2, 3, 10)]


def test_paths_are_made_once(spark):
    """signatures and depths come from the distinct paths as from the detail."""
    from linkscore.operators import features as X

    rows = [(1, 2, 9, 9, 10, 10, 1, 1), (1, 2, 9, 9, 10, 10, 1, 1), (1, 1, 9, 9, None, None, 1, 0), (2, 1, 10, 10, None, None, 1, 0), (3, 1, 9, 9, None, None, 0, 1)]
    detail = spark.createDataFrame(rows, "order_src int, degree_type int, edge1 int, edge2 int, edge3 int, edge4 int, label1 int, label2 int").selectExpr(
        "*", "5 AS apply_time_src", "3 AS apply_time1", "2 AS apply_time2"
    )
    paths = X.black_paths(detail).distinct()
    assert paths.count() == 3
    got = {r["order_src"]: r["signature"] for r in X.signatures_of(paths).collect()}
    assert got == {1: "9|9,9|9|10|10", 2: "10|10"} == {r["order_src"]: r["signature"] for r in X.path_signatures(detail).collect()}
    assert {r["order_src"]: r["depth"] for r in X.max_depth(paths).collect()} == {1: 2, 2: 1}


def test_edges_stay_in_place(unbroadcast):
    """a round deals out the state alone, whether or not a source is split; Louvain's messages travel once."""
    from linkscore.operators import louvain as LV
    from linkscore.runtime import stored

    df = complete(unbroadcast, 12).selectExpr("src", "dst", "CAST(src + dst AS double) AS weight")
    state = stored(LV.initial_state(df), "state")
    adaptive = unbroadcast.conf.get("spark.sql.adaptive.enabled")
    for rows, most, all_told in ((500_000, 1, 3), (4, 3, 6)):
        steps = G.blocked(G.both_ways(df, "weight"), rows)
        assert (steps.hot is None) == (rows > 4)
        sent = steps.send(state.select(F.col("id").alias("src"), F.col("node").alias("x")))
        assert plan_of(sent).count("Exchange hashpartitioning") == most
        offers = LV._best_offers(steps, stored(LV._with_sigma(state), "sums"), 1.0)
        assert plan_of(offers).count("Exchange") == all_told
        want = {(a, b): float(a + b) for a in range(12) for b in range(12) if a != b}
        assert {(r["src"], r["dst"]): r["weight"] for r in sent.collect()} == want
    assert unbroadcast.conf.get("spark.sql.adaptive.enabled") == adaptive


def test_edges_are_lists(spark, monkeypatch):
    """A source is one row with its edges; of a hop only what it reached first is written, of the last nothing."""
    df = complete(spark, 12).union(spark.createDataFrame([(3, 1), (4, 4), (5, 2)], "src long, dst long"))
    steps = G.neighbours(df)
    assert steps.edges.count() == 12
    assert sorted(map(tuple, steps.rows().collect())) == [(a, b) for a in range(12) for b in range(12) if a != b]
    as_given = G.blocked(df.selectExpr("src", "IF(dst = 11, NULL, dst) AS dst"), written=True)
    assert as_given.edges.count() == 11 and as_given.rows().count() == 69
    assert {(r["src"], r["dst"]) for r in as_given.rows().collect()} >= {(10, None), (4, 4), (5, 2)}
    names, plain = [], G.stored
    monkeypatch.setattr(G, "stored", lambda df, name: names.append(name) or plain(df, name))
    chain = spark.createDataFrame([(i, i + 1) for i in range(9)], "src long, dst long")
    seeds = spark.createDataFrame([(0,), (4,)], "id long")
    for low in (None, 2):
        names.clear()
        got = {(r["seed"], r["id"]): r["hop"] for r in G.neighbourhood(chain, seeds, 3, low).collect()}
        assert got == {(s, i): abs(s - i) for s in (0, 4) for i in range(10) if abs(s - i) <= 3}
        assert "reached" not in names and names.count("level") == 3  # the seeds and two hops
    assert {(r["seed"], r["id"]) for r in G.neighbourhood(df, seeds, 2, 10).collect()} == {(0, 0), (4, 4)}


def test_tables_by_one_join_have_the_same_rows(spark):
    """Spark's own text of a derived table against the one that the checks share, with missing and repeated keys."""
    from linkscore.catalog import data

    frames = {
        "orders": spark.createDataFrame([(1, 5), (1, 5), (2, None), (3, 6), (None, 7), (1, 8)], "o_orderkey long, o_custkey long"),
        "lineitem": spark.createDataFrame(
            [(1, 10, 20, "R"), (1, 10, 20, "R"), (2, 11, 21, "N"), (9, 12, 22, "N"), (None, 13, 23, "R"), (3, None, 24, None), (3, 14, None, "A"), (1, 15, 25, "N")],
            "l_orderkey long, l_partkey long, l_suppkey long, l_returnflag string",
        ),
    }
    for name, text in data.BUILT.items():
        both = []
        for t in (text, data.DERIVED[name][1]):
            for f in frames:
                t = data._replace_word(t, f)
            both.append(sorted(map(str, spark.sql(t, **frames).collect())))
        assert both[0] == both[1] and len(both[0]) > 4


def test_steps_go_to_the_lists_once(spark, sent, monkeypatch):
    """a hop's vertices meet the lists once, unless some seed may have too many rows for a task."""
    ring = spark.createDataFrame([(i, (i + s) % 9) for i in range(9) for s in (1, 2)], "src long, dst long")
    for rows, times in ((2_000_000, 3), (5, 3)):
        sent.clear()
        monkeypatch.setattr(G, "ROWS_PER_TASK", rows)
        got = {(r["seed"], r["id"]): r["path"] for r in G.reach_exactly(ring, 3).collect()}
        assert len(got) == 18 and got[0, 6] == [0, 2, 4, 6] and got[0, 5] == [0, 1, 3, 5]
        assert len(sent) == times


def test_common_neighbours_write_an_edge_once(spark, monkeypatch):
    """The undirected edges are made distinct and written in one direction."""
    tables, plain = {}, G.stored
    monkeypatch.setattr(G, "stored", lambda df, name: tables.setdefault(name, plain(df, name)))
    both = complete(spark, 12).union(complete(spark, 12).select("dst", "src")).union(spark.createDataFrame([(1, 1), (None, 2)], "src long, dst long"))
    assert {r["common"] for r in G.common_neighbours(both).collect()} == {10}
    assert max(df.count() for df in tables.values()) == 66

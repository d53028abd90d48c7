"""Graph traversal and vertex algorithms as joins over an edge table.

Edges are materialised once, partitioned by source. A source with very many
edges is cut into blocks, so its messages are produced by several tasks; the
vertex state is repeated once per block (at most ``edges / rows_per_block``
extra rows in all). Sums and minima are combined before the shuffle, so a
vertex that receives very many messages is no hot spot either.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkscore.ordered import number_rows
from linkscore.runtime import cut, dealt, discard, shuffle_width, stored
from linkscore.skew import block_counts, salted_join

ROWS_PER_BLOCK = 500_000
CUT_EVERY = 4  # rounds of a linear loop between two materialisations
SEED_BITS = 64  # seeds of a walk that share one number
MOST_LEVELS = 32  # tables of single hops before they become one
LIST_ROWS = 10_000  # neighbours that travel as one list
ROWS_PER_TASK = 2_000_000  # rows that one task makes out of lists


@dataclass
class BlockedEdges:
    """Edges partitioned and sorted by (src, block), or by src where no source is split; ``hot`` lists the split sources.

    Where edges have no other columns, a row holds those of a source or block as a list in the column
    ``listed``. A round's join finds them in place: only the state travels to the edges, whatever its size.
    """

    edges: DataFrame
    hot: DataFrame | None
    listed: str | None = None

    def rows(self, df: DataFrame | None = None) -> DataFrame:
        """A row per edge, of the edges or of what they were joined to."""
        df = self.edges.drop("_blk") if df is None else df
        if self.listed is None:
            return df
        return df.withColumn(self.listed, F.explode(self.listed))

    def send(self, state: DataFrame) -> DataFrame:
        """Join ``state`` (column ``src`` and payload) to every edge of its vertex."""
        if self.hot is None:
            return self.rows(state.join(self.edges.drop("_blk"), "src"))
        keyed = state.join(self.hot, "src", "left").withColumn(
            "_blk", F.explode(F.sequence(F.lit(0), F.coalesce("_blocks", F.lit(1)) - 1))
        ).drop("_blocks")
        return self.rows(keyed.join(self.edges, ["src", "_blk"]).drop("_blk"))


def _ends(edges: DataFrame, *payload: str) -> DataFrame:
    """Every edge in both directions, no loops."""
    pairs = F.explode(
        F.array(
            F.struct(F.col("src"), F.col("dst"), *payload),
            F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"), *payload),
        )
    )
    return edges.where("src <> dst").select(pairs.alias("e")).select("e.*")


def both_ways(edges: DataFrame, weight: str | None = None) -> DataFrame:
    """Every edge in both directions, distinct (or weights summed), no loops."""
    if weight is None:
        return _ends(edges).distinct()
    return _ends(edges, weight).groupBy("src", "dst").agg(F.sum(weight).alias(weight))


def blocked(edges: DataFrame, rows_per_block: int = ROWS_PER_BLOCK, written: bool = False, distinct: bool = False) -> BlockedEdges:
    """Edges as :class:`BlockedEdges`; with ``written`` they are cheap to read twice, as those of a written table.

    Lists take fewer bytes than rows. ``distinct`` drops repeated edges inside the lists, which
    takes no shuffle of its own, and edges without an end; it is for edges without other columns.
    """
    if not written:
        edges = stored(edges, "edges")  # counted, then gathered: computed once
    hot = cut(block_counts(edges, ["src"], rows_per_block))
    split = not hot.isEmpty()
    keys = ["src", "_blk"] if split else ["src"]
    n = shuffle_width(edges.sparkSession)
    if split:
        blk = F.coalesce(F.pmod(F.xxhash64("dst"), F.col("_blocks")).cast("int"), F.lit(0))
        edges = edges.join(hot, "src", "left").withColumn("_blk", blk).drop("_blocks").repartition(n, *keys)
    if set(edges.columns) - {"src", "dst", "_blk"}:  # lists side by side took longer to read than rows
        rows = edges if split else edges.repartition(n, *keys)
        return BlockedEdges(dealt(rows.sortWithinPartitions(*keys)), hot if split else None)
    if distinct:
        lists = edges.groupBy(*keys).agg(F.sort_array(F.array_distinct(F.collect_list("dst"))).alias("dst"))
    else:  # a missing end stays
        lists = edges.groupBy(*keys).agg(F.collect_list(F.struct("dst")).alias("_l")).select(*keys, F.col("_l.dst").alias("dst"))
    return BlockedEdges(dealt(lists.sortWithinPartitions(*keys)), hot if split else None, "dst")


def neighbours(edges: DataFrame, rows_per_block: int = ROWS_PER_BLOCK) -> BlockedEdges:
    """The undirected graph, each edge once in both directions, no loops."""
    half = stored(edges.where("src <> dst").select("src", "dst"), "edges")
    return blocked(_ends(half), rows_per_block, written=True, distinct=True)


def vertices_of(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


# --- neighbourhoods ------------------------------------------------------


def drop_high_degree(edges: DataFrame, max_degree: int) -> DataFrame:
    """Undirected edges without the vertices of more than ``max_degree`` neighbours."""
    hubs = edges.groupBy("src").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max_degree)
    gone = hubs.select(F.col("src").alias("id"))
    return edges.join(gone, edges["src"] == gone["id"], "left_anti").join(
        gone, edges["dst"] == gone["id"], "left_anti"
    )


def neighbourhood(
    edges: DataFrame,
    seeds: DataFrame,
    degree: int | None,
    max_degree: int | None = None,
    attrs: DataFrame | None = None,
    edge_filter: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """(seed, hop, id): vertices within ``degree`` undirected hops (None: all), hop 0 being the seed.

    ``edge_filter(a, b)`` keeps the steps from a vertex with attribute ``a`` to
    one with attribute ``b`` (table ``attrs``: id, attr), in either direction.
    The reached set of each seed is kept whole. Seeds are numbered, and a vertex holds
    one bit for each: 64 seeds travel along an edge as one number.
    """
    steps = neighbours(edges)
    if max_degree is not None:
        steps = blocked(drop_high_degree(steps.rows(), max_degree), distinct=True)
    if edge_filter is not None:
        a = attrs.select(F.col("id").alias("src"), F.col("attr").alias("_a"))
        b = attrs.select(F.col("id").alias("dst"), F.col("attr").alias("_b"))
        # a vertex may have several attributes, so a step may come out more than once
        kept = steps.rows().join(a, "src").join(b, "dst").where(edge_filter(F.col("_a"), F.col("_b"))).select("src", "dst")
        steps = blocked(kept, distinct=True)
    numbered = number_rows(seeds.select("id").distinct(), [F.col("id")], "_n").withColumn("_n", F.col("_n") - 1)
    numbered = stored(numbered.select("id", F.floor(F.col("_n") / SEED_BITS).alias("_set"), (F.col("_n") % SEED_BITS).cast("int").alias("_bit")), "seeds")
    front = stored(numbered.select("id", "_set", F.expr("shiftleft(1L, _bit)").alias("_new"), F.lit(0).alias("hop")), "level")
    levels = [front]  # all that was reached; nothing else is kept of a hop
    none = F.lit(0).cast("long")
    for hop in itertools.count(1) if degree is None else range(1, degree + 1):
        sent = steps.send(front.select(F.col("id").alias("src"), "_set", "_new"))
        seen = functools.reduce(DataFrame.unionByName, levels)
        both = seen.select("id", "_set", F.col("_new").alias("_old"), none.alias("_got")).unionByName(
            sent.select(F.col("dst").alias("id"), "_set", none.alias("_old"), F.col("_new").alias("_got"))
        )
        merged = both.groupBy("id", "_set").agg(F.bit_or("_old").alias("_old"), F.bit_or("_got").alias("_got"))
        new = F.col("_got").bitwiseAND(F.bitwise_not("_old"))
        front = merged.select("id", "_set", new.alias("_new"), F.lit(hop).alias("hop")).where("_new <> 0")
        if hop == degree:  # goes straight to the result
            levels.append(front)
            break
        front = stored(front, "level")
        if front.isEmpty():
            break
        levels.append(front)
        if len(levels) > MOST_LEVELS:  # a long chain: one table again
            whole = stored(functools.reduce(DataFrame.unionByName, levels), "level")
            for old in levels:
                discard(old)
            levels, front = [whole], whole.where(F.col("hop") == hop)
    names = numbered.groupBy("_set").agg(F.transform(F.array_sort(F.collect_list(F.struct("_bit", "id"))), lambda x: x["id"]).alias("_ids"))
    bits = F.sequence(F.lit(0), F.lit(SEED_BITS - 1))
    at = F.explode(F.filter(bits, lambda i: F.getbit("_new", i) == 1)).alias("_at")
    reached = functools.reduce(DataFrame.unionByName, levels).join(names, "_set").select("hop", "id", "_ids", at)
    return reached.select(F.get("_ids", "_at").alias("seed"), "hop", "id")


def neighbour_attrs(reached: DataFrame, attrs: DataFrame) -> DataFrame:
    """Distinct attributes per seed and hop, one row each."""
    return reached.join(attrs, "id").select("seed", "hop", "attr").distinct()


def reach_exactly(edges: DataFrame, n: int, seeds: DataFrame | None = None) -> DataFrame:
    """(seed, id, path): vertices whose shortest directed distance is ``n``.

    The smallest shortest path (by vertex order) stands for all of them. The lists of
    neighbours travel to the seeds, not single paths, and become rows only where they
    are combined; a seed with very many rows is split by the vertices reached.
    """
    if seeds is None:
        edges = stored(edges.select("src", "dst"), "edges")
    steps = blocked(edges.where("src <> dst").select("src", "dst"), LIST_ROWS, written=seeds is None, distinct=True)
    lists = BlockedEdges(steps.edges.select("src", *["_blk"] * (steps.hot is not None), F.col("dst").alias("_to")), steps.hot)
    starts = vertices_of(edges) if seeds is None else seeds.select("id")
    widths = stored(lists.edges.groupBy("src").agg(F.sum(F.size("_to")).alias("_n")), "widths")
    widest = widths.agg(F.max("_n")).first()[0] or 0
    level = stored(starts.distinct().select(F.col("id").alias("seed"), "id", F.array("id").alias("path")), "reach")
    seen = level.select("seed", F.array("id").alias("_to"), F.lit(0).alias("hop"))
    for hop in range(1, n + 1):
        # up to two steps the vertex before tells the path; beyond, the whole path has to be compared
        via = F.col("id") if hop <= 2 else F.col("path")
        front = level.select("seed", F.col("id").alias("src"), via.alias("_via"))
        total = front.groupBy("src").agg(F.count(F.lit(1)).alias("_times")).join(widths, "src").agg(F.sum(F.col("_times") * F.col("_n"))).first()[0] or 0
        most = (front.groupBy("seed").agg(F.count(F.lit(1)).alias("_times")).agg(F.max("_times")).first()[0] or 0) * widest
        split = None
        if most > ROWS_PER_TASK:  # some seed may have more rows than a task should make
            rows = front.join(widths, "src").groupBy("seed").agg(F.sum("_n").alias("_rows")).where(F.col("_rows") > ROWS_PER_TASK)
            split = cut(rows.select("seed", F.ceil(F.col("_rows") / ROWS_PER_TASK).cast("int").alias("_parts")))
        sent = lists.send(front).select("seed", "_to", F.lit(hop).alias("hop"), "_via")
        sent = sent.unionByName(seen.withColumn("_via", F.lit(None).cast(sent.schema["_via"].dataType)))
        if split is None or split.isEmpty():
            sent = sent.withColumn("_part", F.lit(0))
        else:
            parts = F.coalesce("_parts", F.lit(1))
            sent = sent.join(split, "seed", "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
            mine = F.filter("_to", lambda x: F.pmod(F.xxhash64(x), parts) == F.col("_part"))
            sent = sent.withColumn("_to", F.when(parts == 1, F.col("_to")).otherwise(mine)).drop("_parts")
        tasks = max(shuffle_width(edges.sparkSession), total // ROWS_PER_TASK + 1)
        here = sent.repartition(tasks, "seed", "_part").select("seed", "_part", F.explode("_to").alias("id"), "hop", "_via")
        best = here.groupBy("seed", "_part", "id").agg(F.min("hop").alias("hop"), F.min("_via").alias("_via")).where(F.col("hop") == hop)
        kept = best.select("seed", "id", *["_via"] * (hop > 1))
        if hop < n:
            kept = stored(kept, "reach")  # without paths that the columns tell
            seen = seen.unionByName(kept.select("seed", F.array("id").alias("_to"), F.lit(hop).alias("hop")))
        path = [F.array("seed", "id"), F.array("seed", "_via", "id")][hop - 1] if hop <= 2 else F.concat("_via", F.array("id"))
        level = kept.select("seed", "id", path.alias("path"))
    return level


def paths(edges: DataFrame, starts: DataFrame, hops: int) -> DataFrame:
    """Alternating entity/application paths of exactly ``hops`` edges.

    ``edges`` and ``starts`` have (entity, app); a path begins with an edge of
    ``starts``. An application never returns; an entity may, but not straight
    back over the edge just used. Result: (path, seed, apps).
    """
    e = edges.select("entity", "app")
    state = starts.select(
        F.col("entity").alias("seed"),
        F.array("entity", F.col("app").cast("string")).alias("path"),
        F.array("app").alias("apps"),
        F.col("app").alias("_app"),
        F.col("entity").alias("_entity"),
    )
    for hop in range(2, hops + 1):
        if hop % 2 == 0:  # from an application to another of its entities
            step = e.select(F.col("app").alias("_app"), F.col("entity").alias("_next"))
            state = state.join(step, "_app").where(F.col("_next") != F.col("_entity")).select(
                "seed", F.concat("path", F.array("_next")).alias("path"), "apps", "_app", F.col("_next").alias("_entity")
            )
        else:  # from an entity to an application not on the path
            step = e.select(F.col("entity").alias("_entity"), F.col("app").alias("_next"))
            state = state.join(step, "_entity").where(~F.array_contains("apps", F.col("_next"))).select(
                "seed",
                F.concat("path", F.array(F.col("_next").cast("string"))).alias("path"),
                F.concat("apps", F.array("_next")).alias("apps"),
                F.col("_next").alias("_app"),
                "_entity",
            )
    return state.select("seed", "path", "apps")


# --- the general loop ----------------------------------------------------


def iterate(
    vertices: DataFrame,
    edges: DataFrame,
    send: Callable[[Column], Column],
    combine: Callable[[str], Column],
    update: Callable[[Column, Column], Column],
    rounds: int,
    direction: str = "out",
) -> DataFrame:
    """Vertex program on (id, value).

    Each round every vertex sends ``send(value)`` along its edges (``out``,
    ``in`` or ``both``), messages are merged by the aggregate ``combine`` and
    a vertex with messages becomes ``update(value, message)``. Ends after
    ``rounds`` or when nothing changes.
    """
    e = edges.select("src", "dst")
    if direction == "in":
        e = e.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    steps = neighbours(e) if direction == "both" else blocked(e)
    state = cut(vertices.select("id", "value"))
    for _ in range(rounds):
        sent = steps.send(state.select(F.col("id").alias("src"), send(F.col("value")).alias("_m")))
        merged = sent.where(F.col("_m").isNotNull()).groupBy(F.col("dst").alias("id")).agg(combine("_m").alias("_m"))
        new = F.when(F.col("_m").isNull(), F.col("value")).otherwise(update(F.col("value"), F.col("_m")))
        after = cut(state.join(merged, "id", "left").select("id", new.alias("value"), (~new.eqNullSafe(F.col("value"))).alias("_c")))
        state = after.drop("_c")
        if after.where("_c").isEmpty():
            break
    return state


# --- ranking -------------------------------------------------------------


def pagerank(
    edges: DataFrame, rounds: int | None = None, tol: float | None = None, reset: float = 0.15
) -> DataFrame:
    """(id, rank): ranks start at 1.0, ``reset + (1 - reset) * incoming shares`` per round.

    A fixed number of rounds, or rounds until no rank changes by ``tol``, which
    comes about because every round shrinks the changes by ``1 - reset``.
    """
    if rounds is None and not (tol and tol > 0):
        raise ValueError("give rounds or a positive tolerance")
    e = edges.select("src", "dst").distinct()
    steps = blocked(e)
    out = steps.rows().groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("out"))
    n = shuffle_width(edges.sparkSession)
    base = cut(vertices_of(steps.rows()).join(out, "id", "left").repartition(n, "id"))
    state = base.withColumn("rank", F.lit(1.0))
    for r in itertools.count(1) if rounds is None else range(1, rounds + 1):
        share = state.where("out IS NOT NULL").select(F.col("id").alias("src"), (F.col("rank") / F.col("out")).alias("_m"))
        sums = steps.send(share).groupBy(F.col("dst").alias("id")).agg(F.sum("_m").alias("_m"))
        rank = F.lit(reset) + F.lit(1.0 - reset) * F.coalesce("_m", F.lit(0.0))
        # the fixed loop never looks back, so its plan stays one chain between cuts
        new = base.join(sums, "id", "left").select("id", "out", rank.alias("rank"))
        if tol is None:
            state = cut(new) if r % CUT_EVERY == 0 else new
            continue
        new = cut(new)
        old = state.select("id", F.col("rank").alias("_old"))
        moved = new.join(old, "id").agg(F.max(F.abs(F.col("rank") - F.col("_old")))).first()[0]
        state = new
        if moved is None or moved <= tol:
            break
    return state.select("id", "rank")


def hits(edges: DataFrame, rounds: int) -> DataFrame:
    """(id, hub, authority), both scaled to sum 1 in every round."""
    e = edges.select("src", "dst").distinct()
    fwd = blocked(e)
    back = blocked(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    ids = cut(vertices_of(e))

    def spread(steps: BlockedEdges, state: DataFrame) -> DataFrame:
        got = steps.send(state.select(F.col("id").alias("src"), "v")).groupBy(F.col("dst").alias("id")).agg(F.sum("v").alias("v"))
        got = cut(ids.join(got, "id", "left").fillna(0.0, ["v"]))
        total = got.agg(F.sum("v")).first()[0] or 1.0
        return got.select("id", (F.col("v") / F.lit(total)).alias("v"))

    hub = ids.withColumn("v", F.lit(1.0))
    authority = hub
    for _ in range(rounds):
        authority = spread(fwd, hub)
        hub = spread(back, authority)
    return hub.withColumnRenamed("v", "hub").join(authority.withColumnRenamed("v", "authority"), "id")


def landmark_distances(edges: DataFrame, landmarks: DataFrame, max_hops: int | None = None) -> DataFrame:
    """(id, landmark, distance): shortest undirected hop counts to the landmarks, however far."""
    got = neighbourhood(edges, landmarks, max_hops)
    return got.select("id", F.col("seed").alias("landmark"), F.col("hop").alias("distance"))


def closeness(distances: DataFrame) -> DataFrame:
    """Inverse of the mean distance to the landmarks reached (0 where that is 0)."""
    mean = F.avg("distance")
    return distances.groupBy("id").agg(F.when(mean > 0, 1.0 / mean).otherwise(F.lit(0.0)).alias("closeness"))


# --- similarity of neighbourhoods ---------------------------------------


def common_neighbours(edges: DataFrame) -> DataFrame:
    """(src, dst, common, deg_src, deg_dst) for every undirected edge, ``src < dst``.

    Triangles are found from their vertex of least degree only: edges point
    from lower to higher degree, so a vertex has at most ``sqrt(2 * edges)``
    outgoing ones however large its neighbourhood, and no hub's neighbours
    are ever paired with each other. The list of an edge's upper end comes to its
    lower end and is compared with the list there, so pairs of neighbours are never rows.
    """
    once = edges.where("src <> dst").select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
    half = stored(once.distinct(), "half")
    deg = stored(half.select(F.explode(F.array("src", "dst")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("deg")), "deg")
    with_src = salted_join(half, deg.select(F.col("id").alias("src"), F.col("deg").alias("deg_src")), ["src"], F.col("dst"))
    full = stored(salted_join(with_src, deg.select(F.col("id").alias("dst"), F.col("deg").alias("deg_dst")), ["dst"], F.col("src")), "full")
    upward = F.struct("deg_src", "src") < F.struct(F.col("deg_dst").alias("deg_src"), F.col("dst").alias("src"))
    low = full.select(
        F.when(upward, F.col("src")).otherwise(F.col("dst")).alias("v"), F.when(upward, F.col("dst")).otherwise(F.col("src")).alias("a")
    )
    above = stored(low.groupBy("v").agg(F.collect_list("a").alias("_above")), "above")
    near = salted_join(low, above.select(F.col("v").alias("a"), F.col("_above").alias("_near")), ["a"], F.col("v"))
    third = F.array_intersect("_near", "_above")
    closed = near.join(above, "v").select("v", "a", third.alias("_third")).where(F.size("_third") > 0)

    def edge(x: Column, y: Column, n: Column) -> Column:
        return F.struct(F.least(x, y).alias("src"), F.greatest(x, y).alias("dst"), n.cast("long").alias("n"))

    v, a = F.col("v"), F.col("a")
    sides = F.concat(
        F.array(edge(v, a, F.size("_third"))),
        F.transform("_third", lambda b: edge(v, b, F.lit(1))),
        F.transform("_third", lambda b: edge(a, b, F.lit(1))),
    )
    per_edge = closed.select(F.explode(sides).alias("e")).groupBy("e.src", "e.dst").agg(F.sum("e.n").alias("common"))
    return full.join(per_edge, ["src", "dst"], "left").fillna(0, ["common"]).select(
        "src", "dst", "common", "deg_src", "deg_dst"
    )


def jaccard(edges: DataFrame) -> DataFrame:
    """Shared over united neighbours of the two ends of every edge."""
    c = common_neighbours(edges)
    return c.select("src", "dst", (F.col("common") / (F.col("deg_src") + F.col("deg_dst") - F.col("common"))).alias("similarity"))


def structural_similarity(edges: DataFrame) -> DataFrame:
    """Cosine of the closed neighbourhoods of the two ends of every edge."""
    c = common_neighbours(edges)
    # each closed neighbourhood also holds both ends themselves
    cos = (F.col("common") + 2) / F.sqrt((F.col("deg_src") + 1) * (F.col("deg_dst") + 1))
    return c.select("src", "dst", cos.alias("similarity"))


def stored_round(df: DataFrame) -> DataFrame:
    """Table of one round, written so that the planner sees its true size and not a product of estimates."""
    return stored(df, "round")


def connected_components(edges: DataFrame, vertices: DataFrame | None = None) -> DataFrame:
    """(id, component): the smallest vertex id of each undirected component.

    Every round takes the least label around a vertex and then follows the
    label's own label, which halves long chains; the loop ends when no label
    changes, which it must, as labels only fall.
    """
    steps = neighbours(edges)
    ids = steps.edges.select(F.col("src").alias("id")).distinct() if vertices is None else vertices.select("id").distinct()
    state = held = stored_round(ids.withColumn("component", F.col("id")))
    while True:
        around = steps.send(state.select(F.col("id").alias("src"), F.col("component").alias("_m")))
        least = around.groupBy(F.col("dst").alias("id")).agg(F.min("_m").alias("_m"))
        near = stored_round(
            state.join(least, "id", "left").select(
                "id", F.least("component", F.coalesce("_m", "component")).alias("component"), F.col("component").alias("_old")
            )
        )
        # one row per label, so following labels does not move hot labels around
        labels = near.select(F.col("component").alias("id")).distinct()
        jump = labels.join(near.select("id", F.col("component").alias("_to")), "id").select(F.col("id").alias("component"), "_to")
        after = stored_round(
            salted_join(near, jump, ["component"], F.col("id")).select(
                "id", F.col("_to").alias("component"), (F.col("_to") != F.col("_old")).alias("_c")
            )
        )
        state = after.drop("_c")
        for old in (near, held):
            discard(old)
        held = after
        if after.where("_c").isEmpty():
            break
    return state


def pscan(edges: DataFrame, eps: float = 1e-6) -> DataFrame:
    """Components of the edges whose structural similarity exceeds ``eps``."""
    strong = cut(structural_similarity(edges).where(F.col("similarity") > eps).select("src", "dst"))
    return connected_components(strong, vertices_of(edges))


# --- communities by labels ----------------------------------------------


def label_propagation(edges: DataFrame, rounds: int) -> DataFrame:
    """(id, label): most frequent label around each vertex per round, smallest on a tie."""
    steps = neighbours(edges)
    state = cut(steps.edges.select(F.col("src").alias("id")).distinct()).withColumn("label", F.col("id"))
    for r in range(1, rounds + 1):
        sent = steps.send(state.select(F.col("id").alias("src"), "label"))
        votes = sent.groupBy(F.col("dst").alias("id"), "label").agg(F.count(F.lit(1)).alias("n"))
        state = votes.groupBy("id").agg(F.min(F.struct((-F.col("n")).alias("n"), "label")).alias("b")).select("id", "b.label")
        if r % CUT_EVERY == 0:
            state = cut(state)
    return state


def coarse_labels(edges: DataFrame, rounds: int, drop_self: bool = True) -> DataFrame:
    """Smallest id within ``rounds`` undirected hops; own ids left out on request."""
    steps = neighbours(edges)
    state = steps.edges.select(F.col("src").alias("id")).distinct().withColumn("label", F.col("id"))
    for r in range(1, rounds + 1):
        sent = steps.send(state.select(F.col("id").alias("src"), "label")).select(F.col("dst").alias("id"), "label")
        state = sent.unionByName(state).groupBy("id").agg(F.min("label").alias("label"))  # a vertex keeps its own label
        if r % CUT_EVERY == 0:
            state = cut(state)
    return state.where("label <> id") if drop_self else state


def modularity(edges: DataFrame, labels: DataFrame, weight: str | None = None) -> DataFrame:
    """One row ``q`` for undirected edges and (id, label)."""
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    e = edges.select("src", "dst", w.alias("_w"))
    a = labels.select(F.col("id").alias("src"), F.col("label").alias("_a"))
    b = labels.select(F.col("id").alias("dst"), F.col("label").alias("_b"))
    marked = salted_join(salted_join(e, a, ["src"], F.col("dst")), b, ["dst"], F.col("src"))
    ends = F.explode(
        F.array(
            F.struct(F.col("_a").alias("c"), F.when(F.col("_a") == F.col("_b"), F.col("_w")).otherwise(0.0).alias("inside"), F.col("_w").alias("w")),
            F.struct(F.col("_b").alias("c"), F.lit(0.0).alias("inside"), F.col("_w").alias("w")),
        )
    )
    per = marked.select(ends.alias("x")).groupBy("x.c").agg(F.sum("x.inside").alias("inside"), F.sum("x.w").alias("deg"))
    m = F.sum("deg") / 2
    return per.agg((F.sum("inside") / m - F.sum(F.col("deg") * F.col("deg")) / (4 * m * m)).alias("q"))


def power_clusters(edges: DataFrame, k: int, rounds: int) -> DataFrame:
    """(id, cluster) by power iteration on edges weighted by the ranks of their ends."""
    from pyspark.ml.clustering import PowerIterationClustering

    ranks = cut(pagerank(edges, rounds=5))
    a = ranks.select(F.col("id").alias("src"), F.col("rank").alias("_a"))
    b = ranks.select(F.col("id").alias("dst"), F.col("rank").alias("_b"))
    und = both_ways(edges).where("src < dst")
    weighted = salted_join(salted_join(und, a, ["src"], F.col("dst")), b, ["dst"], F.col("src")).select(
        "src", "dst", (F.col("_a") * F.col("_b")).alias("weight")
    )
    return PowerIterationClustering(k=k, maxIter=rounds, initMode="degree", weightCol="weight").assignClusters(weighted)


def ssl_propagate(vertices: DataFrame, edges: DataFrame, rounds: int) -> DataFrame:
    """(id, label): known labels stay, others take the largest weight sum around them.

    A vertex is decided in the first round in which a neighbour is, so only
    the vertices decided in the round before can vote: the loop works on that
    frontier and stops when it is empty. Ties go to the smallest label.
    """
    steps = blocked(both_ways(edges, "weight"))
    state = cut(vertices.select("id", "label", F.when(F.col("label").isNotNull(), 0).alias("_at")))
    for r in range(1, rounds + 1):
        front = state.where(F.col("_at") == r - 1).select(F.col("id").alias("src"), "label")
        votes = steps.send(front).groupBy(F.col("dst").alias("id"), "label").agg(F.round(F.sum("weight"), 9).alias("w"))
        best = votes.groupBy("id").agg(F.min(F.struct((-F.col("w")).alias("w"), "label")).alias("b")).select("id", F.col("b.label").alias("_new"))
        state = cut(
            state.join(best, "id", "left").select(
                "id",
                F.coalesce("label", "_new").alias("label"),
                F.coalesce("_at", F.when(F.col("_new").isNotNull(), F.lit(r))).alias("_at"),
            )
        )
        if state.where(F.col("_at") == r).isEmpty():
            break
    return state.drop("_at")

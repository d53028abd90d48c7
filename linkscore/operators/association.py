"""From application rows to typed edges, and from edges to linked applications."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkscore.runtime import stored
from linkscore.skew import HOT_ROWS, block_counts, grid_join, salted_join

# Entity type codes of the association graph.
ENTITY_TYPES = {
    "loan_pan": 4,
    "return_pan": 5,
    "recommend": 7,
    "device_id": 9,
    "cert_no": 10,
    "email": 11,
    "mobile": 13,
    "emergency_mobile": 16,
    "contact_mobile": 17,
    "msgphone": 19,
    "hometel": 20,
}
MAX_DEGREE = 10_000  # entities with this many applications or more are hubs
KEY = ["entity_type", "entity_value"]


def application_edges(
    apps: DataFrame,
    spec: Mapping[str, int] = ENTITY_TYPES,
    app_id: str = "order_id",
    app_time: str = "insert_time",
) -> DataFrame:
    """One distinct edge per non-blank entity column of an application row."""
    cols = [c for c in spec if c in apps.columns]
    entries = F.array(
        *[
            F.struct(F.lit(spec[c]).alias("entity_type"), F.col(c).cast("string").alias("entity_value"))
            for c in cols
        ]
    )
    filled = F.filter(
        entries,
        lambda e: e["entity_value"].isNotNull() & (F.trim(e["entity_value"]) != ""),
    )
    return (
        apps.select(F.col(app_id).alias("app_id"), F.col(app_time).alias("app_time"), F.explode(filled).alias("e"))
        .select("e.entity_type", "e.entity_value", "app_id", "app_time")
        .distinct()
    )


def phone_edges(apps: DataFrame, cols: Sequence[str], app_id: str = "order_id") -> DataFrame:
    """Application/phone edges in both directions, zero and blank ids dropped."""
    phones = apps.select(
        F.col(app_id).cast("string").alias("src"),
        F.explode(F.array(*[F.col(c).cast("string") for c in cols])).alias("dst"),
    )
    kept = phones.where(~F.trim("src").isin("", "0") & ~F.trim("dst").isin("", "0"))
    # an explode to two rows reads the source once, a union would read it twice
    both = F.explode(
        F.array(
            F.struct(F.col("src"), F.col("dst")),
            F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")),
        )
    )
    return kept.select(both.alias("e")).select("e.src", "e.dst").distinct()


def call_edges(calls: DataFrame, caller: str, callee: str) -> DataFrame:
    """Distinct caller -> callee edges with both ends filled."""
    def filled(c):
        return F.col(c).isNotNull() & ~F.trim(F.col(c).cast("string")).isin("", "0")

    return (
        calls.where(filled(caller) & filled(callee))
        .select(F.col(caller).alias("src"), F.col(callee).alias("dst"))
        .distinct()
    )


def degrees(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """In-, out- and total degree of every vertex, in one aggregation."""
    ends = F.explode(
        F.array(
            F.struct(F.col(src).alias("id"), F.lit(1).alias("o"), F.lit(0).alias("i")),
            F.struct(F.col(dst).alias("id"), F.lit(0).alias("o"), F.lit(1).alias("i")),
        )
    )
    return (
        edges.select(ends.alias("e"))
        .groupBy(F.col("e.id").alias("id"))
        .agg(F.sum("e.i").alias("in_degree"), F.sum("e.o").alias("out_degree"))
        .withColumn("degree", F.col("in_degree") + F.col("out_degree"))
    )


def drop_hubs(edges: DataFrame, max_degree: int = MAX_DEGREE, keys: Sequence[str] = KEY) -> DataFrame:
    """Edges whose entity has fewer than ``max_degree`` applications.

    The hub list is an aggregate (combined map-side) of at most
    ``edges / max_degree`` rows; the adaptive planner broadcasts it when its
    measured size is small and otherwise splits the hot side of the anti join.
    """
    hubs = (
        edges.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= max_degree).drop("_n")
    )
    return edges.join(hubs, list(keys), "left_anti")


def in_window(ts: Column, start: str, end: str, lag_days: int = 0) -> Column:
    """Inclusive window test; false where ``ts`` is missing or unparsable."""
    lo = F.lit(start).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(lag_days)} DAYS")
    hi = F.lit(end).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(lag_days)} DAYS")
    return F.coalesce(ts.between(lo, hi), F.lit(False))


def _earlier(df: DataFrame, time: str, sources: DataFrame) -> DataFrame:
    """Rows earlier than the last source; the others link with nothing."""
    last = sources.agg(F.max("a_time").alias("_last"))  # one row
    return df.join(F.broadcast(last), F.col(time) < F.col("_last")).drop("_last")


def one_hop(
    edges: DataFrame,
    start: str | None = None,
    end: str | None = None,
    max_degree: int | None = None,
    lag_days: int = 0,
    seeds: DataFrame | None = None,
) -> DataFrame:
    """Applications of the window linked to strictly earlier applications.

    ``seeds`` (``app_id``) names the applications themselves, instead of or
    besides a window. They are cut out before the join. All entities count
    unless ``max_degree`` leaves the hubs out; the rows of a hot entity are
    spread by application id.
    """
    kept = edges if max_degree is None else drop_hubs(edges, max_degree)
    chosen = kept if start is None else kept.where(in_window(F.col("app_time"), start, end, lag_days))
    if seeds is not None:
        chosen = chosen.join(seeds.select("app_id"), "app_id", "left_semi")
    seed_rows = chosen.select(*KEY, F.col("app_id").alias("a_order"), F.col("app_time").alias("a_time")).distinct()
    older = kept.select(*KEY, F.col("app_id").alias("b_order"), F.col("app_time").alias("b_time"))
    older = _earlier(older, "b_time", seed_rows)
    hot = stored(block_counts(older, KEY, HOT_ROWS), "hot")
    if hot.isEmpty():  # copies of a row go where the join needs it; the rows of a hot entity would meet in one task
        older = older.repartition(*KEY)
    linked = salted_join(older.distinct(), seed_rows, KEY, F.col("b_order"), hot=hot)
    # both sides are distinct and all their columns are kept, so the links are as well
    return linked.where((F.col("a_time") > F.col("b_time")) & (F.col("a_order") != F.col("b_order"))).select(
        "a_time",
        "a_order",
        F.col("entity_value").alias("value1"),
        F.col("entity_type").alias("type1"),
        "b_time",
        "b_order",
        F.to_date("a_time").alias("dt"),
    )


def two_hop(
    one: DataFrame,
    edges: DataFrame,
    max_degree: int | None = None,
    performance: DataFrame | None = None,
    inc: DataFrame | None = None,
) -> DataFrame:
    """Extend one-hop rows by any entity of ``b`` to a third application ``c``.

    ``c`` differs from ``a`` and ``b`` and is strictly earlier than ``a``; it
    need not be earlier than ``b``. Both joins spread the rows of an application
    or entity that very many hops pass through. Duplicates go before the last join,
    whose rows are by far the most and do not travel any more. With ``performance``
    and ``inc`` the rows carry what :func:`association_detail` adds; it is joined before
    the last join, too.
    """
    kept = edges if max_degree is None else drop_hubs(edges, max_degree)
    via = kept.select(
        F.col("app_id").alias("b_order"),
        F.col("entity_type").alias("type2"),
        F.col("entity_value").alias("value2"),
    )
    third = kept.select(
        F.col("entity_type").alias("type2"),
        F.col("entity_value").alias("value2"),
        F.col("app_id").alias("c_order"),
        F.col("app_time").alias("c_time"),
    )
    middle = stored(salted_join(one, via, ["b_order"], F.struct("a_order", "value1")).distinct(), "middle")
    third = _earlier(third, "c_time", middle)
    hot = stored(block_counts(third, KEY2, HOT_ROWS), "hot")
    # copies of a row go where the next join needs it
    if performance is not None:
        third = third.repartition("c_order")
    elif hot.isEmpty():
        third = third.repartition(*KEY2)
    third = third.distinct()
    if performance is not None:
        # their own names, as the legs have a type1 and a type2 as well
        p1, p2 = (_performance_of(performance, n).withColumnsRenamed({f"{c}{n}": f"_{c}{n}" for c in PERFORMANCE}) for n in (1, 2))
        middle = middle.join(_source_of(inc), F.col("a_order") == F.col("order_src")).join(p1, F.col("b_order") == F.col("order1"))
        third = third.join(p2, F.col("c_order") == F.col("order2"))
        middle, third = middle.drop("order_src", "order1"), third.drop("order2")
    return (
        salted_join(third, middle, KEY2, F.col("c_order"), hot=hot)
        .where(
            (F.col("c_order") != F.col("a_order"))
            & (F.col("c_order") != F.col("b_order"))
            & (F.col("a_time") > F.col("c_time"))
        )
        .select(
            "a_time", "a_order", "value1", "type1", "b_time", "b_order",
            "value2", "type2", "c_time", "c_order", "dt",
            *([] if performance is None else CARRIED),
        )
    )


def assemble_applications(apply: DataFrame, device: DataFrame, user: DataFrame, day: str) -> DataFrame:
    """One day's applications with their device and user rows where known."""
    today = apply.where(F.col("day") == F.lit(day).cast("date"))
    return today.join(device, "order_id", "left").join(user, "user_id", "left")


def increment(current: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """Rows of ``current`` whose key is not in ``history``."""
    return current.join(history.select(key), key, "left_anti")


PERFORMANCE = ["performance", "apply_time", "type", "history_due_day", "current_due_day", "cert_no", "label"]


SOURCE = ["cert_no_src", "apply_time_src"]
KEY2 = ["type2", "value2"]
CARRIED = [*SOURCE, *[f"_{c}{n}" for n in (1, 2) for c in PERFORMANCE]]  # columns of two-hop rows with their performance


def _source_of(inc: DataFrame) -> DataFrame:
    return inc.select(
        F.col("order_id").alias("order_src"),
        F.col("cert_no").alias("cert_no_src"),
        F.col("apply_time").alias("apply_time_src"),
    )


def _performance_of(performance: DataFrame, n: int) -> DataFrame:
    return performance.select(
        F.col("order_id").alias(f"order{n}"), *[F.col(c).alias(f"{c}{n}") for c in PERFORMANCE]
    )


def association_detail(one: DataFrame, two: DataFrame, performance: DataFrame, inc: DataFrame) -> DataFrame:
    """Hop rows of the increment with the performance of the linked applications.

    Two-hop rows that carry their performance (:func:`two_hop`) are not joined again.
    """
    source = _source_of(inc)
    first = one.select(
        F.col("a_order").alias("order_src"),
        F.col("type1").alias("edge1"),
        F.col("value1"),
        F.col("type1").alias("edge2"),
        F.col("b_order").alias("order1"),
    )
    carried = set(CARRIED) <= set(two.columns)
    known = [F.col(c).alias(c.removeprefix("_")) for c in CARRIED] if carried else []
    second = two.select(
        F.col("a_order").alias("order_src"),
        F.col("type1").alias("edge1"),
        F.col("value1"),
        F.col("type1").alias("edge2"),
        F.col("b_order").alias("order1"),
        F.col("type2").alias("edge3"),
        F.col("value2"),
        F.col("type2").alias("edge4"),
        F.col("c_order").alias("order2"),
        *known,
    )
    p1, p2 = _performance_of(performance, 1), _performance_of(performance, 2)
    hop1 = first.join(source, "order_src").join(p1, "order1").withColumn("degree_type", F.lit(1))
    hop2 = second if carried else second.join(source, "order_src").join(p1, "order1").join(p2, "order2")
    order = ["order2", "order1", "order_src", "edge1", "value1", "edge2", "edge3", "value2", "edge4", *SOURCE]
    hop2 = hop2.select(*order, *[f"{c}{n}" for n in (1, 2) for c in PERFORMANCE]).withColumn("degree_type", F.lit(2))
    return hop2.unionByName(hop1, allowMissingColumns=True)


def graph_from_rows(df: DataFrame, key: str, refs: Sequence[str], attr: str) -> tuple[DataFrame, DataFrame]:
    """Vertices (one per id, smallest attribute kept) and distinct edges of rows.

    Rows with a blank key are dropped, and so are blank references.
    """
    rows = df.where(F.col(key).isNotNull() & (F.trim(F.col(key).cast("string")) != ""))
    edges = (
        rows.select(
            F.col(key).cast("string").alias("src"),
            F.explode(
                F.array(*[F.struct(F.col(r).cast("string").alias("id"), F.lit(r).alias("kind")) for r in refs])
            ).alias("r"),
        )
        .where(F.col("r.id").isNotNull() & (F.trim("r.id") != ""))
        .select("src", F.col("r.id").alias("dst"), F.col("r.kind").alias("kind"))
        .distinct()
    )
    own = rows.select(F.col(key).cast("string").alias("id"), F.lit(key).alias("kind"), F.col(attr).cast("string").alias("attr"))
    ends = edges.select(F.col("dst").alias("id"), "kind", F.lit(None).cast("string").alias("attr"))
    vertices = (
        own.unionByName(ends).groupBy("id").agg(F.min("kind").alias("kind"), F.min("attr").alias("attr"))
    )
    return vertices, edges


def union_sources(*edges: DataFrame) -> DataFrame:
    """Distinct edges of several sources with the same columns."""
    out = edges[0]
    for e in edges[1:]:
        out = out.unionByName(e)
    return out.distinct()


def tagged_links(nodes: DataFrame, rels: DataFrame, types: Sequence[str]) -> DataFrame:
    """Tagged entities and the applications that use them by the listed relations."""
    black = nodes.where(F.col("tagged") == 1).select(F.col("content").alias("tagging_edge"))
    use = rels.where(F.col("rel").isin(*types)).select(
        F.col("content").alias("tagging_edge"), F.col("rel").alias("edge0"), F.col("order_id").alias("apply0")
    )
    return use.join(black, "tagging_edge").select(F.lit(0).alias("degree_type"), "tagging_edge", "edge0", "apply0").distinct()


MOBILE_FAMILY = ("applymymobile", "loanapply", "emergencymobile")  # fixed values


def tagged_one_hop(
    nodes: DataFrame, rels: DataFrame, allowed: Sequence[str], family: Sequence[str] = MOBILE_FAMILY
) -> DataFrame:
    """Tagged entity - application p - shared entity - other application q.

    The last leg uses the same relation as the one before it, except inside
    the phone family, where any member may follow any other. A relationship
    is not walked back, so q differs from p unless another relation leads
    back to it. Rows of an application or entity that very many pass through are spread, and
    nothing travels after the last join, whose rows are by far the most.
    """
    start = tagged_links(nodes, rels, allowed)
    family_of = F.when(F.col("rel").isin(*family), F.lit("phone")).otherwise(F.col("rel"))
    legs = stored(rels.where(F.col("rel").isin(*allowed)).withColumn("family", family_of).select("order_id", "rel", "content", "family").distinct(), "legs")
    second = legs.select(
        F.col("order_id").alias("apply0"), F.col("rel").alias("edge1"), F.col("content").alias("entity1"), "family"
    )
    third = legs.select(
        F.col("content").alias("entity1"), "family", F.col("rel").alias("edge2"), F.col("order_id").alias("apply1")
    )
    first_leg_again = (F.col("tagging_edge") == F.col("entity1")) & (F.col("edge0") == F.col("edge1"))
    first_leg_last = (
        (F.col("apply1") == F.col("apply0"))
        & (F.col("tagging_edge") == F.col("entity1"))
        & (F.col("edge0") == F.col("edge2"))
    )
    same_leg = (F.col("apply1") == F.col("apply0")) & (F.col("edge1") == F.col("edge2"))
    ahead = stored(salted_join(second, start.drop("degree_type"), ["apply0"], F.struct("edge1", "entity1")).where(~first_leg_again), "ahead")
    # all sides are distinct and all their columns are kept, so the rows are as well
    return (
        grid_join(ahead, third, ["entity1", "family"], F.struct("apply0", "tagging_edge", "edge0", "edge1"), F.struct("apply1", "edge2"))
        .where(~same_leg & ~first_leg_last)
        .select(
            F.lit(1).alias("degree_type"), "tagging_edge", "edge0", "apply0", "edge1", "entity1", "edge2", "apply1"
        )
    )

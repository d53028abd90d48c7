"""Risk counters per application from the association detail."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Counter titles.
COUNT_TITLES = ["order_cnt", "id_cnt", "black_cnt", "q_refuse_cnt", "pass_cnt"]
OVERDUE_TITLES = ["overdue0", "overdue3", "overdue30", "overdue0_ls", "overdue3_ls", "overdue30_ls"]
SCOPES = {"self": "_self", "other": "", "all": "_2"}
ALL_COUNTERS = [t + s for s in SCOPES.values() for t in COUNT_TITLES + OVERDUE_TITLES]


def _scope(hop: int, scope: str) -> Column:
    """Rows of one block. A missing ID number is in neither hop-1 scope."""
    earlier = (F.col("degree_type") == hop) & (F.col("apply_time_src") > F.col("apply_time1"))
    if hop == 2:
        return earlier & (F.col("apply_time_src") > F.col("apply_time2"))
    same = F.col("cert_no_src") == F.col("cert_no1")
    return earlier & (same if scope == "self" else ~same)


def _flags(n: int) -> dict[str, Column]:
    passed = F.col(f"type{n}") == "pass"
    now, past = F.col(f"current_due_day{n}"), F.col(f"history_due_day{n}")
    return {
        "order_cnt": F.lit(True),
        "black_cnt": F.col(f"label{n}") == 1,
        "q_refuse_cnt": F.col(f"performance{n}") == "q_refuse",
        "pass_cnt": passed,
        "overdue0": passed & (now <= 0),
        "overdue3": passed & (now > 3),
        "overdue30": passed & (now > 30),
        "overdue0_ls": passed & (past <= 0),
        "overdue3_ls": passed & (past > 3),
        "overdue30_ls": passed & (past > 30),
    }


def _settled(links: DataFrame, via: Sequence[str]) -> DataFrame:
    """Distinct ``links`` without the columns ``via``, in the place of their person.

    Copies go first where the join left them, by ``via``, so a hub's paths do not travel; what is
    left travels once, as the counts by person and by source need no other place.
    """
    local = links.distinct().drop(*via) if via else links
    return local.repartition("order_src", "cert").distinct()


def _via(detail: DataFrame, hop: int) -> list[str]:
    """The columns that the rows of a hop were joined by."""
    return [c for c in (("edge3", "value2") if hop == 2 else ()) if c in detail.columns]


def _packed(flags: Sequence[Column]) -> Column:
    """Flags as bits of one number, a missing flag as 0."""
    bits = [F.when(flag, F.lit(1 << i)).otherwise(F.lit(0)) for i, flag in enumerate(flags)]
    return sum(bits[1:], bits[0])


def _bit(i: int) -> Column:
    return F.shiftright("_flags", i).bitwiseAND(F.lit(1))


def _linked(detail: DataFrame, hop: int, scope: str, titles: Sequence[str]) -> DataFrame:
    """Distinct (source, linked application) rows with 0/1 flags."""
    flags = _flags(hop)
    known = [t for t in titles if t in flags]
    via = _via(detail, hop)
    links = detail.where(_scope(hop, scope)).select(
        "order_src",
        F.col(f"order{hop}").alias("linked"),
        F.col(f"cert_no{hop}").alias("cert"),
        _packed([flags[t] for t in known]).alias("_flags"),
        *via,
    )
    return _settled(links, via).select("order_src", "linked", "cert", *[_bit(i).alias(t) for i, t in enumerate(known)])


def count_block(detail: DataFrame, hop: int, scope: str) -> DataFrame:
    """Distinct linked applications, people, tagged, refused and passed.

    An application has one performance row, so the distinct counts become
    plain sums after one distinct; people are counted by grouping twice
    instead of by a multi-distinct aggregate, which would multiply the rows.
    """
    rows = _linked(detail, hop, scope, COUNT_TITLES)
    sums = [t for t in COUNT_TITLES if t != "id_cnt"]
    per_person = rows.groupBy("order_src", "cert").agg(*[F.sum(t).alias(t) for t in sums])
    return per_person.groupBy("order_src").agg(
        *[(F.count("cert") if t == "id_cnt" else F.sum(t)).alias(t) for t in COUNT_TITLES]
    )


def overdue_block(detail: DataFrame, hop: int, scope: str) -> DataFrame:
    """Passed linked applications by present (plain) and past (``_ls``) days due."""
    rows = _linked(detail, hop, scope, ["pass_cnt", *OVERDUE_TITLES]).where("pass_cnt = 1")
    return rows.groupBy("order_src").agg(*[F.sum(t).alias(t) for t in OVERDUE_TITLES])


def to_long(block: DataFrame, titles: Sequence[str]) -> DataFrame:
    """(order_src, title, cnt) rows of a block, zero counts left out."""
    return (
        block.unpivot(["order_src"], list(titles), "title", "cnt").where(F.col("cnt") > 0)
    )


def pivot_titles(long: DataFrame, titles: Sequence[str]) -> DataFrame:
    """Long counters to one column per title; the title list is fixed, so no extra job."""
    return long.groupBy("order_src").pivot("title", list(titles)).agg(F.sum("cnt")).fillna(0)


def _id(df: DataFrame, c: str) -> Column:
    """The id in its own type; text without blanks around it."""
    return (F.trim(c) if df.schema[c].dataType == T.StringType() else F.col(c)).alias(c)


def merge_features(ids: DataFrame, blocks: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Distinct ids with every block attached (suffix per block), missing counts 0."""
    wide = ids.select(_id(ids, "order_src")).distinct()
    for block, suffix in blocks:
        cols = [c for c in block.columns if c != "order_src"]
        wide = wide.join(block.select("order_src", *[F.col(c).alias(c + suffix) for c in cols]), "order_src", "left")
    return wide.fillna(0)


def all_blocks(detail: DataFrame) -> list[tuple[DataFrame, str]]:
    out = []
    for hop, scope in ((1, "self"), (1, "other"), (2, "all")):
        out.append((count_block(detail, hop, scope), SCOPES[scope]))
        out.append((overdue_block(detail, hop, scope), SCOPES[scope]))
    return out


def association_features(ids: DataFrame, detail: DataFrame) -> DataFrame:
    """All 33 counters in one pass over the detail.

    Equal to merging the six blocks, but what the detail holds is shuffled once:
    rows are reduced to distinct (source, scope, linked) hop by hop, then per person,
    then per source. The scope travels as the bits above the flags.
    """
    titles = COUNT_TITLES + OVERDUE_TITLES
    flags = [t for t in titles if t != "id_cnt"]
    links = []
    for hop, scopes in ((1, ("self", "other")), (2, ("all",))):
        known, via = _flags(hop), _via(detail, hop)
        scope = F.coalesce(*[F.when(_scope(hop, s), F.lit(list(SCOPES).index(s) << len(flags))) for s in scopes])
        own = detail.where(F.col("degree_type") == hop).select(
            "order_src",
            F.col(f"order{hop}").alias("linked"),
            F.col(f"cert_no{hop}").alias("cert"),
            (scope + _packed([known[t] for t in flags])).alias("_flags"),
            *via,
        )
        links.append(own.where(F.col("_flags").isNotNull()).distinct().drop(*via))
    rows = _settled(links[0].unionByName(links[1]), ())
    rows = rows.select("order_src", F.shiftright("_flags", len(flags)).alias("scope"), "cert", *[_bit(i).alias(t) for i, t in enumerate(flags)])
    per_person = rows.groupBy("order_src", "scope", "cert").agg(*[F.sum(t).alias(t) for t in flags])
    aggs = []
    for at, suffix in enumerate(SCOPES.values()):
        here = F.col("scope") == at
        for t in titles:
            value = F.when(here, F.col("cert").isNotNull().cast("long") if t == "id_cnt" else F.col(t))
            aggs.append(F.sum(value).alias(t + suffix))
    wide = per_person.groupBy("order_src").agg(*aggs)
    return ids.select("order_src").distinct().join(wide, "order_src", "left").fillna(0, ALL_COUNTERS)


def drop_all_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with at least one positive counter."""
    return df.where(F.greatest(*[F.col(c) for c in cols]) > 0)


def edge_signature(types: Sequence[Column], sep: str = "|") -> Column:
    """Edge types of a path joined by a separator, each trimmed."""
    return F.concat_ws(sep, *[F.trim(t.cast("string")) for t in types])


def black_paths(detail: DataFrame) -> DataFrame:
    """(order_src, signature, depth): signature of every path that ends in a tagged application."""
    hop2 = F.col("degree_type") == 2
    one = edge_signature([F.col("edge1"), F.col("edge2")])
    two = edge_signature([F.col("edge1"), F.col("edge2"), F.col("edge3"), F.col("edge4")])
    earlier = F.col("apply_time_src") > F.col("apply_time1")
    black = F.when(hop2, (F.col("label2") == 1) & (F.col("apply_time_src") > F.col("apply_time2"))).otherwise(
        F.col("label1") == 1
    )
    return detail.where(earlier & black).select(
        "order_src", F.when(hop2, two).otherwise(one).alias("signature"), F.col("degree_type").alias("depth")
    )


def path_signatures(detail: DataFrame) -> DataFrame:
    return signatures_of(black_paths(detail))


def signatures_of(paths: DataFrame) -> DataFrame:
    """Sorted distinct signatures per source; there are at most 11**4 of them."""
    return (
        paths.select("order_src", "signature")
        .distinct()  # sets of many sources at once would be sorted, path by path
        .groupBy("order_src")
        .agg(F.array_join(F.sort_array(F.collect_set("signature")), ",").alias("signature"))
    )


def max_depth(paths: DataFrame) -> DataFrame:
    return paths.groupBy("order_src").agg(F.max("depth").alias("depth"))


def edge_woe_stats(edges: DataFrame, woe: DataFrame) -> DataFrame:
    """Sum, largest and smallest weight of evidence over the edges of a source."""
    return (
        edges.join(woe, "edge")
        .groupBy("order_src")
        .agg(
            F.sum("woe").alias("edge_woe_sum"),
            F.max("woe").alias("edge_woe_max"),
            F.min("woe").alias("edge_woe_min"),
        )
    )


def attach_context(wide: DataFrame, sig: DataFrame, times: DataFrame) -> DataFrame:
    """Path signature where there is one, and the application time."""
    return wide.join(sig, "order_src", "left").join(times.select("order_src", "apply_time").distinct(), "order_src")


def final_features(wide: DataFrame, woe: DataFrame, depth: DataFrame) -> DataFrame:
    return wide.join(woe, "order_src", "left").join(depth, "order_src", "left")

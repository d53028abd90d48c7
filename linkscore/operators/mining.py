"""Frequent itemsets, rules, decision and regression splits, clustering."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkscore.ordered import running_sums
from linkscore.runtime import cut
from linkscore.skew import blocked_pairs, salted_join

# --- itemsets ------------------------------------------------------------


def apriori(baskets: DataFrame, min_support: float, max_size: int | None = None) -> DataFrame:
    """(items, size, n, support) of the itemsets held by at least the given share of baskets.

    Sets grow until no longer one is frequent, or to ``max_size`` if given.

    Only frequent items travel; pairs of a large basket are formed in blocks,
    and longer sets grow from the frequent ones, so a set is counted only
    where its shorter prefix is frequent.
    """
    rows = baskets.select("basket", "item").distinct()
    total = rows.select("basket").distinct().count()
    least = min_support * total

    def keep(counted: DataFrame) -> DataFrame:
        return counted.where(F.col("n") >= least)

    one = cut(keep(rows.groupBy(F.array("item").alias("items")).agg(F.count(F.lit(1)).alias("n"))))
    frequent = one.select(F.col("items")[0].alias("item"))
    kept = cut(rows.join(frequent, "item", "left_semi").select("basket", "item"))
    levels = [one]
    held = None
    for size in itertools.count(2):
        if max_size is not None and size > max_size:
            break
        if size == 2:
            grown = blocked_pairs(kept, "basket", "item").select("basket", F.array("item_a", "item_b").alias("items"))
        else:
            grown = salted_join(held, kept, ["basket"], F.col("items")).where(
                F.col("item") > F.element_at("items", -1)
            ).select("basket", F.concat("items", F.array("item")).alias("items"))
        grown = cut(grown)
        sets = cut(keep(grown.groupBy("items").agg(F.count(F.lit(1)).alias("n"))))
        if sets.isEmpty():
            break
        levels.append(sets)
        held = cut(grown.join(sets.select("items"), "items", "left_semi").select("basket", "items"))
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out.select("items", F.size("items").alias("size"), "n", (F.col("n") / total).alias("support"))


def rules(itemsets: DataFrame, min_conf: float) -> DataFrame:
    """(antecedent, consequent, confidence) over all splits of every itemset."""
    n = F.size("items")
    masks = F.explode(F.sequence(F.lit(1).cast("long"), F.expr("shiftleft(1L, size(items)) - 2")))

    def side(bit: int) -> Column:
        return F.transform(
            F.filter(F.arrays_zip("items", F.sequence(F.lit(0), n - 1).alias("i")), lambda z: F.getbit(F.col("mask"), z["i"]) == bit),
            lambda z: z["items"],
        )

    split = itemsets.where(n >= 2).select("items", F.col("n").alias("both"), masks.alias("mask")).select(
        "both", side(1).alias("antecedent"), side(0).alias("consequent")
    )
    base = itemsets.select(F.col("items").alias("antecedent"), F.col("n").alias("alone"))
    out = split.join(base, "antecedent").withColumn("confidence", F.col("both") / F.col("alone"))
    return out.where(F.col("confidence") >= min_conf).select("antecedent", "consequent", "confidence")


def fp_growth(baskets: DataFrame, min_count: int, max_size: int | None = None) -> DataFrame:
    """(items, size, n) of the itemsets held by at least ``min_count`` baskets."""
    from pyspark.ml.fpm import FPGrowth

    lists = baskets.groupBy("basket").agg(F.collect_set("item").alias("items"))
    total = lists.count()
    found = FPGrowth(itemsCol="items", minSupport=(min_count - 0.5) / total).fit(lists).freqItemsets
    out = found.select(F.sort_array("items").alias("items"), F.size("items").alias("size"), F.col("freq").alias("n"))
    return out if max_size is None else out.where(F.col("size") <= max_size)


# --- information gain and decision trees --------------------------------


def _plogp(n: Column, total: Column) -> Column:
    return -(n / total) * F.log2(n / total)


def entropy(df: DataFrame, y: str) -> DataFrame:
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = df.groupBy(y).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.sum(_plogp(F.col("n"), total)).alias("entropy"))


def _gains(rows: DataFrame, cols: Sequence[str], y: str) -> DataFrame:
    """(node, column, gain, size) from one aggregation over all candidate columns."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols]))
    counts = rows.select("node", F.col(y).alias("_y"), pairs.alias("p")).groupBy("node", "p.column", "p.value", "_y").agg(
        F.count(F.lit(1)).alias("n")
    )
    counts = cut(counts)
    per_value = counts.groupBy("node", "column", "value").agg(F.sum("n").alias("nv"))
    inside = counts.join(per_value, ["node", "column", "value"]).groupBy("node", "column").agg(
        F.sum(F.col("n") * -F.log2(F.col("n") / F.col("nv"))).alias("rest"), F.sum("n").alias("size")
    )
    per_class = counts.groupBy("node", "column", "_y").agg(F.sum("n").alias("ny"))
    whole = per_class.join(inside, ["node", "column"]).groupBy("node", "column").agg(
        F.sum(_plogp(F.col("ny"), F.col("size"))).alias("whole"), F.max("rest").alias("rest"), F.max("size").alias("size")
    )
    return whole.select("node", "column", (F.col("whole") - F.col("rest") / F.col("size")).alias("gain"), "size")


def info_gain(df: DataFrame, cols: Sequence[str], y: str) -> DataFrame:
    return _gains(df.withColumn("node", F.lit("")), cols, y).select("column", "gain")


def id3(df: DataFrame, cols: Sequence[str], y: str, depth: int) -> DataFrame:
    """(node, column, prediction, size): tree by information gain, one aggregation per level.

    ``node`` is the path of conditions; inner nodes name their split column,
    leaves have none. Each column is used once per path; the majority (the
    smallest class on a tie) is the prediction.
    """
    rows = cut(df.select(*cols, y).withColumn("node", F.lit("")))
    levels = []
    for level in range(depth + 1):
        classes = rows.groupBy("node", y).agg(F.count(F.lit(1)).alias("n"))
        nodes = classes.groupBy("node").agg(
            F.min(F.struct((-F.col("n")).alias("n"), F.col(y).alias("v"))).alias("b"), F.sum("n").alias("size"), F.count(F.lit(1)).alias("kinds")
        )
        if level < depth:
            usable = _gains(rows, cols, y).where((F.col("gain") > 1e-12) & ~F.col("node").contains(F.concat(F.lit("/"), F.col("column"), F.lit("="))))
            best = usable.groupBy("node").agg(F.min(F.struct((-F.round("gain", 9)).alias("g"), F.col("column"))).alias("w"))
            best = best.select("node", F.col("w.column").alias("column"))
        else:
            best = nodes.select("node", F.lit(None).cast("string").alias("column")).limit(0)
        here = cut(nodes.join(best, "node", "left").select("node", "column", F.col("b.v").alias("prediction"), "size"))
        levels.append(here)
        inner = here.where(F.col("column").isNotNull()).select("node", "column")
        if inner.isEmpty():
            break
        chosen = F.lit(None).cast("string")
        for c in cols:
            chosen = F.when(F.col("column") == c, F.col(c).cast("string")).otherwise(chosen)
        grown = salted_join(rows, inner, ["node"], F.struct(*cols)).withColumn(
            "node", F.concat("node", F.lit("/"), F.col("column"), F.lit("="), F.coalesce(chosen, F.lit("")))
        )
        rows = cut(grown.drop("column"))
    out = levels[0]
    for part in levels[1:]:
        out = out.unionByName(part)
    return out


# --- regression splits ---------------------------------------------------


def regression_splits(df: DataFrame, cols: Sequence[str], y: str, by: Sequence[str] = ()) -> DataFrame:
    """(by…, column, value, n_low, n, gain) of every cut ``x <= value`` of every column.

    The squared errors of all cuts follow from running sums over the distinct
    values, so no column is sorted in one task.
    """
    by = list(by)
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols]))
    v = F.col(y).cast("double")
    counts = df.select(*by, v.alias("_y"), pairs.alias("p")).groupBy(*by, "p.column", "p.value").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_y").alias("_s"), F.sum(F.col("_y") * F.col("_y")).alias("_q")
    )
    keys = [*by, "column"]
    run = running_sums(counts, [F.col("value")], {"n_low": "_n", "s_low": "_s"}, by=keys)
    total = counts.groupBy(*keys).agg(F.sum("_n").alias("n"), F.sum("_s").alias("s"))
    out = run.join(total, keys).where(F.col("n_low") < F.col("n"))
    n_up, s_up = F.col("n") - F.col("n_low"), F.col("s") - F.col("s_low")
    gain = F.col("s_low") * F.col("s_low") / F.col("n_low") + s_up * s_up / n_up - F.col("s") * F.col("s") / F.col("n")
    return out.select(*keys, "value", "n_low", "n", gain.alias("gain"))


def regression_split(df: DataFrame, cols: Sequence[str], y: str, min_gain: float = 1.0, min_rows: int = 4) -> DataFrame:
    """The cut that lowers the squared error most, if it meets the limits: one row or none."""
    ok = regression_splits(df, cols, y).where(
        (F.col("n_low") >= min_rows) & (F.col("n") - F.col("n_low") >= min_rows) & (F.col("gain") >= min_gain)
    )
    best = ok.agg(F.max(F.struct(F.col("gain"), "column", "value")).alias("b")).where(F.col("b").isNotNull())
    return best.select("b.column", "b.value", "b.gain")


def reg_tree(df: DataFrame, cols: Sequence[str], y: str, depth: int, min_gain: float = 1.0, min_rows: int = 4) -> DataFrame:
    """(node, column, value, n, mean): regression tree grown level by level.

    Children of a node are ``node + "L"`` (x <= value) and ``node + "R"``.
    """
    rows = cut(df.select(*cols, y).withColumn("node", F.lit("")))
    levels = []
    for level in range(depth + 1):
        means = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.avg(y).alias("mean"))
        if level < depth:
            ok = regression_splits(rows, cols, y, by=["node"]).where(
                (F.col("n_low") >= min_rows) & (F.col("n") - F.col("n_low") >= min_rows) & (F.col("gain") >= min_gain)
            )
            best = ok.groupBy("node").agg(F.max(F.struct("gain", "column", "value")).alias("b")).select("node", "b.column", "b.value")
            here = cut(means.join(best, "node", "left"))
        else:
            here = cut(means.select("*", F.lit(None).cast("string").alias("column"), F.lit(None).cast("double").alias("value")))
        levels.append(here.select("node", "column", "value", "n", "mean"))
        inner = here.where(F.col("column").isNotNull()).select("node", "column", "value")
        if inner.isEmpty():
            break
        x = F.lit(None).cast("double")
        for c in cols:
            x = F.when(F.col("column") == c, F.col(c).cast("double")).otherwise(x)
        side = F.when(x <= F.col("value"), F.lit("L")).otherwise(F.lit("R"))
        rows = cut(salted_join(rows, inner, ["node"], F.struct(*cols, y)).select(*cols, y, F.concat("node", side).alias("node")))
    out = levels[0]
    for part in levels[1:]:
        out = out.unionByName(part)
    return out


def predict_tree(df: DataFrame, nodes: Sequence, cols: Sequence[str]) -> Column:
    """Prediction of a regression tree's rows (a tree has at most 2**depth of them)."""
    tree = {r["node"]: r for r in nodes}

    def walk(node: str) -> Column:
        r = tree[node]
        if r["column"] is None or node + "L" not in tree:
            return F.lit(r["mean"])
        return F.when(F.col(r["column"]) <= r["value"], walk(node + "L")).otherwise(walk(node + "R"))

    return walk("")


def model_tree(df: DataFrame, cols: Sequence[str], y: str, depth: int, min_gain: float = 1.0, min_rows: int = 4) -> list[dict]:
    """Tree with a linear model in every leaf: rows ``node, column, value, n, coef``.

    ``coef`` is the intercept followed by one weight per column. A cut is chosen
    by the squared error that two linear models leave; the errors of all cuts
    follow from running sums of products over the distinct values, so no column
    is sorted in one task. The driver holds one row per node.
    """
    means = df.agg(*[F.avg(c).alias(c) for c in [*cols, y]]).first()
    z = [F.lit(1.0), *[F.col(c).cast("double") - means[c] for c in cols]]
    t = F.col(y).cast("double") - means[y]
    width = len(z)
    sums = {f"g{i}_{j}": F.sum(z[i] * z[j]) for i in range(width) for j in range(i, width)}
    sums |= {f"t{i}": F.sum(z[i] * t) for i in range(width)} | {"yy": F.sum(t * t)}

    n_sums = len(sums)

    @F.pandas_udf("double")
    def left_over(m: pd.Series) -> pd.Series:
        """Squared error of the best linear model with the given sums of products."""
        rows = np.stack(m.to_numpy()) if len(m) else np.zeros((0, n_sums))
        g = np.zeros((len(rows), width, width))
        at = 0
        for i in range(width):
            for j in range(i, width):
                g[:, i, j] = g[:, j, i] = rows[:, at]
                at += 1
        right = rows[:, at : at + width]
        w = np.einsum("nij,nj->ni", np.linalg.pinv(g, rcond=1e-10, hermitian=True), right)
        return pd.Series(np.maximum(rows[:, -1] - (w * right).sum(1), 0.0))

    def packed(prefix: str) -> Column:
        return F.array(*[F.col(prefix + s) for s in sums])

    rows = cut(df.select(*cols, y).withColumn("node", F.lit("")))
    tree: list[dict] = []
    for level in range(depth + 1):
        whole = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"), *[e.alias(f"a_{s}") for s, e in sums.items()])
        here = {r["node"]: r for r in whole.collect()}
        best = {}
        if level < depth:
            pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols]))
            counts = rows.select("*", pairs.alias("p")).groupBy("node", "p.column", "p.value").agg(
                F.count(F.lit(1)).alias("k"), *[e.alias(s) for s, e in sums.items()]
            )
            run = running_sums(counts, [F.col("value")], {"n_low": "k", **{f"l_{s}": s for s in sums}}, by=["node", "column"])
            run = run.join(whole, "node").withColumns({f"u_{s}": F.col(f"a_{s}") - F.col(f"l_{s}") for s in sums})
            run = run.where((F.col("n_low") >= min_rows) & (F.col("n") - F.col("n_low") >= min_rows))
            gain = left_over(packed("a_")) - left_over(packed("l_")) - left_over(packed("u_"))
            cuts = run.select("node", "column", "value", F.round(gain, 6).alias("gain")).where(F.col("gain") >= min_gain)
            found = cuts.groupBy("node").agg(F.max(F.struct("gain", "column", "value")).alias("b")).collect()
            best = {r["node"]: (r["b"]["column"], r["b"]["value"]) for r in found}
        for node, r in here.items():
            g = np.zeros((width, width))
            for i in range(width):
                for j in range(i, width):
                    g[i, j] = g[j, i] = r[f"a_g{i}_{j}"]
            w = np.linalg.pinv(g, rcond=1e-10, hermitian=True) @ np.array([r[f"a_t{i}"] for i in range(width)])
            start = means[y] + w[0] - sum(wi * means[c] for wi, c in zip(w[1:], cols))
            column, value = best.get(node, (None, None))
            tree.append({"node": node, "column": column, "value": value, "n": r["n"], "coef": [float(start), *map(float, w[1:])]})
        if not best:
            break
        side = F.lit(None).cast("string")
        for node, (column, value) in best.items():
            side = F.when(F.col("node") == node, F.when(F.col(column) <= value, "L").otherwise("R")).otherwise(side)
        rows = cut(rows.where(F.col("node").isin(list(best))).withColumn("node", F.concat("node", side)))
    return sorted(tree, key=lambda r: r["node"])


def predict_model_tree(nodes: Sequence[dict], cols: Sequence[str]) -> Column:
    """Prediction of the leaf's linear model."""
    tree = {r["node"]: r for r in nodes}

    def walk(node: str) -> Column:
        r = tree[node]
        if r["column"] is None:
            line = F.lit(r["coef"][0])
            for c, w in zip(cols, r["coef"][1:]):
                line = line + F.col(c) * F.lit(w)
            return line
        return F.when(F.col(r["column"]) <= r["value"], walk(node + "L")).otherwise(walk(node + "R"))

    return walk("")


def prune(nodes: Sequence, test: DataFrame, cols: Sequence[str], y: str) -> list:
    """Merge sibling leaves wherever the merged leaf does no worse on the test rows.

    One scan of the test table gives the sums every node needs.
    """
    tree = {r["node"]: r for r in nodes}
    names = sorted(tree)

    def reach(node: str) -> Column:
        cond = F.lit(True)
        for i, side in enumerate(node):
            r = tree[node[:i]]
            below = F.col(r["column"]) <= r["value"]
            cond = cond & (below if side == "L" else ~below)
        return cond

    v = F.col(y).cast("double")
    aggs = []
    for i, node in enumerate(names):
        here = reach(node)
        aggs += [F.sum(F.when(here, 1.0)).alias(f"n{i}"), F.sum(F.when(here, v)).alias(f"s{i}"), F.sum(F.when(here, v * v)).alias(f"q{i}")]
    row = test.agg(*aggs).first()
    sums = {node: (row[f"n{i}"] or 0.0, row[f"s{i}"] or 0.0, row[f"q{i}"] or 0.0) for i, node in enumerate(names)}

    def error(node: str, mean: float) -> float:
        n, s, q = sums[node]
        return q - 2 * mean * s + n * mean * mean

    kept = dict(tree)
    for node in sorted(tree, key=len, reverse=True):
        left, right = node + "L", node + "R"
        if left in kept and right in kept and left + "L" not in kept and right + "L" not in kept:
            merged = (kept[left]["mean"] + kept[right]["mean"]) / 2
            if error(node, merged) < error(left, kept[left]["mean"]) + error(right, kept[right]["mean"]):
                del kept[left], kept[right]
                kept[node] = {"node": node, "column": None, "value": None, "n": tree[node]["n"], "mean": merged}
    return [kept[n] for n in sorted(kept)]


# --- clusters ------------------------------------------------------------

Distance = Callable[[Sequence[Column], Sequence[Column]], Column]


def euclid(a: Sequence[Column], b: Sequence[Column]) -> Column:
    total = F.lit(0.0)
    for x, y in zip(a, b):
        total = total + (x - y) * (x - y)
    return F.sqrt(total)


def great_circle(a: Sequence[Column], b: Sequence[Column]) -> Column:
    from linkscore.functions.clean import geo_km

    return geo_km(a[0], a[1], b[0], b[1])


def assign(df: DataFrame, cols: Sequence[str], centres: Sequence[Sequence[float]], dist: Distance = euclid) -> DataFrame:
    """Nearest centre (``cluster``) and distance (``far``); the k centres are plain expressions."""
    here = [F.col(c).cast("double") for c in cols]
    offers = [
        F.struct(dist(here, [F.lit(float(v)) for v in centre]).alias("d"), F.lit(i).alias("i")) for i, centre in enumerate(centres)
    ]
    best = F.least(*offers) if len(offers) > 1 else offers[0]
    return df.withColumn("_b", best).withColumn("cluster", F.col("_b.i")).withColumn("far", F.col("_b.d")).drop("_b")


def lloyd(df: DataFrame, cols: Sequence[str], centres: Sequence[Sequence[float]], rounds: int | None = None, dist: Distance = euclid):
    """k-means from the given centres until no row changes its cluster, or for ``rounds``; only k rows per round reach the driver.

    With a distance whose best centre is not the mean, rounds may lead back to
    centres they have had; as that would never end, it ends there.
    """
    centres = [list(map(float, c)) for c in centres]
    before, had = None, set()
    while (rounds is None or len(had) < rounds) and tuple(map(tuple, centres)) not in had:
        had.add(tuple(map(tuple, centres)))
        placed = assign(df.select(*cols), cols, centres, dist).withColumnRenamed("cluster", "_now").drop("far")
        moved = F.lit(True)
        if before is not None:
            placed = assign(placed, cols, before, dist)
            moved = F.col("_now") != F.col("cluster")
        means = placed.groupBy("_now").agg(*[F.avg(c).alias(c) for c in cols], F.max(moved).alias("_moved")).collect()
        before, centres = centres, list(centres)
        for r in means:
            centres[r["_now"]] = [r[c] for c in cols]
        if not any(r["_moved"] for r in means):
            break
    return centres


def bisecting(df: DataFrame, cols: Sequence[str], k: int, rounds: int | None = None, dist: Distance = euclid) -> list[list[float]]:
    """Centres by repeated halving: always the split that leaves the least total squared error."""
    return bisect_clusters(df, cols, k, rounds, dist)[0]


def bisect_clusters(
    df: DataFrame, cols: Sequence[str], k: int, rounds: int | None = None, dist: Distance = euclid
) -> tuple[list[list[float]], DataFrame]:
    """Centres, and the rows with their ``cluster``.

    Each split is carried on until no row changes its half, or for ``rounds``. A row stays in the half it was put in. The best split of a cluster is found
    once and remembered, so a step looks only at the two clusters that are new.
    """
    rows = cut(df.withColumn("cluster", F.lit(0)))

    def described(cluster: int):
        """Mean, squared error around it, and the best split: centres and the error they leave."""
        part = rows.where(F.col("cluster") == cluster).select(*cols)
        one = part.agg(
            *[F.avg(c).alias(f"m_{c}") for c in cols], *[f(c).alias(f"{n}_{c}") for c in cols for n, f in (("lo", F.min), ("hi", F.max))]
        ).first()
        mean = [one[f"m_{c}"] for c in cols]
        pair = lloyd(part, cols, [[one[f"{n}_{c}"] for c in cols] for n in ("lo", "hi")], rounds, dist)

        def error(centres) -> float:
            return assign(part, cols, centres, dist).agg(F.sum(F.col("far") * F.col("far"))).first()[0] or 0.0

        return mean, error([mean]), pair, error(pair)

    known = {0: described(0)}
    while len(known) < k:
        # the split that saves most leaves least in total; the first cluster wins a tie
        chosen = max(sorted(known), key=lambda c: known[c][1] - known[c][3])
        pair, new = known[chosen][2], len(known)
        placed = assign(rows.withColumnRenamed("cluster", "_old"), cols, pair, dist)
        moves = (F.col("_old") == chosen) & (F.col("cluster") == 1)
        rows = cut(placed.withColumn("_new", F.when(moves, F.lit(new)).otherwise(F.col("_old"))).drop("_old", "cluster", "far").withColumnRenamed("_new", "cluster"))
        known[chosen], known[new] = described(chosen), described(new)
    return [known[c][0] for c in sorted(known)], rows

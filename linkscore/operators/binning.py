"""Equal-width bins, optimal binning and category reduction for scorecards."""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkscore.ordered import running_sums
from linkscore.runtime import cut

TREE_BINS = 500  # bins that become an expression
BUCKETS = 256  # of borders, where bins are more
METHODS = {1: "gini", 2: "entropy", 3: "chi2", 4: "iv"}


def _bins_of(acc: float) -> int:
    """Whole bins of width ``acc`` in one; 1 / 0.00001 is a little less than 100,000."""
    return int(1.0 / acc + 1e-9)


def equal_width_bins(df: DataFrame, col: str, acc: float = 0.01, adjust: float = 0.0001) -> DataFrame:
    """(bin, lower, upper) of ``1/acc`` equal bins, both ends widened by ``adjust``."""
    m = _bins_of(acc)
    ends = df.agg(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi"))
    step = (F.col("hi") - F.col("lo")) / m
    return ends.select("lo", "hi", F.explode(F.sequence(F.lit(1), F.lit(m))).alias("bin")).select(
        "bin",
        (F.col("lo") + (F.col("bin") - 1) * step - F.when(F.col("bin") == 1, adjust).otherwise(0.0)).alias("lower"),
        (F.col("lo") + F.col("bin") * step + F.when(F.col("bin") == m, adjust).otherwise(0.0)).alias("upper"),
    )


def _steps(bins: Sequence[tuple[int, float, float]]) -> tuple[list[float], list[int], list[int]]:
    """Borders in order, the largest bin at each border and the largest in the open gap after it (0: none)."""
    borders = sorted({v for _, lower, upper in bins if lower <= upper for v in (lower, upper)})
    opening = sorted((lower, -b, upper) for b, lower, upper in bins if lower <= upper)
    at, after = [], []
    reach: list[tuple[int, float]] = []  # bins that have begun, the largest first
    i = 0
    for v in borders:
        while i < len(opening) and opening[i][0] <= v:
            heapq.heappush(reach, opening[i][1:])
            i += 1
        while reach and reach[0][1] < v:
            heapq.heappop(reach)
        at.append(-reach[0][0] if reach else 0)
        while reach and reach[0][1] <= v:  # ends here; what it hid may go on
            heapq.heappop(reach)
        after.append(-reach[0][0] if reach else 0)
    return borders, at, after


def _searched(c: Column, borders: Sequence[float], at: Sequence[int], after: Sequence[int]) -> Column:
    """Binary search written as an expression: as many comparisons a row as the borders have doublings."""
    if not borders:
        return F.lit(0)
    if len(borders) == 1:
        return F.when(c == borders[0], F.lit(at[0])).when(c > borders[0], F.lit(after[0])).otherwise(F.lit(0))
    half = len(borders) // 2
    right = _searched(c, borders[half:], at[half:], after[half:])
    left = _searched(c, borders[:half], at[:half], after[:half])
    return F.when(c >= borders[half], right).otherwise(left)


def _bucket(c: Column, borders: Sequence[float]) -> Column:
    """Number of borders at or below the value."""
    if not borders:
        return F.lit(0)
    half = len(borders) // 2
    return F.when(c >= borders[half], _bucket(c, borders[half + 1 :]) + (half + 1)).otherwise(_bucket(c, borders[:half]))


def _step_table(pdf: pd.DataFrame) -> pd.DataFrame:
    borders, at, after = _steps(list(pdf[["bin", "lower", "upper"]].itertuples(index=False, name=None)))
    return pd.DataFrame({"bucket": [pdf["bucket"].iloc[0]], "borders": [borders], "at": [at], "after": [after]})


def apply_bins(df: DataFrame, col: str, bins: DataFrame, out: str | None = None) -> DataFrame:
    """Bin of each value, closed on both sides: a shared border belongs to the later bin.

    Values outside every bin, and missing ones, get 0; of overlapping bins the one
    with the largest number counts. Few bins become a binary search written as an
    expression. Many are cut into buckets of neighbouring borders: a row meets the
    sorted borders of its bucket alone, one array, and searches there.
    """
    out = out or f"{col}_BIN"
    clean = bins.select(F.col("bin").cast("int").alias("bin"), F.col("lower").cast("double").alias("lower"), F.col("upper").cast("double").alias("upper")).dropna()
    few = clean.limit(TREE_BINS + 1).collect()
    value = F.col(col).cast("double")
    if len(few) <= TREE_BINS:
        return df.withColumn(out, F.coalesce(_searched(value, *_steps([tuple(r) for r in few])), F.lit(0)).cast("int"))
    borders = sorted(set(clean.approxQuantile("lower", [i / BUCKETS for i in range(1, BUCKETS)], 0.2 / BUCKETS)))
    # a bin goes to all buckets that it reaches
    reached = F.explode(F.sequence(_bucket(F.col("lower"), borders), _bucket(F.col("upper"), borders)))
    steps = clean.where("lower <= upper").select("*", reached.alias("bucket")).groupBy("bucket").applyInPandas(
        _step_table, "bucket int, borders array<double>, at array<int>, after array<int>"
    )
    steps = steps.withColumnsRenamed({"bucket": "_bucket", "borders": "_borders", "at": "_at", "after": "_after"})
    laid = df.withColumn("_bucket", _bucket(value, borders))
    halvings = F.sequence(F.lit(1), F.ceil(F.log2(F.size("_borders") + 1)).cast("int"))
    middle = lambda s: F.floor((s["lo"] + s["hi"]) / 2).cast("int")

    def halved(s: Column, _: Column) -> Column:
        below = F.get("_borders", middle(s)) <= value  # the last border at or below lies in [lo, hi)
        fits = s["hi"] - s["lo"] > 1
        return F.struct(F.when(fits & below, middle(s)).otherwise(s["lo"]).alias("lo"), F.when(fits & ~below, middle(s)).otherwise(s["hi"]).alias("hi"))

    start = F.struct(F.lit(0).alias("lo"), F.size("_borders").alias("hi"))
    place = F.aggregate(halvings, start, halved, lambda s: s["lo"])
    first = F.get("_borders", F.lit(0))
    joined = laid.join(steps, "_bucket", "left").withColumn("_place", F.when(value.isNotNull() & F.col("_borders").isNotNull(), place))
    found = F.when(F.get("_borders", F.col("_place")) == value, F.get("_at", F.col("_place"))).when(value > first, F.get("_after", F.col("_place")))
    return joined.withColumn(out, F.coalesce(found, F.lit(0)).cast("int")).select(*[c for c in df.columns if c != out], out)


def bin_counts(df: DataFrame, cols: Sequence[str], y: str, acc: float = 0.01, adjust: float = 0.0001) -> DataFrame:
    """(var, bin, lower, upper, n0, n1, total) of equal-width bins for many columns.

    One scan finds all ranges, a second counts all bins: the columns are
    unpivoted and the bin number is arithmetic, so the shuffle carries at most
    ``1/acc`` rows per column and task.
    """
    m = _bins_of(acc)
    ends = df.agg(*[e.cast("double").alias(f"{c}__{n}") for c in cols for n, e in (("lo", F.min(c)), ("hi", F.max(c)))]).first()
    cols = [c for c in cols if ends[f"{c}__lo"] is not None]  # a column without values has no bins
    spark = df.sparkSession
    if not cols:
        return spark.createDataFrame([], BINS)
    entries = []
    for c in cols:
        lo, hi = ends[f"{c}__lo"], ends[f"{c}__hi"]
        entries.append(
            F.struct(F.lit(c).alias("var"), F.col(c).cast("double").alias("x"), F.lit(lo).alias("lo"), F.lit((hi - lo) / m).alias("step"))
        )
    long = df.select(F.col(y).alias("_y"), F.explode(F.array(*entries)).alias("e")).select("_y", "e.*").where(F.col("x").isNotNull())
    guess = F.least(F.floor(F.try_divide(F.col("x") - F.col("lo"), F.col("step"))), F.lit(m - 1))
    # settle rounding against the very borders the map states
    guess = F.when(F.col("step") == 0, F.lit(m - 1)).otherwise(guess)
    exact = (
        F.when((guess < m - 1) & (F.col("x") >= F.col("lo") + (guess + 1) * F.col("step")), guess + 1)
        .when((guess > 0) & (F.col("x") < F.col("lo") + guess * F.col("step")), guess - 1)
        .otherwise(guess)
    )
    counts = long.groupBy("var", (exact + 1).cast("int").alias("bin")).agg(
        F.sum(1 - F.col("_y")).cast("long").alias("n0"), F.sum("_y").cast("long").alias("n1")
    )
    grid = []
    for c in cols:
        lo, hi = ends[f"{c}__lo"], ends[f"{c}__hi"]
        step = (hi - lo) / m
        for b in range(1, m + 1):
            grid.append((c, b, lo + (b - 1) * step - (adjust if b == 1 else 0.0), lo + b * step + (adjust if b == m else 0.0)))
    bins = spark.createDataFrame(grid, "var string, bin int, lower double, upper double")
    return (
        bins.join(counts, ["var", "bin"], "left")
        .fillna(0, ["n0", "n1"])
        .withColumn("total", F.col("n0") + F.col("n1"))
    )


def _merge_empty(pdf: pd.DataFrame) -> pd.DataFrame:
    """Fold every bin with a zero count into the next one (the last: into the previous)."""
    rows = pdf.sort_values("bin")[["lower", "upper", "n0", "n1"]].to_numpy().tolist()
    i = 0
    while len(rows) > 1 and i < len(rows):
        lower, upper, n0, n1 = rows[i]
        if n0 > 0 and n1 > 0:
            i += 1
            continue
        j = i + 1 if i + 1 < len(rows) else i - 1
        rows[j] = [min(lower, rows[j][0]), max(upper, rows[j][1]), rows[j][2] + n0, rows[j][3] + n1]
        del rows[i]
        i = min(i, j)
    out = pd.DataFrame(rows, columns=["lower", "upper", "n0", "n1"])
    out.insert(0, "bin", np.arange(1, len(out) + 1))
    out.insert(0, "var", pdf["var"].iloc[0])
    out["total"] = out["n0"] + out["n1"]
    return out


BINS = "var string, bin int, lower double, upper double, n0 long, n1 long, total long"


def merge_empty(bins: DataFrame) -> DataFrame:
    """Bins without zero counts; a variable has at most ``1/acc`` rows."""
    return bins.groupBy("var").applyInPandas(_merge_empty, BINS)


def _spread(n0: Column, n1: Column, method: int) -> Column:
    """Impurity (Gini or entropy) of a group with the given class counts; an empty group has none."""
    n = n0 + n1
    if method == 1:
        return F.coalesce(1 - F.try_divide(n0 * n0 + n1 * n1, n * n), F.lit(0.0))

    def term(k: Column) -> Column:
        share = F.try_divide(k, n)
        return F.when(k > 0, -share * F.log2(share)).otherwise(F.lit(0.0))

    return term(n0) + term(n1)


def _part_merit(n0: Column, n1: Column, all0: Column, all1: Column, method: int) -> Column:
    """What one group adds to the merit of a partition.

    An empty group adds nothing. With one class in all there is no merit by
    impurity or chi-square terms of the absent class; information value is
    undefined (NULL) for a group that lacks a class.
    """
    if method in (1, 2):
        whole = (all0 + all1) * _spread(all0, all1, method)
        return F.coalesce(F.try_divide((n0 + n1) * _spread(n0, n1, method), whole), (n0 + n1) / F.greatest(all0 + all1, F.lit(1.0)))
    if method == 3:
        e0 = F.try_divide((n0 + n1) * all0, all0 + all1)
        e1 = F.try_divide((n0 + n1) * all1, all0 + all1)
        return F.coalesce(F.try_divide((n0 - e0) * (n0 - e0), e0), F.lit(0.0)) + F.coalesce(
            F.try_divide((n1 - e1) * (n1 - e1), e1), F.lit(0.0)
        )
    both = (n0 > 0) & (n1 > 0)
    return F.when(both, (n0 / all0 - n1 / all1) * F.log((n0 * all1) / (n1 * all0)))


def split_merit(bins: DataFrame, method: int) -> DataFrame:
    """Merit of every two-way split of ordered bins: (var, cut, merit).

    ``cut`` is the last bin of the lower side. Running sums over the few bins
    of a variable give all cut points at once.
    """
    upto = Window.partitionBy("var").orderBy("bin")
    whole = Window.partitionBy("var")
    b = bins.select("var", "bin", *[F.col(c).cast("double").alias(c) for c in ("n0", "n1")])
    b = b.select(
        "var",
        F.col("bin").alias("cut"),
        F.sum("n0").over(upto).alias("l0"),
        F.sum("n1").over(upto).alias("l1"),
        F.sum("n0").over(whole).alias("a0"),
        F.sum("n1").over(whole).alias("a1"),
        F.max("bin").over(whole).alias("last"),
    ).where(F.col("cut") < F.col("last"))
    a0, a1, l0, l1 = F.col("a0"), F.col("a1"), F.col("l0"), F.col("l1")
    merit = _part_merit(l0, l1, a0, a1, method) + _part_merit(a0 - l0, a1 - l1, a0, a1, method)
    return b.select("var", "cut", (1 - merit if method in (1, 2) else merit).alias("merit"))


def binning_merit(bins: DataFrame, method: int) -> DataFrame:
    """Merit of a complete binning with any number of bins, per variable."""
    whole = Window.partitionBy("var")
    b = bins.select("var", *[F.col(c).cast("double").alias(c) for c in ("n0", "n1")])
    b = b.withColumn("a0", F.sum("n0").over(whole)).withColumn("a1", F.sum("n1").over(whole))
    part = _part_merit(F.col("n0"), F.col("n1"), F.col("a0"), F.col("a1"), method)
    total = F.sum(part)
    return b.groupBy("var").agg((1 - total if method in (1, 2) else total).alias("merit"))


def merit_of(n0: np.ndarray, n1: np.ndarray, method: int) -> float:
    """Merit of a partition given its class counts (the small per-variable search)."""
    n0, n1 = np.asarray(n0, float), np.asarray(n1, float)
    n, a0, a1 = n0 + n1, n0.sum(), n1.sum()
    total = a0 + a1

    def spread(x0, x1):
        p = np.stack([x0, x1]) / (x0 + x1)
        if method == 1:
            return 1 - (p * p).sum(axis=0)
        with np.errstate(divide="ignore", invalid="ignore"):
            return -np.where(p > 0, p * np.log2(np.where(p > 0, p, 1)), 0).sum(axis=0)

    if method in (1, 2):
        whole = spread(np.array([a0]), np.array([a1]))[0]
        return float(1 - (n * spread(n0, n1)).sum() / (total * whole)) if whole > 0 else 0.0
    if method == 3:
        e0, e1 = n * a0 / total, n * a1 / total
        return float(((n0 - e0) ** 2 / e0 + (n1 - e1) ** 2 / e1).sum())
    if (n0 == 0).any() or (n1 == 0).any():
        return float("nan")
    return float(((n0 / a0 - n1 / a1) * np.log((n0 * a1) / (n1 * a0))).sum())


def greedy_groups(n0: np.ndarray, n1: np.ndarray, method: int, mmax: int) -> np.ndarray:
    """Ordered items to at most ``mmax`` consecutive groups, best split first.

    Within a group the cut of highest two-way merit is taken; among the groups
    the cut that gives the whole partition the highest merit wins.
    """
    c0, c1 = np.concatenate([[0], np.cumsum(n0)]), np.concatenate([[0], np.cumsum(n1)])
    borders = [0, len(n0)]
    while len(borders) - 1 < mmax:
        best = None
        for lo, hi in zip(borders, borders[1:]):
            cuts = range(lo + 1, hi)
            scored = [(merit_of(np.diff(c0[[lo, k, hi]]), np.diff(c1[[lo, k, hi]]), method), -k) for k in cuts]
            scored = [s for s in scored if s[0] > 0]
            if not scored:
                continue
            k = -max(scored)[1]
            new = sorted([*borders, k])
            value = merit_of(np.diff(c0[new]), np.diff(c1[new]), method)
            if best is None or value > best[0]:
                best = (value, new)
        if best is None:
            break
        borders = best[1]
    return np.repeat(np.arange(1, len(borders)), np.diff(borders))


def optimal_bins(
    df: DataFrame, cols: Sequence[str], y: str, method: int = 4, mmax: int = 5, acc: float = 0.01
) -> DataFrame:
    """(var, newbin, lower, upper, n0, n1, total): at most ``mmax`` bins per column.

    Spark counts the fine bins of all columns; the search sees at most
    ``1/acc`` rows per variable and runs for the variables in parallel.
    """

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = _merge_empty(pdf)
        pdf["newbin"] = greedy_groups(pdf["n0"].to_numpy(), pdf["n1"].to_numpy(), method, mmax)
        out = pdf.groupby("newbin", as_index=False).agg(
            lower=("lower", "min"), upper=("upper", "max"), n0=("n0", "sum"), n1=("n1", "sum"), total=("total", "sum")
        )
        out.insert(0, "var", pdf["var"].iloc[0])
        return out

    schema = "var string, newbin int, lower double, upper double, n0 long, n1 long, total long"
    return bin_counts(df, cols, y, acc).groupBy("var").applyInPandas(search, schema)


def reduce_categories(df: DataFrame, col: str, y: str, method: int = 4, mmax: int = 5) -> DataFrame:
    """(value, grp, n0, n1): categories in at most ``mmax`` groups by bad rate.

    The search is that of :func:`greedy_groups`, over any number of categories:
    they are ordered by rate across range partitions and get running sums, and
    each step finds the best cut of every group in one aggregation. Only one row
    per group reaches the driver.
    """
    counts = df.groupBy(F.col(col).cast("string").alias("value")).agg(
        F.sum(1 - F.col(y)).cast("long").alias("n0"), F.sum(y).cast("long").alias("n1")
    )
    rated = counts.withColumn("rate", F.col("n1") / (F.col("n0") + F.col("n1")))
    order = [F.col("rate"), F.col("value")]
    run = cut(_numbered(rated, order))
    last = run.agg(F.max("nth"), F.max("c0"), F.max("c1")).first()
    if last[0] is None:
        return counts.withColumn("grp", F.lit(1)).select("value", "grp", "n0", "n1")
    borders = [(0, 0, 0), tuple(last)]  # (categories, n0, n1) up to each border
    while len(borders) - 1 < mmax:
        best = _best_cut(run, borders, method)
        if best is None:
            break
        borders = best
    grp = F.lit(len(borders) - 1)
    for i in range(len(borders) - 2, 0, -1):
        grp = F.when(F.col("nth") <= borders[i][0], F.lit(i)).otherwise(grp)
    return run.select("value", grp.cast("int").alias("grp"), "n0", "n1")


def _numbered(rated: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Categories with their place in the order and running counts."""
    return running_sums(rated.withColumn("_one", F.lit(1).cast("long")), order, {"nth": "_one", "c0": "n0", "c1": "n1"}).drop("_one")


def _best_cut(run: DataFrame, borders: list[tuple[int, int, int]], method: int) -> list[tuple[int, int, int]] | None:
    """The borders with the one cut more that gives the whole partition the highest merit."""
    group = F.lit(len(borders) - 2)
    for i in range(len(borders) - 2, 0, -1):
        group = F.when(F.col("nth") <= borders[i][0], F.lit(i - 1)).otherwise(group)
    ends = F.array(*[F.struct(*[F.lit(float(v)).alias(n) for v, n in zip(b, ("k", "a0", "a1"))]) for b in borders])
    low, high = F.element_at(ends, F.col("g") + 1), F.element_at(ends, F.col("g") + 2)
    left = [F.col(c).cast("double") - low[a] for c, a in (("c0", "a0"), ("c1", "a1"))]
    right = [high[a] - F.col(c).cast("double") for c, a in (("c0", "a0"), ("c1", "a1"))]
    whole = [high[a] - low[a] for a in ("a0", "a1")]
    merit = _part_merit(*left, *whole, method) + _part_merit(*right, *whole, method)
    scored = run.withColumn("g", group).where(F.col("nth") < high["k"]).select(
        "g", "nth", "c0", "c1", (1 - merit if method in (1, 2) else merit).alias("merit")
    )
    found = scored.where("merit > 0").groupBy("g").agg(F.max(F.struct("merit", (-F.col("nth")).alias("k"), "c0", "c1")).alias("b")).collect()
    best = None
    for r in sorted(found, key=lambda r: r["g"]):
        new = sorted([*borders, (-r["b"]["k"], r["b"]["c0"], r["b"]["c1"])])
        value = merit_of(np.diff([b[1] for b in new]), np.diff([b[2] for b in new]), method)
        if best is None or value > best[0]:
            best = (value, new)
    return best and best[1]


def apply_category_map(df: DataFrame, col: str, groups: DataFrame) -> DataFrame:
    """Add ``<col>_BIN``; values outside the map stay NULL."""
    table = groups.select(F.col("value").alias("_v"), F.col("grp").alias(f"{col}_BIN"))
    return df.join(table, F.col(col).cast("string").eqNullSafe(F.col("_v")), "left").drop("_v")


def group_labels(groups: DataFrame) -> DataFrame:
    """Categories of each group as ``a;b;``."""
    return groups.groupBy("grp").agg(
        F.concat(F.array_join(F.sort_array(F.collect_list("value")), ";"), F.lit(";")).alias("categories")
    )

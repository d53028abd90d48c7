"""Table statistics, value counts, pivots, sampling and the two user aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkscore.ordered import number_rows, percentiles
from linkscore.skew import salted_join

# --- user aggregates -----------------------------------------------------


def avg5(c: Column, nulls_as_zero: bool = False) -> Column:
    """Mean rounded to five decimals; missing values skipped or taken as zero."""
    return F.round(F.avg(F.coalesce(c.cast("double"), F.lit(0.0)) if nulls_as_zero else c), 5)


def array_avg(c: Column, n: int) -> Column:
    """Element-wise mean of arrays of declared length ``n``.

    One partial aggregate per position; elements a short array lacks are
    skipped, never shortening the result.
    """
    return F.array(*[F.avg(F.get(c, i).cast("double")) for i in range(n)])


# --- counts --------------------------------------------------------------


def filled_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Non-blank values per column, one row."""
    cols = list(cols or df.columns)
    return df.agg(*[F.count(F.when(F.trim(F.col(c).cast("string")) != "", 1)).alias(c) for c in cols])


def _to_rows(one_row: DataFrame, cols: Sequence[str], fields: dict[str, str]) -> DataFrame:
    """Turn ``<column>__<field>`` columns of one row into one row per column."""
    rows = F.array(
        *[F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}__{f}`").cast(t).alias(f) for f, t in fields.items()]) for c in cols]
    )
    return one_row.select(F.explode(rows).alias("r")).select("r.*")


def missing_table(df: DataFrame) -> DataFrame:
    """(column, total, percent) of the columns with missing values; one scan."""
    cols = df.columns
    one = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"{c}__total") for c in cols],
    )
    for c in cols:
        one = one.withColumn(f"{c}__percent", F.col(f"{c}__total") / F.col("_rows"))
    return _to_rows(one, cols, {"total": "long", "percent": "double"}).where("total > 0")


def drop_missing(df: DataFrame, max_ratio: float = 0.3) -> DataFrame:
    """Without the columns whose missing ratio is ``max_ratio`` or more."""
    bad = {r["column"] for r in missing_table(df).where(F.col("percent") >= max_ratio).collect()}
    return df.select([c for c in df.columns if c not in bad])


def value_counts(df: DataFrame, col: str, dropna: bool = True) -> DataFrame:
    rows = df.where(F.col(col).isNotNull()) if dropna else df
    total = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    return rows.groupBy(col).agg(F.count(F.lit(1)).alias("count")).withColumn("percent", F.col("count") / total)


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Equal-width bins with count and density, plus mean and deviation of the column.

    A constant column has all its rows in the first bin, with no density.
    """
    s = df.agg(
        F.struct(
            F.min(col).alias("lo"), F.max(col).alias("hi"), F.count(col).alias("n"),
            F.avg(col).alias("mean"), F.stddev(col).alias("sd"),
        )
    ).scalar()
    width = (s["hi"] - s["lo"]) / bins
    at = F.least(F.floor(F.coalesce(F.try_divide(F.col(col) - s["lo"], width), F.lit(0.0))), F.lit(bins - 1)).cast("int")
    counts = df.where(F.col(col).isNotNull()).groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    return counts.select(
        "bin",
        (s["lo"] + width * F.col("bin")).alias("lower"),
        "count",
        F.try_divide(F.col("count") / s["n"], width).alias("density"),
        s["mean"].alias("mean"),
        s["sd"].alias("sd"),
    )


def target_rate(df: DataFrame, col: str, y: str) -> DataFrame:
    return df.groupBy(col).agg(F.avg(y).alias("rate"), F.count(F.lit(1)).alias("n"))


def crosstab(df: DataFrame, x: str, y: str, values: Sequence | None = None) -> DataFrame:
    """Counts of ``x`` by ``y``; without ``values`` one extra job lists the values of ``y``."""
    return df.groupBy(x).pivot(y, list(values) if values is not None else None).count().fillna(0)


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(a, b, corr) for every ordered column pair; all pairs share one scan."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]
    one = df.agg(*[F.corr(a, b).alias(f"c{k}") for k, (a, b) in enumerate(pairs)])
    rows = [F.struct(F.lit(a).alias("a"), F.lit(a).alias("b"), F.lit(1.0).alias("corr")) for a in cols]
    for k, (a, b) in enumerate(pairs):
        rows.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{k}").alias("corr")))
        rows.append(F.struct(F.lit(b).alias("a"), F.lit(a).alias("b"), F.col(f"c{k}").alias("corr")))
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def top_corr(df: DataFrame, y: str, k: int, cols: Sequence[str]) -> DataFrame:
    """The ``k`` columns most correlated with ``y``."""
    one = df.agg(*[F.corr(c, y).alias(c) for c in cols])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("corr")) for c in cols])
    return one.select(F.explode(rows).alias("r")).select("r.*").orderBy(F.desc("corr"), "column").limit(k)


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, minimum, exact quartiles and maximum per column."""
    one = df.agg(
        *[
            e.alias(f"{c}__{f}")
            for c in cols
            for f, e in (
                ("count", F.count(c)), ("mean", F.avg(c)), ("sd", F.stddev(c)), ("min", F.min(c)), ("max", F.max(c)),
            )
        ]
    )
    fields = {"count": "long", "mean": "double", "sd": "double", "min": "double", "max": "double"}
    long = df.select([F.col(c).cast("double").alias(c) for c in cols]).unpivot([], list(cols), "column", "value")
    quarts = percentiles(long, "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, by=["column"])
    return _to_rows(one, cols, fields).join(quarts, "column")


def skew_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    one = df.agg(*[F.skewness(c).alias(f"{c}__skew") for c in cols])
    return _to_rows(one, cols, {"skew": "double"})


def merged_mean_var(df: DataFrame, col: str) -> DataFrame:
    """Count, mean and population variance; partial states are merged by the engine."""
    return df.agg(F.count(col).alias("n"), F.avg(col).alias("mean"), F.var_pop(col).alias("variance"))


SPACES = r"[^ \t\r\n\f\x0B]+"


def text_counts(df: DataFrame, text: str) -> DataFrame:
    """Lines, words and characters (one more per line end) over all texts."""
    c = F.col(text)
    return df.agg(
        F.sum(F.length(c) - F.length(F.replace(c, F.lit("\n"), F.lit(""))) + 1).alias("lines"),
        F.sum(F.regexp_count(c, F.lit(SPACES)).cast("long")).alias("words"),
        F.sum(F.length(c).cast("long") + 1).alias("chars"),
    )


# --- rows ----------------------------------------------------------------


def reduce_with_rejects(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Mark the first row per key (by ``order``, unique per key) as kept, others as rejected.

    The first row is an aggregate, and a hot key's rows are spread for the
    comparison, so no key is sorted in one task.
    """
    first = df.groupBy(key).agg(F.min(F.struct(*order)).alias("_first"))
    return (
        salted_join(df, first, [key], F.struct(*order))
        .withColumn("kept", F.struct(*order) == F.col("_first"))
        .drop("_first")
    )


def undersample(df: DataFrame, label: str, key: str, n: int | None = None, seed: int = 11) -> DataFrame:
    """All rows of the minority class and ``n`` (default: as many) of the majority class.

    The draw orders rows by a seeded hash of the key; the cut-off is found by
    a distributed numbering, not by a sort into one task.
    """
    sizes = {r[0]: r[1] for r in df.groupBy(label).count().collect()}
    if len(sizes) != 2:
        raise ValueError(f"column {label!r} must have two classes")
    small, big = sorted(sizes, key=lambda k: (sizes[k], k))
    take = sizes[small] if n is None else n
    draw = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    major = number_rows(df.where(F.col(label) == big).withColumn("_draw", draw), [F.col("_draw"), F.col(key)], "_nth")
    picked = major.where(F.col("_nth") <= take).drop("_draw", "_nth")
    return df.where(F.col(label) == small).unionByName(picked)


def top_k(df: DataFrame, col: str, k: int, tie: str) -> DataFrame:
    return df.orderBy(F.desc(col), tie).limit(k)


def drop_outliers(df: DataFrame, cond: Column) -> DataFrame:
    """Rows for which ``cond`` does not hold (a missing result keeps the row)."""
    return df.where(~F.coalesce(cond, F.lit(False)))

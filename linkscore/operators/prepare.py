"""Filling gaps, encoding and scaling of table columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkscore.ordered import number_rows, percentiles
from linkscore.runtime import stored

MAX_LEVELS = 10_000  # dummy columns or edge lists that may become expressions


# --- filling -------------------------------------------------------------


def fill_const(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.fillna(dict(values))


def _stats(df: DataFrame, cols: Sequence[str], **aggs):
    """All statistics of all columns in one aggregation, as a scalar subquery."""
    fields = [fn(c).alias(f"{c}__{name}") for c in cols for name, fn in aggs.items()]
    return df.agg(F.struct(*fields).alias("s")).scalar()


def fill_mean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missing and NaN values become the column mean."""
    clean = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in cols}
    s = df.agg(F.struct(*[F.avg(e).alias(c) for c, e in clean.items()]).alias("s")).scalar()
    return df.withColumns({c: F.coalesce(clean[c], s[c]) for c in cols})


def _long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select([F.col(c).cast("double").alias(c) for c in cols]).unpivot([], list(cols), "column", "value")


def _quantiles(df: DataFrame, cols: Sequence[str], probs: Mapping[str, float]) -> dict:
    """Exact percentiles of several columns; one row per column reaches the driver."""
    rows = percentiles(_long(df, cols), "value", probs, by=["column"]).collect()
    return {r["column"]: r for r in rows}


def fill_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    q = _quantiles(df, cols, {"m": 0.5})
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(q[c]["m"])) for c in cols if c in q})


def fill_mode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missing values become the most frequent value, the smallest one on a tie; all columns in one scan."""
    one = lambda i, c: F.struct(*[F.when(F.lit(i == j), F.col(o)).alias(f"v{j}") for j, o in enumerate(cols)], F.lit(i).alias("nth"))
    long = df.select(F.explode(F.array(*[one(i, c) for i, c in enumerate(cols)])).alias("e")).select("e.*")
    values = [f"v{j}" for j in range(len(cols))]
    counts = long.where(F.coalesce(*[F.col(v).cast("string") for v in values]).isNotNull()).groupBy("nth", *values).agg(F.count(F.lit(1)).alias("n"))
    best = [F.min(F.when(F.col("nth") == j, F.struct((-F.col("n")).alias("n"), F.col(v).alias("v")))).alias(v) for j, v in enumerate(values)]
    mode = counts.agg(F.struct(*best)).scalar()
    return df.withColumns({c: F.coalesce(F.col(c), mode[v]["v"]) for c, v in zip(cols, values)})


def fill_group_median(df: DataFrame, col: str, by: str) -> DataFrame:
    """Missing values become the median of their group."""
    med = percentiles(df.select(by, F.col(col).cast("double").alias(col)), col, {"_m": 0.5}, by=[by])
    out = df.join(med, by, "left").withColumn(col, F.coalesce(F.col(col).cast("double"), F.col("_m")))
    return out.select(*df.columns)


def fill_when(df: DataFrame, col: str, cond: Column, value: Column) -> DataFrame:
    return df.withColumn(col, F.when(cond, value).otherwise(F.col(col)))


def uniform(key: Column, seed: int) -> Column:
    """Reproducible number in [0, 1) from a seeded hash of a key."""
    text = F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(text, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def fill_random(df: DataFrame, col: str, key: str, seed: int = 11) -> DataFrame:
    """Missing values become a whole number drawn from [mean - sd, mean + sd)."""
    s = df.agg(F.struct(F.avg(col).alias("m"), F.stddev(col).alias("sd"))).scalar()
    lo, hi = F.floor(s["m"] - s["sd"]), F.floor(s["m"] + s["sd"])
    drawn = lo + F.floor(uniform(F.col(key), seed) * (hi - lo))
    return df.withColumn(col, F.coalesce(F.col(col).cast("long"), drawn))


# --- bins ----------------------------------------------------------------


def _right_closed(c: Column, edges: Sequence[float]) -> Column:
    """Index of the bin (e[i-1], e[i]] among the inner edges."""
    expr = None
    for i in range(len(edges) - 1, -1, -1):
        hit = c > F.lit(edges[i])
        expr = F.when(hit, F.lit(i + 1)) if expr is None else expr.when(hit, F.lit(i + 1))
    return F.when(c.isNotNull(), expr.otherwise(F.lit(0)))


def qcut(df: DataFrame, col: str, k: int, out: str = "bin") -> DataFrame:
    """Quantile bins 0..k-1, right-closed, from exact quantiles."""
    q = _quantiles(df, [col], {f"q{i}": i / k for i in range(1, k)})[col]
    return df.withColumn(out, _right_closed(F.col(col), [q[f"q{i}"] for i in range(1, k)]))


def cut(df: DataFrame, col: str, k: int, out: str = "bin") -> DataFrame:
    """Equal-width bins 0..k-1, right-closed."""
    r = df.agg(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi")).first()
    step = (r["hi"] - r["lo"]) / k
    return df.withColumn(out, _right_closed(F.col(col), [r["lo"] + i * step for i in range(1, k)]))


# --- encoding ------------------------------------------------------------


def collapse_rare(df: DataFrame, col: str, min_count: int = 10, other: str = "Misc") -> DataFrame:
    """Values of fewer than ``min_count`` rows become ``other``."""
    rare = df.groupBy(F.col(col).alias("_v")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") < min_count).drop("_n")
    out = df.join(rare, F.col(col) == F.col("_v"), "left")
    return out.withColumn(col, F.when(F.col("_v").isNotNull(), F.lit(other)).otherwise(F.col(col))).drop("_v")


def _encode(df: DataFrame, col: str, order: Sequence[Column], out: str) -> DataFrame:
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    codes = number_rows(counts, order, "_code").select("_v", (F.col("_code") - 1).alias(out))
    return df.join(codes, F.col(col) == F.col("_v"), "left").drop("_v")


def label_encode(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """0-based code in the sorted order of the distinct values."""
    return _encode(df, col, [F.col("_v")], out or f"{col}_code")


def string_index(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """0-based code by falling frequency, ties alphabetical, for several columns; their values are counted in one scan."""
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("nth"), F.col(c).cast("string").alias("value")) for i, c in enumerate(cols)]))
    counts = df.select(pairs.alias("p")).where("p.value IS NOT NULL").groupBy("p.nth", "p.value").agg(F.count(F.lit(1)).alias("n"))
    codes = number_rows(counts, [F.col("nth"), F.col("n").desc(), F.col("value")], "code")
    first = codes.groupBy("nth").agg(F.min("code").alias("first"))  # a row per column
    codes = stored(codes.join(first, "nth").select("nth", "value", (F.col("code") - F.col("first")).alias("code")), "codes")
    out = df
    for i, c in enumerate(cols):
        own = codes.where(F.col("nth") == i).select(F.col("value").alias("_v"), F.col("code").alias(f"{c}_index"))
        out = out.join(own, F.col(c).cast("string") == F.col("_v"), "left").drop("_v")
    return out


def one_hot(df: DataFrame, index: str, size: int, out: str = "onehot") -> DataFrame:
    """Dense 0/1 array of an index; the last level is the all-zero one."""
    return df.withColumn(out, F.transform(F.sequence(F.lit(0), F.lit(size - 2)), lambda i: (i == F.col(index)).cast("double")))


def dummies(df: DataFrame, cols: Sequence[str], drop: Mapping[str, str] | None = None) -> DataFrame:
    """0/1 column ``<col>_<value>`` per value; optionally without a base level.

    For values that are too many to be columns, see :func:`dummy_vectors`.
    """
    out = {}
    for c in cols:
        values = [r[0] for r in df.select(c).where(F.col(c).isNotNull()).distinct().limit(MAX_LEVELS + 1).collect()]
        if len(values) > MAX_LEVELS:
            raise ValueError(f"column {c!r} has more than {MAX_LEVELS} values: use dummy_vectors")
        for v in sorted(values):
            if (drop or {}).get(c) != v:
                out[f"{c}_{v}"] = F.coalesce((F.col(c) == v).cast("int"), F.lit(0))
    return df.select("*", *[e.alias(n) for n, e in out.items()]).drop(*cols)


def dummy_codes(df: DataFrame, cols: Sequence[str], drop: Mapping[str, str] | None = None) -> DataFrame:
    """(column, value, code): 0-based places of all values, column by column and by value; base levels have none."""
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("nth"), F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for i, c in enumerate(cols)]))
    levels = df.select(pairs.alias("p")).select("p.*").where("value IS NOT NULL").distinct()
    for c, base in (drop or {}).items():
        levels = levels.where((F.col("column") != c) | (F.col("value") != base))
    return number_rows(levels, [F.col("nth"), F.col("value")], "code").select("column", "value", (F.col("code") - 1).alias("code"))


def dummy_vectors(df: DataFrame, cols: Sequence[str], drop: Mapping[str, str] | None = None, out: str = "dummies") -> tuple[DataFrame, DataFrame]:
    """Add ``out``, a sparse vector ``(size, indices, values)`` of 0/1, in place of ``cols``; and the code table.

    Levels are rows of the code table and never columns, so there may be any number
    of them. A missing value or a base level has no place. Each column is joined to
    its codes, which the adaptive planner broadcasts or splits by size.
    """
    codes = stored(dummy_codes(df, cols, drop), "codes")
    size = codes.count()
    coded = df
    for i, c in enumerate(cols):
        own = codes.where(F.col("column") == c).select(F.col("value").alias("_value"), F.col("code").cast("int").alias(f"_code{i}"))
        coded = coded.join(own, F.col(c).cast("string") == F.col("_value"), "left").drop("_value")
    indices = F.array_compact(F.array(*[f"_code{i}" for i in range(len(cols))]))  # ascending, as columns come in order
    vector = F.struct(F.lit(size).cast("int").alias("size"), indices.alias("indices"), F.transform(indices, lambda _: F.lit(1.0)).alias("values"))
    return coded.withColumn(out, vector).select(*[c for c in df.columns if c not in cols], out), codes


# --- scaling -------------------------------------------------------------


def _scaled(c: str, centre: Column | float, spread: Column | float) -> Column:
    """Distance from the centre in units of the spread; a constant column becomes 0."""
    return F.when(F.col(c).isNotNull(), F.coalesce(F.try_divide(F.col(c) - F.lit(centre), F.lit(spread)), F.lit(0.0)))


def min_max(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Columns scaled to 0..1; a constant column becomes 0."""
    s = _stats(df, cols, lo=F.min, hi=F.max)
    return df.withColumns({c: _scaled(c, s[f"{c}__lo"], s[f"{c}__hi"] - s[f"{c}__lo"]) for c in cols})


def standardize(df: DataFrame, cols: Sequence[str], by: str = "sd") -> DataFrame:
    """Centred columns divided by the population deviation, or by the variance; constant columns become 0."""
    s = _stats(df, cols, m=F.avg, d=F.stddev_pop if by == "sd" else F.var_pop)
    return df.withColumns({c: _scaled(c, s[f"{c}__m"], s[f"{c}__d"]) for c in cols})


def unskew(df: DataFrame, cols: Sequence[str], lam: float | None = None) -> DataFrame:
    """``log1p``, or Box-Cox of ``1 + x`` for a given exponent."""
    if lam is None:
        return df.withColumns({c: F.log1p(c) for c in cols})
    return df.withColumns({c: (F.pow(1 + F.col(c), lam) - 1) / lam for c in cols})


def robust_scale(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Centred at the median, divided by the distance of the quartiles (0 where that is 0)."""
    q = _quantiles(df, cols, {"a": 0.25, "m": 0.5, "b": 0.75})
    return df.withColumns({c: _scaled(c, q[c]["m"], q[c]["b"] - q[c]["a"]) for c in cols})


# --- vectors -------------------------------------------------------------


def binarize(df: DataFrame, col: str, threshold: float = 0.5, out: str = "binary") -> DataFrame:
    return df.withColumn(out, F.when(F.col(col).isNotNull(), (F.col(col) > threshold).cast("double")))


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    filled = df.withColumns({f"_f{i}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for i, c in enumerate(cols)})
    names = [f"_f{i}" for i in range(len(cols))]
    return VectorAssembler(inputCols=names, outputCol=out).transform(filled).drop(*names)


def poly_expand(df: DataFrame, col: str, degree: int = 3, out: str = "poly") -> DataFrame:
    from pyspark.ml.feature import PolynomialExpansion

    return PolynomialExpansion(degree=degree, inputCol=col, outputCol=out).transform(df)


def pca(df: DataFrame, col: str, k: int = 3, out: str = "pca") -> DataFrame:
    """Projections on the first ``k`` directions; the largest entry of a direction is positive, so that runs agree on its sign."""
    from pyspark.ml.feature import PCA, ElementwiseProduct
    from pyspark.ml.linalg import Vectors

    model = PCA(k=k, inputCol=col, outputCol="_turned").fit(df)
    signs = [1.0 if max(d, key=abs) > 0 else -1.0 for d in model.pc.toArray().T]
    fixed = ElementwiseProduct(scalingVec=Vectors.dense(signs), inputCol="_turned", outputCol=out)
    return fixed.transform(model.transform(df)).drop("_turned")


NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def to_features(df: DataFrame, skip: int, out: str = "features") -> DataFrame:
    """Array of all columns after the first ``skip``; missing or non-numeric is 0.0."""
    types = dict(df.dtypes)
    values = [
        F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        if types[c] in NUMERIC or types[c].startswith("decimal")
        else F.lit(0.0)
        for c in df.columns[skip:]
    ]
    return df.select(*df.columns[:skip], F.array(*values).alias(out))


# --- two tables ----------------------------------------------------------


def align_columns(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables cut to their common columns, in the order of the first."""
    common = [c for c in a.columns if c in set(b.columns)]
    return a.select(*common), b.select(*common)


def with_source(train: DataFrame, test: DataFrame, flag: str = "source") -> DataFrame:
    """Both tables under one roof with a source column; columns of one only are NULL."""
    return train.withColumn(flag, F.lit("train")).unionByName(test.withColumn(flag, F.lit("test")), allowMissingColumns=True)

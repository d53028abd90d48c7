"""Queries of the preparation family."""

from __future__ import annotations

from pyspark.sql import functions as F

from linkscore.catalog.aggregates import rounded
from linkscore.catalog.registry import query, sql
from linkscore.operators import prepare as I


@query("i01_fill_const", sql(["gaps"], {}, "SELECT id, coalesce(price, 0.0) AS price, coalesce(size, 0) AS size, coalesce(brand, 'None') AS brand, type, name FROM gaps"))
def _(t):
    return I.fill_const(t("gaps"), {"price": 0.0, "size": 0, "brand": "None"})


@query(
    "i02_fill_mean",
    sql(["gaps"], {}, "SELECT id, round(coalesce(price, (SELECT avg(price) FROM gaps)), 6) AS price, round(coalesce(CAST(size AS DOUBLE), (SELECT avg(size) FROM gaps)), 6) AS size FROM gaps"),
)
def _(t):
    return rounded(I.fill_mean(t("gaps").select("id", "price", "size"), ["price", "size"]), 6, "price", "size")


@query(
    "i03_fill_median",
    sql(["gaps"], {}, "SELECT id, round(coalesce(price, (SELECT quantile_cont(price, 0.5) FROM gaps)), 6) AS price, round(coalesce(CAST(size AS DOUBLE), (SELECT quantile_cont(size, 0.5) FROM gaps)), 6) AS size FROM gaps"),
)
def _(t):
    return rounded(I.fill_median(t("gaps").select("id", "price", "size"), ["price", "size"]), 6, "price", "size")


MODE = "(SELECT {0} FROM gaps WHERE {0} IS NOT NULL GROUP BY {0} ORDER BY count(*) DESC, {0} LIMIT 1)"


@query("i04_fill_mode", sql(["gaps"], {}, f"SELECT id, coalesce(brand, {MODE.format('brand')}) AS brand, coalesce(size, {MODE.format('size')}) AS size FROM gaps"))
def _(t):
    return I.fill_mode(t("gaps").select("id", "brand", "size"), ["brand", "size"])


@query(
    "i05_fill_group_median",
    sql(["gaps"], {"m": "SELECT type, quantile_cont(price, 0.5) AS med FROM gaps GROUP BY type"},
        "SELECT id, type, round(coalesce(price, med), 6) AS price FROM gaps JOIN m USING (type)"),
)
def _(t):
    return rounded(I.fill_group_median(t("gaps").select("id", "type", "price"), "price", "type"), 6, "price")


@query("i06_fill_when", sql(["gaps"], {}, "SELECT id, CASE WHEN price IS NULL AND type = 'ECONOMY' THEN 900.0 + size ELSE price END AS price FROM gaps"))
def _(t):
    cond = F.col("price").isNull() & (F.col("type") == "ECONOMY")
    return I.fill_when(t("gaps"), "price", cond, F.lit(900.0) + F.col("size")).select("id", "price")


@query(
    "i07_fill_random",
    sql(["gaps"], {"s": "SELECT floor(avg(size) - stddev_samp(size)) AS lo, floor(avg(size) + stddev_samp(size)) AS hi FROM gaps"},
        "SELECT id, CAST(coalesce(size, lo + floor(CAST(CAST('0x' || substr(md5(concat(CAST(id AS STRING), '|11')), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 * (hi - lo))) AS BIGINT) AS size FROM gaps, s"),
)
def _(t):
    return I.fill_random(t("gaps").select("id", "size"), "size", "id")


@query(
    "i08_qcut",
    sql(["gaps"], {"q": "SELECT quantile_cont(price, 0.25) AS a, quantile_cont(price, 0.5) AS b, quantile_cont(price, 0.75) AS c FROM gaps"},
        "SELECT id, CASE WHEN price IS NULL THEN NULL WHEN price > c THEN 3 WHEN price > b THEN 2 WHEN price > a THEN 1 ELSE 0 END AS bin FROM gaps, q"),
)
def _(t):
    return I.qcut(t("gaps"), "price", 4).select("id", "bin")


@query(
    "i08_cut",
    sql(["gaps"], {"q": "SELECT min(price) AS lo, (max(price) - min(price)) / 5 AS w FROM gaps"},
        "SELECT id, CASE WHEN price IS NULL THEN NULL WHEN price > lo + 4 * w THEN 4 WHEN price > lo + 3 * w THEN 3 WHEN price > lo + 2 * w THEN 2 WHEN price > lo + w THEN 1 ELSE 0 END AS bin FROM gaps, q"),
)
def _(t):
    return I.cut(t("gaps"), "price", 5).select("id", "bin")


@query(
    "i09_collapse_rare",
    sql(["gaps"], {"c": "SELECT name, count(*) AS n FROM gaps GROUP BY name"}, "SELECT id, CASE WHEN n < 80 THEN 'Misc' ELSE name END AS name FROM gaps JOIN c USING (name)"),
)
def _(t):
    return I.collapse_rare(t("gaps"), "name", 80).select("id", "name")


@query("i10_label_encode", sql(["gaps"], {}, "SELECT id, CASE WHEN brand IS NULL THEN NULL ELSE dense_rank() OVER (ORDER BY brand NULLS LAST) - 1 END AS brand_code FROM gaps"))
def _(t):
    return I.label_encode(t("gaps"), "brand").select("id", "brand_code")


@query(
    "i11_string_index",
    sql(["credit"], {c: f"SELECT {c}, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS {c}_index FROM credit GROUP BY {c}" for c in ("priority", "segment", "nation")},
        "SELECT id, priority_index, segment_index, nation_index FROM credit JOIN priority USING (priority) JOIN segment USING (segment) JOIN nation USING (nation)")
    .replace("priority AS (", "xp AS (").replace("segment AS (", "xs AS (").replace("nation AS (", "xn AS (")
    .replace("JOIN priority", "JOIN xp").replace("JOIN segment", "JOIN xs").replace("JOIN nation", "JOIN xn"),
)
def _(t):
    return I.string_index(t("credit"), ["priority", "segment", "nation"]).select("id", "priority_index", "segment_index", "nation_index")


@query(
    "i12_one_hot",
    sql(["gaps"], {"c": "SELECT type, row_number() OVER (ORDER BY count(*) DESC, type) - 1 AS i, count(*) OVER () AS k FROM gaps GROUP BY type"},
        "SELECT id, array_to_string([CASE WHEN x = i THEN 1 ELSE 0 END FOR x IN range(0, k - 1)], '') AS onehot FROM gaps JOIN c USING (type)"),
)
def _(t):
    indexed = I.string_index(t("gaps"), ["type"])
    levels = t("gaps").select("type").distinct().count()
    hot = I.one_hot(indexed, "type_index", levels)
    return hot.select("id", F.array_join(F.transform("onehot", lambda x: x.cast("int").cast("string")), "").alias("onehot"))


TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query(
    "i13_dummies",
    "SELECT c_custkey, " + ", ".join(f"CASE WHEN c_mktsegment = '{v}' THEN 1 ELSE 0 END AS \"c_mktsegment_{v}\"" for v in ("AUTOMOBILE", "FURNITURE", "HOUSEHOLD", "MACHINERY")) + " FROM customer",
)
def _(t):
    return I.dummies(t("customer").select("c_custkey", "c_mktsegment"), ["c_mktsegment"], drop={"c_mktsegment": "BUILDING"})


@query(
    "i13_dummy_vectors",
    """WITH l AS (SELECT DISTINCT 0 AS nth, brand AS value FROM (SELECT p_brand AS brand FROM part) UNION SELECT DISTINCT 1, p_type FROM part WHERE p_type <> 'LARGE'),
    c AS (SELECT nth, value, row_number() OVER (ORDER BY nth, value) - 1 AS code FROM l)
    SELECT p_partkey, CAST((SELECT count(*) FROM c) AS INT) AS size, concat_ws(',', CAST(a.code AS STRING), CAST(b.code AS STRING)) AS indices
    FROM part LEFT JOIN c a ON a.nth = 0 AND a.value = p_brand LEFT JOIN c b ON b.nth = 1 AND b.value = p_type""",
)
def _(t):
    out, _codes = I.dummy_vectors(t("part").select("p_partkey", "p_brand", "p_type"), ["p_brand", "p_type"], drop={"p_type": "LARGE"})
    return out.select("p_partkey", "dummies.size", F.array_join(F.transform("dummies.indices", lambda i: i.cast("string")), ",").alias("indices"))


@query(
    "i14_min_max",
    "SELECT o_orderkey, round((o_totalprice - (SELECT min(o_totalprice) FROM orders)) / (SELECT max(o_totalprice) - min(o_totalprice) FROM orders), 8) AS o_totalprice FROM orders",
)
def _(t):
    return rounded(I.min_max(t("orders").select("o_orderkey", "o_totalprice"), ["o_totalprice"]), 8, "o_totalprice")


@query(
    "i15_standardize",
    "SELECT o_orderkey, round((o_totalprice - m) / sd, 6) + 0.0 AS by_sd, round((o_totalprice - m) / v, 10) + 0.0 AS by_var FROM orders, "
    "(SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS sd, var_pop(o_totalprice) AS v FROM orders)",
)
def _(t):
    both = t("orders").select("o_orderkey", F.col("o_totalprice").alias("by_sd"), F.col("o_totalprice").alias("by_var"))
    out = I.standardize(I.standardize(both, ["by_sd"]), ["by_var"], by="var")
    return rounded(rounded(out, 6, "by_sd"), 10, "by_var")


@query(
    "i16_unskew",
    "SELECT event_id, round(ln(1 + value), 8) AS log_value, round((power(1 + value, 0.15) - 1) / 0.15, 8) AS box_value FROM events",
)
def _(t):
    both = t("events").select("event_id", F.col("value").alias("log_value"), F.col("value").alias("box_value"))
    return rounded(I.unskew(I.unskew(both, ["log_value"]), ["box_value"], 0.15), 8, "log_value", "box_value")


@query(
    "i17_robust_scale",
    "SELECT event_id, round((value - m) / (b - a), 8) + 0.0 AS value FROM events, (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.5) AS m, quantile_cont(value, 0.75) AS b FROM events)",
)
def _(t):
    return rounded(I.robust_scale(t("events").select("event_id", "value"), ["value"]), 8, "value")


@query("i18_binarize", sql(["scored"], {}, "SELECT id, CASE WHEN score > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS binary FROM scored"))
def _(t):
    return I.binarize(t("scored"), "score").select("id", "binary")


@query(
    "i18_poly_expand",
    "WITH p AS (SELECT l_orderkey, l_linenumber, l_discount AS x, l_tax AS z FROM lineitem) SELECT l_orderkey, l_linenumber, round(x, 8) AS e1, round(x * x, 8) AS e2, "
    "round(x * x * x, 8) AS e3, round(z, 8) AS e4, round(x * z, 8) AS e5, round(x * x * z, 8) AS e6, round(z * z, 8) AS e7, round(x * z * z, 8) AS e8, round(z * z * z, 8) AS e9 FROM p",
)
def _(t):
    from pyspark.ml.functions import vector_to_array

    v = I.assemble(t("lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax"), ["l_discount", "l_tax"])
    out = I.poly_expand(v, "features").withColumn("a", vector_to_array("poly"))
    return out.select("l_orderkey", "l_linenumber", *[(F.round(F.col("a")[i], 8) + 0.0).alias(f"e{i + 1}") for i in range(9)])


def pca_sql(k: int, squarings: int = 13) -> str:
    """Directions of the covariance matrix by repeated squaring, each taken out before the next."""
    steps = {
        "x": "SELECT vec_id, unnest(generate_series(1, len(embedding))) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings",
        "cv1": "SELECT a.i, b.i AS j, covar_samp(a.v, b.v) AS v FROM x a JOIN x b USING (vec_id) GROUP BY a.i, b.i",
    }
    for n in range(1, k + 1):
        before = f"cv{n}"
        for s in range(squarings):
            steps[f"sq{n}_{s}"] = f"SELECT a.i, b.j, sum(a.v * b.v) AS v FROM {before} a JOIN {before} b ON a.j = b.i GROUP BY a.i, b.j"
            steps[f"p{n}_{s}"] = f"SELECT i, j, v / (SELECT sum(v) FROM sq{n}_{s} WHERE i = j) AS v FROM sq{n}_{s}"
            before = f"p{n}_{s}"
        steps[f"e{n}"] = f"SELECT i, v / sqrt(sum(v * v) OVER ()) AS v FROM {before} WHERE j = (SELECT arg_max(i, v) FROM {before} WHERE i = j)"
        steps[f"l{n}"] = f"SELECT sum(c.v * a.v * b.v) AS l FROM cv{n} c JOIN e{n} a ON a.i = c.i JOIN e{n} b ON b.i = c.j"
        steps[f"cv{n + 1}"] = f"SELECT c.i, c.j, c.v - l * a.v * b.v AS v FROM cv{n} c JOIN e{n} a ON a.i = c.i JOIN e{n} b ON b.i = c.j, l{n}"
    found = ", ".join(f"round(sum(x.v * e{n}.v), 6) + 0.0 AS pc{n}" for n in range(1, k + 1))
    joins = " ".join(f"JOIN e{n} ON e{n}.i = x.i" for n in range(1, k + 1))
    return sql([], steps, f"SELECT vec_id, {found} FROM x {joins} GROUP BY vec_id", once=list(steps))


@query("i18_pca", pca_sql(3))
def _(t):
    from pyspark.ml.functions import array_to_vector, vector_to_array

    v = t("embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    out = I.pca(v, "features").select("vec_id", vector_to_array("pca").alias("pca"))
    return out.select("vec_id", *[(F.round(F.col("pca")[i], 6) + 0.0).alias(f"pc{i + 1}") for i in range(3)])


@query(
    "i19_to_features",
    sql(["gaps"], {}, "SELECT id, coalesce(price, 0.0) AS f1, coalesce(CAST(size AS DOUBLE), 0.0::DOUBLE) AS f2, 0.0::DOUBLE AS f3, 0.0::DOUBLE AS f4, 0.0::DOUBLE AS f5 FROM gaps"),
)
def _(t):
    return I.to_features(t("gaps"), 1).select("id", *[F.col("features")[i].alias(f"f{i + 1}") for i in range(5)])


@query("j12_align_columns", "SELECT o_orderkey AS key, o_totalprice AS amount, 'a' AS side FROM orders UNION ALL SELECT c_custkey, c_acctbal, 'b' FROM customer")
def _(t):
    a = t("orders").select(F.col("o_orderkey").alias("key"), "o_orderstatus", F.col("o_totalprice").alias("amount"))
    b = t("customer").select(F.col("c_acctbal").alias("amount"), "c_name", F.col("c_custkey").alias("key"))
    x, y = I.align_columns(a, b)
    return x.withColumn("side", F.lit("a")).unionByName(y.withColumn("side", F.lit("b")))


@query(
    "j13_with_source",
    "SELECT o_orderkey AS key, o_orderstatus AS status, o_totalprice AS amount, 'train' AS source FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01' "
    "UNION ALL SELECT o_orderkey, NULL, o_totalprice, 'test' FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'",
)
def _(t):
    rows = t("orders").select(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("amount"), "o_orderdate")
    early = F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz")
    return I.with_source(rows.where(early).drop("o_orderdate"), rows.where(~early).drop("status", "o_orderdate"))

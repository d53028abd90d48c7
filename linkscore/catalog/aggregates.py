"""Queries of the aggregation family."""

from __future__ import annotations

from pyspark.sql import functions as F

from linkscore.catalog.registry import query, sql
from linkscore.operators import aggregates as A


def rounded(df, digits: int, *cols):
    """Round the named columns; adding 0.0 turns -0.0 into 0.0."""
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in cols})


@query(
    "a12_filled_counts",
    sql(["raw_apps"], {}, "SELECT " + ", ".join(
        f"count(CASE WHEN trim({c}) <> '' THEN 1 END) AS {c}" for c in ("cert_no", "email", "mobile", "loan_pan")) + " FROM raw_apps"),
)
def _(t):
    return A.filled_counts(t("raw_apps"), ["cert_no", "email", "mobile", "loan_pan"])


GAP_COLS = ["id", "price", "size", "brand", "type", "name"]


@query(
    "a13_missing_table",
    sql(["gaps"], {"m": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS total, (count(*) - count({c})) / count(*) AS percent FROM gaps" for c in GAP_COLS)},
        "SELECT \"column\", total, round(percent, 9) AS percent FROM m WHERE total > 0"),
)
def _(t):
    return rounded(A.missing_table(t("gaps")), 9, "percent")


@query("a13_drop_missing", sql(["gaps"], {}, "SELECT id, price, brand, type, name FROM gaps"))
def _(t):
    return A.drop_missing(t("gaps"), 0.18)


@query(
    "a14_value_counts",
    sql(["gaps"], {}, "SELECT brand, count(*) AS count, round(count(*) / (SELECT count(*) FROM gaps), 9) AS percent FROM gaps GROUP BY brand"),
)
def _(t):
    return rounded(A.value_counts(t("gaps"), "brand", dropna=False), 9, "percent")


@query(
    "a15_histogram",
    """WITH s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi, count(*) AS n, avg(o_totalprice) AS mean, stddev_samp(o_totalprice) AS sd FROM orders),
    b AS (SELECT CAST(least(floor((o_totalprice - lo) / ((hi - lo) / 20)), 19) AS INT) AS bin, s.* FROM orders, s)
    SELECT bin, round(min(lo) + (min(hi) - min(lo)) / 20 * bin, 4) AS lower, count(*) AS count,
    round(count(*) / min(n) / ((min(hi) - min(lo)) / 20), 12) AS density, round(min(mean), 4) AS mean, round(min(sd), 4) AS sd FROM b GROUP BY bin""",
)
def _(t):
    return rounded(rounded(A.histogram(t("orders"), "o_totalprice", 20), 4, "lower", "mean", "sd"), 12, "density")


@query("a16_target_rate", sql(["credit"], {}, "SELECT priority, round(avg(y), 9) AS rate, count(*) AS n FROM credit GROUP BY priority"))
def _(t):
    return rounded(A.target_rate(t("credit"), "priority", "y"), 9, "rate")


@query(
    "a17_pivot_count",
    "SELECT CAST(extract(hour FROM ts) AS INT) AS hour, " + ", ".join(
        f"count(CASE WHEN event_type = '{e}' THEN 1 END) AS {e}" for e in ("click", "error", "purchase", "signup", "view")) + " FROM events GROUP BY 1",
)
def _(t):
    return A.crosstab(t("events").withColumn("hour", F.hour("ts")), "hour", "event_type")


NUMS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "a18_corr_matrix",
    " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) + 0.0 AS corr FROM lineitem" for a in NUMS for b in NUMS),
)
def _(t):
    return rounded(A.corr_matrix(t("lineitem"), NUMS), 6, "corr")


@query(
    "a18_top_corr",
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{a}' AS \"column\", round(corr({a}, l_extendedprice), 6) + 0.0 AS corr FROM lineitem" for a in ("l_quantity", "l_discount", "l_tax", "l_linenumber"))
    + ") ORDER BY corr DESC LIMIT 2",
)
def _(t):
    return rounded(A.top_corr(t("lineitem"), "l_extendedprice", 2, ["l_quantity", "l_discount", "l_tax", "l_linenumber"]), 6, "corr")


@query(
    "a19_describe",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS sd,
        min({c}) AS min, max({c}) AS max, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50,
        round(quantile_cont({c}, 0.75), 4) AS q75 FROM lineitem""" for c in ("l_quantity", "l_extendedprice")),
)
def _(t):
    return rounded(A.describe(t("lineitem"), ["l_quantity", "l_extendedprice"]), 4, "mean", "sd", "q25", "q50", "q75")


def g1(c: str) -> str:
    return (f"(avg({c} * {c} * {c}) - 3 * avg({c}) * avg({c} * {c}) + 2 * power(avg({c}), 3)) / "
            f"power(avg({c} * {c}) - avg({c}) * avg({c}), 1.5)")


@query(
    "a20_skew_table",
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", round({g1(c)}, 4) + 0.0 AS skew FROM lineitem" for c in ("l_extendedprice", "l_quantity")),
)
def _(t):
    return rounded(A.skew_table(t("lineitem"), ["l_extendedprice", "l_quantity"]), 4, "skew")


@query(
    "a21_crosstab",
    sql(["credit"], {}, "SELECT segment, count(CASE WHEN y = 0 THEN 1 END) AS \"0\", count(CASE WHEN y = 1 THEN 1 END) AS \"1\" FROM credit GROUP BY segment"),
)
def _(t):
    return A.crosstab(t("credit"), "segment", "y", [0, 1])


@query(
    "a22_merged_mean_var",
    "SELECT count(l_extendedprice) AS n, round(avg(l_extendedprice), 4) AS mean, round(var_pop(l_extendedprice), 1) AS variance FROM lineitem",
)
def _(t):
    return rounded(rounded(A.merged_mean_var(t("lineitem"), "l_extendedprice"), 4, "mean"), 1, "variance")


@query(
    "a23_text_counts",
    r"""SELECT CAST(sum(length(text) - length(replace(text, chr(10), '')) + 1) AS BIGINT) AS lines,
    CAST(sum(len(regexp_extract_all(text, '[^ \t\r\n\f\x0B]+'))) AS BIGINT) AS words, CAST(sum(length(text) + 1) AS BIGINT) AS chars FROM documents""",
)
def _(t):
    return A.text_counts(t("documents"), "text")


@query(
    "a24_reduce_with_rejects",
    "SELECT user_id, ts, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1 AS kept FROM events",
)
def _(t):
    return A.reduce_with_rejects(t("events").select("user_id", "ts", "event_id"), "user_id", ["ts", "event_id"])


@query(
    "a25_undersample",
    sql(["credit"], {"c": "SELECT id, y FROM credit",
        "n": "SELECT least((SELECT count(*) FROM c WHERE y = 0), (SELECT count(*) FROM c WHERE y = 1)) AS k"},
        """SELECT id, y FROM (SELECT id, y, row_number() OVER (PARTITION BY y ORDER BY md5(concat(CAST(id AS STRING), '|11')), id) AS r,
        count(*) OVER (PARTITION BY y) AS size FROM c) WHERE r <= (SELECT k FROM n)"""),
)
def _(t):
    return A.undersample(t("credit").select("id", "y"), "y", "id")


@query("a26_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 2")
def _(t):
    return A.top_k(t("orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 2, "o_orderkey")


@query("a26_drop_outliers", "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem WHERE NOT (l_quantity > 45 AND l_extendedprice < 60000)")
def _(t):
    rows = t("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return A.drop_outliers(rows, (F.col("l_quantity") > 45) & (F.col("l_extendedprice") < 60000))


@query(
    "u01_avg5",
    sql(["gaps"], {}, "SELECT type, round(avg(price), 5) AS mean, round(avg(coalesce(price, 0)), 5) AS mean_zero FROM gaps GROUP BY type"),
)
def _(t):
    return t("gaps").groupBy("type").agg(A.avg5(F.col("price")).alias("mean"), A.avg5(F.col("price"), True).alias("mean_zero"))


@query(
    "u02_array_avg",
    "SELECT label, i, round(avg(CAST(embedding[i] AS DOUBLE)), 6) + 0.0 AS mean FROM embeddings, range(1, 65) r(i) GROUP BY label, i",
)
def _(t):
    means = t("embeddings").groupBy("label").agg(A.array_avg(F.col("embedding"), 64).alias("m"))
    return means.select("label", F.posexplode("m")).select(
        "label", (F.col("pos") + 1).cast("long").alias("i"), (F.round("col", 6) + 0.0).alias("mean")
    )

"""Queries of the cleaning family."""

from __future__ import annotations

from pyspark.sql import functions as F

from linkscore.catalog.registry import query, sql
from linkscore.functions import clean as P


def blank(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR trim({c}) = '' OR lower({c}) = 'null' THEN '' ELSE {c} END"


def token(c: str, comma: str = "") -> str:
    return f"replace(replace(replace({blank(c)}, ',', '{comma}'), '&', '@'), '#', '')"


def phone(c: str, patterns) -> str:
    ors = " OR ".join(f"regexp_full_match({c}, '{p}')" for p in patterns)
    return f"coalesce({ors}, FALSE)"


TEXT = ["cert_no", "email", "loan_pan"]


@query("p01_clean_text", sql(["raw_apps"], {}, "SELECT order_id, " + ", ".join(f"{blank(c)} AS {c}" for c in TEXT) + " FROM raw_apps"))
def _(t):
    return t("raw_apps").select("order_id", *[P.clean_text(F.col(c)).alias(c) for c in TEXT])


@query(
    "p02_clean_token",
    sql(
        ["raw_apps"],
        {},
        f"SELECT order_id, replace({blank('cert_no')}, ',', '') AS cert_no, {token('email')} AS email, "
        f"{token('comp_addr', '_')} AS comp_addr, {token('loan_pan')} AS loan_pan FROM raw_apps",
    ),
)
def _(t):
    return t("raw_apps").select(
        "order_id",
        P.clean_token(F.col("cert_no"), only_comma=True).alias("cert_no"),
        P.clean_token(F.col("email")).alias("email"),
        P.clean_token(F.col("comp_addr"), "_").alias("comp_addr"),
        P.clean_token(F.col("loan_pan")).alias("loan_pan"),
    )


@query(
    "p03_is_phone",
    sql(
        ["raw_apps"],
        {"n": "SELECT mobile AS num FROM raw_apps UNION SELECT contact_mobile FROM raw_apps UNION SELECT recommend FROM raw_apps"},
        f"SELECT num, {phone('num', P.PHONE_STRICT)} AS strict_ok, {phone('num', P.PHONE_FIXED)} AS fixed_ok FROM n",
    ),
)
def _(t):
    raw = t("raw_apps")
    nums = raw.select(F.explode(F.array("mobile", "contact_mobile", "recommend")).alias("num")).distinct()
    return nums.select("num", P.is_phone(F.col("num"), "strict").alias("strict_ok"), P.is_phone(F.col("num")).alias("fixed_ok"))


@query(
    "p04_clean_entity",
    sql(
        ["raw_apps"],
        {},
        f"SELECT order_id, CASE WHEN device_id = '{P.ZERO_DEVICE}' THEN '' ELSE device_id END AS device_id, "
        f"lower({blank('email')}) AS email, CASE WHEN length(recommend) BETWEEN 5 AND 11 THEN recommend ELSE '' END AS recommend, "
        "CASE WHEN length(recommend) IN (6, 11) THEN recommend ELSE '' END AS recommend_batch FROM raw_apps",
    ),
)
def _(t):
    return t("raw_apps").select(
        "order_id",
        P.clean_entity(F.col("device_id"), "device").alias("device_id"),
        P.clean_entity(F.col("email"), "email").alias("email"),
        P.clean_entity(F.col("recommend"), "recommend").alias("recommend"),
        P.clean_entity(F.col("recommend"), "recommend", (6, 11)).alias("recommend_batch"),
    )


@query("p05_strip_hyphen", sql(["raw_apps"], {}, "SELECT order_id, replace(contact_mobile, '-', '') AS phone FROM raw_apps"))
def _(t):
    return t("raw_apps").select("order_id", P.strip_hyphen(F.col("contact_mobile")).alias("phone"))


HEX = "('0x' || substr(md5({0}), 1, 16))"


@query(
    "p06_stable_id",
    sql(
        ["app_edges"],
        {
            "k": "SELECT DISTINCT entity_value, entity_type, substr(md5(concat(entity_value, '&', CAST(entity_type AS STRING))), 1, 16) AS h FROM app_edges",
            "u": "SELECT *, CAST(CAST(('0x' || h) AS UBIGINT) AS HUGEINT) AS n FROM k",
        },
        "SELECT entity_value, entity_type, CAST(CASE WHEN n >= 9223372036854775808 THEN n - 18446744073709551616 ELSE n END AS BIGINT) AS id FROM u",
    ),
)
def _(t):
    keys = t("app_edges").select("entity_value", "entity_type").distinct()
    return keys.withColumn("id", P.stable_id(F.col("entity_value"), F.col("entity_type").cast("string")))


@query(
    "p07_to_second",
    sql(["raw_apps"], {}, "SELECT order_id, split_part(insert_time, '.', 1) AS second, substr(insert_time, 1, 10) AS day FROM raw_apps"),
)
def _(t):
    return t("raw_apps").select(
        "order_id", P.to_second(F.col("insert_time")).alias("second"), P.day_of(F.col("insert_time")).alias("day")
    )


TIMES = "SELECT order_id, CASE WHEN order_id % 23 = 1 THEN 'not a time' ELSE insert_time END AS ts FROM raw_apps"


def _times(t):
    return t("raw_apps").select(
        "order_id", F.when(F.col("order_id") % 23 == 1, F.lit("not a time")).otherwise(F.col("insert_time")).alias("ts")
    )


@query(
    "p08_in_window",
    sql(
        ["raw_apps"],
        {"x": TIMES},
        "SELECT order_id, coalesce(try_cast(ts AS TIMESTAMP) BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-12-31', FALSE) AS inside, "
        "coalesce(try_cast(ts AS TIMESTAMP) BETWEEN TIMESTAMP '1997-12-28' AND TIMESTAMP '1998-12-27', FALSE) AS lagged FROM x",
    ),
)
def _(t):
    c = F.col("ts")
    return _times(t).select(
        "order_id",
        P.in_window(c, "1998-01-01", "1998-12-31").alias("inside"),
        P.in_window(c, "1998-01-01", "1998-12-31", lag_days=4).alias("lagged"),
    )


@query("p09_until", sql(["raw_apps"], {"x": TIMES}, "SELECT * FROM x WHERE try_cast(ts AS TIMESTAMP) <= TIMESTAMP '1998-06-30'"))
def _(t):
    return P.until(_times(t), "ts", "1998-06-30")


@query(
    "p10_calendar_columns",
    """SELECT event_id, ts, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%d %H') AS hour,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS second, CAST(date_trunc('month', ts) AS DATE) AS month_first,
    last_day(ts) AS month_last, strftime(ts - INTERVAL 8 HOURS, '%Y-%m-%dT%H:%M:%SZ') AS iso_utc FROM events""",
)
def _(t):
    return P.calendar_columns(t("events").select("event_id", "ts"), "ts")


APP_SPEC = dict(
    phones=["mobile", "contact_mobile", "emergency_mobile", "recommend"],
    tokens={"cert_no": None, "email": "", "company": "", "comp_addr": "_", "device_id": "", "loan_pan": ""},
)


@query(
    "p00_clean_applications",
    sql(
        ["raw_apps"],
        {},
        f"SELECT order_id, insert_time, user_id, replace({blank('cert_no')}, ',', '') AS cert_no, {token('comp_addr', '_')} AS comp_addr, "
        + ", ".join(f"{token(c)} AS {c}" for c in ("email", "company", "device_id", "loan_pan"))
        + ", "
        + ", ".join(f"CASE WHEN {phone(c, P.PHONE_FIXED)} THEN {token(c)} ELSE '' END AS {c}" for c in APP_SPEC["phones"])
        + " FROM raw_apps",
    ),
)
def _(t):
    return P.clean_applications(t("raw_apps"), **APP_SPEC)


@query(
    "p12_recode",
    "SELECT p_partkey, CASE p_size WHEN 0 THEN 4 WHEN 5 THEN 4 WHEN 6 THEN 4 ELSE p_size END AS size, "
    "CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'SMALL' THEN 2 WHEN 'LARGE' THEN 3 ELSE 0 END AS grade FROM part",
)
def _(t):
    return t("part").select(
        "p_partkey",
        P.recode(F.col("p_size"), {0: 4, 5: 4, 6: 4}).alias("size"),
        P.recode(F.col("p_type"), {"ECONOMY": 1, "SMALL": 2, "LARGE": 3}, 0).alias("grade"),
    )


@query("p13_as_category", "SELECT p_partkey, CAST(p_size AS VARCHAR) AS p_size, p_type FROM part")
def _(t):
    return P.as_category(t("part").select("p_partkey", "p_size", "p_type"), ["p_size"])


@query(
    "p14_split_between",
    sql([], {"n": "SELECT c_custkey, concat(c_mktsegment, ', ', c_name, '. of nation ', CAST(c_nationkey AS VARCHAR)) AS full_name FROM customer"},
        "SELECT c_custkey, split_part(split_part(full_name, ', ', 2), '.', 1) AS title FROM n"),
)
def _(t):
    full = F.concat(F.col("c_mktsegment"), F.lit(", "), F.col("c_name"), F.lit(". of nation "), F.col("c_nationkey").cast("string"))
    return t("customer").select("c_custkey", P.split_between(full, ", ", ".").alias("title"))


@query(
    "p15_derive",
    """SELECT event_id, CAST(user_id + event_id + 1 AS BIGINT) AS family, CASE WHEN user_id = 0 THEN 1 ELSE 0 END AS alone,
    CASE WHEN value < 16 THEN 'child' ELSE event_type END AS person,
    CAST(ceil((extract(hour FROM ts) * 3600 + extract(minute FROM ts) * 60 + floor(extract(second FROM ts))) / 3600.0) AS BIGINT) % 24 AS hour FROM events""",
)
def _(t):
    seconds = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    return P.derive(
        t("events").select("event_id", "user_id", "value", "event_type", "ts"),
        {
            "family": F.col("user_id") + F.col("event_id") + 1,
            "alone": F.when(F.col("user_id") == 0, 1).otherwise(0),
            "person": F.when(F.col("value") < 16, F.lit("child")).otherwise(F.col("event_type")),
            "hour": P.hour_of_day(seconds),
        },
    ).select("event_id", "family", "alone", "person", "hour")


@query(
    "p17_geo_km",
    """WITH p AS (SELECT c_custkey, c_nationkey * 3.0 - 40 AS lat1, c_acctbal / 100 AS lon1, s_acctbal / 200 AS lat2, s_nationkey * 7.0 - 80 AS lon2
    FROM customer JOIN supplier ON s_suppkey = c_custkey % 100)
    SELECT c_custkey, round(acos(least(1.0, greatest(-1.0, sin(radians(lat1)) * sin(radians(lat2)) + cos(radians(lat1)) * cos(radians(lat2))
    * cos(radians(lon2 - lon1))))) * 6371.0, 4) AS km FROM p""",
)
def _(t):
    pairs = t("customer").join(t("supplier"), F.col("s_suppkey") == F.col("c_custkey") % 100)
    km = P.geo_km(
        F.col("c_nationkey") * 3.0 - 40, F.col("c_acctbal") / 100, F.col("s_acctbal") / 200, F.col("s_nationkey") * 7.0 - 80
    )
    return pairs.select("c_custkey", F.round(km, 4).alias("km"))


LOAN, USER = "json_extract_string(body, '$.cLoanApply')", "json_extract_string(body, '$.cApplyUser')"


def parsed_sql(source: str) -> str:
    loan = {k: f"json_extract_string(l, '$.{k}')" for k in P.APPLY_FIELDS}
    user = {k: f"json_extract_string(u, '$.{k}')" for k in P.USER_FIELDS}
    cols = [f"{e} AS {P.APPLY_FIELDS[k]}" for k, e in loan.items()] + [f"{e} AS {P.USER_FIELDS[k]}" for k, e in user.items()]
    return (
        f"SELECT msg_id, body, {', '.join(cols)} FROM (SELECT msg_id, body, CASE WHEN json_valid(body) THEN {LOAN} END AS l, "
        f"CASE WHEN json_valid(body) THEN {USER} END AS u FROM {source})"
    )


@query("p18_parse_application", sql(["messages"], {"p": parsed_sql("messages")}, "SELECT * FROM p"))
def _(t):
    return P.parse_application(t("messages"), "body")

"""Domain tables derived from the given tables, in SQL both engines accept.

Each text is run by Spark to feed a query and pasted as a CTE into the
checking SQL, so both sides start from the same definition.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

DERIVED: dict[str, tuple[tuple[str, ...], str]] = {
    # one row per application with its later performance
    "applications": (
        ("orders",),
        """SELECT o_orderkey AS order_id, o_custkey AS cert_no, o_orderdate AS apply_time,
        CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'q_refuse' ELSE 'normal' END AS performance,
        CASE o_orderstatus WHEN 'F' THEN 'pass' WHEN 'P' THEN 'refuse' ELSE 'open' END AS type,
        CAST(o_orderkey % 45 - 5 AS INT) AS current_due_day,
        CAST((o_orderkey * 7) % 60 - 5 AS INT) AS history_due_day,
        CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS label
        FROM orders""",
    ),
    # entity value -> application, entity types 9 (device) and 10 (ID number)
    "app_edges": (
        ("orders", "lineitem"),
        """SELECT DISTINCT 9 AS entity_type, CAST(l_partkey AS STRING) AS entity_value,
        o_orderkey AS app_id, o_orderdate AS app_time
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        UNION ALL SELECT 10, CAST(o_custkey AS STRING), o_orderkey, o_orderdate FROM orders""",
    ),
    # raw application rows as they arrive, with the usual dirt
    "raw_apps": (
        ("orders", "customer"),
        """SELECT o_orderkey AS order_id, concat(CAST(o_orderdate AS STRING), '.0') AS insert_time,
        o_custkey AS user_id,
        CASE WHEN o_custkey % 7 = 3 THEN NULL ELSE concat(CAST(o_custkey AS STRING), ',X') END AS cert_no,
        CASE WHEN o_custkey % 11 = 0 THEN 'NULL' WHEN o_custkey % 13 = 0 THEN '  '
             ELSE concat(c_name, '&Mail.com') END AS email,
        concat(c_mktsegment, ', Ltd') AS company,
        concat(c_mktsegment, ',', CAST(c_nationkey AS STRING)) AS comp_addr,
        concat(CASE o_custkey % 4 WHEN 0 THEN '13' WHEN 1 THEN '17' WHEN 2 THEN '18' ELSE '154' END,
               lpad(CAST(o_custkey * 7919 % 1000000000 AS STRING), 9, '0')) AS mobile,
        concat('0755-', CAST(20000000 + o_custkey % 500 AS STRING)) AS contact_mobile,
        concat('1380', lpad(CAST(o_custkey % 300 AS STRING), 7, '0')) AS emergency_mobile,
        CAST(o_orderkey * 37 AS STRING) AS recommend,
        CASE WHEN o_orderkey % 17 = 0 THEN '00000000-0000-0000-0000-000000000000'
             ELSE concat('dev-', CAST(o_orderkey % 997 AS STRING)) END AS device_id,
        CASE WHEN o_custkey % 5 = 0 THEN 'null' ELSE concat('6222#', CAST(o_custkey AS STRING)) END AS loan_pan
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    ),
    # customers calling suppliers; suppliers get negative ids
    "calls": (
        ("orders", "lineitem"),
        """SELECT o_custkey AS src, -1 - l_suppkey AS dst, count(*) AS weight
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, -1 - l_suppkey""",
    ),
    # undirected entity graph: customer, part and supplier of every line
    "entity_edges": (
        ("orders", "lineitem"),
        """SELECT DISTINCT src, dst FROM (
        SELECT o_custkey * 4 AS src, l_partkey * 4 + 1 AS dst FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        UNION ALL SELECT o_custkey * 4, l_suppkey * 4 + 2 FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        UNION ALL SELECT l_partkey * 4 + 1, l_suppkey * 4 + 2 FROM lineitem) e""",
    ),
    # directed calls with cycles: returned lines call back
    "links": (
        ("orders", "lineitem"),
        """SELECT DISTINCT src, dst FROM (
        SELECT o_custkey * 2 AS src, l_suppkey * 2 + 1 AS dst FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE l_returnflag <> 'R'
        UNION ALL SELECT l_suppkey * 2 + 1, o_custkey * 2 FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE l_returnflag = 'R') e""",
    ),
    "ratings": (
        ("orders", "lineitem"),
        """SELECT o_custkey AS user_id, l_suppkey AS item_id,
        CAST(1 + CAST(sum(l_quantity) AS BIGINT) % 5 AS DOUBLE) AS rating
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_suppkey""",
    ),
    "baskets": (
        ("lineitem", "part"),
        """SELECT DISTINCT l_orderkey AS basket, concat(p_type, '/', CAST(p_size % 4 AS STRING)) AS item
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    ),
    # binary target with categories and measures
    "credit": (
        ("orders", "customer"),
        """SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y,
        o_orderpriority AS priority, c_mktsegment AS segment, CAST(c_nationkey AS STRING) AS nation,
        o_totalprice AS price, c_acctbal AS balance, o_orderdate AS day
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    ),
    "scored": (
        ("orders",),
        """SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y,
        CAST(floor(o_totalprice) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS score FROM orders""",
    ),
    # measures with gaps for the preparation jobs
    "gaps": (
        ("part",),
        """SELECT p_partkey AS id, CASE WHEN p_partkey % 9 = 2 THEN NULL ELSE p_retailprice END AS price,
        CASE WHEN p_partkey % 5 = 1 THEN NULL ELSE p_size END AS size,
        CASE WHEN p_partkey % 6 = 4 THEN NULL ELSE p_brand END AS brand, p_type AS type, p_name AS name
        FROM part""",
    ),
    # incoming messages: an outer JSON object holding two JSON strings
    "messages": (
        ("orders", "customer"),
        """SELECT o_orderkey AS msg_id, CASE WHEN o_orderkey % 19 = 5
          THEN concat('{"cLoanApply": broken generalApply_CreditLoan logNo ', CAST(o_orderkey AS STRING))
          ELSE concat('{"kind":"', CASE WHEN o_orderkey % 4 = 0 THEN 'other' ELSE 'generalApply_CreditLoan' END,
            '","logNo":"', CAST(o_orderkey AS STRING),
            '","cLoanApply":"{\\\\"orderId\\\\":\\\\"', CAST(o_orderkey AS STRING),
            '\\\\",\\\\"insertTime\\\\":\\\\"', CAST(o_orderdate AS STRING),
            '\\\\",\\\\"termId\\\\":\\\\"T', CAST(o_orderkey % 50 AS STRING),
            '\\\\"}","cApplyUser":"{\\\\"userId\\\\":\\\\"', CAST(o_custkey AS STRING),
            '\\\\",\\\\"certNo\\\\":\\\\"C', CAST(o_custkey AS STRING),
            '\\\\",\\\\"mobile\\\\":\\\\"13', lpad(CAST(o_custkey AS STRING), 9, '0'),
            '\\\\",\\\\"email\\\\":\\\\"', c_name,
            '@X.com\\\\"}"}') END AS body
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    ),
}

# the same rows where Spark builds them, by one join instead of two
BUILT = {
    "entity_edges": """SELECT DISTINCT e.src, e.dst FROM (SELECT explode(CASE WHEN o_orderkey IS NULL THEN array(b) ELSE array(
          struct(o_custkey * 4 AS src, l_partkey * 4 + 1 AS dst), struct(o_custkey * 4 AS src, l_suppkey * 4 + 2 AS dst), b) END) AS e
        FROM (SELECT *, struct(l_partkey * 4 + 1 AS src, l_suppkey * 4 + 2 AS dst) AS b
          FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey) x) y""",
    "links": """SELECT DISTINCT CASE WHEN l_returnflag = 'R' THEN l_suppkey * 2 + 1 ELSE o_custkey * 2 END AS src,
        CASE WHEN l_returnflag = 'R' THEN o_custkey * 2 ELSE l_suppkey * 2 + 1 END AS dst
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag IS NOT NULL""",
}


def _needs(name: str) -> tuple[str, ...]:
    return DERIVED[name][0]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, or one derived from the given tables."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    inputs, text = DERIVED[name]
    text = BUILT.get(name, text)
    frames = {t: table(spark, sf_dir, t) for t in inputs}
    text = text.replace("{", "{{").replace("}", "}}")
    for t in inputs:
        text = _replace_word(text, t)
    return spark.sql(text, **frames)


def _replace_word(text: str, word: str) -> str:
    return re.sub(rf"(FROM|JOIN) {word}\b", rf"\1 {{{word}}}", text)


def with_tables(*names: str) -> str:
    """``WITH`` clause defining the derived tables for the checking SQL."""
    return "WITH RECURSIVE " + ", ".join(f"{n} AS ({ctes(n)})" for n in names) + " "


def ctes(name: str) -> str:
    return DERIVED[name][1].replace("\\\\", "\\")

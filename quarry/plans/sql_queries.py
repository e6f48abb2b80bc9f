"""Queries that go through the guarded SQL entry over published views; the text is the same in both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.plans.sqlapi import guarded, publish
from quarry.session import table

CONTRACT = {
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size"],
    "documents": ["doc_id", "lang", "source", "n_chars"],
    "events": ["event_id", "ts", "user_id", "event_type", "value"],
}

TEXTS = {
    "sql_pricing_summary": """SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc, round(avg(l_discount), 6) AS avg_disc, count(*) AS n
        FROM v_lineitem WHERE l_shipdate <= DATE '1998-09-02' GROUP BY l_returnflag, l_linestatus""",
    "sql_top_customers": """WITH t AS (SELECT o_custkey, sum(o_totalprice) AS total FROM v_orders GROUP BY o_custkey)
        SELECT c_name, n_name, round(total, 2) AS total FROM t JOIN v_customer ON c_custkey = o_custkey JOIN v_nation ON n_nationkey = c_nationkey ORDER BY round(total, 2) DESC, c_name LIMIT 20""",
    "sql_order_ranks": """SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nth, count(*) OVER (PARTITION BY o_custkey) AS orders FROM v_orders""",
    "sql_customers_without_orders": """SELECT c_custkey, c_name FROM v_customer WHERE NOT EXISTS (SELECT 1 FROM v_orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""",
    "sql_brand_sets": """SELECT p_brand FROM v_part WHERE p_size > 40 INTERSECT SELECT p_brand FROM v_part WHERE p_size < 5 UNION SELECT 'none' AS p_brand""",
    "sql_event_rollup": """SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, round(sum(value), 4) AS total FROM v_events GROUP BY ROLLUP (event_type)""",
    "sql_document_facets": """SELECT lang, source, count(*) AS n, max(n_chars) AS longest FROM v_documents GROUP BY lang, source HAVING count(*) > 1""",
    "sql_staleness": """SELECT o_custkey, max(o_orderdate) AS newest FROM v_orders GROUP BY o_custkey HAVING max(o_orderdate) < TIMESTAMP '1997-06-01 00:00:00'""",
}


def _run(text: str):
    def query(spark: SparkSession, d: str) -> DataFrame:
        publish(spark, {t: table(spark, d, t) for t in CONTRACT}, CONTRACT)
        return guarded(spark, text)

    return query


QUERIES = {name: _run(text) for name, text in TEXTS.items()}
ORACLES = {name: text.replace(" v_", " ") for name, text in TEXTS.items()}

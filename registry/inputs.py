"""Raw inputs derived from the given tables, one SELECT each.

The text runs unchanged in Spark SQL and in the SQL the results are checked with, except for two
spellings: Spark needs ``\\\\N`` for a backslash and ``TIMESTAMP_NTZ`` for a timestamp without zone.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)

RECIPES: dict[str, str] = {
    "raw_cities": r"""
        SELECT CASE WHEN n_nationkey%5=1 THEN ' '||CAST(n_nationkey AS STRING)||' ' WHEN n_nationkey=24 THEN 'x24' WHEN n_nationkey=23 THEN NULL ELSE CAST(n_nationkey AS STRING) END AS city_id,
        CASE WHEN n_nationkey%2=0 THEN '  '||lower(n_name)||' town' ELSE upper(n_name)||'-on-sea ' END AS city_name FROM nation
        UNION ALL SELECT CAST(n_nationkey AS STRING),
        'zz dup '||n_name FROM nation WHERE n_nationkey%3=0 AND n_nationkey%5<>1
    """,
    "raw_branches": r"""
        SELECT CASE WHEN s_suppkey%17=0 THEN NULL ELSE CAST(s_suppkey AS STRING) END AS branch_id,
        CASE WHEN s_suppkey%2=0 THEN ' '||lower(s_name) ELSE upper(s_name)||' ' END AS branch_name,
        CASE WHEN n_nationkey%2=0 THEN lower(n_name)||' town' ELSE upper(n_name)||'-on-sea ' END AS city_name FROM supplier JOIN nation ON s_nationkey=n_nationkey
        UNION ALL SELECT CAST(s_suppkey AS STRING),
        'zz '||s_name,
        'nowhere' FROM supplier WHERE s_suppkey%4=1
    """,
    "raw_products": r"""
        SELECT CAST(p_partkey AS STRING) AS product_id,
        '  '||upper(p_name) AS product_name,
        lower(p_type)||' ' AS category,
        CASE WHEN p_partkey%13=0 THEN 'n/a' ELSE CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS STRING) END AS price FROM part
        UNION ALL SELECT CAST(p_partkey AS STRING),
        'zz '||p_name,
        p_type,
        '1.00' FROM part WHERE p_partkey%10=0
    """,
    "raw_employees": r"""
        SELECT 'E'||CAST(c_custkey AS STRING) AS employee_id,
        lower(c_name) AS first_name,
        ' '||upper(c_mktsegment) AS last_name,
        'u'||CAST(c_custkey AS STRING)||'@x.test' AS email,
        CAST(c_custkey AS STRING) AS phone,
        CASE WHEN c_custkey%9=0 THEN CAST(NULL AS TIMESTAMP) ELSE CAST(DATE '2020-01-01' + CAST(c_custkey%900 AS INT) AS TIMESTAMP) END AS hire_date,
        CASE WHEN c_custkey%3=0 THEN 'bar tender' ELSE 'WAITER' END AS role FROM customer
    """,
    "raw_staff": r"""
        SELECT ' S'||CAST(c_custkey AS STRING) AS staff_id,
        'E'||CAST(c_custkey AS STRING) AS employee_id FROM customer WHERE c_custkey%7<>0
        UNION ALL SELECT ' S'||CAST(c_custkey AS STRING),
        'E'||CAST(c_custkey+1 AS STRING) FROM customer WHERE c_custkey%7=3
    """,
    "raw_assignments": r"""
        SELECT 'S'||CAST(o_custkey AS STRING) AS staff_id,
        CAST(o_orderkey%100 AS STRING) AS branch_id,
        CAST(o_orderdate AS DATE) AS start_date,
        CASE WHEN o_orderkey%4=0 THEN CAST(NULL AS DATE) ELSE CAST(o_orderdate AS DATE)+CAST(o_orderkey%300 AS INT) END AS end_date FROM orders
    """,
    "raw_sales": r"""
        SELECT CASE WHEN l_orderkey%97=0 THEN NULL ELSE CAST(l_orderkey*10+l_linenumber AS STRING) END AS sale_id,
        CAST(l_suppkey AS STRING) AS branch_id,
        ' S'||CAST(l_orderkey%1500 AS STRING) AS staff_id,
        CAST(l_partkey AS STRING) AS product_id,
        l_shipdate AS sale_date,
        CASE WHEN l_linenumber=7 AND l_orderkey%50=1 THEN 'bad' ELSE CAST(CAST(l_quantity AS DECIMAL(12,2)) AS STRING) END AS volume_sold,
        CASE WHEN l_orderkey%5=0 THEN NULL ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING) END AS price,
        CAST(CAST(l_extendedprice AS DECIMAL(12,2)) - CAST(1 AS DECIMAL(12,2)) AS STRING) AS cost,
        CASE WHEN l_orderkey%3=0 THEN CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING) ELSE NULL END AS revenue FROM lineitem
    """,
    "raw_holidays": r"""
        SELECT CASE WHEN o_orderkey%3=0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) WHEN o_orderkey%41=0 THEN 'TBC' ELSE substr(CAST(CAST(o_orderdate AS DATE) AS STRING),6,2)||'/'||substr(CAST(CAST(o_orderdate AS DATE) AS STRING),9,2)||'/'||substr(CAST(CAST(o_orderdate AS DATE) AS STRING),1,4) END AS raw_date,
        CASE WHEN o_orderkey%2=0 THEN ' madaraka day' ELSE 'Jamhuri Day ' END AS holiday_name,
        CASE WHEN o_orderkey%5=0 THEN '  ' WHEN o_orderkey%5=1 THEN NULL WHEN o_orderkey%5=2 THEN 'Religious' ELSE 'Bank' END AS holiday_type,
        CASE WHEN o_orderkey%7=0 THEN CAST(CAST(o_orderdate AS DATE)+1 AS STRING) ELSE NULL END AS observed FROM orders
    """,
    "raw_campaigns": r"""
        SELECT CAST(c_custkey AS STRING) AS campaign_id,
        CAST(c_nationkey AS STRING) AS city_id,
        CAST(c_custkey%5+1 AS STRING) AS channel_id,
        CAST(c_custkey*37%10000 AS STRING) AS impressions,
        CAST(c_custkey*7%500 AS STRING) AS clicks,
        CAST(c_custkey%50 AS STRING) AS conversions,
        CASE WHEN c_custkey%8=0 THEN '\N' ELSE CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS STRING) END AS spend,
        CAST(DATE '2024-01-01' + CAST(c_custkey%300 AS INT) AS STRING) AS start_date,
        CAST(DATE '2024-01-08' + CAST(c_custkey%300 AS INT) AS STRING) AS end_date FROM customer
    """,
    "raw_campaign_channels": r"""
        SELECT CAST(row_number() OVER (ORDER BY event_type) AS STRING) AS channel_id,
        event_type AS channel_name FROM (SELECT DISTINCT event_type FROM events) e
    """,
}


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read from the file once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def tables_of(sql: str) -> list[str]:
    """Given tables a recipe reads."""
    return [t for t in TABLES if re.search(rf"\b(?:FROM|JOIN)\s+{t}\b", sql, re.I)]


def spark_select(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run a SELECT over the given tables."""
    used = tables_of(sql)
    text = sql.replace("\\", "\\\\").replace("AS TIMESTAMP)", "AS TIMESTAMP_NTZ)")
    for t in used:
        text = re.sub(rf"\b(FROM|JOIN)\s+{t}\b", rf"\1 {{{t}}}", text, flags=re.I)
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in used})


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A raw input by its short name, e.g. ``sales``."""
    return spark_select(spark, sf_dir, RECIPES[f"raw_{name}"])

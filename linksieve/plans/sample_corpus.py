"""Labelled URL tables derived from the test tables.

The test data has no labelled URLs, so order (or line item) keys are spelled out
as URLs of many shapes. The SQL text is portable: Spark and DuckDB run the same
string and give the same rows. The labels are synthetic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_TEMPLATE = """
SELECT {row_id} AS row_id,
  CASE WHEN {key} % 101 = 0 THEN NULL WHEN {key} % 103 = 0 THEN 'http://' ELSE concat(
    CASE {order} % 4 WHEN 0 THEN 'http://' WHEN 1 THEN 'HTTPS://' WHEN 2 THEN '' ELSE 'ftp://' END,
    CASE {key} % 16
      WHEN 0 THEN concat('paypal-secure-login', cast({key} AS string), '.verify-account.top')
      WHEN 1 THEN concat('login', cast({key} AS string), '.duckdns.org')
      WHEN 2 THEN concat('192.168.', cast({key} % 300 AS string), '.7:8080')
      WHEN 3 THEN 'bit.ly'
      WHEN 4 THEN concat('xn--e1afmkfd', cast({key} AS string), '.xn--p1ai')
      WHEN 5 THEN concat(substr(md5(cast({key} AS string)), 1, 12), '.xyz')
      WHEN 6 THEN concat('apple.com@evil', cast({key} AS string), '.tk')
      WHEN 7 THEN concat('WWW.Shop', cast({key} AS string), '.CO.UK')
      WHEN 8 THEN 'en.wikipedia.org'
      WHEN 9 THEN 'github.com'
      WHEN 10 THEN 'пример.рф'
      WHEN 11 THEN 'sites.google.com'
      WHEN 12 THEN concat('pineapple', cast({key} AS string), '.com')
      WHEN 13 THEN '0x7f000001'
      WHEN 14 THEN 'paypal.com'
      ELSE '[::1]' END,
    CASE {key} % 7
      WHEN 0 THEN ''
      WHEN 1 THEN concat('/signin/update?cmd=login&id=', cast({key} AS string))
      WHEN 2 THEN concat('/wiki/CamelCase_', cast({key} AS string), '#top')
      WHEN 3 THEN '/a//redirect//x.zip'
      WHEN 4 THEN concat('/%2Flogin%2F', cast({key} AS string))
      WHEN 5 THEN concat('/', md5(cast({key} AS string)))
      ELSE '/files/setup.exe' END,
    CASE {order} % 3 WHEN 0 THEN '' WHEN 1 THEN '/' ELSE '//' END) END AS url,
  CASE WHEN ({key} % 16 < 7) <> ({order} % 97 = 0) THEN 1 ELSE 0 END AS label
FROM {table}
"""

ORDERS_SQL = _TEMPLATE.format(
    row_id="o_orderkey", key="o_custkey", order="o_orderkey", table="orders"
).strip()
LINEITEM_SQL = _TEMPLATE.format(
    row_id="l_orderkey * 8 + l_linenumber",
    key="(l_orderkey * 7 + l_partkey)",
    order="l_orderkey",
    table="lineitem",
).strip()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _dealt(keys: DataFrame, *by: str) -> DataFrame:
    """Key columns dealt out over all cores. A test table may be one row group and so one task, in which
    its URLs would all be spelled out; real tables have many and need no such step."""
    return keys.repartition(keys.sparkSession.sparkContext.defaultParallelism, *by)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id, url`` of the crawled pages."""
    return _dealt(table(spark, sf_dir, "pages").select("page_id", "url"), "page_id")


def raw_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``row_id, url, label``: one row per order."""
    sql = ORDERS_SQL.replace("FROM orders", "FROM {orders}")
    keys = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return spark.sql(sql, orders=_dealt(keys, "o_orderkey"))


def many_raw_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``row_id, url, label``: one row per line item, nearly all URLs distinct."""
    sql = LINEITEM_SQL.replace("FROM lineitem", "FROM {lineitem}")
    keys = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return spark.sql(sql, lineitem=_dealt(keys, "l_orderkey", "l_linenumber"))

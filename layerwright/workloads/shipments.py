"""The same operators over ``lineitem`` and ``orders``, the largest tables, by shipping month."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.measures import mean, total
from ..operators import contracts, joins, marts, silver
from .oracle_base import half_up, mean as sql_mean, total as sql_total

LINE_KEY = ("l_orderkey", "l_linenumber")
MONTH = ("ship_year", "ship_month")


def _lines(spark, sf):
    return spark.read.parquet(f"{sf}/lineitem.parquet")


def _monthly(spark, sf):
    return _lines(spark, sf).selectExpr("*", "year(l_shipdate) AS ship_year", "month(l_shipdate) AS ship_month")


def lineitem_dedup_latest(spark, sf):
    """The line shipped last of each order and line number."""
    lines = _lines(spark, sf)
    content = [c for c in lines.columns if c not in (*LINE_KEY, "l_shipdate")]
    return silver.keep_first(lines, LINE_KEY, ("l_shipdate", *content))


def lineitem_dedup_counts(spark, sf):
    return silver.dedup_counts(_lines(spark, sf), LINE_KEY)


def lineitem_duplicate_keys(spark, sf):
    return contracts.duplicate_keys(_lines(spark, sf), LINE_KEY)


def lineitem_month_health(spark, sf):
    return marts.health_by(
        _monthly(spark, sf),
        by=MONTH,
        distinct={"distinct_parts": "l_partkey", "distinct_suppliers": "l_suppkey"},
        sums={"total_price": "l_extendedprice"},
        means={"avg_quantity": "l_quantity", "avg_price": "l_extendedprice"},
        span=("l_shipdate", "earliest_ship", "latest_ship"),
        flags={"untaxed_rows": "l_tax = 0", "undiscounted_rows": "l_discount = 0"},
    )


def lineitem_flag_mix(spark, sf):
    """Lines and money per shipping month and return flag, with the flag's share of the month."""
    per_flag = marts.grouped(
        _monthly(spark, sf),
        (*MONTH, "l_returnflag"),
        line_count="count(*)",
        total_price=total("l_extendedprice"),
        avg_quantity=mean("l_quantity"),
    )
    return marts.with_share(per_flag, MONTH, "line_count", "month_lines", "share_pct")


def lineitem_daily_supplier(spark, sf):
    """Lines, money and distinct return flags per shipping date and supplier."""
    return marts.grouped(
        _lines(spark, sf).selectExpr("*", "to_date(l_shipdate) AS ship_date"),
        ("ship_date", "l_suppkey"),
        lines="count(*)",
        total_price=total("l_extendedprice"),
        avg_price=mean("l_extendedprice"),
        flag_count="count(DISTINCT l_returnflag)",
    )


def orders_upsert(spark, sf):
    """Orders with those still open replaced by rows marked as pending."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    pending = orders.where(F.col("o_orderstatus") == "O").withColumn("o_orderstatus", F.lit("PENDING"))
    return joins.upsert(orders, pending, ("o_orderkey",))


def orders_without_lines(spark, sf):
    """Orders no line refers to."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    lines = _lines(spark, sf).select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.anti_join_nullsafe(orders, lines, ("o_orderkey",))


QUERIES = {
    "lineitem_dedup_latest": lineitem_dedup_latest,
    "lineitem_dedup_counts": lineitem_dedup_counts,
    "lineitem_duplicate_keys": lineitem_duplicate_keys,
    "lineitem_month_health": lineitem_month_health,
    "lineitem_flag_mix": lineitem_flag_mix,
    "lineitem_daily_supplier": lineitem_daily_supplier,
    "orders_upsert": orders_upsert,
    "orders_without_lines": orders_without_lines,
}

_MONTHLY = """monthly AS (
  SELECT *, CAST(year(l_shipdate) AS INTEGER) AS ship_year, CAST(month(l_shipdate) AS INTEGER) AS ship_month
  FROM lineitem)"""

ORACLES = {
    "lineitem_dedup_latest": """SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
        l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
        l_linestatus DESC) AS rn FROM lineitem) WHERE rn = 1""",
    "lineitem_dedup_counts": """SELECT count(*) AS rows_in, count(DISTINCT (l_orderkey, l_linenumber)) AS rows_out,
      count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicates FROM lineitem""",
    "lineitem_duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
      GROUP BY ALL HAVING count(*) > 1""",
    "lineitem_month_health": f"""WITH {_MONTHLY}
      SELECT ship_year, ship_month, count(*) AS total_rows, {sql_total('l_extendedprice')} AS total_price,
        {sql_mean('l_quantity')} AS avg_quantity, {sql_mean('l_extendedprice')} AS avg_price,
        min(l_shipdate) AS earliest_ship, max(l_shipdate) AS latest_ship, count(DISTINCT l_partkey) AS distinct_parts,
        count(DISTINCT l_suppkey) AS distinct_suppliers, count(*) FILTER (l_tax = 0) AS untaxed_rows,
        count(*) FILTER (l_discount = 0) AS undiscounted_rows
      FROM monthly GROUP BY ship_year, ship_month""",
    "lineitem_flag_mix": f"""WITH {_MONTHLY}, grouped AS (
      SELECT ship_year, ship_month, l_returnflag, count(*) AS line_count, {sql_total('l_extendedprice')} AS total_price,
        {sql_mean('l_quantity')} AS avg_quantity FROM monthly GROUP BY ALL), totalled AS (
      SELECT *, CAST(sum(line_count) OVER (PARTITION BY ship_year, ship_month) AS BIGINT) AS month_lines FROM grouped)
      SELECT *, CAST({half_up('line_count * 10000', 'month_lines')} AS DOUBLE) / 100 AS share_pct FROM totalled""",
    "lineitem_daily_supplier": f"""SELECT CAST(l_shipdate AS DATE) AS ship_date, l_suppkey, count(*) AS lines,
        {sql_total('l_extendedprice')} AS total_price, {sql_mean('l_extendedprice')} AS avg_price,
        count(DISTINCT l_returnflag) AS flag_count FROM lineitem GROUP BY ALL""",
    "orders_upsert": """SELECT * REPLACE (CASE WHEN o_orderstatus = 'O' THEN 'PENDING' ELSE o_orderstatus END
      AS o_orderstatus) FROM orders""",
    "orders_without_lines": "SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
}

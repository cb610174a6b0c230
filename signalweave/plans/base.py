"""Registry of queries and the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _wide(df: DataFrame) -> DataFrame:
    """Integers of any width as bigint, so that both engines agree on the schema."""
    small = [c for c, t in df.dtypes if t in ("int", "smallint", "tinyint")]
    return df.withColumns({c: F.col(c).cast("bigint") for c in small}) if small else df


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: _wide(f(spark, sf_dir))
        if sql is not None:
            SQL[name] = sql.strip()
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales lines as (industry, area, yr, q, amount, okey, supp, part, ship day); amounts are exact decimals."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate", "l_returnflag")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    amount = F.col("l_extendedprice").cast("decimal(12,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    return (
        li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("p_brand").alias("industry"),
            F.col("o_orderpriority").alias("area"),
            F.year("o_orderdate").alias("yr"),
            F.quarter("o_orderdate").alias("q"),
            amount.cast("decimal(20,4)").alias("amount"),
            F.col("l_orderkey").alias("okey"),
            F.col("l_linenumber").alias("line"),
            F.col("l_suppkey").alias("supp"),
            F.col("o_custkey").alias("cust"),
            F.col("l_quantity").alias("qty"),
            F.to_date("l_shipdate").alias("ship_day"),
            F.col("l_returnflag").alias("flag"),
            F.col("o_orderstatus").alias("status"),
        )
    )


FACTS = """facts AS (
  SELECT p_brand AS industry, o_orderpriority AS area, year(o_orderdate) AS yr, quarter(o_orderdate) AS q,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(20,4)) AS amount,
    l_orderkey AS okey, l_linenumber AS line, l_suppkey AS supp, o_custkey AS cust, l_quantity AS qty,
    CAST(l_shipdate AS DATE) AS ship_day, l_returnflag AS flag, o_orderstatus AS status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

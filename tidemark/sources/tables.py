"""Readers for the driver tables and the ``transactions`` fixture view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# The bank-transaction table derived from orders, customer and nation. The same
# text parses in Spark SQL and in DuckDB, so it is also the oracle's input.
BASE_SQL = """base AS (
  SELECT o.o_orderkey AS Transaction_ID, o.o_custkey AS Customer_ID, o.o_orderdate AS Transaction_Date,
    CASE WHEN o.o_orderkey % 20 = 0 THEN NULL
         WHEN o.o_orderkey % 211 = 0 THEN -o.o_totalprice ELSE o.o_totalprice END AS Transaction_Amount,
    c.c_acctbal AS Account_Balance,
    CASE WHEN o.o_orderkey % 35 = 3 THEN NULL ELSE CAST(o.o_custkey % 125 AS INT) END AS Age,
    o.o_orderstatus AS Transaction_Type, o.o_orderpriority AS Merchant_Category,
    CASE WHEN o.o_orderkey % 40 = 1 THEN NULL
         WHEN o.o_orderkey % 3 = 0 THEN 'Laptop' ELSE 'Smartphone' END AS Device_Type,
    c.c_mktsegment AS Account_Type, n.n_name AS State,
    CASE WHEN o.o_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS Gender,
    CASE WHEN o.o_orderkey % 5 < 2 THEN NULL ELSE n.n_name END AS Bank_Branch,
    CAST(CASE WHEN o.o_totalprice > 450000 AND o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS INT) AS Is_Fraud
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
                JOIN nation n ON c.c_nationkey = n.n_nationkey)"""
TRANSACTIONS_SQL = f"""
WITH {BASE_SQL}
SELECT * FROM base UNION ALL SELECT * FROM base WHERE Transaction_ID % 50 = 7
"""


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_tables(spark: SparkSession, sf_dir: str, names=("orders", "customer", "nation")) -> None:
    for name in names:
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture view. orders is the fact side; customer/nation are dimensions
    (Catalyst broadcasts them when their measured size is under the threshold,
    otherwise it shuffles both sides)."""
    register_tables(spark, sf_dir)
    return spark.sql(TRANSACTIONS_SQL)

"""Joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions import align_keys
from tillroll.operators import left_join, left_join_batch
from tillroll.registry import standins
from tillroll.registry.base import as_text, query, table
from tillroll.session import shared_folder
from tillroll.sinks import PathWarehouse


@query(
    "join_inner",
    """
    SELECT c_custkey, n_name, r_name
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    """,
)
def join_inner(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer")
    nations, regions = table(spark, sf, "nation"), table(spark, sf, "region")
    return (
        customers.join(nations, customers.c_nationkey == nations.n_nationkey, "inner")
        .join(regions, nations.n_regionkey == regions.r_regionkey, "inner")
        .select("c_custkey", "n_name", "r_name")
    )


@query(
    "join_left",
    """
    SELECT o_orderkey, o_orderstatus, l_linenumber, l_returnflag
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
    """,
)
def join_left(spark: SparkSession, sf: str) -> DataFrame:
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    return left_join(orders, lines, "o_orderkey", "l_orderkey").select(
        "o_orderkey", "o_orderstatus", "l_linenumber", "l_returnflag"
    )


@query(
    "join_left_unmatched",
    """
    SELECT d.doc_id, d.lang, l.quality, l.toxic
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    """,
)
def join_left_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "lang")
    labels = table(spark, sf, "labels").withColumnRenamed("doc_id", "labelled_id")
    return left_join(documents, labels, "doc_id", "labelled_id").drop("labelled_id")


CHAIN_SQL = """
    SELECT o_orderkey, l_linenumber, s_suppkey, s_name
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
    LEFT JOIN supplier ON l_suppkey = s_suppkey
"""


def _chain(orders: DataFrame, lines: DataFrame, suppliers: DataFrame) -> DataFrame:
    with_lines = left_join(
        orders.select("o_orderkey"),
        lines.select("l_orderkey", "l_linenumber", "l_suppkey"),
        "o_orderkey",
        "l_orderkey",
    )
    return with_lines.join(
        suppliers, with_lines.l_suppkey == suppliers.s_suppkey, "left"
    ).select("o_orderkey", "l_linenumber", "s_suppkey", "s_name")


@query("join_left_chain", CHAIN_SQL)
def join_left_chain(spark: SparkSession, sf: str) -> DataFrame:
    return _chain(*(table(spark, sf, name) for name in ("orders", "lineitem", "supplier")))


@query("join_warehouse_dim", CHAIN_SQL)
def join_warehouse_dim(spark: SparkSession, sf: str) -> DataFrame:
    """The dimension is loaded into the warehouse and read back for the join."""
    warehouse = PathWarehouse(shared_folder(spark, "warehouse"))
    warehouse.overwrite(table(spark, sf, "supplier"), "supplier")
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    return _chain(orders, lines, warehouse.read(spark, "supplier"))


@query(
    "join_mixed_type_key",
    """
    SELECT c_custkey, n_name FROM customer
    JOIN nation ON TRY_CAST(CAST(c_nationkey AS VARCHAR) AS INTEGER) = n_nationkey
    """,
)
def join_mixed_type_key(spark: SparkSession, sf: str) -> DataFrame:
    customers, nations = as_text(table(spark, sf, "customer")), table(spark, sf, "nation")
    left_key, right_key = align_keys(customers, "c_nationkey", nations, "n_nationkey")
    return customers.join(nations, left_key == right_key, "inner").select(
        F.col("c_custkey").try_cast("bigint").alias("c_custkey"), "n_name"
    )


@query(
    "filter_post_join_null_tolerant",
    """
    SELECT o_orderkey, l_linenumber, l_returnflag
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
    WHERE year(o_orderdate) = 1998 AND (year(l_shipdate) = 1998 OR l_shipdate IS NULL)
    """,
)
def filter_post_join_null_tolerant(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").filter(standins.in_year("o_orderdate", 1998))
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        standins.year_day("l_shipdate").alias("rec_ins_dt"),
    )
    joined = left_join_batch(
        orders, lines, "o_orderkey", "l_orderkey", "rec_ins_dt", "1998-01-01"
    )
    return joined.select("o_orderkey", "l_linenumber", "l_returnflag")

"""The test tables in the shape of the pipeline's four sources.

Each function has a counterpart in SQL, used by the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.plans.schemas import ADDRESS_FIELDS
from tillroll.registry.base import table


def year_day(timestamp: str) -> Column:
    """The first day of the year, as the load date of a yearly batch."""
    return F.make_date(F.year(timestamp), F.lit(1), F.lit(1))


def in_year(timestamp: str, year: int) -> Column:
    """A range of the column itself, which the scan can check against its statistics."""
    start, end = (F.lit(f"{y}-01-01").cast("timestamp_ntz") for y in (year, year + 1))
    return (F.col(timestamp) >= start) & (F.col(timestamp) < end)


def order_transactions(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as transactions, in yearly batches."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("App_Transaction_Id"),
        F.col("o_orderdate").alias("ACTIVITY_TIMESTAMP"),
        F.col("o_custkey").alias("TRANSACTION_POINT_VALUE"),
        F.col("o_totalprice").alias("TRANSACTION_RETAIL_VALUE"),
        F.col("o_orderpriority").alias("TRANSACTION_EXTERNAL_REFERENCE"),
        year_day("o_orderdate").alias("ins_dt"),
    )


def event_transactions(spark: SparkSession, sf: str) -> DataFrame:
    """Events as transactions with a time of day, not yet staged."""
    return table(spark, sf, "events").select(
        F.col("event_id").alias("App_Transaction_Id"),
        F.col("ts").alias("ACTIVITY_TIMESTAMP"),
        F.col("user_id").alias("TRANSACTION_POINT_VALUE"),
        F.col("value").alias("TRANSACTION_RETAIL_VALUE"),
        F.col("event_type").alias("TRANSACTION_EXTERNAL_REFERENCE"),
    )


def receipts(
    spark: SparkSession, sf: str, loyalty: str = "l_suppkey", dated: bool = True
) -> DataFrame:
    """Line items with their part as receipts, all text; in yearly batches unless not dated."""
    lines = table(spark, sf, "lineitem")
    parts = table(spark, sf, "part")
    joined = lines.join(parts, lines.l_partkey == parts.p_partkey, "inner")
    rows = joined.select(
        F.col("l_orderkey").cast("string").alias("SBLP_TRANSACTION_ID"),
        F.col(loyalty).cast("string").alias("LOYALTY_ID"),
        F.replace(F.col("p_name"), F.lit(" "), F.lit(",")).alias("PRODUCTS"),
        F.col("l_linenumber").cast("string").alias("BASE_POINT_VALUE"),
        F.col("l_suppkey").cast("string").alias("MOBILE_UID"),
        F.col("l_returnflag").alias("MOBILE_OS"),
        F.col("l_linestatus").alias("RECEIPT_STATUS"),
        F.col("l_partkey").cast("string").alias("MSG_CODE"),
        year_day("l_shipdate").alias("ins_dt"),
    )
    return rows if dated else rows.drop("ins_dt")


def supplier_registrations(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as registered consumers."""
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("CNSM_ID"), F.col("s_name").alias("REGIS_CITY")
    )


def customer_consumers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as consumers whose address is that of their nation, in one batch."""
    return table(spark, sf, "customer").select(
        F.col("c_nationkey").cast("string").alias("REGIS_CNSM_ID"),
        F.col("c_nationkey").cast("string").alias("REGIS_CTY_CODE"),
        F.col("c_custkey").cast("string").alias("REGIS_ID"),
        F.col("c_name").alias("REGIS_LTY_ID"),
        F.lit("2021-07-25").alias("REGIS_DATE"),
        F.col("c_mktsegment").alias("REGIS_CHANNEL"),
        F.lit(None).cast("string").alias("REGIS_GENDER"),
        F.col("c_mktsegment").alias("REGIS_CITY"),
        F.lit("2021-07-25").cast("date").alias("ins_dt"),
    )


def nation_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Nations as address documents."""
    nations, regions = table(spark, sf, "nation"), table(spark, sf, "region")
    return nations.join(regions, nations.n_regionkey == regions.r_regionkey, "inner").select(
        F.concat(F.lit("doc-"), F.col("n_nationkey")).alias("_id"),
        F.col("n_nationkey").alias("consumer_id"),
        address("n_name", "r_name", F.col("n_regionkey").cast("string")),
    )


def address(*parts: str | Column) -> Column:
    """The nested address of a document."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.struct(*(c.alias(f) for c, f in zip(columns, ADDRESS_FIELDS))).alias("address")


def line_consumers(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as a consumer extract: a part is a consumer, its suppliers are the children.

    A consumer comes back on many rows, and parts beyond the last customer have no address.
    """
    lines, parts = table(spark, sf, "lineitem"), table(spark, sf, "part")
    return lines.join(parts, lines.l_partkey == parts.p_partkey, "inner").select(
        F.col("l_partkey").cast("string").alias("REGIS_CNSM_ID"),
        F.col("p_size").cast("string").alias("REGIS_CTY_CODE"),
        F.col("p_partkey").cast("string").alias("REGIS_ID"),
        F.col("p_name").alias("REGIS_LTY_ID"),
        F.col("l_returnflag").alias("REGIS_DATE"),
        F.col("p_brand").alias("REGIS_CHANNEL"),
        F.col("l_linestatus").alias("REGIS_GENDER"),
        F.col("p_type").alias("REGIS_CITY"),
        F.col("l_suppkey").cast("string").alias("CHILD_ID"),
        F.col("l_linenumber").cast("string").alias("CHILD_NB"),
        F.col("l_returnflag").alias("CHILD_GENDER"),
        year_day("l_shipdate").alias("ins_dt"),
    )


def order_consumers(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their customer as a consumer extract: an order is a child. Not yet staged."""
    orders, customers = table(spark, sf, "orders"), table(spark, sf, "customer")
    return orders.join(customers, orders.o_custkey == customers.c_custkey, "inner").select(
        F.col("o_custkey").cast("string").alias("REGIS_CNSM_ID"),
        F.col("c_nationkey").cast("string").alias("REGIS_CTY_CODE"),
        F.col("c_custkey").cast("string").alias("REGIS_ID"),
        F.col("c_name").alias("REGIS_LTY_ID"),
        F.lit("2021-07-25").alias("REGIS_DATE"),
        F.col("c_mktsegment").alias("REGIS_CHANNEL"),
        F.lit(None).cast("string").alias("REGIS_GENDER"),
        F.col("c_mktsegment").alias("REGIS_CITY"),
        F.col("o_orderkey").cast("string").alias("CHILD_ID"),
        F.col("o_orderstatus").alias("CHILD_NB"),
        F.col("o_orderpriority").alias("CHILD_GENDER"),
    )


def order_children(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their line items as children; an order without lines has none."""
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left").select(
        F.col("o_custkey").alias("REGIS_CNSM_ID"),
        F.col("o_orderstatus").alias("REGIS_CTY_CODE"),
        F.col("l_linenumber").alias("CHILD_ID"),
        F.col("l_returnflag").alias("CHILD_NB"),
        F.col("l_linestatus").alias("CHILD_GENDER"),
        year_day("o_orderdate").alias("ins_dt"),
    )


def customer_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with their nation and region as address documents."""
    customers = table(spark, sf, "customer")
    nations, regions = table(spark, sf, "nation"), table(spark, sf, "region")
    return (
        customers.join(nations, customers.c_nationkey == nations.n_nationkey, "inner")
        .join(regions, nations.n_regionkey == regions.r_regionkey, "inner")
        .select(
            F.concat(F.lit("doc-"), F.col("c_custkey")).alias("_id"),
            F.col("c_custkey").cast("string").alias("consumer_id"),
            address("c_name", "n_name", "r_name"),
        )
    )

"""Projections, casts, filters, DISTINCT, scalar functions and surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions import (
    date_literal,
    drop_columns,
    flatten_struct,
    item_count,
    null_on_error,
    null_or_marker,
    time_parts,
    with_batch_date,
)
from tillroll.operators import dense_key, left_join, unique_key
from tillroll.plans.schemas import ADDRESS_FIELDS
from tillroll.registry import standins
from tillroll.registry.base import query, table
from tillroll.session import shared_folder
from tillroll.sinks import stage
from tillroll.sources import read_staged


@query("proj_batch_date", "SELECT *, DATE '2021-07-25' AS ins_dt FROM orders")
def proj_batch_date(spark: SparkSession, sf: str) -> DataFrame:
    return with_batch_date(table(spark, sf, "orders"), "2021-07-25")


@query(
    "proj_flatten_struct",
    """
    SELECT 'doc-' || n_nationkey AS _id, n_nationkey AS consumer_id, n_name AS street,
           r_name AS city, CAST(n_regionkey AS VARCHAR) AS state
    FROM nation JOIN region ON n_regionkey = r_regionkey
    """,
)
def proj_flatten_struct(spark: SparkSession, sf: str) -> DataFrame:
    once = flatten_struct(standins.nation_documents(spark, sf), "address", ADDRESS_FIELDS)
    return flatten_struct(once, "address", ADDRESS_FIELDS)


@query(
    "proj_flatten_json",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
)
def proj_flatten_json(spark: SparkSession, sf: str) -> DataFrame:
    parsed = table(spark, sf, "events").select(
        "event_id", F.from_json("props", "k int").alias("props")
    )
    return flatten_struct(parsed, "props", ["k"])


@query("proj_drop", "SELECT event_id, ts, user_id, event_type, value FROM events")
def proj_drop(spark: SparkSession, sf: str) -> DataFrame:
    return drop_columns(table(spark, sf, "events"), "props", "_id")


@query(
    "proj_rename",
    "SELECT c_custkey AS CNSM_ID, c_nationkey AS CTY_CODE, c_name AS LTY_ID FROM customer",
)
def proj_rename(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("CNSM_ID"),
        F.col("c_nationkey").alias("CTY_CODE"),
        F.col("c_name").alias("LTY_ID"),
    )


@query(
    "proj_derived_table",
    """
    SELECT d.cust AS CNSM_ID, d.status AS STATUS FROM
      (SELECT DISTINCT o_custkey AS cust, o_orderstatus AS status FROM orders) d
    """,
)
def proj_derived_table(spark: SparkSession, sf: str) -> DataFrame:
    derived = (
        table(spark, sf, "orders")
        .select(F.col("o_custkey").alias("cust"), F.col("o_orderstatus").alias("status"))
        .distinct()
    )
    return derived.select(F.col("cust").alias("CNSM_ID"), F.col("status").alias("STATUS"))


@query(
    "proj_constants",
    """
    SELECT o_orderkey, 0 AS std_ccy, -1 AS ccy_type_key, '-1' AS chnl_key,
           CAST(NULL AS DECIMAL(18,2)) AS ext_dec_1, '@NULL@' AS ext_dec_2
    FROM orders
    """,
)
def proj_constants(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.lit(0).alias("std_ccy"),
        F.lit(-1).alias("ccy_type_key"),
        F.lit("-1").alias("chnl_key"),
        null_or_marker(None, "decimal(18,2)").alias("ext_dec_1"),
        null_or_marker("@NULL@", "decimal(18,2)").alias("ext_dec_2"),
    )


@query(
    "proj_case_insensitive",
    "SELECT n_nationkey, n_name AS City FROM nation WHERE n_regionkey IS NOT NULL",
)
def proj_case_insensitive(spark: SparkSession, sf: str) -> DataFrame:
    nations = table(spark, sf, "nation").withColumnRenamed("N_NAME", "city")
    return nations.filter(F.col("N_RegionKey").isNotNull()).select(
        "n_nationkey", F.col("CITY").alias("City")
    )


@query("cast_named", "SELECT CAST(c_nationkey AS SMALLINT) AS c_nationkey, c_name FROM customer")
def cast_named(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(F.col("c_nationkey").cast("smallint"), "c_name")


@query(
    "cast_smallint",
    """
    SELECT c_custkey, CAST(c_nationkey AS SMALLINT) AS cty_code,
           TRY_CAST(CAST(c_custkey * 100 AS VARCHAR) AS SMALLINT) AS may_overflow,
           TRY_CAST(c_mktsegment AS SMALLINT) AS not_a_number
    FROM customer
    """,
)
def cast_smallint(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        "c_custkey",
        null_on_error(F.col("c_nationkey").cast("string"), "smallint").alias("cty_code"),
        null_on_error((F.col("c_custkey") * 100).cast("string"), "smallint").alias(
            "may_overflow"
        ),
        null_on_error("c_mktsegment", "smallint").alias("not_a_number"),
    )


@query(
    "cast_integer",
    """
    SELECT c_custkey, TRY_CAST(CAST(c_custkey * 10000000 AS VARCHAR) AS INTEGER) AS may_overflow,
           TRY_CAST(split_part(c_name, '#', 2) AS INTEGER) AS regis_id,
           TRY_CAST(c_name AS INTEGER) AS not_a_number
    FROM customer
    """,
)
def cast_integer(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        "c_custkey",
        null_on_error((F.col("c_custkey") * 10000000).cast("string"), "int").alias(
            "may_overflow"
        ),
        null_on_error(F.split_part("c_name", F.lit("#"), F.lit(2)), "int").alias("regis_id"),
        null_on_error("c_name", "int").alias("not_a_number"),
    )


@query(
    "cast_bigint",
    """
    SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS msg_code,
           TRY_CAST(event_type AS BIGINT) AS not_a_number
    FROM events
    """,
)
def cast_bigint(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id",
        null_on_error(F.get_json_object("props", "$.k"), "bigint").alias("msg_code"),
        null_on_error("event_type", "bigint").alias("not_a_number"),
    )


@query("cast_string", "SELECT CAST(o_orderkey AS VARCHAR) AS txn_id FROM orders")
def cast_string(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("txn_id"))


@query("cast_ts_to_date", "SELECT event_id, CAST(ts AS DATE) AS txn_dt_key FROM events")
def cast_ts_to_date(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id", F.col("ts").cast("date").alias("txn_dt_key")
    )


@query(
    "filter_batch_date",
    """
    SELECT event_id, user_id, CAST(ts AS DATE) AS ins_dt FROM events
    WHERE CAST(ts AS DATE) = (SELECT MIN(CAST(ts AS DATE)) FROM events)
    """,
)
def filter_batch_date(spark: SparkSession, sf: str) -> DataFrame:
    """One load date of staged events: only its partition is read."""
    events, path = table(spark, sf, "events"), shared_folder(spark, "staged")
    day = events.agg(F.min(F.to_date("ts"))).first()[0]
    stage(events.withColumn("ins_dt", F.to_date("ts")), path, many_dates=True)
    staged = read_staged(spark, path, events.schema)
    return staged.filter(F.col("ins_dt") == date_literal(day)).select(
        "event_id", "user_id", "ins_dt"
    )


@query(
    "filter_not_null",
    """
    SELECT o_orderkey, l_linenumber FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
    WHERE l_linenumber IS NOT NULL
    """,
)
def filter_not_null(spark: SparkSession, sf: str) -> DataFrame:
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    joined = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
    return joined.filter(F.col("l_linenumber").isNotNull()).select("o_orderkey", "l_linenumber")


@query(
    "filter_and",
    """
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE year(o_orderdate) = 1998 AND o_orderstatus IS NOT NULL
    """,
)
def filter_and(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "orders")
        .filter(standins.in_year("o_orderdate", 1998) & F.col("o_orderstatus").isNotNull())
        .select("o_orderkey", "o_orderdate")
    )


@query(
    "distinct_after_join",
    """
    SELECT DISTINCT c_mktsegment, n_name, n_regionkey
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    """,
)
def distinct_after_join(spark: SparkSession, sf: str) -> DataFrame:
    customers, nations = table(spark, sf, "customer"), table(spark, sf, "nation")
    joined = customers.join(nations, customers.c_nationkey == nations.n_nationkey, "inner")
    return joined.select("c_mktsegment", "n_name", "n_regionkey").distinct()


@query(
    "distinct_multi",
    """
    SELECT DISTINCT o_custkey, o_orderstatus, l_linenumber, l_returnflag, l_linestatus
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
    """,
)
def distinct_multi(spark: SparkSession, sf: str) -> DataFrame:
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    joined = left_join(orders, lines, "o_orderkey", "l_orderkey")
    return joined.select(
        "o_custkey", "o_orderstatus", "l_linenumber", "l_returnflag", "l_linestatus"
    ).distinct()


@query(
    "fn_split_size",
    """
    SELECT p_partkey, CAST(len(string_split(p_name, ' ')) AS INTEGER) AS item_qty FROM part
    """,
)
def fn_split_size(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        "p_partkey", item_count("p_name", pattern=" ").alias("item_qty")
    )


@query(
    "fn_split_size_documents",
    """
    SELECT doc_id, CAST(len(string_split(text, ',')) AS INTEGER) AS item_qty FROM documents
    """,
)
def fn_split_size_documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", item_count("text").alias("item_qty"))


@query(
    "fn_time_parts",
    """
    SELECT event_id, CAST(hour(ts) AS INTEGER) AS txn_tm_hour,
           CAST(minute(ts) AS INTEGER) AS txn_tm_minute,
           CAST(second(ts) AS INTEGER) AS txn_tm_second
    FROM events
    """,
)
def fn_time_parts(spark: SparkSession, sf: str) -> DataFrame:
    parts = time_parts("ts")
    return table(spark, sf, "events").select(
        "event_id", *(column.alias(f"txn_tm_{name}") for name, column in parts.items())
    )


def key_facts(df: DataFrame, key: str) -> DataFrame:
    """What can be said of a key whatever its values are."""
    return df.agg(
        F.count(key).alias("n_rows"),
        F.count_distinct(F.col(key)).alias("n_keys"),
        F.min(key).alias("min_key"),
        F.max(key).alias("max_key"),
    )


DENSE_FACTS = """
    SELECT COUNT(*) AS n_rows, COUNT(*) AS n_keys, CAST(1 AS BIGINT) AS min_key,
           COUNT(*) AS max_key
    FROM ({rows})
"""

UNIQUE_FACTS = "SELECT COUNT(*) AS n_rows, COUNT(*) AS n_keys FROM ({rows})"


@query("surrogate_unique", UNIQUE_FACTS.format(rows="SELECT * FROM orders"))
def surrogate_unique(spark: SparkSession, sf: str) -> DataFrame:
    keyed = unique_key(table(spark, sf, "orders"), "txn_key")
    return key_facts(keyed, "txn_key").select("n_rows", "n_keys")


@query(
    "surrogate_dense", DENSE_FACTS.format(rows="SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
)
def surrogate_dense(spark: SparkSession, sf: str) -> DataFrame:
    pairs = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct()
    return key_facts(dense_key(pairs, "pair_key", unique=True), "pair_key")


@query(
    "surrogate_dense_values",
    """
    WITH placed AS (
      SELECT l_partkey, l_suppkey, (l_partkey * 31 + l_suppkey) % 4096 AS b
      FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)
    )
    SELECT CAST(row_number() OVER (ORDER BY b, l_partkey, l_suppkey) AS BIGINT) AS pair_key,
           l_partkey, l_suppkey
    FROM placed
    """,
)
def surrogate_dense_values(spark: SparkSession, sf: str) -> DataFrame:
    """With buckets that SQL can name too, the keys themselves can be compared."""
    pairs = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct()
    bucket = F.col("l_partkey") * 31 + F.col("l_suppkey")
    return dense_key(pairs, "pair_key", unique=True, bucket=bucket)


@query(
    "surrogate_dense_copies",
    """
    WITH counted AS (
      SELECT o_custkey, o_orderstatus,
             (row_number() OVER (PARTITION BY o_custkey, o_orderstatus) - 1) // 10000 AS part
      FROM orders
    )
    SELECT CAST(row_number() OVER (
             ORDER BY (o_custkey * 31 + part) % 4096, o_custkey, o_orderstatus, part
           ) AS BIGINT) AS row_key, o_custkey, o_orderstatus
    FROM counted
    """,
)
def surrogate_dense_copies(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that repeat get a key each."""
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderstatus")
    return dense_key(rows, "row_key", bucket=F.col("o_custkey") * 31)

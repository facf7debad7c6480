"""Targets and whole jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions import with_batch_date
from tillroll.plans import schemas
from tillroll.plans.jobs import Source, build_targets, run_batch, stage_sources
from tillroll.plans.targets import child_dim, registration_dim, sql_target, transaction_fact
from tillroll.registry import standins
from tillroll.registry.base import query, write_delimited, write_documents
from tillroll.registry.columns import DENSE_FACTS, UNIQUE_FACTS, key_facts
from tillroll.registry.scans import CHILDREN_SQL
from tillroll.session import shared_folder
from tillroll.sinks import PathWarehouse, stage
from tillroll.sources import read_delimited, read_documents, read_staged

BATCH = "2021-07-25"

REGISTRATION_SQL = f"""
    SELECT DISTINCT CAST(c_nationkey AS VARCHAR) AS CNSM_ID,
           CAST(c_nationkey AS SMALLINT) AS CTY_CODE, CAST(c_custkey AS INTEGER) AS REGIS_ID,
           '{BATCH}' AS REGIS_DATE, c_name AS LTY_ID, c_mktsegment AS REGIS_CHANNEL,
           CAST(NULL AS VARCHAR) AS REGIS_GENDER, c_mktsegment AS REGIS_CITY, n_name AS Street,
           r_name AS City, CAST(n_regionkey AS VARCHAR) AS State, DATE '{BATCH}' AS INS_DT
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
"""

EXTRACT_SQL = """
    SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS CNSM_ID, CAST(p_size AS SMALLINT) AS CTY_CODE,
           CAST(p_partkey AS INTEGER) AS REGIS_ID, l_returnflag AS REGIS_DATE, p_name AS LTY_ID,
           p_brand AS REGIS_CHANNEL, l_linestatus AS REGIS_GENDER, p_type AS REGIS_CITY,
           c_name AS Street, n_name AS City, r_name AS State,
           make_date(CAST(year(l_shipdate) AS BIGINT), 1, 1) AS INS_DT
    FROM lineitem JOIN part ON l_partkey = p_partkey
    JOIN customer ON l_partkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""

FACT_SQL = """
    SELECT CAST({id} AS VARCHAR) AS TXN_ID,
           CAST(len(string_split(products, ',')) AS INTEGER) AS TXN_ITEM_QTY,
           {points} AS TXN_LOY_VAL_STD_CCY, 0 AS TXN_GROSS_MNY_STD_CCY,
           {retail} AS TXN_GROSS_MNY_LCL_CCY, -1 AS MNY_LCL_CCY_TYPE_KEY,
           {reference} AS RTL_TXN_TYPE_KEY, {ts} AS TXN_TS, CAST({ts} AS DATE) AS TXN_DT_KEY,
           CAST(hour({ts}) AS INTEGER) AS TXN_TM_HOUR,
           CAST(minute({ts}) AS INTEGER) AS TXN_TM_MINUTE,
           CAST(second({ts}) AS INTEGER) AS TXN_TM_SECOND, '-1' AS CHNL_KEY,
           CAST(known.consumer AS VARCHAR) AS CNSM_ID,
           CAST(NULL AS DECIMAL(18,2)) AS RTL_TXN_EXT_DEC_1,
           CAST(NULL AS DECIMAL(18,2)) AS RTL_TXN_EXT_DEC_2,
           CAST(rec.l_linenumber AS VARCHAR) AS RTL_TXN_EXT_DEC_3,
           CAST(rec.l_suppkey AS VARCHAR) AS RTL_TXN_EXT_CHAR_1,
           rec.l_returnflag AS RTL_TXN_EXT_CHAR_2, rec.products AS RTL_TXN_EXT_CHAR_3,
           rec.l_linestatus AS RTL_TXN_EXT_CHAR_4, rec.l_partkey AS RTL_TXN_EXT_CHAR_5,
           DATE '{batch}' AS INS_DT
    FROM {transactions}
    LEFT JOIN (SELECT lineitem.*, replace(p_name, ' ', ',') AS products
               FROM lineitem JOIN part ON l_partkey = p_partkey) rec ON {id} = rec.l_orderkey
    LEFT JOIN ({consumers}) known ON rec.{loyalty} = known.consumer
    {where}
"""

ORDER_FACT_SQL = FACT_SQL.format(
    id="o_orderkey", points="o_custkey", retail="o_totalprice", reference="o_orderpriority",
    ts="o_orderdate", transactions="orders", consumers="SELECT s_suppkey AS consumer FROM supplier",
    loyalty="l_suppkey", batch="1998-01-01",
    where="""WHERE year(o_orderdate) = 1998
      AND (year(rec.l_shipdate) = 1998 OR rec.l_shipdate IS NULL)""",
)

EVENT_COLUMNS = dict(
    id="event_id", points="user_id", retail="value", reference="event_type", ts="ts",
    transactions="events", batch=BATCH, where="",
)

EVENT_FACT_SQL = FACT_SQL.format(
    consumers="SELECT s_suppkey AS consumer FROM supplier", loyalty="l_suppkey", **EVENT_COLUMNS
)

END_TO_END_SQL = FACT_SQL.format(
    consumers="""SELECT DISTINCT o_custkey AS consumer
                 FROM orders JOIN customer ON o_custkey = c_custkey""",
    loyalty="l_partkey",
    **EVENT_COLUMNS,
)


def _registrations(spark: SparkSession, sf: str) -> DataFrame:
    return registration_dim(
        standins.customer_consumers(spark, sf), standins.nation_documents(spark, sf)
    )


def _extract(spark: SparkSession, sf: str) -> DataFrame:
    return registration_dim(
        standins.line_consumers(spark, sf), standins.customer_documents(spark, sf)
    )


def _children(spark: SparkSession, sf: str) -> DataFrame:
    return child_dim(standins.order_children(spark, sf), "1998-01-01")


def _fact(spark: SparkSession, sf: str, key: str = "unique") -> DataFrame:
    return transaction_fact(
        standins.order_transactions(spark, sf),
        standins.receipts(spark, sf),
        standins.supplier_registrations(spark, sf),
        "1998-01-01",
        key=key,
    )


@query("target_registration_dim", REGISTRATION_SQL)
def target_registration_dim(spark: SparkSession, sf: str) -> DataFrame:
    return _registrations(spark, sf).drop("REGIS_KEY")


@query("target_registration_dim_keys", DENSE_FACTS.format(rows=REGISTRATION_SQL))
def target_registration_dim_keys(spark: SparkSession, sf: str) -> DataFrame:
    return key_facts(_registrations(spark, sf), "REGIS_KEY")


@query("target_registration_dim_extract", EXTRACT_SQL)
def target_registration_dim_extract(spark: SparkSession, sf: str) -> DataFrame:
    """Consumers on many rows, a quarter of them without an address."""
    return _extract(spark, sf).drop("REGIS_KEY")


@query("target_child_dim", CHILDREN_SQL)
def target_child_dim(spark: SparkSession, sf: str) -> DataFrame:
    return _children(spark, sf).drop("CHILD_KEY")


@query("target_child_dim_keys", DENSE_FACTS.format(rows=CHILDREN_SQL))
def target_child_dim_keys(spark: SparkSession, sf: str) -> DataFrame:
    return key_facts(_children(spark, sf), "CHILD_KEY")


@query("target_transaction_fact", ORDER_FACT_SQL)
def target_transaction_fact(spark: SparkSession, sf: str) -> DataFrame:
    return _fact(spark, sf).drop("RTL_TXN_KEY")


@query("target_transaction_fact_keys", UNIQUE_FACTS.format(rows=ORDER_FACT_SQL))
def target_transaction_fact_keys(spark: SparkSession, sf: str) -> DataFrame:
    return key_facts(_fact(spark, sf), "RTL_TXN_KEY").select("n_rows", "n_keys")


@query("target_transaction_fact_dense_keys", DENSE_FACTS.format(rows=ORDER_FACT_SQL))
def target_transaction_fact_dense_keys(spark: SparkSession, sf: str) -> DataFrame:
    return key_facts(_fact(spark, sf, key="dense"), "RTL_TXN_KEY")


@query("target_transaction_fact_events", EVENT_FACT_SQL)
def target_transaction_fact_events(spark: SparkSession, sf: str) -> DataFrame:
    """All events and all receipts in one batch, with a time of day."""
    return transaction_fact(
        with_batch_date(standins.event_transactions(spark, sf), BATCH),
        with_batch_date(standins.receipts(spark, sf, dated=False), BATCH),
        standins.supplier_registrations(spark, sf),
        BATCH,
    ).drop("RTL_TXN_KEY")


@query("job_staged_history_fact", ORDER_FACT_SQL)
def job_staged_history_fact(spark: SparkSession, sf: str) -> DataFrame:
    """The fact of one date from transactions and receipts staged over all years."""
    return history_fact(spark, sf).drop("RTL_TXN_KEY")


def history_fact(spark: SparkSession, sf: str) -> DataFrame:
    frames = {"SB": standins.order_transactions(spark, sf), "OL": standins.receipts(spark, sf)}
    root = shared_folder(spark, "history")
    for name, df in frames.items():
        stage(df, f"{root}/{name}", many_dates=True)
    transactions, receipts = (
        read_staged(spark, f"{root}/{name}", df.drop("ins_dt").schema) for name, df in frames.items()
    )
    return transaction_fact(
        transactions, receipts, standins.supplier_registrations(spark, sf), "1998-01-01"
    )


def _sources(spark: SparkSession, sf: str) -> dict[str, Source]:
    """The four sources as an upstream system leaves them, over the whole tables."""
    landing = write_delimited(
        standins.receipts(spark, sf, loyalty="l_partkey", dated=False), spark, "landing"
    )
    extract = write_delimited(standins.order_consumers(spark, sf), spark, "extract")
    documents = write_documents(standins.customer_documents(spark, sf), spark, "documents")
    return {
        "SB": Source(lambda: standins.event_transactions(spark, sf)),
        "OL": Source(lambda: read_delimited(spark, f"{landing}/*.csv.gz", schemas.RECEIPTS)),
        "CP": Source(lambda: read_delimited(spark, extract, schemas.CONSUMERS)),
        "ADDR": Source(
            lambda: read_documents(spark, documents, schemas.ADDRESSES),
            struct="address",
            fields=schemas.ADDRESS_FIELDS,
            drop=["_id"],
        ),
    }


@query(
    "job_stage_sources",
    f"""
    SELECT 'SB' AS source, CAST(event_id AS VARCHAR) AS id, event_type AS detail,
           DATE '{BATCH}' AS ins_dt FROM events
    UNION ALL
    SELECT 'OL', CAST(l_orderkey AS VARCHAR), replace(p_name, ' ', ','), DATE '{BATCH}'
    FROM lineitem JOIN part ON l_partkey = p_partkey
    UNION ALL
    SELECT 'CP', CAST(o_custkey AS VARCHAR), CAST(o_orderkey AS VARCHAR), DATE '{BATCH}'
    FROM orders JOIN customer ON o_custkey = c_custkey
    UNION ALL
    SELECT 'ADDR', CAST(c_custkey AS VARCHAR), c_name || '/' || n_name || '/' || r_name,
           DATE '{BATCH}'
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    """,
)
def job_stage_sources(spark: SparkSession, sf: str) -> DataFrame:
    paths = stage_sources(_sources(spark, sf), shared_folder(spark, "staging"), BATCH)
    shown = {
        "SB": ("App_Transaction_Id", F.col("TRANSACTION_EXTERNAL_REFERENCE")),
        "OL": ("SBLP_TRANSACTION_ID", F.col("PRODUCTS")),
        "CP": ("REGIS_CNSM_ID", F.col("CHILD_ID")),
        "ADDR": ("consumer_id", F.concat_ws("/", "street", "city", "state")),
    }
    parts = [
        read_staged(spark, paths[name]).select(
            F.lit(name).alias("source"),
            F.col(key).cast("string").alias("id"),
            detail.alias("detail"),
            "ins_dt",
        )
        for name, (key, detail) in shown.items()
    ]
    return reduce(DataFrame.unionByName, parts)


USER_SQL = """
    WITH batch AS (
      SELECT App_Transaction_Id AS id, TRANSACTION_RETAIL_VALUE AS spent
      FROM sb WHERE ins_dt = CAST(:batch_date AS DATE)
    ),
    slips AS (
      SELECT try_cast(SBLP_TRANSACTION_ID AS BIGINT) AS id, LOYALTY_ID AS member,
             size(split(PRODUCTS, ',')) AS items, ins_dt AS received
      FROM ol
    )
    SELECT batch.id, batch.spent, slips.items, regis_dim.REGIS_CITY AS known_as
    FROM batch
    LEFT JOIN slips ON batch.id = slips.id
    LEFT JOIN regis_dim ON slips.member = regis_dim.CNSM_ID
    WHERE slips.received = CAST(:batch_date AS DATE) OR slips.received IS NULL
"""


@query(
    "job_sql_target",
    """
    SELECT o_orderkey AS id, o_totalprice AS spent,
           CAST(len(string_split(p_name, ' ')) AS INTEGER) AS items, s_name AS known_as
    FROM orders
    LEFT JOIN (lineitem JOIN part ON l_partkey = p_partkey) ON o_orderkey = l_orderkey
    LEFT JOIN supplier ON l_suppkey = s_suppkey
    WHERE year(o_orderdate) = 1998 AND (year(l_shipdate) = 1998 OR l_shipdate IS NULL)
    """,
)
def job_sql_target(spark: SparkSession, sf: str) -> DataFrame:
    """SQL text as a user brings it, over views named after the sources."""
    sources = {
        "SB": standins.order_transactions(spark, sf),
        "OL": standins.receipts(spark, sf),
        "REGIS_DIM": standins.supplier_registrations(spark, sf),
    }
    return sql_target(spark, sources, USER_SQL, {"batch_date": "1998-01-01"})


@query("job_end_to_end", END_TO_END_SQL)
def job_end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """Stage, build both dimensions, load them, read one back, build and load the fact."""
    loaded = run_batch(
        spark,
        _sources(spark, sf),
        shared_folder(spark, "staging"),
        PathWarehouse(shared_folder(spark, "warehouse")),
        BATCH,
    )
    return loaded["RTL_TXN_FCT"].drop("RTL_TXN_KEY")


def _dimension(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A dimension as a batch loads it, from the files of an upstream system."""
    sources = _sources(spark, sf)
    staging = shared_folder(spark, "staging")
    stage_sources({source: sources[source] for source in ("CP", "ADDR")}, staging, BATCH)
    warehouse = PathWarehouse(shared_folder(spark, "warehouse"))
    return build_targets(spark, staging, warehouse, BATCH, [name])[name]


@query(
    "job_end_to_end_registrations",
    f"""
    SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS CNSM_ID,
           CAST(c_nationkey AS SMALLINT) AS CTY_CODE, CAST(c_custkey AS INTEGER) AS REGIS_ID,
           '{BATCH}' AS REGIS_DATE, c_name AS LTY_ID, c_mktsegment AS REGIS_CHANNEL,
           CAST(NULL AS VARCHAR) AS REGIS_GENDER, c_mktsegment AS REGIS_CITY, c_name AS Street,
           n_name AS City, r_name AS State, DATE '{BATCH}' AS INS_DT
    FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    """,
)
def job_end_to_end_registrations(spark: SparkSession, sf: str) -> DataFrame:
    return _dimension(spark, sf, "REGIS_DIM").drop("REGIS_KEY")


@query(
    "job_end_to_end_children",
    f"""
    SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS REGIS_CNSM_ID,
           CAST(c_nationkey AS VARCHAR) AS REGIS_CTY_CODE, CAST(o_orderkey AS VARCHAR) AS CHILD_ID,
           o_orderstatus AS CHILD_NB, o_orderpriority AS CHILD_GENDER, DATE '{BATCH}' AS INS_DT
    FROM orders JOIN customer ON o_custkey = c_custkey
    """,
)
def job_end_to_end_children(spark: SparkSession, sf: str) -> DataFrame:
    return _dimension(spark, sf, "CHILD_DIM").drop("CHILD_KEY")

"""Sources, sinks and the preview."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions import flatten_struct, null_on_error, with_batch_date
from tillroll.operators import preview
from tillroll.plans import schemas
from tillroll.plans.targets import child_dim
from tillroll.registry import standins
from tillroll.registry.base import query, table, write_delimited, write_documents
from tillroll.session import one_process, shared_folder
from tillroll.sinks import CatalogWarehouse, JdbcWarehouse, PathWarehouse, stage
from tillroll.sources import (
    read_delimited,
    read_documents,
    read_jdbc_partitioned,
    read_staged,
    text_schema,
)

JDBC_URL_SETTING = "spark.tillroll.jdbc.url"
IN_PROCESS_URL = "jdbc:derby:memory:tillroll;create=true"
IN_PROCESS_DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def database(spark: SparkSession) -> JdbcWarehouse:
    """The database named in the session, or on a local master one inside the process.

    The in-process one is seen by this JVM only, so a cluster has to name its own.
    """
    url = spark.conf.get(JDBC_URL_SETTING, None)
    if url:
        return JdbcWarehouse(url)
    if not one_process(spark):
        raise ValueError(f"set {JDBC_URL_SETTING} to a database all executors reach")
    return JdbcWarehouse(IN_PROCESS_URL, {"driver": IN_PROCESS_DRIVER})


@query("src_jdbc_partitioned", "SELECT * FROM orders")
def src_jdbc_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    db = database(spark)
    db.overwrite(table(spark, sf, "orders"), "src_orders")
    parts = spark.sparkContext.defaultParallelism
    properties = {**db.properties, "preferTimestampNTZ": "true"}
    return read_jdbc_partitioned(spark, db.url, "src_orders", "o_orderkey", parts, properties)


@query("src_jdbc_cuts", "SELECT * FROM lineitem")
def src_jdbc_cuts(spark: SparkSession, sf: str) -> DataFrame:
    """Split at given values of a column whose name Spark wrote in lower case."""
    db = database(spark)
    lines = table(spark, sf, "lineitem")
    db.overwrite(lines, "src_lines")
    parts = spark.sparkContext.defaultParallelism
    shares = [i / parts for i in range(1, parts)]
    cuts = sorted({int(x) for x in lines.approxQuantile("l_orderkey", shares, 0.01)})
    properties = {**db.properties, "preferTimestampNTZ": "true"}
    return read_jdbc_partitioned(
        spark, db.url, "src_lines", "L_ORDERKEY", parts, properties, cuts=cuts
    )


@query("src_delimited_landing", "SELECT * FROM lineitem")
def src_delimited_landing(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    landing = write_delimited(lines, spark, "landing")
    raw = read_delimited(spark, f"{landing}/*.csv.gz", text_schema(lines.columns))
    return raw.select(
        *(null_on_error(f.name, f.dataType).alias(f.name) for f in lines.schema)
    )


@query("src_delimited", "SELECT * FROM customer")
def src_delimited(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer")
    raw = read_delimited(spark, write_delimited(customers, spark, "customer-extract"))
    return raw.select(
        *(null_on_error(f.name, f.dataType).alias(f.name) for f in customers.schema)
    )


@query(
    "src_nested_documents",
    """
    SELECT CAST(n_nationkey AS VARCHAR) AS consumer_id, n_name AS street, r_name AS city,
           CAST(n_regionkey AS VARCHAR) AS state
    FROM nation JOIN region ON n_regionkey = r_regionkey
    """,
)
def src_nested_documents(spark: SparkSession, sf: str) -> DataFrame:
    path = write_documents(standins.nation_documents(spark, sf), spark, "documents")
    docs = read_documents(spark, path, schemas.ADDRESSES)
    return flatten_struct(docs, "address", schemas.ADDRESS_FIELDS).drop("_id")


@query("src_staged_parquet", "SELECT *, DATE '2021-07-25' AS ins_dt FROM orders")
def src_staged_parquet(spark: SparkSession, sf: str) -> DataFrame:
    orders, path = table(spark, sf, "orders"), shared_folder(spark, "staged")
    stage(with_batch_date(orders, "2021-07-25"), path)
    return read_staged(spark, path, orders.schema)


@query("src_warehouse_table", "SELECT * FROM customer")
def src_warehouse_table(spark: SparkSession, sf: str) -> DataFrame:
    warehouse = PathWarehouse(shared_folder(spark, "warehouse"))
    warehouse.overwrite(table(spark, sf, "customer"), "customer")
    return warehouse.read(spark, "customer")


@query("src_warehouse_catalog", "SELECT * FROM part")
def src_warehouse_catalog(spark: SparkSession, sf: str) -> DataFrame:
    warehouse = CatalogWarehouse(shared_folder(spark, "warehouse"))
    warehouse.overwrite(table(spark, sf, "supplier"), "wh_part")
    warehouse.overwrite(table(spark, sf, "part"), "wh_part")
    return warehouse.read(spark, "wh_part")


@query("src_warehouse_jdbc", "SELECT * FROM supplier")
def src_warehouse_jdbc(spark: SparkSession, sf: str) -> DataFrame:
    db = database(spark)
    db.overwrite(table(spark, sf, "supplier"), "wh_supplier")
    return db.read(spark, "wh_supplier", split_on="s_suppkey")


def _events_by_day(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn("ins_dt", F.to_date("ts"))


@query(
    "stage_overwrite_static",
    """
    SELECT *, CAST(ts AS DATE) AS ins_dt FROM events
    WHERE CAST(ts AS DATE) = (SELECT MAX(CAST(ts AS DATE)) FROM events)
    """,
)
def stage_overwrite_static(spark: SparkSession, sf: str) -> DataFrame:
    """All days staged, then the last one again: a static overwrite loses the others."""
    events, path = _events_by_day(spark, sf), shared_folder(spark, "staged")
    last = events.agg(F.max("ins_dt")).first()[0]
    stage(events, path, mode="static", many_dates=True)
    stage(events.filter(F.col("ins_dt") == F.lit(last)), path, mode="static")
    return read_staged(spark, path, table(spark, sf, "events").schema)


@query(
    "stage_overwrite_dynamic",
    """
    SELECT event_id, ts, user_id, event_type, props, CAST(ts AS DATE) AS ins_dt,
           CASE WHEN CAST(ts AS DATE) = (SELECT MAX(CAST(ts AS DATE)) FROM events)
                THEN value * 2 ELSE value END AS value
    FROM events
    """,
)
def stage_overwrite_dynamic(spark: SparkSession, sf: str) -> DataFrame:
    """All days staged, then the last one again with doubled values: the others stay."""
    events, path = _events_by_day(spark, sf), shared_folder(spark, "staged")
    last = events.agg(F.max("ins_dt")).first()[0]
    stage(events, path, many_dates=True)
    corrected = events.filter(F.col("ins_dt") == F.lit(last))
    stage(corrected.withColumn("value", F.col("value") * 2), path)
    return read_staged(spark, path, table(spark, sf, "events").schema)


CHILDREN_SQL = """
    SELECT DISTINCT o_custkey AS REGIS_CNSM_ID, o_orderstatus AS REGIS_CTY_CODE,
           l_linenumber AS CHILD_ID, l_returnflag AS CHILD_NB, l_linestatus AS CHILD_GENDER,
           DATE '1998-01-01' AS INS_DT
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
    WHERE year(o_orderdate) = 1998 AND l_linenumber IS NOT NULL
"""


@query("sink_table_overwrite", CHILDREN_SQL)
def sink_table_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """A table of another batch is replaced as a whole."""
    children = standins.order_children(spark, sf)
    warehouse = PathWarehouse(shared_folder(spark, "warehouse"))
    warehouse.overwrite(child_dim(children, "1997-01-01"), "CHILD_DIM")
    warehouse.overwrite(child_dim(children, "1998-01-01"), "CHILD_DIM")
    return warehouse.read(spark, "CHILD_DIM").drop("CHILD_KEY")


@query("sink_jdbc_overwrite", CHILDREN_SQL)
def sink_jdbc_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    children, db = standins.order_children(spark, sf), database(spark)
    db.overwrite(child_dim(children, "1997-01-01"), "sink_children")
    db.overwrite(child_dim(children, "1998-01-01"), "sink_children")
    return db.read(spark, "sink_children", split_on="CHILD_KEY").drop("CHILD_KEY")


@query(
    "limit_preview",
    "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5",
)
def limit_preview(spark: SparkSession, sf: str) -> DataFrame:
    return preview(table(spark, sf, "orders"), 5, [F.desc("o_totalprice"), F.col("o_orderkey")])

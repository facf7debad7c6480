"""Whole jobs: staging, batches run again, and the shape of their plans."""

from __future__ import annotations

import datetime
import glob
import os
import re
import shutil
import time
from dataclasses import replace

import pytest
from helpers import ADDR, CP, D, OL, OTHER, SB, assert_same_rows, bag, consumer, document
from helpers import physical_plan, receipt, settings, txn
from pyspark.sql import functions as F
from tillroll.operators import key_filter
from tillroll.plans import jobs, schemas
from tillroll.plans import (
    Source,
    build_targets,
    child_dim,
    registration_dim,
    run_batch,
    sql_target,
    stage_sources,
    transaction_fact,
)
from tillroll.plans.targets import most_copies, transaction_fact_parts
from tillroll.registry.base import write_delimited, write_documents
from tillroll.registry.jobs import history_fact
from tillroll.registry.scans import IN_PROCESS_DRIVER, IN_PROCESS_URL
from tillroll.sinks import CatalogWarehouse, JdbcWarehouse, PathWarehouse, stage, stage_batch, write_batch
from tillroll.sources import dates_with_keys, read_delimited, read_documents, read_staged, text_schema


@pytest.fixture
def sources(rows):
    """The four sources before they are staged, so without a load date."""
    frames = {
        "SB": rows([txn(i) for i in range(6)], SB).drop("ins_dt"),
        "OL": rows([receipt(str(i % 4), loyalty=f"c{i % 3}") for i in range(8)], OL).drop("ins_dt"),
        "CP": rows([consumer(f"c{i % 2}", child=f"k{i}") for i in range(5)], CP).drop("ins_dt"),
        "ADDR": rows([document("c0"), document("c1")], ADDR),
    }
    made = {name: Source(lambda df=df: df) for name, df in frames.items()}
    made["ADDR"] = Source(
        made["ADDR"].read, struct="address", fields=["street", "city", "state"], drop=["_id"]
    )
    return made


def test_staging(spark, sources, folder):
    paths = stage_sources(sources, folder, D)
    back = {name: read_staged(spark, path) for name, path in paths.items()}
    assert {name: df.count() for name, df in back.items()} == {"SB": 6, "OL": 8, "CP": 5, "ADDR": 2}
    assert back["ADDR"].columns == ["consumer_id", "street", "city", "state", "ins_dt"]
    assert all(bag(df.select("ins_dt").distinct()) == [(D,)] for df in back.values())


def test_a_batch_that_became_empty_leaves_no_old_rows(spark, sources, folder):
    stage_sources(sources, folder, OTHER)
    stage_sources(sources, folder, D)
    empty = {name: replace(s, read=lambda s=s: s.read().limit(0)) for name, s in sources.items()}
    for name, path in stage_sources(empty, folder, D).items():
        assert bag(read_staged(spark, path).select("ins_dt").distinct()) == [(OTHER,)], name


def test_static_staging_keeps_the_last_date_only(spark, sources, folder):
    stage_sources(sources, folder, OTHER, mode="static")
    for path in stage_sources(sources, folder, D, mode="static").values():
        assert bag(read_staged(spark, path).select("ins_dt").distinct()) == [(D,)]


def test_staging_without_a_date_takes_today(spark, sources, folder):
    before = datetime.date.today()
    paths = stage_sources(sources, folder)
    days = {bag(read_staged(spark, p).select("ins_dt").distinct())[0][0] for p in paths.values()}
    assert len(days) == 1 and before <= days.pop() <= datetime.date.today()


def test_no_sources_is_no_work(folder):
    assert stage_sources({}, folder, D) == {}


def test_a_batch_run_again_gives_the_same_tables(spark, sources, folder):
    def run(day):
        return run_batch(spark, sources, f"{folder}/staging", PathWarehouse(f"{folder}/wh"), day)

    run(OTHER)
    first = {t: bag(df) for t, df in run(D).items()}
    again = run(D)
    assert {t: bag(df) for t, df in again.items()} == first
    assert [len(first[t]) for t in ("REGIS_DIM", "CHILD_DIM", "RTL_TXN_FCT")] == [2, 5, 10]
    assert first["REPEATED_CONSUMERS"] == []
    staged = read_staged(spark, f"{folder}/staging/SB").groupBy("ins_dt").count()
    assert bag(staged) == [(OTHER, 6), (D, 6)]


def test_receipts_of_an_earlier_batch_count_as_receipts(spark, rows, sources, folder):
    """A transaction staged after its receipt is left out, one that never had any is kept."""
    warehouse = PathWarehouse(f"{folder}/wh")

    def run(day, receipts):
        frame = rows(receipts, OL).drop("ins_dt")
        of_day = {**sources, "OL": Source(lambda: frame)}
        loaded = run_batch(spark, of_day, f"{folder}/staging", warehouse, day)
        return bag(loaded["RTL_TXN_FCT"].select("TXN_ID", "CNSM_ID"))

    everything = [receipt(str(i)) for i in range(4)]
    want = [(str(i), "c1") for i in range(4)] + [("4", None), ("5", None)]
    assert run(OTHER, everything) == sorted(want, key=repr)
    assert run(D, [receipt("0")]) == [("0", "c1"), ("4", None), ("5", None)]


def test_a_date_that_was_not_staged_leaves_the_tables_alone(spark, sources, folder):
    warehouse, staging = PathWarehouse(f"{folder}/wh"), f"{folder}/staging"
    before = {t: bag(df) for t, df in run_batch(spark, sources, staging, warehouse, D).items()}
    with pytest.raises(ValueError, match="not staged on 2021-07-24"):
        build_targets(spark, staging, warehouse, OTHER)
    stage_sources({"CP": sources["CP"]}, staging, OTHER)
    with pytest.raises(ValueError, match="ADDR"):
        build_targets(spark, staging, warehouse, OTHER, ["REGIS_DIM", "CHILD_DIM"])
    for name in ("REGIS_DIM", "CHILD_DIM", "RTL_TXN_FCT"):
        assert bag(warehouse.read(spark, name)) == before[name]


def test_a_staging_that_fails_half_way_leaves_the_date_as_it_was(spark, sources, folder):
    """SB can be read again, CP cannot: neither changes, and the batch builds from what it had."""
    warehouse, staging = PathWarehouse(f"{folder}/wh"), f"{folder}/staging"
    before = {t: bag(df) for t, df in run_batch(spark, sources, staging, warehouse, D).items()}
    fails = lambda: sources["CP"].read().withColumn("REGIS_ID", F.raise_error(F.lit("no")))
    again = {"SB": replace(sources["SB"], read=lambda: sources["SB"].read().limit(1)), "CP": replace(sources["CP"], read=fails)}
    with pytest.raises(Exception, match="no"):
        stage_sources(again, staging, D)
    assert read_staged(spark, f"{staging}/SB").count() == 6
    built = build_targets(spark, staging, warehouse, D)
    assert {t: bag(df) for t, df in built.items()} == {t: before[t] for t in built}
    with pytest.raises(Exception, match="no"):
        stage_sources({**sources, **again}, staging, OTHER)
    with pytest.raises(ValueError, match=f"not staged on {OTHER}"):
        build_targets(spark, staging, warehouse, OTHER)


def test_a_half_staged_date_is_not_built(spark, sources, folder, monkeypatch):
    """The driver is lost after SB was published and before OL was."""
    warehouse, staging = PathWarehouse(f"{folder}/wh"), f"{folder}/staging"
    before = {t: bag(df) for t, df in run_batch(spark, sources, staging, warehouse, D).items()}
    publish = jobs.publish

    def lost(spark, written, others=True):
        if written.path.endswith("/OL"):
            raise KeyboardInterrupt
        publish(spark, written, others=others)

    monkeypatch.setattr(jobs, "publish", lost)
    with pytest.raises(KeyboardInterrupt):
        stage_sources(sources, staging, D)
    monkeypatch.undo()
    with pytest.raises(ValueError, match="half staged on 2021-07-25.*'SB'"):
        build_targets(spark, staging, warehouse, D)
    assert {t: bag(warehouse.read(spark, t)) for t in ("REGIS_DIM", "CHILD_DIM", "RTL_TXN_FCT")} == {
        t: before[t] for t in ("REGIS_DIM", "CHILD_DIM", "RTL_TXN_FCT")
    }
    stage_sources(sources, staging, D)
    assert build_targets(spark, staging, warehouse, D)["RTL_TXN_FCT"].count() == len(before["RTL_TXN_FCT"])


def test_rows_that_nobody_published_are_not_read(spark, sources, folder):
    """The driver is lost before the first staging of a source is published."""
    staging = f"{folder}/staging"
    stage_sources({n: sources[n] for n in ("SB", "ADDR")}, staging, D)
    for name in ("CP", "OL"):
        write_batch(sources[name].read(), f"{staging}/{name}", D)
        assert read_staged(spark, f"{staging}/{name}", schemas.STAGED[name]).count() == 0
        with pytest.raises(LookupError):
            read_staged(spark, f"{staging}/{name}")
    with pytest.raises(ValueError, match="not staged on 2021-07-25.*CP"):
        build_targets(spark, staging, PathWarehouse(f"{folder}/wh"), D)


def test_staged_files_that_lost_rows_are_not_loaded(spark, sources, folder):
    warehouse, staging = PathWarehouse(f"{folder}/wh"), f"{folder}/staging"
    stage_sources(sources, staging, D)
    lost = [f for f in glob.glob(f"{staging}/OL/ins_dt={D}/*/*.parquet") if spark.read.parquet(f).count()]
    shutil.copy(lost[0], lost[0].replace("part-", "part-9"))
    with pytest.raises(ValueError, match="OL: .* rows, 8 were staged"):
        build_targets(spark, staging, warehouse, D)
    with pytest.raises(LookupError):
        warehouse.read(spark, "REGIS_DIM")


def test_sources_of_a_date_may_be_staged_one_by_one(spark, sources, folder):
    warehouse, staging = PathWarehouse(f"{folder}/wh"), f"{folder}/staging"
    for name in sources:
        stage_sources({name: sources[name]}, staging, D)
    stage_sources({"CP": sources["CP"]}, staging, D)
    assert build_targets(spark, staging, warehouse, D)["RTL_TXN_FCT"].count() == 10


def test_dates_without_a_key_of_the_batch_are_not_opened(spark, rows, folder):
    staging, days = f"{folder}/staging", [datetime.date(2021, 6, 1) + datetime.timedelta(days=i) for i in range(12)]
    schema = schemas.STAGED["OL"]
    for i, day in enumerate(days):
        ids = [f" 00{1000 * i + j}" if j % 2 else str(1000 * i + j) for j in range(200)] + ["x", None]
        stage_sources({"OL": Source(lambda: rows([receipt(x) for x in ids], OL).drop("ins_dt"))}, staging, day)
    asked = rows([txn(i) for i in (3005, 7100, 7101, 9999)], SB)
    assert dates_with_keys(spark, f"{staging}/OL", asked, "App_Transaction_Id") == [str(days[3]), str(days[7])]
    as_text = asked.withColumn("App_Transaction_Id", F.lit("x"))
    assert dates_with_keys(spark, f"{staging}/OL", as_text, "App_Transaction_Id") == [str(d) for d in days]
    none = asked.withColumn("App_Transaction_Id", F.lit(None).cast("bigint"))
    assert dates_with_keys(spark, f"{staging}/OL", none, "App_Transaction_Id") == []
    decimals = asked.withColumn("App_Transaction_Id", F.lit(1).cast("decimal(20,0)"))
    assert dates_with_keys(spark, f"{staging}/OL", decimals, "App_Transaction_Id") is None
    stage_batch(rows([receipt("1")], OL), f"{staging}/OL", days[0])  # no filter: always opened
    found = dates_with_keys(spark, f"{staging}/OL", asked, "App_Transaction_Id")
    assert found == [str(days[0]), str(days[3]), str(days[7])]
    files = read_staged(spark, f"{staging}/OL", schema, dates=found).inputFiles()
    assert {f.split("ins_dt=")[1][:10] for f in files} == set(found)


def test_a_batch_reads_the_dates_that_may_hold_its_receipts(spark, rows, sources, folder, monkeypatch):
    """The receipts of twenty dates, three of them with one for a transaction of the batch."""
    warehouse, staging = PathWarehouse(f"{folder}/wh"), f"{folder}/staging"
    for i in range(20):
        frame = rows([receipt(str(j)) for j in ([i] if i < 3 else range(100 * i, 100 * i + 50))], OL).drop("ins_dt")
        stage_sources({"OL": Source(lambda: frame)}, staging, datetime.date(2021, 6, 1 + i))
    opened = []
    read = jobs.read_staged

    def watched(spark, path, schema=None, batch_column="ins_dt", dates=None):
        opened.append((path[-2:], dates))
        return read(spark, path, schema, batch_column, dates)

    monkeypatch.setattr(jobs, "read_staged", watched)
    only = {**sources, "OL": Source(lambda: rows([receipt("3")], OL).drop("ins_dt"))}
    fact = bag(run_batch(spark, only, staging, warehouse, D)["RTL_TXN_FCT"].select("TXN_ID"))
    assert fact == [("3",), ("4",), ("5",)]
    dates = next(d for name, d in reversed(opened) if name == "OL")
    assert dates == {"2021-06-01", "2021-06-02", "2021-06-03", str(D)}


def test_sources_staged_by_something_else_are_read_on_all_dates(spark, rows, sources, folder):
    staging, warehouse = f"{folder}/staging", PathWarehouse(f"{folder}/wh")
    stage_sources({n: sources[n] for n in ("SB", "CP", "ADDR")}, staging, D)
    both = rows([receipt("0", day=OTHER), receipt("1")], OL)
    both.write.partitionBy("ins_dt").parquet(f"{staging}/OL")
    fact = build_targets(spark, staging, warehouse, D)["RTL_TXN_FCT"]
    assert bag(fact.select("TXN_ID")) == [("1",), ("2",), ("3",), ("4",), ("5",)]


def test_filters_hold_their_keys_and_few_others(spark):
    keys = spark.range(20_000).select((F.col("id") * 7).cast("string").alias("k"))
    made = key_filter.key_filter(keys.union(keys), "k", 40_000).withColumn("d", F.lit("a")).cache()
    size = 2 ** made.first()["size"]
    assert 20_000 / 8 <= size <= 4 * 20_000 / 8 and made.count() <= size
    held = key_filter.may_hold(made, keys.select(F.col("k").cast("bigint").alias("n")), "n")
    assert held.count() == 20_000
    others = spark.range(200_000).select((F.col("id") * 7 + 3).alias("n"))
    assert key_filter.may_hold(made, others, "n").count() <= 5


def test_a_staged_batch_without_rows_loads_empty_tables(spark, sources, folder):
    empty = {name: replace(s, read=lambda s=s: s.read().limit(0)) for name, s in sources.items()}
    loaded = run_batch(spark, empty, f"{folder}/staging", PathWarehouse(f"{folder}/wh"), D)
    assert {name: df.count() for name, df in loaded.items()} == dict.fromkeys(loaded, 0)


def test_a_batch_leaves_the_session_as_it_was(spark, sources, folder):
    names = ("spark.sql.session.timeZone", "spark.sql.adaptive.forceOptimizeSkewedJoin")
    values = {"spark__sql__session__timeZone": "Europe/Berlin"}
    with settings(spark, **values, spark__sql__adaptive__forceOptimizeSkewedJoin="false"):
        run_batch(spark, sources, f"{folder}/staging", PathWarehouse(f"{folder}/wh"), D)
        assert [spark.conf.get(n) for n in names] == ["Europe/Berlin", "false"]


def test_copies_of_a_fact_row_are_bounded_by_its_keys(rows):
    known = rows([("c1",), ("c1",), ("c2",), (None,), (None,), (None,)], "CNSM_ID string")
    one_each, nobody = rows([("c1",)], "CNSM_ID string"), rows([], "CNSM_ID string")
    transactions = rows([txn(1), txn(1), txn(2), txn(None), txn(None), txn(None)], SB)
    receipts = rows([receipt("1"), receipt("01"), receipt("2"), *[receipt("3")] * 9, receipt(None)], OL)
    assert most_copies(transactions, receipts, known) == 8  # two, by '1' and '01', by twice c1
    assert most_copies(transactions, receipts, one_each) == 4
    assert most_copies(transactions, receipts.filter("SBLP_TRANSACTION_ID = '2'"), nobody) == 3
    assert most_copies(transactions.limit(0), receipts, known) == 0


def test_a_batch_counts_copies_only_where_there_may_be_many(spark, sources, folder, monkeypatch):
    asked, built = [], jobs.transaction_fact
    monkeypatch.setattr(
        jobs, "transaction_fact", lambda *a, **k: asked.append(k["few_copies"]) or built(*a, **k)
    )
    facts = []
    for most in (10_000, 1):
        monkeypatch.setattr(jobs, "COPIES_PER_PART", most)
        loaded = run_batch(spark, sources, folder, PathWarehouse(f"{folder}/wh-{most}"), D)
        facts.append(loaded["RTL_TXN_FCT"])
    assert asked == [True, False]
    assert bag(facts[0]) == bag(facts[1]) and facts[0].count() > 6


class Plain:
    """A warehouse that only takes whole tables."""

    def __init__(self, root):
        self.inner = PathWarehouse(root)

    def overwrite(self, df, table):
        self.inner.overwrite(df, table)

    def read(self, spark, table, split_on=None):
        return self.inner.read(spark, table, split_on)


@pytest.mark.parametrize("key, most, kinds", [
    ("dense", 10_000, [PathWarehouse, CatalogWarehouse, Plain]),
    ("dense", 1, [PathWarehouse]),
    ("unique", 1, [PathWarehouse]),
])
def test_a_fact_made_in_passes_is_the_same(spark, rows, sources, folder, monkeypatch, key, most, kinds):
    monkeypatch.setattr(jobs, "COPIES_PER_PART", most)
    monkeypatch.setattr(jobs, "MOST_PASSES", 3)
    ids = [None, None, 1, 1, 2, 3, 5, 6, *range(20, 40)]
    texts = [None, "1", "01", "2", "2", "2", "x", "", "7", *map(str, range(25, 60))]
    more = {
        "SB": Source(lambda: rows([txn(i) for i in ids], SB).drop("ins_dt")),
        "OL": Source(
            lambda: rows([receipt(t, loyalty=f"c{len(t or '')}") for t in texts], OL).drop("ins_dt")
        ),
    }
    other = Source(lambda: rows([receipt("6"), receipt("21")], OL).drop("ins_dt"))
    stage_sources({**sources, "OL": other}, f"{folder}/staging", OTHER)

    def fact(warehouse):
        batch = {**sources, **more}
        loaded = run_batch(spark, batch, f"{folder}/staging", warehouse, D, fact_key=key)["RTL_TXN_FCT"]
        if key == "unique":
            assert loaded.select("RTL_TXN_KEY").distinct().count() == loaded.count()
            loaded = loaded.drop("RTL_TXN_KEY")
        return bag(loaded)

    want = fact(PathWarehouse(f"{folder}/one"))
    assert len(want) > 20
    monkeypatch.setattr(jobs, "ROWS_PER_PASS", 1)
    asked, build = [], jobs.transaction_fact_parts
    monkeypatch.setattr(
        jobs, "transaction_fact_parts", lambda *a, **k: asked.append(k["few_copies"]) or build(*a, **k)
    )
    for i, kind in enumerate(kinds):
        assert fact(kind(f"{folder}/{i}")) == want
    assert asked == [key == "dense" and most > 1] * len(kinds)
    assert not glob.glob(f"{folder}/staging/_passes*")


def test_a_fact_that_fails_half_way_leaves_the_table_and_no_stored_rows(spark, sources, folder, monkeypatch):
    warehouse = PathWarehouse(f"{folder}/wh")
    want = bag(run_batch(spark, sources, f"{folder}/staging", warehouse, D)["RTL_TXN_FCT"])
    build = jobs.transaction_fact_parts

    def breaks_off(*a, **k):
        yield next(build(*a, **k))
        raise RuntimeError("no")

    monkeypatch.setattr(jobs, "ROWS_PER_PASS", 1)
    monkeypatch.setattr(jobs, "transaction_fact_parts", breaks_off)
    with pytest.raises(RuntimeError, match="no"):
        run_batch(spark, sources, f"{folder}/staging", warehouse, D)
    assert bag(warehouse.read(spark, "RTL_TXN_FCT")) == want
    assert not glob.glob(f"{folder}/staging/_passes*")


def test_an_empty_batch_and_keys_that_are_not_dealt_take_passes_too(spark, rows, sources, folder):
    def facts(transactions, receipts, passes):
        known = rows([("c1",), ("c1",)], "CNSM_ID string")
        frames = (transactions, receipts, known, D)
        if passes == 1:
            return transaction_fact(*frames, key="dense")
        parts = transaction_fact_parts(*frames, f"{folder}/{passes}", passes, key="dense")
        return spark.createDataFrame([r for part in parts for r in part.collect()], schema)

    transactions, receipts = rows([txn(i) for i in range(9)], SB), rows([receipt("3"), receipt("4.0")], OL)
    schema = transaction_fact(transactions, receipts, rows([], "CNSM_ID string"), D).schema
    assert facts(transactions.limit(0), receipts, 3).isEmpty()
    shutil.rmtree(f"{folder}/3")
    halves = transactions.withColumn("App_Transaction_Id", F.col("App_Transaction_Id") / 2)
    assert bag(facts(halves, receipts, 3)) == bag(facts(halves, receipts, 1))


def test_a_batch_leaves_no_shuffle_files(spark, sources, folder):
    def files():
        places = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
        return {f for place in places for f in glob.glob(f"{place}/*/shuffle_*")}

    before = files()
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1):
        run_batch(spark, sources, f"{folder}/staging", PathWarehouse(f"{folder}/wh"), D)
        left = files() - before
        for _ in range(50):  # they are removed beside the driver's own work
            if not left:
                break
            time.sleep(0.1)
            left = files() - before
    assert not left


def test_text_that_stands_for_another_system_is_packed(spark, rows):
    df = rows([(i, f"name {i % 7}", None) for i in range(5000)], "a int, b string, c string")
    for path, read in (
        (write_delimited(df, spark, "packed"), lambda p: read_delimited(spark, p, text_schema(["a", "b", "c"]))),
        (write_documents(df, spark, "packed"), lambda p: read_documents(spark, p, df.schema)),
    ):
        files = glob.glob(f"{path}/part-*")
        assert files and all(name.endswith(".gz") for name in files)
        assert sum(map(os.path.getsize, files)) < 60_000
        assert bag(read(path)) == bag(df.select(F.col("a").cast(read(path).schema["a"].dataType), "b", "c"))


def test_a_sql_target_leaves_views_as_they_were(spark, rows):
    spark.range(7).createOrReplaceTempView("SB")
    try:
        out = sql_target(
            spark, {"sb": spark.range(3), "OL": spark.range(5)}, "SELECT sb.id FROM sb JOIN ol USING (id)"
        )
        assert spark.table("SB").count() == 7 and out.count() == 3
        assert not any(t.name.lower() == "ol" for t in spark.catalog.listTables())
        with pytest.raises(Exception, match="nowhere"):
            sql_target(spark, {"SB": spark.range(3)}, "SELECT * FROM nowhere")
        assert spark.table("SB").count() == 7
    finally:
        spark.catalog.dropTempView("SB")


def test_a_column_that_older_dates_lack_is_read(spark, sources, folder):
    """By the known columns, whichever file is looked at first."""
    older = replace(sources["OL"], read=lambda: sources["OL"].read().drop("MSG_CODE"))
    stage_sources({**sources, "OL": older}, f"{folder}/staging", OTHER)
    loaded = run_batch(spark, sources, f"{folder}/staging", PathWarehouse(f"{folder}/wh"), D)
    assert loaded["RTL_TXN_FCT"].filter("RTL_TXN_EXT_CHAR_5 = 7").count() > 0


def test_the_fact_of_a_staged_history_reads_the_batch_by_partition(spark):
    with settings(spark, spark__sql__maxMetadataStringLength=2000):
        found = scans(physical_plan(history_fact(spark, "/root/testdata/sf0.001")))
    wide = [f for columns, f in found if "PRODUCTS" in columns]
    assert len(wide) == 1 and "1998-01-01" in wide[0]
    transactions = [f for columns, f in found if "App_Transaction_Id" in columns]
    assert transactions and all("1998-01-01" in f for f in transactions)
    assert [f for columns, f in found if columns == {"SBLP_TRANSACTION_ID"}] == [""]


def test_targets_can_be_built_apart(spark, sources, folder):
    warehouse = CatalogWarehouse(f"{folder}/wh")
    stage_sources(sources, f"{folder}/staging", D)
    dims = build_targets(spark, f"{folder}/staging", warehouse, D, ["CHILD_DIM", "REGIS_DIM"])
    assert list(dims) == ["REGIS_DIM", "CHILD_DIM"]
    fact = build_targets(spark, f"{folder}/staging", warehouse, D, ["RTL_TXN_FCT"])
    assert fact["RTL_TXN_FCT"].count() == 10
    with pytest.raises(ValueError):
        build_targets(spark, f"{folder}/staging", warehouse, D, ["OTHER"])


def test_a_batch_through_a_database(spark, sources, folder):
    db = JdbcWarehouse(IN_PROCESS_URL, {"driver": IN_PROCESS_DRIVER}, connections=4)
    paths = PathWarehouse(f"{folder}/wh")
    tables = [run_batch(spark, sources, f"{folder}/staging", w, D) for w in (db, paths)]
    for name in ("REGIS_DIM", "CHILD_DIM", "RTL_TXN_FCT"):
        assert bag(tables[0][name]) == bag(tables[1][name])
    assert tables[0]["RTL_TXN_FCT"].rdd.getNumPartitions() == 4


@pytest.mark.parametrize("key", ["dense", "unique"])
def test_targets_run_again_agree(rows, key):
    consumers = rows([consumer(f"c{i % 7}", child=f"k{i}") for i in range(40)], CP)
    addresses = rows([document(f"c{i}") for i in range(5)], ADDR)
    dims = [registration_dim(consumers.repartition(n), addresses, key=key) for n in (1, 5)]
    kids = [child_dim(consumers.repartition(n), D, key=key) for n in (1, 5)]
    facts = [
        transaction_fact(
            rows([txn(i % 9) for i in range(30)], SB).repartition(n),
            rows([receipt(str(i % 6)) for i in range(20)], OL),
            rows([("c1",)], "CNSM_ID string"),
            D,
            key=key,
        )
        for n in (1, 5)
    ]
    for a, b in (dims, kids, facts):
        if key == "unique":
            name = a.columns[0]
            assert a.select(name).distinct().count() == a.count()
            a, b = a.drop(name), b.drop(name)
        assert_same_rows(a, b)


@pytest.fixture
def two_days(spark, rows, folder):
    """Staged sources of two dates."""
    frames = {
        "SB": rows([txn(i, day=d) for i in range(4) for d in (D, OTHER)], SB),
        "OL": rows([receipt(str(i), day=d) for i in range(4) for d in (D, OTHER)], OL),
        "CP": rows([consumer(f"c{i}", day=d) for i in range(4) for d in (D, OTHER)], CP),
    }
    for name, df in frames.items():
        stage(df, f"{folder}/{name}")
    return {
        name: read_staged(spark, f"{folder}/{name}", df.drop("ins_dt").schema)
        for name, df in frames.items()
    }


def scans(plan):
    """Initial plan's file scans: columns read and partition filters."""
    lines = [line for line in plan.splitlines() if "FileScan parquet" in line]
    columns = [re.search(r"ReadSchema: struct<(.*?)>", line).group(1) for line in lines]
    filters = [re.search(r"PartitionFilters: \[(.*?)\], Pushed", line).group(1) for line in lines]
    return [({c.split(":")[0] for c in cs.split(",")}, f) for cs, f in zip(columns, filters)]


def test_fact_plan(spark, rows, two_days):
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold=-1,
        spark__sql__maxMetadataStringLength=2000,
    ):
        df = transaction_fact(
            two_days["SB"], two_days["OL"], rows([("c1",)], "CNSM_ID string"), D
        )
        plan = physical_plan(df)
    found = scans(plan)
    wide = [f for columns, f in found if "PRODUCTS" in columns]
    keys_only = [f for columns, f in found if columns == {"SBLP_TRANSACTION_ID"}]
    # the batch's receipts in full, by partition; the history for its key column alone
    assert len(wide) == 1 and "ins_dt" in wide[0] and str(D) in str(wide[0])
    assert keys_only == [""]
    transactions = [f for columns, f in found if "App_Transaction_Id" in columns]
    assert transactions and all(str(D) in f for f in transactions)
    assert "SinglePartition" not in plan and "Window" not in plan
    assert plan.count("LeftOuter") == 1 and plan.count("LeftAnti") == 1


def test_child_plan(spark, two_days):
    with settings(spark, spark__sql__maxMetadataStringLength=2000):
        plan = physical_plan(child_dim(two_days["CP"], D, key="unique"))
    (columns, filters), = scans(plan)
    assert str(D) in filters and "REGIS_CITY" not in columns
    assert "PushedFilters: [IsNotNull(CHILD_ID)]" in plan
    assert "SinglePartition" not in plan


def test_registration_plan_shuffles_for_the_join_only(spark, rows, two_days):
    addresses = rows([document("c0")], ADDR)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1):
        plan = physical_plan(registration_dim(two_days["CP"], addresses, key="unique"))
    assert plan.count("Exchange hashpartitioning") == 2 and "SortMergeJoin" in plan


def test_dense_key_gathers_nothing_but_bucket_counts(spark, two_days):
    plan = physical_plan(child_dim(two_days["CP"], D, key="dense"))
    single = plan.split("Exchange SinglePartition")
    assert len(single) == 2
    assert re.search(r"HashAggregate\(keys=\[__bucket#\d+L\], functions=\[count\(1\)", single[1])

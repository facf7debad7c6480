"""Sources and sinks."""

from __future__ import annotations

import datetime
import glob
import json
import uuid
from types import SimpleNamespace

import pytest
from helpers import D, OTHER, bag, settings
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.loads import LoadLog
from tillroll.plans import schemas
from tillroll.registry.scans import IN_PROCESS_DRIVER, IN_PROCESS_URL, database
from tillroll.session import shared_folder
from tillroll.sinks import CatalogWarehouse, JdbcWarehouse, PathWarehouse, publish, stage, stage_batch, write_batch
from tillroll.sinks.swap import swap_of
from tillroll.sources import (
    column_bounds,
    read_delimited,
    read_documents,
    read_jdbc_partitioned,
    read_staged,
    text_schema,
)
from tillroll.sources import jdbc
from tillroll.sources.jdbc import parts_sql, slice_conditions

PROPERTIES = {"driver": IN_PROCESS_DRIVER}


@pytest.fixture
def db():
    return JdbcWarehouse(IN_PROCESS_URL, PROPERTIES, connections=4)


@pytest.fixture
def ids(spark, db):
    table = f"ids_{uuid.uuid4().hex}"
    db.overwrite(spark.range(1, 201).withColumn("v", F.col("id") * 2), table)
    return table


def sizes(df):
    counted = df.groupBy(F.spark_partition_id().alias("p")).count()
    return sorted(r["count"] for r in counted.collect())


def test_guessed_bounds_filter_nothing_but_split_badly(spark, ids):
    df = read_jdbc_partitioned(spark, IN_PROCESS_URL, ids, "id", 2, PROPERTIES, bounds=(1, 100))
    assert df.count() == 200 and sizes(df) == [49, 151]


def test_true_bounds_split_evenly(spark, ids):
    assert column_bounds(spark, IN_PROCESS_URL, ids, "ID", PROPERTIES) == (1, 200)
    df = read_jdbc_partitioned(spark, IN_PROCESS_URL, ids, "ID", 4, PROPERTIES)
    assert df.count() == 200 and max(sizes(df)) <= 51


def test_an_outlier_leaves_the_split_even(spark, db):
    table = f"bunched_{uuid.uuid4().hex}"
    db.overwrite(spark.range(100_000).union(spark.createDataFrame([(10**12,)], "id long")), table)
    df = read_jdbc_partitioned(spark, IN_PROCESS_URL, table, "id", 8, PROPERTIES)
    assert df.count() == 100_001 and sizes(df) == [12_494, *[12_501] * 7]


def test_hot_value_and_nulls_are_parts_of_their_own(spark, db):
    table = f"hot_{uuid.uuid4().hex}"
    key = F.when(F.col("id") < 40, F.lit(7)).when(F.col("id") < 70, F.col("id"))
    db.overwrite(spark.range(100).select(key.cast("bigint").alias("k")), table)
    df = read_jdbc_partitioned(spark, IN_PROCESS_URL, table, "k", 7, PROPERTIES)
    assert df.count() == 100 and sizes(df) == [10, 10, 10, 30, 40]


def hot_table(spark, db, text=False):
    """60 % of 1,000 rows on one value, a tenth without one."""
    table = f"hot_{uuid.uuid4().hex}"
    value = F.when(F.col("id") % 10 < 6, F.lit(500)).when(F.col("id") % 10 < 9, F.col("id"))
    kind = "VARCHAR(20)" if text else "BIGINT"
    db._execute(spark, f'CREATE TABLE {table} ("k" {kind}, "id" BIGINT, "t" VARCHAR(20))')
    value = F.concat(F.lit("it's "), F.lpad(value.cast("string"), 5, "0")) if text else value
    db.overwrite(spark.range(1000).select(value.alias("k"), "id", F.col("id").cast("string").alias("t")), table)
    return table


@pytest.mark.parametrize("text", [False, True])
def test_a_hot_value_is_dealt_by_another_column(spark, db, text):
    table = hot_table(spark, db, text)
    df = read_jdbc_partitioned(spark, IN_PROCESS_URL, table, "K", 8, PROPERTIES, spread="ID")
    assert sorted(r["id"] for r in df.collect()) == list(range(1000))
    assert max(sizes(df)) <= 150 and len(sizes(df)) >= 8
    whole = read_jdbc_partitioned(spark, IN_PROCESS_URL, table, "K", 8, PROPERTIES)
    assert whole.count() == 1000 and max(sizes(whole)) >= 600
    with pytest.raises(ValueError, match="whole numbers"):
        read_jdbc_partitioned(spark, IN_PROCESS_URL, table, "K", 8, PROPERTIES, spread="t")


def test_a_text_column_is_cut_evenly(spark, db):
    table = hot_table(spark, db)
    df = read_jdbc_partitioned(spark, IN_PROCESS_URL, table, "t", 8, PROPERTIES)
    assert df.count() == 1000 and sizes(df) == [125] * 8


def test_rows_dealt_by_hash(spark, db):
    df = read_jdbc_partitioned(spark, IN_PROCESS_URL, hot_table(spark, db), "id", 8, PROPERTIES, hashed=True)
    assert df.count() == 1000 and len(sizes(df)) == 8 and max(sizes(df)) <= 150


NTILE = (
    "SELECT MIN(v) AS v, part FROM (SELECT {c} AS v, NTILE(4) OVER (ORDER BY {c}) AS part"
    " FROM s.t WHERE {c} IS NOT NULL) q GROUP BY part"
)


@pytest.mark.parametrize(
    ("url", "column", "text"),
    [
        ("jdbc:mysql://h/d", "`a`", "CRC32(`a`)"),
        ("jdbc:postgresql://h/d", '"a"', 'HASHTEXT(CAST("a" AS TEXT))'),
        ("jdbc:sqlserver://h", "[a]", "CHECKSUM([a])"),
        ("jdbc:oracle:thin:@h", '"a"', 'ORA_HASH("a")'),
    ],
)
def test_splits_are_made_in_the_database_and_bounded(url, column, text):
    assert parts_sql(url, "s.t", column, 4, 1000) == NTILE.format(c=column)
    mixed = "MOD(MOD(ABS(MOD(COALESCE({}, 0), 30011)) * 18541, 30011), 2) = 1"
    if "sqlserver" in url:
        mixed = "((ABS((COALESCE({}, 0) % 30011)) * 18541 % 30011) % 2) = 1"
    for kind, number in ((T.LongType(), column), (T.DecimalType(20, 0), column), (T.StringType(), text)):
        assert slice_conditions(url, column, kind, 2)[1] == mixed.format(number)
    with pytest.raises(ValueError):
        slice_conditions(url, column, T.DoubleType(), 2)


def test_parts_in_a_database_that_cannot_number_by_order():
    sql = parts_sql("jdbc:derby:memory:x", "t", '"a"', 4, 1001)
    assert "(r - 1) / 251 AS part" in sql and "ROW_NUMBER() OVER ()" in sql


def test_more_parts_than_asked_for_are_an_error(spark, ids, monkeypatch):
    """As from a database that divides whole numbers to fractions."""
    monkeypatch.setattr(jdbc, "parts_sql", lambda url, table, quoted, parts, rows: f"SELECT {quoted} AS v, {quoted} AS part FROM {table}")
    with pytest.raises(RuntimeError, match="4 parts"):
        read_jdbc_partitioned(spark, IN_PROCESS_URL, ids, "id", 4, PROPERTIES)


def test_texts_in_conditions_are_quoted():
    assert jdbc._literal("jdbc:postgresql:x", "it's \\") == "'it''s \\'"
    assert jdbc._literal("jdbc:mysql:x", "it's \\") == "'it''s \\\\'"
    assert jdbc._parts("c", ["a", "a", "b"], repr, lambda n: ["x", "y"] if n > 1 else []) == [
        "c = 'a' AND x", "c = 'a' AND y", "c > 'a' AND c < 'b'", "c >= 'b'",
    ]
    assert jdbc._parts("c", [1, 5, 5], str, lambda n: []) == ["c < 5", "c >= 5"]
    assert jdbc._parts("c", [1], str, lambda n: []) == ["c >= 1"]


def test_cuts_are_kept(spark, db):
    table = f"cut_{uuid.uuid4().hex}"
    bunched = spark.range(100).union(spark.createDataFrame([(10**9,), (None,)], "id long"))
    db.overwrite(bunched.withColumnRenamed("id", "k"), table)

    def cut(at):
        return read_jdbc_partitioned(spark, IN_PROCESS_URL, table, "K", 4, PROPERTIES, cuts=at)

    assert sizes(cut([25, 50, 75])) == [1, 25, 25, 25, 26] and cut([]).count() == 102
    for bad in ([5, 5], ["1; DROP TABLE x"]):
        with pytest.raises(ValueError):
            cut(bad)


def test_a_column_without_values_cannot_split(spark, db):
    table = f"nulls_{uuid.uuid4().hex}"
    db.overwrite(spark.range(1000).select("id", F.lit(None).cast("bigint").alias("k")), table)
    with pytest.raises(ValueError, match="NULL on all rows"):
        read_jdbc_partitioned(spark, IN_PROCESS_URL, table, "k", 8, PROPERTIES)


def test_empty_table_has_no_bounds(spark, db):
    table = f"empty_{uuid.uuid4().hex}"
    db.overwrite(spark.range(0), table)
    assert read_jdbc_partitioned(spark, IN_PROCESS_URL, table, "id", 4, PROPERTIES).count() == 0


def test_dates_split_too(spark, db):
    table = f"dates_{uuid.uuid4().hex}"
    days = [(datetime.date(2021, 1, 1) + datetime.timedelta(days=i),) for i in range(40)]
    db.overwrite(spark.createDataFrame(days, "d date"), table)
    df = read_jdbc_partitioned(spark, IN_PROCESS_URL, table, "d", 4, PROPERTIES)
    assert df.count() == 40 and len(sizes(df)) == 4


@pytest.mark.parametrize("kind", ["decimal(20,0)", "decimal(10,2)", "timestamp", "smallint"])
def test_other_types_split_too(spark, db, kind):
    table = f"typed_{uuid.uuid4().hex}"
    value = F.timestamp_seconds(F.col("id") * 3600) if kind == "timestamp" else F.col("id") * 7
    db.overwrite(spark.range(1, 41).select(value.cast(kind).alias("c")), table)
    df = read_jdbc_partitioned(spark, IN_PROCESS_URL, table, "c", 4, PROPERTIES)
    assert df.count() == 40 and len(sizes(df)) == 4 and max(sizes(df)) < 13


def test_filters_and_columns_reach_the_database(spark, ids):
    df = read_jdbc_partitioned(spark, IN_PROCESS_URL, ids, "id", 2, PROPERTIES)
    plan = df.filter("id > 150").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "*GreaterThan(id,150)" in plan and "ReadSchema: struct<id:bigint>" in plan


def test_truncate_keeps_the_table_and_replaces_its_rows(spark, db, ids):
    db.overwrite(spark.range(5).withColumn("v", F.lit(1).cast("bigint")), ids)
    assert bag(db.read(spark, ids).select("id")) == [(i,) for i in range(5)]


def test_doubled_rows_fail_the_load(spark, db, ids, monkeypatch):
    monkeypatch.setattr(JdbcWarehouse, "_count", lambda *_: 6)
    with pytest.raises(RuntimeError, match="holds 6 rows, 5 were written"):
        db.overwrite(spark.range(5).withColumn("v", F.lit(1).cast("bigint")), ids)


@pytest.mark.parametrize("truncate", [True, False])
def test_a_failed_load_of_a_database_table_leaves_the_old_rows(spark, folder, ids, truncate, monkeypatch):
    db = JdbcWarehouse(IN_PROCESS_URL, PROPERTIES, connections=4, truncate=truncate)
    before = bag(db.read(spark, ids))
    failing = spark.range(5).withColumn("v", F.raise_error(F.lit("no")).cast("bigint"))
    with pytest.raises(Exception, match="no"):
        db.overwrite(failing, ids)
    monkeypatch.setattr(JdbcWarehouse, "_count", lambda *_: 6)
    with pytest.raises(RuntimeError):
        db.overwrite(spark.range(5).withColumn("v", F.lit(1).cast("bigint")), ids)
    assert bag(db.read(spark, ids)) == before
    monkeypatch.undo()
    db.overwrite(spark.range(5).withColumn("v", F.lit(1).cast("bigint")), ids)
    assert bag(db.read(spark, ids)) == [(i, 1) for i in range(5)]


@pytest.mark.parametrize("kind", [PathWarehouse, CatalogWarehouse])
def test_a_failed_load_leaves_the_old_rows(spark, folder, kind):
    warehouse = kind(folder)
    name = f"t_{uuid.uuid4().hex}"
    warehouse.overwrite(spark.range(10), name)
    failing = spark.range(5).select(F.raise_error(F.lit("no")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="no"):
        warehouse.overwrite(failing, name)
    assert warehouse.read(spark, name).count() == 10
    # a table may be rewritten from itself
    warehouse.overwrite(warehouse.read(spark, name).filter("id < 4"), name)
    assert warehouse.read(spark, name).count() == 4


@pytest.mark.parametrize("kind", [PathWarehouse, CatalogWarehouse])
def test_earlier_loads_go(spark, folder, kind):
    warehouse, name = kind(folder, keep=2), f"t_{uuid.uuid4().hex}"
    for n in range(1, 6):
        warehouse.overwrite(spark.range(n), name)
    assert len(glob.glob(f"{folder}/{name}/load-*")) == 2
    assert warehouse.read(spark, name).count() == 5


@pytest.mark.parametrize("kind", [PathWarehouse, CatalogWarehouse])
def test_frames_of_the_last_good_load_survive_a_failed_one(spark, folder, kind):
    warehouse, name = kind(folder, keep=2), f"t_{uuid.uuid4().hex}"
    warehouse.overwrite(spark.range(10), name)
    first = warehouse.read(spark, name)
    failing = spark.range(5).select(F.raise_error(F.lit("no")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="no"):
        warehouse.overwrite(failing, name)
    warehouse.overwrite(spark.range(3), name)
    assert first.count() == 10 and warehouse.read(spark, name).count() == 3
    assert len(glob.glob(f"{folder}/{name}/load-*")) == 2
    warehouse.overwrite(spark.range(4), name)
    assert warehouse.read(spark, name).count() == 4 and len(glob.glob(f"{folder}/{name}/load-*")) == 2


@pytest.mark.parametrize("failing", ["create", "rename"])
def test_columns_that_cannot_change_leave_the_catalog_table(spark, folder, failing, monkeypatch):
    from tillroll.sinks import warehouse as module

    warehouse, name = CatalogWarehouse(folder), f"t_{uuid.uuid4().hex}"
    warehouse.overwrite(spark.range(10), name)
    rename = module._rename

    def no_rename(spark, table, to):
        if to == f"default.{name}" and "_new_" in table:
            raise RuntimeError("no")
        rename(spark, table, to)

    def no_create(*_, **__):
        raise RuntimeError("no")

    changed = spark.range(3).withColumn("more", F.lit(1))
    if failing == "rename":
        monkeypatch.setattr(module, "_rename", no_rename)
    else:
        monkeypatch.setattr(type(spark.catalog), "createTable", no_create)
    with pytest.raises(RuntimeError, match="no"):
        warehouse.overwrite(changed, name)
    monkeypatch.undo()
    assert warehouse.read(spark, name).columns == ["id"] and warehouse.read(spark, name).count() == 10
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(name)] == [name]
    warehouse.overwrite(changed, name)
    assert warehouse.read(spark, name).columns == ["id", "more"]


SWAPS = {
    "jdbc:postgresql://h/d": (("DROP TABLE s.t", "ALTER TABLE s.t_1 RENAME TO t"), True, (), ()),
    "jdbc:derby:memory:x": (("DROP TABLE s.t", "RENAME TABLE s.t_1 TO t"), True, (), ()),
    "jdbc:db2://h/d": (("DROP TABLE s.t", "RENAME TABLE s.t_1 TO t"), True, (), ()),
    "jdbc:sqlserver://h": (("DROP TABLE s.t", "EXEC sp_rename 's.t_1', 't'"), True, (), ()),
    "jdbc:mysql://h/d": (("RENAME TABLE s.t TO s.t_1_old, s.t_1 TO s.t",), False, (), ("DROP TABLE s.t_1_old",)),
    "jdbc:snowflake://h": (("ALTER TABLE s.t SWAP WITH s.t_1",), False, (), ()),
    "jdbc:oracle:thin:@h": (
        ("ALTER TABLE s.t RENAME TO t_1_old", "ALTER TABLE s.t_1 RENAME TO t"), False,
        ("ALTER TABLE s.t_1_old RENAME TO t",), ("DROP TABLE s.t_1_old",),
    ),
    "jdbc:other:x": (
        ("ALTER TABLE s.t RENAME TO t_1_old", "ALTER TABLE s.t_1 RENAME TO t"), False,
        ("ALTER TABLE s.t_1_old RENAME TO t",), ("DROP TABLE s.t_1_old",),
    ),
}


@pytest.mark.parametrize("url", SWAPS)
def test_tables_are_swapped_as_the_database_can(url):
    swap = swap_of(url, "s.t", "s.t_1", True)
    assert (swap.steps, swap.together, swap.undo, swap.after) == SWAPS[url]
    alone = swap_of(url, "t", "t_1", True)
    assert [x.replace("s.", "") for x in swap.steps] == list(alone.steps)
    first = swap_of(url, "s.t", "s.t_1", False)
    assert len(first.steps) == 1 and "t_1" in first.steps[0] and not first.after and "DROP" not in first.steps[0]


@pytest.mark.parametrize("qualified", [False, True])
def test_a_table_with_other_columns_takes_the_place_of_the_old_one(spark, qualified):
    db, name = JdbcWarehouse(IN_PROCESS_URL, PROPERTIES, connections=2, truncate=False), f"T{uuid.uuid4().hex}".upper()
    if qualified:
        name = f"APP.{name}"
        db._execute(spark, "CREATE TABLE app.made (a INT)", "DROP TABLE app.made")
    assert not db._exists(spark, name)
    db.overwrite(spark.range(10), name)
    db.overwrite(spark.range(3).withColumn("more", F.lit(1)), name)
    assert bag(db.read(spark, name)) == [(0, 1), (1, 1), (2, 1)] and db._exists(spark, name.lower())


def test_statements_that_commit_alone_are_taken_back(spark, db, ids):
    """As in a database where a table is renamed away before the new one has its name."""
    steps = [f"RENAME TABLE {ids} TO {ids}_old", f"RENAME TABLE {ids}_missing TO {ids}"]
    with pytest.raises(Exception, match="(?i)exist"):
        db._one_by_one(spark, steps, [f"RENAME TABLE {ids}_old TO {ids}"])
    assert db.read(spark, ids).count() == 200


def test_a_database_that_cannot_be_asked_is_not_one_without_the_table(spark):
    with pytest.raises(Exception, match="(?i)not_there"):
        JdbcWarehouse("jdbc:derby:memory:not_there", PROPERTIES)._exists(spark, "t")


def test_a_load_is_there_when_its_note_is(spark, folder):
    log = LoadLog(spark, f"{folder}/t")
    assert log.loads() == {} and log.current() == {}
    for n in range(12):
        log.add("2021-07-25", f"a{n}", {"rows": n})
    log.add("other", "b", {})
    assert log.current()["2021-07-25"].load == "a11" and log.facts(log.current()["2021-07-25"]) == {"rows": 11}
    with open(f"{folder}/t/_loads/.half", "w") as f:
        f.write('{"ro')
    assert log.trim("2021-07-25", 2) == {"a10", "a11"} and len(log.loads()["2021-07-25"]) == 2
    log.drop("2021-07-25")
    assert list(log.loads()) == ["other"]


def failing_rows(spark):
    return spark.range(5).select(F.raise_error(F.lit("no")).cast("int").alias("n"), F.lit(D).alias("ins_dt"))


def test_a_date_that_fails_to_be_staged_again_keeps_its_rows(spark, folder):
    path = f"{folder}/t"
    stage_batch(staged(spark, [D] * 10).drop("ins_dt"), path, D)
    before = read_staged(spark, path)
    for again in (lambda: stage_batch(failing_rows(spark), path, D), lambda: stage(failing_rows(spark), path, mode="static")):
        with pytest.raises(Exception, match="no"):
            again()
        assert read_staged(spark, path).count() == 10
    stage_batch(staged(spark, [D] * 3).drop("ins_dt"), path, D)
    assert read_staged(spark, path).count() == 3 and before.count() == 10
    stage_batch(staged(spark, [D] * 4).drop("ins_dt"), path, D)
    assert len(glob.glob(f"{path}/ins_dt={D}/__load=*")) == 2


def test_rows_are_there_when_they_are_published(spark, folder):
    path, rows = f"{folder}/t", staged(spark, [D] * 3).drop("ins_dt")
    written = write_batch(rows, path, D)
    assert written.rows == 3 and LoadLog(spark, path).current() == {}
    publish(spark, written)
    assert read_staged(spark, path).count() == 3


def test_dates_that_are_asked_for(spark, folder):
    path = f"{folder}/t"
    stage(staged(spark, [D, D, OTHER]), path)
    schema = staged(spark, [D]).drop("ins_dt").schema
    assert bag(read_staged(spark, path, schema, dates=[D]).select("ins_dt")) == [(D,), (D,)]
    assert len(read_staged(spark, path, schema, dates=[OTHER]).inputFiles()) == 1
    assert read_staged(spark, path, schema, dates=[datetime.date(2020, 1, 1)]).count() == 0
    with pytest.raises(LookupError):
        read_staged(spark, path, dates=[])


def test_a_table_that_was_never_loaded(spark, folder):
    with pytest.raises(LookupError):
        PathWarehouse(folder).read(spark, "T")


def test_credentials_are_not_shown():
    shown = repr(JdbcWarehouse("jdbc:x:", {"user": "u", "password": "secret"}))
    assert "secret" not in shown


def test_landing_of_several_files(spark, folder):
    for n in (1, 2):
        with open(f"{folder}/drop_{n}.csv", "w") as f:
            f.write(f"a|b\n{n}|x\n|\n")
    df = read_delimited(spark, f"{folder}/drop_*.csv", text_schema(["a", "b"]))
    assert bag(df) == sorted([("1", "x"), ("2", "x"), (None, None), (None, None)], key=repr)


def test_header_names_the_columns_when_there_is_no_schema(spark, folder):
    with open(f"{folder}/f.csv", "w") as f:
        f.write("a;b\n1;2\n")
    df = read_delimited(spark, folder, delimiter=";")
    assert df.dtypes == [("a", "string"), ("b", "string")] and bag(df) == [("1", "2")]


def test_other_header_is_an_error_not_a_shift(spark, folder):
    with open(f"{folder}/f.csv", "w") as f:
        f.write("b|a\n1|2\n")
    df = read_delimited(spark, folder, text_schema(["a", "b"]))
    with pytest.raises(Exception, match="(?i)header"):
        df.collect()


@pytest.mark.parametrize("line", ["1", "1|2|3"])
def test_lines_of_another_length(spark, folder, line):
    with open(f"{folder}/f.csv", "w") as f:
        f.write(f"a|b\n1|2\n{line}\n")
    schema = text_schema(["a", "b"])
    for read in (read_delimited(spark, folder, schema), read_delimited(spark, folder, schema).select("a")):
        with pytest.raises(Exception, match="(?i)malformed"):
            read.collect()
    kept = read_delimited(spark, folder, schema, malformed="keep")
    second = "2" if "|" in line else None
    assert bag(kept) == sorted([("1", "2", None), ("1", second, line)], key=repr)
    with pytest.raises(ValueError):
        read_delimited(spark, folder, schema, malformed="drop")


def test_a_truncated_document(spark, folder):
    with open(f"{folder}/f.json", "w") as f:
        f.write('{"_id": "d1", "consumer_id": "c1"}\n{"_id": "d2", "consu\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_documents(spark, folder, schemas.ADDRESSES).collect()
    kept = read_documents(spark, folder, schemas.ADDRESSES, malformed="keep").cache()
    assert bag(kept.select("consumer_id", "_corrupt_record")) == [("c1", None), (None, '{"_id": "d2", "consu')]


def test_delimited_without_header(spark, folder):
    with open(f"{folder}/f.csv", "w") as f:
        f.write("1|2\n3|4\n")
    df = read_delimited(spark, folder, text_schema(["a", "b"]), header=False)
    assert bag(df) == [("1", "2"), ("3", "4")]


def test_documents_with_missing_parts(spark, folder):
    docs = [
        {"_id": "d1", "consumer_id": "c1", "address": {"street": "s", "city": "c", "state": "t"}},
        {"_id": "d2", "consumer_id": "c2", "address": {"city": "c"}},
        {"consumer_id": "c3"},
    ]
    with open(f"{folder}/f.json", "w") as f:
        f.write("\n".join(map(json.dumps, docs)))
    df = read_documents(spark, folder, schemas.ADDRESSES).select("consumer_id", "address.*")
    assert bag(df) == [("c1", "s", "c", "t"), ("c2", None, "c", None), ("c3", None, None, None)]


def staged(spark, days):
    return spark.createDataFrame([(i, d) for i, d in enumerate(days)], "n int, ins_dt date")


def test_dynamic_overwrite_keeps_other_dates(spark, folder):
    path = f"{folder}/t"
    stage(staged(spark, [D, OTHER, OTHER]), path)
    stage(staged(spark, [D, D]), path)
    stage(staged(spark, [D, D]), path)
    got = read_staged(spark, path).groupBy("ins_dt").count()
    assert bag(got) == [(OTHER, 2), (D, 2)]


def test_static_overwrite_drops_other_dates(spark, folder):
    path = f"{folder}/t"
    stage(staged(spark, [D, OTHER]), path, mode="static")
    stage(staged(spark, [D]), path, mode="static")
    assert bag(read_staged(spark, path).select("ins_dt")) == [(D,)]


def test_missing_load_date_is_read_back_as_a_null_date(spark, folder):
    path, df = f"{folder}/t", staged(spark, [None])
    stage(df, path)
    back = read_staged(spark, path, df.drop("ins_dt").schema)
    assert back.schema["ins_dt"].dataType.simpleString() == "date"
    assert bag(back) == [(0, None)]


def test_unknown_mode(spark, folder):
    with pytest.raises(ValueError):
        stage(staged(spark, [D]), folder, mode="append")


def test_a_large_date_is_written_by_several_tasks(spark, folder):
    """A third and more of the rows on one date; a repartition by date would leave one task."""
    day = F.when(F.col("id") % 10 < 7, F.lit(D)).otherwise(
        F.date_add(F.lit(D), (F.col("id") % 10).cast("int"))
    )
    df = spark.range(0, 80_000, 1, 8).select(F.uuid().alias("u"), day.alias("ins_dt"))
    with settings(
        spark,
        spark__sql__adaptive__advisoryPartitionSizeInBytes="256KB",
        spark__sql__adaptive__optimizeSkewsInRebalancePartitions__enabled="true",
    ):
        stage(df, f"{folder}/t", many_dates=True)
    assert len(glob.glob(f"{folder}/t/ins_dt={D}/*/*.parquet")) > 2
    for other in glob.glob(f"{folder}/t/ins_dt=*"):
        assert len(glob.glob(f"{other}/*/*.parquet")) < 16
    assert read_staged(spark, f"{folder}/t").count() == 80_000


def test_one_batch_is_written_without_a_shuffle(spark, folder):
    df = spark.range(0, 1000, 1, 6).withColumn("ins_dt", F.lit(D))
    stage(df, f"{folder}/t")
    assert len(glob.glob(f"{folder}/t/ins_dt={D}/*/*.parquet")) == 6


def test_path_warehouse_replaces_a_table(spark, folder):
    warehouse = PathWarehouse(folder)
    warehouse.overwrite(spark.range(10), "T")
    warehouse.overwrite(spark.range(3), "T")
    assert warehouse.read(spark, "T").count() == 3


def test_catalog_warehouse_leaves_the_previous_load_readable(spark, folder):
    warehouse = CatalogWarehouse(folder)
    warehouse.overwrite(spark.range(10), "cat_t")
    before = warehouse.read(spark, "cat_t")
    warehouse.overwrite(spark.range(3).withColumn("more", F.lit(1)), "cat_t")
    assert before.count() == 10
    assert bag(warehouse.read(spark, "cat_t")) == [(0, 1), (1, 1), (2, 1)]


def test_a_cluster_has_to_name_folder_and_database():
    bare = SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: default),
        sparkContext=SimpleNamespace(master="spark://host:7077"),
    )
    with pytest.raises(ValueError, match="spark.tillroll.jdbc.url"):
        database(bare)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(bare, "x")


def test_shared_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    a, b = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert a != b and a.startswith(base)

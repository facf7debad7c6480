"""The staging job and the whole batch: stage, dimensions, fact."""

from __future__ import annotations

import datetime
import math
import uuid
from collections.abc import Callable, Collection, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions import date_literal, drop_columns, flatten_struct
from tillroll.loads import LoadLog, staged_loads
from tillroll.operators import repeated_keys
from tillroll.operators.copies import COPIES_PER_PART
from tillroll.operators.keys import DEFAULT_BUCKETS
from tillroll.operators.passes import store_parts
from tillroll.plans.schemas import STAGED
from tillroll.plans.targets import (
    child_dim,
    most_copies,
    registration_dim,
    transaction_fact,
    transaction_fact_parts,
)
from tillroll.session import folder_exists, remove_folder, tidy, tuned
from tillroll.sinks.staging import KEEP, publish, write_batch
from tillroll.sinks.warehouse import Warehouse
from tillroll.sources.files import dates_with_keys, read_staged

# The targets, dimensions first, and their keys. Dense keys split evenly.
TARGETS = {"REGIS_DIM": "REGIS_KEY", "CHILD_DIM": "CHILD_KEY", "RTL_TXN_FCT": "RTL_TXN_KEY"}
# The staged sources that the targets are built from.
NEEDED = {"REGIS_DIM": ("CP", "ADDR"), "CHILD_DIM": ("CP",), "RTL_TXN_FCT": ("SB", "OL")}

# Sources that other dates are looked up in, and the column they are looked up by.
KEYED = {"OL": "SBLP_TRANSACTION_ID"}

# The fact is made in a pass for every so many staged rows, up to a number beyond which the disk
# they save is little beside the files of the tables.
ROWS_PER_PASS, MOST_PASSES = 2_000_000, 4


@dataclass(frozen=True)
class Source:
    """A source to stage: how to read it, a struct to flatten, columns to leave out."""

    read: Callable[[], DataFrame]
    struct: str | None = None
    fields: Sequence[str] = ()
    drop: Sequence[str] = ()


def stage_sources(
    sources: Mapping[str, Source],
    root: str,
    batch_date: str | datetime.date | None = None,
    mode: str = "dynamic",
) -> dict[str, str]:
    """Stage every source under ``root`` with one load date; returns name to path.

    The date is today unless given, the same for all sources. Other dates staged earlier are
    kept, or with ``mode="static"`` removed.

    All sources are written before any is published, so one that cannot be read leaves the date as
    it was for all of them. A note of the batch, with each source's load, rows and columns, is left
    at the end; until it is, ``build_targets`` takes the date for half staged.
    """
    paths = {name: f"{root.rstrip('/')}/{name}" for name in sources}
    day, frames, written = batch_date, {}, {}
    for name, source in sources.items():
        df = source.read()
        day = day or df.sparkSession.range(1).select(F.current_date()).first()[0]
        if source.struct is not None:
            df = flatten_struct(df, source.struct, source.fields)
        frames[name] = drop_columns(df, *source.drop)
        key = KEYED.get(name)
        written[name] = write_batch(frames[name], paths[name], day, key=key if key in frames[name].columns else None)
    for name, load in written.items():
        publish(frames[name].sparkSession, load, others=mode == "dynamic")
    if written:
        spark = next(iter(frames.values())).sparkSession
        log = LoadLog(spark, root)
        known = log.current().get(str(day))
        before = log.facts(known)["sources"] if known else {}
        loads = {name: load.facts() for name, load in written.items()}
        log.add(str(day), uuid.uuid4().hex, {"sources": {**before, **loads}})
        log.trim(str(day), KEEP)
    return paths


def check_staged(
    spark: SparkSession, root: str, names: Iterable[str], day: datetime.date, schemas: Mapping[str, T.StructType]
) -> None:
    """Raise unless each source has a complete load of the date, the one the batch was staged with,
    and its files hold the rows that were staged."""
    batches = LoadLog(spark, root)
    batch = batches.current().get(str(day))
    noted = batches.facts(batch)["sources"] if batch else {}
    missing, half, short = [], [], []
    for name in names:
        current = staged_loads(spark, f"{root}/{name}")
        if current is None and folder_exists(spark, f"{root}/{name}/ins_dt={day}"):
            continue  # staged by something else, which leaves no log
        load = (current or {}).get(str(day))
        if load is None:
            missing.append(name)
        elif name in noted and noted[name]["load"] != load.load:
            half.append(name)
        else:
            expected = LoadLog(spark, f"{root}/{name}").facts(load)["rows"]
            found = read_staged(spark, f"{root}/{name}", schemas.get(name), dates=[day]).count()
            if found != expected:
                short.append(f"{name}: {found} rows, {expected} were staged")
    if missing:
        raise ValueError(f"not staged on {day}: {missing}")
    if half:
        raise ValueError(f"half staged on {day}, stage the batch again: {half}")
    if short:
        raise ValueError(f"staged files of {day} are not whole: {short}")


def build_targets(
    spark: SparkSession,
    staging_root: str,
    warehouse: Warehouse,
    batch_date: str | datetime.date,
    targets: Collection[str] = tuple(TARGETS),
    time_zone: str = "UTC",
    fact_key: str = "dense",
    buckets: int = DEFAULT_BUCKETS,
    staged_schemas: Mapping[str, T.StructType] = STAGED,
) -> dict[str, DataFrame]:
    """Build targets of one batch from the staged sources and load them; returns them read back.

    Dimensions come before the fact, which joins the registrations as read back from the
    warehouse, whether loaded now or earlier. The dimensions are those of the batch: staging
    keeps earlier dates, and a consumer taken once per date would multiply the fact. Receipts
    are read on all dates that may hold one for a transaction of the batch, by the filters of keys
    that staging left, because a transaction whose receipts came in another batch is not one
    without receipts.

    Every source the targets need must have been staged on the date, be it empty, by a staging that
    came to its end, and with all its rows; otherwise nothing is loaded. Staged files are read by ``staged_schemas``, not by the footer of one of
    them; a source that is not named there is read by its footers. The session has its own time
    zone and settings again when the targets are loaded.
    """
    unknown = set(targets) - set(TARGETS)
    if unknown:
        raise ValueError(f"unknown targets: {sorted(unknown)}")
    root, day = staging_root.rstrip("/"), datetime.date.fromisoformat(str(batch_date))
    needed = dict.fromkeys(name for target in targets for name in NEEDED[target])
    with tidy(spark):
        check_staged(spark, root, needed, day, staged_schemas)

    def staged(name: str, dates: Collection[str] | None = (str(day),)) -> DataFrame:
        return read_staged(spark, f"{root}/{name}", staged_schemas.get(name), dates=dates)

    def loaded(name: str) -> DataFrame:
        return warehouse.read(spark, name, split_on=TARGETS[name])

    in_batch = F.col("ins_dt") == date_literal(batch_date)
    with tuned(spark, time_zone):
        if "REGIS_DIM" in targets:
            consumers, addresses = staged("CP").filter(in_batch), staged("ADDR").filter(in_batch)
            dim = registration_dim(consumers, addresses, buckets=buckets)
            warehouse.overwrite(dim, "REGIS_DIM")
        if "CHILD_DIM" in targets:
            children = child_dim(staged("CP"), batch_date, buckets=buckets)
            warehouse.overwrite(children, "CHILD_DIM")
        if "RTL_TXN_FCT" in targets:
            registrations, transactions = loaded("REGIS_DIM"), staged("SB")
            alone = set(staged_loads(spark, f"{root}/OL") or ()) == {str(day)}
            held = [] if alone else dates_with_keys(spark, f"{root}/OL", transactions, "App_Transaction_Id")
            receipts = staged("OL", None if held is None else {*held, str(day)})
            few = fact_key == "dense" and (
                most_copies(transactions, receipts, registrations) <= COPIES_PER_PART
            )
            frames = (transactions, receipts, registrations, batch_date)
            options = {"key": fact_key, "buckets": buckets, "few_copies": few}
            passes = math.ceil((transactions.count() + receipts.count()) / ROWS_PER_PASS)
            if passes <= 1:
                warehouse.overwrite(transaction_fact(*frames, **options), "RTL_TXN_FCT")
            else:
                scratch = f"{root}/_passes-{uuid.uuid4().hex}"
                try:
                    parts = transaction_fact_parts(
                        *frames, f"{scratch}/fact", min(passes, MOST_PASSES), **options
                    )
                    if hasattr(warehouse, "overwrite_parts"):
                        warehouse.overwrite_parts(parts, "RTL_TXN_FCT")
                    else:
                        warehouse.overwrite(store_parts(parts, f"{scratch}/all"), "RTL_TXN_FCT")
                finally:
                    remove_folder(spark, scratch)
        return {name: loaded(name) for name in TARGETS if name in targets}


def run_batch(
    spark: SparkSession,
    sources: Mapping[str, Source],
    staging_root: str,
    warehouse: Warehouse,
    batch_date: str | datetime.date,
    time_zone: str = "UTC",
    fact_key: str = "dense",
    buckets: int = DEFAULT_BUCKETS,
    staged_schemas: Mapping[str, T.StructType] = STAGED,
) -> dict[str, DataFrame]:
    """Stage ``SB``, ``OL``, ``CP`` and ``ADDR``, then build and load all targets.

    Running a batch date again leaves the same staged dates and the same tables, keys included.

    Returns the loaded tables, and as ``REPEATED_CONSUMERS`` the consumers on several rows of
    the registration dimension, each of which repeats its facts.
    """
    with tuned(spark, time_zone):
        stage_sources(sources, staging_root, batch_date)
    loaded = build_targets(
        spark,
        staging_root,
        warehouse,
        batch_date,
        time_zone=time_zone,
        fact_key=fact_key,
        buckets=buckets,
        staged_schemas=staged_schemas,
    )
    return {**loaded, "REPEATED_CONSUMERS": repeated_keys(loaded["REGIS_DIM"], "CNSM_ID")}

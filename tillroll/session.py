"""Session settings the jobs rely on, and the shared folder they may write to."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Collection, Iterator, Mapping

from pyspark.sql import SparkSession

# A join that feeds a DISTINCT on the same key keeps its partitioning, and Spark then
# leaves a hot key in one task unless it is told that splitting matters more.
SKEW_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Shuffle files go with the query that wrote them. Otherwise they stay until the driver happens to
# collect its garbage, and a batch would hold those of all its queries at once.
TIDY_SETTINGS = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def tune(spark: SparkSession, time_zone: str | None = None) -> SparkSession:
    """Apply the skew settings and, if given, the time zone used by hour/minute/second."""
    for name, value in SKEW_SETTINGS.items():
        spark.conf.set(name, value)
    if time_zone is not None:
        spark.conf.set("spark.sql.session.timeZone", time_zone)
    return spark


@contextlib.contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[SparkSession]:
    """Settings for the work inside, all of which has to run inside; then as it was before."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield spark
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def tidy(spark: SparkSession) -> contextlib.AbstractContextManager[SparkSession]:
    """Queries made and run inside leave no shuffle files."""
    return settings(spark, TIDY_SETTINGS)


def tuned(
    spark: SparkSession, time_zone: str | None = None
) -> contextlib.AbstractContextManager[SparkSession]:
    """What ``tune`` and ``tidy`` set, for the work inside."""
    zone = {} if time_zone is None else {"spark.sql.session.timeZone": time_zone}
    return settings(spark, SKEW_SETTINGS | TIDY_SETTINGS | zone)


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file is there, in whatever store its path names."""
    place, store = _place(spark, path)
    return store.exists(place)


def write_new_note(spark: SparkSession, path: str, text: str) -> None:
    """Put a short text in a file that is not there yet; readers find all of it or no file."""
    fresh, store = _place(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    out = store.create(fresh, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not store.rename(fresh, _place(spark, path)[0]):
        store.delete(fresh, False)
        raise FileExistsError(path)


def read_note(spark: SparkSession, path: str) -> str | None:
    """The text of a file, or None if there is none."""
    place, store = _place(spark, path)
    if not store.exists(place):
        return None
    stream = store.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove_folder(spark: SparkSession, path: str) -> None:
    place, store = _place(spark, path)
    store.delete(place, True)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if it is not there."""
    place, store = _place(spark, path)
    return [f.getPath().getName() for f in store.listStatus(place)] if store.exists(place) else []


def find_folders(spark: SparkSession, path: str, pattern: str) -> list[tuple[str, str]]:
    """Names of the folders two levels below a path that fit a pattern, with that they lie in."""
    place, store = _place(spark, f"{path}/{pattern}")
    found = (f.getPath() for f in store.globStatus(place) or ())
    return sorted((p.getParent().getName(), p.getName()) for p in found)


def drop_other_folders(spark: SparkSession, path: str, prefix: str, keep: Collection[str]) -> None:
    """Remove the folders below a path that begin with a prefix and are not among those to keep."""
    for name in list_folder(spark, path):
        if name.startswith(prefix) and name not in keep:
            remove_folder(spark, f"{path}/{name}")


def one_process(spark: SparkSession) -> bool:
    """Whether driver and executors are the same process."""
    return spark.sparkContext.master.split("[")[0] == "local"


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder that every executor can reach.

    Lies under ``spark.checkpoint.dir``. Only a local master, where the driver is the one
    executor, may fall back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not one_process(spark):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tillroll-")
    return f"{base.rstrip('/')}/tillroll/{label}-{uuid.uuid4().hex}"

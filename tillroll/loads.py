"""The log of complete loads: a load is there when its note is."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import SparkSession

from tillroll.session import find_folders, list_folder, read_note, remove_folder, write_new_note

#: The partition column that tells loads of a date apart.
LOAD = "__load"

#: Where filters of keys lie, below a staged path.
KEYS = "_keys"

_NAME = re.compile(r"(?P<key>.*)\.(?P<number>\d{8,})\.(?P<load>[^.]+)\.json")


def load_folder(path: str, batch_column: str, date: str, load: str) -> str:
    """Where the files of one load of a date lie."""
    return f"{path.rstrip('/')}/{batch_column}={date}/{LOAD}={load}"


@dataclass(frozen=True, order=True)
class Load:
    """A complete load of a key, by the order they were completed in."""

    number: int
    load: str
    name: str = field(compare=False)


class LoadLog:
    """Notes of complete loads below a path, by key (a table, a load date), numbered in order.

    A load writes its files to a folder of its own, and adds its note when they are complete. A note
    has a name of its own and is never changed or replaced, so readers find either all of it or
    nothing, on object stores too, where a rename over an old note would be a copy and a delete. What
    is current follows from the names, one listing for all keys; the text of a note tells more of one
    load. Modification times are not asked for. One load of a key at a time; loads of different keys
    do not touch each other's notes.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, f"{path.rstrip('/')}/_loads"

    def loads(self) -> dict[str, list[Load]]:
        """The complete loads of each key, the current one last."""
        found: dict[str, list[Load]] = {}
        for name in list_folder(self.spark, self.path):
            if note := _NAME.fullmatch(name):
                found.setdefault(note["key"], []).append(Load(int(note["number"]), note["load"], name))
        return {key: sorted(loads) for key, loads in found.items()}

    def current(self) -> dict[str, Load]:
        return {key: loads[-1] for key, loads in self.loads().items()}

    def facts(self, load: Load) -> dict[str, Any]:
        """What the note of a load says."""
        text = read_note(self.spark, f"{self.path}/{load.name}")
        return json.loads(text) if text else {}

    def add(self, key: str, load: str, facts: dict[str, Any]) -> Load:
        """Make a load the current one of its key."""
        known = self.loads().get(key, [])
        number = known[-1].number + 1 if known else 1
        name = f"{key}.{number:08d}.{load}.json"
        write_new_note(self.spark, f"{self.path}/{name}", json.dumps(facts))
        return Load(number, load, name)

    def trim(self, key: str, keep: int) -> set[str]:
        """Forget the loads of a key but the latest ``keep`` complete ones, which it returns."""
        known = self.loads().get(key, [])
        for old in known[: max(0, len(known) - keep)]:
            remove_folder(self.spark, f"{self.path}/{old.name}")
        return {kept.load for kept in known[-keep:]}

    def drop(self, key: str) -> None:
        """Forget all loads of a key."""
        for load in self.loads().get(key, []):
            remove_folder(self.spark, f"{self.path}/{load.name}")


def staged_loads(spark: SparkSession, path: str, batch_column: str = "ins_dt") -> dict[str, Load] | None:
    """The current load of each date of a staged path; None where it was staged by something else.

    Files of a load that nobody published, say because its driver was lost, are not read as such.
    """
    current = LoadLog(spark, path).current()
    if current or find_folders(spark, path.rstrip("/"), f"{batch_column}=*/{LOAD}=*"):
        return current
    return None

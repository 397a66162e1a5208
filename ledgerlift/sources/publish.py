"""Named tables in versions that readers see whole.

A version's tables are written to a folder of its own. Only then a small commit file with
the next number is created; it names the folder, the tables and their row counts. Readers
take the highest commit, or the one they name, and keep reading that folder, whatever is
published meanwhile. A run that dies before its commit leaves files that no reader sees.
Two runs that publish at once cannot both create the same number: the second raises.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ledgerlift.sources.stages import counted_write

_COMMITS = "commits"


class Conflict(RuntimeError):
    """Someone else published the version that this run was about to publish."""


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    rows: dict[str, int]

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        if name not in self.rows:
            raise KeyError(f"version {self.number} has no table {name!r}")
        return spark.read.parquet(f"{self.folder}/{name}")


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the published versions, ascending."""
    files, place = _files(spark, f"{root}/{_COMMITS}")
    if not files.exists(place):
        return []
    names = [status.getPath().getName() for status in files.listStatus(place)]
    return sorted(int(n) for n in names if n.isdigit())


def _commit(spark: SparkSession, root: str, number: int) -> Version | None:
    """The version a commit file names; None while its writer has not closed it."""
    files, place = _files(spark, f"{root}/{_COMMITS}/{number}")
    size = files.getFileStatus(place).getLen()
    stream = files.open(place)
    try:
        text = bytes(stream.readNBytes(size)).decode()
    finally:
        stream.close()
    try:
        entry = json.loads(text)
    except ValueError:
        return None
    return Version(number, f"{root}/{entry['folder']}", entry["rows"])


def version(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """The named version, or the newest; LookupError if there is none."""
    for n in reversed(versions(spark, root)) if number is None else [number]:
        if number is not None and n not in versions(spark, root):
            break
        if found := _commit(spark, root, n):
            return found
    raise LookupError(f"no published version{'' if number is None else f' {number}'} in {root}")


def publish(spark: SparkSession, root: str, tables: Mapping[str, DataFrame], after: int | None = None) -> Version:
    """Write the tables and make them the newest version.

    ``after`` is the version they were made from (the newest by default); if another has
    been published since, ``Conflict`` is raised and nothing changes for readers.
    """
    known = versions(spark, root)
    number = (known[-1] if known else 0) + 1 if after is None else after + 1
    folder = f"versions/{number}-{uuid.uuid4().hex}"
    rows = {name: counted_write(df, f"{root}/{folder}/{name}") for name, df in tables.items()}
    entry = json.dumps({"folder": folder, "rows": rows}, sort_keys=True)
    files, place = _files(spark, f"{root}/{_COMMITS}/{number}")
    files.mkdirs(place.getParent())
    try:
        stream = files.create(place, False)  # fails where the file exists
    except Exception as failed:
        if files.exists(place):
            raise Conflict(f"version {number} of {root} has been published by another run") from failed
        raise
    try:
        stream.write(bytearray(entry.encode()))
    finally:
        stream.close()
    return Version(number, f"{root}/{folder}", rows)

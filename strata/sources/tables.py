"""Published tables: immutable folders and one small pointer file a version.

    <table>/<folder>/part-*.parquet          written once, never changed or renamed
    <table>/_pointers/0000000007.json        version 7: the folders it consists of, its schema, facts about it

A version is published by creating its pointer, which fails if that number exists. So a reader sees the version
before or the one after, never a mixture or nothing; a DataFrame keeps reading the folders it was made from; a publisher
that dies leaves the old version current, whatever step it had reached (a pointer that was created but not
filled is passed over); and two publishers cannot both take a number. No folder is moved, so nothing depends on
atomic renames. A version may share folders with the one before: unchanged parts are named again, not copied.

The newest ``KEEP`` versions stay readable; ``expire`` removes what only older ones name.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from strata.session import hadoop_path

POINTERS, KEEP, ORPHAN_HOURS = "_pointers", 2, 24


class PublishConflict(RuntimeError):
    """Another publisher took the version that this one was built to follow."""


@dataclass(frozen=True)
class Version:
    """What a pointer says: parts by name (one unnamed part where a table has no parts), schema, facts."""

    number: int
    parts: dict[str, str]
    schema: StructType
    facts: dict = field(default_factory=dict)


def _inside(table: str, name: str) -> str:
    return f"{table.rstrip('/')}/{name}"


def _text(spark: SparkSession, uri: str) -> str:
    fs, path = hadoop_path(spark, uri)
    stream = fs.open(path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _numbers(spark: SparkSession, table: str) -> list[int]:
    """Numbers of all pointers, filled or not, rising."""
    fs, folder = hadoop_path(spark, _inside(table, POINTERS))
    if not fs.exists(folder):
        return []
    names = [x.getPath().getName() for x in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _pointer(table: str, number: int) -> str:
    return _inside(table, f"{POINTERS}/{number:010d}.json")


def version(spark: SparkSession, table: str, number: int) -> Version | None:
    """One version; None if there is no such pointer, or it was never filled."""
    fs, path = hadoop_path(spark, _pointer(table, number))
    if not fs.exists(path):
        return None
    try:
        said = json.loads(_text(spark, _pointer(table, number)))
    except ValueError:
        return None
    return Version(said["version"], said["parts"], StructType.fromJson(said["schema"]), said["facts"])


def history(spark: SparkSession, table: str) -> list[Version]:
    """All readable versions, oldest first."""
    return [v for n in _numbers(spark, table) if (v := version(spark, table, n))]


def current(spark: SparkSession, table: str) -> Version | None:
    for n in reversed(_numbers(spark, table)):
        if found := version(spark, table, n):
            return found
    return None


def frame(spark: SparkSession, table: str, v: Version) -> DataFrame:
    """The rows of a version."""
    if not v.parts:
        return spark.createDataFrame([], v.schema)
    return spark.read.schema(v.schema).parquet(*[_inside(table, p) for _, p in sorted(v.parts.items())])


def read_table(spark: SparkSession, table: str, number: int | None = None) -> DataFrame:
    """A published table, its newest version or a given one; a plain Parquet folder is read as it is."""
    found = current(spark, table) if number is None else version(spark, table, number)
    if found is None:
        if number is not None:
            raise ValueError(f"{table} has no version {number}")
        return spark.read.parquet(table)
    return frame(spark, table, found)


def stage(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> str:
    """Write a new folder of the table, which no version names yet; returns its location.

    No ``coalesce(1)``: every task writes its own file, AQE sizes the partitions, and the commit protocol makes a
    retried task (lost executor) safe.
    """
    staged = _inside(table, uuid.uuid4().hex)
    w = df.write.mode("errorifexists")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(staged)
    return staged


def discard(spark: SparkSession, staged: str) -> None:
    """Remove a folder that no version names, and the table's own folder if nothing else is in it."""
    fs, path = hadoop_path(spark, staged)
    fs.delete(path, True)
    table = path.getParent()
    if fs.exists(table) and not fs.listStatus(table):
        fs.delete(table, False)


def commit(spark: SparkSession, table: str, parts: dict[str, str], schema: StructType, facts: dict | None = None,
           follows: int | None = None) -> Version:
    """Publish folders (named as within the table) as the next version.

    ``follows``: the version the parts were built upon (0: none); if another one has come since, PublishConflict.
    Without it, the table is replaced whatever came before.
    """
    while True:
        number = (_numbers(spark, table) or [0])[-1] + 1
        base = current(spark, table)
        if follows is not None and (base.number if base else 0) != follows:
            raise PublishConflict(f"{table} is at version {base.number if base else 0}, not {follows}")
        made = Version(number, dict(parts), schema, facts or {})
        fs, path = hadoop_path(spark, _pointer(table, number))
        try:
            out = fs.create(path, False)
        except Exception as e:  # noqa: BLE001 - py4j wraps FileAlreadyExistsException
            if "already exists" not in str(e) and "FileAlreadyExists" not in str(e):
                raise
            continue
        try:
            out.write(bytearray(json.dumps({"version": number, "parts": made.parts, "schema": json.loads(schema.json()),
                                            "facts": made.facts}, sort_keys=True).encode()))
        finally:
            out.close()
        return made


def switch(spark: SparkSession, staged: str, table: str, schema: StructType | None = None, facts: dict | None = None) -> str:
    """Make a complete staged folder the table's next version."""
    fs, path = hadoop_path(spark, f"{staged.rstrip('/')}/_SUCCESS")
    if not fs.exists(path):
        raise OSError(f"{staged} is not a complete folder")
    commit(spark, table, {"": path.getParent().getName()}, schema or spark.read.parquet(staged).schema, facts)
    expire(spark, table)
    return table


def publish(df: DataFrame, table: str, partition_by: Sequence[str] | None = None) -> str:
    """Replace a table; readers of the old version keep it."""
    return switch(df.sparkSession, stage(df, table, partition_by or ()), table,
                  df.select(*[c for c in df.columns if c not in (partition_by or ())], *(partition_by or ())).schema)


def expire(spark: SparkSession, table: str, keep: int = KEEP, orphan_hours: float = ORPHAN_HOURS) -> list[str]:
    """Remove pointers before the newest ``keep`` versions and the folders only they name; returns the folders.

    Folders that no version names are another publisher's work, or what a dead one left: they go after ``orphan_hours``.
    """
    told = history(spark, table)
    kept, old = told[-keep:], told[:-keep]
    top = lambda vs: {p.split("/")[0] for v in vs for p in v.parts.values()}
    fs, folder = hadoop_path(spark, table)
    gone = sorted(top(old) - top(kept))
    for x in fs.listStatus(folder) if fs.exists(folder) else []:
        name = x.getPath().getName()
        late = time.time() - x.getModificationTime() / 1000 > orphan_hours * 3600
        if x.isDirectory() and not name.startswith(("_", ".")) and name not in top(told) and late:
            gone.append(name)
    for v in old:  # pointers first: no version may name what is gone
        fs.delete(hadoop_path(spark, _pointer(table, v.number))[1], False)
    for name in gone:
        fs.delete(hadoop_path(spark, _inside(table, name))[1], True)
    return gone

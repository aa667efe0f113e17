"""Versions of stored tables: data goes to new folders, and one small file takes them into use.

A version file names the folders that make up the table. It is numbered and created only if its number is free, so of two
writers that start from the same version one goes through and the other is told. Readers take the newest
version: a writer that is lost before that file changes nothing, and one that is lost after it has left a whole table.
The file system must create files only if absent when asked to (HDFS and conditional object stores do).
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.operators.latest import latest_wins

# Seconds after which a version file that is not complete counts as left behind by a lost writer.
PATIENCE = 5.0
# Versions whose folders are kept for readers that have begun.
KEPT = 2
# Up to so many keys are looked for by a pushed-down filter, which skips row groups by statistics and Bloom filters.
PUSHED_KEYS = 1_000
DATA = "_data"
LANDED_IN = "landed_in"


class Conflict(Exception):
    """Another writer was first, and what it wrote is not what this one started from."""


class VersionLog:
    """Numbered JSON documents in a folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        self._hadoop = spark._jvm.org.apache.hadoop.fs

    def _files(self):
        path = self._hadoop.Path(self.folder)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        path, files = self._files()
        if not files.exists(path):
            return []
        names = [status.getPath().getName() for status in files.listStatus(path)]
        return sorted(int(name.split(".")[0]) for name in names if name.endswith(".json"))

    def get(self, number: int) -> dict | None:
        """The document of a number; None if it is not complete."""
        _, files = self._files()
        stream = files.open(self._hadoop.Path(self._path(number)))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text) if text.endswith("\n") else None

    def newest(self) -> tuple[int, dict | None]:
        """The highest number taken (0 without any) and the newest complete document."""
        numbers, until = self.numbers(), time.monotonic() + PATIENCE
        for number in reversed(numbers):
            while (found := self.get(number)) is None and time.monotonic() < until:
                time.sleep(0.1)
            if found is not None:
                return numbers[-1], found
        return (numbers or [0])[-1], None

    def put(self, number: int, document: dict) -> bool:
        """Take a number with its document; False if another writer has it."""
        _, files = self._files()
        try:
            out = files.create(self._hadoop.Path(self._path(number)), False)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        out.write(bytearray(json.dumps(document).encode() + b"\n"))
        out.close()
        return True

    def delete(self, number: int) -> None:
        self._files()[1].delete(self._hadoop.Path(self._path(number)), False)

    def _path(self, number: int) -> str:
        return f"{self.folder}/{number:010d}.json"


@dataclass(frozen=True)
class Snapshot:
    """A version of a table: its folders by value of the partition column (one, named "", without such a column)."""

    number: int = 0
    parts: dict[str, str] = field(default_factory=dict)
    # The least and the greatest value of the tracked columns, by partition.
    ranges: dict[str, dict[str, list]] = field(default_factory=dict)


class SnapshotTable:
    """A parquet table whose versions are taken into use as a whole.

    `schema` states the columns that readers get; the files may hold more. `tracked` columns have their ranges in the version
    file and Bloom filters in the data files, so that keys are found without reading every partition.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: str, partition_by: str | None = None, tracked: Sequence[str] = ()
    ) -> None:
        self.spark, self.path, self.schema = spark, path, schema
        self.partition_by, self.tracked = partition_by, list(tracked)
        self.log = VersionLog(spark, f"{path}/_versions")

    def snapshot(self) -> Snapshot | None:
        """The newest version; None if the table has none."""
        number, found = self.log.newest()
        return Snapshot(number, found["parts"], found["ranges"]) if found else None

    def _read(self, snapshot: Snapshot, parts: Iterable[str] | None = None, extra: str = "") -> DataFrame:
        folders = [f"{self.path}/{snapshot.parts[part]}" for part in (snapshot.parts if parts is None else parts)]
        known = self.schema + (f", {extra}" if extra else "")
        if self.partition_by:
            known += f", `{self.partition_by}` string"
        if not folders:
            return self.spark.createDataFrame([], known)
        reader = self.spark.read.schema(f"{known}, {DATA} string").option("basePath", self.path)
        return reader.parquet(*folders).drop(DATA)

    def read(self, snapshot: Snapshot | None = None, parts: Iterable[str] | None = None, extra: str = "") -> DataFrame:
        """The table of a version, the newest by default, or some of its partitions; a table without version is empty.

        The partition column comes last. `extra` names further columns of the files.
        """
        return self._read(snapshot or self.snapshot() or Snapshot(), parts, extra)

    def write(self, df: DataFrame) -> Snapshot:
        """Write rows to folders of their own; they are part of no version yet."""
        folder = f"{DATA}={uuid.uuid4().hex}"
        options = {f"parquet.bloom.filter.enabled#{c}": "true" for c in self.tracked}
        if not self.partition_by:
            df.write.options(**options).parquet(f"{self.path}/{folder}")
            return Snapshot(parts={"": folder})
        writer = df.hint("rebalance", self.partition_by).write.options(**options).partitionBy(self.partition_by)
        writer.parquet(f"{self.path}/{folder}")
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        root = hadoop.Path(f"{self.path}/{folder}")
        statuses = root.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(root)
        names = [status.getPath().getName() for status in statuses if status.isDirectory()]
        parts = {unquote(name.split("=", 1)[1]): f"{folder}/{name}" for name in names if "=" in name}
        return Snapshot(parts=parts, ranges=self._ranges(Snapshot(parts=parts), df) if self.tracked and parts else {})

    def _ranges(self, written: Snapshot, df: DataFrame) -> dict[str, dict[str, list]]:
        kinds = {c: df.schema[c].dataType.simpleString() for c in self.tracked}
        extra = ", ".join(f"`{c}` {kind}" for c, kind in kinds.items() if c not in _names(self.schema))
        ends = [f(c).alias(f"{name}_{c}") for c in self.tracked for name, f in (("least", F.min), ("most", F.max))]
        part = F.coalesce(self.partition_by, F.lit(NO_VALUE)).alias("part")
        rows = self._read(written, extra=extra).groupBy(part).agg(*ends).collect()  # a row for each partition
        return {row.part: {c: [row[f"least_{c}"], row[f"most_{c}"]] for c in self.tracked} for row in rows}

    def commit(self, base: Snapshot | None, parts: dict[str, str], ranges: dict[str, dict[str, list]]) -> bool:
        """Take folders into use as the version after `base`; False if another one has come after it."""
        number = base.number if base else 0
        if not self.log.put(number + 1, {"parts": parts, "ranges": ranges}):
            return False
        self._sweep()
        return True

    def rebuild(self, df: DataFrame) -> Snapshot:
        """Replace the whole table by rows, whatever version it has meanwhile."""
        written = self.write(df)
        while not self.commit(base := self.snapshot(), written.parts, written.ranges):
            pass
        return Snapshot((base.number if base else 0) + 1, written.parts, written.ranges)

    def replace(self, base: Snapshot | None, gone: Iterable[str], df: DataFrame) -> Snapshot:
        """Replace the partitions `gone` of the version `base` by those of `df`; all others keep their folders.

        Raises Conflict if another writer has been first.
        """
        base, gone, written = base or Snapshot(), set(gone), self.write(df)
        if clash := written.parts.keys() & base.parts.keys() - gone:
            raise ValueError(f"rows for partitions that are not replaced: {sorted(clash)}")
        parts = {part: folder for part, folder in base.parts.items() if part not in gone} | written.parts
        ranges = {part: known for part, known in base.ranges.items() if part not in gone} | written.ranges
        if not self.commit(base, parts, ranges):
            raise Conflict(self.path)
        return Snapshot(base.number + 1, parts, ranges)

    def holding(self, snapshot: Snapshot, column: str, values: DataFrame) -> set[str]:
        """The partitions that hold any of the values of a one-column frame.

        Partitions whose range does not meet that of the values are not read; of the others only the column is.
        """
        least, most, n = values.agg(F.min(column), F.max(column), F.count(column)).first()
        if not n:
            return set()
        ranges = snapshot.ranges
        meets = lambda r: r is None or r[0] is not None and r[0] <= most and r[1] >= least
        near = [part for part in snapshot.parts if meets(ranges.get(part, {}).get(column))]
        kind = values.schema[column].dataType.simpleString()
        rows = self._read(snapshot, near, "" if column in _names(self.schema) else f"`{column}` {kind}")
        rows = rows.select(column, F.coalesce(self.partition_by, F.lit(NO_VALUE)).alias("part"))
        if n <= PUSHED_KEYS:
            rows = rows.filter(F.col(column).isin([row[0] for row in values.dropna().distinct().collect()]))
        else:
            rows = rows.join(values, column, "left_semi")
        return {row.part for row in rows.select("part").distinct().collect()}

    def _sweep(self) -> None:
        """Delete the folders that only versions before the last KEPT have, and those versions."""
        numbers = self.log.numbers()
        used = {folder for n in numbers[-KEPT:] for folder in _folders(self.log.get(n))}
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        for number in numbers[:-KEPT]:
            for folder in _folders(self.log.get(number)) - used:
                path = hadoop.Path(f"{self.path}/{folder}")
                path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
            self.log.delete(number)


# How a folder is named for rows without a value of the partition column.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _folders(document: dict | None) -> set[str]:
    return set(document["parts"].values()) if document else set()


def _names(schema: str) -> list[str]:
    return [column.split()[0].strip("`") for column in schema.split(", ")]


def merge_landing(
    table: SnapshotTable, landed: DataFrame, partitions: Sequence[str], parse: Callable[[DataFrame], DataFrame],
    keys: Sequence[str], version: str = "ingested_at",
) -> tuple[DataFrame, DataFrame]:
    """Bring a typed table up to date after some landing partitions were written again.

    `landed` are all raw rows, `parse` makes typed ones of them: the newest version of each key, with the landing
    partition in LANDED_IN and the table's own partition column. Afterwards the table holds what parsing everything would give, but
    only partitions are rewritten that hold a row of those landing partitions, old or new, or an older version of
    such a key. A key that is no longer landed where its newest version came from is looked for in all other raw rows.

    Returns the rows that came and those that went.
    """
    again = F.col("date").isin(list(partitions))
    base = table.snapshot() or Snapshot()
    incoming = parse(landed.filter(again))
    days = table.spark.createDataFrame([(p,) for p in partitions], f"{LANDED_IN} string")
    stale_parts = table.holding(base, LANDED_IN, days)
    kind = f"{LANDED_IN} string"
    stale = table.read(base, stale_parts, kind).filter(F.col(LANDED_IN).isin(list(partitions)))
    vanished = stale.join(incoming, list(keys), "left_anti").select(keys[0]).distinct()
    if not vanished.isEmpty():
        elsewhere = landed.filter(~again).join(vanished, keys[0], "left_semi")
        # Also its other rows there are versions of keys that the table knows already.
        incoming = incoming.unionByName(parse(elsewhere))
    incoming_parts = {row[0] for row in incoming.select(F.coalesce(table.partition_by, F.lit(NO_VALUE))).distinct().collect()}
    held = table.holding(base, keys[0], incoming.select(keys[0]))
    touched = (stale_parts | incoming_parts | held) & base.parts.keys()
    kept = table.read(base, touched, kind).filter(~F.col(LANDED_IN).isin(list(partitions)))
    both = kept.withColumn("_came", F.lit(0)).unionByName(incoming.withColumn("_came", F.lit(1)))
    table.replace(base, touched, latest_wins(both, keys, version, ["_came"]).drop("_came"))
    return incoming, stale


def month_of(day: Column) -> Column:
    """The partition of a day."""
    return F.date_format(day, "yyyy-MM")

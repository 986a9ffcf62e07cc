"""Stored tables as parquet directories with atomic commits.

Parquet has no MERGE, and overwriting the directory a query reads from loses data when the driver
dies midway. So every write goes to a fresh ``commit=<id>`` directory and becomes visible by one
small file, ``_commits/<number>.json``, that lists the directories in use, each with its newest
arrival time. Readers see a whole commit or none, and a reader that wants only rows newer than a
watermark opens only the directories that hold some. A merge rewrites only the date partitions that
its keys touch. Where the table format itself takes row-level changes, use
``operators.merging.merge_into_table`` instead.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.time import micros, utc_date
from candlewick.operators.merging import arriving_keys, broadcast_if, merge_rows, on_keys, repeated_keys
from candlewick.schemas import TABLES, Table
from candlewick.sinks.workspace import drop_folder

PART = "part_date"
# Spark's own directory name for a null partition value.
NULL_PART = "__HIVE_DEFAULT_PARTITION__"
ARRIVAL = "ingested_at"
# Keys of a batch of up to so many rows are broadcast (some ten megabytes); those of a larger one are joined by AQE's choice.
BROADCAST_ROWS = 100_000
# An incomplete commit file this old belongs to a writer that died.
ABANDONED_SECONDS = 60


class Store(Protocol):
    """What plans and streams ask of stored tables; ``Lake`` and ``catalog.CatalogTables`` offer it."""

    spark: SparkSession

    def path(self, name: str) -> str: ...

    def exists(self, name: str) -> bool: ...

    def read(
        self,
        name: str,
        dates: Iterable[object] | None = None,
        from_date: object | None = None,
        arrived_after: datetime | None = None,
    ) -> DataFrame: ...

    def optional(self, name: str) -> DataFrame | None: ...

    def append(self, name: str, df: DataFrame, batch: tuple[str, int] | None = None) -> str: ...

    def overwrite(self, name: str, df: DataFrame) -> str: ...

    def upsert(
        self, name: str, source: DataFrame, newer_than: Sequence[str] = (), delete_unmatched: bool = False
    ) -> str: ...

    def replace_dates(self, name: str, df: DataFrame, dates: Iterable[object]) -> str: ...

    def moved(self, name: str, arrived_after: datetime | None = None) -> DataFrame: ...


class CommitConflict(RuntimeError):
    """Another writer committed to the table first; the write can be repeated."""


class Lake:
    """Tables of ``schemas.TABLES`` under one base path."""

    def __init__(self, spark: SparkSession, base_path: str):
        self.spark = spark
        self.base_path = base_path.rstrip("/")

    # -- commit files -------------------------------------------------------------------------

    def path(self, name: str) -> str:
        table = TABLES[name]
        return f"{self.base_path}/{table.layer}/{table.name}"

    def _hadoop(self, path: str):
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def _children(self, path: str) -> list:
        fs, folder = self._hadoop(path)
        return list(fs.listStatus(folder)) if fs.exists(folder) else []

    def _commit_numbers(self, name: str) -> list[int]:
        files = [status.getPath().getName() for status in self._children(f"{self.path(name)}/_commits")]
        return sorted((int(f[:-5]) for f in files if f.endswith(".json") and f[:-5].isdigit()), reverse=True)

    def _load_commit(self, name: str, number: int) -> dict | None:
        fs, file = self._hadoop(f"{self.path(name)}/_commits/{number:012d}.json")
        stream = fs.open(file)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:  # cut off by a dying writer: never became a commit
            return None

    def current(self, name: str) -> dict | None:
        """The newest readable commit: ``directories`` in use (with the newest arrival in each, if the
        table records arrivals) and the last ``batches`` of streams."""
        for number in self._commit_numbers(name):
            commit = self._load_commit(name, number)
            if commit is not None:
                return commit
        return None

    def _base(self, name: str) -> list[int]:
        """Commit numbers a write builds on; refuses while another writer's commit file is incomplete."""
        numbers = self._commit_numbers(name)
        if numbers and self._load_commit(name, numbers[0]) is None:
            fs, file = self._hadoop(f"{self.path(name)}/_commits/{numbers[0]:012d}.json")
            age = time.time() - fs.getFileStatus(file).getModificationTime() / 1000
            if age < ABANDONED_SECONDS:
                raise CommitConflict(f"{name}: commit {numbers[0]} is being written")
        return numbers

    def _commit(
        self, name: str, base: list[int], directories: Mapping[str, int | None], batches: dict, moved: Mapping[str, int | None] | None = None
    ) -> None:
        number = (base[0] if base else 0) + 1
        fs, file = self._hadoop(f"{self.path(name)}/_commits/{number:012d}.json")
        earlier = (self.current(name) or {}).get("moved", {})
        text = json.dumps({"directories": directories, "batches": batches, "moved": {**earlier, **(moved or {})}}, sort_keys=True)
        try:
            stream = fs.create(file, False)
        except Exception as error:
            raise CommitConflict(f"{name}: commit {number} exists") from error
        stream.write(bytearray(text.encode()))
        stream.close()

    # -- reading ------------------------------------------------------------------------------

    def exists(self, name: str) -> bool:
        return self.current(name) is not None

    def read(
        self,
        name: str,
        dates: Iterable[object] | None = None,
        from_date: object | None = None,
        arrived_after: datetime | None = None,
    ) -> DataFrame:
        """The committed rows.

        ``dates`` and ``from_date`` limit a dated table to those partitions. ``arrived_after`` leaves
        out directories without a newer row; the remaining rows still need the row filter.
        """
        commit = self.current(name)
        found = commit["directories"] if commit else {}
        if dates is not None:
            wanted = {_part_name(d) for d in dates}
            found = {d: newest for d, newest in found.items() if _part_of(d) in wanted}
        if from_date is not None:
            found = {d: newest for d, newest in found.items() if _part_of(d) in (NULL_PART, "") or _part_of(d) >= str(from_date)}
        if arrived_after is not None:
            bound = micros(arrived_after)
            found = {d: newest for d, newest in found.items() if newest is None or newest > bound}
        return self._open(TABLES[name], sorted(found)).drop(PART)

    def optional(self, name: str) -> DataFrame | None:
        return self.read(name) if self.exists(name) else None

    def _open(self, table: Table, directories: Sequence[str]) -> DataFrame:
        if not directories:
            empty = table.empty(self.spark)
            return empty.withColumn(PART, F.lit(None).cast("date")) if table.dated_by else empty
        schema = f"{table.ddl}, commit string" + (f", {PART} date" if table.dated_by else "")
        root = self.path(table.full_name)
        reader = self.spark.read.schema(schema).option("basePath", root)
        return reader.parquet(*[f"{root}/{d}" for d in directories]).drop("commit")

    # -- writing ------------------------------------------------------------------------------

    def _write(self, table: Table, df: DataFrame, gather: bool = True) -> dict[str, int | None]:
        """Write rows to a new commit directory; return the directories that hold rows."""
        directory = f"commit={uuid.uuid4().hex}"
        target = f"{self.path(table.full_name)}/{directory}"
        if table.dated_by is None:
            df.write.parquet(target)
            return {directory: None}
        dated = df.withColumn(PART, part_date(table))
        if gather:
            # REBALANCE gathers each date into few files and splits a date that is too big for one task.
            dated = dated.hint("rebalance", F.col(PART))
        dated.write.partitionBy(PART).parquet(target)
        names = [status.getPath().getName() for status in self._children(target)]
        written = {f"{directory}/{n}": None for n in names if n.startswith(f"{PART}=")}
        if written and ARRIVAL in table.columns:
            # One row per date just written, from a single column of it.
            newest = self._open(table, list(written)).groupBy(PART).agg(F.max(F.unix_micros(ARRIVAL)))
            for date, arrival in newest.collect():
                written[f"{directory}/{PART}={_part_name(date)}"] = arrival
        return written

    def overwrite(self, name: str, df: DataFrame) -> str:
        table, base = TABLES[name], self._base(name)
        previous = self.current(name) or {}
        self._commit(name, base, self._write(table, table.conform(df)), previous.get("batches", {}))
        return "overwrite"

    def append(self, name: str, df: DataFrame, batch: tuple[str, int] | None = None) -> str:
        """Add rows. ``batch=(stream, id)`` makes a replayed streaming batch a no-op.

        Arrivals share few dates, so they are written where they are, without a shuffle.
        """
        table, base = TABLES[name], self._base(name)
        previous = self.current(name) or {"directories": {}, "batches": {}}
        batches = dict(previous["batches"])
        if batch is not None:
            stream, number = batch
            if batches.get(stream, -1) >= number:
                return "replayed"
            batches[stream] = number
        added = self._write(table, table.conform(df), gather=False)
        self._commit(name, base, {**previous["directories"], **added}, batches)
        return "append"

    def upsert(
        self,
        name: str,
        source: DataFrame,
        newer_than: Sequence[str] = (),
        delete_unmatched: bool = False,
    ) -> str:
        """Merge one row per key into the table; ``created`` on first write, else ``merged``.

        A batch with several rows of one key is refused: which of them should win is not defined. Rows
        whose key is stored under another time are kept aside for ``moved``.
        """
        table, base = TABLES[name], self._base(name)
        previous = self.current(name)
        moved: dict[str, int | None] = {}
        source, staged = self._staged(table, source)
        try:
            per_key = source.groupBy(*[F.col(f"`{k}`") for k in table.keys]).agg(F.count(F.lit(1)).alias("_rows"))
            rows, most = per_key.agg(F.sum("_rows"), F.max("_rows")).first()
            if (most or 0) > 1:
                repeated = repeated_keys(source, table.keys).first()
                raise ValueError(f"{name}: the batch holds a key more than once: {repeated.asDict()}")
            if previous is None or delete_unmatched:  # only the arriving rows remain
                self.overwrite(name, source)
                return "created" if previous is None else "merged"
            small, moves = (rows or 0) <= BROADCAST_ROWS, False
            touched = list(previous["directories"])
            if table.dated_by is not None:
                touched, moves = self._touched(table, source, touched, small)
            target = table.conform(self._open(table, touched))
            written = self._write(table, merge_rows(target, source, table.keys, newer_than, small))
            if moves and ARRIVAL in table.columns:
                moved = self._set_aside(table, target, source)
        finally:
            drop_folder(self.spark, staged)
        self._commit(name, base, {**_without(previous["directories"], touched), **written}, previous["batches"], moved)
        return "merged"

    def _staged(self, table: Table, source: DataFrame) -> tuple[DataFrame, str]:
        """The batch as files beside the table, computed once, and their folder.

        What follows runs in the table's own session: a streaming batch's session plans without AQE, with a fixed number of
        partitions for every step.
        """
        folder = f"{self.path(table.full_name)}/_staged/{uuid.uuid4().hex}"
        table.conform(source).write.parquet(folder)
        return self.spark.read.schema(table.ddl).parquet(folder), folder

    def _set_aside(self, table: Table, target: DataFrame, source: DataFrame) -> dict[str, int | None]:
        """Write the stored rows that the batch moves to another time; they get the batch's arrival."""
        arriving = arriving_keys(source, table.keys, F.col(table.dated_by).alias("_time"), F.col(ARRIVAL).alias("_arrival"))
        gone = target.join(arriving, on_keys(table.keys)).where(~F.col(table.dated_by).eqNullSafe(F.col("_time")))
        gone = table.conform(gone.withColumn(ARRIVAL, F.col("_arrival")))
        directory = f"_moved/{uuid.uuid4().hex}"
        folder = f"{self.path(table.full_name)}/{directory}"
        gone.write.parquet(folder)
        newest = self.spark.read.schema(table.ddl).parquet(folder).agg(F.max(F.unix_micros(ARRIVAL)), F.count(F.lit(1))).first()
        return {directory: newest[0]} if newest[1] else {}

    def moved(self, name: str, arrived_after: datetime | None = None) -> DataFrame:
        """Former versions of rows that a merge moved to another time, with the arrival of the row that moved them.

        What was computed at their old time has to be computed again. A version that a newer stored row had
        kept from moving may be among them.
        """
        table, bound = TABLES[name], micros(arrived_after) if arrived_after is not None else None
        found = (self.current(name) or {}).get("moved", {})
        folders = [f"{self.path(name)}/{d}" for d, newest in found.items() if bound is None or newest is None or newest > bound]
        return self.spark.read.schema(table.ddl).parquet(*folders) if folders else table.empty(self.spark)

    def replace_dates(self, name: str, df: DataFrame, dates: Iterable[object]) -> str:
        """Replace whole date partitions; a date without a row becomes empty."""
        table, base = TABLES[name], self._base(name)
        previous = self.current(name)
        wanted = {_part_name(d) for d in dates}
        kept = {d: n for d, n in (previous or {}).get("directories", {}).items() if _part_of(d) not in wanted}
        written = self._write(table, table.conform(df))
        self._commit(name, base, {**kept, **written}, (previous or {}).get("batches", {}))
        return "created" if previous is None else "merged"

    def compact(self, name: str, more_than: int = 8) -> int:
        """Rewrite dates that lie in more than so many directories as one; return how many.

        Frequent small appends leave one directory each; readers then open too many small files.
        """
        table, base = TABLES[name], self._base(name)
        previous = self.current(name)
        if previous is None:
            return 0
        by_date: dict[str, list[str]] = {}
        for directory in previous["directories"]:
            by_date.setdefault(_part_of(directory), []).append(directory)
        scattered = [group for group in by_date.values() if len(group) > more_than]
        if scattered:
            old = [directory for group in scattered for directory in group]
            written = self._write(table, table.conform(self._open(table, old)))
            self._commit(name, base, {**_without(previous["directories"], old), **written}, previous["batches"])
        return len(scattered)

    def _touched(self, table: Table, source: DataFrame, directories: Sequence[str], small: bool) -> tuple[list[str], bool]:
        """Directories of the date partitions that hold or will hold a key of the batch, and whether the batch moves a row.

        The collected values are dates, at most two per stored partition, never rows.
        """
        arriving = source.select(part_date(table).alias(PART), F.lit(False).alias("_moves"))
        if not table.date_follows_key:
            # A key may be stored under another date: find it by a scan of the key columns and the time only.
            keys = arriving_keys(source, table.keys, F.col(table.dated_by).alias("_time"))
            held = self._open(table, directories).join(broadcast_if(small, keys), on_keys(table.keys))
            arriving = arriving.unionByName(held.select(PART, (~F.col(table.dated_by).eqNullSafe(F.col("_time"))).alias("_moves")))
        found = arriving.groupBy(PART).agg(F.max("_moves")).collect()
        dates = {_part_name(date) for date, _ in found}
        return [d for d in directories if _part_of(d) in dates], any(moves for _, moves in found)

    def expire(self, name: str, keep: int = 2, min_age_hours: float = 24.0) -> int:
        """Delete data directories that none of the last ``keep`` commits uses; return how many.

        Older commit files go too. Directories younger than ``min_age_hours`` stay: a running write may still need them.
        """
        table, root = TABLES[name], self.path(name)
        numbers = self._commit_numbers(name)[:keep]
        used = {d for n in numbers for d in (self._load_commit(name, n) or {}).get("directories", {})}
        latest = (time.time() - min_age_hours * 3600) * 1000
        deleted = 0
        for commit in self._children(root):
            folder = commit.getPath().getName()
            if not numbers or not folder.startswith("commit="):
                continue
            leaves = self._children(f"{root}/{folder}") if table.dated_by else [commit]
            for leaf in leaves:
                relative = f"{folder}/{leaf.getPath().getName()}" if table.dated_by else folder
                is_data = leaf.isDirectory() and relative not in used
                if is_data and leaf.getModificationTime() <= latest:
                    self._hadoop(f"{root}/{relative}")[0].delete(leaf.getPath(), True)
                    deleted += 1
        for number in self._commit_numbers(name)[keep:]:
            fs, file = self._hadoop(f"{root}/_commits/{number:012d}.json")
            fs.delete(file, False)
        return deleted


def part_date(table: Table) -> Column:
    return utc_date(table.dated_by)


def _part_name(date) -> str:
    return NULL_PART if date is None else str(date)


def _part_of(directory: str) -> str:
    return directory.partition(f"/{PART}=")[2]


def _without(directories: Mapping[str, int | None], gone: Iterable[str]) -> dict[str, int | None]:
    dropped = set(gone)
    return {d: newest for d, newest in directories.items() if d not in dropped}

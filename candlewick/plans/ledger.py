"""Which stored files a pipeline has consumed, so that arrivals are found however old they look.

A watermark on the arrival time loses a row that lands with an arrival older than the overlap. The ledger instead has
one row per consumed file: what a table's present files lack there (an anti-join) is unread, and files of the ledger that
are gone were rewritten or emptied, so what was computed at their dates is computed again. Its size goes with the number of
files, and rows of consumed files are never opened.

Data is written before the ledger: a crash between the two repeats a batch, which the keyed merges absorb. A file that
compaction or a merge has rewritten counts as unread, too.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.functions.time import utc, utc_date
from candlewick.plans.state import WATERMARK, from_micros
from candlewick.schemas import TABLES
from candlewick.sinks.lake import Store

LEDGER = "audit.consumed_files"


@dataclass(frozen=True)
class File:
    """What the ledger keeps of a file; as many of these come to the driver as files changed, which it lists anyway."""

    file: str
    row_count: int
    first_date: date | None
    last_date: date | None
    newest_arrival: datetime | None


@dataclass(frozen=True)
class Arrivals:
    """The unread part of a table: its ``rows`` and ``files``, and the ledger's files that are ``gone``."""

    table: str
    rows: DataFrame
    files: list[File]
    gone: list[File]

    @property
    def row_count(self) -> int:
        return sum(f.row_count for f in self.files)

    @property
    def newest(self) -> datetime | None:
        return max((f.newest_arrival for f in self.files if f.newest_arrival), default=None)

    @property
    def changed(self) -> bool:
        return bool(self.files or self.gone)

    def dates(self) -> list[date]:
        """Dates that hold unread rows or held rows of files that are gone."""
        spans = {(f.first_date, f.last_date) for f in (*self.files, *self.gone) if f.first_date}
        return sorted({first + timedelta(days=n) for first, last in spans for n in range((last - first).days + 1)})


def holds_files(lake: Store) -> bool:
    """Whether the store's tables are parquet files as they lie; row-level formats keep deletions beside them."""
    return getattr(lake, "file_format", "parquet") == "parquet"


def arrivals(lake: Store, table: str, pipeline: str) -> Arrivals:
    """What ``pipeline`` has not consumed of ``table``. Rows of one batch are found together, whatever their times."""
    spark = lake.spark
    present = spark.createDataFrame(
        [(_relative(table, f), f) for f in (lake.read(table).inputFiles() if lake.exists(table) else [])], "file string, location string"
    )
    known = consumed(lake, pipeline, table).withColumn("held", F.lit(True))
    differs = present.join(known, "file", "full_outer").where("location IS NULL OR held IS NULL").collect()
    gone = [File(r.file, r.row_count, r.first_date, r.last_date, None) for r in differs if r.location is None]
    locations = [r.location for r in differs if r.location is not None]
    if not locations:
        return Arrivals(table, TABLES[table].empty(spark), [], gone)
    rows = spark.read.schema(TABLES[table].ddl).parquet(*locations)
    return Arrivals(table, rows, _measured(table, rows, locations), gone)


def consumed(lake: Store, pipeline: str, table: str) -> DataFrame:
    return lake.read(LEDGER).where((F.col("pipeline_name") == pipeline) & (F.col("dataset_name") == _short(table)))


def consume(lake: Store, pipeline: str, batches: Sequence[Arrivals], at: datetime | None = None) -> None:
    """Enter the batches' files and strike out those that are gone."""
    moment, spark = utc(at) or datetime.now(timezone.utc), lake.spark
    entries = [
        (pipeline, _short(b.table), f.file, f.row_count, f.first_date, f.last_date, f.newest_arrival, moment) for b in batches for f in b.files
    ]
    struck = [(pipeline, _short(b.table), f.file) for b in batches for f in b.gone]
    rows = spark.createDataFrame(entries, TABLES[LEDGER].ddl).coalesce(1)
    if struck:
        gone = spark.createDataFrame(struck, "pipeline_name string, dataset_name string, file string")
        kept = lake.read(LEDGER).join(gone, ["pipeline_name", "dataset_name", "file"], "left_anti")
        lake.overwrite(LEDGER, kept.unionByName(rows))
    elif entries:
        lake.append(LEDGER, rows)


def _measured(table: str, rows: DataFrame, locations: Sequence[str]) -> list[File]:
    """One aggregate over two columns; files without rows are entered, too."""
    definition = TABLES[table]
    day = utc_date(definition.dated_by) if definition.dated_by else F.lit(None).cast("date")
    moment = F.col(WATERMARK) if WATERMARK in definition.columns else F.lit(None).cast("timestamp")
    # The part of the path after the table's folder needs no escapes, so both ways of writing a path give the same.
    file = F.substring_index(F.col("_metadata.file_path"), f"/{definition.name}/", -1).alias("file")
    seen = rows.select(file, day.alias("day"), F.unix_micros(moment).alias("moment")).groupBy("file").agg(
        F.count(F.lit(1)).alias("n"), F.min("day").alias("first"), F.max("day").alias("last"), F.max("moment").alias("newest")
    )
    found = {r.file: File(r.file, r.n, r.first, r.last, from_micros(r.newest)) for r in seen.collect()}
    return [found.get(name, File(name, 0, None, None, None)) for name in (_relative(table, f) for f in locations)]


def _relative(table: str, location: str) -> str:
    return location.rpartition(f"/{TABLES[table].name}/")[2]


def _short(table: str) -> str:
    return table.partition(".")[2]

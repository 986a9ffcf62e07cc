"""Stored tables as catalog tables ``layer.name``, readable by plain SQL."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.time import utc_date
from candlewick.operators.merging import merge_into_table, merge_rows, repeated_keys
from candlewick.schemas import TABLES, dotted, table_ddl
from candlewick.sinks.workspace import drop_folder, new_folder

# Formats whose catalog tables take row-level changes.
ROW_LEVEL_FORMATS = ("delta", "iceberg", "hudi")


class CatalogTables:
    """The same operations as ``Lake``, for tables registered in a catalog.

    With a row-level format a merge is the format's own MERGE. Plain parquet tables are rewritten
    whole, from a staged copy in the shared folder; use ``Lake`` or a row-level format for large ones.
    """

    def __init__(self, spark: SparkSession, catalog: str | None = None, file_format: str = "parquet"):
        self.spark = spark
        self.catalog = catalog
        self.file_format = file_format

    def path(self, name: str) -> str:
        table = TABLES[name]
        return dotted(self.catalog, table.layer, table.name)

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.path(name))

    def read(
        self,
        name: str,
        dates: Iterable[object] | None = None,
        from_date: object | None = None,
        arrived_after: datetime | None = None,
    ) -> DataFrame:
        """The table's rows; the bounds become filters that the scan can use."""
        table = TABLES[name]
        if not self.exists(name):
            return table.empty(self.spark)
        rows = self.spark.table(self.path(name))
        if dates is not None and table.dated_by:
            dates, day = list(dates), utc_date(table.dated_by)
            known = day.isin([d for d in dates if d is not None])
            rows = rows.where(known | day.isNull() if None in dates else known)
        if from_date is not None and table.dated_by:
            rows = rows.where(F.col(table.dated_by) >= F.lit(from_date).cast("timestamp"))
        if arrived_after is not None and "ingested_at" in table.columns:
            rows = rows.where(F.col("ingested_at") > F.lit(arrived_after))
        return rows

    def optional(self, name: str) -> DataFrame | None:
        return self.read(name) if self.exists(name) else None

    def _create(self, name: str) -> None:
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {dotted(self.catalog, TABLES[name].layer)}")
        self.spark.sql(table_ddl(TABLES[name], self.catalog, self.file_format))

    def append(self, name: str, df: DataFrame, batch: tuple[str, int] | None = None) -> str:
        """Add rows. ``batch=(stream, id)`` makes a replayed streaming batch a no-op.

        The last batch of a stream is a table property, set after the rows: a crash in between repeats one batch.
        """
        self._create(name)
        mark = f"candlewick.batch.{batch[0]}" if batch else ""
        if batch and self._property(name, mark) >= batch[1]:
            return "replayed"
        TABLES[name].conform(df).write.insertInto(self.path(name))
        if batch:
            self.spark.sql(f"ALTER TABLE {self.path(name)} SET TBLPROPERTIES ('{mark}' = '{batch[1]}')")
        return "append"

    def _property(self, name: str, key: str) -> int:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.path(name)}").where(F.col("key") == key).collect()
        return int(rows[0].value) if rows else -1

    def overwrite(self, name: str, df: DataFrame) -> str:
        self._create(name)
        # Staged first: the new rows may be derived from the table they replace.
        staged = new_folder(self.spark, "staged")
        TABLES[name].conform(df).write.parquet(staged)
        rows = self.spark.read.schema(TABLES[name].ddl).parquet(staged)
        rows.write.insertInto(self.path(name), overwrite=True)
        drop_folder(self.spark, staged)
        return "overwrite"

    def upsert(
        self, name: str, source: DataFrame, newer_than: Sequence[str] = (), delete_unmatched: bool = False
    ) -> str:
        """Merge one row per key into the table; ``created`` on first write, else ``merged``."""
        table, created = TABLES[name], not self.exists(name)
        source = table.conform(source)
        repeated = repeated_keys(source, table.keys).first()
        if repeated is not None:
            raise ValueError(f"{name}: the batch holds a key more than once: {repeated.asDict()}")
        if created:
            self.append(name, source)
            return "created"
        if self.file_format in ROW_LEVEL_FORMATS:
            merge_into_table(source, self.path(name), table.keys, delete_unmatched, newer_than)
        elif delete_unmatched:
            self.overwrite(name, source)
        else:
            self.overwrite(name, merge_rows(self.read(name), source, table.keys, newer_than))
        return "merged"

    def replace_dates(self, name: str, df: DataFrame, dates: Iterable[object]) -> str:
        """Replace the rows of whole dates."""
        table, created, dates = TABLES[name], not self.exists(name), list(dates)
        self._create(name)
        day = utc_date(table.dated_by)
        if self.file_format in ROW_LEVEL_FORMATS:
            table.conform(df).writeTo(self.path(name)).overwrite(day.isin(list(dates)))
        else:
            gone = F.coalesce(day.isin([d for d in dates if d is not None]), F.lit(None in dates))
            kept = self.read(name).where(~gone)
            self.overwrite(name, kept.unionByName(table.conform(df)))
        return "created" if created else "merged"

    def moved(self, name: str, arrived_after: datetime | None = None) -> DataFrame:
        """Catalog tables keep no former versions here: a trade that moves leaves its old minute until a full build."""
        return TABLES[name].empty(self.spark)

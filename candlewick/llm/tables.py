"""Small helpers that the operators of this folder share."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.sinks.workspace import new_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a written table in the shared folder: computed once, and kept when executors are lost."""
    folder = new_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def whole(text: str = "text") -> Column:
    """The text column, null as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def sliced(batch: pa.RecordBatch | pa.Array, rows: int = 256) -> Iterator[pa.RecordBatch | pa.Array]:
    """A batch in short pieces, so that only few texts are Python objects at a time.

    At its end Arrow gives back what former batches have left unused: a worker lives on and would keep it through the
    steps that follow.
    """
    for at in range(0, len(batch), rows):
        yield batch.slice(at, rows)
    pa.default_memory_pool().release_unused()


def total_bytes(docs: DataFrame, text: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once for a context. Workers of a local session that starts where the
    package lies have it already; those of a cluster may be on other machines, wherever the driver starts."""
    root = Path(__file__).resolve().parents[2]
    found = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    local = spark.sparkContext.master.partition("[")[0] == "local"
    if spark.conf.get("spark.candlewick.shipped", None) or local and any(p and Path(p).resolve() == root for p in found):
        return
    with tempfile.TemporaryDirectory() as folder:  # the context copies the archive to its own file server
        archive = shutil.make_archive(f"{folder}/candlewick", "zip", root, "candlewick")
        spark.sparkContext.addPyFile(archive)
        spark.conf.set("spark.candlewick.shipped", "true")
        spark.range(1).mapInArrow(lambda batches: batches, "id long").collect()  # fetched before the folder goes

"""Persisted high watermarks per pipeline and source dataset."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.time import utc
from candlewick.schemas import TABLES
from candlewick.sinks.lake import Store

STATE = "audit.processing_state"
# Default processing column and overlap (fixed values).
WATERMARK = "ingested_at"
OVERLAP_SECONDS = 120


@dataclass(frozen=True)
class State:
    pipeline: str
    dataset: str
    source_layer: str
    target_layer: str
    last_processed_at: datetime | None
    metadata: dict = field(default_factory=dict)
    watermark_column: str = WATERMARK

    @property
    def key(self) -> str:
        return state_key(self.pipeline, self.dataset)


def state_key(pipeline: str, dataset: str) -> str:
    return f"{pipeline}:{dataset}"


def state_rows(spark: SparkSession, states: Sequence[State], updated_at: datetime | None = None) -> DataFrame:
    """A handful of control rows, one per source dataset of a pipeline."""
    moment = utc(updated_at) or datetime.now(timezone.utc)
    rows = [
        (
            s.key, s.pipeline, s.dataset, s.source_layer, s.target_layer, s.watermark_column,
            utc(s.last_processed_at), moment, json.dumps(s.metadata, sort_keys=True, default=str),
        )
        for s in states
    ]
    return spark.createDataFrame(rows, TABLES[STATE].ddl)


def load_state(lake: Store, pipeline: str | None = None) -> DataFrame:
    """Stored states, all or of one pipeline; no rows when nothing was stored yet."""
    stored = lake.read(STATE)
    return stored if pipeline is None else stored.where(F.col("pipeline_name") == pipeline)


def last_watermarks(lake: Store, pipeline: str) -> dict[str, datetime | None]:
    """Dataset -> watermark: one row per source of the pipeline, read to bound the next scan."""
    rows = load_state(lake, pipeline).select("dataset_name", F.unix_micros("last_processed_at")).collect()
    return {name: from_micros(micros) for name, micros in rows}


def save_state(lake: Store, states: Sequence[State], updated_at: datetime | None = None) -> str:
    if not states:
        return "skipped"
    return lake.upsert(STATE, state_rows(lake.spark, states, updated_at))


def batch_extent(df: DataFrame, column: str = WATERMARK) -> tuple[int, datetime | None]:
    """Rows and newest watermark of a batch in one aggregate over a single column."""
    rows, micros = df.agg(F.count(F.lit(1)), F.max(F.unix_micros(F.col(column).cast("timestamp")))).first()
    return rows, from_micros(micros)


def from_micros(micros: int | None) -> datetime | None:
    if micros is None:
        return None
    seconds, rest = divmod(micros, 1_000_000)
    return datetime.fromtimestamp(seconds, timezone.utc).replace(microsecond=rest)

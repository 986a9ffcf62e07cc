"""Freshness from daily parts: counts, newest times and mergeable sketches of distinct symbols.

A part is a row for each date. Parts of disjoint rows merge without reading the rows again, so the overview of a table
of many dates reads only what arrived. The number of symbols is exact in ``reports.freshness_overview``; here it is an
estimate of a HyperLogLog sketch: up to ``EXACT_UP_TO`` distinct values it is right, beyond it its standard error is
about 1.04 / sqrt(2 ** precision), 0.8 % by default.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions.time import age_minutes, as_of_column

#: Logarithm of a sketch's registers (16,384 registers, some 16 KB at most), and distinct values that it lists.
PRECISION, EXACT_UP_TO = 14, 1000


def daily_parts(rows: DataFrame, moment: str, column: str = "symbol", precision: int = PRECISION) -> DataFrame:
    """One row per UTC date of ``moment``: ``part_date``, ``row_count``, ``newest``, ``sketch`` of ``column``.

    Rows without a moment are a part with a null date. A null value is not counted as distinct; a part without any
    value has an empty sketch. An empty table has no part. Sketches are made in every task before the shuffle.
    """
    date = F.to_date(F.to_utc_timestamp(F.col(moment).cast("timestamp"), F.current_timezone()))
    return rows.groupBy(date.alias("part_date")).agg(
        F.count(F.lit(1)).alias("row_count"), F.max(moment).alias("newest"), F.hll_sketch_agg(column, precision).alias("sketch")
    )


def merge_parts(stored: DataFrame, arriving: DataFrame) -> DataFrame:
    """Parts of both, one row per date. The rows behind them must be disjoint, or ``row_count`` counts some twice."""
    return stored.unionByName(arriving).groupBy("part_date").agg(
        F.sum("row_count").alias("row_count"), F.max("newest").alias("newest"), F.hll_union_agg("sketch").alias("sketch")
    )


def freshness_of_parts(parts: DataFrame, dataset: str, moment: str, as_of: datetime | Column | None = None) -> DataFrame:
    """The row of ``reports.freshness_overview`` for one dataset, from its parts alone."""
    totals = parts.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).cast("int").alias("distinct_symbol_count"),
        F.max("newest").alias("latest_timestamp"),
    )
    return totals.select(
        F.lit(dataset).alias("dataset_name"), F.lit(dataset.partition("_")[0]).alias("layer"), "*", F.lit(moment).alias("timestamp_column"),
        age_minutes(as_of_column(as_of), F.col("latest_timestamp")).alias("age_minutes"),
    )

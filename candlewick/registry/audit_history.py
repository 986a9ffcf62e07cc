"""A quality audit trail over the driver tables: one run per day, each over that day's rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick import feeds
from candlewick.operators.quality import audit_rows, judge, measure
from candlewick.operators.quality_rules import RULE_OF

DAY = "run_day"
# Dataset -> its rows and the timestamp that says which day's run checks them.
SLICED = {
    "bronze_trades_live_raw": (feeds.bronze_trades, "event_time"),
    "silver_trades": (feeds.trades, "trade_time"),
    "silver_klines_1m": (feeds.candles, "open_time"),
    "gold_volume_1m": (feeds.gold_volume, "window_start"),
}


def day_end():
    return (F.col(DAY) + F.expr("INTERVAL 1 DAY")).cast("timestamp")


def audit_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = [
        measure(source(spark, sf_dir).withColumn(DAY, F.to_date(moment)), RULE_OF[dataset], [DAY])
        for dataset, (source, moment) in SLICED.items()
    ]
    runs = judge(reduce(DataFrame.union, measured), day_end(), [DAY])
    run_id = F.concat(F.lit("run-"), F.date_format(DAY, "yyyyMMdd"))
    return audit_rows(runs, run_id, day_end(), "test", "data_quality_checks", "quality")

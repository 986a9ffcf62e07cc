from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.fixtures import ARRIVED, CLOSES, at, candles, raw, trade_lines

from candlewick.operators import gold, payloads
from candlewick.plans import gold_build, quality_run, silver_build
from candlewick.schemas import TABLES
from candlewick.sinks.catalog import CatalogTables
from candlewick.operators.filters import cast_to_schema


@pytest.fixture
def tables(spark):
    store = CatalogTables(spark)
    for layer in ("bronze", "silver", "gold", "audit"):
        spark.sql(f"DROP SCHEMA IF EXISTS {layer} CASCADE")
    yield store
    for layer in ("bronze", "silver", "gold", "audit"):
        spark.sql(f"DROP SCHEMA IF EXISTS {layer} CASCADE")


def test_pipeline_over_catalog_tables_answers_sql(spark, tables):
    assert tables.optional("gold.latest_price") is None
    klines = candles(spark, CLOSES)
    early, late = F.col("open_time") < F.lit(at(240)), F.col("open_time") >= F.lit(at(240))
    tables.append("bronze.trades_live_raw", payloads.parse_trades(raw(spark, trade_lines()), ingested_at=ARRIVED))
    for part in (early, late):
        tables.append("bronze.klines_history_raw", klines.where(part))
        silver_build.build_silver(tables, updated_at=at(0))
        gold_build.build_gold(tables, updated_at=at(0))
    prices = spark.sql("SELECT symbol, latest_price FROM gold.latest_price ORDER BY trade_time DESC").collect()
    assert [tuple(r) for r in prices] == [("ETHUSDT", 3535.0), ("BTCUSDT", 65050.0)]
    assert spark.sql("SELECT symbol FROM gold.top_movers ORDER BY abs(move_pct) DESC").first().symbol == "ETHUSDT"
    found = {tuple(r) for r in spark.table("gold.volatility_5m").collect()}
    assert found == {tuple(r) for r in gold.rolling_volatility(klines).collect()}
    duplicates = "SELECT symbol, trade_id FROM silver.trades GROUP BY symbol, trade_id HAVING count(*) > 1"
    assert spark.sql(duplicates).count() == 0
    run = quality_run.run_quality(tables, "r", checked_at=at(0), fail_on_violation=False)
    assert run.count() == 9
    assert run.where("dataset_name = 'gold_top_movers'").first().passed
    assert spark.sql("SELECT count(*) AS n FROM audit.processing_state").first().n == 4


def test_guarded_and_replacing_upserts(spark, tables):
    ddl = "symbol string, trade_id bigint, price double, event_time timestamp, ingested_at timestamp"
    row = lambda price, second: spark.createDataFrame([("A", 1, price, at(second), at(second))], ddl)
    assert tables.upsert("silver.trades", row(1.0, 10)) == "created"
    assert tables.upsert("silver.trades", row(2.0, 5), newer_than=("event_time", "ingested_at")) == "merged"
    assert tables.read("silver.trades").first().price == 1.0
    tables.upsert("silver.trades", row(3.0, 5))
    assert tables.read("silver.trades").first().price == 3.0
    other = row(4.0, 1).withColumn("symbol", F.lit("B"))
    tables.upsert("silver.trades", other, delete_unmatched=True)
    assert [r.symbol for r in tables.read("silver.trades").collect()] == ["B"]
    assert tables.read("silver.trades", arrived_after=at(1)).count() == 0


def test_text_rows_are_cast_by_table(spark):
    text = spark.createDataFrame([("A", "2024-01-01 00:00:00", "1.5", "x", "3")],
                                 "symbol string, window_start string, volume_1m string, notional_1m string, trade_count string")
    row = cast_to_schema(text, TABLES["gold.volume_1m"].casts).first()
    assert (row.volume_1m, row.notional_1m, row.trade_count) == (1.5, None, 3)
    assert row.window_start.year == 2024


def test_no_rules_write_nothing(spark, tables):
    assert quality_run.run_quality(tables, "r", rules=()).count() == 0
    assert not tables.exists("audit.quality_check_runs")


def test_a_replayed_batch_lands_once(spark, tables):
    rows = spark.createDataFrame([("A", at(0), 1.0, 1.0, 1)], TABLES["gold.volume_1m"].ddl)
    done = [tables.append("gold.volume_1m", rows, ("live", number)) for number in (0, 0, 1, 1, 0)]
    assert done == ["append", "replayed", "append", "replayed", "replayed"]
    assert tables.read("gold.volume_1m").count() == 2

from __future__ import annotations

import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.fixtures import ARRIVED, CLOSES, at, candles, live_messages, history_groups, raw

from candlewick.operators import distinct, payloads, quality, reports
from candlewick.operators.quality_rules import RULES, Rule
from candlewick.plans import observability, quality_run, serving
from candlewick.schemas import SERVING_DATASETS, TABLES
from candlewick.sinks.lake import Lake

RULE = Rule(
    "silver.trades", ("symbol", "price", "trade_time"), {"price": 0.0}, ("symbol", "trade_id"),
    freshness=("seen", 900), minimum={"price": 0.0}, maximum={"price": 100.0}, min_rows=11,
)


def verdict(df, rule=RULE, as_of=None):
    (row,) = quality.check_dataset(df, rule, as_of).collect()
    return row


def faulty(spark):
    rows = [("A", 1, "-1.0"), ("A", 1, "9.0"), ("A", 1, "10.0"), ("B", 2, None)] + [("C", i, "5") for i in range(6)]
    df = spark.createDataFrame(rows, "symbol string, trade_id bigint, price string")
    return df.withColumn("seen", F.lit(at(0)))


def test_all_faults_are_named_in_order(spark):
    row = verdict(faulty(spark), as_of=at(1200))
    assert row.violations == [
        "[silver_trades] row_count 10 is below minimum 11",
        "[silver_trades] missing required columns: trade_time",
        "[silver_trades] null ratio for price 0.100000 exceeds max 0.000000",
        "[silver_trades] duplicate_count 2 exceeds max 0 for keys [symbol, trade_id]",
        "[silver_trades] freshness age 1200.00s exceeds max 900s for column seen",
        "[silver_trades] observed minimum for price -1.00000000 is below allowed 0.00000000",
    ]
    flags = (row.passed, row.schema_passed, row.null_checks_passed, row.duplicate_check_passed,
             row.freshness_check_passed, row.bounds_check_passed)
    assert not any(flags)
    summary = json.loads(row.summary_json)
    assert list(summary) == sorted(summary)
    assert summary["bounds_check"]["metrics"]["price"]["observed_max"] == 10.0
    assert summary["duplicate_check"]["duplicate_count"] == 2
    assert summary["schema"]["missing_columns"] == ["trade_time"]


def test_clean_dataset_passes(spark):
    df = faulty(spark).where("symbol = 'C'").withColumn("trade_time", F.col("seen"))
    rule = Rule("silver.trades", RULE.required, RULE.null_ratios, RULE.keys, freshness=RULE.freshness, minimum=RULE.minimum)
    row = verdict(df, rule, at(900))
    assert row.passed and row.violations == []
    assert row.row_count == 6


def test_empty_dataset(spark):
    row = verdict(faulty(spark).limit(0).withColumn("trade_time", F.col("seen")), as_of=at(0))
    assert row.violations == [
        "[silver_trades] row_count 0 is below minimum 11",
        "[silver_trades] freshness check failed: no timestamp values available",
        "[silver_trades] bounds check for price has no comparable values",
    ]
    assert row.null_checks_passed and row.duplicate_check_passed


def test_missing_columns_fail_their_checks(spark):
    row = verdict(faulty(spark).drop("price", "seen", "trade_id"), as_of=at(0))
    assert row.violations[1:] == [
        "[silver_trades] missing required columns: price, trade_time",
        "[silver_trades] null check for price failed: column is missing",
        "[silver_trades] duplicate check failed: missing key columns: trade_id",
        "[silver_trades] freshness check failed: column is missing",
        "[silver_trades] bounds check for price failed: column is missing",
    ]
    assert not row.freshness_check_passed


def test_maximum_and_future_timestamps(spark):
    df = faulty(spark).withColumn("price", F.lit("250")).withColumn("trade_time", F.col("seen"))
    row = verdict(df, as_of=at(-50))
    assert "[silver_trades] observed maximum for price 250.00000000 exceeds allowed 100.00000000" in row.violations
    assert row.freshness_check_passed


def test_open_candle_updates_are_no_duplicates(spark):
    rule = next(r for r in RULES if r.dataset == "bronze_klines_live_raw")
    parsed = payloads.parse_market(raw(spark, [json.dumps(m) for m in live_messages()]))
    assert verdict(payloads.klines_of(parsed), rule, at(120)).duplicate_check_passed
    assert len(RULES) == 9


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def filled(spark, lake):
    """History and live fixtures as a lake with all layers built."""
    from candlewick.plans import gold_build, silver_build

    parsed = payloads.parse_market(raw(spark, [json.dumps(m) for m in live_messages()]), ingested_at=at(200))
    lake.append("bronze.trades_live_raw", payloads.trades_of(parsed))
    lake.append("bronze.klines_live_raw", payloads.klines_of(parsed))
    lake.append("bronze.klines_history_raw", TABLES["bronze.klines_history_raw"].conform(candles(spark, CLOSES)))
    silver_build.build_silver(lake, updated_at=at(300))
    gold_build.build_gold(lake, updated_at=at(300))
    return lake


def test_run_appends_audit_and_gates(spark, lake):
    filled(spark, lake)
    assert lake.read("silver.klines_1m").count() == 11
    fresh = quality_run.run_quality(lake, "run-1", checked_at=at(300))
    assert fresh.where("passed").count() == 9
    with pytest.raises(quality_run.QualityError, match="freshness age"):
        quality_run.run_quality(lake, "run-2", checked_at=at(5000), job_name="nightly")
    audit = lake.read("audit.quality_check_runs")
    assert audit.count() == 18

    runs = reports.quality_recent_runs(audit).collect()
    assert [(r.audit_run_id, r.dataset_count, r.failed_dataset_count, r.job_name) for r in runs] == [
        ("run-2", 9, 5, "nightly"), ("run-1", 9, 0, None)]
    assert "environment" not in reports.quality_recent_runs(audit, with_environment=False).columns
    status = reports.quality_latest_status(audit).collect()
    assert len(status) == 9 and [r.passed for r in status] == [False] * 5 + [True] * 4
    failures = reports.quality_latest_failures(audit).collect()
    assert len(failures) == 5
    assert json.loads(failures[0].violations_json)
    health = {r.dataset_name: r for r in reports.quality_dataset_health(audit).collect()}
    assert (health["silver_trades"].pass_rate, health["silver_klines_1m"].pass_rate) == (0.5, 1.0)
    assert reports.quality_failed_datasets(audit).count() == 5
    counts = {r.status: r.dataset_count for r in reports.quality_status_counts(reports.quality_latest_status(audit)).collect()}
    assert counts == {"passed": 4, "failed": 5}
    audit_report = observability.quality_audit_report(audit)
    assert audit_report["recent_runs"].count() == 2


def test_unreadable_dataset_is_a_violation(spark, lake):
    rows = quality_run.run_quality(lake, "empty", checked_at=at(0), fail_on_violation=False).collect()
    assert len(rows) == 9 and not any(r.passed for r in rows)
    first = json.loads(rows[0].violations_json)
    assert first[0].endswith("unable to read dataset: dataset not found")
    assert first[1].endswith("row_count 0 is below minimum 1")


def test_error_texts_may_hold_quotes(spark):
    measured = quality.unreadable_dataset(spark, RULE, "it's \\ \"bad\"")
    audit = quality.audit_rows(quality.judge(measured, at(0)), "r", at(0)).first()
    assert json.loads(audit.violations_json)[0] == "[silver_trades] unable to read dataset: it's \\ \"bad\""
    assert audit.table_name == "trades"


def test_observability_and_dashboard(spark, lake):
    filled(spark, lake)
    quality_run.run_quality(lake, "run-1", checked_at=at(300))
    datasets = observability.optional_datasets(lake)
    report = observability.observability_report(datasets, at(900))
    assert set(report) == {"freshness", "latest_prices", "volume", "volatility", "top_movers", "quality_runs", "quality_status", "processing_state"}
    fresh = {r.dataset_name: r for r in report["freshness"].collect()}
    assert fresh["gold_latest_price"].distinct_symbol_count == 2
    assert fresh["audit_processing_state"].distinct_symbol_count is None
    assert fresh["audit_quality_check_runs"].age_minutes == 10.0
    board = observability.dashboard(datasets, ["btcusdt "], hours=6, limit=1, as_of=at(300 + 21 * 60))
    kpis = board["kpis"].first()
    assert (kpis.available_dataset_count, kpis.latest_price_symbol_count, kpis.failed_quality_dataset_count) == (6, 1, 0)
    assert kpis.stale_watermark_count == 5
    assert kpis.freshest_dataset == "gold_volatility_5m"
    assert {r.symbol for r in board["volume_trend"].collect()} == {"BTCUSDT"}
    assert board["latest_volatility"].count() == board["top_movers"].count() == 1
    assert "environment" not in board["quality_runs"].columns


def test_reports_do_without_missing_datasets(spark, lake):
    assert observability.observability_report(observability.optional_datasets(lake)) == {}
    lake.overwrite("gold.latest_price", TABLES["gold.latest_price"].empty(spark))
    board = observability.dashboard(observability.optional_datasets(lake), as_of=at(0))
    assert set(board) == {"kpis", "freshness", "latest_prices"}
    kpis = board["kpis"].first()
    assert (kpis.available_dataset_count, kpis.latest_price_symbol_count, kpis.stale_watermark_count) == (1, 0, 0)


def test_publishing(spark, lake, tmp_path):
    serving_lake = Lake(spark, str(tmp_path / "serving"))
    with pytest.raises(RuntimeError):
        serving.publish_serving(lake, serving_lake)
    filled(spark, lake)
    late = at(0) + timedelta(hours=24, seconds=60)
    summary = {r.dataset_name: r for r in serving.publish_serving(lake, serving_lake, as_of=late).collect()}
    assert list(summary) == list(SERVING_DATASETS)
    assert summary["audit_quality_check_runs"].operation == "skipped_missing_source"
    assert (summary["gold_volume_1m"].selection, summary["gold_volume_1m"].row_count) == ("recent_24h", 1)
    assert (summary["gold_volatility_5m"].selection, summary["gold_volatility_5m"].row_count) == ("latest_per_symbol", 2)
    assert summary["audit_processing_state"].row_count == 5
    assert serving_lake.read("audit.processing_state").where("state_key IS NULL").isEmpty()
    assert serving_lake.read("gold.latest_price").count() == 2


def test_a_damaged_file_fails_its_own_dataset_only(spark, lake, tmp_path):
    filled(spark, lake)
    files = [p for p in (tmp_path / "lake").rglob("gold/latest_price/**/*.parquet")] or [p for p in tmp_path.rglob("latest_price/**/*.parquet")]
    for file in files:
        file.write_bytes(b"PAR1 no parquet at all PAR1")
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    audit = quality_run.run_quality(lake, "damaged", checked_at=at(300), fail_on_violation=False)
    found = {r.dataset_name: r for r in audit.collect()}
    assert len(found) == 9 and not found["gold_latest_price"].passed
    assert json.loads(found["gold_latest_price"].violations_json)
    assert found["silver_trades"].passed


def direct(spark, tmp_path, messages):
    (tmp_path / "h.json").write_text(json.dumps(history_groups()))
    history = serving.load_history(spark, "fixture", str(tmp_path / "h.json"), layout="document")
    parsed = payloads.parse_market(raw(spark, [json.dumps(m) for m in messages]), ingested_at=at(200))
    return serving.direct_snapshot(history, payloads.trades_of(parsed), payloads.klines_of(parsed), ARRIVED, "test")


def test_direct_snapshot(spark, tmp_path):
    snapshot = direct(spark, tmp_path, live_messages())
    assert list(snapshot) == list(SERVING_DATASETS)
    assert all(not df.isEmpty() for df in snapshot.values())
    assert snapshot["gold_volatility_5m"].where("symbol = 'BTCUSDT'").count() == 2
    audit = snapshot["audit_quality_check_runs"].collect()
    assert {r.audit_run_id for r in audit} == {"warehouse_direct_20260324T143000"}
    assert all(r.passed and r.violations_json == "[]" for r in audit) and len(audit) == 4
    states = {r.dataset_name: r for r in snapshot["audit_processing_state"].collect()}
    assert states["silver_trades"].last_processed_at == at(200).replace(tzinfo=None)
    summary = serving.publish_serving(Lake(spark, str(tmp_path / "none")), Lake(spark, str(tmp_path / "out")), fallback=snapshot)
    assert {r.selection for r in summary.collect()} == {"direct_source_snapshot"}


def test_direct_snapshot_without_trades(spark, tmp_path):
    snapshot = direct(spark, tmp_path, [m for m in live_messages() if m["data"]["e"] == "kline"])
    audit = {r.dataset_name: r for r in snapshot["audit_quality_check_runs"].collect()}
    assert audit["gold_latest_price"].violations_json == '["dataset produced zero rows"]'
    assert not audit["gold_latest_price"].bounds_check_passed
    states = {r.dataset_name: r for r in snapshot["audit_processing_state"].collect()}
    assert states["silver_trades"].last_processed_at is None


def test_history_modes(spark):
    with pytest.raises(ValueError):
        serving.load_history(spark, "telepathy", "x")
    with pytest.raises(ValueError):
        serving.load_history(spark, "fixture", None)


def trade_rows(spark, *rows):
    """Bronze trades: symbol, id, price, event second, arrival day and second."""
    ddl = "symbol string, trade_id bigint, price string, quantity string, trade_time timestamp, event_time timestamp, ingested_at timestamp"
    made = [(s, i, p, "1", at(e), at(e), None if day is None else at(day * 86_400 + e)) for s, i, p, e, day in rows]
    return TABLES["bronze.trades_live_raw"].conform(spark.createDataFrame(made, ddl))


SHOWN = (
    "dataset_name", "passed", "row_count", "violation_count", "violations_json", "schema_passed", "null_checks_passed", "duplicate_check_passed",
    "freshness_check_passed", "bounds_check_passed", "summary_json",
)


def test_incremental_runs_equal_full_runs(spark, lake):
    """Repeats within and across dates, nulls in keys and dates, late arrivals, moved trades, compaction, unreadable numbers."""
    bronze, silver_ddl = "bronze.trades_live_raw", TABLES["silver.trades"].ddl
    batches = [
        [("A", 1, "5", 10, 0), ("A", 1, "6", 10, 0), ("A", 2, "-1", 20, 0), (None, 3, "x", 30, 0)],
        [("A", 1, "7", 10, 1), ("B", 1, "8", 40, 1), (None, 3, None, 30, 1)],
        [("A", 2, "9", 20, 0), ("C", None, "9", 20, None), (None, 5, "1", 9, 2)],  # a late file of the first date, no date, a new date
    ]
    silver = lambda day, name, price: spark.createDataFrame(
        [(name, 1, price, 1.0, at(day * 86_400), at(day * 86_400), at(day * 86_400), None, None, False, "s", price, None)], silver_ddl)
    moves = [silver(0, "A", 5.0).union(silver(0, "B", 6.0)), silver(1, "C", -1.0), silver(3, "B", 7.0)]
    for number, (rows, trades) in enumerate(zip(batches, moves, strict=True)):
        lake.append(bronze, trade_rows(spark, *rows))
        lake.upsert("silver.trades", trades)
        if number == 2:
            lake.compact(bronze, more_than=1)
        args = {"checked_at": at(90_000), "fail_on_violation": False}
        folded = quality_run.run_quality(lake, f"folded-{number}", incremental=True, **args).select(*SHOWN)
        full = quality_run.run_quality(lake, f"full-{number}", **args).select(*SHOWN)
        assert sorted(map(tuple, folded.collect())) == sorted(map(tuple, full.collect()))
    again = quality_run.run_quality(lake, "again", incremental=True, **args).select(*SHOWN)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, full.collect()))


def test_an_incremental_run_reads_changed_dates_only(spark, lake, monkeypatch):
    table, rule = "bronze.trades_live_raw", [r for r in RULES if r.table == "bronze.trades_live_raw"]
    for day in range(3):
        lake.append(table, trade_rows(spark, ("A", day, "5", 10, day)))
    quality_run.run_quality(lake, "1", rules=rule, checked_at=at(0), fail_on_violation=False, incremental=True)
    lake.append(table, trade_rows(spark, ("A", 1, "5", 20, 3)))
    opened = []
    real = quality_run.partial_measures
    monkeypatch.setattr(quality_run, "partial_measures", lambda df, *a: opened.append(df.inputFiles()) or real(df, *a))
    run = quality_run.run_quality(lake, "2", rules=rule, checked_at=at(0), fail_on_violation=False, incremental=True)
    assert len(opened) == 1 and all("part_date=2024-03-27" in f for f in opened[0])
    row = run.first()
    assert row.row_count == 4 and "duplicate_count 1" in row.violations_json  # the key of an older date again
    opened.clear()
    quality_run.run_quality(lake, "3", rules=rule, checked_at=at(0), fail_on_violation=False, incremental=True)
    assert opened == []


def test_parts_of_dates_merge_like_whole_tables(spark):
    moment = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 60)
    rows = spark.range(20_000).select(moment.alias("window_start"), F.concat(F.lit("S"), F.col("id") % distinct.EXACT_UP_TO).alias("symbol"))
    rows = rows.withColumn("symbol", F.when(F.col("window_start") > F.timestamp_seconds(F.lit(1_700_060_000)), F.col("symbol")))
    rows = rows.unionByName(rows.limit(2).withColumn("window_start", F.lit(None).cast("timestamp")))
    late = F.coalesce(F.col("window_start") > F.timestamp_seconds(F.lit(1_700_500_000)), F.lit(False))
    merged = distinct.merge_parts(distinct.daily_parts(rows.where(~late), "window_start"), distinct.daily_parts(rows.where(late), "window_start"))
    assert merged.count() == rows.select(F.to_date("window_start")).distinct().count()
    expected = reports.freshness_overview({"gold_volume_1m": rows}, at(0)).collect()
    found = distinct.freshness_of_parts(merged, "gold_volume_1m", "window_start", at(0))
    assert found.select(*expected[0].__fields__).collect() == expected


def test_estimates_of_many_symbols_keep_their_error(spark):
    rows = spark.range(300_000).select(F.lit(at(0)).alias("window_start"), F.col("id").cast("string").alias("symbol"))
    (row,) = (distinct.freshness_of_parts(distinct.daily_parts(rows, "window_start"), "gold_volume_1m", "window_start", at(0)).collect())
    assert abs(row.distinct_symbol_count / 300_000 - 1) < 4 * 1.04 / 2 ** (distinct.PRECISION / 2)


def test_parts_of_an_empty_table(spark):
    none = spark.createDataFrame([], "window_start timestamp, symbol string")
    parts = distinct.daily_parts(none, "window_start")
    assert parts.count() == 0 and distinct.merge_parts(parts, parts).count() == 0
    (row,) = (distinct.freshness_of_parts(parts, "gold_volume_1m", "window_start", at(0)).collect())
    assert (row.row_count, row.distinct_symbol_count, row.latest_timestamp, row.age_minutes) == (0, 0, None, None)

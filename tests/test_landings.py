"""Feeds that land in several batches, and keys of quality runs, are written once."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick import feeds
from candlewick.plans import quality_run
from candlewick.registry import queries
from candlewick.sinks.lake import Lake
from tests.test_growth import rows


def test_feeds_that_land_in_batches_are_derived_once(spark, monkeypatch):
    asked = []
    real = feeds.events
    monkeypatch.setattr(feeds, "events", lambda *given: asked.append(given) or real(*given))
    lake = queries._two_batches(spark, "/root/testdata/sf0.001", with_gold=False)
    # Trades and, for history and live ones, candles: before, these three for each of three landings.
    assert len(asked) == 3
    expected = queries.silver.silver_trades(feeds.bronze_trades(spark, "/root/testdata/sf0.001"))
    key = lambda df: rows(df.select("symbol", "trade_id", "price", F.unix_micros("event_time")))
    assert key(lake.read("silver.trades")) == key(expected)


def test_a_quality_run_rewrites_its_keys_once(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path))
    checked = queries._checked(spark, "/root/testdata/sf0.001", landed=True)
    names = ["bronze_trades_live_raw", "silver_trades", "gold_latest_price"]
    rules = [queries.RULE_OF[name] for name in names]
    for rule in rules:
        lake.append(rule.table, checked[rule.dataset])
    replaced, real = [], Lake.replace_dates
    monkeypatch.setattr(Lake, "replace_dates", lambda self, name, *rest: replaced.append(name) or real(self, name, *rest))
    run = quality_run.run_quality(lake, "one", rules, queries.ARRIVED, fail_on_violation=False, incremental=True)
    assert replaced == [quality_run.KEYS]  # before, once for each dataset whose keys can recur
    whole = quality_run.run_quality(lake, "whole", rules, queries.ARRIVED, fail_on_violation=False)
    verdicts = lambda df: rows(df.select("dataset_name", "passed", "row_count", "violations_json", "summary_json"))
    assert verdicts(run) == verdicts(whole)

"""Every operator as a query over the driver tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick import feeds, schemas
from candlewick.operators import distinct, filters, gold, payloads, quality, reports, silver
from candlewick.operators.merging import merge_rows
from candlewick.operators.quality_rules import RULE_OF, RULES
from candlewick.plans import backfill, gold_build, quality_run, serving, silver_build, state
from candlewick.plans.observability import dashboard, observability_report
from candlewick.registry.audit_history import audit_history
from candlewick.registry.served import DASHBOARD, SECTIONS, SERVED
from candlewick.schemas import SERVING_DATASETS
from candlewick.sinks.lake import Lake
from candlewick.sinks.workspace import new_folder
from candlewick.sources import datasets, history, live
from candlewick.streaming.ingest import message_stream, stream_ingest
from candlewick.streaming.silver import stream_silver
from candlewick.streaming.volume import late_trades, stream_volume_1m, stream_volume_updates

AS_OF = datetime(2024, 1, 30, 18, tzinfo=timezone.utc)
ARRIVED = datetime(2024, 2, 1, tzinfo=timezone.utc)
HALFWAY = datetime(2024, 1, 16, tzinfo=timezone.utc)
SYMBOLS = [" view-1 ", "PURCHASE-3", "error-7", ""]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    """Register a function under its name; results show UTC times without a zone."""

    def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return naive(run(spark, sf_dir))

    QUERIES[run.__name__] = wrapped
    return run


def naive(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c, kind in df.dtypes if kind == "timestamp"})


def _lake(spark: SparkSession, label: str) -> Lake:
    return Lake(spark, new_folder(spark, label))


# -- sources --------------------------------------------------------------------------------------


def _history_files(spark: SparkSession, sf_dir: str) -> str:
    """History groups of all candles, one line per symbol and day; some candles are cut short."""
    rows = feeds.candles(spark, sf_dir)
    cells = [
        F.unix_millis("open_time").cast("string"), *[_quoted(c) for c in ("open", "high", "low", "close", "volume")],
        (F.unix_millis("close_time") + 999).cast("string"), _quoted("quote_volume"),
        F.col("trade_count").cast("string"), F.lit('"0"'), F.lit('"0"'), F.lit("0"),
    ]
    array = F.concat(F.lit("["), F.array_join(F.array(*cells), ","), F.lit("]"))
    short = F.concat(F.lit("["), F.array_join(F.array(*cells[:6]), ","), F.lit("]"))
    rows = rows.withColumn("cells", F.when(F.col("trade_count") > 1, array).otherwise(
        F.when(F.col("volume") == 50, short).otherwise(array)))
    groups = rows.groupBy("symbol", F.to_date("open_time").alias("day")).agg(F.collect_list("cells").alias("list"))
    line = F.concat(
        F.lit('{"symbol":"'), F.col("symbol"), F.lit('","interval":"1h","klines":['),
        F.array_join("list", ","), F.lit("]}"),
    )
    folder = new_folder(spark, "history")
    groups.select(line.alias("value")).write.text(folder)
    return folder


def _quoted(column: str):
    return F.concat(F.lit('"'), F.coalesce(F.col(column).cast("string"), F.lit("0")), F.lit('"'))


KLINE_VALUES = ("symbol", "interval", "open_time", "close_time", "open", "high", "low", "close", "volume", "trade_count")


@query
def history_scan(spark, sf_dir):
    rows = history.history_scan(spark, _history_files(spark, sf_dir), "lines", ARRIVED)
    return rows.select("source", "event_type", *KLINE_VALUES, "is_closed", "event_time", "ingested_at")


def _candle_responses(spark, sf_dir):
    rows = feeds.candles(spark, sf_dir)
    cells = [
        F.unix_millis("open_time").cast("string"), *[_quoted(c) for c in ("open", "high", "low", "close", "volume")],
        (F.unix_millis("close_time") + 999).cast("string"), F.lit('"0"'), F.col("trade_count").cast("string"),
        F.lit('"0"'), F.lit('"0"'), F.lit("0"),
    ]
    array = F.concat(F.lit("["), F.array_join(F.array(*cells), ","), F.lit("]"))
    days = rows.withColumn("cells", array).groupBy("symbol", F.to_date("open_time").alias("day"))
    lines = days.agg(F.concat(F.lit("["), F.array_join(F.collect_list("cells"), ","), F.lit("]")).alias("value"))
    folder = new_folder(spark, "rest-candles")
    lines.select(F.lower("symbol").alias("symbol"), "value").write.partitionBy("symbol").text(folder)
    return folder


@query
def rest_candles_scan(spark, sf_dir):
    scanned = history.rest_candles_scan(spark, _candle_responses(spark, sf_dir), "1h", ARRIVED)
    return scanned.select("source", "event_type", *KLINE_VALUES, "is_closed", "event_time", "ingested_at")


def _with_faults(lines):
    """Every line, and beside it a cut copy and an error body."""
    value = F.explode(F.array("value", F.substring("value", 1, 30), F.lit('{"code":-1121}')))
    return lines.select(*[c for c in lines.columns if c != "value"], value.alias("value"))


def _by_reason(rows):
    return rows.groupBy(F.coalesce("reason", F.lit("usable")).alias("reason")).agg(F.count("*").alias("elements"))


@query
def history_quarantine(spark, sf_dir):
    """What becomes of every element of damaged history files."""
    folder = new_folder(spark, "history-faults")
    _with_faults(spark.read.text(_history_files(spark, sf_dir))).write.text(folder)
    return _by_reason(history.explode_candles(history.read_history_groups(spark, folder, "lines")))


TRADE_VALUES = (
    "source", "event_type", "symbol", "trade_id", "price", "quantity", "trade_time", "event_time",
    "is_market_maker", "ingested_at",
)


def _trade_pages(spark, sf_dir):
    rows = feeds.events(spark, sf_dir)
    trade = F.struct(
        F.col("trade_id").alias("id"), F.col("price").cast("string").alias("price"),
        F.col("quantity").cast("string").alias("qty"), F.unix_millis("trade_time").alias("time"),
        (F.col("source") == "error").alias("isBuyerMaker"),
    )
    # A response holds at most 500 trades, however many a symbol has.
    pages = rows.groupBy(F.lower("symbol").alias("symbol"), F.floor(F.col("trade_id") / 500).alias("page"))
    return pages.agg(F.to_json(F.collect_list(trade)).alias("value")).select("symbol", "value")


@query
def rest_trades_scan(spark, sf_dir):
    folder = new_folder(spark, "rest-trades")
    _trade_pages(spark, sf_dir).write.partitionBy("symbol").text(folder)
    return live.rest_trades_scan(spark, folder, ARRIVED).select(*TRADE_VALUES)


@query
def rest_quarantine(spark, sf_dir):
    """What becomes of every element of damaged snapshot responses."""
    folder = new_folder(spark, "rest-faults")
    _with_faults(_trade_pages(spark, sf_dir)).write.partitionBy("symbol").text(folder)
    return _by_reason(live.read_rest_trades(spark, folder))


@query
def document_quarantine(spark, sf_dir):
    """What becomes of the messages in files of one list each, and of the same files cut short."""
    folder = new_folder(spark, "documents")
    pages = feeds.events(spark, sf_dir).groupBy(F.floor(F.col("trade_id") / 500))
    event = F.struct(
        F.lit("trade").alias("e"), F.col("symbol").alias("s"), F.col("trade_id").alias("t"), F.col("price").cast("string").alias("p"),
        F.col("quantity").cast("string").alias("q"), F.unix_millis("trade_time").alias("T"),
    )
    lists = pages.agg(F.to_json(F.collect_list(event)).alias("value")).select("value")
    _with_faults(lists).write.option("maxRecordsPerFile", 1).text(folder)
    return _by_reason(live.live_scan(spark, folder, "document", ingested_at=ARRIVED))


@query
def live_scan(spark, sf_dir):
    """Messages written to files, scanned back: the usable trades."""
    folder = new_folder(spark, "messages")
    feeds.messages(spark, sf_dir).write.text(folder)
    parsed = live.live_scan(spark, folder, "lines", ingested_at=ARRIVED)
    return payloads.trades_of(parsed).select(*TRADE_VALUES)


# -- parsing --------------------------------------------------------------------------------------


@query
def unwrap_payload(spark, sf_dir):
    return payloads.unwrap_payload(feeds.trade_messages(spark, sf_dir)).select("trade_id", "payload")


@query
def classify_payload(spark, sf_dir):
    return payloads.classify_payload(feeds.trade_messages(spark, sf_dir)).select("trade_id", "payload_kind")


@query
def parse_json_objects(spark, sf_dir):
    return payloads.parse_json_objects(feeds.trade_messages(spark, sf_dir))


@query
def parse_trades(spark, sf_dir):
    return payloads.parse_trades(feeds.messages(spark, sf_dir), ingested_at=ARRIVED).select(*TRADE_VALUES)


@query
def parse_klines(spark, sf_dir):
    rows = payloads.parse_klines(feeds.messages(spark, sf_dir), ingested_at=ARRIVED)
    return rows.select("source", "event_type", *KLINE_VALUES, "quote_volume", "is_closed", "event_time", "ingested_at")


@query
def quarantine_payloads(spark, sf_dir):
    parsed = payloads.parse_market(feeds.messages(spark, sf_dir), ingested_at=ARRIVED)
    return payloads.quarantine_of(parsed)


@query
def filter_event_type(spark, sf_dir):
    both = feeds.bronze_history(spark, sf_dir).select("event_type", "symbol", "open_time", "event_time").unionByName(
        feeds.bronze_live_klines(spark, sf_dir).select("event_type", "symbol", "open_time", "event_time")
    )
    return payloads.filter_event_type(both, "kline")


@query
def event_counts(spark, sf_dir):
    parsed = payloads.parse_market(feeds.messages(spark, sf_dir), ingested_at=ARRIVED)
    kinds = payloads.trades_of(parsed).select("event_type").unionByName(payloads.klines_of(parsed).select("event_type"))
    return payloads.event_counts(kinds)


@query
def field_drift(spark, sf_dir):
    return payloads.field_drift(feeds.messages(spark, sf_dir))


# -- silver ---------------------------------------------------------------------------------------

SILVER_TRADE = ("symbol", "trade_id", "price", "quantity", "trade_time", "event_time", "ingested_at", "source", "notional")
SILVER_KLINE = (*KLINE_VALUES, "is_closed", "event_time", "ingested_at", "source")


@query
def silver_trades(spark, sf_dir):
    return silver.silver_trades(feeds.bronze_trades(spark, sf_dir)).select(*SILVER_TRADE)


@query
def silver_klines(spark, sf_dir):
    both = silver.union_klines(feeds.bronze_history(spark, sf_dir), feeds.bronze_live_klines(spark, sf_dir))
    return silver.silver_klines(both).select(*SILVER_KLINE)


@query
def union_klines(spark, sf_dir):
    live_rows = feeds.bronze_live_klines(spark, sf_dir).drop("trade_count")
    both = silver.union_klines(feeds.bronze_history(spark, sf_dir), live_rows)
    return both.select("source", "symbol", "open_time", "close", "trade_count", "is_closed", "event_time")


@query
def normalize_defaults(spark, sf_dir):
    partial = feeds.bronze_trades(spark, sf_dir).select("symbol", "trade_id", "price", "quantity", "trade_time")
    return silver.trade_defaults(partial).select(*TRADE_VALUES)


@query
def normalize_kline_defaults(spark, sf_dir):
    partial = feeds.bronze_history(spark, sf_dir).select(
        "symbol", "interval", "open_time", "close_time", "open", "high", "low", "close", "volume"
    )
    return silver.kline_defaults(partial).select(*SILVER_KLINE)


@query
def tag_source(spark, sf_dir):
    return silver.tag_source(feeds.trades(spark, sf_dir), "replay").select("symbol", "trade_id", "price", "source")


# -- filters and casts ----------------------------------------------------------------------------


@query
def filter_symbols(spark, sf_dir):
    return filters.filter_symbols(feeds.trades(spark, sf_dir), SYMBOLS).select("symbol", "trade_id", "price")


@query
def cast_to_schema(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    texts = rows.select(
        F.col("event_id").cast("string").alias("trade_id"), F.col("ts").cast("string").alias("trade_time"),
        F.col("value").cast("string").alias("price"), F.col("event_type").alias("quantity"),
    )
    casts = {"trade_id": "bigint", "trade_time": "timestamp", "price": "double", "quantity": "double", "none": "int"}
    return filters.cast_to_schema(texts, casts)


@query
def klines_sanity(spark, sf_dir):
    """Candles around the mean price, so that many fall below zero."""
    shifted = feeds.candles(spark, sf_dir).withColumns(
        {c: F.round(F.col(c) - 20, 6) for c in ("open", "high", "low", "close")}
    )
    return filters.negative_klines(shifted)


@query
def trade_null_counts(spark, sf_dir):
    return filters.trade_null_counts(feeds.bronze_trades(spark, sf_dir))


@query
def trade_duplicates(spark, sf_dir):
    return filters.trade_duplicates(feeds.bronze_trades(spark, sf_dir))


@query
def max_watermark(spark, sf_dir):
    return filters.max_watermark(feeds.bronze_trades(spark, sf_dir), "ingested_at")


@query
def watermark_filter(spark, sf_dir):
    rows = filters.after_watermark(feeds.bronze_trades(spark, sf_dir), "ingested_at", HALFWAY, 120)
    return rows.select("symbol", "trade_id", "price", "ingested_at")


@query
def latest_trade_time(spark, sf_dir):
    return filters.latest_trade_time(gold.latest_price(feeds.trades(spark, sf_dir)), AS_OF)


# -- gold -----------------------------------------------------------------------------------------


@query
def latest_price(spark, sf_dir):
    return gold.latest_price(feeds.trades(spark, sf_dir))


@query
def volume_1m(spark, sf_dir):
    return feeds.gold_volume(spark, sf_dir)


@query
def volatility_5m(spark, sf_dir):
    return feeds.gold_volatility(spark, sf_dir)


@query
def volatility_5m_in_window(spark, sf_dir):
    return gold.rolling_volatility(feeds.candles(spark, sf_dir), returns="in_window")


@query
def volatility_5m_by_interval(spark, sf_dir):
    """Two candle widths per symbol, each its own series, in slices of one day."""
    hourly = feeds.candles(spark, sf_dir)
    coarse = hourly.where(F.hour("open_time") < 12).withColumn("interval", F.lit("12h"))
    return gold.rolling_volatility(hourly.unionByName(coarse), by=("symbol", "interval"), slice_days=1)


@query
def top_movers(spark, sf_dir):
    return feeds.gold_movers(spark, sf_dir)


# -- incremental ----------------------------------------------------------------------------------


def _silver_lake(spark: SparkSession, sf_dir: str, until: datetime | None = None) -> Lake:
    """A lake whose silver tables were built from bronze rows that arrived before ``until``."""
    lake = _lake(spark, "silver")
    _load_bronze(lake, _bronze(spark, sf_dir), None, until)
    silver_build.build_silver(lake, updated_at=AS_OF)
    return lake


#: What arrives late, with old arrival times: all deliveries of some kinds of events, and the candles of their symbols.
LATE = ("CLICK", "ERROR")


def _bronze(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "bronze.trades_live_raw": feeds.bronze_trades(spark, sf_dir),
        "bronze.klines_history_raw": feeds.bronze_history(spark, sf_dir),
        "bronze.klines_live_raw": feeds.bronze_live_klines(spark, sf_dir),
    }


def _landed(rows: DataFrame) -> DataFrame:
    """The rows as files, so that a feed that lands in several batches is derived once and not once for each."""
    folder = new_folder(rows.sparkSession, "feed")
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def _load_bronze(
    lake: Lake, sources: dict[str, DataFrame], since: datetime | None, until: datetime | None, late: bool | None = None
) -> None:
    """Bronze rows that arrived in a span of time; ``late`` takes only the rows that land late, or only the others."""
    for table, rows in sources.items():
        if since is not None:
            rows = rows.where(F.col("ingested_at") >= F.lit(since))
        if until is not None:
            rows = rows.where(F.col("ingested_at") < F.lit(until))
        if late is not None:
            rows = rows.where(F.split_part("symbol", F.lit("-"), F.lit(1)).isin(*LATE) == F.lit(late))
        lake.append(table, _gathered(rows))


def _gathered(rows: DataFrame) -> DataFrame:
    """Rows of an arrival date together, so that an append makes one file a date and not one a task and date."""
    return rows.withColumn("_date", F.to_date("ingested_at")).hint("rebalance", F.col("_date")).drop("_date")


def _two_batches(spark: SparkSession, sf_dir: str, with_gold: bool = True) -> Lake:
    """Bronze lands in two batches; silver and gold are built after each. The second also brings rows of the first half
    whose arrival times are far older than the watermark."""
    lake, sources = _lake(spark, "silver"), {table: _landed(rows) for table, rows in _bronze(spark, sf_dir).items()}
    _load_bronze(lake, sources, None, HALFWAY, late=False)
    silver_build.build_silver(lake, updated_at=AS_OF)
    if with_gold:
        gold_build.build_gold(lake, updated_at=AS_OF)
    _load_bronze(lake, sources, None, HALFWAY, late=True)
    _load_bronze(lake, sources, HALFWAY, None)
    silver_build.build_silver(lake, updated_at=ARRIVED)
    if with_gold:
        gold_build.build_gold(lake, updated_at=ARRIVED)
    return lake


@query
def silver_build_incremental(spark, sf_dir):
    return _two_batches(spark, sf_dir, with_gold=False).read("silver.trades").select(*SILVER_TRADE)


@query
def silver_klines_incremental(spark, sf_dir):
    return _two_batches(spark, sf_dir, with_gold=False).read("silver.klines_1m").select(*SILVER_KLINE)


@query
def gold_build_incremental(spark, sf_dir):
    """Rows of the four gold tables after two incremental builds, as one list of measures."""
    lake = _two_batches(spark, sf_dir)
    measures = {
        "gold.latest_price": ("trade_time", "latest_price"),
        "gold.volume_1m": ("window_start", "notional_1m"),
        "gold.volatility_5m": ("window_start", "volatility_5m"),
        "gold.top_movers": ("window_start", "move_pct"),
    }
    parts = [
        lake.read(table).select(
            F.lit(table).alias("table_name"), "symbol", F.col(moment).alias("moment"), F.col(value).alias("value")
        )
        for table, (moment, value) in measures.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


QUERIES["gold_build"] = QUERIES.pop("gold_build_incremental")


def _changed(df: DataFrame) -> DataFrame:
    return filters.after_watermark(df, "ingested_at", HALFWAY)


def _before(df: DataFrame) -> DataFrame:
    return df.where(F.col("ingested_at") <= F.lit(HALFWAY))


@query
def latest_price_incremental(spark, sf_dir):
    trades = silver.silver_trades(feeds.bronze_trades(spark, sf_dir))
    stored = gold.latest_price(_before(trades))
    update = gold_build.latest_price_update(_changed(trades), stored)
    return merge_rows(stored, update, ["symbol"])


@query
def volume_1m_incremental(spark, sf_dir):
    trades = feeds.trades(spark, sf_dir)
    update = gold_build.volume_update(_changed(trades), trades)
    return merge_rows(gold.volume_1m(_before(trades)), update, ["symbol", "window_start"])


@query
def volatility_incremental(spark, sf_dir):
    klines = feeds.candles(spark, sf_dir)
    update = gold_build.volatility_update(_changed(klines), klines)
    return merge_rows(gold.rolling_volatility(_before(klines)), update, ["symbol", "window_start"])


@query
def top_movers_incremental(spark, sf_dir):
    """Movers of the stored ends of each series, merged with those of the changed candles."""
    klines = feeds.candles(spark, sf_dir)
    lake = _lake(spark, "movers")
    lake.upsert("gold.series_ends", gold.series_ends(_before(klines)))
    lake.upsert("gold.top_movers", gold.rank_movers(gold.moves_of_ends(lake.read("gold.series_ends"))))
    changed = gold.series_ends(_changed(klines))
    lake.upsert("gold.series_ends", gold.merge_ends(lake.read("gold.series_ends"), changed))
    lake.upsert("gold.top_movers", gold.rank_movers(gold.moves_of_ends(lake.read("gold.series_ends"))), delete_unmatched=True)
    return lake.read("gold.top_movers")


# -- storage --------------------------------------------------------------------------------------


@query
def table_schemas(spark, sf_dir):
    """Stored columns, with how many of them each table's rows derived from the input fill."""
    lake = _lake(spark, "schemas")
    frames = {
        "silver.trades": feeds.trades(spark, sf_dir), "silver.klines_1m": feeds.candles(spark, sf_dir),
        "gold.volume_1m": feeds.gold_volume(spark, sf_dir), "gold.top_movers": feeds.gold_movers(spark, sf_dir),
    }
    for table, df in frames.items():
        lake.overwrite(table, df)
    counts = [
        lake.read(table).agg(F.count(F.lit(1)).alias("row_count")).withColumn("table_name", F.lit(table))
        for table in frames
    ]
    rows = counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])
    return schemas.table_schemas(spark).join(rows, "table_name")


@query
def write_dataset(spark, sf_dir):
    folder = new_folder(spark, "dataset")
    rows = feeds.trades(spark, sf_dir).select("symbol", "trade_id", "price", "trade_time")
    early = F.col("trade_time") < F.lit(HALFWAY)
    target = datasets.Target(path=folder)
    target.write(rows.where(early), "overwrite")
    target.write(rows.where(~early), "append")
    return target.read(spark)


@query
def read_optional(spark, sf_dir):
    """A dataset chosen by path, together with a missing one that reads as empty."""
    base = new_folder(spark, "optional")
    target = datasets.choose_source("gold", "volume_1m", base)
    target.write(feeds.gold_volume(spark, sf_dir))
    missing = datasets.choose_source("gold", "absent", base)
    return target.read_or_empty(spark, "gold.volume_1m").unionByName(missing.read_or_empty(spark, "gold.volume_1m"))


def _deliveries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """First and second deliveries of the trades, each unique by key."""
    typed = silver.project_trades(feeds.bronze_trades(spark, sf_dir))
    first = typed.where(F.col("event_time") == F.col("trade_time"))
    return first, typed.where(F.col("event_time") > F.col("trade_time"))


@query
def upsert(spark, sf_dir):
    lake = _lake(spark, "upsert")
    for batch in _deliveries(spark, sf_dir):
        lake.upsert("silver.trades", batch)
    return lake.read("silver.trades").select(*SILVER_TRADE)


@query
def upsert_last_batch_wins(spark, sf_dir):
    """The older delivery arrives last and, without a guard, replaces the newer row."""
    lake = _lake(spark, "upsert")
    for batch in reversed(_deliveries(spark, sf_dir)):
        lake.upsert("silver.trades", batch)
    return lake.read("silver.trades").select(*SILVER_TRADE)


@query
def upsert_newer_than(spark, sf_dir):
    """The older delivery arrives last and is kept out by its event time."""
    lake = _lake(spark, "upsert")
    for batch in reversed(_deliveries(spark, sf_dir)):
        lake.upsert("silver.trades", batch, newer_than=silver.NEWEST)
    return lake.read("silver.trades").select(*SILVER_TRADE)


@query
def upsert_replace(spark, sf_dir):
    lake = _lake(spark, "replace")
    volume = feeds.gold_volume(spark, sf_dir)
    lake.upsert("gold.volume_1m", volume)
    lake.upsert("gold.volume_1m", volume.where(F.col("volume_1m") >= 50), delete_unmatched=True)
    return lake.read("gold.volume_1m")


# -- quality --------------------------------------------------------------------------------------

VERDICT = (
    "dataset_name", "layer", "passed", "row_count", "min_row_count", "schema_passed", "null_checks_passed",
    "duplicate_check_passed", "freshness_check_passed", "bounds_check_passed",
)


def _checked(spark: SparkSession, sf_dir: str, landed: bool = False) -> dict[str, DataFrame]:
    """The nine checked datasets; ``landed`` derives each once, for runs that read them again."""
    keep = _landed if landed else lambda rows: rows
    trades = keep(feeds.trades(spark, sf_dir))
    klines = keep(feeds.candles(spark, sf_dir))
    found = {
        "bronze_trades_live_raw": feeds.bronze_trades(spark, sf_dir),
        "bronze_klines_history_raw": feeds.bronze_history(spark, sf_dir),
        "bronze_klines_live_raw": feeds.bronze_live_klines(spark, sf_dir),
        "silver_trades": trades,
        "silver_klines_1m": klines,
        "gold_latest_price": gold.latest_price(trades),
        "gold_volume_1m": gold.volume_1m(trades),
        "gold_volatility_5m": gold.rolling_volatility(klines),
        "gold_top_movers": gold.top_movers(klines),
    }
    return {name: df if df is trades or df is klines else keep(df) for name, df in found.items()}


@query
def dq_row_count(spark, sf_dir):
    parts = [
        quality.metrics(df, RULE_OF[name]).select(
            F.lit(name).alias("dataset_name"), "row_count",
            (F.col("row_count") >= RULE_OF[name].min_rows).alias("passed"),
        )
        for name, df in _checked(spark, sf_dir).items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query
def dq_schema(spark, sf_dir):
    """The trade rule against trades without price and event time."""
    rows = feeds.bronze_trades(spark, sf_dir).drop("price", "event_time")
    verdict = quality.check_dataset(rows, RULE_OF["bronze_trades_live_raw"], AS_OF)
    return verdict.select(*VERDICT, F.array_join("violations", "\n").alias("violations"))


@query
def dq_null_ratio(spark, sf_dir):
    rule = RULE_OF["bronze_trades_live_raw"]
    measured = quality.metrics(feeds.bronze_trades(spark, sf_dir), rule)
    ratio = F.col("null__price") / F.col("row_count")
    return measured.select("row_count", "null__price", ratio.alias("null_ratio"), (ratio <= 0.0).alias("passed"))


@query
def dq_duplicates(spark, sf_dir):
    return quality.duplicate_count(feeds.bronze_trades(spark, sf_dir), ["symbol", "trade_id"])


@query
def dq_bounds(spark, sf_dir):
    rule = RULE_OF["bronze_trades_live_raw"]
    measured = quality.metrics(feeds.bronze_trades(spark, sf_dir), rule)
    return measured.select("low__price", "high__price", "low__quantity", "high__quantity")


@query
def dq_freshness(spark, sf_dir):
    rows = feeds.trades(spark, sf_dir)
    verdict = quality.check_dataset(rows, RULE_OF["silver_trades"], ARRIVED)
    age = F.get_json_object("summary_json", "$.freshness_check.age_seconds").cast("double")
    return verdict.select("dataset_name", F.round(age, 3).alias("age_seconds"), "freshness_check_passed")


@query
def dq_violations(spark, sf_dir):
    verdict = quality.check_dataset(feeds.bronze_trades(spark, sf_dir), RULE_OF["bronze_trades_live_raw"], ARRIVED)
    return verdict.select("dataset_name", "passed", F.posexplode("violations").alias("position", "violation"))


@query
def dq_run(spark, sf_dir):
    verdicts = quality.check_datasets(spark, _checked(spark, sf_dir), RULES, ARRIVED)
    return verdicts.select(*VERDICT, F.array_join("violations", "\n").alias("violations"))


@query
def dq_run_incremental(spark, sf_dir):
    """The second of two runs over stored tables: it reads the dates that came between and folds their measures."""
    lake, checked = _lake(spark, "quality"), _checked(spark, sf_dir, landed=True)
    for number, part in enumerate((_before, lambda df: df.where(F.col("ingested_at") > F.lit(HALFWAY)))):
        for name, df in checked.items():
            table = RULE_OF[name].table
            if "ingested_at" in df.columns:
                lake.append(table, _gathered(part(df)))
            else:
                lake.overwrite(table, df)
        run = quality_run.run_quality(lake, f"run-{number}", checked_at=ARRIVED, fail_on_violation=False, incremental=True)
    return run.select(*VERDICT, F.array_join(F.from_json("violations_json", "array<string>"), "\n").alias("violations"))


AUDIT = (
    "audit_run_id", "checked_at", "environment", "job_name", "task_name", "dataset_name", "layer", "table_name",
    "passed", "row_count", "min_row_count", "violation_count", "violations_json", "schema_passed",
    "null_checks_passed", "duplicate_check_passed", "freshness_check_passed", "bounds_check_passed",
)


@query
def quality_audit_rows(spark, sf_dir):
    """Daily quality runs over four datasets, stored and read back."""
    lake = _lake(spark, "audit")
    lake.append("audit.quality_check_runs", audit_history(spark, sf_dir))
    return lake.read("audit.quality_check_runs").select(*AUDIT)


SUMMARY = """
    duplicate_check struct<duplicate_count: bigint>, freshness_check struct<column: string, age_seconds: double>,
    null_checks struct<metrics: map<string, struct<null_ratio: double>>>,
    bounds_check struct<metrics: map<string, struct<observed_min: double, observed_max: double>>>
"""


@query
def quality_summaries(spark, sf_dir):
    """All that the daily runs measured, read back from their JSON summaries."""
    lake = _lake(spark, "audit")
    lake.append("audit.quality_check_runs", audit_history(spark, sf_dir))
    runs = lake.read("audit.quality_check_runs").select("audit_run_id", "dataset_name", F.from_json("summary_json", SUMMARY).alias("s"))

    def values(measure, column, value, rows=runs):
        return rows.select("audit_run_id", "dataset_name", F.lit(measure).alias("measure"), column.alias("column_name"), value.alias("value"))

    nulls = runs.select("audit_run_id", "dataset_name", F.explode("s.null_checks.metrics").alias("c", "m"))
    bounds = runs.select("audit_run_id", "dataset_name", F.explode("s.bounds_check.metrics").alias("c", "m"))
    parts = [
        values("null_ratio", F.col("c"), F.col("m.null_ratio"), nulls),
        values("observed_min", F.col("c"), F.col("m.observed_min"), bounds),
        values("observed_max", F.col("c"), F.col("m.observed_max"), bounds),
        values("duplicate_count", F.lit(""), F.col("s.duplicate_check.duplicate_count").cast("double")),
        values("age_seconds", F.col("s.freshness_check.column"), F.col("s.freshness_check.age_seconds")),
    ]
    return reduce(DataFrame.unionByName, parts).where("value IS NOT NULL").withColumn("value", F.round("value", 6))


@query
def dq_gate(spark, sf_dir):
    """A gated run over a lake: audit rows are stored first, then the gate reports the failures."""
    lake = _silver_lake(spark, sf_dir)
    try:
        quality_run.run_quality(lake, "gated", checked_at=ARRIVED)
    except quality_run.QualityError:
        pass
    rows = lake.read("audit.quality_check_runs")
    return rows.select("audit_run_id", *VERDICT, "violation_count")


# -- reports --------------------------------------------------------------------------------------


@query
def latest_prices_report(spark, sf_dir):
    return reports.latest_prices(gold.latest_price(feeds.trades(spark, sf_dir)), SYMBOLS)


@query
def recent_volume(spark, sf_dir):
    return reports.recent_volume(feeds.gold_volume(spark, sf_dir), hours=6, as_of=AS_OF)


@query
def volatility_report(spark, sf_dir):
    return reports.volatility_history(feeds.gold_volatility(spark, sf_dir))


@query
def latest_volatility(spark, sf_dir):
    return reports.latest_volatility(feeds.gold_volatility(spark, sf_dir))


@query
def top_movers_report(spark, sf_dir):
    moves = gold.price_moves(feeds.candles(spark, sf_dir))
    return reports.movers_report(moves, limit=5)


@query
def quality_recent_runs(spark, sf_dir):
    return reports.quality_recent_runs(audit_history(spark, sf_dir))


@query
def quality_dataset_health(spark, sf_dir):
    return reports.quality_dataset_health(audit_history(spark, sf_dir))


@query
def quality_latest_status(spark, sf_dir):
    return reports.quality_latest_status(audit_history(spark, sf_dir))


@query
def quality_latest_failures(spark, sf_dir):
    return reports.quality_latest_failures(audit_history(spark, sf_dir))


@query
def quality_failed_datasets(spark, sf_dir):
    return reports.quality_failed_datasets(audit_history(spark, sf_dir))


@query
def quality_status_counts(spark, sf_dir):
    return reports.quality_status_counts(audit_history(spark, sf_dir))


def _state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State rows of a direct run over the input: newest arrivals of trades and candles."""
    return serving.direct_state(feeds.trades(spark, sf_dir), feeds.candles(spark, sf_dir), AS_OF)


def _datasets(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "gold_latest_price": gold.latest_price(feeds.trades(spark, sf_dir)),
        "gold_volume_1m": feeds.gold_volume(spark, sf_dir),
        "gold_volatility_5m": feeds.gold_volatility(spark, sf_dir),
        "gold_top_movers": feeds.gold_movers(spark, sf_dir),
        "audit_quality_check_runs": audit_history(spark, sf_dir),
        "audit_processing_state": _state(spark, sf_dir),
    }


@query
def processing_state_status(spark, sf_dir):
    return reports.processing_state_status(_state(spark, sf_dir), ARRIVED)


@query
def freshness_overview(spark, sf_dir):
    return reports.freshness_overview(_datasets(spark, sf_dir), ARRIVED)


@query
def freshness_by_parts(spark, sf_dir):
    """The volume's row of the overview from daily parts: mornings stored, afternoons arriving."""
    volume = feeds.gold_volume(spark, sf_dir)
    morning = F.hour("window_start") < 12
    stored, arriving = (distinct.daily_parts(volume.where(half), "window_start") for half in (morning, ~morning))
    return distinct.freshness_of_parts(distinct.merge_parts(stored, arriving), "gold_volume_1m", "window_start", ARRIVED)


@query
def dashboard_kpis(spark, sf_dir):
    return dashboard(_datasets(spark, sf_dir), as_of=ARRIVED)["kpis"]


def _sections(found, columns):
    """Rows of all sections as one: the section and all its columns, as text."""
    parts = []
    for name, df in found.items():
        kinds, wanted = dict(df.dtypes), columns[name].split()
        if df.columns != wanted:
            raise ValueError(f"{name}: {df.columns}")
        row = F.concat_ws("|", *[_shown(F.col(c), kinds[c]) for c in wanted])
        parts.append(df.select(F.lit(name).alias("section"), row.alias("row")))
    return reduce(DataFrame.unionByName, parts)


@query
def observability_report_query(spark, sf_dir):
    """All rows of every section of the report."""
    return _sections(observability_report(_datasets(spark, sf_dir), ARRIVED), SECTIONS)


@query
def dashboard_datasets(spark, sf_dir):
    """All rows of every dataset of the dashboard, for some symbols and three days."""
    return _sections(dashboard(_datasets(spark, sf_dir), SYMBOLS, hours=72, limit=5, as_of=ARRIVED), DASHBOARD)


QUERIES["observability_report"] = QUERIES.pop("observability_report_query")


# -- state ----------------------------------------------------------------------------------------


@query
def load_state(spark, sf_dir):
    lake = _silver_lake(spark, sf_dir)
    return state.load_state(lake, silver_build.PIPELINE)


@query
def state_rows(spark, sf_dir):
    """One state per symbol source: its newest arrival, found by one aggregate."""
    rows, newest = state.batch_extent(feeds.bronze_trades(spark, sf_dir))
    metadata = {"write_mode": "merge", "row_count": rows}
    return state.state_rows(
        spark, [state.State("transform_silver", "trades_live_raw", "bronze", "silver", newest, metadata)], AS_OF
    )


@query
def state_upsert(spark, sf_dir):
    lake = _two_batches(spark, sf_dir)
    return state.load_state(lake)


# -- serving --------------------------------------------------------------------------------------


def _contents(tables):
    """Rows of several tables as one: the table, a row's key and its values, as text."""
    parts = []
    for name, (df, keys, values) in tables.items():
        text = lambda columns, df=df: F.concat_ws("|", *[_shown(F.col(c), dict(df.dtypes)[c]) for c in columns])
        parts.append(df.select(F.lit(name).alias("dataset_name"), text(keys).alias("key"), text(values).alias("row")))
    return reduce(DataFrame.unionByName, parts)


def _shown(column, kind):
    if kind.startswith("timestamp"):
        return F.coalesce(F.unix_micros(column.cast("timestamp")).cast("string"), F.lit("-"))
    if kind == "double":  # eight decimals are stored
        return F.coalesce(F.round(column * 1_000_000).cast("bigint").cast("string"), F.lit("-"))
    return F.coalesce(column.cast("string"), F.lit("-"))


@query
def serving_snapshot(spark, sf_dir):
    """The rows that are served of every dataset, with the name of the choice."""
    chosen = {name: serving.serving_selection(name, df, as_of=AS_OF) for name, df in _datasets(spark, sf_dir).items()}
    rows = _contents({name: (df, *SERVED[name]) for name, (df, _) in chosen.items()})
    label = F.create_map(*[F.lit(x) for name, (_, selection) in chosen.items() for x in (name, selection)])
    return rows.withColumn("selection", label[F.col("dataset_name")])


@query
def publish_serving(spark, sf_dir):
    """All six datasets as published and read back from the serving lake."""
    source, target = _lake(spark, "gold"), _lake(spark, "serving")
    for name, df in _datasets(spark, sf_dir).items():
        source.overwrite(SERVING_DATASETS[name], df)
    serving.publish_serving(source, target, as_of=AS_OF)
    return _contents({name: (target.read(SERVING_DATASETS[name]), *SERVED[name]) for name in SERVING_DATASETS})


@query
def load_history(spark, sf_dir):
    """Usable candles of a direct run by source, from history files and from snapshot responses."""
    files = serving.load_history(spark, "fixture", _history_files(spark, sf_dir))
    responses = serving.load_history(spark, "binance_rest", _candle_responses(spark, sf_dir), "1h")
    rows = files.unionByName(responses).where("interval = '1h'")
    return rows.groupBy("source").agg(F.count("*").alias("candles"), F.max("open_time").alias("newest"))


def _direct(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return serving.direct_snapshot(
        feeds.bronze_history(spark, sf_dir), feeds.bronze_trades(spark, sf_dir),
        feeds.bronze_live_klines(spark, sf_dir), AS_OF, "test",
    )


@query
def direct_snapshot(spark, sf_dir):
    """All four gold datasets of a direct run as one list of measures."""
    snapshot = _direct(spark, sf_dir)
    measures = {
        "gold_latest_price": ("trade_time", "latest_price"),
        "gold_volume_1m": ("window_start", "notional_1m"),
        "gold_volatility_5m": ("window_start", "volatility_5m"),
        "gold_top_movers": ("window_start", "move_pct"),
    }
    parts = [
        snapshot[name].select(
            F.lit(name).alias("dataset_name"), "symbol", F.col(moment).alias("moment"), F.col(value).alias("value")
        )
        for name, (moment, value) in measures.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query
def direct_quality(spark, sf_dir):
    return _direct(spark, sf_dir)["audit_quality_check_runs"].select(*AUDIT)


@query
def direct_state(spark, sf_dir):
    return _direct(spark, sf_dir)["audit_processing_state"]


@query
def history_backfill(spark, sf_dir):
    lake = _lake(spark, "backfill")
    backfill.backfill_history(lake, _history_files(spark, sf_dir), "lines", ingested_at=ARRIVED)
    return lake.read("silver.klines_1m").select(*SILVER_KLINE)


# -- streams --------------------------------------------------------------------------------------


def _landed_messages(spark: SparkSession, sf_dir: str) -> str:
    folder = new_folder(spark, "landing")
    feeds.messages(spark, sf_dir).write.text(folder)
    return folder


@query
def stream_ingest_query(spark, sf_dir):
    lake = _lake(spark, "ingest")
    stream = message_stream(spark, _landed_messages(spark, sf_dir))
    writer = stream_ingest(stream, lake, new_folder(spark, "checkpoint"))
    writer.trigger(availableNow=True).start().awaitTermination()
    return _contents({
        "trades": (lake.read("bronze.trades_live_raw"), ["symbol", "trade_id"], [
            "source", "event_type", "price", "quantity", "trade_time", "event_time", "is_market_maker"]),
        "klines": (lake.read("bronze.klines_live_raw"), ["symbol", "interval", "open_time"], [
            "source", "event_type", "close_time", "open", "high", "low", "close", "volume", "trade_count", "is_closed", "event_time"]),
        "quarantine": (lake.read("bronze.quarantine"), ["raw_payload"], ["reason"]),
    })


QUERIES["stream_ingest"] = QUERIES.pop("stream_ingest_query")


def _stream_of(spark: SparkSession, df: DataFrame, label: str, batches: int) -> DataFrame:
    """The rows as files in no order, one for each batch: redeliveries meet their first delivery in another batch."""
    folder = new_folder(spark, label)
    df.repartition(batches, F.xxhash64("price", "ingested_at")).write.parquet(folder)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)


@query
def stream_silver_query(spark, sf_dir):
    lake = _lake(spark, "stream-silver")
    bronze = _stream_of(spark, feeds.bronze_trades(spark, sf_dir), "bronze", 3)
    writer = stream_silver(bronze, lake, new_folder(spark, "checkpoint"))
    writer.trigger(availableNow=True).start().awaitTermination()
    return lake.read("silver.trades").select(*SILVER_TRADE)


QUERIES["stream_silver"] = QUERIES.pop("stream_silver_query")


@query
def stream_volume_1m_query(spark, sf_dir):
    """Minutes that the stream closed; the last minutes stay open until newer trades arrive."""
    folder, target = new_folder(spark, "trades"), new_folder(spark, "volume")
    trades = feeds.trades(spark, sf_dir)
    trades.write.parquet(folder)
    # Files land in no order of time; one batch over all of them has no late rows.
    stream = spark.readStream.schema(trades.schema).parquet(folder)
    writer = stream_volume_1m(stream).writeStream.outputMode("append").format("parquet").option("path", target)
    writer = writer.option("checkpointLocation", new_folder(spark, "checkpoint"))
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(schemas.TABLES["gold.volume_1m"].ddl).parquet(target)


QUERIES["stream_volume_1m"] = QUERIES.pop("stream_volume_1m_query")


#: Days on which the stream's slices begin after the first; rows of ``LATE`` kinds land one slice later.
SLICES = (datetime(2024, 1, 11, tzinfo=timezone.utc), datetime(2024, 1, 21, tzinfo=timezone.utc))


def _streamed_volume(spark: SparkSession, sf_dir: str) -> Lake:
    """All trades land in four slices of time, two kinds one slice late; the stream runs after each."""
    lake, folder, checkpoint = _lake(spark, "volume"), new_folder(spark, "trades"), new_folder(spark, "checkpoint")
    trades = feeds.trades(spark, sf_dir)
    late = F.split_part("symbol", F.lit("-"), F.lit(1)).isin(*LATE)
    number = sum((F.col("trade_time") >= F.lit(day)).cast("int") for day in SLICES) + late.cast("int")
    for landing in range(len(SLICES) + 2):
        trades.where(number == landing).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(trades.schema).parquet(folder)
        writer = stream_volume_updates(stream, lake, checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()
    return lake


@query
def stream_volume_updates_query(spark, sf_dir):
    """Totals of all minutes after a stream with late trades."""
    return _streamed_volume(spark, sf_dir).read("gold.volume_1m")


QUERIES["stream_volume_updates"] = QUERIES.pop("stream_volume_updates_query")


@query
def stream_late_trades(spark, sf_dir):
    """How many of the stream's trades lay behind its watermark."""
    counts = late_trades(_streamed_volume(spark, sf_dir))
    return spark.createDataFrame([(counts["rows"], counts["late_rows"])], "trade_rows long, late_rows long")

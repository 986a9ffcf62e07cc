"""Raw exchange messages to typed bronze rows.

Every message is opened with ``json_tuple``: one pass over the text per nesting level,
keys matched by exact case (``t`` and ``T`` are different fields), bad text gives nulls.
A JSON null is treated like an absent field.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions.time import as_of_column, epoch_ms_to_second
from candlewick.schemas import TABLES

# Wire field -> bronze column, in wire order.
TRADE_FIELDS = {
    "s": "symbol", "t": "trade_id", "p": "price", "q": "quantity", "T": "trade_time",
    "E": "event_time", "e": "event_type", "b": "buyer_order_id", "a": "seller_order_id",
    "m": "is_market_maker",
}
KLINE_FIELDS = {
    "s": "symbol", "t": "open_time", "T": "close_time", "i": "interval", "o": "open", "h": "high",
    "l": "low", "c": "close", "v": "volume", "q": "quote_volume", "n": "trade_count", "x": "is_closed",
}
REQUIRED_TRADE = ("s", "t", "p", "q", "T")
REQUIRED_KLINE = ("s", "t", "T", "i", "o", "h", "l", "c", "v")
LIVE_SOURCE = "binance_live"
INTEGER_TRADE = ("t", "T")
INTEGER_KLINE = ("t", "T")


def parse_json_objects(raw: DataFrame, column: str = "raw_payload") -> DataFrame:
    """Keep the messages whose text is a JSON object."""
    return raw.where(F.schema_of_variant(F.try_parse_json(F.col(column))).startswith("OBJECT"))


def unwrap_payload(raw: DataFrame, column: str = "raw_payload") -> DataFrame:
    """Add ``payload``: the object under ``data`` when there is one, else the message itself."""
    # json_tuple returns a string value unquoted, so the text must show an object after the key.
    wrapped = F.col("_data").startswith("{") & F.col(column).rlike(r'"data"\s*:\s*\{')
    return raw.select("*", F.json_tuple(column, "data").alias("_data")).select(
        *raw.columns, F.when(wrapped, F.col("_data")).otherwise(F.col(column)).alias("payload")
    )


def open_payloads(raw: DataFrame, column: str = "raw_payload") -> DataFrame:
    """Add ``payload``, its trade fields (``f_*``), the nested candle text ``f_k`` and ``payload_kind``."""
    wire = [*TRADE_FIELDS, "k"]
    names = [_trade_name(key) for key in wire]
    opened = unwrap_payload(raw, column)
    opened = opened.select("*", F.json_tuple("payload", *wire).alias(*names))
    is_trade = F.lit(True)
    for key in REQUIRED_TRADE:
        is_trade = is_trade & F.col(_trade_name(key)).isNotNull()
    kind = F.when(F.col(_trade_name("k")).isNotNull(), "kline").when(is_trade, "trade")
    return opened.withColumn("payload_kind", kind)


def classify_payload(raw: DataFrame, column: str = "raw_payload") -> DataFrame:
    """``payload_kind``: kline when a candle is nested, trade when all trade fields are there, else null."""
    return open_payloads(raw, column).select(*raw.columns, "payload", "payload_kind")


def open_candles(opened: DataFrame) -> DataFrame:
    """Add the nested candle fields (``k_*``) to opened payloads."""
    names = [_kline_name(key) for key in KLINE_FIELDS]
    return opened.select("*", F.json_tuple(_trade_name("k"), *KLINE_FIELDS).alias(*names))


def _trade_name(key: str) -> str:
    return f"f_{TRADE_FIELDS.get(key, 'candle')}"


def _kline_name(key: str) -> str:
    return f"k_{KLINE_FIELDS[key]}"


def _missing(required: tuple[str, ...], integers: tuple[str, ...], name) -> Column:
    """Required wire fields that are absent or, for integer fields, unreadable."""
    checks = []
    for key in required:
        value = F.col(name(key))
        absent = value.try_cast("bigint").isNull() if key in integers else value.isNull()
        checks.append(F.when(absent, F.lit(key)))
    return F.array_compact(F.array(*checks))


def missing_trade_fields() -> Column:
    return _missing(REQUIRED_TRADE, INTEGER_TRADE, _trade_name)


def missing_kline_fields() -> Column:
    return _missing(REQUIRED_KLINE, INTEGER_KLINE, _kline_name)


def _trade_columns(source: str, ingested_at: Column) -> list[Column]:
    trade_time = epoch_ms_to_second(F.col("f_trade_time"))
    return [
        F.lit(source).alias("source"),
        F.coalesce("f_event_type", F.lit("trade")).alias("event_type"),
        F.col("f_symbol").alias("symbol"),
        F.col("f_trade_id").try_cast("bigint").alias("trade_id"),
        F.col("f_price").alias("price"),
        F.col("f_quantity").alias("quantity"),
        trade_time.alias("trade_time"),
        F.coalesce(epoch_ms_to_second(F.col("f_event_time")), trade_time).alias("event_time"),
        F.col("f_buyer_order_id").try_cast("bigint").alias("buyer_order_id"),
        F.col("f_seller_order_id").try_cast("bigint").alias("seller_order_id"),
        F.coalesce(F.col("f_is_market_maker").try_cast("boolean"), F.lit(False)).alias("is_market_maker"),
        ingested_at.alias("ingested_at"),
        F.col("raw_payload"),
    ]


def _kline_columns(source: str, ingested_at: Column) -> list[Column]:
    close_time = epoch_ms_to_second(F.col("k_close_time"))
    return [
        F.lit(source).alias("source"),
        F.coalesce("f_event_type", F.lit("kline")).alias("event_type"),
        F.col("k_symbol").alias("symbol"),
        F.col("k_interval").alias("interval"),
        epoch_ms_to_second(F.col("k_open_time")).alias("open_time"),
        close_time.alias("close_time"),
        *[F.col(f"k_{name}").alias(name) for name in ("open", "high", "low", "close", "volume", "quote_volume")],
        F.coalesce(F.col("k_trade_count").try_cast("int"), F.lit(0)).alias("trade_count"),
        F.coalesce(F.col("k_is_closed").try_cast("boolean"), F.lit(False)).alias("is_closed"),
        F.coalesce(epoch_ms_to_second(F.col("f_event_time")), close_time).alias("event_time"),
        ingested_at.alias("ingested_at"),
        F.col("raw_payload"),
    ]


def parse_trades(
    raw: DataFrame, source: str = LIVE_SOURCE, ingested_at: datetime | Column | None = None
) -> DataFrame:
    """Trade messages as ``bronze.trades_live_raw`` rows."""
    opened = open_payloads(raw).where((F.col("payload_kind") == "trade") & (F.size(missing_trade_fields()) == 0))
    return TABLES["bronze.trades_live_raw"].conform(opened.select(*_trade_columns(source, as_of_column(ingested_at))))


def parse_klines(
    raw: DataFrame, source: str = LIVE_SOURCE, ingested_at: datetime | Column | None = None
) -> DataFrame:
    """Candle messages as ``bronze.klines_live_raw`` rows."""
    opened = open_candles(open_payloads(raw).where(F.col("payload_kind") == "kline"))
    complete = opened.where(F.size(missing_kline_fields()) == 0)
    return TABLES["bronze.klines_live_raw"].conform(complete.select(*_kline_columns(source, as_of_column(ingested_at))))


def parse_market(
    raw: DataFrame, source: str = LIVE_SOURCE, ingested_at: datetime | Column | None = None
) -> DataFrame:
    """All messages in one pass: ``trade`` and ``kline`` structs, one of them null, plus ``reason``.

    ``reason`` is null for usable messages and names the fault for the others.
    """
    moment = as_of_column(ingested_at)
    opened = open_candles(open_payloads(raw))
    kind = F.col("payload_kind")
    lacking = (
        F.when(kind == "trade", missing_trade_fields())
        .when(kind == "kline", missing_kline_fields())
    )
    noun = F.when(kind == "trade", F.lit("trade")).otherwise(F.lit("kline"))
    reason = F.when(kind.isNull(), F.lit("unsupported payload")).when(
        F.size(lacking) > 0, F.concat(F.lit("missing "), noun, F.lit(" fields: "), F.array_join(lacking, ", "))
    )
    return opened.withColumn("reason", reason).select(
        "raw_payload",
        "payload_kind",
        "reason",
        moment.alias("ingested_at"),
        F.when(F.col("reason").isNull() & (kind == "trade"), F.struct(*_trade_columns(source, moment))).alias("trade"),
        F.when(F.col("reason").isNull() & (kind == "kline"), F.struct(*_kline_columns(source, moment))).alias("kline"),
    )


def trades_of(parsed: DataFrame) -> DataFrame:
    return TABLES["bronze.trades_live_raw"].conform(parsed.where("trade IS NOT NULL").select("trade.*"))


def klines_of(parsed: DataFrame) -> DataFrame:
    return TABLES["bronze.klines_live_raw"].conform(parsed.where("kline IS NOT NULL").select("kline.*"))


def quarantine_of(parsed: DataFrame) -> DataFrame:
    """Messages that fit no parser, with the reason; they never stop the job."""
    return TABLES["bronze.quarantine"].conform(parsed.where("reason IS NOT NULL"))


def filter_event_type(records: DataFrame, event_type: str) -> DataFrame:
    return records.where(F.col("event_type") == event_type)


def event_counts(records: DataFrame) -> DataFrame:
    return records.groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count"))


# JSON types by the head of a variant's schema; what is none of these is a number.
JSON_TYPES = {"OBJECT": "object", "ARRAY": "list", "STRING": "text", "BOOLEAN": "boolean", "VOID": "null"}


def field_drift(raw: DataFrame, column: str = "raw_payload") -> DataFrame:
    """``event_type``, ``field``, ``json_type`` and ``messages``: how many messages have a field of that type.

    A field that appears, goes or changes its type shows as a row that differs between two spans of messages. Every message
    is parsed once into a VARIANT; fields of nested objects are named ``outer.inner``, to one level. Messages that are no
    JSON objects have no fields.
    """
    whole, inner = F.try_parse_json(F.col(column)), F.try_variant_get("_whole", "$.data", "variant")
    is_object = lambda v: F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    opened = raw.select(whole.alias("_whole")).where(is_object("_whole"))
    opened = opened.select(F.when(is_object(inner), inner).otherwise(F.col("_whole")).alias("_payload"))
    fields = lambda v: F.explode(F.col(v).cast("map<string,variant>")).alias("field", "_value")
    top = opened.select(F.try_variant_get("_payload", "$.e", "string").alias("event_type"), fields("_payload"))
    nested = top.where(is_object("_value")).select("event_type", F.col("field").alias("_outer"), fields("_value"))
    nested = nested.select("event_type", F.concat_ws(".", "_outer", "field").alias("field"), "_value")
    kind = F.lit("number")
    for head, name in JSON_TYPES.items():
        kind = F.when(F.schema_of_variant("_value").startswith(head), name).otherwise(kind)
    return top.unionByName(nested).groupBy("event_type", "field", kind.alias("json_type")).agg(F.count(F.lit(1)).alias("messages"))

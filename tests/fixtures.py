"""Hand-typed market data: two symbols, one-minute candles and a few trades from 14:00 UTC."""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone

START = datetime(2024, 3, 24, 14, tzinfo=timezone.utc)
START_MS = 1711288800000
ARRIVED = datetime(2026, 3, 24, 14, 30, tzinfo=timezone.utc)
CLOSES = {
    "BTCUSDT": [65000, 65100, 65220, 65180, 65350, 65400],
    "ETHUSDT": [3500, 3490, 3480, 3510, 3545],
}
# symbol, trade id, price, quantity, seconds after the start
TRADES = [
    ("BTCUSDT", 1001, "65000.00", "0.10", 0),
    ("BTCUSDT", 1002, "65010.00", "0.20", 15),
    ("BTCUSDT", 1002, "65010.00", "0.20", 15),
    ("ETHUSDT", 2001, "3520.00", "1.50", 65),
    ("BTCUSDT", 1003, "65050.00", "0.15", 90),
    ("ETHUSDT", 2002, "3535.00", "1.00", 125),
]


def at(seconds: float) -> datetime:
    return START + timedelta(seconds=seconds)


def trade_event(symbol, trade_id, price, quantity, seconds, **more) -> dict:
    ms = START_MS + seconds * 1000
    return {"e": "trade", "E": ms, "s": symbol, "t": trade_id, "p": price, "q": quantity, "T": ms, "m": True, **more}


def trade_lines() -> list[str]:
    return [json.dumps(trade_event(*row)) for row in TRADES]


def kline_event(symbol, minute, close, closed, event_second, **more) -> dict:
    ms = START_MS + minute * 60_000
    candle = {
        "t": ms, "T": ms + 59_999, "s": symbol, "i": "1m", "o": "64950.00", "c": close, "h": "65020.00",
        "l": "64920.00", "v": "125.50", "n": 1200, "x": closed, "q": "8150000.00", **more,
    }
    return {"e": "kline", "E": START_MS + event_second * 1000, "s": symbol, "k": candle}


def live_messages() -> list[dict]:
    """Two trades and three candle updates, one of them still open."""
    inner = [
        trade_event(*TRADES[0], b=5001, a=7001),
        kline_event("BTCUSDT", 0, "64980.00", False, 30),
        kline_event("BTCUSDT", 0, "65000.00", True, 60),
        trade_event(*TRADES[3]),
        kline_event("ETHUSDT", 1, "3490.00", True, 120),
    ]
    return [{"stream": "any", "data": data} for data in inner]


def history_groups() -> list[dict]:
    def cells(minute: int, close: float) -> list:
        ms = START_MS + minute * 60_000
        price = f"{close:.2f}"
        return [ms, price, price, price, price, "100.00", ms + 59_999, "6500000.00", 1200, "50.0", "30.0", "0"]

    return [
        {"symbol": symbol, "interval": "1m", "source": "binance_history",
         "klines": [cells(i, close) for i, close in enumerate(closes)]}
        for symbol, closes in CLOSES.items()
    ]


def raw(spark, lines: list[str]):
    return spark.createDataFrame([(line,) for line in lines], "raw_payload string")


def candles(spark, series: dict[str, list[float | None]], interval: str = "1m", step_seconds: int = 60, first: int = 0):
    rows = []
    for symbol, closes in series.items():
        for i, close in enumerate(closes):
            if close is None:  # a gap
                continue
            opened = at((first + i) * step_seconds)
            closed = opened + timedelta(seconds=step_seconds - 1)
            price = float(close)
            rows.append(
                (symbol, interval, opened, closed, price, price, price, price, 1.0, None, 1, True, closed, closed,
                 "binance_history", None)
            )
    from candlewick.schemas import TABLES

    return spark.createDataFrame(rows, TABLES["silver.klines_1m"].ddl)

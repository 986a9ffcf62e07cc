"""Quality rules of the nine stored datasets, as data."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Rule:
    table: str  # key of schemas.TABLES
    required: tuple[str, ...] = ()
    null_ratios: dict[str, float] = field(default_factory=dict)
    keys: tuple[str, ...] = ()
    max_duplicates: int = 0
    # Restricts the duplicate check; live candle capture repeats a key while the candle is open.
    duplicates_where: str | None = None
    freshness: tuple[str, int] | None = None  # column, maximum age in seconds
    minimum: dict[str, float] = field(default_factory=dict)
    maximum: dict[str, float] = field(default_factory=dict)
    min_rows: int = 1

    @property
    def dataset(self) -> str:
        return self.table.replace(".", "_", 1)

    @property
    def bounded(self) -> list[str]:
        return list(dict.fromkeys([*self.minimum, *self.maximum]))


def _rule(table: str, required: str, **rest) -> Rule:
    """Every required column must also be free of nulls."""
    columns = tuple(required.split())
    return Rule(table, columns, dict.fromkeys(columns, 0.0), **rest)


_CANDLE = ("symbol", "interval", "open_time")
_NO_NEGATIVE_CANDLE = {"open": 0.0, "high": 0.0, "low": 0.0, "close": 0.0, "volume": 0.0}

# Checked columns, keys, ages and bounds per dataset.
RULES = (
    _rule(
        "bronze.trades_live_raw", "symbol trade_id price quantity trade_time event_time",
        keys=("symbol", "trade_id"), freshness=("event_time", 900), minimum={"price": 0.0, "quantity": 0.0},
    ),
    _rule(
        "bronze.klines_history_raw", "symbol interval open_time close_time open high low close volume",
        keys=_CANDLE, minimum=_NO_NEGATIVE_CANDLE,
    ),
    _rule(
        "bronze.klines_live_raw", "symbol interval open_time close_time open high low close volume event_time",
        keys=_CANDLE, duplicates_where="is_closed", freshness=("event_time", 900), minimum=_NO_NEGATIVE_CANDLE,
    ),
    _rule(
        "silver.trades", "symbol trade_id price quantity trade_time event_time ingested_at notional",
        keys=("symbol", "trade_id"), freshness=("trade_time", 900),
        minimum={"price": 0.0, "quantity": 0.0, "notional": 0.0},
    ),
    _rule(
        "silver.klines_1m", "symbol interval open_time close_time open high low close volume ingested_at",
        keys=_CANDLE, minimum=_NO_NEGATIVE_CANDLE,
    ),
    _rule(
        "gold.latest_price", "symbol latest_price trade_time",
        freshness=("trade_time", 900), minimum={"latest_price": 0.0},
    ),
    _rule(
        "gold.volume_1m", "symbol window_start volume_1m notional_1m trade_count",
        freshness=("window_start", 900), minimum={"volume_1m": 0.0, "notional_1m": 0.0, "trade_count": 1.0},
    ),
    _rule(
        "gold.volatility_5m", "symbol window_start window_end observation_count volatility_5m",
        minimum={"observation_count": 5.0, "volatility_5m": 0.0},
    ),
    _rule(
        "gold.top_movers", "symbol window_start window_end start_price end_price move_pct",
        minimum={"start_price": 0.0, "end_price": 0.0},
    ),
)
RULE_OF = {rule.dataset: rule for rule in RULES}

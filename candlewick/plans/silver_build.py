"""Bronze to silver, in full or from the stored watermarks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame

from candlewick.operators.filters import after_watermark, watermark_bound
from candlewick.operators.silver import NEWEST, silver_klines, silver_trades, union_klines
from candlewick.plans import ledger
from candlewick.plans.state import OVERLAP_SECONDS, WATERMARK, State, batch_extent, last_watermarks, save_state
from candlewick.sinks.lake import Store

PIPELINE = "transform_silver"
TRADES, HISTORY, LIVE = "bronze.trades_live_raw", "bronze.klines_history_raw", "bronze.klines_live_raw"


def _new_rows(
    lake: Store, table: str, since: dict[str, datetime | None], overlap: int | None
) -> tuple[DataFrame, datetime | None, ledger.Arrivals | None]:
    """Rows to consume, the watermark after them (none without rows), and their ledger entry; ``overlap`` None asks the ledger."""
    last = since.get(_short(table))
    if overlap is None:
        batch = ledger.arrivals(lake, table, PIPELINE)
        newest = max((m for m in (batch.newest, last) if m is not None), default=None)
        return batch.rows, newest if batch.row_count else None, batch
    stored = lake.read(table, arrived_after=watermark_bound(last, overlap))
    rows = after_watermark(stored, WATERMARK, last, overlap)
    count, newest = batch_extent(rows)
    return rows, newest if count else None, None


def _short(table: str) -> str:
    return table.partition(".")[2]


def consumes_by_ledger(lake: Store, consume: str | None) -> bool:
    if consume not in (None, "ledger", "watermark"):
        raise ValueError(f"unknown way to consume: {consume}")
    if consume == "ledger" and not ledger.holds_files(lake):
        raise ValueError("only tables of plain files have a ledger of files")
    return consume == "ledger" or (consume is None and ledger.holds_files(lake))


def build_silver(
    lake: Store,
    mode: str = "merge",
    trades: bool = True,
    klines: bool = True,
    overlap_seconds: int = OVERLAP_SECONDS,
    newer_than: Sequence[str] = NEWEST,
    updated_at: datetime | None = None,
    consume: str | None = None,
) -> dict[str, str]:
    """Build the silver tables; returns what happened to each output.

    ``merge`` reads of each source what it has not consumed and merges by key; ``overwrite`` rebuilds. ``consume`` tells
    what that is: ``"ledger"`` (the default where tables are plain files) finds every arrival, however old its arrival
    time; ``"watermark"`` takes rows that arrived after the stored watermark less ``overlap_seconds`` and loses older ones.
    Watermarks are kept in both cases. Watermark and ledger are saved after the data: a crash in between repeats the batch,
    which the keyed merge absorbs. A late, older delivery does not replace a newer stored row, so the result equals
    one full build; ``newer_than=()`` lets the arriving batch win instead.
    """
    if not trades and not klines:
        raise ValueError("at least one of trades and klines must be built")
    incremental = mode == "merge"
    by_ledger = consumes_by_ledger(lake, consume) and incremental
    overlap = None if by_ledger else overlap_seconds
    read: list[ledger.Arrivals | None] = []
    since = last_watermarks(lake, PIPELINE) if incremental else {}
    outcome: dict[str, str] = {}
    states: list[State] = []

    def write(table: str, rows: DataFrame) -> str:
        if incremental:
            return lake.upsert(table, rows, newer_than=newer_than)
        return lake.overwrite(table, rows)

    def advance(source: str, target: str, newest: datetime) -> None:
        metadata = {"target_table": _short(target), "write_mode": mode}
        states.append(State(PIPELINE, _short(source), "bronze", "silver", newest, metadata))

    if trades:
        rows, newest, batch = _new_rows(lake, TRADES, since, overlap)
        read.append(batch)
        if newest is None:
            outcome["silver.trades"] = "skipped"
        else:
            outcome["silver.trades"] = write("silver.trades", silver_trades(rows))
            advance(TRADES, "silver.trades", newest)
    if klines:
        history, history_newest, batch = _new_rows(lake, HISTORY, since, overlap)
        live, live_newest, live_batch = _new_rows(lake, LIVE, since, overlap)
        read += [batch, live_batch]
        if history_newest is None and live_newest is None:
            outcome["silver.klines_1m"] = "skipped"
        else:
            outcome["silver.klines_1m"] = write("silver.klines_1m", silver_klines(union_klines(history, live)))
            for source, newest in ((HISTORY, history_newest), (LIVE, live_newest)):
                if newest is not None:
                    advance(source, "silver.klines_1m", newest)
    if by_ledger and any(batch.row_count for batch in read):
        ledger.consume(lake, PIPELINE, read, updated_at)
    if incremental:
        outcome["audit.processing_state"] = save_state(lake, states, updated_at)
    return outcome

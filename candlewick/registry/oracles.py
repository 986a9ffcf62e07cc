"""The same results as plain SQL over the driver tables, for comparison.

Each entry names the shared subqueries it needs; ``_with`` puts them in front in order.
"""

from __future__ import annotations

from candlewick.operators.quality_rules import RULE_OF, Rule
from candlewick.registry.served import DASHBOARD, DOUBLES, SECTIONS, SERVED, TIMES
from candlewick.schemas import SERVING_DATASETS, TABLES

AS_OF = "TIMESTAMP '2024-01-30 18:00:00'"
ARRIVED = "TIMESTAMP '2024-02-01 00:00:00'"
HALFWAY = "TIMESTAMP '2024-01-16 00:00:00'"

# Shared subqueries, in dependency order.
PARTS = {
    "feed": """
        SELECT upper(event_type) || '-' || CAST(user_id % 8 AS VARCHAR) AS symbol, event_id AS trade_id,
               value AS price, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS quantity,
               ts AS trade_time, event_type AS source
        FROM events""",
    "trades": """
        SELECT *, trade_time AS event_time, trade_time AS ingested_at, round(price * quantity, 8) AS notional
        FROM feed""",
    "bronze": """
        SELECT symbol, trade_id, CASE WHEN quantity NOT IN (14, 99) THEN price END AS price, quantity, trade_time,
               trade_time AS event_time, trade_time AS ingested_at, source
        FROM feed
        UNION ALL
        SELECT symbol, trade_id, price + 1, quantity, trade_time, trade_time + INTERVAL 1 SECOND,
               trade_time + INTERVAL 60 SECOND, source
        FROM feed WHERE quantity < 15""",
    "usable": "SELECT *, round(price * quantity, 8) AS notional FROM bronze WHERE price IS NOT NULL",
    "silver": """
        SELECT symbol, trade_id, price, quantity, trade_time, event_time, ingested_at, source, notional
        FROM (SELECT *, row_number() OVER (PARTITION BY symbol, trade_id
                                           ORDER BY event_time DESC, ingested_at DESC) AS place FROM usable)
        WHERE place = 1""",
    "candles": """
        SELECT symbol, '1h' AS "interval", date_trunc('hour', trade_time) AS open_time,
               date_trunc('hour', trade_time) + INTERVAL 3599 SECOND AS close_time,
               arg_min(price, row(trade_time, trade_id)) AS "open", max(price) AS high, min(price) AS low,
               arg_max(price, row(trade_time, trade_id)) AS "close", sum(quantity) AS volume,
               CAST(count(*) AS INTEGER) AS trade_count, true AS is_closed,
               date_trunc('hour', trade_time) + INTERVAL 3599 SECOND AS event_time,
               date_trunc('hour', trade_time) + INTERVAL 3659 SECOND AS ingested_at,
               'binance_history' AS source
        FROM feed GROUP BY symbol, date_trunc('hour', trade_time)""",
    "live_candles": """
        SELECT symbol, "interval", open_time, close_time, "open", high, low, "open" AS "close", volume, trade_count,
               false AS is_closed, open_time + INTERVAL 30 MINUTE AS event_time,
               open_time + INTERVAL 30 MINUTE AS ingested_at, 'binance_live' AS source
        FROM candles WHERE split_part(symbol, '-', 1) IN ('PURCHASE', 'VIEW')
        UNION ALL
        SELECT symbol, "interval", open_time, close_time, "open", high, low, "close" + 0.01::DOUBLE, volume,
               trade_count, true, close_time + INTERVAL 1 SECOND, close_time + INTERVAL 61 SECOND, 'binance_live'
        FROM candles WHERE split_part(symbol, '-', 1) IN ('PURCHASE', 'VIEW')""",
    "silver_candles": """
        SELECT * EXCLUDE (place)
        FROM (SELECT *, row_number() OVER (PARTITION BY symbol, "interval", open_time
                                           ORDER BY event_time DESC, ingested_at DESC) AS place
              FROM (SELECT * FROM candles UNION ALL BY NAME SELECT * FROM live_candles) WHERE is_closed)
        WHERE place = 1""",
    "latest": """
        SELECT symbol, arg_max(price, row(trade_time, event_time, ingested_at, trade_id)) AS latest_price,
               max(trade_time) AS trade_time,
               arg_max(source, row(trade_time, event_time, ingested_at, trade_id)) AS source
        FROM trades GROUP BY symbol""",
    "volume": """
        SELECT symbol, date_trunc('minute', trade_time) AS window_start, round(sum(quantity), 8) AS volume_1m,
               round(sum(notional), 8) AS notional_1m, CAST(count(*) AS INTEGER) AS trade_count
        FROM trades GROUP BY symbol, date_trunc('minute', trade_time)""",
    "body": """
        SELECT *, '"s":"' || symbol || '","t":' || trade_id AS ids, CAST(epoch_us(trade_time) // 1000 AS VARCHAR) AS ms,
               CAST(price AS VARCHAR) AS price_text, CAST(quantity AS VARCHAR) AS quantity_text
        FROM feed""",
    "texts": """
        SELECT *, '{"e":"trade","E":' || ms || ',' || ids || ',"p":"' || price_text || '","q":"' || quantity_text
                  || '","T":' || ms || ',"m":false}' AS whole,
               '{"e":"trade","E":' || ms || ',' || ids || ',"q":"' || quantity_text
                  || '","T":' || ms || ',"m":false}' AS unpriced
        FROM body""",
    "messages": """
        SELECT *,
               CASE WHEN source = 'error' AND quantity = 50 THEN substr(whole, 1, 20)
                    WHEN source = 'error' AND quantity = 51 THEN unpriced
                    WHEN source = 'error' AND quantity = 52 THEN '[' || whole || ']'
                    WHEN source = 'error' AND quantity = 53 THEN 'connection lost'
                    WHEN source IN ('view', 'click') THEN '{"stream":"' || symbol || '@trade","data":' || whole || '}'
                    ELSE whole END AS raw_payload,
               source = 'error' AND quantity IN (50, 51, 52, 53) AS broken
        FROM texts""",
    "parsed": """
        SELECT symbol, trade_id, price_text AS price, quantity_text AS quantity,
               date_trunc('second', trade_time) AS trade_time
        FROM messages WHERE NOT broken""",
}


def _volatility(relation: str, in_window: bool = False, by: str = "symbol") -> str:
    frame = f"(PARTITION BY {by} ORDER BY open_time ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"
    inner = frame if not in_window else f"(PARTITION BY {by} ORDER BY open_time ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)"
    return f"""
        SELECT symbol, window_start, window_end, "interval", observation_count, volatility_5m
        FROM (SELECT symbol, "interval", first_value(open_time) OVER {frame} AS window_start,
                     close_time AS window_end, CAST(count(*) OVER {frame} AS INTEGER) AS observation_count,
                     count(ret) OVER {inner} AS returns, round(stddev_pop(ret) OVER {inner}, 8) AS volatility_5m
              FROM (SELECT *, CASE WHEN previous <> 0 THEN "close" / previous - 1 END AS ret
                    FROM (SELECT *, lag("close") OVER (PARTITION BY {by} ORDER BY open_time) AS previous
                          FROM {relation})))
        WHERE observation_count = 5 AND returns > 0"""


def _moves(relation: str) -> str:
    return f"""
        SELECT *, round(CASE WHEN start_price = 0 THEN 0
                             ELSE (end_price - start_price) / start_price * 100 END, 8) AS move_pct
        FROM (SELECT symbol, min(open_time) AS window_start, max(close_time) AS window_end,
                     arg_min("close", open_time) AS start_price, arg_max("close", open_time) AS end_price
              FROM {relation} GROUP BY symbol)"""


PARTS["volatility"] = _volatility("candles")
PARTS["moves"] = _moves("candles")
PARTS["movers"] = "SELECT * FROM moves ORDER BY abs(move_pct) DESC, symbol LIMIT 10"
PARTS["silver_volatility"] = _volatility("silver_candles")
PARTS["silver_movers"] = f"SELECT * FROM ({_moves('silver_candles')}) ORDER BY abs(move_pct) DESC, symbol LIMIT 10"
PARTS["direct_volatility"] = _volatility("silver_candles", in_window=True)


# -- quality verdicts -----------------------------------------------------------------------------


def _verdict(rule: Rule, relation: str, as_of: str, moment: str | None = None, absent: tuple[str, ...] = ()) -> str:
    """One rule's verdict in SQL; with ``moment``, one per day of that timestamp."""
    name, day = rule.dataset, f"CAST({moment} AS DATE)" if moment else "1"
    if moment:
        as_of = "CAST(run_day + INTERVAL 1 DAY AS TIMESTAMP)"
    cell = {c: f'"{c}"' for c in (*rule.null_ratios, *rule.bounded)}
    have = lambda c: c not in absent
    sums = [f'count(*) FILTER ({cell[c]} IS NULL) AS null_{c}' for c in rule.null_ratios if have(c)]
    sums += [f"min({cell[c]}) AS low_{c}, max({cell[c]}) AS high_{c}" for c in rule.bounded if have(c)]
    if rule.freshness and have(rule.freshness[0]):
        sums.append(f'max("{rule.freshness[0]}") AS newest')
    keys = ", ".join(f'"{k}"' for k in rule.keys)
    where = f"WHERE {rule.duplicates_where}" if rule.duplicates_where else ""
    duplicates = (
        f"SELECT run_day, sum(n - 1) AS extra FROM (SELECT {day} AS run_day, count(*) AS n FROM {relation} {where} "
        f"GROUP BY {day}, {keys}) GROUP BY run_day"
        if keys
        else "SELECT CAST(NULL AS INTEGER) AS run_day, 0 AS extra WHERE false"
    )
    missing = sorted(c for c in rule.required if not have(c))
    said, nulls, bounds, fresh = [], [], [], "true"
    said.append(
        f"CASE WHEN row_count < {rule.min_rows} THEN "
        f"printf('[{name}] row_count %d is below minimum {rule.min_rows}', row_count) END"
    )
    if missing:
        said.append(f"'[{name}] missing required columns: {', '.join(missing)}'")
    for c, limit in rule.null_ratios.items():
        if not have(c):
            nulls.append("false")
            said.append(f"'[{name}] null check for {c} failed: column is missing'")
            continue
        nulls.append(f"null_{c} / row_count <= {limit}")
        said.append(
            f"CASE WHEN null_{c} / row_count > {limit} THEN "
            f"printf('[{name}] null ratio for {c} %.6f exceeds max {limit:.6f}', null_{c} / row_count) END"
        )
    unique = f"coalesce(extra, 0) <= {rule.max_duplicates}" if keys else "true"
    if keys:
        said.append(
            f"CASE WHEN NOT ({unique}) THEN printf('[{name}] duplicate_count %d exceeds max {rule.max_duplicates} "
            f"for keys [{', '.join(rule.keys)}]', CAST(extra AS BIGINT)) END"
        )
    if rule.freshness:
        c, limit = rule.freshness
        if not have(c):
            fresh = "false"
            said.append(f"'[{name}] freshness check failed: column is missing'")
        else:
            age = f"greatest((epoch_us({as_of}) - epoch_us(newest)) / 1000000.0, 0)"
            fresh = f"{age} <= {limit}"
            said.append(
                f"CASE WHEN NOT ({fresh}) THEN printf('[{name}] freshness age %.2fs exceeds max {limit}s "
                f"for column {c}', {age}) END"
            )
    for c in rule.bounded:
        if not have(c):
            bounds.append("false")
            said.append(f"'[{name}] bounds check for {c} failed: column is missing'")
            continue
        low = rule.minimum[c]
        bounds.append(f"low_{c} >= {low}")
        said.append(
            f"CASE WHEN low_{c} < {low} THEN "
            f"printf('[{name}] observed minimum for {c} %.8f is below allowed {low:.8f}', low_{c}) END"
        )
    both = lambda flags: " AND ".join(flags) or "true"
    measured = [("null_ratio", c, f"null_{c} / row_count") for c in rule.null_ratios if have(c)]
    measured += [(f"observed_{end}", c, f"{short}_{c}") for c in rule.bounded if have(c) for end, short in (("min", "low"), ("max", "high"))]
    measured += [("duplicate_count", "", "coalesce(extra, 0)")] if keys else []
    if rule.freshness and have(rule.freshness[0]):
        measured.append(("age_seconds", rule.freshness[0], f"greatest((epoch_us({as_of}) - epoch_us(newest)) / 1000000.0, 0)"))
    values = ", ".join(f"{{'measure': '{m}', 'column_name': '{c}', 'value': CAST({v} AS DOUBLE)}}" for m, c, v in measured)
    return f"""
        SELECT run_day, '{name}' AS dataset_name, '{name.partition('_')[0]}' AS layer, len(said) = 0 AS passed,
               row_count, CAST({rule.min_rows} AS BIGINT) AS min_row_count, said, {not missing} AS schema_passed,
               {both(nulls)} AS null_checks_passed, {unique} AS duplicate_check_passed,
               {fresh} AS freshness_check_passed, {both(bounds)} AS bounds_check_passed, [{values}] AS measured
        FROM (SELECT *, list_filter([{', '.join(said)}], lambda x: x IS NOT NULL) AS said
              FROM (SELECT {day} AS run_day, count(*) AS row_count, {', '.join(sums)}
                    FROM {relation} GROUP BY {day}) m LEFT JOIN ({duplicates}) d USING (run_day))"""


AUDITED = {
    "bronze_trades_live_raw": ("bronze", "event_time"),
    "silver_trades": ("trades", "trade_time"),
    "silver_klines_1m": ("candles", "open_time"),
    "gold_volume_1m": ("volume", "window_start"),
}
PARTS["runs"] = " UNION ALL ".join(
    _verdict(RULE_OF[name], relation, "", moment) for name, (relation, moment) in AUDITED.items()
)
PARTS["audit"] = """
        SELECT 'run-' || strftime(run_day, '%Y%m%d') AS audit_run_id,
               CAST(run_day + INTERVAL 1 DAY AS TIMESTAMP) AS checked_at, 'test' AS environment,
               'data_quality_checks' AS job_name, 'quality' AS task_name, dataset_name, layer,
               substr(dataset_name, length(layer) + 2) AS table_name, passed, row_count, min_row_count,
               CAST(len(said) AS INTEGER) AS violation_count,
               CASE WHEN len(said) = 0 THEN '[]' ELSE '["' || array_to_string(said, '", "') || '"]' END
                   AS violations_json,
               schema_passed, null_checks_passed, duplicate_check_passed, freshness_check_passed, bounds_check_passed
        FROM runs"""
PARTS["last_run"] = """
        SELECT * FROM audit
        WHERE audit_run_id = (SELECT audit_run_id FROM audit ORDER BY checked_at DESC, audit_run_id DESC LIMIT 1)"""
PARTS["state"] = f"""
        SELECT 'warehouse_first_publish:silver_trades' AS state_key, 'warehouse_first_publish' AS pipeline_name,
               'silver_trades' AS dataset_name, 'live_source' AS source_layer, 'gold' AS target_layer,
               'ingested_at' AS watermark_column, max(ingested_at) AS last_processed_at, {AS_OF} AS updated_at,
               '{{"dataset":"gold_latest_price,gold_volume_1m"}}' AS metadata_json
        FROM trades
        UNION ALL
        SELECT 'warehouse_first_publish:silver_klines_1m', 'warehouse_first_publish', 'silver_klines_1m',
               'history_live_source', 'gold', 'ingested_at', max(ingested_at), {AS_OF},
               '{{"dataset":"gold_volatility_5m,gold_top_movers"}}'
        FROM candles"""
_MINUTES = f"round((epoch({ARRIVED}) - floor(epoch(latest_timestamp))) / 60.0, 2)"
PARTS["overview"] = f"""
        SELECT *, {_MINUTES} AS age_minutes FROM (
            SELECT 'gold_latest_price' AS dataset_name, 'gold' AS layer, count(*) AS row_count,
                   CAST(count(DISTINCT symbol) AS INTEGER) AS distinct_symbol_count,
                   max(trade_time) AS latest_timestamp, 'trade_time' AS timestamp_column FROM latest
            UNION ALL SELECT 'gold_volume_1m', 'gold', count(*), count(DISTINCT symbol), max(window_start),
                   'window_start' FROM volume
            UNION ALL SELECT 'gold_volatility_5m', 'gold', count(*), count(DISTINCT symbol), max(window_end),
                   'window_end' FROM volatility
            UNION ALL SELECT 'gold_top_movers', 'gold', count(*), count(DISTINCT symbol), max(window_end),
                   'window_end' FROM movers
            UNION ALL SELECT 'audit_quality_check_runs', 'audit', count(*), NULL, max(checked_at), 'checked_at' FROM audit
            UNION ALL SELECT 'audit_processing_state', 'audit', count(*), NULL, max(updated_at), 'updated_at' FROM state)"""


def _with(parts: str, select: str) -> str:
    wanted = set(parts.split())
    unknown = wanted - PARTS.keys()
    if unknown:
        raise KeyError(unknown)
    # DuckDB computes only the subqueries that are used, so give all up to the last one needed.
    names = list(PARTS)
    last = max((names.index(w) for w in wanted), default=-1)
    ctes = ",\n".join(f"{n} AS ({PARTS[n]})" for n in names[: last + 1])
    return f"WITH {ctes}\n{select}"


KLINE = 'symbol, "interval", open_time, close_time, "open", high, low, "close", volume, trade_count'
SILVER_KLINE = f"{KLINE}, is_closed, event_time, ingested_at, source"
SILVER_TRADE = "symbol, trade_id, price, quantity, trade_time, event_time, ingested_at, source, notional"
VERDICT = (
    "dataset_name, layer, passed, row_count, min_row_count, schema_passed, null_checks_passed, "
    "duplicate_check_passed, freshness_check_passed, bounds_check_passed"
)
AUDIT = (
    "audit_run_id, checked_at, environment, job_name, task_name, dataset_name, layer, table_name, passed, "
    "row_count, min_row_count, violation_count, violations_json, schema_passed, null_checks_passed, "
    "duplicate_check_passed, freshness_check_passed, bounds_check_passed"
)
KLINE_TEXT = (
    'symbol, "interval", open_time, close_time, CAST("open" AS VARCHAR) AS "open", CAST(high AS VARCHAR) AS high, '
    'CAST(low AS VARCHAR) AS low, CAST("close" AS VARCHAR) AS "close", CAST(volume AS VARCHAR) AS volume, trade_count'
)
SHORT = "NOT (trade_count = 1 AND volume = 50)"
PARSED_TRADE = f"""SELECT 'binance_live' AS source, 'trade' AS event_type, symbol, trade_id, price, quantity, trade_time,
    trade_time AS event_time, false AS is_market_maker, {ARRIVED} AS ingested_at FROM parsed"""
ALL_VERDICTS = {
    "bronze_trades_live_raw": "bronze", "bronze_klines_history_raw": "candles",
    "bronze_klines_live_raw": "live_candles", "silver_trades": "trades", "silver_klines_1m": "candles",
    "gold_latest_price": "latest", "gold_volume_1m": "volume", "gold_volatility_5m": "volatility",
    "gold_top_movers": "movers",
}
UPSERTED = """SELECT {columns} FROM (
    SELECT *, row_number() OVER (PARTITION BY symbol, trade_id ORDER BY {order}) AS place
    FROM (SELECT *, event_time > trade_time AS again FROM usable)) WHERE place = 1"""


def _measures(latest: str, volume: str, volatility: str, movers: str, label: str, separator: str) -> str:
    rows = (
        ("latest_price", "trade_time", "latest_price", latest),
        ("volume_1m", "window_start", "notional_1m", volume),
        ("volatility_5m", "window_start", "volatility_5m", volatility),
        ("top_movers", "window_start", "move_pct", movers),
    )
    return " UNION ALL ".join(
        f"SELECT 'gold{separator}{name}' AS {label}, symbol, {moment} AS moment, {value} AS value FROM ({relation})"
        for name, moment, value, relation in rows
    )


_SILVER_LATEST = """SELECT symbol, arg_max(price, row(trade_time, event_time, ingested_at, trade_id)) AS latest_price,
    max(trade_time) AS trade_time, arg_max(source, row(trade_time, event_time, ingested_at, trade_id)) AS source
    FROM silver GROUP BY symbol"""
_FIRST_LATEST = """SELECT symbol, arg_max(price, row(trade_time, -trade_id)) AS latest_price,
    max(trade_time) AS trade_time, arg_max(source, row(trade_time, -trade_id)) AS source FROM silver GROUP BY symbol"""
_SILVER_VOLUME = """SELECT symbol, date_trunc('minute', trade_time) AS window_start, round(sum(quantity), 8) AS volume_1m,
    round(sum(notional), 8) AS notional_1m, CAST(count(*) AS INTEGER) AS trade_count
    FROM silver GROUP BY symbol, date_trunc('minute', trade_time)"""
_METADATA = {
    "silver_trades": '{"target_table": "trades", "write_mode": "merge"}',
    "silver_klines": '{"target_table": "klines_1m", "write_mode": "merge"}',
    "gold_trades": '{"targets": ["latest_price", "volume_1m"], "write_mode": "merge"}',
    "gold_klines": '{"targets": ["volatility_5m", "top_movers"], "write_mode": "merge"}',
}


def _state_row(pipeline: str, dataset: str, source: str, target: str, relation: str, updated: str, metadata: str) -> str:
    return f"""SELECT '{pipeline}:{dataset}' AS state_key, '{pipeline}' AS pipeline_name, '{dataset}' AS dataset_name,
        '{source}' AS source_layer, '{target}' AS target_layer, 'ingested_at' AS watermark_column,
        (SELECT max(ingested_at) FROM {relation}) AS last_processed_at, {updated} AS updated_at,
        '{metadata}' AS metadata_json"""


def _silver_state(updated: str) -> str:
    rows = (
        ("trades_live_raw", "bronze", _METADATA["silver_trades"]),
        ("klines_history_raw", "candles", _METADATA["silver_klines"]),
        ("klines_live_raw", "live_candles", _METADATA["silver_klines"]),
    )
    return " UNION ALL ".join(
        _state_row("transform_silver", d, "bronze", "silver", relation, updated, m) for d, relation, m in rows
    )


def _gold_state(updated: str) -> str:
    return " UNION ALL ".join(
        _state_row("build_gold_metrics", d, "silver", "gold", relation, updated, m)
        for d, relation, m in (
            ("trades", "silver", _METADATA["gold_trades"]),
            ("klines_1m", "silver_candles", _METADATA["gold_klines"]),
        )
    )


def _served(dataset: str, relation: str) -> str:
    """Rows of a served dataset as text, as the query shows them."""
    kinds = dict(TABLES[SERVING_DATASETS[dataset]].fields)

    def shown(column: str) -> str:
        forms = {"timestamp": f"epoch_us({column})", "double": f"CAST(round({column} * 1000000) AS BIGINT)"}
        return f"coalesce(CAST({forms.get(kinds[column], column)} AS VARCHAR), '-')"

    quoted = lambda columns: " || '|' || ".join(shown(c).replace("interval", '"interval"') for c in columns)
    keys, values = SERVED[dataset]
    return f"SELECT '{dataset}' AS dataset_name, {quoted(keys)} AS key, {quoted(values)} AS row FROM {relation}"


def _section(name: str, columns: str, relation: str) -> str:
    """Rows of a report section as text, as the query shows them."""

    def shown(column: str) -> str:
        quoted = f'"{column}"'
        form = f"epoch_us({quoted})" if column in TIMES else f"CAST(round({quoted} * 1000000) AS BIGINT)" if column in DOUBLES else quoted
        return f"coalesce(CAST({form} AS VARCHAR), '-')"

    return f"SELECT '{name}' AS section, {' || '.join(shown(c) if i == 0 else f"'|' || {shown(c)}" for i, c in enumerate(columns.split()))} AS row FROM ({relation})"


def _kpis(shown: str = "latest") -> str:
    return f"""SELECT (SELECT count(*) FROM overview) AS available_dataset_count,
                (SELECT max(age_minutes) FROM overview) AS worst_dataset_age_minutes,
                (SELECT dataset_name FROM overview ORDER BY latest_timestamp DESC, dataset_name DESC LIMIT 1)
                    AS freshest_dataset,
                (SELECT count(DISTINCT symbol) FROM {shown}) AS latest_price_symbol_count,
                (SELECT max(trade_time) FROM {shown}) AS latest_trade_time,
                (SELECT count(*) FROM last_run WHERE NOT passed) AS failed_quality_dataset_count,
                (SELECT count(*) FROM state WHERE (epoch({ARRIVED}) - epoch(updated_at)) / 60.0 > 20)
                    AS stale_watermark_count"""


_RUNS = """SELECT audit_run_id, checked_at, environment, job_name, task_name, CAST(count(*) AS INTEGER) AS dataset_count,
    CAST(count(*) FILTER (NOT passed) AS INTEGER) AS failed_dataset_count,
    CAST(sum(violation_count) AS INTEGER) AS violation_count FROM audit GROUP BY ALL"""
_STATE_AGE = f"SELECT *, round((epoch({ARRIVED}) - floor(epoch(updated_at))) / 60.0, 2) AS staleness_minutes FROM state"
_CHOSEN = "symbol IN ('VIEW-1', 'PURCHASE-3', 'ERROR-7')"


def oracle_sql() -> dict[str, str]:
    history = f"""SELECT 'binance_history' AS source, 'kline_history' AS event_type, {KLINE_TEXT}, true AS is_closed,
        close_time AS event_time, {ARRIVED} AS ingested_at FROM candles"""
    verdicts = " UNION ALL ".join(
        _verdict(RULE_OF[name], relation, ARRIVED) for name, relation in ALL_VERDICTS.items()
    )
    counts = " UNION ALL ".join(
        f"SELECT '{name}' AS dataset_name, count(*) AS row_count, count(*) >= 1 AS passed FROM {relation}"
        for name, relation in ALL_VERDICTS.items()
    )
    direct_rows = {
        "latest_price": "(SELECT DISTINCT symbol FROM silver)", "volume_1m": f"({_SILVER_VOLUME})",
        "volatility_5m": "direct_volatility", "top_movers": "silver_movers",
    }
    direct_quality = " UNION ALL ".join(
        f"""SELECT 'warehouse_direct_20240130T180000' AS audit_run_id, {AS_OF} AS checked_at, 'test' AS environment,
            'warehouse_first_publish' AS job_name, 'publish_app_serving_layer' AS task_name,
            'gold_{name}' AS dataset_name, 'gold' AS layer, 'gold.{name}' AS table_name, count(*) > 0 AS passed,
            count(*) AS row_count, CAST(1 AS BIGINT) AS min_row_count,
            CASE WHEN count(*) > 0 THEN 0 ELSE 1 END AS violation_count,
            CASE WHEN count(*) > 0 THEN '[]' ELSE '["dataset produced zero rows"]' END AS violations_json,
            count(*) > 0 AS schema_passed, count(*) > 0 AS null_checks_passed, count(*) > 0 AS duplicate_check_passed,
            count(*) > 0 AS freshness_check_passed, count(*) > 0 AS bounds_check_passed FROM {relation}"""
        for name, relation in direct_rows.items()
    )
    recent_24 = f"SELECT * FROM volume WHERE window_start >= {AS_OF} - INTERVAL 24 HOUR"
    served = {
        "gold_latest_price": ("latest", "current_snapshot"),
        "gold_volume_1m": (f"({recent_24})", "recent_24h"),
        "gold_volatility_5m": (
            "(SELECT * FROM volatility QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY window_end DESC, window_start DESC) = 1)",
            "latest_per_symbol",
        ),
        "gold_top_movers": ("movers", "current_snapshot"),
        "audit_quality_check_runs": ("last_run", "latest_audit_run"),
        "audit_processing_state": ("state", "full_state"),
    }
    common = {"freshness": "SELECT * FROM overview", "quality_status": "SELECT * FROM last_run", "processing_state": _STATE_AGE, "quality_runs": _RUNS}
    report = common | {
        "latest_prices": "SELECT * FROM latest", "volume": "SELECT * FROM volume", "volatility": "SELECT * FROM volatility",
        "top_movers": "SELECT * FROM movers",
    }
    newest_windows = f"SELECT * FROM volatility WHERE {_CHOSEN} QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY window_end DESC, window_start DESC) = 1"
    board = common | {
        "kpis": _kpis(f"(SELECT * FROM latest WHERE {_CHOSEN})"), "latest_prices": f"SELECT * FROM latest WHERE {_CHOSEN}",
        "volume_trend": f"SELECT * FROM volume WHERE {_CHOSEN} AND window_start >= {ARRIVED} - INTERVAL 72 HOUR",
        "latest_volatility": f"SELECT * FROM ({newest_windows}) ORDER BY volatility_5m DESC NULLS LAST, symbol LIMIT 5",
        "top_movers": f"SELECT * FROM movers WHERE {_CHOSEN} ORDER BY abs(move_pct) DESC, symbol LIMIT 5",
    }
    gated = {
        "bronze_trades_live_raw": "bronze", "bronze_klines_history_raw": "candles",
        "bronze_klines_live_raw": "live_candles", "silver_trades": "silver", "silver_klines_1m": "silver_candles",
    }
    gate = " UNION ALL ".join(
        f"SELECT 'gated' AS audit_run_id, {VERDICT}, CAST(len(said) AS INTEGER) AS violation_count "
        f"FROM ({_verdict(RULE_OF[name], relation, ARRIVED)})"
        for name, relation in gated.items()
    )
    # Gold was not built: each of its datasets fails for being unreadable and for having no rows.
    for name in ("latest_price", "volume_1m", "volatility_5m", "top_movers"):
        gate += f" UNION ALL SELECT 'gated', 'gold_{name}', 'gold', false, 0, 1, true, true, true, true, true, 2"
    stored = {"silver.trades": "trades", "silver.klines_1m": "candles", "gold.volume_1m": "volume", "gold.top_movers": "movers"}
    schema_rows = " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, {place} AS "position", '{column}' AS column_name, '{kind}' AS data_type,
            {column in TABLES[name].keys} AS is_key, (SELECT count(*) FROM {relation}) AS row_count"""
        for name, relation in stored.items()
        for place, (column, kind) in enumerate(TABLES[name].fields)
    )
    two_widths = """(SELECT * FROM candles UNION ALL
        SELECT * REPLACE ('12h' AS "interval") FROM candles WHERE hour(open_time) < 12)"""
    shifted = """(SELECT symbol, "interval", open_time, close_time, round("open" - 20, 6) AS "open",
        round(high - 20, 6) AS high, round(low - 20, 6) AS low, round("close" - 20, 6) AS "close", volume FROM candles)"""
    return {
        # sources
        "history_scan": _with("candles", f"{history} WHERE {SHORT}"),
        "history_quarantine": _with(
            "candles",
            f"""SELECT CASE WHEN {SHORT} THEN 'usable' ELSE 'candle with fewer than 11 cells' END AS reason,
                count(*) AS elements FROM candles GROUP BY 1
                UNION ALL SELECT 'no readable list of candles', 2 * count(DISTINCT (symbol, CAST(open_time AS DATE))) FROM candles""",
        ),
        "rest_quarantine": _with(
            "body",
            """SELECT 'usable' AS reason, count(*) AS elements FROM body
               UNION ALL SELECT 'not a JSON list', 2 * count(DISTINCT (symbol, trade_id // 500)) FROM body""",
        ),
        "document_quarantine": _with(
            "body",
            """SELECT 'usable' AS reason, count(*) AS elements FROM body
               UNION ALL SELECT 'unsupported payload', 2 * count(DISTINCT trade_id // 500) FROM body""",
        ),
        "rest_candles_scan": _with(
            "candles", history.replace("'binance_history' AS source", "'binance_rest' AS source")
        ),
        "rest_trades_scan": _with(
            "body",
            f"""SELECT 'binance_rest' AS source, 'trade' AS event_type, symbol, trade_id, price_text AS price,
                quantity_text AS quantity, date_trunc('second', trade_time) AS trade_time,
                date_trunc('second', trade_time) AS event_time, source = 'error' AS is_market_maker,
                {ARRIVED} AS ingested_at FROM body""",
        ),
        "live_scan": _with("parsed", PARSED_TRADE),
        # parsing
        "unwrap_payload": _with(
            "messages",
            "SELECT trade_id, CASE WHEN source IN ('view', 'click') THEN whole ELSE raw_payload END AS payload FROM messages",
        ),
        "classify_payload": _with(
            "messages", "SELECT trade_id, CASE WHEN NOT broken THEN 'trade' END AS payload_kind FROM messages"
        ),
        "parse_json_objects": _with(
            "messages",
            "SELECT trade_id, raw_payload FROM messages WHERE NOT broken OR quantity = 51",
        ),
        "parse_trades": _with("parsed", PARSED_TRADE),
        "parse_klines": _with(
            "live_candles",
            f"""SELECT 'binance_live' AS source, 'kline' AS event_type, {KLINE_TEXT}, CAST(NULL AS VARCHAR) AS quote_volume,
                is_closed, event_time, {ARRIVED} AS ingested_at FROM live_candles""",
        ),
        "quarantine_payloads": _with(
            "messages",
            f"""SELECT raw_payload, CAST(NULL AS VARCHAR) AS payload_kind, 'unsupported payload' AS reason,
                {ARRIVED} AS ingested_at FROM messages WHERE broken""",
        ),
        "filter_event_type": _with(
            "live_candles", "SELECT 'kline' AS event_type, symbol, open_time, event_time FROM live_candles"
        ),
        "event_counts": _with(
            "live_candles messages",
            """SELECT 'trade' AS event_type, count(*) AS event_count FROM messages WHERE NOT broken
               UNION ALL SELECT 'kline', count(*) FROM live_candles""",
        ),
        "field_drift": _with(
            "live_candles messages",
            """SELECT 'trade' AS event_type, field, json_type, (SELECT count(*) FROM messages WHERE NOT broken OR quantity = 51) AS messages
               FROM (VALUES ('e', 'text'), ('E', 'number'), ('s', 'text'), ('t', 'number'), ('q', 'text'), ('T', 'number'), ('m', 'boolean')) AS f(field, json_type)
               UNION ALL SELECT 'trade', 'p', 'text', count(*) FROM messages WHERE NOT broken
               UNION ALL SELECT 'kline', field, json_type, (SELECT count(*) FROM live_candles)
               FROM (VALUES ('e', 'text'), ('E', 'number'), ('s', 'text'), ('k', 'object'), ('k.t', 'number'), ('k.T', 'number'), ('k.s', 'text'),
                   ('k.i', 'text'), ('k.o', 'text'), ('k.c', 'text'), ('k.h', 'text'), ('k.l', 'text'), ('k.v', 'text'), ('k.n', 'number'),
                   ('k.x', 'boolean')) AS f(field, json_type)""",
        ),
        # silver
        "silver_trades": _with("silver", "SELECT * FROM silver"),
        "silver_klines": _with("silver_candles", f"SELECT {SILVER_KLINE} FROM silver_candles"),
        "union_klines": _with(
            "live_candles",
            """SELECT source, symbol, open_time, CAST("close" AS VARCHAR) AS "close", trade_count, is_closed, event_time
               FROM candles UNION ALL
               SELECT source, symbol, open_time, CAST("close" AS VARCHAR), NULL, is_closed, event_time FROM live_candles""",
        ),
        "normalize_defaults": _with(
            "bronze",
            """SELECT 'binance' AS source, CAST(NULL AS VARCHAR) AS event_type, symbol, trade_id,
               CAST(price AS VARCHAR) AS price, CAST(quantity AS VARCHAR) AS quantity, trade_time,
               trade_time AS event_time, false AS is_market_maker, trade_time AS ingested_at FROM bronze""",
        ),
        "normalize_kline_defaults": _with(
            "candles",
            f"""SELECT {KLINE_TEXT.replace('trade_count', '0 AS trade_count')}, true AS is_closed,
                close_time AS event_time, close_time AS ingested_at, 'binance' AS source FROM candles""",
        ),
        "tag_source": _with("trades", "SELECT symbol, trade_id, price, 'replay' AS source FROM trades"),
        # filters
        "filter_symbols": _with(
            "trades",
            "SELECT symbol, trade_id, price FROM trades WHERE symbol IN ('VIEW-1', 'PURCHASE-3', 'ERROR-7')",
        ),
        "cast_to_schema": "SELECT event_id AS trade_id, ts AS trade_time, value AS price, CAST(NULL AS DOUBLE) AS quantity FROM events",
        "klines_sanity": _with(
            "candles",
            f"SELECT * FROM {shifted} WHERE \"open\" < 0 OR high < 0 OR low < 0 OR \"close\" < 0 OR volume < 0",
        ),
        "trade_null_counts": _with(
            "bronze",
            """SELECT count(*) FILTER (symbol IS NULL) AS null_symbol_count,
               count(*) FILTER (trade_id IS NULL) AS null_trade_id_count,
               count(*) FILTER (price IS NULL) AS null_price_count,
               count(*) FILTER (quantity IS NULL) AS null_quantity_count,
               count(*) FILTER (trade_time IS NULL) AS null_trade_time_count FROM bronze""",
        ),
        "trade_duplicates": _with(
            "bronze",
            "SELECT symbol, trade_id, count(*) AS duplicate_count FROM bronze GROUP BY ALL HAVING count(*) > 1",
        ),
        "max_watermark": _with("bronze", "SELECT max(ingested_at) AS max_timestamp FROM bronze"),
        "watermark_filter": _with(
            "bronze",
            f"""SELECT symbol, trade_id, CAST(price AS VARCHAR) AS price, ingested_at FROM bronze
                WHERE ingested_at > {HALFWAY} - INTERVAL 120 SECOND""",
        ),
        "latest_trade_time": _with(
            "latest", f"SELECT max(trade_time) AS latest_trade_time, {AS_OF} AS checked_at FROM latest"
        ),
        # gold
        "latest_price": _with("latest", "SELECT * FROM latest"),
        "volume_1m": _with("volume", "SELECT * FROM volume"),
        "volatility_5m": _with("volatility", "SELECT * FROM volatility"),
        "volatility_5m_in_window": _with("candles", _volatility("candles", in_window=True)),
        "volatility_5m_by_interval": _with("candles", _volatility(two_widths, by='symbol, "interval"')),
        "top_movers": _with("movers", "SELECT * FROM movers"),
        # incremental
        "silver_build_incremental": _with("silver", "SELECT * FROM silver"),
        "silver_klines_incremental": _with("silver_candles", f"SELECT {SILVER_KLINE} FROM silver_candles"),
        "gold_build": _with(
            "silver silver_volatility silver_movers",
            _measures(
                _SILVER_LATEST, _SILVER_VOLUME, "SELECT * FROM silver_volatility", "SELECT * FROM silver_movers",
                "table_name", ".",
            ),
        ),
        "latest_price_incremental": _with("silver", _SILVER_LATEST),
        "volume_1m_incremental": _with("volume", "SELECT * FROM volume"),
        "volatility_incremental": _with("volatility", "SELECT * FROM volatility"),
        "top_movers_incremental": _with("movers", "SELECT * FROM movers"),
        # storage
        "table_schemas": _with("movers volume", schema_rows),
        "write_dataset": _with("trades", "SELECT symbol, trade_id, price, trade_time FROM trades"),
        "read_optional": _with("volume", "SELECT * FROM volume"),
        "upsert": _with("usable", UPSERTED.format(columns=SILVER_TRADE, order="again DESC")),
        "upsert_last_batch_wins": _with("usable", UPSERTED.format(columns=SILVER_TRADE, order="again")),
        "upsert_newer_than": _with("silver", "SELECT * FROM silver"),
        "upsert_replace": _with("volume", "SELECT * FROM volume WHERE volume_1m >= 50"),
        # quality
        "dq_row_count": _with("movers volatility volume latest live_candles", counts),
        "dq_schema": _with(
            "bronze",
            f"""SELECT {VERDICT}, array_to_string(said, chr(10)) AS violations
                FROM ({_verdict(RULE_OF['bronze_trades_live_raw'], 'bronze', AS_OF, absent=('price', 'event_time'))})""",
        ),
        "dq_null_ratio": _with(
            "bronze",
            """SELECT count(*) AS row_count, count(*) FILTER (price IS NULL) AS null__price,
               count(*) FILTER (price IS NULL) / count(*) AS null_ratio,
               count(*) FILTER (price IS NULL) = 0 AS passed FROM bronze""",
        ),
        "dq_duplicates": _with(
            "bronze",
            """SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_count
               FROM (SELECT count(*) AS n FROM bronze GROUP BY symbol, trade_id)""",
        ),
        "dq_bounds": _with(
            "bronze",
            """SELECT min(price) AS low__price, max(price) AS high__price, min(quantity) AS low__quantity,
               max(quantity) AS high__quantity FROM bronze""",
        ),
        "dq_freshness": _with(
            "trades",
            f"""SELECT 'silver_trades' AS dataset_name,
                round((epoch_us({ARRIVED}) - epoch_us(max(trade_time))) / 1000000.0, 3) AS age_seconds,
                (epoch_us({ARRIVED}) - epoch_us(max(trade_time))) / 1000000.0 <= 900 AS freshness_check_passed
                FROM trades""",
        ),
        "dq_violations": _with(
            "bronze",
            f"""SELECT dataset_name, passed, CAST(n - 1 AS INTEGER) AS "position", said[n] AS violation
                FROM (SELECT dataset_name, passed, said, unnest(generate_series(1, len(said))) AS n
                      FROM ({_verdict(RULE_OF['bronze_trades_live_raw'], 'bronze', ARRIVED)}))""",
        ),
        "dq_run": _with(
            "movers volatility volume latest live_candles",
            f"SELECT {VERDICT}, array_to_string(said, chr(10)) AS violations FROM ({verdicts})",
        ),
        "dq_run_incremental": _with(
            "movers volatility volume latest live_candles",
            f"SELECT {VERDICT}, array_to_string(said, chr(10)) AS violations FROM ({verdicts})",
        ),
        "quality_audit_rows": _with("audit", f"SELECT {AUDIT} FROM audit"),
        "quality_summaries": _with(
            "runs",
            """SELECT 'run-' || strftime(run_day, '%Y%m%d') AS audit_run_id, dataset_name, m.measure, m.column_name, round(m.value, 6) AS value
               FROM (SELECT run_day, dataset_name, unnest(measured) AS m FROM runs) WHERE m.value IS NOT NULL""",
        ),
        "dq_gate": _with("silver_candles silver bronze live_candles", gate),
        # reports
        "latest_prices_report": _with(
            "latest", "SELECT * FROM latest WHERE symbol IN ('VIEW-1', 'PURCHASE-3', 'ERROR-7')"
        ),
        "recent_volume": _with("volume", f"SELECT * FROM volume WHERE window_start >= {AS_OF} - INTERVAL 6 HOUR"),
        "volatility_report": _with(
            "volatility", "SELECT symbol, window_start, window_end, volatility_5m FROM volatility"
        ),
        "latest_volatility": _with(
            "volatility",
            """SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (
               PARTITION BY symbol ORDER BY window_end DESC, window_start DESC) AS place FROM volatility) WHERE place = 1""",
        ),
        "top_movers_report": _with("moves", "SELECT * FROM moves ORDER BY abs(move_pct) DESC, symbol LIMIT 5"),
        "quality_recent_runs": _with("audit", _RUNS),
        "quality_dataset_health": _with(
            "audit",
            """SELECT dataset_name, layer, max(checked_at) AS latest_checked_at, CAST(count(*) AS INTEGER) AS run_count,
               CAST(count(*) FILTER (passed) AS INTEGER) AS successful_runs,
               CAST(count(*) FILTER (NOT passed) AS INTEGER) AS failed_runs,
               CAST(max(violation_count) AS INTEGER) AS max_violation_count,
               round(count(*) FILTER (passed) / count(*), 4) AS pass_rate FROM audit GROUP BY dataset_name, layer""",
        ),
        "quality_latest_status": _with(
            "last_run",
            """SELECT checked_at, dataset_name, layer, table_name, passed, row_count, violation_count, job_name,
               task_name, audit_run_id FROM last_run""",
        ),
        "quality_latest_failures": _with(
            "last_run",
            """SELECT checked_at, dataset_name, layer, table_name, row_count, violation_count, violations_json
               FROM last_run WHERE NOT passed""",
        ),
        "quality_failed_datasets": _with(
            "audit",
            """SELECT checked_at, audit_run_id, environment, job_name, task_name, dataset_name, layer, table_name,
               row_count, violation_count, violations_json FROM audit WHERE NOT passed""",
        ),
        "quality_status_counts": _with(
            "audit",
            """SELECT CASE WHEN passed THEN 'passed' WHEN NOT passed THEN 'failed' ELSE 'unknown' END AS status,
               count(*) AS dataset_count FROM audit GROUP BY ALL""",
        ),
        "processing_state_status": _with(
            "state",
            f"""SELECT pipeline_name, dataset_name, source_layer, target_layer, watermark_column, last_processed_at,
                updated_at, round((epoch({ARRIVED}) - epoch(updated_at)) / 60.0, 2) AS staleness_minutes, metadata_json
                FROM state""",
        ),
        "freshness_overview": _with("overview", "SELECT * FROM overview"),
        "freshness_by_parts": _with("overview", "SELECT * FROM overview WHERE dataset_name = 'gold_volume_1m'"),
        "dashboard_kpis": _with("overview", _kpis()),
        "observability_report": _with("overview", " UNION ALL ".join(_section(n, SECTIONS[n], r) for n, r in report.items())),
        "dashboard_datasets": _with("overview", " UNION ALL ".join(_section(n, DASHBOARD[n], r) for n, r in board.items())),
        # state
        "load_state": _with("silver_candles", _silver_state(AS_OF)),
        "state_rows": _with(
            "bronze",
            f"""SELECT 'transform_silver:trades_live_raw' AS state_key, 'transform_silver' AS pipeline_name,
                'trades_live_raw' AS dataset_name, 'bronze' AS source_layer, 'silver' AS target_layer,
                'ingested_at' AS watermark_column, max(ingested_at) AS last_processed_at, {AS_OF} AS updated_at,
                '{{"row_count": ' || count(*) || ', "write_mode": "merge"}}' AS metadata_json FROM bronze""",
        ),
        "state_upsert": _with("silver_candles", f"{_silver_state(ARRIVED)} UNION ALL {_gold_state(ARRIVED)}"),
        # serving
        "serving_snapshot": _with(
            "latest volume volatility movers last_run state",
            " UNION ALL ".join(f"SELECT *, '{label}' AS selection FROM ({_served(n, r)})" for n, (r, label) in served.items()),
        ),
        "publish_serving": _with(
            "latest volume volatility movers last_run state",
            " UNION ALL ".join(_served(n, r) for n, (r, _) in served.items()),
        ),
        "load_history": _with(
            "candles",
            f"""SELECT 'binance_history' AS source, count(*) AS candles, max(open_time) AS newest FROM candles WHERE {SHORT}
                UNION ALL SELECT 'binance_rest', count(*), max(open_time) FROM candles""",
        ),
        "direct_snapshot": _with(
            "silver direct_volatility silver_movers",
            _measures(
                _FIRST_LATEST, _SILVER_VOLUME, "SELECT * FROM direct_volatility", "SELECT * FROM silver_movers",
                "dataset_name", "_",
            ),
        ),
        "direct_quality": _with("silver direct_volatility silver_movers", direct_quality),
        "direct_state": _with(
            "silver silver_candles",
            f"""SELECT 'warehouse_first_publish:silver_trades' AS state_key, 'warehouse_first_publish' AS pipeline_name,
                'silver_trades' AS dataset_name, 'live_source' AS source_layer, 'gold' AS target_layer,
                'ingested_at' AS watermark_column, (SELECT max(ingested_at) FROM silver) AS last_processed_at,
                {AS_OF} AS updated_at, '{{"dataset":"gold_latest_price,gold_volume_1m"}}' AS metadata_json
                UNION ALL
                SELECT 'warehouse_first_publish:silver_klines_1m', 'warehouse_first_publish', 'silver_klines_1m',
                'history_live_source', 'gold', 'ingested_at', (SELECT max(ingested_at) FROM silver_candles), {AS_OF},
                '{{"dataset":"gold_volatility_5m,gold_top_movers"}}'""",
        ),
        "history_backfill": _with(
            "candles",
            f"""SELECT {KLINE}, is_closed, event_time, {ARRIVED} AS ingested_at, source FROM candles WHERE {SHORT}""",
        ),
        # streams
        "stream_ingest": _with(
            "parsed live_candles messages",
            f"""SELECT 'trades' AS dataset_name, symbol || '|' || trade_id AS key, source || '|' || event_type || '|' || price || '|' || quantity
                    || '|' || epoch_us(trade_time) || '|' || epoch_us(event_time) || '|' || is_market_maker AS row FROM ({PARSED_TRADE})
                UNION ALL SELECT 'klines', symbol || '|' || "interval" || '|' || epoch_us(open_time),
                    'binance_live|kline|' || epoch_us(close_time) || '|' || "open" || '|' || high || '|' || low || '|' || "close" || '|' || volume
                    || '|' || trade_count || '|' || is_closed || '|' || epoch_us(event_time)
                FROM (SELECT {KLINE_TEXT}, is_closed, event_time FROM live_candles)
                UNION ALL SELECT 'quarantine', raw_payload, 'unsupported payload' FROM messages WHERE broken""",
        ),
        "stream_silver": _with("silver", "SELECT * FROM silver"),
        "stream_volume_updates": _with("volume", "SELECT * FROM volume"),
        "stream_late_trades": _with(
            "trades",
            """SELECT count(*) AS trade_rows, count(*) FILTER (trade_time <= bound - INTERVAL 2 MINUTE) AS late_rows
            FROM (
                SELECT trade_time, max(trade_time) OVER (ORDER BY landing RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS bound
                FROM (SELECT trade_time, CAST(trade_time >= TIMESTAMP '2024-01-11' AS INTEGER) + CAST(trade_time >= TIMESTAMP '2024-01-21' AS INTEGER)
                             + CAST(split_part(symbol, '-', 1) IN ('CLICK', 'ERROR') AS INTEGER) AS landing FROM trades))""",
        ),
        "stream_volume_1m": _with(
            "volume",
            """SELECT * FROM volume
               WHERE window_start + INTERVAL 1 MINUTE <= (SELECT max(trade_time) FROM trades) - INTERVAL 2 MINUTE""",
        ),
    }

from __future__ import annotations

import json

from tests.fixtures import ARRIVED, START, START_MS, TRADES, at, history_groups, kline_event, live_messages, raw, trade_event, trade_lines

from candlewick.operators import payloads
from candlewick.sources.history import explode_candles, history_scan, read_history_groups, read_rest_candles, rejected_candles, rest_candles_scan
from candlewick.sources.live import live_scan, read_rest_trades, rejected_rest_trades, rest_trades_scan


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def naive(moment):
    return moment.replace(tzinfo=None)


def test_trade_message_becomes_bronze_row(spark):
    event = trade_event("BTCUSDT", 1001, "65000.00", "0.10", 0, b=5001, a=7001)
    row = one(payloads.parse_trades(raw(spark, [json.dumps(event)]), ingested_at=ARRIVED))
    assert (row.symbol, row.trade_id, row.price, row.quantity) == ("BTCUSDT", 1001, "65000.00", "0.10")
    assert row.trade_time == row.event_time == naive(START)
    assert (row.buyer_order_id, row.seller_order_id, row.is_market_maker) == (5001, 7001, True)
    assert (row.source, row.event_type) == ("binance_live", "trade")
    assert row.ingested_at == naive(ARRIVED)
    assert json.loads(row.raw_payload) == event


def test_optional_trade_fields_have_defaults(spark):
    event = trade_event("A", 1, "1", "2", 7)
    for key in ("E", "e", "m"):
        del event[key]
    row = one(payloads.parse_trades(raw(spark, [json.dumps(event)])))
    assert row.event_time == naive(at(7))
    assert row.event_type == "trade"
    assert row.is_market_maker is False
    assert row.buyer_order_id is None


def test_milliseconds_are_cut_to_the_second(spark):
    row = one(payloads.parse_klines(raw(spark, [json.dumps(kline_event("A", 0, "1", True, 60))])))
    assert row.close_time == naive(at(59))
    assert row.event_time == naive(at(60))
    assert (row.trade_count, row.quote_volume, row.is_closed) == (1200, "8150000.00", True)


def test_optional_kline_fields_have_defaults(spark):
    event = kline_event("OUTER", 0, "1", True, 60)
    event["k"]["s"] = "INNER"
    for key in ("q", "n", "x"):
        del event["k"][key]
    del event["E"]
    row = one(payloads.parse_klines(raw(spark, [json.dumps(event)])))
    assert row.symbol == "INNER"
    assert (row.quote_volume, row.trade_count, row.is_closed) == (None, 0, False)
    assert row.event_time == row.close_time == naive(at(59))


def test_envelope_is_opened_only_around_an_object(spark):
    event = json.dumps(trade_event(*TRADES[0]))
    lines = [f'{{"stream":"x","data":{event}}}', event, json.dumps({"data": event}), json.dumps({"data": 5})]
    opened = [json.loads(r.payload) for r in payloads.unwrap_payload(raw(spark, lines)).collect()]
    assert opened == [json.loads(event), json.loads(event), {"data": event}, {"data": 5}]


def test_unusable_messages_are_quarantined_with_a_reason(spark):
    no_price = trade_event(*TRADES[0])
    del no_price["p"]
    no_open = kline_event("A", 0, "1", True, 60)
    del no_open["k"]["o"], no_open["k"]["v"]
    bad_id = trade_event("A", "x1", "1", "1", 0)
    lines = [json.dumps(no_price), json.dumps(no_open), json.dumps(bad_id), "nonsense", "[1,2]", '{"s":"A"', *trade_lines()]
    parsed = payloads.parse_market(raw(spark, lines))
    reasons = {r.raw_payload: r.reason for r in payloads.quarantine_of(parsed).collect()}
    assert reasons == {
        lines[0]: "unsupported payload",
        lines[1]: "missing kline fields: o, v",
        lines[2]: "missing trade fields: t",
        "nonsense": "unsupported payload",
        "[1,2]": "unsupported payload",
        '{"s":"A"': "unsupported payload",
    }
    assert payloads.trades_of(parsed).count() == 6
    assert payloads.klines_of(parsed).count() == 0


def test_only_json_objects_are_kept(spark):
    lines = ['{"a":1}', "[1]", "5", "nope", '"text"', '{"a":']
    assert [r.raw_payload for r in payloads.parse_json_objects(raw(spark, lines)).collect()] == ['{"a":1}']


def test_live_file_mixes_trades_and_candles(spark, tmp_path):
    (tmp_path / "live.json").write_text(json.dumps(live_messages(), indent=1))
    parsed = live_scan(spark, str(tmp_path), "document", ingested_at=ARRIVED)
    assert payloads.trades_of(parsed).count() == 2
    assert payloads.klines_of(parsed).count() == 3
    first = payloads.trades_of(parsed).orderBy("trade_id").first()
    assert first.buyer_order_id == 5001
    # Structured input is stored compact with sorted keys.
    assert first.raw_payload == json.dumps(live_messages()[0], sort_keys=True, separators=(",", ":"))


def test_live_file_with_a_single_message(spark, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps(live_messages()[0]))
    assert payloads.trades_of(live_scan(spark, str(tmp_path), "document")).count() == 1


def test_history_file_gives_one_row_per_candle(spark, tmp_path):
    (tmp_path / "history.json").write_text(json.dumps(history_groups()))
    rows = history_scan(spark, str(tmp_path), "document", ARRIVED).orderBy("symbol", "open_time").collect()
    assert len(rows) == 11
    first = rows[0]
    assert (first.symbol, first.close, first.trade_count, first.is_closed) == ("BTCUSDT", "65000.00", 1200, True)
    assert first.event_type == "kline_history"
    assert first.event_time == first.close_time == naive(at(59))
    assert json.loads(first.raw_payload) == history_groups()[0]["klines"][0]


def test_history_defaults_and_short_candles(spark, tmp_path):
    good = history_groups()[0]["klines"][0]
    (tmp_path / "h.json").write_text(json.dumps({"symbol": "A", "klines": [good, good[:10], {"o": 1}]}))
    row = one(history_scan(spark, str(tmp_path), "document"))
    assert (row.interval, row.source) == ("1m", "binance_history")
    rejected = rejected_candles(explode_candles(read_history_groups(spark, str(tmp_path), "document")))
    assert sorted(r.reason for r in rejected.collect()) == ["candle is not an array", "candle with fewer than 11 cells"]


def test_no_history_input_disappears(spark, tmp_path):
    good = history_groups()[0]["klines"][0]
    group = json.dumps({"symbol": "A", "klines": [good]})
    lines = [group, group[:40], json.dumps({"symbol": "B", "klines": 5}), json.dumps([1]), json.dumps({"klines": [good]})]
    (tmp_path / "h.json").write_text("\n".join([*lines, "", "  "]))
    exploded = explode_candles(read_history_groups(spark, str(tmp_path), "lines"))
    assert history_scan(spark, str(tmp_path)).count() == 1
    reasons = {r.raw_payload: r.reason for r in rejected_candles(exploded).collect()}
    assert reasons == {**dict.fromkeys(lines[1:4], "no readable list of candles"), json.dumps(good, separators=(",", ":")): "history group without symbol"}
    cut = tmp_path / "cut"
    cut.mkdir()
    (cut / "c.json").write_text(json.dumps(history_groups())[:-9])
    (cut / "d.json").write_text(json.dumps([5, {"symbol": "A", "klines": [good]}]))
    rows = explode_candles(read_history_groups(spark, str(cut), "document")).collect()
    assert sorted(r.reason or "" for r in rows) == ["", "no readable list of candles", "not a JSON list"]


def test_no_snapshot_input_disappears(spark, tmp_path):
    folder = tmp_path / "symbol=a"
    folder.mkdir()
    trade = {"id": 7, "price": "1", "qty": "2", "time": START_MS}
    lines = [json.dumps([trade, 5, None]), json.dumps([trade])[:20], '{"code":-1}', "[]", ""]
    (folder / "a.json").write_text("\n".join(lines))
    found = read_rest_trades(spark, str(tmp_path))
    assert rest_trades_scan(spark, str(tmp_path)).count() == 1
    reasons = sorted((r.raw_payload, r.reason) for r in rejected_rest_trades(found).collect())
    assert reasons == sorted([("5", "trade is not an object"), ("null", "trade is not an object"), (lines[1], "not a JSON list"), (lines[2], "not a JSON list")])
    candles = explode_candles(read_rest_candles(spark, str(tmp_path))).collect()
    assert [r.reason for r in candles if r.raw_payload == lines[2]] == ["no readable list of candles"]
    assert [r.reason for r in candles if r.raw_payload == lines[1]] == ["no readable list of candles"]


def test_no_message_file_disappears(spark, tmp_path):
    event = json.dumps(live_messages()[0])
    (tmp_path / "cut.json").write_text(f"[{event}, {event[:30]}")
    (tmp_path / "null.json").write_text(f"[{event}, null]")
    parsed = live_scan(spark, str(tmp_path), "document")
    assert payloads.trades_of(parsed).count() == 1
    assert sorted(r.raw_payload[:4] for r in payloads.quarantine_of(parsed).collect()) == sorted([f"[{event}"[:4], "null"])


def test_landed_snapshots(spark, tmp_path):
    candles, trades = tmp_path / "candles" / "symbol=btcusdt", tmp_path / "trades" / "symbol=btcusdt"
    candles.mkdir(parents=True), trades.mkdir(parents=True)
    (candles / "a.json").write_text(json.dumps(history_groups()[0]["klines"]))
    snapshot = [{"id": 7, "price": "1.50", "qty": "2", "time": START_MS + 1999, "isBuyerMaker": True}, {"id": 8, "price": "1", "qty": "1", "time": START_MS}]
    (trades / "a.json").write_text(json.dumps(snapshot))
    rows = rest_candles_scan(spark, str(tmp_path / "candles"), ingested_at=ARRIVED).collect()
    assert len(rows) == 6
    assert {(r.symbol, r.source) for r in rows} == {("BTCUSDT", "binance_rest")}
    first, second = rest_trades_scan(spark, str(tmp_path / "trades"), ARRIVED).orderBy("trade_id").collect()
    assert (first.symbol, first.price, first.is_market_maker) == ("BTCUSDT", "1.50", True)
    assert first.trade_time == first.event_time == naive(at(1))
    assert (second.is_market_maker, second.buyer_order_id, second.source) == (False, None, "binance_rest")


def test_event_counts(spark):
    parsed = payloads.parse_market(raw(spark, [json.dumps(m) for m in live_messages()]))
    records = payloads.trades_of(parsed).select("event_type").unionByName(payloads.klines_of(parsed).select("event_type"))
    assert {r.event_type: r.event_count for r in payloads.event_counts(records).collect()} == {"trade": 2, "kline": 3}
    assert payloads.filter_event_type(records, "kline").count() == 3


def test_field_drift(spark):
    lines = [
        '{"e":"trade","p":"1.5","t":7}', '{"e":"trade","p":1.5,"t":8,"x":null}', '{"stream":"s","data":{"e":"kline","k":{"o":"1","n":[2],"in":{"a":1}}}}',
        '{"e":"trade","data":"text"}', "[1]", "broken", "", '{"E":5}',
    ]
    found = {(r.event_type, r.field, r.json_type): r.messages for r in payloads.field_drift(raw(spark, lines)).collect()}
    assert found == {
        ("trade", "e", "text"): 3, ("trade", "p", "text"): 1, ("trade", "p", "number"): 1, ("trade", "t", "number"): 2, ("trade", "x", "null"): 1,
        ("trade", "data", "text"): 1, ("kline", "e", "text"): 1, ("kline", "k", "object"): 1, ("kline", "k.o", "text"): 1, ("kline", "k.n", "list"): 1,
        ("kline", "k.in", "object"): 1, (None, "E", "number"): 1,
    }

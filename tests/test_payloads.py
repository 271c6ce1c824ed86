"""Payload flattening (S-1 … S-3) on hand-written documents."""

import datetime as dt

from marketflow.sources import payloads as pl


def _docs(spark, *texts):
    return spark.createDataFrame([(f"doc{i}", t) for i, t in enumerate(texts)],
                                 "payload_id string, value string")


def test_latest_drops_both_null_and_epoch_zero(spark):
    doc = ('{"data": {"1": {"high": 10, "highTime": 0, "low": 5, "lowTime": 1700000000},'
           ' "2": {"high": null, "low": null}, "3": {"high": 7}}}')
    out = {r.item_id: r for r in pl.parse_latest_payload(_docs(spark, doc)).collect()}
    assert set(out) == {1, 3}                                   # both-NULL item skipped
    assert out[1].high_time is None                              # row 13: epoch 0 -> NULL
    assert out[1].low_time == dt.datetime.fromtimestamp(1700000000, dt.timezone.utc).replace(tzinfo=None)
    assert out[3].low_price is None and out[3].high_time is None


def test_duplicate_json_keys_last_wins(spark):
    doc = '{"data": {"1": {"high": 10, "low": 5}, "1": {"high": 11, "low": 6}}}'
    rows = pl.parse_latest_payload(_docs(spark, doc)).collect()
    assert [(r.item_id, r.high_price) for r in rows] == [(1, 11)]


def test_empty_and_malformed_payloads(spark):
    docs = _docs(spark, '{"data": {}}', "{not json", '{"data": {"5": {"high": 1}}}')
    assert pl.parse_latest_payload(docs).count() == 1
    assert [r.payload_id for r in pl.quarantined(docs).collect()] == ["doc1"]


def test_window_payload_timestamp_default(spark):
    with_ts = '{"timestamp": 1700000100, "data": {"4": {"avgHighPrice": 3, "lowPriceVolume": 2}}}'
    no_ts = '{"data": {"4": {"avgHighPrice": 3}}}'
    out = pl.parse_window_payload(_docs(spark, with_ts, no_ts)).orderBy("timestamp").collect()
    assert out[0].timestamp == dt.datetime(1970, 1, 1)          # missing -> epoch 0
    assert out[1].avg_high_price == 3 and out[1].low_price_volume == 2 and out[1].avg_low_price is None


def test_envelope(spark):
    line = '{"poll_time": 1700000000, "payload": {"data": {"9": {"high": 2, "low": 1}}}}'
    r = pl.parse_latest_payload(_docs(spark, line), envelope=True).first()
    assert r.loaded_at == dt.datetime.fromtimestamp(1700000000, dt.timezone.utc).replace(tzinfo=None)


def test_mapping_required_fields(spark):
    doc = ('[{"id": 1, "name": "a", "limit": 5}, {"id": 2}, {"name": "no id"},'
           ' {"id": 3, "name": "c", "members": true}]')
    docs = _docs(spark, doc)
    out = {r.item_id: r for r in pl.parse_mapping_payload(docs).collect()}
    assert set(out) == {1, 3} and out[1].buy_limit == 5 and out[3].members is True
    assert pl.invalid_mapping_records(docs).count() == 2


def test_mapping_values_that_do_not_fit(spark):
    """One parse types every field; nothing sent as a value becomes NULL."""
    doc = ('[{"id": 1, "name": "a", "limit": 3000000000}, {"id": 2, "name": "b", "highalch": 12.5},'
           ' {"id": 3, "name": "c", "lowalch": "x"}, {"id": 4, "limit": 1}, {"id": "5", "name": "e"}, 6,'
           ' {"id": 7, "name": "g", "members": 1}, {"id": 8, "name": ["h"]}, {"id": 9, "id": 10, "name": "i", "value": 7.0},'
           ' {"id": 11, "name": "k", "limit": null, "members": false, "more": {"x": 1}}, {"id": null, "name": "m"}]')
    rows = pl.mapping_records(_docs(spark, doc, "{oops", '{"id": 1}', "[]")).collect()
    bad = sorted((r.payload_id, r.pos, r.reason) for r in rows if r.reason and r.payload_id == "doc0")
    assert [(p, why) for _, p, why in bad] == [(0, "value"), (1, "value"), (2, "value"), (3, "required"), (4, "value"),
                                               (5, "record"), (6, "value"), (7, "value"), (10, "required")]
    assert sorted(r.payload_id for r in rows if r.reason == "document") == ["doc1", "doc2"]
    assert "3000000000" in next(r.rejected for r in rows if r.pos == 0)
    good = {r.item_id: r for r in rows if not r.reason}
    assert set(good) == {10, 11} and good[10].value == 7 and good[11].members is False and good[11].buy_limit is None


def test_mapping_documents_without_a_load_time(spark):
    lines = ('{"poll_time": 0, "payload": [{"id": 1, "name": "a"}]}', '{"payload": [{"id": 2, "name": "b"}]}')
    rows = pl.mapping_records(_docs(spark, *lines), envelope=True).collect()
    assert sorted((r.item_id or 0, r.reason or "") for r in rows) == [(0, "load_time"), (1, "")]

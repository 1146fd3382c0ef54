"""Streams over several files: equal to the batch result, stable under replay, right in every batch."""

import json
import os
from datetime import datetime, timedelta
from random import Random

import pytest
from pyspark.sql import functions as F

from souk.operators import experiments, moderation
from souk.plans.feature_view import materialize_stream, user_behavior_view
from souk.sources import online, streams
from souk.sources.files import StreamSource
from souk.streaming import cache, counts, review

PAYLOADS = [
    '{"user_id": "u_31", "event_type": "view", "timestamp": "2025-03-04T08:15:00Z"}',
    '{"user_id": "u_31", "event_type": "purchase", "timestamp": "2025-03-04T08:21:30Z"}',
    '{"user_id": "u_32", "event_type": "view", "timestamp": "2025-03-04T08:22:10Z"}',
    "{broken", '{"user_id": "", "event_type": "view"}', '{"user_id": "u_33"}', '{"user_id": "u_33", "event_type": "cart"}', "",
]


def text_files(folder, batches):
    os.makedirs(folder, exist_ok=True)
    for i, lines in enumerate(batches):
        path = os.path.join(folder, f"{i:03d}.txt")
        with open(path, "w") as out:
            out.write("\n".join(lines) + "\n")
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    return folder


def text_stream(spark, folder):
    return streams.stream_source(spark, StreamSource(type="text", path=folder, options={"maxFilesPerTrigger": "1"}))


def table_batches(spark, folder, rows, schema):
    """One Parquet file per batch, read in that order; files that are there already stay."""
    os.makedirs(folder, exist_ok=True)
    for i, part in enumerate(rows):
        tmp = os.path.join(folder, f"_{i}")
        if os.path.exists(tmp):
            continue
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(tmp)
        name = next(f for f in os.listdir(tmp) if f.endswith(".parquet"))
        target = os.path.join(folder, f"{i:03d}.parquet")
        os.link(os.path.join(tmp, name), target)
        os.utime(target, (1_700_000_000 + i, 1_700_000_000 + i))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("pathGlobFilter", "[0-9]*.parquet").parquet(folder)


def test_user_counts_across_batches(spark, tmp_path):
    folder = text_files(str(tmp_path / "in"), [PAYLOADS[:1], PAYLOADS[1:4], PAYLOADS[4:]])
    seen = {}
    streams.drain(counts.stream_user_counts(text_stream(spark, folder)),
                  lambda rows, n: seen.update({r.user_id: tuple(r)[1:] for r in rows.collect()}), checkpoint=str(tmp_path / "c"))
    assert seen == {"u_31": (1, 1, 1.0), "u_32": (1, 0, 0.0)}


def test_a_feature_view_compiles_over_its_stream(spark, tmp_path):
    folder = text_files(str(tmp_path / "in"), [PAYLOADS[:2], PAYLOADS[2:]])
    view = user_behavior_view(stream=StreamSource(type="text", path=folder))
    seen = {}
    streams.drain(materialize_stream(spark, view), lambda rows, n: seen.update({r.user_id: tuple(r)[1:] for r in rows.collect()}), checkpoint=str(tmp_path / "c"))
    assert seen == {"u_31": (1, 1, 1.0), "u_32": (1, 0, 0.0), "u_33": (0, 0, 0.0)}
    with pytest.raises(ValueError):
        materialize_stream(spark, user_behavior_view())


def test_malformed_payload_passes_through(spark):
    df = spark.createDataFrame([(p,) for p in PAYLOADS], "value string")
    rows = counts.parse_events(df).collect()
    assert [r.value for r in rows] == PAYLOADS and rows[3].user_id is None
    assert counts.valid_events(counts.parse_events(df)).count() == 4


def test_increments_survive_a_replayed_batch(spark, tmp_path):
    folder = text_files(str(tmp_path / "in"), [PAYLOADS[:2], PAYLOADS[:1]])
    path, replay = str(tmp_path / "out"), []
    write = online.write_increments(path)

    def twice(rows, number):
        delta = counts.counter_deltas(rows)
        write(delta, number)
        write(delta, number)
        replay.append(number)

    streams.drain(text_stream(spark, folder), twice, "append", str(tmp_path / "c"))
    got = {(r.key, r.field): r.value for r in online.read_increments(spark, path).collect()}
    key = "fv:user_aggregates:user:u_31"
    assert got == {(key, "user_view_count"): 2, (key, "user_purchase_count"): 1} and replay == [0, 1]


def test_a_restarted_stream_goes_on_where_it_stopped(spark, tmp_path):
    folder, path, progress = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "c")
    write = online.write_increments(path)
    text_files(folder, [PAYLOADS[:2]])
    for more in ([], [PAYLOADS[:2], PAYLOADS[2:3]]):
        text_files(folder, [PAYLOADS[:2], *more][: len(more) + 1]) if more else None
        streams.drain(text_stream(spark, folder), lambda rows, n: write(counts.counter_deltas(rows), n), "append", progress)
    total = online.read_increments(spark, path).agg(F.sum("value")).first()[0]
    assert total == 5  # two events, then two and one more; the first file is not read again


def test_guardrail_stream_equals_batch(spark, tmp_path):
    rows = [[("control" if i % 2 else "treatment", float((i * 37) % 11) - (i % 2 == 0) * 2.0) for i in range(b * 90, b * 90 + 90)] for b in range(3)]
    stream = table_batches(spark, str(tmp_path / "in"), rows, "variant string, metric double")
    decisions = []
    streams.drain(review.stream_guardrail(stream), lambda df, n: decisions.extend(df.collect()), checkpoint=str(tmp_path / "c"))
    batch = experiments.seq_guardrail(spark.createDataFrame([r for b in rows for r in b], "variant string, metric double")).first()
    assert decisions[0].decision == "GATHERING_DATA" and decisions[-1].z == pytest.approx(batch.z)
    assert decisions[-1].decision == batch.decision == "STOP_DEGRADATION"


def test_review_stream_equals_batch_over_many_files(spark, tmp_path):
    start = datetime(2024, 1, 1)
    events = [(start + timedelta(minutes=i), (i * 7) % 3 != 0, i, f"t{(i * 5) % 4}") for i in range(60)]
    a_schema = "transaction_id string, alert_id bigint, user_id string, amount double, alert_at timestamp"
    d_schema = "transaction_id string, decision_id bigint, action string, reviewer_id string, decided_at timestamp"
    alerts = [[(tx, i, "u", 1.0, at) for at, d, i, tx in events[p:p + 20] if not d] for p in (0, 20, 40)]
    decisions = [[(tx, i, "Blocked" if i % 2 else "Approved", f"r{i}", at) for at, d, i, tx in events[p:p + 20] if d] for p in (0, 20, 40)]
    out = review.stream_hitl(table_batches(spark, str(tmp_path / "a"), alerts, a_schema), table_batches(spark, str(tmp_path / "d"), decisions, d_schema))
    seen = {}
    streams.drain(out, lambda rows, n: seen.update({r.transaction_id: (r.status, r.moderated_by) for r in rows.collect()}), checkpoint=str(tmp_path / "c"))
    batch = moderation.hitl_status(spark.createDataFrame([r for b in alerts for r in b], a_schema), spark.createDataFrame([r for b in decisions for r in b], d_schema))
    assert seen == {r.transaction_id: (r.status, r.moderated_by) for r in batch.collect()}


def test_windows_drop_only_late_rows(spark, tmp_path):
    day = datetime(2024, 1, 1)
    hours = [(0, 1, 5), (9,), (10,), (2, 8), (30,)]
    batches = [[("view", day + timedelta(hours=h)) for h in part] for part in hours]
    stream = table_batches(spark, str(tmp_path / "in"), batches, "event_type string, ts timestamp")
    rows = []
    streams.drain(counts.stream_window_counts(stream, width="6 hours"), lambda df, n: rows.extend(df.collect()), "append", str(tmp_path / "c"))
    # the row of 02:00 arrives after its window closed; the one of 08:00 still counts
    assert sorted((r.window_start.hour, r.n) for r in rows) == [(0, 3), (6, 3)]


def test_ttl_dedup_computes_again_at_expiry(spark, tmp_path):
    t0 = datetime(2024, 1, 1)
    offsets = [[("a", 0), ("a", 5), ("b", 0), ("a", 60), ("a", 119)], [("a", 90), ("b", 59)], [("a", 120), ("c", 600)], [("a", 1000), ("b", 1000)], [("z", 5000)]]
    # the last request only moves the watermark past the others
    batches = [[(k, t0 + timedelta(seconds=s)) for k, s in part] for part in offsets]
    stream = table_batches(spark, str(tmp_path / "in"), batches, "key string, ts timestamp")
    rows = []
    streams.drain(cache.ttl_dedup(stream), lambda df, n: rows.extend(df.collect()), "append", str(tmp_path / "c"))
    assert sorted((r.key, int((r.ts - t0).total_seconds())) for r in rows) == [
        ("a", 0), ("a", 60), ("a", 120), ("a", 1000), ("b", 0), ("b", 1000), ("c", 600)
    ]


def test_ttl_dedup_goes_by_event_time(spark, tmp_path):
    t0 = datetime(2024, 1, 1)
    offsets = [[(40, 1)], [(10, 2)], [(75, 3), (69, 4)], [(70, 5), (131, 6)], [(5000, 7)]]
    batches = [[("a", t0 + timedelta(seconds=s, microseconds=s), i) for s, i in part] for part in offsets]
    stream = table_batches(spark, str(tmp_path / "in"), batches, "key string, ts timestamp, id bigint")
    rows = []
    streams.drain(cache.ttl_dedup(stream), lambda df, n: rows.extend(df.collect()), "append", str(tmp_path / "c"))
    assert sorted((r.ts, r.id) for r in rows) == [(t0 + timedelta(seconds=s, microseconds=s), i) for s, i in ((10, 2), (70, 5), (131, 6))]


def test_the_end_of_a_table_releases_what_waits(spark, tmp_path):
    t0 = datetime(2024, 1, 1)
    rows = [[("a", t0), ("b", t0 + timedelta(seconds=1))], [("a", t0 + timedelta(seconds=59)), ("a", t0 + timedelta(seconds=61))]]
    schema = "key string, ts timestamp"
    stream = table_batches(spark, str(tmp_path / "in"), rows, schema)
    last = spark.createDataFrame([(None, t0 + timedelta(hours=2))], schema)
    got = streams.drain_whole(stream, cache.ttl_dedup, last, "whole").collect()
    assert sorted((r.key, int((r.ts - t0).total_seconds())) for r in got) == [("a", 0), ("a", 61), ("b", 1)]


def test_a_review_queue_goes_on_after_a_restart(spark, tmp_path):
    t0, a, d = datetime(2024, 1, 1), str(tmp_path / "a"), str(tmp_path / "d")
    a_schema = "transaction_id string, alert_id bigint, user_id string, amount double, alert_at timestamp"
    d_schema = "transaction_id string, decision_id bigint, action string, reviewer_id string, decided_at timestamp"
    alerts = [[("x", 1, "u", 1.0, t0), ("y", 2, "u", 2.0, t0)], [("x", 3, "u", 3.0, t0 - timedelta(hours=2))], [("y", 4, "u", 4.0, t0 + timedelta(hours=3))]]
    decisions = [[("z", 9, "Approved", "r", t0)], [("x", 8, "Blocked", "s", t0 + timedelta(hours=1)), ("y", 6, "Approved", "r", t0 + timedelta(hours=2))], [("x", 7, "Approved", "r", t0)]]
    seen = {}
    for n in (1, 2, 3):  # a new query each time, from the same checkpoint
        out = review.stream_hitl(table_batches(spark, a, alerts[:n], a_schema), table_batches(spark, d, decisions[:n], d_schema))
        streams.drain(out, lambda rows, _: seen.update({r.transaction_id: (r.alert_id, r.status, r.moderated_by) for r in rows.collect()}), checkpoint=str(tmp_path / "c"))
    batch = moderation.hitl_status(spark.createDataFrame(sum(alerts, []), a_schema), spark.createDataFrame(sum(decisions, []), d_schema))
    assert seen == {r.transaction_id: (str(r.alert_id), r.status, r.moderated_by) for r in batch.collect()} == {
        "x": ("1", "approved", "r"), "y": ("4", "pending", None)
    }


@pytest.mark.parametrize("seed", [0, 1])
def test_review_stream_ignores_the_order_of_arrival(spark, tmp_path, seed):
    start, shuffled = datetime(2024, 1, 1), Random(seed)
    events = [(start + timedelta(minutes=i), shuffled.random() < 0.5, i, f"t{shuffled.randrange(8)}") for i in range(60)]
    shuffled.shuffle(events)
    a_schema = "transaction_id string, alert_id bigint, user_id string, amount double, alert_at timestamp"
    d_schema = "transaction_id string, decision_id bigint, action string, reviewer_id string, decided_at timestamp"
    alerts = [[(tx, i, "u", 1.0, at) for at, d, i, tx in events[p:p + 15] if not d] for p in (0, 15, 30, 45)]
    decisions = [[(tx, i, "Blocked" if i % 2 else "Approved", f"r{i}", at) for at, d, i, tx in events[p:p + 15] if d] for p in (0, 15, 30, 45)]
    out = review.stream_hitl(table_batches(spark, str(tmp_path / "a"), alerts, a_schema), table_batches(spark, str(tmp_path / "d"), decisions, d_schema))
    seen = {}
    streams.drain(out, lambda rows, n: seen.update({r.transaction_id: (r.alert_id, r.status, r.moderated_by) for r in rows.collect()}), checkpoint=str(tmp_path / "c"))
    batch = moderation.hitl_status(spark.createDataFrame([r for b in alerts for r in b], a_schema), spark.createDataFrame([r for b in decisions for r in b], d_schema))
    assert seen == {r.transaction_id: (str(r.alert_id), r.status, r.moderated_by) for r in batch.collect()}


def test_resolved_reviews_leave_the_state(spark, tmp_path):
    t0 = datetime(2024, 1, 1)
    a_schema = "transaction_id string, alert_id bigint, user_id string, amount double, alert_at timestamp"
    d_schema = "transaction_id string, decision_id bigint, action string, reviewer_id string, decided_at timestamp"
    alerts = [[("x", 1, "u", 1.0, t0)], [("y", 2, "u", 1.0, t0 + timedelta(days=5))], [("x", 3, "u", 2.0, t0 + timedelta(days=9))]]
    decisions = [[("x", 1, "Blocked", "r", t0 + timedelta(hours=1))], [("w", 2, "Blocked", "r", t0 + timedelta(days=5))], [("v", 3, "Blocked", "r", t0 + timedelta(days=9))]]
    out = review.stream_hitl(table_batches(spark, str(tmp_path / "a"), alerts, a_schema), table_batches(spark, str(tmp_path / "d"), decisions, d_schema))
    rows = []
    query = streams.drain(out, lambda df, n: rows.extend((n, r.transaction_id, r.alert_id, r.status) for r in df.collect()), checkpoint=str(tmp_path / "c"))
    assert [r[1:] for r in sorted(rows)] == [("x", "1", "blocked"), ("y", "2", "pending"), ("x", "3", "pending")]
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 3  # y and x wait for a decision, v for an alert


def test_kafka_source_asks_for_the_connector(spark):
    try:
        streams.stream_source(spark, StreamSource(topic="interactions"))
    except Exception as error:  # noqa: BLE001
        assert "kafka" in str(error).lower()

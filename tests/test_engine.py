"""Timelines, bad inputs, a sequential simulator and crash tests for the order engine."""

import json
import random
import warnings

import pytest
from pyspark.sql import functions as F

import tidemark.sources.lake as lake_module
from tidemark import cli
from tidemark.config import Settings
from tidemark.functions.decode import by_python, decode
from tidemark.operators.aggregate import fold, whole
from tidemark.operators.route import process
from tidemark.operators.windowing import idle_watermark, prefix_max, slices
from tidemark.plans import views
from tidemark.sources import synthetic
from tidemark.sources.lake import Lake
from tidemark.sources.records import RAW, dead_letter_messages, file_stream, kafka_options, replayed_messages
from tidemark.streaming.service import Metrics, batch_function, native, start

BASE = 1_789_387_200  # 2026-09-14 12:00:00 UTC
W120 = Settings(lateness_seconds=120)


def iso(seconds):
    from datetime import UTC, datetime

    return datetime.fromtimestamp(BASE + seconds, UTC).isoformat()


def event(at, n, **more):
    return {"event_id": f"evt-{n}", "event_type": "order_paid", "occurred_at": iso(at), "order_id": "ord-1", "merchant_id": "m_kioskone", "user_id": "u_0001", "amount_minor": 1000, "currency": "EUR", "schema_version": 1} | more


def raw(spark, values, first=0):
    rows = []
    for k, v in enumerate(values, first):
        data = v if v is None or isinstance(v, bytes) else json.dumps(v).encode()
        rows.append(("orders.v1", 0, k, b"m_kioskone", None if data is None else bytearray(data), k))
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, key binary, value binary, s bigint")
    return df.select("topic", "partition", "offset", "key", "value", F.timestamp_seconds(F.lit(BASE) + F.col("s")).alias("timestamp"))


def outcomes(spark, values, settings=W120, now=BASE + 100_000, **more):
    return [r.outcome for r in process(raw(spark, values), settings, now, **more).rows.orderBy("offset").collect()]


@pytest.mark.parametrize(
    ("times", "want"),
    [([100, 60], "on_time"), ([310, 185], "late_accepted"), ([10, 300, 20], "too_late"), ([610, 485], "late_accepted")],
)
def test_timelines(spark, times, want):
    assert outcomes(spark, [event(t, k) for k, t in enumerate(times)])[-1] == want


def test_lateness_is_a_knob(spark):
    values = [event(t, k) for k, t in enumerate([10, 300, 20])]
    assert outcomes(spark, values, Settings(lateness_seconds=600))[-1] != "too_late"
    assert outcomes(spark, values, Settings(lateness_seconds=60))[-1] == "too_late"


def test_restatement_and_measures(spark):
    values = [event(185, 1), event(310, 2), event(188, 3, amount_minor=500), event(310, 4, event_type="order_refunded", amount_minor=300), event(311, 5, event_type="order_placed", amount_minor=None, user_id=""), event(311, 6, event_type="order_cancelled", user_id=None)]
    r = process(raw(spark, values), W120, BASE + 1000)
    rows = {x.window_start - BASE: x for x in fold(r.deltas(), r.users(), 60, r.watermark()).collect()}
    a, b = rows[180], rows[300]
    assert (a.gross_amount_minor, a.late_events_applied, a.revision, a.distinct_users) == (1500, 1, 2, 1)
    assert (b.events_total, b.orders_placed, b.orders_paid, b.orders_cancelled, b.orders_refunded, b.net_amount_minor, b.distinct_users) == (4, 1, 1, 1, 1, 700, 1)
    assert b.first_event_at - BASE == 310 and b.last_event_at - BASE == 311 and not b.is_closed


def test_skew_does_not_move_the_watermark(spark):
    r = process(raw(spark, [event(10, 1), event(3600, 2), event(20, 3)]), W120, BASE + 10)
    assert [x.outcome for x in r.rows.orderBy("offset").collect()] == ["on_time", "future_skew", "on_time"]
    assert r.watermark() == BASE + 20 - 120


def test_idle_watermark():
    assert idle_watermark(None, 400, 0, 30, 120) == 280
    assert idle_watermark(300, 400, 0, 30, 120) == 300
    assert idle_watermark(100, 400, 390, 30, 120) == 100


def test_bad_records(spark):
    bad = [None, b"\xff\xfe\x00", b'{"a": ', b"[1, 2, 3]", b" " * 2_000_000, b'{"a":1} x']
    assert outcomes(spark, bad) == ["malformed"] * 6
    broken = [event(1, 1, occurred_at="yesterday"), event(1, 2, amount_minor=-1), event(1, 3, amount_minor=19.99), event(1, 4, currency="EURO"), event(1, 5, event_type="order_disputed"), event(1, 6, amount_minor=True), event(1, 7, amount_minor=10**30), {k: v for k, v in event(1, 8, merchant_id="").items() if k != "order_id"}]
    r = process(raw(spark, broken), W120, BASE)
    got = r.rows.orderBy("offset").collect()
    assert [x.outcome for x in got] == ["contract_violation"] * 8
    assert got[0].problem == "occurred_at: 'yesterday' is not an ISO-8601 timestamp"
    assert got[1].problem == "amount_minor: -1 is negative"
    assert got[2].problem == "amount_minor: expected integer minor units, got float"
    assert got[3].problem == "currency: 'EURO' is not a 3-letter code"
    assert got[4].problem == "event_type: 'order_disputed' is not in contract v1 (order_placed, order_paid, order_cancelled, order_refunded)"
    assert got[7].problem == "order_id: required field is missing or empty; merchant_id: required field is missing or empty"
    assert r.ledger().count() == 8 and r.dead_letters().count() == 8
    assert outcomes(spark, [event(1, 1, user_id=7), event(1, 2, occurred_at="20260914T120000")]) == ["validation_error"] * 2
    assert outcomes(spark, [event(1, 1, amount_minor=None), event(1, 2, loyalty_tier="gold")]) == ["on_time"] * 2
    assert process(raw(spark, [event(1, 2, loyalty_tier="gold")]), W120, BASE).rows.first().unknown_fields == ["loyalty_tier"]


def test_duplicates_and_accounting(spark):
    ledger = spark.createDataFrame([("evt-9",)], "event_id string")
    r = process(raw(spark, [event(1, 1), event(1, 1), event(1, 2), event(1, 9), b"x", event(1, 3, event_type="?")]), W120, BASE + 5, ledger=ledger)
    assert r.counts() == {"on_time": 2, "duplicate": 2, "malformed": 1, "contract_violation": 1}
    assert sum(r.counts().values()) == 6
    heads = dead_letter_messages(r.dead_letters()).first()
    assert {h.key for h in heads.headers} == {"reason", "source_topic", "source_offset"}


def simulate(times, lateness, window, skew, nows):
    mark, out = None, []
    for t, now in zip(times, nows, strict=True):
        if t > now + skew:
            out.append("future_skew")
            continue
        if mark is not None and t - t % window + window <= mark:
            out.append("too_late")
            continue
        out.append("late_accepted" if mark is not None and t < mark else "on_time")
        mark = t - lateness if mark is None else max(mark, t - lateness)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_closed_form_equals_the_simulator_in_any_batches(spark, tmp_path, seed):
    rng = random.Random(seed)
    times = [k * 7 + rng.choice([0, 0, 0, -50, -200, -900, 30]) for k in range(300)]
    values = [event(t, k) for k, t in enumerate(times)]
    now = BASE + 300 * 7 - 500
    want = simulate([BASE + t for t in times], 120, 60, 60, [now] * 300)
    assert outcomes(spark, values, now=now) == want
    cuts, got, totals = sorted(rng.sample(range(1, 300), 2)), [], []
    lake = Lake(spark, str(tmp_path / "lake"))
    for k, (a, b) in enumerate(zip([0, *cuts], [*cuts, 300], strict=True)):
        r = process(raw(spark, values[a:b], a), W120, now, lake.watermark(), lake.read("ledger"))
        got += [x.outcome for x in r.rows.orderBy("offset").collect()]
        assert lake.write(k, r) and not lake.write(k, r)
    assert got == want
    one = process(raw(spark, values), W120, now)
    key = ["window_start", "merchant_id", "events_total", "gross_amount_minor", "distinct_users", "revision"]
    all_ = sorted(map(tuple, fold(one.deltas(), one.users(), 60, one.watermark()).select(*key).collect()))
    assert sorted(map(tuple, lake.aggregates(60).select(*key).collect())) == all_
    assert sorted(map(tuple, whole(one.rows, 60, one.watermark()).select(*key).collect())) == all_


def test_sliced_prefix_equals_the_single_one(spark):
    df = spark.createDataFrame([(k, (k * 7919) % 1000 if k % 9 else None) for k in range(500)], "k bigint, v bigint")
    one = prefix_max(df, F.col("v"), ["k"], "m").orderBy("k").collect()
    assert prefix_max(df, F.col("v"), ["k"], "m", F.floor(F.col("k") / 37)).select("k", "v", "m").orderBy("k").collect() == one
    for n in (1, 2, 9):
        assert prefix_max(df, F.col("v"), ["k"], "m", slices(df, F.col("k"), n)).select("k", "v", "m").orderBy("k").collect() == one


def test_crash_before_the_marker_leaves_nothing_visible(spark, tmp_path):
    lake, r = Lake(spark, str(tmp_path / "lake")), process(raw(spark, [event(1, 1), event(2, 2)]), W120, BASE + 5)
    r.deltas().write.parquet(f"{lake.root}/aggregate_delta/batch_id=0")  # died here
    assert lake.aggregates(60) is None and lake.read("ledger") is None and lake.closed_by(0, 60) is None
    lake.register(60)
    assert spark.sql("SELECT * FROM agg_orders_minute").isEmpty() and spark.table("ledger").isEmpty()
    run = batch_function(lake, W120, clock=lambda: BASE + 5)
    run(raw(spark, [event(1, 1), event(2, 2)]), 0)
    run(raw(spark, [event(1, 1), event(2, 2)]), 0)
    run(raw(spark, [event(1, 1)]), 1)
    assert lake.aggregates(60).first().events_total == 2 and lake.last_offsets().count() == 1
    run(raw(spark, []).limit(0), 2)


def test_stream_with_scenarios(spark, tmp_path):
    for k, name in enumerate(("clean", "poison")):
        df = synthetic.records(spark, 400, BASE + 10 * k, faults=synthetic.SCENARIOS[name]).withColumn("offset", F.col("offset") + 1000 * k)
        df.select("topic", "partition", "offset", "key", "value", "timestamp").coalesce(1).write.parquet(str(tmp_path / f"in/{name}"))
    lake = Lake(spark, str(tmp_path / "lake"))
    q = start(file_stream(spark, str(tmp_path / "in/*")), lake, Settings(), str(tmp_path / "cp"), clock=lambda: BASE + 3600, trigger={"availableNow": True})
    q.awaitTermination(120)
    counts = lake.state()["counts"]
    assert sum(counts.values()) == 800 and counts["malformed"] > 0 and counts["contract_violation"] > 0
    assert lake.aggregates(60).agg(F.sum("events_total")).first()[0] == counts["on_time"] + counts.get("late_accepted", 0)


def test_both_readers_agree(spark):
    """The JVM's reading of plain records and Python's, on records that are nearly plain."""
    rng = random.Random(5)
    base = json.dumps(event(5, 1))
    bits = ['"', "{", "}", "[", "]", "\\", ",", ":", "1", "-0", "0.5", "1e3", "true", "null", "NaN", " ", "\n", "\t", "é", "\x00", "\u2028", '"event_id": 7', '"x": {"y": 1}', "'", "00", "9" * 20, "Infinity", "//", "T", "Z", "+02:00", ".123456", ".1234567", "24"]
    values = [base, base + " ", " " + base, base + " x", "{}", "[]", "", "null", "1", '"a"', '{"a": 1, "a": 2}', '{"event_id": "a", "event_id": "b"}', base.replace("order_paid", "a}b"), base.replace("evt-1", "\\ud800"), base.replace("evt-1", "\\u00e9")]
    values += [json.dumps(event(5, 1, **{f: v})) for f in ("event_id", "occurred_at", "amount_minor", "user_id", "schema_version", "currency") for v in (None, "", 0, -0.0, 1, -1, 2**63, 10**30, 1.0, True, False, [], {}, "x", "2026-01-01", "2026-01-01T00:00:00Z", "2026-01-01 00:00:00.5+01:00", "0000-01-01T00:00:00Z", "0001-01-01T00:00:00Z", "9999-12-31T23:59:59.999999Z", "2026-02-30T00:00:00Z", "2026-01-01T24:00:00Z", "2026-01-01T00:00:60Z", "2026-01-01T00:00:00+23:00", "2026-01-01T00:00:00-18:30", "2026-01-01T00:00Z", "1500-02-28T12:00:00Z", "20260101", "é", "a b")]
    for _ in range(1500):
        at = rng.randrange(len(base))
        values.append(base[:at] + rng.choice(bits) + base[at + rng.choice([0, 0, 1, 3]) :])
    rows = spark.createDataFrame([(k, bytearray(v.encode("utf-8", "surrogatepass"))) for k, v in enumerate(values)], "k int, value binary")
    both = decode(rows).withColumn("p", by_python(F.col("value"), F.lit(True))).collect()
    for r in both:
        assert r._d == r.p, values[r.k]
    assert sum(r._d.malformed is None for r in both) > 200


def test_ledger_is_unique_and_tells_the_same_each_time(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    bad, good = event(1, 1, event_type="?", merchant_id="m_b"), event(1, 1)
    for k, values in enumerate([[bad, good, event(2, 2)], [bad, good], [bad], [event(2, 3, amount_minor=-1)], [event(2, 3, amount_minor=-1, merchant_id="")]]):
        lake.write(k, process(raw(spark, values, 10 * k), W120, BASE + 5 + k, lake.watermark(), lake.read("ledger")))
    rows = {r.event_id: r for r in lake.read("ledger").collect()}
    assert lake.read("ledger").count() == len(rows) == 3
    assert (rows["evt-1"].disposition, rows["evt-1"].merchant_id, rows["evt-3"].disposition, rows["evt-3"].merchant_id) == ("applied", "m_kioskone", "refused", "m_kioskone")


def test_dead_letters_are_published_before_the_marker(spark, tmp_path):
    lake, sent, fail = Lake(spark, str(tmp_path / "lake")), [], [True]

    def publish(df):
        if fail.pop() if fail else False:
            raise OSError("no broker")
        sent.extend(r.reason for r in df.collect())

    run = batch_function(lake, W120, clock=lambda: BASE + 5, publish=publish)
    with pytest.raises(OSError):
        run(raw(spark, [b"x", event(1, 1)]), 0)
    assert lake.aggregates(60) is None and not sent
    run(raw(spark, [b"x", event(1, 1)]), 0)
    run(raw(spark, [b"x", event(1, 1)]), 0)
    assert sent == ["malformed"] and lake.aggregates(60).first().events_total == 1


def test_markers_are_compacted_and_old_ids_forgotten(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lake_module, "COMPACT_AT", 3)
    lake = Lake(spark, str(tmp_path / "lake"))
    for k in range(6):
        lake.write(k, process(raw(spark, [event(60 * k, k)], k), W120, BASE + 3600 * k, lake.watermark(), lake.read("ledger")))
    assert len(lake.markers()) <= 3 and lake.state()["batches"] == [[0, 5]] and lake.state()["counts"] == {"on_time": 6}
    assert Lake(spark, lake.root).watermark() == lake.watermark() == BASE + 300 - 120
    for name, ddl in lake_module.TABLES.items():
        written = spark.read.parquet(f"{lake.root}/{name}/batch_id=0")
        assert written.schema.simpleString() == spark.createDataFrame([], ddl).schema.simpleString(), name
    assert "agg_orders_minute" in lake.register(60) and spark.sql("SELECT sum(events_total) FROM agg_orders_minute").first()[0] == 6
    assert spark.sql("SELECT count(*) FROM dlq_events").first()[0] == 0
    assert [r.window_start - BASE for r in lake.aggregates(60, touched_by=4).collect()] == [240]
    assert [[r.window_start - BASE for r in lake.closed_by(k, 60).orderBy("window_start").collect()] for k in range(6)] == [[], [], [], [0], [60], [120]]
    assert lake.purge(BASE + 5 * 3600, 2) == 3 and lake.read("ledger").count() == 3
    again = process(raw(spark, [event(0, 0), event(300, 5)], 90), Settings(lateness_seconds=9000), BASE + 5 * 3600, None, lake.read("ledger"))
    assert [r.outcome for r in again.rows.orderBy("offset").collect()] == ["on_time", "duplicate"]
    assert lake.aggregates(60).agg(F.sum("events_total"), F.max("updated_at")).first()[:] == (6, BASE + 5 * 3600)


def test_replays_are_marked(spark, tmp_path):
    lake, sent = Lake(spark, str(tmp_path / "lake")), []
    lake.write(0, process(raw(spark, [b"x", b"y", event(1, 1, event_type="?")]), W120, BASE))
    assert views.replay(lake.dead_letters(), limit=2).count() == 2 and lake.dead_letters().where("replayed_at is not null").isEmpty()
    for n, reason in ((1, "malformed"), (1, "malformed"), (0, "malformed"), (1, None)):
        out = views.replay(lake.dead_letters(), lambda df: sent.append(replayed_messages(df).count()), reason, 1, lambda df: lake.mark_replayed(df, BASE + 9))
        assert out.count() == n
    assert lake.dead_letters().where(F.col("replayed_at") == F.timestamp_seconds(F.lit(BASE + 9))).count() == 3


def test_a_quiet_stream_closes_its_windows(spark, tmp_path):
    import time

    now = int(time.time())
    df = spark.createDataFrame([("orders.v1", 0, 0, None, bytearray(json.dumps(event(1, 1, occurred_at=iso(now - BASE - 70))).encode()))], "topic string, partition int, offset bigint, key binary, value binary").withColumn("timestamp", F.timestamp_seconds(F.lit(now)))
    df.write.parquet(str(tmp_path / "in"))
    lake, metrics = Lake(spark, str(tmp_path / "lake")), Metrics()
    settings = Settings(window_seconds=60, lateness_seconds=0, idle_seconds=3, flush_seconds=1.0)
    q = start(file_stream(spark, str(tmp_path / "in")), lake, settings, str(tmp_path / "cp"), metrics=metrics)
    try:
        until = time.time() + 90
        while time.time() < until and not ((a := lake.aggregates(60)) is not None and a.where("is_closed").count()):
            time.sleep(1)
    finally:
        q.stop()
    assert lake.aggregates(60).first().is_closed and lake.state()["counts"] == {"on_time": 1}
    assert 'tidemark_events_total{outcome="on_time"} 1' in metrics.text() and "tidemark_watermark_lag_seconds" in metrics.text()


def test_command_line(spark, tmp_path, capsys):
    folders = {k: str(tmp_path / k) for k in ("in", "lake", "cp", "dlq", "again")}
    assert cli.main(["scenario", "poison", "--count", "300", "--target", folders["in"]], spark) == 0
    ticks = iter(range(100))
    n = cli.produce(spark, lambda df: df.write.mode("append").parquet(folders["in"]), 20, 3, synthetic.Faults(), clock=lambda: BASE + next(ticks), sleep=lambda s: None)
    assert n == 60 and spark.read.parquet(folders["in"]).count() == 360
    cli.main(["run", "--source", folders["in"], "--lake", folders["lake"], "--checkpoint", folders["cp"], "--dlq", folders["dlq"], "--once"], spark)
    lake = Lake(spark, folders["lake"])
    counts = lake.state()["counts"]
    assert sum(counts.values()) == 360 and spark.read.parquet(folders["dlq"]).count() == sum(n for k, n in counts.items() if k not in ("on_time", "late_accepted", "duplicate"))
    cli.main(["health", "--lake", folders["lake"]], spark)
    cli.main(["replay-dlq", "--lake", folders["lake"], "--reason", "malformed", "--limit", "5"], spark)
    cli.main(["replay-dlq", "--lake", folders["lake"], "--limit", "5", "--target", folders["again"]], spark)
    said = capsys.readouterr().out
    assert "newest_window" in said and "5 dead letters listed" in said and "5 dead letters sent" in said
    assert spark.read.parquet(folders["again"]).count() == 5 and lake.dead_letters().where("replayed_at is not null").count() == 5


def test_native_mode_and_adapters(spark, tmp_path):
    ev = spark.createDataFrame([(f"e{k}", BASE + k, "m", "order_paid", 5) for k in range(50)], "event_id string, s bigint, merchant_id string, event_type string, amount_minor bigint").withColumn("occurred_at", F.timestamp_seconds("s"))
    ev.write.parquet(str(tmp_path / "ev"))
    stream = spark.readStream.schema(ev.schema).parquet(str(tmp_path / "ev"))
    q = native(stream, Settings()).writeStream.outputMode("update").format("memory").queryName("native_out").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.sql("select sum(events_total) from native_out").first()[0] == 50
    options = kafka_options(Settings(topic="t"))
    assert options["startingOffsets"] == "earliest" and options["subscribe"] == "t" and "value binary" in RAW


def test_settings_warn_and_read_the_environment(monkeypatch):
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        Settings(lateness_seconds=10)
    assert seen
    monkeypatch.setenv("TIDEMARK_WINDOW_SECONDS", "120")
    assert Settings.from_env().window_seconds == 120
    monkeypatch.setenv("TIDEMARK_STRICT_CONTRACT", "true")
    monkeypatch.setenv("TIDEMARK_FLUSH_SECONDS", "2.5")
    monkeypatch.setenv("TIDEMARK_TOPIC", "t2")
    assert (Settings.from_env().strict_contract, Settings.from_env().flush_seconds, Settings.from_env().topic) == (True, 2.5, "t2")
    with pytest.raises(ValueError):
        Settings(window_seconds=0)
    with pytest.raises(ValueError):
        synthetic.Faults(duplicate=0.9, late=0.2)

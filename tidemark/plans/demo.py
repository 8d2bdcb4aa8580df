"""The engine's operators over the driver's events table, with DuckDB SQL for each.

Arrivals are derived by integer arithmetic: types are mapped, one in twenty events comes twice, one in ten comes hours late,
one in fifty carries a time two hours ahead. now is each row's own arrival. Windows are of an hour, lateness five hours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import aggregate
from tidemark.operators.dedup import first_arrival, mark_duplicates
from tidemark.operators.windowing import classify, slices
from tidemark.plans import views

WINDOW, LATENESS, SKEW = 3600, 18_000, 60
TYPES = {"view": "order_placed", "purchase": "order_paid", "error": "order_cancelled", "click": "order_refunded"}
ORDER = ["arr", "copy", "event_id"]
#: When the last day of dead letters ends.
DAY_END = 1_706_500_000
AGG = ("window_start", "merchant_id", *aggregate.ADDITIVE, "distinct_users", "net_amount_minor", "revision", "first_event_at", "last_event_at", "is_closed", "updated_at")

ARRIVALS_SQL = """
WITH base AS (SELECT event_id, user_id, user_id % 6 AS merchant_id, event_type AS raw_type,
    CASE event_type WHEN 'view' THEN 'order_placed' WHEN 'purchase' THEN 'order_paid' WHEN 'error' THEN 'order_cancelled' WHEN 'click' THEN 'order_refunded' ELSE event_type END AS event_type,
    CAST(round(value * 100) AS BIGINT) AS amount_minor, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events),
timed AS (SELECT *, s + CASE WHEN event_id % 50 = 7 THEN 7200 ELSE 0 END AS occurred_s, s + CASE WHEN event_id % 10 = 3 THEN 4000 + (event_id * 7919) % 30000 ELSE 0 END AS arr0 FROM base),
arrivals AS (SELECT *, arr0 AS arr, 0 AS copy FROM timed UNION ALL SELECT *, arr0 + 500 AS arr, 1 AS copy FROM timed WHERE event_id % 20 = 0),
valid AS (SELECT * FROM arrivals WHERE event_type LIKE 'order_%'),
fresh AS (SELECT * FROM valid QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY arr, copy) = 1),
seen AS (SELECT *, occurred_s - occurred_s % 3600 AS window_start, max(CASE WHEN occurred_s <= arr + 60 THEN occurred_s END) OVER (ORDER BY arr, copy, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 18000 AS watermark_before FROM fresh),
classed AS (SELECT *, CASE WHEN occurred_s > arr + 60 THEN 'future_skew' WHEN window_start + 3600 <= watermark_before THEN 'too_late' WHEN occurred_s < watermark_before THEN 'late_accepted' ELSE 'on_time' END AS outcome FROM seen),
applied AS (SELECT * FROM classed WHERE outcome IN ('on_time', 'late_accepted')),
mark AS (SELECT max(occurred_s) - 18000 AS wm FROM applied),
agg AS (SELECT window_start, merchant_id, count(*) AS events_total, count(*) FILTER (event_type = 'order_placed') AS orders_placed, count(*) FILTER (event_type = 'order_paid') AS orders_paid,
    count(*) FILTER (event_type = 'order_cancelled') AS orders_cancelled, count(*) FILTER (event_type = 'order_refunded') AS orders_refunded,
    CAST(coalesce(sum(amount_minor) FILTER (event_type = 'order_paid'), 0) AS BIGINT) AS gross_amount_minor, CAST(coalesce(sum(amount_minor) FILTER (event_type = 'order_refunded'), 0) AS BIGINT) AS refunded_amount_minor,
    count(*) FILTER (outcome = 'late_accepted') AS late_events_applied, count(DISTINCT user_id) AS distinct_users,
    CAST(coalesce(sum(amount_minor) FILTER (event_type = 'order_paid'), 0) - coalesce(sum(amount_minor) FILTER (event_type = 'order_refunded'), 0) AS BIGINT) AS net_amount_minor,
    CAST(1 + count(*) FILTER (outcome = 'late_accepted') AS INTEGER) AS revision, min(occurred_s) AS first_event_at, max(occurred_s) AS last_event_at, max(arr) AS updated_at, window_start + 3600 <= (SELECT wm FROM mark) AS is_closed
    FROM applied GROUP BY window_start, merchant_id),
late AS (SELECT event_id, merchant_id, event_type, occurred_s, window_start, watermark_before, CAST(watermark_before - occurred_s AS DOUBLE) AS lateness_seconds, amount_minor, arr AS recorded_s FROM classed WHERE outcome = 'too_late'),
dead AS (SELECT outcome AS reason, arr AS failed_s FROM classed WHERE outcome IN ('too_late', 'future_skew') UNION ALL SELECT 'contract_violation', arr FROM arrivals WHERE event_type NOT LIKE 'order_%')
"""


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    kind = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for p in TYPES.items() for x in p)), "event_type"), F.col("event_type"))
    s = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).cast("long")
    e = e.select("event_id", "user_id", F.pmod("user_id", F.lit(6)).alias("merchant_id"), kind.alias("event_type"), F.round(F.col("value") * 100).cast("long").alias("amount_minor"), s.alias("s"))
    e = e.withColumns({"occurred_s": F.col("s") + F.when(F.col("event_id") % 50 == 7, 7200).otherwise(0), "arr": F.col("s") + F.when(F.col("event_id") % 10 == 3, 4000 + (F.col("event_id") * 7919) % 30_000).otherwise(0)}).drop("s")
    copies = F.when(F.col("event_id") % 20 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return e.withColumn("copy", F.explode(copies)).withColumn("arr", F.col("arr") + 500 * F.col("copy"))


def valid(spark, d):
    return arrivals(spark, d).where(F.col("event_type").startswith("order_"))


def classed(spark, d) -> DataFrame:
    fresh = first_arrival(valid(spark, d), "event_id", ["arr", "copy"])
    parts = slices(arrivals(spark, d), F.col("arr"), int(spark.conf.get("spark.sql.shuffle.partitions")))
    return classify(fresh, ORDER, WINDOW, LATENESS, SKEW, F.col("arr"), slice_col=parts)


def _agg(spark, d, parts=None) -> DataFrame:
    """In one pass over the events, or folded from parts."""
    c = classed(spark, d).withColumn("user_id", F.col("user_id").cast("string"))
    out = aggregate.whole(c, WINDOW, None, updated=F.col("arr")) if parts is None else aggregate.fold(parts(c), aggregate.membership(c), WINDOW, None)
    top = out.agg((F.max("last_event_at") - LATENESS).alias("wm"))
    return out.crossJoin(F.broadcast(top)).withColumn("is_closed", F.col("window_start") + WINDOW <= F.col("wm")).select(*AGG)  # top: one row


def _late(spark, d) -> DataFrame:
    c = classed(spark, d).where("outcome = 'too_late'")
    return c.select("event_id", "merchant_id", "event_type", "occurred_s", "window_start", "watermark_before", (F.col("watermark_before") - F.col("occurred_s")).cast("double").alias("lateness_seconds"), "amount_minor", F.col("arr").alias("recorded_s"))


def _dead(spark, d) -> DataFrame:
    c = classed(spark, d).where(F.col("outcome").isin("too_late", "future_skew")).select(F.col("outcome").alias("reason"), F.col("arr").alias("failed_s"))
    return c.union(arrivals(spark, d).where(~F.col("event_type").startswith("order_")).select(F.lit("contract_violation"), "arr"))


def _outcomes(spark, d) -> DataFrame:
    dup = mark_duplicates(valid(spark, d), "event_id", ["arr", "copy"]).where("duplicate is not null").select(F.lit("duplicate").alias("outcome"))
    bad = arrivals(spark, d).where(~F.col("event_type").startswith("order_")).select(F.lit("contract_violation"))
    return classed(spark, d).select("outcome").union(dup).union(bad).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def _ledger(spark, d) -> DataFrame:
    return first_arrival(arrivals(spark, d), "event_id", ["arr", "copy"]).select("event_id", "merchant_id", F.when(F.col("event_type").startswith("order_"), "applied").otherwise("refused").alias("disposition"))


def _health(spark, d) -> DataFrame:
    now = 1_706_745_600  # 2024-02-01
    return views.health(_agg(spark, d), _late(spark, d), _dead(spark, d), now)


def _two_batches(c: DataFrame) -> DataFrame:
    """Deltas of two batches, to be folded."""
    return aggregate.deltas(c.where("event_id % 2 = 0"), updated=F.col("arr")).union(aggregate.deltas(c.where("event_id % 2 = 1"), updated=F.col("arr")))


def _props(spark, d) -> DataFrame:
    e = spark.read.parquet(f"{d}/events.parquet")
    return e.select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k"))


def _users(spark, d):
    return aggregate.membership(classed(spark, d).withColumn("user_id", F.col("user_id").cast("string")))


def _replay(spark, d):
    """A second pass over ids that are in the ledger applies nothing."""
    v = valid(spark, d)
    return mark_duplicates(v, "event_id", ["arr", "copy"], v.select("event_id")).groupBy("duplicate").agg(F.count(F.lit(1)).alias("n"))


def _progress(spark, d):
    c = classed(spark, d)
    return c.groupBy(F.floor(F.col("arr") / 86_400).alias("day")).agg(F.min("watermark_before").alias("low"), F.max("watermark_before").alias("high"))


_FROM = ARRIVALS_SQL
QUERIES = {
    "minute_aggregates": (_agg, f"{_FROM} SELECT * FROM agg"),
    "delta_fold": (lambda s, d: _agg(s, d, _two_batches), f"{_FROM} SELECT * FROM agg"),
    "outcome_counts": (_outcomes, f"{_FROM} SELECT outcome, count(*) AS n FROM (SELECT outcome FROM classed UNION ALL SELECT 'duplicate' FROM valid QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY arr, copy) > 1 UNION ALL SELECT 'contract_violation' FROM arrivals WHERE event_type NOT LIKE 'order_%') GROUP BY outcome"),
    "dedup_first_arrival": (lambda s, d: first_arrival(valid(s, d), "event_id", ["arr", "copy"]).select("event_id", "arr", "copy"), f"{_FROM} SELECT event_id, arr, copy FROM fresh"),
    "duplicate_stats": (lambda s, d: mark_duplicates(valid(s, d), "event_id", ["arr", "copy"]).groupBy(F.coalesce("duplicate", F.lit("new")).alias("state")).agg(F.count(F.lit(1)).alias("n")), f"{_FROM} SELECT CASE WHEN r > 1 THEN 'in_batch' ELSE 'new' END AS state, count(*) AS n FROM (SELECT row_number() OVER (PARTITION BY event_id ORDER BY arr, copy) AS r FROM valid) GROUP BY state"),
    "classified_events": (lambda s, d: classed(s, d).select("event_id", "window_start", "watermark_before", "outcome"), f"{_FROM} SELECT event_id, window_start, watermark_before, outcome FROM classed"),
    "late_events": (_late, f"{_FROM} SELECT * FROM late"),
    "too_late_by_window": (lambda s, d: _late(s, d).groupBy("merchant_id", "window_start").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("lateness_seconds")).alias("avg_lateness")), f"{_FROM} SELECT merchant_id, window_start, count(*) AS n, round(avg(lateness_seconds)) AS avg_lateness FROM late GROUP BY ALL"),
    "late_percentiles": (lambda s, d: views.late_analysis(_late(s, d)).withColumn("p99_lateness", F.round("p99_lateness", 3)), f"{_FROM} SELECT merchant_id, count(*) AS n, round(avg(lateness_seconds)) AS avg_lateness, round(percentile_cont(0.99) WITHIN GROUP (ORDER BY lateness_seconds), 3) AS p99_lateness FROM late GROUP BY merchant_id"),
    "future_skew": (lambda s, d: classed(s, d).where("outcome = 'future_skew'").select("event_id", "occurred_s", "arr"), f"{_FROM} SELECT event_id, occurred_s, arr FROM classed WHERE outcome = 'future_skew'"),
    "contract_violations": (lambda s, d: arrivals(s, d).where(~F.col("event_type").startswith("order_")).groupBy("event_type", "merchant_id").agg(F.count(F.lit(1)).alias("n")), f"{_FROM} SELECT event_type, merchant_id, count(*) AS n FROM arrivals WHERE event_type NOT LIKE 'order_%' GROUP BY ALL"),
    "dlq_by_reason": (lambda s, d: views.dead_by_reason(_dead(s, d)), f"{_FROM} SELECT reason, count(*) AS n, max(failed_s) AS last_failed FROM dead GROUP BY reason"),
    "dlq_last_day": (lambda s, d: views.dead_by_reason(_dead(s, d), DAY_END - views.DAY), f"{_FROM} SELECT reason, count(*) AS n, max(failed_s) AS last_failed FROM dead WHERE failed_s > {DAY_END} - 86400 GROUP BY reason"),
    "newest_late_events": (lambda s, d: views.newest_late(_late(s, d)), f"{_FROM} SELECT event_id, merchant_id, window_start, round_even(lateness_seconds, 0) AS late_s, recorded_s FROM late ORDER BY recorded_s DESC, event_id DESC LIMIT 20"),
    "ledger": (_ledger, f"{_FROM} SELECT event_id, merchant_id, CASE WHEN event_type LIKE 'order_%' THEN 'applied' ELSE 'refused' END AS disposition FROM arrivals QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY arr, copy) = 1"),
    "ledger_uniqueness": (lambda s, d: _ledger(s, d).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("n_ids")), f"{_FROM} SELECT count(DISTINCT event_id) AS n, count(DISTINCT event_id) AS n_ids FROM arrivals"),
    "window_membership": (_users, f"{_FROM} SELECT DISTINCT window_start, merchant_id, CAST(user_id AS VARCHAR) AS user_id FROM applied"),
    "distinct_users": (lambda s, d: _users(s, d).groupBy("window_start", "merchant_id").agg(F.count(F.lit(1)).alias("n")), f"{_FROM} SELECT window_start, merchant_id, count(DISTINCT user_id) AS n FROM applied GROUP BY ALL"),
    "hourly_rollup": (lambda s, d: views.hourly(_agg(s, d)), f"{_FROM} SELECT window_start - window_start % 3600 AS hour_start, merchant_id, CAST(sum(orders_paid) AS BIGINT) AS orders_paid, CAST(sum(gross_amount_minor) AS BIGINT) AS gross_amount_minor, CAST(sum(refunded_amount_minor) AS BIGINT) AS refunded_amount_minor, CAST(sum(net_amount_minor) AS BIGINT) AS net_amount_minor, CAST(sum(late_events_applied) AS BIGINT) AS late_events_applied, count(*) FILTER (NOT is_closed) AS open_windows FROM agg GROUP BY ALL"),
    "pipeline_health": (_health, f"{_FROM} SELECT max(window_start) AS newest_window, max(updated_at) AS last_write, 1706745600 - max(updated_at) AS seconds_since_write, count(*) FILTER (NOT is_closed) AS open_windows, CAST(sum(late_events_applied) AS BIGINT) AS late_events_applied, (SELECT count(*) FROM late WHERE recorded_s > 1706745600 - 3600) AS too_late_last_hour, (SELECT count(*) FROM dead WHERE failed_s > 1706745600 - 3600) AS dlq_last_hour FROM agg"),
    "open_windows": (lambda s, d: _agg(s, d).where("NOT is_closed").select("window_start", "merchant_id"), f"{_FROM} SELECT window_start, merchant_id FROM agg WHERE NOT is_closed"),
    "restated_windows": (lambda s, d: views.restated(_agg(s, d)), f"{_FROM} SELECT * FROM agg WHERE revision > 1 ORDER BY updated_at DESC, window_start DESC, merchant_id LIMIT 50"),
    "newest_windows_topk": (lambda s, d: views.newest(_agg(s, d)), f"{_FROM} SELECT * FROM agg ORDER BY window_start DESC, merchant_id LIMIT 20"),
    "watermark_progress": (_progress, f"{_FROM} SELECT arr // 86400 AS day, min(watermark_before) AS low, max(watermark_before) AS high FROM classed GROUP BY day"),
    "replay_is_noop": (_replay, f"{_FROM} SELECT CASE WHEN r > 1 THEN 'in_batch' ELSE 'ledger' END AS duplicate, count(*) AS n FROM (SELECT row_number() OVER (PARTITION BY event_id ORDER BY arr, copy) AS r FROM valid) GROUP BY duplicate"),
    "net_revenue": (lambda s, d: _agg(s, d).groupBy("merchant_id").agg(F.sum("net_amount_minor").alias("net_amount_minor")), f"{_FROM} SELECT merchant_id, CAST(sum(net_amount_minor) AS BIGINT) AS net_amount_minor FROM agg GROUP BY merchant_id"),
    "json_props_decode": (_props, "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"),
}

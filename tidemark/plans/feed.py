"""The whole engine over the driver's events table: raw records with faults through decode, contract, routing and lake, with DuckDB SQL.

Records are JSON text built alike on both sides. event_id % 40 picks a fault (none from 19 on), one event in twenty comes
twice, one in ten hours late. All batches have one clock, so that what lies after it is too far ahead.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import Settings
from tidemark.functions.decode import once
from tidemark.operators.route import Routed, process
from tidemark.operators.windowing import OUTCOMES
from tidemark.plans import demo, views
from tidemark.sources.lake import Lake

SETTINGS = Settings(window_seconds=demo.WINDOW, lateness_seconds=demo.LATENESS, skew_seconds=demo.SKEW)
NOW = 1_706_500_000
#: Arrivals at which a new batch begins.
CUTS = (1_704_930_000, 1_705_790_000)

RAW_SQL = """
WITH base AS (SELECT event_id, user_id, event_id % 40 AS f, CAST(floor(epoch(ts)) AS BIGINT) AS occurred_s, CAST(round(value * 100) AS BIGINT) AS amount,
    CASE WHEN event_id % 40 = 5 THEN 'order_disputed' ELSE CASE event_type WHEN 'view' THEN 'order_placed' WHEN 'purchase' THEN 'order_paid' WHEN 'error' THEN 'order_cancelled' WHEN 'click' THEN 'order_refunded' ELSE event_type END END AS kind FROM events),
timed AS (SELECT *, occurred_s + CASE WHEN event_id % 10 = 3 THEN 4000 + (event_id * 7919) % 30000 ELSE 0 END AS arr0 FROM base),
copies AS (SELECT *, arr0 AS arr, 0 AS copy FROM timed UNION ALL SELECT *, arr0 + 500 AS arr, 1 AS copy FROM timed WHERE event_id % 20 = 0),
texts AS (SELECT *, CAST(user_id % 6 AS INTEGER) AS partition, event_id * 2 + copy AS "offset", 'm' || (user_id % 6) AS merchant,
    CASE WHEN f = 16 THEN strftime(make_timestamp(occurred_s * 1000000), '%Y%m%dT%H%M%S') ELSE strftime(make_timestamp(occurred_s * 1000000), '%Y-%m-%dT%H:%M:%SZ') END AS iso FROM copies),
json AS (SELECT *, '{"event_id":"evt-' || event_id || '","event_type":"' || kind || '","occurred_at":"' || CASE WHEN f = 7 THEN 'yesterday' ELSE iso END || '",' || CASE WHEN f = 6 THEN '' ELSE '"order_id":"ord-' || event_id || '",' END
    || '"merchant_id":"' || CASE WHEN f = 6 THEN '' ELSE merchant END || '","user_id":' || CASE WHEN f = 11 THEN CAST(user_id AS VARCHAR) WHEN f = 18 THEN '"\\u00e9' || user_id || '"' ELSE '"u' || user_id || '"' END
    || ',"amount_minor":' || CASE f WHEN 8 THEN '-1' WHEN 9 THEN '19.99' WHEN 13 THEN 'null' WHEN 14 THEN '1e3' ELSE CAST(amount AS VARCHAR) END || ',"currency":"' || CASE WHEN f = 10 THEN 'EURO' ELSE 'EUR' END
    || '","schema_version":' || CASE WHEN f = 15 THEN '"x"' ELSE '1' END || CASE WHEN f = 12 THEN ',"loyalty_tier":"gold"' ELSE '' END || '}' AS j FROM texts),
raw AS (SELECT *, CASE WHEN f = 0 THEN NULL WHEN f = 1 THEN left(j, 20) WHEN f = 2 THEN '[1, 2, 3]' WHEN f = 3 THEN chr(65533) || chr(65533) || 'A' WHEN f = 4 THEN j || ' x' WHEN event_id % 4000 = 17 THEN rpad(j, 1000001, ' ') ELSE j END AS v FROM json),
judged AS (SELECT *, CASE WHEN f = 0 THEN 'record value is null (tombstone on a non-compacted topic)' WHEN f IN (1, 4) THEN 'record is not valid JSON' WHEN f = 2 THEN 'record is a JSON list, expected an object' WHEN f = 3 THEN 'record is not valid UTF-8'
        WHEN event_id % 4000 = 17 THEN 'record is 1000001 bytes, over the 1000000 limit' END AS malformed,
    nullif(concat_ws('; ', CASE WHEN f = 6 THEN 'order_id: required field is missing or empty; merchant_id: required field is missing or empty' END,
        CASE WHEN kind NOT IN ('order_placed', 'order_paid', 'order_cancelled', 'order_refunded') THEN 'event_type: ''' || kind || ''' is not in contract v1 (order_placed, order_paid, order_cancelled, order_refunded)' END,
        CASE WHEN f = 7 THEN 'occurred_at: ''yesterday'' is not an ISO-8601 timestamp' END,
        CASE f WHEN 8 THEN 'amount_minor: -1 is negative' WHEN 9 THEN 'amount_minor: expected integer minor units, got float' WHEN 14 THEN 'amount_minor: expected integer minor units, got float' END,
        CASE WHEN f = 10 THEN 'currency: ''EURO'' is not a 3-letter code' END), '') AS broken,
    CASE f WHEN 11 THEN 'user_id: expected a string, got int' WHEN 15 THEN 'schema_version: expected an integer' WHEN 16 THEN 'occurred_at: not a date-time' END AS mistyped FROM raw),
refused AS (SELECT *, CASE WHEN malformed IS NOT NULL THEN 'malformed' WHEN broken IS NOT NULL THEN 'contract_violation' WHEN mistyped IS NOT NULL THEN 'validation_error' END AS refusal, coalesce(malformed, broken, mistyped) AS problem,
    CASE WHEN f = 13 THEN NULL ELSE amount END AS amount_minor, CASE WHEN f = 18 THEN chr(233) || user_id ELSE 'u' || user_id END AS user_text FROM judged),
nth AS (SELECT *, CASE WHEN refusal IS NULL THEN row_number() OVER (PARTITION BY event_id, refusal ORDER BY arr, partition, "offset") END AS n FROM refused),
fresh AS (SELECT *, occurred_s - occurred_s % 3600 AS window_start, max(CASE WHEN occurred_s <= 1706500060 THEN occurred_s END) OVER (ORDER BY arr, partition, "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 18000 AS watermark_before FROM nth WHERE n = 1),
classed AS (SELECT *, CASE WHEN occurred_s > 1706500060 THEN 'future_skew' WHEN window_start + 3600 <= watermark_before THEN 'too_late' WHEN occurred_s < watermark_before THEN 'late_accepted' ELSE 'on_time' END AS outcome FROM fresh),
records AS (SELECT *, outcome AS o FROM classed UNION ALL SELECT *, NULL, NULL, 'x', coalesce(refusal, 'duplicate') FROM nth WHERE n IS NULL OR n > 1),
applied AS (SELECT * FROM classed WHERE outcome IN ('on_time', 'late_accepted')),
agg AS (SELECT window_start, merchant AS merchant_id, count(*) AS events_total, count(*) FILTER (kind = 'order_placed') AS orders_placed, count(*) FILTER (kind = 'order_paid') AS orders_paid,
    count(*) FILTER (kind = 'order_cancelled') AS orders_cancelled, count(*) FILTER (kind = 'order_refunded') AS orders_refunded,
    CAST(coalesce(sum(amount_minor) FILTER (kind = 'order_paid'), 0) AS BIGINT) AS gross_amount_minor, CAST(coalesce(sum(amount_minor) FILTER (kind = 'order_refunded'), 0) AS BIGINT) AS refunded_amount_minor,
    count(*) FILTER (outcome = 'late_accepted') AS late_events_applied, count(DISTINCT user_text) AS distinct_users, min(occurred_s) AS first_event_at, max(occurred_s) AS last_event_at,
    window_start + 3600 <= (SELECT max(occurred_s) - 18000 FROM applied) AS is_closed FROM applied GROUP BY window_start, merchant),
dead AS (SELECT o AS reason, partition, "offset", merchant AS key, left(coalesce(v, ''), 10000) AS payload,
    CASE o WHEN 'too_late' THEN 'window closed; watermark was ' || strftime(make_timestamp(watermark_before * 1000000), '%Y-%m-%dT%H:%M:%SZ') WHEN 'future_skew' THEN 'occurred_at ' || iso || ' is further ahead than 60s' ELSE problem END AS detail
    FROM records WHERE o IN ('malformed', 'contract_violation', 'validation_error', 'too_late', 'future_skew')),
ledger AS (SELECT event_id, arg_min(row, struct_pack(rank, arr, partition, "offset")) AS r FROM (SELECT 'evt-' || event_id AS event_id, arr, partition, "offset", CASE WHEN refusal IS NULL THEN 0 ELSE 1 END AS rank,
    struct_pack(m := CASE WHEN f = 6 THEN 'unknown' ELSE merchant END, w := CASE WHEN refusal IS NULL THEN occurred_s - occurred_s % 3600 ELSE 1706500000 END, d := CASE WHEN refusal IS NULL THEN 'applied' ELSE 'refused' END) AS row FROM nth
    WHERE n = 1 OR refusal IN ('contract_violation', 'validation_error')) GROUP BY event_id)
"""


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    if e.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism:  # one small file: else one task would decode all
        e = e.repartition(spark.sparkContext.defaultParallelism)
    f, text = F.col("event_id") % 40, lambda x: F.col(x).cast("string")
    kind = F.when(f == 5, "order_disputed").otherwise(F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for p in demo.TYPES.items() for x in p)), "event_type"), F.col("event_type")))
    occurred = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).cast("long")
    e = e.select("event_id", "user_id", f.alias("f"), kind.alias("kind"), occurred.alias("occurred_s"), F.round(F.col("value") * 100).cast("long").alias("amount"))
    late = F.when(F.col("event_id") % 10 == 3, 4000 + (F.col("event_id") * 7919) % 30_000).otherwise(0)
    e = e.withColumn("copy", F.explode(F.when(F.col("event_id") % 20 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    e = e.withColumns({"arr": F.col("occurred_s") + late + 500 * F.col("copy"), "merchant": F.concat(F.lit("m"), (F.col("user_id") % 6).cast("string"))})
    f, at = F.col("f"), F.timestamp_seconds("occurred_s")
    iso = F.when(f == 7, "yesterday").when(f == 16, F.date_format(at, "yyyyMMdd'T'HHmmss")).otherwise(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    user = F.when(f == 11, text("user_id")).when(f == 18, F.concat(F.lit('"\\u00e9'), text("user_id"), F.lit('"'))).otherwise(F.concat(F.lit('"u'), text("user_id"), F.lit('"')))
    amount = F.when(f == 8, "-1").when(f == 9, "19.99").when(f == 13, "null").when(f == 14, "1e3").otherwise(text("amount"))
    j = F.concat(
        F.lit('{"event_id":"evt-'), text("event_id"), F.lit('","event_type":"'), "kind", F.lit('","occurred_at":"'), iso, F.lit('",'), F.when(f == 6, "").otherwise(F.concat(F.lit('"order_id":"ord-'), text("event_id"), F.lit('",'))),
        F.lit('"merchant_id":"'), F.when(f == 6, "").otherwise(F.col("merchant")), F.lit('","user_id":'), user, F.lit(',"amount_minor":'), amount, F.lit(',"currency":"'), F.when(f == 10, "EURO").otherwise("EUR"),
        F.lit('","schema_version":'), F.when(f == 15, '"x"').otherwise("1"), F.when(f == 12, ',"loyalty_tier":"gold"').otherwise(""), F.lit("}"),
    )
    e = once(e, "_j", j.alias("j")).withColumn("j", F.col("_j.j"))
    value = F.when(f == 0, None).when(f == 1, F.substring("j", 1, 20)).when(f == 2, "[1, 2, 3]").when(f == 4, F.concat("j", F.lit(" x"))).when(F.col("event_id") % 4000 == 17, F.rpad("j", 1_000_001, " ")).otherwise(F.col("j"))
    value = F.when(f == 3, F.unhex(F.lit("FFFE41"))).otherwise(F.encode(value, "utf-8"))
    return e.select(F.lit("orders.v1").alias("topic"), F.pmod("user_id", F.lit(6)).cast("int").alias("partition"), (F.col("event_id") * 2 + F.col("copy")).alias("offset"), F.encode("merchant", "utf-8").alias("key"), value.alias("value"), F.timestamp_seconds("arr").alias("timestamp"))


def routed(spark: SparkSession, sf_dir: str) -> Routed:
    return process(raw(spark, sf_dir), SETTINGS, NOW)


def lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Three batches written one after another, each with the watermark and ledger of those before it; the last one twice."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    out, all_ = Lake(spark, os.path.join(shared, f"lake-{uuid.uuid4()}")), raw(spark, sf_dir)
    held: list[DataFrame] = []

    def hold(df: DataFrame) -> DataFrame:
        held.append(df.persist())
        return held[-1]

    for k, (a, b) in enumerate(zip((0, *CUTS), (*CUTS, 1 << 40), strict=True)):
        batch = all_.where(F.col("timestamp").between(F.timestamp_seconds(F.lit(a)), F.timestamp_seconds(F.lit(b - 1))))
        out.write(k, process(batch, SETTINGS, NOW, out.watermark(), out.read("ledger"), hold=hold))
        held.pop().unpersist()
    if out.write(k, process(batch, SETTINGS, NOW, out.watermark(), out.read("ledger"))):
        raise RuntimeError("a batch was written twice")
    return out


def _records(spark, d):
    problem = F.when(F.col("outcome") == "malformed", F.substring_index("problem", ": ", 1)).otherwise(F.col("problem"))
    seen = lambda c: F.when(F.col("outcome") != "malformed", F.col(c)).alias(c)
    return routed(spark, d).rows.select("partition", "offset", "outcome", problem.alias("problem"), seen("event_id"), F.array_join("unknown_fields", ",").alias("unknown_fields"), F.when(F.col("outcome").isin(*OUTCOMES), F.col("amount_minor")).alias("amount_minor"), "watermark_before")


def _dead(spark, d):
    detail = F.when(F.col("reason") == "malformed", F.substring_index("detail", ": ", 1)).otherwise(F.col("detail"))
    return routed(spark, d).dead_letters().select("reason", detail.alias("detail"), "partition", "offset", "key", "payload")


def _late(spark, d):
    return routed(spark, d).late().select("event_id", "merchant_id", "event_type", "window_start", "watermark_at", "lateness_seconds", "amount_minor", "payload")


def _lake_counts(spark, d):
    return spark.createDataFrame(sorted(lake(spark, d).state()["counts"].items()), "outcome string, n long")


def _proof(spark, d):
    done = lake(spark, d)
    return views.dedup_proof(done.aggregates(demo.WINDOW), done.read("ledger"))


AGG = ("window_start", "merchant_id", "events_total", "orders_placed", "orders_paid", "orders_cancelled", "orders_refunded", "gross_amount_minor", "refunded_amount_minor", "late_events_applied", "distinct_users", "first_event_at", "last_event_at", "is_closed", "updated_at")
_APPLIED = "o IN ('on_time', 'late_accepted', 'too_late', 'future_skew')"
QUERIES = {
    "engine_records": (_records, f"{RAW_SQL} SELECT partition, \"offset\", o AS outcome, problem, CASE WHEN o <> 'malformed' THEN 'evt-' || event_id END AS event_id, CASE WHEN o <> 'malformed' THEN CASE WHEN f = 12 THEN 'loyalty_tier' ELSE '' END END AS unknown_fields, CASE WHEN {_APPLIED} THEN amount_minor END AS amount_minor, watermark_before FROM records"),
    "engine_dead_letters": (_dead, f"{RAW_SQL} SELECT * FROM dead"),
    "engine_late_events": (_late, f"""{RAW_SQL} SELECT 'evt-' || event_id AS event_id, merchant AS merchant_id, kind AS event_type, window_start, watermark_before AS watermark_at, CAST(watermark_before - occurred_s AS DOUBLE) AS lateness_seconds, amount_minor,
        '{{"event_id":"evt-' || event_id || '","event_type":"' || kind || '","occurred_at":"' || strftime(make_timestamp(occurred_s * 1000000), '%Y-%m-%d %H:%M:%S+00:00') || '","order_id":"ord-' || event_id || '","merchant_id":"' || merchant || '","user_id":"' || user_text || '","amount_minor":' || coalesce(CAST(amount_minor AS VARCHAR), 'null') || ',"currency":"EUR","payment_method":null,"schema_version":1}}' AS payload FROM classed WHERE outcome = 'too_late'"""),
    "engine_ledger": (lambda s, d: routed(s, d).ledger().select("event_id", "merchant_id", "window_start", "disposition"), f"{RAW_SQL} SELECT event_id, r.m AS merchant_id, r.w AS window_start, r.d AS disposition FROM ledger"),
    "engine_checkpoints": (lambda s, d: routed(s, d).checkpoints("g").select("consumer_group", "topic", "partition", "last_offset", "watermark_at"), f"{RAW_SQL} SELECT 'g' AS consumer_group, 'orders.v1' AS topic, partition, max(\"offset\") AS last_offset, (SELECT max(occurred_s) - 18000 FROM applied) AS watermark_at FROM raw GROUP BY partition"),
    "lake_aggregates": (lambda s, d: lake(s, d).aggregates(demo.WINDOW).select(*AGG), f"{RAW_SQL} SELECT *, CAST({NOW} AS BIGINT) AS updated_at FROM agg"),
    "lake_counts": (_lake_counts, f"{RAW_SQL} SELECT o AS outcome, count(*) AS n FROM records GROUP BY o"),
    "lake_ledger": (lambda s, d: lake(s, d).read("ledger").select("event_id", "merchant_id", "window_start", "disposition"), f"{RAW_SQL} SELECT event_id, r.m AS merchant_id, r.w AS window_start, r.d AS disposition FROM ledger"),
    "lake_members": (lambda s, d: lake(s, d).read("window_user").select("window_start", "merchant_id", "user_id").distinct(), f"{RAW_SQL} SELECT DISTINCT window_start, merchant AS merchant_id, user_text AS user_id FROM applied"),
    "lake_offsets": (lambda s, d: lake(s, d).last_offsets().groupBy("topic").agg(F.max("last_offset").alias("last_offset"), F.max("watermark_at").alias("watermark_at")), f"{RAW_SQL} SELECT 'orders.v1' AS topic, (SELECT max(\"offset\") FROM (SELECT partition, arg_max(\"offset\", b) AS \"offset\" FROM (SELECT partition, (arr >= {CUTS[0]})::INT + (arr >= {CUTS[1]})::INT AS b, max(\"offset\") AS \"offset\" FROM raw GROUP BY 1, 2) GROUP BY partition)) AS last_offset, (SELECT max(occurred_s) - 18000 FROM applied) AS watermark_at"),
    "lake_dead_by_reason": (lambda s, d: lake(s, d).dead_letters().groupBy("reason").agg(F.count(F.lit(1)).alias("n")), f"{RAW_SQL} SELECT reason, count(*) AS n FROM dead GROUP BY reason"),
    "dedup_proof": (_proof, f"{RAW_SQL} SELECT (SELECT count(*) FROM applied) AS events_total, (SELECT count(*) FROM ledger) AS n_ledger, (SELECT count(*) FROM ledger) AS n_ids"),
}

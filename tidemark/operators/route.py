"""One batch of raw records to its five outputs, with the outcome of every record."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import Settings
from tidemark.functions.contract import Contract
from tidemark.functions.decode import decode, decode_key, once, preview
from tidemark.operators import aggregate
from tidemark.operators.dedup import mark_duplicates
from tidemark.operators.windowing import bucket, classify, slices

ORDER = ["timestamp", "partition", "offset"]
PLACE = ["topic", "partition", "offset"]


@dataclass
class Routed:
    """rows: every record with its outcome (malformed, contract_violation, validation_error, duplicate, or that of its window)."""

    rows: DataFrame
    settings: Settings
    now: int
    prior: int | None
    known: DataFrame | None = None  # the ledger before this batch

    @cached_property
    def summary(self) -> list:
        """One row for each topic, partition and outcome: its count, highest offset and latest applied event time, in one job."""
        applied = F.when(F.col("outcome").isin("on_time", "late_accepted"), F.col("occurred_s"))
        return self.rows.groupBy("topic", "partition", "outcome").agg(F.count(F.lit(1)).alias("n"), F.max("offset").alias("last_offset"), F.max(applied).alias("top")).collect()

    def counts(self) -> dict[str, int]:
        out: dict[str, int] = {}
        for r in self.summary:
            out[r.outcome] = out.get(r.outcome, 0) + r.n
        return out

    def watermark(self) -> int | None:
        """The watermark after the batch; never below the prior one."""
        tops = [r.top - self.settings.lateness_seconds for r in self.summary if r.top is not None]
        return max((x for x in (self.prior, *tops) if x is not None), default=None)

    def deltas(self) -> DataFrame:
        return aggregate.deltas(self.rows, updated=F.lit(self.now))

    def users(self) -> DataFrame:
        return aggregate.membership(self.rows)

    def ledger(self) -> DataFrame:
        """A row for every id that was handled for the first time, applied or refused; refused ones with the batch's clock as window.
        An id that is both in one batch counts as applied; of several refused records the first arrival tells the merchant."""
        new = F.col("outcome").isin("on_time", "late_accepted", "too_late", "future_skew")
        refused = F.col("outcome").isin("contract_violation", "validation_error") & (F.col("id_kind") == "str") & (F.col("event_id") != "")
        rows = self.rows.where(new | refused).select("event_id", F.struct(F.when(new, 0).otherwise(1).alias("rank"), *ORDER, F.coalesce(F.nullif("merchant_id", F.lit("")), F.lit("unknown")).alias("merchant_id"), F.when(new, F.col("window_start")).otherwise(F.lit(self.now)).alias("window_start")).alias("row"))
        out = rows.groupBy("event_id").agg(F.min("row").alias("row"))
        if self.known is not None:
            out = out.join(self.known.select("event_id"), "event_id", "left_anti")
        return out.select("event_id", "row.merchant_id", "row.window_start", F.timestamp_seconds(F.lit(self.now)).alias("seen_at"), F.when(F.col("row.rank") == 0, "applied").otherwise("refused").alias("disposition"))

    def late(self) -> DataFrame:
        mark = F.coalesce("watermark_before", F.lit(self.now))
        at = F.date_format("occurred_at", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        payload = F.to_json(F.struct("event_id", "event_type", F.concat(F.regexp_replace(at, r"\.000000$", ""), F.lit("+00:00")).alias("occurred_at"), "order_id", "merchant_id", "user_id", "amount_minor", "currency", "payment_method", "schema_version"), {"ignoreNullFields": "false"})
        late = (mark.cast("double") - F.unix_micros("occurred_at") / 1e6).alias("lateness_seconds")
        return self.rows.where("outcome = 'too_late'").select("event_id", "merchant_id", "event_type", "occurred_at", "window_start", mark.alias("watermark_at"), late, "amount_minor", payload.alias("payload"), F.timestamp_seconds(F.lit(self.now)).alias("recorded_at"))

    def dead_letters(self) -> DataFrame:
        iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ssXXX")
        detail = (
            F.when(F.col("outcome") == "too_late", F.concat(F.lit("window closed; watermark was "), F.coalesce(iso(F.timestamp_seconds("watermark_before")), F.lit("unset"))))
            .when(F.col("outcome") == "future_skew", F.concat(F.lit("occurred_at "), iso("occurred_at"), F.lit(f" is further ahead than {self.settings.skew_seconds}s")))
            .otherwise(F.col("problem"))
        )
        bad = self.rows.where(F.col("outcome").isin("malformed", "contract_violation", "validation_error", "too_late", "future_skew"))
        return bad.select(F.col("outcome").alias("reason"), detail.alias("detail"), *PLACE, decode_key().alias("key"), preview("value").alias("payload"), F.timestamp_seconds(F.lit(self.now)).alias("failed_at"), F.lit(None).cast("timestamp").alias("replayed_at")).dropDuplicates(PLACE)

    def checkpoints(self, group: str) -> DataFrame:
        last: dict[tuple, int] = {}
        for r in self.summary:
            last[r.topic, r.partition] = max(r.last_offset, last.get((r.topic, r.partition), r.last_offset))
        rows = [(*k, n, group, self.watermark()) for k, n in sorted(last.items())]
        return self.rows.sparkSession.createDataFrame(rows, "topic string, partition int, last_offset long, consumer_group string, watermark_at long")


def process(raw: DataFrame, settings: Settings, now: int, prior: int | None = None, ledger: DataFrame | None = None, contract: Contract | None = None, hold: Callable[[DataFrame], DataFrame] | None = None) -> Routed:
    """Decodes, checks, de-duplicates and classifies raw records (the Kafka source's columns). now: one clock for the batch, in
    seconds. The order of arrival is by timestamp, partition and offset. Every record keeps its row from end to end: what is
    refused or a duplicate moves no watermark. hold, where given, keeps the decoded records (persist, say)."""
    contract = contract or Contract()
    parts = slices(raw, F.unix_micros("timestamp"), settings.slices or int(raw.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    d = once(decode(raw), "_r", F.nullif(F.array_join(contract.violations(settings.strict_contract), "; "), F.lit("")).alias("bad"), contract.type_errors().alias("type"))
    refused = F.when(F.col("_d.malformed").isNotNull(), "malformed").when(F.col("_r.bad").isNotNull(), "contract_violation").when(F.col("_r.type").isNotNull(), "validation_error")
    columns = [*contract.event(), F.col("_d.unknown_fields").alias("unknown_fields"), contract.kind("event_id").alias("id_kind"), refused.alias("refused"), F.coalesce("_d.malformed", "_r.bad", "_r.type").alias("problem"), F.floor(F.col("_d.occurred_us") / 1e6).cast("long").alias("occurred_s")]
    d = once(d, "_o", *columns).select(*raw.columns, "_o.*")
    d = hold(d) if hold else d
    d = mark_duplicates(d.withColumn("_key", F.when(F.col("refused").isNull(), F.col("event_id"))), "_key", ORDER, ledger).drop("_key")
    fresh = F.col("refused").isNull() & F.col("duplicate").isNull()
    out = classify(d, ORDER, settings.window_seconds, settings.lateness_seconds, settings.skew_seconds, F.lit(now), prior=F.lit(prior).cast("long"), slice_col=parts, only=fresh)
    out = out.withColumn("outcome", F.coalesce("refused", F.when(F.col("duplicate").isNotNull(), "duplicate"), "outcome"))
    return Routed(out, settings, now, prior, ledger)

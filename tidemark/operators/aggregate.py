"""Aggregates by window and merchant, as deltas of a batch and folded over batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS = ("window_start", "merchant_id")
ADDITIVE = ("events_total", "orders_placed", "orders_paid", "orders_cancelled", "orders_refunded", "gross_amount_minor", "refunded_amount_minor", "late_events_applied")


def applied(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("outcome").isin("on_time", "late_accepted"))


def measures(occurred: str = "occurred_s") -> list:
    """The additive measures and the first and last event times, as aggregates of applied rows."""
    is_ = lambda kind: F.col("event_type") == f"order_{kind}"
    amount = lambda kind: F.coalesce(F.sum(F.when(is_(kind), F.coalesce("amount_minor", F.lit(0)))), F.lit(0))
    return [
        F.count(F.lit(1)).alias("events_total"),
        *(F.count_if(is_(kind)).alias(f"orders_{kind}") for kind in ("placed", "paid", "cancelled", "refunded")),
        amount("paid").alias("gross_amount_minor"),
        amount("refunded").alias("refunded_amount_minor"),
        F.count_if(F.col("outcome") == "late_accepted").alias("late_events_applied"),
        F.min(occurred).alias("first_event_at"),
        F.max(occurred).alias("last_event_at"),
    ]


def deltas(classified: DataFrame, occurred: str = "occurred_s", updated: Column | None = None) -> DataFrame:
    """The additive measures of one batch, its first and last event times, and when it was written, where that is given."""
    more = [] if updated is None else [F.max(updated).alias("updated_at")]
    return applied(classified).groupBy(*KEYS).agg(*measures(occurred), *more)


def membership(classified: DataFrame) -> DataFrame:
    """Distinct users of each window; null and empty users don't count."""
    return applied(classified).where(F.nullif("user_id", F.lit("")).isNotNull()).select(*KEYS, "user_id").distinct()


def _sums(parts: DataFrame) -> list:
    """How parts of a window's measures become the whole."""
    latest = [F.max("updated_at").alias("updated_at")] if "updated_at" in parts.columns else []
    return [*(F.sum(c).alias(c) for c in ADDITIVE), F.min("first_event_at").alias("first_event_at"), F.max("last_event_at").alias("last_event_at"), *latest]


def _derived(out: DataFrame, window: int, watermark: int | None) -> DataFrame:
    end = F.col("window_start") + window
    return out.withColumns({"window_end": end, "net_amount_minor": F.col("gross_amount_minor") - F.col("refunded_amount_minor"), "revision": (F.col("late_events_applied") + 1).cast("int"), "is_closed": F.coalesce(end <= F.lit(watermark).cast("long"), F.lit(False))})


def fold(parts: DataFrame, users: DataFrame, window: int, watermark: int | None) -> DataFrame:
    """Current aggregates from all deltas and memberships; updated_at is that of the last delta, if they have it."""
    total = parts.groupBy(*KEYS).agg(*_sums(parts))
    counted = users.select(*KEYS, "user_id").distinct().groupBy(*KEYS).agg(F.count(F.lit(1)).alias("distinct_users"))
    out = total.join(counted, list(KEYS), "left").withColumn("distinct_users", F.coalesce("distinct_users", F.lit(0)))
    return _derived(out, window, watermark)


def whole(classified: DataFrame, window: int, watermark: int | None, occurred: str = "occurred_s", updated: Column | None = None) -> DataFrame:
    """What fold() gives for a single batch, in one pass over its rows: measures by user first, then by window."""
    more = [] if updated is None else [F.max(updated).alias("updated_at")]
    by_user = applied(classified).groupBy(*KEYS, F.nullif("user_id", F.lit("")).alias("user_id")).agg(*measures(occurred), *more)
    return _derived(by_user.groupBy(*KEYS).agg(*_sums(by_user), F.count("user_id").alias("distinct_users")), window, watermark)

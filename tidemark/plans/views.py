"""Read side: rollups, health, top lists and dead-letter replay over the output tables (times in seconds)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DAY = 86_400


def hourly(agg: DataFrame) -> DataFrame:
    sums = ("orders_paid", "gross_amount_minor", "refunded_amount_minor", "net_amount_minor", "late_events_applied")
    hour = F.col("window_start") - F.pmod("window_start", F.lit(3600))
    return agg.groupBy(hour.alias("hour_start"), "merchant_id").agg(*(F.sum(c).alias(c) for c in sums), F.count_if(~F.col("is_closed")).alias("open_windows"))


def health(agg: DataFrame, late: DataFrame, dead: DataFrame, now: int) -> DataFrame:
    """One row; late needs recorded_s, dead failed_s, agg updated_at."""
    one = agg.agg(F.max("window_start").alias("newest_window"), F.max("updated_at").alias("last_write"), (F.lit(now) - F.max("updated_at")).alias("seconds_since_write"), F.count_if(~F.col("is_closed")).alias("open_windows"), F.sum("late_events_applied").alias("late_events_applied"))
    hour = lambda df, c, name: df.agg(F.count_if(F.col(c) > now - 3600).alias(name))
    return one.crossJoin(hour(late, "recorded_s", "too_late_last_hour")).crossJoin(hour(dead, "failed_s", "dlq_last_hour"))  # one row each


def newest(agg: DataFrame, n: int = 20) -> DataFrame:
    return agg.orderBy(F.desc("window_start"), "merchant_id").limit(n)


def restated(agg: DataFrame, n: int = 50) -> DataFrame:
    """Windows changed after they were first counted, the last written first."""
    return agg.where("revision > 1").orderBy(F.desc("updated_at"), F.desc("window_start"), "merchant_id").limit(n)


def newest_late(late: DataFrame, n: int = 20) -> DataFrame:
    """The last late events; halves of a second are rounded to even."""
    return late.orderBy(F.desc("recorded_s"), F.desc("event_id")).limit(n).select("event_id", "merchant_id", "window_start", F.rint("lateness_seconds").alias("late_s"), "recorded_s")


def late_analysis(late: DataFrame) -> DataFrame:
    return late.groupBy("merchant_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("lateness_seconds")).alias("avg_lateness"), F.percentile("lateness_seconds", 0.99).alias("p99_lateness"))


def dead_by_reason(dead: DataFrame, since: int | None = None) -> DataFrame:
    """Dead letters by reason, the most frequent first; since: only those that failed after it (now - DAY, say)."""
    rows = dead if since is None else dead.where(F.col("failed_s") > since)
    return rows.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.max("failed_s").alias("last_failed")).orderBy(F.desc("n"), "reason")


def dedup_proof(agg: DataFrame, ledger: DataFrame) -> DataFrame:
    """One row: events in windows, rows of the ledger and different ids among them, which are as many."""
    return agg.agg(F.sum("events_total").alias("events_total")).crossJoin(ledger.agg(F.count(F.lit(1)).alias("n_ledger"), F.countDistinct("event_id").alias("n_ids")))  # one row each


def replay(dead: DataFrame, publish: Callable[[DataFrame], None] | None = None, reason: str | None = None, limit: int = 100, mark: Callable[[DataFrame], None] | None = None) -> DataFrame:
    """The oldest dead letters that were not replayed; without publish only shown (a dry run). mark, called after publish, notes
    that they were sent (Lake.mark_replayed), so that the next call takes others."""
    out = dead.where(F.col("replayed_at").isNull())
    out = (out.where(F.col("reason") == reason) if reason else out).orderBy("failed_at", "topic", "partition", "offset").limit(limit)
    if publish:
        out = dead.sparkSession.createDataFrame(out.collect(), out.schema)  # limit rows at most: what is published is what is marked
        publish(out)
        if mark:
            mark(out)
    return out

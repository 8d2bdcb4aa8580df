"""Event-time windows and the per-event watermark, as a closed form.

The watermark before an event is the largest event time before it in arrival order, among events that are not too far in
the future, less the allowed lateness. Too-late events can't raise it, so no sequential state is needed: a prefix maximum does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OUTCOMES = ("on_time", "late_accepted", "too_late", "future_skew")


def bucket(seconds: Column, size: int) -> Column:
    """Start of the epoch-aligned tumbling window, for seconds as a whole number."""
    return seconds - F.pmod(seconds, F.lit(size))


def slices(df: DataFrame, at: Column, n: int) -> Column | None:
    """A number for each row that rises with `at` (a long) and splits df into n parts of about equal size, for prefix_max.

    The bounds are approximate percentiles, n - 1 numbers on the driver, so batches of any time span are split alike. Null
    times come first. None where there is nothing to split.
    """
    if n < 2:
        return None
    bounds = df.agg(F.percentile_approx(at, [k / n for k in range(1, n)], 10 * n)).first()[0]
    if not bounds:
        return None
    known = F.array(*(F.lit(b) for b in sorted(set(bounds))))
    return F.size(F.filter(known, lambda b: b < F.coalesce(at, F.lit(-(1 << 62)))))


def prefix_max(df: DataFrame, value: Column, order: list[str], name: str, slice_col: Column | None = None) -> DataFrame:
    """df with the largest value before each row in `order` (all rows before it, not itself).

    With slice_col, which must not decrease along the order, each slice is one window partition and only one row a slice goes
    through a single task; without it, all rows do.
    """
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    if slice_col is None:
        return df.withColumn(name, F.max(value).over(before(Window.orderBy(*order))))
    df = df.withColumns({"_slice": slice_col, "_value": value})
    tops = df.groupBy("_slice").agg(F.max("_value").alias("_top")).withColumn("_base", F.max("_top").over(before(Window.orderBy("_slice")))).drop("_top")
    out = df.join(F.broadcast(tops), "_slice").withColumn(name, F.greatest(F.max("_value").over(before(Window.partitionBy("_slice").orderBy(*order))), "_base"))  # tops: one row a slice
    return out.drop("_slice", "_value", "_base")


def classify(df: DataFrame, order: list[str], window: int, lateness: int, skew: int, now: Column, occurred: str = "occurred_s", prior: Column | None = None, slice_col: Column | None = None, only: Column | None = None) -> DataFrame:
    """df (one row for each new event, times in seconds) with window_start, watermark_before and outcome.

    prior: the watermark carried over from earlier batches. only: which rows count (null: all); the others move nothing and
    get no watermark and no outcome, nor does a row whose event time is null.
    """
    t = F.col(occurred)
    only = F.lit(True) if only is None else only
    df = df.withColumn("_far", F.when(only, t > now + skew))
    df = prefix_max(df, F.when(~F.col("_far"), t), order, "_seen", slice_col)
    df = df.withColumn("watermark_before", F.when(only, F.greatest(F.col("_seen") - lateness, prior if prior is not None else F.lit(None).cast("long"))))
    start, mark = bucket(t, window), F.col("watermark_before")
    outcome = F.when(F.col("_far"), "future_skew").when(start + window <= mark, "too_late").when(t < mark, "late_accepted").when(t.isNotNull() & only, "on_time")
    return df.withColumns({"window_start": start, "outcome": outcome}).drop("_far", "_seen")


def idle_watermark(prior: int | None, now: int, last_record: int, idle: int, lateness: int) -> int | None:
    """The watermark of a quiet input: after `idle` seconds without records, now less the lateness, if that is later."""
    if now - last_record < idle:
        return prior
    return max(now - lateness, prior) if prior is not None else now - lateness

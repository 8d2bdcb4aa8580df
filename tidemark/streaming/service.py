"""Structured Streaming around one batch function, and the coarser native form."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tidemark.config import Settings
from tidemark.operators.route import process
from tidemark.operators.windowing import idle_watermark
from tidemark.sources.lake import Lake

#: The topic of rows that only tell that time goes on.
TICK = "_tick"
#: Gauges read the tables, so they are not taken more often than this.
GAUGE_SECONDS = 60


def batch_function(lake: Lake, settings: Settings, clock: Callable[[], float] = time.time, publish: Callable[[DataFrame], None] | None = None, metrics: Metrics | None = None) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: route, write, publish dead letters, then mark. What a crash leaves behind has no marker; a batch with a marker
    is skipped. The watermark is that of the last commit; a batch without records moves it as time does on a quiet input, and
    is only written if it does. Now and then the ledger is purged."""
    began, purged = int(clock()), [int(clock())]

    def run(raw: DataFrame, batch_id: int) -> None:
        state = lake.state()
        if any(a <= batch_id <= b for a, b in state["batches"]):
            return
        now, prior = int(clock()), state["watermark"]
        raw = raw.where(F.col("topic") != TICK).persist()
        held: list[DataFrame] = []

        def hold(df: DataFrame) -> DataFrame:
            held.append(df.persist())
            return held[-1]

        try:
            if raw.isEmpty():
                last = state["last_record"] if state["last_record"] is not None else began
                moved = idle_watermark(prior, now, last, settings.idle_seconds, settings.lateness_seconds)
                if moved == prior:
                    return
                prior = moved
            routed = process(raw, settings, now, prior, lake.read("ledger"), hold=hold)
            lake.write(batch_id, routed, settings.consumer_group, publish)
        except Exception:
            if metrics:
                metrics.flush_failures += 1
            raise
        finally:
            for df in (raw, *held):
                df.unpersist()
        if metrics:
            metrics.observe(lake, settings, now)
        if now - purged[0] >= settings.purge_seconds:
            lake.purge(now, settings.ledger_hours)
            purged[0] = now

    return run


def with_ticks(stream: DataFrame) -> DataFrame:
    """The raw records and a row a second, so that batches come while the input is quiet."""
    ticks = stream.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).option("numPartitions", 1).load()
    nothing = F.lit(None).cast("binary")
    return stream.unionByName(ticks.select(F.lit(TICK).alias("topic"), F.lit(0).alias("partition"), F.col("value").alias("offset"), nothing.alias("key"), nothing.alias("value"), "timestamp"))


def start(stream: DataFrame, lake: Lake, settings: Settings, checkpoint: str, trigger: dict | None = None, **options) -> StreamingQuery:
    """Without a trigger: a batch each flush_seconds, with ticks; with one, say availableNow, none are added."""
    if trigger is None:
        stream, trigger = with_ticks(stream), {"processingTime": f"{int(settings.flush_seconds * 1000)} milliseconds"}
    return stream.writeStream.foreachBatch(batch_function(lake, settings, **options)).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def native(events: DataFrame, settings: Settings) -> DataFrame:
    """Windows by Spark's own watermark, which moves between batches only and drops what is too late without a trace: for load tests, not
    for the exact figures. events: event_id, occurred_at, merchant_id, event_type, amount_minor."""
    late, size = f"{settings.lateness_seconds} seconds", f"{settings.window_seconds} seconds"
    once = events.withWatermark("occurred_at", late).dropDuplicatesWithinWatermark(["event_id"])
    out = once.groupBy(F.window("occurred_at", size), "merchant_id").agg(F.count(F.lit(1)).alias("events_total"), F.sum(F.when(F.col("event_type") == "order_paid", F.col("amount_minor"))).alias("gross_amount_minor"))
    return out.select(F.col("window.start").alias("window_start"), "merchant_id", "events_total", "gross_amount_minor")


class Metrics(StreamingQueryListener):
    """Rows, batches, seconds and state rows by query name; counts by outcome, flushes and gauges of the lake."""

    def __init__(self) -> None:
        self.values: dict[str, dict[str, float]] = {}
        self.events: dict[str, int] = {}
        self.gauges: dict[str, float] = {}
        self.flushes = self.flush_failures = 0
        self.gauged: int | None = None

    def observe(self, lake: Lake, settings: Settings, now: int) -> None:
        """After a commit: outcomes since the first batch, how far the watermark is behind, and how much is open."""
        state = lake.state()
        self.flushes += 1
        self.events = dict(state["counts"])
        mark = state["watermark"]
        if mark is not None:
            self.gauges["watermark_lag_seconds"] = now - mark
        if self.gauged is not None and now - self.gauged < GAUGE_SECONDS:
            return
        self.gauged = now
        users, parts = lake.read("window_user"), lake.read("aggregate_delta")
        open_ = F.lit(True) if mark is None else F.col("window_start") + settings.window_seconds > mark
        self.gauges["open_windows"] = parts.where(open_).select("window_start", "merchant_id").distinct().count()
        self.gauges["tracked_users"] = users.where(open_).select("window_start", "merchant_id", "user_id").distinct().count()

    def text(self) -> str:
        """All values in the text form that scrapers read."""
        out = [f'tidemark_events_total{{outcome="{k}"}} {n}' for k, n in sorted(self.events.items())]
        out += [f"tidemark_flushes_total {self.flushes}", f"tidemark_flush_failures_total {self.flush_failures}"]
        out += [f"tidemark_{k} {v}" for k, v in sorted(self.gauges.items())]
        out += [f'tidemark_query_{k}{{query="{q}"}} {v}' for q, d in sorted(self.values.items()) for k, v in sorted(d.items())]
        return "\n".join(out) + "\n"

    def serve(self, port: int) -> ThreadingHTTPServer:
        """Answers scrapes on a thread of its own, until shutdown() of what is returned."""
        metrics = self

        class Handler(BaseHTTPRequestHandler):
            def do_GET(self) -> None:  # noqa: N802
                body = metrics.text().encode()
                self.send_response(200)
                self.send_header("Content-Type", "text/plain; version=0.0.4")
                self.send_header("Content-Length", str(len(body)))
                self.end_headers()
                self.wfile.write(body)

            def log_message(self, *args) -> None:
                pass

        server = ThreadingHTTPServer(("", port), Handler)
        threading.Thread(target=server.serve_forever, daemon=True).start()
        return server

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.values.setdefault(str(event.name or event.id), {"rows": 0, "batches": 0, "seconds": 0.0, "state_rows": 0})

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        v = self.values.setdefault(str(p.name or p.id), {"rows": 0, "batches": 0, "seconds": 0.0, "state_rows": 0})
        v["rows"] += p.numInputRows
        v["batches"] += 1
        v["seconds"] += p.durationMs.get("triggerExecution", 0) / 1000
        v["state_rows"] = sum(s.numRowsTotal for s in p.stateOperators)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


def register_metrics(spark: SparkSession) -> Metrics:
    metrics = Metrics()
    spark.streams.addListener(metrics)
    return metrics

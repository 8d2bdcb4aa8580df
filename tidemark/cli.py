"""Command line: python -m tidemark.cli run | health | replay-dlq | produce | scenario."""

from __future__ import annotations

import argparse
import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import Settings
from tidemark.plans import views
from tidemark.sources import records, synthetic
from tidemark.sources.lake import Lake
from tidemark.streaming import service


def session() -> SparkSession:
    return SparkSession.builder.appName("tidemark").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def writer(target: str, settings: Settings, topic: str) -> Callable[[DataFrame], None]:
    """Into a folder as Parquet, or to Kafka."""
    if target == "kafka":
        return lambda df: records.kafka_sink(df.select("key", "value", *(["headers"] if "headers" in df.columns else [])), settings, topic)
    return lambda df: df.write.mode("append").parquet(target)


def produce(spark: SparkSession, write: Callable[[DataFrame], None], rate: float, duration: float, faults: synthetic.Faults, seed: int = 42, clock: Callable[[], float] = time.time, sleep: Callable[[float], None] = time.sleep) -> int:
    """Raw records at a fixed rate for so many seconds (0: on and on), a second's worth at a time; how many."""
    began, done = clock(), 0
    start = int(began)
    while not duration or done < rate * duration:
        due = int(min(rate * (clock() - began + 1), rate * duration if duration else float("inf")))
        if due > done:
            write(synthetic.records(spark, due, start, rate, faults, seed, first=done).drop("fault"))
            done = due
        if not duration or done < rate * duration:
            sleep(max(0.0, began + done / rate - clock()))
    return done


def health(lake: Lake, settings: Settings, now: int) -> dict:
    late, dead, agg = lake.read("late_events"), lake.dead_letters(), lake.aggregates(settings.window_seconds)
    if agg is None:
        return {}
    return views.health(agg, late.withColumn("recorded_s", F.unix_seconds("recorded_at")), dead.withColumn("failed_s", F.unix_seconds("failed_at")), now).first().asDict()


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="tidemark")
    sub = out.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="read, aggregate and write until stopped")
    run.add_argument("--source", default="kafka", help="kafka, or a folder of Parquet records")
    run.add_argument("--lake", required=True)
    run.add_argument("--checkpoint", required=True)
    run.add_argument("--dlq", default="", help="kafka, a folder, or nothing")
    run.add_argument("--once", action="store_true", help="stop when all that is there is read")
    run.add_argument("--metrics-port", type=int, default=0)
    for name, text in (("health", "print the health view"), ("replay-dlq", "send dead letters again")):
        p = sub.add_parser(name, help=text)
        p.add_argument("--lake", required=True)
    p.add_argument("--reason")
    p.add_argument("--limit", type=int, default=100)
    p.add_argument("--target", default="", help="kafka or a folder; nothing: only show them")
    for name, text in (("produce", "records at a fixed rate"), ("scenario", "a fixed set of records")):
        p = sub.add_parser(name, help=text)
        p.add_argument("--target", default="kafka", help="kafka or a folder")
        if name == "produce":
            p.add_argument("--rate", type=float, default=100)
            p.add_argument("--duration", type=float, default=60, help="seconds; 0: until stopped")
            p.add_argument("--seed", type=int, default=42)
            for fault in ("duplicate", "late", "very_late", "malformed"):
                p.add_argument(f"--{fault.replace('_', '-')}-rate", type=float, default=getattr(synthetic.Faults, fault))
        else:
            p.add_argument("name", choices=sorted(synthetic.SCENARIOS))
            p.add_argument("--count", type=int, default=2000)
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None, settings: Settings | None = None) -> int:
    a, settings = parser().parse_args(argv), settings or Settings.from_env()
    spark = spark or session()
    now = int(time.time())
    if a.command == "run":
        lake, metrics = Lake(spark, a.lake), service.register_metrics(spark) if a.metrics_port else None
        server = metrics.serve(a.metrics_port) if metrics else None
        stream = records.kafka_stream(spark, settings) if a.source == "kafka" else records.file_stream(spark, a.source)
        send = writer(a.dlq, settings, settings.dlq_topic) if a.dlq else None
        publish = (lambda df: send(records.dead_letter_messages(df))) if send else None
        query = service.start(stream, lake, settings, a.checkpoint, {"availableNow": True} if a.once else None, publish=publish, metrics=metrics)
        try:
            query.awaitTermination()
        except KeyboardInterrupt:
            query.stop()
        finally:
            if server:
                server.shutdown()
    elif a.command == "health":
        print(json.dumps(health(Lake(spark, a.lake), settings, now), indent=2, default=str))
    elif a.command == "replay-dlq":
        lake = Lake(spark, a.lake)
        dead = lake.dead_letters()
        send = writer(a.target, settings, settings.topic) if a.target else None
        rows = [] if dead is None else views.replay(dead, (lambda df: send(records.replayed_messages(df))) if send else None, a.reason, a.limit, lambda df: lake.mark_replayed(df, now)).collect()
        for r in rows:
            print(f"{'' if send else '[dry run] '}{r.topic}/{r.partition}/{r.offset} {r.reason}")
        print(f"{len(rows)} dead letters {'sent' if send else 'listed'}")
    else:
        write = writer(a.target, settings, settings.topic)
        if a.command == "produce":
            faults = synthetic.Faults(a.duplicate_rate, a.late_rate, a.very_late_rate, a.malformed_rate)
            print(f"produced {produce(spark, write, a.rate, a.duration, faults, a.seed)} records")
        else:
            write(synthetic.records(spark, a.count, now, faults=synthetic.SCENARIOS[a.name]).drop("fault"))
            print(f"scenario {a.name}: produced {a.count} records")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

"""A transactional sink on plain tables: each batch overwrites its own folders, then a marker makes it visible."""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.aggregate import KEYS, fold
from tidemark.operators.route import PLACE, Routed

# Names of the measures and columns stand in outputs.
TABLES = {
    "aggregate_delta": "window_start long, merchant_id string, events_total long, orders_placed long, orders_paid long, orders_cancelled long, orders_refunded long, gross_amount_minor long, refunded_amount_minor long, late_events_applied long, first_event_at long, last_event_at long, updated_at int",
    "ledger": "event_id string, merchant_id string, window_start long, seen_at timestamp, disposition string",
    "window_user": "window_start long, merchant_id string, user_id string",
    "late_events": "event_id string, merchant_id string, event_type string, occurred_at timestamp, window_start long, watermark_at long, lateness_seconds double, amount_minor long, payload string, recorded_at timestamp",
    "dlq_events": "reason string, detail string, topic string, partition int, offset long, key string, payload string, failed_at timestamp, replayed_at timestamp",
    "checkpoint": "topic string, partition int, last_offset long, consumer_group string, watermark_at long",
}
#: So many markers are written into one.
COMPACT_AT = 100


class Lake:
    """Tables under root/<table>/batch_id=N and markers under root/_commits. Readers see only batches with a marker.

    A marker holds runs of batch ids, the watermark, counts by outcome and clocks of all of them. One writer at a time. A
    reader keeps the markers that it has seen, and only reads new ones.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.seen = spark, root.rstrip("/"), {}

    def _path(self, name: str = ""):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _write_file(self, name: str, content: dict) -> None:
        """Whole or not at all; a file of that name is replaced."""
        folder, _, last = name.rpartition("/")
        fs, hidden = self._path(f"{folder}/.{last}.tmp")
        out = fs.create(hidden, True)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        target = self._path(name)[1]
        if fs.exists(target):
            fs.delete(target, False)
        if not fs.rename(hidden, target):
            raise OSError(f"{name} could not be written")

    def _read_files(self, folder: str) -> dict[str, dict]:
        fs, path = self._path(folder)
        if not fs.exists(path):
            return {}
        out, now = {}, set()
        for status in fs.listStatus(path):
            name = status.getPath().getName()
            if name.startswith(".") or not name.endswith(".json"):
                continue
            stamp = (folder, name, status.getModificationTime(), status.getLen())
            if stamp not in self.seen:
                stream = fs.open(status.getPath())
                try:
                    self.seen[stamp] = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
                finally:
                    stream.close()
            out[name] = self.seen[stamp]
            now.add(stamp)
        self.seen = {k: v for k, v in self.seen.items() if k[0] != folder or k in now}
        return out

    def markers(self) -> list[dict]:
        """All markers; where one takes in others that are still there, it alone."""
        found = sorted(self._read_files("_commits").values(), key=lambda m: -sum(b - a for a, b in m["batches"]))
        out: list[dict] = []
        for m in found:
            if not any(all(any(c <= a and b <= d for c, d in o["batches"]) for a, b in m["batches"]) for o in out):
                out.append(m)
        return out

    def state(self) -> dict:
        """batches (runs of ids), watermark, counts, at and last_record over all markers; None where nothing is committed."""
        found = self.markers()
        most = lambda name: max((m[name] for m in found if m.get(name) is not None), default=None)
        counts: dict[str, int] = {}
        for m in found:
            for k, n in m["counts"].items():
                counts[k] = counts.get(k, 0) + n
        runs: list[list[int]] = []
        for a, b in sorted(tuple(r) for m in found for r in m["batches"]):
            if runs and a <= runs[-1][1] + 1:
                runs[-1][1] = max(runs[-1][1], b)
            else:
                runs.append([a, b])
        return {"batches": runs, "watermark": most("watermark"), "counts": counts, "at": most("at"), "last_record": most("last_record")}

    def committed(self, batch_id: int) -> bool:
        return any(a <= batch_id <= b for a, b in self.state()["batches"])

    def watermark(self) -> int | None:
        return self.state()["watermark"]

    def read(self, table: str) -> DataFrame | None:
        """Rows of committed batches, as a filter on the folders; None before the first commit. Of the ledger, those that are not purged."""
        runs = self.state()["batches"]
        first = self._read_files("_purged").get(f"{table}.json", {}).get("before", 0)
        fs, path = self._path(table)
        if not runs or not fs.exists(path):
            return None
        among = F.lit(False)
        for a, b in runs:
            if b >= first:
                among = among | F.col("batch_id").between(max(a, first), b)
        return self.spark.read.schema(f"{TABLES[table]}, batch_id int").parquet(f"{self.root}/{table}").where(among)

    def table(self, table: str) -> DataFrame:
        """As read(), but an empty table before the first commit."""
        rows = self.read(table)
        return self.spark.createDataFrame([], f"{TABLES[table]}, batch_id int") if rows is None else rows

    def register(self, window: int) -> list[str]:
        """Temporary views for SQL, with or without commits: every table, and agg_orders_minute, the aggregates as they are now.
        Their names; they show what is committed when this is called."""
        for name in TABLES:
            self.table(name).createOrReplaceTempView(name)
        dead = self.dead_letters()
        (self.table("dlq_events") if dead is None else dead).createOrReplaceTempView("dlq_events")
        fold(self.table("aggregate_delta"), self.table("window_user"), window, self.watermark()).createOrReplaceTempView("agg_orders_minute")
        return [*TABLES, "agg_orders_minute"]

    def write(self, batch_id: int, routed: Routed, group: str = "tidemark", publish: Callable[[DataFrame], None] | None = None) -> bool:
        """Tables first, then the dead letters are published, then the marker: a publisher that fails leaves the batch to be done
        again, and its letters are sent at least once. False if the batch is committed already: a replay changes nothing."""
        if self.committed(batch_id):
            return False
        routed.rows = routed.rows.persist()
        try:
            counts = routed.counts()  # the first job: it fills what is persisted
            parts = (routed.deltas(), routed.ledger(), routed.users(), routed.late(), routed.dead_letters(), routed.checkpoints(group))

            def put(table: str, df: DataFrame) -> None:
                df.write.mode("overwrite").parquet(f"{self.root}/{table}/batch_id={batch_id}")

            with ThreadPoolExecutor(len(TABLES)) as pool:  # side by side: each is a short job
                for done in [pool.submit(inheritable_thread_target(self.spark)(put), table, df) for table, df in zip(TABLES, parts, strict=True)]:
                    done.result()
            if publish:
                publish(self.spark.read.parquet(f"{self.root}/dlq_events/batch_id={batch_id}"))
            self._write_file(f"_commits/{batch_id}.json", {"batches": [[batch_id, batch_id]], "watermark": routed.watermark(), "counts": counts, "at": routed.now, "last_record": routed.now if counts else None})
        finally:
            routed.rows.unpersist()
        if len(self._read_files("_commits")) > COMPACT_AT:
            self.compact()
        return True

    def compact(self) -> None:
        """All markers into one, which is there before the others go."""
        names, whole = list(self._read_files("_commits")), self.state()
        name = f"to-{whole['batches'][-1][1]}.json"
        self._write_file(f"_commits/{name}", whole)
        for old in names:
            if old != name:
                fs, path = self._path(f"_commits/{old}")
                fs.delete(path, False)

    def purge(self, now: int, hours: int) -> int:
        """Forgets ledger batches in which every id was seen over so many hours ago. What is forgotten is written down first; then folders go. Returns how many."""
        ledger = self.read("ledger")
        if ledger is None:
            return 0
        seen = ledger.groupBy("batch_id").agg(F.max("seen_at").alias("m"))
        kept = seen.where(F.col("m") >= F.timestamp_seconds(F.lit(now - hours * 3600))).agg(F.min("batch_id")).first()[0]
        before = kept if kept is not None else self.state()["batches"][-1][1] + 1
        self._write_file("_purged/ledger.json", {"before": before})
        fs, path = self._path("ledger")
        gone = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith("batch_id=") and int(s.getPath().getName().partition("=")[2]) < before]
        for old in gone:
            fs.delete(old, True)
        return len(gone)

    def aggregates(self, window: int, touched_by: int | None = None) -> DataFrame | None:
        """Aggregates of all windows, or of those that a batch added to."""
        parts, users = self.read("aggregate_delta"), self.read("window_user")
        if parts is None:
            return None
        if touched_by is not None:
            keys = parts.where(F.col("batch_id") == touched_by).select(*KEYS).distinct()
            parts, users = parts.join(keys, list(KEYS), "left_semi"), users.join(keys, list(KEYS), "left_semi")
        return fold(parts, users, window, self.watermark())

    def closed_by(self, batch_id: int, window: int) -> DataFrame | None:
        """The aggregates of windows that the watermark of that batch was the first to pass."""
        marks = self.read("checkpoint")
        out = self.aggregates(window)
        if out is None:
            return None
        before, after = marks.agg(F.max(F.when(F.col("batch_id") < batch_id, F.col("watermark_at"))), F.max(F.when(F.col("batch_id") <= batch_id, F.col("watermark_at")))).first()
        first = F.lit(True) if before is None else F.col("window_end") > before
        return out.where(F.lit(after is not None) & (F.col("window_end") <= F.lit(after)) & first)

    def last_offsets(self) -> DataFrame | None:
        rows = self.read("checkpoint")
        return None if rows is None else rows.groupBy("consumer_group", "topic", "partition").agg(F.max_by("last_offset", "batch_id").alias("last_offset"), F.max_by("watermark_at", "batch_id").alias("watermark_at"))

    def dead_letters(self) -> DataFrame | None:
        """The dead letter of each place, once, with the time of its last replay."""
        rows = self.read("dlq_events")
        if rows is None:
            return None
        kept = [c for c in rows.columns if c not in (*PLACE, "replayed_at")]
        rows = rows.groupBy(*PLACE).agg(F.min_by(F.struct(*kept), "batch_id").alias("r")).select("r.*", *PLACE)
        fs, path = self._path("dlq_replays")
        if not fs.exists(path):
            return rows.withColumn("replayed_at", F.lit(None).cast("timestamp"))
        sent = self.spark.read.parquet(f"{self.root}/dlq_replays").groupBy(*PLACE).agg(F.max("replayed_at").alias("replayed_at"))
        return rows.join(sent, PLACE, "left")

    def mark_replayed(self, rows: DataFrame, now: int) -> None:
        """Notes that these dead letters were sent again; nothing else of them changes."""
        rows.select(*PLACE, F.timestamp_seconds(F.lit(now)).alias("replayed_at")).write.mode("append").parquet(f"{self.root}/dlq_replays")

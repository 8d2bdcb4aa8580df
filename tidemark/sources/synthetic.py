"""Seeded order events with faults, from spark.range and hashes: any number of rows, the same for the same seed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Default rates, and those of the scenarios below, with which outcomes can be compared.
@dataclass(frozen=True)
class Faults:
    duplicate: float = 0.05
    late: float = 0.08
    very_late: float = 0.01
    malformed: float = 0.005
    unknown_type: float = 0.003
    skew: float = 0.002
    unknown_field: float = 0.01

    def __post_init__(self) -> None:
        if self.duplicate + self.late + self.very_late + self.malformed + self.unknown_type + self.skew > 1:
            raise ValueError("fault rates leave no clean events")


SCENARIOS = {
    "clean": Faults(0, 0, 0, 0, 0, 0),
    "duplicates": Faults(duplicate=0.35, late=0.02, very_late=0, malformed=0),
    "late-burst": Faults(duplicate=0.02, late=0.35, very_late=0.15, malformed=0),
    "poison": Faults(duplicate=0.02, late=0.05, malformed=0.15, unknown_type=0.08, skew=0.05),
}
#: The first three can't be read as an object; the others break the contract by an empty key, a fraction of a cent and a month too many.
POISON = (
    '{"order_id": "p-1", "merchant_id": "m1",}',
    "42",
    '{"event_id": "p-2", "event_type": "order_paid"} and more',
    '{"event_id": "p-3", "event_type": "order_placed", "occurred_at": "2026-01-05T10:00:00Z", "order_id": "p-3", "merchant_id": ""}',
    '{"event_id": "p-4", "event_type": "order_paid", "occurred_at": "2026-01-05T10:00:00Z", "order_id": "p-4", "merchant_id": "m2", "amount_minor": 12.5}',
    '{"event_id": "p-5", "event_type": "order_refunded", "occurred_at": "2026-13-05T10:00:00Z", "order_id": "p-5", "merchant_id": "m3"}',
)


def records(spark: SparkSession, rows: int, start: int, rate: float = 200.0, faults: Faults | None = None, seed: int = 7, merchants: int = 6, users: int = 500, partitions: int = 6, first: int = 0) -> DataFrame:
    """Raw records (and the kind of fault each has); row i arrives start + i / rate seconds after the epoch. A duplicate repeats
    one of the 200 rows before it. first: rows before that one are left out, so that a run can come in parts."""
    faults = faults or Faults()
    draw = lambda salt, n, i="i": F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), F.col(i)), F.lit(n))
    edges, at = [], 0.0
    for name in ("duplicate", "malformed", "unknown_type", "skew", "very_late", "late"):
        at += getattr(faults, name)
        edges.append((name, round(at * 1_000_000)))

    def kind(i: str) -> Column:
        out, roll = F.lit("clean"), draw("roll", 1_000_000, i)
        for name, edge in reversed(edges):
            out = F.when(roll < edge, name).otherwise(out)
        return out

    d = spark.range(first, rows).withColumnRenamed("id", "i").withColumn("fault", kind("i"))
    d = d.withColumn("src", F.when((F.col("fault") == "duplicate") & (F.col("i") > 0), F.greatest(F.col("i") - 1 - draw("back", 200), F.lit(0))).otherwise(F.col("i"))).withColumn("own", kind("src"))
    shift = F.when(F.col("own") == "skew", 120 + draw("s", 781, "src")).when(F.col("own") == "very_late", -400 - draw("v", 1401, "src")).when(F.col("own") == "late", -30 - draw("l", 151, "src")).otherwise(0)
    roll = draw("type", 100, "src")
    type_ = F.when(F.col("own") == "unknown_type", "order_partially_refunded").when(roll < 40, "order_placed").when(roll < 85, "order_paid").when(roll < 95, "order_cancelled").otherwise("order_refunded")
    merchant = F.concat(F.lit("m"), draw("m", merchants, "src"))
    amount = F.when(type_.isin("order_placed", "order_cancelled"), F.lit(None)).otherwise(199 + draw("a", 24_801, "src"))
    json = F.to_json(
        F.struct(
            F.concat(F.lit("evt-"), F.col("src")).alias("event_id"), type_.alias("event_type"), F.date_format(F.timestamp_seconds(F.lit(start) + F.floor(F.col("src") / rate) + shift), "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("occurred_at"),
            F.concat(F.lit("ord_"), F.col("src")).alias("order_id"), merchant.alias("merchant_id"), F.concat(F.lit("u_"), draw("u", users, "src")).alias("user_id"), amount.alias("amount_minor"), F.lit("EUR").alias("currency"), F.lit("card").alias("payment_method"), F.lit(1).alias("schema_version"),
            F.when(draw("x", 1_000_000, "src") < round(faults.unknown_field * 1_000_000), F.lit("gold")).alias("loyalty_tier"),
        )
    )
    poison = F.element_at(F.array(*map(F.lit, POISON)), (draw("p", len(POISON), "src") + 1).cast("int"))
    value = F.when(F.col("own") == "malformed", poison).otherwise(json)
    return d.select(F.lit("orders.v1").alias("topic"), F.pmod(F.xxhash64(merchant), F.lit(partitions)).cast("int").alias("partition"), F.col("i").alias("offset"), F.encode(merchant, "utf-8").alias("key"), F.encode(value, "utf-8").alias("value"), F.timestamp_millis((F.lit(start * 1000) + F.col("i") * 1000 / rate).cast("long")).alias("timestamp"), "fault")

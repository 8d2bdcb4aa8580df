"""De-duplication: one event id is applied once, the first arrival wins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_arrival(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key; ties in `order` are settled by the other columns. An aggregate, so a hot key is combined
    in each task before the shuffle."""
    rest = [c for c in df.columns if c not in (key, *order)]
    first = df.groupBy(key).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    return first.select(key, *(F.col("_first")[c].alias(c) for c in (*order, *rest))).select(df.columns)


def mark_duplicates(df: DataFrame, key: str, order: list[str], ledger: DataFrame | None = None) -> DataFrame:
    """df with duplicate: null for a first arrival, else in_batch or ledger. A null key is never a duplicate; rows that have none
    are dealt out by their place in the order, so that they don't meet in one task."""
    k = F.col(key)
    nth = F.row_number().over(Window.partitionBy(key, F.when(k.isNull(), F.xxhash64(*order))).orderBy(*order))
    out = df.withColumn("_nth", F.when(k.isNotNull(), nth).otherwise(1))
    if ledger is None:
        out = out.withColumn("_known", F.lit(None).cast("boolean"))
    else:
        out = out.join(ledger.select(F.col("event_id").alias(key)).distinct().withColumn("_known", F.lit(True)), key, "left")
    return out.withColumn("duplicate", F.when(F.col("_nth") > 1, "in_batch").when(F.col("_known"), "ledger")).drop("_nth", "_known")

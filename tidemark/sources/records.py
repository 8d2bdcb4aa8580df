"""Raw records: from files (batch or stream) and from Kafka where its connector is installed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.config import Settings

RAW = "topic string, partition int, offset bigint, key binary, value binary, timestamp timestamp"


def files(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(RAW).format(fmt).load(path)


def file_stream(spark: SparkSession, path: str, fmt: str = "parquet", files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(RAW).format(fmt).option("maxFilesPerTrigger", files_per_trigger).load(path)


def kafka_options(s: Settings) -> dict[str, str]:
    """Options of the source; offsets are kept in the query's checkpoint and committed when a batch is done."""
    return {
        "kafka.bootstrap.servers": s.bootstrap_servers, "subscribe": s.topic, "startingOffsets": s.starting_offsets, "maxOffsetsPerTrigger": str(s.max_offsets_per_trigger), "failOnDataLoss": "true",
        "groupIdPrefix": s.consumer_group, "kafka.isolation.level": "read_committed", "kafka.session.timeout.ms": str(s.session_timeout_ms), "kafka.max.poll.interval.ms": str(s.max_poll_interval_ms),
    }


def kafka_stream(spark: SparkSession, settings: Settings) -> DataFrame:
    """Needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**kafka_options(settings)).load().select("topic", "partition", "offset", "key", "value", "timestamp")


def dead_letter_messages(dead: DataFrame) -> DataFrame:
    """key, value and headers as the Kafka sink takes them (includeHeaders)."""
    return dead.selectExpr(
        "cast(coalesce(key, cast(partition as string)) as binary) key",
        "cast(to_json(struct(reason, detail, topic, partition, offset, key, payload, failed_at)) as binary) value",
        "array(struct('reason' as key, cast(reason as binary) as value), struct('source_topic' as key, cast(topic as binary) as value), struct('source_offset' as key, cast(cast(offset as string) as binary) as value)) headers",
    )


def replayed_messages(dead: DataFrame) -> DataFrame:
    """Dead letters as the records that they were, for the source topic."""
    return dead.selectExpr("cast(coalesce(key, '') as binary) key", "cast(payload as binary) value")


def sink_options(settings: Settings, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": settings.bootstrap_servers, "topic": topic, "includeHeaders": "true", "kafka.acks": "all", "kafka.enable.idempotence": "true", "kafka.compression.type": "zstd", "kafka.retries": "10", "kafka.linger.ms": "20"}


def kafka_sink(df: DataFrame, settings: Settings, topic: str | None = None) -> None:
    """Raises where a message can't be delivered. The dead letter topic, where none is named."""
    df.write.format("kafka").options(**sink_options(settings, topic or settings.dlq_topic)).save()

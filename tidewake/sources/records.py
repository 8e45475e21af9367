"""Sources of change records, all in the shape topic, partition, offset, value."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewake.schemas import CAPTURED, RECORD


@dataclass(frozen=True)
class Capture:
    """A captured table, its topic and its target tables."""

    name: str

    @property
    def topic(self) -> str:
        return f"cdc.{self.name}"

    @property
    def dlq_topic(self) -> str:
        return f"cdc.{self.name}.dlq"

    def bronze(self, namespace: str = "bronze") -> str:
        return f"{namespace}.{self.name}_cdc"


RETENTION_DAYS = 3
REGISTRY = [Capture(n) for n in CAPTURED]


def kafka_stream(spark: SparkSession, bootstrap: str, capture: Capture) -> DataFrame:
    """Needs Spark's Kafka connector. Gaps beyond retention are passed over."""
    options = {"kafka.bootstrap.servers": bootstrap, "subscribe": capture.topic, "kafka.group.id": f"bronze-writer-{capture.name}", "startingOffsets": "earliest", "failOnDataLoss": "false"}
    return spark.readStream.format("kafka").options(**options).load().select("topic", "partition", "offset", "value")


def file_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files of records as a stream."""
    reader = spark.readStream.schema(RECORD)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).parquet(path)


def bronze_history(spark: SparkSession, table: str, topic: str | None = None, since: date | None = None) -> DataFrame:
    """The raw table as the source of a backfill; since: the first day of ingestion, by which partitions are pruned."""
    df = spark.read.table(table)
    if since is not None:
        day = df["ingestion_timestamp_date"] if "ingestion_timestamp_date" in df.columns else F.to_date("ingestion_timestamp")
        df = df.where(day >= F.lit(since))
    return df if topic is None else df.where(F.col("kafka_topic") == topic)


def retained(records: DataFrame, timestamp: str, now: Column, days: int = RETENTION_DAYS) -> DataFrame:
    """Records that the topic's retention still keeps."""
    return records.where(F.col(timestamp) > now - F.make_dt_interval(days=F.lit(days)))

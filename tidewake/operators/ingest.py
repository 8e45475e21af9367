"""Records to raw rows and quarantined rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewake.functions.envelope import decode, decode_compat, event_id


def decoded(records: DataFrame, strict_compat: bool = False) -> DataFrame:
    """records (topic, partition, offset, value) with the envelope's fields; one parse."""
    rows = records.select("topic", "partition", "offset", F.col("value").cast("string").alias("value_str"))
    return decode_compat(rows) if strict_compat else decode(rows)


def bronze_rows(rows: DataFrame, at: datetime | Column | None = None) -> DataFrame:
    """Raw rows of the good records; at: one ingestion time for all."""
    when = F.current_timestamp() if at is None else at if isinstance(at, Column) else F.lit(at)
    return rows.where("parse_error_type IS NULL").select(
        event_id(F.col("topic"), F.col("partition"), F.col("offset")).alias("event_id"),
        "operation", "before", "after", "source_timestamp", "source_lsn", "transaction_id",
        F.col("topic").alias("kafka_topic"), F.col("partition").cast("int").alias("kafka_partition"), F.col("offset").alias("kafka_offset"),
        when.cast("timestamp").alias("ingestion_timestamp"),
    )


def dlq_rows(rows: DataFrame, at: datetime | Column | None = None) -> DataFrame:
    """Quarantined rows of the others."""
    when = F.current_timestamp() if at is None else at if isinstance(at, Column) else F.lit(at)
    return rows.where("parse_error_type IS NOT NULL").select(
        F.col("value_str").alias("original_event"), F.col("parse_error_message").alias("error_message"), F.col("parse_error_type").alias("error_type"),
        F.col("topic").alias("source_topic"), F.col("partition").cast("int").alias("kafka_partition"), F.col("offset").alias("kafka_offset"), when.cast("timestamp").alias("failed_at"),
    )


def batch_metrics(rows: DataFrame) -> DataFrame:
    """Good and bad records of each topic, in one aggregation."""
    return rows.groupBy("topic").agg(F.count_if(F.col("parse_error_type").isNull()).alias("good"), F.count_if(F.col("parse_error_type").isNotNull()).alias("bad"))


def route_topic(topic: Column) -> Column:
    """cdc.commerce.x -> cdc.x; other topics stay."""
    return F.regexp_replace(topic, r"^cdc\.commerce\.(.*)$", "cdc.$1")


def reprocess(quarantined: DataFrame, fix: Column) -> DataFrame:
    """Quarantined rows with corrected texts, decoded again; fix: the corrected text."""
    return decode(quarantined.select(F.col("source_topic").alias("topic"), F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset"), fix.alias("value_str")))

"""Change events: envelopes of state before and after, and state out of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def changes(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(op, key, before, after): what turns one state into the other; rows that stay equal make no event."""
    image = lambda df, name: df.select(F.col(key).alias(f"_{name}_key"), F.struct(*df.columns).alias(name))
    both = image(before, "before").join(image(after, "after"), F.col("_before_key") == F.col("_after_key"), "full")
    op = F.when(F.col("before").isNull(), "c").when(F.col("after").isNull(), "d").otherwise("u")
    return both.where(~F.col("before").eqNullSafe(F.col("after"))).select(op.alias("op"), F.coalesce("_before_key", "_after_key").alias("key"), "before", "after")


def snapshot(state: DataFrame, key: str) -> DataFrame:
    """(op, key, before, after) of the rows that are there when capture begins."""
    row = F.struct(*state.columns)
    return state.select(F.lit("r").alias("op"), F.col(key).alias("key"), F.lit(None).cast(state.select(row.alias("x")).schema["x"].dataType).alias("before"), row.alias("after"))


def envelopes(events: DataFrame, topic: str, lsn: Column, partitions: int = 3, ms: Column | None = None) -> DataFrame:
    """Stream records (topic, partition, offset, value) of events. lsn: the place in the log, which also is the offset; a key's events share a partition."""
    at = (lsn if ms is None else ms).cast("bigint")
    value = F.to_json(F.struct("op", "before", "after", F.struct(at.alias("ts_ms"), lsn.cast("bigint").alias("lsn")).alias("source"), F.lit(None).cast("struct<id:string>").alias("transaction")), {"ignoreNullFields": "false"})
    return events.select(F.lit(topic).alias("topic"), F.pmod(F.xxhash64("key"), F.lit(partitions)).cast("int").alias("partition"), lsn.cast("bigint").alias("offset"), value.cast("binary").alias("value"))

"""Typed, deduplicated and current state out of raw rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def dedup(bronze: DataFrame) -> DataFrame:
    """One row for each event_id: replays are equal but for their ingestion time, of which the first stays."""
    order = F.struct("ingestion_timestamp", "kafka_offset")
    rest = [c for c in bronze.columns if c != "event_id"]
    return bronze.groupBy("event_id").agg(F.min_by(F.struct(*rest), order).alias("r")).select("event_id", "r.*")


def current_state(bronze: DataFrame, key: str) -> DataFrame:
    """The last row of each key, deleted keys and rows without a key left out. Order of record: LSN, then partition and offset."""
    k = F.coalesce(F.get_json_object("after", f"$.{key}"), F.get_json_object("before", f"$.{key}"))
    order = F.struct("source_lsn", "kafka_partition", "kafka_offset")
    last = bronze.withColumn(key, k).where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct("operation", "after", "source_lsn", "kafka_offset"), order).alias("r"))
    return last.where("r.operation <> 'd'").select(key, "r.*")


def typed(bronze: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Typed columns of the image after, or before where there is no other (deletes); a name may list older names after it, as 'new|old'. Missing ones are null."""
    out, image = [], F.coalesce("after", "before")
    for names, kind in columns.items():
        found: list[Column] = [F.get_json_object(image, f"$.{n}") for n in names.split("|")]
        out.append(F.coalesce(*found).try_cast(kind).alias(names.split("|")[0]) if len(found) > 1 else found[0].try_cast(kind).alias(names))
    return bronze.select("event_id", "operation", "source_lsn", *out)


def late(bronze: DataFrame, seconds: int, range_offsets: int = 100_000) -> DataFrame:
    """For each topic: rows, and those that came more than some seconds behind the latest row before them in the log.

    The log is cut into ranges of offsets. Each is looked through by itself, beginning with the latest time of all ranges before it.
    """
    place = ["kafka_topic", "kafka_partition"]
    rows = bronze.select(*place, "kafka_offset", "source_timestamp", F.floor(F.col("kafka_offset") / range_offsets).alias("_range"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    heads = rows.groupBy(*place, "_range").agg(F.max("source_timestamp").alias("_latest"))
    heads = heads.select(*place, "_range", F.max("_latest").over(before(Window.partitionBy(*place).orderBy("_range"))).alias("_upto"))
    own = F.max("source_timestamp").over(before(Window.partitionBy(*place, "_range").orderBy("kafka_offset")))
    rows = rows.withColumn("_own", own).join(heads, [*place, "_range"])
    behind = F.unix_micros(F.greatest("_own", "_upto")) - F.unix_micros("source_timestamp")
    return rows.withColumn("_late", F.coalesce(behind > seconds * 1_000_000, F.lit(False))).groupBy("kafka_topic").agg(F.count("*").alias("n"), F.count_if("_late").alias("n_late"))

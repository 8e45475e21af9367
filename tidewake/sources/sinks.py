"""Tables and topics that rows are written to."""

from __future__ import annotations

from collections import defaultdict
from threading import Lock

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewake.operators.mutations import apply_changes
from tidewake.schemas import BRONZE, DLQ
from tidewake.sources.records import REGISTRY

TARGET_FILE_BYTES = 134_217_728


def statements(script: str) -> list[str]:
    """The statements of a SQL script, cut at semicolons; comments, quoted names and literals are seen as such."""
    out, at, begin, kept = [], 0, 0, []
    closing = {"'": "'", '"': '"', "`": "`", "--": "\n", "/*": "*/"}
    while at < len(script):
        sign = script[at : at + 2] if script[at : at + 2] in closing else script[at]
        if sign in closing:
            end = script.find(closing[sign], at + len(sign))
            end = len(script) if end < 0 else end + len(closing[sign])
            if sign in ("--", "/*"):
                kept.append(script[begin:at] + " ")
                begin = end
            at = end
        elif sign == ";":
            out.append("".join(kept) + script[begin:at])
            kept, at = [], at + 1
            begin = at
        else:
            at += 1
    return [s for x in [*out, "".join(kept) + script[begin:]] if (s := x.strip())]


def ddl(namespace: str = "bronze", iceberg: bool = False) -> list[str]:
    """Namespace, a raw table for each capture, and the quarantine. Parquet tables have a date column where Iceberg has a hidden partition."""
    def table(name: str, columns: str, ts: str) -> str:
        if iceberg:
            return f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING iceberg PARTITIONED BY (days({ts})) TBLPROPERTIES ('write.target-file-size-bytes' = '{TARGET_FILE_BYTES}')"
        return f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {ts}_date DATE) USING parquet PARTITIONED BY ({ts}_date)"

    return [f"CREATE NAMESPACE IF NOT EXISTS {namespace}", *[table(c.bronze(namespace), BRONZE, "ingestion_timestamp") for c in REGISTRY], table(f"{namespace}.dlq_events", DLQ, "failed_at")]


def ensure_tables(spark: SparkSession, script: str | None = None, namespace: str = "bronze", iceberg: bool = False) -> int:
    found = ddl(namespace, iceberg) if script is None else statements(script)
    for s in found:
        spark.sql(s)
    return len(found)


#: Parquet appends to one table share a folder for unfinished files, which the first to end deletes; so they take turns.
_TURNS: dict[str, Lock] = defaultdict(Lock)


def append(df: DataFrame, table: str, ts: str) -> None:
    """Appends by name; adds the date column if the table has one. Queries of one driver may append to one table at a time."""
    target = df.sparkSession.table(table).columns
    if f"{ts}_date" in target:
        df = df.withColumn(f"{ts}_date", F.to_date(ts))
    with _TURNS[table]:
        df.select(*target).write.insertInto(table)


def load(df: DataFrame, path: str, mode: str = "append") -> int:
    """Bulk load; the rows written, counted on the way."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode).parquet(path)
    return seen.get["n"]


def load_tables(tables: dict[str, DataFrame], base: str, mode: str = "append") -> dict[str, int]:
    """Tables that hang together, each to a folder of its name; rows written."""
    return {name: load(df, f"{base}/{name}", mode) for name, df in tables.items()}


def truncate_all(spark: SparkSession, tables: list[str], kept: tuple[str, ...] = ("warehouses",)) -> None:
    for t in tables:
        if t.rpartition(".")[2] not in kept:
            spark.sql(f"TRUNCATE TABLE {t}")


def merge_sql(table: str, changes: str, key: str, columns: list[str]) -> str:
    """MERGE of a view of changes (op and columns, one row for each key) into a table whose format has it."""
    rest = [c for c in columns if c != key]
    sets, names, values = ", ".join(f"t.{c} = c.{c}" for c in rest), ", ".join(columns), ", ".join(f"c.{c}" for c in columns)
    return f"MERGE INTO {table} t USING {changes} c ON t.{key} = c.{key} WHEN MATCHED AND c.op = 'd' THEN DELETE WHEN MATCHED THEN UPDATE SET {sets} WHEN NOT MATCHED AND c.op <> 'd' THEN INSERT ({names}) VALUES ({values})"


def upsert(spark: SparkSession, path: str, changes: DataFrame, key: str, order: str | None = None, buckets: int = 64, now: Column | None = None) -> None:
    """Changes (op, key, columns) merged into Parquet files in buckets of keys. Only buckets with changes are read and written.

    The new state is written to the checkpoint folder first; then each bucket is replaced.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [c for c in changes.columns if c not in ("op", order)]
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    touched = [r[0] for r in changes.select(bucket).distinct().collect()]  # buckets at most
    state = spark.createDataFrame([], changes.select(*names).schema)
    if store.exists(place):
        state = spark.read.parquet(path).where(F.col("bucket").isin(touched)).select(*names)
    changes = changes.withColumn("op", F.when(F.col("op") == "d", "d").otherwise("c")) if now is None else changes
    merged = apply_changes(state, changes, key, now, order).withColumn("bucket", bucket).checkpoint()
    merged.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    full = {r[0] for r in merged.select("bucket").distinct().collect()}
    for b in set(touched) - full:  # all their keys were deleted
        store.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/bucket={b}"), True)


def to_topic(df: DataFrame, bootstrap: str, topic: str) -> None:
    """Original texts to a Kafka topic, without keys. Needs Spark's Kafka connector."""
    df.selectExpr("original_event AS value").write.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("topic", topic).save()

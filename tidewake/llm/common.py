"""What several operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space: tab, line feed, vertical tab, form feed, carriage return, space.
WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A key with more than one in so many rows is hot; so there are fewer hot keys than this.
HOT_PARTS = 100_000
#: Keys with fewer rows are never hot; of others a smaller table has at most HOT_PARTS, too.
LEAST_HOT = 100


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only a session in one process, as in tests, may leave it unset.
    """
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or context._jsc.sc().getCheckpointDir().getOrElse(None)
    if not base:
        if not context.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tidewake-")
        context.setCheckpointDir(base)
    return base.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def stored(df: DataFrame, name: str, **options: object) -> DataFrame:
    """df, written to the shared folder and read back: cuts the lineage and outlives lost executors.

    The folder goes when the driver ends, or earlier by discard().
    """
    path = shared_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    store, place = _folder(df.sparkSession, path)
    store.deleteOnExit(place)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(df: DataFrame) -> None:
    """Deletes the folder of a DataFrame that stored() made. Nothing that reads it may be computed afterwards."""
    store, place = _folder(df.sparkSession, df._stored_at)
    store.delete(place, True)


def packed(df: DataFrame, *more: Column) -> DataFrame:
    """df's columns by number, and more columns beside them, whose names so can't clash with df's. Each is still pruned by itself."""
    return df.select(*[F.col(f"`{c}`").alias(f"_{i}_") for i, c in enumerate(df.columns)], *more)


def numbered(name: str, columns: list[str]) -> Column:
    """A column of packed(), by its name in df's columns."""
    return F.col(f"_{[c.lower() for c in columns].index(name.lower())}_")


def unpacked(*without: str, columns: list[str]) -> list[Column]:
    """All columns of packed() with their names, but for some, whatever their case."""
    gone = {c.lower() for c in without}
    return [F.col(f"_{i}_").alias(c) for i, c in enumerate(columns) if c.lower() not in gone]


def ascii_lower(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def words(column: Column) -> Column:
    """The words of a text; no words for null. White space is WHITE only."""
    inner = F.trim(column, F.lit(WHITE))
    return F.when(F.length(inner) > 0, F.split(inner, WHITE_RUN)).otherwise(F.array().cast("array<string>"))


def spread(*columns: Column) -> Column:
    """A number over 0 that deals equal keys out."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 20)) + 1


def attach(left: DataFrame, right: DataFrame, key: str, salt: Column, total: int) -> DataFrame:
    """left with right's columns, by a left join that no key can make uneven.

    right has one row for each key and a column n, the number of left's rows
    with that key; total is the number of left's rows. Keys with more than a
    HOT_PARTS-th of the rows are fewer than HOT_PARTS and so can be broadcast;
    all others have few rows each and are joined by a shuffle, in which the
    rows with a hot key, or none, are dealt out by salt. Where so many rows are
    too many for a task, the join is one that adaptive execution splits.
    """
    bound = max(total // HOT_PARTS, LEAST_HOT)
    added = [c for c in right.columns if c not in (key, "n")]
    values = F.struct(*added)
    hot = right.where(F.col("n") > bound).select(F.col(key).alias("hot_key"), values.alias("hot"))
    cold = right.where(F.col("n") <= bound).select(F.col(key).alias("cold_key"), (F.col("n") % 1).alias("zero"), values.alias("cold"))  # not a literal, or the join would be dealt out by the key alone
    rows = packed(left, F.col(key).alias("key"), salt.alias("dealt"))
    rows = rows.join(F.broadcast(hot), F.col("key") == F.col("hot_key"), "left")
    rows = rows.withColumn("salt", F.when(F.col("hot_key").isNotNull() | F.col("key").isNull(), F.col("dealt")).otherwise(F.lit(0).cast("long")))
    out = rows.join(cold, (F.col("key") == F.col("cold_key")) & (F.col("salt") == F.col("zero")), "left")
    both = F.coalesce("hot", "cold")
    return out.select(*unpacked(columns=left.columns), *[both[c].alias(c) for c in added])


def key_of(id_col: Column, text: Column) -> Column:
    """A document's place in the order of ids (null last) and, of rows that share one, of texts."""
    return F.struct(id_col.isNull().alias("none"), id_col.alias("id"), F.xxhash64(text).alias("sum"))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(batches: Iterator[pa.RecordBatch], column: str, bytes_at_once: int) -> Iterator[pa.RecordBatch]:
    """The batches, cut where a text begins after so many bytes of the column; a longer text is alone."""
    import pyarrow.compute as pc

    for b in batches:
        sizes = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        group = np.cumsum(sizes) // bytes_at_once
        cuts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), b.num_rows]
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            if j > i:
                yield b.slice(i, j - i)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

"""The mutation schedule: how many of each event fall due, from rates a minute."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Events a minute.
RATES = {"new_customer": 5, "new_order": 50, "payment_change": 40, "order_cancellation": 40, "inventory_restock": 20, "shipment_change": 30, "profile_update": 5, "price_stock_change": 10, "delete_order_item": 5}


def due(spark: SparkSession, seconds: int, tick: float = 1.0, rates: dict[str, float] = RATES) -> DataFrame:
    """(event, tick, n): credit grows by rate / 60 * tick, and each whole credit is an event."""
    table = F.array(*[F.struct(F.lit(k).alias("event"), F.lit(float(v)).alias("rate")) for k, v in rates.items()])
    ticks = spark.range(1, int(seconds / tick) + 1).withColumnRenamed("id", "tick").select("tick", F.inline(table))
    upto = lambda t: F.floor(F.round(t * F.col("rate") * tick / 60, 9))
    return ticks.select("event", "tick", (upto(F.col("tick")) - upto(F.col("tick") - 1)).alias("n")).where("n > 0")


def stream(spark: SparkSession, rates: dict[str, float] = RATES) -> DataFrame:
    """The same rates as an endless stream of events, by Spark's rate source."""
    total = sum(rates.values())
    upto, out = 0.0, None
    for k, v in rates.items():
        upto += v
        hit = F.pmod(F.xxhash64("value"), F.lit(1_000_000)) < int(1_000_000 * upto / total)
        out = F.when(hit, k) if out is None else out.when(hit, k)
    return spark.readStream.format("rate").option("rowsPerSecond", max(1, round(total / 60))).load().select(out.alias("event"), "timestamp", "value")

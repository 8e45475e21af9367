"""Change records and business tables, derived from the supplied tables by fixed rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewake.functions.draws import draw, weighted
from tidewake.schemas import N_WAREHOUSES, SEED_WEIGHTS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch_ms(ts) -> F.Column:
    return F.expr(f"timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', {ts})")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as stream records: inserts, snapshot reads, updates and deletes; error events have malformed texts of four kinds."""
    e = table(spark, sf_dir, "events")
    op = F.when(F.col("event_type") == "signup", "c").when(F.col("event_type") == "view", "r").when(F.col("event_id") % 7 == 0, "d").otherwise("u")
    image = lambda cents: F.concat(F.lit('{"event_id":'), "event_id", F.lit(',"user_id":'), "user_id", F.lit(',"cents":"'), cents, F.lit('"}'))
    cents = F.floor(F.col("value") * 100).cast("bigint").cast("string")
    before = F.when(op == "u", image(F.lit("0"))).when(op == "d", image(cents)).otherwise("null")
    after = F.when(op == "d", "null").otherwise(image(cents))
    tx = F.when(op == "r", "null").otherwise(F.concat(F.lit('{"id":"tx-'), F.floor(F.col("event_id") / 10).cast("string"), F.lit('"}')))
    good = F.concat(F.lit('{"op":"'), op, F.lit('","before":'), before, F.lit(',"after":'), after, F.lit(',"source":{"ts_ms":'), epoch_ms("ts").cast("string"), F.lit(',"lsn":'), (F.col("event_id") * 10 + 1000).cast("string"), F.lit('},"transaction":'), tx, F.lit("}"))
    bad = F.when(F.col("event_id") % 4 == 0, "{not json").when(F.col("event_id") % 4 == 1, '{"op":"c"}').when(F.col("event_id") % 4 == 2, "[1,2,3]")
    return e.select(
        F.concat(F.lit("cdc."), "event_type").alias("topic"), (F.col("user_id") % 3).cast("int").alias("partition"), F.col("event_id").alias("offset"),
        F.when(F.col("event_type") == "error", bad).otherwise(good).cast("binary").alias("value"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewake.operators.synth import customer_rows

    return customer_rows(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("country")))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"), F.col("p_brand").alias("category"), F.col("p_retailprice").cast("decimal(10,2)").alias("price"), draw("stock", F.col("p_partkey"), 1001).alias("stock_quantity"))


def warehouses(spark: SparkSession) -> DataFrame:
    return spark.range(1, N_WAREHOUSES + 1).select(F.col("id").alias("warehouse_id"))


def orders(spark: SparkSession, sf_dir: str, seeded: bool = True) -> DataFrame:
    """Orders with drawn statuses (as the seeder gives them), or those of the table."""
    o = table(spark, sf_dir, "orders")
    own = F.when(F.col("o_orderstatus") == "O", "PLACED").when(F.col("o_orderstatus") == "P", "PAID").otherwise("DELIVERED")
    status = weighted("status", F.col("o_orderkey"), SEED_WEIGHTS) if seeded else own
    return o.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), status.alias("order_status"), F.col("o_totalprice").cast("decimal(12,2)").alias("total_amount"), F.col("o_orderdate").alias("created_at"))


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items; the id is a digest of the whole row, as (order, line) is not unique in the table."""
    li = table(spark, sf_dir, "lineitem")
    cents = lambda c: F.round(F.col(c) * 100).cast("bigint").cast("string")
    key = F.md5(F.concat_ws("|", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", cents("l_quantity"), cents("l_extendedprice"), cents("l_discount"), cents("l_tax"), "l_returnflag", "l_linestatus").cast("binary"))
    return li.select(key.alias("order_item_id"), F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"), F.col("l_quantity").cast("int").alias("quantity"), F.col("l_extendedprice").cast("decimal(10,2)").alias("unit_price"))


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewake.operators.synth import payment_rows

    return payment_rows(orders(spark, sf_dir))


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewake.operators.synth import order_times, shipment_rows

    return shipment_rows(order_times(orders(spark, sf_dir)))


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewake.operators.synth import inventory_rows

    return inventory_rows(products(spark, sf_dir), warehouses(spark))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reservation requests: one for each line item, at a drawn warehouse."""
    i = order_items(spark, sf_dir)
    return i.select(F.col("order_item_id").alias("request_id"), "order_id", "product_id", (draw("warehouse", F.col("order_item_id"), N_WAREHOUSES) + 1).alias("warehouse_id"), "quantity")

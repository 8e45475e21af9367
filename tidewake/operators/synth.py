"""Business rows from orders and products, by draws on their keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewake.functions.draws import draw
from tidewake.operators.dealing import parts
from tidewake.schemas import CARRIERS, CATEGORIES, N_WAREHOUSES, PAYMENT_METHODS

#: Days that an order has been under way, by status.
PROGRESS_DAYS = {"PLACED": 0, "PAID": 1, "SHIPPED": 3, "DELIVERED": 6, "CANCELLED": 1}
RETRY_PERCENT = 8
MAX_ITEMS = 4
#: Ids to a part in which rows are numbered.
PART_IDS = 10_000


def pick(tag: str, key: Column, names: list[str]) -> Column:
    return F.get(F.array(*[F.lit(n) for n in names]), draw(tag, key, len(names)).cast("int"))


def plus(ts: Column, seconds: Column) -> Column:
    return ts + F.make_dt_interval(secs=seconds)


def dense_ids(df: DataFrame, key: str, order: list[str], name: str, base: int = 1) -> DataFrame:
    """df numbered from base on, without gaps, in the order of a whole-number key and then of order.

    Rows are numbered inside parts of PART_IDS keys each; only the parts' counts are summed up in one place.
    """
    rows = df.withColumn("_part", F.floor(F.col(key) / PART_IDS))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = rows.groupBy(F.col("_part").alias("_of")).agg(F.count("*").alias("_n")).select("_of", before.alias("_before"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(key, *order))
    return rows.withColumn("_own", own).join(parts, F.col("_part") == F.col("_of")).withColumn(name, F.col("_own") + F.col("_before") + (base - 1)).drop("_part", "_own", "_of", "_before")


def jittered(price: Column, tag: str, key: Column) -> Column:
    """A price up to a tenth off, in whole cents."""
    cents = (price * 100).cast("bigint") * (900 + draw(tag, key, 201)) + 500
    return (F.floor(cents / 1000).cast("decimal(20,0)") / 100).cast("decimal(10,2)")


def customer_rows(customers: DataFrame) -> DataFrame:
    """customers (customer_id, name, country) with an email that the id makes unique, and a city."""
    dotted = F.replace(F.lower(F.replace("name", F.lit("#"), F.lit(" "))), F.lit(" "), F.lit("."))
    email = F.concat(dotted, F.lit("."), "customer_id", F.lit("@example.com"))
    return customers.select("customer_id", "name", email.alias("email"), F.concat(F.lit("City "), draw("home", F.col("customer_id"), 500).cast("string")).alias("city"), "country")


def product_rows(products: DataFrame) -> DataFrame:
    """products (product_id, word) with name, category, price of 5 to 500, and stock of up to 1000."""
    k = F.col("product_id")
    rows = products.withColumn("category", pick("category", k, CATEGORIES))
    name = F.concat_ws(" ", F.initcap("word"), F.element_at(F.split("category", " "), 1), k.cast("string"))
    price = ((500 + draw("price", k, 49_501)).cast("decimal(12,0)") / 100).cast("decimal(10,2)")
    return rows.select("product_id", name.alias("product_name"), "category", price.alias("price"), draw("stock", k, 1001).alias("stock_quantity"))


def order_item_rows(orders: DataFrame, products: DataFrame, max_items: int = MAX_ITEMS, base: int = 1) -> DataFrame:
    """Items of each order: 1 to max_items of different products (or all there are), 1 to 5 of each, at a price up to a tenth off.

    Products are taken at a drawn place in the order of their ids and a drawn stride on from it, round the end.
    """
    pool = dense_ids(products.select("product_id", "price"), "product_id", [], "rank", 0)
    many = products.select(F.count("*").alias("_many"))
    k = F.col("order_id")
    rows = orders.select("order_id").crossJoin(F.broadcast(many))  # one row
    stride = F.greatest(F.floor(F.col("_many") / max_items), F.lit(1))
    rows = rows.withColumns({"_first": draw("item", k, 1 << 31) % F.col("_many"), "_stride": draw("stride", k, 1 << 31) % stride + 1, "_n": F.least(draw("items", k, max_items) + 1, F.col("_many"))})
    rows = rows.select("order_id", "_first", "_stride", "_many", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)).alias("number"))
    rows = rows.withColumn("_rank", (F.col("_first") + F.col("number") * F.col("_stride")) % F.col("_many")).join(pool, F.col("_rank") == F.col("rank"))
    key = F.concat_ws("|", "order_id", "number")
    rows = dense_ids(rows, "order_id", ["number"], "order_item_id", base)
    return rows.select("order_item_id", "order_id", "product_id", (draw("quantity", key, 5) + 1).alias("quantity"), jittered(F.col("price"), "jitter", key).alias("unit_price"))


def totals(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(F.sum(F.col("unit_price") * F.col("quantity")).cast("decimal(12,2)").alias("total_amount"))


def payment_rows(orders: DataFrame) -> DataFrame:
    """One payment for each order, and for some an earlier failed try. payment_id: twice the order's id, less one for the try."""
    k = F.col("order_id")
    coin = draw("coin", k, 2) == 0
    status = F.when(F.col("order_status").isin("PAID", "SHIPPED", "DELIVERED"), "SUCCESS").when(F.col("order_status") == "CANCELLED", F.when(coin, "REFUNDED").otherwise("FAILED")).otherwise(F.when(coin, "PENDING").otherwise("FAILED"))
    at = plus(F.col("created_at"), 60 * (1 + draw("paydelay", k, 120)))
    first = orders.select((2 * k).alias("payment_id"), "order_id", status.alias("payment_status"), pick("method", k, PAYMENT_METHODS).alias("payment_method"), F.col("total_amount").alias("amount"), at.alias("created_at"))
    return first.unionByName(retry_rows(orders))


def retry_rows(orders: DataFrame) -> DataFrame:
    k = F.col("order_id")
    some = orders.where(F.col("order_status").isin("PAID", "SHIPPED", "DELIVERED") & (draw("retry", k, 100) < RETRY_PERCENT))
    return some.select((2 * k - 1).alias("payment_id"), "order_id", F.lit("FAILED").alias("payment_status"), pick("retrymethod", k, PAYMENT_METHODS).alias("payment_method"), F.col("total_amount").alias("amount"), plus(F.col("created_at"), 30 * (1 + draw("retrydelay", k, 60))).alias("created_at"))


def created_times(orders: DataFrame, now: Column) -> DataFrame:
    """orders with created_at: up to 181 days before now."""
    return orders.withColumn("created_at", plus(now, -draw("age", F.col("order_id"), 181 * 86_400)))


def order_times(orders: DataFrame) -> DataFrame:
    """orders with updated_at: created_at plus up to a day more than the status has taken, in whole seconds."""
    days = F.create_map(*[x for s, d in PROGRESS_DAYS.items() for x in (F.lit(s), F.lit(d))])[F.col("order_status")]
    return orders.withColumn("updated_at", plus(F.col("created_at"), F.floor(draw("updated", F.col("order_id"), 1_000_000) * (days + 1) * 86_400 / 1_000_000)))


def shipment_rows(orders: DataFrame) -> DataFrame:
    """A shipment for each order (with updated_at) that is PAID or further: sent up to 12 hours before the order's last change, there half a day to five days later."""
    k = F.col("order_id")
    rows = orders.where(F.col("order_status").isin("PAID", "SHIPPED", "DELIVERED")).withColumn("shipment_status", F.when(F.col("order_status") == "PAID", "PENDING").when(F.col("order_status") == "SHIPPED", F.when(draw("transit", k, 2) == 0, "SHIPPED").otherwise("IN_TRANSIT")).otherwise(F.when(draw("returned", k, 100) < 95, "DELIVERED").otherwise("RETURNED")))
    rows = rows.withColumn("shipped_at", F.when(F.col("shipment_status") != "PENDING", plus(F.col("updated_at"), -draw("shipped", k, 43_200))))
    rows = rows.withColumn("delivered_at", F.when(F.col("shipment_status").isin("DELIVERED", "RETURNED"), plus(F.col("shipped_at"), 43_200 + draw("delivered", k, 388_800))))
    return rows.select(k.alias("shipment_id"), "order_id", "shipment_status", pick("carrier", k, CARRIERS).alias("carrier"), "shipped_at", "delivered_at", F.coalesce("delivered_at", "shipped_at", "updated_at").alias("updated_at"))


def inventory_rows(products: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Each product at each warehouse; the warehouses are a fixed few. Products are dealt out first, as a task that reads many would make 15 times as many rows."""
    some = products.select("product_id")
    some = some.repartition(parts(some, some.count() * N_WAREHOUSES), "product_id")
    rows = some.crossJoin(F.broadcast(warehouses)).withColumn("inventory_id", (F.col("product_id") - 1) * 15 + F.col("warehouse_id"))
    rows = rows.withColumn("available_quantity", draw("available", F.col("inventory_id"), 501))
    return rows.select("inventory_id", "product_id", "warehouse_id", "available_quantity", F.least(draw("reserved", F.col("inventory_id"), 51), F.col("available_quantity")).alias("reserved_quantity"))


def seeded_tables(orders: DataFrame, products: DataFrame, max_items: int = MAX_ITEMS) -> dict[str, DataFrame]:
    """The four tables that hang together: orders (order_id, customer_id, order_status, created_at) with totals from their items, the items, payments and shipments."""
    items = order_item_rows(orders, products, max_items)
    full = order_times(orders.drop("total_amount").join(totals(items), "order_id"))
    full = full.select("order_id", "customer_id", "order_status", "total_amount", "created_at", "updated_at")
    return {"orders": full, "order_items": items, "payments": payment_rows(full), "shipments": shipment_rows(full)}


def counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n)."""
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("n")).select(F.lit(t).alias("table_name"), "n") for t, df in tables.items()])

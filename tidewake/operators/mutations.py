"""The simulator's mutations, as set-based operators: state and requests in, changed rows out.

Rows that a guard rejects are not returned, as they make no change event. Where several
requests meet one row they are applied in the order of their ids: sums for unguarded changes,
a fold for guarded ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewake.functions.draws import draw
from tidewake.operators.synth import customer_rows, jittered, pick, totals
from tidewake.schemas import CARRIERS, N_WAREHOUSES, PAYMENT_METHODS


def new_customers(requests: DataFrame, base: int) -> DataFrame:
    """A customer for each request (request_id from 1 on, name, country), with ids from base on."""
    return customer_rows(requests.select((F.col("request_id") + (base - 1)).alias("customer_id"), "name", "country"))


def new_orders(requests: DataFrame, products: DataFrame, max_customer: int, max_product: int, order_base: int) -> dict[str, DataFrame]:
    """Orders with 1 to 4 items, their items and pending payments, and the stock that they ask for. requests: request_id, from 1 on.

    Products are drawn with replacement; unknown ones are passed over, and so are orders without any other.
    """
    k = F.col("request_id")
    rows = requests.select("request_id", F.explode(F.sequence(F.lit(0).cast("long"), draw("cart", k, 4))).alias("number"))
    key = F.concat_ws("|", "request_id", "number")
    rows = rows.withColumns({"product_id": draw("cartitem", key, max_product) + 1, "quantity": draw("cartquantity", key, 5) + 1}).join(products.select("product_id", "price"), "product_id")
    items = rows.select(
        ((k + (order_base - 1)) * 4 + F.col("number")).alias("order_item_id"), (k + (order_base - 1)).alias("order_id"), "product_id", "quantity", jittered(F.col("price"), "cartprice", key).alias("unit_price"),
        (draw("cartwarehouse", key, N_WAREHOUSES) + 1).alias("warehouse_id"),
    )
    made = totals(items)
    o = F.col("order_id")
    orders = made.select("order_id", (draw("buyer", o, max_customer) + 1).alias("customer_id"), F.lit("PLACED").alias("order_status"), "total_amount")
    payments = made.select((2 * o).alias("payment_id"), "order_id", F.lit("PENDING").alias("payment_status"), pick("method", o, PAYMENT_METHODS).alias("payment_method"), F.col("total_amount").alias("amount"))
    return {"orders": orders, "order_items": items.drop("warehouse_id"), "payments": payments, "requests": items.select(F.col("order_item_id").alias("request_id"), "product_id", "warehouse_id", "quantity")}


def reserve(inventory: DataFrame, requests: DataFrame) -> DataFrame:
    """requests: request_id, product_id, warehouse_id, quantity over 0. Each key's requests are folded in order, a request that does not fit is passed over.

    What is left never grows, so once a request is passed over all later ones of its size or more are, too: of each key and size only the first
    available / size requests can fit. Others are dropped before they are dealt out, which leaves a bounded fold
    for any key, however many requests it has.
    """
    most = inventory.agg(F.coalesce(F.max("available_quantity"), F.lit(0))).first()[0]
    place = ["product_id", "warehouse_id"]
    nth = F.row_number().over(Window.partitionBy(*place, "quantity").orderBy("request_id"))
    some = requests.where("quantity > 0").select("request_id", *place, "quantity").withColumn("_nth", nth).where(F.col("_nth") <= int(most))
    stock = inventory.select(*place, F.col("available_quantity").alias("_stock"))
    some = some.join(stock, place).where(F.col("_nth") * F.col("quantity") <= F.col("_stock"))
    asked = some.groupBy(*place).agg(F.sort_array(F.collect_list(F.struct("request_id", "quantity"))).alias("asked"))
    rows = inventory.join(asked, place)
    taken = F.aggregate("asked", F.lit(0).cast("bigint"), lambda a, r: F.when(F.col("available_quantity") - a >= r["quantity"], a + r["quantity"]).otherwise(a))
    return rows.withColumn("taken", taken).where("taken > 0").select(
        "inventory_id", "product_id", "warehouse_id",
        (F.col("available_quantity") - F.col("taken")).alias("available_quantity"), (F.col("reserved_quantity") + F.col("taken")).alias("reserved_quantity"),
    )


def release(inventory: DataFrame, requests: DataFrame) -> DataFrame:
    """Cancelled orders' quantities go back; reserved ones never below zero."""
    back = requests.groupBy("product_id", "warehouse_id").agg(F.sum("quantity").alias("q"))
    return inventory.join(back, ["product_id", "warehouse_id"]).select(
        "inventory_id", "product_id", "warehouse_id",
        (F.col("available_quantity") + F.col("q")).alias("available_quantity"), F.greatest(F.col("reserved_quantity") - F.col("q"), F.lit(0)).alias("reserved_quantity"),
    )


def restock(inventory: DataFrame, requests: DataFrame) -> DataFrame:
    more = requests.groupBy("product_id", "warehouse_id").agg(F.sum("quantity").alias("q"))
    return inventory.join(more, ["product_id", "warehouse_id"]).select("inventory_id", "product_id", "warehouse_id", (F.col("available_quantity") + F.col("q")).alias("available_quantity"), "reserved_quantity")


def resolve_payments(orders: DataFrame, payments: DataFrame, draw) -> DataFrame:
    """The first pending payment of each PLACED order succeeds or fails; success pays the order."""
    pending = payments.where("payment_status = 'PENDING'").groupBy("order_id").agg(F.min("payment_id").alias("payment_id"))
    out = orders.where("order_status = 'PLACED'").join(pending, "order_id").withColumn("payment_status", F.when(draw(F.col("payment_id")) < 85, "SUCCESS").otherwise("FAILED"))
    return out.select("order_id", "payment_id", "payment_status", F.when(F.col("payment_status") == "SUCCESS", "PAID").otherwise(F.col("order_status")).alias("order_status"))


def advance_shipments(orders: DataFrame, shipments: DataFrame, draw_of, now: Column) -> DataFrame:
    """PAID or SHIPPED orders: a shipment is made (numbered as its order), sent, or settled; with the row that it then is."""
    had = shipments.select("order_id", "shipment_id", "shipment_status", "carrier", "shipped_at", "delivered_at")
    rows = orders.where("order_status IN ('PAID', 'SHIPPED')").select("order_id", F.col("order_status").alias("was")).join(had, "order_id", "left")
    settled = F.when(draw_of(F.col("order_id")) < 95, "DELIVERED").otherwise("RETURNED")
    to = F.when(F.col("shipment_status").isNull(), "PENDING").when(F.col("shipment_status") == "PENDING", "SHIPPED").when(F.col("shipment_status") == "SHIPPED", settled)
    rows = rows.withColumn("to_status", to).where("to_status IS NOT NULL")
    return rows.select(
        "order_id", F.coalesce("shipment_id", "order_id").alias("shipment_id"), F.col("shipment_status").alias("from_status"), "to_status", F.coalesce("carrier", pick("newcarrier", F.col("order_id"), CARRIERS)).alias("carrier"),
        F.when(F.col("to_status") == "SHIPPED", now).otherwise(F.col("shipped_at")).alias("shipped_at"), F.when(F.col("to_status").isin("DELIVERED", "RETURNED"), now).otherwise(F.col("delivered_at")).alias("delivered_at"),
        F.when(F.col("to_status") == "SHIPPED", "SHIPPED").when(F.col("to_status") == "DELIVERED", "DELIVERED").otherwise(F.col("was")).alias("order_status"),
    )


def cancel(orders: DataFrame) -> DataFrame:
    return orders.where("order_status IN ('PLACED', 'PAID')").withColumn("order_status", F.lit("CANCELLED"))


def delete_items(orders: DataFrame, items: DataFrame, chosen) -> DataFrame:
    """One item of each PLACED order with more than one; chosen orders them. The order's total sinks, not below zero."""
    some = items.join(orders.where("order_status = 'PLACED'").select("order_id", "total_amount"), "order_id")
    one = some.groupBy("order_id", "total_amount").agg(F.count("*").alias("n"), F.min_by(F.struct("order_item_id", "quantity", "unit_price"), chosen).alias("i")).where("n > 1")
    less = F.col("i.quantity") * F.col("i.unit_price")
    return one.select("order_id", F.col("i.order_item_id").alias("order_item_id"), F.greatest(F.col("total_amount") - less, F.lit(0)).cast("decimal(14,2)").alias("total_amount"))


def change_products(products: DataFrame, draw) -> DataFrame:
    """Half the products get a price up to a tenth off, at least 1; the others a stock change of -20 to 50, at least 0."""
    percent = draw("delta")(F.col("product_id"), 21) - 10
    price = F.greatest(F.round(F.col("price") * (100 + percent) / 100, 2), F.lit(1)).cast("decimal(10,2)")
    stock = F.greatest(F.col("stock_quantity") + draw("stockdelta")(F.col("product_id"), 71) - 20, F.lit(0))
    is_price = draw("which")(F.col("product_id"), 2) == 0
    return products.select("product_id", F.when(is_price, price).otherwise(F.col("price")).alias("price"), F.when(is_price, F.col("stock_quantity")).otherwise(stock).alias("stock_quantity"))


def apply_changes(state: DataFrame, changes: DataFrame, key: str, now: Column | None = None, order: str | None = None) -> DataFrame:
    """state with the rows of changes (op, key, after columns) applied: inserts, updates and deletes. Of several changes of a key the last by order counts. updated_at is set on updates, as the trigger does."""
    names = state.columns
    own = F.struct("op", F.struct(*names).alias("new"))
    last = changes.groupBy(F.col(key).alias("_key")).agg((F.max_by(own, F.col(order)) if order else F.max(own)).alias("_c")).select("_key", "_c.*")
    out = state.withColumn("_old", F.lit(True)).join(last, F.col(key) == F.col("_key"), "full").where("op IS NULL OR op <> 'd'")
    set_now = F.lit(None) if now is None else now
    take = lambda c: F.when(F.col("op") == "u", set_now).when(F.col("op") == "c", F.col("new")[c]).otherwise(F.col(c)) if c == "updated_at" else F.when(F.col("op").isNotNull(), F.col("new")[c]).otherwise(F.col(c))
    return out.where("_old OR op = 'c'").select(*[take(c).alias(c) for c in names])

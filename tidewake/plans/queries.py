"""The query catalogue over the supplied tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewake.functions.draws import draw
from tidewake.functions.envelope import decode, event_id
from tidewake.functions.statemachine import is_terminal, next_status, next_statuses, status_history
from tidewake.operators import audits, changes, ingest, mutations, silver, synth
from tidewake.operators.dealing import parts
from tidewake.plans import standin as s
from tidewake.plans.plants import PLANTS, planted

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: Ingestion and failure times are left out, as they are the wall clock's.
BRONZE_OUT = ["event_id", "operation", "before", "after", "source_lsn", "transaction_id", "kafka_topic", "kafka_partition", "kafka_offset"]


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def _rows(spark: SparkSession, d: str) -> DataFrame:
    return ingest.decoded(s.records(spark, d))


def _bronze(spark: SparkSession, d: str) -> DataFrame:
    return ingest.bronze_rows(_rows(spark, d))


@query
def bronze_ingest(spark, d):
    return _bronze(spark, d).select(*BRONZE_OUT, F.unix_millis("source_timestamp").alias("source_ms"))


@query
def dlq_quarantine(spark, d):
    return ingest.dlq_rows(_rows(spark, d)).drop("failed_at")


@query
def envelope_edge_cases(spark, d):
    from tidewake.plans.edges import EDGES

    edges = F.array(*[F.struct(F.lit(i).alias("case_id"), F.lit(v).cast("string").alias("value_str")) for i, v in enumerate(EDGES)])
    out = decode(spark.range(1).select(F.inline(edges)))
    return out.select("case_id", "operation", "source_lsn", "transaction_id", F.unix_millis("source_timestamp").alias("source_ms"), "parse_error_type")


@query
def event_ids(spark, d):
    return s.records(spark, d).select("topic", "partition", "offset", event_id(F.col("topic"), F.col("partition"), F.col("offset")).alias("event_id"))


@query
def topic_route(spark, d):
    raw = s.table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("cdc.commerce."), "event_type")).otherwise(F.concat(F.lit("other."), "event_type")).alias("raw"))
    return raw.select("event_id", ingest.route_topic(F.col("raw")).alias("topic"))


@query
def batch_metrics(spark, d):
    return ingest.batch_metrics(_rows(spark, d))


@query
def op_mix(spark, d):
    return _bronze(spark, d).groupBy("kafka_topic", "operation").agg(F.count("*").alias("n"))


@query
def decode_before_after(spark, d):
    cents = lambda c: F.get_json_object(c, "$.cents").cast("bigint")
    return _bronze(spark, d).groupBy("operation").agg(F.count("before").alias("n_before"), F.count("after").alias("n_after"), F.sum(cents("before")).alias("before_cents"), F.sum(cents("after")).alias("after_cents"))


@query
def partition_assignment(spark, d):
    return s.orders(spark, d).select("order_id", F.pmod(draw("partition", F.col("order_id"), 1 << 20), F.lit(3)).cast("int").alias("partition"))


@query
def open_orders(spark, d):
    o = s.orders(spark, d).where(~F.col("order_status").isin("DELIVERED", "CANCELLED"))
    return o.orderBy(draw("sample", F.col("order_id"), 1 << 31), "order_id").limit(5000).select("order_id", "order_status")


@query
def next_ids(spark, d):
    parts = [(n, s.table(spark, d, t), c) for n, t, c in (("customers", "customer", "c_custkey"), ("products", "part", "p_partkey"), ("orders", "orders", "o_orderkey"))]
    parts.append(("returns", s.table(spark, d, "orders").where("o_orderkey < 0"), "o_orderkey"))
    out = [df.agg(F.coalesce(F.max(c), F.lit(0)).alias("max_id")).select(F.lit(n).alias("table_name"), "max_id", (F.col("max_id") + 1).alias("next_id")) for n, df, c in parts]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


@query
def product_pool(spark, d):
    return s.products(spark, d).select("product_id", "price").orderBy("product_id")


@query
def order_totals(spark, d):
    t = s.order_items(spark, d).groupBy("order_id").agg(F.sum(F.col("unit_price") * F.col("quantity")).cast("decimal(38,2)").alias("items_total"), F.count("*").alias("n_items"))
    return s.orders(spark, d).select("order_id").join(t, "order_id")


@query
def price_lookup_join(spark, d):
    p = s.products(spark, d).select("product_id", "price")
    j = s.order_items(spark, d).join(p, "product_id")
    return j.groupBy("product_id", "price").agg(F.sum("quantity").alias("quantity"), F.sum(F.col("price") * F.col("quantity")).cast("decimal(38,2)").alias("list_value"))


@query
def pending_payment_lookup(spark, d):
    p = s.payments(spark, d).where("payment_status = 'PENDING'").groupBy("order_id").agg(F.min("payment_id").alias("payment_id"))
    return s.orders(spark, d).where("order_status = 'PLACED'").join(p, "order_id").select("order_id", "payment_id")


@query
def inventory_cross_seed(spark, d):
    return s.inventory(spark, d)


@query
def seed_status_distribution(spark, d):
    return s.orders(spark, d).groupBy("order_status").agg(F.count("*").alias("n"))


@query
def payment_derivation(spark, d):
    return s.payments(spark, d)


@query
def retry_payments(spark, d):
    return synth.retry_rows(s.orders(spark, d))


@query
def shipment_derivation(spark, d):
    return s.shipments(spark, d)


@query
def customer_email(spark, d):
    return s.customers(spark, d)


def _now() -> F.Column:
    """A fixed time, so that results don't depend on the clock."""
    return F.lit("2026-01-01").cast("timestamp_ntz")


@query
def order_timestamps(spark, d):
    o = synth.order_times(synth.created_times(s.orders(spark, d), _now()))
    return o.select("order_id", "order_status", "created_at", F.expr("timestampdiff(SECOND, created_at, updated_at)").alias("seconds"))


def _raw_products(spark: SparkSession, d: str) -> DataFrame:
    return s.table(spark, d, "part").select(F.col("p_partkey").alias("product_id"), F.element_at(F.split("p_name", " "), 1).alias("word"))


@query
def product_synthesis(spark, d):
    return synth.product_rows(_raw_products(spark, d))


@query
def order_item_synthesis(spark, d):
    return synth.order_item_rows(s.orders(spark, d), s.products(spark, d))


@query
def order_total_synthesis(spark, d):
    return synth.totals(synth.order_item_rows(s.orders(spark, d), s.products(spark, d)))


@query
def id_allocation(spark, d):
    """Ids from 1001 on, without gaps, in the order of (order, line's digest)."""
    i = s.order_items(spark, d).select("order_id", "order_item_id").distinct()
    return synth.dense_ids(i, "order_id", ["order_item_id"], "item_number", 1001)


@query
def seeded_load(spark, d):
    """Rows of the four tables that are loaded together, and the sums that hang together."""
    t = synth.seeded_tables(s.orders(spark, d), s.products(spark, d))
    n = synth.counts(t)
    money = t["orders"].agg(F.sum("total_amount").alias("money")).select(F.lit("orders").alias("of"), "money").unionByName(t["payments"].agg(F.sum("amount").alias("money")).select(F.lit("payments").alias("of"), "money"))
    return n.join(money, n["table_name"] == money["of"], "left").select("table_name", "n", F.col("money").cast("decimal(38,2)").alias("money"))


@query
def new_customer_events(spark, d):
    c = s.table(spark, d, "customer")
    base = c.agg(F.coalesce(F.max("c_custkey"), F.lit(0))).first()[0] + 1
    asked = c.where("c_custkey % 20 = 0").select((F.col("c_custkey") / 20).cast("bigint").alias("request_id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("country"))
    return changes.snapshot(mutations.new_customers(asked, base), "customer_id").select(F.lit("c").alias("op"), "key", F.to_json("after").alias("after"))


@query
def new_order_events(spark, d):
    """All changes that new orders make: inserts of orders, items and payments, and updates of the stock that they reserve."""
    made, stock, _ = _new_orders(spark, d)
    keys = {"orders": "order_id", "order_items": "order_item_id", "payments": "payment_id"}
    inserts = [(t, changes.snapshot(made[t], k).withColumn("op", F.lit("c"))) for t, k in keys.items()]
    reserved = mutations.reserve(stock, made["requests"])
    before = stock.join(reserved.select("inventory_id"), "inventory_id", "left_semi")
    rows = [df.select(F.lit(f"cdc.{t}").alias("topic"), "op", "key", _image("before").alias("before"), _image("after").alias("after")) for t, df in [*inserts, ("inventory", changes.changes(before, reserved.select(*before.columns), "inventory_id"))]]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


def _image(c: str) -> F.Column:
    return F.when(F.col(c).isNotNull(), F.to_json(c))


def _new_orders(spark: SparkSession, d: str) -> tuple[dict[str, DataFrame], DataFrame, int]:
    """A request for each tenth customer; every 17th product is unknown by then."""
    c, p = s.table(spark, d, "customer"), s.products(spark, d)
    last = s.table(spark, d, "orders").agg(F.coalesce(F.max("o_orderkey"), F.lit(0))).first()[0]
    asked = c.where("c_custkey % 10 = 0").select((F.col("c_custkey") / 10).cast("bigint").alias("request_id"))
    most = p.agg(F.max("product_id")).first()[0]
    buyers = c.agg(F.max("c_custkey")).first()[0]
    return mutations.new_orders(asked, p.where("product_id % 17 <> 0"), buyers, most, last + 1), s.inventory(spark, d), last


@query
def cdc_roundtrip(spark, d):
    """Orders, captured as a snapshot and a log of updates and deletes, sent as envelopes, decoded, landed, and read back as current state."""
    o = s.orders(spark, d).select("order_id", "order_status", "total_amount")
    paid = mutations.resolve_payments(s.orders(spark, d), s.payments(spark, d), lambda k: draw("resolve", k, 100)).select("order_id", F.col("order_status").alias("now"))
    later = o.join(paid, "order_id", "left").select("order_id", F.coalesce("now", "order_status").alias("order_status"), "total_amount").where("NOT (order_status = 'CANCELLED' AND order_id % 2 = 0)")
    log = changes.envelopes(changes.snapshot(o, "order_id"), "cdc.orders", F.col("key")).unionByName(changes.envelopes(changes.changes(o, later, "order_id"), "cdc.orders", F.col("key") + (1 << 40)))
    now = silver.current_state(ingest.bronze_rows(ingest.decoded(log)), "order_id")
    return silver.typed(now.select(F.lit("").alias("event_id"), "operation", F.lit(None).alias("before"), "after", "source_lsn"), {"order_id": "bigint", "order_status": "string", "total_amount": "decimal(12,2)"}).select("order_id", "operation", "order_status", "total_amount")


@query
def change_mix(spark, d):
    """Changes that deleting items makes, by kind."""
    o, i = s.orders(spark, d), s.order_items(spark, d).dropDuplicates(["order_item_id"])
    gone = mutations.delete_items(o, i, F.col("order_item_id"))
    left = i.join(gone.select("order_item_id"), "order_item_id", "left_anti")
    kept = o.select("order_id", "total_amount").join(gone.select("order_id", F.col("total_amount").alias("less")), "order_id", "left").select("order_id", F.coalesce("less", "total_amount").cast("decimal(12,2)").alias("total_amount"))
    items = changes.changes(i, left, "order_item_id").select(F.lit("cdc.order_items").alias("topic"), "op", F.col("before.quantity").alias("q"))
    orders = changes.changes(o.select("order_id", "total_amount"), kept, "order_id").select(F.lit("cdc.orders").alias("topic"), "op", F.lit(0).alias("q"))
    return items.unionByName(orders).groupBy("topic", "op").agg(F.count("*").alias("n"), F.sum("q").alias("quantity"))


@query
def inventory_reserve(spark, d):
    return mutations.reserve(s.inventory(spark, d), s.requests(spark, d))


@query
def inventory_release(spark, d):
    gone = mutations.cancel(s.orders(spark, d)).select("order_id")
    return mutations.release(s.inventory(spark, d), s.requests(spark, d).join(gone, "order_id", "left_semi"))


@query
def inventory_restock(spark, d):
    asked = s.products(spark, d).select("product_id", (draw("rwarehouse", F.col("product_id"), 15) + 1).alias("warehouse_id"), (draw("ramount", F.col("product_id"), 191) + 10).alias("quantity"))
    return mutations.restock(s.inventory(spark, d), asked)


@query
def payment_resolution(spark, d):
    return mutations.resolve_payments(s.orders(spark, d), s.payments(spark, d), lambda k: draw("resolve", k, 100))


@query
def shipment_advance(spark, d):
    """A tenth of the orders have no shipment yet."""
    had = s.shipments(spark, d).where(draw("lost", F.col("order_id"), 10) > 0)
    return mutations.advance_shipments(s.orders(spark, d), had, lambda k: draw("settle", k, 100), _now())


@query
def order_cancellation(spark, d):
    return mutations.cancel(s.orders(spark, d)).select("order_id", "order_status")


@query
def delete_item_adjust(spark, d):
    return mutations.delete_items(s.orders(spark, d), s.order_items(spark, d), F.col("order_item_id"))


@query
def price_stock_change(spark, d):
    return mutations.change_products(s.products(spark, d), lambda tag: lambda k, n: draw(tag, k, n))


@query
def profile_update(spark, d):
    some = draw("move", F.col("customer_id"), 20) == 0
    c = s.customers(spark, d).withColumn("city", F.concat(F.lit("city"), draw("city", F.col("customer_id"), 100).cast("string")))
    return c.where(some).select("customer_id", "city")


@query
def apply_order_changes(spark, d):
    """State after payments are resolved and cancelled orders of one kind deleted."""
    o = synth.order_times(s.orders(spark, d)).select("order_id", "order_status", "total_amount", "updated_at")
    paid = mutations.resolve_payments(s.orders(spark, d), s.payments(spark, d), lambda k: draw("resolve", k, 100)).where("order_status = 'PAID'").select("order_id", "order_status")
    up = paid.join(o.drop("order_status"), "order_id").select(F.lit("u").alias("op"), *o.columns, F.lit(2).alias("lsn"))
    first = up.withColumns({"order_status": F.lit("PLACED"), "lsn": F.lit(1)})  # an earlier change of the same keys
    gone = o.where((F.col("order_status") == "CANCELLED") & (F.col("order_id") % 2 == 0)).select(F.lit("d").alias("op"), *o.columns, F.lit(1).alias("lsn"))
    return mutations.apply_changes(o, up.unionByName(gone).unionByName(first), "order_id", _now(), "lsn")


@query
def legal_transitions(spark, d):
    return s.orders(spark, d).select("order_id", "order_status", F.array_join(next_statuses(F.col("order_status")), ",").alias("next_statuses"), next_status(F.col("order_status"), draw("next", F.col("order_id"), 1000)).alias("next_status"))


@query
def terminal_orders(spark, d):
    return s.orders(spark, d).groupBy("order_status", is_terminal(F.col("order_status")).alias("terminal")).agg(F.count("*").alias("n"))


def _tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {n: getattr(s, n)(spark, d) for n in ("customers", "products", "orders", "order_items", "payments", "inventory", "shipments")} | {"warehouses": s.warehouses(spark)}


def _planted(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The tables, with violations of every rule planted in them."""
    return {n: df.selectExpr(*[planted(n, c) for c in df.columns]) if n in PLANTS else df for n, df in _tables(spark, d).items()}


@query
def check_violations(spark, d):
    return audits.check_violations(_planted(spark, d))


@query
def enum_violations(spark, d):
    return audits.enum_violations(_planted(spark, d))


@query
def fk_violations(spark, d):
    return audits.fk_violations(_planted(spark, d))


@query
def unique_violations(spark, d):
    return audits.unique_violations(_planted(spark, d))


@query
def silver_dedup(spark, d):
    b = _bronze(spark, d)
    return silver.dedup(b.unionByName(b)).select(*BRONZE_OUT)


@query
def silver_current_state(spark, d):
    return silver.current_state(_bronze(spark, d), "user_id")


@query
def silver_typed(spark, d):
    return silver.typed(_bronze(spark, d), {"user_id": "bigint", "cents": "decimal(12,0)", "event_id_missing": "bigint"}).select("event_id", "operation", "user_id", F.col("cents").cast("bigint").alias("cents"), "event_id_missing")


@query
def status_history_audit(spark, d):
    log = s.table(spark, d, "events").select(F.col("user_id").alias("order_id"), F.col("event_id").alias("source_lsn"), F.col("event_id").alias("kafka_offset"), F.get(F.array(*[F.lit(x) for x in ("PLACED", "PAID", "SHIPPED", "DELIVERED", "CANCELLED")]), draw("audit", F.col("event_id"), 5).cast("int")).alias("order_status"))
    return status_history(log).groupBy("previous_status", "order_status", "legal").agg(F.count("*").alias("n"))


@query
def status_durations(spark, d):
    """Milliseconds until a key's next change, the history that compaction would lose."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = s.table(spark, d, "events").select("user_id", "event_id", "event_type", "ts")
    return e.select("user_id", "event_id", "event_type", F.lead("event_type").over(w).alias("next_type"), (F.lead(s.epoch_ms("ts")).over(w) - s.epoch_ms("ts")).alias("ms"))


@query
def schema_additive(spark, d):
    b = _bronze(spark, d).withColumn("after", F.when(F.col("kafka_offset") % 2 == 0, F.replace("after", F.lit('"cents"'), F.lit('"discount":"5","cents"'))).otherwise(F.col("after")))
    return silver.typed(b, {"user_id": "bigint", "discount": "bigint"}).select("event_id", "user_id", "discount")


@query
def schema_rename(spark, d):
    b = _bronze(spark, d).withColumn("after", F.when(F.col("kafka_offset") % 2 == 0, F.replace("after", F.lit('"cents"'), F.lit('"amount_cents"'))).otherwise(F.col("after")))
    return silver.typed(b, {"amount_cents|cents": "bigint"}).select("event_id", "amount_cents")


@query
def dlq_reprocess(spark, d):
    q = ingest.dlq_rows(_rows(spark, d))
    fixed = F.when(F.col("original_event") == '{"op":"c"}', '{"op":"c","source":{"lsn":7}}').otherwise(F.col("original_event"))
    return ingest.reprocess(q, fixed).select("topic", "partition", "offset", "operation", "source_lsn", "parse_error_type")


@query
def late_events(spark, d):
    b = _bronze(spark, d)
    shuffled = b.withColumn("source_timestamp", F.timestamp_millis(F.unix_millis("source_timestamp") - 3_600_000 * draw("late", F.col("kafka_offset"), 5)))
    return silver.late(shuffled, 3600, 1000)


@query
def hourly_activity(spark, d):
    e = s.table(spark, d, "events").where("event_type <> 'error'")
    return e.groupBy(F.window(F.col("ts"), "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").cast("timestamp_ntz").alias("hour"), "event_type", "n")


@query
def gold_revenue_by_category(spark, d):
    """Paid revenue by product category; our definition.

    Items are dealt out by product and then by order, into parts that do not grow. Each join holds the part's products or orders and streams the
    items, so that no key fills a task. Items of an order lie together at last: one row for each order and category is all that is left to count.
    """
    o, p, i = s.orders(spark, d), s.products(spark, d).select("product_id", "category"), s.order_items(spark, d).select("order_id", "product_id", "quantity", "unit_price")
    n = parts(i, max(df.count() for df in (o, p, i)))
    paid = o.where("order_status IN ('PAID', 'SHIPPED', 'DELIVERED')").select("order_id").repartition(n, "order_id")
    sold = i.repartition(n, "product_id").join(p.repartition(n, "product_id").hint("shuffle_hash"), "product_id").select("order_id", "category", "quantity", "unit_price")
    one = sold.repartition(n, "order_id").join(paid.hint("shuffle_hash"), "order_id").groupBy("order_id", "category").agg(F.sum(F.col("unit_price") * F.col("quantity")).alias("revenue"), F.sum("quantity").alias("quantity"))
    return one.groupBy("category").agg(F.sum("revenue").cast("decimal(38,2)").alias("revenue"), F.sum("quantity").alias("quantity"), F.count("*").alias("n_orders"))

"""DuckDB SQL for the catalogue, written independently of the Spark expressions."""

from __future__ import annotations

from tidewake.plans.plants import PLANTS, planted


def _draw(tag: str, key: str, below: int) -> str:
    return f"(('0x' || substr(md5('{tag}|' || ({key})), 1, 8))::BIGINT % {below})"


def _pick(tag: str, key: str, names: list[str]) -> str:
    return f"([{', '.join(repr(n) for n in names)}])[({_draw(tag, key, len(names))} + 1)::INTEGER]"


METHODS = ["CREDIT_CARD", "DEBIT_CARD", "UPI", "NET_BANKING", "WALLET", "COD"]
CARRIERS = ["BlueDart", "Delhivery", "DTDC", "India Post", "Ekart", "FedEx"]
CATEGORIES = ["Electronics", "Apparel", "Home & Kitchen", "Books", "Beauty", "Sports & Outdoors", "Toys & Games", "Grocery", "Automotive", "Office Supplies"]
ST = _draw("status", "o_orderkey", 100)

RECORDS = """
rec AS (SELECT 'cdc.' || event_type topic, (user_id % 3)::INTEGER part, event_id off, event_type, user_id, event_id,
  CASE event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r' ELSE CASE WHEN event_id % 7 = 0 THEN 'd' ELSE 'u' END END op,
  floor(value * 100)::BIGINT cents, epoch_us(ts) // 1000 ms, event_id * 10 + 1000 lsn,
  CASE WHEN event_type <> 'view' THEN 'tx-' || (event_id // 10) END tx FROM events),
good AS (SELECT *, CASE WHEN op <> 'd' THEN '{"event_id":' || event_id || ',"user_id":' || user_id || ',"cents":"' || cents || '"}' END aft,
  CASE WHEN op = 'd' THEN '{"event_id":' || event_id || ',"user_id":' || user_id || ',"cents":"' || cents || '"}' WHEN op = 'u' THEN '{"event_id":' || event_id || ',"user_id":' || user_id || ',"cents":"0"}' END bef,
  sha256(topic || '|' || part || '|' || off) eid FROM rec WHERE event_type <> 'error')
"""
BUSINESS = f"""
ord AS (SELECT o_orderkey order_id, o_custkey customer_id, CASE WHEN {ST} < 5 THEN 'PLACED' WHEN {ST} < 13 THEN 'PAID' WHEN {ST} < 25 THEN 'SHIPPED' WHEN {ST} < 90 THEN 'DELIVERED' ELSE 'CANCELLED' END order_status,
  o_totalprice::DECIMAL(12,2) total_amount, o_orderdate created_at FROM orders),
prod AS (SELECT p_partkey product_id, p_name product_name, p_brand category, p_retailprice::DECIMAL(10,2) price, {_draw("stock", "p_partkey", 1001)} stock_quantity FROM part),
item AS (SELECT md5(l_orderkey || '|' || l_partkey || '|' || l_suppkey || '|' || l_linenumber || '|' || round(l_quantity * 100)::BIGINT || '|' || round(l_extendedprice * 100)::BIGINT || '|' || round(l_discount * 100)::BIGINT || '|' || round(l_tax * 100)::BIGINT || '|' || l_returnflag || '|' || l_linestatus) order_item_id,
  l_orderkey order_id, l_partkey product_id, l_quantity::INTEGER quantity, l_extendedprice::DECIMAL(10,2) unit_price FROM lineitem),
retry AS (SELECT 2 * order_id - 1 payment_id, order_id, 'FAILED' payment_status, {_pick("retrymethod", "order_id", METHODS)} payment_method, total_amount amount,
  created_at + to_seconds(30 * (1 + {_draw("retrydelay", "order_id", 60)})) created_at FROM ord WHERE order_status IN ('PAID', 'SHIPPED', 'DELIVERED') AND {_draw("retry", "order_id", 100)} < 8),
pay AS (SELECT 2 * order_id payment_id, order_id, CASE WHEN order_status IN ('PAID', 'SHIPPED', 'DELIVERED') THEN 'SUCCESS' WHEN order_status = 'CANCELLED' THEN if({_draw("coin", "order_id", 2)} = 0, 'REFUNDED', 'FAILED') ELSE if({_draw("coin", "order_id", 2)} = 0, 'PENDING', 'FAILED') END payment_status,
  {_pick("method", "order_id", METHODS)} payment_method, total_amount amount, created_at + to_seconds(60 * (1 + {_draw("paydelay", "order_id", 120)})) created_at FROM ord UNION ALL SELECT * FROM retry),
timed AS (SELECT *, ({_draw("updated", "order_id", 1_000_000)} * (CASE order_status WHEN 'PLACED' THEN 0 WHEN 'SHIPPED' THEN 3 WHEN 'DELIVERED' THEN 6 ELSE 1 END + 1) * 86400 // 1000000)::BIGINT secs, created_at + to_seconds(secs) order_updated FROM ord),
ship1 AS (SELECT *, CASE order_status WHEN 'PAID' THEN 'PENDING' WHEN 'SHIPPED' THEN if({_draw("transit", "order_id", 2)} = 0, 'SHIPPED', 'IN_TRANSIT') ELSE if({_draw("returned", "order_id", 100)} < 95, 'DELIVERED', 'RETURNED') END shipment_status FROM timed WHERE order_status IN ('PAID', 'SHIPPED', 'DELIVERED')),
ship2 AS (SELECT *, CASE WHEN shipment_status <> 'PENDING' THEN order_updated - to_seconds({_draw("shipped", "order_id", 43200)}) END shipped_at FROM ship1),
ship3 AS (SELECT *, CASE WHEN shipment_status IN ('DELIVERED', 'RETURNED') THEN shipped_at + to_seconds(43200 + {_draw("delivered", "order_id", 388800)}) END delivered_at FROM ship2),
ship AS (SELECT order_id shipment_id, order_id, shipment_status, {_pick("carrier", "order_id", CARRIERS)} carrier, shipped_at, delivered_at, coalesce(delivered_at, shipped_at, order_updated) updated_at FROM ship3),
inv0 AS (SELECT (product_id - 1) * 15 + w inventory_id, product_id, w warehouse_id FROM prod, range(1, 16) t(w)),
inv AS (SELECT *, {_draw("available", "inventory_id", 501)} available_quantity, least({_draw("reserved", "inventory_id", 51)}, {_draw("available", "inventory_id", 501)}) reserved_quantity FROM inv0),
req AS (SELECT order_item_id request_id, order_id, product_id, {_draw("warehouse", "order_item_id", 15)} + 1 warehouse_id, quantity FROM item),
cust AS (SELECT c_custkey customer_id, c_name name, replace(lower(replace(c_name, '#', ' ')), ' ', '.') || '.' || c_custkey || '@example.com' email, 'City ' || {_draw("home", "c_custkey", 500)} city, c_nationkey country FROM customer),
pool AS (SELECT product_id, price, row_number() OVER (ORDER BY product_id) - 1 r, count(*) OVER () many FROM prod),
slots AS (SELECT order_id, unnest(range(least({_draw("items", "order_id", 4)} + 1, (SELECT count(*) FROM prod)))) num, (SELECT count(*) FROM prod) many FROM ord),
syn AS (SELECT row_number() OVER (ORDER BY order_id, num) order_item_id, order_id, product_id, {_draw("quantity", "order_id || '|' || num", 5)} + 1 quantity,
  ((((price * 100)::BIGINT * (900 + {_draw("jitter", "order_id || '|' || num", 201)}) + 500) // 1000)::DECIMAL(20,0) / 100)::DECIMAL(10,2) unit_price
  FROM slots JOIN pool ON r = ({_draw("item", "order_id", 1 << 31)} % slots.many + num * ({_draw("stride", "order_id", 1 << 31)} % greatest(slots.many // 4, 1) + 1)) % slots.many)
"""
_NEXT = "CASE order_status WHEN 'PLACED' THEN ['PAID', 'CANCELLED'] WHEN 'PAID' THEN ['SHIPPED', 'CANCELLED'] WHEN 'SHIPPED' THEN ['DELIVERED'] ELSE []::VARCHAR[] END"
_RESOLVED = f"""res AS (SELECT o.order_id, p.payment_id, if({_draw("resolve", "p.payment_id", 100)} < 85, 'SUCCESS', 'FAILED') payment_status FROM ord o JOIN (SELECT order_id, min(payment_id) payment_id FROM pay WHERE payment_status = 'PENDING' GROUP BY 1) p USING (order_id) WHERE order_status = 'PLACED')"""


def _rec(sql: str) -> str:
    return f"WITH {RECORDS} {sql}"


def _biz(sql: str, more: str = "") -> str:
    return f"WITH RECURSIVE {BUSINESS}{', ' + more if more else ''} {sql}"


_OF = {"customers": "cust", "products": "prod", "orders": "ord", "order_items": "item", "payments": "pay", "inventory": "inv", "shipments": "ship"}
_INV = """'{{"inventory_id":' || inventory_id || ',"product_id":' || product_id || ',"warehouse_id":' || warehouse_id || ',"available_quantity":' || ({a}) || ',"reserved_quantity":' || ({r}) || '}}'"""


def _bad(sql: str) -> str:
    """sql over the tables with violations planted in them, as x_bad."""
    more = ", ".join(f"{x}_bad AS (SELECT * REPLACE ({', '.join(planted(t, c) for c in PLANTS[t])}) FROM {x})" for t, x in _OF.items())
    return _biz(sql, more)


def _check(name: str, rules: list[tuple[str, str]], source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' table_name, '{rule}' rule, count(*) FILTER (WHERE NOT ({p})) violations FROM {source}" for rule, p in rules)


def _fk(child: str, column: str, source: str, parent: str, key: str) -> str:
    return f"SELECT '{child}' child, '{column}' fk_column, count(*) violations FROM {source} c WHERE {column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{column})"


#: What the rules say of each edge text, worked out by hand: (operation, lsn, transaction, milliseconds, error), by case.
_PARSE, _KIND, _TYPE, _RANGE = "EnvelopeParseError", "AttributeError", "TypeError", "ValueError"
_PLAIN = ("c", None, None, None, None)
_FULL = ("c", 5, None, 1000, None)
EDGE_CASES: dict[int, tuple] = {
    **{i: (None, None, None, None, _PARSE) for i in (*range(10), 42, 43, 46)},  # no object, or without op or source; text behind the value; single quotes
    **{i: (None, None, None, None, _KIND) for i in (16, 17, 18, 19, 40)},  # source or transaction is something else than an object
    **{i: (None, None, None, None, _TYPE) for i in (25, 26, 27)},
    28: (None, None, None, None, _RANGE),
    11: (None, None, None, None, None),  # op is there, but null
    **{i: _PLAIN for i in (10, 12, 13, 14, 15, 20, 29, 30, 31)},  # an empty source counts as {}; an lsn that is no whole number as none
    21: ("c", None, None, 0, None), 22: ("c", None, None, 1750000000000, None), 23: ("c", None, None, 1500, None), 24: ("c", None, None, 1, None),
    32: ("c", 29481192, None, None, None),
    33: ("5", 5, None, 1000, None), 34: ("true", 5, None, 1000, None), 35: ("zzz", 5, None, 1000, None),
    36: ("c", 5, "987", 1000, None), 37: ("c", 5, "5", 1000, None), **{i: _FULL for i in (38, 39, 41, 44, 45)},
}


def _literal(x: object) -> str:
    return "NULL" if x is None else str(x) if isinstance(x, int) else f"'{x}'"


ORACLES: dict[str, str] = {
    "envelope_edge_cases": "SELECT case_id, operation, source_lsn::BIGINT source_lsn, transaction_id, source_ms::BIGINT source_ms, parse_error_type FROM (VALUES "
    + ", ".join(f"({', '.join(map(_literal, (i, *row)))})" for i, row in sorted(EDGE_CASES.items())) + ") v(case_id, operation, source_lsn, transaction_id, source_ms, parse_error_type)",
    "bronze_ingest": _rec("SELECT eid event_id, op operation, bef AS before, aft AS after, lsn source_lsn, tx transaction_id, topic kafka_topic, part kafka_partition, off kafka_offset, ms source_ms FROM good"),
    "dlq_quarantine": _rec("""SELECT CASE event_id % 4 WHEN 0 THEN '{not json' WHEN 1 THEN '{"op":"c"}' WHEN 2 THEN '[1,2,3]' END original_event,
      CASE event_id % 4 WHEN 0 THEN 'invalid JSON' WHEN 1 THEN 'missing required field ''source''' WHEN 2 THEN 'envelope is not a JSON object' ELSE 'value is null' END error_message,
      'EnvelopeParseError' error_type, topic source_topic, part kafka_partition, off kafka_offset FROM rec WHERE event_type = 'error'"""),
    "event_ids": _rec("SELECT topic, part AS \"partition\", off AS \"offset\", sha256(topic || '|' || part || '|' || off) event_id FROM rec"),
    "topic_route": "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'cdc.' || event_type ELSE 'other.' || event_type END topic FROM events",
    "batch_metrics": _rec("SELECT topic, count(*) FILTER (WHERE event_type <> 'error') good, count(*) FILTER (WHERE event_type = 'error') bad FROM rec GROUP BY 1"),
    "op_mix": _rec("SELECT topic kafka_topic, op operation, count(*) n FROM good GROUP BY ALL"),
    "decode_before_after": _rec("SELECT op operation, count(bef) n_before, count(aft) n_after, sum(CASE op WHEN 'u' THEN 0 WHEN 'd' THEN cents END)::BIGINT before_cents, sum(CASE WHEN op <> 'd' THEN cents END)::BIGINT after_cents FROM good GROUP BY 1"),
    "partition_assignment": f"SELECT o_orderkey order_id, ({_draw('partition', 'o_orderkey', 1 << 20)} % 3)::INTEGER AS \"partition\" FROM orders",
    "open_orders": _biz(f"SELECT order_id, order_status FROM ord WHERE order_status NOT IN ('DELIVERED', 'CANCELLED') ORDER BY {_draw('sample', 'order_id', 1 << 31)}, order_id LIMIT 5000"),
    "next_ids": "WITH m AS (SELECT 'customers' table_name, coalesce(max(c_custkey), 0) max_id FROM customer UNION ALL SELECT 'products', coalesce(max(p_partkey), 0) FROM part UNION ALL SELECT 'orders', coalesce(max(o_orderkey), 0) FROM orders UNION ALL SELECT 'returns', coalesce(max(o_orderkey), 0) FROM orders WHERE o_orderkey < 0) SELECT *, max_id + 1 next_id FROM m",
    "product_pool": _biz("SELECT product_id, price FROM prod ORDER BY 1"),
    "order_totals": _biz("SELECT order_id, sum(unit_price * quantity)::DECIMAL(38,2) items_total, count(*) n_items FROM item JOIN (SELECT order_id FROM ord) USING (order_id) GROUP BY 1"),
    "price_lookup_join": _biz("SELECT product_id, price, sum(quantity)::BIGINT quantity, sum(price * quantity)::DECIMAL(38,2) list_value FROM item JOIN prod USING (product_id) GROUP BY ALL"),
    "pending_payment_lookup": _biz("SELECT o.order_id, min(payment_id) payment_id FROM ord o JOIN pay p ON o.order_id = p.order_id AND payment_status = 'PENDING' WHERE order_status = 'PLACED' GROUP BY 1"),
    "inventory_cross_seed": _biz("SELECT inventory_id, product_id, warehouse_id, available_quantity, reserved_quantity FROM inv"),
    "seed_status_distribution": _biz("SELECT order_status, count(*) n FROM ord GROUP BY 1"),
    "payment_derivation": _biz("SELECT * FROM pay"),
    "retry_payments": _biz("SELECT * FROM retry"),
    "shipment_derivation": _biz("SELECT * FROM ship"),
    "customer_email": _biz("SELECT * FROM cust"),
    "order_timestamps": _biz(f"SELECT order_id, order_status, TIMESTAMP '2026-01-01' - to_seconds({_draw('age', 'order_id', 181 * 86_400)}) created_at, secs AS seconds FROM timed"),
    "product_synthesis": f"""WITH c AS (SELECT p_partkey product_id, split_part(p_name, ' ', 1) w, {_pick("category", "p_partkey", CATEGORIES)} category FROM part)
      SELECT product_id, upper(w[1]) || lower(w[2:]) || ' ' || split_part(category, ' ', 1) || ' ' || product_id product_name, category, ((500 + {_draw("price", "product_id", 49501)})::DECIMAL(12,0) / 100)::DECIMAL(10,2) price, {_draw("stock", "product_id", 1001)} stock_quantity FROM c""",
    "order_item_synthesis": _biz("SELECT * FROM syn"),
    "order_total_synthesis": _biz("SELECT order_id, sum(unit_price * quantity)::DECIMAL(12,2) total_amount FROM syn GROUP BY 1"),
    "id_allocation": _biz("SELECT *, row_number() OVER (ORDER BY order_id, order_item_id) + 1000 item_number FROM (SELECT DISTINCT order_id, order_item_id FROM item)"),
    "seeded_load": _biz("""SELECT 'order_items' table_name, count(*) n, NULL::DECIMAL(38,2) money FROM syn UNION ALL SELECT 'orders', count(*), sum(t)::DECIMAL(38,2) FROM tot
      UNION ALL SELECT 'payments', count(*), sum(t)::DECIMAL(38,2) FROM (SELECT order_id FROM pay) JOIN tot USING (order_id) UNION ALL SELECT 'shipments', count(*), NULL FROM ship""", "tot AS (SELECT order_id, sum(unit_price * quantity) t FROM syn GROUP BY 1)"),
    "new_customer_events": f"""WITH r AS (SELECT c_custkey // 20 + (SELECT max(c_custkey) FROM customer) AS key, c_name, c_nationkey FROM customer WHERE c_custkey % 20 = 0)
      SELECT 'c' op, key, '{{"customer_id":' || key || ',"name":"' || c_name || '","email":"' || replace(lower(replace(c_name, '#', ' ')), ' ', '.') || '.' || key || '@example.com","city":"City ' || {_draw("home", "key", 500)} || '","country":' || c_nationkey || '}}' AS after FROM r""",
    "new_order_events": _biz(
        f"""SELECT 'cdc.orders' topic, 'c' op, order_id AS key, NULL AS before, '{{"order_id":' || order_id || ',"customer_id":' || {_draw("buyer", "order_id", "(SELECT max(c_custkey) FROM customer)")} + 1 || ',"order_status":"PLACED","total_amount":' || t || '}}' AS after FROM sums
      UNION ALL SELECT 'cdc.order_items', 'c', order_item_id, NULL, '{{"order_item_id":' || order_item_id || ',"order_id":' || order_id || ',"product_id":' || product_id || ',"quantity":' || quantity || ',"unit_price":' || unit_price || '}}' FROM cart
      UNION ALL SELECT 'cdc.payments', 'c', 2 * order_id, NULL, '{{"payment_id":' || 2 * order_id || ',"order_id":' || order_id || ',"payment_status":"PENDING","payment_method":"' || {_pick("method", "order_id", METHODS)} || '","amount":' || t || '}}' FROM sums
      UNION ALL SELECT 'cdc.inventory', 'u', inventory_id, {_INV.format(a="a", r="reserved_quantity")}, {_INV.format(a="a - taken", r="reserved_quantity + taken")}
        FROM (SELECT inventory_id, inv.product_id, inv.warehouse_id, inv.available_quantity a, reserved_quantity, taken FROM inv JOIN (SELECT product_id, warehouse_id, max(taken) taken FROM cartfold GROUP BY ALL) USING (product_id, warehouse_id) WHERE taken > 0)""",
        f"""asks AS (SELECT c_custkey // 10 rq, unnest(range({_draw("cart", "rq", 4)} + 1)) num FROM customer WHERE c_custkey % 10 = 0),
      drawn AS (SELECT *, rq + (SELECT max(o_orderkey) FROM orders) order_id, {_draw("cartitem", "rq || '|' || num", "(SELECT max(p_partkey) FROM part)")} + 1 product_id FROM asks),
      cart AS (SELECT order_id * 4 + num order_item_id, order_id, product_id, {_draw("cartquantity", "rq || '|' || num", 5)} + 1 quantity, ((((price * 100)::BIGINT * (900 + {_draw("cartprice", "rq || '|' || num", 201)}) + 500) // 1000)::DECIMAL(20,0) / 100)::DECIMAL(10,2) unit_price,
        {_draw("cartwarehouse", "rq || '|' || num", 15)} + 1 warehouse_id FROM drawn JOIN prod USING (product_id) WHERE product_id % 17 <> 0),
      sums AS (SELECT order_id, sum(unit_price * quantity)::DECIMAL(12,2) t FROM cart GROUP BY 1),
      ck AS (SELECT cart.*, available_quantity a, row_number() OVER (PARTITION BY cart.product_id, cart.warehouse_id ORDER BY order_item_id) k FROM cart JOIN inv USING (product_id, warehouse_id)),
      cartfold AS (SELECT product_id, warehouse_id, k, CASE WHEN a >= quantity THEN quantity ELSE 0 END::BIGINT taken FROM ck WHERE k = 1
        UNION ALL SELECT ck.product_id, ck.warehouse_id, ck.k, f.taken + CASE WHEN ck.a - f.taken >= ck.quantity THEN ck.quantity ELSE 0 END FROM cartfold f JOIN ck ON ck.product_id = f.product_id AND ck.warehouse_id = f.warehouse_id AND ck.k = f.k + 1)""",
    ),
    "cdc_roundtrip": _biz("SELECT order_id, CASE WHEN payment_status = 'SUCCESS' THEN 'u' ELSE 'r' END operation, if(payment_status = 'SUCCESS', 'PAID', order_status) order_status, total_amount FROM ord LEFT JOIN res USING (order_id) WHERE NOT (order_status = 'CANCELLED' AND order_id % 2 = 0)", _RESOLVED),
    "change_mix": _biz("SELECT 'cdc.order_items' topic, 'd' op, count(*) n, sum(quantity)::BIGINT quantity FROM gone HAVING count(*) > 0 UNION ALL SELECT 'cdc.orders', 'u', count(*), 0 FROM gone WHERE greatest(total_amount - quantity * unit_price, 0)::DECIMAL(12,2) <> total_amount HAVING count(*) > 0",
        "uniq AS (SELECT DISTINCT * FROM item), gone AS (SELECT * FROM (SELECT i.*, total_amount, count(*) OVER (PARTITION BY order_id) n, row_number() OVER (PARTITION BY order_id ORDER BY order_item_id) k FROM uniq i JOIN ord USING (order_id) WHERE order_status = 'PLACED') WHERE n > 1 AND k = 1)"),
    "inventory_reserve": _biz(
        """SELECT inventory_id, product_id, warehouse_id, available_quantity - taken available_quantity, reserved_quantity + taken reserved_quantity
           FROM inv JOIN (SELECT product_id, warehouse_id, max(taken) taken FROM fold GROUP BY ALL) USING (product_id, warehouse_id) WHERE taken > 0""",
        """rk AS (SELECT req.*, available_quantity a, row_number() OVER (PARTITION BY req.product_id, req.warehouse_id ORDER BY request_id) k FROM req JOIN inv USING (product_id, warehouse_id)),
           fold AS (SELECT product_id, warehouse_id, k, a, CASE WHEN a >= quantity THEN quantity ELSE 0 END::BIGINT taken FROM rk WHERE k = 1
             UNION ALL SELECT rk.product_id, rk.warehouse_id, rk.k, rk.a, f.taken + CASE WHEN rk.a - f.taken >= rk.quantity THEN rk.quantity ELSE 0 END FROM fold f JOIN rk ON rk.product_id = f.product_id AND rk.warehouse_id = f.warehouse_id AND rk.k = f.k + 1)""",
    ),
    "inventory_release": _biz("SELECT inventory_id, product_id, warehouse_id, (available_quantity + q)::BIGINT available_quantity, greatest(reserved_quantity - q, 0)::BIGINT reserved_quantity FROM inv JOIN (SELECT product_id, warehouse_id, sum(quantity) q FROM req JOIN ord USING (order_id) WHERE order_status IN ('PLACED', 'PAID') GROUP BY ALL) USING (product_id, warehouse_id)"),
    "inventory_restock": _biz(f"SELECT inventory_id, product_id, warehouse_id, available_quantity + {_draw('ramount', 'product_id', 191)} + 10 available_quantity, reserved_quantity FROM inv WHERE warehouse_id = {_draw('rwarehouse', 'product_id', 15)} + 1"),
    "payment_resolution": _biz("SELECT order_id, payment_id, payment_status, if(payment_status = 'SUCCESS', 'PAID', 'PLACED') order_status FROM res", _RESOLVED),
    "shipment_advance": _biz(
        "SELECT order_id, order_id shipment_id, from_status, to_status, coalesce(carrier, fresh) carrier, CASE WHEN to_status = 'SHIPPED' THEN TIMESTAMP '2026-01-01' ELSE shipped_at END shipped_at, CASE WHEN to_status IN ('DELIVERED', 'RETURNED') THEN TIMESTAMP '2026-01-01' ELSE delivered_at END delivered_at, CASE to_status WHEN 'SHIPPED' THEN 'SHIPPED' WHEN 'DELIVERED' THEN 'DELIVERED' ELSE order_status END order_status FROM adv WHERE to_status IS NOT NULL",
        f"adv AS (SELECT o.order_id, order_status, s.shipment_status from_status, s.carrier, s.shipped_at, s.delivered_at, {_pick("newcarrier", "o.order_id", CARRIERS)} fresh, CASE WHEN s.shipment_status IS NULL THEN 'PENDING' WHEN s.shipment_status = 'PENDING' THEN 'SHIPPED' WHEN s.shipment_status = 'SHIPPED' THEN if({_draw('settle', 'o.order_id', 100)} < 95, 'DELIVERED', 'RETURNED') END to_status FROM ord o LEFT JOIN (SELECT * FROM ship WHERE {_draw("lost", "order_id", 10)} > 0) s ON o.order_id = s.order_id WHERE order_status IN ('PAID', 'SHIPPED'))",
    ),
    "order_cancellation": _biz("SELECT order_id, 'CANCELLED' order_status FROM ord WHERE order_status IN ('PLACED', 'PAID')"),
    "delete_item_adjust": _biz("SELECT order_id, order_item_id, greatest(total_amount - quantity * unit_price, 0)::DECIMAL(14,2) total_amount FROM (SELECT i.*, total_amount, count(*) OVER (PARTITION BY order_id) n, row_number() OVER (PARTITION BY order_id ORDER BY order_item_id) k FROM item i JOIN ord USING (order_id) WHERE order_status = 'PLACED') WHERE n > 1 AND k = 1"),
    "price_stock_change": _biz(f"SELECT product_id, if({_draw('which', 'product_id', 2)} = 0, greatest((((price * 100)::BIGINT * (90 + {_draw('delta', 'product_id', 21)}) + 50) // 100)::DECIMAL(20,2) / 100, 1)::DECIMAL(10,2), price) price, if({_draw('which', 'product_id', 2)} = 0, stock_quantity, greatest(stock_quantity + {_draw('stockdelta', 'product_id', 71)} - 20, 0)) stock_quantity FROM prod"),
    "profile_update": f"SELECT c_custkey customer_id, 'city' || {_draw('city', 'c_custkey', 100)} city FROM customer WHERE {_draw('move', 'c_custkey', 20)} = 0",
    "apply_order_changes": _biz("SELECT order_id, if(payment_status = 'SUCCESS', 'PAID', order_status) order_status, total_amount, if(payment_status = 'SUCCESS', TIMESTAMP '2026-01-01', order_updated) updated_at FROM timed LEFT JOIN res USING (order_id) WHERE NOT (order_status = 'CANCELLED' AND order_id % 2 = 0)", _RESOLVED),
    "legal_transitions": _biz(f"SELECT order_id, order_status, array_to_string({_NEXT}, ',') next_statuses, CASE WHEN len({_NEXT}) > 0 THEN ({_NEXT})[({_draw('next', 'order_id', 1000)} % greatest(len({_NEXT}), 1) + 1)::INTEGER] END next_status FROM ord"),
    "terminal_orders": _biz("SELECT order_status, order_status IN ('DELIVERED', 'CANCELLED') terminal, count(*) n FROM ord GROUP BY ALL"),
    "check_violations": _bad(" UNION ALL ".join([
        _check("products", [("price_not_negative", "price >= 0"), ("stock_not_negative", "stock_quantity >= 0")], "prod_bad"),
        _check("orders", [("total_not_negative", "total_amount >= 0"), ("order_status_known", "order_status IN ('PLACED', 'PAID', 'SHIPPED', 'DELIVERED', 'CANCELLED')")], "ord_bad"),
        _check("order_items", [("quantity_positive", "quantity > 0"), ("unit_price_not_negative", "unit_price >= 0")], "item_bad"),
        _check("payments", [("amount_not_negative", "amount >= 0"), ("payment_status_known", "payment_status IN ('PENDING', 'SUCCESS', 'FAILED', 'REFUNDED')"), ("payment_method_known", "payment_method IN ('CREDIT_CARD', 'DEBIT_CARD', 'UPI', 'NET_BANKING', 'WALLET', 'COD')")], "pay_bad"),
        _check("inventory", [("available_not_negative", "available_quantity >= 0"), ("reserved_not_negative", "reserved_quantity >= 0")], "inv_bad"),
        _check("shipments", [("shipment_status_known", "shipment_status IN ('PENDING', 'SHIPPED', 'IN_TRANSIT', 'DELIVERED', 'RETURNED')"), ("delivered_after_shipped", "delivered_at IS NULL OR shipped_at IS NULL OR delivered_at >= shipped_at")], "ship_bad"),
    ])),
    "enum_violations": _bad("SELECT 'orders' table_name, 'order_status' column_name, order_status AS value, count(*) violations FROM ord_bad WHERE order_status NOT IN ('PLACED', 'PAID', 'SHIPPED', 'DELIVERED', 'CANCELLED') GROUP BY ALL "
        "UNION ALL SELECT 'payments', 'payment_status', payment_status, count(*) FROM pay_bad WHERE payment_status NOT IN ('PENDING', 'SUCCESS', 'FAILED', 'REFUNDED') GROUP BY ALL "
        "UNION ALL SELECT 'payments', 'payment_method', payment_method, count(*) FROM pay_bad WHERE payment_method NOT IN ('CREDIT_CARD', 'DEBIT_CARD', 'UPI', 'NET_BANKING', 'WALLET', 'COD') GROUP BY ALL "
        "UNION ALL SELECT 'shipments', 'shipment_status', shipment_status, count(*) FROM ship_bad WHERE shipment_status NOT IN ('PENDING', 'SHIPPED', 'IN_TRANSIT', 'DELIVERED', 'RETURNED') GROUP BY ALL"),
    "fk_violations": _bad(" UNION ALL ".join([
        _fk("orders", "customer_id", "ord_bad", "cust_bad", "customer_id"), _fk("order_items", "order_id", "item_bad", "ord_bad", "order_id"), _fk("order_items", "product_id", "item_bad", "prod_bad", "product_id"),
        _fk("payments", "order_id", "pay_bad", "ord_bad", "order_id"), _fk("inventory", "product_id", "inv_bad", "prod_bad", "product_id"), _fk("inventory", "warehouse_id", "inv_bad", "(SELECT w.range warehouse_id FROM range(1, 16) w)", "warehouse_id"), _fk("shipments", "order_id", "ship_bad", "ord_bad", "order_id"),
    ])),
    "unique_violations": _bad("SELECT 'customers' table_name, count(*) violations FROM (SELECT email FROM cust_bad GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT 'inventory', count(*) FROM (SELECT product_id, warehouse_id FROM inv_bad GROUP BY ALL HAVING count(*) > 1)"),
    "silver_dedup": _rec("SELECT eid event_id, op operation, bef AS before, aft AS after, lsn source_lsn, tx transaction_id, topic kafka_topic, part kafka_partition, off kafka_offset FROM good"),
    "silver_current_state": _rec("SELECT user_id::VARCHAR user_id, op operation, aft AS after, lsn source_lsn, off kafka_offset FROM good QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY lsn DESC) = 1 AND op <> 'd'"),
    "silver_typed": _rec("SELECT eid event_id, op operation, user_id, cents, NULL::BIGINT event_id_missing FROM good"),
    "status_history_audit": f"""WITH s AS (SELECT user_id, event_id, (['PLACED', 'PAID', 'SHIPPED', 'DELIVERED', 'CANCELLED'])[({_draw('audit', 'event_id', 5)} + 1)::INTEGER] order_status FROM events),
      h AS (SELECT *, lag(order_status) OVER (PARTITION BY user_id ORDER BY event_id) previous_status FROM s)
      SELECT previous_status, order_status, previous_status IS NULL OR previous_status = order_status OR previous_status || '>' || order_status IN ('PLACED>PAID', 'PLACED>CANCELLED', 'PAID>SHIPPED', 'PAID>CANCELLED', 'SHIPPED>DELIVERED') legal, count(*) n FROM h GROUP BY ALL""",
    "status_durations": "SELECT user_id, event_id, event_type, lead(event_type) OVER w next_type, lead(epoch_us(ts) // 1000) OVER w - epoch_us(ts) // 1000 ms FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)",
    "schema_additive": _rec("SELECT eid event_id, user_id, CASE WHEN off % 2 = 0 AND op <> 'd' THEN 5 END::BIGINT discount FROM good"),
    "schema_rename": _rec("SELECT eid event_id, cents amount_cents FROM good"),
    "dlq_reprocess": _rec("""SELECT topic, part AS "partition", off AS "offset", CASE WHEN event_id % 4 = 1 THEN 'c' END operation, CASE WHEN event_id % 4 = 1 THEN 7 END::BIGINT source_lsn, CASE WHEN event_id % 4 <> 1 THEN 'EnvelopeParseError' END parse_error_type FROM rec WHERE event_type = 'error'"""),
    "late_events": _rec(f"""SELECT kafka_topic, count(*) n, count(*) FILTER (WHERE m - t > 3600000) n_late FROM (SELECT topic kafka_topic, t, max(t) OVER (PARTITION BY topic, part ORDER BY off ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) m FROM (SELECT *, ms - 3600000 * {_draw('late', 'off', 5)} t FROM good)) GROUP BY 1"""),
    "hourly_activity": "SELECT date_trunc('hour', ts)::TIMESTAMP AS hour, event_type, count(*) n FROM events WHERE event_type <> 'error' GROUP BY ALL",
    "gold_revenue_by_category": _biz("SELECT category, sum(unit_price * quantity)::DECIMAL(38,2) revenue, sum(quantity)::BIGINT quantity, count(DISTINCT order_id) n_orders FROM item JOIN ord USING (order_id) JOIN prod USING (product_id) WHERE order_status IN ('PAID', 'SHIPPED', 'DELIVERED') GROUP BY 1"),
}

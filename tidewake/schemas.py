"""Fixed schemas, enumerations and constraints of the data model.

Fixed values: these must equal the source system's.
"""

BRONZE = (
    "event_id STRING, operation STRING, before STRING, after STRING, source_timestamp TIMESTAMP, source_lsn BIGINT, "
    "transaction_id STRING, kafka_topic STRING, kafka_partition INT, kafka_offset BIGINT, ingestion_timestamp TIMESTAMP"
)
DLQ = "original_event STRING, error_message STRING, error_type STRING, source_topic STRING, kafka_partition INT, kafka_offset BIGINT, failed_at TIMESTAMP"
RECORD = "topic STRING, partition INT, offset BIGINT, value BINARY"

CAPTURED = ["customers", "products", "orders", "order_items", "payments", "inventory", "shipments"]

ORDER_STATUS = ["PLACED", "PAID", "SHIPPED", "DELIVERED", "CANCELLED"]
PAYMENT_STATUS = ["PENDING", "SUCCESS", "FAILED", "REFUNDED"]
PAYMENT_METHODS = ["CREDIT_CARD", "DEBIT_CARD", "UPI", "NET_BANKING", "WALLET", "COD"]
SHIPMENT_STATUS = ["PENDING", "SHIPPED", "IN_TRANSIT", "DELIVERED", "RETURNED"]
CARRIERS = ["BlueDart", "Delhivery", "DTDC", "India Post", "Ekart", "FedEx"]
CATEGORIES = ["Electronics", "Apparel", "Home & Kitchen", "Books", "Beauty", "Sports & Outdoors", "Toys & Games", "Grocery", "Automotive", "Office Supplies"]
ORDER_TRANSITIONS = {"PLACED": ["PAID", "CANCELLED"], "PAID": ["SHIPPED", "CANCELLED"], "SHIPPED": ["DELIVERED"], "DELIVERED": [], "CANCELLED": []}
SEED_WEIGHTS = {"PLACED": 5, "PAID": 8, "SHIPPED": 12, "DELIVERED": 65, "CANCELLED": 10}

#: (table, rule, predicate that a row must not make false).
CHECKS = [
    ("products", "price_not_negative", "price >= 0"),
    ("products", "stock_not_negative", "stock_quantity >= 0"),
    ("orders", "total_not_negative", "total_amount >= 0"),
    ("orders", "order_status_known", "order_status IN ('PLACED', 'PAID', 'SHIPPED', 'DELIVERED', 'CANCELLED')"),
    ("order_items", "quantity_positive", "quantity > 0"),
    ("order_items", "unit_price_not_negative", "unit_price >= 0"),
    ("payments", "amount_not_negative", "amount >= 0"),
    ("payments", "payment_status_known", "payment_status IN ('PENDING', 'SUCCESS', 'FAILED', 'REFUNDED')"),
    ("payments", "payment_method_known", "payment_method IN ('CREDIT_CARD', 'DEBIT_CARD', 'UPI', 'NET_BANKING', 'WALLET', 'COD')"),
    ("inventory", "available_not_negative", "available_quantity >= 0"),
    ("inventory", "reserved_not_negative", "reserved_quantity >= 0"),
    ("shipments", "shipment_status_known", "shipment_status IN ('PENDING', 'SHIPPED', 'IN_TRANSIT', 'DELIVERED', 'RETURNED')"),
    ("shipments", "delivered_after_shipped", "delivered_at IS NULL OR shipped_at IS NULL OR delivered_at >= shipped_at"),
]
#: (table, column, values that it may have).
ENUMS = [("orders", "order_status", ORDER_STATUS), ("payments", "payment_status", PAYMENT_STATUS), ("payments", "payment_method", PAYMENT_METHODS), ("shipments", "shipment_status", SHIPMENT_STATUS)]
#: (child, column, parent, column).
FOREIGN_KEYS = [
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("payments", "order_id", "orders", "order_id"),
    ("inventory", "product_id", "products", "product_id"),
    ("inventory", "warehouse_id", "warehouses", "warehouse_id"),
    ("shipments", "order_id", "orders", "order_id"),
]
UNIQUE = [("customers", ["email"]), ("inventory", ["product_id", "warehouse_id"])]
N_WAREHOUSES = 15

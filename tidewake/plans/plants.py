"""Violations planted by rule, so that audits have something to find: for each table, columns with the condition and the value put there."""

PLANTS: dict[str, dict[str, tuple[str, str]]] = {
    "customers": {"email": ("customer_id % 50 = 1", "'double@example.com'")},
    "products": {"price": ("product_id % 97 = 3", "-1"), "stock_quantity": ("product_id % 89 = 2", "-5")},
    "orders": {"total_amount": ("order_id % 101 = 4", "-10"), "order_status": ("order_id % 103 = 5", "'LOST'"), "customer_id": ("order_id % 107 = 6", "-1")},
    "order_items": {"quantity": ("quantity = 5", "0"), "unit_price": ("product_id % 83 = 1", "-1"), "order_id": ("order_id % 79 = 8", "-order_id"), "product_id": ("quantity = 13", "-1")},
    "payments": {"amount": ("payment_id % 109 = 7", "-1"), "payment_status": ("payment_id % 113 = 9", "'HELD'"), "payment_method": ("payment_id % 127 = 11", "'CHEQUE'"), "order_id": ("payment_id % 131 = 13", "-1")},
    "inventory": {"available_quantity": ("inventory_id % 137 = 1", "-1"), "reserved_quantity": ("inventory_id % 139 = 2", "-1"), "product_id": ("inventory_id % 149 = 3", "-1"), "warehouse_id": ("inventory_id % 151 = 4", "99")},
    "shipments": {"shipment_status": ("shipment_id % 157 = 5", "'STUCK'"), "delivered_at": ("shipment_id % 5 = 0 AND delivered_at IS NOT NULL", "shipped_at - INTERVAL '1' HOUR"), "order_id": ("shipment_id % 163 = 6", "-1")},
}


def planted(table: str, column: str) -> str:
    """The column's expression, in SQL that Spark and DuckDB share."""
    when = PLANTS[table].get(column)
    return f"CASE WHEN {when[0]} THEN {when[1]} ELSE {column} END AS {column}" if when else column

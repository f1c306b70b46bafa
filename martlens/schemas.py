"""Explicit StructTypes of the retail tables (never inferred)."""

from pyspark.sql import types as T

L, I, S, Dt, B = T.LongType(), T.IntegerType(), T.StringType(), T.DateType(), T.BooleanType()
TS = T.TimestampNTZType()  # wall-clock timestamps, independent of session/process zone
MONEY = T.DecimalType(18, 2)


def _st(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


CUSTOMERS = _st(("customer_id", L), ("email", S), ("first_name", S), ("last_name", S),
                ("signup_date", Dt), ("country", S), ("customer_tier", S))
CUSTOMERS_ACTIVE = _st(*[(f.name, f.dataType) for f in CUSTOMERS.fields], ("is_active", B))
PRODUCTS = _st(("product_id", L), ("product_name", S), ("category", S), ("subcategory", S),
               ("unit_cost", I), ("selling_price", I), ("launch_date", Dt), ("is_active", B))
ORDERS = _st(("order_id", L), ("customer_id", L), ("order_date", Dt), ("order_status", S),
             ("payment_method", S), ("shipping_country", S), ("total_amount", I),
             ("final_total", MONEY))
ORDER_ITEMS = _st(("order_item_id", L), ("order_id", L), ("product_id", L), ("quantity", I),
                  ("unit_price", I), ("discount_percent", I))
INVENTORY = _st(("inventory_id", L), ("product_id", L), ("warehouse_location", S),
                ("stock_quantity", I), ("last_updated", TS))
CUSTOMER_REVIEWS = _st(("review_id", L), ("product_id", L), ("customer_id", L), ("rating", I),
                       ("review_text", S), ("review_date", Dt), ("is_verified_purchase", B))
PROMOTIONS = _st(("promotion_id", I), ("promotion_code", S), ("discount_type", S),
                 ("discount_value", I), ("start_date", Dt), ("end_date", Dt),
                 ("max_uses", I), ("times_used", I))
PROMOTION_USAGE = _st(("usage_id", L), ("promotion_id", I), ("order_id", L),
                      ("discount_applied", B), ("used_date", Dt))
DQ_ISSUES = _st(("id", L), ("check_name", S), ("severity", S), ("row_count", L),
                ("sample_ids", S), ("details", S), ("detected_at", TS))
DATA_FIX_AUDIT = _st(("audit_id", L), ("check_name", S), ("fix_date", TS), ("fixed_by", S),
                     ("sql_executed", S), ("notes", S))
DQ_NOTIFICATIONS = _st(("channel", S), ("payload", S), ("detected_at", TS))

TABLES = {
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "inventory": INVENTORY,
    "customer_reviews": CUSTOMER_REVIEWS,
    "promotions": PROMOTIONS,
    "promotion_usage": PROMOTION_USAGE,
    "dq_issues": DQ_ISSUES,
    "data_fix_audit": DATA_FIX_AUDIT,
}

# Primary keys (also used by rule_primary_key)
PRIMARY_KEYS = {
    "customers": "customer_id", "products": "product_id", "orders": "order_id",
    "order_items": "order_item_id", "inventory": "inventory_id",
    "customer_reviews": "review_id", "promotions": "promotion_id",
    "promotion_usage": "usage_id", "dq_issues": "id", "data_fix_audit": "audit_id",
}

# Foreign keys: (child table, column, parent table, parent column)
FOREIGN_KEYS = [
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("inventory", "product_id", "products", "product_id"),
    ("customer_reviews", "product_id", "products", "product_id"),
    ("customer_reviews", "customer_id", "customers", "customer_id"),
    ("promotion_usage", "promotion_id", "promotions", "promotion_id"),
    ("promotion_usage", "order_id", "orders", "order_id"),
]

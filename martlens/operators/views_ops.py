"""Registry entries for sources (full scans, ordered scan) and the base views."""

from __future__ import annotations

from pyspark.sql import functions as F

from martlens.operators.cleaning import fix_is_active
from martlens.plans import views

SRC_TABLES = ("customers", "products", "orders", "order_items", "inventory", "customer_reviews",
              "promotions", "promotion_usage")

OPS = {f"src_table_{n}": (lambda t, p, n=n: t[n]) for n in SRC_TABLES}
OPS["src_table"] = lambda t, p: t["orders"]  # the canonical full scan; every table has its own key above
OPS["src_ordered_scan"] = lambda t, p: t.dq_issues.orderBy(F.col("detected_at").asc_nulls_last(), "id")
OPS.update({
    "view_base_orders": lambda t, p: views.base_orders(t),
    "view_base_order_items": lambda t, p: views.base_order_items(t),
    "view_base_products": lambda t, p: views.base_products(t),
    "view_base_customers": lambda t, p: views.base_customers(t.replace(customers=fix_is_active(t)), with_active=True),
    "view_base_reviews": lambda t, p: views.base_reviews(t),
    "view_base_inventory": lambda t, p: views.base_inventory(t),
})

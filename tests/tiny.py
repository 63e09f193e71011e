"""Tiny hand-made star schemas for edge-case tests."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from atelier.schemas import D_CRAFTSMAN, D_CUSTOMER, D_PRODUCT, F_ORDER

D = dt.date
OLD = dt.datetime(2020, 1, 1)
NEW = dt.datetime(2024, 1, 1)


def star(spark, orders, products=None, craftsmen=None, customers=None):
    """orders: (order_id, product_id, craftsman_id, customer_id, created, completion, status[, load])."""
    products = products or [(1, "p1", "d1", "cat-a", 100, OLD), (2, "p2", "d2", "cat-b", 200, OLD)]
    craftsmen = craftsmen or [
        (1, "c1", "a1", D(1980, 1, 1), "c1@x", OLD),
        (2, "c2", "a2", D(1981, 1, 1), "c2@x", OLD),
    ]
    customers = customers or [
        (10, "u10", "addr", D(1990, 1, 1), "u10@x", OLD),
        (11, "u11", "addr", D(1991, 1, 1), "u11@x", OLD),
    ]
    fo = [o if len(o) == 8 else (*o, OLD) for o in orders]
    return {
        "f_order": spark.createDataFrame(fo, F_ORDER),
        "d_product": spark.createDataFrame([(*p[:4], Decimal(p[4]), *p[5:]) for p in products], D_PRODUCT),
        "d_craftsman": spark.createDataFrame(craftsmen, D_CRAFTSMAN),
        "d_customer": spark.createDataFrame(customers, D_CUSTOMER),
    }


def order(oid, product=1, craftsman=1, customer=10, created=D(2024, 1, 5), done_after=None, status=None):
    completion = created + dt.timedelta(days=done_after) if done_after is not None else None
    if status is None:
        status = "done" if done_after is not None else "created"
    return (oid, product, craftsman, customer, created, completion, status)

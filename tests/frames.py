"""Tiny hand-written source frames (FIXTURES.md §3)."""

import datetime as dt
from decimal import Decimal as D

from valuepay import schemas as S


def ts(s):
    return dt.datetime.fromisoformat(s) if s else None


def orders(spark, rows):
    """rows: (order_id, customer_id, status, purchase_ts)"""
    full = [(o, c, st, ts(t), None, None, None, None) for o, c, st, t in rows]
    return spark.createDataFrame(full, S.ORDERS)


def payments(spark, rows):
    """rows: (order_id, seq, type, installments, value)"""
    return spark.createDataFrame([(o, q, t, i, D(v)) for o, q, t, i, v in rows], S.ORDER_PAYMENTS)


def items(spark, rows):
    """rows: (order_id, item_id, price, freight)"""
    return spark.createDataFrame([(o, i, "p", "s", None, D(p), D(f)) for o, i, p, f in rows], S.ORDER_ITEMS)


def customers(spark, rows):
    """rows: (customer_id, unique_id, zip, city, state)"""
    return spark.createDataFrame(rows, S.CUSTOMERS)


def geolocation(spark, rows):
    """rows: (zip, lat, lng, city, state)"""
    return spark.createDataFrame(rows, S.GEOLOCATION)

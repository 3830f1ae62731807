"""Literal bronze rows for edge cases the driver data cannot show."""

from __future__ import annotations

from decimal import Decimal

from ledgerflow import schemas as S


def order(order_id, customer_id=1, product_id=1, unit_price="10.00", quantity=1, discount="0.00",
          total_amount="10.00", status="completed", created_at="2024-01-10T10:00:00+00:00",
          product_name="p", category="c", country="US", payment_method="card"):
    dec = lambda v: None if v is None else Decimal(v)
    return (order_id, customer_id, product_id, product_name, category, dec(unit_price), quantity,
            dec(discount), dec(total_amount), country, status, payment_method, created_at)


def customer(customer_id, email="a@x.com", segment="standard", joined_at="2023-01-01T00:00:00+00:00"):
    return (customer_id, f"name{customer_id}", email, "US", segment, joined_at)


def product(product_id, base_price="10.00", name="p", category="c", rating=4.0):
    return (product_id, name, category, Decimal(base_price), 0, rating, 0)


def orders_df(spark, rows):
    return spark.createDataFrame(rows, S.BRONZE_ORDERS)


def customers_df(spark, rows):
    return spark.createDataFrame(rows, S.BRONZE_CUSTOMERS)


def products_df(spark, rows):
    return spark.createDataFrame(rows, S.BRONZE_PRODUCTS)

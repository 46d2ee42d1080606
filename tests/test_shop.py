"""The order schema's literal rows with results worked out by hand."""

from __future__ import annotations

import uuid
from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from shelfmark import schemas
from shelfmark.operators import change, joins, quality
from shelfmark.plans import layers, shop
from shelfmark.session import fresh_path
from shelfmark.sources import tables

# Fixed values.
CUSTOMERS = [
    (101, "Aarav", "Sharma", "aarav.s@email.com", "Mumbai", "Maharashtra", date(2024, 1, 15), True),
    (102, "Priya", "Patel", "priya.p@email.com", "Ahmedabad", "Gujarat", date(2024, 2, 20), False),
    (103, "Rohan", "Gupta", "rohan.g@email.com", "Delhi", "Delhi", date(2024, 3, 10), True),
    (104, "Sneha", "Reddy", "sneha.r@email.com", "Hyderabad", "Telangana", date(2024, 4, 5), False),
    (105, "Vikram", "Singh", "vikram.s@email.com", "Jaipur", "Rajasthan", date(2024, 5, 12), True),
    (106, "Ananya", "Iyer", "ananya.i@email.com", "Chennai", "Tamil Nadu", date(2024, 6, 18), False),
    (107, "Karan", "Mehta", "karan.m@email.com", "Pune", "Maharashtra", date(2024, 7, 22), True),
    (108, "Divya", "Nair", "divya.n@email.com", "Kochi", "Kerala", date(2024, 8, 30), False),
]
PRODUCTS = [
    (201, "Wireless Earbuds", "Electronics", "BoAt", D("1499.00"), 250),
    (202, "Cotton T-Shirt", "Clothing", "Levis", D("799.00"), 500),
    (203, "Smart Watch", "Electronics", "Noise", D("2999.00"), 150),
    (204, "Running Shoes", "Clothing", "Nike", D("4599.00"), 120),
    (205, "Bluetooth Speaker", "Electronics", "JBL", D("3499.00"), 200),
    (206, "Bedsheet Set", "Home", "Spaces", D("1299.00"), 300),
    (207, "Laptop Stand", "Electronics", "AmazonBasics", D("899.00"), 180),
    (208, "Cushion Covers (Set)", "Home", "HomeCenter", D("599.00"), 400),
]
ORDERS = [
    (1001, 101, date(2024, 8, 1), "Delivered", D("4498.00")),
    (1002, 102, date(2024, 8, 3), "Delivered", D("799.00")),
    (1003, 103, date(2024, 8, 5), "Shipped", D("7498.00")),
    (1004, 101, date(2024, 8, 10), "Delivered", D("3499.00")),
    (1005, 104, date(2024, 8, 12), "Cancelled", D("2999.00")),
    (1006, 105, date(2024, 8, 15), "Delivered", D("5898.00")),
    (1007, 106, date(2024, 8, 18), "Pending", D("1299.00")),
    (1008, 103, date(2024, 8, 20), "Delivered", D("899.00")),
    (1009, 107, date(2024, 8, 25), "Shipped", D("6098.00")),
    (1010, 108, date(2024, 8, 28), "Delivered", D("1598.00")),
]


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame(CUSTOMERS, schemas.SHOP["customers"])


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame(PRODUCTS, schemas.SHOP["products"])


@pytest.fixture(scope="module")
def orders(spark):
    return spark.createDataFrame(ORDERS, schemas.SHOP["orders"])


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def test_selections(customers, products, orders):
    assert rows(shop.by_status(orders, "Delivered"), "order_id") == [(i,) for i in (1001, 1002, 1004, 1006, 1008, 1010)]
    assert rows(shop.by_category_above(products, "Electronics", 2000), "product_id") == [(203,), (205,)]
    window = shop.placed_between(orders, date(2024, 8, 10), date(2024, 8, 25), "Cancelled")
    assert rows(window, "order_id") == [(1004,), (1006,), (1007,), (1008,), (1009,)]
    joined = customers.withColumnRenamed("join_date", "order_date")
    assert shop.placed_in_year(joined, 2024).count() == 8
    assert shop.placed_in_year(joined, 2023).count() == 0


def test_figures(products, orders):
    assert shop.count_rows(orders).first()[0] == 10
    assert shop.count_distinct(orders, "customer_id", "n").first()[0] == 8
    assert shop.count_distinct(orders, "customer_id", "n", approximate=True).first()[0] == 8
    assert shop.revenue_of_status(orders, "Delivered").first()[0] == D("17191.00")
    assert rows(shop.avg_price_by_category(products)) == [
        ("Clothing", D("2699.00")), ("Electronics", D("2224.00")), ("Home", D("949.00"))]
    assert rows(shop.categories_above(products, 2000), "category") == [("Clothing",), ("Electronics",)]
    assert rows(shop.price_extremes(products)) == [
        ("Clothing", D("4599.00"), D("799.00")), ("Electronics", D("3499.00"), D("899.00")),
        ("Home", D("1299.00"), D("599.00"))]
    assert tuple(shop.delivered_or_not(orders, "Delivered").first()) == (6, 4)
    assert [tuple(r) for r in shop.status_revenue(orders).collect()] == [
        ("Delivered", 6, D("17191.00")), ("Shipped", 2, D("13596.00")), ("Cancelled", 1, D("2999.00")),
        ("Pending", 1, D("1299.00"))]


def test_price_tiers(products):
    tiers = dict(rows(shop.price_tiers(products), "product_id", "price_tier"))
    assert tiers == {201: "Mid-Range", 202: "Budget", 203: "Mid-Range", 204: "Premium", 205: "Premium",
                     206: "Mid-Range", 207: "Budget", 208: "Budget"}


def test_stock_update(spark, products):
    sold = spark.createDataFrame([(202, 1), (208, 1), (202, 2)], "product_id int, quantity int")
    stock = dict(rows(change.apply_stock_deltas(products, sold), "product_id", "stock_qty"))
    assert (stock[202], stock[208], stock[201]) == (497, 399, 250)


def test_constraints_report_broken_rows(spark, customers, products, orders):
    bad_orders = orders.unionByName(
        spark.createDataFrame([(1011, 999, date(2024, 9, 1), "Pending", D("2500"))], schemas.SHOP["orders"]))
    bad_products = products.unionByName(
        spark.createDataFrame([(209, "Test Product", "Electronics", "TestBrand", D("-50"), 100)], schemas.SHOP["products"]))
    report = quality.constraint_report({
        "products": (bad_products, quality.Constraints(unique=["product_id"], checks={"price": F.col("unit_price") > 0})),
        "orders": (bad_orders, quality.Constraints(
            references=[quality.Reference("customer_id", customers, "customer_id")])),
    })
    assert rows(report) == [("orders", "foreign_key", "customer_id", 1), ("products", "check", "price", 1),
                            ("products", "unique", "product_id", 0)]


def test_outer_joins_match_spark(spark):
    """NULL keys, unmatched rows on both sides, and a key that holds most rows."""
    one = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "d")], "k int, n string")
    many = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 50), (9, 51), (None, 52)], "k int, v int")

    def found(df):
        return sorted(df.select("k", "n", "v").collect(), key=str)
    assert found(joins.keep_all_of_one(one, many, "k")) == found(one.join(many, "k", "left"))
    assert found(joins.keep_all_of_many(one, many, "k")) == found(one.join(many, "k", "right"))
    assert found(joins.keep_all(one, many, "k")) == found(one.join(many, "k", "full"))
    assert joins.orphan_count(many, "k", one, "k").first()[0] == 2
    assert joins.orphan_count(many, "k", one, "k", count_null=False).first()[0] == 1


def test_order_batch_is_checked_before_it_is_written(spark, customers, orders):
    name = f"orders_{uuid.uuid4().hex}"
    tables.save_table(orders, name, fresh_path(spark, name))
    owner = [quality.Reference("customer_id", customers, "customer_id")]

    def batch(customer):
        return spark.createDataFrame([(1011, customer, date(2024, 9, 1), "Pending", D("1598.00"))], schemas.SHOP["orders"])
    with pytest.raises(layers.OrphanError):
        layers.append_checked(batch(999), name, "order_id", owner)
    assert tables.read_table(spark, name).count() == 10
    for _ in range(2):
        layers.append_checked(batch(102), name, "order_id", owner)
    assert tables.read_table(spark, name).count() == 11
    tables.drop_table(spark, name)

"""Explicit schemas. Identifiers, phones, cards and postal codes are text, so nothing loses its
leading zeros; money is DECIMAL."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType, DataType, DateType, DecimalType, IntegerType, StringType, StructField, StructType,
)

INT, TEXT, DATE, FLAG = IntegerType(), StringType(), DateType(), BooleanType()


def _schema(required: tuple[str, ...] = (), **columns: DataType) -> StructType:
    return StructType([StructField(name, kind, name not in required) for name, kind in columns.items()])


# Order schema.
SHOP = {
    "customers": _schema(
        customer_id=INT, first_name=TEXT, last_name=TEXT, email=TEXT, city=TEXT, state=TEXT, join_date=DATE,
        is_premium=FLAG, required=("customer_id", "first_name", "last_name", "email", "join_date"),
    ),
    "products": _schema(
        product_id=INT, product_name=TEXT, category=TEXT, brand=TEXT, unit_price=DecimalType(10, 2),
        stock_qty=INT, required=("product_id", "product_name", "category", "unit_price", "stock_qty"),
    ),
    "orders": _schema(
        order_id=INT, customer_id=INT, order_date=DATE, status=TEXT, total_amount=DecimalType(12, 2),
        required=("order_id", "customer_id", "order_date"),
    ),
    "order_items": _schema(
        item_id=INT, order_id=INT, product_id=INT, quantity=INT, unit_price=DecimalType(10, 2),
        discount_pct=DecimalType(5, 2),
        required=("item_id", "order_id", "product_id", "quantity", "unit_price"),
    ),
}

# Flat superstore file, as typed columns; the names are also those of the positional rename.
SUPERSTORE = _schema(
    row_id=TEXT, order_id=TEXT, order_date=TEXT, ship_date=TEXT, ship_mode=TEXT, customer_id=TEXT,
    customer_name=TEXT, segment=TEXT, country=TEXT, city=TEXT, state=TEXT, postal_code=TEXT, region=TEXT,
    product_id=TEXT, category=TEXT, sub_category=TEXT, product_name=TEXT, sales=DecimalType(12, 2),
    quantity=INT, discount=DecimalType(4, 2), profit=DecimalType(14, 4), total_amount=DecimalType(14, 2),
)

# E-commerce tables after cleaning.
STORE_CLEAN = {
    "customers": _schema(
        customer_id=TEXT, customer_name=TEXT, email=TEXT, registration_date=DATE, customer_type=TEXT,
        region_code=TEXT, email_valid=INT,
        required=("customer_id", "customer_name", "email", "registration_date", "customer_type", "region_code",
            "email_valid"),
    ),
    "products": _schema(
        product_id=TEXT, product_name=TEXT, category=TEXT, subcategory=TEXT, cost_price=DecimalType(12, 2),
        required=("product_id", "product_name", "category", "subcategory", "cost_price"),
    ),
    "orders": _schema(
        order_id=TEXT, customer_id=TEXT, order_date=DATE, status=TEXT, region_code=TEXT, is_guest=INT,
        required=("order_id", "order_date", "status", "region_code", "is_guest"),
    ),
    "order_items": _schema(
        item_id=TEXT, order_id=TEXT, product_id=TEXT, quantity=DecimalType(14, 6), unit_price=DecimalType(14, 6),
        discount_percent=DecimalType(9, 6),
        required=("item_id", "order_id", "product_id", "quantity", "unit_price", "discount_percent"),
    ),
}

# Lakehouse tables.
LAKE = {
    "customers": _schema(
        customer_id=TEXT, customer_name=TEXT, email=TEXT, phone=TEXT, dob=DATE, address=TEXT, city=TEXT,
        state=TEXT, signup_date=DATE, required=("customer_id", "customer_name", "email"),
    ),
    "products": _schema(
        product_id=TEXT, product_name=TEXT, category=TEXT, cost_price=DecimalType(10, 2),
        selling_price=DecimalType(10, 2),
        required=("product_id", "product_name", "category", "cost_price", "selling_price"),
    ),
    "orders": _schema(
        order_id=TEXT, customer_id=TEXT, product_id=TEXT, quantity=INT, unit_price=DecimalType(10, 2),
        total_amount=DecimalType(10, 2), order_date=DATE, status=TEXT, payment_method=TEXT,
        required=("order_id", "customer_id", "product_id", "quantity", "unit_price", "total_amount", "order_date", "status"),
    ),
    "payments": _schema(
        payment_id=TEXT, order_id=TEXT, card_number=TEXT, cvv=TEXT, amount=DecimalType(10, 2),
        payment_date=DATE, payment_status=TEXT,
        required=("payment_id", "order_id", "amount", "payment_date", "payment_status"),
    ),
}


def required(schema: StructType) -> list[str]:
    """The NOT NULL columns."""
    return [f.name for f in schema.fields if not f.nullable]


def all_text(schema: StructType) -> StructType:
    """The same columns, all as text."""
    return StructType([StructField(f.name, TEXT) for f in schema.fields])

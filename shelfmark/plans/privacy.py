"""Silver layer: direct identifiers are masked or replaced by tokens before anything is shared."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.dates import age_in_years
from shelfmark.functions.text import keep_first, mask_address, mask_card, mask_email, mask_phone, tier, token

# Fixed values. The first band also holds ages under 18.
AGE_BANDS = [(25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54")]
OLDEST_BAND = "55+"
SPENDING_LABELS = ("Low", "Medium", "High")
HIGHEST_SPENDING = "Very High"


def mask_customers(customers: DataFrame, as_of: Column, secret: str | None = None) -> DataFrame:
    """Token in place of the id, masked name and contacts, age band in place of the birth date."""
    age = age_in_years(F.col("dob"), as_of)
    return customers.select(
        keep_first(F.col("customer_name")).alias("customer_name"),
        mask_email(F.col("email")).alias("email"),
        mask_phone(F.col("phone")).alias("phone"),
        mask_address(F.col("address")).alias("address"),
        "city", "state", "signup_date",
        token(F.col("customer_id"), secret).alias("customer_token"),
        age.alias("age"),
        tier(age, AGE_BANDS, OLDEST_BAND).alias("age_band"),
    )


def tokenize_orders(orders: DataFrame, secret: str | None = None) -> DataFrame:
    """Orders with the customer id replaced by the same token that `mask_customers` makes."""
    return orders.select(
        "order_id", "product_id", "quantity", "unit_price", "total_amount", "order_date", "status",
        "payment_method", token(F.col("customer_id"), secret).alias("customer_token"),
    )


def mask_payments(payments: DataFrame, cuts: Sequence[int] = (1000, 5000, 15000)) -> DataFrame:
    """No security code, last four card digits, spending bucket."""
    steps = list(zip(cuts, SPENDING_LABELS, strict=True))
    return payments.drop("cvv").select(
        "payment_id", "order_id", mask_card(F.col("card_number")).alias("card_number"),
        "amount", "payment_date", "payment_status",
        tier(F.col("amount"), steps, HIGHEST_SPENDING).alias("spending_bucket"),
    )

"""Clean-up of dirty customer, product, order and item tables.

Everything arrives as text or loosely typed; a value that does not parse becomes NULL instead of
failing the job. Duplicate keys keep a fixed survivor (see `dedupe_by_key`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.dates import parse_mixed_date
from shelfmark.functions.money import MONEY, average, discounted, total
from shelfmark.functions.numbers import DOES_NOT_FIT, NOT_A_NUMBER, exact_number, number_fault
from shelfmark.functions.text import (
    MISSING_CONTACT, blank_to_null, email_flag, email_strict, format_phone, name_case,
)
from shelfmark.operators.dedupe import dedupe_by_key
from shelfmark.operators.joins import referenced

# Fixed values.
CATALOGUE_DEFAULTS = {
    "what_customers_said": "No comments",
    "seller_name": "Unknown",
    "seller_information": "Unknown",
    "videos": "No Video",
    "variations": "No Variants",
}

# Digits before and after the point that an item's numbers may have.
ITEM_NUMBERS = {"quantity": (8, 6), "unit_price": (8, 6), "discount_percent": (3, 6)}


def fill_defaults(df: DataFrame, defaults: Mapping[str, str | int | float],
                  flags: Mapping[str, str] | None = None) -> DataFrame:
    """Fill NULLs per column. `flags` maps a new 0/1 column to the column whose presence it records;
    presence is taken before the fill."""
    for flag, column in (flags or {}).items():
        df = df.withColumn(flag, F.col(column).isNotNull().cast("int"))
    return df.na.fill(dict(defaults))


def drop_incomplete(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL in any required column."""
    return df.na.drop(how="any", subset=list(required))


def flag_email_valid(customers: DataFrame) -> DataFrame:
    """Title-case names and flag e-mail validity; every customer stays."""
    return dedupe_by_key(customers, ["customer_id"]).withColumns({
        "customer_name": name_case(F.col("customer_name"), after="non_letter"),
        "email_valid": email_flag(F.col("email")),
    })


def clean_customers(customers: DataFrame) -> DataFrame:
    """Typed dates, one row per customer, word-cased names and places, formatted phone; customers
    without a usable e-mail are dropped."""
    one_each = dedupe_by_key(customers, ["customer_id"])
    cased = {c: name_case(F.col(c)) for c in ("customer_name", "city", "state")}
    return one_each.filter(email_strict(F.col("email"))).withColumns({
        **cased,
        "dob": F.try_to_date("dob", "yyyy-MM-dd"),
        "signup_date": F.try_to_date("signup_date", "yyyy-MM-dd"),
        "phone": F.coalesce(format_phone(F.col("phone")), F.lit(MISSING_CONTACT)),
        "address": F.coalesce(F.trim("address"), F.lit(MISSING_CONTACT)),
    })


def clean_products(products: DataFrame, after: str = "non_letter") -> DataFrame:
    """One row per product, trimmed and cased names, numeric and positive cost."""
    cost = F.col("cost_price").try_cast(MONEY)
    return dedupe_by_key(products, ["product_id"]).withColumns({
        "product_name": name_case(F.col("product_name"), after),
        "cost_price": cost,
    }).filter(F.col("cost_price") > 0)


def clean_orders(orders: DataFrame, as_of: Column) -> DataFrame:
    """One row per order, guest flag from the null spellings of the customer, one date format;
    orders with an unreadable or future date are dropped."""
    customer = blank_to_null(F.col("customer_id"))
    return dedupe_by_key(orders, ["order_id"]).withColumns({
        "customer_id": customer,
        "order_date": parse_mixed_date(F.col("order_date")),
        "is_guest": customer.isNull().cast("int"),
    }).filter(F.col("order_date") <= as_of)


def judged_items(items: DataFrame) -> DataFrame:
    """Items with their numbers typed and `fault`, the first rule an item breaks (NULL for a good one).

    The rules judge the numbers as they are spelled, down to the last digit. A number that the column types cannot hold
    exactly is NULL with the fault `does_not_fit`, text that is no number NULL with `not_a_number`.
    """
    # In two steps, so that each number is read once.
    text = {c: F.col(c).cast("string") for c in ITEM_NUMBERS}
    read = items.withColumns({f"_{c}": exact_number(text[c], *digits) for c, digits in ITEM_NUMBERS.items()})
    quantity, price, discount = (F.col(f"_{c}") for c in ITEM_NUMBERS)
    spelled = [number_fault(text[c], F.col(f"_{c}")) for c in ITEM_NUMBERS]
    any_of = lambda fault: F.array_contains(F.array(*spelled), fault)
    fault = (
        F.when(quantity.isNull() | price.isNull() | discount.isNull(),
               F.when(any_of(NOT_A_NUMBER), NOT_A_NUMBER).otherwise(DOES_NOT_FIT))
        .when(quantity == 0, "zero_quantity")
        .when(price <= 0, "non_positive_price")
        .when(~discount.between(0, 100), "discount_out_of_range")
    )
    return read.withColumn("fault", fault).withColumns({c: F.col(f"_{c}") for c in ITEM_NUMBERS}).drop(*(f"_{c}" for c in ITEM_NUMBERS))


def typed_items(items: DataFrame) -> DataFrame:
    """Item text as numbers; what is none, or does not fit exactly, becomes NULL."""
    return judged_items(items).drop("fault")


def clean_order_items(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """One row per item, numeric, in range, and pointing at a clean order and product. Numbers keep all their digits."""
    sound = judged_items(dedupe_by_key(items, ["item_id"])).filter(F.col("fault").isNull())
    known = referenced(referenced(sound, orders, "order_id"), products, "product_id")
    return known.select("item_id", "order_id", "product_id", "quantity", "unit_price", "discount_percent")


def quarantine_order_items(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """The rows `clean_order_items` leaves out, as they came in, with `reject_reason` and the number
    of input rows each stands for (`copies`). Accepted rows plus copies equal the input."""
    columns = ["item_id", "order_id", "product_id", "quantity", "unit_price", "discount_percent"]
    rest = columns[1:]
    # Copies merge first, so an id with very many copies reaches the join below as a few rows.
    distinct_rows = items.groupBy(*columns).agg(F.count("*").alias("_copies"))
    # With the copies in the minimum (they cannot change it) both sides of the join read one merged shuffle.
    survivor = distinct_rows.groupBy("item_id").agg(F.min(F.struct(*rest, "_copies")).alias("_first"))
    survives = F.struct(*rest, "_copies").eqNullSafe(F.col("_first")).alias("_survives")
    tagged = distinct_rows.join(survivor, "item_id").select(*columns, "_copies", survives, F.struct(*columns).alias("_raw"))
    flagged = (
        judged_items(tagged)
        .join(orders.select("order_id", F.lit(True).alias("_order")), "order_id", "left")
        .join(products.select("product_id", F.lit(True).alias("_product")), "product_id", "left")
    )
    reason = F.when(F.col("_survives"), F.coalesce(
        F.col("fault"),
        F.when(F.col("_order").isNull(), F.lit("unknown_order")),
        F.when(F.col("_product").isNull(), F.lit("unknown_product")),
    ))
    spare = F.col("_copies") - F.col("_survives").cast("int")
    verdicts = F.array(
        F.struct(reason.alias("reason"), F.lit(1).cast("bigint").alias("copies")),
        F.struct(F.when(spare > 0, F.lit("duplicate")).alias("reason"), spare.alias("copies")),
    )
    rejected = flagged.select("_raw", F.explode(verdicts).alias("_verdict")).filter(F.col("_verdict.reason").isNotNull())
    return rejected.select("_raw.*", F.col("_verdict.reason").alias("reject_reason"), F.col("_verdict.copies").alias("copies"))


# Lakehouse tables without rules of their own ----------------------------------------------------

def clean_lake_products(products: DataFrame) -> DataFrame:
    """One row per product with cased name and category."""
    return dedupe_by_key(products, ["product_id"]).withColumns({
        c: name_case(F.col(c)) for c in ("product_name", "category")})


def clean_lake_orders(orders: DataFrame) -> DataFrame:
    """One row per order, complete keys, typed date."""
    complete = drop_incomplete(dedupe_by_key(orders, ["order_id"]), ["order_id", "customer_id", "product_id"])
    return complete.withColumn("order_date", F.try_to_date(F.col("order_date").cast("string"), "yyyy-MM-dd"))


def clean_payments(payments: DataFrame) -> DataFrame:
    """One row per payment, typed date."""
    return dedupe_by_key(payments, ["payment_id"]).withColumn(
        "payment_date", F.try_to_date(F.col("payment_date").cast("string"), "yyyy-MM-dd"))


# Composite pipelines ---------------------------------------------------------------------------

def catalogue_clean(catalogue: DataFrame) -> DataFrame:
    """One row per product with defaults, a variations flag and the price after discount."""
    filled = fill_defaults(
        dedupe_by_key(catalogue, ["product_id"]), {**CATALOGUE_DEFAULTS, "discount": 0},
        {"has_variations": "variations"},
    )
    price = discounted(F.col("initial_price"), F.col("discount"))
    return filled.withColumn("calculated_final_price", F.round(price, 2))


def high_rated(catalogue: DataFrame, rating: float = 4, votes: int = 70) -> DataFrame:
    """Products rated above `rating` by more than `votes` customers."""
    return (
        catalogue.filter((F.col("rating") > rating) & (F.col("ratings_count") > votes))
        .select("product_id", "title", "category", "rating", "initial_price", "discount")
    )


def _priced_transactions(transactions: DataFrame) -> DataFrame:
    one_each = dedupe_by_key(transactions, ["user_id", "transaction_date"])
    return one_each.na.fill({"price": "0", "status": "Unknown"}).withColumn("price", F.col("price").cast(MONEY))


def price_summary(transactions: DataFrame) -> DataFrame:
    """One row over all transactions: count, minimum, maximum, average and total price."""
    price = F.col("price").cast(MONEY)
    return transactions.agg(
        F.count("*").alias("total_records"), F.min(price).alias("minimum_price"),
        F.max(price).alias("maximum_price"), average(price).alias("average_price"),
        total(price).alias("total_price"),
    )


def store_sales(transactions: DataFrame) -> DataFrame:
    """Transactions, revenue and average price per store."""
    price = F.col("price").cast(MONEY)
    return transactions.groupBy("store_id").agg(
        F.count("*").alias("transactions"), total(price).alias("revenue"), average(price).alias("average_price"),
    )


def store_sales_pipeline(transactions: DataFrame, region: str) -> DataFrame:
    """Dedupe, fill, keep one region, cast and group per store."""
    price = F.col("price")
    return _priced_transactions(transactions).filter(F.col("region") == region).groupBy("store_id").agg(
        F.count("*").alias("transactions"), total(price).alias("revenue"), average(price).alias("average_price"),
        F.min(price).alias("minimum_price"), F.max(price).alias("maximum_price"),
    )


def net_sales(sales: DataFrame) -> DataFrame:
    """Add `net_sales`, sales after the discount percent."""
    return sales.withColumn("net_sales", F.round(discounted(F.col("sales"), F.col("discount")), 2))


def net_sales_enrich(sales: DataFrame, company: str) -> DataFrame:
    """Rename the customer column, add net sales, a discount label and a constant, drop a column."""
    label = F.when(F.col("discount") >= 10, "High").when(F.col("discount").isNotNull(), "Low")
    return (
        net_sales(sales.withColumnRenamed("customer_name", "customer"))
        .withColumn("discount_type", label)
        .withColumn("company", F.lit(company))
        .drop("returned")
    )


def region_category_pipeline(sales: DataFrame, minimum_quantity: int = 5) -> DataFrame:
    """Fill, keep larger sales, derive net sales and total them per region and category."""
    filled = sales.na.fill({"discount": 0, "sales": 0}).filter(F.col("quantity") >= minimum_quantity)
    return net_sales(filled).groupBy("region", "category").agg(total(F.col("net_sales")).alias("total_sales"))


def category_stats(sales: DataFrame) -> DataFrame:
    """Orders and average, highest and lowest sale per category, highest first."""
    amount = F.col("sales")
    return sales.groupBy("category").agg(
        F.count("*").alias("orders"), average(amount).alias("average_sales"),
        F.max(amount).alias("highest_sale"), F.min(amount).alias("lowest_sale"),
    ).orderBy(F.col("highest_sale").desc(), "category")

"""Customer analytics.

Every job first reduces lines or orders to customer grain (or customer-day, customer-month), so a
customer with a large share of all orders never meets a window or a join as raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from shelfmark.functions.dates import month_key, month_number
from shelfmark.functions.money import money_ratio, ratio, total
from shelfmark.functions.text import tier
from shelfmark.operators.dedupe import first_row, last_row
from shelfmark.operators.ordering import Key, ntile, number_rows, rank_of_value, ranked_top, running_sums
from shelfmark.session import durable

# Fixed values.
QUARTILE_NAMES = ("Platinum", "Gold", "Silver", "Bronze")
CUSTOMER_SHARES = 8  # a customer's lines are ranked in so many shares before they meet


# Order lines of the split sales table ----------------------------------------------------------

def orders_above_average(lines: DataFrame, k: int | None = None) -> DataFrame:
    """Order lines above the mean sale; with `k` the k highest, by row_id where equal."""
    mean = lines.agg(F.sum("sales") / F.count("sales")).scalar()
    above = lines.filter(F.col("sales") > mean).select("row_id", "order_id", "customer_id", "product_id", "sales")
    return above if k is None else above.orderBy(F.col("sales").desc(), "row_id").limit(k)


def top_order_per_customer(lines: DataFrame, k: int | None = None) -> DataFrame:
    """The highest line of every customer, ties kept; with `k` the k highest of them.

    A window keeps a customer's ties next to its maximum; a customer with very many lines reaches it as the few of each share that
    can still be highest, since the limit on the rank is applied before the shuffle. The shares are dealt by a shuffle of their own,
    so that no task sorts lines for the window and for the joins before it at once.
    """
    place = F.rank().over(W.partitionBy("customer_id").orderBy(F.col("sales").desc_nulls_last()))
    share = F.pmod(F.xxhash64("row_id"), F.lit(CUSTOMER_SHARES))
    dealt = lines.select("customer_id", "row_id", "order_id", "sales").repartition("customer_id", share)
    found = dealt.withColumn("_place", place).filter(
        (F.col("_place") == 1) & F.col("customer_id").isNotNull() & F.col("sales").isNotNull()).drop("_place")
    return found if k is None else found.orderBy(F.col("sales").desc(), "row_id").limit(k)


def _customer_sums(lines: DataFrame, customers: DataFrame, *attributes: str) -> DataFrame:
    """Sales and profit of every customer, summed before names are joined."""
    sums = lines.groupBy("customer_id").agg(
        F.sum("sales").alias("total_sales"), F.sum("profit").alias("total_profit"))
    return sums.join(customers.select("customer_id", *attributes), "customer_id")


def _customer_orders(lines: DataFrame, customers: DataFrame) -> DataFrame:
    sums = lines.groupBy("customer_id").agg(
        total(F.col("sales")).alias("total_sales"), total(F.col("profit")).alias("total_profit"),
        F.count_distinct("order_id").alias("order_count"))
    return customers.select("customer_id", "customer_name").join(sums, "customer_id")


def customer_totals(lines: DataFrame, customers: DataFrame, k: int | None = None) -> DataFrame:
    """Sales, profit and distinct orders per customer; with `k` the k customers of highest sales."""
    totals = _customer_orders(lines, customers)
    return totals if k is None else totals.orderBy(F.col("total_sales").desc(), "customer_id").limit(k)


def single_order_customers(lines: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers with exactly one order."""
    return _customer_orders(lines, customers).filter(F.col("order_count") == 1).select(
        "customer_id", "customer_name", "order_count", "total_sales")


def customers_above_average(lines: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers whose sales exceed the mean customer's."""
    sums = durable(_customer_sums(lines, customers, "customer_name"))  # read twice below
    mean = sums.agg(F.sum("total_sales") / F.count("total_sales")).scalar()
    return sums.filter(F.col("total_sales") > mean).select(
        "customer_id", "customer_name", F.round("total_sales", 2).alias("total_sales"))


def customer_row_number_rank(lines: DataFrame, customers: DataFrame) -> DataFrame:
    """Row number and rank of every customer by sales."""
    sums = _customer_sums(lines, customers, "customer_name")
    numbered = number_rows(sums, [F.col("total_sales").desc(), F.col("customer_id").asc()])
    return rank_of_value(numbered, ["total_sales"], "rank_no").select(
        "customer_id", "customer_name", F.round("total_sales", 2).alias("total_sales"),
        F.round("total_profit", 2).alias("total_profit"), F.col("row_number").alias("row_no"), "rank_no")


def top_customers_ranked(lines: DataFrame, customers: DataFrame, k: int = 10) -> DataFrame:
    """Customers of rank 1 to k by sales, ties kept."""
    sums = _customer_sums(lines, customers, "customer_name", "region")
    return ranked_top(sums, "total_sales", k, "rank_no").select(
        "customer_id", "customer_name", "region", F.round("total_sales", 2).alias("total_sales"), "rank_no")


def bottom_customers_ranked(lines: DataFrame, customers: DataFrame, k: int = 10) -> DataFrame:
    """Customers of the k lowest ranks by sales, ties kept."""
    sums = _customer_sums(lines, customers, "customer_name")
    return ranked_top(sums, "total_sales", k, "low_rank", ascending=True).select(
        "customer_id", "customer_name", F.round("total_sales", 2).alias("total_sales"), "low_rank")


def customer_overall_rank(lines: DataFrame, customers: DataFrame, k: int = 20) -> DataFrame:
    """The first k customers by sales with their rank. All customers ahead of one in the cut are in
    the cut too, so ranking the k rows is enough."""
    order = F.col("total_sales").desc()
    best = _customer_sums(lines, customers, "customer_name", "segment", "region").orderBy(order, "customer_id").limit(k)
    return best.select(
        "customer_id", "customer_name", "segment", "region", F.round("total_sales", 2).alias("total_sales"),
        F.round("total_profit", 2).alias("total_profit"), F.rank().over(W.orderBy(order)).alias("overall_rank"))


# Orders ----------------------------------------------------------------------------------------

def customers_never_delivered(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers with orders of which none was delivered."""
    per_customer = orders.groupBy("customer_id").agg(
        F.count("order_id").alias("order_count"), F.count_if(F.col("status") == "DELIVERED").alias("_delivered"))
    waiting = per_customer.filter(F.col("_delivered") == 0)
    return customers.select("customer_id", "customer_name").join(waiting, "customer_id").select(
        "customer_id", "customer_name", "order_count").orderBy(F.col("order_count").desc(), "customer_id")


def customer_risk(orders: DataFrame, gap_days: int = 30) -> DataFrame:
    """Days since the customer's previous order, and `At Risk` where the mean gap exceeds `gap_days`.

    The window runs over customer-days, not orders: within a day only the first order has a gap
    other than 0, and the mean gap follows from the first day, the last day and the order count.
    """
    known = orders.filter(F.col("customer_id").isNotNull()).select("customer_id", "order_id", "order_date")
    days = known.groupBy("customer_id", "order_date").agg(
        F.min("order_id").alias("_first_of_day"), F.count("*").alias("_orders"))
    customer = W.partitionBy("customer_id")
    gaps = F.sum("_orders").over(customer) - 1
    span = F.datediff(F.max("order_date").over(customer), F.min("order_date").over(customer))
    status = F.when(gaps == 0, "Insufficient Data").when(span > gaps * gap_days, "At Risk").otherwise("Active")
    rated = days.select(
        "customer_id", "order_date", "_first_of_day", status.alias("risk_status"),
        F.datediff("order_date", F.lag("order_date").over(customer.orderBy("order_date"))).alias("_gap"))
    since = F.when(F.col("order_id") == F.col("_first_of_day"), F.col("_gap")).otherwise(0)
    return known.join(rated, ["customer_id", "order_date"]).select(
        "customer_id", "order_id", "order_date", since.alias("days_since_previous"), "risk_status")


def cohort_retention(customers: DataFrame, orders: DataFrame, months: int = 4) -> DataFrame:
    """Percent of each registration month that ordered 0, 1, ... months after it."""
    users = customers.select(
        "customer_id", month_key(F.col("registration_date")).alias("reg_month"),
        month_number(F.col("registration_date")).alias("_registered"))
    active = (
        orders.filter((F.col("status") != "CANCELLED") & F.col("customer_id").isNotNull())
        .select("customer_id", month_number(F.col("order_date")).alias("_ordered")).distinct()
    )
    distance = (F.col("_ordered") - F.col("_registered")).alias("_month")
    counts = (
        users.join(active, "customer_id").select("reg_month", distance)
        .filter(F.col("_month").between(0, months - 1))
        .groupBy("reg_month").agg(*(F.count_if(F.col("_month") == m).alias(f"_active_{m}") for m in range(months)))
    )
    sizes = users.groupBy("reg_month").agg(F.count("*").alias("total_users"))
    def percent(m: int) -> Column:
        return ratio(F.coalesce(F.col(f"_active_{m}"), F.lit(0)) * 100, F.col("total_users"), 2)
    return sizes.join(counts, "reg_month", "left").select(
        "reg_month", "total_users", *(percent(m).alias(f"month_{m}_pct") for m in range(months)))


# Revenue lines ---------------------------------------------------------------------------------

def _known(rev: DataFrame) -> DataFrame:
    return rev.filter(F.col("customer_id").isNotNull())


def monthly_buckets(rev: DataFrame, low: int = 5000, high: int = 10000) -> DataFrame:
    """Customers per month in each revenue bucket, `High` first."""
    monthly = _known(rev).groupBy("order_month", "customer_id").agg(F.sum("net_revenue").alias("_net"))
    net = F.col("_net")
    bucket = F.when(net > high, "High").when(net >= low, "Medium").otherwise("Low")
    place = F.when(F.col("revenue_bucket") == "High", 1).when(F.col("revenue_bucket") == "Medium", 2).otherwise(3)
    return monthly.groupBy("order_month", bucket.alias("revenue_bucket")).agg(
        F.count("*").alias("customer_count")).orderBy("order_month", place)


def _value_per_customer(rev: DataFrame) -> DataFrame:
    return _known(rev).groupBy("customer_id").agg(F.sum("net_revenue").alias("revenue"))


def _best_first() -> list[Column]:
    return [F.col("revenue").desc(), F.col("customer_id").asc()]


def ltv_quartiles(rev: DataFrame) -> DataFrame:
    """Lifetime value of every customer and its quartile by name."""
    numbered = number_rows(_value_per_customer(rev), _best_first())
    quartile = ntile(F.col("row_number"), F.col("row_count"), len(QUARTILE_NAMES))
    segment = tier(quartile, [(i + 2, n) for i, n in enumerate(QUARTILE_NAMES[:-1])], QUARTILE_NAMES[-1])
    return numbered.select("customer_id", F.round("revenue", 2).alias("total_value"), segment.alias("ltv_segment"))


def pareto(rev: DataFrame) -> DataFrame:
    """Customers with positive revenue, best first: their percentile and the cumulative share."""
    positive = _value_per_customer(rev).filter(F.col("revenue") > 0)
    numbered = running_sums(positive, [Key("revenue", descending=True), Key("customer_id")], ["revenue"])
    return numbered.select(
        "customer_id", F.round("revenue", 2).alias("revenue"),
        ratio(F.col("row_number") * 100, F.col("row_count"), 2).alias("customer_percentile"),
        money_ratio(F.col("running_revenue") * 100, F.col("total_revenue"), 2).alias("cumulative_revenue_pct"))


def category_shift(rev: DataFrame, products: DataFrame) -> DataFrame:
    """Category of the first and of the last purchase of every customer.

    The first and last line per customer are aggregates; categories join afterwards, twice one row
    per customer.
    """
    order = [F.col("order_date"), F.col("item_id")]
    ends = _known(rev).filter(F.col("quantity") > 0).groupBy("customer_id").agg(
        first_row(["product_id"], order).alias("_first"), last_row(["product_id"], order).alias("_last"))
    def category(which: str) -> DataFrame:
        return products.select(F.col("product_id").alias(f"_{which}_id"), F.col("category").alias(f"{which}_category"))
    found = ends.select(
        "customer_id", F.col("_first.product_id").alias("_first_id"), F.col("_last.product_id").alias("_last_id"),
    ).join(category("first"), "_first_id").join(category("last"), "_last_id")
    shift = F.when(F.col("first_category") != F.col("last_category"), "Yes").otherwise("No")
    return found.select("customer_id", "first_category", "last_category", shift.alias("category_shift"))

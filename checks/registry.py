"""Every query by name: which job runs over which derived tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType

from checks.views import Views
from shelfmark import schemas
from shelfmark.operators import change, dedupe, joins, profile, quality
from shelfmark.plans import basket, clean, customers, facts, layers, marts, normalise, period, privacy, sales, shop
from shelfmark.session import fresh_path, tune
from shelfmark.sources import files, tables

Query = Callable[[SparkSession, str], DataFrame]

PERIOD = (date(1998, 1, 1), date(1998, 6, 30))
MASK_DAY = "2004-06-15"


def plain(df: DataFrame) -> DataFrame:
    """Money as DOUBLE and dates as text, the forms both engines print alike."""
    def shown(field):
        if isinstance(field.dataType, DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, DateType):
            return F.col(field.name).cast("string").alias(field.name)
        return F.col(field.name)
    return df.select(*(shown(f) for f in df.schema.fields))


def _rev(v: Views) -> DataFrame:
    return facts.revenue_lines(facts.order_lines(v.items(), v.orders()))


def _lines(v: Views) -> DataFrame:
    return normalise.split_orders(v.flat())


def _split(v: Views) -> tuple[DataFrame, DataFrame]:
    return _lines(v), normalise.split_customers(v.flat())


def _clean_orders(v: Views) -> DataFrame:
    return clean.clean_orders(v.orders_dirty(), v.as_of())


def _silver_orders(v: Views) -> DataFrame:
    return privacy.tokenize_orders(v.lake_orders())


def _silver_customers(v: Views) -> DataFrame:
    return privacy.mask_customers(v.customers(), F.lit(MASK_DAY).cast("date"))


# Sources and sinks -------------------------------------------------------------------------------

def _csv_round_trip(v: Views) -> DataFrame:
    rows = v.customers().select("customer_id", "customer_name", "email", "phone", "signup_date")
    path = fresh_path(v.spark, "csv")
    files.write_csv(rows, path)
    return files.read_csv(v.spark, path, rows.schema)


def _parquet_round_trip(v: Views) -> DataFrame:
    rows = facts.order_lines(v.items(), v.orders()).select(
        "item_id", "order_id", "quantity", "net_revenue", "order_day", "order_month")
    path = fresh_path(v.spark, "parquet")
    # One file per month: rows of a month meet in one task before the write, and AQE splits a
    # month that is too large for one.
    files.write_parquet(rows.hint("rebalance", "order_month"), path, ["order_month"])
    return files.read_parquet(v.spark, path)


def _table_name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex}"


def _table_round_trip(v: Views) -> DataFrame:
    name = _table_name("orders")
    tables.save_table(v.orders(), name, path=fresh_path(v.spark, name))
    return tables.read_table(v.spark, name)


def _append_new_rows(v: Views) -> DataFrame:
    """The increment arrives twice; the second load adds nothing."""
    name = _table_name("ledger")
    tables.save_table(v.upsert_target(), name, path=fresh_path(v.spark, name))
    for _ in range(2):
        tables.append_new_rows(v.upsert_source(), name, "order_id")
    return tables.read_table(v.spark, name)


def _append_checked(v: Views) -> DataFrame:
    """A batch is appended after its keys were found among the orders; rows without a key and all but one row of a key stay out."""
    name = _table_name("batch")
    tables.save_table(v.upsert_target(), name, path=fresh_path(v.spark, name))
    batch = v.batch().filter("customer_id IS NULL OR customer_id > 0")
    layers.append_checked(batch, name, "order_id", [quality.Reference("order_id", v.orders(), "order_id")])
    return tables.read_table(v.spark, name)


def _append_rejects(v: Views) -> DataFrame:
    """What an append gives back of the careless batch."""
    name = _table_name("batch")
    tables.save_table(v.upsert_target(), name, path=fresh_path(v.spark, name))
    return tables.append_new_rows(v.batch(), name, "order_id", [quality.Reference("customer_id", v.customers(), "customer_id")])


def _replaced_table(v: Views) -> DataFrame:
    """A table saved, dropped, made anew, and replaced by a part of its own rows."""
    name = _table_name("orders")
    tables.save_table(v.orders(), name, path=fresh_path(v.spark, name))
    tables.drop_table(v.spark, name)
    folder = fresh_path(v.spark, name)
    tables.replace_table(v.orders(), name, folder)
    tables.replace_table(tables.read_table(v.spark, name).filter("status <> 'CANCELLED'"), name, folder)
    return tables.read_table(v.spark, name)


def _master(v: Views) -> tuple[str, str]:
    """A table that holds some orders twice, and the folder of its versions."""
    name, target = _table_name("master"), v.upsert_target()
    folder = fresh_path(v.spark, name)
    tables.replace_table(target.unionByName(target.filter("order_id % 40 = 3")), name, folder)
    return name, folder


def _remove_duplicates(v: Views) -> DataFrame:
    name, folder = _master(v)
    layers.remove_duplicates(v.spark, name, "order_id", folder)
    return tables.read_table(v.spark, name)


def _incremental_load(v: Views, report: bool = False) -> DataFrame:
    """The table after duplicates were removed and the increment was loaded, or the checks of that load."""
    name, folder = _master(v)
    layers.remove_duplicates(v.spark, name, "order_id", folder)
    checks = layers.incremental_load(v.upsert_source(), name, "order_id", folder, "order_code", "INCR-2001")
    return checks if report else tables.read_table(v.spark, name)


def _scan_orders(v: Views) -> DataFrame:
    path = fresh_path(v.spark, "lines")
    v.lake_order_lines().write.text(path)
    return files.scan_checked(v.spark, path, schemas.LAKE["orders"], header=False)


def _lake(v: Views) -> layers.Layer:
    """The silver layer from dirty tables."""
    raw = {"customers": v.customers_dirty(), "products": v.products_dirty(), "orders": v.lake_orders_dirty(), "payments": v.payments_dirty()}
    return layers.silver_lake(layers.clean_lake(raw), F.lit(MASK_DAY).cast("date"))


def _gold(mart: str) -> Callable[[Views], DataFrame]:
    return lambda v: layers.gold_lake(_lake(v))[mart]


def _upsert_partitioned(v: Views) -> DataFrame:
    """Orders by month; the Octobers of all years have none, so the increment meets a NULL partition."""
    month = F.when(F.month("order_date") != 10, F.date_format("order_date", "yyyy-MM"))
    path = fresh_path(v.spark, "months")
    files.write_parquet(v.upsert_target().withColumn("order_month", month).hint("rebalance", "order_month"), path, ["order_month"])
    change.upsert_partitions(path, v.upsert_source().withColumn("order_month", month), "order_id", "order_month")
    return files.read_parquet(v.spark, path)


def _bronze_copy(v: Views) -> DataFrame:
    raw, bronze = fresh_path(v.spark, "raw"), fresh_path(v.spark, "bronze")
    landed = {
        "customers": v.customers().select("customer_id", "customer_name", "phone", "signup_date"),
        "products": v.products().select("product_id", "product_name", "category", "cost_price"),
    }
    for name, df in landed.items():
        files.write_csv(df, f"{raw}/{name}")
    files.copy_layer(v.spark, landed, raw, bronze, {n: schemas.all_text(d.schema) for n, d in landed.items()})
    copies = [files.read_parquet(v.spark, f"{bronze}/{n}") for n in landed]
    return copies[0].select(F.lit("customers").alias("dataset"), F.col("customer_id").alias("id"),
                            F.col("customer_name").alias("name"), F.col("phone").alias("detail")).unionByName(
        copies[1].select(F.lit("products").alias("dataset"), F.col("product_id").alias("id"),
                         F.col("product_name").alias("name"), F.col("cost_price").alias("detail")))


# Quality -----------------------------------------------------------------------------------------

def _lake_products(v: Views) -> DataFrame:
    """Products with text prices, as they arrive, read as money."""
    return v.products_dirty().select("product_id", F.col("cost_price").try_cast("decimal(10,2)").alias("cost_price"),
                                     F.col("cost_price").try_cast("decimal(10,2)").alias("selling_price"))


def _rule_violations(v: Views) -> DataFrame:
    as_of = F.lit("2000-12-31").cast("date")
    parts = [
        quality.rule_violations(_lake_products(v), quality.price_rules()),
        quality.rule_violations(clean.typed_items(v.items_dirty()), quality.quantity_rules()),
        quality.rule_violations(v.customers(), quality.customer_rules(as_of)),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _referential_violations(v: Views) -> DataFrame:
    ref = quality.Reference
    return quality.referential_violations({
        "orders_without_customer": (v.orders(), ref("customer_id", v.customers(), "customer_id")),
        "items_without_product": (v.items_dirty(), ref("product_id", v.products(), "product_id")),
        "items_without_order": (v.items_dirty(), ref("order_id", v.orders(), "order_id")),
    })


def _constraint_report(v: Views) -> DataFrame:
    ref, rules = quality.Reference, quality.Constraints
    return quality.constraint_report({
        "customers": (v.customers(), rules(unique=["customer_id", "email"], not_null=["customer_name", "email"])),
        "products": (v.products_dirty().withColumn("cost_price", F.col("cost_price").try_cast("decimal(12,2)")), rules(
            unique=["product_id"], not_null=["cost_price"], checks={"positive_cost": F.col("cost_price") > 0})),
        "orders": (v.orders_dirty(), rules(
            unique=["order_id"],
            checks={"known_status": F.col("status").isin("DELIVERED", "SHIPPED", "PLACED", "CANCELLED")})),
        "order_items": (clean.typed_items(v.items_dirty()), rules(
            unique=["item_id"], not_null=["quantity"],
            checks={"moved_units": F.col("quantity") != 0, "discount_range": F.col("discount_percent").between(0, 100)},
            references=[ref("order_id", v.orders(), "order_id"), ref("product_id", v.products(), "product_id")])),
    })


def _clean_store_report(v: Views) -> DataFrame:
    """What the declared store tables promise, held against the cleaned ones."""
    store = layers.clean_store({"customers": v.customers_dirty().withColumnRenamed("region", "region_code"), "products": v.products_dirty(),
                                "orders": v.orders_dirty(), "order_items": v.items_dirty()}, v.as_of())
    ref, kinds = quality.Reference, schemas.STORE_CLEAN
    orders, products = store["orders"], store["products"]
    statuses = ("DELIVERED", "SHIPPED", "PLACED", "CANCELLED", "RETURNED")
    return quality.constraint_report({
        "customers": (store["customers"], quality.declared(
            kinds["customers"], ["customer_id"], {"email_flag": F.col("email_valid").isin(0, 1)})),
        "products": (products, quality.declared(kinds["products"], ["product_id"], {"positive_cost": F.col("cost_price") > 0})),
        "orders": (orders, quality.declared(
            kinds["orders"], ["order_id"], {"known_status": F.col("status").isin(*statuses), "guest_flag": F.col("is_guest").isin(0, 1)},
            [ref("customer_id", v.customers().select(F.col("customer_id").cast("string").alias("customer_id")), "customer_id")])),
        "order_items": (store["order_items"], quality.declared(
            kinds["order_items"], ["item_id"],
            {"moved_units": F.col("quantity") != 0, "positive_price": F.col("unit_price") > 0,
             "discount_range": F.col("discount_percent").between(0, 100)},
            [ref("order_id", orders, "order_id"), ref("product_id", products, "product_id")])),
    })


def _single_order_customers(v: Views) -> DataFrame:
    """A customer and year count as one customer here: over all years nearly everyone has several orders."""
    flat = v.flat_by_year()
    return customers.single_order_customers(normalise.split_orders(flat), normalise.split_customers(flat))


def _upsert(v: Views) -> DataFrame:
    return change.upsert(v.upsert_target(), v.upsert_source(), "order_id")


QUERIES: dict[str, Callable[[Views], DataFrame]] = {
    # 2.1 sources and sinks
    "csv_round_trip": _csv_round_trip,
    "parquet_round_trip": _parquet_round_trip,
    "table_round_trip": _table_round_trip,
    "append_new_rows": _append_new_rows,
    "bronze_copy": _bronze_copy,
    "append_rejects": _append_rejects,
    "replaced_table": _replaced_table,
    "checked_scan": lambda v: files.good_rows(_scan_orders(v)),
    "checked_scan_rejects": lambda v: files.rejected_lines(_scan_orders(v)).withColumn(
        files.REASONS, F.array_join(files.REASONS, ",")),
    # 2.2 projections and filters
    "project_columns": lambda v: v.customers().select("customer_id", "customer_name", "city"),
    "net_sales_enrich": lambda v: clean.net_sales_enrich(v.sales(), "Shelfmark"),
    "split_orders": _lines,
    "rename_positional": lambda v: normalise.rename_positional(v.flat(), [f"c{i:02d}" for i in range(1, 23)]),
    "filter_status": lambda v: shop.by_status(v.orders(), "DELIVERED"),
    "filter_category_price": lambda v: shop.by_category_above(v.products(), "PROMO", 2000),
    "filter_between_segment": lambda v: shop.by_age_and_plan(v.transactions(), 18, 30, "Premium"),
    "filter_date_range": lambda v: shop.placed_between(v.orders(), date(1998, 8, 10), date(1998, 8, 25), "CANCELLED"),
    "filter_year_range": lambda v: shop.placed_in_year(v.orders(), 1997),
    "filter_high_discount": lambda v: sales.high_discount_lines(v.flat(), 0.08),
    "filter_prefix": lambda v: shop.with_prefix(v.coded_orders(), "order_code", "INCR-2001"),
    "price_tiers": lambda v: shop.price_tiers(v.products()),
    "line_facts": lambda v: facts.line_facts(v.items(), v.orders(), v.products()),
    "revenue_lines": lambda v: facts.revenue_lines(facts.line_facts(v.items(), v.orders(), v.products())),
    # 2.3 joins and subqueries
    "join_order_customer": lambda v: shop.orders_with_customer(v.orders(), v.customers()),
    "join_left_customers": lambda v: shop.customers_with_orders(v.customers(), v.orders()),
    "join_right_orders": lambda v: shop.orders_with_any_customer(v.customers(), v.orders()),
    "join_full": lambda v: shop.customers_and_orders(v.customers(), v.orders()),
    "join_three_way": lambda v: shop.item_details(v.orders(), v.items(), v.products()),
    "orphan_orders": lambda v: joins.orphans(v.orders(), v.customers(), "customer_id"),
    "basket_pairs": lambda v: basket.basket_pairs(_rev(v)),
    "top_order_per_customer": lambda v: customers.top_order_per_customer(_lines(v)),
    "top_order_per_customer_10": lambda v: customers.top_order_per_customer(_lines(v), 10),
    "orders_above_average_10": lambda v: customers.orders_above_average(_lines(v), 10),
    "customer_totals_10": lambda v: customers.customer_totals(*_split(v), 10),
    "customers_never_delivered": lambda v: customers.customers_never_delivered(v.customers(), v.orders()),
    "orders_above_average": lambda v: customers.orders_above_average(_lines(v)),
    "customers_above_average": lambda v: customers.customers_above_average(*_split(v)),
    # 2.4 aggregations
    "count_rows": lambda v: shop.count_rows(v.orders()),
    "count_distinct_customers": lambda v: shop.count_distinct(v.flat(), "customer_id", "customers"),
    "delivered_revenue": lambda v: shop.revenue_of_status(v.orders(), "DELIVERED"),
    "avg_price_by_category": lambda v: shop.avg_price_by_category(v.products()),
    "status_revenue": lambda v: shop.status_revenue(v.orders()),
    "price_extremes": lambda v: shop.price_extremes(v.products()),
    "having_avg_price": lambda v: shop.categories_above(v.products(), 2840),
    "delivered_vs_not": lambda v: shop.delivered_or_not(v.orders()),
    "price_summary": lambda v: clean.price_summary(v.transactions()),
    "store_sales": lambda v: clean.store_sales(v.transactions()),
    "category_stats": lambda v: clean.category_stats(v.sales()),
    "region_totals": lambda v: shop.region_totals(v.sales()),
    "status_totals": lambda v: shop.status_totals(v.orders()),
    "region_west_revenue": lambda v: sales.region_revenue(v.flat(), "EUROPE"),
    "region_performance": lambda v: sales.region_performance(v.flat()),
    "category_performance": lambda v: sales.category_performance(v.flat()),
    "segment_performance": lambda v: sales.segment_performance(v.flat()),
    "yearly_growth": lambda v: sales.yearly_growth(v.flat()),
    "monthly_sales": lambda v: sales.monthly_sales(v.flat()),
    "loss_subcategories": lambda v: sales.loss_subcategories(v.flat()),
    "duplicate_keys": lambda v: dedupe.repeated_keys(v.flat(), ["order_id"]),
    "customer_totals": lambda v: customers.customer_totals(*_split(v)),
    "single_order_customers": _single_order_customers,
    "revenue_by_category": lambda v: sales.revenue_by_category(_rev(v), v.products()),
    "returns_exceed_purchases": lambda v: sales.returns_exceed_purchases(_rev(v), v.products()),
    "return_rate": lambda v: sales.return_rate(_rev(v), v.products()),
    "mart_sales_summary": lambda v: marts.sales_summary(_silver_orders(v), v.products()),
    "mart_customer_summary": lambda v: marts.customer_summary(_silver_orders(v), _silver_customers(v)),
    "mart_product_summary": lambda v: marts.product_summary(_silver_orders(v), v.products()),
    "mart_category_revenue": lambda v: marts.category_revenue(_silver_orders(v), v.products()),
    "mart_monthly_revenue": lambda v: marts.monthly_revenue(_silver_orders(v)),
    "describe_numeric": lambda v: profile.describe_numeric(
        v.flat(), ["sales", "quantity", "discount", "profit", "total_amount"]),
    "cohort_retention": lambda v: customers.cohort_retention(v.customers(), v.orders()),
    "period_breakdown_daily": lambda v: period.period_breakdown(_rev(v), "daily", *PERIOD),
    "period_breakdown_weekly": lambda v: period.period_breakdown(_rev(v), "weekly", *PERIOD),
    "period_breakdown_monthly": lambda v: period.period_breakdown(_rev(v), "monthly", *PERIOD),
    "period_comparison": lambda v: period.period_comparison(_rev(v), *PERIOD),
    # 2.5 windows
    "customer_row_number_rank": lambda v: customers.customer_row_number_rank(*_split(v)),
    "top_customers_ranked": lambda v: customers.top_customers_ranked(*_split(v)),
    "bottom_customers_ranked": lambda v: customers.bottom_customers_ranked(*_split(v)),
    "customer_overall_rank": lambda v: customers.customer_overall_rank(*_split(v)),
    "split_customers": lambda v: normalise.split_customers(v.flat()),
    "running_revenue_by_region": lambda v: sales.running_revenue(_rev(v)),
    "product_rank_in_category": lambda v: sales.product_rank(_rev(v), v.products()),
    "customer_risk": lambda v: customers.customer_risk(v.orders()),
    "monthly_customer_buckets": lambda v: customers.monthly_buckets(_rev(v), 300000, 600000),
    "ltv_quartiles": lambda v: customers.ltv_quartiles(_rev(v)),
    "yoy_growth": lambda v: sales.yoy_growth(_rev(v)),
    "yoy_growth_dense": lambda v: sales.yoy_growth(_rev(v), dense=True),
    "category_shift": lambda v: customers.category_shift(_rev(v), v.products()),
    "pareto_customers": lambda v: customers.pareto(_rev(v)),
    # 2.6 top-k
    "top_expensive_lines": lambda v: sales.top_expensive_lines(v.flat(), "PROMO", 1000),
    "top_products": lambda v: sales.top_products(v.flat()),
    "top_customers": lambda v: sales.top_customers(v.flat()),
    "bottom_products": lambda v: sales.bottom_products(v.flat()),
    "top_revenue_customers": lambda v: sales.top_revenue_customers(_rev(v)),
    "last_12_months": lambda v: sales.last_months(_rev(v)),
    "period_top_products": lambda v: period.period_top_products(_rev(v), v.products(), *PERIOD),
    # 2.7 sets and duplicates
    "table_row_counts": lambda v: profile.row_counts({
        "customers": v.customers(), "products": v.products(), "orders": v.orders(), "order_items": v.items()}),
    "split_products": lambda v: normalise.split_products(v.flat()),
    "dedupe_by_key": lambda v: dedupe.dedupe_by_key(
        v.sales(), ["order_id", "region"], order_by=["order_date", "row_id"]),
    # 2.8 to 2.10 cleaning, quality, privacy
    "clean_customers": lambda v: clean.clean_customers(v.customers_dirty()),
    "clean_products": lambda v: clean.clean_products(v.products_dirty()),
    "clean_orders": _clean_orders,
    "clean_order_items": lambda v: clean.clean_order_items(
        v.items_dirty(), _clean_orders(v), clean.clean_products(v.products_dirty())),
    "quarantine_order_items": lambda v: clean.quarantine_order_items(
        v.items_dirty(), _clean_orders(v), clean.clean_products(v.products_dirty())),
    "flag_email_valid": lambda v: clean.flag_email_valid(v.customers_dirty()),
    "fill_defaults": lambda v: clean.fill_defaults(
        v.catalogue(), clean.CATALOGUE_DEFAULTS, {"has_variations": "variations"}),
    "drop_incomplete": lambda v: clean.drop_incomplete(v.sales(), ["customer_name", "sales"]),
    "catalogue_clean": lambda v: clean.catalogue_clean(v.catalogue()),
    "high_rated": lambda v: clean.high_rated(v.catalogue()),
    "store_sales_pipeline": lambda v: clean.store_sales_pipeline(v.transactions(), "WEST"),
    "region_category_pipeline": lambda v: clean.region_category_pipeline(v.sales()),
    "null_counts": lambda v: profile.null_counts(v.flat()),
    "duplicate_report": lambda v: profile.duplicate_report(v.orders_dirty(), "order_id"),
    "quality_summary": lambda v: profile.quality_summary({
        "customers": v.customers_dirty(), "products": v.products_dirty(), "orders": v.orders_dirty(),
        "order_items": v.items_dirty()}),
    "rule_violations": _rule_violations,
    "referential_violations": _referential_violations,
    "constraint_report": _constraint_report,
    "mask_customers": lambda v: privacy.mask_customers(
        clean.clean_customers(v.customers_dirty()), F.lit(MASK_DAY).cast("date")),
    "tokenize_orders": _silver_orders,
    "lake_orders_clean": lambda v: clean.clean_lake_orders(v.lake_orders_dirty()),
    "lake_products_clean": lambda v: clean.clean_lake_products(v.products_dirty()),
    "payments_clean": lambda v: clean.clean_payments(v.payments_dirty()),
    "lake_gold_sales": lambda v: marts.sales_summary(
        privacy.tokenize_orders(clean.clean_lake_orders(v.lake_orders_dirty())),
        clean.clean_lake_products(v.products_dirty())),
    "lake_gold_customers": _gold("customer_summary"),
    "lake_gold_categories": _gold("product_summary"),
    "lake_gold_category_revenue": _gold("category_revenue"),
    "lake_gold_monthly": _gold("monthly_revenue"),
    "lake_silver_payments": lambda v: _lake(v)["payments_secure"],
    "mask_payments": lambda v: privacy.mask_payments(v.payments()),
    "clean_store_report": _clean_store_report,
    # 2.11 change
    "upsert": _upsert,
    "upsert_partitioned": _upsert_partitioned,
    "append_checked": _append_checked,
    "remove_duplicates": _remove_duplicates,
    "incremental_load": _incremental_load,
    "incremental_report": lambda v: _incremental_load(v, report=True),
    "upsert_counts": lambda v: change.upsert_counts(v.upsert_target(), v.upsert_source(), "order_id"),
    "upsert_validation": lambda v: change.upsert_validation(
        v.upsert_target(), _upsert(v), v.upsert_source(), "order_id", "order_code", "INCR-2001"),
    "conditional_update": lambda v: change.replace_null(v.flat(), "postal_code", "0"),
    "apply_stock_deltas": lambda v: change.apply_stock_deltas(v.products(), v.items()),
}


def queries() -> dict[str, Query]:
    def bind(job: Callable[[Views], DataFrame]) -> Query:
        return lambda spark, sf_dir: plain(job(Views(tune(spark), sf_dir)))
    return {name: bind(job) for name, job in QUERIES.items()}

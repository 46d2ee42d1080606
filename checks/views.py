"""The retail tables, derived from the given test tables.

`checks/oracle.py` states the same derivations in SQL. Dirt (text dates, blanks, bad numbers,
repeated rows, orphans) follows from the keys, so both engines see the same rows. Every view covers
its whole source table, but for the two sides of the upsert, which are a table and its increment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.schemas import LAKE

# Schemas of the given tables; stating them saves a job per table that would read file footers.
TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
}

REGIONS = ("NORTH", "SOUTH", "EAST", "WEST", "CENTRAL")
CUSTOMER_TYPES = ("REGULAR", "PREMIUM", "VIP")
PAYMENT_METHODS = ("Card", "Cash", "Transfer", "Wallet")
PAYMENT_STATUS = ("Paid", "Failed", "Refunded")
SALE_CATEGORIES = ("Electronics", "Clothing", "Furniture", "Office Supplies")
SALE_REGIONS = ("North", "South", "East", "West")

# Numbers of dirty items that are not plain ones: column -> (step, rest, text) for the products of that rest; the later wins.
ITEM_SPELLINGS = {
    "quantity": [(300, 8, "x"), (200, 7, "0"), (200, 11, "2.00004"), (200, 12, "2.5"), (200, 19, "1e1"), (200, 20, " 7 "),
                 (200, 21, "123456789"), (200, 22, "0.0000001"), (200, 23, "nan")],
    "unit_price": [(200, 13, "1.239"), (200, 14, "5.555"), (200, 15, "0.004"), (200, 18, "1.23456789"), (200, 24, "-0.004"),
                   (200, 25, "free")],
    "discount_percent": [(200, 9, "120"), (200, 16, "-0.001"), (200, 17, "100.004"), (200, 26, "12.3456"), (200, 27, "")],
}


def _pick(index: Column, values: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), (index % len(values) + 1).cast("int"))


def _every(key: str, step: int, rest: int = 0) -> Column:
    return F.col(key) % step == rest


class Views:
    """The derived tables of one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.dir}/{name}.parquet")

    # Customers -------------------------------------------------------------------------------

    def customers(self) -> DataFrame:
        key = F.col("c_custkey")
        places = self._table("nation").join(self._table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        email = (
            F.when(_every("c_custkey", 70), F.lit(None).cast("string"))
            .when(_every("c_custkey", 50), F.concat(F.lit("user"), key, F.lit(".mail.example.com")))
            .otherwise(F.concat(F.lit("user"), key, F.lit("@mail"), key % 9, F.lit(".example.com")))
        )
        registered = F.date_add(F.lit("1995-01-01").cast("date"), ((key * 37) % 2300).cast("int"))
        return self._table("customer").join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
            key.alias("customer_id"),
            F.when(_every("c_custkey", 12), F.concat(F.lit("  "), F.upper("c_name"), F.lit("  ")))
            .otherwise(F.col("c_name")).alias("customer_name"),
            email.alias("email"),
            F.when(~_every("c_custkey", 33), F.lpad((key * 7919).cast("string"), 10, "0")).alias("phone"),
            F.date_add(F.lit("1960-01-01").cast("date"), ((key * 13) % 16000).cast("int")).alias("dob"),
            registered.alias("registration_date"), registered.alias("signup_date"),
            F.concat(key, F.lit(" Main Street")).alias("address"),
            F.col("n_name").alias("city"), F.col("r_name").alias("state"),
            F.col("c_mktsegment").alias("segment"), F.col("r_name").alias("region"),
            _pick(key, CUSTOMER_TYPES).alias("customer_type"),
        )

    def customers_dirty(self) -> DataFrame:
        """Dates as text, and some customers twice."""
        text = self.customers().withColumns({
            "dob": F.col("dob").cast("string"), "signup_date": F.col("signup_date").cast("string")})
        return text.unionByName(text.filter(_every("customer_id", 40, 3)))

    # Orders ----------------------------------------------------------------------------------

    def _order_status(self) -> Column:
        pending = _pick(F.col("o_orderkey"), ("CANCELLED", "PLACED", "RETURNED"))
        return (F.when(F.col("o_orderstatus") == "F", "DELIVERED")
                .when(F.col("o_orderstatus") == "O", "SHIPPED").otherwise(pending))

    def orders(self) -> DataFrame:
        guest = _every("o_orderkey", 20)
        return self._table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.when(~guest, F.col("o_custkey")).alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            self._order_status().alias("status"),
            _pick(F.col("o_custkey"), REGIONS).alias("region_code"),
            guest.cast("int").alias("is_guest"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("total_amount"),
        )

    def as_of(self) -> Column:
        """The last clean order date."""
        return self.orders().agg(F.max("order_date")).scalar()

    def orders_dirty(self) -> DataFrame:
        clean = self.orders().drop("is_guest", "total_amount")
        day = F.col("order_date")
        dirty = clean.withColumns({
            "customer_id": F.when(F.col("customer_id").isNull(), _pick(F.col("order_id"), ("", "NULL", "None")))
            .otherwise(F.col("customer_id").cast("string")),
            "order_date": F.when(_every("order_id", 25), F.date_format(day, "dd-MM-yyyy"))
            .when(_every("order_id", 200, 1), F.concat(F.lit("2099-"), F.date_format(day, "MM-dd")))
            .when(_every("order_id", 500, 2), F.lit("bad-date"))
            .otherwise(day.cast("string")),
        })
        return dirty.unionByName(dirty.filter(_every("order_id", 200, 3)))

    # Items -----------------------------------------------------------------------------------

    def _item_id(self) -> Column:
        return F.concat_ws("-", *(F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")))

    def _unit_price(self) -> Column:
        """Whole cents, rounded down, of the line price per unit."""
        cents = F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity"))
        return (cents.cast("bigint") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(12,2)")

    def items(self) -> DataFrame:
        quantity = F.col("l_quantity").cast("int")
        return self._table("lineitem").select(
            self._item_id().alias("item_id"), F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.when(F.col("l_returnflag") == "R", -quantity).otherwise(quantity).alias("quantity"),
            self._unit_price().alias("unit_price"),
            F.round(F.col("l_discount") * 100).cast("int").cast("decimal(5,2)").alias("discount_percent"),
        )

    def items_dirty(self) -> DataFrame:
        orphan = (F.col("order_id") + F.col("product_id")) % 100 == 0
        def spelled(column: str) -> Column:
            """The value as text; some products have spellings of their own."""
            text = F.col(column).cast("string")
            for step, rest, value in ITEM_SPELLINGS[column]:
                text = F.when(_every("product_id", step, rest), F.lit(value)).otherwise(text)
            return text.alias(column)

        dirty = self.items().select(
            "item_id",
            F.when(orphan, -1 - F.col("order_id")).otherwise(F.col("order_id")).alias("order_id"),
            "product_id", spelled("quantity"), spelled("unit_price"), spelled("discount_percent"),
            F.col("order_id").alias("_key"),
        )
        return dirty.unionByName(dirty.filter(_every("_key", 200, 5))).drop("_key")

    # Products --------------------------------------------------------------------------------

    def products(self) -> DataFrame:
        price = F.col("p_retailprice").cast("decimal(10,2)")
        return self._table("part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"), F.col("p_brand").alias("subcategory"),
            price.alias("cost_price"),
            (price * _pick_price(F.col("p_partkey"))).cast("decimal(10,2)").alias("unit_price"),
            (F.col("p_size") * 100000).alias("stock_qty"),
        )

    def products_dirty(self) -> DataFrame:
        dirty = self.products().select(
            "product_id",
            F.when(_every("product_id", 12), F.concat(F.lit("  "), F.upper("product_name"), F.lit("  ")))
            .otherwise(F.col("product_name")).alias("product_name"),
            "category", "subcategory",
            F.when(_every("product_id", 90, 4), F.lit("n/a"))
            .when(_every("product_id", 250), (-F.col("cost_price")).cast("string"))
            .otherwise(F.col("cost_price").cast("string")).alias("cost_price"),
        )
        return dirty.unionByName(dirty.filter(_every("product_id", 100, 3)))

    # Lakehouse -------------------------------------------------------------------------------

    def lake_orders(self) -> DataFrame:
        """One row per line: the lakehouse keeps one product per order."""
        header = self._table("orders").select(
            F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("order_date"), self._order_status().alias("status"))
        return self._table("lineitem").join(header, "l_orderkey").select(
            self._item_id().alias("order_id"), "customer_id", F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"), self._unit_price().alias("unit_price"),
            F.col("l_extendedprice").cast("decimal(12,2)").alias("total_amount"), "order_date", "status",
            _pick(F.col("l_orderkey"), PAYMENT_METHODS).alias("payment_method"),
        )

    def lake_orders_dirty(self) -> DataFrame:
        """Lake orders as text dates, some unreadable, some without customer, some twice."""
        dirty = self.lake_orders().withColumns({
            "customer_id": F.when(~_every("product_id", 250, 3), F.col("customer_id")),
            "order_date": F.when(_every("product_id", 300, 4), "unknown").otherwise(F.col("order_date").cast("string")),
        })
        return dirty.unionByName(dirty.filter(_every("product_id", 100, 5)))

    def lake_order_lines(self) -> DataFrame:
        """The dirty lake orders as lines of a CSV file, in one column; some have a field too few or too many, or a number that
        its column would round."""
        def of(step: int, rest: int, value: str, otherwise: Column) -> Column:
            return F.when(_every("product_id", step, rest), F.lit(value)).otherwise(otherwise)

        text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in LAKE["orders"].names}
        text["quantity"] = of(200, 33, "2.5", text["quantity"])
        text["unit_price"] = of(200, 34, "1.239", text["unit_price"])
        text["status"] = of(200, 35, "", text["status"])
        text["total_amount"] = of(200, 38, "n/a", text["total_amount"])
        last = F.concat(F.lit(","), text["payment_method"])
        end = F.when(_every("product_id", 200, 36), "").when(_every("product_id", 200, 37), F.concat(last, F.lit(",more"))).otherwise(last)
        return self.lake_orders_dirty().select(F.concat(F.concat_ws(",", *list(text.values())[:-1]), end).alias("value"))

    def payments_dirty(self) -> DataFrame:
        """Payments as text dates, some unreadable, some twice."""
        dirty = self.payments().withColumn("payment_date", F.when(_every("order_id", 70, 3), "unknown")
                                           .otherwise(F.col("payment_date").cast("string")))
        return dirty.unionByName(dirty.filter(_every("order_id", 40, 2)))

    def payments(self) -> DataFrame:
        key = F.col("o_orderkey")
        return self._table("orders").select(
            F.concat(F.lit("PAY"), key).alias("payment_id"), key.alias("order_id"),
            F.lpad((key * 104729).cast("string"), 16, "4").alias("card_number"),
            F.lpad((key % 1000).cast("string"), 3, "0").alias("cvv"),
            (F.col("o_totalprice").cast("decimal(12,2)") * F.lit("0.05").cast("decimal(3,2)"))
            .cast("decimal(14,4)").alias("amount"),
            F.col("o_orderdate").cast("date").alias("payment_date"),
            _pick(key, PAYMENT_STATUS).alias("payment_status"),
        )

    # Flat sales table ------------------------------------------------------------------------

    def flat(self) -> DataFrame:
        """Superstore shape: a line with its order, customer and product."""
        people = self.customers().select(
            "customer_id", F.trim("customer_name").alias("customer_name"), "segment", "city", "state", "region")
        day = F.col("o_orderdate").cast("date")
        sales = F.col("l_extendedprice").cast("decimal(12,2)")
        discount = F.col("l_discount").cast("decimal(4,2)")
        quantity = F.col("l_quantity").cast("int")
        net = (sales * (F.lit("1").cast("decimal(1,0)") - discount)).cast("decimal(16,4)")
        cost = quantity * F.col("p_retailprice").cast("decimal(10,2)") * F.lit("0.9").cast("decimal(2,1)")
        joined = (
            self._table("lineitem").join(self._table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(people, F.col("o_custkey") == F.col("customer_id"))
            .join(self._table("part"), F.col("l_partkey") == F.col("p_partkey"))
        )
        return joined.select(
            self._item_id().alias("row_id"), F.col("l_orderkey").alias("order_id"),
            F.date_format(day, "M/d/yyyy").alias("order_date"),
            F.date_format(F.col("l_shipdate").cast("date"), "M/d/yyyy").alias("ship_date"),
            F.col("o_orderpriority").alias("ship_mode"), "customer_id", "customer_name", "segment",
            F.col("state").alias("country"),
            F.when(_every("l_linenumber", 5), F.concat(F.col("city"), F.lit(" North")))
            .otherwise(F.col("city")).alias("city"),
            "state",
            F.when(~_every("customer_id", 15), F.lpad(F.col("customer_id").cast("string"), 5, "0")).alias("postal_code"),
            "region", F.col("l_partkey").alias("product_id"), F.col("p_type").alias("category"),
            F.col("p_brand").alias("sub_category"), F.col("p_name").alias("product_name"),
            sales.alias("sales"), quantity.alias("quantity"), discount.alias("discount"),
            (net - cost).cast("decimal(16,4)").alias("profit"), net.alias("total_amount"),
        )

    # Smaller shapes --------------------------------------------------------------------------

    def transactions(self) -> DataFrame:
        key, customer = F.col("o_orderkey"), F.col("o_custkey")
        return self._table("orders").select(
            key.alias("transaction_id"), customer.alias("user_id"),
            F.col("o_orderdate").cast("date").alias("transaction_date"),
            F.when(~_every("o_orderkey", 40), F.col("o_totalprice").cast("decimal(12,2)").cast("string")).alias("price"),
            F.when(~_every("o_orderkey", 30), F.col("o_orderstatus")).alias("status"),
            _pick(customer, REGIONS).alias("region"),
            (customer % 50 + 18).cast("int").alias("age"),
            _pick(customer, ("Premium", "Basic", "Free")).alias("subscription"),
            (key % 100).alias("store_id"), F.col("o_orderpriority").alias("product_category"),
        )

    def sales(self) -> DataFrame:
        return self._table("lineitem").select(
            self._item_id().alias("row_id"), F.col("l_orderkey").alias("order_id"),
            F.col("l_shipdate").cast("date").alias("order_date"),
            F.when(~_every("l_partkey", 60), F.concat(F.lit("Buyer "), F.col("l_suppkey"))).alias("customer_name"),
            _pick(F.col("l_suppkey"), SALE_REGIONS).alias("region"),
            _pick(F.col("l_partkey"), SALE_CATEGORIES).alias("category"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.when(~_every("l_partkey", 35), self._unit_price()).alias("unit_price"),
            F.when(~_every("l_partkey", 45), F.col("l_extendedprice").cast("decimal(12,2)")).alias("sales"),
            F.when(~_every("l_partkey", 55), F.round(F.col("l_discount") * 200).cast("int").cast("decimal(5,2)")).alias("discount"),
            F.when(F.col("l_returnflag") == "R", "Yes").otherwise("No").alias("returned"),
        )

    def catalogue(self) -> DataFrame:
        def unless(step: int, text: str) -> Column:
            return F.when(~_every("p_partkey", step), F.concat(F.lit(text), F.col("p_brand")))
        rows = self._table("part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_name").alias("title"), F.col("p_type").alias("category"),
            (F.col("p_size") % 50 * F.lit("0.1").cast("decimal(2,1)")).cast("decimal(3,1)").alias("rating"),
            (F.col("p_partkey") % 200).alias("ratings_count"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("initial_price"),
            F.when(~_every("p_partkey", 9), F.col("p_size").cast("decimal(5,2)")).alias("discount"),
            unless(11, "Shop ").alias("seller_name"), unless(13, "About ").alias("seller_information"),
            unless(7, "Clip ").alias("videos"), unless(5, "Kinds of ").alias("variations"),
            unless(17, "Said of ").alias("what_customers_said"),
        )
        return rows.unionByName(rows.filter(_every("product_id", 20, 3)))

    # Increment -------------------------------------------------------------------------------

    def flat_by_year(self) -> DataFrame:
        """All flat lines, with the customer of each year under a key of their own."""
        return self.flat().withColumn("customer_id", F.concat_ws("-", "customer_id", F.substring("order_date", -4, 4)))

    def upsert_target(self) -> DataFrame:
        """Orders placed before 2001."""
        return self._coded(F.lit("ORD-")).filter(F.col("order_date") < F.lit("2001-01-01").cast("date"))

    def coded_orders(self) -> DataFrame:
        """All orders; those of 2001 carry the code of an increment."""
        new = F.col("order_date") >= F.lit("2001-01-01").cast("date")
        return self._coded(F.when(new, F.lit("INCR-2001-")).otherwise(F.lit("ORD-")))

    def upsert_source(self) -> DataFrame:
        """Orders from the last quarter of 2000 on, at a corrected price; those of 2001 are new."""
        day = F.col("order_date")
        new = day >= F.lit("2001-01-01").cast("date")
        rows = self._coded(F.when(new, F.lit("INCR-2001-")).otherwise(F.lit("ORD-")))
        return rows.filter(day >= F.lit("2000-10-01").cast("date")).withColumn(
            "total_amount", (F.col("total_amount") + 1).cast("decimal(12,2)"))

    def batch(self) -> DataFrame:
        """The increment as a careless sender brings it: every row twice, some without a key, some of a customer nobody knows, some
        once more at another price."""
        rows = self.upsert_source()
        return (
            rows.unionByName(rows)
            .unionByName(rows.filter(_every("order_id", 50)).withColumn("order_id", F.lit(None).cast("bigint")))
            .unionByName(rows.filter(_every("order_id", 90, 1)).withColumn("customer_id", F.lit(-1).cast("bigint")))
            .unionByName(rows.filter(_every("order_id", 70, 3)).withColumn("total_amount", (F.col("total_amount") + 5).cast("decimal(12,2)")))
        )

    def _coded(self, prefix: Column) -> DataFrame:
        return self.orders().select(
            "order_id", F.concat(prefix, F.col("order_id")).alias("order_code"), "customer_id", "order_date",
            "status", "total_amount")


def _pick_price(key: Column) -> Column:
    """Factor that spreads list prices over all price tiers."""
    return (key % 5 + 1).cast("decimal(1,0)")

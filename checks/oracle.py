"""The SQL statement DuckDB runs for each query, over the same test tables.

`VIEWS` restates the derivations of `checks/views.py`; a statement takes the views it mentions as
common table expressions.
"""

from __future__ import annotations

import re

from checks.views import ITEM_SPELLINGS


def _pick(index: str, *values: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {index} % {len(values)} {cases} END"


def money(expression: str) -> str:
    """A sum of money with two decimals."""
    return f"CAST(ROUND({expression}, 2) AS DOUBLE)"


def ratio(numerator: str, denominator: str, scale: int = 2) -> str:
    """numerator / denominator rounded half away from zero in whole numbers; NULL over 0."""
    top = f"CAST(CAST({numerator} AS DECIMAL(30,6)) * CAST(1000000 AS DECIMAL(7,0)) AS HUGEINT)"
    bottom = f"CAST(CAST({denominator} AS DECIMAL(30,6)) * CAST(1000000 AS DECIMAL(7,0)) AS HUGEINT)"
    size = 10 ** scale
    return (f"CASE WHEN {bottom} = 0 THEN NULL ELSE CAST(SIGN({top}) * SIGN({bottom}) * "
            f"((2 * ABS({top}) * {size} + ABS({bottom})) // (2 * ABS({bottom}))) AS DOUBLE) / {size} END")


def average(expression: str) -> str:
    return ratio(f"SUM({expression})", f"COUNT({expression})")


ITEM_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"
UNIT_PRICE = "CAST(CAST(FLOOR(l_extendedprice * 100 / l_quantity) AS BIGINT) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2))"
ITEM_NUMBERS = {"quantity": 8, "unit_price": 8, "discount_percent": 3}  # digits before the point; six after it


def _spelled(column: str) -> str:
    cases = " ".join(f"WHEN product_id % {step} = {rest} THEN '{text}'" for step, rest, text in reversed(ITEM_SPELLINGS[column]))
    return f"CASE {cases} ELSE CAST({column} AS VARCHAR) END AS {column}"


def _fits(column: str) -> str:
    read = f"{column}_read"
    return f"(trunc({read} * 1000000) = {read} * 1000000 AND abs({read}) < 1e{ITEM_NUMBERS[column]})"


STATUS = ("CASE o_orderstatus WHEN 'F' THEN 'DELIVERED' WHEN 'O' THEN 'SHIPPED' ELSE "
          + _pick("o_orderkey", "CANCELLED", "PLACED", "RETURNED") + " END")
REGION = _pick("o_custkey", "NORTH", "SOUTH", "EAST", "WEST", "CENTRAL")

VIEWS: dict[str, str] = {
    "fx_customers": f"""
        SELECT c_custkey AS customer_id,
               CASE WHEN c_custkey % 12 = 0 THEN '  ' || upper(c_name) || '  ' ELSE c_name END AS customer_name,
               CASE WHEN c_custkey % 70 = 0 THEN NULL
                    WHEN c_custkey % 50 = 0 THEN 'user' || c_custkey || '.mail.example.com'
                    ELSE 'user' || c_custkey || '@mail' || (c_custkey % 9) || '.example.com' END AS email,
               CASE WHEN c_custkey % 33 <> 0 THEN lpad(CAST(c_custkey * 7919 AS VARCHAR), 10, '0') END AS phone,
               DATE '1960-01-01' + CAST((c_custkey * 13) % 16000 AS INTEGER) AS dob,
               DATE '1995-01-01' + CAST((c_custkey * 37) % 2300 AS INTEGER) AS registration_date,
               DATE '1995-01-01' + CAST((c_custkey * 37) % 2300 AS INTEGER) AS signup_date,
               c_custkey || ' Main Street' AS address, n_name AS city, r_name AS state,
               c_mktsegment AS segment, r_name AS region,
               {_pick("c_custkey", "REGULAR", "PREMIUM", "VIP")} AS customer_type
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "fx_customers_dirty": """
        SELECT * FROM fx_customers UNION ALL SELECT * FROM fx_customers WHERE customer_id % 40 = 3""",
    "fx_orders": f"""
        SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 20 <> 0 THEN o_custkey END AS customer_id,
               CAST(o_orderdate AS DATE) AS order_date, {STATUS} AS status, {REGION} AS region_code,
               CAST(o_orderkey % 20 = 0 AS INTEGER) AS is_guest,
               CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount
        FROM orders""",
    "fx_orders_dirty_once": f"""
        SELECT order_id,
               CASE WHEN customer_id IS NULL THEN {_pick("order_id", "", "NULL", "None")}
                    ELSE CAST(customer_id AS VARCHAR) END AS customer_id,
               CASE WHEN order_id % 25 = 0 THEN strftime(order_date, '%d-%m-%Y')
                    WHEN order_id % 200 = 1 THEN '2099-' || strftime(order_date, '%m-%d')
                    WHEN order_id % 500 = 2 THEN 'bad-date'
                    ELSE strftime(order_date, '%Y-%m-%d') END AS order_date,
               status, region_code
        FROM fx_orders""",
    "fx_orders_dirty": """
        SELECT * FROM fx_orders_dirty_once UNION ALL SELECT * FROM fx_orders_dirty_once WHERE order_id % 200 = 3""",
    "fx_items": f"""
        SELECT {ITEM_ID} AS item_id, l_orderkey AS order_id, l_partkey AS product_id,
               CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS INTEGER) AS quantity,
               {UNIT_PRICE} AS unit_price,
               CAST(CAST(ROUND(l_discount * 100) AS INTEGER) AS DECIMAL(5,2)) AS discount_percent
        FROM lineitem""",
    "fx_items_dirty_once": f"""
        SELECT item_id,
               CASE WHEN (order_id + product_id) % 100 = 0 THEN -1 - order_id ELSE order_id END AS order_id, product_id,
               {_spelled("quantity")}, {_spelled("unit_price")}, {_spelled("discount_percent")}, order_id AS source_key
        FROM fx_items""",
    "fx_items_dirty": """
        SELECT * EXCLUDE (source_key) FROM fx_items_dirty_once
        UNION ALL SELECT * EXCLUDE (source_key) FROM fx_items_dirty_once WHERE source_key % 200 = 5""",
    "fx_items_read": f"""
        SELECT *, {", ".join(f"TRY_CAST(trim({c}) AS DECIMAL(38,15)) AS {c}_read" for c in ITEM_NUMBERS)} FROM fx_items_dirty""",
    "fx_items_typed": f"""
        SELECT item_id, order_id, product_id, {", ".join(f"CASE WHEN {_fits(c)} THEN {c}_read END AS {c}" for c in ITEM_NUMBERS)}
        FROM fx_items_read""",
    "fx_products": """
        SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS subcategory,
               CAST(p_retailprice AS DECIMAL(10,2)) AS cost_price,
               CAST(CAST(p_retailprice AS DECIMAL(10,2)) * CAST(p_partkey % 5 + 1 AS DECIMAL(1,0)) AS DECIMAL(10,2))
                   AS unit_price,
               p_size * 100000 AS stock_qty
        FROM part""",
    "fx_products_dirty_once": """
        SELECT product_id,
               CASE WHEN product_id % 12 = 0 THEN '  ' || upper(product_name) || '  ' ELSE product_name END
                   AS product_name, category, subcategory,
               CASE WHEN product_id % 90 = 4 THEN 'n/a' WHEN product_id % 250 = 0 THEN CAST(-cost_price AS VARCHAR)
                    ELSE CAST(cost_price AS VARCHAR) END AS cost_price
        FROM fx_products""",
    "fx_products_dirty": """
        SELECT * FROM fx_products_dirty_once
        UNION ALL SELECT * FROM fx_products_dirty_once WHERE product_id % 100 = 3""",
    "fx_line": """
        SELECT i.item_id, i.order_id, i.product_id, o.customer_id, o.order_date, o.status, o.region_code, o.is_guest,
               p.category, p.subcategory, p.product_name, p.cost_price, i.quantity, i.unit_price, i.discount_percent,
               o.order_date AS order_day, strftime(o.order_date, '%Y-%m') AS order_month,
               CAST(i.quantity * i.unit_price * ((100 - i.discount_percent) * CAST(0.01 AS DECIMAL(3,2)))
                    AS DECIMAL(18,6)) AS net_revenue
        FROM fx_items i JOIN fx_orders o USING (order_id) JOIN fx_products p USING (product_id)""",
    "fx_line_facts": """
        SELECT *, CASE WHEN quantity < 0 THEN 0 ELSE net_revenue END AS gross_revenue,
               CASE WHEN quantity < 0 THEN -net_revenue ELSE 0 END AS return_value,
               CAST(quantity < 0 AS INTEGER) AS is_return
        FROM fx_line""",
    "fx_revenue": "SELECT * FROM fx_line WHERE status <> 'CANCELLED'",
    "fx_lake_orders": f"""
        SELECT {ITEM_ID} AS order_id, o_custkey AS customer_id, l_partkey AS product_id,
               CAST(l_quantity AS INTEGER) AS quantity, {UNIT_PRICE} AS unit_price,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS total_amount, CAST(o_orderdate AS DATE) AS order_date,
               {STATUS} AS status, {_pick("l_orderkey", "Card", "Cash", "Transfer", "Wallet")} AS payment_method
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "fx_lake_orders_dirty_once": """
        SELECT * REPLACE (CASE WHEN product_id % 250 <> 3 THEN customer_id END AS customer_id,
                          CASE WHEN product_id % 300 = 4 THEN 'unknown' ELSE CAST(order_date AS VARCHAR) END AS order_date)
        FROM fx_lake_orders""",
    "fx_lake_orders_dirty": """
        SELECT * FROM fx_lake_orders_dirty_once
        UNION ALL SELECT * FROM fx_lake_orders_dirty_once WHERE product_id % 100 = 5""",
    "fx_lake_order_lines": """
        SELECT *, CASE WHEN product_id % 200 IN (36, 37) THEN 'malformed_line' ELSE concat_ws(',',
                   CASE WHEN customer_id IS NULL THEN 'missing:customer_id' END,
                   CASE WHEN product_id % 200 = 33 THEN 'does_not_fit:quantity' END,
                   CASE WHEN product_id % 200 = 34 THEN 'does_not_fit:unit_price' END,
                   CASE WHEN product_id % 200 = 38 THEN 'not_a_number:total_amount' END,
                   CASE WHEN order_date = 'unknown' THEN 'malformed:order_date' END,
                   CASE WHEN product_id % 200 = 35 THEN 'missing:status' END) END AS reject_reasons,
               CASE WHEN product_id % 200 = 33 THEN '2.5' ELSE CAST(quantity AS VARCHAR) END AS quantity_text,
               CASE WHEN product_id % 200 = 34 THEN '1.239' ELSE CAST(unit_price AS VARCHAR) END AS price_text,
               CASE WHEN product_id % 200 = 38 THEN 'n/a' ELSE CAST(total_amount AS VARCHAR) END AS amount_text,
               CASE WHEN product_id % 200 = 35 THEN '' ELSE status END AS status_text
        FROM fx_lake_orders_dirty""",
    "good_lake_orders": """
        SELECT * EXCLUDE (place) REPLACE (TRY_CAST(order_date AS DATE) AS order_date) FROM (
            SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY customer_id NULLS FIRST, product_id, quantity,
                                         unit_price, total_amount, order_date, status, payment_method) AS place
            FROM fx_lake_orders_dirty)
        WHERE place = 1 AND order_id IS NOT NULL AND customer_id IS NOT NULL AND product_id IS NOT NULL""",
    "good_lake_products": """
        SELECT DISTINCT * REPLACE (capitals(product_name) AS product_name, capitals(category) AS category)
        FROM fx_products_dirty""",
    "fx_payments_dirty": """
        SELECT *, lpad(CAST(order_id % 1000 AS VARCHAR), 3, '0') AS cvv,
               CASE WHEN order_id % 70 <> 3 THEN CAST(payment_date AS VARCHAR) ELSE 'unknown' END AS paid
        FROM fx_payments, range(2) copy(n) WHERE n = 0 OR order_id % 40 = 2""",
    "fx_payments": f"""
        SELECT 'PAY' || o_orderkey AS payment_id, o_orderkey AS order_id,
               lpad(CAST(o_orderkey * 104729 AS VARCHAR), 16, '4') AS card_number,
               CAST(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.05 AS DECIMAL(3,2)) AS DECIMAL(14,4)) AS amount,
               CAST(o_orderdate AS DATE) AS payment_date,
               {_pick("o_orderkey", "Paid", "Failed", "Refunded")} AS payment_status
        FROM orders""",
    "fx_flat": f"""
        SELECT {ITEM_ID} AS row_id, l_orderkey AS order_id, strftime(o_orderdate, '%-m/%-d/%Y') AS order_date,
               strftime(l_shipdate, '%-m/%-d/%Y') AS ship_date, o_orderpriority AS ship_mode, customer_id,
               trim(customer_name) AS customer_name, segment, state AS country,
               CASE WHEN l_linenumber % 5 = 0 THEN city || ' North' ELSE city END AS city, state,
               CASE WHEN customer_id % 15 <> 0 THEN lpad(CAST(customer_id AS VARCHAR), 5, '0') END AS postal_code,
               region, l_partkey AS product_id, p_type AS category, p_brand AS sub_category, p_name AS product_name,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS sales, CAST(l_quantity AS INTEGER) AS quantity,
               CAST(l_discount AS DECIMAL(4,2)) AS discount,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
                    - CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(10,2)) * CAST(0.9 AS DECIMAL(2,1))
                    AS DECIMAL(16,4)) AS profit,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(16,4))
                   AS total_amount
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN fx_customers ON o_custkey = customer_id
             JOIN part ON l_partkey = p_partkey""",
    "fx_transactions": f"""
        SELECT o_orderkey AS transaction_id, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS transaction_date,
               CASE WHEN o_orderkey % 40 <> 0 THEN CAST(o_totalprice AS DECIMAL(12,2)) END AS price,
               CASE WHEN o_orderkey % 30 <> 0 THEN o_orderstatus END AS status, {REGION} AS region,
               CAST(o_custkey % 50 + 18 AS INTEGER) AS age, {_pick("o_custkey", "Premium", "Basic", "Free")} AS subscription,
               o_orderkey % 100 AS store_id, o_orderpriority AS product_category
        FROM orders""",
    "fx_sales": f"""
        SELECT {ITEM_ID} AS row_id, l_orderkey AS order_id, CAST(l_shipdate AS DATE) AS order_date,
               CASE WHEN l_partkey % 60 <> 0 THEN 'Buyer ' || l_suppkey END AS customer_name,
               {_pick("l_suppkey", "North", "South", "East", "West")} AS region,
               {_pick("l_partkey", "Electronics", "Clothing", "Furniture", "Office Supplies")} AS category,
               CAST(l_quantity AS INTEGER) AS quantity,
               CASE WHEN l_partkey % 35 <> 0 THEN {UNIT_PRICE} END AS unit_price,
               CASE WHEN l_partkey % 45 <> 0 THEN CAST(l_extendedprice AS DECIMAL(12,2)) END AS sales,
               CASE WHEN l_partkey % 55 <> 0 THEN CAST(CAST(ROUND(l_discount * 200) AS INTEGER) AS DECIMAL(5,2)) END
                   AS discount,
               CASE WHEN l_returnflag = 'R' THEN 'Yes' ELSE 'No' END AS returned
        FROM lineitem""",
    "fx_catalogue_once": """
        SELECT p_partkey AS product_id, p_name AS title, p_type AS category,
               CAST(p_size % 50 * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(3,1)) AS rating, p_partkey % 200 AS ratings_count,
               CAST(p_retailprice AS DECIMAL(10,2)) AS initial_price,
               CASE WHEN p_partkey % 9 <> 0 THEN CAST(p_size AS DECIMAL(5,2)) END AS discount,
               CASE WHEN p_partkey % 11 <> 0 THEN 'Shop ' || p_brand END AS seller_name,
               CASE WHEN p_partkey % 13 <> 0 THEN 'About ' || p_brand END AS seller_information,
               CASE WHEN p_partkey % 7 <> 0 THEN 'Clip ' || p_brand END AS videos,
               CASE WHEN p_partkey % 5 <> 0 THEN 'Kinds of ' || p_brand END AS variations,
               CASE WHEN p_partkey % 17 <> 0 THEN 'Said of ' || p_brand END AS what_customers_said
        FROM part""",
    "fx_catalogue": """
        SELECT * FROM fx_catalogue_once UNION ALL SELECT * FROM fx_catalogue_once WHERE product_id % 20 = 3""",
    "fx_target": """
        SELECT order_id, 'ORD-' || order_id AS order_code, customer_id, order_date, status, total_amount
        FROM fx_orders WHERE order_date < DATE '2001-01-01'""",
    "fx_source": """
        SELECT order_id, CASE WHEN order_date >= DATE '2001-01-01' THEN 'INCR-2001-' ELSE 'ORD-' END || order_id
                   AS order_code, customer_id, order_date, status, CAST(total_amount + 1 AS DECIMAL(12,2)) AS total_amount
        FROM fx_orders WHERE order_date >= DATE '2000-10-01'""",
    "fx_coded": """
        SELECT order_id, CASE WHEN order_date >= DATE '2001-01-01' THEN 'INCR-2001-' ELSE 'ORD-' END || order_id
                   AS order_code, customer_id, order_date, status, total_amount FROM fx_orders""",
    "fx_merged": """
        SELECT t.* FROM fx_target t ANTI JOIN fx_source s USING (order_id) UNION ALL SELECT * FROM fx_source""",
    # Shared results of jobs.
    "people": """
        SELECT customer_id, customer_name, segment, region, state, city FROM (
            SELECT customer_id, customer_name, segment, region, state, city,
                   row_number() OVER (PARTITION BY customer_id
                                      ORDER BY count(*) DESC, customer_name, segment, region, state, city) AS place
            FROM fx_flat GROUP BY customer_id, customer_name, segment, region, state, city)
        WHERE place = 1""",
    "buyer": """
        SELECT p.customer_id, p.customer_name, p.segment, p.region, SUM(f.sales) AS sales, SUM(f.profit) AS profit,
               COUNT(DISTINCT f.order_id) AS order_count
        FROM fx_flat f JOIN people p USING (customer_id)
        GROUP BY p.customer_id, p.customer_name, p.segment, p.region""",
    "good_orders": """
        SELECT order_id, CASE WHEN customer_id NOT IN ('', 'NULL', 'None', 'nan') THEN customer_id END AS customer_id,
               day AS order_date, status, region_code,
               CAST(customer_id IN ('', 'NULL', 'None', 'nan') AS INTEGER) AS is_guest
        FROM (SELECT DISTINCT *, CASE WHEN order_date LIKE '____-%' THEN CAST(try_strptime(order_date, '%Y-%m-%d') AS DATE)
                                      WHEN order_date LIKE '__-%' THEN CAST(try_strptime(order_date, '%d-%m-%Y') AS DATE)
                                 END AS day
              FROM fx_orders_dirty)
        WHERE day <= (SELECT MAX(order_date) FROM fx_orders)""",
    "good_products": """
        SELECT product_id,
               list_aggregate(list_transform(string_split(lower(trim(product_name)), ' '),
                                             lambda w: upper(w[1]) || w[2:]), 'string_agg', ' ') AS product_name,
               category, subcategory, TRY_CAST(cost_price AS DECIMAL(12,2)) AS cost_price
        FROM (SELECT DISTINCT * FROM fx_products_dirty) WHERE TRY_CAST(cost_price AS DECIMAL(12,2)) > 0""",
    "judged_items": f"""
        SELECT d.* EXCLUDE (quantity_read, unit_price_read, discount_percent_read),
               CASE WHEN {" OR ".join(f"{c}_read IS NULL" for c in ITEM_NUMBERS)} THEN 'not_a_number'
                    WHEN NOT ({" AND ".join(_fits(c) for c in ITEM_NUMBERS)}) THEN 'does_not_fit'
                    WHEN quantity_read = 0 THEN 'zero_quantity'
                    WHEN unit_price_read <= 0 THEN 'non_positive_price'
                    WHEN discount_percent_read NOT BETWEEN 0 AND 100 THEN 'discount_out_of_range'
                    WHEN order_id NOT IN (SELECT order_id FROM good_orders) THEN 'unknown_order'
                    WHEN product_id NOT IN (SELECT product_id FROM good_products) THEN 'unknown_product'
               END AS reject_reason
        FROM (SELECT item_id, order_id, product_id, quantity, unit_price, discount_percent, COUNT(*) AS copies,
                     any_value(quantity_read) AS quantity_read, any_value(unit_price_read) AS unit_price_read,
                     any_value(discount_percent_read) AS discount_percent_read,
                     row_number() OVER (PARTITION BY item_id ORDER BY order_id, product_id, quantity, unit_price,
                                        discount_percent) AS place
              FROM fx_items_read GROUP BY item_id, order_id, product_id, quantity, unit_price, discount_percent) d""",
    "good_customers": """
        SELECT customer_id, capitals(customer_name) AS customer_name, email,
               CASE WHEN phone IS NULL THEN 'Not Provided'
                    ELSE '(' || phone[1:3] || ') ' || phone[4:6] || '-' || phone[7:10] END AS phone,
               dob, registration_date, signup_date, trim(address) AS address, capitals(city) AS city,
               capitals(state) AS state, segment, region, customer_type
        FROM (SELECT DISTINCT * FROM fx_customers_dirty)
        WHERE regexp_matches(email, '^[\\w\\.-]+@[\\w\\.-]+\\.\\w+$')""",
    "masked": """
        SELECT left(customer_name, 1) || '***' AS customer_name,
               left(email, 1) || '***@' || string_split(email, '@')[-1] AS email,
               '(XXX) XXX-' || right(phone, 4) AS phone,
               '*** ' || string_split(address, ' ')[-1] AS address, city, state, signup_date,
               sha256(CAST(customer_id AS VARCHAR)) AS customer_token,
               CAST(date_sub('month', dob, DATE '2004-06-15') // 12 AS INTEGER) AS age
        FROM SOURCE_CUSTOMERS""",
}


def _capitals(text: str) -> str:
    """Words of `text`, split at blanks, with a capital first letter."""
    return (f"list_aggregate(list_transform(string_split(lower(trim({text})), ' '), "
            f"lambda w: upper(w[1]) || w[2:]), 'string_agg', ' ')")


for _name in ("good_customers", "good_lake_products"):
    VIEWS[_name] = re.sub(r"capitals\((\w+)\)", lambda m: _capitals(m[1]), VIEWS[_name])
VIEWS["masked_clean"] = VIEWS["masked"].replace("SOURCE_CUSTOMERS", "good_customers")
VIEWS["masked_raw"] = VIEWS.pop("masked").replace("SOURCE_CUSTOMERS", "fx_customers")

AGE_BAND = ("CASE WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34' WHEN age < 45 THEN '35-44' "
            "WHEN age < 55 THEN '45-54' ELSE '55+' END")


def _iso(column: str, name: str | None = None) -> str:
    return f"CAST({column} AS VARCHAR) AS {name or column.split('.')[-1]}"


def _double(column: str, name: str | None = None) -> str:
    return f"CAST({column} AS DOUBLE) AS {name or column.split('.')[-1]}"


CLEAN_ORDER = f"""order_id, customer_id, {_iso("order_date")}, status, region_code, is_guest,
    {_double("total_amount")}"""
CODED_ORDER = f"""order_id, order_code, customer_id, {_iso("order_date")}, status, {_double("total_amount")}"""
WIDE_LINE = f"""item_id, order_id, product_id, customer_id, {_iso("order_date")}, status, region_code, is_guest,
    category, subcategory, product_name, {_double("cost_price")}, quantity, {_double("unit_price")},
    {_double("discount_percent")}, {_iso("order_day")}, order_month, {_double("net_revenue")},
    {_double("gross_revenue")}, {_double("return_value")}, is_return"""
FLAT = ("row_id order_id order_date ship_date ship_mode customer_id customer_name segment country city state "
        "postal_code region product_id category sub_category product_name sales quantity discount profit "
        "total_amount").split()
FLAT_MONEY = {"sales", "discount", "profit", "total_amount"}
PRODUCT = f"""product_id, product_name, category, subcategory, {_double("cost_price")}, {_double("unit_price")}, stock_qty"""
SALE = f"""row_id, order_id, {_iso("order_date")}, customer_name, region, category, quantity, {_double("unit_price")},
    {_double("sales")}, {_double("discount")}, returned"""
IN_PERIOD = "order_date BETWEEN DATE '1998-01-01' AND DATE '1998-06-30'"


def _nulls(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_count FROM {table}" for c in columns)


def _describe(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, COUNT({c}) AS "count", ROUND(AVG(CAST({c} AS DOUBLE)), 4) AS mean,
        ROUND(STDDEV_SAMP(CAST({c} AS DOUBLE)), 4) AS stddev, ROUND(MIN(CAST({c} AS DOUBLE)), 4) AS "min",
        ROUND(MAX(CAST({c} AS DOUBLE)), 4) AS "max" FROM fx_flat""" for c in columns)


def _quality(name: str, table: str, columns: list[str]) -> str:
    nulls = " + ".join(f"COUNT(*) - COUNT({c})" for c in columns)
    return f"""SELECT '{name}' AS dataset, COUNT(*) AS row_count, {nulls} AS total_nulls,
        COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM {table})) AS exact_duplicates FROM {table}"""


def _breakdown(period: str) -> str:
    return f"""SELECT {period} AS period, COUNT(DISTINCT order_id) AS orders, {money("SUM(net_revenue)")} AS revenue
        FROM fx_revenue WHERE {IN_PERIOD} GROUP BY 1"""


def _mart(joined: str, keys: str, *measures: str, orders: str = "fx_lake_orders") -> str:
    return f"SELECT {keys}, {', '.join(measures)} FROM {orders} o {joined} GROUP BY {keys}"


def _customer_mart(orders: str, people: str) -> str:
    return f"""SELECT customer_token, age_band, city, state, COUNT(*) AS total_orders,
        {money("SUM(total_amount)")} AS total_spent, {average("total_amount")} AS avg_order_value
        FROM {orders} o JOIN (SELECT *, {AGE_BAND} AS age_band FROM {people}) c
        ON c.customer_token = sha256(CAST(o.customer_id AS VARCHAR)) GROUP BY customer_token, age_band, city, state"""


def _bucket(amount: str) -> str:
    return (f"CASE WHEN {amount} < 1000 THEN 'Low' WHEN {amount} < 5000 THEN 'Medium' WHEN {amount} < 15000 THEN 'High' "
            f"ELSE 'Very High' END AS spending_bucket")


def _not_null(table: str, view: str, columns: str) -> list[str]:
    return [_violations(table, "not_null", c, _bad(view, f"{c} IS NULL")) for c in columns.split()]


_TO_PRODUCT = "JOIN fx_products p USING (product_id)"
_YOY = """SELECT ym, {revenue} AS revenue, {prior} AS prev_year_revenue, {growth} AS yoy_growth_pct
    FROM (SELECT ym, revenue, lag(revenue, 12) OVER (ORDER BY ym) AS prior FROM ({months}))"""


def _yoy(months: str) -> str:
    return _YOY.format(revenue=money("revenue"), prior=money("prior"),
                       growth=ratio("(revenue - prior) * 100", "prior"), months=months)


_MONTHS = "SELECT order_month AS ym, SUM(net_revenue) AS revenue FROM fx_revenue GROUP BY order_month"
_DENSE = f"""SELECT strftime(m, '%Y-%m') AS ym, COALESCE(revenue, 0) AS revenue
    FROM (SELECT unnest(generate_series(MIN(CAST(ym || '-01' AS DATE)), MAX(CAST(ym || '-01' AS DATE)),
                                        INTERVAL 1 MONTH)) AS m FROM ({_MONTHS}))
    LEFT JOIN ({_MONTHS}) have ON have.ym = strftime(m, '%Y-%m')"""


def _violations(table: str, kind: str, name: str, count: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{kind}' AS kind, '{name}' AS constraint_name, "
            f"({count}) AS violations")


def _repeated(table: str, column: str) -> str:
    return (f"SELECT COUNT(*) FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL "
            f"GROUP BY {column} HAVING COUNT(*) > 1)")


def _bad(table: str, condition: str) -> str:
    return f"SELECT COUNT(*) FROM {table} WHERE {condition}"


VALIDATION = """SELECT *, CAST(expected = actual AS INTEGER) AS passed FROM (
    SELECT 'row_delta' AS "check", (SELECT COUNT(*) FROM fx_source s ANTI JOIN fx_target t USING (order_id)) AS expected,
           (SELECT COUNT(*) FROM fx_merged) - (SELECT COUNT(*) FROM fx_target) AS actual
    UNION ALL SELECT 'duplicate_keys', 0, (SELECT COUNT(*) - COUNT(DISTINCT order_id) FROM fx_merged)
    UNION ALL SELECT 'new_rows_by_prefix', (SELECT COUNT(*) FROM fx_source WHERE order_code LIKE 'INCR-2001%'),
           (SELECT COUNT(*) FROM fx_merged WHERE order_code LIKE 'INCR-2001%'))"""

QUERIES: dict[str, str] = {
    "csv_round_trip": f"SELECT customer_id, customer_name, email, phone, {_iso('signup_date')} FROM fx_customers",
    "parquet_round_trip": f"""SELECT item_id, order_id, quantity, {_double("net_revenue")}, {_iso("order_day")},
        order_month FROM fx_line""",
    "table_round_trip": f"SELECT {CLEAN_ORDER} FROM fx_orders",
    "append_new_rows": f"""SELECT {CODED_ORDER} FROM (SELECT * FROM fx_target UNION ALL
        SELECT s.* FROM fx_source s ANTI JOIN fx_target t USING (order_id))""",
    "bronze_copy": """SELECT 'customers' AS dataset, CAST(customer_id AS VARCHAR) AS id, customer_name AS name,
        phone AS detail FROM fx_customers
        UNION ALL SELECT 'products', CAST(product_id AS VARCHAR), product_name, CAST(cost_price AS VARCHAR)
        FROM fx_products""",
    "project_columns": "SELECT customer_id, customer_name, city FROM fx_customers",
    "net_sales_enrich": f"""SELECT row_id, order_id, {_iso("order_date")}, customer_name AS customer, region, category,
        quantity, {_double("unit_price")}, {_double("sales")}, {_double("discount")},
        {money("sales * ((100 - discount) * CAST(0.01 AS DECIMAL(3,2)))")} AS net_sales,
        CASE WHEN discount >= 10 THEN 'High' WHEN discount < 10 THEN 'Low' END AS discount_type,
        'Shelfmark' AS company FROM fx_sales""",
    "split_orders": f"""SELECT row_id, order_id, order_date, ship_date, ship_mode, customer_id, product_id,
        {_double("sales")}, quantity, {_double("discount")}, {_double("profit")} FROM fx_flat""",
    "rename_positional": "SELECT " + ", ".join(
        f"{f'CAST({c} AS DOUBLE)' if c in FLAT_MONEY else c} AS c{i:02d}" for i, c in enumerate(FLAT, 1)) + " FROM fx_flat",
    "filter_status": f"SELECT {CLEAN_ORDER} FROM fx_orders WHERE status = 'DELIVERED'",
    "filter_category_price": f"SELECT {PRODUCT} FROM fx_products WHERE category = 'PROMO' AND unit_price > 2000",
    "filter_between_segment": f"""SELECT transaction_id, user_id, {_iso("transaction_date")},
        CAST(price AS VARCHAR) AS price, status, region, age, subscription, store_id, product_category
        FROM fx_transactions WHERE age BETWEEN 18 AND 30 AND subscription = 'Premium'""",
    "filter_date_range": f"""SELECT {CLEAN_ORDER} FROM fx_orders
        WHERE order_date BETWEEN DATE '1998-08-10' AND DATE '1998-08-25' AND status <> 'CANCELLED'""",
    "filter_year_range": f"SELECT {CLEAN_ORDER} FROM fx_orders WHERE year(order_date) = 1997",
    "filter_high_discount": f"""SELECT row_id, product_name, {_double("sales")}, {_double("discount")},
        {money("profit")} AS profit FROM fx_flat WHERE discount >= 0.08""",
    "filter_prefix": f"SELECT {CODED_ORDER} FROM fx_coded WHERE order_code LIKE 'INCR-2001%'",
    "price_tiers": f"""SELECT product_id, product_name, {_double("unit_price")},
        CASE WHEN unit_price < 1000 THEN 'Budget' WHEN unit_price <= 3000 THEN 'Mid-Range' ELSE 'Premium' END
            AS price_tier FROM fx_products""",
    "line_facts": f"SELECT {WIDE_LINE} FROM fx_line_facts",
    "revenue_lines": f"SELECT {WIDE_LINE} FROM fx_line_facts WHERE status <> 'CANCELLED'",
    "join_order_customer": f"""SELECT order_id, {_iso("order_date")}, customer_name, {_double("total_amount")}
        FROM fx_orders JOIN fx_customers USING (customer_id)""",
    "join_left_customers": f"""SELECT c.customer_id, customer_name, order_id, {_iso("order_date")},
        {_double("total_amount")} FROM fx_customers c LEFT JOIN fx_orders s ON s.customer_id = c.customer_id""",
    "join_right_orders": """SELECT customer_name, order_id
        FROM fx_customers c RIGHT JOIN fx_orders o ON o.customer_id = c.customer_id""",
    "join_full": """SELECT COALESCE(c.customer_id, s.customer_id) AS customer_id, customer_name, order_id
        FROM fx_customers c FULL JOIN fx_orders s ON s.customer_id = c.customer_id""",
    "join_three_way": f"""SELECT item_id, o.order_id, product_name, quantity, {_double("i.unit_price")},
        {_double("discount_percent")} FROM fx_orders o JOIN fx_items i USING (order_id)
        JOIN fx_products p USING (product_id)""",
    "orphan_orders": f"""SELECT {CLEAN_ORDER} FROM fx_orders o
        WHERE NOT EXISTS (SELECT 1 FROM fx_customers c WHERE c.customer_id = o.customer_id)""",
    "basket_pairs": """SELECT product_a, product_b, times_bought_together,
        row_number() OVER (ORDER BY times_bought_together DESC, product_a, product_b) AS pair_rank
        FROM (SELECT products[i] AS product_a, product_b, COUNT(*) AS times_bought_together
              FROM (SELECT products, i, unnest(products[i + 1:]) AS product_b
                    FROM (SELECT products, unnest(range(1, len(products))) AS i
                          FROM (SELECT list_sort(list(DISTINCT product_id)) AS products FROM fx_revenue
                                WHERE quantity > 0 AND order_id IS NOT NULL GROUP BY order_id)))
              GROUP BY products[i], product_b HAVING COUNT(*) > 2)""",
    "top_order_per_customer": f"""SELECT f.customer_id, row_id, order_id, {_double("sales")} FROM fx_flat f
        JOIN (SELECT customer_id, MAX(sales) AS best FROM fx_flat GROUP BY customer_id) m
        ON m.customer_id = f.customer_id AND m.best = f.sales""",
    "top_order_per_customer_10": f"""SELECT customer_id, row_id, order_id, {_double("sales")} FROM (
        SELECT *, max(sales) OVER (PARTITION BY customer_id) AS best FROM fx_flat)
        WHERE sales = best ORDER BY sales DESC, row_id LIMIT 10""",
    "orders_above_average_10": f"""SELECT row_id, order_id, customer_id, product_id, {_double("sales")} FROM fx_flat
        WHERE sales * (SELECT COUNT(sales) FROM fx_flat) > (SELECT SUM(sales) FROM fx_flat)
        ORDER BY fx_flat.sales DESC, row_id LIMIT 10""",
    "customer_totals_10": f"""SELECT customer_id, customer_name, {money("sales")} AS total_sales,
        {money("profit")} AS total_profit, order_count FROM buyer ORDER BY ROUND(sales, 2) DESC, customer_id LIMIT 10""",
    "customers_never_delivered": """SELECT customer_id, customer_name, COUNT(*) AS order_count
        FROM fx_customers JOIN fx_orders USING (customer_id)
        WHERE customer_id NOT IN (SELECT customer_id FROM fx_orders WHERE status = 'DELIVERED' AND customer_id IS NOT NULL)
        GROUP BY customer_id, customer_name""",
    "orders_above_average": f"""SELECT row_id, order_id, customer_id, product_id, {_double("sales")} FROM fx_flat
        WHERE sales * (SELECT COUNT(sales) FROM fx_flat) > (SELECT SUM(sales) FROM fx_flat)""",
    "customers_above_average": f"""SELECT customer_id, customer_name, {money("sales")} AS total_sales FROM buyer
        WHERE sales * (SELECT COUNT(*) FROM buyer) > (SELECT SUM(sales) FROM buyer)""",
    "count_rows": "SELECT COUNT(*) AS total_rows FROM fx_orders",
    "count_distinct_customers": "SELECT COUNT(DISTINCT customer_id) AS customers FROM fx_flat",
    "delivered_revenue": f"""SELECT {money("SUM(total_amount)")} AS total_revenue FROM fx_orders
        WHERE status = 'DELIVERED'""",
    "avg_price_by_category": f"""SELECT category, {average("unit_price")} AS avg_price FROM fx_products
        GROUP BY category""",
    "status_revenue": f"""SELECT status, COUNT(*) AS total_orders, {money("SUM(total_amount)")} AS total_revenue
        FROM fx_orders GROUP BY status""",
    "price_extremes": """SELECT category, CAST(MAX(unit_price) AS DOUBLE) AS most_expensive,
        CAST(MIN(unit_price) AS DOUBLE) AS cheapest FROM fx_products GROUP BY category""",
    "having_avg_price": f"""SELECT category, {average("unit_price")} AS avg_price FROM fx_products
        GROUP BY category HAVING SUM(unit_price) > 2840 * COUNT(unit_price)""",
    "delivered_vs_not": """SELECT COUNT(*) FILTER (status = 'DELIVERED') AS delivered_orders,
        COUNT(*) FILTER (status <> 'DELIVERED') AS not_delivered_orders FROM fx_orders""",
    "price_summary": f"""SELECT COUNT(*) AS total_records, {_double("MIN(price)", "minimum_price")},
        {_double("MAX(price)", "maximum_price")}, {average("price")} AS average_price,
        {money("SUM(price)")} AS total_price FROM fx_transactions""",
    "store_sales": f"""SELECT store_id, COUNT(*) AS transactions, {money("SUM(price)")} AS revenue,
        {average("price")} AS average_price FROM fx_transactions GROUP BY store_id""",
    "category_stats": f"""SELECT category, COUNT(*) AS orders, {average("sales")} AS average_sales,
        {_double("MAX(sales)", "highest_sale")}, {_double("MIN(sales)", "lowest_sale")} FROM fx_sales GROUP BY category""",
    "region_totals": f"SELECT region, {money('SUM(sales)')} AS total_sales FROM fx_sales GROUP BY region",
    "status_totals": f"""SELECT status, COUNT(*) AS order_count, {money("SUM(total_amount)")} AS sum_total_amount
        FROM fx_orders GROUP BY status""",
    "region_west_revenue": f"""SELECT region, COUNT(*) AS orders, {money("SUM(sales)")} AS revenue FROM fx_flat
        WHERE region = 'EUROPE' GROUP BY region""",
    "region_performance": f"""SELECT region, COUNT(*) AS orders, {money("SUM(sales)")} AS revenue,
        {money("SUM(profit)")} AS profit, {average("sales")} AS avg_order_value FROM fx_flat GROUP BY region""",
    "category_performance": f"""SELECT category, {money("SUM(sales)")} AS revenue,
        CAST(SUM(quantity) AS BIGINT) AS quantity_sold, {average("profit")} AS avg_profit FROM fx_flat GROUP BY category""",
    "segment_performance": f"""SELECT segment, {money("SUM(sales)")} AS revenue, {money("SUM(profit)")} AS profit
        FROM fx_flat GROUP BY segment""",
    "yearly_growth": f"""SELECT CAST(year(strptime(order_date, '%m/%d/%Y')) AS INTEGER) AS year,
        {money("SUM(sales)")} AS revenue, {money("SUM(profit)")} AS profit, COUNT(DISTINCT order_id) AS orders
        FROM fx_flat GROUP BY 1""",
    "monthly_sales": f"""SELECT CAST(year(strptime(order_date, '%m/%d/%Y')) AS INTEGER) AS year,
        CAST(month(strptime(order_date, '%m/%d/%Y')) AS INTEGER) AS month, {money("SUM(sales)")} AS monthly_sales
        FROM fx_flat GROUP BY 1, 2""",
    "loss_subcategories": f"""SELECT category, sub_category, COUNT(*) AS loss_rows, {money("SUM(profit)")} AS total_loss
        FROM fx_flat WHERE profit < 0 GROUP BY category, sub_category""",
    "duplicate_keys": """SELECT order_id, COUNT(*) AS duplicate_count FROM fx_flat GROUP BY order_id
        HAVING COUNT(*) > 1""",
    "customer_totals": f"""SELECT customer_id, customer_name, {money("sales")} AS total_sales,
        {money("profit")} AS total_profit, order_count FROM buyer""",
    "single_order_customers": f"""SELECT customer_id || '-' || right(order_date, 4) AS customer_id,
        MIN(customer_name) AS customer_name, COUNT(DISTINCT order_id) AS order_count, {money("SUM(sales)")} AS total_sales
        FROM fx_flat GROUP BY fx_flat.customer_id, right(order_date, 4) HAVING COUNT(DISTINCT order_id) = 1""",
    "revenue_by_category": f"""SELECT category, {money("SUM(net_revenue)")} AS net_revenue FROM fx_revenue
        GROUP BY category""",
    "returns_exceed_purchases": """SELECT * FROM (SELECT product_id, product_name, category,
        CAST(SUM(CASE WHEN quantity < 0 THEN -quantity ELSE 0 END) AS BIGINT) AS returned_units,
        CAST(SUM(CASE WHEN quantity > 0 THEN quantity ELSE 0 END) AS BIGINT) AS purchased_units
        FROM fx_revenue GROUP BY product_id, product_name, category) WHERE returned_units > purchased_units""",
    "return_rate": f"""SELECT category, {ratio("SUM(CASE WHEN quantity < 0 THEN -quantity ELSE 0 END)",
        "SUM(ABS(quantity))", 4)} AS return_rate FROM fx_revenue GROUP BY category""",
    "mart_sales_summary": _mart(
        _TO_PRODUCT, "product_id, product_name, category", "COUNT(*) AS total_orders",
        "CAST(SUM(quantity) AS BIGINT) AS total_quantity_sold", f"{money('SUM(total_amount)')} AS total_revenue",
        f"{average('total_amount')} AS avg_order_value"),
    "mart_customer_summary": _customer_mart("fx_lake_orders", "masked_raw"),
    "lake_gold_customers": _customer_mart("good_lake_orders", "masked_clean"),
    "lake_gold_categories": _mart(
        "JOIN good_lake_products p USING (product_id)", "category", "COUNT(*) AS total_orders",
        "CAST(SUM(quantity) AS BIGINT) AS total_units_sold", f"{money('SUM(total_amount)')} AS total_revenue", orders="good_lake_orders"),
    "lake_gold_category_revenue": _mart("JOIN good_lake_products p USING (product_id)", "category",
                                        f"{money('SUM(total_amount)')} AS category_revenue", orders="good_lake_orders"),
    "lake_gold_monthly": f"""SELECT strftime(order_date, '%Y-%m') AS order_month,
        {money("SUM(total_amount)")} AS monthly_revenue FROM good_lake_orders GROUP BY 1""",
    "lake_silver_payments": f"""SELECT DISTINCT payment_id, order_id, '************' || right(card_number, 4) AS card_number,
        {_double("amount")}, CAST(TRY_CAST(paid AS DATE) AS VARCHAR) AS payment_date, payment_status, {_bucket("amount")}
        FROM fx_payments_dirty""",
    "append_rejects": f"""SELECT * FROM (WITH batch AS (
            SELECT s.* FROM fx_source s, range(2)
            UNION ALL SELECT * REPLACE (NULL AS order_id) FROM fx_source WHERE order_id % 50 = 0
            UNION ALL SELECT * REPLACE (-1 AS customer_id) FROM fx_source WHERE order_id % 90 = 1
            UNION ALL SELECT * REPLACE (CAST(total_amount + 5 AS DECIMAL(12,2)) AS total_amount) FROM fx_source WHERE order_id % 70 = 3),
        told AS (SELECT *, CASE WHEN order_id IS NULL THEN 'missing_key'
                WHEN customer_id NOT IN (SELECT customer_id FROM fx_customers) THEN 'unknown_customer_id'
                WHEN order_id IN (SELECT order_id FROM fx_target) THEN 'known_key' END AS reject_reason FROM batch),
        numbered AS (SELECT *, row_number() OVER (PARTITION BY order_id, reject_reason ORDER BY order_code, customer_id NULLS FIRST,
                order_date, status, total_amount) AS place FROM told)
        SELECT {CODED_ORDER}, coalesce(reject_reason, 'repeated_key') AS reject_reason, COUNT(*) AS copies FROM numbered
        WHERE reject_reason IS NOT NULL OR place > 1 GROUP BY ALL)""",
    "replaced_table": f"SELECT {CLEAN_ORDER} FROM fx_orders WHERE status <> 'CANCELLED'",
    "checked_scan": f"""SELECT order_id, CAST(customer_id AS VARCHAR) AS customer_id, CAST(product_id AS VARCHAR) AS product_id, quantity,
        {_double("unit_price")}, {_double("total_amount")}, order_date, status, payment_method
        FROM fx_lake_order_lines WHERE reject_reasons = ''""",
    "checked_scan_rejects": """SELECT order_id, CAST(customer_id AS VARCHAR) AS customer_id, CAST(product_id AS VARCHAR) AS product_id,
        quantity_text AS quantity, price_text AS unit_price, amount_text AS total_amount, order_date, nullif(status_text, '') AS status,
        CASE WHEN product_id % 200 <> 36 THEN payment_method END AS payment_method,
        CASE WHEN product_id % 200 IN (36, 37) THEN concat_ws(',', order_id, coalesce(CAST(customer_id AS VARCHAR), ''), product_id,
            quantity_text, price_text, amount_text, order_date, status_text, CASE WHEN product_id % 200 = 37
            THEN payment_method || ',more' END) END AS _corrupt_record, reject_reasons
        FROM fx_lake_order_lines WHERE reject_reasons <> ''""",
    "clean_store_report": " UNION ALL ".join((
        _violations("customers", "unique", "customer_id", "0"),
        *_not_null("customers", "(SELECT DISTINCT * FROM fx_customers_dirty)", "customer_id customer_name email registration_date"),
        *(_violations("customers", kind, name, "0") for kind, name in (
            ("not_null", "customer_type"), ("not_null", "email_valid"), ("check", "email_flag"))),
        _violations("customers", "not_null", "region_code", "0"),
        *(_violations("products", kind, name, "0") for kind, name in (
            ("unique", "product_id"), ("check", "positive_cost"), *(("not_null", c) for c in (
                "product_id", "product_name", "category", "subcategory", "cost_price")))),
        _violations("orders", "unique", "order_id", _repeated("good_orders", "order_id")),
        *_not_null("orders", "good_orders", "order_id order_date status region_code is_guest"),
        _violations("orders", "check", "known_status", _bad(
            "good_orders", "status NOT IN ('DELIVERED', 'SHIPPED', 'PLACED', 'CANCELLED', 'RETURNED')")),
        _violations("orders", "check", "guest_flag", _bad("good_orders", "is_guest NOT IN (0, 1)")),
        _violations("orders", "foreign_key", "customer_id", _bad(
            "good_orders", "customer_id NOT IN (SELECT CAST(customer_id AS VARCHAR) FROM fx_customers)")),
        *(_violations("order_items", kind, name, "0") for kind, name in (
            ("unique", "item_id"), ("check", "moved_units"), ("check", "positive_price"), ("check", "discount_range"),
            ("foreign_key", "order_id"), ("foreign_key", "product_id"), *(("not_null", c) for c in (
                "item_id", "order_id", "product_id", "quantity", "unit_price", "discount_percent")))))),
    "remove_duplicates": f"SELECT {CODED_ORDER} FROM fx_target",
    "incremental_load": f"SELECT {CODED_ORDER} FROM fx_merged",
    "mart_product_summary": _mart(
        _TO_PRODUCT, "category", "COUNT(*) AS total_orders", "CAST(SUM(quantity) AS BIGINT) AS total_units_sold",
        f"{money('SUM(total_amount)')} AS total_revenue"),
    "mart_category_revenue": _mart(_TO_PRODUCT, "category", f"{money('SUM(total_amount)')} AS category_revenue"),
    "mart_monthly_revenue": f"""SELECT strftime(order_date, '%Y-%m') AS order_month,
        {money("SUM(total_amount)")} AS monthly_revenue FROM fx_lake_orders GROUP BY 1""",
    "describe_numeric": _describe(["sales", "quantity", "discount", "profit", "total_amount"]),
    "cohort_retention": f"""SELECT reg_month, total_users, {", ".join(
        f"{ratio(f'COALESCE(a{m}, 0) * 100', 'total_users')} AS month_{m}_pct" for m in range(4))}
        FROM (SELECT strftime(registration_date, '%Y-%m') AS reg_month, COUNT(*) AS total_users
              FROM fx_customers GROUP BY 1)
        LEFT JOIN (SELECT reg_month, {", ".join(
            f"COUNT(DISTINCT customer_id) FILTER (step = {m}) AS a{m}" for m in range(4))}
            FROM (SELECT c.customer_id, strftime(registration_date, '%Y-%m') AS reg_month,
                         date_diff('month', registration_date, order_date) AS step
                  FROM fx_customers c JOIN fx_orders o ON o.customer_id = c.customer_id WHERE status <> 'CANCELLED')
            GROUP BY reg_month) USING (reg_month)""",
    "period_breakdown_daily": _breakdown("CAST(order_date AS VARCHAR)"),
    "period_breakdown_weekly": _breakdown("strftime(order_date, '%Y-%W')"),
    "period_breakdown_monthly": _breakdown("strftime(order_date, '%Y-%m')"),
    "period_comparison": f"""SELECT metric, "current", previous,
        CASE WHEN previous = 0 THEN 'n/a' ELSE CAST(ROUND(("current" - previous) * 100 / previous, 2) AS VARCHAR) || '%'
        END AS change,
        CASE WHEN previous <> 0 THEN ROUND(("current" - previous) * 100 / previous, 2) END AS change_pct
        FROM (SELECT unnest(['orders', 'revenue', 'unique_customers']) AS metric,
                     unnest([CAST(o1 AS DOUBLE), r1, c1]) AS "current", unnest([CAST(o0 AS DOUBLE), r0, c0]) AS previous
              FROM (SELECT COUNT(DISTINCT order_id) AS o1, COALESCE({money("SUM(net_revenue)")}, 0) AS r1,
                           COUNT(DISTINCT customer_id) AS c1 FROM fx_revenue WHERE {IN_PERIOD}),
                   (SELECT COUNT(DISTINCT order_id) AS o0, COALESCE({money("SUM(net_revenue)")}, 0) AS r0,
                           COUNT(DISTINCT customer_id) AS c0 FROM fx_revenue
                    WHERE order_date BETWEEN DATE '1997-07-04' AND DATE '1997-12-31'))""",
    "customer_row_number_rank": f"""SELECT customer_id, customer_name, {money("sales")} AS total_sales,
        {money("profit")} AS total_profit, row_number() OVER (ORDER BY sales DESC, customer_id) AS row_no,
        rank() OVER (ORDER BY sales DESC) AS rank_no FROM buyer""",
    "top_customers_ranked": f"""SELECT customer_id, customer_name, region, {money("sales")} AS total_sales, rank_no
        FROM (SELECT *, CAST(rank() OVER (ORDER BY sales DESC) AS INTEGER) AS rank_no FROM buyer) WHERE rank_no <= 10""",
    "bottom_customers_ranked": f"""SELECT customer_id, customer_name, {money("sales")} AS total_sales, low_rank
        FROM (SELECT *, CAST(rank() OVER (ORDER BY sales NULLS FIRST) AS INTEGER) AS low_rank FROM buyer) WHERE low_rank <= 10""",
    "customer_overall_rank": f"""SELECT customer_id, customer_name, segment, region, {money("sales")} AS total_sales,
        {money("profit")} AS total_profit, CAST(rank() OVER (ORDER BY sales DESC) AS INTEGER) AS overall_rank FROM buyer
        ORDER BY sales DESC, customer_id LIMIT 20""",
    "split_customers": "SELECT * FROM people",
    "running_revenue_by_region": f"""SELECT region_code, {_iso("day", "order_day")}, {money("MAX(own)")} AS daily_revenue,
        {money("SUM(earlier.net)")} AS running_revenue
        FROM (SELECT region_code, order_day AS day, SUM(net_revenue) AS own FROM fx_revenue GROUP BY ALL)
        JOIN (SELECT region_code, order_day AS past, SUM(net_revenue) AS net FROM fx_revenue GROUP BY ALL) earlier
            USING (region_code)
        WHERE past <= day GROUP BY region_code, day""",
    "product_rank_in_category": f"""SELECT category, product_id, product_name, {money("net")} AS total_revenue,
        dense_rank() OVER (PARTITION BY category ORDER BY net DESC, product_id) AS revenue_rank
        FROM (SELECT category, product_id, product_name, SUM(net_revenue) AS net FROM fx_revenue GROUP BY ALL)""",
    "customer_risk": f"""SELECT customer_id, order_id, {_iso("order_date")}, CAST(gap AS INTEGER) AS days_since_previous,
        CASE WHEN COUNT(gap) OVER everything = 0 THEN 'Insufficient Data'
             WHEN SUM(gap) OVER everything > 30 * COUNT(gap) OVER everything THEN 'At Risk' ELSE 'Active' END
            AS risk_status
        FROM (SELECT customer_id, order_id, order_date,
                     order_date - lag(order_date) OVER (PARTITION BY customer_id ORDER BY order_date, order_id) AS gap
              FROM fx_orders WHERE customer_id IS NOT NULL)
        WINDOW everything AS (PARTITION BY customer_id)""",
    "monthly_customer_buckets": """SELECT order_month,
        CASE WHEN net > 600000 THEN 'High' WHEN net >= 300000 THEN 'Medium' ELSE 'Low' END AS revenue_bucket,
        COUNT(*) AS customer_count
        FROM (SELECT order_month, customer_id, SUM(net_revenue) AS net FROM fx_revenue
              WHERE customer_id IS NOT NULL GROUP BY ALL) GROUP BY 1, 2""",
    "ltv_quartiles": f"""SELECT customer_id, {money("net")} AS total_value,
        ['Platinum', 'Gold', 'Silver', 'Bronze'][ntile(4) OVER (ORDER BY net DESC, customer_id)] AS ltv_segment
        FROM (SELECT customer_id, SUM(net_revenue) AS net FROM fx_revenue WHERE customer_id IS NOT NULL GROUP BY ALL)""",
    "yoy_growth": _yoy(_MONTHS),
    "yoy_growth_dense": _yoy(_DENSE),
    "category_shift": """SELECT customer_id, bought[1].category AS first_category, bought[-1].category AS last_category,
        if(bought[1].category IS DISTINCT FROM bought[-1].category, 'Yes', 'No') AS category_shift
        FROM (SELECT customer_id, list({'day': order_date, 'item': item_id, 'category': category}
                                       ORDER BY order_date, item_id) AS bought
              FROM fx_revenue WHERE quantity > 0 GROUP BY customer_id)
        WHERE customer_id IS NOT NULL""",
    "pareto_customers": f"""SELECT customer_id, {money("net")} AS revenue,
        {ratio("place * 100", "everyone")} AS customer_percentile, {ratio("so_far * 100", "everything")}
            AS cumulative_revenue_pct
        FROM (SELECT customer_id, net, row_number() OVER best AS place, COUNT(*) OVER () AS everyone,
                     SUM(net) OVER best AS so_far, SUM(net) OVER () AS everything
              FROM (SELECT customer_id, SUM(net_revenue) AS net FROM fx_revenue WHERE customer_id IS NOT NULL
                    GROUP BY customer_id HAVING SUM(net_revenue) > 0)
              WINDOW best AS (ORDER BY net DESC, customer_id ROWS UNBOUNDED PRECEDING))""",
    "top_expensive_lines": f"""SELECT row_id, product_name, {_double("f.sales")}, {_double("discount")},
        {money("profit")} AS profit FROM fx_flat f WHERE category = 'PROMO' AND f.sales > 1000
        ORDER BY f.sales DESC, row_id LIMIT 10""",
    "top_products": f"""SELECT product_name, {money("SUM(sales)")} AS revenue, CAST(SUM(quantity) AS BIGINT) AS quantity
        FROM fx_flat GROUP BY product_name ORDER BY SUM(sales) DESC, product_name LIMIT 10""",
    "top_customers": f"""SELECT customer_name, COUNT(DISTINCT order_id) AS orders, {money("SUM(sales)")} AS revenue,
        {money("SUM(profit)")} AS profit FROM fx_flat GROUP BY customer_name
        ORDER BY SUM(sales) DESC, customer_name LIMIT 10""",
    "bottom_products": f"""SELECT product_name, {money("SUM(profit)")} AS total_loss FROM fx_flat GROUP BY product_name
        ORDER BY ROUND(SUM(profit), 2), product_name LIMIT 10""",
    "top_revenue_customers": f"""SELECT customer_id, {money("SUM(net_revenue)")} AS net_revenue FROM fx_revenue
        WHERE customer_id IS NOT NULL GROUP BY customer_id ORDER BY ROUND(SUM(net_revenue), 2) DESC, customer_id LIMIT 10""",
    "last_12_months": f"""SELECT order_month AS ym, {money("SUM(net_revenue)")} AS net_revenue FROM fx_revenue
        GROUP BY order_month ORDER BY order_month DESC LIMIT 12""",
    "period_top_products": f"""SELECT product_id, product_name, {money("SUM(net_revenue)")} AS revenue FROM fx_revenue
        WHERE {IN_PERIOD} GROUP BY product_id, product_name ORDER BY ROUND(SUM(net_revenue), 2) DESC, product_id LIMIT 3""",
    "table_row_counts": " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {t}" for n, t in (
            ("customers", "fx_customers"), ("products", "fx_products"), ("orders", "fx_orders"),
            ("order_items", "fx_items"))),
    "split_products": "SELECT DISTINCT product_id, product_name, category, sub_category FROM fx_flat",
    "dedupe_by_key": f"""SELECT {SALE} FROM (SELECT *, row_number() OVER (
        PARTITION BY order_id, region ORDER BY order_date, row_id) AS place FROM fx_sales) WHERE place = 1""",
    "clean_customers": f"""SELECT customer_id, customer_name, email, phone, {_iso("dob")}, {_iso("registration_date")},
        {_iso("signup_date")}, address, city, state, segment, region, customer_type FROM good_customers""",
    "clean_products": f"""SELECT product_id, product_name, category, subcategory, {_double("cost_price")}
        FROM good_products""",
    "clean_orders": f"""SELECT order_id, customer_id, {_iso("order_date")}, status, region_code, is_guest
        FROM good_orders""",
    "clean_order_items": f"""SELECT item_id, order_id, product_id,
        {", ".join(f"CAST(CAST(trim({c}) AS DECIMAL(38,15)) AS DOUBLE) AS {c}" for c in ITEM_NUMBERS)}
        FROM judged_items WHERE place = 1 AND reject_reason IS NULL""",
    "quarantine_order_items": """SELECT item_id, order_id, product_id, quantity, unit_price,
        discount_percent, reject_reason, 1 AS copies FROM judged_items
        WHERE place = 1 AND reject_reason IS NOT NULL
        UNION ALL SELECT item_id, order_id, product_id, quantity, unit_price, discount_percent,
        'duplicate', copies - CAST(place = 1 AS INTEGER) FROM judged_items WHERE copies > 1 OR place > 1""",
    "flag_email_valid": f"""SELECT customer_id, titled AS customer_name, email, phone, {_iso("dob")},
        {_iso("registration_date")}, {_iso("signup_date")}, address, city, state, segment, region, customer_type,
        COALESCE(CAST(email LIKE '%@%' AND contains(string_split(email, '@')[-1], '.') AS INTEGER), 0) AS email_valid
        FROM (SELECT DISTINCT *, {_capitals("customer_name")} AS titled FROM fx_customers_dirty)""",
    "fill_defaults": f"""SELECT product_id, title, category, {_double("rating")}, ratings_count,
        {_double("initial_price")}, {_double("discount")}, COALESCE(seller_name, 'Unknown') AS seller_name,
        COALESCE(seller_information, 'Unknown') AS seller_information, COALESCE(videos, 'No Video') AS videos,
        COALESCE(variations, 'No Variants') AS variations,
        COALESCE(what_customers_said, 'No comments') AS what_customers_said,
        CAST(variations IS NOT NULL AS INTEGER) AS has_variations FROM fx_catalogue""",
    "drop_incomplete": f"SELECT {SALE} FROM fx_sales WHERE customer_name IS NOT NULL AND sales IS NOT NULL",
    "catalogue_clean": f"""SELECT DISTINCT product_id, title, category, {_double("rating")}, ratings_count,
        {_double("initial_price")}, COALESCE(CAST(discount AS DOUBLE), 0) AS discount,
        COALESCE(seller_name, 'Unknown') AS seller_name,
        COALESCE(seller_information, 'Unknown') AS seller_information, COALESCE(videos, 'No Video') AS videos,
        COALESCE(variations, 'No Variants') AS variations,
        COALESCE(what_customers_said, 'No comments') AS what_customers_said,
        CAST(variations IS NOT NULL AS INTEGER) AS has_variations,
        {money("initial_price * ((100 - COALESCE(discount, 0)) * CAST(0.01 AS DECIMAL(3,2)))")} AS calculated_final_price
        FROM fx_catalogue""",
    "high_rated": f"""SELECT product_id, title, category, {_double("rating")}, {_double("initial_price")},
        {_double("discount")} FROM fx_catalogue WHERE rating > 4 AND ratings_count > 70""",
    "store_sales_pipeline": f"""SELECT store_id, COUNT(*) AS transactions, {money("SUM(price)")} AS revenue,
        {average("price")} AS average_price, {_double("MIN(price)", "minimum_price")},
        {_double("MAX(price)", "maximum_price")}
        FROM (SELECT store_id, COALESCE(price, 0) AS price, region, row_number() OVER (
                  PARTITION BY user_id, transaction_date ORDER BY transaction_id) AS place FROM fx_transactions)
        WHERE place = 1 AND region = 'WEST' GROUP BY store_id""",
    "region_category_pipeline": f"""SELECT region, category, {money("SUM(net)")} AS total_sales
        FROM (SELECT region, category, ROUND(COALESCE(sales, 0) * ((100 - COALESCE(discount, 0))
                                             * CAST(0.01 AS DECIMAL(3,2))), 2) AS net
              FROM fx_sales WHERE quantity >= 5) GROUP BY region, category""",
    "null_counts": _nulls("fx_flat", FLAT),
    "duplicate_report": """SELECT COUNT(*) AS total, (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM fx_orders_dirty))
        AS distinct_rows, COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM fx_orders_dirty)) AS exact_duplicates,
        COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT order_id FROM fx_orders_dirty)) AS duplicate_keys
        FROM fx_orders_dirty""",
    "quality_summary": " UNION ALL ".join((
        _quality("customers", "fx_customers_dirty", ["email", "phone"]),
        _quality("products", "fx_products_dirty", ["product_name"]),
        _quality("orders", "fx_orders_dirty", ["customer_id"]),
        _quality("order_items", "fx_items_dirty", ["order_id"]))),
    "rule_violations": f"""SELECT 'negative_price' AS rule, ({_bad("fx_products_dirty",
        "TRY_CAST(cost_price AS DECIMAL(10,2)) < 0")}) AS violations
        UNION ALL SELECT 'non_positive_quantity', ({_bad("fx_items_typed", "quantity <= 0")})
        UNION ALL SELECT 'malformed_email', ({_bad("fx_customers", "email NOT LIKE '%@%'")})
        UNION ALL SELECT 'future_signup', ({_bad("fx_customers", "signup_date > DATE '2000-12-31'")})""",
    "referential_violations": """SELECT 'orders_without_customer' AS "check", COUNT(*) AS violations FROM fx_orders o
        WHERE NOT EXISTS (SELECT 1 FROM fx_customers c WHERE c.customer_id = o.customer_id)
        UNION ALL SELECT 'items_without_product', COUNT(*) FROM fx_items_dirty i
        WHERE NOT EXISTS (SELECT 1 FROM fx_products p WHERE p.product_id = i.product_id)
        UNION ALL SELECT 'items_without_order', COUNT(*) FROM fx_items_dirty i
        WHERE NOT EXISTS (SELECT 1 FROM fx_orders o WHERE o.order_id = i.order_id)""",
    "constraint_report": " UNION ALL ".join((
        _violations("customers", "unique", "customer_id", _repeated("fx_customers", "customer_id")),
        _violations("customers", "unique", "email", _repeated("fx_customers", "email")),
        _violations("customers", "not_null", "customer_name", _bad("fx_customers", "customer_name IS NULL")),
        _violations("customers", "not_null", "email", _bad("fx_customers", "email IS NULL")),
        _violations("products", "unique", "product_id", _repeated("fx_products_dirty", "product_id")),
        _violations("products", "not_null", "cost_price",
                    _bad("fx_products_dirty", "TRY_CAST(cost_price AS DECIMAL(12,2)) IS NULL")),
        _violations("products", "check", "positive_cost",
                    _bad("fx_products_dirty", "TRY_CAST(cost_price AS DECIMAL(12,2)) <= 0")),
        _violations("orders", "unique", "order_id", _repeated("fx_orders_dirty", "order_id")),
        _violations("orders", "check", "known_status", _bad("fx_orders_dirty", "status = 'RETURNED'")),
        _violations("order_items", "unique", "item_id", _repeated("fx_items_dirty", "item_id")),
        _violations("order_items", "not_null", "quantity", _bad("fx_items_typed", "quantity IS NULL")),
        _violations("order_items", "check", "moved_units", _bad("fx_items_typed", "quantity = 0")),
        _violations("order_items", "check", "discount_range", _bad("fx_items_typed", "discount_percent NOT BETWEEN 0 AND 100")),
        _violations("order_items", "foreign_key", "order_id",
                    "SELECT COUNT(*) FROM fx_items_dirty i ANTI JOIN fx_orders o USING (order_id)"),
        _violations("order_items", "foreign_key", "product_id",
                    "SELECT COUNT(*) FROM fx_items_dirty i ANTI JOIN fx_products p USING (product_id)"))),
    "mask_customers": f"""SELECT * REPLACE (CAST(signup_date AS VARCHAR) AS signup_date), {AGE_BAND} AS age_band
        FROM masked_clean""",
    "tokenize_orders": f"""SELECT order_id, product_id, quantity, {_double("unit_price")}, {_double("total_amount")},
        {_iso("order_date")}, status, payment_method, sha256(CAST(customer_id AS VARCHAR)) AS customer_token
        FROM fx_lake_orders""",
    "lake_orders_clean": f"""SELECT order_id, customer_id, product_id, quantity, {_double("unit_price")},
        {_double("total_amount")}, {_iso("order_date")}, status, payment_method FROM good_lake_orders""",
    "lake_products_clean": "SELECT * FROM good_lake_products",
    "payments_clean": f"""SELECT DISTINCT payment_id, order_id, card_number, cvv, {_double("amount")},
        CAST(TRY_CAST(paid AS DATE) AS VARCHAR) AS payment_date, payment_status FROM fx_payments_dirty""",
    "lake_gold_sales": f"""SELECT product_id, product_name, category, COUNT(*) AS total_orders,
        CAST(SUM(quantity) AS BIGINT) AS total_quantity_sold, {money('SUM(total_amount)')} AS total_revenue,
        {average('total_amount')} AS avg_order_value
        FROM good_lake_orders JOIN good_lake_products USING (product_id) GROUP BY product_id, product_name, category""",
    "mask_payments": f"""SELECT payment_id, order_id, '************' || right(card_number, 4) AS card_number,
        {_double("amount")}, {_iso("payment_date")}, payment_status, {_bucket("amount")} FROM fx_payments""",
    "upsert": f"SELECT {CODED_ORDER} FROM fx_merged",
    "upsert_partitioned": f"""SELECT {CODED_ORDER},
        CASE WHEN month(order_date) <> 10 THEN strftime(order_date, '%Y-%m') END AS order_month FROM fx_merged""",
    "append_checked": f"""SELECT {CODED_ORDER} FROM (SELECT * FROM fx_target UNION ALL
        SELECT s.* FROM fx_source s ANTI JOIN fx_target t USING (order_id))""",
    "upsert_counts": """SELECT COUNT(*) FILTER (t.order_id IS NOT NULL) AS rows_to_update,
        COUNT(*) FILTER (t.order_id IS NULL) AS rows_to_insert FROM fx_source s LEFT JOIN fx_target t USING (order_id)""",
    "incremental_report": VALIDATION,
    "upsert_validation": VALIDATION,
    "conditional_update": "SELECT " + ", ".join(
        "COALESCE(postal_code, '0') AS postal_code" if c == "postal_code" else _double(c) if c in FLAT_MONEY else c
        for c in FLAT) + " FROM fx_flat",
    "apply_stock_deltas": f"""SELECT product_id, product_name, category, subcategory, {_double("cost_price")},
        {_double("unit_price")}, CAST(stock_qty - COALESCE(taken, 0) AS BIGINT) AS stock_qty
        FROM fx_products LEFT JOIN (SELECT product_id, SUM(quantity) AS taken FROM fx_items GROUP BY product_id)
        USING (product_id)""",
}


def _needed(sql: str) -> list[str]:
    """Views that `sql` mentions, each after the views it needs itself."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\w+", text):
            if name in VIEWS and name not in order:
                visit(VIEWS[name])
                if name not in order:
                    order.append(name)
    visit(sql)
    return order


def statements() -> dict[str, str]:
    """One statement per query."""
    result = {}
    for name, sql in QUERIES.items():
        views = ",\n".join(f"{v} AS ({VIEWS[v]})" for v in _needed(sql))
        result[name] = f"WITH {views}\n{sql}"
    return result

"""Independent SQL for every registered query, over the same sample tables.

Each entry is a list of output columns with a kind (i integer, d number,
s text) and a body; common parts are named queries put in front.
"""

from __future__ import annotations

import re

# --- building blocks ---------------------------------------------------------

CAST = {"i": "BIGINT", "d": "DOUBLE", "s": "VARCHAR"}


def rounded(expression: str, digits: int, noise: int = 10) -> str:
    """Half-up rounding of a double whose digits beyond ``noise`` are binary noise."""
    return f"CAST(round(CAST({expression} AS DECIMAL(38,{noise})), {digits}) AS DOUBLE)"


def ratio(top: str, bottom: str) -> str:
    return f"CAST({top} AS DOUBLE) / nullif(CAST({bottom} AS DOUBLE), 0)"


def pct(top: str, bottom: str, digits: int = 2) -> str:
    return rounded(f"CAST({top} AS DOUBLE) * 100 / nullif(CAST({bottom} AS DOUBLE), 0)", digits, 12)


def mean(column: str, digits: int = 6) -> str:
    return rounded(f"CAST(sum({column}) AS DOUBLE) / count({column})", digits)


def growth(now: str, before: str) -> str:
    return rounded(f"CAST({now} - {before} AS DOUBLE) / nullif(CAST({before} AS DOUBLE), 0)", 4, 12)


def in_list(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


TEXT_COLUMNS = (
    "order_item_id order_id product_id quantity customer_id order_date total_amount "
    "name city email signup_date product_name category price"
).split()
NULLS = ("", "null", "NULL", "None", "none", "N/A", "n/a", "NA", "#N/A", "nan", "NaN")
CSV_NULLS = NULLS[:1] + (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
EMAIL = r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$"
SPLIT = "DATE '1999-06-15'"
SPLIT_KEY = 19990615
AS_OF = "DATE '2001-09-01'"


def nulled(column: str, tokens) -> str:
    return f"CASE WHEN {column} IN {in_list(tokens)} THEN NULL ELSE {column} END"


def title(column: str) -> str:
    runs = rf"regexp_extract_all(lower({column}), '(\p{{L}}+|[^\p{{L}}]+)')"
    return f"array_to_string(list_transform({runs}, lambda r : upper(r[1]) || r[2:]), '')"


def band(price: str) -> str:
    return (
        f"CASE WHEN {price} >= 0 AND {price} < 500 THEN 'Budget' WHEN {price} >= 500 AND {price} < 2000 THEN 'Mid-Range' "
        f"WHEN {price} >= 2000 AND {price} < 4000 THEN 'Premium' WHEN {price} >= 4000 THEN 'Luxury' ELSE 'Unknown' END"
    )


def segment(value: str, orders: str) -> str:
    return (
        f"CASE WHEN {value} >= 2000000 OR {orders} >= 15 THEN 'High Value' WHEN {value} >= 800000 OR {orders} >= 10 "
        f"THEN 'Regular' WHEN {orders} = 1 THEN 'New' ELSE 'Developing' END"
    )


def date_key(day: str) -> str:
    return f"(year({day}) * 10000 + month({day}) * 100 + day({day}))"


PARTS: dict[str, str] = {}
PARTS["l0"] = """
SELECT (l_orderkey * 8 + l_linenumber) * 1048576 + (l_partkey * 31 + l_suppkey) % 1048576 AS order_item_id,
       l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
       CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, CAST(round(l_discount * 100) AS BIGINT) AS discount
FROM lineitem"""
PARTS["lines"] = """
SELECT l0.order_item_id, l0.order_id, l0.product_id, l0.quantity, o_custkey AS customer_id,
       CAST(o_orderdate AS DATE) AS order_date,
       CAST(((cents * (100 - discount) + 50) // 100) / 100.0 AS DECIMAL(18,2)) AS total_amount,
       c_name AS name, n_name AS city, lower(replace(c_name, '#', '.')) || '@example.com' AS email,
       DATE '1994-01-01' + CAST(o_custkey % 730 AS INTEGER) AS signup_date,
       p_name AS product_name, p_type AS category,
       CAST(((2 * cents + quantity) // (2 * quantity)) / 100.0 AS DECIMAL(18,2)) AS price,
       CAST(o_orderpriority[1] AS BIGINT) AS channel_sk, n_nationkey + 1 AS geography_sk, r_name AS region
FROM l0 JOIN orders ON order_id = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN part ON product_id = p_partkey"""
_MEASURES = f"""
       CAST(quantity * price AS DECIMAL(18,2)) AS gross_revenue, total_amount AS net_revenue,
       CAST(greatest(quantity * price - total_amount, 0) AS DECIMAL(18,2)) AS discount_amount,
       CASE WHEN quantity * price > 0 THEN {rounded("CAST(greatest(quantity * price - total_amount, 0) AS DOUBLE) / CAST(quantity * price AS DOUBLE)", 4)} ELSE 0 END AS discount_pct,
       greatest(order_date - signup_date, 0) AS customer_tenure_days,
       year(order_date) AS order_year, month(order_date) AS order_month, {band("price")} AS price_band"""
PARTS["clean"] = f"SELECT *, {_MEASURES} FROM lines"
PARTS["fact"] = f"""
SELECT *, {date_key("order_date")} AS order_date_key, strftime(order_date, '%Y-%m') AS year_month,
       year(order_date) AS year_number, month(order_date) AS month_number, monthname(order_date) AS month_name,
       'Q' || quarter(order_date) AS quarter_name, year(order_date) || '-Q' || quarter(order_date) AS year_quarter
FROM clean"""
PARTS["dimp"] = f"""
SELECT product_id, row_number() OVER (ORDER BY product_id) AS product_sk, product_name, category, price AS unit_price, {band("price")} AS price_band
FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY order_date DESC, order_item_id DESC) AS rn FROM lines) WHERE rn = 1"""
PARTS["dimc"] = f"""
SELECT *, row_number() OVER (ORDER BY customer_id) AS customer_sk, {segment("total_lifetime_value", "total_orders")} AS customer_segment
FROM (SELECT customer_id, any_value(name) AS customer_name, any_value(email) AS email, any_value(city) AS city,
             any_value(signup_date) AS signup_date, count(DISTINCT order_id) AS total_orders, sum(net_revenue) AS total_lifetime_value
      FROM clean GROUP BY customer_id)"""
PARTS["channel"] = """
SELECT * FROM (VALUES (1, 'Online Store', 'Direct'), (2, 'Mobile App', 'Direct'), (3, 'Email Campaign', 'Direct'),
 (4, 'Social Media', 'Organic'), (5, 'Search (SEO)', 'Organic'), (6, 'Paid Search', 'Partner'), (7, 'Unknown', 'Unknown'))
 AS t(channel_sk, channel_name, channel_type)"""
PARTS["activity"] = f"""
SELECT customer_id, any_value(name) AS customer_name, any_value(email) AS email, any_value(city) AS city,
       any_value(signup_date) AS signup_date, count(DISTINCT order_id) AS total_orders, sum(quantity) AS total_items_bought,
       sum(net_revenue) AS lifetime_value, {mean("net_revenue")} AS avg_order_value,
       min(order_date) AS first_order_date, max(order_date) AS last_order_date
FROM fact GROUP BY customer_id"""
PARTS["monthly"] = f"""
SELECT year_month AS year_month_key, product_id, sum(quantity) AS total_units_sold, count(DISTINCT order_id) AS total_orders,
       sum(gross_revenue) AS total_gross_revenue, sum(net_revenue) AS total_net_revenue, {mean("price", 2)} AS avg_unit_price,
       {mean("net_revenue", 2)} AS avg_order_value, count(DISTINCT customer_id) AS total_customers
FROM fact GROUP BY 1, 2"""
PARTS["by_month"] = """
SELECT year_month, year_number, month_number, sum(net_revenue) AS net_revenue, count(DISTINCT order_date) AS active_days
FROM fact GROUP BY 1, 2, 3"""

# --- damaged text ------------------------------------------------------------

PARTS["dirty"] = """
SELECT CASE WHEN i % 101 = 0 THEN '' ELSE CAST(i AS VARCHAR) END AS order_item_id, CAST(order_id AS VARCHAR) AS order_id,
  CASE WHEN i % 107 = 0 THEN 'abc' ELSE CAST(product_id AS VARCHAR) END AS product_id,
  CASE WHEN i % 89 = 0 THEN '-5' WHEN i % 61 = 0 THEN 'n/a' WHEN i % 67 = 0 THEN CAST(quantity AS VARCHAR) || '.7' ELSE CAST(quantity AS VARCHAR) END AS quantity,
  CASE WHEN i % 103 = 0 THEN 'NULL' ELSE CAST(customer_id AS VARCHAR) END AS customer_id,
  CASE WHEN i % 73 = 0 THEN 'not-a-date' WHEN i % 113 = 0 THEN 'NaN' ELSE CAST(order_date AS VARCHAR) END AS order_date,
  CASE WHEN i % 59 = 0 THEN '0' WHEN i % 127 = 0 THEN 'bad' ELSE CAST(total_amount AS VARCHAR) END AS total_amount,
  CASE WHEN i % 131 = 0 THEN 'None' WHEN i % 2 = 0 THEN '  ' || name || ' ' ELSE name END AS name,
  CASE WHEN i % 97 = 0 THEN 'NULL' WHEN i % 71 = 0 THEN lower(city) WHEN i % 43 = 0 THEN 'el cairo' WHEN i % 47 = 0 THEN 'AL-QAHIRA' WHEN i % 37 = 0 THEN ' alex ' ELSE city END AS city,
  CASE WHEN i % 79 = 0 THEN replace(email, '@', '.') WHEN i % 41 = 0 THEN upper(email) WHEN i % 139 = 0 THEN '' ELSE email END AS email,
  CASE WHEN i % 109 = 0 THEN '' ELSE CAST(signup_date AS VARCHAR) END AS signup_date,
  CASE WHEN i % 137 = 0 THEN 'N/A' ELSE product_name END AS product_name,
  CASE WHEN i % 53 = 0 THEN 'electronic' WHEN i % 31 = 0 THEN 'food & bev' WHEN i % 149 = 0 THEN '' ELSE category END AS category,
  CASE WHEN i % 83 = 0 THEN '' WHEN i % 151 = 0 THEN '-1' ELSE CAST(price AS VARCHAR) END AS price
FROM (SELECT *, order_item_id AS i FROM lines) JOIN (VALUES (1), (2)) AS copies(k) ON k = 1 OR i % 29 = 0"""
PARTS["read_text"] = "SELECT " + ", ".join(f"{nulled(c, CSV_NULLS)} AS {c}" for c in TEXT_COLUMNS) + " FROM dirty"
PARTS["uniq"] = "SELECT DISTINCT * FROM dirty"
PARTS["nulled"] = "SELECT " + ", ".join(f"{nulled(c, NULLS)} AS {c}" for c in TEXT_COLUMNS) + " FROM uniq"
PARTS["keyed"] = """SELECT * FROM nulled WHERE order_item_id IS NOT NULL AND order_id IS NOT NULL AND product_id IS NOT NULL AND customer_id IS NOT NULL"""
PARTS["filled"] = """SELECT * REPLACE (coalesce(city, 'Unknown') AS city, coalesce(category, 'Uncategorised') AS category,
 coalesce(product_name, 'Unknown Product') AS product_name, coalesce(name, 'Unknown Customer') AS name) FROM keyed"""


def whole(column: str) -> str:
    return f"TRY_CAST(trunc(TRY_CAST({column} AS DECIMAL(38,6))) AS BIGINT)"


PARTS["idsraw"] = "SELECT * REPLACE (" + ", ".join(
    f"{whole(c)} AS {c}" for c in ("order_item_id", "order_id", "product_id", "customer_id", "quantity")
) + ") FROM filled"
PARTS["typed"] = """SELECT * REPLACE (CAST(round(TRY_CAST(total_amount AS DECIMAL(38,6)), 2) AS DECIMAL(18,2)) AS total_amount,
 CAST(round(TRY_CAST(price AS DECIMAL(38,6)), 2) AS DECIMAL(18,2)) AS price) FROM idsraw
 WHERE order_item_id IS NOT NULL AND order_id IS NOT NULL AND product_id IS NOT NULL AND customer_id IS NOT NULL"""
PARTS["texted"] = f"""SELECT * REPLACE ({title("trim(city)")} AS city, trim(name) AS name, {title("trim(category)")} AS category,
 trim(product_name) AS product_name, lower(trim(email)) AS email) FROM typed"""
PARTS["aliased"] = """SELECT * REPLACE (
 CASE city WHEN 'El Cairo' THEN 'Cairo' WHEN 'Al Cairo' THEN 'Cairo' WHEN 'Al-Qahira' THEN 'Cairo' WHEN 'Alex' THEN 'Alexandria' WHEN 'El Giza' THEN 'Giza' WHEN 'Al Giza' THEN 'Giza' ELSE city END AS city,
 CASE category WHEN 'Electronic' THEN 'Electronics' WHEN 'Cloths' THEN 'Clothing' WHEN 'Cloth' THEN 'Clothing' WHEN 'Book' THEN 'Books' WHEN 'Food & Bev' THEN 'Food' ELSE category END AS category) FROM texted"""
PARTS["dated"] = "SELECT * REPLACE (TRY_CAST(order_date AS DATE) AS order_date, TRY_CAST(signup_date AS DATE) AS signup_date) FROM aliased"
PARTS["flagged"] = """SELECT * REPLACE (coalesce(order_date, DATE '1900-01-01') AS order_date, coalesce(signup_date, DATE '1900-01-01') AS signup_date),
 CASE WHEN order_date IS NOT NULL AND signup_date IS NOT NULL THEN 1 ELSE 0 END AS dq_date_valid FROM dated"""
PARTS["ranged"] = """SELECT * REPLACE (CASE WHEN quantity > 0 THEN quantity ELSE 1 END AS quantity),
 CASE WHEN order_date < signup_date THEN 1 ELSE 0 END AS dq_order_before_signup FROM flagged"""
PARTS["priced"] = f"""SELECT * REPLACE (CASE WHEN price > 0 THEN price ELSE
 (SELECT CAST({rounded("median(CAST(price AS DOUBLE))", 2)} AS DECIMAL(18,2)) FROM ranged WHERE price > 0) END AS price) FROM ranged"""
PARTS["repaired"] = """SELECT * REPLACE (CASE WHEN total_amount > 0 THEN total_amount ELSE CAST(quantity * price AS DECIMAL(18,2)) END AS total_amount) FROM priced"""
PARTS["cleaned"] = f"""SELECT *, CASE WHEN regexp_matches(email, '{EMAIL}') THEN 1 ELSE 0 END AS dq_email_valid, {_MEASURES},
 'batch-1' AS etl_load_id, '2001-09-01 00:00:00' AS etl_load_date, 'sample' AS etl_source_file FROM repaired"""
PARTS["dirtyfact"] = f"""SELECT *, {date_key("order_date")} AS order_date_key, strftime(order_date, '%Y-%m') AS year_month
 FROM cleaned WHERE {date_key("order_date")} BETWEEN 19940101 AND 20021231"""

_SQL: dict[str, str] = {}


def _with(body: str) -> str:
    """Put the named parts that the body needs in front of it, in order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for word in re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", text):
            if word in PARTS and word not in needed:
                visit(PARTS[word])
                if word not in needed:
                    needed.append(word)

    visit(body)
    if not needed:
        return body
    named = ", ".join(f"{name} AS ({PARTS[name].strip()})" for name in needed)
    return f"WITH {named} {body}"


def add(name: str, columns: str, body: str) -> None:
    specs = [c.split(":") for c in columns.split()]
    outer = ", ".join(f"CAST({c} AS {CAST[k]}) AS {c}" for c, k in specs)
    _SQL[name] = f"SELECT {outer} FROM ({_with(body)})"


TEXTS = " ".join(f"{c}:s" for c in TEXT_COLUMNS)

# --- sources -----------------------------------------------------------------
add("extract_csv", TEXTS, "SELECT * FROM read_text")
add("landing_copy", TEXTS, "SELECT * FROM read_text")
add("load_raw", TEXTS + " etl_load_id:s etl_load_date:s etl_source_file:s",
    "SELECT *, 'batch-1' AS etl_load_id, '2001-09-01 00:00:00' AS etl_load_date, 'sample' AS etl_source_file FROM dirty")
add("raw_bulk_copy", TEXTS + " etl_load_id:s", "SELECT *, 'batch-1' AS etl_load_id FROM read_text")
_COMPUTED = """CAST(quantity * price AS DECIMAL(38,2)) AS calculated_revenue, greatest(quantity * price - total_amount, 0) AS discount_amount,
 year(order_date) AS order_year, month(order_date) AS order_month, order_date - signup_date AS customer_tenure_days"""
_COMPUTED_COLUMNS = "calculated_revenue:d discount_amount:d order_year:i order_month:i customer_tenure_days:i"
add("load_staging",
    "order_item_id:i order_id:i product_id:i customer_id:i quantity:i total_amount:d order_date:s customer_name:s city:s email:s "
    "signup_date:s product_name:s category:s unit_price:d dq_email_valid:i dq_date_valid:i " + _COMPUTED_COLUMNS,
    f"""SELECT order_item_id, order_id, product_id, customer_id, quantity, total_amount, order_date, name AS customer_name, city, email,
    signup_date, product_name, category, price AS unit_price, dq_email_valid, dq_date_valid, {_COMPUTED}
    FROM (SELECT * EXCLUDE (discount_amount, order_year, order_month, customer_tenure_days) FROM cleaned)""")
add("staging_computed", "order_item_id:i " + _COMPUTED_COLUMNS, f"SELECT order_item_id, {_COMPUTED} FROM lines")
add("truncate_reload_fact", "table_name:s row_count:i net_revenue:d", """
 SELECT 'fact_order_items' AS table_name, count(*) AS row_count, sum(net_revenue) AS net_revenue FROM fact
 UNION ALL SELECT 'fact_order_summary', count(DISTINCT (order_id, order_date_key, customer_id, geography_sk)), sum(net_revenue) FROM fact
 UNION ALL SELECT 'fact_monthly_product_performance', count(*), sum(total_net_revenue) FROM monthly""")
add("read_fact_back", "order_item_id:i order_id:i order_date_key:i quantity:i gross_revenue:d net_revenue:d discount_amount:d", "SELECT * FROM fact")

# --- cleaning ----------------------------------------------------------------
add("clean_colnames", TEXTS, "SELECT * FROM dirty")
add("clean_dedup", TEXTS, "SELECT * FROM uniq")
add("clean_null_tokens", TEXTS, "SELECT * FROM nulled")
add("clean_drop_null_keys", TEXTS, "SELECT * FROM keyed")
add("rejected_keys", TEXTS + " reason:s", f"""
 SELECT * FROM (SELECT *, CASE WHEN order_item_id IS NULL OR order_id IS NULL OR product_id IS NULL OR customer_id IS NULL THEN 'null key'
  WHEN {whole("order_item_id")} IS NULL OR {whole("order_id")} IS NULL OR {whole("product_id")} IS NULL OR {whole("customer_id")} IS NULL
  THEN 'unreadable key' END AS reason FROM nulled) WHERE reason IS NOT NULL""")
add("clean_fill_defaults", "order_item_id:s name:s city:s product_name:s category:s", "SELECT * FROM filled")
add("clean_cast_ids", "order_item_id:i order_id:i product_id:i customer_id:i quantity:i", "SELECT * FROM idsraw")
add("clean_cast_money", "order_item_id:i total_amount:d price:d", "SELECT * FROM typed")
add("clean_strings", "order_item_id:i name:s city:s email:s product_name:s category:s", "SELECT * FROM texted")
add("clean_city_alias", "order_item_id:i city:s", "SELECT * FROM aliased")
add("clean_category_alias", "order_item_id:i category:s", "SELECT * FROM aliased")
add("profile_value_counts", "column_name:s value:s row_count:i", """
 SELECT 'category' AS column_name, category AS value, count(*) AS row_count FROM aliased GROUP BY category
 UNION ALL SELECT 'city', city, count(*) FROM aliased GROUP BY city""")
add("clean_dates", "order_item_id:i order_date:s signup_date:s", "SELECT * FROM dated")
add("dq_date_valid", "order_item_id:i dq_date_valid:i", "SELECT * FROM flagged")
add("clean_date_sentinel", "order_item_id:i order_date:s signup_date:s", "SELECT * FROM flagged")
add("dq_order_before_signup", "order_item_id:i dq_order_before_signup:i", "SELECT * FROM ranged")
add("clean_quantity_range", "order_item_id:i quantity:i", "SELECT * FROM ranged")
add("clean_price_median", "order_item_id:i price:d", "SELECT * FROM priced")
add("clean_amount_recompute", "order_item_id:i total_amount:d", "SELECT * FROM repaired")
add("dq_email_valid", "order_item_id:i email:s dq_email_valid:i", "SELECT * FROM cleaned")
add("derive_revenue", "order_item_id:i gross_revenue:d net_revenue:d discount_amount:d discount_pct:d", "SELECT * FROM cleaned")
add("derive_tenure", "order_item_id:i customer_tenure_days:i", "SELECT * FROM cleaned")
add("derive_year_month", "order_item_id:i order_year:i order_month:i", "SELECT * FROM cleaned")
add("price_band", "order_item_id:i price:d price_band:s", "SELECT * FROM cleaned")
add("audit_columns", "order_item_id:i etl_load_id:s etl_load_date:s etl_source_file:s", "SELECT * FROM cleaned")
for _name in ("clean_orders", "save_processed"):
  add(_name,
    "order_item_id:i order_id:i product_id:i quantity:i customer_id:i order_date:s total_amount:d name:s city:s email:s signup_date:s "
    "product_name:s category:s price:d dq_date_valid:i dq_order_before_signup:i dq_email_valid:i gross_revenue:d net_revenue:d "
    "discount_amount:d discount_pct:d customer_tenure_days:i order_year:i order_month:i price_band:s etl_load_id:s etl_load_date:s etl_source_file:s",
    "SELECT * FROM cleaned")
add("clean_summary", "metric:s value:i", """
 SELECT 'rows_in' AS metric, count(*) AS value FROM dirty UNION ALL SELECT 'rows_out', count(*) FROM cleaned
 UNION ALL SELECT 'rows_removed', (SELECT count(*) FROM dirty) - (SELECT count(*) FROM cleaned)""")

# --- quality -----------------------------------------------------------------
add("dq_overview", "row_count:i column_count:i", "SELECT count(*) AS row_count, 14 AS column_count FROM read_text")
_NULL_ROWS = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, count(*) AS n FROM read_text" for c in TEXT_COLUMNS
)
add("dq_nulls", "column_name:s null_count:i null_pct:d",
    f"SELECT column_name, null_count, {pct('null_count', 'n')} AS null_pct FROM ({_NULL_ROWS}) WHERE null_count > 0")
PARTS["textuniq"] = "SELECT DISTINCT * FROM read_text"
PARTS["dups"] = """SELECT (SELECT count(*) FROM read_text) - (SELECT count(*) FROM textuniq) AS full_row_duplicates,
 (SELECT count(*) FROM read_text) - (SELECT count(DISTINCT coalesce(order_item_id, '?')) FROM read_text) AS order_item_id_duplicates"""
add("dq_duplicates", "full_row_duplicates:i order_item_id_duplicates:i distinct_orders:i distinct_customers:i distinct_products:i", """
 SELECT full_row_duplicates, order_item_id_duplicates, (SELECT count(DISTINCT order_id) FROM read_text) AS distinct_orders,
 (SELECT count(DISTINCT customer_id) FROM read_text) AS distinct_customers, (SELECT count(DISTINCT product_id) FROM read_text) AS distinct_products FROM dups""")
add("dq_numeric_ranges", "column_name:s min_value:d max_value:d mean_value:d negatives:i zeros:i nulls:i", f"""
 SELECT column_name, min(v) AS min_value, max(v) AS max_value, {mean("v", 2)} AS mean_value,
  count(*) FILTER (v < 0) AS negatives, count(*) FILTER (v = 0) AS zeros, count(*) FILTER (v IS NULL) AS nulls FROM (
   SELECT 'quantity' AS column_name, TRY_CAST(quantity AS DECIMAL(20,4)) AS v FROM read_text
   UNION ALL SELECT 'total_amount', TRY_CAST(total_amount AS DECIMAL(20,4)) FROM read_text
   UNION ALL SELECT 'price', TRY_CAST(price AS DECIMAL(20,4)) FROM read_text) GROUP BY column_name""")
PARTS["days"] = "SELECT TRY_CAST(order_date AS DATE) AS o, TRY_CAST(signup_date AS DATE) AS s, email FROM read_text"
add("dq_dates", "order_date_min:s order_date_max:s signup_date_min:s signup_date_max:s bad_order_dates:i bad_signup_dates:i order_before_signup:i order_before_signup_pct:d", f"""
 SELECT min(o) AS order_date_min, max(o) AS order_date_max, min(s) AS signup_date_min, max(s) AS signup_date_max,
 count(*) FILTER (o IS NULL) AS bad_order_dates, count(*) FILTER (s IS NULL) AS bad_signup_dates, count(*) FILTER (o < s) AS order_before_signup,
 {pct("count(*) FILTER (o < s)", "count(*)", 1)} AS order_before_signup_pct FROM days""")
add("dq_categorical", "column_name:s value:s row_count:i share_pct:d", f"""
 SELECT *, {pct("row_count", "(SELECT count(*) FROM read_text)", 1)} AS share_pct FROM (
  SELECT 'category' AS column_name, category AS value, count(*) AS row_count FROM read_text WHERE category IS NOT NULL GROUP BY category
  UNION ALL SELECT 'city', city, count(*) FROM read_text WHERE city IS NOT NULL GROUP BY city)""")
_VALID = f"CASE WHEN regexp_matches(trim(email), '{EMAIL}') THEN 1 ELSE 0 END"
add("dq_email", "invalid_emails:i valid_emails:i", f"SELECT sum(1 - {_VALID}) AS invalid_emails, sum({_VALID}) AS valid_emails FROM read_text")
PARTS["issues"] = f"""SELECT full_row_duplicates + order_item_id_duplicates
 + (SELECT count(*) FILTER (o IS NULL) + count(*) FILTER (s IS NULL) + sum(1 - {_VALID}) FROM days)
 + (SELECT count(*) FROM ({_NULL_ROWS}) WHERE null_count > 0) AS total_issues FROM dups"""
add("dq_score", "total_issues:i score:d grade:s", """
 SELECT *, CASE WHEN score >= 90 THEN 'A' WHEN score >= 75 THEN 'B' WHEN score >= 60 THEN 'C' ELSE 'D' END AS grade
 FROM (SELECT total_issues, greatest(0, 100 - total_issues * 0.5) AS score FROM issues)""")

# --- dimensions --------------------------------------------------------------
add("dim_date",
    "date_key:i full_date:s day_of_month:i day_name:s day_of_week:i day_of_year:i week_of_year:i month_number:i month_name:s month_name_short:s "
    "quarter_number:i quarter_name:s year_number:i year_month:s year_quarter:s is_weekend:i is_weekday:i is_leap_year:i days_in_month:i", f"""
 SELECT {date_key("d")} AS date_key, d AS full_date, day(d) AS day_of_month, dayname(d) AS day_name, dayofweek(d) + 1 AS day_of_week, dayofyear(d) AS day_of_year,
 weekofyear(d) AS week_of_year, month(d) AS month_number, monthname(d) AS month_name, monthname(d)[1:3] AS month_name_short, quarter(d) AS quarter_number,
 'Q' || quarter(d) AS quarter_name, year(d) AS year_number, strftime(d, '%Y-%m') AS year_month, year(d) || '-Q' || quarter(d) AS year_quarter,
 CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend, CASE WHEN dayofweek(d) IN (0, 6) THEN 0 ELSE 1 END AS is_weekday,
 CASE WHEN day(last_day(make_date(year(d), 2, 1))) = 29 THEN 1 ELSE 0 END AS is_leap_year, day(last_day(d)) AS days_in_month
 FROM (SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS d FROM orders)""")
_CUSTOMER = (
    "customer_id:i customer_name:s email:s signup_date:s signup_year:i signup_month:i city:s country:s region:s "
    "customer_segment:s total_orders:i total_lifetime_value:d is_active:i"
)


def customers_where(condition: str) -> str:
    """Customer dimension of the lines that meet a condition."""
    return f"""SELECT *, year(signup_date) AS signup_year, month(signup_date) AS signup_month, 'Egypt' AS country, 'MENA' AS region,
 {segment("total_lifetime_value", "total_orders")} AS customer_segment, 1 AS is_active FROM (
 SELECT customer_id, any_value(name) AS customer_name, any_value(email) AS email, any_value(city) AS city, any_value(signup_date) AS signup_date,
 count(DISTINCT order_id) AS total_orders, sum(total_amount) AS total_lifetime_value FROM lines WHERE {condition} GROUP BY customer_id)"""


def products_where(condition: str) -> str:
    return f"""SELECT product_id, product_name, category, price AS unit_price, {band("price")} AS price_band, 1 AS is_active FROM (
 SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY order_date DESC, order_item_id DESC) AS rn FROM lines WHERE {condition}) WHERE rn = 1"""


add("dim_customer", _CUSTOMER, customers_where("true"))
add("dim_product", "product_id:i product_name:s category:s unit_price:d price_band:s is_active:i", products_where("true"))
add("dim_geography", "geography_sk:i city_name:s governorate:s country:s country_code:s region:s continent:s latitude:d longitude:d", """
 SELECT n_nationkey + 1 AS geography_sk, n_name AS city_name, n_name || ' Governorate' AS governorate, n_name AS country, 'N' || n_nationkey AS country_code,
 r_name AS region, r_name AS continent, n_nationkey * 3 - 36 AS latitude, n_nationkey * 5 - 60 AS longitude FROM nation JOIN region ON n_regionkey = r_regionkey
 UNION ALL SELECT 0, 'Unknown', NULL, 'Unknown', '--', 'Unknown', 'Unknown', NULL, NULL""")
add("dim_channel", "channel_sk:i channel_name:s channel_type:s channel_category:s line_count:i", """
 SELECT c.channel_sk, channel_name, channel_type, NULL AS channel_category, count(l.channel_sk) AS line_count
 FROM channel c LEFT JOIN lines l ON l.channel_sk = c.channel_sk GROUP BY ALL""")
add("surrogate_keys", "customer_sk:i customer_id:i", f"""
 SELECT customer_id, row_number() OVER (ORDER BY CASE WHEN first <= {SPLIT} THEN 0 ELSE 1 END, customer_id) AS customer_sk
 FROM (SELECT customer_id, min(order_date) AS first FROM lines GROUP BY customer_id)""")
add("customer_segment", "customer_id:i total_orders:i total_lifetime_value:d customer_segment:s", customers_where("true"))

PARTS["c_old"] = customers_where(f"order_date <= {SPLIT}")
PARTS["c_new"] = customers_where(f"order_date > {SPLIT}")
PARTS["p_old"] = products_where(f"order_date <= {SPLIT}")
PARTS["p_new"] = products_where(f"order_date > {SPLIT}")


def merged(old: str, new: str, key: str, surrogate: str, take_new, keep_old, touched: str, inserted=None) -> str:
    """Type-1 merge: ``take_new`` columns follow an update, ``keep_old`` ones do not."""
    inserted = inserted or {}
    columns = [f"CASE WHEN o.{key} IS NULL OR {touched} THEN n.{c} ELSE o.{c} END AS {c}" for c in take_new]
    columns += [f"CASE WHEN o.{key} IS NULL THEN {inserted.get(c, 'n.' + c)} ELSE o.{c} END AS {c}" for c in keep_old]
    return f"""SELECT row_number() OVER (ORDER BY CASE WHEN o.{key} IS NULL THEN 1 ELSE 0 END, coalesce(o.{key}, n.{key})) AS {surrogate},
 coalesce(o.{key}, n.{key}) AS {key}, {", ".join(columns)},
 CASE WHEN o.{key} IS NULL THEN 'insert' WHEN {touched} THEN 'update' ELSE 'unchanged' END AS action
 FROM {old} AS o FULL JOIN {new} AS n ON o.{key} = n.{key}"""


_ALL_CUSTOMER = [c.split(":")[0] for c in _CUSTOMER.split()][1:]
add("upsert_dim_type1", "customer_sk:i " + _CUSTOMER + " action:s",
    merged("c_old", "c_new", "customer_id", "customer_sk", _ALL_CUSTOMER, [], "n.customer_id IS NOT NULL"))
PARTS["c_stale"] = "SELECT * REPLACE (CASE WHEN signup_month = 1 THEN NULL ELSE email END AS email) FROM c_old"
_CUSTOMER_TAKEN = ["customer_name", "email", "city", "signup_date", "signup_year", "signup_month"]
add("upsert_customer_changed", "customer_sk:i " + _CUSTOMER + " action:s",
    merged("c_stale", "c_new", "customer_id", "customer_sk", _CUSTOMER_TAKEN,
           [c for c in _ALL_CUSTOMER if c not in _CUSTOMER_TAKEN],
           "(n.customer_id IS NOT NULL AND (o.customer_name IS DISTINCT FROM n.customer_name OR o.email IS DISTINCT FROM n.email OR o.city IS DISTINCT FROM n.city))",
           {"customer_segment": "'New'", "total_orders": "0", "total_lifetime_value": "0"}))
_PRODUCT_MERGE = merged("p_old", "p_new", "product_id", "product_sk", ["product_name", "category", "unit_price", "price_band"], ["is_active"],
    "(n.product_id IS NOT NULL AND (o.unit_price IS DISTINCT FROM n.unit_price OR o.product_name IS DISTINCT FROM n.product_name OR o.category IS DISTINCT FROM n.category))")
add("upsert_product_changed", "product_sk:i product_id:i product_name:s category:s unit_price:d price_band:s is_active:i action:s", _PRODUCT_MERGE)
add("merge_counts", "action:s row_count:i", f"SELECT action, count(*) AS row_count FROM ({_PRODUCT_MERGE}) GROUP BY action")
PARTS["late"] = f"SELECT customer_id, count(DISTINCT order_id) AS orders, sum(net_revenue) AS value FROM fact WHERE order_date_key > {SPLIT_KEY} GROUP BY customer_id"
_STATS = "customer_id:i total_orders:i total_lifetime_value:d customer_segment:s"
PARTS["all_orders"] = "SELECT customer_id, count(DISTINCT order_id) AS orders, sum(net_revenue) AS value FROM fact GROUP BY customer_id"
for _name, _without in [(n + tail, w) for n, w in (("refresh_customer_stats_inner", "'New'"), ("refresh_customer_stats", segment("0", "0"))) for tail in ("", "_all_facts")]:
    add(_name, _STATS, f"""
 SELECT c_custkey AS customer_id, coalesce(orders, 0) AS total_orders, coalesce(value, 0) AS total_lifetime_value,
 CASE WHEN orders IS NULL THEN {_without} ELSE {segment("value", "orders")} END AS customer_segment FROM customer LEFT JOIN all_orders ON customer_id = c_custkey""")

# --- facts -------------------------------------------------------------------
_FACT = ("order_date_key:i customer_sk:i product_sk:i geography_sk:i channel_sk:i order_id:i order_item_id:i quantity:i unit_price:d "
         "gross_revenue:d net_revenue:d discount_amount:d discount_pct:d customer_tenure_days:i")
_FACT_KEYS = "order_date_key, customer_sk, product_sk, geography_sk, f.channel_sk, order_id, order_item_id, quantity, f.price AS unit_price, gross_revenue, net_revenue, discount_amount"
_FACT_FROM = "FROM fact f JOIN dimc c ON c.customer_id = f.customer_id JOIN dimp p ON p.product_id = f.product_id"
add("fact_order_items", _FACT, f"SELECT {_FACT_KEYS}, discount_pct, customer_tenure_days {_FACT_FROM}")
add("fact_order_items_sql", _FACT + " etl_load_id:s", f"""
 SELECT {_FACT_KEYS.replace("f.channel_sk", "1 AS channel_sk")}, {rounded("CAST(gross_revenue - net_revenue AS DOUBLE) / CAST(gross_revenue AS DOUBLE)", 4)} AS discount_pct,
 order_date - f.signup_date AS customer_tenure_days, 'batch-1' AS etl_load_id {_FACT_FROM}""")
add("unmapped_keys", "natural_key:s row_count:i", f"""
 SELECT 'customer_id' AS natural_key, count(*) AS row_count FROM lines WHERE customer_id NOT IN (SELECT customer_id FROM lines WHERE order_date <= {SPLIT})
 UNION ALL SELECT 'product_id', count(*) FROM lines WHERE product_id NOT IN (SELECT product_id FROM lines WHERE order_date <= {SPLIT})""")
add("fact_order_summary",
    "order_id:i order_date_key:i customer_sk:i geography_sk:i total_items:i total_quantity:i order_gross_revenue:d order_net_revenue:d order_discount_amount:d distinct_products:i", """
 SELECT order_id, order_date_key, customer_sk, geography_sk, count(*) AS total_items, sum(quantity) AS total_quantity, sum(gross_revenue) AS order_gross_revenue,
 sum(net_revenue) AS order_net_revenue, sum(discount_amount) AS order_discount_amount, count(DISTINCT product_id) AS distinct_products
 FROM fact f JOIN dimc c ON c.customer_id = f.customer_id GROUP BY 1, 2, 3, 4""")
add("fact_monthly_product",
    "year_month_key:s product_sk:i total_units_sold:i total_orders:i total_gross_revenue:d total_net_revenue:d avg_unit_price:d avg_order_value:d total_customers:i",
    "SELECT m.*, product_sk FROM monthly m JOIN dimp p ON p.product_id = m.product_id")
PARTS["mom"] = f"""SELECT *, {growth("total_net_revenue", "lag(total_net_revenue) OVER w")} AS revenue_mom_change_pct,
 {growth("total_units_sold", "lag(total_units_sold) OVER w")} AS units_mom_change_pct FROM monthly WINDOW w AS (PARTITION BY product_id ORDER BY year_month_key)"""
add("monthly_mom_change", "year_month_key:s product_sk:i total_net_revenue:d total_units_sold:i revenue_mom_change_pct:d units_mom_change_pct:d",
    "SELECT m.*, product_sk FROM mom m JOIN dimp p ON p.product_id = m.product_id")

# --- incremental -------------------------------------------------------------
PARTS["runs"] = """SELECT o_orderkey AS run_seq, o_orderpriority AS pipeline_name, CAST(o_orderdate AS DATE) AS last_loaded_date,
 CASE WHEN o_orderstatus = 'F' THEN 'FAILED' ELSE 'SUCCESS' END AS last_run_status, o_custkey AS rows_loaded FROM orders"""
add("hwm_read", "pipeline_name:s last_loaded_date:s",
    "SELECT pipeline_name, arg_max(last_loaded_date, run_seq) AS last_loaded_date FROM runs WHERE last_run_status = 'SUCCESS' GROUP BY 1")
PARTS["half"] = f"SELECT *, row_number() OVER (PARTITION BY pipeline_name, last_loaded_date > {SPLIT} ORDER BY run_seq DESC) AS rn FROM runs"
add("hwm_upsert", "run_seq:i pipeline_name:s last_loaded_date:s last_run_status:s rows_loaded:i", """
 SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pipeline_name ORDER BY run_seq DESC) AS last FROM half WHERE rn = 1) WHERE last = 1""")
add("incremental_delta", "order_item_id:i order_date:s net_revenue:d", f"SELECT * FROM clean WHERE order_date > {SPLIT}")
add("incremental_replace_window", "order_item_id:i order_date_key:i net_revenue:d", "SELECT * FROM fact")
# Lines up to the split were loaded first, so their missing prices got the median of that batch.
add("run_incremental", "order_item_id:i order_date_key:i quantity:i net_revenue:d", f"""
 SELECT order_item_id, order_date_key, quantity, CASE WHEN amount > 0 THEN amount
  ELSE CAST(quantity * CASE WHEN known > 0 OR order_date > {SPLIT} THEN price ELSE early END AS DECIMAL(18,2)) END AS net_revenue
 FROM (SELECT d.*, r.total_amount AS amount, r.price AS known FROM dirtyfact d JOIN ranged r ON r.order_item_id = d.order_item_id),
  (SELECT CAST({rounded("median(CAST(price AS DOUBLE))", 2)} AS DECIMAL(18,2)) AS early FROM ranged WHERE price > 0 AND order_date <= {SPLIT})""")
# Four deliveries of undamaged lines; of each line the last one counts, of each product the newest line of all deliveries.
PARTS["delivered"] = """
SELECT *, 1 AS delivery FROM lines WHERE order_item_id % 4 IN (0, 1)
UNION ALL SELECT * REPLACE (CASE WHEN order_item_id % 8 = 1 THEN total_amount + 10 ELSE total_amount END AS total_amount), 2 FROM lines WHERE order_item_id % 4 IN (1, 2)
UNION ALL SELECT * REPLACE (CASE WHEN order_item_id % 4 = 2 THEN order_date + 31 ELSE order_date END AS order_date), 3 FROM lines
 WHERE order_item_id % 4 = 3 OR order_item_id % 12 = 6
UNION ALL SELECT * REPLACE (CASE WHEN order_item_id % 16 = 3 THEN quantity + 1 ELSE quantity END AS quantity), 4 FROM lines WHERE order_item_id % 32 = 0 OR order_item_id % 16 = 3"""
PARTS["current"] = f"""
SELECT *, {date_key("order_date")} AS order_date_key, strftime(order_date, '%Y-%m') AS year_month_key, total_amount AS net_revenue
FROM (SELECT *, row_number() OVER (PARTITION BY order_item_id ORDER BY delivery DESC) AS rn FROM delivered) WHERE rn = 1"""
PARTS["current_monthly"] = f"""
SELECT *, {growth("units", "lag(units) OVER (PARTITION BY product_id ORDER BY year_month_key)")} AS change
FROM (SELECT product_id, year_month_key, sum(quantity) AS units, sum(net_revenue) AS value, count(DISTINCT customer_id) AS buyers FROM current GROUP BY 1, 2)"""
add("stream_load", "table_name:s key:i label:s number:i amount:d", f"""
 SELECT 'fact_order_items' AS table_name, order_item_id AS key, CAST(order_date_key AS VARCHAR) AS label, quantity AS number, CAST(net_revenue AS DOUBLE) AS amount FROM current
 UNION ALL SELECT 'fact_order_summary', order_id, CAST(order_date_key AS VARCHAR), count(*), CAST(sum(net_revenue) AS DOUBLE) FROM current GROUP BY order_id, order_date_key
 UNION ALL SELECT 'monthly_units', product_id, year_month_key, units, CAST(value AS DOUBLE) FROM current_monthly
 UNION ALL SELECT 'monthly_change', product_id, year_month_key, buyers, change FROM current_monthly
 UNION ALL SELECT 'dim_customer', customer_id, {segment("value", "orders")}, orders, CAST(value AS DOUBLE)
  FROM (SELECT customer_id, count(DISTINCT order_id) AS orders, sum(net_revenue) AS value FROM current GROUP BY 1)
 UNION ALL SELECT 'dim_product', product_id, any_value(product_name), 0, CAST(arg_max(price, (order_date, order_item_id, delivery)) AS DOUBLE) FROM delivered GROUP BY 2""")
add("rebuild_derived_facts", "year_month_key:s product_id:i total_net_revenue:d total_orders:i total_customers:i revenue_mom_change_pct:d units_mom_change_pct:d",
    "SELECT * FROM mom")
_KEYS = ("order_item_id", "order_id", "product_id", "customer_id")
_FAULTS = ", ".join([f"CASE WHEN {c} IS NULL THEN 'missing {c}' END" for c in _KEYS] + [f"CASE WHEN {c} IS NOT NULL AND {whole(c)} IS NULL THEN 'unreadable {c}' END" for c in _KEYS])
add("quarantine", TEXTS + " stage:s reasons:s", f"""
 SELECT *, 'clean' AS stage FROM (SELECT {", ".join(TEXT_COLUMNS)}, concat_ws(', ', {_FAULTS}) AS reasons FROM nulled) WHERE reasons <> ''
 UNION ALL SELECT {", ".join(f"CAST({c} AS VARCHAR)" for c in TEXT_COLUMNS)}, 'date_key_range', 'fact' FROM cleaned WHERE {date_key("order_date")} NOT BETWEEN 19940101 AND 20021231""")
add("full_load", "customer_id:i customer_name:s city:s total_orders:i total_lifetime_value:d customer_segment:s", f"""
 SELECT a.customer_id, customer_name, a.city, coalesce(orders, 0) AS total_orders, coalesce(value, 0) AS total_lifetime_value,
 {segment("coalesce(value, 0)", "coalesce(orders, 0)")} AS customer_segment FROM
 (SELECT customer_id, name AS customer_name, city, row_number() OVER (PARTITION BY customer_id ORDER BY order_date DESC, order_item_id DESC) AS rn FROM cleaned) a
 LEFT JOIN (SELECT customer_id, count(DISTINCT order_id) AS orders, sum(net_revenue) AS value FROM dirtyfact GROUP BY 1) s ON s.customer_id = a.customer_id WHERE rn = 1""")
_NUMBERS = ("order_item_id order_id product_id quantity customer_id total_amount price dq_date_valid dq_order_before_signup dq_email_valid gross_revenue "
            "net_revenue discount_amount discount_pct customer_tenure_days order_year order_month").split()
_WORDS = "order_date name city email signup_date product_name category price_band etl_load_date etl_source_file".split()
_DESCRIBED = [f"""SELECT '{c}' AS column_name, count(v) AS value_count, NULL AS unique_values, NULL AS top, NULL AS freq, CAST(avg(v) AS REAL) AS mean, CAST(stddev_samp(v) AS REAL) AS std,
 min(v) AS min, quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.5) AS q50, quantile_cont(v, 0.75) AS q75, max(v) AS max FROM (SELECT CAST({c} AS DOUBLE) AS v FROM cleaned)""" for c in _NUMBERS]
_DESCRIBED += [f"""SELECT '{c}', coalesce(sum(n), 0), nullif(count(*), 0), min(v) FILTER (n = most), max(n), NULL, NULL, NULL, NULL, NULL, NULL, NULL
 FROM (SELECT *, max(n) OVER () AS most FROM (SELECT {"''" if c == "etl_source_file" else f"CAST({c} AS VARCHAR)"} AS v, count(*) AS n FROM cleaned WHERE {c} IS NOT NULL GROUP BY 1))""" for c in _WORDS]
add("dry_run_describe", "column_name:s value_count:i unique_values:i top:s freq:i mean:d std:d min:d q25:d q50:d q75:d max:d", " UNION ALL ".join(_DESCRIBED))
add("run_full_etl", "order_id:i order_date_key:i total_items:i total_quantity:i order_net_revenue:d distinct_products:i", """
 SELECT order_id, order_date_key, count(*) AS total_items, sum(quantity) AS total_quantity, sum(net_revenue) AS order_net_revenue, count(DISTINCT product_id) AS distinct_products
 FROM (SELECT d.*, coalesce(n_nationkey + 1, 0) AS place FROM dirtyfact d LEFT JOIN nation ON n_name = d.city) GROUP BY order_id, order_date_key, customer_id, place""")

# --- analytics ---------------------------------------------------------------
add("revenue_by_quarter",
    "year_number:i quarter_name:s year_quarter:s total_orders:i unique_customers:i total_units_sold:i gross_revenue:d net_revenue:d total_discounts:d avg_order_item_value:d revenue_per_customer:d", f"""
 SELECT year_number, quarter_name, year_quarter, count(DISTINCT order_id) AS total_orders, count(DISTINCT customer_id) AS unique_customers, sum(quantity) AS total_units_sold,
 sum(gross_revenue) AS gross_revenue, sum(net_revenue) AS net_revenue, sum(discount_amount) AS total_discounts, {mean("net_revenue")} AS avg_order_item_value,
 {rounded(ratio("sum(net_revenue)", "count(DISTINCT customer_id)"), 4)} AS revenue_per_customer FROM fact GROUP BY 1, 2, 3""")
add("monthly_growth", "year_month:s year_number:i month_name:s net_revenue:d total_orders:i unique_customers:i prior_month_revenue:d mom_growth_pct:d ytd_revenue:d", f"""
 SELECT *, {pct("net_revenue - prior_month_revenue", "prior_month_revenue")} AS mom_growth_pct,
 sum(net_revenue) OVER (PARTITION BY year_number ORDER BY month_number ROWS UNBOUNDED PRECEDING) AS ytd_revenue FROM (
 SELECT *, lag(net_revenue) OVER (ORDER BY year_month) AS prior_month_revenue FROM (
 SELECT year_month, year_number, month_number, month_name, sum(net_revenue) AS net_revenue, count(DISTINCT order_id) AS total_orders, count(DISTINCT customer_id) AS unique_customers
 FROM fact GROUP BY 1, 2, 3, 4))""")
add("category_share", "category:s year_number:i net_revenue:d gross_revenue:d total_discounts:d total_orders:i units_sold:i avg_unit_price:d revenue_share_pct:d", f"""
 SELECT *, {pct("net_revenue", "sum(net_revenue) OVER (PARTITION BY year_number)")} AS revenue_share_pct FROM (
 SELECT category, year_number, sum(net_revenue) AS net_revenue, sum(gross_revenue) AS gross_revenue, sum(discount_amount) AS total_discounts, count(DISTINCT order_id) AS total_orders,
 sum(quantity) AS units_sold, {mean("price")} AS avg_unit_price FROM fact GROUP BY 1, 2)""")
PARTS["per_product"] = f"""SELECT f.product_id, any_value(p.product_name) AS product_name, any_value(p.category) AS category, any_value(p.price_band) AS price_band,
 any_value(p.unit_price) AS unit_price, count(DISTINCT order_id) AS total_orders, sum(quantity) AS total_units_sold, sum(net_revenue) AS total_net_revenue,
 sum(gross_revenue) AS total_gross_revenue, {mean("quantity", 4)} AS avg_qty_per_order, count(DISTINCT customer_id) AS unique_buyers, {mean("net_revenue")} AS avg_order_value
 FROM fact f JOIN dimp p ON p.product_id = f.product_id GROUP BY f.product_id"""
add("top_products",
    "product_id:i product_name:s category:s price_band:s unit_price:d total_orders:i total_units_sold:i total_net_revenue:d total_gross_revenue:d avg_qty_per_order:d rank_in_category:i", """
 SELECT *, rank() OVER (PARTITION BY category ORDER BY total_net_revenue DESC) AS rank_in_category FROM per_product ORDER BY total_net_revenue DESC, product_id LIMIT 20""")
PARTS["cumulative"] = """SELECT *, sum(total_net_revenue) OVER () AS grand, sum(total_net_revenue) OVER (ORDER BY total_net_revenue DESC, product_id ROWS UNBOUNDED PRECEDING) AS running FROM per_product"""
add("abc_classification", "product_id:i product_name:s category:s net_revenue:d units_sold:i order_count:i revenue_pct:d cumulative_pct:d abc_class:s", f"""
 SELECT product_id, product_name, category, total_net_revenue AS net_revenue, total_units_sold AS units_sold, total_orders AS order_count,
 {pct("total_net_revenue", "grand")} AS revenue_pct, {pct("running", "grand")} AS cumulative_pct,
 CASE WHEN running * 100 <= grand * 70 THEN 'A - High Value' WHEN running * 100 <= grand * 90 THEN 'B - Mid Value' ELSE 'C - Low Value' END AS abc_class FROM cumulative""")
add("pareto", "product_id:i product_name:s net_revenue:d cumulative_pct:d",
    f"SELECT product_id, product_name, total_net_revenue AS net_revenue, {pct('running', 'grand')} AS cumulative_pct FROM cumulative")
PARTS["rfm"] = f"SELECT *, {AS_OF} - last_order_date AS recency_days, total_orders AS frequency, lifetime_value AS monetary_value FROM activity"
add("rfm_segmentation", "customer_id:i customer_name:s city:s recency_days:i frequency:i monetary_value:d r_score:i f_score:i m_score:i rfm_total_score:i customer_segment:s", """
 SELECT *, r_score + f_score + m_score AS rfm_total_score,
 CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions' WHEN r_score >= 3 AND f_score >= 3 THEN 'Loyal Customers'
 WHEN r_score >= 4 AND f_score <= 2 THEN 'Recent Customers' WHEN r_score <= 2 AND f_score >= 3 AND m_score >= 3 THEN 'At Risk'
 WHEN r_score <= 2 AND f_score <= 2 AND m_score <= 2 THEN 'Lost' WHEN m_score >= 4 THEN 'High Spenders' ELSE 'Regular' END AS customer_segment
 FROM (SELECT *, ntile(5) OVER (ORDER BY recency_days, customer_id) AS r_score, ntile(5) OVER (ORDER BY frequency, customer_id) AS f_score,
 ntile(5) OVER (ORDER BY monetary_value, customer_id) AS m_score FROM rfm)""")
add("rfm_points", "customer_id:i recency_days:i frequency:i monetary_value:d customer_segment:s",
    "SELECT r.*, customer_segment FROM rfm r JOIN dimc c ON c.customer_id = r.customer_id")
add("cohort_retention", "cohort_month:s months_since_first:i active_customers:i cohort_size:i retention_pct:d", f"""
 SELECT *, {pct("active_customers", "cohort_size")} AS retention_pct FROM (
 SELECT *, max(active_customers) OVER (PARTITION BY cohort_month) AS cohort_size FROM (
 SELECT strftime(cohort, '%Y-%m') AS cohort_month, datediff('month', cohort, order_date) AS months_since_first, count(DISTINCT customer_id) AS active_customers
 FROM (SELECT customer_id, order_date, min(order_date) OVER (PARTITION BY customer_id) AS cohort FROM fact) GROUP BY 1, 2) WHERE months_since_first BETWEEN 0 AND 12)""")
add("clv_ranking",
    "customer_id:i customer_name:s city:s signup_date:s total_orders:i total_items_bought:i lifetime_value:d avg_order_value:d last_order_date:s customer_age_days:i clv_percentile:d clv_quartile:i", """
 SELECT *, last_order_date - signup_date AS customer_age_days, percent_rank() OVER (ORDER BY lifetime_value) AS clv_percentile,
 ntile(4) OVER (ORDER BY lifetime_value, customer_id) AS clv_quartile FROM activity""")
add("city_year_share", "city_name:s country:s year_number:i total_orders:i unique_customers:i net_revenue:d avg_order_value:d units_sold:i city_revenue_share_pct:d city_rank:i", f"""
 SELECT *, {pct("net_revenue", "sum(net_revenue) OVER (PARTITION BY year_number)")} AS city_revenue_share_pct, rank() OVER (PARTITION BY year_number ORDER BY net_revenue DESC) AS city_rank FROM (
 SELECT city AS city_name, city AS country, year_number, count(DISTINCT order_id) AS total_orders, count(DISTINCT customer_id) AS unique_customers, sum(net_revenue) AS net_revenue,
 {mean("net_revenue")} AS avg_order_value, sum(quantity) AS units_sold FROM fact GROUP BY 1, 2, 3)""")
add("city_category", "city_name:s category:s net_revenue:d total_orders:i units_sold:i",
    "SELECT city AS city_name, category, sum(net_revenue) AS net_revenue, count(DISTINCT order_id) AS total_orders, sum(quantity) AS units_sold FROM fact GROUP BY 1, 2")
PARTS["counts"] = "SELECT customer_id, count(DISTINCT order_id) AS n FROM fact GROUP BY 1"
add("repeat_purchase_rate", "total_customers:i one_time_buyers:i repeat_buyers:i loyal_buyers:i repeat_purchase_rate_pct:d avg_orders_per_customer:d", f"""
 SELECT count(*) AS total_customers, count(*) FILTER (n = 1) AS one_time_buyers, count(*) FILTER (n >= 2) AS repeat_buyers, count(*) FILTER (n >= 5) AS loyal_buyers,
 {pct("count(*) FILTER (n >= 2)", "count(*)")} AS repeat_purchase_rate_pct, {mean("n")} AS avg_orders_per_customer FROM counts""")
add("new_vs_returning", "year_month:s new_customers:i returning_customers:i new_customer_revenue:d returning_customer_revenue:d", """
 SELECT year_month, count(DISTINCT CASE WHEN order_date = first THEN customer_id END) AS new_customers, count(DISTINCT CASE WHEN order_date > first THEN customer_id END) AS returning_customers,
 sum(CASE WHEN order_date = first THEN net_revenue ELSE 0 END) AS new_customer_revenue, sum(CASE WHEN order_date > first THEN net_revenue ELSE 0 END) AS returning_customer_revenue
 FROM (SELECT *, min(order_date) OVER (PARTITION BY customer_id) AS first FROM fact) GROUP BY 1""")
add("channel_share", "channel_name:s channel_type:s year_number:i total_orders:i unique_customers:i net_revenue:d avg_order_value:d units_sold:i channel_revenue_share_pct:d", f"""
 SELECT *, {pct("net_revenue", "sum(net_revenue) OVER (PARTITION BY year_number)")} AS channel_revenue_share_pct FROM (
 SELECT channel_name, channel_type, year_number, count(DISTINCT order_id) AS total_orders, count(DISTINCT customer_id) AS unique_customers, sum(net_revenue) AS net_revenue,
 {mean("net_revenue")} AS avg_order_value, sum(quantity) AS units_sold FROM fact f JOIN channel c ON c.channel_sk = f.channel_sk GROUP BY 1, 2, 3)""")
add("channel_category", "channel_name:s category:s net_revenue:d customers:i avg_order_value:d", f"""
 SELECT channel_name, category, sum(net_revenue) AS net_revenue, count(DISTINCT customer_id) AS customers, {mean("net_revenue")} AS avg_order_value
 FROM fact f JOIN channel c ON c.channel_sk = f.channel_sk GROUP BY 1, 2""")
add("kpi_summary",
    "total_net_revenue:d total_gross_revenue:d total_discounts:d total_orders:i total_customers:i total_line_items:i total_units_sold:i data_from_date:s data_to_date:s "
    "overall_discount_pct:d avg_order_item_value:d avg_basket_value:d avg_customer_value:d data_span_days:i", f"""
 SELECT sum(net_revenue) AS total_net_revenue, sum(gross_revenue) AS total_gross_revenue, sum(discount_amount) AS total_discounts, count(DISTINCT order_id) AS total_orders,
 count(DISTINCT customer_id) AS total_customers, count(*) AS total_line_items, sum(quantity) AS total_units_sold, min(order_date) AS data_from_date, max(order_date) AS data_to_date,
 {pct("sum(discount_amount)", "sum(gross_revenue)")} AS overall_discount_pct, {rounded(ratio("sum(net_revenue)", "count(*)"), 2)} AS avg_order_item_value,
 {rounded(ratio("sum(net_revenue)", "count(DISTINCT order_id)"), 2)} AS avg_basket_value, {rounded(ratio("sum(net_revenue)", "count(DISTINCT customer_id)"), 2)} AS avg_customer_value,
 max(order_date) - min(order_date) AS data_span_days FROM fact""")

# --- views -------------------------------------------------------------------
add("vw_monthly_revenue", "year_month:s year_number:i month_name:s month_number:i net_revenue:d gross_revenue:d discounts:d orders:i customers:i units_sold:i", """
 SELECT year_month, year_number, month_name, month_number, sum(net_revenue) AS net_revenue, sum(gross_revenue) AS gross_revenue, sum(discount_amount) AS discounts,
 count(DISTINCT order_id) AS orders, count(DISTINCT customer_id) AS customers, sum(quantity) AS units_sold FROM fact GROUP BY 1, 2, 3, 4""")
add("vw_product_performance",
    "product_id:i product_name:s category:s price_band:s unit_price:d total_revenue:d total_units:i total_orders:i unique_buyers:i avg_order_value:d",
    "SELECT *, total_net_revenue AS total_revenue, total_units_sold AS total_units FROM per_product")
PARTS["per_city"] = f"""SELECT city AS city_name, any_value(geography_sk) AS geography_sk, sum(net_revenue) AS net_revenue, count(DISTINCT order_id) AS total_orders,
 count(DISTINCT customer_id) AS unique_customers, {mean("net_revenue")} AS line_value FROM fact GROUP BY 1"""
add("vw_city_performance", "city_name:s country:s latitude:d longitude:d total_revenue:d total_orders:i unique_customers:i avg_order_value:d", """
 SELECT city_name, city_name AS country, (geography_sk - 1) * 3 - 36 AS latitude, (geography_sk - 1) * 5 - 60 AS longitude, net_revenue AS total_revenue, total_orders, unique_customers,
 line_value AS avg_order_value FROM per_city""")
add("vw_customer_360",
    "customer_id:i customer_name:s email:s city:s signup_date:s customer_segment:s total_orders:i lifetime_value:d avg_order_value:d last_order_date:s first_order_date:s days_since_last_order:i", f"""
 SELECT a.*, customer_segment, {AS_OF} - last_order_date AS days_since_last_order FROM activity a JOIN dimc c ON c.customer_id = a.customer_id""")

# --- measures ----------------------------------------------------------------
_KPIS = f"""SELECT sum(net_revenue) AS total_revenue, count(DISTINCT order_id) AS total_orders, count(DISTINCT customer_id) AS unique_customers,
 {rounded(ratio("sum(net_revenue)", "count(DISTINCT order_id)"), 4)} AS avg_order_value, sum(quantity) AS total_units_sold,
 {rounded(ratio("sum(discount_amount)", "sum(gross_revenue)"), 6)} AS discount_rate FROM fact"""
_KPI_COLUMNS = "total_revenue:d total_orders:i unique_customers:i avg_order_value:d total_units_sold:i discount_rate:d"
add("exec_kpis", _KPI_COLUMNS, _KPIS)
add("slice", _KPI_COLUMNS, _KPIS + """ WHERE order_date BETWEEN DATE '1996-03-15' AND DATE '1999-10-20'
 AND category IN ('ECONOMY', 'PROMO') AND city IN ('NATION_1', 'NATION_2', 'NATION_7')""")
add("revenue_orders_trend", "year_month:s net_revenue:d total_orders:i",
    "SELECT year_month, sum(net_revenue) AS net_revenue, count(DISTINCT order_id) AS total_orders FROM fact GROUP BY 1")
_YEARS = range(1995, 2002)
add("yoy_month_matrix", "month_number:i month_name:s " + " ".join(f"y{y}:d" for y in _YEARS),
    "SELECT month_number, month_name, " + ", ".join(f"sum(net_revenue) FILTER (year_number = {y}) AS y{y}" for y in _YEARS) + " FROM fact GROUP BY 1, 2")
_MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()
add("seasonality_matrix", "year_number:i " + " ".join(f"{m}:d" for m in _MONTHS),
    "SELECT year_number, " + ", ".join(f"sum(net_revenue) FILTER (month_number = {i + 1}) AS {m}" for i, m in enumerate(_MONTHS)) + " FROM fact GROUP BY 1")
PARTS["per_category"] = "SELECT category, sum(net_revenue) AS net_revenue FROM fact GROUP BY 1"
add("best_category", "category:s net_revenue:d", "SELECT * FROM per_category ORDER BY net_revenue DESC, category LIMIT 1")
add("category_revenue", "category:s net_revenue:d", "SELECT * FROM per_category")
add("avg_catalog_price", "avg_unit_price:d", f"SELECT {mean('unit_price')} AS avg_unit_price FROM dimp")
add("category_trend", "category:s year_month:s net_revenue:d", "SELECT category, year_month, sum(net_revenue) AS net_revenue FROM fact GROUP BY 1, 2")
add("price_band_distribution", "price_band:s total_orders:i net_revenue:d", """
 SELECT p.price_band, count(DISTINCT order_id) AS total_orders, sum(net_revenue) AS net_revenue FROM fact f JOIN dimp p ON p.product_id = f.product_id GROUP BY 1""")
add("customer_ltv", "customer_id:i customer_ltv:d", "SELECT customer_id, lifetime_value AS customer_ltv FROM activity")
add("avg_customer_ltv", "avg_customer_ltv:d", f"SELECT {mean('lifetime_value', 4)} AS avg_customer_ltv FROM activity")
add("repeat_buyers", "repeat_buyers:i", "SELECT count(*) FILTER (n >= 2) AS repeat_buyers FROM counts")
add("at_risk_customers", "customer_id:i last_order_date:s days_since_last_purchase:i",
    f"SELECT *, {AS_OF} - last_order_date AS days_since_last_purchase FROM activity WHERE {AS_OF} - last_order_date >= 90")
add("segment_breakdown", "customer_segment:s customers:i", "SELECT customer_segment, count(*) AS customers FROM dimc GROUP BY 1")
add("customer_acquisition", "signup_year:i signup_month:i new_customers:i",
    "SELECT year(signup_date) AS signup_year, month(signup_date) AS signup_month, count(*) AS new_customers FROM dimc GROUP BY 1, 2")
add("top_customers", "customer_id:i customer_name:s city:s total_orders:i lifetime_value:d last_order_date:s customer_segment:s", """
 SELECT a.*, customer_segment FROM activity a JOIN dimc c ON c.customer_id = a.customer_id ORDER BY lifetime_value DESC, a.customer_id LIMIT 20""")
add("city_segment_matrix", "city_name:s high_value:i regular:i new:i developing:i", """
 SELECT f.city AS city_name, count(DISTINCT CASE WHEN customer_segment = 'High Value' THEN f.customer_id END) AS high_value,
 count(DISTINCT CASE WHEN customer_segment = 'Regular' THEN f.customer_id END) AS regular, count(DISTINCT CASE WHEN customer_segment = 'New' THEN f.customer_id END) AS new,
 count(DISTINCT CASE WHEN customer_segment = 'Developing' THEN f.customer_id END) AS developing FROM fact f JOIN dimc c ON c.customer_id = f.customer_id GROUP BY 1""")
add("category_mix_by_city", "city_name:s category:s net_revenue:d city_share_pct:d", f"""
 SELECT *, {pct("net_revenue", "sum(net_revenue) OVER (PARTITION BY city_name)")} AS city_share_pct FROM (SELECT city AS city_name, category, sum(net_revenue) AS net_revenue FROM fact GROUP BY 1, 2)""")
add("city_market_share", "city_name:s net_revenue:d total_orders:i unique_customers:i avg_order_value:d market_share_pct:d", f"""
 SELECT *, {rounded(ratio("net_revenue", "total_orders"), 4)} AS avg_order_value, {pct("net_revenue", "sum(net_revenue) OVER ()")} AS market_share_pct FROM per_city""")
add("city_revenue", "city_name:s net_revenue:d total_orders:i unique_customers:i", "SELECT * FROM per_city")
add("revenue_yoy", "year_month:s net_revenue:d prior_year_revenue:d yoy_pct:d", f"""
 SELECT a.year_month, a.net_revenue, b.net_revenue AS prior_year_revenue, {pct("a.net_revenue - b.net_revenue", "b.net_revenue")} AS yoy_pct
 FROM by_month a LEFT JOIN by_month b ON b.year_number = a.year_number - 1 AND b.month_number = a.month_number""")
add("revenue_ytd", "year_month:s net_revenue:d ytd_revenue:d",
    "SELECT year_month, net_revenue, sum(net_revenue) OVER (PARTITION BY year_number ORDER BY month_number ROWS UNBOUNDED PRECEDING) AS ytd_revenue FROM by_month")
add("revenue_3m_rolling", "year_month:s avg_daily_revenue_3m:d", f"""
 SELECT year_month, {rounded(ratio("sum(net_revenue) OVER w", "sum(active_days) OVER w"), 4)} AS avg_daily_revenue_3m FROM by_month
 WINDOW w AS (ORDER BY year_number * 12 + month_number RANGE BETWEEN 2 PRECEDING AND CURRENT ROW)""")
add("weekday_weekend", "is_weekend:i net_revenue:d total_orders:i", """
 SELECT CASE WHEN dayofweek(order_date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend, sum(net_revenue) AS net_revenue, count(DISTINCT order_id) AS total_orders FROM fact GROUP BY 1""")
add("qoq_waterfall", "year_quarter:s net_revenue:d revenue_change:d", """
 SELECT *, net_revenue - lag(net_revenue) OVER (ORDER BY year_quarter) AS revenue_change FROM (SELECT year_quarter, sum(net_revenue) AS net_revenue FROM fact GROUP BY 1)""")
add("product_matrix", "product_id:i product_name:s category:s units_sold:i net_revenue:d avg_order_value:d total_orders:i",
    "SELECT *, total_units_sold AS units_sold, total_net_revenue AS net_revenue FROM per_product")
add("new_customers_month", "year_month:s new_customers:i",
    "SELECT strftime(first_order_date, '%Y-%m') AS year_month, count(*) AS new_customers FROM activity GROUP BY 1")

# --- constraints and access --------------------------------------------------
PARTS["unrepaired"] = f"SELECT *, {date_key('order_date')} AS k FROM flagged"
add("check_constraints", "rule:s violations:i", """
 SELECT 'date_key_range' AS rule, count(*) FILTER (NOT k BETWEEN 19940101 AND 20021231) AS violations FROM unrepaired
 UNION ALL SELECT 'net_revenue_nonnegative', count(*) FILTER (total_amount < 0) FROM unrepaired
 UNION ALL SELECT 'quantity_positive', count(*) FILTER (quantity <= 0) FROM unrepaired
 UNION ALL SELECT 'total_amount_nonnegative', count(*) FILTER (total_amount < 0) FROM unrepaired
 UNION ALL SELECT 'unit_price_nonnegative', count(*) FILTER (price < 0) FROM unrepaired""")
add("fk_integrity", "child_table:s foreign_key:s orphan_rows:i", f"""
 SELECT 'fact_order_items' AS child_table, 'order_date_key' AS foreign_key, count(*) AS orphan_rows FROM fact WHERE order_date_key > {SPLIT_KEY}
 UNION ALL SELECT 'fact_order_items', 'customer_sk', count(*) FROM fact WHERE customer_id NOT IN (SELECT c_custkey FROM customer)
 UNION ALL SELECT 'fact_order_items', 'product_sk', count(*) FROM fact WHERE product_id NOT IN (SELECT p_partkey FROM part)
 UNION ALL SELECT 'fact_order_items', 'geography_sk', count(*) FROM fact WHERE city NOT IN (SELECT n_name FROM nation)
 UNION ALL SELECT 'fact_order_items', 'channel_sk', count(*) FROM fact WHERE channel_sk NOT IN (SELECT channel_sk FROM channel)
 UNION ALL SELECT 'fact_order_summary', 'order_date_key', count(DISTINCT order_id) FROM fact WHERE order_date_key > {SPLIT_KEY}
 UNION ALL SELECT 'fact_order_summary', 'customer_sk', count(DISTINCT order_id) FROM fact WHERE customer_id NOT IN (SELECT c_custkey FROM customer)
 UNION ALL SELECT 'fact_order_summary', 'geography_sk', count(DISTINCT order_id) FROM fact WHERE city NOT IN (SELECT n_name FROM nation)""")
PARTS["repeated"] = "SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"


def _unique(table: str, keys: str, source: str) -> str:
    grouped = f"SELECT count(*) AS n FROM {source} GROUP BY {keys.replace(',', ', ')} HAVING count(*) > 1"
    return f"SELECT '{table}' AS table_name, '{keys}' AS unique_key, count(*) AS repeated_keys, coalesce(sum(n), 0) AS rows_involved FROM ({grouped})"


PARTS["g_orders"] = "SELECT DISTINCT order_id, order_date_key, customer_id, geography_sk FROM fact"
PARTS["g_monthly"] = "SELECT year_month_key, product_id AS product_sk FROM monthly"
PARTS["g_dates"] = "SELECT CAST(unnest(generate_series(DATE '1994-01-01', DATE '2002-12-31', INTERVAL 1 DAY)) AS DATE) AS full_date"
PARTS["g_cities"] = "SELECT n_name AS city_name FROM nation"
add("unique_keys", "table_name:s unique_key:s repeated_keys:i rows_involved:i", " UNION ALL ".join([
    _unique("lineitem", "l_orderkey,l_linenumber", "lineitem"),
    _unique("dim_customer", "customer_id", "dimc"),
    _unique("dim_product", "product_id", "dimp"),
    _unique("dim_geography", "city_name", "g_cities"),
    _unique("dim_date", "full_date", "g_dates"),
    _unique("fact_order_summary", "order_id", "g_orders"),
    _unique("fact_monthly_product_performance", "year_month_key,product_sk", "g_monthly"),
]))
add("year_partition_layout", "order_year:i row_count:i", "SELECT year_number AS order_year, count(*) AS row_count FROM fact GROUP BY 1")
add("mask_email", "customer_id:i email:s", "SELECT customer_id, email[1] || 'XXX@XXXX.com' AS email FROM dimc")
add("row_filter_city", "order_item_id:i net_revenue:d", "SELECT * FROM fact WHERE region = 'ASIA'")


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)

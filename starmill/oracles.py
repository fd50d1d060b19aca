"""The same results in plain SQL over the sample tables, as an independent check.

Written for DuckDB: sums are cast back to 64 bits or doubles, divisors are
guarded, and every LIMIT has a full tie-break.
"""

from __future__ import annotations

YEAR = 1998

# Clean mapping ---------------------------------------------------------------

CUSTOMER = """
customer_dim AS (
  SELECT c_custkey AS customer_id,
         CASE WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
         list_extract(['0-17','18-25','26-35','36-45','46-50','51-55','55+'], c_custkey % 7 + 1) AS age_group,
         c_mktsegment AS occupation,
         list_extract(['A','B','C'], c_nationkey % 3 + 1) AS city_category,
         list_extract(['0','1','2','3','4+'], c_custkey % 5 + 1) AS stay_in_current_city_years,
         CASE WHEN c_custkey % 4 < 2 THEN 'Single' ELSE 'Married' END AS marital_status
  FROM customer)"""

ITEM = """
item AS (
  SELECT 'P' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS product_id,
         p_type AS product_category,
         CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
         CAST(p_partkey % 25 AS INTEGER) AS store_id,
         CAST(p_partkey % (SELECT count(*) FROM supplier) AS INTEGER) AS supplier_id
  FROM part)"""

MOVEMENT = """
movement AS (
  SELECT l_orderkey * 10 + l_linenumber AS order_id,
         o_custkey AS customer_id,
         'P' || lpad(CAST(l_partkey AS VARCHAR), 8, '0') AS product_id,
         CAST(o_orderdate AS DATE) AS date_id,
         CAST(l_quantity AS INTEGER) AS quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

SALE = """
sale AS (
  SELECT order_id, customer_id, m.product_id, date_id, quantity, i.unit_price,
         i.store_id, i.supplier_id,
         CAST(quantity * i.unit_price AS DECIMAL(10,2)) AS total_amount
  FROM movement m JOIN item i ON m.product_id = i.product_id)"""

_ATTRIBUTES = """
         CAST(isodow(date_id) AS INTEGER) AS day_of_week,
         CASE WHEN isodow(date_id) >= 6 THEN 1 ELSE 0 END AS is_weekend,
         CAST(weekofyear(date_id) AS INTEGER) AS week_of_year,
         CAST(day(date_id) AS INTEGER) AS day_of_month,
         CAST(month(date_id) AS INTEGER) AS month,
         monthname(date_id) AS month_name,
         CAST(quarter(date_id) AS INTEGER) AS quarter,
         CAST(year(date_id) AS INTEGER) AS year,
         CASE WHEN month(date_id) IN (12, 1, 2) THEN 'Winter'
              WHEN month(date_id) <= 5 THEN 'Spring'
              WHEN month(date_id) <= 8 THEN 'Summer' ELSE 'Fall' END AS season,
         0 AS is_holiday"""

CAL = f"""
cal AS (
  SELECT date_id, {_ATTRIBUTES}
  FROM (SELECT DISTINCT date_id FROM movement))"""

SHOP = """
shop AS (
  SELECT n_nationkey AS store_id, n_name AS store_name, r_name AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

VENDOR = """
vendor AS (
  SELECT CAST(s_suppkey AS INTEGER) AS supplier_id, s_name AS supplier_name FROM supplier)"""

STAR = ",".join([CUSTOMER, ITEM, MOVEMENT, SALE, CAL, SHOP, VENDOR])

# Dirty mapping ---------------------------------------------------------------

RAW_CUSTOMER = """
raw_customer_one AS (
  SELECT c_custkey AS customer_id,
         CASE WHEN c_custkey % 41 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
         CASE WHEN c_custkey % 53 <> 0 THEN list_extract(
           ['0-17','18-25','26-35','36-45','46-50','51-55','55+'], c_custkey % 7 + 1) END AS age,
         c_mktsegment AS occupation,
         CASE WHEN c_custkey % 37 <> 0 THEN list_extract([' a ',' b ',' c '], c_nationkey % 3 + 1) END AS city_category,
         list_extract(['0','1','2','3','4+'], c_custkey % 5 + 1) AS stay_in_current_city_years,
         CASE WHEN c_custkey % 43 = 0 THEN NULL WHEN c_custkey % 4 < 2 THEN 0 ELSE 1 END AS marital_status,
         1 AS seq
  FROM customer),
raw_customer AS (
  SELECT * FROM raw_customer_one
  UNION ALL
  SELECT customer_id, gender, '99', occupation, 'z', stay_in_current_city_years, marital_status, 2
  FROM raw_customer_one WHERE customer_id % 50 = 0)"""

CLEAN_CUSTOMER = RAW_CUSTOMER + """,
clean_customer AS (
  SELECT customer_id,
         CASE gender WHEN 'M' THEN 'Male' WHEN 'F' THEN 'Female' ELSE 'Unknown' END AS gender,
         coalesce(age, 'Unknown') AS age,
         age AS age_group,
         occupation,
         coalesce(trim(upper(city_category)), 'Unknown') AS city_category,
         stay_in_current_city_years,
         CASE marital_status WHEN 0 THEN 'Single' WHEN 1 THEN 'Married' END AS marital_status
  FROM raw_customer
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY seq) = 1)"""


def _title(column: str) -> str:
    return (
        f"regexp_replace(array_to_string(list_transform(regexp_extract_all({column}, "
        r"'(\p{L}+|\P{L}+)', 1), lambda x: CASE x[1:1] WHEN 'ß' THEN 'Ss' ELSE upper(x[1:1]) END || lower(x[2:])), ''), "
        r"'^\s+|\s+$', '', 'g')"
    )


RAW_PRODUCT = """
raw_product_one AS (
  SELECT p_partkey, 'P' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS product_id,
         ' ' || lower(p_type) AS product_category,
         CASE WHEN p_partkey % 29 = 0 THEN 'n/a'
              ELSE CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR) END AS price,
         CAST(n_nationkey AS INTEGER) AS store_id,
         '  ' || lower(replace(n_name, '_', '-')) || ' ' AS store_name,
         CAST(s_suppkey AS INTEGER) AS supplier_id,
         lower(s_name) AS supplier_name,
         1 AS seq
  FROM part
  JOIN nation ON n_nationkey = p_partkey % 25
  JOIN supplier ON s_suppkey = p_partkey % (SELECT count(*) FROM supplier)),
raw_product AS (
  SELECT * FROM raw_product_one
  UNION ALL
  SELECT p_partkey, product_id, 'dup', '1.00', store_id, store_name, supplier_id, supplier_name, 2
  FROM raw_product_one WHERE p_partkey % 40 = 0),
known_product AS (
  SELECT *, try_cast(price AS DECIMAL(20,6)) AS known_price
  FROM raw_product
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY seq) = 1)"""

CLEAN_PRODUCT = RAW_PRODUCT + f""",
clean_product AS (
  SELECT product_id, {_title("product_category")} AS product_category,
         CAST(coalesce(known_price, (SELECT median(known_price) FROM known_product)) AS DECIMAL(10,2)) AS unit_price,
         store_id, supplier_id,
         {_title("store_name")} AS store_name,
         {_title("supplier_name")} AS supplier_name
  FROM known_product)"""

RAW_TX = """
raw_tx AS (
  SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS order_id,
         CASE WHEN l_orderkey % 71 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
         CASE WHEN l_orderkey % 67 <> 0 THEN 'P' || lpad(CAST(l_partkey AS VARCHAR), 8, '0') END AS product_id,
         CASE WHEN l_orderkey % 97 = 0 THEN 'n/a' WHEN l_orderkey % 89 = 0 THEN '-1'
              WHEN l_orderkey % 83 = 0 THEN NULL WHEN l_orderkey % 79 = 0 THEN '0'
              WHEN l_orderkey % 73 = 0 THEN '99999999999'
              ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
         CASE WHEN l_orderkey % 61 = 0 THEN 'not-a-date'
              ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS date_text,
         l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
typed_tx AS (
  SELECT CAST(order_id AS BIGINT) AS order_id, CAST(customer_id AS BIGINT) AS customer_id, product_id,
         try_cast(date_text AS DATE) AS date_id, try_cast(quantity AS DECIMAL(20,6)) AS quantity,
         l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate
  FROM raw_tx),
first_tx AS (
  SELECT order_id, customer_id, product_id, date_id, quantity
  FROM typed_tx
  QUALIFY row_number() OVER (
    PARTITION BY order_id
    ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) = 1)"""

CLEAN_TX = RAW_TX + """,
usable_tx AS (
  SELECT order_id, customer_id, product_id, date_id, try_cast(coalesce(quantity, 1) AS INTEGER) AS quantity
  FROM first_tx WHERE customer_id IS NOT NULL AND product_id IS NOT NULL),
clean_tx AS (SELECT * FROM usable_tx WHERE quantity > 0)"""

DIRTY_CAL = f"""
dirty_cal AS (
  SELECT date_id, {_ATTRIBUTES}
  FROM (SELECT DISTINCT date_id FROM clean_tx WHERE date_id IS NOT NULL))"""

# Shorthand -------------------------------------------------------------------


def _money(column: str = "total_amount") -> str:
    return f"CAST(sum({column}) AS DOUBLE)"


QTY = "CAST(sum(quantity) AS BIGINT)"
ORDERS = "count(DISTINCT order_id)"
MEAN = "CAST(sum(total_amount) AS DOUBLE) / count(total_amount)"
DAY_TYPE = "CASE WHEN is_weekend = 1 THEN 'Weekend' ELSE 'Weekday' END"
IN_YEAR = f"year = {YEAR}"


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


def _star(body: str) -> str:
    return _with(STAR, body)


def _growth(cur: str, prev: str) -> str:
    return f"CAST(round(CAST(({cur} - {prev}) / nullif({prev}, 0) AS DECIMAL(30,9)) * 100, 2) AS DOUBLE)"


DAILY = """,
daily AS (
  SELECT product_id, product_category, date_id, sum(total_amount) AS amount
  FROM sale JOIN item USING (product_id)
  GROUP BY ALL),
product_mean AS (
  SELECT product_id, count(amount) AS n, sum(amount) AS total FROM daily GROUP BY product_id),
labelled AS (
  SELECT product_id, product_category, date_id,
         CAST(amount AS DOUBLE) AS daily_sales,
         CAST(total AS DOUBLE) / n AS avg_daily_sales,
         CAST(round(CAST(CAST(amount * n AS DOUBLE) / nullif(CAST(total AS DOUBLE), 0) AS DECIMAL(30,9)), 2) AS DOUBLE) AS sales_multiplier,
         CASE WHEN amount * n > 2 * total THEN 'SPIKE/OUTLIER' ELSE 'NORMAL' END AS anomaly_flag
  FROM daily JOIN product_mean USING (product_id))"""

STORE_QUARTERS = f"""
SELECT store_id, store_name, year, quarter, {_money()} AS total_sales, {QTY} AS total_qty
FROM sale JOIN shop USING (store_id) JOIN cal USING (date_id)
GROUP BY ALL"""

_ROLLUP_KEYS = "year, store_name, supplier_name, product_id"


def _rollup(extra: str = "") -> str:
    return _star(
        f"""
SELECT {_ROLLUP_KEYS}, {_money()} AS total_revenue, {QTY} AS total_quantity{extra}
FROM sale JOIN cal USING (date_id) JOIN shop USING (store_id) JOIN vendor USING (supplier_id)
GROUP BY ROLLUP ({_ROLLUP_KEYS})"""
    )


def _count(table: str, name: str | None = None) -> str:
    return f"SELECT '{name or table}' AS table_name, count(*) AS row_count FROM {table}"


def _pk(name: str, table: str, key: str) -> str:
    return f"""
SELECT '{name}' AS table_name, count(*) AS duplicate_keys,
       CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS surplus_rows
FROM (SELECT count(*) AS n FROM {table} GROUP BY {key} HAVING count(*) > 1)"""


def _nulls(name: str, table: str, columns: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, '{column}' AS column_name, "
        f"count(*) FILTER ({column} IS NULL) AS null_rows FROM {table}"
        for column in columns
    )


# Dimensions with gaps, for the foreign-key checks.
GAPS = """,
some_customers AS (SELECT * FROM customer_dim WHERE customer_id % 10 <> 9),
some_shops AS (SELECT * FROM shop WHERE store_id % 5 <> 4)"""


def _orphans(key: str, dim: str) -> str:
    return f"""
SELECT '{key}' AS foreign_key, count(*) AS orphan_rows
FROM sale WHERE {key} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{key} = sale.{key})"""


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    # Scans, loads and dimensions
    sql["scan_transactions_csv"] = _with(
        RAW_TX,
        """
SELECT order_id AS "orderID", customer_id AS "Customer_ID", product_id AS "Product_ID",
       nullif(quantity, 'n/a') AS quantity, date_text AS date
FROM raw_tx""",
    )
    sql["scan_customers"] = _with(
        RAW_CUSTOMER,
        """
SELECT CAST(customer_id AS VARCHAR) AS "Customer_ID", gender AS "Gender", age AS "Age", occupation AS "Occupation",
       city_category AS "City_Category", stay_in_current_city_years AS "Stay_In_Current_City_Years",
       CAST(marital_status AS VARCHAR) AS "Marital_Status"
FROM raw_customer""",
    )
    sql["scan_products"] = sql["scan_products_reordered"] = _with(
        RAW_PRODUCT,
        """
SELECT product_id AS "Product_ID", product_category AS "Product_Category", nullif(price, 'n/a') AS "price$",
       CAST(store_id AS VARCHAR) AS "storeID", CAST(supplier_id AS VARCHAR) AS "supplierID",
       store_name AS "storeName", supplier_name AS "supplierName"
FROM raw_product""",
    )
    loaded = ",".join([CLEAN_CUSTOMER, CLEAN_PRODUCT, CLEAN_TX, DIRTY_CAL])
    sql["load_dimensions"] = _with(
        loaded,
        "\nUNION ALL\n".join(
            [
                _count("clean_customer", "dim_customer"),
                _count("(SELECT DISTINCT store_id, store_name FROM clean_product)", "dim_store"),
                _count("(SELECT DISTINCT supplier_id, supplier_name FROM clean_product)", "dim_supplier"),
                _count("clean_product", "dim_product"),
                _count("dirty_cal", "dim_date"),
            ]
        ),
    )
    by_half = {
        "dim_customer": ("clean_customer", "customer_id % 2 = 0", "gender"),
        "dim_store": ("(SELECT DISTINCT store_id, store_name FROM clean_product)", "store_id % 2 = 0", "store_name"),
        "dim_supplier": ("(SELECT DISTINCT supplier_id, supplier_name FROM clean_product)", "supplier_id % 2 = 0", "supplier_name"),
        "dim_product": ("clean_product", "CAST(substr(product_id, 2) AS BIGINT) % 2 = 0", "product_category"),
        "dim_date": ("dirty_cal", "day(date_id) % 2 = 0", "season"),
    }
    sql["load_dimensions_twice"] = _with(
        loaded,
        "\nUNION ALL\n".join(
            f"SELECT '{name}' AS table_name, count(*) AS row_count, count(*) FILTER (NOT ({half}) AND {label} IS NOT NULL) AS late_count, "
            f"count(*) FILTER ({half}) AS rejected_count FROM {rows}"
            for name, (rows, half, label) in by_half.items()
        ),
    )
    sql["warehouse_build_twice"] = (
        sql["load_dimensions"]
        + "\nUNION ALL\n"
        + _count("clean_tx", "fact_sales")
        + "\nUNION ALL\n"
        + _count("(SELECT 1 FROM typed_tx JOIN clean_product USING (product_id))", "fact_sales_enriched")
    )
    sql["fact_sales_load"] = _with(CLEAN_TX, "SELECT * FROM clean_tx")
    enriched = """
SELECT order_id, customer_id, product_id, date_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
       store_id, supplier_id, CAST(total_amount AS DOUBLE) AS total_amount
FROM sale"""
    sql["table_preview"] = _star(
        enriched
        + """
ORDER BY order_id, customer_id, product_id, date_id, quantity, unit_price, store_id, supplier_id, total_amount
LIMIT 20"""
    )
    sql["table_count"] = _star("SELECT count(*) AS row_count FROM sale")
    sql["describe_table"] = (
        "SELECT column_name AS col_name, CASE column_type WHEN 'VARCHAR' THEN 'string' "
        "ELSE lower(column_type) END AS data_type, CAST(NULL AS VARCHAR) AS comment "
        f"FROM (DESCRIBE {_with(CLEAN_CUSTOMER, 'SELECT * FROM clean_customer')})"
    )
    sql["dim_customer"] = _with(CLEAN_CUSTOMER, "SELECT * FROM clean_customer")
    sql["dim_product"] = _with(
        CLEAN_PRODUCT,
        "SELECT product_id, product_category, CAST(unit_price AS DOUBLE) AS unit_price FROM clean_product",
    )
    sql["dim_store"] = _with(
        CLEAN_PRODUCT,
        "SELECT DISTINCT store_id, store_name, CAST(NULL AS VARCHAR) AS region FROM clean_product",
    )
    sql["dim_supplier"] = _with(
        CLEAN_PRODUCT, "SELECT DISTINCT supplier_id, supplier_name FROM clean_product"
    )
    sql["dim_date"] = _with(CLEAN_TX + "," + DIRTY_CAL, "SELECT * FROM dirty_cal")
    sql["product_master"] = _with(
        CLEAN_PRODUCT,
        """
SELECT product_id, product_category, CAST(unit_price AS DOUBLE) AS unit_price, store_id, supplier_id
FROM clean_product""",
    )

    # Cleaning
    sql["clean_customers"] = sql["dim_customer"]
    sql["clean_products"] = _with(
        CLEAN_PRODUCT, "SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price) FROM clean_product"
    )
    sql["coerce_numeric"] = _with(
        RAW_TX,
        """
SELECT CAST(order_id AS BIGINT) AS order_id, quantity AS quantity_text,
       CAST(try_cast(quantity AS DECIMAL(20,6)) AS DOUBLE) AS quantity
FROM raw_tx""",
    )
    sql["coerce_date"] = _with(
        RAW_TX,
        """
SELECT CAST(order_id AS BIGINT) AS order_id,
       coalesce(CASE CAST(order_id AS BIGINT) % 3 WHEN 1 THEN strftime(try_cast(date_text AS DATE), '%-m/%-d/%Y')
                WHEN 2 THEN strftime(try_cast(date_text AS DATE), '%Y%m%d') END, date_text) AS date_text,
       try_cast(date_text AS DATE) AS date_id
FROM raw_tx""",
    )
    sql["impute_median_price"] = _with(
        CLEAN_PRODUCT,
        """
SELECT c.product_id, CAST(k.known_price AS DOUBLE) AS delivered_price,
       CAST(c.unit_price AS DOUBLE) AS unit_price
FROM clean_product c JOIN known_product k USING (product_id)""",
    )
    sql["clean_transactions"] = sql["fact_sales_load"]
    sql["rejected_transactions"] = _with(CLEAN_TX, "SELECT * FROM usable_tx WHERE quantity <= 0 OR quantity IS NULL")
    sql["cleaning_report"] = _with(
        loaded,
        "\nUNION ALL\n".join(
            [
                _count("clean_customer", "customers"),
                _count("clean_product", "products"),
                _count("clean_tx", "transactions"),
            ]
        ),
    )
    sql["dedup_keep_first"] = _with(
        RAW_TX, "SELECT * REPLACE (CAST(quantity AS DOUBLE) AS quantity) FROM first_tx"
    )
    sql["title_case"] = f"""
SELECT doc_id, {_title("text")} AS title FROM documents"""

    # Enrichment, batch and streaming
    sql["fact_enriched"] = _star(enriched)
    sql["stream_enrich"] = sql["stream_parked"] = sql["fact_enriched"]
    sql["stream_enrich_clean"] = _with(
        ",".join([RAW_TX, CLEAN_PRODUCT]),
        """
SELECT DISTINCT order_id, CAST(1 AS INTEGER) AS is_copy
FROM typed_tx JOIN clean_product USING (product_id)
WHERE customer_id IS NOT NULL AND try_cast(coalesce(quantity, 1) AS INTEGER) > 0""",
    )
    sql["stream_unmatched"] = _star(
        """
SELECT * FROM movement
WHERE product_id NOT IN (SELECT product_id FROM item WHERE CAST(substr(product_id, 2) AS BIGINT) % 10 <> 9)"""
    )
    sql["stream_batch_counts"] = _star(
        """
SELECT CAST(1 AS INTEGER) AS several_batches, count(*) AS processed,
       count(*) FILTER (product_id IN (SELECT product_id FROM item WHERE CAST(substr(product_id, 2) AS BIGINT) % 10 <> 9))
         AS joined
FROM movement"""
    )
    sql["stream_store_quarterly"] = _star(STORE_QUARTERS)

    sql["stream_bounded_batches"] = _with(
        RAW_TX, "SELECT count(*) AS processed, CAST(1 AS INTEGER) AS within_bound, CAST(1 AS INTEGER) AS several_batches FROM raw_tx"
    )
    sql["enrich_case_insensitive"] = _star(
        """
SELECT order_id, customer_id, CASE WHEN order_id % 3 = 0 THEN lower(product_id) ELSE product_id END AS product_id,
       date_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price, store_id, supplier_id, CAST(total_amount AS DOUBLE) AS total_amount
FROM sale"""
    )
    sql["catalog_store_view"] = _star(STORE_QUARTERS)
    sql["catalog_defaults"] = _star(
        """
SELECT year, CAST(0 AS INTEGER) AS is_holiday, count(*) AS rows, count(*) AS stamped FROM movement JOIN cal USING (date_id) GROUP BY year"""
    )

    # Analytical queries
    sql["q01_top_products_daytype_monthly"] = _star(
        f"""
SELECT year, month, month_name, is_weekend, {DAY_TYPE} AS day_type, product_id, product_category,
       {_money()} AS total_revenue, {QTY} AS total_quantity
FROM sale JOIN cal USING (date_id) JOIN item USING (product_id)
WHERE {IN_YEAR}
GROUP BY ALL
ORDER BY month, is_weekend, total_revenue DESC, product_id
LIMIT 60"""
    )
    customer_totals = f"""{_money()} AS total_purchase_amount,
       count(DISTINCT customer_id) AS customer_count, {MEAN} AS avg_purchase_amount"""
    sql["q02_demographics_city"] = _star(
        f"""
SELECT gender, age_group, city_category, {customer_totals}
FROM sale JOIN customer_dim USING (customer_id)
GROUP BY ALL"""
    )
    sql["bucketed_demographics"] = sql["q02_demographics_city"]
    sql["q03_category_by_occupation"] = _star(
        f"""
SELECT occupation, product_category, {_money()} AS total_sales, {QTY} AS total_quantity,
       {ORDERS} AS total_orders
FROM sale JOIN customer_dim USING (customer_id) JOIN item USING (product_id)
GROUP BY ALL"""
    )
    sql["numbered_category_by_occupation"] = sql["q03_category_by_occupation"]
    sql["q04_gender_age_quarterly"] = _star(
        f"""
SELECT year, quarter, gender, age_group, {_money()} AS total_purchase_amount, {ORDERS} AS total_orders
FROM sale JOIN customer_dim USING (customer_id) JOIN cal USING (date_id)
WHERE {IN_YEAR}
GROUP BY ALL"""
    )

    def top_by_category(trait: str, total: str, rank: str) -> str:
        return _star(
            f"""
SELECT product_category, {trait}, {_money()} AS {total},
       CAST(rank() OVER (PARTITION BY product_category ORDER BY sum(total_amount) DESC) AS INTEGER) AS {rank}
FROM sale JOIN customer_dim USING (customer_id) JOIN item USING (product_id)
GROUP BY product_category, {trait}
QUALIFY {rank} <= 5"""
        )

    sql["q05_top_occupations_by_category"] = top_by_category("occupation", "total_sales", "sales_rank")
    sql["q06_city_marital_h2"] = _star(
        f"""
SELECT year, month, month_name, city_category, marital_status,
       {_money()} AS total_purchase_amount, {ORDERS} AS total_orders
FROM sale JOIN customer_dim USING (customer_id) JOIN cal USING (date_id)
WHERE {IN_YEAR} AND month > 6
GROUP BY ALL"""
    )
    sql["q07_stay_gender_avg"] = _star(
        f"""
SELECT stay_in_current_city_years, gender, {customer_totals}
FROM sale JOIN customer_dim USING (customer_id)
GROUP BY ALL"""
    )
    sql["q08_top_cities_by_category"] = top_by_category("city_category", "total_revenue", "city_rank")
    sql["q09_monthly_growth_category"] = _star(
        f""",
monthly AS (
  SELECT year, month, month_name, product_category, {_money()} AS cur
  FROM sale JOIN cal USING (date_id) JOIN item USING (product_id)
  WHERE {IN_YEAR}
  GROUP BY ALL),
paired AS (
  SELECT *, lag(cur) OVER (PARTITION BY product_category ORDER BY year, month) AS prev FROM monthly)
SELECT year, month, month_name, product_category, cur AS current_month_sales,
       prev AS previous_month_sales, {_growth("cur", "prev")} AS growth_percentage
FROM paired"""
    )
    sql["q10_weekend_by_age"] = _star(
        f"""
SELECT age_group, {DAY_TYPE} AS day_type, {_money()} AS total_sales, {ORDERS} AS total_orders,
       {MEAN} AS avg_order_value
FROM sale JOIN customer_dim USING (customer_id) JOIN cal USING (date_id)
WHERE {IN_YEAR}
GROUP BY age_group, is_weekend"""
    )
    sql["q11_top5_products_daytype"] = _star(
        f"""
SELECT year, month, {DAY_TYPE} AS day_type, product_id, product_category, {_money()} AS revenue,
       CAST(rank() OVER (PARTITION BY year, month, is_weekend ORDER BY sum(total_amount) DESC) AS INTEGER) AS product_rank
FROM sale JOIN cal USING (date_id) JOIN item USING (product_id)
WHERE {IN_YEAR}
GROUP BY year, month, is_weekend, product_id, product_category
QUALIFY product_rank <= 5"""
    )
    sql["q12_store_quarterly_growth"] = _star(
        f""",
quarterly AS (
  SELECT store_id, store_name, quarter, {_money()} AS cur
  FROM sale JOIN shop USING (store_id) JOIN cal USING (date_id)
  WHERE {IN_YEAR}
  GROUP BY ALL),
paired AS (SELECT *, lag(cur) OVER (PARTITION BY store_id ORDER BY quarter) AS prev FROM quarterly)
SELECT store_id, store_name, quarter, cur AS quarterly_revenue, prev AS previous_quarter_revenue,
       {_growth("cur", "prev")} AS growth_rate
FROM paired"""
    )
    sql["q13_supplier_store_product"] = _star(
        f"""
SELECT shop.store_id, store_name, vendor.supplier_id, supplier_name, product_id, product_category,
       {_money()} AS total_sales, {QTY} AS total_quantity
FROM sale JOIN shop ON sale.store_id = shop.store_id JOIN vendor ON sale.supplier_id = vendor.supplier_id
JOIN item USING (product_id)
GROUP BY ALL"""
    )
    sql["q14_seasonal_products"] = _star(
        f"""
SELECT season, product_id, product_category, {_money()} AS total_sales, {QTY} AS total_quantity,
       {ORDERS} AS total_orders
FROM sale JOIN cal USING (date_id) JOIN item USING (product_id)
GROUP BY ALL"""
    )
    sql["q15_store_supplier_volatility"] = _star(
        f""",
monthly AS (
  SELECT store_id, store_name, supplier_id, supplier_name, year, month, {_money()} AS cur
  FROM sale JOIN shop USING (store_id) JOIN vendor USING (supplier_id) JOIN cal USING (date_id)
  GROUP BY ALL),
paired AS (
  SELECT *, lag(cur) OVER (PARTITION BY store_id, supplier_id ORDER BY year, month) AS prev FROM monthly)
SELECT store_id, store_name, supplier_id, supplier_name, year, month, cur AS monthly_revenue,
       prev AS previous_month_revenue, {_growth("cur", "prev")} AS volatility_percentage
FROM paired"""
    )
    sql["q16_product_affinity"] = _star(
        f"""
SELECT a.product_id AS product1, b.product_id AS product2,
       count(DISTINCT a.customer_id) AS times_bought_together,
       {_money("a.total_amount + b.total_amount")} AS combined_revenue
FROM sale a JOIN sale b
  ON a.customer_id = b.customer_id AND a.date_id = b.date_id AND a.product_id < b.product_id
GROUP BY ALL
ORDER BY times_bought_together DESC, sum(a.total_amount + b.total_amount) DESC, product1, product2
LIMIT 5"""
    )
    sql["q17_rollup"] = _rollup()
    sql["q17_rollup_grouping_id"] = _rollup(
        f", CAST(grouping_id({_ROLLUP_KEYS}) AS BIGINT) AS grouping_id"
    )
    sql["q18_half_year_split"] = _star(
        f"""
SELECT product_id, product_category,
       CAST(coalesce(sum(total_amount) FILTER (month <= 6), 0) AS DOUBLE) AS h1_revenue,
       CAST(coalesce(sum(total_amount) FILTER (month > 6), 0) AS DOUBLE) AS h2_revenue,
       CAST(coalesce(sum(quantity) FILTER (month <= 6), 0) AS BIGINT) AS h1_quantity,
       CAST(coalesce(sum(quantity) FILTER (month > 6), 0) AS BIGINT) AS h2_quantity,
       {_money()} AS yearly_revenue, {QTY} AS yearly_quantity
FROM sale JOIN cal USING (date_id) JOIN item USING (product_id)
WHERE {IN_YEAR}
GROUP BY product_id, product_category"""
    )
    sql["product_daily_stats"] = _star(
        DAILY
        + """
SELECT product_id, product_category,
       CAST(sum(amount) AS DOUBLE) / count(amount) AS avg_daily_sales,
       round(stddev_pop(CAST(amount AS DOUBLE)), 4) AS stddev_sales
FROM daily
GROUP BY ALL"""
    )
    sql["q19_daily_labelled"] = _star(DAILY + "\nSELECT * FROM labelled")
    sql["q19_revenue_spikes"] = _star(
        DAILY
        + """
SELECT * FROM labelled
WHERE anomaly_flag <> 'NORMAL'
ORDER BY sales_multiplier DESC, daily_sales DESC, product_id, date_id
LIMIT 50"""
    )
    sql["q20_store_quarterly_sales"] = _star(STORE_QUARTERS)
    sql["q20_view_preview"] = _star(STORE_QUARTERS + "\nORDER BY store_name, year, quarter, store_id LIMIT 20")

    # Data quality
    sql["fk_orphans"] = _star(
        GAPS
        + "\nUNION ALL\n".join(
            [
                _orphans("customer_id", "some_customers"),
                _orphans("product_id", "item"),
                _orphans("store_id", "some_shops"),
                _orphans("supplier_id", "vendor"),
                _orphans("date_id", "cal"),
            ]
        )
    )
    sql["pk_violations"] = _star(
        "\nUNION ALL\n".join(
            [
                _pk("dim_date", "cal", "date_id"),
                _pk("dim_customer", "customer_dim", "customer_id"),
                _pk("dim_supplier", "vendor", "supplier_id"),
                _pk("dim_store", "shop", "store_id"),
                _pk("dim_product", "item", "product_id"),
                _pk("fact_sales", "movement", "order_id"),
            ]
        )
    )
    dirty_fact = """,
dirty_fact AS (
  SELECT order_id, customer_id, product_id, date_id, try_cast(quantity AS INTEGER) AS quantity, unit_price,
         try_cast(quantity * unit_price AS DECIMAL(10,2)) AS total_amount
  FROM typed_tx JOIN clean_product USING (product_id))"""
    sql["not_null_violations"] = _with(
        loaded + dirty_fact,
        "\nUNION ALL\n".join(
            [
                _nulls("dim_date", "dirty_cal", ["date_id", "day_of_week", "is_weekend", "month", "year"]),
                _nulls("dim_customer", "clean_customer", ["customer_id"]),
                _nulls("dim_supplier", "clean_product", ["supplier_id"]),
                _nulls("dim_store", "clean_product", ["store_id"]),
                _nulls("dim_product", "clean_product", ["product_id"]),
                _nulls(
                    "fact_sales",
                    "dirty_fact",
                    ["order_id", "customer_id", "product_id", "date_id", "quantity", "unit_price", "total_amount"],
                ),
            ]
        ),
    )
    sql["fk_set_null"] = _star(
        GAPS
        + """
SELECT order_id, sale.customer_id, product_id, date_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
       s.store_id, supplier_id, CAST(total_amount AS DOUBLE) AS total_amount,
       CASE WHEN c.customer_id IS NULL THEN 1 ELSE 0 END AS customer_missing,
       0 AS product_missing, 0 AS date_missing
FROM sale LEFT JOIN some_customers c ON c.customer_id = sale.customer_id
LEFT JOIN some_shops s ON s.store_id = sale.store_id"""
    )
    sql["completion_report"] = _star(
        f""",
view_rows AS ({STORE_QUARTERS}),
counted AS (
"""
        + "\nUNION ALL\n".join(
            [
                _count("customer_dim", "dim_customer"),
                _count("shop", "dim_store"),
                _count("vendor", "dim_supplier"),
                _count("item", "dim_product"),
                _count("cal", "dim_date"),
                _count("movement", "fact_sales"),
                _count("sale", "fact_sales_enriched"),
                _count("view_rows", "store_quarterly_sales"),
            ]
        )
        + """)
SELECT *, CASE WHEN row_count > 0 THEN 1 ELSE 0 END AS is_complete FROM counted"""
    )
    return sql

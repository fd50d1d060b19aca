"""Explicit schemas of the inputs and of the warehouse tables."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

PRICE = DecimalType(10, 2)
# Text is coerced to this before any rounding, so "3.0" counts as 3.
COERCED = DecimalType(20, 6)


def _columns(**types) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in types.items()])


# Column names of the delivered files, in file order. Columns
# that may hold dirty text are read as strings and coerced by the cleaning.
CUSTOMER_FILE = _columns(
    Customer_ID=StringType(),
    Gender=StringType(),
    Age=StringType(),
    Occupation=StringType(),
    City_Category=StringType(),
    Stay_In_Current_City_Years=StringType(),
    Marital_Status=StringType(),
)
PRODUCT_FILE = _columns(
    Product_ID=StringType(),
    Product_Category=StringType(),
    **{"price$": StringType()},
    storeID=StringType(),
    supplierID=StringType(),
    storeName=StringType(),
    supplierName=StringType(),
)
TRANSACTION_FILE = _columns(
    orderID=StringType(),
    Customer_ID=StringType(),
    Product_ID=StringType(),
    quantity=StringType(),
    date=StringType(),
)

# Delivered name -> warehouse name.
CUSTOMER_NAMES = {
    "Customer_ID": "customer_id",
    "Gender": "gender",
    "Age": "age",
    "Occupation": "occupation",
    "City_Category": "city_category",
    "Stay_In_Current_City_Years": "stay_in_current_city_years",
    "Marital_Status": "marital_status",
}
PRODUCT_NAMES = {
    "Product_ID": "product_id",
    "Product_Category": "product_category",
    "price$": "unit_price",
    "storeID": "store_id",
    "supplierID": "supplier_id",
    "storeName": "store_name",
    "supplierName": "supplier_name",
}
TRANSACTION_NAMES = {
    "orderID": "order_id",
    "Customer_ID": "customer_id",
    "Product_ID": "product_id",
    "quantity": "quantity",
    "date": "date_id",
}

# Columns of the warehouse tables, their keys and NOT NULL columns.
# Order and customer ids are 64 bits wide: 32 do not number 100 TB of orders.
DIM_DATE = _columns(
    date_id=DateType(),
    day_of_week=IntegerType(),
    is_weekend=IntegerType(),
    week_of_year=IntegerType(),
    day_of_month=IntegerType(),
    month=IntegerType(),
    month_name=StringType(),
    quarter=IntegerType(),
    year=IntegerType(),
    season=StringType(),
    is_holiday=IntegerType(),
)
DIM_CUSTOMER = _columns(
    customer_id=LongType(),
    gender=StringType(),
    age=StringType(),
    age_group=StringType(),
    occupation=StringType(),
    city_category=StringType(),
    stay_in_current_city_years=StringType(),
    marital_status=StringType(),
)
DIM_PRODUCT = _columns(
    product_id=StringType(), product_category=StringType(), unit_price=PRICE
)
DIM_STORE = _columns(store_id=IntegerType(), store_name=StringType(), region=StringType())
DIM_SUPPLIER = _columns(supplier_id=IntegerType(), supplier_name=StringType())
PRODUCT_MASTER = _columns(
    product_id=StringType(),
    product_category=StringType(),
    unit_price=PRICE,
    store_id=IntegerType(),
    supplier_id=IntegerType(),
)
FACT_SALES = _columns(
    order_id=LongType(),
    customer_id=LongType(),
    product_id=StringType(),
    date_id=DateType(),
    quantity=IntegerType(),
)
FACT_ENRICHED = _columns(
    order_id=LongType(),
    customer_id=LongType(),
    product_id=StringType(),
    date_id=DateType(),
    quantity=IntegerType(),
    unit_price=PRICE,
    store_id=IntegerType(),
    supplier_id=IntegerType(),
    total_amount=PRICE,
)
STORE_QUARTERS = _columns(
    store_id=IntegerType(),
    store_name=StringType(),
    year=IntegerType(),
    quarter=IntegerType(),
    total_sales=DecimalType(20, 2),
    total_qty=LongType(),
)
BATCH_TOTALS = _columns(processed=LongType(), joined=LongType())
# Where the enriched fact is stored, it is split by this column.
SALE_YEAR = "sale_year"

# Declared keys and NOT NULL columns, checked by operators.quality.
PRIMARY_KEYS = {
    "dim_date": "date_id",
    "dim_customer": "customer_id",
    "dim_supplier": "supplier_id",
    "dim_store": "store_id",
    "dim_product": "product_id",
    "fact_sales": "order_id",
}
NOT_NULL = {
    "dim_date": ["date_id", "day_of_week", "is_weekend", "month", "year"],
    "dim_customer": ["customer_id"],
    "dim_supplier": ["supplier_id"],
    "dim_store": ["store_id"],
    "dim_product": ["product_id"],
    "fact_sales": [
        "order_id",
        "customer_id",
        "product_id",
        "date_id",
        "quantity",
        "unit_price",
        "total_amount",
    ],
}
# Fact column -> (dimension, what happens to a fact row without a match).
FOREIGN_KEYS = {
    "customer_id": ("dim_customer", "restrict"),
    "product_id": ("dim_product", "restrict"),
    "store_id": ("dim_store", "set null"),
    "supplier_id": ("dim_supplier", "set null"),
    "date_id": ("dim_date", "restrict"),
}

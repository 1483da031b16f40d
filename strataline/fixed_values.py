"""Names, patterns, formats and table layouts that results depend on.

Everything here is a fixed value: a feed's column names and types, the
characters a cleaner removes, the layout of each table. Code elsewhere refers
to these by name and never repeats them.
"""

# --- fixed values: cleaning and conversion ---------------------------------
NAME_JUNK = r"[^a-zA-Z\s]"
WHITESPACE_RUN = r"\s+"
EMAIL_JUNK = r"[^\w\.\@\+\-]"
NON_DIGIT = r"\D"
PHONE_MIN_DIGITS = 10
ORDER_DATE_FORMAT = "d/M/yyyy"
UNKNOWN = "unknown"
MONEY_TYPE = "decimal(38,2)"
EARLIEST_LOAD = "1900-01-01"

# --- fixed values: service columns -----------------------------------------
CORRUPT = "_corrupt_record"
LOAD_TS = "load_ts"

# --- fixed values: feed schemas, in file order -----------------------------
CUSTOMER_FEED = """
    customer_id string,
    customer_name string,
    email string,
    phone string,
    address string,
    segment string,
    country string,
    city string,
    state string,
    postal string,
    region string,
    _corrupt_record string
"""

PRODUCT_FEED = """
    product_id string,
    category string,
    sub_category string,
    product_name string,
    state string,
    price_per_product double,
    _corrupt_record string
"""

ORDER_FEED = """
    `Row ID` bigint,
    `Order ID` string,
    `Order Date` string,
    `Ship Date` string,
    `Ship Mode` string,
    `Customer ID` string,
    `Product ID` string,
    `Quantity` bigint,
    `Price` double,
    `Discount` double,
    `Profit` double,
    _corrupt_record string
"""

# --- fixed values: schema and table names ----------------------------------
BRONZE, SILVER, GOLD = "bronze", "silver", "gold"
FILES_TABLE = "processed_files"
CUSTOMERS_TABLE = "customers"
PRODUCTS_TABLE = "products"
ORDERS_TABLE = "orders"
SILVER_PRODUCTS_TABLE = "products_1"
SILVER_ORDERS_TABLE = "order_enrich"
KPI_VIEW = "kpi_agg"

# --- fixed values: table layouts -------------------------------------------
PROCESSED_FILES = """
    file_path string,
    object string,
    modification_time timestamp
"""

BRONZE_CUSTOMERS = """
    customer_id string,
    customer_name string,
    email string,
    phone string,
    address string,
    segment string,
    country string,
    city string,
    state string,
    postal string,
    region string,
    load_ts timestamp,
    _corrupt_record string
"""

BRONZE_PRODUCTS = """
    product_id string,
    category string,
    sub_category string,
    product_name string,
    state string,
    price_per_product double,
    load_ts timestamp,
    _corrupt_record string
"""

BRONZE_ORDERS = """
    row_id bigint,
    order_id string,
    order_date string,
    ship_date string,
    ship_mode string,
    customer_id string,
    product_id string,
    quantity bigint,
    price double,
    discount double,
    profit double,
    _corrupt_record string,
    load_ts timestamp
"""

SILVER_PRODUCTS = """
    product_id string,
    category string,
    sub_category string,
    load_ts timestamp
"""

SILVER_CUSTOMERS = """
    customer_id string,
    customer_name string,
    email string,
    phone string,
    address string,
    segment string,
    country string,
    city string,
    state string,
    postal string,
    region string,
    load_ts timestamp
"""

SILVER_ORDERS = """
    row_id bigint,
    order_id string,
    order_date date,
    customer_id string,
    product_id string,
    profit decimal(38,2),
    category string,
    sub_category string,
    customer_name string,
    country string,
    load_ts timestamp
"""

GOLD_KPI = """
    order_year int,
    category string,
    sub_category string,
    customer_id string,
    total_profit decimal(38,2)
"""

"""Table contracts of the pipeline (Bronze text files, Silver and Gold tables)."""

from __future__ import annotations

from pyspark.sql.types import DecimalType, StringType, StructField, StructType

# Money is exact decimal, never float: sums of many prices must reconcile to the cent.
MONEY = DecimalType(10, 2)

# Fixed values that must equal the source system's text format and column names.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIMESTAMP_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"

ORDERS_COLUMNS = (
    "order_id",
    "customer_id",
    "order_status",
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)

ORDER_ITEMS_COLUMNS = (
    "order_id",
    "order_item_id",
    "product_id",
    "seller_id",
    "shipping_limit_date",
    "price",
    "freight_value",
)

ORDER_TIMESTAMP_COLUMNS = ORDERS_COLUMNS[3:]

SILVER_ORDERS_COLUMNS = (
    "order_id", "customer_id", "order_status", "purchase_date", *ORDER_TIMESTAMP_COLUMNS,
)

SALES_COLUMNS = (
    "order_id",
    "product_id",
    "purchase_date",
    "order_status",
    "quantity",
    "unit_price",
    "item_revenue",
    "freight_total",
)

GOLD_COLUMNS = (
    "purchase_date",
    "product_id",
    "quantity",
    "total_revenue",
    "total_freight",
    "orders_count",
)

# Period the order data is expected to cover; dates outside it are a WARNING.
DEFAULT_PERIOD = ("2016-09-01", "2018-10-31")

# Order statuses that count as a sale in Gold. One parameter, passed everywhere.
DEFAULT_VALID_SALE_STATUSES = ("delivered",)


def all_text(columns) -> StructType:
    """Bronze schema: every column text and nullable, nothing inferred."""
    return StructType([StructField(c, StringType(), True) for c in columns])


ORDERS_BRONZE = all_text(ORDERS_COLUMNS)
ORDER_ITEMS_BRONZE = all_text(ORDER_ITEMS_COLUMNS)

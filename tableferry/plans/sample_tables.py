"""Repeatable sample tables of any size, made in parallel from a range or any frame of ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions.draws import (
    days_before,
    draw_decimal,
    draw_int,
    filled,
    iso_text,
    pick,
    pick_some,
    sub_key,
)
from tableferry.sources.catalog import Definition

BASE_DATE = "2025-01-01"

# The vocabulary, text forms and ranges of the sample tables.
FIRST_NAMES = ["John", "Jane", "Michael", "Sarah", "David", "Emily", "Robert", "Lisa"]
LAST_NAMES = ["Smith", "Johnson", "Williams", "Brown", "Jones", "Garcia", "Miller", "Davis"]
COUNTRIES = ["USA", "Canada", "UK", "Germany", "France"]
STATUSES = ["pending", "processing", "shipped", "delivered", "cancelled"]
PAYMENTS = ["credit_card", "debit_card", "paypal", "bank_transfer"]
CITIES = ["New York", "Los Angeles", "Chicago", "Houston", "Phoenix"]
STATES = ["NY", "CA", "IL", "TX", "AZ"]
CATEGORIES = ["Electronics", "Clothing", "Home & Garden", "Sports", "Books"]
BRANDS = ["BrandA", "BrandB", "BrandC", "BrandD", "BrandE"]
TAGS = ["new", "sale", "featured", "popular", "clearance"]
EMAIL = "customer{}@example.com"
PHONE = "+1-555-{}-{}"
STREET = "{} Main St"
PRODUCT_NAME = "Product {}"
DESCRIPTION = "High quality product number {} with excellent features"
WHOLE = {
    "phone": (1000, 9999),
    "registration_days": (1, 365),
    "order_days": (1, 180),
    "street": (100, 9999),
    "zip": (10000, 99999),
    "product_id": (1, 100),
    "quantity": (1, 5),
    "items": (1, 3),
    "stock_quantity": (0, 1000),
    "review_count": (0, 500),
}
DECIMAL = {
    "lifetime_value": (100, 10000, 2),
    "order_amount": (10, 1000, 2),
    "item_price": (10, 200, 2),
    "price": (9.99, 999.99, 2),
    "cost": (5, 500, 2),
    "rating": (1, 5, 1),
}
MOST_TAGS = 3

# The warehouse schemas and layouts of these tables.
CUSTOMERS_TARGET = """
  customer_id bigint NOT NULL, first_name string, last_name string, email string, phone string,
  registration_date date, country string, is_active boolean, lifetime_value double, created_at timestamp"""
ORDERS_TARGET = """
  order_id bigint NOT NULL, customer_id bigint, order_date date, order_amount double, status string,
  payment_method string, shipping_address struct<street: string, city: string, state: string, zip: string>,
  items array<struct<product_id: bigint, quantity: bigint, price: double>>, created_at timestamp"""
ORDERS_JSON_TARGET = """
  order_id bigint NOT NULL, customer_id bigint, order_date date, order_amount double, status string,
  payment_method string, shipping_address string, items string, created_at timestamp"""
PRODUCTS_TARGET = """
  product_id bigint NOT NULL, product_name string, category string, brand string, price double, cost double,
  stock_quantity bigint, description string, rating double, review_count bigint, is_available boolean,
  tags array<string>, created_at timestamp, updated_at timestamp"""
LABELS = {"source": "log_table", "env": "test"}
TARGETS = {
    "customers": (
        CUSTOMERS_TARGET,
        Definition(("registration_date",), ("country", "is_active"), 0, "Customer information table", LABELS),
    ),
    "orders": (
        ORDERS_TARGET,
        Definition(
            ("order_date",),
            ("customer_id", "status"),
            0,
            "Orders table with nested shipping address and items array",
            LABELS,
        ),
    ),
    "orders_json": (
        ORDERS_JSON_TARGET,
        Definition(
            ("order_date",), ("customer_id", "status"), 0, "Orders table with JSON strings (alternative schema)", LABELS
        ),
    ),
    "products": (
        PRODUCTS_TARGET,
        Definition((), ("category", "brand", "is_available"), 0, "Product catalog with tags array", LABELS),
    ),
}


def target_table(name: str) -> tuple[T.StructType, Definition]:
    """Warehouse schema and layout of a sample table."""
    ddl, definition = TARGETS[name]
    return T.StructType.fromDDL(ddl), definition


def _ids(spark: SparkSession, count: int) -> DataFrame:
    return spark.range(1, count + 1)


class _Drawer:
    """Draws of one table: the row's id and the seed are given once."""

    def __init__(self, key: Column, seed: int, base_date: str):
        self.key, self.seed, self.base_date = key, seed, base_date

    def whole(self, label: str, of: str | None = None) -> Column:
        return draw_int(self.key, self.seed, label, *WHOLE[of or label])

    def decimal(self, label: str, of: str | None = None) -> Column:
        return draw_decimal(self.key, self.seed, label, *DECIMAL[of or label])

    def pick(self, label: str, values: list[str]) -> Column:
        return pick(self.key, self.seed, label, values)

    def flag(self, label: str) -> Column:
        return draw_int(self.key, self.seed, label, 0, 1) == 1

    def day(self, label: str, of: str) -> Column:
        return days_before(self.key, self.seed, label, self.base_date, *WHOLE[of])

    def made(self) -> Column:
        return iso_text(f"{self.base_date} 00:00:00")


def customers_for(ids: DataFrame, seed: int = 0, base_date: str = BASE_DATE) -> DataFrame:
    """One sample customer per row of ``ids`` (column ``id``)."""
    key = F.col("id")
    draw = _Drawer(key, seed, base_date)
    return ids.select(
        key.cast("int").alias("customer_id"),
        draw.pick("first_name", FIRST_NAMES).alias("first_name"),
        draw.pick("last_name", LAST_NAMES).alias("last_name"),
        filled(EMAIL, key).alias("email"),
        filled(PHONE, draw.whole("phone.1", "phone"), draw.whole("phone.2", "phone")).alias("phone"),
        draw.day("registration_date", "registration_days").alias("registration_date"),
        draw.pick("country", COUNTRIES).alias("country"),
        draw.flag("is_active").alias("is_active"),
        draw.decimal("lifetime_value").alias("lifetime_value"),
        draw.made().alias("created_at"),
    )


def orders_for(ids: DataFrame, seed: int = 0, base_date: str = BASE_DATE, customers: int = 1000) -> DataFrame:
    """One sample order with nested address and one to three items per row of ``ids``."""
    key = F.col("id")
    draw = _Drawer(key, seed, base_date)

    def item(number: int) -> Column:
        part = _Drawer(sub_key(key, F.lit(number)), seed, base_date)
        return F.struct(
            part.whole("product_id").alias("product_id"),
            part.whole("quantity").alias("quantity"),
            part.decimal("price", "item_price").alias("price"),
        )

    # All items are drawn: unlike a lambda over a sequence this stays in generated code.
    drawn = F.array(*[item(number) for number in range(1, WHOLE["items"][1] + 1)])
    return ids.select(
        key.cast("int").alias("order_id"),
        draw_int(key, seed, "customer_id", 1, customers).alias("customer_id"),
        draw.day("order_date", "order_days").alias("order_date"),
        draw.decimal("order_amount").alias("order_amount"),
        draw.pick("status", STATUSES).alias("status"),
        draw.pick("payment_method", PAYMENTS).alias("payment_method"),
        F.struct(
            filled(STREET, draw.whole("street")).alias("street"),
            draw.pick("city", CITIES).alias("city"),
            draw.pick("state", STATES).alias("state"),
            draw.whole("zip").cast("string").alias("zip"),
        ).alias("shipping_address"),
        F.slice(drawn, 1, draw.whole("items")).alias("items"),
        draw.made().alias("created_at"),
    )


def products_for(ids: DataFrame, seed: int = 0, base_date: str = BASE_DATE) -> DataFrame:
    """One sample product with up to three tags per row of ``ids``."""
    key = F.col("id")
    draw = _Drawer(key, seed, base_date)
    return ids.select(
        key.cast("int").alias("product_id"),
        filled(PRODUCT_NAME, key).alias("product_name"),
        draw.pick("category", CATEGORIES).alias("category"),
        draw.pick("brand", BRANDS).alias("brand"),
        draw.decimal("price").alias("price"),
        draw.decimal("cost").alias("cost"),
        draw.whole("stock_quantity").alias("stock_quantity"),
        filled(DESCRIPTION, key).alias("description"),
        draw.decimal("rating").alias("rating"),
        draw.whole("review_count").alias("review_count"),
        draw.flag("is_available").alias("is_available"),
        pick_some(key, seed, "tags", TAGS, MOST_TAGS).alias("tags"),
        draw.made().alias("created_at"),
        draw.made().alias("updated_at"),
    )


def sample_customers(spark: SparkSession, count: int = 1000, seed: int = 0, base_date: str = BASE_DATE) -> DataFrame:
    return customers_for(_ids(spark, count), seed, base_date)


def sample_orders(
    spark: SparkSession, count: int = 5000, seed: int = 0, base_date: str = BASE_DATE, customers: int = 1000
) -> DataFrame:
    return orders_for(_ids(spark, count), seed, base_date, customers)


def sample_products(spark: SparkSession, count: int = 500, seed: int = 0, base_date: str = BASE_DATE) -> DataFrame:
    return products_for(_ids(spark, count), seed, base_date)

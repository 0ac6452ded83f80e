"""Views and reports on loaded customer, order and product tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.functions.nested import json_fragment, json_scalar, quoted
from tableferry.operators.quality import profile
from tableferry.sources.catalog import create_view, quote_name

SUMMARY_KEYS = ["customer_id", "first_name", "last_name", "email", "country"]
PERFORMANCE_COLUMNS = [
    "product_id",
    "product_name",
    "category",
    "brand",
    "price",
    "rating",
    "review_count",
    "stock_quantity",
    "is_available",
]


def orders_per_customer(orders: DataFrame) -> DataFrame:
    """Order figures per customer.

    Reports add orders up per customer before joining: the sums are combined
    before the shuffle, so a customer with a third of all orders is one small row
    per task, and the join that follows reuses the partitioning by customer.
    """
    return (
        orders.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.sum("order_amount").alias("total_spent"),
            F.count("order_amount").alias("priced_orders"),
            F.max("order_date").alias("last_order_date"),
        )
    )


def _with_figures(customers: DataFrame, orders: DataFrame, keys: list[str]) -> DataFrame:
    """Customers with their order figures, grouped by ``keys``: customers without orders stay, repeats add up."""
    return (
        customers.select(*keys)
        .join(orders_per_customer(orders), "customer_id", "left")
        .groupBy(*keys)
        .agg(
            F.coalesce(F.sum("total_orders"), F.lit(0).cast("bigint")).alias("total_orders"),
            F.sum("total_spent").alias("total_spent"),
            F.sum("priced_orders").alias("priced_orders"),
            F.max("last_order_date").alias("last_order_date"),
        )
    )


def customer_order_summary(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Per customer: number of orders (0 without any), sum, average and latest date (null without any)."""
    return _with_figures(customers, orders, SUMMARY_KEYS).select(
        *SUMMARY_KEYS,
        "total_orders",
        "total_spent",
        (F.col("total_spent") / F.nullif("priced_orders", F.lit(0))).alias("avg_order_value"),
        "last_order_date",
    )


def country_revenue(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Per country: distinct customers, orders, revenue and average order value, highest revenue first.

    Grouping by customer first makes the distinct count a plain count and leaves
    one row per country and task for the last shuffle.
    """
    revenue = F.sum("total_spent")
    return (
        _with_figures(customers, orders, ["customer_id", "country"])
        .groupBy("country")
        .agg(
            F.count("customer_id").alias("customers"),
            F.sum("total_orders").alias("total_orders"),
            revenue.alias("total_revenue"),
            (revenue / F.nullif(F.sum("priced_orders"), F.lit(0))).alias("avg_order_value"),
        )
        .orderBy(F.col("total_revenue").desc_nulls_last(), F.col("country"))
    )


def product_performance(products: DataFrame) -> DataFrame:
    """Available products, best rated first.

    The id ends the sort key, which fixes the order of ties and lets the range
    shuffle split a rating that many products share.
    """
    return (
        products.filter("is_available")
        .select(*PERFORMANCE_COLUMNS)
        .orderBy(F.col("rating").desc_nulls_last(), F.col("review_count").desc_nulls_last(), F.col("product_id"))
    )


def top_products(products: DataFrame, count: int) -> DataFrame:
    """The first rows of ``product_performance``; each task keeps only its own best."""
    return product_performance(products).limit(count)


def category_stats(products: DataFrame) -> DataFrame:
    """Per category: products, average price and rating, stock; largest category first."""
    return (
        products.groupBy("category")
        .agg(
            F.count("*").alias("product_count"),
            F.avg("price").alias("avg_price"),
            F.avg("rating").alias("avg_rating"),
            F.sum("stock_quantity").alias("total_stock"),
        )
        .orderBy(F.col("product_count").desc(), F.col("category"))
    )


def count_by(df: DataFrame, key: str, name: str) -> DataFrame:
    """Rows per value of one column."""
    return df.groupBy(quoted(key)).agg(F.count("*").alias(name))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``table_name, row_count`` for each table."""
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
              for n, df in tables.items()]
    result = counts[0]
    for one in counts[1:]:
        result = result.unionByName(one)
    return result


def customer_quality(customers: DataFrame) -> DataFrame:
    """One row: customers, distinct ids and addresses, active and inactive customers."""
    return profile(customers, ["customer_id", "email"], ["is_active"]).select(
        F.col("total_rows").alias("total_customers"),
        F.col("unique_customer_id").alias("unique_customers"),
        F.col("unique_email").alias("unique_emails"),
        F.col("is_active_true").alias("active_customers"),
        F.col("is_active_false").alias("inactive_customers"),
    )


def orders_since(orders: DataFrame, since: str, status: str) -> DataFrame:
    """Customer, amount and status of orders from a date on with one status; both filters reach the scan."""
    recent = (F.col("order_date") >= F.lit(since).cast(orders.schema["order_date"].dataType)) & (
        F.col("status") == status
    )
    return orders.filter(recent).select("customer_id", "order_amount", "status")


def preview(df: DataFrame, columns: list[str], count: int, order_by: list[str | Column] | None = None) -> DataFrame:
    """A few rows of some columns; name an order to make the choice repeatable."""
    rows = df.orderBy(*order_by) if order_by else df
    return rows.select(*columns).limit(count)


def order_cities(orders: DataFrame) -> DataFrame:
    """City and number of items of orders with nested columns; only these nested fields are read."""
    return orders.select(
        "order_id", F.col("shipping_address.city").alias("city"), F.array_size("items").alias("item_count")
    )


def order_cities_json(orders: DataFrame) -> DataFrame:
    """City and items of orders whose nested columns are JSON text."""
    return orders.select(
        "order_id",
        json_scalar(F.col("shipping_address"), "$.city").alias("city"),
        json_fragment(F.col("items"), "$").alias("items_json"),
    )


def create_report_views(spark: SparkSession, schema: str) -> None:
    """Stored views over the tables ``customers``, ``orders`` and ``products`` of a schema."""

    def table(name: str) -> str:
        return quote_name(f"{schema}.{name}")

    keys = ", ".join(f"c.{k}" for k in SUMMARY_KEYS)
    create_view(
        spark,
        f"{schema}.customer_order_summary",
        f"""
        WITH figures AS (
          SELECT customer_id, count(order_id) AS orders, sum(order_amount) AS spent,
                 count(order_amount) AS priced, max(order_date) AS latest
          FROM {table("orders")} WHERE customer_id IS NOT NULL GROUP BY customer_id)
        SELECT {keys}, coalesce(sum(f.orders), 0) AS total_orders, sum(f.spent) AS total_spent,
               sum(f.spent) / nullif(sum(f.priced), 0) AS avg_order_value, max(f.latest) AS last_order_date
        FROM {table("customers")} c LEFT JOIN figures f ON f.customer_id = c.customer_id
        GROUP BY {keys}""",
    )
    # No ORDER BY: the order of a view does not carry over to queries on it.
    create_view(
        spark,
        f"{schema}.product_performance",
        f"SELECT {', '.join(PERFORMANCE_COLUMNS)} FROM {table('products')} WHERE is_available",
    )

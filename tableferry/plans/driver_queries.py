"""Every operator as a query on the star-schema tables, with the SQL that gives the same rows.

The tables stand in for the tables a load delivers: customers are ``customer``
with ``nation``, products are ``part``, JSON text is ``events.props``. Queries
that load or log a table do so in a fresh schema below the scratch folder and
return what a reader of the loaded table sees; the table stays there, as the
result is read from it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry import leases
from tableferry.functions import draws, mapping, nested, size
from tableferry.operators import incremental, layout, load, pointer, quality, verify
from tableferry.plans import cli, move, reports, sample_tables
from tableferry.session import scratch_path, scratch_root, text_frame
from tableferry.sources import catalog, files, log_table
from tableferry.streaming import append

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL equivalent if there is one."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workspace(spark: SparkSession) -> str:
    """A new catalog schema whose tables lie in the shared scratch folder."""
    name = f"ferry_{uuid.uuid4().hex[:12]}"
    leases.note(spark, "schema", name)
    catalog.create_schema(spark, name, scratch_path(spark, "schema"))
    return name


# ---------------------------------------------------------------- stand-ins

CUSTOMERS_SQL = """
  SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
         concat('customer', c_custkey, '@example.com') AS email, n_name AS country, c_acctbal > 0 AS is_active,
         c_acctbal AS lifetime_value
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""
ORDERS_SQL = """
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
         o_totalprice AS order_amount, o_orderstatus AS status, o_orderpriority AS payment_method
  FROM orders"""
PRODUCTS_SQL = """
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS brand,
         p_retailprice AS price, p_size / 10.0 AS rating, p_size * 3 AS review_count, p_size AS stock_quantity,
         p_size > 10 AS is_available
  FROM part"""
WITH_ALL = f"WITH customers AS ({CUSTOMERS_SQL}), sales AS ({ORDERS_SQL}), products AS ({PRODUCTS_SQL})"


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return rows.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.concat(F.lit("customer"), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias("email"),
        F.col("n_name").alias("country"),
        (F.col("c_acctbal") > 0).alias("is_active"),
        F.col("c_acctbal").alias("lifetime_value"),
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("order_date"),
        F.col("o_totalprice").alias("order_amount"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("payment_method"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("price"),
        (F.col("p_size") / 10).alias("rating"),
        (F.col("p_size") * 3).alias("review_count"),
        F.col("p_size").alias("stock_quantity"),
        (F.col("p_size") > 10).alias("is_available"),
    )


def nested_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with an address and one to three items, derived row by row."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("order_id"),
        F.struct(
            F.concat(key.cast("string"), F.lit(" Main St")).alias("street"),
            F.col("o_orderpriority").alias("city"),
            F.col("o_orderstatus").alias("state"),
            F.lpad(F.col("o_custkey").cast("string"), 5, "0").alias("zip"),
        ).alias("shipping_address"),
        F.transform(
            F.sequence(F.lit(1), (1 + F.pmod(key, F.lit(3))).cast("int")),
            lambda i: F.struct(
                (F.col("o_custkey") + i).alias("product_id"), i.alias("quantity"), F.col("o_totalprice").alias("price")
            ),
        ).alias("items"),
    )


# ------------------------------------------------------------------ reports

SUMMARY_SELECT = """
  SELECT c.customer_id, c.first_name, c.last_name, c.email, c.country,
         count(s.order_id) AS total_orders, round(sum(s.order_amount), 2) AS total_spent,
         round(avg(s.order_amount), 6) AS avg_order_value, max(s.order_date) AS last_order_date
  FROM customers c LEFT JOIN {orders} s ON c.customer_id = s.customer_id
  GROUP BY c.customer_id, c.first_name, c.last_name, c.email, c.country"""


def _rounded(summary: DataFrame, total: str) -> DataFrame:
    return summary.withColumns({total: F.round(total, 2), "avg_order_value": F.round("avg_order_value", 6)})


@query(f"{WITH_ALL} {SUMMARY_SELECT.format(orders='sales')}")
def customer_order_summary(spark, sf_dir):
    return _rounded(reports.customer_order_summary(customers(spark, sf_dir), sales(spark, sf_dir)), "total_spent")


@query(
    f"{WITH_ALL}, late AS (SELECT * FROM sales WHERE order_date >= DATE '2001-01-01') "
    f"{SUMMARY_SELECT.format(orders='late')}"
)
def customer_order_summary_recent(spark, sf_dir):
    """The same summary of the latest year's orders; customers without any stay in with nulls."""
    late = sales(spark, sf_dir).filter(F.col("order_date") >= F.lit("2001-01-01").cast("date"))
    return _rounded(reports.customer_order_summary(customers(spark, sf_dir), late), "total_spent")


@query(
    f"""{WITH_ALL}
    SELECT c.country, count(DISTINCT c.customer_id) AS customers, count(s.order_id) AS total_orders,
           round(sum(s.order_amount), 2) AS total_revenue, round(avg(s.order_amount), 6) AS avg_order_value
    FROM customers c LEFT JOIN sales s ON c.customer_id = s.customer_id
    GROUP BY c.country ORDER BY total_revenue DESC NULLS LAST, c.country"""
)
def country_revenue(spark, sf_dir):
    return _rounded(reports.country_revenue(customers(spark, sf_dir), sales(spark, sf_dir)), "total_revenue")


@query(
    f"{WITH_ALL} SELECT * FROM products WHERE is_available "
    "ORDER BY rating DESC NULLS LAST, review_count DESC NULLS LAST, product_id"
)
def product_performance(spark, sf_dir):
    return reports.product_performance(products(spark, sf_dir))


@query(
    f"{WITH_ALL} SELECT * FROM products WHERE is_available "
    "ORDER BY rating DESC NULLS LAST, review_count DESC NULLS LAST, product_id LIMIT 25"
)
def top_products(spark, sf_dir):
    return reports.top_products(products(spark, sf_dir), 25)


@query(
    f"""{WITH_ALL}
    SELECT category, count(*) AS product_count, round(avg(price), 6) AS avg_price, round(avg(rating), 6) AS avg_rating,
           CAST(sum(stock_quantity) AS BIGINT) AS total_stock
    FROM products GROUP BY category ORDER BY product_count DESC, category"""
)
def category_stats(spark, sf_dir):
    stats = reports.category_stats(products(spark, sf_dir))
    return stats.withColumns({"avg_price": F.round("avg_price", 6), "avg_rating": F.round("avg_rating", 6)})


@query(f"{WITH_ALL} SELECT status, count(*) AS total_orders FROM sales GROUP BY status")
def count_by_status(spark, sf_dir):
    return reports.count_by(sales(spark, sf_dir), "status", "total_orders")


@query(f"{WITH_ALL} SELECT country, count(*) AS total_customers FROM customers GROUP BY country")
def count_by_country(spark, sf_dir):
    return reports.count_by(customers(spark, sf_dir), "country", "total_customers")


@query("SELECT c_mktsegment, count(*) AS total_customers FROM customer GROUP BY c_mktsegment")
def count_by_segment(spark, sf_dir):
    return reports.count_by(table(spark, sf_dir, "customer"), "c_mktsegment", "total_customers")


COUNTED = ["customer", "orders", "part", "lineitem", "events", "documents"]


@query(" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in COUNTED))
def table_counts(spark, sf_dir):
    return reports.table_counts({n: table(spark, sf_dir, n) for n in COUNTED})


@query(
    f"""{WITH_ALL}
    SELECT count(*) AS total_customers, count(DISTINCT customer_id) AS unique_customers,
           count(DISTINCT email) AS unique_emails, count(*) FILTER (is_active) AS active_customers,
           count(*) FILTER (NOT is_active) AS inactive_customers
    FROM customers"""
)
def quality_profile(spark, sf_dir):
    return reports.customer_quality(customers(spark, sf_dir))


@query(
    """SELECT count(*) AS total, count(DISTINCT l_orderkey) AS unique_ids,
              (SELECT count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)) AS repeated_ids
       FROM lineitem"""
)
def duplicate_summary(spark, sf_dir):
    return quality.duplicate_summary(table(spark, sf_dir, "lineitem"), "l_orderkey")


@query("SELECT l_orderkey, count(*) AS copies FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1")
def duplicate_check(spark, sf_dir):
    return quality.duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey"])


@query(
    f"""{WITH_ALL} SELECT * FROM sales s
    WHERE NOT EXISTS (SELECT 1 FROM customers c WHERE c.is_active AND c.customer_id = s.customer_id)"""
)
def fk_orphans(spark, sf_dir):
    """Orders whose customer is not among the active ones."""
    active = customers(spark, sf_dir).filter("is_active")
    return quality.orphans(sales(spark, sf_dir), active, "customer_id", "customer_id")


@query(
    f"""{WITH_ALL} SELECT customer_id AS orphan_key, count(*) AS row_count FROM sales s
    WHERE NOT EXISTS (SELECT 1 FROM customers c WHERE c.is_active AND c.customer_id = s.customer_id)
    GROUP BY customer_id"""
)
def fk_orphan_summary(spark, sf_dir):
    active = customers(spark, sf_dir).filter("is_active")
    return quality.orphan_summary(sales(spark, sf_dir), active, "customer_id", "customer_id")


@query(
    f"""{WITH_ALL} SELECT customer_id, order_amount, status FROM sales
    WHERE order_date >= DATE '2000-01-01' AND status = 'F'"""
)
def recent_delivered(spark, sf_dir):
    return reports.orders_since(sales(spark, sf_dir), "2000-01-01", "F")


@query(
    f"""{WITH_ALL} SELECT order_id, customer_id, order_amount FROM sales
    ORDER BY order_amount DESC, order_id LIMIT 1000"""
)
def order_preview(spark, sf_dir):
    """A preview of 1,000 rows: the limit is the feature."""
    order = [F.col("order_amount").desc(), F.col("order_id")]
    return reports.preview(sales(spark, sf_dir), ["order_id", "customer_id", "order_amount"], 1000, order)


# ------------------------------------------------------------ nested, JSON

@query(
    """SELECT o_orderkey AS order_id, o_orderpriority AS city, CAST(1 + o_orderkey % 3 AS INTEGER) AS item_count
       FROM orders"""
)
def nested_city_and_count(spark, sf_dir):
    return reports.order_cities(nested_orders(spark, sf_dir))


ITEMS_JSON_SQL = """
  '[' || list_aggregate(list_transform(range(1, CAST(2 + o_orderkey % 3 AS BIGINT)), lambda i:
      concat('{"product_id":', o_custkey + i, ',"quantity":', i, '}')), 'string_agg', ',') || ']'"""


@query(
    f"""SELECT o_orderkey AS order_id, o_orderpriority AS city, {ITEMS_JSON_SQL} AS items_json,
               o_totalprice AS first_price FROM orders"""
)
def nested_to_json_fields(spark, sf_dir):
    """Nested columns become JSON text, which is then queried; prices are compared as numbers, as engines print them differently."""
    found = reports.order_cities_json(nested.nested_to_json(nested_orders(spark, sf_dir)))
    return found.select(
        "order_id",
        "city",
        F.regexp_replace("items_json", r',"price":[^,}]*', "").alias("items_json"),
        F.get_json_object("items_json", "$[0].price").cast("double").alias("first_price"),
    )


ITEM_ROWS_SQL = """
       SELECT o_orderkey AS order_id, concat(o_orderkey, ' Main St') AS street, o_orderpriority AS city,
              o_orderstatus AS state, lpad(CAST(o_custkey AS VARCHAR), 5, '0') AS zip, i AS position,
              o_custkey + i AS product_id, i AS quantity, o_totalprice AS price
       FROM orders, LATERAL (SELECT CAST(unnest(range(1, CAST(2 + o_orderkey % 3 AS BIGINT))) AS INTEGER) AS i)"""


@query(ITEM_ROWS_SQL)
def orders_json_roundtrip(spark, sf_dir):
    """To JSON text and back, then one row per item."""
    orders = nested_orders(spark, sf_dir)
    return _item_rows(nested.json_to_nested(nested.nested_to_json(orders), orders.schema))


@query(ITEM_ROWS_SQL)
def orders_json_load(spark, sf_dir):
    """A nested log table through the staged route as JSON text; the loaded text is parsed and read item by item."""
    path, orders = scratch_path(spark, "nested-orders"), nested_orders(spark, sf_dir)
    log_table.write_log_table(orders, path)
    job = move.Job(path, table="orders_json", schema=workspace(spark), stage_root=scratch_path(spark, "stage"))
    move.move_table(spark, job, strict_verify=True, checksum=True).collect()
    return _item_rows(nested.json_to_nested(spark.table(job.target), orders.schema))


@query(ITEM_ROWS_SQL)
def orders_nested_load(spark, sf_dir):
    """The same table through the staged route with its nested columns kept."""
    path = scratch_path(spark, "nested-orders")
    log_table.write_log_table(nested_orders(spark, sf_dir), path)
    job = move.Job(path, table="orders", schema=workspace(spark), stage_root=scratch_path(spark, "stage"), nested="keep")
    move.move_table(spark, job, strict_verify=True, checksum=True).collect()
    return _item_rows(spark.table(job.target))


def _item_rows(orders: DataFrame) -> DataFrame:
    return orders.select("order_id", "shipping_address.*", F.posexplode("items").alias("at", "item")).select(
        "order_id",
        "street",
        "city",
        "state",
        "zip",
        (F.col("at") + 1).alias("position"),
        "item.product_id",
        "item.quantity",
        "item.price",
    )


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_scalar(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", nested.json_scalar(F.col("props"), "$.k").alias("k"))


@query("SELECT event_id, CAST(json(props) AS VARCHAR) AS props FROM events")
def json_whole(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", nested.json_fragment(F.col("props")).alias("props"))


@query(
    """SELECT vec_id, label, unnest(range(CAST(len(embedding) AS BIGINT))) AS position, CAST(unnest(embedding) AS DOUBLE) AS value
       FROM embeddings"""
)
def array_json_roundtrip(spark, sf_dir):
    """Vectors to JSON text and back, one row per component."""
    vectors = table(spark, sf_dir, "embeddings")
    text = nested.nested_to_json(vectors.withColumn("kept", F.col("embedding")).drop("embedding"))
    back = nested.json_to_nested(text, T.StructType([T.StructField("kept", vectors.schema["embedding"].dataType)]))
    parts = back.select("vec_id", "label", F.posexplode("kept").alias("position", "value"))
    return parts.withColumns({"position": F.col("position").cast("bigint"), "value": F.col("value").cast("double")})


# --------------------------------------------------------- schema mapping

def _text_orders(spark, sf_dir) -> DataFrame:
    """Orders as a source that keeps dates and times as text and ids as narrow numbers."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("int").alias("order_id"),
        F.col("o_custkey").cast("int").alias("customer_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        F.col("o_totalprice").cast("string").alias("order_amount"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("created_at"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
    )


MAPPED = "order_id bigint NOT NULL, customer_id bigint, order_date date, order_amount double, created_at timestamp_ntz, status string, priority string"


@query(
    """SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
              o_totalprice AS order_amount, o_orderdate AS created_at, o_orderstatus AS status, o_orderpriority AS priority FROM orders"""
)
def schema_map(spark, sf_dir):
    return mapping.map_schema(_text_orders(spark, sf_dir), T.StructType.fromDDL(MAPPED))


def _loose_dates(spark, sf_dir) -> DataFrame:
    """Line items with a date text whose day runs past the end of some months."""
    return table(spark, sf_dir, "lineitem").select(
        "*",
        F.concat(
            F.left(F.col("l_shipdate").cast("string"), F.lit(8)), (F.col("l_linenumber") + 26).cast("string")
        ).alias("ship_text"),
    )


LOOSE_SQL = "SELECT *, strftime(l_shipdate, '%Y-%m-') || (l_linenumber + 26) AS t FROM lineitem"
LOOSE_TARGET = "l_orderkey bigint, l_linenumber int, ship_text date"


def _whole_target(spark, sf_dir) -> T.StructType:
    return T.StructType([*table(spark, sf_dir, "lineitem").schema.fields, T.StructField("ship_text", T.DateType())])


@query(f"SELECT * EXCLUDE (t), TRY_CAST(t AS DATE) AS ship_text FROM ({LOOSE_SQL}) WHERE TRY_CAST(t AS DATE) IS NOT NULL")
def mapped_clean_rows(spark, sf_dir):
    flagged = mapping.map_schema_flagged(_loose_dates(spark, sf_dir), _whole_target(spark, sf_dir))
    return mapping.split_rejects(flagged)[0]


@query(
    f"""SELECT * EXCLUDE (t), CAST(NULL AS DATE) AS ship_text, 'ship_text' AS rejected FROM ({LOOSE_SQL})
        WHERE TRY_CAST(t AS DATE) IS NULL"""
)
def mapped_rejected_rows(spark, sf_dir):
    flagged = mapping.map_schema_flagged(_loose_dates(spark, sf_dir), _whole_target(spark, sf_dir))
    rejected = mapping.split_rejects(flagged)[1]
    return rejected.withColumn("rejected", F.array_join(mapping.REJECTS, ",")).drop(mapping.REJECTS)


@query(
    f"""SELECT l_orderkey, l_linenumber, TRY_CAST(t AS DATE) AS ship_text, NULL AS original FROM ({LOOSE_SQL})
        WHERE TRY_CAST(t AS DATE) IS NOT NULL
        UNION ALL
        SELECT l_orderkey, l_linenumber, NULL, concat('{{"l_orderkey":', l_orderkey, ',"l_linenumber":', l_linenumber,
               ',"ship_text":"', t, '"}}')
        FROM ({LOOSE_SQL}) WHERE TRY_CAST(t AS DATE) IS NULL"""
)
def permissive_load(spark, sf_dir):
    """Rows that fit land in the target, the others with their original text in a second table."""
    schema = workspace(spark)
    result, _ = load.load_permissive(
        _loose_dates(spark, sf_dir).select("l_orderkey", "l_linenumber", "ship_text"),
        T.StructType.fromDDL(LOOSE_TARGET),
        f"{schema}.lineitem",
        f"{schema}.rejects",
        f"{scratch_root(spark)}/stage",
    )
    load.remove_stage(spark, result.staged_path)
    good = spark.table(f"{schema}.lineitem").withColumn("original", F.lit(None).cast("string"))
    bad = spark.table(f"{schema}.rejects").withColumnRenamed(mapping.SOURCE, "original").drop(mapping.REJECTS)
    return good.unionByName(bad)


@query(
    f"""SELECT 'ship_text' AS column_name, 'string' AS source_type, 'date' AS target_type, 'type differs' AS issue,
               count(*) AS lossy_rows
        FROM ({LOOSE_SQL}) WHERE TRY_CAST(t AS DATE) IS NULL"""
)
def schema_diff(spark, sf_dir):
    return verify.schema_diff(_loose_dates(spark, sf_dir), _whole_target(spark, sf_dir))


DOCUMENT_BYTES = """(CASE WHEN doc_id IS NULL THEN 0 ELSE 8 END) + (CASE WHEN n_chars IS NULL THEN 0 ELSE 8 END)
  + coalesce(strlen(text), 0) + coalesce(strlen(lang), 0) + coalesce(strlen(source), 0)"""


@query(
    f"""SELECT doc_id, CAST({DOCUMENT_BYTES} AS BIGINT) AS row_bytes FROM documents WHERE {DOCUMENT_BYTES} > 10000"""
)
def oversized_rows(spark, sf_dir):
    return size.oversized(table(spark, sf_dir, "documents"), 10_000).select("doc_id", "row_bytes")


@query("SELECT doc_id, left(text, 1000) AS text, length(text) > 1000 AS was_cut FROM documents")
def truncated_text(spark, sf_dir):
    """Cutting long text is the operator here; every row and its whole text is read."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", (F.char_length("text") > 1000).alias("was_cut"))
    return size.truncate_text(rows, 1000)


@query("SELECT doc_id, lang, source, n_chars, text FROM documents")
def split_wide_rejoined(spark, sf_dir):
    """Wide text moved to a side table, then joined back by key."""
    narrow, side = size.split_wide(table(spark, sf_dir, "documents"), ["doc_id"], ["text"])
    return narrow.join(side, "doc_id")


# ------------------------------------------------------------------- loads

@query("SELECT * FROM lineitem")
def staged_load(spark, sf_dir):
    target = f"{workspace(spark)}.lineitem"
    result = load.load_staged(table(spark, sf_dir, "lineitem"), target, f"{scratch_root(spark)}/stage", shrink="coalesce")
    load.remove_stage(spark, result.staged_path)
    return spark.table(target)


@query("SELECT * FROM lineitem")
def direct_load(spark, sf_dir):
    target = f"{workspace(spark)}.lineitem"
    load.load_direct(table(spark, sf_dir, "lineitem"), target, shrink="coalesce")
    return spark.table(target)


@query("SELECT * FROM orders UNION ALL SELECT * FROM orders")
def append_load(spark, sf_dir):
    """A first load and an append of the same rows: append adds, it does not replace."""
    target = f"{workspace(spark)}.orders"
    orders = table(spark, sf_dir, "orders")
    load.load_direct(orders, target)
    load.load_staged(orders, target, f"{scratch_root(spark)}/stage", "append")
    return spark.table(target)


@query("SELECT * FROM orders")
def append_only_missing(spark, sf_dir):
    """An append repeated by key after a part was loaded adds just the missing rows."""
    target = f"{workspace(spark)}.orders"
    orders = table(spark, sf_dir, "orders")
    load.load_direct(orders.filter("o_orderstatus = 'F'"), target)
    load.load_direct(incremental.rows_not_in(orders, spark.table(target), ["o_orderkey"]), target, "append",
                     shrink="rebalance")
    return spark.table(target)


@query(
    """SELECT o_orderstatus, count(*) AS row_count, sum(o_totalprice) > 0 AS has_prices,
              (SELECT count(*) FROM orders WHERE o_orderstatus <> 'F') AS added, TRUE AS verified
       FROM orders GROUP BY o_orderstatus"""
)
def keyed_append_verified(spark, sf_dir):
    """A keyed append after a part was loaded, run twice: the second adds nothing, and both checks compare keys."""
    path, orders = scratch_path(spark, "orders"), table(spark, sf_dir, "orders")
    log_table.write_log_table(orders, path)
    job = move.Job(path, table="orders", schema=workspace(spark), mode="append", key=("o_orderkey",))
    load.load_direct(orders.filter("o_orderstatus = 'F'"), job.target)
    results = [move.run_job(spark, job) for _ in range(2)]
    return (
        spark.table(job.target)
        .groupBy("o_orderstatus")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            (F.sum("o_totalprice") > 0).alias("has_prices"),
            F.lit(sum(r["source_rows"] for r in results)).cast("bigint").alias("added"),
            F.lit(all(r["verified"] for r in results)).alias("verified"),
        )
    )


@query("SELECT event_id, user_id, event_type, value, props, ts, CAST(ts AS DATE) AS day FROM events")
def partitioned_load(spark, sf_dir):
    target = f"{workspace(spark)}.events"
    rows = layout.with_partition_date(table(spark, sf_dir, "events"), "ts", "day")
    load.load_direct(rows, target, definition=catalog.Definition(partition_by=("day",)))
    return spark.table(target)


@query(
    """SELECT event_id, user_id, event_type, value, props, ts, CAST(ts AS DATE) AS day FROM events
       WHERE CAST(ts AS DATE) >= DATE '2024-01-20'"""
)
def expired_partitions(spark, sf_dir):
    """Date partitions before a day are dropped."""
    target = f"{workspace(spark)}.events"
    rows = layout.with_partition_date(table(spark, sf_dir, "events"), "ts", "day")
    load.load_direct(rows, target, definition=catalog.Definition(partition_by=("day",)))
    catalog.expire_partitions(spark, target, "day", "2024-01-20")
    return spark.table(target)


@query(
    """SELECT event_id, user_id, event_type, value, props, ts, strftime(ts, '%Y-%m-%d-%H') AS hour FROM events
       WHERE ts >= TIMESTAMP '2024-01-20 12:00:00'"""
)
def expired_partitions_hourly(spark, sf_dir):
    """Hour partitions before a time are dropped."""
    target = f"{workspace(spark)}.events"
    rows = layout.with_partition_date(table(spark, sf_dir, "events"), "ts", "hour", "hour")
    load.load_direct(rows, target, definition=catalog.Definition(partition_by=("hour",)))
    catalog.expire_partitions(spark, target, "hour", "2024-01-20 12:00:00")
    return spark.table(target)


@query("SELECT 'kept' AS name, count(*) AS row_count FROM orders")
def dropped_table(spark, sf_dir):
    """Of two loaded tables one is dropped; what the schema still holds."""
    schema, orders = workspace(spark), table(spark, sf_dir, "orders")
    for name in ("kept", "gone"):
        load.load_direct(orders, f"{schema}.{name}")
    catalog.drop_table(spark, f"{schema}.gone")
    left = spark.sql(f"SHOW TABLES IN {schema}").select(F.col("tableName").alias("name"))
    return left.join(spark.table(f"{schema}.kept").agg(F.count(F.lit(1)).alias("row_count")), F.lit(True), "left")


@query("SELECT 'reviewed' AS \"key\", CAST(count(*) AS VARCHAR) AS value FROM orders")
def table_property(spark, sf_dir):
    """A property set on a loaded table, read back: here the number of its rows."""
    target = f"{workspace(spark)}.orders"
    rows = load.load_direct(table(spark, sf_dir, "orders"), target).rows
    catalog.set_property(spark, target, "reviewed", str(rows))
    return spark.sql(f"SHOW TBLPROPERTIES {target}").filter("key = 'reviewed'").select("key", "value")


@query(f"{WITH_ALL} SELECT 'dear' AS name, * FROM sales WHERE order_amount >= 150000 UNION ALL SELECT 'cheap', * FROM sales WHERE order_amount < 150000")
def cached_split(spark, sf_dir):
    """One frame, kept while two tables are loaded from it."""
    schema = workspace(spark)
    parts = {"dear": "order_amount >= 150000", "cheap": "order_amount < 150000"}
    with layout.cached(sales(spark, sf_dir)) as kept:
        for name, which in parts.items():
            load.load_direct(kept.filter(which), f"{schema}.{name}")
    return reduce(DataFrame.unionByName, [spark.table(f"{schema}.{n}").select(F.lit(n).alias("name"), "*") for n in parts])


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders")
def typed_rows(spark, sf_dir):
    """Untyped rows (JSON lines) read with a stated schema, then loaded."""
    lines, target = scratch_path(spark, "lines"), f"{workspace(spark)}.orders"
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    orders.write.json(lines)
    load.load_direct(spark.read.schema(orders.schema).option("mode", "FAILFAST").json(lines), target)
    return spark.table(target)


@query(f"{WITH_ALL} SELECT * FROM customers")
def clustered_load(spark, sf_dir):
    target = f"{workspace(spark)}.customers"
    definition = catalog.Definition(cluster_by=("country", "is_active"), comment="Customer information table")
    load.load_direct(customers(spark, sf_dir), target, definition=definition)
    return spark.table(target)


@query(f"{WITH_ALL} SELECT * FROM sales")
def bucketed_load(spark, sf_dir):
    target = f"{workspace(spark)}.orders"
    definition = catalog.Definition(cluster_by=("customer_id",), buckets=8)
    load.load_direct(sales(spark, sf_dir), target, definition=definition)
    return spark.table(target)


@query(
    """SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
              o_totalprice AS order_amount, o_orderdate AS created_at, o_orderstatus AS status, o_orderpriority AS priority FROM orders"""
)
def created_target(spark, sf_dir):
    """A table created from a flat ``name:TYPE`` list, filled by an append that maps text to its types."""
    target = f"{workspace(spark)}.orders"
    schema = mapping.flat_schema("order_id:INTEGER,customer_id:INTEGER,order_date:DATE,order_amount:FLOAT,created_at:DATETIME,status:STRING,priority")
    catalog.create_table(spark, target, schema, catalog.Definition(cluster_by=("customer_id",)))
    load.load_direct(mapping.map_schema(_text_orders(spark, sf_dir), schema), target, "append")
    return spark.table(target)


@query(f"{WITH_ALL} {SUMMARY_SELECT.format(orders='sales')}")
def stored_views(spark, sf_dir):
    """The summary view, stored in the catalog over loaded tables."""
    schema = workspace(spark)
    load.load_direct(customers(spark, sf_dir), f"{schema}.customers", shrink="rebalance")
    load.load_direct(sales(spark, sf_dir), f"{schema}.orders")
    load.load_direct(products(spark, sf_dir), f"{schema}.products")
    reports.create_report_views(spark, schema)
    return _rounded(spark.table(f"{schema}.customer_order_summary"), "total_spent")


@query("SELECT * FROM events")
def incremental_slice(spark, sf_dir):
    """A table filled up to a moment, then with the rows above its high-water mark."""
    target = f"{workspace(spark)}.events"
    events = table(spark, sf_dir, "events")
    load.load_direct(events.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")), target)
    load.load_direct(incremental.incremental(events, spark.table(target), "ts"), target, "append")
    return spark.table(target)


@query("SELECT * FROM events")
def stream_append(spark, sf_dir):
    """Two rounds over a folder that grows in between; each round takes only new files."""
    folder = scratch_path(spark, "incoming")
    target = f"{workspace(spark)}.events"
    events = table(spark, sf_dir, "events")
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    for part in (early, ~early):
        events.filter(part).write.mode("append").parquet(folder)
        append.append_available(append.new_files(spark, folder, events.schema), target, f"{folder}-progress")
    return spark.table(target)


@query("SELECT * FROM events")
def stream_append_by_key(spark, sf_dir):
    """A stream into a table that a load had partly filled."""
    folder = scratch_path(spark, "incoming")
    target = f"{workspace(spark)}.events"
    events = table(spark, sf_dir, "events")
    events.write.parquet(folder)
    load.load_direct(events.filter("event_type = 'click'"), target)
    append.append_available(append.new_files(spark, folder, events.schema), target, f"{folder}-progress", ["event_id"])
    return spark.table(target)


# ------------------------------------------------- loads that show in one step

@query(
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority
       FROM orders"""
)
def overwrite_switched(spark, sf_dir):
    """A target behind a view, filled and then replaced from itself: no rename, rows written once."""
    target = f"{workspace(spark)}.orders"
    load.load_direct(table(spark, sf_dir, "orders"), target, switch=True)
    load.load_direct(spark.table(target).withColumn("o_totalprice", F.col("o_totalprice") + 1), target)
    return spark.table(target)


@query("SELECT * FROM orders")
def append_since_last(spark, sf_dir):
    """Three appends with nothing stated: all rows, those committed since, and none."""
    path, orders = scratch_path(spark, "orders"), table(spark, sf_dir, "orders")
    job = move.Job(path, table="orders", schema=workspace(spark), mode="append", switch=True, nested="keep")
    log_table.write_log_table(orders.filter("o_orderstatus = 'F'"), path)
    move.run_job(spark, job)
    log_table.write_log_table(orders.filter("o_orderstatus <> 'F'"), path, "append")
    for _ in range(2):
        move.run_job(spark, job)
    return spark.table(job.target)


@query("SELECT * FROM orders")
def append_folded(spark, sf_dir):
    """Appends to a target behind a view, then written as one load."""
    target, orders = f"{workspace(spark)}.orders", table(spark, sf_dir, "orders")
    for status in ("F", "O", "P"):
        load.load_direct(orders.filter(F.col("o_orderstatus") == status), target, "append", switch=True)
    pointer.fold(spark, target)
    return spark.table(target)


@query("SELECT * FROM events")
def stream_append_switched(spark, sf_dir):
    """A keyed stream into a target behind a view; its last batch is then offered again and passed over by the ledger."""
    folder = scratch_path(spark, "incoming")
    target, progress = f"{workspace(spark)}.events", f"{folder}-progress"
    events = table(spark, sf_dir, "events")
    load.load_direct(events.filter("event_type = 'click'"), target, switch=True)
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    for part in (early, ~early):
        events.filter(part).write.mode("append").parquet(folder)
        append.append_available(append.new_files(spark, folder, events.schema), target, progress, ["event_id"])
    append.append_batch(events.withColumn("event_id", -1 - F.col("event_id")), 1, target, ["event_id"], progress)
    return spark.table(target)


@query(
    """SELECT event_id, user_id, event_type, CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-20' THEN value * 2 ELSE value END AS value,
              props, ts, CAST(ts AS DATE) AS day FROM events WHERE CAST(ts AS DATE) < DATE '2024-01-20' OR event_type = 'click'"""
)
def replaced_partitions(spark, sf_dir):
    """The later days of a partitioned table are replaced by their clicks with doubled values; earlier days stay."""
    target = f"{workspace(spark)}.events"
    rows = layout.with_partition_date(table(spark, sf_dir, "events"), "ts", "day")
    load.load_direct(rows, target, definition=catalog.Definition(partition_by=("day",)))
    late = rows.filter((F.col("day") >= F.lit("2024-01-20").cast("date")) & (F.col("event_type") == "click"))
    load.load_direct(late.withColumn("value", F.col("value") * 2), target, "partitions")
    return spark.table(target)


@query("SELECT * FROM lineitem")
def compacted_files(spark, sf_dir):
    """Many small files written as few of even size, without a shuffle."""
    small, even = scratch_path(spark, "small"), scratch_path(spark, "even")
    table(spark, sf_dir, "lineitem").repartition(32).write.parquet(small)
    layout.compact_files(spark, small, even, 4 << 20)
    return spark.read.parquet(even)


@query("SELECT 'kept' AS name, * FROM orders UNION ALL SELECT 'later', * FROM orders")
def expired_tables(spark, sf_dir):
    """Of three tables one has passed its time; the rows of those that stay."""
    schema, orders = workspace(spark), table(spark, sf_dir, "orders")
    for name, moment in (("kept", None), ("gone", "2024-01-01"), ("later", "2024-06-01")):
        load.load_direct(orders, f"{schema}.{name}", switch=name == "gone")
        if moment:
            catalog.set_expiry(spark, f"{schema}.{name}", moment)
    catalog.expire_tables(spark, schema, "2024-03-01")
    left = [r.tableName for r in spark.sql(f"SHOW TABLES IN {schema}").orderBy("tableName").collect()]
    shown = [spark.table(f"{schema}.{name}").select(F.lit(name).alias("name"), "*") for name in left]
    return reduce(DataFrame.unionByName, shown)


# --------------------------------------------------------------- log tables

_logged: dict[tuple[str, str], str] = {}


def _logged_orders(spark, sf_dir) -> str:
    """A log table of three commits: finished orders, the rest appended, then all replaced with higher prices.

    Written once per application and input; the queries on it only read.
    """
    made = (spark.sparkContext.applicationId, sf_dir)
    if made not in _logged:
        _logged[made] = _write_logged_orders(spark, sf_dir)
    return _logged[made]


def _write_logged_orders(spark, sf_dir) -> str:
    path = scratch_path(spark, "orders")
    orders = table(spark, sf_dir, "orders")
    log_table.write_log_table(orders.filter("o_orderstatus = 'F'"), path, partition_by=("o_orderstatus",))
    log_table.write_log_table(orders.filter("o_orderstatus <> 'F'"), path, "append")
    dearer = orders.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    log_table.write_log_table(dearer, path, "overwrite", ("o_orderstatus",))
    return path


@query(
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority
       FROM orders"""
)
def snapshot_replay(spark, sf_dir):
    return log_table.read_table(spark, _logged_orders(spark, sf_dir))


@query("SELECT * FROM orders WHERE o_orderstatus = 'F'")
def snapshot_first_version(spark, sf_dir):
    return log_table.read_table(spark, _logged_orders(spark, sf_dir) + "@v0")


@query("SELECT * FROM orders")
def snapshot_version(spark, sf_dir):
    return log_table.read_table(spark, _logged_orders(spark, sf_dir), version=1)


@query(
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority
       FROM orders WHERE o_orderstatus = 'P'"""
)
def snapshot_partition(spark, sf_dir):
    """Files of other partitions are dropped from the list before the scan."""
    return log_table.read_table(spark, _logged_orders(spark, sf_dir), where="o_orderstatus = 'P'")


@query(
    """SELECT 'delta' AS format, 2::BIGINT AS version, count(*) AS num_records,
              'o_orderstatus' AS partition_columns FROM orders"""
)
def table_detail(spark, sf_dir):
    detail = log_table.table_detail(spark, _logged_orders(spark, sf_dir))
    return detail.select("format", "version", "num_records", "partition_columns")


@query(
    """SELECT 'source' AS side, 1::BIGINT AS copies, * FROM orders
       UNION ALL
       SELECT 'target', 1, o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1, o_orderdate, o_orderpriority FROM orders"""
)
def change_rows(spark, sf_dir):
    """What changed between two versions: both snapshots are read, rows on both sides cancel out."""
    path = _logged_orders(spark, sf_dir)
    before, after = (log_table.read_table(spark, path, version=v) for v in (1, 2))
    found = verify.row_differences(before, after)
    return found.select("side", "copies", *before.columns)


@query("SELECT * FROM orders WHERE o_orderstatus <> 'F'")
def rows_since_commit(spark, sf_dir):
    """Rows committed after the first commit's time, as the source of an append."""
    path = scratch_path(spark, "orders")
    orders = table(spark, sf_dir, "orders")
    log_table.write_log_table(orders.filter("o_orderstatus = 'F'"), path)
    first = log_table.log_history(spark, path).first().committed_at
    log_table.write_log_table(orders.filter("o_orderstatus <> 'F'"), path, "append")
    return log_table.read_since(spark, path, first.isoformat(" "))


@query("SELECT * FROM orders UNION ALL SELECT * FROM orders")
def log_rebuilt(spark, sf_dir):
    """A table whose log is lost: its plain files, replaced ones included, become a table of the catalog."""
    path, target = scratch_path(spark, "orders"), f"{workspace(spark)}.orders"
    orders = table(spark, sf_dir, "orders")
    log_table.write_log_table(orders, path)
    log_table.write_log_table(orders, path, "overwrite")
    load.load_direct(files.read_plain(spark, path), target)
    return spark.table(target)


@query("SELECT count(*) AS row_count, TRUE AS only_live_files FROM orders")
def live_file_manifest(spark, sf_dir):
    """Rows of the files that the manifest lists."""
    path = _write_logged_orders(spark, sf_dir)
    listed = spark.read.option("recursiveFileLookup", "true").text(log_table.write_manifest(spark, path))
    live = log_table.snapshot_files(spark, path)
    return live.join(listed, F.col("path") == F.col("value"), "full").agg(
        F.sum("num_records").alias("row_count"),
        F.bool_and(F.col("path").isNotNull() & F.col("value").isNotNull()).alias("only_live_files"),
    )


@query(
    """SELECT TRUE AS log_exists, 3::BIGINT AS commit_files, 0::BIGINT AS checkpoint_files,
              count(*) > 0 AS has_data FROM orders"""
)
def log_structure(spark, sf_dir):
    report = log_table.structure_report(spark, _logged_orders(spark, sf_dir))
    return report.select("log_exists", "commit_files", "checkpoint_files", (F.col("data_bytes") > 0).alias("has_data"))


@query(
    """SELECT 0::BIGINT AS version, 'WRITE' AS operation, count(*) AS added_records FROM orders
         WHERE o_orderstatus = 'F'
       UNION ALL SELECT 1, 'WRITE', count(*) FROM orders WHERE o_orderstatus <> 'F'
       UNION ALL SELECT 2, 'WRITE', count(*) FROM orders"""
)
def log_history(spark, sf_dir):
    history = log_table.log_history(spark, _logged_orders(spark, sf_dir))
    return history.select("version", "operation", "added_records")


@query("SELECT count(*) AS row_count FROM orders")
def data_files(spark, sf_dir):
    """A bare listing of a table's files, joined with what each holds."""
    path = scratch_path(spark, "orders")
    log_table.write_log_table(table(spark, sf_dir, "orders"), path)
    rows = files.read_plain(spark, path).groupBy(files.row_location().alias("path")).agg(F.count("*").alias("n"))
    return files.list_files(spark, path).join(rows, "path").agg(F.sum("n").alias("row_count"))


@query("SELECT count(*) AS row_count FROM lineitem")
def partition_report(spark, sf_dir):
    return layout.partition_report(table(spark, sf_dir, "lineitem")).agg(F.sum("row_count").alias("row_count"))


@query(
    """SELECT position, column_name, filled_rows, n - filled_rows AS null_rows FROM (
         SELECT count(*) AS n, count(doc_id) AS c1, count(text) AS c2, count(lang) AS c3, count(source) AS c4,
                count(n_chars) AS c5 FROM documents)
       CROSS JOIN LATERAL (VALUES (1, 'doc_id', c1), (2, 'text', c2), (3, 'lang', c3), (4, 'source', c4),
                                  (5, 'n_chars', c5)) AS v(position, column_name, filled_rows)"""
)
def layout_report(spark, sf_dir):
    return layout.schema_report(table(spark, sf_dir, "documents")).drop("data_type")


# ------------------------------------------------------------ verification

@query(
    """SELECT count(*) AS source_rows, 2 * count(*) AS target_rows, 0::BIGINT AS difference, TRUE AS passed
       FROM orders"""
)
def verify_counts(spark, sf_dir):
    """Count check of an append: what the target held before is added to what was loaded."""
    target = f"{workspace(spark)}.orders"
    orders = table(spark, sf_dir, "orders")
    before = load.load_direct(orders, target).rows
    load.load_direct(orders, target, "append")
    return verify.verify_counts(orders, spark.table(target), before)


@query("SELECT count(*) AS source_rows, count(*) AS target_rows, TRUE AS passed FROM lineitem")
def verify_checksum(spark, sf_dir):
    target = f"{workspace(spark)}.lineitem"
    rows = table(spark, sf_dir, "lineitem")
    load.load_direct(rows, target)
    return verify.verify_checksum(rows, spark.table(target)).select("source_rows", "target_rows", "passed")


@query(
    """SELECT count(*) AS source_rows, count(*) FILTER (o_orderstatus <> 'P') AS target_rows,
              count(*) FILTER (o_orderstatus = 'P') AS difference, count(*) FILTER (o_orderstatus = 'P') = 0 AS passed
       FROM orders"""
)
def verify_counts_short(spark, sf_dir):
    """The count check of a load that left rows out."""
    target = f"{workspace(spark)}.orders"
    orders = table(spark, sf_dir, "orders")
    load.load_direct(orders.filter("o_orderstatus <> 'P'"), target)
    return verify.verify_counts(orders, spark.table(target))


@query(
    """SELECT count(*) AS source_rows, count(*) AS target_rows, count(*) FILTER (l_returnflag = 'R') = 0 AS passed
       FROM lineitem"""
)
def verify_checksum_changed(spark, sf_dir):
    """The checksum of a table whose returned items were changed."""
    target = f"{workspace(spark)}.lineitem"
    rows = table(spark, sf_dir, "lineitem")
    load.load_direct(rows.withColumn("l_quantity", F.expr(ALTERED)), target)
    return verify.verify_checksum(rows, spark.table(target)).select("source_rows", "target_rows", "passed")


@query(
    """SELECT count(*) FILTER (o_orderkey % 7 = 0) > 0 AS sample_saw_changes,
              count(*) FILTER (o_orderkey % 7 = 0) = 0 AS passed FROM orders"""
)
def sample_diff_changed(spark, sf_dir):
    """The sample comparison, of one key in four, with every seventh order's price changed."""
    target = f"{workspace(spark)}.orders"
    orders = table(spark, sf_dir, "orders")
    load.load_direct(orders.withColumn("o_totalprice", F.expr("o_totalprice + if(o_orderkey % 7 = 0, 1, 0)")), target)
    found = verify.verify_sample(orders, spark.table(target), ["o_orderkey"], one_in=4)
    seen = (F.col("only_in_source") > 0) & (F.col("only_in_source") == F.col("only_in_target"))
    return found.select(seen.alias("sample_saw_changes"), "passed")


ALTERED = "CASE WHEN l_returnflag = 'R' THEN l_quantity + 1 ELSE l_quantity END"


@query(
    f"""WITH a AS (SELECT * FROM lineitem), b AS (SELECT * REPLACE ({ALTERED} AS l_quantity) FROM lineitem)
    SELECT 'source' AS side, count(*) AS copies, * FROM (FROM a EXCEPT ALL FROM b) GROUP BY ALL
    UNION ALL SELECT 'target', count(*), * FROM (FROM b EXCEPT ALL FROM a) GROUP BY ALL"""
)
def row_differences(spark, sf_dir):
    """Whole rows that differ after quantities of returned items were changed."""
    rows = table(spark, sf_dir, "lineitem")
    found = verify.row_differences(rows, rows.withColumn("l_quantity", F.expr(ALTERED)))
    return found.select("side", "copies", *[F.col(c).cast(rows.schema[c].dataType) for c in rows.columns])


@query(
    f"""WITH a AS (SELECT * FROM lineitem),
             b AS (SELECT * REPLACE (CASE WHEN l_orderkey % 97 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity) FROM lineitem WHERE l_orderkey % 89 <> 0)
    SELECT 'source' AS side, count(*) AS copies, * FROM (FROM a EXCEPT ALL FROM b) GROUP BY ALL
    UNION ALL SELECT 'target', count(*), * FROM (FROM b EXCEPT ALL FROM a) GROUP BY ALL"""
)
def located_differences(spark, sf_dir):
    """Whole rows that differ, found by digests over the hash of the key: few orders were changed or lost."""
    rows = table(spark, sf_dir, "lineitem")
    other = rows.filter("l_orderkey % 89 <> 0").withColumn("l_quantity", F.expr("if(l_orderkey % 97 = 0, l_quantity + 1, l_quantity)"))
    found = verify.located_differences(rows, other, ["l_orderkey", "l_linenumber"])
    return found.select("side", "copies", *[F.col(c).cast(rows.schema[c].dataType) for c in rows.columns])


@query(
    """SELECT 'items[].price' AS path, 'double' AS source_type, 'int' AS target_type, 'type differs' AS issue,
              count(*) FILTER (o_totalprice >= 100000) * 0 AS lossy_rows FROM orders
       UNION ALL SELECT 'items[].product_id', 'bigint', 'string', 'type differs', 0 FROM orders HAVING count(*) > 0
       UNION ALL SELECT 'shipping_address.city', 'string', 'int', 'type differs', count(*) FILTER (TRY_CAST(o_orderpriority AS INTEGER) IS NULL) FROM orders
       UNION ALL SELECT 'shipping_address.street', 'string', NULL, 'only in source', count(*) FROM orders
       UNION ALL SELECT 'shipping_address.zip', 'string', 'tinyint', 'type differs', count(*) FILTER (o_custkey > 127) FROM orders
       UNION ALL SELECT 'shipping_address.country', NULL, 'string', 'only in target', 0 FROM orders HAVING count(*) > 0"""
)
def schema_diff_nested(spark, sf_dir):
    """Differences inside structs and arrays, with the rows that would lose a value at each place."""
    target = T.StructType.fromDDL(
        "order_id bigint, shipping_address struct<city:int,state:string,zip:tinyint,country:string>, "
        "items array<struct<product_id:string,quantity:int,price:int>>"
    )
    return verify.schema_diff_nested(nested_orders(spark, sf_dir), target)


@query("SELECT 0::BIGINT AS only_in_source, 0::BIGINT AS only_in_target, count(*) > 0 AS passed FROM orders")
def sample_diff(spark, sf_dir):
    """Whole-row comparison of a loaded table with its source, over all keys."""
    target = f"{workspace(spark)}.orders"
    orders = table(spark, sf_dir, "orders")
    load.load_direct(orders, target)
    return verify.verify_sample(orders, spark.table(target), ["o_orderkey"])


@query(
    """SELECT 'unique(l_orderkey,l_linenumber)' AS "check", (SELECT count(*) FROM (
         SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)) AS violations,
         (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)) = 0
           AS passed
       UNION ALL SELECT 'not_null(l_orderkey)', count(*) FILTER (l_orderkey IS NULL),
         count(*) FILTER (l_orderkey IS NULL) = 0 FROM lineitem
       UNION ALL SELECT 'not_null(l_shipdate)', count(*) FILTER (l_shipdate IS NULL),
         count(*) FILTER (l_shipdate IS NULL) = 0 FROM lineitem"""
)
def not_null_and_key(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    return verify.verify_keys(rows, ["l_orderkey", "l_linenumber"], ["l_orderkey", "l_shipdate"])


# ------------------------------------------------------------------- moves

MOVED = ["customer", "orders", "part"]


def _batch(spark, sf_dir) -> DataFrame:
    """Moves three log tables and fails on one that does not exist."""
    root, schema = scratch_path(spark, "lake"), workspace(spark)
    for name in MOVED:
        log_table.write_log_table(table(spark, sf_dir, name), f"{root}/{name}")
    entries = [
        {"source_path": f"{root}/{name}", "schema": schema, "table": name, "stage_root": f"{root}/stage"}
        for name in [MOVED[0], "absent", *MOVED[1:]]
    ]
    config = f"{root}-config"
    text_frame(spark, [json.dumps(entries)]).write.text(config)
    return move.move_all(spark, config, parallel=2)


@query(
    " UNION ALL ".join(
        f"SELECT '{n}' AS \"table\", 'SUCCESS' AS status, count(*) AS source_rows, count(*) AS target_rows, "
        f"TRUE AS verified FROM {n}"
        for n in MOVED
    )
    + " UNION ALL SELECT 'absent', 'FAILED', NULL, NULL, NULL"
)
def batch_summary(spark, sf_dir):
    return _batch(spark, sf_dir).select("table", "status", "source_rows", "target_rows", "verified")


@query("SELECT 3::BIGINT AS succeeded, 4::BIGINT AS tables FROM orders HAVING count(*) > 0")
def batch_totals(spark, sf_dir):
    return move.batch_totals(_batch(spark, sf_dir))


def _configured(spark, entries: list[dict], path: str) -> str:
    text_frame(spark, [json.dumps(entries)]).write.text(path)
    return path


@query(
    """SELECT c_custkey AS "key", 'customer' AS "table", 1 AS copies FROM customer
       UNION ALL SELECT o_orderkey, 'orders', 2 FROM orders"""
)
def batch_resumed(spark, sf_dir):
    """A batch of appends in which one table fails, run again with its ledger: the table that was moved is not appended twice.

    Orders are appended once more by a job of their own, so both counts are seen.
    """
    root, schema = scratch_path(spark, "lake"), workspace(spark)
    entries = [
        {"source_path": f"{root}/{name}", "schema": schema, "table": name, "mode": "append", "stage_root": f"{root}/stage"}
        for name in ("customer", "orders")
    ]
    batch, ledger = _configured(spark, entries, f"{root}-config"), f"{root}-ledger"
    log_table.write_log_table(table(spark, sf_dir, "customer"), f"{root}/customer")
    move.move_all(spark, batch, parallel=2, ledger=ledger)
    log_table.write_log_table(table(spark, sf_dir, "orders"), f"{root}/orders")
    for _ in range(2):
        move.move_all(spark, batch, parallel=2, ledger=ledger)
    move.run_job(spark, move.Job(f"{root}/orders", table="orders", schema=schema, mode="append"))
    one = lambda name, key: spark.table(f"{schema}.{name}").groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).cast("int").alias("copies")).withColumn("table", F.lit(name))
    return one("customer", "c_custkey").unionByName(one("orders", "o_orderkey")).select("key", "table", "copies")


@query("SELECT * FROM part")
def command_line(spark, sf_dir):
    """One table moved by the command line's own entry point."""
    path, schema = scratch_path(spark, "part"), workspace(spark)
    log_table.write_log_table(table(spark, sf_dir, "part"), path)
    stage = scratch_path(spark, "stage")
    status = cli.main(["--source-path", path, "--schema", schema, "--table", "part", "--stage-root", stage, "--strict-verify", "--checksum"], spark)
    return spark.table(f"{schema}.part").filter(F.lit(status == 0))


# ------------------------------------------------------------ sample tables

SEED = 7


def _draw_sql(key: str, label: str) -> str:
    low, high, shift, spread, offset = draws.factors(SEED, label)
    mixed = f"(({key} & {draws.KEY_PRIME}) * {low} + ({key} >> 31) * {high} + {shift}) % {draws.KEY_PRIME}"
    return f"((({mixed}) * {spread} + {offset}) % {draws.DRAW_PRIME})"


def _int_sql(key: str, label: str, low: int, high: int) -> str:
    return f"CAST({low} + {_draw_sql(key, label)} % {high - low + 1} AS INTEGER)"


def _decimal_sql(key: str, label: str, low: int, high: int, scale: int) -> str:
    return f"CAST({low} + {_draw_sql(key, label)} % {high - low + 1} AS DOUBLE) / {scale}"


def _pick_sql(key: str, label: str, values: list[str]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[{_int_sql(key, label, 1, len(values))}]"


def _day_sql(key: str, label: str, low: int, high: int) -> str:
    return f"strftime(DATE '{sample_tables.BASE_DATE}' - {_int_sql(key, label, low, high)}, '%Y-%m-%d')"


@query(
    f"""SELECT CAST(c_custkey AS INTEGER) AS customer_id,
      {_pick_sql("c_custkey", "first_name", sample_tables.FIRST_NAMES)} AS first_name,
      {_pick_sql("c_custkey", "last_name", sample_tables.LAST_NAMES)} AS last_name,
      concat('customer', c_custkey, '@example.com') AS email,
      concat('+1-555-', {_int_sql("c_custkey", "phone.1", 1000, 9999)}, '-',
             {_int_sql("c_custkey", "phone.2", 1000, 9999)}) AS phone,
      {_day_sql("c_custkey", "registration_date", 1, 365)} AS registration_date,
      {_pick_sql("c_custkey", "country", sample_tables.COUNTRIES)} AS country,
      {_int_sql("c_custkey", "is_active", 0, 1)} = 1 AS is_active,
      {_decimal_sql("c_custkey", "lifetime_value", 10000, 1000000, 100)} AS lifetime_value,
      '2025-01-01T00:00:00.000000' AS created_at
    FROM customer"""
)
def sample_customers(spark, sf_dir):
    ids = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return sample_tables.customers_for(ids, SEED)


@query(
    f"""SELECT CAST(o_orderkey AS INTEGER) AS order_id, {_int_sql("o_orderkey", "customer_id", 1, 1000)} AS customer_id,
      {_day_sql("o_orderkey", "order_date", 1, 180)} AS order_date,
      {_decimal_sql("o_orderkey", "order_amount", 1000, 100000, 100)} AS order_amount,
      {_pick_sql("o_orderkey", "status", sample_tables.STATUSES)} AS status,
      {_pick_sql("o_orderkey", "payment_method", sample_tables.PAYMENTS)} AS payment_method,
      concat({_int_sql("o_orderkey", "street", 100, 9999)}, ' Main St') AS street,
      {_pick_sql("o_orderkey", "city", sample_tables.CITIES)} AS city,
      {_pick_sql("o_orderkey", "state", sample_tables.STATES)} AS state,
      CAST({_int_sql("o_orderkey", "zip", 10000, 99999)} AS VARCHAR) AS zip,
      {_int_sql("((o_orderkey << 4) + i)", "product_id", 1, 100)} AS product_id,
      {_int_sql("((o_orderkey << 4) + i)", "quantity", 1, 5)} AS quantity,
      {_decimal_sql("((o_orderkey << 4) + i)", "price", 1000, 20000, 100)} AS price
    FROM orders, LATERAL (SELECT unnest(range(1, 1 + {_int_sql("o_orderkey", "items", 1, 3)})) AS i)"""
)
def sample_orders(spark, sf_dir):
    """One row per item."""
    ids = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    orders = sample_tables.orders_for(ids, SEED)
    # Outer, although no order lacks items: it saves a check that would compute the items twice.
    flat = orders.select("*", "shipping_address.*", F.inline_outer("items"))
    return flat.drop("shipping_address", "items", "created_at")


@query(
    f"""SELECT CAST(p_partkey AS INTEGER) AS product_id, concat('Product ', p_partkey) AS product_name,
      {_pick_sql("p_partkey", "category", sample_tables.CATEGORIES)} AS category,
      {_pick_sql("p_partkey", "brand", sample_tables.BRANDS)} AS brand,
      {_decimal_sql("p_partkey", "price", 999, 99999, 100)} AS price,
      {_decimal_sql("p_partkey", "cost", 500, 50000, 100)} AS cost,
      {_int_sql("p_partkey", "stock_quantity", 0, 1000)} AS stock_quantity,
      concat('High quality product number ', p_partkey, ' with excellent features') AS description,
      {_decimal_sql("p_partkey", "rating", 10, 50, 10)} AS rating,
      {_int_sql("p_partkey", "review_count", 0, 500)} AS review_count,
      {_int_sql("p_partkey", "is_available", 0, 1)} = 1 AS is_available,
      array_to_string(list_slice(([{", ".join(map(str, map(list, draws.orderings(sample_tables.TAGS, 3))))}])
        [{_int_sql("p_partkey", "tags", 1, 60)}], 1, {_int_sql("p_partkey", "tags.count", 0, 3)}), ',') AS tags
    FROM part"""
)
def sample_products(spark, sf_dir):
    ids = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"))
    rows = sample_tables.products_for(ids, SEED).drop("created_at", "updated_at")
    return rows.withColumn("tags", F.array_join("tags", ","))

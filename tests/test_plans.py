"""Reports, sample tables, moves and the command line."""

import json
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tableferry.functions.mapping import map_schema
from tableferry.operators import load
from tableferry.plans import cli, move, reports, sample_cli, sample_tables
from tableferry.plans.move import Job
from tableferry.sources import catalog, log_table


@pytest.fixture(scope="module")
def shop(spark):
    customers = spark.createDataFrame(
        [
            (1, "A", "B", "a@x", "US", True),
            (2, "C", "D", "c@x", "US", False),
            (3, "E", "F", "e@x", "FR", None),
            (3, "E", "F", "e@x", "FR", None),
            (None, "G", "H", None, "DE", True),
        ],
        "customer_id int, first_name string, last_name string, email string, country string, is_active boolean",
    )
    orders = spark.sql("""
      SELECT * FROM VALUES (1, 1, 10D, date'2025-01-01', 'a'), (2, 1, 20D, date'2025-01-03', 'b'),
        (3, 3, null, date'2025-01-02', 'a'), (null, 3, 4D, null, null), (5, null, 9D, date'2025-01-09', 'a'),
        (6, 99, 1D, date'2025-01-09', 'a')
      AS o(order_id, customer_id, order_amount, order_date, status)""")
    return customers, orders


def join_then_group(customers, orders, keys):
    """What the reports must equal: join first, group afterwards."""
    joined = customers.alias("c").join(orders.alias("o"), F.col("c.customer_id") == F.col("o.customer_id"), "left")
    return joined.groupBy(*[F.col(f"c.{k}") for k in keys]).agg(
        F.count_distinct("c.customer_id").alias("customers"),
        F.count("o.order_id").alias("total_orders"),
        F.sum("order_amount").alias("total"),
        F.avg("order_amount").alias("avg_order_value"),
        F.max("order_date").alias("last"),
    )


def test_summary_equals_join_then_group(shop):
    found = reports.customer_order_summary(*shop)
    plain = join_then_group(*shop, reports.SUMMARY_KEYS).drop("customers")
    assert rows(found, "customer_id") == rows(plain, "customer_id")
    by_id = {r.customer_id: r for r in found.collect()}
    assert tuple(by_id[2])[5:] == (0, None, None, None)
    assert (by_id[3].total_orders, by_id[3].total_spent, by_id[3].avg_order_value) == (2, 8.0, 4.0)


def test_revenue_equals_join_then_group(shop):
    found = reports.country_revenue(*shop)
    plain = join_then_group(*shop, ["country"]).drop("last")
    assert rows(found, "country") == rows(plain, "country")
    assert [r.country for r in found.collect()] == ["US", "FR", "DE"]


def test_summary_joins_one_row_per_customer_and_shuffles_once_per_side(spark, shop):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = reports.customer_order_summary(*shop)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 2


def test_quality_counts(shop):
    assert tuple(reports.customer_quality(shop[0]).first()) == (5, 3, 3, 2, 1)


def test_products(spark):
    products = spark.createDataFrame(
        [
            (1, "p", "x", "b", 1.0, 4.0, 5, 7, True),
            (2, "p", "x", "b", 2.0, 4.0, 9, 7, True),
            (3, "p", "y", "b", 3.0, None, 9, None, True),
            (4, "p", "y", "b", 5.0, 5.0, 9, 7, False),
            (5, "p", "y", "b", None, 5.0, 9, 7, None),
            (6, "p", "x", "b", 1.0, 4.0, 5, 7, True),
        ],
        "product_id int, product_name string, category string, brand string, price double, rating double, "
        "review_count int, stock_quantity int, is_available boolean",
    )
    assert [r.product_id for r in reports.product_performance(products).collect()] == [2, 1, 6, 3]
    assert [r.product_id for r in reports.top_products(products, 2).collect()] == [2, 1]
    assert "TakeOrderedAndProject" in reports.top_products(products, 2)._jdf.queryExecution().executedPlan().toString()
    assert rows(reports.category_stats(products)) == [("x", 3, 4 / 3, 4.0, 21), ("y", 3, 4.0, 5.0, 14)]


def test_orders_since_reaches_the_partitions(spark, schema, shop):
    load.write_table(shop[1], f"{schema}.o", definition=catalog.Definition(("order_date",), ("status",)))
    found = reports.orders_since(spark.table(f"{schema}.o"), "2025-01-02", "a")
    assert rows(found, "customer_id") == [(None, 9.0, "a"), (3, None, "a"), (99, 1.0, "a")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_date" in plan and "EqualTo(status,a)" in plan
    assert "ReadSchema: struct<customer_id:int,order_amount:double,status:string>" in plan


def test_table_counts_and_preview(spark):
    tables = {"a": spark.range(3), "b": spark.range(0)}
    assert rows(reports.table_counts(tables), "table_name") == [("a", 3), ("b", 0)]
    assert rows(reports.preview(spark.range(9), ["id"], 2, [F.desc("id")])) == [(8,), (7,)]
    assert reports.preview(spark.range(9), ["id"], 2).count() == 2


def test_sample_tables_fit_their_targets(spark, schema):
    made = {
        "customers": sample_tables.sample_customers(spark, 300, seed=1),
        "orders": sample_tables.sample_orders(spark, 400, seed=1),
        "products": sample_tables.sample_products(spark, 200, seed=1),
    }
    assert [df.count() for df in made.values()] == [300, 400, 200]
    for name, frame in made.items():
        target, definition = sample_tables.target_table(name)
        mapped = map_schema(frame, target)
        assert mapped.count() == frame.count()
        catalog.create_table(spark, f"{schema}.{name}", target, definition)
        load.write_table(mapped, f"{schema}.{name}", "append")
        assert spark.table(f"{schema}.{name}").count() == frame.count()
        assert catalog.table_definition(spark, f"{schema}.{name}") == definition
    pairs = rows(reports.order_cities(spark.table(f"{schema}.orders")), "order_id")
    target, definition = sample_tables.target_table("orders_json")
    catalog.create_table(spark, f"{schema}.orders_json", target, definition)
    load.write_table(map_schema(made["orders"], target), f"{schema}.orders_json", "append")
    texts = rows(reports.order_cities_json(spark.table(f"{schema}.orders_json")), "order_id")
    assert [(i, city, len(json.loads(items))) for i, city, items in texts] == pairs
    reports.create_report_views(spark, schema)
    summary = reports.customer_order_summary(spark.table(f"{schema}.customers"), spark.table(f"{schema}.orders"))
    assert rows(spark.table(f"{schema}.customer_order_summary"), "customer_id") == rows(summary, "customer_id")
    available = spark.table(f"{schema}.products").filter("is_available").count()
    assert spark.table(f"{schema}.product_performance").count() == available


def test_sample_tables_repeat_and_differ_by_seed(spark):
    one, same, other = (rows(sample_tables.sample_orders(spark, 50, seed=s), "order_id") for s in (1, 1, 2))
    assert one == same != other
    assert all(1 <= r[1] <= 1000 and 10 <= r[3] <= 1000 and 1 <= len(r[7]) <= 3 for r in one)


@pytest.fixture
def source(spark, tmp_path):
    path = str(tmp_path / "lake" / "t")
    log_table.write_log_table(spark.sql("SELECT id, array(id) AS l, '2025-01-02' AS d FROM range(5)"), path)
    return path


def result(spark, job, **flags):
    return move.move_table(spark, job, **flags).first()


@pytest.mark.parametrize("method", ["staged", "direct", "parquet", "connector"])
def test_move_one_table(spark, schema, source, tmp_path, method):
    job = Job(source, "t", schema, stage_root=str(tmp_path / "stage"), method=method, date_columns=("d",))
    row = result(spark, job)
    assert (row.status, row.source_version, row.verified) == ("SUCCESS", 0, True)
    assert row.source_rows == row.target_rows == 5
    assert row.staged_path is None and row.error is None
    assert spark.table(f"{schema}.t").dtypes == [("id", "bigint"), ("l", "string"), ("d", "date")]
    stage = tmp_path / "stage" / schema
    assert not stage.exists() or not list(stage.iterdir())


def test_move_keeps_the_stage_on_request(spark, schema, source, tmp_path):
    row = result(spark, Job(source, "t", schema, stage_root=str(tmp_path / "stage")), cleanup=False)
    assert os.path.isdir(row.staged_path)


def test_target_in_a_named_catalog(spark, schema, source):
    for mode, total in (("overwrite", 5), ("overwrite", 5), ("append", 10)):
        row = result(spark, Job(source, "t", schema, catalog="spark_catalog", mode=mode))
        assert (row.status, row.target_rows, row.error) == ("SUCCESS", total, None)
    assert spark.table(f"{schema}.t").count() == 10


def test_failed_load_leaves_no_stage(spark, schema, source, tmp_path):
    load.write_table(spark.range(1).withColumnRenamed("id", "other"), f"{schema}.t")
    row = result(spark, Job(source, "t", schema, mode="append", stage_root=str(tmp_path / "stage")))
    assert row.status == "FAILED" and "differ" in row.error
    assert not list((tmp_path / "stage" / schema).iterdir())
    assert spark.table(f"{schema}.t").count() == 1


def test_partitioning_is_carried_over(spark, schema, tmp_path):
    path = str(tmp_path / "lake")
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "id int, k string")
    log_table.write_log_table(frame, path, partition_by=("k",))
    for _ in range(2):
        assert result(spark, Job(path, "t", schema)).verified
        assert catalog.table_definition(spark, f"{schema}.t").partition_by == ("k",)
    assert result(spark, Job(path, "u", schema, cluster_by=("id",))).verified
    assert catalog.table_definition(spark, f"{schema}.u").partition_by == ()


def test_connector_options():
    job = Job("x", "t", "s", project="p", format="bigquery", stage_root="gs://bucket/stage", partition_by=("d",),
              cluster_by=("a", "b"), options={"writeMethod": "indirect"})
    assert move.connector_options(job) == {
        "table": "p.s.t",
        "temporaryGcsBucket": "bucket",
        "writeMethod": "indirect",
        "partitionField": "d",
        "partitionType": "DAY",
        "clusteredFields": "a,b",
    }


def test_append_through_a_connector(spark, source, tmp_path):
    out = {"path": str(tmp_path / "out")}
    for total in (5, 10):
        row = result(spark, Job(source, "t", "s", format="orc", options=out, mode="append"))
        assert (row.status, row.target_rows, row.verified) == ("SUCCESS", total, True)


def test_move_appends_and_verifies_with_the_rows_before(spark, schema, source):
    for total in (5, 10):
        row = result(spark, Job(source, "t", schema, mode="append", nested="keep"))
        assert (row.status, row.target_rows, row.verified) == ("SUCCESS", total, True)
    assert result(spark, Job(source, "t", schema), verify=False).verified is None


def test_move_pins_the_version_it_read(spark, schema, source):
    log_table.write_log_table(spark.sql("SELECT id, array(id) AS l, '' AS d FROM range(2)"), source, "append")
    row = result(spark, Job(source + "@v0", "t", schema))
    assert (row.source_version, row.target_rows, row.verified) == (0, 5, True)
    assert result(spark, Job(source, "t", schema)).target_rows == 7


def test_append_only_what_is_new(spark, schema, source):
    first = log_table.log_history(spark, source).first().committed_at
    by = {"k": {"key": ("id",)}, "c": {"incremental_column": "id"}, "s": {"since": str(first)}}
    assert "only make sense" in result(spark, Job(source, "k", schema, key=("id",))).error
    for name in by:
        assert result(spark, Job(source, name, schema)).target_rows == 5
    later = spark.sql("SELECT id + 5 AS id, array(id) AS l, '2025-01-03' AS d FROM range(2)")
    log_table.write_log_table(later, source, "append")
    for name, only_new in by.items():
        row = result(spark, Job(source, name, schema, mode="append", **only_new))
        assert (row.status, row.source_rows, row.target_rows, row.verified) == ("SUCCESS", 2, 7, True)
        assert rows(spark.table(f"{schema}.{name}").select("id"), "id") == [(i,) for i in range(7)]
    for name in "kc":
        row = result(spark, Job(source, name, schema, mode="append", **by[name]))
        assert (row.status, row.source_rows, row.target_rows, row.verified) == ("SUCCESS", 0, 7, True)


def test_move_reports_failures(spark, schema, source, tmp_path):
    assert "missing table" in result(spark, Job(source, None, schema)).error
    assert "unknown method" in result(spark, Job(source, "t", schema, method="fax")).error
    assert "unknown mode" in result(spark, Job(source, "t", schema, mode="merge")).error
    assert result(spark, Job(str(tmp_path / "absent"), "t", schema)).status == "FAILED"


def test_failed_check_warns_or_fails(spark, schema, source, monkeypatch):
    monkeypatch.setattr(move, "verify_counts", lambda *a: spark.sql("SELECT false AS passed, 4L AS target_rows"))
    row = result(spark, Job(source, "t", schema))
    assert (row.status, row.verified, row.target_rows) == ("SUCCESS", False, 4)
    row = result(spark, Job(source, "t", schema), strict_verify=True)
    assert (row.status, row.verified) == ("FAILED", False)
    monkeypatch.setattr(move, "verify_counts", lambda *a: 1 / 0)
    assert result(spark, Job(source, "t", schema)).verified is False


def test_checksum_of_a_move(spark, schema, source, monkeypatch):
    for nested in ("json", "keep"):
        assert result(spark, Job(source, "t", schema, nested=nested), checksum=True).verified
    assert result(spark, Job(source, "t", schema, mode="append", nested="keep"), checksum=True).verified
    changed = spark.sql("SELECT id, array(id) AS l, 'x' AS d FROM range(5)")
    monkeypatch.setattr(move, "_read_target", lambda *a: changed)
    assert result(spark, Job(source, "t", schema)).verified
    assert result(spark, Job(source, "t", schema, nested="keep"), checksum=True).verified is False


def test_move_plain_parquet_through_a_connector(spark, tmp_path):
    spark.range(6).write.parquet(str(tmp_path / "plain"))
    out = {"path": str(tmp_path / "out")}
    job = Job(str(tmp_path / "plain"), "t", "s", project="p", format="orc", options=out, method="direct")
    assert job.target == "p.s.t"
    row = result(spark, job)
    assert (row.status, row.source_version, row.target_rows, row.verified) == ("SUCCESS", None, 6, True)


def test_batch_keeps_failures_apart(spark, schema, source, tmp_path):
    config = tmp_path / "config.json"
    entries = [
        {"source_path": source, "schema": schema, "table": "one", "partition_by": ["d"], "nested": "keep"},
        {"source_path": source, "schema": schema},
        {"source_path": str(tmp_path / "absent"), "schema": schema, "table": "two"},
        {
            "gcs_delta_path": source,
            "bq_project": "p",
            "bq_dataset": schema,
            "bq_table": "three",
            "temp_bucket": str(tmp_path),
        },
    ]
    config.write_text(json.dumps(entries, indent=2))
    results = move.move_all(spark, str(config), method="direct")
    assert [(r.table, r.status, r.method) for r in results.collect()] == [
        ("one", "SUCCESS", "direct"),
        (None, "FAILED", "direct"),
        ("two", "FAILED", "direct"),
        ("three", "SUCCESS", "direct"),
    ]
    assert tuple(move.batch_totals(results).first()) == (2, 4)
    assert spark.sql(f"SHOW PARTITIONS {schema}.one").count() == 1
    again = move.move_all(spark, str(config), mode="append", parallel=3)
    assert [r.target_rows for r in again.collect()] == [10, None, None, 10]


def test_bare_bucket_names(spark, tmp_path):
    (tmp_path / "c.json").write_text('[{"temp_bucket": "some-bucket", "bq_table": "t"}]')
    job = move.jobs_from_config(spark, str(tmp_path / "c.json"))[0]
    assert (job.stage_root, job.table, job.source_path) == ("gs://some-bucket", "t", None)


def test_command_line(spark, source, tmp_path):
    assert cli.main(["--source-path", source, "--schema", "default", "--table", "from_cli"]) == 0
    assert spark.table("from_cli").count() == 5
    assert cli.main(["--delta-path", source + "x", "--bq-dataset", "default", "--bq-table", "t"]) == 1
    with pytest.raises(SystemExit) as stopped:
        cli.main(["--source-path", source])
    assert stopped.value.code == 2


def test_sample_command_line_honours_row_counts(spark, tmp_path, capsys):
    sizes = {"customers": 30, "orders": 40, "products": 20}
    given = [text for name, n in sizes.items() for text in (f"--{name}", str(n))]
    assert sample_cli.main(["--output-dir", str(tmp_path), *given]) == 0
    assert {n: log_table.read_table(spark, str(tmp_path / n)).count() for n in sizes} == sizes
    assert "orders: version 0, 1 commits" in capsys.readouterr().out


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from tableferry import session

    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "yarn"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_root(Session())

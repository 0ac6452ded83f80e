"""Layout, catalog tables, loads, incremental and streaming appends."""

import os
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.operators import incremental, layout, load
from tableferry.sources import catalog
from tableferry.sources.catalog import Definition
from tableferry.sources.files import list_files
from tableferry.streaming import append


def plan(df):
    return df._jdf.queryExecution().toString()


def test_files_are_packed_by_size(spark, tmp_path):
    """Many small files of different sizes and a large one become files within the stated band, without a shuffle."""
    source, target = f"{tmp_path}/in", 200_000
    noise = spark.range(0, 60_000, 1, 1).select("id", F.sha2(F.col("id").cast("string"), 256).alias("s"))
    for low, high, n in ((0, 2_000, 40), (2_000, 9_000, 7), (9_000, 60_000, 1)):
        noise.filter(f"id >= {low} and id < {high}").repartition(n).write.mode("append").parquet(source)
    before = list_files(spark, source)
    assert before.count() == 48
    scans = list(layout.packed_scan(spark, before, target))
    assert all("Exchange" not in plan(s) for s in scans)
    assert layout.compact_files(spark, source, f"{tmp_path}/out", target) == 60_000
    sizes = sorted(r["size"] for r in list_files(spark, f"{tmp_path}/out").collect())
    total = sum(sizes)
    filled = {r[0] for r in spark.read.parquet(f"{tmp_path}/out").select("_metadata.file_size").distinct().collect()}
    small = [x for x in sizes if x < target / 2 and x in filled]
    assert len(small) <= 1 and len(sizes) <= 2 * total / target + 1
    after = spark.read.parquet(f"{tmp_path}/out")
    assert after.exceptAll(noise).isEmpty() and noise.exceptAll(after).isEmpty()
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "134217728b"


def test_partition_folders_are_packed_too(spark, tmp_path):
    frame = spark.range(100).selectExpr("id", "id % 3 AS part")
    frame.write.partitionBy("part").parquet(f"{tmp_path}/in")
    assert layout.compact_files(spark, f"{tmp_path}/in", f"{tmp_path}/out") == 100
    assert rows(spark.read.parquet(f"{tmp_path}/out").select("id", "part"), "id") == rows(frame, "id")
    assert list_files(spark, f"{tmp_path}/out").count() == 1


def test_shrink_merges_no_more_scan_partitions_than_a_target_file(spark, tmp_path):
    """Fourteen partitions of the largest size: four and more in one task would exceed the target."""
    path, name = str(tmp_path / "many"), "spark.sql.files.maxPartitionBytes"
    spark.range(0, 14, 1, 14).write.parquet(path)
    before = {n: spark.conf.get(n) for n in (name, "spark.sql.files.openCostInBytes")}
    try:
        for each, most in (("128m", 2), ("100m", 2), ("256m", 1), ("512m", 1), ("16m", 4)):
            spark.conf.set(name, each)
            spark.conf.set("spark.sql.files.openCostInBytes", each)  # so that every file is a partition
            frame = spark.read.parquet(path)
            assert frame.rdd.getNumPartitions() == 14
            merged = layout.shrink_partitions(frame, how="coalesce")
            assert merged.rdd.getNumPartitions() == -(-14 // most)
            assert max(merged.select("id").rdd.glom().map(len).collect()) <= most
            assert sorted(r.id for r in merged.collect()) == list(range(14))
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)


def test_shrink_partitions(spark):
    assert layout.shrink_partitions(spark.range(0, 100, 1, 9), how="coalesce").rdd.getNumPartitions() == 2
    assert layout.shrink_partitions(spark.range(0, 100, 1, 3), how="coalesce").rdd.getNumPartitions() == 1
    assert layout.shrink_partitions(spark.range(100).filter("id < 0"), how="coalesce").count() == 0
    assert "Rebalance" in plan(layout.shrink_partitions(spark.range(9), how="rebalance"))
    with pytest.raises(ValueError):
        layout.shrink_partitions(spark.range(9), how="magic")


def test_hot_cluster_value_is_spread_and_sorted(spark):
    """Two thirds of the rows are copies of one row; ranges still split them."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    frame = spark.range(0, 60000, 1, 12).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(7).alias("k"))
    placed = layout.arrange(frame, cluster_by=("k",))
    sizes = [r.row_count for r in layout.partition_report(placed).collect()]
    assert sum(sizes) == 60000
    assert max(sizes) < 60000 * 0.5
    assert placed.columns == ["k"]
    with_place = placed.select("k", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("at"))
    by_part = {}
    for r in with_place.orderBy("at").collect():
        by_part.setdefault(r.p, []).append(r.k)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert all(v == sorted(v) for v in by_part.values())


def test_partition_dates(spark):
    frame = spark.sql("SELECT timestamp'2025-03-04 05:06:07' AS t")
    found = {g: str(layout.with_partition_date(frame, "t", "d", g).first().d) for g in layout.GRAINS}
    assert found == {"hour": "2025-03-04-05", "day": "2025-03-04", "month": "2025-03-01", "year": "2025-01-01"}
    with pytest.raises(ValueError):
        layout.with_partition_date(frame, "t", "d", "week")


def test_cached_releases_on_failure(spark):
    frame = spark.range(5)
    with pytest.raises(RuntimeError):
        with layout.cached(frame) as kept:
            assert kept.storageLevel.useMemory
            raise RuntimeError
    assert not frame.storageLevel.useMemory


def test_schema_report(spark):
    frame = spark.createDataFrame([(1, None), (2, "x")], "a int, `b.c` string")
    assert rows(layout.schema_report(frame), "position") == [(1, "a", "int", 2, 0), (2, "b.c", "string", 1, 1)]


def test_create_table_keeps_its_definition(spark, schema):
    name = f"{schema}.t"
    definition = Definition(("day",), ("k",), 0, "it's a table", {"env": "test"})
    catalog.create_table(spark, name, T.StructType.fromDDL("id bigint NOT NULL, k string, day date"), definition)
    assert catalog.table_definition(spark, name) == definition
    catalog.set_property(spark, name, "env", "live")
    assert catalog.table_definition(spark, name).properties == {"env": "live"}
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        catalog.create_table(spark, name, T.StructType.fromDDL("id int"))
    catalog.create_table(spark, name, T.StructType.fromDDL("id int"), replace=True)
    assert spark.table(name).columns == ["id"]
    catalog.drop_table(spark, name)
    assert not catalog.table_exists(spark, name)
    catalog.drop_table(spark, name)


def test_views(spark, schema):
    spark.range(3).write.saveAsTable(f"{schema}.t")
    catalog.create_view(spark, f"{schema}.v", f"SELECT max(id) AS top FROM {schema}.t")
    assert spark.table(f"{schema}.v").first().top == 2
    catalog.create_view(spark, "session_view", spark.range(4))
    assert spark.table("session_view").count() == 4
    spark.catalog.dropTempView("session_view")


def test_overwrite_keeps_layout_and_may_read_itself(spark, schema):
    name = f"{schema}.t"
    definition = Definition(("k",), (), 0, "about", {"env": "test"})
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "id int, k string")
    assert load.write_table(frame, name, "overwrite", definition) == 2
    assert load.write_table(spark.table(name).filter("id = 2"), name) == 1
    assert rows(spark.table(name)) == [(2, "b")]
    assert catalog.table_definition(spark, name) == definition
    assert load.write_table(spark.range(5), name) == 5
    assert spark.table(name).columns == ["id"]
    assert not catalog.table_exists(spark, f"{name}__incoming")


def test_failed_overwrite_leaves_the_old_table(spark, schema):
    name = f"{schema}.t"
    load.write_table(spark.range(3), name)
    failure = F.raise_error(F.lit("boom")).cast("bigint")
    broken = spark.range(3).select(F.when(F.col("id") == 2, failure).otherwise(0).alias("id"))
    with pytest.raises(Exception, match="boom"):
        load.write_table(broken, name)
    assert spark.table(name).count() == 3
    assert not catalog.table_exists(spark, f"{name}__incoming")


def test_append_matches_by_name(spark, schema):
    name = f"{schema}.t"
    load.write_table(spark.createDataFrame([(1, "a")], "id int, k string"), name, "append")
    load.write_table(spark.createDataFrame([("b", 2)], "k string, id int"), name, "append")
    assert rows(spark.table(name), "id") == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError, match="differ"):
        load.write_table(spark.range(1), name, "append")
    with pytest.raises(ValueError, match="unknown mode"):
        load.write_table(spark.range(1), name, "merge")


def test_strict_load_refuses_a_bad_cast(spark, schema):
    name = f"{schema}.t"
    load.write_table(spark.range(1), name)
    with pytest.raises(Exception, match="(?i)cast"):
        load.write_table(spark.createDataFrame([("x",)], "id string"), name, "append")
    assert spark.table(name).count() == 1


def test_odd_column_names(spark, schema):
    frame = spark.sql("SELECT id, CAST(id % 2 AS string) AS `a.b`, id AS `c d` FROM range(10)")
    load.write_table(frame, f"{schema}.p", definition=Definition(("a.b",), ("c d",)))
    load.write_table(frame, f"{schema}.c", definition=Definition((), ("a.b", "c d")))
    for name in "pc":
        assert rows(spark.table(f"{schema}.{name}").select("id", "`a.b`", "`c d`"), "id") == rows(frame, "id")


def test_staged_load(spark, schema, tmp_path):
    name = f"{schema}.t"
    frame = spark.sql("SELECT 1 AS id, array(1, 2) AS l")
    result = load.load_staged(frame, name, str(tmp_path))
    assert result.rows == 1
    assert result.staged_path.startswith(f"{tmp_path}/{schema}/t_2")
    parts = [f for f in os.listdir(result.staged_path) if f.endswith(".parquet")]
    assert parts and all(".snappy." in f for f in parts)
    assert rows(spark.table(name)) == [(1, "[1,2]")]
    assert load.load_staged(frame, name, str(tmp_path), "append", nested="json").rows == 1
    assert spark.table(name).count() == 2
    assert load.remove_stage(spark, result.staged_path)
    assert not os.path.exists(result.staged_path)
    assert not load.remove_stage(spark, result.staged_path)
    assert not load.remove_stage(spark, "nosuchscheme://x")


def test_permissive_load(spark, schema, tmp_path):
    frame = spark.createDataFrame([(1, "2025-01-01"), (2, "x"), (None, "2025-01-03")], "id int, d string")
    wanted = T.StructType.fromDDL("id bigint NOT NULL, d date")
    for times in (1, 2):
        result, rejected = load.load_permissive(frame, wanted, f"{schema}.t", f"{schema}.bad", str(tmp_path))
        assert (result.rows, rejected) == (1, 2)
        assert spark.table(f"{schema}.t").dtypes == [("id", "bigint"), ("d", "date")]
        assert spark.table(f"{schema}.t").count() == 1
        assert spark.table(f"{schema}.bad").count() == 2, "a repeated overwrite must not double the rejects"
    bad = spark.table(f"{schema}.bad").select("_rejects", "_source").distinct()
    assert rows(bad, "_source") == [
        ('["d"]', '{"id":2,"d":"x"}'),
        ('["id"]', '{"id":null,"d":"2025-01-03"}'),
    ]


def test_stage_name():
    assert load.stage_path("/s/", "a.b", datetime(2025, 1, 2, 3, 4, 5)) == "/s/a/b_20250102_030405"


def test_direct_load_keeps_nested_columns_on_request(spark, schema):
    frame = spark.sql("SELECT 1 AS id, named_struct('a', 1) AS s")
    load.load_direct(frame, f"{schema}.t", nested="keep")
    assert spark.table(f"{schema}.t").select("s.a").first().a == 1
    with pytest.raises(ValueError, match="nested"):
        load.load_direct(frame, f"{schema}.t", nested="flat")


def test_files_follow_the_partitions(spark, schema):
    """A quarter as many files as partitions if the caller says that it is a scan; with a layout the scan keeps its width instead."""

    def files(name):
        return spark.table(f"{schema}.{name}").select("_metadata.file_path").distinct().count()

    load.load_direct(spark.range(0, 800, 1, 8), f"{schema}.merged", shrink="coalesce")
    assert files("merged") == 2
    load.load_direct(spark.range(0, 800, 1, 8), f"{schema}.sized")
    assert files("sized") == 1
    load.write_table(spark.range(0, 800, 1, 8), f"{schema}.plain")
    assert files("plain") == 8
    load.load_direct(spark.range(0, 800, 1, 8), f"{schema}.sorted", definition=Definition((), ("id",)))
    assert files("sorted") == 1 and spark.table(f"{schema}.sorted").count() == 800


def test_load_through_a_data_source(spark, tmp_path):
    target = str(tmp_path / "out")
    options = {"path": target}
    assert load.load_direct(spark.range(8), "p.s.t", fmt="orc", options=options).rows == 8
    load.load_staged(spark.range(8), "p.s.t", str(tmp_path / "stage"), "append", fmt="orc", options=options)
    assert spark.read.orc(target).count() == 16


def test_loading_nothing(spark, schema, tmp_path):
    empty = spark.createDataFrame([], "id int, k string")
    assert load.load_direct(empty, f"{schema}.a").rows == 0
    assert load.load_staged(empty, f"{schema}.b", str(tmp_path)).rows == 0
    assert load.load_staged(empty, f"{schema}.c", str(tmp_path), definition=Definition(("k",))).rows == 0
    assert [spark.table(f"{schema}.{t}").count() for t in "abc"] == [0, 0, 0]


def test_partitioned_table_prunes_and_expires(spark, schema):
    name = f"{schema}.t"
    frame = spark.range(60).select("id", F.expr("date_add(date'2025-01-01', CAST(id % 6 AS int))").alias("day"))
    frame = frame.unionByName(spark.sql("SELECT 99L AS id, CAST(null AS date) AS day"))
    load.load_direct(frame, name, definition=Definition(("day",), ("id",)), shrink="rebalance")
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 7
    pruned = spark.table(name).filter("day = date'2025-01-02' AND id > 30")
    assert "PartitionFilters: [isnotnull(day" in plan(pruned)
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,30)]" in plan(pruned)
    assert pruned.count() == 5
    assert catalog.expire_partitions(spark, name, "day", "2025-01-03") == 2
    assert spark.table(name).count() == 41
    assert catalog.expire_partitions(spark, name, "day", "2025-01-03") == 0


def test_hot_partition_is_split_over_tasks(spark, schema):
    """One day holds nearly all rows; rebalancing writes it from several tasks instead of one."""
    frame = spark.range(0, 200_000, 1, 8).select(
        F.md5(F.col("id").cast("string").cast("binary")).alias("text"),
        F.when(F.col("id") % 20 > 0, "2025-01-01").otherwise("2025-01-02").cast("date").alias("day"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        load.write_table(frame, f"{schema}.t", definition=Definition(("day",), ("text",)))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = spark.table(f"{schema}.t").groupBy("day").agg(F.count_distinct("_metadata.file_path").alias("n"))
    found = {str(r.day): r.n for r in files.collect()}
    assert found["2025-01-01"] >= 4
    assert found["2025-01-02"] <= 2
    assert spark.table(f"{schema}.t").count() == 200_000


def test_bucketed_tables_join_without_shuffle(spark, schema):
    definition = Definition(cluster_by=("id",), buckets=4)
    for name in "ab":
        load.load_direct(spark.range(1000), f"{schema}.{name}", definition=definition)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table(f"{schema}.a").join(spark.table(f"{schema}.b"), "id")
        assert joined.count() == 1000
        assert "Exchange hashpartitioning" not in plan(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_incremental_by_high_water_mark(spark, schema):
    name = f"{schema}.t"
    source = spark.range(10).select("id", F.expr("timestamp_seconds(id)").alias("at"))
    load.write_table(source.filter("id < 0"), name)
    assert incremental.incremental(source, spark.table(name), "at").count() == 10
    load.write_table(source.filter("id < 4"), name)
    new = incremental.incremental(source, spark.table(name), "at")
    assert rows(new.select("id"), "id") == [(i,) for i in range(4, 10)]


def test_high_water_mark_reaches_the_scan(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "p"))
    new = incremental.incremental(spark.read.parquet(str(tmp_path / "p")), spark.range(5), "id")
    assert "GreaterThan(id,4)" in plan(new)
    assert new.count() == 5


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "decimal(10,2)", "double", "string"])
def test_high_water_mark_of_each_type(spark, tmp_path, kind):
    text = {"date": "concat('2025-01-1', id)", "timestamp": "concat('2025-03-30 01:30:00.00000', id)"}
    text["timestamp_ntz"] = text["timestamp"]
    source = spark.range(5).select(F.expr(f"CAST({text.get(kind, 'id')} AS {kind}) AS at"))
    source.write.parquet(str(tmp_path / "p"))
    loaded = source.sort("at").limit(3)
    new = incremental.incremental(spark.read.parquet(str(tmp_path / "p")), loaded, "at")
    assert rows(new, "at") == rows(source, "at")[3:]
    assert "PushedFilters: [IsNotNull(at), GreaterThan(at," in plan(new)


def test_rows_not_in_keeps_null_keys(spark):
    source = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, None), (None, "c")], "i int, k string")
    target = spark.createDataFrame([("a", 1), (None, 3), ("b", 9)], "k string, i int")
    found = rows(incremental.rows_not_in(source, target, ["i", "k"]), "i", "k")
    assert found == [(None, "c"), (2, "b"), (2, "b"), (3, None)]


def test_stream_owns_its_table(spark, schema, tmp_path):
    folder, name = str(tmp_path / "in"), f"{schema}.s"
    for part in range(2):
        spark.range(part * 10, part * 10 + 10).write.mode("append").parquet(folder)
        append.append_available(append.new_files(spark, folder, spark.range(1).schema), name)
        assert spark.table(name).count() == (part + 1) * 10
    append.append_available(append.new_files(spark, folder, spark.range(1).schema), name)
    assert spark.table(name).count() == 20
    with pytest.raises(ValueError, match="stream"):
        load.write_table(spark.range(1), name, "append")
    load.write_table(spark.range(1), f"{schema}.loaded")
    with pytest.raises(ValueError, match="key"):
        append.append_available(append.new_files(spark, folder, spark.range(1).schema), f"{schema}.loaded")


def test_keyed_stream_can_be_repeated(spark, schema, tmp_path):
    folder, name = str(tmp_path / "in"), f"{schema}.s"
    spark.sql("SELECT id, array(id) AS l FROM range(10)").repartition(3).write.parquet(folder)
    stream = append.new_files(spark, folder, spark.read.parquet(folder).schema, "*.parquet", 1)
    for progress in ("first", "again"):
        append.append_available(stream, name, str(tmp_path / progress), ["id"])
    assert rows(spark.table(name), "id")[:2] == [(0, "[0]"), (1, "[1]")]
    assert spark.table(name).count() == 10

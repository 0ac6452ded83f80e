import pytest
from pyspark.sql import functions as F

from conftest import SF, rows

from tableferry.operators import load, pointer
from tableferry.plans import move
from tableferry.sources import catalog
from tableferry.sources.log_table import read_after, write_log_table
from tableferry.streaming import append


def frame(spark, *pairs):
    return spark.createDataFrame(list(pairs), "id long, day string")


class Killed(BaseException):
    """Stands for a run that ends at this point."""


STEPS = ["create_table", "_insert", "set_pointer", "drop_leftovers"]


def killing(monkeypatch, step, after):
    real = getattr(pointer, step)

    def stop(*args, **kwargs):
        if after:
            real(*args, **kwargs)
        raise Killed(step)

    monkeypatch.setattr(pointer, step, stop)


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("step", STEPS)
def test_killed_overwrite_shows_old_or_new_rows(spark, schema, monkeypatch, step, after):
    target = f"{schema}.t"
    load.write_table(frame(spark, (1, "a")), target, switch=True, marks={"m": "1"})
    load.write_table(frame(spark, (2, "a")), target, marks={"m": "2"})
    with monkeypatch.context() as patched:
        killing(patched, step, after)
        with pytest.raises(Killed):
            load.write_table(frame(spark, (3, "b"), (4, "b")), target, marks={"m": "3"})
    pointer.unlock(spark, target)
    found = {r.id for r in spark.table(target).collect()}
    switched = step == "drop_leftovers" or (step == "set_pointer" and after)
    assert found == ({3, 4} if switched else {2})
    assert catalog.read_pointer(spark, target).marks == {"m": "3" if switched else "2"}
    assert load.write_table(frame(spark, (5, "c")), target) == 1
    assert rows(spark.table(target)) == [(5, "c")]
    tables = [r.tableName for r in spark.sql(f"SHOW TABLES IN {schema} LIKE 't__*'").collect()]
    assert len(tables) == 2, "only the table shown and the one shown before stay"


@pytest.mark.parametrize("partition_by", [(), ("day",)])
@pytest.mark.parametrize("step", ["_insert", "set_pointer"])
def test_killed_append_adds_nothing_twice(spark, schema, monkeypatch, step, partition_by):
    target = f"{schema}.t"
    load.write_table(frame(spark, (1, "a")), target, switch=True, definition=catalog.Definition(partition_by=partition_by, comment="text"))
    with monkeypatch.context() as patched:
        killing(patched, step, after=step == "_insert")
        with pytest.raises(Killed):
            load.write_table(frame(spark, (2, "gone"), (3, None), (4, "x=/y")), target, "append", marks={"m": "7"})
    assert rows(spark.table(target)) == [(1, "a")] and catalog.read_pointer(spark, target).marks == {}
    load.write_table(frame(spark, (2, "b"), (3, None)), target, "append", marks={"m": "7"})
    assert rows(spark.table(target), "id") == [(1, "a"), (2, "b"), (3, None)]
    shown = catalog.read_pointer(spark, target)
    assert (shown.load, shown.marks) == (2, {"m": "7"})
    definition = catalog.table_definition(spark, target)
    assert (definition.partition_by, definition.comment) == (partition_by, "text")
    assert pointer.fold(spark, target) == 3 and catalog.read_pointer(spark, target).load == 1
    assert catalog.read_pointer(spark, target).marks == {"m": "7"} and spark.table(target).count() == 3


def test_rows_are_written_once_and_readers_keep_their_table(spark, schema):
    target = f"{schema}.t"
    load.write_table(frame(spark, (1, "a")), target, switch=True)
    reader = spark.table(target)
    load.write_table(spark.table(target).selectExpr("id + 1 AS id", "day"), target)
    assert rows(reader) == [(1, "a")] and rows(spark.table(target)) == [(2, "a")]


def test_one_load_at_a_time(spark, schema):
    target = f"{schema}.t"
    load.write_table(frame(spark, (1, "a")), target, switch=True)
    with pointer.locked(spark, target):
        with pytest.raises(RuntimeError, match="is being loaded"):
            load.write_table(frame(spark, (2, "a")), target, "append")
        with pointer.locked(spark, target, hours=0):  # a lock of a dead run is taken over
            pass
    assert load.write_table(frame(spark, (2, "a")), target, "append") == 1


def test_tables_become_pointers_on_request_only(spark, schema):
    target = f"{schema}.t"
    load.write_table(frame(spark, (1, "a")), target, definition=catalog.Definition(partition_by=("day",), comment="text", properties={"team": "x"}))
    with pytest.raises(ValueError, match="make_pointer"):
        load.write_table(frame(spark, (2, "a")), target, switch=True)
    with pytest.raises(ValueError, match="only a pointer"):
        load.write_table(frame(spark, (2, "a")), target, "append", marks={"m": "1"})
    pointer.make_pointer(spark, target)
    pointer.make_pointer(spark, target)
    load.write_table(frame(spark, (2, "b")), target, "append")
    assert rows(spark.table(target), "id") == [(1, "a"), (2, "b")]
    definition = catalog.table_definition(spark, target)
    assert definition.partition_by == ("day",) and definition.comment == "text" and definition.properties["team"] == "x"
    catalog.set_property(spark, target, "reviewed", "yes")
    load.write_table(frame(spark, (3, "c")), target, "append")
    assert catalog.table_properties(spark, target)["reviewed"] == "yes"
    catalog.drop_table(spark, target)
    assert not catalog.table_exists(spark, target) and spark.sql(f"SHOW TABLES IN {schema}").count() == 0


def test_making_a_pointer_can_be_resumed(spark, schema, monkeypatch):
    target = f"{schema}.t"
    load.write_table(frame(spark, (1, "a")), target)
    with monkeypatch.context() as patched:
        killing(patched, "set_pointer", after=False)
        with pytest.raises(Killed):
            pointer.make_pointer(spark, target)
    assert load.recover_table(spark, target) and rows(spark.table(target)) == [(1, "a")]
    pointer.make_pointer(spark, target)
    assert rows(spark.table(target)) == [(1, "a")]


def test_expiry_works_behind_a_pointer(spark, schema):
    target = f"{schema}.t"
    days = [(1, "2024-01-01"), (2, "2024-02-01")]
    load.write_table(frame(spark, *days), target, switch=True, definition=catalog.Definition(partition_by=("day",)))
    load.write_table(frame(spark, (3, "2024-01-01"), (4, "2024-02-02")), target, "append")
    assert catalog.expire_partitions(spark, target, "day", "2024-01-15") == 1
    assert [r.id for r in spark.table(target).orderBy("id").collect()] == [2, 4]


def test_filters_reach_the_scan(spark, schema, capsys):
    target = f"{schema}.t"
    load.write_table(frame(spark, (1, "a")), target, switch=True, definition=catalog.Definition(partition_by=("day",)))
    spark.table(target).filter("id > 5 and day = 'a'").explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThan(id,5)" in plan and "(day" in plan.split("PartitionFilters")[1].split("\n")[0] and "__load" in plan.split("PartitionFilters")[1].split("\n")[0]


# ------------------------------------------------------------ progress kept with the target


def orders(spark, low, high):
    return spark.read.parquet(f"{SF}/orders.parquet").filter(f"o_orderkey between {low} and {high}")


def test_append_takes_what_is_newer(spark, schema, tmp_path, monkeypatch):
    path = str(tmp_path / "orders")
    job = move.Job(path, table="orders", schema=schema, mode="append", switch=True)
    write_log_table(orders(spark, 0, 100), path)
    first = move.run_job(spark, job)
    write_log_table(orders(spark, 101, 200), path, "append")
    with monkeypatch.context() as patched:  # dies after the rows are written, before they show
        killing(patched, "set_pointer", after=False)
        with pytest.raises(Killed):
            move.run_job(spark, job)
    second, third = move.run_job(spark, job), move.run_job(spark, job)
    assert [r["status"] for r in (first, second, third)] == ["SUCCESS"] * 3
    assert all(r["verified"] for r in (first, second, third))
    assert [r["source_rows"] for r in (first, second, third)] == [orders(spark, 0, 100).count(), orders(spark, 101, 200).count(), 0]
    assert spark.table(job.target).exceptAll(orders(spark, 0, 200)).isEmpty() and spark.table(job.target).count() == orders(spark, 0, 200).count()
    write_log_table(orders(spark, 201, 300), path, "overwrite")
    refused = move.run_job(spark, job)
    assert refused["status"] == "FAILED" and "removed or changed rows" in refused["error"]
    renewed = move.run_job(spark, move.Job(path, table="orders", schema=schema, mode="overwrite"))
    assert renewed["verified"] and spark.table(job.target).count() == orders(spark, 201, 300).count()
    write_log_table(orders(spark, 301, 310), path, "append")
    assert move.run_job(spark, job)["source_rows"] == orders(spark, 301, 310).count()


def test_marks_belong_to_a_source(spark, schema, tmp_path):
    for name, low in (("a", 0), ("b", 1000)):
        write_log_table(orders(spark, low, low + 50), str(tmp_path / name))
        result = move.run_job(spark, move.Job(str(tmp_path / name), table="orders", schema=schema, mode="append", switch=True))
        assert result["verified"] and result["source_rows"] == orders(spark, low, low + 50).count()
    assert len(catalog.read_pointer(spark, f"{schema}.orders").marks) == 2


def test_rows_after_a_version(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(3):
        write_log_table(orders(spark, 100 * i, 100 * i + 99), path, "append" if i else "overwrite")
    assert rows(read_after(spark, path, 0, 1), "o_orderkey") == rows(orders(spark, 100, 199), "o_orderkey")
    assert rows(read_after(spark, path, 0), "o_orderkey") == rows(orders(spark, 100, 299), "o_orderkey")
    assert read_after(spark, path, 2).count() == 0 and read_after(spark, path, 5).columns == orders(spark, 0, 1).columns


# ------------------------------------------------------------ streams with a ledger


@pytest.mark.parametrize("switch", [False, True])
def test_replayed_batch_reads_nothing(spark, schema, tmp_path, switch):
    target, folder, progress = f"{schema}.orders", str(tmp_path / "in"), str(tmp_path / "progress")
    load.write_table(orders(spark, 0, 50), target, switch=switch)
    for low in (0, 101):
        orders(spark, low, low + 100).write.mode("append").parquet(folder)
        append.append_available(append.new_files(spark, folder, orders(spark, 0, 1).schema), target, progress, ["o_orderkey"])
    want = rows(orders(spark, 0, 201), "o_orderkey")
    assert rows(spark.table(target), "o_orderkey") == want

    class Unread:
        """A batch that may be named but not read."""

        sparkSession = spark

        def __getattr__(self, name):
            raise AssertionError(f"read by {name}")

    assert append.append_batch(Unread(), 1, target, ["o_orderkey"], progress) == 0
    assert append.append_batch(orders(spark, 150, 205), 2, target, ["o_orderkey"], progress) == orders(spark, 202, 205).count()
    assert append.last_batch(spark, target, append._stream_id(spark, progress)) == 2
    if switch:
        assert len(catalog.read_pointer(spark, target).marks) == 1


def test_lookup_of_a_batch_prunes_the_target(spark, schema, capsys):
    target = f"{schema}.orders"
    load.write_table(orders(spark, 0, 300), target)
    append.missing_rows(orders(spark, 250, 400), spark.table(target), ["o_orderkey"]).explain("formatted")
    plan = capsys.readouterr().out
    low, high = orders(spark, 250, 400).selectExpr("min(o_orderkey)", "max(o_orderkey)").first()
    pushed = [line for line in plan.split("\n") if line.startswith("PushedFilters") and f"GreaterThanOrEqual(o_orderkey,{low})" in line]
    assert pushed and f"LessThanOrEqual(o_orderkey,{high})" in pushed[0]


# ------------------------------------------------------------ replacing some partitions


def files(spark, table):
    return {r.path: r.modified for r in spark.table(table).selectExpr("_metadata.file_path AS path", "_metadata.file_modification_time AS modified").distinct().collect()}


def test_other_partitions_keep_their_files(spark, schema):
    target = f"{schema}.t"
    load.write_table(frame(spark, (1, "a"), (2, "b"), (3, None)), target, definition=catalog.Definition(partition_by=("day",)))
    before = files(spark, target)
    assert load.write_table(frame(spark, (20, "b"), (21, "b"), (30, None), (40, "c")), target, "partitions") == 4
    assert rows(spark.table(target), "id") == [(1, "a"), (20, "b"), (21, "b"), (30, None), (40, "c")]
    kept = {p: t for p, t in files(spark, target).items() if "day=a" in p}
    assert kept and kept.items() <= before.items()
    assert load.write_table(frame(spark), target, "partitions") == 0 and spark.table(target).count() == 5
    assert spark.conf.get(load.OVERWRITE_CONF, "static").lower() == "static"


def test_replacing_partitions_is_refused_where_it_cannot_be(spark, schema):
    load.write_table(frame(spark, (1, "a")), f"{schema}.flat")
    load.write_table(frame(spark, (1, "a")), f"{schema}.shown", switch=True)
    for name, reason in (("flat", "no partitions"), ("shown", "is a pointer")):
        with pytest.raises(ValueError, match=reason):
            load.write_table(frame(spark, (2, "a")), f"{schema}.{name}", "partitions")


def test_job_that_replaces_partitions_is_verified(spark, schema, tmp_path):
    path = str(tmp_path / "orders")
    write_log_table(orders(spark, 0, 500), path, partition_by=("o_orderstatus",))
    assert move.run_job(spark, move.Job(path, table="orders", schema=schema))["verified"]
    write_log_table(orders(spark, 0, 500).filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.lit(0.0)), path, "overwrite", ("o_orderstatus",))
    result = move.run_job(spark, move.Job(path, table="orders", schema=schema, mode="partitions"))
    assert result["status"] == "SUCCESS" and result["verified"]
    found = spark.table(f"{schema}.orders").selectExpr("o_orderstatus = 'F'", "o_totalprice = 0").distinct()
    assert {tuple(r) for r in found.collect()} == {(True, True), (False, False)}
    assert spark.table(f"{schema}.orders").count() == orders(spark, 0, 500).count()

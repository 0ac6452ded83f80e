"""Checks, profiles, duplicates and orphans."""

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.operators import quality, verify


def test_counts(spark):
    row = verify.verify_counts(spark.range(5), spark.range(12), before=7).first()
    assert tuple(row) == (5, 12, 0, True)
    row = verify.verify_counts(spark.range(5), spark.range(3)).first()
    assert tuple(row) == (5, 3, 2, False)
    assert verify.verify_counts(spark.range(0), spark.range(0)).first().passed


@pytest.fixture
def wide(spark):
    return spark.sql("""
      SELECT id, IF(id % 3 = 0, null, CAST(id AS string)) AS s, map(id, 'x', -1L, 'y') AS m, array(id) AS l,
             CAST(id AS double) / 7 AS d FROM range(500)""")


def test_checksum_ignores_order_and_width(spark, wide):
    other = wide.withColumn("id", F.col("id").cast("int")).repartition(3).orderBy(F.desc("id"))
    assert verify.verify_checksum(wide, other.select("l", "m", "s", "d", "id")).first().passed


@pytest.mark.parametrize(
    "change",
    [
        lambda df: df.withColumn("d", F.when(F.col("id") == 77, 0.0).otherwise(F.col("d"))),
        lambda df: df.filter("id <> 77"),
        lambda df: df.union(df.filter("id = 77")),
        lambda df: df.withColumn("s", F.when(F.col("id") == 77, F.lit(None)).otherwise(F.col("s"))),
        lambda df: df.filter("id <> 77").union(df.filter("id = 78")),
    ],
)
def test_checksum_sees_one_changed_row(wide, change):
    assert not verify.verify_checksum(wide, change(wide)).first().passed


def test_checksum_sees_a_value_that_moved_to_another_column(spark):
    left = spark.createDataFrame([(None, "a")], "x string, y string")
    right = spark.createDataFrame([("a", None)], "x string, y string")
    assert not verify.verify_checksum(left, right).first().passed


def test_checksum_of_nothing(spark):
    assert verify.verify_checksum(spark.range(0), spark.range(0)).first().passed
    assert not verify.verify_checksum(spark.range(0), spark.range(1)).first().passed


def test_row_differences_count_copies(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, None)], "i int, s string")
    right = spark.createDataFrame([("a", 1), (None, 2), ("z", 3)], "s string, i bigint")
    found = rows(verify.row_differences(left, right), "side", "i")
    assert found == [("source", 2, 1, "a"), ("target", 1, 3, "z")]


def test_sample_comparison(spark, wide):
    assert verify.verify_sample(wide, wide.repartition(5), ["id"], 10).first().passed
    sample = verify.sample_by_key(wide, ["id"], 10).count()
    assert 20 < sample < 90
    changed = wide.withColumn("d", F.lit(0.0))
    result = verify.verify_sample(wide, changed, ["id"], 10).first()
    assert not result.passed and result.only_in_source == result.only_in_target > 0
    narrow = wide.withColumn("id", F.col("id").cast("int"))
    assert verify.sample_by_key(narrow, ["id"], 10).count() == sample


def test_keys(spark):
    frame = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "c"), (None, "d")], "id int, s string")
    assert rows(verify.verify_keys(frame, ["id"], ["id", "s"])) == [
        ("unique(id)", 1, False),
        ("not_null(id)", 2, False),
        ("not_null(s)", 1, False),
    ]
    assert all(r.passed for r in verify.verify_keys(frame.filter("id is null and false"), ["id"]).collect())


def test_schema_diff_counts_lossy_rows(spark):
    frame = spark.createDataFrame([("1", 5, None), ("x", None, "k")], "a string, b int, c string")
    target = T.StructType.fromDDL("a int, c string NOT NULL, e date")
    assert rows(verify.schema_diff(frame, target), "column_name") == [
        ("a", "string", "int", "type differs", 1),
        ("b", "int", None, "only in source", 1),
        ("c", "string", "string", "target requires a value", 1),
        ("e", None, "date", "only in target", 0),
    ]
    assert verify.schema_diff(frame, frame.schema).count() == 0


PEOPLE = [(1, "a@x", True), (1, "a@x", False), (2, None, None), (None, "b@x", True)]


def test_profile_ignores_nulls(spark):
    frame = spark.createDataFrame(PEOPLE, "id int, email string, ok boolean")
    assert tuple(quality.profile(frame, ["id", "email"], ["ok"]).first()) == (4, 2, 2, 2, 1)


def test_duplicates(spark):
    frame = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "id int")
    assert rows(quality.duplicates(frame, ["id"]), "id") == [(None, 2), (1, 2)]
    assert tuple(quality.duplicate_summary(frame, "id").first()) == (5, 2, 1)
    assert tuple(quality.duplicate_summary(frame.filter("false"), "id").first()) == (0, 0, 0)


def test_orphans(spark):
    child = spark.createDataFrame([(1, 10), (2, 10), (3, 11), (4, None)], "id int, parent int")
    parent = spark.createDataFrame([(11,), (11,), (None,)], "key int")
    assert rows(quality.orphans(child, parent, "parent", "key"), "id") == [(1, 10), (2, 10)]
    assert rows(quality.orphan_summary(child, parent, "parent", "key")) == [(10, 2)]


# ------------------------------------------------------------ differences found by digests


def altered(spark, seed, n, changes):
    import random

    draw = random.Random(seed)
    rows = [(i if draw.random() > 0.02 else None, draw.randint(0, 5), [draw.randint(0, 3)]) for i in range(n)]
    rows += draw.sample(rows, 20)
    other = list(rows)
    for _ in range(changes):
        at = draw.randrange(len(other))
        kind = draw.choice(["gone", "changed", "copied"])
        if kind == "gone":
            other.pop(at)
        elif kind == "changed":
            other[at] = (other[at][0], other[at][1] + 1, other[at][2])
        else:
            other.append(other[at])
    kinds = "k long, v int, a array<int>"
    return spark.createDataFrame(rows, kinds), spark.createDataFrame(other, kinds)


@pytest.mark.parametrize("changes", [0, 1, 7, 400])
def test_located_differences_are_all_differences(spark, changes):
    left, right = altered(spark, changes, 1500, changes)
    want = sorted(map(str, verify.row_differences(left, right).collect()))
    assert sorted(map(str, verify.located_differences(left, right, ["k"]).collect())) == want
    assert bool(verify.differing_leaves(left, right, ["k"])) == bool(want)


def test_only_rows_under_differing_leaves_are_compared(spark):
    left, right = altered(spark, 3, 20_000, 5)
    leaves = verify.differing_leaves(left, right, ["k"])
    assert 1 <= len(leaves) <= 5
    rows = verify.under_leaves(left, ["k"], ["a", "k", "v"], leaves)
    assert 0 < rows.count() <= 600  # rows without a key share one leaf
    assert verify.under_leaves(left, ["k"], ["a", "k", "v"], []).count() == 0


def test_nested_schema_differences(spark):
    have = "id int, a struct<city:string, zip:int, gone:string>, items array<struct<n:string, tags:array<int>>>, m map<string,long>, flat string"
    want = "id bigint, a struct<city:string, zip:bigint, more:int>, items array<struct<n:int, tags:array<string>>>, m map<int,int>, flat string, extra int"
    rows = [
        (1, ("x", 1, None), [("1", [1]), ("2", None)], {"1": 5}, "t"),
        (2, ("x", 1, "g"), [("one", [1]), ("2", [])], {"k": 5, "3": 1 << 40}, "t"),
        (3, None, None, None, None),
        (4, (None, None, None), [None, (None, None)], {"2": None}, None),
    ]
    found = {r.path: tuple(r)[1:] for r in verify.schema_diff_nested(spark.createDataFrame(rows, have), T.StructType.fromDDL(want)).collect()}
    assert found == {
        "id": ("int", "bigint", "type differs", 0),
        "a.zip": ("int", "bigint", "type differs", 0),
        "a.gone": ("string", None, "only in source", 1),
        "a.more": (None, "int", "only in target", 0),
        "items[].n": ("string", "int", "type differs", 1),
        "items[].tags[]": ("int", "string", "type differs", 0),
        "m{key}": ("string", "int", "type differs", 1),
        "m{value}": ("bigint", "int", "type differs", 1),
        "extra": (None, "int", "only in target", 0),
    }
    same = spark.createDataFrame(rows, have)
    assert verify.schema_diff_nested(same, same.schema).count() == 0


def test_required_values_inside_nested_columns(spark):
    have = T.StructType.fromDDL("s struct<a:int>, l array<int>, m map<string,int>, deep array<struct<b:int>>")
    want = T.StructType.fromDDL("s struct<a:int not null>, l array<int>, m map<string,int>, deep array<struct<b:int not null>>, must int not null")
    want["l"].dataType.containsNull = want["m"].dataType.valueContainsNull = False
    rows = [((None,), [1, None], {"x": None}, [(1,), (None,)]), (None, None, None, None), ((1,), [], {}, [None])]
    found = {(r.path, r.issue): r.lossy_rows for r in verify.schema_diff_nested(spark.createDataFrame(rows, have), want).collect()}
    needs = "target requires a value"
    assert found == {("s.a", needs): 1, ("l[]", needs): 1, ("m{value}", needs): 1, ("deep[].b", needs): 1, ("must", "only in target"): 3}

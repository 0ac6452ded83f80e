"""Nested values, type mapping, row size and draws on edge cases."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions import draws, mapping, nested, size


@pytest.fixture(scope="module")
def edges(spark):
    return spark.sql("""
      SELECT * FROM VALUES
        (1, named_struct('a', 1, 'b', CAST(null AS string), 't', timestamp'2025-01-01 10:00:00.123456'),
            array('x', null), map(7, 'seven'), double('NaN')),
        (2, CAST(null AS struct<a: int, b: string, t: timestamp>), array(), map(), 0.5D),
        (3, named_struct('a', CAST(null AS int), 'b', 'q"', 't', CAST(null AS timestamp)),
            CAST(null AS array<string>), CAST(null AS map<int, string>), null)
      AS t(id, `s.x`, tags, m, d)""")


def test_nested_to_json_defaults(edges):
    text = nested.nested_to_json(edges)
    assert text.columns == edges.columns
    assert [kind for _, kind in text.dtypes] == ["int", "string", "string", "string", "double"]
    found = [tuple(r)[1:4] for r in text.orderBy("id").collect()]
    assert found == [
        ('{"a":1,"t":"2025-01-01T10:00:00.123Z"}', '["x",null]', '{"7":"seven"}'),
        (None, "[]", "{}"),
        ('{"b":"q\\""}', None, None),
    ]


def test_nested_to_json_keeping_nulls(edges):
    first = nested.nested_to_json(edges, keep_nulls=True).orderBy("id").first()
    assert json.loads(first["s.x"]) == {"a": 1, "b": None, "t": "2025-01-01T10:00:00.123456Z"}


@pytest.mark.parametrize("keep_nulls", [True, False])
def test_json_round_trip(edges, keep_nulls):
    back = nested.json_to_nested(nested.nested_to_json(edges, keep_nulls), edges.schema)
    assert [f.dataType for f in back.schema.fields] == [f.dataType for f in edges.schema.fields]
    wanted, found = ([r.asDict(True) for r in df.orderBy("id").collect()] for df in (edges, back))
    for before, after in zip(wanted, found):
        before.pop("d"), after.pop("d")
        if not keep_nulls and before["s.x"] and before["s.x"]["t"]:
            before["s.x"]["t"] = before["s.x"]["t"].replace(microsecond=123000)
        assert before == after


def test_broken_json_fails_the_job(spark):
    text = spark.createDataFrame([('{"a":',)], "s string")
    with pytest.raises(Exception, match="(?i)malformed"):
        nested.json_to_nested(text, T.StructType.fromDDL("s struct<a: int>")).collect()


def test_json_access(spark):
    text = """{"s": "plain", "n": 1.5, "b": true, "z": null, "o": {"k": 69}, "a": [1, 2], "brace": "{x}", "e": ""}"""
    one = spark.createDataFrame([(text,)], "j string")
    paths = ["s", "n", "b", "z", "o", "a", "brace", "e", "absent"]
    scalars = one.select(*[nested.json_scalar(F.col("j"), f"$.{p}").alias(p) for p in paths]).first()
    assert list(scalars) == ["plain", "1.5", "true", None, None, None, "{x}", "", None]
    fragments = one.select(*[nested.json_fragment(F.col("j"), f"$.{p}").alias(p) for p in paths]).first()
    assert list(fragments) == ['"plain"', "1.5", "true", None, '{"k":69}', "[1,2]", '"{x}"', '""', None]


def test_whole_json_value(spark):
    texts = spark.createDataFrame([('{"k": 69}',), (' "bare" ',), ("[1, 2]",), ("broken",), (None,)], "j string")
    found = [r[0] for r in texts.select(nested.json_fragment(F.col("j"))).collect()]
    assert found == ['{"k":69}', '"bare"', "[1,2]", None, None]


def test_scalar_of_null_is_null(spark):
    assert spark.sql("SELECT CAST(null AS string) AS j").select(nested.json_scalar(F.col("j"), "$.a")).first()[0] is None


BAD = [("2025-02-30", "x"), ("", "2025-01-01"), (None, None), ("2025-01-02", "2025-01-01T01:02:03.000004")]


def test_strict_mapping_raises_and_names_the_column(spark):
    frame = spark.createDataFrame(BAD, "d string, t string")
    with pytest.raises(Exception, match="column d holds"):
        mapping.map_schema(frame, T.StructType.fromDDL("d date, t string")).collect()
    with pytest.raises(Exception, match="column t holds"):
        mapping.map_schema(frame, T.StructType.fromDDL("d string, t timestamp")).collect()


def test_permissive_mapping_sets_rows_aside(spark):
    frame = spark.createDataFrame(BAD, "d string, t string")
    clean, rejected = mapping.split_rejects(
        mapping.map_schema_flagged(frame, T.StructType.fromDDL("d date, t timestamp"))
    )
    assert clean.count() == 2
    assert [r[mapping.REJECTS] for r in rejected.orderBy(F.size(mapping.REJECTS)).collect()] == [["d"], ["d", "t"]]


def test_text_times_use_the_stated_zone(spark):
    frame = spark.createDataFrame(
        [("2025-01-01T10:00:00.123456",), ("2025-01-01 10:00:00+02:00",), ("2025-01-01",), ("2025-01-01T10:00:00Z",)],
        "t string",
    )
    target = T.StructType.fromDDL("t timestamp")
    utc = [str(r[0]) for r in mapping.map_schema(frame, target).select(F.col("t").cast("string")).collect()]
    assert utc == ["2025-01-01 10:00:00.123456", "2025-01-01 08:00:00", "2025-01-01 00:00:00", "2025-01-01 10:00:00"]
    paris = mapping.map_schema(frame, target, zone="Europe/Paris").select(F.col("t").cast("string")).collect()
    assert [r[0] for r in paris] == [
        "2025-01-01 09:00:00.123456",
        "2025-01-01 08:00:00",
        "2024-12-31 23:00:00",
        "2025-01-01 10:00:00",
    ]


def test_mapping_converts_inside_nested_values(spark):
    frame = spark.sql("""
      SELECT named_struct('a', 1, 'b', '7') AS s, array(named_struct('p', 1), null) AS l, map('k', 1) AS m
      UNION ALL SELECT null, null, null""")
    target = T.StructType.fromDDL("s struct<b: bigint, c: string>, l array<struct<p: bigint>>, m map<string, double>")
    found = mapping.map_schema(frame, target)
    assert [f.dataType for f in found.schema.fields] == [f.dataType for f in target.fields]
    first, second = (r.asDict(True) for r in found.orderBy(F.col("s").isNull()).collect())
    assert first == {"s": {"b": 7, "c": None}, "l": [{"p": 1}, None], "m": {"k": 1.0}}
    assert second == {"s": None, "l": None, "m": None}


def test_mapping_sees_values_lost_inside_nested_values(spark):
    frame = spark.sql("SELECT named_struct('b', 'no') AS s, array('1', 'no') AS l, map('k', 'no') AS m")
    target = T.StructType.fromDDL("s struct<b: int>, l array<int>, m map<string, int>")
    flagged = mapping.map_schema_flagged(frame, target).first()
    assert flagged[mapping.REJECTS] == ["s", "l", "m"]


def test_required_columns(spark):
    frame = spark.createDataFrame([(1,), (None,)], "id int")
    target = T.StructType.fromDDL("id bigint NOT NULL")
    with pytest.raises(Exception, match="column id holds"):
        mapping.map_schema(frame, target).collect()
    assert mapping.split_rejects(mapping.map_schema_flagged(frame, target))[1].count() == 1
    with pytest.raises(ValueError, match="lacks: .'other'"):
        mapping.map_schema(frame, T.StructType.fromDDL("id int, other int NOT NULL"))
    with pytest.raises(ValueError, match="not in the target: .'id'"):
        mapping.map_schema(frame, T.StructType.fromDDL("other int"))
    assert mapping.map_schema(frame, T.StructType.fromDDL("id int, other date")).first().other is None


def test_target_schema_and_flat_list():
    source = T.StructType.fromDDL("id int NOT NULL, d string, t string, l array<struct<p: int>>, f float")
    target = mapping.target_schema(source, dates=("d",), times=("t",))
    assert target.simpleString() == "struct<id:bigint,d:date,t:timestamp,l:array<struct<p:bigint>>,f:double>"
    assert not target["id"].nullable
    flat = mapping.flat_schema("id:INTEGER,name:STRING,day:DATE,ok:BOOLEAN,x:FLOAT,at:TIMESTAMP,bare")
    assert flat.simpleString() == "struct<id:bigint,name:string,day:date,ok:boolean,x:double,at:timestamp,bare:string>"


def test_intervals_are_refused(spark):
    frame = spark.sql("SELECT INTERVAL '1' DAY AS i, array(INTERVAL '1' MONTH) AS l, 1 AS x")
    with pytest.raises(TypeError, match="i, l"):
        mapping.reject_intervals(frame.schema)


def test_schema_differences():
    left = T.StructType.fromDDL("a int, b string, c date, d int")
    right = T.StructType.fromDDL("a bigint, b string, d int NOT NULL, e string")
    assert mapping.schema_differences(left, right) == [
        ("a", "int", "bigint", "type differs"),
        ("c", "date", None, "only in source"),
        ("d", "int", "int", "target requires a value"),
        ("e", None, "string", "only in target"),
    ]


def test_row_size_counts_bytes_not_characters(spark):
    values = [(1, "é" * 5, [1, 2]), (2, "e" * 5, None), (None, None, None)]
    frame = spark.createDataFrame(values, "i int, s string, l array<int>")
    sizes = [r[0] for r in frame.select(size.row_bytes(frame.schema)).collect()]
    assert sizes == [4 + 10 + 5, 4 + 5, 0]
    assert rows(size.oversized(frame, 9).select("i", "row_bytes")) == [(1, 19)]
    assert rows(size.oversized(frame, 8).select("i", "row_bytes"), "i") == [(1, 19), (2, 9)]


def test_truncate_and_split(spark):
    frame = spark.createDataFrame([(1, "ééééé", "b"), (2, None, "c")], "i int, s string, t string")
    assert rows(size.truncate_text(frame, 3), "i") == [(1, "ééé", "b"), (2, None, "c")]
    assert rows(size.truncate_text(frame, 0, ["t"]), "i")[0] == (1, "ééééé", "")
    narrow, side = size.split_wide(frame, ["i"], ["s"])
    assert (narrow.columns, side.columns) == (["i", "t"], ["i", "s"])


def test_draws_do_not_depend_on_partitioning(spark):
    key = F.col("id")
    picked = [
        draws.draw_int(key, 3, "n", -5, 5).alias("n"),
        draws.draw_decimal(key, 3, "d", 9.99, 10.01, 2).alias("d"),
        draws.pick(key, 3, "p", ["a", "b"]).alias("p"),
        draws.pick_some(key, 3, "s", ["a", "b", "c"], 2).alias("s"),
    ]
    one = rows(spark.range(0, 3000, 1, 1).select(key, *picked), "id")
    many = rows(spark.range(0, 3000, 1, 7).repartition(5).select(key, *picked), "id")
    assert one == many
    assert {r[1] for r in one} == set(range(-5, 6))
    assert {r[2] for r in one} == {9.99, 10.0, 10.01}
    assert {len(r[4]) for r in one} == {0, 1, 2} and all(len(set(r[4])) == len(r[4]) for r in one)


def test_draws_of_large_and_negative_keys(spark):
    keys = spark.createDataFrame([(-(2**63),), (-1,), (2**31,), (2**62 - 1,), (2**63 - 1,)], "id bigint")
    values = [r[0] for r in keys.select(draws.draw(F.col("id"), 1, "x")).collect()]
    assert all(0 <= v < draws.DRAW_PRIME for v in values) and len(set(values)) >= 4

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from made_docs import docs  # noqa: F401
from tableferry.llm.exact_dedup import KEY_BITS, MOST_DEPTH, Directory, build_index, classes, deduplicate, look_up


def found(spark, frame):
    rows = classes(spark, frame).select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0]))


def test_largest_id_stays_and_null_counts_as_empty(spark, docs):
    frame = docs((1, "a"), (2, "b"), (3, "a"), (4, None), (5, ""), (None, "b"), (6, "A"), (7, "a "))
    sha = {t: hashlib.sha256(t.encode()).hexdigest() for t in ("a", "b", "", "A", "a ")}
    assert found(spark, frame) == [
        (1, 3, 2, False, sha["a"]),
        (2, 2, 2, True, sha["b"]),
        (3, 3, 2, True, sha["a"]),
        (4, 5, 2, False, sha[""]),
        (5, 5, 2, True, sha[""]),
        (6, 6, 1, True, sha["A"]),
        (7, 7, 1, True, sha["a "]),
        (None, 2, 2, False, sha["b"]),
    ]


def test_stage_keeps_one_row_per_text_and_all_columns(spark, docs):
    frame = docs((1, "a"), (1, "a"), (2, "b"), (None, "c"), (None, "c"), (3, "x" * 300_000), (4, "x" * 300_000))
    kept = deduplicate(spark, frame)
    assert kept.columns == frame.columns
    assert sorted((r.text[0], r.doc_id) for r in kept.collect()) == [("a", 1), ("b", 2), ("c", None), ("x", 4)]


def test_empty_table(spark, docs):
    assert classes(spark, docs()).count() == 0
    assert deduplicate(spark, docs()).count() == 0


def many(docs, n=4000):
    draw = random.Random(n)
    return docs(*[(i, f"text {draw.randrange(n // 2)}" if i % 3 else "the hot text") for i in range(n)])


@pytest.mark.parametrize("held", [0, 200_000])
def test_lookups_go_through_slot_and_bucket(spark, docs, held):
    """Small buckets, so that directories are deep: the result is that of a dictionary."""
    frame = many(docs)
    index = build_index(spark, frame, owners=1, capacity=4)
    assert index.slots.agg(F.max("directory_depth")).first()[0] >= 6
    per_owner = index.slots.groupBy("owner", "directory_depth").agg(F.count(F.lit(1)).alias("n"), F.min("slot").alias("low"), F.max("slot").alias("high")).collect()
    assert all(r.n == 1 << r.directory_depth and (r.low, r.high) == (0, r.n - 1) for r in per_owner)
    keyed = frame.select("doc_id", "text", F.xxhash64("text").alias("key"), F.unhex(F.sha2("text", 256)).alias("digest"))
    got = {r.doc_id: (r.keep_id, r.group_size) for r in look_up(spark, keyed, index, held).collect()}
    groups = {}
    for r in frame.select("doc_id", "text").collect():
        groups.setdefault(r.text, []).append(r.doc_id)
    assert got == {i: (max(ids), len(ids)) for ids in groups.values() for i in ids}


def test_a_wrong_directory_finds_nothing(spark, docs):
    frame = many(docs, 600)
    index = build_index(spark, frame, owners=1, capacity=4)
    keyed = frame.select("doc_id", F.xxhash64("text").alias("key"), F.unhex(F.sha2("text", 256)).alias("digest"))
    assert look_up(spark, keyed, index).count() == 600
    index.slots = index.slots.withColumn("bucket", F.col("bucket") + 1)
    assert look_up(spark, keyed, index).count() < 600


@pytest.mark.parametrize("capacity", [1, 2, 5])
def test_directory_splits_and_keeps_every_entry(capacity):
    directory = Directory(capacity)
    keys = [(k * 0x9E3779B97F4A7C15) % (1 << KEY_BITS) for k in range(200)] + [5, 5, 5, 4, 1 << 63]
    for n, key in enumerate(keys):
        directory.insert(key, [n])
    buckets = directory.buckets()
    assert sorted(e[0] for b in buckets for c in b["chains"].values() for e in c) == list(range(len(keys)))
    assert len(directory.slots) == 1 << directory.depth
    for b in buckets:
        assert b["n"] <= capacity or len(b["chains"]) == 1 or b["depth"] == MOST_DEPTH
        assert all(k >> (KEY_BITS - b["depth"]) == b["prefix"] for k in b["chains"] if b["depth"])

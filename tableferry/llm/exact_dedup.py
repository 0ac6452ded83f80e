"""Exact dedup by an extendible-hash index on shared files.

A text's key is the 64-bit hash of its bytes. Map tasks first fold the copies
they meet, so a text that fills a third of the table reaches its owner as one
row per map task. Each owner task holds a range of keys: it reads them in key
order, keeps one chain entry per different text of a key (compared byte by
byte), and fills buckets; a bucket over capacity doubles the directory where
needed and splits by the next key bit. Only entries of 100 bytes or so stay in
memory, never texts. The index lies in the shared folder as two Parquet tables:
the directories (which bucket every slot of an owner points to) and the buckets
with their chains. A document finds its entry as in any such index: its key's
leading bits name the owner, the next ones the slot, the slot the bucket, and in
the bucket's chain of its key the SHA-256 names the entry (different texts of one
key that shared it would stop the build).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.llm.common import saved, ship, slices, whole_text, width

BUCKET_CAPACITY = 512
FOLD_BYTES = 16 << 20
KEY_BITS = 64
MOST_DEPTH = 16
OWNERS_PER_PARTITION = 32

_FOLDED = pa.schema([("key", pa.int64()), ("digest", pa.binary()), ("text", pa.string()), ("keep_id", pa.int64()), ("group_size", pa.int64()), ("keep_rows", pa.int64())])
_FOLDED_DDL = "key long, digest binary, text string, keep_id long, group_size long, keep_rows long"
_INDEX = pa.schema([("owner", pa.int32()), ("bucket", pa.int64()), ("depth", pa.int32()), ("key", pa.int64()), ("digest", pa.binary()), ("keep_id", pa.int64()), ("group_size", pa.int64()), ("keep_rows", pa.int64())])
_SLOTS_DDL = "owner int, directory_depth int, slot long, bucket long, depth int"
#: Slots that every task may hold; more are joined to the documents.
HELD_SLOTS = 200_000
_INDEX_DDL = "owner int, bucket long, depth int, key long, digest binary, keep_id long, group_size long, keep_rows long"


def _merge(entry: list, keep_id: int | None, size: int, keep_rows: int) -> None:
    """Add a group of equal texts to an entry [text, digest, keep_id, size, keep_rows]; null ids are the smallest."""
    mine = entry[2]
    if keep_id == mine:
        entry[4] += keep_rows
    elif mine is None or (keep_id is not None and keep_id > mine):
        entry[2], entry[4] = keep_id, keep_rows
    entry[3] += size


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per different text of this task, or of each FOLD_BYTES of different text."""
    chains: dict[int, list[list]] = {}
    held = 0

    def out() -> pa.RecordBatch:
        rows = [(k, e[1], e[0], e[2], e[3], e[4]) for k, chain in chains.items() for e in chain]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _FOLDED, strict=True)], schema=_FOLDED)

    for batch in slices(batches, "text"):
        for key, digest, text, row_id in zip(*(batch.column(c).to_pylist() for c in ("key", "digest", "text", "id")), strict=True):
            chain = chains.setdefault(key, [])
            for entry in chain:
                if entry[0] == text:
                    _merge(entry, row_id, 1, 1)
                    break
            else:
                chain.append([text, digest, row_id, 1, 1])
                held += len(text) + 200
        if held > FOLD_BYTES:
            yield out()
            chains.clear()
            held = 0
    if chains:
        yield out()


class Directory:
    """An extendible-hash directory over the keys of one owner.

    Slots are addressed by the leading bits of the key below the owner's own
    prefix. ``insert`` adds an entry; a bucket over capacity splits by its next
    bit, doubling the directory when the bucket already uses all its bits.
    Entries of one key stay together, however many they are, and so do entries
    whose keys agree on MOST_DEPTH bits: such a bucket just grows.
    """

    def __init__(self, capacity: int = BUCKET_CAPACITY):
        self.capacity = capacity
        self.depth = 0
        self.slots: list[dict] = [{"depth": 0, "prefix": 0, "chains": {}, "n": 0}]

    def _slot(self, key: int, depth: int) -> int:
        return (key & ((1 << KEY_BITS) - 1)) >> (KEY_BITS - depth) if depth else 0

    def insert(self, key: int, entry: list) -> None:
        bucket = self.slots[self._slot(key, self.depth)]
        bucket["chains"].setdefault(key, []).append(entry)
        bucket["n"] += 1
        while bucket["n"] > self.capacity and len(bucket["chains"]) > 1 and bucket["depth"] < MOST_DEPTH:
            bucket = self._split(bucket, key)

    def _split(self, bucket: dict, key: int) -> dict:
        if bucket["depth"] == self.depth:
            self.slots = [b for b in self.slots for _ in range(2)]
            self.depth += 1
        depth = bucket["depth"] + 1
        halves = [{"depth": depth, "prefix": bucket["prefix"] << 1 | bit, "chains": {}, "n": 0} for bit in (0, 1)]
        for k, chain in bucket["chains"].items():
            half = halves[self._slot(k, depth) & 1]
            half["chains"][k] = chain
            half["n"] += len(chain)
        span = 1 << (self.depth - depth)
        for half in halves:
            at = half["prefix"] * span
            self.slots[at : at + span] = [half] * span
        return halves[self._slot(key, depth) & 1]

    def buckets(self) -> list[dict]:
        return list({id(b): b for b in self.slots}.values())


def _build(owner_bits: int, capacity: int):
    """Owner task: rows come sorted by key; the texts of one key are compared, then only the entry is kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directory, key, chain, owner = Directory(capacity), None, [], None

        def close() -> None:
            if len({e[1] for e in chain}) != len(chain):
                raise ValueError("two different texts share key and SHA-256")
            for entry in chain:
                # the owner's own bits are shifted out, so its directory starts at depth 0
                directory.insert(key << owner_bits, [key, *entry[1:]])

        def pages() -> Iterator[pa.RecordBatch]:
            if owner is None:
                return
            # a directory's slots travel as rows without a key: slot in keep_id, the directory's depth in group_size
            slots = [(owner, b["prefix"], b["depth"], None, None, slot, directory.depth, None) for slot, b in enumerate(directory.slots)]
            entries = [(owner, b["prefix"], b["depth"], *e) for b in directory.buckets() for c in b["chains"].values() for e in c]
            for rows in (slots, entries):
                for a in range(0, len(rows), 50_000):
                    part = rows[a : a + 50_000]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), _INDEX, strict=True)], schema=_INDEX)

        for batch in slices(batches, "text"):
            columns = (batch.column(c).to_pylist() for c in ("owner", "key", "digest", "text", "keep_id", "group_size", "keep_rows"))
            for o, k, digest, text, keep_id, size, keep_rows in zip(*columns, strict=True):
                if k != key:
                    if chain:
                        close()
                    if o != owner:
                        yield from pages()
                        directory = Directory(capacity)
                    key, owner, chain = k, o, []
                for entry in chain:
                    if entry[0] == text:
                        _merge(entry, keep_id, size, keep_rows)
                        break
                else:
                    chain.append([text, digest, keep_id, size, keep_rows])
        if chain:
            close()
        yield from pages()

    return run


@dataclass
class Index:
    """An index on shared files. ``owner_bits`` leading bits of a key name its owner.

    ``slots``: (owner, directory_depth, slot, bucket, depth), one row per slot of
    every owner's directory. ``entries``: (owner, bucket, depth, key, digest,
    keep_id, group_size, keep_rows), one row per different text; ``keep_id`` is
    the largest id of the group (null only if all are), ``keep_rows`` the number
    of rows that have it.
    """

    owner_bits: int
    slots: DataFrame
    entries: DataFrame
    stored: DataFrame


def build_index(
    spark: SparkSession, docs: DataFrame, text: str = "text", row_id: str = "doc_id", owners: int = OWNERS_PER_PARTITION, capacity: int = BUCKET_CAPACITY
) -> Index:
    """Write the index of all texts of ``docs``, with ``owners`` key ranges a partition at least and buckets of ``capacity`` entries."""
    ship(spark)
    bits = (width(spark) * owners - 1).bit_length()
    rows = docs.select(F.col(row_id).cast("long").alias("id"), whole_text(text).alias("text"))
    rows = rows.select("id", "text", F.xxhash64("text").alias("key"), F.unhex(F.sha2("text", 256)).alias("digest"))
    folded = rows.mapInArrow(_fold, _FOLDED_DDL)
    owned = folded.withColumn("owner", F.shiftrightunsigned("key", KEY_BITS - bits).cast("int"))
    owned = owned.repartition(width(spark), "owner").sortWithinPartitions("key")
    stored = saved(spark, owned.mapInArrow(_build(bits, capacity), _INDEX_DDL), "exact-index")
    slots = stored.filter("key is null").selectExpr("owner", "cast(group_size as int) directory_depth", "keep_id slot", "bucket", "depth")
    return Index(bits, slots, stored.filter("key is not null"), stored)


def look_up(spark: SparkSession, keyed: DataFrame, index: Index, held: int = HELD_SLOTS) -> DataFrame:
    """``keyed`` (key, digest, ...) with the entry of every row: owner, slot, bucket, chain.

    Directory depths are a row per owner. The slots go to every task if there
    are at most ``held``, a slot for some hundred texts; else both sides meet by
    owner and slot. Chains are met by owner, bucket and key; a chain's row that a
    third of all documents ask for is split by adaptive execution.
    """
    depths = index.slots.groupBy("owner").agg(F.max("directory_depth").alias("directory_depth"))  # at most 2^owner_bits rows
    below = F.shiftleft("key", index.owner_bits)
    slot = F.when(F.col("directory_depth") == 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftrightunsigned", below, KEY_BITS - F.col("directory_depth")))
    asked = keyed.withColumn("owner", F.shiftrightunsigned("key", KEY_BITS - index.owner_bits).cast("int"))
    asked = asked.join(F.broadcast(depths), "owner").withColumn("slot", slot)
    slots = index.slots.select("owner", "slot", "bucket")
    found = asked.join(F.broadcast(slots) if index.slots.count() <= held else slots, ["owner", "slot"])
    chains = index.entries.select("owner", "bucket", "key", "digest", "keep_id", "group_size", "keep_rows")
    return found.join(chains, ["owner", "bucket", "key", "digest"]).drop("owner", "slot", "directory_depth", "bucket")


def classes(spark: SparkSession, docs: DataFrame, text: str = "text", row_id: str = "doc_id", payload: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: struct ``row`` (the ``payload`` columns, all by default), ``keep_id``,
    ``group_size``, ``keep_rows``, ``kept`` and ``text_sha256``.

    Null texts count as empty. Of equal texts the row with the largest id is
    kept; rows that share text and id are all marked ``kept`` and counted in
    ``keep_rows``. A null id is smaller than any other. An empty table gives no
    rows. Columns of ``docs`` may have any names.
    """
    index = build_index(spark, docs, text, row_id)
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in (payload or docs.columns)]).alias("row"),
        F.col(row_id).cast("long").alias("id"),
        F.xxhash64(whole_text(text)).alias("key"),
        F.unhex(F.sha2(whole_text(text), 256)).alias("digest"),
    )
    found = look_up(spark, keyed, index)
    kept = F.col("id").eqNullSafe(F.col("keep_id")).alias("kept")
    return found.select("row", "keep_id", "group_size", "keep_rows", kept, F.lower(F.hex("digest")).alias("text_sha256"))


def deduplicate(spark: SparkSession, docs: DataFrame, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """``docs`` without the rows that are copies; columns as they were.

    Rows that repeat both text and id are rare, so only they are counted out by
    a grouping; all others are kept by comparing ids.
    """
    found = classes(spark, docs, text, row_id).filter("kept")
    single = found.filter("keep_rows = 1").select("row.*")
    repeated = found.filter("keep_rows > 1").groupBy("text_sha256").agg(F.first("row").alias("row"))
    return single.unionByName(repeated.select("row.*"))

"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Rows and virtual nodes are hashed onto one ring. A row belongs to the shard of
the next virtual node clockwise; where that shard is full, the row goes on
clockwise to the first that is not. With capacities that differ by one at most
and add up to all rows, every shard ends exactly full, so counts differ by one
at most, and only overflowing rows leave their place on the ring.

Only rows per arc (between two virtual nodes) decide, so the walk runs over a
table of arcs of fixed size; rows find their shard and slot by their rank in
the arc.
"""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableferry.llm.common import ship, whole_text

VIRTUAL_NODES = 128
#: Parts of an arc that are ranked on their own.
LANES = 16


def ring(shards: int, virtual: int = VIRTUAL_NODES) -> tuple[np.ndarray, np.ndarray]:
    """Places of all virtual nodes in ring order, and their shards. A shard's nodes do not depend on how many shards there are."""
    nodes = sorted((xxhash.xxh64_intdigest(f"{s}/{v}", seed=7) >> 1, s) for s in range(shards) for v in range(virtual))
    return np.array([n[0] for n in nodes], np.int64), np.array([n[1] for n in nodes], np.int64)


def capacities(rows: int, shards: int, slack: float = 0.0) -> np.ndarray:
    """Rows each shard may hold: even shares, raised by ``slack`` (0: they add up exactly)."""
    even = np.full(shards, rows // shards, np.int64)
    even[: rows % shards] += 1
    return even if slack <= 0 else np.ceil(even * (1 + slack)).astype(np.int64)


def walk(counts: np.ndarray, owners: np.ndarray, room: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """Deal the rows of every arc: (arc, first rank, end rank, shard, first slot).

    First every arc fills its own shard; then arcs in ring order send what is
    left clockwise, past full shards.
    """
    left, room = counts.astype(np.int64).copy(), room.astype(np.int64).copy()
    used = np.zeros(len(room), np.int64)
    done = np.zeros(len(counts), np.int64)
    out: list[tuple[int, int, int, int, int]] = []

    def give(arc: int, shard: int) -> None:
        n = int(min(left[arc], room[shard]))
        if n:
            out.append((arc, int(done[arc]), int(done[arc]) + n, shard, int(used[shard])))
            left[arc] -= n
            done[arc] += n
            room[shard] -= n
            used[shard] += n

    for arc in range(len(counts)):
        give(arc, int(owners[arc]))
    free = [i for i in range(len(owners)) if room[owners[i]] > 0]  # nodes of shards with room, in ring order
    for arc in np.flatnonzero(left).tolist():
        while left[arc]:
            at = bisect.bisect_right(free, arc) % len(free)
            node = free[at]
            if room[owners[node]] == 0:
                free.pop(at)
                continue
            give(arc, int(owners[node]))
    return out


def shard(spark: SparkSession, docs: DataFrame, shards: int, text: str = "text", row_id: str = "doc_id", slack: float = 0.0, virtual: int = VIRTUAL_NODES) -> DataFrame:
    """(``doc_id``, ``size``, ``text_crc32``, ``shard``, ``slot``) per row; size is the text's UTF-8 bytes plus 16.

    A row's place on the ring is the hash of its text, so equal texts share an
    arc and lie on one shard, but for those in arcs that a full shard cuts; a
    group larger than a shard fills several. Rows of an arc are ranked in LANES
    by the hash of id and text, so no task ranks a whole group of copies. Ids may
    repeat or be null; equal rows are interchangeable. Null texts count as
    empty. An empty table gives no rows.
    """
    ship(spark)
    places, owners = ring(shards, virtual)
    body = whole_text(text)
    rows = docs.select(
        F.col(row_id).alias("doc_id"),
        (F.octet_length(body).cast("long") + 16).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(body), 1).alias("place"),
        F.pmod(F.xxhash64(F.col(row_id), body, F.lit("lane")), F.lit(LANES)).cast("int").alias("lane"),
    )

    @F.pandas_udf("int")
    def arc_of(place: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(places, place.to_numpy(np.int64), side="left") % len(places)).astype("int32")

    rows = rows.withColumn("arc", arc_of("place"))
    counts = np.zeros((len(places), LANES), np.int64)
    for arc, lane, n in rows.groupBy("arc", "lane").count().collect():  # at most shards x virtual x LANES rows
        counts[arc, lane] = n
    plan = walk(counts.sum(axis=1), owners, capacities(int(counts.sum()), shards, slack))
    table = spark.createDataFrame(pd.DataFrame(plan or [(0, 0, 0, 0, 0)], columns=["arc", "first", "end", "shard", "slot0"]).astype({"arc": "int32", "shard": "int32"}))
    arc, lane = np.nonzero(counts)
    before = (np.cumsum(counts, axis=1) - counts)[arc, lane]
    lanes = spark.createDataFrame(pd.DataFrame({"arc": np.append(arc, -1).astype("int32"), "lane": np.append(lane, 0).astype("int32"), "before": np.append(before, 0)}))
    # both tables are bounded by the ring, whatever the input: a row per arc, lane or cut
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("arc", "lane").orderBy("place", "doc_id")) - 1)
    ranked = ranked.join(F.broadcast(lanes), ["arc", "lane"]).withColumn("rank", F.col("rank") + F.col("before"))
    dealt = ranked.join(F.broadcast(table), "arc").filter("rank >= first and rank < end")
    return dealt.select("doc_id", "size", "text_crc32", "shard", (F.col("slot0") + F.col("rank") - F.col("first")).cast("long").alias("slot"))

"""Compressed vector codes (product quantization) with codebooks by ball k-means.

A vector is cut into equal parts; each part position has a codebook. The parts
nearest to one entry form its ball. By the triangle inequality only an entry
within twice the ball's radius can be nearer to any of its parts, and for one
part at distance r from its own entry only entries within 2r can (at exactly 2r
a tie is possible, which may go to a lower index). So

- entries are ranked by their distance to the ball's own entry; the radius cuts
  the list to the ball's neighbours,
- parts closer than half of the nearest neighbour's distance (the stable core)
  are left where they are,
- the others fall into rings by the number of neighbours within 2r and are
  compared with just those,
- a part whose own entry and whose candidates did not move keeps its entry.

All distances are whole numbers, so these tests are exact and every round gives
what a search through all entries gives. A round reads the vectors with their
codes, writes them with new codes and adds up each entry's parts in Spark: one
row per entry and task is shuffled, one per entry reaches the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.llm.common import discard, saved, ship, whole_numbers

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Widths of the rings, in ranks of neighbours; a part is compared with all neighbours up to its ring's outer rank.
RINGS = (4, 12, 32, 64, 128, 1 << 30)
BLOCK = 32_768

_EXACT = 1 << 53  # whole numbers below are exact as doubles
_LONG = (1 << 63) - 1


class Codebook:
    """Entries of one part position with their distances to each other, nearest first."""

    def __init__(self, entries: np.ndarray, before: np.ndarray | None = None):
        self.entries = entries  # n x width, whole numbers
        apart = squared(entries, entries)
        np.fill_diagonal(apart, -1)  # an entry comes first in its own list
        self.near = np.argsort(apart, axis=1, kind="stable")[:, 1:]
        self.apart = np.take_along_axis(apart, self.near, axis=1)
        still = np.zeros(len(entries), bool) if before is None else (entries == before).all(axis=1)
        moved = ~still[self.near]
        #: How many of an entry's nearest neighbours stayed in place, from the first on; -1 if the entry itself moved.
        self.settled = np.where(still, np.where(moved.any(axis=1), moved.argmax(axis=1) if moved.shape[1] else 0, moved.shape[1]), -1)

    def assign(self, parts: np.ndarray, codes: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, int]:
        """Nearest entry of every part (ties to the lower index), its squared distance, and how many distances were computed."""
        if codes is None:
            return *nearest(parts, self.entries, np.arange(len(self.entries))), len(parts) * len(self.entries)
        own = parts - self.entries[codes]
        distance = np.einsum("ij,ij->i", own, own)
        codes, work = codes.copy(), len(parts)
        order = np.argsort(codes, kind="stable")
        edges = np.flatnonzero(np.diff(codes[order], prepend=-1))
        for a, b in zip(edges, [*edges[1:], len(order)], strict=True):
            ball = order[a:b]
            entry = int(codes[ball[0]])
            reach = 4 * distance[ball]
            neighbours = int(np.searchsorted(self.apart[entry], reach.max(), side="right"))
            within = np.searchsorted(self.apart[entry, :neighbours], reach, side="right")
            active = within > max(0, int(self.settled[entry]))  # 0 within: the stable core
            ring = np.searchsorted(RINGS, within)
            for r in np.unique(ring[active]):
                rows = ball[active & (ring == r)]
                outer = min(neighbours, RINGS[r])
                found, best = nearest(parts[rows], self.entries, np.concatenate([[entry], self.near[entry, :outer]]))
                codes[rows], distance[rows] = found, best
                work += len(rows) * outer
        return codes, distance, work


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances between all rows of two whole-number arrays."""
    largest = max(int(np.abs(a).max(initial=0)), int(np.abs(b).max(initial=0)))
    if 4 * largest * largest * max(a.shape[1], 1) < _EXACT:
        x, y = a.astype(np.float64), b.astype(np.float64)
        return ((x * x).sum(1)[:, None] - 2 * (x @ y.T) + (y * y).sum(1)).astype(np.int64)
    return (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)


def nearest(parts: np.ndarray, entries: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest of the entries ``among``, ties to the lower index, and the squared distances."""
    among = np.sort(among)
    codes, distance = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
    for a in range(0, len(parts), 4096):
        found = squared(parts[a : a + 4096], entries[among])
        pick = found.argmin(axis=1)
        codes[a : a + 4096] = among[pick]
        distance[a : a + 4096] = found[np.arange(len(pick)), pick]
    return codes, distance


def _assigned(rows: DataFrame, books: list[np.ndarray], before: list[np.ndarray] | None) -> DataFrame:
    """``rows`` (vec_id, label, v, codes) with new ``codes`` and the squared distances ``errors`` of the parts."""
    parts = len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [Codebook(b, None if before is None else old) for b, old in zip(books, before or books, strict=True)]
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                block = batch.slice(start, BLOCK)
                n = block.num_rows
                v = block.column("v").flatten().to_numpy().reshape(n, -1)
                old = block.column("codes")
                old = None if old.null_count else old.flatten().to_numpy().reshape(n, parts)
                width = v.shape[1] // parts
                codes, errors = np.empty((n, parts), np.int32), np.empty((n, parts), np.int64)
                for p, book in enumerate(known):
                    own = np.ascontiguousarray(v[:, p * width : (p + 1) * width])
                    codes[:, p], errors[:, p], _ = book.assign(own, None if old is None else old[:, p].astype(np.int64))
                ends = pa.array(np.arange(0, n * parts + 1, parts, dtype=np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(x.ravel())) for x in (codes, errors)]
                yield pa.RecordBatch.from_arrays([block.column("vec_id"), block.column("label"), block.column("v"), *lists], names=["vec_id", "label", "v", "codes", "errors"])

    fields = rows.schema
    kinds = ", ".join(f"{c} {fields[c].dataType.simpleString()}" for c in ("vec_id", "label", "v"))
    return rows.select("vec_id", "label", "v", "codes").mapInArrow(run, f"{kinds}, codes array<int>, errors array<long>")


def moved(rows: DataFrame, books: list[np.ndarray], kind: str) -> list[np.ndarray]:
    """Codebooks after a round: exact floors of sum by count; unused entries stay. ``kind`` holds the sums."""
    parts, width = len(books), books[0].shape[1]
    one = lambda p: F.struct(F.lit(p).alias("part"), F.col("codes")[p].alias("entry"), *[F.col("v")[p * width + i].alias(f"x{i}") for i in range(width)])
    split = rows.select(F.inline(F.array(*[one(p) for p in range(parts)])))
    sums = split.groupBy("part", "entry").agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col(f"x{i}").cast(kind)).alias(f"s{i}") for i in range(width)])
    after = [b.copy() for b in books]
    for row in sums.collect():  # one row per entry
        after[row["part"]][row["entry"]] = [int(row[f"s{i}"]) // row["n"] for i in range(width)]
    return after


def compress(
    spark: SparkSession,
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    row_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> tuple[DataFrame, list[np.ndarray]]:
    """(``vec_id``, ``label``, ``codes``, ``error``) per kept vector, and the final codebook of each part.

    Null vectors and those with null or non-finite components are dropped.
    Components count as floor(scale * x). Codebooks start as the parts of the
    vectors with the smallest ids (null ids last, equal ids in the order of
    their vectors); fewer vectors than ``entries`` give shorter codebooks. The
    first of those vectors sets the length; vectors of another length, and all
    if it cannot be cut into equal parts, come back with null codes and error.
    Rows may repeat. No usable vectors give no rows. A table whose squared
    distances no long can hold is refused before any round.
    """
    if entries > 1 << 24:
        raise ValueError("a codebook travels to every task; at most 2^24 entries")
    ship(spark)
    usable = vectors.select(F.col(row_id).alias("vec_id"), F.col(label).alias("label"), whole_numbers(F.col(vector), scale).alias("v")).filter("v is not null")
    table = saved(spark, usable, "whole-vectors")
    first = table.orderBy(F.asc_nulls_last("vec_id"), "v").select("v").limit(1).collect()
    length = len(first[0]["v"]) if first else 0
    if not length or length % parts:
        return table.select("vec_id", "label", F.lit(None).cast("array<int>").alias("codes"), F.lit(None).cast("long").alias("error")), []
    fit = table.filter(F.size("v") == length)
    size = fit.agg(F.count(F.lit(1)).alias("n"), F.max(F.array_max("v")).alias("top"), F.min(F.array_min("v")).alias("low")).first()
    largest = max(abs(size["top"]), abs(size["low"]))
    if 16 * largest * largest * length > _LONG:
        raise ValueError(f"components up to {largest} of {length} have squared distances beyond a long")
    kind = "long" if largest * size["n"] <= _LONG else "decimal(38,0)"
    start = np.array([r["v"] for r in fit.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).select("v").collect()], np.int64)
    width = length // parts
    books = [np.ascontiguousarray(start[:, p * width : (p + 1) * width]) for p in range(parts)]
    rows, before = fit.withColumn("codes", F.lit(None).cast("array<int>")), None
    written = []
    for done in range(rounds + 1):
        rows = saved(spark, _assigned(rows, books, before), f"codes-{done}")
        discard(spark, *written)
        written = [rows]
        if done < rounds:
            before, books = books, moved(rows, books, kind)
    coded = rows.select("vec_id", "label", "codes", F.aggregate("errors", F.lit(0).cast("long"), lambda a, x: a + x).alias("error"))
    rest = table.filter(F.size("v") != length).select("vec_id", "label", F.lit(None).cast("array<int>").alias("codes"), F.lit(None).cast("long").alias("error"))
    return coded.unionByName(rest), books


def with_label_error(spark: SparkSession, coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``: the error added up over equal labels, nulls together. Copies of a label are combined before the shuffle."""
    totals = coded.groupBy(F.col("label").alias("of")).agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"))
    return coded.join(saved(spark, totals, "label-errors"), F.col("label").eqNullSafe(F.col("of"))).drop("of")


def code_text(codes: str = "codes"):
    """Codes as text, two lowercase hex digits each (more where an index needs them)."""
    return F.array_join(F.transform(codes, lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")


def books_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.ravel()).encode()).hexdigest()

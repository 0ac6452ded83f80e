"""SimHash fingerprints, bit-sliced comparison of candidate blocks, and near-duplicate groups.

Fingerprints that agree on a band of bits meet. Where the bands make it certain
that close fingerprints agree on one (radius 2 of 64 bits: at least two of four
16-bit blocks stay equal, so all six pairs of blocks serve as bands; a wider
radius r: three of r + 3 blocks), no link is lost. A band value with many members is dealt to blocks, and each pair of
blocks is compared once. In a task, members stand in tiles whose bit planes are
stored vertically: bit j of a plane's word belongs to member j. A plane at a
time, the differing bits are added to carry-save counters of all members at
once; a row of comparisons whose members all exceed the radius is abandoned.

A tile reports the links of a smallest spanning forest, not all pairs.

One text of each group goes on in the pipeline (``one_per_print_group``).

Groups by the similarity of shingle sets (``one_per_group``) are another law.
They need a wider radius than bands can cover for certain, so fingerprints only
come first there: those of 128 bits that meet on any of 48 bands give links, which are checked against the exact
similarity of the shingle sets and contract large groups at little cost. Then a
complete filter follows: texts whose similarity reaches the limit share a
shingle among the rarest of each (prefix filter), in places that leave room for
enough common ones. All such pairs that are not in one group by then are
checked exactly, so no link is lost, whatever the fingerprints found.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.llm.common import Row, discard, saved, ship, slices, tidy, width
from tableferry.llm.components import components

BLOCK = 512
TILE = 256
SEED = 42
_STEPS = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9)


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 (seed 42) of every run of ``words`` words, A-Z lower-cased, joined by one space; fewer words: the whole sequence."""
    joined = b" ".join((text or "").encode().split()).lower()  # bytes: only ASCII white space and A-Z count
    if not joined:
        return np.zeros(0, np.uint64)
    ends = np.append(np.flatnonzero(np.frombuffer(joined, np.uint8) == 32), len(joined))
    last = ends[words - 1 :].tolist() or [len(joined)]
    first = [0, *(ends[: len(last) - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(first, last, strict=True)], np.uint64)


def _lane(hashes: np.ndarray, lane: int) -> np.ndarray:
    """Lane 0 is the hash itself, further lanes are mixed from it."""
    if lane:
        hashes = (hashes + np.uint64(lane) * np.uint64(_STEPS[0])) * np.uint64(_STEPS[1])
        hashes = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(_STEPS[0])
        hashes ^= hashes >> np.uint64(32)
    return hashes


def fingerprint(hashes: np.ndarray, lanes: int = 1) -> bytes:
    """64 bits per lane, big-endian: a bit is set if over half of the hashes set it; no hashes give zero."""
    out = []
    for lane in range(lanes):
        bits = np.unpackbits(_lane(hashes, lane).astype(">u8").view(np.uint8)).reshape(-1, 64)
        out.append(np.packbits(2 * bits.sum(0, dtype=np.int64) > len(hashes)).tobytes())
    return b"".join(out)


def fingerprints(docs: DataFrame, words: int, lanes: int = 1, unique: bool = False, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """(``doc_id``, ``fingerprint``) per row; ``unique`` counts a repeated shingle once. Null texts count as empty."""
    ship(docs.sparkSession)
    source = docs.select(F.col(row_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    schema = T.StructType([source.schema["doc_id"], T.StructField("fingerprint", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out = []
            for t in batch.column("text").to_pylist():
                hashes = shingle_hashes(t, words)
                out.append(fingerprint(np.unique(hashes) if unique else hashes, lanes))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())], names=["doc_id", "fingerprint"])

    return source.mapInArrow(run, schema)


class Tile:
    """Members compared all with all over their first ``bits``: bit planes, carry-save counters, early end."""

    def __init__(self, prints: np.ndarray, radius: int):
        self.n, self.radius = len(prints), radius
        bits = np.unpackbits(prints, axis=1)  # member, bit
        self.bits = bits.shape[1]
        lanes = -(-self.n // 64) * 64
        padded = np.zeros((self.bits, lanes), np.uint8)
        padded[:, : self.n] = bits.T
        self.planes = np.packbits(padded, axis=1, bitorder="little").view("<u8")
        self.rows = np.where(bits.T.astype(bool), np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))  # bit, member
        later = np.arange(lanes)[None, :] > np.arange(self.n)[:, None]
        later[:, self.n :] = False
        self.open = np.packbits(later, axis=1, bitorder="little").view("<u8")

    def close_pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs (i < j) within the radius, and their distances."""
        levels = max(1, self.radius.bit_length())
        row = np.arange(self.n)
        alive = self.open.copy()
        counters = [np.zeros_like(alive) for _ in range(levels)]
        spread = np.random.default_rng(0).permutation(self.bits)
        for step, b in enumerate(spread):
            carry = self.planes[b][None, :] ^ self.rows[b][row][:, None]
            for c in counters:  # add one bit to every member's counter
                c ^= carry
                carry &= ~c
            alive &= ~carry  # the counter ran over: beyond the radius for good
            if step % 8 == 7 and step + 1 < self.bits:
                alive &= self._within(counters)
                keep = alive.any(axis=1)
                if not keep.all():
                    row, alive = row[keep], alive[keep]
                    counters = [c[keep] for c in counters]
                    if not len(row):
                        break
        alive &= self._within(counters)
        at, lane = np.nonzero(np.unpackbits(alive.view(np.uint8), axis=1, bitorder="little"))
        distance = np.zeros(len(at), np.int64)
        for level, c in enumerate(counters):
            distance += ((c[at, lane >> 6] >> (lane & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64) << level
        return row[at], lane, distance

    def _within(self, counters: list[np.ndarray]) -> np.ndarray:
        """Members whose counter is at most the radius."""
        less = np.zeros_like(counters[0])
        equal = ~less
        for level in reversed(range(len(counters))):
            if self.radius >> level & 1:
                less |= equal & ~counters[level]
                equal &= counters[level]
            else:
                equal &= ~counters[level]
        return less | equal


def forest(n: int, a: np.ndarray, b: np.ndarray, distance: np.ndarray) -> list[int]:
    """Numbers of the pairs that make up a smallest spanning forest."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    chosen = []
    for d in np.unique(distance):
        some = np.flatnonzero(distance == d)
        while len(some):
            for i in some[:4096].tolist():
                x, y = find(int(a[i])), find(int(b[i]))
                if x != y:
                    root[x] = y
                    chosen.append(i)
            some = some[4096:]
            if len(some):  # most pairs of a large group are settled by the first ones
                top = np.array([find(x) for x in range(n)])
                some = some[top[a[some]] != top[b[some]]]
    return chosen


def _compare(radius: int, first_radius: int | None):
    """Rows sorted by band value; whole groups fill tiles, so pairs of different groups are compared too, which is harmless.

    With ``first_radius``, tiles compare the first 64 bits at that radius and
    only pairs that pass are counted in full, over 128 bits; what a fingerprint
    holds beyond these only tells it from others.
    """

    def links(keys: list[bytes]) -> pa.RecordBatch:
        prints = sorted(set(keys))
        rows = np.frombuffer(b"".join(prints), np.uint8).reshape(len(prints), -1)
        if first_radius is None:
            a, b, distance = Tile(rows, radius).close_pairs()
        else:
            a, b, _ = Tile(rows[:, :8], first_radius).close_pairs()
            distance = np.bitwise_count(rows[a, :16] ^ rows[b, :16]).sum(axis=1, dtype=np.int64)
            near = distance <= radius
            a, b, distance = a[near], b[near], distance[near]
        chosen = forest(len(prints), a, b, distance)
        return pa.RecordBatch.from_arrays([pa.array([prints[x[i]] for i in chosen], pa.binary()) for x in (a, b)] + [pa.array([int(distance[i]) for i in chosen], pa.int32())], names=["a", "b", "distance"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile: list[bytes] = []
        group: list[bytes] = []
        key = None
        for batch in batches:
            for *k, fp in zip(*(batch.column(c).to_pylist() for c in ("band", "value", "low", "high", "fingerprint")), strict=True):
                if k != key:
                    if len(tile) + len(group) > TILE and tile:
                        yield links(tile)
                        tile = []
                    tile += group
                    group, key = [], k
                group.append(fp)
        for part in (tile + group,) if len(tile) + len(group) <= TILE else (tile, group):
            if part:
                yield links(part)

    return run


def close_links(spark: SparkSession, prints: DataFrame, bands: list[list[int]], radius: int, first_radius: int | None = None, block: int = BLOCK) -> DataFrame:
    """Links (``a``, ``b``) among different fingerprints within the radius that agree on a band.

    ``prints`` has ``fingerprint`` and ``keys``; ``bands`` lists byte numbers of
    ``keys``. Band values of one member are dropped after a count that is
    combined before its shuffle; values with over ``block`` members are dealt to
    blocks, every pair of which meets in one tile. Spark takes the exploded rows
    for one per fingerprint, so the join may not choose to broadcast them.
    """
    band = F.explode(F.array(*[F.struct(F.lit(i).alias("band"), F.concat(*[F.substring("keys", b + 1, 1) for b in own]).alias("value")) for i, own in enumerate(bands)])).alias("b")
    rows = prints.select("fingerprint", band).select("b.*", "fingerprint")
    counts = rows.groupBy("band", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("int")
    met = rows.hint("merge").join(counts, ["band", "value"]).withColumn("blocks", blocks).withColumn("mine", F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = met.select("band", "value", "fingerprint", "mine", others)
    dealt = dealt.select("band", "value", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "fingerprint")
    dealt = dealt.repartition(width(spark), "band", "value", "low", "high").sortWithinPartitions("band", "value", "low", "high")
    return dealt.mapInArrow(_compare(radius, first_radius), "a binary, b binary, distance int").select("a", "b").distinct()


def block_bands(blocks: int, agree: int) -> list[list[int]]:
    """Any ``agree`` of ``blocks`` blocks of two bytes each, as byte numbers."""
    return [[byte for i in own for byte in (2 * i, 2 * i + 1)] for own in combinations(range(blocks), agree)]


#: Any two of the four 16-bit blocks of a 64-bit fingerprint.
PAIR_BANDS = block_bands(4, 2)
#: Beyond it, three blocks would have fewer than 21 bits.
MOST_RADIUS = 6


def block_keys(prints: list[bytes], blocks: int) -> list[bytes]:
    """64-bit fingerprints cut into ``blocks`` (4 or more) nearly equal runs of bits, each written as two bytes."""
    whole = np.frombuffer(b"".join(prints), ">u8").astype(np.uint64)
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    parts = [(whole >> np.uint64(64 - b)) & np.uint64((1 << (b - a)) - 1) for a, b in pairwise(cuts)]
    return [row.tobytes() for row in np.stack(parts, axis=1).astype(">u2")]


def links_within(spark: SparkSession, prints: DataFrame, radius: int) -> DataFrame:
    """Links (``a``, ``b``) that hold groups of different 64-bit fingerprints within ``radius`` <= 6 together.

    Of radius + 3 blocks of bits at most ``radius`` differ, so fingerprints
    that close agree on three blocks, and none is missed; up to radius 2 two of
    four blocks do. Three blocks of eight have 24 bits: few others meet there.
    """
    if not 0 <= radius <= MOST_RADIUS:
        raise ValueError(f"the bands are complete and selective up to {MOST_RADIUS} differing bits")
    if radius <= 2:
        return close_links(spark, prints.withColumn("keys", F.col("fingerprint")), PAIR_BANDS, radius)
    blocks = radius + 3

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                column = batch.column("fingerprint")
                yield pa.RecordBatch.from_arrays([column, pa.array(block_keys(column.to_pylist(), blocks), pa.binary())], names=["fingerprint", "keys"])

    keyed = prints.select("fingerprint").mapInArrow(keys, "fingerprint binary, keys binary")
    return close_links(spark, keyed, block_bands(blocks, 3), radius)


def near_groups(spark: SparkSession, docs: DataFrame, words: int = 3, radius: int = 2, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """(``doc_id``, ``fingerprint``, ``component_id``) per row; 64-bit fingerprints link at ``radius`` <= 6 differing bits.

    ``component_id`` is the smallest id reachable. Texts without words have
    fingerprint zero. Null ids are kept but never name a group that has another
    id; rows that repeat an id are rows of their own. An empty table gives no rows.
    """
    marked = saved(spark, fingerprints(docs, words, 1, text=text, row_id=row_id), "fingerprints")
    prints = marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    found = components(spark, links_within(spark, prints, radius))
    roots = prints.join(found.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    roots = saved(spark, roots, "roots")
    smallest = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    named = roots.join(smallest, "root").select("fingerprint", "component_id")
    return marked.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def one_per_print_group(spark: SparkSession, docs: DataFrame, words: int = 3, radius: int = 5, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each group that ``near_groups`` finds; columns as they were.

    The row with the smallest id stays (null ids are larger than others); of
    rows that share fingerprint and id, the one with the smallest text. Texts
    without words form one group. An empty table gives no rows; columns may
    have any names.
    """
    ship(spark)
    own = Row(docs, None, text)
    source = docs.select(own.packed().alias("row"), F.coalesce(F.col(row_id).cast("long"), F.lit((1 << 63) - 1)).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    schema = T.StructType([*source.schema, T.StructField("fingerprint", T.BinaryType())])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out = [fingerprint(shingle_hashes(t, words)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=schema.fieldNames())

    marked = saved(spark, source.mapInArrow(mark, schema), "marked")
    kept: list[DataFrame] = []
    with tidy(spark, kept):
        prints = saved(spark, marked.groupBy("fingerprint").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")), "prints")
        found = components(spark, links_within(spark, prints, radius))
        roots = prints.join(found.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
        first = roots.groupBy("root").agg(F.min(F.struct("least", "fingerprint")).alias("first"), F.sum("n").alias("rows"))
        first = saved(spark, first.select("first.fingerprint", F.col("first.least").alias("id"), "rows"), "first")
        kept.append(first)
    whole = marked.join(first, ["fingerprint", "id"]).select("rows", "fingerprint", "text", own.unpacked().alias("row"))
    single = whole.filter("rows = 1").select("row.*")
    several = whole.filter("rows > 1").groupBy("fingerprint").agg(F.min_by("row", "text").alias("row"))
    return single.unionByName(several.select("row.*"))


#: For similar texts: 48 bands of 16 bits drawn from 128, the same for ever.
_DRAWN = np.concatenate([np.random.default_rng(128 + i).permutation(128) for i in range(6)])
DRAWN_BANDS = [[2 * i, 2 * i + 1] for i in range(48)]
SIMILAR_RADIUS = 34
SIMILAR_FIRST_RADIUS = 20


def _drawn_keys(print_: bytes) -> bytes:
    return np.packbits(np.unpackbits(np.frombuffer(print_[:16], np.uint8))[_DRAWN]).tobytes()


def _similar(least: float, words: int):
    """Links whose texts' shingle sets have at least this Jaccard similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text_a", 1 << 20):
            keep = []
            for a, b in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist(), strict=True):
                x, y = (np.unique(shingle_hashes(t, words)) for t in (a, b))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= least * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


#: Slots of the table that tells frequent shingles apart; it only orders shingles, so shared slots lose nothing.
_SLOTS = 1 << 22
_WINDOW = 4_000_000


def _frequencies(texts: DataFrame, words: int) -> np.ndarray:
    """A level (twice the binary logarithm) per slot: how many texts hold a shingle, where that is seen twice in a window.

    Shingles seen once in every window stay at level 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(window), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(found[n > 1].view(np.int64)), pa.array(n[n > 1].astype(np.int64))], names=["token", "n"])

        window, size = [], 0
        for batch in slices(batches, "text"):
            for t in batch.column("text").to_pylist():
                window.append(np.unique(shingle_hashes(t, words)))
                size += len(window[-1])
            if size >= _WINDOW:
                yield counted()
                window, size = [], 0
        if window:
            yield counted()

    sums = texts.select("text").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    top = sums.groupBy(F.col("token").bitwiseAND(_SLOTS - 1).cast("int").alias("slot")).agg(F.max("n").alias("n")).toArrow()
    levels = np.zeros(_SLOTS, np.uint8)
    levels[top.column("slot").to_numpy()] = 2 * np.log2(np.maximum(top.column("n").to_numpy(), 1))
    return levels


def _prefix_rows(levels, least: float, words: int):
    """The rarest shingles of a text, as many as make sure that similar texts share one, rare ones first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sizes, tokens = [], []
            for t in batch.column("text").to_pylist():
                found = np.unique(shingle_hashes(t, words))
                n = len(found)
                ordered = found[np.argsort(levels.value[found & np.uint64(_SLOTS - 1)], kind="stable")]  # ties by hash: one order for all texts
                sizes.append(n)
                tokens.append(ordered[: n - int(np.ceil(least * n - 1e-9)) + 1 if n else 0].view(np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, tokens)]), pa.int32()), pa.array(np.concatenate(tokens)))
            yield pa.RecordBatch.from_arrays([batch.column("fingerprint"), batch.column("id"), pa.array(sizes, pa.int32()), lists], names=["fingerprint", "id", "size", "tokens"])

    return run


def _pairs_of_groups(least: float):
    """Pairs of members of a group (token, low, high; sorted) that are not joined yet and may reach the similarity.

    If the group's shingle is the first that two texts share, they have no more
    in common than the shorter of what follows it; so a similar pair passes at
    its first common shingle.
    """

    def pairs(table: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        start = np.ones(len(table["token"]), bool)
        start[1:] = (table["token"][1:] != table["token"][:-1]) | (table["low"][1:] != table["low"][:-1]) | (table["high"][1:] != table["high"][:-1])
        group = np.cumsum(start)
        size, rest = table["size"].astype(np.float64), (table["size"] - table["place"]).astype(np.float64)
        i, step, out, held = np.arange(len(group)), 1, [], 0
        while True:
            i = i[i + step < len(group)]
            i = i[group[i] == group[i + step]]
            if not len(i):
                break
            j = i + step
            open_ = table["root"][i] != table["root"][j]
            open_ &= (table["low"][i] == table["high"][i]) | (table["mine"][i] != table["mine"][j])  # tiles of two blocks: only pairs across
            open_ &= np.minimum(rest[i], rest[j]) * (1 + least) >= least * (size[i] + size[j]) - 1e-6
            x, y = table["node"][i[open_]], table["node"][j[open_]]
            out.append(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1))
            held += len(x)
            if held > 1 << 20:
                yield told(out)
                out, held = [], 0
            step += 1
        if held:
            yield told(out)

    def told(out: list[np.ndarray]) -> pa.RecordBatch:
        found = np.unique(np.concatenate(out), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(found[:, k])) for k in (0, 1)], names=["x", "y"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left: dict[str, np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = {name: batch.column(name).to_numpy() for name in batch.schema.names}
            if left is not None:
                table = {name: np.concatenate([left[name], column]) for name, column in table.items()}
            key = np.stack([table["token"], table["low"], table["high"]])
            last = np.flatnonzero((key != key[:, -1:]).any(axis=0))
            cut = int(last[-1]) + 1 if len(last) else 0  # the last group may go on in the next batch
            yield from pairs({name: column[:cut] for name, column in table.items()})
            left = {name: column[cut:] for name, column in table.items()}
        if left is not None:
            yield from pairs(left)

    return run


def open_pairs(spark: SparkSession, texts: DataFrame, roots: DataFrame, least: float, words: int, block: int = BLOCK) -> DataFrame:
    """Pairs (``x``, ``y``) of nodes in different groups that may reach the similarity ``least``; complete.

    ``texts`` has ``fingerprint``, ``id`` and ``text``; ``roots`` names the row
    of each fingerprint that counts (``least``) and its group (``root``). Nodes
    are 64-bit hashes of fingerprints. Shingles that stand in one group only are
    dropped after a count; those of more than ``block`` texts are dealt to
    blocks, every pair of which meets in one task.
    """
    levels = spark.sparkContext.broadcast(_frequencies(texts, words))
    found = texts.mapInArrow(_prefix_rows(levels, least, words), T.StructType([texts.schema["fingerprint"], texts.schema["id"], *T._parse_datatype_string("size int, tokens array<long>")]))
    named = roots.select("fingerprint", F.col("least").alias("id"), F.xxhash64("root").alias("root"))
    found = found.join(named, ["fingerprint", "id"]).select(F.xxhash64("fingerprint").alias("node"), "root", "size", "tokens")
    found = saved(spark, found, "prefixes")
    rows = found.select("node", "root", "size", F.posexplode("tokens").alias("place", "token"))
    counts = rows.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("r"), F.max("root").alias("s")).filter("r <> s")
    counts = saved(spark, counts.select("token", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "shared-shingles")
    met = rows.join(counts, "token").withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = met.select("token", "node", "root", "size", "place", "mine", others)
    dealt = dealt.select("token", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "mine", "node", "root", "size", "place")
    dealt = dealt.repartition(width(spark), "token", "low", "high").sortWithinPartitions("token", "low", "high")
    return dealt.mapInArrow(_pairs_of_groups(least), "x long, y long").distinct()


def one_per_group(spark: SparkSession, docs: DataFrame, words: int = 5, similarity: float = 0.8, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each group of similar texts; columns as they were.

    Texts are linked if their sets of ``words``-word shingles have a Jaccard
    similarity of at least ``similarity``; groups follow links. The row with the
    smallest id stays (null ids are larger than others); rows that repeat text
    and id count as one. Texts without words form one group. Texts are one
    node if their shingle sets have the same 128-bit digest, which stands behind
    the 128 bits of the fingerprint. An empty table gives no rows; columns may
    have any names.
    """
    ship(spark)
    own = Row(docs, None, text)
    source = docs.select(own.packed().alias("row"), F.coalesce(F.col(row_id).cast("long"), F.lit((1 << 63) - 1)).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    schema = T.StructType([*source.schema, T.StructField("fingerprint", T.BinaryType())])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = [np.unique(shingle_hashes(t, words)) for t in batch.column("text").to_pylist()]
            out = [fingerprint(x, 2) + xxhash.xxh3_128_digest(x.tobytes()) for x in sets]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=schema.fieldNames())

    marked = saved(spark, source.mapInArrow(mark, schema), "marked")
    prints = saved(spark, marked.groupBy("fingerprint").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")), "prints")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("fingerprint"), pa.array([_drawn_keys(p) for p in batch.column("fingerprint").to_pylist()], pa.binary())], names=["fingerprint", "keys"])

    keyed = prints.select("fingerprint").mapInArrow(keys, "fingerprint binary, keys binary")
    kept: list[DataFrame] = []
    with tidy(spark, kept):
        links = saved(spark, close_links(spark, keyed, DRAWN_BANDS, SIMILAR_RADIUS, SIMILAR_FIRST_RADIUS), "candidates")
        ends = links.select(F.explode(F.array("a", "b")).alias("fingerprint")).distinct()
        texts = marked.select("fingerprint", "id", "text").join(ends, "fingerprint").join(prints.select("fingerprint", F.col("least").alias("id")), ["fingerprint", "id"])
        texts = saved(spark, texts.groupBy("fingerprint").agg(F.min("text").alias("text")), "candidate-texts")
        paired = links.join(texts.select(F.col("fingerprint").alias("a"), F.col("text").alias("text_a")), "a").join(texts.select(F.col("fingerprint").alias("b"), F.col("text").alias("text_b")), "b")
        joined = components(spark, paired.select("a", "b", "text_a", "text_b").mapInArrow(_similar(similarity, words), "a binary, b binary"))
        joined = saved(spark, joined, "joined")
        groups = saved(spark, prints.join(joined.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint")), "groups")
        kept += [joined, groups]
    with tidy(spark, kept := []):
        pairs = saved(spark, open_pairs(spark, marked.select("fingerprint", "id", "text"), groups, similarity, words), "open-pairs")
        kept.append(pairs)
    with tidy(spark, kept := []):
        named = groups.select("fingerprint", F.col("least").alias("id"), F.xxhash64("fingerprint").alias("node"))
        ends = named.join(pairs.select(F.explode(F.array("x", "y")).alias("node")).distinct(), "node")
        texts = marked.select("fingerprint", "id", "text").join(ends, ["fingerprint", "id"])
        texts = saved(spark, texts.groupBy("node", "fingerprint").agg(F.min("text").alias("text")), "open-texts")
        first, second = (texts.select(F.col("node").alias(n), F.col("fingerprint").alias(f), F.col("text").alias(f"text_{f}")) for n, f in (("x", "a"), ("y", "b")))
        paired = pairs.join(first, "x").join(second, "y")
        similar = paired.select("a", "b", "text_a", "text_b").mapInArrow(_similar(similarity, words), "a binary, b binary")
        found = components(spark, joined.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(similar))
        found = saved(spark, found, "joined")
        kept.append(found)
    discard(spark, joined, groups, pairs)
    roots = prints.join(found.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    kept = roots.groupBy("root").agg(F.min(F.struct("least", "fingerprint")).alias("first"), F.sum("n").alias("rows"))
    kept = kept.select("first.fingerprint", F.col("first.least").alias("id"), "rows")
    rows = marked.join(kept, ["fingerprint", "id"])
    whole = rows.select("rows", "fingerprint", own.unpacked().alias("row"))
    single = whole.filter("rows = 1").select("row.*")
    several = whole.filter("rows > 1").groupBy("fingerprint").agg(F.first("row").alias("row"))
    return single.unionByName(several.select("row.*"))

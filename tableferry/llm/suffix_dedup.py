"""Removal of byte strings that occur more than once, by suffix arrays over candidate regions.

1. Every possible start of a repeated string (``length`` bytes) belongs to the
   smallest-hash k-gram inside it. Equal strings hold that k-gram at the same
   place, and so agree on the k-gram with half a string's bytes on its longer
   side: the *anchor*. Runs of starts with one anchor (a *region*: the run's
   bytes) can only match regions of the same anchor. Spark counts runs per
   anchor; those of anchors that stand once end here.
2. Regions that occur several times as a whole repeat altogether; one of them
   stands for all, so copies and common passages meet no task as a group.
3. Different regions of one anchor meet in a shard. Its suffix array comes from
   Larsson-Sadakane refinement, its common prefixes from Kasai's scan, both in
   numpy; neighbours that share ``length`` bytes repeat.
4. An anchor with many regions is dealt to several shards. Each lists its
   different strings as sorted digests, cut into ranges; per range the shards'
   lists are merged by binary search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.llm.common import Row, discard, drop_shuffles, saved, ship, slices, tidy, whole_text, width

LENGTH = 400
GRAM = 16
PLACE_BITS = 24
SEGMENT = 8 << 20
SHARD_REGIONS = 1000
SHARD_BYTES = 1 << 20
NO_ID = -(1 << 63)

_RUNS = "id long, tag long, gram long, region long, first int, n int"
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93))


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on as one number, zeros beyond the end."""
    n = len(data)
    padded = np.zeros(n + 16, np.uint8)
    padded[:n] = data
    out = np.empty(n, np.uint64)
    for o in range(min(8, n)):
        part = np.frombuffer(padded, "<u8", (n - o + 7) // 8, o)
        out[o::8] = part
    return out


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from every position on."""
    words = words_at(data)
    n = len(data) - GRAM + 1
    h = words[:n] * _MIX[0]
    h ^= h >> np.uint64(29)
    h += words[8 : 8 + n] * _MIX[1]
    h ^= h >> np.uint64(32)
    h *= _MIX[2]
    h ^= h >> np.uint64(29)
    return h


def start_runs(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of starts that share their anchor: first start, number of starts, place of the anchor.

    ``bounds`` are the documents' ends inside ``data``; strings do not cross
    them. The order of k-grams is by hash and then place, the same for equal
    strings wherever they stand.
    """
    hashes = _gram_hashes(data)
    low = np.uint64((1 << PLACE_BITS) - 1)
    least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    window, span = length - GRAM + 1, 1
    while span * 2 <= window:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if window > span:
        least = np.minimum(least[: span - window], least[window - span :])
    begins = np.concatenate([[0], bounds[:-1]])
    fits = np.maximum(bounds - begins - length + 1, 0)
    long = fits > 0
    starts = np.repeat(begins[long] - (np.cumsum(fits[long]) - fits[long]), fits[long]) + np.arange(fits.sum())
    if not len(starts):
        return (np.zeros(0, np.int64),) * 3
    place = (least[starts] & low).astype(np.int64)
    half = (length - GRAM + 1) // 2
    anchor = np.where(place - starts >= half, place - half, place)  # half a string before the k-gram, or after it
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    return starts[new], np.diff(np.append(new, len(starts))), anchor[new]


def _scan(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SEGMENT // 2):
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            ids, tags = batch.column("id").to_numpy(), batch.column("tag").to_numpy()
            for data, bounds, row, shift in _segments(texts, length):
                first, n, anchor = start_runs(np.frombuffer(data, np.uint8), bounds, length)
                if not len(first):
                    continue
                doc = np.searchsorted(bounds, first, side="right")
                digest, reach = xxhash.xxh3_64_intdigest, GRAM + (length - GRAM + 1) // 2
                region = np.array([digest(data[a : a + m + length - 1]) for a, m in zip(first.tolist(), n.tolist(), strict=True)], np.uint64)
                gram = np.array([digest(data[a : a + reach]) for a in anchor.tolist()], np.uint64)
                begins = np.concatenate([[0], bounds[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (ids[row[doc]], tags[row[doc]], gram.view(np.int64), region.view(np.int64), (first - begins[doc] + shift).astype(np.int32), n.astype(np.int32))],
                    names=["id", "tag", "gram", "region", "first", "n"],
                )

    return run


def _segments(texts: list[bytes], length: int) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, int]]:
    """Texts joined, with their ends and row numbers; a very long text alone, in parts that overlap by a string's length."""
    usual = [i for i, t in enumerate(texts) if length <= len(t) <= SEGMENT]
    if usual:
        yield b"".join(texts[i] for i in usual), np.cumsum([len(texts[i]) for i in usual]), np.array(usual), 0
    for i, t in enumerate(texts):
        if len(t) > SEGMENT:
            for a in range(0, len(t) - length + 1, SEGMENT):
                part = t[a : a + SEGMENT + length - 1]
                yield part, np.array([len(part)]), np.array([i]), a


def suffix_array(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array and ranks of regions joined, each followed by a mark of its own, and the marks' places by position.

    ``data`` holds byte + 1, and 0 at ``ends`` (the marks). Larsson-Sadakane:
    suffixes are grouped by their first symbols, and each round sorts the
    members of open groups by the group of the suffix as far ahead as is sorted.
    """
    size = len(data)
    mark = np.repeat(ends, np.diff(ends, prepend=-1))
    key, ahead = np.zeros(size, np.int64), 6
    for o in range(ahead):
        at = np.arange(size) + o
        key = key << 9 | np.where(at < mark, data[np.minimum(at, size - 1)], 0)
    key[ends] = np.arange(len(ends)) - len(ends)  # marks differ and come first
    sa = np.argsort(key, kind="stable")
    ordered = key[sa]
    head = np.maximum.accumulate(np.where(np.concatenate([[True], ordered[1:] != ordered[:-1]]), np.arange(size), 0))
    rank = np.empty(size, np.int64)
    rank[sa] = head
    while True:
        count = np.bincount(rank, minlength=size)
        open_ = sa[count[rank[sa]] > 1]
        if not len(open_):
            return sa, rank, mark
        group = rank[open_]
        key = group * size + rank[np.minimum(open_ + ahead, mark[open_])]
        order = np.argsort(key, kind="stable")
        open_, key, group = open_[order], key[order], group[order]
        index = np.arange(len(open_))
        first = np.maximum.accumulate(np.where(np.concatenate([[True], group[1:] != group[:-1]]), index, 0))
        part = np.maximum.accumulate(np.where(np.concatenate([[True], key[1:] != key[:-1]]), index, 0))
        sa[group + index - first] = open_
        rank[open_] = group + part - first
        ahead *= 2


def common_prefixes(words: np.ndarray, sa: np.ndarray, rank: np.ndarray, mark: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Bytes each suffix shares with the one before it: Kasai's scan, one step in all regions at a time.

    A region's scan goes through its positions in order and loses one byte per
    step; whatever it gains is compared eight bytes at a time.
    """
    lcp = np.zeros(len(sa), np.int64)
    begins = np.concatenate([[0], ends[:-1] + 1])
    lengths = ends - begins
    order = np.argsort(-lengths, kind="stable")
    begins, lengths = begins[order], lengths[order]
    shared = np.zeros(len(begins), np.int64)
    for o in range(int(lengths[0]) if len(lengths) else 0):
        live = int(np.searchsorted(-lengths, -o, side="left"))
        here = begins[:live] + o
        r = rank[here]
        before = sa[np.maximum(r - 1, 0)]
        limit = np.where(r > 0, np.minimum(mark[here] - here, mark[before] - before), 0)
        h = np.minimum(np.maximum(shared[:live] - 1, 0), limit)
        todo = np.flatnonzero(h < limit)
        while len(todo):
            differ = words[here[todo] + h[todo]] ^ words[before[todo] + h[todo]]
            same = np.where(differ == 0, 8, np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)) >> 3).astype(np.int64)
            h[todo] = np.minimum(h[todo] + same, limit[todo])
            todo = todo[(same == 8) & (h[todo] < limit[todo])]
        lcp[r] = h
        shared[:live] = h
    return lcp


def repeated_starts(regions: list[bytes], weights: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every start of a full string in the regions: region, place, group of equal strings, and whether the group repeats."""
    sizes = np.array([len(r) for r in regions], np.int64)
    ends = np.cumsum(sizes + 1) - 1
    raw = np.frombuffer(b"\0".join(regions) + b"\0", np.uint8)
    data = raw.astype(np.int64) + 1
    data[ends] = 0
    sa, rank, mark = suffix_array(data, ends)
    lcp = common_prefixes(words_at(raw), sa, rank, mark, ends)
    equal = np.cumsum(lcp < length)
    starts = np.flatnonzero(mark - np.arange(len(raw)) >= length)
    group = equal[rank[starts]]
    region = np.searchsorted(ends, starts)
    repeats = np.bincount(group, weights=weights[region])[group] > 1
    return region, starts - (ends[region] - sizes[region]), group, repeats


def _spans(region: np.ndarray, place: np.ndarray, length: int) -> Iterator[tuple[int, int, int]]:
    """Runs of repeated starts as (region, first byte, end)."""
    if len(place):
        new = np.flatnonzero(np.concatenate([[True], (region[1:] != region[:-1]) | (place[1:] != place[:-1] + 1)]))
        last = np.append(new[1:], len(place)) - 1
        yield from zip(region[new].tolist(), place[new].tolist(), (place[last] + length).tolist(), strict=True)


_SHARDED = "id long, tag long, start int, end int, gram long, part int, digests binary, owners binary, places binary"


def _sort_shards(length: int):
    """Suffix arrays over whole shards, about SHARD_BYTES at a time; spans of repeats, and lists of strings of divided k-grams."""

    def work(rows: list[tuple]) -> pa.RecordBatch:
        out: list[tuple] = []
        region, place, group, repeats = repeated_starts([r[5] for r in rows], np.array([min(r[6], 2) for r in rows], np.float64), length)
        own = np.array([r[6] < 2 for r in rows])[region]
        found = repeats & own
        out.extend((rows[k][2], rows[k][3], rows[k][4] + a, rows[k][4] + b, None, None, None, None, None) for k, a, b in _spans(region[found], place[found], length))
        parts = np.array([r[7] for r in rows])[region]
        divided = np.flatnonzero(parts > 1)
        if len(divided):
            # one start for each different string; those that repeat here are settled, so they need no owner
            _, at = np.unique(group[divided], return_index=True)
            chosen = divided[at]
            by_key: dict[tuple[int, int], list] = {}
            for i in chosen.tolist():
                r = rows[region[i]]
                digest = xxhash.xxh3_128_digest(r[5][place[i] : place[i] + length])
                settled = bool(repeats[i])
                by_key.setdefault((r[0], int.from_bytes(digest[:4], "little") % r[7]), []).append((digest, NO_ID if settled else r[2], 0 if settled else r[3], -1 if settled else r[4] + int(place[i])))
            for (gram, part), items in by_key.items():
                items.sort()
                owners = np.array([(x[1], x[2]) for x in items], "<i8")
                out.append((None, None, None, None, gram, part, b"".join(x[0] for x in items), owners.tobytes(), np.array([x[3] for x in items], "<i4").tobytes()))
        columns = list(zip(*out, strict=True)) if out else [[]] * 9
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in _SHARDED.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        shard: list[tuple] = []
        for batch in slices(batches, "bytes"):
            for row in zip(*(batch.column(c).to_pylist() for c in ("gram", "salt", "id", "tag", "first", "bytes", "copies", "parts")), strict=True):
                if shard and row[:2] != shard[0][:2]:
                    waiting += shard
                    shard = []
                    if sum(len(r[5]) for r in waiting) > SHARD_BYTES:
                        yield work(waiting)
                        waiting = []
                shard.append(row)
        waiting += shard
        if waiting:
            yield work(waiting)

    return run


def _merge_lists(length: int):
    """Strings that several shards list: each list is searched for in all lists of its range, sorted together."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        keys = [np.frombuffer(d, "S16") for d in rows["digests"]]  # all 128 bits in byte order
        everything = np.sort(np.concatenate(keys))
        found = []
        for mine, owners, places in zip(keys, rows["owners"], rows["places"], strict=True):
            times = np.searchsorted(everything, mine, side="right") - np.searchsorted(everything, mine, side="left")
            place = np.frombuffer(places, "<i4")
            hit = np.flatnonzero((times > 1) & (place >= 0))
            found.append(np.column_stack([np.frombuffer(owners, "<i8").reshape(-1, 2)[hit], place[hit]]))
        got = pd.DataFrame(np.concatenate(found), columns=["id", "tag", "place"]).sort_values(["id", "tag", "place"], ignore_index=True)
        if not len(got):
            return pd.DataFrame({"id": [], "tag": [], "start": [], "end": []})
        same = (got["id"].diff().fillna(1) == 0) & (got["tag"].diff().fillna(1) == 0) & (got["place"].diff().fillna(0) == 1)
        runs = got.groupby((~same).cumsum()).agg(id=("id", "first"), tag=("tag", "first"), start=("place", "first"), last=("place", "last"))
        return runs.assign(end=runs["last"] + length)[["id", "tag", "start", "end"]]

    return run


def repeated_spans(spark: SparkSession, keyed: DataFrame, length: int) -> DataFrame:
    """Spans (``id``, ``tag``, ``start``, ``end`` in bytes) that repeated strings cover; spans of a document may overlap."""
    scanned = saved(spark, keyed.mapInArrow(_scan(length), _RUNS), "runs")
    # most anchors stand once: only runs of the others go on
    shared = saved(spark, scanned.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram"), "anchors")
    drop_shuffles(spark)
    runs = saved(spark, scanned.join(shared, "gram").select(*scanned.columns), "shared-runs")
    discard(spark, scanned, shared)
    drop_shuffles(spark)
    regions = runs.groupBy("gram", "region").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("id", "tag", "first", "n")).alias("one"))
    grams = regions.groupBy("gram").agg(F.count(F.lit(1)).alias("regions"))
    regions = saved(spark, regions.join(grams, "gram"), "regions")
    drop_shuffles(spark)
    whole = runs.join(regions.filter("copies > 1").select("gram", "region"), ["gram", "region"])
    whole = whole.select("id", "tag", F.col("first").alias("start"), (F.col("first") + F.col("n") + (length - 1)).alias("end"))

    parts = F.ceil(F.col("regions") / SHARD_REGIONS).cast("int")
    asked = regions.filter("regions > 1").select(
        "gram", F.pmod(F.xxhash64("one.id", "one.tag", "one.first"), parts).cast("int").alias("salt"), parts.alias("parts"), F.least("copies", F.lit(2)).cast("int").alias("copies"), "one.*"
    )
    per_doc = asked.groupBy("id", "tag").agg(F.collect_list(F.struct("gram", "salt", "parts", "copies", "first", "n")).alias("asked"))
    kind = T.StructType.fromDDL("gram long, salt int, id long, tag long, first int, bytes binary, copies int, parts int")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            rows = []
            for row_id, tag, text, asks in zip(*(batch.column(c).to_pylist() for c in ("id", "tag", "text", "asked")), strict=True):
                data = text.encode()
                rows += [(a["gram"], a["salt"], row_id, tag, a["first"], data[a["first"] : a["first"] + a["n"] + length - 1], a["copies"], a["parts"]) for a in asks]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=kind.fieldNames())

    shards = keyed.join(per_doc, ["id", "tag"]).mapInArrow(cut, kind).repartition(width(spark), "gram", "salt").sortWithinPartitions("gram", "salt")
    sorted_ = saved(spark, shards.mapInArrow(_sort_shards(length), _SHARDED), "shards")
    drop_shuffles(spark)
    inside = sorted_.filter("digests is null").select("id", "tag", "start", "end")
    across = sorted_.filter("digests is not null").groupBy("gram", "part").applyInPandas(_merge_lists(length), "id long, tag long, start int, end int")
    return whole.unionByName(inside).unionByName(across)


def remove_repeats(
    spark: SparkSession,
    docs: DataFrame,
    length: int = LENGTH,
    text: str = "text",
    row_id: str = "doc_id",
    payload: list[str] | None = None,
    outputs: tuple[str, ...] = ("kept", "kept_text"),
) -> DataFrame:
    """One row per row of ``docs``: struct ``row`` (the ``payload`` columns, all by default), ``n_bytes``, ``spans``
    (maximal removed runs as array of start and end) and the ``outputs``: ``kept`` (remaining bytes),
    ``kept_sha256`` (their digest) and ``kept_text``.

    Every byte goes that a string of ``length`` bytes covers which also starts
    elsewhere, in the same document or another. ``kept_text`` removes whole
    characters only: a span gives back parts of characters at its ends. Null
    counts as empty; shorter texts stay as they are; rows that repeat each
    other remove each other. An empty table gives no rows.
    """
    ship(spark)
    body = whole_text(text)
    own = Row(docs, payload, text)
    base = docs.select(own.packed().alias("row"), F.coalesce(F.col(row_id).cast("long"), F.lit(NO_ID)).alias("id"), body.alias("text")).withColumn("tag", F.xxhash64("id", "text"))
    kept: list[DataFrame] = []
    with tidy(spark, kept):  # runs, regions and shards go before texts are shuffled once more
        spans = saved(spark, repeated_spans(spark, base.select("id", "tag", "text"), length), "spans")
        kept.append(spans)
    drop_shuffles(spark)
    per_doc = spans.distinct().groupBy("id", "tag").agg(F.collect_list(F.struct("start", "end")).alias("found"))
    joined = base.join(per_doc, ["id", "tag"], "left").select("row", "text", "found")
    kinds = {"text": "string", "kept": "binary", "kept_sha256": "string", "kept_text": "string"}
    wanted = [*(["text"] if own.text else []), *outputs]
    more = ", ".join(f"{name} {kinds[name]}" for name in wanted)
    schema = T.StructType([joined.schema["row"], *T.StructType.fromDDL(f"n_bytes long, spans array<struct<start:int,end:int>>{', ' * bool(more)}{more}").fields])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sizes, spans, made = [], [], {name: [] for name in outputs}
            for one, found in zip(batch.column("text").to_pylist(), batch.column("found").to_pylist(), strict=True):
                data = one.encode()
                merged: list[list[int]] = []
                for s in sorted((f["start"], f["end"]) for f in found or ()):
                    if merged and s[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s[1])
                    else:
                        merged.append(list(s))
                sizes.append(len(data))
                spans.append([{"start": a, "end": b} for a, b in merged])
                if "kept" in made:
                    made["kept"].append(_without(data, merged))
                if "kept_sha256" in made:
                    made["kept_sha256"].append(hashlib.sha256(_without(data, merged)).hexdigest())
                if "kept_text" in made:
                    made["kept_text"].append(_without(data, [_whole_characters(data, *m) for m in merged]).decode() if merged else one)
            columns = [pa.array(made[n], pa.binary() if n == "kept" else pa.string()) if n in made else batch.column(n) for n in wanted]
            span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(sizes, pa.int64()), pa.array(spans, span), *columns], names=schema.fieldNames())

    return joined.mapInArrow(apply, schema).select(own.unpacked().alias("row"), "n_bytes", "spans", *outputs)


def _without(data: bytes, spans: list) -> bytes:
    cuts = [0, *(x for s in spans for x in s), len(data)]
    return b"".join(data[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True))


def _whole_characters(data: bytes, start: int, end: int) -> tuple[int, int]:
    while start < end and data[start] & 0xC0 == 0x80:
        start += 1
    while end > start and end < len(data) and data[end] & 0xC0 == 0x80:
        end -= 1
    return start, end

"""Best-fit packing of token sequences with swap-based local search.

Documents are tokenized where they are read; only piece lengths move on. Pieces
are dealt to packing groups of bounded size by their place in their task, never
by content, so no source or group of copies can fill a group. A group is packed
best-fit decreasing and then improved: pieces of the emptiest bins move into
gaps, or change places one-for-one or two-for-one with smaller pieces of fuller
bins. Every step raises the sum of squared fills, so the emptiest bins drain
and vanish. Each group can end with a bin or so more than a single packing
would need, which a group's thousands of bins outweigh.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tableferry.llm.common import PieceCache, kept, saved, ship, slices, whole_text

CAPACITY = 2048
GROUP_PIECES = 40_000
END_ID = 0
#: Words whose ids a task keeps; more only save time.
KNOWN_WORDS = 400_000


class WordTokenizer:
    """Ids of whole texts from a tokenizer that drops white space, word by word.

    Words between spaces or line ends are encoded by the tokenizer itself, many
    in one call, each id being told to its word by its offset; known words come
    from a cache. Tokenizers whose tokens never span white space give the same
    ids as for the whole text.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.cache = PieceCache(self._words, KNOWN_WORDS)

    def _words(self, words: list[str]) -> list[list[int]]:
        out: list[list[int]] = []
        for a in range(0, len(words), 4096):
            some = words[a : a + 4096]
            got = self.tokenizer.encode("\n".join(some), add_special_tokens=False)
            ends = np.cumsum([len(w) + 1 for w in some])
            at = np.searchsorted(ends, np.array([o[0] for o in got.offsets], np.int64), side="right")
            cut = np.searchsorted(at, np.arange(len(some) + 1))
            ids = got.ids
            out.extend(ids[cut[i] : cut[i + 1]] for i in range(len(some)))
        return out

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's ids begin and end."""
        if not pc.any(pc.match_substring(texts, "<|")).as_py():  # else special tokens could appear by lower-casing
            texts = pc.ascii_lower(texts)
        texts = pc.replace_substring(texts, "\n", " ")
        texts = pc.replace_substring_regex(texts, "([a-z])([.,])", "\\1 \\2")  # the tokenizer cuts there anyway
        return self.cache.look_up_lists(pc.split_pattern(texts, " "))


def loaded(path: str) -> WordTokenizer:
    """The tokenizer of a file, loaded once per Python process while that packs."""
    return kept(("words", path), lambda: WordTokenizer(path))


def piece_table(docs: DataFrame, tokenizer_path: str, text: str = "text", row_id: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and ``deal``, the piece's number in its task.

    A document is its ids and then id 0, so an empty or null text is one piece
    of length 1. Only documents longer than ``capacity`` are cut.
    """
    ship(docs.sparkSession)
    source = docs.select(F.col(row_id).alias("doc_id"), whole_text(text).alias("text"))
    schema = T.StructType(
        [source.schema["doc_id"], T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()), T.StructField("deal", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = loaded(tokenizer_path)
        dealt = 0
        for batch in slices(batches, "text"):
            at, piece, start, length, crc = [], [], [], [], []
            all_ids, ends = tokenizer.encode_all(batch.column("text"))
            for i in range(batch.num_rows):
                ids = np.append(all_ids[ends[i] : ends[i + 1]], END_ID).astype("<u4")
                for k, a in enumerate(range(0, len(ids), capacity)):
                    part = ids[a : a + capacity]
                    at.append(i)
                    piece.append(k)
                    start.append(a)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(at)), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc)), pa.array(range(dealt, dealt + len(at)), pa.int64())],
                names=schema.fieldNames(),
            )
            dealt += len(at)

    return source.mapInArrow(run, schema)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of item numbers: longest item first, each into the fullest bin that takes it."""
    bins: list[list[int]] = []
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]  # numbers of bins by their gap
    gaps: list[int] = []  # gaps in use, sorted
    for item in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[item])
        at = bisect.bisect_left(gaps, size)
        if at == len(gaps):
            bins.append([item])
            left, where = capacity - size, len(bins) - 1
        else:
            gap = gaps[at]
            where = by_gap[gap].pop()
            if not by_gap[gap]:
                gaps.pop(at)
            bins[where].append(item)
            left = gap - size
        if left:
            if not by_gap[left]:
                bisect.insort(gaps, left)
            by_gap[left].append(where)
    return bins


def improve(lengths: np.ndarray, bins: list[list[int]], capacity: int) -> list[list[int]]:
    """Local search on the underfull bins until none of them can be emptied.

    The emptiest bin gives: each of its items, largest first, moves into the
    smallest gap that takes it, or changes places with one smaller item, or two
    items of it with one, in a fuller bin whose gap allows it. Every step fills
    a fuller bin further, so the sum of squared fills rises and the search ends.
    It ends when every underfull bin was tried since the last step, or when all
    gaps together cannot hold the emptiest bin.
    """
    bins = [list(b) for b in bins]
    fill = np.array([int(lengths[b].sum()) for b in bins], np.int64)
    owner = np.empty(len(lengths), np.int64)
    for k, b in enumerate(bins):
        owner[b] = k
    size = lengths.astype(np.int64)
    tried = np.zeros(len(bins), bool)
    while True:
        open_bins = (fill > 0) & (fill < capacity)
        room = int((capacity - fill[open_bins]).sum())
        givers = np.flatnonzero(open_bins & ~tried)
        if not len(givers):
            break
        least = int(fill[open_bins].min())
        if room - (capacity - least) < least:
            break
        giver = int(givers[np.argmin(fill[givers])])
        if _drain(giver, size, fill, owner, bins, capacity):
            tried[:] = False  # gaps have changed, so bins given up may have a chance
        tried[giver] = bool(bins[giver])
    return [b for b in bins if b]


def _drain(giver: int, size: np.ndarray, fill: np.ndarray, owner: np.ndarray, bins: list[list[int]], capacity: int) -> int:
    """Empty one bin as far as steps that raise the squared fill allow; the number of steps."""

    def shift(item: int, to: int) -> None:
        bins[owner[item]].remove(item)
        bins[to].append(item)
        fill[owner[item]] -= size[item]
        fill[to] += size[item]
        owner[item] = to

    steps = 0
    while bins[giver]:
        mine = sorted(bins[giver], key=lambda i: -size[i])
        gap = capacity - fill
        fuller = (fill >= fill[giver]) & (gap > 0)
        fuller[giver] = False
        for item in mine:
            fits = np.flatnonzero(fuller & (gap >= size[item]))
            if len(fits):
                shift(item, int(fits[np.argmin(gap[fits])]))
                break
        else:
            found = _exchange(mine, size, fuller, gap, owner, capacity)
            if found is None:
                return steps
            group, other = found
            to = int(owner[other])
            shift(other, giver)
            for item in group:
                shift(item, to)
        steps += 1
    return steps


def _exchange(mine: list[int], size: np.ndarray, fuller: np.ndarray, gap: np.ndarray, owner: np.ndarray, capacity: int) -> tuple[tuple[int, ...], int] | None:
    """One or two items of the giver and the smaller item of a fuller bin that they can replace; ``None`` if there is none.

    One suffices of items of equal size, so a bin offers at most about 64 sizes
    and all their pairs. For every size of the others' items only the widest
    gap beside such an item counts.
    """
    candidates = np.flatnonzero(fuller[owner])
    if not len(candidates):
        return None
    widest = np.full(capacity + 1, -1, np.int64)
    np.maximum.at(widest, size[candidates], gap[owner[candidates]])
    theirs = np.flatnonzero(widest >= 0)
    one_of: dict[int, list[int]] = {}
    for item in mine:
        one_of.setdefault(int(size[item]), []).append(item)
    offers = [(n, (items[0],)) for n, items in one_of.items()]
    sizes = list(one_of)
    offers += [(n + m, (one_of[n][0], one_of[m][n == m])) for k, n in enumerate(sizes) for m in sizes[k:] if n + m <= capacity and (n != m or len(one_of[n]) > 1)]
    wanted = np.array([n for n, _ in offers])
    good = (theirs[None, :] < wanted[:, None]) & (theirs + widest[theirs] >= wanted[:, None])
    able = np.flatnonzero(good.any(axis=1))
    if not len(able):
        return None
    pick = int(able[0])
    their_size = int(theirs[np.argmax(good[pick])])
    others = candidates[(size[candidates] == their_size) & (gap[owner[candidates]] + their_size >= wanted[pick])]
    return offers[pick][1], int(others[0])


def pack_lengths(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each item, and the number of bins."""
    bins = improve(lengths, best_fit_decreasing(lengths, capacity), capacity)
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for k, b in enumerate(bins):
        sizes = lengths[b]
        where[b] = k
        offset[b] = np.cumsum(sizes) - sizes
    return where, offset, len(bins)


def pack(spark: SparkSession, docs: DataFrame, tokenizer_path: str, text: str = "text", row_id: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of every document with ``sequence_id`` and ``offset``.

    Null texts count as empty; null or repeated ids are carried as they are,
    each row being a document of its own. Equal lengths may trade places. An
    empty table gives no rows; further columns of ``docs`` are not read.
    """
    pieces = saved(spark, piece_table(docs, tokenizer_path, text, row_id, capacity).withColumn("task", F.spark_partition_id()), "pieces")
    groups = max(1, -(-pieces.count() // GROUP_PIECES))
    schema = T.StructType([*(f for f in pieces.schema if f.name not in ("deal", "task")), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        where, offset, _ = pack_lengths(rows["length"].to_numpy(np.int64), capacity)
        rows["sequence_id"] = where * groups + key[0]
        rows["offset"] = offset
        return rows[schema.fieldNames()]

    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("task", "deal"), F.lit(groups)).cast("int")).drop("deal", "task")
    return dealt.groupBy("group").applyInPandas(run, schema)

from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from made_docs import docs  # noqa: F401
from tableferry.llm.ring import capacities, ring, shard, walk


@pytest.mark.parametrize("rows", [0, 1, 39, 40, 1000])
def test_walk_fills_every_shard_exactly(rows):
    places, owners = ring(40, 8)
    counts = np.bincount(np.random.default_rng(rows).integers(0, len(places), rows), minlength=len(places))
    counts[0] += rows // 2  # a hot arc
    plan = walk(counts, owners, capacities(int(counts.sum()), 40))
    load = Counter()
    for arc, first, end, to, slot in plan:
        assert slot == load[to] and end > first
        load[to] += end - first
    assert sum(load.values()) == counts.sum()
    assert not load or max(load[s] for s in range(40)) - min(load[s] for s in range(40)) <= 1
    for arc, n in enumerate(counts):
        parts = sorted((first, end) for a, first, end, _, _ in plan if a == arc)
        assert [p[0] for p in parts] == [0, *[p[1] for p in parts]][: len(parts)] and (parts[-1][1] if parts else 0) == n


def test_another_shard_moves_few_rows():
    keys = np.random.default_rng(1).integers(0, 1 << 63, 20_000)
    homes = []
    for n in (40, 41):
        places, owners = ring(n)
        homes.append(owners[np.searchsorted(places, keys) % len(places)])
    moved = homes[0] != homes[1]
    assert (homes[1][moved] == 40).all() and moved.mean() < 0.05


def by_hand(counts, owners, room):
    """Row by row: every row to its own shard while that has room, then the others clockwise to the first with room."""
    used, out, waiting = Counter(), {}, []
    for arc, n in enumerate(counts):
        for rank in range(n):
            shard_ = owners[arc]
            if used[shard_] < room[shard_]:
                out[arc, rank] = (shard_, used[shard_])
                used[shard_] += 1
            else:
                waiting.append((arc, rank))
    for arc, rank in waiting:
        at = arc + 1
        while used[owners[at % len(owners)]] >= room[owners[at % len(owners)]]:
            at += 1
        shard_ = owners[at % len(owners)]
        out[arc, rank] = (shard_, used[shard_])
        used[shard_] += 1
    return out


@pytest.mark.parametrize("seed", range(6))
def test_walk_against_row_by_row(seed):
    draw = np.random.default_rng(seed)
    places, owners = ring(7, 5)
    counts = draw.integers(0, 12, len(places))
    counts[int(draw.integers(len(places)))] += 150
    room = capacities(int(counts.sum()), 7)
    got = {(arc, rank): (to, slot + rank - first) for arc, first, end, to, slot in walk(counts, owners, room) for rank in range(first, end)}
    assert got == by_hand(counts, owners, room)


def homes(keys, shards, slack=0.0):
    places, owners = ring(shards)
    arc = np.searchsorted(places, keys) % len(places)
    order = np.lexsort((keys, arc))
    rank = np.empty(len(keys), np.int64)
    counts = np.bincount(arc, minlength=len(places))
    rank[order] = np.arange(len(keys)) - np.repeat(np.cumsum(counts) - counts, counts)
    out = np.full(len(keys), -1)
    for a, first, end, to, _ in walk(counts, owners, capacities(len(keys), shards, slack)):
        out[(arc == a) & (rank >= first) & (rank < end)] = to
    return out


def test_exact_bounds_move_little():
    """With counts one apart at most: one row in a hundred more, or one shard more, moves a limited share of the old rows."""
    keys = np.random.default_rng(3).integers(0, 1 << 63, 8_000)
    base = homes(keys[:7_920], 40)
    assert np.bincount(base, minlength=40).max() - np.bincount(base, minlength=40).min() <= 1
    assert (homes(keys, 40)[:7_920] != base).mean() < 0.05
    assert (homes(keys[:7_920], 41) != base).mean() < 0.20
    # a quarter of slack leaves almost all rows at home
    loose = homes(keys[:7_920], 40, 0.25)
    assert (homes(keys[:7_920], 41, 0.25) != loose).mean() < 0.06


def test_equal_texts_lie_together(spark, docs):
    pairs = [(i, f"text {i // 3}") for i in range(600)] + [(1000 + i, "the hot one") for i in range(300)]
    got = shard(spark, docs(*pairs), 6).toPandas()
    assert got.groupby("shard").size().tolist() == [150] * 6
    apart = got[got.doc_id < 1000].groupby("text_crc32")["shard"].nunique()
    assert (apart > 1).mean() < 0.15


def test_odd_documents(spark, docs):
    pairs = [(i, f"text {i}") for i in range(50)] + [(None, None), (7, ""), (7, ""), (60, "x" * 100_000)]
    got = shard(spark, docs(*pairs), 5).toPandas()
    assert len(got) == 54 and got.groupby("shard").size().between(10, 11).all()
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    last = got[got.doc_id == 60].iloc[0]
    assert last["size"] == 100_016 and last.text_crc32 == crc32(b"x" * 100_000)
    assert shard(spark, docs(), 5).count() == 0

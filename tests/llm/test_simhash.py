import random
import re

import numpy as np
import pytest
import xxhash

from made_docs import docs  # noqa: F401
from tableferry.llm.common import saved
from tableferry.llm.components import components
from tableferry.llm.simhash import Tile, block_bands, block_keys, fingerprint, forest, links_within, near_groups, one_per_group, one_per_print_group, shingle_hashes


def by_hand(text, words=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    parts = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not parts:
        return 0
    shingles = [" ".join(parts[i : i + words]) for i in range(len(parts) - words + 1)] or [" ".join(parts)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", "  \n", "one", "One TWO", "a b c d e f", "É é\x85x y z\x1cw", "a b c a b c a b c"])
def test_fingerprint(text):
    assert int.from_bytes(fingerprint(shingle_hashes(text, 3)), "big") == by_hand(text)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 12])
def test_tile_finds_all_close_pairs(radius):
    rng = np.random.default_rng(radius)
    for n in (1, 2, 63, 64, 65, 200):
        prints = rng.integers(0, 256, (5, 8)).astype(np.uint8)[rng.integers(0, 5, n)]
        for i in range(n):
            for _ in range(int(rng.integers(0, 4))):
                prints[i, rng.integers(8)] ^= 1 << int(rng.integers(8))
        a, b, d = Tile(prints, radius).close_pairs()
        distance = np.bitwise_count(prints[:, None, :] ^ prints[None]).sum(-1)
        want = [(i, j, int(distance[i, j])) for i in range(n) for j in range(i + 1, n) if distance[i, j] <= radius]
        assert sorted(zip(a.tolist(), b.tolist(), d.tolist(), strict=True)) == want


def test_forest_joins_what_pairs_join():
    a, b, d = np.array([0, 1, 0, 3]), np.array([1, 2, 2, 4]), np.array([2, 1, 1, 0])
    assert sorted(forest(6, a, b, d)) == [1, 2, 3]


def test_components(spark):
    links = [(1, 2), (2, 3), (5, 4), (9, 9), (7, 6), (6, 5), *[(20 + i, 21 + i) for i in range(40)]]
    got = dict(components(spark, spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**dict.fromkeys([1, 2, 3], 1), **dict.fromkeys([4, 5, 6, 7], 4), **dict.fromkeys(range(20, 61), 20)}
    assert components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def test_null_ids_repeated_rows_and_long_texts(spark, docs):
    draw = random.Random(6)
    long = " ".join(draw.choice("abcdefgh") * draw.randint(1, 4) for _ in range(120_000))
    pairs = [(None, "a b c d"), (None, "a b c d"), (9, "a b c d"), (4, "x y z w"), (4, "x y z w"), (None, "only null ids here"), (7, long), (8, long + " ")]
    got = near_groups(spark, docs(*pairs)).collect()
    assert len(got) == len(pairs)
    texts = dict(pairs)
    found = sorted((-1 if r.doc_id is None else r.doc_id, -1 if r.component_id is None else r.component_id) for r in got)
    assert found == [(-1, -1), (-1, 9), (-1, 9), (4, 4), (4, 4), (7, 7), (8, 7), (9, 9)]
    assert all(int.from_bytes(bytes(r.fingerprint), "big") == by_hand(texts[r.doc_id]) for r in got if r.doc_id is not None)


def test_groups_of_odd_documents(spark, docs):
    texts = {1: "a b c d", 2: "A b  C\nd", 3: None, 4: " ", 5: "other words here", 6: "a b c d"}
    got = {r.doc_id: r for r in near_groups(spark, docs(*texts.items())).collect()}
    assert {i: r.component_id for i, r in got.items()} == {1: 1, 2: 1, 6: 1, 3: 3, 4: 3, 5: 5}
    assert all(int.from_bytes(bytes(r.fingerprint), "big") == by_hand(texts[i] or "") for i, r in got.items())
    assert near_groups(spark, docs()).count() == 0


def test_links_over_chains_equal_brute_force(spark, monkeypatch, docs):
    from tableferry.llm import simhash

    rng = np.random.default_rng(5)
    prints = rng.integers(0, 256, (300, 8)).astype(np.uint8)
    for i in range(1, 300):
        if i % 3:
            prints[i] = prints[i - 1]
            for _ in range(int(rng.integers(1, 4))):
                prints[i, rng.integers(8)] ^= 1 << int(rng.integers(8))
    frame = spark.createDataFrame([(bytearray(p.tobytes()),) for p in prints], "fingerprint binary").distinct()
    links = simhash.close_links(spark, frame.selectExpr("fingerprint", "fingerprint AS keys"), simhash.PAIR_BANDS, 2, block=4)
    got = {bytes(r.node): bytes(r.root) for r in components(spark, links).collect()}
    names = sorted({p.tobytes() for p in prints})
    root = {n: n for n in names}
    changed = True
    while changed:
        changed = False
        for x in names:
            for y in names:
                if sum((p ^ q).bit_count() for p, q in zip(x, y, strict=True)) <= 2 and root[x] > root[y]:
                    root[x], changed = root[y], True
    assert {n: got.get(n, n) for n in names} == root


@pytest.mark.parametrize("radius", [3, 5, 6])
def test_close_fingerprints_share_three_blocks(radius):
    rng = np.random.default_rng(radius)
    bands = block_bands(radius + 3, 3)
    for _ in range(200):
        x = int(rng.integers(0, 1 << 64, dtype=np.uint64))
        y = x ^ sum(1 << int(b) for b in rng.choice(64, radius, replace=False))
        a, b = (bytes(k) for k in block_keys([x.to_bytes(8, "big"), y.to_bytes(8, "big")], radius + 3))
        assert len(a) == 2 * (radius + 3)
        assert any(all(a[i] == b[i] for i in own) for own in bands)
    with pytest.raises(ValueError):
        links_within(None, None, 7)


@pytest.mark.parametrize("radius", [2, 5])
def test_exploded_rows_are_never_broadcast(spark, radius):
    rows = [(bytes(row),) for row in np.random.default_rng(0).integers(0, 256, (50, 8)).tolist()]
    prints = spark.createDataFrame([*rows, (rows[0][0][:7] + bytes([rows[0][0][7] ^ 1]),)], "fingerprint binary")
    links = links_within(spark, saved(spark, prints, "prints"), radius)
    assert links.count() == 1
    assert "SortMergeJoin" in (plan := links._jdf.queryExecution().executedPlan().toString()) and "Broadcast" not in plan


def test_one_of_each_group_of_close_fingerprints(spark, docs):
    """The fingerprint's distance alone decides, against brute force."""
    draw = random.Random(8)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(6))
    pairs = [(None, "no words here but these"), (7, ""), (6, None), (6, " \n"), (5, "short text"), (9, "Short  text")]
    for k in range(40):  # one to ten words changed of 60 to 300
        base = [word() for _ in range(draw.choice([60, 150, 300]))]
        for i in range(2):
            pairs.append((100 + 2 * k + i, " ".join(base)))
            for at in draw.sample(range(len(base)), draw.randint(1, 10)):
                base[at] = word()
    prints = {i: by_hand(t or "") for i, t in pairs if i is not None}
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in prints:
        for j in prints:
            if (prints[i] ^ prints[j]).bit_count() <= 5:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    want = sorted({find(i) for i in prints})
    assert 50 < len(want) < 83
    kept = one_per_print_group(spark, docs(*pairs))
    assert kept.columns == docs().columns
    got = kept.collect()
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in got) == [-1, *want]
    assert one_per_print_group(spark, docs()).count() == 0


def test_one_of_each_group_of_similar_texts(spark, docs):
    draw = random.Random(1)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(300)]
    near = base[:150] + ["new"] + base[151:]
    far = [w if i % 8 else word() for i, w in enumerate(base)]
    pairs = [(3, " ".join(base)), (2, " ".join(near)), (1, " ".join(far)), (4, "short text"), (5, "short text"), (6, None), (7, ""), (None, " ".join(base + base[:20]))]
    kept = one_per_group(spark, docs(*pairs))
    assert kept.columns == docs().columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 6]
    assert one_per_group(spark, docs()).count() == 0


def kept_by_brute_force(texts, words=5, least=0.8):
    sets = {i: set(shingle_hashes(t, words).tolist()) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return sorted({find(i) for i in sets})


def test_links_hidden_among_rejected_ones_are_found(spark, docs):
    draw = random.Random(3)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(6))
    shared = [word() for _ in range(260)]
    texts = {i: " ".join(shared + [word() for _ in range(40)]) for i in range(150)}  # pairwise similarity 0.76
    for i in range(0, 60, 2):  # planted pairs just over 0.8
        texts[200 + i] = " ".join(shared + texts[i].split()[260:270] + [word() for _ in range(30)])
    want = kept_by_brute_force(texts)
    assert 150 <= len(want) < 180
    assert sorted(r.doc_id for r in one_per_group(spark, docs(*texts.items())).collect()) == want


def test_no_similar_pair_is_lost_among_short_texts(spark, docs):
    draw = random.Random(4)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(6))
    texts = {}
    for shingles, more in ((4, 1), (5, 1), (12, 3), (89, 11)):  # similarity 0.8 and little over
        for _ in range(60):
            base = [word() for _ in range(shingles + 4)]
            texts[len(texts)] = " ".join(base)
            texts[len(texts)] = " ".join(base + [word() for _ in range(more)])
    want = kept_by_brute_force(texts)
    assert len(want) == 240
    assert sorted(r.doc_id for r in one_per_group(spark, docs(*texts.items())).collect()) == want

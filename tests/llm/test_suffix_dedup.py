import random
from collections import Counter

import numpy as np
import pytest

from made_docs import docs  # noqa: F401
from tableferry.llm import suffix_dedup
from tableferry.llm.suffix_dedup import remove_repeats, repeated_starts
from tableferry.sources.files import path_exists


def by_hand(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        cover = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                cover[i : i + length] = True
        out.append(np.frombuffer(d, np.uint8)[~cover].tobytes())
    return out


@pytest.mark.parametrize("seed", range(4))
def test_suffix_arrays_find_all_repeats(seed):
    draw = random.Random(seed)
    for _ in range(30):
        regions = [bytes(draw.choice(b"ab") for _ in range(draw.randint(1, 60))) for _ in range(draw.randint(1, 12))]
        length = draw.randint(2, 12)
        seen = Counter(r[i : i + length] for r in regions for i in range(len(r) - length + 1))
        region, place, _, repeats = repeated_starts(regions, np.ones(len(regions)), length)
        got = {(int(k), int(i)): bool(x) for k, i, x in zip(region, place, repeats, strict=True)}
        assert got == {(k, i): seen[r[i : i + length]] > 1 for k, r in enumerate(regions) for i in range(len(r) - length + 1)}


@pytest.mark.parametrize(("shard", "length"), [(1000, 40), (2, 40), (3, 33)])
def test_same_bytes_as_by_hand(spark, docs, monkeypatch, shard, length):
    monkeypatch.setattr(suffix_dedup, "SHARD_REGIONS", shard)
    draw = random.Random(length)
    word = lambda n: "".join(draw.choice("abcdeé ") for _ in range(n))
    common = word(120)
    texts = [word(draw.randint(0, 300)) + (common[draw.randint(0, 20) : draw.randint(60, 120)] if draw.random() < 0.7 else "") + word(draw.randint(0, 200)) for _ in range(40)]
    texts += [None, "", "a" * 500, common, common, texts[0], "ab" * 100, word(5)]
    got = {r.doc_id: bytes(r.kept) for r in remove_repeats(spark, docs(*enumerate(texts)), length).select("row.doc_id", "kept").collect()}
    assert [got[i] for i in range(len(texts))] == by_hand(texts, length)


def test_rows_that_repeat_and_null_ids(spark, docs):
    found = remove_repeats(spark, docs((1, "x y z " * 30), (1, "x y z " * 30), (None, "unlike the others, " * 2)), 50)
    rows = sorted((r.row.doc_id or 0, r.n_bytes, len(r.spans), r.kept_text) for r in found.collect())
    assert rows == [(0, 38, 0, "unlike the others, " * 2), (1, 180, 1, ""), (1, 180, 1, "")]
    assert remove_repeats(spark, docs(), 50).count() == 0


def test_text_keeps_whole_characters(spark, docs):
    shared = "0123456789" * 5
    found = remove_repeats(spark, docs((1, "é" + shared + "à"), (2, "ã" + shared + "è")), 50)
    assert sorted(r.kept_text for r in found.collect()) == ["ãè", "éà"]


def test_runs_of_single_anchors_are_gone_before_texts_move(spark, docs, monkeypatch):
    draw = random.Random(2)
    word = lambda n: "".join(draw.choice("abcdefgh ") for _ in range(n))
    common, held, rows = word(80), [], {}

    def saved(spark, df, label):
        if label == "shards":
            held.extend(name for name, (path, _) in rows.items() if path_exists(spark, path))
        table = common_saved(spark, df, label)
        rows[label] = table._written_at, table.count()
        return table

    common_saved = suffix_dedup.saved
    monkeypatch.setattr(suffix_dedup, "saved", saved)
    texts = [word(400) for _ in range(20)] + [word(100) + common, common + word(100)]
    got = {r.doc_id: bytes(r.kept) for r in remove_repeats(spark, docs(*enumerate(texts)), 50).select("row.doc_id", "kept").collect()}
    assert [got[i] for i in range(len(texts))] == by_hand(texts, 50)
    assert sorted(held) == ["regions", "shared-runs"]
    assert rows["shared-runs"][1] * 10 < rows["runs"][1]

import random
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from made_docs import docs  # noqa: F401
from tableferry.llm.packing import WordTokenizer, best_fit_decreasing, improve, pack, pack_lengths

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_word_by_word_ids_equal_whole_text_ids():
    draw = random.Random(3)
    library, mine = Tokenizer.from_file(PATH), WordTokenizer(PATH)
    texts = ["", "İstanbul ΑΣ. ok", "a  b\tc　d\x1ce", "don't we'll 's", "<|ENDOFTEXT|> A.b, C"]
    texts += ["".join(draw.choice("aA'sbéÉ \n\t.,1ßΣ́日 ") for _ in range(draw.randint(0, 40))) for _ in range(1000)]
    for some in (texts, [*texts, "x<|endoftext|>y <|startoftext|>"]):
        ids, ends = mine.encode_all(pa.array(some))
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)] == [library.encode(t, add_special_tokens=False).ids for t in some]


@pytest.mark.parametrize("seed", range(5))
def test_search_never_loses_items_and_never_needs_more_bins(seed):
    lengths = np.random.default_rng(seed).integers(1, 101, 400)
    first = best_fit_decreasing(lengths, 100)
    better = improve(lengths, first, 100)
    assert sorted(i for b in better for i in b) == list(range(400))
    assert max(lengths[b].sum() for b in better) <= 100
    assert -(-lengths.sum() // 100) <= len(better) <= len(first)


def test_swaps_empty_a_bin():
    lengths = np.array([6, 3, 5, 4, 2])  # 6+3 | 5+4 | 2: two bins of ten hold all
    bins = improve(lengths, [[0, 1], [2, 3], [4]], 10)
    assert len(bins) == 2


def fewest(lengths, capacity):
    """The fewest bins, by trying every way."""
    best = len(lengths)

    def place(i, fills):
        nonlocal best
        if len(fills) >= best:
            return
        if i == len(lengths):
            best = len(fills)
            return
        for k, f in enumerate(fills):
            if f + lengths[i] <= capacity and f not in fills[:k]:
                place(i + 1, [*fills[:k], f + lengths[i], *fills[k + 1 :]])
        place(i + 1, [*fills, lengths[i]])

    place(0, [])
    return best


def test_small_sets_against_every_packing():
    draw = np.random.default_rng(8)
    right = greedy = 0
    for _ in range(300):
        lengths = np.sort(draw.integers(1, 16, 10))[::-1].copy()
        first = best_fit_decreasing(lengths, 20)
        better = improve(lengths, first, 20)
        least = fewest(lengths.tolist(), 20)
        assert least <= len(better) <= len(first)
        right += len(better) == least
        greedy += len(first) == least
    assert right >= 297 and right >= greedy


@pytest.mark.parametrize("seed", range(4))
def test_search_ends_where_no_step_is_left(seed):
    """No move and no exchange is possible any more for any underfull bin, or all gaps cannot hold the emptiest."""
    draw = np.random.default_rng(seed)
    lengths = draw.integers(1, 30, 60)
    bins = [b for b in np.array_split(np.argsort(-lengths), 25) if lengths[b].sum() <= 100]
    kept = np.concatenate(bins)
    names = {int(i): k for k, i in enumerate(kept)}
    bins = improve(lengths[kept], [[names[int(i)] for i in b] for b in bins], 100)
    size = lengths[kept]
    fill = np.array([size[b].sum() for b in bins])
    open_bins = [k for k in range(len(bins)) if fill[k] < 100]
    least = min((fill[k] for k in open_bins), default=0)
    if sum(100 - fill[k] for k in open_bins) - (100 - least) < least:
        return
    for k in open_bins:
        for j in open_bins:
            if j != k and fill[j] >= fill[k]:
                assert all(size[i] > 100 - fill[j] for i in bins[k])
                for group in [(i,) for i in bins[k]] + [(i, m) for i in bins[k] for m in bins[k] if i < m]:
                    n = size[list(group)].sum()
                    assert not any(size[o] < n <= size[o] + 100 - fill[j] for o in bins[j])


def test_many_sizes_take_bounded_time():
    lengths = np.random.default_rng(1).integers(600, 1500, 5000)
    started = time.perf_counter()
    bins = improve(lengths, best_fit_decreasing(lengths, 2048), 2048)
    assert max(lengths[b].sum() for b in bins) <= 2048 and time.perf_counter() - started < 60


def test_offsets_are_gapless():
    where, offset, n = pack_lengths(np.array([5, 5, 3, 3, 2, 1, 1]), 10)
    assert n == 2
    for k in range(n):
        some = sorted(zip(offset[where == k], np.array([5, 5, 3, 3, 2, 1, 1])[where == k], strict=True))
        assert [a for a, _ in some] == list(np.cumsum([0] + [b for _, b in some])[:-1])


def test_pack_of_odd_documents(spark, docs):
    got = pack(spark, docs((1, None), (2, ""), (3, "word " * 5000), (None, "a"), (4, "b"), (4, "b")), PATH).toPandas()
    assert len(got) == 5 + 3
    third = got[got.doc_id == 3].sort_values("piece")
    assert third.length.tolist() == [2048, 2048, 905] and third.start.tolist() == [0, 2048, 4096]
    assert got.groupby("sequence_id").length.sum().max() <= 2048
    assert pack(spark, docs(), PATH).count() == 0

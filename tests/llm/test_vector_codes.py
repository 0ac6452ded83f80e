import random

import numpy as np
import pytest

from tableferry.llm.vector_codes import Codebook, books_digest, code_text, compress, with_label_error


def full_search(parts, entries):
    return np.array([min(range(len(entries)), key=lambda k: (sum((int(a) - int(b)) ** 2 for a, b in zip(x, entries[k])), k)) for x in parts])


@pytest.mark.parametrize("seed", range(8))
def test_balls_find_what_a_full_search_finds(seed):
    draw = np.random.default_rng(seed)
    spread = int(draw.integers(2, 60))  # small values give many ties and equal entries
    parts, entries = draw.integers(-spread, spread, (300, 3)), draw.integers(-spread, spread, (40, 3))
    book = Codebook(entries)
    codes, distance, _ = book.assign(parts, None)
    assert (codes == full_search(parts, entries)).all()
    for step in range(3):
        after = entries.copy()
        after[draw.integers(0, 40, 5 * (step + 1))] += draw.integers(-3, 4, 3)
        book = Codebook(after, entries)
        codes, distance, work = book.assign(parts, codes)
        assert (codes == full_search(parts, after)).all()
        assert (distance == ((parts - after[codes]) ** 2).sum(1)).all()
        entries = after


def test_separated_balls_are_left_alone():
    entries = np.arange(30)[:, None] * 1000
    parts = np.repeat(entries, 50, axis=0) + np.tile(np.arange(50), 30)[:, None]
    codes, _, _ = Codebook(entries).assign(parts, None)
    again, _, work = Codebook(entries + 1, entries).assign(parts, codes)
    assert (again == codes).all() and work == len(parts)


def by_hand(rows, entries=256, rounds=4):
    kept = [(i, [int(np.floor(1024 * float(x))) for x in v], y) for i, v, y in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0], r[1]))
    width = len(kept[0][1]) // 4
    books, codes = [], []
    for p in range(4):
        x = np.array([r[1][p * width : (p + 1) * width] for r in kept], dtype=object)
        book = [list(e) for e in x[:entries]]
        for done in range(rounds + 1):
            code = [min(range(len(book)), key=lambda k: (sum((a - b) ** 2 for a, b in zip(one, book[k])), k)) for one in x]
            if done == rounds:
                break
            for k in set(code):
                own = [one for one, c in zip(x, code) if c == k]
                book[k] = [sum(col) // len(own) for col in zip(*own)]
        books.append(book)
        codes.append((code, [sum((a - b) ** 2 for a, b in zip(one, book[c])) for one, c in zip(x, code)]))
    out = [(r[0], "".join(f"{codes[p][0][n]:02x}" for p in range(4)), sum(codes[p][1][n] for p in range(4)), r[2]) for n, r in enumerate(kept)]
    return out, [np.array(b, np.int64) for b in books]


@pytest.mark.parametrize("n", [3, 60])
def test_whole_table_against_a_plain_loop(spark, n):
    draw = random.Random(n)
    rows = [(10 * i, [draw.choice([-0.5, -0.1, 0.0, 0.003, 0.2, 0.21]) for _ in range(8)], draw.choice([None, 1, 2])) for i in range(n)]
    rows += [rows[0], (2, rows[1][1], 7), (5, None, 1), (6, [None] + [0.0] * 7, 1), (7, [float("inf")] + [0.0] * 7, 1), (8, [float("nan")] * 8, None)]
    frame = spark.createDataFrame([(*r, "own") for r in rows], "vec_id long, embedding array<float>, label int, code string")
    coded, books = compress(spark, frame, entries=16)
    got = with_label_error(spark, coded).select("vec_id", code_text().alias("code"), "error", "label", "label_error").collect()
    want, own = by_hand([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], y) for i, v, y in rows], entries=16)
    assert sorted((r.vec_id, r.code, r.error, r.label or 0) for r in got) == sorted((i, c, e, y or 0) for i, c, e, y in want)
    assert books_digest(books) == books_digest(own)
    total = {}
    for _, _, e, y in want:
        total[y] = total.get(y, 0) + e
    assert all(r.label_error == total[r.label] for r in got)


def test_edge_tables(spark):
    kinds = "vec_id long, embedding array<double>, label int"
    coded, books = compress(spark, spark.createDataFrame([], kinds))
    assert coded.count() == 0 and books == []
    odd = spark.createDataFrame([(1, [0.5] * 6, 1), (None, [0.5] * 8, 1)], kinds)
    assert [tuple(r) for r in compress(spark, odd)[0].collect()] == [(1, 1, None, None), (None, 1, None, None)]
    mixed = spark.createDataFrame([(1, [0.5] * 8, 1), (2, [0.5] * 4, 1), (None, [0.25] * 8, None)], kinds)
    found = {r.vec_id: (r.codes, r.error) for r in compress(spark, mixed)[0].collect()}
    assert found == {1: ([0, 0, 0, 0], 0), 2: (None, None), None: ([1, 1, 1, 1], 0)}
    with pytest.raises(ValueError, match="beyond a long"):
        compress(spark, spark.createDataFrame([(1, [1e20] * 8, 1)], kinds))

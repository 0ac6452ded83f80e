import random
import time

import numpy as np
import pytest

from made_docs import docs  # noqa: F401
from tableferry.llm.toxicity import count_words, maximal_segments, score, train, training_rows


def by_definition(scores):
    """The best segment, then the same to its left and right."""
    out = []

    def split(a, b):
        best = max(((sum(scores[i:j]), -i, -j) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0, 0, 0))
        if best[0] > 0:
            split(a, -best[1])
            out.append((-best[1], -best[2]))
            split(-best[2], b)

    split(0, len(scores))
    return out


@pytest.mark.parametrize("seed", range(20))
def test_segments_follow_their_definition(seed):
    draw = random.Random(seed)
    scores = np.array([draw.uniform(-3, 2) for _ in range(draw.randint(0, 25))])
    assert [(a, b) for a, b, _ in maximal_segments(scores)] == by_definition(scores.tolist())


@pytest.mark.parametrize("drift", [-0.01, -0.4, -2.0])
def test_segments_take_linear_time(drift):
    """1.6 million words whose sums fall, rise and stay: every second word is positive."""
    rng = np.random.default_rng(1)
    scores = np.where(np.arange(1_600_000) % 2 == 0, rng.uniform(0.5, 1.5, 1_600_000), rng.uniform(-1.5, -0.5, 1_600_000) + drift)
    started = time.perf_counter()
    found = maximal_segments(scores)
    assert time.perf_counter() - started < 20 and len(found) > 0


def test_counts_are_those_of_words(spark):
    frame = spark.createDataFrame([("Vermin vermin's x1y", 1), ("verm, vermin", 0), ("", 0)], "text string, label int")
    counts = {(r.level, r.toxic, r.clean) for r in count_words(frame).collect()}
    # words: vermin 2/1, s 1/0, x 1/0, y 1/0, verm 0/1; beginnings of four letters: verm 2/2
    assert {(0, 2, 1), (0, 1, 0), (0, 0, 1), (1, 2, 2), (2, 2, 1)} <= counts and sum(r[1] for r in counts if r[0] == 0) == 3


def corpus(n, seed):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        words = ["w" + "".join(draw.choice("abcde") for _ in range(3)) for _ in range(draw.randint(5, 60))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(draw.randint(2, 5)):
                words.insert(draw.randrange(len(words)), draw.choice(["vermin", "garbage", "zlurp" + draw.choice("abcdefgh")]))
        out.append((i, " ".join(words), int(toxic)))
    return out


def test_held_out_documents(spark, docs):
    made = corpus(600, 1)
    labels = spark.createDataFrame([(i, y) for i, _, y in made] + [(None, 1), (9999, 0), (0, None)], "doc_id long, toxic int")
    known = {r.doc_id for r in training_rows(labels).filter("doc_id is not null").collect()}
    frame = docs(*[(i, t) for i, t, _ in made])
    model = train(spark, frame, training_rows(labels))
    extra = docs((-1, None), (-2, ""), (-3, "zlurpzz " * 3 + "w " * 50_000), (-3, "wabc"), (None, "garbage vermin garbage"))
    got = {(r.doc_id, r.score) for r in score(frame.unionByName(extra), model).select("row.doc_id", "score").collect()}
    held = [(y, s) for i, t, y in made if i not in known for d, s in got if d == i]
    assert len(held) > 150 and all(0 <= s <= 1 for _, s in got)
    assert sum((s >= 0.7) == (y == 1) for y, s in held) / len(held) > 0.97
    by_id = dict(got)
    assert by_id[-1] == by_id[-2] < 0.5 and by_id[None] > 0.7


def test_without_labels_or_documents(spark, docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = train(spark, docs((1, "a b")), none)
    assert [r.score < 0.1 for r in score(docs((1, "a b")), model).collect()] == [True]
    assert score(docs(), train(spark, docs(), none)).count() == 0

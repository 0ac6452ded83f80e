import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from tableferry.llm.quality_rules import count_features, judge, tail, upper_bound


def by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = {i + step for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for step in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated)


ODD = ["", " \n\t\r\x0b\x0c ", "a", "a b", "a a a", "a a a a", "x\ny\nx\n \n \nx\r\nx\r", "Ä ß 漢字 漢字 漢字 漢字 a b\x85c", "|<>#*$%& $ a|b", "a\x00b a\x00b", "é " * 5, "\n" * 50, "one two three four one two three"]


def test_counts_follow_their_definition():
    draw = random.Random(5)
    made = [draw.choice(["", "\n"]).join(draw.choice(["a", "b", "cc", "É", " ", "  ", "\n", "\t", "# "]) for _ in range(draw.randint(0, 60))) for _ in range(300)]
    texts = ODD + made + ["lorem ipsum dolor " * 40_000, ("w%d " * 3 % (1, 2, 3)) + " ".join(map(str, range(50_000)))]
    found = count_features(pa.array(texts))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert [tuple(int(found[c][i]) for c in names) for i in range(len(texts))] == [by_hand(t) for t in texts]


def test_counts_of_no_texts():
    assert all(len(v) == 0 for v in count_features(pa.array([], pa.string())).values())
    assert count_features(pa.array([""]))["n_words"].tolist() == [0]


@pytest.mark.parametrize(("k", "n", "share"), [(0, 10, 0.3), (3, 10, 0.3), (9, 10, 0.9), (10, 10, 0.5), (40, 2000, 0.02)])
def test_tail_is_the_binomial_sum(k, n, share):
    assert tail(k, n, share) == pytest.approx(sum(math.comb(n, i) * share**i * (1 - share) ** (n - i) for i in range(k + 1)))


def test_upper_bound():
    assert upper_bound(0, 100, 0.05) == pytest.approx(1 - 0.05 ** (1 / 100))
    assert tail(7, 300, upper_bound(7, 300, 0.01)) == pytest.approx(0.01)
    assert upper_bound(5, 5, 0.05) == 1.0


def test_bound_holds_over_many_draws():
    """Of many holdouts that break the risk, at most about the stated share is cleared."""
    draw = random.Random(2)
    risk, level, n = 0.05, 0.1, 200
    cleared = sum(tail(sum(draw.random() < risk for _ in range(n)), n, risk) <= level for _ in range(2000))
    assert cleared / 2000 <= level


def corpus(n, seed):
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choice("abcdefghij") for _ in range(5)) for _ in range(500)]
    out = []
    for i in range(n):
        words = [draw.choice(vocabulary) for _ in range(draw.randint(60, 90))]
        bad = i % 4 == 0
        if bad:
            words = [w + "###" if j % 3 else w for j, w in enumerate(words)]
        out.append((i, " ".join(words), "xx" if i % 10 else "rare", bad))
    return out


def test_rules_reject_bad_documents_and_keep_good_ones(spark):
    made = corpus(3000, 1)
    rows = [(i, t, lang, "lang") for i, t, lang, _ in made] + [(9001, None, "xx", ""), (9002, "", None, ""), (9003, made[0][1], None, ""), (9004, made[0][1], "unseen", ""), (None, made[1][1], "xx", ""), (1, made[1][1], "xx", "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept string")
    labels = spark.createDataFrame([(i, int(not bad)) for i, _, _, bad in made if i % 3] + [(None, 1), (2, None), (5, 7), (4, 0)], "doc_id long, quality int")
    judged, chosen = judge(spark, frame, labels)
    found = [(r.row.doc_id, r.kept, r.base_failed, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.row.text) for r in judged.collect()]
    assert len(found) == len(rows)
    assert all(r[3:8] == by_hand(r[8]) and r[2] == (r[3] < 50 or 100 * r[7] > 50 * r[3]) for r in found)
    rung = {r.stratum: r for r in chosen.collect()}
    assert rung["=xx"].last_rung >= 0 and rung["=xx"].bound <= 0.02
    assert rung["=rare"].last_rung == -1  # too few labels for the bound: all stay
    kept = {r[0]: r[1] for r in found if r[0] is not None}
    common = [(kept[i], bad) for i, _, lang, bad in made if lang == "xx"]
    assert not any(k for k, bad in common if bad)
    assert sum(k for k, bad in common if not bad) >= 0.98 * sum(not bad for _, bad in common)
    assert all(kept[i] for i, _, lang, _ in made if lang == "rare")
    assert (kept[9001], kept[9002], kept[9003], kept[9004]) == (False, False, True, True)


def test_copies_count_once_in_the_holdout(spark):
    made = corpus(2, 3)
    frame = spark.createDataFrame([(i, made[1][1], "xx") for i in range(3000)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(3000)], "doc_id long, quality int")
    judged, chosen = judge(spark, frame, labels)
    assert sum(r.n_good for r in chosen.collect()) <= 1 and judged.filter("kept").count() == 3000


def test_without_labels_or_documents(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    long = " ".join(map(str, range(60)))
    frame = spark.createDataFrame([(1, long, "en"), (2, "short", "en")], "doc_id long, text string, lang string")
    assert {(r.row.doc_id, r.kept) for r in judge(spark, frame, none)[0].collect()} == {(1, True), (2, False)}
    assert judge(spark, frame.filter("false"), none)[0].count() == 0

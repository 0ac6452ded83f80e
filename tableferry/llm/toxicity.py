"""Toxic passages by maximum-scoring segment search over token log-odds.

Counts. Words of the labelled training documents are counted per class, each
word with its beginnings of four and six letters, under 64-bit hashes. A word's
log-odds are those of Dirichlet posteriors: its prior is the class split of its
longer beginning, whose prior is that of the shorter one, whose prior is the
split of all words; so an unseen ending of a known stem still counts, and a word
seen once counts next to nothing.

Passages. One linear scan finds all maximal scoring segments of a document
(Ruzzo and Tompa). A segment's score is measured against chance by its
extreme-value distribution: with the lambda that solves E[exp(lambda s)] = 1
over the words of all clean training documents, a document of n words has about
n exp(-lambda S) segments of score S or more. Significant passages are those
with an expectation below a limit. The document's score is its best and total
chance-corrected evidence, put on the scale of probabilities by a logistic
curve fitted to a bounded sample of training documents.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.llm.common import PieceCache, Row, discard, kept, saved, ship, slices, whole_text

STEMS = (4, 6)
PRIOR = 10.0
SCORE_LIMIT = 8.0
DRIFT = 0.7
EXPECTED = 0.01
#: Labelled documents that words are counted in, about; more are thinned by a hash of their ids.
TRAINING_ROWS = 1_000_000
#: Labelled documents that the curve is fitted on, about.
SAMPLE = 20_000
#: Entries of a model, 16 bytes each; past it, entries seen least often give way to their beginnings.
MODEL_ENTRIES = 4_000_000
LEVELS = 1 + len(STEMS)

_FLUSH = 1 << 18
_STEP = 1 << 16  # scores are kept in steps of 1 / 65536

_WORD = re.compile(r"[^\W\d_]+")


def _keys(word: str) -> tuple[int, ...]:
    """Hashes of a word and of its beginnings; every level has hashes of its own."""
    digest = xxhash.xxh3_64_intdigest
    return tuple(digest(word if not level else word[: STEMS[level - 1]], seed=level) for level in range(LEVELS))


class _Words:
    """Numbers of words: ``encode`` maps a list of words to one number or row of numbers per word."""

    def __init__(self, encode: Callable[[list[str]], np.ndarray], width: int):
        kept("toxicity", object)  # the caches of other operators are not needed now
        self.encode, self.width = encode, width
        self.cache = PieceCache(self._tokens)

    def _tokens(self, tokens: list[str]) -> list[list[int]]:
        words = [_WORD.findall(t.lower()) for t in tokens]
        flat = [w for ws in words for w in ws]
        numbers = self.encode(flat).ravel().tolist() if flat else []
        ends = np.cumsum([0, *map(len, words)]) * self.width
        return [numbers[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def split(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all words in order, and each text's end among the words. Words are runs of letters, lower-cased."""
        for blank in ("\n", "\t", "\r"):
            texts = pc.replace_substring(texts, blank, " ")
        numbers, ends = self.cache.look_up_lists(pc.split_pattern(texts, " "))
        return numbers, ends // self.width


def count_words(labelled: DataFrame) -> DataFrame:
    """(``word``, ``level``, ``toxic``, ``clean``) over all rows of (text, label): how often each class holds a word or beginning.

    Every task adds up its own documents first, so a shuffle row stands for a
    word and task; a task that meets very many words passes them on in parts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place: dict[int, int] = {}
        levels = bytearray()

        def number(level: int, key: int) -> int:
            at = place.setdefault(key, len(place))
            if at == len(levels):
                levels.append(level)
            return at

        def encode(words: list[str]) -> np.ndarray:
            return np.array([[number(level, k) for level, k in enumerate(_keys(w))] for w in words])

        def parts(total: np.ndarray) -> Iterator[pa.RecordBatch]:
            level, key = np.frombuffer(bytes(levels), np.uint8).astype(np.int32), np.fromiter(place, np.uint64, len(place))
            for a in range(0, len(place), 100_000):
                own = slice(a, min(a + 100_000, len(place)))
                columns = [key[own].view(np.int64), level[own], total[1, own], total[0, own]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["word", "level", "toxic", "clean"])

        words, total = _Words(encode, LEVELS), np.zeros((2, 0), np.int64)
        for batch in slices(batches, "text"):
            ids, ends = words.split(batch.column("text"))
            owner = np.repeat(batch.column("label").to_numpy(), np.diff(ends))
            total = np.pad(total, ((0, 0), (0, len(place) - total.shape[1])))
            for label in (0, 1):
                total[label] += np.bincount(ids.reshape(-1, LEVELS)[owner == label].ravel(), minlength=len(place))
            if len(place) > _FLUSH:
                yield from parts(total)
                place.clear()
                levels.clear()
                words, total = _Words(encode, LEVELS), np.zeros((2, 0), np.int64)
        yield from parts(total)

    counted = labelled.mapInArrow(run, "word long, level int, toxic long, clean long")
    return counted.groupBy("word", "level").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


@dataclass
class Model:
    """Counts per class of words and beginnings by sorted hash, all words of either class, the scale of chance, and the curve to probabilities."""

    keys: np.ndarray
    toxic: np.ndarray
    clean: np.ndarray
    words: tuple[float, float] = (0.5, 0.5)
    scale: float = 1.0
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log-odds of words, toxic against clean, less the drift that makes ordinary text fall."""
        toxic, clean = (max(n, 0.5) for n in self.words)
        keys = np.array([_keys(w) for w in words], np.uint64)
        split = np.full(len(words), toxic / (toxic + clean))
        for level in [*range(1, LEVELS), 0]:  # short beginnings, longer ones, the word
            at = np.searchsorted(self.keys, keys[:, level])
            known = at < len(self.keys)
            known[known] = self.keys[at[known]] == keys[known, level]
            t, c = np.zeros(len(words)), np.zeros(len(words))
            t[known], c[known] = self.toxic[at[known]], self.clean[at[known]]
            split = (t + PRIOR * split) / (t + c + PRIOR)
        odds = np.log(split / (1 - split)) - np.log(toxic / clean)
        return np.clip(odds, -SCORE_LIMIT, SCORE_LIMIT) - DRIFT

    def reader(self) -> _Words:
        """Splits texts into word scores, in steps of 1 / 65536."""
        return _Words(lambda words: np.rint(self.word_scores(words) * _STEP).astype(np.int64), 1)


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) in one pass, in time linear in the number of words.

    Runs below zero only lower the running sum, so only positive words are
    visited; each becomes a segment that swallows earlier ones while that
    raises its score. Every segment remembers the nearest earlier one that
    begins at a smaller sum, so what lies between is never looked at again.
    """
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    kept: list[tuple] = []  # start, end, sum before, sum after, place of the nearest earlier one with a smaller sum before
    for i in np.flatnonzero(scores > 0).tolist():
        start, left, right = i, float(sums[i]), float(sums[i + 1])
        j = len(kept) - 1
        while True:
            while j >= 0 and kept[j][2] >= left:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= right:
                break
            start, _, left, _, before = kept[j]
            del kept[j:]
            j = before
        kept.append((start, i + 1, left, right, j))
    return [(a, b, r - l) for a, b, l, r, _ in kept]


def _lambda(values: np.ndarray, weights: np.ndarray) -> float:
    """The positive root of E[exp(lambda s)] = 1 over word scores of clean documents."""
    weights = weights / weights.sum()
    low, high = 1e-3, 8.0
    for _ in range(60):
        mid = (low + high) / 2
        if float((weights * np.exp(np.minimum(mid * values, 700))).sum()) > 1:
            high = mid
        else:
            low = mid
    return (low + high) / 2


def evidence(scores: np.ndarray, scale: float) -> tuple[float, float, list[tuple[int, int, float]]]:
    """Best and total chance-corrected evidence of a document, and its significant passages (start, end, expectation)."""
    n = max(len(scores), 1)
    best, total, passages = 0.0, 0.0, []
    for a, b, s in maximal_segments(scores):
        over = scale * s - np.log(n)  # minus the log of the expected number of such segments
        best = max(best, over)
        if np.exp(-over) < EXPECTED:
            total += over
            passages.append((a, b, float(np.exp(-over))))
    return best, total, passages


def _fit(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float, float]:
    """Logistic curve over (best, log total evidence) by Newton steps, with a little shrinkage."""
    design = np.column_stack([np.ones(len(x)), x[:, 0], np.log1p(x[:, 1])])
    w = np.zeros(3)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(3)
        step = np.linalg.solve(hessian, design.T @ (y - p) - 1e-2 * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(v) for v in w)


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, text: str = "text", row_id: str = "doc_id", label: str = "toxic") -> Model:
    """Model from the documents that ``labels`` (row_id, label) names for training.

    About TRAINING_ROWS labelled ids are used, all if there are no more, chosen by
    a hash; their ids go to every task, so no text is shuffled to meet its label.
    Words and the scale of chance are counted over all of those documents, the
    curve is fitted on about SAMPLE of them. Of several labels of an id the
    largest counts. Without labels of both classes every document scores alike, below 0.1.
    """
    ship(spark)
    known = labels.filter(F.col(label).isin(0, 1) & F.col(row_id).isNotNull()).groupBy(F.col(row_id).alias("doc_id")).agg(F.max(label).cast("int").alias("label"))
    known = saved(spark, known, "labels")
    near = lambda rows, wanted: rows.filter(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 30)) < math.ceil(min(1.0, wanted / max(1, rows.count())) * (1 << 30)))
    few = F.broadcast(near(known, TRAINING_ROWS))  # bounded by TRAINING_ROWS
    labelled = docs.select(F.col(row_id).alias("doc_id"), whole_text(text).alias("text")).join(few, "doc_id")
    labelled = saved(spark, labelled, "labelled")
    counts = saved(spark, count_words(labelled.select("text", "label")), "word-counts")
    model = _model(counts)
    model.scale = _scale(labelled, model)
    x = _score_frame(near(labelled, SAMPLE), model, ["label"]).select("label", "best", "total").toArrow().to_pandas()
    if 0 < x["label"].sum() < len(x):
        model.curve = _fit(x[["best", "total"]].to_numpy(float), x["label"].to_numpy(float))
    else:
        model.curve = (-3.0, 0.0, 0.0)
    discard(spark, known, labelled, counts)
    return model


def _model(counts: DataFrame) -> Model:
    """The count table as arrays of at most MODEL_ENTRIES entries."""
    seen = F.col("toxic") + F.col("clean")
    least = [1 << i for i in range(40)]
    row = counts.agg(*[F.count_if(seen >= n).alias(f"n{n}") for n in least], *[F.coalesce(F.sum(F.when(F.col("level") == 0, F.col(c))), F.lit(0)).alias(c) for c in ("toxic", "clean")]).first()
    enough = next(n for n in least if row[f"n{n}"] <= MODEL_ENTRIES)
    table = counts.filter(seen >= enough).select("word", "toxic", "clean").toArrow()
    keys = table["word"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return Model(keys[order], *(table[c].to_numpy()[order].astype(np.float32) for c in ("toxic", "clean")), (float(row["toxic"]), float(row["clean"])))


def _scale(labelled: DataFrame, model: Model) -> float:
    """Lambda over the words of all clean training documents: a histogram of scores, added up per task."""
    edges = np.linspace(-SCORE_LIMIT - DRIFT, SCORE_LIMIT - DRIFT, 401)
    shared = labelled.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, total = shared.value.reader(), np.zeros(len(edges) - 1, np.int64)
        for batch in slices(batches, "text"):
            total += np.histogram(words.split(batch.column("text"))[0] / _STEP, edges)[0]
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["cell", "n"])

    cells = labelled.filter("label = 0").select("text").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    if not cells:
        return 1.0
    middle = (edges[:-1] + edges[1:]) / 2
    return _lambda(np.array([middle[c.cell] for c in cells]), np.array([c.n for c in cells], np.float64))


def _score_frame(rows: DataFrame, model: Model, payload: list[str]) -> DataFrame:
    """``payload`` columns with ``best``, ``total``, ``score`` and ``passages`` of ``text``. The model's size is bounded by MODEL_ENTRIES."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    kinds = rows.select(*payload).schema
    schema = T.StructType([*kinds, *T.StructType.fromDDL("best double, total double, score double, passages array<struct<first_word:int,end_word:int,expected:double>>").fields])
    out_type = pa.list_(pa.struct([("first_word", pa.int32()), ("end_word", pa.int32()), ("expected", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        words, w = model.reader(), model.curve
        for batch in slices(batches, "text"):
            scores, ends = words.split(batch.column("text"))
            scores = scores / _STEP
            best, total, passages = [], [], []
            for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                x, y, found = evidence(scores[a:b], model.scale)
                best.append(x)
                total.append(y)
                passages.append([{"first_word": i, "end_word": j, "expected": e} for i, j, e in found])
            score = 1 / (1 + np.exp(-np.clip(w[0] + w[1] * np.array(best) + w[2] * np.log1p(np.array(total)), -30, 30)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in payload), pa.array(best), pa.array(total), pa.array(score), pa.array(passages, out_type)], names=schema.fieldNames())

    return rows.select(*payload, *([] if "text" in payload else ["text"])).mapInArrow(run, schema)


def score(docs: DataFrame, model: Model, text: str = "text", payload: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: struct ``row`` (the ``payload`` columns, all by default), ``score`` from 0 to 1 and ``passages``.

    Whole texts are scored; null and empty texts score like a text without
    toxic words. Nothing is shuffled. An empty table gives no rows.
    """
    ship(docs.sparkSession)
    row = Row(docs, payload, text)
    scored = _score_frame(docs.select(row.packed().alias("row"), whole_text(text).alias("text")), model, ["row", "text"] if row.text else ["row"])
    return scored.select(row.unpacked().alias("row"), "score", "passages")


def training_rows(labels: DataFrame, row_id: str = "doc_id") -> DataFrame:
    """Labels whose CRC-32 of the id as text leaves another remainder than 1 when divided by 3."""
    return labels.filter(F.crc32(F.col(row_id).cast("string").cast("binary")) % 3 != 1)

"""Quality rules whose thresholds are chosen under a risk bound.

A rule rejects a document where one of its measures (symbols, repeated lines,
repeated words, capitals, very long or short words) exceeds a cutoff. Cutoffs
are chosen per stratum (by default the language) from labelled documents, which
a hash of the text deals into a fitting part and a holdout:

1. Fitting part: a ladder of cutoffs. On rung t every rule takes the smallest
   cutoff that rejects at most a share q_t of the good documents. Rungs run from
   no good document at all to several percent.
2. Holdout: rung by rung, from the loosest, the exact binomial test of "rejects
   more than ``risk`` of the good documents". The stratum stops at the first rung
   that the test cannot clear at level ``doubt / strata``. So rungs within a
   stratum need no correction (a fixed sequence ends at its first failure) and
   strata are corrected by Bonferroni: with probability 1 - doubt no stratum's
   rules reject more than ``risk`` of its good documents.
3. Of the cleared rungs the one with the largest excess of bad over good
   rejections in the fitting part is taken; without an excess, none.

A stratum without enough labels clears no rung and its documents all stay. Equal
texts count once in the holdout, as copies are not independent.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.llm.common import saved, ship, slices, whole_text

FEW_WORDS = 50
RISK = 0.02
DOUBT = 0.05
HOLDOUT = 0.7
#: Shares of good documents that a rung may reject in the fitting part.
RUNGS = (0.0, 0.0005, 0.001, 0.002, 0.004, 0.006, 0.008, 0.01, 0.0125, 0.015, 0.02)
#: Measures in thousandths; higher is worse. ``short_words`` counts up as words get shorter.
MEASURES = {
    "symbols": "1000 * n_symbols / word_chars",
    "capitals": "1000 * n_capitals / word_chars",
    "dup_lines": "1000 * n_dup_lines / n_lines",
    "repeat_words": "1000 * n_repeat_words / n_words",
    "long_words": "100 * word_chars / n_words",
    "short_words": "1000 * n_words / word_chars",
}

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")
_BLANKS = "\t\n\x0b\x0c\r"


def _owners(lists: pa.ListArray) -> np.ndarray:
    return np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))


def count_features(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of ``_COUNTS`` for every text (no nulls among them).

    Words are runs without the ASCII blanks, lines end at a line feed. Everything
    is counted on numbers that stand for words and lines, per text and over whole texts.
    """
    n = len(texts)
    lines = pc.split_pattern(texts, "\n")
    coded = lines.flatten().dictionary_encode()
    line_id, owner = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), _owners(lines)
    real = pc.match_substring_regex(coded.dictionary, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)[line_id] if len(line_id) else np.zeros(0, bool)
    line_id, owner = line_id[real], owner[real]
    different = np.unique(owner * (len(coded.dictionary) + 1) + line_id) // (len(coded.dictionary) + 1)
    n_lines = np.bincount(owner, minlength=n)

    flat = texts
    for blank in _BLANKS:
        flat = pc.replace_substring(flat, blank, " ")
    words = pc.split_pattern(flat, " ")
    coded = words.flatten().dictionary_encode()
    word, owner = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), _owners(words)
    sizes = pc.utf8_length(coded.dictionary).to_numpy(zero_copy_only=False).astype(np.int64)
    real = sizes[word] > 0 if len(word) else np.zeros(0, bool)
    word, owner = word[real], owner[real]
    capitals = pc.count_substring_regex(coded.dictionary, r"\p{Lu}").to_numpy(zero_copy_only=False).astype(np.int64)
    sums = lambda values: np.bincount(owner, values, n).astype(np.int64)

    return {
        "n_words": np.bincount(owner, minlength=n),
        "word_chars": sums(sizes[word]),
        "n_symbols": pc.count_substring_regex(texts, "[#*$%&|<>]").to_numpy(zero_copy_only=False).astype(np.int64),
        "n_dup_lines": n_lines - np.bincount(different, minlength=n),
        "n_repeat_words": np.bincount(owner[_repeated(word, owner)], minlength=n),
        "n_lines": n_lines,
        "n_capitals": sums(capitals[word]),
    }


def _repeated(word: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Which words stand in a three-word window that their text holds twice or more."""
    covered = np.zeros(len(word), bool)
    at = np.flatnonzero(owner[:-2] == owner[2:]) if len(word) > 2 else np.zeros(0, np.int64)
    if not len(at):
        return covered
    # windows as numbers, exactly: a number for the pair of words, then for the pair and the third in this text
    word = np.unique(word, return_inverse=True)[1]
    span = int(word.max()) + 1
    pair = np.unique(word[at] * span + word[at + 1], return_inverse=True)[1]
    window = np.unique(pair * span + word[at + 2], return_inverse=True)[1]
    window = np.unique(owner[at] * (int(window.max()) + 1) + window, return_inverse=True)[1]
    twice = at[np.bincount(window)[window] > 1]
    for step in range(3):
        covered[twice + step] = True
    return covered


def features(docs: DataFrame, payload: list[str], text: str = "text") -> DataFrame:
    """``payload`` columns with the counts of every whole text (null: none) and ``text_hash``. Nothing is shuffled."""
    ship(docs.sparkSession)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in payload]).alias("row"), whole_text(text).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = count_features(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("text_hash"), *(pa.array(found[c]) for c in _COUNTS)], names=["row", "text_hash", *_COUNTS])

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, text_hash long, " + ", ".join(f"{c} long" for c in _COUNTS))


def tail(k: int, n: int, share: float) -> float:
    """Probability of at most ``k`` successes in ``n`` trials of probability ``share``, summed term by term."""
    if k >= n:
        return 1.0
    i = np.arange(k + 1)
    step = np.log((n - i[1:] + 1) / i[1:]) + math.log(share) - math.log1p(-share)
    logs = n * math.log1p(-share) + np.concatenate([[0.0], np.cumsum(step)])
    top = logs.max()
    return min(1.0, float(np.exp(top) * np.exp(logs - top).sum()))


def upper_bound(k: int, n: int, level: float) -> float:
    """Exact (Clopper-Pearson) upper bound of a share of which ``k`` in ``n`` were seen: the share whose tail is ``level``."""
    if k >= n:
        return 1.0
    low, high = 0.0, 1.0 - 1e-12
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if mid > 0 and tail(k, n, mid) > level else (low, mid) if mid > 0 else (mid, high)
    return high


def ladders(fit: DataFrame, rungs: tuple[float, ...] = RUNGS) -> DataFrame:
    """(``stratum``, ``cuts``): for every measure its cutoff on each rung, from rows (stratum, good, measures).

    Equal values are added up per task before the shuffle; a group then holds one
    row per value, of at most a few thousand.
    """
    long = fit.filter("good").unpivot("stratum", [F.col(m) for m in MEASURES], "measure", "value").groupBy("stratum", "measure", "value").agg(F.count(F.lit(1)).alias("n"))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("value", ascending=False)
        value, above = group["value"].to_numpy(), (group["n"].cumsum() - group["n"]).to_numpy()
        total = int(group["n"].sum())
        cuts = [int(value[above <= share * total].min()) for share in rungs]  # rejecting above it takes ``above`` good documents
        return pd.DataFrame({"stratum": [group["stratum"].iloc[0]], "measure": [group["measure"].iloc[0]], "cuts": [cuts]})

    each = long.groupBy("stratum", "measure").applyInPandas(run, "stratum string, measure string, cuts array<int>")
    return each.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("measure", "cuts"))).alias("cuts"))


def first_rung(rungs: int) -> Column:
    """The loosest rung whose cutoffs reject a row; ``rungs`` where none does. Cutoffs fall from rung to rung."""

    def cleared(measure: str) -> Column:
        return F.size(F.filter(F.element_at("cuts", F.lit(measure)), lambda cut: F.col(measure) <= cut))

    return F.when(F.col("cuts").isNull(), F.lit(rungs)).otherwise(F.least(*map(cleared, MEASURES)))


def chosen_rungs(rows: DataFrame, strata: int, risk: float, doubt: float, rungs: int) -> DataFrame:
    """(``stratum``, ``rung``, ``n_good``, ``n_rejected``, ``bound``) from labelled rows (stratum, good, held, rung).

    ``rung`` is the last rung that rejects, -1 for none; ``bound`` is the upper
    bound of its false rejections at level ``doubt / strata``.
    """
    counts = rows.groupBy("stratum", "held", "good", "rung").agg(F.count(F.lit(1)).alias("n"))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        def rejected(held: bool, good: bool) -> np.ndarray:
            own = group[(group["held"] == held) & (group["good"] == good)]
            return np.cumsum(np.bincount(own["rung"], own["n"], rungs + 1)).astype(np.int64)

        good, level = rejected(True, True), doubt / strata
        total, cleared = int(good[-1]), 0
        while cleared < rungs and total and tail(int(good[cleared]), total, risk) <= level:
            cleared += 1
        gain = (rejected(False, False) - rejected(False, True))[:cleared]
        rung = int(gain.argmax()) if cleared and gain.max() > 0 else -1
        k = int(good[rung]) if rung >= 0 else 0
        return pd.DataFrame({"stratum": [group["stratum"].iloc[0]], "last_rung": [rung], "n_good": [total], "n_rejected": [k], "bound": [upper_bound(k, total, level) if total else 1.0]})

    return counts.groupBy("stratum").applyInPandas(run, "stratum string, last_rung int, n_good long, n_rejected long, bound double")


def judge(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    stratum: str = "lang",
    risk: float = RISK,
    doubt: float = DOUBT,
    row_id: str = "doc_id",
    label: str = "quality",
    payload: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Every row of ``docs`` (struct ``row``, counts, ``base_failed``, ``kept``, ``stratum``, ``rung``) and the table of chosen rungs.

    A document fails the base rules with fewer than 50 words or with more than
    half of its words in repeated windows; only the others are used to choose
    cutoffs, and only they can be rejected by them. ``labels`` (row_id, label)
    name good (1) and bad (0) documents; of several labels of an id the largest
    counts, other values and null ids count for nothing. A null stratum is a
    stratum of its own. Rows may repeat. Without labels all but the failed stay;
    an empty table gives no rows.

    Only the counts pass on from the texts. Labels meet documents by id, as
    narrow rows; the strata's cutoffs come back to all rows by a join that
    Spark broadcasts or splits by measured size.
    """
    names = payload if payload is not None else docs.columns
    rows = features(docs.withColumns({"__id": F.col(f"`{row_id}`"), "__stratum": F.col(f"`{stratum}`").cast("string")}), [*names, "__id", "__stratum"])
    failed = (F.col("n_words") < FEW_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    measure = lambda c: F.when(F.col("n_words") > 0, F.expr(c).cast("int")).otherwise(F.lit(0))
    rows = rows.withColumns({"base_failed": failed, "stratum": F.coalesce(F.concat(F.lit("="), F.col("row.__stratum")), F.lit("null")), **{m: measure(c) for m, c in MEASURES.items()}})
    rows = saved(spark, rows, "quality-counts")

    known = labels.filter(F.col(label).isin(0, 1) & F.col(row_id).isNotNull()).groupBy(F.col(row_id).alias("__known")).agg((F.max(label) == 1).alias("good"))
    labelled = rows.filter("not base_failed").select(F.col("row.__id").alias("__id"), "stratum", "text_hash", *MEASURES).join(known, F.col("__id") == F.col("__known"))
    once = labelled.groupBy("stratum", "text_hash", *MEASURES).agg(F.max("good").alias("good"))
    share = F.pmod(F.xxhash64("text_hash", F.lit("holdout")), F.lit(1 << 20)) < int(HOLDOUT * (1 << 20))
    once = saved(spark, once.withColumn("held", share), "quality-labelled")

    strata = max(1, once.select("stratum").distinct().count())
    steps = len(RUNGS)
    cuts = saved(spark, ladders(once.filter("not held")), "quality-cutoffs")
    placed = once.join(cuts, "stratum").select("stratum", "good", "held", first_rung(steps).alias("rung"))
    chosen = saved(spark, cuts.join(chosen_rungs(placed, strata, risk, doubt, steps), "stratum"), "quality-rungs")

    judged = rows.join(chosen.select("stratum", "cuts", "last_rung"), "stratum", "left").withColumn("rung", first_rung(steps))
    kept = ~F.col("base_failed") & (F.col("rung") > F.coalesce(F.col("last_rung"), F.lit(-1)))
    own = F.struct(*[F.col(f"row.`{c}`").alias(c) for c in names]).alias("row")
    return judged.select(own, *_COUNTS, "base_failed", kept.alias("kept"), "stratum", "rung"), chosen

"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written as
Parquet and read again as the next stage's documents. A stage begins by deleting
the intermediate tables of the stages before it, unless its ``docs`` still read
from them: write a stage's frame before the next stage is called.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.llm import common, exact_dedup, packing, simhash, suffix_dedup, toxicity
from tableferry.session import scratch_path

REJECT_SCORE = 0.7
#: Differing bits at which fingerprints link: a changed word in 200 stays below, and complete bands have 24 bits.
NEAR_BITS = 5
#: Bytes of a passage that must not repeat: below 50 words of any language in hand.
PASSAGE_BYTES = 200

#: SQL cannot score, fingerprint or tokenize texts; tests compare every stage with brute force.
ORACLE_SQL = None

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Intermediate tables of stages that ran before.
_earlier: list[str] = []


def _stage(work: Stage) -> Stage:
    """Let ``work`` begin without the intermediate tables of earlier stages that its documents do not need."""

    @wraps(work)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = docs.inputFiles() if _earlier else []
        common.discard_paths(spark, [p for p in _earlier if not any(p.rsplit("/", 1)[1] in file for file in read)])
        _earlier[:] = [p for p in _earlier if p in common.written]
        common.drop_shuffles(spark)
        before = set(common.written)
        out = work(spark, docs, sf_dir)
        _earlier.extend(p for p in common.written if p not in before)
        return out

    return run


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.7."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(spark, docs.select("doc_id", "text"), toxicity.training_rows(labels).select("doc_id", "toxic"))
    return toxicity.score(docs, model).filter(F.col("score") < REJECT_SCORE).select("row.*")


@_stage
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts: the one with the largest id."""
    return exact_dedup.deduplicate(spark, docs)


@_stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of close SimHash fingerprints: 64 bits over three-word shingles, NEAR_BITS or fewer differ."""
    return simhash.one_per_print_group(spark, docs, radius=NEAR_BITS)


@_stage
def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that also stand elsewhere; ``n_chars`` follows the text."""
    rest = [c for c in docs.columns if c not in ("text", "n_chars")]
    marked = docs.withColumn("has text", F.col("text").isNotNull())
    found = suffix_dedup.remove_repeats(spark, marked, length=PASSAGE_BYTES, payload=[*rest, "has text"], outputs=("kept_text",))
    new = {"text": F.when(F.col("row.`has text`"), F.col("kept_text")), "n_chars": F.length("kept_text").cast("long")}
    return found.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


@_stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in sequences of 2048 tokens."""
    return packing.pack(spark, docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", drop_passages),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written below the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

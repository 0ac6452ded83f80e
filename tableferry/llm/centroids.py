"""Centroid clustering in whole numbers, all inside the JVM.

Vectors become arrays of whole numbers. A round gives every vector the nearest
of a few literal centroids: ``zip_with`` and ``aggregate`` compute each squared
distance, ``array_min`` over (distance, number) structs picks the nearest and
settles ties. Column sums per cluster, combined in every task, then move the
centroids; one row per centroid reaches the driver.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.llm.common import discard, saved, whole_numbers

CENTROIDS = 8
ROUNDS = 10
SCALE = 1024
DIMS = 64
SEED = 3

_LONG = (1 << 63) - 1


def _longs(numbers: list[int]) -> Column:
    """A literal array; one text is far quicker to plan than many columns."""
    return F.expr(f"array({', '.join(f'{n}L' for n in numbers)})")


def _distance(numbers: list[int]) -> Column:
    """Squared distance of ``v`` to a centroid: the vector's own square (``own``), less twice the product, plus the centroid's square."""
    doubled = _longs([2 * c for c in numbers])
    product = F.aggregate(F.zip_with("v", doubled, lambda x, c: x * c), F.lit(0).cast("long"), lambda total, p: total + p)
    return F.col("own") - product + F.lit(sum(c * c for c in numbers)).cast("long")


def assign(rows: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``rows`` (v, own, ...) with ``near``: the squared distance to the nearest centroid and its number; ties go to the smaller number."""
    choices = [F.struct(_distance(c).alias("distance"), F.lit(k).alias("cluster")) for k, c in enumerate(centroids)]
    return rows.withColumn("near", F.array_min(F.array(*choices)))


def moved(assigned: DataFrame, centroids: list[list[int]], kind: str) -> list[list[int]]:
    """Centroids after a round: exact floors of sum by count; empty ones stay. ``kind`` holds the sums."""
    dims = len(centroids[0])
    sums = [F.expr(f"sum(cast(v[{i}] as {kind})) as s{i}") for i in range(dims)]
    totals = assigned.select(F.col("near.cluster").alias("cluster"), "v").groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums)
    after = list(centroids)
    for row in totals.collect():  # one row per centroid
        after[row["cluster"]] = [int(row[f"s{i}"]) // row["n"] for i in range(dims)]
    return after


def cluster(
    spark: SparkSession,
    vectors: DataFrame,
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    dims: int = DIMS,
    seed: int = SEED,
    row_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """(``vec_id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid``, ``centroid_sha256``) per kept vector.

    Vectors of another length than ``dims``, null ones and those with null or
    non-finite components take no part. Components count as floor(scale * x).
    The k kept vectors whose ids have the smallest SHA-256 are the first
    centroids; a row with a null id is clustered but comes last there, and rows
    that share an id are ordered by their vectors. Rows may repeat. Fewer
    vectors than k give fewer centroids; none give no rows. A table whose
    squared distances no long can hold is refused before any round.

    A cluster with most of the rows is one partial sum per task. The vectors are
    written once as whole numbers; rounds end early when no centroid moves, as
    all later ones would repeat.
    """
    usable = vectors.filter(F.size(vector) == dims).select(F.col(row_id).alias("vec_id"), whole_numbers(F.col(vector), scale).alias("v")).filter("v is not null")
    numbers = saved(spark, usable, "whole-vectors")
    if not dims:
        raise ValueError("vectors need at least one component")
    size = numbers.agg(F.count(F.lit(1)).alias("n"), F.max(F.array_max("v")).alias("top"), F.min(F.array_min("v")).alias("low")).first()
    if not size["n"]:
        return numbers.selectExpr("vec_id", "0 cluster", "0L distance", "0L cluster_inertia", "0L inertia", "v centroid", "'' centroid_sha256").filter("false")
    largest = max(abs(size["top"]), abs(size["low"]))
    if 4 * largest * largest * dims > _LONG:
        raise ValueError(f"components up to {largest} of {dims} have squared distances beyond a long")
    kind = "long" if largest * size["n"] <= _LONG else "decimal(38,0)"
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    centroids = [list(r["v"]) for r in numbers.orderBy(place.asc_nulls_last(), "v").limit(k).select("v").collect()]
    own = F.aggregate("v", F.lit(0).cast("long"), lambda total, x: total + x * x)
    rows = numbers.withColumn("own", own)
    for _ in range(rounds):
        after = moved(assign(rows, centroids), centroids, kind)
        if after == centroids:
            break
        centroids = after
    placed = saved(spark, assign(rows, centroids).select("vec_id", "near.cluster", "near.distance"), "placed-vectors")
    discard(spark, numbers)
    inertia = {r["cluster"]: int(r["total"]) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    per_cluster = lambda values: F.element_at(F.array(*values), F.col("cluster") + 1)
    return placed.select(
        "vec_id",
        "cluster",
        "distance",
        per_cluster([F.lit(inertia.get(i, 0)).cast("long") for i in range(len(centroids))]).alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        per_cluster([_longs(c) for c in centroids]).alias("centroid"),
        per_cluster([F.lit(hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for c in centroids]).alias("centroid_sha256"),
    )

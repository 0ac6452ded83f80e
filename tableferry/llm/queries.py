"""The operators on the driver's tables with production parameters, and SQL where it can express the result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tableferry.llm import (
    centroids,
    exact_dedup,
    host_trust,
    packing,
    pieces,
    quality_rules,
    ring,
    simhash,
    suffix_dedup,
    templates,
    threshold_search,
    toxicity,
    vector_codes,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; a third of the labels is never learned from."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.train(spark, docs.select("doc_id", "text"), toxicity.training_rows(labels).select("doc_id", "toxic"))
    scored = toxicity.score(docs, model, payload=["doc_id"])
    return scored.select(
        "row.doc_id",
        (F.crc32(F.col("row.doc_id").cast("string").cast("binary")) % 3 == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"),
    )


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's url."""
    return host_trust.judge(spark, _table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "host", "path", "rule", "verdict")


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids and round trip of every document."""
    encoded = pieces.encode_frame(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return templates.extract(spark, _table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document in sequences of 2048 tokens."""
    return packing.pack(spark, _table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty shards by consistent hashing with exact load bounds."""
    dealt = ring.shard(spark, _table(spark, sf_dir, "documents"), 40)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors for every fiftieth one."""
    return threshold_search.top_k(spark, _table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the copy of it that stays."""
    found = exact_dedup.classes(spark, _table(spark, sf_dir, "documents"), payload=["doc_id"])
    return found.select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document."""
    found = simhash.near_groups(spark, _table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.hex("fingerprint")).alias("fingerprint"), "component_id")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated 400-byte strings."""
    found = suffix_dedup.remove_repeats(spark, _table(spark, sf_dir, "documents"), payload=["doc_id"], outputs=("kept_sha256", "kept_text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return found.select("row.doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256", "kept_text")


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight clusters of the 64-component vectors, as whole numbers."""
    found = centroids.cluster(spark, _table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document, and whether base rules and risk-bounded cutoffs keep it."""
    judged, _ = quality_rules.judge(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), payload=["doc_id"])
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("row.doc_id", *counts, "base_failed", "kept")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-byte codes of the vectors with their errors."""
    coded, books = vector_codes.compress(spark, _table(spark, sf_dir, "embeddings"))
    found = vector_codes.with_label_error(spark, coded)
    return found.select("vec_id", vector_codes.code_text().alias("code"), "error", "label_error", F.lit(vector_codes.books_digest(books)).alias("codebooks_sha256"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_url_filter,
        op3_pieces,
        op4_main_text,
        op5_packing,
        op6_sharding,
        op7_top_k,
        op8_exact_dedup,
        op9_simhash,
        op10_suffix_dedup,
        op11_centroids,
        op12_quality_rules,
        op13_vector_codes,
    )
} | {"pipeline": corpus_pipeline.run}


def _centroid_sql(k: int, rounds: int) -> str:
    """Every round as two steps: the nearest centroid of each vector, then the floors of the means."""
    steps = [
        f"""v AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR)), e) - 1 AS n, e FROM v
            QUALIFY n < {k}
        )"""
    ]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
            SELECT v.r, any_value(v.vec_id) AS vec_id, any_value(v.e) AS e, min({{'d': CAST(list_sum(list_transform(list_zip(v.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT), 'n': c.n}}) AS near
            FROM v CROSS JOIN c{i} AS c GROUP BY v.r)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
            WITH x AS (SELECT near.n AS n, unnest(e) AS x, unnest(range(64)) AS p FROM a{i}),
            m AS (SELECT n, p, CAST(sum(x) AS BIGINT) AS s, count(*) AS q FROM x GROUP BY n, p),
            f AS (SELECT n, list((s - ((s % q) + q) % q) // q ORDER BY p) AS e FROM m GROUP BY n)
            SELECT c.n, coalesce(f.e, c.e) AS e FROM c{i} AS c LEFT JOIN f USING (n))""")
    return f"""WITH {", ".join(steps)}
        SELECT vec_id, CAST(near.n AS INTEGER) AS cluster, near.d AS distance, CAST(sum(near.d) OVER (PARTITION BY near.n) AS BIGINT) AS cluster_inertia,
            CAST(sum(near.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.e, ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} AS c ON c.n = near.n"""


def _codes_sql(entries: int, rounds: int) -> str:
    """The same two steps per part position."""
    steps = [
        f"""v AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS MATERIALIZED (
            SELECT r, p, e[1 + p * len(e) // 4 : (p + 1) * len(e) // 4] AS e FROM v, (SELECT unnest(range(4)) AS p)
        ), c0 AS MATERIALIZED (SELECT p, r - 1 AS n, e FROM s WHERE r <= {entries})"""
    ]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
            SELECT s.r, s.p, any_value(s.e) AS e, min({{'d': CAST(list_sum(list_transform(list_zip(s.e, c.e), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS BIGINT), 'n': c.n}}) AS near
            FROM s JOIN c{i} AS c USING (p) GROUP BY s.r, s.p)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
            WITH x AS (SELECT p, near.n AS n, unnest(e) AS x, unnest(range(len(e))) AS k FROM a{i}),
            m AS (SELECT p, n, k, CAST(sum(x) AS BIGINT) AS s, count(*) AS q FROM x GROUP BY p, n, k),
            f AS (SELECT p, n, list((s - ((s % q) + q) % q) // q ORDER BY k) AS e FROM m GROUP BY p, n)
            SELECT c.p, c.n, coalesce(f.e, c.e) AS e FROM c{i} AS c LEFT JOIN f USING (p, n))""")
    return f"""WITH {", ".join(steps)},
        o AS (SELECT r, string_agg(printf('%02x', near.n), '' ORDER BY p) AS code, CAST(sum(near.d) AS BIGINT) AS error FROM a{rounds} GROUP BY r),
        b AS (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY p, n)) AS codebooks_sha256 FROM c{rounds})
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM v JOIN o USING (r), b"""


ORACLES = {
    "op7_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
        ), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op8_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
            sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op11_centroids": _centroid_sql(centroids.CENTROIDS, centroids.ROUNDS),
    "op13_vector_codes": _codes_sql(vector_codes.ENTRIES, vector_codes.ROUNDS),
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL

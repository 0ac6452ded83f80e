import random

import numpy as np
import pytest

import corpus_pipeline
from made_docs import docs  # noqa: F401
from tableferry.llm import common
from tableferry.llm.queries import ORACLES, QUERIES
from tableferry.llm.simhash import fingerprint, shingle_hashes
from tableferry.sources.files import path_exists

SF = "/root/testdata/sf0.001"


def test_every_operator_has_a_query():
    assert [f"op{n}" for n in range(1, 14)] == [name.split("_")[0] for name in QUERIES if name != "pipeline"]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_near_dedup", "suffix_array_dedup", "best_fit_packing"]


def test_sql_where_it_can_express_a_query():
    assert set(ORACLES) == {"op7_top_k", "op8_exact_dedup", "op11_centroids", "op13_vector_codes"}


@pytest.fixture
def folder(spark, tmp_path):
    """Documents with planted toxic rows, copies, near copies and a shared passage."""
    draw = random.Random(11)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(draw.randint(3, 8)))
    texts = {i: [word() for _ in range(200)] for i in range(60)}
    passage = [word() for _ in range(60)]
    for i in range(0, 20):
        texts[i] += random.Random(i).choices(["vermin", "garbage", "scoundrel"], k=6)
    texts[40] = list(texts[41])
    texts[42] = texts[43][:100] + ["changed"] + texts[43][101:]
    for i in (50, 51):
        texts[i] = texts[i][:80] + passage + texts[i][80:]
    rows = [(i, " ".join(t), "en", "s", len(" ".join(t))) for i, t in texts.items()] + [(70, None, None, None, None), (71, "", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, int(i < 20)) for i in range(40)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path), " ".join(passage)


def test_stages_by_hand(spark, folder):
    sf_dir, passage = folder
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), docs.schema)
        seen.append({r.doc_id: r for r in docs.collect()})
    toxic, copies, near, passages = seen
    assert set(toxic) == {*range(20, 60), 70, 71}
    assert set(toxic) - set(copies) == {40, 70}
    assert set(copies) - set(near) == {43}
    assert set(passages) == set(near)
    assert all(passage not in passages[i].text and passages[i].n_chars == len(passages[i].text) for i in (50, 51))
    assert all(passages[i].text == near[i].text for i in near if i not in (50, 51))
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).toPandas()
    assert set(packed.doc_id) == set(near) and packed.groupby("sequence_id").length.sum().max() <= 2048


def test_near_stage_goes_by_fingerprints(spark, docs):
    """Similar shingle sets do not decide: of texts that share 0.8 and more, those with far fingerprints stay; close ones go however few shingles they share."""
    draw = random.Random(12)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(6))
    texts = {}
    for _ in range(30):
        base = [word() for _ in range(90)]
        texts[len(texts)] = " ".join(base)
        texts[len(texts)] = " ".join(base + [word() for _ in range(12)])
    prints = {i: int.from_bytes(fingerprint(shingle_hashes(t, 3)), "big") for i, t in texts.items()}
    want = [i for i in texts if i % 2 == 0 or (prints[i] ^ prints[i - 1]).bit_count() > 5]
    assert 30 < len(want) < 60
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs(*texts.items()), "").collect()) == want


def test_intermediate_tables_go_with_their_stage(spark, folder):
    """Written stages leave nothing but their output; a frame that was not written keeps what it reads."""
    sf_dir, _ = folder
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = corpus_pipeline.drop_copies(spark, docs, sf_dir)
    lazy = set(common.written)
    near = corpus_pipeline.drop_near_copies(spark, docs, sf_dir)  # reads docs, which still read from the first stage
    assert near.count() == 59 and all(path_exists(spark, p) for p in lazy & set(common.written))
    path = f"{sf_dir}/near"
    near.write.parquet(path)
    of_stages = set(corpus_pipeline._earlier)
    corpus_pipeline.drop_toxic(spark, spark.read.parquet(path), sf_dir).write.parquet(f"{path}-clean")
    assert of_stages and not any(path_exists(spark, p) for p in of_stages)


def test_run_with_repeated_ids_and_empty_tables(spark, tmp_path):
    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, "a b c", "en", "s", 5), (1, "a b c", "en", "s", 5), (1, "other words", "en", "s", 11), (None, "no id", None, None, None)]
    for name, some in (("some", rows), ("none", [])):
        spark.createDataFrame(some, kinds).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
    got = corpus_pipeline.run(spark, f"{tmp_path}/some").toPandas()
    assert len(got) == 3 and sorted(got.doc_id.fillna(-1)) == [-1, 1, 1]
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_run(spark):
    got = corpus_pipeline.run(spark, SF).toPandas()
    assert len(got) and (np.sort(got[got.piece == 0].doc_id) == np.unique(got.doc_id)).all()

import random

import public_tokenizers
import pytest
import sentencepiece

from made_docs import docs  # noqa: F401
from tableferry.llm.pieces import PrefixTableBpe, encode_frame

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "   ", "a  b", " a\tb\n c ", "▁x▁▁", "é́", "a\0b c\0", "<s>x</s>", "<0x0A>", "😀 日本", "x" * 200, " " * 37 + "the", "...,,. a.b,c"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def table():
    return PrefixTableBpe(PATH)


def test_same_ids_and_texts_as_the_library(table, library):
    draw = random.Random(7)
    texts = ODD + ["".join(draw.choice("aabeht .,\n▁e é=1<0x>日本𠀀") for _ in range(draw.randint(0, 40))) for _ in range(2000)]
    for text in texts:
        ids = table.encode(text).tolist()
        assert ids == library.encode(text), text
        assert table.decode(ids) == library.decode(ids)


def test_decoding_of_loose_ids(table, library):
    for ids in ([0], [13362, 0], [1, 2, 260], [259, 300], [13, 300]):
        assert table.decode(ids) == library.decode(ids)


def test_frame_with_nulls_long_texts_and_clashing_columns(spark, docs, library):
    long = "word, another. " * 60_000
    got = {r.doc_id: r for r in encode_frame(docs((1, None), (2, ""), (3, long), (4, "ab"), (4, "ab"), (None, "c")), PATH, payload=("doc_id", "row")).collect()}
    assert got[1].ids == got[2].ids == [] and got[1].decoded == ""
    assert got[3].ids == library.encode(long) and got[3].decoded == long
    assert got[None].ids == library.encode("c")
    assert encode_frame(docs(), PATH).count() == 0

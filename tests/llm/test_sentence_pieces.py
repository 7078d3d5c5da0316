import random

import public_tokenizers
import pytest
import sentencepiece

from sieveline.llm import sentence_pieces
from sieveline.llm.common import sha256_hex

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def own():
    return sentence_pieces.PieceTable(MODEL, keep=50)


def odd_texts():
    pick = random.Random(7)
    alphabet = " ▁  \n\tabcthe inger.ñ\x00é漢🎉<0x0A></s><s><unk>​"
    texts = ["".join(pick.choice(alphabet) for _ in range(pick.randint(0, 70))) for _ in range(3000)]
    texts += [" " * n for n in range(70)] + ["a" + " " * n + "b" for n in range(70)]
    return texts + ["", "  leading", "trailing  ", "x" * 30_000, "ab " * 20_000]


def test_ids_and_text_equal_the_library(library, own):
    for text in odd_texts():
        ids = library.encode(text)
        assert own.encode(text) == ids
        assert own.decode(ids) == library.decode(ids)


def test_broken_byte_runs_decode_like_the_library(library, own):
    byte = [library.piece_to_id(f"<0x{b:02X}>") for b in (0xE2, 0x96, 0x41, 0xFF, 0xC3, 0xA9, 0xF0, 0x9F)]
    for ids in ([byte[0]], byte, [byte[4], byte[5]], [450, byte[0], byte[1], 450], [0, 1, 2, 450]):
        assert own.decode(ids) == library.decode(ids)


def test_operator_rows(spark, rows, library):
    data = [(1, "the cat", "x"), (1, "the cat", "x"), (2, None, None), (None, "", "y"), (3, "é漢\n", "z")]
    df = rows(data, "doc_id long, text string, n_tokens string")  # an extra column with a name of the digest
    got = sorted(map(tuple, sentence_pieces.encode_digest(df, MODEL).collect()), key=str)
    want = []
    for doc_id, text, _ in data:
        ids = library.encode(text or "")
        want.append((doc_id, len(ids), sha256_hex(",".join(map(str, ids)).encode()), sha256_hex(library.decode(ids).encode())))
    assert got == sorted(want, key=str)
    full = sentence_pieces.decode(sentence_pieces.encode(df, MODEL), MODEL)
    assert {(r.text or "", r.decoded) for r in full.collect()} == {(t or "", t or "") for _, t, _ in data}
    at_once = sentence_pieces.encode(df, MODEL, decoded="decoded")
    assert sorted(map(str, at_once.collect())) == sorted(map(str, full.collect()))
    with pytest.raises(ValueError):
        sentence_pieces.encode(df, MODEL, ids="text")


def test_empty_table(spark, rows):
    assert sentence_pieces.encode_digest(rows([], "doc_id long, text string"), MODEL).count() == 0

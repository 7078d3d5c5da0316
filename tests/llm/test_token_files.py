import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from sieveline.llm import token_files
from sieveline.llm.elias_fano import EliasFano
from test_sentence_pieces import odd_texts

MODEL = public_tokenizers.path("word_bpe_49k.json")


@given(st.lists(st.integers(-(2**40), 2**40), max_size=700))
@settings(max_examples=60, deadline=None)
def test_elias_fano_round_trip(values):
    values = sorted(values)
    stored, end = EliasFano.from_bytes(b"xy" + EliasFano.of(values).to_bytes(), 2)
    assert stored.values().tolist() == values
    assert [stored.select(k) for k in range(len(values))] == values
    for v in values[:5]:
        assert stored.first_at_least(v) == values.index(v)
    assert end == 2 + stored.n_bytes()


def test_space_is_near_minimal():
    values = np.cumsum(np.random.default_rng(1).integers(0, 1000, 50_000))
    bits = 8 * EliasFano.of(values).n_bytes() / len(values)
    assert bits < 2.3 + np.log2(values[-1] / len(values))


def test_pieces_between_spaces_equal_whole_texts():
    whole = Tokenizer.from_file(MODEL)
    own = token_files.WordIds(MODEL, keep=200)
    texts = odd_texts() + ["It's a Dog's LIFE we'll see", "<|endoftext|> a<|startoftext|>b", "é é ̈x  　 y", "a\x1cb\x85c", None, "<|StartOfText|> A. b, ß. 'S, it's. ÉT, É.", "J\u030c ΑΣ. x.", "ǅ, ŉ.", "l'. d'll, a've."]
    got = [np.frombuffer(b, own.kind).tolist() for b in own.encode(texts)]
    assert got == [whole.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_marks_after_every_code_point():
    whole, own = Tokenizer.from_file(MODEL), token_files.WordIds(MODEL)
    points = [chr(c) for c in range(0x21, 0x30000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 20_000):
        texts = [f"{c}. a{c}," for c in points[at : at + 20_000]]
        got = [np.frombuffer(b, own.kind).tolist() for b in own.encode(texts)]
        assert got == [e.ids for e in whole.encode_batch_fast(texts, add_special_tokens=False)]


@pytest.mark.parametrize("shards, block_ids", [(1, 1 << 20), (3, 40), (50, 1)])
def test_files_hold_the_corpus(spark, rows, tmp_path, shards, block_ids):
    pick = random.Random(3)
    texts = ["the quick brown fox", "", None, "idée " * 400, "the quick brown fox", "漢字 x"]
    data = [(i, pick.choice(texts), "x") for i in range(-5, 60)] + [(7, "the quick", "y"), (None, "null id", "z")]
    pick.shuffle(data)
    path = str(tmp_path / "ids")
    token_files.write(rows(data, "doc_id long, text string, shard string"), path, MODEL, shards=shards, block_ids=block_ids)
    whole = Tokenizer.from_file(MODEL)
    want, start = [], 0
    encoded = [(d, [*whole.encode(t or "", add_special_tokens=False).ids, 1]) for d, t, _ in data]
    for d, ids in sorted(encoded, key=lambda r: (r[0] is not None, r[0] or 0, np.array(r[1], "<u2").tobytes())):
        want.append((d, start, len(ids), ids))
        start += len(ids)
    got = sorted((tuple(r) for r in token_files.read(spark, path).collect()), key=lambda r: r[1])
    assert got == want
    digest = sorted((tuple(r) for r in token_files.read_digest(spark, path).collect()), key=lambda r: r[1])
    assert digest == [(d, s, n, zlib.crc32(np.array(ids, "<u4").tobytes())) for d, s, n, ids in want]
    assert sorted(r.ids for r in token_files.lookup(spark, path, 7).collect()) == sorted(ids for d, _, _, ids in want if d == 7)
    assert token_files.lookup(spark, path, 1000).count() == 0


def test_empty_table(spark, rows, tmp_path):
    path = str(tmp_path / "ids")
    token_files.write(rows([], "doc_id long, text string"), path, MODEL)
    assert token_files.read(spark, path).count() == 0

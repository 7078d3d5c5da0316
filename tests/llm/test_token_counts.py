import hashlib
import random
from functools import cache

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from sieveline.llm import token_counts
from test_sentence_pieces import odd_texts

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
MORE = ["<|endoftext|>", "a <|endoftext|> b", "<|ENDOFTEXT|>", "É", "É", "é", "é", "  two   spaces ", "it's we'LL", "\n\n x\t", "Ab", "ab"]


@cache
def loaded(file):
    return sentencepiece.SentencePieceProcessor(model_file=file) if file.endswith(".model") else Tokenizer.from_file(file)


def library(file, text):
    found = loaded(file).encode(text) if file.endswith(".model") else loaded(file).encode(text, add_special_tokens=False).ids
    return len(found)


@pytest.mark.parametrize("file", [BYTES, WORDS, PIECES])
def test_equals_the_library(spark, rows, tmp_path, file):
    texts = [*dict.fromkeys(odd_texts() + MORE), None, "", "", "same", "same"]
    data = [(i if i % 7 else None, t) for i, t in enumerate(texts)]
    store = str(tmp_path / "cache")
    want = sorted((d or -1, len((t or "").encode()), library(file, t or "")) for d, t in data)
    for _ in range(2):  # the second time from the cache
        got = token_counts.count(rows(data, "doc_id long, text string"), file, store).collect()
        assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in got) == want
        assert all(r.over_limit == (r.n_tokens > 1024) for r in got)


def stored_digests(spark, store, file):
    return [bytes(r.digest) for r in token_counts.cached(spark, store, token_counts.version(file)).collect()]


def test_only_distinct_misses_are_encoded(spark, rows, tmp_path):
    store, schema = str(tmp_path / "cache"), "doc_id long, text string"
    first = [(i, "copy") for i in range(50)] + [(None, "copy"), (1, "other"), (2, None), (3, "")]
    token_counts.count(rows(first, schema), BYTES, store).collect()
    assert sorted(stored_digests(spark, store, BYTES)) == sorted(hashlib.sha256(t.encode()).digest() for t in ("copy", "other", ""))
    got = token_counts.count(rows([(7, "copy"), (8, "new"), (9, "new")], schema), BYTES, store).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in got) == [(7, library(BYTES, "copy")), (8, library(BYTES, "new")), (9, library(BYTES, "new"))]
    assert len(stored_digests(spark, store, BYTES)) == 4
    token_counts.count(rows([(7, "copy"), (8, "new")], schema), BYTES, store).collect()
    assert len(list((tmp_path / "cache").glob("version=*/run=*"))) == 2
    token_counts.count(rows([(7, "copy")], schema), PIECES, store).collect()  # another tokenizer, its own counts
    assert len(list((tmp_path / "cache").glob("version=*"))) == 2


def test_stored_counts_are_used(spark, rows, tmp_path):
    store, schema = str(tmp_path / "cache"), "doc_id long, text string"
    planted = rows([(bytearray(hashlib.sha256(b"copy").digest()), 4711)], "digest binary, n_tokens long")
    for run in ("a", "b"):  # two runs at the same time stored the same
        planted.write.parquet(f"{store}/version={token_counts.version(BYTES)}/run={run}")
    got = token_counts.count(rows([(1, "copy"), (2, "x")], schema), BYTES, store).collect()
    assert sorted((r.doc_id, r.n_tokens, r.over_limit) for r in got) == [(1, 4711, True), (2, 1, False)]


def test_rows_that_come_in_another_order(spark, rows, tmp_path):
    from pyspark.sql import functions as F

    data = [(i, f"text number {i} of some") for i in range(400)]
    df = rows(data, "doc_id long, text string").repartition(7).orderBy(F.rand())  # another order at each reading
    got = token_counts.count(df, BYTES, str(tmp_path / "cache")).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in got) == [(i, library(BYTES, t)) for i, t in data]


def test_normalised_contents_share_an_entry(spark, rows, tmp_path):
    store = str(tmp_path / "cache")
    data = [(1, "A  b É"), (2, "a b é"), (3, "a b É"), (4, "<|endoftext|>"), (5, "<|ENDOFTEXT|>")]
    got = {r.doc_id: r.n_tokens for r in token_counts.count(rows(data, "doc_id long, text string"), WORDS, store).collect()}
    assert got == {d: library(WORDS, t) for d, t in data}
    assert len(stored_digests(spark, store, WORDS)) == 3


@pytest.mark.parametrize("file", [BYTES, PIECES])
def test_long_texts_are_cut_where_no_token_crosses(monkeypatch, file):
    monkeypatch.setattr(token_counts, "LONG", 20)
    counter = token_counts._make(file)
    for text in [*odd_texts(), "it's a long line of words with  two spaces and 123 456 numbers, we'll see <|endoftext|> so\n what " * 9, "x" * 500, "a b" * 100]:
        pieces = counter.pieces(text)
        assert sum(counter.lengths(pieces)) == library(file, text)
    assert len(counter.pieces("some words " * 50)) > 10


def test_texts_count_as_their_words(monkeypatch):
    monkeypatch.setattr(token_counts, "KEEP", 50)
    monkeypatch.setattr(token_counts, "KEEP_LENGTH", 6)
    counter = token_counts._make(BYTES)
    pick = random.Random(5)
    parts = ["word", "longerword", "a", ".", ",", "x.", "don't", "we'll,", "12", "3.4", "é", "É.", "İ.", "क़.", "漢字,", " ", "  ", "\n", "\t", "\u00a0", "\u3000", "\x1c", "\x85", "<|endoftext|>", "'s", "ab,c."]
    for _ in range(3000):
        text = pick.choice(["", " "]).join(pick.choices(parts, k=pick.randrange(1, 12)))
        assert counter.lengths([text]) == [library(BYTES, text)], repr(text)
    words = ("".join(f"a {chr(c)}. {chr(c)}, x{chr(c)} {chr(c)}x" for c in range(a, a + 64)) for a in range(0x20, 0x3000, 64))
    for text in words:
        assert counter.lengths([text]) == [library(BYTES, text)], repr(text)


def test_very_long_text(spark, rows, tmp_path):
    text = "lorem ipsum dolor sit amet 12 " * 120_000  # 3.6 MB
    got = token_counts.count(rows([(1, text)], "doc_id long, text string"), BYTES, str(tmp_path / "c")).first()
    assert (got.n_bytes, got.n_tokens) == (len(text), 120_000 * 9 + 1) or got.n_tokens == library(BYTES, text)


def test_other_columns_and_empty_tables(spark, rows, tmp_path):
    store = str(tmp_path / "cache")
    got = token_counts.count(rows([(1, "a b", 5, "x")], "digest long, text string, row int, `a.b` string"), BYTES, store)
    assert got.columns == ["digest", "row", "a.b", "n_bytes", "n_tokens", "over_limit"] and tuple(got.first()) == (1, 5, "x", 3, 2, False)
    with pytest.raises(ValueError):
        token_counts.count(rows([(1, "a")], "n_bytes long, text string"), BYTES, store)
    assert token_counts.count(rows([("a b",)], "text string"), BYTES, store).collect()[0].n_tokens == 2
    assert token_counts.count(rows([], "doc_id long, text string"), BYTES, store).count() == 0
    assert token_counts.count(rows([], "doc_id long, text string"), BYTES, str(tmp_path / "none")).count() == 0


def test_words_of_an_earlier_run_are_let_go():
    counter = token_counts._make(BYTES)
    counter.begin("one")
    text = "some words of the first run"
    first = counter.lengths([text])
    counter.begin("one")  # its next task
    assert len(counter.words) > 0
    counter.begin("two")
    assert len(counter.words) == 0
    assert counter.lengths([text]) == first == [library(BYTES, text)]


def test_a_worker_starts_each_run_without_words(spark, rows, tmp_path):
    begun = []
    for k in range(2):
        encoded = token_counts._encoded(rows([(bytearray(b"d"), f"word {k}")], "digest binary, text string"), BYTES)
        begun.append([r.n_tokens for r in encoded.collect()])
    assert begun == [[library(BYTES, f"word {k}")] for k in range(2)]

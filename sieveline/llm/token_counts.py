"""Token counts of a corpus with a digest cache.

A row's content is normalised as its tokenizer would do it and digested (SHA-256); the tokenizer's version is
a digest of its file and library. Counts are kept under both: a run joins its distinct digests to
the stored counts, encodes only what has none, each content once however many rows hold it, and
appends what it found. A second run over the same texts encodes nothing; another tokenizer
or library version starts its own part of the cache.

Cache layout: ``<cache>/version=<digest>/run=<id>/*.parquet`` with (digest binary, n_tokens long). A run
writes one directory, committed as a whole, so a lost executor or an aborted run leaves no half
of one. Runs at the same time may store a digest twice, always with the same count; readers
take one.

Of each content without a count the first row is encoded where it is read; texts are not moved unless there are too many
of them for a broadcast of their places, and then once. Should a source give its rows in another order when it is read
again, what was missed is found by its content. Digests of a frequent text are joined without an aggregation behind
the shuffle, so adaptive execution can split them.

Row rules: null text counts as empty (no bytes, no tokens); repeated rows and equal or null ids
are rows of their own; all columns but the text stay, whatever their names, unless one is
named like a result, which raises. Texts beyond ``LONG`` characters are encoded in pieces, cut where
no token can cross: a letter, one space, a letter. Tokenizers for which that is not certain get whole
texts. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import islice
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sieveline.llm.common import give_back, in_chunks, per_worker, stored
from sieveline.sources.snapshots import exists

LONG = 1 << 20  # characters
KEEP, KEEP_LENGTH = 500_000, 48  # words, and characters of a word, that a worker keeps the counts of
SMALL_SIDE = 300_000  # contents that may be broadcast: 40 bytes each
COUNTS = "digest binary, n_tokens long"
RESULTS = ("n_bytes", "n_tokens", "over_limit")
_BORDER = re.compile("[A-Za-z](?= [A-Za-z])")
_WORDS = re.compile(r"(?<=\S)(?=[ \n]\S)")
_ODD_BLANKS = re.compile(r"[^\S \n]|[ \n][ \n]")  # white space of other kinds, or more than one in a row


class JsonCounter:
    """Counts by the tokenizers library (``.json`` files)."""

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.normalizer = self.tokenizer.normalizer
        before = self.tokenizer.pre_tokenizer
        plain = all(" " not in t.content and not (t.lstrip or t.rstrip or t.single_word) for t in self.tokenizer.get_added_tokens_decoder().values())
        # The byte-level pattern ends a token between a letter and a space and starts the next one with that space.
        self.cuts = plain and self.normalizer is None and type(before).__name__ == "ByteLevel" and before.use_regex and not before.add_prefix_space
        self.words = WordCounts(self.whole) if self.cuts else None
        self.run = ""

    def content(self, text: str) -> bytes:
        """What decides the count: the normalised text, or the text itself where it spells out an added token."""
        if self.normalizer is None:
            return text.encode()
        if any(a in text for a in self.added):
            return b"\xff" + text.encode()  # no normalised text starts so
        return self.normalizer.normalize_str(text).encode()

    def pieces(self, text: str) -> list[str]:
        return list(_pieces(text, 0)) if self.cuts else [text]

    def lengths(self, texts: list[str]) -> list[int]:
        if not self.cuts:
            return self.whole(texts)
        return self.words.counts(texts)

    def begin(self, run: str) -> None:
        """Words of an earlier run go: a worker that is used again would hold them beside those of its next texts."""
        if self.words is not None and self.run != run:
            self.words.clear()
            give_back()
        self.run = run

    def whole(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class WordCounts(dict):
    """Counts of words with the blank before them, for byte-level tokenizers. When full, the older half goes.

    A single space between two characters that are no white space belongs to the token behind it, a single line feed
    is one of its own. So a text is cut before them, and a point or comma behind a letter is counted apart:
    whole texts count as their words do (tested). Words are kept without their space, but with their line feed.
    """

    def __init__(self, whole: Callable[[list[str]], list[int]]):
        super().__init__()
        self.whole = whole
        word, *marked = whole([" a", " a.", " a,"])
        self.marks = word == 1 and marked == [2, 2]

    def _split(self, text: str) -> tuple[str, list[str]]:
        """The start of the text up to the first cut, and the words behind it."""
        if _ODD_BLANKS.search(text) is None and text[0] not in " \n" and text[-1] not in " \n":
            first, *words = text.replace("\n", " \n").split(" ")
            return first, words
        first, *words = _WORDS.split(text)
        return first, [w[1:] if w[0] == " " else w for w in words]

    @staticmethod
    def _shown(words: list[str]) -> list[str]:
        return [w if w[0] == "\n" else " " + w for w in words]

    def learn(self, words: list[str]) -> None:
        if len(self) + len(words) > KEEP:
            late = dict(islice(self.items(), len(self) // 2, None))
            self.clear()
            self.update(late)
        for at in range(0, len(words), 5_000):
            some = words[at : at + 5_000]
            self.update(zip(some, self.whole(self._shown(some)), strict=True))

    def __missing__(self, word: str) -> int:
        return self.whole(self._shown([word]))[0]  # a long one, or one that has just gone

    def counts(self, texts: list[str]) -> list[int]:
        split = [self._split(t) if t else ("", []) for t in texts]
        new = {w for w in set().union(*(words for _, words in split)).difference(self) if len(w) <= KEEP_LENGTH}
        marked = {w for w in new if self.marks and w[-1] in ".," and w.isascii() and w[:-1].isalpha()}
        self.learn(list((new - marked) | {w[:-1] for w in marked if w[:-1] not in self}))
        self.update([(w, self[w[:-1]] + 1) for w in marked])
        firsts = self.whole([first for first, _ in split])
        return [n + sum(map(self.__getitem__, words)) for n, (_, words) in zip(firsts, split, strict=True)]


class PieceCounter:
    """Counts by the sentencepiece library (``.model`` files)."""

    def __init__(self, file: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.processor = sentencepiece.SentencePieceProcessor(model_file=file)
        model = pb.ModelProto()
        model.ParseFromString(Path(file).read_bytes())
        norm = model.normalizer_spec
        self.normalizes = bool(norm.precompiled_charsmap) or norm.remove_extra_whitespaces
        spanning = any("▁" in p.piece.lstrip("▁") for p in model.pieces)
        # The mark that a text gets in front stands for the space that the cut takes away.
        self.cuts = norm.add_dummy_prefix and norm.escape_whitespaces and not self.normalizes and not spanning

    def content(self, text: str) -> bytes:
        return (self.processor.Normalize(text) if self.normalizes else text).encode()

    def pieces(self, text: str) -> list[str]:
        return list(_pieces(text, 1)) if self.cuts else [text]

    def begin(self, run: str) -> None:
        """Nothing is kept between runs."""

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.processor.encode(texts, num_threads=1)]


def _pieces(text: str, skip: int) -> Iterator[str]:
    """The text in pieces of about ``LONG`` characters; ``skip`` characters are left out at each cut."""
    at = 0
    while len(text) - at > LONG:
        border = _BORDER.search(text, at + LONG)
        if border is None:
            break
        yield text[at : border.end()]
        at = border.end() + skip
    yield text[at:] if at else text


def _make(file: str) -> JsonCounter | PieceCounter:
    return PieceCounter(file) if file.endswith(".model") else JsonCounter(file)


_counter = per_worker(_make)


def version(tokenizer_file: str) -> str:
    """Digest of the file's bytes and of the library that reads it."""
    if tokenizer_file.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    name = f"{library.__name__} {library.__version__}\n".encode()
    return hashlib.sha256(name + Path(tokenizer_file).read_bytes()).hexdigest()


def _digested(df: DataFrame, text: str, tokenizer_file: str, others: list[Column]) -> DataFrame:
    """``others``, ``text`` (empty for null) and ``digest``; inside the JVM where the tokenizer does not normalise."""
    rows = df.select(*others, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    counter = _counter(tokenizer_file)
    normalizes = counter.normalizer is not None if isinstance(counter, JsonCounter) else counter.normalizes
    if not normalizes:
        return rows.withColumn("digest", F.unhex(F.sha2("text", 256)))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer_file)
        for batch in batches:
            for part in in_chunks(batch, "text"):
                keys = [hashlib.sha256(counter.content(t)).digest() for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(keys, pa.binary())], names=[*part.schema.names, "digest"])

    return rows.mapInArrow(digest, rows.withColumn("digest", F.lit(None).cast("binary")).schema)


def _encoded(contents: DataFrame, tokenizer_file: str) -> DataFrame:
    """(digest, n_tokens) of (digest, text)."""
    of_run = uuid.uuid4().hex

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer_file)
        counter.begin(of_run)
        for batch in batches:
            give_back()
            for part in in_chunks(batch, "text", 1 << 20):
                found, held, size = np.zeros(part.num_rows, np.int64), [], 0
                owners: list[int] = []
                for row, text in enumerate(part.column("text").to_pylist()):
                    for piece in counter.pieces(text):
                        held.append(piece)
                        owners.append(row)
                        size += len(piece)
                        if size >= LONG:
                            np.add.at(found, owners, counter.lengths(held))
                            held, owners, size = [], [], 0
                if held:
                    np.add.at(found, owners, counter.lengths(held))
                yield pa.RecordBatch.from_arrays([part.column("digest"), pa.array(found)], names=["digest", "n_tokens"])

    return contents.select("digest", "text").mapInArrow(encode, COUNTS)


def cached(spark: SparkSession, cache: str, of_version: str) -> DataFrame | None:
    """Stored (digest, n_tokens) of one version, perhaps with repeats; None where there is none yet."""
    path = f"{cache}/version={of_version}"
    return spark.read.schema(COUNTS).parquet(path) if exists(spark, path) else None


def _append(texts: DataFrame, tokenizer_file: str, cache: str, of_version: str) -> DataFrame:
    """Encodes (digest, text), stores the counts as one run and reads them back."""
    run = f"{cache}/version={of_version}/run={uuid.uuid4().hex}"
    _encoded(texts, tokenizer_file).write.parquet(run)
    return texts.sparkSession.read.schema(COUNTS).parquet(run)


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(SMALL_SIDE + 1).count() <= SMALL_SIDE else df


def count(df: DataFrame, tokenizer_file: str, cache: str, text: str = "text", limit: int = 1024) -> DataFrame:
    """The rows of ``df`` without their text, with n_bytes (UTF-8), n_tokens and whether that is over ``limit``.

    Encodes what ``cache`` (a folder that every executor reaches) has no count for, and appends it there.
    """
    spark = df.sparkSession
    others = [c for c in df.columns if c != text]
    if clash := set(others) & set(RESULTS):
        raise ValueError(f"columns {sorted(clash)} exist already; rename or drop them")
    packed = F.struct(*[F.col(f"`{c}`") for c in others]).alias("row") if others else F.lit(None).cast("string").alias("row")
    of_version = version(tokenizer_file)
    place = F.monotonically_increasing_id().alias("place")
    keyed = _digested(df, text, tokenizer_file, [packed, place]).select("row", "place", F.octet_length("text").cast("long").alias("n_bytes"), "digest")
    keyed = stored(keyed, "digests")

    firsts = keyed.groupBy("digest").agg(F.min("place").alias("place"))
    known = cached(spark, cache, of_version)
    counts = []
    if known is not None:
        known = known.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))
        firsts = stored(firsts.join(known, "digest", "left"), "wanted")
        counts.append(firsts.where("n_tokens is not null").select("digest", "n_tokens"))
        firsts = firsts.where("n_tokens is null").select("digest", "place")
    misses = stored(firsts, "misses")
    if misses.limit(1).count():
        # The first row of each content is taken where it is read. The digest shows whether it is the row it was.
        wanted = misses.withColumnRenamed("digest", "_digest")
        texts = _digested(df, text, tokenizer_file, [place]).join(_few(wanted), "place").where("digest = _digest")
        counts.append(_append(texts, tokenizer_file, cache, of_version))
        lost = misses.join(counts[-1], "digest", "left_anti")
        if lost.limit(1).count():  # a source whose rows come in another order each time: by content then
            texts = _digested(df, text, tokenizer_file, []).join(_few(lost.select("digest")), "digest", "left_semi").dropDuplicates(["digest"])
            counts.append(_append(texts, tokenizer_file, cache, of_version))
    counts = reduce(DataFrame.unionByName, counts) if counts else spark.createDataFrame([], COUNTS)
    found = keyed.join(counts, "digest", "left")
    results = [F.col("n_bytes"), F.col("n_tokens"), (F.col("n_tokens") > limit).alias("over_limit")]
    return found.select(*([F.col("row").getField(c).alias(c) for c in others]), *results)

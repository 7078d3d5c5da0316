"""Token ids of a corpus as binary blocks with Elias-Fano encoded document boundaries.

The corpus is one concatenated array of ids in ascending doc_id order. It is cut into
shards by doc_id ranges (one Spark partition each) and a shard into blocks of bounded size,
each holding whole documents:

    magic, id width, doc_ids (Elias-Fano), boundaries (Elias-Fano, one more than documents), ids

Ids take two bytes where the vocabulary allows it. ``select`` on the boundaries gives a
document's offset and length. A written set is a folder of Parquet files with one row per block
(shard, block number, first and last doc_id, counts, ids before the block in its shard, the
block's bytes), so Spark's writers commit it and any store Spark reaches can hold it.

Row rules: null and empty texts have only the end id; a null doc_id sorts first, before all
others; rows with equal doc_id follow one another in the order of their ids; other
columns of the input are not written. An empty table gives an empty set.
"""

from __future__ import annotations

import os
import struct
import zlib
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from sieveline.llm.common import per_worker
from sieveline.llm.elias_fano import EliasFano

MAGIC = b"SLT1"
_HEAD = struct.Struct("<4sBI")  # magic, bytes of an id, documents with a null doc_id
BLOCKS = "shard int, block int, first_id long, last_id long, n_docs long, n_ids long, before long, bytes binary"


# ---- encoding -----------------------------------------------------------------------------


class WordIds(dict):
    """Ids, as bytes, of text between white space. When full, the older half goes: memory is bounded.

    The tokenizer cuts at white space first, and letters from signs, so the pieces between plain spaces and
    line feeds can be encoded one by one, and a word of ASCII letters apart from the mark at its end (other letters
    may come apart when normalised, and their last part then joins the mark; tested against whole texts). Since it lower-cases, Latin-1 texts are lower-cased before the look-up.
    """

    def __init__(self, tokenizer_file: str, keep: int = 1_200_000, keep_length: int = 48):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; a pool of threads would only spin
        super().__init__()
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = f"<u{self.width}"
        self.keep, self.keep_length = keep, keep_length
        probe = ("Ab", "ab", "a.", "a", ".")
        upper, lower, both, word, mark = (f.ids for f in self.tokenizer.encode_batch(list(probe), add_special_tokens=False))
        self.lowers, self.cuts = upper == lower, both == word + mark

    def _pack(self, ids: list[int]) -> bytes:
        return array("H" if self.width == 2 else "I", ids).tobytes()  # little-endian on every platform Spark runs on

    def learn(self, words: list[str]) -> None:
        if len(self) + len(words) > self.keep:
            late = dict(islice(self.items(), len(self) // 2, None))
            self.clear()
            self.update(late)
        for at in range(0, len(words), 5_000):
            some = words[at : at + 5_000]
            found = self.tokenizer.encode_batch_fast(some, add_special_tokens=False)
            self.update((word, self._pack(f.ids)) for word, f in zip(some, found, strict=True))

    def __missing__(self, word: str) -> bytes:
        return self._pack(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def _split(self, text: str | None) -> list[str]:
        if not text:
            return []
        if self.lowers and not any(map(text.__contains__, ("<|", *self.special))):
            try:
                text.encode("latin-1")
                text = text.lower()
            except UnicodeEncodeError:
                pass
        return text.replace("\n", " ").split(" ")

    def encode(self, texts: list[str | None]) -> list[bytes]:
        split = [self._split(t) for t in texts]
        found = [list(map(self.get, words)) for words in split]  # one look-up a word
        holes = [k for k, ids in enumerate(found) if None in ids]
        new = {w for k in holes for w, ids in zip(split[k], found[k], strict=True) if ids is None}
        if new:
            marked = {w for w in new if self.cuts and 1 < len(w) <= self.keep_length and w[-1] in ".," and w.isascii() and w[:-1].isalpha()}
            plain = {w for w in new - marked if len(w) <= self.keep_length}
            plain.update(b for w in marked for b in (w[:-1], w[-1]) if b not in self)
            self.learn(list(plain))
            self.update((w, self[w[:-1]] + self[w[-1]]) for w in marked)
            for k in holes:
                found[k] = [self[w] if ids is None else ids for w, ids in zip(split[k], found[k], strict=True)]
        return [b"".join(ids) for ids in found]


_words = per_worker(WordIds)


def _bounds(df: DataFrame, doc_id: str, shards: int) -> np.ndarray:
    """Upper doc_id of each shard but the last, from one pass over the doc_id column."""
    found = df.agg(F.percentile_approx(doc_id, [i / shards for i in range(1, shards)], 10 * shards)).first()[0] if shards > 1 else None
    return np.unique(np.array(found or [], dtype=np.int64))


def write(
    df: DataFrame,
    path: str,
    tokenizer_file: str,
    end_id: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
    shards: int | None = None,
    block_ids: int = 1 << 20,
) -> None:
    """Encodes ``text`` of all rows, appends ``end_id`` to each and writes the blocks to ``path``.

    ``shards``: doc_id ranges, one per shuffle partition unless given. Texts are encoded before the shuffle,
    which then moves two bytes an id.
    """
    spark = df.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    bounds = _bounds(rows, "doc_id", shards)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(tokenizer_file)
        end = np.array([end_id], words.kind).tobytes()
        for batch in batches:
            for part in range(0, batch.num_rows, 500):
                some = batch.slice(part, 500)
                ids = [found + end for found in words.encode(some.column(1).to_pylist())]
                key = np.asarray(some.column(0).fill_null(np.iinfo(np.int64).min), dtype=np.int64)
                shard = np.searchsorted(bounds, key, side="left").astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard), some.column(0), pa.array(ids, pa.binary())], names=["shard", "doc_id", "ids"]
                )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = _words(tokenizer_file).width
        shard, number, before = None, 0, 0
        doc_ids: list[int | None] = []
        parts: list[bytes] = []
        held = 0

        def block():
            nonlocal number, before, held
            row = _block_row(shard, number, before, doc_ids, parts, width)
            number, before, held = number + 1, before + held, 0
            doc_ids.clear()
            parts.clear()
            return row

        for batch in batches:
            for s, d, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n = len(ids) // width
                if doc_ids and (s != shard or held + n > block_ids):
                    yield block()
                if s != shard:
                    shard, number, before = s, 0, 0
                doc_ids.append(d)
                parts.append(ids)
                held += n
        if doc_ids:
            yield block()

    (
        rows.mapInArrow(encode, "shard int, doc_id long, ids binary")
        .repartitionById(len(bounds) + 1, F.col("shard"))
        .sortWithinPartitions("doc_id", "ids")
        .mapInArrow(blocks, BLOCKS)
        .write.parquet(path)
    )


def _block_row(shard: int, number: int, before: int, doc_ids: list[int | None], parts: list[bytes], width: int) -> pa.RecordBatch:
    nulls = sum(d is None for d in doc_ids)
    named = np.array(doc_ids[nulls:], dtype=np.int64)
    ends = np.cumsum([0, *(len(p) // width for p in parts)])
    data = _HEAD.pack(MAGIC, width, nulls) + EliasFano.of(named).to_bytes() + EliasFano.of(ends).to_bytes() + b"".join(parts)
    first, last = (int(named[0]), int(named[-1])) if len(named) else (None, None)
    values = [shard, number, first, last, len(doc_ids), int(ends[-1]), before, data]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    names = [f.split()[0] for f in BLOCKS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names)


# ---- reading --------------------------------------------------------------------------------


class Block:
    """One block's bytes: documents by place, offsets by select."""

    def __init__(self, data: bytes):
        magic, width, self.nulls = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token block")
        self.doc_ids, at = EliasFano.from_bytes(data, _HEAD.size)
        self.ends, at = EliasFano.from_bytes(data, at)
        self.ids = np.frombuffer(data, f"<u{width}", offset=at)

    def __len__(self) -> int:
        return self.nulls + self.doc_ids.n

    def document(self, place: int) -> np.ndarray:
        return self.ids[self.ends.select(place) : self.ends.select(place + 1)]

    def places(self, doc_id: int) -> range:
        """Places of the documents with this id."""
        return range(self.nulls + self.doc_ids.first_at_least(doc_id), self.nulls + self.doc_ids.first_at_least(doc_id + 1))


def _with_start(spark: SparkSession, path: str) -> DataFrame:
    """Blocks with ``start``, the ids of the whole corpus before the block.

    The driver sees one total per shard.
    """
    found = spark.read.schema(BLOCKS).parquet(path)
    totals = found.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()
    starts, so_far = [], 0
    for shard, n in totals:
        starts.append((shard, so_far))
        so_far += n
    of_shard = spark.createDataFrame(starts, "shard int, shard_start long")
    return found.join(of_shard, "shard").withColumn("start", F.col("shard_start") + F.col("before"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: doc_id, start (in the concatenated array), n_tokens, ids."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for start, place, ids in _documents(batches):
            yield pa.RecordBatch.from_arrays(
                [place, pa.array(start[:-1]), pa.array(np.diff(start)), pa.ListArray.from_arrays(pa.array((start - start[0]).astype(np.int32)), pa.array(ids.astype(np.int32)))],
                names=["doc_id", "start", "n_tokens", "ids"],
            )

    return _with_start(spark, path).select("start", "bytes").mapInArrow(documents, "doc_id long, start long, n_tokens long, ids array<int>")


def read_digest(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: doc_id, start, n_tokens and the crc32 of its ids as 32-bit integers."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for start, doc_ids, ids in _documents(batches):
            raw = memoryview(ids.astype("<u4").tobytes())
            cuts = 4 * (start - start[0])
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [doc_ids, pa.array(start[:-1]), pa.array(np.diff(start)), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return _with_start(spark, path).select("start", "bytes").mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray]]:
    """For each block: global boundaries, doc_ids, ids."""
    for batch in batches:
        for start, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            block = Block(data.as_buffer())
            doc_ids = pa.concat_arrays([pa.nulls(block.nulls, pa.int64()), pa.array(block.doc_ids.values())])
            yield start + block.ends.values(), doc_ids, block.ids


def lookup(spark: SparkSession, path: str, doc_id: int) -> DataFrame:
    """The ids of one document: only blocks whose range holds it are read, only its ids are decoded."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                block = Block(data.as_buffer())
                found = [block.document(p).astype(np.int32) for p in block.places(doc_id)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id] * len(found), pa.int64()), pa.array([list(f) for f in found], pa.list_(pa.int32()))],
                    names=["doc_id", "ids"],
                )

    blocks = spark.read.schema(BLOCKS).parquet(path).where((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id))
    return blocks.select("bytes").mapInArrow(find, "doc_id long, ids array<int>")

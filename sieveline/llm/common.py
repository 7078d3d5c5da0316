"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import hashlib
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession

import sieveline
from sieveline.session import scratch_dir
from sieveline.sources.snapshots import remove


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_BYTES = 4 << 20  # of a batch that goes from Spark to a Python worker

_shipped: set[str] = set()
_stored_at: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, as ``--py-files`` would; once for each application."""
    context = spark.sparkContext
    # A batch is held several times over, in the JVM and in the worker: texts go over in a few MB, short rows as before.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    package = Path(sieveline.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="sieveline-code-")) / "sieveline_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    Cuts the lineage: the files survive a lost executor, and what is expensive to make
    (whole-text passes) is made once although several later steps read it. The shuffle files of the write
    go with it; else they stay until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    kept = spark.read.schema(df.schema).parquet(path)
    _stored_at[kept] = path
    return kept


def discard(*kept: DataFrame) -> None:
    """Deletes the files of frames that ``stored`` returned; nothing may read them any more."""
    for df in kept:
        if path := _stored_at.pop(df, None):
            remove(df.sparkSession, path)


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def refuse(keep: Iterable[str], taken: Iterable[str]) -> None:
    """Raises where a column to be kept has the name of one that the operator makes."""
    own = {t.lower() for t in taken}
    if clash := sorted(k for k in keep if k.lower() in own):
        raise ValueError(f"columns {clash} have names that the operator uses; rename them")


def byte_offsets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of an Arrow array as one UTF-8 buffer, and where each starts and ends.

    Nulls count as empty.
    """
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1].copy()
    data = texts.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    whole = whole[offsets[0] : offsets[-1]]
    offsets -= offsets[0]
    if texts.null_count:
        lengths = np.diff(offsets)
        dead = np.asarray(texts.is_null())
        if lengths[dead].any():  # a null slot may hold bytes
            keep = np.repeat(~dead, lengths)
            whole = whole[keep]
            lengths = np.where(dead, 0, lengths)
            offsets = np.concatenate([[0], np.cumsum(lengths)])
    return whole, offsets


def in_chunks(batch: pa.RecordBatch, column: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about ``most_bytes`` of text each, one row at least."""
    at = batch.schema.get_field_index(column)
    lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(at)), 0), dtype=np.int64)
    ends = np.cumsum(lengths)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


_made: list[dict] = []
_makers: dict[Callable, Callable] = {}


class _PerWorker:
    """Goes to a worker as its maker only: with what the driver made, each task would get a copy of its own, to be made
    and learned anew, that stays until garbage is collected."""

    def __init__(self, make: Callable):
        self.make, self.made = make, {}
        _made.append(self.made)

    def __call__(self, *key):
        if key not in self.made:
            self.made[key] = self.make(*key)
        return self.made[key]

    def __reduce__(self):
        return per_worker, (self.make,)


def per_worker(make: Callable) -> Callable:
    """``make`` called once in each Python worker, for models and tokenizers; the same for each call with one ``make``."""
    if make not in _makers:
        _makers[make] = _PerWorker(make)
    return _makers[make]


_kept: dict = {}


def kept_for(token: str, make: Callable):
    """``make()`` of the latest ``token``, kept by this Python worker between tasks of one job."""
    if token not in _kept:
        release()
        _kept[token] = make()
    return _kept[token]


def release() -> None:
    """Frees the models and tables that earlier stages left in this Python worker, and gives the memory back.

    Workers are used again by later stages; one that holds much itself calls this first.
    """
    if not _kept and not any(_made):
        return
    for made in (_kept, *_made):
        made.clear()
    gc.collect()
    give_back()


def give_back() -> None:
    """Gives freed memory back to the system: a worker that waits for its next task keeps it otherwise."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # the C library's own call, where there is one
        ctypes.CDLL(None).malloc_trim(0)


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()

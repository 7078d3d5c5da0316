"""What a Python worker holds at a time."""

import os
import time

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sieveline.llm import common, token_counts

BYTES = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture
def own_settings(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    yield
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", before)


def test_texts_come_to_workers_in_small_batches(spark, own_settings):
    common.ship(spark)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], names=["size", "n"])

    texts = spark.range(6000, numPartitions=1).select(F.repeat(F.lit("word "), 800).alias("text"))
    got = texts.mapInArrow(sizes, "size long, n long").collect()
    assert sum(r.n for r in got) == 6000
    assert max(r.size for r in got) <= 2 * common.BATCH_BYTES


def test_a_new_model_frees_what_earlier_stages_kept():
    earlier = common.per_worker(lambda name: [name])
    first = earlier("tokenizer")
    common.kept_for("one", dict)
    assert earlier("tokenizer") is not first
    kept = common.kept_for("one", dict)
    assert common.kept_for("one", dict) is kept
    common.release()


def test_a_worker_keeps_its_model_between_tasks(spark):
    from pyspark import cloudpickle

    token_counts._counter(BYTES)  # the driver has one too; it does not go with the task

    def task(batches):
        for _ in batches:  # a worker that leaves rows unread is not used again
            pass
        yield pa.RecordBatch.from_arrays([pa.array([id(token_counts._counter(BYTES))]), pa.array([os.getpid()])], names=["model", "worker"])

    assert len(cloudpickle.dumps(token_counts._counter)) < 1_000
    rows = [r for _ in range(3) for r in spark.range(0, 8, 1, 8).mapInArrow(task, "model long, worker long").collect()]
    assert len({(r.model, r.worker) for r in rows}) == len({r.worker for r in rows}) < len(rows)


def shuffle_files(spark) -> int:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return files.mkString("\n").count("shuffle_")


def test_a_stored_step_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    setting = spark.conf.get(common.CLEANUP, None)
    df = spark.range(5000).groupBy((F.col("id") % 700).alias("k")).count()
    kept = common.stored(df, "test-cleanup")
    for _ in range(50):  # files go shortly after the write
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.2)
    assert shuffle_files(spark) <= before
    assert spark.conf.get(common.CLEANUP, None) == setting
    assert kept.count() == 700


def test_discarded_steps_are_gone_from_the_shared_folder(spark):
    kept = common.stored(spark.range(10), "test-discard")
    path = kept.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
    assert os.path.exists(path)
    common.discard(kept)
    assert not os.path.exists(path)
    common.discard(kept, spark.range(3))  # nothing to do

"""What Python workers and the JVM hold of a partition of texts does not grow with the partition."""

import random
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orderwake.llm.common import BATCH_BYTES, map_texts
from orderwake.llm.decontaminate import contamination, decontaminate
from orderwake.llm.pieces import default_model, encode_batch, vocabulary
from orderwake.llm.quality_crf import line_features

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def spark_limit(spark):
    """Spark's own limit on Arrow batches, which a session starts with."""
    before = spark.conf.get(LIMIT)
    spark.conf.set(LIMIT, str(64 << 20))
    yield spark
    spark.conf.set(LIMIT, before)


def test_a_partition_of_texts_is_many_batches(spark_limit):
    def whole(piece):
        """Rows of the piece, and bytes of the text buffer of the batch that it is cut from."""
        return pa.RecordBatch.from_arrays([pa.array([piece.num_rows]), pa.array([piece.column(0).buffers()[2].size])], ["n", "size"])

    docs = spark_limit.range(0, 3000, 1, 1).select(F.repeat(F.lit("word "), 1000).alias("text"))
    found = map_texts(docs, "text", whole, "n bigint, size bigint").collect()
    assert sum(r.n for r in found) == 3000
    assert max(r.size for r in found) < BATCH_BYTES + 10_000


def test_decontamination_holds_batches(spark_limit):
    docs = spark_limit.createDataFrame([(1, "a text")], "doc_id bigint, text string")
    items = spark_limit.createDataFrame([(1, "another passage")], "item_id bigint, text string")
    for made in (contamination, decontaminate):
        spark_limit.conf.set(LIMIT, str(64 << 20))
        made(docs, items)
        assert spark_limit.conf.get(LIMIT) == str(BATCH_BYTES)


def test_lower_limit_stays(spark_limit):
    spark_limit.conf.set(LIMIT, "1m")
    map_texts(spark_limit.createDataFrame([("a",)], "text string"), "text", lambda piece: piece, "text string")
    assert spark_limit.conf.get(LIMIT) == "1m"


def peak(work, *given):
    """Bytes that Python holds more while the work is done a second time."""
    work(*given)
    tracemalloc.start()
    try:
        before = tracemalloc.get_traced_memory()[0]
        work(*given)
        return tracemalloc.get_traced_memory()[1] - before
    finally:
        tracemalloc.stop()


def test_memory_of_a_piece():
    dealt = random.Random(3)
    texts = [" ".join(dealt.choices(["stone", "river", "bridges", "oldest", "quiet"], k=900)) for _ in range(400)]
    size = sum(map(len, texts))
    assert peak(line_features, texts) < 15 * size
    assert peak(encode_batch, texts, vocabulary(default_model())) < 15 * size

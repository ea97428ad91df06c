"""Helpers shared by the text operators."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word and line rules, `[\x20\x09-\x0D]`.
SPACE = " \t\n\x0b\f\r"
#: The same as a regular expression class body.
SPACE_CLASS = r"\x20\x09-\x0D"
#: Bytes of an Arrow batch on its way to Python, give or take a row.
BATCH_BYTES = 4_000_000
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(column: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(column, UPPER, LOWER)


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`. Only a local session may lack that setting; it gets a temporary one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoint-"))
    return context.getCheckpointDir()


def durable(frame: DataFrame) -> DataFrame:
    """Compute a frame once and keep its rows in the shared folder, so that it survives lost executors."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint()


def written(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame as Parquet in the shared folder and read it again."""
    folder = f"{shared_folder(frame.sparkSession)}/{re.sub('[^a-z]+', '-', name.lower())}-{uuid.uuid4().hex}"
    frame.write.parquet(folder)
    return frame.sparkSession.read.parquet(folder)


def forget(frame: DataFrame) -> None:
    """Delete the folder of a frame that `written` gave, once nothing reads it any more."""
    spark = frame.sparkSession
    folders = {name.rsplit("/", 1)[0] for name in frame.inputFiles()}
    shared = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if path.getParent().toUri().getPath() == shared.toUri().getPath():
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def fair_share(sizes: dict[int, int], total: int) -> int:
    """The largest share, at least 1, with which members that give their size or the share, if less, give `total` at most.

    `sizes` has the number of members of each size. If all fit whole, it is the largest size.
    """
    left, members = total, sum(sizes.values())
    for size, count in sorted(sizes.items()):
        if size * members > left:
            return max(1, left // members)
        left, members = left - size * count, members - count
    return max(sizes, default=1)


def hold_batches(spark: SparkSession) -> None:
    """Let this session's Arrow batches have BATCH_BYTES at most; a lower limit of the user's stays.

    Spark's own limits of 10,000 rows and 64 MB make a batch of a whole partition of texts. The JVM holds it outside
    the heap while it grows, and so does Python with its answer, for each task that an executor runs.
    """
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_BATCH_SETTING))
    if now > BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def portions(
    batches: Iterator[pa.RecordBatch], text: str, most_bytes: int = 2_000_000
) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the texts of a piece add up to about `most_bytes`; a longer text stands alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        start = total = 0
        for i, size in enumerate(sizes):
            if total and total + size > most_bytes:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < len(sizes):
            yield batch.slice(start)


def map_texts(
    frame: DataFrame, text: str, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """Run `work` on pieces of bounded text size, in Arrow batches."""
    hold_batches(frame.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in portions(batches, text):
            made = work(piece)
            if made is not None:
                yield made

    return frame.mapInArrow(run, schema)

"""A clean table that takes one extract of a change log after the other.

The newest image of every key is kept in buckets by a hash of the key, deletions included, so that an
older image that arrives later can't bring a deleted row back. An extract rewrites only the buckets that
hold one of its keys, into a new version folder; all other buckets stay where they are. A small index
names the version of each bucket. It is replaced in one step after the new files are complete, so a
merge that is cut off changes nothing and can be run again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedupe import RECORD_TIMESTAMP, is_deletion, newest_image
from .files import File

BUCKET = "_bucket"


class ChangeLogTable:
    """Newest images by key below one folder, merged extract by extract."""

    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[str], buckets: int = 64, recorded: str = RECORD_TIMESTAMP):
        self.spark, self.folder, self.keys, self.recorded = spark, folder.rstrip("/"), list(keys), recorded
        self._index = File(spark, f"{self.folder}/index.json")
        self.state = self._index.load() or {"version": 0, "buckets": buckets, "schema": None, "versions": {}}

    def _schema(self) -> T.StructType | None:
        return T.StructType.fromJson(self.state["schema"]) if self.state["schema"] else None

    def _stored(self, buckets: Sequence[int]) -> DataFrame | None:
        """Newest images in the listed buckets; columns that came later are NULL in older versions."""
        known = [(b, self.state["versions"][str(b)]) for b in buckets if str(b) in self.state["versions"]]
        if not known:
            return None
        paths = [f"{self.folder}/v{version}/{BUCKET}={bucket}" for bucket, version in known]
        return self.spark.read.schema(self._schema()).parquet(*paths)

    def merge(self, extract: DataFrame) -> list[int]:
        """Take in one extract and return the buckets that were rewritten.

        Columns are matched by name. One that the table has and the extract lacks is NULL in the new images,
        one that is new is NULL in the old; a known column is cast to the type that the table has.
        """
        known = self._schema()
        fields = {f.name: f for f in (known.fields if known else [])}
        columns = [F.col(c).cast(fields[c].dataType).alias(c) if c in fields else F.col(c) for c in extract.columns]
        newest = newest_image(extract.select(*columns), self.keys, self.recorded)
        bucket = F.pmod(F.xxhash64(*(F.col(k).cast("string") for k in self.keys)), F.lit(self.state["buckets"])).cast("int")
        version = self.state["version"] + 1
        incoming = f"{self.folder}/v{version}_incoming"
        newest.withColumn(BUCKET, bucket).write.mode("overwrite").parquet(incoming)
        # Read again: the images are found once, though they are looked at twice. There are at most as many
        # rows here as buckets.
        arrived = self.spark.read.parquet(incoming)
        touched = sorted(r[0] for r in arrived.select(BUCKET).distinct().collect())
        merged = arrived.drop(BUCKET)
        old = self._stored(touched)
        if old is not None:
            both = old.unionByName(merged, allowMissingColumns=True)
            merged = newest_image(both, self.keys, self.recorded)
        schema = merged.schema
        merged.withColumn(BUCKET, bucket).repartition(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(4))).write.mode("overwrite").partitionBy(
            BUCKET
        ).parquet(f"{self.folder}/v{version}")
        self.state = {
            **self.state,
            "version": version,
            "schema": schema.jsonValue(),
            "versions": self.state["versions"] | {str(b): version for b in touched},
        }
        self._index.save(self.state)
        File(self.spark, incoming).delete()
        return touched

    def clean(self) -> None:
        """Delete bucket folders of earlier versions that no reader needs any more."""
        for version in range(1, self.state["version"] + 1):
            folder = f"{self.folder}/v{version}"
            kept = [b for b, v in self.state["versions"].items() if v == version]
            if not kept:
                File(self.spark, folder).delete()
                continue
            for bucket in range(self.state["buckets"]):
                if str(bucket) not in kept:
                    File(self.spark, f"{folder}/{BUCKET}={bucket}").delete()

    def load(self, deleted: str = "is_deleted") -> DataFrame:
        """One row per key: the newest image, and none where that image is a deletion."""
        schema = self._schema()
        if schema is None:
            raise FileNotFoundError(f"no extract has been merged into {self.folder}")
        rows = self._stored(range(self.state["buckets"]))
        rows = self.spark.createDataFrame([], schema) if rows is None else rows
        return rows.filter(~is_deletion(deleted)) if deleted in rows.columns else rows

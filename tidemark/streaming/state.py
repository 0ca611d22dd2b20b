"""Versioned, bucketed state tables for ``foreachBatch`` processors.

State lives as parquet under a folder on shared storage (inside the query's
checkpoint area), never in executor memory, so a lost executor or a restarted
query loses nothing.  Rows are dealt to ``buckets`` by the hash of their key
columns.  A batch rewrites only the buckets it touches, into a folder of its
own; a manifest names, for every bucket, the batch that wrote it last.

Two manifest slots alternate: batch ``b`` reads slot ``(b - 1) % 2`` and
overwrites slot ``b % 2``.  A batch that is replayed after a failure therefore
reads exactly the state it read the first time, and rewrites its own folder
and slot.  Folders that neither of the two manifests names are deleted.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "__bucket"
DEFAULT_BUCKETS = 16


class VersionedState:
    def __init__(self, path: str, schema: T.StructType, keys: Sequence[str] = (), buckets: int = DEFAULT_BUCKETS):
        self.path = path.rstrip("/")
        self.schema = schema
        self.keys = list(keys)
        self.buckets = buckets if self.keys else 1
        self._stored = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])

    def bucket(self):
        """Bucket number of a row."""
        if not self.keys:
            return F.lit(0)
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """Buckets that hold the keys of ``rows`` (at most ``buckets`` numbers reach the driver)."""
        return sorted(r[0] for r in rows.select(self.bucket().alias("b")).distinct().collect())

    def _folder(self, batch_id: int) -> str:
        return f"{self.path}/batch={batch_id}"

    # --- manifest: a JSON text per batch in alternating slots

    def manifest(self, spark: SparkSession, batch_id: int) -> dict:
        """What batch ``batch_id - 1`` committed: bucket -> batch that wrote it, and other values."""
        if batch_id <= 0:
            return {"buckets": {}}
        return json.loads(spark.read.text(f"{self.path}_meta/slot={(batch_id - 1) % 2}", wholetext=True).first()[0])

    def commit(self, spark: SparkSession, batch_id: int, manifest: dict) -> None:
        before = self.manifest(spark, batch_id)
        row = spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1)
        row.write.mode("overwrite").text(f"{self.path}_meta/slot={batch_id % 2}")
        self._delete_unused(spark, set(before["buckets"].values()) | set(manifest["buckets"].values()), batch_id)

    def _delete_unused(self, spark: SparkSession, used: set[int], batch_id: int) -> None:
        root = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            if name.startswith("batch=") and int(name[6:]) not in used and int(name[6:]) < batch_id:
                fs.delete(status.getPath(), True)

    # --- rows

    def read(self, spark: SparkSession, manifest: dict, buckets: Sequence[int] | None = None) -> DataFrame:
        """Rows of the given buckets (default: all) as the manifest names them."""
        by_batch: dict[int, list[int]] = {}
        for bucket, batch in manifest["buckets"].items():
            if buckets is None or int(bucket) in buckets:
                by_batch.setdefault(batch, []).append(int(bucket))
        out = spark.createDataFrame([], self.schema)
        for batch, own in sorted(by_batch.items()):
            rows = spark.read.schema(self._stored).parquet(self._folder(batch)).where(F.col(BUCKET).isin(own))
            out = out.unionByName(rows.drop(BUCKET))
        return out

    def write(self, df: DataFrame, batch_id: int, manifest: dict, touched: Sequence[int]) -> dict:
        """Write the touched buckets' rows as of batch ``batch_id``; the manifest that names them.

        ``df`` holds all rows of these buckets.  Reading them back cuts the
        lineage, so later batches never recompute earlier ones.
        """
        if touched:
            (df.select(*[f.name for f in self.schema.fields]).withColumn(BUCKET, self.bucket())
             .repartition(len(touched), BUCKET)
             .write.mode("overwrite").option("partitionOverwriteMode", "static")
             .partitionBy(BUCKET).parquet(self._folder(batch_id)))
        buckets = {**manifest["buckets"], **{str(b): batch_id for b in touched}}
        return {**manifest, "buckets": buckets}

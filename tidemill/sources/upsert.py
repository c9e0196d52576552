"""Keyed tables on plain partitioned parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.ranking import latest_per_key
from tidemill.session import fresh_path, remove, settings

BUCKET = "_bucket"
NEWER = "_newer"


class KeyedTable:
    """Upsert by primary key (S18/S21) into a parquet table partitioned by a hash of the key.

    A merge reads and rewrites the partitions of the batch's keys only, by dynamic partition overwrite, which also removes
    their old files, once the new ones are all there. Batch and table move once: they are shuffled by the hash that gives the bucket, to
    as many tasks as there are buckets, so a task holds whole buckets and writes them. Merging a batch again gives the same table, so a stream that repeats its last batch after a
    failure needs no memory of batch ids, and any number of streams may feed one table one after the other. ``buckets`` belongs to
    the table: choose it so that one bucket's rows suit one task, and keep it.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 64):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets

    def _stored(self) -> DataFrame | None:
        try:
            return self.spark.read.option("mergeSchema", True).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def read(self) -> DataFrame | None:
        stored = self._stored()
        return None if stored is None else stored.drop(BUCKET)

    def merge(self, rows: DataFrame, order: Sequence[str], at_rest: bool = False) -> None:
        """Last row per key wins; within the batch by ``order``, over the stored table always. A batch is looked through twice, so it is
        written before and removed afterwards, unless it lies in files already (``at_rest``)."""
        path = None
        if not at_rest:
            path, schema = fresh_path(self.spark, "upsert"), rows.schema
            rows.write.option("compression", "zstd").parquet(path)
            rows = self.spark.read.schema(schema).parquet(path)
        bucket = F.pmod(F.hash(*self.keys), F.lit(self.buckets)).cast("int")
        touched = [r[0] for r in rows.select(bucket.alias(BUCKET)).distinct().collect()]  # ``buckets`` numbers at most
        if touched:
            every, stored = rows.withColumn(NEWER, F.lit(True)), self._stored()
            if stored is not None:
                old = stored.where(F.col(BUCKET).isin(touched)).drop(BUCKET)
                every = old.withColumn(NEWER, F.lit(False)).unionByName(every, allowMissingColumns=True)
            newest = latest_per_key(every, self.keys, [NEWER, *order]).drop(NEWER).withColumn(BUCKET, bucket)
            with settings(every.sparkSession, {"spark.sql.shuffle.partitions": str(self.buckets)}):
                newest.write.option("partitionOverwriteMode", "dynamic").option("compression", "zstd").mode("overwrite").partitionBy(BUCKET).parquet(self.path)
        if path:
            remove(self.spark, path)


def upsert_batches(table: KeyedTable, order: Sequence[str], at_rest: bool = False):
    """A ``foreachBatch`` function that merges each micro-batch."""
    def run(batch: DataFrame, batch_id: int) -> None:
        table.merge(batch, order, at_rest)
    return run


def dim_rows(changes: DataFrame, row_key: str) -> DataFrame:
    """Dimension upserts from change records (S21): deletes are ignored, the key is the MD5 of the row key."""
    return (changes.where(F.col("op") != "d")
            .select(F.md5(F.col("after")[row_key]).alias("row_key"), "after", "ts_ms"))

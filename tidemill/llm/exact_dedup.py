"""Exact de-duplication against a persistent digest index.

The index is a parquet table bucketed and sorted by digest. A batch is reduced to one row per digest on the map side,
meets the index in a sort-merge anti-join whose index side needs no exchange, and the digests that are left are appended.

Defined cases: null text counts as empty; empty texts are equal to each other; a null id ranks after every other id; of
rows that are equal in id and text one stays (whichever the engine numbers first); an empty batch changes nothing; a batch that comes again,
also after a stop between its append and its result, gets the same answer: the row that the index names stays whenever a batch holds
it (rows without an id that are equal in text count as the same row); extra columns are not looked at.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import q, unused
from tidemill.session import fresh_path, settled


def normalised(text: Column) -> Column:
    """Every run of ASCII white space becomes one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \t-\r]+", " ")


def text_digest(text: Column) -> Column:
    """SHA-256 of the normalised text in UTF-8, 32 bytes."""
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


class DigestIndex:
    """digest -> the id that stays, bucketed and sorted by digest, at ``path`` in a folder that all executors share.

    Opening the same path again (also in a later application) continues the index; ``buckets`` must then be the same.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path
        n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.table = "digest_index_" + hashlib.md5(path.encode()).hexdigest()
        spark.sql(f"create table if not exists {self.table} (digest binary, keep_id bigint) using parquet "
                  f"clustered by (digest) sorted by (digest) into {n} buckets location '{path}'")

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, fresh: DataFrame) -> None:
        """Add (digest, keep_id) rows whose digests are not in the index yet."""
        fresh.select("digest", "keep_id").write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)


def add_batch(index: DigestIndex, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Decide on every row of a batch and append its new digests to the index.

    Returns one row per input row: id, digest, keep_id (the id that stays, of this batch or of an earlier one), group_size
    (equal rows in this batch), kept. A digest that holds a third of all rows is counted on the map side; the last join
    splits it by the adaptive skew rule, since both of its sides are exchanged.
    """
    rows = settled(docs.select(q(id_col).cast("bigint").alias("id"), text_digest(q(text_col)).alias("digest"),
                               F.monotonically_increasing_id().alias("tie")), "digests")
    best = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "tie"))
    groups = settled(rows.groupBy("digest").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size")), "groups")
    known = index.rows()
    fresh = (groups.join(known.hint("merge"), "digest", "left_anti")
             .select("digest", F.col("best.id").alias("keep_id"), F.col("best.tie").alias("keep_tie"), "group_size"))
    seen = (groups.join(known.hint("merge"), "digest")
            .select("digest", "keep_id", F.lit(None).cast("bigint").alias("keep_tie"), "group_size"))
    decided = settled(fresh.unionByName(seen), "decided")
    met = decided.where(F.col("keep_tie").isNull())
    if not met.isEmpty():  # of these the row that the index names stays, if it is in this batch
        named = rows.join(met.select(F.col("digest").alias("of"), F.col("keep_id").alias("named_id")), (F.col("digest") == F.col("of")) & F.col("id").eqNullSafe(F.col("named_id")))
        again = named.groupBy("digest").agg(F.min("tie").alias("again_tie"))
        decided = settled(decided.join(again, "digest", "left").withColumn("stays", F.coalesce("keep_tie", "again_tie")).drop("again_tie"), "decided")
    else:
        decided = decided.withColumn("stays", F.col("keep_tie"))
    index.append(decided.where(F.col("keep_tie").isNotNull()))
    return rows.join(decided, "digest").select(
        F.col("id"), "digest", "keep_id", "group_size", F.coalesce(F.col("tie") == F.col("stays"), F.lit(False)).alias("kept"))


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", index: DigestIndex | None = None) -> DataFrame:
    """``add_batch`` on a new index of its own, unless one is given."""
    spark = docs.sparkSession
    return add_batch(index or DigestIndex(spark, fresh_path(spark, "digest-index")), docs, id_col, text_col)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", index: DigestIndex | None = None) -> DataFrame:
    """The rows that stay, with the columns of ``docs``. Of rows equal in id and text one is left, as in ``decisions``."""
    kept = decisions(docs, id_col, text_col, index).where("kept").select(F.col("id").alias("kept_id"), F.col("digest").alias("kept_digest"))
    ident, digest = unused(docs, "row_id", "row_digest")
    keyed = docs.withColumns({ident: q(id_col).cast("bigint"), digest: text_digest(q(text_col))})
    stay = keyed.join(kept, q(digest).eqNullSafe(F.col("kept_digest")) & q(ident).eqNullSafe(F.col("kept_id")), "left_semi")
    return stay.dropDuplicates([digest, ident]).select(*map(q, docs.columns))

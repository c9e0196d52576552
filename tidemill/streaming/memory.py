"""The memory of visitors behind the log splitter, kept in shared files and read by a batch's visitors only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.session import fresh_path, remove

FANOUT = 16     # directories of a level that are merged into one of the next level
BUCKETS = 1024  # most hash buckets of a directory
STORED = "mid string, memory date, seen date, level int, part int, bucket int"


class VisitorMemory:
    """The day every visitor is remembered by, with the last day each was seen.

    Batch ``n`` adds the directory ``level=0/part=n``. Every ``FANOUT`` directories of a level become one of the next, one row per
    visitor, so a batch reads fewer than ``FANOUT`` directories a level, and there are as many levels as its number has digits.
    A level has four times the hash buckets of the one below: of the large directories, only the buckets that hold a
    visitor of the batch are read.

    A visitor not seen for more than ``keep_days`` days is new again (None: never). That is judged visitor by visitor, so it does not
    depend on merges; these drop entries older than twice that, counted from the newest day they see. All
    directories are named by batch ids and replaced as a whole, and merged ones are removed one batch later: a repeated batch
    reads and writes exactly the same.
    """

    def __init__(self, spark: SparkSession, path: str, keep_days: int | None):
        self.spark, self.path, self.keep_days = spark, path.rstrip("/"), keep_days

    @staticmethod
    def parts(batch_id: int) -> list[tuple[int, int]]:
        """(level, part) of the directories that hold all batches before ``batch_id``."""
        found, level, upto = [], 0, batch_id
        while upto:
            found += [(level, n) for n in range(upto - upto % FANOUT, upto)]
            upto, level = upto // FANOUT, level + 1
        return found

    @staticmethod
    def merges(batch_id: int) -> list[tuple[int, int]]:
        """(level, part) of the directories to be made before ``batch_id`` is read, lower levels first."""
        due, level, count = [], 1, batch_id
        while count and count % FANOUT == 0:
            count //= FANOUT
            due.append((level, count - 1))
            level += 1
        return due

    def _directory(self, level: int, part: int) -> str:
        return f"{self.path}/level={level}/part={part}"

    def _sources(self, level: int, part: int) -> list[tuple[int, int]]:
        return [(level - 1, n) for n in range(part * FANOUT, (part + 1) * FANOUT)]

    def _read(self, parts: list[tuple[int, int]]) -> DataFrame:
        return self.spark.read.schema(STORED).option("basePath", self.path).parquet(*[self._directory(*p) for p in parts])

    def _write(self, rows: DataFrame, level: int, part: int) -> None:
        bucket = F.pmod(F.xxhash64("mid"), F.lit(_buckets(level))).cast("int")
        (rows.select("mid", "memory", "seen", bucket.alias("bucket")).repartition("bucket")
         .write.mode("overwrite").partitionBy("bucket").parquet(self._directory(level, part)))

    def merge_due(self, batch_id: int) -> None:
        for level, part in self.merges(batch_id):
            rows = _newest(self._read(self._sources(level, part)))
            if self.keep_days is not None:
                newest = rows.agg(F.max("seen").alias("m")).select("m").scalar()
                rows = rows.where(F.col("seen") >= F.date_sub(newest, 2 * self.keep_days))
            self._write(rows, level, part)

    def candidates(self, visitors: DataFrame, batch_id: int) -> DataFrame:
        """Stored entries in the buckets of the batch's visitors; all other files are pruned before reading."""
        parts = self.parts(batch_id)
        hit = [r[0] for r in visitors.select(F.pmod(F.xxhash64("mid"), F.lit(BUCKETS)).cast("int")).distinct().collect()]  # BUCKETS at most
        wanted = F.lit(False)
        for level in sorted({level for level, _ in parts}):
            wanted = wanted | ((F.col("level") == level) & F.col("bucket").isin(sorted({h % _buckets(level) for h in hit})))
        return self._read(parts).where(wanted)

    def update(self, visitors: DataFrame, batch_id: int) -> DataFrame:
        """(mid, memory) for the batch's ``visitors`` (mid, memory, first, last), also written as the batch's directory.

        ``memory`` of the input is what an unknown visitor would be remembered by; ``first`` and ``last`` are the days seen.
        """
        self.merge_due(batch_id)
        scratch = fresh_path(self.spark, "visitors")
        visitors.write.parquet(scratch)
        here = self.spark.read.schema(visitors.schema).parquet(scratch)
        if batch_id == 0:
            known = here.select("mid", "memory", F.col("last").alias("seen"))
        else:
            stored = self.candidates(here, batch_id).join(here.select("mid"), "mid", "left_semi")
            old = _newest(stored).select("mid", F.col("memory").alias("_memory"), F.col("seen").alias("_seen"))
            fresh = F.datediff("first", "_seen") > F.lit(self.keep_days).cast("int")
            kept = F.col("_seen").isNotNull() & ~F.coalesce(fresh, F.lit(False))
            known = here.join(old, "mid", "left").select(
                "mid", F.when(kept, F.col("_memory")).otherwise(F.col("memory")).alias("memory"), F.greatest("last", "_seen").alias("seen"))
        self._write(known, 0, batch_id)
        remove(self.spark, scratch)
        for level, part in self.merges(batch_id - 1) if batch_id else []:
            for source in self._sources(level, part):
                remove(self.spark, self._directory(*source))
        return self._read([(0, batch_id)]).select("mid", "memory")


def _buckets(level: int) -> int:
    return min(4 ** level, BUCKETS)


def _newest(entries: DataFrame) -> DataFrame:
    """The latest entry of every visitor, combined on the map side."""
    return entries.groupBy("mid").agg(F.max(F.struct("seen", "memory")).alias("_e")).select("mid", "_e.memory", "_e.seen")

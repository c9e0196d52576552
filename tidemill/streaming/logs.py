"""Raw log processing: dirty lines, new-visitor repair, splitting into record types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.streaming.memory import VisitorMemory
from tidemill.streaming.sources import parsed_log

ROUTES = ("dirty", "err", "start", "display", "action", "page")


def visitors_seen(good: DataFrame) -> DataFrame:
    """(mid, memory, first, last): the day a visitor is remembered by -- the day of the first event, or the day before it when
    that event already said the visitor is not new (X15) -- and the days seen. An aggregate with map-side combine."""
    first = F.min_by(F.struct("ts", "common.is_new"), F.struct("ts", "common.is_new"))
    day = F.to_date(F.timestamp_millis("_m.ts"))
    return good.groupBy(F.col("common.mid").alias("mid")).agg(first.alias("_m"), F.max("ts").alias("_last")).select(
        "mid", F.when(F.col("_m.is_new") == "1", day).otherwise(F.date_sub(day, 1)).alias("memory"),
        day.alias("first"), F.to_date(F.timestamp_millis("_last")).alias("last"))


def repaired(good: DataFrame, memory: DataFrame) -> DataFrame:
    """A "new" flag on any day but the remembered one becomes "0". A visitor's rows may be a third of the batch:
    the join splits them, because it is a plain skew-aware join and not a keyed operator."""
    joined = good.join(memory.select(F.col("mid").alias("_mid"), "memory"), F.col("common.mid") == F.col("_mid"), "left")
    stale = (F.col("common.is_new") == "1") & (F.to_date(F.timestamp_millis("ts")) != F.col("memory"))
    flag = F.when(stale, F.lit("0")).otherwise(F.col("common.is_new"))
    return joined.withColumn("common", F.col("common").withField("is_new", flag)).drop("_mid", "memory")


def split(good: DataFrame) -> DataFrame:
    """(route, value): every record of a log line in one pass.

    ``err`` goes out on its own; a start log ends there; otherwise each display and action is a record and the page
    stays one. All records carry ``common`` and ``ts``.
    """
    def record(route: str, *cols):
        return F.struct(F.lit(route).alias("route"), F.to_json(F.struct("common", *cols, "ts")).alias("value"))

    is_page = F.col("start").isNull()
    page = F.col("page")
    err = F.when(F.col("err").isNotNull(), F.array(record("err", "err")))
    start = F.when(~is_page, F.array(record("start", "start")))
    shown = F.when(is_page, F.transform("displays", lambda x: record("display", page, x.alias("display"))))
    acted = F.when(is_page, F.transform("actions", lambda x: record("action", page, x.alias("action"))))
    body = F.when(is_page, F.array(record("page", page)))
    empty = F.array().cast("array<struct<route:string,value:string>>")
    every = F.concat(*[F.coalesce(part, empty) for part in (err, start, shown, acted, body)])
    return good.select(F.explode(every).alias("_r")).select("_r.route", "_r.value")


def split_batches(out: str, memory_path: str, keep_days: int | None = 730):
    """``foreachBatch`` job (R1): records partitioned by route, and a memory of visitors.

    The records lie in a directory named by the batch id, so a repeated batch overwrites exactly its own files. The memory
    (``VisitorMemory``) is read by the batch's visitors only; one not seen for ``keep_days`` days is forgotten (None: never).
    Gaps are taken between batches: within one, a visitor is judged by the first event.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        parsed = parsed_log(batch)
        dirty = parsed.where(F.col("_corrupt").isNotNull()).select(F.lit("dirty").alias("route"), "value")
        good = parsed.where(F.col("_corrupt").isNull())
        memory = VisitorMemory(batch.sparkSession, memory_path, keep_days).update(visitors_seen(good), batch_id)
        records = dirty.unionByName(split(repaired(good, memory)))
        records.write.mode("overwrite").partitionBy("route").parquet(f"{out}/batch={batch_id}")
    return run

"""Joins and windows of event streams whose state is kept as files.

A stream join of Spark puts every row of a batch into its state store and takes it out again with the watermark, although nearly all partners
come in the same batch when the stream is read in the order of time. Here a micro-batch is joined or aggregated as a whole, with the rows before it
that can still matter: only these are carried from batch to batch, as files, and skewed keys are split like those of any batch join.

Every result has an anchor, a time. It is given out once, by the first batch after which the clock has passed the anchor by ``ahead_s``, when nothing can
join it or change it any more; rows that come later than that are too late. Rows are carried while a result that is still open may reach back to them
(``back_s`` before its anchor). The clock is the least of the streams' latest times, each less its delay, as with the watermark.

The files of a batch are named by its id and written from those of the batch before, so a batch that is repeated after a failure gives the same.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemill.session import fresh_path, remove, shuffles_removed
from tidemill.streaming.sinks import drain

SIDE, TIME = "_side", "event_time"
PACK = {"compression": "zstd"}


@dataclasses.dataclass(frozen=True)
class Stream:
    """A streaming frame with ``event_time``. Rows outside ``keep`` only move the clock."""

    df: DataFrame
    delay_s: float
    keep: Column | None = None


@dataclasses.dataclass(frozen=True)
class Part:
    """What is made of the streams: ``job`` takes a frame of each, ``anchor`` is a time of its rows."""

    job: Callable[..., DataFrame]
    ahead_s: float
    back_s: float
    anchor: Column | None = None


def _micros(seconds: float) -> int:
    return round(seconds * 1_000_000)


def _side(stream: Stream, i: int, n: int, kinds: Sequence[str]) -> DataFrame:
    row = F.struct(*[F.col(c) for c in stream.df.columns])
    row = row if stream.keep is None else F.when(stream.keep, row)
    parts = [(row if k == i else F.lit(None)).cast(kinds[k]).alias(f"s{k}") for k in range(n)]
    return stream.df.select(F.lit(i).alias(SIDE), TIME, *parts)


def closed_results(streams: Sequence[Stream], parts: Sequence[Part], label: str) -> list[DataFrame]:
    """Run the streams to the end of what is there; a table in the shared folder for each part."""
    spark, n = streams[0].df.sparkSession, len(streams)
    folder, checkpoint = fresh_path(spark, label), fresh_path(spark, f"{label}-ckpt")
    kinds = [s.df.schema.simpleString() for s in streams]
    every = _side(streams[0], 0, n, kinds)
    for i in range(1, n):
        every = every.unionByName(_side(streams[i], i, n, kinds))
    schema = every.schema
    shapes = [p.job(*[spark.createDataFrame([], s.df.schema) for s in streams]).drop(TIME).schema for p in parts]
    clocks: dict[int, list[int | None]] = {}  # latest times by batch; a query that goes on elsewhere finds them among the carried rows
    some = F.coalesce(*[F.col(f"s{i}").isNotNull() for i in range(n)]) if n == 1 else F.greatest(*[F.col(f"s{i}").isNotNull() for i in range(n)])

    def latest(i: int) -> Column:
        return F.max(F.when(F.col(SIDE) == i, F.unix_micros(TIME))).alias(f"c{i}")

    def carried(batch_id: int) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{folder}/carried-{batch_id}")

    def clock(batch_id: int) -> list[int | None]:
        if batch_id < 0:
            return [None] * n
        if batch_id not in clocks:
            clocks[batch_id] = list(carried(batch_id).agg(*[latest(i) for i in range(n)]).first())
        return clocks[batch_id]

    def passed(times: list[int | None]) -> int | None:
        return None if None in times else min(c - _micros(s.delay_s) for c, s in zip(times, streams))

    def run(batch: DataFrame, batch_id: int) -> None:
        fresh, seen = f"{folder}/fresh-{batch_id}", Observation()
        batch.observe(seen, *[latest(i) for i in range(n)]).where(some).write.mode("overwrite").options(**PACK).parquet(fresh)
        was, found = clock(batch_id - 1), seen.get
        now = [max((c for c in (was[i], found.get(f"c{i}")) if c is not None), default=None) for i in range(n)]
        low, high = passed(was), passed(now)
        rows = spark.read.schema(schema).parquet(fresh)
        if batch_id > 0:
            rows = rows.unionByName(carried(batch_id - 1).where(some))
        sides = [rows.where(F.col(SIDE) == i).select(f"s{i}.*") for i in range(n)]
        for k, p in enumerate(parts):
            at = F.unix_micros(F.col(TIME) if p.anchor is None else p.anchor)
            closed = F.lit(False) if high is None else at <= high - _micros(p.ahead_s)
            closed = closed if low is None else closed & (at > low - _micros(p.ahead_s))
            with shuffles_removed(spark):
                p.job(*sides).where(closed).drop(TIME).write.mode("overwrite").parquet(f"{folder}/part-{k}/batch={batch_id}")
        if high is not None:
            rows = rows.where(F.unix_micros(TIME) > min(high - _micros(p.ahead_s + p.back_s) for p in parts))
        marks = spark.createDataFrame([(i, c) for i, c in enumerate(now) if c is not None], f"{SIDE} int, c bigint").select(SIDE, F.timestamp_micros("c").alias(TIME))
        rows.unionByName(marks, allowMissingColumns=True).write.mode("overwrite").options(**PACK).parquet(f"{folder}/carried-{batch_id}")
        clocks[batch_id] = now
        remove(spark, fresh)
        remove(spark, f"{folder}/carried-{batch_id - 2}")

    drain(every.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint))
    return [spark.read.schema(shape).parquet(f"{folder}/part-{k}/*") for k, shape in enumerate(shapes)]

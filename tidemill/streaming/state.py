"""Keyed state on event streams.

Only small streams reach a Python state processor: bursts of a key are thinned in the JVM first, with the key salted,
so a key that sends a third of all events costs its few distinct (day, window) rows here and nothing more. A call settles a whole bucket
of keys, with one state entry per key.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# the workers that run state processors do not see shipped packages, so the classes travel themselves, not by name
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SALTS = 16


def live(cond: Column, time: str = "event_time") -> Column:
    """A filter that stays above the watermark operator: rows it drops still move the event clock (heartbeats)."""
    return F.when(F.col(time).isNotNull(), cond)


def once_per_window(df: DataFrame, keys: Sequence[str], grain: str, time: str = "event_time") -> DataFrame:
    """One row per (keys, tumbling window), exact (X18 form); state leaves with the watermark.

    Two steps: the first spreads a hot key over salts, the second sees at most ``SALTS`` rows of it. A batch needs one, as its rows are combined
    before they are moved.
    """
    if not df.isStreaming:
        return df.withColumn("_w", F.window(time, grain)).drop(time).dropDuplicates(["_w", *keys])
    rest = [c for c, t in df.dtypes if c not in keys and not t.startswith("map")]
    salt = F.pmod(F.xxhash64(*rest), F.lit(SALTS))
    # the window is the one event-time column from here on
    w = df.withColumn("_w", F.window(time, grain)).withColumn("_salt", salt).drop(time)
    return w.dropDuplicates(["_w", *keys, "_salt"]).dropDuplicates(["_w", *keys]).drop("_salt")


BUCKETS = 256  # of keys; part of the state, so it stays the same for the life of a query


class DayMemory(StatefulProcessor):
    """First event of each key's day, with what the key's past says about it; a call settles all keys of a bucket.

    Emits key columns, event time, ``is_first`` (nothing of the key was seen before), ``gap_days`` since the active day before it
    (null when there is none) and the carried columns of that first event. The state has one entry per key: the days that the watermark
    still lets in, and the last one before them. Only the entries of a batch's keys are read and written.
    """

    def __init__(self, keys: Sequence[str], carry: Sequence[str] = ()):
        self.keys, self.carry = list(keys), list(carry)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.memory = handle.getMapState("memory", "ident string", "days string, last int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for pdf in rows:
            pdf["day"] = ((pdf["event_time"].dt.floor("D") - pd.Timestamp(0)) // pd.Timedelta(days=1)).astype("int64")
            both = pdf if first is None else pd.concat([first, pdf], ignore_index=True)
            first = both.sort_values("event_time", kind="stable").drop_duplicates(["ident", "day"])
        if first is None or first.empty:
            return
        closed_before = timerValues.getCurrentWatermarkInMs() // 86_400_000
        first = first.sort_values(["ident", "day"], kind="stable", ignore_index=True)
        days = first["day"].tolist()
        keep, is_first, gap = [], [], []
        for ident, at in first.groupby("ident", sort=False).indices.items():
            state = self.memory.getValue((ident,)) if self.memory.containsKey((ident,)) else None
            known = {int(d) for d in state[0].split(",") if d} if state else set()
            last = state[1] if state else None  # the last day that no row can reach any more
            for i in at:
                day = days[i]
                if day in known:
                    continue
                before = max((x for x in (*known, last) if x is not None and x < day), default=None)
                keep.append(i), is_first.append(0 if known or last is not None else 1), gap.append(None if before is None else day - before)
                known.add(day)
            gone = [d for d in known if d < closed_before]
            if gone:
                last = max(gone if last is None else [*gone, last])
            self.memory.updateValue((ident,), (",".join(str(d) for d in sorted(known) if d >= closed_before), last))
        if keep:
            out = first.iloc[keep][[*self.keys, "event_time", *self.carry]].reset_index(drop=True)
            out.insert(len(self.keys) + 1, "is_first", is_first)
            out.insert(len(self.keys) + 2, "gap_days", pd.array(gap, dtype="Int64"))
            yield out

    def close(self) -> None:
        pass


def first_of_day(df: DataFrame, keys: Sequence[str], grain: str, carry: Sequence[str] = ()) -> DataFrame:
    """First event per key and day as a stream (X12); ``is_first`` and ``gap_days`` serve X13 and X14.

    ``grain`` is the window the result will be counted in; the event time is exact to that window. ``carry`` columns are
    those of the first event.
    """
    if carry:
        # the earliest row of each window, ties by the carried columns; a hot key is spread over salts first
        least = F.min(F.struct("event_time", *carry)).alias("_f")
        salt = F.pmod(F.xxhash64("event_time", *carry), F.lit(SALTS)).alias("_salt")
        parts = df.groupBy(F.window("event_time", grain).alias("_w"), *keys, salt).agg(least)
        parts = parts.withColumn("event_time", F.window_time("_w"))
        once = parts.groupBy(F.window("event_time", grain).alias("_w"), *keys).agg(F.min("_f").alias("_f"))
        thin = once.select(*keys, F.window_time("_w").alias("event_time"), *[F.col(f"_f.{c}").alias(c) for c in carry])
    else:
        # one aggregate: bursts of a key combine on the map side, so each (key, window) is one row in one state
        once = df.groupBy(F.window("event_time", grain).alias("_w"), *keys).agg(F.count(F.lit(1)).alias("_n"))
        thin = once.select(*keys, F.window_time("_w").alias("event_time"))
    plain = [f"k{i}" for i in range(len(keys))]  # names without a leading underscore, which rows do not carry
    named = ", ".join(f"{p} {t}" for p, (_, t) in zip(plain, thin.select(*keys).dtypes))
    carried = "".join(f", {c} {t}" for c, t in thin.select(*carry).dtypes) if carry else ""
    ident = F.to_json(F.struct(*[F.col(k) for k in keys]), {"ignoreNullFields": "false"})
    rows = thin.select(F.pmod(F.xxhash64(ident), F.lit(BUCKETS)).cast("int").alias("bucket"), ident.alias("ident"),
                       *[F.col(k).alias(p) for k, p in zip(keys, plain)], "event_time", *carry)
    out = rows.groupBy("bucket").transformWithStateInPandas(
        DayMemory(plain, carry), f"{named}, event_time timestamp, is_first int, gap_days bigint{carried}", "append", "eventTime",
        eventTimeColumnName="event_time")
    return out.withColumnsRenamed(dict(zip(plain, keys)))


def with_retractions(df: DataFrame, key: str, version: str, payload: Sequence[str], grain: str, ttl_ms: int = 10_000) -> DataFrame:
    """Versions of a key with ``sign`` +1, and the versions they replace with ``sign`` -1 (X16), by event time.

    A version takes back the one before it when that is at most ``ttl_ms`` older. Sums of ``sign * amount`` over windows of ``grain`` need
    three things of a key and a window only: the time of its first version there, its last version there, and its last version before the
    window; versions in between cancel, as they lie within the lifetime of each other (so ``grain`` must not exceed it). All three come from
    one aggregate over windows that slide by ``grain`` and reach back by the lifetime: it combines on the map side, whatever share
    of the rows one key has, and a key's state leaves with the watermark. Of equal times the higher version counts as the later.

    The rows carry the event time of the window they count in.
    """
    width = round(pd.Timedelta(grain).total_seconds() * 1000)
    if width > ttl_ms:
        raise ValueError("the grain must not exceed the lifetime: versions of one window would not all replace each other")
    reach = width * (1 + -(-ttl_ms // width))
    sliding = df.withColumn("_w", F.window("event_time", f"{reach} milliseconds", f"{width} milliseconds"))
    inside = F.col("event_time") >= F.expr(f"timestampadd(MILLISECOND, -{width}, _w.end)")
    one = F.struct(F.unix_millis("event_time").alias("at"), F.col(version).alias("version"), *payload)
    rows = sliding.groupBy("_w", F.col(key).alias("id")).agg(
        F.min(F.when(inside, F.unix_millis("event_time"))).alias("_first"), F.max(F.when(inside, one)).alias("_now"),
        F.max(F.when(~inside, one)).alias("_was")).where(F.col("_first").isNotNull())
    undone = F.col("_was").isNotNull() & (F.col("_first") - F.col("_was.at") <= ttl_ms)

    def signed(sign: int, of: str) -> Column:
        return F.struct(F.lit(sign).alias("sign"), *[F.col(f"{of}.{c}").alias(c) for c in payload])

    every = F.array_compact(F.array(signed(1, "_now"), F.when(undone, signed(-1, "_was"))))
    return rows.select("id", F.window_time("_w").alias("event_time"), F.explode(every).alias("_s")).select("id", "event_time", "_s.*")


class Newest(StatefulProcessor):
    """Pass a row only when its version exceeds every version of its id seen before (X17); a call settles all ids of a bucket.

    One entry per id and generation of event time, of which the batch's ids alone are read and written. An id is looked for in the
    generation of its time and the ones beside it, so it is remembered ``ttl_ms`` at least. One timer waits for the end of the oldest generation;
    it removes all generations that are over by then, so the entries are listed once, not once a generation.
    """

    def __init__(self, id_type: str, ttl_ms: int):
        self.id_type, self.ttl_ms = id_type, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.top = handle.getMapState("top", f"generation bigint, id {self.id_type}", "ts_ms bigint")
        self.open = handle.getValueState("open", "generations string")

    def generations(self) -> set[int]:
        return {int(g) for g in self.open.get()[0].split(",")} if self.open.exists() else set()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best: dict[tuple, int] = {}  # of the ids of this call
        touched, live = set(), self.generations()
        for pdf in rows:
            pdf = pdf.sort_values(["event_time", "ts_ms"], kind="stable")
            generation = ((pdf["event_time"] - pd.Timestamp(0)) // pd.Timedelta(milliseconds=self.ttl_ms)).astype("int64")
            passed = []
            for ident, ts, g in zip(pdf["id"], pdf["ts_ms"], generation):
                newest = None
                for near in (g - 1, g, g + 1):
                    if (near, ident) not in best and near in live:
                        best[near, ident] = self.top.getValue((near, ident))[0] if self.top.containsKey((near, ident)) else None
                    seen = best.get((near, ident))
                    newest = seen if newest is None or (seen is not None and seen > newest) else newest
                passed.append(newest is None or ts > newest)
                if passed[-1]:
                    best[g, ident] = int(ts)
                    touched.add((g, ident))
            if any(passed):
                yield pdf.loc[passed, ["id", "ts_ms", "event_time"]]
        for g, ident in touched:
            self.top.updateValue((g, ident), (best[g, ident],))
        new = {g for g, _ in touched} - live
        if new:
            self.open.update((",".join(map(str, sorted(new | live))),))
            if not live or min(new) < min(live):
                self.handle.registerTimer(int(min(new) + 2) * self.ttl_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        gone = timerValues.getCurrentWatermarkInMs() // self.ttl_ms - 2
        left = sorted(g for g in self.generations() if g > gone)
        if left:
            for g, ident in list(self.top.keys()):
                if g <= gone:
                    self.top.removeKey((g, ident))
            self.open.update((",".join(map(str, left)),))
            self.handle.registerTimer((left[0] + 2) * self.ttl_ms)
        else:
            self.top.clear()
            self.open.clear()
        return iter([])

    def close(self) -> None:
        pass


def only_newer(df: DataFrame, ttl_ms: int = 86_400_000, buckets: int = BUCKETS) -> DataFrame:
    """Newest-first filter over ``id, ts_ms, event_time``; equal (id, ts_ms) pairs are dropped in the JVM before."""
    thin = df.select("id", "ts_ms", "event_time").dropDuplicatesWithinWatermark(["id", "ts_ms"])
    kind = dict(thin.dtypes)["id"]
    return thin.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")).groupBy(
        "bucket").transformWithStateInPandas(
        Newest(kind, ttl_ms), f"id {kind}, ts_ms bigint, event_time timestamp", "append", "eventTime",
        eventTimeColumnName="event_time")

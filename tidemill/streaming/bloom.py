"""De-duplication by Bloom filters: bounded memory, no repeat passes, a known share of new keys is dropped by mistake."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHARDS = 64


def bits_for(expected: int, fpp: float) -> int:
    """Bits of a filter for so many keys at this rate of false positives."""
    return max(64, math.ceil(-expected * math.log(fpp) / math.log(2) ** 2))


def probes_for(fpp: float) -> int:
    return max(1, round(-math.log2(fpp)))


class Layer:
    """One bit array. A layer that has taken as many keys as it is made for is closed, and another of twice the size follows, with half
    the rate: the rates of all layers of a generation add up to less than twice the first one's, however many keys come."""

    def __init__(self, number: int, expected: int, fpp: float, bits: bytes | None = None, count: int = 0):
        self.capacity, self.rate = expected << number, fpp / 2 ** number
        self.size, self.probes = bits_for(self.capacity, self.rate), probes_for(self.rate)
        self.bits = np.frombuffer(bits, np.uint8).copy() if bits else np.zeros(-(-self.size // 8), np.uint8)
        self.count = count

    def places(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Bit numbers by double hashing, a row per key."""
        step = np.arange(self.probes, dtype=np.uint64)
        return (one[:, None].astype(np.uint64) + step * (two[:, None].astype(np.uint64) * np.uint64(2) + np.uint64(1))) % np.uint64(self.size)

    def holds(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        at = self.places(one, two)
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).all(1)

    def add(self, one: np.ndarray, two: np.ndarray) -> None:
        at = self.places(one, two).ravel()
        np.bitwise_or.at(self.bits, at >> np.uint64(3), np.left_shift(1, (at & np.uint64(7)).astype(np.uint8)).astype(np.uint8))
        self.count += len(one)


class BloomShard(StatefulProcessor):
    """The filters of one range of hashes: layers per generation of event time. A key is looked for in the generation of its time and both
    neighbours, so that repeats up to a generation apart are found in any order; what the watermark has left behind goes by timer."""

    def __init__(self, columns: Sequence[str], expected: int, fpp: float, period_ms: int):
        self.columns, self.expected, self.fpp, self.period_ms = list(columns), expected, fpp, period_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.layers = handle.getMapState("layers", "generation long, number int", "bits binary, n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        live: dict[int, list[Layer]] = {}
        for (generation, number), (bits, n) in sorted(self.layers.iterator(), key=lambda x: tuple(x[0])):
            live.setdefault(generation, []).append(Layer(number, self.expected, self.fpp / 6, bytes(bits), n))  # two per layer sum, three generations
        known, touched = {g: len(x) for g, x in live.items()}, set()
        for pdf in rows:
            one, two = (pdf[c].to_numpy().astype(np.uint32) for c in ("hash_one", "hash_two"))
            generation = ((pdf["event_time"] - pd.Timestamp(0)) // pd.Timedelta(milliseconds=self.period_ms)).to_numpy().astype(np.int64)
            fresh = ~pd.DataFrame({"a": one, "b": two}).duplicated().to_numpy()  # of equal keys in a batch the first
            for g in np.unique(generation).tolist():
                mine = np.flatnonzero(fresh & (generation == g))
                for near in (g - 1, g, g + 1):
                    for layer in live.get(near, []):
                        mine = mine[~layer.holds(one[mine], two[mine])]
                fresh[np.setdiff1d(np.flatnonzero(generation == g), mine)] = False
                while len(mine):
                    own = live.setdefault(g, [])
                    if not own or own[-1].count >= own[-1].capacity:
                        own.append(Layer(len(own), self.expected, self.fpp / 6))
                    room = own[-1].capacity - own[-1].count
                    own[-1].add(one[mine[:room]], two[mine[:room]])
                    touched.add((g, len(own) - 1))
                    mine = mine[room:]
            if fresh.any():
                yield pdf.loc[fresh, self.columns]
        for g, number in touched:
            self.layers.updateValue((g, number), (live[g][number].bits.tobytes(), live[g][number].count))
            if g not in known:
                self.handle.registerTimer((g + 2) * self.period_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        gone = expiredTimerInfo.getExpiryTimeInMs() // self.period_ms - 2
        for generation, number in list(self.layers.keys()):
            if generation <= gone:
                self.layers.removeKey((generation, number))
        return iter([])

    def close(self) -> None:
        pass


def bloom_deduplicated(df: DataFrame, key: str, period: str, expected: int, fpp: float = 0.001, shards: int = SHARDS) -> DataFrame:
    """Rows whose ``key`` was not there before, within a ``period`` of event time at least and two at most.

    ``expected`` keys a period, over all shards, are what the first bit arrays are made for; more keys open further ones, and the share of new
    keys that is dropped stays at ``fpp``. Null keys are one key.
    """
    period_ms = round(pd.Timedelta(period).total_seconds() * 1000)
    text = F.coalesce(F.col(key).cast("string"), F.lit("\\0"))
    hashed = df.withColumn("hash_one", F.hash(text)).withColumn("hash_two", F.hash(F.lit("second"), text))  # murmur3, two seeds
    schema = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)
    spread = hashed.withColumn("hash_shard", F.pmod(F.xxhash64("hash_one", "hash_two"), F.lit(shards)).cast("int"))
    return spread.groupBy("hash_shard").transformWithStateInPandas(
        BloomShard(df.columns, max(1, -(-expected // shards)), fpp, period_ms), schema, "append", "eventTime", eventTimeColumnName="event_time")

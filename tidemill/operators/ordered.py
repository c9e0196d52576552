"""Ordered per-group operators that survive a group of any size.

A plain window sorts a whole group inside one task. Here a group holding more than ``1/SHARE`` of all rows is cut
into value slices first: row numbers, ranks and neighbours are computed per slice by an ordinary window and
stitched together by per-slice offsets. Slices are dealt out in proportion to a group's rows, about ``SLICES`` in all, so a
slice holds about ``1/SLICES`` of all rows whatever the size of its group. By pigeonhole at most ``SHARE`` groups are cut, so
every table joined back has at most ``SHARE + SLICES`` rows -- that bound, not a guess, is what allows the broadcasts.
Results equal the plain window for every input, nulls and NaN in the order keys included.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, CharType, DataType, DateType, DecimalType, DoubleType, FloatType, FractionalType,
                               IntegralType, LongType, MapType, StringType, TimestampNTZType, TimestampType, VarcharType, VariantType)

SHARE = 4096    # a group above this part of all rows is cut
SLICES = 16384  # slices of all cut groups together, about
LEAST = 100_000  # a smaller group is never cut
DRAW = 16       # rows drawn per slice to place the slice bounds
BLOCK = 128     # slice bounds looked through at once
SLICE = "_slice"


def rising(value: Column) -> Column:
    """The ``cut`` for ascending order: nulls come first, NaN last."""
    v = value.cast("double")
    return F.coalesce(F.nanvl(v, F.lit(float("inf"))), F.lit(float("-inf")))


def falling(value: Column) -> Column:
    """The ``cut`` for descending order: NaN comes first, nulls last."""
    v = value.cast("double")
    return F.coalesce(-F.nanvl(v, F.lit(float("inf"))), F.lit(float("inf")))


def places(df: DataFrame, *order: str) -> list[Column]:
    """A ``cut`` on the whole order ``order``: column names of ``df``, descending with a leading minus.

    Every column gives numbers that rise along its order: whether it is null or NaN, then its value, in two halves where a
    double would round it. Strings count by their first twelve bytes. The list ends at the first column whose different values may share
    their numbers (strings, decimals, other types), as what follows it would no longer rise.
    """
    found = []
    for name in order:
        down, name = name.startswith("-"), name.removeprefix("-")
        value, kind = F.col(f"`{name}`"), df.schema[name].dataType
        numbers, exact = _numbers(value, kind)
        odd = F.isnan(value) if isinstance(kind, FractionalType) and not isinstance(kind, DecimalType) else F.lit(False)
        kept = [F.when(value.isNull(), 0.0).when(odd, 2.0).otherwise(1.0), *[F.when(value.isNull() | odd, 0.0).otherwise(n) for n in numbers]]
        found += [-n for n in kept] if down else kept
        if not exact:
            break
    return found


def _numbers(value: Column, kind: DataType) -> tuple[list[Column], bool]:
    """Doubles that rise with ``value``, and whether different values always differ in them."""
    if isinstance(kind, (StringType, CharType, VarcharType)):
        part = lambda at: F.conv(F.rpad(F.hex(F.substring(F.encode(value, "utf-8"), at, 6)), 12, "0"), 16, 10).cast("double")
        return [part(1), part(7)], False
    if isinstance(kind, TimestampNTZType):
        clock = F.hour(value) * 3600 + F.minute(value) * 60 + F.extract(F.lit("SECOND"), value).cast("double")
        return [F.unix_date(value.cast("date")).cast("double"), clock], True
    if isinstance(kind, (LongType, TimestampType)):
        whole = F.unix_micros(value) if isinstance(kind, TimestampType) else value
        return [F.shiftright(whole, 32).cast("double"), whole.bitwiseAND(F.lit((1 << 32) - 1)).cast("double")], True
    if isinstance(kind, DateType):
        return [F.unix_date(value).cast("double")], True
    if isinstance(kind, (IntegralType, BooleanType, FloatType, DoubleType)):
        return [value.cast("double")], True
    return ([value.cast("double")] if isinstance(kind, DecimalType) else []), False


class OrderedGroups:
    """``df`` grouped by ``keys`` and ordered by ``order``.

    ``cut`` is a numeric expression that never decreases along ``order``: ``rising`` or ``falling`` of the first order key (or
    of its epoch value). Rows with equal ``cut`` always share a slice, so ties are never torn apart. A list, as of ``places``, is compared
    number by number: with it a group is also cut among rows that are equal in the first order key.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[Column], cut: Column | Sequence[Column],
                 share: int = SHARE, slices: int = SLICES, least: int = LEAST):
        self.keys, self.order = list(keys), list(order)
        single = isinstance(cut, Column)
        self._empty = F.array().cast("array<array<double>>" if single else "array<array<array<double>>>")
        base = df.withColumn("_cut", rising(cut) if single else F.array(*[rising(c) for c in cut]))
        total = base.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
        # the block that holds the bound, then the bound within it
        at = F.size(F.filter("_marks", lambda block: block[0] < F.col("_cut")))
        inside = F.size(F.filter(F.get("_marks", at - 1), lambda m: m < F.col("_cut")))
        slice_of = F.when(at == 0, F.lit(0)).otherwise((at - 1) * BLOCK + inside)
        if not self.keys:
            # everything is one group: its slice bounds are a single value, no join needed
            marks = self._cut_points(base.withColumn("_n", total), total, slices, least).select("_marks").scalar()
            marks = F.coalesce(marks, self._empty)
            self.sliced = base.withColumn("_marks", marks).withColumn(SLICE, slice_of).drop("_marks")
        else:
            hot = (base.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("_n"))
                   .where((F.col("_n") * share > total) & (F.col("_n") > least)))
            inner = base.alias("b").join(F.broadcast(hot.alias("h")), _same_pair(self.keys, "b", "h"))
            splits = self._cut_points(inner.select("b.*", "h._n"), total, slices, least)
            self.sliced = (
                base.alias("b")
                .join(F.broadcast(splits.alias("s")), _same_pair(self.keys, "b", "s"), "left")
                .withColumn(SLICE, F.when(F.col("_marks").isNull(), F.lit(-1)).otherwise(slice_of))
                .select(*[F.col(f"b.{c}").alias(c) for c in base.columns], SLICE))
        self.local = Window.partitionBy(*self.keys, SLICE).orderBy(*self.order)
        # runs over per-slice rows only, at most SHARE + SLICES of them
        self._chain = Window.partitionBy(*self.keys).orderBy(SLICE)

    def _cut_points(self, rows: DataFrame, total: Column, slices: int, least: int) -> DataFrame:
        """Ascending slice bounds per group in blocks, from about ``DRAW`` of its ``_n`` rows per slice.

        The sample is picked by row hash, so evaluating this plan again -- for another branch, or after a lost
        executor -- yields the very same bounds, which offsets and local numbers both depend on.
        """
        hashed = [f.name for f in rows.schema.fields if not isinstance(f.dataType, (MapType, VariantType))]
        pieces = F.ceil(F.least(F.col("_n") * F.lit(float(slices)) / total, F.greatest(F.col("_n") / max(least / 8, 1), F.lit(8.0)))).cast("int")
        rows = rows.withColumn("_pieces", F.greatest(pieces, F.lit(2)))
        draw = F.pmod(F.xxhash64(*hashed), F.lit(1 << 30)) < F.col("_pieces") * F.lit(float(DRAW << 30)) / F.col("_n")
        bounds = F.transform(F.sequence(F.lit(1), F.col("_pieces") - 1),
                             lambda i: F.get("_p", F.floor(F.size("_p") * i / F.col("_pieces")).cast("int")))
        marks = F.array_distinct(F.filter(bounds, lambda m: m.isNotNull()))
        blocks = F.when(F.size("_m") > 0, F.transform(F.sequence(F.lit(0), F.floor((F.size("_m") - 1) / BLOCK).cast("int")), lambda i: F.slice("_m", i * BLOCK + 1, BLOCK)))
        return (rows.where(draw).groupBy(*self.keys).agg(F.array_sort(F.collect_set("_cut")).alias("_p"), F.first("_pieces").alias("_pieces"))
                .select(*self.keys, marks.alias("_m")).select(*self.keys, F.coalesce(blocks, self._empty).alias("_marks")))

    def _per_slice(self, *aggs: Column) -> DataFrame:
        """One row per (cut group, slice); groups that were not cut need no stitching."""
        return self.sliced.where(F.col(SLICE) >= 0).groupBy(*self.keys, SLICE).agg(*aggs)

    def _stitch(self, left: DataFrame, bounds: DataFrame) -> DataFrame:
        on = [*self.keys, SLICE]
        extra = [c for c in bounds.columns if c not in on]
        return (left.alias("l").join(F.broadcast(bounds.alias("o")), _same_pair(on, "l", "o"), "left")
                .select("l.*", *[F.col(f"o.{c}").alias(c) for c in extra]))

    def _tidy(self, df: DataFrame) -> DataFrame:
        return df.drop(SLICE, "_cut", "_before", "_next", "_last")

    def _offsets(self, weight: Column) -> DataFrame:
        before = F.sum("_w").over(self._chain.rowsBetween(Window.unboundedPreceding, -1))
        return self._per_slice(weight.alias("_w")).withColumn("_before", F.coalesce(before, F.lit(0))).drop("_w")

    def _numbered(self, fn: Column, out: str) -> DataFrame:
        local = self.sliced.withColumn(out, fn.cast("bigint"))
        done = self._stitch(local, self._offsets(F.count(F.lit(1))))
        return done.withColumn(out, F.col(out) + F.coalesce("_before", F.lit(0)))

    def row_number(self, out: str = "rn") -> DataFrame:
        return self._tidy(self._numbered(F.row_number().over(self.local), out))

    def rank(self, out: str = "rk") -> DataFrame:
        """Rank with ties; equal values share a slice, so the local rank plus the offset is the global one."""
        return self._tidy(self._numbered(F.rank().over(self.local), out))

    def running_sum(self, value: str, out: str) -> DataFrame:
        """Sum of ``value`` over all rows up to and including this one."""
        run = F.sum(value).over(self.local.rowsBetween(Window.unboundedPreceding, 0))
        done = self._stitch(self.sliced.withColumn(out, run), self._offsets(F.sum(value)))
        return self._tidy(done.withColumn(out, F.col(out) + F.coalesce("_before", F.lit(0))))

    def running_max(self, value: str, out: str) -> DataFrame:
        """Maximum of ``value`` over all earlier rows (null for the first)."""
        span = self.local.rowsBetween(Window.unboundedPreceding, -1)
        before = F.max("_m").over(self._chain.rowsBetween(Window.unboundedPreceding, -1))
        bounds = self._per_slice(F.max(value).alias("_m")).withColumn("_before", before).drop("_m")
        done = self._stitch(self.sliced.withColumn(out, F.max(value).over(span)), bounds)
        return self._tidy(done.withColumn(out, F.greatest(out, "_before")))

    def step(self, value: str, out: str, number: str | None = None, back: bool = False) -> DataFrame:
        """The neighbouring row's ``value``: the next one, or the previous one with ``back``."""
        move = F.lag if back else F.lead
        local = (self.sliced.withColumn(out, move(value).over(self.local))
                 .withColumn("_last", move(F.lit(True)).over(self.local).isNull()))
        if number:
            local = local.withColumn(number, F.row_number().over(self.local).cast("bigint"))
        # the edge row of each slice, found by an aggregate with map-side combine
        pos = F.struct(*[F.col(f"_o{i}") for i in range(len(self.order))])
        edged = self.sliced.where(F.col(SLICE) >= 0)
        for i, o in enumerate(self.order):
            edged = edged.withColumn(f"_o{i}", o)
        pick = F.max_by if back else F.min_by
        edges = edged.groupBy(*self.keys, SLICE).agg(
            pick(F.struct(F.col(value).alias("v")), pos).alias("_edge"), F.count(F.lit(1)).alias("_w"))
        before = F.sum("_w").over(self._chain.rowsBetween(Window.unboundedPreceding, -1))
        bounds = (edges.withColumn("_next", move("_edge").over(self._chain))
                  .withColumn("_before", F.coalesce(before, F.lit(0))).drop("_edge", "_w"))
        done = self._stitch(local, bounds)
        done = done.withColumn(out, F.when(F.col("_last"), F.col("_next.v")).otherwise(F.col(out)))
        if number:
            done = done.withColumn(number, F.col(number) + F.coalesce("_before", F.lit(0)))
        return self._tidy(done)


def _same_pair(keys: Sequence[str], a: str, b: str) -> Column:
    cond = None
    for k in keys:
        one = F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
        cond = one if cond is None else cond & one
    return cond

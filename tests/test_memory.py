"""Visitor memory: merged levels, pruned files, forgotten visitors, repeated batches."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemill.session import fresh_path
from tidemill.streaming import memory as m
from tidemill.streaming.memory import VisitorMemory

START = dt.date(2025, 7, 1)
SHAPE = "mid string, memory date, first date, last date"


def day(n):
    return START + dt.timedelta(days=n)


def batch_of(spark, rows):
    """rows: (mid, first day, last day, was new)."""
    return spark.createDataFrame([(mid, day(a if new else a - 1), day(a), day(b)) for mid, a, b, new in rows], SHAPE).coalesce(1)


@pytest.mark.parametrize("keep", [None, 3])
def test_equals_a_dictionary_over_merged_levels(spark, monkeypatch, keep):
    monkeypatch.setattr(m, "FANOUT", 2)
    path, draw = fresh_path(spark, "memory"), random.Random(7)
    model = {}
    for n in range(9):
        rows = [(mid, n + draw.randint(-1, 0), n, draw.random() < 0.5) for mid in "abcdefgh" if draw.random() < 0.4]
        want = {}
        for mid, a, b, new in rows:
            memory, seen = model.get(mid, (None, None))
            if memory is None or (keep is not None and a - seen > keep):
                memory = a if new else a - 1
            model[mid] = (memory, max(b, b if seen is None else seen))
            want[mid] = day(memory)
        for _ in range(2 if n in (4, 5) else 1):  # a repeated batch answers the same
            got = VisitorMemory(spark, path, keep).update(batch_of(spark, rows), n)
            assert {r.mid: r.memory for r in got.collect()} == want, n
    kept = {(int(a.split("=")[1]), int(b.split("=")[1])) for a in os.listdir(path) for b in os.listdir(f"{path}/{a}")}
    assert set(VisitorMemory.parts(9)) <= kept and (0, 3) not in kept and (1, 1) not in kept


def test_only_the_buckets_of_the_batch_are_read(spark, monkeypatch):
    monkeypatch.setattr(m, "FANOUT", 2)
    path = fresh_path(spark, "memory")
    memory = VisitorMemory(spark, path, None)
    for n in range(4):
        memory.update(batch_of(spark, [(f"v{i}", n, n, True) for i in range(200)]), n)
    memory.merge_due(4)
    one = batch_of(spark, [("v7", 9, 9, True)])
    pruned, whole = memory.candidates(one, 4), memory._read(memory.parts(4))
    assert memory.parts(4) == [(2, 0)] and len(whole.inputFiles()) == 16
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert pruned.select(F.input_file_name()).distinct().count() == 1
    assert pruned.where("mid = 'v7'").count() == 1
    assert [r.memory for r in memory.update(one, 4).collect()] == [day(0)]


def test_numbers_of_parts_and_merges():
    assert VisitorMemory.parts(0) == [] and VisitorMemory.merges(0) == []
    for n in range(1, 700):
        covered = sorted(b for level, part in VisitorMemory.parts(n) for b in range(part * 16 ** level, (part + 1) * 16 ** level))
        assert covered == list(range(n)) and len(VisitorMemory.parts(n)) <= 15 * 3
    assert VisitorMemory.merges(256) == [(1, 15), (2, 0)]

"""The pipeline stage by stage against brute force, and the registered queries against their SQL."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from llm_rows import shingles
from registry.check import compare, connect
from tidemill.llm import queries


@pytest.mark.parametrize("key", sorted(queries.SQL))
def test_matches_sql(spark, sf_dir, key):
    ok, note = compare(spark, connect(sf_dir), sf_dir, queries.QUERIES[key], queries.SQL[key])
    assert ok, note


def test_registered():
    assert set(queries.QUERIES) <= set(driver.queries()) and set(queries.SQL) <= set(driver.oracle_sql())
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in queries.QUERIES if k.startswith("op")) == list(range(1, 14)) and "pipeline" in queries.QUERIES


def test_stages(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")  # the smallest tables have too few labels
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    stage = dict(corpus_pipeline.STAGES)
    good = stage["quality"](spark, docs, sf_dir).cache()
    junk = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 0").collect()}
    fine = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").collect()}
    left = {r.doc_id for r in good.collect()}
    assert len(left & junk) <= 0.1 * len(junk) and len(left & fine) >= 0.97 * len(fine)

    unique = stage["exact_dedup"](spark, good, sf_dir).cache()
    seen = {}
    for r in sorted(good.collect(), key=lambda r: r.doc_id):
        seen.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text), r.doc_id)
    rows = unique.collect()
    assert sorted(r.doc_id for r in rows) == sorted(seen.values())

    near = {r.doc_id for r in stage["near_dedup"](spark, unique, sf_dir).collect()}
    sets = {r.doc_id: shingles(r.text, 5) for r in rows}
    top = {d: d for d in sets}
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = a, b
                while top[x] != x:
                    x = top[x]
                while top[y] != y:
                    y = top[y]
                top[max(x, y)] = min(x, y)
    assert near == {d for d in ids if top[d] == d}

    clean = stage["decontamination"](spark, unique.where(F.col("doc_id").isin(list(near))), sf_dir).cache()
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    words = lambda t: " " + " ".join(re.findall(r"\w+", t.lower())) + " "
    leaking = {r.doc_id for r in rows if r.doc_id in near and any(words(t) in words(r.text) for t in items)}
    assert {r.doc_id for r in clean.collect()} == near - leaking
    assert clean.columns == docs.columns
    out = stage["bpe"](spark, clean, sf_dir)
    assert out.count() == clean.count() and names == ["quality", "exact_dedup", "near_dedup", "decontamination", "bpe"]


def test_stages_on_no_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        assert out.count() == 0

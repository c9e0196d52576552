"""Exact and near-duplicates against brute force, and the index over several batches."""

import hashlib
import random
import re

import pytest

from llm_rows import ODD, make, shingles
from tidemill.llm import exact_dedup, minhash
from tidemill.session import fresh_path


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def test_exact_odd_rows(odd):
    got = exact_dedup.decisions(odd).collect()
    assert len(got) == len(ODD)
    groups = {}
    for i, t in ODD:
        groups.setdefault(norm(t), []).append(i)
    by_digest = {hashlib.sha256(k.encode()).digest(): v for k, v in groups.items()}
    for r in got:
        members = by_digest[bytes(r.digest)]
        assert r.group_size == len(members) and r.keep_id == min((m for m in members if m is not None), default=None)
    assert sum(r.kept for r in got) == len(groups)


def test_exact_keeps_columns_and_one_of_equal_rows(odd):
    out = exact_dedup.drop_copies(odd)
    assert out.columns == odd.columns
    assert sorted(r.doc_id for r in out.collect()) == [1, 3, 5, 6, 7, 8, 9, 10, 12]


def test_exact_empty(none):
    assert exact_dedup.decisions(none).count() == 0 and exact_dedup.drop_copies(none).count() == 0


def test_index_continues_over_batches(spark):
    path = fresh_path(spark, "test-index")
    index = exact_dedup.DigestIndex(spark, path, 4)
    first = exact_dedup.add_batch(index, make(spark, [(5, "a"), (6, "b")]))
    assert {(r.id, r.keep_id, r.kept) for r in first.collect()} == {(5, 5, True), (6, 6, True)}
    again = exact_dedup.DigestIndex(spark, path, 4)
    second = exact_dedup.add_batch(again, make(spark, [(1, "a"), (2, "c"), (3, "c")]))
    assert {(r.id, r.keep_id, r.kept) for r in second.collect()} == {(1, 5, False), (2, 2, True), (3, 2, False)}
    assert again.rows().count() == 3
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = again.rows().groupBy("digest").count()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan  # the buckets are the partitioning


def test_repeated_batches_get_the_same_answer(spark):
    """Three batches, each sent again: at once, after a stop that lost the result, and after later batches."""
    index = exact_dedup.DigestIndex(spark, fresh_path(spark, "test-index"), 3)
    batches = [[(5, "a"), (6, "b"), (6, "b"), (None, "n")], [(1, "a"), (2, "c"), (3, "c"), (None, "n")], [(9, "b"), (6, "b"), (2, "c"), (10, "d"), (10, "d")]]

    def answer(batch, read=True):
        out = exact_dedup.add_batch(index, make(spark, batch))
        return sorted(((r.id, r.keep_id, r.kept, r.group_size) for r in out.collect()), key=str) if read else None

    answer(batches[0], read=False)  # appended, but the result is lost
    first = [answer(b) for b in batches]
    assert first[0] == sorted([(5, 5, True, 1), (6, 6, False, 2), (6, 6, True, 2), (None, None, True, 1)], key=str)
    assert first[1] == sorted([(1, 5, False, 1), (2, 2, True, 2), (3, 2, False, 2), (None, None, True, 1)], key=str)
    assert first[2] == sorted([(9, 6, False, 2), (6, 6, True, 2), (2, 2, True, 1), (10, 10, False, 2), (10, 10, True, 2)], key=str)
    assert [answer(b) for b in batches] == first and index.rows().count() == 5


def brute(rows, k, percent=80):
    sets = [shingles(t, k) for _, t in rows]
    top = list(range(len(rows)))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                top[root(a)] = root(b)
    best = {}
    for i, (d, _) in enumerate(rows):
        best.setdefault(root(i), []).append(d)
    return sorted(((d, len(sets[i]), min((x for x in best[root(i)] if x is not None), default=None)) for i, (d, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("k", [2, 5])
def test_near_odd_rows(spark, odd, k):
    got = minhash.near_duplicates(odd, shingle=k).collect()
    assert sorted(((r.id, r.n, r.component_id) for r in got), key=str) == brute(ODD, k)
    out = minhash.drop_near_duplicates(odd, shingle=k)
    assert out.columns == odd.columns


def test_near_empty(none):
    assert minhash.near_duplicates(none).count() == 0 and minhash.drop_near_duplicates(none).count() == 0


def test_near_against_brute_force(spark):
    """Small sets, chains, borderline similarities, a crowded group with strays, and one common passage."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for size in (1, 2, 3, 4, 5, 6, 9, 12, 20, 60, 150):
        for _ in range(4):
            base = [rng.choice(words) for _ in range(size)]
            for copy in range(5):
                text = list(base)
                for _ in range(rng.randrange(0, 2 + size // 8)):
                    text[rng.randrange(len(text))] = rng.choice(words)
                rows.append((n := n + 1, " ".join(text)))
    base = [rng.choice(words) for _ in range(90)]
    for copy in range(120):  # more members than a short list, some of them too far from the first
        text = list(base)
        for _ in range(rng.randrange(0, 9)):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((n := n + 1, " ".join(text)))
    passage = " ".join(rng.choice(words) for _ in range(40))
    rows += [(n := n + 1, passage + " " + " ".join(rng.choice(words) for _ in range(25))) for _ in range(60)]
    rng.shuffle(rows)
    got = minhash.near_duplicates(make(spark, rows), shingle=2).collect()
    assert sorted(((r.id, r.n, r.component_id) for r in got), key=str) == brute(rows, 2)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.component_id for r in got}) and all(r.id == r.component_id for r in kept)


def test_cells_split_large_groups(spark, monkeypatch):
    monkeypatch.setattr(minhash, "TEXTS", 7)
    monkeypatch.setattr(minhash, "SHORT", 3)
    rng = random.Random(5)
    base = [f"w{rng.randrange(300)}" for _ in range(80)]
    rows = []
    for i in range(70):
        text = list(base)
        for _ in range(rng.randrange(0, 12)):
            text[rng.randrange(len(text))] = f"x{rng.randrange(50)}"
        rows.append((i, " ".join(text)))
    got = minhash.near_duplicates(make(spark, rows), shingle=2).collect()
    assert sorted(((r.id, r.n, r.component_id) for r in got), key=str) == brute(rows, 2)


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.node: r.comp for r in minhash.components(edges).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[101] == got[100] == 100


def test_components_write_two_tables_a_round(spark, monkeypatch):
    written, settled = [], minhash.settled
    monkeypatch.setattr(minhash, "settled", lambda df, label: written.append(label) or settled(df, label))
    edges = lambda rows: spark.createDataFrame(rows, "a long, b long")
    assert {(r.node, r.comp) for r in minhash.components(edges([(0, i) for i in range(1, 9)])).collect()} == {(i, 0) for i in range(9)}
    assert written == ["large"]  # a star is seen to be done
    assert {(r.node, r.comp) for r in minhash.components(edges([(9, 5), (9, 2), (5, 7), (3, 3)])).collect()} == {(i, 2) for i in (2, 5, 7, 9)}
    assert written[1:] == ["large", "stars"] * (len(written) // 2 - 1) + ["large"]
    assert minhash.components(edges([])).count() == 0


def test_near_copies_of_lower_similarity(spark):
    # texts 2i and 2i + 1 share 6 of 16 words, 37.5 %
    rows = [(i, " ".join([f"s{i // 2}x{j}" for j in range(6)] + [f"o{i}x{j}" for j in range(5)])) for i in range(60)]
    got = {r.id: r.component_id for r in minhash.near_duplicates(make(spark, rows), shingle=1, percent=35).collect()}
    assert got == {i: i // 2 * 2 for i in range(60)}
    with pytest.raises(ValueError):
        minhash.near_duplicates(make(spark, rows), percent=20)


def test_near_duplicates_keeps_only_what_its_result_reads(spark, monkeypatch):
    """The tables between the steps and their shuffles are removed as soon as nothing reads them."""
    import pathlib

    made, write = [], minhash.settled
    monkeypatch.setattr(minhash, "settled", lambda df, label: made.append(write(df, label)) or made[-1])
    rng = random.Random(4)
    base = [" ".join(rng.choice("abcdefghij") * 3 + str(rng.randrange(50)) for _ in range(60)) for _ in range(12)]
    texts = [" ".join([*b.split()[:-k], *(f"w{k}{j}" for j in range(k))]) if k else b for b in base for k in range(4)]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    paths = [pathlib.Path(df.settled_at.removeprefix("file:")) for df in made]
    left = {p.name.rsplit("-", 1)[0] for p in paths if p.exists()}
    assert len(left) < len({p.name.rsplit("-", 1)[0] for p in paths}) and left <= {"sketches", "components", "large", "more"} and spark.conf.get(
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
    assert len({r.component_id for r in got.collect()}) == 12 and got.count() == 48

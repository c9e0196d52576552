"""Dictionary segmentation against a search over all paths and against a plain dynamic program."""

import functools
import math

from pyspark.sql import functions as F

from tidemill.functions import segment, text


def cheapest(run, cost):
    """(cost, words) by recursion over all words at a place; of equal costs the longest word first."""
    @functools.cache
    def best(at):
        if at == len(run):
            return 0, ()
        ways = [(segment.UNKNOWN + best(at + 1)[0], -1)]
        ways += [(cost[run[at:at + k]] + best(at + k)[0], -k) for k in range(1, len(run) - at + 1) if run[at:at + k] in cost]
        total, minus = min(ways)
        return total, (run[at:at - minus], *best(at - minus)[1])

    return best(0)


def test_every_run_of_the_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    every = docs.select(F.explode(text.words(F.col("text"))).alias("word")).where(F.length("word").between(2, 6))
    dictionary = every.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where("n >= 10").cache()
    rows = {r.word: r.n for r in dictionary.collect()}
    cost = {w: math.floor(1000 * math.log(sum(rows.values()) / n)) for w, n in rows.items()}
    runs = docs.select(F.explode(text.words(F.col("text"))).alias("run")).distinct().limit(3000).cache()
    got = segment.segmented_runs(runs, dictionary, 6).collect()
    assert len(got) == runs.count()
    assert all(tuple(r.words) == cheapest(r.run, cost)[1] for r in got)


def test_odd_texts_and_ties(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "abcab ab"), (4, "中国人民 x中国"), (5, "abab"), (6, "q" * 60), (5, "abab")], "id int, t string")
    dictionary = spark.createDataFrame([("ab", 5), ("c", 1), ("abab", 5), ("中国", 4), ("国人", 4), ("人民", 4), ("", 3), (None, 2), ("zz", 0), ("ab", 5)], "word string, n int")
    got = {}
    for r in segment.segmented(docs, "t", dictionary, 4).groupBy("id").agg(F.sort_array(F.collect_list("keyword")).alias("k")).collect():
        got[r.id] = r.k
    assert got == {3: ["ab", "ab", "ab", "c"], 4: sorted(["中国", "人民", "x", "中国"]), 5: ["abab", "abab"], 6: ["q"] * 60}
    assert segment.segmented(docs, "t", dictionary.limit(0), 4).where("id = 3").count() == 7
    # two words of half the cost against one long word: equal costs, the longest wins
    even = spark.createDataFrame([("ab", 100), ("cd", 100), ("abcd", 1), ("pad", 9799)], "word string, n int")
    assert [r.words for r in segment.segmented_runs(spark.createDataFrame([("abcd",)], "run string"), even, 4).collect()] == [["abcd"]]

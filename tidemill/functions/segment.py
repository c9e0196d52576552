"""Dictionary segmentation: a run of letters as the cheapest sequence of dictionary words.

The lattice of a run has an edge for every dictionary word in it, and one of a single character at every place. A word costs the logarithm of its
rarity, a character of no word ``UNKNOWN``; the path of least cost is found by dynamic programming from the end of the run, folded by
higher-order functions; of equal costs the longest word wins. Distinct runs are segmented once, however often they occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.text import words

UNKNOWN = 20_000  # cost of a character that no word covers, in thousandths of a nat


def costs(dictionary: DataFrame, word: str = "word", n: str = "n") -> DataFrame:
    """(word, cost): 1000 ln(total / occurrences), rounded down; of repeated words the occurrences are added. Null, empty and unseen
    words are no words."""
    known = dictionary.select(F.col(word).alias("word"), F.col(n).alias("n")).where((F.length("word") > 0) & (F.col("n") > 0))
    counts = known.groupBy("word").agg(F.sum("n").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.join(total).select("word", F.floor(1000 * F.ln(F.col("total") / F.col("n"))).cast("long").alias("cost"))  # one row of totals


def best_path(run: Column, edges: Column, longest: int) -> Column:
    """array<string>: the words of the cheapest path. ``edges``: map from a start (from 0) to its array<struct<cost: bigint, size: int>>.

    The state holds the cost from each of the next ``longest`` places to the end, nearest first, and the chosen sizes from the current place on."""
    n = F.length(run)
    start = F.struct(F.array(F.lit(0).cast("bigint")).alias("ahead"), F.array().cast("array<int>").alias("sizes"))

    def step(state: Column, back: Column) -> Column:
        at = n - back
        one = F.struct((F.lit(UNKNOWN) + F.get(state.ahead, F.lit(0))).cast("bigint").alias("cost"), F.lit(-1).alias("minus"))
        words_here = F.coalesce(F.try_element_at(edges, at), F.array().cast("array<struct<cost:bigint,size:int>>"))
        ways = F.transform(words_here, lambda e: F.struct((e.cost + F.get(state.ahead, e["size"] - 1)).cast("bigint").alias("cost"), (-e["size"]).alias("minus")))
        best = F.array_min(F.concat(F.array(one), ways))  # the least cost, then the longest
        return F.transform(F.array(best), lambda b: F.struct(F.slice(F.concat(F.array(b.cost), state.ahead), 1, longest).alias("ahead"),
                                                             F.concat(F.array(-b.minus), state.sizes).alias("sizes")))[0]

    sizes = F.aggregate(F.sequence(F.lit(1), n), start, step, lambda s: s.sizes)
    cut = F.struct(F.lit(1).alias("at"), F.array().cast("array<string>").alias("words"), F.lit(1).alias("place"))

    def take(state: Column, size: Column) -> Column:
        here = state.at == state.place
        return F.struct(F.when(here, state.at + size).otherwise(state.at).alias("at"),
                        F.when(here, F.concat(state.words, F.array(F.substr(run, state.at, size)))).otherwise(state.words).alias("words"), (state.place + 1).alias("place"))

    return F.when(n > 0, F.aggregate(sizes, cut, take, lambda s: s.words)).otherwise(F.array().cast("array<string>"))


def segmented_runs(runs: DataFrame, dictionary: DataFrame, longest: int, run: str = "run") -> DataFrame:
    """(run, words) of distinct runs. Every part of a run of up to ``longest`` characters meets the dictionary by an equi-join."""
    distinct = runs.select(F.col(run).alias("run")).where(F.length("run") > 0).distinct()
    at = distinct.select("run", F.explode(F.sequence(F.lit(0), F.length("run") - 1)).alias("at"))
    parts = at.select("run", "at", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.length("run") - F.col("at")))).alias("size"))
    found = parts.withColumn("word", F.substr("run", F.col("at") + 1, F.col("size"))).join(costs(dictionary), "word")
    starts = found.groupBy("run", "at").agg(F.collect_list(F.struct("cost", "size")).alias("ways"))  # at most ``longest`` each
    edges = starts.groupBy("run").agg(F.map_from_entries(F.collect_list(F.struct("at", "ways"))).alias("edges"))
    none = F.create_map().cast("map<int,array<struct<cost:bigint,size:int>>>")
    whole = distinct.join(edges, "run", "left")
    return whole.select("run", best_path(F.col("run"), F.coalesce("edges", none), longest).alias("words"))


def segmented(df: DataFrame, col: str, dictionary: DataFrame, longest: int, out: str = "keyword") -> DataFrame:
    """One row per dictionary word or uncovered character of every letter or digit run of ``col``, the table-function form; null and empty
    texts give none."""
    rows = df.withColumn("_run", F.explode(words(F.col(col))))
    table = segmented_runs(rows, dictionary, longest, "_run").select(F.col("run").alias("_run"), "words")
    return rows.join(table, "_run").withColumn(out, F.explode("words")).drop("_run", "words", col)

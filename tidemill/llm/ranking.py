"""Ranked lexical search: the highest-scoring documents of every query text, by norm buckets.

A document is a vector of impacts, one per term, a query a vector of counts; the score is their product. Documents are ordered by the
length of their vectors and searched in rounds, longest first. By Cauchy-Schwarz a document scores at most the product of both lengths, so
once a query has ``top`` results, buckets of vectors too short to reach the last of them are passed over for it, and vectors too short for
every query are not read at all. Within a bucket the coordinates of a query are taken exactly, some at a time, those that can matter most
first; the others are bounded by Cauchy-Schwarz over what is left of both vectors and by their largest values in the bucket. When no document
can enter the result any more the query leaves the bucket; else all its coordinates are taken, in 64-bit integers, and the scores are
exact. Bounds are rounded up, so no result is lost.

Queries are taken in blocks of bounded size; documents are counted, weighed and ordered once per block, over the block's terms.

Defined cases: null text has no terms; a document without terms counts for nothing, a query without terms finds nothing; repeated rows are
documents (or queries) of their own; of equal scores the smaller id comes first, null ids last; empty tables give no rows; extra
columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemill.llm import tokens
from tidemill.llm.common import q, ready
from tidemill.session import settled

TOP = 20
QUERIES, QUERY_BYTES = 2_000, 1 << 24  # per block, on average
HEAD, GROWTH = 64, 8  # the first round takes one in 64 documents, the next ones eight times as many
FOCUS = 4  # coordinates taken exactly before the rest is bounded again
BUCKET = 2_000
SURE = 1 + 1e-9  # above the rounding of bounds

_TERM = np.zeros(256, bool)
_TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def terms(texts: pa.Array) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """(first row, terms, offsets of each text's terms): runs of letters, digits and everything beyond ASCII, A-Z in lower case."""
    for low, _, data, bounds in tokens.chunks(texts):
        inside = _TERM[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        edge = bounds[:-1][bounds[:-1] < len(data)]
        begins[edge] = inside[edge]
        starts = np.flatnonzero(begins)
        before = np.concatenate([[0], np.cumsum(inside)]).astype(np.int64)
        found = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(before[starts], before[-1])), pa.py_buffer(tokens.LOWER[data[inside]]))
        yield low, found, np.searchsorted(starts, bounds)


def _lists(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(values))


class Block:
    """Some queries: the terms of all of them, and each one's terms with counts."""

    def __init__(self, rows: list[tuple[int, str | None]]):
        self.query = np.array([r[0] for r in rows], np.int64)
        words, first = [], [0]
        for _, found, ends in terms(pa.array([r[1] for r in rows], pa.string())):
            words.append(found.cast(pa.string()))
            first.extend((ends[1:] + first[-1]).tolist())
        coded = pa.chunked_array(words, pa.string()).combine_chunks().dictionary_encode()
        self.terms = coded.dictionary
        index = coded.indices.to_numpy()
        each = [np.unique(index[a:b], return_counts=True) for a, b in zip(first[:-1], first[1:])]
        self.term, self.count = [e[0] for e in each], [e[1] for e in each]
        self.norm = np.array([math.sqrt(float((c ** 2).sum())) for c in self.count])


class _Count:
    """Documents to (id, terms in all, the block's terms in it, how often)."""

    def __init__(self, vocabulary: pa.Array):
        self.vocabulary = vocabulary.cast(pa.large_string())

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = max(len(self.vocabulary), 1)
        for batch in batches:
            for low, found, first in terms(batch.column(1)):
                n = len(first) - 1
                code = pc.index_in(found, value_set=self.vocabulary)
                known = np.flatnonzero(code.is_valid())
                owner = np.searchsorted(first, known, "right") - 1
                cell, often = np.unique(owner * size + code.drop_null().to_numpy(), return_counts=True)
                ends = np.searchsorted(cell, np.arange(1, n + 1) * size)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, n), pa.array(np.diff(first).astype(np.int64)), _lists((cell % size).astype(np.int32), ends),
                                                  _lists(often.astype(np.int32), ends)], names=["id", "n", "terms", "often"])


def _holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per term of the task: the documents that hold it."""
    total = np.zeros(0, np.int64)
    for batch in batches:
        some = np.bincount(batch.column("terms").flatten().to_numpy(), minlength=len(total))
        some[:len(total)] += total
        total = some
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held].astype(np.int64))], names=["term", "df"])


class _Impact:
    """Counted documents to (id, norm, terms, impacts): a term's weight times its share, damped by the document's length."""

    def __init__(self, weight: np.ndarray, documents: int, length: int):
        self.weight, self.documents, self.length = weight, documents, length

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = batch.column("terms").offsets.to_numpy()
            ends = ends - ends[0]
            term, often = (batch.column(name).flatten().to_numpy().astype(np.int64) for name in ("terms", "often"))
            m = 100 - 25 + (25 * batch.column("n").to_numpy() * self.documents) // self.length
            impact = self.weight[term] * ((1_000_000_000 * often) // (1000 * often + 12 * np.repeat(m, np.diff(ends))))
            norm = np.sqrt(np.bincount(np.repeat(np.arange(batch.num_rows), np.diff(ends)), impact.astype(float) ** 2, batch.num_rows))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(norm), _lists(term.astype(np.int32), ends[1:]), _lists(impact, ends[1:])],
                                             names=["id", "norm", "terms", "impacts"])


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring batches joined: a bucket has some ``BUCKET`` documents of nearly the same length."""
    some: list[pa.RecordBatch] = []
    for batch in batches:
        some.append(batch)
        if sum(b.num_rows for b in some) >= BUCKET:
            yield pa.concat_batches(some)
            some = []
    if some:
        yield pa.concat_batches(some)


class _Search:
    """The best documents of a task for every query, as (query, id, score); ``least`` are scores below which a query needs none."""

    def __init__(self, block: Block, least: np.ndarray, top: int, kind: pa.DataType):
        self.block, self.least, self.top, self.kind = block, least, top, kind

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, least = self.block, self.least.copy()
        best: list[list[tuple]] = [[] for _ in block.query]
        some = np.array([len(t) > 0 for t in block.term], bool)
        for batch in _buckets(batches):
            norm = batch.column("norm").to_numpy()
            ends = batch.column("terms").offsets.to_numpy()
            ends = ends - ends[0]
            term, impact = (batch.column(name).flatten().to_numpy() for name in ("terms", "impacts"))
            owner = np.repeat(np.arange(len(norm)), np.diff(ends))
            order = np.argsort(term, kind="stable")
            by_term, doc, value = term[order], owner[order], impact[order]
            strength = value.astype(float) ** 2
            first = np.searchsorted(by_term, np.arange(len(block.terms) + 1))
            ceiling = np.zeros(len(block.terms))  # the largest impact of a term in the bucket
            np.maximum.at(ceiling, by_term, value)
            square = norm ** 2
            for i in np.flatnonzero(some & (block.norm * norm.max(initial=0) * SURE >= least)).tolist():
                mine, count = block.term[i], block.count[i].astype(float)
                reach = count * ceiling[mine]
                if reach.sum() * SURE < max(least[i], 1):
                    continue
                score, taken = np.zeros(len(norm), np.int64), np.zeros(len(norm))
                order, hope = np.argsort(-reach, kind="stable"), reach.sum()
                rest = float((count ** 2).sum())
                for f in range(0, len(order), FOCUS):
                    for k in order[f:f + FOCUS].tolist():
                        at = slice(first[mine[k]], first[mine[k] + 1])
                        score[doc[at]] += int(count[k]) * value[at]
                        taken[doc[at]] += strength[at]
                    hope -= reach[order[f:f + FOCUS]].sum()
                    rest -= (count[order[f:f + FOCUS]] ** 2).sum()
                    if hope < 1:
                        break
                    more = np.minimum(math.sqrt(max(rest, 0.0)) * np.sqrt(np.maximum(square * SURE - taken, 0)), hope)
                    if ((score + more) * SURE).max() < least[i]:
                        break
                else:
                    hope = 0.0
                if hope < 1:
                    best[i], least[i] = self._entered(score, batch.column("id"), best[i], least[i])
        rows = [(int(block.query[i]), ident, score) for i, found in enumerate(best) for score, ident in found]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], self.kind), pa.array([r[2] for r in rows], pa.int64())],
                                         names=["query", "id", "score"])

    def _entered(self, score: np.ndarray, ids: pa.Array, best: list[tuple], least: float) -> tuple[list[tuple], float]:
        """The best of a query with the documents of a bucket, and the score to reach from now on."""
        good = np.flatnonzero((score > 0) & (score >= least))
        if len(good) > self.top:
            good = good[score[good] >= np.partition(score[good], -self.top)[-self.top]]  # with all ties of the last
        best = best + [(int(score[g]), ids[int(g)].as_py()) for g in good]
        best.sort(key=lambda r: (-r[0], r[1] is None, r[1]))
        best = best[:self.top]
        return best, max(least, best[-1][0]) if len(best) == self.top else least


def _block(docs: DataFrame, block: Block, top: int) -> DataFrame:
    """(query, id, score): the ``top`` documents of each query of the block, and some that others beat."""
    kind = docs.schema["id"].dataType
    counted = settled(docs.mapInArrow(_Count(block.terms), f"id {kind.simpleString()}, n long, terms array<int>, often array<int>").where("n > 0"), "counted")
    size = counted.agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("n"), F.lit(1)).alias("length")).first()
    df = np.zeros(len(block.terms), np.int64)
    for r in counted.mapInArrow(_holders, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():  # the block's terms
        df[r.term] = r.df
    weight = np.array([math.floor(1000 * math.log((2 * size.documents + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
    vectors = counted.mapInArrow(_Impact(weight, size.documents, size.length), f"id {kind.simpleString()}, norm double, terms array<int>, impacts array<long>")
    # equal lengths are many where documents are copied: the hash cuts between them
    ordered = settled(vectors.where("norm > 0").repartitionByRange(F.desc("norm"), F.xxhash64("id", "terms")).sortWithinPartitions(F.desc("norm")), "by-norm")
    shares = [1 / HEAD * GROWTH ** n for n in range(64) if GROWTH ** n < HEAD]
    cuts = ordered.agg(F.percentile_approx("norm", F.array(*[F.lit(1 - x) for x in shares]), F.lit(1000)).alias("cuts")).first().cuts or []
    asked = block.norm > 0
    least, rounds, below = np.zeros(len(block.query)), [], float("inf")
    place = {int(x): i for i, x in enumerate(block.query)}
    for cut in [*cuts, 0.0]:
        needed = float((least[asked] / block.norm[asked]).min(initial=np.inf)) / SURE  # no shorter vector can enter any result
        part = ordered.where((F.col("norm") < below) & (F.col("norm") >= max(cut, needed)))
        rounds.append(settled(part.mapInArrow(_Search(block, least, top, to_arrow_type(kind)), f"query long, id {kind.simpleString()}, score long"), "round"))
        found, below = reduce(DataFrame.union, rounds), cut
        for r in ranked(found, top).where(F.col("rank") == top).select("query", "score").collect():  # one row per query of the block
            least[place[r.query]] = r.score
    return found


def ranked(found: DataFrame, top: int) -> DataFrame:
    """The ``top`` rows of each query, numbered; the limit is applied in each task before the exchange."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(docs: DataFrame, queries: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text", query_col: str = "item_id",
           query_text_col: str = "text") -> DataFrame:
    """(item, rank, id, score) of the ``top`` documents with a score above 0 for every query text."""
    ready(docs.sparkSession)
    plain = docs.select(q(id_col).alias("id"), q(text_col).cast("string").alias("text"))
    items = settled(queries.select(q(query_col).alias("item"), q(query_text_col).cast("string").alias("text"), F.monotonically_increasing_id().alias("query")), "queries")
    size = items.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    blocks = max(1, -(-size.n // QUERIES), -(-size.bytes // QUERY_BYTES))
    dealt = F.pmod(F.xxhash64("query"), F.lit(blocks))
    found = [_block(plain, Block(items.where(dealt == b).select("query", "text").collect()), top) for b in range(blocks)]
    return ranked(reduce(DataFrame.union, found), top).join(items.select("item", "query"), "query").select("item", "rank", "id", "score")

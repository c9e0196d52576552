"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)): all pairwise interactions in time
linear in the features. Features come from the text (hashed words, and bins of structure statistics) and from its stated
length; labels, language, source and ids are never features.

Defined cases: null text counts as empty; an empty text has only structure features and gets a score like any other; a null
or wrong stated length falls in a bin of its own; labels that are null are left out, of repeated labels for an id the
smallest counts; without any label every text scores 0.5; an empty table gives no rows; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm import tokens
from tidemill.llm.common import q, ready

SAMPLE = 8_000  # labelled rows to fit on, at most: those whose ids have the smallest hashes
WORD_BITS = 14  # words are hashed to so many bits
RANK = 8
THRESHOLD = 0.3
BINS = 12  # per structure statistic
STATS = 12
SIZE = (1 << WORD_BITS) + BINS * STATS

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_LETTER[128:] = True  # bytes of other letters, nearly always
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_MARK = np.zeros(256, bool)
_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def _sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return (total[bounds[1:]] - total[bounds[:-1]]).astype(float)


def _structure(w: tokens.Words, stated: np.ndarray, distinct: np.ndarray) -> np.ndarray:
    """A bin number per text and statistic."""
    size = np.maximum(np.diff(w.bounds), 1).astype(float)
    n = np.diff(w.first).astype(float)
    some = np.maximum(n, 1)
    letters = np.maximum(_sums(_LETTER[w.data], w.bounds), 1)
    again = np.zeros(len(w.hashes), bool)
    again[1:] = w.hashes[1:] == w.hashes[:-1]
    marked = _MARK[w.data[w.ends - 1]] if len(w.ends) else np.zeros(0, bool)
    twice = marked & (w.ends - w.starts > 1)
    twice[twice] = _MARK[w.data[w.ends[twice] - 2]]
    lonely = marked & (w.ends - w.starts == 1)
    length = _sums(w.data & 0xC0 != 0x80, w.bounds)
    ratios = [
        _sums(_UPPER[w.data], w.bounds) / letters, _sums(_MARK[w.data], w.bounds) / size * 4, _sums(_DIGIT[w.data], w.bounds) / size * 4,
        distinct / some, _sums(again, w.first) / some, _sums(twice, w.first) / some, _sums(lonely, w.first) / some,
        _sums(w.data == 10, w.bounds) / some * 4, np.minimum((letters / some) / 24, 1), _sums(_LETTER[w.data], w.bounds) / size,
    ]
    bins = [np.minimum((r * (BINS - 2)).astype(int) + (r > 0), BINS - 1) for r in ratios]
    bins.append(np.minimum(np.log2(n + 1), BINS - 1).astype(int))
    odd = np.abs(stated - length)
    bins.append(np.where(np.isnan(stated), 0, 1 + np.minimum(np.log2(np.nan_to_num(odd, nan=0.0) + 1), BINS - 2)).astype(int))
    return np.stack(bins, 1)


def features(texts: pa.Array, stated: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, row after the last, text, feature, value): the non-zero features of the texts, sorted by text."""
    for low, high, data, bounds in tokens.chunks(texts):
        w = tokens.words(data, bounds)
        slot = (w.hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64)
        cell, count = np.unique(w.owner() * (1 << WORD_BITS) + slot, return_counts=True)
        doc, word = cell >> WORD_BITS, cell & ((1 << WORD_BITS) - 1)
        value = np.log1p(count)
        norm = np.sqrt(np.bincount(doc, value ** 2, len(w)))
        value = value / norm[doc] if len(doc) else value
        bins = _structure(w, stated[low:high], np.bincount(doc, minlength=len(w)).astype(float))
        more = (1 << WORD_BITS) + np.arange(STATS) * BINS + bins
        owner = np.concatenate([doc, np.repeat(np.arange(len(w)), STATS)])
        order = np.argsort(owner, kind="stable")
        yield low, high, owner[order], np.concatenate([word, more.ravel()])[order], np.concatenate([value, np.full(more.size, 0.5)])[order]


@dataclass
class Machine:
    """Bias, weights and factors."""

    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def margin(self, n: int, doc: np.ndarray, slot: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the sigmoid, and the factor sums per text."""
        vx = self.factor[slot] * value[:, None]
        sums = np.stack([np.bincount(doc, vx[:, f], n) for f in range(RANK)], 1)
        squares = np.bincount(doc, (vx ** 2).sum(1), n)
        return self.bias + np.bincount(doc, self.weight[slot] * value, n) + 0.5 * ((sums ** 2).sum(1) - squares), sums

    def scores(self, texts: pa.Array, stated: np.ndarray) -> np.ndarray:
        out = np.zeros(len(texts))
        for low, high, doc, slot, value in features(texts, stated):
            out[low:high] = _sigmoid(self.margin(high - low, doc, slot, value)[0])
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Rows:
    """Labelled rows: those of ``label[i]`` are ``slot`` and ``value`` from ``first[i]`` to ``first[i + 1]``."""

    label: np.ndarray
    first: np.ndarray
    slot: np.ndarray
    value: np.ndarray

    def __len__(self) -> int:
        return len(self.label)

    def some(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, feature, value) of the given rows, in their order."""
        size = self.first[rows + 1] - self.first[rows]
        at = np.arange(size.sum()) + np.repeat(self.first[rows] - np.cumsum(size) + size, size)
        return np.repeat(np.arange(len(rows)), size), self.slot[at], self.value[at].astype(float)


def train(rows: Rows, epochs: int = 12, batch: int = 256, rate: float = 0.02, decay: float = 1e-4, seed: int = 5) -> Machine:
    """Fit on labelled rows by mini-batch Adam on the log loss."""
    rng = np.random.default_rng(seed)
    m = Machine(0.0, np.zeros(SIZE), rng.normal(0, 0.02, (SIZE, RANK)))
    if not len(rows):
        m.factor[:] = 0
        return m
    labels = rows.label.astype(float)
    m.bias = float(np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1)))
    size = SIZE * (RANK + 1)
    first, second, step = np.zeros(size), np.zeros(size), 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), batch):
            pick = order[at:at + batch]
            doc, slot, value = rows.some(pick)
            score, sums = m.margin(len(pick), doc, slot, value)
            error = (_sigmoid(score) - labels[pick]) / len(pick)
            pull = error[doc] * value
            grad = np.empty(size)
            grad[:SIZE] = np.bincount(slot, pull, SIZE) + decay * m.weight
            inner = sums[doc] - m.factor[slot] * value[:, None]
            for f in range(RANK):
                grad[SIZE * (f + 1):SIZE * (f + 2)] = np.bincount(slot, pull * inner[:, f], SIZE) + decay * m.factor[:, f]
            step += 1
            first = 0.9 * first + 0.1 * grad
            second = 0.999 * second + 0.001 * grad ** 2
            move = rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
            m.bias -= rate * float(error.sum())
            m.weight -= move[:SIZE]
            m.factor -= move[SIZE:].reshape(RANK, SIZE).T
    return m


def held_out(ident: Column) -> Column:
    """A fifth of the ids, never learned from; null ids belong to it."""
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _stated(column: pa.Array) -> np.ndarray:
    return column.cast(pa.float64()).to_numpy(zero_copy_only=False).astype(float)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(quality, features, values) of labelled texts."""
    for batch in batches:
        label = batch.column("quality").to_pylist()
        for low, high, doc, slot, value in features(batch.column("text"), _stated(batch.column("stated"))):
            cut = np.searchsorted(doc, np.arange(high - low + 1))
            yield pa.record_batch({"quality": pa.array(label[low:high], pa.int32()),
                                   "slot": pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(slot, pa.int32())),
                                   "value": pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(value, pa.float32()))})


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> Machine:
    """A machine from at most ``sample`` labelled rows that are not held out. Their features (not their texts) go to the driver."""
    ready(docs.sparkSession)
    known = (labels.where("quality is not null").select(q(id_col).alias("id"), F.col("quality").cast("int").alias("quality"))
             .where(~held_out(F.col("id"))).groupBy("id").agg(F.min("quality").alias("quality")))
    # at most ``sample`` pairs of integers: their size is bounded
    picked = F.broadcast(known.orderBy(F.xxhash64("id"), "id").limit(sample))
    stated = q(length_col).cast("double") if length_col in docs.columns else F.lit(None).cast("double")
    rows = docs.select(q(id_col).alias("id"), q(text_col).cast("string").alias("text"), stated.alias("stated")).join(picked, "id")
    got = rows.select("quality", "text", "stated").mapInArrow(_extract, "quality int, slot array<int>, value array<float>").toArrow()
    label, first, slot, value = (np.concatenate([np.zeros(0, kind), *parts]).astype(kind) for kind, parts in (
        (np.int32, [c.to_numpy() for c in got["quality"].chunks]), (np.int64, [np.diff(c.offsets.to_numpy()) for c in got["slot"].chunks]),
        (np.int32, [c.flatten().to_numpy() for c in got["slot"].chunks]), (np.float32, [c.flatten().to_numpy() for c in got["value"].chunks])))
    first = np.concatenate([[0], np.cumsum(first)])
    # the order of arrival must not matter: by label, number of features, and the first of these
    key = [(int(label[i]), int(first[i + 1] - first[i]), slot[first[i]:min(first[i] + 50, first[i + 1])].astype(">i4").tobytes()) for i in range(len(label))]
    return train(Rows(*_ordered(label, first, slot, value, np.array(sorted(range(len(key)), key=key.__getitem__), np.int64))))


def _ordered(label: np.ndarray, first: np.ndarray, slot: np.ndarray, value: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, ...]:
    """The rows in another order."""
    size = first[order + 1] - first[order]
    at = np.arange(size.sum()) + np.repeat(first[order] - np.cumsum(size) + size, size)
    return label[order], np.concatenate([[0], np.cumsum(size)]), slot[at], value[at]


def scorer(machine: Machine) -> Callable[..., Column]:
    """A column function (text, stated length) -> score."""
    @F.arrow_udf("double")
    def score(text: pa.Array, stated: pa.Array) -> pa.Array:
        return pa.array(machine.scores(text, _stated(stated)))

    return score


def scored(docs: DataFrame, labels: DataFrame, name: str = "score", sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
           length_col: str = "n_chars") -> DataFrame:
    """``docs`` with a score column."""
    machine = fit(docs, labels, sample, id_col, text_col, length_col)
    stated = q(length_col).cast("double") if length_col in docs.columns else F.lit(None).cast("double")
    return docs.withColumn(name, scorer(machine)(q(text_col).cast("string"), stated))

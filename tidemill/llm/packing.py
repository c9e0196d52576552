"""Best-fit packing: documents as token pieces, packed into as few sequences of a fixed capacity as possible.

Only the histogram of piece lengths reaches the driver: at most ``capacity`` numbers, whatever the corpus. Over it the configuration linear
program (a configuration: how many pieces of each length share one sequence; least sequences that cover the histogram) is solved by
multiplicative weights: every length has a weight, a knapsack dynamic program prices the heaviest configuration, which is taken in the
largest fraction that its scarcest length allows, and the weights of the lengths it covers fall. Fractions are rounded up as far as pieces
are left; the rest goes best-fit, longest first, into the gaps and then into new sequences. The plan is a list of (pattern, copies).

Pieces find their slots in parallel: the n-th piece of a length takes the n-th slot of that length. Numbers come from counts
per (task, length), so no length is gathered in one place.

Defined cases: null text counts as empty, which is the closing id alone; a document of over ``capacity`` tokens is cut into pieces
of that many, the last may be shorter; null ids and repeated rows are packed like any other row; an empty table gives no rows; extra
columns are not looked at. Strings of the tokenizer's special tokens are ordinary text.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm import tokens
from tidemill.llm.common import q, ready
from tidemill.session import settled

CAPACITY = 2048
CLOSING = 0  # the id that ends every document
BYTES = 1 << 22  # of text at once
STEPS = 40  # dynamic programs in one solution of the linear program
NEAR = 0.02  # configurations so close to the heaviest are taken in the same step
ROUNDS = 4  # solutions, each over what rounding left
RATE = 0.2  # how fast the weight of a covered length falls
NUMBER_BITS = 44  # pieces of one length: at most 2 ** 44

Configuration = tuple[tuple[int, int], ...]  # (number of the length, slots)
Pattern = tuple[tuple[int, int], ...]  # (length, slots), longest first


_LETTER, _DIGIT, _MARK, _ODD = 1, 2, 3, 4
_KIND = np.full(256, _ODD, np.uint8)
_KIND[33:127] = _MARK
_KIND[[*range(65, 91), *range(97, 123)]] = _LETTER
_KIND[48:58] = _DIGIT
_KIND[39] = _ODD  # contractions
_KIND[np.flatnonzero(tokens.SPACE)] = 0


@lru_cache(maxsize=1)
def _loaded(path: str):
    """(tokenizer, its model behind a split at white space, ids that end a word), once per worker."""
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    model = Tokenizer(whole.model)
    model.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
    vocabulary = whole.get_vocab()
    closes = np.zeros(max(vocabulary.values()) + 1, bool)
    closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
    return whole, model, closes


class _Cutter:
    """Texts to pieces. Every distinct word of some megabytes of text is encoded once, by the tokenizer.

    Stretches between white space are independent for the tokenizer. Those of ASCII and Latin-1 letters, digits and marks are cut and put in
    lower case here, as its rules say, and are encoded by its model alone; others go through all of its steps."""

    def __init__(self, path: str, capacity: int, with_ids: bool):
        self.path, self.capacity, self.with_ids = path, capacity, with_ids

    def _plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words and how many each has."""
        ids = np.array(self.model.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.int64)
        return ids, np.diff(np.flatnonzero(self.closes[ids]) + 1, prepend=0)

    def _odd(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words that the tokenizer may cut further: their ids are told apart by their places in the joined text."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        got = self.library.encode(" ".join(words), add_special_tokens=False)
        at = np.fromiter((a for a, _ in got.offsets), np.int64, len(got.ids))
        return np.array(got.ids, np.int64), np.bincount(np.searchsorted(np.cumsum(sizes + 1) - sizes - 1, at, "right") - 1, minlength=len(words))

    def _words(self, data: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The words, which of them are odd, and the first word of each text."""
        n, kind, low = len(data), _KIND[data], data.copy()
        after = np.zeros(n, bool)  # second bytes of Latin-1 letters
        after[1:] = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        kind[after] = _LETTER
        kind[:-1][after[1:]] = _LETTER
        low[((data >= 65) & (data <= 90)) | (after & (data <= 0x9E))] += 32
        inside = kind > 0
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        edge = bounds[:-1][bounds[:-1] < n]
        begins[edge] = inside[edge]
        stretch = np.cumsum(begins) - 1
        odd = np.bincount(stretch[kind == _ODD], minlength=int(begins.sum())) > 0
        plain = inside & ~odd[stretch] if n else inside
        cut = begins.copy()
        cut[1:] |= plain[1:] & ((kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT))
        starts = np.flatnonzero(cut)
        before = np.concatenate([[0], np.cumsum(inside)]).astype(np.int64)
        text = np.where(plain, low, data)[inside]
        words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(before[starts], before[-1])), pa.py_buffer(text))
        return words, ~plain[starts], np.searchsorted(starts, bounds)

    def documents(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of every text, the closing id included."""
        for _, _, data, bounds in tokens.chunks(texts, BYTES):
            words, odd, first = self._words(data, bounds)
            coded = words.dictionary_encode()
            index = coded.indices.to_numpy()
            strange = np.zeros(len(coded.dictionary), bool)
            strange[index] = odd
            order = np.concatenate([np.flatnonzero(~strange), np.flatnonzero(strange)])
            parts = [encode(coded.dictionary.filter(pa.array(mask)).to_pylist()) for encode, mask in ((self._plain, ~strange), (self._odd, strange)) if mask.any()]
            flat, size = (np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in (0, 1))
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            word = place[index]
            ids = _gathered(flat, size, word)
            ends = np.concatenate([[0], np.cumsum(size[word])])[first]
            for a, b in zip(ends[:-1], ends[1:]):
                yield np.append(ids[a:b], CLOSING).astype("<u4")

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        self.library, self.model, self.closes = _loaded(self.path)
        part, seen = TaskContext.get().partitionId(), np.zeros(self.capacity + 1, np.int64)
        for batch in _joined(batches):
            row, piece, start, length, crc, nth, ids = [], [], [], [], [], [], []
            for at, doc in enumerate(self.documents(batch.column(1))):
                for k, low in enumerate(range(0, len(doc), self.capacity)):
                    one = doc[low:low + self.capacity]
                    row.append(at), piece.append(k), start.append(low), length.append(len(one)), crc.append(zlib.crc32(one.tobytes())), nth.append(seen[len(one)])
                    seen[len(one)] += 1
                    if self.with_ids:
                        ids.append(one)
            columns = {"id": batch.column(0).take(pa.array(row, pa.int64())), "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()),
                       "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()), "part": pa.array([part] * len(row), pa.int32()), "nth": pa.array(nth, pa.int64())}
            if self.with_ids:
                ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                columns["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*ids, np.zeros(0)]).astype(np.int32)))
            yield pa.RecordBatch.from_pydict(columns)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``BYTES``: the more text at once, the fewer words are encoded again."""
    some, size = [], 0
    for batch in batches:
        some.append(batch)
        if (size := size + batch.nbytes) >= BYTES:
            yield pa.concat_batches(some)
            some, size = [], 0
    if some:
        yield pa.concat_batches(some)


def _gathered(flat: np.ndarray, size: np.ndarray, pick: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` (of the given sizes, one after another) with the numbers ``pick``, joined."""
    begin, some = np.cumsum(size) - size, size[pick]
    total = np.cumsum(some)
    return flat[np.arange(total[-1] if len(total) else 0) + np.repeat(begin[pick] - total + some, some)]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32, part, nth[, ids]) of every piece, written; it is the nth of its length in its part."""
    ready(docs.sparkSession)
    plain = docs.select(q(id_col).alias("id"), q(text_col).cast("string").alias("text"))
    schema = f"id {plain.schema['id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long, part int, nth long"
    return settled(plain.mapInArrow(_Cutter(path, capacity, with_ids), schema + ", ids array<int>" * with_ids), "pieces")


class Knapsack:
    """The heaviest configurations under given weights, by dynamic programming over the capacity. ``lengths`` ascend."""

    def __init__(self, lengths: np.ndarray, weights: np.ndarray, counts: np.ndarray, capacity: int):
        self.lengths, self.counts, self.capacity = lengths.tolist(), counts.tolist(), capacity
        self.choice = [-1] * (capacity + 1)
        best = np.zeros(capacity + 1)
        fits = np.searchsorted(lengths, np.arange(capacity + 1), "right").tolist()
        for c in range(self.lengths[0], capacity + 1):
            value = best[c - lengths[:fits[c]]] + weights[:fits[c]]
            top = fits[c] - 1 - int(value[::-1].argmax())  # of equal values the longest piece
            best[c], self.choice[c] = value[top], top
        self.worth = weights + best[capacity - lengths]  # of the heaviest configuration with each length

    def configuration(self, first: int) -> Configuration:
        """The heaviest configuration that holds a piece of the length number ``first``, with no more slots than pieces: the recursion allows
        any number of slots; for those beyond, the longest pieces that fit come in."""
        slots, left = {first: 1}, self.capacity - self.lengths[first]
        while left >= self.lengths[0]:
            i = self.choice[left]
            left -= self.lengths[i]
            slots[i] = slots.get(i, 0) + 1
        for i, k in slots.items():
            slots[i] = min(k, self.counts[i])
        left = self.capacity - sum(self.lengths[i] * k for i, k in slots.items())
        i = bisect_right(self.lengths, left) - 1
        while i >= 0:
            if (more := min(left // self.lengths[i], self.counts[i] - slots.get(i, 0))) > 0:
                slots[i] = slots.get(i, 0) + more
                left -= more * self.lengths[i]
            i = min(i, bisect_right(self.lengths, left)) - 1
        return tuple(sorted(slots.items()))


def fractions(lengths: np.ndarray, counts: np.ndarray, capacity: int, steps: int = STEPS) -> dict[Configuration, float]:
    """Configurations with fractional copies, as many tokens in all as the histogram has, by multiplicative weights.

    One dynamic program prices a whole step: all configurations within ``NEAR`` of the heaviest, if the weights that fall meanwhile leave them
    as heavy."""
    weights, x = lengths / capacity, defaultdict(float)
    for round_ in range(steps):
        sack, before = Knapsack(lengths, weights, counts, capacity), weights.copy()
        least = float(sack.worth.max()) * (1 - NEAR)
        for first in np.argsort(-sack.worth, kind="stable").tolist():
            if sack.worth[first] < least:
                break
            slots = sack.configuration(first)
            at, need = (np.array(v) for v in zip(*slots))
            if weights[at] @ need < (before[at] @ need) * (1 - NEAR):
                continue
            step = float((counts[at] / need).min())
            if round_ >= steps // 2:  # the first steps only find the weights
                x[slots] += step
            weights[at] *= np.exp(-RATE * need * step / counts[at])
    volume = sum(copies * sum(k * int(lengths[i]) for i, k in slots) for slots, copies in x.items())
    scale = float(lengths @ counts) / volume
    return {slots: copies * scale for slots, copies in x.items()}


def plan(histogram: dict[int, int], capacity: int = CAPACITY, steps: int = STEPS, rounds: int = ROUNDS) -> list[tuple[Pattern, int]]:
    """Patterns and their copies, holding exactly the pieces of the histogram: the fewest sequences of those after each round."""
    left = {n: c for n, c in histogram.items() if c > 0}
    chosen: list[tuple[Pattern, int]] = []
    if capacity in left:
        chosen.append((((capacity, 1),), left.pop(capacity)))
    plans = [] if left else [chosen]
    while left and len(plans) < rounds:
        lengths = np.array(sorted(left), np.int64)
        counts = np.array([left[int(n)] for n in lengths], np.int64)
        x = fractions(lengths, counts, capacity, steps)
        gap = {slots: capacity - sum(k * int(lengths[i]) for i, k in slots) for slots in x}
        usual = sum(gap[slots] * copies for slots, copies in x.items()) / sum(x.values())
        for slots, copies in sorted(x.items(), key=lambda item: (-item[1], item[0])):
            if gap[slots] > usual:  # such pieces may find better company in the next solution
                continue
            copies = min(int(np.ceil(copies - 1e-9)), *(int(counts[i]) // k for i, k in slots))
            if copies > 0:
                for i, k in slots:
                    counts[i] -= copies * k
                chosen.append((tuple((int(lengths[i]), k) for i, k in reversed(slots)), copies))
        left = {int(n): int(c) for n, c in zip(lengths, counts) if c}
        plans.append(best_fit(chosen, left, capacity))
    return min(plans, key=lambda groups: sum(copies for _, copies in groups))


def best_fit(chosen: list[tuple[Pattern, int]], left: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Put what is left, longest first, where it leaves the least space; equal sequences are handled together."""
    open_: dict[int, list[tuple[Pattern, int]]] = defaultdict(list)
    frees: list[int] = []

    def keep(pattern: Pattern, copies: int) -> None:
        free = capacity - sum(n * k for n, k in pattern)
        if copies:
            if not open_[free]:
                insort(frees, free)
            open_[free].append((pattern, copies))

    for pattern, copies in chosen:
        keep(pattern, copies)
    for length in sorted(left, reverse=True):
        count = left[length]
        while count:
            at = bisect_left(frees, length)
            if at < len(frees):
                pattern, copies = open_[frees[at]].pop()
                each = frees[at] // length
                if not open_[frees[at]]:
                    frees.pop(at)
            else:
                pattern, copies, each = (), -(-count // (capacity // length)), capacity // length
            full = min(copies, count // each)
            rest = min(count - full * each, each - 1) if full < copies else 0
            keep((*pattern, (length, each)), full)
            if rest:
                keep((*pattern, (length, rest)), 1)
            keep(pattern, copies - full - (rest > 0)) if pattern else None
            count -= full * each + rest
    return [g for free in sorted(open_) for g in open_[free]]


class Slots:
    """Where the n-th piece of a length goes, for a whole plan."""

    def __init__(self, plan_: list[tuple[Pattern, int]]):
        rows, taken, sequence = [], defaultdict(int), 0
        for pattern, copies in plan_:
            offset = 0
            for length, slots in pattern:
                rows.append((length, taken[length], sequence, slots, offset))
                taken[length] += copies * slots
                offset += length * slots
            sequence += copies
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 5)
        self.key = (table[:, 0] << NUMBER_BITS) | table[:, 1]
        self.first, self.sequence, self.slots, self.offset = table[:, 1], table[:, 2], table[:, 3], table[:, 4]

    def __call__(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) per piece."""
        at = np.searchsorted(self.key, (length << NUMBER_BITS) | number, "right") - 1
        copy, slot = np.divmod(number - self.first[at], self.slots[at])
        return self.sequence[at] + copy, self.offset[at] + slot * length


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset[, ids]) of every piece: its place in its document and in its sequence."""
    cut = pieces(docs, path, capacity, with_ids, id_col, text_col)
    counts = settled(cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    slots = Slots(plan(histogram, capacity))

    @F.arrow_udf("struct<sequence_id: long, offset: long>")
    def place(length: pa.Array, number: pa.Array) -> pa.Array:
        sequence, offset = slots(length.to_numpy(zero_copy_only=False).astype(np.int64), number.to_numpy(zero_copy_only=False).astype(np.int64))
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], ["sequence_id", "offset"])

    numbered = cut.join(counts.select("part", "length", before.alias("before")), ["part", "length"])
    placed = numbered.withColumn("place", place(F.col("length"), F.col("before") + F.col("nth")))
    return placed.select("id", "piece", "start", "length", "ids_crc32", "place.sequence_id", "place.offset", *["ids"] * with_ids)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, of a ``pack`` with ids. A sequence is bounded by the capacity."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(inside, lambda x: x.ids)).alias("ids"))

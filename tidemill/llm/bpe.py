"""Byte-level BPE: encoding by a rank file, and decoding.

A text is cut into words by the vocabulary's pattern, whose rules are applied to whole batches of code points; the merges of a word depend on the word alone. The merges of
all words of a batch are folded together: in each round the first neighbours of every word whose joined bytes have the lowest rank are joined,
until no pair has a rank. The pairs that can be joined, every token cut in two tokens, are one sorted table.

Words are folded once per corpus if they are among its most frequent (a table of at most ``FREQUENT`` words, found by counting all
words), else once per batch of texts that has them. The table only saves work: ids are the same with any table.

Words of more than ``LONG`` bytes go through the tiktoken library, as a fold is quadratic in the word's length.

Defined cases: null text counts as empty and has no ids; decoding null or no ids gives no bytes; ids outside the vocabulary decode to
nothing; an empty table gives no rows; repeated rows are each encoded; extra columns stay, but for one named as the result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from public_tokenizers import PATTERN
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from tidemill.llm import tokens
from tidemill.llm.common import q, ready
from tidemill.session import settled

CELLS = 1 << 17  # bytes of words that are folded in one table
FREQUENT = 1 << 19
LONG = 256
LETTER, NUMBER, SPACE = 1, 2, 3
_NEVER, _NONE = np.iinfo(np.int32).max, np.iinfo(np.int64).max
# Fixed value: the white space of the pattern's \s (Unicode White_Space), which differs between regex libraries.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from a file of base64 tokens and ranks on the driver."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, f.read().splitlines()))}


def explicit(pattern: str) -> str:
    """The pattern with its white space spelled out."""
    return pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\S", f"[^{WHITE}]").replace(r"\s", f"[{WHITE}]")


class Merges:
    """Folds the ranked merges over many words at once. Symbols are numbered by rank, so the lowest number is the pair to join first."""

    def __init__(self, ranks: dict[bytes, int]):
        missing = [bytes([b]) for b in range(256) if bytes([b]) not in ranks]
        order = sorted(ranks, key=ranks.get)
        symbol = {token: i for i, token in enumerate(order + missing)}
        self.whole = ranks
        self.ids = np.array([ranks[t] for t in order] + [-1] * len(missing), np.int32)  # -1, which becomes null: a byte that the vocabulary lacks
        self.bytes = np.array([symbol[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token in order:
            for cut in range(1, len(token)):
                left, right = symbol.get(token[:cut]), symbol.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = symbol[token]
        keys = np.fromiter(pairs, np.int64, len(pairs))
        at = np.argsort(keys)
        self.keys, self.joined = np.append(keys[at], _NONE), np.append(np.fromiter(pairs.values(), np.int32, len(pairs))[at], _NEVER).astype(np.int32)

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The symbol that two symbols are joined to, or _NEVER."""
        key = left.astype(np.int64) << 32 | right
        spot = np.searchsorted(self.keys, key)
        return np.where(self.keys[spot] == key, self.joined[spot], _NEVER)

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, where the ids of each begin and end). A word that is a token is that token."""
        size = np.array([len(w) for w in words], np.int64)
        token = np.array([self.whole.get(w, -1) for w in words], np.int64)
        many = np.where(token >= 0, 1, size)
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.flatnonzero(token >= 0), many[token >= 0], token[token >= 0].astype(np.int32))]
        fold = np.flatnonzero(token < 0)
        fold = fold[np.argsort(size[fold], kind="stable")]  # words of like length share a table
        while len(fold):
            wide = int(size[fold[0]]) * 5 // 4 + 1
            some = fold[:min(int(np.searchsorted(size[fold], wide, "right")), max(1, CELLS // wide))]
            fold = fold[len(some):]
            parts.append((some, *self._folded([words[i] for i in some], size[some])))
        for some, count, _ in parts:
            many[some] = count
        ends = np.concatenate([[0], np.cumsum(many)]).astype(np.int64)
        out = np.zeros(ends[-1], np.int32)
        for some, count, ids in parts:
            before = np.cumsum(count) - count
            out[np.arange(len(ids)) + np.repeat(ends[some] - before, count)] = ids
        return out, ends

    def _folded(self, words: list[bytes], size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids per word, ids). A row per word: its symbols, the symbol that each would be joined to with its right neighbour, and both neighbours'
        places. Every round joins in every word the first of its pairs of lowest rank, until no word has one."""
        n, wide = len(words), int(size.max(initial=0)) + 1  # the last place stays empty
        there = np.arange(wide) < size[:, None]
        symbols = np.zeros((n, wide), np.int32)
        symbols[there] = self.bytes[np.frombuffer(b"".join(words), np.uint8)]
        best = np.full((n, wide), _NEVER, np.int32)
        left = there[:, 1:]
        best[:, :-1][left] = self.pair(symbols[:, :-1][left], symbols[:, 1:][left])
        after = np.broadcast_to(np.minimum(np.arange(1, wide + 1), wide - 1), (n, wide)).copy()
        after = np.where(np.arange(1, wide + 1) < size[:, None], after, wide - 1).astype(np.int32)
        before = np.broadcast_to(np.arange(-1, wide - 1), (n, wide)).astype(np.int32)
        row = np.arange(n)  # words that still have a pair
        while len(row):
            at = best[row].argmin(1)
            to = best[row, at]
            row, at, to = row[to < _NEVER], at[to < _NEVER], to[to < _NEVER]
            gone = after[row, at]
            follows = after[row, gone]
            symbols[row, at], after[row, at] = to, follows
            there[row, gone], best[row, gone], best[row, at] = False, _NEVER, _NEVER
            some = follows < wide - 1
            before[row[some], follows[some]] = at[some]
            best[row[some], at[some]] = self.pair(to[some], symbols[row[some], follows[some]])
            ahead = before[row, at]
            some = ahead >= 0
            best[row[some], ahead[some]] = self.pair(symbols[row[some], ahead[some]], to[some])
        return there.sum(1), self.ids[symbols[there]]


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """LETTER, NUMBER, SPACE or 0 per code point."""
    points = np.setdiff1d(np.arange(0x110000, dtype=np.uint32), np.arange(0xD800, 0xE000, dtype=np.uint32))
    text, kinds = points.astype("<u4").tobytes().decode("utf-32-le"), np.zeros(0x110000, np.uint8)
    for kind, run in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, f"[{WHITE}]+")):
        for m in regex.finditer(run, text):
            kinds[points[m.start():m.end()]] = kind
    return kinds


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def _sums(points: np.ndarray) -> np.ndarray:
    """Running polynomial over code points, to hash any stretch of them."""
    out = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(tokens.mix(points.astype(np.uint64) + np.uint64(1)) * tokens._powers(len(points) + 1)[0][:len(points)], out=out[1:])
    return out


def _hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return tokens.mix((sums[end] - sums[start]) * tokens._powers(len(sums))[1][start] + (end - start).astype(np.uint64))


def word_starts(points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the words of the texts ``bounds[i]:bounds[i + 1]`` begin, as public_tokenizers.PATTERN cuts them.

    Runs of letters, of digits and of other marks are words, each with one space before it. Of white space before something else the
    last character stands alone or is that space; the rest is a word, as is white space at the end. An apostrophe on its own
    takes s, t, m, d, re, ve or ll from the letters after it.
    """
    n, kind = len(points), _kinds()[points]
    first = np.zeros(n + 1, bool)
    first[bounds] = True
    change = first[:n].copy()
    change[1:] |= kind[1:] != kind[:-1]
    begin = np.flatnonzero(change)
    end = np.append(begin[1:], n)
    kinds = kind[begin]
    blank = kinds == SPACE
    start = np.zeros(n + 1, bool)
    spaced = ~blank & ~first[begin] & (points[begin - 1] == 32)
    start[begin - spaced] = True
    closing = first[end]  # runs at the end of their text
    alone = blank & ~closing & (end - begin == 1) & (points[begin] == 32)
    start[begin[blank & ~alone]] = True
    start[end[blank & ~closing] - 1] = True
    # contractions
    quote = np.flatnonzero((points[begin] == 39) & (end - begin == 1) & ~spaced & ~closing)
    quote = quote[kinds[np.minimum(quote + 1, len(kinds) - 1)] == LETTER]
    if len(quote):
        at, stop = begin[quote] + 1, end[quote + 1]
        one, two = points[at], np.where(stop - at > 1, points[np.minimum(at + 1, n - 1)], 0)
        takes = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, 0)
        for pair in ("re", "ve", "ll"):
            takes = np.where((one == ord(pair[0])) & (two == ord(pair[1])), 2, takes)
        hit = takes > 0
        start[at[hit]] = False
        more = hit & (stop - at > takes)
        start[(at + takes)[more]] = True
    return np.flatnonzero(start[:n])


class _Texts:
    """Cuts texts; the ids of known words are at hand, the others are folded once per batch."""

    def __init__(self, words: list[str], flat: np.ndarray, ends: np.ndarray, merges: Merges):
        parts = [np.zeros(0, np.uint64)]
        for low in range(0, len(words), 1 << 16):
            some = words[low:low + (1 << 16)]
            at = np.concatenate([[0], np.cumsum([len(w) for w in some])]).astype(np.int64)
            parts.append(_hashes(_sums(_points("".join(some))), at[:-1], at[1:]))
        hashes = np.concatenate(parts)
        order = np.argsort(hashes)
        self.hashes, self.number = hashes[order], order.astype(np.int32)
        self.flat, self.ends, self.merges, self.library = flat, ends, merges, None

    def by_library(self, word: str) -> list[int]:
        if self.library is None:
            import tiktoken
            self.library = tiktoken.Encoding("whole", pat_str=r"(?s).+", mergeable_ranks=self.merges.whole, special_tokens={})
        return self.library.encode_ordinary(word)

    def folded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, where the ids of each begin and end)."""
        coded = [w.encode() for w in words]
        long = [i for i, w in enumerate(coded) if len(w) > LONG]
        ids, ends = self.merges([b"" if len(w) > LONG else w for w in coded])
        if not long:
            return ids, ends
        extra = [np.array(self.by_library(words[i]), np.int32) for i in long]
        many = np.diff(ends)
        ids = np.insert(ids, np.repeat(ends[long], [len(e) for e in extra]), np.concatenate(extra))
        many[long] = [len(e) for e in extra]
        return ids, np.concatenate([[0], np.cumsum(many)]).astype(np.int64)

    def cut(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where the ids of each begin and end)."""
        whole = "".join(texts)
        points = _points(whole)
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        start = word_starts(points, bounds)
        end = np.append(start[1:], len(points))
        hashes = _hashes(_sums(points), start, end)
        spot = np.minimum(np.searchsorted(self.hashes, hashes), max(len(self.hashes) - 1, 0))
        known = self.hashes[spot] == hashes if len(self.hashes) else np.zeros(len(start), bool)
        word = np.where(known, self.number[spot] if len(self.hashes) else 0, -1).astype(np.int64)
        rare: dict[str, int] = {}
        word[~known] = [rare.setdefault(whole[a:b], len(self.ends) - 1 + len(rare)) for a, b in zip(start[~known].tolist(), end[~known].tolist())]
        flat, ends = self.folded(list(rare))
        flat, ends = np.concatenate([self.flat, flat]), np.concatenate([self.ends, self.ends[-1] + ends[1:]])
        size = ends[word + 1] - ends[word]
        total = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        ids = flat[np.arange(total[-1]) + np.repeat(ends[word] - total[:-1], size)]
        return ids, total[np.searchsorted(start, bounds)]

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for low, high in _stretches(np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)), tokens.CHUNK):
                some = batch.slice(low, high - low)
                ids, ends = self.cut([t or "" for t in texts[low:high].to_pylist()])
                yield pa.RecordBatch.from_arrays([*some.columns[:-1], _lists(ids, ends)], names=[*batch.schema.names[:-1], "out"])


def _stretches(ends: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """(first row, row after the last) of stretches of rows of about ``size`` in all, as a worker keeps what its largest batch took; a larger
    row is a stretch of its own. ``ends`` are running sums."""
    low = 0
    while low < len(ends):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + size, "right")))
        yield low, high
        low = high


def _lists(ids: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids, pa.int32(), mask=ids < 0))


def frequent_words(texts: Column, docs: DataFrame, pattern: str, merges: Merges, most: int = FREQUENT) -> pa.Table:
    """(word, ids) of the most frequent words, ``most`` at most; all words of all texts are counted."""
    words = docs.select(F.explode(F.regexp_extract_all(F.coalesce(texts, F.lit("")), F.lit(pattern), F.lit(0))).alias("word"))
    counts = settled(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where("n > 1").where(F.octet_length("word") <= LONG), "words")
    level = F.floor(F.log2("n") * 16)
    total, least = 0, None
    for row in sorted(counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words")).collect(), key=lambda r: -r.level):  # some hundred levels
        if (total := total + row.words) > most:
            break
        least = row.level
    chosen = counts.where(level >= least) if least is not None else counts.limit(0)

    def with_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch({"word": batch.column(0), "ids": _lists(*merges([w.encode() for w in batch.column(0).to_pylist()]))})

    return chosen.select("word").mapInArrow(with_ids, "word string, ids array<int>").toArrow()


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", name: str = "ids", most: int = FREQUENT) -> DataFrame:
    """``docs`` without its text, with the ids of every text. ``pattern`` must be the one that ``word_starts`` implements."""
    if pattern != PATTERN:
        raise ValueError("no cutting rules for this pattern")
    ready(docs.sparkSession)
    merges = Merges(load_ranks(path))
    known = frequent_words(q(text_col).cast("string"), docs, explicit(pattern).replace("\\x85", "\\u0085").replace("\\xa0", "\\u00a0"), merges, most)
    ids = known["ids"].combine_chunks()
    texts = _Texts(known["word"].to_pylist(), ids.flatten().fill_null(-1).to_numpy().astype(np.int32), ids.offsets.to_numpy().astype(np.int64), merges)
    cols = [c for c in docs.columns if c not in (text_col, name)]  # under plain names on the way, as theirs may be anything
    plain = docs.select(*[q(c).alias(f"c{i}") for i, c in enumerate(cols)], q(text_col).cast("string").alias("text"))
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema.fields[:-1]), "out array<int>"])
    return plain.mapInArrow(texts, schema).toDF(*cols, name)


def decoder(path: str) -> Callable[[Column], Column]:
    """A column function ids -> bytes: the pieces of the ids, concatenated."""
    table = load_ranks(path)
    pieces = [b""] * (max(table.values(), default=-1) + 2)  # the last one for ids outside the vocabulary
    for token, rank in table.items():
        pieces[rank] = token
    size = np.array([len(p) for p in pieces], np.int64)
    begin, every = np.cumsum(size) - size, np.frombuffer(b"".join(pieces), np.uint8)

    @F.arrow_udf(BinaryType())
    def decode(ids: pa.Array) -> pa.Array:
        flat, ends, valid, out = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy(), ids.is_valid().to_pylist(), []
        for low, high in _stretches(ends[1:] - ends[0], tokens.CHUNK // 4):
            some = flat[ends[low]:ends[high]].astype(np.int64)
            some = np.where((some < 0) | (some >= len(size) - 1), len(size) - 1, some)
            total = np.concatenate([[0], np.cumsum(size[some])])
            data = every[np.arange(total[-1]) + np.repeat(begin[some] - total[:-1], size[some])].tobytes()
            at = total[ends[low:high + 1] - ends[low]]
            out += [data[a:b] if ok else None for a, b, ok in zip(at[:-1], at[1:], valid[low:high])]
        return pa.array(out, pa.binary())

    return lambda ids: F.coalesce(decode(ids), F.lit(b""))


@F.arrow_udf(StringType())
def ids_digest(ids: pa.Array) -> pa.Array:
    """SHA-256 (hex) of ids as little-endian unsigned 32-bit integers; null counts as no ids."""
    flat, ends = ids.values.to_numpy(zero_copy_only=False).astype("<u4"), ids.offsets.to_numpy()
    return pa.array([hashlib.sha256(flat[a:b].tobytes() if ok else b"").hexdigest() for a, b, ok in zip(ends[:-1], ends[1:], ids.is_valid().to_pylist())])

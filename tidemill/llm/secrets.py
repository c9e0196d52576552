"""Secret scan: fixed patterns, and two character Markov models for what the patterns miss.

The models are first-order chains over the characters of tokens, trained from labelled samples. Random strings: the values that the patterns find
in the corpus, and as many generated ones over the alphabets of keys. Ordinary ones: all other text of the corpus, and the names in the source of
Python's standard library (words of prose say little about identifiers, constants and paths), alone and joined to paths. Each model is the
mean of the chains of its two samples, so neither sample drowns the other; tokens of the corpus that the samples from outside call random are
not learned as ordinary. A token whose log-likelihood ratio says "random" becomes a
span of kind ``markov``, unless it touches a span of a pattern or has the form of a UUID. The margin is calibrated on names that the model has
not seen: at most one in two hundred may pass.

Positions are code points, the end is exclusive. Defined cases: null text counts as empty; a text without finds has no spans; without any
found value the model of random strings rests on the generated ones; an empty table gives no rows; repeated rows are each reported; extra columns
are not looked at.
"""

from __future__ import annotations

import os
import pathlib
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm import tokens
from tidemill.llm.common import q, ready

# Fixed patterns of the contract; counted repeats state the least length of what counts.
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_VALUE = 8
KINDS = ("assign", "access", "hex", "markov")

LONG = 12  # the least length at which nine in ten random strings reach the margin
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LONG)
UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
PRIOR = 20.0  # pairs that the shares of single symbols count for
FALSE = 0.005  # share of held-out names that may pass
MARGIN = 3.0  # nats, at least
GENERATED = 2_000  # random strings per alphabet
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
SYMBOLS = len(ALPHABET)
_SYMBOL = np.full(256, SYMBOLS)  # SYMBOLS: not of the alphabet
_SYMBOL[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(SYMBOLS)
_DIGITS, _CAPITALS = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
KEYS = [_CAPITALS + _CAPITALS.lower() + _DIGITS, ALPHABET[:64], "0123456789abcdef", _CAPITALS + "234567", ALPHABET[:62] + "-_", _CAPITALS.lower() + _DIGITS]
SPANS = "array<struct<kind:string,start:int,end:int>>"


def by_pattern(text: str) -> Iterator[tuple[int, int, int, str]]:
    """(start, kind, end, value) of the fixed patterns."""
    if ":" in text or "=" in text:
        for m in ASSIGN.finditer(text):
            if len(m[1]) >= LEAST_VALUE:
                yield m.start(), 0, m.end(), m[1]
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            yield m.start(), 1, m.end(), m[0]
    for m in HEX.finditer(text):
        yield m.start(), 2, m.end(), m[0]


def _pairs(data: np.ndarray) -> np.ndarray:
    """Counts of neighbouring symbols, as a flat square."""
    s = _SYMBOL[data]
    a, b = s[:-1], s[1:]
    ok = (a < SYMBOLS) & (b < SYMBOLS)
    return np.bincount(a[ok] * SYMBOLS + b[ok], minlength=SYMBOLS * SYMBOLS)


def _joined(values: list[str]) -> np.ndarray:
    return _pairs(np.frombuffer(" ".join(values).encode(), np.uint8))


@dataclass
class Models:
    """``table``: log-likelihood ratio random : ordinary of every pair of symbols; ``margin``: the nats that a secret must reach."""

    table: np.ndarray
    margin: float


class _Count:
    """Texts to (random, pair, n) rows: pairs of symbols in found values, and in all other text but tokens that ``base`` calls random."""

    def __init__(self, base: Models):
        self.base = base

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, doubtful = [], []
            for t in filter(None, batch.column(0).to_pylist()):
                spans = list(by_pattern(t))
                found += [v for *_, v in spans]
                doubtful += [t[a:b] for a, k, b in spans_of(t, self.base, spans) if k == 3]
            random_ = _joined(found)
            every = np.zeros_like(random_)
            for _, _, data, _ in tokens.chunks(batch.column(0)):
                every += _pairs(data)
            for flag, counts in ((True, random_), (False, np.maximum(every - random_ - _joined(doubtful), 0))):
                at = np.flatnonzero(counts)
                yield pa.record_batch({"random": pa.array([flag] * len(at), pa.bool_()), "pair": pa.array(at, pa.int32()), "n": pa.array(counts[at], pa.int64())})


def library_names() -> list[str]:
    """The distinct names and words in the source of Python's standard library (its top folder), sorted."""
    found: set[str] = set()
    for f in sorted(pathlib.Path(os.__file__).parent.glob("*.py")):
        found.update(re.findall(r"[A-Za-z_][A-Za-z0-9_]{2,}", f.read_text(errors="replace")))
    return sorted(found)


def with_paths(names: list[str], seed: int = 4) -> list[str]:
    """The names, and each of them once more in a path or a compound of three."""
    shuffled = list(names)
    random.Random(seed).shuffle(shuffled)
    return shuffled + [sep.join(shuffled[i:i + 9:3]) for k, sep in enumerate("/-.") for i in range(k, len(shuffled) - 8, 9)]


def random_strings(seed: int = 4) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choices(letters, k=rng.randrange(LONG, 50))) for letters in KEYS for _ in range(GENERATED)]


def _chain(counts: np.ndarray) -> np.ndarray:
    """Shares of the next symbol; every row leans on how often the symbols occur at all, and these on equal shares."""
    square = counts.reshape(SYMBOLS, SYMBOLS).astype(float)
    single = (square.sum(0) + 1) / (square.sum() + SYMBOLS)
    return (square + PRIOR * single) / (square.sum(1, keepdims=True) + PRIOR)


def train(docs: DataFrame, text_col: str = "text", names: list[str] | None = None) -> Models:
    """The models of a corpus. What reaches the driver of it is one number per pair and class. ``names`` are labelled ordinary."""
    ready(docs.sparkSession)
    names = library_names() if names is None else names
    unseen = [zlib.crc32(n.encode()) % 5 == 0 for n in names]
    known, held = (with_paths([n for n, x in zip(names, unseen) if x == flag]) for flag in (False, True))
    ordinary, random_ = _chain(_joined(known)), _chain(_joined(random_strings()))

    def models(table: np.ndarray) -> Models:
        scores = [ratio(n, table) for n in held if len(n) >= LONG]
        return Models(table, max(MARGIN, float(np.quantile(scores, 1 - FALSE))) if scores else MARGIN)

    base = models(np.log(random_) - np.log(ordinary))
    rows = docs.select(q(text_col).cast("string")).mapInArrow(_Count(base), "random boolean, pair int, n long").groupBy("random", "pair").agg(F.sum("n").alias("n"))
    counts, got = np.zeros((2, SYMBOLS * SYMBOLS)), rows.toArrow()
    counts[got["random"].to_numpy().astype(int), got["pair"].to_numpy()] += got["n"].to_numpy()
    return models(np.log(_chain(counts[1]) + random_) - np.log(_chain(counts[0]) + ordinary))


def ratio(token: str, table: np.ndarray) -> float:
    """Nats by which the token is likelier as a random string. A pair counts once, as its repetition is no evidence; a few pairs tell nothing."""
    s = _SYMBOL[np.frombuffer(token.encode(), np.uint8)]
    pairs = np.unique(s[:-1] * SYMBOLS + s[1:])
    return float(table.ravel()[pairs].sum()) if len(pairs) >= LONG // 2 else 0.0


def spans_of(text: str, models: Models, base: list[tuple[int, int, int, str]] | None = None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all spans, in this order. ``base``: those of the patterns, if known."""
    found = [x[:3] for x in (by_pattern(text) if base is None else base)]
    for m in TOKEN.finditer(text):
        if ratio(m[0], models.table) > models.margin and not UUID.fullmatch(m[0]) and all(m.end() <= a or b <= m.start() for a, _, b in found):
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def scanner(models: Models):
    """A column function text -> spans."""
    kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    @F.arrow_udf(SPANS)
    def scan(text: pa.Array) -> pa.Array:
        return pa.array([[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans_of(t or "", models)] for t in text.to_pylist()], pa.list_(kind))

    return scan


def scan(docs: DataFrame, text_col: str = "text", name: str = "spans", names: list[str] | None = None) -> DataFrame:
    """``docs`` with the spans of every text, by start and then kind."""
    return docs.withColumn(name, scanner(train(docs, text_col, names))(q(text_col).cast("string")))


def redacted(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """The text with every span replaced; overlapping spans count as one."""
    state = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    step = lambda s, x: F.when(x.end <= s.at, s).otherwise(F.struct(F.concat(
        s.out, F.when(x.start >= s.at, F.concat(F.substring(text, s.at + 1, x.start - s.at), F.lit(mask))).otherwise(F.lit(""))).alias("out"), x.end.alias("at")))
    return F.aggregate(spans, state, step, lambda s: F.concat(s.out, F.substring(text, s.at + 1, F.length(text))))


def joined(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x.kind, x.start, x.end)), ",")

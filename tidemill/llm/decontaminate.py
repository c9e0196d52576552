"""Benchmark decontamination by templates.

Numbers, units and names become typed placeholders, so a question keeps its template when its parameters change; neighbouring numbers
or names are one placeholder. A capitalised word that opens a sentence is read both as a word and as a name. Windows of
template tokens are hash-joined with those of the benchmark. A document leaks an item if windows of the item, close
together, cover at least 80 % of it, and if the slot values of one alignment of these windows agree: the same value of the item always
stands for the same value in the document (equal values: a verbatim copy; other values: a re-parameterised question).

Defined cases: null texts count as empty; empty texts leak nothing and empty items are leaked by nothing; items of fewer
words than a window are one window of their own length; a window of too few literal words must match word for word; equal items are
reported each; repeated rows are reported once per id; a null id is reported as null; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm import tokens
from tidemill.llm.common import q, ready, unused
from tidemill.session import settled

WINDOW = 5
COVER = 0.8  # share of an item's windows
AGREE = 0.8  # share of slot values that follow one mapping
LITERALS = 2  # of a window's words; with fewer its template alone says too little
SLOTS = 1 << 22  # size of the table that filters document windows before the join

# Words that stand for numbers, and units.
NUMBER_WORDS = """one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen
nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion""".split()
NUMBER_WORDS += [f"{a}-{b}" for a in "twenty thirty forty fifty sixty seventy eighty ninety".split() for b in NUMBER_WORDS[:9]]
UNITS = """% kg g mg km m cm mm mile miles ft feet foot inch inches yard yards lb lbs pound pounds ounce ounces l ml liter liters litre
litres second seconds minute minutes hour hours day days week weeks month months year years dollar dollars euro euros cent cents usd
eur gbp degrees mph kmh percent""".split()
_NUMBER_WORDS = np.sort(np.array([tokens.word_hash(x) for x in NUMBER_WORDS], np.uint64))
_UNITS = np.sort(np.array([tokens.word_hash(x) for x in UNITS], np.uint64))
NUMBER, UNIT, NAME = 1, 2, 3
_PLACEHOLDER = tokens.mix(np.array([0, 11, 22, 33], np.uint64))

_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in "+-$.("]] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in "!\"#&'()*,-./:;<=>?@[\\]^_`{|}~"]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?:;"]] = True


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def folded(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with the accented capitals of Latin-1 in lower case; A-Z are folded when words are hashed."""
    out = data.copy()
    at = np.flatnonzero(data[:-1] == 0xC3) + 1
    at = at[(data[at] >= 0x80) & (data[at] <= 0x9E) & (data[at] != 0x97)]
    out[at] += 32
    return out


def canonical(w: tokens.Words, original: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(value, kind, wide kind, opens) of every word: its folded hash without outer punctuation, 0 or the type of its placeholder, the same
    with opening words, and whether it opens a text, a line or a sentence.

    A name begins with a capital and goes on in lower case; if it opens a text, a line or a sentence, it is one in the wide kind only.
    """
    data, start, end = w.data, w.starts.copy(), w.ends.copy()
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    while (move := (end - start > 1) & _MARK[data[end - 1]]).any():
        end -= move
    while (move := (end - start > 1) & _MARK[data[start]]).any():
        start += move
    value = w.hash_of(start, end)
    raw, second = data[w.starts], data[np.minimum(w.starts + 1, w.ends - 1)]
    number = _DIGIT[data[start]] | (_SIGN[raw] & _DIGIT[second]) | _among(value, _NUMBER_WORDS)
    capital = (original != data) | ((original >= 65) & (original <= 90))  # at the second byte of an accented letter
    accented = original[start] == 0xC3
    second_letter = start + 1 + accented
    inside = second_letter < end
    upper = capital[start + (accented & (end - start > 1))] & inside & ~capital[np.where(inside, second_letter, start)]
    upper &= ~((original[np.where(inside, second_letter, start)] == 0xC3) & capital[np.minimum(np.where(inside, second_letter, start) + 1, len(data) - 1)])
    lines = np.concatenate([[0], np.cumsum(data == 10)])
    opens = np.ones(len(start), bool)  # first of its text, its line or its sentence
    opens[1:] = _STOP[data[w.ends[:-1] - 1]] | (lines[w.starts[1:]] > lines[w.ends[:-1]])
    opens[w.first[:-1][w.first[:-1] < len(start)]] = True
    kind = np.where(number, NUMBER, np.where(upper & ~opens, NAME, 0))
    after = np.zeros(len(start), bool)
    after[1:] = number[:-1]
    after[w.first[:-1][w.first[:-1] < len(start)]] = False
    kind = np.where(after & ~number & _among(value, _UNITS), UNIT, kind)
    return value, kind, np.where((kind == 0) & upper, NAME, kind), opens


def merged(value: np.ndarray, kind: np.ndarray, opens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, kind, slot value) of every run: neighbouring numbers or names of a sentence are one, other words are alone."""
    goes_on = np.zeros(len(kind), bool)
    goes_on[1:] = (kind[1:] == kind[:-1]) & ((kind[1:] == NUMBER) | (kind[1:] == NAME)) & ~opens[1:]
    at = np.flatnonzero(~goes_on)
    if not len(at):
        return at, kind, value
    inside = np.arange(len(kind)) - np.repeat(at, np.diff(np.append(at, len(kind))))
    slot = np.add.reduceat(tokens.mix(value + inside.astype(np.uint64) * _PLACEHOLDER[1]), at)
    return at, kind[at], np.where(kind[at] > 0, slot, np.uint64(0))


def windows(texts: pa.Array, sizes: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text, words in the text, position, words in the window, key, slot values) of all windows: once by their words, with no slots, and
    those with placeholders and enough literal words again by their template: word by word, with runs as one placeholder, and with opening
    words as names, where these differ. Equal templates have equal keys, whichever way they arose. Slot values are 0 for literal words."""
    for low, _, data, bounds in tokens.chunks(texts):
        w = tokens.words(folded(data), bounds)
        value, kind, wide, opens = canonical(w, data)
        owner, count = w.owner(), np.diff(w.first)
        every, n = np.arange(len(value)), len(value)
        plain = every, kind, np.where(kind > 0, tokens.mix(value), np.uint64(0)), np.zeros(n, bool)
        readings = [plain]
        for some, opening in ((kind, False), (wide, True)):
            at, kinds, slot = merged(value, some, opens)
            size = np.diff(np.append(at, n))
            new = np.add.reduceat(some != kind, at) > 0 if opening and n else size > 1
            readings.append((at, kinds, slot, new))
        for k in sizes:
            begin, _ = tokens.places(w.first, k)
            if len(begin):
                place = low + owner[begin], count[owner[begin]], begin - w.first[owner[begin]], np.full(len(begin), k)
                yield *place, tokens.mix(tokens.chain([value[begin + i] for i in range(k)]) + np.uint64(k)), np.zeros((len(begin), k), np.uint64)
            for at, kinds, slot, new in readings:
                begin, _ = tokens.places(np.searchsorted(at, w.first), k)
                if not len(begin):
                    continue
                spot = begin[:, None] + np.arange(k)
                literal = (kinds[spot] == 0).sum(1)
                keep = (literal < k) & (literal >= min(k, LITERALS))
                if at is not every:  # the others have been read before
                    keep &= new[spot].any(1)
                begin, spot = begin[keep], spot[keep]
                if len(begin):
                    template = np.where(kinds > 0, _PLACEHOLDER[kinds], value[at])
                    text, stop = owner[at[begin]], np.append(at, n)[begin + k]
                    yield (low + text, count[text], at[begin] - w.first[text], stop - at[begin],
                           tokens.mix(~tokens.chain([template[begin + i] for i in range(k)]) + np.uint64(k)), slot[spot])


_DDL = "id long, row long, words int, pos int, more int, key long, slots array<long>"


def _reader(sizes: list[int], table: np.ndarray | None, short: bool):
    """Windows of (id, row, text) batches: those whose key is in the table, or all; ``short``: texts below the window size are one window.
    ``more`` counts the places after the first at which a window of words begins that lies in this one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column("id"), batch.column("row")
            for text, words, pos, span, key, slots in windows(batch.column("text"), sizes):
                k = slots.shape[1]
                keep = np.ones(len(key), bool) if table is None else table[(key % np.uint64(SLOTS)).astype(np.int64)]
                if short and k < WINDOW:
                    keep &= words == span
                if keep.any():
                    n = int(keep.sum())
                    flat = pa.array(np.ascontiguousarray(slots[keep]).view(np.int64).ravel())
                    yield pa.record_batch({"id": ids.take(pa.array(text[keep])), "row": rows.take(pa.array(text[keep])), "words": pa.array(words[keep], pa.int32()),
                                           "pos": pa.array(pos[keep], pa.int32()), "more": pa.array(np.maximum(span[keep] - WINDOW, 0), pa.int32()), "key": pa.array(key[keep].view(np.int64)),
                                           "slots": pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * k, pa.int32()), flat)})
    return run


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text") -> DataFrame:
    """(id, row, item, n_windows, matched, agreement, verbatim) of every document that leaks an item; ``row`` is the text's hash.

    Document windows are first looked up in a table of fixed size, then joined by key, then counted per document, item,
    place and alignment: the join yields rows only where a window of the benchmark stands in a document.
    """
    def shaped(df: DataFrame, ident: str, text: str) -> DataFrame:
        return df.select(q(ident).cast("bigint").alias("id"), F.xxhash64(q(text)).alias("row"), F.coalesce(q(text).cast("string"), F.lit("")).alias("text"))

    ready(docs.sparkSession)
    items = settled(shaped(benchmark, item_col, item_text_col).mapInArrow(_reader(list(range(1, WINDOW + 1)), None, True), _DDL), "items")
    sizes = [WINDOW] + [r[0] for r in items.where(F.size("slots") < WINDOW).select(F.size("slots")).distinct().collect()]  # four more at most
    table = np.zeros(SLOTS, bool)
    slots = items.select(F.col("key").bitwiseAND(SLOTS - 1).alias("s")).distinct().toArrow()  # SLOTS rows at most
    table[slots["s"].to_numpy()] = True
    packed = np.packbits(table)

    def document_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _reader(sizes, np.unpackbits(packed).astype(bool), False)(batches)

    seen = shaped(docs, id_col, text_col).mapInArrow(document_windows, _DDL).drop("words", "more")
    total = F.greatest(F.col("words") - WINDOW + 1, F.lit(1))
    there = items.select("key", F.col("id").alias("item"), F.col("row").alias("item_row"), "words", total.alias("n_windows"), F.col("pos").alias("item_start"), "more", F.col("slots").alias("item_slots"))
    hits = seen.join(there, "key")
    # nearby hits share a band of the item's length; the bands of the second row of bands straddle the borders of the first
    shift = F.col("pos") - F.col("item_start")
    band = F.explode(F.array(F.floor(shift / F.col("words")) * 2, F.floor((shift + F.col("words") / 2) / F.col("words")) * 2 + 1)).alias("band")
    place = ["id", "row", "item", "item_row", "band"]
    hits = settled(hits.select("id", "row", "item", "item_row", "n_windows", "item_start", "more", "pos", shift.alias("shift"), band, "slots", "item_slots"), "hits")
    hits = hits.withColumn("item_pos", F.explode(F.sequence("item_start", F.col("item_start") + F.col("more"))))
    enough = F.col("matched") >= F.col("n_windows") * COVER
    cover = hits.groupBy(*place).agg(F.max("n_windows").alias("n_windows"), F.countDistinct("item_pos").alias("matched")).where(enough).select(*place)
    # a window of the document stands for one of the item, so two rows of a table are not all the like rows of an item
    starts = F.countDistinct("item_start")
    matched = F.floor(F.countDistinct("item_pos") * F.least(F.countDistinct("pos"), starts) / starts).alias("matched")
    same = [F.col(f"h.{c}").eqNullSafe(F.col(f"c.{c}")) for c in place]
    found = _aligned(hits.alias("h").join(cover.alias("c"), same, "left_semi"), place).groupBy(*place, "alignment")
    pairs = found.agg(F.max("n_windows").alias("n_windows"), matched, F.flatten(F.collect_list("pairs")).alias("pairs")).where(enough)
    # written here, as one plan of all steps costs the driver as much again with every exchange that ends
    pairs = settled(pairs, "alignments").select(*place, "alignment", "n_windows", "matched", F.explode_outer("pairs").alias("p"))
    by = [*place, "alignment", "n_windows", "matched"]
    mapped = pairs.groupBy(*by, "p.a", "p.b").agg(F.count("p").alias("n"))
    best = mapped.groupBy(*by, "a").agg(F.max("n").alias("most"), F.sum("n").alias("n"), F.sum(F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0)).alias("same"))
    agree = best.groupBy(*by).agg(F.coalesce(F.try_divide(F.sum("most"), F.sum("n")), F.lit(1.0)).alias("agreement"), (F.sum("same") == F.sum("n")).alias("verbatim"))
    # of several alignments the fullest one is reported
    top = F.max(F.struct("matched", "agreement", "verbatim")).alias("top")
    out = agree.where(F.col("agreement") >= AGREE).groupBy("id", "row", "item").agg(F.max("n_windows").alias("n_windows"), top)
    return out.select("id", "row", "item", "n_windows", "top.matched", "top.agreement", "top.verbatim")


def _aligned(hits: DataFrame, place: list[str]) -> DataFrame:
    """(place, alignment, n_windows, item_pos, item_start, pos, pairs): the hits of every alignment tried in a place, with their (item, document) slot values.

    A window that repeats in an item also meets its other places, so agreement is that of an alignment, not of all hits: the hits of one
    shift; per position the hit whose shift has most hits, or the hit nearest to a shift with most; and all word-for-word hits.
    """
    pairs = F.filter(F.arrays_zip(F.col("item_slots").alias("a"), F.col("slots").alias("b")), lambda p: (p.a != 0) | (p.b != 0))
    # a spot met in several ways counts once, by the nearest window and with the slots of its template
    first = F.max(F.struct("item_start", "pos", F.size("pairs").alias("n"), "pairs")).alias("first")
    spots = (hits.withColumn("pairs", pairs).withColumn("literal", F.size("pairs") == 0).groupBy(*place, "shift", "item_pos")
             .agg(F.max("n_windows").alias("n_windows"), F.max("literal").alias("literal"), first).select("*", "first.item_start", "first.pos", "first.pairs").drop("first"))
    near = Window.partitionBy(*place)
    voted = spots.withColumn("votes", F.count(F.lit(1)).over(Window.partitionBy(*place, "shift"))).withColumn("most", F.max("votes").over(near))
    # like rows around an inserted text let several shifts have most hits; each of them is tried
    mains = F.collect_set(F.when(F.col("votes") == F.col("most"), F.col("shift"))).over(near)
    voted = voted.withColumn("mains", mains).withColumn("main", F.explode("mains"))
    far, position = F.abs(F.col("shift") - F.col("main")), Window.partitionBy(*place, "main", "item_pos")
    ranked = voted.withColumns({"by_votes": F.row_number().over(position.orderBy(F.desc("votes"), far, "shift")),
                                "by_distance": F.row_number().over(position.orderBy(far, F.desc("votes"), "shift"))})
    name = lambda kind, at: F.struct(F.lit(kind).alias("kind"), F.col(at).cast("long").alias("shift"))
    once = F.col("main") == F.array_min("mains")
    tried = F.array(F.when(once, name(0, "shift")), F.when(F.col("by_votes") == 1, name(1, "main")), F.when(F.col("by_distance") == 1, name(2, "main")),
                    F.when(once & F.col("literal"), name(3, "main")))
    return ranked.select(*place, F.explode(F.array_compact(tried)).alias("alignment"), "n_windows", "item_pos", "item_start", "pos", "pairs")


def drop_leaking(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that leak no item, with its columns."""
    bad = leaks(docs, benchmark, id_col, text_col).select(F.col("id").alias("bad_id"), F.col("row").alias("bad_row")).distinct()
    ident, row = unused(docs, "leak_id", "leak_row")
    keyed = docs.withColumns({ident: q(id_col).cast("bigint"), row: F.xxhash64(q(text_col))})
    return keyed.join(bad, q(ident).eqNullSafe(F.col("bad_id")) & (q(row) == F.col("bad_row")), "left_anti").select(*map(q, docs.columns))

"""Personal data: fixed patterns, and boosted trees over proposals of generous generators. Column expressions throughout.

Positions come from cutting the text at the matches: ``split`` gives what lies between them, ``regexp_extract_all`` the matches
themselves, and running lengths give code-point offsets (the end is exclusive). Before matching, single separators inside numbers
and single dots inside host names are replaced by one placeholder character, so that the patterns only repeat character classes and neither
recurse nor go back on very long runs.

The generators propose overlapping spans of e-mail-like and number-like strings. The trees learn from soft format and context which
proposals look like those that a pattern confirmed, with the mark by which it did (plus and country code, kind of at sign, check sums)
hidden. The others are unlabelled, not negative: the share of true ones among them is estimated from the scores of the confirmed ones,
and a threshold per kind selects what is added. A proposal that touches a pattern's span, or that a check sum refutes, is never added.

Defined cases: null text counts as empty; a text without finds has no spans; with no confirmed proposal nothing is added; an empty table
gives no rows; repeated rows are each reported; extra columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm import boosting
from tidemill.llm.common import q
from tidemill.session import settled

BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("email_like", "number_like")
PRECISION = 0.95  # estimated, of what lies above a threshold, over all proposals
LEAST = 0.5  # a threshold is this at least: proposals that look the same are confirmed more often than not
FEATURES = ["length", "digits", "letters", "separators", "distinct", "groups", "longest_group", "dots", "before_word", "after_word", "cue", "line_start"]
CUE = r"(?i)(phone|tel|call|mobile|fax|mail|contact|card|visa|iban|account|ssn|ip|address)\W{0,3}$"

# Fixed patterns of the contract, in terms of the placeholder \x01 (see ``_compact`` and ``_dotted``).
EMAIL = r"(?:(?<![A-Za-z0-9._%+\x01-])|\G)[A-Za-z0-9._%+\x01-]++@[A-Za-z0-9-]++\x01[A-Za-z0-9\x01-]*+"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9][0-9\x01]++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
OCTETS = r"^0*([0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])(\.0*([0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])){3}$"

# Generators of proposals.
EMAIL_LIKE = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9][A-Za-z0-9.-]*+"
NUMBER_LIKE = r"[+(]?[0-9][0-9 ().-]{5,}[0-9]"
MARK = r"^\+(?:[0-9]{1,3}[ .-]*(?=[ (.-]|(?<=[ .-])[0-9]))?"  # a plus, and the country code if it stands apart
AT = r" ?(?:@|\(at\)|\[at\]) ?"


def _compact(text: Column) -> Column:
    """One space or hyphen between digits becomes the placeholder; lengths stay."""
    return F.regexp_replace(F.translate(text, "\x01", "\x02"), r"(?<=[0-9])[ -](?=[0-9])", "\x01")


def _dotted(text: Column) -> Column:
    """One dot between characters of host names becomes the placeholder; lengths stay."""
    return F.regexp_replace(F.translate(text, "\x01", "\x02"), r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", "\x01")


def located(text: Column, pattern: str, kind: str, when: Column) -> Column:
    """All leftmost matches of a pattern as structs (kind, start, end, found); none unless ``when``."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<kind:string,start:int,end:int,found:string>>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        start = s.at + F.length(x.gap)
        end = start + F.length(x.hit)
        return F.struct(end.alias("at"), F.concat(s.out, F.array(F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), x.hit.alias("found")))).alias("out"))

    pairs = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, h: F.struct(g.alias("gap"), h.alias("hit")))
    return F.when(when, F.aggregate(pairs, zero, step, lambda s: s.out)).otherwise(zero.getField("out"))


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    back = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        twice = 2 * d - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """The spans of the fixed patterns, per kind."""
    digit = text.rlike("[0-9]")
    between = lambda x, low, high: F.length(_digits(x.found)).between(low, high)
    return {
        "email": located(_dotted(text), EMAIL, "email", F.contains(text, F.lit("@"))),
        "ip": F.filter(located(text, IP, "ip", digit & F.contains(text, F.lit("."))), lambda x: x.found.rlike(OCTETS)),
        "card": F.filter(located(_compact(text), CARD, "card", digit), lambda x: F.when(between(x, 13, 19), luhn(_digits(x.found))).otherwise(False)),
        "phone": F.filter(located(text, PHONE, "phone", digit & F.contains(text, F.lit("+"))), lambda x: between(x, 9, 15)),
    }


def proposals(text: Column) -> Column:
    """Overlapping spans of the generators."""
    at = F.contains(text, F.lit("@")) | F.contains(text, F.lit("(at)")) | F.contains(text, F.lit("[at]"))
    return F.concat(located(text, EMAIL_LIKE, "email_like", at), located(text, NUMBER_LIKE, "number_like", text.rlike("[0-9].{5}")))


def _described(text: Column, x: Column) -> Column:
    """A proposal with its features."""
    found = F.regexp_replace(F.regexp_replace(x.found, MARK, ""), AT, "@")  # without what decides
    count = lambda pattern: F.length(F.regexp_replace(found, pattern, "")).cast("double")
    before, after = F.substring(text, F.greatest(x.start - 15, F.lit(1)), F.least(x.start, F.lit(16))), F.substring(text, x.end + 1, F.lit(2))
    groups = F.filter(F.split(found, "[^0-9]+"), lambda g: g != "")
    values = {
        "length": F.length(found), "digits": count("[^0-9]"), "letters": count("[^A-Za-z]"), "separators": count("[0-9A-Za-z]"),
        "distinct": F.size(F.array_distinct(F.split(found, "(?!^)"))), "groups": F.size(groups),
        "longest_group": F.coalesce(F.array_max(F.transform(groups, lambda g: F.length(g))), F.lit(0)),
        "dots": count("[^.]"),
        "before_word": F.when(before.rlike(r"[\p{L}0-9_]$"), 1).otherwise(0), "after_word": F.when(after.rlike(r"^[\p{L}0-9_]"), 1).otherwise(0),
        "cue": F.when(before.rlike(CUE), 1).otherwise(0), "line_start": F.when((x.start == 0) | before.rlike(r"\n$"), 1).otherwise(0),
    }
    return F.struct(x.kind.alias("kind"), x.start.alias("start"), x.end.alias("end"), *[v.cast("double").alias(k) for k, v in values.items()])


def _refuted(x: Column) -> Column:
    """Whether a proposal has the form of an address or a card and fails its check."""
    return F.when(x.kind != "number_like", False).when(x.found.rlike(r"^[0-9]+(\.[0-9]+){3}$"), ~x.found.rlike(OCTETS)).when(
        F.startswith(x.found, F.lit("+")), False).when(F.length(_digits(x.found)).between(13, 19), ~luhn(_digits(x.found))).otherwise(False)


def _touches(x: Column, spans: Column) -> Column:
    return F.exists(spans, lambda b: (b.start < x.end) & (x.start < b.end))


def found_in(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, proposed) per row: the patterns' spans, and the proposals with features, whether they touch one and whether a check refutes them."""
    plain = docs.select(q(id_col).alias("id"), F.coalesce(q(text_col).cast("string"), F.lit("")).alias("text"))
    base = F.concat(*[F.transform(spans, lambda x: F.struct(x.kind.alias("kind"), x.start.alias("start"), x.end.alias("end"))) for spans in base_spans(F.col("text")).values()])
    some = plain.select("id", "text", base.alias("base"), proposals(F.col("text")).alias("raw"))
    marked = lambda x: F.struct(_described(F.col("text"), x).alias("p"), _touches(x, F.col("base")).alias("confirmed"), _refuted(x).alias("refuted"))
    return some.select("id", "base", F.transform("raw", marked).alias("proposed"))


def learn(found: DataFrame) -> tuple[boosting.Boosted, dict[str, float]]:
    """Trees over the features of all proposals, and the threshold of every kind (2: nothing is added).

    The trees give the chance to be confirmed; divided by its mean over the confirmed proposals it is the chance to be of their sort.
    Proposals that look the same are one row with a weight, so the training reads far fewer rows than there are proposals.
    """
    rows = found.select(F.explode("proposed").alias("x")).select("x.p.*", F.col("x.confirmed").cast("int").alias("label"))
    sorts = rows.groupBy("kind", "label", *FEATURES).agg(F.count(F.lit(1)).alias("n"))
    sorts = settled(sorts.sortWithinPartitions("kind", "label", *FEATURES), "proposals")  # the same order, the same sums
    model = boosting.fit(sorts, FEATURES, "label", weight="n")
    steps = sorts.select("kind", "label", "n", F.floor(model.probability() * 100).alias("step")).groupBy("kind", "step").agg(
        F.sum(F.col("label") * F.col("n")).alias("good"), F.sum("n").alias("n")).collect()
    limits = dict.fromkeys(MORE_KINDS, 2.0)
    for kind in MORE_KINDS:  # at most 101 steps per kind
        mine = sorted((r for r in steps if r.kind == kind and r.good is not None), key=lambda r: -r.step)
        confirmed = sum(r.good for r in mine)
        if not confirmed:
            continue
        usual = sum(r.good * r.step for r in mine) / 100 / confirmed
        right = n = 0
        for row in mine:
            right, n = right + row.n * min(1.0, row.step / 100 / max(usual, 0.01)), n + row.n
            if right >= PRECISION * n and row.step >= 100 * LEAST:
                limits[kind] = row.step / 100
    return model, limits


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans) per row: the patterns' spans by kind and start, and all spans likewise."""
    found = settled(found_in(docs, id_col, text_col), "personal")
    model, limits = learn(found)

    def added(kind: str) -> Column:
        chosen = F.filter("proposed", lambda x: (x.p.kind == kind) & ~x.confirmed & ~x.refuted & (model.probability(lambda name: x.p[name]) >= limits[kind]))
        return F.transform(chosen, lambda x: F.struct(x.p.kind.alias("kind"), x.p.start.alias("start"), x.p.end.alias("end")))

    return found.select("id", "base", F.concat("base", *[added(k) for k in MORE_KINDS]).alias("spans"))


def joined(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x.kind, x.start, x.end)), ",")

"""URL filtering: explicit rules first, boosted trees on lexical features for the rest.

The trees learn from the URLs that a rule already decides, so the verdict generalises the rule list.

Defined cases: null, or no ``://``: host and path are empty, no rule fits, the trees decide; only A-Z of a host is
lower-cased; ports and user names stay in the host; an empty table gives no rows; with rules that decide nothing (or only
one way) the trees answer with the one verdict seen, or allow if there is none; extra columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm import boosting
from tidemill.llm.common import lower_ascii, q
from tidemill.session import settled

#: Verdict per rule (host, path), the rules of the contract.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
SAMPLE = 20_000  # labelled URLs to learn from, at most: those with the smallest hash
FEATURES = ["url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "entropy", "params", "query_length", "hyphens",
            "has_fragment", "secure", "suffix_log_count", "suffix_allow_share"]


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return lower_ascii(rest)


def path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, its verdict) for the longest rule that fits, else nulls. The rule list is a literal, so keep it to some hundreds."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, text in sorted(rules, key=lambda r: len(r[1])):
        at, slash, below = text.partition("/")
        fits = ((host == at) | F.endswith(host, F.lit("." + at))) & F.startswith(path, F.lit(slash + below))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def _entropy(text: Column) -> Column:
    """Bits per character."""
    letters = F.split(text, "(?!^)")
    n = F.length(text)
    share = lambda x: (n - F.length(F.replace(text, x, F.lit("")))) / n
    return F.when(n > 0, F.aggregate(F.array_distinct(letters), F.lit(0.0), lambda a, x: a - share(x) * F.log2(share(x)))).otherwise(0.0)


def _lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    text = F.coalesce(url, F.lit(""))
    count = lambda pattern: F.length(text) - F.length(F.regexp_replace(text, pattern, ""))
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    columns = {
        "url_length": F.length(text), "host_length": F.length(host), "path_length": F.length(path),
        "depth": F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit(""))),
        "labels": F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))),
        "digit_ratio": count("[0-9]") / F.greatest(F.length(text), F.lit(1)), "entropy": _entropy(host),
        "params": F.when(query == "", 0).otherwise(F.size(F.split(query, "&"))), "query_length": F.length(query), "hyphens": count("-"),
        "has_fragment": F.when(F.instr(text, "#") > 0, 1).otherwise(0), "secure": F.when(F.startswith(text, F.lit("https://")), 1).otherwise(0),
    }
    return {k: c.cast("double") for k, c in columns.items()}


def verdicts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, sample: int = SAMPLE) -> DataFrame:
    """id, host, path, rule, verdict, score (probability of allow) for every row.

    The statistics of host suffixes cover all rows; they are one row per suffix, joined by an exchange unless the optimizer
    finds them small.
    """
    base = pages.select(q(id_col).alias("id"), q(url_col).cast("string").alias("url"))
    base = base.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    rule, by_rule = rule_for(F.col("host"), F.col("path"), rules)
    base = base.withColumns({"rule": rule, "by_rule": by_rule, "suffix": F.substring_index("host", ".", -1)})
    seen, allowed = F.count("by_rule"), F.sum(F.when(F.col("by_rule") == "allow", 1).otherwise(0))
    stats = base.groupBy("suffix").agg(F.log1p(F.count(F.lit(1))).alias("suffix_log_count"), ((allowed + 1) / (seen + 2)).alias("suffix_allow_share"))
    rows = base.join(settled(stats, "suffixes"), "suffix").withColumns(_lexical(F.col("url"), F.col("host"), F.col("path")))
    labelled = rows.where("by_rule is not null").select(*FEATURES, F.when(F.col("by_rule") == "allow", 1).otherwise(0).alias("label"), F.xxhash64("url").alias("h"))
    model = boosting.fit(labelled.orderBy("h").limit(sample), FEATURES, "label")
    scored = rows.withColumn("score", model.probability())
    return scored.select("id", "host", "path", "rule", F.coalesce("by_rule", F.when(F.col("score") >= 0.5, "allow").otherwise("block")).alias("verdict"), "score")

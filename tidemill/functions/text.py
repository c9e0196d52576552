"""Keyword splitting and the last-token word check."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def words(col: Column) -> Column:
    """Lower-case letter/digit runs of the whole text, in order; empty for null."""
    return F.regexp_extract_all(F.lower(F.coalesce(col, F.lit(""))), F.lit(r"([\p{L}\p{N}]+)"), 1)


def explode_words(df: DataFrame, col: str, out: str = "keyword") -> DataFrame:
    """One row per word occurrence, the table-function form."""
    return df.withColumn(out, F.explode(words(F.col(col)))).drop(col)


def cleaned(col: Column, default: str, width: int | None = None) -> Column:
    """Trimmed text with a default for null, optionally cut to ``width`` characters."""
    value = F.coalesce(F.trim(col), F.lit(default))
    return value if width is None else F.substring(value, 1, width)


def moderated(df: DataFrame, text: str, word_table: DataFrame) -> DataFrame:
    """Flag rows whose last comma-separated token is in ``word_table(word)``.

    The word table is small by nature, but its join side is left to the optimizer, which checks the size.
    """
    token = F.element_at(F.split(F.col(text), ","), -1)
    listed = word_table.select(F.col("word").alias("_word")).distinct().withColumn("_hit", F.lit(True))
    joined = df.withColumn("_word", token).join(listed, "_word", "left")
    hit = F.col("_hit").isNotNull()
    return (joined
            .withColumn("is_violation", F.when(hit, 1).otherwise(0))
            .withColumn("violation_grade", F.when(hit, "P0"))
            .withColumn("violation_msg", F.when(hit, F.col("_word")))
            .drop("_word", "_hit"))


def snake_case(name: str) -> str:
    """``orderId`` -> ``order_id``."""
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name).lower()


def to_snake_json(names: Sequence[str]) -> Column:
    """The columns as one JSON text with snake-case names."""
    return F.to_json(F.struct(*[F.col(n).alias(snake_case(n)) for n in names]))

"""Personal-data masking: hash, keep-first, keep-three, and validate-then-hash."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted mobile number and mail address shapes.
PHONE = r"^(13[0-9]|14[01456879]|15[0-35-9]|16[2567]|17[0-8]|18[0-9]|19[0-35-9])\d{8}$"
EMAIL = r"^[a-zA-Z0-9_-]+@[a-zA-Z0-9_-]+(\.[a-zA-Z0-9_-]+)+$"


def first_letter(col: Column) -> Column:
    """``Zhang San`` -> ``Z*``."""
    return F.concat(F.substring(col, 1, 1), F.lit("*"))


def keep_three(col: Column) -> Column:
    """``13812345678`` -> ``138*``."""
    return F.concat(F.substring(col, 1, 3), F.lit("*"))


def mail_domain(col: Column) -> Column:
    """``a@b.c`` -> ``*@b.c``; null where there is no ``@``."""
    return F.concat(F.lit("*@"), F.get(F.split(col, "@"), 1))


def hashed_phone(col: Column) -> Column:
    return F.md5(F.when(col.rlike(PHONE), col))


def hashed_email(col: Column) -> Column:
    return F.md5(F.when(col.rlike(EMAIL), col))


def only_allowed(col: Column, allowed: str = "a-zA-Z0-9_") -> Column:
    """True when the text consists of the allowed character class only."""
    return col.rlike(f"^[{allowed}]+$")


def hash_bucket(col: Column, buckets: int) -> Column:
    """Last three hex digits of the md5, modulo ``buckets``, four digits wide."""
    tail = F.conv(F.right(F.md5(col), F.lit(3)), 16, 10).cast("int")
    return F.lpad((tail % buckets).cast("string"), 4, "0")

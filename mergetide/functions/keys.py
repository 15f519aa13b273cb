"""Composite keys "source::native" of accounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mergetide.functions.text import present, trimmed


def account_key(source: Column, native: Column) -> Column:
    """"source::native", both trimmed; null if either is blank."""
    return F.when(present(source) & present(native), F.concat(trimmed(source), F.lit("::"), trimmed(native)))


def key_parts(key: Column) -> Column:
    """struct<source, native>, split at the first "::"; null if either part is blank."""
    at = F.locate("::", key)
    a, b = trimmed(F.substring(key, F.lit(1), at - 1)), trimmed(F.substring(key, at + 2, F.lit(1 << 30)))
    return F.when((at > 1) & present(a) & present(b), F.struct(a.alias("source"), b.alias("native")))


def clean_key(key: Column) -> Column:
    p = key_parts(key)
    return account_key(p["source"], p["native"])

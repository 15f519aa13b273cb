"""Presence, case, spacing, bracketed lists and normal forms of texts, as Columns."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: White space of all scripts, and the byte order mark; trim() knows only the space.
SPACE = r"[\s   -     　﻿]"


def trimmed(c: Column) -> Column:
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def present(c: Column) -> Column:
    """True unless null or only white space."""
    return F.coalesce(F.length(trimmed(c)) > 0, F.lit(False))


def trim_or_null(c: Column) -> Column:
    return F.nullif(trimmed(c), F.lit(""))


def first_present(*cs: Column) -> Column:
    return F.coalesce(*[F.when(present(c), c) for c in cs])


def split_tokens(c: Column) -> Column:
    """array: the different texts in square brackets, in order; the whole trimmed text where there are none. A bracket holds two characters or more,
    so neighbours of one character run together."""
    found = F.array_distinct(F.filter(F.transform(F.regexp_extract_all(c, F.lit(r"\[(.+?.)\]"), F.lit(1)), trimmed), lambda x: x != ""))
    return F.when(~present(c), F.array().cast("array<string>")).when(F.size(found) > 0, found).otherwise(F.array(trimmed(c)))


def bracketed(c: Column) -> Column:
    """The sorted different values of an array as "[a] [b]"."""
    return F.array_join(F.transform(F.array_sort(F.array_distinct(c)), lambda x: F.concat(F.lit("["), x, F.lit("]"))), " ")


def capitalized(c: Column) -> Column:
    """The first letter of every word that a space ends in upper case, the rest as it is."""
    return F.array_join(F.transform(F.split(c, " "), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30))), " ")


def cased(c: Column, case: str) -> Column:
    return {"lower": F.lower, "upper": F.upper, "capitalize": capitalized, "same": lambda x: x}[case](c)


def without_spaces(c: Column) -> Column:
    return F.regexp_replace(c, SPACE, "")


def upper_first(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, 2, 1 << 30))


def lower_first(c: Column) -> Column:
    return F.concat(F.lower(F.substring(c, 1, 1)), F.substring(c, 2, 1 << 30))


def padded(n: Column, digits: int) -> Column:
    """The number with zeros in front; longer ones as they are."""
    t = n.cast("string")
    return F.when(F.length(t) >= digits, t).otherwise(F.lpad(t, digits, "0"))


def kept_counter(text: Column, counter: Column, most: int) -> Column:
    """text and counter, the text cut so that both have at most ``most`` characters."""
    k = F.coalesce(counter, F.lit(""))
    return F.concat(F.substring(text, F.lit(1), F.greatest(F.lit(most) - F.length(k), F.lit(0))), k)


_LETTERS = str.maketrans({"ł": "l", "Ł": "L", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ı": "i", "þ": "th", "ð": "d", "–": "-", "—": "-", "’": "", "'": "", "‘": ""})


def to_ascii(text: str) -> str:
    """Latin letters without marks, apostrophes dropped; what has no ASCII form is left out."""
    t = unicodedata.normalize("NFKD", text.translate(_LETTERS))
    return t.encode("ascii", "ignore").decode()


def plain_name(text: str) -> str:
    """Lower case, without marks, only letters, digits and single spaces."""
    t = unicodedata.normalize("NFD", text.lower())
    return re.sub(r"\s+", " ", re.sub(r"[^a-z0-9\s]", "", re.sub(r"[̀-ͯ]", "", t))).strip()


def plain_text(text: str) -> str:
    """Lower case, without marks, single spaces."""
    t = re.sub(r"[̀-ͯ]", "", unicodedata.normalize("NFD", text.lower()))
    return re.sub(r"\s+", " ", t).strip()


# Particles of surnames that stay in lower case.
PARTICLES = ["van", "von", "de", "del", "della", "di", "da", "le", "la"]


def proper_name(text: str) -> str:
    """Upper case at the start of words and after hyphens, apostrophes, Mc and Mac; words that are particles in lower case. Spaces stay as they are."""
    def word(w: str) -> str:
        low = w.lower()
        if "-" in w:
            return "-".join(word(p) for p in w.split("-"))
        if "'" in w:
            return "'".join(p[:1].upper() + p[1:] for p in low.split("'"))
        for start, more in (("mc", 2), ("mac", 3)):
            if low.startswith(start) and len(low) > more:
                return start.capitalize() + low[more:].capitalize()
        return low if low in PARTICLES else low.capitalize()

    return " ".join(word(w) for w in text.split(" "))


def full_name(text: str) -> str:
    """proper_name of a text with single spaces, none around it."""
    return proper_name(" ".join(text.split()))


def _over(kernel, doc: str):
    @F.arrow_udf(StringType())
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for t in texts:
            d = t.dictionary_encode()
            done = pa.array([None if x is None else kernel(x) for x in d.dictionary.to_pylist()], pa.string())
            yield done.take(d.indices)

    def column(c: Column) -> Column:
        return run(c)

    column.__doc__ = doc
    return column


ascii_form = _over(to_ascii, "Column of to_ascii; each different text of a batch is computed once.")
name_form = _over(plain_name, "Column of plain_name.")
text_form = _over(plain_text, "Column of plain_text.")
proper_form = _over(proper_name, "Column of proper_name.")
full_form = _over(full_name, "Column of full_name.")


def ssn_form(c: Column) -> Column:
    """Nine digits, or '' if there are more or fewer."""
    d = F.regexp_replace(F.coalesce(c, F.lit("")), r"\D", "")
    return F.when(F.length(d) == 9, d).otherwise("")


def phone_form(c: Column) -> Column:
    """"+1 222 333 4444" of a North American number in any shape; "+" and digits of one that starts with another country's "+"; '' for others."""
    d = F.regexp_replace(F.coalesce(c, F.lit("")), r"\D", "")
    ten = F.regexp_extract(d, r"^(?:00)?1?(\d{10})$", 1)
    shown = F.concat(F.lit("+1 "), F.substring(ten, 1, 3), F.lit(" "), F.substring(ten, 4, 3), F.lit(" "), F.substring(ten, 7, 4))
    return F.when(ten.rlike(r"^[2-9]"), shown).when(trimmed(c).rlike(r"^\+(?!1)") & F.length(d).between(8, 15), F.concat(F.lit("+"), d)).otherwise("")


def email_form(c: Column) -> Column:
    """Lower case, without "mailto:" or separators around it; null if it isn't one address."""
    t = F.lower(F.regexp_replace(F.regexp_replace(trimmed(c), "(?i)^mailto:\\s*", ""), r"[\s;,]+$", ""))
    return F.when(t.rlike(r"^[^@\s]+@[^@\s.]+(\.[^@\s.]+)+$"), t)

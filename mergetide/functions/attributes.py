"""Open bags of attributes: maps of names to lists of texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from mergetide.functions.text import first_present, present, trimmed


def pick(bag: Column, name: str) -> Column:
    """The values under a name, or under the name with its first letter in lower case."""
    low = name[:1].lower() + name[1:]
    got = F.try_element_at(bag, F.lit(name))
    return got if low == name else F.coalesce(got, F.try_element_at(bag, F.lit(low)))


def single(values: Column) -> Column:
    """A list as one text: its values joined by ", "; null for an empty list."""
    return F.when(F.size(values) > 0, F.array_join(values, ", "))


def merged(*bags: Column, without: tuple[str, ...] = ()) -> Column:
    """The bags' attributes; of one name the last that isn't null."""
    def both(old: Column, new: Column) -> Column:
        return F.map_concat(F.map_filter(old, lambda k, v: ~F.map_contains_key(new, k)), new)

    none = F.map_from_arrays(F.array(), F.array()).cast("map<string,array<string>>")
    return reduce(both, [F.map_filter(F.coalesce(b, none), lambda k, v: v.isNotNull() & ~k.isin(list(without))) for b in bags])


def typed(value: Column, kind: str) -> Column:
    """A text as "string", "boolean" ("true" in any case), "int" or "long" (0 if it is no number); null stays null; other kinds are strings."""
    if kind == "boolean":
        return F.when(value.isNotNull(), F.lower(trimmed(value)) == "true")
    if kind in ("int", "long"):
        n = F.coalesce(trimmed(value).try_cast("double").cast("long"), F.lit(0))
        return F.when(value.isNotNull(), n.cast("int") if kind == "int" else n)
    return value


def as_set(values: Column) -> Column:
    """The present values of a list, trimmed, each once, in their order."""
    return F.array_distinct(F.transform(F.filter(F.coalesce(values, F.array().cast("array<string>")), present), trimmed))


def label(bag: Column, display: Column, name: Column, key: Column) -> Column:
    """What an identity is called: displayName among its attributes, its display name, name, or id."""
    return first_present(F.try_element_at(bag, F.lit("displayName")), display, name, key)


def needs_refresh(account: Column, row: Column, seconds: int = 60) -> Column:
    """Whether an account changed after its row by more than ``seconds``; null counts as the oldest, a missing row needs it."""
    us = lambda c: F.coalesce(F.unix_micros(c.cast("timestamp")), F.lit(0))
    return row.isNull() | (us(account) - us(row) > seconds * 1_000_000)


def with_attribute(bag: Column, name: str, values: Column) -> Column:
    """The bag with the values under a name, in place of those it had; a null bag counts as empty, and null values take the name out."""
    none = F.map_from_arrays(F.array(), F.array()).cast("map<string,array<string>>")
    rest = F.map_filter(F.coalesce(bag, none), lambda k, v: k != name)
    return F.when(values.isNotNull(), F.map_concat(rest, F.create_map(F.lit(name), values))).otherwise(rest)


def with_both_cases(bag: Column, name: str, values: Column) -> Column:
    """with_attribute under the name as it is and with its first letter in lower case."""
    low = name[:1].lower() + name[1:]
    out = with_attribute(bag, name, values)
    return out if low == name else with_attribute(out, low, values)


def references(items: Column) -> Column:
    """The texts that items of an array of struct<id, value, name> mean: the first of the three that isn't null, present ones only."""
    return F.filter(F.transform(F.coalesce(items, F.array().cast("array<struct<id:string,value:string,name:string>>")), lambda x: F.coalesce(x["id"], x["value"], x["name"])), present)


def tokens(json: Column) -> Column:
    """The tokens of a JSON value: of a list each text, number or boolean, or what an object means (see references); of anything else itself alone.

    A text that is no JSON is a token; null and blank give none. Order and repetition stay.
    """
    kind = "array<string>"
    meant = lambda x: F.when(x.startswith("{"), F.coalesce(*[F.get_json_object(x, f"$.{n}") for n in ("id", "value", "name")])).otherwise(x)
    listed = F.from_json(trimmed(json), kind)
    one = F.when(trimmed(json).rlike(r'^".*"$'), F.get_json_object(F.concat(F.lit('{"v":'), trimmed(json), F.lit("}")), "$.v")).otherwise(trimmed(json))
    all_ = F.when(trimmed(json).startswith("["), F.coalesce(listed, F.array().cast(kind))).otherwise(F.array(one))
    return F.when(~present(json), F.array().cast(kind)).otherwise(F.filter(F.transform(all_, meant), present))


# The names under which a bag may hold mail addresses.
MAIL_NAMES = ["email", "mail", "emailAddress", "Email", "Mail", "EmailAddress"]


def mails(bag: Column) -> Column:
    """The mail addresses of a bag, under any of MAIL_NAMES: trimmed, each once."""
    return as_set(F.flatten(F.array(*[F.coalesce(F.try_element_at(bag, F.lit(n)), F.array().cast("array<string>")) for n in MAIL_NAMES])))


def valid_mail(c: Column) -> Column:
    """Whether a text looks like one mail address."""
    return F.coalesce(trimmed(c).rlike(r"^[^\s@]+@[^\s@]+\.[^\s@]+$"), F.lit(False))


def account_name(key: Column, native: Column, bag: Column, identity: Column) -> Column:
    """What an account is called where it has no name: its key, native identity, name among its attributes, or identity."""
    return first_present(key, native, single(pick(bag, "name")), identity)


def output_key(bag: Column, unique: str, native: Column, required: bool) -> Column:
    """struct<lookup, unique>: the key of an output row: its native identity, and the value of the attribute ``unique``. Where that has none, the native
    identity stands for it, or, if it is ``required``, the key is null and the row is to be left out."""
    own = single(pick(bag, unique))
    value = F.when(present(own), own) if required else first_present(own, native)
    return F.when(value.isNotNull(), F.struct(native.alias("lookup"), value.alias("unique")))

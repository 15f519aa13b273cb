"""Output schemas: what sources, mappings and definitions name, and the projection onto it."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from mergetide.functions.attributes import pick, single, typed
from mergetide.operators.mapping import Mapping


@dataclass(frozen=True)
class Field:
    name: str
    kind: str = "string"
    multi: bool = False


def discovered(base: Iterable[Field], sources: Iterable[Iterable[Field]], mappings: Iterable[Mapping] = (), computed: Iterable[str] = ()) -> list[Field]:
    """The fields by lower-case name: base, then sources (the first source that names a field decides), mappings (lists are multi) and computed ones."""
    out: dict[str, Field] = {f.name.lower(): f for f in base}
    for fields in reversed([list(s) for s in sources]):
        out |= {f.name.lower(): f for f in fields if f.name}
    for m in mappings:
        out[m.target.lower()] = Field(m.target, "string", m.merge == "list")
    for n in computed:
        out.setdefault(n.lower(), Field(n))
    return list(out.values())


def projected(rows: DataFrame, bag: Column, fields: list[Field], keep: list[str]) -> DataFrame:
    """rows with a typed column for each field, from a bag of lists of texts: one select, so that only named attributes are read."""
    def column(f: Field) -> Column:
        v = pick(bag, f.name)
        return (v if f.multi else typed(single(v), f.kind)).alias(f.name)

    return rows.select(*keep, *[column(f) for f in fields])

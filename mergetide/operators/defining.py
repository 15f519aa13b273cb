"""Define: computed attributes one after the other, each of which the next may use."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mergetide.functions.template import attribute
from mergetide.functions.text import first_present


@dataclass(frozen=True)
class Definition:
    """name: the attribute. The rest as in functions.template.attribute; refresh: compute it even where the row need not be computed anew."""

    name: str
    expression: str
    most: int | None = None
    trim: bool = False
    case: str = "same"
    spaces: bool = False
    normalize: bool = False
    refresh: bool = False


def define(rows: DataFrame, definitions: list[Definition], fallbacks: dict[str, str] | None = None, anew: Column | None = None, locked: dict[str, Column] | None = None) -> DataFrame:
    """rows with a column for each definition, in their order; columns of that name are the values so far.

    A result without a value takes the column that ``fallbacks`` names for the attribute, if that is present, else null. Where ``anew`` is not true the
    value so far stays, unless the definition refreshes. ``locked``: attributes whose value, where it isn't null, is given and not computed.
    """
    out = rows
    for d in definitions:
        names = {c: F.col(c).cast("string") for c, kind in out.dtypes if kind in ("string", "int", "bigint", "double", "boolean", "timestamp", "date")}
        made = attribute(d.expression, names, d.most, d.trim, d.case, d.spaces, d.normalize)
        if d.name in (fallbacks or {}):
            made = first_present(made, F.col(fallbacks[d.name]).cast("string"))
        if d.name in (locked or {}):
            made = F.coalesce(locked[d.name], made)
        if anew is not None and not d.refresh and d.name in out.columns:
            made = F.when(F.coalesce(anew, F.lit(False)), made).otherwise(F.col(d.name))
        out = out.withColumn(d.name, made)
    return out

"""Map: one value, or a list, per target attribute from the accounts of a person."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mergetide.functions.text import bracketed, present, split_tokens, trimmed


#: The column of the accounts that names the source of their entity's main account.
ORIGIN = "origin_source"


@dataclass(frozen=True)
class Mapping:
    """target: the attribute made. merge: first, source, list or concatenate. inputs: the attributes read, in order (by default the target alone, which
    is otherwise read last). source: for merge "source", whose accounts count."""

    target: str
    merge: str = "first"
    inputs: tuple[str, ...] = field(default=())
    source: str | None = None

    def order(self) -> list[str]:
        return [*[i for i in self.inputs if i != self.target], self.target] if self.inputs else [self.target]


def map_attributes(accounts: DataFrame, entity: str, mappings: list[Mapping], order: list[str], main: Column | None = None) -> DataFrame:
    """One row per entity with a column for each mapping, in one aggregation.

    ``accounts``: entity, source, the input attributes as texts, and the ordinals ``order`` (of the source, then of the account in it). The account
    where ``main`` is true comes first. first, source: the first bracket token of the first present value, accounts in order, inputs in order
    within an account; a source "$originSource" is the one that the column ORIGIN names for the entity. list: all tokens, different and sorted. concatenate: the list as "[a] [b]". Nothing present gives null, or an empty list.
    """
    first = F.when(F.coalesce(main, F.lit(False)), 0).otherwise(1) if main is not None else F.lit(0)
    out = []
    for m in mappings:
        wanted = F.col(ORIGIN) if m.source == "$originSource" else F.lit(m.source)
        counts = F.col("source") == wanted if m.merge == "source" and m.source else F.lit(True)
        if m.merge in ("first", "source"):
            own = F.coalesce(*[F.when(present(F.col(i)), F.get(split_tokens(F.col(i)), F.lit(0))) for i in m.order()])
            rank = F.struct(first, *[F.col(o) for o in order])
            out.append(F.min_by(own, F.when(counts & own.isNotNull(), rank)).alias(m.target))
        else:
            tokens = F.flatten(F.array(*[F.coalesce(split_tokens(F.col(i)), F.array().cast("array<string>")) for i in m.order()]))
            # Sets of sets, so that partial aggregation drops repeated values before the shuffle.
            all_ = F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.array_sort(F.array_distinct(tokens))))))
            out.append((all_ if m.merge == "list" else F.nullif(bracketed(all_), F.lit(""))).alias(m.target))
    return accounts.where(F.col(entity).isNotNull()).groupBy(entity).agg(*out)


def history(previous: Column, entry: Column, most: int = 10) -> Column:
    """The history with an entry more: none that repeats the last, the last ``most`` kept."""
    old = F.coalesce(previous, F.array().cast("array<string>"))
    last = F.try_element_at(old, F.lit(-1))
    added = F.when(entry.isNull() | (last == entry), old).otherwise(F.array_append(old, entry))
    return F.when(F.size(added) > most, F.slice(added, -most, most)).otherwise(added)


def switched_main(accounts: DataFrame, entity: str, mappings: list[Mapping], order: list[str], main: Column, account: str = "account", switch: str = "mainAccount") -> DataFrame:
    """map_attributes where one of the mappings, ``switch``, names the main account for those after it: two aggregations, up to it and from there on."""
    at = next((k for k, m in enumerate(mappings) if m.target == switch), len(mappings) - 1)
    first = map_attributes(accounts, entity, mappings[: at + 1], order, main)
    if at + 1 >= len(mappings):
        return first
    told = accounts.join(first.select(entity, F.col(switch).alias("_main")), entity, "left")
    rest = map_attributes(told, entity, mappings[at + 1 :], order, F.when(F.col("_main").isNotNull(), F.col("_main") == F.col(account)).otherwise(main))
    return first.join(rest, entity)


def merged_values(old: DataFrame, mapped: DataFrame, entity: str, targets: list[str], fixed: dict[str, Column] | None = None, managed: Column | None = None) -> DataFrame:
    """The entities' values after a mapping: ``old`` (entity, targets, any other columns) with those of ``mapped``.

    A target that maps to nothing is cleared, unless ``managed`` is false for the row (it has no accounts, so nothing could map). ``fixed``: targets whose old
    value stays where the condition holds and there is one, as of ids and names that may not change, and unique values. History entries are trimmed, blank
    ones dropped.
    """
    both = old.join(mapped.select(entity, *[F.col(t).alias(f"_{t}") for t in targets]), entity, "left")
    out = []
    for t in targets:
        new = F.col(f"_{t}")
        if t == "history":
            new = F.filter(F.transform(new, trimmed), lambda x: x != "")
        if managed is not None:
            new = F.when(new.isNull() & ~F.coalesce(managed, F.lit(True)), F.col(t)).otherwise(new)
        if t in (fixed or {}):
            new = F.when(F.coalesce(fixed[t], F.lit(False)) & F.col(t).isNotNull(), F.col(t)).otherwise(new)
        out.append(new.alias(t))
    return both.select(entity, *[c for c in old.columns if c != entity and c not in targets], *out)

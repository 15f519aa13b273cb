"""Problem 6: postal addresses of one location, by weighted character n-grams in a prefix-filtered inverted index.

Typed addresses are read into house number, unit, direction, street name (all its words up to the kind of street), kind, town and postal code; equal
readings are one variant. A variant is a vector of three parts: the grams of its street's name, of its town and of its code, weighted by their
rarity over all variants, each part with a fixed share of the whole. Two variants are one location if the cosine of their whole vectors reaches
COSINE and house number, unit, kind, direction and place are compatible.

Candidates come from an inverted index. As town and code together can add no more than their shares to a cosine, two variants that reach COSINE agree in
their streets' grams by STREET_LEAST at least; so of each street only the rarest grams are indexed, up to where what is left has a norm below that: the
rarest gram that two such streets share is indexed for both. A posting stands under house number, unit, place and gram, since other numbers, units and
places are other locations whatever the cosine: so no list grows with the number of towns that have the same street. The place of a posting is the town
(each spelling under the commonest ones within a few edits, which an index of the towns' grams finds) or the digits of the code; of addresses that lack
one of the two, also the state.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from math import log1p, sqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mergetide.llm.places import STATES, _lookup, name_sql
from mergetide.session import cut, ship
from mergetide.sources import read_table

#: Least cosine of two whole vectors, and the shares of street, town and code in the square of a vector that has all three.
COSINE, SHARES = 0.6, (0.64, 0.20, 0.16)
#: What the streets' own cosine is at least, where the whole one reaches COSINE: town and code add at most their shares.
STREET_LEAST = (COSINE - SHARES[1] - SHARES[2]) / SHARES[0]
#: A gram counts as borne by this share of the variants at least: else the odd grams of a slip would outweigh the rest of a name.
FLOOR = 0.005
#: Variants added to both counts of a share, as a few variants say little about rarity.
SMOOTH = 5
#: Letters of a gram; a street's name may differ by one edit for every EDIT_EACH letters of the shorter one, and two at least.
GRAM, EDIT_EACH = 2, 3.5
#: Edits allowed between spellings of a town: for fewer than 5 letters, fewer than 9, and more.
TOWN_EDITS = (1, 2, 3)

# Short forms of the kinds of street, of directions and of what precedes a unit; and what stands for a town that isn't given.
KINDS = {
    "avenue": "ave av aven avn", "boulevard": "blvd boul bvd", "circle": "cir circ", "court": "ct crt", "crescent": "cres cr", "drive": "dr drv", "highway": "hwy hiway", "lane": "ln la",
    "parkway": "pkwy pky pway", "place": "pl plc", "road": "rd", "square": "sq sqr", "street": "st str strt", "terrace": "ter terr", "alley": "aly", "way": "wy", "trail": "trl",
}
DIRECTIONS = {"north": "n no nth", "south": "s so sth", "east": "e", "west": "w"}
UNITS = ["apartment", "apt", "unit", "suite", "ste", "flat", "room", "rm"]
NO_TOWN = ["", "na", "none", "unknown", "tbd", "tbc", "hq", "remote", "various", "homeoffice", "fieldbased", "sameasabove", "notprovided", "pending", "null", "seehr", "xxx", "x"]

_KIND = {w: k for k, v in KINDS.items() for w in [k, *v.split()]}
_DIRECTION = {w: k for k, v in DIRECTIONS.items() for w in [k, *v.split()]}
_LOOKALIKE = str.maketrans("0135", "oles")
_NOISE = re.compile(r"\bc/o\b[^,]*,?|\battn\b[^,]*,?|\([^)]*\)|\b\d+(?:st|nd|rd|th) floor(?: \w+)?|\bfloor \d+\b|\b(?:rear|lobby|reception)\b")
_TOKEN = re.compile(r"[a-z0-9]+|#|,")
_NUMBER, _UNIT, _ORDINAL = re.compile(r"\d+"), re.compile(r"\d+[a-z]?"), re.compile(r"\d+(?:st|nd|rd|th)")


def _edits(a: str, b: str, most: int) -> bool:
    """Whether a and b are within ``most`` edits, a swap of neighbours being one."""
    if abs(len(a) - len(b)) > most:
        return False
    before: list[int] = []
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            d = min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            new.append(d)
        before, row = row, new
    return row[-1] <= most


@lru_cache(1 << 14)
def _kind(word: str) -> str | None:
    if k := _KIND.get(word):
        return k
    return next((k for k in KINDS if 4 <= len(word) <= len(k) + 2 and _edits(word, k, 1 if len(k) < 6 else 2)), None)


def _plain(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text.lower()) if not unicodedata.combining(c))


def _street(words: list[str]) -> tuple[str, str | None, str]:
    """(direction or "", name or null, kind or "") of the words of a street: the name is all words before the last kind of street among them."""
    direction, kind, after = "", "", []
    at = next((j for j in range(len(words) - 1, 0, -1) if _kind(words[j])), 0)
    if at:
        kind, after, words = _kind(words[at]) or "", words[at + 1 :], words[:at]
    elif len(words) > 1 and words[-1] in _DIRECTION:
        after, words = words[-1:], words[:-1]
    if len(words) > 1 and words[0] in _DIRECTION:
        direction, words = _DIRECTION[words[0]][0], words[1:]
    if not direction and after[:1] and after[0] in _DIRECTION:
        direction = _DIRECTION[after[0]][0]
    return direction, "".join(_DIRECTION.get(w, w) for w in words) or None, kind


@lru_cache(1 << 14)
def read_address(text: str | None, city: str | None = None) -> tuple[str | None, str, str, str | None, str]:
    """(house number, unit or "", direction or "", street name, kind or ""). Number or name are null where none can be read.

    The name is every word before the kind of street, written together; ``city``'s words at the end of an address without a kind are no part of it.
    """
    if not text:
        return None, "", "", None, ""
    tokens = _TOKEN.findall(_NOISE.sub(" ", _plain(text)))
    unit, marked, bare, parts, i, ended = "", [], [], [[]], 0, 0
    while i < len(tokens):
        w, n = tokens[i], tokens[i + 1] if i + 1 < len(tokens) else ""
        k = tokens[i + 2] if n in ("#", "no") and i + 2 < len(tokens) else n
        if w[0].isalpha() and len(w) > 2 and (_UNIT.fullmatch(k) or (w in UNITS and len(k) == 1 and k.isalpha())) and (w in UNITS or (len(w) >= 5 and any(_edits(w, u, 2 if len(u) > 5 else 1) for u in UNITS if len(u) > 3))):
            unit = unit or k
            i += 2 if k is n else 3
        elif w in ("#", "no", "num", "number", "nr") and _UNIT.fullmatch(n):
            marked.append(n)
            i += 2
        elif _NUMBER.fullmatch(w):
            bare.append(w)
            i += 1
        elif _UNIT.fullmatch(w):
            marked.append(w)
            i += 1
        elif w in ("#", ","):
            i += 1
        else:
            # A number, a unit or a comma ends a run of words.
            if i != ended:
                parts.append([])
            parts[-1].append(w if _ORDINAL.fullmatch(w) else w.translate(_LOOKALIKE))
            i = ended = i + 1
    house = bare[0] if bare else None
    if house is None:
        house = max((m for m in marked if _NUMBER.fullmatch(m)), key=len, default=None)
        if house is not None:
            marked.remove(house)
    unit = unit or (marked[0] if marked else bare[1] if len(bare) > 1 else "")
    parts = [p for p in parts if any(len(w) > 1 for w in p)]
    words = parts[0] if parts else []
    if len(parts) > 1 and not any(_kind(w) for w in words[1:]) and _kind(parts[1][0]):
        words = words + parts[1]
    town = {w.translate(_LOOKALIKE) for w in _TOKEN.findall(_plain(city))} if city else set()
    while len(words) > 1 and words[-1] in town and words[-1] not in _KIND:
        words = words[:-1]
    direction, name, kind = _street(words)
    return house.lstrip("0") or "0" if house else None, unit.lstrip("0"), direction, name, kind


_READ = "house string, unit string, direction string, name string, kind string"


def read_addresses(text: Column, city: Column) -> Column:
    """struct of the parts of each address; see read_address."""
    fields = [f.split()[0] for f in _READ.split(", ")]

    @F.arrow_udf(f"struct<{_READ.replace(' ', ':').replace(',:', ',')}>")
    def read(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for t, c in batches:
            cols = list(zip(*[read_address(x, y) for x, y in zip(t.to_pylist(), c.to_pylist(), strict=True)], strict=True)) or [()] * len(fields)
            yield pa.StructArray.from_arrays([pa.array(x, pa.string()) for x in cols], fields)

    return read(text, city)


_FIELDS = ["house", "unit", "direction", "name", "kind", "town", "st", "zip"]


def _read(rows: DataFrame) -> DataFrame:
    """(key, spelling, seen, variant, the fields of the reading): of every row with an address that has a number and a name. ``spelling`` stands for the
    typed values, ``seen`` for those three of them that make a pair of rows worth giving."""
    key, tail = name_sql(False, "city")
    typed = rows.withColumn("r", read_addresses(F.col("address"), F.col("city"))).select("key", "address", "city", "state", "zipCode", "r.*").where("house is not null and name is not null")
    v = rows.sparkSession.sql(f"select *, {key} as town, coalesce({_lookup(False, 'state', STATES)}, {_lookup(False, tail, STATES)}) as st, regexp_replace(coalesce(zipCode, ''), '[^0-9]', '') as zip from {{typed}}", typed=typed)
    v = v.withColumn("town", F.when(~F.col("town").isin(NO_TOWN), F.col("town"))).withColumn("zip", F.when(F.length("zip").isin(5, 9), F.substring("zip", 1, 5)))
    known = lambda c: F.coalesce(c, F.lit("\u0000"))
    of = lambda *names: F.xxhash64(*[known(F.col(n)) for n in names])
    return v.select("key", of("address", "city", "state", "zipCode").alias("spelling"), of("address", "city", "zipCode").alias("seen"), of(*_FIELDS).alias("variant"), *_FIELDS)


@lru_cache(1 << 15)
def grams(text: str) -> tuple[str, ...]:
    """The different grams of a text with its ends marked."""
    t = f"^{text}$"
    return tuple(dict.fromkeys(t[i : i + GRAM] for i in range(max(1, len(t) - GRAM + 1))))


def _sql_grams(c: str) -> Column:
    t = F.concat(F.lit("^"), F.col(c), F.lit("$"))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(t) - GRAM + 1, F.lit(1))), lambda i: F.substring(t, i, F.lit(GRAM))))


def rarities(variants: DataFrame) -> list[dict[str, float]]:
    """The weight of every gram of streets, towns and codes by the share of all variants that bear it, smoothed by SMOOTH and FLOOR: log(1 + 1 / share).

    Names have letters and digits of ASCII and the marks of the ends, so there are at most 38 ** GRAM grams of streets, fewer of towns and codes, however many
    rows there are.
    """
    n = max(variants.count(), 1)
    spread = variants.select(F.explode(F.array(*[F.struct(F.lit(i).alias("part"), _sql_grams(c).alias("g")) for i, c in enumerate(("name", "town", "zip"))])).alias("x"))
    seen = spread.where("x.g is not null").select("x.part", F.explode("x.g").alias("g")).groupBy("part", "g").agg(F.count("*").alias("df"))
    out: list[dict[str, float]] = [{}, {}, {}]
    for r in seen.collect():
        out[r["part"]][r["g"]] = log1p(1 / ((r["df"] + SMOOTH) / (n + SMOOTH) + FLOOR))
    return out


def street_prefix(name: str, weights: dict[str, float]) -> list[str]:
    """The rarest grams of a street's name, up to where those left have a norm below STREET_LEAST of the whole."""
    g = sorted(grams(name), key=lambda x: (-weights[x], x))
    rest = total = sum(weights[x] ** 2 for x in g)
    out = []
    for x in g:
        if rest < STREET_LEAST**2 * total * (1 - 1e-9):
            break
        out.append(x)
        rest -= weights[x] ** 2
    return out


def cosine(a: tuple[str | None, ...], b: tuple[str | None, ...], weights: list[dict[str, float]]) -> float:
    """Of two whole vectors, given as (name, town, code). A part that is missing has no share in its vector."""
    dot, na, nb = 0.0, 0.0, 0.0
    for x, y, w, share in zip(a, b, weights, SHARES, strict=True):
        na += share if x else 0
        nb += share if y else 0
        if x and y:
            if x == y:
                dot += share
            else:
                gx, gy = grams(x), grams(y)
                both = sum(w[g] ** 2 for g in set(gx) & set(gy))
                dot += share * both / sqrt(sum(w[g] ** 2 for g in gx) * sum(w[g] ** 2 for g in gy))
    return dot / sqrt(na * nb) if na and nb else 0.0


def town_keys(towns: DataFrame) -> DataFrame:
    """(town, place): the commonest spellings that each spelling of a town may stand for, itself if none near it is commoner.

    ``towns``: town, n (how often). Two spellings are near within TOWN_EDITS of the shorter one; as an edit changes two pairs of letters, those share one of
    the rarest 2 * edits + 1 pairs of each, shifted by no more than the edits, by which they meet.
    """
    t = F.concat(F.lit("^"), F.col("town"), F.lit("$"))
    pairs = F.transform(F.sequence(F.lit(1), F.length(t) - 1), lambda i: F.struct(F.substring(t, i, F.lit(2)).alias("g"), i.alias("at")))
    terms = towns.select("town", "n", F.explode(pairs).alias("x")).select("town", "n", "x.*")
    df = terms.groupBy("g").agg(F.count("*").alias("df"))
    least = F.when(F.length("town") < 5, TOWN_EDITS[0]).when(F.length("town") < 9, TOWN_EDITS[1]).otherwise(TOWN_EDITS[2])
    ranked = terms.join(df, "g").groupBy("town", "n").agg(F.array_sort(F.collect_list(F.struct("df", "g", "at"))).alias("g")).withColumn("edits", least)
    index = cut(ranked.select("town", "n", "edits", F.explode(F.slice("g", F.lit(1), 2 * F.col("edits") + 1)).alias("x")).select("town", "n", "edits", "x.g", "x.at"))
    a, b = index.alias("a"), index.alias("b")
    edits = F.least("a.edits", "b.edits")
    met = a.join(b, "g").where((F.col("b.n") > F.col("a.n")) & (F.abs(F.col("a.at") - F.col("b.at")) <= edits) & (F.abs(F.length("a.town") - F.length("b.town")) <= edits))
    within = F.expr(f"levenshtein(a.town, b.town, {max(TOWN_EDITS)})").between(0, edits)
    near = cut(met.where(within).select(F.col("a.town").alias("town"), F.col("b.town").alias("other")).distinct())
    small = near.select("town").distinct()
    tops = near.join(small.withColumnRenamed("town", "other"), "other", "left_anti").select("town", F.col("other").alias("place"))
    alone = towns.select("town").join(tops.select("town").distinct(), "town", "left_anti").select("town", F.col("town").alias("place"))
    return tops.unionByName(alone)


def _compatible(a: str, b: str) -> Column:
    """What a cosine can't say of two readings that share house number, unit and place: kind, direction, state and a number in the name don't differ, nor the name by more
    than a few edits."""
    c = lambda t, n: F.col(f"{t}.{n}")
    blank = lambda n: (c(a, n) == "") | (c(b, n) == "") | (c(a, n) == c(b, n))
    most = F.greatest(F.lit(2.0), F.least(F.length(c(a, "name")), F.length(c(b, "name"))) / EDIT_EACH)
    number = lambda t: F.regexp_replace(c(t, "name"), "[^0-9]", "")
    return (number(a) == number(b)) & blank("kind") & blank("direction") & F.coalesce(c(a, "st") == c(b, "st"), F.lit(True)) & (F.levenshtein(c(a, "name"), c(b, "name")) <= most)


def near_variants(variants: DataFrame) -> DataFrame:
    """(va, vb): variants of one location, va < vb. ``variants``: variant and the fields of a reading, one row each."""
    weights = rarities(variants)

    @F.arrow_udf("array<string>")
    def prefix(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for names in batches:
            yield pa.array([street_prefix(x, weights[0]) for x in names.to_pylist()], pa.list_(pa.string()))

    @F.arrow_udf("double")
    def whole(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for b in batches:
            yield pa.array([cosine(x[:3], x[3:], weights) for x in zip(*[c.to_pylist() for c in b], strict=True)], pa.float64())

    towns = town_keys(variants.where("town is not null").groupBy("town").agg(F.count("*").alias("n"))).groupBy("town").agg(F.collect_list("place").alias("at"))
    none = F.array().cast("array<string>")
    mark = lambda m, c: F.when(F.col(c).isNotNull(), F.array(F.concat(F.lit(m), F.col(c)))).otherwise(none)
    placed = variants.select("variant", "house", "unit", "town", "st", "zip", prefix("name").alias("g")).join(towns, "town", "left")
    digits = F.array_join(F.array_sort(F.split("zip", "")), "")
    lacking = F.col("town").isNull() | F.col("zip").isNull()
    places = F.concat(F.transform(F.coalesce("at", none), lambda x: F.concat(F.lit("T"), x)), F.when(F.col("zip").isNotNull(), F.array(F.concat(F.lit("Z"), digits))).otherwise(none), F.when(lacking, mark("S", "st")).otherwise(none))
    spread = placed.select("variant", "house", "unit", "g", F.explode(places).alias("place")).select("variant", F.col("place").startswith("S").alias("state_only"), F.xxhash64("house", "unit", "place").alias("at"), F.explode("g").alias("g"))
    index = spread.select("variant", "state_only", F.xxhash64("at", "g").alias("term"))
    met = index.join(index.select("term", F.col("variant").alias("other")), "term").where("variant < other").groupBy(F.col("variant").alias("va"), F.col("other").alias("vb")).agg(F.min("state_only").alias("state_only"))
    said = lambda v, at: variants.select(F.col("variant").alias(v), F.struct(*_FIELDS).alias(at))
    both = met.join(said("va", "a"), "va").join(said("vb", "b"), "vb").where(_compatible("a", "b"))
    both = both.where("not state_only or ((a.town is null or b.town is null) and (a.zip is null or b.zip is null))")
    parts = [F.col(f"{s}.{n}") for s in "ab" for n in ("name", "town", "zip")]
    return both.where(whole(*parts) >= COSINE).select("va", "vb")


def locations(rows: DataFrame, key: str = "record_id") -> tuple[DataFrame, DataFrame]:
    """(members, links): the rows by what they say, and what says one location.

    members: key, spelling (a number for the typed values) and seen (for address, city and zipCode of them); a repeated key with the same values is there
    once. links: (a, b), spellings of one location that differ in address, city or zipCode, each pair once. Copies are in no link but share a spelling.
    Links aren't transitive: what lacks a town may be in either of two towns that are not each other. See same_places for the rows taken.
    """
    ship(rows.sparkSession)
    rows = rows.select(rows[key].cast("string").alias("key"), *[rows[c].cast("string").alias(c) for c in ("address", "city", "state", "zipCode")]).where("key is not null and address is not null")
    read = cut(_read(rows))
    variants = cut(read.groupBy("variant").agg(F.first(F.struct(*_FIELDS)).alias("f")).select("variant", "f.*"))
    near = cut(near_variants(variants))
    spelt = cut(read.groupBy("spelling").agg(F.first(F.struct("seen", "variant")).alias("s")).select("spelling", "s.*"))
    side = lambda v, at, seen: spelt.select(F.col("variant").alias(v), F.col("spelling").alias(at), F.col("seen").alias(seen))
    within = spelt.groupBy("variant").agg(F.count("*").alias("n")).where("n > 1").select(F.col("variant").alias("va"), F.col("variant").alias("vb"))
    pairs = near.unionByName(within).join(side("va", "a", "sa"), "va").join(side("vb", "b", "sb"), "vb").where("sa <> sb and (va <> vb or a < b)").select("a", "b")
    return read.select("key", "spelling", "seen").distinct(), pairs


def same_places(rows: DataFrame, key: str = "record_id") -> DataFrame:
    """(record_a, record_b): the pairs of rows with an address that give one location and do not agree in all of address, city and zipCode.

    ``rows``: key, address, city, state, zipCode; other columns are ignored. record_a < record_b as strings. Rows with a null key or address, or
    an address without a house number or a street's name, are in no pair; rows that agree in all three (null agrees with null only) give no
    pair with each other but each pairs with the others; a repeated key is one record. Rows that share neither town nor code give one location only if each
    lacks one of them and they share the state. Empty tables give no pairs.
    """
    members, links = locations(rows, key)
    left = members.select(F.col("key").alias("ka"), F.col("spelling").alias("a"))
    right = members.select(F.col("key").alias("kb"), F.col("spelling").alias("b"))
    pairs = links.join(left, "a").join(right, "b").where("ka <> kb")
    return pairs.select(F.least("ka", "kb").alias("record_a"), F.greatest("ka", "kb").alias("record_b")).distinct()


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return same_places(read_table(spark, folder, "identity_feed", "record_id", "address", "city", "state", "zipCode"))


QUERIES = {"p6_found": p6_found}
ORACLES: dict[str, str] = {}

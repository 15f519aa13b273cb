"""Problem 5: freely typed places to the entries of a reference list, by a pigeonhole join. SQL only.

A text within k edits of a reference text holds at least one of its k + 1 segments unchanged, shifted by k places at most. So the reference
texts are cut into k + 1 segments, typed texts into the substrings that stand where such segments may stand, both meet in an equality join,
and levenshtein verifies the pairs. Typed values are grouped first, so that each different value is looked up once, however often it is typed;
what finds no entry is reported through an anti-join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mergetide.sources import read_table

#: Edits allowed in general, and in names of LONG letters or more.
EDITS, EDITS_LONG, LONG = 2, 3, 9


def _edits(n: str) -> str:
    """SQL of the edits allowed to a reference text of n letters."""
    return f"if({n} >= {LONG}, {EDITS_LONG}, {EDITS})"


# States and provinces, and the spellings in use for each besides its code.
STATES = {
    "al": "alabama ala", "ak": "alaska alas", "az": "arizona ariz", "ar": "arkansas ark", "ca": "california calif cal", "co": "colorado colo", "ct": "connecticut conn",
    "de": "delaware del", "fl": "florida fla", "ga": "georgia geo", "hi": "hawaii haw", "id": "idaho ida", "il": "illinois ill ills", "in": "indiana ind", "ia": "iowa",
    "ks": "kansas kans kan", "ky": "kentucky", "la": "louisiana", "me": "maine", "md": "maryland", "ma": "massachusetts mass", "mi": "michigan mich", "mn": "minnesota minn",
    "ms": "mississippi miss", "mo": "missouri", "mt": "montana mont", "ne": "nebraska nebr neb", "nv": "nevada nev", "nh": "newhampshire", "nj": "newjersey", "nm": "newmexico nmex newmex",
    "ny": "newyork", "nc": "northcarolina ncar ncarolina", "nd": "northdakota ndak", "oh": "ohio", "ok": "oklahoma okla", "or": "oregon ore oreg", "pa": "pennsylvania penna penn", "ri": "rhodeisland",
    "sc": "southcarolina scar", "sd": "southdakota sdak", "tn": "tennessee tenn", "tx": "texas tex", "ut": "utah", "vt": "vermont verm", "va": "virginia virg", "wa": "washington wash",
    "wv": "westvirginia wva", "wi": "wisconsin wisc wis", "wy": "wyoming wyo",
    "ab": "alberta alta", "bc": "britishcolumbia", "mb": "manitoba man", "nb": "newbrunswick", "nl": "newfoundland nfld", "ns": "novascotia", "on": "ontario ont", "pe": "princeedwardisland pei",
    "qc": "quebec que pq", "sk": "saskatchewan sask",
}
COUNTRIES = {"us": "usa unitedstates unitedstatesofamerica america", "ca": "can canada"}
# What stands before or after a town's name without belonging to it, and short forms of the words that do.
BEFORE = ["city of", "town of", "village of", "greater"]
AFTER = ["main office", "metro area", "metro", "area", "downtown", "campus", "city"]
FIRST = {"north": "n no nth", "south": "s so sth", "east": "e", "west": "w", "saint": "st snt", "fort": "ft frt", "mount": "mt mnt mtn", "port": "pt prt", "lake": "lk"}
LAST = {"heights": "hts hgts", "falls": "fls", "grove": "grv grve", "beach": "bch", "springs": "spgs spg sprgs", "junction": "jct jctn junc"}
ACCENTS = ("àáâãäåāăçćčďèéêëēęěìíîïīłñńňòóôõöøōřśšťùúûüūůýÿžźż015", "aaaaaaaacccdeeeeeeeiiiiilnnnooooooorsstuuuuuuyyzzzols")


def _replace(duck: bool, text: str, pattern: str, by: str) -> str:
    p = pattern if duck else pattern.replace("\\", "\\\\")
    return f"regexp_replace({text}, '{p}', '{by}'" + (", 'g')" if duck else ")")


#: A state at the end of a town's text, in any of its spellings; spaces and points may stand between its letters.
TAIL = "|".join(r"[ .]*".join(x) for x in sorted({x for k, v in STATES.items() for x in [k, *v.split()]}, key=lambda x: (-len(x), x)))


def name_sql(duck: bool, column: str) -> tuple[str, str]:
    """SQL of a town's key (letters only) and of the state at the end of its text (letters only, or '')."""
    r = lambda t, p, b: _replace(duck, t, p, b)
    t = f"translate(lower(coalesce({column}, '')), '{ACCENTS[0]}', '{ACCENTS[1]}')"
    t = r(t, "[\u200b\ufeff]", "")
    t = f"trim({r(t, '[' + chr(92) + 's' + chr(160) + ']+', ' ')})"
    after = r"[ ,(\-]+(?:" + "|".join(AFTER) + r")[ ).]*$"
    t = r(t, after, "")
    tail = r"[ ,/(]+(" + TAIL + r")[ ).]*$"
    state = f"regexp_extract({t}, '{tail if duck else tail.replace(chr(92), chr(92) * 2)}', 1)"
    state = r(state, "[^a-z]", "")
    t = r(r(t, tail, ""), after, "")
    t = r(t, "^(?:" + "|".join(BEFORE) + ") ", "")
    t = f"trim({r(r(r(t, r'[.]', ' '), r'[^a-z ]', ''), ' +', ' ')})"
    for full, short in FIRST.items():
        t = r(t, f"^(?:{short.replace(' ', '|')}) ", full + " ")
    for full, short in LAST.items():
        t = r(t, f" ?(?:{full}|{short.replace(' ', '|')})$", " " + full)
    return f"replace({t}, ' ', '')", state


def _lookup(duck: bool, text: str, table: dict[str, str]) -> str:
    """SQL of the code that a spelling means, or null."""
    plain = _replace(duck, f"lower(coalesce({text}, ''))", "[^a-z]", "")
    words, codes = ", ".join(f"'{w}'" for k, v in table.items() for w in [k, *v.split()]), ", ".join(f"'{k}'" for k, v in table.items() for _ in [k, *v.split()])
    if duck:
        return f"list_extract([{codes}], list_position([{words}], {plain}))"
    return f"try_element_at(map_from_arrays(array({words}), array({codes})), {plain})"


def _typed_sql(duck: bool, table: str) -> str:
    key, tail = name_sql(duck, "city")
    return f"""
      select city, state, country, {key} as key, coalesce({_lookup(duck, 'state', STATES)}, {_lookup(duck, tail, STATES)}) as st, {_lookup(duck, 'country', COUNTRIES)} as ct
      from {table}"""


def map_places(rows: DataFrame, places: DataFrame, key: str = "record_id") -> DataFrame:
    """(key, place_id): each row with a non-null city that isn't exactly an entry, with the entry that it means, or 0.

    The town's name, without decoration and with short words written out, must be within EDITS of an entry's (EDITS_LONG from LONG letters on); the state,
    if one can be read from the state or the end of the town, must be the entry's; else the country must be, if it can be read. The nearest
    entry is meant; if two are equally near, none is. Blank towns and fillers give 0; repeated rows give a row each; null keys are kept; other
    columns are ignored; an empty reference list gives 0 for every row.
    """
    spark = rows.sparkSession
    rows = rows.select(rows[key].alias("key"), rows["city"], rows["state"], rows["country"])
    places = places.select("place_id", "city", "state", "country")
    q = lambda text, **named: spark.sql(text, **named)
    todo = q("select r.* from {rows} r left anti join {places} p on r.city = p.city and r.state = p.state and r.country = p.country where r.city is not null", rows=rows, places=places)
    typed = q(_typed_sql(False, "{todo}") + " group by city, state, country", todo=todo)
    entries = q("select place_id, key, st, ct, length(key) as n from (" + _typed_sql(False, "{places}").replace("select city", "select place_id, city") + ") where key <> ''", places=places)
    texts = q("select key, length(key) as n from {typed} where key <> '' group by key", typed=typed)
    # A reference text of n letters and k edits has k + 1 segments; segment i goes from i * n / (k + 1) on to where the next begins.
    cutting = lambda n, i: f"div({i} * {n}, k + 1)"
    parts = q(f"select key as entry, n, i, substring(key, 1 + {cutting('n', 'i')}, {cutting('n', '(i + 1)')} - {cutting('n', 'i')}) as seg from (select distinct key, n, {_edits('n')} as k from {{entries}}) lateral view explode(sequence(0, k)) as i", entries=entries)
    shifts = q(f"""
      select distinct key, m, i, substring(key, at, len) as seg from (
        select key, n, m, i, {cutting('m', 'i')} + 1 + d as at, {cutting('m', '(i + 1)')} - {cutting('m', 'i')} as len
        from (select key, n, m, {_edits('m')} as k from {{texts}} lateral view explode(sequence(greatest(1, n - {EDITS_LONG}), n + {EDITS_LONG})) as m)
        lateral view explode(sequence(0, k)) as i lateral view explode(sequence(-k, k)) as d where abs(n - m) <= k)
      where len = 0 or (at >= 1 and at + len - 1 <= n)""", texts=texts)
    near = q(f"select key, entry, levenshtein(key, entry) as dist from (select distinct s.key, p.entry from {{shifts}} s join {{parts}} p on s.seg = p.seg and s.i = p.i and s.m = p.n) where levenshtein(key, entry) <= {_edits('length(entry)')}", shifts=shifts, parts=parts)
    found = q("""
      select city, state, country, min_by(place_id, dist) as place_id from (
        select *, min(dist) over (partition by city, state, country) as least from (
          select t.city, t.state, t.country, e.place_id, n.dist from {typed} t join {near} n on t.key = n.key join {entries} e on n.entry = e.key
          where if(t.st is not null, t.st = e.st, t.ct is null or t.ct = e.ct)))
      where dist = least group by city, state, country having count(*) = 1""", typed=typed, near=near, entries=entries)
    mapped = q("select r.key, f.place_id from {todo} r join {found} f on r.city = f.city and r.state <=> f.state and r.country <=> f.country", todo=todo, found=found)
    lost = q("select r.key, 0 as place_id from {todo} r left anti join {found} f on r.city = f.city and r.state <=> f.state and r.country <=> f.country", todo=todo, found=found)
    return q("select key, cast(place_id as int) as place_id from {a} union all select key, place_id from {b}", a=mapped, b=lost).withColumnRenamed("key", key)


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return map_places(read_table(spark, folder, "identity_feed", "record_id", "city", "state", "country"), read_table(spark, folder, "ref_places"))


P5_SQL = f"""
with todo as (
  select record_id, city, state, country from identity_feed r where city is not null
    and not exists (select 1 from ref_places p where r.city = p.city and r.state = p.state and r.country = p.country)),
typed as ({_typed_sql(True, '(select distinct city, state, country from todo)')}),
entries as (select * from ({_typed_sql(True, 'ref_places').replace('select city', 'select place_id, city')}) where key <> ''),
pairs as (
  select t.city, t.state, t.country, e.place_id, levenshtein(t.key, e.key) as dist from typed t join entries e
    on t.key <> '' and case when t.st is not null then t.st = e.st else t.ct is null or t.ct = e.ct end
    and levenshtein(t.key, e.key) <= case when length(e.key) >= {LONG} then {EDITS_LONG} else {EDITS} end),
found as (
  select city, state, country, min(place_id) as place_id from pairs p
  where dist = (select min(dist) from pairs q where q.city = p.city and q.state is not distinct from p.state and q.country is not distinct from p.country)
  group by 1, 2, 3 having count(*) = 1)
select r.record_id, cast(coalesce(f.place_id, 0) as integer) as place_id
from todo r left join found f on r.city = f.city and r.state is not distinct from f.state and r.country is not distinct from f.country
"""

QUERIES = {"p5_found": p5_found}
ORACLES = {"p5_found": P5_SQL}

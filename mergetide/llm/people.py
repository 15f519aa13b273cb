"""What typed names, dates of birth, mails and numbers say about a person; the ground of problems 1 and 3."""

from __future__ import annotations

import re
import unicodedata
from array import array
from collections.abc import Iterator, Sequence
from datetime import date
from functools import lru_cache
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from mergetide.llm.survivorship import FILLERS
from mergetide.session import cut, drop, told

# Common short and variant forms of given names, each line a name and the forms used for it.
GIVEN = """
abigail abby gail; aisha ayesha; alexander alex sandy aleksander; anthony tony antony; archibald archie; augustine gus; benjamin ben benji;
bernadette bernie; bjorn; charles charlie chas; chloe khloe; christopher chris topher kristopher; clarence clay; cordelia delia; cynthia cindy; daniel dan danny;
deborah deb debbie debra debby; dmitri dmitry dima; dorothy dot dottie; edward ed eddie ted teddy ned; eleanor ellie nora elinor ella; elizabeth liz beth betty;
fatima fatma; florence flo flossie; francois; frederick fred freddie; gabriella gaby ella; geoffrey geoff jeffrey jeff; gregory greg gregor; gwendolyn gwen; harold hal harry;
henrietta hettie etta; ignatius iggy; ingrid inge; isabella izzy bella isobel; jacqueline jackie jacqui; james jim jimmy jamie; jennifer jen jenny; jocelyn joss; jonathan jon jonny johnathan;
jose pepe; joseph joe joey; josephine jo josie; katherine kate kathy katie; lakshmi laxmi; lawrence larry laurence; leonard len lenny; lucinda lucy cindy; lukasz lukas;
madeleine maddie madeline; margaret peggy maggie marge; marguerite daisy; maria mari; matthew matt mathew; maximilian max; michael mike mick mickey micheal; mohammed muhammad mohamed;
nathaniel nate nat; nicholas nick nico nicolas; oliver ollie; ottilie tilly; pamela pam; patricia pat patty trish tricia; patrick pat paddy; philip phil phillip; prudence pru;
raul raoul; raymond ray; rebecca becca becky rebekah; renee rene; richard rick dick; robert rob bob bobby; ronald ron ronnie; rosalind roz; rosemary rosie; samuel sam sammy;
sean shawn shaun; sebastian seb bastian; siobhan shivaun; stephen steve stevie steven; susan sue susie suzan; tabitha tabby; thaddeus thad; thandiwe thandi; theodore ted theo;
thibault thibaut; thomas tom tommy; timothy tim timmy; valerie val; victoria vicky tori viktoria; vincent vinny; walter walt wally; william bill billy will; winifred winnie freda;
ximena jimena; yevgeny evgeny zhenya; yusuf yousef yousuf; zachary zack zach; zoe zoey
"""
# Titles, suffixes, and the particles that belong to the surname after them.
TITLES = {"dr", "mr", "mrs", "ms", "miss", "prof", "sir", "jr", "sr", "ii", "iii", "iv", "phd", "md", "esq", "mba", "cpa"}
PARTICLES = {"de", "la", "der", "den", "van", "von", "del", "di", "da", "du", "le", "vann", "vande", "d"}
MONTHS = {m: i for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split(), 1)}
FILLER_DATES = {"1900-01-01", "1970-01-01", "1899-12-31", "9999-12-31"}
_LOOKALIKE = str.maketrans("0135", "oles")
_ODD = str.maketrans({"ł": "l", "ø": "o", "đ": "d", "ß": "ss", "æ": "a", "œ": "o", "ı": "i"})


_AA, _BESIDE = re.compile("aa|ae"), re.compile(r"(?<=[a-z])[0135]+|[0135]+(?=[a-z])")


@lru_cache(1 << 16)
def fold(text: str) -> str:
    """Lower case without accents; digits within words as the letters they look like; "oe", "ue" and "aa" as their vowels."""
    t = text.lower()
    if not t.isascii():
        t = "".join(c for c in unicodedata.normalize("NFKD", t.translate(_ODD)) if not unicodedata.combining(c))
    if not t.isalpha():
        t = _BESIDE.sub(lambda m: m[0].translate(_LOOKALIKE), t)
    return _AA.sub("a", t).replace("oe", "o").replace("ue", "u")


_ALIKE, _SILENT, _TWICE = str.maketrans("cqwzydjb", "kkvsitip"), str.maketrans("", "", "aeiouh"), re.compile(r"(.)\1+")
_ALIKE_BYTES = bytes.maketrans(b"cqwzydjb", b"kkvsitip")


@lru_cache(1 << 16)
def code(word: str) -> str:
    """A phonetic code: like consonants alike, doubles once, vowels only in front."""
    w = word
    for a, b in (("ph", "f"), ("gh", "g"), ("ck", "k"), ("th", "t"), ("sch", "s"), ("sh", "s"), ("kn", "n"), ("wr", "r"), ("x", "ks"), ("qu", "k")):
        w = w.replace(a, b)
    if w.isascii():
        b = w.encode().translate(_ALIKE_BYTES)
        w = (b[:1] + b[1:].translate(None, b"aeiouh")).decode()
    else:
        w = w.translate(_ALIKE)
        w = w[:1] + w[1:].translate(_SILENT)
    return _TWICE.sub(r"\1", w)


NAMES: dict[str, list[str]] = {}
for _line in GIVEN.replace("\n", " ").split(";"):
    _name, *_forms = [fold(w) for w in _line.split()]
    for _w in [_name, *_forms]:
        NAMES.setdefault(_w, []).append(_name)

_WORD = re.compile(r"[a-z]+")


@lru_cache(1 << 16)
def words(text: str | None) -> tuple[str, ...]:
    """The words of a name, without titles."""
    return tuple([w for w in _WORD.findall(fold((text or "").replace("'", "").replace("’", "").replace("`", ""))) if w not in TITLES])


def one_slip(word: str) -> set[str]:
    """The words that one letter left out, put in, put for another or swapped with the next makes of a word."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    return {a + b[1:] for a, b in cuts if b} | {a + c + b for a, b in cuts for c in letters} | {a + c + b[1:] for a, b in cuts if b for c in letters} | {a + b[1] + b[0] + b[2:] for a, b in cuts if len(b) > 1}


@lru_cache(1 << 16)
def given_names(word: str, words: frozenset[str]) -> tuple[str, ...]:
    """The names that a given name may be a form of: itself if it is no form of any; a word with one slip counts as the word it must be."""
    if word in NAMES:
        return tuple(NAMES[word])
    if word in words or len(word) < 4:
        return (word,)
    meant = {n for w in one_slip(word) if w in words or (w in NAMES and len(w) > 3) for n in NAMES.get(w, [w])}
    return tuple(sorted(meant)) if len(meant) == 1 else (word,)


def _within(a: str, b: str, most: int) -> bool:
    """Whether a and b are within ``most`` edits. Equal ends are cut off first, which leaves little of like texts."""
    if abs(len(a) - len(b)) > most:
        return False
    i, n = 0, min(len(a), len(b))
    while i < n and a[i] == b[i]:
        i += 1
    a, b = a[i:], b[i:]
    i, n = 0, min(len(a), len(b))
    while i < n and a[-1 - i] == b[-1 - i]:
        i += 1
    a, b = a[: len(a) - i], b[: len(b) - i]
    if not a or not b:
        return True
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
        if min(row) > most:
            return False
    return row[-1] <= most


def _joined(ws: list[str]) -> list[str]:
    """The parts of a surname, particles joined to the part after them."""
    if len(ws) == 1:
        return ws
    out, hold = [], ""
    for w in ws:
        if w in PARTICLES and not (len(w) == 1 and out):
            hold += w
        elif w in ("mc", "mac", "o", "mak"):
            hold += w
        else:
            out.append(hold + w)
            hold = ""
    return out + ([hold] if hold else [])


def split_name(first: str | None, last: str | None, full: str | None, known: frozenset[str] = frozenset()) -> tuple[list[str], list[str]]:
    """(given names and initials, surname parts) in folded form. Particles are joined to the surname; titles are left out."""
    def is_given(w: str) -> bool:
        return w in NAMES or w in known

    f, s = list(words(first)), list(words(last))
    if not s and full:
        parts = re.split(r"[,;]", full, maxsplit=1)
        if len(parts) == 2 and words(parts[1]) and words(parts[0]):
            f, s = list(words(parts[1])), list(words(parts[0]))
        else:
            ws = list(words(full))
            cut = next((i for i, w in enumerate(ws) if w in PARTICLES and len(w) > 1), None)
            if cut == 0:
                cut = next((i + 1 for i, w in enumerate(ws) if w not in PARTICLES), len(ws))
                f, s = ws[cut:], ws[:cut]
            elif cut is not None:
                f, s = ws[:cut], ws[cut:]
            elif len(ws) > 1 and is_given(ws[-1]) and not is_given(ws[0]):
                f, s = ws[-1:], ws[:-1]
            elif len(ws) > 1 and len(ws[-1]) == 1:
                f, s = ws[1:], ws[:1]
            else:
                f, s = ws[:-1], ws[-1:]
    if not f and full and s:
        own = set(_joined(s)) | set(s)
        f = [w for w in words(full) if w not in own and w not in PARTICLES]
    if f and s and len(s) == 1 and is_given(s[0]) and not any(is_given(w) or len(w) == 1 for w in f):
        f, s = s, f
    return f, _joined(s)


_NUMBER, _MONTH, _YEAR = re.compile(r"\d+"), re.compile(r"[a-z]{3}"), re.compile(r"\d{4}")


def read_dates(text: str | None) -> list[str]:
    """The dates that a text may mean, none for fillers: two where day and month can't be told apart."""
    t = (text or "").strip().lower()
    n = [int(x) for x in _NUMBER.findall(t)]
    word = _MONTH.search(t)
    found = []
    if word and word[0] in MONTHS and len(n) == 2:
        found = [(max(n), MONTHS[word[0]], min(n))]
    elif len(n) == 3 and _YEAR.match(t):
        found = [(n[0], n[1], n[2])]
    elif len(n) == 3:
        found = [(n[2], n[1], n[0])] + ([(n[2], n[0], n[1])] if "/" in t else [])
    out = []
    for y, m, d in found:
        try:
            out.append(date(y, m, d).isoformat())
        except ValueError:
            continue
    if len(out) == 1:
        return out if out[0] not in FILLER_DATES else []
    return sorted(set(out) - FILLER_DATES)


_FILLERS, _LETTER = frozenset(FILLERS), re.compile("[a-z]")


def _of_name(glued: str, names: list[str]) -> bool:
    """Whether a mailbox holds a name of four letters or more, or four letters in a row of one."""
    for w in names:
        if len(w) >= 4 and w in glued:
            return True
    for w in names:
        for i in range(len(w) - 3):
            if w[i : i + 4] in glued:
                return True
    return False


def read_email(text: str | None, first: list[str], last: list[str]) -> tuple[str | None, str | None]:
    """(mailbox with its parts in order, number at its end): the number is null unless the mailbox is made from the person's name."""
    t = (text or "").lower().strip(" \t\r\n;,\u200b\ufeff\xa0").removeprefix("mailto:").strip()
    local = t.partition("@")[0].partition("+")[0]
    if len(local) < 4 or local in _FILLERS or t in _FILLERS or not _LETTER.search(local):
        return None, None
    letters = local.rstrip("0123456789")
    digits = local[len(letters) :]
    parts = sorted([fold(p) for p in letters.replace("_", ".").replace("-", ".").split(".") if p])
    return ".".join(parts) + digits, digits if _of_name("".join(parts), last + first) else None


def _mail_names(box: str, digits: str, surname: str, given: list[str]) -> tuple[list[str], list[str]]:
    """(spellings of the surname, given names) that a mailbox shows: those close to the typed ones."""
    letters = box[: len(box) - len(digits)]
    parts = letters.split(".")
    spelt = [p for p in parts if len(p) >= 5]
    if len(parts) == 1:
        spelt += [letters[1:]] + [letters[len(g) :] for g in given if letters.startswith(g)] + [letters[: -len(g)] for g in given if letters.endswith(g)]
    if not spelt or spelt == [surname]:
        return [], parts
    near = dict.fromkeys(w for w in spelt if len(w) >= 5 and w != surname and (w[:2] == surname[:2] or w[-3:] == surname[-3:]))
    return [w for w in near if _within(w, surname, 3)], parts


def read_person(first: str | None, last: str | None, full: str | None, email: str | None, born: str | None, known: frozenset[str] = frozenset()) -> dict:
    f, s = split_name(first, last, full, known)
    whole = [w for w in f if len(w) > 1]
    given = _in_order(given_names(whole[0], known)) if whole else []
    dates = read_dates(born)
    box, num = read_email(email, f, s)
    surname = "".join(s)
    forms = [surname, *[w for w in s if len(w) >= 5]] if surname else []
    initials = _in_order([w[:1] for w in [*given, *f[:1]]])
    if box and num is not None:
        spelt, parts = _mail_names(box, num, surname, [*whole[:1], *given])
        forms += spelt
        if not given and initials:
            given = sorted({n for w in parts if w[:1] == initials[0] and (w in NAMES or w in known) for n in given_names(w, known)})
            if not given:
                given = sorted({n for w in parts for n in NAMES.get(w, []) if n[:1] == initials[0]})
    forms = _in_order(forms)
    codes = [c for c in _in_order([code(w) for w in forms]) if c]
    return {"last": surname, "forms": forms, "codes": codes, "first": whole[0] if whole else "", "given": given, "initials": initials, "short": not given, "dates": dates, "box": box, "num": num}


def _in_order(texts: Sequence[str]) -> list[str]:
    """The different texts in order."""
    return sorted(set(texts)) if len(texts) > 1 else [*texts]


_INTS = pa.list_(pa.int32())
#: What is kept of a person for matching: texts that only have to be equal are kept as hashes.
_PERSON = {"last": pa.string(), "first": pa.string(), "short": pa.bool_(), "num": pa.string(), "box": pa.string(), "forms": _INTS, "codes": _INTS, "heads": _INTS, "given": _INTS, "initials": _INTS, "dates": _INTS}
_SQL = {pa.string(): "string", pa.bool_(): "boolean", _INTS: "array<int>"}
VALUES = list(_PERSON)


def _hash(text: str) -> int:
    return crc32(text.encode("utf-8", "surrogatepass")) - (1 << 31)


def read_batch(columns: list[pa.Array], known: frozenset[str] = frozenset()) -> pa.StructArray:
    """What columns of first, last and full names, mails and dates say, a struct for each row: dates as yyyymmdd, other lists as hashes."""
    plain: dict[str, list] = {k: [] for k, t in _PERSON.items() if t != _INTS}
    flat = {k: array("i") for k, t in _PERSON.items() if t == _INTS}
    ends = {k: array("i", [0]) for k in flat}
    # Each person's lists go at once into those of the batch, so that none is kept for the garbage collector to look at.
    for row in zip(*[c.to_pylist() for c in columns], strict=True):
        p = read_person(*row, known)
        for k, out in plain.items():
            out.append(p[k])
        flat["dates"].extend([int(d.replace("-", "")) for d in p["dates"]])
        flat["heads"].extend([_hash(x) for x in _in_order([c[:2] for c in p["codes"]])])
        for k in ("forms", "codes", "given", "initials"):
            flat[k].extend([_hash(x) for x in p[k]])
        for k, out in flat.items():
            ends[k].append(len(out))
    of = lambda x: pa.Array.from_buffers(pa.int32(), len(x), [None, pa.py_buffer(x)])
    return pa.StructArray.from_arrays([pa.array(plain[k], t) if k in plain else pa.ListArray.from_arrays(of(ends[k]), of(flat[k])) for k, t in _PERSON.items()], list(_PERSON))


#: A word counts as a given name from this share of all words typed as given names on, and from LEAST_SEEN rows on, as fewer show nothing in small tables;
#: not if it is one slip away from a word that is FAR times as common. At most 1 / SHARE words reach the share, however large the tables are.
SHARE, LEAST_SEEN, FAR = 5e-4, 3, 5


@F.arrow_udf(StringType())
def _folded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for b in batches:
        yield pa.array([w and fold(w) for w in b.to_pylist()], pa.string())


def vocabulary(rows: DataFrame, first: str = "firstName", last: str = "lastName") -> frozenset[str]:
    """The given names of a table: words that have a share of those typed as given name, are typed so far more often than as surname, and are no slip of a far
    commoner one. The share bounds their number, so they can go along with a function. All rows are counted, in one pass."""
    words = lambda c, n: F.transform(F.regexp_extract_all(F.lower(F.coalesce(F.col(c), F.lit(""))), F.lit(r"[\p{L}]{2,}"), F.lit(0)), lambda w: F.struct(w.alias("w"), F.lit(n).alias("n"), F.lit(1 - n).alias("m")))
    seen = rows.select(F.explode(F.concat(words(first, 1), words(last, 0))).alias("x")).groupBy("x.w").agg(F.sum("x.n").alias("n"), F.sum("x.m").alias("m"))
    # Plain words are their own folded form.
    plain = F.col("w").rlike("^[a-z]+$") & ~F.col("w").rlike("aa|ae|oe|ue")
    seen = seen.select(F.coalesce(F.when(plain, F.col("w")), _folded(F.when(~plain, F.col("w")))).alias("w"), "n", "m").groupBy("w").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    seen = cut(seen, all=F.sum("n"))
    least = max(float(LEAST_SEEN), (told(seen, "all") or 0) * SHARE)
    many = {r["w"]: (r["n"], r["m"]) for r in seen.where(F.col("n") >= least).collect()}
    drop(seen)
    return frozenset(w for w, (n, m) in many.items() if n > 4 * m and (w in NAMES or len(w) < 4 or not any(many.get(v, (0, 0))[0] >= FAR * n for v in one_slip(w))))


def read_people(first: Column, last: Column, full: Column, email: Column, born: Column, known: frozenset[str] = frozenset()) -> Column:
    """struct of what the values say: surname, its forms and codes, given names, dates of birth, mailbox, number."""

    @F.arrow_udf("struct<" + ",".join(f"{k}:{_SQL[t]}" for k, t in _PERSON.items()) + ">")
    def read(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for b in batches:
            yield read_batch(b, known)

    return read(first, last, full, email, born)


def feed_people(feed: DataFrame, known: frozenset[str] = frozenset()) -> DataFrame:
    """identity_feed rows as people: key, and the fields of read_people."""
    c = lambda n: F.col(n).cast("string")
    return feed.withColumn("p", read_people(c("firstName"), c("lastName"), c("fullName"), c("email"), c("birthDate"), known)).select(*[x for x in feed.columns if x not in _PERSON], "p.*")


def identity_people(identities: DataFrame, known: frozenset[str] = frozenset()) -> DataFrame:
    """identities as people: key id, from their attributes; the display name where given or last name is null."""
    at = lambda n: F.try_element_at(F.col("attributes"), F.lit(n))
    return identities.withColumn("p", read_people(at("firstname"), at("lastname"), at("displayName"), at("email"), at("birthDate"), known)).select("id", "p.*")


def shared_keys() -> Column:
    """array<struct<t, k>>: keys that rows of one person share, of the kinds D (date of birth and start of a surname's code), N (code and given name),
    I (code and initial), M (start of a code and number of a mailbox), G (date and given name), B (a mailbox with a number or of no name), E (another
    mailbox with code and initial, or with a date, as without these it can't carry a pair)."""
    cross = lambda t, x, y: f"transform(flatten(transform({x}, x -> transform({y}, y -> xxhash64('{t}', x, y)))), k -> named_struct('t', '{t}', 'k', k))"
    none = "cast(array() as array<struct<t:string,k:bigint>>)"
    boxed = f"concat({cross('E', 'transform(codes, x -> xxhash64(box, x))', 'initials')}, {cross('E', 'array(xxhash64(box))', 'dates')})"
    return F.expr(
        f"concat({cross('D', 'heads', 'dates')}, {cross('N', 'codes', 'given')}, {cross('I', 'codes', 'initials')}, {cross('G', 'dates', 'given')}, "
        f"if(num <> '', transform(heads, x -> named_struct('t', 'M', 'k', xxhash64('M', num, x))), {none}), case when box is null then {none} when num = '' then {boxed} else array(named_struct('t', 'B', 'k', xxhash64('B', box))) end)"
    )


def near_keys() -> Column:
    """array<struct<t, k>>: kind C, what near dates of birth share, with the surname's code and the initial; for names that many bear. Two dates share a part if
    they differ in the day, the month, a digit of the year or a year, or have day and month swapped."""
    y, m, d, md = "(x div 10000)", "((x div 100) % 100)", "(x % 100)", "(x % 10000)"
    parts = f"array(xxhash64(1, {y}, {m}), xxhash64(2, {y}, {d}), xxhash64(3, {md}, {y} div 10), xxhash64(4, {md}, {y} % 10), xxhash64(5, {y}, least({m}, {d}), greatest({m}, {d})), xxhash64(6, {md}, {y}), xxhash64(6, {md}, {y} + 1))"
    shared = f"array_distinct(flatten(transform(dates, x -> {parts})))"
    return F.expr(f"transform(flatten(flatten(transform(codes, c -> transform(initials, i -> transform({shared}, z -> xxhash64('C', c, i, z)))))), k -> named_struct('t', 'C', 'k', k))")


def reading() -> Column:
    """A number for all that a person's values say."""
    return F.xxhash64(*[F.coalesce(c, F.lit("-")) if c in ("num", "box") else F.col(c) for c in VALUES])


#: Kinds of keys that only say a name.
NAME_ONLY = ["N", "I"]


#: What of the values is needed to compare two people; the rest only makes keys.
COMPARED = ["last", "first", "short", "num", "box", "forms", "codes", "given", "initials", "dates"]


def near_sql(x: str, y: str) -> str:
    """SQL of whether two dates yyyymmdd differ in one part as near_keys means it."""
    year = "({0} div 10000)".format
    other = f"{x} % 100 = ({y} div 100) % 100 and ({x} div 100) % 100 = {y} % 100"
    same_year = f"{year(x)} = {year(y)} and ({x} div 100 = {y} div 100 or {x} % 100 = {y} % 100 or ({other}))"
    same_day = f"{x} % 10000 = {y} % 10000 and ({x} div 100000 = {y} div 100000 or {year(x)} % 10 = {year(y)} % 10 or abs({year(x)} - {year(y)}) <= 1)"
    return f"(({same_year}) or ({same_day}))"


def packed_dates() -> Column:
    """The dates of a reading, two at most, as one number; 0 for none."""
    return F.expr("bigint(coalesce(get(dates, 0), 0)) + shiftleft(bigint(coalesce(get(dates, 1), 0)), 32)")


def agreeing_dates(x: str, y: str) -> Column:
    """Whether two packed_dates have near dates, or one has none."""
    parts = lambda c: [f"int({c} & 4294967295)", f"int(shiftright({c}, 32))"]
    either = " or ".join(f"({p} <> 0 and {q} <> 0 and {near_sql(p, q)})" for p in parts(x) for q in parts(y))
    return F.expr(f"{x} = {y} or {x} = 0 or {y} = 0 or {either}")


def once(df: DataFrame, name: str, values: dict[str, Column]) -> DataFrame:
    """df with a struct of ``values``, which are computed once for a row: filters and projections behind aren't merged with them, as they would repeat them."""
    return df.withColumn(name, F.explode(F.array(F.struct(*[c.alias(n) for n, c in values.items()]))))


def overlap(a: str, b: str) -> Column:
    return F.arrays_overlap(F.col(a), F.col(b))


def evidence(a: str = "a", b: str = "b") -> dict[str, Column]:
    """How two people's values agree; each is 0 for a conflict, null where a side says nothing, and the more the closer.

    surname: 3 the same form, 2 the same code or few edits. given: 3 one name, 2 few edits, 1 an initial. born: 3 one date, 2 near. number: 3 the
    same in mailboxes of their names, 0 another or none on one side. box: 3 the same mailbox (4 if it is of neither's name).
    """
    c = lambda t, n: f"{t}.{n}"
    x = lambda t, n: F.col(c(t, n))
    edits = F.levenshtein(x(a, "last"), x(b, "last"))
    short = F.least(F.length(x(a, "last")), F.length(x(b, "last")))
    surname = F.when(overlap(c(a, "forms"), c(b, "forms")), 3).when(overlap(c(a, "codes"), c(b, "codes")) & (edits <= F.greatest(short / 2, F.lit(3))), 2).when(edits <= F.when(short >= 9, 3).when(short >= 6, 2).otherwise(1), 2).otherwise(0)
    none = lambda n: (F.size(x(a, n)) == 0) | (F.size(x(b, n)) == 0)
    fe = F.levenshtein(x(a, "first"), x(b, "first"))
    fs = F.least(F.length(x(a, "first")), F.length(x(b, "first")))
    given = F.when(none("initials"), None).when(x(a, "short") | x(b, "short"), F.when(overlap(c(a, "initials"), c(b, "initials")), 1).otherwise(0)).when(overlap(c(a, "given"), c(b, "given")), 3).when((fe <= F.when(fs >= 7, 3).otherwise(2)) & (fs >= 4), 2).otherwise(0)
    born = F.when(none("dates"), None).when(overlap(c(a, "dates"), c(b, "dates")), 3).when(F.expr(f"exists({a}.dates, x -> exists({b}.dates, y -> {near_sql('x', 'y')}))"), 2).otherwise(0)
    number = F.when(x(a, "num").isNull() | x(b, "num").isNull() | ((x(a, "num") == "") & (x(b, "num") == "")), None).when(x(a, "num") == x(b, "num"), 3).otherwise(0)
    box = F.when(x(a, "box") == x(b, "box"), F.when(x(a, "num").isNull() & x(b, "num").isNull(), 4).otherwise(3))
    return {"surname": surname, "given": given, "born": born, "number": number, "box": box}

"""Similarities of texts that Spark has no expression for, as kernels and as Columns over Arrow batches.

Scores run from 0 to 1 in the kernels and are whole percentages, halves rounded up, in the Columns.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType


def jaro(a: str, b: str) -> float:
    """Matches within half the longer length; transpositions count by halves."""
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    taken, ours = [False] * len(b), []
    for i, x in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == x:
                taken[j] = True
                ours.append(x)
                break
    m = len(ours)
    if not m:
        return 0.0
    theirs = [y for y, t in zip(b, taken, strict=True) if t]
    swaps = sum(x != y for x, y in zip(ours, theirs, strict=True)) / 2
    return (m / len(a) + m / len(b) + (m - swaps) / m) / 3


def jaro_winkler(a: str, b: str) -> float:
    """Jaro, raised by up to four equal leading characters from 0.7 on. Two empty texts are unlike; case counts."""
    if a == b:
        return 1.0 if a else 0.0
    s = jaro(a, b)
    if s < 0.7:
        return s
    lead = 0
    for x, y in zip(a[:4], b[:4], strict=False):
        if x != y:
            break
        lead += 1
    return s + 0.1 * lead * (1 - s)


def percent(x: float) -> int:
    """Whole percentage, halves up."""
    return math.floor(x * 100 + 0.5)


def pairwise(kernel: Callable[[str, str], float], kind: str = "double") -> Callable[[Column, Column], Column]:
    """A Column function of two texts from a kernel; null where either is null. Equal pairs within a batch are computed once."""

    @F.arrow_udf({"double": DoubleType(), "int": IntegerType()}[kind])
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for a, b in batches:
            seen: dict[tuple[str, str], float] = {}
            out = []
            for p in zip(a.to_pylist(), b.to_pylist(), strict=True):
                if p[0] is None or p[1] is None:
                    out.append(None)
                    continue
                if p not in seen:
                    seen[p] = kernel(*p)
                out.append(seen[p])
            yield pa.array(out, {"double": pa.float64(), "int": pa.int32()}[kind])

    return run


def bigrams(c: Column) -> Column:
    """array: the pairs of neighbouring characters, repeated ones kept."""
    return F.when(F.length(c) >= 2, F.transform(F.sequence(F.lit(1), F.length(c) - 1), lambda i: F.substring(c, i, F.lit(2)))).otherwise(F.array().cast("array<string>"))


def bigram_codes(c: Column) -> Column:
    """array of whole numbers, all different: the bigrams of a text by their characters and by how often they stood before; to compare a text with many."""
    at = lambda i: F.ascii(F.substring(c, i, F.lit(1))).cast("long")
    codes = F.transform(F.sequence(F.lit(1), F.length(c) - 1), lambda i: F.shiftleft(at(i), 40) + F.shiftleft(at(i + 1), 16))
    numbered = lambda x: F.transform(x, lambda g, i: g + F.size(F.filter(F.slice(x, F.lit(1), i), lambda h: h == g)))
    return F.when(F.length(c) >= 2, numbered(codes)).otherwise(F.array().cast("array<bigint>"))


def dice_of_codes(x: Column, y: Column, a: Column, b: Column) -> Column:
    """dice_score of two texts a and b whose bigram_codes are x and y: one intersection, compiled."""
    ratio = F.size(F.array_intersect(x, y)) * 2 / (F.size(x) + F.size(y))
    return F.when((a == "") & (b == ""), 0).when(a == b, 100).when((F.size(x) == 0) | (F.size(y) == 0), 0).otherwise(F.floor(ratio * 100 + 0.5)).cast("int")


def dice_score(a: Column, b: Column) -> Column:
    """Whole percentage of the bigrams that two texts share, repeated ones counted: 100 for equal texts, 0 if both are empty or one has fewer than two
    characters. Built of Spark's own array functions."""
    return dice_of_codes(bigram_codes(a), bigram_codes(b), a, b)


def lig3_percent(a: str, b: str) -> float:
    """0.7 edits + 0.2 tokens + 0.1 prefix, each from 0 to 100 and at most 100 together, of texts in plain_text form. Not symmetric in its token part: the account's text comes first.

    Edits: substitution 1, gap 0.9, a gap at the start 0.8, a swap of neighbours 0.5, against the longer length.
    """
    if a == b:
        return 100.0 if a else 0.0
    if not a or not b:
        return 0.0
    two: list[float] = []
    one = [0.8 * j for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        row = [0.8 * i]
        for j, y in enumerate(b, 1):
            v = min(one[j - 1] + (x != y), one[j] + 0.9, row[-1] + 0.9)
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, two[j - 2] + 0.5)
            row.append(v)
        two, one = one, row
    longest = max(len(a), len(b))
    base = max(0.0, (longest - one[-1]) / longest * 100)
    return min(100.0, base * 0.7 + _token_part(a.split(), b.split()) * 100 * 0.2 + _prefix_part(a, b) * 100 * 0.1)


def lig3(a: str, b: str) -> float:
    """lig3_percent from 0 to 1."""
    return lig3_percent(a, b) / 100


def lig3_score(a: str, b: str) -> int:
    """lig3_percent as a whole percentage, halves up."""
    return math.floor(lig3_percent(a, b) + 0.5)


def _token_part(ours: list[str], theirs: list[str]) -> float:
    if len(ours) == 1 and len(theirs) == 1:
        return 0.0
    used, hits = set(), 0
    for t in ours:
        for k, u in enumerate(theirs):
            if k not in used and (t == u or (len(t) > 2 and u.startswith(t[:2]))):
                used.add(k)
                hits += 1
                break
    return hits / max(len(ours), len(theirs))


def _prefix_part(a: str, b: str) -> float:
    most = min(5, len(a), len(b))
    same = 0
    while same < most and a[same] == b[same]:
        same += 1
    return same / 5


def length_gate(a: Column, b: Column, threshold: int) -> Column:
    """Whether lig3 is to be asked at all: the lengths' ratio, in percent, reaches the threshold. A rule, not a shortcut: scores can exceed it."""
    return F.least(F.length(a), F.length(b)) * 100 >= F.greatest(F.length(a), F.length(b)) * threshold


def double_metaphone(word: str) -> tuple[str, str]:
    """Primary and secondary phonetic code, of the published algorithm's main rules, for Latin letters; codes are as long as the text makes them."""
    w = "".join(c for c in word.upper() if c.isalpha())
    one, two, i, n = [], [], 0, len(w)
    at = lambda k, *xs: any(k >= 0 and w.startswith(x, k) for x in xs)
    vowel = lambda k: 0 <= k < n and w[k] in "AEIOUY"

    def put(p: str, s: str | None = None) -> None:
        one.append(p)
        two.append(p if s is None else s)

    if at(0, "GN", "KN", "PN", "WR", "PS"):
        i = 1
    if at(0, "X"):
        put("S")
        i = 1
    while i < n:
        c, step = w[i], 1
        if c in "AEIOUY":
            if i == 0:
                put("A")
        elif c == "B":
            put("P")
            step = 2 if at(i + 1, "B") else 1
        elif c == "Ç":
            put("S")
        elif c == "C":
            if at(i, "CHIA") or (i == 0 and at(i, "CHARAC", "CHARIS", "CHOR", "CHYM", "CHEM")):
                put("K")
                step = 2
            elif at(i, "CH"):
                if i > 0 and at(i, "CHAE"):
                    put("K", "X")
                elif at(0, "VAN ", "VON ", "SCH") or at(i - 2, "ORCHES", "ARCHIT", "ORCHID") or at(i + 2, "T", "S"):
                    put("K")
                else:
                    put("X", "K" if i > 0 else "X")
                step = 2
            elif at(i, "CZ") and not at(i - 2, "WICZ"):
                put("S", "X")
                step = 2
            elif at(i + 1, "CIA"):
                put("X")
                step = 3
            elif at(i, "CC") and not (i == 1 and w[0] == "M"):
                if at(i + 2, "I", "E", "H") and not at(i + 2, "HU"):
                    put("KS" if (i == 1 and w[0] == "A") or at(i - 1, "UCCEE", "UCCES") else "X")
                    step = 3
                else:
                    put("K")
                    step = 2
            elif at(i, "CK", "CG", "CQ"):
                put("K")
                step = 2
            elif at(i, "CI", "CE", "CY"):
                put("S", "X" if at(i, "CIO", "CIE", "CIA") else "S")
                step = 2
            else:
                put("K")
                step = 2 if at(i + 1, "C", "K", "Q") and not at(i + 1, "CE", "CI") else 1
        elif c == "D":
            if at(i, "DG") and at(i + 2, "I", "E", "Y"):
                put("J")
                step = 3
            else:
                put("TK" if at(i, "DG") else "T")
                step = 2 if at(i, "DG", "DT", "DD") else 1
        elif c == "F":
            put("F")
            step = 2 if at(i + 1, "F") else 1
        elif c == "G":
            if at(i + 1, "H"):
                if i > 0 and not vowel(i - 1):
                    put("K")
                elif i == 0:
                    put("J" if at(i + 2, "I") else "K")
                elif (i > 1 and at(i - 2, "B", "H", "D")) or (i > 2 and at(i - 3, "B", "H", "D")) or (i > 3 and at(i - 4, "B", "H")):
                    pass
                elif i > 2 and at(i - 1, "U") and at(i - 3, "C", "G", "L", "R", "T"):
                    put("F")
                elif i > 0 and w[i - 1] != "I":
                    put("K")
                step = 2
            elif at(i + 1, "N"):
                if i == 1 and vowel(0):
                    put("KN", "N")
                elif not at(i + 2, "EY"):
                    put("N", "KN")
                else:
                    put("KN")
                step = 2
            elif at(i + 1, "LI"):
                put("KL", "L")
                step = 2
            elif i == 0 and at(i + 1, "Y", "ES", "EP", "EB", "EL", "EY", "IB", "IL", "IN", "IE", "EI", "ER"):
                put("K", "J")
                step = 2
            elif at(i + 1, "E", "I", "Y") or at(i - 1, "AGGI", "OGGI"):
                put("K" if at(i + 1, "ET") else "J", "J" if at(i + 1, "IER") else "K")
                step = 2
            else:
                put("K")
                step = 2 if at(i + 1, "G") else 1
        elif c == "H":
            if (i == 0 or vowel(i - 1)) and vowel(i + 1):
                put("H")
                step = 2
        elif c == "J":
            if at(i, "JOSE"):
                put("H" if n == 4 else "J", "H")
            elif i == 0:
                put("J", "A")
            elif vowel(i - 1) and at(i + 1, "A", "O"):
                put("J", "H")
            elif i == n - 1:
                put("J", "")
            elif not at(i + 1, "L", "T", "K", "S", "N", "M", "B", "Z") and not at(i - 1, "S", "K", "L"):
                put("J")
            step = 2 if at(i + 1, "J") else 1
        elif c == "K":
            put("K")
            step = 2 if at(i + 1, "K") else 1
        elif c == "L":
            put("L", "" if at(i + 1, "L") and i == n - 3 and at(i - 1, "ILLO", "ILLA", "ALLE") else "L")
            step = 2 if at(i + 1, "L") else 1
        elif c == "M":
            put("M")
            step = 2 if at(i + 1, "M") or (at(i - 1, "UMB") and (i + 1 == n - 1 or at(i + 2, "ER"))) else 1
        elif c in "NÑ":
            put("N")
            step = 2 if at(i + 1, "N") else 1
        elif c == "P":
            put("F" if at(i + 1, "H") else "P")
            step = 2 if at(i + 1, "H", "P", "B") else 1
        elif c == "Q":
            put("K")
            step = 2 if at(i + 1, "Q") else 1
        elif c == "R":
            put("" if i == n - 1 and at(i - 2, "IE") and not at(i - 4, "ME", "MA") else "R", "R")
            step = 2 if at(i + 1, "R") else 1
        elif c == "S":
            if at(i - 1, "ISL", "YSL"):
                pass
            elif i == 0 and at(i, "SUGAR"):
                put("X", "S")
            elif at(i, "SH"):
                put("S" if at(i + 1, "HEIM", "HOEK", "HOLM", "HOLZ") else "X")
                step = 2
            elif at(i, "SIO", "SIA"):
                put("S", "X")
                step = 3
            elif (i == 0 and at(i + 1, "M", "N", "L", "W")) or at(i + 1, "Z"):
                put("S", "X")
                step = 2 if at(i + 1, "Z") else 1
            elif at(i, "SC"):
                if at(i + 2, "H"):
                    if at(i + 3, "ER", "EN"):
                        put("X", "SK")
                    elif at(i + 3, "OO", "UY", "ED", "EM"):
                        put("SK")
                    else:
                        put("X", "S" if i == 0 and not vowel(3) and not at(3, "W") else "X")
                elif at(i + 2, "I", "E", "Y"):
                    put("S")
                else:
                    put("SK")
                step = 3
            else:
                put("" if i == n - 1 and at(i - 2, "AI", "OI") else "S", "S")
                step = 2 if at(i + 1, "S", "Z") else 1
        elif c == "T":
            if at(i, "TION", "TIA", "TCH"):
                put("X")
                step = 3
            elif at(i, "TH", "TTH"):
                if at(i + 2, "OM", "AM"):
                    put("T")
                else:
                    put("0", "T")
                step = 2
            else:
                put("T")
                step = 2 if at(i + 1, "T", "D") else 1
        elif c == "V":
            put("F")
            step = 2 if at(i + 1, "V") else 1
        elif c == "W":
            if at(i, "WR"):
                put("R")
                step = 2
            elif i == 0 and (vowel(1) or at(0, "WH")):
                put("A", "F" if vowel(1) else "A")
            elif (i == n - 1 and i > 0 and vowel(i - 1)) or at(i - 1, "EWSKI", "EWSKY", "OWSKI", "OWSKY"):
                put("", "F")
            elif at(i, "WICZ", "WITZ"):
                put("TS", "FX")
                step = 4
        elif c == "X":
            if not (i == n - 1 and at(i - 3, "IAU", "EAU") or i == n - 1 and at(i - 2, "AU", "OU")):
                put("KS")
            step = 2 if at(i + 1, "C", "X") else 1
        elif c == "Z":
            if at(i + 1, "H"):
                put("J")
            else:
                put("S", "TS" if at(i + 1, "ZO", "ZI", "ZA") else "S")
            step = 2 if at(i + 1, "Z", "H") else 1
        i += step
    return "".join(one), "".join(two)


def _code_likeness(a: str, b: str) -> float:
    return max(jaro_winkler(a, b), dice(a, b))


def dice(a: str, b: str) -> float:
    """The kernel of dice_score."""
    if a == b:
        return 1.0 if a else 0.0
    if len(a) < 2 or len(b) < 2:
        return 0.0
    left: dict[str, int] = {}
    for k in range(len(a) - 1):
        left[a[k : k + 2]] = left.get(a[k : k + 2], 0) + 1
    both = 0
    for k in range(len(b) - 1):
        g = b[k : k + 2]
        if left.get(g, 0):
            left[g] -= 1
            both += 1
    return 2 * both / (len(a) + len(b) - 2)


def metaphone_score(a: str, b: str) -> int:
    """100 for equal primary codes, 80 for equal secondary ones, 70 across; else a step of the best likeness of any two codes: 60, 45, 30, 15 or 0."""
    (p, s), (q, t) = double_metaphone(a), double_metaphone(b)
    if p and p == q:
        return 100
    if s and s == t:
        return 80
    if p == t or s == q:
        return 70
    like = max((_code_likeness(x, y) for x in (p, s) for y in (q, t) if x and y), default=0.0)
    return next((v for least, v in ((0.85, 60), (0.7, 45), (0.55, 30), (0.4, 15)) if like >= least), 0)


def _part_likeness(t: str, u: str) -> float:
    """Of two parts of names: 1 if equal, 0.8 for an initial of the other, else their Jaro-Winkler where it is above 0.8."""
    if t == u:
        return 1.0
    if len(t) == 1 or len(u) == 1:
        return 0.8 if t[0] == u[0] else 0.0
    v = jaro_winkler(t, u)
    return v if v > 0.8 else 0.0


def name_score(a: str, b: str) -> float:
    """0.5 tokens + 0.3 sound + 0.2 Jaro-Winkler of two names in plain_name form; parts may stand in any order, initials count 0.8."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    x, y = a.split(), b.split()
    left, hits = dict(enumerate(y)), 0.0
    for t in x:
        # The best of the parts not yet taken, the first of equally good ones.
        v, which = max(((_part_likeness(t, u), -k) for k, u in left.items()), default=(0.0, 0))
        if v > 0:
            del left[-which]
            hits += v
    codes = [double_metaphone(u) for u in y if len(u) > 1]
    sound, spoken = 0.0, [t for t in x if len(t) > 1]
    for t in spoken:
        best = max((jaro_winkler(c, d) for q in codes for c in double_metaphone(t) for d in q if c and d), default=0.0)
        sound += best if best >= 0.65 else 0.0
    phonetic = sound / max(len(spoken), len(codes)) if spoken and codes else 0.0
    return 0.5 * hits / max(len(x), len(y)) + 0.3 * phonetic + 0.2 * jaro_winkler(a, b)

"""Problem 10: the reading level of each document of English prose, by a linear pairwise ranker.

A text is cut into sentences. A word model tells sentences of English prose from machine output and other languages; the ranker, learnt from pairs of
graded documents, scores the prose by its vocabulary and syntax; a document's score is the median of its sentences, each counted by its words,
so that it is that of most of the prose; an isotonic regression turns scores into levels.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mergetide.session import ship
from mergetide.sources import read_table

#: At most so many graded documents are learnt from, drawn by a seeded hash.
SAMPLE = 3000
#: Words are told apart that stand in this share of all documents or more: at most as many as a document has on the average, divided by it.
WORD_SHARE = 1e-4
#: A language, or a kind of text, counts as graded if its share of graded documents is so large a part of the share in all of them.
LANG_PART, KIND_PART = 0.2, 0.05
#: Words that a document must have, and the least part of them that must be prose.
LEAST_WORDS, LEAST_PROSE = 20, 0.25

_FENCE = re.compile(r"```.*?(?:```|\Z)|~~~.*?(?:~~~|\Z)", re.S)
_END = re.compile(r"[.!?;:。！？]+(?:\s+|$)|,\s+and\s+|\n+\s*(?:[-*•>#]+\s*)?")
_TOKEN = re.compile(r"[^\W\d_]+(?:['’\-][^\W\d_]+)*")
_SYNTAX = ("length", "letters", "long", "commas")


def sentences(text: str | None) -> list[list[str]]:
    """The words of each sentence, in lower case; code in fences is left out."""
    parts = _END.split(_FENCE.sub("\n", (text or "").replace("\r", "\n")))
    return [w for w in (_TOKEN.findall(p.lower()) for p in parts if p) if w]


def syntax(words: list[str]) -> list[float]:
    n = len(words)
    return [math.log(n), sum(map(len, words)) / n / 5, sum(len(w) > 8 for w in words) / n, sum("-" in w for w in words) / n]


class Model:
    """prose: log odds of words; weight: the ranker's, of words and syntax; steps: (score, level) pairs of the isotonic regression."""

    def __init__(self, prose: dict[str, float], weight: dict[str, float], shape: list[float], steps: list[tuple[float, float]]):
        self.prose, self.weight, self.shape, self.steps = prose, weight, shape, steps

    def is_prose(self, words: list[str]) -> bool:
        get = self.prose.get
        return sum(get(w, 0.0) for w in words) > 0

    def score(self, words: list[str]) -> float:
        get = self.weight.get
        return sum(get(w, 0.0) for w in words) / len(words) + sum(a * b for a, b in zip(self.shape, syntax(words), strict=True))

    def document(self, text: str | None) -> tuple[int, int, float]:
        """(words, words of prose, median score of the prose)"""
        found = sentences(text)
        total = len((text or "").split())
        good = [s for s in found if self.is_prose(s)]
        if not good:
            return total, 0, 0.0
        scored = sorted((self.score(s), len(s)) for s in good)
        half, n = sum(x for _, x in scored) / 2, 0
        for value, count in scored:
            n += count
            if n >= half:
                break
        return total, sum(x for _, x in scored), value

    def level(self, score: float) -> int:
        xs, ys = zip(*self.steps, strict=True)
        return int(min(5, max(1, math.floor(np.interp(score, xs, ys) + 0.5))))


def isotonic(xs: np.ndarray, ys: np.ndarray) -> list[tuple[float, float]]:
    """Pool adjacent violators: the means of ys that rise with xs, at each pool's first and last x."""
    pools: list[list[float]] = []
    for x, y in sorted(zip(xs.tolist(), ys.tolist(), strict=True)):
        pools.append([y, 1.0, x, x])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            b, a = pools.pop(), pools.pop()
            pools.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2], b[3]])
    return [(x, p[0]) for p in pools for x in ((p[2], p[3]) if p[3] > p[2] else (p[2],))]


class Sparse:
    """A matrix by rows: the values that aren't zero, with their rows and columns."""

    def __init__(self, rows: np.ndarray, cols: np.ndarray, values: np.ndarray, shape: tuple[int, int]):
        self.rows, self.cols, self.values, self.shape = rows, cols, values, shape

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, self.values * w[self.cols], self.shape[0])

    def transposed_times(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.cols, self.values * g[self.rows], self.shape[1])


def rank(x: Sparse, grade: np.ndarray, rounds: int = 400, pairs: int = 60000, l2: float = 1e-3, seed: int = 0) -> np.ndarray:
    """Weights w such that x times w ranks documents by grade: logistic loss on pairs of different grade, by gradient steps with momentum."""
    rng = np.random.default_rng(seed)
    n, w, v = len(grade), np.zeros(x.shape[1]), np.zeros(x.shape[1])
    # Every grade is drawn as often as any other, so that rare grades are told apart too.
    near = np.floor(grade + 0.5).astype(int)
    p = 1 / np.bincount(near)[near]
    p /= p.sum()
    i, j = rng.choice(n, pairs, p=p), rng.choice(n, pairs, p=p)
    up = grade[i] > grade[j]
    i, j = np.where(up, i, j), np.where(up, j, i)
    keep = grade[i] != grade[j]
    i, j = i[keep], j[keep]
    if not len(i):
        return w
    part = (grade[i] - grade[j]) / (grade[i] - grade[j]).mean()
    step = 4.0 / max((x.values**2).sum() / n, 1e-9)
    for _ in range(rounds):
        s = x.times(w)
        c = part / (1 + np.exp(np.clip(s[i] - s[j], -30, 30)))
        g = np.bincount(j, c, n) - np.bincount(i, c, n)
        v = 0.9 * v - step * (x.transposed_times(g) / len(i) + l2 * w)
        w = w + v
    return w


def prose_words(words: dict[str, tuple[int, int]]) -> dict[str, float]:
    """The log odds of words for prose; ``words``: in how many documents that are surely prose, and surely not, a word stands."""
    a, b = max((x for x, _ in words.values()), default=1) + 1, max((y for _, y in words.values()), default=1) + 1
    return {w: max(-4.0, min(4.0, math.log((x + 0.5) / a) - math.log((y + 0.5) / b))) for w, (x, y) in words.items()}


def features(model: Model, text: str | None) -> tuple[list[str], list[float], list[float]] | None:
    """(words, the share of each in the prose, syntax) of a text; None if it has no prose."""
    good = [s for s in sentences(text) if model.is_prose(s)]
    if not good:
        return None
    n = sum(map(len, good))
    seen = Counter(w for s in good for w in s)
    shape = [sum(v) / n for v in zip(*[[x * len(s) for x in syntax(s)] for s in good], strict=True)]
    return list(seen), [k / n for k in seen.values()], shape


def ranker(rows: list[tuple[float, list[str], list[float], list[float]]], seed: int = 0) -> tuple[dict[str, float], list[float]]:
    """(weight of words, weight of syntax) learnt from (grade, words, shares, syntax) of graded documents."""
    df = Counter(w for _, words, _, _ in rows for w in words)
    names = [w for w, n in df.most_common() if n >= 3]
    at = {w: k for k, w in enumerate(names)}
    cells = [(r, at[w], v) for r, (_, words, shares, _) in enumerate(rows) for w, v in zip(words, shares, strict=True) if w in at]
    cells += [(r, len(names) + k, v) for r, (_, _, _, shape) in enumerate(rows) for k, v in enumerate(shape)]
    r, c, v = (np.array(z) for z in zip(*cells, strict=True))
    shape = (len(rows), len(names) + len(_SYNTAX))
    scale = np.sqrt(np.bincount(c, v * v, shape[1]) / shape[0]) + 0.02
    w = rank(Sparse(r, c, v / scale[c], shape), np.array([g for g, *_ in rows]), seed=seed) / scale
    return {n: x for n, x in zip(names, w, strict=False)}, w[len(names) :].tolist()


def fit(documents: DataFrame, grades: DataFrame) -> Model:
    """The model of the graded documents (at most SAMPLE, by a seeded hash of the id; words are counted over all documents).

    Which words are prose: they stand in graded documents rather than in those of a kind and language of which no document is graded.
    """
    def plain(c: str):
        return F.regexp_extract(F.lower(F.trim(F.coalesce(c, F.lit("")))), r"^[a-z]*", 0)

    grade = grades.where("level between 1 and 5").groupBy("doc_id").agg(F.avg("level").alias("grade"))
    docs = documents.where("text is not null").select("doc_id", "text", plain("lang").alias("lang"), plain("source").alias("kind"))
    marked = docs.join(grade, "doc_id", "left")
    all_ = marked.agg(F.count("*").alias("n"), F.count("grade").alias("g")).first()
    if not all_["g"]:
        return Model({}, {}, [0.0] * len(_SYNTAX), [(0.0, 3.0)])
    usual = all_["g"] / all_["n"]
    rate = F.count("grade") / F.count("*")
    langs = marked.groupBy("lang").agg(rate.alias("p")).where(F.col("p") > LANG_PART * usual).select("lang", F.lit(True).alias("l"))
    kinds = marked.groupBy("kind").agg(rate.alias("q")).where(F.col("q") > KIND_PART * usual).select("kind", F.lit(True).alias("k"))
    marked = marked.join(langs, "lang", "left").join(kinds, "kind", "left")
    marked = marked.withColumn("surely", F.when(F.col("grade").isNotNull(), 1).when(F.col("l").isNull() | F.col("k").isNull(), 0)).where("surely is not null")
    words = marked.select("doc_id", "surely", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}]+(?:['’\-][\p{L}]+)*"), F.lit(0)))).alias("w"))
    counts = words.groupBy("w").agg(F.sum("surely").alias("yes"), F.sum(1 - F.col("surely")).alias("no")).where(F.col("yes") + F.col("no") >= WORD_SHARE * all_["n"])
    model = Model(prose_words({r["w"]: (r["yes"], r["no"]) for r in counts.collect()}), {}, [0.0] * len(_SYNTAX), [(0.0, 3.0)])
    drawn = grade.orderBy(F.xxhash64("doc_id", F.lit(0)), "doc_id").limit(SAMPLE)
    sample = docs.join(drawn, "doc_id").select("doc_id", "text", "grade")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [(d, g, *f) for d, t, g in zip(pdf["doc_id"], pdf["text"], pdf["grade"], strict=True) if (f := features(model, t))]
            yield pd.DataFrame(got, columns=["doc_id", "grade", "words", "shares", "shape"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = [tuple(r)[1:] for r in sample.mapInPandas(read, f"doc_id {kind}, grade double, words array<string>, shares array<double>, shape array<double>").orderBy("doc_id").collect()]
    if not rows:
        return model
    model = Model(model.prose, *ranker(rows), model.steps)

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [(d, g, x[2]) for d, t, g in zip(pdf["doc_id"], pdf["text"], pdf["grade"], strict=True) if (x := model.document(t))[1]]
            yield pd.DataFrame(got, columns=["doc_id", "grade", "score"])

    pairs = sample.mapInPandas(scored, f"doc_id {kind}, grade double, score double").orderBy("doc_id").collect()
    return Model(model.prose, model.weight, model.shape, isotonic(np.array([r["score"] for r in pairs]), np.array([r["grade"] for r in pairs])))


def reading_levels(documents: DataFrame, grades: DataFrame) -> DataFrame:
    """(doc_id, level): the level 1 to 5 of each document of LEAST_WORDS words or more, of which LEAST_PROSE or more are English prose.

    Null, short and other texts give no row; a repeated document gives a row each; null grades and raters don't matter; without grades no
    document can be told to be prose, so the result is empty. Whole texts are read, however long.
    """
    ship(documents.sparkSession)
    model = fit(documents, grades)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for d, t in zip(pdf["doc_id"], pdf["text"], strict=True):
                total, prose, score = model.document(t)
                if total >= LEAST_WORDS and prose >= LEAST_PROSE * total:
                    rows.append((d, model.level(score)))
            yield pd.DataFrame(rows, columns=["doc_id", "level"]).astype({"doc_id": pdf["doc_id"].dtype, "level": "int32"})

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.where("text is not null").select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, level int")


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return reading_levels(read_table(spark, folder, "documents", "doc_id", "text", "lang", "source"), read_table(spark, folder, "doc_levels", "doc_id", "level"))


QUERIES = {"p10_found": p10_found}
ORACLES: dict[str, str] = {}

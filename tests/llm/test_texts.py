import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mergetide.llm import bpe, mixing, reading, tokenize


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.read_ranks(open(tokenize.TOKENIZER, "rb").read()))


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return t


TEXTS = ["", " ", "hello world", "a" * 4000, "ab" * 3000, "日本語の文章です。" * 200, "<|endoftext|> is text", "x\r\n\t  y  ", "naïve café — ’s 123456 don't​﻿", "👩🏽‍💻 ok", "\u0000\u0001", "of " * 50 + "   "]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_equal_the_library(encoder, library, text):
    assert encoder.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_random_texts(encoder, library):
    r = random.Random(1)
    for _ in range(200):
        t = "".join(r.choice("abe tion  the\n\t.,'sé世1") for _ in range(r.randrange(200)))
        assert encoder.encode(t) == library.encode(t, add_special_tokens=False).ids


def test_queue_order():
    q = bpe.RankQueue(50257)
    r = random.Random(2)
    put = [(r.randrange(50257), k) for k in range(500)] + [(7, 3), (7, 1)]
    for rank, at in put:
        q.push(rank, at)
    got = []
    while (x := q.pop())[0] >= 0:
        got += [(x[0], p) for p in x[1]]
    assert got == sorted(put) and q.pop() == (-1, [])


def test_corpus(spark):
    df = spark.createDataFrame([(1, "hello", 9), (2, None, 9), (3, "", 9), (1, "hello", 9)], "doc_id long, text string, ids int")
    got = sorted((r.doc_id, list(r.ids)) for r in tokenize.encode_corpus(df).collect())
    assert got == [(1, [31373]), (1, [31373]), (2, []), (3, [])]
    assert tokenize.encode_corpus(df.limit(0)).collect() == []
    assert [r.n for r in df.orderBy("doc_id").select(tokenize.token_count(F.col("text")).alias("n")).collect()] == [1, 1, 0, 0]


# p9


@pytest.mark.parametrize("seed", range(6))
def test_fit_reaches_the_budget(seed):
    r = random.Random(seed)
    lengths = sorted(r.sample(range(1, 60), 12))
    counts = [r.randrange(1, 9) for _ in lengths]
    total = sum(a * b for a, b in zip(lengths, counts, strict=True))
    for budget in (0, 1, total // 3, total // 2, total, total + 5):
        take = mixing.fit(lengths, counts, budget, exact=200)
        got = sum(a * b for a, b in zip(lengths, take, strict=True))
        assert all(0 <= t <= c for t, c in zip(take, counts, strict=True)) and got <= budget
        if lengths[0] == 1 or budget >= total:
            assert got >= min(budget, total) - (0 if budget >= total else lengths[0])


def test_fit_is_exact_where_the_rest_is_small():
    for budget in range(60):
        sums = {0}
        for n, c in ((4, 3), (7, 2), (11, 2)):
            sums = {s + n * k for s in sums for k in range(c + 1)}
        take = mixing.fit([4, 7, 11], [3, 2, 2], budget, exact=1000)
        got = 4 * take[0] + 7 * take[1] + 11 * take[2]
        assert got <= budget
        if budget <= 12:
            assert got == max(s for s in sums if s <= budget)


def test_mix(spark):
    docs = [(k, " A " if k % 2 else "b", 5 + k % 3, "x") for k in range(200)] + [(900, None, 5, "x"), (901, "c", 5, "x"), (902, "a", 0, "x"), (903, "a", None, "x")]
    df = spark.createDataFrame(docs, "doc_id long, source string, tokens int, times string")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.25, 3), ("gone", 0.25, 2)], "source string, target_share double, max_repeats int")
    chosen, rep = mixing.mix(df, targets, "doc_id", "source", "tokens")
    shares = {r.source: r.actual_share for r in rep.collect()}
    assert abs(shares["a"] - 2 / 3) < 0.01 and abs(shares["b"] - 1 / 3) < 0.01 and shares["gone"] == 0
    rows = chosen.collect()
    assert len({r.doc_id for r in rows}) == len(rows) and all(r.source in ("a", "b") for r in rows)
    again = {tuple(r) for r in mixing.mix(df, targets, "doc_id", "source", "tokens")[0].collect()}
    assert again == {tuple(r) for r in rows}
    big, rep = mixing.mix(df, targets, "doc_id", "source", "tokens", total=100_000)
    assert {r.source: r.most_times for r in rep.collect()} == {"a": 1, "b": 3, "gone": 0}
    assert mixing.mix(df.limit(0), targets, "doc_id", "source", "tokens")[0].collect() == []


# p10


def test_isotonic():
    got = reading.isotonic(np.array([1.0, 2, 3, 4]), np.array([1.0, 3, 2, 5]))
    assert got == [(1.0, 1.0), (2.0, 2.5), (3.0, 2.5), (4.0, 5.0)]


LEVELS = ["the dog is big and red", "please update the phone number before lunch", "the connector normalizes a pending attribute", "the partition serializes idempotent concurrency", "epistemological presuppositions adumbrate onomastic variability"]


def corpus(spark):
    r = random.Random(1)
    docs, grades = [], []
    for k in range(120):
        lv = k % 5
        text = ". ".join(" ".join(r.sample(LEVELS[lv].split(), 4)) for _ in range(8)) + "."
        docs.append((k, text, "en", "guide", 3))
        if k % 2 == 0:
            grades += [(k, "ra", lv + 1), (k, "rb", lv + 1), (k, "rc", None)]
    for k in range(200, 260):
        docs.append((k, "\n".join(f"ERROR duplicate native skipped {r.random()}" for _ in range(20)), "en", "runlog", 3))
        docs.append((k + 100, "die zuordnung ist gesperrt und konten bleiben offen " * 4, "de", "guide", 3))
    docs += [(900, None, "en", "guide", 3), (901, "", "en", "guide", 3), (902, "the dog is big", "en", "guide", 3), (903, (LEVELS[1] + ". ") * 3000, "en", None, 3)]
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, level int"), spark.createDataFrame(grades, "doc_id long, rater string, level int")


def test_reading_levels(spark):
    docs, grades = corpus(spark)
    got = {r.doc_id: r.level for r in reading.reading_levels(docs, grades).collect()}
    assert {k: v for k, v in got.items() if k < 120} == {k: k % 5 + 1 for k in range(120)}
    assert set(got) - set(range(120)) == {903} and got[903] == 2
    assert reading.reading_levels(docs.limit(0), grades).collect() == []
    assert reading.reading_levels(docs, grades.limit(0)).collect() == []


def test_limiting_source_gives_all_its_copies(spark):
    docs = spark.createDataFrame([(k, "a", 97) for k in range(4)] + [(100 + k, "b", 50) for k in range(2000)] + [(9000, "c", 70)], "doc_id long, source string, tokens long")
    targets = spark.createDataFrame([("a", 0.03, 6), ("b", 0.95, 9), ("c", 0.02, 0)], "source string, target_share double, max_repeats int")
    chosen, rep = mixing.mix(docs, targets, "doc_id", "source", "tokens")
    assert {r.times for r in chosen.where("source = 'a'").collect()} == {6}
    got = {r.source: r for r in rep.collect()}
    assert got["a"].mixed_tokens == 2328 and got["c"].mixed_tokens == 0 and abs(got["a"].actual_share - 0.03 / 0.98) < 1e-3

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mergetide.functions import similarity as S


@pytest.mark.parametrize(("a", "b", "want"), [("MARTHA", "MARHTA", 96), ("DIXON", "DICKSONX", 81), ("a", "b", 0), ("ab", "ba", 0), ("a", "ab", 85), ("", "", 0), ("x", "x", 100)])
def test_jaro_winkler(a, b, want):
    assert S.percent(S.jaro_winkler(a, b)) == want


def test_jaro_keeps_half_transpositions():
    assert round(S.jaro("acd- c", "d-c "), 4) == 0.7639


@pytest.mark.parametrize(("a", "b", "want"), [("night", "nacht", 25), ("aaaa", "aa", 50), ("123 Main Street", "123 Main St", 83), ("New York", "Los Angeles", 0), ("", "", 0), ("a", "ab", 0)])
def test_dice(spark, a, b, want):
    row = spark.createDataFrame([(a, b)], "a string, b string").select(S.dice_score(F.col("a"), F.col("b")).alias("d")).first()
    assert row.d == S.percent(S.dice(a, b))
    assert abs(row.d - want) <= 1


@pytest.mark.parametrize(("a", "b", "want"), [("smith", "smyth", 60), ("robert", "robert smith", 58), ("ann", "ann b", 61), ("john", "john robert doe", 38), ("jo ann", "john", 41), ("john", "jo ann", 51)])
def test_lig3(a, b, want):
    assert S.lig3_score(a, b) == want


def test_metaphone_codes():
    for a, b in (("Smith", "Smyth"), ("Stephen", "Steven"), ("Catherine", "Katherine"), ("Philip", "Filip"), ("knight", "nite")):
        assert set(S.double_metaphone(a)) & set(S.double_metaphone(b)), (a, b)
    assert S.double_metaphone("") == ("", "")
    assert S.metaphone_score("smith", "smyth") == 100


def test_metaphone_of_whole_names_and_all_codes(monkeypatch):
    assert S.metaphone_score("jonathan smith", "jonathan smith") == 100
    assert S.metaphone_score("jonathan smith", "jonathan brown") < 100
    monkeypatch.setattr(S, "double_metaphone", {"a": ("KKKK", "TRSN"), "b": ("LLLL", "TRSM")}.get)
    assert S.metaphone_score("a", "b") == 60


def test_names_in_any_order():
    assert S.name_score("john smith", "smith john") > 0.75
    assert S.name_score("j smith", "john smith") > S.name_score("k smith", "john smith")


@given(st.text(max_size=12), st.text(max_size=12))
def test_ranges(a, b):
    for f in (S.jaro_winkler, S.dice, S.lig3, S.name_score):
        assert 0 <= f(a, b) <= 1.0000001
    assert S.dice(a, b) == S.dice(b, a)
    assert S.metaphone_score(a, b) in (0, 15, 30, 45, 60, 70, 80, 100)

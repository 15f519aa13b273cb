import pytest
from pyspark.sql import functions as F

from mergetide.functions.template import HELPERS, compile_template, place_helpers
from mergetide.functions.text import proper_name
from mergetide.operators.defining import Definition, define
from mergetide.operators.unique import allocate_template


def render(spark, source, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
    return df.select(compile_template(source, {c: F.col(c) for c in values}).alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ('$Datefns.format($d, "yyyy-MM-dd")', "2024-01-31"), ('$Datefns.format($d, "d/M/yy HH:mm:ss")', "31/1/24 10:05:09"), ("$Datefns.addMonths($d, 1)", "2024-03-02T10:05:09.000Z"), ("$Datefns.subDays($d, 31)", "2023-12-31T10:05:09.000Z"),
        ("$Datefns.addYears($d, 1)", "2025-01-31T10:05:09.000Z"), ("$Datefns.getYear($d)", "2024"), ("$Datefns.differenceInDays($d, $e)", "30"), ("#if($Datefns.isBefore($e, $d))yes#else no#end", "yes"), ("#if($Datefns.isAfter($e, $d))yes#else no#end", " no"),
        ("$Datefns.startOfDay($d)", "2024-01-31T00:00:00.000Z"), ("$Datefns.endOfDay($d)", "2024-01-31T23:59:59.999Z"), ("#if($Datefns.isValid($n))yes#else no#end", " no"), ("$JSON.stringify($q)", '"a\\"b"'), ("$JSON.parse($j).name", "Ann"),
        ("$Normalize.address($a)", "12 Oak St, Springfield, IL, 62701"), ("$AddressParse.parse($a).city", "Springfield"), ("$Math.pow(2, 3)", "8.0"), ("$Math.trunc(-2.5)", "-2"), ('#if($q.replace("a", ""))x#end', "x"),
        ("$q.toString().", 'a"b.'), ('$e.slice(0, 4)', "2024"), ('$n.padStart(4, "0")', "0no!"),
    ],
)
def test_helpers(spark, source, want):
    v = dict(d="2024-01-31T10:05:09Z", e="2024-01-01T00:00:00Z", n="no!", q='a"b', j='{"name": "Ann"}', a="12 Oak St, Springfield, IL 62701")
    assert render(spark, source, **v) == want


def test_towns_are_a_parameter(spark, monkeypatch):
    for k, f in place_helpers({"seattle": ("Washington", "WA")}).items():
        monkeypatch.setitem(HELPERS, k, f)
    assert render(spark, "$AddressParse.getCityState($c)-$AddressParse.getCityStateCode($c)", c=" Seattle") == "Washington-WA"


@pytest.mark.parametrize(("name", "want"), [("VAN DER BERG", "van Der Berg"), ("DE LA CRUZ", "de la Cruz"), ("macarthur", "MacArthur"), ("o'BRIEN", "O'Brien"), ("MARY-JANE", "Mary-Jane"), ("mcdonald", "McDonald"), ("", ""), ("von trapp", "von Trapp")])
def test_proper_name(name, want):
    assert proper_name(name) == want


def test_define_in_order(spark):
    rows = spark.createDataFrame([("1", "Ann", "Lee", None, True), ("2", None, None, "old", True), ("3", "Bo", "Ray", "old", False)], "id string, f string, l string, login string, new boolean")
    defs = [Definition("login", "$f.$l", case="lower"), Definition("mail", "$login@x.example", refresh=True)]
    got = {r.id: (r.login, r.mail) for r in define(rows, defs, {"login": "id"}, F.col("new")).collect()}
    assert got["1"] == ("ann.lee", "ann.lee@x.example") and got["3"] == ("old", "old@x.example")


def test_unique_by_template(spark):
    rows = spark.createDataFrame([(1, "ann", None), (2, "ann", None), (3, "ann", "ann1"), (4, None, None), (5, "bo", None)], "id int, f string, have string")
    got = {r.id: r.value for r in allocate_template(rows.where("f is not null"), "id", "id", "$f", existing="have", digits=2).collect()}
    assert got == {1: "ann", 2: "ann01", 3: "ann1", 5: "bo"}
    got = {r.id: r.value for r in allocate_template(rows.where("f is not null"), "id", "id", "x$counter-$f", existing="have", anew=F.lit(True)).collect()}
    assert got == {1: "x-ann", 2: "x1-ann", 3: "x2-ann", 5: "x-bo"}
    ids = {r.value for r in allocate_template(rows, "id", "id", "$UUID").collect()}
    assert len(ids) == 5

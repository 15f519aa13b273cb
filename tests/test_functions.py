import datetime

import pytest
from pyspark.sql import functions as F

from mergetide.functions import dates, keys, template, text


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(column.alias("x")).first().x


def test_presence(spark):
    for v, want in ((None, False), ("", False), (" \t ", False), ("0", True), ("x", True)):
        assert one(spark, text.present(F.col("v")), v=v) is want


@pytest.mark.parametrize(("v", "want"), [("[HR] [IT]", ["HR", "IT"]), ("[A] [B]", ["A] [B"]), ("plain", ["plain"]), (" ", []), (None, []), ("[HR] [HR]", ["HR"])])
def test_brackets(spark, v, want):
    assert one(spark, text.split_tokens(F.col("v")), v=v) == want


def test_case(spark):
    assert one(spark, text.capitalized(F.col("v")), v="van der mEER") == "Van Der MEER"
    assert one(spark, text.padded(F.col("v"), 3), v="7") == "007"
    assert one(spark, text.padded(F.col("v"), 3), v="1234") == "1234"
    assert one(spark, text.kept_counter(F.col("v"), F.lit("12"), 5), v="jsmith") == "jsm12"


def test_forms(spark):
    assert one(spark, text.ascii_form(F.col("v")), v="Łukasz O'Brién") == "Lukasz OBrien"
    assert one(spark, text.proper_form(F.col("v")), v="JUAN DE LA mcdonald-o'neil") == "Juan de la McDonald-O'Neil"
    assert one(spark, text.ssn_form(F.col("v")), v="973-62-5155") == "973625155"
    assert one(spark, text.phone_form(F.col("v")), v="1 (920) 555-8020") == "+1 920 555 8020"
    assert one(spark, text.phone_form(F.col("v")), v="555-01") == ""
    assert one(spark, text.email_form(F.col("v")), v="mailto:A.B@x.example;") == "a.b@x.example"


@pytest.mark.parametrize(("v", "want"), [("2001-02-03", "2001-02-03"), ("2001/2/3", "2001-02-03"), ("03/02/2001", "2001-02-03"), ("12/25/2001", "2001-12-25"), ("Feb 3 2001", "2001-02-03"), ("3 February 2001", "2001-02-03"), ("03/Feb/2001", None), ("31/02/2001", None), ("", None), (None, None), ("00/00/0000", None)])
def test_dates(spark, v, want):
    got = one(spark, dates.read_date(F.col("v")), v=v)
    assert (got and got.isoformat()) == want


def test_months_roll_over(spark):
    day = F.to_date(F.lit("2023-01-31"))
    assert one(spark, dates.add_months(day, 1), v="") == datetime.date(2023, 3, 3)
    assert one(spark, dates.add_years(F.to_date(F.lit("2024-02-29")), 1), v="") == datetime.date(2025, 3, 1)


def test_keys(spark):
    assert one(spark, keys.account_key(F.col("a"), F.col("b")), a=" s ", b="1 ") == "s::1"
    assert one(spark, keys.account_key(F.col("a"), F.col("b")), a=" ", b="1") is None
    assert tuple(one(spark, keys.key_parts(F.col("a")), a="s::1::2")) == ("s", "1::2")
    assert one(spark, keys.key_parts(F.col("a")), a="::2") is None


@pytest.mark.parametrize(
    ("source", "want"),
    [("$first.$last", "Ada.Lovelace"), ("${first}x", "Adax"), ("$first.substring(0,1).toLowerCase()$last", "aLovelace"), ("$nobody", "$nobody"), ("$!gone|", "|"), ("$gone", "$gone"), ("#set($x = $first.toUpperCase())$x-$x", "ADA-ADA"), ("#if($gone)yes#elseif($first == 'Ada')ada#else no#end", "ada"), ("#if($first.length() > 5)long#{end}", None), ("$Normalize.ssn('1-2')|", "|"), ("$Math.round(2.5)", "3")],
)
def test_templates(spark, source, want):
    c = {"first": F.col("first"), "last": F.col("last"), "gone": F.col("gone")}
    if want is None:
        with pytest.raises(template.TemplateError):
            template.compile_template(source, c)
    else:
        assert one(spark, template.compile_template(source, c), first="Ada", last="Lovelace", gone=None) == want


def test_attribute_steps(spark):
    c = {"last": F.col("last")}
    assert one(spark, template.attribute(" $last ", c, most=6, trim=True, case="upper", normalize=True), last="Müller") == "MULLE"
    assert one(spark, template.attribute("$nothing", c), last="x") is None
    with pytest.raises(template.TemplateError):
        template.compile_template("$last.getClass()", c)

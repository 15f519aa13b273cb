import datetime

from pyspark.sql import functions as F

from mergetide.functions import attributes as A
from mergetide.functions.places import first_place
from mergetide.operators import blocking, matching, schema
from mergetide.operators.mapping import Mapping
from mergetide.sources import sinks


def test_bags(spark):
    df = spark.createDataFrame([({"title": ["Buyer"], "tags": ["a", "b"], "n": ["x"], "ok": ["TRUE"]}, {"title": None, "n": ["7"]})], "a map<string,array<string>>, b map<string,array<string>>")
    m = A.merged(F.col("a"), F.col("b"))
    r = df.select(m.alias("m"), A.single(A.pick(m, "Title")).alias("t"), A.typed(A.single(A.pick(m, "n")), "int").alias("n"), A.typed(F.lit("x"), "long").alias("z"), A.as_set(F.array(F.lit(" a"), F.lit("a"), F.lit(" "), F.lit(None))).alias("s")).first()
    assert r.m == {"title": ["Buyer"], "tags": ["a", "b"], "n": ["7"], "ok": ["TRUE"]}
    assert (r.t, r.n, r.z, r.s) == ("Buyer", 7, 0, ["a"])
    f = schema.discovered([schema.Field("id")], [[schema.Field("n", "int"), schema.Field("ok", "boolean")], [schema.Field("N", "string")]], [Mapping("tags", "list")], ["title"])
    assert [(x.name, x.kind, x.multi) for x in f] == [("id", "string", False), ("n", "int", False), ("ok", "boolean", False), ("tags", "string", True), ("title", "string", False)]
    p = schema.projected(df, F.col("a"), f, []).first()
    assert (p.id, p.n, p.ok, p.tags, p.title) == (None, 0, True, ["a", "b"], "Buyer")


def test_refresh(spark):
    t = datetime.datetime(2025, 1, 1)
    rows = [(t + datetime.timedelta(seconds=61), t, True), (t + datetime.timedelta(seconds=60), t, False), (None, t, False), (t, None, True)]
    df = spark.createDataFrame(rows, "a timestamp, r timestamp, want boolean")
    assert df.where(A.needs_refresh(F.col("a"), F.col("r")) != F.col("want")).count() == 0


def test_places_in_texts(spark):
    rows = spark.createDataFrame([(1, "12 Main St, West New York, near York"), (2, "nowhere"), (3, None), (4, "york")], "k int, t string")
    places = spark.createDataFrame([("New York",), ("York",), ("New",)], "city string")
    assert {r.k: r.city for r in first_place(rows, "k", "t", places, "city").collect()} == {1: "New York", 4: "York"}


def test_custom_rules_and_full_scan(spark):
    pairs = spark.createDataFrame([("abc", "abd"), ("abc", None)], "n_a string, n_i string")
    rule = matching.Rule("n", "custom", 50, expression="#if($accountValue == $candidateValue)100#else$accountValue.length()#end")
    assert [r.r0 for r in matching.scored(pairs, [rule]).orderBy(F.desc_nulls_last("n_i")).collect()] == [3, 3]
    assert pairs.select(matching.custom_score("250", F.col("n_a"), F.col("n_i"), "n").alias("x")).first().x == 100
    assert pairs.select(matching.max_achievable([F.lit(50), F.lit(None).cast("int")], [1.0, 1.0]).alias("x")).first().x == 75.0
    a = spark.createDataFrame([(1, None), (2, "x"), (3, "")], "a int, n string")
    got = blocking.full_pairs(a, spark.range(3).withColumnRenamed("id", "i"), "a", "i", ["n"], 1).collect()
    assert sorted((r.a, r.i) for r in got) == [(k, i) for k in (1, 3) for i in range(3)]


def test_state(spark, tmp_path):
    at = str(tmp_path / "state")
    empty = sinks.load_state(spark, at, "source string, n long")
    assert empty.count() == 0
    one = spark.createDataFrame([("s", 3)], "source string, n long")
    sinks.save_state(sinks.counted(empty, one, "source", "n"), at)
    sinks.save_state(sinks.counted(sinks.load_state(spark, at, "source string, n long"), one, "source", "n"), at)
    assert [tuple(r) for r in sinks.load_state(spark, at, "source string, n long").collect()] == [("s", 6)]
    sinks.write_report(one, one, str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report/rows")).count() == 1

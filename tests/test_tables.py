import datetime
import random

import pytest
from pyspark.sql import functions as F

from mergetide.functions import attributes, urls
from mergetide.operators import hierarchy, mapping, report, reviews, routing
from mergetide.operators.mapping import Mapping
from mergetide.sources import scan

INSTANCES = "instance string, form string, ord long, account string, account_name string, source_name string, source_type string, state string, recipients array<string>, candidates string, is_new boolean, chosen array<string>, comments string, url string"


def instances(spark, *rows):
    names = [f.split()[0] for f in INSTANCES.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], INSTANCES)


def one(spark, c, **values):
    return spark.range(1).select(*[v.alias(k) for k, v in values.items()]).select(c.alias("x")).first()["x"]


def test_tokens_and_bags(spark):
    for text, want in [('["a", {"id": "b"}, {"name": "c"}, " "]', ["a", "b", "c"]), ("report", ["report"]), ('{"value": "v"}', ["v"]), ("", []), (None, []), ("7", ["7"]), ('"q"', ["q"])]:
        assert one(spark, attributes.tokens(F.col("t")), t=F.lit(text).cast("string")) == want
    bag = F.expr("map('Name', array('x'), 'email', array(' a@x.example ', 'a@x.example', 'b'))")
    assert one(spark, attributes.with_both_cases(F.col("b"), "Name", F.array(F.lit("y"))), b=bag)["name"] == ["y"]
    assert one(spark, attributes.with_attribute(F.lit(None).cast("map<string,array<string>>"), "k", F.array(F.lit("y")))) == {"k": ["y"]}
    assert "Name" not in one(spark, attributes.with_attribute(F.col("b"), "Name", F.lit(None).cast("array<string>")), b=bag)
    assert one(spark, F.filter(attributes.mails(F.col("b")), attributes.valid_mail), b=bag) == ["a@x.example"]
    assert one(spark, attributes.output_key(F.col("b"), "uid", F.lit("n1"), True), b=bag) is None
    assert tuple(one(spark, attributes.output_key(F.col("b"), "uid", F.lit("n1"), False), b=bag)) == ("n1", "n1")


def test_links(spark):
    base = F.lit("https://tenant.api.host.example/v3")
    assert one(spark, urls.ui_origin(base)) == "https://tenant.host.example"
    assert one(spark, urls.link(urls.ui_origin(base), "/ui/a/{id}/x", id=F.lit("a b/c"))) == "https://tenant.host.example/ui/a/a%20b%2Fc/x"
    assert one(spark, urls.link(urls.ui_origin(base), "/{id}", id=F.lit(None).cast("string"))) is None


def test_scans(spark):
    df = spark.createDataFrame([(1, "a", 5)], "id int, over string, credit_limit int")
    assert scan.checked_filter(df, "credit_limit > 3 and over <> ' select '").count() == 1
    for bad in ("id in (select 1)", "row_number() over (order by id) = 1"):
        with pytest.raises(scan.FilterError):
            scan.checked_filter(df, bad)
    src = spark.createDataFrame([("s1", "One"), ("s2", "Two")], "id string, name string")
    assert [r.id for r in scan.checked_sources(spark.createDataFrame([("Two", 5)], "name string, limit int"), src).collect()] == ["s2"]
    with pytest.raises(scan.FilterError, match="Three"):
        scan.checked_sources(spark.createDataFrame([("Three", 5)], "name string, limit int"), src)
    t = lambda h: datetime.datetime(2025, 1, 1, h)
    runs = scan.due(spark.createDataFrame([("a", t(1)), ("a", t(3)), ("b", t(1)), ("c", t(1))], "s string, at timestamp"), spark.createDataFrame([("a", t(2)), ("b", t(2))], "r string, at timestamp"), "s", "r", "at")
    assert {r.s: r.due for r in runs.collect()} == {"a": True, "b": False, "c": True}
    got = scan.hydrated(spark.createDataFrame([("1",), (None,), ("9",)], "k string"), "k", spark.createDataFrame([("1", "n")], "id string, name string"), ["name"])
    assert {(r.k, r["name"]) for r in got.collect()} == {("1", "n"), (None, None), ("9", None)}


def test_form_states(spark):
    df = instances(
        spark,
        dict(instance="1", form="a", ord=1, account="s::1", state="CANCELLED"), dict(instance="2", form="a", ord=2, account="s::1", state="SUBMITTED"), dict(instance="3", form="a", ord=3, account="s::1", state="COMPLETED"),
        dict(instance="4", form="b", ord=1, account="s::2", state="CANCELLED"), dict(instance="5", form="c", ord=1, account="s::3", state="ASSIGNED"), dict(instance="6", form="d", ord=1, account="s::4", state="ASSIGNED"), dict(instance="7", form="e", ord=1, state=None),
    )
    acc = spark.createDataFrame([("s::1",), ("s::2",), ("s::3",), ("s::3",)], "key string")
    got = {r.form: (r.answers, r.seen, r["drop"], r.hold) for r in reviews.form_states(df, acc).collect()}
    assert got == {"a": (1, 2, True, False), "b": (0, 1, True, False), "c": (0, 0, False, True), "d": (0, 0, True, True), "e": (0, 0, False, True)}
    assert reviews.form_states(df.limit(0), acc).count() == 0
    queue = spark.createDataFrame([("s::1",), ("s::3",)], "k string")
    assert [r.k for r in reviews.without_pending(queue, reviews.form_states(df, acc), "k").collect()] == ["s::1"]


def test_decisions(spark):
    base = dict(account=" s :: 1 ", recipients=["r1", "r2"], state="COMPLETED", ord=1)
    df = instances(
        spark,
        base | dict(instance="new"), base | dict(instance="old", is_new=False, chosen=["i1", "i2"], ord=2), base | dict(instance="later", is_new=False, chosen=["i1"], ord=3, state="ASSIGNED"), base | dict(instance="nobody", is_new=False, chosen=[]),
        base | dict(instance="bare", account="x"), base | dict(instance="none", recipients=[]), base | dict(instance="null", recipients=None), base | dict(instance="odd", source_type="weird", is_new=False, chosen=["i3"]),
    )
    made = reviews.decisions(df)
    got = {r.instance: (r.account, r.is_new, r.identity_id, r.finished, r.source_type) for r in made.collect()}
    assert set(got) == {"new", "old", "later", "odd"} and got["new"] == ("s::1", True, None, True, "authoritative") and got["old"][2] == "i1" and not got["later"][3]
    assert {(r.identity_id, r.instance) for r in reviews.last_assignments(made).collect()} == {("i1", "old"), ("i3", "odd")}
    rows = spark.createDataFrame([("row2", "i1"), ("row1", "i1")], "row_id string, identity_id string")
    src = spark.createDataFrame([("s", True)], "name string, disables boolean")
    assert {r.instance: (r.effect, r.row_id) for r in routing.applied(made, rows, src).collect()} == {"new": ("emit", None), "old": ("merge", "row1"), "odd": ("create", None)}
    assert {tuple(r) for r in routing.conflicting(made).collect()} == {("s::1", "i1", 2), ("s::1", "i3", 2)}
    assert reviews.decisions(df.limit(0)).count() == 0


def test_pending_and_requests(spark):
    df = instances(spark, dict(instance="1", account="s::1", state="ASSIGNED", recipients=["r"], candidates=" a, b,,", url="u"), dict(instance="2", account="s::2", state="COMPLETED", recipients=["r"], candidates="a"), dict(instance="3", state="ASSIGNED", recipients=["r"], candidates=None, account="s::3"), dict(instance="4", state=None, recipients=["r"], account="s::4"))
    assert {tuple(r) for r in reviews.pending(df, "candidate").collect()} == {("a", "u", "1", "s::1"), ("b", "u", "1", "s::1")}
    assert {tuple(r) for r in reviews.pending(df, "reviewer").collect()} == {("r", "u", "1", "s::1"), ("r", None, "3", "s::3")}
    assert {tuple(r) for r in reviews.pending_counts(reviews.pending(df, "account"), "account").collect()} == {("s::1", 1, 1, 2), ("s::3", 0, 1, 0)}
    m = spark.createDataFrame([("s::1", "x", "b"), ("s::9", "x", "b"), ("s::9", "x", "a")], "account string, source_id string, identity_id string")
    who = spark.createDataFrame([("x", "r"), ("x", "q"), ("x", None)], "source_id string, reviewer string")
    assert {tuple(r) for r in reviews.review_requests(m, who, df).collect()} == {("s::1", "q", "b"), ("s::9", "q", "a,b"), ("s::9", "r", "a,b")}
    rows = spark.createDataFrame([("a", ["candidate", "auto"]), ("r", None), ("z", ["activeReviews"])], "identity_id string, statuses array<string>")
    got = {r.identity_id: (r.statuses, r.reviews) for r in reviews.reconciled(rows, reviews.pending(df, "candidate"), reviews.pending(df, "reviewer")).collect()}
    assert got == {"a": (["auto", "candidate"], []), "r": (["activeReviews"], ["u"]), "z": ([], [])}
    now = F.lit(datetime.datetime(2025, 1, 31))
    assert one(spark, reviews.stale(F.lit(datetime.datetime(2025, 1, 1)), now, 7)) and not one(spark, reviews.stale(F.lit(None).cast("timestamp"), now, 7))


def test_routes(spark):
    cols = "id string, linked boolean, correlated boolean, reviewers int, source_type string, disables boolean, exact long, matched long, peers long"
    rows = [("linked", True, False, 1, "record", None, 1, 1, 1), ("exact", None, None, 1, "authoritative", None, 1, 1, 0), ("match", None, False, 1, None, None, 0, 2, 0), ("peer", None, False, 1, "authoritative", None, None, None, 1), ("peer-record", None, False, 1, "record", None, 0, 0, 1), ("bare", None, False, 0, "orphan", True, 1, 1, 1), ("corr", None, True, 1, "orphan", False, 1, 1, 1), ("none", None, None, 1, None, None, None, None, None)]
    df = spark.createDataFrame(rows, cols)
    got = {r.id: r.outcome for r in routing.routed(df, routing.Toggles(assign_exact=True)).collect()}
    assert got == {"linked": "linked", "exact": "assign", "match": "review", "peer": "defer", "peer-record": "register", "bare": "disable", "corr": "drop", "none": "emit"}
    off = {r.id: r.outcome for r in routing.routed(df, routing.Toggles(defer=False)).collect()}
    assert off["exact"] == "review" and off["peer"] == "emit"
    held = spark.createDataFrame([("a", "disable", None), ("a", "disable", False), ("b", "disable", True), ("c", "emit", False)], "k string, outcome string, disabled boolean")
    assert [r.k for r in routing.disables(held, "k").collect()] == ["a"]
    out = spark.createDataFrame([("a", ["x"], None), ("b", [], ["baseline"]), ("c", None, None)], "k string, accounts array<string>, statuses array<string>")
    assert [r.k for r in routing.without_orphans(out).orderBy("k").collect()] == ["a", "b"]
    auto = routing.automatic(spark.createDataFrame([("s::1", "i1")], "a string, i string"), "a", "i")
    assert report.decision_counts(auto).first()["automatic"] == 1
    assert [tuple(r) for r in routing.correlations(spark.createDataFrame([("k", "i1"), ("l", "i2")], "key string, identity_id string"), spark.createDataFrame([("k", None), ("l", "i2")], "key string, identity_id string")).collect()] == [("k", "i1")]


def test_report_rows(spark):
    rows = spark.createDataFrame([("b", ["matched", "review"], 1), ("a", ["review"], 1), ("c", ["existing-fusion"], 1), ("a", ["baseline", "review"], 2), ("d", [], 1)], "k string, cats array<string>, v int")
    got = [(r.k, r.group, r.place) for r in report.emitted(rows, "k", "cats").orderBy("place").collect()]
    assert got == [("a", "baseline", 1), ("b", "matched", 2), ("c", "existing-fusion", 3)]
    assert [(r.k, r.group) for r in report.emitted(rows, "k", "cats", ["review"]).orderBy("place").collect()] == [("a", "review"), ("b", "review")]
    assert report.emitted(rows, "k", "cats", []).count() == 0
    rep = spark.createDataFrame([("x", True, 1), ("y", True, 1), ("z", True, 0), ("w", False, 2)], "account string, deferred boolean, matches int")
    out = spark.createDataFrame([(["y", None],)], "accounts array<string>")
    assert [(r.key, r.accounts) for r in report.deferred_stubs(rep, out, "accounts").collect()] == [("orphan-deferred:x", ["x"])]


def test_main_account_switches(spark):
    rows = spark.createDataFrame([("e", "s1", 1, 1, "a1", "a2", "Ann", "s2"), ("e", "s2", 2, 1, "a2", None, "Anna", "s2")], "entity string, source string, src_ord int, acct_ord int, account string, mainAccount string, name string, origin_source string")
    maps = [Mapping("mainAccount"), Mapping("name"), Mapping("own", "source", ("name",), "$originSource")]
    rows = rows.withColumn("own", F.lit(None).cast("string"))
    got = mapping.switched_main(rows, "entity", maps, ["src_ord", "acct_ord"], F.lit(False)).first()
    assert (got["mainAccount"], got["name"], got["own"]) == ("a2", "Anna", "Anna")
    old = spark.createDataFrame([("e", "kept", "old", ["h"], 1), ("f", "x", "y", None, 2)], "entity string, uid string, name string, history array<string>, extra int")
    new = spark.createDataFrame([("e", "new", None, [" a ", ""])], "entity string, uid string, name string, history array<string>")
    got = {r.entity: (r.uid, r["name"], r.history, r.extra) for r in mapping.merged_values(old, new, "entity", ["uid", "name", "history"], {"uid": F.lit(True)}, F.col("extra") == 1).collect()}
    assert got == {"e": ("kept", None, ["a"], 1), "f": ("x", "y", None, 2)}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_descendants(spark, seed):
    r = random.Random(seed)
    nodes = [(f"s{s}", f"{k}", str(r.choice([r.randrange(k + 1), k - 1, k + 3])) if k and r.random() < 0.93 else None) for s in range(2) for k in range(60)]
    up = {(s, v): p for s, v, p in nodes}
    df = spark.createDataFrame([(*n, f"{n[1]}", 0) for n in nodes], "s string, v string, p string, l string, size int")
    got = {(x.s, x.v): x for x in hierarchy.hierarchy(df, "s", "v", "p", "l", intervals=True).collect()}
    want = set()
    for s, v, _ in nodes:
        seen, at = [v], v
        while (at := up.get((s, at))) is not None and (s, at) in up and at not in seen:
            seen.append(at)
        ends = at is None or (s, at) not in up
        assert (got[s, v].chain == "ok") == ends
        if ends:
            assert got[s, v].path == "/".join(reversed(seen)) and got[s, v].depth == len(seen) - 1
            want |= {(s, a, v) for a in seen[1:]}
    pairs = hierarchy.below(hierarchy.hierarchy(df, "s", "v", "p", "l", intervals=True), "s", "v").collect()
    assert len(pairs) == len({tuple(x) for x in pairs}) and {tuple(x) for x in pairs} == want
    assert hierarchy.below(hierarchy.hierarchy(df.limit(0), "s", "v", "p", "l", intervals=True), "s", "v").collect() == []

import random

import pytest
from pyspark.sql import functions as F

from mergetide.functions import bulk
from mergetide.functions.similarity import dice, percent
from mergetide.operators import blocking, claims, greedy, mapping, matching, unique
from mergetide.operators.components import components
from mergetide.operators.hierarchy import feed_hierarchy, hierarchy
from mergetide.operators.ordinals import running_number
from mergetide.plans import fusion
from mergetide.sources import scan


def brute_hierarchy(rows):
    parent = {v: p for v, p in rows}
    out = {}
    for v in parent:
        seen, x = [v], v
        while (x := parent.get(x)) in parent and x not in seen:
            seen.append(x)
        if x in parent:
            out[v] = ("", -1, "", "cycle" if x == v else "below")
        else:
            out[v] = (seen[-1], len(seen) - 1, "/".join(reversed(seen)), "ok")
    below = {v: set() for v in parent}
    for v in parent:
        x, seen = parent.get(v), set()
        while x in parent and x not in seen:
            seen.add(x)
            if x != v:
                below[x].add(v)
            x = parent.get(x)
    return {v: (*t[:3], len(below[v]), t[3]) for v, t in out.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_hierarchy_against_brute_force(spark, seed):
    r = random.Random(seed)
    rows = [(f"n{i}", r.choice([None, "gone", f"n{r.randrange(60)}", f"n{max(0, i - 1)}", f"n{max(0, i - 1)}"])) for i in range(60)]
    df = spark.createDataFrame([("s", *x) for x in rows], "s string, v string, p string").withColumn("l", F.col("v"))
    got = {x.v: (x.root_id, x.depth, x.path, x.descendants, x.chain) for x in hierarchy(df, "s", "v", "p", "l").collect()}
    assert got == brute_hierarchy(rows)


def test_hierarchy_cases(spark):
    schema = "record_id string, source_id string, id string, managerId string, modified timestamp, loaded_at timestamp, path string"
    assert feed_hierarchy(spark.createDataFrame([], schema)).collect() == []
    t = __import__("datetime").datetime
    rows = [("a", "s", "01", None, None, None, "x"), ("b", "s", "2", " 1.0", None, t(2020, 1, 1), "x"), ("c", "s", "2", "9", None, None, "x"), ("d", "s", "3", "3", None, None, "x"), ("e", "s", "4", "3", None, None, "x"), ("f", None, "1", None, None, None, "x"), ("g", "s", None, "1", None, None, "x")]
    got = {(x.source_id, x.id): (x.root_id, x.depth, x.path, x.descendants, x.chain) for x in feed_hierarchy(spark.createDataFrame(rows, schema)).collect()}
    assert got == {("s", "01"): ("01", 0, "01", 1, "ok"), ("s", "2"): ("01", 1, "01/2", 0, "ok"), ("s", "3"): ("", -1, "", 1, "cycle"), ("s", "4"): ("", -1, "", 0, "below"), (None, "1"): ("1", 0, "1", 0, "ok")}


def test_components(spark):
    r = random.Random(3)
    edges = [(f"{r.randrange(80):02}", f"{r.randrange(80):02}") for _ in range(60)] + [("00", None), ("zz", "zz")]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a and b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {x.node: x.component for x in components(spark.createDataFrame(edges, "a string, b string"), "a", "b").collect()}
    assert got == {v: min(u for u in root if find(u) == find(v)) for v in root}
    assert components(spark.createDataFrame([], "a string, b string"), "a", "b").collect() == []


def test_mapping(spark):
    rows = [("e", "s1", 1, "b", "[HR] [IT]", None), ("e", "s1", 1, "a", None, " x "), ("e", "s2", 2, "a", "Ops", "y"), (None, "s1", 1, "a", "z", "z"), ("f", "s1", 1, "a", " ", None)]
    df = spark.createDataFrame(rows, "e string, source string, o1 int, o2 string, dept string, nick string").withColumn("name", F.lit(None).cast("string"))
    m = mapping.Mapping
    got = {r.e: r for r in mapping.map_attributes(df, "e", [m("dept", "list"), m("name", "first", ("nick", "dept")), m("nick", "source", (), "s2")], ["o1", "o2"]).collect()}
    assert got["e"].dept == ["HR", "IT", "Ops"] and got["e"].name == "x" and got["e"].nick == "y"
    assert got["f"].dept == [] and got["f"].name is None


@pytest.mark.parametrize("seed", [1, 2])
def test_allocation_is_sequential(spark, seed):
    r = random.Random(seed)
    rows = [(i, i, r.choice(["a", "a1", "a2", "b", None])) for i in range(25)]
    taken = ["a", "b2"]
    want, used = {}, set(taken)
    for k, _, b in rows:
        want[k] = next((v for n in range(5) if b and (v := b + (str(n) if n else "")) not in used), None)
        used.add(want[k])
    got = unique.allocate(spark.createDataFrame(rows, "k long, o long, b string"), "k", "o", "b", spark.createDataFrame([(x,) for x in taken], "value string"), 4)
    assert {x.k: x.value for x in got.collect()} == want


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_leaders_are_sequential(spark, seed):
    r = random.Random(seed)
    edges = {tuple(r.sample(range(30), 2)) for _ in range(40)}
    near = lambda a, b: (a, b) in edges or (b, a) in edges
    want = {}
    for v in range(30):
        want[v] = next((u for u in range(v) if want[u] == u and near(u, v)), v)
    got = greedy.leaders(spark.range(30).withColumnRenamed("id", "v"), spark.createDataFrame(list(edges), "a long, b long"), "v", "a", "b", "v")
    assert {x.v: x.leader for x in got.collect()} == want


def test_deferral_against_every_pair(spark):
    r = random.Random(4)
    rows = [("00", "s", "jonathan smith"), ("01", "s", "jonathan smyth"), ("02", "s", "smith jonathan"), ("03", "s", "jonathan smith phd"), ("04", "s", "x"), ("05", "s", "x"), ("06", "t", "jonathan smith"), ("07", None, "jonathan smith"), ("08", None, "jonathan smith")]
    for i in range(10, 99):
        w = list(r.choice(["anna bergman", "annabel bergmann", "aaaa aa", "ann", "bob", "jonathan smith"]))
        w[r.randrange(len(w))] = r.choice(["", "a", "xy", "nn"])
        rows.append((str(i), r.choice("st"), " ".join("".join(w).split())))
    want = {}
    for i, s, n in rows:
        want[i] = next((j for j, t, m in rows if s and j < i and s == t and want[j] == j and percent(dice(n, m)) >= 75), i)
    got = fusion.deferred(spark.createDataFrame(rows, "id string, source_id string, name string"))
    assert sorted(tuple(x) for x in got.collect()) == sorted(want.items())
    assert want["01"] == want["03"] == "00"


@pytest.mark.parametrize("seed", [1, 2])
def test_exclusive_is_sequential(spark, seed):
    r = random.Random(seed)
    m = {(a, i): r.randrange(4) for a in range(12) for i in r.sample(range(10), 3)}
    want, used = {}, set()
    for a in range(12):
        free = sorted((o, i) for (x, i), o in m.items() if x == a and i not in used)
        if free:
            want[a] = free[0][1]
            used.add(free[0][1])
    df = spark.createDataFrame([(a, i, o) for (a, i), o in m.items()], "a int, i int, o int")
    assert {x.a: x.i for x in greedy.exclusive(df, "a", "i", "a", "o").collect()} == want


def test_running_number(spark):
    df = spark.createDataFrame([("a" if i % 3 else "b", i) for i in range(40)], "g string, o int").repartition(4)
    got = {(x.g, x.o): x.n for x in running_number(df, ["g"], ["o"], "n").collect()}
    for g in "ab":
        assert [got[k] for k in sorted(k for k in got if k[0] == g)] == list(range(1, 1 + sum(k[0] == g for k in got)))
    assert sorted(x.n for x in running_number(df, [], ["o"], "n").collect()) == list(range(1, 41))


def test_blocking_needs_every_present_attribute(spark):
    a = spark.createDataFrame([(1, "john", "rome"), (2, "john", None), (3, None, None)], "a int, n string, c string")
    i = spark.createDataFrame([(7, "jane", "rome"), (8, "john", "york")], "i int, n string, c string")
    got = {(x.a, x.i): x.pos for x in blocking.blocked_pairs(a, i, "a", "i", ["n", "c"]).collect()}
    assert got == {(1, 7): 0, (2, 7): 0, (2, 8): 0}


def test_rules(spark):
    pairs = spark.createDataFrame([(1, 1, "ann", "ann", "x", "x"), (1, 2, "ann", "bob", "x", "x"), (2, 1, "anna", "anne", None, "x"), (3, 1, "john", "john robert doe", "y", "y")], "a int, i int, n_a string, n_i string, c_a string, c_i string")
    rules = [matching.Rule("n", "dice", 60, mandatory=True), matching.Rule("c", "jaro-winkler", 90)]
    got = {(r.a, r.i): r for r in matching.evaluated(pairs, rules, 60.0).collect()}
    assert got[1, 1].exact and got[1, 1].passed and got[1, 1].combined == 100.0
    assert not got[1, 2].passed and got[1, 2].r0 == 0
    assert got[2, 1].r1 is None and got[2, 1].combined == float(percent(2 / 3)) and got[2, 1].passed and not got[2, 1].exact
    gate = {(r.a, r.i): r.r0 for r in matching.scored(pairs, [matching.Rule("n", "lig3", 60)]).collect()}
    assert gate[3, 1] is None and gate[1, 1] == 100
    assert matching.scored(pairs, [matching.Rule("n", "nothing", 60)]).first().r0 is None


def test_rules_take_names_in_their_forms(spark):
    pairs = spark.createDataFrame([(1, 1, "renée o'neil", "renee oneil"), (2, 2, "zoë", "zoe")], "a int, i int, n_a string, n_i string")
    got = {r.a: (r.r0, r.r1) for r in matching.scored(pairs, [matching.Rule("n", "name-matcher", 60), matching.Rule("n", "lig3", 60)]).collect()}
    assert got[1][0] == 100 and got[2] == (100, 100)


def test_caps_and_ranks(spark):
    df = spark.createDataFrame([(1, "a", 1, True, False, 90.0), (1, "b", 2, True, True, 100.0), (1, "c", 3, True, False, 95.0), (1, "d", 4, False, False, 10.0)], "a int, i string, o int, passed boolean, exact boolean, combined double")
    assert [r.i for r in matching.first_candidates(df, "a", "o", 5, stop_at_exact=True).orderBy("o").collect()] == ["a", "b"]
    assert [r.i for r in matching.first_candidates(df, "a", "o", 1).collect()] == ["a"]
    assert [(r.i, r.place) for r in matching.best_candidates(df, "a", "combined", "i", 2).orderBy("place").collect()] == [("b", 1), ("c", 2)]


def test_claims(spark):
    c = spark.createDataFrame([("k", 2, "x", "a"), ("k", 1, "y", "b"), ("k", 1, "z", "a"), (None, 1, "w", "a")], "key string, phase int, owner string, ord string")
    assert [tuple(r) for r in claims.claimed(c, "key", "phase", "owner", "ord").collect()] == [("k", 1, "z")]
    assert [r.key for r in claims.unclaimed(spark.createDataFrame([("k",), ("m",)], "key string"), c, "key").collect()] == ["m"]


def test_filters_are_checked(spark):
    df = spark.range(3)
    assert scan.checked_filter(df, " ").count() == 3
    assert scan.checked_filter(df, "id > 1").count() == 1
    with pytest.raises(Exception):
        scan.checked_filter(df, "nothing > 1")


ODD_NAMES = ["x", "xx", "aaaaaa", "aaaa", "ann", "anna b", "annab", "é", "😀 b", "😀 bc", "jonathan smith", "jonathan smyth", "smith jonathan", "a" * 300, "a" * 280, ""]


def test_counts_of_meetings_make_no_pairs(spark, monkeypatch):
    r = random.Random(5)
    names = ODD_NAMES + ["".join(r.choice("ab é") for _ in range(r.randrange(1, 9))) for _ in range(60)]
    a = spark.createDataFrame([(k, n) for k, n in enumerate([*names, *names[:9], None])] + [(None, "ann"), (0, "x")], "account int, name string")
    i = spark.createDataFrame([(k, n) for k, n in enumerate([*names[::2], "ann", "ann", None])] + [(None, "ann")], "identity int, name string")
    pairs = blocking.blocked_pairs(a, i, "account", "identity", ["name"]).groupBy("account").agg(F.count("*"), F.min("pos"), F.sum("pos"))
    want = sorted(tuple(x) for x in pairs.collect())
    monkeypatch.setattr(blocking, "blocked_pairs", None)
    assert sorted(tuple(x) for x in blocking.counted_meetings(a, i, "account", "identity", "name").collect()) == want
    monkeypatch.setattr(bulk, "ROWS", 3000)
    texts = [n for n in names if n]
    got = [x for p in bulk.trigram_meetings(texts, texts[::-1]) for x in zip(*map(list, p), strict=True)]
    monkeypatch.undo()
    assert sorted(got) == sorted(x for p in bulk.trigram_meetings(texts, texts[::-1]) for x in zip(*map(list, p), strict=True))
    monkeypatch.setattr(blocking, "blocked_pairs", None)
    assert fusion.blocked_counts(spark, "/root/testdata/sf0.001").count() > 0


@pytest.mark.parametrize("threshold", [60, 75])
def test_near_texts_against_every_pair(spark, monkeypatch, threshold):
    r = random.Random(6)
    names = ODD_NAMES + ["".join(r.choice("ab é") for _ in range(r.randrange(1, 9))) for _ in range(60)]
    a = spark.createDataFrame([(k, n) for k, n in enumerate([*names, *names[:9], None])] + [(None, "ann"), (0, "x")], "account int, name string")
    i = spark.createDataFrame([(k, n) for k, n in enumerate([*names[::2], "ann", "ann", None])] + [(None, "ann")], "identity int, name string")
    pairs = blocking.blocked_pairs(a.withColumn("x", F.col("name")), i.withColumn("y", F.col("name")), "account", "identity", ["name"], (["x"], ["y"]))
    want = sorted((p.account, p.identity, p.pos, percent(dice(p.x, p.y))) for p in pairs.collect() if percent(dice(p.x, p.y)) >= threshold)
    monkeypatch.setattr(blocking, "BLOCK", 20)
    got = blocking.with_owners(blocking.near_texts(a, i, "name", threshold), a, i, "account", "identity", "name").select("account", "identity", "pos", "name_dice")
    assert sorted(tuple(x) for x in got.collect()) == want


@pytest.mark.parametrize("name", ["match_dice", "match_scores", "match_capped", "match_blended"])
def test_matches_make_no_blocked_pairs(spark, monkeypatch, name):
    monkeypatch.setattr(blocking, "blocked_pairs", None)
    assert fusion.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0


def test_near_within_blocks(spark):
    from mergetide.session import cut

    r = random.Random(7)
    rows = [(f"{k:03}", r.choice(["s", "t", None]), "".join(r.choice("ab ") for _ in range(r.randrange(1, 9))).strip() or "b") for k in range(150)]
    want = {(x, y) for x, g, n in rows for y, h, m in rows if y < x and g and g == h and percent(dice(n, m)) >= 75}
    got = blocking.near_within(cut(spark.createDataFrame(rows, "id string, g string, name string")), "id", "g", "name", 75, block=20)
    assert {(x.a, x.b) for x in got.collect()} == want


def test_deferral_takes_its_edges_from_blocks(spark, monkeypatch):
    asked, near = [], blocking.near_within
    monkeypatch.setattr(blocking, "near_within", lambda *a: asked.append(a[1:]) or near(*a))
    rows = [("1", "s", "jonathan smith"), ("2", "s", "jonathan smyth"), ("3", "t", "jonathan smith"), ("4", "s", "x")]
    got = fusion.deferred(spark.createDataFrame(rows, "id string, source_id string, name string"))
    assert sorted(tuple(x) for x in got.collect()) == [("1", "1"), ("2", "1"), ("3", "3"), ("4", "4")] and asked == [("id", "source_id", "name", 75)]

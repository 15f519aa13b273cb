import datetime
import random

import pytest
from pyspark.sql import functions as F

from mergetide.llm import addresses, linkage, people, places, survivorship, topn, variants
from mergetide.operators.components import components

T = datetime.datetime
FEED = "record_id string, source_id string, id string, firstName string, lastName string, fullName string, email string, phone string, birthDate string, ssn string, address string, city string, state string, zipCode string, country string, department string, title string, managerId string, modified timestamp, loaded_at timestamp, name string, `key` string"
IDS = "id string, attributes map<string,string>, last string"
ACC = "source_id string, native_identity string, identity_id string, record_id string"


def feed(spark, *rows):
    names = [f.split()[0].strip("`") for f in FEED.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], FEED)


# p4


def brute_top(rows, n):
    best = {}
    for g, i, s in rows:
        if g is not None and i is not None and s is not None and s == s:
            best[g, i] = max(best.get((g, i), s), s)
    out = set()
    for g in {g for g, _ in best}:
        out |= {(g, i) for _, i in sorted((-s, i) for (h, i), s in best.items() if h == g)[:n]}
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_top_n(spark, seed):
    r = random.Random(seed)
    rows = [(r.choice(["a", "a", "a", "b", "c", None]), r.choice(["x", "y", "z", "u", "v", None]), r.choice([1.0, 2.0, 2.0, -0.0, 0.0, None, float("nan")])) for _ in range(300)]
    df = spark.createDataFrame([(*x, "?") for x in rows], "g string, i string, s double, s2 string").repartition(5)
    got = [(x.g, x.i) for x in topn.top_n(df, "g", "s", "i", 3).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_top(rows, 3)


def test_top_n_cases(spark):
    df = spark.createDataFrame([], "g string, i string, s double")
    assert topn.top_n(df, "g", "s", "i", 3).collect() == []
    one = spark.createDataFrame([("a", "x", 1.0)] * 3, "g string, i string, s double")
    assert len(topn.top_n(one, "g", "s", "i", 3).collect()) == 1
    assert topn.top_n(one, "g", "s", "i", 0).collect() == []


# p5


def test_places(spark):
    ref = spark.createDataFrame([(1, "Rushaton", "WA", "US"), (2, "Rushaton", "NC", "US"), (3, "Cranercombe Heights", "AB", "CA")], "place_id int, city string, state string, country string")
    rows = [("exact", "Rushaton", "WA", "US"), ("case", "RUSHATON", "WA", "US"), ("slip", "Rushtaon", "Wash.", "US"), ("tail", "Rushaton (NC)", None, None), ("both", "Rushaton", None, "US"), ("none", "Glyincombe", "WA", "US"), ("fill", "n/a", "WA", "US"), ("null", None, "WA", "US"), ("blank", " ", None, None), ("short", "Cranercmbe Hts", "Alberta", "CAN"), ("long", "x" * 5000, "WA", "US"), (None, "rushaton", "NC", "US")]
    df = spark.createDataFrame([(*r, 9) for r in rows], "record_id string, city string, state string, country string, place_id int")
    got = {r.record_id: r.place_id for r in places.map_places(df, ref).collect()}
    assert got == {"case": 1, "slip": 1, "tail": 2, "both": 0, "none": 0, "fill": 0, "blank": 0, "short": 3, "long": 0, None: 2}
    assert {r.place_id for r in places.map_places(df, ref.limit(0)).collect()} == {0}
    assert places.map_places(df.limit(0), ref).collect() == []


def test_pigeonhole_misses_nothing(spark):
    r = random.Random(5)
    ref = [(k, "".join(r.choice("abcd") for _ in range(r.randrange(4, 14))), "WA", "US") for k in range(1, 30)]
    typed = []
    for k in range(150):
        w = list(r.choice(ref)[1])
        for _ in range(r.randrange(4)):
            at = r.randrange(len(w) + 1)
            w[at : at + r.randrange(2)] = [r.choice("abcd")] * r.randrange(2)
        typed.append((str(k), "".join(w) or "a", "WA", "US"))

    def lev(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    want = {}
    for k, w, _, _ in typed:
        if any(w == x[1] for x in ref):
            continue
        d = [(lev(w, x[1]), x[0]) for x in ref if lev(w, x[1]) <= (places.EDITS_LONG if len(x[1]) >= places.LONG else places.EDITS)]
        near = [p for dist, p in d if dist == min(d)[0]]
        want[k] = near[0] if len(near) == 1 else 0
    got = places.map_places(spark.createDataFrame(typed, "record_id string, city string, state string, country string"), spark.createDataFrame(ref, "place_id int, city string, state string, country string"))
    assert {x.record_id: x.place_id for x in got.collect()} == want


# p6


@pytest.mark.parametrize(
    ("text", "want"),
    [("8100 Kestrelwash Pl", ("8100", "", "", "kestrelwash", "place")), ("Ravenfold Sq 2952", ("2952", "", "", "ravenfold", "square")), ("No 3B, 5687 North Masongreen Ave.", ("5687", "3b", "n", "masongreen", "avenue")), ("c/o Reception, apartment 21C, 457 No. Pebblecombe Court", ("457", "21c", "n", "pebblecombe", "court")), ("Heronwood Circle #6656 - Ste 21", ("6656", "21", "", "heronwood", "circle")), ("3949 flintstead rd, North Pemandale", ("3949", "", "", "flintstead", "road")), ("77 5th Ave", ("77", "", "", "5th", "avenue")), ("12 Old Mill Rd rushaton", ("12", "", "", "oldmill", "road")), ("Apt B, 12 N Main St", ("12", "b", "n", "main", "street")), ("", (None, "", "", None, "")), (None, (None, "", "", None, ""))],
)
def test_read_address(text, want):
    assert addresses.read_address(text) == want


def test_same_places(spark):
    rows = [("a", "12 Oakmere Street", "Rushaton", "WA", "10101"), ("b", "Oakmere Str 12", "RUSHATON", "WA", None), ("c", "12 Oakmree St", "Rushaton", None, "10101-1234"), ("d", "12 Oakmere Street Apt 4", "Rushaton", "WA", "10101"), ("e", "14 Oakmere Street", "Rushaton", "WA", "10101"), ("f", "12 Oakmere Street", "Glyelford", "TN", "20202"), ("g", "12 Oakmere Lane", "Rushaton", "WA", "10101"), ("h", "12 Oakmere Street", "Rushaton", "WA", "10101"), ("i", None, "Rushaton", "WA", "10101"), ("j", "", None, None, None), ("k", "x" * 3000, "Rushaton", "WA", "1"), (None, "12 Oakmere Str.", "Rushaton", "WA", "10101")]
    df = spark.createDataFrame([(*r, "?") for r in rows], "record_id string, address string, city string, state string, zipCode string, variant string")
    got = sorted(tuple(r) for r in addresses.same_places(df).collect())
    assert got == [("a", "b"), ("a", "c"), ("b", "c"), ("b", "h"), ("c", "h")]
    assert addresses.same_places(df.limit(0)).collect() == []
    assert sorted(tuple(r) for r in addresses.same_places(df.union(df)).collect()) == got


@pytest.mark.parametrize(
    ("one", "two"),
    [("12 Old Mill Road", "12 Old Church Road"), ("4 San Pedro Ave", "4 San Mateo Ave"), ("9 Martin Luther King Blvd", "9 Martin Street"), ("55 Lake Shore Drive", "55 Lake View Court"), ("77 5th Ave", "77 South Ave"), ("77 5th Ave", "77 6th Ave"), ("8 Kestrelwash Road", "8 Kestrelburn Road"), ("8 Oak Street Apt B", "8 Oak Street Apt C")],
)
def test_other_streets(spark, one, two):
    df = spark.createDataFrame([("a", one, "Rushaton", "WA", "10101"), ("b", two, "Rushaton", "WA", "10101")], "record_id string, address string, city string, state string, zipCode string")
    assert addresses.same_places(df).collect() == []


def test_candidates_lose_no_pair(spark):
    # Against all pairs: whatever reaches the cosine, is compatible and shares a place comes out.
    r = random.Random(3)
    street, towns = ["kestrelwash", "kestrelburn", "oldmill", "oldchurch", "main", "mainline", "oakmere"], ["rushaton", "rushaten", "glyelford", None]
    slip = lambda w: (w[: (k := r.randrange(len(w)))] + r.choice(["", "a", "x"]) + w[k + 1 :]) if w and r.random() < 0.4 else w
    rows = []
    for k in range(160):
        rows.append((k, str(r.randrange(1, 3)), "", "", slip(r.choice(street)), r.choice(["", "road", "lane"]), r.choice(towns), r.choice(["wa", None]), r.choice(["10101", "10110", "20202", None])))
    fields = ["variant", *addresses._FIELDS]
    v = spark.createDataFrame(rows, "variant long, house string, unit string, direction string, name string, kind string, town string, st string, zip string")
    weights = addresses.rarities(v)
    keys = {}
    for x in addresses.town_keys(v.where("town is not null").groupBy("town").agg(F.count("*").alias("n"))).collect():
        keys.setdefault(x.town, set()).add(x.place)
    both = [(dict(zip(fields, x)), dict(zip(fields, y))) for x in rows for y in rows if x[0] < y[0] and x[1] == y[1]]
    ok = {(x.a, x.b) for x in spark.createDataFrame([(a, b) for a, b in both], "a struct<variant:long,direction:string,name:string,kind:string,st:string>, b struct<variant:long,direction:string,name:string,kind:string,st:string>").where(addresses._compatible("a", "b")).select(F.col("a.variant").alias("a"), F.col("b.variant").alias("b")).collect()}
    want = set()
    for a, b in both:
        lacks = (not a["town"] or not b["town"]) and (not a["zip"] or not b["zip"]) and all(not x["town"] or not x["zip"] for x in (a, b))
        place = bool(keys.get(a["town"], set()) & keys.get(b["town"], set())) or bool(a["zip"] and b["zip"] and sorted(a["zip"]) == sorted(b["zip"])) or bool(lacks and a["st"] and a["st"] == b["st"])
        part = lambda x: (x["name"], x["town"], x["zip"])
        if place and (a["variant"], b["variant"]) in ok and addresses.cosine(part(a), part(b), weights) >= addresses.COSINE:
            want.add((a["variant"], b["variant"]))
    got = {(x.va, x.vb) for x in addresses.near_variants(v).collect()}
    assert got == want and len(want) > 100


def test_copies_make_no_links(spark):
    df = spark.createDataFrame([(f"c{k:03}", "12 Oakmere Street", "Rushaton", "WA", "10101") for k in range(50)] + [("d", "12 Oakmere St", "Rushaton", "WA", None)], "record_id string, address string, city string, state string, zipCode string")
    members, links = addresses.locations(df)
    assert links.count() == 1 and members.count() == 51 and members.select("spelling").distinct().count() == 2
    assert addresses.same_places(df).count() == 50


# p7


def test_survivors(spark):
    rows = [
        dict(record_id="1", source_id="s1", id="1", email="a@x.example", phone="555-01", title="Buyer", modified=T(2024, 1, 1)),
        dict(record_id="2", source_id="s2", id="1", email="n/a", phone="(920) 555-8020", title="see HR", modified=T(2025, 1, 1)),
        dict(record_id="3", source_id="s2", id="2", email="@x.example", phone="111-111-1111", title="Bxyer", modified=T(2024, 1, 1)),
        dict(record_id="4", source_id="s1", id="9", email="b@x.example"),
        dict(record_id="5", source_id="s1", id="7", email="c@x.example"),
    ]
    f = feed(spark, *rows)
    managed = spark.createDataFrame([("s1", "1", "i", "z"), ("s2", "1", "i", "z"), ("s2", "2", "i", "z"), ("s1", "9", "j", "z"), ("s1", "7", None, "z")], ACC)
    linked = survivorship.correlated(f, managed).withColumn("priority", F.when(F.col("source_id") == "s2", 1).otherwise(2))
    got = {(r.identity_id, r.field_name): r.record_id for r in survivorship.survivors(linked, "identity_id", "record_id", "modified", "priority", {c: g(F.col(c)) for c, g in survivorship.REAL.items()}).collect()}
    assert got == {("i", "email"): "1", ("i", "phone"): "2", ("i", "title"): "3"}
    assert survivorship.survivors(linked.limit(0), "identity_id", "record_id", "modified", "priority", {"email": F.lit(True)}).collect() == []


# p1 and p3


def test_read_person():
    p = people.read_person("Robert", "van dér O'Ilemire", None, "mailto:bob.vanderoilemire77@x.example;", "03/04/1980")
    assert p["given"] == ["robert"] and p["last"] == "vanderoilemire" and p["num"] == "77" and p["dates"] == ["1980-03-04", "1980-04-03"]
    assert people.read_person(None, None, "Valebova, Henrietta", None, None)["last"] == "valebova"
    assert people.read_person("Fox", "Susan", None, "pixel123@x.example", "1970-01-01")["dates"] == []
    assert people.read_person(None, None, None, None, None)["forms"] == []
    assert people.read_person("x" * 9000, "", "", "", "")["last"] == ""


def test_given_names_by_share(spark):
    typed = spark.range(20000).select(F.when(F.col("id") < 5, "Pamella").when(F.col("id") < 400, "Pamela").otherwise("Sanjay").alias("firstName"), F.when(F.col("id") == 0, "Grenafgard").alias("lastName"))
    for _ in range(2):
        known = people.vocabulary(typed)
        assert "pamella" not in known and {"pamela", "sanjay"} <= known and people.given_names("pamella", known) == ("pamela",)
        typed = typed.union(typed)
    names = ["".join("bdgkmprtvz"[int(d)] + "ao"[int(d) % 2] for d in f"{k * 7919 % 10007:05}") for k in range(1100)]
    assert people.vocabulary(spark.createDataFrame([(w, None) for w in names * 4], "firstName string, lastName string")) == {people.fold(w) for w in names}


def people_tables(spark):
    rows = [
        dict(record_id="r1", source_id="s", id="1", firstName="Bob", lastName="Grenafgard", fullName="Bob Grenafgard", email="r.grenaphgard@x.example", birthDate="28/03/1955"),
        dict(record_id="r2", source_id="s", id="2", firstName="Ursula", lastName="Kelonier", fullName="Ursula Kelonier", email=None, birthDate="1971-01-22"),
        dict(record_id="r3", source_id="s", id="3", firstName="Robert", lastName="Grenaphgard", fullName="Robert Grenaphgard", birthDate="1999-09-09"),
        dict(record_id="r4", source_id="s", id="1", firstName=None, lastName="Grenaphgard", fullName=None, email="n/a", birthDate=None),
        dict(record_id="r5", source_id="t", id="5"),
        dict(record_id="r6", source_id="t", id="6", firstName="Robert", lastName="Grenaphgard", birthDate="1955-03-28"),
    ]
    ids = [("i1", {"firstname": "Robert", "lastname": "Grenaphgard", "displayName": "Robert Grenaphgard", "birthDate": "1955-03-28"}, "?"), ("i2", {"displayName": None}, "?"), ("i3", None, "?")]
    return feed(spark, *rows), spark.createDataFrame(ids, IDS), spark.createDataFrame([("t", "6", "i1", "?")], ACC)


def test_linkage(spark):
    f, ids, acc = people_tables(spark)
    got = {r.record_id: r.identity_id for r in linkage.link_feed(f, ids, acc).collect()}
    assert got == {"r1": "i1", "r4": "i1"}
    conf = [r.confidence for r in linkage.link_feed(f.union(f), ids, acc).collect()]
    assert len(conf) == 2 and all(0 < c <= 1 for c in conf)
    assert linkage.link_feed(f.limit(0), ids, acc).collect() == []
    assert linkage.link_feed(f, ids.limit(0), acc.limit(0)).collect() == []


def test_ties_reach_as_far_as_they_go(spark):
    # A chain: each record shares its account with the record before and its security number with the one after.
    rows = [dict(record_id="c00", source_id="s", id="0", firstName="Robert", lastName="Grenaphgard", birthDate="1955-03-28", ssn="900000001")]
    rows += [dict(record_id=f"c{k:02}", source_id="s", id=str(k // 2 * 2) if k % 2 else str(k), firstName=None, lastName="Grenaphgard", ssn=f"90000000{(k + 1) // 2 + 1}" if k % 2 else f"90000000{k // 2 + 1}") for k in range(1, 12)]
    got = {r.record_id: r.identity_id for r in linkage.link_feed(feed(spark, *rows), people_tables(spark)[1], people_tables(spark)[2]).collect()}
    assert got == {f"c{k:02}": "i1" for k in range(12)}


@pytest.mark.parametrize("seed", [1, 2])
def test_rare_bound_loses_no_link(spark, monkeypatch, seed):
    # Forty known persons of one name: records are told apart by dates, mailboxes and their numbers, whether or not the name itself makes pairs.
    r = random.Random(seed)
    day = lambda k: f"19{50 + k % 45}-{1 + k % 12:02}-{1 + k % 28:02}"
    ids = [(f"i{k:02}", {"firstname": r.choice(["Robert", "Bob"]), "lastname": r.choice(["Grenaphgard", "Grenafgard"]), "birthDate": r.choice([day(k), None]), "email": f"robert.grenaphgard{r.choice(['', k])}@x.example"}, "?") for k in range(40)]
    rows = []
    for n in range(80):
        k = r.randrange(40)
        near = day(k)[:8] + "28"
        rows.append(dict(record_id=f"r{n:02}", source_id="s", id=str(n), firstName=r.choice(["Robert", "Bob", "R", "Ursula"]), lastName=r.choice(["Grenaphgard", "Grenafgard"]), birthDate=r.choice([day(k), near, None]), email=r.choice([None, f"robert.grenaphgard{k}@y.example", "robert.grenaphgard@y.example"])))
    f, known, none = feed(spark, *rows), spark.createDataFrame(ids, IDS), spark.createDataFrame([], ACC)
    got = {tuple(x)[:2] for x in linkage.link_feed(f, known, none).collect()}
    # Without the bound the name makes all pairs, but then near dates aren't keys of their own, and such pairs may be pruned as too light.
    monkeypatch.setattr(linkage, "RARE", 1 << 20)
    want = {tuple(x)[:2] for x in linkage.link_feed(f, known, none).collect()}
    assert want <= got and len(want) > 10


def test_neighbours_decide_between_namesakes(spark):
    # Two persons of one name and no date; the second account of the one whose mailbox is known is told by the phone both accounts have.
    ids = [("i1", {"firstname": "Robert", "lastname": "Grenaphgard", "email": "robert.grenaphgard77@x.example"}, "?"), ("i2", {"firstname": "Robert", "lastname": "Grenaphgard"}, "?")]
    rows = [dict(record_id="a", source_id="s", id="1", firstName="Robert", lastName="Grenaphgard", email="robert.grenaphgard77@y.example", phone="(920) 555-8020"), dict(record_id="b", source_id="s", id="2", firstName="Robert", lastName="Grenafgard", phone="920 555 8020"), dict(record_id="c", source_id="s", id="3", firstName="Robert", lastName="Grenafgard")]
    got = {x.record_id: (x.identity_id, x.confidence) for x in linkage.link_feed(feed(spark, *rows), spark.createDataFrame(ids, IDS), spark.createDataFrame([], ACC)).collect()}
    assert got["a"][0] == got["b"][0] == "i1" and "c" not in got and got["a"][1] > 0.5


def test_variants(spark):
    f, ids, acc = people_tables(spark)
    got = {tuple(r) for r in variants.name_variants(f, ids, acc).collect()}
    assert ("i1", "r1") in got and ("r1", "r4") in got and not any("r3" in p or "r2" in p or "r6" in p for p in got)
    assert variants.name_variants(f.limit(0), ids.limit(0), acc.limit(0)).collect() == []


def groups_of(spark, rows):
    """The clusters of (key, first, last, email, born), as a set of sets."""
    df = spark.createDataFrame(rows, "key string, f string, l string, m string, b string")
    none = F.lit(None).cast("string")
    p = df.withColumn("p", people.read_people(F.col("f"), F.col("l"), none, F.col("m"), F.col("b"))).select("key", "p.*")
    p = variants.cut(p.withColumn("reading", people.reading()))
    out = {}
    for r in variants.cluster(p, spark.createDataFrame([], "key string, anchor long")).distinct().collect():
        out.setdefault(r.component, set()).add(r.key)
    return {frozenset(x) for x in out.values()}


def test_hot_rare_name_without_dates(spark):
    rows = [(f"k{i:03}", "Robert" if i % 2 else "Bob", "Grenaphgard", None, None) for i in range(70)]
    assert groups_of(spark, rows) == {frozenset(r[0] for r in rows)}


@pytest.mark.parametrize("seed", [1, 2])
def test_common_bound_changes_no_cluster(spark, monkeypatch, seed):
    r = random.Random(seed)
    rows = []
    for i in range(150):
        f, l = r.choice(["Robert", "Bob", "R", "Roberta", "Ursula", None]), r.choice(["Grenaphgard", "Grenafgard", "Grenaphgart", "Kelonier", "Kelonyer"])
        box = r.choice([None, None, f"robert.{l.lower()}", f"ursula.{l.lower()}", f"r.{l.lower()}", f"robert.{l.lower()}{r.choice([7, 8])}", "pixel", f"pixel{i}"])
        rows.append((f"k{i:03}", f, l, box and box + "@x.example", r.choice([None, None, None, f"19{r.randrange(50, 99)}-0{r.randrange(1, 10)}-1{r.randrange(10)}"]) if l[0] == "K" else r.choice([None, None, "1955-03-28"])))
    monkeypatch.setattr(variants, "COMMON", 1 << 20)
    want = groups_of(spark, rows)
    monkeypatch.setattr(variants, "COMMON", 4)
    assert groups_of(spark, rows) == want and len(want) > 1


def test_nothing_is_asked_within_an_account(spark, monkeypatch):
    # Deliveries of one account are one person already: they make no edge, and still are variants of one another and of who is linked to any of them.
    edges = []
    monkeypatch.setattr(variants, "components", lambda e, a, b: edges.append(e.count()) or components(e, a, b))
    rows = [dict(record_id=f"r{k}", source_id="s", id="1", firstName=n, lastName="Grenafgard", fullName=f"{n} Grenafgard", birthDate="1955-03-28") for k, n in enumerate(["Bob", "Robert", "Rob"])]
    got = variants.name_variants(feed(spark, *rows), spark.createDataFrame([], IDS), spark.createDataFrame([], ACC)).collect()
    assert sorted(tuple(r) for r in got) == [("r0", "r1"), ("r0", "r2"), ("r1", "r2")] and edges == [0]
    rows.append(dict(record_id="r3", source_id="t", id="7", firstName="Bobby", lastName="Grenaphgard", fullName="Bobby Grenaphgard", birthDate="1955-03-28"))
    got = variants.name_variants(feed(spark, *rows), spark.createDataFrame([], IDS), spark.createDataFrame([], ACC)).collect()
    assert len(got) == 6 and edges[1] == 1


def test_a_repeated_key_is_one_record(spark):
    # Two rows of one key, of different accounts and persons by what they say: who is linked to either is linked to the key.
    r = lambda key, account, name, born: dict(record_id=key, source_id="s", id=account, firstName=name, lastName="Kelonier", fullName=f"{name} Kelonier", birthDate=born)
    rows = [r("a", "1", "Robert", "1955-03-28"), r("a", "2", "Ursula", "1971-01-22"), r("b", "3", "Bob", "1955-03-28"), r("c", "4", "Ursula", "22/01/1971")]
    got = {tuple(x) for x in variants.name_variants(feed(spark, *rows), spark.createDataFrame([], IDS), spark.createDataFrame([], ACC)).collect()}
    assert {("a", "b"), ("a", "c"), ("b", "c")} == got


def test_agreements_are_computed_once(spark):
    pairs = spark.createDataFrame([("1", "ab", "abc"), ("2", "ab", "ab")], "key string, a string, b string").repartition("key")
    df = people.once(pairs, "e", {"edits": F.levenshtein("a", "b")}).where("e.edits > 0").select("key", (F.col("e.edits") * F.col("e.edits")).alias("n"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("levenshtein(") == 1
    assert [tuple(r) for r in df.collect()] == [("1", 1)]

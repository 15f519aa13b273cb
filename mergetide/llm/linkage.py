"""Problem 1: records and known identities without a common key, by collective linkage in a graph.

Every record and every known person has keys: a date of birth with the start of a surname's code, a surname's code with a given name, a
mailbox, a number of a mailbox, and so on. Two that share a key are joined by an edge, weighted by how rare the keys they share are among
the known persons; edges much weaker than a record's best are pruned (meta-blocking). What is left is scored by how the values agree.
Then neighbours count: records and known rows that share a rare attribute among themselves (deliveries of one account, a mailbox, a phone or
security number) raise each other's scores: a pair of record and identity gains by how sure its neighbours are of that identity, and what becomes
sure by that raises its own neighbours in turn, until no score changes any more.

Accounts that are already correlated stand beside their identity as further accounts of what is known about the person.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mergetide.llm.people import COMPARED, NAME_ONLY, VALUES, evidence, feed_people, identity_people, near_keys, once, reading, shared_keys, vocabulary
from mergetide.llm.survivorship import correlated
from mergetide.session import BROADCAST_ROWS, cut, ship
from mergetide.session import told as count
from mergetide.sources import read_table

#: A key of a name alone makes its pairs if at most so many known persons bear it. That loses none: such a pair is accepted by the name alone only where at
#: most three bear it, else it needs a date of birth, a mailbox or its number, and then it also shares a key that joins the name with that. So this only
#: saves work, from PLAIN on.
RARE = 24
#: A name that so many bear adds nothing to the weight of an edge, and one that fewer bear by how much fewer.
PLAIN = 24
#: Least score of a link, and how far the next identity must be behind.
ACCEPT, MARGIN = 8.0, 1.5
#: Edges lighter than this part of a record's heaviest are pruned.
PRUNE = 0.3
#: What a pair gains, at most, by a neighbour that is sure of its identity.
NEIGHBOUR = 6.0
SCORE = {
    "surname": {3: 4.0, 2: 3.0, 0: -2.0}, "given": {3: 2.0, 2: 1.5, 1: 1.0, 0: -5.0}, "born": {3: 6.0, 2: 3.0, 0: -5.0}, "number": {3: 4.0, 0: -4.0}, "box": {4: 8.0, 3: 2.0},
}


def score(e: dict[str, Column], borne: Column) -> Column:
    """The sum of what each agreement says, and of how few known persons bear the name (``borne``)."""
    parts = [reduce(lambda w, kv: w.when(e[n] == kv[0], kv[1]), v.items(), F.when(e[n].isNull(), 0.0)).otherwise(0.0) for n, v in SCORE.items()]
    return reduce(lambda x, y: x + y, parts) + F.when(borne <= 1, 2.0).when(borne <= 3, 1.0).otherwise(0.0)


def candidates(records: DataFrame, known: DataFrame) -> DataFrame:
    """(reading, alias, identity_id, borne): edges between readings of records and of known persons, pruned by weight.

    Both have ``reading`` and the fields of read_people; what says the same is looked up once. Bearers of a name that more than RARE known persons have
    get keys of near dates too, in place of the pairs of the name alone. ``borne``: how many known persons bear the name that both share, null if
    it is not told by a key.
    """
    def keyed(df: DataFrame, keys: Column, *ids: str) -> DataFrame:
        return df.select(*ids, F.explode(keys).alias("x")).select(*ids, F.col("x.t").isin(NAME_ONLY).alias("name"), "x.k")

    named = F.expr("flatten(transform(codes, x -> transform(initials, i -> xxhash64('I', x, i))))")
    hot = cut(known.select("identity_id", F.explode(named).alias("k")).distinct().groupBy("k").agg(F.count("*").alias("n")).where(F.col("n") > RARE).select("k"))

    def near(df: DataFrame, *ids: str) -> DataFrame:
        few = df.where("size(dates) > 0").select(*ids, "codes", "initials", "dates", F.explode(named).alias("k")).join(hot, "k", "left_semi")
        return keyed(few, near_keys(), *ids)

    n = known.agg(F.greatest(F.approx_count_distinct("identity_id", 0.01), F.lit(1)).alias("n")).first()["n"]
    # All that follows by key needs one shuffle of either side.
    kn = keyed(known, shared_keys(), "alias", "identity_id").unionByName(near(known, "alias", "identity_id")).repartition("k").distinct()
    # How many known persons have a key: their number in its order, at its end. So the rows are sorted by key once, for this and for the join.
    ranked = kn.withColumn("df", F.dense_rank().over(Window.partitionBy("k").orderBy("identity_id")))
    kn = ranked.withColumn("df", F.max("df").over(Window.partitionBy("k")))
    weight = F.when(F.col("name"), F.greatest(F.log(PLAIN / F.col("df")), F.lit(0.0))).otherwise(F.log1p(n / F.col("df")))
    use = kn.where(~F.col("name") | (F.col("df") <= RARE)).select("k", "alias", "identity_id", weight.alias("w"), F.when(F.col("name"), F.col("df")).cast("int").alias("borne"))
    mine = keyed(records, shared_keys(), "reading").unionByName(near(records, "reading")).select("k", "reading").repartition("k").distinct()
    edges = mine.join(use, "k").groupBy("reading", "alias", "identity_id").agg(F.sum("w").alias("weight"), F.min("borne").alias("borne"))
    best = F.max("weight").over(Window.partitionBy("reading"))
    return edges.withColumn("best", best).where(F.col("weight") >= PRUNE * F.col("best")).select("reading", "alias", "identity_id", "borne")


def best_of(scored: DataFrame) -> DataFrame:
    """(key, identity_id, score): a record's best identity, if it is good enough and well ahead of the next."""
    per = scored.repartition("key").groupBy("key", "identity_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("key").orderBy(F.desc("score"), F.desc("identity_id"))
    top = per.withColumn("n", F.row_number().over(w)).withColumn("behind", F.coalesce(F.lead("score").over(w), F.lit(-99.0)))
    return top.where((F.col("n") == 1) & (F.col("score") >= ACCEPT) & (F.col("score") - F.col("behind") >= MARGIN)).select("key", "identity_id", "score")


def sureness(score: Column) -> Column:
    """0 to 1, rising with the score."""
    return 1 / (1 + F.exp(-(score - ACCEPT + 2) / 2))


def raised(sure: DataFrame, scored: DataFrame, records: DataFrame, known: DataFrame, ties: list[str]) -> DataFrame:
    """(key, identity_id, score): ``sure``, and what the neighbours' scores raise to that until no score changes.

    A tie that several share supports an identity by the greatest sureness among its members, if all those that are sure of one mean the same. In every
    round a pair of an open record and an identity that one of its ties supports gains NEIGHBOUR times that sureness on top of its own score, which is that of
    its values, whether or not an edge had brought the two together; what is good enough then supports its own ties. An identity that is once sure
    stays, and there are finitely many, so this ends; each round only goes through what the round before changed.
    """
    tied = lambda df, *ids: df.select(*ids, F.explode(F.filter(F.array(*[F.when(F.col(t).isNotNull(), F.xxhash64(F.lit(t), t)) for t in ties]), lambda x: x.isNotNull())).alias("tie"))
    mine = records.select("key", *ties).join(sure.select("key", "identity_id", "score"), "key", "left").withColumn("conf", sureness(F.col("score")))
    mine = cut(tied(mine, "key", "identity_id", "conf"))
    both = [F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("conf").alias("conf")]
    said = mine.where("identity_id is not null").select("tie", "identity_id", "conf").unionByName(tied(known.withColumn("conf", F.lit(1.0)), "identity_id", "conf").select("tie", "identity_id", "conf"))
    open_ = mine.where("identity_id is null").select("key", "tie").distinct()
    told = said.select("tie", F.col("identity_id").alias("lo"), F.col("identity_id").alias("hi"), "conf").groupBy("tie").agg(*both)
    told = cut(told.join(open_.select("tie").distinct(), "tie", "left_semi"))
    out, fresh, e = sure, told, evidence()
    while True:
        heard = open_.join(fresh.where("lo = hi").select("tie", F.col("lo").alias("identity_id"), "conf"), "tie").groupBy("key", "identity_id").agg(F.max("conf").alias("conf"))
        heard = cut(heard.join(out.select("key"), "key", "left_anti"))
        if not count(heard):
            return out
        # Few hear anything, and then their values are found where they are.
        few = F.broadcast(heard) if count(heard) <= BROADCAST_ROWS else heard
        ours = records.select("key", F.struct(*COMPARED).alias("a")).join(few.select("key").distinct(), "key", "left_semi").groupBy("key").agg(F.first("a").alias("a"))
        theirs = known.select("identity_id", F.struct(*COMPARED).alias("b")).join(few, "identity_id")
        apart = theirs.join(ours, "key").groupBy("key", "identity_id", "conf").agg(*[F.max(e[n]).alias(n) for n in ("surname", "given", "born", "number")])
        # Nothing that a neighbour says outweighs a plain contradiction in every alias of the identity.
        fits = apart.where("coalesce(given, 1) > 0 and (surname > 0 or coalesce(born, 0) > 0) and coalesce(number, 1) > 0 and coalesce(born, 1) > 0")
        part = lambda n: reduce(lambda w, kv: w.when(F.col(n) == kv[0], kv[1]), SCORE[n].items(), F.when(F.col(n).isNull(), 0.0)).otherwise(0.0)
        fits = cut(fits.select("key", "identity_id", (part("surname") + part("given") + part("born") + part("number")).alias("base"), (NEIGHBOUR * F.col("conf")).alias("gain")))
        gains = F.broadcast(fits) if count(fits) <= BROADCAST_ROWS else fits
        own = scored.join(gains.select("key").distinct(), "key", "left_semi").join(gains.drop("base"), ["key", "identity_id"], "left")
        own = own.select("key", "identity_id", (F.col("score") + F.coalesce("gain", F.lit(0.0))).alias("score"))
        new = cut(best_of(own.unionByName(fits.select("key", "identity_id", (F.col("base") + F.col("gain")).alias("score")))))
        if not count(new):
            return out
        out = out.unionByName(new)
        more = open_.join(new.withColumn("conf", sureness(F.col("score"))), "key").select("tie", F.col("identity_id").alias("lo"), F.col("identity_id").alias("hi"), "conf")
        told = cut(told.withColumn("new", F.lit(False)).unionByName(more.withColumn("new", F.lit(True))).groupBy("tie").agg(*both, F.max("new").alias("new")), told)
        fresh = told.where("new")


def link(records: DataFrame, known: DataFrame, ties: list[str]) -> DataFrame:
    """(key, identity_id, confidence): the known person that each record is of, if one can be told.

    ``records``: key, reading (a number for all that a record says), the fields of read_people, and ``ties``, columns that only records of one person
    share; ``known``: alias, identity_id, reading, the fields of read_people, and ties (null where there is none). Records with a null key are left
    out; records that say nothing get no link; a repeated key is one record; empty tables give no links. confidence: 0 to 1, rising with the score.
    """
    records = records.where("key is not null").select("key", "reading", *VALUES, *ties)
    known = known.withColumn("alias", F.xxhash64("identity_id", "reading"))
    edges = cut(candidates(records, known))
    b = known.select("alias", F.struct(*COMPARED).alias("b")).groupBy("alias").agg(F.first("b").alias("b"))
    a = records.select("key", "reading", F.struct(*COMPARED).alias("a"))
    scored = once(edges.join(a, "reading").join(b, "alias"), "e", evidence())
    scored = once(scored, "s", {"score": score({n: F.col(f"e.{n}") for n in SCORE}, F.coalesce("borne", F.lit(PLAIN + 1)))})
    scored = cut(scored.select("key", "identity_id", "s.score").where("score > 0"))
    sure = cut(best_of(scored))
    return raised(sure, scored, records, known, ties).select("key", "identity_id", sureness(F.col("score")).alias("confidence"))


def _digits(c: str, n: int) -> Column:
    d = F.regexp_replace(F.col(c), r"\D", "")
    return F.when((F.length(d) >= n) & ~d.rlike(r"^1?(\d)\1+$"), F.substring(d, -n, n))


def link_feed(feed: DataFrame, identities: DataFrame, managed: DataFrame) -> DataFrame:
    """(record_id, identity_id, confidence) of the uncorrelated rows of identity_feed."""
    ship(feed.sparkSession)
    use = feed.select("record_id", "source_id", "id", "firstName", "lastName", "fullName", "email", "birthDate", "phone", "ssn")
    known_names = vocabulary(feed)
    people = feed_people(correlated(use, managed), known_names).withColumn("reading", reading())
    household = F.concat(_digits("phone", 10), F.lit("|"), F.get("initials", F.lit(0)).cast("string"))
    # A mailbox of the person's name without a number may be anyone's of that name, and a phone anyone's of a household.
    people = people.select("record_id", "identity_id", "reading", *VALUES, F.xxhash64("source_id", "id").alias("account"), household.alias("phone"), _digits("ssn", 9).alias("ssn"), F.when(F.coalesce(F.col("num") != "", F.lit(True)), F.col("box")).alias("mail"))
    people = cut(people)
    ties = ["account", "mail", "phone", "ssn"]
    who = cut(identity_people(identities, known_names).withColumn("reading", reading()).withColumn("mail", F.when(F.coalesce(F.col("num") != "", F.lit(True)), F.col("box"))))
    known = people.where("identity_id is not null").join(who.select(F.col("id").alias("identity_id")), "identity_id", "left_semi").drop("record_id")
    known = known.unionByName(who.withColumnRenamed("id", "identity_id"), allowMissingColumns=True)
    return link(people.where("identity_id is null").withColumnRenamed("record_id", "key"), known, ties).withColumnRenamed("key", "record_id")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return link_feed(read_table(spark, folder, "identity_feed"), read_table(spark, folder, "identities", "id", "attributes"), read_table(spark, folder, "managed_accounts", "source_id", "native_identity", "identity_id")).select("record_id", "identity_id")


QUERIES = {"p1_found": p1_found}
ORACLES: dict[str, str] = {}

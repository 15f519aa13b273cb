"""Problem 3: names of one person typed differently.

Records are blocked by phonetic codes of their sorted name parts; pairs are compared by Jaro-Winkler and a table of nicknames; accepted pairs are
clustered by connected components. As many people share a name, a name counts for more the fewer births come with it, and what else a record says
(date of birth, mailbox) confirms or refutes a pair. A code that many records share is refined by those before any pair is made; what many records of one
rare name link by the name alone becomes a star.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mergetide.functions.similarity import jaro_winkler, pairwise
from mergetide.llm.linkage import SCORE, score
from mergetide.llm.people import COMPARED, NAME_ONLY, VALUES, agreeing_dates, evidence, feed_people, near_keys, once, packed_dates, read_people, reading, shared_keys, vocabulary
from mergetide.llm.survivorship import correlated
from mergetide.operators.components import components
from mergetide.session import BROADCAST_ROWS, cut, drop, ship, told
from mergetide.sources import read_table

#: A key of a name alone makes all its pairs if at most so many different readings share it. Beyond that its pairs are found in other ways (near dates
#: and ``alike``), which give the same clusters without making them all.
COMMON = 60
#: The most births of a name that the score still counts for something.
RARE_BIRTHS = 3
#: Least score of a pair; least Jaro-Winkler of surnames and given names that no table or code links.
ACCEPT, LIKE_SURNAME, LIKE_GIVEN = 8.0, 0.9, 0.88


def alike(use: DataFrame, said: DataFrame) -> DataFrame | None:
    """(node, other): stars in place of the pairs that many bearers of a rare full name make by the name alone; none where there is no such name.

    That takes the same form of the surname, one given name and no second birth (4 + 2 + 2 in the score), so all that share these belong together, unless
    the numbers of their mailboxes differ. A reading without mailbox of its name contradicts none and is joined to all; the mailboxes without a number
    agree among themselves; those with the same number meet by it.
    """
    rare = cut(use.where((F.col("t") == "N") & (F.col("df") > COMMON) & (F.col("births") <= 1)).select("k", "reading"))
    if not told(rare):
        return None
    if told(rare) <= BROADCAST_ROWS:
        rare = F.broadcast(rare)
    same = rare.join(said, "reading").select("k", "node", "num", "given", F.explode("forms").alias("form")).select("k", "node", "num", "form", F.explode("given").alias("name"))
    least = same.groupBy("k", "form", "name").agg(F.min(F.when(F.col("num").isNull(), F.col("node"))).alias("any"), F.min(F.when(F.col("num") == "", F.col("node"))).alias("blank"))
    stars = same.join(least, ["k", "form", "name"]).select("node", F.explode(F.array("any", F.when(F.col("num") == "", F.col("blank")))).alias("other"))
    return stars.where("other is not null and node <> other").distinct()


def placed(people: DataFrame, anchors: Column) -> DataFrame:
    """``people`` with ``component``, the same for what is one person.

    ``people``: key, reading and the fields of read_people; ``anchors``: array of numbers made of its columns, rows of one anchor being one person. Rows that say the same are one
    reading, so that copies make no pairs. Null keys are left out; empty tables give no rows.
    """
    people = people.where("key is not null")
    # A reading with neither date nor mailbox names no person by itself: such copies are not taken as one.
    bare = (F.size("dates") == 0) & F.col("box").isNull()
    people = people.withColumn("reading", F.when(bare, F.xxhash64("key", "reading")).otherwise(F.col("reading")))
    # Nodes of the graph are what is surely one person: a reading counts as one of the anchors of its rows, itself if they have none. So nothing is asked about
    # two readings that an anchor joins already, and of the rows of a reading the first says what it says.
    own = Window.partitionBy("reading").orderBy("reading")
    node = F.first(F.coalesce(F.get(anchors, F.lit(0)), F.col("reading"))).over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    people = cut(people.repartition("reading").withColumns({"nth": F.row_number().over(own), "node": node}))
    tied = people.select(F.explode(anchors).alias("anchor"), "node")
    # An anchor of a single node joins nothing.
    many = cut(tied.repartition("anchor").groupBy("anchor").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("anchor", F.col("lo").alias("other")))
    edges = [tied.join(F.broadcast(many) if told(many) <= BROADCAST_ROWS else many, "anchor").select("node", "other")] if told(many) else []
    said = people.where("nth = 1")
    spread = said.select("reading", "node", packed_dates().alias("born"), F.explode(shared_keys()).alias("x")).select("reading", "node", "born", "x.*")
    # How many share a key, and how many different dates of birth come with it, which tells how many bear a name: numbers in the order of the dates, so
    # that the rows of a key are sorted once, where they are. A key of a single node makes no pairs.
    by = Window.partitionBy("k")
    first = F.expr("nullif(born & 4294967295, 0)")
    ranked = spread.repartition("k").withColumn("rank", F.dense_rank().over(by.orderBy(first.asc_nulls_last())))
    ranked = ranked.withColumn("df", F.count("*").over(by)).withColumn("births", F.coalesce(F.max(F.when(first.isNotNull(), F.col("rank"))).over(by), F.lit(0))).withColumn("lo", F.min("node").over(by)).withColumn("hi", F.max("node").over(by))
    name_only, often = F.col("t").isin(NAME_ONLY), F.col("df") > COMMON
    use = cut(ranked.where("lo < hi").select("t", "k", "reading", "node", "born", "df", "births"), hot=F.count_if((F.col("t") == "I") & often), few=F.count_if(name_only & often & (F.col("births") <= RARE_BIRTHS)))
    x = use.where(~name_only | ~often).select("k", "reading", "node", "born", F.when(name_only, F.col("births")).alias("births"))
    if told(use, "hot"):
        hot = use.where((F.col("t") == "I") & often).select("reading").distinct()
        more = said.where("size(dates) > 0").join(hot, "reading", "left_semi").select("reading", "node", packed_dates().alias("born"), F.explode(near_keys()).alias("x"))
        x = x.unionByName(more.select("x.k", "reading", "node", "born", F.lit(None).cast("int").alias("births")))
    # Two with dates of birth that aren't near are two people, whatever else agrees. Both sides have the same columns, so that their rows are shuffled once.
    pairs = x.alias("x").join(x.alias("y"), F.expr("x.k = y.k and x.reading < y.reading and x.node <> y.node") & agreeing_dates("x.born", "y.born"))
    met = pairs.select("x.reading", F.col("y.reading").alias("other"), F.least("x.births", "y.births").alias("births")).repartition("reading").groupBy("reading", "other").agg(F.min("births").cast("int").alias("borne"))
    if told(use, "few"):
        # Keys of rare names that make no pairs by themselves still say how few bear the name.
        few = cut(use.where(name_only & often & (F.col("births") <= RARE_BIRTHS)).groupBy("reading").agg(F.collect_list(F.struct("k", "births")).alias("few")))
        if told(few) <= BROADCAST_ROWS:
            few = F.broadcast(few)
        met = met.join(few, "reading", "left").join(few.select(F.col("reading").alias("other"), F.col("few").alias("fewb")), "other", "left")
        shared = F.expr("array_min(transform(filter(few, x -> exists(fewb, y -> y.k = x.k)), x -> x.births))").cast("int")
        met = met.select("reading", "other", F.least("borne", shared).alias("borne"))
        if (stars := alike(use, said)) is not None:
            edges.append(stars)
    values = said.select("reading", F.struct("node", *COMPARED).alias("v"))
    pairs = met.alias("met").join(values.alias("l"), F.expr("met.reading = l.reading")).join(values.alias("r"), F.expr("met.other = r.reading")).select(F.coalesce("borne", F.lit(COMMON)).alias("borne"), F.col("l.v").alias("a"), F.col("r.v").alias("b"))
    pairs = once(pairs, "e", evidence())
    e = {n: F.col(f"e.{n}") for n in SCORE}
    pairs = pairs.where((F.coalesce(e["born"], F.lit(1)) > 0) & (F.coalesce(e["number"], F.lit(1)) > 0))
    # Jaro-Winkler is asked where neither table nor code links the names; it gives null for null.
    ask_s, ask_g = e["surname"] == 0, (e["given"] == 0) & ~F.col("a.short") & ~F.col("b.short")
    # Only pairs that it could bring over the bar go to it; those over the bar without it are links.
    best = e | {"surname": F.when(ask_s, 2).otherwise(e["surname"]), "given": F.when(ask_g, 2).otherwise(e["given"])}
    asked = F.struct(*[F.when(ask_s, F.col(f"{t}.last")).alias(f"{t}s") for t in "ab"], *[F.when(ask_g, F.col(f"{t}.first")).alias(f"{t}g") for t in "ab"], "borne", "e")
    accepted = lambda e: (score(e, F.col("borne")) >= ACCEPT) & (e["surname"] + F.coalesce(e["given"], F.lit(0)) > 0)
    pairs = pairs.where(score(best, F.col("borne")) >= ACCEPT).select(F.least("a.node", "b.node").alias("node"), F.greatest("a.node", "b.node").alias("other"), F.when(~F.coalesce(accepted(e), F.lit(False)), asked).alias("asked"))
    pairs = cut(pairs.repartition("node").distinct(), asked=F.count("asked"))
    edges.append(pairs.where("asked is null").select("node", "other"))
    if told(pairs, "asked"):
        jw = pairwise(jaro_winkler)
        open_ = pairs.where("asked is not null").select("node", "other", "asked.*").withColumn("js", jw("as", "bs")).withColumn("jg", jw("ag", "bg"))
        given = F.when(F.col("jg") >= LIKE_GIVEN, 2).otherwise(e["given"])
        edges.append(open_.where(accepted(e | {"surname": F.when(F.col("js") >= LIKE_SURNAME, 2).otherwise(e["surname"]), "given": given})).select("node", "other"))
    graph = components(reduce(DataFrame.unionByName, edges), "node", "other")
    drop(use)
    return people.join(graph, "node", "left").withColumn("component", F.coalesce("component", "node")).drop("nth", "node")


def cluster(people: DataFrame, sure: DataFrame) -> DataFrame:
    """(key, component) of people that are one person.

    ``people``: key, reading and the fields of read_people; ``sure``: (key, anchor), keys of one anchor being one person. Null keys are left out; empty
    tables give no rows; people without a partner are in no component.
    """
    of = sure.groupBy("key").agg(F.collect_set("anchor").alias("of"))
    found = placed(people.join(of, "key", "left"), F.coalesce("of", F.array().cast("array<bigint>"))).select("key", "component")
    return found.withColumn("n", F.count("*").over(Window.partitionBy("component"))).where("n > 1").select("key", "component")


def name_variants(feed: DataFrame, identities: DataFrame, managed: DataFrame) -> DataFrame:
    """(record_a, record_b): records of one person whose names differ; record_a < record_b.

    Records are the uncorrelated rows of ``feed`` (record_id; fullName, or firstName and lastName if it is null) and ``identities`` (id; displayName of the
    attributes). Correlated rows help to see who is who but are in no pair. Records without a name are in no pair; a repeated key is one record.
    """
    ship(feed.sparkSession)
    use = correlated(feed.select("record_id", "source_id", "id", "firstName", "lastName", "fullName", "email", "birthDate"), managed)
    words = vocabulary(feed)
    name = F.coalesce("fullName", F.concat_ws(" ", "firstName", "lastName"))
    rows = feed_people(use.withColumn("name", name), words).select(F.col("record_id").alias("key"), "name", "identity_id", F.xxhash64("source_id", "id", F.lit("account")).alias("account"), *VALUES)
    at = lambda n: F.try_element_at(F.col("attributes"), F.lit(n))
    who = identities.withColumn("p", read_people(at("firstname"), at("lastname"), at("displayName"), at("email"), at("birthDate"), words))
    who = who.select(F.col("id").alias("key"), at("displayName").alias("name"), "p.*")
    people = rows.unionByName(who, allowMissingColumns=True).withColumn("reading", reading())
    # A row of a correlated account belongs to its identity, deliveries of one account to each other; a repeated key is one record.
    person = lambda c: F.when(F.col(c).isNotNull(), F.xxhash64(c, F.lit("person")))
    found = placed(people, F.filter(F.array(person("identity_id"), "account", person("key")), lambda x: x.isNotNull()))
    records = found.where("identity_id is null and name is not null").select("component", "key", "name", "num").repartition("component").distinct()
    # Two with different numbers in the mailboxes of their names are two people.
    return records.alias("x").join(records.alias("y"), F.expr("x.component = y.component and x.key < y.key and x.name <> y.name and coalesce(x.num = y.num, true)")).select(F.col("x.key").alias("record_a"), F.col("y.key").alias("record_b")).distinct()


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return name_variants(read_table(spark, folder, "identity_feed"), read_table(spark, folder, "identities", "id", "attributes"), read_table(spark, folder, "managed_accounts", "source_id", "native_identity", "identity_id"))


QUERIES = {"p3_found": p3_found}
ORACLES: dict[str, str] = {}

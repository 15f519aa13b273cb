"""Reviews as tables: what the answers of reviewers say of forms, accounts and identities. Forms themselves, their pages and mails, belong to other systems.

An instance is one reviewer's copy of a form: instance, form, ord (its order in the form), account (a composite key), account_name, source_name,
source_type, state, recipients array<string>, candidates (ids joined by commas), is_new boolean, chosen array<string>, comments, url.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mergetide.functions.keys import clean_key
from mergetide.functions.text import first_present, present, trimmed

# States of an instance that count as an answer, and the one that withdraws it. Any other state is open.
ANSWERED, CANCELLED = ["COMPLETED", "IN_PROGRESS", "SUBMITTED"], "CANCELLED"


def answered(state: Column) -> Column:
    return F.coalesce(F.upper(state).isin(ANSWERED), F.lit(False))


def open_(state: Column) -> Column:
    """Neither answered nor withdrawn; null states are neither."""
    return state.isNotNull() & ~answered(state) & (F.upper(state) != CANCELLED)


def candidate_ids(text: Column) -> Column:
    """The ids of a list joined by commas, trimmed, blank ones left out."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ","), trimmed), lambda x: x != "")


def form_states(instances: DataFrame, accounts: DataFrame) -> DataFrame:
    """(form, account, answers, seen, drop, hold): what becomes of each form and its account.

    A form's instances are gone through in order up to the first answer. drop: the form is done, as it has an answer, all of it was withdrawn, or its
    account is gone (``accounts``: key). hold: the account waits, as there is no answer yet and not all was withdrawn. seen: instances answered or withdrawn.
    """
    first = instances.groupBy("form").agg(F.min(F.when(answered(F.col("state")), F.col("ord"))).alias("_first"), F.min_by("account", F.when(F.col("account").isNotNull(), F.col("ord"))).alias("_account"))
    read = instances.join(first, "form").where(F.coalesce(F.col("ord") <= F.col("_first"), F.lit(True)))
    is_answer, withdrawn = answered(F.col("state")), F.coalesce(F.upper("state") == CANCELLED, F.lit(False))
    per = read.groupBy("form", F.col("_account").alias("account")).agg(F.count_if(is_answer).alias("answers"), F.count_if(is_answer | withdrawn).alias("seen"), F.bool_and(withdrawn).alias("_all"))
    per = per.join(accounts.select(F.col("key").alias("account"), F.lit(True).alias("_there")).dropDuplicates(["account"]), "account", "left")
    gone = F.col("account").isNotNull() & F.col("_there").isNull()
    return per.select("form", "account", "answers", "seen", ((F.col("answers") > 0) | F.col("_all") | gone).alias("drop"), ((F.col("answers") == 0) & ~F.col("_all")).alias("hold"))


def decisions(instances: DataFrame) -> DataFrame:
    """The decisions that instances hold: instance, ord, reviewer, account, account_name, source_name, source_type, is_new, identity_id, comments, finished, url.

    A null is_new is true. One that is not new needs a chosen identity, of which the first counts; all need a reviewer (the first recipient) and an account
    with a composite key. Unknown source types count as authoritative.
    """
    new = F.coalesce("is_new", F.lit(True))
    chosen = F.when(~new, F.get("chosen", F.lit(0)))
    kind = F.when(F.col("source_type").isin("authoritative", "record", "orphan"), F.col("source_type")).otherwise("authoritative")
    df = instances.select("instance", "ord", F.get("recipients", F.lit(0)).alias("reviewer"), clean_key(F.col("account")).alias("account"), first_present(F.col("account_name"), F.col("account")).alias("account_name"), F.coalesce("source_name", F.lit("")).alias("source_name"), kind.alias("source_type"), new.alias("is_new"), chosen.alias("identity_id"), F.coalesce("comments", F.lit("")).alias("comments"), answered(F.col("state")).alias("finished"), "url")
    return df.where(F.col("account").isNotNull() & present(F.col("reviewer")) & (F.col("is_new") | present(F.col("identity_id"))))


def last_assignments(made: DataFrame) -> DataFrame:
    """(identity_id, instance, account): the last finished decision that assigns an account to each identity."""
    last = F.max(F.struct("ord", "instance", "account")).alias("x")
    return made.where("finished and not is_new").groupBy("identity_id").agg(last).select("identity_id", "x.instance", "x.account")


def pending(instances: DataFrame, by: str) -> DataFrame:
    """(by, url, instance, other): the open instances by "reviewer", "candidate" or "account", each once; other: a candidate of an account, else an account.

    Rows, not lists, as one reviewer may have a third of all instances; see pending_counts.
    """
    rows = instances.where(open_(F.col("state")) & (F.size("recipients") > 0))
    spread = {"reviewer": F.explode("recipients"), "candidate": F.explode(candidate_ids(F.col("candidates"))), "account": F.col("account")}[by]
    other = F.explode_outer(candidate_ids(F.col("candidates"))) if by == "account" else F.col("account")
    return rows.withColumn("_by", spread).withColumn("other", other).select(F.col("_by").alias(by), "url", "instance", "other").where(F.col(by).isNotNull()).distinct()


def pending_counts(rows: DataFrame, by: str) -> DataFrame:
    """(by, urls, forms, others): how many different ones each has, of the rows of ``pending``."""
    return rows.groupBy(by).agg(F.count_distinct("url").alias("urls"), F.count_distinct("instance").alias("forms"), F.count_distinct("other").alias("others"))


def without_pending(queue: DataFrame, states: DataFrame, key: str) -> DataFrame:
    """The accounts of a queue that no open form holds."""
    return queue.join(states.where("hold").select(F.col("account").alias(key)).distinct(), key, "left_anti")


def review_requests(matches: DataFrame, reviewers: DataFrame, instances: DataFrame) -> DataFrame:
    """(account, reviewer, candidates): the reviews to ask for: each account with matches (account, source_id, identity_id) and each reviewer of its source
    (source_id, reviewer), unless an open instance asks that reviewer already. candidates: the ids, sorted, joined by commas."""
    per = matches.groupBy("account", "source_id").agg(F.array_join(F.array_sort(F.collect_set("identity_id")), ",").alias("candidates"))
    asked = instances.where(open_(F.col("state"))).select("account", F.explode("recipients").alias("reviewer")).distinct()
    wanted = per.join(reviewers.select("source_id", "reviewer").where("reviewer is not null").distinct(), "source_id")
    return wanted.join(asked, ["account", "reviewer"], "left_anti").select("account", "reviewer", "candidates")


def reconciled(rows: DataFrame, by_candidate: DataFrame, by_reviewer: DataFrame, identity: str = "identity_id") -> DataFrame:
    """rows (identity, statuses, reviews) as the open reviews (rows of ``pending``) have it: "candidate" and "activeReviews" are taken from the statuses and put
    back where they hold, and reviews are the urls that wait for the row's identity, as the output shows them."""
    df = rows.join(by_candidate.select(F.col("candidate").alias(identity), F.lit(True).alias("_c")).distinct(), identity, "left")
    df = df.join(by_reviewer.groupBy(F.col("reviewer").alias(identity)).agg(F.array_sort(F.collect_set("url")).alias("_r")), identity, "left")
    own = F.array_except(F.coalesce("statuses", F.array().cast("array<string>")), F.array(F.lit("candidate"), F.lit("activeReviews")))
    more = F.filter(F.array(F.when(F.col("_c"), "candidate"), F.when(F.size("_r") > 0, "activeReviews")), lambda x: x.isNotNull())
    return df.withColumn("statuses", F.concat(own, more)).withColumn("reviews", F.coalesce("_r", F.array().cast("array<string>"))).drop("_c", "_r")


def stale(created: Column, now: Column, days: int) -> Column:
    """Whether a form is older than so many days; one without a time is not."""
    return F.coalesce(F.unix_micros(created.cast("timestamp")) < F.unix_micros(now.cast("timestamp")) - F.lit(days * 86_400_000_000), F.lit(False))

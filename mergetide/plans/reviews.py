"""Queries of reviews, decisions and routing. The tables hold no reviews, so each scoring of the match report stands for an instance of one: its pass says
the state, its source the reviewer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mergetide.functions.keys import account_key
from mergetide.operators import report, reviews, routing
from mergetide.operators.routing import Toggles
from mergetide.sources import read_table


def instances(spark: SparkSession, d: str) -> DataFrame:
    """An instance for each account, identity and pass of the candidates, in the columns of operators.reviews: the form is the account's, pass 1 is answered
    from a score of 60 on and withdrawn below, pass 2 is open, pass 3 answered; below a score of 75 the reviewer chose a new identity."""
    c = read_table(spark, d, "candidates", "accountId", "sourceName", "identityId", "score", "pass_no")
    per = c.where("identityId is not null and accountId is not null").groupBy("accountId", "identityId", "pass_no").agg(F.coalesce(F.max(F.when(~F.isnan("score"), F.col("score"))), F.lit(0.0)).alias("score"), F.min("sourceName").alias("source_name"))
    m = read_table(spark, d, "managed_accounts", "id", "source_id", "native_identity", "name")
    m = m.select(F.col("id").alias("accountId"), account_key(F.col("source_id"), F.col("native_identity")).alias("account"), F.col("name").alias("account_name"))
    s = F.broadcast(read_table(spark, d, "sources", "name", "source_type").withColumnRenamed("name", "source_name"))
    state = F.when((F.col("pass_no") == 1) & (F.col("score") < 60), "CANCELLED").when(F.col("pass_no") == 2, "ASSIGNED").when(F.col("pass_no") == 3, "SUBMITTED").otherwise("COMPLETED")
    df = per.join(m, "accountId", "left").join(s, "source_name", "left")
    order = F.format_string("%06d|%s|%d", F.floor(F.col("score") * 1000).cast("int"), F.col("identityId"), F.col("pass_no"))
    return df.select(F.concat_ws("|", "accountId", "identityId", F.col("pass_no").cast("string")).alias("instance"), F.col("accountId").alias("form"), order.alias("ord"), "account", "account_name", "source_name", "source_type", state.alias("state"), F.array("source_name").alias("recipients"), F.col("identityId").alias("candidates"), (F.col("score") < 75).alias("is_new"), F.array("identityId").alias("chosen"), F.lit(None).cast("string").alias("comments"), F.concat(F.lit("form:"), "accountId").alias("url"))


_INSTANCES = """
inst as (
  select p.accountId || '|' || p.identityId || '|' || p.pass_no as instance, p.accountId as form, printf('%06d|%s|%d', floor(p.score * 1000)::int, p.identityId, p.pass_no) as ord, trim(m.source_id) || '::' || trim(m.native_identity) as account,
    coalesce(m.name, trim(m.source_id) || '::' || trim(m.native_identity)) as account_name, p.source_name, s.source_type, p.identityId, p.score < 75 as is_new,
    case when pass_no = 1 and score < 60 then 'CANCELLED' when pass_no = 2 then 'ASSIGNED' when pass_no = 3 then 'SUBMITTED' else 'COMPLETED' end as state
  from (select accountId, identityId, pass_no, coalesce(max(score) filter (where not isnan(score)), 0) as score, min(sourceName) as source_name from candidates where identityId is not null and accountId is not null group by 1, 2, 3) p
  left join managed_accounts m on m.id = p.accountId left join sources s on s.name = p.source_name),
dec as (
  select *, case when not is_new then identityId end as chosen, state in ('COMPLETED', 'SUBMITTED') as finished from inst where account is not null and trim(source_name) <> '')
"""


def review_states(spark: SparkSession, d: str) -> DataFrame:
    acc = read_table(spark, d, "managed_accounts", "source_id", "native_identity", "is_machine").where("not coalesce(is_machine, false)").select(account_key(F.col("source_id"), F.col("native_identity")).alias("key"))
    return reviews.form_states(instances(spark, d), acc)


STATES_SQL = f"""
with {_INSTANCES},
f as (select form, min(ord) filter (where state in ('COMPLETED', 'SUBMITTED')) as first, any_value(account) as account from inst group by 1),
r as (select f.form, f.account, count(*) filter (where state in ('COMPLETED', 'SUBMITTED')) as answers, count(*) filter (where state <> 'ASSIGNED') as seen, bool_and(state = 'CANCELLED') as gone
  from inst i join f on f.form = i.form where f.first is null or i.ord <= f.first group by 1, 2)
select form, account, answers, seen, answers > 0 or gone or (account is not null and not exists (select 1 from managed_accounts m where not coalesce(m.is_machine, false) and trim(m.source_id) || '::' || trim(m.native_identity) = r.account)) as drop, answers = 0 and not gone as hold from r
"""


def review_decisions(spark: SparkSession, d: str) -> DataFrame:
    return reviews.decisions(instances(spark, d)).select("instance", "reviewer", "account", "account_name", "source_type", "is_new", "identity_id", "finished")


DECISIONS_SQL = f"with {_INSTANCES} select instance, source_name as reviewer, account, account_name, coalesce(source_type, 'authoritative') as source_type, is_new, chosen as identity_id, finished from dec"


def review_assignments(spark: SparkSession, d: str) -> DataFrame:
    return reviews.last_assignments(reviews.decisions(instances(spark, d)))


ASSIGNMENTS_SQL = f"with {_INSTANCES} select chosen as identity_id, arg_max(instance, ord || chr(1) || instance) as instance, arg_max(account, ord || chr(1) || instance) as account from dec where finished and not is_new group by 1"


def review_pending(spark: SparkSession, d: str) -> DataFrame:
    """The open reviews by reviewer, candidate and account: how many forms, and how many others they are about."""
    rows = instances(spark, d)
    by = [reviews.pending_counts(reviews.pending(rows, b), b).select(F.lit(b).alias("by"), F.col(b).alias("who"), "urls", "forms", "others") for b in ("reviewer", "candidate", "account")]
    return by[0].unionByName(by[1]).unionByName(by[2])


PENDING_SQL = f"""
with {_INSTANCES}, o as (select * from inst where state = 'ASSIGNED')
select 'reviewer' as by, source_name as who, count(distinct form) as urls, count(distinct instance) as forms, count(distinct account) as others from o where source_name is not null group by 2
union all select 'candidate', identityId, count(distinct form), count(distinct instance), count(distinct account) from o group by 2
union all select 'account', account, count(distinct form), count(distinct instance), count(distinct identityId) from o where account is not null group by 2
"""


def review_queue(spark: SparkSession, d: str) -> DataFrame:
    """The accounts that no open form holds, by source."""
    acc = read_table(spark, d, "managed_accounts", "source_id", "native_identity").select("source_id", account_key(F.col("source_id"), F.col("native_identity")).alias("key")).where("key is not null")
    return reviews.without_pending(acc, review_states(spark, d), "key").groupBy("source_id").agg(F.count("*").alias("n"))


QUEUE_SQL = f"""
with s as ({STATES_SQL})
select source_id, count(*) as n from managed_accounts m where trim(source_id) <> '' and trim(native_identity) <> '' and not exists (select 1 from s where s.hold and s.account = trim(m.source_id) || '::' || trim(m.native_identity)) group by 1
"""


def review_requests(spark: SparkSession, d: str) -> DataFrame:
    """The reviews to ask for: matches of 70 or more, the reviewers of a source being itself and its most trusted one, without those asked already."""
    rows = instances(spark, d)
    m = rows.where("state <> 'CANCELLED' and account is not null").select("account", F.col("source_name").alias("source_id"), F.col("candidates").alias("identity_id"))
    s = read_table(spark, d, "sources", "name", "priority")
    top = s.groupBy().agg(F.min_by("name", "priority").alias("reviewer"))
    own = s.select(F.col("name").alias("source_id"), F.col("name").alias("reviewer"))
    return reviews.review_requests(m, own.unionByName(s.select(F.col("name").alias("source_id")).join(F.broadcast(top))), rows)


REQUESTS_SQL = f"""
with {_INSTANCES}, r as (select name as source_id, name as reviewer from sources union select name, (select arg_min(name, priority) from sources) from sources),
m as (select account, source_name, string_agg(distinct identityId, ',' order by identityId) as candidates from inst where state <> 'CANCELLED' and account is not null group by 1, 2)
select m.account, r.reviewer, m.candidates from m join r on r.source_id = m.source_name where not exists (select 1 from inst i where i.state = 'ASSIGNED' and i.account = m.account and i.source_name = r.reviewer)
"""


def _outcomes(spark: SparkSession, d: str) -> DataFrame:
    acc = read_table(spark, d, "managed_accounts", "id", "source_id", "identity_id", "uncorrelated", "disabled")
    s = F.broadcast(read_table(spark, d, "sources", "id", "source_type", "priority").withColumnRenamed("id", "source_id"))
    best = read_table(spark, d, "candidates", "accountId", "identityId", "score").where("identityId is not null and score is not null and not isnan(score)").groupBy("accountId")
    best = best.agg(F.count_if(F.col("score") >= 99).alias("exact"), F.count_if(F.col("score") >= 80).alias("matched"), F.count_if(F.col("score") >= 60).alias("peers")).withColumnRenamed("accountId", "id")
    df = acc.join(s, "source_id", "left").join(best, "id", "left")
    listed = read_table(spark, d, "identities", "id").select(F.col("id").alias("identity_id"), F.lit(True).alias("linked"))
    df = df.join(listed, "identity_id", "left").withColumn("correlated", ~F.coalesce("uncorrelated", F.lit(True))).withColumn("reviewers", F.when(F.col("priority") < 8, 1).otherwise(0)).withColumn("disables", F.col("priority") % 2 == 0)
    return routing.routed(df, Toggles(assign_exact=True))


def accounts_routed(spark: SparkSession, d: str) -> DataFrame:
    """Where every account goes."""
    return _outcomes(spark, d).select("id", "outcome")


_ROUTED_SQL = """
b as (select accountId, count(*) filter (where score >= 99) as exact, count(*) filter (where score >= 80) as matched, count(*) filter (where score >= 60) as peers from candidates where identityId is not null and score is not null and not isnan(score) group by 1),
p as (select a.*, s.source_type, case when s.source_type = 'record' then 'register' when s.source_type = 'orphan' and s.priority % 2 = 0 then 'disable' when s.source_type = 'orphan' then 'drop' else 'emit' end as plain,
  coalesce(s.priority, 99) < 8 and coalesce(a.uncorrelated, true) as asked from managed_accounts a left join sources s on s.id = a.source_id),
r as (select p.id, p.source_id, p.native_identity, p.disabled, p.identity_id, case when exists (select 1 from identities i where i.id = p.identity_id) then 'linked' when not asked then plain when coalesce(b.exact, 0) > 0 then 'assign' when coalesce(b.matched, 0) > 0 then 'review'
  when coalesce(b.peers, 0) > 0 and coalesce(source_type, 'authoritative') = 'authoritative' then 'defer' else plain end as outcome from p left join b on b.accountId = p.id)
"""
ROUTED_SQL = f"with {_ROUTED_SQL} select id, outcome from r"


def accounts_disabled(spark: SparkSession, d: str) -> DataFrame:
    return routing.disables(_outcomes(spark, d), "id")


DISABLED_SQL = f"with {_ROUTED_SQL} select id from r where outcome = 'disable' and not coalesce(disabled, false)"


def decisions_applied(spark: SparkSession, d: str) -> DataFrame:
    """What every finished decision does, with the identities of enabled rows as rows."""
    rows = read_table(spark, d, "identities", "id", "disabled").where("not coalesce(disabled, false)").select(F.concat(F.lit("row:"), "id").alias("row_id"), F.col("id").alias("identity_id"))
    s = read_table(spark, d, "sources", "name", "priority").select("name", (F.col("priority") % 2 == 1).alias("disables"))
    return routing.applied(reviews.decisions(instances(spark, d)), rows, s)


APPLIED_SQL = f"""
with {_INSTANCES}
select d.instance, d.account, d.chosen as identity_id, case when is_new then case when d.source_type = 'record' then 'register' when d.source_type = 'orphan' and s.priority % 2 = 1 then 'disable' when d.source_type = 'orphan' then 'drop' else 'emit' end
  when i.id is not null then 'merge' else 'create' end as effect, case when not is_new and i.id is not null then 'row:' || i.id end as row_id
from dec d left join sources s on s.name = d.source_name left join identities i on i.id = d.chosen and not coalesce(i.disabled, false) where finished
"""


def decisions_conflicts(spark: SparkSession, d: str) -> DataFrame:
    return routing.conflicting(reviews.decisions(instances(spark, d)))


DECISION_CONFLICTS_SQL = f"with {_INSTANCES}, x as (select distinct account, chosen from dec where finished and not is_new) select account, chosen as identity_id, n from (select *, count(*) over (partition by account) as n from x) where n > 1"


def correlations_set(spark: SparkSession, d: str) -> DataFrame:
    """The accounts whose identity another system is to set by the last assignments."""
    m = read_table(spark, d, "managed_accounts", "source_id", "native_identity", "identity_id").select(account_key(F.col("source_id"), F.col("native_identity")).alias("key"), "identity_id")
    return routing.correlations(review_assignments(spark, d).select(F.col("account").alias("key"), "identity_id"), m)


CORRELATIONS_SQL = f"with a as ({ASSIGNMENTS_SQL}) select a.account as key, a.identity_id from a join managed_accounts m on trim(m.source_id) || '::' || trim(m.native_identity) = a.account where m.identity_id is distinct from a.identity_id"


def _reported(spark: SparkSession, d: str) -> DataFrame:
    """Accounts as report rows: key, status and categories."""
    acc = _outcomes(spark, d).select("id", "identity_id", "outcome", "exact", "matched")
    seen = review_pending(spark, d).where("by = 'account'").select(F.col("who").alias("key"), F.lit(True).alias("pending"))
    m = read_table(spark, d, "managed_accounts", "id", "source_id", "native_identity").select("id", account_key(F.col("source_id"), F.col("native_identity")).alias("key"))
    made = reviews.decisions(instances(spark, d)).where("finished").select(F.col("account").alias("key"), F.lit(True).alias("decided")).distinct()
    df = acc.join(m, "id").join(seen, "key", "left").join(made, "key", "left")
    status = report.account_status(F.col("matched") > 0, F.col("outcome") == "defer", F.lit(False), F.col("exact").isNotNull())
    df = df.withColumn("status", status).withColumn("statuses", F.when(F.col("outcome") == "linked", F.array(F.lit("baseline"))).otherwise(F.array().cast("array<string>")))
    return df.select("id", "status", report.row_categories(F.col("statuses"), F.col("identity_id"), F.col("status"), F.col("exact") > 0, F.col("pending"), F.col("decided"), F.col("outcome") == "emit").alias("categories"))


def report_rows(spark: SparkSession, d: str) -> DataFrame:
    """The rows of a report without those that are only listed, in groups and in order."""
    out = report.emitted(_reported(spark, d), "id", "categories", [c for c in report.CATEGORIES if c != "existing-fusion"])
    return out.select("id", "group", "place", "status", F.array_join("categories", "|").alias("categories"))


_REPORTED = f"""
{_INSTANCES}, {_ROUTED_SQL},
q as (select r.id, r.identity_id, r.outcome, case when outcome = 'defer' then 'deferred' when coalesce(b.matched, 0) > 0 then 'matched' when b.accountId is not null then 'non-matched' else 'not-analyzed' end as status, coalesce(b.exact, 0) > 0 as exact,
  exists (select 1 from inst i where i.state = 'ASSIGNED' and i.account = trim(r.source_id) || '::' || trim(r.native_identity)) as pending, exists (select 1 from dec x where x.finished and x.account = trim(r.source_id) || '::' || trim(r.native_identity)) as decided from r left join b on b.accountId = r.id),
c as (select id, status, [x for x in [case when outcome = 'linked' then 'baseline' end, case when outcome <> 'linked' and trim(identity_id) <> '' then 'identity-linked' end, case when status = 'non-matched' then 'nonMatched' end,
  case when status = 'matched' then 'matched' end, case when status = 'matched' and exact then 'exact' end, case when status = 'deferred' then 'deferred' end, case when pending then 'review' end, case when decided then 'decisions' end, case when outcome = 'emit' then 'existing-fusion' end] if x is not null] as cats from q)
"""
REPORT_ROWS_SQL = f"""
with {_REPORTED}, g as (select id, status, cats, [x for x in cats if x <> 'existing-fusion'][1] as grp from c)
select id, grp as "group", row_number() over (order by list_position(['baseline', 'identity-linked', 'nonMatched', 'matched', 'exact', 'deferred', 'review', 'decisions'], grp), id) as place, status, array_to_string(cats, '|') as categories from g where grp is not null
"""


def report_options(spark: SparkSession, d: str) -> DataFrame:
    return report.option_counts(_reported(spark, d), "categories", "status")


OPTIONS_SQL = f"with {_REPORTED} select " + ", ".join(f"count(*) filter (where list_contains(cats, '{c}')) as n_{c}" for c in ("nonMatched", "matched", "exact", "deferred", "review", "decisions")) + ", count(*) filter (where status = 'review-error') as n_review_error from c"


def decisions_counted(spark: SparkSession, d: str) -> DataFrame:
    return report.decision_counts(reviews.decisions(instances(spark, d)))


COUNTED_SQL = f"""
with {_INSTANCES}, x as (select *, coalesce(source_type, 'authoritative') as t from dec where finished)
select count(*) filter (where t = 'authoritative') as authoritative, count(*) filter (where t = 'record') as record, count(*) filter (where t = 'orphan') as orphan, count(*) filter (where t = 'authoritative' and is_new) as new_identities,
  count(*) filter (where t <> 'authoritative' and is_new) as no_matches, count(*) filter (where source_name = 'system') as automatic from x
"""


QUERIES = {
    "review_states": review_states, "review_decisions": review_decisions, "review_assignments": review_assignments, "review_pending": review_pending, "review_queue": review_queue, "review_requests": review_requests,
    "accounts_routed": accounts_routed, "accounts_disabled": accounts_disabled, "decisions_applied": decisions_applied, "decisions_conflicts": decisions_conflicts, "correlations_set": correlations_set, "report_rows": report_rows,
    "report_options": report_options, "decisions_counted": decisions_counted,
}
ORACLES = {
    "review_states": STATES_SQL, "review_decisions": DECISIONS_SQL, "review_assignments": ASSIGNMENTS_SQL, "review_pending": PENDING_SQL, "review_queue": QUEUE_SQL, "review_requests": REQUESTS_SQL,
    "accounts_routed": ROUTED_SQL, "accounts_disabled": DISABLED_SQL, "decisions_applied": APPLIED_SQL, "decisions_conflicts": DECISION_CONFLICTS_SQL, "correlations_set": CORRELATIONS_SQL, "report_rows": REPORT_ROWS_SQL,
    "report_options": OPTIONS_SQL, "decisions_counted": COUNTED_SQL,
}

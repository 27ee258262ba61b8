"""Periods counted from the words of their days: numbered once, stored day by day, backfilled and read back."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from dialoom.operators import day_words, periods
from dialoom.plans import views as v
from dialoom.plans.queries import HITS, LATEST, YEAR, _hits, _user_days, query
from dialoom.sources import sinks
from dialoom.sources.shared import saved, shared_path

METRICS = """count(DISTINCT client_id) FILTER (active) AS active_users, count(*) AS sessions, count(*) FILTER (queries >= 3) AS deep_sessions, CAST(sum(queries) AS BIGINT) AS queries,
 count(DISTINCT client_id) FILTER (pos) AS positive_users, count(DISTINCT client_id) FILTER (neg) AS negative_users"""
MARKS = "sum(queries) AS queries, bool_or(initiated OR continued) AS active, bool_or(polarities LIKE '%positive%') AS pos, bool_or(polarities LIKE '%negative%') AS neg"
#: As HITS, but a query belongs to the day its line was shipped, so most sessions have queries of several days.
SHIPPED = HITS.replace("CAST(o_orderdate AS DATE) AS data_date FROM lineitem", "CAST(l_shipdate AS DATE) AS data_date FROM lineitem")


def _shipped(spark, d):
    return periods.contribution_hits(v.v3_mentions(spark, d, "l_shipdate"), v.v3_members(spark, d, False))


def _words(hits, *by):
    """The hits' users and sessions numbered, and their words by day."""
    users, sessions = day_words.numbered(hits, day_words.USER), day_words.numbered(hits, day_words.SESSION, near=("rollup_id", "data_date"))
    return day_words.user_words(hits, users, *by), day_words.session_words(hits, sessions, *by)


@query(f"WITH {HITS}, s AS (SELECT rollup_id, client_id, cid, {MARKS} FROM h WHERE {YEAR} GROUP BY rollup_id, client_id, cid) SELECT rollup_id, {METRICS} FROM s GROUP BY rollup_id")
def q_period_words(spark, d):
    """A31 over words that are stored by day; the year reads its days' words and no hit."""
    hits = saved(_hits(spark, d), "hits")
    year = F.year("data_date") == 1997
    users, sessions = (saved(w, "words").filter(year) for w in _words(hits, "data_date"))
    return day_words.period_metrics(users, sessions)


@query(f"""WITH {SHIPPED}, s AS (SELECT strftime(data_date, '%Y') AS period, rollup_id, client_id, cid, {MARKS} FROM h GROUP BY 1, rollup_id, client_id, cid UNION ALL SELECT strftime(data_date, '%Y-%m'), rollup_id, client_id, cid, {MARKS} FROM h GROUP BY 1, rollup_id, client_id, cid
 UNION ALL SELECT 'all', rollup_id, client_id, cid, {MARKS} FROM h GROUP BY rollup_id, client_id, cid) SELECT period, rollup_id, {METRICS} FROM s GROUP BY period, rollup_id""")
def q_period_words_levels(spark, d):
    """Every month from its days, every year from its months, all time from its years; sessions run over several days, so their queries add up across words."""
    hits = saved(_shipped(spark, d), "hits")
    month, year = F.date_format("data_date", "yyyy-MM").alias("period"), F.substring("period", 1, 4).alias("period")
    levels = []
    for words in _words(hits, "data_date"):
        values = [c for c in words.columns if c != "data_date"]
        months = saved(day_words.merged(words.select(month, *values), "period", "rollup_id"), "months")
        years = saved(day_words.merged(months.select(year, *values), "period", "rollup_id"), "years")
        ever = day_words.merged(years, "rollup_id").withColumn("period", F.lit("all"))
        levels.append(months.unionByName(years).unionByName(ever))
    return day_words.period_metrics(*levels, "period")


@query(f"WITH {SHIPPED}, {LATEST} SELECT (SELECT count(*) FROM lt) AS users, (SELECT count(*) FROM lt WHERE eligible) AS eligible_users, (SELECT count(DISTINCT client_id) FROM h WHERE initiated OR continued) AS active_users, (SELECT count(DISTINCT cid) FROM h) AS sessions, (SELECT CAST(sum(queries) AS BIGINT) FROM h) AS queries")
def q_period_words_totals(spark, d):
    """Users who only have a profile get their numbers after those with hits."""
    hits, profiles = saved(_shipped(spark, d), "hits"), periods.contribution_users(_user_days(spark, d))
    users = day_words.numbered(profiles, day_words.USER, day_words.numbered(hits, day_words.USER))
    sessions = day_words.numbered(hits, day_words.SESSION)
    return day_words.period_totals(day_words.user_words(hits, users, "data_date"), day_words.session_words(hits, sessions, "data_date"), day_words.profile_words(profiles, users, "data_date"))


@query(f"WITH {SHIPPED}, s AS (SELECT rollup_id, client_id, cid, {MARKS} FROM h GROUP BY rollup_id, client_id, cid) SELECT rollup_id, {METRICS} FROM s GROUP BY rollup_id")
def q_period_words_backfill(spark, d):
    """Days published with a dictionary that lacks every second entity in the last eight days; after the change those days alone are computed and published again, new users and sessions numbered after the known ones."""
    full = saved(_shipped(spark, d).withColumn("product", F.lit("M1")), "hits")
    last = full.agg(F.max("data_date")).first()[0]
    recent = F.col("data_date") > F.date_sub(F.lit(last), 8)
    before = full.filter(~recent | (F.crc32("rollup_id") % 2 == 0))
    backfill = full.filter(recent)
    paths = [shared_path(spark, name) for name in ("user-words", "session-words")]
    makers = [(day_words.USER, day_words.user_words), (day_words.SESSION, day_words.session_words)]
    for path, (key, words) in zip(paths, makers, strict=True):
        old = day_words.numbered(before, key)
        new = day_words.numbered(backfill, key, old)
        sinks.publish_days(words(before, old, *sinks.DAY), path)
        sinks.publish_days(words(backfill, new, *sinks.DAY), path, backfill)
    return day_words.period_metrics(*map(partial(sinks.published, spark), paths))

"""Periods from the words of days against plain counting of the hits."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from dialoom.operators import day_words, periods

SCHEMA = "data_date date, client_id string, rollup_id string, cid string, queries long, initiated boolean, continued boolean, polarities array<string>"
DAY0 = datetime.date(2024, 1, 29)


def made_hits(seed: int, n: int, n_users: int = 150) -> list[tuple]:
    """Hits whose sessions run over several days and rollups; a third belong to one user, some have no user or session."""
    r, rows = random.Random(seed), []
    for _ in range(n):
        user = "hot" if r.random() < 0.33 else r.choice([None, *[f"u{k}" for k in range(n_users)]])
        marks = r.choice([None, [], ["positive"], ["negative", "positive"], ["mixed"]])
        rows.append((DAY0 + datetime.timedelta(r.randrange(6)), user, r.choice(["a", "b", None]), r.choice([None, *[f"s{k}" for k in range(20)]]), r.randint(1, 3), r.random() < 0.3, r.random() < 0.3, marks))
    return rows


def plain_metrics(rows: list[tuple], period) -> dict:
    out = {}
    for key in {(period(x[0]), x[2]) for x in rows}:
        mine = [x for x in rows if (period(x[0]), x[2]) == key]
        depth = {}
        for x in mine:
            depth[x[1], x[3]] = depth.get((x[1], x[3]), 0) + x[4]
        users = lambda test, mine=mine: len({x[1] for x in mine if test(x)})
        out[key] = (users(lambda x: x[5] or x[6]), len(depth), sum(q >= 3 for q in depth.values()), sum(depth.values()), users(lambda x: "positive" in (x[7] or [])), users(lambda x: "negative" in (x[7] or [])))
    return out


def words_of(hits, *by):
    return day_words.user_words(hits, day_words.numbered(hits, day_words.USER), *by), day_words.session_words(hits, day_words.numbered(hits, day_words.SESSION), *by)


@pytest.mark.parametrize("seed", [1, 2])
def test_months_from_days_and_all_from_months(spark, seed):
    rows = made_hits(seed, 900)
    month = lambda day: f"{day:%Y-%m}"
    levels = []
    for words in words_of(spark.createDataFrame(rows, SCHEMA), "data_date"):
        values = [c for c in words.columns if c != "data_date"]
        months = day_words.merged(words.select(F.date_format("data_date", "yyyy-MM").alias("period"), *values), "period", "rollup_id")
        levels.append(months.unionByName(day_words.merged(months, "rollup_id").withColumn("period", F.lit("all"))))
    got = {tuple(r[:2]): tuple(r[2:]) for r in day_words.period_metrics(*levels, "period").collect()}
    assert got == plain_metrics(rows, month) | plain_metrics(rows, lambda day: "all")


def test_equals_counting_of_hits(spark):
    hits = spark.createDataFrame([x for x in made_hits(3, 600) if x[2]], SCHEMA)
    got, want = day_words.period_metrics(*words_of(hits, "data_date")), periods.period_metrics(hits)
    assert sorted(got.select(*want.columns).collect()) == sorted(want.collect())


def test_known_keys_keep_their_numbers(spark):
    hits = spark.createDataFrame(made_hits(4, 400), SCHEMA)
    old = day_words.numbered(hits.filter("day(data_date) = 29"), day_words.SESSION)
    every = day_words.numbered(hits, day_words.SESSION, old)
    kept = {tuple(r[:2]): r[2] for r in every.collect()}
    assert all(kept[tuple(r[:2])] == r[2] for r in old.collect())
    assert len(kept) == len(set(kept.values())) == every.count() == hits.select(*day_words.SESSION).distinct().count()


def test_totals(spark):
    rows = made_hits(5, 500)
    hits = spark.createDataFrame(rows, SCHEMA)
    profiles = spark.createDataFrame([(DAY0, f"u{k}", k % 3 == 0) for k in range(200)] + [(DAY0 + datetime.timedelta(1), "u1", True), (DAY0, None, None)], "data_date date, client_id string, eligible boolean")
    users = day_words.numbered(profiles, day_words.USER, day_words.numbered(hits, day_words.USER))
    sessions = day_words.numbered(hits, day_words.SESSION)
    got = day_words.period_totals(day_words.user_words(hits, users, "data_date"), day_words.session_words(hits, sessions, "data_date"), day_words.profile_words(profiles, users, "data_date")).first()
    active = {x[1] for x in rows if x[5] or x[6]}
    assert tuple(got) == (201, 68, len(active), len({(x[1], x[3]) for x in rows}), sum(x[4] for x in rows))


def test_empty(spark):
    hits = spark.createDataFrame([], SCHEMA)
    users, sessions = words_of(hits, "data_date")
    assert day_words.period_metrics(users, sessions).collect() == []
    profiles = spark.createDataFrame([], "data_date date, client_id string, eligible boolean")
    words = day_words.profile_words(profiles, day_words.numbered(profiles, day_words.USER), "data_date")
    assert tuple(day_words.period_totals(users, sessions, words).first()) == (0, 0, 0, 0, 0)


def test_a_period_shuffles_words_and_reads_no_hits(spark):
    """70 users of one rollup on each of 6 days are two words a day, and one grouping by word is all that precedes the count."""
    rows = [(DAY0 + datetime.timedelta(k), f"u{n}", "a", "s", 1, True, False, []) for k in range(6) for n in range(70)]
    hits = spark.createDataFrame(rows, SCHEMA).repartition(1)
    users, sessions = words_of(hits, "data_date")
    assert users.count() <= 6 * 4 and sessions.count() <= 6 * 4  # at most one word more for each partition of the numbers
    assert tuple(day_words.period_metrics(users, sessions).first()) == ("a", 70, 70, 70, 420, 0, 0)

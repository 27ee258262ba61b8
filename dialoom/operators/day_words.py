"""Bitmaps of users and sessions by day, from which periods of any length are counted exactly without their hits.

Users and sessions get numbers once (``numbered``). A day keeps, for each rollup and each 64 numbers, one word with a bit for each user or session.
Words of days are joined to months, and months to years, by the same merge, so a period shuffles words instead of users of all days. A word has
64 bits instead of the 32,768 of Spark's bitmap functions, as most rollups have a handful of users on a day: a word never takes more rows than the
hits it stands for, and where users are many it takes 64 times fewer.

Defined results: a null user or session is one user or session; a day without hits has no words; repeated hits of a day, rollup, user and session are
added; an empty table gives no words and no metrics (totals are 0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.sources.shared import saved

USER, SESSION = ("client_id",), ("client_id", "cid")


def numbered(rows: DataFrame, key: tuple[str, ...], known: DataFrame | None = None, near: tuple[str, ...] = ()) -> DataFrame:
    """(key, number) of all keys; keys of ``known`` keep their numbers, new ones come after them, in the order of their smallest values in the columns
    ``near`` (sessions of one rollup and day share words), then those with most rows first (busy users share words).

    The numbers are written once: they are positions in a sorted table, with gaps, and so need no single task.
    """
    new = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("weight"), F.min(F.struct(F.lit(0).alias("none"), *near)).alias("place"))
    first = 0
    if known is not None:
        new = new.alias("n").join(known.alias("k"), _same("n", "k", key), "left_anti")
        top = known.agg(F.max("number")).first()[0]
        first = 0 if top is None else (top // 64 + 1) * 64
    order = [F.col("place"), F.desc("weight"), *[F.col(c) for c in key]]
    found = saved(new.orderBy(*order).select(*key, (F.monotonically_increasing_id() + F.lit(first)).alias("number")), "numbers")
    return found if known is None else known.select(*found.columns).unionByName(found)


def _same(one: str, other: str, key: tuple[str, ...]) -> Column:
    same = F.lit(True)
    for c in key:
        same &= F.col(f"{one}.{c}").eqNullSafe(F.col(f"{other}.{c}"))
    return same


def _placed(rows: DataFrame, numbers: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """The rows with the word of their key's number and the bit in it."""
    found = rows.alias("r").join(numbers.alias("n"), _same("r", "n", key))
    return found.select("r.*", F.expr("shiftright(n.number, 6)").alias("word"), F.expr("shiftleft(1L, CAST(n.number & 63 AS INT))").alias("bit"))


def _bits(bit: Column, condition: Column) -> Column:
    return F.bit_or(F.when(condition, bit).otherwise(F.lit(0).cast("long")))


def user_words(hits: DataFrame, users: DataFrame, *by: str) -> DataFrame:
    """(by, rollup_id, word, active, positive, negative) from the contribution hits of A30; ``by`` is the day, with the product where there are several."""
    has = lambda mark: F.coalesce(F.array_contains("polarities", mark), F.lit(False))
    placed = _placed(hits.select(*by, "rollup_id", "client_id", (F.col("initiated") | F.col("continued")).alias("is_active"), has("positive").alias("pos"), has("negative").alias("neg")), users, USER)
    bit = F.col("bit")
    return placed.groupBy(*by, "rollup_id", "word").agg(_bits(bit, F.col("is_active")).alias("active"), _bits(bit, F.col("pos")).alias("positive"), _bits(bit, F.col("neg")).alias("negative"))


def session_words(hits: DataFrame, sessions: DataFrame, *by: str) -> DataFrame:
    """(by, rollup_id, word, one, two, three, queries): sessions with at least one, two and three queries of the day, and all queries."""
    rows = hits.groupBy(*by, "rollup_id", *SESSION).agg(F.sum("queries").alias("queries"))
    bit, n = F.col("bit"), F.col("queries")
    levels = [_bits(bit, n >= k).alias(name) for k, name in ((1, "one"), (2, "two"), (3, "three"))]
    return _placed(rows, sessions, SESSION).groupBy(*by, "rollup_id", "word").agg(*levels, F.sum("queries").alias("queries"))


def profile_words(profiles: DataFrame, users: DataFrame, *by: str) -> DataFrame:
    """(by, word, seen, eligible) from the contribution users of A30."""
    bit = F.col("bit")
    return _placed(profiles.select(*by, "client_id", F.col("eligible").alias("is_eligible")), users, USER).groupBy(*by, "word").agg(F.bit_or("bit").alias("seen"), _bits(bit, F.col("is_eligible")).alias("eligible"))


def merged(words: DataFrame, *by: str) -> DataFrame:
    """Words of days (or of months) as words of the longer periods ``by``; the rows of a word are one for each day at most.

    Marks are joined by OR. Sessions add up to three: a session has three queries if one part has three, or if parts of two and one, or three
    parts of one, meet; so each part is added to the levels reached before it. The order of the parts does not matter.
    """
    kept = [c for c in ("active", "positive", "negative", "seen", "eligible") if c in words.columns]
    aggregates = [F.bit_or(c).alias(c) for c in kept]
    if "one" not in words.columns:
        return words.groupBy(*by, "word").agg(*aggregates)
    parts = words.groupBy(*by, "word").agg(*aggregates, F.collect_list(F.struct("one", "two", "three")).alias("parts"), F.sum("queries").alias("queries"))
    either, both = Column.bitwiseOR, Column.bitwiseAND

    def add(a: Column, b: Column) -> Column:
        three = either(either(a["three"], b["three"]), either(both(a["two"], b["one"]), both(a["one"], b["two"])))
        return F.struct(either(a["one"], b["one"]).alias("one"), either(either(a["two"], b["two"]), both(a["one"], b["one"])).alias("two"), three.alias("three"))

    none = F.struct(*[F.lit(0).cast("long").alias(c) for c in ("one", "two", "three")])
    total = F.when(F.size("parts") == 1, F.col("parts")[0]).otherwise(F.aggregate("parts", none, add))
    return parts.select(*by, "word", *kept, total.alias("total"), "queries").select(*by, "word", *kept, "total.*", "queries")


def _count(*columns: tuple[str, str]) -> list[Column]:
    return [F.coalesce(F.sum(F.bit_count(c)), F.lit(0)).cast("long").alias(name) for c, name in columns]


def period_metrics(users: DataFrame, sessions: DataFrame, *by: str) -> DataFrame:
    """A31 from the words of a period's days, with the columns of ``periods.period_metrics``; ``by`` may name a period column to count many periods at once."""
    keys = [*by, "rollup_id"]
    people = merged(users, *keys).groupBy(*keys).agg(*_count(("active", "active_users"), ("positive", "positive_users"), ("negative", "negative_users")))
    volume = merged(sessions, *keys).groupBy(*keys).agg(*_count(("one", "sessions"), ("three", "deep_sessions")), F.sum("queries").alias("queries"))
    same = F.lit(True)
    for c in keys:
        same &= F.col(f"p.{c}").eqNullSafe(F.col(f"v.{c}"))
    return people.alias("p").join(volume.alias("v"), same).select(*[f"p.{c}" for c in keys], "active_users", "sessions", "deep_sessions", "queries", "positive_users", "negative_users")


def period_totals(users: DataFrame, sessions: DataFrame, profiles: DataFrame) -> DataFrame:
    """A33 from the words of a period's days: one row; rollups of one user or session meet in its bit."""
    people = merged(profiles).agg(*_count(("seen", "users"), ("eligible", "eligible_users")))
    active = merged(users.select("word", "active")).agg(*_count(("active", "active_users")))
    volume = sessions.groupBy("word").agg(F.bit_or("one").alias("one"), F.sum("queries").alias("queries")).agg(*_count(("one", "sessions")), F.coalesce(F.sum("queries"), F.lit(0)).cast("long").alias("queries"))
    return people.join(F.broadcast(active)).join(F.broadcast(volume))  # one row each

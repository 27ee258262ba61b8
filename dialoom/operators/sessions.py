"""Session structure, openings, retention, demand and review samples over turn tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialoom.functions import rules
from dialoom.functions.text import rate, strip


def long(c: Column) -> Column:
    return F.coalesce(c, F.lit(0)).cast("long")


def session_lengths(turns: DataFrame, *by: str) -> DataFrame:
    return turns.groupBy(*by, "cid").agg(F.count(F.lit(1)).alias("n"))


def structure_columns(n: Column) -> list[Column]:
    """Six counts and four ratios from session lengths."""
    multi, five = n >= 2, n >= 5
    sums = {"total_turns": F.sum(n), "total_sessions": F.count(F.lit(1)), "single_sessions": F.count_if(n == 1), "multi_sessions": F.count_if(multi), "multi_turns": F.sum(F.when(multi, n)), "five_plus_sessions": F.count_if(five)}
    sums = {k: long(v) for k, v in sums.items()}
    ratios = {"average_turns": ("total_turns", "total_sessions"), "multi_rate": ("multi_sessions", "total_sessions"), "multi_average_turns": ("multi_turns", "multi_sessions"), "five_plus_rate": ("five_plus_sessions", "total_sessions")}
    return [v.alias(k) for k, v in sums.items()] + [rate(sums[a], sums[b]).alias(k) for k, (a, b) in ratios.items()]


def session_structure(turns: DataFrame, *by: str) -> DataFrame:
    """A17 for the whole table or by columns."""
    lengths = session_lengths(turns, *by)
    return lengths.groupBy(*by).agg(*structure_columns(F.col("n")))


def volume_by_day(turns: DataFrame) -> DataFrame:
    """A42. The exact user count goes through a distinct pair per user and day first, so no task holds a day's users."""
    sessions = session_lengths(turns, "data_date").groupBy("data_date").agg(F.sum("n").alias("turns"), F.count(F.lit(1)).alias("sessions"))
    users = turns.select("data_date", "client_id").distinct().groupBy("data_date").agg(F.count(F.lit(1)).alias("users"))
    return sessions.join(users, "data_date")


def metric_series(turns: DataFrame) -> DataFrame:
    """Volumes and structure by day."""
    users = turns.select("data_date", "client_id").distinct().groupBy("data_date").agg(F.count(F.lit(1)).alias("users"))
    return session_structure(turns, "data_date").join(users, "data_date")


def first_turns(turns: DataFrame) -> DataFrame:
    """One row per session, its first turn by timestamp, time text and row; min_by needs no sort."""
    key = rules.row_order(F.col("timestamp"), F.col("created_at"), F.col("source_row"))
    marked = turns.withColumn("reply", F.col("is_reply").cast("int"))
    first = F.min_by(F.struct("text", "category", "response", "source_row", "reply"), key).alias("first")
    return marked.groupBy("cid").agg(F.count(F.lit(1)).alias("n"), F.sum("reply").alias("replies"), first).select("cid", "n", (F.col("replies") - F.col("first.reply")).alias("later_replies"), "first.text", "first.category", "first.response", "first.source_row")


def opening_groups(first: DataFrame, spark_domain: DataFrame) -> DataFrame:
    """A18 by first utterance category, every category of the domain."""
    out = first.groupBy("category").agg(*structure_columns(F.col("n")), F.count_if(F.col("later_replies") > 0).alias("reply_sessions"), F.count(F.lit(1)).alias("sessions"))
    total = first.agg(F.count(F.lit(1)).alias("all_sessions"))
    filled = spark_domain.join(out, "category", "left").join(F.broadcast(total))
    return filled.select("category", *[long(F.col(c)).alias(c) for c in ("sessions", "total_turns", "multi_sessions", "five_plus_sessions", "reply_sessions")],
                         rate(F.col("reply_sessions"), F.col("sessions")).alias("reply_rate"), rate(long(F.col("sessions")), F.col("all_sessions")).alias("session_share"))


def with_direction(first: DataFrame, prompt: Column) -> DataFrame:
    """X11 and X12 on placeholder sessions: key and status."""
    found = first.filter("category = 'startPrompt'").withColumn("found", rules.direction_of(prompt))
    status = F.when(F.col("found").isNull(), "unlabelled").when(F.col("found") == "unsupported", "unsupported").otherwise("classified")
    return found.withColumn("status", status).withColumn("direction", F.when(status == "classified", F.col("found")))


def opening_directions(directed: DataFrame, domain: DataFrame) -> DataFrame:
    """All ten keys; shares over placeholder sessions."""
    total = directed.agg(F.count(F.lit(1)).alias("prompts"))
    counted = directed.filter("direction is not null").groupBy("direction").agg(F.count(F.lit(1)).alias("sessions"), F.sum("n").alias("turns"), F.count_if(F.col("later_replies") > 0).alias("reply_sessions"))
    out = domain.join(counted, "direction", "left").join(F.broadcast(total))
    return out.select("direction", *[long(F.col(c)).alias(c) for c in ("sessions", "turns", "reply_sessions")], rate(long(F.col("sessions")), F.col("prompts")).alias("share"))


def direction_coverage(directed: DataFrame) -> DataFrame:
    """A20."""
    counts = {s: F.count_if(F.col("status") == s) for s in ("classified", "unlabelled", "unsupported")}
    return directed.agg(*[v.alias(k) for k, v in counts.items()], rate(counts["classified"], F.count(F.lit(1))).alias("coverage"))


def opening_diagnostics(first: DataFrame, norm: Column) -> DataFrame:
    """A21."""
    return first.agg(F.count_if(strip(F.col("text")) == "").alias("empty_first"), F.count_if(norm.isin(*rules.SYSTEM_HINTS)).alias("hint_first"))


def raw_row_check(first: DataFrame, raw: DataFrame) -> DataFrame:
    """First rows whose raw row is missing or belongs to another session."""
    other = raw.select(F.col("source_row"), F.col("cid").alias("raw_cid"))
    return first.join(other, "source_row", "left").filter(~F.col("cid").eqNullSafe(F.col("raw_cid"))).select("cid", "source_row", "raw_cid")


def key_overlap(one: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """How many distinct keys of one table the other has."""
    return one.select(key).distinct().join(other.select(key).distinct(), key, "left_semi").agg(F.count(F.lit(1)).alias("overlap"))


def first_seen(active: DataFrame) -> DataFrame:
    return active.groupBy("user").agg(F.min("data_date").alias("first_date"))


def daily_active(active: DataFrame) -> DataFrame:
    """A22 from distinct (user, data_date)."""
    joined = active.join(first_seen(active), "user")
    fresh = F.count_if(F.col("data_date") == F.col("first_date"))
    return joined.groupBy("data_date").agg(F.count(F.lit(1)).alias("active_users"), fresh.alias("first_observed_users"), (F.count(F.lit(1)) - fresh).alias("returning_users"))


def retention(active: DataFrame, covered: DataFrame, lags: tuple[int, ...] = (1, 7)) -> DataFrame:
    """Cohorts by first day; a rate only if all days of its window are covered, the observed rate always.

    One equi-join of users to their first day answers every lag; covered days are counted per cohort day by a range of at most max(lags) + 1 dates.
    """
    joined = active.join(first_seen(active), "user")
    gap = F.datediff("data_date", "first_date")
    cohorts = joined.groupBy("first_date").agg(F.count_if(gap == 0).alias("users"), *[F.count_if(gap == lag).alias(f"d{lag}_observed") for lag in lags])
    offsets = covered.select("data_date").distinct().select(F.col("data_date").alias("covered_date"), F.explode(F.sequence(F.lit(0), F.lit(max(lags)))).alias("back"))
    days = offsets.select(F.date_sub("covered_date", F.col("back")).alias("first_date"), "back").groupBy("first_date").agg(*[F.count_if(F.col("back") <= lag).alias(f"d{lag}_covered") for lag in lags])
    out = cohorts.join(days, "first_date", "left")
    columns = ["first_date", "users"]
    for lag in lags:
        observed = rate(F.col(f"d{lag}_observed"), F.col("users"))
        columns += [F.col(f"d{lag}_observed"), observed.alias(f"d{lag}_observed_rate"), F.when(F.coalesce(f"d{lag}_covered", F.lit(0)) == lag + 1, observed).alias(f"d{lag}_rate")]
    return out.select(*columns)


def active_days(active: DataFrame, last: Column) -> DataFrame:
    """How many users were active on 1 to 7 of the last seven days."""
    week = active.join(F.broadcast(active.agg(last.alias("last_date")))).filter(F.datediff("last_date", "data_date") < 7)
    counted = week.groupBy("user").agg(F.count(F.lit(1)).alias("days")).groupBy("days").agg(F.count(F.lit(1)).alias("users"))
    domain = active.sparkSession.range(1, 8).select(F.col("id").alias("days"))
    return domain.join(counted, "days", "left").select("days", long(F.col("users")).alias("users"))


def week_coverage(active: DataFrame, covered: DataFrame, last: Column) -> DataFrame:
    """How many of the last seven days have rows, and whether all seven are declared complete."""
    end = active.agg(last.alias("last_date"))
    near = lambda days: days.select("data_date").distinct().join(F.broadcast(end)).filter(F.datediff("last_date", "data_date").between(0, 6))  # noqa: E731  (end is one row)
    seen, whole = near(active).agg(F.count(F.lit(1)).alias("covered_days")), near(covered).agg((F.count(F.lit(1)) == 7).alias("week_complete"))
    return seen.join(F.broadcast(whole))


def confirm_coverage(cohorts: DataFrame, covered: DataFrame, lags: tuple[int, ...] = (1, 7)) -> DataFrame:
    """The rates of stored cohorts (``retention``) anew, after more days were declared complete; observed counts stay as they are."""
    days = covered.select("data_date").distinct().select(F.col("data_date").alias("covered_date"), F.explode(F.sequence(F.lit(0), F.lit(max(lags)))).alias("back"))
    days = days.select(F.date_sub("covered_date", F.col("back")).alias("first_date"), "back").groupBy("first_date").agg(*[F.count_if(F.col("back") <= lag).alias(f"d{lag}_days") for lag in lags])
    out = cohorts.join(days, "first_date", "left")
    for lag in lags:
        out = out.withColumn(f"d{lag}_rate", F.when(F.coalesce(f"d{lag}_days", F.lit(0)) == lag + 1, F.col(f"d{lag}_observed_rate"))).drop(f"d{lag}_days")
    return out


def volume_check(volume: DataFrame, structure: DataFrame) -> DataFrame:
    """A42 against A17: days on which turns or sessions differ."""
    other = structure.select("data_date", F.col("total_turns").alias("t"), F.col("total_sessions").alias("s"))
    both = volume.join(other, "data_date", "full_outer")
    return both.filter(~F.col("turns").eqNullSafe(F.col("t")) | ~F.col("sessions").eqNullSafe(F.col("s"))).select("data_date", "turns", "t", "sessions", "s")


def intent_demand(turns: DataFrame, label: str) -> DataFrame:
    """Users, sessions and turns by label; penetration over all users. Two-level, so a hot label is split by session first."""
    pairs = turns.repartition(label, "client_id").groupBy(label, "client_id", "cid").agg(F.count(F.lit(1)).alias("turns"))
    users = pairs.groupBy(label, "client_id").agg(F.sum("turns").alias("turns"), F.count(F.lit(1)).alias("sessions"))
    out = users.groupBy(label).agg(F.count(F.lit(1)).alias("users"), F.sum("sessions").alias("sessions"), F.sum("turns").alias("turns"))
    total = turns.select("client_id").distinct().agg(F.count(F.lit(1)).alias("total"))
    return out.join(F.broadcast(total)).select(label, "users", "sessions", "turns", rate(F.col("users"), F.col("total")).alias("penetration"))


def hash_sample(rows: DataFrame, key: Column, n: int, seed: str) -> DataFrame:
    """N rows by the smallest seeded hash, with the inclusion probability."""
    total = rows.agg(F.count(F.lit(1)).alias("population"))
    picked = rows.withColumn("draw", F.sha2(F.concat(F.lit(seed), key), 256)).orderBy("draw").limit(n)
    return picked.join(F.broadcast(total)).withColumn("probability", F.least(F.lit(1.0), F.lit(float(n)) / F.col("population")))


def stratified_sample(rows: DataFrame, strata: str, key: str, n: int, seed: str) -> DataFrame:
    """The n smallest hashes of every stratum; a row keeps all strata that drew it.

    A stratum may hold most rows, so each is first cut to its n best per hash bucket; the final rank then sees 64 n rows at most.
    """
    drawn = rows.select(F.col(key), F.explode(strata).alias("stratum")).withColumn("draw", F.sha2(F.concat(F.lit(seed), F.col(key).cast("string")), 256))
    near = drawn.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(64)))
    first = near.withColumn("r", F.row_number().over(Window.partitionBy("stratum", "bucket").orderBy("draw"))).filter(F.col("r") <= n)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("stratum").orderBy("draw"))).filter(F.col("rank") <= n).select(key, "stratum", "rank")


def strata_population(rows: DataFrame, strata: str) -> DataFrame:
    """A29."""
    return rows.select(F.explode(strata).alias("stratum")).groupBy("stratum").agg(F.count(F.lit(1)).alias("population"))


def strata_coverage(rows: DataFrame, strata: str, key: str, sampled: DataFrame, reviewed: DataFrame) -> DataFrame:
    """Population, sampled and reviewed rows of every stratum; the two tables hold keys."""
    marked = rows.select(key, F.explode(strata).alias("stratum"))
    for name, keys in (("is_sampled", sampled), ("is_reviewed", reviewed)):
        marked = marked.join(keys.select(key).distinct().withColumn(name, F.lit(True)), key, "left")
    return marked.groupBy("stratum").agg(F.count(F.lit(1)).alias("population"), F.count("is_sampled").alias("sampled"), F.count("is_reviewed").alias("reviewed"))


def transcripts(turns: DataFrame, sampled: DataFrame) -> DataFrame:
    """The ordered turns of sampled sessions as JSON."""
    rows = turns.join(sampled.select("cid"), "cid", "left_semi")
    listed = F.array_sort(F.collect_list(F.struct("turn_index", "source_row", "text")))
    return rows.groupBy("cid").agg(F.to_json(listed).alias("transcript"), F.count(F.lit(1)).alias("turns"))


def previous_turn(turns: DataFrame) -> DataFrame:
    """W2."""
    w = Window.partitionBy("client_id", "cid").orderBy("source_row")
    return turns.withColumns({"previous_text": F.lag("text").over(w), "previous_ai_text": F.lag("ai_text").over(w)})

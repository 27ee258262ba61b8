"""Daily contributions, periods, history baselines, comparison of days, definitions and dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialoom.functions.text import change_ratio, growth, rate, sample_label


def contribution_users(profiles: DataFrame, *dimensions: str) -> DataFrame:
    """(data_date, client_id, dimensions, eligible)."""
    return profiles.select("data_date", "client_id", *dimensions, "eligible")


def contribution_hits(mentions: DataFrame, members: DataFrame) -> DataFrame:
    """(data_date, client_id, rollup_id, cid): queries, initiated, continued, polarities; a query counts once per rollup."""
    joined = mentions.join(members, "entity_id")
    joined = joined.repartition("data_date", "client_id", "rollup_id", "cid")  # serves both groupings
    queries = joined.groupBy("data_date", "client_id", "rollup_id", "cid", "query").agg(F.bool_or(F.col("signal") == "initiation").alias("initiated"), F.bool_or(F.col("signal") == "continuation").alias("continued"), F.collect_set("polarity").alias("polarities"))
    return queries.groupBy("data_date", "client_id", "rollup_id", "cid").agg(F.count(F.lit(1)).alias("queries"), F.bool_or("initiated").alias("initiated"), F.bool_or("continued").alias("continued"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("polarities")))).alias("polarities"))


def union_days(*days: DataFrame) -> DataFrame:
    """The rows of several days' tables; a table that lacks a column has nulls there. A day that comes twice is an error of the caller (``audit.identity``)."""
    out = days[0]
    for more in days[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def repaired(stored: DataFrame, daily: DataFrame, key: str, value: str, users: str) -> tuple[DataFrame, DataFrame]:
    """Stored rows with baseline, change and sample label computed anew from the daily table, and the rows (key, data_date, columns) that this changed."""
    right = with_baseline(daily, daily, key, value).withColumn("sample", sample_label(F.col(users)))
    columns = [c for c in stored.columns if c in right.columns]
    right = right.select(*columns)
    return right, changed(stored.select(*columns), right, [key, "data_date"])


def in_period(rows: DataFrame, period: str, value: str | None = None) -> DataFrame:
    """A day, a month (YYYY-MM) or all; a plain filter on the partition column."""
    if period == "all":
        return rows
    if period == "day":
        return rows.filter(F.col("data_date") == F.lit(value).cast("date"))
    first = F.lit(f"{value}-01").cast("date")
    return rows.filter((F.col("data_date") >= first) & (F.col("data_date") < F.add_months(first, 1)))


def period_metrics(hits: DataFrame) -> DataFrame:
    """Per rollup the distinct active users, sessions, deep sessions (queries of a session summed over days) and users with a positive or negative mark."""
    dealt = hits.repartition("rollup_id", "client_id")  # serves both levels of grouping below it
    sessions = dealt.groupBy("rollup_id", "client_id", "cid").agg(F.sum("queries").alias("queries"), F.bool_or(F.col("initiated") | F.col("continued")).alias("active"), F.bool_or(F.array_contains("polarities", "positive")).alias("pos"), F.bool_or(F.array_contains("polarities", "negative")).alias("neg"))
    users = sessions.groupBy("rollup_id", "client_id").agg(F.sum("queries").alias("queries"), F.count(F.lit(1)).alias("sessions"), F.count_if(F.col("queries") >= 3).alias("deep"), F.bool_or("active").alias("active"), F.bool_or("pos").alias("pos"), F.bool_or("neg").alias("neg"))
    return users.groupBy("rollup_id").agg(F.count_if("active").alias("active_users"), F.sum("sessions").alias("sessions"), F.sum("deep").alias("deep_sessions"), F.sum("queries").alias("queries"), F.count_if("pos").alias("positive_users"), F.count_if("neg").alias("negative_users"))


def latest_profiles(users: DataFrame, *dimensions: str) -> DataFrame:
    """A user is placed by the latest day, nulls included, and eligible if ever eligible."""
    last = F.max_by(F.struct(*dimensions), "data_date").alias("last")
    return users.groupBy("client_id").agg(last, F.bool_or("eligible").alias("eligible")).select("client_id", *[F.col(f"last.{d}").alias(d) for d in dimensions], "eligible")


def period_groups(latest: DataFrame, dimension: str) -> DataFrame:
    """Group sizes; the largest one is marked as default."""
    sizes = latest.filter(F.col(dimension).isNotNull()).groupBy(dimension).agg(F.count(F.lit(1)).alias("users"), F.count_if("eligible").alias("eligible_users"))
    best = sizes.agg(F.max_by(F.col(dimension), F.struct("eligible_users", "users", F.col(dimension))).alias("best"))
    return sizes.join(F.broadcast(best)).select(dimension, "users", "eligible_users", (F.col(dimension) == F.col("best")).alias("is_default"))


def period_totals(latest: DataFrame, hits: DataFrame) -> DataFrame:
    """Users, eligible users, active users, sessions and queries of a period."""
    people = latest.agg(F.count(F.lit(1)).alias("users"), F.count_if("eligible").alias("eligible_users"))
    active = hits.filter(F.col("initiated") | F.col("continued")).select("client_id").distinct().agg(F.count(F.lit(1)).alias("active_users"))
    volume = hits.groupBy("client_id", "cid").agg(F.sum("queries").alias("q")).agg(F.count(F.lit(1)).alias("sessions"), F.sum("q").alias("queries"))
    return people.join(F.broadcast(active)).join(F.broadcast(volume))


def period_coverage(metrics: DataFrame, totals: DataFrame) -> DataFrame:
    """Coverage per rollup over the period's eligible users."""
    return metrics.join(F.broadcast(totals.select("eligible_users"))).withColumn("coverage", rate(F.col("active_users"), F.col("eligible_users")))


def with_baseline(daily: DataFrame, observed: DataFrame, key: str, value: str, back: int = 7, every_day: bool = False) -> DataFrame:
    """Per (key, data_date) the mean of the days before it, all days of a batch in one job.

    ``observed`` lists the days that exist; a row missing on an observed day counts 0, a missing day counts nothing. With ``every_day`` a
    baseline exists only if the key was present on each observed day. The range join is an equi-join: a past row is
    copied to the ``back`` days that look at it.
    """
    ahead = F.explode(F.sequence(F.lit(1), F.lit(back))).alias("ahead")
    past = daily.select(key, "data_date", F.col(value).alias("_v"), ahead).groupBy(key, F.date_add("data_date", F.col("ahead")).alias("data_date")).agg(F.sum("_v").alias("past_sum"), F.count("_v").alias("past_days"))
    days = observed.select("data_date").distinct().select("data_date", ahead).groupBy(F.date_add("data_date", F.col("ahead")).alias("data_date")).agg(F.count(F.lit(1)).alias("observed_days"))
    out = daily.join(past, [key, "data_date"], "left").join(days, "data_date", "left")
    present = F.coalesce("past_days", F.lit(0)) == F.col("observed_days") if every_day else F.lit(True)
    base = F.when(present, rate(F.coalesce("past_sum", F.lit(0)), F.col("observed_days")))
    return out.select(key, "data_date", value, F.coalesce("observed_days", F.lit(0)).cast("long").alias("observed_days"), base.alias("baseline"), change_ratio(F.col(value), base).alias("change"), growth(F.col(value), base).alias("growth"))


def compare_days(series: DataFrame, start: str, end: str, volumes: list[str], ratios: list[str]) -> DataFrame:
    """One row per metric with both values and the change, relative for volumes and absolute for ratios."""
    pick = lambda day, p: series.filter(F.col("data_date") == F.lit(day).cast("date")).select(*[F.col(c).cast("double").alias(f"{p}_{c}") for c in [*volumes, *ratios]])
    both = pick(start, "a").join(F.broadcast(pick(end, "b")))
    rows = [F.struct(F.lit(c).alias("metric"), F.col(f"a_{c}").alias("start_value"), F.col(f"b_{c}").alias("end_value"), (change_ratio(F.col(f"b_{c}"), F.col(f"a_{c}")) if c in volumes else F.col(f"b_{c}") - F.col(f"a_{c}")).alias("change")) for c in [*volumes, *ratios]]
    return both.select(F.inline(F.array(*rows)))


def two_factor(pairs: DataFrame) -> DataFrame:
    """The change of turns split into sessions and depth by midpoints; columns a_/b_ turns, sessions, average_turns."""
    sessions = (F.col("b_sessions") - F.col("a_sessions")) * (F.col("a_average_turns") + F.col("b_average_turns")) / 2
    depth = (F.col("b_average_turns") - F.col("a_average_turns")) * (F.col("a_sessions") + F.col("b_sessions")) / 2
    total = (F.col("b_turns") - F.col("a_turns")).cast("double")
    share = lambda x: F.try_divide(x, F.nullif(total, F.lit(0.0)))
    return pairs.select("data_date", "previous_date", total.cast("long").alias("total_delta"), (F.round(sessions, 6) + 0.0).alias("sessions_part"), (F.round(depth, 6) + 0.0).alias("depth_part"), share(sessions).alias("sessions_share"), share(depth).alias("depth_share"))


def previous_comparable(series: DataFrame, *by: str) -> DataFrame:
    """Each day with the latest earlier day of the same keys that has sessions. One row per day and key goes through the window."""
    w = Window.partitionBy(*by).orderBy("data_date").rowsBetween(Window.unboundedPreceding, -1)
    other = [c for c in series.columns if c not in by]
    last = F.last(F.when(F.col("total_sessions") > 0, F.struct(*other)), ignorenulls=True).over(w)
    return series.withColumn("previous", last)


def definition_families(days: DataFrame, definition: Column) -> DataFrame:
    """Days of the newest definition are included, others excluded."""
    marked = days.withColumn("definition", definition)
    newest = marked.groupBy("product").agg(F.max_by("definition", F.struct("data_date", "definition")).alias("newest"))
    return marked.join(F.broadcast(newest), "product").withColumn("included", F.col("definition") == F.col("newest"))


def missing_dates(days: DataFrame) -> DataFrame:
    """Dates between the first and last day of a product without a row."""
    span = days.groupBy("product").agg(F.min("data_date").alias("a"), F.max("data_date").alias("b")).select("product", F.explode(F.sequence("a", "b")).alias("data_date"))
    return span.join(days.select("product", "data_date").distinct(), ["product", "data_date"], "left_anti")


def latest_date(days: DataFrame) -> DataFrame:
    """T4."""
    return days.groupBy("product").agg(F.max("data_date").alias("latest_date"), F.count_distinct("data_date").alias("dates"))


def alignment(base: DataFrame, interest: DataFrame) -> DataFrame:
    """Base and interest tables per product and date: available, missing, matched, mismatch."""
    one, two = base.select("product", "data_date", F.col("digest").alias("base_digest"), F.lit(1).alias("b")), interest.select("product", "data_date", F.col("digest").alias("interest_digest"), F.lit(1).alias("i"))
    both = one.join(two, ["product", "data_date"], "full_outer")
    state = F.when(F.col("b").isNull(), "base_missing").when(F.col("i").isNull(), "interest_missing").when(F.col("base_digest").isNull() | F.col("interest_digest").isNull(), "not_recorded").when(F.col("base_digest") == F.col("interest_digest"), "matched").otherwise("mismatch")
    return both.select("product", "data_date", state.alias("state"))


def table_digest(rows: DataFrame, *by: str) -> DataFrame:
    """A digest that does not depend on row order: the sum of row hashes and the count."""
    columns = [c for c in rows.columns if c not in by]
    return rows.groupBy(*by).agg(F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("hash_sum"), F.count(F.lit(1)).alias("rows"))


def stale(derived: DataFrame, base: DataFrame) -> DataFrame:
    """Derived days whose recorded digest differs from the base table's, or whose base is gone."""
    other = base.select("product", "data_date", F.col("digest").alias("base_digest"))
    return derived.join(other, ["product", "data_date"], "left").filter(~F.col("digest").eqNullSafe(F.col("base_digest"))).select("product", "data_date")


def changed(one: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that differ between two versions of a table, with both sides as JSON; equal tables give none."""
    values = [c for c in one.columns if c not in keys]
    side = lambda df, name: df.select(*keys, F.struct(*values).alias(name))
    both = side(one, "old").join(side(other, "new"), keys, "full_outer")
    return both.filter(~F.col("old").eqNullSafe(F.col("new"))).select(*keys, F.to_json("old").alias("old"), F.to_json("new").alias("new"))


def same_rows(one: DataFrame, other: DataFrame) -> bool:
    """Whether a write would change nothing."""
    columns = sorted(one.columns)
    one, other = one.select(*columns), other.select(*columns)
    return one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()

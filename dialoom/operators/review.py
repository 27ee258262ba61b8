"""Review outcomes, semantic scores, profile and intent sections, risk figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.functions.text import rate, sample_label

OUTCOMES = ("complete", "partial", "unmet", "unknown")


def review_outcomes(rows: DataFrame) -> DataFrame:
    """Per demand type the outcome counts, users, unmet users and completion over what could be decided."""
    per_user = rows.groupBy("demand", "client_id").agg(*[F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES])
    decided = F.sum("complete") + F.sum("partial") + F.sum("unmet")
    return per_user.groupBy("demand").agg(*[F.sum(o).alias(o) for o in OUTCOMES], F.count(F.lit(1)).alias("users"), F.count_if(F.col("unmet") > 0).alias("unmet_users"), rate(F.sum("complete"), decided).alias("completion"))


def semantic_scores(rows: DataFrame, fields: list[tuple[str, str]], gold: str, predicted: str) -> DataFrame:
    """Accuracy per (gold, predicted) column pair; micro precision and recall of the entity sets."""
    hits, g, p = F.sum(F.size(F.array_intersect(gold, predicted))), F.sum(F.size(F.array_distinct(gold))), F.sum(F.size(F.array_distinct(predicted)))
    accuracy = [rate(F.count_if(F.col(a).eqNullSafe(F.col(b))), F.count(F.lit(1))).alias(f"{b}_accuracy") for a, b in fields]
    return rows.agg(F.count(F.lit(1)).alias("rows"), *accuracy, hits.alias("true_positives"), rate(hits, p).alias("precision"), rate(hits, g).alias("recall"))


def same_aligned(keys_a: Column, values_a: Column, keys_b: Column, values_b: Column) -> Column:
    """Aligned label lists that agree in any order."""
    pairs = lambda k, v: F.array_sort(F.arrays_zip(k.alias("k"), v.alias("v")))
    return pairs(keys_a, values_a) == pairs(keys_b, values_b)


def sealed_join(sample: DataFrame, returned: DataFrame, key: str, fixed: list[str]) -> DataFrame:
    """Violations of 'every sampled row comes back once with unchanged fixed columns'."""
    twice = returned.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    back = returned.dropDuplicates([key]).select(key, *[F.col(c).alias(f"r_{c}") for c in fixed], F.lit(1).alias("returned")).join(twice, key)
    both = sample.select(key, *fixed, F.lit(1).alias("sampled")).join(back, key, "full_outer")
    same = F.lit(True)
    for c in fixed:
        same &= F.col(c).eqNullSafe(F.col(f"r_{c}"))
    problem = F.when(F.col("returned").isNull(), "missing").when(F.col("sampled").isNull(), "unknown").when(F.col("n") > 1, "repeated").when(~same, "changed")
    return both.select(key, problem.alias("problem")).filter("problem is not null")


def difficulty_totals(rows: DataFrame) -> DataFrame:
    """A38."""
    return rows.groupBy("difficulty").agg(F.sum("exposures").alias("exposures"), F.sum("opened").alias("opened"), rate(F.sum("opened"), F.sum("exposures")).alias("open_rate"))


def profile_section(sessions: DataFrame, label: str) -> DataFrame:
    """A39 from (client_id, label, n): users, their share (over at least 1), sessions, turns, mean depth, share of five turns or more, label of the sample."""
    users = sessions.groupBy(label, "client_id").agg(F.count(F.lit(1)).alias("sessions"), F.sum("n").alias("turns"), F.count_if(F.col("n") >= 5).alias("five"))
    out = users.groupBy(label).agg(F.count(F.lit(1)).alias("users"), F.sum("sessions").alias("sessions"), F.sum("turns").alias("turns"), F.sum("five").alias("five_plus"))
    total = out.agg(F.sum("users").alias("all_users"))
    least = lambda c: F.greatest(F.lit(1), F.col(c))
    return out.join(F.broadcast(total)).select(label, "users", rate(F.col("users"), least("all_users")).alias("share"), "sessions", "turns", rate(F.col("turns"), least("sessions")).alias("average_turns"),
                                               rate(F.col("five_plus"), least("sessions")).alias("five_plus_share"), sample_label(F.col("users")).alias("sample"))


def intent_shares(rows: DataFrame, label: str) -> DataFrame:
    """Count and share by label."""
    counted = rows.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    total = counted.agg(F.sum("rows").alias("all_rows"))
    return counted.join(F.broadcast(total)).select(label, "rows", rate(F.col("rows"), F.col("all_rows")).alias("share"))


def share_comparison(rows: DataFrame, ending: DataFrame, label: str) -> DataFrame:
    """Shares in all rows and in ending rows, and their difference; labels of either side."""
    one = intent_shares(rows, label).select(label, F.col("rows").alias("all_count"), F.col("share").alias("all_share"))
    two = intent_shares(ending, label).select(label, F.col("rows").alias("ending_count"), F.col("share").alias("ending_share"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    both = one.join(two, label, "full_outer").select(label, zero("all_count"), F.coalesce("all_share", F.lit(0.0)).alias("all_share"), zero("ending_count"), F.coalesce("ending_share", F.lit(0.0)).alias("ending_share"))
    return both.withColumn("difference", F.col("ending_share") - F.col("all_share"))


def risk_summary(flags: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Per risk (name -> 'flag' or 'events' column) the count over rows, and users with any flag over all users."""
    counts = [F.coalesce(F.sum(F.col(c).cast("long")), F.lit(0)).alias(name) for name, c in columns.items()]
    rows = flags.agg(F.count(F.lit(1)).alias("rows"), *counts)
    any_flag = F.greatest(*[F.col(c).cast("int") for c in columns.values()]) > 0
    users = flags.groupBy("client_id").agg(F.max(any_flag.cast("int")).alias("flagged")).agg(F.count(F.lit(1)).alias("users"), F.sum("flagged").alias("candidate_users"))
    out = rows.join(F.broadcast(users))
    return out.select("rows", *columns, *[rate(F.col(n), F.col("rows")).alias(f"{n}_rate") for n in columns], "users", "candidate_users", rate(F.col("candidate_users"), F.col("users")).alias("candidate_user_rate"))

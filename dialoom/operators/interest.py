"""Interest metrics over mention tables (entity_id, client_id, cid, query, signal, polarity).

Distinct counts are taken by grouping to the finest key first and counting rows above it, so no task ever holds the
users of a popular entity, and Catalyst needs no Expand for several distincts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialoom.functions.text import rate, sample_label, valid_if

ACTIVE = ("initiation", "continuation")
POLARITIES = ("positive", "negative", "mixed", "neutral")
METRICS = ("mention_users", "initiators", "continuers", "active_users", "queries", "sessions", "deep_sessions")


def entity_metrics(mentions: DataFrame, key: str = "entity_id", *by: str) -> DataFrame:
    """A3, A4: per entity the distinct queries, users, sessions, initiators, continuers, active users, deep sessions (three queries or more) and their share, 0 without sessions."""
    keys = [*by, key]
    has = {s: F.max((F.col("signal") == s).cast("int")).alias(s) for s in ACTIVE}
    dealt = mentions.repartition(*keys, "client_id")  # serves all three levels of grouping below it
    queries = dealt.groupBy(*keys, "client_id", "cid", "query").agg(*has.values())
    sessions = queries.groupBy(*keys, "client_id", "cid").agg(F.count(F.lit(1)).alias("queries"), *[F.max(s).alias(s) for s in ACTIVE])
    users = sessions.groupBy(*keys, "client_id").agg(F.sum("queries").alias("queries"), F.count(F.lit(1)).alias("sessions"), F.count_if(F.col("queries") >= 3).alias("deep"), *[F.max(s).alias(s) for s in ACTIVE])
    out = users.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("mention_users"), F.sum("initiation").cast("long").alias("initiators"), F.sum("continuation").cast("long").alias("continuers"),
        F.count_if((F.col("initiation") == 1) | (F.col("continuation") == 1)).alias("active_users"), F.sum("queries").alias("queries"), F.sum("sessions").alias("sessions"), F.sum("deep").alias("deep_sessions"),
    )
    return out.withColumn("deep_rate", F.coalesce(rate(F.col("deep_sessions"), F.col("sessions")), F.lit(0.0)))


def polarity_users(mentions: DataFrame, key: str = "entity_id") -> DataFrame:
    """A5: distinct users per polarity."""
    users = mentions.groupBy(key, "client_id").agg(*[F.max((F.col("polarity") == p).cast("int")).alias(p) for p in POLARITIES])
    return users.groupBy(key).agg(*[F.sum(p).cast("long").alias(f"{p}_users") for p in POLARITIES])


def ranked(metrics: DataFrame, key: str) -> DataFrame:
    """Rank by active users, mentions, queries, id. The window runs over one row per entity of the dictionary."""
    order = Window.orderBy(F.desc("active_users"), F.desc("mention_users"), F.desc("queries"), key)
    return metrics.withColumn("rank", F.row_number().over(order))


def top(metrics: DataFrame, key: str, n: int) -> DataFrame:
    return metrics.orderBy(F.desc("active_users"), F.desc("mention_users"), F.desc("queries"), key).limit(n)


def by_visibility(metrics: DataFrame, entities: DataFrame, visibility: str) -> DataFrame:
    """A6, T6."""
    return metrics.join(entities.filter(F.col("visibility") == visibility).select("entity_id"), "entity_id", "left_semi")


def rollup_metrics(mentions: DataFrame, members: DataFrame) -> DataFrame:
    """The same metrics deduplicated over a family; number of its other members."""
    joined = mentions.join(members, "entity_id")
    children = members.filter("rollup_id != entity_id").groupBy("rollup_id").agg(F.count(F.lit(1)).alias("children"))
    out = entity_metrics(joined, "rollup_id").join(children, "rollup_id", "left")
    return out.withColumn("children", F.coalesce("children", F.lit(0)).cast("long"))


def structure_metrics(mentions: DataFrame, entities: DataFrame, *columns: str) -> DataFrame:
    """Metrics by dictionary columns."""
    joined = mentions.join(entities.select("entity_id", *columns), "entity_id")
    return entity_metrics(joined, columns[-1], *columns[:-1])


def totals(turns: DataFrame, mentions: DataFrame, public: DataFrame) -> DataFrame:
    """A2: rows, content rows, queries with a public entity, active users."""
    seen = mentions.join(public.select("entity_id"), "entity_id", "left_semi")
    queries = seen.select("query").distinct().agg(F.count(F.lit(1)).alias("entity_queries"))
    users = seen.filter(F.col("signal").isin(*ACTIVE)).select("client_id").distinct().agg(F.count(F.lit(1)).alias("active_users"))
    rows = turns.agg(F.count(F.lit(1)).alias("input_rows"), F.count_if("is_content").alias("content_rows"))
    return rows.join(F.broadcast(queries)).join(F.broadcast(users))


def domain_counts(rows: DataFrame, column: str, domain: DataFrame) -> DataFrame:
    """A1: counts over a fixed domain, zero-filled, with the share of all counted rows (0 over zero)."""
    counted = rows.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    total = rows.agg(F.count(F.lit(1)).alias("all_rows"))
    out = domain.join(counted, column, "left").join(F.broadcast(total))
    count = F.coalesce("rows", F.lit(0)).cast("long")
    return out.select(column, count.alias("rows"), F.coalesce(rate(count, F.col("all_rows")), F.lit(0.0)).alias("share"))


def with_region(turns: DataFrame, cities: DataFrame, city: str = "city_normalized", status: str = "city_status") -> DataFrame:
    """region_id of a city with a normal status, and whether such a city has no region; ``cities`` (city, region_id) is joined by size."""
    valid = valid_if(F.col(city), F.col(status))
    named = cities.select(F.col("city").alias("mapped_city"), F.col("region_id").alias("mapped_region"))
    joined = turns.withColumn("valid_city", valid).join(named, F.col("valid_city") == F.col("mapped_city"), "left")
    return joined.withColumns({"region_id": F.col("mapped_region"), "unmapped": F.col("valid_city").isNotNull() & F.col("mapped_region").isNull()}).drop("valid_city", "mapped_city", "mapped_region")


def stable_profile(turns: DataFrame, dimensions: list[str], eligible: Column, unmapped: Column | None = None) -> DataFrame:
    """A dimension survives if it is valid and equal on all rows of the user."""
    kept = [F.when((F.min(d) == F.max(d)) & (F.count(d) == F.count(F.lit(1))), F.min(d)).alias(d) for d in dimensions]
    extra = [] if unmapped is None else [F.bool_or(unmapped).alias("unmapped")]
    return turns.groupBy("client_id").agg(*kept, F.bool_or(eligible).alias("eligible"), *extra)


def grouping_sets(dimensions: list[str], sets: list[list[str]], rows: DataFrame, more: list[str], aggregates: list[Column]) -> DataFrame:
    """Aggregates by every dimension set in one pass; a row counts for a set only if the set's dimensions are all known."""
    of = [F.array([F.lit(d) for d in s]) for s in sets]
    wide = rows.withColumn("dims", F.explode(F.array(*of)))
    known = F.lit(True)
    for d in dimensions:
        known &= ~F.array_contains("dims", d) | F.col(d).isNotNull()
    parts = [F.when(F.array_contains("dims", d), F.col(d)).alias(d) for d in dimensions]
    wide = wide.filter(known).select(F.array_join("dims", "+").alias("dimension_set"), *parts, *[c for c in wide.columns if c not in dimensions and c != "dims"])
    return wide.groupBy("dimension_set", *dimensions, *more).agg(*aggregates)


def segment_groups(profiles: DataFrame, dimensions: list[str], sets: list[list[str]]) -> DataFrame:
    """A10: users and eligible users per group of every dimension set."""
    return grouping_sets(dimensions, sets, profiles, [], [F.count(F.lit(1)).alias("users"), F.count_if("eligible").alias("eligible_users")])


def active_pairs(mentions: DataFrame, members: DataFrame | None = None, key: str = "entity_id") -> DataFrame:
    """Distinct active (user, entity) pairs, the input of A11 and A12; distinct before the join to profiles, which keeps popular entities small."""
    active = mentions.filter(F.col("signal").isin(*ACTIVE))
    if members is not None:
        active = active.join(members, "entity_id")
    return active.select("client_id", key).distinct()


def segment_interest(pairs: DataFrame, profiles: DataFrame, dimensions: list[str], sets: list[list[str]], key: str = "entity_id") -> DataFrame:
    """Interested eligible users per group and entity."""
    joined = pairs.join(profiles.filter("eligible"), "client_id")
    return grouping_sets(dimensions, sets, joined, [key], [F.count(F.lit(1)).alias("interest_users")])


def segment_overall(pairs: DataFrame, profiles: DataFrame, dimensions: list[str], sets: list[list[str]], entities: DataFrame, key: str = "entity_id") -> DataFrame:
    """Per dimension set and entity the interested users among those whose dimensions are known, coverage, zero rows kept."""
    known = grouping_sets(dimensions, sets, profiles.filter("eligible"), [], [F.count(F.lit(1)).alias("n")]).groupBy("dimension_set").agg(F.sum("n").alias("eligible_users"))
    found = segment_interest(pairs, profiles, dimensions, sets, key).groupBy("dimension_set", key).agg(F.sum("interest_users").alias("interest_users"))
    asked = F.explode(F.array(*[F.lit("+".join(s)) for s in sets]))
    grid = entities.select(key).withColumn("dimension_set", asked).join(F.broadcast(known), "dimension_set")  # one row for each set
    out = grid.join(found, ["dimension_set", key], "left")
    users = F.coalesce("interest_users", F.lit(0)).cast("long")
    return out.select("dimension_set", key, "eligible_users", users.alias("interest_users"), rate(users, F.col("eligible_users")).alias("coverage"))


def dense_groups(groups: DataFrame, domains: dict[str, DataFrame], dimensions: list[str], dims: list[str]) -> DataFrame:
    """Every combination of one set's domains (small fixed lists), zero-filled."""
    grid = None
    for d in dims:
        grid = domains[d] if grid is None else grid.join(F.broadcast(domains[d]))
    own = groups.filter(F.col("dimension_set") == "+".join(dims)).select(*dims, "users", "eligible_users")
    out = grid.join(own, dims, "left")
    return out.select(*dims, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("users", "eligible_users")])


def dense_interest(grid: DataFrame, overall: DataFrame, counts: DataFrame, dims: list[str], key: str = "entity_id") -> DataFrame:
    """For every group and listed entity the coverage and its difference to the overall coverage."""
    name = "+".join(dims)
    listed = overall.filter(F.col("dimension_set") == name).select(key, F.col("coverage").alias("overall_coverage"))
    own = counts.filter(F.col("dimension_set") == name).select(*dims, key, "interest_users")
    out = listed.join(F.broadcast(grid)).join(own, [*dims, key], "left")  # the grid is a product of small fixed domains
    users = F.coalesce("interest_users", F.lit(0)).cast("long")
    cover = rate(users, F.col("eligible_users"))
    return out.select(*dims, key, "eligible_users", users.alias("interest_users"), cover.alias("coverage"), (cover - F.col("overall_coverage")).alias("difference"))


def age_gender_view(dense: DataFrame, labels: dict[str, str], age: str = "age", gender: str = "gender", key: str = "entity_id") -> DataFrame:
    """The age and gender view in the older shape: gender labels instead of ids, shares as coverage and points of difference, list order by group."""
    named = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    order = Window.partitionBy(age, gender).orderBy(F.desc("interest_users"), key)
    rows = dense.withColumn("position", F.row_number().over(order))
    return rows.select(age, F.coalesce(F.try_element_at(named, F.col(gender)), F.col(gender)).alias("gender_label"), key, "position", "eligible_users", "interest_users", "coverage", (F.col("difference") * 100).alias("difference_points"), sample_label(F.col("eligible_users")).alias("sample"))


def segment_query(groups: DataFrame, overall: DataFrame, counts: DataFrame, domains: dict[str, DataFrame], dimensions: list[str], dims: list[str], wanted: list[tuple]) -> DataFrame:
    """T5: one to four groups (values of ``dims``) of a set, each with every listed entity (A13, A14); a group outside the domains is an error."""
    if not 1 <= len(wanted) <= 4 or len(set(wanted)) != len(wanted):
        raise ValueError("one to four different groups")
    asked = groups.sparkSession.createDataFrame([tuple(map(str, w)) for w in wanted], ", ".join(f"{d} string" for d in dims))
    grid = dense_groups(groups, domains, dimensions, dims).join(F.broadcast(asked), dims)
    if grid.count() != len(wanted):
        raise ValueError("a group is outside the domains")
    return dense_interest(grid, overall, counts, dims, key=[c for c in overall.columns if c not in ("dimension_set", "eligible_users", "interest_users", "coverage")][0])


def segment_summary(groups: DataFrame, dims: list[str]) -> DataFrame:
    """T5: the groups of a set with users and sample label, without entity counts."""
    return groups.filter(F.col("dimension_set") == "+".join(dims)).select(*dims, "users", "eligible_users", sample_label(F.col("eligible_users")).alias("sample_status"))


def top_per_group(dense: DataFrame, dims: list[str], n: int = 10, key: str = "entity_id") -> DataFrame:
    """The n entities of every group."""
    order = Window.partitionBy(*dims).orderBy(F.desc("interest_users"), key)
    return dense.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def mapping_diagnostics(profiles: DataFrame, region: str) -> DataFrame:
    """A16."""
    return profiles.agg(F.count_if(F.col(region).isNotNull()).alias("stable_region_users"), F.count_if("unmapped").alias("unmapped_users"))

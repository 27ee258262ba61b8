"""Queries over whole audits, coverage, repairs and reports; what is wrong in the rows was put there by the query."""

from __future__ import annotations

from pyspark.sql import functions as F

from dialoom.functions import rules, text
from dialoom.functions.text import NORMAL
from dialoom.operators import audit, interest, matching, periods, sessions
from dialoom.plans import views as v
from dialoom.plans.queries import DENSE, HITS, REV, SEG, STRATA, V2A, _active, _brands, _daily, _dense, _dense_interest, _directed, _hits, _pairs, _reviewed, _strata, domain, query, rounded
from dialoom.sources import sinks

SECTION = """c AS (SELECT c_nationkey AS nation, c_mktsegment AS label, c_acctbal >= 0 AS normal FROM customer), i AS (SELECT nation, label FROM c WHERE normal GROUP BY nation, label)"""


@query(f"WITH {SECTION} SELECT 'user share' AS rule, label AS key FROM i WHERE nation % 4 = 0 UNION ALL SELECT 'average', label FROM i WHERE nation % 5 = 0 UNION ALL SELECT 'counts', CAST(nation AS VARCHAR) FROM c WHERE nation = 3 GROUP BY nation UNION ALL SELECT 'coverage', CAST(nation AS VARCHAR) FROM c WHERE nation = 3 GROUP BY nation UNION ALL SELECT 'statuses do not cover users', CAST(nation AS VARCHAR) FROM c WHERE nation = 3 GROUP BY nation")
def q_audit_p8_section(spark, d):
    c = v.table(spark, d, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("label"), F.when(F.col("c_acctbal") >= 0, NORMAL).otherwise("other").alias("status"))
    eligible, normal, nation = F.count(F.lit(1)), F.count_if(F.col("status") == NORMAL), F.col("nation")
    section = c.groupBy("nation").agg(eligible.alias("eligible_users"), normal.alias("normal_users"), (normal / F.greatest(eligible, F.lit(1))).alias("coverage"))
    statuses = c.groupBy("nation", "status").agg(F.count(F.lit(1)).alias("users"))
    items = c.filter(F.col("status") == NORMAL).groupBy("nation", "label").agg(F.count(F.lit(1)).alias("users")).join(section.select("nation", "normal_users"), "nation")
    users = F.col("users")
    items = items.select("nation", "label", "users", (users * 2).alias("sessions"), F.when(nation % 5 == 0, users * 7).otherwise(users * 5).alias("turns"), users.alias("five_plus_sessions"),
                         (users / F.col("normal_users") + F.when(nation % 4 == 0, 0.1).otherwise(0.0)).alias("user_share"), F.lit(2.5).alias("average"), F.lit(0.5).alias("five_plus_share"), text.sample_label(users).alias("sample_status"))
    spoiled = section.withColumn("eligible_users", F.when(nation == 3, 0).otherwise(F.col("eligible_users")))
    return audit.profile_section(spoiled, statuses, items, "nation")


@query("""WITH o AS (SELECT l_returnflag AS label, count(*) AS n FROM lineitem WHERE l_linestatus = 'O' GROUP BY ALL), e AS (SELECT label, n + CASE WHEN label = 'R' THEN 1 ELSE 0 END AS n FROM o UNION ALL SELECT 'X', 2)
 SELECT coalesce(o.label, e.label) AS label, o.n AS compared_rows, e.n AS own_rows FROM o FULL JOIN e ON o.label = e.label WHERE o.n IS DISTINCT FROM e.n""")
def q_audit_p10_ending(spark, d):
    counted = v.table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("label")).agg(F.count_if(F.col("l_linestatus") == "O").alias("ending_rows"))
    ending = counted.select("label", (F.col("ending_rows") + F.when((F.col("label") == "R") & (F.col("ending_rows") > 0), 1).otherwise(0)).alias("rows"))
    return audit.ending_cross_check(counted, ending.unionByName(spark.createDataFrame([("X", 2)], "label string, rows long")), "label")


@query(f"WITH {v.V2F} {v.DIRECTED} SELECT 'share' AS rule, 'birthday' AS key FROM (SELECT count(*) FROM g) UNION ALL SELECT 'directions are not the classified', CAST(count(*) FILTER (found <> 'unsupported') + 1 AS VARCHAR) FROM g")
def q_audit_p11_directions(spark, d):
    directed = _directed(spark, d)
    rows = sessions.opening_directions(directed, domain(spark, "direction", rules.DIRECTIONS))
    groups = sessions.opening_groups(v.v2_first(spark, d), domain(spark, "category", ("startPrompt", "legacyDefault", "other")))
    spoiled = rows.withColumn("sessions", F.col("sessions") + F.when(F.col("direction") == "birthday", 1).otherwise(0))
    return audit.opening_directions(spoiled, sessions.direction_coverage(directed), groups)


@query(f"WITH {SEG} SELECT 'set missing' AS rule, 'age' AS key FROM (SELECT count(*) FROM sg) UNION ALL SELECT 'entity not listed', brand FROM si WHERE dimension_set = 'age' UNION ALL SELECT 'group counts', dimension_set FROM sg WHERE gender = 'BUILDING' AND dimension_set = 'gender'")
def q_audit_p12_sets(spark, d):
    pairs, profiles = _pairs(spark, d), v.v3_profiles(spark, d)
    overall = interest.segment_overall(pairs, profiles, v.DIMS, v.SETS, _brands(spark, d), "brand").filter("dimension_set != 'age'")
    groups = interest.segment_groups(profiles, v.DIMS, v.SETS).withColumn("users", F.when((F.col("dimension_set") == "gender") & (F.col("gender") == "BUILDING"), -1).otherwise(F.col("users")))
    return audit.segment_sets(groups, overall, interest.segment_interest(pairs, profiles, v.DIMS, v.SETS, "brand"), ["+".join(s) for s in v.SETS], "brand")


@query(f"WITH {HITS} SELECT 'day sum' AS rule, rollup_id AS key FROM h GROUP BY rollup_id HAVING rollup_id LIKE '%3'")
def q_audit_p19_sums(spark, d):
    hits = _hits(spark, d).withColumn("client_id", F.sha2("client_id", 256))
    totals = hits.groupBy("rollup_id").agg((F.sum("queries") + F.when(F.col("rollup_id").endswith("3"), 1).otherwise(0)).alias("queries"))
    return audit.contributions(hits.select("client_id").distinct(), hits, v.v3_members(spark, d).select("rollup_id").distinct(), ["positive", "negative", "neutral", "mixed"], totals)


WINDOWS = ", dy AS (SELECT DISTINCT data_date FROM a), fd AS (SELECT DISTINCT first_date FROM fs), w AS (SELECT first_date, count(*) FILTER (data_date <= first_date + 1) AS all1, count(*) FILTER (data_date <= first_date + 1 AND day(data_date) <> 5) AS some1, count(*) AS all7, count(*) FILTER (day(data_date) <> 5) AS some7 FROM fd JOIN dy ON data_date BETWEEN first_date AND first_date + 7 GROUP BY first_date)"


@query(f"WITH {V2A}{WINDOWS} SELECT 'maturity' AS rule, CAST(first_date AS VARCHAR) AS key FROM w WHERE (all1 = 2) <> (some1 = 2) OR (all7 = 8) <> (some7 = 8)")
def q_audit_p24_maturity(spark, d):
    active = _active(spark, d)
    days = active.select("data_date").distinct()
    cohorts = sessions.retention(active, days.filter(F.dayofmonth("data_date") != 5))
    return audit.research_report(sessions.daily_active(active), cohorts, days)


@query(f"WITH {V2A}{WINDOWS}, c AS (SELECT first_date, count(DISTINCT usr) AS users, count(*) FILTER (data_date = first_date + 1) AS o1, count(*) FILTER (data_date = first_date + 7) AS o7 FROM a JOIN fs USING (usr) GROUP BY first_date) SELECT first_date, CASE WHEN all1 = 2 THEN round(o1 / users, 9) END AS d1_rate, CASE WHEN all7 = 8 THEN round(o7 / users, 9) END AS d7_rate FROM c JOIN w USING (first_date)")
def q_retention_confirmed(spark, d):
    active = _active(spark, d)
    days = active.select("data_date").distinct()
    stored = sessions.retention(active, days.filter(F.dayofmonth("data_date") != 5))
    return rounded(sessions.confirm_coverage(stored, days).select("first_date", "d1_rate", "d7_rate"), "d1_rate", "d7_rate")


@query(f"WITH {V2A}, n AS (SELECT DISTINCT data_date FROM a WHERE data_date > (SELECT max(data_date) FROM a) - 7) SELECT count(*) AS covered_days, count(*) FILTER (data_date <> (SELECT max(data_date) FROM a)) = 7 AS week_complete FROM n")
def q_week_coverage(spark, d):
    active = _active(spark, d)
    last = active.agg(F.max("data_date").alias("last"))
    covered = active.select("data_date").distinct().join(F.broadcast(last), F.col("data_date") != F.col("last")).drop("last")  # one row
    return sessions.week_coverage(active, covered, F.max("data_date"))


@query(f"WITH {STRATA} SELECT stratum, count(*) AS population, count(*) FILTER (doc_id % 3 = 0) AS sampled, count(*) FILTER (doc_id % 6 = 0) AS reviewed FROM st GROUP BY stratum")
def q_strata_coverage(spark, d):
    rows = _strata(spark, d)
    return sessions.strata_coverage(rows, "strata", "doc_id", rows.filter("doc_id % 3 = 0").select("doc_id"), rows.filter("doc_id % 6 = 0").select("doc_id"))


@query(f"WITH {v.V2} SELECT data_date, count(*) AS turns, count(*) + 1 AS t, count(DISTINCT cid) AS sessions, count(DISTINCT cid) AS s FROM v2 WHERE day(data_date) % 6 = 0 GROUP BY data_date")
def q_volume_check(spark, d):
    t = v.v2_turns(spark, d)
    structure = sessions.session_structure(t, "data_date")
    return sessions.volume_check(sessions.volume_by_day(t), structure.withColumn("total_turns", F.col("total_turns") + F.when(F.dayofmonth("data_date") % 6 == 0, 1).otherwise(0)))


@query("SELECT doc_id, rule FROM (SELECT doc_id, unnest([CASE WHEN source = 'src2' THEN 'entity repeated' END, CASE WHEN toxic = 1 THEN 'signals: length' END, CASE WHEN lang = 'fr' THEN 'signals: domain' END, CASE WHEN quality = 0 THEN 'provenance' END]) AS rule FROM documents JOIN labels USING (doc_id)) WHERE rule IS NOT NULL")
def q_audit_p25_aligned(spark, d):
    rows = _reviewed(spark, d)
    said = F.when(F.col("lang") == "fr", "shouted").otherwise("said")
    rows = rows.withColumns({"found": F.array(F.lit("a"), F.when(F.col("source") == "src2", "a").otherwise("b")), "signals": F.when(F.col("toxic") == 1, F.array(said)).otherwise(F.array(said, F.lit("said"))), "origin": F.when(F.col("quality") == 0, "ai").otherwise("human")})
    return audit.aligned_labels(rows, "doc_id", "found", {"signals": ["said", "asked"]}, ("origin", "human")).select(F.col("key").cast("long").alias("doc_id"), "rule")


@query(f"WITH {REV}, o AS (SELECT demand AS label, count(*) FILTER (outcome = 'complete') AS complete, count(*) AS n, count(*) FILTER (outcome = 'unknown') AS unknown FROM r GROUP BY demand) SELECT 'label' AS rule, label AS key FROM o WHERE label = 'es' UNION ALL SELECT 'outcomes', label FROM o WHERE label = 'de' UNION ALL SELECT 'completion', label FROM o WHERE label = 'fr'")
def q_audit_p24_outcomes(spark, d):
    n = lambda what: F.count_if(F.col("outcome") == what)
    rows = _reviewed(spark, d).groupBy(F.col("demand").alias("label")).agg(*[n(o).alias(o) for o in ("complete", "partial", "unmet", "unknown")], F.count(F.lit(1)).alias("reviewed_sessions"), F.count_distinct("client_id").alias("reviewed_users"))
    rows = rows.withColumn("completion", F.try_divide(F.col("complete").cast("double"), (F.col("reviewed_sessions") - F.col("unknown")).cast("double")) + F.when(F.col("label") == "fr", 0.1).otherwise(0.0))
    return audit.outcome_rows(rows.withColumn("unmet", F.col("unmet") + F.when(F.col("label") == "de", 1).otherwise(0)), ["en", "de", "fr"])


@query(f"WITH {SEG} {DENSE} SELECT 'difference' AS rule, brand AS key FROM di WHERE brand = '7' AND coverage IS NOT NULL AND overall IS NOT NULL UNION ALL SELECT 'group order', '2' FROM (SELECT count(*) FROM di) UNION ALL SELECT 'group order', '1' FROM (SELECT count(*) FROM di)")
def q_audit_p26_view(spark, d):
    from pyspark.sql import Window

    overall = interest.segment_overall(_pairs(spark, d), v.v3_profiles(spark, d), v.DIMS, v.SETS, _brands(spark, d), "brand").filter("dimension_set = 'gender+region'")
    order = Window.orderBy(F.desc("interest_users"), F.desc(F.coalesce("coverage", F.lit(0.0))), "brand")
    overall = overall.withColumn("rank", F.row_number().over(order)).drop("dimension_set")
    place = F.row_number().over(Window.orderBy("gender", "region"))
    groups = _dense(spark, d).withColumn("at", place).withColumn("position", F.when(F.col("at") == 1, 2).when(F.col("at") == 2, 1).otherwise(F.col("at"))).drop("at")
    rows = _dense_interest(spark, d).withColumn("difference", F.col("difference") + F.when(F.col("brand") == "7", 0.01).otherwise(0.0))
    return audit.demographic_view(rows, overall, groups, ["gender", "region"], "brand")


@query(f"WITH {SEG} SELECT 'gender|' || gender || '|' || brand AS key, 'interest_users' AS columns FROM si WHERE dimension_set = 'gender' AND brand = '7'")
def q_audit_p27_segments(spark, d):
    """The second computation groups each dimension set by itself instead of exploding the sets."""
    pairs, profiles = _pairs(spark, d), v.v3_profiles(spark, d)
    name = lambda dims: F.concat_ws("|", F.lit("+".join(dims)), *[F.col(x).cast("string") for x in dims], "brand").alias("key")
    first = interest.segment_interest(pairs, profiles, v.DIMS, v.SETS, "brand").select(F.concat_ws("|", "dimension_set", *[F.col(x).cast("string") for x in v.DIMS], "brand").alias("key"), "dimension_set", "brand", "interest_users")
    first = first.select("key", (F.col("interest_users") + F.when((F.col("dimension_set") == "gender") & (F.col("brand") == "7"), 1).otherwise(0)).alias("interest_users"))
    joined, again = pairs.join(profiles.filter("eligible"), "client_id"), None
    for dims in v.SETS:
        rows = joined.dropna(subset=dims).groupBy(*dims, "brand").agg(F.count_distinct("client_id").alias("interest_users")).select(name(dims), "interest_users")
        again = rows if again is None else again.unionByName(rows)
    return audit.compared(first, again, ["key"])


P15 = f"{v.V3}, e AS (SELECT entity_id, count(DISTINCT query) AS q FROM m GROUP BY entity_id)"


@query(f"WITH {P15} SELECT 'entities' AS \"table\", entity_id AS key, 'queries' AS columns FROM e WHERE q % 5 = 0 UNION ALL SELECT 'counters', 'all', 'rows' FROM (SELECT count(*) FROM e) UNION ALL SELECT 'structure', CAST(data_date AS VARCHAR), 'total_turns' FROM (SELECT DISTINCT CAST(ts AS DATE) AS data_date FROM events) WHERE day(data_date) = 7")
def q_audit_p15_tables(spark, d):
    m, t = v.v3_mentions(spark, d), v.v2_turns(spark, d)
    members = v.v3_members(spark, d, False)
    entities = interest.entity_metrics(m).select("entity_id", (F.col("queries") + F.when(F.col("queries") % 5 == 0, 1).otherwise(0)).alias("queries"), "mention_users")
    rollups = interest.rollup_metrics(m, members).select("rollup_id", "queries", "mention_users")
    structure = sessions.session_structure(t, "data_date").select("data_date", (F.col("total_turns") + F.when(F.dayofmonth("data_date") == 7, 1).otherwise(0)).alias("total_turns"), "total_sessions")
    counters = m.agg((F.count(F.lit(1)) + 1).alias("rows")).withColumn("name", F.lit("all"))
    plain = lambda df, key: df.groupBy(key).agg(F.count_distinct("query").alias("queries"), F.count_distinct("client_id").alias("mention_users"))
    again = {"entities": plain(m, "entity_id"), "rollups": plain(m.join(members, "entity_id"), "rollup_id"), "structure": t.groupBy("data_date").agg(F.count(F.lit(1)).alias("total_turns"), F.count_distinct("cid").alias("total_sessions")), "counters": m.groupBy(F.lit("all").alias("name")).agg(F.count(F.lit(1)).alias("rows"))}
    return audit.recomputed({"entities": entities, "rollups": rollups, "structure": structure, "counters": counters}, again, {"entities": ["entity_id"], "rollups": ["rollup_id"], "structure": ["data_date"], "counters": ["name"]})


@query("SELECT c_custkey, CASE WHEN c_acctbal >= 0 AND c_nationkey % 7 <> 0 THEN CAST(n_regionkey AS VARCHAR) END AS region_id, c_acctbal >= 0 AND c_nationkey % 7 = 0 AS unmapped FROM customer JOIN nation ON c_nationkey = n_nationkey")
def q_regions(spark, d):
    c, n = v.table(spark, d, "customer"), v.table(spark, d, "nation")
    rows = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("city_normalized"), F.when(F.col("c_acctbal") >= 0, NORMAL).otherwise("?").alias("city_status"))
    cities = n.filter("n_nationkey % 7 != 0").select(F.col("n_name").alias("city"), F.col("n_regionkey").cast("string").alias("region_id"))
    return interest.with_region(rows, cities).select("c_custkey", "region_id", "unmapped")


@query("SELECT o_orderkey, o_orderkey % 7 AS n, o_orderkey % 5 AS d, round((o_orderkey % 7) / nullif(o_orderkey % 5, 0), 9) AS rate, printf('%+.1f%%', ((o_orderkey % 7) - 3) * 10.0) AS percent, printf('%+.2f pp', (o_orderkey % 7) * 1.5 - 4) AS points FROM orders".replace("printf('%+.1f%%', ((o_orderkey % 7) - 3) * 10.0)", "format('{:+.1f}%', ((o_orderkey % 7) - 3) * 10.0::DOUBLE)").replace("printf('%+.2f pp', (o_orderkey % 7) * 1.5 - 4)", "format('{:+.2f} pp', ((o_orderkey % 7) * 1.5 - 4)::DOUBLE)"))
def q_ratio(spark, d):
    k = F.col("o_orderkey")
    ratio = text.ratio(k % 7, k % 5)
    return rounded(v.table(spark, d, "orders").select("o_orderkey", ratio.alias("r"), text.signed_percent(((k % 7) - 3) / 10).alias("percent"), text.signed_points(((k % 7) * 1.5 - 4) / 100).alias("points")).select("o_orderkey", "r.n", "r.d", "r.rate", "percent", "points"), "rate")


@query("WITH e AS (SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) % 5 AS k FROM events) SELECT event_id, k NOT IN (1, 2) AS orderable, CASE WHEN k = 0 THEN 2.5 ELSE 0.0 END::DOUBLE AS ts FROM e")
def q_row_order(spark, d):
    k = F.get_json_object("props", "$.k").cast("int") % 5
    stamp = F.when(k == 0, " 2.5\t").when(k == 1, "NaN").when(k == 2, "-Infinity").when(k == 3, "noon")
    return v.table(spark, d, "events").select("event_id", rules.is_orderable(stamp).alias("orderable"), rules.row_order(stamp, F.lit(""), F.col("event_id"))["ts"].alias("ts"))


@query("WITH e AS (SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) % 6 AS k FROM events) SELECT event_id, k NOT IN (0, 1) AS valid, CASE WHEN k = 5 THEN 'birthday' WHEN k = 4 THEN 'operation' END AS direction FROM e")
def q_opening_prompts(spark, d):
    k = F.get_json_object("props", "$.k").cast("int") % 6
    response = F.when(k == 0, "{broken").when(k == 1, "[1]").when(k == 2, '{"extra": {"opening_prompt": 7}}').when(k == 3, '{"extra": []}').when(k == 4, '{"extra": {"opening_prompt": "运营任务＋x==y"}}').otherwise('{"extra": {"opening_prompt": "\\t生日==x"}}')
    valid, prompt = rules.opening_prompt(response)
    return v.table(spark, d, "events").select("event_id", valid.alias("valid"), rules.direction_of(prompt).alias("direction"))


@query("WITH e AS (SELECT event_id, event_type, event_id % 4 AS k FROM events) SELECT event_id, CASE WHEN k = 0 AND event_type = 'view' THEN 'E' WHEN k = 1 AND event_type = 'click' THEN 'T' WHEN k = 2 AND event_type = 'purchase' THEN 'P' ELSE 'none' END AS entity_id, CASE WHEN k = 1 AND event_type = 'click' THEN 8 WHEN k = 2 AND event_type = 'purchase' THEN 8 WHEN k = 0 AND event_type = 'view' THEN 4 ELSE 0 END AS stop FROM e")
def q_match_modes(spark, d):
    """Exact, token and pattern aliases and one that is only a candidate."""
    aliases = [matching.Alias("E", "view", "view", "exact"), matching.Alias("T", "click", "click", "token"), matching.Alias("P", "p.r.h.s.", "p.r.h.s.", "pattern"), matching.Alias("C", "error", "error", policy="candidate")]
    k = F.col("event_id") % 4
    said = F.when(k == 0, F.col("event_type")).when(k == 1, F.concat(F.lit("a "), "event_type", F.lit("!"))).when(k == 2, F.col("event_type")).otherwise(F.concat("event_type", F.lit("s")))
    rows = v.table(spark, d, "events").select("event_id", "event_type", k.alias("k"), said.alias("said"))
    hit = F.get(F.filter("hits", lambda h: ~((h["entity_id"] == "T") & (F.col("k") != 1)) & ~((h["entity_id"] == "E") & (F.col("k") != 0)) & ~((h["entity_id"] == "P") & (F.col("k") != 2))), F.lit(0))
    out = matching.match(rows, "said", aliases).withColumn("hit", hit)
    return out.select("event_id", F.coalesce("hit.entity_id", F.lit("none")).alias("entity_id"), F.coalesce(F.col("hit.stop") + F.when(F.col("hit.entity_id") == "T", 1).otherwise(0), F.lit(0)).alias("stop"))


@query("""WITH e AS (SELECT event_id, event_type, event_id % 4 AS k FROM events),
 a AS (SELECT event_id, 'E' AS entity_id, 0 AS start, 4 AS stop FROM e WHERE event_type = 'view' AND k IN (0, 2) UNION ALL SELECT event_id, 'T', 0, 5 FROM e WHERE event_type = 'click' AND k IN (0, 2) UNION ALL SELECT event_id, 'T', 2, 7 FROM e WHERE event_type = 'click' AND k = 1
 UNION ALL SELECT event_id, 'P', 0, 8 FROM e WHERE event_type = 'purchase' AND k IN (0, 2) UNION ALL SELECT event_id, 'S', CASE WHEN k = 1 THEN 1 ELSE 0 END, CASE WHEN k = 1 THEN 7 ELSE 6 END FROM e WHERE event_type = 'signup')
 SELECT event_id, entity_id, start, stop FROM a""")
def q_match_every_mode(spark, d):
    """All hits of exact, token, pattern and substring aliases, those that would be of the wrong place or mode too."""
    aliases = [matching.Alias("E", "view", "view", "exact"), matching.Alias("T", "click", "click", "token"), matching.Alias("P", "p.r.h.s.", "p.r.h.s.", "pattern"), matching.Alias("S", "signup", "signup"), matching.Alias("C", "error", "error", policy="candidate")]
    k = F.col("event_id") % 4
    said = F.when(k == 1, F.concat(F.lit("a "), "event_type", F.lit("!"))).when(k == 3, F.concat("event_type", F.lit("s"))).otherwise(F.col("event_type"))
    hits = v.table(spark, d, "events").select("event_id", F.explode(matching.hits_of(said, aliases, False)).alias("hit"))
    return hits.select("event_id", "hit.entity_id", "hit.start", "hit.stop")


@query(f"WITH {SEG} {DENSE} SELECT gender AS gender_label, region, brand, CAST(row_number() OVER (PARTITION BY gender, region ORDER BY interest_users DESC, brand) AS INTEGER) AS position, round((coverage - overall) * 100, 6) AS difference_points, CASE WHEN eligible_users >= 30 THEN 'describable' ELSE 'small_sample' END AS sample FROM di")
def q_age_gender_shape(spark, d):
    rows = interest.age_gender_view(_dense_interest(spark, d), {"none": "?"}, "region", "gender", "brand")
    return rows.select("gender_label", "region", "brand", "position", (F.round("difference_points", 6) + 0.0).alias("difference_points"), "sample")


@query(f"WITH {SEG} {DENSE} SELECT gender, region, brand, eligible_users, interest_users FROM di WHERE (gender, region) IN (('BUILDING', 'ASIA'), ('MACHINERY', 'EUROPE'))")
def q_segment_asked(spark, d):
    pairs, profiles = _pairs(spark, d), v.v3_profiles(spark, d)
    domains = {"gender": v.table(spark, d, "customer").select(F.col("c_mktsegment").alias("gender")).distinct(), "region": v.table(spark, d, "region").select(F.col("r_name").alias("region"))}
    overall, counts = interest.segment_overall(pairs, profiles, v.DIMS, v.SETS, _brands(spark, d), "brand"), interest.segment_interest(pairs, profiles, v.DIMS, v.SETS, "brand")
    out = interest.segment_query(interest.segment_groups(profiles, v.DIMS, v.SETS), overall, counts, domains, v.DIMS, ["gender", "region"], [("BUILDING", "ASIA"), ("MACHINERY", "EUROPE")])
    return out.select("gender", "region", "brand", "eligible_users", "interest_users")


@query(f"WITH {SEG} SELECT gender, users, eligible_users, CASE WHEN eligible_users >= 30 THEN 'describable' ELSE 'small_sample' END AS sample_status FROM sg WHERE dimension_set = 'gender'")
def q_segment_summary(spark, d):
    return interest.segment_summary(interest.segment_groups(v.v3_profiles(spark, d), v.DIMS, v.SETS), ["gender"])


@query(f"WITH {v.V2}, dl AS (SELECT CAST(k AS VARCHAR) AS phrase, data_date, count(DISTINCT client_id) AS users FROM v2 WHERE day(data_date) <> 9 GROUP BY k, data_date) SELECT phrase, data_date, 'sample' AS columns FROM dl WHERE users >= 1 AND phrase LIKE '%7'")
def q_repair(spark, d):
    daily = _daily(spark, d)
    stored = periods.with_baseline(daily, daily, "phrase", "users").withColumn("sample", F.when(F.col("phrase").endswith("7"), "unsure").otherwise(text.sample_label(F.col("users"))))
    changed = periods.repaired(stored, daily, "phrase", "users", "users")[1]
    differs = ~F.get_json_object("old", "$.sample").eqNullSafe(F.get_json_object("new", "$.sample"))
    return changed.select("phrase", "data_date", F.when(differs, "sample").alias("columns"))


@query(f"WITH {v.V3}, {v.E3}, b AS (SELECT entity_id, count(DISTINCT client_id) FILTER (signal <> 'passive') AS active_users, count(DISTINCT client_id) AS u, count(DISTINCT query) AS q FROM m GROUP BY entity_id), x AS (SELECT b.*, visibility FROM b JOIN e USING (entity_id)) SELECT visibility AS list, entity_id, CAST(row_number() OVER (PARTITION BY visibility ORDER BY active_users DESC, u DESC, q DESC, entity_id) AS INTEGER) AS rank FROM x UNION ALL SELECT 'topics', event_type, CAST(row_number() OVER (ORDER BY count(*) DESC, event_type) AS INTEGER) FROM events GROUP BY event_type")
def q_report_tables(spark, d):
    m, entities = v.v3_mentions(spark, d), v.v3_entities(spark, d)
    topics = v.table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"))
    phrases = topics.select(F.col("event_type").alias("norm"), F.col("rows").alias("users"), F.col("rows").alias("sessions"), F.col("rows").alias("query_count"))
    aliases = entities.select("entity_id", F.col("name").alias("value"))
    lists = sinks.report_tables(interest.rollup_metrics(m, v.v3_members(spark, d)), interest.entity_metrics(m), entities, phrases, topics, topics, topics, aliases)
    one = lambda name, label, key: lists[name].select(F.lit(label).alias("list"), F.col(key).alias("entity_id"), "rank")
    return one("entities", "public", "entity_id").unionByName(one("restricted", "restricted", "entity_id")).unionByName(one("topics", "topics", "event_type"))

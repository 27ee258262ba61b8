"""Registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.functions import rules, text
from dialoom.operators import audit, interest, periods, review, sessions
from dialoom.plans import views as v

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def domain(spark: SparkSession, column: str, values) -> DataFrame:
    return spark.createDataFrame([(x,) for x in values], f"{column} string")


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) + 0.0 for c in columns})  # no negative zero


# --- sessions

STRUCTURE = """CAST(sum(n) AS BIGINT) AS total_turns, count(*) AS total_sessions, count(*) FILTER (n = 1) AS single_sessions, count(*) FILTER (n >= 2) AS multi_sessions, CAST(coalesce(sum(n) FILTER (n >= 2), 0) AS BIGINT) AS multi_turns,
 count(*) FILTER (n >= 5) AS five_plus_sessions, round(sum(n) / count(*), 9) AS average_turns, round(count(*) FILTER (n >= 2) / count(*), 9) AS multi_rate, round(sum(n) FILTER (n >= 2) / nullif(count(*) FILTER (n >= 2), 0), 9) AS multi_average_turns, round(count(*) FILTER (n >= 5) / count(*), 9) AS five_plus_rate"""
RATIOS = ("average_turns", "multi_rate", "multi_average_turns", "five_plus_rate")


@query(f"WITH {v.V1}, s AS (SELECT cid, count(*) AS n FROM v1 GROUP BY cid) SELECT {STRUCTURE} FROM s")
def q_session_structure(spark, d):
    return rounded(sessions.session_structure(v.v1_turns(spark, d)), *RATIOS)


@query(f"WITH {v.V2} SELECT data_date, count(*) AS turns, count(DISTINCT cid) AS sessions, count(DISTINCT client_id) AS users FROM v2 GROUP BY data_date")
def q_volume_by_day(spark, d):
    return sessions.volume_by_day(v.v2_turns(spark, d))


@query(f"WITH {v.V2}, s AS (SELECT data_date, cid, count(*) AS n FROM v2 GROUP BY ALL), u AS (SELECT data_date, count(DISTINCT client_id) AS users FROM v2 GROUP BY data_date), a AS (SELECT data_date, {STRUCTURE} FROM s GROUP BY data_date) SELECT a.*, users FROM a JOIN u USING (data_date)")
def q_metric_series(spark, d):
    return rounded(sessions.metric_series(v.v2_turns(spark, d)), *RATIOS)


@query(f"WITH {v.V2F} SELECT cid, n, CAST(later_replies AS BIGINT) AS later_replies, category, text, source_row FROM f")
def q_first_turns(spark, d):
    return v.v2_first(spark, d).drop("response")


@query(f"""WITH {v.V2F}, g AS (SELECT category, count(*) AS sessions, sum(n) AS total_turns, count(*) FILTER (n >= 2) AS multi_sessions, count(*) FILTER (n >= 5) AS five_plus_sessions, count(*) FILTER (later_replies > 0) AS reply_sessions FROM f GROUP BY category),
  d AS (SELECT unnest(['startPrompt', 'legacyDefault', 'other']) AS category)
  SELECT d.category, coalesce(sessions, 0) AS sessions, CAST(coalesce(total_turns, 0) AS BIGINT) AS total_turns, coalesce(multi_sessions, 0) AS multi_sessions, coalesce(five_plus_sessions, 0) AS five_plus_sessions, coalesce(reply_sessions, 0) AS reply_sessions,
  round(reply_sessions / sessions, 9) AS reply_rate, round(coalesce(sessions, 0) / (SELECT count(*) FROM f), 9) AS session_share FROM d LEFT JOIN g USING (category)""")
def q_opening_groups(spark, d):
    return rounded(sessions.opening_groups(v.v2_first(spark, d), domain(spark, "category", ("startPrompt", "legacyDefault", "other"))), "reply_rate", "session_share")


def _directed(spark, d):
    return sessions.with_direction(v.v2_first(spark, d), rules.opening_prompt(F.col("response"))[1])


@query(f"""WITH {v.V2F} {v.DIRECTED}, c AS (SELECT found AS direction, count(*) AS sessions, sum(n) AS turns, count(*) FILTER (later_replies > 0) AS reply_sessions FROM g WHERE found <> 'unsupported' GROUP BY found),
  d AS (SELECT unnest(['knowledge','operation','preference','unfinished_topic','birthday','anniversary','holiday','night','fallback','general_interest']) AS direction)
  SELECT direction, coalesce(sessions, 0) AS sessions, CAST(coalesce(turns, 0) AS BIGINT) AS turns, coalesce(reply_sessions, 0) AS reply_sessions, round(coalesce(sessions, 0) / (SELECT count(*) FROM g), 9) AS share FROM d LEFT JOIN c USING (direction)""")
def q_opening_directions(spark, d):
    return rounded(sessions.opening_directions(_directed(spark, d), domain(spark, "direction", rules.DIRECTIONS)), "share")


@query(f"WITH {v.V2F} {v.DIRECTED} SELECT count(*) FILTER (found IS NOT NULL AND found <> 'unsupported') AS classified, count(*) FILTER (found IS NULL) AS unlabelled, count(*) FILTER (found = 'unsupported') AS unsupported, round(count(*) FILTER (found IS NOT NULL AND found <> 'unsupported') / count(*), 9) AS coverage FROM g")
def q_opening_coverage(spark, d):
    return rounded(sessions.direction_coverage(_directed(spark, d)), "coverage")


@query(f"WITH {v.V2F} SELECT count(*) FILTER (text = '') AS empty_first, CAST(0 AS BIGINT) AS hint_first FROM f")
def q_opening_diagnostics(spark, d):
    return sessions.opening_diagnostics(v.v2_first(spark, d), text.normalize_opening(F.col("text")))


@query(f"WITH {v.V2F} SELECT cid, source_row, cid || '!' AS raw_cid FROM f WHERE source_row % 10 = 0")
def q_raw_row_check(spark, d):
    raw = v.v2_turns(spark, d).select("source_row", F.when(F.col("source_row") % 10 == 0, F.concat("cid", F.lit("!"))).otherwise(F.col("cid")).alias("cid"))
    return sessions.raw_row_check(v.v2_first(spark, d), raw)


def _active(spark, d):
    return v.v2_turns(spark, d).select(F.col("client_id").alias("user"), "data_date").distinct()


V2A = v.V2 + ", a AS (SELECT DISTINCT client_id AS usr, data_date FROM v2), fs AS (SELECT usr, min(data_date) AS first_date FROM a GROUP BY usr)"


@query(f"WITH {v.V2} SELECT count(*) AS overlap FROM (SELECT DISTINCT client_id FROM v2 WHERE data_date = DATE '2024-01-02' INTERSECT SELECT DISTINCT client_id FROM v2 WHERE data_date = DATE '2024-01-03')")
def q_cross_day_overlap(spark, d):
    t = v.v2_turns(spark, d)
    return sessions.key_overlap(t.filter("data_date = date '2024-01-02'"), t.filter("data_date = date '2024-01-03'"), "client_id")


@query(f"WITH {v.V2} SELECT client_id FROM v2 WHERE data_date = DATE '2024-01-02' EXCEPT SELECT client_id FROM v2 WHERE data_date = DATE '2024-01-03'")
def q_lost_users(spark, d):
    t = v.v2_turns(spark, d)
    return t.filter("data_date = date '2024-01-02'").select("client_id").distinct().join(t.filter("data_date = date '2024-01-03'"), "client_id", "left_anti")


@query(f"WITH {V2A} SELECT data_date, count(*) AS active_users, count(*) FILTER (data_date = first_date) AS first_observed_users, count(*) FILTER (data_date > first_date) AS returning_users FROM a JOIN fs USING (usr) GROUP BY data_date")
def q_daily_active(spark, d):
    return sessions.daily_active(_active(spark, d))


@query(f"""WITH {V2A}, cov AS (SELECT DISTINCT data_date FROM v2 WHERE day(data_date) <> 5),
 c AS (SELECT first_date, count(DISTINCT usr) AS users, count(*) FILTER (data_date = first_date + 1) AS d1_observed, count(*) FILTER (data_date = first_date + 7) AS d7_observed FROM a JOIN fs USING (usr) GROUP BY first_date)
 SELECT first_date, users, d1_observed, round(d1_observed / users, 9) AS d1_observed_rate, CASE WHEN (SELECT count(*) FROM cov WHERE data_date BETWEEN first_date AND first_date + 1) = 2 THEN round(d1_observed / users, 9) END AS d1_rate,
 d7_observed, round(d7_observed / users, 9) AS d7_observed_rate, CASE WHEN (SELECT count(*) FROM cov WHERE data_date BETWEEN first_date AND first_date + 7) = 8 THEN round(d7_observed / users, 9) END AS d7_rate FROM c""")
def q_retention(spark, d):
    covered = v.v2_turns(spark, d).select("data_date").distinct().filter(F.dayofmonth("data_date") != 5)
    return rounded(sessions.retention(_active(spark, d), covered), "d1_observed_rate", "d1_rate", "d7_observed_rate", "d7_rate")


@query(f"WITH {V2A}, l AS (SELECT usr, count(*) AS days FROM a WHERE data_date > (SELECT max(data_date) FROM a) - 7 GROUP BY usr) SELECT d.days, (SELECT count(*) FROM l WHERE l.days = d.days) AS users FROM (SELECT CAST(unnest(range(1, 8)) AS BIGINT) AS days) d")
def q_active_days(spark, d):
    return sessions.active_days(_active(spark, d), F.max("data_date"))


@query(f"WITH {v.V2} SELECT event_type, count(DISTINCT client_id) AS users, count(DISTINCT cid) AS sessions, count(*) AS turns, round(count(DISTINCT client_id) / (SELECT count(DISTINCT client_id) FROM v2), 9) AS penetration FROM v2 GROUP BY event_type")
def q_intent_demand(spark, d):
    return rounded(sessions.intent_demand(v.v2_turns(spark, d), "event_type").withColumns({"sessions": F.col("sessions").cast("long"), "turns": F.col("turns").cast("long")}), "penetration")


V1S = v.V1 + ", k AS (SELECT DISTINCT cid FROM v1), smp AS (SELECT cid, sha256('s1' || cid) AS draw FROM k ORDER BY draw LIMIT 20)"


@query(f"WITH {V1S} SELECT cid, draw, (SELECT count(*) FROM k) AS population, round(least(1.0, 20 / (SELECT count(*) FROM k)), 9) AS probability FROM smp")
def q_session_sample(spark, d):
    return rounded(sessions.hash_sample(v.v1_turns(spark, d).select("cid").distinct(), F.col("cid"), 20, "s1"), "probability")


@query(f"WITH {V1S} SELECT cid, sha256(string_agg(CAST(turn_index AS VARCHAR) || ':' || text, '|' ORDER BY turn_index)) AS transcript_hash, count(*) AS turns FROM v1 WHERE cid IN (SELECT cid FROM smp) GROUP BY cid")
def q_transcripts(spark, d):
    t = v.v1_turns(spark, d)
    out = sessions.transcripts(t, sessions.hash_sample(t.select("cid").distinct(), F.col("cid"), 20, "s1"))
    items = F.from_json("transcript", "array<struct<turn_index:bigint,source_row:bigint,text:string>>")
    return out.select("cid", F.sha2(F.array_join(F.transform(items, lambda x: F.concat(x["turn_index"].cast("string"), F.lit(":"), x["text"])), "|"), 256).alias("transcript_hash"), "turns")


@query(f"WITH {v.V1} SELECT source_row, lag(text) OVER w AS previous_text, lag(ai_text) OVER w AS previous_ai_text FROM v1 WINDOW w AS (PARTITION BY cid ORDER BY source_row)")
def q_prev_turn(spark, d):
    return sessions.previous_turn(v.v1_turns(spark, d)).select("source_row", "previous_text", "previous_ai_text")


# --- scalars


def _english(spark, d):
    return _whole(spark, d).filter("lang = 'en'").select("doc_id", "text")


def _whole(spark, d):
    """All languages: DuckDB has neither NFKC nor casefold, so the q_*_whole queries have no SQL; tests hold them against Python."""
    return v.table(spark, d, "documents").select("doc_id", "text", "lang")


@query(r"""SELECT doc_id, sha256(regexp_replace(replace(lower(text), 'ß', 'ss'), '[\s，。！？、,.!?；;：:“”"''‘’（）()《》【】\[\]~～_\-]+', '', 'g')) AS norm_hash FROM documents WHERE lang = 'en'""")
def q_normalize(spark, d):
    return _english(spark, d).select("doc_id", F.sha2(text.normalize_text(F.col("text")), 256).alias("norm_hash"))


@query()
def q_normalize_whole(spark, d):
    return _whole(spark, d).select("doc_id", F.sha2(text.normalize_text(F.col("text")), 256).alias("norm_hash"))


@query(r"""SELECT doc_id, sha256(regexp_replace(lower(trim(text, E' \t\n\r')), '[\s，。！？、,.!?；;：:“”"''‘’（）()《》【】\[\]~～\-_/]+', '', 'g')) AS norm_hash FROM documents WHERE lang = 'en'""")
def q_normalize_opening(spark, d):
    return _english(spark, d).select("doc_id", F.sha2(text.normalize_opening(F.col("text")), 256).alias("norm_hash"))


@query()
def q_normalize_opening_whole(spark, d):
    return _whole(spark, d).select("doc_id", F.sha2(text.normalize_opening(F.col("text")), 256).alias("norm_hash"))


@query("SELECT doc_id, substr(sha256('user' || chr(0) || 'src' || chr(0) || CAST(doc_id AS VARCHAR)), 1, 20) AS pseudonym FROM documents")
def q_pseudonym(spark, d):
    return v.table(spark, d, "documents").select("doc_id", text.day_key("user", F.col("doc_id").cast("string"), F.lit("src")).alias("pseudonym"))


def _hmac_sql(secret: str, message: str) -> str:
    """X4 as two nested digests over the padded key (of 64 bytes at most)."""
    inner, outer = (bytes(b ^ pad for b in secret.encode().ljust(64, b"\0")).hex() for pad in (0x36, 0x5C))
    return f"sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode({message}))))"


@query(f"SELECT doc_id, {_hmac_sql('not-a-secret', "'user:' || CAST(doc_id AS VARCHAR)")} AS pseudonym FROM documents")
def q_stable_pseudonym(spark, d):
    return v.table(spark, d, "documents").select("doc_id", text.stable_key("not-a-secret", "user", F.col("doc_id").cast("string")).alias("pseudonym"))


@query(r"SELECT doc_id, regexp_matches(text, '(?i)([0-9]{6,}|[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,})') AS contact_like FROM documents WHERE lang = 'en'")
def q_contact_scan(spark, d):
    return _english(spark, d).select("doc_id", text.is_contact_like(F.col("text")).alias("contact_like"))


@query()
def q_contact_scan_whole(spark, d):
    return _whole(spark, d).select("doc_id", text.is_contact_like(F.col("text")).alias("contact_like"))


@query(r"SELECT doc_id, substr(regexp_replace(text, '(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b', '[redacted]', 'g'), 1, 160) AS example FROM documents WHERE lang = 'en'")
def q_redacted(spark, d):
    """Its SQL masks mail only; a phone number that is a word of its own is masked here too."""
    return _english(spark, d).select("doc_id", text.redacted(F.col("text"), words=True).alias("example"))


@query()
def q_redacted_whole(spark, d):
    return _whole(spark, d).select("doc_id", text.redacted(F.col("text")).alias("example"))


@query("SELECT p_partkey, CASE WHEN p_size BETWEEN 1 AND 17 THEN p_size END AS age, CASE WHEN p_size % 3 = 0 THEN p_brand END AS gender, CASE WHEN p_size % 3 = 0 THEN 'M1' ELSE 'M2' END AS product, CASE WHEN p_size >= 30 THEN 'describable' ELSE 'small_sample' END AS label FROM part")
def q_profile_dims(spark, d):
    p = v.table(spark, d, "part")
    status = F.when(F.col("p_size") % 3 == 0, text.NORMAL).otherwise("?")
    scene = F.when(F.col("p_size") % 3 == 0, "488").otherwise("904")
    return p.select("p_partkey", text.age_of(F.concat(F.lit(" "), F.col("p_size").cast("string"))).alias("age"), text.valid_if(F.col("p_brand"), status).alias("gender"), text.product_of(scene).alias("product"), text.sample_label(F.col("p_size")).alias("label"))


@query("SELECT event_id, CASE WHEN event_type = 'error' THEN 'row:' || CAST(event_id AS VARCHAR) ELSE event_type END AS session_key, CASE WHEN event_type = 'error' THEN 'session:row:' || CAST(event_id AS VARCHAR) ELSE CAST(user_id AS VARCHAR) END AS user_key FROM events")
def q_fallback_keys(spark, d):
    e = v.table(spark, d, "events").withColumn("empty", F.col("event_type") == "error")
    e = e.withColumn("session_key", text.session_key(F.when(F.col("empty"), "").otherwise(F.col("event_type")), F.col("event_id")))
    return e.select("event_id", "session_key", text.user_key(F.when(~F.col("empty"), F.col("user_id").cast("string")), F.col("session_key")).alias("user_key"))


@query("SELECT o_orderkey, round(CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE (o_totalprice - o_orderkey % 5) / (o_orderkey % 5) END, 9) AS change, round(CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice / (o_orderkey % 5) END, 9) AS growth FROM orders")
def q_change_and_growth(spark, d):
    o, base = v.table(spark, d, "orders"), F.col("o_orderkey") % 5
    return rounded(o.select("o_orderkey", text.change_ratio(F.col("o_totalprice"), base).alias("change"), text.growth(F.col("o_totalprice"), base).alias("growth")), "change", "growth")


@query("SELECT s_suppkey, printf('%+.2f', s_acctbal) AS signed_number, printf('%+.1f%%', s_acctbal * 100) AS signed_percent FROM supplier")
def q_change_texts(spark, d):
    return v.table(spark, d, "supplier").select("s_suppkey", text.signed_number(F.col("s_acctbal")).alias("signed_number"), text.signed_percent(F.col("s_acctbal")).alias("signed_percent"))


@query("SELECT p_partkey, replace(p_name, ' ', '|') AS piped, CAST(len(string_split(p_name, ' ')) AS INTEGER) AS pieces, CASE WHEN p_brand = 'Brand#1' THEN 'Brand#2' ELSE p_brand END AS definition FROM part")
def q_lists_and_bridge(spark, d):
    p = v.table(spark, d, "part").withColumn("piped", text.joined(F.split("p_name", " ")))
    return p.select("p_partkey", "piped", F.size(text.split_list(F.col("piped"))).alias("pieces"), text.definition_of(F.col("p_brand"), {"Brand#1": "Brand#2"}).alias("definition"))


# --- interest

METRIC_SQL = """count(DISTINCT client_id) AS mention_users, count(DISTINCT client_id) FILTER (signal = 'initiation') AS initiators, count(DISTINCT client_id) FILTER (signal = 'continuation') AS continuers, count(DISTINCT client_id) FILTER (signal <> 'passive') AS active_users,
 count(DISTINCT query) AS queries, count(DISTINCT cid) AS sessions"""


def metric_sql(source: str, key: str, *by: str) -> str:
    keys = ", ".join([*by, key])
    return f"""WITH {source}, b AS (SELECT {keys}, {METRIC_SQL} FROM x GROUP BY {keys}), dp AS (SELECT {keys}, count(*) AS deep_sessions FROM (SELECT {keys}, cid FROM x GROUP BY {keys}, cid HAVING count(DISTINCT query) >= 3) GROUP BY {keys})
 SELECT b.*, coalesce(deep_sessions, 0) AS deep_sessions, round(coalesce(deep_sessions, 0) / sessions, 9) AS deep_rate"""


@query(metric_sql(f"{v.V3}, x AS (SELECT * FROM m)", "entity_id") + " FROM b LEFT JOIN dp USING (entity_id)")
def q_entity_metrics(spark, d):
    return rounded(interest.entity_metrics(v.v3_mentions(spark, d)), "deep_rate")


@query(f"WITH {v.V3} SELECT entity_id, " + ", ".join(f"count(DISTINCT client_id) FILTER (polarity = '{p}') AS {p}_users" for p in interest.POLARITIES) + " FROM m GROUP BY entity_id")
def q_polarity_users(spark, d):
    return interest.polarity_users(v.v3_mentions(spark, d))


def _visible(kind):
    return metric_sql(f"{v.V3}, {v.E3}, x AS (SELECT m.* FROM m JOIN e USING (entity_id) WHERE visibility = '{kind}')", "entity_id") + " FROM b LEFT JOIN dp USING (entity_id)"


@query(_visible("restricted"))
def q_restricted(spark, d):
    return rounded(interest.by_visibility(interest.entity_metrics(v.v3_mentions(spark, d)), v.v3_entities(spark, d), "restricted"), "deep_rate")


@query(_visible("public"))
def q_public_listing(spark, d):
    return rounded(interest.by_visibility(interest.entity_metrics(v.v3_mentions(spark, d)), v.v3_entities(spark, d), "public"), "deep_rate")


@query(f"WITH {v.V3}, b AS (SELECT entity_id, {METRIC_SQL} FROM m GROUP BY entity_id) SELECT entity_id, active_users, CAST(row_number() OVER (ORDER BY active_users DESC, mention_users DESC, queries DESC, entity_id) AS INTEGER) AS rank FROM b")
def q_ranked_lists(spark, d):
    return interest.ranked(interest.entity_metrics(v.v3_mentions(spark, d)), "entity_id").select("entity_id", "active_users", "rank")


@query(metric_sql(f"{v.V3}, {v.E3} {v.ROLLUP}, x AS (SELECT m.*, rollup_id FROM m JOIN mem USING (entity_id))", "rollup_id") + ", (SELECT count(*) FROM mem WHERE mem.rollup_id = b.rollup_id AND mem.entity_id <> b.rollup_id) AS children FROM b LEFT JOIN dp USING (rollup_id)")
def q_rollup_metrics(spark, d):
    return rounded(interest.rollup_metrics(v.v3_mentions(spark, d), v.v3_members(spark, d)), "deep_rate")


@query(f"WITH {v.V3}, {v.E3} {v.ROLLUP} SELECT rollup_id, entity_id FROM mem")
def q_rollup_members(spark, d):
    return v.v3_members(spark, d)


@query(f"WITH {v.E3} SELECT entity_id, entity_id AS ancestor_id, 0 AS depth FROM e UNION ALL SELECT entity_id, parent_id, 1 FROM e WHERE parent_id IS NOT NULL")
def q_hierarchy(spark, d):
    from dialoom.operators.matching import ancestors

    return ancestors(v.v3_entities(spark, d))


@query(metric_sql(f"{v.V3}, {v.E3}, x AS (SELECT m.*, type, subtype FROM m JOIN e USING (entity_id))", "subtype", "type") + " FROM b LEFT JOIN dp USING (type, subtype)")
def q_structure_metrics(spark, d):
    return rounded(interest.structure_metrics(v.v3_mentions(spark, d), v.v3_entities(spark, d), "type", "subtype"), "deep_rate")


@query(f"WITH {v.V3}, {v.E3}, {v.P3}, x AS (SELECT m.* FROM m JOIN e USING (entity_id) WHERE visibility = 'public') SELECT (SELECT count(*) FROM pr) AS input_rows, (SELECT count(*) FROM pr WHERE is_content) AS content_rows, (SELECT count(DISTINCT query) FROM x) AS entity_queries, (SELECT count(DISTINCT client_id) FROM x WHERE signal <> 'passive') AS active_users")
def q_totals(spark, d):
    public = v.v3_entities(spark, d).filter("visibility = 'public'")
    return interest.totals(v.v3_profile_rows(spark, d), v.v3_mentions(spark, d), public)


@query("WITH d AS (SELECT unnest(['view', 'click', 'none']) AS event_type), c AS (SELECT event_type, count(*) AS n FROM events GROUP BY event_type) SELECT event_type, coalesce(n, 0) AS rows, round(coalesce(n, 0) / (SELECT count(*) FROM events), 9) AS share FROM d LEFT JOIN c USING (event_type)")
def q_domain_counts(spark, d):
    return rounded(interest.domain_counts(v.table(spark, d, "events"), "event_type", domain(spark, "event_type", ("view", "click", "none"))), "share")


@query(f"WITH {v.P3} SELECT * FROM up")
def q_user_profile(spark, d):
    return v.v3_profiles(spark, d)


SETS_SQL = "GROUPING SETS ((age), (gender), (region), (age, gender), (age, region), (gender, region), (age, gender, region))"
KNOWN = "(grouping(age) = 1 OR age IS NOT NULL) AND (grouping(gender) = 1 OR gender IS NOT NULL) AND (grouping(region) = 1 OR region IS NOT NULL)"
SET_NAME = "concat_ws('+', CASE WHEN grouping(age) = 0 THEN 'age' END, CASE WHEN grouping(gender) = 0 THEN 'gender' END, CASE WHEN grouping(region) = 0 THEN 'region' END)"
SEG = f"""{v.V3}, {v.P3}, sg AS (SELECT {SET_NAME} AS dimension_set, age, gender, region, count(*) AS users, count(*) FILTER (eligible) AS eligible_users FROM up GROUP BY {SETS_SQL} HAVING {KNOWN}),
 ap AS (SELECT DISTINCT client_id, split_part(p_brand, '#', 2) AS brand FROM m JOIN part ON entity_id = CAST(p_partkey AS VARCHAR) WHERE signal <> 'passive'), j AS (SELECT up.*, brand FROM ap JOIN up USING (client_id) WHERE eligible),
 si AS (SELECT * FROM (SELECT {SET_NAME} AS dimension_set, age, gender, region, brand, count(*) AS interest_users, {KNOWN} AS ok FROM j GROUP BY brand, {SETS_SQL}) WHERE ok),
 kn AS (SELECT dimension_set, CAST(sum(eligible_users) AS BIGINT) AS eligible_users FROM sg GROUP BY dimension_set HAVING sum(eligible_users) > 0), br AS (SELECT DISTINCT split_part(p_brand, '#', 2) AS brand FROM part),
 so AS (SELECT kn.dimension_set, br.brand, kn.eligible_users, CAST(coalesce(sum(interest_users), 0) AS BIGINT) AS interest_users, round(coalesce(sum(interest_users), 0) / any_value(kn.eligible_users), 9) AS coverage FROM kn CROSS JOIN br LEFT JOIN si ON si.dimension_set = kn.dimension_set AND si.brand = br.brand GROUP BY kn.dimension_set, br.brand, kn.eligible_users)"""


def _pairs(spark, d):
    brands = v.table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("entity_id"), F.substring_index("p_brand", "#", -1).alias("brand"))
    return interest.active_pairs(v.v3_mentions(spark, d), brands, "brand")


def _brands(spark, d):
    return v.table(spark, d, "part").select(F.substring_index("p_brand", "#", -1).alias("brand")).distinct()


@query(f"WITH {SEG} SELECT * FROM sg")
def q_segment_groups(spark, d):
    return interest.segment_groups(v.v3_profiles(spark, d), v.DIMS, v.SETS)


@query(f"WITH {SEG} SELECT dimension_set, age, gender, region, brand, interest_users FROM si")
def q_segment_interest(spark, d):
    return interest.segment_interest(_pairs(spark, d), v.v3_profiles(spark, d), v.DIMS, v.SETS, "brand")


@query(f"WITH {SEG} SELECT * FROM so")
def q_segment_overall(spark, d):
    return rounded(interest.segment_overall(_pairs(spark, d), v.v3_profiles(spark, d), v.DIMS, v.SETS, _brands(spark, d), "brand"), "coverage")


DENSE = """, gd AS (SELECT gender, region FROM (SELECT DISTINCT c_mktsegment AS gender FROM customer) CROSS JOIN (SELECT r_name AS region FROM region)),
 dg AS (SELECT gender, region, coalesce(users, 0) AS users, coalesce(eligible_users, 0) AS eligible_users FROM gd LEFT JOIN (SELECT * FROM sg WHERE dimension_set = 'gender+region') USING (gender, region)),
 di AS (SELECT gender, region, so.brand, dg.eligible_users, coalesce(si.interest_users, 0) AS interest_users, coalesce(si.interest_users, 0) / nullif(dg.eligible_users, 0) AS coverage, so.interest_users / so.eligible_users AS overall
  FROM dg CROSS JOIN (SELECT * FROM so WHERE dimension_set = 'gender+region') so LEFT JOIN (SELECT * FROM si WHERE dimension_set = 'gender+region') si USING (gender, region, brand))"""


def _dense(spark, d):
    profiles = v.v3_profiles(spark, d)
    domains = {"gender": v.table(spark, d, "customer").select(F.col("c_mktsegment").alias("gender")).distinct(), "region": v.table(spark, d, "region").select(F.col("r_name").alias("region"))}
    return interest.dense_groups(interest.segment_groups(profiles, v.DIMS, v.SETS), domains, v.DIMS, ["gender", "region"])


def _dense_interest(spark, d):
    pairs, profiles = _pairs(spark, d), v.v3_profiles(spark, d)
    overall = interest.segment_overall(pairs, profiles, v.DIMS, v.SETS, _brands(spark, d), "brand")
    return interest.dense_interest(_dense(spark, d), overall, interest.segment_interest(pairs, profiles, v.DIMS, v.SETS, "brand"), ["gender", "region"], "brand")


@query(f"WITH {SEG} {DENSE} SELECT * FROM dg")
def q_segment_grid(spark, d):
    return _dense(spark, d)


@query(f"WITH {SEG} {DENSE} SELECT gender, region, brand, eligible_users, interest_users, round(coverage, 9) AS coverage, round(coverage - overall, 9) AS difference FROM di")
def q_segment_dense(spark, d):
    return rounded(_dense_interest(spark, d), "coverage", "difference")


@query(f"WITH {SEG} {DENSE} SELECT gender, region, brand, interest_users, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY gender, region ORDER BY interest_users DESC, brand) AS r FROM di) WHERE r <= 10")
def q_segment_top10(spark, d):
    return interest.top_per_group(_dense_interest(spark, d), ["gender", "region"], 10, "brand").select("gender", "region", "brand", "interest_users", "rank")


@query(f"WITH {SEG} SELECT age, gender, users, eligible_users FROM sg WHERE dimension_set = 'age+gender'")
def q_age_gender_view(spark, d):
    return interest.segment_groups(v.v3_profiles(spark, d), v.DIMS, v.SETS).filter("dimension_set = 'age+gender'").select("age", "gender", "users", "eligible_users")


@query(f"WITH {v.P3} SELECT count(*) FILTER (region IS NOT NULL) AS stable_region_users, count(*) FILTER (unmapped) AS unmapped_users FROM up")
def q_mapping_diag(spark, d):
    return interest.mapping_diagnostics(v.v3_profiles(spark, d), "region")


# --- contributions and periods

HITS = v.V3 + ", " + v.E3 + v.ROLLUP + """, q AS (SELECT data_date, client_id, rollup_id, cid, query, signal, polarity FROM m JOIN mem USING (entity_id)),
 h AS (SELECT data_date, client_id, rollup_id, cid, count(DISTINCT query) AS queries, bool_or(signal = 'initiation') AS initiated, bool_or(signal = 'continuation') AS continued, array_to_string(list_sort(list(DISTINCT polarity)), '|') AS polarities FROM q GROUP BY data_date, client_id, rollup_id, cid)"""
YEAR = "data_date >= DATE '1997-01-01' AND data_date < DATE '1998-01-01'"


def _hits(spark, d):
    return periods.contribution_hits(v.v3_mentions(spark, d), v.v3_members(spark, d, False))


def _user_days(spark, d):
    return interest.stable_profile(v.v3_profile_rows(spark, d).withColumn("client_id", F.struct("client_id", "data_date")), ["gender", "region"], F.col("is_content")).select("client_id.client_id", "client_id.data_date", "gender", "region", "eligible")


@query(f"WITH {HITS} SELECT * FROM h")
def q_contrib_hit(spark, d):
    return _hits(spark, d).withColumn("polarities", text.joined(F.col("polarities")))


UD = v.P3 + ", ud AS (SELECT client_id, data_date, CASE WHEN count(gender) = count(*) THEN min(gender) END AS gender, CASE WHEN count(region) = count(*) THEN min(region) END AS region, bool_or(is_content) AS eligible FROM pr GROUP BY client_id, data_date)"


@query(f"WITH {UD} SELECT data_date, client_id, gender, region, eligible FROM ud")
def q_contrib_user(spark, d):
    return periods.contribution_users(_user_days(spark, d), "gender", "region")


@query(f"""WITH {HITS}, s AS (SELECT rollup_id, client_id, cid, sum(queries) AS queries, bool_or(initiated OR continued) AS active, bool_or(polarities LIKE '%positive%') AS pos, bool_or(polarities LIKE '%negative%') AS neg FROM h WHERE {YEAR} GROUP BY rollup_id, client_id, cid)
 SELECT rollup_id, count(DISTINCT client_id) FILTER (active) AS active_users, count(*) AS sessions, count(*) FILTER (queries >= 3) AS deep_sessions, CAST(sum(queries) AS BIGINT) AS queries, count(DISTINCT client_id) FILTER (pos) AS positive_users, count(DISTINCT client_id) FILTER (neg) AS negative_users FROM s GROUP BY rollup_id""")
def q_period_metrics(spark, d):
    return periods.period_metrics(_hits(spark, d).filter("year(data_date) = 1997"))


@query(f"WITH {HITS} SELECT rollup_id, count(DISTINCT client_id) AS users FROM h WHERE data_date >= DATE '1997-03-01' AND data_date < DATE '1997-04-01' GROUP BY rollup_id")
def q_period_month(spark, d):
    hits = periods.in_period(_hits(spark, d), "month", "1997-03")
    return hits.select("rollup_id", "client_id").distinct().groupBy("rollup_id").agg(F.count(F.lit(1)).alias("users"))


LATEST = UD + ", la AS (SELECT client_id, arg_max({'g': gender, 'r': region}, data_date) AS l, bool_or(eligible) AS eligible FROM ud GROUP BY client_id), lt AS (SELECT client_id, l.g AS gender, l.r AS region, eligible FROM la)"


@query(f"WITH {LATEST}, g AS (SELECT gender, count(*) AS users, count(*) FILTER (eligible) AS eligible_users FROM lt WHERE gender IS NOT NULL GROUP BY gender) SELECT *, row_number() OVER (ORDER BY eligible_users DESC, users DESC, gender DESC) = 1 AS is_default FROM g")
def q_period_groups(spark, d):
    return periods.period_groups(periods.latest_profiles(_user_days(spark, d), "gender", "region"), "gender")


@query(f"WITH {HITS}, {LATEST} SELECT (SELECT count(*) FROM lt) AS users, (SELECT count(*) FROM lt WHERE eligible) AS eligible_users, (SELECT count(DISTINCT client_id) FROM h WHERE initiated OR continued) AS active_users, (SELECT count(DISTINCT cid) FROM h) AS sessions, (SELECT CAST(sum(queries) AS BIGINT) FROM h) AS queries")
def q_period_totals(spark, d):
    return periods.period_totals(periods.latest_profiles(_user_days(spark, d), "gender", "region"), _hits(spark, d))


@query(f"WITH {HITS}, {LATEST} SELECT rollup_id, count(DISTINCT client_id) FILTER (initiated OR continued) AS active_users, round(count(DISTINCT client_id) FILTER (initiated OR continued) / (SELECT count(*) FROM lt WHERE eligible), 9) AS coverage FROM h GROUP BY rollup_id")
def q_period_coverage(spark, d):
    hits = _hits(spark, d)
    totals = periods.period_totals(periods.latest_profiles(_user_days(spark, d), "gender", "region"), hits)
    return rounded(periods.period_coverage(periods.period_metrics(hits), totals).select("rollup_id", "active_users", "coverage"), "coverage")


@query(f"WITH {v.V2} SELECT client_id, cid FROM v2 WHERE day(data_date) = 1 UNION ALL SELECT client_id, cid FROM v2 WHERE day(data_date) = 2")
def q_union_days(spark, d):
    t = v.v2_turns(spark, d).select("client_id", "cid", "data_date")
    return periods.union_days(t.filter(F.dayofmonth("data_date") == 1), t.filter(F.dayofmonth("data_date") == 2)).select("client_id", "cid")


# --- history and comparison


def _daily(spark, d):
    t = v.v2_turns(spark, d).filter(F.dayofmonth("data_date") != 9)
    return t.select("data_date", F.col("k").cast("string").alias("phrase"), "client_id").distinct().groupBy("phrase", "data_date").agg(F.count(F.lit(1)).alias("users"))


DAILY = v.V2 + ", dl AS (SELECT CAST(k AS VARCHAR) AS phrase, data_date, count(DISTINCT client_id) AS users FROM v2 WHERE day(data_date) <> 9 GROUP BY k, data_date), od AS (SELECT DISTINCT data_date FROM dl), b AS (SELECT a.phrase, a.data_date, a.users, (SELECT count(*) FROM od WHERE od.data_date BETWEEN a.data_date - 7 AND a.data_date - 1) AS observed_days, (SELECT sum(users) FROM dl p WHERE p.phrase = a.phrase AND p.data_date BETWEEN a.data_date - 7 AND a.data_date - 1) AS s, (SELECT count(*) FROM dl p WHERE p.phrase = a.phrase AND p.data_date BETWEEN a.data_date - 7 AND a.data_date - 1) AS n FROM dl a)"
GROWTH_SQL = "round(base, 9) AS baseline, round((users - base) / nullif(base, 0), 9) AS change, round(users / nullif(base, 0), 9) AS growth"


@query(f"WITH {DAILY}, c AS (SELECT *, CASE WHEN observed_days > 0 THEN coalesce(s, 0) / observed_days END AS base FROM b) SELECT phrase, data_date, users, observed_days, {GROWTH_SQL} FROM c")
def q_history_baseline(spark, d):
    daily = _daily(spark, d)
    return rounded(periods.with_baseline(daily, daily, "phrase", "users"), "baseline", "change", "growth")


@query(f"WITH {DAILY}, c AS (SELECT *, CASE WHEN observed_days > 0 AND n = observed_days THEN s / observed_days END AS base FROM b) SELECT phrase, data_date, users, observed_days, {GROWTH_SQL} FROM c")
def q_candidate_baseline(spark, d):
    daily = _daily(spark, d)
    return rounded(periods.with_baseline(daily, daily, "phrase", "users", every_day=True), "baseline", "change", "growth")


@query(f"WITH {DAILY}, c AS (SELECT *, CASE WHEN observed_days > 0 THEN coalesce(s, 0) / observed_days END AS base FROM b WHERE data_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-16') SELECT phrase, data_date, round(users / nullif(base, 0), 9) AS growth FROM c WHERE users / nullif(base, 0) >= 3")
def q_batch_growth(spark, d):
    daily = _daily(spark, d)
    out = periods.with_baseline(daily, daily, "phrase", "users").filter("data_date between date '2024-01-10' and date '2024-01-16' and growth >= 3")
    return rounded(out.select("phrase", "data_date", "growth"), "growth")


SERIES = v.V2 + f", s AS (SELECT data_date, cid, count(*) AS n FROM v2 GROUP BY ALL), a AS (SELECT data_date, {STRUCTURE}, sum(n) / count(*) AS avg_turns FROM s GROUP BY data_date)"


@query(f"""WITH {SERIES}, u AS (SELECT data_date, count(DISTINCT client_id) AS users FROM v2 GROUP BY data_date), x AS (SELECT * FROM a JOIN u USING (data_date) WHERE data_date = DATE '2024-01-03'), y AS (SELECT * FROM a JOIN u USING (data_date) WHERE data_date = DATE '2024-01-10')
 SELECT 'total_turns' AS metric, CAST(x.total_turns AS DOUBLE) AS start_value, CAST(y.total_turns AS DOUBLE) AS end_value, round((y.total_turns - x.total_turns) / x.total_turns, 9) AS change FROM x, y UNION ALL SELECT 'total_sessions', x.total_sessions, y.total_sessions, round((y.total_sessions - x.total_sessions) / x.total_sessions, 9) FROM x, y
 UNION ALL SELECT 'users', x.users, y.users, round((y.users - x.users) / x.users, 9) FROM x, y UNION ALL SELECT 'multi_rate', x.multi_rate, y.multi_rate, round(y.multi_sessions / y.total_sessions - x.multi_sessions / x.total_sessions, 9) FROM x, y""")
def q_compare_days(spark, d):
    series = sessions.metric_series(v.v2_turns(spark, d))
    return rounded(periods.compare_days(series, "2024-01-03", "2024-01-10", ["total_turns", "total_sessions", "users"], ["multi_rate"]), "start_value", "end_value", "change")


def _previous(spark, d):
    return periods.previous_comparable(sessions.session_structure(v.v2_turns(spark, d).filter(F.dayofmonth("data_date") != 9).withColumn("product", F.lit("M1")), "product", "data_date"), "product").filter("previous is not null")


PREV = v.V2 + ", s AS (SELECT data_date, cid, count(*) AS n FROM v2 WHERE day(data_date) <> 9 GROUP BY ALL), a AS (SELECT data_date, CAST(sum(n) AS BIGINT) AS t, count(*) AS c, sum(n) / count(*) AS v FROM s GROUP BY data_date), p AS (SELECT *, lag(data_date) OVER w AS pd, lag(t) OVER w AS pt, lag(c) OVER w AS pc, lag(v) OVER w AS pv FROM a WINDOW w AS (ORDER BY data_date))"


@query(f"WITH {PREV} SELECT data_date, pd AS previous_date FROM p WHERE pd IS NOT NULL")
def q_prev_comparable(spark, d):
    return _previous(spark, d).select("data_date", F.col("previous.data_date").alias("previous_date"))


@query(f"WITH {PREV} SELECT data_date, pd AS previous_date, t - pt AS total_delta, round((c - pc) * (v + pv) / 2, 6) + 0.0 AS sessions_part, round((v - pv) * (c + pc) / 2, 6) + 0.0 AS depth_part, round((c - pc) * (v + pv) / 2 / nullif(t - pt, 0), 9) + 0.0 AS sessions_share, round((v - pv) * (c + pc) / 2 / nullif(t - pt, 0), 9) + 0.0 AS depth_share FROM p WHERE pd IS NOT NULL")
def q_two_factor(spark, d):
    names = {"turns": "total_turns", "sessions": "total_sessions", "average_turns": "average_turns"}
    pairs = _previous(spark, d).select("data_date", F.col("previous.data_date").alias("previous_date"), *[F.col(c).alias(f"b_{k}") for k, c in names.items()], *[F.col(f"previous.{c}").alias(f"a_{k}") for k, c in names.items()])
    return rounded(periods.two_factor(pairs), "sessions_share", "depth_share")


def _days(spark, d):
    return v.v2_turns(spark, d).filter(F.dayofmonth("data_date") % 6 != 0).groupBy("product", "data_date").agg(F.count(F.lit(1)).alias("digest")).withColumn("version", F.when(F.dayofmonth("data_date") < 10, "1.0").when(F.dayofmonth("data_date") < 20, "1.4").otherwise("1.5"))


DAYS = v.V2 + ", dy AS (SELECT 'M1' AS product, data_date, count(*) AS digest, CASE WHEN day(data_date) < 10 THEN '1.0' WHEN day(data_date) < 20 THEN '1.4' ELSE '1.5' END AS version FROM v2 WHERE day(data_date) % 6 <> 0 GROUP BY data_date)"


@query(f"WITH {DAYS} SELECT data_date, CASE version WHEN '1.4' THEN '1.5' ELSE version END AS definition, day(data_date) >= 10 AS included FROM dy")
def q_definition_families(spark, d):
    return periods.definition_families(_days(spark, d), text.definition_of(F.col("version"), {"1.4": "1.5"})).select("data_date", "definition", "included")


@query(f"WITH {DAYS} SELECT 'M1' AS product, CAST(x AS DATE) AS data_date FROM (SELECT unnest(range(min(data_date), max(data_date), INTERVAL 1 DAY)) AS x FROM dy) WHERE CAST(x AS DATE) NOT IN (SELECT data_date FROM dy)")
def q_missing_dates(spark, d):
    return periods.missing_dates(_days(spark, d))


@query(f"WITH {DAYS} SELECT product, max(data_date) AS latest_date, count(*) AS dates FROM dy GROUP BY product")
def q_latest_date(spark, d):
    return periods.latest_date(_days(spark, d))


def _derived(spark, d):
    return _days(spark, d).filter(F.dayofmonth("data_date") > 3).withColumn("digest", F.when(F.dayofmonth("data_date") % 5 == 0, F.col("digest") + 1).when(F.dayofmonth("data_date") % 7 != 0, F.col("digest")))


@query(f"WITH {DAYS} SELECT product, data_date, CASE WHEN day(data_date) <= 3 THEN 'interest_missing' WHEN day(data_date) % 5 = 0 THEN 'mismatch' WHEN day(data_date) % 7 = 0 THEN 'not_recorded' ELSE 'matched' END AS state FROM dy")
def q_alignment(spark, d):
    return periods.alignment(_days(spark, d), _derived(spark, d))


@query(f"WITH {DAYS} SELECT product, data_date FROM dy WHERE day(data_date) > 3 AND (day(data_date) % 5 = 0 OR day(data_date) % 7 = 0)")
def q_audit_p22_stale(spark, d):
    return periods.stale(_derived(spark, d), _days(spark, d))


@query(f"WITH {DAYS} SELECT count(DISTINCT version) AS definitions FROM dy")
def q_audit_p28_definitions(spark, d):
    return audit.mixed_definitions(_days(spark, d), ["product", "version"])


@query(f"WITH {DAYS} SELECT 'gap' AS rule, CAST(data_date AS VARCHAR) AS key FROM (SELECT data_date, data_date - lag(data_date) OVER (ORDER BY data_date) AS s FROM dy) WHERE s <> 1 UNION ALL SELECT 'batch', CAST(count(*) AS VARCHAR) FROM dy")
def q_audit_p21_contiguous(spark, d):
    return audit.contiguous(_days(spark, d))


# --- review


def _reviewed(spark, d):
    docs = v.table(spark, d, "documents").select("doc_id", "lang", "source").join(v.table(spark, d, "labels"), "doc_id")
    outcome = F.when(F.col("quality") == 1, F.when(F.col("toxic") == 1, "partial").otherwise("complete")).otherwise(F.when(F.col("doc_id") % 2 == 0, "unmet").otherwise("unknown"))
    return docs.withColumns({"client_id": F.col("source"), "demand": F.col("lang"), "outcome": outcome})


REV = "r AS (SELECT doc_id, lang AS demand, source AS client_id, quality, toxic, CASE WHEN quality = 1 THEN CASE WHEN toxic = 1 THEN 'partial' ELSE 'complete' END WHEN doc_id % 2 = 0 THEN 'unmet' ELSE 'unknown' END AS outcome FROM documents JOIN labels USING (doc_id))"


@query(f"WITH {REV} SELECT demand, count(*) FILTER (outcome = 'complete') AS complete, count(*) FILTER (outcome = 'partial') AS partial, count(*) FILTER (outcome = 'unmet') AS unmet, count(*) FILTER (outcome = 'unknown') AS unknown, count(DISTINCT client_id) AS users, count(DISTINCT client_id) FILTER (outcome = 'unmet') AS unmet_users, round(count(*) FILTER (outcome = 'complete') / nullif(count(*) FILTER (outcome <> 'unknown'), 0), 9) AS completion FROM r GROUP BY demand")
def q_review_outcomes(spark, d):
    return rounded(review.review_outcomes(_reviewed(spark, d)), "completion")


@query(f"WITH {REV} SELECT count(*) AS rows, round(count(*) FILTER (quality = toxic) / count(*), 9) AS toxic_accuracy, CAST(sum(CASE WHEN quality = 1 AND toxic = 1 THEN 1 ELSE 0 END) AS BIGINT) AS true_positives, round(sum(CASE WHEN quality = 1 AND toxic = 1 THEN 1 ELSE 0 END) / nullif(sum(toxic), 0), 9) AS precision, round(sum(CASE WHEN quality = 1 AND toxic = 1 THEN 1 ELSE 0 END) / nullif(sum(quality), 0), 9) AS recall FROM r")
def q_semantic_scores(spark, d):
    named = lambda c: F.when(F.col(c) == 1, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>"))
    rows = _reviewed(spark, d).withColumns({"gold_set": named("quality"), "found_set": named("toxic")})
    return rounded(review.semantic_scores(rows, [("quality", "toxic")], "gold_set", "found_set"), "toxic_accuracy", "precision", "recall")


def _strata(spark, d):
    return _reviewed(spark, d).withColumn("strata", F.array_compact(F.array(F.concat(F.lit("lang_"), "lang"), F.when(F.col("toxic") == 1, "toxic"))))


STRATA = REV + ", st AS (SELECT doc_id, 'lang_' || demand AS stratum FROM r UNION ALL SELECT doc_id, 'toxic' FROM r WHERE toxic = 1)"


@query(f"WITH {STRATA} SELECT stratum, count(*) AS population FROM st GROUP BY stratum")
def q_strata(spark, d):
    return sessions.strata_population(_strata(spark, d), "strata")


@query(f"WITH {STRATA} SELECT doc_id, stratum, CAST(k AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY sha256('v1' || CAST(doc_id AS VARCHAR))) AS k FROM st) WHERE k <= 12")
def q_stratified_sample(spark, d):
    return sessions.stratified_sample(_strata(spark, d), "strata", "doc_id", 12, "v1")


@query("SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'missing' WHEN doc_id % 13 = 0 THEN 'repeated' ELSE 'changed' END AS problem FROM documents WHERE doc_id % 11 = 0 OR doc_id % 13 = 0 OR doc_id % 17 = 0")
def q_sealed_join(spark, d):
    docs = v.table(spark, d, "documents").select("doc_id", "lang")
    back = docs.filter("doc_id % 11 != 0").withColumn("lang", F.when(F.col("doc_id") % 17 == 0, "?").otherwise(F.col("lang")))
    return review.sealed_join(docs, back.unionByName(back.filter("doc_id % 13 = 0")), "doc_id", ["lang"])


SESS = v.V3 + ", ss AS (SELECT client_id, cid, count(*) AS n, min(polarity) AS pol FROM m GROUP BY client_id, cid), cs AS (SELECT ss.*, c_mktsegment AS label FROM ss JOIN customer ON client_id = CAST(c_custkey AS VARCHAR))"


def _sessions3(spark, d):
    s = v.v3_mentions(spark, d).groupBy("client_id", "cid").agg(F.count(F.lit(1)).alias("n"), F.min("polarity").alias("pol"))
    return s.join(v.table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("client_id"), F.col("c_mktsegment").alias("label")), "client_id")


@query(f"WITH {SESS}, a AS (SELECT label, count(DISTINCT client_id) AS users, count(*) AS sessions, CAST(sum(n) AS BIGINT) AS turns, count(*) FILTER (n >= 5) AS f FROM cs GROUP BY label) SELECT label, users, round(users / (SELECT sum(users) FROM a), 9) AS share, sessions, turns, round(turns / sessions, 9) AS average_turns, round(f / sessions, 9) AS five_plus_share, CASE WHEN users >= 30 THEN 'describable' ELSE 'small_sample' END AS sample FROM a")
def q_profile_section(spark, d):
    return rounded(review.profile_section(_sessions3(spark, d), "label"), "share", "average_turns", "five_plus_share")


@query(f"WITH {SESS} SELECT pol, count(*) AS rows, round(count(*) / (SELECT count(*) FROM cs), 9) AS share FROM cs GROUP BY pol")
def q_intent_shares(spark, d):
    return rounded(review.intent_shares(_sessions3(spark, d), "pol"), "share")


@query(f"WITH {SESS}, a AS (SELECT pol, count(*) AS c, count(*) FILTER (n = 1) AS e FROM cs GROUP BY pol), b AS (SELECT pol, c AS all_count, c / (SELECT sum(c) FROM a) AS x, e AS ending_count, e / (SELECT sum(e) FROM a) AS y FROM a) SELECT pol, all_count, round(x, 9) AS all_share, ending_count, round(y, 9) AS ending_share, round(y - x, 9) AS difference FROM b")
def q_share_comparison(spark, d):
    s = _sessions3(spark, d)
    return rounded(review.share_comparison(s, s.filter("n = 1"), "pol"), "all_share", "ending_share", "difference")


@query("SELECT o_orderpriority AS difficulty, count(*) AS exposures, count(*) FILTER (o_orderstatus = 'F') AS opened, round(count(*) FILTER (o_orderstatus = 'F') / count(*), 9) AS open_rate FROM orders GROUP BY o_orderpriority")
def q_difficulty(spark, d):
    rows = v.table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("difficulty"), "o_custkey").agg(F.count(F.lit(1)).alias("exposures"), F.count_if(F.col("o_orderstatus") == "F").alias("opened"))
    return rounded(review.difficulty_totals(rows), "open_rate")


@query("WITH f AS (SELECT user_id, event_type = 'error' AS a, value > 50 AS b FROM events), u AS (SELECT user_id, bool_or(a OR b) AS x FROM f GROUP BY user_id) SELECT count(*) AS rows, count(*) FILTER (a) AS errors, count(*) FILTER (b) AS large, round(count(*) FILTER (a) / count(*), 9) AS errors_rate, round(count(*) FILTER (b) / count(*), 9) AS large_rate, (SELECT count(*) FROM u) AS users, (SELECT count(*) FROM u WHERE x) AS candidate_users, round((SELECT count(*) FROM u WHERE x) / (SELECT count(*) FROM u), 9) AS candidate_user_rate FROM f")
def q_risk_summary(spark, d):
    flags = v.table(spark, d, "events").select(F.col("user_id").alias("client_id"), (F.col("event_type") == "error").alias("a"), (F.col("value") > 50).alias("b"))
    out = review.risk_summary(flags, {"errors": "a", "large": "b"})
    return rounded(out.withColumn("candidate_users", F.col("candidate_users").cast("long")), "errors_rate", "large_rate", "candidate_user_rate")

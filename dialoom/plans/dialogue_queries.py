"""Matching, classification, candidate, audit and incremental queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from dialoom.functions import rules, text
from dialoom.operators import audit, candidates, classify, interest, matching, periods, review, sessions
from dialoom.plans import views as v
from dialoom.plans.queries import DAYS, HITS, LATEST, SEG, STRUCTURE, V2A, _active, _daily, _days, _hits, _pairs, _reviewed, _sessions3, _user_days, _whole, domain, query, rounded
from dialoom.sources import readers, sinks
from dialoom.sources.shared import shared_path

#: The six literal aliases of the dictionary view; they overlap on purpose.
WORDS = ("there", "the", "thing", "hand", "and", "ion")
ALIASES = [matching.Alias(w, w, w) for w in WORDS]
ORDERED = [a.normalized for a in matching.ordered(ALIASES)]
NORM_SQL = r"""regexp_replace(replace(lower(text), 'ß', 'ss'), '[\s，。！？、,.!?；;：:“”"''‘’（）()《》【】\[\]~～_\-]+', '', 'g')"""


def _greedy_sql(source: str, key: str, step: str = "g", at: str = "s", norm: str = "norm") -> str:
    """The greedy match unrolled over the six aliases."""
    steps = [f"{step}0 AS (SELECT {key}, {NORM_SQL} AS {norm} FROM {source})"]
    for i, a in enumerate(ORDERED):
        free = " AND ".join(["true", *[f"NOT ({at}{j} > 0 AND strpos({norm}, '{a}') < {at}{j} + {len(ORDERED[j])} AND strpos({norm}, '{a}') + {len(a)} > {at}{j})" for j in range(i)]])
        steps.append(f"{step}{i + 1} AS (SELECT *, CASE WHEN strpos({norm}, '{a}') > 0 AND {free} THEN strpos({norm}, '{a}') ELSE 0 END AS {at}{i} FROM {step}{i})")
    return ", ".join(steps)


def _docs(spark, d):
    return _whole(spark, d).filter("lang = 'en'").select("doc_id", "text")


LAST = f"g{len(ORDERED)}"
EN = "en AS (SELECT doc_id, text FROM documents WHERE lang = 'en')"


@query(f"WITH {EN}, n AS (SELECT doc_id, {NORM_SQL} AS norm FROM en) " + " UNION ALL ".join(f"SELECT doc_id, '{a}' AS entity_id, CAST(strpos(norm, '{a}') - 1 AS INTEGER) AS start FROM n WHERE strpos(norm, '{a}') > 0" for a in ORDERED))
def q_alias_hits(spark, d):
    return _every_hit(_docs(spark, d))


@query()
def q_alias_hits_whole(spark, d):
    return _every_hit(_whole(spark, d))


def _every_hit(df):
    return df.select("doc_id", F.inline(matching.hits_of(F.col("text"), ALIASES, greedily=False))).select("doc_id", "entity_id", "start")


GREEDY = f"WITH {EN}, {_greedy_sql('en', 'doc_id')} " + " UNION ALL ".join(f"SELECT doc_id, '{a}' AS entity_id, CAST(s{i} - 1 AS INTEGER) AS start FROM {LAST} WHERE s{i} > 0" for i, a in enumerate(ORDERED))


@query(GREEDY)
def q_match_greedy(spark, d):
    return matching.match(_docs(spark, d), "text", ALIASES).select("doc_id", F.inline("hits")).select("doc_id", "entity_id", "start")


@query()
def q_match_greedy_whole(spark, d):
    return matching.match(_whole(spark, d), "text", ALIASES).select("doc_id", F.inline("hits")).select("doc_id", "entity_id", "start")


@query(GREEDY)
def q_match_by_gram(spark, d):
    return matching.match_by_gram(_docs(spark, d), "text", ALIASES, "hits", "doc_id").select("doc_id", F.inline("hits")).select("doc_id", "entity_id", "start")


@query()
def q_match_by_gram_whole(spark, d):
    return matching.match_by_gram(_whole(spark, d), "text", ALIASES, "hits", "doc_id").select("doc_id", F.inline("hits")).select("doc_id", "entity_id", "start")


@query("WITH a AS (SELECT * FROM (VALUES ('1', 'a'), ('2', 'b')) t(entity_id, value)) SELECT DISTINCT CAST(p_partkey % 5 AS VARCHAR) AS entity_id, p_type AS value FROM part WHERE p_size < 25 UNION SELECT DISTINCT CAST(p_partkey % 5 AS VARCHAR), p_type FROM part")
def q_effective_aliases(spark, d):
    p = v.table(spark, d, "part").select((F.col("p_partkey") % 5).cast("string").alias("entity_id"), F.col("p_type").alias("value"), "p_size")
    return matching.effective_aliases(p.filter("p_size < 25").drop("p_size").distinct(), p.drop("p_size").distinct())


def _labelled(spark, d):
    return classify.with_row_labels(v.v1_turns(spark, d), ALIASES, {})


def _case(pairs, otherwise):
    return "CASE " + " ".join(f"WHEN {t} THEN '{x}'" for t, x in pairs) + f" ELSE '{otherwise}' END"


def _m(pattern):
    return f"regexp_matches(norm, '{pattern}')"


ANY_HIT = " OR ".join(f"strpos(norm, '{a}') > 0" for a in ORDERED)
ROUTE_SQL = _case([("is_template = '是'", rules.ROUTES[0]), (ANY_HIT, rules.ROUTES[5]), (f"norm = '' OR {_m('^[0-9]+$')}", rules.ROUTES[1]), (_m(rules.DEVICE_CONTROL), rules.ROUTES[3]), (_m(rules.PURE_DIALOGUE), rules.ROUTES[2]),
                   (f"{_m(rules.DEICTIC_ONLY)} OR {_m(rules.CHINESE_NUMBER)}", rules.ROUTES[4]), (f"length(norm) <= 1 OR (length(norm) <= 2 AND NOT {_m(rules.CONTENT_HINT)})", rules.ROUTES[1])], rules.ROUTES[5])
TOPIC_SQL = _case([(_m(r), t) for r, t in zip(rules.TOPIC_RULES, rules.TOPICS, strict=False)], rules.TOPICS[-1])
BEHAVIOR_SQL = _case([(_m(p), rules.BEHAVIORS[i]) for p, i in ((rules.CORRECTION, 6), (rules.PREFERENCE, 5), (rules.CONTENT_REQUEST, 2), (rules.PLAY, 3), (rules.QUESTION, 1), (rules.DEICTIC_ONLY, 7), (rules.SHARE, 4))], rules.BEHAVIORS[0])
V1N = f"{v.V1}, n AS (SELECT *, {NORM_SQL} AS norm FROM v1), l AS (SELECT source_row, {ROUTE_SQL} AS route, {TOPIC_SQL} AS topic, {BEHAVIOR_SQL} AS behavior FROM n)"


def _domain_sql(column, values, rows):
    return f"WITH {V1N}, x AS (SELECT * FROM l WHERE {rows}), d AS (SELECT unnest([{', '.join(repr(x) for x in values)}]) AS {column}), cc AS (SELECT {column}, count(*) AS n FROM x GROUP BY {column}) SELECT {column}, coalesce(n, 0) AS rows, round(coalesce(coalesce(n, 0) / nullif((SELECT count(*) FROM x), 0), 0.0), 9) AS share FROM d LEFT JOIN cc USING ({column})"


@query(_domain_sql("route", rules.ROUTES, "true"))
def q_routes(spark, d):
    return rounded(interest.domain_counts(_labelled(spark, d).select(F.col("row_route").alias("route")), "route", domain(spark, "route", rules.ROUTES)), "share")


@query(_domain_sql("topic", rules.TOPICS, f"route = '{rules.ROUTES[5]}'"))
def q_topics(spark, d):
    return rounded(interest.domain_counts(_labelled(spark, d).filter("is_content").select(F.col("row_topic").alias("topic")), "topic", domain(spark, "topic", rules.TOPICS)), "share")


@query(_domain_sql("behavior", rules.BEHAVIORS, f"route = '{rules.ROUTES[5]}'"))
def q_behaviors(spark, d):
    return rounded(interest.domain_counts(_labelled(spark, d).filter("is_content").select(F.col("row_behavior").alias("behavior")), "behavior", domain(spark, "behavior", rules.BEHAVIORS)), "share")


@query(f"WITH n AS (SELECT event_id, CASE event_type WHEN 'view' THEN '我喜欢看' WHEN 'click' THEN '不喜欢' WHEN 'error' THEN '不喜欢这个但喜欢那个' ELSE event_type END AS norm FROM events) SELECT event_id, CASE WHEN neg AND pos THEN 'mixed' WHEN neg THEN 'negative' WHEN pos THEN 'positive' ELSE 'neutral' END AS polarity FROM (SELECT event_id, {_m(rules.NEGATIVE)} AS neg, regexp_matches(regexp_replace(norm, '{rules.NEGATIVE}', '', 'g'), '{rules.POSITIVE}') AS pos FROM n)")
def q_polarity(spark, d):
    said = F.when(F.col("event_type") == "view", "我喜欢看").when(F.col("event_type") == "click", "不喜欢").when(F.col("event_type") == "error", "不喜欢这个但喜欢那个").otherwise(F.col("event_type"))
    return v.table(spark, d, "events").select("event_id", rules.polarity(said).alias("polarity"))


#: Turns whose texts ask to go on, name entities again and judge them, so that contexts are carried over several turns.
SPOKEN = f"""WITH RECURSIVE {v.V1}, spoken AS (SELECT * REPLACE (
  CASE (turn_index // 2 + source_row // 1000) % 6 WHEN 1 THEN '继续' WHEN 2 THEN '然后呢' WHEN 3 THEN '我喜欢the，thing不喜欢hand' WHEN 4 THEN text || '，想看ion' WHEN 5 THEN '还有呢' ELSE text END AS text,
  CASE (turn_index // 2 + source_row // 1000) % 4 WHEN 0 THEN '' WHEN 1 THEN 'hand' WHEN 2 THEN '讲the' ELSE ai_text END AS ai_text) FROM v1)"""
PLAIN = f"WITH RECURSIVE {v.V1}, spoken AS (SELECT * FROM v1)"


def _spoken(spark, d):
    k = F.floor(F.col("turn_index") / 2) + F.floor(F.col("source_row") / 1000)
    said = F.when(k % 6 == 1, "继续").when(k % 6 == 2, "然后呢").when(k % 6 == 3, "我喜欢the，thing不喜欢hand").when(k % 6 == 4, F.concat("text", F.lit("，想看ion"))).when(k % 6 == 5, "还有呢").otherwise(F.col("text"))
    heard = F.when(k % 4 == 0, "").when(k % 4 == 1, "hand").when(k % 4 == 2, "讲the").otherwise(F.col("ai_text"))
    return v.v1_turns(spark, d).withColumns({"text": said, "ai_text": heard})


def _clause_sql(i: int) -> str:
    """E9 of alias i in the row's norm and pieces."""
    a = ORDERED[i]
    whole = f"coalesce(nullif(array_to_string(list_filter(pieces, lambda p: strpos(p, '{a}') > 0), ''), ''), norm)"
    others = [f"CASE WHEN s{j} > 0 THEN strpos(w, '{x}') END" for j, x in enumerate(ORDERED) if j != i]
    ends = ", ".join(f"CASE WHEN {p} > 0 AND {p} < t THEN {p} - 1 + {len(x)} END" for p, x in zip(others, [x for x in ORDERED if x != a], strict=True))
    starts = ", ".join(f"CASE WHEN {p} > t THEN {p} - 1 END" for p in others)
    cut = f"(SELECT CASE WHEN e < length(w) AND regexp_matches(rest, '{rules.NEXT_PREDICATE}') THEN t - 1 + {len(a)} + length(regexp_extract(rest, '^(.*?)(?:{rules.NEXT_PREDICATE})', 1)) ELSE e END AS stop, b, w FROM (SELECT *, substr(w, t + {len(a)}, greatest(e - t + 1 - {len(a)}, 0)) AS rest FROM (SELECT w, t, coalesce(list_max([{ends}]), 0) AS b, coalesce(list_min([{starts}]), length(w)) AS e FROM (SELECT w, strpos(w, '{a}') AS t FROM (SELECT {whole} AS w)))))"
    return f"(SELECT substr(w, b + 1, greatest(stop - b, 0)) FROM {cut})"


def _listed(prefix: str) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {prefix}{i} > 0 THEN '{a}' END" for i, a in enumerate(ORDERED)) + "], lambda x: x IS NOT NULL)"


def _fold_sql(head: str) -> str:
    """The session fold, one turn after the other, by a recursive table; ``done`` has a row for each turn."""
    entity = ", ".join(
        f"CASE WHEN s{i} > 0 AND usable THEN {{'entity_id': '{a}', 'signal': CASE WHEN list_contains(users, '{a}') OR list_contains(assistants, '{a}') OR strpos(before_ai, '{a}') > 0 THEN CASE WHEN regexp_matches(c{i}, '{rules.SUBSTANTIVE}') AND c{i} <> '{a}' THEN '{rules.SIGNALS[2]}' ELSE '{rules.SIGNALS[3]}' END ELSE '{rules.SIGNALS[1]}' END, "
        f"'polarity': CASE WHEN regexp_matches(c{i}, '{rules.NEGATIVE}') AND regexp_matches(regexp_replace(c{i}, '{rules.NEGATIVE}', '', 'g'), '{rules.POSITIVE}') THEN 'mixed' WHEN regexp_matches(c{i}, '{rules.NEGATIVE}') THEN 'negative' WHEN regexp_matches(c{i}, '{rules.POSITIVE}') THEN 'positive' ELSE 'neutral' END, 'basis': 'explicit_alias'}} END"
        for i, a in enumerate(ORDERED)
    )
    carried = f"[{{'entity_id': context[1], 'signal': '{rules.SIGNALS[2]}', 'polarity': 'neutral', 'basis': 'single_context'}}]"
    mine, heard = _greedy_sql("spoken", "source_row"), _greedy_sql("(SELECT source_row, ai_text AS text FROM spoken)", "source_row", "h", "a", "ai_norm")
    inherits = "usable AND asks AND len(named) = 0 AND len(list_distinct(list_concat(f.next_users, f.next_ai))) = 1"
    return f"""{head}, {mine}, {heard},
facts AS (SELECT spoken.*, norm, ai_norm, {", ".join(f"s{i}" for i in range(len(ORDERED)))}, {_listed("a")} AS ai_ids, is_template <> '是' AS usable, regexp_matches(norm, '{rules.CONTINUE_REQUEST}') AS asks, {ROUTE_SQL} AS row_route, {TOPIC_SQL} AS row_topic, {BEHAVIOR_SQL} AS row_behavior,
  list_transform(regexp_split_to_array(text, '{rules.CLAUSE_BREAK}'), lambda p: {NORM_SQL.replace("text", "p")}) AS pieces, CASE WHEN is_template <> '是' THEN {_listed("s")} ELSE [] END AS named FROM spoken JOIN {LAST} USING (source_row) JOIN h{len(ORDERED)} USING (source_row)),
turns AS (SELECT *, row_route = '{rules.ROUTES[5]}' AS content, row_number() OVER (PARTITION BY cid ORDER BY source_row) AS r FROM facts),
fold AS (SELECT cid, r, source_row, CAST([] AS VARCHAR[]) AS users, CAST([] AS VARCHAR[]) AS assistants, '' AS before_ai, CAST([] AS VARCHAR[]) AS context, false AS inherited, CASE WHEN content THEN named ELSE [] END AS next_users, ai_ids AS next_ai, ai_norm AS next_norm FROM turns WHERE r = 1
  UNION ALL SELECT t.cid, t.r, t.source_row, f.next_users, f.next_ai, f.next_norm, list_distinct(list_concat(f.next_users, f.next_ai)), {inherits}, CASE WHEN {inherits} THEN list_distinct(list_concat(f.next_users, f.next_ai)) WHEN content THEN named ELSE [] END, ai_ids, ai_norm FROM fold f JOIN turns t ON t.cid = f.cid AND t.r = f.r + 1),
clauses AS (SELECT source_row, {", ".join(f"CASE WHEN s{i} > 0 THEN {_clause_sql(i)} END AS c{i}" for i in range(len(ORDERED)))} FROM turns),
done AS (SELECT *, CASE WHEN len(list_distinct(list_transform(entities, lambda x: x.signal))) = 1 THEN entities[1].signal ELSE '{rules.SIGNALS[0]}' END AS signal FROM (
  SELECT turns.source_row, turns.cid, client_id, turn_index, CASE WHEN inherited THEN '{rules.ROUTES[5]}' ELSE row_route END AS route, CASE WHEN inherited OR content THEN row_topic END AS topic,
  CASE WHEN inherited OR row_route = '{rules.ROUTES[4]}' THEN '{rules.BEHAVIORS[7]}' WHEN content THEN row_behavior END AS behavior, CASE WHEN inherited THEN {carried} ELSE list_filter([{entity}], lambda x: x IS NOT NULL) END AS entities
  FROM turns JOIN fold USING (source_row) JOIN clauses USING (source_row)))"""


FOLDED = """SELECT source_row, route, behavior, signal, '[' || array_to_string(list_transform(entities, lambda e: '{"entity_id":"' || e.entity_id || '","signal":"' || e.signal || '","polarity":"' || e.polarity || '","basis":"' || e.basis || '"}'), ',') || ']' AS entities FROM done"""
SAID = "SELECT e.entity_id AS entity_id, e.signal AS signal, e.polarity AS polarity, count(*) AS rows FROM (SELECT unnest(entities) AS e FROM done WHERE route = '" + rules.ROUTES[5] + "') GROUP BY ALL"


def _folded(turns):
    return classify.classify_turns(turns, ALIASES).select("source_row", "route", "behavior", "signal", F.to_json("entities").alias("entities"))


def _said(turns):
    return classify.mentions(classify.classify_turns(turns, ALIASES)).groupBy("entity_id", "signal", "polarity").agg(F.count(F.lit(1)).alias("rows"))


@query(f"{_fold_sql(PLAIN)} {FOLDED}")
def q_context_fold(spark, d):
    return _folded(v.v1_turns(spark, d))


@query(f"{_fold_sql(SPOKEN)} {FOLDED}")
def q_context_chain(spark, d):
    """The same over turns that carry contexts."""
    return _folded(_spoken(spark, d))


@query(f"{_fold_sql(PLAIN)} {SAID}")
def q_signals(spark, d):
    return _said(v.v1_turns(spark, d))


@query(f"{_fold_sql(SPOKEN)} {SAID}")
def q_signals_carried(spark, d):
    return _said(_spoken(spark, d))


@query()
def q_safe_turns(spark, d):
    return sinks.safe_turns(classify.classify_turns(v.v1_turns(spark, d), ALIASES), "v1")


KEYED = "substr(sha256('{kind}' || chr(0) || 'v1' || chr(0) || {value}), 1, 20)"


@query(_fold_sql(SPOKEN) + f" SELECT source_row, {KEYED.format(kind='user', value='client_id')} AS user_key, {KEYED.format(kind='session', value='cid')} AS session_key, turn_index, route, topic, behavior, signal, " + ", ".join(f"array_to_string(list_transform(entities, lambda e: e.{one}), '|') AS {many}" for one, many in (("entity_id", "entity_ids"), ("signal", "signals"), ("polarity", "polarities"), ("basis", "bases"))) + " FROM done")
def q_safe_turn_lists(spark, d):
    """The pseudonymised turns with their lists as text."""
    out = sinks.safe_turns(classify.classify_turns(_spoken(spark, d), ALIASES), "v1")
    return out.withColumns({c: text.joined(F.col(c)) for c in ("entity_ids", "signals", "polarities", "bases")})


# --- exports and stored days, written and read back


def _exported(turns, sep):
    """The rows as a quoted export in the shared folder, texts with marks and line ends inside."""
    path = shared_path(turns.sparkSession, "export")
    turns.write.option("header", True).option("sep", sep).option("quoteAll", True).option("escape", '"').option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


NOISY = "text || chr(10) || 'said \"' || turn_index || '\", twice' || chr(9)"


def _noisy(spark, d):
    return v.v1_turns(spark, d).withColumn("text", F.concat("text", F.lit('\nsaid "'), F.col("turn_index").cast("string"), F.lit('", twice\t')))


@query(f"WITH {v.V1} SELECT source_row, cid, client_id, {NOISY} AS text, ai_text, CAST(turn_index AS INTEGER) AS turn_index FROM v1")
def q_turn_export(spark, d):
    """Turns through a comma export and back."""
    turns = _noisy(spark, d).withColumnRenamed("client_id", "clientId")
    turns = turns.withColumns({c: F.lit("x") for c in readers.TURN_COLUMNS if c not in turns.columns})
    return readers.turn_csv(spark, _exported(turns, ",")).select("source_row", "cid", "client_id", "text", "ai_text", "turn_index")


@query(f"WITH {v.V1} SELECT CAST(source_row AS VARCHAR) AS id, {NOISY} AS text, count(*) OVER () AS records FROM v1")
def q_raw_export(spark, d):
    """Turns through a tab export and back; the record numbers of its files, which begin at 2, tell how many records there are."""
    path = _exported(_noisy(spark, d).select(F.col("source_row").alias("id"), "text"), "\t")
    records = readers.raw_export(spark, path)
    numbered = records.groupBy("source_row").agg(F.count(F.lit(1)).alias("files")).agg(F.sum("files").alias("records"), F.max("source_row").alias("highest"), F.count(F.lit(1)).alias("numbers"))
    sound = numbered.filter(F.col("highest") == F.col("numbers") + 1).select("records")  # no number is missing
    return records.select("id", "text").crossJoin(F.broadcast(sound))


STORED = "SELECT CAST(event_id AS BIGINT) AS event_id, CAST(ts AS DATE) AS data_date, CASE WHEN day(ts) % 2 = 0 THEN value * 2 ELSE value END AS value FROM events WHERE NOT (day(ts) % 2 = 0 AND event_id % 3 = 0)"


@query(STORED)
def q_replaced_days(spark, d):
    """All days stored, then the even ones again with fewer and other rows; a replaced day keeps none of its old rows."""
    e = v.table(spark, d, "events").select(F.col("event_id").cast("long").alias("event_id"), F.to_date("ts").alias("data_date"), "value", F.lit("M1").alias("product"))
    path = shared_path(spark, "days")
    sinks.replace_days(e, path)
    even = e.filter((F.dayofmonth("data_date") % 2 == 0) & (F.col("event_id") % 3 != 0)).withColumn("value", F.col("value") * 2)
    sinks.replace_days(even, path)
    return sinks.stored(spark, path).select("event_id", "data_date", "value")


@query("SELECT CAST(event_id AS BIGINT) AS event_id, CAST(ts AS DATE) AS data_date, CASE WHEN day(ts) % 2 = 0 THEN value * 2 ELSE value END AS value FROM events WHERE day(ts) % 5 <> 0 AND NOT (day(ts) % 2 = 0 AND event_id % 3 = 0)")
def q_published_days(spark, d):
    """All days published, the even ones again with fewer and other rows and every fifth without any, then a run whose audit fails."""
    e = v.table(spark, d, "events").select(F.col("event_id").cast("long").alias("event_id"), F.to_date("ts").alias("data_date"), "value", F.lit("M1").alias("product"))
    path, day = shared_path(spark, "published"), F.dayofmonth("data_date")
    sinks.publish_days(e, path)
    again = e.filter((day % 2 == 0) | (day % 5 == 0))
    sinks.publish_days(again.filter((day % 5 != 0) & (F.col("event_id") % 3 != 0)).withColumn("value", F.col("value") * 2), path, again)
    try:
        sinks.publish_days(e.withColumn("value", F.lit(-1.0)), path, audits=lambda rows: [rows.filter("value < 0")])
    except ValueError:
        return sinks.published(spark, path).select("event_id", "data_date", "value")
    raise AssertionError("the audit did not hold the run back")


@query("SELECT CAST(event_id AS BIGINT) AS event_id, CAST(ts AS DATE) AS data_date FROM events WHERE CAST(ts AS DATE) IN (SELECT DISTINCT CAST(ts AS DATE) FROM events WHERE value > 99)")
def q_backed_up_days(spark, d):
    """The days that are about to be replaced, copied whole."""
    e = v.table(spark, d, "events").select(F.col("event_id").cast("long").alias("event_id"), F.to_date("ts").alias("data_date"), "value", F.lit("M1").alias("product"))
    path, copy = shared_path(spark, "days"), shared_path(spark, "copy")
    sinks.replace_days(e, path)
    sinks.backup_days(spark, path, e.filter("value > 99"), copy)
    return readers.history(spark, copy, "M1", "1900-01-01", "2999-12-31").select("event_id", "data_date")


@query("SELECT CAST(ts AS DATE) AS data_date, false AS again, day(CAST(ts AS DATE)) = 1 AS changed FROM events GROUP BY 1")
def q_unchanged_days(spark, d):
    """Whether each day would be written again, as stored and with the values of the first of a month changed; both answers come from the stored rows."""
    e = v.table(spark, d, "events").select(F.col("event_id").cast("long").alias("event_id"), F.to_date("ts").alias("data_date"), "value", F.lit("M1").alias("product"))
    path = shared_path(spark, "days")
    sinks.replace_if_changed(e, path)
    again = sinks.replace_if_changed(e, path)
    old = periods.table_digest(sinks.stored(spark, path).select(*e.columns), "data_date")
    new = periods.table_digest(e.withColumn("value", F.when(F.dayofmonth("data_date") == 1, F.col("value") + 1).otherwise(F.col("value"))).select(*e.columns), "data_date")
    same = [c for c in old.columns if c != "data_date"]
    both = old.join(new.withColumnsRenamed({c: f"new_{c}" for c in same}), "data_date")
    changed = ~F.lit(True)
    for c in same:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"new_{c}"))
    return both.select("data_date", F.lit(again).alias("again"), changed.alias("changed"))


# --- candidates


def _phrased(spark, d):
    return v.v2_turns(spark, d).withColumn("text", F.concat_ws(" ", "event_type", F.col("k").cast("string")))


def _found(spark, d):
    found = candidates.candidate_phrases(_phrased(spark, d), keep=("client_id", "cid", "text", "data_date"))
    return candidates.unknown(found, ALIASES)


CAND = v.V2 + ", p AS (SELECT *, event_type || ' ' || CAST(k AS VARCHAR) AS phrase, event_type || CAST(k AS VARCHAR) AS norm FROM v2), ca AS (SELECT norm, min(phrase) AS phrase, count(*) AS query_count, count(DISTINCT client_id) AS users, count(DISTINCT cid) AS sessions, list_aggregate(list_sort(list(DISTINCT phrase))[1:3], 'string_agg', '|') AS examples FROM p GROUP BY norm)"


@query(f"WITH {CAND} SELECT source_row, norm, phrase FROM p")
def q_candidate_phrases(spark, d):
    return candidates.candidate_phrases(_phrased(spark, d))


@query(f"WITH {v.V2} SELECT source_row, CASE WHEN event_type = 'signup' THEN CAST(k AS VARCHAR) ELSE event_type || CAST(k AS VARCHAR) END AS norm FROM v2 WHERE event_type <> 'signup' OR k >= 10")
def q_candidate_cooccurrence(spark, d):
    t = v.v2_turns(spark, d)
    t = t.withColumns({"text": F.concat("event_type", F.col("k").cast("string"), F.lit("和signup"), (F.col("k") % 7).cast("string")), "known": F.array(F.lit("signup"))})
    return candidates.candidate_phrases(t, aliases_col="known").select("source_row", "norm")


@query(f"WITH {CAND} SELECT * FROM ca WHERE users >= 5 AND sessions >= 8")
def q_candidates(spark, d):
    out = candidates.eligible(candidates.aggregate_candidates(_found(spark, d), least_rows=3))
    return out.select("norm", "phrase", "query_count", "users", "sessions", text.joined(F.col("examples")).alias("examples"))


#: Phrases of which some are generic (C3) and some hold an alias of the dictionary (C5), by event type.
MINED = {"view": "会飞的邮筒", "click": "The Hand", "purchase": "什么东西", "signup": "香草味", "error": "嘻嘻嘻"}


def _mined_sql() -> str:
    said = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{p}'" for k, p in MINED.items()) + " ELSE event_type END || CASE WHEN k % 3 = 0 THEN '' ELSE CAST(k % 5 AS VARCHAR) END"
    generic = f"norm IN ({', '.join(repr(x) for x in candidates.STOP)}) OR " + " OR ".join(f"regexp_matches(norm, '{p}')" for p in (candidates.DIALOGUE, candidates.ASKING, candidates.BEGINNING, candidates.ENDING, candidates.FALLBACK_ASKING))
    known = " OR ".join(f"strpos(norm, '{a}') > 0" for a in ORDERED)
    return f"WITH {v.V2}, said AS (SELECT client_id, cid, {said} AS text FROM v2), normal AS (SELECT *, {NORM_SQL} AS norm FROM said) SELECT norm, min(text) AS phrase, count(*) AS query_count, count(DISTINCT client_id) AS users, count(DISTINCT cid) AS sessions FROM normal WHERE length(norm) BETWEEN 2 AND 12 AND NOT ({generic}) AND NOT ({known}) GROUP BY norm"


@query(_mined_sql())
def q_candidates_mined(spark, d):
    """Phrases of which the generic ones and those that the dictionary knows go."""
    spoken = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in MINED.items() for x in pair]), F.col("event_type")), F.col("event_type"))
    t = v.v2_turns(spark, d)
    t = t.withColumn("text", F.concat(spoken, F.when(F.col("k") % 3 == 0, "").otherwise((F.col("k") % 5).cast("string"))))
    found = candidates.unknown(candidates.candidate_phrases(t, keep=("client_id", "cid", "text")), ALIASES)
    return candidates.aggregate_candidates(found).drop("examples")


@query(f"WITH {CAND} SELECT norm, users FROM (SELECT * FROM ca WHERE users >= 5 AND sessions >= 8 ORDER BY users DESC, sessions DESC, query_count DESC, norm LIMIT 10 OFFSET 20)")
def q_candidate_page(spark, d):
    return candidates.page(candidates.eligible(candidates.aggregate_candidates(_found(spark, d))), 20, 10).select("norm", "users")


@query("""WITH s AS (SELECT CAST(o_custkey AS VARCHAR) AS norm, count(*) AS users, count(DISTINCT o_orderstatus) AS sessions, count(DISTINCT o_orderpriority) AS query_count FROM orders GROUP BY o_custkey)
 SELECT norm, users, sessions, query_count FROM s ORDER BY users DESC, sessions DESC, query_count DESC, norm LIMIT 25 OFFSET 50""")
def q_page_after(spark, d):
    """The third page of customers by orders, reached from the last row of the page before."""
    o = v.table(spark, d, "orders")
    stats = o.groupBy(F.col("o_custkey").cast("string").alias("norm")).agg(F.count(F.lit(1)).alias("users"), F.count_distinct("o_orderstatus").alias("sessions"), F.count_distinct("o_orderpriority").alias("query_count"))
    last = None
    for _ in range(2):
        last = candidates.page_after(stats, last, 25).orderBy(F.asc("users"), F.asc("sessions"), F.asc("query_count"), F.desc("norm")).first()
    return candidates.page_after(stats, last, 25).select("norm", "users", "sessions", "query_count")


@query(f"WITH {CAND} SELECT norm, users, sessions, query_count FROM ca ORDER BY users DESC, sessions DESC, query_count DESC, norm LIMIT 200")
def q_candidate_top(spark, d):
    return candidates.ranked(candidates.aggregate_candidates(_found(spark, d))).select("norm", "users", "sessions", "query_count")


DAYC = CAND + ", dc AS (SELECT data_date, norm, min(phrase) AS phrase, count(*) AS query_count, count(DISTINCT client_id) AS users, count(DISTINCT cid) AS sessions FROM p GROUP BY data_date, norm), md AS (SELECT norm, CAST(sum(query_count) AS BIGINT) AS query_count, CAST(sum(users) AS BIGINT) AS user_days, count(DISTINCT data_date) AS days, min(data_date) AS first_date, max(data_date) AS last_date FROM dc GROUP BY norm HAVING bool_or(users >= 3) OR (count(DISTINCT data_date) >= 2 AND sum(users) >= 10 AND sum(sessions) >= 12))"


def _day_candidates(spark, d):
    return candidates.aggregate_candidates(_found(spark, d), "data_date").withColumn("eligible", F.col("users") >= 3)


@query(f"WITH {DAYC} SELECT * FROM md")
def q_candidates_multi_day(spark, d):
    return candidates.merge_days(_day_candidates(spark, d)).select("norm", "query_count", "user_days", "days", "first_date", "last_date")


@query(f"WITH {DAYC}, r AS (SELECT data_date, norm, row_number() OVER (PARTITION BY data_date ORDER BY users DESC, sessions DESC, query_count DESC, norm) AS k FROM dc WHERE norm IN (SELECT norm FROM md)) SELECT data_date, norm, CAST(k AS INTEGER) AS rank FROM r WHERE k <= 10")
def q_candidate_pushback(spark, d):
    daily = _day_candidates(spark, d)
    return candidates.push_back(daily, candidates.merge_days(daily)).select("data_date", "norm", "rank")


@query(f"WITH {CAND} SELECT norm, norm LIKE '%1' AS degraded, CASE WHEN norm LIKE '%1' THEN '其他' ELSE '作品' END AS suggested_type, CASE WHEN norm LIKE '%1' THEN 0.0 ELSE 0.5 END::DOUBLE AS confidence FROM ca")
def q_candidate_suggestions(spark, d):
    stats = candidates.aggregate_candidates(_found(spark, d)).select("norm")
    known = stats.filter("norm not like '%1'").select("norm", F.lit("作品").alias("suggested_type"), F.lit(0.5).alias("confidence"))
    return candidates.with_suggestions(stats, known).select("norm", "degraded", "suggested_type", "confidence")


# --- audits: violations in rows that the query spoils on purpose


@query("SELECT 'text2' AS missing FROM (SELECT count(*) FROM conversations)")
def q_audit_p1_columns(spark, d):
    return audit.required_columns(v.table(spark, d, "conversations"), ["conv_id", "text", "text2"])


@query("SELECT count(*) AS rows, CAST(7 AS BIGINT) AS expected FROM events")
def q_audit_p2_rows(spark, d):
    return audit.row_count(v.table(spark, d, "events"), 7)


@query(f"WITH {v.V2} SELECT source_row, created_at, '488' AS \"sceneId\" FROM v2 WHERE data_date <> DATE '2024-01-05'")
def q_audit_p3_date(spark, d):
    return audit.one_date_and_scene(v.v2_turns(spark, d), "2024-01-05", "488")


@query(f"WITH {v.V2} SELECT count(*) AS rows, min(created_at) AS first, max(created_at) AS last FROM v2")
def q_audit_p3_span(spark, d):
    return audit.date_span(v.v2_turns(spark, d))


@query("""WITH x AS (SELECT event_id // 2 AS id, event_id * 2 AS source_row, CASE WHEN event_id % 50 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS client_id, CAST(event_id % 97 AS VARCHAR) AS cid FROM events)
 SELECT 'id repeated' AS rule, CAST(id AS VARCHAR) AS key FROM x GROUP BY id HAVING count(*) > 1 UNION ALL SELECT 'rows have gaps', CAST(count(*) AS VARCHAR) FROM x UNION ALL SELECT 'no user', CAST(source_row AS VARCHAR) FROM x WHERE client_id = ''
 UNION ALL SELECT 'several users', cid FROM x GROUP BY cid HAVING min(client_id) <> max(client_id) UNION ALL SELECT 'long session', cid FROM x GROUP BY cid HAVING count(*) > 103""")
def q_audit_p4_identity(spark, d):
    e = v.table(spark, d, "events")
    rows = e.select(F.floor(F.col("event_id") / 2).alias("id"), (F.col("event_id") * 2).alias("source_row"), F.when(F.col("event_id") % 50 == 0, "").otherwise(F.col("user_id").cast("string")).alias("client_id"), (F.col("event_id") % 97).cast("string").alias("cid"))
    return audit.identity(rows, 1, 103)


RATIO_SQL = "r AS (SELECT o_orderkey AS path, o_orderkey % 7 AS n, o_orderkey % 5 AS d, CASE WHEN o_orderkey % 5 > 0 THEN (o_orderkey % 7) / (o_orderkey % 5) WHEN o_orderkey % 11 = 0 THEN 1.0 END + CASE WHEN o_orderkey % 13 = 0 THEN 0.001 ELSE 0 END AS rate FROM orders)"


def _ratio_rows(spark, d):
    k = F.col("o_orderkey")
    rate = F.when(k % 5 > 0, (k % 7) / (k % 5)).when(k % 11 == 0, F.lit(1.0)) + F.when(k % 13 == 0, 0.001).otherwise(0.0)
    return v.table(spark, d, "orders").select(k.alias("path"), (k % 7).alias("n"), (k % 5).alias("d"), rate.alias("rate"), (k % 2 == 0).alias("counts_events"))


@query(f"WITH {RATIO_SQL} SELECT path FROM r WHERE n > d OR (d = 0) <> (rate IS NULL) OR coalesce(abs(rate - n / nullif(d, 0)) >= 1e-12, false)")
def q_audit_p5_ratios(spark, d):
    return audit.ratios(_ratio_rows(spark, d)).select("path")


@query(f"WITH {RATIO_SQL}, e AS (SELECT path, CASE WHEN path % 2 = 0 THEN least(n, d) ELSE n END AS n, d, CASE WHEN path % 2 = 0 AND rate > 1 THEN 1.0 ELSE rate END AS rate FROM r) SELECT path FROM e WHERE n > d OR (d = 0) <> (rate IS NULL) OR coalesce(abs(rate - n / nullif(d, 0)) >= 1e-12, false)")
def q_audit_p6_risk(spark, d):
    return audit.risk_rates(_ratio_rows(spark, d)).select("path")


@query(f"WITH {v.V2}, s AS (SELECT data_date, cid, count(*) AS n FROM v2 GROUP BY ALL), a AS (SELECT data_date, {STRUCTURE} FROM s GROUP BY data_date) SELECT data_date FROM a WHERE day(data_date) % 3 = 0")
def q_audit_p7_structure(spark, d):
    rows = sessions.session_structure(v.v2_turns(spark, d), "data_date")
    return audit.structure(rows.withColumn("multi_turns", F.col("multi_turns") + F.when(F.dayofmonth("data_date") % 3 == 0, 1).otherwise(0))).select("data_date")


@query(f"WITH {v.P3}, a AS (SELECT gender, count(*) AS n FROM up GROUP BY gender) SELECT gender FROM a WHERE gender IN ('BUILDING', 'MACHINERY')")
def q_audit_p8_profile_sums(spark, d):
    p = v.v3_profiles(spark, d)
    whole = p.groupBy("gender").agg((F.count(F.lit(1)) + F.when(F.col("gender").isin("BUILDING", "MACHINERY"), 1).otherwise(0)).alias("users"))
    return audit.partition_sums(p, ["gender"], F.lit(1), whole, "users").select("gender")


@query("WITH a AS (SELECT DISTINCT o_orderpriority AS pol FROM orders) SELECT pol FROM a WHERE pol < '3'")
def q_audit_p9_shares(spark, d):
    rows = review.intent_shares(v.table(spark, d, "orders").select(F.col("o_orderpriority").alias("pol")), "pol")
    return audit.shares(rows.withColumn("share", F.col("share") + F.when(F.col("pol") < "3", 0.01).otherwise(0.0)), [], "pol", "rows", "share").select("pol")


@query("SELECT DISTINCT CASE WHEN l_discount = 0 THEN 'mixed' END AS pol FROM lineitem WHERE l_discount = 0")
def q_audit_p10_difference(spark, d):
    s = _sessions3(spark, d)
    rows = review.share_comparison(s, s.filter("n = 1"), "pol")
    return audit.share_difference(rows.withColumn("difference", F.when(F.col("pol") == "mixed", 2.0).otherwise(F.col("difference")))).select("pol")


@query(f"WITH {v.V2F} SELECT 'sums' AS rule FROM (SELECT count(*) FROM f)")
def q_audit_p11_openings(spark, d):
    first = v.v2_first(spark, d)
    groups = sessions.opening_groups(first, domain(spark, "category", ("startPrompt", "legacyDefault", "other")))
    day = sessions.session_structure(v.v2_turns(spark, d)).select("total_sessions", (F.col("total_turns") + 1).alias("total_turns"), "multi_sessions")
    return audit.opening_groups(groups, day)


@query("SELECT n_nationkey, r_regionkey, CASE WHEN r_regionkey = n_regionkey AND n_nationkey % 4 <> 0 THEN '' ELSE 'missing' END AS problem FROM nation CROSS JOIN region WHERE NOT (r_regionkey = n_regionkey AND n_nationkey % 4 <> 0)")
def q_audit_p12_grid(spark, d):
    n, r = v.table(spark, d, "nation"), v.table(spark, d, "region")
    grid = n.select("n_nationkey").join(F.broadcast(r.select("r_regionkey")))  # both are small fixed domains
    return audit.grid_complete(n.filter("n_nationkey % 4 != 0").select("n_nationkey", F.col("n_regionkey").alias("r_regionkey")), grid, ["n_nationkey", "r_regionkey"])


@query(f"WITH {SEG} SELECT dimension_set, brand FROM so WHERE brand = '7' AND interest_users > 0")
def q_audit_p12_counts(spark, d):
    from dialoom.plans.queries import _brands

    rows = interest.segment_overall(_pairs(spark, d), v.v3_profiles(spark, d), v.DIMS, v.SETS, _brands(spark, d), "brand")
    return audit.segment_counts(rows.withColumn("coverage", F.when(F.col("brand") == "7", F.col("coverage") * 2).otherwise(F.col("coverage")))).select("dimension_set", "brand")


@query()
def q_audit_p13_privacy(spark, d):
    return audit.aggregate_only(v.table(spark, d, "documents").select("doc_id", "text", "lang", F.sha2("text", 256).alias("textSha256")))


@query("SELECT 'user_key' AS \"column\", 'pseudonym' AS problem, count(*) FILTER (user_id % 10 = 0) AS rows FROM events")
def q_audit_p14_turn_privacy(spark, d):
    rows = v.table(spark, d, "events").select(F.when(F.col("user_id") % 10 == 0, F.lit("plain")).otherwise(text.day_key("user", F.col("user_id").cast("string"), F.lit("s"))).alias("user_key"), "event_type")
    return audit.turn_table_privacy(rows, ["user_key"], ["event_type"])


@query(f"WITH {v.V3} SELECT entity_id, 'queries' AS columns FROM m GROUP BY entity_id HAVING count(DISTINCT query) % 5 = 0")
def q_audit_p15_recompute(spark, d):
    m = v.v3_mentions(spark, d)
    stored = interest.entity_metrics(m).select("entity_id", F.when(F.col("queries") % 5 == 0, F.col("queries") + 1).otherwise(F.col("queries")).alias("queries"), "mention_users")
    again = m.groupBy("entity_id").agg(F.count_distinct("query").alias("queries"), F.count_distinct("client_id").alias("mention_users"))
    return audit.compared(stored, again, ["entity_id"])


@query(f"WITH {v.V1} SELECT source_row, 'text' AS columns FROM v1 WHERE source_row % 7 = 0")
def q_audit_p16_private(spark, d):
    t = v.v1_turns(spark, d).select("source_row", "cid", "text")
    return audit.compared(t, t.withColumn("text", F.when(F.col("source_row") % 7 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))), ["source_row"])


@query("SELECT event_id AS source_row FROM events WHERE event_id % 9 = 0 OR event_id % 4 = 1")
def q_audit_p17_evidence(spark, d):
    e = v.table(spark, d, "events").select(F.col("event_id").alias("source_row"), F.array("event_type").alias("ids"), F.when(F.col("event_id") % 9 == 0, F.array("event_type", "event_type")).otherwise(F.array("event_type")).alias("signals"))
    return audit.evidence(e, "ids", ["signals"], F.col("source_row") % 4 != 1)


@query("SELECT 'alias repeated' AS rule, p_name AS key FROM (SELECT DISTINCT p_name, count(*) OVER (PARTITION BY p_name) AS n FROM part) WHERE n > 1 UNION ALL SELECT 'unknown parent', CAST(p_partkey AS VARCHAR) FROM part WHERE p_partkey % 100 = 7")
def q_audit_p18_dictionary(spark, d):
    p = v.table(spark, d, "part")
    entities = v.v3_entities(spark, d).withColumn("parent_id", F.when(F.col("entity_id").cast("string").rlike("^[0-9]+$") & (F.expr("try_cast(entity_id as int)") % 100 == 7), F.lit("nobody")).otherwise(F.col("parent_id")))
    aliases = p.select(F.col("p_partkey").cast("string").alias("entity_id"), F.lit("substring").alias("mode"), F.col("p_name").alias("normalized"), F.col("p_name").alias("value"), F.lit("auto").alias("policy"), F.array().cast("array<string>").alias("terms"))
    return audit.dictionary(entities, aliases)


@query(f"WITH {HITS}, x AS (SELECT * FROM h WHERE data_date = DATE '1997-03-01') SELECT 'polarity' AS rule, rollup_id AS key FROM x WHERE polarities LIKE '%mixed%'")
def q_audit_p19_contributions(spark, d):
    hits = _hits(spark, d).filter("data_date = date '1997-03-01'").withColumn("client_id", F.sha2("client_id", 256))
    users = hits.select("client_id").distinct()
    return audit.contributions(users, hits, v.v3_members(spark, d).select("rollup_id").distinct(), ["positive", "negative", "neutral"])


@query(f"WITH {CAND} SELECT 'too many' AS rule, CAST(count(*) AS VARCHAR) AS key FROM ca UNION ALL SELECT 'eligibility', norm FROM ca WHERE users >= 5 AND sessions >= 8 AND norm LIKE 'view%'")
def q_audit_p20_candidates(spark, d):
    rows = candidates.aggregate_candidates(_found(spark, d)).withColumn("growth", F.lit(None).cast("double"))
    good = (F.col("users") >= 5) & (F.col("sessions") >= 8)
    return audit.candidate_table(rows.withColumn("eligible", good & ~F.col("norm").startswith("view")))


@query("SELECT 'none' AS event_type, 'missing' AS problem FROM (SELECT count(*) FROM events)")
def q_audit_p23_domain(spark, d):
    rows = v.table(spark, d, "events").select("event_type").distinct()
    return audit.grid_complete(rows, domain(spark, "event_type", ("view", "click", "error", "purchase", "signup", "none")), ["event_type"])


@query(f"WITH {V2A} SELECT 'daily sum' AS rule, CAST(data_date AS VARCHAR) AS key FROM a WHERE day(data_date) = 4 GROUP BY data_date")
def q_audit_p24_research(spark, d):
    active = _active(spark, d)
    daily = sessions.daily_active(active).withColumn("returning_users", F.col("returning_users") + F.when(F.dayofmonth("data_date") == 4, 1).otherwise(0))
    return audit.research_report(daily, sessions.retention(active, active.select("data_date")))


@query("SELECT doc_id FROM documents JOIN labels USING (doc_id) WHERE lang = 'es' OR source = 'src3'")
def q_audit_p25_labels(spark, d):
    rows = _reviewed(spark, d).withColumns({"one": F.col("source"), "two": F.lit("src3")})
    return audit.labels(rows, {"lang": ["en", "de", "fr"]}, ("one", "two")).select("doc_id")


@query(f"WITH {v.V3}, b AS (SELECT entity_id, count(DISTINCT client_id) FILTER (signal <> 'passive') AS active_users, count(DISTINCT client_id) AS u, count(DISTINCT query) AS q FROM m GROUP BY entity_id), r AS (SELECT entity_id, row_number() OVER (ORDER BY active_users DESC, u DESC, q DESC, entity_id) AS k FROM b) SELECT entity_id FROM r WHERE k % 10 = 0")
def q_audit_p26_ranks(spark, d):
    rows = interest.ranked(interest.entity_metrics(v.v3_mentions(spark, d)), "entity_id").withColumn("list", F.lit("ip"))
    rows = rows.withColumn("rank", F.when(F.col("rank") % 10 == 0, -F.col("rank")).otherwise(F.col("rank")))
    return audit.ranks(rows, ["list"], "rank", [F.desc("active_users"), F.desc("mention_users"), F.desc("queries"), F.col("entity_id")]).select("entity_id")


@query("SELECT CAST(user_id AS VARCHAR) || '-' || CAST(CAST(min(ts) AS DATE) AS VARCHAR) AS cid, '' AS columns FROM events WHERE false GROUP BY user_id")
def q_audit_p27_openings(spark, d):
    from pyspark.sql import Window

    t = v.v2_turns(spark, d)
    order = Window.partitionBy("cid").orderBy("created_at", "source_row")
    other = t.withColumn("r", F.row_number().over(order)).filter("r = 1").select("cid", "text", "source_row")
    return audit.compared(v.v2_first(spark, d).select("cid", "text", "source_row"), other, ["cid"])


@query("SELECT o_orderkey AS source_row, CASE WHEN o_orderkey % 3 = 0 THEN 'right' ELSE 'left' END AS missing_side FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 5 = 0")
def q_pair_turns(spark, d):
    """One-to-one merge of two turn tables; rows that only one side has."""
    o = v.table(spark, d, "orders").select(F.col("o_orderkey").alias("source_row"))
    return audit.paired(o.filter("source_row % 5 != 0 or source_row % 3 = 0"), o.filter("source_row % 3 != 0"), "source_row")[1]


# --- incremental


def _digests(spark, d):
    return periods.table_digest(v.v2_turns(spark, d).select("product", "data_date", "source_row", "event_type"), "product", "data_date")


@query(f"WITH {v.V2} SELECT DISTINCT data_date FROM v2 WHERE day(data_date) = 3 OR day(data_date) > 20")
def q_incremental_t7_changed_days(spark, d):
    now = _digests(spark, d)
    done = now.filter(F.dayofmonth("data_date") <= 20).withColumn("rows", F.col("rows") + F.when(F.dayofmonth("data_date") == 3, 1).otherwise(0))
    return sinks.changed_days(now, done).select("data_date")


@query(f"WITH {v.V2} SELECT data_date, count(*) AS turns FROM v2 WHERE data_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-15' GROUP BY data_date")
def q_incremental_t8_backfill(spark, d):
    return sinks.backfill(v.v2_turns(spark, d), "2024-01-15").groupBy("data_date").agg(F.count(F.lit(1)).alias("turns"))


@query(f"WITH {v.V2}, dl AS (SELECT CAST(k AS VARCHAR) AS phrase, data_date FROM v2 WHERE day(data_date) <> 9 GROUP BY k, data_date), od AS (SELECT DISTINCT data_date FROM dl) SELECT phrase, data_date FROM dl WHERE phrase LIKE '%7' AND (SELECT count(*) FROM od WHERE od.data_date BETWEEN dl.data_date - 7 AND dl.data_date - 1) > 0")
def q_incremental_t9_repair(spark, d):
    daily = _daily(spark, d)
    right = periods.with_baseline(daily, daily, "phrase", "users")
    stored = right.withColumn("baseline", F.when(F.col("phrase").endswith("7"), F.col("baseline") + 1).otherwise(F.col("baseline")))
    return periods.changed(stored, right, ["phrase", "data_date"]).select("phrase", "data_date")


@query(f"WITH {v.V2} SELECT DISTINCT data_date FROM v2 WHERE day(data_date) % 4 = 0")
def q_incremental_t10_refresh(spark, d):
    series = sessions.metric_series(v.v2_turns(spark, d)).select("data_date", "total_turns", "users")
    old = series.withColumn("users", F.when(F.dayofmonth("data_date") % 4 == 0, F.col("users") - 1).otherwise(F.col("users")))
    return periods.changed(old, series, ["data_date"]).select("data_date")


@query(f"WITH {DAYS} SELECT data_date, CASE WHEN day(data_date) % 2 = 0 THEN 'kept' END AS review FROM dy")
def q_incremental_t13_reviews(spark, d):
    days = _days(spark, d)
    reviews = days.select("product", "data_date", F.when(F.dayofmonth("data_date") % 2 == 0, F.col("digest")).otherwise(-1).alias("digest"), F.lit("kept").alias("review"))
    return sinks.carry_reviews(days.select("product", "data_date"), reviews, days).select("data_date", "review")


@query(f"WITH {SEG} SELECT age, gender, users FROM sg WHERE dimension_set = 'age+gender' AND gender IN ('BUILDING', 'MACHINERY')")
def q_segment_query(spark, d):
    """T5: one to four groups of a set."""
    groups = interest.segment_groups(v.v3_profiles(spark, d), v.DIMS, v.SETS)
    return groups.filter((F.col("dimension_set") == "age+gender") & F.col("gender").isin("BUILDING", "MACHINERY")).select("age", "gender", "users")


@query(f"WITH {LATEST} SELECT client_id, gender, region, eligible FROM lt")
def q_latest_profiles(spark, d):
    return periods.latest_profiles(_user_days(spark, d), "gender", "region")



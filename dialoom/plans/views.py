"""Dialogue views over the shared test tables, and the same views as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dialoom.functions import rules
from dialoom.functions.text import normalize_opening


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def v1_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of ``conversations``: a user or system row with the assistant row after it; the user key falls back to the session."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = table(spark, sf_dir, "conversations").withColumns({"next_role": F.lead("role").over(w), "next_text": F.lead("text").over(w)}).filter("role != 'assistant'")
    return rows.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("source_row"), F.col("conv_id").cast("string").alias("cid"), F.concat(F.lit("session:"), F.col("conv_id").cast("string")).alias("client_id"), F.col("text"),
        F.when(F.col("next_role") == "assistant", F.col("next_text")).otherwise("").alias("ai_text"), F.col("turn").alias("turn_index"), F.when(F.col("role") == "system", "是").otherwise("否").alias("is_template"), F.lit("否").alias("is_invalid_turn"),
    )


V1 = """
c AS (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
v1 AS (SELECT conv_id * 1000 + turn AS source_row, CAST(conv_id AS VARCHAR) AS cid, 'session:' || CAST(conv_id AS VARCHAR) AS client_id, text, CASE WHEN next_role = 'assistant' THEN next_text ELSE '' END AS ai_text,
  turn AS turn_index, CASE WHEN role = 'system' THEN '是' ELSE '否' END AS is_template, '否' AS is_invalid_turn FROM c WHERE role <> 'assistant')"""


def v2_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of ``events``: a session is a user's day; 'signup' stands for the placeholder opening, 'error' for an empty utterance."""
    e = table(spark, sf_dir, "events")
    day = F.to_date("ts")
    text = F.when(F.col("event_type") == "signup", rules.PLACEHOLDER).when(F.col("event_type") == "error", "").otherwise(F.col("event_type"))
    keys = F.array(*[F.lit(a[0]) for a in rules.DIRECTIONS.values()])
    k = F.get_json_object("props", "$.k").cast("int")
    prompt = F.when(k % 13 == 0, F.lit("")).when(k % 13 == 1, F.lit("x==y")).when(k % 13 == 2, F.lit("运营任务+z==y")).otherwise(F.concat(F.get(keys, F.pmod(k, F.lit(10))), F.lit("==y")))
    return e.select(
        (F.col("event_id") + 1).alias("source_row"), F.col("event_id").cast("string").alias("id"), F.col("user_id").cast("string").alias("client_id"), F.concat_ws("-", F.col("user_id").cast("string"), day.cast("string")).alias("cid"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("created_at"), day.alias("data_date"), F.col("event_type"), text.alias("text"), F.to_json(F.struct(F.struct(prompt.alias("opening_prompt")).alias("extra"))).alias("response"),
        F.col("value"), F.col("ts"), F.lit("488").alias("sceneId"), F.lit("M1").alias("product"), k.alias("k"),
    )


V2 = """
v2 AS (SELECT event_id + 1 AS source_row, CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS client_id, CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS cid, strftime(ts, '%Y-%m-%d %H:%M:%S') AS created_at,
  CAST(ts AS DATE) AS data_date, event_type, CASE event_type WHEN 'signup' THEN '##{startPrompt}##' WHEN 'error' THEN '' ELSE event_type END AS text, ts, value, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)"""


def v2_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    from dialoom.operators.sessions import first_turns

    t = v2_turns(spark, sf_dir)
    t = t.withColumn("norm", normalize_opening(F.col("text")))
    t = t.withColumns({"category": rules.opening_category(F.col("text"), F.col("norm")), "is_reply": rules.is_reply(F.col("text"), F.col("norm")), "timestamp": F.lit("x")})
    return first_turns(t)


V2F = V2 + """,
o AS (SELECT *, CASE WHEN text = '##{startPrompt}##' THEN 'startPrompt' ELSE 'other' END AS category, row_number() OVER (PARTITION BY cid ORDER BY created_at, source_row) AS r FROM v2),
f AS (SELECT cid, count(*) AS n, sum(CASE WHEN r > 1 AND text <> '' AND category = 'other' THEN 1 ELSE 0 END) AS later_replies, max(CASE WHEN r = 1 THEN category END) AS category, max(CASE WHEN r = 1 THEN text END) AS text,
  max(CASE WHEN r = 1 THEN k END) AS k, max(CASE WHEN r = 1 THEN source_row END) AS source_row FROM o GROUP BY cid)"""
DIRECTED = """,
g AS (SELECT *, CASE WHEN k % 13 = 0 THEN NULL WHEN k % 13 = 1 THEN 'unsupported' WHEN k % 13 = 2 THEN 'operation'
  ELSE ['knowledge','operation','preference','unfinished_topic','birthday','anniversary','holiday','night','fallback','general_interest'][k % 10 + 1] END AS found FROM f WHERE category = 'startPrompt')"""


def v3_mentions(spark: SparkSession, sf_dir: str, day: str = "o_orderdate") -> DataFrame:
    """Mentions of orders: user = customer, session = order, query = order line, entity = part; ``day`` is the column that dates them."""
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    signal = F.when(F.col("l_returnflag") == "A", "initiation").when(F.col("l_returnflag") == "N", "continuation").otherwise("passive")
    polarity = F.when(F.col("l_discount") == 0, "mixed").when((F.col("l_linestatus") == "O") & (F.col("l_discount") > 0.055), "positive").when((F.col("l_linestatus") == "F") & (F.col("l_discount") > 0.075), "negative").otherwise("neutral")
    joined = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(F.col("l_partkey").cast("string").alias("entity_id"), F.col("o_custkey").cast("string").alias("client_id"), F.col("o_orderkey").cast("string").alias("cid"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("query"),
                         signal.alias("signal"), polarity.alias("polarity"), F.to_date(day).alias("data_date"))


V3 = """
m AS (SELECT CAST(l_partkey AS VARCHAR) AS entity_id, CAST(o_custkey AS VARCHAR) AS client_id, CAST(o_orderkey AS VARCHAR) AS cid, l_orderkey * 10 + l_linenumber AS query,
  CASE l_returnflag WHEN 'A' THEN 'initiation' WHEN 'N' THEN 'continuation' ELSE 'passive' END AS signal,
  CASE WHEN l_discount = 0 THEN 'mixed' WHEN l_linestatus = 'O' AND l_discount > 0.055 THEN 'positive' WHEN l_linestatus = 'F' AND l_discount > 0.075 THEN 'negative' ELSE 'neutral' END AS polarity,
  CAST(o_orderdate AS DATE) AS data_date FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def v3_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts under brands; every 17th part is restricted."""
    p = table(spark, sf_dir, "part")
    parts = p.select(F.col("p_partkey").cast("string").alias("entity_id"), F.concat_ws(" ", F.col("p_name"), F.col("p_partkey").cast("string")).alias("name"), F.col("p_type").alias("type"), (F.col("p_size") % 5).cast("string").alias("subtype"), F.when(F.col("p_partkey") % 10 != 0, F.col("p_brand")).alias("parent_id"),
                     F.when(F.col("p_partkey") % 17 == 0, "restricted").otherwise("public").alias("visibility"))
    brands = p.select(F.col("p_brand").alias("entity_id"), F.col("p_brand").alias("name"), F.lit("BRAND").alias("type"), F.lit("0").alias("subtype"), F.lit(None).cast("string").alias("parent_id"), F.lit("public").alias("visibility")).distinct()
    return parts.unionByName(brands)


E3 = """
e AS (SELECT CAST(p_partkey AS VARCHAR) AS entity_id, p_name || ' ' || CAST(p_partkey AS VARCHAR) AS name, p_type AS type, CAST(p_size % 5 AS VARCHAR) AS subtype, CASE WHEN p_partkey % 10 <> 0 THEN p_brand END AS parent_id,
  CASE WHEN p_partkey % 17 = 0 THEN 'restricted' ELSE 'public' END AS visibility FROM part UNION ALL SELECT DISTINCT p_brand, p_brand, 'BRAND', '0', NULL, 'public' FROM part)"""
ROLLUP = """,
par AS (SELECT DISTINCT parent_id AS rollup_id FROM e WHERE parent_id IS NOT NULL AND visibility = 'public'),
mem AS (SELECT rollup_id, e.entity_id FROM par JOIN e ON e.parent_id = rollup_id AND e.visibility = 'public' WHERE e.entity_id IN (SELECT entity_id FROM m)
  UNION ALL SELECT entity_id, entity_id FROM e WHERE parent_id IS NULL AND visibility = 'public' AND type IN ('PROMO', 'SMALL', 'LARGE') AND entity_id NOT IN (SELECT rollup_id FROM par) AND entity_id IN (SELECT entity_id FROM m))"""
STANDALONE = ["PROMO", "SMALL", "LARGE"]
DIMS = ["age", "gender", "region"]
SETS = [["age"], ["gender"], ["region"], ["age", "gender"], ["age", "region"], ["gender", "region"], ["age", "gender", "region"]]


def v3_profile_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a user's rows with profile columns; a seventh of the nations has no region, order priority is the dimension that varies."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    places = n.join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey"))  # nations are a fixed table of 25 rows
    rows = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey"))
    mapped = F.col("c_nationkey") % 7 != 0
    return rows.select(F.col("o_custkey").cast("string").alias("client_id"), (F.floor(F.col("c_acctbal") / 2500).cast("long")).alias("age"), F.col("c_mktsegment").alias("gender"), F.when(mapped, F.col("r_name")).alias("region"), (~mapped).alias("unmapped"),
                       F.col("o_orderpriority").alias("priority"), (F.col("o_orderstatus") == "F").alias("is_content"), F.to_date("o_orderdate").alias("data_date"))


P3 = """
pr AS (SELECT CAST(o_custkey AS VARCHAR) AS client_id, CAST(floor(c_acctbal / 2500) AS BIGINT) AS age, c_mktsegment AS gender, CASE WHEN c_nationkey % 7 <> 0 THEN r_name END AS region, c_nationkey % 7 = 0 AS unmapped,
  o_orderpriority AS priority, o_orderstatus = 'F' AS is_content, CAST(o_orderdate AS DATE) AS data_date FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
up AS (SELECT client_id, CASE WHEN min(age) = max(age) AND count(age) = count(*) THEN min(age) END AS age, CASE WHEN min(gender) = max(gender) AND count(gender) = count(*) THEN min(gender) END AS gender,
  CASE WHEN min(region) = max(region) AND count(region) = count(*) THEN min(region) END AS region, CASE WHEN min(priority) = max(priority) AND count(priority) = count(*) THEN min(priority) END AS priority,
  bool_or(is_content) AS eligible, bool_or(unmapped) AS unmapped FROM pr GROUP BY client_id)"""


def v3_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    from dialoom.operators.interest import stable_profile

    return stable_profile(v3_profile_rows(spark, sf_dir), [*DIMS, "priority"], F.col("is_content"), F.col("unmapped"))


def v3_members(spark: SparkSession, sf_dir: str, matched: bool = True) -> DataFrame:
    from dialoom.operators.matching import rollup_members

    return rollup_members(v3_entities(spark, sf_dir), v3_mentions(spark, sf_dir) if matched else None, STANDALONE)

"""The session fold as a stream, and clauses cut in the matcher."""

import random

from pyspark.sql import functions as F

from dialoom.functions import rules
from dialoom.operators import classify, matching

NAMES = ["fox", "owl", "elk"]
ALIASES = [matching.Alias(n, n, n) for n in NAMES]
SCHEMA = "client_id string, cid string, source_row long, text string, ai_text string, is_invalid_turn string, is_template string"


def brute(turns):
    """One loop over each session's turns in order."""
    state, out = {}, {}
    for client, cid, row, said, heard, invalid, template in sorted(turns, key=lambda t: t[2]):
        users, ai, ai_text = state.get((client, cid), ([], [], ""))
        usable = invalid == "否" and template != "是"
        named = [n for n in NAMES if usable and n in (said or "")]
        context = set(users) | set(ai)
        inherits = usable and said in ("继续", "然后呢") and len(context) == 1
        out[row] = sorted(context) if inherits else sorted(named), inherits, {n: n in users or n in ai or n in ai_text for n in named}
        state[client, cid] = sorted(context) if inherits else named, [n for n in NAMES if n in (heard or "")], heard or ""
    return out


def said_by(rng, n, sessions):
    words = ["继续", "然后呢", "the fox", "owl and elk", "嗯", None, "讲故事给我听"]
    return [(f"u{k % sessions % 3}", f"s{k % sessions}", k, rng.choice(words), rng.choice(["", "fox", "owl", None, "elk fox"]), rng.choice("否否否是"), rng.choice("否否否是")) for k in range(n)]


def check(spark, turns):
    out = classify.classify_turns(spark.createDataFrame(turns, SCHEMA).repartition(3), ALIASES).collect()
    want = brute(turns)
    assert len(out) == len(turns)
    for r in out:
        ids, inherits, before = want[r.source_row]
        assert sorted(e.entity_id for e in r.entities) == ids and r.inherited == inherits, r
        assert all((e.signal != rules.SIGNALS[1]) == before[e.entity_id] for e in r.entities if not inherits), r
        assert {e.basis for e in r.entities} <= ({"single_context"} if inherits else {"explicit_alias"})
    return sum(r.inherited for r in out)


def test_fold_equals_a_loop(spark):
    assert check(spark, said_by(random.Random(1), 900, 40)) > 20


def test_one_session_with_most_turns(spark):
    rng = random.Random(2)
    turns = [("u", "s", *t[2:]) for t in said_by(rng, 30_000, 1)] + [(None, None, 40_000 + k, *t[3:]) for k, t in enumerate(said_by(rng, 50, 1))]
    assert check(spark, turns) > 1000


def test_fold_plan_collects_no_session(spark):
    df = spark.createDataFrame(said_by(random.Random(3), 10, 2), SCHEMA)
    plan = classify.classify_turns(df, ALIASES)._jdf.queryExecution().toString()
    physical = plan[plan.index("Physical Plan") :]
    assert "collect_list" not in plan and physical.count("ArrowEvalPython") == 1 and physical.count("MapInArrow") == 1 and "Join" not in physical
    assert classify.classify_turns(df.limit(0), ALIASES).collect() == []


def test_clauses(spark):
    cases = [("喜欢fox，讨厌owl", {"fox": "喜欢fox", "owl": "讨厌owl"}), ("喜欢fox讨厌owl", {"fox": "喜欢fox", "owl": "讨厌owl"}), ("fox owl", {"fox": "fox", "owl": "owl"}), ("FOX!?elk elk", {"fox": "fox", "elk": "elkelk"}), ("然后fox但是fox", {"fox": "foxfox"})]
    df = spark.createDataFrame(cases, "text string, want map<string,string>").withColumn("r", matching.reading_of(F.col("text"), ALIASES))
    for r in df.collect():
        assert {h.entity_id: c for h, c in zip(r.r.hits, r.r.clauses, strict=True)} == r.want

"""Sessions, retention, history, audits, readers and sinks on small tables."""

import datetime as dt
import hashlib
import hmac
import json

import pytest
from pyspark.sql import functions as F

from dialoom.functions import text
from dialoom.operators import audit, interest, periods, review, sessions
from dialoom.sources import readers, sinks

D = dt.date


def test_session_lengths(spark):
    rows = [(f"s{i}",) for i, n in enumerate((1, 1, 3, 5)) for _ in range(n)]
    r = sessions.session_structure(spark.createDataFrame(rows, "cid string")).first()
    assert (r["total_turns"], r["total_sessions"], r["multi_rate"], r["multi_average_turns"]) == (10, 4, 0.5, 4.0)
    assert audit.structure(sessions.session_structure(spark.createDataFrame(rows, "cid string"))).isEmpty()
    empty = sessions.session_structure(spark.createDataFrame([], "cid string")).first()
    assert (empty["total_turns"], empty["average_turns"]) == (0, None)


def test_retention_needs_covered_days(spark):
    active = spark.createDataFrame([("a", D(2026, 8, 1)), ("b", D(2026, 8, 1)), ("a", D(2026, 8, 2)), ("a", D(2026, 8, 8))], "user string, data_date date")
    row = sessions.retention(active, active.select("data_date").distinct()).filter("first_date = date '2026-08-01'").first()
    assert (row["d1_rate"], row["d7_rate"], row["d7_observed_rate"]) == (0.5, None, 0.5)
    every = spark.createDataFrame([(D(2026, 8, k),) for k in range(1, 9)], "data_date date")
    assert sessions.retention(active, every).filter("first_date = date '2026-08-01'").first()["d7_rate"] == 0.5
    assert sessions.daily_active(active).filter("data_date = date '2026-08-02'").first()["returning_users"] == 1


def test_history_baseline(spark):
    days = spark.createDataFrame([(D(2026, 8, k),) for k in range(1, 8)], "data_date date")
    daily = spark.createDataFrame([("x", D(2026, 8, 1), 7), ("x", D(2026, 8, 8), 7)], "id string, data_date date, users long")
    row = periods.with_baseline(daily, days, "id", "users").filter("data_date = date '2026-08-08'").first()
    assert (row["baseline"], row["change"], row["growth"]) == (1.0, 6.0, 7.0)
    assert periods.with_baseline(daily, days, "id", "users", every_day=True).filter("data_date = date '2026-08-08'").first()["baseline"] is None


def test_segments(spark):
    rows = [(f"u{i}", "3", "m", i < 30, False) for i in range(30)] + [(f"v{i}", "10", "f", False, i == 0) for i in range(30)] + [("w", None, "m", True, False)]
    profiles = spark.createDataFrame(rows, "client_id string, age string, gender string, eligible boolean, unmapped boolean")
    pairs = spark.createDataFrame([("u0", "e"), ("u1", "e"), ("w", "e"), ("v1", "e")], "client_id string, entity_id string")
    sets = [["age"], ["gender"], ["age", "gender"]]
    overall = {r["dimension_set"]: r for r in interest.segment_overall(pairs, profiles, ["age", "gender"], sets, spark.createDataFrame([("e",)], "entity_id string")).collect()}
    assert (overall["gender"]["interest_users"], overall["gender"]["eligible_users"]) == (3, 31) and abs(overall["gender"]["coverage"] - 3 / 31) < 1e-12
    assert (overall["age"]["interest_users"], overall["age"]["eligible_users"]) == (2, 30)
    groups = {(r["dimension_set"], r["age"], r["gender"]): r for r in interest.segment_groups(profiles, ["age", "gender"], sets).collect()}
    assert (groups["age+gender", "10", "f"]["users"], groups["age+gender", "10", "f"]["eligible_users"]) == (30, 0)
    assert interest.mapping_diagnostics(profiles, "age").first()["unmapped_users"] == 1


def test_profiles_must_agree_on_all_rows(spark):
    rows = spark.createDataFrame([("a", 5, True), ("a", 5, False), ("b", 5, False), ("b", 6, False), ("c", None, True), ("c", 4, True)], "client_id string, age int, content boolean")
    got = {r["client_id"]: (r["age"], r["eligible"]) for r in interest.stable_profile(rows, ["age"], F.col("content")).collect()}
    assert got == {"a": (5, True), "b": (None, False), "c": (None, True)}


def test_period_union(spark):
    hits = spark.createDataFrame([(D(2026, 8, 1), "u", "r", "s", 1, True, False, ["neutral"]), (D(2026, 8, 2), "u", "r", "s", 2, False, True, ["positive"])], "data_date date, client_id string, rollup_id string, cid string, queries long, initiated boolean, continued boolean, polarities array<string>")
    r = periods.period_metrics(hits).first()
    assert (r["active_users"], r["queries"], r["sessions"], r["deep_sessions"], r["positive_users"]) == (1, 3, 1, 1, 1)
    assert periods.in_period(hits, "day", "2026-08-02").count() == 1 and periods.in_period(hits, "month", "2026-08").count() == 2


def test_scores(spark):
    rows = spark.createDataFrame([(["a", "b"], ["a"], "x", "x")], "gold array<string>, found array<string>, g string, p string")
    r = review.semantic_scores(rows, [("g", "p")], "gold", "found").first()
    assert (r["precision"], r["recall"], r["p_accuracy"]) == (1.0, 0.5, 1.0)
    df = spark.createDataFrame([(["a", "b"], ["x", "y"], ["b", "a"], ["y", "x"])], "k array<string>, v array<string>, k2 array<string>, v2 array<string>")
    assert df.select(review.same_aligned(F.col("k"), F.col("v"), F.col("k2"), F.col("v2"))).first()[0]


def test_keys(spark):
    df = spark.createDataFrame([("u1", "M2"), ("u2", "M1")], "u string, p string").select("u", "p", text.stable_key("secret", "user", F.col("u"), F.col("p")).alias("k"), text.day_key("user", F.col("u"), F.lit("src")).alias("d"))
    for r in df.collect():
        message = ("M2:" if r["p"] == "M2" else "") + f"user:{r['u']}"
        assert r["k"] == hmac.new(b"secret", message.encode(), hashlib.sha256).hexdigest()
        assert r["d"] == hashlib.sha256(f"user\0src\0{r['u']}".encode()).hexdigest()[:20]


def test_ages_and_redaction(spark):
    df = spark.createDataFrame([("6",), (" 17 ",), ("18",), ("0",), ("x",), (None,), ("3.5",)], "t string")
    assert [r[0] for r in df.select(text.age_of(F.col("t"))).collect()] == [6, 17, None, None, None, None, None]
    df = spark.createDataFrame([("call 13812345678 or a.b@c.org",)], "t string")
    assert df.select(text.redacted(F.col("t"), "*")).first()[0] == "call * or *"


def test_identity_audit(spark):
    good = spark.createDataFrame([("i1", 1, "u", "s"), ("i2", 2, "u", "s")], "id string, source_row long, client_id string, cid string")
    assert audit.identity(good).isEmpty()
    bad = spark.createDataFrame([("i1", 1, "u", "s"), ("i1", 3, "v", "s"), ("i3", 3, "", "")], "id string, source_row long, client_id string, cid string")
    assert {r["rule"] for r in audit.identity(bad).collect()} == {"id repeated", "row repeated", "no user", "no session", "several users"}


def test_privacy_audit(spark):
    df = spark.createDataFrame([("0123456789abcdef0123", "a@b.co", 1)], "key string, label string, clientId int")
    assert {(r["column"], r["problem"]) for r in audit.aggregate_only(df).collect()} == {("clientId", "forbidden name"), ("key", "identifier"), ("label", "contact")}


def test_turn_csv(spark, tmp_path):
    path = tmp_path / "t.csv"
    head = ",".join(readers.TURN_COLUMNS)
    path.write_text(f'{head}\n1,u1,s1,488,"two\nlines ""q""",,1,否,否,,6,正常,男,正常,北京,正常\n', encoding="utf-8-sig")
    row = readers.turn_csv(spark, str(path)).first()
    assert (row["source_row"], row["text"], row["ai_text"], row["client_id"]) == (1, 'two\nlines "q"', "", "u1")
    with pytest.raises(ValueError):
        readers.turn_csv(spark, str(path), columns=("nothing",))


def test_raw_and_ragged(spark, tmp_path):
    path = tmp_path / "r.tsv"
    path.write_text("cid\ttext\tcreated_at\ns1\ta\t2026-08-01\ns2\ta\tb\t2026-08-02\n")
    assert readers.header_separator(spark, str(path)) == "\t"
    got = {r["n_cells"]: (r["created_at"], r["is_ragged"]) for r in readers.ragged_lines(spark, str(path)).collect()}
    assert got == {3: ("2026-08-01", False), 4: ("2026-08-02", True)}


def test_dictionary_and_regions(spark, tmp_path):
    path = tmp_path / "d.json"
    path.write_text(json.dumps({"schemaVersion": "x/1.0.0", "entities": [{"id": "E", "canonicalName": "N", "aliases": ["A b"], "ambiguousAliases": ["C"]}, {"id": "F", "canonicalName": "M", "parentRegistryId": "E", "matchRules": [{"value": "z", "mode": "token", "policy": "context", "contextTerms": ["t"]}]}]}))
    entities, aliases = readers.dictionary(spark, str(path))
    assert {r["entity_id"]: r["parent_id"] for r in entities.collect()} == {"E": None, "F": "E"}
    assert {(r["value"], r["normalized"], r["mode"], r["policy"]) for r in aliases.collect()} == {("A b", "ab", "substring", "auto"), ("C", "c", "substring", "candidate"), ("z", "z", "token", "context")}
    path = tmp_path / "m.json"
    path.write_text(json.dumps({"regions": [{"id": "11", "name": "北京"}], "aliases": {"北京市": "11"}}))
    regions, cities = readers.region_map(spark, str(path))
    assert regions.first()["name"] == "北京" and cities.first()["region_id"] == "11"


def test_days_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    make = lambda rows: spark.createDataFrame(rows, "product string, data_date date, n long")
    sinks.replace_days(make([("M1", D(2026, 8, 1), 1), ("M1", D(2026, 8, 2), 2)]), path)
    sinks.backup_days(spark, path, make([("M1", D(2026, 8, 2), 0)]), str(tmp_path / "b"))
    sinks.replace_days(make([("M1", D(2026, 8, 2), 3)]), path)
    assert sorted(r["n"] for r in spark.read.parquet(path).collect()) == [1, 3]
    assert [r["n"] for r in spark.read.parquet(str(tmp_path / "b")).collect()] == [2]
    assert not sinks.replace_if_changed(make([("M1", D(2026, 8, 2), 3)]), path)
    assert sinks.replace_if_changed(make([("M1", D(2026, 8, 2), 4)]), path)
    assert sinks.stored(spark, str(tmp_path / "none")) is None
    assert [r["n"] for r in readers.history(spark, path, "M1", "2026-08-02", "2026-08-09").collect()] == [4]


def test_raw_export_counts_records(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text('cid,text,response\ns1,"two\nlines",x\ns2,b,y\ns3,c,z\n', encoding="utf-8-sig")
    assert {(r["source_row"], r["cid"]) for r in readers.raw_export(spark, str(path)).collect()} == {(2, "s1"), (3, "s2"), (4, "s3")}


def test_date_contract(spark, tmp_path):
    tabs, commas, none = (tmp_path / n for n in ("t.tsv", "c.csv", "n.csv"))
    tabs.write_text("cid\tsceneId\ttext\tcreated_at\ns\t488\ta\t2026-08-01 01:00\ns\t488\ta\tb\t2026-08-01 02:00\ns\t488\ta\t2026-08-02 01:00\ns\t904\ta\t2026-08-01\ns\t488\ta\tsoon\ns\n")
    got = [(r["rule"], r["value"]) for r in readers.date_contract(spark, str(tabs), "2026-08-01", "488").collect()]
    assert sorted(got) == [("cells", "1"), ("created_at", "soon"), ("date", "2026-08-02 01:00"), ("scene", "904")]
    commas.write_text('cid,sceneId,text,created_at\ns,488,"a, b",2026-08-01\ns,488,a,b,2026-08-01\n', encoding="utf-8-sig")
    assert [(r["rule"], r["value"]) for r in readers.date_contract(spark, str(commas), "2026-08-01", "488").collect()] == [("cells", "5")]
    none.write_text("sceneId,created_at\n")
    assert [r["rule"] for r in readers.date_contract(spark, str(none), "2026-08-01", "488").collect()] == ["no rows"]
    (tmp_path / "m.csv").write_text("cid\n1\n")
    with pytest.raises(ValueError):
        readers.date_contract(spark, str(tmp_path / "m.csv"), "2026-08-01", "488")


def test_turn_tables_are_written_and_read_back(spark, tmp_path):
    from dialoom.operators import classify
    from dialoom.operators.matching import Alias

    rows = [(1, "u1", "s1", "look at the comet", "yes", 1), (2, "u1", "s1", "hm", "", 2)]
    df = spark.createDataFrame(rows, "source_row long, client_id string, cid string, text string, ai_text string, turn_index int")
    df = df.withColumns({"is_template": F.lit("否"), "is_invalid_turn": F.lit("否"), "created_at": F.lit("2026-08-01"), "profile_age": F.lit("6"), "product": F.lit("M1"), "data_date": F.lit("2026-08-01").cast("date")})
    sinks.write_turns(classify.classify_turns(df, [Alias("E", "comet", "comet")]), "day", str(tmp_path / "safe"), str(tmp_path / "private"))
    safe, private = spark.read.parquet(str(tmp_path / "safe")), spark.read.parquet(str(tmp_path / "private"))
    assert set(private.columns) == {*sinks.DAY, *sinks.PRIVATE} and not {"text", "cid", "client_id"} & set(safe.columns)
    assert {(r["source_row"], r["text"], r["entity_names"]) for r in private.collect()} == {(1, "look at the comet", "E"), (2, "hm", "")}
    assert {(r["source_row"], tuple(r["entity_ids"])) for r in safe.collect()} == {(1, ("E",)), (2, ())}


def test_daily_documents_are_audited_and_loaded(spark, tmp_path):
    day = {"product": "M1", "data_date": "2026-08-01", "total_turns": 10, "total_sessions": 4, "users": 3, "single_sessions": 2, "multi_sessions": 2, "multi_turns": 8, "five_plus_sessions": 1, "average_turns": 2.5, "extra": "x"}
    (tmp_path / "a.json").write_text(json.dumps({**day, "users": 1}))
    (tmp_path / "b.json").write_text(json.dumps(day))
    docs = readers.daily_documents(spark, str(tmp_path))
    assert [(r["users"], r["average_turns"]) for r in docs.collect()] == [(3, 2.5)] and "extra" not in docs.columns
    sinks.load_documents(spark, docs, str(tmp_path / "out"), [audit.structure(docs)])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
    with pytest.raises(ValueError):
        sinks.load_documents(spark, docs, str(tmp_path / "out"), [audit.structure(docs.withColumn("multi_turns", F.lit(1)))])


def test_reports_are_written(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "k string, n long")
    sinks.write_reports({"one": df, "two": df}, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "two")).collect() == df.collect()


def test_privacy_audit_looks_into_nested_columns(spark):
    rows = [([{"who": "a@b.co"}], ("x", ["13812345678"]), {"k": "two\nlines"}, [["0123456789abcdef0123"]])]
    df = spark.createDataFrame(rows, "list array<struct<who:string>>, one struct<name:string,phones:array<string>>, map map<string,string>, deep array<array<string>>")
    got = {(r["column"], r["problem"], r["rows"]) for r in audit.aggregate_only(df).collect()}
    assert got == {("list.who", "contact", 1), ("one.phones", "contact", 1), ("map.value", "long text", 1), ("deep", "identifier", 1)}
    assert {r["column"] for r in audit.aggregate_only(spark.createDataFrame([([("t",)],)], "rows array<struct<clientId:string>>")).collect()} == {"rows.clientId"}


def test_changed_days_follow_the_code(spark):
    day = spark.createDataFrame([("M1", D(2026, 8, 1), 1, 2), ("M1", D(2026, 8, 9), 3, 4)], "product string, data_date date, hash_sum long, rows long")
    now = sinks.with_code(day, audit)
    todo, window = sinks.run_days(now, now, "2026-08-09")
    assert todo.isEmpty() and [r["data_date"] for r in window.collect()] == [D(2026, 8, 9)]
    assert sinks.changed_days(now, sinks.with_code(day, sinks)).count() == 2


def test_segment_query_takes_one_to_four_known_groups(spark):
    from dialoom.operators import interest

    profiles = spark.createDataFrame([("u", "a", True)], "client_id string, g string, eligible boolean")
    pairs = spark.createDataFrame([("u", "e")], "client_id string, entity_id string")
    groups, sets = interest.segment_groups(profiles, ["g"], [["g"]]), [["g"]]
    overall = interest.segment_overall(pairs, profiles, ["g"], sets, pairs.select("entity_id"))
    ask = lambda *w: interest.segment_query(groups, overall, interest.segment_interest(pairs, profiles, ["g"], sets), {"g": spark.createDataFrame([("a",), ("b",)], "g string")}, ["g"], ["g"], list(w))
    assert {(r["g"], r["interest_users"]) for r in ask(("a",), ("b",)).collect()} == {("a", 1), ("b", 0)}
    for wrong in ([], [("a",)] * 2, [("z",)]):
        with pytest.raises(ValueError):
            ask(*wrong)


def _rules(df):
    return sorted(((r["rule"], r["key"]) for r in df.collect()), key=repr)


def test_identity_audit_counts_every_row_and_null_keys(spark, monkeypatch):
    monkeypatch.setattr(audit, "UNFOLD", 2)  # groups that break a rule more often than an array may hold
    rows = [(None, 3, "u", "s"), (None, 3, "v", "s"), ("a", 5, "", None), ("b", 6, None, "t")] + [("c", 9, "", "t")] * 5
    df = spark.createDataFrame(rows, "id string, source_row long, client_id string, cid string")
    want = [("id repeated", None), ("id repeated", "c"), ("long session", "t"), ("no session", "5"), *[("no user", "5"), ("no user", "6")], *[("no user", "9")] * 5, ("row repeated", "3"), ("row repeated", "9"), ("rows have gaps", "9"), ("several users", "s")]
    assert sorted(_rules(audit.identity(df, 1, 4)), key=repr) == sorted(want, key=repr)
    assert audit.identity(df.limit(0)).isEmpty()
    assert audit.identity(df)._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") + audit.identity(df)._jdf.queryExecution().optimizedPlan().toString().count("LocalRelation") == 1  # one scan


def test_contributions_audit_counts_every_hit(spark, monkeypatch):
    monkeypatch.setattr(audit, "UNFOLD", 2)
    key, hit = "a" * 64, "client_id string, rollup_id string, cid string, queries long, polarities array<string>"
    hits = spark.createDataFrame([(key, "r", "1", 2, ["good"]), (key, "r", "1", 0, ["odd"]), *[("b" * 64, "x", str(i), 1, ["good"]) for i in range(5)], (None, None, "9", 1, [])], hit)
    users, rollups = spark.createDataFrame([(key,), ("short",), (None,)], "client_id string"), spark.createDataFrame([("r",), ("y",)], "rollup_id string")
    totals = spark.createDataFrame([("r", 2), ("x", 4), ("y", 0)], "rollup_id string, queries long")
    got = sorted(_rules(audit.contributions(users, hits, rollups, ["good"], totals)), key=repr)
    b = "b" * 64
    want = [("user key form", "short"), *[("unknown user", b)] * 5, ("unknown user", None), *[("unknown rollup", "x")] * 5, ("unknown rollup", None), ("count not positive", "r"), ("polarity", "r"), ("repeated", "r"), ("day sum", "x"), ("day sum", "y"), ("day sum", None)]
    assert got == sorted(want, key=repr)
    assert audit.contributions(users.limit(0), hits.limit(0), rollups.limit(0), ["good"], totals.limit(0)).isEmpty()


def test_directions_audit_without_rows(spark):
    directions = spark.createDataFrame([], "direction string, sessions long, turns long, reply_sessions long, share double")
    coverage = spark.createDataFrame([(2, 1, 0, 2 / 3)], "classified long, unlabelled long, unsupported long, coverage double")
    groups = spark.createDataFrame([("startPrompt", 3, 4, 1), ("other", 9, 9, 0)], "category string, sessions long, total_turns long, reply_sessions long")
    assert _rules(audit.opening_directions(directions, coverage, groups)) == [("directions are not the classified", "0")]
    own = spark.createDataFrame([("night", 2, 3, 1, 2 / 3)], directions.schema)
    assert audit.opening_directions(own, coverage, groups).isEmpty()
    assert audit.opening_directions(directions, coverage.limit(0), groups.limit(0)).isEmpty()
    assert _rules(audit.opening_directions(own.union(own), coverage, groups)) == [("directions are not the classified", "4"), ("more than the group", "4"), ("repeated", "night")]


def test_profile_audit_counts_every_item(spark):
    section = spark.createDataFrame([("g", 5, 3, 0.6), ("h", 1, 2, 2.0)], "part string, eligible_users long, normal_users long, coverage double")
    statuses = spark.createDataFrame([("g", "normal", 3), ("g", "other", 2), ("h", "other", -1), ("h", "other", 2)], "part string, status string, users long")
    kind = "part string, label string, users long, sessions long, turns long, five_plus_sessions long, user_share double, average double, five_plus_share double, sample_status string"
    label = audit.sample_label(F.col("users"))
    items = spark.createDataFrame([("g", "x", 3, 6, 12, 3, 1.0, 2.0, 0.5, None), ("h", "y", 1, 1, 1, 2, 0.5, 1.0, 2.0, None), ("h", "y", 1, 2, 2, 0, 0.1, 1.0, 0.0, None)], kind).withColumn("sample_status", label)
    statuses = statuses.withColumn("status", F.when(F.col("status") == "normal", audit.NORMAL).otherwise(F.col("status")))
    want = [("counts", "h"), ("item counts", "y"), ("label repeated", "h"), ("normal status", "h"), ("status count", "h"), ("status repeated", "h"), ("user share", "y")]
    assert _rules(audit.profile_section(section, statuses, items, "part")) == want
    assert audit.profile_section(section.limit(0), statuses.limit(0), items.limit(0), "part").isEmpty()


def test_days_are_published_at_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    make = lambda rows: spark.createDataFrame(rows, "product string, data_date date, n long")
    seen = lambda: sorted(((r["product"], r["data_date"].day, r["n"]) for r in sinks.published(spark, path).collect()), key=repr)
    assert sinks.published(spark, path) is None
    first = make([("M1", D(2026, 8, 1), 1), ("M1", D(2026, 8, 2), 2), (None, D(2026, 8, 2), 7)])
    assert sinks.publish_days(first, path) == 1 and sinks.publish_days(first, path) is None
    # a run that ends between write and publish leaves the old days readable, and the next one takes its place
    with monkeypatch.context() as m:
        m.setattr(sinks.periods, "table_digest", lambda *a: 1 / 0)
        try:
            sinks.publish_days(make([("M1", D(2026, 8, 1), 9)]), path)
        except ZeroDivisionError:
            pass
    assert seen() == sorted([("M1", 1, 1), ("M1", 2, 2), (None, 2, 7)], key=repr)
    again = make([("M1", D(2026, 8, 2), 2), ("M1", D(2026, 8, 3), 3), ("M1", D(2026, 8, 3), 3)])
    assert sinks.publish_days(again, path, make([("M1", D(2026, 8, k), 0) for k in (1, 2, 3, 4)])) == 2
    assert seen() == sorted([("M1", 2, 2), ("M1", 3, 3), ("M1", 3, 3), (None, 2, 7)], key=repr)
    assert {(r["data_date"].day, r["version"], r["rows"]) for r in sinks.pointers(spark, path).filter("product = 'M1'").collect()} == {(1, 2, 0), (2, 1, 1), (3, 2, 2), (4, 2, 0)}
    nothing = make([])
    assert sinks.publish_days(nothing, path, first.unionByName(again)) == 3 and seen() == []
    assert sinks.publish_days(nothing, path) is None

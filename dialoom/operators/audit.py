"""Audits. Each returns a table of violations; an empty table passes."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialoom.functions.text import EMAIL, NORMAL, PHONE, sample_label
from dialoom.operators.sessions import confirm_coverage

# What an aggregate table must not hold.
FORBIDDEN = re.compile(r"(^|_)(cid|clientid|client_id|text|ai_text|response|query|evidence|preview|fingerprint|birthday|city|city_normalized|constellation)(_|$)", re.I)
ALLOWED = {"constellation_users", "constellation_eligible_users", "constellation_rate", "query_count"}
IDENTIFIER = r"^[0-9a-f]{20,40}$"
PSEUDONYM = r"^[0-9a-f]{20}$"
HEX64 = r"^[0-9a-f]{64}$"
UNFOLD = 10_000


def _rule(rows: DataFrame, rule: str, key: str) -> DataFrame:
    return rows.select(F.lit(rule).alias("rule"), F.col(key).cast("string").alias("key"))


def _all(found: list[DataFrame]) -> DataFrame:
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _broken(rows: DataFrame, rules: list[tuple[str, str, Column]]) -> DataFrame:
    """(rule, key) of all rules (name, key column, condition or number of times) that a row breaks, in one pass over the rows.

    A group that breaks a rule several times is unfolded in two steps, so no array is longer than ``UNFOLD`` or the times over it."""
    times = [n.cast("long") for _, _, n in rules]
    each = [F.struct(F.lit(rule).alias("rule"), F.col(key).cast("string").alias("key"), n.alias("times")) for (rule, key, _), n in zip(rules, times, strict=True)]
    found = rows.filter(F.greatest(*times, F.lit(0)) > 0).select(F.inline(F.array(*each))).filter("times > 0")
    found = found.withColumn("step", F.explode(F.sequence(F.lit(0), F.floor((F.col("times") - 1) / UNFOLD))))
    return found.withColumn("one", F.explode(F.sequence(F.lit(1), F.least(F.lit(UNFOLD), F.col("times") - F.col("step") * UNFOLD)))).select("rule", "key")


def _times(condition: Column, name: str) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False))).alias(name)


def _off(share: Column, n: Column, d: Column) -> Column:
    """The share is not n over max(1, d)."""
    return ~F.coalesce(F.abs(share - n / F.greatest(d, F.lit(1))) < 1e-12, F.lit(False))


def _inexact(rate: Column, n: Column, d: Column) -> Column:
    """The rate is not n over d, null over zero."""
    right = F.try_divide(n.cast("double"), d.cast("double"))
    return ~F.coalesce(F.abs(rate - right) < 1e-12, rate.isNull() & right.isNull())


def required_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """P1."""
    return df.sparkSession.createDataFrame([(c,) for c in sorted(set(required) - set(df.columns))], "missing string")


def row_count(df: DataFrame, expected: int) -> DataFrame:
    """P2."""
    return df.agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") != expected).withColumn("expected", F.lit(expected).cast("long"))


def one_date_and_scene(df: DataFrame, date: str, scene: str) -> DataFrame:
    """Rows of another date or scene, or with a date that is none."""
    day = F.try_to_date(F.substring("created_at", 1, 10), "yyyy-MM-dd")
    wrong = ~day.eqNullSafe(F.lit(date).cast("date")) | ~F.col("sceneId").eqNullSafe(F.lit(scene))
    return df.filter(wrong).select("source_row", "created_at", "sceneId")


def date_span(df: DataFrame) -> DataFrame:
    """Rows, first and last time text."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.min("created_at").alias("first"), F.max("created_at").alias("last"))


def identity(df: DataFrame, row_start: int = 1, longest: int = 10_000) -> DataFrame:
    """(rule, key): repeated ids or rows, gaps, empty users or sessions, sessions of several users or of unexpected length.

    Every row gives one mark for its id, its row number, its session and the table, and one of its own if its user or session is empty; all marks
    are counted in one grouping. Null ids are one id."""
    row, user, none = F.col("source_row").cast("long"), F.col("client_id").cast("string"), F.lit(None)
    mark = lambda kind, key, at=none: F.struct(F.lit(kind).alias("kind"), key.cast("string").alias("key"), at.cast("long").alias("at"))
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) == ""
    own = [F.when(empty(c), mark(kind, F.col("source_row"), F.monotonically_increasing_id())) for c, kind in (("client_id", "no user"), ("cid", "no session"))]
    marks = F.array_compact(F.array(mark("id", F.col("id")), mark("row", F.col("source_row")), mark("session", F.col("cid")), mark("table", none), *own))
    groups = df.select(row.alias("row"), user.alias("user"), F.inline(marks)).groupBy("kind", "key", "at").agg(F.count(F.lit(1)).alias("n"), F.min("user").alias("a"), F.max("user").alias("b"), F.min("row").alias("lo"), F.max("row").alias("hi"))
    kind, n = F.col("kind"), F.col("n")
    return _broken(groups, [
        ("id repeated", "key", (kind == "id") & (n > 1)), ("row repeated", "key", (kind == "row") & (n > 1)),
        ("rows have gaps", "n", (kind == "table") & ((F.col("lo") != row_start) | (F.col("hi") - F.col("lo") + 1 != n))), ("no user", "key", kind == "no user"), ("no session", "key", kind == "no session"),
        ("several users", "key", (kind == "session") & (F.col("a") != F.col("b"))), ("long session", "key", (kind == "session") & (n > longest)),
    ])


def ratios(rows: DataFrame) -> DataFrame:
    """P5 over (path, n, d, rate)."""
    off = F.abs(F.col("rate") - F.try_divide(F.col("n").cast("double"), F.col("d").cast("double"))) >= 1e-12
    return rows.filter((F.col("n") < 0) | (F.col("n") > F.col("d")) | ((F.col("d") == 0) != F.col("rate").isNull()) | F.coalesce(off, F.lit(False)))


def risk_rates(rows: DataFrame) -> DataFrame:
    """P6 over (path, n, d, rate, counts_events): event rates may exceed 1."""
    return ratios(rows.withColumn("n", F.when(F.col("counts_events"), F.least("n", "d")).otherwise(F.col("n"))).withColumn("rate", F.when(F.col("counts_events") & (F.col("rate") > 1), 1.0).otherwise(F.col("rate"))))


def structure(rows: DataFrame) -> DataFrame:
    """Identities of the session structure table."""
    single, multi, five, turns, multi_turns = (F.col(c) for c in ("single_sessions", "multi_sessions", "five_plus_sessions", "total_turns", "multi_turns"))
    good = (single + multi == F.col("total_sessions")) & (multi_turns + single == turns) & (multi_turns >= 2 * multi) & (multi_turns >= 5 * five + 2 * (multi - five)) & ((five > 0) | (multi_turns <= 4 * multi))
    return rows.filter(~good)


def partition_sums(rows: DataFrame, by: list[str], parts: Column, whole: DataFrame, total: str) -> DataFrame:
    """Groups whose parts do not add up to the total of the other table."""
    sums = rows.groupBy(*by).agg(F.sum(parts).alias("part_sum"))
    return sums.join(whole.select(*by, F.col(total).alias("whole")), by, "full_outer").filter(~F.col("part_sum").eqNullSafe(F.col("whole")))


def profile_section(section: DataFrame, statuses: DataFrame, items: DataFrame, by: str) -> DataFrame:
    """(rule, key) over sections (by, eligible_users, normal_users, coverage), their statuses (by, status, users) and their items
    (by, label, users, sessions, turns, five_plus_sessions, user_share, average, five_plus_share, sample_status).

    Statuses and items are read once: each row counts for its label and for its section, all in one grouping. A section is one row."""
    users, sessions, none = F.col("users"), F.col("sessions"), F.lit(None)
    of_item = {
        "item counts": (F.least("users", "sessions", "turns", "five_plus_sessions") < 0) | (F.col("five_plus_sessions") > sessions), "user share": F.col("known") & _off(F.col("user_share"), users, F.col("section_normal")),
        "average": _off(F.col("average"), F.col("turns"), sessions), "five plus share": _off(F.col("five_plus_share"), F.col("five_plus_sessions"), sessions), "sample label": F.col("sample_status") != sample_label(users),
    }
    of_section = {"counts": (F.col("normal_users") < 0) | (F.col("normal_users") > F.col("eligible_users")), "coverage": _off(F.col("coverage"), F.col("normal_users"), F.col("eligible_users"))}
    wrong = lambda found: [c.cast("int").alias(r) for r, c in found.items()]
    twice = lambda label, kind: F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), x.cast("string").alias("label")) for k, x in ((kind, label), ("section", none))]))
    known = items.join(section.select(by, F.col("normal_users").alias("section_normal"), F.lit(True).alias("known")), by, "left")
    marks = known.select(by, users.alias("item_users"), *wrong(of_item), twice(F.col("label"), "item"))
    marks = marks.unionByName(statuses.select(by, users.alias("status_users"), F.when(F.col("status") == NORMAL, users).alias("status_normal"), *wrong({"status count": users < 0}), twice(F.col("status"), "status")), True)
    marks = marks.unionByName(section.select(by, "eligible_users", "normal_users", *wrong(of_section), F.lit("section").alias("kind"), none.cast("string").alias("label"), F.lit(1).alias("listed")), True)
    sums = [F.coalesce(F.sum(f"`{c}`"), F.lit(0)).alias(c) for c in ("item_users", "status_users", "status_normal", "listed", *of_item, "status count", *of_section)]
    groups = marks.groupBy("kind", by, "label").agg(F.count(F.lit(1)).alias("n"), F.max("eligible_users").alias("eligible_users"), F.max("normal_users").alias("normal_users"), *sums)
    kind, times, whole = F.col("kind"), (lambda r, k: F.when(F.col("kind") == k, F.col(f"`{r}`"))), (F.col("kind") == "section") & (F.col("listed") > 0)
    return _broken(groups, [
        *[(r, by, times(r, "section")) for r in of_section], ("statuses do not cover users", by, whole & (F.col("status_users") != F.col("eligible_users"))), ("normal status", by, whole & (F.col("status_normal") != F.col("normal_users"))),
        ("items do not cover normal users", by, whole & (F.col("item_users") != F.col("normal_users"))), ("status count", by, times("status count", "status")),
        ("status repeated", by, (kind == "status") & (F.col("n") > 1)), ("label repeated", by, (kind == "item") & (F.col("n") > 1)), *[(r, "label", times(r, "item")) for r in of_item],
    ])


def shares(rows: DataFrame, by: list[str], label: str, count: str, share: str) -> DataFrame:
    """Repeated labels, shares that are not count over the group's sum."""
    sums = rows.groupBy(*by).agg(F.sum(count).alias("all_rows")) if by else rows.agg(F.sum(count).alias("all_rows"))
    repeats = rows.groupBy(*by, label).agg(F.count(F.lit(1)).alias("times"))
    joined = (rows.join(sums, by) if by else rows.join(F.broadcast(sums))).join(repeats, [*by, label])
    return joined.filter((F.col("times") > 1) | (F.abs(F.col(share) - F.col(count) / F.greatest(F.col("all_rows"), F.lit(1))) >= 1e-12)).select(*by, label)


def share_difference(rows: DataFrame) -> DataFrame:
    """P10."""
    return rows.filter(F.abs(F.col("difference") - (F.col("ending_share") - F.col("all_share"))) >= 1e-12)


def ending_cross_check(comparison: DataFrame, ending: DataFrame, label: str) -> DataFrame:
    """P10: labels whose nonzero ending rows are not those of the ending table (label, rows)."""
    one = comparison.filter("ending_rows > 0").select(label, F.col("ending_rows").alias("compared_rows"))
    both = one.join(ending.filter("rows > 0").select(label, F.col("rows").alias("own_rows")), label, "full_outer")
    return both.filter(~F.col("compared_rows").eqNullSafe(F.col("own_rows")))


def opening_groups(groups: DataFrame, structure_row: DataFrame) -> DataFrame:
    """Groups that do not add up to the day's structure, or with more replies than sessions of several turns."""
    sums = groups.agg(F.sum("sessions").alias("s"), F.sum("total_turns").alias("t"), F.sum("multi_sessions").alias("m")).join(F.broadcast(structure_row))
    wrong = sums.filter((F.col("s") != F.col("total_sessions")) | (F.col("t") != F.col("total_turns")) | (F.col("m") != F.col("multi_sessions")))
    over = groups.filter(F.col("reply_sessions") > F.col("multi_sessions")).select(F.concat(F.lit("replies: "), "category").alias("rule"))
    return wrong.select(F.lit("sums").alias("rule")).unionByName(over)


def opening_directions(directions: DataFrame, coverage: DataFrame, groups: DataFrame) -> DataFrame:
    """(rule, key): directions that are repeated, have more replies than sessions or a wrong share, or do not add up to the classified
    sessions; parts of the coverage that do not add up to the placeholder sessions. ``coverage`` and the placeholder group are one row each.

    Each table is read once; a direction's row counts for its direction and for the whole."""
    parts = ["sessions", "turns", "reply_sessions"]
    start = groups.agg(*[F.max(F.when(F.col("category") == "startPrompt", F.col(c))).alias(n) for c, n in (("sessions", "start_sessions"), ("total_turns", "start_turns"), ("reply_sessions", "start_replies"))])
    ones = start.join(F.broadcast(coverage.agg(*[F.max(c).alias(c) for c in ("classified", "unlabelled", "unsupported", "coverage")])))  # one row, whatever the tables hold
    nothing = directions.sparkSession.range(1).select(F.lit(True).alias("whole"), *[F.lit(0).cast("long").alias(c) for c in parts])
    marks = directions.select("direction", "share", *parts, F.explode(F.array(F.lit(False), F.lit(True))).alias("whole")).unionByName(nothing, True).join(F.broadcast(ones))
    begun = F.col("start_sessions").isNotNull()
    counts = F.expr("reply_sessions > sessions or least(sessions, turns, reply_sessions) < 0")
    one = [F.first(c).alias(c) for c in ones.columns]
    sums = marks.groupBy("whole", F.when(~F.col("whole"), F.col("direction")).alias("direction")).agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(c), F.lit(0)).alias(f"sum_{c}") for c in parts], *one, _times(counts, "counts"), _times(begun & _inexact(F.col("share"), F.col("sessions"), F.col("start_sessions")), "shares"))
    whole, every = F.col("whole") & begun & F.col("classified").isNotNull(), F.col("classified") + F.col("unlabelled") + F.col("unsupported")
    more = F.expr("sum_sessions > start_sessions or sum_turns > start_turns or sum_reply_sessions > start_replies")
    return _broken(sums, [
        ("repeated", "direction", ~F.col("whole") & (F.col("n") > 1)), ("counts", "direction", F.when(~F.col("whole"), F.col("counts"))), ("share", "direction", F.when(~F.col("whole"), F.col("shares"))),
        ("coverage parts", "start_sessions", whole & (every != F.col("start_sessions"))), ("coverage", "coverage", whole & _inexact(F.col("coverage"), F.col("classified"), F.col("start_sessions"))),
        ("directions are not the classified", "sum_sessions", whole & (F.col("sum_sessions") != F.col("classified"))), ("more than the group", "sum_sessions", whole & more),
    ])


def grid_complete(rows: DataFrame, grid: DataFrame, keys: list[str]) -> DataFrame:
    """Keys missing from the table, keys outside the grid, repeated keys."""
    side = lambda df, what: df.select(*keys).withColumn("problem", F.lit(what))
    same = [F.col(f"x.{k}").eqNullSafe(F.col(f"y.{k}")) for k in keys]
    a, b = rows.alias("x"), grid.alias("y")
    condition = same[0]
    for more in same[1:]:
        condition &= more
    missing = grid.alias("y").join(a, condition, "left_anti")
    extra = rows.alias("x").join(b, condition, "left_anti")
    twice = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return side(missing, "missing").unionByName(side(extra, "outside")).unionByName(side(twice, "repeated"))


def segment_counts(rows: DataFrame) -> DataFrame:
    """Counts out of bounds, coverage that is not exact."""
    exact = F.coalesce(F.abs(F.col("coverage") - F.try_divide(F.col("interest_users").cast("double"), F.col("eligible_users").cast("double"))) < 1e-12, F.col("eligible_users") == 0)
    return rows.filter((F.col("interest_users") < 0) | (F.col("interest_users") > F.col("eligible_users")) | ~exact)


def segment_sets(groups: DataFrame, overall: DataFrame, counts: DataFrame, sets: list[str], key: str = "entity_id") -> DataFrame:
    """(rule, key): dimension sets that are missing from the overall table, listed entities that are repeated, sparse counts that are
    zero, above the group's eligible users or of an entity the overall table does not list, groups with a wrong sample label.

    The sparse counts meet their groups (one row each) in one join, then the overall table and the asked sets in one grouping by set and entity."""
    asked = overall.sparkSession.createDataFrame([(s,) for s in sets], "dimension_set string")
    dims = [c for c in groups.columns if c not in ("dimension_set", "users", "eligible_users", "sample_status")]
    own, other = counts.alias("x"), groups.withColumn("found", F.lit(True)).alias("y")
    same = F.col("x.dimension_set") == F.col("y.dimension_set")
    for d in dims:
        same &= F.col(f"x.{d}").eqNullSafe(F.col(f"y.{d}"))
    sparse = F.expr("x.interest_users <= 0 or x.interest_users > y.eligible_users") & F.col("y.found")
    marks = own.join(other, same, "left").select(F.col("x.dimension_set").alias("dimension_set"), F.col(f"x.{key}").alias(key), F.lit(1).alias("counted"), F.col("y.found").isNull().alias("lost"), sparse.alias("sparse"))
    marks = marks.unionByName(overall.select("dimension_set", key, F.lit(1).alias("listed")), True)
    # a listed entity counts for its set too
    marks = marks.withColumn("of_set", F.explode(F.when(F.col("listed") == 1, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    marks = marks.withColumn(key, F.when(~F.col("of_set"), F.col(key))).unionByName(asked.withColumns({"of_set": F.lit(True), "asked": F.lit(1)}), True)
    sums = marks.groupBy("of_set", "dimension_set", key).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("counted", "listed", "asked")], _times(F.col("lost"), "lost"), _times(F.col("sparse"), "sparse"))
    unlisted = (F.col("listed") == 0) | F.col("dimension_set").isNull() | F.col(key).isNull()
    entity = lambda n: F.when(~F.col("of_set"), n)
    found = _broken(sums, [
        ("set missing", "dimension_set", F.when(F.col("of_set") & (F.col("listed") == 0), F.col("asked"))), ("entity repeated", key, entity(F.col("listed") > 1)), ("entity not listed", key, entity(F.when(unlisted, F.col("counted")))),
        ("group missing", "dimension_set", entity(F.col("lost"))), ("sparse count", key, entity(F.col("sparse"))),
    ])
    of_group = [("group counts", "dimension_set", F.expr("users < 0 or eligible_users < 0 or eligible_users > users"))]
    if "sample_status" in groups.columns:
        of_group.append(("sample label", "dimension_set", F.col("sample_status") != sample_label(F.col("eligible_users"))))
    return found.unionByName(_broken(groups, of_group))


def demographic_view(rows: DataFrame, overall: DataFrame, groups: DataFrame, dims: list[str], key: str = "entity_id") -> DataFrame:
    """(rule, key) over the dense view (dims, key, eligible_users, interest_users, coverage, difference), the overall list (key, rank,
    eligible_users, interest_users, coverage) of one dimension set and its groups (dims, position, eligible_users) in the fixed order of the domains."""
    fixed = groups.withColumn("right_position", F.row_number().over(Window.orderBy(*dims)))  # a grid of small fixed domains
    eligible = overall.agg(F.max("eligible_users").alias("overall_eligible")).join(F.broadcast(groups.agg(F.sum("eligible_users").alias("group_sum"))))
    both = rows.join(overall.select(key, F.col("coverage").alias("overall_coverage"), F.lit(True).alias("listed")), key, "left")
    gap = F.when(F.col("coverage").isNull() | F.col("overall_coverage").isNull(), F.col("difference").isNull()).otherwise(F.coalesce(F.abs(F.col("difference") - (F.col("coverage") - F.col("overall_coverage"))) < 1e-12, F.lit(False)))
    order = Window.orderBy(F.desc("interest_users"), F.desc(F.coalesce("coverage", F.lit(0.0))), key)  # one row for each listed entity
    ranked = overall.withColumn("right_rank", F.row_number().over(order))
    return _all([
        _rule(fixed.filter("position != right_position"), "group order", "position"), _rule(eligible.filter("overall_eligible != group_sum"), "eligible users", "group_sum"), _rule(ranked.filter("rank != right_rank"), "list order", key),
        _broken(both, [
            ("counts", key, F.expr("interest_users < 0 or interest_users > eligible_users")), ("coverage", key, _inexact(F.col("coverage"), F.col("interest_users"), F.col("eligible_users"))),
            ("difference", key, ~gap), ("entity not listed", key, F.col("listed").isNull()),
        ]),
    ])


def _columns(schema: T.StructType) -> list[tuple[str, Column, T.DataType, bool]]:
    """Names and values of all fields, those of structs, arrays and maps too; what lies in an array or map is an array of values."""

    def below(kind: T.DataType, value: Column, path: str, many: bool) -> list[tuple[str, Column, T.DataType, bool]]:
        out = [(path, value, kind, many)]
        inside = (lambda f: F.transform(value, f)) if many else (lambda f: f(value))
        if isinstance(kind, T.StructType):
            for field in kind.fields:
                out += below(field.dataType, inside((lambda name: lambda v: v[name])(field.name)), f"{path}.{field.name}", many)
        elif isinstance(kind, T.ArrayType):
            out += below(kind.elementType, F.flatten(value) if many else value, path, True)
        elif isinstance(kind, T.MapType):
            for name, of, part in (("key", F.map_keys, kind.keyType), ("value", F.map_values, kind.valueType)):
                out += below(part, F.flatten(F.transform(value, of)) if many else of(value), f"{path}.{name}", True)
        return out

    return [x for field in schema.fields for x in below(field.dataType, F.col(f"`{field.name}`"), field.name, False)]


def aggregate_only(df: DataFrame) -> DataFrame:
    """Forbidden column names, and strings at any depth that are identifiers, contacts, long or of several lines; one pass over the rows."""
    spark, fields = df.sparkSession, _columns(df.schema)
    names = {}
    for path, *_ in fields:
        snake = re.sub(r"(?<!^)(?=[A-Z])", "_", path.split(".")[-1]).lower()
        if FORBIDDEN.search(snake) and snake not in ALLOWED:
            names[path] = (path, "forbidden name", 1)
    out = spark.createDataFrame(list(names.values()), "column string, problem string, rows long")
    strings = [(path, value, many) for path, value, kind, many in fields if isinstance(kind, T.StringType)]
    if not strings:
        return out
    tests = {"identifier": lambda c: c.rlike(IDENTIFIER), "contact": lambda c: c.rlike(EMAIL) | c.rlike(PHONE), "long text": lambda c: c.rlike(r"[\r\n]") | (F.char_length(c) > 240)}
    flat = df.agg(*[F.count_if(F.exists(value, test) if many else test(value)).alias(f"{k}|{i}") for i, (_, value, many) in enumerate(strings) for k, test in tests.items()])
    rows = F.array(*[F.struct(F.lit(path).alias("column"), F.lit(k).alias("problem"), F.col(f"`{k}|{i}`").alias("rows")) for i, (path, *_) in enumerate(strings) for k in tests])
    return out.unionByName(flat.select(F.inline(rows)).filter("rows > 0"))


def turn_table_privacy(df: DataFrame, keys: list[str], labels: list[str]) -> DataFrame:
    """Pseudonyms of the wrong form, label columns with contact-like text."""
    tests = [(k, "pseudonym", ~F.col(k).rlike(PSEUDONYM)) for k in keys] + [(c, "contact", F.col(c).rlike(EMAIL) | F.col(c).rlike(PHONE)) for c in labels]
    flat = df.agg(*[F.count_if(t).alias(f"t{i}") for i, (_, _, t) in enumerate(tests)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(p).alias("problem"), F.col(f"t{i}").alias("rows")) for i, (c, p, _) in enumerate(tests)])
    return flat.select(F.inline(rows)).filter("rows > 0")


def compared(one: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Keys on which two computations of a table differ, column by column."""
    values = [c for c in one.columns if c not in keys]
    both = one.select(*keys, *[F.col(c).alias(f"a_{c}") for c in values], F.lit(1).alias("a_")).join(other.select(*keys, *[F.col(c).alias(f"b_{c}") for c in values], F.lit(1).alias("b_")), keys, "full_outer")
    wrong = F.filter(F.array(*[F.when(~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")), F.lit(c)) for c in values], F.when(F.col("a_").isNull() | F.col("b_").isNull(), F.lit("row"))), lambda x: x.isNotNull())
    return both.withColumn("columns", F.array_join(wrong, ",")).filter("columns != ''").select(*keys, "columns")


def recomputed(stored: dict[str, DataFrame], again: dict[str, DataFrame], keys: dict[str, list[str]]) -> DataFrame:
    """(table, key, columns) of all tables of a day (counters, entities, rollups, structure) that differ from their second computation."""
    out = None
    for name, df in stored.items():
        found = compared(df, again[name], keys[name])
        rows = found.select(F.lit(name).alias("table"), F.concat_ws("|", *[F.col(k).cast("string") for k in keys[name]]).alias("key"), "columns")
        out = rows if out is None else out.unionByName(rows)
    return out


def paired(one: DataFrame, other: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Two turn tables side by side by row, and (key, missing_side) of the rows that only one of them has."""
    a, b = one.withColumn("has_left", F.lit(1)), other.withColumn("has_right", F.lit(1))
    both = a.join(b, key, "full_outer")
    alone = both.filter("has_left is null or has_right is null").select(key, F.when(F.col("has_left").isNull(), "left").otherwise("right").alias("missing_side"))
    return both.filter("has_left = 1 and has_right = 1").drop("has_left", "has_right"), alone


def evidence(rows: DataFrame, ids: str, lists: list[str], is_content: Column) -> DataFrame:
    """Lists of other length than the ids, repeated ids, evidence on rows without content."""
    bad = F.size(F.array_distinct(ids)) != F.size(ids)
    for c in lists:
        bad |= F.size(c) != F.size(ids)
    return rows.filter(bad | (~is_content & (F.size(ids) > 0))).select("source_row")


def dictionary(entities: DataFrame, aliases: DataFrame) -> DataFrame:
    """(rule, key)."""
    twice = lambda df, *c: df.groupBy(*c).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    parents = entities.select(F.col("entity_id").alias("p1"), F.col("parent_id").alias("p2"))
    up = entities.filter("parent_id is not null").join(parents, F.col("parent_id") == F.col("p1"), "left")
    up2 = up.join(parents.select(F.col("p1").alias("q1"), F.col("p2").alias("q2")), F.col("p2") == F.col("q1"), "left")
    loops = (F.col("parent_id") == F.col("entity_id")) | (F.col("p2") == F.col("entity_id")) | (F.col("q2") == F.col("entity_id"))
    found = [
        _rule(twice(entities, "entity_id"), "id repeated", "entity_id"), _rule(twice(entities, "name"), "name repeated", "name"), _rule(twice(aliases, "mode", "normalized"), "alias repeated", "normalized"),
        _rule(aliases.filter("policy = 'context' and coalesce(size(terms), 0) <= 0"), "context without terms", "normalized"),
        _rule(aliases.filter((F.col("mode") == "pattern") & (~F.col("value").rlike(r"^\^.*\$$") | (F.char_length("value") > 128) | F.col("value").contains(".*"))), "pattern form", "value"),
        _rule(up.filter("p1 is null"), "unknown parent", "entity_id"), _rule(up2.filter(loops), "cycle", "entity_id"), _rule(up2.filter(F.col("q2").isNotNull() & ~loops), "too deep", "entity_id"),
    ]
    return _all(found)


def contributions(users: DataFrame, hits: DataFrame, rollups: DataFrame, allowed: list[str], totals: DataFrame | None = None) -> DataFrame:
    """(rule, key); ``totals`` (rollup_id, queries) are the day's rollups, one row each, which the hits have to add up to.

    Every table is read once: a hit counts for itself, for its user and for its rollup, all in one grouping."""
    text, none = "string", F.lit(None)
    mark = lambda kind, user=none, rollup=none, cid=none: F.struct(F.lit(kind).alias("kind"), user.cast(text).alias("client_id"), rollup.cast(text).alias("rollup_id"), cid.cast(text).alias("cid"))
    user, rollup = F.col("client_id"), F.col("rollup_id")
    odd = F.size(F.array_except("polarities", F.lit(allowed))) > 0
    marks = hits.select(F.lit(1).alias("hit"), "queries", odd.alias("odd"), F.inline(F.array(mark("hit", user, rollup, F.col("cid")), mark("user", user), mark("rollup", none, rollup))))
    for kind, df, key in (("user", users, mark("user", user)), ("rollup", rollups, mark("rollup", none, rollup))):
        marks = marks.unionByName(df.select(F.lit(1).alias(f"known_{kind}"), F.inline(F.array(key))), True)
    if totals is not None:
        marks = marks.unionByName(totals.select(F.lit(1).alias("day"), F.col("queries").alias("day_queries"), F.inline(F.array(mark("rollup", none, rollup)))), True)
    counted = ["hit", "known_user", "known_rollup", *(["day"] if totals is not None else [])]
    sums = [F.sum("queries").alias("hit_queries"), *([F.sum("day_queries").alias("day_queries")] if totals is not None else [])]
    groups = marks.groupBy("kind", "client_id", "rollup_id", "cid").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counted], *sums, _times(F.col("queries") <= 0, "low"), _times(F.col("odd"), "odd"))
    of = lambda kind, n: F.when(F.col("kind") == kind, n)
    unknown = lambda kind, key: of(kind, F.when((F.col(f"known_{kind}") == 0) | key.isNull(), F.col("hit")))
    found = [
        ("user key form", "client_id", of("user", F.when(~user.rlike(HEX64), F.col("known_user")))), ("unknown user", "client_id", unknown("user", user)), ("unknown rollup", "rollup_id", unknown("rollup", rollup)),
        ("count not positive", "rollup_id", of("hit", F.col("low"))), ("polarity", "rollup_id", of("hit", F.col("odd"))), ("repeated", "rollup_id", of("hit", F.col("hit") > 1)),
    ]
    if totals is not None:
        summed = (F.col("hit") + F.col("day") > 0) & ~F.col("hit_queries").eqNullSafe(F.col("day_queries"))
        found.append(("day sum", "rollup_id", of("rollup", summed)))
    return _broken(groups, found)


def candidate_table(rows: DataFrame, most: int = 200, min_users: int = 5, min_sessions: int = 8, growth_users: int = 3, min_growth: float = 3.0) -> DataFrame:
    """P20: (rule, key)."""
    eligible = ((F.col("users") >= min_users) & (F.col("sessions") >= min_sessions)) | ((F.col("users") >= growth_users) & F.coalesce(F.col("growth") >= min_growth, F.lit(False)))
    found = [
        _rule(rows.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most), "too many", "n"), _rule(rows.groupBy("norm").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "repeated", "norm"),
        _rule(rows.filter("users < 0 or sessions < 0 or query_count < 0"), "negative", "norm"), _rule(rows.filter(F.isnan("growth") | (F.abs("growth") == float("inf"))), "growth", "norm"),
        _rule(rows.filter(F.size("examples") > 3), "examples", "norm"), _rule(rows.filter(F.col("eligible") != eligible), "eligibility", "norm"),
    ]
    return _all(found)


def contiguous(days: DataFrame, most: int = 7) -> DataFrame:
    """Days of a batch that do not follow the day before; a batch of several products or of more than ``most`` days."""
    order = Window.partitionBy("product").orderBy("data_date")
    gaps = days.withColumn("step", F.datediff("data_date", F.lag("data_date").over(order))).filter("step != 1").select(F.lit("gap").alias("rule"), F.col("data_date").cast("string").alias("key"))
    whole = days.agg(F.count_distinct("product").alias("products"), F.count(F.lit(1)).alias("n")).filter((F.col("products") != 1) | (F.col("n") > most))
    return gaps.unionByName(whole.select(F.lit("batch").alias("rule"), F.col("n").cast("string").alias("key")))


def research_report(daily: DataFrame, cohorts: DataFrame, covered: DataFrame | None = None, lags: tuple[int, ...] = (1, 7)) -> DataFrame:
    """Daily parts that do not add up, cohorts that do not match their day, observed counts over cohort size, and, with the days
    declared complete, cohorts that have a rate before their window is covered or none after it."""
    wrong = _rule(daily.filter("first_observed_users + returning_users != active_users"), "daily sum", "data_date")
    both = daily.filter("first_observed_users > 0").join(cohorts, F.col("data_date") == F.col("first_date"), "full_outer").withColumn("day", F.coalesce("first_date", "data_date"))
    found = [wrong, _rule(both.filter(~F.col("first_observed_users").eqNullSafe(F.col("users"))), "cohort size", "day"), _rule(cohorts.filter(" or ".join(f"d{lag}_observed > users" for lag in lags)), "observed", "first_date")]
    if covered is not None:
        right = confirm_coverage(cohorts, covered, lags).select("first_date", *[F.col(f"d{lag}_rate").alias(f"right_{lag}") for lag in lags])
        joined = cohorts.join(right, "first_date")
        unlike = F.lit(False)
        for lag in lags:
            unlike |= ~F.col(f"d{lag}_rate").eqNullSafe(F.col(f"right_{lag}"))
        found.append(_rule(joined.filter(unlike), "maturity", "first_date"))
    return _all(found)


def outcome_rows(rows: DataFrame, domain: list[str]) -> DataFrame:
    """(rule, key) over reviewed demand (label, complete, partial, unmet, unknown, reviewed_sessions, reviewed_users, completion)."""
    n = F.col("reviewed_sessions")
    parts = F.col("complete") + F.col("partial") + F.col("unmet") + F.col("unknown")
    return _all([
        _rule(rows.filter(~F.coalesce(F.col("label").isin(*domain), F.lit(False))), "label", "label"), _rule(rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "repeated", "label"),
        _rule(rows.filter((parts != n) | (F.col("reviewed_users") > n)), "outcomes", "label"), _rule(rows.filter(_inexact(F.col("completion"), F.col("complete"), n - F.col("unknown"))), "completion", "label"),
    ])


def labels(rows: DataFrame, domains: dict[str, list], annotators: tuple[str, str] | None = None) -> DataFrame:
    """P25: values outside their domain; two annotators that are the same or missing."""
    bad = F.lit(False)
    for column, domain in domains.items():
        bad |= ~F.coalesce(F.col(column).isin(*domain), F.lit(False))
    if annotators:
        a, b = (F.coalesce(c, F.lit("")) for c in annotators)
        bad |= (a == "") | (b == "") | (a == b)
    return rows.filter(bad)


def aligned_labels(rows: DataFrame, key: str, entities: str, lists: dict[str, list[str]], provenance: tuple[str, str] | None = None) -> DataFrame:
    """P25: (rule, key): reviewed rows with a repeated entity, with label lists (arrays beside the entities) of another length or outside
    their domain, or of another provenance (column, wanted value); one pass over the rows."""
    found = [("entity repeated", key, F.size(F.array_distinct(entities)) != F.size(entities))]
    for column, domain in lists.items():
        found += [(f"{column}: length", key, F.size(column) != F.size(entities)), (f"{column}: domain", key, F.size(F.array_except(column, F.lit(domain))) > 0)]
    if provenance:
        found.append(("provenance", key, ~F.col(provenance[0]).eqNullSafe(F.lit(provenance[1]))))
    return _broken(rows, found)


def ranks(rows: DataFrame, by: list[str], rank: str, order: list[Column]) -> DataFrame:
    """Rows whose stored rank is not the rank of the order."""
    return rows.withColumn("right_rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col(rank) != F.col("right_rank"))


def mixed_definitions(days: DataFrame, columns: list[str]) -> DataFrame:
    """One row if the tables to be combined differ in their definition."""
    return days.agg(F.count_distinct(F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])).alias("definitions")).filter("definitions > 1")

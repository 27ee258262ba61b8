"""Turn classification and the session fold that carries context."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.functions import rules
from dialoom.operators.matching import Alias, reading_of

SIGNALED = "array<struct<entity_id:string,signal:string,polarity:string,basis:string>>"
#: What the fold reads of a turn, and what it adds to it.
READ = ("client_id", "cid", "usable", "is_content", "asks_on", "named", "forms", "ai_ids", "ai_norm")
CARRIED = "inherited boolean, context_id string, was_user array<boolean>, was_ai array<boolean>"
_CARRIED = pa.schema([("inherited", pa.bool_()), ("context_id", pa.string()), ("was_user", pa.list_(pa.bool_())), ("was_ai", pa.list_(pa.bool_()))])


def with_row_labels(turns: DataFrame, aliases: list[Alias], topics: dict[str, str]) -> DataFrame:
    """Everything a row tells by itself: normal form, hits of both sides, local clauses, polarity, route, topic, behaviour."""
    df = turns.withColumns({"_read": reading_of(F.col("text"), aliases), "_heard": reading_of(F.col("ai_text"), aliases)})
    located = F.zip_with("_read.hits", "_read.clauses", lambda h, c: F.struct(h["entity_id"].alias("entity_id"), h["normalized"].alias("normalized"), c.alias("clause")))
    df = df.select("*", F.col("_read.hits").alias("hits"), F.col("_heard.hits").alias("ai_hits"), F.col("_read.norm").alias("norm"), F.col("_heard.norm").alias("ai_norm"), located.alias("located")).drop("_read", "_heard")
    named = F.create_map(*[F.lit(x) for kv in topics.items() for x in kv]) if topics else None
    entity_topic = F.try_element_at(named, F.get("hits", F.lit(0))["entity_id"]) if topics else None
    return df.withColumns({
        "is_content": rules.route(F.col("norm"), F.col("is_invalid_turn"), F.col("is_template"), F.size("hits") > 0) == rules.ROUTES[5],
        "row_route": rules.route(F.col("norm"), F.col("is_invalid_turn"), F.col("is_template"), F.size("hits") > 0),
        "row_topic": rules.topic(F.col("norm"), entity_topic), "row_behavior": rules.behavior(F.col("norm")),
        "asks_on": F.col("norm").rlike(rules.CONTINUE_REQUEST),
    })


class Context:
    """What the turn before left: the entities that it was given, and those and the words of the assistant's answer."""

    def __init__(self, canonical: frozenset[str]):
        self.canonical, self.session = canonical, None
        self.users: list[str] = []
        self.assistants: list[str] = []
        self.ai_norm = ""

    def step(self, client, cid, usable, is_content, asks_on, named, forms, ai_ids, ai_norm) -> tuple:
        """One turn in order: whether it inherits and what, and for each of its own entities who had named it before."""
        if (client, cid) != self.session:
            self.session, self.users, self.assistants, self.ai_norm = (client, cid), [], [], ""
        context = {*self.users, *self.assistants}
        only = next(iter(context)) if len(context) == 1 else None
        inherits = bool(usable and asks_on and not named and only in self.canonical)
        out = inherits, only if inherits else None, [i in self.users for i in named], [i in self.assistants or form in self.ai_norm for i, form in zip(named, forms, strict=True)]
        self.users = [only] if inherits else named if is_content else []
        self.assistants, self.ai_norm = ai_ids, ai_norm
        return out


def session_fold(rows: DataFrame, canonical: list[str]) -> DataFrame:
    """The labelled rows with ``entities`` (id, signal, polarity, basis) and ``inherited``, folded along each session.

    Sessions are dealt by key and sorted by source_row; a task reads them as a stream and holds the turn before and nothing else, so a session
    of any length costs its rows once. All columns travel with their row: nothing is joined back, no session is collected.
    """
    usable = F.coalesce((F.col("is_invalid_turn") == "否") & (F.col("is_template") != "是"), F.lit(False))
    slim = rows.withColumn("usable", usable).withColumn("located", F.when(F.col("usable"), F.col("located")).otherwise(F.filter("located", lambda x: F.lit(False))))
    slim = slim.withColumns({"named": F.transform("located", lambda x: x["entity_id"]), "forms": F.transform("located", lambda x: x["normalized"]), "ai_ids": F.transform("ai_hits", lambda h: h["entity_id"])}).drop("hits", "ai_hits")
    names, places = frozenset(canonical), [slim.columns.index(c) for c in READ]

    def carry(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = Context(names)
        for batch in incoming:
            found = [context.step(*turn) for turn in zip(*(batch.column(k).to_pylist() for k in places), strict=True)]
            added = [pa.array([f[k] for f in found], field.type) for k, field in enumerate(_CARRIED)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, *_CARRIED.names])

    dealt = slim.repartition("client_id", "cid").sortWithinPartitions("client_id", "cid", "source_row")
    schema = slim.schema
    for field in rows.sparkSession.createDataFrame([], CARRIED).schema:
        schema = schema.add(field)
    folded = dealt.mapInArrow(carry, schema)

    def judged(x: Column, i: Column) -> Column:
        substantive = x["clause"].rlike(rules.SUBSTANTIVE) & (x["clause"] != x["normalized"])
        signal = F.when(F.get("was_user", i) | F.get("was_ai", i), F.when(substantive, rules.SIGNALS[2]).otherwise(rules.SIGNALS[3])).otherwise(rules.SIGNALS[1])
        return F.struct(x["entity_id"].alias("entity_id"), signal.alias("signal"), rules.polarity(x["clause"]).alias("polarity"), F.lit("explicit_alias").alias("basis"))

    carried = F.array(F.struct(F.col("context_id").alias("entity_id"), F.lit(rules.SIGNALS[2]).alias("signal"), F.lit("neutral").alias("polarity"), F.lit("single_context").alias("basis")))
    entities = F.when(F.col("inherited"), carried.cast(SIGNALED)).otherwise(F.transform("located", judged).cast(SIGNALED))
    return folded.withColumn("entities", entities).drop("usable", "named", "forms", "ai_ids", "context_id", "was_user", "was_ai", "located")


def classify_turns(turns: DataFrame, aliases: list[Alias], topics: dict[str, str] | None = None, canonical: dict[str, str] | None = None) -> DataFrame:
    """The classified turn table: route, topic, behaviour, entities, summary signal. ``canonical`` lists entities whose own name matches them."""
    rows = with_row_labels(turns, aliases, topics or {})
    names = sorted(canonical if canonical is not None else {a.entity_id for a in aliases if a.policy == "auto"})
    out = session_fold(rows, names)
    named = F.create_map(*[F.lit(x) for kv in (topics or {}).items() for x in kv]) if topics else None
    route = F.when(F.col("inherited"), rules.ROUTES[5]).otherwise(F.col("row_route"))
    content = route == rules.ROUTES[5]
    inherited_topic = F.try_element_at(named, F.get("entities", F.lit(0))["entity_id"]) if topics else F.lit(None).cast("string")
    signals = F.array_distinct(F.transform("entities", lambda e: e["signal"]))
    short = route == rules.ROUTES[4]
    return out.withColumns({
        "route": route, "topic": F.when(content, F.coalesce(F.when(F.col("inherited"), inherited_topic), F.col("row_topic"))),
        "behavior": F.when(F.col("inherited") | short, rules.BEHAVIORS[7]).when(content, F.col("row_behavior")),
        "signal": F.when(F.size(signals) == 1, F.get(signals, F.lit(0))).otherwise(rules.SIGNALS[0]),
    }).drop("row_route", "row_topic", "row_behavior", "is_content", "asks_on", "ai_norm")


def mentions(classified: DataFrame) -> DataFrame:
    """One row per entity of a content turn."""
    return classified.filter(F.col("route") == rules.ROUTES[5]).select("client_id", "cid", "source_row", F.inline("entities"))

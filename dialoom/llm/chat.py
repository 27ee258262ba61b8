r"""Chat formatting, in Spark expressions only.

Turn structs of a conversation are collected and sorted (turn, role, text), adjacent turns of one role
become one block, and blocks are joined into one string::

    <|im_start|>role\ntext<|im_sep|>text<|im_end|>\n

A control string in a role or text is broken by escaping its first character ('<' as ``\l``, '[' as
``\b``) and a backslash is doubled, so the escape can be undone and turns read back. Besides the string,
``segments`` lists its pieces in order with the loss mask: true for the texts of assistant turns.

Runs are found by index (filter over positions, then slice), so the cost is linear in the turns. A
conversation is one output row and has to fit in a task; nothing else is gathered.

Defined results: null text and null role count as empty; null turns sort first; rows that tie on the turn
are ordered by role, then text, and repeated rows are all kept; a null conv_id is a conversation of its own;
an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.llm.common import table

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Openings of control strings, and what they become.
CONTROL = (("<|im_", "\\l|im_"), ("<s>", "\\ls>"), ("</s>", "\\l/s>"), ("[INST]", "\\bINST]"), ("[/INST]", "\\b/INST]"))
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for raw, safe in CONTROL:
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape(text: Column) -> Column:
    """Doubled backslashes split the text; what is left in a part is an escaped character."""
    def plain(part):
        for code, raw in (("\\l", "<"), ("\\b", "["), ("\\n", "\n")):
            part = F.replace(part, F.lit(code), F.lit(raw))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), plain), "\\")


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, formatted, segments array<struct<text, loss>>."""
    item = F.struct(F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    convs = turns.groupBy(F.col(conv_col).alias("conv_id")).agg(F.array_sort(F.collect_list(item)).alias("turns"))
    n = F.size("turns")
    change = lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"])
    convs = convs.withColumn("starts", F.filter(F.sequence(F.lit(0), n - 1), change))
    run = lambda s, k: F.struct(F.get("turns", s)["role"].alias("role"), F.transform(F.slice("turns", s + 1, F.coalesce(F.get("starts", k + 1), n) - s), lambda t: escape(t["text"])).alias("texts"))
    convs = convs.withColumn("blocks", F.transform("starts", run))

    def pieces(block):
        loss = block["role"] == LOSS_ROLE
        seg = lambda text, is_loss: F.struct(text.alias("text"), is_loss.alias("loss"))
        head = F.array(seg(F.concat(F.lit(START), escape_role(block["role"]), F.lit("\n")), F.lit(False)))
        body = F.flatten(F.transform(block["texts"], lambda t, i: F.array(seg(F.when(i > 0, SEP).otherwise(""), F.lit(False)), seg(t, loss))))
        return F.concat(head, body, F.array(seg(F.lit(END + "\n"), F.lit(False))))

    convs = convs.withColumn("segments", F.flatten(F.transform("blocks", pieces)))
    return convs.select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted string."""
    blocks = F.slice(F.split(formatted, r"<\|im_start\|>", -1), 2, 2_147_483_000)

    def turns_of(block):
        role = F.substring_index(block, "\n", 1)
        body = F.substring(block, F.char_length(role) + 2, F.char_length(block) - F.char_length(role) - 2 - len(END))
        return F.transform(F.split(body, r"<\|im_sep\|>", -1), lambda t: F.struct(unescape(role).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns_of))


def loss_text(segments: Column) -> Column:
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    out = format_chats(rows.unionByName(extra))
    out = out.withColumns({"read": read_turns(F.col("formatted")), "masked": loss_text(F.col("segments"))})
    said = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("read").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                      F.char_length("masked").cast("long").alias("loss_chars"), F.sha2(F.col("masked"), 256).alias("loss_sha256"), F.char_length("formatted").cast("long").alias("formatted_chars"))


_ESCAPED = "replace(replace(replace(replace(replace(replace({}, '\\', '\\\\'), '<|im_', '\\l|im_'), '<s>', '\\ls>'), '</s>', '\\l/s>'), '[INST]', '\\bINST]'), '[/INST]', '\\b/INST]')"
ORACLE = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
o AS (SELECT *, row_number() OVER w AS k, coalesce(role <> lag(role) OVER w, true) AS fresh FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
a AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY k), '') AS masked,
  sum(length({_ESCAPED.format("text")}) + CASE WHEN fresh THEN 24 + length(replace({_ESCAPED.format("role")}, chr(10), '\\n')) ELSE 10 END) AS formatted_chars
  FROM o GROUP BY conv_id)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, turns_sha256, CAST(length(masked) AS BIGINT) AS loss_chars, sha256(masked) AS loss_sha256,
  CAST(formatted_chars AS BIGINT) AS formatted_chars FROM a
"""

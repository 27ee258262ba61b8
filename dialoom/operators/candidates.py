"""Candidate phrases that the dictionary does not know yet."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialoom.functions.text import CONTACT_LIKE, growth, redacted, strip
from dialoom.operators import matching
from dialoom.sources.shared import saved

# Extraction patterns and the generic-phrase lists.
TITLE = r"《([^》]{2,16})》"
CUE = r"(?i)(?:喜欢|想看|想玩|想听|想聊|聊聊|知道|认识|介绍|讲讲|搜索|关于)([a-z0-9一-鿿·]{2,16})"
TRAILING = r"(?:是什么|是谁|怎么玩|的故事|故事|吗|呢|吧|呀|啊|了)$"
STOP = (
    "一个故事 这个故事 什么东西 怎么回事 好不好 可以吗 为什么 告诉我 介绍一下 我不知道 我也不知道 不知道 我知道 知道了 可以 不可以 没有 你好 你说什么 你说啥 你是谁 你叫什么名字 你在干嘛 你在干什么 继续讲 再说一遍 还有什么 准备好了 "
    "妈妈 爸爸 爷爷 奶奶 外公 外婆 哥哥 姐姐 弟弟 妹妹 好吃 我爱你 什么 不喜欢 我喜欢 喜欢 现在几点 现在几点了 吃什么 睡觉 吃饭 喝水 开心 难过 生气 害怕 想知道 这个 那个 好的好的 你再说一遍 玩游戏 不会 不会的 会的 游戏 没有没有 "
    "故事 动物 小朋友 一下 第一个 都喜欢 巧克力 apple yes no nonono"
).split()
DIALOGUE = (
    r"^(?:(?:我(?:也)?|他|她)?(?:不|没)知道|(?:我)?知道(?:了|啦|啊|呀)?|你(?:好(?:呀|啊)?|说.*|是谁.*|叫什么.*|在干.*)|(?:不)?可以(?:的|了|啦|啊|呀|吧)?|没有(?:啊|呀|了)?|当然(?:了|啦)?|准备好(?:了|啦)?|(?:哈|呵|嘿|嘻|喵|汪|喂){2,}|好呀|对呀|是的|不是|真的|几点了)$"
)
ASKING = r"为什么|怎么|什么|谁|哪里|哪儿|几点|多少|等于几"
BEGINNING = r"^(?:我|你|他|她|它|这|那|嗯|哦|啊|哇|咳|哈喽|好|不|没|是|可以|不用|不要|知道|找|看|玩|画|讲|吃|喝|请|其他|还有|对不起)"
ENDING = r"(?:呀|啊|吧|呢|啦|的|味|色)$"
FALLBACK_ASKING = r"为什么|怎么|什么|是谁|哪里|可以吗|好不好"
PIECES = r"[，,；;]|以及|还有|和"
EXAMPLES, DEALT = 3, 64


def is_generic(norm: Column) -> Column:
    """C3."""
    return norm.isin(*STOP) | norm.rlike(DIALOGUE) | norm.rlike(ASKING) | norm.rlike(BEGINNING) | norm.rlike(ENDING)


def _normal_forms(texts: Column) -> Column:
    """X1 of every text in an array of arrays."""

    def change(rows: pd.Series) -> pd.Series:
        return pd.Series([[[matching.normal(t) for t in piece] for piece in row] for row in rows], dtype=object)

    return F.pandas_udf(change, "array<array<string>>")(texts)


def candidate_phrases(turns: DataFrame, text_col: str = "text", aliases_col: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row (source_row, phrase, norm and the columns to keep) per phrase of a turn, the first form of each normalised phrase.

    Known aliases are replaced by a comma and the rest is cut into pieces; every piece is mined for itself. A piece without
    a pattern hit falls back to its whole short text. All of it happens inside the row: nothing is shuffled, and Python runs once.
    """
    raw = strip(F.col(text_col))
    if aliases_col:
        longest = F.sort_array(F.transform(aliases_col, lambda a: F.struct((-F.char_length(a)).alias("k"), a.alias("a"))))
        cut = F.aggregate(longest, raw, lambda text, a: F.regexp_replace(text, F.concat(F.lit(r"(?iu)\Q"), a["a"], F.lit(r"\E")), F.lit("，")))
        pieces = F.when(F.size(aliases_col) > 0, F.split(cut, PIECES, -1)).otherwise(F.array(raw))
    else:
        pieces = F.array(raw)
    forms = lambda p: F.concat(F.regexp_extract_all(p, F.lit(TITLE), F.lit(1)), F.regexp_extract_all(p, F.lit(CUE), F.lit(1)))
    mined = lambda p: F.concat(F.transform(forms(p), lambda f: F.regexp_replace(strip(f), TRAILING, "")), F.array(p))
    clean = turns.filter(~raw.rlike(CONTACT_LIKE)).select("source_row", *[c for c in keep if c != "source_row"], F.transform(pieces, strip).alias("_pieces"))
    clean = clean.withColumn("_said", F.transform("_pieces", mined))
    clean = clean.withColumn("_norm", _normal_forms(F.col("_said")))
    pairs = F.zip_with("_said", "_norm", lambda said, norm: F.zip_with(said, norm, lambda s, n: F.struct(s.alias("phrase"), n.alias("norm"))))
    fits = lambda x, most: F.char_length(x["norm"]).between(2, most) & ~is_generic(x["norm"])

    def of_piece(all_forms: Column) -> Column:
        cued = F.filter(F.slice(all_forms, 1, F.size(all_forms) - 1), lambda x: fits(x, 16))
        short = F.filter(F.slice(all_forms, -1, 1), lambda x: fits(x, 12) & ~x["norm"].rlike(FALLBACK_ASKING))
        return F.when(F.size(cued) > 0, cued).otherwise(short)

    found = clean.withColumn("_found", F.flatten(F.transform(pairs, of_piece)))
    norms = F.transform("_found", lambda x: x["norm"])
    first = F.filter("_found", lambda x, k: F.array_position(norms, x["norm"]) == k + 1)
    return found.select(*[c for c in clean.columns if not c.startswith("_")], F.inline(first)).select("source_row", "norm", "phrase", *[c for c in keep if c != "source_row"])


def unknown(found: DataFrame, aliases: list[matching.Alias]) -> DataFrame:
    """Rows whose phrase the dictionary does not match, by one pass of its automaton over the phrase."""
    return found.filter(F.size(matching.hits_of(F.col("phrase"), aliases)) == 0)


def aggregate_candidates(found: DataFrame, *by: str, least_rows: int = 1) -> DataFrame:
    """C6 from rows (norm, phrase, client_id, cid, text): counts, distinct users and sessions, at most three examples in order.

    The rows are written once. Phrases of fewer than ``least_rows`` rows go before users, sessions and examples are built: one that needs so
    many users cannot reach them with fewer rows.
    """
    keys = [*by, "norm"]
    found = saved(found.select(*keys, "client_id", "cid", "phrase", redacted(F.col("text")).alias("example")), "phrases")
    if least_rows > 1:
        frequent = found.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_rows).drop("n")
        found = found.join(frequent, keys, "left_semi")
    pairs = found.groupBy(*keys, "client_id", "cid").agg(F.count(F.lit(1)).alias("n"), F.min("phrase").alias("phrase"))
    users = pairs.groupBy(*keys, "client_id").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("sessions"), F.min("phrase").alias("phrase"))
    out = users.groupBy(*keys).agg(F.min("phrase").alias("phrase"), F.sum("n").alias("query_count"), F.count(F.lit(1)).alias("users"), F.sum("sessions").alias("sessions"))
    return out.join(first_examples(found, keys), keys, "left").withColumn("examples", F.coalesce("examples", F.array().cast("array<string>")))


def first_examples(found: DataFrame, keys: list[str]) -> DataFrame:
    """(*keys, examples): the first distinct redacted texts (``example``); a phrase's texts are dealt by hash and cut in every part, so that EXAMPLES * DEALT at most meet."""
    texts = found.select(*keys, "example").filter("example is not null").distinct()
    order = Window.partitionBy(*keys, "dealt").orderBy("example")
    first = texts.withColumn("dealt", F.pmod(F.xxhash64("example"), F.lit(DEALT))).withColumn("place", F.row_number().over(order)).filter(F.col("place") <= EXAMPLES)
    return first.groupBy(*keys).agg(F.slice(F.array_sort(F.collect_list("example")), 1, EXAMPLES).alias("examples"))


def eligible(stats: DataFrame, baseline: DataFrame | None = None, min_users: int = 5, min_sessions: int = 8, min_growth: float = 3.0, growth_users: int = 3) -> DataFrame:
    """Enough users and sessions, or enough growth against the baseline (norm, average_users)."""
    if baseline is None:
        joined = stats.withColumn("average_users", F.lit(None).cast("double"))
    else:
        joined = stats.join(baseline, "norm", "left")
    joined = joined.withColumn("growth", growth(F.col("users"), F.col("average_users")))
    return joined.filter(((F.col("users") >= min_users) & (F.col("sessions") >= min_sessions)) | ((F.col("users") >= growth_users) & (F.col("growth") >= min_growth)))


def ranked(stats: DataFrame, limit: int = 200) -> DataFrame:
    """W9."""
    return stats.orderBy(F.desc("users"), F.desc("sessions"), F.desc("query_count"), "norm").limit(limit)


def page_after(stats: DataFrame, last: dict | None, limit: int) -> DataFrame:
    """The next ``limit`` rows after the last row of the page before (users, sessions, query_count, norm; None for the first page).

    Rows up to that row are filtered away, so what is sorted is one page of each task; a page does not move if earlier rows are added. Counts and
    norm are never null."""
    if last is not None:
        place = F.struct(-F.col("users"), -F.col("sessions"), -F.col("query_count"), "norm")
        stats = stats.filter(place > F.struct(*[F.lit(-last[c]).cast("long") for c in ("users", "sessions", "query_count")], F.lit(last["norm"])))
    return ranked(stats, limit)


def page(stats: DataFrame, offset: int, limit: int) -> DataFrame:
    """W10 by number; ``page_after`` sorts less."""
    return stats.orderBy(F.desc("users"), F.desc("sessions"), F.desc("query_count"), "norm").offset(offset).limit(limit)


def merge_days(daily: DataFrame) -> DataFrame:
    """Sums of day counts (user_days: users are not told apart across days), first and last day, kept if flagged or frequent."""
    out = daily.groupBy("norm").agg(F.min("phrase").alias("phrase"), F.sum("query_count").alias("query_count"), F.sum("users").alias("user_days"), F.sum("sessions").alias("sessions"),
                                    F.count_distinct("data_date").alias("days"), F.min("data_date").alias("first_date"), F.max("data_date").alias("last_date"), F.bool_or("eligible").alias("any_eligible"))
    return out.filter(F.col("any_eligible") | ((F.col("days") >= 2) & (F.col("user_days") >= 10) & (F.col("sessions") >= 12)))


def push_back(daily: DataFrame, selected: DataFrame, public: int = 10) -> DataFrame:
    """Each day's rows that the batch selected, the first ten of a day, without examples."""
    order = Window.partitionBy("data_date").orderBy(F.desc("users"), F.desc("sessions"), F.desc("query_count"), "norm")
    kept = daily.join(selected.select("norm"), "norm", "left_semi").drop("examples")
    return kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= public)


def with_suggestions(stats: DataFrame, suggestions: DataFrame) -> DataFrame:
    """Suggestion columns or their defaults."""
    out = stats.join(suggestions, "norm", "left")
    return out.withColumns({"degraded": F.col("suggested_type").isNull(), "suggested_type": F.coalesce("suggested_type", F.lit("其他")), "confidence": F.coalesce("confidence", F.lit(0.0))})

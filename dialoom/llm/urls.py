"""URL filters: path rules first, gradient-boosted trees on lexical features for the rest. DataFrame functions only.

The trees learn from the URLs that a rule decides (label 1: block), at most ``max_train`` of them, taken in
hash order. Suffix statistics (how common the last host label is, how often rules block it) cover all rows; common suffixes
are joined by a broadcast of bounded size, the others by shuffle.

Defined results: a null URL or one without ``://`` has an empty host and path, no rule, and is judged by
the trees like any other; without labelled rows of both kinds every row without a rule is allowed; repeated
rows get equal results; very long URLs are read whole; an empty table gives an empty table; extra columns pass
through whatever their name, but for host, path, rule, verdict and block_score, which are replaced.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.llm.common import hub_join, save, table

#: (rule, verdict); a rule is a host and the start of a path.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
MAX_TRAIN = 20_000
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ("f_len", "f_host_len", "f_path_len", "f_depth", "f_labels", "f_digits", "f_hyphens", "f_entropy", "f_params", "f_query_len", "f_suffix_log", "f_suffix_block")


def url_parts(url: Column) -> tuple[Column, Column]:
    host = F.translate(F.regexp_extract(url, PARTS, 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, else null."""
    rule, verdict = None, None
    for text, says in sorted(rules, key=lambda r: -len(r[0])):
        at, slash, rest = text.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(slash + rest)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, says) if verdict is None else verdict.when(fits, says)
    return rule, verdict


def entropy(text: Column) -> Column:
    """Shannon entropy (bits) of the characters: a fold over run lengths of the sorted characters, linear after the sort."""
    start = F.struct(F.lit("").alias("c"), F.lit(0.0).alias("n"), F.lit(0.0).alias("s"))
    gain = lambda n: F.when(n > 1, n * F.log2(n)).otherwise(F.lit(0.0))

    def step(acc, c):
        same = acc["c"] == c
        return F.struct(c.alias("c"), F.when(same, acc["n"] + 1.0).otherwise(F.lit(1.0)).alias("n"), F.when(same, acc["s"]).otherwise(acc["s"] + gain(acc["n"])).alias("s"))

    size = F.char_length(text).cast("double")
    total = F.aggregate(F.array_sort(F.split(text, "")), start, step, lambda acc: acc["s"] + gain(acc["n"]))
    return F.when(size > 0, F.log2(size) - total / size).otherwise(F.lit(0.0))


def count_of(text: Column, chars: str) -> Column:
    return (F.char_length(text) - F.char_length(F.translate(text, chars, ""))).cast("double")


def with_features(pages: DataFrame, url_col: str, rules=RULES) -> DataFrame:
    """The page as a struct (``page``), so that its columns meet none of these, and url, host, path, rule, rule_verdict, suffix and features."""
    df = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("page"), F.col(f"`{url_col}`").alias("url"))
    url = F.coalesce("url", F.lit(""))
    host, path = url_parts(F.col("url"))
    df = df.withColumns({"host": host, "path": path})
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    query = F.substring_index(F.regexp_extract(url, r"(?s)\?(.*)$", 1), "#", 1)
    size = F.greatest(F.char_length(url), F.lit(1))
    return df.withColumns({
        "rule": rule, "rule_verdict": says,
        "suffix": F.substring_index(F.col("host"), ".", -1),
        "f_len": F.char_length(url).cast("double"), "f_host_len": F.char_length("host").cast("double"), "f_path_len": F.char_length("path").cast("double"),
        "f_depth": count_of(F.col("path"), "/"), "f_labels": count_of(F.col("host"), "."), "f_digits": count_of(url, "0123456789") / size,
        "f_hyphens": count_of(url, "-_%"), "f_entropy": entropy(url), "f_params": count_of(query, "="), "f_query_len": F.char_length(query).cast("double"),
    })


def suffix_statistics(df: DataFrame) -> DataFrame:
    """For every suffix: rows, log of the rows and smoothed share of blocked among ruled rows."""
    ruled, blocked = F.count("rule_verdict"), F.count_if(F.col("rule_verdict") == "block")
    stats = df.groupBy("suffix").agg(F.count(F.lit(1)).alias("rows"), ruled.alias("ruled"), blocked.alias("blocked"))
    return stats.select("suffix", "rows", F.log1p("rows").alias("f_suffix_log"), ((F.col("blocked") + 1.0) / (F.col("ruled") + 2.0)).alias("f_suffix_block"))


def url_verdicts(pages: DataFrame, url_col: str = "url", rules=RULES, max_train: int = MAX_TRAIN, seed: int = 7) -> DataFrame:
    """Add host, path, rule and verdict to every row."""
    df = with_features(pages, url_col, rules)
    df = hub_join(df, save(suffix_statistics(df), "suffixes"), "suffix", "rows", pages.count())
    ruled = df.filter("rule is not null").select(*FEATURES, (F.col("rule_verdict") == "block").cast("double").alias("label"), F.xxhash64("url", F.lit(seed)).alias("draw"))
    train = ruled.orderBy("draw", *FEATURES).limit(max_train).drop("draw").persist()
    kinds = train.groupBy("label").count().count()
    kept = [F.col("page")[c].alias(c) for c in pages.columns if c not in ("host", "path", "rule", "verdict", "block_score")]
    if kinds < 2:
        train.unpersist()
        return df.select(*kept, "host", "path", "rule", F.coalesce("rule_verdict", F.lit("allow")).alias("verdict"), F.lit(None).cast("double").alias("block_score"))
    pack = VectorAssembler(inputCols=list(FEATURES), outputCol="lexical")
    trees = GBTClassifier(featuresCol="lexical", labelCol="label", maxIter=12, maxDepth=4, stepSize=0.3, seed=seed, predictionCol="url_class")
    trees = trees.setRawPredictionCol("url_raw").setProbabilityCol("url_probability")
    model = trees.fit(pack.transform(train))
    train.unpersist()
    scored = model.transform(pack.transform(df))
    block = vector_to_array("url_probability")[1]
    verdict = F.coalesce("rule_verdict", F.when(block >= 0.5, "block").otherwise("allow"))
    return scored.select(*kept, "host", "path", "rule", verdict.alias("verdict"), block.alias("block_score"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = url_verdicts(table(spark, sf_dir, "pages").select("page_id", "url"))
    return out.select("page_id", "host", "path", "rule", "verdict")

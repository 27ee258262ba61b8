"""Odd documents that every operator has to take."""

from pyspark.sql import functions as F

LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog " * 8, "en", "a"), (2, "the quick brown fox jumps over the lazy dog " * 8, "en", "a"), (3, None, "en", "a"), (4, "", None, None), (5, LONG, "en", "b"),
    (6, " \n\t ", "de", "b"), (7, "one two", "de", None), (7, "one two", "de", None), (None, "a null id with some words", "fr", "c"), (9, "ünïcode “quotes” 日本語 text\u00a0here 😀 " * 9, "fr", "c"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
#: Column names that operators use inside.
CLASHES = ["size", "host", "score", "n_words", "rows", "label", "set_key", "hits", "word", "n", "key", "part", "prediction", "features", "bucket", "rid", "weight", "lexical", "url_raw", "url_probability", "url_class", "f_len", "suffix", "rule_verdict", "page", "tree_host", "tree_keys", "page_host", "near_id", "near_key", "found_id", "mix_rate", "mix_words", "target", "kept", "tolerance", "other_columns", "html_text"]


def odd(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in CLASHES})


def empty(spark):
    return spark.createDataFrame([], SCHEMA)

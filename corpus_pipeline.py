"""The corpus pipeline: documents in, token blocks out.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a DataFrame that is
written as Parquet and read again as the next stage's docs. All but the last return the columns of documents.

Further columns pass through with the values of the input, whatever they are called; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.llm.common import packed, save, table, unpacked, word_count
from dialoom.llm.decontaminate import contaminated
from dialoom.llm.jaccard import deduplicate
from dialoom.llm.mixing import emit, mix
from dialoom.llm.quality import host_rules
from dialoom.llm.tokens import token_boundaries


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and their host's verdict keep; null and empty texts go, repeated rows are judged alike, a null source is a host of its own."""
    return unpacked(host_rules(packed(docs, "doc_id", "text", "source")).filter("kept"), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates; texts without words are classes of their own, rows with a null id stay, of repeated rows one stays."""
    return deduplicate(docs).select([F.col(f"`{c}`") for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; null and empty texts hold none, rows with a null id stay."""
    found = save(contaminated(docs, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("found_id")).distinct(), "contaminated")
    return docs.join(found, docs["doc_id"] == found["found_id"], "left_anti")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's rate says (0 to 3 times); without words a source has rate 0, a null source is a source of its own."""
    rows = packed(docs, "doc_id", "text", "source")
    return unpacked(emit(mix(rows.withColumn("mix_words", word_count(F.col("text"))), size_col="mix_words")), docs.columns)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each document of the token files, in ascending order of doc_id (null first); a null text is the end id alone."""
    return token_boundaries(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("token_output", token_output),
]

#: Shingle sets, components and token ids have no SQL form here; tests/llm holds the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = save(docs, name)
    return docs

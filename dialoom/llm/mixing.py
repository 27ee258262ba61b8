"""Mixing sources to target weights.

Every source gets a share of the budget by weight; a source may give at most ``max_rate`` times its
own size and what it cannot give is shared again by weight. The repetition rate of a source is
target / size: a document is emitted floor(rate) times, plus once more if a number drawn from a seeded
hash of its id is below the fraction.

Defined results: a null source is a source of its own and the last in order; documents without words
have size 0 and never change a target; a source of size 0 has target 0 and its documents are emitted
``0`` times; rows that repeat an id draw the same number; a null id draws as the text 'null'; an empty
table gives an empty table. Extra columns pass through, but for those with the name of a result or beginning
with ``mix_``, which are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dialoom.llm.common import save, table, unit_hash, word_count

WEIGHTS = (5, 2, 1)
MAX_RATE = 3
SEED = "mix-1"


def source_targets(totals: DataFrame, weights=WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """(mix_source, source_size) to the same with ``weight`` and ``target``; the budget is the sum of all sizes.

    With sources in order of cap / weight, the full ones are a prefix; the level of the rest is the
    budget they leave over the weights left. Taken at each place in the order, the level rises up to the
    first source that is not full and falls after it, so the level is the largest. The windows run over one
    row per source, not per document.
    """
    pos = F.row_number().over(Window.orderBy(F.col("mix_source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    caps = totals.withColumn("weight", F.get(cycle, F.pmod(pos, F.lit(len(weights))))).withColumn("cap", F.col("source_size") * max_rate)
    by_fill = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("mix_source").asc_nulls_last())
    everything = by_fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.sum("cap").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing))
    level = caps.withColumn("level", (F.sum("source_size").over(everything) - before) / after)
    target = F.least(F.col("cap").cast("double"), F.max("level").over(everything) * F.col("weight"))
    return level.select("mix_source", "source_size", "weight", target.alias("target"))


def mix(docs: DataFrame, size_col: str = "size", source_col: str = "source", id_col: str = "doc_id", weights=WEIGHTS, max_rate: int = MAX_RATE, seed: str = SEED) -> DataFrame:
    """Add source_size, target and mix_copies (how often the mix emits the row).

    One aggregation to a row per source; the small result is written and joined back, so Spark
    broadcasts it only if its file is below the broadcast threshold and else splits the hot source (AQE).
    """
    docs = docs.drop(*[c for c in ("source_size", "target", "mix_source", "mix_size", "mix_target", "mix_rate", "mix_copies") if c not in (size_col, source_col, id_col)])
    totals = docs.groupBy(F.col(source_col).alias("mix_source")).agg(F.sum(size_col).alias("source_size"))
    targets = save(source_targets(totals, weights, max_rate).select("mix_source", F.col("source_size").alias("mix_size"), F.col("target").alias("mix_target")), "targets")
    rate = F.when(F.col("mix_size") > 0, F.col("mix_target") / F.col("mix_size")).otherwise(F.lit(0.0))
    joined = docs.join(targets, F.col(source_col).eqNullSafe(F.col("mix_source")), "left").withColumn("mix_rate", rate)
    extra = (unit_hash(seed, F.col(id_col)) < F.col("mix_rate") - F.floor("mix_rate")).cast("long")
    out = joined.withColumn("mix_copies", F.floor("mix_rate") + extra)
    return out.withColumnsRenamed({"mix_size": "source_size", "mix_target": "target"}).drop("mix_source", "mix_rate")


def emit(mixed: DataFrame, copies_col: str = "mix_copies") -> DataFrame:
    """Each row as often as its copies say."""
    copies = F.explode(F.array_repeat(F.lit(0), F.col(copies_col).cast("int")))
    return mixed.withColumn("mix_copy", copies).drop("mix_copy", copies_col)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = save(table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    mixed = mix(sizes)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("mix_copies") * F.col("size")).alias("taken"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
t AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, source_size * 3 AS cap FROM t),
l AS (SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
        / CAST(sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS lev FROM w),
g AS (SELECT *, least(CAST(cap AS DOUBLE), max(lev) OVER () * weight) AS target FROM l),
r AS (SELECT d.doc_id, d.size, g.source_size, g.target, CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0 END AS rate,
        CAST(CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS u
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, CAST((floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) * size AS BIGINT) AS taken FROM r
"""

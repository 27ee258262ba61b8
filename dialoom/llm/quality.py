"""Quality rules with host verdicts.

A document is measured by word and line rules. Failures are counted by host (the source column of
``documents``), host rates are shrunk with a beta prior fitted to all hosts by the method of moments,
and the verdict of the host is joined back:

* ``reject``: the shrunk failure rate is over ``max_rate``; every document of the host goes,
* ``normal``: documents that fail a soft rule (symbols, repeated lines) go,
* ``trusted``: the shrunk rate is below ``trust_rate``; one soft failure is forgiven.

Defined results: null and empty texts have no words and fail the length rule; a null host is a host of
its own; equal rows get equal results; an empty table gives an empty table; extra columns pass through, but for those with the name of a result,
which is replaced.
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.llm.common import save, table

MIN_WORDS = 50
MAX_RATE = 0.5
TRUST_RATE = 0.02
MEASURES = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"
SYMBOLS = b"#*$%&|<>"


def measure(text: str | None) -> tuple[int, int, int, int, int, int]:
    """The six counts of one whole text; bytes.split() splits at exactly the white space of the word class."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    chars = len(text) - sum(map(raw.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [line for line in text.split("\n") if line.encode("utf-8", "surrogatepass").split()]
    repeats = 0
    if n > 3:
        counts = Counter(zip(words, words[1:], words[2:], strict=False))
        if len(counts) < n - 2:
            end = 0  # first word that no repeated window has covered yet
            for i, window in enumerate(zip(words, words[1:], words[2:], strict=False)):
                if counts[window] > 1:
                    repeats += i + 3 - max(end, i)
                    end = i + 3
    return n, chars, symbols, len(lines), len(lines) - len(set(lines)), repeats


def _measures(texts: pd.Series) -> pd.DataFrame:
    names = [part.split()[0] for part in MEASURES.split(", ")]
    return pd.DataFrame([measure(t) for t in texts], columns=names, dtype="int64")


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add the counts, base_failed and soft_failures."""
    out = docs.withColumn("quality_measures", F.pandas_udf(_measures, MEASURES)(F.col(text_col)))
    out = out.select(*[F.col(f"`{c}`") for c in docs.columns if c not in {part.split()[0] for part in MEASURES.split(", ")}], "quality_measures.*")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    soft = (5 * F.col("n_symbols") > F.col("n_words")).cast("int") + (2 * F.col("n_dup_lines") > F.col("n_lines")).cast("int")
    return out.withColumns({"base_failed": failed, "soft_failures": soft})


def host_verdicts(docs: DataFrame, host_col: str = "source", max_rate: float = MAX_RATE, trust_rate: float = TRUST_RATE) -> DataFrame:
    """One row per host: n_host, host_failures, host_rate (shrunk) and tolerated soft failures (-1: none kept).

    The prior needs four sums over hosts; only that one row comes to the driver.
    """
    bad = (F.col("base_failed") | (F.col("soft_failures") > 0)).cast("long")
    hosts = docs.groupBy(F.col(host_col).alias("rule_host")).agg(F.count(F.lit(1)).alias("n_host"), F.sum(bad).alias("host_failures"))
    hosts = save(hosts, "hosts")
    p = F.col("host_failures") / F.col("n_host")
    row = hosts.agg(F.avg(p).alias("m"), F.var_pop(p).alias("v"), F.avg(1 / F.col("n_host")).alias("i")).first()
    a, b = beta_prior(row["m"], row["v"], row["i"])
    rate = (F.col("host_failures") + a) / (F.col("n_host") + a + b)
    return hosts.select("rule_host", "n_host", "host_failures", rate.alias("host_rate"), F.when(rate > max_rate, -1).when(rate < trust_rate, 1).otherwise(0).alias("tolerance"))


def beta_prior(mean: float | None, var: float | None, inverse_n: float | None) -> tuple[float, float]:
    """Moments of host rates, less their binomial noise, to the beta prior; no hosts or no spread gives a wide or tight default."""
    if mean is None:
        return 1.0, 1.0
    mean = min(max(mean, 1e-3), 1 - 1e-3)
    spread = max(var - mean * (1 - mean) * inverse_n, mean * (1 - mean) / 1001)
    strength = max(mean * (1 - mean) / spread - 1, 1.0)
    return mean * strength, (1 - mean) * strength


def host_rules(docs: DataFrame, text_col: str = "text", host_col: str = "source", keep_text: bool = True, max_rate: float = MAX_RATE, trust_rate: float = TRUST_RATE) -> DataFrame:
    """Every document with its counts, its host's figures and ``kept``.

    Texts are read once: the measured table is written and both the host aggregation (three narrow
    columns) and the join read it. Host rows are joined by size: broadcast if the file is small, else AQE splits hot hosts.
    """
    scored = measured(docs, text_col)
    scored = save(scored if keep_text else scored.drop(text_col), "measured")
    hosts = host_verdicts(scored, host_col, max_rate, trust_rate)
    out = scored.drop(*[c for c in hosts.columns if c != host_col]).join(save(hosts, "verdicts"), F.col(host_col).eqNullSafe(F.col("rule_host")), "left").drop("rule_host")
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("soft_failures") <= F.col("tolerance")))


def op2_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = host_rules(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), keep_text=False)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM d WHERE len(w) > 2),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i+1], w[i+2]) AS c FROM p),
r AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM g WHERE c > 1) GROUP BY doc_id),
l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
m AS (SELECT d.doc_id, d.source, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
   length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
   len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
   FROM d JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
   CASE WHEN 5 * n_symbols > n_words THEN 1 ELSE 0 END + CASE WHEN 2 * n_dup_lines > n_lines THEN 1 ELSE 0 END AS soft FROM m),
h AS (SELECT source, count(*) AS n, sum(CASE WHEN base_failed OR soft > 0 THEN 1 ELSE 0 END) AS k FROM f GROUP BY source),
b AS (SELECT least(greatest(avg(k / n), 1e-3), 1 - 1e-3) AS mu, var_pop(k / n) AS v, avg(1 / n) AS i FROM h),
s AS (SELECT mu, greatest(mu * (1 - mu) / greatest(v - mu * (1 - mu) * i, mu * (1 - mu) / 1001) - 1, 1.0) AS s FROM b),
t AS (SELECT h.source, (k + mu * s) / (n + s) AS rate FROM h, s)
SELECT f.doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
   CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
   NOT base_failed AND soft <= CASE WHEN rate > 0.5 THEN -1 WHEN rate < 0.02 THEN 1 ELSE 0 END AS kept
FROM f JOIN t ON f.source IS NOT DISTINCT FROM t.source
"""

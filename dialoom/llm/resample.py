"""Target-distribution importance resampling over hashed word runs.

The weight of a document is the sum of gains of its features, one gain for each hash bucket: how much likelier the bucket is in
the target than in the corpus. Weights are looked up in an array of ``BUCKETS`` gains (the only thing that goes through the
driver, of fixed size). A Gumbel number from the hashed id makes the score, so the highest scores are a sample without replacement.

The draw needs no sort of the corpus: the scored rows are written, and exact count jobs over the score narrow an interval until it is one value, the
cutoff (``CUTS`` intervals a job), then in the same way the smallest sufficient doc_id among rows at the cutoff. Only drawn rows are range-partitioned, and a rank
is the offset of its range plus the place in it.

Defined results: null and empty texts have no features and weight 0; a null id counts as smaller than all others and is hashed as
``null``; rows that repeat an id are scored each by its own text, and ties of score and id go by the number of features, then at random; too small
a table draws nothing, an empty one gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.llm.common import save, table

BUCKETS = 10_000
#: Fixed values of the contract: words, least words of a drawn document, share drawn in percent, seed of the scores.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LEAST_WORDS, PERCENT, SEED = 20, 10, "2024"
#: Intervals that one count job tells apart.
CUTS = 64
LEAST, MOST = -(1 << 63), (1 << 63) - 1
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def features(text: Column, longest: int = 1) -> Column:
    """All runs of 1 to ``longest`` words, joined by a space, repeats included; an empty array for a null text."""
    words = F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))
    if longest == 1:
        return words

    def runs(n: int) -> Column:
        starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))

    return F.concat(words, *map(runs, range(2, longest + 1)))


def bucket_of(feature: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.crc32(feature.cast("binary")), F.lit(buckets)).cast("int")


def bucket_counts(docs: DataFrame, text_col: str = "text", longest: int = 1, buckets: int = BUCKETS) -> dict[int, int]:
    """Features of all rows by bucket: ``buckets`` numbers, counted in the tasks before they are shuffled."""
    found = docs.select(F.explode(features(F.col(f"`{text_col}`"), longest)).alias("feature")).groupBy(bucket_of(F.col("feature"), buckets).alias("bucket")).count()
    return {r["bucket"]: r["count"] for r in found.collect()}


def gains(corpus: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    s, t = float(sum(corpus.values()) + buckets), float(sum(target.values()) + buckets)
    return [math.floor(1000 * math.log((target.get(b, 0) + 1) * s / ((corpus.get(b, 0) + 1) * t))) for b in range(buckets)]


def scored(docs: DataFrame, gained: list[int], seed: str = SEED, longest: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight and score; the gains are one constant array of the plan."""
    by_bucket = F.split(F.lit(",".join(map(str, gained))), ",").cast("array<bigint>")
    gain = lambda w: F.element_at(by_bucket, bucket_of(w, len(gained)) + 1)
    doc_id = F.col(f"`{id_col}`").cast("long")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")
    text = F.col(f"`{text_col}`")
    words = docs.select(doc_id.alias("doc_id"), noise.alias("noise"), features(text, longest).alias("found"), *([] if longest == 1 else [F.size(features(text)).alias("n_words")]))
    weight = F.aggregate("found", F.lit(0).cast("long"), lambda a, w: a + gain(w))
    n_words = F.size("found") if longest == 1 else F.col("n_words")
    return words.select("doc_id", n_words.cast("long").alias("n_words"), F.size("found").cast("long").alias("n_features"), weight.alias("weight"), (weight + F.col("noise")).alias("score"))


def smallest_with(rows: DataFrame, value: Column, wanted: int) -> int:
    """The smallest x such that at least ``wanted`` rows (1 or more) have a value of at most x, by exact count jobs over shrinking intervals."""
    low, high = rows.agg(F.min(value), F.max(value)).first()
    below = 0
    while low < high:
        step = -(-(high - low + 1) // CUTS)
        cuts = [min(low + step * k, high) for k in range(1, CUTS)]
        cuts = sorted({c - 1 for c in cuts if c > low})
        counted = rows.filter(value <= F.lit(cuts[-1])).agg(*[F.count_if((value >= F.lit(low)) & (value <= F.lit(c))).alias(f"c{k}") for k, c in enumerate(cuts)]).first()
        passed = 0
        for c, n in zip(cuts, counted, strict=True):
            if below + n >= wanted:
                high = c
                break
            low, passed = c + 1, n
        below += passed
    return low


def draw(rows: DataFrame, wanted: int) -> DataFrame:
    """The written rows (doc_id, n_words, n_features, weight, score, eligible, at) with ``rank`` 1, 2, 3 ... for the ``wanted`` highest scores among eligible rows."""
    ranked = F.lit(None).cast("long")
    if not wanted:
        return rows.withColumn("rank", ranked)
    able = rows.filter("eligible")
    cutoff = -smallest_with(able, -F.col("score"), wanted)
    left = wanted - able.filter(F.col("score") > cutoff).count()
    key = F.coalesce("doc_id", F.lit(LEAST))
    last = smallest_with(able.filter(F.col("score") == cutoff), key, left)
    inside = F.col("eligible") & ((F.col("score") > cutoff) | ((F.col("score") == cutoff) & (key <= last)))
    # rows that repeat score and id are dealt to several ranges by their number in the table
    order = [F.desc("score"), F.asc("doc_id"), F.asc("n_features"), F.asc("at")]
    dealt = save(rows.filter(inside).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()), "drawn")
    part, place = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = {r["part"]: r["n"] for r in dealt.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row for each range
    before, starts = 0, {}
    for p in sorted(sizes):
        starts[p], before = before, before + sizes[p]
    offset = F.element_at(F.from_json(F.lit("{" + ",".join(f'"{p}":{n}' for p, n in starts.items()) + "}"), "map<string,bigint>"), part.cast("string"))
    rank = offset + place + 1
    drawn = dealt.withColumn("rank", F.when(rank <= wanted, rank)).drop("place")
    return drawn.unionByName(rows.filter(~inside).withColumn("rank", ranked))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, longest: int = 1, buckets: int = BUCKETS, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score and rank (null if not drawn), one row for each row."""
    gained = gains(bucket_counts(docs, text_col, longest, buckets), bucket_counts(target, target_col, longest, buckets), buckets)
    rows = scored(docs, gained, seed, longest, id_col, text_col).withColumns({"eligible": F.col("n_words") >= least_words, "at": F.monotonically_increasing_id()})
    rows = save(rows, "scored")
    wanted = percent * rows.filter("eligible").count() // 100
    return draw(rows, wanted).select("doc_id", "n_features", "weight", "score", "rank")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("text"))


#: CRC-32 is spelled out over the bytes of each distinct word.
ORACLE = r"""
WITH crc AS (SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, CAST(b AS BIGINT))) AS t),
found AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
aimed AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
each AS (SELECT doc_id, unnest(words) AS w FROM found),
bytes AS (SELECT w, list_transform(range(length(hex(encode(w))) // 2), lambda i: CAST('0x' || substr(hex(encode(w)), 2 * i + 1, 2) AS BIGINT)) AS b FROM (SELECT w FROM each UNION SELECT w FROM aimed)),
hashed AS (SELECT w, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)]), CAST(4294967295 AS BIGINT)), 4294967295) % 10000 AS bucket FROM bytes, crc),
s AS (SELECT bucket, count(*) AS n FROM each JOIN hashed USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM aimed JOIN hashed USING (w) GROUP BY bucket),
gain AS (SELECT s.bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT sum(n) FROM s) + 10000)::DOUBLE / ((s.n + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE))) AS BIGINT) AS g FROM s LEFT JOIN t USING (bucket)),
weights AS (SELECT doc_id, sum(g) AS weight FROM each JOIN hashed USING (w) JOIN gain USING (bucket) GROUP BY doc_id),
noisy AS (SELECT f.doc_id, CAST(len(words) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || f.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS noise FROM found f LEFT JOIN weights USING (doc_id)),
scores AS (SELECT doc_id, n_features, weight, weight + noise AS score FROM noisy),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r FROM scores WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= (SELECT 10 * count(*) // 100 FROM scores WHERE n_features >= 20) THEN r END AS rank FROM scores LEFT JOIN ranked USING (doc_id)
"""

"""Partitioned tables by product and date that can be written again safely."""

from __future__ import annotations

import hashlib
import inspect
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from dialoom.functions.text import day_key
from dialoom.operators import periods

DAY = ("product", "data_date")
PRIVATE = ("source_row", "client_id", "cid", "created_at", "turn_index", "text", "ai_text", "route", "topic", "behavior", "entity_names", "signal")
SAFE = ("source_row", "user_key", "session_key", "turn_index", "route", "topic", "behavior", "entity_ids", "signal", "signals", "polarities", "bases")


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None if it was never written."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def replace_days(df: DataFrame, path: str, by: tuple[str, ...] = DAY) -> None:
    """S9 to S11 (days are few, so they may be listed): write the partitions that the rows have; others stay. Rows of a day are replaced, never added."""
    df.repartition(*[F.col(c) for c in by], F.pmod(F.xxhash64(*[c for c in df.columns if c not in by]), F.lit(16))).write.partitionBy(*by).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def replace_if_changed(df: DataFrame, path: str, by: tuple[str, ...] = DAY) -> bool:
    """No write if the stored days equal the new ones."""
    old = stored(df.sparkSession, path)
    if old is not None and periods.same_rows(old.join(F.broadcast(df.select(*by).distinct()), list(by), "left_semi").select(*df.columns), df):
        return False
    replace_days(df, path, by)
    return True


def pointers(spark: SparkSession, path: str) -> DataFrame | None:
    """The version that each day of a published table shows, with the digest of its rows; one row for each day, None if nothing was published."""
    every = stored(spark, f"{path}/pointers")
    return None if every is None else every.groupBy(*DAY).agg(F.max_by(F.struct("version", "hash_sum", "rows"), "version").alias("last")).select(*DAY, "last.*")


def published(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of a published table: of each day those of the version that its pointer names; null days are days too.

    Versions are folders, so those that no pointer names are not read: the list of the versions in use (at most one for each day) picks the folders."""
    now = pointers(spark, path)
    if now is None:
        return None
    used = [r["version"] for r in now.filter("rows > 0").select("version").distinct().collect()]
    folders = [f"{path}/versions/v{n:08d}" for n in sorted(used)] or [f"{path}/versions/*"]
    rows = spark.read.option("basePath", f"{path}/versions").parquet(*folders) if used else spark.read.parquet(*folders).limit(0).withColumn("version", F.lit(0))
    named = now.select("version", *[F.col(c).alias(f"day_{c}") for c in DAY])
    same = F.col("in_version") == F.col("version")
    for c in DAY:
        same &= F.col(c).eqNullSafe(F.col(f"day_{c}"))
    return rows.withColumnRenamed("version", "in_version").join(F.broadcast(named), same, "left_semi").drop("in_version")  # one row for each day


def publish_days(df: DataFrame, path: str, days: DataFrame | None = None, audits: Callable[[DataFrame], list[DataFrame]] | None = None) -> int | None:
    """Write, audit, then publish. The days' rows are written as a version of their own and read back, the audits run on what was
    written, and only then one committed file of pointers makes all days show them at once. A run that is killed before leaves the old days as they are;
    its version is never read, and the next run writes over it.

    ``days`` (product, data_date) are the days the run covers; one of them without rows is empty afterwards. Days whose digest is that of the stored
    rows get no new pointer. Gives the version, or None if no day changed. One run at a time may publish to a path."""
    spark, old = df.sparkSession, pointers(df.sparkSession, path)
    version = 1 if old is None else old.agg(F.max("version")).first()[0] + 1
    folder = f"{path}/versions/v{version:08d}"
    deal = F.pmod(F.xxhash64(*[c for c in df.columns if c not in DAY]), F.lit(16))
    df.withColumn("version", F.lit(version)).repartition(*[F.col(c) for c in DAY], deal).write.mode("overwrite").parquet(folder)
    written = spark.read.parquet(folder).drop("version")
    if audits is not None and any(not a.isEmpty() for a in audits(written)):
        raise ValueError("an audit has violations; nothing was published")
    new = periods.table_digest(written.select(*sorted(written.columns)), *DAY)
    if days is not None:
        own = F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in DAY])
        empty = days.select(*DAY).distinct().withColumn("own", own).join(new.select(own.alias("own")), "own", "left_anti").drop("own")
        new = new.unionByName(empty.withColumns({"hash_sum": F.lit(0).cast("decimal(38,0)"), "rows": F.lit(0).cast("long")}))
    if old is not None:
        key = [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in (*DAY, "hash_sum", "rows")]
        new = new.alias("n").join(old.alias("o"), key, "left_anti")
    new = new.select(*DAY, F.lit(version).alias("version"), F.col("hash_sum").cast("decimal(38,0)").alias("hash_sum"), F.col("rows").cast("long").alias("rows")).coalesce(1).persist()  # one row for each day
    try:
        if new.isEmpty():
            return None
        new.write.mode("append").parquet(f"{path}/pointers")
        return version
    finally:
        new.unpersist()


def backup_days(spark: SparkSession, path: str, days: DataFrame, target: str) -> None:
    """Copy the partitions that are about to be replaced."""
    old = stored(spark, path)
    if old is not None:
        old.join(F.broadcast(days.select(*DAY).distinct()), list(DAY), "left_semi").write.partitionBy(*DAY).mode("errorifexists").parquet(target)


def safe_turns(classified: DataFrame, source: str) -> DataFrame:
    """The pseudonymised turn table."""
    pick = lambda f: F.transform("entities", lambda e: e[f])
    keyed = classified.withColumns({"user_key": day_key("user", F.col("client_id"), F.lit(source)), "session_key": day_key("session", F.col("cid"), F.lit(source)), "entity_ids": pick("entity_id"), "signals": pick("signal"), "polarities": pick("polarity"), "bases": pick("basis")})
    return keyed.select(*[c for c in DAY if c in classified.columns], *SAFE)


def write_turns(classified: DataFrame, source: str, safe_path: str, private_path: str) -> None:
    """Both turn tables from one persisted frame."""
    held = classified.persist()
    replace_days(safe_turns(held, source), safe_path)
    replace_days(private_turns(held), private_path)
    held.unpersist()


def private_turns(classified: DataFrame) -> DataFrame:
    """The turn table with raw ids and texts: the private columns and nothing else."""
    named = classified.withColumn("entity_names", F.array_join(F.transform("entities", lambda e: e["entity_id"]), "|"))
    return named.select(*[c for c in (*DAY, *PRIVATE) if c in named.columns])


def report_tables(rollups: DataFrame, entities: DataFrame, dictionary: DataFrame, candidates: DataFrame, topics: DataFrame, behaviors: DataFrame, routes: DataFrame, aliases: DataFrame) -> dict[str, DataFrame]:
    """The eight report tables: ranked rollups, public and restricted entities, candidates, topics, behaviours, routes, dictionary.

    Ranks run over one row for each rollup, entity or kept candidate.
    """
    by = lambda *columns: F.row_number().over(Window.orderBy(*columns))
    users = [F.desc("active_users"), F.desc("mention_users"), F.desc("queries")]
    named = entities.join(dictionary.select("entity_id", "name", "type", "visibility"), "entity_id")
    listed = lambda kind: named.filter(F.col("visibility") == kind).drop("visibility").withColumn("rank", by(*users, F.col("entity_id")))
    counted = lambda df: df.withColumn("rank", by(F.desc("rows"), F.col(df.columns[0])))
    rules = aliases.groupBy("entity_id").agg(F.array_sort(F.collect_set("value")).alias("aliases"))
    return {
        "rollups": rollups.withColumn("rank", by(*users, F.col("rollup_id"))), "entities": listed("public"), "restricted": listed("restricted"),
        "candidates": candidates.withColumn("rank", by(F.desc("users"), F.desc("sessions"), F.desc("query_count"), F.col("norm"))).filter("rank <= 200"),
        "topics": counted(topics), "behaviors": counted(behaviors), "routes": counted(routes), "dictionary": dictionary.join(rules, "entity_id", "left"),
    }


def write_reports(tables: dict[str, DataFrame], folder: str) -> None:
    """One table per report list."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def load_documents(spark: SparkSession, docs: DataFrame, path: str, audits: list[DataFrame]) -> None:
    """Store ready daily rows after their audits passed."""
    if any(not a.isEmpty() for a in audits):
        raise ValueError("an audit has violations; nothing was stored")
    replace_days(docs, path)


def changed_days(current: DataFrame, done: DataFrame | None) -> DataFrame:
    """Days whose input digest is not among the finished ones."""
    return current if done is None else current.join(done, [*DAY, *[c for c in ("hash_sum", "rows", "code") if c in current.columns]], "left_anti")


def with_code(digests: DataFrame, *modules: object) -> DataFrame:
    """Digests with the identity of the code that computes the result (a digest of the modules' sources)."""
    code = hashlib.sha256("".join(inspect.getsource(m) for m in modules).encode()).hexdigest()
    return digests.withColumn("code", F.lit(code))


def run_days(current: DataFrame, done: DataFrame | None, last: str, days: int = 7) -> tuple[DataFrame, DataFrame]:
    """Days to compute, and the days of the window up to ``last`` whose growth is computed anew in any case."""
    end = F.lit(last).cast("date")
    return changed_days(current, done), current.filter(F.col("data_date").between(F.date_sub(end, days - 1), end))


def backfill(rows: DataFrame, last: str, days: int = 8) -> DataFrame:
    """The rows of the days that a dictionary change reaches."""
    end = F.lit(last).cast("date")
    return rows.filter(F.col("data_date").between(F.date_sub(end, days - 1), end))


def carry_reviews(recomputed: DataFrame, reviews: DataFrame, digests: DataFrame) -> DataFrame:
    """Recomputed rows with the untouched reviews whose source digest still holds."""
    valid = reviews.join(digests, [*DAY, "digest"], "left_semi")
    return recomputed.join(valid, list(DAY), "left")

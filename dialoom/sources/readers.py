"""Landing of turn exports, dictionaries, region maps and daily tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialoom.functions.text import normalize_text, strip
from dialoom.sources import records

TURN_COLUMNS = ("source_row", "clientId", "cid", "sceneId", "text", "ai_text", "turn_index", "is_template", "is_invalid_turn", "invalid_reason", "profile_age", "age_status", "profile_gender", "gender_status", "city_normalized", "city_status")


def turn_csv(spark: SparkSession, path: str, columns: tuple[str, ...] = TURN_COLUMNS, extra: tuple[str, ...] = ("created_at",)) -> DataFrame:
    """The turn export, every field a string as in the file (a missing field is ''), typed columns beside: UTF-8 with BOM, quoted text over lines.

    A file is read by many tasks (``records``), so the largest upload needs no task for itself.
    """
    raw = records.table(spark, path, ",")
    missing = sorted(set(columns) - set(raw.columns))
    if missing:
        raise ValueError(f"columns missing: {missing}")
    df = raw.select(*[F.coalesce(c, F.lit("")).alias(c) for c in [*columns, *[c for c in extra if c in raw.columns]]])
    return df.withColumns({"source_row": F.col("source_row").try_cast("long"), "turn_index": F.col("turn_index").try_cast("int"), "client_id": F.col("clientId")})


def header_separator(spark: SparkSession, path: str) -> str:
    """A tab if the header has one, else a comma."""
    first = spark.read.text(path).limit(1).collect()
    return "\t" if first and "\t" in first[0][0] else ","


def raw_export(spark: SparkSession, path: str) -> DataFrame:
    """The raw export by sniffed separator, with ``source_row``, the record's number in its file, the header being 1; read by many tasks."""
    df = records.table(spark, path)
    return df.select(*[c for c in df.columns if c not in ("record_number", "source_row")], F.col("record_number").alias("source_row"))


def ragged_lines(spark: SparkSession, path: str) -> DataFrame:
    """S3: tab lines with more or fewer cells than the header: created_at is the last cell; (line, n_cells, created_at, is_ragged)."""
    lines = spark.read.text(path).withColumn("cells", F.split("value", "\t", -1))
    header = lines.limit(1).select(F.size("cells").alias("width"), F.col("value").alias("header"))
    joined = lines.join(F.broadcast(header)).filter(F.col("value") != F.col("header"))
    at = F.when(F.size("cells") == F.col("width"), F.get("cells", F.array_position(F.split("header", "\t"), "created_at").cast("int") - 1)).otherwise(F.element_at("cells", -1))
    return joined.select(F.col("value").alias("line"), F.size("cells").alias("n_cells"), at.alias("created_at"), (F.size("cells") != F.col("width")).alias("is_ragged"))


def date_contract(spark: SparkSession, path: str, date: str, scene: str) -> DataFrame:
    """S3: (line, rule, value) of lines that break the contract of a day's export: cells that do not fit the header (tab lines may be ragged,
    comma lines must match), a created_at without a date or of another day, another scene. An export without rows is one violation."""
    head = spark.read.text(path).limit(1).collect()
    header = head[0][0].lstrip("\ufeff") if head else ""
    tabs = header.count("\t") > header.count(",")
    names = [c.strip('"') for c in header.split("\t" if tabs else ",")]
    missing = sorted({"created_at", "sceneId"} - set(names))
    if missing:
        raise ValueError(f"columns missing: {missing}")
    lines = spark.read.text(path).filter(F.ltrim(F.regexp_replace("value", "^\ufeff", "")) != header)
    rows = lines.withColumn("cells", F.split("value" if tabs else F.regexp_replace("value", r'"(?:[^"]|"")*"', ""), "\t" if tabs else ",", -1))
    fits = F.size("cells") == len(names)
    at, where = names.index("created_at"), names.index("sceneId")
    plain = F.from_csv(F.col("value"), ", ".join(f"c{k} string" for k in range(len(names))), {"escape": '"'}) if not tabs else None
    created = F.when(fits, F.get("cells", F.lit(at)) if tabs else plain[f"c{at}"]).otherwise(F.element_at("cells", -1))
    said = F.get("cells", F.lit(where)) if tabs else plain[f"c{where}"]
    day = F.try_to_date(F.substring(strip(created), 1, 10), "yyyy-MM-dd")
    broken = ~fits if not tabs else ~fits & (F.size("cells") <= where)
    rule = F.when(broken, "cells").when(day.isNull(), "created_at").when(day != F.lit(date).cast("date"), "date").when(strip(said) != scene, "scene")
    value = F.when(broken, F.size("cells").cast("string")).when(rule == "scene", said).otherwise(created)
    found = rows.select(F.col("value").alias("line"), rule.alias("rule"), value.alias("value")).filter("rule is not null")
    none = lines.agg(F.count(F.lit(1)).alias("n")).filter("n = 0").select(F.lit("").alias("line"), F.lit("no rows").alias("rule"), F.lit("0").alias("value"))
    return found.unionByName(none)


def history(spark: SparkSession, path: str, product: str, first: str, last: str) -> DataFrame:
    """Stored daily rows of a product and a date range; partition filters only."""
    return spark.read.parquet(path).filter((F.col("product") == product) & F.col("data_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


RULE = T.StructType([T.StructField("value", T.StringType()), T.StructField("mode", T.StringType()), T.StructField("policy", T.StringType()), T.StructField("contextTerms", T.ArrayType(T.StringType()))])
ENTITY = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "canonicalName", "entityType", "entitySubtype", "broadTopic", "parentRegistryId", "visibility", "safetyCategory")]
                      + [T.StructField("aliases", T.ArrayType(T.StringType())), T.StructField("ambiguousAliases", T.ArrayType(T.StringType())), T.StructField("matchRules", T.ArrayType(RULE))])
DICTIONARY = T.StructType([T.StructField("schemaVersion", T.StringType()), T.StructField("entities", T.ArrayType(ENTITY))])


def dictionary(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Entity and alias tables from either schema version; plain aliases match automatically, ambiguous ones are candidates only."""
    raw = spark.read.schema(DICTIONARY).option("multiLine", True).json(path).select(F.posexplode("entities").alias("no", "e"))
    entities = raw.select(F.col("e.id").alias("entity_id"), F.col("e.canonicalName").alias("name"), F.col("e.entityType").alias("type"), F.col("e.entitySubtype").alias("subtype"), F.col("e.broadTopic").alias("topic"),
                          F.nullif("e.parentRegistryId", F.lit("")).alias("parent_id"), F.coalesce("e.visibility", F.lit("public")).alias("visibility"), F.coalesce("e.safetyCategory", F.lit("none")).alias("safety"))
    rule = lambda policy: lambda a: F.struct(a.alias("value"), F.lit("substring").alias("mode"), F.lit(policy).alias("policy"), F.array().cast("array<string>").alias("contextTerms"))
    none = F.array().cast("array<struct<value:string,mode:string,policy:string,contextTerms:array<string>>>")
    old = F.concat(F.transform(F.coalesce("e.aliases", F.array().cast("array<string>")), rule("auto")), F.transform(F.coalesce("e.ambiguousAliases", F.array().cast("array<string>")), rule("candidate")))
    rules = F.concat(F.coalesce("e.matchRules", none), old.cast("array<struct<value:string,mode:string,policy:string,contextTerms:array<string>>>"))
    aliases = raw.select("no", F.col("e.id").alias("entity_id"), F.posexplode(rules).alias("pos", "r")).select("entity_id", F.col("r.value").alias("value"), F.coalesce("r.mode", F.lit("substring")).alias("mode"), F.coalesce("r.policy", F.lit("auto")).alias("policy"), F.col("r.contextTerms").alias("terms"), "no", "pos")
    return entities, aliases.withColumn("normalized", normalize_text(F.col("value")))


def region_map(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Regions (region_id, name) and the two-column table (city, region_id)."""
    schema = T.StructType([T.StructField("regions", T.ArrayType(T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType())]))), T.StructField("aliases", T.MapType(T.StringType(), T.StringType()))])
    raw = spark.read.schema(schema).option("multiLine", True).json(path)
    return raw.select(F.inline("regions")).toDF("region_id", "name"), raw.select(F.explode("aliases").alias("city", "region_id"))


METRICS = ", ".join(f"{c} long" for c in ("total_turns", "total_sessions", "users", "single_sessions", "multi_sessions", "multi_turns", "five_plus_sessions"))
RATIOS = ", ".join(f"{c} double" for c in ("average_turns", "multi_rate", "multi_average_turns", "five_plus_rate"))
DOCUMENT = f"product string, data_date date, {METRICS}, {RATIOS}"


def daily_documents(spark: SparkSession, folder: str, schema: str = DOCUMENT) -> DataFrame:
    """One JSON document per product and day from a folder, the newest file of a day; columns and types are those of the schema."""
    rows = spark.read.schema(schema).option("multiLine", True).json(folder).withColumn("_file", F.input_file_name())
    order = Window.partitionBy("product", "data_date").orderBy(F.desc("_file"))
    return rows.withColumn("_r", F.row_number().over(order)).filter("_r = 1").drop("_r", "_file")

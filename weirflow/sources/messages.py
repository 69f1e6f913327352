"""Raw and reflow messages: scans, and typed records with a dead-letter side.

Kafka topics are read once and fanned out to the enrichers; files of JSON lines stand in for a topic in tests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.documents import update_count_of
from ..schemas import ENRICHMENTS, OBJECT


def scan(spark: SparkSession, topics: list[str], bootstrap: str = "", folder: str | None = None, stream: bool = True, starting: str = "earliest", group: str | None = None, most_per_trigger: int | None = None) -> DataFrame:
    """Messages as value, topic, partition, offset: from Kafka, or of files ``folder/topic/*`` of JSON lines (stand-ins of topics in tests, each read as a whole; lines are numbered)."""
    if folder is None:
        reader = spark.readStream if stream else spark.read
        reader = reader.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("subscribe", ",".join(topics)).option("startingOffsets", starting)
        if group:
            reader = reader.option("groupIdPrefix", group)
        if stream and most_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", most_per_trigger)
        return reader.load().select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset")
    out = None
    for topic in topics:
        reader = spark.readStream.option("maxFilesPerTrigger", most_per_trigger or 1000) if stream else spark.read
        files = reader.schema("value string").text(f"{folder}/{topic}", wholetext=True)
        lines = files.select(file_offset().alias("at"), F.posexplode(F.split("value", r"\r?\n")).alias("line", "value")).where("value <> ''")
        part = lines.select("value", F.lit(topic).alias("topic"), F.lit(0).alias("partition"), (F.col("at") + F.col("line")).alias("offset"))
        out = part if out is None else out.unionByName(part)
    return out


def file_offset() -> Column:
    """What orders files: their time, in milliseconds since 2020, with room for 16 million lines each."""
    return (F.unix_millis(F.col("_metadata.file_modification_time")) - F.lit(1_577_836_800_000)) * F.lit(1 << 24)


def blank(c: Column) -> Column:
    """Null, empty, or white space only."""
    return c.isNull() | c.rlike(r"^\s*$")


def parse_raw(messages: DataFrame) -> DataFrame:
    """Raw messages as records; ``malformed`` tells those for the dead-letter side: no JSON object, or no document id."""
    v = F.try_parse_json("value")
    get = lambda name, kind: F.try_variant_get("v", f"$.{name}", kind)
    rows = messages.withColumn("v", v)
    return rows.select(
        get("documentId", "string").alias("document_id"),
        F.coalesce(get("payload", OBJECT), F.expr("map_from_arrays(cast(array() as array<string>), cast(array() as array<variant>))")).alias("payload"),
        update_count_of(get("boomerangUpdateCount", "variant")).alias("boomerang_update_count"),
        F.coalesce(get("timestamp", "bigint"), F.unix_millis(F.current_timestamp())).alias("timestamp"),
        F.coalesce(get("reflow", "boolean"), F.lit(False)).alias("reflow"),
        get("existingEnrichments", ENRICHMENTS).alias("existing_enrichments"),
        (F.col("v").isNull() | ~F.schema_of_variant("v").startswith("OBJECT") | get("documentId", "string").isNull()).alias("malformed"),
        *[c for c in messages.columns],
    )


def parse_reflow(messages: DataFrame) -> DataFrame:
    """Reflow messages: enricher, criteria as JSON, time; and whether they are malformed."""
    rows = messages.withColumn("v", F.try_parse_json("value"))
    return rows.select(
        F.try_variant_get("v", "$.enricherName", "string").alias("enricher_name"),
        F.to_json(F.try_variant_get("v", "$.queryCriteria", "variant")).alias("query_criteria"),
        F.coalesce(F.try_variant_get("v", "$.timestamp", "bigint"), F.unix_millis(F.current_timestamp())).alias("timestamp"),
        (F.col("v").isNull() | ~F.schema_of_variant("v").startswith("OBJECT")).alias("malformed"),
        *messages.columns,
    )


def split_malformed(parsed: DataFrame, policy: str = "dead_letter") -> tuple[DataFrame, DataFrame]:
    """Good records and the dead-letter rows; with the policy ``fail`` the first malformed row ends the job."""
    if policy == "fail":
        parsed = parsed.withColumn("malformed", F.when(F.col("malformed"), F.raise_error(F.concat(F.lit("malformed message: "), F.coalesce("value", F.lit("null"))))).otherwise(F.col("malformed")))
    return parsed.where("not malformed").drop("malformed", "value"), parsed.where("malformed").select("topic", "partition", "offset", "value")

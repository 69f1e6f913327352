"""Queries of the general training-data operators, over the whole tables of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import change_log, exactly_once, instants
from ..shared import scratch


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _deliveries(spark: SparkSession, folder: str) -> tuple[exactly_once.SeenStore, dict[str, DataFrame]]:
    """The batches of the raw topics as two deliveries to a new store of seen messages."""
    raw, even = table(spark, folder, "raw_documents"), F.pmod(F.coalesce("batch_id", F.lit(0)), F.lit(2)) == 0
    return exactly_once.SeenStore(spark, scratch(spark, "seen")), {"1": raw.where(even), "2": raw.where(~even)}


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    store, parts = _deliveries(spark, folder)
    for name, part in parts.items():
        store.commit(part, name)
    return store.repeated()


def p1_one_copy(spark: SparkSession, folder: str) -> DataFrame:
    return exactly_once.one_copy(table(spark, folder, "raw_documents"))


def p1_deliveries(spark: SparkSession, folder: str) -> DataFrame:
    """The accepted messages by delivery."""
    store, parts = _deliveries(spark, folder)
    first, second = (store.deliver(part, name).withColumn("delivery", F.lit(int(name))) for name, part in parts.items())
    return first.unionByName(second).select("document_id", "boomerang_update_count", "path", "delivery", "kafka_topic", "kafka_partition", "kafka_offset")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return change_log.rebuild(table(spark, folder, "document_changes"), scratch(spark, "changes"))


def _purchases(spark: SparkSession, folder: str, only: DataFrame | None = None) -> DataFrame:
    """Purchases, their dates parsed; ``only`` those of certain sources."""
    stores = table(spark, folder, "stores").select("store_id", F.col("country").alias("store_country"))
    bought = table(spark, folder, "purchase_documents").select("record_id", "store_id", "purchase_date", "ingested_at").join(stores, "store_id", "left")
    if only is not None:
        bought = bought.join(only.select(F.col("source").alias("store_id")), "store_id", "left_semi")
    keep = [F.col("record_id"), F.col("store_id").alias("source"), F.unix_millis(F.col("ingested_at").cast("timestamp")).alias("ingested_ms")]
    return instants.parse(bought, keep, F.col("purchase_date"), F.col("store_country") == "US")


def _declared(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "stores").select(F.col("store_id").alias("source"), F.col("timezone").alias("zone"), F.lit(0).alias("rank"))


def _usable(parsed: DataFrame) -> DataFrame:
    """The rows whose wall clock tells something of its zone: those with a time of day and without a zone of their own."""
    return parsed.where("wall_ms is not null and region is null and pmod(wall_ms, 86400000) <> 0")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """A store's zone is the one that it declares; one that declares none gets what its rows tell, among UTC and all zones that any store declares. Sources that aren't stores are UTC."""
    stores = _declared(spark, folder).select("source", F.nullif(F.trim("zone"), F.lit("")).alias("zone"))
    declared, silent = stores.where("zone is not null"), stores.where("zone is null").select("source")
    known = declared.select("zone").unionByName(spark.range(1).select(F.lit("UTC").alias("zone"))).distinct()
    candidates = silent.crossJoin(F.broadcast(known)).withColumn("rank", (F.col("zone") != "UTC").cast("int"))
    # Stores are some hundred rows, those that declare no zone a part of them: their purchases alone are weighed, and no purchase is shuffled.
    told = instants.choose_zones(_usable(_purchases(spark, folder, F.broadcast(silent))), F.broadcast(candidates)).select("source", "zone")
    zones = F.broadcast(declared.unionByName(told))
    bought = _purchases(spark, folder).join(zones, "source", "left").select(F.lit("purchase_documents").alias("source_table"), "record_id", instants.resolve(F.coalesce("zone", F.lit("UTC"))).alias("utc_millis"))
    clients = instants.parse(table(spark, folder, "client_documents"), [F.col("record_id")], F.col("registration_date"), F.lit(False))
    clients = clients.select(F.lit("client_documents").alias("source_table"), "record_id", instants.resolve(F.lit("UTC")).alias("utc_millis"))
    return bought.unionByName(clients)


def p5_zones(spark: SparkSession, folder: str) -> DataFrame:
    """The zone of each store as its own rows tell, without its declared zone, among all zones that any store declares."""
    stores = _declared(spark, folder)
    # Names of IANA zones are a few hundred at most.
    zones = sorted({r.zone for r in stores.select("zone").distinct().collect()}, key=lambda z: (z != "UTC", z))
    candidates = stores.select("source", F.posexplode(F.array(*map(F.lit, zones))).alias("rank", "zone"))
    chosen = instants.choose_zones(_usable(_purchases(spark, folder)), candidates).where("rows > 0")
    return chosen.join(stores.select("source", F.col("zone").alias("declared")), "source").select(F.col("source").alias("store_id"), "zone", "declared", "violations", F.col("rows").alias("n_rows"))


QUERIES = {f.__name__: f for f in (p1_found, p1_one_copy, p1_deliveries, p3_found, p5_found, p5_zones)}

_MESSAGE = """select lower(trim(document_id)) as document_id, coalesce(boomerang_update_count, 0) as boomerang_update_count,
  case when reflow then 'reflow' else 'realtime' end as path, * exclude (document_id, boomerang_update_count) from raw_documents where trim(document_id) <> ''"""

SQL = {
    "p1_found": f"select document_id, boomerang_update_count, path from ({_MESSAGE}) group by all having count(*) > 1",
    "p1_one_copy": f"""select document_id, boomerang_update_count, path, batch_id, kafka_topic, kafka_partition, kafka_offset from ({_MESSAGE})
      qualify row_number() over (partition by document_id, boomerang_update_count, path order by batch_id, kafka_topic, kafka_partition, kafka_offset) = 1""",
    "p1_deliveries": f"""select document_id, boomerang_update_count, path, cast(if(batch_id % 2 = 0, 1, 2) as int) as delivery, kafka_topic, kafka_partition, kafka_offset from ({_MESSAGE})
      qualify row_number() over (partition by document_id, boomerang_update_count, path order by batch_id % 2, batch_id, kafka_topic, kafka_partition, kafka_offset) = 1""",
    "p3_found": """select document_id, boomerang_update_count from (
        select lower(trim(document_id)) as document_id, coalesce(boomerang_update_count, 0) as boomerang_update_count, timestamp_ms, change_seq,
          case when coalesce(trim(op), '') = '' then payload is null else lower(trim(op)) in ('d', 'del', 'delete', 'deleted', 'remove', 'removed', 'rm') end as gone
        from document_changes where trim(document_id) <> ''
        qualify row_number() over (partition by lower(trim(document_id)) order by coalesce(boomerang_update_count, 0) desc, timestamp_ms desc nulls last, change_seq) = 1)
      where not gone""",
}

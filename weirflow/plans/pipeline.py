"""Whole pipelines: guard, enrich, union, join, merge; in a batch and as a stream.

REALTIME takes raw and reflow documents, OFFLINE reflow documents only. Each enricher sees each document
once; the guard stands before the call, per document, enricher and path, and only for realtime documents of
enricher without reflow it is left out.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sinks
from ..config import EnricherConfig, PipelineConfig
from ..enrichers.base import create
from ..operators import enrich, guard, joiner, reflow
from ..sources import messages
from ..sources.docstore import DocStore, IdsReader, SearchSource
from ..streaming import processors

#: Runs an enricher over documents.
Call = Callable[[DataFrame, EnricherConfig], DataFrame]


def union_all(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames; no frame is an error."""
    if not frames:
        raise ValueError("nothing to unite")
    return reduce(DataFrame.unionByName, frames)


def service_of(e: EnricherConfig) -> enrich.Service:
    return enrich.Service(e.name, e.class_name, e.properties, e.bulk_size if e.bulk_enabled else 0, e.async_capacity, e.async_timeout_ms, e.rate_limit_per_second, e.max_retries, e.retry_delay_ms)


def store_url(cfg: PipelineConfig) -> str:
    """The store's hosts, apart by commas."""
    return ",".join(h if "://" in h else f"http://{h}" for h in map(str, cfg.elasticsearch.hosts))


def refetch_of(cfg: PipelineConfig) -> enrich.Refetch | None:
    """The client that reads documents again from the configured store; None without a store."""
    s = cfg.elasticsearch
    return IdsReader(store_url(cfg), s.index, s.username, s.password, s.socket_timeout_ms / 1000) if s.hosts else None


def service_calls(refetch: enrich.Refetch | None) -> Call:
    """Enrichers as services; failed reflow documents are read and tried again if ``refetch`` is given."""
    return lambda rows, e: enrich.call_service(rows, service_of(e), None if not e.rate_limit_per_second else e.parallelism, refetch=refetch)


def all_services(documents: DataFrame, cfg: PipelineConfig, refetch: enrich.Refetch | None) -> DataFrame:
    """Documents with their enricher_name through their enrichers, in one operator; its partitions are the greatest parallelism of a limited enricher."""
    limited = [e.parallelism for e in cfg.enrichers if e.rate_limit_per_second]
    return enrich.call_services(documents, {e.name: service_of(e) for e in cfg.enrichers}, max(limited, default=None), refetch=refetch)


def batch_results(cfg: PipelineConfig, raw: DataFrame | None, reflow: DataFrame | None, call: Call, order: list[str], chunk: str | None = None) -> DataFrame:
    """Results of all enrichers for a batch.

    ``call`` gives a frame of documents with enricher_name, enriched_fields, success and error_message. Raw and reflow
    documents have document_id, boomerang_update_count, reflow and the order columns; reflow ones may
    have enricher_name, the enricher that asked for them. The guard is one plan per path, whatever the number of enrichers, and its
    exchanges are made once.
    """
    frames = []
    realtime = raw if cfg.mode == "REALTIME" else None
    fresh = guard.accept(realtime, ["document_id"], order, chunk=chunk) if realtime is not None and cfg.reflow_names() else None
    asked = reflow is not None and "enricher_name" in reflow.columns
    again = guard.accept(reflow, ["document_id", *(["enricher_name"] if asked else [])], order, chunk=chunk) if reflow is not None and cfg.reflow_names() else None
    for e in cfg.enrichers:
        if realtime is not None:
            frames.append(call(fresh if e.reflow_enabled else realtime, e))
        if e.reflow_enabled and again is not None:
            frames.append(call(again.where(F.col("enricher_name") == e.name).drop("enricher_name") if asked else again, e))
    return union_all(frames)


def run_batch(cfg: PipelineConfig, raw: DataFrame | None, reflow: DataFrame | None, call: Call, order: list[str], chunk: str | None = None, seq: str = "seq") -> DataFrame:
    """Assembled documents of a batch; one cycle per document."""
    results = batch_results(cfg, raw, reflow, call, order, chunk)
    keys = ["document_id", "boomerang_update_count"] if cfg.joiner.join_key == "document_version" else ["document_id"]
    return joiner.joined(results, cfg.names(), cfg.reflow_names(), keys, seq, cfg.joiner.reflow_expected == "triggering_only")


def remote_store(spark: SparkSession, cfg: PipelineConfig) -> DocStore:
    """The configured store, read anew by every use."""
    s = cfg.elasticsearch
    spark.dataSource.register(SearchSource)
    options = {"url": store_url(cfg), "index": s.index, "user": s.username, "password": s.password, "timeout": s.socket_timeout_ms / 1000, "slices": cfg.reflow.max_slices, "page": cfg.reflow.fetch_batch_size}
    if cfg.reflow.sort_field:
        options["sort"] = cfg.reflow.sort_field
    return DocStore(spark.read.format("weirflow_search").options(**options).load())


def stage_requests(spark: SparkSession, cfg: PipelineConfig, store: DocStore, staged_folder: str, checkpoint: str, folder: str | None = None, trigger: str = "1 second"):
    """Starts the reflow stage: requests of all reflow topics, with the documents of the store that they ask for written to ``staged_folder``."""
    cfg.validate()
    asked = [e for e in cfg.enrichers if e.reflow_enabled]
    queries = {e.name: create(e.class_name, e.properties).reflow_query for e in asked}
    group = "-".join(sorted({e.reflow_consumer_group for e in asked if e.reflow_consumer_group}))
    scanned = messages.scan(spark, sorted({e.reflow_topic for e in asked}), cfg.kafka.bootstrap_servers, folder, starting=cfg.kafka.starting_offsets, group=group)
    requests = messages.split_malformed(messages.parse_reflow(scanned), cfg.malformed)[0]

    def body(batch: DataFrame, batch_id: int) -> None:
        reflow.stage_reflow(batch, batch_id, store, staged_folder, cfg.reflow.slice_threshold, cfg.reflow.max_slices, queries)

    return requests.writeStream.option("checkpointLocation", checkpoint).trigger(processingTime=trigger).foreachBatch(body).start()


def _fan_out(parsed: DataFrame, cfg: PipelineConfig, path: str) -> DataFrame:
    """One row per document and enricher of the path. The topic is read once; enrichers are a handful."""
    names = cfg.names() if path == "realtime" else cfg.reflow_names()
    each = F.explode(F.array(*map(F.lit, names))) if path == "realtime" else F.col("enricher_name")
    return parsed.select(
        "document_id", each.alias("enricher_name"), F.lit(path).alias("path"),
        (F.col("partition").cast("bigint") * F.lit(1 << 50) + F.col("offset")).alias("seq"),
        "boomerang_update_count", "reflow", F.to_json("payload").alias("payload_json"), F.to_json("existing_enrichments").alias("existing_json"), "timestamp",
    )


def _staged(spark: SparkSession, staged_folder: str) -> DataFrame:
    return spark.readStream.schema("value string").text(f"{staged_folder}/*").select("value", F.lit("staged").alias("topic"), F.lit(0).alias("partition"), messages.file_offset().alias("offset"))


def dead_letters(spark: SparkSession, cfg: PipelineConfig, folder: str | None = None, staged_folder: str | None = None) -> DataFrame:
    """The malformed raw, reflow and staged messages as a stream of ``value``: JSON of topic, partition, offset and the message."""
    scan = lambda topics: messages.scan(spark, topics, cfg.kafka.bootstrap_servers, folder, starting=cfg.kafka.starting_offsets)
    parsed = [messages.parse_raw(scan([cfg.kafka.raw_topic]))] if cfg.mode == "REALTIME" else []
    if cfg.reflow_names():
        parsed.append(messages.parse_reflow(scan(sorted({e.reflow_topic for e in cfg.enrichers if e.reflow_enabled}))))
        if staged_folder is not None:
            parsed.append(messages.parse_raw(_staged(spark, staged_folder)))
    rows = union_all([messages.split_malformed(p)[1] for p in parsed])
    return rows.select(F.to_json(F.struct("topic", "partition", "offset", "value")).alias("value"))


def stream_documents(spark: SparkSession, cfg: PipelineConfig, raw_folder: str | None = None, staged_folder: str | None = None, refetch: enrich.Refetch | None = None) -> DataFrame:
    """The output documents as a stream of ``value``; folders stand in for the topics, staged reflow documents come from a folder.

    Reflow documents that fail are read again by ``refetch``, by default from the configured store, and tried again.
    """
    cfg.validate()
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", processors.STATE_STORE)
    inputs = []
    if cfg.mode == "REALTIME":
        group = "-".join(sorted({e.consumer_group for e in cfg.enrichers if e.consumer_group}))
        scanned = messages.scan(spark, [cfg.kafka.raw_topic], cfg.kafka.bootstrap_servers, raw_folder, starting=cfg.kafka.starting_offsets, group=group, most_per_trigger=cfg.kafka.max_offsets_per_trigger or None)
        inputs.append(_fan_out(messages.split_malformed(messages.parse_raw(scanned), cfg.malformed)[0], cfg, "realtime"))
    if staged_folder is not None and cfg.reflow_names():
        parsed = messages.parse_raw(_staged(spark, staged_folder)).withColumn("enricher_name", F.try_variant_get(F.try_parse_json("value"), "$.enricherName", "string"))
        inputs.append(_fan_out(messages.split_malformed(parsed, cfg.malformed)[0], cfg, "reflow"))
    # One guard and one operator for all enrichers, so each source is read once.
    unguarded = [e.name for e in cfg.enrichers if not e.reflow_enabled]
    results = all_services(processors.guard(union_all(inputs), unguarded), cfg, refetch or refetch_of(cfg)).withColumnRenamed("enriched_fields", "fields_json")
    joined = processors.join(results, cfg.names(), cfg.reflow_names(), cfg.joiner.timeout_ms, cfg.joiner.reflow_expected == "triggering_only", cfg.joiner.join_key == "document_version")
    typed = joined.select(
        "document_id", "boomerang_update_count", F.try_variant_get(F.try_parse_json("original_payload"), "$", "map<string,variant>").alias("original_payload"),
        F.try_variant_get(F.try_parse_json("enrichments"), "$", "map<string,map<string,variant>>").alias("enrichments"), F.unix_millis(F.current_timestamp()).alias("timestamp"),
    )
    return sinks.as_json(typed, cfg.emit_update_count)

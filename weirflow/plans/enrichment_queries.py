"""Queries of the enrichment operators, over the whole tables of a folder."""

from __future__ import annotations

import hashlib
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import EnricherConfig, PipelineConfig
from ..enrichers.base import Enricher, create
from ..enrichers.geo import PurchaseGeoEnricher
from ..functions import documents as D
from ..functions import mappers as M
from ..operators import enrich, guard, joiner, reflow
from ..sources import messages
from ..sources.docstore import DocStore, slice_of
from ..sources.query import compile_query, geo_reflow_query
from . import pipeline
from .corpus_queries import table

ORDER = ["kafka_topic", "kafka_partition", "kafka_offset"]
GEO, CURRENCY = "purchase-geo-enricher", "purchase-currency-enricher"
CONFIG = PipelineConfig(enrichers=[
    EnricherConfig(name=GEO, consumer_group="geo", reflow_topic="reflow-geo", reflow_enabled=True),
    EnricherConfig(name=CURRENCY, consumer_group="currency", reflow_enabled=False),
])
BOTH = {"bool": {"must": [{"term": {f"enrichments.{GEO}.geo_region": "US-E"}}, {"term": {"storeId": "ST-0001"}}]}}
SORT, PAGE = "startTime", 1000
CURSOR = (1700000000000.0, "")


def _raw(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "raw_documents")


def _parsed(spark: SparkSession, folder: str) -> DataFrame:
    """Raw messages with their payload as a map; those that are malformed have none."""
    return _raw(spark, folder).withColumn("p", D.object_of(F.col("payload")))


def raw_parse(spark: SparkSession, folder: str) -> DataFrame:
    rows = _parsed(spark, folder)
    fields = {"store_id": "storeId", "currency": "currency", "first_name": "firstName"}
    return rows.select(*ORDER, F.coalesce("boomerang_update_count", F.lit(0)).alias("n_update"), *(M.text_of(F.col("p"), f).alias(n) for n, f in fields.items()), (F.col("document_id").isNull() | F.col("p").isNull()).alias("dead_letter"))


def _guarded(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    rows = _raw(spark, folder).where("document_id is not null").withColumn("reflow", F.coalesce("reflow", F.lit(False)))
    return guard.guarded(rows, ["document_id", *more], ORDER, chunk="batch_id").select("document_id", "reflow", F.coalesce("boomerang_update_count", F.lit(0)).alias("n_update"), *ORDER, "accepted")


def guard_accept(spark: SparkSession, folder: str) -> DataFrame:
    return _guarded(spark, folder).where("accepted").drop("accepted", "reflow")


def guard_drop(spark: SparkSession, folder: str) -> DataFrame:
    return _guarded(spark, folder).where("not accepted").drop("accepted", "reflow")


def guard_per_path(spark: SparkSession, folder: str) -> DataFrame:
    return _guarded(spark, folder, "reflow")


def _entries(rows: DataFrame, m: Column, *keys: str) -> DataFrame:
    return rows.select(*keys, F.explode(m).alias("field", "value"))


def geo_request_map(spark: SparkSession, folder: str) -> DataFrame:
    return _entries(_parsed(spark, folder).where("p is not null"), M.geo_request(F.col("p")), *ORDER)


def geo_response_map(spark: SparkSession, folder: str) -> DataFrame:
    return _entries(table(spark, folder, "stores"), M.geo_response(*map(F.col, ("latitude", "longitude", "geo_region", "timezone"))), "store_id")


def field_map(spark: SparkSession, folder: str) -> DataFrame:
    rows = _parsed(spark, folder).withColumn("p", F.map_filter("p", lambda _, v: ~F.is_variant_null(v)))
    return rows.select(*ORDER, F.explode(F.map_keys(M.rename_fields(F.col("p")))).alias("field"))


def client_payload(spark: SparkSession, folder: str) -> DataFrame:
    names = {"clientId": "client_id", "firstName": "first_name", "lastName": "last_name", "registrationDate": "registration_date"}
    client = {f: F.col(names.get(f, f)) for f in M.CLIENT_FIELDS}
    return _entries(table(spark, folder, "client_documents"), M.client_payload(client), "record_id")


def client_typed(spark: SparkSession, folder: str) -> DataFrame:
    rows = _parsed(spark, folder).where("kafka_topic = 'clients-raw'").select(*ORDER, M.client_of(F.col("p")).alias("c"))
    return rows.select(*ORDER, F.col("c.firstName").alias("first_name"), F.col("c.tier").alias("tier"), F.col("c.country").alias("country"))


def _key() -> Column:
    return F.concat_ws("-", *ORDER)


def _store(spark: SparkSession, folder: str) -> DocStore:
    """The raw messages as stored documents, with their existing enrichments inside."""
    p = F.col("payload")
    inside = F.concat(F.expr("left(payload, length(payload) - 1)"), F.lit(', "enrichments": '), F.col("existing_enrichments"), F.lit("}"))
    return DocStore(_raw(spark, folder).where(F.try_parse_json(p).isNotNull()).select(_key().alias("document_id"), F.when(F.col("existing_enrichments").isNull(), p).otherwise(inside).alias("source")))


def dsl_term(spark: SparkSession, folder: str) -> DataFrame:
    return _store(spark, folder).where({"term": {"storeId": "ST-0001"}}).select("document_id")


def dsl_columns(spark: SparkSession, folder: str) -> DataFrame:
    """A query over fields that the store keeps as columns: it is filtered in the scan, and documents aren't parsed."""
    bought = table(spark, folder, "purchase_documents")
    store = DocStore(bought.withColumn("source", F.to_json(F.struct("store_id", "currency"))), "record_id", "source", {"storeId": "store_id", "currency": "currency", "startTime": "start_time"})
    query = {"bool": {"must": [{"term": {"storeId": "ST-0001"}}, {"range": {"startTime": {"gte": 1600000000000}}}], "must_not": [{"terms": {"currency": ["EUR", "USD"]}}]}}
    return store.where(query).select(F.col("document_id").alias("record_id"))


def dsl_bool_must(spark: SparkSession, folder: str) -> DataFrame:
    return _store(spark, folder).where(BOTH).select("document_id")


def dsl_geo_region(spark: SparkSession, folder: str) -> DataFrame:
    return _store(spark, folder).where(geo_reflow_query({"region": "US-E", "storeId": " "})).select("document_id")


def dsl_match_all(spark: SparkSession, folder: str) -> DataFrame:
    return _store(spark, folder).where(geo_reflow_query({"region": None})).groupBy().agg(F.count("*").alias("n"))


def dsl_match(spark: SparkSession, folder: str) -> DataFrame:
    return _store(spark, folder).where({"match": {"country": "ES"}}).select("document_id")


def dsl_match_text(spark: SparkSession, folder: str) -> DataFrame:
    query = {"match": {"text": "lighthouses Brücke glacier"}}
    return table(spark, folder, "documents").where(compile_query(query, F.col, F.col("doc_id"), frozenset({"text"}))).select("doc_id")


def dsl_ids(spark: SparkSession, folder: str) -> DataFrame:
    return _store(spark, folder).where({"ids": {"values": [f"purchases-raw-{p}-{o}" for p in range(8) for o in (1, 2, 3)]}}).select("document_id")


def reflow_count_slices(spark: SparkSession, folder: str) -> DataFrame:
    region = F.try_variant_get(F.try_parse_json("existing_enrichments"), f'$["{GEO}"].geo_region', "string")
    documents = _parsed(spark, folder).where("p is not null").select(region.alias("region"), M.text_of(F.col("p"), "storeId").alias("store_id"))
    plan = reflow.plan_slices(table(spark, folder, "reflow_messages"), documents, threshold=1000, max_slices=10)
    request = reflow.request_id("message_id", "enricher_name", "query_criteria")
    return plan.select("message_id", "n_documents", "slice_id", "max_slices", M.slice_key(request, F.col("slice_id")).alias("slice_key"), M.is_sliced(F.col("max_slices")).alias("is_sliced"))


def slice_partition(spark: SparkSession, folder: str) -> DataFrame:
    return _raw(spark, folder).select(_key().alias("document_id"), slice_of(_key(), 4).alias("slice_id"))


def page_first(spark: SparkSession, folder: str) -> DataFrame:
    return _store(spark, folder).page(None, PAGE, sort_field=SORT).select("document_id", "sort_value")


def page_after_cursor(spark: SparkSession, folder: str) -> DataFrame:
    return _store(spark, folder).page({"term": {"currency": "EUR"}}, PAGE, CURSOR, SORT, 1, 2).select("document_id", "sort_value")


def fetch_by_ids(spark: SparkSession, folder: str) -> DataFrame:
    ids = _raw(spark, folder).where("reflow").select(_key().alias("document_id"))
    return _store(spark, folder).by_ids(ids).select("document_id", "boomerang_update_count", "reflow", F.size("existing_enrichments").alias("n_existing"))


def enrich_lookup_single(spark: SparkSession, folder: str) -> DataFrame:
    bought = table(spark, folder, "purchase_documents").select("record_id", "store_id")
    results = enrich.lookup(bought, table(spark, folder, "stores"), "store_id", GEO, F.struct("geo_region", "timezone"))
    return results.select("record_id", "enricher_name", "success", "error_message", F.col("enriched_fields.geo_region").alias("geo_region"), F.col("enriched_fields.timezone").alias("geo_timezone"))


def bulk_batches(spark: SparkSession, folder: str) -> DataFrame:
    rows = enrich.bulk_positions(_raw(spark, folder), 20, ["kafka_topic", "kafka_partition"], ["kafka_offset"])
    return rows.select(*ORDER, "bulk_id", "position")


def _call(spark: SparkSession, folder: str):
    """The two enrichers as lookups: a store's place, and how many purchases a currency has."""
    stores = table(spark, folder, "stores")
    currencies = table(spark, folder, "purchase_documents").where("currency is not null").groupBy("currency").agg(F.count("*").alias("n_purchases"))
    answers = {
        GEO: ("store_id", stores, F.expr("map('geo_region', to_variant_object(named_struct('v', geo_region)))")),
        CURRENCY: ("currency", currencies, F.expr("map('n_purchases', to_variant_object(named_struct('v', cast(n_purchases as string))))")),
    }

    def call(rows: DataFrame, e: EnricherConfig) -> DataFrame:
        on, table_, fields = answers[e.name]
        # The currency service answers nothing at all to a document without a currency.
        rows = rows.where("currency is not null") if e.name == CURRENCY else rows
        return enrich.lookup(rows, table_, on, e.name, fields).select("document_id", "enricher_name", "success", "enriched_fields", "original_payload", "reflow", "existing_enrichments", "seq", "boomerang_update_count")

    return call


RETRIES, WORSE = 3, 6


def _fails(document_id: str) -> int:
    return int(hashlib.md5(document_id.encode()).hexdigest()[:8], 16) % WORSE


class FailsFirst(Enricher):
    """Fails the first so many times for a document, by its id."""

    def open(self, properties: dict[str, str]) -> None:
        self.calls = Counter()

    def call(self, document_id: str, request: dict) -> dict:
        self.calls[document_id] += 1
        if self.calls[document_id] <= _fails(document_id):
            raise RuntimeError(str(self.calls[document_id]))
        return {"attempts": self.calls[document_id]}


def retry_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """Attempts and outcome of reflow documents whose service fails the first times."""
    rows = table(spark, folder, "orders").select(F.col("o_orderkey").cast("string").alias("document_id"), F.lit("{}").alias("payload_json"), F.lit(True).alias("reflow"))
    service = enrich.Service("fails", "", max_retries=RETRIES, retry_delay_ms=0)
    got = enrich.call_service(rows, service, make=_fails_first, refetch=lambda ids: {d: {} for d in ids})
    return got.select("document_id", F.coalesce(F.get_json_object("enriched_fields", "$.attempts"), "error_message").cast("int").alias("attempts"), "success")


def _fails_first() -> FailsFirst:
    return create(f"{__name__}.FailsFirst")


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    rows = _parsed(spark, folder).where("document_id is not null and p is not null").withColumn("reflow", F.coalesce("reflow", F.lit(False)))
    existing = F.try_variant_get(F.try_parse_json("existing_enrichments"), "$", "map<string, map<string, variant>>")
    return rows.select(
        "document_id", "reflow", "boomerang_update_count", "batch_id", *ORDER, M.text_of(F.col("p"), "storeId").alias("store_id"), M.text_of(F.col("p"), "currency").alias("currency"),
        F.col("p").alias("original_payload"), existing.alias("existing_enrichments"), F.struct("batch_id", *ORDER).alias("seq"), F.unix_millis(F.col("ingested_at").cast("timestamp")).alias("at"),
    )


def _piped(spark: SparkSession, folder: str, mode: str) -> DataFrame:
    cfg = PipelineConfig(mode=mode, enrichers=CONFIG.enrichers)
    rows = _documents(spark, folder)
    return pipeline.run_batch(cfg, rows.where("not reflow") if mode == "REALTIME" else None, rows.where("reflow"), _call(spark, folder), ORDER, "batch_id")


def _flat(rows: DataFrame) -> DataFrame:
    """Whether a document is complete and from what, the store of its first payload, and its enrichments: how many, and two fields."""
    new = lambda name, field: F.try_variant_get(F.try_element_at(F.try_element_at("enrichments", F.lit(name)), F.lit(field)), "$.v", "string")
    return rows.select("document_id", "reflow", "is_partial", F.array_join(F.sort_array("reported"), ",").alias("reported"), M.text_of(F.col("original_payload"), "storeId").alias("first_store"), F.coalesce(F.size("enrichments"), F.lit(0)).alias("n_enrichments"), new(GEO, "geo_region").alias("geo_region"), new(CURRENCY, "n_purchases").alias("n_purchases"))


def realtime_pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(_piped(spark, folder, "REALTIME"))


def offline_pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(_piped(spark, folder, "OFFLINE"))


def join_partial(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(_piped(spark, folder, "REALTIME")).where("is_partial").select("document_id", "reported")


def join_complete(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(_piped(spark, folder, "REALTIME")).where("not is_partial").select("document_id", "reported", "first_store")


def join_reflow_expected(spark: SparkSession, folder: str) -> DataFrame:
    """The enrichers that a document waits for, by the path of its first result."""
    return _piped(spark, folder, "REALTIME").select("document_id", "reflow", F.array_join(F.sort_array("expected"), ",").alias("expected"), "is_partial")


def union_results(spark: SparkSession, folder: str) -> DataFrame:
    cfg, rows = CONFIG, _documents(spark, folder)
    results = pipeline.batch_results(cfg, rows.where("not reflow"), rows.where("reflow"), _call(spark, folder), ORDER, "batch_id")
    return results.groupBy("enricher_name", "reflow", "success").agg(F.count("*").alias("n_results"), F.count_distinct("document_id").alias("n_documents"))


def carry_forward_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Existing enrichments overlaid with the geo answer, where there is one."""
    stores = table(spark, folder, "stores").select("store_id", F.expr(f"map('{GEO}', map('geo_region', to_variant_object(named_struct('v', geo_region))))").alias("new"))
    rows = _documents(spark, folder).where("existing_enrichments is not null").join(stores, "store_id", "left")
    both = rows.select(*ORDER, F.explode(D.overlay(F.col("existing_enrichments"), F.col("new"))).alias("enricher_name", "fields"))
    value = F.when(F.schema_of_variant("value").startswith("OBJECT"), F.try_variant_get("value", "$.v", "string")).otherwise(F.try_variant_get("value", "$", "string"))
    return both.select(*ORDER, "enricher_name", F.explode("fields").alias("field", "value")).select(*ORDER, "enricher_name", "field", F.when(F.col("field") == "geo_region", value).alias("value"))


def merged_document(spark: SparkSession, folder: str) -> DataFrame:
    """The keys of each merged document, with the values of those that are ours or text."""
    rows = _documents(spark, folder).withColumn("document", D.merged(F.col("original_payload"), F.col("document_id"), F.lit(0), F.col("existing_enrichments")))
    value = F.when(F.schema_of_variant("value") == "STRING", F.try_variant_get("value", "$", "string"))
    return rows.select(*ORDER, F.explode("document").alias("field", "value")).select(*ORDER, "field", value.alias("value"))


def output_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The merged documents as JSON strings: their id, store, and number of keys."""
    rows = _documents(spark, folder).select(*ORDER, "document_id", "original_payload", F.lit(0).alias("timestamp"), F.col("existing_enrichments").alias("enrichments"))
    document = F.to_json(D.merged(F.col("original_payload"), F.col("document_id"), F.col("timestamp"), F.col("enrichments")), {"ignoreNullFields": "false"})
    return rows.select(*ORDER, document.alias("value")).select(*ORDER, F.get_json_object("value", "$.documentId").alias("document_id"), F.get_json_object("value", "$.storeId").alias("store_id"), F.size(F.json_object_keys("value")).alias("n_keys"))


def emission_cycles(spark: SparkSession, folder: str) -> DataFrame:
    """Emissions over time: results arrive when their message was ingested, those of the currency enricher a minute later for every other batch."""
    rows = _documents(spark, folder)
    geo = rows.select("document_id", F.col("at").alias("arrival_ms"), F.struct("seq", F.lit(0).alias("k")).alias("seq"), F.lit(GEO).alias("enricher_name"), "reflow")
    late = rows.where("currency is not null").select("document_id", (F.col("at") + F.when(F.col("batch_id") % 2 == 0, 60_000).otherwise(1000)).alias("arrival_ms"), F.struct("seq", F.lit(1).alias("k")).alias("seq"), F.lit(CURRENCY).alias("enricher_name"), "reflow")
    return joiner.cycles(geo.unionByName(late), CONFIG.names(), CONFIG.reflow_names())


def late_second_cycle(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that a late result emitted again: their cycles, and how many of them were complete."""
    return emission_cycles(spark, folder).groupBy("document_id").agg(F.count("*").alias("n_cycles"), F.count_if(~F.col("is_partial")).alias("n_complete")).where("n_cycles > 1")


def update_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The update count of stored documents that have it as a whole number, a fraction, a string, a flag, null, or not at all."""
    n, k = F.col("o_orderkey"), F.col("o_orderkey") % 6
    value = F.when(k == 0, n.cast("string")).when(k == 1, F.concat(n.cast("string"), F.lit(".9"))).when(k == 2, F.concat(F.lit('"'), n.cast("string"), F.lit('"'))).when(k == 3, "true").when(k == 4, "null")
    source = F.when(value.isNull(), "{}").otherwise(F.concat(F.lit('{"boomerangUpdateCount": '), value, F.lit("}")))
    rows = table(spark, folder, "orders").select(n.cast("string").alias("document_id"), source.alias("source"))
    store = DocStore(rows)
    return store.by_ids(rows.select("document_id")).select("document_id", "boomerang_update_count")


def raw_messages(spark: SparkSession, folder: str) -> DataFrame:
    """The raw topics as JSON messages, read again: the record of each, and whether it is malformed."""
    text = lambda c: F.coalesce(F.to_json(F.struct(F.col(c).alias("v"))), F.lit("{}"))
    field = lambda name, c: F.concat(F.lit(f'"{name}": '), F.when(F.col(c).isNull(), "null").otherwise(F.regexp_extract(text(c), r'^\{"v":(?s)(.*)\}$', 1)))
    value = F.concat(F.lit("{"), field("documentId", "document_id"), F.lit(", "), field("boomerangUpdateCount", "boomerang_update_count"), F.lit(", "), field("reflow", "reflow"), F.lit(', "payload": '), F.coalesce("payload", F.lit("null")), F.lit("}"))
    rows = messages.parse_raw(_raw(spark, folder).select(*ORDER, value.alias("value"), F.col("kafka_topic").alias("topic"), F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset")))
    return rows.select(*ORDER, "document_id", F.col("boomerang_update_count").alias("n_update"), "reflow", F.size("payload").alias("n_fields"), "malformed")


class StubGeo(PurchaseGeoEnricher):
    """The geo service without a network: it knows a store by the digits of its id, and is down for every seventh."""

    def _post(self, url: str, body, headers: dict[str, str]):
        if isinstance(body, list):
            return [self._post(url, x, headers) for x in body]
        n = int("".join(c for c in body["storeId"] if c.isdigit()) or 0)
        if n % 7 == 0 and headers:
            raise RuntimeError("service answered 503")
        return {"latitude": n, "longitude": None if n % 5 == 0 else -n, "region": body["country"], "timezone": body.get("referenceDate")}


def _stub(bulk: int) -> enrich.Service:
    return enrich.Service(GEO, f"{__name__}.StubGeo", {"apiUrl": "stub"}, bulk_size=bulk)


def http_enrich_stub(spark: SparkSession, folder: str) -> DataFrame:
    """The geo enricher's requests and answers through the runtime, singly and in bulks of 20; a bulk of the stub never fails."""
    payload = F.to_json(F.struct(F.col("store_id").alias("storeId"), F.col("country").alias("currency"), F.col("city").alias("purchaseDate")))
    rows = table(spark, folder, "stores").select(F.col("store_id").alias("document_id"), payload.alias("payload_json"))
    both = enrich.call_service(rows, _stub(0)).withColumn("mode", F.lit("single")).unionByName(enrich.call_service(rows, _stub(20)).withColumn("mode", F.lit("bulk")))
    field = lambda n: F.get_json_object("enriched_fields", f"$.{n}").alias(n)
    return both.select("document_id", "mode", "enricher_name", "success", "error_message", field("geo_region"), field("geo_location"), field("geo_timezone"))


def result_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Purchases as results: a success with the store's region, or a failure that keeps what was known before."""
    bought = table(spark, folder, "purchase_documents").join(table(spark, folder, "stores").select("store_id", "geo_region", F.lit(True).alias("hit")), "store_id", "left")
    text = lambda c: F.expr(f"map('v', to_variant_object(named_struct('v', {c})))")
    old = F.expr("cast(null as map<string, map<string, variant>>)")
    common = F.col("record_id"), F.lit(GEO)
    good = bought.where("hit").select(*M.success(*common, text("geo_region"), text("currency"), F.lit(0), F.lit(False), old))
    bad = bought.where("hit is null").select(*M.failure(*common, text("currency"), F.lit(0), F.lit("not found"), F.lit(False), old))
    field = lambda c: F.try_variant_get(F.try_element_at(c, F.lit("v")), "$.v", "string")
    return good.unionByName(bad).select(F.col("document_id").alias("record_id"), "enricher_name", "success", "error_message", "reflow", field("enriched_fields").alias("geo_region"), field("original_payload").alias("currency"))


QUERIES = {f.__name__: f for f in (
    raw_parse, guard_accept, guard_drop, guard_per_path, geo_request_map, geo_response_map, field_map, client_payload, client_typed, dsl_term, dsl_bool_must, dsl_geo_region, dsl_match_all, dsl_match, dsl_match_text, dsl_ids,
    reflow_count_slices, slice_partition, page_first, page_after_cursor, fetch_by_ids, enrich_lookup_single, bulk_batches, realtime_pipeline, offline_pipeline, join_partial, union_results, carry_forward_merge, merged_document, emission_cycles, retry_outcomes,
    join_complete, join_reflow_expected, late_second_cycle, update_counts, raw_messages, http_enrich_stub, result_rows,
    dsl_columns, output_documents,
)}

_COORDINATES = "kafka_topic, kafka_partition, kafka_offset"
_KEY = "concat_ws('-', kafka_topic, kafka_partition, kafka_offset)"
_VALID = "(select * from raw_documents where json_valid(payload))"
_REGION = f"""(existing_enrichments->'$."{GEO}"'->>'$.geo_region')"""
_BEFORE = "max(coalesce(boomerang_update_count, 0)) over (partition by {} order by batch_id, kafka_topic, kafka_partition, kafka_offset rows between unbounded preceding and 1 preceding)"


def _guard_sql(keys: str, table_: str = "raw_documents") -> str:
    return f"""select *, coalesce(boomerang_update_count, 0) as n_update, coalesce(n_update >= {_BEFORE.format(keys)}, true) as accepted
      from (select * replace (coalesce(reflow, false) as reflow) from {table_} where document_id is not null)"""


_SLICE = f"(('0x' || substr(md5({_KEY}), 1, 8))::bigint % {{n}})"
_RESULTS = f"""
  docs as (select *, payload->>'$.storeId' as store_id, payload->>'$.currency' as currency from ({_guard_sql("document_id, coalesce(reflow, false)", _VALID)})),
  currencies as (select currency, count(*)::varchar as n_purchases from purchase_documents where currency is not null group by 1),
  results as (
    select document_id, batch_id, {_COORDINATES}, reflow, existing_enrichments, store_id, '{GEO}' as enricher_name, s.store_id is not null as success, s.geo_region as field from docs d left join stores s using (store_id) where accepted
    union all
    select document_id, batch_id, {_COORDINATES}, reflow, existing_enrichments, store_id, '{CURRENCY}', c.currency is not null, c.n_purchases from docs d left join currencies c using (currency) where not reflow and d.currency is not null)"""


def _pipeline_sql(where: str) -> str:
    seq = "(batch_id, kafka_topic, kafka_partition, kafka_offset)"
    return f"""with {_RESULTS},
  grouped as (
    select document_id, arg_min(reflow, {seq}) as reflow, arg_min({{'v': store_id}}, {seq}).v as first_store, arg_min(json_keys(existing_enrichments), {seq}) filter (reflow and existing_enrichments is not null) as existing, list(distinct enricher_name order by enricher_name) as names,
      arg_max({{'ok': success, 'v': field}}, {seq}) filter (enricher_name = '{GEO}') as geo, arg_max({{'ok': success, 'v': field}}, {seq}) filter (enricher_name = '{CURRENCY}') as cur
    from results where {where} group by 1)
  select document_id, reflow, case when reflow then not list_contains(names, '{GEO}') else len(names) < 2 end as is_partial, array_to_string(names, ',') as reported, first_store,
    len(list_distinct(list_concat(coalesce(existing, []), case when geo.ok then ['{GEO}'] else [] end, case when cur.ok then ['{CURRENCY}'] else [] end)))::int as n_enrichments,
    case when geo.ok then geo.v end as geo_region, case when cur.ok then cur.v end as n_purchases from grouped"""


#: Emissions by a recursion over each document's results: state is the open cycle's start, whom it waits for, and who reported (1 currency, 2 geo).
_CYCLES = f"""with recursive
  d as (select document_id, coalesce(reflow, false) as reflow, batch_id, {_COORDINATES}, epoch_ms(ingested_at) as t, payload->>'$.currency' as currency from {_VALID} where document_id is not null),
  u as (select document_id, reflow, batch_id, {_COORDINATES}, t, 2 as bit from d
    union all select document_id, reflow, batch_id, {_COORDINATES}, t + case when batch_id % 2 = 0 then 60000 else 1000 end, 1 from d where currency is not null),
  r as (select *, row_number() over (partition by document_id order by t, batch_id, {_COORDINATES}, bit desc) as rn, count(*) over (partition by document_id) as n from u),
  step as (
    select document_id, 0::bigint as rn, 0::bigint as started, 0 as wanted, 0 as got, null::bigint as late_start, 0 as late_got, null::bigint as full_start, 0 as full_got, 0::bigint as t, false as is_last from (select distinct document_id from r)
    union all
    select document_id, rn, start, want, case when (want & ~now) = 0 then 0 else now end, case when due then old end, old_got, case when (want & ~now) = 0 then start end, now, t, is_last from (
      select r.document_id, r.rn, r.t, r.rn = r.n as is_last, s.got > 0 and r.t >= s.started + 30000 as due, s.started as old, s.got as old_got,
        case when s.got > 0 and not due then s.started else r.t end as start, case when s.got > 0 and not due then s.wanted when r.reflow then 2 else 3 end as want,
        (case when s.got > 0 and not due then s.got else 0 end) | r.bit as now
      from step s join r on r.document_id = s.document_id and r.rn = s.rn + 1)),
  emitted as (
    select document_id, rn, 0 as k, late_start as started_ms, late_start + 30000 as emitted_ms, true as is_partial, late_got as got from step where late_start is not null
    union all select document_id, rn, 1, full_start, t, false, full_got from step where full_start is not null
    union all select document_id, rn, 2, started, started + 30000, true, got from step where is_last and got > 0)
  select document_id, row_number() over (partition by document_id order by rn, k)::int as cycle, started_ms, emitted_ms, is_partial,
    case got when 1 then '{CURRENCY}' when 2 then '{GEO}' else '{CURRENCY},{GEO}' end as reported from emitted"""


SQL = {
    "emission_cycles": _CYCLES,
    "late_second_cycle": f"select document_id, count(*) as n_cycles, count(*) filter (not is_partial) as n_complete from ({_CYCLES}) group by 1 having count(*) > 1",
    "join_complete": f"select document_id, reported, first_store from ({_pipeline_sql('true')}) where not is_partial",
    "join_reflow_expected": f"select document_id, reflow, case when reflow then '{GEO}' else '{CURRENCY},{GEO}' end as expected, is_partial from ({_pipeline_sql('true')})",
    "update_counts": "select o_orderkey::varchar as document_id, case when o_orderkey % 6 in (0, 1) then o_orderkey else 0 end::bigint as boomerang_update_count from orders",
    "raw_messages": f"""select {_COORDINATES}, case when ok then document_id end as document_id, case when ok then coalesce(boomerang_update_count, 0) else 0 end as n_update, case when ok then coalesce(reflow, false) else false end as reflow,
      case when ok and payload is not null then len(json_keys(payload)) else 0 end::int as n_fields, document_id is null or not ok as malformed from (select *, coalesce(json_valid(payload), true) as ok from raw_documents)""",
    "http_enrich_stub": f"""with s as (select *, coalesce(try_cast(regexp_replace(store_id, '[^0-9]', '', 'g') as int), 0) as n from stores), m as (select *, unnest(['single', 'bulk']) as mode from s)
      select store_id as document_id, mode, '{GEO}' as enricher_name, ok as success, case when not ok then 'service answered 503' end as error_message, case when ok then country end as geo_region,
        case when ok and n % 5 <> 0 then n || ',' || -n end as geo_location, case when ok then city end as geo_timezone from (select *, mode = 'bulk' or n % 7 <> 0 as ok from m)""",
    "result_rows": f"""select record_id, '{GEO}' as enricher_name, s.store_id is not null as success, case when s.store_id is null then 'not found' end as error_message, false as reflow, s.geo_region, currency
      from purchase_documents left join stores s using (store_id)""",
    "dsl_columns": "select record_id from purchase_documents where store_id = 'ST-0001' and start_time >= 1600000000000 and not coalesce(currency in ('EUR', 'USD'), false)",
    "output_documents": f"""select {_COORDINATES}, document_id, payload->>'$.storeId' as store_id,
      len(list_distinct(list_concat(json_keys(payload), ['documentId', 'timestamp'], case when existing_enrichments is null then [] else ['enrichments'] end)))::int as n_keys from {_VALID} where document_id is not null""",
    "raw_parse": f"""select {_COORDINATES}, coalesce(boomerang_update_count, 0) as n_update, case when ok then payload->>'$.storeId' end as store_id, case when ok then payload->>'$.currency' end as currency,
      case when ok then payload->>'$.firstName' end as first_name, document_id is null or not ok as dead_letter from (select *, coalesce(json_valid(payload), false) as ok from raw_documents)""",
    "guard_accept": f"select document_id, n_update, {_COORDINATES} from ({_guard_sql('document_id')}) where accepted",
    "guard_drop": f"select document_id, n_update, {_COORDINATES} from ({_guard_sql('document_id')}) where not accepted",
    "guard_per_path": f"select document_id, reflow, n_update, {_COORDINATES}, accepted from ({_guard_sql('document_id, reflow')})",
    "geo_request_map": f"""select {_COORDINATES}, 'storeId' as field, case when list_contains(json_keys(payload), 'storeId') then payload->>'$.storeId' else '' end as value from {_VALID}
      union all select {_COORDINATES}, 'country', case when list_contains(json_keys(payload), 'currency') then payload->>'$.currency' else '' end from {_VALID}
      union all select {_COORDINATES}, 'referenceDate', payload->>'$.purchaseDate' from {_VALID} where list_contains(json_keys(payload), 'purchaseDate')""",
    "geo_response_map": """select store_id, 'geo_latitude' as field, latitude::varchar as value from stores union all select store_id, 'geo_longitude', longitude::varchar from stores
      union all select store_id, 'geo_region', geo_region from stores union all select store_id, 'geo_timezone', timezone from stores
      union all select store_id, 'geo_location', latitude::varchar || ',' || longitude::varchar from stores where latitude is not null and longitude is not null""",
    "field_map": f"""select {_COORDINATES}, case k when 'storeId' then 'store_id' when 'currency' then 'currency_code' when 'geoLatitude' then 'geo_latitude' when 'geoLongitude' then 'geo_longitude' when 'geoRegion' then 'geo_region' else k end as field
      from (select *, unnest(json_keys(payload)) as k from {_VALID}) where json_type(payload, '$.' || k) <> 'NULL'""",
    "client_payload": " union all ".join(f"select record_id, '{f}' as field, {c} as value from client_documents where {c} is not null" for f, c in zip(
        M.CLIENT_FIELDS, ("client_id", "first_name", "last_name", "email", "phone", "address", "city", "country", "registration_date", "tier"), strict=True)),
    "client_typed": f"""select {_COORDINATES}, case when ok then payload->>'$.firstName' end as first_name, case when ok then payload->>'$.tier' end as tier, case when ok then payload->>'$.country' end as country
      from (select *, json_valid(payload) as ok from raw_documents where kafka_topic = 'clients-raw')""",
    "dsl_term": f"select {_KEY} as document_id from {_VALID} where payload->>'$.storeId' = 'ST-0001'",
    "dsl_bool_must": f"select {_KEY} as document_id from {_VALID} where payload->>'$.storeId' = 'ST-0001' and {_REGION} = 'US-E'",
    "dsl_geo_region": f"select {_KEY} as document_id from {_VALID} where {_REGION} = 'US-E'",
    "dsl_match_all": f"select count(*) as n from {_VALID}",
    "dsl_match": f"select {_KEY} as document_id from {_VALID} where payload->>'$.country' = 'ES'",
    "dsl_match_text": "select doc_id from documents where list_has_any(string_split_regex(lower(text), '[^\\p{L}\\p{N}_]+'), ['lighthouses', 'brücke', 'glacier'])",
    "dsl_ids": f"select {_KEY} as document_id from {_VALID} where kafka_topic = 'purchases-raw' and kafka_partition < 8 and kafka_offset in (1, 2, 3)",
    "reflow_count_slices": f"""with d as (select {_REGION} as region, payload->>'$.storeId' as store_id from {_VALID}),
      m as (select message_id, nullif(trim(case when json_valid(query_criteria) then query_criteria->>'$.region' end), '') as region, nullif(trim(case when json_valid(query_criteria) then query_criteria->>'$.storeId' end), '') as store_id from reflow_messages),
      c as (select message_id, (select count(*) from d where (m.region is null or d.region = m.region) and (m.store_id is null or d.store_id = m.store_id)) as n_documents from m),
      s as (select *, cast(case when n_documents = 0 then 0 when n_documents <= 1000 then 1 else least(10, ceil(n_documents / 1000)) end as int) as max_slices from c)
      select * exclude (d), concat_ws('-', d[1:8], d[9:12], d[13:16], d[17:20], d[21:32]) || ':' || slice_id as slice_key, max_slices > 1 as is_sliced from (
        select message_id, n_documents, cast(unnest(range(max_slices)) as int) as slice_id, max_slices from s where max_slices > 0)
      join (select message_id, md5(concat_ws('|', message_id, coalesce(enricher_name, ''), coalesce(query_criteria, ''))) as d from reflow_messages) using (message_id)""",
    "slice_partition": f"select {_KEY} as document_id, {_SLICE.format(n=4)} as slice_id from raw_documents",
    "page_first": f"select {_KEY} as document_id, (payload->>'$.{SORT}')::double as sort_value from {_VALID} order by sort_value desc nulls last, document_id limit {PAGE}",
    "page_after_cursor": f"""select {_KEY} as document_id, (payload->>'$.{SORT}')::double as sort_value from {_VALID} where payload->>'$.currency' = 'EUR' and {_SLICE.format(n=2)} = 1
      and (sort_value is null or sort_value < {CURSOR[0]} or sort_value = {CURSOR[0]} and document_id > '') order by sort_value desc nulls last, document_id limit {PAGE}""",
    "fetch_by_ids": f"""select {_KEY} as document_id, 0::bigint as boomerang_update_count, true as reflow, case when existing_enrichments is null then 0 else len(json_keys(existing_enrichments))::int end as n_existing
      from {_VALID} where reflow""",
    "enrich_lookup_single": f"""select record_id, '{GEO}' as enricher_name, s.store_id is not null as success, case when s.store_id is null then 'not found' end as error_message, s.geo_region, s.timezone as geo_timezone
      from purchase_documents left join stores s using (store_id)""",
    "bulk_batches": f"""select {_COORDINATES}, n // 20 as bulk_id, (n % 20)::int as position from (select *, row_number() over (partition by kafka_topic, kafka_partition order by kafka_offset) - 1 as n from raw_documents)""",
    "retry_outcomes": f"""select d as document_id, least(fails, {RETRIES}) + 1 as attempts, fails <= {RETRIES} as success
      from (select o_orderkey::varchar as d, ('0x' || substr(md5(d), 1, 8))::bigint % {WORSE} as fails from orders)""",
    "realtime_pipeline": _pipeline_sql("true"),
    "offline_pipeline": _pipeline_sql("reflow"),
    "join_partial": f"select document_id, reported from ({_pipeline_sql('true')}) where is_partial",
    "union_results": f"with {_RESULTS} select enricher_name, reflow, success, count(*) as n_results, count(distinct document_id) as n_documents from results group by all",
    "carry_forward_merge": f"""with r as (select * from {_VALID} where existing_enrichments is not null and document_id is not null),
      old as (select r.*, unnest(json_keys(existing_enrichments)) as enricher_name from r),
      kept as (select {_COORDINATES}, enricher_name, unnest(json_keys(existing_enrichments, '$."' || enricher_name || '"')) as field, existing_enrichments from old left join stores s on payload->>'$.storeId' = s.store_id where s.store_id is null or enricher_name <> '{GEO}')
      select {_COORDINATES}, enricher_name, field, case when field = 'geo_region' then existing_enrichments->('$."' || enricher_name || '"')->>'$.geo_region' end as value from kept
      union all select {_COORDINATES}, '{GEO}', 'geo_region', s.geo_region from r join stores s on payload->>'$.storeId' = s.store_id""",
    "merged_document": f"""with r as (select * from {_VALID} where document_id is not null), k as (select *, unnest(json_keys(payload)) as field from r)
      select {_COORDINATES}, field, case when json_type(payload, '$.' || field) = 'VARCHAR' then payload->>('$.' || field) end as value from k where field not in ('documentId', 'timestamp', 'enrichments')
      union all select {_COORDINATES}, 'documentId', document_id from r union all select {_COORDINATES}, 'timestamp', null from r
      union all select {_COORDINATES}, 'enrichments', null from r where existing_enrichments is not null""",
}

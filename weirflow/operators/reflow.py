"""Reflow: requests become counted slices of the stored documents they concern.

``plan_slices`` plans many requests at once: requests of the geo form are two optional equalities, so counting
them is a join with counts per value, not a scan per request. ``slices_of`` plans one request of any query.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import exists, publish_text, read_text
from ..sources.docstore import DocStore
from ..sources.messages import blank
from ..sources.query import geo_reflow_query


def slice_count(count: Column, threshold: int = 10_000, max_slices: int = 10) -> Column:
    """0 for nothing, 1 up to the threshold, else as many as keep slices below it, within the limit."""
    n = F.least(F.lit(max_slices), F.ceil(count / F.lit(threshold)))
    return F.when(count == 0, 0).when(count <= threshold, 1).otherwise(n).cast("int")


def request_id(*columns: str) -> Column:
    """A request's id in the form of a UUID, from what tells the request apart, so that a replay gives the same one."""
    digest = F.md5(F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)))
    return F.concat_ws("-", *(F.substring(digest, start, n) for start, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))


def explode_slices(requests: DataFrame, count: str = "n_documents", threshold: int = 10_000, max_slices: int = 10) -> DataFrame:
    """One row per slice: slice_id and max_slices; requests without documents give none."""
    n = slice_count(F.col(count), threshold, max_slices)
    return requests.withColumn("max_slices", n).where("max_slices > 0").withColumn("slice_id", F.explode(F.sequence(F.lit(0), F.col("max_slices") - 1)))


def geo_criteria(requests: DataFrame) -> DataFrame:
    """Region and store of each request's criteria, null where blank."""
    criteria = F.try_parse_json("query_criteria")
    part = lambda name: F.try_variant_get(criteria, f"$.{name}", "string")
    return requests.select("*", *(F.when(~blank(part(a)), part(a)).alias(b) for a, b in (("region", "region"), ("storeId", "store_id"))))


def geo_counts(requests: DataFrame, documents: DataFrame) -> DataFrame:
    """``n_documents`` of each geo request; ``documents`` has region and store_id.

    Documents are counted once per (region, store) with their totals; each request takes the row of its own
    two values, where an absent value means all.
    """
    grouped = documents.cube("region", "store_id").agg(F.count("*").alias("n_documents"), F.grouping("region").alias("any_region"), F.grouping("store_id").alias("any_store"))
    grouped = grouped.where("(any_region = 1 or region is not null) and (any_store = 1 or store_id is not null)")
    wanted = requests.withColumn("any_region", F.col("region").isNull().cast("byte")).withColumn("any_store", F.col("store_id").isNull().cast("byte"))
    left, right = wanted.alias("r"), grouped.alias("g")
    same = (F.col("r.any_region") == F.col("g.any_region")) & (F.col("r.any_store") == F.col("g.any_store")) & F.col("r.region").eqNullSafe(F.col("g.region")) & F.col("r.store_id").eqNullSafe(F.col("g.store_id"))
    return left.join(right, same, "left").select("r.*", F.coalesce("g.n_documents", F.lit(0)).alias("n_documents")).drop("any_region", "any_store")


def plan_slices(requests: DataFrame, documents: DataFrame, threshold: int = 10_000, max_slices: int = 10) -> DataFrame:
    return explode_slices(geo_counts(geo_criteria(requests), documents), threshold=threshold, max_slices=max_slices)


def slices_of(store: DocStore, criteria: dict | None, threshold: int = 10_000, max_slices: int = 10, to_query=geo_reflow_query) -> list[tuple[dict, int, int]]:
    """Query, slice and number of slices for one request."""
    query = to_query(criteria)
    count = store.count(query)
    if count == 0:
        return []
    n = 1 if count <= threshold else min(max_slices, -(-count // threshold))
    return [(query, i, n) for i in range(n)]


def stage_reflow(messages: DataFrame, batch_id: int, store: DocStore, folder: str, threshold: int = 10_000, max_slices: int = 10, to_query=geo_reflow_query) -> None:
    """``foreachBatch`` body: fetches what the batch's requests ask for and writes it as JSON lines of raw messages, a folder per slice.

    ``to_query`` makes a query of the criteria; as a mapping it does so by enricher, and requests for others are left out.
    The slices are planned once and the plan is kept beside ``folder``, so a replayed batch goes on with the slices that aren't
    written yet. Requests are few; documents never pass the driver.
    """
    spark, folder = messages.sparkSession, folder.rstrip("/")
    kept = f"{folder}-plans/{batch_id}"
    if not exists(spark, kept):
        query_of = to_query.get if isinstance(to_query, dict) else lambda _: to_query
        rows = messages.select("enricher_name", "query_criteria").distinct().collect()
        asked = [(r.enricher_name, json.loads(r.query_criteria) if r.query_criteria else None) for r in rows if query_of(r.enricher_name) is not None]
        plan = [(name, *slice_) for name, criteria in asked for slice_ in slices_of(store, criteria, threshold, max_slices, query_of(name))]
        publish_text(spark, kept, json.dumps(plan))
    for k, (name, query, i, n) in enumerate(json.loads(read_text(spark, kept))):
        path = f"{folder}/batch={batch_id}-{k}"
        if not exists(spark, f"{path}/_SUCCESS"):
            part = store.fetch_slice(query, i, n).select(F.to_json(F.struct(
                F.col("document_id").alias("documentId"), "payload", F.col("boomerang_update_count").alias("boomerangUpdateCount"), "timestamp", "reflow",
                F.col("existing_enrichments").alias("existingEnrichments"), F.lit(name).alias("enricherName"))).alias("value"))
            part.write.mode("overwrite").text(path)

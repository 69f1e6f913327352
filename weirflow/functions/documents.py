"""Merging of documents: maps of VARIANT values, where a later key wins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import ENRICHMENTS, OBJECT


def overlay(existing: Column, new: Column) -> Column:
    """Existing enrichments overlaid with the new ones that aren't null; an enricher's fields are replaced as a whole."""
    fresh = F.map_filter(new, lambda _, v: v.isNotNull())
    kept = F.map_filter(existing, lambda k, _: ~F.array_contains(F.map_keys(fresh), k))
    return F.when(existing.isNull(), fresh).when(new.isNull(), existing).otherwise(F.map_concat(kept, fresh))


def merged(payload: Column, document_id: Column, timestamp: Column, enrichments: Column, update_count: Column | None = None) -> Column:
    """The output document as one map: payload, then documentId, timestamp and enrichments, each of which beats a payload key of its name."""
    value = lambda c: F.variant_get(F.parse_json(F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"})), "$.v", "variant")
    own = {"documentId": value(document_id), "timestamp": value(timestamp)}
    if update_count is not None:
        own["boomerangUpdateCount"] = value(update_count)
    names = [*own, "enrichments"]
    rest = F.map_filter(payload, lambda k, _: ~k.isin(names))
    top = F.create_map(*[x for k, v in own.items() for x in (F.lit(k), v)])
    with_enrichments = F.map_concat(top, F.create_map(F.lit("enrichments"), value(enrichments)))
    top = F.when(enrichments.isNull(), top).otherwise(with_enrichments)
    return F.when(payload.isNull(), top).otherwise(F.map_concat(rest, top))


def object_of(json: Column) -> Column:
    """A JSON string's top-level object as a map; null for anything else."""
    return F.try_variant_get(F.try_parse_json(json), "$", OBJECT)


def enrichments_of(source: Column) -> Column:
    """The existing enrichments of a stored document (a map): the object under ``enrichments``, else an empty map."""
    found = F.try_variant_get(F.try_element_at(source, F.lit("enrichments")), "$", ENRICHMENTS)
    return F.coalesce(found, F.expr("map_from_arrays(cast(array() as array<string>), cast(array() as array<map<string, variant>>))"))


def update_count_of(value: Column) -> Column:
    """A numeric VARIANT as a whole number, cut; anything else, a string of digits too, is 0."""
    kind = F.schema_of_variant(value)
    return F.coalesce(F.when(kind.rlike(r"^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL)"), F.try_variant_get(value, "$", "double").try_cast("bigint")), F.lit(0).cast("bigint"))

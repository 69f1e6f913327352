"""Request, response and field mappings. Maps are ``map<string, variant>``, requests ``map<string, string>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import CLIENT_FIELDS

#: Logical to physical field names (fixed values).
FIELD_NAMES = {"storeId": "store_id", "currency": "currency_code", "geoLatitude": "geo_latitude", "geoLongitude": "geo_longitude", "geoRegion": "geo_region"}


def text_of(m: Column, key: str) -> Column:
    return F.try_variant_get(F.try_element_at(m, F.lit(key)), "$", "string")


def get_or(m: Column, key: str, default: str) -> Column:
    """The value of a key, which may be null; the default only if the key is absent."""
    return F.when(F.map_contains_key(m, key), text_of(m, key)).otherwise(F.lit(default))


def geo_request(payload: Column) -> Column:
    """What the geo service is asked: store, country (from the currency), and the reference date if the payload has one."""
    base = F.create_map(F.lit("storeId"), get_or(payload, "storeId", ""), F.lit("country"), get_or(payload, "currency", ""))
    return F.when(F.map_contains_key(payload, "purchaseDate"), F.map_concat(base, F.create_map(F.lit("referenceDate"), text_of(payload, "purchaseDate")))).otherwise(base)


def geo_response(latitude: Column, longitude: Column, region: Column, timezone: Column) -> Column:
    """The geo enrichment, as strings; nulls are kept, a location is added if both coordinates are there."""
    lat, lon = latitude.cast("string"), longitude.cast("string")
    base = F.create_map(F.lit("geo_latitude"), lat, F.lit("geo_longitude"), lon, F.lit("geo_region"), region, F.lit("geo_timezone"), timezone)
    return F.when(lat.isNotNull() & lon.isNotNull(), F.map_concat(base, F.create_map(F.lit("geo_location"), F.concat_ws(",", lat, lon)))).otherwise(base)


def strict_request(payload: Column) -> Column:
    """The alternative request: store_id and currency_code; an error if either is missing."""
    store, currency = text_of(payload, "storeId"), text_of(payload, "currency")
    return F.when(store.isNull() | currency.isNull(), F.raise_error(F.lit("storeId and currency are required"))).otherwise(F.create_map(F.lit("store_id"), store, F.lit("currency_code"), currency))


def strict_response(latitude: Column, longitude: Column, region: Column) -> Column:
    """The alternative response mapping; an error if a part is missing."""
    values = latitude.cast("string"), longitude.cast("string"), region
    missing = values[0].isNull() | values[1].isNull() | values[2].isNull()
    return F.when(missing, F.raise_error(F.lit("latitude, longitude and region are required"))).otherwise(F.create_map(F.lit("geo_latitude"), values[0], F.lit("geo_longitude"), values[1], F.lit("geo_region"), values[2]))


def physical_name(name: Column) -> Column:
    out = name
    for logical, physical in FIELD_NAMES.items():
        out = F.when(name == logical, F.lit(physical)).otherwise(out)
    return out


def rename_fields(m: Column) -> Column:
    """A map with physical key names; an error if two keys become one or a value is null."""
    renamed = F.transform_keys(m, lambda k, _: F.concat(physical_name(k), F.lit("\x00"), k))
    names = F.transform(F.map_keys(renamed), lambda k: F.substring_index(k, "\x00", 1))
    clash = F.size(F.array_distinct(names)) < F.size(names)
    empty = F.exists(F.map_values(m), lambda v: v.isNull())
    return F.when(clash, F.raise_error(F.lit("two fields have one physical name"))).when(empty, F.raise_error(F.lit("a field is null"))).otherwise(F.map_from_arrays(names, F.map_values(m)))


def client_payload(client: dict[str, Column]) -> Column:
    """A typed client as a payload map without its null fields."""
    return F.map_filter(F.create_map(*[x for f in CLIENT_FIELDS for x in (F.lit(f), client[f].cast("string"))]), lambda _, v: v.isNotNull())


def client_of(payload: Column) -> Column:
    """A payload map (VARIANT values) as a typed client; a null payload is an empty client."""
    return F.struct(*(text_of(payload, f).alias(f) for f in CLIENT_FIELDS))


def success(document_id: Column, enricher: Column, fields: Column, payload: Column, count: Column, reflow: Column, existing: Column) -> list[Column]:
    return _result(document_id, enricher, fields, payload, count, F.lit(True), F.lit(None).cast("string"), reflow, existing)


def failure(document_id: Column, enricher: Column, payload: Column, count: Column, error: Column, reflow: Column, existing: Column) -> list[Column]:
    return _result(document_id, enricher, F.lit(None).cast("map<string,variant>"), payload, count, F.lit(False), error, reflow, existing)


def _result(document_id, enricher, fields, payload, count, ok, error, reflow, existing) -> list[Column]:
    named = {"document_id": document_id, "enricher_name": enricher, "enriched_fields": fields, "original_payload": payload, "boomerang_update_count": count, "success": ok, "error_message": error, "reflow": reflow, "existing_enrichments": existing}
    return [*(c.alias(n) for n, c in named.items()), F.unix_millis(F.current_timestamp()).alias("timestamp")]


def slice_key(request_id: Column, slice_id: Column) -> Column:
    return F.concat_ws(":", request_id, slice_id.cast("string"))


def is_sliced(max_slices: Column) -> Column:
    return max_slices > 1

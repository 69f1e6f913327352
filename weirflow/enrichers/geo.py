"""The geo enricher of purchases, over HTTP."""

from __future__ import annotations

from typing import Any

from ..sources.query import geo_reflow_query
from .http import HttpEnricher

#: Response field to enrichment field (fixed values).
RESPONSE = {"latitude": "geo_latitude", "longitude": "geo_longitude", "region": "geo_region", "timezone": "geo_timezone"}


class PurchaseGeoEnricher(HttpEnricher):
    def map_request(self, document_id: str, payload: dict) -> dict:
        request = {"storeId": payload.get("storeId", ""), "country": payload.get("currency", "")}
        if "purchaseDate" in payload:
            request["referenceDate"] = payload["purchaseDate"]
        return request

    def map_response(self, document_id: str, payload: dict, response: Any) -> dict | None:
        if response is None:
            return None
        fields = {new: response.get(old) for old, new in RESPONSE.items()}
        if fields["geo_latitude"] is not None and fields["geo_longitude"] is not None:
            fields["geo_location"] = f"{fields['geo_latitude']},{fields['geo_longitude']}"
        return fields

    def reflow_query(self, criteria: dict | None) -> dict:
        return geo_reflow_query(criteria)

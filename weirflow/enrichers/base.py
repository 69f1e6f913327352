"""What an enricher is, and how one is made from its class name."""

from __future__ import annotations

import importlib
from typing import Any


class Enricher:
    """Maps a document to a request, calls a service, maps its response. Instances live on executors.

    ``call`` answers one request; ``call_bulk`` answers many at once, in order, and may be left out.
    """

    supports_bulk = False

    def open(self, properties: dict[str, str]) -> None:
        self.properties = properties

    def close(self) -> None:
        pass

    def map_request(self, document_id: str, payload: dict) -> dict:
        return payload

    def map_response(self, document_id: str, payload: dict, response: Any) -> dict | None:
        return response

    def map_field(self, name: str) -> str:
        return name

    def reflow_query(self, criteria: dict | None) -> dict:
        return criteria or {"match_all": {}}

    def call(self, document_id: str, request: dict) -> Any:
        raise NotImplementedError

    def call_bulk(self, requests: list[dict]) -> list:
        raise NotImplementedError("this enricher has no bulk call")

    def enrich(self, document_id: str, payload: dict) -> dict | None:
        return self.map_response(document_id, payload, self.call(document_id, self.map_request(document_id, payload)))

    def enrich_bulk(self, documents: list[tuple[str, dict]]) -> list[dict | None]:
        """One call; a response shorter than the request is padded with empty answers."""
        answers = self.call_bulk([self.map_request(d, p) for d, p in documents])
        answers = [*answers, *[{}] * (len(documents) - len(answers))]
        return [self.map_response(d, p, a) for (d, p), a in zip(documents, answers, strict=False)]


def create(class_name: str, properties: dict[str, str] | None = None) -> Enricher:
    """An opened enricher of the class ``module.Class``: ValueError if it is no Enricher, RuntimeError if it can't be made."""
    try:
        module, _, name = class_name.rpartition(".")
        kind = getattr(importlib.import_module(module), name)
    except Exception as e:
        raise RuntimeError(f"cannot load enricher {class_name}: {e}") from e
    if not (isinstance(kind, type) and issubclass(kind, Enricher)):
        raise ValueError(f"{class_name} is no Enricher")
    try:
        enricher = kind()
        enricher.open(properties or {})
    except Exception as e:
        raise RuntimeError(f"cannot create enricher {class_name}: {e}") from e
    return enricher

"""An enricher that posts JSON to a service."""

from __future__ import annotations

import json
import urllib.error
import urllib.request
from typing import Any

from .base import Enricher


class HttpEnricher(Enricher):
    """Properties: apiUrl, bulkApiUrl (else apiUrl), timeoutMs (5000). A status that isn't 2xx is an error."""

    supports_bulk = True

    def open(self, properties: dict[str, str]) -> None:
        super().open(properties)
        self.url = properties["apiUrl"]
        self.bulk_url = properties.get("bulkApiUrl") or self.url
        self.timeout = int(properties.get("timeoutMs") or 5000) / 1000

    def _post(self, url: str, body: Any, headers: dict[str, str]) -> Any:
        request = urllib.request.Request(url, json.dumps(body).encode(), {"Content-Type": "application/json", **headers})
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as answer:
                return json.loads(answer.read() or b"null")
        except urllib.error.HTTPError as e:
            raise RuntimeError(f"service answered {e.code}") from e

    def call(self, document_id: str, request: dict) -> Any:
        return self._post(self.url, request, {"X-Document-Id": document_id})

    def call_bulk(self, requests: list[dict]) -> list:
        answer = self._post(self.bulk_url, requests, {})
        if not isinstance(answer, list):
            raise RuntimeError("the bulk answer is no array")
        return answer

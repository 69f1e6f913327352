"""Guard and joiner as stateful processors. Values in state are JSON strings and scalars."""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _struct(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, k) for n, k in kinds.items()])


S, L, B = T.StringType(), T.LongType(), T.BooleanType()
#: Of a guarded document, per enricher and path; ``seq`` orders the rows of one micro-batch.
DOCUMENT = _struct(document_id=S, enricher_name=S, path=S, seq=L, boomerang_update_count=L, reflow=B, payload_json=S, existing_json=S, timestamp=L)
RESULT = _struct(document_id=S, enricher_name=S, seq=L, reflow=B, success=B, payload_json=S, fields_json=S, existing_json=S, boomerang_update_count=L)
OUTPUT = _struct(document_id=S, original_payload=S, enrichments=S, is_partial=B, boomerang_update_count=L)


class Guard(StatefulProcessor):
    """Passes rows whose update count isn't below the greatest one accepted; the state is that count.

    Realtime documents of enrichers in ``free`` all pass, and keep no state.
    """

    def __init__(self, free: list[str]):
        self.free = frozenset(free)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.top = handle.getValueState("top", _struct(n=L))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        if key[1] in self.free and key[2] == "realtime":
            yield from rows
            return
        top = self.top.get()[0] if self.top.exists() else None
        for row in sorted(rows, key=lambda r: r.seq):
            n = row.boomerang_update_count or 0
            if top is None or n >= top:
                top = n
                yield row
        if top is not None:
            self.top.update((top,))

    def close(self) -> None:
        pass


class Joiner(StatefulProcessor):
    """Collects the results of a document until all expected enrichers reported, or the timeout after the first.

    On completion the timer is deleted, so nothing is emitted twice; a result that comes later opens a new cycle.
    """

    def __init__(self, all_names: list[str], reflow_names: list[str], timeout_ms: int = 30_000, triggering_only: bool = False):
        self.all_names, self.reflow_names = frozenset(all_names), frozenset(reflow_names)
        self.timeout_ms, self.triggering_only = timeout_ms, triggering_only

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.first = handle.getValueState("first", _struct(payload=S, reflow=B, timer=L, n=L))
        self.existing = handle.getValueState("existing", _struct(json=S))
        self.reported = handle.getMapState("reported", _struct(name=S), _struct(json=S))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        for row in sorted(rows, key=lambda r: r.seq):
            if not self.first.exists():
                timer = timerValues.getCurrentProcessingTimeInMs() + self.timeout_ms
                self.handle.registerTimer(timer)
                self.first.update((row.payload_json, bool(row.reflow), timer, row.boomerang_update_count))
            if row.reflow and row.existing_json is not None and not self.existing.exists():
                self.existing.update((row.existing_json,))
            self.reported.updateValue((row.enricher_name,), (row.fields_json if row.success else None,))
            names = {k[0] for k in self.reported.keys()}
            expected = self.all_names if not self.first.get()[1] else self.reflow_names & names if self.triggering_only else self.reflow_names
            if expected <= names:
                self.handle.deleteTimer(self.first.get()[2])
                yield self._emit(key, False)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        if self.first.exists():
            yield self._emit(key, True)

    def _emit(self, key: Any, partial: bool) -> Row:
        payload, _, _, n = self.first.get()
        merged = json.loads(self.existing.get()[0]) if self.existing.exists() else {}
        for (name,), (fields,) in self.reported.iterator():
            if fields is not None:
                merged[name] = json.loads(fields)
        for state in (self.first, self.existing, self.reported):
            state.clear()
        return Row(document_id=key[0], original_payload=payload, enrichments=json.dumps(merged), is_partial=partial, boomerang_update_count=n)

    def close(self) -> None:
        pass


def guard(documents: DataFrame, free: list[str] | None = None) -> DataFrame:
    """A stream of ``DOCUMENT`` rows, without the stale ones per document, enricher and path; realtime ones of enrichers in ``free`` aren't looked at."""
    rows = documents.select(*DOCUMENT.names)
    return rows.groupBy("document_id", "enricher_name", "path").transformWithState(statefulProcessor=Guard(free or []), outputStructType=DOCUMENT, outputMode="Append", timeMode="None")


def join(results: DataFrame, all_names: list[str], reflow_names: list[str], timeout_ms: int = 30_000, triggering_only: bool = False, by_version: bool = False) -> DataFrame:
    """A stream of ``RESULT`` rows as assembled documents, one per document, or per document and update count; its count is the first result's."""
    rows = results.select(*RESULT.names)
    return rows.groupBy("document_id", *(["boomerang_update_count"] if by_version else [])).transformWithState(statefulProcessor=Joiner(all_names, reflow_names, timeout_ms, triggering_only), outputStructType=OUTPUT, outputMode="Append", timeMode="ProcessingTime")

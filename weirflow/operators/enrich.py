"""Running enrichers: lookups as joins, services in Arrow batches with concurrency, limits, timeouts and retries.

``lookup`` joins a table of answers; a miss is a failure. ``call_services`` runs enrichers within the
partitions, each for the documents that are meant for it, so any number of them reads its input once: up to ``capacity`` documents in flight, in input order, singly or in bulks, within a rate limit that is
the partitions' share of a global one. Every error becomes a failure row. Reflow documents that failed are read
again and tried again: within the partition where a store's client is given (``retried``), else by ``call_with_retry``.
"""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from concurrent.futures import TimeoutError as Late
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..enrichers.base import Enricher, create

TIMED_OUT = {False: "Async enrichment timed out", True: "Async bulk enrichment timed out"}
NO_ANSWER = "the enricher returned nothing"


@dataclass
class Service:
    """How to call one enricher."""

    name: str
    class_name: str
    properties: dict[str, str] = field(default_factory=dict)
    bulk_size: int = 0  # 0: singly
    capacity: int = 100
    timeout_ms: int = 30_000
    rate_per_second: float = 0.0
    max_retries: int = 3
    retry_delay_ms: int = 5000


def lookup(documents: DataFrame, answers: DataFrame, on: str, name: str, fields: Column) -> DataFrame:
    """Results of an enricher that is a table: ``fields`` of the matching answer; no match is a failure."""
    found = answers.select(F.col(on), fields.alias("enriched_fields"), F.lit(True).alias("_hit"))
    rows = documents.join(found, on, "left").withColumn("success", F.col("_hit").isNotNull()).drop("_hit")
    return rows.withColumn("enricher_name", F.lit(name)).withColumn("error_message", F.when(~F.col("success"), F.lit("not found")))


class Limiter:
    """Permits at an even pace; none needed at rate 0."""

    def __init__(self, per_second: float):
        self.step, self.next, self.lock = (1 / per_second if per_second > 0 else 0.0), 0.0, threading.Lock()

    def acquire(self) -> None:
        if not self.step:
            return
        with self.lock:
            now = time.monotonic()
            at = max(now, self.next)
            self.next = at + self.step
        time.sleep(max(0.0, at - now))


Result = tuple[dict | None, bool, str | None]


def run_single(enricher: Enricher, limiter: Limiter, document: tuple[str, dict]) -> Result:
    try:
        limiter.acquire()
        return enricher.enrich(*document), True, None
    except Exception as e:  # noqa: BLE001 - any error is a failure of this document only
        return None, False, str(e) or type(e).__name__


def run_bulk(enricher: Enricher, limiter: Limiter, documents: list[tuple[str, dict]]) -> list[Result]:
    try:
        limiter.acquire()
        answers = enricher.enrich_bulk(documents)
    except Exception as e:  # noqa: BLE001
        return [(None, False, str(e) or type(e).__name__)] * len(documents)
    answers = [*answers, *[None] * (len(documents) - len(answers))]
    return [(a, True, None) if a is not None else (None, False, NO_ANSWER) for a in answers[: len(documents)]]


def run_all(enricher: Enricher, limiter: Limiter, documents: list[tuple[str, dict]], bulk_size: int, capacity: int, timeout_ms: int) -> list[Result]:
    """One result per document, in their order."""
    bulk = bulk_size > 0
    parts = [documents[i : i + bulk_size] for i in range(0, len(documents), bulk_size)] if bulk else documents
    workers = max(1, min(len(parts), capacity // max(1, bulk_size)))
    pool = ThreadPoolExecutor(workers)
    try:
        # No more than the capacity is handed out at a time, so an element's clock starts when it may run.
        waiting: list[tuple[Future, float, int]] = []
        out: list[Result] = []

        def finish() -> None:
            future, began, n = waiting.pop(0)
            try:
                got = future.result(max(0.0, began + timeout_ms / 1000 - time.monotonic()))
                out.extend(got if bulk else [got])
            except Late:
                future.cancel()
                out.extend([(None, False, TIMED_OUT[bulk])] * n)

        for part in parts:
            if len(waiting) >= workers:
                finish()
            waiting.append((pool.submit(run_bulk if bulk else run_single, enricher, limiter, part), time.monotonic(), len(part) if bulk else 1))
        while waiting:
            finish()
        return out
    finally:
        pool.shutdown(wait=False, cancel_futures=True)


#: Gives the current payloads of documents by id; those that are gone are left out.
Refetch = Callable[[list[str]], dict[str, dict]]
GONE = "document not found"


def retried(enricher: Enricher, limiter: Limiter, documents: list[tuple[str, dict]], results: list[Result], again: list[bool], service: Service, refetch: Refetch) -> tuple[list[tuple[str, dict]], list[Result]]:
    """Documents and results after failures marked in ``again`` were read and tried again, up to ``max_retries`` times with the delay before each.

    A document that is gone fails at once; an error of the reading takes up one retry.
    """
    documents, results = [*documents], [*results]
    waiting = [i for i, (_, ok, _) in enumerate(results) if again[i] and not ok]
    for _ in range(service.max_retries):
        if not waiting:
            break
        time.sleep(service.retry_delay_ms / 1000)
        try:
            fresh = refetch(sorted({documents[i][0] for i in waiting}))
        except Exception as e:  # noqa: BLE001
            for i in waiting:
                results[i] = (None, False, f"re-fetch failed: {e}")
            continue
        for i in waiting:
            if documents[i][0] not in fresh:
                results[i] = (None, False, GONE)
        waiting = [i for i in waiting if documents[i][0] in fresh]
        for i in waiting:
            documents[i] = (documents[i][0], fresh[documents[i][0]])
        got = run_all(enricher, limiter, [documents[i] for i in waiting], service.bulk_size, service.capacity, service.timeout_ms)
        for i, result in zip(waiting, got, strict=True):
            results[i] = result
        waiting = [i for i in waiting if not results[i][1]]
    return documents, results


def _update_count(payload: dict) -> int:
    n = payload.get("boomerangUpdateCount")
    return int(n) if isinstance(n, (int, float)) and not isinstance(n, bool) else 0


class _Runner:
    """One enricher within a partition, made when it is first needed."""

    def __init__(self, service: Service, partitions: int, make: Callable[[], Enricher] | None, refetch: Refetch | None):
        self.service, self.make, self.refetch = service, make, refetch if service.max_retries > 0 else None
        self.limiter, self.enricher = Limiter(service.rate_per_second / partitions), None

    def __call__(self, documents: list[tuple[str, dict]], again: list[bool]) -> tuple[list[tuple[str, dict]], list[Result]]:
        """Documents as they were read last, and their results."""
        self.enricher = self.enricher or (self.make() if self.make else create(self.service.class_name, self.service.properties))
        got = run_all(self.enricher, self.limiter, documents, self.service.bulk_size, self.service.capacity, self.service.timeout_ms)
        return retried(self.enricher, self.limiter, documents, got, again, self.service, self.refetch) if self.refetch else (documents, got)

    def close(self) -> None:
        if self.enricher:
            self.enricher.close()


def call_services(documents: DataFrame, services: dict[str, Service], partitions: int | None = None, makes: dict[str, Callable[[], Enricher]] | None = None, refetch: Refetch | None = None) -> DataFrame:
    """Adds enriched_fields (JSON), success and error_message to documents with document_id, enricher_name and payload_json.

    Each document goes to the service of its enricher_name; one without a service is an error. Rate limits are divided by the number of
    partitions, which therefore is set here if there is a limit: to ``partitions``, else to the session's shuffle partitions. With
    ``refetch``, rows whose ``reflow`` is true are tried again when they fail; payload_json and boomerang_update_count are those
    of the document read last.
    """
    columns = documents.columns
    if partitions or any(s.rate_per_second for s in services.values()):
        partitions = partitions or int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        documents = documents.repartition(partitions)
    parts, makes = partitions or 1, makes or {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runners = {name: _Runner(s, parts, makes.get(name), refetch) for name, s in services.items()}
        try:
            for batch in batches:
                column = lambda name, batch=batch: batch.column(columns.index(name)).to_pylist()
                rows = [(d, json.loads(p) if p else {}) for d, p in zip(column("document_id"), column("payload_json"), strict=True)]
                again = [bool(x) for x in column("reflow")] if "reflow" in columns else [False] * len(rows)
                by_name: dict[str, list[int]] = {}
                for i, name in enumerate(column("enricher_name")):
                    by_name.setdefault(name, []).append(i)
                got: list[Result] = [(None, False, None)] * len(rows)
                fresh: dict[int, dict] = {}
                for name, which in by_name.items():
                    read, results = runners[name]([rows[i] for i in which], [again[i] for i in which])
                    for i, (_, payload), result in zip(which, read, results, strict=True):
                        got[i] = result
                        if payload is not rows[i][1]:
                            fresh[i] = payload
                kept = list(batch.columns)
                for name, value in (("payload_json", json.dumps), ("boomerang_update_count", _update_count)):
                    if fresh and name in columns:
                        new = [value(fresh[i]) if i in fresh else x for i, x in enumerate(column(name))]
                        kept[columns.index(name)] = pa.array(new, batch.schema.field(columns.index(name)).type)
                added = [pa.array([None if f is None else json.dumps(f) for f, _, _ in got], pa.string()), pa.array([ok for _, ok, _ in got], pa.bool_()), pa.array([e for _, _, e in got], pa.string())]
                yield pa.RecordBatch.from_arrays([*kept, *added], [*columns, "enriched_fields", "success", "error_message"])
        finally:
            for runner in runners.values():
                runner.close()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema.fields)
    return documents.mapInArrow(run, f"{schema}, enriched_fields string, success boolean, error_message string")


def call_service(documents: DataFrame, service: Service, partitions: int | None = None, make: Callable[[], Enricher] | None = None, refetch: Refetch | None = None) -> DataFrame:
    """The same for one service that all documents are meant for."""
    rows = documents.withColumn("enricher_name", F.lit(service.name))
    return call_services(rows, {service.name: service}, partitions, {service.name: make} if make else None, refetch)


def call_with_retry(documents: DataFrame, service: Service, refetch: Callable[[DataFrame], DataFrame], keep: Callable[[DataFrame, str], DataFrame], sleep: Callable[[float], None] = time.sleep, **options) -> DataFrame:
    """Reflow documents: failures are read again by id and tried again, up to ``max_retries`` times.

    ``refetch`` gives current documents for a frame of ids, in the columns of ``documents``; an id that is gone fails at
    once. ``keep`` writes a frame and reads it back, so that no service is called twice for one attempt.
    """
    results = keep(call_service(documents, service, **options), "attempt-0")
    done = None
    for attempt in range(1, service.max_retries + 1):
        good, bad = results.where("success"), results.where("not success")
        done = good if done is None else done.unionByName(good)
        if bad.isEmpty():
            return done
        sleep(service.retry_delay_ms / 1000)
        fresh = keep(refetch(bad.select("document_id").distinct()).select(*documents.columns), f"fresh-{attempt}")
        gone = bad.join(fresh.select("document_id").distinct(), "document_id", "left_anti").withColumn("error_message", F.lit(GONE))
        done = done.unionByName(gone.select(*results.columns))
        results = keep(call_service(fresh, service, **options), f"attempt-{attempt}")
    return results if done is None else done.unionByName(results)


def bulk_positions(documents: DataFrame, bulk_size: int, keys: list[str], order: list[str]) -> DataFrame:
    """The bulk of each document and its place in it, counted within ``keys`` (a source partition)."""
    from pyspark.sql.window import Window

    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    return documents.withColumn("bulk_id", F.floor(n / bulk_size).cast("bigint")).withColumn("position", (n % bulk_size).cast("int"))

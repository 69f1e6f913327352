"""Assembly of the enrichers' results per document.

In a batch: the first result gives payload, path and (of reflow results) the existing enrichments, the last
result of each enricher its fields, a failure counts as reported without fields. Complete means that all
expected enrichers reported: the reflow-enabled ones if the first result is of the reflow path, else all.
Everything is a grouping with partial aggregation; a group's state is one entry per enricher.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.documents import overlay


def joined(results: DataFrame, all_names: list[str], reflow_names: list[str], keys: list[str] | None = None, order: str = "seq", triggering_only: bool = False) -> DataFrame:
    """One row per document: original_payload, reflow, enrichments, reported, expected, is_partial.

    Order values must be unique per document. ``triggering_only`` expects of a reflow document only the enrichers that
    report at all.
    """
    keys = keys or ["document_id"]
    last = results.groupBy(*keys, "enricher_name").agg(
        F.max_by(F.struct("success", "enriched_fields"), order).alias("last"),
        F.min(order).alias("first_seq"),
        F.min_by(F.struct("original_payload", "reflow"), order).alias("first"),
        F.min(F.when(F.col("reflow") & F.col("existing_enrichments").isNotNull(), F.col(order))).alias("existing_seq"),
        F.min_by("existing_enrichments", F.when(F.col("reflow") & F.col("existing_enrichments").isNotNull(), F.col(order))).alias("existing"),
    )
    fields = F.when(F.col("last.success"), F.col("last.enriched_fields"))
    documents = last.groupBy(*keys).agg(
        F.min_by("first", "first_seq").alias("first"),
        F.min_by("existing", "existing_seq").alias("existing"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("enricher_name", "first_seq")))).alias("seen"),
        F.collect_list(F.struct(F.col("enricher_name").alias("key"), fields.alias("value"))).alias("entries"),
    )
    every, reflow = (F.array(*map(F.lit, sorted(n))).cast("array<string>") for n in (all_names, reflow_names))
    reported = F.map_keys("seen")
    expected = F.when(F.col("first.reflow"), F.array_intersect(reflow, reported) if triggering_only else reflow).otherwise(every)
    new = F.map_from_entries(F.filter("entries", lambda e: e["value"].isNotNull()))
    return documents.select(
        *keys,
        F.col("first.original_payload").alias("original_payload"),
        F.col("first.reflow").alias("reflow"),
        overlay(F.col("existing"), new).alias("enrichments"),
        reported.alias("reported"),
        expected.alias("expected"),
        (F.size(F.array_except(expected, reported)) > 0).alias("is_partial"),
    )


CYCLES = "document_id string, cycle int, started_ms bigint, emitted_ms bigint, is_partial boolean, reported string"
_EMITTED = "document_id string, segment bigint, k int, started_ms bigint, emitted_ms bigint, is_partial boolean, reported string"


def cycles(results: DataFrame, all_names: list[str], reflow_names: list[str], timeout_ms: int = 30_000) -> DataFrame:
    """The emissions of a document when results arrive over time: arrival_ms and seq order them.

    A cycle starts with a result while none is open, ends when complete or ``timeout_ms`` after it started, and
    a later result opens the next one. No cycle reaches over a pause of ``timeout_ms``, so a document's results are cut into
    segments there, which are folded by themselves: a document with very many results is spread, and a fold holds
    one open cycle only.
    """
    expect = {False: frozenset(all_names), True: frozenset(reflow_names)}
    names = [c.split()[0] for c in _EMITTED.split(", ")]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, segment, k, start, wanted, got = None, None, 0, 0, frozenset(), set()
        out: list[tuple] = []

        def close(at: int, partial: bool) -> None:
            nonlocal k, got
            out.append((doc, segment, k, start, at, partial, ",".join(sorted(got))))
            k, got = k + 1, set()

        def batch() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.string()), strict=True)], names)
            out.clear()
            return rows

        for part in batches:
            for d, s, at, name, reflow in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if got and (d != doc or s != segment or at >= start + timeout_ms):
                    close(start + timeout_ms, True)
                if d != doc or s != segment:
                    doc, segment, k = d, s, 0
                if not got:
                    start, wanted = at, expect[bool(reflow)]
                got.add(name)
                if wanted <= got:
                    close(at, False)
            if out:
                yield batch()
        if got:
            close(start + timeout_ms, True)
            yield batch()

    order = ["arrival_ms", "seq"]
    within = Window.partitionBy("document_id").orderBy(*order)
    pause = F.coalesce(F.col("arrival_ms") - F.lag("arrival_ms").over(within) >= timeout_ms, F.lit(False))
    rows = results.select("document_id", *order, "enricher_name", "reflow").where("document_id is not null").withColumn("pause", pause)
    rows = rows.withColumn("segment", F.sum(F.col("pause").cast("bigint")).over(within.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.repartition("document_id", "segment").sortWithinPartitions("document_id", "segment", *order)
    emitted = rows.select("document_id", "segment", "arrival_ms", "enricher_name", "reflow").mapInArrow(fold, _EMITTED)
    number = F.row_number().over(Window.partitionBy("document_id").orderBy("segment", "k"))
    return emitted.withColumn("cycle", number).select(*(c.split()[0] for c in CYCLES.split(", ")))

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from weirflow import config, sinks
from weirflow.enrichers.base import Enricher
from weirflow.operators import reflow
from weirflow.plans import pipeline
from weirflow.sources import messages
from weirflow.sources.docstore import DocStore
from weirflow.streaming import processors


class Echo(Enricher):
    """Answers with the version it saw; fails on demand."""

    def call(self, document_id, request):
        if request.get("fail") == self.properties["me"]:
            raise RuntimeError("told to")
        return {self.properties["me"]: request.get("v")}


def cfg(mode="REALTIME", timeout=60_000):
    one = lambda n, on: {"name": n, "consumerGroup": "g", "reflowTopic": "r", "reflowEnabled": on, "className": "tests.test_streaming.Echo", "asyncTimeoutMs": 10, "properties": {"me": n}}
    return config.from_mapping({"mode": mode, "kafka": {"rawTopic": "raw", "outputTopic": "out"}, "joiner": {"timeoutMs": timeout}, "enrichers": [one("a", True), one("b", False)]})


def until(query, rows, n, seconds=170):
    """Run a query until it has written n rows."""
    end = time.time() + seconds
    try:
        while len(got := rows()) < n and time.time() < end:
            assert query.isActive
            time.sleep(0.5)
        return got
    finally:
        query.stop()


def read(spark, folder):
    if not os.path.isdir(folder):
        return []
    return [json.loads(r.value) for r in spark.read.text(folder).collect()]


def test_realtime_stream(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    doc = lambda d, n, **p: json.dumps({"documentId": d, "payload": p, "boomerangUpdateCount": n, "timestamp": 1})
    (tmp_path / "raw" / "1.json").write_text("\n".join([doc("x", 2, v=2), doc("y", 0, v=1, fail="a"), "{broken"]))
    out = str(tmp_path / "out")
    values = pipeline.stream_documents(spark, cfg(), raw_folder=str(tmp_path))
    query = sinks.write(values, str(tmp_path / "checkpoint"), folder=out)
    got = {d["documentId"]: d for d in until(query, lambda: read(spark, out), 2)}
    assert {d: r["enrichments"] for d, r in got.items()} == {"x": {"a": {"a": 2}, "b": {"b": 2}}, "y": {"b": {"b": 1}}}
    assert got["x"]["v"] == 2
    # A stale version is stopped by the guard of a, so the joiner waits for it; b's result alone is no document yet.
    (tmp_path / "raw" / "2.json").write_text(doc("x", 1, v=1) + "\n" + doc("z", 0, v=5))
    query = sinks.write(pipeline.stream_documents(spark, cfg(), raw_folder=str(tmp_path)), str(tmp_path / "checkpoint"), folder=out)
    docs = until(query, lambda: read(spark, out), 3)
    assert sorted(d["documentId"] for d in docs) == ["x", "y", "z"]


def test_timeout_emits_once_and_no_ghosts(spark, tmp_path):
    rows = [("d", "a", 1, False, True, "{}", '{"k": 1}', None, 0), ("e", "a", 1, True, True, "{}", None, '{"b": {"old": 1}}', 0), ("f", "a", 1, False, True, "{}", '{"k": 2}', None, 0), ("f", "b", 2, False, False, "{}", None, None, 0)]
    spark.createDataFrame(rows, processors.RESULT).coalesce(1).write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema(processors.RESULT).json(str(tmp_path / "in"))
    joined = processors.join(stream, ["a", "b"], ["a"], timeout_ms=1500)
    query = joined.writeStream.format("memory").queryName("emitted").option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="500 milliseconds").outputMode("append").start()
    try:
        end = time.time() + 90
        while spark.table("emitted").count() < 3 and time.time() < end:
            time.sleep(0.5)
        time.sleep(3)
        got = sorted((r.document_id, json.loads(r.enrichments), r.is_partial) for r in spark.table("emitted").collect())
    finally:
        query.stop()
    assert got == [("d", {"a": {"k": 1}}, True), ("e", {"b": {"old": 1}}, False), ("f", {"a": {"k": 2}}, False)]


def test_reflow_goes_round(spark, tmp_path):
    store = DocStore(spark.createDataFrame([(f"d{i}", json.dumps({"storeId": "A" if i % 2 else "B", "v": i, "boomerangUpdateCount": i, "enrichments": {"b": {"old": i}}})) for i in range(6)], "document_id string, source string"))
    requests = spark.createDataFrame([("a", '{"storeId": "A"}'), ("a", '{"storeId": "A"}'), ("a", '{"storeId": "none"}')], "enricher_name string, query_criteria string")
    for _ in range(2):
        reflow.stage_reflow(requests, 0, store, str(tmp_path / "staged"), threshold=2, max_slices=10)
    assert spark.read.text(str(tmp_path / "staged") + "/*").count() == 3
    values = pipeline.stream_documents(spark, cfg("OFFLINE"), staged_folder=str(tmp_path / "staged"))
    query = sinks.write(values, str(tmp_path / "checkpoint"), folder=str(tmp_path / "out"))
    got = {d["documentId"]: d["enrichments"] for d in until(query, lambda: read(spark, str(tmp_path / "out")), 3)}
    assert got == {f"d{i}": {"a": {"a": i}, "b": {"old": i}} for i in (1, 3, 5)}


class Interrupted(DocStore):
    """Fails at its second slice until told otherwise, and counts what it fetches."""

    fetched, healthy = (), False

    def fetch_slice(self, query, slice_id=0, max_slices=1):
        if slice_id == 1 and not self.healthy:
            raise OSError("lost")
        self.fetched = (*self.fetched, slice_id)
        return super().fetch_slice(query, slice_id, max_slices)


def test_a_replayed_batch_goes_on_where_it_was(spark, tmp_path):
    store = Interrupted(spark.createDataFrame([(f"d{i}", json.dumps({"v": i})) for i in range(30)], "document_id string, source string"))
    requests = spark.createDataFrame([("a", None)], "enricher_name string, query_criteria string")
    folder = str(tmp_path / "staged")
    with pytest.raises(OSError):
        reflow.stage_reflow(requests, 7, store, folder, threshold=10, max_slices=10)
    store.healthy = True
    reflow.stage_reflow(requests, 7, store, folder, threshold=5, max_slices=10)
    reflow.stage_reflow(requests, 7, store, folder, threshold=10, max_slices=10)
    assert store.fetched == (0, 1, 2)
    assert sorted(d["documentId"] for d in read(spark, folder + "/*") or [json.loads(r.value) for r in spark.read.text(folder + "/*").collect()]) == sorted(f"d{i}" for i in range(30))


class FailsTwice(Echo):
    """Fails for a document until it was read again twice."""

    def call(self, document_id, request):
        if request.get("read", 0) < 2:
            raise RuntimeError("not yet")
        return {"a": request["v"]}


class Store:
    """Documents by id; one is gone."""

    def __init__(self):
        self.reads = 0

    def __call__(self, ids):
        self.reads += 1
        if self.reads == 1:
            raise OSError("no store")
        return {d: {"v": d, "read": self.reads - 1} for d in ids if d != "gone"}


def test_failed_reflow_documents_are_tried_again(spark, tmp_path):
    (tmp_path / "staged" / "batch=0").mkdir(parents=True)
    docs = [{"documentId": d, "payload": {"v": 0, "read": 0 if d != "good" else 2}, "reflow": True, "existingEnrichments": {"b": {"old": 1}}, "enricherName": "a"} for d in ("x", "gone", "good")]
    (tmp_path / "staged" / "batch=0" / "1.txt").write_text("\n".join(map(json.dumps, docs)))
    c = cfg("OFFLINE")
    c.enrichers[0].class_name, c.enrichers[0].retry_delay_ms, c.enrichers[0].async_timeout_ms = "tests.test_streaming.FailsTwice", 10, 5000
    values = pipeline.stream_documents(spark, c, staged_folder=str(tmp_path / "staged"), refetch=Store())
    query = sinks.write(values, str(tmp_path / "checkpoint"), folder=str(tmp_path / "out"))
    got = {d["documentId"]: (d["v"], d["enrichments"]) for d in until(query, lambda: read(spark, str(tmp_path / "out")), 3)}
    assert got["good"] == (0, {"a": {"a": 0}, "b": {"old": 1}})
    assert got["gone"] == (0, {"b": {"old": 1}})
    # The store's error took one retry of three.
    assert got["x"] == ("x", {"a": {"a": "x"}, "b": {"old": 1}})


class Asks(Echo):
    def reflow_query(self, criteria):
        return {"term": {"kind": (criteria or {}).get("k")}}


def test_reflow_topics_are_staged_and_enriched(spark, tmp_path):
    store = DocStore(spark.createDataFrame([(f"d{i}", json.dumps({"kind": "odd" if i % 2 else "even", "v": i, "enrichments": {"b": {"old": i}}})) for i in range(6)], "document_id string, source string"))
    (tmp_path / "r").mkdir()
    ask = lambda name, k: json.dumps({"enricherName": name, "queryCriteria": {"k": k}})
    (tmp_path / "r" / "1.json").write_text("\n".join([ask("a", "odd"), ask("a", "none"), ask("nobody", "even"), "{broken"]))
    c, staged = cfg("OFFLINE"), str(tmp_path / "staged")
    c.enrichers[0].class_name, c.reflow.slice_threshold, c.enrichers[0].async_timeout_ms = "tests.test_streaming.Asks", 2, 5000
    stage = pipeline.stage_requests(spark, c, store, staged, str(tmp_path / "requests"), str(tmp_path))
    query = sinks.write(pipeline.stream_documents(spark, c, staged_folder=staged), str(tmp_path / "checkpoint"), folder=str(tmp_path / "out"))
    try:
        got = {d["documentId"]: d["enrichments"] for d in until(query, lambda: read(spark, str(tmp_path / "out")), 3)}
        assert stage.isActive
    finally:
        stage.stop()
    assert got == {f"d{i}": {"a": {"a": i}, "b": {"old": i}} for i in (1, 3, 5)}


def test_dead_letters_are_written(spark, tmp_path):
    for name, text in (("raw", '{"documentId": "x"}\n{broken'), ("r", '{"enricherName": "a"}\n[1]'), ("staged/batch=0", '{"documentId": "y"}\n{"payload": {}}')):
        (tmp_path / name).mkdir(parents=True)
        (tmp_path / name / "1.txt").write_text(text)
    values = pipeline.dead_letters(spark, cfg(), str(tmp_path), str(tmp_path / "staged"))
    query = sinks.write(values, str(tmp_path / "checkpoint"), folder=str(tmp_path / "dead"))
    got = until(query, lambda: read(spark, str(tmp_path / "dead")), 3, 40)
    assert sorted((d["topic"], d["value"]) for d in got) == [("r", "[1]"), ("raw", "{broken"), ("staged", '{"payload": {}}')]


def test_upsert_closes_the_loop(spark):
    old = spark.createDataFrame([("a", "1"), ("b", "1")], "document_id string, source string")
    new = spark.createDataFrame([("b", "2"), ("c", "2")], "document_id string, source string")
    assert {tuple(r) for r in sinks.upsert(old, new).collect()} == {("a", "1"), ("b", "2"), ("c", "2")}
    assert sinks.as_json(spark.createDataFrame([("d",)], "document_id string").select("document_id", F.expr("map('a', to_variant_object(named_struct('x', 1)))").alias("original_payload"), F.expr("cast(null as map<string, map<string, variant>>)").alias("enrichments"), F.lit(1).alias("timestamp"))).count() == 1


def test_one_source_and_one_guard_for_any_number_of_enrichers(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "staged").mkdir()
    plans = []
    for n in (1, 3):
        c = cfg()
        c.enrichers = [config.EnricherConfig(name=f"e{i}", consumer_group="g", reflow_topic="r", class_name="tests.test_streaming.Echo", properties={"me": "x"}, async_timeout_ms=10) for i in range(n)]
        plan = pipeline.stream_documents(spark, c, str(tmp_path), str(tmp_path / "staged"))._jdf.queryExecution().analyzed().toString()
        plans.append((plan.count("TransformWithState"), plan.count("FileSource") or plan.count("StreamingRelation"), plan.count("MapInArrow")))
    assert plans[0] == plans[1] and plans[0][0] >= 2 and plans[0][2] == 1


def test_versions_are_joined_by_themselves_and_their_count_is_emitted(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    doc = lambda n, v: json.dumps({"documentId": "x", "payload": {"v": v}, "boomerangUpdateCount": n, "timestamp": 1})
    (tmp_path / "raw" / "1.json").write_text("\n".join([doc(1, 10), doc(2, 20)]))
    c = cfg()
    c.joiner.join_key, c.emit_update_count = "document_version", True
    query = sinks.write(pipeline.stream_documents(spark, c, raw_folder=str(tmp_path)), str(tmp_path / "checkpoint"), folder=str(tmp_path / "out"))
    got = until(query, lambda: read(spark, str(tmp_path / "out")), 2)
    assert sorted((d["boomerangUpdateCount"], d["v"], d["enrichments"]["b"]["b"]) for d in got) == [(1, 10, 10), (2, 20, 20)]


def test_lines_of_one_file_are_in_order(spark, tmp_path):
    """The guard sees the versions of one file in the order of its lines."""
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "1.json").write_text("\n".join(f'{{"n": {i}}}' for i in range(50)) + "\n")
    rows = messages.scan(spark, ["t"], folder=str(tmp_path), stream=False).orderBy("offset").collect()
    assert [json.loads(r.value)["n"] for r in rows] == list(range(50)) and len({r.offset for r in rows}) == 50

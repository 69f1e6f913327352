import json
import random
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from weirflow import config, sinks
from weirflow.enrichers.base import Enricher, create
from weirflow.enrichers.geo import PurchaseGeoEnricher
from weirflow.enrichers.http import HttpEnricher
from weirflow.functions import documents as D
from weirflow.functions import mappers as M
from weirflow.operators import enrich, guard, joiner, reflow
from weirflow.sources import messages
from weirflow.sources.docstore import DocStore, SearchSource
from weirflow.sources.query import compile_query, geo_reflow_query, simple_region_query

KEBAB = """
service:
  pipeline:
    mode: OFFLINE
  kafka: {bootstrap-servers: "h:1", raw-topic: raw, output-topic: out}
  reflow: {slice-threshold: 5, sort-field: startTime}
  joiner: {timeout-ms: 40000}
  enrichers:
    - {name: geo, reflow-topic: r, class-name: weirflow.enrichers.geo.PurchaseGeoEnricher, rate-limit-per-second: 50, properties: {apiUrl: "http://x"}}
"""
CAMEL = """
mode: REALTIME
kafka: {bootstrapServers: "h:1", rawTopic: raw, outputTopic: out}
enrichers:
  - {name: geo, consumerGroup: g, reflowTopic: r, className: c, bulkEnabled: "true", bulkSize: 20}
"""


class TestConfig:
    def test_both_spellings(self, tmp_path):
        (tmp_path / "k.yaml").write_text(KEBAB)
        (tmp_path / "c.yaml").write_text(CAMEL)
        k, c = config.load(tmp_path / "k.yaml").validate(), config.load(tmp_path / "c.yaml")
        assert (k.mode, k.kafka.raw_topic, k.reflow.slice_threshold, k.reflow.max_slices, k.joiner.timeout_ms, k.enrichers[0].rate_limit_per_second) == ("OFFLINE", "raw", 5, 10, 40000, 50.0)
        assert (c.mode, c.enrichers[0].bulk_enabled, c.enrichers[0].bulk_size, c.enrichers[0].max_retries) == ("REALTIME", True, 20, 3)
        with pytest.warns(UserWarning):
            c.validate()

    @pytest.mark.parametrize("change", [{"enrichers": []}, {"mode": "X"}])
    def test_invalid(self, change):
        with pytest.raises(ValueError):
            config.from_mapping({"enrichers": [{"name": "a", "consumerGroup": "g", "reflowTopic": "r"}], **change}).validate()

    def test_invalid_enrichers(self):
        for e in ([{"name": "a"}], [{"name": "a", "consumerGroup": "g"}], [{"name": "a", "consumerGroup": "g", "reflowEnabled": False}] * 2, [{"name": "a", "consumerGroup": "g", "reflowEnabled": False, "bulkEnabled": True, "bulkSize": 500}]):
            with pytest.raises(ValueError):
                config.from_mapping({"enrichers": e}).validate()


class TestQuery:
    def rows(self, spark, query):
        docs = [("1", {"storeId": "A", "country": "IL", "n": 5, "enrichments": {"purchase-geo-enricher": {"geo_region": "US-NY"}}}), ("2", {"storeId": "B", "country": None}), ("3", {"storeId": "A"})]
        store = DocStore(spark.createDataFrame([(i, json.dumps(d)) for i, d in docs], "document_id string, source string"))
        return sorted(r.document_id for r in store.where(query).collect())

    def test_nodes(self, spark):
        for query, expected in [
            ({"term": {"storeId": "A"}}, ["1", "3"]), ({"match": {"country": "IL"}}, ["1"]), ({"match_all": {}}, ["1", "2", "3"]), (None, ["1", "2", "3"]), ({"ids": {"values": ["2", "9"]}}, ["2"]),
            (geo_reflow_query({"region": "US-NY", "storeId": "A"}), ["1"]), (geo_reflow_query({"region": " ", "storeId": ""}), ["1", "2", "3"]), (geo_reflow_query(None), ["1", "2", "3"]), ({"exists": {"field": "country"}}, ["1"]),
            ({"bool": {"must_not": [{"term": {"storeId": "A"}}]}}, ["2"]), ({"bool": {"should": [{"term": {"storeId": "B"}}, {"range": {"n": {"gte": 5}}}]}}, ["1", "2"]), ({"terms": {"storeId": ["B"]}}, ["2"]),
        ]:
            assert self.rows(spark, query) == expected, query

    def test_unknown(self):
        with pytest.raises(ValueError):
            compile_query({"fuzzy": {"a": "b"}}, F.col, F.col("k"))

    def test_samples(self):
        assert geo_reflow_query({"region": "US-NY", "changeType": "geo_data_updated"}) == {"term": {"enrichments.purchase-geo-enricher.geo_region": "US-NY"}}


def store_of(spark, n=23):
    docs = [(f"d{i:02}", json.dumps({"startTime": None if i % 5 == 0 else i % 7, "boomerangUpdateCount": i if i % 3 else str(i), "enrichments": {"e": {"f": i}} if i % 2 else 3})) for i in range(n)]
    return DocStore(spark.createDataFrame([*docs, ("gone", None)], "document_id string, source string"))


def test_region_query_and_batch_sink(spark, tmp_path):
    rows = spark.createDataFrame([("a", '{"geo_region": "x"}'), ("b", '{"geo_region": "y"}')], "document_id string, source string")
    found = DocStore(rows).where(simple_region_query("x")).select(F.col("document_id").alias("value"))
    sinks.write_batch(found, folder=str(tmp_path / "out"))
    sinks.write_batch(found, folder=str(tmp_path / "out"))
    assert [r.value for r in spark.read.text(str(tmp_path / "out")).collect()] == ["a", "a"]


class TestStore:
    def test_pages_are_the_whole_in_order(self, spark):
        store = store_of(spark)
        for size in (4, 23, 24, 50):
            pages = list(store.pages({"exists": {"field": "boomerangUpdateCount"}}, size, "startTime"))
            got = [r.document_id for p in pages for r in p]
            expected = sorted((f"d{i:02}" for i in range(23)), key=lambda d: (0 if int(d[1:]) % 5 else 1, -(int(d[1:]) % 7) if int(d[1:]) % 5 else 0, d))
            assert got == expected and len(pages[-1]) < size
        assert [r.document_id for r in store.page(None, 2, ("d01",)).collect()] == ["d02", "d03"]

    def test_slices_are_disjoint_and_exhaustive(self, spark):
        store = store_of(spark)
        parts = [sorted(r.document_id for r in store.fetch_slice(None, i, 4).collect()) for i in range(4)]
        assert sorted(d for p in parts for d in p) == [f"d{i:02}" for i in range(23)]

    def test_raw_records(self, spark):
        ids = spark.createDataFrame([("d01",), ("d03",), ("d02",), ("gone",), ("none",), ("d01",)], "document_id string")
        got = {r.document_id: r for r in store_of(spark).by_ids(ids).select("*", F.to_json("existing_enrichments").alias("e")).collect()}
        assert {d: (r.boomerang_update_count, r.e, r.reflow) for d, r in got.items()} == {"d01": (1, '{"e":{"f":1}}', True), "d02": (2, "{}", True), "d03": (0, '{"e":{"f":3}}', True)}

    def test_slice_plan(self, spark):
        store = store_of(spark)
        assert [reflow.slices_of(store, None, t, 10) for t in (24, 23)] == [[({"match_all": {}}, 0, 1)], [({"match_all": {}}, 0, 2), ({"match_all": {}}, 1, 2)]]
        assert len(reflow.slices_of(store, None, 1, 10)) == 10 and reflow.slices_of(store, {"storeId": "none"}) == []

    def test_fields_that_are_columns(self, spark, tmp_path):
        """Filters on them reach the scan, and nothing is parsed; results are those of the parsed documents."""
        spark.createDataFrame([(f"d{i}", json.dumps({"a": {"b": str(i % 3)}, "n": i}), str(i % 3), float(i)) for i in range(9)], "id string, doc string, ab string, n double").write.parquet(str(tmp_path / "s"))
        plain, fast = DocStore(spark.read.parquet(str(tmp_path / "s")), "id", "doc"), DocStore(spark.read.parquet(str(tmp_path / "s")), "id", "doc", {"a.b": "ab", "n": "n"})
        for query in ({"term": {"a.b": "1"}}, {"bool": {"must": [{"range": {"n": {"gt": 3}}}], "must_not": {"term": {"a.b": "2"}}}}, None):
            assert sorted(r.document_id for r in fast.where(query).collect()) == sorted(r.document_id for r in plain.where(query).collect())
            assert [r.document_id for r in fast.page(query, 2, sort_field="n").collect()] == [r.document_id for r in plain.page(query, 2, sort_field="n").collect()]
        plan = fast.where({"term": {"a.b": "1"}}).select("document_id")._jdf.queryExecution().executedPlan().toString()
        assert "EqualTo(ab,1)" in plan and "parse_json" not in plan

    def test_remote_hosts_in_turn(self, spark, service):
        spark.dataSource.register(SearchSource)
        rows = spark.read.format("weirflow_search").options(url=f"http://127.0.0.1:1, {service.url}", index="i", slices=2, page=3).load().collect()
        assert len(rows) == 9

    def test_remote(self, spark, service):
        spark.dataSource.register(SearchSource)
        rows = spark.read.format("weirflow_search").options(url=service.url, index="i", slices=2, page=3, user="u", password="p").load().collect()
        assert sorted(r.document_id for r in rows) == [str(i) for i in range(10) if i != 4]


class Handler(BaseHTTPRequestHandler):
    def do_POST(self):  # noqa: N802
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        self.server.calls.append((self.path, body, self.headers.get("X-Document-Id")))
        status, answer = 200, {}
        if self.path.endswith("_search"):
            hits = [{"_id": str(i), "_source": None if i == 4 else {"i": i}, "sort": [i]} for i in range(10) if i % 2 == body["slice"]["id"] and i > (body.get("search_after") or [-1])[0]]
            answer = {"hits": {"hits": hits[: body["size"]]}}
        elif isinstance(body, list):
            answer = [{"n": b.get("n")} for b in body][: 2 if any(b.get("short") for b in body) else None]
        elif body.get("fail"):
            status = 500
        elif body.get("slow"):
            time.sleep(2)
        else:
            answer = {"latitude": 40.5, "longitude": -74, "region": "US", "timezone": None, "city": "x"}
        self.send_response(status)
        self.end_headers()
        self.wfile.write(json.dumps(answer).encode())

    def log_message(self, *_):
        pass


@pytest.fixture(scope="module")
def service():
    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    server.calls, server.url = [], f"http://127.0.0.1:{server.server_port}"
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield server
    server.shutdown()


class Flaky(Enricher):
    """Fails while the payload says so; the payload's n is the number of the attempt from which it works."""

    def call(self, document_id, request):
        if request.get("attempt", 0) < request.get("works_at", 0):
            raise RuntimeError("not yet")
        return {"ok": document_id}


class TestService:
    def test_geo(self, service):
        geo = create("weirflow.enrichers.geo.PurchaseGeoEnricher", {"apiUrl": service.url})
        assert geo.map_request("d", {"currency": None, "purchaseDate": "x"}) == {"storeId": "", "country": None, "referenceDate": "x"}
        assert geo.enrich("d", {"storeId": "A"}) == {"geo_latitude": 40.5, "geo_longitude": -74, "geo_region": "US", "geo_timezone": None, "geo_location": "40.5,-74"}
        assert service.calls[-1] == ("/", {"storeId": "A", "country": ""}, "d")
        assert geo.reflow_query({"storeId": "A"}) == {"term": {"storeId": "A"}}
        assert geo.map_response("d", {}, None) is None

    def test_factory(self):
        with pytest.raises(ValueError):
            create("json.JSONDecoder")
        with pytest.raises(RuntimeError):
            create("nowhere.Nothing")
        with pytest.raises(RuntimeError):
            create("weirflow.enrichers.http.HttpEnricher", {})
        with pytest.raises(NotImplementedError):
            Flaky().enrich_bulk([("d", {})])

    def test_single_order_failure_and_timeout(self, spark, service):
        rows = [(f"d{i}", json.dumps({"fail": i == 2, "slow": i == 5, "n": i})) for i in range(8)]
        df = spark.createDataFrame(rows, "document_id string, payload_json string").coalesce(1)
        s = enrich.Service("geo", "weirflow.enrichers.http.HttpEnricher", {"apiUrl": service.url}, timeout_ms=700, capacity=4)
        got = enrich.call_service(df, s).collect()
        assert [r.document_id for r in got] == [r[0] for r in rows]
        assert [r.success for r in got] == [i not in (2, 5) for i in range(8)]
        assert (got[2].error_message, got[5].error_message) == ("service answered 500", enrich.TIMED_OUT[False])

    def test_bulk(self, spark, service):
        df = spark.createDataFrame([(f"d{i}", json.dumps({"n": i, "short": i == 4})) for i in range(7)], "document_id string, payload_json string").coalesce(1)
        before = len(service.calls)
        s = enrich.Service("b", "weirflow.enrichers.http.HttpEnricher", {"apiUrl": "http://127.0.0.1:1", "bulkApiUrl": service.url}, bulk_size=3)
        got = enrich.call_service(df, s).collect()
        assert len(service.calls) - before == 3
        assert [json.loads(r.enriched_fields) for r in got] == [{"n": 0}, {"n": 1}, {"n": 2}, {"n": 3}, {"n": 4}, {}, {"n": 6}] and all(r.success for r in got)

    def test_rate(self):
        limiter, began = enrich.Limiter(50), time.monotonic()
        for _ in range(6):
            limiter.acquire()
        assert time.monotonic() - began >= 0.09
        enrich.Limiter(0).acquire()

    def test_retry(self, spark, tmp_path):
        # The store's document changes with every read: its attempt is the number of reads.
        reads = [0]

        def refetch(ids):
            reads[0] += 1
            return ids.where("document_id <> 'gone'").select("document_id", F.to_json(F.struct(F.lit(reads[0]).alias("attempt"), F.expr("cast(substring(document_id, 2) as int)").alias("works_at"))).alias("payload_json"))

        def keep(df, name):
            df.write.parquet(f"{tmp_path}/{name}")
            return spark.read.parquet(f"{tmp_path}/{name}")

        docs = [("d0", 0), ("d1", 1), ("d3", 3), ("d9", 9), ("gone", 5)]
        df = spark.createDataFrame([(d, json.dumps({"works_at": n})) for d, n in docs], "document_id string, payload_json string")
        slept = []
        s = enrich.Service("f", "tests.test_enrichment.Flaky", max_retries=3, retry_delay_ms=10)
        got = {r.document_id: (r.success, r.error_message) for r in enrich.call_with_retry(df, s, refetch, keep, slept.append, make=Flaky).collect()}
        assert got == {"d0": (True, None), "d1": (True, None), "d3": (True, None), "d9": (False, "not yet"), "gone": (False, "document not found")}
        assert slept == [0.01] * 3


class TestMappers:
    def test_field_names(self, spark):
        renamed = lambda m: spark.createDataFrame([(m,)], "m map<string,string>").select(M.rename_fields(F.col("m")).alias("m")).first().m
        assert renamed({"storeId": "a", "x": "b"}) == {"store_id": "a", "x": "b"}
        for bad in ({"storeId": "a", "store_id": "b"}, {"storeId": None}):
            with pytest.raises(Exception, match="physical name|is null"):
                renamed(bad)

    def test_counts(self, spark):
        df = spark.createDataFrame([("5",), ("2.7",), ('"5"',), ("null",), ("{}",), (None,)], "j string")
        assert [r[0] for r in df.coalesce(1).select(D.update_count_of(F.try_parse_json("j"))).collect()] == [5, 2, 0, 0, 0, 0]

    def test_strict(self, spark):
        df = spark.createDataFrame([('{"storeId": "a", "currency": "EUR"}',), ('{"storeId": "a"}',)], "j string").withColumn("p", D.object_of(F.col("j")))
        assert df.where("j like '%EUR%'").select(M.strict_request(F.col("p")).alias("m")).first().m == {"store_id": "a", "currency_code": "EUR"}
        with pytest.raises(Exception, match="required"):
            df.where("j not like '%EUR%'").select(M.strict_request(F.col("p"))).collect()
        with pytest.raises(Exception, match="required"):
            df.select(M.strict_response(F.lit(1), F.lit(None), F.lit("r"))).collect()

    def test_merge_order(self, spark):
        df = spark.createDataFrame([("d", '{"documentId": "old", "a": null, "timestamp": 1, "enrichments": {"x": {}}}', '{"e": {"f": 1}}')], "document_id string, p string, e string")
        e = F.try_variant_get(F.try_parse_json("e"), "$", "map<string,map<string,variant>>")
        got = df.select(F.to_json(D.merged(D.object_of(F.col("p")), F.col("document_id"), F.lit(7), e)).alias("v"), F.to_json(D.merged(D.object_of(F.col("p")), F.col("document_id"), F.lit(7), F.lit(None).cast("map<string,map<string,variant>>"), F.lit(3))).alias("w")).first()
        assert json.loads(got.v) == {"documentId": "d", "a": None, "timestamp": 7, "enrichments": {"e": {"f": 1}}}
        assert json.loads(got.w) == {"documentId": "d", "a": None, "timestamp": 7, "boomerangUpdateCount": 3}

    def test_slices(self, spark):
        df = spark.createDataFrame([(0,), (1,), (10,), (11,), (95,), (1000,)], "n int")
        assert [r[0] for r in df.coalesce(1).select(reflow.slice_count(F.col("n"), 10, 10)).collect()] == [0, 1, 1, 2, 10, 10]
        assert [tuple(r) for r in df.coalesce(1).select(M.is_sliced(F.col("n")), M.slice_key(F.lit("r"), F.col("n"))).take(2)] == [(False, "r:0"), (False, "r:1")]


class TestMessages:
    def test_parse_and_dead_letters(self, spark, tmp_path):
        (tmp_path / "raw").mkdir()
        good = {"documentId": "d", "payload": {"a": 1}, "boomerangUpdateCount": 4, "timestamp": 9, "reflow": True, "existingEnrichments": {"e": {"f": None}}, "extra": 1}
        lines = [json.dumps(good), '{"documentId": "e"}', '{"payload": {}}', "{broken", "[1]"]
        (tmp_path / "raw" / "x.json").write_text("\n".join(lines))
        parsed = messages.parse_raw(messages.scan(spark, ["raw"], folder=str(tmp_path), stream=False))
        kept, dead = messages.split_malformed(parsed)
        rows = {r.document_id: r for r in kept.select("*", F.to_json("payload").alias("p"), F.to_json("existing_enrichments").alias("x")).collect()}
        assert (rows["d"].boomerang_update_count, rows["d"].timestamp, rows["d"].reflow, rows["d"].p) == (4, 9, True, '{"a":1}')
        assert (rows["e"].boomerang_update_count, rows["e"].reflow, rows["e"].p, rows["e"].x) == (0, False, "{}", None) and rows["e"].timestamp > 10**12
        assert sorted(r.value for r in dead.collect()) == sorted(lines[2:])
        with pytest.raises(Exception, match="malformed"):
            messages.split_malformed(parsed, "fail")[0].collect()


def guard_fold(rows):
    top, out = {}, []
    for k, c, o, n in sorted(rows, key=lambda r: (r[1], r[2])):
        ok = k not in top or (n or 0) >= top[k]
        if ok:
            top[k] = n or 0
        out.append((k, c, o, ok))
    return sorted(out)


def test_guard_is_the_fold(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice("aab"), i // 7, i, rnd.choice([None, 0, 1, 2, 3, 4])) for i in range(80)]
    df = spark.createDataFrame(rows, "k string, c int, o int, boomerang_update_count bigint")
    for chunk, order in (("c", ["o"]), (None, ["c", "o"])):
        assert sorted(tuple(r) for r in guard.guarded(df, ["k"], order, chunk=chunk).select("k", "c", "o", "accepted").collect()) == guard_fold(rows)


RESULTS = "document_id string, seq int, enricher_name string, success boolean, enriched_fields map<string,string>, original_payload string, reflow boolean, existing_enrichments map<string,map<string,string>>, arrival_ms bigint"


def results(seed, n=60):
    rnd = random.Random(seed)
    rows, at = [], 0
    for i in range(n):
        at += rnd.choice([0, 1, 5, 40])
        ok = rnd.random() < 0.7
        rows.append((rnd.choice("xyz"), i, rnd.choice("ABC"), ok, {"f": str(i)} if ok else None, f"p{i}", rnd.random() < 0.4, rnd.choice([None, {"A": {"f": "old"}, "Z": {"g": "old"}}]), at))
    return rows


def test_joiner_is_the_fold(spark):
    for seed in range(3):
        rows = results(seed)
        got = {r.document_id: r for r in joiner.joined(spark.createDataFrame(rows, RESULTS), ["A", "B", "C"], ["A"]).collect()}
        for d in {r[0] for r in rows}:
            mine = [r for r in rows if r[0] == d]
            existing = next((r[7] for r in mine if r[6] and r[7] is not None), None)
            last = {r[2]: r[4] for r in mine}
            assert got[d].original_payload == mine[0][5] and got[d].enrichments == {**(existing or {}), **{k: v for k, v in last.items() if v is not None}}
            assert got[d].is_partial == (not ({"A"} if mine[0][6] else {"A", "B", "C"}) <= set(last))


def test_cycles_are_the_fold(spark):
    rows = results(7, 90)
    expected = []
    for d in "xyz":
        got, n, start, want = set(), 0, 0, set()
        for r in sorted((r for r in rows if r[0] == d), key=lambda r: (r[8], r[1])):
            if got and r[8] >= start + 30:
                n += 1
                expected.append((d, n, start, start + 30, True, ",".join(sorted(got))))
                got = set()
            if not got:
                start, want = r[8], {"A"} if r[6] else {"A", "B", "C"}
            got.add(r[2])
            if want <= got:
                n += 1
                expected.append((d, n, start, r[8], False, ",".join(sorted(got))))
                got = set()
        if got:
            expected.append((d, n + 1, start, start + 30, True, ",".join(sorted(got))))
    df = spark.createDataFrame(rows, RESULTS)
    assert sorted(tuple(r) for r in joiner.cycles(df, ["A", "B", "C"], ["A"], 30).collect()) == sorted(expected)
    assert joiner.cycles(df.limit(0), ["A"], ["A"]).count() == 0


def test_http_enricher_is_exported():
    assert issubclass(PurchaseGeoEnricher, HttpEnricher)


def test_guard_keeps_rows_with_nulls(spark):
    rows = [(None, None, 1, 5), (None, None, 2, 4), ("a", None, 3, 1), ("a", 1, 4, 2), ("a", 1, 5, None), ("b", 2, None, 7)]
    df = spark.createDataFrame(rows, "k string, c int, o int, boomerang_update_count bigint")
    got = {(r.k, r.c, r.o): r.accepted for r in guard.guarded(df, ["k"], ["o"], chunk="c").collect()}
    assert got == {(None, None, 1): True, (None, None, 2): False, ("a", None, 3): True, ("a", 1, 4): True, ("a", 1, 5): False, ("b", 2, None): True}
    assert {(r.k, r.c, r.o) for r in guard.accept(df, ["k"], ["o"], chunk="c").collect()} == {k for k, ok in got.items() if ok}
    plan = guard.accept(df.withColumn("payload", F.lit("x")), ["k"], ["o"], chunk="c")._jdf.queryExecution().optimizedPlan().toString()
    assert "payload" not in "".join(x for x in plan.splitlines() if "Window" in x)

"""The document store: count, slices, pages, lookups by id.

Within Spark it is a DataFrame with a key and the stored JSON; a remote store is read by ``SearchSource``, a
Python data source with one partition per slice, each of which follows a cursor.
"""

from __future__ import annotations

import base64
import json
import urllib.error
import urllib.request

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.documents import enrichments_of, object_of, update_count_of
from .query import compile_query, json_field


def slice_of(key: Column, n: int | Column) -> Column:
    """The slice of a key: a hash that other engines can compute as well."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") % (F.lit(n) if isinstance(n, int) else n)


class DocStore:
    """A store over a DataFrame with a key column and the document as a JSON string.

    ``fields`` names columns that hold fields of the document, by dotted path: filters and sorts on them need no parsing and reach the
    scan. They must be what the document says, as strings (a sort field: a number).
    """

    def __init__(self, df: DataFrame, key: str = "document_id", source: str = "source", fields: dict[str, str] | None = None):
        self.fields = {path: f"_field_{i}" for i, path in enumerate(fields or {})}
        kept = [F.col(c).alias(self.fields[path]) for path, c in (fields or {}).items()]
        self.df = df.select(F.col(key).alias("document_id"), F.col(source).alias("source"), *kept).withColumn("v", F.try_parse_json("source"))

    def field(self, path: str) -> Column:
        return F.col(self.fields[path]) if path in self.fields else json_field(F.col("v"))(path)

    def where(self, query: dict | str | None) -> DataFrame:
        return self.df.where(compile_query(query, self.field, F.col("document_id")))

    def count(self, query: dict | str | None) -> int:
        return self.where(query).count()

    def fetch_slice(self, query: dict | str | None, slice_id: int = 0, max_slices: int = 1) -> DataFrame:
        """All documents of one slice; slices are disjoint and together are everything."""
        rows = self.where(query)
        if max_slices > 1:
            rows = rows.where(slice_of(F.col("document_id"), max_slices) == slice_id)
        return to_raw(rows)

    def page(self, query: dict | str | None, size: int, after: tuple | None = None, sort_field: str | None = None, slice_id: int = 0, max_slices: int = 1) -> DataFrame:
        """One page, by the sort field descending (numbers; missing last) and then the key; ``after`` is the last row's (sort value, key)."""
        rows = self.where(query)
        if max_slices > 1:
            rows = rows.where(slice_of(F.col("document_id"), max_slices) == slice_id)
        key = F.col("document_id")
        if not sort_field or not sort_field.strip():
            if after is not None:
                rows = rows.where(key > after[-1])
            return rows.orderBy(key).limit(size).withColumn("sort_value", F.lit(None).cast("double"))
        rows = rows.withColumn("sort_value", self.field(sort_field).try_cast("double"))
        s = F.col("sort_value")
        if after is not None:
            rows = rows.where((s.isNull() & (key > after[1])) if after[0] is None else s.isNull() | (s < after[0]) | (s == after[0]) & (key > after[1]))
        return rows.orderBy(F.desc_nulls_last("sort_value"), key).limit(size)

    def pages(self, query: dict | str | None, size: int, sort_field: str | None = None):
        """Pages until one is short."""
        after = None
        while True:
            rows = self.page(query, size, after, sort_field).collect()
            yield rows
            if len(rows) < size:
                return
            after = rows[-1]["sort_value"], rows[-1]["document_id"]

    def by_ids(self, ids: DataFrame) -> DataFrame:
        """Documents of the given ids; Catalyst chooses the join by their number."""
        return to_raw(self.df.join(ids.select("document_id").distinct(), "document_id", "left_semi"))


def to_raw(rows: DataFrame) -> DataFrame:
    """Stored documents as raw records of the reflow path; documents without a source are skipped."""
    found = rows.withColumn("payload", object_of(F.col("source"))).where("payload is not null")
    return found.select(
        "document_id", "payload",
        update_count_of(F.try_element_at("payload", F.lit("boomerangUpdateCount"))).alias("boomerang_update_count"),
        F.unix_millis(F.current_timestamp()).alias("timestamp"), F.lit(True).alias("reflow"),
        enrichments_of(F.col("payload")).alias("existing_enrichments"),
    )


class IdsReader:
    """Current documents of a remote store by id, for use where there is no session; one POST url/index/_search for up to ``page`` ids."""

    def __init__(self, url: str, index: str = "", user: str = "", password: str = "", timeout: float = 30, page: int = 1000):
        self.options, self.page = {"url": url, "index": index, "user": user, "password": password, "timeout": timeout}, page

    def __call__(self, ids: list[str]) -> dict[str, dict]:
        found = {}
        for i in range(0, len(ids), self.page):
            part = ids[i : i + self.page]
            hits = _SearchReader(self.options)._post({"size": len(part), "query": {"ids": {"values": part}}})["hits"]["hits"]
            found |= {str(h["_id"]): h["_source"] for h in hits if isinstance(h.get("_source"), dict)}
        return found


class _Slice(InputPartition):
    def __init__(self, i: int):
        self.i = i


class SearchSource(DataSource):
    """``spark.read.format("weirflow_search")`` with options url, index, query, slices, page, sort, user, password, timeout.

    A page is asked for by POST url/index/_search with size, query, slice, sort and search_after; a page that is
    not full is the last. ``url`` may name several hosts, apart by commas, that are asked in turn until one answers. A failed task
    starts its slice again.
    """

    @classmethod
    def name(cls) -> str:
        return "weirflow_search"

    def schema(self) -> str:
        return "document_id string, source string"

    def reader(self, schema) -> DataSourceReader:
        return _SearchReader(dict(self.options))


class _SearchReader(DataSourceReader):
    def __init__(self, options: dict):
        self.o = options

    def partitions(self):
        return [_Slice(i) for i in range(int(self.o.get("slices", 1)))]

    def _post(self, body: dict) -> dict:
        *others, last = [u.strip().rstrip("/") for u in self.o["url"].split(",")]
        for url in others:
            try:
                return self._ask(url, body)
            except urllib.error.HTTPError:
                raise
            except OSError:  # no answer: the next host
                continue
        return self._ask(last, body)

    def _ask(self, url: str, body: dict) -> dict:
        request = urllib.request.Request(f"{url}/{self.o.get('index', '')}/_search", json.dumps(body).encode(), {"Content-Type": "application/json"})
        if self.o.get("user"):
            request.add_header("Authorization", "Basic " + base64.b64encode(f"{self.o['user']}:{self.o.get('password', '')}".encode()).decode())
        with urllib.request.urlopen(request, timeout=float(self.o.get("timeout", 30))) as answer:
            return json.loads(answer.read())

    def read(self, partition):
        size, slices, after = int(self.o.get("page", 1000)), int(self.o.get("slices", 1)), None
        sort = [{"_id": "asc"}] if not self.o.get("sort") else [{self.o["sort"]: "desc"}, {"_id": "asc"}]
        while True:
            body = {"size": size, "query": json.loads(self.o.get("query") or '{"match_all": {}}'), "sort": sort}
            if slices > 1:
                body["slice"] = {"id": partition.i, "max": slices}
            if after is not None:
                body["search_after"] = after
            hits = self._post(body)["hits"]["hits"]
            for hit in hits:
                if hit.get("_source") is not None:
                    yield str(hit["_id"]), json.dumps(hit["_source"])
            if len(hits) < size:
                return
            after = hits[-1]["sort"]

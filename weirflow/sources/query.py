"""The document store's JSON query language as a Column: a filter that Catalyst moves as near to the scan as it can.

Over stored JSON strings that is behind their parsing; fields that a store keeps as columns of their own are filtered in the scan.

Nodes: term, match, ids, bool with must, match_all; and, for use beyond them, terms, range, exists and bool
with should, must_not and filter. An unknown node is an error.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Resolve = Callable[[str], Column]


def json_field(source: Column) -> Resolve:
    """Fields by dotted path within a VARIANT."""

    def resolve(path: str) -> Column:
        return F.try_variant_get(source, "$" + "".join(f'["{p}"]' for p in path.split(".")), "string")

    return resolve


def compile_query(query: dict | str | None, field: Resolve, key: Column, text_fields: frozenset[str] = frozenset()) -> Column:
    """The predicate of a query; null and empty queries match all. ``text_fields`` are matched by word, all others as a whole."""
    if isinstance(query, str):
        query = json.loads(query)
    if not query:
        return F.lit(True)
    parts = [_node(kind, body, field, key, text_fields) for kind, body in query.items()]
    return reduce(lambda a, b: a & b, parts)


def _value(body):
    return body.get("value", body.get("query")) if isinstance(body, dict) else body


def _all_of(nodes, *rest) -> Column:
    return reduce(lambda a, b: a & b, [compile_query(n, *rest) for n in (nodes if isinstance(nodes, list) else [nodes])], F.lit(True))


def _node(kind: str, body, field: Resolve, key: Column, text_fields: frozenset[str]) -> Column:
    rest = (field, key, text_fields)
    if kind == "match_all":
        return F.lit(True)
    if kind == "ids":
        return key.isin([str(v) for v in body["values"]])
    if kind == "exists":
        return field(body["field"]).isNotNull()
    if kind == "bool":
        unknown = set(body) - {"must", "filter", "should", "must_not"}
        if unknown:
            raise ValueError(f"unknown bool clause {sorted(unknown)}")
        out = _all_of(body.get("must", []), *rest) & _all_of(body.get("filter", []), *rest)
        if should := body.get("should"):
            out = out & reduce(lambda a, b: a | b, [compile_query(n, *rest) for n in (should if isinstance(should, list) else [should])])
        for n in body.get("must_not", []) if isinstance(body.get("must_not", []), list) else [body["must_not"]]:
            out = out & ~F.coalesce(compile_query(n, *rest), F.lit(False))
        return out
    if kind in ("term", "match", "terms", "range"):
        ((name, value),) = body.items()
        c = field(name)
        if kind == "terms":
            return c.isin([str(v) for v in value])
        if kind == "range":
            tests = {"gt": c.try_cast("double").__gt__, "gte": c.try_cast("double").__ge__, "lt": c.try_cast("double").__lt__, "lte": c.try_cast("double").__le__}
            return reduce(lambda a, b: a & b, [tests[op](float(v)) for op, v in value.items()])
        value = _value(value)
        if kind == "match" and name in text_fields:
            words = [w for w in re.split(r"\W+", str(value).lower()) if w]
            return F.arrays_overlap(F.split(F.lower(c), r"[^\p{L}\p{N}_]+"), F.array(*map(F.lit, words))) if words else F.lit(False)
        return c == (str(value).lower() if isinstance(value, bool) else str(value))
    raise ValueError(f"unknown query node {kind}")


def _blank(value) -> bool:
    return value is None or not str(value).strip()


def geo_reflow_query(criteria: dict | None, enricher: str = "purchase-geo-enricher") -> dict:
    """The geo enricher's query of reflow criteria: region and store as terms, both if both are given, all documents if neither is."""
    criteria = criteria or {}
    terms = []
    if not _blank(criteria.get("region")):
        terms.append({"term": {f"enrichments.{enricher}.geo_region": criteria["region"]}})
    if not _blank(criteria.get("storeId")):
        terms.append({"term": {"storeId": criteria["storeId"]}})
    if not terms:
        return {"match_all": {}}
    return terms[0] if len(terms) == 1 else {"bool": {"must": terms}}


def simple_region_query(region: str) -> dict:
    return {"term": {"geo_region": region}}

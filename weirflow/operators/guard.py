"""The version guard: per key, a row passes unless its update count is below that of a row accepted before.

The state is a running maximum, so a batch needs no fold: the maximum of all earlier rows decides. Earlier rows
of the same chunk (a batch of the feed) come from a window within (key, chunk), all earlier chunks from a
window over the chunks' maxima. So a key that holds a great part of all rows is spread over its chunks.
Nulls in keys, chunk or order are values like any other; null chunks come first.

``accept`` decides on the keys, the order and the count alone, so payloads don't pass through the windows: the few rows that are
stale are taken out by an anti-join on their order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _same(names: list[str]) -> Column:
    """Equality of columns with their ``_other_`` namesakes, where nulls are equal."""
    return reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"_other_{n}")) for n in names])


def _renamed(df: DataFrame, names: list[str], *more: str) -> DataFrame:
    return df.select(*(F.col(n).alias(f"_other_{n}") for n in names), *more)


def guarded(df: DataFrame, keys: list[str], order: list[str], count: str = "boomerang_update_count", chunk: str | None = None) -> DataFrame:
    """Adds ``accepted``. Rows come in the order of ``chunk`` (if given) and then ``order``, which must be unique; a null count is 0."""
    n = F.coalesce(F.col(count), F.lit(0))
    before = Window.partitionBy(*keys, *([chunk] if chunk else [])).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_within", F.max(n).over(before))
    if chunk:
        within = [*keys, chunk]
        earlier = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
        chunks = df.groupBy(*within).agg(F.max(n).alias("_top")).withColumn("_ahead", F.max("_top").over(earlier))
        chunks = _renamed(chunks, within, "_ahead")
        df = df.join(chunks, _same(within)).withColumn("_within", F.greatest("_within", "_ahead")).drop(*chunks.columns)
    return df.withColumn("accepted", F.col("_within").isNull() | (n >= F.col("_within"))).drop("_within")


def accept(df: DataFrame, keys: list[str], order: list[str], count: str = "boomerang_update_count", chunk: str | None = None) -> DataFrame:
    """The rows that pass."""
    asked = list(dict.fromkeys([*keys, *order, count, *([chunk] if chunk else [])]))
    stale = guarded(df.select(*asked), keys, order, count, chunk).where("not accepted")
    whole = list(dict.fromkeys([*keys, *([chunk] if chunk else []), *order]))
    return df.join(_renamed(stale, whole), _same(whole), "left_anti")

"""A table kept as a log-structured merge of its change feed.

``ChangeLog.append`` turns changes into sorted runs (one newest change per key and run, deletions as tombstones).
Runs are partitions of one table that is bucketed and sorted by key, so ``current`` merges the live runs bucket by
bucket where they lie, without a shuffle: the newest change of a key wins, keys whose newest change is a
tombstone are absent. ``compact`` merges runs into one the same way and, when it merges all of them, drops the
tombstones. Which runs are live, and the number of buckets, is said by numbered manifests, each published by one
rename, so a reader sees the table before or after an append or a compaction and never between. Runs have names of
their own; of two writers at once the second fails and may try again, and nothing of the first is lost.

An append aggregates with a combine step that keeps the later of two changes. That makes it indifferent to
repeated and out-of-order changes, lets every task reduce its part of a run before the exchange, and so
keeps a key with very many changes from reaching one task. Buckets are as many as the session's shuffle partitions when
the log is begun, so they grow with the input.

Order of changes: update count (missing: 0), then time (missing: before all times); a change with both equal
is a repetition, of which the first to arrive stays. An op is read by its spelling: delete, del, d, remove,
rm delete; null, blank or unknown ops delete if the payload is null and else set; every other op sets the document. A null or blank id is
no change. An empty feed gives an empty table.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import children, publish_text, read_text, remove
from .exactly_once import normal_id

#: Spellings of ops (fixed values).
DELETES = ("d", "del", "delete", "deleted", "remove", "removed", "rm")
SETS = ("i", "ins", "insert", "inserted", "c", "create", "created", "u", "upd", "update", "updated", "upsert", "put", "set", "merge", "replace")


def is_delete(op: Column, payload: Column) -> Column:
    word = F.lower(F.trim(F.coalesce(op, F.lit(""))))
    return F.when(word.isin(*DELETES), True).when(word.isin(*SETS), False).otherwise(payload.isNull())


COLUMNS = "key string, n_update bigint, at_ms bigint, arrival bigint, tombstone boolean, run string"


def as_changes(df: DataFrame) -> DataFrame:
    """Changes with key, sequence and tombstone flag."""
    key = normal_id(F.col("document_id"))
    return df.select(
        key.alias("key"),
        F.coalesce(F.col("boomerang_update_count"), F.lit(0)).cast("bigint").alias("n_update"),
        F.coalesce(F.col("timestamp_ms"), F.lit(-(2**63))).cast("bigint").alias("at_ms"),
        (-F.col("change_seq")).alias("arrival"),
        is_delete(F.col("op"), F.col("payload")).alias("tombstone"),
        F.col("batch_id"),
    ).where("key <> ''")


def newest(changes: DataFrame, *keys: str) -> DataFrame:
    """The newest change of each key."""
    last = F.max(F.struct("n_update", "at_ms", "arrival", "tombstone")).alias("last")
    return changes.groupBy(*keys, "key").agg(last).select(*keys, "key", "last.*")


class ChangeLog:
    """Sorted runs below ``root``, and the manifests of those that are live.

    The table of runs is external and known to the session's catalog, since only a catalog's tables keep their buckets.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self._wanted = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def _version(self) -> int:
        return max([int(x) for x in children(self.spark, f"{self.root}/manifest") if x.isdigit()], default=0)

    def _manifest(self, version: int) -> dict:
        return json.loads(read_text(self.spark, f"{self.root}/manifest/{version:09d}")) if version else {"buckets": self._wanted, "runs": []}

    def runs(self) -> list[str]:
        """Names of the live runs, oldest first."""
        return self._manifest(self._version())["runs"]

    def _publish(self, version: int, buckets: int, runs: list[str]) -> None:
        if not publish_text(self.spark, f"{self.root}/manifest/{version:09d}", json.dumps({"buckets": buckets, "runs": runs})):
            raise RuntimeError("another writer changed the log; try again")

    def _table(self, buckets: int) -> str:
        name = f"weirflow_log_{hashlib.md5(self.root.encode()).hexdigest()[:16]}_{buckets}"
        self.spark.sql(f"create table if not exists {name} ({COLUMNS}) using parquet partitioned by (run) clustered by (key) sorted by (key) into {buckets} buckets location '{self.root}/runs'")
        return name

    def _read(self, buckets: int, runs: list[str]) -> DataFrame:
        table = self._table(buckets)
        for run in runs:
            self.spark.sql(f"alter table {table} add if not exists partition (run = '{run}')")
        return self.spark.table(table).where(F.col("run").isin(runs)).drop("run")

    def _write(self, rows: DataFrame, buckets: int, run: Column) -> None:
        """One file per run and bucket."""
        names = [c.split()[0] for c in COLUMNS.split(", ")[:-1]]
        rows.select(*names, run.alias("run")).repartition(buckets, "key").write.mode("append").insertInto(self._table(buckets))

    def append(self, df: DataFrame, run: Column | None = None) -> None:
        """Append changes as one run, or as one run per value of ``run`` in the order of the values, in one job."""
        version = self._version()
        manifest, name = self._manifest(version), f"{version + 1:09d}-{uuid.uuid4().hex}-"
        changes = newest(as_changes(df).withColumn("run", F.lit(0) if run is None else run), "run")
        self._write(changes, manifest["buckets"], F.concat(F.lit(name), F.format_string("%09d", "run")))
        added = [x.removeprefix("run=") for x in children(self.spark, f"{self.root}/runs") if x.startswith(f"run={name}")]
        self._publish(version + 1, manifest["buckets"], manifest["runs"] + added)

    def compact(self, most: int = 4) -> None:
        """Merge runs into one if more than ``most`` are live: the older ones, or all if two stay in any case."""
        version = self._version()
        manifest = self._manifest(version)
        live, buckets = manifest["runs"], manifest["buckets"]
        if len(live) <= most:
            return
        old, rest = live[: len(live) - most + 1], live[len(live) - most + 1 :]
        merged = newest(self._read(buckets, old))
        if not rest:
            merged = merged.where("not tombstone")
        name = f"{version + 1:09d}-{uuid.uuid4().hex}"
        self._write(merged, buckets, F.lit(name))
        self._publish(version + 1, buckets, [name, *rest])

    def vacuum(self) -> None:
        """Delete runs that the newest manifest doesn't name; not while someone appends or still reads them."""
        live = set(self.runs())
        for x in children(self.spark, f"{self.root}/runs"):
            if x.startswith("run=") and x.removeprefix("run=") not in live:
                remove(self.spark, f"{self.root}/runs/{x}")

    def current(self) -> DataFrame:
        """The documents that exist, with the count of their last change."""
        manifest = self._manifest(self._version())
        if not manifest["runs"]:
            return self.spark.createDataFrame([], "document_id string, boomerang_update_count bigint")
        merged = newest(self._read(manifest["buckets"], manifest["runs"]))
        return merged.where("not tombstone").select(F.col("key").alias("document_id"), F.col("n_update").alias("boomerang_update_count"))


def rebuild(df: DataFrame, root: str, runs: int = 8, most: int = 4) -> DataFrame:
    """The current documents of a whole change feed, appended as ``runs`` runs and compacted to ``most``."""
    log = ChangeLog(df.sparkSession, root)
    log.append(df, F.pmod(F.coalesce("batch_id", F.lit(0)), F.lit(runs)).cast("int"))
    log.compact(most)
    return log.current()

"""Exactly one copy of messages that were delivered at least once.

A message is (document id, update count, path). Identifiers are encoded exactly: a dictionary, sharded by
the identifier's hash, gives each document id a dense code within its shard. What was seen is kept as
bitmaps over the update counts: one 64-bit word per (shard, code, path, count div 64), words without a bit
are not stored, so a document's whole history mostly is one row. A delivery is screened in three steps:

1. arrivals are pre-aggregated per message, which also removes the skew of a hot document or message;
2. messages become words, words get the code of their document (a rank within the shard, no global sort);
3. a word is compared with the stored one: bits not seen before are accepted, with one arrival each.

The store has two tables: the dictionary has each id once, the bitmaps have codes only. ``SeenStore.commit`` unions the
new bits atomically: new codes and words are written to a folder of their own, and count only once the
delivery's marker, which names the folder, has been renamed into place. A replay after a lost driver reads back what was
committed; of two writers of one delivery both read back what the first committed. ``compact`` merges all deliveries so far
into one. The number of shards is the store's from its first delivery on; it is taken from the session's
shuffle partitions, so that it grows with the input.

Defined cases: a null or blank id is no message (such rows are left out); ids are compared trimmed of spaces
and in lower case; a missing count is 0, a missing reflow flag is realtime; counts may be any bigint; equal
arrivals are told apart by the order columns, and of complete ties one copy stays; an empty table gives an
empty result; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..shared import children, publish_text, read_text

ORDER = ("batch_id", "kafka_topic", "kafka_partition", "kafka_offset")
#: Shards per shuffle partition of the session that begins a store; a shard is ranked by one task.
SHARDS_PER_PARTITION = 16

DICTIONARY = "shard int, id string, code bigint"
BITMAPS = "shard int, code bigint, reflow boolean, word bigint, unseen bigint, repeated bigint"


def default_shards(spark: SparkSession) -> int:
    return SHARDS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))


def normal_id(c: Column) -> Column:
    """An identifier as it is compared."""
    return F.lower(F.trim(c))


def arrivals(df: DataFrame, order: tuple[str, ...] = ()) -> DataFrame:
    """One row per message: how often it arrived, and its first arrival by the order columns."""
    seen = df.select(
        normal_id(F.col("document_id")).alias("id"),
        F.coalesce(F.col("reflow"), F.lit(False)).alias("reflow"),
        F.coalesce(F.col("boomerang_update_count"), F.lit(0)).cast("bigint").alias("n_update"),
        *([F.struct(*order).alias("arrival")] if order else []),
    ).where("id <> ''")
    return seen.groupBy("id", "reflow", "n_update").agg(F.count("*").alias("copies"), *([F.min("arrival").alias("arrival")] if order else []))


def words(messages: DataFrame, shards: int) -> DataFrame:
    """Messages as 64-bit words: the bits present, and those that arrived more than once."""
    bit = F.expr("shiftleft(1L, cast(n_update & 63 as int))")
    return (
        messages.withColumn("word", F.expr("shiftright(n_update, 6)"))
        .groupBy("id", "reflow", "word")
        .agg(F.bit_or(bit).alias("bits"), F.bit_or(F.when(F.col("copies") > 1, bit).otherwise(F.lit(0).cast("bigint"))).alias("again"))
        .withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    )


def encode(batch: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """Rows with (shard, id) get ``code``: the dictionary's, or the next free ones of the shard.

    ``fresh`` tells the codes that are new. A new id's code is its dense rank within the shard, so ids need
    neither be collected nor sorted globally.
    """
    w = Window.partitionBy("shard").orderBy("id")
    if dictionary is None:
        return batch.withColumn("code", F.dense_rank().over(w).cast("bigint") - 1).withColumn("fresh", F.lit(True))
    known = batch.join(dictionary.select("shard", "id", "code"), ["shard", "id"], "left")
    top = dictionary.groupBy("shard").agg(F.max("code").alias("top"))
    fresh = Window.partitionBy("shard", F.col("code").isNull()).orderBy("id")
    return (
        known.join(top, "shard", "left")
        .withColumn("rank", F.dense_rank().over(fresh).cast("bigint"))
        .withColumn("fresh", F.col("code").isNull())
        .withColumn("code", F.coalesce("code", F.coalesce("top", F.lit(-1)) + F.col("rank")))
        .drop("top", "rank")
    )


def screen(encoded: DataFrame, bitmaps: DataFrame | None = None) -> DataFrame:
    """Words with ``unseen`` (bits to accept) and ``repeated`` (bits seen before, or more than once now)."""
    if bitmaps is None:
        return encoded.withColumn("unseen", F.col("bits")).withColumn("repeated", F.col("again"))
    stored = bitmaps.groupBy("shard", "code", "reflow", "word").agg(F.bit_or("bits").alias("stored"))
    old = F.coalesce("stored", F.lit(0).cast("bigint"))
    return (
        encoded.join(stored, ["shard", "code", "reflow", "word"], "left")
        .withColumn("unseen", F.col("bits").bitwiseAND(F.bitwise_not(old)))
        .withColumn("repeated", F.col("again").bitwiseOR(F.col("bits").bitwiseAND(old)))
        .drop("stored")
    )


def bits_of(screened: DataFrame, name: str) -> DataFrame:
    """The messages whose bit is set in the column ``name``."""
    positions = F.expr(f"filter(sequence(0, 63), i -> (shiftrightunsigned({name}, i) & 1) = 1)")
    return screened.where(F.col(name) != 0).select("id", "reflow", "word", F.explode(positions).alias("i")).select("id", "reflow", (F.col("word") * 64 + F.col("i")).alias("n_update"))


def path_name() -> Column:
    return F.when(F.col("reflow"), "reflow").otherwise("realtime")


def accepted(messages: DataFrame, screened: DataFrame, order: tuple[str, ...] = ORDER) -> DataFrame:
    """One arrival per unseen bit."""
    return messages.join(bits_of(screened, "unseen"), ["id", "reflow", "n_update"], "left_semi").select(
        F.col("id").alias("document_id"), F.col("n_update").alias("boomerang_update_count"), path_name().alias("path"), *(F.col("arrival")[c].alias(c) for c in order)
    )


def one_copy(df: DataFrame, order: tuple[str, ...] = ORDER) -> DataFrame:
    """One arrival of each message of ``df``, the first by ``order``, against an empty store."""
    return accepted(arrivals(df, order), screen(encode(words(arrivals(df), default_shards(df.sparkSession)))), order)


class SeenStore:
    """Dictionary and bitmaps of all deliveries so far, in a folder that the cluster shares.

    Of a delivery's words, ``unseen`` are the bits it added and ``repeated`` those that had come before or came more than once in it.
    """

    def __init__(self, spark: SparkSession, root: str, shards: int | None = None, order: tuple[str, ...] = ORDER):
        self.spark, self.root, self.order = spark, root.rstrip("/"), order
        self._wanted = shards or default_shards(spark)

    def _log(self) -> dict[str, dict]:
        """Committed deliveries, in order: the name of each with its folder, the store's shards, and the deliveries merged into it."""
        names = [x for x in children(self.spark, f"{self.root}/log") if not x.endswith(".tmp")]
        return {x: json.loads(read_text(self.spark, f"{self.root}/log/{x}")) for x in names}

    def deliveries(self) -> list[str]:
        """Names of the committed deliveries, in order."""
        return [x for x, entry in self._log().items() if "merges" not in entry]

    def _live(self, log: dict[str, dict], until: str | None = None) -> list[str]:
        """Folders that hold the deliveries before ``until``: those of the last compaction, and what came after it."""
        before = {x: e for x, e in log.items() if until is None or x < until}
        merged = [e for e in before.values() if "merges" in e]
        within = set(merged[-1]["merges"]) if merged else set()
        return [*([merged[-1]["folder"]] if merged else []), *(e["folder"] for x, e in before.items() if "merges" not in e and x not in within)]

    def _read(self, folders: list[str], table: str, schema: str) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.root}/{f}/{table}" for f in folders))

    def _write(self, folder: str, dictionary: DataFrame, bitmaps: DataFrame) -> None:
        dictionary.select(*(c.split()[0] for c in DICTIONARY.split(", "))).sortWithinPartitions("shard", "code").write.parquet(f"{self.root}/{folder}/dictionary")
        bitmaps.select(*(c.split()[0] for c in BITMAPS.split(", "))).sortWithinPartitions("shard", "code", "reflow", "word").write.parquet(f"{self.root}/{folder}/bitmaps")

    def commit(self, df: DataFrame, delivery: str) -> DataFrame:
        """Screen one delivery, union its new bits, and return its words with their ids.

        Deliveries come one after another, their names in ascending order; seen is what was committed under a smaller name. A
        delivery that is committed already is read back, whatever ``df`` holds.
        """
        log = self._log()
        if delivery not in log:
            shards = next((e["shards"] for e in log.values()), self._wanted)
            before, folder = self._live(log, delivery), f"data-{uuid.uuid4().hex}"
            dictionary = self._read(before, "dictionary", DICTIONARY) if before else None
            bitmaps = self._read(before, "bitmaps", BITMAPS).where("unseen <> 0").withColumnRenamed("unseen", "bits") if before else None
            encoded = f"{self.root}/{folder}/encoded"
            encode(words(arrivals(df), shards), dictionary).write.parquet(encoded)
            rows = self.spark.read.parquet(encoded)
            self._write(folder, rows.where("fresh").select("shard", "id", "code").distinct(), screen(rows, bitmaps))
            publish_text(self.spark, f"{self.root}/log/{delivery}", json.dumps({"folder": folder, "shards": shards}))
            log = self._log()
        known = self._read([*self._live(log, delivery), log[delivery]["folder"]], "dictionary", DICTIONARY)
        return self._read([log[delivery]["folder"]], "bitmaps", BITMAPS).join(known, ["shard", "code"])

    def deliver(self, df: DataFrame, delivery: str) -> DataFrame:
        """Commit one delivery; returns the accepted arrivals, one per message that no delivery before had."""
        return accepted(arrivals(df, self.order), self.commit(df, delivery), self.order)

    def compact(self) -> None:
        """Merge the bitmaps of all deliveries so far into one word each; their dictionaries are put together."""
        log = self._log()
        live, names = self._live(log), [x for x, e in log.items() if "merges" not in e]
        if len(live) < 2:
            return
        folder = f"data-{uuid.uuid4().hex}"
        # Bits set by two deliveries at once can't be, so a union of what each added is what all have seen.
        merged = self._read(live, "bitmaps", BITMAPS).groupBy("shard", "code", "reflow", "word").agg(F.bit_or("unseen").alias("unseen"), F.bit_or("repeated").alias("repeated"))
        self._write(folder, self._read(live, "dictionary", DICTIONARY), merged)
        publish_text(self.spark, f"{self.root}/log/{names[-1]}~merged", json.dumps({"folder": folder, "shards": log[names[-1]]["shards"], "merges": names}))

    def repeated(self) -> DataFrame:
        """Each message that arrived more than once in all deliveries: document_id, boomerang_update_count, path."""
        live = self._live(self._log())
        seen = self._read(live, "bitmaps", BITMAPS).where("repeated <> 0").groupBy("shard", "code", "reflow", "word").agg(F.bit_or("repeated").alias("repeated"))
        named = seen.join(self._read(live, "dictionary", DICTIONARY), ["shard", "code"])
        return bits_of(named, "repeated").select(F.col("id").alias("document_id"), F.col("n_update").alias("boomerang_update_count"), path_name().alias("path"))

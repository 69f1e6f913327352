import random
from collections import Counter

from weirflow.operators import exactly_once as E

SCHEMA = "kafka_topic string, kafka_partition int, kafka_offset bigint, batch_id bigint, document_id string, boomerang_update_count bigint, reflow boolean, payload string, id string, word bigint, code bigint"


def rows_of(n, seed=1):
    rnd = random.Random(seed)
    return [("t", rnd.randint(0, 2), i, i // 10, rnd.choice(["a", "A", " a ", "b", "c", None, "  ", "hot", "hot", "hot"]), rnd.choice([None, 0, 1, 63, 64, 65, -1, 2**62]), rnd.choice([None, True, False]), None, "clash", 7, 8) for i in range(n)]


def key(r):
    d = (r[4] or "").strip(" ").lower()
    return (d, r[5] or 0, "reflow" if r[6] else "realtime") if d else None


def test_repeated_and_one_copy(spark):
    rows = rows_of(300)
    counts = Counter(k for r in rows if (k := key(r)))
    df = spark.createDataFrame(rows, SCHEMA)
    store = E.SeenStore(spark, E_root(spark))
    store.commit(df.where("batch_id % 2 = 0"), "1")
    store.commit(df.where("batch_id % 2 = 1"), "2")
    assert sorted(map(tuple, store.repeated().collect())) == sorted(k for k, n in counts.items() if n > 1)
    assert sorted(tuple(r)[:3] for r in E.one_copy(df).collect()) == sorted(counts)


def E_root(spark):
    from weirflow.shared import scratch

    return scratch(spark, "test-seen")


def test_replay_gives_the_same(spark):
    df = spark.createDataFrame(rows_of(200, 2), SCHEMA)
    store = E.SeenStore(spark, E_root(spark), shards=4)
    first = sorted(store.deliver(df.where("kafka_offset < 100"), "1").collect())
    second = sorted(store.deliver(df.where("kafka_offset >= 100"), "2").collect())
    assert sorted(store.deliver(df.where("kafka_offset < 100"), "1").collect()) == first
    assert store.deliveries() == ["1", "2"]
    keys = [tuple(r)[:3] for r in first + second]
    assert len(keys) == len(set(keys)) == len({k for r in rows_of(200, 2) if (k := key(r))})
    assert store.deliver(df, "3").count() == 0


def test_compaction_changes_nothing(spark):
    rows = rows_of(300, 3)
    df = spark.createDataFrame(rows, SCHEMA)
    parts = [df.where(f"kafka_offset % 3 = {i}") for i in range(3)]
    plain, packed = E.SeenStore(spark, E_root(spark), shards=3), E.SeenStore(spark, E_root(spark), shards=3)
    for name, part in zip("124", parts, strict=True):
        expected = sorted(plain.deliver(part, name).collect())
        assert sorted(packed.deliver(part, name).collect()) == expected
        packed.compact()
    assert packed.deliveries() == ["1", "2", "4"] and len(packed._live(packed._log())) == 1
    assert sorted(packed.repeated().collect()) == sorted(plain.repeated().collect())
    assert sorted(packed.deliver(parts[0], "1").collect()) == sorted(plain.deliver(parts[0], "1").collect())


def test_ids_are_stored_once(spark):
    root = E_root(spark)
    store = E.SeenStore(spark, root, shards=2)
    df = spark.createDataFrame(rows_of(300), SCHEMA)
    store.commit(df.where("batch_id < 15"), "1")
    store.commit(df.where("batch_id >= 15"), "2")
    ids = [r.id for r in store._read(store._live(store._log()), "dictionary", E.DICTIONARY).collect()]
    assert len(ids) == len(set(ids)) == len({k[0] for r in rows_of(300) if (k := key(r))})
    assert "id" not in store._read(store._live(store._log()), "bitmaps", E.BITMAPS).columns


def test_two_writers_of_one_delivery(spark, monkeypatch):
    """The one that publishes later reads back what the first committed."""
    root = E_root(spark)
    df = spark.createDataFrame(rows_of(100), SCHEMA)
    one, two = E.SeenStore(spark, root, shards=2), E.SeenStore(spark, root, shards=2)
    first = sorted(one.commit(df, "1").collect())
    read = [{}, one._log()]
    monkeypatch.setattr(two, "_log", lambda: read.pop(0))
    assert sorted(two.commit(df.limit(5), "1").collect()) == first == sorted(one.commit(df, "1").collect())


def test_codes_are_dense_and_exact(spark):
    messages = E.arrivals(spark.createDataFrame(rows_of(300), SCHEMA))
    coded = E.encode(E.words(messages, 2)).select("shard", "id", "code").distinct().collect()
    assert len({r.id for r in coded}) == len(coded)
    for shard in {r.shard for r in coded}:
        assert sorted(r.code for r in coded if r.shard == shard) == list(range(sum(r.shard == shard for r in coded)))


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert E.one_copy(df).count() == 0
    store = E.SeenStore(spark, E_root(spark))
    store.commit(df, "1")
    assert store.repeated().count() == 0

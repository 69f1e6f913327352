import random

import pytest

from weirflow.operators import change_log as C
from weirflow.shared import scratch

SCHEMA = "change_seq bigint, batch_id bigint, document_id string, boomerang_update_count bigint, op string, timestamp_ms bigint, payload string, key string, run string"


def fold(rows):
    state = {}
    for seq, _, d, n, op, at, payload, *_ in sorted(rows):
        k = (d or "").strip(" ").lower()
        if not k:
            continue
        o = (op or "").strip().lower()
        gone = o in C.DELETES if o in C.DELETES + C.SETS else payload is None
        order = (n or 0, -(2**63) if at is None else at)
        if k not in state or order > state[k][0]:
            state[k] = order, gone
    return sorted((k, o[0]) for k, (o, gone) in state.items() if not gone)


def changes(n, seed):
    rnd = random.Random(seed)
    return [(i, rnd.randint(0, 9), rnd.choice(["x", "X ", "y", "z", None, "", "hot", "hot"]) or None, rnd.choice([None, 0, 1, 2, 3]), rnd.choice(["I", " Update", "upd", "delete", "D", None, "", "what"]), rnd.choice([None, 5, 6, 7]), rnd.choice([None, "{}"]), "clash", "clash") for i in range(n)]


def test_rebuild_is_the_fold(spark):
    for seed in range(4):
        rows = changes(60, seed)
        got = C.rebuild(spark.createDataFrame(rows, SCHEMA), scratch(spark, "log"), runs=5, most=2)
        assert sorted(map(tuple, got.collect())) == fold(rows)


def test_appends_compaction_and_vacuum(spark):
    log = C.ChangeLog(spark, scratch(spark, "log"), buckets=3)
    assert log.current().count() == 0
    rows = changes(90, 9)
    for i in range(3):
        log.append(spark.createDataFrame(rows[i * 30 : i * 30 + 30], SCHEMA))
    before = sorted(map(tuple, log.current().collect()))
    assert before == fold(rows) and len(log.runs()) == 3
    log.compact(1)
    assert len(log.runs()) == 1 and sorted(map(tuple, log.current().collect())) == before
    log.vacuum()
    assert sorted(map(tuple, log.current().collect())) == before


def test_empty_feed(spark):
    assert C.rebuild(spark.createDataFrame([], SCHEMA), scratch(spark, "log")).count() == 0


def test_merging_is_without_a_shuffle(spark):
    log = C.ChangeLog(spark, scratch(spark, "log"), buckets=5)
    for i in range(3):
        log.append(spark.createDataFrame(changes(40, i), SCHEMA))
    merged = log.current()
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert merged.count() == len(merged.collect())


@pytest.mark.parametrize("second", ["append", "compact"])
def test_two_writers(spark, monkeypatch, second):
    """Whoever publishes second fails, and nothing of the first is lost."""
    root, rows = scratch(spark, "log"), changes(60, 5)
    one, two = C.ChangeLog(spark, root, buckets=2), C.ChangeLog(spark, root, buckets=2)
    one.append(spark.createDataFrame(rows[:20], SCHEMA))
    one.append(spark.createDataFrame(rows[20:40], SCHEMA))
    version = two._version()
    one.append(spark.createDataFrame(rows[40:], SCHEMA))
    monkeypatch.setattr(two, "_version", lambda: version)
    with pytest.raises(RuntimeError, match="another writer"):
        two.append(spark.createDataFrame(rows[:5], SCHEMA)) if second == "append" else two.compact(1)
    assert sorted(map(tuple, one.current().collect())) == fold(rows)


def test_all_deleted(spark):
    log = C.ChangeLog(spark, scratch(spark, "log"), buckets=2)
    for at in (1, 2):
        log.append(spark.createDataFrame([(at, 1, "x", at, "D", at, None, "", "")], SCHEMA))
    log.compact(1)
    assert log.current().count() == 0
    log.append(spark.createDataFrame([(3, 1, "x", 0, "I", 3, None, "", "")], SCHEMA))
    assert [tuple(r) for r in log.current().collect()] == [("x", 0)]

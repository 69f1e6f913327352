import datetime as dt
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from weirflow.operators import instants as I
from weirflow.plans.corpus_queries import p5_found

UTC = dt.timezone.utc


def ms(*a, micro=0):
    return int(dt.datetime(*a, micro, tzinfo=UTC).timestamp() * 1000) if len(a) == 6 else int(dt.datetime(*a, tzinfo=UTC).timestamp() * 1000)


CASES = [
    ("2024-06-02 06:08:51 UTC", ms(2024, 6, 2, 6, 8, 51)), ("1747659302", 1747659302000), ("1695119414055", 1695119414055), ("1745867017931608", 1745867017931), ("1745867017931608123", 1745867017931),
    ("Sat, 25 Nov 2023 12:46:24 +0000", ms(2023, 11, 25, 12, 46, 24)), ("20220701T181059Z", ms(2022, 7, 1, 18, 10, 59)), ("20230113235724", ms(2023, 1, 13, 22, 57, 24)), ("20230113", ms(2023, 1, 12, 23, 0, 0)),
    ("2023-10-05T01:57:49.871999909Z", ms(2023, 10, 5, 1, 57, 49) + 871), ("2023-06-13T08:04:17+09:00[Asia/Tokyo]", ms(2023, 6, 12, 23, 4, 17)), ("2023-05-16T01:56+1000", ms(2023, 5, 15, 15, 56, 0)),
    ("2024-06-31", None), ("2024-06-10T25:61:00", None), ("31.11.2025 19:41", None), ("spring 2023", None), ("Q3 2025", None), ("-1", None), ("0", None), ("", None), (None, None), ("2024-01-01 12:00:00 XYZ", None),
    ("01/08/2024 7:43 AM", ms(2024, 8, 1, 5, 43, 0)), ("10/27/2023 11:39 PM", ms(2023, 10, 27, 21, 39, 0)), ("12/01/2023 12:05 AM", ms(2023, 1, 11, 23, 5, 0)), ("07.04.22 17:24", ms(2022, 4, 7, 15, 24, 0)),
    ("24 März 2023 16:49", ms(2023, 3, 24, 15, 49, 0)), ("12 diciembre 2023 06:03", ms(2023, 12, 12, 5, 3, 0)), ("23 août 2024 02:04", ms(2024, 8, 23, 0, 4, 0)), ("  14 Nov 2024 02:57:43 ", ms(2024, 11, 14, 1, 57, 43)),
    ("2023-03-26T02:30:00", ms(2023, 3, 26, 1, 30, 0)), ("2023-10-29T02:30:00", ms(2023, 10, 29, 0, 30, 0)), ("2024-11-03T01:30:00[America/New_York]", ms(2024, 11, 3, 5, 30, 0)), ("2023-07-01 00:00:00 PDT", ms(2023, 7, 1, 7, 0, 0)),
    ("2024-02-29", ms(2024, 2, 28, 23, 0, 0)), ("2023-02-29", None),
]


@pytest.mark.parametrize("us", [False])
def test_forms(spark, us):
    df = spark.createDataFrame([(i, t, "x", 1) for i, (t, _) in enumerate(CASES)], "i int, t string, region string, instant_ms int")
    parsed = I.parse(df.repartition(1), [F.col("i")], F.col("t"), F.lit(us))
    got = {r.i: r.v for r in parsed.select("i", I.resolve(F.lit("Europe/Berlin")).alias("v")).collect()}
    assert [(t, got.get(i)) for i, (t, _) in enumerate(CASES)] == CASES


def test_month_first(spark):
    df = spark.createDataFrame([("01/08/2024", True), ("01/08/2024", False), ("13/08/2024", True), ("01.08.2024", True), ("01/08/2024", None)], "t string, us boolean")
    got = [r.v for r in I.parse(df.coalesce(1), [F.col("t")], F.col("t"), F.col("us")).select(I.resolve(F.lit("UTC")).alias("v")).collect()]
    assert got == [ms(2024, 1, 8), ms(2024, 8, 1), ms(2024, 8, 13), ms(2024, 8, 1), ms(2024, 8, 1)]


def test_zones_are_found_by_their_violations(spark):
    zones = ["UTC", "America/New_York", "Europe/Berlin", "Asia/Tokyo"]
    rows = []
    from zoneinfo import ZoneInfo

    for s, z in enumerate(zones):
        for i in range(40):
            at = dt.datetime(2024, 1, 1, tzinfo=UTC) + dt.timedelta(days=9 * i, hours=i % 24)
            wall = at.astimezone(ZoneInfo(z)).replace(tzinfo=UTC)
            rows.append((s, int(wall.timestamp() * 1000), int(at.timestamp() * 1000) + 60_000 * (i % 50)))
    data = spark.createDataFrame(rows, "source int, wall_ms bigint, ingested_ms bigint")
    several = spark.createDataFrame([(s, z, k) for s in range(4) for k, z in enumerate(zones)], "source int, zone string, rank int")
    assert {r.source: r.zone for r in I.choose_zones(data, several).collect()} == dict(enumerate(zones))
    one = spark.createDataFrame([(9, "Asia/Tokyo", 0)], "source int, zone string, rank int")
    assert [r.zone for r in I.choose_zones(data, one).collect()] == ["Asia/Tokyo"]


def test_a_declared_zone_is_weighed_and_taken(spark):
    """Its rows fit UTC, which the violations tell; the source declares another zone all the same."""
    rows = spark.createDataFrame([(1, 1_700_000_000_000 + i, 1_700_000_060_000 + i) for i in range(5)] + [(None, 1, 1)], "source int, wall_ms bigint, ingested_ms bigint")
    zones = spark.createDataFrame([(1, "Asia/Tokyo", 0, True), (1, "UTC", 1, False), (2, "UTC", 0, True)], "source int, zone string, rank int, declared boolean")
    got = {r.source: tuple(r)[1:] for r in I.choose_zones(rows, zones).collect()}
    assert got == {1: ("Asia/Tokyo", 5, 5), 2: ("UTC", 0, 0)}


def test_a_store_without_a_zone_gets_what_its_rows_tell(spark, tmp_path):
    """A declared zone is taken though its rows fit another; null and unknown stores, and those that nothing tells of, are UTC."""
    save = lambda rows, schema, name: spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    save([("tokyo", "JP", "Asia/Tokyo"), ("york", "US", "America/New_York"), ("none", "US", None), ("blank", "DE", " "), ("idle", "DE", None)], "store_id string, country string, timezone string", "stores")
    rows, expected = [], {}
    for i in range(30):
        # The clocks of tokyo and blank show UTC, those of none New York's time, in summer and in winter.
        at = dt.datetime(2024, 1, 5, 12, 1, tzinfo=UTC) + dt.timedelta(days=11 * i)
        york = at.astimezone(ZoneInfo("America/New_York")).replace(tzinfo=None)
        for k, (store, clock, zone) in enumerate([("tokyo", at, "Asia/Tokyo"), ("york", york, "America/New_York"), ("none", york, "America/New_York"), ("blank", at, "UTC"), ("idle", york.replace(hour=0, minute=0), "UTC"), (None, york, "UTC"), ("other", york, "UTC")]):
            rows.append((10 * i + k, store, f"{clock:%Y-%m-%dT%H:%M:%S}", (at + dt.timedelta(minutes=i)).replace(tzinfo=None)))
            expected[10 * i + k] = int(clock.replace(tzinfo=ZoneInfo(zone)).timestamp() * 1000)
    save(rows, "record_id bigint, store_id string, purchase_date string, ingested_at timestamp_ntz", "purchase_documents")
    save([], "record_id bigint, registration_date string", "client_documents")
    assert {r.record_id: r.utc_millis for r in p5_found(spark, str(tmp_path)).collect()} == expected


def test_empty(spark):
    df = spark.createDataFrame([], "i int, t string")
    assert I.parse(df, [F.col("i")], F.col("t"), F.lit(True)).select(I.resolve(F.lit("UTC"))).count() == 0

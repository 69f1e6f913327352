"""All strings of the small tables against a second reading of the rules, in plain Python."""

import datetime as dt
import os
import re
from zoneinfo import ZoneInfo

import pandas as pd
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
UTC = dt.timezone.utc
EPOCH = dt.datetime(1970, 1, 1, tzinfo=UTC)
OFFSETS = {"Z": 0, "UTC": 0, "GMT": 0, "JST": 540, "EDT": -240, "CEST": 120, "CET": 60, "EST": -300, "MST": -420, "PDT": -420, "CDT": -300, "PST": -480, "CST": -360}
NAMES = "jan januar january janvier enero|feb februar february février febrero|mar märz march mars marzo|apr april avril abril|may mai mayo|jun juni june juin junio|jul juli july juillet julio|aug august août agosto|sep september septembre septiembre|oct oktober october octobre octubre|nov november novembre noviembre|dec dezember december décembre diciembre"
MONTH = {n: i + 1 for i, names in enumerate(NAMES.split("|")) for n in names.split()}


def wall(zone, *parts):
    at = dt.datetime(*parts, tzinfo=ZoneInfo(zone))  # fold 0: the earlier of two, and forward out of a gap
    return (at.astimezone(UTC) - EPOCH) // dt.timedelta(milliseconds=1)


def instant(text, us, zone):
    s = text.strip()
    try:
        if s.isdigit():
            for unit in (1, 10**3, 10**6, 10**9):
                if 946684800 * unit <= int(s) < 2240611200 * unit:
                    return int(s) * 1000 // unit
            return wall(zone, *(int(s[a:b]) for a, b in ((0, 4), (4, 6), (6, 8), (8, 10), (10, 12), (12, 14)))) if len(s) == 14 else None
        s = re.sub(r"\[.*\]$", "", s)
        offset = None
        if m := re.search(r"(?<=\d)\s*([+-])(\d\d):?(\d\d)$", s) if "T" in s or " " in s else None:
            offset, s = (1 if m[1] == "+" else -1) * (int(m[2]) * 60 + int(m[3])), s[: m.start()].strip()
        elif (m := re.search(r"\s?(Z|[A-Z]{3,4})$", s)) and m[1] in OFFSETS:
            offset, s = OFFSETS[m[1]], s[: m.start()].strip()
        s = re.sub(r"^[A-Z][a-z]{2}, ", "", s)
        h = mi = sec = micro = 0
        if m := re.search(r"[T ](\d{1,2}):(\d\d)(?::(\d\d)(?:\.(\d+))?)?(?: ([AP]M))?$", s):
            h, mi, sec, micro = int(m[1]), int(m[2]), int(m[3] or 0), int(((m[4] or "") + "000000")[:6])
            if m[5]:
                h = h % 12 + 12 * (m[5] == "PM")
            s = s[: m.start()]
        elif m := re.fullmatch(r"(\d{8})T(\d\d)(\d\d)(\d\d)", s):
            h, mi, sec, s = int(m[2]), int(m[3]), int(m[4]), f"{m[1][:4]}-{m[1][4:6]}-{m[1][6:]}"
        if m := re.fullmatch(r"(\d{4})[-/](\d\d)[-/](\d\d)", s):
            y, mo, d = map(int, m.groups())
        elif m := re.fullmatch(r"(\d\d)\.(\d\d)\.(\d{4}|\d\d)", s):
            d, mo, y = map(int, m.groups())
        elif m := re.fullmatch(r"(\d\d)/(\d\d)/(\d{4})", s):
            a, b, y = map(int, m.groups())
            mo, d = (a, b) if b > 12 or us and a <= 12 else (b, a)
        elif (m := re.fullmatch(r"(\d{1,2}) (\w+) (\d{4})", s)) and m[2].lower() in MONTH:
            d, mo, y = int(m[1]), MONTH[m[2].lower()], int(m[3])
        else:
            return None
        y += 2000 * (y < 100)
        return wall(zone if offset is None else "UTC", y, mo, d, h, mi, sec, micro) - 60_000 * (offset or 0)
    except ValueError:
        return None


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the test tables aren't here")
def test_all_strings(spark):
    stores = pd.read_parquet(f"{FOLDER}/stores.parquet").set_index("store_id")
    expected = {}
    for r in pd.read_parquet(f"{FOLDER}/purchase_documents.parquet").itertuples():
        known = r.store_id in stores.index
        if r.purchase_date is not None:
            expected["purchase_documents", r.record_id] = instant(r.purchase_date, known and stores.country[r.store_id] == "US", stores.timezone[r.store_id] if known else "UTC")
    for r in pd.read_parquet(f"{FOLDER}/client_documents.parquet").itertuples():
        if r.registration_date is not None:
            expected["client_documents", r.record_id] = instant(r.registration_date, False, "UTC")
    got = {(r.source_table, r.record_id): r.utc_millis for r in entry.queries()["p5_found"](spark, FOLDER).collect()}
    assert got == {k: v for k, v in expected.items() if v is not None}

"""Timestamps of any form as UTC instants.

Three steps, all in the JVM: ``parse`` reads the string into a wall clock (or an instant, if it names its
offset or zone), ``choose_zones`` gives each source of zoneless strings an offset history, and ``resolve``
converts the wall clocks.

An offset history is a named zone, so daylight-saving changes come with it. A source's zone is chosen among
the admissible ones by its violations: with the right zone a zoneless time is never later than the row's
ingestion and seldom much earlier, while a wrong one shifts all of a source's rows, or those of one season,
out of that window. Violations are counted by one aggregation per (source, zone); ties go to the zone
listed first. A zone that a source declares is the one history that its rows may follow: it is weighed like the others, and taken.

Defined cases: null, blank, unreadable and impossible strings (31 April, 25:61) give null; surrounding white
space is ignored; digits below the millisecond are cut off; a missing time of day is midnight; a wall clock
that occurs twice is the earlier instant, a skipped one moves forward by the gap; an offset in the string
beats a zone in brackets; weekday names are not checked; an unknown zone abbreviation, a zone name outside brackets, an ISO
week, the day of a year, the hour 24 and the second 60 make the string unreadable. Ties, repeated rows and other columns pass through unchanged; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Offsets of zone abbreviations in minutes, North American or European meaning first (fixed values).
ABBREVIATIONS = {
    "Z": 0, "UT": 0, "UTC": 0, "GMT": 0, "WET": 0, "WEST": 60, "BST": 60, "IST": 60, "CET": 60, "MEZ": 60, "MET": 60, "CEST": 120, "MESZ": 120, "MEST": 120, "EET": 120, "EEST": 180, "MSK": 180, "TRT": 180,
    "NST": -210, "NDT": -150, "AST": -240, "ADT": -180, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420, "AKST": -540, "AKDT": -480, "HST": -600,
    "BRT": -180, "JST": 540, "KST": 540, "SGT": 480, "HKT": 480, "AWST": 480, "AEST": 600, "AEDT": 660, "NZST": 720, "NZDT": 780,
}
#: Month names by number: English, German, French, Spanish, Italian, Portuguese, without accents (fixed values).
MONTHS = (
    "jan january januar janner janvier janv enero ene gennaio gen janeiro",
    "feb february februar fevrier fevr febrero febbraio fevereiro fev",
    "mar march marz mrz maerz mars marzo marco",
    "apr april avril avr abril abr aprile",
    "may mai mayo maggio mag maio",
    "jun june juni juin junio giugno giu junho",
    "jul july juli juil juillet julio luglio lug julho",
    "aug august aout agosto ago",
    "sep sept september septembre septiembre settembre set setembro",
    "oct october okt oktober octobre octubre ottobre ott outubro out",
    "nov november novembre noviembre novembro",
    "dec december dez dezember decembre diciembre dic dicembre dezembro",
)
ACCENTS = ("áàâäãåçéèêëíìîïñóòôöõúùûüű", "aaaaaaceeeeiiiinooooouuuuu")

_ZONE = r"(?:\s*(Z|[+-]\d{2}(?::?\d{2})?(?![\d:])|(?:UTC|GMT)[+-]\d{1,2}(?::?\d{2})?|[A-Za-z]{1,5})?\s*(?:[\[(]([A-Za-z_+\-/0-9]+)[\])])?)?"
_TIME = r"(?:(?:,?\s+|[Tt]\s*|\s+(?:at|um|a las|à)\s+)(\d{1,2})[:.h](\d{2})(?::(\d{2})(?:[.,](\d{1,12}))?)?\s*((?i:[ap]\.?m\.?))?" + _ZONE + r")?"
#: Groups in the order of each pattern: y, mo, d, h, mi, s, fraction, am/pm, zone, region.
_ISO = rf"^(\d{{4}})[-/.](\d{{1,2}})[-/.](\d{{1,2}}){_TIME}$"
_BASIC = r"^(\d{4})(\d{2})(\d{2})[Tt ](\d{2})(\d{2})(?:(\d{2})(?:[.,](\d{1,12}))?)?()" + _ZONE + "$"
_PAIR = rf"^(\d{{1,2}})([./-])(\d{{1,2}})\2(\d{{4}}|\d{{2}}){_TIME}$"
_WORD = r"(?:[A-Za-z]+\.?,?\s+)?"
_NAME = r"(\p{L}{3,10})\.?"
_DAY_FIRST = rf"^{_WORD}(\d{{1,2}})(?:st|nd|rd|th|\.|er|º)?[\s-]+(?:de\s+)?{_NAME},?[\s-]+(?:de\s+|del\s+)?(\d{{4}}|\d{{2}}){_TIME}$"
_NAME_FIRST = rf"^{_WORD}{_NAME}\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}}){_TIME}$"
_FIELDS = "$4|$5|$6|$7|$8|$9|$10"
#: Epoch seconds of 2000-01-01 and 2041-01-01.
_FROM, _UNTIL = 946684800, 2240611200


def _epoch_ms(s: Column) -> Column:
    """Milliseconds of a bare number in the unit that puts it into 2000 to 2040."""
    n = s.try_cast("bigint")
    within = lambda unit: (n >= F.lit(_FROM * unit)) & (n < F.lit(min(_UNTIL * unit, 2**63 - 1)))
    cut = lambda by: F.call_function("div", n, F.lit(by).cast("bigint"))
    return F.when(within(1), n * 1000).when(within(1000), n).when(within(1_000_000), cut(1000)).when(within(1_000_000_000), cut(1_000_000))


def _parts(s: Column, month_first: Column) -> Column:
    """The string's fields joined by bars: y|mo|d|h|mi|s|fraction|am/pm|zone|region; null if no pattern fits."""
    a, b = F.regexp_extract(s, _PAIR, 1).try_cast("int"), F.regexp_extract(s, _PAIR, 3).try_cast("int")
    confusable = (a <= 12) & (b <= 12)
    dotted = F.regexp_extract(s, _PAIR, 2) == "."
    swap = ~dotted & F.when(confusable, month_first).otherwise(b > 12)
    # Group 2 of _PAIR is the separator, so its fields are numbered one higher.
    pair = F.when(swap, F.regexp_replace(s, _PAIR, "$4|$1|$3|$5|$6|$7|$8|$9|$10|$11")).otherwise(F.regexp_replace(s, _PAIR, "$4|$3|$1|$5|$6|$7|$8|$9|$10|$11"))
    digits = F.regexp_replace(s, r"^(\d{4})(\d{2})(\d{2})(?:(\d{2})(\d{2})(\d{2})?(\d{3})?)?$", "$1|$2|$3|$4|$5|$6|$7|||")
    return (
        F.when(s.rlike(_ISO), F.regexp_replace(s, _ISO, f"$1|$2|$3|{_FIELDS}"))
        .when(s.rlike(r"^\d+$"), F.when(F.length(s).isin(8, 12, 14, 17), digits))
        .when(s.rlike(_BASIC), F.regexp_replace(s, _BASIC, f"$1|$2|$3|{_FIELDS}"))
        .when(s.rlike(_PAIR), pair)
        .when(s.rlike(_DAY_FIRST), F.regexp_replace(s, _DAY_FIRST, f"$3|$2|$1|{_FIELDS}"))
        .when(s.rlike(_NAME_FIRST), F.regexp_replace(s, _NAME_FIRST, f"$3|$1|$2|{_FIELDS}"))
    )


def _lookup(pairs: dict[str, int], key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for p in pairs.items() for x in p]), key)


def _fixed(df: DataFrame, *keep: str, **columns: Column) -> DataFrame:
    """Adds columns by a generator: through a projection the optimizer would repeat their expressions in whatever uses them."""
    return df.select(*keep, F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))


def parse(df: DataFrame, keep: list[Column], text: Column, month_first: Column) -> DataFrame:
    """The columns ``keep`` with ``instant_ms`` (the string names its instant), or ``wall_ms`` (a wall clock as if in UTC) and ``region`` (its zone in brackets, if any)."""
    kept = [f"_k{i}" for i in range(len(keep))]
    names = df.select(*keep).columns
    df = df.select(*(c.alias(k) for c, k in zip(keep, kept, strict=True)), F.regexp_replace(text, r"^[\s\u00a0]+|[\s\u00a0]+$", "").alias("_s"), F.coalesce(month_first, F.lit(False)).alias("_first"))
    s = F.col("_s")
    fraction = F.rpad(F.substring(F.substring_index(s, ".", -1), 1, 3), 3, "0").try_cast("bigint")
    df = _fixed(df, *kept, "_s", "_first", _epoch=F.when(s.rlike(r"^\d{9,19}$"), _epoch_ms(s)).when(s.rlike(r"^\d{9,10}\.\d+$"), _epoch_ms(F.substring_index(s, ".", 1)) + fraction))
    df = _fixed(df, *kept, "_epoch", _p=F.when(F.col("_epoch").isNull(), F.split(_parts(s, F.col("_first")), r"\|")))
    part = lambda k: F.get("_p", F.lit(k))
    number = lambda k: F.coalesce(part(k).try_cast("int"), F.lit(0))
    name = F.translate(F.lower(part(1)), *ACCENTS)
    months = {n: i + 1 for i, names in enumerate(MONTHS) for n in names.split()}
    fields = {
        "_y": F.when(F.length(part(0)) == 2, number(0) + 2000).otherwise(number(0)),
        "_m": F.coalesce(part(1).try_cast("int"), _lookup(months, name), F.lit(0)),
        "_d": number(2), "_h0": number(3), "_mi": number(4), "_sec": number(5),
        "_frac": F.rpad(F.substring(part(6), 1, 3), 3, "0").try_cast("int"),
        "_ap": F.lower(F.substring(part(7), 1, 1)), "_z": F.upper(part(8)), "region": F.nullif(part(9), F.lit("")),
    }
    df = _fixed(df, *kept, "_epoch", "_p", **fields)
    y, m, d = F.col("_y"), F.col("_m"), F.col("_d")
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    last = F.when(m.isin(4, 6, 9, 11), 30).when(m == 2, F.when(leap, 29).otherwise(28)).otherwise(31)
    ap, h0 = F.coalesce(F.col("_ap"), F.lit("")), F.col("_h0")
    hour = F.when(ap == "", h0).otherwise(h0 % 12 + F.when(ap == "p", 12).otherwise(0))
    fits = F.col("_p").isNotNull() & (y >= 1) & m.between(1, 12) & (d >= 1) & (d <= last) & (F.when(ap == "", h0.between(0, 23)).otherwise(h0.between(1, 12))) & F.col("_mi").between(0, 59) & F.col("_sec").between(0, 59)
    days = F.when(fits, F.unix_date(F.make_date(F.when(fits, y), F.when(fits, m), F.when(fits, d))))
    local = (((days.cast("bigint") * 24 + hour) * 60 + F.col("_mi")) * 60 + F.col("_sec")) * 1000 + F.coalesce("_frac", F.lit(0))
    zone = F.coalesce(F.col("_z"), F.lit(""))
    numeric = r"^(?:UTC|GMT)?([+-])(\d{1,2}):?(\d{2})?$"
    minutes = (F.regexp_extract(zone, numeric, 2).try_cast("int") * 60 + F.coalesce(F.regexp_extract(zone, numeric, 3).try_cast("int"), F.lit(0))) * F.when(F.regexp_extract(zone, numeric, 1) == "-", -1).otherwise(1)
    offset = F.when(zone == "", F.lit(None).cast("int")).when(zone.rlike(numeric), F.when((minutes <= 1080) & (minutes >= -1080), minutes)).otherwise(_lookup(ABBREVIATIONS, zone))
    df = _fixed(df, *kept, "_epoch", "region", _local=local, _z=zone, _offset=offset)
    readable = (F.col("_z") == "") | F.col("_offset").isNotNull()
    instant = F.coalesce("_epoch", F.when(F.col("_z") != "", F.col("_local") - F.col("_offset").cast("bigint") * 60_000))
    wall = F.when(readable & (F.col("_z") == ""), F.col("_local"))
    return _fixed(df, *kept, "region", instant_ms=instant, wall_ms=wall).select(*(F.col(k).alias(n) for k, n in zip(kept, names, strict=True)), "region", "instant_ms", "wall_ms")


def to_utc_ms(wall_ms: Column, zone: Column) -> Column:
    """A wall clock (milliseconds as if in UTC) in a named zone as epoch milliseconds."""
    return F.unix_millis(F.to_utc_timestamp(F.timestamp_millis(wall_ms), zone))


def choose_zones(rows: DataFrame, admissible: DataFrame, late_ms: int = 3 * 3_600_000) -> DataFrame:
    """The zone of each source, by violations: columns source, zone, violations, rows.

    ``rows`` has source, wall_ms and ingested_ms; ``admissible`` has source, zone and rank, a bounded list of
    zones per source, and may have ``declared``: a source with a declared zone gets that one, whatever the others' weight, so its
    violations only tell how well it fits. A row violates a zone if its instant lies after its ingestion, or more than
    ``late_ms`` before it, and then weighs as much as that; any other row weighs as it is late. The least weight wins. A row
    that is late in every zone counts against all alike. A source without rows gets the zone of its first rank.
    """
    if "declared" not in admissible.columns:
        admissible = admissible.withColumn("declared", F.lit(False))
    lag = F.col("ingested_ms") - to_utc_ms(F.col("wall_ms"), F.col("zone"))
    wrong = (lag < 0) | (lag > late_ms)
    # Each source's rows are weighed in place and summed up map-side; the zones are a bounded list per source.
    weighed = rows.select("source", "wall_ms", "ingested_ms").join(admissible.select("source", "zone"), "source").groupBy("source", "zone").agg(
        F.sum(F.when(wrong, late_ms).otherwise(lag)).alias("penalty"), F.count_if(wrong).alias("violations"), F.count("*").alias("rows"))
    nothing = F.lit(0).cast("bigint")
    scored = admissible.join(weighed, ["source", "zone"], "left").select("source", "zone", "rank", "declared", *(F.coalesce(c, nothing).alias(c) for c in ("penalty", "violations", "rows")))
    best = scored.groupBy("source").agg(F.min(F.struct((~F.col("declared")).alias("open"), "penalty", "rank", "zone", "violations", "rows")).alias("b"))
    return best.select("source", F.col("b.zone").alias("zone"), F.col("b.violations").alias("violations"), F.col("b.rows").alias("rows"))


def resolve(zone: Column) -> Column:
    """A generator of a parsed row's instant: what the string names, else its wall clock in its own or the given zone; no row if there is none."""
    instant = F.coalesce("instant_ms", to_utc_ms(F.col("wall_ms"), F.coalesce("region", zone)))
    return F.explode(F.array_compact(F.array(instant)))

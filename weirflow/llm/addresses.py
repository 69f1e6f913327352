"""Address records that denote the same building.

All in SQL, numbers first. ``normal`` takes a record apart: flat, floor or unit and postcode are dropped, the
house number (with its letter), the direction and the kind of street are read off, what remains are words of
the street's and the town's name. Words are counted over all rows. Records meet in blocks of the house number
plus a form of any of their words: the word, its beginning with as many letters left out as errors are accepted, or the set of its
letters. Two words that are equal or alike by ``_NEAR`` share a form, and no pair is accepted without such words. A pair that met is accepted if nothing contradicts (number, letter, direction, kind, town, country; a
missing part contradicts nothing) and the words it shares carry most of the rarity of its street's name; words
left over on both sides are compared by edit distance first.

A block is as large as the number of records at one house number with a form of one word. Very many records of
one building are few distinct normal forms: identical forms are compared once, by a representative, and
``same_place`` looks the records up by form again when it lists pairs. ``classes`` gives one row per record
with its class (connected forms) and its form's number of links instead.

Defined cases: a null or blank address takes no part; a null city or a country that isn't known contradicts nothing; an address without a
number only meets others without; a range of numbers is another number than its ends, and a letter from a to z, bis or ter is part of the number;
further numbers (of a street's name) must be those of the other side or some of them; an address of nothing but numbers and kinds
is the place of equal ones only, and one of neither names nor numbers is no place; repeated records are places of the same form; very long addresses are cut
by nothing; other columns are ignored; an empty table gives no pairs.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import written
from .components import components, degrees

_FROM = "áàâäãåāăąæçćčďđéèêëēěęğíìîïīıłľñńňóòôöõøōőřśšşșťţțúùûüūůűýÿžźżßœº" "άέήίόύώϊϋΐΰς" "ёй"
_TO = "aaaaaaaaaacccddeeeeeeegiiiiiillnnnoooooooorsssstttuuuuuuuyyzzzsoo".replace(" ", "") + "αεηιουωιυιυσ" + "еи"
#: Spellings of kinds of street, directions, parts of town names and countries (fixed values).
KINDS = {
    "st": "st street str strasse strase stra", "rd": "rd road", "av": "av ave avenue avenida avda avd", "bd": "bd blvd boul boulevard bvd", "dr": "dr drive drv", "ln": "ln la lane", "te": "ter terr terrace",
    "cl": "cl close calle c", "gd": "gdns gardens gdn garden", "pl": "pl place plaza pza plz platz plza", "ru": "r rue", "ch": "ch che chem chemin", "cm": "cno cmno camino", "ps": "p paseo pso",
    "wg": "wg weg", "ga": "g ga gasse", "al": "al allee", "sq": "sq square", "ct": "ct court", "wy": "way wy", "cr": "cres crescent",
}
DIRECTIONS = {"n": "n no north", "s": "s so south", "e": "e east", "w": "w west"}
TOWN_PARTS = {
    "saint": "st ste sankt saint sainte s san", "santa": "sta santa", "santo": "sto santo", "mount": "mt mount", "mountain": "mtn mountain", "fort": "ft fort", "port": "pt port", "point": "pnt point", "great": "gt great", "little": "lt lit little",
    "upper": "upr up upper", "lower": "lwr lower", "north": "no n north", "south": "so south", "east": "e east", "west": "w west", "new": "nw new", "old": "old", "heights": "hts hgts heights", "falls": "fls falls", "springs": "spgs sprs springs",
    "spring": "spg spring", "village": "vlg vill village", "valley": "vly val valley", "junction": "jct jn junction", "lake": "lk lake", "lakes": "lks lakes", "beach": "bch beach", "center": "ctr cntr center centre", "city": "cty city", "island": "is isl island",
    "harbor": "hbr harbor harbour", "grove": "grv grove", "creek": "crk creek", "ferry": "fry ferry", "bridge": "brg bridge", "villanueva": "vva villanueva", "nuestra": "ntra nuestra", "senora": "sra senora", "ober": "ob ober", "unter": "unt unter", "neu": "neu",
}
OPTIONAL = "de del d la le les las los el the of sur s on am an bad city der die das du des und et y l"
COUNTRIES = {
    "us": "us usa unitedstates unitedstatesofamerica america", "gb": "gb gbr uk unitedkingdom greatbritain england scotland wales britain", "de": "de ger deu germany deutschland brd allemagne alemania", "fr": "fr fra france frankreich francia",
    "es": "es esp spain espana espagne spanien", "it": "it ita italy italia italien italie", "pt": "pt prt portugal", "nl": "nl nld netherlands thenetherlands nederland holland niederlande paysbas", "be": "be bel belgium belgique belgie belgien", "lu": "lu lux luxembourg luxemburg",
    "ch": "ch che switzerland schweiz suisse svizzera suiza", "at": "at aut austria osterreich oesterreich autriche", "ie": "ie irl ireland eire irlande", "dk": "dk dnk denmark danmark", "se": "se swe sweden sverige schweden", "no": "no nor norway norge norwegen",
    "fi": "fi fin finland suomi finnland", "is": "is isl iceland island", "pl": "pl pol poland polska polen", "cz": "cz cze czechia czechrepublic cesko tschechien", "sk": "sk svk slovakia slovensko", "hu": "hu hun hungary magyarorszag ungarn", "ro": "ro rou romania",
    "bg": "bg bgr bulgaria българия", "gr": "gr grc greece hellas griechenland ελλαδα ελλας", "hr": "hr hrv croatia hrvatska", "si": "si svn slovenia slovenija", "rs": "rs srb serbia srbija", "ua": "ua ukr ukraine украина украіна", "ru": "ru rus russia russianfederation россия",
    "tr": "tr tur turkey turkiye turkei", "il": "il isr israel", "ca": "ca can canada kanada", "mx": "mx mex mexico mejico", "br": "br bra brazil brasil", "ar": "ar arg argentina", "cl": "cl chl chile", "co": "co col colombia", "au": "au aus australia", "nz": "nz nzl newzealand",
    "jp": "jp jpn japan 日本", "cn": "cn chn china 中国", "kr": "kr kor southkorea republicofkorea", "in": "in ind india", "za": "za zaf southafrica", "ee": "ee est estonia eesti", "lv": "lv lva latvia latvija", "lt": "lt ltu lithuania lietuva",
}
_UNIT = r"(?:flat|apt|apartment|unit|suite|ste|appt|appartement|app|bat|batiment|piso|planta|puerta|whg|wohnung|etage|floor|room|rm|top)"
#: Words alike: up to two errors by length, or up to four (two swaps) that leave the letters the same but for one, or three in a long word that replace one letter.
_NEAR = """(levenshtein({a}, {b}, 4) between 0 and if(least(length({a}), length({b})) < 5, 0, if(least(length({a}), length({b})) < 8, 1, 2))
  or least(length({a}), length({b})) >= 6 and levenshtein({a}, {b}, 4) between 0 and 4 and abs(length({a}) - length({b})) <= 2
    and size(array_except(split({a}, ''), split({b}, ''))) <= 1 and size(array_except(split({b}, ''), split({a}, ''))) <= 1
    and (levenshtein({a}, {b}, 4) <= 3 and least(length({a}), length({b})) >= 9
      or size(array_except(split({a}, ''), split({b}, ''))) + size(array_except(split({b}, ''), split({a}, ''))) <= 1))"""
#: Whole names of towns alike: those, and two errors from 6 letters on.
_NEAR_TOWN = "(" + _NEAR + " or least(length({a}), length({b})) >= 6 and levenshtein({a}, {b}, 2) between 0 and 2)"
#: Letters that a form of a word keeps.
KEPT = 6
#: Least share of the rarity that the shared words carry, where one side has words left over, and where both have.
OVERLAP, OVERLAP_BOTH = 0.4, 0.85


def plain(c: Column) -> Column:
    """Lower case without accents."""
    return F.regexp_replace(F.translate(F.lower(c), _FROM, _TO), r"\p{M}+", "")


def _fold(word: str) -> str:
    return re.sub("([aou])e", r"\1", word)


def _map(groups: dict[str, str], change=str) -> str:
    return "map(" + ", ".join(f"'{w}', '{k}'" for w, k in {change(w): change(k) for k, ws in groups.items() for w in ws.split()}.items()) + ")"


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"[^\p{L}\p{N}]+"), lambda w: w != "")


#: A house number: a range or one number, with a letter or bis, ter; a letter that stands apart ends the line or is none of a street's abbreviations.
_NUMBER = r"\b\d+(?:-\d+)?(?:-?[a-z]\b|\s?(?:bis|ter|quater)\b|\s-?[a-dfh-kmoqt-vxz]\b(?!\.)|\s-?[a-z]\s*(?=$|[,;]))?"
_ORDINAL = r"\b(\d+)(st|nd|rd|th|eme)\b(?=\s+[\p{L}])"


def has_address(address: str) -> Column:
    return F.trim(F.coalesce(F.col(address), F.lit(""))) != ""


def normal(df: DataFrame, key: str = "record_id", address: str = "address", city: str = "city", country: str = "country") -> DataFrame:
    """Records with an address and its parts: number, more (further numbers), direction, kinds, names (words of street and town), town, country. The key may be a struct."""
    a = F.lower(F.col(address))
    for pattern, by in (
        (r"[\s ]+", " "),
        (r"\bp\.?º|\bp\.º", " paseo "), (r"\bc/", " calle "), (r"(?:\bnº|\bn°|\bn\.º|\bnúm\b\.?|\bnum\b\.?|\bnúmero\b|\bnr\b\.?)", " "),
        (r"\b\d+\s*[ºª°]\s*(?:izq|izda|dcha|der|centro|[a-d])?\b\.?", " "), (r"\b\d+\s*\.?\s*(?:og|stock|etage)\b\.?", " "), (r"#\s*\d+\w*", " "),
    ):
        a = F.regexp_replace(a, pattern, by)
    a = plain(a)
    other_kind = "|".join(sorted({w for k, ws in KINDS.items() if k not in ("st", "wg", "ga", "al", "pl") for w in ws.split() if len(w) > 1}))
    for pattern, by in (
        (rf"\b{_UNIT}\b\.?\s*(?:no\b\.?)?\s*\d+[a-z]?\b", " "),
        # Kinds that are written together with the name; allee without an e only where no other kind is named.
        (rf"(?<=\p{{L}}{{4}})[ -]?(strasse|strase|str\b\.?|gasse|weg\b|wg\b\.?|platz|plz\b\.?|pl\b\.?|allee|alle\b(?!.*\b(?:{other_kind})\b)|al\.|g\.)", " $1 "),
        (r"\bla\b(?=\s+[\p{L}])", " "),
        # Numbers of streets, as in 5th Avenue, are words.
        (_ORDINAL, "o$1o"),
    ):
        a = F.regexp_replace(a, pattern, by)
    # A postcode beside another number.
    a = F.when(a.rlike(r"\b\d{5}\b") & a.rlike(r"\b\d{1,4}[a-z]?\b"), F.regexp_replace(a, r"\b\d{5}\b", " ")).otherwise(a)
    # By a generator: through a projection the optimizer would repeat the whole of it in whatever uses it.
    df = df.where(has_address(address)).select(F.col(key).alias("key"), F.coalesce(F.col(city), F.lit("")).alias("city"), F.coalesce(F.col(country), F.lit("")).alias("land"), F.explode(F.array(a)).alias("a"))
    a = F.col("a")
    blank_city = F.trim("city") == ""
    # Without a city, a street abbreviation before further words may as well be a saint's: then it's neither for certain.
    maybe_saint = blank_city & a.rlike(r"\p{L}{3,}\s+st\b\.?\s+\p{L}{3,}")
    words = F.regexp_replace(a, _NUMBER, " ")
    numbers = F.transform(F.regexp_extract_all(a, F.lit(r"\b(\d+(?:-\d+)?)"), F.lit(1)), lambda n: F.ltrim(n, F.lit("0")))
    df = df.select(
        "key",
        F.regexp_replace(F.ltrim(F.regexp_extract(a, _NUMBER, 0), F.lit("0")), r"\s+-?|-(?=[a-z])", "").alias("number"),
        F.array_sort(F.array_distinct(F.slice(numbers, 2, 2**31 - 1))).alias("more"),
        _words(F.when(maybe_saint, F.regexp_replace(words, r"\bst\b", "saint")).otherwise(words)).alias("w"),
        _words(plain(F.col("city"))).alias("c"),
        F.regexp_replace(plain(F.col("land")), r"[^\p{L}]", "").alias("land"),
        F.regexp_extract(a, r"\b\d+[a-z]?\s+(no|so|[nsew]|north|south|east|west)\b\.?\s+[\p{L}]", 1).alias("way"),
    )
    kinds, ways, parts, lands = _map(KINDS), _map(DIRECTIONS), _map(TOWN_PARTS, _fold), _map(COUNTRIES)
    optional = "array(" + ", ".join(f"'{w}'" for w in OPTIONAL.split()) + ")"
    fold = "regexp_replace(x, '([aou])e', '$1')"  # German spellings of umlauts meet the plain vowel
    town = f"filter(transform(transform(c, x -> {fold}), x -> coalesce({parts}[x], x)), x -> not array_contains({optional}, x))"
    near = _NEAR.format(a="x", b="y")
    # A town's words, and its whole name as one word: it may be written apart or together.
    df = df.withColumn("town", F.expr(town)).withColumn("town_name", F.concat_ws("", "town"))
    town = "if(size(town) < 2, town, array_append(town, town_name))"
    df = df.selectExpr("key", "number", "more", f"{ways}[way] as way", f"transform(w, x -> if({kinds}[x] is null, {fold}, x)) as w", f"{town} as town", "town_name", f"{lands}[land] as country")
    df = df.selectExpr("*", f"explode(array(filter(w, x -> not exists(town, y -> coalesce({parts}[x], x) = y or {near}) and not array_contains({optional}, x) or {kinds}[x] is not null and not array_contains(town, x)))) as v")
    named = f"transform(filter(v, x -> {kinds}[x] is null and {ways}[x] is null and not array_contains({optional}, x)), x -> coalesce({parts}[x], x))"
    # A street or hamlet that is called like its town keeps that name.
    df = df.selectExpr("*", f"explode(array({named})) as named").selectExpr("* except (named)", f"explode(array(if(size(named) > 0, named, {named.replace('filter(v,', 'filter(w,')}))) as named")
    return df.selectExpr(
        "key", "number", "more", "country", "way",
        f"array_sort(array_distinct(filter(transform(v, x -> {kinds}[x]), x -> x is not null))) as kinds", "array_sort(array_distinct(named)) as names",
        # Without a city its name is among the words, maybe in two: neighbours are kept as pairs.
        "if(town_name = '' and size(named) > 1, array_sort(array_distinct(transform(sequence(1, size(named) - 1), i -> concat(named[i - 1], ' ', named[i])))), cast(array() as array<string>)) as couples",
        "array_sort(town) as town", "town_name",
    )


FORM = ("number", "more", "country", "kinds", "way", "names", "couples", "town", "town_name")


def _large(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the rows. Its size is guessed from small files, before lists are exploded and texts unpacked, so it
    would be sent through the driver as if it were small."""
    return df.hint("merge")


def _rarity(forms: DataFrame) -> DataFrame:
    """Forms with ``rarity``: word -> weight, by the number of rows that have the word."""
    words = forms.select("form", "rows", F.explode("names").alias("word"))
    counts = words.groupBy("word").agg(F.sum("rows").alias("n"))
    total = forms.agg(F.sum("rows")).first()[0] or 0
    weighed = words.join(_large(counts), "word").withColumn("weight", F.log(1 + F.lit(total) / F.col("n")))
    listed = weighed.groupBy("form").agg(F.sort_array(F.collect_list(F.struct("weight", "word")), asc=False).alias("l"))
    return forms.join(_large(listed), "form").select(forms["*"], F.map_from_arrays(F.col("l.word"), F.col("l.weight")).alias("rarity"))


def word_forms(word: str) -> str:
    """SQL: forms of a word such that two words share one if they are equal or ``_NEAR`` holds.

    Words within n edits have a common rest after at most n letters are left out on either side; its first ``KEPT``
    letters stand within the first ``KEPT + n`` of both, filled up at the end. Words whose sets of letters differ by
    one letter at most share a set, or one's set is the other's without a letter.
    """
    one, two = (f"rpad(left({word}, {KEPT + n}), {KEPT + n}, '_')" for n in (1, 2))
    letters = f"array_sort(array_distinct(split({word}, '')))"
    return f"""array_distinct(concat(array({word}),
      if(length({word}) between 5 and 8, transform(sequence(1, {KEPT + 1}), i -> concat('1', substring({one}, 1, i - 1), substring({one}, i + 1))), array()),
      if(length({word}) >= 8, flatten(transform(sequence(1, {KEPT + 1}), i -> transform(sequence(i + 1, {KEPT + 2}), j -> concat('2', substring({two}, 1, i - 1), substring({two}, i + 1, j - i - 1), substring({two}, j + 1))))), array()),
      if(length({word}) >= 6, transform(array_append({letters}, ''), c -> concat('3', array_join(array_remove({letters}, c), ''))), array())))"""


def form_pairs(forms: DataFrame) -> DataFrame:
    """Pairs of form ids that denote the same building."""
    weighed = written(_rarity(forms), "forms")
    # A block is a hash of the number and a form of a word: what is met by a collision is refused like any other pair.
    blocks = "explode(array_distinct(flatten(transform(names, y -> transform(" + word_forms("y") + ", z -> xxhash64(number, z)))))) as block"
    keys = weighed.selectExpr("form", blocks)
    met = keys.select(F.col("form").alias("a"), "block").join(_large(keys.select(F.col("form").alias("b"), "block")), "block").where("a < b").select("a", "b").distinct()
    side = lambda s: _large(weighed.select(F.col("form").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in (*FORM, "rarity"))))
    pairs = met.join(side("a"), "a").join(side("b"), "b")
    pairs = pairs.where("number_a = number_b and (size(array_except(more_a, more_b)) = 0 or size(array_except(more_b, more_a)) = 0) and coalesce(country_a = country_b, true) and coalesce(way_a = way_b, true)").where("size(kinds_a) = 0 or size(kinds_b) = 0 or arrays_overlap(kinds_a, kinds_b)")
    near, town_near = _NEAR.format(a="x", b="y"), _NEAR_TOWN.format(a="town_name_a", b="town_name_b")
    pairs = pairs.selectExpr("*", "array_intersect(names_a, names_b) as common").selectExpr("*", "array_except(names_a, common) as rest_a", "array_except(names_b, common) as rest_b")
    # Two neighbours of one side that together are the other's town.
    coupled = lambda s, t: f"exists(couples_{s}, z -> array_contains(split(z, ' '), x) and {_NEAR.format(a=f'town_name_{t}', b="replace(z, ' ', '')")})"
    # Words left over are first matched with each other, then with the other side's town.
    pairs = pairs.selectExpr("*", f"filter(rest_a, x -> exists(rest_b, y -> {near})) as like_a", f"filter(rest_b, x -> exists(rest_a, y -> {near})) as like_b")
    pairs = pairs.selectExpr(
        "*",
        f"filter(rest_a, x -> not array_contains(like_a, x) and (exists(town_b, y -> {near}) or {coupled('a', 'b')})) as in_town_a", f"filter(rest_b, x -> not array_contains(like_b, x) and (exists(town_a, y -> {near}) or {coupled('b', 'a')})) as in_town_b",
    )
    pairs = pairs.selectExpr("*", "array_except(array_except(rest_a, like_a), in_town_a) as left_a", "array_except(array_except(rest_b, like_b), in_town_b) as left_b")
    weight = lambda words, s: f"aggregate({words}, 0d, (s, x) -> s + rarity_{s}[x])"
    pairs = pairs.selectExpr("*", f"{weight('array_union(common, like_a)', 'a')} as shared_a", f"{weight('array_union(common, like_b)', 'b')} as shared_b", f"{weight('left_a', 'a')} as lost_a", f"{weight('left_b', 'b')} as lost_b")
    parts = "array(" + ", ".join(f"'{_fold(k)}'" for k in TOWN_PARTS) + ")"
    towns = f"""case when town_name_a <> '' and town_name_b <> '' then town_name_a = town_name_b or {town_near}
        or exists(town_a, x -> length(x) >= 4 and not array_contains({parts}, x) and exists(town_b, y -> {near}))
          and (size(array_intersect(town_a, {parts})) = 0 or size(array_intersect(town_b, {parts})) = 0 or arrays_overlap(array_intersect(town_a, {parts}), town_b))
      when town_name_a <> '' then size(left_b) = 0 or size(in_town_b) > 0
      when town_name_b <> '' then size(left_a) = 0 or size(in_town_a) > 0
      else size(left_a) = 0 or size(left_b) = 0 end"""
    share = f"if(size(left_a) > 0 and size(left_b) > 0, {OVERLAP_BOTH}, {OVERLAP})"
    return pairs.where(towns).where(f"least(shared_a, shared_b) > 0 and shared_a + shared_b >= {share} * (shared_a + shared_b + lost_a + lost_b)").select("a", "b")


def places(df: DataFrame, **columns: str) -> DataFrame:
    """Each record with the id of its normal form, and the form's parts."""
    return normal(df, **columns).withColumn("form", F.xxhash64(*FORM))


def _forms(records: DataFrame) -> DataFrame:
    """The forms that denote a place, with their number of rows."""
    return records.groupBy("form").agg(*(F.first(c).alias(c) for c in FORM), F.count("*").alias("rows")).where("size(names) > 0 or number <> ''")


def classes(df: DataFrame, **columns: str) -> DataFrame:
    """Each record with the parts of its address, its class ``place`` (forms connected by links) and ``links``, the number of other forms at the same building."""
    records = written(places(df, **columns), "places")
    links = written(form_pairs(_forms(records)), "links")
    rows = records.join(components(links), "form", "left").join(degrees(links), "form", "left")
    return rows.withColumn("place", F.coalesce("label", "form")).withColumn("links", F.coalesce("links", F.lit(0).cast("bigint"))).drop("label")


def same_place(df: DataFrame, **columns: str) -> DataFrame:
    """Pairs ``a`` < ``b`` of records at the same building."""
    records = written(places(df, **columns), "places")
    forms = _forms(records)
    pairs = form_pairs(forms)
    own = forms.where("rows > 1").select(F.col("form").alias("a"), F.col("form").alias("b"))
    rows = lambda s, key: _large(records.select(F.col("form").alias(s), F.col("key").alias(key)))
    found = pairs.unionByName(own).join(rows("a", "x"), "a").join(rows("b", "y"), "b")
    return found.where("a <> b and x <> y or x < y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()

"""One form for texts that look the same.

Texts are exploded to positioned code points (one flat array of code points per batch, with the document of
each position), joined with the mapping tables by code point, combining marks are ordered by class, pairs
are recomposed, and strings are rebuilt. The tables are small and fixed, they come from the Unicode database
of the worker's Python and the look-alike list below; joining is a gather from a table indexed by code point.

A character is mapped by these rules: default-ignorable code points are dropped; every kind of blank is a
space; canonical decompositions apply, and of the compatibility ones only those that keep the look (full and
half width, no-break, font variants, Latin ligatures, Roman numerals); look-alike letters become the Latin letter
that a reader takes them for. Superscripts, fractions, circled digits and the like stay, since they look
different; so do case, accents, digits and marks.

``same_looking`` compares 128-bit hashes of the forms. It never pairs equal texts with each other: a group's
distinct texts are paired, then each side's documents are looked up, so a group of very many copies costs
what it yields.

Defined cases: null gives null and takes no part; blank texts (nothing left but white space) take no part;
texts of any length are compared whole; a repeated row (equal id and text) pairs as its text does, once; other columns are
ignored; an empty table gives no pairs.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import written

#: Letters and marks that a reader takes for a plain one (fixed values).
LOOKALIKES = {
    "Latin": ("ɡɑᴄᴏꜱᴠᴡᴢ", "gacosvwz"),
    "Cyrillic": ("аԁеһіјӏорԛсѕѵԝхуАВСЕԌНІЈКӀМОРԚЅТѴԜХҮУ", "adehijlopqcsvwxyABCEGHIJKIMOPQSTVWXYY"),
    "Greek": ("αιορνϲϳΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿ", "aiopvcjABEZHIKMNOPTYXCJ"),
    "Armenian": ("օսհոցզՏՍՕ", "ouhngqSUO"),
    "Coptic": ("ⲟⲣⲥⲭⲞⲢⲤⲦⲬⲎⲒⲔⲘⲚⲀⲂⲈⲌ", "opcxOPCTXHIKMNABEZ"),
    "Cherokee": ("ᎠᎡᎢᎪᎫᎬᎳᎷᎻᏀᏃᏒᏔᏕᏙᏚᏞᏟᏢᏦᏴ", "DRTAJEWMHGZRWSVSLCPKB"),
    "Lisu": ("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU"),
    "marks": ("‐‑µ․∶ꓸ", "--μ.:."),
}
#: Default-ignorable code points, as ranges (fixed values).
IGNORABLE = (
    (0x00AD, 0x00AD), (0x034F, 0x034F), (0x061C, 0x061C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0x3164, 0x3164),
    (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFA0, 0xFFA0), (0xFFF0, 0xFFF8), (0x1BCA0, 0x1BCA3), (0x1D173, 0x1D17A), (0xE0000, 0xE0FFF),
)
KEEPS_LOOK = ("<wide>", "<narrow>", "<noBreak>", "<font>")
SIZE = 0x110000
#: Characters that are exploded at a time.
PIECE = 1_000_000
_ASCII = re.compile(r"[\x00-\x7f]")


def _expansion(c: int, plain: dict[int, int]) -> list[int]:
    """The code points that stand for one: decomposed as far as the look is kept, look-alikes replaced."""
    ch = chr(c)
    if unicodedata.category(ch) == "Zs":
        return [0x20]
    tag, _, rest = unicodedata.decomposition(ch).partition(" ")
    if 0xAC00 <= c <= 0xD7A3:
        return [ord(x) for x in unicodedata.normalize("NFD", ch)]
    if not tag or tag.startswith("<") and not (tag in KEEPS_LOOK or 0xFB00 <= c <= 0xFB06 or 0x2160 <= c <= 0x217F):
        return [plain.get(c, c)]
    parts = rest if tag.startswith("<") else f"{tag} {rest}"
    return [y for x in parts.split() for y in _expansion(int(x, 16), plain)]


@cache
def tables():
    """By code point: length and start of its expansion, the flat expansions, combining class; and the composing pairs."""
    plain = {ord(a): ord(b) for x, y in LOOKALIKES.values() for a, b in zip(x, y, strict=True)}
    length, start = np.ones(SIZE, np.int64), np.arange(SIZE, dtype=np.int64)
    flat = [np.arange(SIZE, dtype=np.uint32)]
    extra: list[int] = []
    classes, pairs = np.zeros(SIZE, np.uint8), {}
    for c in range(0x80, SIZE):
        ch = chr(c)
        if (k := unicodedata.combining(ch)) > 0:
            classes[c] = k
        if 0xD800 <= c < 0xE000 or not (unicodedata.decomposition(ch) or c in plain or 0xAC00 <= c <= 0xD7A3 or unicodedata.category(ch) == "Zs"):
            continue
        new = _expansion(c, plain)
        length[c], start[c] = len(new), SIZE + len(extra)
        extra += new
        two = unicodedata.normalize("NFD", ch)
        if len(two) > 1 and unicodedata.normalize("NFC", ch) == ch and (a := unicodedata.normalize("NFC", two[:-1])) and len(a) == 1:
            pairs[ord(a) << 21 | ord(two[-1])] = c
    for a, b in IGNORABLE:
        length[a : b + 1] = 0
    keys = np.array(sorted(pairs), np.int64)
    return length, start, np.concatenate([*flat, np.array(extra, np.uint32)]), classes, keys, np.array([pairs[k] for k in keys.tolist()], np.uint32)


def slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours whose sizes add up to ``most`` at the most, or of one."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def _pieces(text: str) -> list[str]:
    """A long text cut before ASCII characters, which join with nothing before them."""
    out, start = [], 0
    while len(text) - start > PIECE and (cut := _ASCII.search(text, start + PIECE)):
        out.append(text[start : cut.start()])
        start = cut.start()
    return [*out, text[start:]]


def forms(texts: list[str]) -> list[str]:
    """The common form of each text, worked out in pieces of bounded size; texts of plain ASCII are their own."""
    out = list(texts)
    which = [k for k, t in enumerate(texts) if not t.isascii()]
    pieces = [_pieces(texts[k]) for k in which]
    flat = [p for ps in pieces for p in ps]
    done = [f for a, b in slices([len(p) for p in flat], 2 * PIECE) for f in _forms(flat[a:b])]
    at = 0
    for k, ps in zip(which, pieces, strict=True):
        out[k] = "".join(done[at : at + len(ps)])
        at += len(ps)
    return out


def _forms(texts: list[str]) -> list[str]:
    length, start, flat, classes, pair_keys, pair_values = tables()
    which = [k for k, t in enumerate(texts) if not t.isascii()]
    out = list(texts)
    if not which:
        return out
    points = np.frombuffer("".join([texts[k] for k in which]).encode("utf-32-le", "surrogatepass"), np.uint32)
    document = np.repeat(np.arange(len(which)), [len(texts[k]) for k in which])
    # The join with the mappings: each position becomes as many as its expansion has.
    n = length[points]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    points = flat[np.repeat(start[points] - (ends - n), n) + np.arange(total)] if total != len(n) or (n != 1).any() else flat[start[points]]
    document = np.repeat(document, n)
    # Marks are ordered by class behind their starter.
    k = classes[points]
    if ((k[1:] > 0) & (k[:-1] > k[1:])).any():
        starter = np.cumsum((k == 0) | np.concatenate([[True], document[1:] != document[:-1]]))
        order = np.lexsort((np.arange(total), k, starter))
        points, k = points[order], k[order]
    # Recomposition, one mark behind each starter at a time.
    while len(points) > 1:
        mark = np.flatnonzero((k[1:] > 0) & (k[:-1] == 0) & (document[1:] == document[:-1])) + 1
        if not len(mark):
            break
        key = points[mark - 1].astype(np.int64) << 21 | points[mark]
        at = np.minimum(np.searchsorted(pair_keys, key), len(pair_keys) - 1)
        hit = pair_keys[at] == key
        if not hit.any():
            break
        points = points.copy()
        points[mark[hit] - 1] = pair_values[at[hit]]
        keep = np.ones(len(points), bool)
        keep[mark[hit]] = False
        points, k, document = points[keep], k[keep], document[keep]
    joined = points.tobytes().decode("utf-32-le", "surrogatepass")
    cuts = np.searchsorted(document, np.arange(len(which) + 1))
    for i, j in enumerate(which):
        out[j] = joined[cuts[i] : cuts[i + 1]]
    # Hangul, and marks that meet their starter across others, are left to the library.
    open_ = document[(points >= 0x1100) & (points <= 0x11FF)], document[1:][(k[1:] > 0) & (k[:-1] > 0)]
    for i in np.unique(np.concatenate(open_)).tolist():
        out[which[i]] = unicodedata.normalize("NFC", out[which[i]])
    return out


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(key, t) for key, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if t is not None and key is not None]
        look = [xxhash.xxh3_128_digest(f.encode("utf-8", "surrogatepass")) if f and not f.isspace() else None for f in forms([t for _, t in rows])]
        own = [xxhash.xxh3_128_digest(t.encode("utf-8", "surrogatepass")) for _, t in rows]
        keep = [i for i, x in enumerate(look) if x is not None]
        yield pa.RecordBatch.from_arrays([pa.array([rows[i][0] for i in keep], batch.schema.field(0).type), pa.array([look[i] for i in keep], pa.binary()), pa.array([own[i] for i in keep], pa.binary())], ["key", "look", "own"])


def signatures(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, hash of the common form and hash of the text itself, of every text that isn't blank."""
    return df.select(key, text).mapInArrow(_signatures, f"key {df.schema[key].dataType.simpleString()}, look binary, own binary")


def _form_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).to_pylist()
        made = iter(forms([t for t in texts if t is not None]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([None if t is None else next(made) for t in texts], pa.string())], ["key", "form"])


def common_form(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``form``, the one form of all texts that look the same."""
    return df.select(key, text).mapInArrow(_form_batches, f"key {df.schema[key].dataType.simpleString()}, form string").withColumnRenamed("key", key)


def same_looking(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pairs ``a`` < ``b`` of keys whose texts differ as strings but look the same."""
    marked = written(signatures(df, key, text), "looks")
    variants = marked.groupBy("look", "own").agg(F.lit(1).alias("one")).drop("one")
    several = variants.groupBy("look").agg(F.count("*").alias("n")).where("n > 1").select("look")
    rows = marked.join(several, "look", "left_semi").select("key", "look", "own").distinct()
    kinds = rows.select("look", "own").distinct()
    twins = kinds.select("look", F.col("own").alias("own_a")).join(kinds.select("look", F.col("own").alias("own_b")), "look").where("own_a < own_b")
    left, right = rows.select("look", F.col("own").alias("own_a"), F.col("key").alias("x")), rows.select("look", F.col("own").alias("own_b"), F.col("key").alias("y"))
    found = twins.join(left, ["look", "own_a"]).join(right, ["look", "own_b"]).where("x <> y")
    return found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def classes(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document whose text isn't blank with the hash of its form as ``look``, and ``links``: how many other texts look the same as its own."""
    marked = written(signatures(df, key, text), "looks")
    variants = marked.groupBy("look", "own").agg(F.lit(1).alias("one")).groupBy("look").agg((F.count("*") - 1).alias("links"))
    return marked.join(variants, "look").select(F.col("key").alias(key), F.hex("look").alias("look"), "links")

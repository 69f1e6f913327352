"""Held-out passages that stand, whole or in good part, in corpus texts.

Passages and texts are tokenised alike: escapes undone, look-alike characters and case unified, punctuation
and spacing dropped. Spaced seeds find the places worth a look: fixed masks of which some positions are
ignored, so that a changed word under an ignored position leaves the seed's hash as it is. The hashes of all
passages form a sorted table that is broadcast, and every window of every text is joined with it where the
text is read; nothing of the corpus is shuffled. Around the hits, a local alignment that tolerates changed,
lost and added words, and a longer insertion, finds the best stretch of the passage; it counts as leaked if
it spans ``SPAN`` of the passage and most of it matches. Places whose words alone rule that out aren't aligned.

A seed of many passages (a phrase in common) says little; it is used only where its passage has no rarer
seed nearby, so no part of a passage is without seeds. Passages are a stated query set: they are worked off
in blocks of at most ``BLOCK`` words, one broadcast of bounded size each.

Defined cases: null texts and null passages take no part, nor does what has fewer than ``LEAST`` words; texts of any length are
searched whole; a repeated row or passage is reported once per (document, item); other columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from .lookalike import forms, slices

#: Seed masks; 0 is an ignored position.
MASKS = ("1111", "110101", "1010011")
COMMON = 8
NEAR = 6
#: Places of a passage that must be hit on one band of diagonals for an alignment, at most; ``Index.need`` is less where
#: a stretch of SPAN with one word in EDITED changed may have fewer.
HITS = 7
EDITED = 8
BAND = 8
#: Further words of the text that a window takes in: for an insertion, and at its ends.
JOIN = 24
MARGIN = 12
#: Pairs that are aligned, and whose words are looked at, at a time.
TOGETHER, LOOKED_AT = 64, 512
#: Cells of a table of pairs by words of their passages, unless one pair has more.
CELLS = 2_000_000
SPAN = 0.42
DENSITY = 0.7
LEAST = 8
BLOCK, HELD = 2_000_000, 4
#: Characters of texts that are searched at a time.
SLICE = 2_000_000
#: Alignment scores in tenths of a word.
MATCH, MISMATCH, SKIP_ITEM, OPEN, EXTEND = 10, -10, 10, 10, 1
_GREEK_OR_CYRILLIC = re.compile("[\u0370-\u052f\u1c80-\u1c8f\u1f00-\u1fff]")
_WORD = re.compile(r"[぀-ヿ㐀-鿿豈-﫿]|[^\W_぀-ヿ㐀-鿿豈-﫿]+")
_ESCAPE = re.compile(r"\\u([0-9a-fA-F]{4})|\\x([0-9a-fA-F]{2})|\\[nrtbf]|((?:%[0-9a-fA-F]{2})+)")
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
FILTER_BITS = 22


def _unescaped(m: re.Match) -> str:
    if m[3]:
        return unquote(m[3], errors="ignore")
    code = m[1] or m[2]
    return chr(int(code, 16)) if code and not 0xD800 <= int(code, 16) < 0xE000 else " "


def plain(texts: list[str]) -> list[str]:
    """Texts with escapes undone, look-alikes unified, in one case.

    A letter whose small or capital form looks like another is that other one in both cases (Greek nu is like v and like N).
    """
    texts = [html.unescape(t) if "&" in t else t for t in texts]
    texts = [_ESCAPE.sub(_unescaped, t) if "\\" in t or "%" in t else t for t in texts]
    texts = [t.casefold() for t in forms(texts)]
    return [(t.translate(_both_cases()) if not t.isascii() and _GREEK_OR_CYRILLIC.search(t) else t).replace("v", "n") for t in texts]


@cache
def _both_cases() -> dict[int, str]:
    """Small letters whose capitals look like another letter's: that letter, as the capitals have become it."""
    small = [c for c in map(chr, range(0x80, 0x2000)) if c != c.upper() and _GREEK_OR_CYRILLIC.match(c)]
    return {ord(c): f.casefold() for c, f in zip(small, forms([c.upper() for c in small]), strict=True) if f != c.upper() and f.casefold() != c}


def words(text: str) -> list[str]:
    return _WORD.findall(text)


def seeds(codes: np.ndarray, document: np.ndarray, mask: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the windows of one mask that lie in one document and hold known words only."""
    offsets = [i for i, c in enumerate(MASKS[mask]) if c == "1"]
    n = len(codes) - offsets[-1]
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    valid = document[:n] == document[offsets[-1] :]
    for o in offsets:
        valid &= codes[o : n + o] >= 0
    at = np.flatnonzero(valid)
    key = np.full(len(at), mask + 1, np.uint64)
    for o, m in zip(offsets, _MIX, strict=True):
        key = (key ^ codes[at + o].astype(np.uint64)) * m
        key ^= key >> np.uint64(29)
    return at, key


class Index:
    """The seeds of a block of passages: vocabulary, sorted hashes with their places, and the passages as codes."""

    def __init__(self, items: list[tuple[int, str]]):
        kept = [(k, w) for (k, _), w in zip(items, map(words, plain([t for _, t in items])), strict=True) if len(w) >= LEAST]
        self.keys = [k for k, _ in kept]
        self.vocabulary: dict[str, int] = {}
        self.passages = [np.array([self.vocabulary.setdefault(x, len(self.vocabulary)) for x in w], np.int64) for _, w in kept]
        lengths = np.array([len(p) for p in self.passages], np.int64)
        codes = np.concatenate([*self.passages, np.zeros(0, np.int64)])
        item = np.repeat(np.arange(len(kept)), lengths)
        place = np.concatenate([np.arange(n) for n in lengths] or [np.zeros(0, np.int64)])
        found = [seeds(codes, item, m) for m in range(len(MASKS))]
        at, key = (np.concatenate([f[k] for f in found]) for k in (0, 1))
        # Seeds of many passages stay only where their passage has no rarer one nearby.
        _, which = np.unique(key, return_inverse=True)
        per_key = np.unique(np.stack([which, item[at]]), axis=1)[0] if len(at) else np.zeros(0, np.int64)
        rare = np.bincount(per_key, minlength=1)[which] <= COMMON if len(at) else np.zeros(0, bool)
        marked = np.zeros(len(codes) + 1, np.int64)
        marked[1:][at[rare]] = 1
        total = np.cumsum(marked)
        near = total[np.minimum(at + NEAR + 1, len(codes))] - total[np.maximum(at - NEAR, 0)] > 0
        keep = rare | ~near
        mask = np.repeat(np.arange(len(MASKS)), [len(f[0]) for f in found])
        self.need = needed(lengths, item[at[keep]], place[at[keep]], np.array([len(m) for m in MASKS])[mask[keep]])
        at, key = at[keep], key[keep]
        order = np.argsort(key, kind="stable")
        self.hashes, self.item, self.place = key[order], item[at[order]].astype(np.int32), place[at[order]].astype(np.int32)
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.hashes >> np.uint64(64 - FILTER_BITS)] = True

    def hits(self, codes: np.ndarray, document: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Position, item and place in the item of every seed hit."""
        out = []
        for m in range(len(MASKS)):
            at, key = seeds(codes, document, m)
            maybe = self.filter[key >> np.uint64(64 - FILTER_BITS)]
            at, key = at[maybe], key[maybe]
            low, high = np.searchsorted(self.hashes, key, "left"), np.searchsorted(self.hashes, key, "right")
            n = high - low
            ends = np.cumsum(n)
            total = int(ends[-1]) if len(ends) else 0
            row = np.repeat(low - (ends - n), n) + np.arange(total)
            out.append((np.repeat(at, n), self.item[row], self.place[row]))
        return tuple(np.concatenate([o[k] for o in out]) for k in range(3))


def needed(lengths: np.ndarray, item: np.ndarray, place: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Places to be hit, by passage: as many as any stretch of SPAN keeps of its seeds after its edits, from 1 to HITS."""
    out = np.full(len(lengths), HITS, np.int64)
    order = np.lexsort((width, place, item))
    item, place, width = item[order], place[order], width[order]
    first = np.concatenate([[True], (item[1:] != item[:-1]) | (place[1:] != place[:-1])]) if len(item) else np.zeros(0, bool)
    item, place, width = item[first], place[first], width[first]
    ends = np.searchsorted(item, np.arange(len(lengths) + 1))
    for i, n in enumerate(lengths.tolist()):
        size = math.ceil(SPAN * n)
        p, w = place[ends[i] : ends[i + 1]], width[ends[i] : ends[i + 1]]
        # A place lies in the stretches that begin from p + w - size to p.
        low, high = np.maximum(p + w - size, 0), np.minimum(p, n - size) + 1
        whole = low < high
        counts = np.cumsum(np.bincount(low[whole], minlength=n + 2) - np.bincount(high[whole], minlength=n + 2))[: n - size + 1]
        # An edit spoils the places whose seed reaches over it, at most so many.
        spoilt = np.cumsum(np.bincount(p, minlength=n + 1) - np.bincount(p + w, minlength=n + 1)).max()
        out[i] = min(HITS, max(1, int(counts.min()) - size // EDITED * int(spoilt)))
    return out


def hopeful(windows: list[np.ndarray], passages: list[np.ndarray], most: int) -> np.ndarray:
    """Whether a pair's alignment may be accepted, by the words alone.

    A word of the passage within the aligned span counts +1 if it is matched and -1 if not, so of an accepted span at least
    (1 + DENSITY) / 2 of the words stand in the window. Codes of words are below ``most``.
    """
    row = lambda parts: np.repeat(np.arange(len(parts)), [len(x) for x in parts])
    there, asked = row(windows) * most + np.concatenate(windows), row(passages) * most + np.concatenate(passages)
    there = np.sort(there[np.concatenate(windows) >= 0])
    stands = np.zeros(len(asked), bool)
    if len(there):
        stands = there[np.minimum(np.searchsorted(there, asked), len(there) - 1)] == asked
    sizes = np.array([len(p) for p in passages])
    table = np.zeros((len(passages), int(sizes.max()) + 1))
    at, place = row(passages), np.concatenate([np.arange(n) for n in sizes])
    table[at, place + 1] = np.where(stands, 1.0, 0.0) - (1 + DENSITY) / 2 + 1e-9
    total = np.cumsum(table, axis=1)
    least = np.ceil(SPAN * sizes).astype(int)
    # A span from i to j is good enough if total[j] >= total[i]; the least total[i] up to j - least is all that counts.
    low = np.minimum.accumulate(total, axis=1)
    before = np.arange(table.shape[1])[None, :] - least[:, None]
    within = (before >= 0) & (np.arange(table.shape[1])[None, :] <= sizes[:, None])
    return (within & (total >= np.take_along_axis(low, np.maximum(before, 0), axis=1))).any(axis=1)


def stretch(windows: list[np.ndarray], passages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Span (in words of the passage) and score (in words) of each pair's best local alignment."""
    count, width, height = len(windows), max(map(len, passages)), max(map(len, windows))
    shift = int(width + 2).bit_length()
    one = 1 << shift
    kind = np.int32 if width * MATCH * one < 1 << 29 else np.int64
    text, item = np.full((height, count, 1), -1, np.int32), np.full((count, width), -2, np.int32)
    for k, (w, p) in enumerate(zip(windows, passages, strict=True)):
        text[: len(w), k, 0], item[k, : len(p)] = w, p
    # A cell is score * one + (one - 1 - start), so that one maximum carries both.
    fresh = ((one - 1) - np.arange(width + 1)).astype(kind)  # an alignment that starts behind place i - 1
    ramp = (np.arange(width + 1) * (SKIP_ITEM * one)).astype(kind)
    h = np.tile(fresh, (count, 1))
    e, now, step, same = np.full_like(h, -(1 << 29)), np.empty_like(h), np.empty((count, width), kind), np.empty((count, width), bool)
    best, end, rows = np.full(count, one - 1, kind), np.zeros(count, np.int64), np.arange(count)
    for j in range(height):
        e -= EXTEND * one
        np.subtract(h, OPEN * one, out=now)
        np.maximum(e, now, out=e)
        np.equal(item, text[j], out=same)
        np.multiply(same, kind((MATCH - MISMATCH) * one), out=step)
        step += kind(MISMATCH * one)
        step += h[:, :-1]
        np.maximum(e, fresh, out=now)
        np.maximum(now[:, 1:], step, out=now[:, 1:])
        now += ramp
        np.maximum.accumulate(now, axis=1, out=h)
        h -= ramp
        np.maximum(h, fresh, out=h)
        top = h.argmax(axis=1)
        value = h[rows, top]
        better = (value >> shift) > (best >> shift)
        best, end = np.where(better, value, best), np.where(better, top, end)
    start = (one - 1) - (best & (one - 1))
    return np.maximum(end - start, 0), (best >> shift) / MATCH


def candidates(at: np.ndarray, place: np.ndarray, pair: np.ndarray, need: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs with the places that their item needs or more on one band of diagonals: pair, and first and last diagonal of its bands."""
    diagonal = at - place
    low = int(diagonal.min()) - BAND
    places = int(place.max()) + 1
    bands = (int(diagonal.max()) - low) // BAND + 2
    found = []
    for offset in (0, BAND // 2):
        cell = pair * bands + (diagonal - low + offset) // BAND
        hit = np.sort(cell * places + place)
        cell = hit[np.concatenate([[True], hit[1:] != hit[:-1]])] // places
        first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        cells, n = cell[first], np.diff(np.append(first, len(cell)))
        cells = cells[n >= need[cells // bands % len(need)]]
        first = cells % bands * BAND + low - offset
        found.append((cells // bands, first, first + BAND - 1))
    which, first, last = (np.concatenate([f[k] for f in found]) for k in range(3))
    order = np.lexsort((first, which))
    which, first, last = which[order], first[order], last[order]
    new = np.concatenate([[True], (which[1:] != which[:-1]) | (first[1:] > last[:-1] + JOIN)]) if len(which) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    return (which[starts], first[starts], np.maximum.reduceat(last, starts)) if len(starts) else (which, first, last)


def _together(order: np.ndarray, size: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Parts of ``order`` (by ascending size) of at most so many members and ``CELLS`` cells, or of one member."""
    start = 0
    while start < len(order):
        end = start + 1
        while end < len(order) and end - start < most and (end - start + 1) * size[order[end]] <= CELLS:
            end += 1
        yield order[start:end]
        start = end


def leaks_of(found: list[list[str]], index: Index) -> tuple[np.ndarray, np.ndarray]:
    """Row of the text and item, for every leak; texts are given as their words."""
    lengths = np.array([len(w) for w in found], np.int64)
    get = index.vocabulary.get
    codes = np.fromiter((get(x, -1) for x in chain.from_iterable(found)), np.int64, int(lengths.sum()))
    document = np.repeat(np.arange(len(found)), lengths)
    at, item, place = index.hits(codes, document)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    base = np.concatenate([[0], np.cumsum(lengths)])
    # With fewer places bands may run together and a window's best stretch be another one, so bands of HITS are looked at by themselves too.
    by_need = [candidates(at - base[document[at]], place.astype(np.int64), document[at] * len(index.keys) + item, need) for need in (index.need, np.full(len(index.need), HITS))]
    pair, first, last = np.unique(np.concatenate([np.stack(c) for c in by_need], axis=1), axis=1)
    row, it = pair // len(index.keys), pair % len(index.keys)
    size = np.array([len(p) for p in index.passages], np.int64)[it]
    low, high = np.maximum(base[row] + first - MARGIN, base[row]), np.minimum(base[row] + last + size + JOIN + MARGIN, base[row + 1])
    good = np.zeros(len(pair), bool)
    by_size = np.lexsort((high - low, size))
    chance = np.zeros(len(pair), bool)
    for part in _together(by_size, size, LOOKED_AT):
        chance[part] = hopeful([codes[low[k] : high[k]] for k in part], [index.passages[it[k]] for k in part], len(index.vocabulary))
    by_size = by_size[chance[by_size]]
    for part in _together(by_size, size, TOGETHER):
        span, score = stretch([codes[low[k] : high[k]] for k in part], [index.passages[it[k]] for k in part])
        good[part] = (span >= SPAN * size[part]) & (score >= DENSITY * span)
    return row[good], it[good]


def _blocks(items: DataFrame, key: str, passage: str) -> Iterator[list[tuple[int, str]]]:
    block, size = [], 0
    for k, text in items.select(key, passage).dropna().distinct().toLocalIterator():
        block.append((k, text))
        size += len(text) // 4 if text.isascii() else len(text)
        if size >= BLOCK:
            yield block
            block, size = [], 0
    if block:
        yield block


def leaks(df: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", passage: str = "passage") -> DataFrame:
    """``key`` and ``item_key`` of each text that holds a passage, or ``SPAN`` of it or more as one stretch."""
    types = to_arrow_type(df.schema[key].dataType), to_arrow_type(items.schema[item_key].dataType)
    kinds = df.schema[key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    shipped = [df.sparkSession.sparkContext.broadcast(Index(block)) for block in _blocks(items, item_key, passage)]
    out = df.sparkSession.createDataFrame([], f"a {kinds[0]}, b {kinds[1]}") if not shipped else None
    for first in range(0, len(shipped), HELD):

        def run(batches: Iterator[pa.RecordBatch], held=tuple(shipped[first : first + HELD])) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                pairs = [(k, t) for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if t]
                for start, end in slices([len(t) for _, t in pairs], SLICE):
                    found = [words(t) for t in plain([t for _, t in pairs[start:end]])]
                    for index in (h.value for h in held):
                        row, it = leaks_of(found, index)
                        got = [pairs[start + r][0] for r in row.tolist()], [index.keys[i] for i in it.tolist()]
                        yield pa.RecordBatch.from_arrays([pa.array(g, t) for g, t in zip(got, types, strict=True)], ["a", "b"])

        part = df.select(key, text).where(df[text].isNotNull()).mapInArrow(run, f"a {kinds[0]}, b {kinds[1]}")
        out = part if out is None else out.union(part)
    return out.distinct().toDF(key, item_key)

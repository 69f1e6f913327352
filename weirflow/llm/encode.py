"""Token ids of whole texts by a byte-level BPE of public ranks.

A byte pair that never occurs inside any token of the vocabulary marks a certain cut: no merge can cross it.
``certain_cuts`` reads the vocabulary for the blanks (space, line feed, tab) that no token holds after another
byte than a blank; the splitting pattern of these vocabularies ends a piece there as well, and its look-ahead
only looks at what follows a run of blanks, so cutting before such a blank changes nothing. Texts are cut
into fragments there. Long fragments of scripts without blanks are cut again, between two letters beyond ASCII whose
bytes at the cut are no pair of any token: the splitting pattern takes a run of letters as one piece wherever it begins or
ends (only ASCII letters stand behind its apostrophes), so nothing but the merges could cross. Each distinct
fragment of a batch is encoded once and independently, and the ids are
concatenated by position. Text is mostly repeated fragments, so little of it reaches the encoder.

A task holds one Arrow batch, worked off in slices of bounded size, and a bounded memo of fragments. Nothing
is shuffled. The vocabulary is read on the driver and shipped to the workers; it is a file of fixed size.

Defined cases: null and empty texts give an empty list; strings of special tokens are ordinary text; texts of
any length are encoded whole; rows are neither merged nor dropped, so repeated ids give repeated rows; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from itertools import chain, pairwise
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

TOKENIZERS = "/opt/tokenizers"
#: The pattern that splits text before the merges of the rank files (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLANKS = " \n\t"
MEMO = 200_000
SLICE_CHARS = 16_000_000
#: Letters between two cuts within a run, at least.
LETTERS = 16

_encoders: dict[int, tuple[object, re.Pattern, frozenset[int], dict]] = {}


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


def certain_cuts(ranks: dict[bytes, int]) -> str:
    """The blanks before which a text may be cut after any character that is no white space.

    The bytes before a blank inside a token are read as the character that they end; bytes that end none
    within the token count as no white space, so in doubt there is no cut.
    """
    inside = set()
    for token in ranks:
        text = token.decode("utf-8", "surrogateescape")
        inside.update(b for a, b in pairwise(text) if b in BLANKS and not a.isspace())
    return "".join(c for c in BLANKS if c not in inside)


def pairs_inside(ranks: dict[bytes, int]) -> frozenset[int]:
    """The pairs of a byte that ends a character beyond ASCII and one that begins the next, that some token has; any other pair is a certain cut."""
    return frozenset(a << 8 | b for token in ranks for a, b in pairwise(token) if a >= 0x80 and b >= 0xC2)


def letters_apart(fragment: str, inside: frozenset[int]) -> list[str]:
    """A fragment cut at certain pairs between letters beyond ASCII, into parts of ``LETTERS`` or more."""
    parts, start = [], 0
    for i in range(LETTERS, len(fragment)):
        a, b = fragment[i - 1], fragment[i]
        if i - start >= LETTERS and a > "\x7f" and b > "\x7f" and a.isalpha() and b.isalpha() and a.encode()[-1] << 8 | b.encode()[0] not in inside:
            parts.append(fragment[start:i])
            start = i
    return [*parts, fragment[start:]]


def fragments_of(cuts: str) -> re.Pattern:
    """Fragments: a run of blanks and what follows it, up to the next certain cut."""
    if not cuts:
        return re.compile(r"(?s).+")
    return re.compile(rf"\s*\S+(?:[^\S{re.escape(cuts)}]\s*\S+)*|\s+")


def _encoder(data: bytes):
    key = hash(data)
    if key not in _encoders:
        import tiktoken

        ranks = read_ranks(data)
        _encoders[key] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), fragments_of(certain_cuts(ranks)), pairs_inside(ranks), {}
    return _encoders[key]


def encode_texts(texts: list[str | None], data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and ids of all texts."""
    encoding, fragments, inside, memo = _encoder(data)
    found = [fragments.findall(t) if t else [] for t in texts]
    counts = np.fromiter(map(len, found), np.int64, len(found))
    codes, distinct = pd.factorize(np.array(list(chain.from_iterable(found)), dtype=object))
    if len(memo) + len(distinct) > MEMO:
        memo.clear()
    new = [f for f in distinct if f not in memo]
    encode_ = encoding.encode_ordinary
    whole = lambda f: encode_(f) if len(f) < 2 * LETTERS or f.isascii() else list(chain.from_iterable(map(encode_, letters_apart(f, inside))))
    known = dict(zip(new, map(whole, new), strict=True))
    if len(memo) + len(new) <= MEMO:
        memo.update(known)
    ids = [known.get(f) or memo[f] for f in distinct]
    lengths = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter(chain.from_iterable(ids), np.int32, int(lengths.sum()))
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    each = lengths[codes]
    ends = np.cumsum(each)
    total = int(ends[-1]) if len(ends) else 0
    out = flat[np.repeat(starts[codes] - (ends - each), each) + np.arange(total)]
    offsets = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
    return offsets, out


def _slices(texts: list[str | None], most: int) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and size + n > most:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """``key`` and ``ids`` (the token ids of ``text`` without special tokens) of every row."""
    shipped = df.sparkSession.sparkContext.broadcast(Path(folder, f"{tokenizer}.tiktoken").read_bytes())
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            for start, end in _slices(texts, SLICE_CHARS):
                offsets, ids = encode_texts(texts[start:end], shipped.value)
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([keys[start:end], lists], ["key", "ids"])

    return df.select(key, text).mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)

import random

import pytest
from pyspark.sql import types as T

from weirflow.llm import encode as E

tokenizers = pytest.importorskip("tokenizers")
DATA = open(f"{E.TOKENIZERS}/byte_bpe_50k.tiktoken", "rb").read()


@pytest.fixture(scope="module")
def reference():
    t = tokenizers.Tokenizer.from_file(f"{E.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_cuts_are_certain():
    ranks = E.read_ranks(DATA)
    assert E.certain_cuts(ranks) == " \n\t"
    assert E.certain_cuts({**ranks, b"a b": 99999}) == "\n\t"
    assert E.certain_cuts({**ranks, b"\xa0\n": 99999}) == " \t"


def test_random_texts(reference):
    rnd = random.Random(1)
    alphabet = " \n\t\r 　\x1c\x85abcé's'llDon!?<|endoftext|>12 木‍😀"
    texts = [None, "", " ", "<|endoftext|>", "a\n\nA", "  x  "] + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(5000)] + ["word " * 50_000, "日本" * 20_000]
    offsets, ids = E.encode_texts(texts, DATA)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)] == reference(texts)


def test_letters_without_blanks_are_cut(reference):
    rnd = random.Random(4)
    inside = E.pairs_inside(E.read_ranks(DATA))
    runs = ["日本語の文章はここにある終わり", "привет", "Ωμέγα", "한국어", "e\u0301", "'re", "l'été", "ーー", "々々", "中", "ﬁ", "ก็"]
    texts = ["".join(rnd.choice(runs) for _ in range(rnd.randint(10, 80))) for _ in range(1500)]
    assert all("".join(E.letters_apart(t, inside)) == t for t in texts) and max(map(len, E.letters_apart("日本語の文章はここにある終わり" * 500, inside))) <= 3 * E.LETTERS
    offsets, ids = E.encode_texts(texts, DATA)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)] == reference(texts)


def test_frame(spark, reference):
    rows = [(1, "Hello  world", "x"), (2, None, None), (3, "", "y"), (3, "", "y"), (None, "a", "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    got = E.encode(df.coalesce(1))
    assert got.schema["ids"].dataType == T.ArrayType(T.IntegerType())
    assert [tuple(r) for r in got.collect()] == [(r[0], i) for r, i in zip(rows, reference([r[1] for r in rows]), strict=True)]
    assert E.encode(df.limit(0)).count() == 0


def test_round_trip(spark):
    import tiktoken

    enc = tiktoken.Encoding("r", pat_str=E.PATTERN, mergeable_ranks=E.read_ranks(DATA), special_tokens={})
    texts = ["Ünïcode​ text\n\twith  odd   spacing 123", "Привет, мир", "終わり。"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert [enc.decode(r.ids) for r in E.encode(df.coalesce(1)).collect()] == texts

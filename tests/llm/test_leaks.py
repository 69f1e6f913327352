import random

import numpy as np

from weirflow.llm import leaks as L

RND = random.Random(11)
WORDS = ["".join(RND.choice("abcdefghijklmnop") for _ in range(RND.randint(3, 8))) for _ in range(600)]


def passage(n=60):
    return [RND.choice(WORDS) for _ in range(n)]


ITEMS = [(i, passage()) for i in range(12)]


def changed(words, every=8):
    out = []
    for i, w in enumerate(words):
        if i % every == every // 2:
            kind = i % 3
            out += [] if kind == 0 else ["zzchanged"] if kind == 1 else [w, "zzadded"]
        else:
            out.append(w)
    return out


def page(middle):
    return " ".join([*passage(40), *middle, *passage(40)])


def found_in(texts, index):
    return L.leaks_of([L.words(t) for t in L.plain(texts)], index)


CASES = {
    1: (page(ITEMS[0][1]), {0}),
    2: (page(ITEMS[1][1]).upper().replace(" ", "  "), {1}),
    3: (page(changed(ITEMS[2][1])), {2}),
    4: (page(ITEMS[3][1][:32]), {3}),
    5: (page(ITEMS[4][1][28:]), {4}),
    6: (page(ITEMS[5][1][:18]), set()),
    7: (page([*ITEMS[6][1][:30], *("this site stores small files on your device by continuing you agree ok".split()), *ITEMS[6][1][30:]]), {6}),
    8: (page(ITEMS[7][1]).replace("a", "а").replace("e", "e​").replace("o", "ｏ"), {7}),
    9: (page(sorted(ITEMS[8][1])), set()),
    10: (None, set()),
    11: ("", set()),
    12: (" ".join(passage(30_000) + ITEMS[9][1] + passage(10)), {9}),
    13: ("&quot;" + ", ".join(ITEMS[10][1]) + "\\n&amp;" + "; ".join(ITEMS[11][1]), {10, 11}),
    14: (page(ITEMS[0][1] + ITEMS[0][1]), {0}),
}


def test_cases(spark):
    docs = spark.createDataFrame([(k, t, "x", 1) for k, (t, _) in CASES.items()] * 2, "doc_id bigint, text string, item_id string, a int")
    items = spark.createDataFrame([(i, " ".join(w), None) for i, w in ITEMS] + [(99, None, None), (98, "too short", None)], "item_id bigint, passage string, text string")
    got = [tuple(r) for r in L.leaks(docs, items).collect()]
    assert sorted(got) == sorted((k, i) for k, (_, want) in CASES.items() for i in want)
    assert L.leaks(docs.limit(0), items).count() == 0 and L.leaks(docs, items.limit(0)).count() == 0


def test_blocks_give_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([(k, t) for k, (t, _) in CASES.items()], "doc_id bigint, text string")
    items = spark.createDataFrame([(i, " ".join(w)) for i, w in ITEMS], "item_id bigint, passage string")
    whole = sorted(L.leaks(docs, items).collect())
    monkeypatch.setattr(L, "BLOCK", 200)
    monkeypatch.setattr(L, "HELD", 2)
    assert sorted(L.leaks(docs, items).collect()) == whole


def slow_alignment(text, item):
    """The best local alignment's score, cell by cell."""
    n, m = len(text), len(item)
    h = [[0] * (m + 1) for _ in range(n + 1)]
    e = [[-(10**9)] * (m + 1) for _ in range(n + 1)]
    best = 0
    for j in range(1, n + 1):
        for i in range(m + 1):
            e[j][i] = max(e[j - 1][i] - L.EXTEND, h[j - 1][i] - L.OPEN)
            here = max(0, e[j][i])
            if i:
                here = max(here, h[j - 1][i - 1] + (L.MATCH if text[j - 1] == item[i - 1] else L.MISMATCH), h[j][i - 1] - L.SKIP_ITEM)
            h[j][i] = here
            best = max(best, here)
    return best / L.MATCH


def test_alignment_against_cells():
    rnd = np.random.default_rng(3)
    windows = [rnd.integers(0, 6, rnd.integers(1, 40)) for _ in range(40)]
    items = [rnd.integers(0, 6, rnd.integers(1, 25)) for _ in range(40)]
    _, score = L.stretch(windows, items)
    assert score.tolist() == [slow_alignment(w, p) for w, p in zip(windows, items, strict=True)]


def test_common_phrases_keep_seeds():
    phrase = passage(12)
    items = [(i, " ".join(phrase)) for i in range(30)]
    index = L.Index(items)
    assert len(index.hashes) and len({int(i) for i in index.item}) == 30


def test_short_passages():
    rnd = random.Random(21)
    fresh = lambda n: ["".join(rnd.choice("qrstuvwxyz") for _ in range(7)) for _ in range(n)]
    items = [fresh(n) for n in range(8, 45)]
    index = L.Index([(i, " ".join(w)) for i, w in enumerate(items)])
    # Whole, its half, and whole with one word in eight changed; a quarter is none.
    for made, expected in ((list, True), (lambda w: w[: (len(w) + 1) // 2], True), (lambda w: [x if i % 8 != 4 else "zzchanged" for i, x in enumerate(w)], True), (lambda w: w[: len(w) // 4], False)):
        row, item = found_in([page(made(w)) for w in items], index)
        assert sorted(zip(row.tolist(), item.tolist(), strict=True)) == ([(i, i) for i in range(len(items))] if expected else [])


def test_short_passages_of_common_phrases():
    rnd = random.Random(22)
    fresh = lambda n: ["".join(rnd.choice("qrstuvwxyz") for _ in range(7)) for _ in range(n)]
    phrase = fresh(6)
    items = [phrase + fresh(4) for _ in range(30)]
    index = L.Index([(i, " ".join(w)) for i, w in enumerate(items)])
    row, item = found_in([page(w) for w in items], index)
    assert {(i, i) for i in range(30)} <= set(zip(row.tolist(), item.tolist(), strict=True))


def test_letters_in_both_cases():
    small = "никто в городе не видел, как тихая книга была осмотрена до полудня; σε αυτή την ωραία πόλη κανείς δεν είδε το νέο βιβλίο"
    assert L.plain([small.upper().replace("А", "A").replace("Ο", "O")])[0].replace("Σ", "σ") == L.plain([small])[0]
    assert L.plain(["%D0%B4%D0%B0 100% \\u0434a"]) == ["дa 100% дa"]


def test_pairs_left_out_are_never_accepted():
    rnd = np.random.default_rng(8)
    windows, items = [], []
    for _ in range(600):
        item = rnd.integers(0, 60, rnd.integers(8, 70))
        part = item[: rnd.integers(3, len(item) + 1)].copy()
        part[rnd.random(len(part)) < rnd.choice([0, 0.1, 0.2])] = 61
        windows.append(np.concatenate([rnd.integers(0, 60, rnd.integers(0, 20)), part, rnd.integers(-1, 60, rnd.integers(1, 20))]))
        items.append(item)
    span, score = L.stretch(windows, items)
    size = np.array([len(i) for i in items])
    good, chance = (span >= L.SPAN * size) & (score >= L.DENSITY * span), L.hopeful(windows, items, 62)
    assert good.sum() > 50 and not chance.all() and not (good & ~chance).any()


def test_recall_of_planted_stretches():
    """Half of a passage or more, up to one word in eight changed, lost or added at random places: at least 0.98 of them are found, and no third."""
    rnd = random.Random(31)
    texts, wanted, thirds = [], [], []
    for n in range(300):
        words = ITEMS[n % 12][1]
        size = rnd.randint(len(words) // 2, len(words))
        start = rnd.randint(0, len(words) - size)
        part = words[start : start + size]
        for at in sorted(rnd.sample(range(size), rnd.randint(0, size // 8)), reverse=True):
            part = part[:at] + rnd.choice([[], ["zzchanged"], [part[at], "zzadded"]]) + part[at + 1 :]
        texts.append(page(part))
        wanted.append(n % 12)
        at = rnd.randint(0, len(words) - len(words) // 4)
        thirds.append(page(words[at : at + len(words) // 4]))
    index = L.Index([(i, " ".join(w)) for i, w in ITEMS])
    row, item = found_in(texts, index)
    found = set(zip(row.tolist(), item.tolist(), strict=True))
    assert len(found & set(enumerate(wanted))) >= 0.98 * len(texts) and found <= set(enumerate(wanted))
    assert len(found_in(thirds, index)[0]) == 0

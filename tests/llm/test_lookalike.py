import itertools
import random
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st

from weirflow.llm import lookalike as L

PLAIN = {ord(a): b for x, y in L.LOOKALIKES.values() for a, b in zip(x, y, strict=True)}


def brute(text):
    out = []
    for c in text:
        if any(a <= ord(c) <= b for a, b in L.IGNORABLE):
            continue
        if unicodedata.category(c) == "Zs":
            out.append(" ")
            continue
        keeps = unicodedata.decomposition(c).startswith(L.KEEPS_LOOK) or 0xFB00 <= ord(c) <= 0xFB06 or 0x2160 <= ord(c) <= 0x217F
        out.append(unicodedata.normalize("NFKD", c) if keeps else c)
    return unicodedata.normalize("NFC", unicodedata.normalize("NFD", "".join(out)).translate(PLAIN))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aeiou AEȩ́́̈ïﬁﬃＡ１​ ­аесοΑΡё한がが-‑Ω½²"), max_size=12), max_size=6))
def test_forms(texts):
    assert L.forms(texts) == [brute(t) for t in texts]


def test_what_looks_the_same_and_what_does_not():
    same = [("file", "ﬁle"), ("Café", "Café"), ("cope", "соре"), ("ABC 12", "ＡＢＣ １２"), ("no-one", "no‑​one"), ("が", "が"), ("Mo", "Μο"), ("rapid", "ᏒApid".replace("Ꮢ", "r").replace("A", "α")), ("SOUP", "ꓢՕꓴᏢ"), ("a.b:c", "a․b∶c")]
    different = [("resume", "résumé"), ("file", "File"), ("x2", "x²"), ("5", "２"), ("a.b", "a,b"), ("½", "1/2"), ("ab", "a b")]
    for a, b in same:
        assert L.forms([a]) == L.forms([b]), (a, b)
    for a, b in different:
        assert L.forms([a]) != L.forms([b]), (a, b)


def test_pairs(spark):
    rnd = random.Random(5)
    base = ["copper", "café bar", "ﬁne", "fine", None, "", " ", "​", "copper", "с​opper", "ｃopper", "café bar", "Copper"]
    rows = [(i, t, "x", "y") for i, t in enumerate(base + [rnd.choice(base) for _ in range(30)])] + [(0, "copper", "x", "y")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, key string, look string")
    expected = {(a[0], b[0]) for a, b in itertools.permutations(rows, 2) if a[0] < b[0] and a[1] and b[1] and brute(a[1]).strip() and a[1] != b[1] and brute(a[1]) == brute(b[1])}
    got = [tuple(r) for r in L.same_looking(df).collect()]
    assert len(got) == len(set(got)) and set(got) == expected and expected
    assert L.same_looking(df.limit(0)).count() == 0 and L.classes(df.limit(0)).count() == 0
    links = {r.doc_id: r.links for r in L.classes(df).collect()}
    assert set(links) == {i for i, t, *_ in rows if t and brute(t).strip()}
    assert all(links[i] == len({u for _, u, *_ in rows if u and brute(u) == brute(t)}) - 1 for i, t, *_ in rows if i in links)
    forms = {r.doc_id: r.form for r in L.common_form(df).collect()}
    assert forms[4] is None and forms[5] == "" and forms[9] == "copper"


def test_long_text(spark):
    df = spark.createDataFrame([(1, "à la carte " * 100_000), (2, "à la carte " * 100_000)], "doc_id bigint, text string")
    assert [tuple(r) for r in L.same_looking(df).collect()] == [(1, 2)]

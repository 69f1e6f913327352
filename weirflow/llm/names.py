"""Records of the same person or organisation under variant spellings of its name.

``features`` takes a record apart: name tokens (without titles, legal forms and particles), the identity in its
e-mail address, phone digits, and house number with street. Records meet by a supporting fact (e-mail, phone or
address), so a frequent name alone brings nobody together; facts that may differ by an edit meet by symmetric
deletes. Where more than ``BLOCK`` forms share a fact, they must share a form of a name token as well. Both
indexes have all pairs that ``linked`` accepts: names that agree have two tokens that match strongly, and such tokens share a
form for every rule of ``alike``. True copies are compared once.

Candidates are scored by aligning their tokens: the best assignment, where a token may stand for another as
the same, a near spelling, a nickname, an initial or an abbreviation. A link needs aligned names and one
supporting fact, and no contradiction (different identities in the e-mail addresses, unless phone and house are both the same; given
names that do not agree). Linked records form entities by connected components; a pair within an entity is kept unless
it contradicts itself.

Defined cases: a record without a name, or without any supporting fact, links with none; nulls in any column
only mean that the fact is missing; swapped, joined or empty name fields are one bag of tokens; repeated rows
are linked; very long names keep all tokens, for the index and for alignment; other columns are ignored;
an empty table gives no pairs.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import cache, lru_cache
from itertools import combinations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import written
from . import addresses
from .components import components

TITLES = frozenset("mr mrs ms miss dr prof professor herr frau mme mlle monsieur madame sr sra senor senora don dona sir sig jr mag ing".split())
PARTICLES = frozenset("von van der de del den la le du da di of the and und et zu ter dos bin al el".split())
LEGAL = frozenset("inc incorporated llc ltd limited gmbh mbh kg kgaa co company cie corp corporation sa sarl srl sl plc ag group societe anonyme anonima holding bv nv oy ab as pty".split())
#: Local parts that name no one (fixed values).
ROLES = frozenset("info sales office contact contacto kontakt orders order billing admin support hello mail service accounts team hr jobs press".split())
#: Particles that may be written together with the name.
GLUED = frozenset("von van vander vonder de del dela di da du le la mc mac o".split())
#: Common nicknames by given name, of several languages (fixed values); diminutives by ending need no entry.
NICKNAMES = {
    "abdullah": "abdul", "abdulrahman": "abdul rahman", "abigail": "abby gail", "agnieszka": "aga", "albert": "al bert bertie", "aleksandr": "alex sasha sascha aleks shura", "alexander": "alex alec sandy xander sasha lex", "alexandra": "alex sandra sasha lexi",
    "alfred": "al alf fred fredo", "anastasia": "nastya stacy ana stasya", "andrew": "andy drew", "angela": "angie", "anna": "annie nan anya", "anthony": "tony ant", "antonio": "tono toni", "arthur": "art artie", "avraham": "avi abe", "barbara": "barb babs basia barbie",
    "beatriz": "bea", "benjamin": "ben benny benji", "bernard": "bernie", "bronislaw": "bronek", "carmen": "menchu", "catherine": "cathy kate katie cat", "charles": "charlie chuck chas carl", "charlotte": "lotte lottie charlie", "christina": "chris tina christy", "christopher": "chris kit topher",
    "chukwuemeka": "emeka chuks", "concepcion": "concha conchita", "constantinos": "kostas dinos costas", "consuelo": "chelo", "cynthia": "cindy", "daniel": "dan danny", "david": "dave davy", "deborah": "deb debbie", "dimitrios": "dimitris mitsos", "dmitri": "mitya dima",
    "dolores": "lola loli", "domenica": "mimma nica", "donald": "don donnie", "dorothy": "dot dottie dolly", "edward": "ed ned ted eddie", "eduardo": "edu lalo", "ekaterina": "katya kate katia", "eleanor": "ellie nell nora", "elisabeth": "lisbeth lisa beth elsa sissi liesl", "elizabeth": "liz beth eliza betty lizzie bess libby lisa",
    "elodie": "elo", "emmanuel": "manny manu", "enrique": "quique kike", "eugene": "gene", "evangelia": "litsa eva lia", "evgeny": "zhenya", "francisco": "paco pancho kiko curro fran", "francois": "fanch", "frances": "fran frannie", "franziska": "franzi", "frederick": "fred freddy", "frederique": "fred", "friedrich": "fritz",
    "gabriel": "gabe gabi", "gerald": "gerry jerry", "gertrude": "trudy gert", "giovanni": "gianni nino", "giuseppe": "beppe pino peppe", "gregory": "greg", "guadalupe": "lupe", "guillermo": "memo guille", "gunther": "gunni", "harold": "harry hal", "heinrich": "heinz heiner", "helen": "nell lena",
    "henry": "harry hank hal", "ignacio": "nacho", "isabella": "bella izzy isa", "ivan": "vanya", "jacob": "jake cobus", "jacqueline": "jackie", "james": "jim jimmy jamie", "jeanbaptiste": "jb", "jennifer": "jen jenny", "jessica": "jess jessie", "jesus": "chuy", "joachim": "achim jochen", "johannes": "hans hannes jan",
    "john": "jack johnny", "jonathan": "jon jonny", "jose": "pepe", "joseph": "joe joey", "josephine": "josie jo", "jurgen": "jupp", "katherine": "kate kathy katie kat", "kenneth": "ken kenny", "konstantin": "kostya", "lawrence": "larry", "leonard": "leo len lenny", "luis": "lucho", "magdalena": "magda lena",
    "manuel": "manolo manu", "margaret": "maggie peggy meg", "margarethe": "grete gretel gretchen", "maria": "masha mia", "mariateresa": "mayte maite maritere", "martha": "marty patty", "mary": "molly polly", "matthew": "matt", "michael": "mike mick micky misha", "mohammed": "mo hamudi", "mikhail": "misha",
    "natalia": "natasha", "nathaniel": "nate nat", "nicholas": "nick nicky", "oluwaseun": "seun olu", "olivia": "liv", "padraig": "paddy", "pamela": "pam", "patricia": "pat trish patty", "patrick": "pat paddy", "peter": "pete", "philip": "phil", "rebecca": "becky bex", "richard": "dick rick rich", "robert": "bob rob bobby",
    "roberto": "beto", "ronald": "ron ronnie", "rosario": "charo", "samantha": "sam", "samuel": "sam sammy", "sebastian": "seb basti", "sergei": "seryozha", "shoshana": "shosh", "siobhan": "shiv", "sofia": "sonia sonja", "stanislaw": "staszek stan", "stephen": "steve", "susan": "sue", "susanna": "sue susie", "tatiana": "tanya",
    "theodore": "ted teddy theo", "theresa": "terry tess", "thomas": "tom tommy", "timothy": "tim", "ulrich": "uli", "veronique": "vero", "victoria": "vicky tori", "vincent": "vince vinnie", "virginia": "ginny", "vladimir": "vova volodya", "vladislav": "vlad slava", "walter": "walt wally", "wilhelm": "willi helm",
    "wolfgang": "wolf", "william": "bill will billy liam", "yehonatan": "yoni", "yitzhak": "itzik", "zachary": "zach zack", "zbigniew": "zbyszek",
}
#: Given names of two words that have nicknames of their own, written as one.
DOUBLE = (("maria teresa", "mariateresa"), ("jean baptiste", "jeanbaptiste"))
#: Endings of diminutives.
ENDINGS = ("ie", "ey", "y", "i")
#: What a match of two tokens is worth.
SAME, NICK, NEAR, ABBREVIATED, INITIAL = 1.0, 0.95, 0.9, 0.8, 0.6
STRONG = 0.85
#: Up to so many tokens all assignments are gone through.
DENSE = 12
#: Forms that share one fact and still all meet each other; in larger blocks name tokens decide.
BLOCK = 64
#: Digits that two spellings of a phone number have in common at their end.
TAIL = 8
#: Letters that a form of a word or of an e-mail address keeps.
KEPT, KEPT_LOCAL = 6, 24
def plain(text: str) -> str:
    """Lower case, without accents."""
    return "".join(c for c in unicodedata.normalize("NFKD", text.lower().replace("ß", "ss").replace("ł", "l").replace("ø", "o")) if not unicodedata.combining(c))


def folded(token: str) -> str:
    """A token with spelt-out umlauts as plain vowels."""
    return re.sub("([aou])e", r"\1", token)


#: Given names by nickname (and by themselves), and the nicknames by given name; both as ``plain`` writes them.
_NAMES_OF: dict[str, set[str]] = {}
_SHORT: dict[str, list[str]] = {}
for _full, _short in NICKNAMES.items():
    _SHORT[plain(_full)] = plain(_short).split()
    for _s in (plain(_full), *plain(_short).split()):
        _NAMES_OF.setdefault(_s, set()).add(plain(_full))


def tokens(*fields: str | None) -> list[str]:
    """Name tokens of all fields, sorted; if nothing but titles or legal forms is there, those."""
    text = plain(" ".join(f for f in fields if f))
    text = re.sub(r"\b(?:\w\.){2,}\w?", lambda m: m[0].replace(".", ""), text)
    text = re.sub(r"(?<=\b\w)['’`´](?=\w)", "", text)
    text = re.sub(r"[^\w]+|_", " ", text)
    for apart, together in DOUBLE:
        text = text.replace(apart, together)
    found = text.split()
    kept = [t for t in found if t not in TITLES and t not in PARTICLES and t not in LEGAL]
    names = set(kept or found)
    # A nickname beside its full name says nothing new.
    return sorted(t for t in names if not any(n != t and n in names for n in _NAMES_OF.get(t, ())))


def email_identity(email: str | None) -> tuple[str, str]:
    """The last run of digits (of the local part, else of the domain), and the local part, with the domain if it names a role only."""
    local, _, domain = (email or "").strip().lower().partition("@")
    local = local.split("+")[0]
    runs = re.findall(r"\d+", local) or re.findall(r"\d+", domain.rpartition(".")[0])
    if local in ROLES:
        local += domain
    return (runs[-1] if runs else ""), re.sub(r"[^a-z0-9]", "", folded(plain(local)))


def phone_digits(phone: str | None) -> str:
    """All digits without leading zeros; fewer than 6 are no phone number."""
    digits = re.sub(r"\D", "", phone or "").lstrip("0")
    return digits if len(digits) >= 6 else ""


def _same_phone(a: dict, b: dict) -> bool:
    """Equal numbers, or one that is the other without its country's or area's digits."""
    short, long = sorted((a["phone"], b["phone"]), key=len)
    return bool(short) and (short == long or len(short) >= TAIL and long.endswith(short))


@lru_cache(1 << 17)
def distance(a: str, b: str) -> int:
    """Edit distance where a swap of neighbours is one edit."""
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a):
        now = [i + 1]
        for j, y in enumerate(b):
            d = min(row[j] + (x != y), row[j + 1] + 1, now[j] + 1)
            if before is not None and j and x == b[j - 1] and a[i - 1] == y:
                d = min(d, before[j - 1] + 1)
            now.append(d)
        before, row = row, now
    return row[-1]


def close(a: str, b: str, edits: int) -> bool:
    """Whether the distance is no more than that."""
    return abs(len(a) - len(b)) <= edits and distance(a, b) <= edits


def most_edits(shorter: int) -> int:
    """The edits that two tokens may differ by, given the shorter one's length."""
    return 0 if shorter < 4 else 1 if shorter < 6 else 2 if shorter < 10 else 3


def _given(token: str) -> set[str]:
    """The given names of a token that is a nickname or a given name, as it is or without spelt-out umlauts."""
    return _NAMES_OF.get(token, set()) | _NAMES_OF.get(folded(token), set())


@lru_cache(1 << 17)
def alike(a: str, b: str) -> float:
    """What the match of two tokens is worth; 0 if they are different names."""
    if folded(a) == folded(b):
        return SAME
    if len(a) > len(b):
        a, b = b, a
    if len(a) == 1:
        return INITIAL if b[0] == a or any(s[0] == a for n in _given(b) for s in (n, *_SHORT[n])) else 0.0
    if _given(a) & _given(b):
        return NICK
    if any(close(x, y, most_edits(min(len(x), len(y)))) for x, y in ((a, b), (folded(a), folded(b)))) and not (a in _SHORT and b in _SHORT):
        return NEAR
    # A misspelt nickname or given name.
    if _near_names(a) & _near_names(b) and not (a in _SHORT and b in _SHORT):
        return NEAR
    if any(min(len(x), len(y)) >= 6 and close(x, y, 1) for x in unglued(a) for y in unglued(b)):
        return NEAR
    if _diminutive(a, b) or _diminutive(b, a):
        return ABBREVIATED
    rest = iter(b)
    if a[0] == b[0] and 2 <= len(a) < len(b) and all(c in rest for c in a) and (b.startswith(a) or len(b) >= 6 and len(a) <= 5):
        return ABBREVIATED
    return 0.0


def _left_out(word: str) -> set[str]:
    """A word without up to one letter, without up to two if it is long: words within as many errors share one."""
    return {"".join(x) for k in range(3 if len(word) >= 9 else 2) for x in combinations(word, len(word) - k)}


@cache
def _index() -> dict[str, set[str]]:
    """Given names and nicknames by what is left of them."""
    found: dict[str, set[str]] = {}
    for s in _NAMES_OF:
        for rest in _left_out(s):
            found.setdefault(rest, set()).add(s)
    return found


@lru_cache(1 << 17)
def _near_names(token: str) -> frozenset[str]:
    """The given names that the token may stand for, as it is or with one error (behind the first letter of a short one), two in a long name."""

    def near(s: str) -> bool:
        n = min(len(s), len(token))
        return s == token or (n >= 5 or n == 4 and s[0] == token[0]) and close(s, token, 2 if n >= 9 else 1)

    if len(token) > 32:  # longer than any of them with its errors
        return frozenset()
    met = set().union(*(_index().get(rest, ()) for rest in _left_out(token)))
    found = frozenset(n for s in met if near(s) for n in _NAMES_OF[s])
    return found | _near_names(folded(token)) if folded(token) != token else found


@lru_cache(1 << 14)
def unglued(token: str) -> tuple[str, ...]:
    """A token, and without particles that it may be written together with."""
    return (token, *(token[len(g) :] for g in GLUED if token.startswith(g) and len(token) - len(g) >= 6))


def _diminutive(short: str, full: str) -> bool:
    """Whether a name is another's beginning with an ending of diminutives, as Debbie is of Deborah."""
    for ending in ENDINGS:
        if short.endswith(ending):
            stem = short[: -len(ending)]
            if len(stem) >= 4 and stem[-1] == stem[-2]:
                stem = stem[:-1]
            return len(stem) >= 3 and len(full) > len(stem) and full.startswith(stem)
    return False


def align(a: tuple[str, ...], b: tuple[str, ...]) -> tuple[float, int, int, bool]:
    """Best assignment of tokens: its worth, how many of the shorter side stay alone, how many match, and whether a long token matches strongly."""
    if len(a) > len(b):
        a, b = b, a
    worth = [[alike(x, y) for y in b] for x in a]
    if len(b) > DENSE:
        return _align_long(a, b, worth)
    best: dict[int, tuple[float, int, bool]] = {0: (0.0, 0, False)}
    for i, row in enumerate(worth):
        step = dict(best)  # this token stays alone
        for used, (total, n, strong) in best.items():
            for j, w in enumerate(row):
                if w and not used >> j & 1:
                    new = (total + w, n + 1, strong or w >= STRONG and min(len(a[i]), len(b[j])) >= 4)
                    if new > step.get(used | 1 << j, (-1.0, 0, False)):
                        step[used | 1 << j] = new
        best = step
    total, n, strong = max(best.values())
    return total, len(a) - n, n, strong


def _align_long(a: tuple[str, ...], b: tuple[str, ...], worth: list[list[float]]) -> tuple[float, int, int, bool]:
    """The same for many tokens: the assignment of greatest worth, then of most matches, then of most strong ones, in whole numbers.

    Tokens that nothing connects by a chain of matches can't compete, so each connected part is assigned by itself.
    """
    strong = lambda i, j: worth[i][j] >= STRONG and min(len(a[i]), len(b[j])) >= 4
    unit = len(a) + 1
    value = {(i, j): (round(w * 100) * unit + 1) * unit + strong(i, j) for i, row in enumerate(worth) for j, w in enumerate(row) if w}
    of_a: dict[int, list[int]] = {}
    of_b: dict[int, list[int]] = {}
    for i, j in value:
        of_a.setdefault(i, []).append(j)
        of_b.setdefault(j, []).append(i)
    pairs: list[tuple[int, int]] = []
    seen: set[int] = set()
    for start in of_a:
        if start in seen:
            continue
        rows, columns, todo = [start], set(), [start]
        seen.add(start)
        while todo:
            for j in of_a[todo.pop()]:
                if j not in columns:
                    columns.add(j)
                    more = [i for i in of_b[j] if i not in seen]
                    seen.update(more)
                    rows += more
                    todo += more
        at = sorted(columns)
        chosen = assignment([[value.get((i, j), 0) for j in at] for i in rows])
        pairs += [(rows[r], at[c]) for r, c in chosen if (rows[r], at[c]) in value]
    return sum(worth[i][j] for i, j in pairs), len(a) - len(pairs), len(pairs), any(strong(i, j) for i, j in pairs)


def assignment(values: list[list[int]]) -> list[tuple[int, int]]:
    """Rows and columns of the assignment of greatest sum (Hungarian method)."""
    if len(values) > len(values[0]):
        return [(r, c) for c, r in assignment([list(column) for column in zip(*values, strict=True)])]
    n, m = len(values), len(values[0])
    u, v, owner = [0] * (n + 1), [0] * (m + 1), [0] * (m + 1)
    for i in range(1, n + 1):
        owner[0], at = i, 0
        least, way, used = [float("inf")] * (m + 1), [0] * (m + 1), [False] * (m + 1)
        while True:
            used[at] = True
            row, step, to = owner[at], float("inf"), 0
            for j in range(1, m + 1):
                if not used[j]:
                    cost = -values[row - 1][j - 1] - u[row] - v[j]
                    if cost < least[j]:
                        least[j], way[j] = cost, at
                    if least[j] < step:
                        step, to = least[j], j
            for j in range(m + 1):
                if used[j]:
                    u[owner[j]] += step
                    v[j] -= step
                else:
                    least[j] -= step
            at = to
            if not owner[at]:
                break
        while at:
            owner[at] = owner[way[at]]
            at = way[at]
    return [(owner[j] - 1, j - 1) for j in range(1, m + 1) if owner[j]]


def names_agree(a: tuple[str, ...], b: tuple[str, ...]) -> int:
    """2: the names agree; 1: they agree in one token only, or but for initials; 0: they don't."""
    _, alone, n, strong = align(a, b)
    if strong and alone == 0:
        return 2 if n >= 2 else 1
    # Middle initials may differ.
    long_a, long_b = long_tokens(a), long_tokens(b)
    _, alone, n, strong = align(long_a, long_b)
    if strong and alone == 0 and n >= 2:
        return 1
    return 1 if any(joined(x, y) for x, y in ((long_a, long_b), (long_b, long_a))) else 0


def long_tokens(name: tuple[str, ...]) -> tuple[str, ...]:
    return tuple(t for t in name if len(t) > 1)


def joined(a: tuple[str, ...], b: tuple[str, ...]) -> bool:
    """Whether names agree once two tokens of the first, that match none, are written together as one of the second; another token must match strongly."""
    if len(a) < 3 or len(a) < len(b):
        return False
    rest_a, rest_b = ([x for x in s if all(alike(x, y) < STRONG for y in t)] for s, t in ((a, b), (b, a)))
    for x in rest_a:
        for y in rest_a:
            if x != y and any(min(len(x), len(y)) >= 3 and close(x + y, w, 1) for w in rest_b):
                left = tuple(t for t in a if t not in (x, y))
                others = tuple(w for w in b if not close(x + y, w, 1))
                _, alone, n, strong = align(left, others)
                if strong and alone == 0 and n >= 1:
                    return True
    return False


def surname_only(a: tuple[str, ...], b: tuple[str, ...]) -> bool:
    """Whether one name is nothing but one long token, initials aside, and that is the other's."""
    a, b = long_tokens(a), long_tokens(b)
    _, alone, n, strong = align(a, b)
    return strong and alone == 0 and n == 1 and min(len(a), len(b)) == 1


def _same_email(a: dict, b: dict) -> bool | None:
    """Whether the addresses name one identity; None if that can't be told."""
    if a["number"] and b["number"]:
        return a["number"] == b["number"]
    if a["local"] and b["local"] and not a["number"] and not b["number"] and close(a["local"], b["local"], 1):
        return True
    return None


def _same_address(a: dict, b: dict) -> bool:
    return bool(a["house"]) and a["house"] == b["house"] and bool(a["street"]) and bool(b["street"]) and any(close(x, y, 2) for x in a["street"].split() for y in b["street"].split() if len(x) > 4 and len(y) > 4)


def _tokens(row: dict) -> tuple[str, ...]:
    return tuple(row["tokens"].split())


def linked(a: dict, b: dict) -> bool:
    """Whether two records are one entity by what they say themselves.

    Different identities in the e-mail addresses are outweighed only by the whole name with phone and house together; a surname
    with another initial only by e-mail and phone together.
    """
    agree, email, phone = names_agree(_tokens(a), _tokens(b)), _same_email(a, b), _same_phone(a, b)
    if not agree:
        return bool(email) and phone and surname_only(_tokens(a), _tokens(b))
    if email:
        return True
    place = _same_address(a, b)
    if email is False:
        return agree == 2 and phone and place
    return (phone or place) and (agree == 2 or phone and place)


def compatible(a: dict, b: dict) -> bool:
    """Whether nothing in two records of one component speaks against them."""
    agree, email = names_agree(_tokens(a), _tokens(b)), _same_email(a, b)
    if email is False:
        return agree == 2 and _same_phone(a, b) and _same_address(a, b)
    return agree > 0 or bool(email) and surname_only(_tokens(a), _tokens(b))


FIELDS = ("tokens", "number", "local", "phone", "house", "street")
_FEATURES = "key {}, form bigint, " + ", ".join(f"{f} string" for f in FIELDS) + ", keys array<bigint>"


def within(word: str, edits: int, kept: int = KEPT) -> set[str]:
    """Forms of a word; two words within so many edits share one.

    They have a common rest after at most ``edits`` letters are left out on either side, and the first ``kept``
    letters of it stand within the first ``kept + edits`` of both (words are filled up at the end).
    """
    head = word[: kept + edits].ljust(kept + edits, "\0")
    return set(map("".join, combinations(head, kept)))


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def fact_keys(row: dict) -> list[int]:
    """Hashes of the supporting facts; two records that have one in common, as ``linked`` sees it, share one. Those of phones are odd, all others even."""
    phone = [_hash(f"phone{row['phone'][-TAIL:]}") | 1] if row["phone"] else []
    facts = {f"number{row['number']}"} if row["number"] else set()
    if row["local"] and not row["number"]:
        facts |= {f"local{v}" for v in within(row["local"], 1, KEPT_LOCAL)}
    if row["house"]:
        facts |= {f"house{row['house']} {v}" for w in row["street"].split() if len(w) > 4 for v in within(w, 2)}
    return [*phone, *(_hash(f) & ~1 for f in facts)]


@lru_cache(1 << 14)
def token_keys(token: str) -> frozenset[str]:
    """Forms of a token; two tokens of 4 letters or more that match strongly share one."""
    if folded(token) != token:
        return _token_keys(token) | _token_keys(folded(token))
    return _token_keys(token)


def _token_keys(token: str) -> frozenset[str]:
    n = len(token)
    if n < 4:
        return frozenset({f"={token}"})
    keys = {f"={token}", *(f"^{name}" for name in _near_names(token))}
    keys |= {f"g{v}" for rest in unglued(token) if len(rest) >= 6 for v in within(rest, 1)}
    for edits in {most_edits(m) for m in range(4, n + 1) if n - m <= most_edits(m)}:
        keys |= {f"{edits}{v}" for v in within(token, edits)}
    return frozenset(keys)


def _refined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each fact of a form with each form of each name token."""
    for batch in batches:
        for form, fact, name in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            keys = [_hash(f"{fact}|{k}") & ~1 | fact & 1 for k in sorted(set().union(*map(token_keys, name.split())))]
            yield pa.RecordBatch.from_arrays([pa.array([form] * len(keys), pa.int64()), pa.array(keys, pa.int64())], ["form", "k"])


def _met(forms: DataFrame) -> DataFrame:
    """Pairs of forms that share a fact, in large blocks also a form of a token; with two e-mail identities the phone must be the same."""
    keys = forms.select("form", "number", F.explode("keys").alias("k"))
    sizes = keys.groupBy("k").agg(F.count("*").alias("n")).where("n > 1")
    small = keys.join(sizes.where(F.col("n") <= BLOCK), "k").select("form", "number", "k")
    large = keys.join(sizes.where(F.col("n") > BLOCK), "k").select("form", "k").join(forms.select("form", "tokens"), "form").select("form", "k", "tokens")
    refined = large.mapInArrow(_refined, "form bigint, k bigint").join(forms.select("form", "number"), "form").select("form", "number", "k")

    def pairs(rows: DataFrame) -> DataFrame:
        side = lambda s: rows.select(F.col("form").alias(s), F.col("number").alias(f"number_{s}"), "k")
        return side("a").join(side("b"), "k").where("a < b and (number_a = '' or number_b = '' or number_a = number_b or k & 1 = 1)").select("a", "b")

    return pairs(small).unionByName(pairs(refined)).distinct()


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {k: [] for k in ("key", "form", *FIELDS, "keys")}
        for key, first, last, email, phone, house, street in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            number, local = email_identity(email)
            row = {"tokens": " ".join(tokens(first, last)), "number": number, "local": local, "phone": phone_digits(phone), "house": house or "", "street": street or ""}
            if key is None or not row["tokens"] or not (number or local or row["phone"] or row["house"]):
                continue
            out["key"].append(key)
            out["form"].append(_hash("\x00".join(row[f] for f in FIELDS)))
            for f in FIELDS:
                out[f].append(row[f])
            out["keys"].append(fact_keys(row))
        types = [batch.schema.field(0).type, pa.int64(), *[pa.string()] * len(FIELDS), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], list(out))


def features(df: DataFrame) -> DataFrame:
    """Records with their form, the parts that are compared, and the keys of their facts."""
    own = ("record_id", "first_name", "last_name", "email", "phone")
    packed = df.select(F.struct(*own).alias("own"), "address", "city", "country")
    placed = addresses.normal(packed, "own").select("key.*", F.col("number").alias("house"), F.concat_ws(" ", "names").alias("street"))
    placeless = packed.where(~addresses.has_address("address")).select("own.*", F.lit("").alias("house"), F.lit("").alias("street"))
    rows = placed.unionByName(placeless)
    return rows.select("record_id", "first_name", "last_name", "email", "phone", "house", "street").mapInArrow(_features, _FEATURES.format(df.schema["record_id"].dataType.simpleString()))


def _scored(accept):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            kept = [r for r in rows if accept({f: r[f"{f}_a"] for f in FIELDS}, {f: r[f"{f}_b"] for f in FIELDS})]
            yield pa.RecordBatch.from_arrays([pa.array([r[s] for r in kept], pa.int64()) for s in "ab"], ["a", "b"])

    return run


def _compare(pairs: DataFrame, forms: DataFrame, accept) -> DataFrame:
    """The pairs of forms that ``accept`` takes; those of two e-mail identities, which it takes only if phone and house are equal, are dropped before."""
    side = lambda s: forms.select(F.col("form").alias(s), *(F.col(f).alias(f"{f}_{s}") for f in FIELDS))
    rows = pairs.join(side("a"), "a").join(side("b"), "b")
    rows = rows.where(f"number_a = '' or number_b = '' or number_a = number_b or house_a <> '' and house_a = house_b and phone_a <> '' and right(phone_a, {TAIL}) = right(phone_b, {TAIL})")
    return rows.mapInArrow(_scored(accept), "a bigint, b bigint")


def entities(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Records with their form and parts, forms with their component, and the direct links between forms."""
    records = written(features(df), "names")
    forms = records.groupBy("form").agg(*(F.first(f).alias(f) for f in FIELDS), F.first("keys").alias("keys"), F.count("*").alias("rows"))
    forms = written(forms, "forms")
    links = written(_compare(_met(forms), forms, linked), "links")
    return records.select("key", "form"), components(links).join(forms, "form"), links


def _bridged(members: DataFrame, links: DataFrame) -> DataFrame:
    """The members, where e-mail identities of a component that links connect are written as one."""
    sides = [members.select(F.col("form").alias(s), F.col("label"), F.col("number").alias(f"number_{s}")) for s in "ab"]
    crossing = links.join(sides[0], "a").join(sides[1].drop("label"), "b").where("number_a <> '' and number_b <> '' and number_a <> number_b")
    crossing = written(crossing.select(*(F.xxhash64("label", f"number_{s}").alias(s) for s in "ab")).distinct(), "bridges")
    if crossing.isEmpty():
        return members
    one = components(crossing).select(F.col("form").alias("node"), F.col("label").alias("identity"))
    rows = members.withColumn("node", F.xxhash64("label", "number")).join(one, "node", "left")
    return rows.withColumn("number", F.coalesce(F.col("identity").cast("string"), "number")).drop("node", "identity")


def same_entity(df: DataFrame) -> DataFrame:
    """Pairs ``a`` < ``b`` of records of the same person or organisation, all pairs within an entity."""
    records, members, links = entities(df)
    members = _bridged(members, links)
    inside = members.select(F.col("form").alias("a"), "label").join(members.select(F.col("form").alias("b"), "label"), "label").where("a < b").select("a", "b")
    pairs = _compare(inside, members, compatible)
    several = records.groupBy("form").agg(F.count("*").alias("n")).where("n > 1").select(F.col("form").alias("a"), F.col("form").alias("b"))
    found = pairs.unionByName(several).join(records.select(F.col("form").alias("a"), F.col("key").alias("x")), "a").join(records.select(F.col("form").alias("b"), F.col("key").alias("y")), "b")
    return found.where("a <> b and x <> y or x < y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()

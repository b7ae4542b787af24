"""Variant spellings of names typed by people (problem 1).

Merge-and-rematch resolution. A profile is what is known of one entity: the
forms of its surname, the forms of its given names with their initials and
short forms, or the forms of each word of an organisation. Every spelling
starts as a profile. Profiles that share a block and agree are merged, which
unions their forms and initials; the merged ones enter blocking again with all
they know and are compared as a whole with every profile that shares a block,
until a round merges nothing. So a spelling with one error in the surname and
another in the given name is reached through two spellings with one error
each, and an initial known from one spelling keeps another apart. Short forms
(initials, nicknames) join a profile only where exactly one fits.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import count, product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.llm.skeleton import folded
from quernstone.operators.graph import connected_components
from quernstone.operators.grouping import map_key_runs, split_hot
from quernstone.session import materialize, release

# Titles before names, particles, legal forms and small words.
_TITLES = set("dr pr prof professeur professor mtre maitre me m mr mrs ms mme mlle monsieur madame herr frau don dona sr sra sir".split())
_PARTICLES = ("van", "von", "der", "den", "de", "du", "des", "le", "la", "les", "d", "l", "di", "da", "do", "dos", "del", "el", "ter", "ten")
_SMALL = set("de des du la le les l d the of for and et y e a au aux der die das von vom fur del los las el do da dos en in und v asbl sarl scop ev inc ltd".split())

# First words of organisations and their usual abbreviations.
_ORG_WORDS = set(
    "association assoc federation fed syndicat synd institut institute instituto inst cooperative cooperativa coop collectif colectivo coletivo coll comite comision commission cte"
    " reseau res red union junta jta society soc societe sociedad sociedade trust tr bodengenossenschaft bodengen genossenschaft verein verband bund verlag editions presses"
    " universite university universidad universidade centre center centro ligue league fondation foundation stiftung fundacion fundacao confederation conseil council ministere ministry"
    " office bureau agence mouvement movement groupe groupement atelier coordination archives musee bibliotheque library".split()
)

# Short forms of given names.
_NICKNAMES = {
    "alex": "alexandre alexandra", "babette": "elisabeth", "bebert": "albert robert", "cricri": "christine christian", "doudou": "edouard", "gege": "gerard", "ginette": "genevieve", "guitte": "marguerite",
    "jeannot": "jean", "lisette": "elisabeth", "loulou": "louis louise", "lulu": "lucien lucie", "mimile": "emile", "pierrot": "pierre", "riton": "henri", "zaza": "isabelle",
    "bea": "beatrice", "becky": "rebecca", "ben": "benjamin", "bill": "william", "bob": "robert", "cathy": "catherine", "chris": "christophe christine christian",
    "dan": "daniel", "dany": "daniel danielle", "dede": "andre", "delf": "delphine", "dom": "dominique", "fanfan": "francois francoise", "fanny": "stephanie francoise", "ferdi": "ferdinand",
    "flo": "florence florian", "fred": "frederic alfred", "fredo": "alfred frederic", "gaby": "gabriel gabrielle", "gitte": "brigitte", "gus": "gustave", "isa": "isabelle", "jacotte": "jacqueline",
    "jeje": "jerome", "jim": "james", "jo": "joseph josephine", "josie": "josephine", "juju": "julien julie", "kate": "catherine katharina", "kathe": "katharina", "lili": "elisabeth liliane",
    "lolo": "laurence laurent", "ludo": "ludovic", "mado": "madeleine", "manu": "emmanuel emmanuelle", "margot": "marguerite", "mat": "matthieu mathieu", "max": "maximilien maxime", "mel": "melanie",
    "mike": "michael", "nat": "nathanael nathalie", "nico": "nicolas", "patty": "patricia", "pepe": "jose", "phil": "philippe", "raph": "raphael", "sam": "samuel", "seb": "sebastien",
    "steph": "stephanie stephane", "theo": "theophile theodore", "tom": "thomas", "toine": "antoine", "val": "valentine valerie", "vero": "veronique", "vicky": "victoria", "willi": "wilfried wilhelm",
}
_FULL_OF = {k: frozenset(v.split()) for k, v in _NICKNAMES.items()}

# User accounts and devices.
_NO_ENTITY = re.compile(r"^(admin|administrator|administrateur|user|usuario|utilisateur( windows)?|windows|xerox|canon|ricoh|scanner.*|copieur.*|pao|stagiaire|owner|root|guest|invite|unknown|inconnu|anonyme|anonymous)$")


@lru_cache(maxsize=100_000)
def _org_word(w: str) -> bool:
    """A first word of organisations, one typing error allowed in longer ones."""
    return w in _ORG_WORDS or (len(w) >= 4 and any(len(o) >= 5 and near(w, o) for o in _ORG_WORDS))


# --- one spelling ---------------------------------------------------------------------------


class Parsed:
    """One spelling: ``kind`` (person, org, none), long tokens, initials."""

    __slots__ = ("kind", "tokens", "initials")

    def __init__(self, kind: str, tokens: tuple[str, ...], initials: tuple[str, ...]):
        self.kind, self.tokens, self.initials = kind, tokens, initials


#: A nickname in quotes beside the full name adds nothing to it.
_QUOTED = re.compile(r"\s[«“„\"‘'(][^«»“”\"]{2,20}?[»”“\"’')]\s")


def parse(spelling: str) -> Parsed:
    plain = re.sub(r"\s+", " ", folded(_QUOTED.sub(" ", spelling))).strip()
    if not plain or _NO_ENTITY.match(plain):
        return Parsed("none", (), ())
    words = re.findall(r"[^\W\d_]+(?:-[^\W\d_]+)*\.?", re.sub(r"['’]", " ", plain))
    bare = [w.rstrip(".") for w in words]
    if any(_org_word(w) for w in bare) or re.match(r"\s*[A-Z]\. [a-zà-ÿ]{4,} (de|des|du|of|von|dos|da)\b", spelling):
        acronym = re.findall(r"\(([A-Z]{2,6})\)|^([A-Z]{2,6}) [–-] ", spelling)
        drop = {folded(x) for pair in acronym for x in pair if x}
        tokens = tuple(w for w, full in zip(bare, words, strict=True) if w not in _SMALL and w not in drop and (len(w) > 1 or full.endswith(".")))
        return Parsed("org" if len(tokens) > 1 else "none", tokens, ())
    names = [(w, b) for w, b in zip(words, bare, strict=True) if b not in _TITLES or (w.endswith(".") and len(b) == 1)]
    initials = tuple(c for w, b in names if len(b) == 1 or (w.endswith(".") and len(b) <= 3) or re.fullmatch(r"[a-z]\.?-[a-z]", b) for c in (b[0], b[-1])[: 1 + ("-" in b)])
    tokens = tuple(b for w, b in names if len(b) > 1 and b not in _PARTICLES and not (w.endswith(".") and len(b) <= 3) and not re.fullmatch(r"[a-z]-[a-z]", b))
    if len(tokens) + len(initials) < 2 or len(tokens) > 4 or not tokens:
        return Parsed("none", tokens, initials)
    return Parsed("person", tokens, initials)


def near(a: str, b: str) -> bool:
    """At most one edit: insertion, deletion, substitution or swap of neighbours."""
    if a == b:
        return True
    la, lb = len(a), len(b)
    if abs(la - lb) > 1 or min(la, lb) < 4:
        return False
    i = 0
    while i < min(la, lb) and a[i] == b[i]:
        i += 1
    if la == lb:
        return a[i + 1 :] == b[i + 1 :] or (i + 1 < la and a[i] == b[i + 1] and a[i + 1] == b[i] and a[i + 2 :] == b[i + 2 :])
    return a[i + 1 :] == b[i:] if la > lb else a[i:] == b[i + 1 :]


def _joined(a: str, b: str) -> bool:
    """Surnames agree, one of them perhaps with its particle glued on."""
    if _alike(a, b):
        return True
    short, long = (a, b) if len(a) < len(b) else (b, a)
    return long.endswith(short) and long[: len(long) - len(short)] in _PARTICLES


def _alike(a: str, b: str) -> bool:
    """One edit apart at most, but not only in a last vowel: Paul and Paula, Marie and Maria are two names."""
    return a == b or (near(a, b) and not _other_ending(a, b))


def _other_ending(a: str, b: str) -> bool:
    short, long = sorted((a, b), key=len)
    return long[-1] in "aeiou" and (long[:-1] == short or (len(long) == len(short) and long[:-1] == short[:-1] and short[-1] in "aeiou" and long != short))


_BESIDE = re.compile(r"(\w[\w-]+) [«“„\"‘(] ?(\w{2,9}) ?[»”“\"’)] \w")


def beside(spelling: str) -> tuple[str, str] | None:
    """``(short form, full name)`` of a name such as *Robert « Bob » Kultin*."""
    m = _BESIDE.search(spelling)
    return (folded(m[2]), folded(m[1])) if m and len(m[2]) < len(m[1]) and not m[2].isupper() else None


def _abbreviates(a: str, b: str) -> bool:
    short, long = sorted((a, b), key=len)
    if not 1 <= len(short) <= 8 or short[0] != long[0] or len(long) - len(short) < 2:
        return False
    if long.startswith(short):
        return True
    if len(short) > 4:
        return False
    it = iter(long)
    return all(c in it for c in short)


# --- profiles -------------------------------------------------------------------------------


class Profile:
    """What is known of one entity; written as one line of text (``card``).

    Persons: ``readings``, each the forms of the surname and those of the given
    names. A spelling does not tell which of its words is the surname, so it
    has a reading for each; merging keeps the readings that agree. A given name
    is its words, then ``/`` and further initials: ``octave``, ``octave/b``,
    ``/ob``. ``alias`` are full names of short forms learned from the data.
    Organisations: ``slots``, the forms of each word.
    """

    __slots__ = ("card", "kind", "readings", "alias", "slots", "known")

    def __init__(self, card: str):
        self.card = card
        self.kind, *parts = card.split("\t")
        self.readings: list[tuple[frozenset[str], frozenset[str]]] = []
        self.slots: list[frozenset[str]] = []
        self.alias: dict[str, frozenset[str]] = {}
        if self.kind == "p":
            for pair in filter(None, parts[0].split(",")):
                k, v = pair.split(">")
                self.alias[k] = self.alias.get(k, frozenset()) | {v}
            for r in parts[1:]:
                s, g = r.split("|")
                self.readings.append((frozenset(s.split(",")), frozenset(g.split(","))))
        else:
            self.slots = [frozenset(x.split(",")) for x in parts]
        self.known = [_Given(g, self) for _, g in self.readings]

    def full_of(self, w: str) -> frozenset[str]:
        return _FULL_OF.get(w, frozenset()) | self.alias.get(w, frozenset())


class _Given:
    """Forms of given names of one reading, taken apart once."""

    __slots__ = ("full", "words", "marks", "seqs", "more")

    def __init__(self, forms: Iterable[str], profile: Profile):
        split = [g.split("/") for g in sorted(forms)]
        named = [(w.split(), i) for w, i in split if w]
        #: full forms without blanks; initials alone count only where no full form is known
        self.full = sorted({"".join(ws) for ws, _ in named})
        self.words = sorted({w for ws, _ in named for w in ws})
        self.marks = {w: {w[0], *(f[0] for f in profile.full_of(w))} for w in self.words}
        seqs = {"".join(w[0] for w in ws) + i for ws, i in named} if named else {i for _, i in split}
        self.seqs = sorted(seqs)
        #: initials after the first that are known
        self.more = sorted({i if w else i[1:] for w, i in split} - {""})


def _write_person(alias: dict[str, frozenset[str]], readings: Iterable[tuple[frozenset[str], frozenset[str]]]) -> str:
    pairs = ",".join(sorted(f"{k}>{v}" for k, vs in alias.items() for v in vs))
    return "\t".join(["p", pairs, *sorted({",".join(sorted(s)) + "|" + ",".join(sorted(g)) for s, g in readings})])


def _write_org(slots: Iterable[frozenset[str]]) -> str:
    return "\t".join(["o", *sorted(",".join(sorted(s)) for s in slots)])


@lru_cache(maxsize=100_000)
def profile(card: str) -> Profile:
    return Profile(card)


def card_of(spelling: str, alias: dict[str, frozenset[str]] | None = None) -> str | None:
    """The profile of a single spelling; None if it denotes no entity or could be any."""
    return _card(parse(spelling), alias)


def _card(p: Parsed, alias: dict[str, frozenset[str]] | None = None) -> str | None:
    if p.kind == "none":
        return None
    if p.kind == "org":
        return _write_org(frozenset([t]) for t in p.tokens) if any(len(t) >= 5 and not _org_word(t) for t in p.tokens) else None
    more = "".join(p.initials)
    readings = []
    for i, t in enumerate(p.tokens):
        given = " ".join(u.replace("-", " ") for k, u in enumerate(p.tokens) if k != i)
        readings.append((frozenset([t]), frozenset([f"{given}/{more}"])))
    known = {t: alias[t] for t in p.tokens if alias and t in alias}
    return _write_person(known, readings)


def _apart(x: _Given, y: _Given) -> bool:
    """Initials after the first that are known on both sides and differ."""
    return any(c != d for a in x.more for b in y.more for c, d in zip(a, b, strict=False))


def _given_match(x: _Given, y: _Given, p: Profile, q: Profile) -> int:
    """2 same given names, 1 possible (a short form, or initials that one side lacks), 0 different."""
    if not x.full and not y.full:
        if not any(a[0] == b[0] for a in x.seqs for b in y.seqs) or _apart(x, y):
            return 0
        return 2 if bool(x.more) == bool(y.more) else 1
    if x.full and y.full:
        if _apart(x, y):
            return 0
        best = 0
        for u in x.full:
            for v in y.full:
                if _alike(u, v) or _cut(u, v, p, q):
                    return 2 if bool(x.more) == bool(y.more) else 1
                best = best or int(_nick(u, v, p, q))
        return best
    short, long = (y, x) if x.full else (x, y)
    for i in short.seqs:
        for w, marks in long.marks.items():
            if i[0] in marks:
                after = [s[s.index(w[0]) :] for s in long.seqs if w[0] in s]
                if not any(a[k] != i[k] for a in after for k in range(1, min(len(a), len(i)))):
                    return 1
    return 0


def _nick(a: str, b: str, p: Profile, q: Profile) -> bool:
    fa, fb = p.full_of(a) | q.full_of(a), p.full_of(b) | q.full_of(b)
    if b in fa or a in fb or fa & fb:
        return True
    short, long = sorted((a, b), key=len)
    return 3 <= len(short) < len(long) and long.startswith(short) and not _other_ending(a, b)


def _cut(a: str, b: str, p: Profile, q: Profile) -> bool:
    """A given name cut short to four or five letters."""
    short, long = sorted((a, b), key=len)
    return 4 <= len(short) <= 5 and len(long) - len(short) >= 3 and long.startswith(short) and not (p.full_of(short) | q.full_of(short))


def _slot_map(a: Profile, b: Profile) -> list[tuple[int, int]] | None:
    """Which words of two organisations stand for each other; None if they are different ones."""
    if len(a.slots) != len(b.slots):
        return None
    mine = sorted(range(len(a.slots)), key=lambda i: -max(map(len, a.slots[i])))
    left = list(range(len(b.slots)))
    pairs, proper = [], 0
    # the surest agreement first, else an abbreviation may take another word's partner
    for agree in (str.__eq__, near, _abbreviates):
        for i in list(mine):
            hit = next((j for j in left if any(agree(t, u) for t in a.slots[i] for u in b.slots[j])), None)
            if hit is None:
                continue
            proper += agree is not _abbreviates and any(not _org_word(t) and len(t) >= 5 for t in a.slots[i])
            mine.remove(i)
            left.remove(hit)
            pairs.append((i, hit))
    return pairs if not mine and proper else None


def compare_profiles(p: Profile, q: Profile) -> int:
    """2 same entity, 1 possible (a short form on one side), 0 different."""
    if p.kind != q.kind:
        return 0
    if p.kind == "o":
        return 2 if _slot_map(p, q) else 0
    best = 0
    for (s, _), x in zip(p.readings, p.known, strict=True):
        for (t, _), y in zip(q.readings, q.known, strict=True):
            if any(_joined(a, b) for a in s for b in t):
                best = max(best, _given_match(x, y, p, q))
                if best == 2:
                    return 2
    return best


def compare(x: str, y: str) -> int:
    """:func:`compare_profiles` of two spellings."""
    a, b = card_of(x), card_of(y)
    return compare_profiles(profile(a), profile(b)) if a and b else 0


def merge_cards(cards: list[str]) -> str:
    """One profile out of those of one entity: forms, initials and short forms united.

    Each is laid over what is merged already in the readings that agree; one
    that fits no reading yet waits for the others. ``cards`` are the different
    profiles of one entity, not its rows.
    """
    first, *rest = sorted(set(cards), key=lambda c: (len(c), c))
    whole = profile(first)
    waiting = [profile(c) for c in rest]
    while waiting:
        held = []
        for q in waiting:
            merged = _unite(whole, q)
            if merged is None:
                held.append(q)
            else:
                whole = merged
        if len(held) == len(waiting):
            # joined through short forms that others explain: all readings stay
            for q in held:
                whole = _unite(whole, q, force=True) or whole
            break
        waiting = held
    return whole.card


def _unite(p: Profile, q: Profile, force: bool = False) -> Profile | None:
    if p.kind == "o":
        at = _slot_map(p, q)
        if at is None:
            return None
        return Profile(_write_org(p.slots[i] | q.slots[j] for i, j in at))
    alias = {k: p.alias.get(k, frozenset()) | q.alias.get(k, frozenset()) for k in {*p.alias, *q.alias}}
    found: dict[int, list] = {0: [], 1: [], 2: []}
    for (s, g), x in zip(p.readings, p.known, strict=True):
        for (t, h), y in zip(q.readings, q.known, strict=True):
            if any(_joined(a, b) for a in s for b in t):
                found[_given_match(x, y, p, q)].append((s | t, g | h))
    united = found[2] or found[1] or (p.readings + q.readings if force else [])
    return Profile(_write_person(alias, united)) if united else None


def fullness(card: str) -> int:
    """0 one initial, 1 several, 2 a nickname, 3 full names, 4 full names and initials."""
    p = profile(card)
    if p.kind == "o":
        return 4
    full = [x for x in p.known if x.full]
    if not full:
        return int(any(x.more for x in p.known))
    # a spelling does not tell which of its words is the given name
    named = [x for x in full if not all(p.full_of(w) or len(w) == 3 for w in x.words)]
    if len(named) < len(full):
        return 2
    return 3 + int(any(x.more for x in full))


# --- blocks ---------------------------------------------------------------------------------


def _deletions(t: str) -> set[str]:
    return {t} | {t[:i] + t[i + 1 :] for i in range(len(t))} if len(t) >= 4 else {t}


def _forms(t: str) -> set[str]:
    """Two tokens that ``_joined`` or ``near`` accept share one of these."""
    return _deletions(t) | {t[len(p) :] for p in _PARTICLES if t.startswith(p) and len(t) - len(p) > 1}


def _given_keys(x: _Given, p: Profile) -> set[str]:
    """Given names that agree share one: an edit leaves the first two letters or what follows them.

    Keys that end in a dot are initials: they are for pairs with a name of which
    only initials are known.
    """
    keys = {k for u in x.full for k in (u[:2], f"~{u[2:]}", f"~{u[3:]}", *(f[:2] for f in p.full_of(u)))}
    letters = {c for marks in x.marks.values() for c in marks} or {s[0] for s in x.seqs}
    return keys | {f"{c}." for c in letters}


def _org_keys(others: list[frozenset[str]], most: int = 4) -> set[str]:
    """Words that agree one by one share a letter of their first two; more than ``most`` words give one key a letter."""
    letters = [sorted({c for u in forms for c in u[:2]}) for forms in others]
    if len(others) > most:
        return {f"{len(others)} {c}" for cs in letters for c in cs}
    return {f"{len(others)} {''.join(sorted(cs))}" for cs in product(*letters)}


def block_keys(p: Profile) -> dict[str, set[str]]:
    """Blocks of a profile, each with the second parts it gets if the block is crowded.

    Any two profiles that ``compare_profiles`` accepts share a block and, in it,
    a second part. Whether a block is crowded depends on the block alone, so
    both sides decide alike.
    """
    keys: dict[str, set[str]] = defaultdict(set)
    for (block, _), second in block_rows(p).items():
        keys[block] |= second
    return keys


def block_rows(p: Profile) -> dict[tuple[str, str], set[str]]:
    """``block_keys`` by the form that a block comes from.

    Two profiles with the same form share the block of the whole form, so they
    need not meet in those with a letter left out.
    """
    keys: dict[tuple[str, str], set[str]] = defaultdict(set)
    if p.kind == "o":
        for i, forms in enumerate(p.slots):
            second = _org_keys([o for k, o in enumerate(p.slots) if k != i])
            for t in forms:
                # words count from four letters on, and not if listed
                if len(t) >= 4 and (len(t) == 4 or t not in _ORG_WORDS):
                    for d in _deletions(t):
                        keys[f"o {d}", f"o {t}"] |= second
        return keys
    for (surnames, _), x in zip(p.readings, p.known, strict=True):
        second = _given_keys(x, p)
        for t in surnames:
            for d in _forms(t):
                keys[f"p {d}", f"p {t}"] |= second
    return keys


# --- the table ------------------------------------------------------------------------------


def _short_forms(pool: DataFrame, least: int = 2) -> DataFrame:
    """``short, full``: short forms written beside full names in ``least`` different spellings or more.

    A pair seen once may be a pen name.
    """

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([b for s in pdf["name"] if (b := beside(s))], columns=["short", "full"])

    counts = pool.mapInPandas(pairs, "short string, full string").groupBy("short", "full").agg(F.count(F.lit(1)).alias("c"))
    return counts.where(F.col("c") >= least).select("short", "full")


def _first_profiles(pool: DataFrame) -> DataFrame:
    """``name, card``: the profile of each spelling that denotes an entity, with the short forms it may stand for."""

    def parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ps = [parse(s) for s in pdf["name"]]
            yield pd.DataFrame({"name": pdf["name"], "card": [_card(p) for p in ps], "ts": [list(p.tokens) if p.kind == "person" and len(p.tokens) > 1 else [] for p in ps]})

    first = materialize(pool.mapInPandas(parsed, "name string, card string, ts array<string>").where("card is not null"), "names")
    hit = first.select("name", F.explode("ts").alias("short")).join(_short_forms(pool), "short").groupBy("name").agg(F.collect_set(F.concat("short", F.lit(">"), "full")).alias("alias"))
    hit = materialize(hit, "names")

    def cards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for s, al in zip(pdf["name"], pdf["alias"], strict=True):
                known: dict[str, frozenset[str]] = {}
                for pair in al:
                    k, v = pair.split(">")
                    known[k] = known.get(k, frozenset()) | {v}
                out.append(card_of(s, known))
            yield pd.DataFrame({"name": pdf["name"], "card": out})

    plain = first.join(hit, "name", "left_anti").select("name", "card")
    return plain.unionByName(hit.mapInPandas(cards, "name string, card string"))


def _keyed(profiles: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """A row for each block and form of each profile; those of profiles that did not change are taken from ``before``."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(b, f, sorted(second), i, c) for i, c in zip(pdf["pid"], pdf["card"], strict=True) for (b, f), second in block_rows(profile(c)).items()]
            yield pd.DataFrame(rows, columns=["block", "form", "second", "pid", "card"])

    fresh = profiles.where("changed") if before is not None else profiles
    made = fresh.select("pid", "card").mapInPandas(emit, "block string, form string, second array<string>, pid string, card string")
    rows = made.select(F.xxhash64("block").alias("block"), F.xxhash64("form").alias("form"), "second", "pid", "card", F.lit(True).alias("changed"))
    if before is not None:
        still = profiles.where("not changed").select("pid")
        rows = rows.unionByName(before.join(still, "pid", "left_semi").withColumn("changed", F.lit(False)))
    rows = materialize(rows, "names")
    if before is not None:
        release(before)
    return rows


def _edges(profiles: DataFrame, crowd: int, limit: int, keyed: DataFrame | None = None) -> DataFrame:
    """``a, b, strength`` between profiles that share a block and agree; one of them changed in the round before."""
    keyed = _keyed(profiles) if keyed is None else keyed
    # a block of one form is needed only if it is the whole form
    sizes = keyed.groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.max("changed").alias("any"), (F.min("form") < F.max("form")).alias("mixed"))
    rows = keyed.join(sizes.where("n > 1 and any").select("block", "n", "mixed"), "block").where("mixed or form = block")
    few = rows.where(F.col("n") <= crowd).select(F.col("block").alias("tile"), F.lit(0).alias("side"), "second", "block", "form", "pid", "card", "changed")
    many = rows.where(F.col("n") > crowd).select("block", F.explode("second").alias("part"), "form", "pid", "card", "changed")
    many = many.select(F.xxhash64("block", "part").alias("key"), F.array("part").alias("second"), "block", "form", "pid", "card", "changed")
    tiles = few.unionByName(split_hot(many, "key", "pid", limit).select("tile", "side", "second", "block", "form", "pid", "card", "changed"))

    def match(pdf: pd.DataFrame, bounds: np.ndarray) -> pd.DataFrame:
        done: set[tuple[str, str]] = set()
        out: list[tuple[str, str, int]] = []
        pid, card, side, changed = (pdf[c].tolist() for c in ("pid", "card", "side", "changed"))
        second, form, block = pdf["second"].tolist(), pdf["form"].tolist(), pdf["block"].tolist()
        bare = lru_cache(maxsize=None)(lambda c: not all(x.full for x in profile(c).known))

        def meet(i: int, j: int) -> None:
            pair = (pid[i], pid[j]) if pid[i] < pid[j] else (pid[j], pid[i])
            if pair[0] != pair[1] and pair not in done:
                done.add(pair)
                if s := compare_profiles(profile(card[i]), profile(card[j])):
                    out.append((*pair, s))

        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if hi - lo < 2:
                continue
            cross, parts = any(side[lo:hi]), defaultdict(list)
            for i in range(lo, hi):
                for x in second[i]:
                    parts[x].append(i)
            for x, rows in parts.items():
                if len(rows) < 2:
                    continue
                # initials alone on one side, where the part is of initials; a changed profile on one side
                first = [i for i in rows if bare(card[i])] if x.endswith(".") else rows
                at = {i: k for k, i in enumerate(first)}
                new = [j for j in rows if changed[j]]
                for k, i in enumerate(first):
                    for j in rows if changed[i] else new:
                        if at.get(j, k + 1) > k and not (cross and side[i] == side[j]) and (form[i] != form[j] or form[i] == block[i]):
                            meet(i, j)
        return pd.DataFrame(out, columns=["a", "b", "strength"])

    return map_key_runs(tiles, "tile", match, "a string, b string, strength int").distinct()


def resolve_names(names: DataFrame, name: str = "name", limit: int = 2000, crowd: int = 100, max_rounds: int | None = None) -> DataFrame:
    """``name, entity``: every distinct spelling with the entity it denotes.

    ``entity`` is the smallest spelling of the merged profile. Null and blank
    strings are left out, repeated rows count once; devices, accounts and
    single words stay alone. Blocks of more than ``crowd`` profiles are divided
    by what stands beside the surname, parts of more than ``limit`` rows are
    compared in tiles; none is cut off. From the second round on only profiles
    that changed are compared (with all). Rounds go on until one merges
    nothing, each leaving fewer profiles; raises if ``max_rounds`` are given
    and do not suffice. Nothing is kept between calls.
    """
    pool = materialize(names.select(F.col(name).cast("string").alias("name")).where("name is not null and trim(name) <> ''").distinct(), "names")
    owners = materialize(_first_profiles(pool), "names")
    # equal profiles are one: case, order, blanks, titles and punctuation are gone
    members = owners.groupBy("card").agg(F.min("name").alias("pid"))
    owner = owners.join(members, "card").select("name", "pid")
    profiles = materialize(members.select("pid", "card", F.lit(True).alias("changed")), "names")
    maybe = keyed = None
    for rounds in count() if max_rounds is None else range(max_rounds):
        keyed = _keyed(profiles, keyed)
        edges = _edges(profiles, crowd, limit, keyed)
        if maybe is not None:
            edges = edges.unionByName(maybe).distinct()
        edges = materialize(edges, "names")
        moved = _merge(profiles, edges)
        if moved is None:
            break
        owner = owner.join(moved, "pid", "left").select("name", F.coalesce("root", "pid").alias("pid"))
        if rounds % 4 == 3:
            owner = materialize(owner, "names")
        profiles, maybe = _merged_profiles(profiles, moved), _still_open(edges, moved)
    else:
        raise RuntimeError("resolve_names: not converged")
    entity = owner.groupBy("pid").agg(F.min("name").alias("entity"))
    named = owner.join(entity, "pid").select("name", "entity")
    return pool.join(named, "name", "left").select("name", F.coalesce("entity", "name").alias("entity"))


def _merge(profiles: DataFrame, edges: DataFrame) -> DataFrame | None:
    """``pid, root`` of every profile merged in this round (roots too); None if there are none.

    Sure edges merge at once. A short form then joins the one fuller profile it
    may belong to; with two or more candidates it waits for a later round.
    """
    seen = {r["strength"]: r["n"] for r in edges.groupBy("strength").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not seen:
        return None
    comp = connected_components(edges.where("strength = 2"), "a", "b").select(F.col("node").alias("pid"), F.col("component").alias("root"))
    if 2 in seen:
        comp = materialize(comp, "names")
    if 1 not in seen:
        return comp
    at = lambda x, to: comp.select(F.col("pid").alias(x), F.col("root").alias(to))
    m = edges.where("strength = 1").join(at("a", "ra"), "a", "left").join(at("b", "rb"), "b", "left").select(F.coalesce("ra", "a").alias("pa"), F.coalesce("rb", "b").alias("pb"))
    both = m.unionByName(m.select(F.col("pb").alias("pa"), F.col("pa").alias("pb"))).where("pa <> pb").distinct()
    both = materialize(both, "names")
    asked = profiles.join(comp, "pid", "left").select(F.coalesce("root", "pid").alias("p"), "card").join(both.select(F.col("pa").alias("p")).distinct(), "p", "left_semi")
    level = _levels(asked).groupBy("p")
    level = level.agg(F.max("level").alias("level"), F.array_distinct(F.flatten(F.collect_set("letters"))).alias("letters"))
    both = both.join(level.select(F.col("p").alias("pa"), F.col("level").alias("la"), "letters"), "pa").join(level.select(F.col("p").alias("pb"), F.col("level").alias("lb")), "pb")
    one = both.where("la < lb").groupBy("pa").agg(F.count(F.lit(1)).alias("n"), F.min("pb").alias("pb"), F.first("letters").alias("letters")).where("n = 1")
    one = materialize(one.select("pa", "pb", "letters"), "names")
    # two that differ in their further initials cannot both belong to one: they wait
    torn = one.select("pb", F.explode("letters").alias("c")).groupBy("pb").agg(F.countDistinct("c").alias("cs")).where("cs > 1").select("pb")
    torn = one.where(F.size("letters") > 0).join(torn, "pb", "left_semi").select("pa")
    # nor is it known what belongs to a profile that is itself about to join another
    one = one.join(torn, "pa", "left_anti").select("pa", "pb")
    one = materialize(one.join(one.select(F.col("pa").alias("pb")), "pb", "left_anti"), "names")
    if not one.limit(1).count():
        return comp if 2 in seen else None
    ends = one.select(F.explode(F.array("pa", "pb")).alias("pid")).distinct()
    moved = comp.select("pid").unionByName(ends).distinct().join(comp, "pid", "left").select("pid", F.coalesce("root", "pid").alias("r1"))
    moved = moved.join(one.select(F.col("pa").alias("r1"), F.col("pb").alias("r2")), "r1", "left")
    return materialize(moved.select("pid", F.coalesce("r2", "r1").alias("root")), "names")


def _levels(profiles: DataFrame) -> DataFrame:
    """``p, level, letters``: fullness, and the first of the further initials."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            letters = [sorted({m[0] for x in p.known for m in x.more}) for p in map(profile, pdf["card"])]
            yield pd.DataFrame({"p": pdf["p"], "level": [fullness(c) for c in pdf["card"]], "letters": letters})

    return profiles.select("p", "card").mapInPandas(run, "p string, level int, letters array<string>")


def _merged_profiles(profiles: DataFrame, moved: DataFrame) -> DataFrame:
    """Profiles after a round: those merged are united and marked as changed."""

    def unite(pdf: pd.DataFrame, bounds: np.ndarray) -> pd.DataFrame:
        root, card = pdf["root"].to_numpy(), pdf["card"].to_numpy()
        return pd.DataFrame({"pid": root[bounds[:-1]], "card": [merge_cards(list(card[a:b])) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]})

    groups = profiles.join(moved, "pid").select("root", "card")
    new = map_key_runs(groups, "root", unite, "pid string, card string").withColumn("changed", F.lit(True))
    old = profiles.join(moved, "pid", "left_anti").select("pid", "card", F.lit(False).alias("changed"))
    out = materialize(new.unionByName(old), "names")
    release(profiles)
    return out


def _still_open(edges: DataFrame, moved: DataFrame) -> DataFrame:
    """Possible links between profiles that did not change; the others are found anew."""
    gone = moved.select("pid")
    return edges.where("strength = 1").join(gone.withColumnRenamed("pid", "a"), "a", "left_anti").join(gone.withColumnRenamed("pid", "b"), "b", "left_anti").select("a", "b", "strength")


def spelling_pairs(entities: DataFrame) -> DataFrame:
    """``name_a, name_b``: all pairs of different spellings of one entity."""
    b = entities.select(F.col("name").alias("name_b"), "entity")
    return entities.select(F.col("name").alias("name_a"), "entity").join(b, "entity").where("name_a < name_b").select("name_a", "name_b")

import random

import pytest

from quernstone.llm import names as N

SAME = [
    ("Octave Besvirhuzia", "Besvirhuzia Octave"), ("Octave Besvirhuzia", "Besvirhzia, Octave"), ("Octave Besvirhuzia", "octave  besvirhuzia "), 
    ("Florence Lejavnecnusec", "Florence Le Javnecnusec"), ("Blandine Gixhuzroria", "de Gixhuzroria, Blandine"), ("O. Besvirhuzia", "Besvirhuzia O."),
    ("Institut de recherche rurale de Zelmofbalia", "Inst. rech. rurale de Zelmofbalia"), ("Institut de recherche rurale de Zelmofbalia", "Zelmofbalia (Institut de recherche rurale de)"),
    ("Cooperativa hortelana de Murbubvir", "CHM – Cooperativa hortelana de Murbubbvir"), ("Society for the Lands of Sacgekmexia", "The Society for the Lands of Sacgekmexia, asbl"), ("Rééseau semences de Hafhop", "Réseau semences de Hafhop"),
]
# a name without further initials may be anyone's who has the same without
POSSIBLE = [("Octave Besvirhuzia", "Dr Octave B. Besvirhuzia"), ("J. Roux", "J. P. Roux"), ("J.-P. Roux", "Jean-Paul Roux"), ("P. Roux", "Jean Paul Roux"), ("O. Besvirhuzia", "Octave Besvirhuzia"), ("Alex Le Jitguffozo", "Alexandre Le Jitguffozo"), ("Bob Kultinkicia", "Robert Kultinkicia")]
DIFFERENT = [
    ("Hortense de Gasgixjuc", "Robert de Gasgixjuc"), ("H. de Gasgixjuc", "Robert de Gasgixjuc"), ("Institut de recherche rurale de Sacgekmexia", "Society for the Lands of Sacgekmexia"),
    ("Paul Martin", "Paula Martin"), ("Louis Martel", "Louise Martel"), ("Marie Dupont", "Maria Dupont"), ("J. P. Roux", "J. M. Roux"), ("Octave B. Roux", "Octave M. Roux"), ("J. M. Roux", "Jean-Paul Roux"),
    ("Union agricole de Lepnad", "Union forestière de Lepnad"), ("Robert « Bob » Makleppiv", "Robert « Bob » Zishuznecia"), ("admin", "Admin"), ("seigneurs locaux", "squatters"),
]


@pytest.mark.parametrize("pairs, want", [(SAME, 2), (POSSIBLE, 1), (DIFFERENT, 0)])
def test_compare(pairs, want):
    for a, b in pairs:
        assert N.compare(a, b) == want == N.compare(b, a), (a, b)


def test_abbreviation_takes_no_other_words_partner():
    assert N.compare("Jta. Regantes de Jtifarzokia", "Jta. Regantes de Jitrorfipia") == 0


def test_near_is_one_edit():
    def slow(a, b):
        d = {}
        for i in range(len(a) + 1):
            for j in range(len(b) + 1):
                if not i or not j:
                    d[i, j] = i + j
                    continue
                d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
        return d[len(a), len(b)]

    rnd = random.Random(1)
    for _ in range(4000):
        a = "".join(rnd.choice("abc") for _ in range(rnd.randrange(4, 8)))
        b = "".join(rnd.choice("abc") for _ in range(rnd.randrange(4, 8)))
        assert N.near(a, b) == (slow(a, b) <= 1)
        if N.near(a, b):
            assert N._deletions(a) & N._deletions(b)


def resolve(spark, rows, **kw):
    df = spark.createDataFrame([(r, "x", 1) for r in rows], "name string, profile string, full int")
    return {r["name"]: r["entity"] for r in N.resolve_names(df, **kw).collect()}


def test_merge_and_rematch(spark):
    rows = [a for p in SAME + DIFFERENT for a in p] + ["Fem Julie", "Samuel Mexmurpon", "Saamuel Mexmurpon", "Mexmurpon, S.", "Sam Mexmurpon", "Mexmurpon Saamuell", None, "", "  ", "Samuel Mexmurpon", "J" * 3000]
    got = resolve(spark, rows)
    for a, b in SAME:
        assert got[a] == got[b], (a, b)
    for a, b in DIFFERENT:
        assert got[a] != got[b], (a, b)
    # the second spelling error is reached through the spelling with one
    assert len({got[x] for x in ("Samuel Mexmurpon", "Saamuel Mexmurpon", "Mexmurpon, S.", "Sam Mexmurpon", "Mexmurpon Saamuell")}) == 1
    assert None not in got and "" not in got and got["J" * 3000] == "J" * 3000


def test_short_forms_wait_for_one_owner(spark):
    got = resolve(spark, ["Hortense de Gasgixjuc", "Henriette de Gasgixjuc", "H. de Gasgixjuc", "R. de Gasgixjuc", "Robert de Gasgixjuc"])
    assert got["H. de Gasgixjuc"] not in (got["Hortense de Gasgixjuc"], got["Henriette de Gasgixjuc"])
    assert got["R. de Gasgixjuc"] == got["Robert de Gasgixjuc"]


def test_hot_block_in_tiles(spark):
    rnd = random.Random(2)
    rows = [f"{''.join(rnd.choice('abcdefgh') for _ in range(9))} Gasgixjuc" for _ in range(60)] + ["Octave Gasgixjuc", "Gasgixjuc Octave"]
    whole, tiled = resolve(spark, rows), resolve(spark, rows, limit=7)
    assert whole == tiled and whole["Octave Gasgixjuc"] == whole["Gasgixjuc Octave"]


def test_crowded_blocks_lose_nothing(spark):
    rows = ["Octave Besvirhuzia", "Besvirhuzia Ocatve", "O. Besvirhuzia", "Hortense Besvirhuzia", "Octave Zelmofba"]
    got = resolve(spark, rows, crowd=0)
    assert got["Octave Besvirhuzia"] == got["Besvirhuzia Ocatve"] == got["O. Besvirhuzia"] != got["Hortense Besvirhuzia"]


def test_mixed_rare_and_common_tokens(spark):
    rnd = random.Random(3)
    made = lambda: "".join(rnd.choice("bcdfghkmpqrtvwxz") for _ in range(9))
    rows = [f"{made()} Martinel" for _ in range(70)] + [f"Jeannic {made()}" for _ in range(70)]
    rows += ["Isaline Martinel", "I. Martinel", "Jeannic Martinel", "Jaennic Martinel", "Eannic Martinel", "Alexandre Martinel", "Lexandre Martinel"]
    got = resolve(spark, rows, crowd=60)
    assert got["Isaline Martinel"] == got["I. Martinel"] != got["Jeannic Martinel"]
    assert got["Jeannic Martinel"] == got["Jaennic Martinel"] == got["Eannic Martinel"]
    assert got["Alexandre Martinel"] == got["Lexandre Martinel"]


def test_names_that_agree_share_a_block():
    rnd = random.Random(4)
    base = [s for p in SAME + POSSIBLE + DIFFERENT for s in p] + ["Jean Martin", "J. Martin", "Bob Martin", "Jean-Paul Vandyck", "Jean Paul Dyck", "Inst. recherche rur. Zelm.", "Robert Le Martin"]

    def spoil(s):
        for _ in range(rnd.randrange(3)):
            i = rnd.randrange(1, len(s))
            s = rnd.choice([s[:i] + s[i + 1 :], s[:i] + rnd.choice("aejmrz") + s[i:], s[: i - 1] + s[i] + s[i - 1] + s[i + 1 :]])
        return s

    spelled = sorted({spoil(s) for s in base for _ in range(12)} | set(base))
    known = [N.profile(c) for c in sorted({N.card_of(s) for s in spelled} - {None})]
    # profiles of several spellings too
    pools = [rnd.sample(known, 3) for _ in range(60)]
    known += [N.profile(N.merge_cards([p.card for p in ps])) for ps in pools if len({p.kind for p in ps}) == 1 and N.compare_profiles(ps[0], ps[1])]
    keys = [N.block_keys(p) for p in known]
    bare = [not all(x.full for x in p.known) for p in known]
    met = 0
    for i, a in enumerate(known):
        for j in range(i + 1, len(known)):
            if N.compare_profiles(a, known[j]):
                met += 1
                both = [(k, x) for k in keys[i].keys() & keys[j].keys() for x in keys[i][k] & keys[j][k]]
                assert any(not x.endswith(".") or bare[i] or bare[j] for _, x in both), (a.card, known[j].card)
    assert met > 500


def brute_force(rows):
    """All pairs of profiles, round by round."""
    cards = {c: {s} for s in rows if (c := N.card_of(s))}
    for s in rows:
        if c := N.card_of(s):
            cards[c].add(s)
    while True:
        merged = None
        for strength in (2, 1):
            links = [(a, b) for a in cards for b in cards if a < b and N.compare_profiles(N.profile(a), N.profile(b)) >= strength]
            if strength == 1:
                fuller = {a: {b for x in links for a_, b in (x, x[::-1]) if a_ == a and N.fullness(a) < N.fullness(b)} for a in cards}
                links = [(a, next(iter(bs))) for a, bs in fuller.items() if len(bs) == 1]
            if links:
                merged = links[0]
                break
        if merged is None:
            return {frozenset(v) for v in cards.values()}
        a, b = merged
        names = cards.pop(a) | cards.pop(b)
        cards[N.merge_cards([a, b])] = names | cards.get(N.merge_cards([a, b]), set())


@pytest.mark.parametrize("people, crowd", [(6, 0), (6, 100), (25, 0), (25, 3)])
def test_recall_against_brute_force(spark, people, crowd):
    rnd = random.Random(people)
    made = lambda: "".join(rnd.choice("bcdfglmnprstvz") + rnd.choice("aeiou") for _ in range(4)) + rnd.choice("lnrs")
    given = ["Samuel", "Octave", "Hortense", "Isaline", "Robert", "Florence"]
    surnames = [made() for _ in range(max(2, people // 4))]
    rows = set()
    for _ in range(people):
        g, f = rnd.choice(given), rnd.choice(surnames).capitalize()
        typo = lambda x: (lambda i: rnd.choice([x[:i] + x[i + 1 :], x[:i] + x[i] + x[i:]]))(rnd.randrange(1, len(x) - 1))
        rows |= set(rnd.sample([f"{g} {f}", f"{f}, {g}", f"{f.upper()} {g}", f"{typo(g)} {f}", f"{g} {typo(f)}", f"{typo(typo(g))} {f}", f"{typo(g)} {typo(f)}", f"{g[0]}. {f}", f"Dr {g} {f}"], 5))
    got = resolve(spark, sorted(rows), crowd=crowd)
    groups = {}
    for s in rows:
        if N.card_of(s):
            groups.setdefault(got[s], set()).add(s)
    pairs = lambda gs: {(a, b) for g in gs for a in g for b in g if a < b}
    want, have = pairs(brute_force(sorted(rows))), pairs(groups.values())
    assert len(want & have) >= 0.9 * len(want) and len(want & have) >= 0.9 * len(have)


def test_profiles_unite_what_their_spellings_know(spark):
    # one error in each name: neither spelling alone is within reach of the last one
    rows = ["Samuel Mexmurpon", "Saamuel Mexmurpon", "Samuel Mxmurpon"]
    assert not any(N.compare(a, "Saamuell Mxmurpn") for a in rows)
    got = resolve(spark, [*rows, "Saamuell Mxmurpn"])
    assert len(set(got.values())) == 1
    # an initial learned from one spelling keeps another one away
    got = resolve(spark, ["Samuel Mexmurpon", "Mexmurpon, Samuel B.", "S. Q. Mexmurpon", "S. B. Mexmurpon"])
    assert got["Samuel Mexmurpon"] == got["Mexmurpon, Samuel B."] == got["S. B. Mexmurpon"] != got["S. Q. Mexmurpon"]


def test_short_forms_are_learned_from_this_table_only(spark):
    rows = ["Isabelle « Zouzou » Kraflin", "Isabelle « Zouzou » Tegnov", "Zouzou Marbuk", "Isabelle Marbuk"]
    taught = resolve(spark, rows)
    assert taught["Zouzou Marbuk"] == taught["Isabelle Marbuk"]
    alone = resolve(spark, rows[2:])
    assert alone["Zouzou Marbuk"] != alone["Isabelle Marbuk"]


def test_rounds_until_nothing_merges(spark, monkeypatch):
    with pytest.raises(RuntimeError):
        resolve(spark, ["Octave Besvirhuzia", "Octave Besvirhzia"], max_rounds=1)
    rounds = []
    monkeypatch.setattr(N, "_edges", lambda profiles, *a: profiles.select(N.F.col("pid").alias("a"), N.F.col("pid").alias("b"), N.F.lit(2).alias("strength")))
    monkeypatch.setattr(N, "_merge", lambda profiles, edges: rounds.append(1) or (N.materialize(profiles.select("pid", N.F.col("pid").alias("root"))) if len(rounds) < 6 else None))
    resolve(spark, ["Octave Besvirhuzia"])
    assert len(rounds) == 6


def test_empty_and_pairs(spark):
    assert resolve(spark, []) == {}
    df = spark.createDataFrame([("b", "e"), ("a", "e"), ("c", "f")], "name string, entity string")
    assert [tuple(r) for r in N.spelling_pairs(df).collect()] == [("a", "b")]


def test_only_pairs_that_may_agree_are_compared(spark, monkeypatch):
    given = ["Abel", "Blandine", "Cedric", "Denise", "Edgar", "Fabrice", "Gontran", "Hubert", "Irma", "Jeanne", "Klaus", "Lucien", "Maurice", "Norbert", "Odile", "Pascal", "Quentin", "Roland", "Sylvain", "Thibaut"]
    rows = [f"{g} {f}" for g in given for f in ("Mexmurpon", "Mexmurpn")]
    want = resolve(spark, rows)
    assert len(set(want.values())) == len(given)
    seen = []

    def here(df, key, fn, schema):
        pdf = df.toPandas().sort_values(key, ignore_index=True)
        k = pdf[key].to_numpy()
        out = fn(pdf, N.np.concatenate([[0], N.np.flatnonzero(k[1:] != k[:-1]) + 1, [len(k)]]))
        return spark.createDataFrame([tuple(r) for r in out.itertuples(index=False)], schema)

    monkeypatch.setattr(N, "map_key_runs", here)
    compared = N.compare_profiles
    monkeypatch.setattr(N, "compare_profiles", lambda p, q: seen.append((p.card, q.card)) or compared(p, q))
    assert resolve(spark, rows) == want
    assert len(seen) < 3 * len(rows)

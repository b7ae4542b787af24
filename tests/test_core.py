"""Fixtures for the library's own operators, with expectations worked out by hand."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quernstone.functions import cite, lang, meta, rules, text, titles
from quernstone.operators import audit, catalog, dedup, discover, search, throttle
from quernstone.operators.graph import connected_components
from quernstone.operators.grouping import map_key_runs, split_hot


def one(spark, expr, schema="x int", row=(1,)):
    return spark.createDataFrame([row], schema).select(expr.alias("v")).first()["v"]


def test_effective_score(spark):
    f = lambda *v: one(spark, rules.effective_score(*[F.lit(x).cast("int") for x in v]))
    assert (f(0, 9, None), f(None, 9, 3), f(None, None, 7), f(None, None, None)) == (0, 9, 7, 0)


@pytest.mark.parametrize("raw, want", [("1884-1951", "1880s"), ("c. 12345", "inconnu"), ("", "inconnu"), (None, "inconnu"), ("x1999y", "1990s")])
def test_decade(spark, raw, want):
    assert one(spark, rules.decade(F.lit(raw).cast("string"))) == want


def test_publishable(spark):
    def f(final, initial, fmt, error, summary="s", id_="a"):
        cols = [F.lit(id_), F.lit(final).cast("int"), F.lit(initial).cast("int"), F.lit(None).cast("int"), F.lit(fmt), F.lit("http://x/y"), F.lit(error).cast("string"), F.lit(summary).cast("string")]
        return one(spark, rules.publishable(*cols, excluded=["13352415"]))

    assert f(4, None, "odt", None) and not f(None, 8, "pdf", "e") and f(5, 8, "pdf", "e") and not f(9, 9, "html", None) and not f(9, 9, "pdf", None, id_="13352415")


@pytest.mark.parametrize("sources, want", [(("brochure_1905.pdf", "publié en 2021-03-15"), "2021-03-15"), (("australie 1929-1936",), ""), (("congrès 1931 puis 1987",), "1987"), (("", None), "")])
def test_publication_date(spark, sources, want):
    assert one(spark, meta.publication_date(*[F.lit(s).cast("string") for s in sources], year_now=2026)) == want


def test_identifiers(spark):
    assert one(spark, meta.find_doi(F.lit("doi.org/10.1234/abcd.5678 pour"))) == "10.1234/abcd.5678"
    assert one(spark, meta.find_doi(F.lit("(10.1234/ab)."))) == "10.1234/ab"
    assert one(spark, meta.find_isbn(F.lit("978-2-07-040850-3 puis 978-2-07-040850-4"))) in ("9782070408504", "9782070408503")
    assert one(spark, meta.find_isbn(F.lit("080442957X"))) == "080442957X"
    assert one(spark, meta.find_isbn(F.lit("0804429571"))) == ""
    assert one(spark, meta.find_hal_id(F.lit("HAL-01234567"))) == "hal-01234567"


def test_titles(spark):
    t = lambda link, pdf, name: one(spark, titles.normalize_title(F.lit(link).cast("string"), F.lit(pdf).cast("string"), F.lit(name).cast("string")))
    assert t("· Les terres communes (PDF)", "Microsoft Word - x.doc", "x.pdf") == "Les terres communes"
    assert t("", "", "les_terres-communes.pdf") == "les terres communes"
    assert t("Titre: suite - fin (version italienne, à imprimer)", "", "a.pdf") == "Titre : suite — fin (version italienne)"
    assert t(None, None, None) == ""
    assert t("8pp A5", None, "la_terre-nue.pdf") == "la terre nue" and t("8pp A5", None, "A5.pdf") == "" and t("Terres nues 16 pages A5", "", "") == "Terres nues" and t("Terres NB", "", "") == "Terres"
    assert t("mini-manuel", "Manuel du jardin partagé", "x.pdf") == "Mini-Manuel : Du jardin partagé" and t("Mini Manuel de la terre", None, None) == "Mini-Manuel : De la terre"
    by = one(spark, titles.normalize_title(F.lit("Les landes (Ana Roux)"), F.lit(None).cast("string"), F.lit(""), F.lit("Ana Roux")))
    assert by == "Les landes" and t("Les landes (Ana Roux)", None, "") == "Les landes (Ana Roux)"
    assert t("Un titre (cahier) (PDF)", "Working paper 12", "") == "Un titre" and t("Les terres (PDF, 2e édition) en commun", None, "") == "Les terres (2e édition) en commun"


def test_language(spark):
    fr = "les terres des communes sont pour les gens qui ont une vie dans ce pays avec des champs et pour leur travail sur la terre mais pas plus que cette année comme nous " * 2
    d = lambda s: one(spark, lang.detect_language(F.lit(s)))
    assert d(fr) == "fr" and d("x" * 79) == "" and d("a " * 29 + "b" * 60) == "" and d("mot " * 40) == ""
    assert one(spark, lang.detect_by_hints(F.lit("terres terres terres"))) == ""
    assert one(spark, lang.detect_by_hints(F.lit("luttes_pour-les communs"))) == "fr"
    assert one(spark, lang.guess_language(F.lit("zzz"))) == "unknown"


def test_tokens(spark):
    assert one(spark, text.index_tokens(F.lit("Cœur des communs 2×3"))) == ["communs"]
    assert one(spark, text.fingerprint_tokens(F.lit("Été été ÉTÉS abcde Abcde xy"))) == ["abcde"]
    assert one(spark, text.first_sentence(F.lit("A! B. C"))) == "A! B."
    assert one(spark, text.strip_html(F.lit("<p>a</p>\n<b>b</b>"))) == "a b"
    assert one(spark, text.jaccard(F.array().cast("array<string>"), F.array().cast("array<string>"))) == 0.0
    assert one(spark, text.mark_terms(F.lit("Les Communs (x)"), ["communs", "(x)"])) == "Les <mark>Communs</mark> <mark>(x)</mark>"


def test_search(spark):
    docs = spark.createDataFrame([(1, "terre terre eau"), (2, "terre"), (3, None), (4, "")], "id int, text string")
    idx = search.postings(docs, "id", "text")
    assert [tuple(r) for r in search.search_all(idx, "id", ["terre", "terre"]).collect()] == [(1, 4), (2, 2)]
    assert search.search_all(idx, "id", ["terre", "inconnu"]).count() == 0 and search.search_all(idx, "id", []).count() == 0
    assert [tuple(r) for r in search.search_any(docs, "id", "text", ["eau", "ter"]).collect()] == [(1, 2), (2, 1)]


def test_jaccard_against_brute_force(spark):
    import random

    rnd = random.Random(5)
    base = [[f"w{rnd.randrange(200)}" for _ in range(30)] for _ in range(25)]
    rows = []
    for i in range(120):
        ts = set(rnd.choice(base))
        for _ in range(rnd.randrange(4)):
            ts.discard(rnd.choice(sorted(ts)))
            ts.add(f"x{rnd.randrange(9999)}")
        rows.append((i, sorted(ts)))
    rows += [(500, []), (501, rows[0][1])]
    df = spark.createDataFrame(rows, "id int, ts array<string>")
    got = {(r["a"], r["b"]): r["similarity"] for r in dedup.jaccard_pairs(df, "id", "ts", 0.8).collect()}
    reps = {}
    for i, ts in rows:
        reps.setdefault(tuple(ts), i)
    want = {}
    items = [(i, set(ts)) for ts, i in reps.items() if ts]
    for x, (i, a) in enumerate(items):
        for j, b in items[x + 1 :]:
            s = len(a & b) / len(a | b)
            if s >= 0.8:
                want[min(i, j), max(i, j)] = s
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert dedup.nearest_earlier(dedup.jaccard_pairs(df, "id", "ts", 0.8)).count() == len({b for _, b in want})


def _shuffled(spark):
    found = spark.sparkContext._jsc.sc().statusStore().executorList(True)
    return sum(found.apply(i).totalShuffleWrite() for i in range(found.size()))


def test_jaccard_shuffles_no_words(spark):
    import random

    rnd = random.Random(6)
    rows = [(i, sorted({f"word{rnd.randrange(3000)}" for _ in range(80)})) for i in range(2000)]
    rows += [(5000 + i, sorted(set(rows[0][1][:-1]) | {f"other{i}"})) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, ts array<string>")
    before = _shuffled(spark)
    for limit in (2000, 7):  # the second cuts the keys of the forty into tiles
        got = {(r["a"], r["b"]) for r in dedup.jaccard_pairs(df, "id", "ts", 0.95, limit).collect()}
        assert got == {(a, b) for a in [0, *range(5000, 5040)] for b in range(5000, 5040) if a < b}
        assert _shuffled(spark) - before < 400 * len(rows)
        before = _shuffled(spark)


def test_nearest_earlier_shuffles_no_words(spark):
    import random

    rnd = random.Random(8)
    rows = [(i, sorted({f"word{rnd.randrange(3000)}" for _ in range(80)})) for i in range(2000)]
    rows += [(5000, rows[3][1][1:]), (5001, rows[3][1][2:]), (5002, rows[4][1][1:])]
    before = _shuffled(spark)
    got = dedup.nearest_earlier(dedup.jaccard_pairs(spark.createDataFrame(rows, "id int, ts array<string>"), "id", "ts", 0.95)).collect()
    assert {(r["record"], r["duplicate_of"]) for r in got} == {(5000, 3), (5001, 5000), (5002, 4)}
    assert _shuffled(spark) - before < 400 * len(rows)


def test_jaccard_pairs_carry_no_words(spark):
    # long texts of one small vocabulary: nearly all pairs are at the threshold
    rows = [(i, [f"word number {w}" for w in range(300) if w not in (i, (7 * i + 1) % 300)]) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, ts array<string>")
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before = _shuffled(spark)
        got = {(r["a"], r["b"]): r["similarity"] for r in dedup.jaccard_pairs(df, "id", "ts", 0.95).collect()}
        moved = _shuffled(spark) - before
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    sets = {i: set(ts) for i, ts in rows}
    assert got == {(i, j): len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for i in sets for j in sets if i < j and sets[i] != sets[j]}
    assert moved < 5e6


def test_verified_in_blocks(spark):
    import random

    rnd = random.Random(9)
    sets = {f"r{i}": sorted({f"w{rnd.randrange(40)}" for _ in range(rnd.randrange(1, 40))}) for i in range(60)}
    cand = [(a, b) for a in sets for b in sets if a < b and rnd.random() < 0.5]
    args = spark.createDataFrame(cand, "a string, b string"), spark.createDataFrame(list(sets.items()), "k string, ts array<string>")
    want = {(a, b, s) for a, b in cand if (s := len(set(sets[a]) & set(sets[b])) / len(set(sets[a]) | set(sets[b]))) >= 0.4}
    for words, pairs in ((10**6, 10**6), (90, 10**6), (10**6, 20)):  # one block, many, many
        assert {tuple(r) for r in dedup._verified(*args, 0.4, "string", words, pairs).collect()} == want


def test_best_title_match_against_brute_force(spark):
    import random

    rnd = random.Random(7)
    heads = [[f"w{rnd.randrange(60)}" for _ in range(n)] for n in (3, 4, 5, 6, 8, 9, 10, 12, 14, 15, 16, 20) for _ in range(3)]
    side = lambda: [(f"{i:03}", [w for w in rnd.choice(heads) if rnd.random() > 0.06] + rnd.choice([[], ["more"], [f"x{i % 9}"]])) for i in range(200)]
    left, right = side() + [("n", None), ("e", [])], side() + [("f", []), ("g", None)]
    frame = lambda rows, k: spark.createDataFrame(rows, f"{k} string, w array<string>")
    got = {r["p"]: (r["q"], r["ratio"]) for r in dedup.best_title_match(frame(left, "p"), frame(right, "q"), "p", "q", "w", 0.8).collect()}
    want = {}
    for p, x in left:
        found = [(-len(set(x) & set(y)) / max(len(set(x)), len(set(y))), q) for q, y in right if x and y]
        best = [f for f in found if f[0] <= -0.8]
        if best:
            want[p] = (min(best)[1], round(-min(best)[0], 6))
    assert got == want and len({r for _, r in want.values()}) > 3
    # titles that differ in a place only: rows grow with the titles, not with their pairs
    many = [(f"{i:05}", ["chronicle", "landless", "history", "commons", "struggle", f"place{i}"]) for i in range(1500)]
    lone = [(k, [*w[:-1], f"other{k}"]) for k, w in many]
    before = _shuffled(spark)
    assert {r["q"] for r in dedup.best_title_match(frame(lone, "p"), frame(many, "q"), "p", "q", "w", 0.8).collect()} == {"00000"}
    assert _shuffled(spark) - before < 1000 * len(many)


def test_exact_duplicates(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b"), (4, None), (5, None)], "id int, t string")
    got = {tuple(r) for r in dedup.exact_duplicates(df, "id", F.sha2("t", 256)).collect()}
    assert got == {(1, 1, 1, 2), (3, 1, 2, 2)}


def test_components(spark):
    edges = [(f"n{i:03}", f"n{i + 1:03}") for i in range(60)] + [("z", "y"), ("q", "q"), (None, "r")]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "src string, dst string")).collect()}
    assert {got[f"n{i:03}"] for i in range(61)} == {"n000"} and got["z"] == got["y"] == "y" and got["q"] == "q" and "r" not in got
    assert connected_components(spark.createDataFrame([], "src string, dst string")).count() == 0


def test_runs_and_hot_keys(spark):
    df = spark.range(3000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))

    def sizes(pdf, bounds):
        return pd.DataFrame({"k": pdf["k"].to_numpy()[bounds[:-1]], "n": bounds[1:] - bounds[:-1]})

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = {r["k"]: r["n"] for r in map_key_runs(df, "k", sizes, "k bigint, n bigint").collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    assert got == {k: 429 if k < 4 else 428 for k in range(7)}
    tiles = split_hot(spark.range(50).select(F.lit(1).cast("bigint").alias("k"), "id"), "k", "id", 12).toPandas()
    met = set()
    for _, t in tiles.groupby("tile"):
        cross = t["side"].any()
        rows = list(zip(t["id"], t["side"], strict=True))
        assert len(rows) <= 60
        for x, (i, a) in enumerate(rows):
            for j, b in rows[x + 1 :]:
                if not cross or a != b:
                    assert (min(i, j), max(i, j)) not in met
                    met.add((min(i, j), max(i, j)))
    assert len(met) == 50 * 49 // 2


RUN = "id string, run_date string, source string, url string, score int, read_score int, doc_type string, doc_date string, lang string, downloaded boolean, saved_as string, title string"
CAT = "id string, url string, source string, first_seen string, latest_run string, score_initial int, latest_score int, score_final int, doc_type string, doc_date string, lang string, downloaded boolean, saved_as string, title string"


def test_merge(spark):
    cat = spark.createDataFrame([("a", "u", "s", "r0", "r0", 3, 3, 7, "livre", "1990", "fr", True, "old.pdf", "Fixed")], CAT)
    rep = spark.createDataFrame([("a", "r1", "s", "u", 5, None, None, "", "", True, "new.pdf", "Other"), ("b", "r1", "s", "v", 6, 2, "tract", "2001", "es", True, "b.pdf", "B"), ("c", "r1", "s", "w", 6, None, None, "", "", False, None, None)], RUN)
    arch = spark.createDataFrame([("c",)], "id string")
    over = spark.createDataFrame([("b", 8), ("zz", 1)], "id string, score int")
    out = catalog.merge_records(cat, rep, arch, over)
    got = {r["id"]: r for r in out.collect()}
    assert set(got) == {"a", "b"}
    a = got["a"]
    assert (a["score_initial"], a["latest_score"], a["score_final"], a["lang"], a["doc_type"], a["saved_as"], a["title"], a["first_seen"], a["latest_run"]) == (5, 5, 7, "fr", "livre", "old.pdf", "Fixed", "r0", "r1")
    assert (got["b"]["score_final"], got["b"]["title"], got["b"]["first_seen"]) == (8, "B", "r1")
    again = {tuple(r) for r in catalog.merge_records(out, rep, arch, over).collect()}
    assert again == {tuple(r) for r in out.collect()}


def test_archive_is_idempotent(spark):
    cat = spark.createDataFrame([("a", 1), ("b", 5)], "id string, s int")
    kept, moved = catalog.move_to_archive(cat, cat.limit(0), F.col("s") < 3)
    kept2, moved2 = catalog.move_to_archive(kept, moved, F.col("s") < 3)
    assert [r["id"] for r in kept2.collect()] == ["b"] and [r["id"] for r in moved2.collect()] == ["a"]


def test_candidates(spark):
    none = spark.createDataFrame([], "url string, seen_count int, first_seen string, last_seen string, found_from array<struct<doc_id: string, page: int>>")
    found = spark.createDataFrame([("u", "d", 1, "2026-01-01"), ("u", "d", 1, "2026-01-03")], "url string, doc_id string, page int, day string")
    r = catalog.merge_candidates(none, found).first()
    assert (r["seen_count"], len(r["found_from"]), r["first_seen"], r["last_seen"]) == (2, 1, "2026-01-01", "2026-01-03")
    r = catalog.merge_candidates(catalog.merge_candidates(none, found), found).first()
    assert (r["seen_count"], len(r["found_from"])) == (4, 1)


def test_change_dates(spark):
    cur = spark.createDataFrame([("a", "h1"), ("b", "h2"), ("c", "h3")], "id string, hash string")
    old = spark.createDataFrame([("a", "h1", "2020-01-01"), ("b", "hx", "2020-01-01"), ("gone", "h", "2020-01-01")], "id string, hash string, lastmod string")
    assert {r["id"]: r["lastmod"] for r in catalog.change_dates(cur, old, "2026-01-01").collect()} == {"a": "2020-01-01", "b": "2026-01-01", "c": "2026-01-01"}


def test_throttle(spark):
    runs = spark.createDataFrame([("s", i, 2) for i in range(3)] + [("t", 0, 2), ("t", 1, 2), ("t", 2, 5), ("u", 0, None)] + [("v", i, 0) for i in range(12)], "label string, o int, f int")
    got = {r["label"]: (r["low_runs"], r["interval_days"]) for r in throttle.interval_fold(runs, "label", F.col("o"), F.col("f")).collect()}
    assert got == {"s": (3, 14), "t": (0, 7), "u": (1, 7), "v": (12, 60)}
    assert [one(spark, throttle.backoff_days(F.lit(n))) for n in (0, 1, 2, 3, 4, 6, 40)] == [0, 0, 7, 14, 28, 60, 60]
    assert [one(spark, throttle.cooldown_hours(F.lit(c))) for c in (200, 429, 403)] == [0, 24, 168]
    assert throttle.robots_rules("User-agent: *\nDisallow: /a*\nDisallow: /b\n\nUser-agent: other\nDisallow: /c", "bot") == ["/b"]


def test_streaks(spark):
    ev = spark.createDataFrame([(1, "s", True), (2, "s", True), (3, "s", False), (4, "s", True), (1, "t", False)], "o int, k string, bad boolean")
    got = sorted((r["k"], r["o"], r["streak"]) for r in throttle.failure_streaks(ev, "k", [F.col("o")], F.col("bad")).collect())
    assert got == [("s", 1, 1), ("s", 2, 2), ("s", 3, 0), ("s", 4, 1), ("t", 1, 0)]


def test_gate(spark):
    state = spark.createDataFrame(
        [("cool", "d", "2026-02-01", True, 0, None, None, 7, 0), ("rob", "d2", None, False, 0, None, None, 7, 0), ("fail", "d2", None, True, 3, "2026-01-01", None, 7, 0), ("ttl", "d2", None, True, 0, None, "2026-01-08", 7, 0), ("low", "d2", None, True, 0, None, "2026-01-08", 14, 3), ("free", "d2", None, True, 0, None, "2025-12-01", 7, 0), ("lim", "d3", None, True, 0, None, None, 7, 0)],
        "label string, domain string, cooldown_until string, robots_allowed boolean, failures int, last_failure string, last_fetch string, interval_days int, low_runs int",
    )
    for c in ("cooldown_until", "last_failure", "last_fetch"):
        state = state.withColumn(c, F.col(c).cast("timestamp"))
    dom = spark.createDataFrame([("d3", "2026-01-11")], "domain string, rate_limit_until string").select("domain", F.col("rate_limit_until").cast("timestamp"), F.lit(None).cast("timestamp").alias("last_request"))
    got = {r["label"]: r["decision"] for r in throttle.gate(state, dom, "2026-01-10 00:00:00").collect()}
    assert got == {"cool": "in_cooldown", "rob": "robots_disallow", "fail": "failure_backoff", "ttl": "ttl_not_elapsed", "low": "low_yield_cooldown", "free": "ok", "lim": "domain_rate_limited"}


def test_quotes(spark):
    t = spark.createDataFrame([("d", "[p.1] Les terres\n[p.2] « L’été des com-\nmunes » fut long et dur pour tous ceux du pays")], "id string, text string")
    q = spark.createDataFrame([(1, "d", "l'ete des communes"), (2, "d", "long et dur pour tous ceux du village voisin la"), (3, "d", "trois mots loin"), (4, "x", "les terres"), (5, "d", None)], "q int, id string, quote string")
    got = {r["q"]: r["how"] for r in cite.verify_quotes(q, t, "q", "quote", "id", "text").collect()}
    assert got == {1: "exact", 2: "partial", 3: None, 4: None, 5: None}
    assert [tuple(r) for r in cite.quote_pages(q, cite.pages(t, "id", "text"), "q", "quote", "id").collect()] == [(1, 2)]


def test_pages_and_notes(spark):
    t = spark.createDataFrame([("d", "intro [p.1] un\n¹ voir https://a.b/c).\n[p.3] Bibliographie\nX, 1990"), ("e", None), ("f", "")], "id string, text string")
    pages = cite.pages(t, "id", "text")
    assert sorted((r["id"], r["page_no"]) for r in pages.collect()) == [("d", 0), ("d", 1), ("d", 3)]
    assert [tuple(r) for r in cite.footnote_links(pages, "id").collect()] == [("d", 1, "url", "https://a.b/c")]
    assert [tuple(r) for r in cite.bibliography_page(pages, "id").collect()] == [("d", 3, "heading")]


def test_audits(spark):
    issues = lambda c: sorted(one(spark, c))
    assert issues(audit.summary_issues(F.lit(""), F.lit("t"))) == ["empty"]
    assert issues(audit.summary_issues(F.lit("http://x.y " + "a" * 20), F.lit("t"))) == ["raw_url", "too_short"]
    assert issues(audit.date_issues(F.lit("1930-1937"), F.lit("x"), F.lit(None).cast("string"), 2026)) == ["range"]
    assert issues(audit.date_issues(F.lit("2030"), F.lit("en 1999"), F.lit("2026-01-01"), 2026)) == ["after_collection", "future", "title_year"]
    assert issues(audit.title_issues(F.lit("Le GRAND livre_x…"))) == ["capitals", "cut_off", "odd_signs"]
    assert one(spark, audit.date_confidence(F.lit("2001-02"), F.lit("2001"))) == "medium"


def test_discovery(spark):
    df = spark.createDataFrame([("d", {"b": [1], "a": [0, 2]})], "id string, inv map<string,array<int>>")
    assert discover.rebuild_abstract(df, "id", "inv").first()["abstract"] == "a b a"
    new = spark.createDataFrame([("10.1/A",), (None,), ("10.1/b",)], "doi string")
    old = spark.createDataFrame([(" 10.1/a",), (None,)], "doi string")
    assert sorted(r["doi"] or "" for r in discover.unknown_only(new, old, "doi").collect()) == ["", "10.1/b"]
    s = lambda h, g: one(spark, discover.link_status(F.lit(h).cast("int"), F.lit(g).cast("int")))
    assert (s(200, None), s(403, 200), s(404, None), s(None, None), s(500, 410)) == ("ok", "ok", "dead", "unchecked", "dead")
    assert one(spark, discover.theme_score(F.lit("commun foncier land terre tierra"), ["commun", "foncier", "land", "terre", "tierra"], [])) == 7


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "id string, t string, ts array<string>")
    assert dedup.jaccard_pairs(empty, "id", "ts", 0.9).count() == 0
    assert search.postings(empty, "id", "t").count() == 0
    assert dedup.duplicate_report(empty, F.col("t"), F.length("t")).first()["contents"] == 0

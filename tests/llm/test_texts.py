"""Look-alikes, residue, language and abuse on small fixtures and held-out rows."""

import pytest
from pyspark.sql import functions as F

from quernstone import session
from quernstone.llm import abuse, language, lookalike, residue
from quernstone.llm.skeleton import canonical, folded, skeleton

PAIRS = [("conﬁé", "confié"), ("ab", "ab"), ("ꓐꓰꓡ", "BEL"), ("ᎠᎡᎢ", "DRT"), ("𝒂b", "ab"), ("Habi﻿ter le mаrais", "Habiter le marais"), ("ｄｒｏｉｔｓ", "droits"), ("été là", "été là"), ("conﬂits dʼusage", "conflits d’usage"), ("Chroոicle", "Chronicle"), ("« κοινή γη »", "« κοινή γη »")]
VISIBLE = [("10 m²", "10 m2"), ("①", "1"), ("½", "1⁄2 "), ("кот", "kot"), ("Habiter", "habiter"), ("été", "ete"), ("les communs", "les communs de"), ("a-b", "a–b"), ("12", "13")]


def test_skeletons():
    for a, b in PAIRS:
        assert skeleton(a) == skeleton(b), (a, b)
    for a, b in PAIRS[-6:]:
        assert canonical(a) == canonical(b), (a, b)
    for a, b in VISIBLE:
        assert skeleton(a) != skeleton(b), (a, b)
    assert canonical("« земля и хлеб »") == "« земля и хлеб »" and skeleton(None) is None and skeleton("") == "" and folded("Œuvre ßÉ") == "oeuvre sse"


def test_full_list_of_confusables(monkeypatch, tmp_path):
    from quernstone.llm import skeleton as S

    f = tmp_path / "list.txt"
    f.write_text("\ufeff# comment\n0442 ; 0074 ;\tMA\t# t\n0031 ; 006C ; MA\n")
    monkeypatch.setenv("QUERNSTONE_CONFUSABLES", str(f))
    caches = (S.char_table, S._in_table, S._no_letters)
    [c.cache_clear() for c in caches]
    try:
        assert S.char_table()[0x442] in ("t", "ᴛ") and ord("1") not in S.char_table()
    finally:
        monkeypatch.undo()
        [c.cache_clear() for c in caches]


def test_lookalike_pairs(spark):
    rows = [(1, "аb", 0), (2, "ab", 0), (3, "ab", 0), (4, "аb", 0), (5, None, 0), (6, "", 0), (7, "AB", 0), (2, "ab", 0), (8, "​" * 20000 + "ab", 0)]
    forms = lookalike.lookalike_forms(spark.createDataFrame(rows, "id int, text string, field int"), "id", "text", "f")
    got = {(r["key_a"], r["key_b"]) for r in lookalike.lookalike_pairs(forms).collect()}
    assert got == {("1", "2"), ("1", "3"), ("1", "8"), ("2", "4"), ("2", "8"), ("3", "4"), ("3", "8"), ("4", "8")}
    classes = lookalike.lookalike_classes(forms).collect()
    assert len(classes) == 7 and {r["n_forms"] for r in classes if r["key"] != "7"} == {3} and {r["canonical"] for r in classes if r["key"] != "7"} == {"ab"}
    empty = lookalike.lookalike_forms(spark.createDataFrame([], "id int, text string"), "id", "text", "f")
    assert lookalike.lookalike_pairs(empty).count() == 0 and lookalike.lookalike_classes(empty).count() == 0


RESIDUE = ["{{ title }}", "Lorem ipsum dolor sit amet porta", "Erreur 502 : la page demandée est introuvable.", "Veuillez activer JavaScript pour afficher ce contenu.", "Votre texte ici", "Untitled", "Access denied.", "[résumé à compléter]", "This document by __auteur__, published in %year%, is about x."]
CONTENT = ["Les auteurs comparent l’erreur 404 des archives en ligne à la page arrachée d’un registre.", "L’ensemble {terre, eau, bois} y désigne les trois communs.", "Un chapitre explique pourquoi un site peut se passer de JavaScript et de toute plateforme.", "Sans titre ni terre à Tintudtev et ailleurs"]


def test_weak_labels():
    assert [residue.weak_label(s, False) for s in RESIDUE] == [1] * len(RESIDUE)
    assert [residue.weak_label(s, False, title=True) for s in CONTENT] == [0] * len(CONTENT)
    assert residue.weak_label("Page introuvable 404", True) == 1 and residue.weak_label("Page introuvable 404", False) is None


def _catalog(spark, rows):
    return spark.createDataFrame(rows, "id string, s string, t string, st string, u string, value string, title string")


def test_residue_model(spark):
    places = ["Lep", "Nad", "Haf", "Zel", "Gus", "Mor"]
    normal = [f"Les {w} de {p} défendent {o} contre l’avis du tribunal numéro{i}." for i, (w, p, o) in enumerate((w, p, o) for w in ("bergers", "meuniers", "glaneurs") for p in places for o in ("les landes", "le moulin", "les eaux", "la forêt"))]
    rows = [(str(i), s + (" " + CONTENT[i % 4] if i % 5 == 0 else ""), f"Titre {i} de {places[i % 6]}", "ok", f"http://h{i % 9}.example/x", "v", "t") for i, s in enumerate(normal)]
    rows += [(f"x{i}", RESIDUE[i % len(RESIDUE)] if i % 2 else normal[i] + " " + RESIDUE[i % len(RESIDUE)], None, "http_404", f"http://h{(i // 9 + i) % 9}.example/y", "v", "t") for i in range(40)]
    rows += [("n", None, "", None, None, None, None), ("e", "", "  ", None, "bad", None, None), ("l", normal[0] * 3000 + " {{ title }}", None, None, None, None, None)]
    df = _catalog(spark, rows)
    fields = {"summary": (F.col("s"), False), "pdf_title": (F.col("t"), True)}
    model, measures = residue.train_residue(df, "id", fields, F.col("st"), F.col("u"))
    assert measures["n_test"] > 0 and measures["recall"] >= 0.9 and measures["false_rate"] <= 0.05
    got = {(r["field"], r["rec_key"]): r["is_residue"] for r in residue.mark_residue(df, model, "id", fields).collect()}
    assert all(got["summary", f"x{i}"] for i in range(40)) and got["summary", "l"]
    assert sum(got["summary", str(i)] for i in range(len(normal))) == 0 and ("summary", "n") not in got and ("summary", "e") not in got
    empty = _catalog(spark, [])
    model, _ = residue.train_residue(empty, "id", fields, F.col("st"), F.col("u"))
    assert residue.mark_residue(empty, model, "id", fields).count() == 0


def test_residue_rare_kinds_beside_many_numbers(spark):
    rare = ["[Text folgt].", "TITRE ICI.", "Cliquez pour ajouter un titre.", "Merci de réessayer.", "Blindtext, bitte ersetzen."]
    normal = [f"Les bergers de {p} défendent {o} contre l’avis du tribunal." for p in ("Lep", "Nad", "Haf", "Zel") for o in ("les landes", "le moulin", "les eaux", "la forêt")]
    normal += [f"{a} {b}." for a in ("Un titre", "Le texte", "Merci au village", "Les eaux", "La forêt", "Le moulin") for b in ("de Lep", "ici et ailleurs", "à ajouter au recueil", "de tous", "sans maître", "des bergers", "du canton")]
    said = normal + [f"Request id {hash_:08x}" for hash_ in range(7, 4_000_000, 2000)] + rare
    df = _catalog(spark, [(str(i), s, None, None, f"http://h{i % 9}.example/x", "v", "t") for i, s in enumerate(said)])
    fields = {"summary": (F.col("s"), False)}
    model, _ = residue.train_residue(df, "id", fields, F.col("st"), F.col("u"), sample=60)
    assert not [path for _, path in session._WRITTEN if "/weak-" in path]
    got = {r["rec_key"]: r["is_residue"] for r in residue.mark_residue(df, model, "id", fields).collect()}
    assert [s for i, s in enumerate(said) if s not in normal and not got[str(i)]] == []
    assert sum(got[str(i)] for i in range(len(normal))) <= 1


TEXTS = {
    "fr": ["Les bergères du haut pays défendent les landes contre l’avis du tribunal.", "Les meuniers associés rachètent le moulin communal pour les foyers du canton.", "Dans ce chapitre, les auteurs décrivent longuement le droit de glanage."],
    "en": ["The upland shepherds defend the heath against the ruling of the court.", "The associated millers buy back the town mill for the households of the district.", "In this chapter, the authors describe at length the right to glean."],
    "es": ["Las pastoras de la sierra defienden el páramo contra el fallo del tribunal.", "Los molineros asociados recompran el molino municipal para los hogares del distrito.", "En este capítulo, los autores describen con detalle el derecho a espigar."],
    "de": ["Die Hirtinnen des Oberlands verteidigten die Heide gegen das Urteil des Gerichts.", "Die vereinigten Müller kauften die Gemeindemühle für die Haushalte des Bezirks.", "In diesem Kapitel beschreiben die Verfasser ausführlich das Recht der Nachlese."],
    "pt": ["As pastoras da serra defendem a charneca contra a sentença do tribunal.", "Os moleiros associados compram de volta o moinho comunal para os lares do distrito.", "Neste capítulo, os autores descrevem em pormenor o direito ao rebusco."],
}


@pytest.fixture(scope="module")
def dictionaries(spark):
    rows = [(t, g) for lang, ts in TEXTS.items() for t in ts for g in (lang, lang.upper())]
    rows += [(TEXTS["fr"][0], "en"), (TEXTS["de"][1], "fr"), (None, "fr"), ("x", "fr"), (TEXTS["es"][0], None)]
    return language.train_dictionaries(spark.createDataFrame(rows, "t string, g string"), "t", "g")


def test_narrow_whole_text_is_rejected(dictionaries):
    m = language.Compressors(dictionaries)
    assert m.stretches("Zixqo vruf pelk dwa.")[0][0] == "und"
    assert language.Compressors(dictionaries, whole_margin=1.0, margin=1.0).stretches(TEXTS["fr"][0])[0][0] == "und"


def test_tags():
    assert [language.tag_language(t) for t in ("fr-FR", "français", "EN_us", "xx", "", None, " und ", "it", "pt-BR")] == ["fr", "fr", "en", None, None, None, None, "other", "pt"]


def test_language(spark, dictionaries):
    s = {lang: " ".join(ts[:2]) for lang, ts in TEXTS.items()}
    rows = [("right", s["fr"], "fr-FR", 1), ("wrong", s["de"], "fr", 1), ("none", s["pt"], None, 1), ("mixed", s["fr"] + " / " + s["es"] + " " + TEXTS["fr"][2], "fr", 1), ("term", TEXTS["fr"][0] + " Le mot “enclosure of the commons” y revient. " + TEXTS["fr"][1], "fr", 1), ("null", None, "fr", 1), ("empty", " ", None, 1), ("signs", "12 + 34 = ?", None, 1), ("long", s["en"] * 4000, "en", 1)]
    seg = language.language_segments(spark.createDataFrame(rows, "id string, text string, tag string, lang int"), dictionaries, "id", "text", F.col("tag"), "f")
    got = {}
    for r in language.wrong_labels(seg).collect():
        got.setdefault(r["rec_key"], {})[r["seg_no"]] = r["lang"]
    assert got == {"wrong": {1: "de"}, "none": {1: "pt"}, "mixed": {1: "fr", 2: "es", 3: "fr"}}
    by = {r["rec_key"]: r for r in seg.collect()}
    assert by["signs"]["lang"] == "und" and by["long"]["lang"] == "en" and 0.5 < by["right"]["confidence"] <= 1.0 and "null" not in by and "empty" not in by


def test_language_held_out(spark, sf):
    from quernstone.llm import queries
    from quernstone.session import table

    dicts = language.train_dictionaries(queries._labelled(spark, sf), "text", "lang")
    docs = table(spark, sf.replace("sf0.001", "sf0.01"), "documents").where("lang in ('fr', 'en', 'es', 'de', 'pt')")
    seg = language.language_segments(docs, dicts, "doc_id", "text", F.col("lang"), "text").where("n_segments = 1").toPandas()
    assert (seg["lang"] == seg["tag_lang"]).mean() > 0.85  # some tags are wrong on purpose


def test_language_sample_of_different_texts(spark):
    said = {"fr": "dans cette terre nous sommes avec les paysans et pour les communs", "en": "in this land they have been with the peasants and for the commons"}
    rows = [(f"{c}{c}{c} {line} {c}{d}{c}{d}", lang) for lang, line in said.items() for c in "abcdefghijklmnopqrst" for d in "xyz"]
    rows += [(f"{said['fr']} encore", "fr")] * 3000
    df = spark.createDataFrame(rows, "t string, g string")
    got = language.train_dictionaries(df, "t", "g", sample_per_language=20)
    assert all(got[x].count(said[x].split()[-1].encode()) == 20 for x in said)
    # the room goes by hash, not to the first letters
    small = language.train_dictionaries(df, "t", "g", sample_per_language=60, dict_bytes=600)
    firsts = [small["en"].count(f"{c}{c}{c} in this".encode()) for c in "abcdefghijklmnopqrst"]
    assert sum(firsts) < 10 and any(firsts[5:])


def test_language_without_labels(spark):
    d = language.train_dictionaries(spark.createDataFrame([], "t string, g string"), "t", "g")
    assert language.Compressors(d).stretches("the house of the people is in the land and they have been there for it")[0][0] == "en"


def test_unmasking():
    s = abuse.Spelling()
    assert [s[w] for w in ("4bru71$", "v0llpf0$73n", "i*****s", "enfoiiiire", "1853", "19th")] == ["abrutis", "vollpfosten", "i#s", "enfoire", "0", "19th"]
    assert abuse.tokens_of("Quels c r é t i n s !\nI.d.i.o.t.e.n") == [["quels", "cretins"], ["idioten"]]


def _docs(n=400):
    clean = ["Les bergères du haut pays défendent les landes.", "Les meuniers rachètent le moulin communal.", "The upland shepherds defend the heath.", "La vermine a détruit le grain et les rats ont ruiné le silo."]
    foul = ["Bande d’abrutis, allez crever !", "Ces crétins méritent une raclée.", "Qu’on chasse cette vermine du pays !"]
    rows, labels = [], []
    for i in range(n):
        bad = i % 6 == 0
        body = [clean[(i + k) % 4] for k in range(5)]
        if bad:
            body[i % 5] = foul[(i // 6) % 3]
        rows.append((i, " ".join(body), f"s{i % 3}", "x"))
        if i < n // 2:
            labels.append((i, int(bad) if i % 41 else 1 - int(bad), "none", "r"))
    return rows, labels + [labels[0]]


def test_abuse(spark):
    rows, labels = _docs()
    rows += [(900, None, "s0", "x"), (901, "", None, "x"), (902, "Les landes. " * 20000 + "Bande d’abrutis, allez crever !", "s1", "x"), (903, "Bande d’4bru71$, allez c r e v e r !", "s1", "x"), (903, "Bande d’4bru71$, allez c r e v e r !", "s1", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, score string")
    labs = spark.createDataFrame(labels + [(2, None, None, None), (None, 1, "x", "r")], "doc_id bigint, toxic int, category string, annotator string")
    model = abuse.train_abuse(docs, labs)
    got = [r for r in abuse.score_documents(docs, model).collect()]
    flag = {r["doc_id"]: r for r in got}
    held = range(200, 400)
    assert sum(flag[i]["flagged"] == (i % 6 == 0) for i in held) >= 198
    assert not flag[900]["flagged"] and not flag[901]["flagged"] and flag[902]["flagged"] and flag[903]["flagged"] and len(got) == len(rows)
    assert flag[200 + (6 - 200 % 6)]["sentence_no"] == (200 + (6 - 200 % 6)) % 5
    rates = {r["source"]: r for r in abuse.rates(abuse.score_documents(docs, model)).collect()}
    assert rates[None]["documents"] == 1 and rates["s0"]["documents"] == 135


def test_abuse_without_labels(spark):
    docs = spark.createDataFrame([(1, "abruti", "s")], "doc_id bigint, text string, source string")
    labs = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert not abuse.score_documents(docs, abuse.train_abuse(docs, labs)).first()["flagged"]
    assert abuse.score_documents(docs.where("false"), abuse.train_abuse(docs.where("false"), labs)).count() == 0

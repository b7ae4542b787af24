"""Language by stop words, hints and source defaults, as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quernstone.functions.text import lit_array

# Frequent function words per language; ties go to the language listed first.
FUNCTION_WORDS = {
    "fr": "le la les des une dans pour que qui avec sur est pas plus cette nous comme aux par ont sont leur mais",
    "en": "the and for that with this from are was have not they their which been more would about there these",
    "es": "que los las una para con del por como más pero este esta son han sus muy también entre sobre",
    "pt": "que uma para com dos das por como mais mas este esta são não seu sua também entre sobre pelo",
    "de": "der die und den das ist ein eine von mit auf für nicht auch werden sich dass wird sind einen",
}

# Words of titles and file names that point to a language.
TITLE_HINTS = {
    "fr": "les des une pour dans avec contre mouvement luttes communs terres paysannerie foncier paysan territoire commun propriété liberté espace rencontres cahier brochure texte rapport recueil histoire pratique manuel anticapitalisme ecologie squat anticolonialisme quelques vers après entre",
    "en": "the and for land commons common peasant struggle movement rights agrarian enclosure trust cooperative community liberation freedom history practice toward against anarchism sabotage power state capital labor solidarity autonomy resistance",
    "es": "los las una para con del por tierra campesino campesina movimiento reforma agraria comunes derechos lucha libertad autonomia resistencia jovenes acciones publicaciones libros manual zapatista sindicato trabajadores pueblos",
    "pt": "dos das para com uma terra trabalhadores movimento agraria reforma camponeses questao biblioteca desenvolvimento desigualdade direitos sem-terra luta brasil",
    "de": "der die und den das für eine boden gemeinsam bewegung kapital arbeit freiheit programm bericht handbuch einführung fehlende barrierefrei eigenmittel veröffentlichung",
}

# Substrings that hint at a language in short texts.
SUBSTRING_HINTS = {
    "fr": ["de la", "des", "les ", "communs", "terre", "paysann", "réforme", "propriété", "agraire", "anarchi", "société"],
    "en": ["the ", " and ", "land", "peasant", "commons", "rural", "agrarian", "of the", "movement"],
    "es": ["tierra", "campesin", "comunes", "agrari", "movimiento", " de la ", " del ", "soberanía"],
    "de": ["die ", "der ", "und ", "deutsch", "boden", "agrar"],
    "pt": ["terra ", "camponê", "agrári", "movimento"],
}


def _among(words: Column, listed: str) -> Column:
    return F.size(F.filter(words, lambda w: w.isin(listed.split())))


def once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _ranked(scores: dict[str, Column], **more: dict[str, Column]) -> Column:
    """Languages by score, the first listed first on ties."""
    rows = [F.struct(s.alias("score"), F.lit(-i).alias("place"), F.lit(lang).alias("lang"), *[m[lang].alias(n) for n, m in more.items()]) for i, (lang, s) in enumerate(scores.items())]
    return F.sort_array(F.array(*rows), asc=False)


def _best(scores: dict[str, Column], least: int, none: str) -> Column:
    """The language of the highest score if it reaches ``least``."""
    return once(_ranked(scores), lambda r: F.when(r[0]["score"] >= least, r[0]["lang"]).otherwise(F.lit(none)))


def detect_language(text: Column, chars: int = 80, words: int = 30, sample: int = 600, least: int = 5) -> Column:
    """By function words among the first ``sample`` words; '' where there is too little."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[a-zà-öø-ÿ]+"), F.lit(0))

    def judge(w: Column) -> Column:
        best = once(F.slice(w, 1, sample), lambda head: _best({lang: _among(head, ws) for lang, ws in FUNCTION_WORDS.items()}, least, ""))
        return F.when(F.size(w) < words, "").otherwise(best)

    return F.when(F.length(F.coalesce(text, F.lit(""))) < chars, "").otherwise(once(found, judge))


def detect_by_hints(text: Column) -> Column:
    """By title words; needs two different ones and a lead over the second language."""
    spaced = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[-_./%+]", " ")
    found = F.regexp_extract_all(spaced, F.lit(r"[a-zà-öø-ÿ]{3,}"), F.lit(0))

    def judge(w: Column) -> Column:
        scores = {lang: _among(w, ws) for lang, ws in TITLE_HINTS.items()}
        kinds = {lang: F.size(F.array_intersect(F.array_distinct(w), lit_array(ws.split()))) for lang, ws in TITLE_HINTS.items()}
        return once(_ranked(scores, kinds=kinds), lambda r: F.when((r[0]["kinds"] >= 2) & (r[1]["score"] < r[0]["score"]), r[0]["lang"]).otherwise(F.lit("")))

    return once(found, judge)


def guess_language(text: Column) -> Column:
    """By substrings of a short text; ``unknown`` without any."""
    t = F.lower(F.coalesce(text, F.lit("")))
    scores = {lang: sum((F.contains(t, F.lit(h)).cast("int") for h in hs), F.lit(0)) for lang, hs in SUBSTRING_HINTS.items()}
    return _best(scores, 1, "unknown")


def resolve_language(tag: Column, text: Column, hints: Column, default: Column) -> Column:
    """Tag of the source, else the text, else title words, else the source's default."""
    five = list(FUNCTION_WORDS)
    code = F.substring(F.lower(F.coalesce(tag, F.lit(""))), 1, 2)
    pick = lambda c: F.nullif(c, F.lit(""))
    fallback = F.when(F.coalesce(default, F.lit("")).isin(five), default)
    return F.coalesce(F.when(code.isin(five), code), pick(detect_language(text)), pick(detect_by_hints(hints)), fallback, F.lit(""))

"""Language of texts and of their mixed-language segments (problem 5).

Compression classification: each language has a zstandard raw-content
dictionary built from labelled text; a sentence belongs to the language whose
dictionary lets it be written in the fewest bytes. Narrow margins are
rejected; such sentences join the stretch beside them.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernstone.llm.skeleton import folded

LANGS = ("fr", "en", "es", "de", "pt")

# ISO 639 codes and names of the five languages, accents removed.
_TAG_NAMES = {
    "fr": "fr fra fre francais french frances franzosisch",
    "en": "en eng english anglais ingles englisch",
    "es": "es spa esp espanol castellano spanish espagnol espanhol spanisch",
    "de": "de deu ger deutsch german allemand aleman alemao",
    "pt": "pt por portugues portuguese portugais portugiesisch",
}
_TAGS = {t: lang for lang, line in _TAG_NAMES.items() for t in line.split()}

# Codes and names of other languages, which a tag may name.
_OTHER_TAGS = set("it ita italiano italian italien nl nld dut nederlands dutch ca cat catala catalan oc oci occitan eu eus gl glg galego ro ron rum pl pol ru rus el ell la lat latin sv swe da dan no nor fi fin cs ces hu hun tr tur ar ara zh zho ja jpn eo epo br bre".split())

# Frequent short words, the seed of every dictionary.
_SEEDS = {
    "fr": " le la les des une dans pour avec sans par sur est sont qui que ce cette ces aux du de et en au plus ne pas leur leurs son sa ses nous vous il elle ils elles ont ete mais ou donc comme entre apres avant depuis jusqu a l’ d’ qu’ n’ s’ ",
    "en": " the of and to in is was for with that this these those from by on at as are were been has have had not but or an it its their they we you he she his her which who will would can could than then after before while without under over between through until ",
    "es": " el la los las de del y en que un una unos unas por con para sin sobre es son fue fueron se su sus no mas como pero entre hasta desde cuando donde este esta estos estas al lo le les muy tambien ya ha han ",
    "de": " der die das den dem des und in zu von mit ist sind war waren nicht ein eine einer eines einem einen auf fur an bei nach aus wie auch als sich uber unter durch ohne gegen um wird werden wurde wurden hat haben oder aber zum zur im am ",
    "pt": " o a os as de do da dos das e em no na nos nas que um uma uns umas por com para sem sobre ser foi foram se seu sua seus suas nao mais como mas entre ate desde quando onde este esta ao aos pelo pela muito tambem ja tem ",
}


def tag_language(tag: str | None) -> str | None:
    """What a tag names: one of the five, ``other``, or None (missing or no language)."""
    if not tag or not tag.strip():
        return None
    t = re.split(r"[-_\s(;,]", folded(tag.strip()))[0]
    return _TAGS.get(t) or ("other" if t in _OTHER_TAGS else None)


_SENTENCE = re.compile(r"(?<=[.!?…])[\s»”\"]+(?=\S)|\s+/\s+|^/\s+|\s+\|\s+|\n+")


def sentences(text: str) -> list[str]:
    return [s for s in (x.strip() for x in _SENTENCE.split(text) if x) if s]


_JUNK = re.compile(r"[^a-z’' -]+")
_QUOTED = re.compile(r"[“„«\"][^”“»\"]{1,40}[”“»\"]")


def _plain(s: str) -> bytes:
    """Letters only; a short quoted term is left out, it may be foreign."""
    return (" " + re.sub(r"\s+", " ", _JUNK.sub(" ", folded(_QUOTED.sub(" ", s)))).strip() + " ").encode()


class Compressors:
    """One zstandard compressor per language, with a margin rule.

    ``margin`` is the least relative gap between the two shortest encodings;
    sentences under it, and those with fewer than ``min_chars`` letters, get
    no language of their own.
    """

    def __init__(self, dictionaries: dict[str, bytes], level: int = 3, margin: float = 0.04, min_chars: int = 12, whole_margin: float = 0.02):
        self.langs = [x for x in LANGS if x in dictionaries]
        self.margin, self.min_chars, self.whole_margin = margin, min_chars, whole_margin
        params = zstandard.ZstdCompressionParameters.from_level(level, write_content_size=False, write_checksum=False, write_dict_id=False)
        self.by = []
        for lang in self.langs:
            d = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=params)
            self.by.append(zstandard.ZstdCompressor(dict_data=d, compression_params=params))
        self.known: dict[str, tuple[str | None, float]] = {}

    def classify(self, sentence: str) -> tuple[str | None, float]:
        """``(language or None, confidence)``; confidence from the bytes saved."""
        hit = self.known.get(sentence)
        if hit is None:
            raw = _plain(sentence)
            if len(raw) < self.min_chars + 2:
                hit = (None, 0.0)
            else:
                sizes = [len(c.compress(raw)) for c in self.by]
                order = sorted(range(len(sizes)), key=sizes.__getitem__)
                best, second = sizes[order[0]], sizes[order[1]]
                weights = [2.0 ** (-1.0 * (s - best)) for s in sizes]
                ok = (second - best) >= self.margin * second
                hit = (self.langs[order[0]] if ok else None, 1.0 / sum(weights))
            if len(self.known) > 300_000:
                self.known.clear()
            self.known[sentence] = hit
        return hit

    def stretches(self, text: str) -> list[tuple[str, float, str]]:
        """``(language, confidence, text)`` of each longest stretch of one language.

        Rejected sentences go to the stretch before them (at the start: after
        them). A text without any sure sentence is judged as a whole, where
        ``whole_margin`` is enough; ``und`` where even that is missing or the
        text has no letters.
        """
        found: list[list] = []
        pending: list[str] = []
        for s in sentences(text):
            lang, conf = self.classify(s)
            if lang is None:
                if found:
                    found[-1][2].append(s)
                else:
                    pending.append(s)
            elif found and found[-1][0] == lang:
                found[-1][1].append((conf, len(s)))
                found[-1][2].append(s)
            else:
                found.append([lang, [(conf, len(s))], [*pending, s] if not found else [s]])
                pending = []
        if not found:
            raw = _plain(text)
            if len(raw) < 4:
                return [("und", 0.0, text)]
            sizes = [len(c.compress(raw)) for c in self.by]
            best, second = sorted(range(len(sizes)), key=sizes.__getitem__)[:2]
            conf = 1.0 / sum(2.0 ** (-1.0 * (s - sizes[best])) for s in sizes)
            sure = sizes[second] - sizes[best] >= max(1.0, self.whole_margin * sizes[second])
            return [(self.langs[best] if sure else "und", conf, text)]
        return [(lang, sum(c * n for c, n in cs) / max(1, sum(n for _, n in cs)), " ".join(ss)) for lang, cs, ss in found]


def train_dictionaries(labelled: DataFrame, text: str, tag: str, sample_per_language: int = 1500, dict_bytes: int = 96_000) -> dict[str, bytes]:
    """Raw-content dictionaries from at most ``sample_per_language`` texts each.

    The sample is the different texts with the smallest hashes, so it is the
    same in every run however often a text is copied; a dictionary takes their
    sentences in that order up to ``dict_bytes``. Labels may be wrong: only
    sentences whose words agree with their label enter. Without any labelled
    row the seed words remain.
    """
    tags = {v: k for k, line in _TAG_NAMES.items() for v in line.split()}
    first = F.element_at(F.split(F.lower(F.trim(F.translate(F.col(tag), "çáàâãéèêíóôõúñöüäÇÉ", "caaaaeeeiooounouaCE"))), r"[-_ (;,]"), 1)
    name = F.create_map(*[F.lit(x) for kv in tags.items() for x in kv])[first]
    picked = labelled.select(F.col(text).alias("t"), name.alias("lang")).where("t is not null and length(t) > 40 and lang is not null").distinct().withColumn("h", F.xxhash64("t"))
    # A threshold that twice the sample is expected to pass spares a global sort.
    counts = {r["lang"]: r["n"] for r in picked.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    below = F.lit(2**63 - 1)
    for lang, n in counts.items():
        below = F.when(F.col("lang") == lang, F.lit(min(2**63 - 1, 2**64 * (2 * sample_per_language + 100) // n - 2**63))).otherwise(below)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "t"))
    rows = picked.where(F.col("h") <= below).withColumn("rank", rank).where(F.col("rank") <= sample_per_language).select("lang", "t", "rank").collect()
    by: dict[str, list[str]] = {x: [] for x in LANGS}
    for r in sorted(rows, key=lambda r: (r["lang"], r["rank"])):
        by[r["lang"]].extend(sentences(r["t"]))

    def build(chosen: dict[str, list[str]]) -> dict[str, bytes]:
        out = {}
        for lang in LANGS:
            seen: set[bytes] = set()
            parts, size = [], 0
            for s in chosen[lang]:
                p = _plain(s)
                if p in seen or size > dict_bytes:
                    continue
                seen.add(p)
                parts.append(p)
                size += len(p)
            out[lang] = b"".join(parts) + _SEEDS[lang].encode()
        return out

    return build(_agreeing(by))


def _agreeing(by: dict[str, list[str]], rounds: int = 3) -> dict[str, list[str]]:
    """The sample's sentences whose words speak for their label.

    A single mislabelled sentence would let its whole language be written with
    the wrong dictionary, so labels are checked before by word frequencies per
    label, counted again over what is left after each round. Seed words count
    as one more sentence of their language.
    """
    left = {lang: [(s, _plain(s).decode().split()) for s in dict.fromkeys(ss)] for lang, ss in by.items()}
    for _ in range(rounds):
        counts = {lang: Counter(w for _, ws in left[lang] for w in set(ws)) for lang in left}
        for lang, c in counts.items():
            c.update(_SEEDS[lang].split())
        total = {lang: sum(c.values()) + 50.0 for lang, c in counts.items()}

        def best(ws: list[str]) -> str:
            return max(counts, key=lambda x: sum(math.log((counts[x][w] + 0.05) / total[x]) for w in ws))  # noqa: B023

        left = {lang: [(s, ws) for s, ws in ss if best(ws) == lang] for lang, ss in left.items()}
    return {lang: [s for s, _ in ss] for lang, ss in left.items()}


def language_segments(df: DataFrame, dictionaries: dict[str, bytes], key: str, text: str, tag: Column, field: str) -> DataFrame:
    """``field, rec_key, seg_no, lang, confidence, n_chars, n_segments, tag_lang``.

    One row per longest stretch of one language, ``seg_no`` from 1. Null and
    blank texts give no row; repeated rows are each answered. The dictionaries
    are of bounded size (``dict_bytes``) and travel with the function.
    """
    src = df.select(F.col(key).cast("string").alias("rec_key"), F.col(text).alias("text"), tag.cast("string").alias("tag")).where("text is not null and trim(text) <> ''")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Compressors(dictionaries)
        for pdf in batches:
            rows = []
            for k, t, g in zip(pdf["rec_key"], pdf["text"], pdf["tag"], strict=True):
                named = tag_language(g)
                segs = model.stretches(t)
                for i, (lang, conf, seg) in enumerate(segs, 1):
                    rows.append((field, k, i, lang, float(conf), len(seg), len(segs), named))
            yield pd.DataFrame(rows, columns=["field", "rec_key", "seg_no", "lang", "confidence", "n_chars", "n_segments", "tag_lang"])

    return src.mapInPandas(run, "field string, rec_key string, seg_no int, lang string, confidence double, n_chars int, n_segments int, tag_lang string")


def wrong_labels(segments: DataFrame) -> DataFrame:
    """Segments of texts whose tag is missing, names no or another language, or that mix languages."""
    return segments.where("lang <> 'und' and (n_segments > 1 or tag_lang is null or tag_lang <> lang)")

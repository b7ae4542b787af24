"""Template residue and error-page text (problem 4).

A regularised linear classifier on hashed word n-grams, length and title
features judges every sentence of a value; a value is marked if one sentence
is. Weak labels come from phrases and from the response status of the record;
the model is validated on hosts that it has not seen.
"""

from __future__ import annotations

import re
import re._parser as sre
from collections.abc import Iterator
from functools import lru_cache, reduce

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernstone.llm.linear import bag_probability, fit, hashed, pack
from quernstone.llm.skeleton import folded
from quernstone.session import materialize, release

BITS = 18

_PLACEHOLDER = re.compile(
    r"\{\{\s*[\w.]+\s*\}\}|[$#]?\{[\w.]+\}|<%=?\s*[\w.]+\s*%>|\[%\s*[\w.]+\s*%\]|\[\[\s*[\w.]+\s*\]\]|<<\s*[\w.]+\s*>>"
    r"|&lt;\s*[\w.]+\s*&gt;|<[A-Za-z_]\w*>|@@[\w.]+@@|__[A-Za-z][\w.]*?__|%[A-Za-z_][\w.]*%|\$[A-Za-z_][\w.]*\$"
)

# Phrases that only such text uses (accents removed, lower case).
_PHRASES = [
    # scripts and browser checks
    r"(veuillez )?activer? javascript", r"active javascript", r"enable javascript", r"ative o javascript", r"aktivieren sie javascript",
    r"javascript (is|must be) (required|enabled|disabled)", r"(besoin|precisa|necesita) (de )?scripts", r"requires (scripts|javascript)", r"skripte benotigt",
    r"scripts may be blocked", r"turn them on in your browser", r"reglages de votre navigateur", r"verification de votre navigateur",
    r"checking (that )?your browser", r"comprobando su navegador", r"a verificar o seu navegador", r"browser wird (gepruft|uberpruft)", r"loading viewer",
    # error pages
    r"\b(erreur|error|fehler|erro) [45]\d\d ?:", r"^[45]\d\d (not found|forbidden|bad gateway|service unavailable|gone)", r"^(acces refuse|access denied|acceso denegado|acesso negado|zugriff verweigert)\.?$",
    r"vous n.avez pas l.autorisation", r"no tiene permiso", r"nao tem permissao", r"you do not have permission", r"keine berechtigung",
    r"momentanement indisponible", r"service unavailable", r"temporariamente indisponivel", r"temporalmente (no )?disponible", r"vorubergehend nicht verfugbar",
    r"delai d.attente depasse", r"gateway time-?out", r"internal server error", r"down for maintenance", r"request was blocked", r"request id\b",
    r"reference de la requete", r"vorgangsnummer", r"(document|page) (requested )?(was )?not found on this server", r"can.t seem to find the page",
    r"document n.existe plus", r"documento ya no esta disponible", r"merci de reessayer", r"try again later", r"bitte spater erneut", r"retour a l.accueil",
    # unfilled text
    r"votre texte ici", r"your text here", r"(escriba )?su texto aqui", r"o seu texto aqui", r"ihr text hier", r"inserer ici", r"insert \w+ here", r"inserte aqui",
    r"insira aqui", r"hier zusammenfassung", r"cliquez pour ajouter", r"click to add", r"durch klicken hinzufugen", r"haga clic para", r"clique para",
    r"texte d.exemple", r"sample text", r"texto de (ejemplo|exemplo)", r"blindtext", r"\[resume a completer\]", r"\[resum\w+ (por preencher|pendiente)\]", r"^todo\b", r"\[text folgt\]", r"goes here", r"xxxx",
    r"titre ici", r"enter a short description", r"description du document\)",
    r"^(sans titre|untitled( document)?|ohne titel|sin titulo|sem titulo|titre du document|document title|new document|nouveau document|titulo del documento|neues dokument|novo documento|\[?titre\]?|title|titre)([-_ ]?\d+)?$",
    # filler
    r"lorem ipsum|ipsum lorem|dolor sit amet",
]


def _literal(pattern: str) -> str:
    """The longest text that every match of a pattern holds."""
    runs, run = [""], ""
    for op, arg in sre.parse(pattern):
        run = run + chr(arg) if op is sre.LITERAL else ""
        runs.append(run)
    return max(runs, key=len)


#: Phrases with what to look for before the pattern is tried, and those without such a text.
_HINTED = [(h, re.compile(p)) for p in _PHRASES if len(h := _literal(p)) > 2]
_PLAIN = re.compile("|".join(f"(?:{p})" for p in _PHRASES if len(_literal(p)) <= 2))


@lru_cache(maxsize=1)
def _hints() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for h in {h for h, _ in _HINTED}:
        found.add_word(h, [p for k, p in _HINTED if k == h])
    found.make_automaton()
    return found


def phrase(text: str) -> str | None:
    """The pattern of the first phrase found in a prepared text; None without one."""
    for _, ps in _hints().iter(text):
        for p in ps:
            if p.search(text):
                return p.pattern
    found = _PLAIN.search(text)
    return found and f"plain {found[0]}"


def strong(text: str) -> bool:
    """Whether a prepared text holds one of the phrases."""
    return phrase(text) is not None


# Words of the usual Latin filler.
_FILLER = set("lorem ipsum dolor sit amet consectetur adipiscing elit sed eiusmod tempor incididunt labore dolore magna aliqua viverra porta cursus ornare vestibulum sagittis pretium bibendum lacinia pharetra tellus quisque fringilla mauris aliquam vivamus nulla vitae".split())

# Words that error pages share with texts about them.
_SOFT = re.compile(r"\b(error|erreur|fehler|erro|refuse|denied|denegado|negado|verweigert|indisponible|unavailable|javascript|script|navigateur|browser|navegador|not found|introuvable|404|403|500|502|503)\b")


_SPLIT = re.compile(r"(?<=[.!?…])\s+|\n+")


#: What a placeholder begins with.
_OPENS = re.compile(r"[{<\[&@_%$]")
_WORD = re.compile(r"\w+")
_UNIT = re.compile(r"\w+|[\[\](){}…:]")


def segments(value: str) -> list[str]:
    """Sentences, and every placeholder once more by itself."""
    named = _PLACEHOLDER.findall(value) if _OPENS.search(value) else []
    return [s for s in (x.strip() for x in _SPLIT.split(value)) if s] + named or [value]


@lru_cache(maxsize=50_000)
def prepare(segment: str) -> str:
    """Folded text in which every placeholder is the word ``phphph``."""
    return folded(_PLACEHOLDER.sub(" phphph ", segment) if _OPENS.search(segment) else segment).strip()


def weak_label(seg: str, status_error: bool, title: bool = False) -> int | None:
    """1 residue, 0 content, None no opinion."""
    text = prepare(seg)
    words = _WORD.findall(text)
    if "phphph" in words or strong(text) or sum(map(_FILLER.__contains__, words)) >= 3:
        return 1
    if _SOFT.search(text):
        if len(words) >= (4 if title else 8):
            return 0
        return 1 if status_error and len(words) <= 4 else None
    return 0


def kind(seg: str) -> str:
    """What makes a sentence residue, with its length: each kind has its share of the sample.

    Filler and reference numbers make ever new sentences; a fixed sentence is
    one, however often it occurs.
    """
    text = prepare(seg)
    words = _WORD.findall(text)
    why = phrase(text) or ("placeholder" if "phphph" in words else "filler" if sum(map(_FILLER.__contains__, words)) >= 3 else "status")
    return f"{why} {min(len(words), 8)}"


@lru_cache(maxsize=200_000)
def _word_ids(w: str) -> tuple[int, ...]:
    return (hashed(f"u {w}", BITS), hashed(f"c {w[:5]}", BITS)) if len(w) > 5 else (hashed(f"u {w}", BITS),)


@lru_cache(maxsize=200_000)
def _pair_id(a: str, b: str) -> int:
    return hashed(f"b {a} {b}", BITS)


@lru_cache(maxsize=1000)
def _other_id(name: str) -> int:
    return hashed(name, BITS)


def features(seg: str, whole: bool, title: bool) -> list[int]:
    """Hashed uni- and bigrams, word beginnings, length and title features of one sentence."""
    words = _UNIT.findall(prepare(seg))
    words = [("0s" if len(w) == 3 and w[0] in "45" else "0d") if w.isdigit() else w for w in words]
    out = {f for w in words for f in _word_ids(w)}
    out.update(map(_pair_id, words, words[1:]))
    n = len(words)
    out.add(_other_id(f"n {min(n, 24) // 3}"))
    if title:
        out.add(_other_id(f"t whole {whole} {min(n, 6)}"))
    elif whole:
        out.add(_other_id(f"s whole {min(n, 24) // 6}"))
    if title and n and (words[-1] in ("pdf", "doc", "docx", "indd", "qxp", "odt") or "_" in seg or re.fullmatch(r"[\w-]+", seg.strip())) and "phphph" not in words and not re.search(r"\s", seg.strip()):
        out.add(_other_id("t file"))
    return sorted(out)


class Residue:
    """Trained model; ``scores`` gives the highest sentence probability of each value."""

    def __init__(self, w: np.ndarray, bias: float, threshold: float = 0.5):
        self.w, self.bias, self.threshold = w, bias, threshold

    def scores(self, values: list[str], titles: list[bool]) -> np.ndarray:
        """All sentences of a batch at once, as one sparse product."""
        flat: list[int] = []
        ptr, ends, seen = [0], [], {}
        rows: list[int] = []
        for v, t in zip(values, titles, strict=True):
            parts = segments(v)
            for s in parts:
                key = (s, len(parts) == 1, t)
                at = seen.get(key)
                if at is None:
                    at = seen[key] = len(ptr) - 1
                    flat.extend(features(*key))
                    ptr.append(len(flat))
                rows.append(at)
            ends.append(len(rows))
        n = np.diff(ptr)
        total = np.add.reduceat(self.w[np.array(flat, np.int64)].astype(np.float64), ptr[:-1]) if flat else np.empty(0)
        p = 1.0 / (1.0 + np.exp(-np.clip(total / np.sqrt(n) + self.bias, -50.0, 50.0)))
        return np.maximum.reduceat(p[rows], [0, *ends[:-1]]) if rows else np.empty(0)

    def score(self, value: str, title: bool) -> float:
        return float(self.scores([value], [title])[0])


def _values(df: DataFrame, key: str, fields: dict[str, tuple[Column, bool]], status: Column, url: Column) -> DataFrame:
    items = F.array(*[F.struct(F.lit(n).alias("field"), c.cast("string").alias("value"), F.lit(t).alias("title")) for n, (c, t) in fields.items()])
    return (
        df.select(F.col(key).cast("string").alias("rec_key"), status.cast("string").alias("status"), url.cast("string").alias("url"), F.explode(items).alias("v"))
        .select("rec_key", "status", F.expr("lower(try_parse_url(url, 'HOST'))").alias("host"), "v.field", "v.value", "v.title")
        .where("value is not null and trim(value) <> ''")
    )


def train_residue(
    df: DataFrame, key: str, fields: dict[str, tuple[Column, bool]], status: Column, url: Column, sample: int = 15_000, held_out: float = 0.2
) -> tuple[Residue, dict[str, float]]:
    """Model and its measures on unseen hosts.

    The training set is at most ``sample`` distinct sentences of each stratum
    (residue, its kinds in turn; titles and sentences that share words with
    it; all others; those with the smallest hashes) from ``1 - held_out`` of the hosts;
    sentences of the other hosts measure a first model; the model
    that is given back is then fitted to all of them. Counting and labelling run over
    all rows on the executors.
    """
    vals = _values(df, key, fields, status, url)

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[tuple[str, bool, bool], int | None] = {}
        for pdf in batches:
            rows = []
            for st, host, value, title in zip(pdf["status"], pdf["host"], pdf["value"], pdf["title"], strict=True):
                err = bool(st) and bool(re.match(r"http_[45]", st))
                parts = segments(value)
                test = hashed(host or "", 10) < held_out * 1024
                for s in parts:
                    k = (s, err, title)
                    if k not in known:
                        if len(known) > 200_000:
                            known.clear()
                        known[k] = weak_label(s, err, title)
                    if known[k] is not None:
                        stratum = 0 if known[k] else (1 if title or len(s) < 60 or _SOFT.search(folded(s)) else 2)
                        rows.append((s, len(parts) == 1, title, known[k], stratum, test, "" if stratum else kind(s)))
            yield pd.DataFrame(rows, columns=["seg", "whole", "title", "y", "stratum", "test", "kind"]).drop_duplicates()

    labelled = vals.mapInPandas(label, "seg string, whole boolean, title boolean, y int, stratum int, test boolean, kind string")
    distinct = labelled.groupBy("seg", "whole", "title", "y").agg(F.min("stratum").alias("stratum"), F.min("test").alias("test"), F.min("kind").alias("kind"), F.xxhash64("seg").alias("h"))
    distinct = materialize(distinct, "weak")
    turn = F.row_number().over(Window.partitionBy("kind", "whole", "title").orderBy("h", "seg"))
    found = distinct.where("stratum = 0").withColumn("turn", turn).where(F.col("turn") <= sample).orderBy("turn", "h", "seg", "whole", "title").limit(sample).drop("turn")
    got = reduce(DataFrame.unionByName, [found, *[distinct.where(F.col("stratum") == k).orderBy("h", "seg", "whole", "title").limit(sample) for k in (1, 2)]])
    rows = got.toPandas().sort_values(["h", "seg", "whole", "title", "y"])
    release(distinct)
    feats = [[features(s, w, t)] for s, w, t in zip(rows["seg"], rows["whole"], rows["title"], strict=True)]
    y = rows["y"].to_numpy(float)
    test = rows["test"].to_numpy(bool)
    if not len(rows) or y.sum() == 0:
        return Residue(np.zeros(1 << BITS, np.float32), -9.0), {"n_train": float(len(rows))}
    fit_on = [i for i in range(len(rows)) if not test[i]] or list(range(len(rows)))
    settings = {"l2": 1e-6, "rounds": 150, "bias": -3.0, "balance": False}
    w, bias = fit(pack([feats[i] for i in fit_on], [y[i] for i in fit_on]), BITS, **settings)
    measures = {"n_train": float(len(fit_on)), "n_test": float(test.sum())}
    if test.any():
        p = bag_probability(pack([feats[i] for i in np.flatnonzero(test)], list(y[test])), w, bias)
        hit = p >= 0.5
        measures |= {"recall": float(hit[y[test] > 0].mean()) if (y[test] > 0).any() else 1.0, "false_rate": float(hit[y[test] == 0].mean()) if (y[test] == 0).any() else 0.0}
    if test.any():  # measured; the model in use learns from all hosts
        w, bias = fit(pack(feats, list(y)), BITS, **settings)
    return Residue(w, bias), measures


def mark_residue(df: DataFrame, model: Residue, key: str, fields: dict[str, tuple[Column, bool]]) -> DataFrame:
    """``rec_key, field, score, is_residue`` for every value that is not blank.

    Null and blank values give no row, repeated rows are each judged, a long
    value is judged sentence by sentence to its end.
    """
    w, bias, threshold = model.w, model.bias, model.threshold
    vals = _values(df, key, fields, F.lit(None), F.lit(None)).select("rec_key", "field", "value", "title")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = Residue(w, bias, threshold)
        for pdf in batches:
            score = m.scores(pdf["value"].tolist(), pdf["title"].tolist())
            yield pd.DataFrame({"rec_key": pdf["rec_key"], "field": pdf["field"], "score": score, "is_residue": score >= threshold})

    return vals.mapInPandas(run, "rec_key string, field string, score double, is_residue boolean")

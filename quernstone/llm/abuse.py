"""Abusive, hateful or sexual content (problem 9).

Multiple-instance learning: a document is a bag of sentences. Sentence scores,
combined by noisy-or, are trained from document labels alone; afterwards they
locate the offending sentences.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.llm.linear import Bags, fit, hashed
from quernstone.llm.skeleton import folded
from quernstone.session import materialize

BITS = 17

#: Shares of positive and of negative labels taken to be wrong.
WRONG_POSITIVE, MISSED = 0.1, 0.004

#: Ridge penalty.
L2 = 3e-5

_LEET = str.maketrans("01345780@$|", "oieastbo" + "asl")
_SPACED = re.compile(r"\b[a-z](?:[ .\-_][a-z]){2,}\b")
_REPEAT = re.compile(r"([a-z])\1{2,}")
_SENTENCE = re.compile(r"(?<=[.!?…])\s+|\n+")
_WORDS = re.compile(r"[a-z0-9@$*|]+")
_UNUSUAL = re.compile(r"[^\x00-\u017f‘’“”„–—…]")


def fold_text(text: str) -> str:
    """Lower case without accents; letters that only look Latin become Latin."""
    if _UNUSUAL.search(text):
        text = folded(text)
    text = text.replace("’", "'").replace("ß", "ss").replace("œ", "oe")
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode().lower()


class Spelling(dict):
    """Token → word: masked spellings written out.

    Letters repeated three times or more become one, digits and signs inside
    words become letters, a word with stars becomes ``first#last``, a number
    ``0``. Most texts repeat their tokens, so each is worked out once.
    """

    def __missing__(self, token: str) -> str:
        if len(self) > 400_000:
            self.clear()
        w = token
        letters = sum(c.isalpha() for c in w)
        stars = w.strip("*|")
        if w.isdigit():
            w = "0"
        elif "*" in stars and letters:
            w = f"{stars[0]}#{stars[-1]}"
        elif letters and letters < len(w) and not re.fullmatch(r"\d+[a-z]{1,3}|[a-z]\d+", w):
            w = w.translate(_LEET).strip("*|")
        out = self[token] = _REPEAT.sub(r"\1", w)
        return out


def tokens_of(text: str) -> list[list[str]]:
    """Tokens of each sentence; spaced and dotted letters are joined."""
    plain = _SPACED.sub(lambda m: re.sub(r"[ .\-_]", "", m[0]), fold_text(text))
    return [ts for ts in map(_WORDS.findall, _SENTENCE.split(plain)) if ts]


def word_features(w: str) -> list[int]:
    """The word, its beginning and its ending, so that inflected forms share weights; masked spelling.

    Beginnings under five letters join what reports and abuse must not share.
    """
    out = [hashed(f"u {w}", BITS)]
    if len(w) > 5:
        out.append(hashed(f"c {w[:5]}", BITS))
    if len(w) > 6:
        out.append(hashed(f"e {w[-4:]}", BITS))
    if "#" in w:
        out.append(hashed("masked", BITS))
    return out


def pair_feature(a: str, b: str) -> int:
    return hashed(f"b {a} {b}", BITS)


def divisor(n_words: int) -> float:
    return math.sqrt(n_words + 4.0)


class AbuseModel:
    """Weights with the caches a worker needs; ``sentence`` gives a logit."""

    def __init__(self, w: np.ndarray, bias: float):
        self.w, self.bias = w, bias
        model, spelled = self, Spelling()

        class Words(dict):
            def __missing__(self, k: str) -> float:
                if len(self) > 400_000:
                    self.clear()
                v = self[k] = float(sum(model.w[f] for f in word_features(spelled[k])))
                return v

        class Pairs(dict):
            def __missing__(self, k: tuple[str, str]) -> float:
                if len(self) > 1_000_000:
                    self.clear()
                v = self[k] = float(model.w[pair_feature(spelled[k[0]], spelled[k[1]])])
                return v

        self.words, self.pairs = Words(), Pairs()

    def sentence(self, ws: list[str]) -> float:
        s = sum(map(self.words.__getitem__, ws)) + sum(map(self.pairs.__getitem__, zip(ws, ws[1:], strict=False)))
        return s / math.sqrt(len(ws) + 4.0) + self.bias

    def document(self, text: str) -> tuple[float, float, int, int]:
        """``(score, highest sentence score, its position, offending sentences)``."""
        q, top, at, n = 0.0, -99.0, -1, 0
        for i, ws in enumerate(tokens_of(text)):
            s = self.sentence(ws)
            if s > -12.0:
                q += math.log1p(math.exp(min(s, 30.0)))
            n += s >= 0.0
            if s > top:
                top, at = s, i
        return -math.expm1(-q), 1.0 / (1.0 + math.exp(-max(top, -60.0))), at, n


def train_abuse(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", max_positive: int = 4000, max_negative: int = 3000, max_chars: int = 60_000_000, rounds: int = 120) -> AbuseModel:
    """Model from at most ``max_positive`` and ``max_negative`` reviewed documents.

    Several reviews of a document vote; ties are left out. The sample is the
    documents with the smallest hashes of their key, as many as have
    ``max_chars`` characters together. Without labels of both kinds every
    document scores 0.
    """
    votes = labels.where(f"{key} is not null and toxic is not null").groupBy(key).agg(F.avg(F.col("toxic").cast("double")).alias("y")).where("y <> 0.5")
    order = [F.xxhash64(key), F.col(key)]
    pos = votes.where("y > 0.5").orderBy(*order).limit(max_positive)
    neg = votes.where("y < 0.5").orderBy(*order).limit(max_negative)
    chosen = pos.unionByName(neg)  # at most max_positive + max_negative rows
    found = docs.select(key, text).where(F.col(text).isNotNull()).join(F.broadcast(chosen), key).select(key, text, "y").dropDuplicates([key])
    found = materialize(found.withColumn("h", F.xxhash64(key)).withColumn("size", F.length(text)), "reviewed")
    size = found.select("h", key, "size").toPandas().sort_values(["h", key])
    within = size[size["size"].cumsum() <= max_chars]
    last = within["h"].max() if len(within) < len(size) and len(within) else None
    rows = (found if last is None else found.where(F.col("h") <= int(last))).select(key, text, "y").toPandas().sort_values(key)
    y = (rows["y"].to_numpy(float) > 0.5).astype(float) if len(rows) else np.empty(0)
    if not y.sum() or y.sum() == len(y):
        return AbuseModel(np.zeros(1 << BITS, np.float32), -30.0)
    spelled = Spelling()
    cache: dict[str, list[int]] = {}
    flat: list[int] = []
    indptr, bag_ptr, scale = [0], [0], []
    for t in rows[text]:
        for ts in tokens_of(t) or [[]]:
            ws = [spelled[x] for x in ts]
            for w in ws:
                if w not in cache:
                    cache[w] = word_features(w)
                flat.extend(cache[w])
            flat.extend(pair_feature(a, b) for a, b in zip(ws, ws[1:], strict=False))
            indptr.append(len(flat))
            scale.append(divisor(len(ws)))
        bag_ptr.append(len(scale))
    bags = Bags(np.array(flat, np.int64), np.array(indptr), np.array(bag_ptr), y, np.array(scale))
    w, bias = fit(bags, BITS, l2=L2, rounds=rounds, rate=0.1, bias=-6.0, smooth=WRONG_POSITIVE, missed=MISSED, balance=False, gain=_gain(bags))
    return AbuseModel(w, bias)


def _gain(bags: Bags) -> np.ndarray:
    """1 for features that no inoffensive document has, less the more have them.

    Words of the everyday text are in many documents that were found
    inoffensive; they must not explain a document that a reviewer marked by
    mistake.
    """
    clean = np.flatnonzero(bags.y == 0)
    lo, hi = bags.indptr[bags.bag_ptr[clean]], bags.indptr[bags.bag_ptr[clean + 1]]
    df = np.zeros(1 << BITS)
    for a, b in zip(lo, hi, strict=True):
        df[np.unique(bags.idx[a:b])] += 1
    return 1.0 / (1.0 + df / (1.0 + 0.002 * len(clean)))


def score_documents(docs: DataFrame, model: AbuseModel, key: str = "doc_id", text: str = "text", source: str = "source", threshold: float = 0.25, sentence_threshold: float = 0.25) -> DataFrame:
    """``key, source, score, top_sentence, sentence_no, n_offending, flagged``.

    One row per document; null and empty texts score 0. A document is flagged
    if its noisy-or score reaches ``threshold`` and a sentence can be shown
    that reaches ``sentence_threshold``; whole texts are read.
    """
    w, bias = model.w, model.bias
    src = docs.select(F.col(key).alias("doc_key"), F.col(source).cast("string").alias("source"), F.col(text).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = AbuseModel(w, bias)
        for pdf in batches:
            got = [m.document(t) if t else (0.0, 0.0, -1, 0) for t in pdf["text"]]
            out = pd.DataFrame(got, columns=["score", "top_sentence", "sentence_no", "n_offending"])
            out.insert(0, "doc_key", pdf["doc_key"].to_numpy())
            out.insert(1, "source", pdf["source"].to_numpy())
            out["flagged"] = (out["score"] >= threshold) & (out["top_sentence"] >= sentence_threshold)
            yield out

    kind = dict(src.dtypes)["doc_key"]
    return src.mapInPandas(run, f"doc_key {kind}, source string, score double, top_sentence double, sentence_no int, n_offending int, flagged boolean").withColumnRenamed("doc_key", key)


def rates(scored: DataFrame) -> DataFrame:
    """Documents, flagged documents and their share per source."""
    return scored.groupBy("source").agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum(F.col("flagged").cast("long")).alias("flagged"),
        F.round(F.avg(F.col("flagged").cast("double")), 6).alias("rate"),
    )

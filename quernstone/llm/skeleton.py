"""Skeletons of texts: equal for texts that look the same.

``skeleton`` decomposes a text, replaces every character by its prototype from
a look-alike table (nothing, for characters that show nothing) and decomposes
again. The table holds the forms that Unicode itself calls variants in width,
font, position or ligature of other characters, and letters of other scripts.
Raised, lowered, circled and fraction forms show something else and stay, as
do case, accents and words, so texts that differ visibly keep different
skeletons.
"""

from __future__ import annotations

import os
import re
import sys
import unicodedata
from functools import lru_cache

# Characters of other scripts, and below them the ones they look like (after the public Unicode list of confusables).
_LOOKALIKES = [
    # Cyrillic
    ("аеіјорсухѕһԁԛԝзӏ", "aeijopcyxshdqw3l"),
    ("АВЕІЈКМНОРСТУХЅҺԌԚԜ", "ABEIJKMHOPCTYXSHGQW"),
    ("ѵҮүԍ", "vYyg"),
    ("вмтнкпгя", "ʙᴍᴛʜĸnrᴙ"),
    # Greek
    ("ονιυραϲϳγ", "ovıupacjy"),
    ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "ABEZHIKMNOPTYX"),
    ("κτ", "ĸᴛ"),
    # Coptic
    ("ⲂⲎⲒⲔⲘⲚⲞⲢⲤⲦⲨⲬⲟⲣⲥ", "BHIKMNOPCTYXopc"),
    # Cherokee
    ("ᎠᎡᎢᎪᎫᎬᎳᎷᎻᎽᏀᏃᏎᏏᏒᏔᏕᏙᏚᏞᏟᏢᏦᏧᏴ", "DRTAJEWMHYGZ4bRWSVSLCPKdB"),
    # Lisu
    ("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEOU"),
    # Armenian
    ("օոսհցքզյՏՍՕՈ", "onuhgpqjSUOU"),
    # Latin letters and signs that stand for others
    ("ıȷɑɡʋɩℓᴋ", "ijagvilĸ"),
    ("‐‒−⁃﹘", "-----"),
    ("ʼʹ＇′ꞌ", "’’’’’"),
    ("ʺˮ", '""'),
    ("ꓲⅼ∣", "lll"),
]

# Marks in use as one letter's own (they show nothing apart from it).
_INVISIBLE_EXTRA = "ᅟᅠㅤﾠ͏឴឵᠎⠀"

# Compatibility forms that look like what they stand for.
_SAME_LOOK = ("<wide>", "<narrow>", "<noBreak>", "<font>", "<compat>", "<small>", "<initial>", "<medial>", "<final>", "<isolated>")


def _listed(path: str) -> dict[int, str]:
    """Pairs of a list of confusables in the format that Unicode publishes.

    Digits and the letters l, I and O are left as they are: they are told
    apart in print.
    """
    out: dict[int, str] = {}
    with open(path, encoding="utf-8-sig") as f:
        for line in f:
            parts = line.partition("#")[0].split(";")
            if len(parts) >= 2:
                odd, plain = (("".join(chr(int(x, 16)) for x in p.split())) for p in parts[:2])
                if len(odd) == 1 and not odd.isascii():
                    out[ord(odd)] = plain
    return out


@lru_cache(maxsize=1)
def char_table() -> dict[int, str | None]:
    """Code point → prototype, for ``str.translate``; None drops the character.

    ``QUERNSTONE_CONFUSABLES`` may name a file with the full public list, to be
    found under the same path on every executor; it adds to the table.
    """
    known: dict[int, str] = {}
    if path := os.environ.get("QUERNSTONE_CONFUSABLES"):
        known.update(_listed(path))
    for odd, plain in _LOOKALIKES:
        known.update((ord(a), "i" if b == "ı" else b) for a, b in zip(odd, plain, strict=True))
    table: dict[int, str | None] = dict(known)
    for cp in range(sys.maxunicode + 1):
        c = chr(cp)
        kind = unicodedata.category(c)
        if kind == "Cf" or c in _INVISIBLE_EXTRA or 0xFE00 <= cp <= 0xFE0F or 0xE0100 <= cp <= 0xE01EF:
            table[cp] = None
        elif kind in ("Zs", "Zl", "Zp") and c != " ":
            table[cp] = " "
        elif kind == "Cc" and c not in "\n\t\r":
            table[cp] = None
        elif cp not in known and unicodedata.decomposition(c).startswith(_SAME_LOOK):
            table[cp] = unicodedata.normalize("NFKD", c).translate(known)
    return table


@lru_cache(maxsize=1)
def _in_table() -> re.Pattern:
    """Any character that the table may change; looking for one is cheaper than translating all.

    The first class ends at U+FFFF, as larger ones are searched one by one.
    """
    return re.compile("[" + "".join(f"\\u{cp:04x}" for cp in char_table() if cp < 0x10000) + "]|[\\U00010000-\\U0010ffff]")


_CONTROL = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")


def _replaced(text: str, form: str) -> str:
    plain = unicodedata.normalize(form, text)
    if _in_table().search(plain):
        plain = unicodedata.normalize(form, plain.translate(char_table()))
    return plain


def skeleton(text: str | None) -> str | None:
    """The skeleton; null stays null, an empty text stays empty."""
    if text is None:
        return None
    return _CONTROL.sub("", text) if text.isascii() else _replaced(text, "NFD")


@lru_cache(maxsize=1)
def _no_letters() -> dict[int, str | None]:
    """The table without letters of other scripts."""
    return {cp: v for cp, v in char_table().items() if v is None or not chr(cp).isalpha() or unicodedata.decomposition(chr(cp)).startswith("<")}


def canonical(text: str | None) -> str | None:
    """The one consistent form of a text: skeleton characters, composed again.

    Letters of foreign scripts become Latin only inside words that are mostly
    Latin otherwise, so that a Greek or Cyrillic word stays what it is.
    """
    if text is None:
        return None
    if text.isascii():
        return _CONTROL.sub("", text)
    table = char_table()
    plain = unicodedata.normalize("NFC", unicodedata.normalize("NFC", text).translate(_no_letters()))

    def word(m: re.Match) -> str:
        w = m[0]
        if w.isascii():
            return w
        latin = sum(1 for c in w if "LATIN" in unicodedata.name(c, ""))
        foreign = [c for c in w if c.isalpha() and "LATIN" not in unicodedata.name(c, "")]
        if not foreign or latin < len(foreign) or any(ord(c) not in table for c in foreign):
            return w
        return w.translate(table)

    return unicodedata.normalize("NFC", re.sub(r"\w+", word, plain))


_MARKS = re.compile(r"[̀-ͯ᪰-᫿᷀-᷿⃐-⃿]+")


def folded(text: str) -> str:
    """Skeleton without case, accents and raised forms, for comparing words."""
    if text.isascii():
        return text.lower()
    t = _MARKS.sub("", _replaced(text, "NFKD")).lower()
    return t.replace("ß", "ss").replace("œ", "oe").replace("æ", "ae")


_WORD = re.compile(r"\w+")


def folded_words(text: str | None) -> list[str]:
    return _WORD.findall(folded(text)) if text else []

"""Date and time strings: every reading that one string allows.

``readings(raw)`` returns a list of ``(format, normal form)``. The normal form
of a moment is ``yyyy-MM-ddTHH:mm:ssZ`` in UTC; of a value without time of day
``yyyy-MM-dd``, ``yyyy-MM`` or ``yyyy``. Wall times without a zone are read in
``zone``; a wall time that occurs twice is its first occurrence, a skipped one
keeps the offset valid before the change (``fold=0``).
"""

from __future__ import annotations

import re
import unicodedata
from datetime import UTC, date, datetime, timedelta, timezone
from functools import lru_cache
from zoneinfo import ZoneInfo

# Month names of fr, en, es, de, pt (accents removed), January first.
MONTH_NAMES = [
    "janvier janv jan january enero ene januar jaenner janeiro",
    "fevrier fevr fev february feb febrero februar fevereiro",
    "mars mar march marzo maerz marz mrz marco",
    "avril avr april apr abril abr",
    "mai may mayo maio",
    "juin june jun junio juni junho",
    "juillet juil july jul julio juli julho",
    "aout august aug agosto ago ag",
    "septembre sept sep september septiembre setiembre setembro set",
    "octobre oct october octubre oktober okt outubro out",
    "novembre nov november noviembre novembro",
    "decembre dec december diciembre dic dezember dez dezembro",
]
MONTHS = {name: i + 1 for i, line in enumerate(MONTH_NAMES) for name in line.split()}

# Zone abbreviations, offset in minutes.
ZONES = {"z": 0, "utc": 0, "gmt": 0, "ut": 0, "wet": 0, "west": 60, "bst": 60, "cet": 60, "cest": 120, "mez": 60, "mesz": 120, "eet": 120, "eest": 180, "est": -300, "edt": -240, "cst": -360, "cdt": -300, "pst": -480, "pdt": -420}

_TZ = r"\s*(?P<tz>z|utc|gmt|ut|we?s?t|bst|cet|cest|mez|mesz|eest|eet|est|edt|cst|cdt|pst|pdt|(?:gmt|utc)?[+-]\d{2}:?(?:\d{2})?)?"
_TIME = r"(?P<h>\d{1,2})[:h-](?P<mi>\d{2})(?:[:-](?P<s>\d{2})(?:[.,]\d+)?)?"
_DAYNAME = r"(?:[a-z]{2,10}\.?,?\s+)?"
_MON = r"(?P<mon>[a-z]{3,10})\.?"
_AMPM = r"(?:\s*(?P<ap>[ap])\.?m\.?)?"
_AT = r"(?:,?\s*(?:a las|as|a|at|um|-)?\s+)"

_PATTERNS: list[tuple[str, re.Pattern]] = [
    (name, re.compile(text))
    for name, text in [
        ("iso", rf"(?P<y>\d{{4}})-(?P<m>\d\d)-(?P<d>\d\d)(?:[t_ ]{_TIME}{_TZ})?"),
        ("iso_month", r"(?P<y>\d{4})-(?P<m>\d\d)"),
        ("year", r"(?P<y>\d{4})"),
        ("year_first", rf"(?P<y>\d{{4}})[/.](?P<m>\d{{1,2}})[/.](?P<d>\d{{1,2}})(?:[t_ ]{_TIME}{_AMPM}{_TZ})?"),
        ("compact_sep", r"(?P<y>\d{4})(?P<m>\d\d)(?P<d>\d\d)[_t -](?P<h>\d\d):?(?P<mi>\d\d):?(?P<s>\d\d)?(?P<tz>z|[+-]\d\d:?\d\d)?"),
        ("compact14", r"(?P<y>\d{4})(?P<m>\d\d)(?P<d>\d\d)(?P<h>\d\d)(?P<mi>\d\d)(?P<s>\d\d)(?P<tz>z)?"),
        ("compact12", r"(?P<y>\d{4})(?P<m>\d\d)(?P<d>\d\d)(?P<h>\d\d)(?P<mi>\d\d)"),
        ("compact8", r"(?P<y>\d{4})(?P<m>\d\d)(?P<d>\d\d)"),
        ("compact8_day_first", r"(?P<d>\d\d)(?P<m>\d\d)(?P<y>\d{4})"),
        ("pdf", r"d:(?P<y>\d{4})(?:(?P<m>\d\d)(?:(?P<d>\d\d)(?:(?P<h>\d\d)(?:(?P<mi>\d\d)(?P<s>\d\d)?)?)?)?)?(?P<tz>z|[+-]\d\d'?:?(?:\d\d)?)?(?:00)?[\d']*"),
        ("day_first", rf"(?P<d>\d{{1,2}})(?P<sep>[/.-])(?P<m>\d{{1,2}})(?P=sep)(?P<y>\d{{4}})(?:{_AT}{_TIME}{_AMPM}{_TZ})?"),
        ("month_first", rf"(?P<m>\d{{1,2}})(?P<sep>[/.-])(?P<d>\d{{1,2}})(?P=sep)(?P<y>\d{{4}})(?:{_AT}{_TIME}{_AMPM}{_TZ})?"),
        ("month_year", r"(?P<m>\d{1,2})[/.-](?P<y>\d{4})"),
        ("day_name_month", rf"{_DAYNAME}(?:le\s+)?(?P<d>\d{{1,2}})(?:er|\.|º|st|nd|rd|th)?[\s-]+(?:de\s+|of\s+)?{_MON}[\s,-]+(?:de\s+|del\s+)?(?P<y>\d{{4}})(?:{_AT}{_TIME}{_AMPM}{_TZ})?"),
        ("name_month_day", rf"{_DAYNAME}{_MON}\s+(?P<d>\d{{1,2}})(?:st|nd|rd|th)?,?\s+(?P<y>\d{{4}})(?:{_AT}{_TIME}{_AMPM}{_TZ})?"),
        ("asctime", rf"[a-z]{{3}}\s+{_MON}\s+(?P<d>\d{{1,2}})\s+{_TIME}\s+(?:(?P<tz>[a-z]{{1,4}})\s+)?(?P<y>\d{{4}})"),
        ("name_month", rf"{_MON}[\s-]+(?:de\s+|del\s+)?(?P<y>\d{{4}})"),
        ("epoch_s", r"(?P<epoch>\d{9,10})"),
        ("epoch_ms", r"(?P<epoch>\d{12,13})"),
        ("epoch_us", r"(?P<epoch>\d{15,16})"),
    ]
]
FORMATS = [name for name, _ in _PATTERNS]
_EPOCH_UNIT = {"epoch_s": 1, "epoch_ms": 1000, "epoch_us": 1_000_000}
#: Epochs count as moments only between these years.
EPOCH_YEARS = (1975, 2050)
YEARS = (1000, 2100)


def fold(text: str) -> str:
    text = unicodedata.normalize("NFKD", text)
    return "".join(c for c in text if not unicodedata.combining(c) and unicodedata.category(c) != "Cf").lower()


def _offset(tz: str) -> int | None:
    if tz in ZONES:
        return ZONES[tz]
    m = re.fullmatch(r"(?:gmt|utc)?([+-])(\d\d)'?:?(\d\d)?", tz)
    if not m or int(m[2]) > 14 or int(m[3] or 0) > 59:
        return None
    return (1 if m[1] == "+" else -1) * (int(m[2]) * 60 + int(m[3] or 0))


def _utc(at: datetime) -> str | None:
    try:
        at = at.astimezone(UTC)
    except (OverflowError, ValueError):
        return None
    return f"{at.year:04d}-{at.month:02d}-{at.day:02d}T{at.hour:02d}:{at.minute:02d}:{at.second:02d}Z"


def _value(name: str, g: dict, zone: ZoneInfo) -> str | None:
    if g.get("epoch"):
        try:
            at = datetime(1970, 1, 1, tzinfo=UTC) + timedelta(seconds=int(g["epoch"]) // _EPOCH_UNIT[name])
        except OverflowError:
            return None
        return _utc(at) if EPOCH_YEARS[0] <= at.year <= EPOCH_YEARS[1] else None
    y = int(g["y"])
    if not YEARS[0] <= y <= YEARS[1]:
        return None
    month = g.get("m") or (MONTHS.get(g["mon"]) if g.get("mon") else None)
    if g.get("mon") and not month:
        return None
    if not month:
        return f"{y:04d}"
    month = int(month)
    if not 1 <= month <= 12:
        return None
    if not g.get("d"):
        return f"{y:04d}-{month:02d}"
    try:
        day = date(y, month, int(g["d"]))
    except ValueError:
        return None
    if not g.get("h"):
        return day.isoformat()
    h, mi, s = int(g["h"]), int(g.get("mi") or 0), int(g.get("s") or 0)
    if g.get("ap"):
        if not 1 <= h <= 12:
            return None
        h = h % 12 + (12 if g["ap"] == "p" else 0)
    if h > 23 or mi > 59 or s > 59:
        return None
    if g.get("tz"):
        off = _offset(g["tz"])
        if off is None:
            return None
        return _utc(datetime(y, month, day.day, h, mi, s, tzinfo=timezone(timedelta(minutes=off))))
    return _utc(datetime(y, month, day.day, h, mi, s, tzinfo=zone))


@lru_cache(maxsize=8)
def _zone(name: str) -> ZoneInfo:
    return ZoneInfo(name)


def readings(raw: str | None, zone: str = "Europe/Paris", day_first: bool | None = True) -> list[tuple[str, str]]:
    """All ``(format, normal form)`` that ``raw`` allows; empty if none.

    ``day_first=True`` (False) leaves out the all-numeric readings with the
    month (day) in front; None keeps both and leaves the choice to the caller.
    """
    if not raw:
        return []
    text = re.sub(r"\s+", " ", fold(raw)).strip()
    text = text.removeprefix("cleanup_")
    out: dict[str, str] = {}
    for name, pattern in _PATTERNS:
        if (name == "month_first" and day_first is True) or (name == "day_first" and day_first is False):
            continue
        m = pattern.fullmatch(text)
        if m and (v := _value(name, m.groupdict(), _zone(zone))) and v not in out.values():
            out[name] = v
    return list(out.items())

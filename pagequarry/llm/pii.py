"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass over a text: at-signs, digits that could begin a number, plus signs
before digits, and cues (schemes, words that announce an account). A local parser for each kind expands an anchor to
its boundaries and validates what it finds. Parsers look at the neighbourhood of an anchor only.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "iban", "login")  # the last two are added to the base kinds
BASE = 4
# The patterns of the base kinds from where an anchor puts their start (an e-mail's from its at-sign on).
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_LOGIN = re.compile(r"[^\s/@:]+:[^\s/@]+@[A-Za-z0-9.-]+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = "0123456789"
_CUES = {"iban": ("IBAN", "iban", "Iban"), "login": ("http://", "https://", "ftp://", "ssh://", "postgres://", "mysql://")}
_CUE_REACH = 12  # characters between a cue and what it announces


@cache
def _automaton() -> ahocorasick.Automaton:
    """Anchors to the kinds that they may begin; made once in each worker."""
    anchors: dict[str, list[int]] = {"@": [0]}
    for a in _DIGITS:
        anchors[f"+{a}"] = [3]
        anchors[f"{a}."] = [1]
        for b in _DIGITS:
            for gap in ("", " ", "-"):
                anchors[f"{a}{gap}{b}"] = [2]
    for kind, cues in _CUES.items():
        for cue in cues:
            anchors[cue] = [KINDS.index(kind)]
    made = ahocorasick.Automaton()
    for anchor, kinds in anchors.items():
        made.add_word(anchor, (len(anchor), kinds))
    made.make_automaton()
    return made


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _email(text: str, at: int, free: int) -> tuple[int, int, bool] | None:
    start = at
    while start > free and text[start - 1] in _LOCAL:
        start -= 1
    m = _DOMAIN.match(text, at) if start < at else None
    return (start, m.end(), True) if m else None


def _ip(text: str, at: int, free: int) -> tuple[int, int, bool] | None:
    start = at
    while start > free and text[start - 1] in _DIGITS:
        start -= 1
    m = _IP.match(text, start)
    return (start, m.end(), all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split("."))) if m else None


def _card(text: str, at: int, free: int) -> tuple[int, int, bool] | None:
    m = _CARD.match(text, at)
    digits = re.sub(r"[\x20-]", "", m.group())
    return at, m.end(), 16 <= len(digits) <= 19 and luhn(digits)


def _phone(text: str, at: int, free: int) -> tuple[int, int, bool] | None:
    m = _PHONE.match(text, at)
    return (at, m.end(), 8 <= sum(c in _DIGITS for c in m.group()) <= 15) if m else None


def _iban(text: str, at: int, free: int) -> tuple[int, int, bool] | None:
    m = _IBAN.search(text, at, at + _CUE_REACH + 60)
    if not m or m.start() - at > _CUE_REACH:
        return None
    plain = m.group().replace(" ", "")
    valid = len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    return (m.start(), m.end(), True) if valid else None


def _login(text: str, at: int, free: int) -> tuple[int, int, bool] | None:
    start = text.index("://", at) + 3
    m = _LOGIN.match(text, start)
    return (start, m.end(), True) if m else None


_PARSERS: tuple[Callable[[str, int, int], tuple[int, int, bool] | None], ...] = (_email, _ip, _card, _phone, _iban, _login)


def find(text: str | None) -> list[list[tuple[int, int]]]:
    """Spans of each kind in code points, end exclusive: leftmost, apart, invalid ones dropped without another try."""
    out: list[list[tuple[int, int]]] = [[] for _ in KINDS]
    if not text:
        return out
    free = [0] * len(KINDS)
    for last, (length, kinds) in _automaton().iter(text):
        at = last - length + 1
        for k in kinds:
            if at < free[k]:
                continue
            found = _PARSERS[k](text, at, free[k])
            if found:
                start, end, valid = found
                free[k] = end
                if valid:
                    out[k].append((start, end))
    return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column(1):
            spans = find(text.as_py())
            named = [[f"{KINDS[k]}:{s}:{e}" for s, e in found] for k, found in enumerate(spans)]
            base = ",".join(x for part in named[:BASE] for x in part)
            rows.append((*map(len, spans), hashlib.sha256(base.encode()).hexdigest(), ",".join(x for part in named for x in part)))
        columns = list(zip(*rows)) if rows else [()] * (len(KINDS) + 2)
        types = [*[pa.int64()] * len(KINDS), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))],
                                         ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): spans (kind:start:end, by kind, then start), the base kinds' hash and
    a count for each kind.

    Base kinds are e-mail and IP addresses, card and phone numbers; added are IBANs after their cue and logins inside
    URLs. Null and empty texts have none. Null ids and repeated rows give their row; other columns are ignored. An
    empty table gives no rows.
    """
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _scan, f"doc_id bigint, {counts}, base_sha256 string, spans string")
    return found.select("doc_id", *(f"n_{k}" for k in KINDS[:BASE]), "base_sha256", "spans", *(f"n_{k}" for k in KINDS[BASE:]))

"""Personal data: patterns propose, checksums confirm, context adjusts.

The base kinds (email, ip, card, phone) are always reported when their pattern and
validator agree.  Further kinds are proposed by a pattern, checked by a validator
(mod-97 for account numbers, area and group rules for social security numbers) and
scored: a confirmed checksum and nearby context words raise the score, words that speak
against it lower it, and a span is reported from ``LEAST_SCORE`` on.

All spans are in code points, end exclusive.  Each pattern runs in time linear in the
text: e-mail addresses are found from their at-signs, and number patterns never start
inside a run of digits.

Defined results: NULL and empty texts have no spans; whole texts of any length are
searched; repeated rows are searched each; an empty table gives an empty result; further
columns of the input are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from tidemark.llm.common import map_texts

#: All kinds, in the order in which spans with one start are listed.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "birth_date")
LEAST_SCORE = 0.6
#: Code points on either side of a span that are searched for context words.
NEAR = 48

AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A match ends with a whole run of digits, so no later one can start inside a run.
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Proposed kinds: pattern, words that speak for it, words that speak against it.
PROPOSED = {
    "iban": (
        re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
        re.compile(r"(?i)\b(iban|account|bank|konto|compte|cuenta)\b"),
        re.compile(r"(?i)\b(example|sample|muster)\b"),
    ),
    "ssn": (
        re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
        re.compile(r"(?i)\b(ssn|social security|tax id|taxpayer)\b"),
        re.compile(r"(?i)\b(order|invoice|part|serial|isbn)\b"),
    ),
    "birth_date": (
        re.compile(r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4})(?![0-9./-])"),
        re.compile(r"(?i)\b(born|birth|birthday|dob|geboren|geburtsdatum|né|née|nacid[oa])\b"),
        re.compile(r"(?i)\b(published|updated|version|release|copyright)\b"),
    ),
}


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number is right."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def mod97(code: str) -> bool:
    """Whether an account number, its first four characters moved to the end, is 1 mod 97."""
    moved = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str):
    """Leftmost matches: each at-sign takes the run before it, after the last match."""
    last = 0
    for match in AT.finditer(text):
        at = start = match.start()
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < at:
            last = match.end()
            yield start, last


def base_spans(text: str):
    if "@" in text:
        for start, end in emails(text):
            yield "email", start, end
    for m in IP.finditer(text):
        if all(int(p[-4:]) <= 255 and len(p.lstrip("0")) <= 3 for p in m[0].split(".")):
            yield "ip", m.start(), m.end()
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            yield "card", m.start(), m.end()
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                yield "phone", m.start(), m.end()


def confirmed(kind: str, found: str) -> float:
    """A proposal's score by its validator, before context; 0 if it can't be."""
    if kind == "iban":
        code = found.replace(" ", "")
        return 0.9 if 15 <= len(code) <= 34 and mod97(code) else 0.0
    if kind == "ssn":
        area, group, serial = found.split("-")
        return 0.0 if area in ("000", "666") or area[0] == "9" or group == "00" or serial == "0000" else 0.5
    parts = [int(p) for p in re.split(r"[-./]", found)]
    year, month, day = parts if parts[0] > 31 else parts[::-1]
    if month > 12:
        month, day = day, month
    return 0.3 if 1900 <= year <= 2100 and 1 <= month <= 12 and 1 <= day <= 31 else 0.0


def proposed_spans(text: str):
    """Spans of the further kinds with their scores."""
    for kind, (pattern, words_for, words_against) in PROPOSED.items():
        for m in pattern.finditer(text):
            score = confirmed(kind, m[0])
            if score:
                around = text[max(0, m.start() - NEAR) : m.start()] + "\n" + text[m.end() : m.end() + NEAR]
                score += 0.4 * bool(words_for.search(around)) - 0.4 * bool(words_against.search(around))
            if score >= LEAST_SCORE:
                yield kind, m.start(), m.end(), min(1.0, score)


def spans_of(text: str | None) -> list[dict]:
    """All spans of a text by start, then kind."""
    if not text:
        return []
    found = [(kind, start, end, 1.0) for kind, start, end in base_spans(text)]
    found += proposed_spans(text)
    found.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return [dict(zip(("kind", "start", "end", "score"), s)) for s in found]


def find(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans`` of each row of ``docs`` (doc_id, text)."""
    return map_texts(
        docs.select("doc_id", "text"),
        lambda: lambda text: (spans_of(text),),
        "spans array<struct<kind:string,start:int,end:int,score:double>>",
    )

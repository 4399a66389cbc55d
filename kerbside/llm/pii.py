"""Personal data: patterns propose spans, checksums confirm them, context words score them.

Base kinds (email, ip, card, phone) are kept whenever their own check holds:
parts of an address at most 255, the Luhn sum of a card, the digits of a
phone number. Added kinds need a score of at least ``THRESHOLD``:

* ``iban``: country code, two check digits and 11 to 30 letters or digits, in
  groups or not. The mod-97 checksum confirms it and gives the score.
* ``tel``: 9 to 15 digits in groups without the leading ``+``. It has no
  checksum, so a context word close by has to lift it over the threshold.

A null text is empty. Spans are code points, end exclusive; kinds may overlap.
All patterns here are read in linear time, whatever the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.tables import unused

KINDS = ("email", "ip", "card", "phone", "iban", "tel")
BASE = KINDS[:4]
THRESHOLD = 0.5
CONTEXT_CHARS = 40

# Words that raise the score of a nearby span.
CONTEXT = {
    "iban": ("iban", "bank", "konto", "compte", "cuenta", "account"),
    "tel": ("tel", "phone", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"),
    "card": ("card", "visa", "mastercard", "karte", "carte", "tarjeta"),
    "email": ("mail", "email", "contact", "kontakt", "contacto"),
    "phone": ("tel", "phone", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"),
    "ip": ("ip", "host", "server", "address", "adresse"),
}
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "tel": 0.2}
LIFT = 0.35

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# The look-behinds change no match: a run of digits that fails from its start fails from inside too.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_TEL = re.compile(r"(?<![0-9A-Za-z+.])\(?[0-9]{2,5}\)?(?:[\x20./-][0-9]{2,8}){1,5}(?![0-9A-Za-z])")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        doubled = digit * (1 + place % 2)
        total += doubled - 9 * (doubled > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches around each ``@``; walking left keeps long words linear."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def _digits(value: str) -> str:
    return "".join(_DIGIT.findall(value))


def _context(text: str, kind: str, start: int, end: int) -> float:
    around = text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS]
    words = {w.lower() for w in _WORD.findall(around)}
    return LIFT if words & set(CONTEXT[kind]) else 0.0


def _merged(found: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Overlapping spans as one stretch; stretches in order."""
    out: list[tuple[int, int]] = []
    for start, _, end in sorted(found):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def spans(text: str | None) -> list[tuple[int, int, int, float]]:
    """``(start, kind number, end, score)`` of every span, in order of start, then kind."""
    text = text or ""
    found: list[tuple[int, int, int]] = []
    if "@" in text:
        found += [(s, 0, e) for s, e in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12 and 12 <= len(d := _digits(m.group())) <= 19 and luhn(d):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_digits(m.group())) <= 15:
                    found.append((m.start(), 3, m.end()))
        base = list(found)
        for m in _IBAN.finditer(text):
            if mod97(m.group().replace(" ", "")):
                found.append((m.start(), 4, m.end()))
        stretches, at = _merged(base), 0
        for m in _TEL.finditer(text):
            while at < len(stretches) and stretches[at][1] <= m.start():
                at += 1
            inside = at < len(stretches) and stretches[at][0] < m.end()
            if not inside and 9 <= len(_digits(m.group())) <= 15:
                found.append((m.start(), 5, m.end()))
    scored = []
    for start, kind, end in found:
        score = min(1.0, PRIOR[KINDS[kind]] + _context(text, KINDS[kind], start, end))
        if kind < len(BASE) or score >= THRESHOLD:
            scored.append((start, kind, end, score))
    return sorted(scored)


def masked(text: str | None, found: list[tuple[int, int, int, float]]) -> str | None:
    """The text with each run of overlapping spans replaced by the name of its first kind."""
    if not found:
        return text
    parts, done = [], 0
    for start, kind, end, _ in found:
        if start >= done:
            parts += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done = max(done, end)
    return "".join(parts) + text[done:]


def find_personal_data(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns to keep (all but the text by default) plus ``masked`` text and ``spans`` (array of start, kind, end, score).

    Rows pass one by one in Arrow batches; nothing is shuffled. Null ids,
    repeated rows and other columns change nothing; a text is scanned whole, in
    time that follows its length; an empty table gives no rows.
    """
    keep = [c for c in docs.columns if c != text_col] if keep is None else keep
    keep = [c for c in keep if c not in ("masked", "spans")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32()), ("score", pa.float64())]))
        for batch in batches:
            texts = batch.column(0).to_pylist()
            found = [spans(t) for t in texts]
            rows = [[{"start": s, "kind": KINDS[k], "end": e, "score": p} for s, k, e, p in f] for f in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(map(masked, texts, found), pa.string()), pa.array(rows, kinds)],
                [*keep, "masked", "spans"],
            )

    picked = docs.select(F.col(text_col).cast("string").alias(unused("__text", docs)), *(F.col(f"`{c}`") for c in keep))
    schema = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return picked.mapInArrow(run, f"{schema}masked string, spans array<struct<start:int,kind:string,end:int,score:double>>")

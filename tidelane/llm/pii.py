"""Personal data: regular expressions propose spans, checksums confirm them, and words nearby adjust the score.

Base kinds are email, ip, card (Luhn) and phone; their spans always count. Added kinds are iban (its country's length and mod-97),
ssn, mac and secret (keys and passwords: known forms, private key blocks, and mixed values that a name announces); their spans count
from a score of ``least`` on: the kind's own score, plus what a passed checksum adds, plus or less what supporting or
doubting words within ``REACH`` characters before or after add. Added spans never overlap base ones or each other.

All scans take time linear in the text, however long its runs of digits or letters are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelane.llm.frames import field, unused

KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "mac", "secret")
BASE = KINDS[:4]
REACH = 40

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Za-z]{2}[0-9]{2}(?=[ -]?[A-Za-z0-9]{4})", re.ASCII)
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_MAC = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{2}:){5}[0-9A-Fa-f]{2}(?![0-9A-Fa-f:])")
_NAMED = re.compile(r"(?:token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key|auth[_-]?key)[\"']?\s{0,3}[:=]\s{0,3}[\"']?([A-Za-z0-9_./+-]{16,512}={0,2})", re.IGNORECASE | re.ASCII)
_KEY_BLOCK = re.compile(r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----")
_KEY_END = re.compile(r"-----END [A-Z ]{0,30}PRIVATE KEY-----")
# Forms of keys that common services issue.
_ISSUED = re.compile(r"(?<![A-Za-z0-9_-])(?:AKIA[0-9A-Z]{16}|gh[opsu]_[A-Za-z0-9]{36,255}|xox[abprs]-[A-Za-z0-9-]{10,255}|sk-[A-Za-z0-9]{20,255}|AIza[A-Za-z0-9_-]{35})(?![A-Za-z0-9_])", re.ASCII)
# Lengths of account numbers by country.
IBAN_LENGTHS = {
    text[:2]: int(text[2:]) for text in """
    AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23
    GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28
    NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30
    """.split()
}
_NOT_DIGIT = re.compile(r"[^0-9]+")

#: Own score and what a passed checksum adds.
SCORES = {"email": (0.9, 0.0), "ip": (0.6, 0.0), "card": (0.4, 0.4), "phone": (0.7, 0.0), "iban": (0.2, 0.6), "ssn": (0.3, 0.0), "mac": (0.6, 0.0), "secret": (0.4, 0.5)}
SUPPORT = {
    "email": ("mail", "contact", "correo"), "ip": ("ip", "address", "server"), "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "tel", "call", "mobile"), "iban": ("iban", "bank", "account", "konto"), "ssn": ("ssn", "social", "security"), "mac": ("mac", "device"),
    "secret": ("token", "secret", "password", "key", "credentials"),
}
DOUBT = ("example", "sample", "version", "isbn", "order")
SUPPORT_ADDS, DOUBT_ADDS = 0.3, -0.3
_WORD = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    """Whether the last digit checks the others: every second one from the right counts twice."""
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Whether an account number without spaces leaves 1 when its first four characters go last and letters count from 10."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _accounts(text: str) -> Iterator[tuple[int, int]]:
    """Account numbers of their country's length, in one run or in groups of four; what follows is none of it."""
    for found in _IBAN.finditer(text):
        length = IBAN_LENGTHS.get(found.group()[:2].upper())
        if length is None:
            continue
        taken, at = found.group(), found.end()
        while len(taken) < length and at < len(text):
            if len(taken) % 4 == 0 and text[at] in " -" and text[at - 1] not in " -":
                at += 1
            elif text[at].isascii() and text[at].isalnum():
                taken, at = taken + text[at], at + 1
            else:
                break
        ends = at == len(text) or not (text[at].isascii() and text[at].isalnum())
        if len(taken) == length and ends and mod97(taken.upper()):
            yield found.start(), at


def _secrets(text: str) -> Iterator[tuple[int, int]]:
    for found in _ISSUED.finditer(text):
        yield found.span()
    for found in _NAMED.finditer(text):
        value = found.group(1)
        # A word or a path is no key: keys mix digits and letters, and repeat few of them.
        if any(c.isdigit() for c in value) and any(c.isalpha() for c in value) and len(set(value)) >= 8:
            yield found.span(1)
    end = 0
    for found in _KEY_BLOCK.finditer(text) if "PRIVATE KEY-----" in text else ():
        if found.start() >= end:
            close = _KEY_END.search(text, found.end())
            end = close.end() if close else found.end()
            yield found.start(), end


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        at += 1
        if found:
            yield start, found.end()
            last = at = found.end()


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    for run in _DOTTED.finditer(text):
        parts = run.group().split(".")
        start = run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
                yield start, end
            start = end + 1


def _numbers(pattern: re.Pattern, text: str, least: int, most: int, check) -> Iterator[tuple[int, int]]:
    for found in pattern.finditer(text):
        if found.end() - found.start() >= least:
            digits = _NOT_DIGIT.sub("", found.group())
            if least <= len(digits) <= most and check(digits):
                yield found.span()


def score(kind: str, text: str, start: int, end: int) -> float:
    own, checked = SCORES[kind]
    near = {w.lower() for w in _WORD.findall(text[max(0, start - REACH) : start] + " " + text[end : end + REACH])}
    own += checked + SUPPORT_ADDS * bool(near & set(SUPPORT[kind])) + DOUBT_ADDS * bool(near & set(DOUBT))
    return round(min(1.0, max(0.0, own)), 4)


def find(text: str, least: float = 0.5) -> list[tuple[str, int, int, float]]:
    """All spans of a text by start, then kind: kind, start, end (exclusive, in code points), score."""
    found = [("email", *s) for s in _emails(text)] if "@" in text else []
    found += [("ip", *s) for s in _addresses(text)]
    found += [("card", *s) for s in _numbers(_DIGITS, text, 14, 19, luhn)]
    found += [("phone", *s) for s in _numbers(_PHONE, text, 10, 15, lambda _: True)]
    out = [(k, a, b, score(k, text, a, b)) for k, a, b in found]
    taken = sorted((a, b) for _, a, b in found)
    added = [("iban", *s) for s in _accounts(text)] + [("secret", *s) for s in _secrets(text)]
    added += [("ssn", *m.span()) for m in _SSN.finditer(text)]
    added += [("mac", *m.span()) for m in _MAC.finditer(text)] if ":" in text else []
    last = place = 0
    for kind, a, b in sorted(added, key=lambda s: (s[1], KINDS.index(s[0]))):
        while place < len(taken) and taken[place][1] <= a:
            place += 1
        if a >= last and not any(x < b and y > a for x, y in taken[place : place + 3]) and (own := score(kind, text, a, b)) >= least:
            out.append((kind, a, b, own))
            last = b
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def _listed(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b, _ in spans)


SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"


def _run(text: str, into: str, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in find(t or "", least)] for t in batch[text].to_pylist()]
            at = batch.schema.get_field_index(into)
            yield batch.set_column(at, batch.schema.field(at), pa.array(made, batch.schema.field(at).type))

    return run


def find_personal(docs: DataFrame, into: str, least: float = 0.5) -> DataFrame:
    """``docs`` with a list column ``into`` of spans (kind, start, end, score), by start, then kind.

    Null text counts as empty. Other columns pass through; an earlier column ``into`` is replaced; rows repeat as given.
    """
    out = docs.withColumn(into, F.lit(None).cast(SPANS))
    return out.mapInArrow(_run("text", into, least), out.schema)


def _digest(keep: list[str], spans: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [[(s["kind"], s["start"], s["end"], s["score"]) for s in x] for x in batch[spans].to_pylist()]
            base = [[s for s in x if s[0] in BASE] for x in own]
            counts = [pa.array([sum(s[0] == k for s in x) for x in base], pa.int64()) for k in BASE]
            sha = pa.array([hashlib.sha256(_listed(x).encode()).hexdigest() for x in base], pa.string())
            scores = pa.array([",".join(f"{s[3]:.2f}" for s in x) for x in own], pa.string())
            columns = [*(batch[c] for c in keep), *counts, sha, pa.array(map(_listed, own), pa.string()), scores]
            yield pa.RecordBatch.from_arrays(columns, [*keep, *(f"n_{k}" for k in BASE), "base_sha256", "spans", "scores"])

    return run


def digest(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Counts of base spans, the SHA-256 of their list, the list of all spans and that of their scores, for each row; only the columns ``keep`` stay."""
    spans = unused(docs, "found_spans")
    found = find_personal(docs.select(*keep, "text"), spans).drop("text")
    schema = ", ".join([*(field(docs, c) for c in keep), *(f"n_{k} long" for k in BASE), "base_sha256 string", "spans string", "scores string"])
    return found.mapInArrow(_digest(keep, spans), schema)

"""Personal data: patterns propose spans, checksum validators confirm them, nearby words adjust the score."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from orbitloom.llm.common import map_rows, table

#: Kinds in the order of the spans; the last two are this method's own.
KINDS = ("email", "ip", "card", "phone", "iban", "pan")

# Each pattern runs in linear time: a run of its characters is entered once, from its left end.
EMAIL_TAIL = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=\x20?[A-Z0-9])")
#: Characters of the account numbers of each country; those of others have 15 to 34.
IBAN_LENGTH = {
    c: n
    for n, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
        24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for c in countries.split()
}
UPPER = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
#: Characters on either side of a span that may hold context words.
NEAR = 60
#: A confirmed span's score without context, and what a context word adds.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "pan": 0.3}
BOOST = 0.35
CONTEXT = {
    "email": re.compile(r"\b(?:e-?mail|mail|contact|write)", re.I),
    "ip": re.compile(r"\b(?:ip|address|host|server|client)\b", re.I),
    "card": re.compile(r"\b(?:card|visa|mastercard|credit|debit|payment)", re.I),
    "phone": re.compile(r"\b(?:phone|tel|mobile|call|fax|cell)", re.I),
    "iban": re.compile(r"\b(?:iban|account|bank|konto|compte|cuenta)", re.I),
    "pan": re.compile(r"\b(?:card|amex|american express|diners|credit|debit|imei)", re.I),
}
#: Spans of the method's own kinds need this score.
LEAST_SCORE = 0.5


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def mod97(iban: str) -> bool:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def emails(text: str) -> Iterable[tuple[int, int]]:
    """Leftmost non-overlapping addresses. A match starts at the left end of the run of local characters before an @, or where the match before it ends."""
    done = 0
    for m in EMAIL_TAIL.finditer(text):
        start = at = m.start()
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at:
            done = m.end()
            yield start, done


def ibans(text: str) -> Iterable[tuple[int, int]]:
    """Account numbers that the check digits confirm. Other words may follow in capitals or digits: a number ends where a word does, at its country's length or, where the country has none, at the last place from 15 to 34 characters."""
    done = 0
    for m in IBAN.finditer(text):
        if (start := m.start()) < done:
            continue
        at, code, ends = start, [], []
        while len(code) < 34:
            if text[at : at + 1] == " " and text[at + 1 : at + 2] in UPPER:
                at += 1
            if text[at : at + 1] not in UPPER:
                break
            code.append(text[at])
            at += 1
            if len(code) >= 15 and not (text[at : at + 1].isascii() and text[at : at + 1].isalnum()):
                ends.append((len(code), at))
        length = IBAN_LENGTH.get(text[start : start + 2])
        for n, end in reversed(ends):
            if n == (length or n) and mod97("".join(code[:n])):
                done = end
                yield start, end
                break


def proposed(text: str) -> Iterable[tuple[str, int, int]]:
    """Confirmed spans, kind by kind."""
    if "@" in text:
        for start, end in emails(text):
            yield "email", start, end
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            yield "ip", m.start(), m.end()
    short = []
    for m in DIGITS.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "") if m.end() - m.start() <= 40 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            if len(digits) >= 16:
                yield "card", m.start(), m.end()
            else:
                short.append(("pan", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                yield "phone", m.start(), m.end()
    for start, end in ibans(text):
        yield "iban", start, end
    yield from short


def find(text: str) -> list[tuple[str, int, int, float]]:
    """Spans as (kind, start, end, score), by kind and start; positions are code points, the end exclusive. Spans of the base kinds stay whatever their score; the others need LEAST_SCORE."""
    out = []
    for kind, start, end in proposed(text):
        near = text[max(0, start - NEAR) : start] + "\n" + text[end : end + NEAR]
        score = min(1.0, PRIOR[kind] + BOOST * bool(CONTEXT[kind].search(near)))
        if kind in ("email", "ip", "card", "phone") or score >= LEAST_SCORE:
            out.append((kind, start, end, score))
    return out


def personal_data(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """The columns in keep, with `found`: an array of (kind, start, end, score) over the whole text. A null or empty text has none; repeated rows give repeated results."""

    def make() -> Callable[[tuple], Iterable[tuple]]:
        def row(values: tuple) -> Iterable[tuple]:
            yield *values[:-1], [dict(zip(("kind", "start", "end", "score"), x, strict=True)) for x in find(values[-1] or "")]

        return row

    kinds = dict(df.dtypes)
    return map_rows(df.select(*keep, text), make, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "found array<struct<kind: string, start: long, end: long, score: double>>"]))


def masked(text: str, spans: list[tuple[str, int, int, float]]) -> str:
    """The text with each span replaced by its kind in brackets; where spans overlap, one mark of the first stands for all."""
    parts, done = [], 0
    for kind, start, end, _ in sorted(spans, key=lambda x: (x[1], -x[2])):
        if start >= done:
            parts += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*parts, text[done:]])


def mask_personal_data(df: DataFrame, text: str) -> DataFrame:
    """All rows and columns, with the spans in the text column replaced. Null texts stay null."""
    at = df.columns.index(text)

    def make() -> Callable[[tuple], Iterable[tuple]]:
        def row(values: tuple) -> Iterable[tuple]:
            s = values[at]
            spans = find(s) if s else []
            yield (*values[:at], masked(s, spans), *values[at + 1 :]) if spans else values

        return row

    return map_rows(df, make, ", ".join(f"`{c}` {kind}" for c, kind in df.dtypes))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    def make() -> Callable[[tuple], Iterable[tuple]]:
        def row(values: tuple) -> Iterable[tuple]:
            doc_id, found = values
            spans = [(x["kind"], f"{x['kind']}:{x['start']}:{x['end']}") for x in found or []]
            base = [s for kind, s in spans if kind in KINDS[:4]]
            counts = [sum(kind == k for kind, _ in spans) for k in KINDS[:4]]
            yield doc_id, *counts, hashlib.sha256(",".join(base).encode()).hexdigest(), ",".join(s for _, s in spans)

        return row

    found = personal_data(table(spark, sf_dir, "documents"), "text", ["doc_id"])
    return map_rows(found, make, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")

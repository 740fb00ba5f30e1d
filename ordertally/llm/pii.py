"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs,
digits, address schemes and identifier cues.  A deterministic parser expands
each anchor to its boundaries and validates the result:

* ``email``, ``ip``, ``card``, ``phone``: the base kinds, leftmost and
  non-overlapping per kind; a match that fails its check is dropped and its
  characters are not tried again.
* ``address``: a scheme (http, https, ftp, mailto) with a host or mailbox.
* ``account``: an identifier cue (iban, account, token, ...) with the
  identifier after it; IBANs must pass their mod-97 check, other identifiers
  need six characters and four digits.

Offsets are code points, ends exclusive.  Defined cases: null and empty
texts have no spans; repeated rows are searched each on their own; further
input columns are ignored, and redaction keeps them.
"""

from __future__ import annotations

import functools
import hashlib
import re

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertally.llm.common import fields, map_columns

# Base kinds in their listed order, then the added ones.
KINDS = ("email", "ip", "card", "phone", "address", "account")
SCHEMES = ("http://", "https://", "ftp://", "mailto:")
CUES = (
    "iban", "account", "account no", "account number", "acct", "konto", "kontonummer", "cuenta", "compte", "passport",
    "ssn", "social security number", "tax id", "customer id", "user id", "member id", "licence", "license number",
    "token", "api key", "api_key", "apikey", "secret", "password", "passwort", "access key", "secret key",
)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+){0,3}")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])*")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_HOST = re.compile(r"(?:[^\s/?#@<>\"']+@)?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+(?::[0-9]+)?(?:[/?#][^\s<>\"']*)?")
_BETWEEN = re.compile(r"(?:\s*(?:no\.?|nr\.?|number|is))?[\s:=#\"'(]{1,8}", re.I)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_IDENTIFIER = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9._/+-]*[A-Za-z0-9])?")

Span = tuple[int, int, int]  # start, kind's place in KINDS, end


@functools.cache
def _anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for c in "@+0123456789":
        found.add_word(c, (c, 1))
    for s in SCHEMES:
        for form in {s, s.upper(), s.capitalize()}:
            found.add_word(form, ("scheme", len(s)))
    for c in CUES:
        for form in {c, c.upper(), c.capitalize(), c.title()}:
            found.add_word(form, ("cue", len(c)))
    found.make_automaton()
    return found


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _byte_part(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def _iban_ok(text: str) -> bool:
    moved = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _account(text: str, start: int, end: int) -> tuple[int, int] | None:
    """The identifier after the cue at text[start:end]."""
    if start and text[start - 1].isalnum() or end < len(text) and text[end].isalnum():
        return None
    gap = _BETWEEN.match(text, end)
    if gap is None:
        return None
    if m := _IBAN.match(text, gap.end()):
        for stop in range(m.end(), m.start() + 14, -1):  # at most 34 characters and their spaces
            iban = text[m.start() : stop].replace(" ", "")
            if text[stop - 1] != " " and 15 <= len(iban) <= 34 and _iban_ok(iban):
                return m.start(), stop
    m = _IDENTIFIER.match(text, gap.end())
    if m and m.end() - m.start() >= 6 and sum(c.isdigit() for c in m[0]) >= 4:
        return m.start(), m.end()
    return None


def find_spans(text: str | None) -> list[Span]:
    """All spans of a text by start, then kind."""
    out: set[Span] = set()
    email_end = digits_end = dotted_end = phone_end = address_end = 0
    for last, (kind, size) in _anchors().iter(text or ""):
        at = last - size + 1
        if kind == "@":
            start = at
            while start > email_end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                email_end = m.end()
                out.add((start, 0, email_end))
        elif kind == "+":
            if at >= phone_end and (m := _PHONE.match(text, at)):
                phone_end = m.end()
                if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out.add((at, 3, phone_end))
        elif kind == "scheme":
            if at >= address_end and (m := _HOST.match(text, last + 1)):
                address_end = at + len(text[at : m.end()].rstrip(".,;:!?)]}"))
                out.add((at, 4, address_end))
        elif kind == "cue":
            if found := _account(text, at, last + 1):
                out.add((found[0], 5, found[1]))
        else:
            if at >= dotted_end:
                m = _DOTTED.match(text, at)
                dotted_end = m.end()
                parts = m[0].split(".")
                if len(parts) == 4 and all(map(_byte_part, parts)):
                    out.add((at, 1, dotted_end))
            if at >= digits_end:
                m = _DIGITS.match(text, at)
                digits_end = m.end()
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and _luhn(digits):
                    out.add((at, 2, digits_end))
    return sorted(out)


def span_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


FOUND = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def find_personal_data(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans, per document."""

    def run(texts):
        cols: list[list] = [[] for _ in range(6)]
        for text in texts.to_pylist():
            spans = find_spans(text)
            base = [x for x in spans if x[1] < 4]
            for k in range(4):
                cols[k].append(sum(x[1] == k for x in base))
            cols[4].append(hashlib.sha256(span_text(base).encode()).hexdigest())
            cols[5].append(span_text(spans))
        return cols

    return map_columns(docs, ["text"], fields(FOUND), run, keep)


def redacted(text: str | None) -> str | None:
    """A text with each run of overlapping spans replaced by the kind of its first span, as in ``[EMAIL]``."""
    spans = find_spans(text)
    if not spans:
        return text
    out, end = [], 0
    for i, (s, k, e) in enumerate(spans):
        if i == 0 or s >= end:
            out += [text[end:s], f"[{KINDS[k].upper()}]"]
        end = max(end, e)
    return "".join(out) + text[end:]


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, ``n_chars`` (if there) following the new text."""
    counted = [f for f in docs.schema.fields if f.name == "n_chars"]
    text = fields("text string")
    out = map_columns(docs, ["text"], text, lambda t: [[redacted(x) for x in t.to_pylist()]])
    if counted:
        out = out.withColumn("n_chars", F.coalesce(F.length("text"), F.col("n_chars")).cast(counted[0].dataType))
    return out.select(*docs.columns)


def op5(docs: DataFrame) -> DataFrame:
    return find_personal_data(docs, ["doc_id"])

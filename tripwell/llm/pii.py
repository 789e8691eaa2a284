"""Personal data by anchor expansion.

One Aho-Corasick automaton finds anchors in a text: at-signs, scheme marks, a plus
before a digit, neighbouring digits (also of an IBAN), a point before a digit, and identifier cues.
From each anchor a local parser expands to the boundaries of the candidate and
validates it. The parsers only look at the characters that can belong to the
candidate, so the cost follows the text length and the number of anchors.

Kinds found by expansion that equal a plain left-to-right pattern search:

* ``email``  local part, ``@``, host with a dot
* ``ip``     four dotted numbers of at most 255
* ``card``   16 to 19 digits with single separators that pass the Luhn sum
* ``phone``  ``+`` and 8 to 15 digits with separators

Further kinds: ``account`` (number after an identifier cue, or an IBAN that
passes its checksum), ``secret`` (value assigned to a key, token or password),
``url`` (address behind a scheme that carries a user name or an e-mail address),
``masked_email`` (``name [at] host [dot] tld``).

Null texts count as empty and have no spans. Offsets count code points, ends are
exclusive. Each row is handled alone: no shuffle, no group, bounded memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tripwell.llm.batches import handing_back

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("account", "masked_email", "secret", "url")

# Words that announce an identifier or a credential.
ACCOUNT_CUES = ("iban", "account", "acct", "passport", "ssn", "social security", "tax id")
SECRET_CUES = ("key", "token", "secret", "password", "passwd")

_DIGITS = "0123456789"
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NUMBER_CHARS = frozenset(_DIGITS + " -")
_DOTTED_CHARS = frozenset(_DIGITS + ".")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_CAPITALS = re.compile(r"[A-Z]{2}")
_ACCOUNT = re.compile(r"(?: (?:no|number|nr)\.?)?[ :#.=]{1,3}([A-Z]{0,2}[0-9](?:[ -]?[0-9]){5,33})(?![A-Za-z0-9])", re.I)
_SECRET = re.compile(r"[\w-]{0,24}[ \t]{0,2}[:=][ \t]{0,2}[\"']?")
_VALUE = re.compile(r"[A-Za-z0-9_+/=.~-]*")
_VALUE_SIGNS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ_+/=.~-"
_MASKED = re.compile(r"[ ]?[A-Za-z0-9-]+(?: ?[\[(](?:dot)[\])] ?[A-Za-z0-9-]+)+", re.I)
_URL = re.compile(r"[^\s<>\"']+")
_SCHEME = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+.-")

_automaton = None


def anchors():
    """The automaton of all anchors, built once per worker process."""
    global _automaton
    if _automaton is None:
        import ahocorasick

        machine = ahocorasick.Automaton()
        entries = {"@": "email", "://": "url", "mailto:": "url"}
        for form in ("at", "At", "AT"):
            entries |= {f"[{form}]": "masked", f"({form})": "masked"}
        for d in _DIGITS:
            entries["+" + d] = "phone"
            entries["." + d] = "dotted"
            for other in _DIGITS:
                for between in ("", " ", "-"):
                    entries[d + between + other] = "number"
        for cues, kind in ((ACCOUNT_CUES, "account"), (SECRET_CUES, "secret")):
            for cue in cues:
                for form in {cue, cue.upper(), cue.title(), cue.capitalize()}:
                    entries[form] = kind
        for word, kind in entries.items():
            machine.add_word(word, (kind, len(word)))
        machine.make_automaton()
        _automaton = machine
    return _automaton


def _run(text: str, start: int, end: int, allowed: frozenset, least: int = 0) -> tuple[int, int]:
    """The widest stretch of allowed characters around ``start:end``, not left of ``least``."""
    while start > least and text[start - 1] in allowed:
        start -= 1
    stop = len(text)
    while end < stop and text[end] in allowed:
        end += 1
    return start, end


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _iban(candidate: str) -> bool:
    s = candidate.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _iban_end(text: str, at: int) -> int:
    """Where an IBAN that starts here ends, at the end of a word; 0 if there is none."""
    m = _IBAN.match(text, at)
    for end in range(m.end(), at + 14, -1) if m else ():
        if not text[end:end + 1].isalnum() and text[end - 1] != " " and _iban(text[at:end]):
            return end
    return 0


def _digits(s: str) -> str:
    return "".join(c for c in s if c in _DIGITS)


def find_spans(text: str | None) -> list[tuple[str, int, int]]:
    """All spans as (kind, start, end), ordered by kind as listed, then by start."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if not text:
        return []
    email_end = dotted_end = number_end = value_end = value_start = digits_end = url_end = 0
    last_at = -1
    for last, (kind, width) in anchors().iter(text):
        end = last + 1
        start = end - width
        if kind == "number":
            if width == 2 and start > 1 and _CAPITALS.match(text, start - 2) and not text[max(0, start - 3):start - 2].isalnum():
                if stop := _iban_end(text, start - 2):
                    found["account"].append((start - 2, stop))
            if start < number_end:
                continue
            a, number_end = _run(text, start, end, _NUMBER_CHARS)
            for m in _CARD.finditer(text, a, number_end):
                digits = _digits(m.group())
                if 16 <= len(digits) <= 19 and _luhn(digits):
                    found["card"].append(m.span())
        elif kind == "dotted":
            if start < dotted_end:
                continue
            a, dotted_end = _run(text, start, end, _DOTTED_CHARS)
            for m in _DOTTED.finditer(text, a, dotted_end):
                if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
                    found["ip"].append(m.span())
        elif kind == "email":
            host = _HOST.match(text, end)
            a = _run(text, start, start, _LOCAL, email_end)[0] if host else start
            if a < start:
                email_end = host.end()
                found["email"].append((a, email_end))
        elif kind == "phone":
            if (m := _PHONE.match(text, start)) and 8 <= len(_digits(m.group())) <= 15:
                found["phone"].append(m.span())
        elif kind == "account":
            if (m := _ACCOUNT.match(text, end)):
                found["account"].append(m.span(1))
            else:
                a = end + (text[end:end + 1] in (":", " ")) + (text[end:end + 2] == ": ")
                if stop := _iban_end(text, a):
                    found["account"].append((a, stop))
        elif kind == "secret":
            if m := _SECRET.match(text, end):
                a = m.end()
                if not value_start <= a < value_end:
                    value_start, value_end = _VALUE.match(text, a).span()
                    digits_end = a + len(text[a:value_end].rstrip(_VALUE_SIGNS))
                if value_end - a >= 12 and a < digits_end:
                    found["secret"].append((a, value_end))
        elif kind == "masked":
            m = _MASKED.match(text, end)
            b = start - (start > 0 and text[start - 1] == " ")
            a = _run(text, b, b, _LOCAL)[0]
            if m and a < b:
                found["masked_email"].append((a, m.end()))
        elif kind == "url":
            if end >= url_end:  # else the anchor lies in a run that is known
                url_end = m.end() if (m := _URL.match(text, end)) else end
                last_at = text.rfind("@", end, url_end)
            a = _run(text, start, start, _SCHEME)[0]
            if last_at >= end and (a < start or width > 3):
                found["url"].append((a, url_end))
    return [(k, *span) for k in KINDS for span in sorted(set(found[k]))]


def redact(text: str | None) -> str | None:
    """The text with every span, overlapping ones merged, replaced by the kind of its first span."""
    spans = sorted(find_spans(text), key=lambda s: (s[1], -s[2]))
    if not spans:
        return text
    parts, at = [], 0
    merged: list[list] = []
    for kind, start, end in spans:
        if merged and start < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], end)
        else:
            merged.append([kind, start, end])
    for kind, start, end in merged:
        parts += [text[at:start], f"<{kind.upper()}>"]
        at = end
    return "".join(parts) + text[at:]


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan_personal_data(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """One row per input row: id, ``spans`` (``kind:start:end`` comma-joined), counts and digest of base spans."""
    picked = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text].alias("text"))

    @handing_back
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [find_spans(t) for t in batch.column("text").to_pylist()]
            base = [[s for s in spans if s[0] in BASE_KINDS] for spans in rows]
            counts = {f"n_{k}": pa.array([sum(s[0] == k for s in b) for b in base], pa.int64()) for k in BASE_KINDS}
            digests = [hashlib.sha256(_joined(b).encode()).hexdigest() for b in base]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), **counts, "base_sha256": pa.array(digests, pa.string()),
                "spans": pa.array([_joined(spans) for spans in rows], pa.string())})

    return picked.mapInArrow(scan, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                                   "base_sha256 string, spans string")


def redact_documents(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The same rows and columns with personal data replaced in the text; a length column follows the text."""
    names = docs.columns

    @handing_back
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old = batch.column(text).to_pylist()
            new = [redact(t) for t in old]
            if new != old:
                batch = batch.set_column(names.index(text), text, pa.array(new, batch.schema.field(text).type))
                if length in names and pa.types.is_integer(batch.schema.field(length).type):
                    was = batch.column(length).to_pylist()
                    batch = batch.set_column(names.index(length), length, pa.array(
                        [w if a == b else len(b) for w, a, b in zip(was, old, new)], batch.schema.field(length).type))
            yield batch

    return docs.mapInArrow(clean, docs.schema)

"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds the anchors: at-signs, plus signs, scheme marks (``://``)
and identifier cues. Deterministic local parsers then expand each anchor to its boundaries and
validate what they found; digit runs anchor the IP and card parsers. Kinds, in order: ``email``,
``ip``, ``card``, ``phone`` (their matches equal the leftmost non-overlapping ones of the patterns
below), then ``address`` (scheme://host whose host is an IPv4 literal or that carries user info)
and ``account`` (an identifier after a cue: a valid IBAN, or 6 to 20 digits).

email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+
ip     [0-9]+(\\.[0-9]+){3}, each part at most 255
card   [0-9]([ -]?[0-9])+, 14 to 19 digits, Luhn
phone  \\+[0-9][ ().0-9-]+[0-9], 10 to 15 digits
A match that fails its check is dropped and the search goes on behind it.

Every step is linear in the text, so very long texts and digit runs are safe. Null and empty
texts have no spans; overlapping spans of different kinds are all kept; rows are independent, so
ties, repeats and skew do not matter; other columns are carried or ignored as the caller selects.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

KINDS = ("email", "ip", "card", "phone", "address", "account")
BASE = KINDS[:4]
# fixed values: words that announce an account identifier
CUES = ("account", "acct", "iban", "customer no", "customer id", "member id", "passport", "ssn",
        "konto", "kontonummer", "kundennummer", "cuenta", "compte", "steuernummer")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_RUN = re.compile(r"[0-9](?:[0-9 .\-]*[0-9])?")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_CARD_GAP = re.compile(r"[ -]")
_AUTHORITY = re.compile(r"[^\s/?#<>\"']+")
_IPV4_HOST = re.compile(r"([0-9]{1,3})\.([0-9]{1,3})\.([0-9]{1,3})\.([0-9]{1,3})(?::[0-9]+)?$")
_BLANKS = re.compile(r"[ \t]*")
_FILLER = re.compile(r"(?:no|nr|number|num|id|is|ist|es|est)\b\.?", re.I)
_IDENTIFIER = re.compile(r"[A-Z]{0,4}[0-9][A-Z0-9]*(?:[ -]?[A-Z0-9]+){0,8}", re.I)
_AUTOMATON = None


def _automaton():
    global _AUTOMATON
    if _AUTOMATON is None:
        a = ahocorasick.Automaton()
        for mark in ("@", "+", "://"):
            a.add_word(mark, (mark, len(mark)))
        for cue in CUES:
            for form in {cue, cue.capitalize(), cue.upper(), cue.title()}:
                a.add_word(form, ("cue", len(form)))
        a.make_automaton()
        _AUTOMATON = a
    return _AUTOMATON


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _at_most_255(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and int(part) <= 255)


def _iban(ident: str) -> bool:
    s = re.sub(r"[ -]", "", ident).upper()
    if not re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", s):
        return False
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _numbers(text: str, out: list) -> None:
    """IPs and cards: both lie inside runs of digits, dots, blanks and hyphens."""
    for run in _RUN.finditer(text):
        lo, hi = run.span()
        if hi - lo < 7:
            continue
        for m in _DOTTED.finditer(text, lo, hi):
            parts = [p.span() for p in _DIGITS.finditer(text, *m.span())]
            for k in range(0, len(parts) - 3, 4):
                four = parts[k:k + 4]
                if all(_at_most_255(text[a:b]) for a, b in four):
                    out.append((four[0][0], 1, four[3][1]))
        for m in _CARD.finditer(text, lo, hi):
            if m.end() - m.start() >= 14:
                digits = _CARD_GAP.sub("", m.group())
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))


def _after_cue(text: str, at: int) -> re.Match | None:
    """The identifier after a cue that ends before ``at``: blanks, a filler word and a mark are
    passed one after the other, so a long run of blanks is read once."""
    at = _BLANKS.match(text, at).end()
    m = _FILLER.match(text, at)
    if m:
        at = _BLANKS.match(text, m.end()).end()
    if text[at:at + 1] in (":", "#", "="):
        at = _BLANKS.match(text, at + 1).end()
    return _IDENTIFIER.match(text, at)


def find_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all personal data in a whole text, by start, then kind."""
    if not text:
        return []
    out: list[tuple[int, int, int]] = []
    email_end = phone_end = account_end = 0
    n = len(text)
    for last, (what, size) in _automaton().iter(text):
        if what == "@":
            if last < email_end:
                continue
            start = last
            while start > email_end and text[start - 1] in _LOCAL:
                start -= 1
            m = _DOMAIN.match(text, last + 1) if start < last else None
            if m:
                email_end = m.end()
                out.append((start, 0, email_end))
        elif what == "+":
            if last < phone_end:
                continue
            m = _PHONE.match(text, last)
            if m:
                phone_end = m.end()
                if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                    out.append((last, 3, phone_end))
        elif what == "://":
            start = last - 2
            while start > 0 and text[start - 1].isascii() and text[start - 1].isalpha():
                start -= 1
            m = _AUTHORITY.match(text, last + 1) if start < last - 2 else None
            if m:
                host = m.group().rpartition("@")[2]
                ip = _IPV4_HOST.match(host)
                if "@" in m.group()[1:] or ip and all(map(_at_most_255, ip.groups())):
                    out.append((start, 4, m.end()))
        else:
            start = last + 1 - size
            if start < account_end or start and text[start - 1].isalnum() \
                    or last + 1 < n and text[last + 1].isalpha():
                continue
            m = _after_cue(text, last + 1)
            if m:
                # the identifier ends with the last piece that holds a digit
                ident = m.group()
                pieces = list(re.finditer(r"[A-Za-z0-9]+", ident))
                whole = [p.end() for p in pieces if any(c.isdigit() for c in p.group())]
                for end in reversed(whole):
                    if _iban(ident[:end]):
                        break
                else:
                    end = next((p.start() for p in pieces if p.group().isalpha()), len(ident))
                    end = max([w for w in whole if w <= end], default=whole[0])
                digits = sum(c.isdigit() for c in ident[:end])
                if 6 <= digits <= 20 or _iban(ident[:end]):
                    account_end = m.start() + end
                    out.append((m.start(), 5, account_end))
    _numbers(text, out)
    out.sort()
    return [(KINDS[k], a, b) for a, k, b in out]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redact_text(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Replace every stretch of overlapping spans by the kind of its first one in brackets."""
    out, at, i = [], 0, 0
    while i < len(spans):
        kind, a, b = spans[i]
        i += 1
        while i < len(spans) and spans[i][1] < b:
            b = max(b, spans[i][2])
            i += 1
        out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans: array of (kind, start, end), n_<base kind>, base_sha256, joined) per row."""
    kind = docs.schema[id_col].dataType.simpleString()
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    names = ["id", "spans", *[f"n_{k}" for k in BASE], "base_sha256", "joined"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [find_spans(t.as_py()) for t in b.column(1)]
            base = [[s for s in f if s[0] in BASE] for f in found]
            yield pa.RecordBatch.from_arrays(
                [b.column(0),
                 pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in f] for f in found],
                          pa.list_(span)),
                 *[pa.array([sum(s[0] == k for s in f) for f in base], pa.int64()) for k in BASE],
                 pa.array([hashlib.sha256(joined(f).encode()).hexdigest() for f in base]),
                 pa.array([joined(f) for f in found], pa.string())], names=names)

    counts = ", ".join(f"n_{k} long" for k in BASE)
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")
                       ).transform(map_arrow, run, f"id {kind}, spans array<struct<kind: string, start: long,"
                                         f" end: long>>, {counts}, base_sha256 string, joined string")


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of ``text_col`` replaced by its kind; nulls stay null."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t in b.column(at):
                t = t.as_py()
                spans = find_spans(t)
                out.append(redact_text(t, spans) if spans else t)
            cols = list(b.columns)
            cols[at] = pa.array(out, b.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(cols, schema=b.schema)

    return docs.transform(map_arrow, run, docs.schema)

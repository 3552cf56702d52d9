"""Secret scan: Aho-Corasick keywords, anchored patterns at the hits, then embedded checksums.

One pass of an Aho-Corasick automaton finds every keyword of a text. Only at a
hit is the pattern of that keyword tried, anchored there; a candidate with an
embedded checksum must also pass it. Runs of hexadecimal digits have no
keyword; one linear pattern finds them.

Every row is scanned by itself, so there is no shuffle and a lost task is
simply run again. Defined results: a null or empty text has no spans, repeated
rows are scanned alike, an empty table stays empty, and extra columns are kept
(``out`` replaces a column of that name).
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in the order that decides between spans with one start.
BASE_KINDS = ("assign", "access", "hex")
ADDED_KINDS = ("github", "npm", "jwt")
KINDS = BASE_KINDS + ADDED_KINDS

SPANS = "array<struct<kind:string,start:int,end:int>>"
_SPANS_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

#: Keyword (lower case) to the kind whose pattern is tried at its start.
KEYWORDS = {
    "password": "assign",
    "passwd": "assign",
    "secret": "assign",
    "token": "assign",
    "apikey": "assign",
    "api_key": "assign",
    "akia": "access",
    "ghp_": "github",
    "gho_": "github",
    "ghu_": "github",
    "ghs_": "github",
    "ghr_": "github",
    "npm_": "npm",
    "eyj": "jwt",
}

PATTERNS = {
    "assign": re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.IGNORECASE | re.ASCII,
    ),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "github": re.compile(r"gh[pousr]_[A-Za-z0-9]+"),
    "npm": re.compile(r"npm_[A-Za-z0-9]+"),
    "jwt": re.compile(r"(eyJ[A-Za-z0-9_-]+)\.(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]*"),
}
HEX_RUN = re.compile(r"[0-9a-f]{16,}")

BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def checksum62(body: str) -> str:
    """CRC-32 of ``body`` as six base-62 digits, as issued tokens carry it at their end."""
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits


def _issued(match: re.Match) -> bool:
    body = match[0][4:]
    return len(body) == 36 and checksum62(body[:30]) == body[30:]


def _signed(match: re.Match) -> bool:
    """The first part of a signed web token is a JSON object that names an algorithm."""
    try:
        head = json.loads(base64.urlsafe_b64decode(match[1] + "=" * (-len(match[1]) % 4)))
    except (ValueError, RecursionError):
        return False
    return isinstance(head, dict) and "alg" in head


ACCEPTS = {
    "assign": lambda m: len(m[2]) >= 12,
    "access": lambda m: len(m[0]) >= 18,
    "github": _issued,
    "npm": _issued,
    "jwt": _signed,
}


def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        found.add_word(word, (len(word), kind))
    found.make_automaton()
    return found


def spans_of(text: str | None, keywords) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then kind."""
    if not text:
        return []
    spans = [("hex", m.start(), m.end()) for m in HEX_RUN.finditer(text)]
    # One capital has a lower-case form of two code points; replaced first, offsets hold.
    low = text.replace("İ", "i").lower()
    hits = sorted((end + 1 - n, kind) for end, (n, kind) in keywords.iter(low))
    resume = dict.fromkeys(PATTERNS, 0)
    for start, kind in hits:
        # A match, accepted or not, uses up its text for its own kind.
        if start >= resume[kind] and (match := PATTERNS[kind].match(text, start)):
            resume[kind] = match.end()
            if ACCEPTS[kind](match):
                spans.append((kind, start, match.end()))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def _scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    keywords = automaton()
    names = ("kind", "start", "end")
    for texts in batches:
        yield pa.array([[dict(zip(names, s)) for s in spans_of(t.as_py(), keywords)] for t in texts], _SPANS_ARROW)


def _redact(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, spans, marks in batches:
        done = []
        for text, found, mark in zip(texts, spans, marks):
            text, found = text.as_py(), found.as_py()
            if text and found:
                parts, at = [], 0
                for s in found:
                    if s["end"] > at:
                        parts += [text[at : max(at, s["start"])], mark.as_py() if s["start"] >= at else ""]
                        at = s["end"]
                text = "".join(parts) + text[at:]
            done.append(text)
        yield pa.array(done, pa.string())


def scan(docs: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """``docs`` with the secret spans of each text in ``out``."""
    find = F.arrow_udf(_typed(_scan, 1), SPANS)
    return docs.withColumn(out, find(F.col(f"`{text}`")))


def redact(docs: DataFrame, text: str = "text", mark: str = "[redacted]") -> DataFrame:
    """``docs`` with every secret span of ``text`` replaced; overlapping spans get one mark."""
    find = F.arrow_udf(_typed(_scan, 1), SPANS)
    clear = F.arrow_udf(_typed(_redact, 3), "string")
    column = F.col(f"`{text}`")
    return docs.withColumn(text, clear(column, find(column), F.lit(mark)))


def _typed(function, inputs: int):
    """Spark reads the kind of an Arrow UDF off its annotations, which must be types, not text."""
    takes = pa.Array if inputs == 1 else tuple[(pa.Array,) * inputs]
    function.__annotations__ = {"batches": Iterator[takes], "return": Iterator[pa.Array]}
    return function


def joined(spans: Column) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

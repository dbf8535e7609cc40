"""Secret scans: an Aho-Corasick automaton finds keywords, anchored expressions look only at its hits, and tokens that
carry a checksum count only if it is right.

Long hexadecimal runs have no keyword. Any run of 32 digits covers a position that leaves remainder 31 modulo 32, so
only these positions are probed, and a run is measured where one holds a digit.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from zlib import crc32

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame

ASSIGN, ACCESS, HEX, GITHUB, NPM = KINDS = ("assign", "access", "hex", "github", "npm")
# Keywords and expressions of the kinds, and the digits of the tokens' checksums.
KEYWORDS = {
    ASSIGN: ("password", "passwd", "secret", "token", "apikey", "api_key"),
    ACCESS: ("akia",),
    GITHUB: ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    NPM: ("npm_",),
}
ASSIGNMENT = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS_KEY = re.compile(r"AKIA[A-Z0-9]+")
HEX_RUN = re.compile(r"[0-9a-f]+")
HEX_DIGIT = re.compile(r"[0-9a-f]")
CHECKED_TOKEN = re.compile(r"(?:gh[pousr]|npm)_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
BASE62 = string.digits + string.ascii_uppercase + string.ascii_lowercase
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 8, 16, 32


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for word in words:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def checksum(body: str) -> str:
    """Six base-62 digits of the crc32."""
    value, digits = crc32(body.encode()), ""
    while len(digits) < 6:
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits


def hex_runs(text: str) -> Iterator[tuple[int, int]]:
    end = 0
    for probe in HEX_DIGIT.finditer(text[LEAST_HEX - 1 :: LEAST_HEX]):
        at = LEAST_HEX - 1 + LEAST_HEX * probe.start()
        if at < end:
            continue
        start = at
        while start > end and text[start - 1] in "0123456789abcdef":
            start -= 1
        end = HEX_RUN.match(text, start).end()
        if end - start >= LEAST_HEX:
            yield start, end


def scan(text: str | None, words: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in code points, end exclusive, by start and then kind."""
    if not text:
        return []
    # Lower-cases A-Z alone, so that no position moves.
    lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    found = [(HEX, start, end) for start, end in hex_runs(text)]
    ends = dict.fromkeys(KEYWORDS, 0)  # of the kind's last match: a kind's matches do not overlap
    for last, (kind, length) in words.iter(lowered):
        start = last - length + 1
        if start < ends[kind]:
            continue
        if kind == ASSIGN:
            if match := ASSIGNMENT.match(text, start):
                ends[kind] = match.end()
                if len(match[2]) >= LEAST_VALUE:
                    found.append((kind, start, match.end()))
        elif kind == ACCESS:
            if match := ACCESS_KEY.match(text, start):
                ends[kind] = match.end()
                if match.end() - start >= LEAST_ACCESS:
                    found.append((kind, start, match.end()))
        elif (match := CHECKED_TOKEN.match(text, start)) and checksum(match[1]) == match[2]:
            ends[kind] = match.end()
            found.append((kind, start, match.end()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def find_secrets(documents: DataFrame) -> DataFrame:
    """``doc_id`` and ``secrets``, an array of ``kind, start, end, value``, for every row of ``documents``.

    Null and empty texts have none. Null doc_id and repeated rows: a row each. Matches of one kind do not overlap (the
    leftmost wins); matches of different kinds may, and are ordered by start, then kind. Very long
    texts are scanned whole. Empty table: empty result.
    Other columns are ignored.
    """

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = automaton()
        for batch in batches:
            found = [
                [{"kind": k, "start": i, "end": j, "value": text[i:j]} for k, i, j in scan(text, words)]
                for text in batch["text"]
            ]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "secrets": found})

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInPandas(
        look, f"doc_id {kind}, secrets array<struct<kind:string,start:int,end:int,value:string>>"
    )

"""Secret scan: keyword automaton, anchored patterns, checksums.

An Aho-Corasick automaton finds the keywords in the lower-cased text. Only at
a hit is the kind's pattern tried, anchored at the keyword. Long hexadecimal
runs have no keyword: they are found as byte runs with numpy. Kinds whose
tokens carry a checksum are kept only when it holds.

Kinds, in order:

* assign, access, hex: leftmost non-overlapping matches of the base patterns
  below; a match that is too short is dropped but still uses up its text.
* github, npm: a prefix and 36 letters or digits, of which the last six are the
  base-62 CRC-32 of the thirty before.

Spans are code points, end exclusive, of the whole match. Defined results: a
null or empty text has no spans; repeated rows give equal rows; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoscore.llm import hashing as H

# Keywords of each kind, its pattern and the least length (of
# the last group, or of the whole match).
KINDS = ["assign", "access", "hex", "github", "npm"]
KEYWORDS = {
    "assign": ["password", "passwd", "secret", "token", "apikey", "api_key"],
    "access": ["akia"],
    "github": ["ghp_", "gho_", "ghu_", "ghs_", "ghr_"],
    "npm": ["npm_"],
}
PATTERNS = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "github": re.compile(r"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
    "npm": re.compile(r"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
}
LEAST = {"assign": 6, "access": 20, "hex": 24}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

_HEX = np.zeros(256, bool)
_HEX[[*range(48, 58), *range(97, 103)]] = True
_LOWER = bytes(H.LOWER)
_AUTOMATON = []

SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("start", T.IntegerType()),
                                  T.StructField("end", T.IntegerType())]))


def checksum_holds(body: str) -> bool:
    """Whether the last six signs are the base-62 CRC-32 of those before."""
    n, want = zlib.crc32(body[:-6].encode()), ""
    for _ in range(6):
        n, r = divmod(n, 62)
        want = BASE62[r] + want
    return want == body[-6:]


def _automaton():
    if not _AUTOMATON:
        import ahocorasick

        a = ahocorasick.Automaton()
        for kind, words in KEYWORDS.items():
            for w in words:
                a.add_word(w, (kind, len(w)))
        a.make_automaton()
        _AUTOMATON.append(a)
    return _AUTOMATON[0]


def _near_keywords(raw: bytes, low: str) -> list[tuple[int, int, int]]:
    hits = sorted((end + 1 - n, kind) for end, (kind, n) in _automaton().iter(low))
    text = raw.decode("utf-8", "surrogatepass") if hits else ""
    out, used = [], dict.fromkeys(KINDS, 0)
    for start, kind in hits:
        if start < used[kind]:
            continue
        m = PATTERNS[kind].match(text, start)
        if not m:
            continue
        used[kind] = m.end()
        if kind in LEAST:
            good = len(m[m.lastindex or 0]) >= LEAST[kind]
        else:
            good = checksum_holds(m[1])
        if good:
            out.append((KINDS.index(kind), m.start(), m.end()))
    return out


def scan(column: pa.Array) -> list[list[tuple[int, int, int]]]:
    """(kind, start, end) spans of each text, by start and kind."""
    found: list[list] = [[] for _ in range(len(column))]
    data, off = H.text_bytes(column)
    a, b = H._split_runs(_HEX[data], off)
    long = b - a >= LEAST["hex"]
    a, b = a[long], b[long]
    raw = data.tobytes()
    low = raw.translate(_LOWER)
    # code points before each byte: those of all bytes that don't continue a character
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)]) if len(a) else off
    of = np.searchsorted(off, a, "right") - 1
    for d, before, n in zip(of.tolist(), (points[a] - points[off[of]]).tolist(), (b - a).tolist()) if len(a) else ():
        found[d].append((KINDS.index("hex"), before, before + n))
    for d in range(len(column)):
        lo, hi = int(off[d]), int(off[d + 1])
        if lo < hi:
            found[d] += _near_keywords(raw[lo:hi], low[lo:hi].decode("utf-8", "surrogatepass"))
        found[d].sort(key=lambda s: (s[1], s[0]))
    return found


def spans(text: Column) -> Column:
    """Array of (kind, start, end) of each text; kind counts in KINDS."""
    @F.arrow_udf(SPANS)
    def run(column: pa.Array) -> pa.Array:
        out = []
        for part in H.slices(pa.record_batch([column], ["t"]), "t"):
            out += [[{"kind": k, "start": s, "end": e} for k, s, e in r] for r in scan(part.column(0))]
        return pa.array(out, pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])))

    return run(text)


def written_spans(found: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == KINDS.index(kind))).cast("long")

"""Benchmark decontamination by q-gram counts in diagonal bands.

Texts and items are compared in lower case with runs of white space as one
blank. An item of m characters leaks into a document when some region of the
document is within ``budget(m)`` edits of the whole item: a tenth of m, lowered
where the lemma below would promise nothing.

Q-gram lemma: such a region shares at least ``m - q + 1 - q * budget`` of the
item's q-grams, on diagonals (document position minus item position) that
differ by the budget at most. Diagonals are cut into bands that overlap by the
budget; shared q-grams are counted per band and only bands that reach the
bound are aligned, by dynamic programming on the band's diagonals.

Documents never leave their task, so neither hot passages nor hot sources move
data. The items come in blocks of about BLOCK_CHARS characters, one pass over
the documents for each, so that what a task holds doesn't grow with them.

Defined results: null and empty texts hold no leak; items that are null or
shorter than q characters match nothing; repeated items each count; repeated
documents get equal rows; empty tables give no hits; extra columns are kept
and not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoscore.llm import hashing as H
from geoscore.llm.common import free_name, written

Q = 8
BLOCK_CHARS = 2_000_000
BAND = 32
HIT = T.ArrayType(T.StructType([T.StructField("item", T.LongType()), T.StructField("distance", T.IntegerType())]))
_BUILT: dict = {}


def normal(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def budget(m: int, q: int = Q) -> int:
    """Edits allowed for an item of m characters."""
    return min(m // 10, m // q - 1)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _grams(codes: np.ndarray, q: int) -> np.ndarray:
    """32-bit hash of each q-gram."""
    n = len(codes) - q + 1
    h = np.zeros(max(n, 0), np.uint32)
    for j in range(q if n > 0 else 0):
        h = h * np.uint32(0x01000193) + codes[j: j + n]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(13)
    return h


class Items:
    """Q-gram index of a block of items (id, text)."""

    BITS = 24

    def __init__(self, items: list, q: int = Q):
        self.q = q
        self.ids, self.texts = [], []
        for item_id, text in items:
            text = normal(text)
            if len(text) >= q:
                self.ids.append(item_id)
                self.texts.append(text)
        self.codes = [_codes(t) for t in self.texts]
        self.m = np.array([len(c) for c in self.codes], np.int64)
        self.edits = np.array([budget(int(m), q) for m in self.m], np.int64)
        self.least = self.m - q + 1 - q * self.edits
        grams = [_grams(c, q) for c in self.codes]
        h = np.concatenate(grams) if grams else np.zeros(0, np.uint32)
        order = np.argsort(h, kind="stable")
        self.gram, first, self.times = np.unique(h[order], return_index=True, return_counts=True)
        self.first = first
        self.item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])[order] if grams else np.zeros(0, np.int64)
        self.place = (np.concatenate([np.arange(len(g)) for g in grams])[order] if grams else np.zeros(0, np.int64))
        self.bitmap = np.zeros(1 << self.BITS, bool)
        self.bitmap[h >> np.uint32(32 - self.BITS)] = True

    def find(self, texts: list[str]) -> list[list[tuple]]:
        """For each (normalised) text the (item, distance) that leak into it."""
        out: list[list[tuple]] = [[] for _ in texts]
        if not self.texts:
            return out
        codes = _codes("\n".join(texts))  # a line break occurs in no normalised item
        off = np.cumsum([0] + [len(t) + 1 for t in texts])
        h = _grams(codes, self.q)
        at = np.flatnonzero(self.bitmap[h >> np.uint32(32 - self.BITS)])
        pos = np.minimum(np.searchsorted(self.gram, h[at]), len(self.gram) - 1)
        hit = self.gram[pos] == h[at]
        at, pos = at[hit], pos[hit]
        times = self.times[pos]
        total = np.cumsum(times) - times
        entry = np.repeat(self.first[pos] - total, times) + np.arange(times.sum())
        at = np.repeat(at, times)
        item = self.item[entry]
        diagonal = at - self.place[entry] + int(self.m.max(initial=0))  # kept positive
        doc = np.searchsorted(off, at, "right") - 1
        e = self.edits[item]
        width = np.maximum(BAND, e + 1)
        band = diagonal // width
        shared = (diagonal % width <= e) & (band > 0)  # in the band before as well
        keys = np.concatenate([_key(doc, item, band), _key(doc[shared], item[shared], band[shared] - 1)])
        keys, count = np.unique(keys, return_counts=True)
        found: dict[tuple, int] = {}
        enough = count >= self.least[(keys >> 36) & 0xFFFFF]
        for key in keys[enough].tolist():
            d, i, b = self._unkey(key)
            known = found.get((d, i))
            if known == 0:
                continue
            distance = self._align(codes, int(off[d]), int(off[d + 1]) - 1, i, b)
            if distance is not None and (known is None or distance < known):
                found[d, i] = distance
        for (d, i), distance in found.items():
            out[d].append((self.ids[i], distance))
        return out

    @staticmethod
    def _unkey(key: int) -> tuple[int, int, int]:
        return key >> 56, (key >> 36) & 0xFFFFF, key & 0xFFFFFFFFF

    def _align(self, codes: np.ndarray, lo: int, hi: int, i: int, b: int) -> int | None:
        """Least edits of item i against the document codes[lo:hi] within the
        diagonals of band b, or None beyond the budget."""
        m, e = int(self.m[i]), int(self.edits[i])
        width = max(BAND, e + 1)
        low = b * width - int(self.m.max()) - e  # diagonals as document positions
        wide = width + 3 * e + 1
        start = max(lo, low)
        if self.texts[i] in codes[start: min(hi, low + wide + m)].tobytes().decode("utf-32-le", "surrogatepass"):
            return 0
        big = m + wide + 1
        text = np.full(m + wide + 1, -1, np.int64)  # text[x] is the character at position low + x
        a, z = max(lo, low), min(hi, low + m + wide + 1)
        if z <= a:
            return None
        text[a - low: z - low] = codes[a:z]
        k = np.arange(wide)
        # row r, diagonal k: pattern[:r] against text ending before low + k + r
        inside = (low + k >= lo) & (low + k <= hi)
        row = np.where(inside, 0, big)
        pattern = self.codes[i].astype(np.int64)
        for r in range(1, m + 1):
            same = np.minimum(row + (text[k + r - 1] != pattern[r - 1]), np.append(row[1:], big) + 1)
            end = low + k + r
            same = np.where((end >= lo) & (end <= hi), same, big)
            row = np.minimum.accumulate(same - k) + k
            row = np.where((end >= lo) & (end <= hi), row, big)
            if row.min() > e:
                return None
        return int(row.min())


def _key(doc, item, band):
    return (doc.astype(np.int64) << 56) | (item.astype(np.int64) << 36) | band.astype(np.int64)


def blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list]:
    """The items as lists of (item_id, text), about ``block_chars`` each."""
    items = benchmark.select(F.col("item_id").cast("long").alias("id"), "text").where("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // block_chars)
    for b in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == b)
        yield sorted((tuple(r) for r in part.collect()), key=lambda r: (r[0] is not None, r))


def hits(items: list, spark):
    """Function from a text column to its leaks, array of (item, distance)."""
    shared = spark.sparkContext.broadcast(items)

    @F.arrow_udf(HIT)
    def run(column: pa.Array) -> pa.Array:
        if _BUILT.get("items") is not shared.value:
            _BUILT.update(items=shared.value, index=Items(shared.value))
        out: list[list] = []
        for part in H.slices(pa.record_batch([column], ["t"]), "t", 1 << 20):
            texts = [normal(t) for t in part.column(0).to_pylist()]
            for j in range(0, len(texts), 120):  # a key has room for 127 documents
                out += _BUILT["index"].find(texts[j: j + 120])
        kind = pa.list_(pa.struct([("item", pa.int64()), ("distance", pa.int32())]))
        order = lambda x: (x[0] is not None, x)
        return pa.array([[{"item": i, "distance": d} for i, d in sorted(r, key=order)] for r in out], kind)

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, result: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` with the column ``result``: array of (item, distance)."""
    none = F.array().cast(HIT)
    for k, items in enumerate(blocks(benchmark, block_chars)):
        found = hits(items, docs.sparkSession)(F.col("text"))
        if k == 0:
            docs = docs.withColumn(result, found)
        else:
            docs = docs.withColumn(result, F.concat(result, found))
        if k:
            docs = written(docs, "leaks")
    return docs if result in docs.columns else docs.withColumn(result, none)


def clean(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without the documents that hold a leak."""
    columns, mark = docs.columns, free_name(docs, "leaks")
    return leaks(docs, benchmark, mark, block_chars).where(F.size(mark) == 0).select(*columns)

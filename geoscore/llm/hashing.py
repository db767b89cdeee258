"""Word, line and shingle hashes of Arrow string batches, computed with numpy.

Texts are read as the UTF-8 bytes of an Arrow string column. A word's 64-bit
hash is a polynomial over random byte values, taken from one running sum per
batch, so no Python loop runs per word. All functions work on whole texts and
are used inside ``mapInArrow`` / ``mapInPandas`` tasks only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_TABLE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.int64).astype(U) * U(2) + U(1)
_POWERS: dict[str, np.ndarray] = {}

# Fixed value: the white-space bytes that separate words.
SPACE_BYTES = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]
SPACE = np.zeros(256, bool)
SPACE[SPACE_BYTES] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_LOWER_TABLE = _TABLE[LOWER]


def _powers(base: int, name: str, n: int) -> np.ndarray:
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        size = max(n, 1 << 16, 0 if have is None else 2 * len(have))
        factors = np.full(size, U(base & _MASK))
        factors[0] = U(1)
        _POWERS[name] = have = np.multiply.accumulate(factors)
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every input bit over the 64 output bits."""
    h = h ^ (h >> U(33))
    h = h * U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U(33))
    h = h * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(33))


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of True."""
    padded = np.zeros(len(flags) + 2, bool)
    padded[1:-1] = flags
    edge = np.flatnonzero(padded[1:] != padded[:-1])
    return edge[::2], edge[1::2]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = _TABLE) -> np.ndarray:
    """64-bit hash of each span ``data[starts:ends]``; ``values``: a random
    number for each byte (or code point)."""
    n = len(data)
    total = np.empty(n + 1, U)
    total[0] = 0
    terms = values.take(data)
    terms *= _powers(_BASE, "up", n)[:n]
    np.cumsum(terms, out=total[1:])
    h = (total[ends] - total[starts]) * _powers(_BASE_INV, "down", n + 1)[starts]
    return mix(h + (ends - starts).astype(U))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the start of each text (plus the end).

    Nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset: column.offset + n + 1].astype(np.int64)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def span_array(data: np.ndarray, a: np.ndarray, b: np.ndarray, kind: pa.DataType = pa.binary()) -> pa.Array:
    """The spans ``data[a:b]`` as an Arrow array of bytes (or strings)."""
    ends = np.concatenate([[0], np.cumsum(b - a)])
    at = np.repeat(a - ends[:-1], b - a) + np.arange(ends[-1])
    return pa.Array.from_buffers(kind, len(a), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data[at]))])


def slices(batch: pa.RecordBatch, column: str, limit: int = 256 << 10) -> Iterator[pa.RecordBatch]:
    """Consecutive row slices of about ``limit`` text bytes (one text at least),
    which bounds the numpy scratch arrays whatever the batch size."""
    col = batch.column(batch.schema.get_field_index(column))
    _, off = text_bytes(col)
    i, n = 0, len(col)
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield batch.slice(i, j - i)
        i = j


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True):
    """Words (runs of bytes other than white space) of a batch of texts.

    Returns (hash, doc index, start, end); a word never crosses two texts."""
    starts, ends = _split_runs(~SPACE.take(data), offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(starts, offsets)))
    return span_hashes(data, starts, ends, _LOWER_TABLE if lower else _TABLE), doc, starts, ends


def _split_runs(keep: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of True, cut where a new text begins."""
    starts, ends = runs(keep)
    cut = np.unique(offsets[(offsets > 0) & (offsets < len(keep))])
    cut = cut[keep[cut] & keep[cut - 1]]
    if len(cut):
        starts = np.sort(np.concatenate([starts, cut]))
        ends = np.sort(np.concatenate([ends, cut]))
    return starts, ends


def grouped_order(group: np.ndarray, rank: np.ndarray | None, h: np.ndarray, rank_bits: int = 20) -> np.ndarray:
    """Order by (group, rank, hash); ``group`` counts up from 0.

    One 64-bit sort key holds the group, the rank and the hash's top bits;
    only when that doesn't tell two hashes apart, a full sort follows."""
    bits = rank_bits if rank is not None else 0
    top = int(group[-1]).bit_length() if len(group) else 0
    left = 64 - top - bits
    if left < 24:
        return np.lexsort((h, group) if rank is None else (h, rank, group))
    key = (group.astype(U) << U(64 - top) if top else np.zeros(len(h), U)) | (h >> U(64 - left))
    if rank is not None:
        key |= rank.astype(U) << U(left)
    order = np.argsort(key)
    key, hs = key[order], h[order]
    if ((key[1:] == key[:-1]) & (hs[1:] != hs[:-1])).any():
        return np.lexsort((h, group) if rank is None else (h, rank, group))
    return order


def shingles(word_hash: np.ndarray, doc: np.ndarray, n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingle hashes of each document, sorted by (doc, hash).

    A document of 1 to k-1 words has its whole word sequence as one shingle; a
    document without words has none. Returns (hash, doc)."""
    n = len(word_hash)
    weights = mix(np.arange(1, k + 1).astype(U)) | U(1)
    counts = np.bincount(doc, minlength=n_docs)
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    if n >= k:
        h = np.zeros(n - k + 1, U)
        for j in range(k):
            h += word_hash[j: n - k + 1 + j] * weights[j]
        same = doc[: n - k + 1] == doc[k - 1:]
        h, d = mix(h)[same], doc[: n - k + 1][same]
    else:
        h, d = np.zeros(0, U), np.zeros(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        extra = np.zeros(len(short), U)
        for j in range(k - 1):
            has = counts[short] > j
            extra[has] += word_hash[first[short[has]] + j] * weights[j]
        h = np.concatenate([h, mix(extra + counts[short].astype(U))])
        d = np.concatenate([d, short])
    if len(short):
        byd = np.argsort(d, kind="stable")
        h, d = h[byd], d[byd]
    order = grouped_order(d, None, h)
    h, d = h[order], d[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return h[new], d[new]

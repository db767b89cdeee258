"""Exact substring dedup with a two-stage suffix sort.

Texts are UTF-8 bytes. A byte is removed when a string of ``length`` (100)
bytes that covers it also starts earlier: in a smaller doc_id, or earlier in
the same document. Strings are judged on the input.

1. Equal texts: later copies are removed whole (if long enough) and only the
   first goes on.
2. Every string has an anchor, its smallest GRAM-byte gram by hash, the
   leftmost of equals; equal strings have equal anchors at equal places. Anchors
   are counted over all texts; strings whose anchor occurs once don't repeat.
3. The strings of one anchor occurrence are consecutive; the bytes they span
   go to the task of the anchor's hash. Spans that are equal within a slice of
   a map task are sent once, so a passage in a third of all documents sends a
   row for each slice.
4. Each task sorts the suffixes at the strings' starts in two stages. Suffixes
   smaller than their successor are sorted directly, eight bytes at a time, up
   to the string length. The others are induced by scanning the buckets of
   first bytes in order: from a suffix in place, the one before it falls to the
   next free place of its bucket. Common prefixes of neighbours then give the
   groups of equal strings, and all but the earliest mark their bytes.
5. The marks of a document meet its text again.

A task's memory is the spans of a chunk of whole anchors, CHUNK_BYTES or one
anchor's spans.

Defined results: a null text counts as empty; texts shorter than ``length``
lose nothing; a null doc_id sorts before all others; strings at equal places
(rows that repeat a doc_id) are not earlier than one another; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoscore.llm import hashing as H
from geoscore.llm.common import lookup, shuffle_partitions, written

LENGTH = 100
GRAM = 16
SLICE = 2 << 20
CHUNK_BYTES = 2 << 20
TASK_BYTES = 24 << 20
MOST_BROADCAST = 2_000_000
NO_ID = -(1 << 63)
U = np.uint64
_PLACE = U((1 << 34) - 1)


def anchors(data: np.ndarray, off: np.ndarray, length: int, gram: int):
    """(hash, place, first start, last start) of each anchor occurrence."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none.astype(U), none, none, none
    total = np.concatenate([np.zeros(1, U), np.cumsum(H._TABLE[data] * H._powers(H._BASE, "up", n)[:n])])
    h = H.mix((total[gram:] - total[:-gram]) * H._powers(H._BASE_INV, "down", n + 1)[: n - gram + 1])
    width = length - gram + 1
    m = len(h)
    rows = -(-m // width)
    key = np.full(rows * width, ~U(0))
    key[:m] = (h & ~_PLACE) | np.arange(m).astype(U)
    key = key.reshape(rows, width)
    ahead = np.minimum.accumulate(key, axis=1).ravel()
    back = np.minimum.accumulate(key[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = np.arange(n - length + 1)
    place = (np.minimum(back[starts], ahead[starts + width - 1]) & _PLACE).astype(np.int64)
    doc_end = np.repeat(off[1:], np.diff(off))[: len(starts)]
    good = starts + length <= doc_end
    starts, place = starts[good], place[good]
    if not len(starts):
        return none.astype(U), none, none, none
    new = np.ones(len(starts), bool)
    new[1:] = (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return h[place[first]], place[first], starts[first], starts[last]


def anchor_counts(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """(anchor, n) over all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def summed():
            h, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["anchor", "n"])

        for batch in batches:
            for part in H.slices(batch, "text", SLICE):
                held.append(anchors(*H.text_bytes(part.column("text")), length, gram)[0])
                size += len(held[-1])
                if size > 2_000_000:
                    yield summed()
                    held, size = [], 0
        if size:
            yield summed()

    return texts.select("text").mapInArrow(run, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))


SPAN = "anchor long, doc long, body long, start long, offset int, bytes binary, stop long"


def spans(texts: DataFrame, repeated: np.ndarray | None, length: int, gram: int) -> DataFrame:
    """Spans of repeated anchors. Rows without bytes are marks already: a span
    [start, stop) equal to an earlier one of the same slice."""
    shared = texts.sparkSession.sparkContext.broadcast(repeated) if repeated is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in H.slices(batch, "text", SLICE):
                data, off = H.text_bytes(part.column("text"))
                h, place, lo, hi = anchors(data, off, length, gram)
                d = np.searchsorted(off, lo, "right") - 1
                if shared is not None:
                    known = shared.value
                    pos = np.minimum(np.searchsorted(known, h), max(len(known) - 1, 0))
                    keep = known[pos] == h if len(known) else np.zeros(len(h), bool)
                else:
                    keep = np.zeros(len(h), bool)
                    marks = part.column("marks")
                    lists = np.asarray(marks.flatten()).view(U)
                    lens = np.diff(marks.offsets.to_numpy())
                    ends = np.cumsum(lens)
                    first = np.searchsorted(d, np.arange(len(part) + 1))
                    for i in range(len(part)):
                        a, b = first[i], first[i + 1]
                        keep[a:b] = np.isin(h[a:b], lists[ends[i] - lens[i]: ends[i]])
                h, place, lo, hi, d = (x[keep] for x in (h, place, lo, hi, d))
                doc, body = (part.column(c).to_numpy()[d] for c in ("doc", "body"))
                start, end = lo - off[d], hi + length
                content = H.mix(H.span_hashes(data, lo, end) + (place - lo).astype(U)) ^ h if len(lo) else h
                order = np.lexsort((start, doc, content))
                c, dd, ss = content[order], doc[order], start[order]
                new = np.ones(len(c), bool)
                new[1:] = c[1:] != c[:-1]
                group = np.cumsum(new) - 1
                head = np.flatnonzero(new)[group] if len(c) else np.zeros(0, np.int64)
                later = (dd != dd[head]) | (ss != ss[head])
                gone = np.zeros(len(c), bool)
                gone[order] = later
                raw = data.tobytes()
                yield pa.RecordBatch.from_arrays([
                    pa.array(h.view(np.int64)), pa.array(doc), pa.array(body), pa.array(start), pa.array((place - lo).astype(np.int32)),
                    pa.array([None if g else raw[a:b] for g, a, b in zip(gone.tolist(), lo.tolist(), end.tolist())], pa.binary()),
                    pa.array(start + (end - lo))], names=["anchor", "doc", "body", "start", "offset", "bytes", "stop"])

    columns = ["doc", "body", "text"] + (["marks"] if shared is None else [])
    return texts.select(*columns).mapInArrow(run, SPAN)


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as a big-endian number."""
    out = np.zeros(len(text), U)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    for j in range(8):
        out = (out << U(8)) | padded[j: j + len(text)]
    return out


def suffix_order(text: np.ndarray, wanted: np.ndarray, depth: int, word: np.ndarray | None = None) -> np.ndarray:
    """The wanted suffixes of ``text`` in order of their first ``depth`` bytes.

    Two stages: suffixes smaller than their successor are sorted directly, the
    rest are induced from the buckets of first bytes. ``word``: the text's
    :func:`_words`, if at hand."""
    n = len(text)
    t = text.astype(np.int16)
    # smaller[i]: suffix i < suffix i+1. Equal neighbours follow the next pair.
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(t[1:] - t[:-1])
    step[-1] = -1  # the last suffix is larger than the empty one
    last = np.flatnonzero(step)
    smaller = np.repeat(step[last] > 0, np.diff(last, prepend=-1))
    need = np.zeros(n, bool)
    need[wanted] = True
    # a larger suffix needs its successor, up to the next smaller one
    stops = smaller.copy()
    stops[-1] = True
    ends = np.flatnonzero(stops)
    runs_end = np.repeat(ends, np.diff(ends, prepend=-1))
    larger = np.flatnonzero(need & ~smaller)
    if len(larger):
        grow = np.zeros(n + 1, np.int64)
        np.add.at(grow, larger, 1)
        np.add.at(grow, runs_end[larger] + 1, -1)
        need |= np.cumsum(grow)[:n] > 0
    word = _words(text) if word is None else word
    direct = np.flatnonzero(need & smaller)
    direct = _sorted_directly(word, direct, depth)
    # induction by buckets of first bytes, smallest first
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    bucket_of = text[direct]
    borders = np.searchsorted(bucket_of, np.arange(257))
    if need[n - 1] and not smaller[n - 1]:
        waiting[int(text[n - 1])].append(np.array([n - 1]))
    out = []

    def send(placed, low):
        before = placed[placed > 0] - 1
        before = before[need[before] & ~smaller[before]]
        chars = text[before]
        same = before[chars == low]
        rest, rest_chars = before[chars > low], chars[chars > low]
        order = np.argsort(rest_chars, kind="stable")
        rest, rest_chars = rest[order], rest_chars[order]
        cuts = np.flatnonzero(np.diff(rest_chars)) + 1
        for group in np.split(rest, cuts):
            if len(group):
                waiting[int(text[group[0]])].append(group)
        return same

    for c in range(256):
        front = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        while len(front):  # runs of one byte induce within their bucket
            out.append(front)
            front = send(front, c)
        tail = direct[borders[c]: borders[c + 1]]
        if len(tail):
            out.append(tail)
            send(tail, c)
    order = np.concatenate(out) if out else np.zeros(0, np.int64)
    mine = np.zeros(n, bool)
    mine[wanted] = True
    return order[mine[order]]


def _sorted_directly(word: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """Places ordered by their first ``depth`` bytes, eight at a time; each
    round sorts only the places that are still tied."""
    if not len(places):
        return places
    places = places[np.argsort(word[places], kind="stable")]
    k = word[places]
    group = np.concatenate([[0], np.cumsum(k[1:] != k[:-1])])
    n = len(word)
    for at in range(8, depth, 8):
        size = np.bincount(group)
        tied = np.flatnonzero(size[group] > 1)
        if not len(tied):
            break
        p, g = places[tied], group[tied]
        inside = p + at < n
        k = np.where(inside, word[np.minimum(p + at, n - 1)], U(0))
        if at + 8 > depth:
            k = k >> U(8 * (at + 8 - depth))
        _, k = np.unique(k, return_inverse=True)
        both = (g.astype(np.int64) << 32) | k
        order = np.argsort(both, kind="stable")
        both = both[order]
        places[tied] = p[order]
        split = np.zeros(len(places), np.int64)
        split[tied[1:]] = (both[1:] != both[:-1]) & (g[1:] == g[:-1])
        group = group + np.cumsum(split)
    return places


def repeats(rows: DataFrame, length: int) -> DataFrame:
    """(doc, body, start, stop) ranges covered by strings that start earlier
    too; all spans of an anchor are in one task."""
    def chunk(doc, body, start, texts):
        lens = np.array([len(t) + 1 for t in texts], np.int64)
        text = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
        first = np.cumsum(lens) - lens
        strings = lens - length  # each span's number of strings
        span = np.repeat(np.arange(len(texts)), strings)
        inner = np.arange(len(span)) - np.repeat(np.cumsum(strings) - strings, strings)
        word = _words(text)
        order = suffix_order(text, first[span] + inner, length, word)
        # neighbours that are still equal go on to the next eight bytes
        like = np.arange(max(len(order) - 1, 0))
        for at in [*range(0, length - 7, 8), length - 8]:
            like = like[word[order[like] + at] == word[order[like + 1] + at]]
        linked = np.zeros(len(order) + 1, bool)  # to the one before
        linked[like + 1] = True
        order = order[linked[:-1] | linked[1:]]  # strings that repeat
        if not len(order):
            return None
        head = np.flatnonzero(~linked[:-1] & linked[1:])
        size = np.diff(np.append(np.cumsum(linked[:-1] | linked[1:])[head] - 1, len(order)))
        begin = np.cumsum(size) - size
        of = np.repeat(np.arange(len(texts)), lens)[order]
        d, s = doc[of], start[of] + order - first[of]
        early = d == np.repeat(np.minimum.reduceat(d, begin), size)
        least = np.minimum.reduceat(np.where(early, s, np.iinfo(np.int64).max), begin)
        gone = np.sort(order[~early | (s != np.repeat(least, size))])
        if not len(gone):
            return None
        of = np.searchsorted(first, gone, "right") - 1
        cut = np.ones(len(gone), bool)
        cut[1:] = (gone[1:] != gone[:-1] + 1) | (of[1:] != of[:-1])
        a = np.flatnonzero(cut)
        b = np.append(a[1:], len(gone)) - 1
        return [pa.array(x) for x in (doc[of[a]], body[of[a]], start[of[a]] + gone[a] - first[of[a]], start[of[b]] + gone[b] - first[of[b]] + length)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        table = pa.Table.from_batches(held) if held else None
        if table is None or not table.num_rows:
            return
        anchor = table["anchor"].to_numpy()
        order = np.argsort(anchor, kind="stable")
        anchor = anchor[order]
        texts = table["bytes"].to_pylist()
        doc, body, start = (table[c].to_numpy()[order] for c in ("doc", "body", "start"))
        size = np.cumsum([len(texts[i]) + 1 for i in order])
        new = np.flatnonzero(np.append(anchor[1:] != anchor[:-1], True)) + 1  # ends of anchors
        i = 0
        while i < len(anchor):
            base = size[i - 1] if i else 0
            fit = new[(new > i) & (size[new - 1] - base <= CHUNK_BYTES)]
            j = int(fit[-1]) if len(fit) else int(new[new > i][0])
            if j - i > 1:
                got = chunk(doc[i:j], body[i:j], start[i:j], [texts[k] for k in order[i:j]])
                if got:
                    yield pa.RecordBatch.from_arrays(got, names=["doc", "body", "start", "stop"])
            i = j

    return rows.select("anchor", "doc", "body", "start", "bytes").mapInArrow(run, "doc long, body long, start long, stop long")


CUT = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
                    T.StructField("kept", T.BinaryType()), T.StructField("kept_sha256", T.StringType())])


def _cutter(length: int, with_text: bool):
    @F.arrow_udf(CUT)
    def run(text: pa.Array, whole: pa.Array, ranges: pa.Array) -> pa.Array:
        out = []
        for t, w, r in zip(text.to_pylist(), whole.to_pylist(), ranges.to_pylist()):
            raw = (t or "").encode("utf-8", "surrogatepass")
            if w and len(raw) >= length:
                merged = [[0, len(raw)]]
            else:
                merged = []
                for a, b in sorted((x["start"], x["stop"]) for x in r or []):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
            kept, at = [], 0
            for a, b in merged:
                kept.append(raw[at:a])
                at = b
            kept = b"".join([*kept, raw[at:]])
            out.append({"n_bytes": len(raw), "n_removed": len(raw) - len(kept), "n_spans": len(merged),
                        "kept": kept if with_text else None, "kept_sha256": hashlib.sha256(kept).hexdigest()})
        return pa.array(out, pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                                        ("kept", pa.binary()), ("kept_sha256", pa.string())]))

    return run


def dedup_substrings(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, with_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept, kept_sha256) of each row of
    ``docs`` (doc_id, text); ``kept`` holds the bytes left if asked for."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
                       F.xxhash64("text").alias("body"), "text")
    copies = written(docs.groupBy("body").agg(F.min("doc").alias("first"), F.count("*").alias("n")).where(F.col("n") > 1)
                     .select("body", "first"), "copies")
    docs = docs.join(lookup(copies), "body", "left").withColumn("copy", F.coalesce(F.col("first") < F.col("doc"), F.lit(False))).drop("first")
    texts = docs.where(~F.col("copy") & (F.octet_length("text") >= length))
    repeated = written(anchor_counts(texts, length, gram).where(F.col("n") > 1).select("anchor"), "anchors")
    if repeated.count() <= MOST_BROADCAST:
        known = np.sort(repeated.toArrow()["anchor"].to_numpy().view(U))
    else:
        known = None
        texts = _marked(texts, repeated, length, gram)
    found = written(spans(texts, known, length, gram), "spans")
    sent = found.where(F.col("bytes").isNotNull())
    volume = sent.agg(F.coalesce(F.sum(F.octet_length("bytes")), F.lit(0))).first()[0]
    tasks = max(shuffle_partitions(spark), -(-volume // TASK_BYTES))
    ranges = repeats(sent.repartition(tasks, "anchor"), length).unionByName(
        found.where(F.col("bytes").isNull()).select("doc", "body", "start", "stop"))
    ranges = ranges.groupBy("doc", "body").agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))
    out = docs.join(ranges, ["doc", "body"], "left").withColumn("cut", _cutter(length, with_text)("text", "copy", "ranges"))
    return out.select("doc_id", "cut.*")


def _marked(texts: DataFrame, repeated: DataFrame, length: int, gram: int) -> DataFrame:
    """``texts`` with the repeated anchors each holds, by joins."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in H.slices(batch, "text", SLICE):
                data, off = H.text_bytes(part.column("text"))
                h, _, lo, _ = anchors(data, off, length, gram)
                d = np.searchsorted(off, lo, "right") - 1
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), part.column("doc").take(pa.array(d)),
                                                  part.column("body").take(pa.array(d))], names=["anchor", "doc", "body"])

    held = texts.select("doc", "body", "text").mapInArrow(run, "anchor long, doc long, body long")
    marks = held.join(repeated, "anchor").groupBy("doc", "body").agg(F.collect_set("anchor").alias("marks"))
    return texts.join(marks, ["doc", "body"])

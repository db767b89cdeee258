"""Exact line dedup by a prefix-filtered set-similarity join.

A line's tokens are its distinct words (white-space separated, A-Z in lower
case). A line is removed when an earlier line of the input (smaller doc_id, or
the same and a smaller line number) has a Jaccard similarity of at least
``num / den`` (4/5) with it. Earlier lines count whether or not they are
removed themselves. Lines without words are kept.

Steps:

1. Corpus counts of words in 2**BITS hash buckets. A partition leaves out
   buckets that make up less than 1 / TABLE of its words, so a sum is low by
   that share at most. The ranks of the buckets, an array of fixed size, are
   broadcast as the order of rarity; ties go by hash.
2. Each line's prefix: its rarest size - ceil(4/5 size) + 1 tokens. Similar
   lines share a token of their prefixes, and two if each is a token longer. A
   line's keys are the rare tokens of its prefix and the pairs of frequent ones
   of the longer one: two similar lines share the first token they have in
   common if it is rare, else a pair. Lines above PAIRED tokens take frequent
   tokens singly, and lines within similarity of that size do both. Equal
   token sets count as one line, first within the tasks, so a line repeated a
   million times sends a few rows.
3. Prefix rows meet by key, sent as one packed row for each batch of lines and
   partition. Pairs pass the length filter, the positional filter (tokens left
   after the shared one) and a parity bitmap of WIDE words: the bits in which
   two bitmaps differ are a lower bound of the tokens that only one line has.
   For each line its earliest CANDIDATES partners per key go on. The rows of a
   frequent key are dealt into blocks of about BLOCK rows; each pair of blocks
   meets in a task.
4. Candidates, first each line's earliest, are verified on their whole token
   sets, read again, once for each line concerned, and joined to the pairs; a
   line of many pairs is dealt over several keys.
5. Lines that had more partners than that and are undecided after the first
   meet all of them: only they ask. Only the keys under which a line had more partners are
   met again; under its others it has met all.

Any order of tokens gives the same rows; rarity only makes buckets small.

Defined results: a null text stays null and an empty text has no words; a null
doc_id sorts before all others; rows that repeat a doc_id share positions, and
only a strictly earlier position removes a line; an empty table gives an empty
result; extra columns are kept whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoscore.llm import hashing as H
from geoscore.llm.common import forget, free_name, lookup, shuffle_partitions, written

BITS = 20
TABLE = 1 << 20
CANDIDATES = 3
PAIRS_AT_ONCE = 1 << 18
BLOCK = 1 << 13  # prefix rows of a frequent key that a block holds; a task meets two blocks at a time
BUCKETS = 1 << 20  # in which the prefix rows of keys are counted
PAIRED = 64  # tokens of the longest lines that use pairs of frequent tokens as keys
ROWS_AT_ONCE = 1 << 18
MOST_BROADCAST = 2_000_000
PAIRS_AT_A_KEY = 1 << 10  # candidate pairs of a set that one key of the verifying join holds
WIDE = 3  # words of the bitmap that pairs pass when they meet
WIDE_BITS = [f"wide{k}" for k in range(WIDE)]
U = np.uint64
NO_ID = -(1 << 63)
QUIET = 62  # bit of a row's size and position that says the line asks for no partners


def line_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, doc, line number) of every word of a batch of texts."""
    data, off = H.text_bytes(column)
    h, doc, starts, _ = H.words(data, off)
    breaks = np.flatnonzero(data == 10)
    line = np.repeat(np.arange(len(breaks) + 1), np.diff(np.searchsorted(starts, breaks), prepend=0, append=len(starts)))
    return h, doc, line - np.searchsorted(breaks, off)[doc]


def word_ranks(docs: DataFrame, block: int, table: int = TABLE) -> tuple[np.ndarray, int]:
    """Rank of each hash bucket of words: 0 for rare ones, then by count; and
    the first rank of frequent words, seen more often than ``block``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held = np.zeros(1 << BITS, np.int64), [np.zeros(0, np.int64)]
        for batch in batches:
            for part in H.slices(batch, "text"):
                held.append((H.words(*H.text_bytes(part.column(0)))[0] >> U(64 - BITS)).astype(np.int64))
                if sum(map(len, held)) > 1 << BITS:
                    counts += np.bincount(np.concatenate(held), minlength=1 << BITS)
                    held = held[:1]
        counts += np.bincount(np.concatenate(held), minlength=1 << BITS)
        n = int(counts.sum())
        keep = np.flatnonzero((counts > 0) & (counts * table >= n))
        buckets = np.append(keep, -1)
        yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), pa.array(np.append(counts[keep], n))], names=["bucket", "n"])

    # a row a bucket, so a fixed number of them
    got = docs.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    bucket, n = got["bucket"].to_numpy(), got["n"].to_numpy()
    top = (bucket >= 0) & (n * table >= n[bucket < 0].sum())
    bucket, n = bucket[top], n[top]
    ranks = np.zeros(1 << BITS, np.uint32)
    ranks[bucket[np.lexsort((bucket, n))]] = np.arange(1, len(bucket) + 1)
    return ranks, 1 + int((n <= block).sum())


def _line_sets(column: pa.Array, ranks: np.ndarray):
    """Distinct tokens of each line in order of rarity: hashes, their line's
    index, and (doc, line number) of each line index."""
    h, doc, line = line_words(column)
    if not len(h):
        return h, h.astype(np.int64), doc, line
    new = np.ones(len(h), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (line[1:] != line[:-1])
    at = np.cumsum(new) - 1
    order = H.grouped_order(at, ranks[h >> U(64 - BITS)] if len(ranks) else None, h, BITS)
    hs, ats = h[order], at[order]
    first = np.ones(len(hs), bool)
    first[1:] = (hs[1:] != hs[:-1]) | (ats[1:] != ats[:-1])
    return hs[first], ats[first], doc[new], line[new]


def _set_keys(h: np.ndarray, size: np.ndarray) -> np.ndarray:
    start = np.cumsum(size) - size
    total = np.add.reduceat(H.mix(h ^ U(0x5DEECE66D)), start) if len(h) else np.zeros(0, U)
    return H.mix(total + size.astype(U)).view(np.int64)


def _keys(h: np.ndarray, at: np.ndarray, size: np.ndarray, lead: np.ndarray, often: np.ndarray, num: int, den: int):
    """(key, position of its first token, line index) of the keys under which
    lines meet, by line: the rare tokens of the prefix and, with the token that
    follows the prefix, the pairs of frequent ones. Long lines have frequent
    tokens as they are; those of nearly PAIRED tokens have both."""
    nth = np.arange(len(h)) - (np.cumsum(size) - size)[at]
    one = (nth < lead[at]) & (~often | (size[at] * den >= num * PAIRED))
    two = (nth < lead[at] + (lead[at] > 0)) & often & (size[at] <= PAIRED)
    h2, at2, nth2 = h[two], at[two], nth[two]
    # a frequent token goes with each later one of its line
    left = np.cumsum(np.bincount(at2, minlength=len(size)))[at2] - np.arange(len(h2)) - 1
    a = np.repeat(np.arange(len(h2)), left)
    b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(left) - left, left)
    pair = H.mix(h2[a] * U(0x9E3779B97F4A7C15) + h2[b])
    key, pos, line = np.concatenate([h[one], pair]), np.concatenate([nth[one], nth2[a]]), np.concatenate([at[one], at2[a]])
    order = np.argsort(line, kind="stable")
    return key[order], pos[order], line[order]


def _bytes(ends: np.ndarray, numbers: np.ndarray) -> pa.Array:
    """The numbers between each two ``ends`` as an array of bytes."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * numbers.itemsize).astype(np.int32)), pa.py_buffer(numbers)])


def _numbers(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of an array of bytes, and how many each value has."""
    if not len(column):
        return np.zeros(0, kind), np.zeros(0, np.int64)
    offset = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    ends = np.frombuffer(column.buffers()[1], offset)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[ends[0]: ends[-1]].view(kind), np.diff(ends) // np.dtype(kind).itemsize


def line_table(docs: DataFrame, ranks: np.ndarray, frequent: int, num: int, den: int) -> DataFrame:
    """(doc, body, line, set, size, WIDE_BITS, prefix, place) of every
    line with words: ``prefix`` its keys, ``place`` their first tokens'
    positions, both as the bytes of 32-bit numbers."""
    table = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in H.slices(batch, "text"):
                h, at, doc, line = _line_sets(part.column("text"), table.value)
                n = len(doc)
                size = np.bincount(at, minlength=n)
                start = np.cumsum(size) - size
                bits, bit, word = [], U(1) << ((h >> U(8)) & U(63)), (h >> U(16)) % U(WIDE)
                for k in range(WIDE):
                    mine = np.where(word == U(k), bit, U(0))
                    bits.append(np.bitwise_xor.reduceat(mine, start) if n else np.zeros(0, U))
                lead = size - -(-num * size // den) + 1
                lead[size * (den - num) < num] = 0  # so small that only an equal set is similar enough
                key, pos, owner = _keys(h, at, size, lead, table.value[h >> U(64 - BITS)] >= frequent, num, den)
                ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])
                yield pa.RecordBatch.from_arrays([
                    part.column("doc").take(pa.array(doc)), part.column("body").take(pa.array(doc)),
                    pa.array(line.astype(np.int32)), pa.array(_set_keys(h, size)), pa.array(size.astype(np.int32)), *(pa.array(b.view(np.int64)) for b in bits),
                    _bytes(ends, (key >> U(32)).astype(np.uint32)), _bytes(ends, pos.astype(np.int32))],
                    names=["doc", "body", "line", "set", "size", *WIDE_BITS, "prefix", "place"])

    wide = "".join(f"{c} long, " for c in WIDE_BITS)
    schema = f"doc long, body long, line int, set long, size int, {wide}prefix binary, place binary"
    return docs.select("doc", "body", "text").mapInArrow(run, schema)


def _prefix_of(batch: pa.RecordBatch, columns: list[str]):
    """(key, position of its first token, the columns) of each key of a batch of lines."""
    token, lens = _numbers(batch.column("prefix"), np.int32)
    pos, _ = _numbers(batch.column("place"), np.int32)
    at = np.repeat(np.arange(len(batch)), lens)
    return token, pos.astype(np.int64), {c: batch.column(c).to_numpy(zero_copy_only=False)[at] for c in columns}


def _bucket(token: np.ndarray) -> np.ndarray:
    return token.view(np.uint32).astype(np.int64) % BUCKETS


Blocks = tuple[np.ndarray, np.ndarray]


def _blocks_of(token: np.ndarray, blocks: Blocks) -> np.ndarray:
    """Number of blocks of each token."""
    bucket, n = blocks
    if not len(bucket):
        return np.ones(len(token), np.int64)
    mine = _bucket(token)
    pos = np.minimum(np.searchsorted(bucket, mine), len(bucket) - 1)
    return np.where(bucket[pos] == mine, n[pos], 1)


def token_blocks(lines: DataFrame, block: int) -> tuple[Blocks, int]:
    """Buckets of tokens with many prefix rows and their number of blocks, and
    the rows that these send. A partition leaves out buckets of less than its
    share of a block, so a count is low by a block at most."""
    share = block / max(1, lines.rdd.getNumPartitions())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held = np.zeros(BUCKETS, np.int32), []

        def add():
            bucket, n = np.unique(np.concatenate(held), return_counts=True)
            counts[bucket] += n.astype(np.int32)
            held.clear()

        for batch in batches:
            held.append(_bucket(_numbers(batch.column("prefix"), np.int32)[0]))
            if sum(map(len, held)) > ROWS_AT_ONCE:
                add()
        if held:
            add()
        keep = np.flatnonzero((counts > 0) & (counts >= share))
        yield pa.RecordBatch.from_arrays([pa.array(keep.astype(np.int32)), pa.array(counts[keep].astype(np.int64))], names=["bucket", "n"])

    got = (lines.select("prefix").where(F.octet_length("prefix") > 0).mapInArrow(run, "bucket int, n long")
           .groupBy("bucket").agg(F.sum("n").alias("n")).where(F.col("n") > block).orderBy("bucket").toArrow())
    bucket, n = got["bucket"].to_numpy().astype(np.int64), got["n"].to_numpy()
    blocks = -(-n // block) + 1
    return (bucket, blocks), int((n * blocks).sum())


def _once(batch: pa.RecordBatch) -> pa.RecordBatch:
    """One line for each set: the one of the smallest doc."""
    key, doc = batch.column("set").to_numpy(), batch.column("doc").to_numpy()
    order = np.lexsort((doc, key))
    new = np.ones(len(key), bool)
    new[1:] = key[order][1:] != key[order][:-1]
    return batch if new.all() else batch.take(pa.array(order[new]))


KEY_ROW = {"token": "int", "cell": "long", "side": "int", "set": "long", "size_pos": "long", "doc": "long", **dict.fromkeys(WIDE_BITS, "long")}
DTYPES = {"int": np.int32, "long": np.int64}


def _packed(rows: list[np.ndarray], parts: int) -> pa.RecordBatch:
    """A row for each partition: its number, and each column's numbers as bytes."""
    part = (H.mix(rows[0].view(np.uint32).astype(U) ^ rows[1].view(U) << U(32)) % U(parts)).astype(np.int64)
    order = np.argsort(part.astype(np.uint16) if parts < 1 << 16 else part, kind="stable")
    part = part[order]
    start = np.flatnonzero(np.diff(part, prepend=-1))
    ends = np.append(start, len(part))
    columns = [_bytes(ends, x[order]) for x in rows]
    return pa.RecordBatch.from_arrays([pa.array(part[start].astype(np.int32)), *columns], names=["part", *KEY_ROW])


def _unpacked(batch: pa.RecordBatch) -> list[np.ndarray]:
    """The columns of KEY_ROW of packed or plain rows."""
    out = []
    for c, kind in KEY_ROW.items():
        column = batch.column(c)
        packed = pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
        out.append(_numbers(column, DTYPES[kind])[0] if packed else column.to_numpy(zero_copy_only=False))
    return out


def key_rows(lines: DataFrame, blocks: Blocks, parts: int = 0, asked: np.ndarray | None = None) -> DataFrame:
    """KEY_ROW of each key of a line, equal sets once per batch. A token of
    several blocks has a row in the cell of each pair of blocks that its set is
    in; side: 0 where a block meets itself, else 1 and 2. ``parts``: packed into
    one row for each of so many partitions. ``asked``: flags of the buckets
    whose tokens alone are wanted."""
    shared = lines.sparkSession.sparkContext.broadcast((blocks, asked))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, asked = shared.value
        for batch in batches:
            token, pos, col = _prefix_of(_once(batch), ["set", "size", "doc", *WIDE_BITS])
            rows = [token, col["set"], col["size"].astype(np.int64) << 32 | pos, col["doc"], *(col[c] for c in WIDE_BITS)]
            if asked is not None:
                mine = asked[_bucket(token)]
                rows = [x[mine] for x in rows]
            n = _blocks_of(rows[0], blocks)
            own_block = (H.mix(rows[1].view(U) ^ U(0x9E3779B9)) % n.astype(U)).astype(np.int64)
            ends = np.cumsum(n)
            i = 0
            while i < len(n):
                base = ends[i] - n[i]
                j = max(i + 1, int(np.searchsorted(ends, base + ROWS_AT_ONCE, "right")))
                at = np.repeat(np.arange(i, j), n[i:j])
                other = np.arange(len(at)) - (ends - n - base)[at]
                own = own_block[at]
                cell = np.minimum(own, other) * n[at] + np.maximum(own, other)
                side = np.where(own == other, 0, np.where(own < other, 1, 2)).astype(np.int32)
                token, *rest = (x[at] for x in rows)
                i = j
                if parts:
                    yield _packed([token, cell, side, *rest], parts)
                else:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (token, cell, side, *rest)], names=list(KEY_ROW))

    schema = ", ".join(f"{c} {'binary' if parts else kind}" for c, kind in KEY_ROW.items())
    return lines.select("doc", "set", "size", "prefix", "place", *WIDE_BITS).where(F.octet_length("prefix") > 0).mapInArrow(
        run, f"part int, {schema}" if parts else schema)


def _distinct_rows(group: np.ndarray, key: np.ndarray, size_pos: np.ndarray, doc: np.ndarray, *others):
    """One row for each (group, set), by group: its smallest doc and position."""
    both = group.astype(U) << U(32) | key.view(U) >> U(32)
    order = np.argsort(both)
    if ((both[order][1:] == both[order][:-1]) & (key[order][1:] != key[order][:-1])).any():
        order = np.lexsort((key, group))
    g, k = group[order], key[order]
    start = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (k[1:] != k[:-1])]))
    first = order[start]
    return [g[start], k[start], np.minimum.reduceat(size_pos[order], start), np.minimum.reduceat(doc[order], start), *(x[first] for x in others)]


def meetings(rows: DataFrame, num: int, den: int, most: int | None) -> DataFrame:
    """(x, y, at, more) of the sets that share a prefix token and pass the
    filters, y not of a later document than x: for each x, token and cell
    the ``most`` earliest y and their doc, in ``more`` the token if there are
    others. A task holds the rows of its tokens and cells, works through their
    pairs PAIRS_AT_ONCE at a time and hands them on when a token is done, or at
    once if all are wanted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [_unpacked(b) for b in batches if b.num_rows]
        if not held:
            return
        token, cell, side, *cols = (np.concatenate(x) for x in zip(*held))
        held.clear()
        group = token.view(np.uint32)
        if cell.any():  # a number for each token and cell, gapless from 0
            order = np.lexsort((cell, token))
            new = np.ones(len(token), bool)
            new[1:] = (token[order][1:] != token[order][:-1]) | (cell[order][1:] != cell[order][:-1])
            group = np.empty(len(token), np.uint32)
            group[order] = np.cumsum(new) - 1
        group, key, size_pos, doc, token, side, *wide = _distinct_rows(group, *cols[:3], token, side, *cols[3:])
        del cell, cols
        new = np.diff(group.astype(np.int64), prepend=-1) != 0
        named = token[new]
        group = np.cumsum(new) - 1
        asks = size_pos >> QUIET == 0
        size, pos = size_pos >> 32 & ((1 << QUIET - 32) - 1), size_pos & 0xFFFFFFFF
        place = (group * 4 + side) << 32
        order = np.argsort(place | size)
        group, place, key, size, pos, doc, side, asks, *wide = (
            x[order] for x in (group, place, key, size, pos, doc, side, asks, *(w.view(U) for w in wide)))
        bits = reduce(np.bitwise_xor, wide)  # a bitmap of all tokens, too
        # partners: the larger ones after a row in its own block, those of similar size in the other block
        upto = np.minimum(size * den // num, (1 << 32) - 1)
        begin = np.arange(len(group)) + 1
        last = np.searchsorted(place | size, place | upto, "right")
        if side.any():
            over = place + (1 << 32)
            begin = np.where(side == 1, np.searchsorted(place | size, over | -(-num * size // den), "left"), begin)
            last = np.where(side == 1, np.searchsorted(place | size, over | upto, "right"), last)
        some = np.bincount(group, weights=asks) > 0
        count = np.where((side == 2) | ~some[group], 0, last - begin)
        sums = np.concatenate([[0], np.cumsum(count)])
        best: list[np.ndarray] = [np.zeros(0, np.int64)] * 5  # group, x, doc of y, y, others
        i, n = 0, len(group)

        def shortened(parts):
            tok, x, ydoc, y, others = (np.concatenate(c) for c in zip(*parts))
            o = np.lexsort((y, ydoc, x, tok))
            tok, x, ydoc, y, others = (c[o] for c in (tok, x, ydoc, y, others))
            new = np.ones(len(x), bool)
            new[1:] = (x[1:] != x[:-1]) | (tok[1:] != tok[:-1])
            at = np.cumsum(new) - 1
            nth = np.arange(len(x)) - np.flatnonzero(new)[at]
            keep = nth < most
            lost = np.bincount(at, weights=others + ~keep)
            return [c[keep] for c in (tok, x, ydoc, y, np.where(nth == 0, lost[at], 0).astype(np.int64))]

        def out(tok, x, ydoc, y, others):
            more = pa.array(named[tok].astype(np.int32), mask=others == 0)
            return pa.RecordBatch.from_arrays([pa.array(x), pa.array(y), pa.array(ydoc), more], names=["x", "y", "at", "more"])

        while i < n:
            j = max(i + 1, int(np.searchsorted(sums, sums[i] + PAIRS_AT_ONCE, "right")) - 1)
            a = np.repeat(np.arange(i, j), count[i:j])
            b = begin[a] + np.arange(len(a)) - np.repeat(sums[i:j] - sums[i], count[i:j])
            both = size[a] + size[b]
            need = -(-num * both // (num + den))
            apart = both - 2 * need
            good = (asks[a] | asks[b]) & (np.minimum(size[a] - pos[a], size[b] - pos[b]) >= need) & (np.bitwise_count(bits[a] ^ bits[b]) <= apart)
            a, b, apart = a[good], b[good], apart[good]
            good = sum(np.bitwise_count(w[a] ^ w[b]).astype(np.int64) for w in wide) <= apart
            a, b = a[good], b[good]
            back, on = asks[a] & (doc[a] >= doc[b]), asks[b] & (doc[b] >= doc[a])
            x, y = np.concatenate([a[back], b[on]]), np.concatenate([b[back], a[on]])
            i = j
            if not most:
                if len(x):
                    yield out(group[x], key[x], doc[y], key[y], np.zeros(len(x), np.int64))
                continue
            if len(x):
                best = shortened([best, [group[x], key[x], doc[y], key[y], np.zeros(len(x), np.int64)]])
            done = best[0] < group[i] if i < n else np.ones(len(best[0]), bool)
            if done.any():
                yield out(*(c[done] for c in best))
                best = [c[~done] for c in best]

    return rows.mapInArrow(run, "x long, y long, at long, more int")


def set_tokens(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(set, tokens) of the wanted lines (doc, body, line), each read once."""
    per_doc = written(wanted.groupBy("doc", "body").agg(F.collect_set("line").alias("want")), "wanted")
    # line numbers, no more than a document has: the bound is on their sum
    asked = per_doc.agg(F.sum(F.size("want"))).first()[0] or 0
    side = F.broadcast(per_doc) if asked <= MOST_BROADCAST else per_doc

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in H.slices(batch, "text"):
                h, at, doc, line = _line_sets(part.column("text"), np.zeros(0, np.uint32))
                size = np.bincount(at, minlength=len(doc))
                start = np.cumsum(size) - size
                want = part.column("want")
                lens = np.diff(want.offsets.to_numpy()) if len(part) else np.zeros(0, int)
                key = np.repeat(np.arange(len(part)), lens) << 32 | want.flatten().to_numpy()
                row = np.searchsorted(doc.astype(np.int64) << 32 | line, key)  # every wanted line has words
                ends = np.concatenate([[0], np.cumsum(size[row])])
                take = np.repeat(start[row] - ends[:-1], size[row]) + np.arange(ends[-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_set_keys(h, size)[row]), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(h[take].view(np.int64)))],
                    names=["set", "tokens"])

    out = written(docs.join(side, ["doc", "body"]).select("text", "want").mapInArrow(run, "set long, tokens array<long>"), "tokens")
    forget(per_doc)
    # rows that repeat a doc_id and its text read their lines again
    twice = out.groupBy("set").agg(F.count("*").alias("n")).where(F.col("n") > 1).limit(1).count()
    return out.groupBy("set").agg(F.first("tokens").alias("tokens")) if twice else out


def _dealt(pairs: DataFrame, tokens: DataFrame, side: str, keys: DataFrame) -> DataFrame:
    """``pairs`` with the tokens of their ``side``. A set of many of the pairs
    ``keys`` is dealt out, PAIRS_AT_A_KEY to a salt, its tokens once for each."""
    tokens = tokens.select(F.col("set").alias(side), F.col("tokens").alias(f"{side}_tokens"))
    often = keys.groupBy(side).count().where(F.col("count") > PAIRS_AT_A_KEY)
    if not often.limit(1).count():
        return pairs.join(tokens, side)
    often = lookup(written(often.select(side, F.ceil(F.col("count") / PAIRS_AT_A_KEY).cast("int").alias("salts")), "often"))
    salts = F.coalesce("salts", F.lit(1))
    pairs = pairs.join(often, side, "left").withColumn("salt", F.pmod(F.xxhash64("x", "y"), salts).cast("int")).drop("salts")
    copies = tokens.join(often, side, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")
    return pairs.join(copies, [side, "salt"]).drop("salt")


def first_lines(lines: DataFrame, pairs: DataFrame) -> DataFrame:
    """(set, at, body) of the sets of the pairs: their earliest line's doc and
    number, and its text's hash."""
    sets = written(pairs.select(F.col("x").alias("set")).unionByName(pairs.select(F.col("y").alias("set"))).distinct(), "sets")
    out = (lines.select("set", "doc", "line", "body").join(lookup(sets), "set")
           .groupBy("set").agg(F.min(F.struct("doc", "line", "body")).alias("f")))
    out = written(out.select("set", F.struct("f.doc", "f.line").alias("at"), "f.body"), "firsts")
    forget(sets)
    return out


def _late(docs: DataFrame, pairs: DataFrame, firsts: DataFrame, num: int, den: int) -> DataFrame:
    """Sets x of the pairs (x, y) whose y comes first and is similar enough."""
    at = {s: firsts.select(F.col("set").alias(s), F.col("at").alias(f"{s}_at"), F.col("body").alias(f"{s}_body")) for s in "xy"}
    pairs = pairs.select("x", "y").join(at["x"], "x").join(at["y"], "y").where(F.col("y_at") < F.col("x_at"))
    pairs = written(pairs.select("x", "y", "x_at", "x_body", "y_at", "y_body"), "pairs")
    wanted = [pairs.select(f"{s}_at.doc", F.col(f"{s}_body").alias("body"), f"{s}_at.line") for s in "xy"]
    tokens = set_tokens(docs, wanted[0].unionByName(wanted[1]).distinct())
    both = _dealt(_dealt(pairs.select("x", "y"), tokens, "x", pairs), tokens, "y", pairs)
    x, y = F.col("x_tokens"), F.col("y_tokens")
    common = F.size(F.array_intersect(x, y))
    similar = both.where(common * (num + den) >= num * (F.size(x) + F.size(y)))
    late = written(similar.select(F.col("x").alias("set")).distinct(), "late")
    forget(pairs)
    return late


def removed_lines(docs: DataFrame, num: int = 4, den: int = 5) -> DataFrame:
    """(doc, body, line) of the lines to remove; docs: doc, body, text."""
    parts = shuffle_partitions(docs.sparkSession)
    lines = written(line_table(docs, *word_ranks(docs, BLOCK), num, den), "lines")
    blocks, sent = token_blocks(lines, BLOCK)
    parts += -(-sent // ROWS_AT_ONCE)

    packed = key_rows(lines, blocks, parts).repartitionById(parts, F.col("part"))
    met = written(meetings(packed, num, den, CANDIDATES), "met")
    firsts = first_lines(lines, met)
    # the earliest partner settles most lines; the others' remaining partners follow
    best = met.groupBy("x").agg(F.min(F.struct("at", "y")).alias("b")).select("x", "b.y")
    late = _late(docs, best, firsts, num, den)
    undecided = met.join(late.withColumnRenamed("set", "x"), "x", "left_anti")
    rest = undecided.select("x", "y").distinct().join(best, ["x", "y"], "left_anti")
    crowded = written(undecided.where("more is not null").select(F.col("x").alias("set"), F.col("more").alias("token")).distinct(), "open")
    if crowded.limit(1).count():
        # only these ask now
        still, tokens = crowded.select("set").distinct(), crowded.select("token").distinct()
        asked = np.zeros(BUCKETS, bool)
        asked[tokens.select(F.col("token").bitwiseAND(F.lit(BUCKETS - 1)).alias("b")).distinct().toArrow()["b"].to_numpy()] = True
        quiet = F.when(F.col("asks"), F.lit(0)).otherwise(F.lit(1 << QUIET))
        rows = (key_rows(lines, blocks, asked=asked).join(lookup(tokens), "token", "left_semi")
                .join(lookup(still.withColumn("asks", F.lit(True))), "set", "left")
                .withColumn("size_pos", F.col("size_pos").bitwiseOR(quiet)).select(*KEY_ROW))
        again = (meetings(rows.repartition(parts, "token", "cell"), num, den, None).select("x", "y").distinct()
                 .join(met.select("x", "y"), ["x", "y"], "left_anti"))
        rest = written(rest.unionByName(again), "rest")
        firsts = first_lines(lines, rest)
    late = late.unionByName(_late(docs, rest, firsts, num, den))
    late = late.withColumn("late", F.lit(True))
    firsts = (lines.groupBy("set").agg(F.min(F.struct("doc", "line")).alias("first"), F.count("*").alias("n"))
              .join(late, "set", "left").where((F.col("n") > 1) | F.col("late")))
    return (lines.select("doc", "body", "line", "set").join(firsts, "set")
            .where((F.struct("doc", "line") > F.col("first")) | F.col("late")).select("doc", "body", "line").distinct())


def _without(text: Column, gone: Column) -> Column:
    """(text, n_lines, n_removed) of a text without its lines ``gone``. The
    text is split once; its lines meet flags sorted by line number, so the
    work is that of a sort of the lines, however many are gone."""
    breaks = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    n = F.when(text.isNull(), 0).otherwise(breaks + 1)

    def flagged(numbers: Column, kept: bool) -> Column:
        return F.transform(numbers, lambda i: F.struct(i.alias("line"), F.lit(kept).alias("kept")))

    kept = F.array_except(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), gone)
    flags = F.sort_array(F.concat(flagged(kept, True), flagged(gone, False)))
    # array_join leaves nulls out
    shorter = F.array_join(F.zip_with(F.split(text, "\n", -1), flags, lambda part, flag: F.when(flag["kept"], part)), "\n")
    removed = F.coalesce(F.size(gone), F.lit(0))
    return F.struct(F.when(removed > 0, shorter).otherwise(text).alias("text"), n.cast("long").alias("n_lines"),
                    F.when(text.isNull(), 0).otherwise(removed).cast("long").alias("n_removed"))


def dedup_lines(docs: DataFrame, result: str, num: int = 4, den: int = 5) -> DataFrame:
    """``docs`` (doc_id, text and others) with a struct column ``result``:
    text without the removed lines, n_lines, n_removed, and the removed line
    numbers as ``removed``."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    body = F.xxhash64("text")
    gone = (removed_lines(docs.select(doc.alias("doc"), body.alias("body"), "text"), num, den)
            .groupBy("doc", "body").agg(F.sort_array(F.collect_set("line")).alias("gone")))
    gone = written(gone, "gone")
    small = (gone.agg(F.sum(F.size("gone"))).first()[0] or 0) <= MOST_BROADCAST
    names = {c: free_name(docs, f"{c}_of_line") for c in ("doc", "body", "gone")}
    gone = gone.withColumnsRenamed(names)
    gone = F.broadcast(gone) if small else gone  # line numbers, a few bytes each
    kept = docs.withColumns({names["doc"]: doc, names["body"]: body}).join(gone, [names["doc"], names["body"]], "left")
    shorter = _without(F.col("text"), F.coalesce(names["gone"], F.array().cast("array<int>")))
    whole = F.struct(*(shorter[c].alias(c) for c in ("text", "n_lines", "n_removed")),
                     F.coalesce(names["gone"], F.array().cast("array<int>")).alias("removed"))
    return kept.withColumn(result, whole).select(*docs.columns, result)

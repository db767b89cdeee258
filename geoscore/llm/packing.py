"""Best-fit packing of token pieces with certified bin counts.

A document's ids plus one end token are cut into pieces of ``capacity``; the
first piece is the short one. Pieces are dealt to partitions by hash and each
partition packs its own by best-fit decreasing. A lower bound from
dual-feasible functions certifies a partition's bin count: when the packing
meets the bound no better one exists. Partitions with a gap exchange
documents: their bins that aren't full are emptied, the pieces dealt anew to
fewer partitions, and best-fit decreasing reruns, until all are certified, no
round gains a bin or the rounds are over. A round that doesn't lower the
count is not taken. Full pieces are sequences of their own.

The pool of a round is dealt to partitions of about PARTITION_PIECES rows, so
no task grows with the input.

Defined results: a null or empty text is one piece holding the end token; a
piece's key is (doc_id, piece), and rows that repeat a doc_id (or have none)
are packed each as a document of its own; an empty table packs to no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoscore.llm import hashing as H
from geoscore.llm.common import spread, written
from geoscore.llm.tokens import Encoder

CAPACITY = 1024
END_ID = 2
PARTITION_PIECES = 16_384
ROUNDS = 3
_ENCODERS: dict[str, Encoder] = {}

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's pieces."""
    path = path or vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _ENCODERS:
            _ENCODERS[path] = Encoder(path)
        encoder = _ENCODERS[path]
        for batch in batches:
            for part in H.slices(batch, "text", 1 << 20):
                texts = [t or "" for t in part.column("text").to_pylist()]
                rows = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32")}
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoder.encode(texts)):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    head = len(ids) % capacity or capacity
                    cuts = [0, *range(head, len(ids) + 1, capacity)]
                    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        for name, value in zip(rows, (doc_id, i, a, b - a, zlib.crc32(ids[a:b].tobytes()))):
                            rows[name].append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[n], t) for n, t in zip(rows, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                    names=list(rows))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECE_SCHEMA)


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each item (lengths in falling order) by best-fit decreasing.

    Open bins stand in one stack per free room; a bit set of the rooms in use
    finds the smallest that fits."""
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    used, bins, out = 0, 0, np.empty(len(lengths), np.int64)
    for i, need in enumerate(lengths.tolist()):
        fit = used >> need
        if fit:
            room = need + (fit & -fit).bit_length() - 1
            b = stacks[room].pop()
            if not stacks[room]:
                used &= ~(1 << room)
        else:
            room, b, bins = capacity, bins, bins + 1
        out[i] = b
        room -= need
        if room:
            stacks[room].append(b)
            used |= 1 << room
    return out


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Largest bin bound over two families of dual-feasible functions.

    Threshold t <= capacity/2: items above capacity - t count as whole bins,
    items below t as nothing, the others by length. Rounding k: an item of
    share x counts floor((k+1) x) / k, or x where (k+1) x is whole."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1)
    size = np.arange(capacity + 1)
    best = -(-int((count * size).sum()) // capacity)
    number, mass = np.cumsum(count[::-1])[::-1], np.cumsum(count * size)
    for t in range(1, capacity // 2 + 1):
        big = int(number[capacity - t + 1])
        middle = int(mass[capacity - t] - mass[t - 1])
        best = max(best, big + -(-middle // capacity))
    for k in range(1, 21):
        whole = (k + 1) * size % capacity == 0
        value = np.where(whole, size * k, (k + 1) * size // capacity * capacity)  # in 1 / (k * capacity)
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    return best


def _pack_group(capacity: int):
    """Pack one partition; ``bins`` and ``bound`` on each of its rows."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece", "row"], ascending=[False, True, True, True],
                              kind="stable", ignore_index=True)
        lengths = pdf["length"].to_numpy()
        b = best_fit(lengths, capacity)
        bins = int(b.max()) + 1
        fill = np.bincount(b, weights=lengths, minlength=bins).astype(np.int64)
        pdf["bin"] = b
        pdf["fill"] = fill[b]
        pdf["bins"] = bins
        pdf["bound"] = lower_bound(lengths, capacity)
        order = np.argsort(b, kind="stable")
        run_sum = np.cumsum(lengths[order]) - lengths[order]
        first = np.flatnonzero(np.diff(b[order], prepend=-1))
        offset = np.empty(len(b), np.int64)
        offset[order] = run_sum - np.repeat(run_sum[first], np.diff(np.append(first, len(b))))
        pdf["offset"] = offset
        return pdf
    return run


def _round(items: DataFrame, n_pieces: int, turn: int, capacity: int) -> DataFrame:
    groups = max(1, -(-n_pieces // PARTITION_PIECES))
    key = spread(F.lit(turn), "doc_id", "piece", "row")
    schema = PIECE_SCHEMA + ", row long, turn int, part int, bin long, fill long, bins long, bound long, offset long"
    packed = (items.select("doc_id", "piece", "start", "length", "ids_crc32", "row")
              .withColumn("turn", F.lit(turn)).withColumn("part", (key % groups).cast("int"))
              .withColumns({c: F.lit(0).cast("long") for c in ("bin", "fill", "bins", "bound", "offset")})
              .groupBy("part").applyInPandas(_pack_group(capacity), schema))
    return written(packed, "packed")


def pack(items: DataFrame, capacity: int = CAPACITY, rounds: int = ROUNDS) -> DataFrame:
    """Adds sequence_id and offset to pieces; also bins and bound of the
    partition that packed them (0 for full pieces)."""
    items = written(items.withColumn("row", F.monotonically_increasing_id()), "pieces")
    full = items.where(F.col("length") == capacity)
    pool = items.where(F.col("length") < capacity)
    done: list[DataFrame] = []
    n = pool.count()
    if n:
        packed = _round(pool, n, 0, capacity)
        for turn in range(1, rounds + 1):
            gap = F.col("bins") > F.col("bound")
            free = gap & (F.col("fill") < capacity)
            loose = packed.where(free)
            before = packed.where(free).agg(F.count("*").alias("n"), F.countDistinct("part", "bin").alias("bins")).first()
            if not before["n"]:
                break
            again = _round(loose, before["n"], turn, capacity)
            after = again.agg(F.countDistinct("part", "bin").alias("bins")).first()["bins"]
            if after >= before["bins"]:
                break
            done.append(packed.where(~free))
            packed = again
        done.append(packed)
    number = F.col("turn").cast("long") * (1 << 58) + F.col("part").cast("long") * (1 << 32) + F.col("bin")
    out = full.select("doc_id", "piece", "start", "length", "ids_crc32",
                      (-F.col("row") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
                      F.lit(0).cast("long").alias("bins"), F.lit(0).cast("long").alias("bound"))
    for part in done:
        out = out.unionByName(part.select("doc_id", "piece", "start", "length", "ids_crc32",
                                          number.alias("sequence_id"), "offset", "bins", "bound"))
    return out

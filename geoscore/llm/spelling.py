"""Spelling variant grouping: a relational trie walked level by level.

Words are counted over all texts; those seen often enough form the vocabulary.
Every word is put into two tries, one over its letters and one over them
reversed. A trie node is the 64-bit hash of its prefix. Nodes where no word
branches, ends or starts its search are left out, so an edge carries a label of
one or more letters; nodes and edges are tables dealt by node.

One edit leaves the first half of a word or its second half untouched. A
word's search therefore starts in either trie at the node of its untouched
half, as a state (word, position, node, edits) with no edits, and never
branches above it, where the tries are dense. Each level joins the states with
the edges of their nodes: a label is passed unchanged, or with the one edit
allowed. After its edit a state must go on unchanged, so it is kept only if the
rest of its word is among the (hashed) tails below the child. A state that ends
a word with one edit names a near word; pairs are verified. Levels go on until no state is left, one written table a level.

A node with very many words below it is split: its states are dealt over salts
and its edges repeated for each salt. The table of such nodes is broadcast; it
has HOT_NODES rows at most, since a node needs more than ``rows / HOT_NODES`` words.

Each word's form is its near word of largest count, if that count is large
enough against its own; roots follow the forms by doubling joins.

Defined results: null and empty texts hold no words; a null id counts as empty
text in the deletion rule; repeated rows count again; ties between forms go to
the smallest word in code-point order; very long words take more labels, not
more letters a level; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoscore.llm import crc
from geoscore.llm import hashing as H
from geoscore.llm.common import forget, lookup, written
from geoscore.operators.ranking import numbered

SLICE = 512 << 10
LEAST_LETTERS = 7
LEAST_COUNT = 2
FORM_TIMES = 10
FEW = 250_000  # states that are joined by broadcast (a word and three numbers each)
TAIL = 32  # letters of a word's rest that its hash takes in, beside its length
TAILS = 128  # tail hashes, kept as sets of bits
DAMAGE = 31  # a run loses a letter when this divides its checksum
HOT = 20_000  # words below a node before its states are dealt over salts
HOT_NODES = 100_000

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
# One ASCII letter for each of U+00C0 to U+00FF: words inside the tries have one byte a letter.
ACCENTED = "".join(map(chr, range(0xC0, 0x100)))
ASCII = "".join(map(chr, range(0x20, 0x60)))
_BACK = np.uint64(0x5851F42D4C957F2D)  # tells nodes of the reversed trie apart


def letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One byte a code point for a batch of texts: ASCII letters in lower case,
    U+00C0 to U+00FF by number, everything else 0.

    Returns (values, text starts plus the end, UTF-8 bytes in lower case, first
    byte and end byte of each value)."""
    data, off = H.text_bytes(column)
    low = H.LOWER[data]
    lead = data == 0xC3
    second = np.zeros(len(data), bool)
    second[1:] = lead[:-1]
    keep = ~lead
    values = np.where(second, low + np.uint8(0x40), np.where(_LETTER[data], low, np.uint8(0)))[keep]
    at = np.flatnonzero(keep)
    return values, np.concatenate([[0], np.cumsum(keep)])[off], low, at - second[at], at + 1


def _runs(part: pa.RecordBatch) -> tuple[np.ndarray, pa.Array, np.ndarray, list[str]]:
    """Distinct runs of letters of a slice of (doc_id, text) by hash, the number
    of times each stays whole, and the runs that lost a letter."""
    values, off, low, first, last = letters(part.column(1))
    a, b = H._split_runs(values != 0, off)
    long = b - a >= LEAST_LETTERS
    a, b = a[long], b[long]
    prefix = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in part.column(0).to_pylist()], np.uint32)
    hashes, one, back = np.unique(H.span_hashes(values, a, b), return_index=True, return_inverse=True)
    begin, end = first[a[one]], last[b[one] - 1]
    h = crc.joined(prefix[np.searchsorted(off, a, "right") - 1], crc.span_crc(low, begin, end)[back], (end - begin)[back])
    hit = h % DAMAGE == 0
    n = np.bincount(back[~hit], minlength=len(one))
    hit &= b - a > LEAST_LETTERS
    lost = []
    for s, e, drop in zip(a[hit].tolist(), b[hit].tolist(), (h[hit] % (b - a)[hit]).tolist()):
        run = values[s:e].tobytes()
        lost.append((run[:drop] + run[drop + 1:]).decode("latin-1"))
    some = n > 0
    return hashes[some], H.span_array(low, begin[some], end[some], pa.string()), n[some], lost


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of every word of LEAST_LETTERS or more over all texts, after
    the deletion rule; added up within a batch of texts first."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_runs(part) for part in H.slices(batch, "text", SLICE)]
            if not found:
                continue
            hashes, words, counts, lost = zip(*found)
            _, one, back = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
            total = np.bincount(back, weights=np.concatenate(counts), minlength=len(one)).astype(np.int64)
            lost = Counter(w for part in lost for w in part)
            yield pa.record_batch([pa.concat_arrays([pa.concat_arrays(words).take(pa.array(one)), pa.array(list(lost), pa.string())]),
                                   pa.array(np.concatenate([total, np.array(list(lost.values()), np.int64)]))], ["word", "n"])

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def untouched(length, backward):
    """Letters that a search from this end of a word keeps unchanged."""
    return length - length // 2 if backward else length // 2


def _prefixes(words: DataFrame) -> DataFrame:
    """(id, backward, depth, node, next, start, tail): a word's prefixes from
    the depth where a search for a near word may reach it; ``next`` is the
    letter that follows (0: the word ends), ``start`` marks the word's own
    start, ``tail`` is the hash of what follows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in H.slices(batch, "s", SLICE // 4):
                values, off = H.text_bytes(part.column(1))
                size = np.diff(off)
                ids = part.column(0).to_numpy()
                for backward in (False, True):
                    if backward:
                        of = np.repeat(np.arange(len(size)), size)
                        values = values[off[of] + off[of + 1] - 1 - np.arange(len(values))]
                    least = untouched(size - 1, backward)
                    n = size - least + 1
                    w = np.repeat(np.arange(len(size)), n)
                    depth = np.arange(len(w)) - np.repeat(np.cumsum(n) - n, n) + least[w]
                    at, end = off[w] + depth, off[w + 1]
                    node = H.span_hashes(values, off[w], at)
                    if backward:
                        node ^= _BACK
                    following = np.where(at == end, 0, np.append(values, 0)[at]).astype(np.int8)
                    tail = (crc.span_crc(values, at, np.minimum(at + TAIL, end)) + (end - at)) % TAILS
                    yield pa.record_batch(
                        [pa.array(ids[w]), pa.array(np.full(len(w), backward)), pa.array(depth.astype(np.int32)), pa.array(node.view(np.int64)),
                         pa.array(following), pa.array(depth == untouched(size[w], backward)), pa.array(tail.astype(np.int16))],
                        ["id", "backward", "depth", "node", "next", "start", "tail"])

    return words.select("id", "s").mapInArrow(
        run, "id long, backward boolean, depth int, node long, next byte, start boolean, tail short")


def _dealt(rows: DataFrame, hot: DataFrame, by: str) -> DataFrame:
    """Rows with the salt of their node."""
    return (rows.join(F.broadcast(hot), "node", "left")
            .withColumn("salt", F.coalesce(F.pmod(F.xxhash64(by), F.col("salts")), F.lit(0)).cast("int")).drop("salts"))


def _repeated(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """Rows repeated for each salt of their node."""
    return (rows.join(F.broadcast(hot), "node", "left")
            .withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("salts").cast("int"), F.lit(1)) - 1))).drop("salts"))


def _both_ways(words: DataFrame) -> DataFrame:
    """(id, backward, s) with the word as each trie spells it."""
    return (words.select("id", "s", F.explode(F.array(F.lit(False), F.lit(True))).alias("backward"))
            .withColumn("s", F.when(F.col("backward"), F.reverse("s")).otherwise(F.col("s"))))


def trie(words: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Starts (backward, node, s), edges (node, salt, out) and hot nodes (node,
    salts) of the tries of ``words`` (id, s), whose ids grow with their length.

    A node has one row, with the map ``out`` from a label's first letter to
    (label, child, ends, tails); the alphabet bounds it. ``ends`` is the word
    that ends at the child, ``tails`` the set of tail hashes below it. A node's shortest word, the one of least id, gives
    the edge that leads to it: no other word reaches further up."""
    prefixes = written(_prefixes(words), "trie-prefixes")
    tail = F.col("tail").cast("int")
    nodes = written(prefixes.groupBy("node").agg(
        F.count(F.lit(1)).alias("below"), F.min("id").alias("owner"),
        (F.max("start") | (F.min("next") == 0) | (F.min("next") != F.max("next"))).alias("kept"),
        F.array(*(F.bit_or(F.when(F.shiftright(tail, 6) == k, F.expr("shiftleft(1L, int(tail) & 63)")).otherwise(F.lit(0)))
                  for k in range(TAILS // 64))).alias("tails")), "trie-nodes")
    total = nodes.agg(F.coalesce(F.sum("below"), F.lit(0))).first()[0]
    limit = max(HOT, total // HOT_NODES)
    hot = written(nodes.where(F.col("below") > limit).select("node", F.ceil(F.col("below") / limit).alias("salts")), "trie-hot")
    kept = _repeated(nodes.where("kept").select("node", "owner", "tails"), hot)
    own = F.col("id") == F.col("owner")
    path = (_dealt(prefixes.select("id", "backward", "depth", "node"), hot, "id").join(kept, ["node", "salt"])
            .select("id", "backward", "depth", F.col("node").alias("child"), own.alias("own"), F.when(own, F.col("tails")).alias("tails")))
    above = Window.partitionBy("id", "backward").orderBy("depth")  # a word's prefixes
    edges = (path.withColumn("node", F.lag("child").over(above)).withColumn("from", F.lag("depth").over(above))
             .where("own AND node IS NOT NULL").join(_both_ways(words), ["id", "backward"])
             .select("node", F.struct(F.expr("substring(s, from + 1, depth - from)").alias("label"), "child",
                                      F.when(F.col("depth") == F.length("s"), F.col("s")).alias("ends"), "tails").alias("e"))
             .groupBy("node").agg(F.map_from_entries(F.collect_list(F.struct(F.substring("e.label", 1, 1), "e"))).alias("out")))
    edges = written(_repeated(edges, hot), "trie-edges")
    starts = written(prefixes.where("start").select("id", "backward", "node").join(_both_ways(words), ["id", "backward"])
                     .select("backward", "node", "s"), "trie-starts")
    forget(prefixes)
    forget(nodes)
    return starts, edges, hot


def near_words(words: DataFrame) -> DataFrame:
    """Ordered pairs (word, near) of ``words`` (id, word, s) that differ by
    exactly one inserted, deleted or replaced letter."""
    starts, edges, hot = trie(words)
    s, pos, edits = F.col("s"), F.col("pos"), F.col("edits")
    label, span, size = F.col("e.label"), F.length("e.label"), F.length("s")
    first, one, here, after = edits == 0, F.length("e.label") == 1, F.col("here"), F.col("after")

    def ready(states: DataFrame) -> DataFrame:
        """States with the two letters at their position and the hashes of
        what follows from it on: computed once, not for every edge."""
        def tail(at: Column) -> Column:
            return F.pmod(F.crc32(F.substring(s, at + 1, F.lit(TAIL))) + size - at, F.lit(TAILS)).cast("int")
        return states.select("backward", "node", "s", "pos", "edits", F.substring(s, pos + 1, F.lit(1)).alias("here"),
                             F.substring(s, pos + 2, F.lit(1)).alias("after"), *(tail(pos + k).alias(f"tail{k}") for k in range(3)))

    def known(k: int) -> Column:
        t = F.col(f"tail{k}")
        return F.getbit(F.get("e.tails", F.shiftright(t, 6)), t.bitwiseAND(F.lit(63))) == 1

    def near(shift: int) -> Column:
        return (pos + span + shift <= size) & (F.levenshtein(F.substring(s, pos + 1, span + shift), label, 1) == 1)

    # A label is met unchanged, or with a letter replaced, too many or too few in the
    # word; in a run of equal letters one too many or too few counts at the run's end.
    # The moves' numbers make up a mask, whose members are its row of a table: each
    # condition is evaluated once, and the generated code stays small enough to be compiled.
    moves = [
        F.when(one, (here == label) & (first | known(1))).otherwise(F.substring(s, pos + 1, span) == label),
        first & F.when(one, (here != label) & (here != "") & known(1)).otherwise(near(0)),
        first & F.when(one, (here != label) & (after == label) & known(2)).otherwise(near(1)),
        first & F.when(one, (here != label) & known(0)).otherwise(near(-1)),
    ]
    shifts = [0, 0, 1, -1]
    mask = reduce(Column.__add__, (F.when(good, 1 << k).otherwise(0) for k, good in enumerate(moves)))
    members = F.lit([[k for k in range(4) if m >> k & 1] or [-1] for m in range(16)])
    move = F.col("move")
    half = F.floor(size / 2).cast("int")
    states = ready(starts.select("backward", "node", "s", F.when(F.col("backward"), size - half).otherwise(half).alias("pos"),
                                 F.lit(0).cast("byte").alias("edits")))
    levels = []
    while True:
        # before its edit a state tries every edge, after it the one that its next letter names
        tried = F.when(first, F.map_values("out")).otherwise(F.array(F.try_element_at("out", here)))
        met = _dealt(lookup(states, FEW), hot, "s").join(edges, ["node", "salt"])
        met = met.select(*states.columns, F.explode(tried).alias("e"))
        met = met.select("backward", "s", "pos", "edits", "e", F.explode(F.get(members, mask)).alias("move")).where("move >= 0")
        met = met.select("backward", F.col("e.child").alias("node"), "s", F.col("e.ends").alias("ends"),
                         (pos + span + F.get(F.lit(shifts), move)).alias("pos"),
                         F.when(move > 0, F.lit(1)).otherwise(edits).cast("byte").alias("edits"))
        # words found lie in a folder of their own, which alone is read in the end
        level = written(met.withColumn("found", F.col("ends").isNotNull() & (pos + 1 - edits == size)), "trie-level", by="found")
        levels.append(level)
        states = ready(level.where((pos < size) | first))
        if states.isEmpty():
            break
    found = None
    for level in levels:
        part = level.where("found").select("backward", "s", "ends")
        found = part if found is None else found.unionAll(part)
    pairs = found.where(F.levenshtein("s", "ends", 1) == 1).select(*(
        F.translate(F.when(F.col("backward"), F.reverse(c)).otherwise(F.col(c)), ASCII, ACCENTED).alias(name)
        for c, name in (("s", "word"), ("ends", "near"))))
    out = written(pairs.distinct(), "near-words")
    for table in [*levels, starts, edges, hot]:
        forget(table)
    return out


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of each word of ``docs``
    (doc_id, text)."""
    counted = word_counts(docs).where(F.col("n") >= LEAST_COUNT).withColumn("s", F.translate("word", ACCENTED, ASCII))
    words = written(numbered(counted.withColumn("size", F.length("s")), [F.col("size"), F.col("s")], "id"), "words")
    pairs = near_words(words)
    best = (pairs.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
            .groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best")))
    most = -F.col("best.n")
    taken = most >= FORM_TIMES * F.col("n")
    forms = written(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(taken, F.col("best.near")).alias("form"), F.when(taken, most).alias("form_n")), "forms")
    # a form's count is FORM_TIMES the word's, so chains are short and acyclic
    jump = written(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "jumps")
    while True:
        onward = jump.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        further = written(jump.join(onward, "root", "left").select(
            "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "jumps")
        moved = not further.where("moved").isEmpty()
        forget(jump)
        jump = further
        if not moved:
            break
    return forms.join(jump.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from geoscore.llm import substrings
from geoscore.llm.substrings import dedup_substrings, suffix_order


def brute(rows, length=100):
    first = {}
    places = [((i if i is not None else float("-inf")), (t or "").encode()) for i, t in rows]
    for i, b in places:
        for s in range(len(b) - length + 1):
            w = b[s:s + length]
            first[w] = min(first.get(w, (i, s)), (i, s))
    out = []
    for (i, b), (doc_id, _) in zip(places, rows):
        gone = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - length + 1):
            if first[b[s:s + length]] < (i, s):
                gone[s:s + length] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((doc_id, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def cases():
    rnd = random.Random(6)
    letters = lambda n, a="abcdé \n": "".join(rnd.choice(a) for _ in range(n))
    passages = [letters(rnd.randint(90, 260)) for _ in range(6)]
    rows = []
    for i in range(70):
        rows.append((i, "".join(rnd.choice([letters(rnd.randint(0, 150)), rnd.choice(passages), rnd.choice(passages)[:130]]) for _ in range(4))))
    rows += [(200, rows[3][1]), (201, rows[3][1]), (150, rows[3][1] + "x"), (202, "a" * 700), (203, "ab" * 300), (204, "a" * 400 + "b" + "a" * 300),
             (205, None), (206, ""), (207, "x" * 99), (208, "x" * 99), (None, passages[0]), (209, passages[1]), (209, passages[1] + letters(20)),
             (209, passages[1]), (210, "\0" * 250), (211, letters(4000) * 2)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("most, chunk", [(10**6, 2 << 20), (0, 2000)])
def test_against_all_strings(make_docs, monkeypatch, most, chunk):
    monkeypatch.setattr(substrings, "MOST_BROADCAST", most)
    monkeypatch.setattr(substrings, "CHUNK_BYTES", chunk)
    rows = cases()
    got = dedup_substrings(make_docs(rows)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_empty_table(make_docs):
    assert dedup_substrings(make_docs([(1, "a")]).limit(0)).count() == 0


def test_suffix_order_of_whole_texts():
    rng = np.random.default_rng(2)
    for n, a in ((1, 2), (50, 1), (300, 2), (2000, 3), (3000, 255)):
        text = rng.integers(0, a + 1, n).astype(np.uint8)
        raw = text.tobytes()
        want = sorted(range(n), key=lambda i: raw[i:])
        assert suffix_order(text, np.arange(n), n + 8).tolist() == want
        part = np.sort(rng.choice(n, n // 2, replace=False))
        got = suffix_order(text, part, 16)
        keys = [raw[i:i + 16] for i in got.tolist()]
        assert keys == sorted(keys) and sorted(got.tolist()) == part.tolist()


def test_long_text_and_clashing_columns(make_docs):
    """A passage of a text beyond a slice that stands in a shorter one too, and columns named like the operator's own."""
    rng = np.random.default_rng(4)
    long = bytes(rng.integers(97, 123, 2_600_000, dtype=np.uint8)).decode()
    docs = make_docs([(2, long), (5, "!" + long[1_200_000:1_200_500] + "!"), (7, "short")])
    for c in ("anchor", "start", "doc", "row", "body", "marks", "n_bytes", "kept"):
        docs = docs.withColumn(c, F.lit("x"))
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"]) for r in dedup_substrings(docs.drop("n_bytes")).collect()}
    assert got == {2: (2_600_000, 0, 0), 5: (502, 500, 1), 7: (5, 0, 0)}


def test_bytes_are_packed_once_and_earliest_strings_stay(monkeypatch):
    """One pass over a chunk's bytes; of equal strings only those at the earliest place stay."""
    class Rows:
        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            return run

    packed, real = [], substrings._words
    monkeypatch.setattr(substrings, "_words", lambda text: packed.append(len(text)) or real(text))
    a, b = bytes(range(1, 121)), bytes(range(100, 220))
    spans = [(1, 5, 0, 30, a), (1, 4, 0, 10, a), (1, 4, 1, 10, a), (1, 4, 0, 200, a[3:110]), (1, 9, 0, 0, b), (2, 3, 0, 7, b)]
    names = ["anchor", "doc", "body", "start", "bytes"]
    table = pa.table({n: list(c) for n, c in zip(names, zip(*spans))})
    got = pa.Table.from_batches(substrings.repeats(Rows(), 100)(iter(table.to_batches()))).to_pylist()
    # the same place in a row that repeats the doc_id is not earlier
    assert sorted((r["doc"], r["start"], r["stop"]) for r in got) == [(4, 200, 307), (5, 30, 150), (9, 0, 120)]
    assert packed == [sum(len(s[4]) + 1 for s in spans)]

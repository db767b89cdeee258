import random
import re

import numpy as np
from pyspark.sql import functions as F

from geoscore.llm import shingles
from geoscore.llm.shingles import STEP, blocks, near_duplicates, needed, signatures

from .conftest import noisy_texts


def shingle_set(text, k=5):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} - {()}


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    comp = list(range(len(rows)))

    def root(a):
        while comp[a] != a:
            a = comp[a]
        return a

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                comp[root(i)] = root(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((d, len(sets[i]), min(ids, default=None)))
    return sorted(out, key=str)


def check(make_docs, rows):
    got = near_duplicates(make_docs(rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_components_against_all_pairs(make_docs, monkeypatch):
    monkeypatch.setattr(shingles, "RARE", 3)  # small data, so that all classes occur
    monkeypatch.setattr(shingles, "VERY", 8)
    monkeypatch.setattr(shingles, "LARGE", 5)
    texts = noisy_texts(5, 260, lines=(1, 4), words=(1, 30), edits=0.12)
    base = " ".join(f"v{i}" for i in range(400))
    rnd = random.Random(9)
    family = [" ".join(w if rnd.random() > e else f"n{rnd.random()}" for w in base.split()) for e in [0.004, 0.02, 0.05] * 12]
    rows = list(enumerate(texts + family + [base] * 5 + [base.upper(), base + " x", "a b c d", "A b c d", "a", "a"]))
    rows += [(None, base), (None, None), (7000, None), (7001, ""), (7002, " \n"), (7003, "a b c"), (7003, "a b c"), (7003, "q")] + [(7004, base + " y z")] * 3
    check(make_docs, rows)


def test_copies_only_and_empty_table(make_docs):
    check(make_docs, [(3, "a b c d e f")] * 4 + [(1, "A b c d e  f")])
    assert near_duplicates(make_docs([(1, "a")]).limit(0)).count() == 0


def test_whole_sets_always_reach_their_credits():
    for size in range(4, 4000):
        own = int(np.searchsorted(STEP, size, "right")) - 1
        for tag in (own, own + 1):
            pairs, triples = blocks(tag)
            assert size - pairs - 2 * triples >= size - needed(size, 4, 5) + 1 or size < 12
    rnd = np.random.default_rng(1)
    for size in range(4, 40):  # small sizes: by trial over class patterns
        for _ in range(40):
            tokens = np.sort(rnd.integers(0, 1 << 62, size).astype(np.uint64))
            kind = rnd.integers(1, 4, size)
            for lost in (rnd.choice(size, size - needed(size, 4, 5), replace=False) for _ in range(5)):
                rest = np.delete(tokens, lost)
                if len(rest) * 5 < size * 4 or len(rest) < 4:
                    continue
                keep = np.isin(tokens, rest)
                a = signatures(tokens, kind == 2, kind == 3, 4, 5)
                b = signatures(rest, (kind == 2)[keep], (kind == 3)[keep], 4, 5)
                assert np.isin(a, b).any()


def test_long_texts_and_clashing_columns(make_docs):
    """A text beyond a slice, its copy with a few edits, and columns named like the operator's own."""
    words = [f"w{i % 7919}x{i // 7919}" for i in range(90000)]
    edited = list(words)
    for k in range(0, 90000, 9000):
        edited[k] = "other"
    docs = make_docs([(5, " ".join(words)), (3, " ".join(edited)), (9, " ".join(words[:45000])), (1, "a b c d e f"), (1, "a b c d e f")])
    for c in ("key", "sig", "doc", "row", "component", "n", "text_", "hash"):
        docs = docs.withColumn(c, F.lit("x"))
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_duplicates(docs).select("doc_id", "n_shingles", "component_id").collect()}
    assert got == {(5, 89996, 3), (3, 89996, 3), (9, 44996, 9), (1, 2, 1)}

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from geoscore.llm import packing
from geoscore.llm.packing import best_fit, lower_bound, pack, pieces, vocabulary
from geoscore.llm.tokens import Encoder


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(vocabulary())


def odd_texts():
    rnd = random.Random(3)
    signs = list("ab 's\n\t.1é' tlrevmd!中\x85\x1c")
    fixed = ["", " ", "  a", "\n a", "it's", "don't!'s", "''s", "'stuff", "a  b ", "<|endoftext|> a", "a<|endoftext|>b", "½ x²", "\t\tx", "é'd 中文"]
    return fixed + ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 40))) for _ in range(4000)]


def test_ids_equal_the_tokenizer(tokenizer, monkeypatch):
    monkeypatch.setattr(Encoder, "MAX_WORDS", 3000)  # the word table starts anew now and then
    encoder, texts = Encoder(vocabulary()), odd_texts()
    for i in range(0, len(texts), 500):
        for t, ids in zip(texts[i:i + 500], encoder.encode(texts[i:i + 500])):
            assert ids.tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_pieces_and_packing(make_docs, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "PARTITION_PIECES", 60)
    rnd = random.Random(5)
    rows = [(i, " ".join(rnd.choice(["the", "of", "qzx", "é"]) for _ in range(rnd.randint(0, 900)))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (None, "x"), (1002, "y"), (1002, "y"), (1003, "w " * 9000)]
    got = pack(pieces(make_docs(rows))).collect()
    want = defaultdict(list)
    for i, t in rows:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        want[i] += [(p, a, b - a, zlib.crc32(ids[a:b].tobytes())) for p, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    have, bins = defaultdict(list), defaultdict(list)
    for r in got:
        have[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(bins) <= 1.06 * -(-sum(r["length"] for r in got) // 1024) + 1
    assert pack(pieces(make_docs(rows[:1]).limit(0))).count() == 0


def test_bound_and_best_fit():
    rng = np.random.default_rng(1)
    for _ in range(50):
        lengths = np.sort(rng.integers(1, 101, rng.integers(1, 12)))[::-1]
        b = best_fit(lengths, 100)
        assert np.bincount(b, weights=lengths).max() <= 100
        # fewest bins by trying all fillings
        best = len(lengths)

        def place(i, rooms):
            nonlocal best
            if len(rooms) >= best:
                return
            if i == len(lengths):
                best = len(rooms)
                return
            for k in range(len(rooms)):
                if rooms[k] >= lengths[i] and rooms[k] not in rooms[:k]:
                    place(i + 1, rooms[:k] + [rooms[k] - lengths[i]] + rooms[k + 1:])
            place(i + 1, rooms + [100 - lengths[i]])

        place(0, [])
        assert lower_bound(lengths, 100) <= best <= b.max() + 1

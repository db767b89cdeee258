"""Token ids of whole texts by a byte-level BPE vocabulary file.

The vocabulary's word pattern is applied to a batch of texts with numpy; each
distinct word of a task is encoded once by the tokenizer and its ids reused
for every occurrence. Texts that hold one of the tokenizer's added tokens go
through the tokenizer whole, so ids equal ``Tokenizer.encode(text,
add_special_tokens=False)`` for every text.
"""

from __future__ import annotations

import sys
import unicodedata

import numpy as np

from geoscore.llm import hashing as H

U = np.uint64

# The word pattern of the vocabulary is
# 's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
SUFFIXES = ["s", "t", "re", "ve", "m", "ll", "d"]
# The code points with Unicode's White_Space property.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
               0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
_TABLES: dict[str, np.ndarray] = {}


def _kinds() -> np.ndarray:
    if "kind" not in _TABLES:
        first = {"L": LETTER, "N": NUMBER}
        kind = np.array([first.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)], np.uint8)
        kind[WHITE_SPACE] = SPACE
        _TABLES["kind"] = kind
        rng = np.random.default_rng(7)
        _TABLES["value"] = rng.integers(1, 1 << 63, len(kind), dtype=np.int64).astype(U) * U(2) + U(1)
    return _TABLES["kind"]


def split(codes: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pattern's words over code points of several
    texts (``off``: each text's start, and the end)."""
    n = len(codes)
    kind = _kinds()[codes]
    head = np.zeros(n + 1, bool)  # a text begins here
    head[off] = True
    new = np.ones(n, bool)
    new[1:] = kind[1:] != kind[:-1]
    new |= head[:n]
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], n)
    k = kind[starts]
    # White space before a word of the same text: its last sign goes with the
    # word if it is a blank, and stands alone if not.
    joined = np.zeros(len(starts), bool)
    joined[1:] = (k[:-1] == SPACE) & ~head[starts[1:]]
    before = joined & (codes[starts - 1] == 32) & (starts > 0)
    tail = np.zeros(len(starts), bool)
    tail[:-1] = (k[:-1] == SPACE) & ~head[starts[1:]]
    blank = tail & (codes[ends - 1] == 32)
    word_start = starts - before
    word_end = ends - blank
    alone = tail & ~blank & (ends - starts > 1)
    word_end = word_end - alone
    keep = word_end > word_start
    # Contractions: an apostrophe run of length one, without a blank before,
    # followed at once by one of the suffixes.
    mark = np.flatnonzero((k == OTHER) & (codes[starts] == 39) & (ends - starts == 1) & ~before)
    mark = mark[(mark + 1 < len(starts))]
    mark = mark[(k[mark + 1] == LETTER) & ~head[starts[mark + 1]]] if len(mark) else mark
    for m in mark:
        s, e = starts[m + 1], ends[m + 1]
        for suffix in SUFFIXES:
            if e - s >= len(suffix) and all(codes[s + i] == ord(x) for i, x in enumerate(suffix)):
                word_end[m] = s + len(suffix)
                word_start[m + 1] = s + len(suffix)
                keep[m + 1] = word_end[m + 1] > word_start[m + 1]
                break
    a = np.concatenate([word_start[keep], ends[alone] - 1])
    b = np.concatenate([word_end[keep], ends[alone]])
    order = np.argsort(a, kind="stable")
    return a[order], b[order]


class WordTable:
    """Ids of the words met so far, found by word hash.

    Two sorted tables: new words enter the small one, which is merged into the
    large one when it has grown to a quarter of it."""

    def __init__(self):
        self.tables = [[np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64)] for _ in range(2)]
        self.flat: list[np.ndarray] = [np.zeros(0, np.uint32)]

    def __len__(self):
        return sum(len(t[0]) for t in self.tables)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, count) in the flat ids of each hash; start -1: unknown."""
        start, count = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        for known, starts, counts in self.tables:
            if len(known):
                pos = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                hit = known[pos] == hashes
                start[hit], count[hit] = starts[pos[hit]], counts[pos[hit]]
        return start, count

    def add(self, hashes: np.ndarray, ids: list[list[int]]):
        counts = np.array([len(x) for x in ids], np.int64)
        starts = sum(map(len, self.flat)) + np.cumsum(counts) - counts
        self.flat.append(np.array([i for x in ids for i in x], np.uint32))
        self._into(1, [hashes, starts, counts])
        if len(self.tables[1][0]) > max(50_000, len(self.tables[0][0]) // 4):
            self._into(0, self.tables[1])
            self.tables[1] = [x[:0] for x in self.tables[1]]
            self.flat = [np.concatenate(self.flat)]

    def _into(self, k: int, rows: list[np.ndarray]):
        both = [np.concatenate(x) for x in zip(self.tables[k], rows)]
        order = np.argsort(both[0], kind="stable")
        self.tables[k] = [x[order] for x in both]

    def ids(self) -> np.ndarray:
        if len(self.flat) > 8:
            self.flat = [np.concatenate(self.flat)]
        return self.flat[0] if len(self.flat) == 1 else np.concatenate(self.flat)


class Encoder:
    """Encodes lists of texts; keeps the ids of the words met so far."""

    MAX_WORDS = 1_500_000  # bounds the word table's memory; it starts anew beyond

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = self._word_encoder(path)
        self.table = WordTable()

    def _word_encoder(self, path: str):
        """Function from a list of words to their ids.

        When the ids of the merged tokens stand in merge order, merging by
        smallest id is the same rule, and the faster ``tiktoken`` applies it
        to the file's own vocabulary; else the tokenizer encodes the words."""
        import json

        import tiktoken

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        merged = [model["vocab"].get(a + b) for a, b in pairs]
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [x for x in range(256) if x not in visible]
        byte_of = {chr(x): x for x in visible} | {chr(256 + i): x for i, x in enumerate(hidden)}
        if None in merged or merged != sorted(merged):
            return lambda words: [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in self.added}
        fast = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        return lambda words: [fast.encode_ordinary(w) for w in words]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids (uint32) of each text."""
        special = [any(a in t for a in self.added) for t in texts]
        plain = ["" if s else t for t, s in zip(texts, special)]
        joined = "".join(plain)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        off = np.concatenate([[0], np.cumsum([len(t) for t in plain])]).astype(np.int64)
        if not len(codes):
            out = [np.zeros(0, np.uint32) for _ in texts]
        else:
            a, b = split(codes, off)
            h = H.span_hashes(codes, a, b, _TABLES["value"])
            distinct, first, at = np.unique(h, return_index=True, return_inverse=True)
            start, count = self.table.find(distinct)
            new = start < 0
            if len(self.table) + new.sum() > self.MAX_WORDS and new.any():
                self.table = WordTable()
                new = np.ones(len(distinct), bool)
            if new.any():
                self.table.add(distinct[new], self.words([joined[a[i]: b[i]] for i in first[new]]))
                start, count = self.table.find(distinct)
            start, count = start[at], count[at]
            total = np.concatenate([[0], np.cumsum(count)])
            flat = self.table.ids()[np.repeat(start - total[:-1], count) + np.arange(total[-1])]
            cut = total[np.searchsorted(a, off[1:], "left")]
            out = np.split(flat, cut[:-1]) if len(texts) > 1 else [flat]
        for i, s in enumerate(special):
            if s:
                out[i] = np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, np.uint32)
        return out

import itertools
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from geoscore.llm import lines
from geoscore.llm.lines import dedup_lines

from .conftest import noisy_texts

ODD = [(None, "a b c d e"), (None, None), (5000, None), (5001, ""), (5002, "\n\n"), (5003, "A b C d e\nx"),
       (5003, "A b C d e\nx"), (5003, "y z\nx"), (5004, "a b c d"), (5005, "é É\x0bü q"), (5006, "é É ü q r"),
       (5007, " ".join(f"long{i}" for i in range(30000))), (5008, " ".join(f"long{i}" for i in range(29000)))]


def brute(rows):
    """doc position -> removed line numbers, by comparing all lines."""
    found = []
    for k, (i, t) in enumerate(rows):
        for j, line in enumerate((t or "").split("\n")):
            words = {re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", line)}
            if words:
                found.append((i if i is not None else float("-inf"), j, k, words))
    gone = {k: [] for k in range(len(rows))}
    for a, b, k, x in found:
        if any((c, d) < (a, b) and len(x & y) * 5 >= len(x | y) * 4 for c, d, _, y in found):
            gone[k].append(b)
    return gone


def result(df):
    return sorted((str(r["doc_id"]), r["text"] or "", r["r"]["removed"], r["r"]["text"]) for r in df.collect())


def expected(rows):
    gone = brute(rows)
    out = []
    for k, (i, t) in enumerate(rows):
        kept = None if t is None else "\n".join(p for j, p in enumerate(t.split("\n")) if j not in set(gone[k]))
        out.append((str(i), t or "", gone[k], kept))
    return sorted(out, key=lambda r: (r[0], r[1], r[2]))


@pytest.mark.parametrize("candidates, at_once", [(3, 1 << 20), (1, 50)])
def test_lines_against_all_pairs(make_docs, monkeypatch, candidates, at_once):
    monkeypatch.setattr(lines, "CANDIDATES", candidates)
    monkeypatch.setattr(lines, "PAIRS_AT_ONCE", at_once)
    rows = list(enumerate(noisy_texts(1, 250))) + ODD
    assert result(dedup_lines(make_docs(rows), "r")) == expected(rows)


@pytest.mark.parametrize("block, paired", [(1, 64), (10, 10), (40, 4)])
def test_frequent_tokens_meet_in_pairs(make_docs, monkeypatch, block, paired):
    """Lines on both sides of the length from which frequent tokens are taken singly."""
    monkeypatch.setattr(lines, "BLOCK", block)
    monkeypatch.setattr(lines, "PAIRED", paired)
    rows = list(enumerate(noisy_texts(7, 160, words=(3, 24), edits=0.3))) + ODD
    assert result(dedup_lines(make_docs(rows), "r")) == expected(rows)


def test_clashing_columns_and_empty_table(make_docs):
    docs = make_docs([(1, "a b c"), (2, "a b c\nd")])
    for c in ("doc_of_line", "body", "line", "set", "doc", "gone_of_line", "size", "x"):
        docs = docs.withColumn(c, F.lit(7))
    got = dedup_lines(docs, "r")
    assert got.columns == docs.columns + ["r"]
    assert {(r["doc_id"], r["r"]["text"]) for r in got.collect()} == {(1, "a b c"), (2, "d")}
    assert dedup_lines(docs.limit(0), "r").count() == 0


def family(words=14):
    """Distinct lines of one template with two variable words that are more common than its fixed ones."""
    common = [f"v{i}" for i in range(words)]
    rows = [" ".join([f"fix{i}" for i in range(15)] + list(c)) for c in itertools.combinations(common, 2)]
    return rows + [f"{c} alone{i}" for i in range(words * words // 2) for c in common]


def test_frequent_token_meets_in_blocks(make_docs, monkeypatch):
    monkeypatch.setattr(lines, "BLOCK", 8, raising=False)
    monkeypatch.setattr(lines, "ROWS_AT_ONCE", 100, raising=False)
    largest, real = [], lines.meetings

    def spy(rows, *args):
        key = [c for c in ("token", "cell") if c in rows.columns]
        largest.append(rows.distinct().groupBy(*key).count().agg(F.max("count")).first()[0] or 0)
        return real(rows, *args)

    monkeypatch.setattr(lines, "meetings", spy)
    rows = list(enumerate(noisy_texts(5, 120, words=(9, 14)))) + [(i + 1000, t) for i, t in enumerate(family())]
    assert result(dedup_lines(make_docs(rows), "r")) == expected(rows)
    assert max(largest) <= 5 * 8


def test_line_of_many_pairs_is_read_once(make_docs, monkeypatch):
    monkeypatch.setattr(lines, "PAIRS_AT_A_KEY", 10, raising=False)
    wanted, real = [], lines.written

    def spy(df, kind):
        out = real(df, kind)
        if kind == "wanted":
            wanted.append(out.agg(F.max(F.size("want"))).first()[0] or 0)
        return out

    monkeypatch.setattr(lines, "written", spy)
    base = [f"b{i}" for i in range(20)]
    rows = [(0, " ".join(base))] + [(i, " ".join(base[:i % 20] + [f"c{i}"] + base[i % 20 + 1:])) for i in range(1, 60)]
    rows += [(0, " ".join(base)), (70, "p q r s t u v w x\np q r s t u v w x z"), (70, "p q r s t u v w x\np q r s t u v w x z")]
    assert result(dedup_lines(make_docs(rows), "r")) == expected(rows)
    assert max(wanted) <= 2


def test_only_crowded_keys_meet_again(make_docs, monkeypatch):
    """Under a key without further partners a line has met all of them."""
    monkeypatch.setattr(lines, "CANDIDATES", 1)
    crowded, again, real = set(), set(), lines.meetings

    def spy(rows, num, den, most):
        found = real(rows, num, den, most)
        if most:
            crowded.update(r["more"] for r in found.where(F.col("more").isNotNull()).collect())
        else:
            again.update(r["token"] for r in rows.select("token").distinct().collect())
        return found

    monkeypatch.setattr(lines, "meetings", spy)
    rows = list(enumerate(noisy_texts(11, 200, words=(6, 16), edits=0.4)))
    assert result(dedup_lines(make_docs(rows), "r")) == expected(rows)
    assert again and again <= crowded


def test_key_rows_travel_packed(make_docs, monkeypatch):
    """A shuffled row for each batch of lines and partition, not for each key; few tables are written."""
    sent, kinds, real, write = [], [], lines.meetings, lines.written

    def spy(rows, num, den, most):
        if most:
            sent.append((rows.count(), rows.rdd.getNumPartitions()))
        return real(rows, num, den, most)

    monkeypatch.setattr(lines, "meetings", spy)
    monkeypatch.setattr(lines, "written", lambda df, kind: kinds.append(kind) or write(df, kind))
    rows = list(enumerate(noisy_texts(13, 400, words=(6, 20)))) + ODD
    docs = make_docs(rows).coalesce(1)
    assert result(dedup_lines(docs, "r")) == expected(rows)
    (n, parts), = sent
    assert n <= 3 * parts
    assert not {"words", "often", "still"} & set(kinds)


def test_packed_rows_come_back(make_docs):
    rng = np.random.default_rng(3)
    kinds = list(lines.KEY_ROW.values())
    rows = [rng.integers(-(1 << 31), 1 << 31, 500).astype(lines.DTYPES[k]) for k in kinds]
    rows[1] = rng.integers(0, 2, 500)
    packed = lines._packed(rows, 7)
    assert packed.num_rows == 7
    back = lines._unpacked(packed.slice(0, 3)), lines._unpacked(packed.slice(3))
    assert sorted(zip(*(np.concatenate(x) for x in zip(*back)))) == sorted(zip(*rows))
    assert not set(zip(*back[0][:2])) & set(zip(*back[1][:2]))  # a token's cell stays together


@pytest.mark.parametrize("texts", [[], [None, ""], ["\n\n a\n", "b", "", "c d\ne", " "]])
def test_words_know_their_line(texts):
    h, doc, line = lines.line_words(pa.array(texts, pa.string()))
    assert list(zip(doc.tolist(), line.tolist())) == [(i, j) for i, t in enumerate(texts) for j, p in enumerate((t or "").split("\n")) for _ in p.split()]
    assert len(h) == len(doc)


def test_a_long_text_is_split_once(spark):
    n = 20_000
    text = "\n".join(f"line {i}" for i in range(n))
    row = spark.createDataFrame([(text, list(range(0, n, 2))), ("a\n\n", [0]), ("a\n", [0, 1]), ("é\n", []), (None, [])], "text string, gone array<int>")
    got = row.select(lines._without(F.col("text"), F.col("gone")).alias("r"))
    assert "split" not in "".join(p.split("lambdafunction(")[1].split("))")[0] for p in str(got._jdf.queryExecution().analyzed()).split("transform(")[1:])
    rows = [tuple(r["r"]) for r in got.collect()]
    assert rows[0] == ("\n".join(f"line {i}" for i in range(1, n, 2)), n, n // 2)
    assert rows[1:] == [("\n", 3, 1), ("", 2, 2), ("é\n", 2, 0), (None, 0, 0)]

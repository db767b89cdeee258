import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from geoscore.llm.sharding import shard


def check(make_docs, rows):
    got = shard(make_docs(rows).withColumn("size", F.lit(1)).withColumn("shard", F.lit("x"))).collect()
    assert len(got) == len(rows)
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots, load, homes = defaultdict(list), Counter(dict.fromkeys(range(16), 0)), defaultdict(Counter)
    for r in got:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < 16
        slots[r["shard"]].append(r["slot"])
        load[r["shard"]] += r["size"]
        homes[r["text_crc32"]][r["shard"]] += 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return load, homes


def test_equal_sizes_and_copies_together(make_docs):
    rnd = random.Random(1)
    rows = [(i, "".join(rnd.choice("abcé ") for _ in range(rnd.randint(0, 300)))) for i in range(3000)]
    rows += [(5000 + i, rows[i % 200][1]) for i in range(600)]
    rows += [(None, None), (7000, ""), (7000, ""), (7001, None)]
    load, homes = check(make_docs, rows)
    assert max(load.values()) - min(load.values()) <= 0.01 * max(load.values())
    families = [h for c, h in homes.items() if sum(h.values()) > 1]
    assert sum(len(h) == 1 for h in families) >= 0.95 * len(families)


def test_family_larger_than_a_shard(make_docs):
    rows = [(i, "hot " * 20) for i in range(1500)] + [(2000 + i, f"{i} " * 15) for i in range(3000)]
    load, homes = check(make_docs, rows)
    assert max(load.values()) - min(load.values()) <= 0.02 * max(load.values())
    hot = homes[zlib.crc32(b"hot " * 20)]
    assert len(hot) <= 10  # at least 7 shards hold a third of all bytes


def cut_links(homes):
    """Copies that are not where most of their family are."""
    return sum(sum(h.values()) - max(h.values()) for h in homes.values())


def plainly(rows, shards=16):
    """Label propagation one document at a time: each in turn goes to the shard
    with room where its copies weigh most."""
    size = [len((t or "").encode()) + 1 for _, t in rows]
    capacity = -(-sum(size) // shards)
    rnd = random.Random(0)
    label, load, at = [rnd.randrange(shards) for _ in rows], Counter(), defaultdict(Counter)
    for k, (_, t) in enumerate(rows):
        load[label[k]] += size[k]
        at[t][label[k]] += size[k]
    for _ in range(6):
        for k, (_, t) in enumerate(rows):
            best = max((s for s in at[t] if s != label[k] and load[s] + size[k] <= capacity), key=lambda s: (at[t][s], -s), default=None)
            if best is not None and at[t][best] > at[t][label[k]] - size[k]:
                at[t][label[k]] -= size[k]
                load[label[k]] -= size[k]
                label[k] = best
                at[t][best] += size[k]
                load[best] += size[k]
    homes = defaultdict(Counter)
    for k, (_, t) in enumerate(rows):
        homes[zlib.crc32((t or "").encode())][label[k]] += 1
    return homes


@pytest.mark.parametrize("texts, copies", [(20000, 2), (400, 2), (700, 9)])
def test_copies_only_are_exchanged(make_docs, texts, copies):
    """Without documents that have no copies there is no free room: shards exchange."""
    rnd = random.Random(texts)
    bodies = ["".join(rnd.choice("abcdefgh ") for _ in range(rnd.randint(20, 60))) + str(i) for i in range(texts)]
    rows = [(i * copies + k, t) for i, t in enumerate(bodies) for k in range(copies)]
    load, homes = check(make_docs, rows)
    assert max(load.values()) - min(load.values()) <= (0.01 if texts == 20000 else 0.06) * max(load.values())
    assert sum(len(h) == 1 for h in homes.values()) >= 0.95 * len(homes)
    assert cut_links(homes) <= cut_links(plainly(rows))


def test_half_of_the_texts_doubled(make_docs):
    rnd = random.Random(3)
    bodies = ["".join(rnd.choice("abcdefgh ") for _ in range(rnd.randint(5, 90))) + str(i) for i in range(6000)]
    rows = [(i, t) for i, t in enumerate(bodies)] + [(10000 + i, t) for i, t in enumerate(bodies[:3000])]
    load, homes = check(make_docs, rows)
    assert max(load.values()) - min(load.values()) <= 0.01 * max(load.values())
    assert sum(len(h) == 1 for h in homes.values() if sum(h.values()) > 1) >= 0.99 * 3000


def test_long_texts_and_layout(make_docs):
    """A text larger than a shard; the same shards whatever the files' layout."""
    rows = [(1, "x" * 3_000_000), (2, "y" * 900_000), (3, "y" * 900_000)] + [(10 + i, f"text {i % 400} " * 30) for i in range(900)] + [(5, None), (5, None)]
    load, _ = check(make_docs, rows)
    assert sorted(load.values())[-1] == 3_000_001
    one = sorted(map(str, shard(make_docs(rows).repartition(7)).collect()))
    assert one == sorted(map(str, shard(make_docs(list(reversed(rows))).repartition(3)).collect()))


def test_copies_only_and_empty_table(make_docs):
    check(make_docs, [(1, "a")] * 5)
    assert shard(make_docs([(1, "a")]).limit(0)).count() == 0

"""Balanced label propagation: shards of equal size that keep copies together.

Documents with equal texts are linked (through their text, never pair by
pair). A label is a shard. Copies of one text are alike, so the state holds one
row for each text and shard: how many copies are there. All labels start at
random. Each round, every linked document looks at the shard where its copies
weigh most (ties by a hash of text and shard, so wishes go every way alike),
and wishes to move there. Wishes between two shards are summed in hash buckets
of texts, a table of fixed size that comes to the driver, where the flows are
cut back until no shard exceeds its capacity by more than some slack: what leaves a shard makes room
for what enters, so shards exchange documents even when all are full. Buckets
are admitted up to each flow, then as long as one fits. When none does, full
shards are closed, and texts still split look to the others; then the slack
grows. Rounds go on until nothing moves at the most slack; copies only ever
join the shard where most are, so this ends.

Families and single documents above 1 / BIG of a shard, BIG * shards of them at most, are placed
first, each into the shards with most room, so they fill as few as can be.
An evening pass then moves buckets of whole families from shards above the
mean to those below, and documents without copies fill the shards up: their
hash buckets, FILL of them, are dealt largest first to the shard with most
room.

The law is ``bytes``: shards' sizes are equal up to a bucket of the filling or
of the evening pass, or a document that is larger than that.

Defined results: a null text has size 1 like an empty one and is linked with
it; repeated rows are documents of their own and alike; rows without doc_id
come first; votes that tie go by hash; which copies go where depends on doc_id
and text only, not on the files' layout; very long texts count by their bytes;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoscore.llm.common import forget, spread, written

SHARDS = 16
BIG = 8
SLACK = 0.05       # by which shards may exceed their capacity before the evening pass, or by a family,
MOST_SLACK = 0.25  # growing up to this while texts are split
BUCKETS = 256      # of texts, for the wishes between two shards
EVENING = 1 << 12  # buckets of whole families in a shard
FILL = 1 << 14
ALIKE = 64         # copies of a text that start at random one by one; more start evenly
CHUNK_ROWS = 5000


def flows(wish: np.ndarray, load: np.ndarray, capacity: float) -> np.ndarray:
    """The largest multiples of the wishes (from, to) in bytes found by cutting
    back what enters a shard that would exceed its capacity, until none does."""
    flow = wish.astype(float)
    while True:
        into, out = flow.sum(0), flow.sum(1)
        over = (load + into - out > capacity * (1 + 1e-9)) & (into > 0)
        if not over.any():
            return flow
        share = np.clip((capacity - load + out) / np.where(into > 0, into, 1), 0, 1)
        share[share < 1e-6] = 0
        flow[:, over] *= share[over]


def _admitted(wish: dict[tuple[int, int], dict[int, int]], flow: np.ndarray, load: np.ndarray, capacity: float) -> list[tuple[int, int, int]]:
    """(from, to, bucket) of the wishes to grant: each pair's buckets within
    its flow, then others in turn as long as one fits."""
    out, load, left = [], load.copy(), {}
    for (a, b), buckets in sorted(wish.items()):
        total = 0
        for k, v in sorted(buckets.items()):
            if total + v <= flow[a, b] * (1 + 1e-9):
                total += v
                out.append((a, b, k))
            else:
                left[a, b, k] = v
        load[a] -= total
        load[b] += total
    while True:
        fitted = []
        for (a, b, k), v in left.items():
            if load[b] + v <= capacity:
                load[a] -= v
                load[b] += v
                fitted.append((a, b, k))
        if not fitted:
            return out
        out += fitted
        for f in fitted:
            del left[f]


def propagate(families: DataFrame, load: np.ndarray, capacity: int) -> DataFrame:
    """(group, size, shard, n): how many copies of each family (group, size, n)
    each shard gets, ``load`` being taken already."""
    spark, shards = families.sparkSession, len(load)
    one = F.explode(F.when(F.col("n") <= ALIKE, F.transform(F.sequence(F.lit(1), F.col("n")), lambda k: F.struct(
        (spread(F.lit("start"), "group", k) % shards).alias("shard"), F.lit(1).cast("long").alias("n"))))
        .otherwise(F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.struct(
            s.cast("int").alias("shard"), (F.floor(F.col("n") * (s + 1) / shards) - F.floor(F.col("n") * s / shards)).alias("n")))))
    state = (families.select("group", "size", one.alias("c")).groupBy("group", "size", F.col("c.shard").alias("shard"))
             .agg(F.sum("c.n").alias("n")).where("n > 0"))
    state = written(state, "labels")
    largest = families.agg(F.coalesce(F.max(F.col("n") * F.col("size")), F.lit(0))).first()[0]
    limit, turn = capacity + max(capacity * SLACK, largest), 0
    closed: set[int] = set()
    while True:
        # a family has a row for each shard at most; it goes to the open shard where most of it is, else to any
        opened = [s for s in range(shards) if s not in closed]
        inside = F.col("shard").isin(opened) if opened else F.lit(False)
        family = W.partitionBy("group")
        most = F.max(F.struct(inside.alias("open"), "n", spread("group", "shard").alias("tie"), "shard")).over(family)
        other = F.get(F.lit(opened or [0]), spread(F.lit("other"), "group") % max(1, len(opened)))
        to = (F.when((F.count("*").over(family) == 1) | F.lit(not opened), F.col("shard"))
              .when(most["open"], most["shard"]).otherwise(other))
        wish = written(state.withColumn("to", to).withColumn("bucket", spread(F.lit(turn), "group") % BUCKETS), "wishes")
        got = wish.groupBy("shard", "to", "bucket").agg(F.sum(F.col("n") * F.col("size")).alias("b")).collect()
        now, asked, pairs = load.astype(float), np.zeros((shards, shards)), defaultdict(dict)
        for r in got:
            now[r["shard"]] += r["b"]
            if r["shard"] != r["to"]:
                asked[r["shard"], r["to"]] += r["b"]
                pairs[r["shard"], r["to"]][r["bucket"]] = r["b"]
        if not pairs and not closed:
            forget(wish)
            return state
        granted = _admitted(pairs, flows(asked, now, limit), now, limit)
        if not granted:
            forget(wish)
            full = {s for s in range(shards) if now[s] >= capacity} | closed
            if full != closed:
                closed = full  # what is still split looks for room elsewhere
            elif limit < capacity * (1 + MOST_SLACK):
                closed, limit = set(), limit + capacity * SLACK  # the evening pass takes the surplus back
            else:
                return state
            continue
        # shards * shards * BUCKETS rows at most
        table = F.broadcast(spark.createDataFrame(granted, "shard int, to int, bucket int").withColumn("go", F.lit(True)))
        moved = (wish.join(table, ["shard", "to", "bucket"], "left")
                 .groupBy("group", "size", F.when(F.col("go"), F.col("to")).otherwise(F.col("shard")).alias("shard")).agg(F.sum("n").alias("n")))
        forget(state)
        state = written(moved, "labels")
        forget(wish)
        turn += 1


def _even(state: DataFrame, load: np.ndarray, capacity: int, singles: int) -> DataFrame:
    """Buckets of whole families move from shards above their share to those
    below, as far as the documents without copies can't fill the gaps."""
    shards = len(load)
    bucket = spread(F.lit("even"), "group") % EVENING
    whole = F.count("*").over(W.partitionBy("group")) == 1
    state = state.withColumn("bucket", F.when(whole, bucket))
    got = state.groupBy("shard", "bucket").agg(F.sum(F.col("n") * F.col("size")).alias("b")).collect()
    now, own = load.astype(float), defaultdict(dict)
    for r in got:
        now[r["shard"]] += r["b"]
        if r["bucket"] is not None:
            own[r["shard"]][r["bucket"]] = r["b"]
    # what the others fill up to: no shard need be below this
    floor = _level(now, singles)
    moves = []
    while True:
        b = int(now.argmin())
        for a in np.argsort(-now):
            gap = now[a] - now[b]
            fit = [(abs(v - gap / 2), k) for k, v in own[a].items() if 0 < v < gap]  # so the two come closer
            if fit or now[a] <= max(floor, now[b] * 1.0005):
                break
        if not fit or now[a] <= max(floor, now[b] * 1.0005):
            break
        k = min(fit)[1]
        v = own[a].pop(k)
        moves.append((int(a), k, b))
        now[a] -= v
        now[b] += v
    if not moves:
        return state.drop("bucket")
    table = state.sparkSession.createDataFrame(moves, "shard int, bucket int, to int")
    return (state.join(F.broadcast(table), ["shard", "bucket"], "left")  # shards * EVENING rows at most
            .select("group", "size", F.coalesce("to", "shard").alias("shard"), "n"))


def _level(now: np.ndarray, water: float) -> float:
    """Level that ``water`` poured over the shards' loads reaches."""
    ordered = np.sort(now)
    for k in range(1, len(ordered) + 1):
        level = (water + ordered[:k].sum()) / k
        if k == len(ordered) or level <= ordered[k]:
            return float(level)
    return 0.0


def _filling(rows: DataFrame, room: np.ndarray) -> DataFrame:
    """Shards for documents without copies, by hash bucket."""
    bucket = (spread(F.lit("fill"), "doc_id", "group") % FILL).alias("bucket")
    sums = {r["bucket"]: r["b"] for r in rows.groupBy(bucket).agg(F.sum("size").alias("b")).collect()}
    heap = [(-left, s) for s, left in enumerate(room.tolist())]
    heapq.heapify(heap)
    place = []
    for b, size in sorted(sums.items(), key=lambda x: (-x[1], x[0])):
        left, s = heapq.heappop(heap)
        place.append((b, s))
        heapq.heappush(heap, (left + size, s))
    table = rows.sparkSession.createDataFrame(place, "bucket int, shard int")
    return rows.withColumn("bucket", bucket).join(F.broadcast(table), "bucket").drop("bucket")  # FILL rows at most


def _numbered(rows: DataFrame, by: str, n: Column, out: str, *order: str) -> DataFrame:
    """``rows`` numbered from 0 within each value of ``by``, which has ``n`` rows:
    counts of chunks of about CHUNK_ROWS give each chunk its first number."""
    chunk = spread(F.lit("chunk"), "doc_id", "group") % F.greatest(F.lit(1), F.floor(n / CHUNK_ROWS))
    rows = rows.withColumn("chunk", chunk)
    before = W.partitionBy(by).orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    starts = (rows.groupBy(by, "chunk").agg(F.count("*").alias("c"))
              .select(by, "chunk", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("first")))
    inside = F.row_number().over(W.partitionBy(by, "chunk").orderBy(*order)) - 1
    return rows.withColumn("inside", inside).join(starts, [by, "chunk"]).withColumn(out, F.col("first") + F.col("inside")).drop("chunk", "inside", "first")


def _big_places(families: list, load: np.ndarray, capacity: int) -> list[tuple]:
    """(group, size, shard, n) of the big families, largest first, each in the
    shards with most room; ``load`` is added to."""
    out = []
    for r in sorted(families, key=lambda r: (-r["n"] * r["size"], r["group"])):
        left = r["n"]
        while left:
            s = int(load.argmin())
            n = min(left, max(1, int((capacity - load[s]) // r["size"])))
            out.append((r["group"], r["size"], s, n))
            load[s] += n * r["size"]
            left -= n
    return out


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                               F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("group")), "documents")
    total, n_rows = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    capacity = -(-total // shards)
    families = written(rows.groupBy("group").agg(F.max("size").alias("size"), F.count("*").alias("n"))
                       .where((F.col("n") > 1) | (F.col("size") * BIG > capacity)), "families")
    load = np.zeros(shards)
    big = F.col("n") * F.col("size") * BIG > capacity
    placed = _big_places(families.where(big).collect(), load, capacity)  # BIG * shards of them at most
    singles = rows.join(families.select("group"), "group", "left_anti")
    alone = singles.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    state = written(_even(propagate(families.where(~big), load, capacity), load, capacity, alone), "homes")
    for r in state.groupBy("shard").agg(F.sum(F.col("n") * F.col("size")).alias("b")).collect():
        load[r["shard"]] += r["b"]
    homes = state.unionByName(spark.createDataFrame(placed, "group long, size long, shard int, n long"))
    # copies are numbered by doc_id; each home takes the next ones
    upto = W.partitionBy("group").orderBy("shard").rowsBetween(W.unboundedPreceding, 0)
    homes = (homes.groupBy("group", "shard").agg(F.sum("n").alias("n")).withColumn("last", F.sum("n").over(upto))
             .groupBy("group").agg(F.sort_array(F.collect_list(F.struct("last", "shard"))).alias("homes"), F.sum("n").alias("n")))
    copies = _numbered(rows.join(homes, "group"), "group", F.col("n"), "nth", "doc_id")
    copies = copies.select("doc_id", "size", "text_crc32", "group",
                           F.filter("homes", lambda h: h["last"] > F.col("nth"))[0]["shard"].alias("shard"))
    out = written(copies.unionByName(_filling(singles, capacity - load)), "placed")
    slots = _numbered(out, "shard", F.lit(n_rows // shards), "slot", "doc_id", "group")
    return slots.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

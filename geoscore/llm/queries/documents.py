"""opN_* queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoscore.llm import decontam, lines, packing, pii, quality, resample, secrets, sharding, shingles, spelling, substrings, topk, toxicity
from geoscore.llm.common import id_crc, lookup, written
from geoscore.llm.queries import register
from geoscore.sources.testdata import load


# CRC-32 in SQL: ``crc_table`` lists the 256 steps of the reflected polynomial,
# ``crc_sql(x)`` is the checksum of a string's UTF-8 bytes.
CRC_TABLE = """
crc_steps(i, k, c) AS (
    SELECT CAST(range AS BIGINT), 0, CAST(range AS BIGINT) FROM range(256)
    UNION ALL
    SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM crc_steps WHERE k < 8
), crc_table AS (SELECT list(c ORDER BY i) AS steps FROM crc_steps WHERE k = 8)
"""


def crc_sql(x: str) -> str:
    return f"""xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(
        range(CAST(octet_length(encode({x})) AS BIGINT)),
        lambda i: CAST('0x' || substr(hex(encode({x})), 2 * i + 1, 2) AS BIGINT))),
        lambda a, b: xor(a // 256, steps[1 + xor(a % 256, b)])), 4294967295)"""


LOWER_SQL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')".format


def labelled(docs: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """(key, text, label) of the documents with a label in ``column``."""
    seen = written(labels.select(F.col("doc_id").alias("key"), F.col(column).alias("label")), "labels")
    return docs.select(F.col("doc_id").alias("key"), "text").join(lookup(seen), "key")


def quality_model(spark: SparkSession, docs: DataFrame, labels: DataFrame):
    """Weights learnt from the labelled rows that are not held out."""
    seen = labels.where(F.col("quality").isin(0, 1) & (id_crc(F.col("doc_id")) % 5 != 0))
    return quality.train(labelled(docs, seen, "quality"))


@register("op1_lines")
def op1_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    out = lines.dedup_lines(docs, "lines")
    return out.select("doc_id", "lines.n_lines", "lines.n_removed", "lines.removed",
                      F.sha2("lines.text", 256).alias("kept_sha256"))


@register("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    labels = load(spark, sf_dir, "labels")
    seen = labels.where(F.col("toxic").isin(0, 1) & (id_crc(F.col("doc_id")) % 3 != 1))
    model = toxicity.train(labelled(docs, seen, "toxic"))
    scored = toxicity.score_rows(docs, model, "score")
    scored = scored.select("doc_id", (id_crc(F.col("doc_id")) % 3 == 1).alias("held_out"), "score")
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@register("op3_near_duplicates")
def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return shingles.near_duplicates(docs).select("doc_id", "n_shingles", "component_id")


@register("op4_secrets")
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", secrets.spans(F.col("text")).alias("found"))
    base = F.filter("found", lambda s: s["kind"] < 3)
    counts = [secrets.count(F.col("found"), k).alias(f"n_{k}") for k in secrets.KINDS]
    return docs.select("doc_id", *counts[:3], F.sha2(secrets.written_spans(base), 256).alias("base_sha256"),
                       secrets.written_spans(F.col("found")).alias("spans"), *counts[3:])


@register("op5_decontamination")
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontam.leaks(docs, load(spark, sf_dir, "benchmark").select("item_id", "text"), "leaks")
    return out.select("doc_id", (F.size("leaks") > 0).alias("contaminated"), F.size("leaks").cast("long").alias("n_items"),
                      F.col("leaks.item").alias("item_ids"), F.array_min("leaks.distance").alias("least_edits"))


@register("op6_quality")
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    weights = quality_model(spark, docs, load(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", (id_crc(F.col("doc_id")) % 5 == 0).alias("held_out"),
                         quality.score(F.col("text"), weights, spark).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@register("op7_substrings")
def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.dedup_substrings(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@register("op8_sharding")
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(load(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op9_packing")
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(packing.pieces(docs))


@register("op10_top_k", oracle="""
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS score
    FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 100 = 0
), r AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= 10
""")
def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = load(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, F.col("vec_id") % 100 == 0)


@register("op11_pii")
def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pii.find(load(spark, sf_dir, "documents").select("doc_id", "text"), "found")
    base = F.filter("found", lambda s: s["base"])

    def count(k: int):
        return F.size(F.filter(base, lambda s: s["kind"] == k)).cast("long")

    return docs.select("doc_id", *(count(k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS)),
                       F.sha2(pii.written_spans(base), 256).alias("base_sha256"), pii.written_spans(F.col("found")).alias("spans"),
                       (F.size("found") - F.size(base)).cast("long").alias("n_added"))


@register("op12_variants", oracle=f"""
WITH RECURSIVE {CRC_TABLE}, runs AS (
    SELECT doc_id, unnest(regexp_extract_all({LOWER_SQL('text')}, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents
), seen AS (
    SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL
), named AS (SELECT *, doc_id || ':' || run AS name FROM seen),
hashed AS (SELECT run, n, {crc_sql('name')} AS h FROM named, crc_table),
damaged AS (
    SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed
), words AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM damaged WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), places AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words),
cuts AS (SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM places),
pairs AS (
    SELECT a.word, b.word AS near FROM cuts AS a JOIN cuts AS b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT a.word, b.word FROM cuts AS a JOIN words AS b ON a.rest = b.word
    UNION SELECT b.word, a.word FROM cuts AS a JOIN words AS b ON a.rest = b.word
), best AS (
    SELECT p.word, p.near, w.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near,
           row_number() OVER (PARTITION BY p.word ORDER BY w.n DESC, p.near) AS r
    FROM pairs AS p JOIN words AS w ON w.word = p.near
), forms AS (
    SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= 10 * w.n THEN b.near END AS form,
           CASE WHEN b.near_n >= 10 * w.n THEN b.near_n END AS form_n
    FROM words AS w LEFT JOIN best AS b ON b.word = w.word AND b.r = 1
), followed(word, last) AS (
    SELECT word, word FROM forms
    UNION ALL SELECT f.word, g.form FROM followed AS f JOIN forms AS g ON f.last = g.word WHERE g.form IS NOT NULL
)
SELECT f.word, f.form, r.last AS root, f.n, f.n_near, f.form_n
FROM forms AS f JOIN followed AS r ON r.word = f.word JOIN forms AS e ON e.word = r.last AND e.form IS NULL
""")
def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(load(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op13_resampling", oracle=f"""
WITH RECURSIVE {CRC_TABLE}, texts AS (
    SELECT 0 AS side, doc_id AS id, text FROM documents
    UNION ALL SELECT 1, NULL, text FROM benchmark
), split AS (
    SELECT side, id, regexp_extract_all({LOWER_SQL('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM texts WHERE text IS NOT NULL
), features AS (
    SELECT side, id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]))) AS f
    FROM split
), counted AS (SELECT side, id, f, count(*) AS n FROM features GROUP BY ALL),
names AS (SELECT DISTINCT f FROM counted),
hashed AS (SELECT f, {crc_sql('f')} % 10000 AS bucket FROM names, crc_table),
placed AS (SELECT side, id, bucket, sum(n) AS n FROM counted JOIN hashed USING (f) GROUP BY ALL),
totals AS (
    SELECT coalesce(sum(n) FILTER (side = 0), 0) AS big_s, coalesce(sum(n) FILTER (side = 1), 0) AS big_t FROM placed
), gains AS (
    SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(sum(n) FILTER (side = 1), 0) + 1 AS DOUBLE) * CAST(any_value(big_s) + 10000 AS DOUBLE)
        / (CAST(coalesce(sum(n) FILTER (side = 0), 0) + 1 AS DOUBLE) * CAST(any_value(big_t) + 10000 AS DOUBLE)))) AS BIGINT) AS gain
    FROM placed, totals GROUP BY bucket
), sums AS (
    SELECT id AS doc_id, CAST(sum(n) AS BIGINT) AS n_features,
           CAST(floor(CAST(sum(n * gain) AS DOUBLE) / CAST(sum(n) AS DOUBLE)) AS BIGINT) AS weight
    FROM placed JOIN gains USING (bucket) WHERE side = 0 GROUP BY id
), scored AS (
    SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
        + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || d.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
    FROM documents AS d LEFT JOIN sums AS s ON d.doc_id = s.doc_id
), ranked AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 39
)
SELECT s.doc_id, s.n_features, s.weight, s.score, CASE WHEN rank <= 25 * n // 100 THEN rank END AS rank
FROM scored AS s LEFT JOIN ranked AS r ON s.doc_id = r.doc_id
""")
def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return resample.resample(docs, load(spark, sf_dir, "benchmark").select("text"))

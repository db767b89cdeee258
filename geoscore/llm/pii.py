"""Personal data: labelers vote on candidate spans, EM weighs the labelers, and
a span classifier is trained on what it finds.

1. Candidates: all matches of the base patterns, and wider ones: numbers cut
   out of matches that failed (a card after an address, say), dotted quads in
   longer runs, telephone numbers without a plus sign, spelt-out addresses.
2. Labelers: six regex, gazetteer and context labelers vote yes, no or nothing
   on every candidate of all texts. Spark counts the vote patterns; there are
   at most ``4 * 3 ** 6`` of them, whatever the input.
3. Expectation-maximisation on these counts estimates each labeler's
   reliability for each kind, and the probability that a pattern is right.
4. A logistic regression (Spark ML) learns from these probabilities, by the
   spans' shape, surroundings and evidence, over all candidates.
5. A second pass scores the candidates. Base spans stay; a further candidate is
   added when its probability is at least a half and it meets no base span and
   no likelier candidate. Added cards must pass Luhn, added addresses have parts
   of 255 at most, as base ones.

Kinds, in order: email, ip, card, phone. Spans are code points, end exclusive.
Defined results: null and empty texts have no spans; of candidates that tie,
the longer, then the earlier, then the first kind is kept; repeated rows get
equal results; without candidates no model is fitted; an empty table gives an
empty result; very long texts are read whole in linear time; other columns are
not read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoscore.llm import hashing as H
from geoscore.llm.common import forget, written

KINDS = ["email", "ip", "card", "phone"]

# The base patterns (possessive where nothing can be given back)
# and the number of digits a card or telephone number has.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS = (16, 19)
PHONE_DIGITS = (8, 15)

# Gazetteers and context words of the labelers.
DOMAIN_ENDS = frozenset("com org net edu gov int mil info biz io dev app eu uk de fr es it nl be ch at pl pt se no dk fi ie us ca mx br ar au nz in jp cn ru za".split())
CALLING_CODES = frozenset(("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98 "
                           "211 212 213 216 218 220 221 225 233 234 254 255 256 260 263 351 352 353 354 355 356 357 358 359 370 371 372 373 374 375 376 377 380 381 385 386 "
                           "387 389 420 421 423 502 503 504 505 506 507 509 591 593 595 598 852 853 855 880 886 960 961 962 963 964 965 966 967 968 971 972 973 974 977 994 995 998").split())
ISSUERS = re.compile(r"4|5[1-5]|2[2-7]|3[47]|3[0689]|6011|64[4-9]|65|62|35")
OWN_WORDS = {
    "email": frozenset("email mail emails mails contact contacto courriel adresse correo write kontakt reply".split()),
    "ip": frozenset("ip ips address adresse direccion host server serveur servidor ping client gateway from login".split()),
    "card": frozenset("card cards visa mastercard amex credit debit karte kreditkarte carte tarjeta payment pay".split()),
    "phone": frozenset("phone tel telephone telefon téléphone teléfono telefono mobile cell fax call mobil handy portable movil móvil sms".split()),
}
OTHER_WORDS = frozenset("version release order invoice isbn issn section chapter page pages figure table number id sku serial hash ratio score total sum price "
                        "bestellung rechnung seite version facture commande página pedido factura v no nr".split())

MARKS = re.compile(r"[0-9@]|[(\[{]at[)\]}]|\x20dot\x20", re.I)
DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3,}+")
GROUP = re.compile(r"[0-9]+")
PLAIN_PHONE = re.compile(r"(?<![0-9+(.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])|(?<![0-9])00[1-9](?:[\x20.-]?[0-9]){7,12}(?![0-9])")
SPELT_AT = re.compile(r"\x20?[(\[{]at[)\]}]\x20?|\x20at\x20", re.I)
SPELT_DOMAIN = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\x20?[(\[{]dot[)\]}]\x20?|\x20dot\x20|\.)[A-Za-z0-9-]{1,63}){1,8}", re.I)
WORD = re.compile(r"[^\W\d_]+")

CHECKED = ("ip", "card")  # kinds whose added spans must pass their own check
NO_VOTE, YES, NO = 0, 1, 2
LABELERS = ["shape", "checksum", "gazetteer", "context", "edges", "run"]
# Features and their numbers of values; the first six are the labelers' votes.
SIZES = [3, 3, 3, 3, 3, 3, 4, 4, 6, 5, 4]
WIDTH = sum(SIZES)
SLICE = 512 << 10


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _part_ok(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base matches that hold, by kind and start."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        m = DOMAIN.match(text, at + 1)
        if m:
            s = at
            while s > done and text[s - 1] in LOCAL:
                s -= 1
            if s < at:
                out.append((0, s, m.end()))
                done = m.end()
        at = text.find("@", max(at + 1, done))
    out += [(1, *m.span()) for m in IP.finditer(text) if all(_part_ok(p) for p in m[0].split("."))]
    for kind, pattern, (least, most) in ((2, CARD, CARD_DIGITS), (3, PHONE, PHONE_DIGITS)):
        for m in pattern.finditer(text):
            n = sum(map(len, GROUP.findall(m[0])))
            if least <= n <= most and (kind == 3 or luhn("".join(GROUP.findall(m[0])))):
                out.append((kind, *m.span()))
    return out


def candidates(text: str) -> list[tuple[int, int, int, int, int, bool]]:
    """(kind, start, end, start and end of the run it lies in, base) of every
    candidate span, base ones first."""
    if not MARKS.search(text):
        return []
    found = {s: (*s, s[1], s[2], True) for s in base_spans(text)}

    def add(kind, s, e, a, b):
        found.setdefault((kind, s, e), (kind, s, e, a, b, False))

    for m in DOTTED.finditer(text):
        g = [x.span() for x in GROUP.finditer(text, *m.span())]
        for k in range(len(g) - 3):
            add(1, g[k][0], g[k + 3][1], *m.span())
    for m in CARD.finditer(text):
        if m.end() - m.start() < 13:
            continue
        g = [x.span() for x in GROUP.finditer(text, *m.span())]
        for k in range(len(g)):
            n = 0
            for s, e in g[k:k + 7]:
                n += e - s
                if n > 19 or e - s < 3:
                    break
                if n >= 13:
                    add(2, g[k][0], e, *m.span())
    plus = list(PHONE.finditer(text))
    for m in plus:
        n = 0
        for g in GROUP.finditer(text, *m.span()):
            n += g.end() - g.start()
            if n > PHONE_DIGITS[1]:
                break
            if n >= PHONE_DIGITS[0]:
                add(3, m.start(), g.end(), *m.span())
    begun = [m.start() for m in plus]
    for m in PLAIN_PHONE.finditer(text):
        k = bisect_right(begun, m.start())
        if not k or plus[k - 1].end() <= m.start():
            add(3, *m.span(), *m.span())
    for m in SPELT_AT.finditer(text):
        d = SPELT_DOMAIN.match(text, m.end())
        s = m.start()
        while s > 0 and m.start() - s < 64 and text[s - 1] in LOCAL:
            s -= 1
        if d and s < m.start():
            add(0, s, d.end(), s, d.end())
    return list(found.values())


def _side(c: str) -> int:
    return 0 if not c or c.isspace() else 1 if c.isalpha() else 2 if c.isdigit() else 3


def describe(text: str, kind: int, start: int, end: int, a: int, b: int) -> list[int]:
    """The six votes, then left and right sign, digits, groups and separators."""
    span = text[start:end]
    groups = GROUP.findall(span)
    digits = "".join(groups)
    sizes = [len(g) for g in groups]
    shape = checksum = gazetteer = NO_VOTE
    if kind == 0:
        labels = [x for x in re.split(r"[^A-Za-z0-9-]+", re.split(r"@|\bat\b", span, maxsplit=1, flags=re.I)[-1]) if x and x.lower() != "dot"]
        last = labels[-1].lower() if labels else ""
        shape = YES if "@" in span else NO if "." in span and " at " in span else NO_VOTE
        checksum = YES if last.isalpha() and len(labels) > 1 and not any(x[0] == "-" or x[-1] == "-" or len(x) > 63 for x in labels) else NO
        gazetteer = YES if last in DOMAIN_ENDS else NO_VOTE
    elif kind == 1:
        shape = YES if all(g == "0" or g[0] != "0" for g in groups) else NO
        checksum = YES if all(_part_ok(g) for g in groups) else NO
        first = int(groups[0][:4])
        gazetteer = YES if 1 <= first <= 223 and first != 127 and any(n > 1 for n in sizes) else NO
    elif kind == 2:
        even = len(sizes) == 1 or (all(n == 4 for n in sizes[:-1]) and sizes[-1] <= 4) or sizes == [4, 6, 5]
        shape = YES if even and len(digits) >= 15 else NO
        checksum = YES if luhn(digits) else NO
        gazetteer = YES if ISSUERS.match(digits) else NO
    else:
        shape = YES if span.count("(") == span.count(")") and not re.search(r"[\x20.-]{3}|[.-]{2}|\([^0-9]", span) and max(sizes) < 12 else NO
        checksum = YES if 10 <= len(digits) <= 13 else NO_VOTE
        code = digits[2:] if digits.startswith("00") else digits
        known = any(code[:n] in CALLING_CODES for n in (1, 2, 3))
        gazetteer = NO_VOTE if span[0] not in "+0" else YES if known else NO
    near = [w.lower() for w in WORD.findall(text[max(0, start - 40): start])][-4:]
    context = YES if any(w in OWN_WORDS[KINDS[kind]] for w in near) else NO if near and near[-1] in OTHER_WORDS else NO_VOTE
    left, right = _side(text[start - 1: start]), _side(text[end: end + 1])
    edges = NO if left in (1, 2) or right in (1, 2) else YES if left == 0 and (right == 0 or text[end] in ".,;:!?)") else NO_VOTE
    cut = text[max(0, start - 1): start] * (a < start) + text[end: end + 1] * (end < b)
    run = YES if not cut else NO if re.search(r"[0-9.-]", cut) else NO_VOTE
    marks = "".join(sorted(set(re.sub(r"[0-9]", "", span)))) if kind else ""
    separators = 0 if not marks else 1 if marks == " " else 2 if len(marks) == 1 else 3
    return [shape, checksum, gazetteer, context, edges, run, left, right,
            min(len(digits) // 4, 5), min(len(groups), 4), separators]


def _code(kind: int, values: list[int]) -> int:
    code = kind
    for v, n in zip(values, SIZES):
        code = code * n + v
    return code


def _decoded(code: int) -> tuple[int, list[int]]:
    values = []
    for n in reversed(SIZES):
        code, v = divmod(code, n)
        values.append(v)
    return code, values[::-1]


def _places(code: int) -> list[int]:
    """Places of a candidate's features in the classifier's vector."""
    kind, values = _decoded(code)
    first = np.cumsum([0, *SIZES[:-1]]) + kind * WIDTH
    return [int(f) + v for f, v in zip(first, values)]


def votes_of(code: int) -> int:
    """Vote pattern of a candidate, with its kind."""
    kind, values = _decoded(code)
    for v in values[:len(LABELERS)]:
        kind = kind * 3 + v
    return kind


def evidence(texts: DataFrame) -> DataFrame:
    """(code, votes, n): how often each description and vote pattern occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Counter()
            for part in H.slices(batch, "text", SLICE):
                for text in part.column(0).to_pylist():
                    found.update(_code(c[0], describe(text, *c[:5])) for c in candidates(text or ""))
            codes = list(found)
            yield pa.record_batch([pa.array(codes, pa.int64()), pa.array([votes_of(c) for c in codes], pa.int64()),
                                   pa.array([found[c] for c in codes], pa.int64())], ["code", "votes", "n"])

    return (texts.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "code long, votes long, n long")
            .groupBy("code", "votes").agg(F.sum("n").alias("n")))


def reliabilities(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """Expectation-maximisation for one kind: ``patterns`` (rows, labelers) of
    votes and their counts. Returns the probability that each pattern is right,
    the vote probabilities [right, labeler, vote], and the share of right ones.

    Pseudo-counts say that a labeler's yes is likelier for right candidates, so
    the two classes can't change places."""
    yes, no = (patterns == YES).sum(1), (patterns == NO).sum(1)
    right = 1 / (1 + np.exp(-(yes - no).astype(float)))
    guess = np.array([[3.0, 1.0, 8.0], [3.0, 8.0, 1.0]])  # wrong, right by no vote, yes, no
    table = np.zeros((2, patterns.shape[1], 3))
    for _ in range(rounds):
        for y, weight in ((0, counts * (1 - right)), (1, counts * right)):
            for j in range(patterns.shape[1]):
                table[y, j] = np.bincount(patterns[:, j], weights=weight, minlength=3) + guess[y]
        table /= table.sum(2, keepdims=True)
        share = ((counts * right).sum() + 1) / (counts.sum() + 2)
        score = np.log(table)[:, np.arange(patterns.shape[1]), patterns].sum(2) + np.log([[1 - share], [share]])
        new = 1 / (1 + np.exp(np.clip(score[0] - score[1], -700, 700)))
        moved = np.abs(new - right).max() if len(new) else 0.0
        right = new
        if moved < 1e-9:
            break
    return right, table, float(share)


def _vote_list(votes: int) -> tuple[int, list[int]]:
    out = []
    for _ in LABELERS:
        votes, v = divmod(votes, 3)
        out.append(v)
    return votes, out[::-1]


def label_model(found: DataFrame) -> dict[int, float]:
    """Probability of each vote pattern (kind included) that occurs."""
    rows = found.groupBy("votes").agg(F.sum("n").alias("n")).collect()
    out = {}
    for kind in range(len(KINDS)):
        mine = sorted((r["votes"], r["n"]) for r in rows if _vote_list(r["votes"])[0] == kind)
        if mine:
            patterns = np.array([_vote_list(v)[1] for v, _ in mine])
            right, _, _ = reliabilities(patterns, np.array([n for _, n in mine], float))
            out.update(zip([v for v, _ in mine], right.tolist()))
    return out


def train(docs: DataFrame) -> np.ndarray | None:
    """Weights of the span classifier (the last is the intercept), learnt from
    all texts; None without candidates."""
    spark = docs.sparkSession
    found = written(evidence(docs), "pii-evidence")
    model = label_model(found)
    if not model:
        return None
    posterior = spark.createDataFrame(list(model.items()), "votes long, right double")
    sums = (found.join(F.broadcast(posterior), "votes")
            .groupBy("code").agg(F.sum(F.col("n") * F.col("right")).alias("yes"), F.sum(F.col("n") * (1 - F.col("right"))).alias("no")))
    places = F.udf(_places, "array<int>")
    size = WIDTH * len(KINDS)
    vectors = sums.withColumn("at", places("code")).select("yes", "no", array_to_vector(F.transform(
        F.sequence(F.lit(0), F.lit(size - 1)), lambda k: F.array_contains("at", k).cast("double"))).alias("features"))
    rows = written(vectors.select("features", F.explode(F.array(F.struct(F.lit(1.0).alias("label"), F.col("yes").alias("weight")),
                                                               F.struct(F.lit(0.0).alias("label"), F.col("no").alias("weight")))).alias("r"))
                   .select("features", "r.label", "r.weight"), "pii-training")
    fitted = LogisticRegression(weightCol="weight", maxIter=60, regParam=1e-4, standardization=False).fit(rows)
    forget(rows)
    forget(found)
    return np.append(fitted.coefficients.toArray(), fitted.intercept)


def chosen(text: str, weights: np.ndarray | None) -> list[tuple[int, int, int, bool, float]]:
    """(kind, start, end, base, probability) of a text's spans, by kind and start."""
    base, rated = [], []
    for kind, s, e, a, b, sure in candidates(text):
        values = describe(text, kind, s, e, a, b)
        p = 1.0
        if weights is not None:
            p = float(1 / (1 + np.exp(-np.clip(weights[_places(_code(kind, values))].sum() + weights[-1], -35, 35))))
        if sure:
            base.append((kind, s, e, True, p))
        elif p >= 0.5 and not (KINDS[kind] in CHECKED and values[1] == NO):
            rated.append((-p, s - e, s, kind, e))
    starts, ends = [], []  # of the text taken, disjoint and in order
    for _, s, e, *_ in sorted(base, key=lambda r: r[1:3]):
        if starts and s < ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    out = base
    for p, _, s, kind, e in sorted(rated):
        k = bisect_right(starts, s)
        if not (k and ends[k - 1] > s) and not (k < len(starts) and starts[k] < e):
            starts.insert(k, s)
            ends.insert(k, e)
            out.append((kind, s, e, False, -p))
    return sorted(out)


SPANS = "array<struct<kind:int,start:int,end:int,base:boolean,score:double>>"


def spans(text: Column, weights: np.ndarray | None, spark) -> Column:
    """Array of (kind, start, end, base, score) of each text; kind counts in KINDS."""
    model = spark.sparkContext.broadcast(weights)
    names = ["kind", "start", "end", "base", "score"]
    shape = pa.list_(pa.struct(list(zip(names, [pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.float64()]))))

    @F.arrow_udf(SPANS)
    def run(column: pa.Array) -> pa.Array:
        out = []
        for part in H.slices(pa.record_batch([column], ["t"]), "t", SLICE):
            out += [[dict(zip(names, s)) for s in chosen(t or "", model.value)] for t in part.column(0).to_pylist()]
        return pa.array(out, shape)

    return run(text)


def written_spans(found: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame, out: str) -> DataFrame:
    """``docs`` (with text) and their spans of personal data as column ``out``."""
    return docs.withColumn(out, spans(F.col("text").cast("string"), train(docs), docs.sparkSession))

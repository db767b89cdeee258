"""Model evaluation metrics as aggregations.

All of them reduce the scored rows with one partially-aggregated pass to a
handful of counts or sums; the per-class arithmetic runs on that one-row
result. Zero denominators give 0, as in the usual classification report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoscore.operators.joins import bounded_broadcast
from geoscore.session import materialize

# Class tables above this many labels are joined without a broadcast hint.
MAX_CLASSES = 10_000


def _safe(n, d):
    return F.coalesce(F.try_divide(n.cast("double"), d.cast("double")), F.lit(0.0))


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row ``tn, fp, fn, tp`` for a 0/1 label and prediction."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")

    def cnt(cond):
        return F.count(F.when(cond, F.lit(1)))

    return df.agg(cnt((y == 0) & (p == 0)).alias("tn"), cnt((y == 0) & (p == 1)).alias("fp"),
                  cnt((y == 1) & (p == 0)).alias("fn"), cnt((y == 1) & (p == 1)).alias("tp"))


def class_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows for class '0', class '1', 'accuracy', 'macro avg' and
    'weighted avg' with precision, recall, f1 and support."""
    cm = confusion(df, label, prediction)
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    p1, r1 = _safe(tp, tp + fp), _safe(tp, tp + fn)
    p0, r0 = _safe(tn, tn + fn), _safe(tn, tn + fp)
    f1 = _safe(F.lit(2.0) * p1 * r1, p1 + r1)
    f0 = _safe(F.lit(2.0) * p0 * r0, p0 + r0)
    s1, s0 = (tp + fn).cast("double"), (tn + fp).cast("double")
    acc = _safe(tp + tn, n)
    wavg = lambda a, b: _safe(a * s0 + b * s1, n)
    rows = [
        ("0", p0, r0, f0, s0),
        ("1", p1, r1, f1, s1),
        ("accuracy", acc, acc, acc, n.cast("double")),
        ("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n.cast("double")),
        ("weighted avg", wavg(p0, p1), wavg(r0, r1), wavg(f0, f1), n.cast("double")),
    ]
    structs = [F.struct(F.lit(k).alias("class"), a.alias("precision"), b.alias("recall"),
                        c.alias("f1"), d.alias("support")) for k, a, b, c, d in rows]
    return cm.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def kappa_f1(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy, Cohen's kappa and the F1 score of the positive class."""
    cm = confusion(df, label, prediction)
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    po = _safe(tp + tn, n)
    pe = _safe((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp), n * n)
    kappa = _safe(po - pe, F.lit(1.0) - pe)
    f1 = _safe(F.lit(2.0) * tp, F.lit(2.0) * tp + fp + fn)
    return cm.select(po.alias("accuracy"), kappa.alias("kappa"), f1.alias("f1"))


def regression_errors(df: DataFrame, label: str = "label",
                      prediction: str = "prediction") -> DataFrame:
    """Mean squared and mean absolute error."""
    e = F.col(prediction).cast("double") - F.col(label).cast("double")
    return df.agg(F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"))


def class_weights(df: DataFrame, label: str = "label", n_classes: int = 2) -> DataFrame:
    """Balanced weights ``n / (n_classes * n_class)`` per label value. The
    input is read once: the total is the sum over the classes' rows."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    # the window holds one row a class
    return (counts.withColumn("n_total", F.sum("n_class").over(Window.partitionBy(F.lit(0))))
            .select(label, "n_class",
                    (F.col("n_total") / (F.lit(float(n_classes)) * F.col("n_class"))).alias("weight")))


def with_class_weights(df: DataFrame, label: str = "label", weight_col: str = "weight") -> DataFrame:
    """Attach the balanced weight of each row's class (one row per class: a
    broadcast after the size check). The weights are written first, so the
    check and the join read them, not the input again."""
    w = materialize(class_weights(df, label).select(label, F.col("weight").alias(weight_col)))
    return df.join(bounded_broadcast(w, MAX_CLASSES), label)

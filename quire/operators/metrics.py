"""Metrics and losses over prediction tables (E1-E10, C10 softmax).

Everything is an aggregate over the prediction table; per-class statistics
are produced by exploding each row into the (at most two) classes it
touches, so there is no class x row product.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _lse(z: Column) -> Column:
    """log-sum-exp of an array column."""
    m = F.array_max(z)
    return m + F.log(F.aggregate(z, F.lit(0.0), lambda acc, y: acc + F.exp(y - m)))


def softmax(df: DataFrame, z_col: str, out_col: str) -> DataFrame:
    """exp(z - max) / sum; max and sum are materialised once per row."""
    d = df.withColumn("__m", F.array_max(z_col))
    d = d.withColumn("__s", F.aggregate(z_col, F.lit(0.0), lambda acc, y: acc + F.exp(y - F.col("__m"))))
    return d.withColumn(out_col, F.transform(z_col, lambda y: F.exp(y - F.col("__m")) / F.col("__s"))) \
        .drop("__m", "__s")


def accuracy(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """E1."""
    return pred.agg(F.round(F.avg((F.col(label) == F.col(prediction)).cast("double")), 6).alias("accuracy"))


def mean_fold_accuracy(pred: DataFrame, fold: str = "fold", label: str = "label",
                       prediction: str = "prediction") -> DataFrame:
    """Accuracy per fold, then the plain mean."""
    per = pred.groupBy(fold).agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("a"))
    return per.agg(F.round(F.avg("a"), 6).alias("mean_accuracy"))


def _class_stats(pred: DataFrame, label: str, prediction: str) -> DataFrame:
    l, p = F.col(label), F.col(prediction)
    rows = F.array(
        F.struct(l.alias("c"), (l == p).cast("long").alias("tp"), F.lit(0).cast("long").alias("fp"),
                 (l != p).cast("long").alias("fn")),
        F.struct(p.alias("c"), F.lit(0).cast("long").alias("tp"), (l != p).cast("long").alias("fp"),
                 F.lit(0).cast("long").alias("fn")))
    e = pred.select(F.explode(rows).alias("r")).select("r.*")
    return e.groupBy("c").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def classification_report(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per class precision / recall / F1 / support (0/0 -> 0), then the
    accuracy, macro-average and support-weighted-average rows."""
    st = _class_stats(pred, label, prediction)
    pc = st.select(F.col("c").cast("string").alias("name"),
                   _safe_div(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                   _safe_div(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
                   (F.col("tp") + F.col("fn")).alias("support"))
    pc = pc.withColumn("f1", _safe_div(2 * F.col("precision") * F.col("recall"),
                                       F.col("precision") + F.col("recall")))
    r6 = lambda c: F.round(c, 6)
    per_class = pc.select("name", r6(F.col("precision")).alias("precision"), r6(F.col("recall")).alias("recall"),
                          r6(F.col("f1")).alias("f1"), F.col("support").cast("bigint").alias("support"))
    acc = pred.agg(F.lit("accuracy").alias("name"), F.lit(None).cast("double").alias("precision"),
                   F.lit(None).cast("double").alias("recall"),
                   r6(F.avg((F.col(label) == F.col(prediction)).cast("double"))).alias("f1"),
                   F.count(F.lit(1)).cast("bigint").alias("support"))
    macro = pc.agg(F.lit("macro avg").alias("name"), r6(F.avg("precision")).alias("precision"),
                   r6(F.avg("recall")).alias("recall"), r6(F.avg("f1")).alias("f1"),
                   F.sum("support").cast("bigint").alias("support"))
    tot = F.sum("support")
    weighted = pc.agg(F.lit("weighted avg").alias("name"),
                      r6(F.sum(F.col("precision") * F.col("support")) / tot).alias("precision"),
                      r6(F.sum(F.col("recall") * F.col("support")) / tot).alias("recall"),
                      r6(F.sum(F.col("f1") * F.col("support")) / tot).alias("f1"),
                      tot.cast("bigint").alias("support"))
    return per_class.unionByName(acc).unionByName(macro).unionByName(weighted)


def confusion_matrix(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Counts for every (label, prediction) class pair, zeros included.
    The class list is small; the grid is one explode of it per class."""
    classes = (pred.select(F.col(label).alias("c"))
               .union(pred.select(F.col(prediction).alias("c"))).distinct())
    all_c = classes.select(F.sort_array(F.collect_list("c"))).scalar()
    grid = classes.select(F.col("c").alias(label), F.explode(all_c).alias(prediction))
    cnt = pred.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))
    return (grid.join(cnt, [label, prediction], "left")
            .select(label, prediction, F.coalesce("n", F.lit(0)).cast("bigint").alias("count")))


def cross_entropy(df: DataFrame, z_col: str, label_col: str, ignore_label: int | None = None) -> DataFrame:
    """E5: mean of -log softmax(z)[label]; rows whose label equals
    ``ignore_label`` (padding) are left out."""
    d = df if ignore_label is None else df.filter(F.col(label_col) != ignore_label)
    per = _lse(F.col(z_col)) - F.element_at(z_col, F.col(label_col) + 1)
    return d.agg(F.round(F.avg(per), 6).alias("loss"))


def binary_cross_entropy(df: DataFrame, p_col: str, y_col: str) -> DataFrame:
    """E6.  Logarithms are bounded below by -100, so a certain wrong prediction counts (and does not drop its row)."""
    p, y = F.col(p_col), F.col(y_col)

    def bounded_log(x):
        return F.when(x <= 0, F.lit(-100.0)).otherwise(F.greatest(F.log(x), F.lit(-100.0)))
    return df.agg(F.round(F.avg(-(y * bounded_log(p) + (1 - y) * bounded_log(1 - p))), 6).alias("loss"))


def smoothed_weighted_loss(df: DataFrame, z_col: str, label_col: str, n_classes: int,
                           smoothing: float, weights: Sequence[float]) -> DataFrame:
    """Targets (1 - s) onehot + s / C; -sum target * log softmax; times
    the weight of the true class; mean.  A target outside [0, C) is an error."""
    lab = F.col(label_col)
    checked = F.when((lab < 0) | (lab >= n_classes),
                     F.raise_error(F.lit("Target out of range"))).otherwise(lab)
    d = df.withColumn("__lab", checked).withColumn("__lse", _lse(F.col(z_col)))
    w = F.array(*[F.lit(float(x)) for x in weights])
    terms = F.transform(F.col(z_col), lambda zc, c: (
        (F.lit(1.0 - smoothing) * (c == F.col("__lab")).cast("double") + F.lit(smoothing / n_classes))
        * (zc - F.col("__lse"))))
    per = -F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) * F.element_at(w, F.col("__lab") + 1)
    return d.agg(F.round(F.avg(per), 6).alias("loss"))


def reconstruction_plus_kl(df: DataFrame, x: str = "x", xh: str = "xh", m: str = "m", lv: str = "lv") -> DataFrame:
    """-sum(x ln(xh + 1e-8) + (1 - x) ln(1 - xh + 1e-8)) - 0.5 sum(1 + lv - m^2 - e^lv), summed."""
    rec = F.aggregate(F.zip_with(x, xh, lambda a, b: a * F.log(b + 1e-8) + (1 - a) * F.log(1 - b + 1e-8)),
                      F.lit(0.0), lambda s, v: s + v)
    kl = F.aggregate(F.zip_with(m, lv, lambda a, b: 1 + b - a * a - F.exp(b)), F.lit(0.0), lambda s, v: s + v)
    return df.agg(F.round(F.sum(-rec - 0.5 * kl), 6).alias("loss"))


def metrics_by_split(df: DataFrame, z_col: str, label_col: str, keys: Sequence[str],
                     batch_col: str | None = None) -> DataFrame:
    """Cross-entropy and accuracy per key (epoch, split).  With
    ``batch_col`` the loss is the mean of the batches' mean losses (a short
    last batch weighs as much as a full one), else the mean over the rows;
    the accuracy is the share of correct rows."""
    z = F.col(z_col)
    loss = _lse(z) - F.element_at(z_col, F.col(label_col) + 1)
    hit = F.array_position(z, F.array_max(z)) - 1 == F.col(label_col)
    per = df.groupBy(*keys, *([batch_col] if batch_col else [])).agg(
        F.avg(loss).alias("loss"), F.sum(hit.cast("long")).alias("hits"), F.count(hit).alias("rows"))
    return per.groupBy(*keys).agg(F.round(F.avg("loss"), 6).alias("loss"),
                                  F.round(F.sum("hits") / F.sum("rows"), 6).alias("accuracy"))

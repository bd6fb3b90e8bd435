"""Classification metrics (G1-G8) as aggregates.

All counts come from ``count_if`` cells in one pass; the threshold sweep
evaluates every threshold in that same pass (no row x threshold explode);
the AUC is the exact rank-sum over distinct scores (ties averaged).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewise.operators.ordering import argmax_first
from casewise.operators.prefix import running_totals
from casewise.session import cut_lineage

# The 19-point threshold grid 0.05 .. 0.95 (numpy linspace).
THRESHOLDS = [0.05 + i * ((0.95 - 0.05) / 18) for i in range(18)] + [0.95]
SCORE_EPS = 1e-9  # fixed value: added to (max - min) in min-max scaling
METRIC_NAMES = ["accuracy", "balanced_accuracy", "f1", "precision", "recall", "positive_rate"]


def _div0(a: Column, b: Column) -> Column:
    """a / b, 0 when b == 0 (zero_division=0)."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b.cast("double"))


def metric_columns(tn: Column, fp: Column, fn: Column, tp: Column) -> list[Column]:
    n = tn + fp + fn + tp
    precision = _div0(tp, tp + fp)
    recall = _div0(tp, tp + fn)
    specificity = _div0(tn, tn + fp)
    # balanced accuracy averages the recall of the classes present in y_true
    present = (tp + fn > 0).cast("int") + (tn + fp > 0).cast("int")
    bal = F.when(present == 0, F.lit(0.0)).otherwise(
        (F.when(tp + fn > 0, recall).otherwise(0.0) + F.when(tn + fp > 0, specificity).otherwise(0.0))
        / present)
    return [
        _div0(tp + tn, n).alias("accuracy"),
        bal.alias("balanced_accuracy"),
        F.when(precision + recall == 0, F.lit(0.0))
        .otherwise(F.lit(2.0) * precision * recall / (precision + recall)).alias("f1"),
        precision.alias("precision"),
        recall.alias("recall"),
        _div0(tp + fp, n).alias("positive_rate"),
    ]


def confusion_cells(label: Column, pred: Column, suffix: str = "") -> list[Column]:
    return [F.count_if((label == 0) & (pred == 0)).alias(f"tn{suffix}"),
            F.count_if((label == 0) & (pred == 1)).alias(f"fp{suffix}"),
            F.count_if((label == 1) & (pred == 0)).alias(f"fn{suffix}"),
            F.count_if((label == 1) & (pred == 1)).alias(f"tp{suffix}")]


def usable_score(score: Column) -> Column:
    """A missing score is NULL or NaN; it takes part in no metric (no confusion cell, no rank)."""
    return F.nanvl(score.cast("double"), F.lit(None).cast("double"))


def predict(score: Column, threshold: float) -> Column:
    return (usable_score(score) >= F.lit(float(threshold))).cast("int")


def confusion_matrix(df: DataFrame, label: str, pred: str) -> DataFrame:
    """One row tn, fp, fn, tp ([[TN, FP], [FN, TP]])."""
    return df.agg(*confusion_cells(F.col(label), F.col(pred)))


def metrics_from_cells(cells: DataFrame) -> DataFrame:
    c = [F.col(x) for x in ("tn", "fp", "fn", "tp")]
    return cells.select("*", *metric_columns(*c))


def metrics_at_threshold(df: DataFrame, label: str, score: str, threshold: float,
                         with_auc: bool = True) -> DataFrame:
    """G1: accuracy, balanced accuracy, F1, precision, recall, positive rate (+ AUC).

    With the AUC, cells and ranks come from one stored aggregate per distinct score.
    """
    if not with_auc:
        cells = df.agg(*confusion_cells(F.col(label), predict(F.col(score), threshold)))
        return metrics_from_cells(cells).select(F.lit(float(threshold)).alias("threshold"),
                                                *METRIC_NAMES, "tn", "fp", "fn", "tp")
    counts = cut_lineage(score_counts(df, label, score))
    above = F.col("score") >= F.lit(float(threshold))
    zero = F.lit(0).cast("bigint")
    cells = counts.agg(*[F.coalesce(F.sum(F.when(side, F.col(c))), zero).alias(name) for name, side, c in (
        ("tn", ~above, "neg"), ("fp", above, "neg"), ("fn", ~above, "pos"), ("tp", above, "pos"))])
    auc = _auc_of(counts).first()["roc_auc"]  # one scalar
    return metrics_from_cells(cells).select(F.lit(float(threshold)).alias("threshold"), *METRIC_NAMES,
                                            "tn", "fp", "fn", "tp", F.lit(auc).cast("double").alias("roc_auc"))


def score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    """(score, pos, neg): rows of each class per distinct usable score."""
    rows = df.select(usable_score(F.col(score)).alias("score"), F.col(label).alias("__y")).where(
        F.col("score").isNotNull())
    return rows.groupBy("score").agg(F.count_if(F.col("__y") == 1).alias("pos"),
                                     F.count_if(F.col("__y") == 0).alias("neg"))


def _partitions(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _auc_of(counts: DataFrame) -> DataFrame:
    """Rank sum over stored score counts; products are taken in doubles, as pairs pass 2 ** 63 early."""
    cum = running_totals(counts, "score", ["neg"], _partitions(counts), inclusive=False, suffix="_below")
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    sums = cum.agg(F.sum(pos * (F.col("neg_below").cast("double") + F.lit(0.5) * neg)).alias("__u"),
                   F.sum(pos).alias("__p"), F.sum(neg).alias("__n"))
    return sums.select(F.when((F.col("__p") > 0) & (F.col("__n") > 0),
                              F.col("__u") / (F.col("__p") * F.col("__n"))).alias("roc_auc"))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; NULL when only
    one class is present.  Rows without a usable score do not count."""
    return _auc_of(cut_lineage(score_counts(df, label, score)))


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, highest first."""
    counts = cut_lineage(score_counts(df, label, score))
    cum = running_totals(counts, "score", ["pos", "neg"], _partitions(df), descending=True)
    tot = counts.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()
    p, n = tot["P"] or 0, tot["N"] or 0
    return cum.select(F.col("score").alias("threshold"),
                      (F.col("neg_cum") / F.lit(float(n)) if n else F.lit(None).cast("double")).alias("fpr"),
                      (F.col("pos_cum") / F.lit(float(p)) if p else F.lit(None).cast("double")).alias("tpr"))


def threshold_sweep(df: DataFrame, label: str, score: str,
                    thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """Metrics at every threshold from one aggregate pass."""
    lab, sc = F.col(label), F.col(score)
    aggs = []
    for i, t in enumerate(thresholds):
        aggs += confusion_cells(lab, predict(sc, t), suffix=f"_{i}")
    wide = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(float(t)).alias("threshold"),
                 *[F.col(f"{c}_{i}").alias(c) for c in ("tn", "fp", "fn", "tp")])
        for i, t in enumerate(thresholds)]))
    long = wide.select(rows.alias("r")).select("r.*")
    return metrics_from_cells(long).select("position", "threshold", *METRIC_NAMES)


def best_threshold(sweep: DataFrame) -> DataFrame:
    """E5 on G2: best balanced accuracy, lowest threshold on ties."""
    return argmax_first(sweep, "balanced_accuracy", "position",
                        ["position", "threshold", *METRIC_NAMES])


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per-class precision/recall/F1/support plus macro and weighted averages."""
    c = df.agg(*confusion_cells(F.col(label), F.col(pred))).first()
    tn, fp, fn, tp = c["tn"], c["fp"], c["fn"], c["tp"]

    def prf(t, f_p, f_n):
        p = t / (t + f_p) if t + f_p else 0.0
        r = t / (t + f_n) if t + f_n else 0.0
        f = 2 * p * r / (p + r) if p + r else 0.0
        return p, r, f

    rows = []
    p0, r0, f0 = prf(tn, fn, fp)
    p1, r1, f1 = prf(tp, fp, fn)
    s0, s1 = tn + fp, tp + fn
    rows.append(("0", p0, r0, f0, s0))
    rows.append(("1", p1, r1, f1, s1))
    rows.append(("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s0 + s1))
    tot = s0 + s1
    w = (lambda a, b: (a * s0 + b * s1) / tot if tot else 0.0)
    rows.append(("weighted avg", w(p0, p1), w(r0, r1), w(f0, f1), tot))
    return df.sparkSession.createDataFrame(
        rows, "class string, precision double, recall double, f1 double, support bigint")


def minmax_normalise(df: DataFrame, raw: str, out: str = "score") -> DataFrame:
    """(s - min) / (max - min + 1e-9) over the scored DataFrame."""
    mm = df.agg(F.min(raw).alias("lo"), F.max(raw).alias("hi")).first()
    lo, hi = mm["lo"], mm["hi"]
    if lo is None:
        return df.withColumn(out, F.lit(None).cast("double"))
    return df.withColumn(out, (F.col(raw) - F.lit(lo)) / (F.lit(hi - lo) + F.lit(SCORE_EPS)))


def sigmoid(x) -> Column:
    col = F.col(x) if isinstance(x, str) else x
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col))


def positive_probability(prob_col: str = "probability") -> Column:
    """Probability of class 1 from a Spark ML probability vector."""
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(F.col(prob_col))[1]


def evaluate(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """Thresholded report with confusion cells and AUC."""
    return metrics_at_threshold(df, label, score, threshold, with_auc=True)

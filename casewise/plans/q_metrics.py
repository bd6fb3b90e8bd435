"""Registered scoring-metric queries (E5, G1-G8, G11) on the stand-in score."""

from __future__ import annotations

from pyspark.sql import functions as F

from casewise.functions.columns import label_filter_map
from casewise.operators import metrics as M
from casewise.plans import sql as S
from casewise.plans.catalog import register
from casewise.plans.common import r6
from casewise.sources.views import cases_view

_LAB = "upper(trim(coalesce(case_status, 'nan')))"
SCORED = (f"SELECT case_id, CAST({_LAB} = 'F' AS INTEGER) AS label, score FROM cases "
          f"WHERE {_LAB} IN ('F', 'O')")


def scored(spark, sf_dir):
    df = cases_view(spark, sf_dir).select("case_id", "case_status", "score")
    return label_filter_map(df, "case_status", "F", "O")


def _d(v: float) -> str:
    return f"CAST({v!r} AS DOUBLE)"


def cells_sql(thr: float) -> str:
    t = _d(thr)
    return (f"count(*) FILTER (WHERE label = 0 AND NOT score >= {t}) AS tn, "
            f"count(*) FILTER (WHERE label = 0 AND score >= {t}) AS fp, "
            f"count(*) FILTER (WHERE label = 1 AND NOT score >= {t}) AS fn, "
            f"count(*) FILTER (WHERE label = 1 AND score >= {t}) AS tp")


METRICS_SQL = """
round(CASE WHEN tn+fp+fn+tp = 0 THEN 0.0 ELSE (tp+tn)/(tn+fp+fn+tp) END, 6) AS accuracy,
round(CASE WHEN (tp+fn > 0)::INT + (tn+fp > 0)::INT = 0 THEN 0.0 ELSE
  ((CASE WHEN tp+fn > 0 THEN tp/(tp+fn) ELSE 0.0 END) + (CASE WHEN tn+fp > 0 THEN tn/(tn+fp) ELSE 0.0 END))
  / ((tp+fn > 0)::INT + (tn+fp > 0)::INT) END, 6) AS balanced_accuracy,
round(CASE WHEN pr + rc = 0 THEN 0.0 ELSE 2.0*pr*rc/(pr+rc) END, 6) AS f1,
round(pr, 6) AS precision, round(rc, 6) AS recall,
round(CASE WHEN tn+fp+fn+tp = 0 THEN 0.0 ELSE (tp+fp)/(tn+fp+fn+tp) END, 6) AS positive_rate"""

PR_SQL = ("*, CASE WHEN tp+fp = 0 THEN 0.0 ELSE tp/(tp+fp) END AS pr, "
          "CASE WHEN tp+fn = 0 THEN 0.0 ELSE tp/(tp+fn) END AS rc")

AUC_SQL = """SELECT CASE WHEN sum(p) > 0 AND sum(n) > 0
  THEN sum(p * (nb + 0.5 * n)) / (sum(p) * sum(n)) END AS roc_auc
FROM (SELECT p, n, coalesce(sum(n) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb
      FROM (SELECT score, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n
            FROM scored GROUP BY score))"""

def _m6():
    return [r6(c) for c in M.METRIC_NAMES]


@register("metrics_at_threshold", S.with_cases(
    f"SELECT {_d(0.55)} AS threshold, {METRICS_SQL}, tn, fp, fn, tp, "
    f"round((SELECT roc_auc FROM auc), 6) AS roc_auc FROM (SELECT {PR_SQL} FROM c)",
    scored=SCORED, c=f"SELECT {cells_sql(0.55)} FROM scored", auc=AUC_SQL))
def q_metrics_at_threshold(spark, sf_dir):
    out = M.metrics_at_threshold(scored(spark, sf_dir), "label", "score", 0.55)
    return out.select("threshold", *_m6(), "tn", "fp", "fn", "tp", r6("roc_auc"))


def _sweep_sql() -> str:
    parts = [f"SELECT {i} AS position, {_d(t)} AS threshold, {cells_sql(t)} FROM scored"
             for i, t in enumerate(M.THRESHOLDS)]
    return " UNION ALL ".join(parts)


@register("threshold_sweep", S.with_cases(
    f"SELECT CAST(position AS INTEGER) AS position, threshold, {METRICS_SQL} FROM (SELECT {PR_SQL} FROM c)",
    scored=SCORED, c=_sweep_sql()))
def q_threshold_sweep(spark, sf_dir):
    out = M.threshold_sweep(scored(spark, sf_dir), "label", "score")
    return out.select("position", "threshold", *_m6())


@register("best_threshold", S.with_cases(
    f"SELECT * FROM (SELECT CAST(position AS INTEGER) AS position, threshold, {METRICS_SQL} "
    f"FROM (SELECT {PR_SQL} FROM c)) ORDER BY balanced_accuracy DESC, position LIMIT 1",
    scored=SCORED, c=_sweep_sql()))
def q_best_threshold(spark, sf_dir):
    """E5 + G2: first threshold with the best balanced accuracy."""
    sweep = M.threshold_sweep(scored(spark, sf_dir), "label", "score")
    return M.best_threshold(sweep.select("position", "threshold", *_m6()))


@register("confusion_matrix", S.with_cases(
    f"SELECT {cells_sql(0.5)} FROM scored", scored=SCORED))
def q_confusion_matrix(spark, sf_dir):
    df = scored(spark, sf_dir).withColumn("pred", M.predict(F.col("score"), 0.5))
    return M.confusion_matrix(df, "label", "pred")


@register("roc_auc", S.with_cases(f"SELECT round(roc_auc, 6) AS roc_auc FROM ({AUC_SQL})", scored=SCORED))
def q_roc_auc(spark, sf_dir):
    return M.roc_auc(scored(spark, sf_dir), "label", "score").select(r6("roc_auc"))


@register("roc_auc_missing", S.with_cases(f"SELECT round(roc_auc, 6) AS roc_auc FROM ({AUC_SQL})",
                                          scored=SCORED + " AND case_id % 7 <> 0"))
def q_roc_auc_missing(spark, sf_dir):
    """G4 with every seventh score missing: rows without a score take no part."""
    df = scored(spark, sf_dir)
    gone = F.when(F.col("case_id") % 14 == 0, F.lit(float("nan"))).when(F.col("case_id") % 7 == 0, F.lit(None).cast("double"))
    df = df.withColumn("score", F.when(F.col("case_id") % 7 == 0, gone).otherwise(F.col("score")))
    return M.roc_auc(df, "label", "score").select(r6("roc_auc"))


@register("roc_curve", S.with_cases(
    """SELECT score AS threshold,
       round(sum(n) OVER (ORDER BY score DESC) / (SELECT count(*) FILTER (WHERE label = 0) FROM scored), 6) AS fpr,
       round(sum(p) OVER (ORDER BY score DESC) / (SELECT count(*) FILTER (WHERE label = 1) FROM scored), 6) AS tpr
FROM (SELECT score, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n
      FROM scored GROUP BY score)""", scored=SCORED))
def q_roc_curve(spark, sf_dir):
    out = M.roc_curve(scored(spark, sf_dir), "label", "score")
    return out.select("threshold", r6("fpr"), r6("tpr"))


@register("classification_report", S.with_cases(
    """SELECT '0' AS class, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1, s0 AS support FROM k
UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1_, 6), s1 FROM k
UNION ALL SELECT 'macro avg', round((p0+p1)/2, 6), round((r0+r1)/2, 6), round((f0+f1_)/2, 6), s0+s1 FROM k
UNION ALL SELECT 'weighted avg', round((p0*s0+p1*s1)/(s0+s1), 6), round((r0*s0+r1*s1)/(s0+s1), 6),
                 round((f0*s0+f1_*s1)/(s0+s1), 6), s0+s1 FROM k""",
    scored=SCORED, c=f"SELECT {cells_sql(0.5)} FROM scored",
    k0="""SELECT CASE WHEN tn+fn = 0 THEN 0.0 ELSE tn/(tn+fn) END AS p0,
                 CASE WHEN tn+fp = 0 THEN 0.0 ELSE tn/(tn+fp) END AS r0,
                 CASE WHEN tp+fp = 0 THEN 0.0 ELSE tp/(tp+fp) END AS p1,
                 CASE WHEN tp+fn = 0 THEN 0.0 ELSE tp/(tp+fn) END AS r1,
                 tn+fp AS s0, tp+fn AS s1 FROM c""",
    k="""SELECT *, CASE WHEN p0+r0 = 0 THEN 0.0 ELSE 2*p0*r0/(p0+r0) END AS f0,
                CASE WHEN p1+r1 = 0 THEN 0.0 ELSE 2*p1*r1/(p1+r1) END AS f1_ FROM k0"""))
def q_classification_report(spark, sf_dir):
    df = scored(spark, sf_dir).withColumn("pred", M.predict(F.col("score"), 0.5))
    out = M.classification_report(df, "label", "pred")
    return out.select("class", r6("precision"), r6("recall"), r6("f1"), "support")


@register("evaluate", S.with_cases(
    f"SELECT {_d(0.5)} AS threshold, {METRICS_SQL}, tn, fp, fn, tp, "
    f"round((SELECT roc_auc FROM auc), 6) AS roc_auc FROM (SELECT {PR_SQL} FROM c)",
    scored=SCORED, c=f"SELECT {cells_sql(0.5)} FROM scored", auc=AUC_SQL))
def q_evaluate(spark, sf_dir):
    """Stored threshold (default 0.5)."""
    out = M.evaluate(scored(spark, sf_dir), "label", "score", 0.5)
    return out.select("threshold", *_m6(), "tn", "fp", "fn", "tp", r6("roc_auc"))


@register("score_normalise", S.with_cases(
    """SELECT case_id, round((prevailing_wage - (SELECT min(prevailing_wage) FROM cases))
       / ((SELECT max(prevailing_wage) - min(prevailing_wage) FROM cases) + 1e-9), 6) AS score_minmax,
       round(1.0 / (1.0 + exp(-(score * 10.0 - 5.0))), 6) AS score_sigmoid FROM cases"""))
def q_score_normalise(spark, sf_dir):
    """Batch min-max over the scored frame; sigmoid for row-wise scoring."""
    df = cases_view(spark, sf_dir).select("case_id", "prevailing_wage", "score")
    out = M.minmax_normalise(df, "prevailing_wage", "score_minmax")
    out = out.withColumn("score_sigmoid", M.sigmoid(F.col("score") * 10.0 - 5.0))
    return out.select("case_id", r6("score_minmax"), r6("score_sigmoid"))


@register("positive_rate", S.with_cases(
    f"SELECT round(avg(CASE WHEN score >= {_d(0.5)} THEN 1.0 ELSE 0.0 END), 6) AS predicted_positive_rate, "
    "round(avg(label), 6) AS true_positive_rate FROM scored", scored=SCORED))
def q_positive_rate(spark, sf_dir):
    """Mean predicted and true class."""
    df = scored(spark, sf_dir)
    return df.agg(F.avg(M.predict(F.col("score"), 0.5)).alias("predicted_positive_rate"),
                  F.avg("label").alias("true_positive_rate")).select(
        r6("predicted_positive_rate"), r6("true_positive_rate"))


@register("argmax_first", S.with_cases(
    f"SELECT * FROM (SELECT CAST(position AS INTEGER) AS position, threshold, {METRICS_SQL} "
    f"FROM (SELECT {PR_SQL} FROM c)) ORDER BY accuracy DESC, position LIMIT 1",
    scored=SCORED, c=_sweep_sql()))
def q_argmax_first(spark, sf_dir):
    """E5: first row with the largest accuracy in the sweep (strict > keeps the first)."""
    from casewise.operators.ordering import argmax_first
    sweep = M.threshold_sweep(scored(spark, sf_dir), "label", "score").select("position", "threshold", *_m6())
    return argmax_first(sweep, "accuracy", "position", ["position", "threshold", *M.METRIC_NAMES])

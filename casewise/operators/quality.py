"""Data-quality checks (E6, G12) over train/test splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewise.functions.columns import resolve_column
from casewise.operators.profile import duplicate_count
from casewise.session import cut_lineage


def column_frame(spark: SparkSession, df: DataFrame) -> DataFrame:
    return spark.createDataFrame([(c,) for c in df.columns], "column string")


def column_diff(train: DataFrame, test: DataFrame) -> DataFrame:
    """Columns only in train / only in test as rows (column, side)."""
    spark = train.sparkSession
    a, b = column_frame(spark, train), column_frame(spark, test)
    only_train = a.exceptAll(b).withColumn("side", F.lit("train"))
    only_test = b.exceptAll(a).withColumn("side", F.lit("test"))
    return only_train.unionByName(only_test)


def validation_report(train: DataFrame, test: DataFrame, target: str, positive: str,
                      negative: str, raise_on_failure: bool = False, shown_classes: int = 20) -> DataFrame:
    """One-row report: status, shapes, targets, class sample, duplicates, issues.

    Raises ``ValueError`` when the target cannot be resolved in either split
    (the reference's guard); a column mismatch sets ``status`` false.
    """
    t_train, t_test = resolve_column(train, target), resolve_column(test, target)
    if t_train is None or t_test is None:
        raise ValueError(f"no column matches the target {target!r}: train has {train.columns}, test has {test.columns}")
    extra_train = sorted(set(train.columns) - set(test.columns))
    extra_test = sorted(set(test.columns) - set(train.columns))
    status = not (extra_train or extra_test)
    n_train, n_test = train.count(), test.count()
    dup_train, dup_test = (duplicate_count(x).first()["duplicates"] for x in (train, test))
    classes = cut_lineage(train.select(F.col(t_train).cast("string").alias("v")).where(F.col("v").isNotNull()).distinct())
    # the whole class set decides; only the printed sample is cut
    has = classes.agg(F.count_if(F.col("v") == positive).alias("p"), F.count_if(F.col("v") == negative).alias("n")).first()
    sample = [r["v"] for r in classes.orderBy("v").limit(shown_classes).collect()]
    issue = "" if status else f"column_mismatch extra_in_train={extra_train} extra_in_test={extra_test}"
    row = (status, n_train, len(train.columns), n_test, len(test.columns), target, t_train,
           ",".join(sample), has["p"] > 0, has["n"] > 0, dup_train, dup_test, issue)
    report = train.sparkSession.createDataFrame([row], REPORT_SCHEMA)
    if raise_on_failure and not status:
        raise ValueError(f"Validation failed: {issue}")
    return report


REPORT_SCHEMA = ("status boolean, train_rows bigint, train_cols bigint, test_rows bigint, "
                 "test_cols bigint, configured_target string, resolved_target string, "
                 "target_sample string, has_positive boolean, has_negative boolean, "
                 "duplicates_train bigint, duplicates_test bigint, issues string")

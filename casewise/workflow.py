"""User-level entry points mirroring the reference's scripts.

* ``train(spark, cfg)``   -- entry 1: ingest -> validate -> transform -> select
  -> refit -> evaluate -> persist (splits, reports, bundle, metrics).
* ``score(spark, bundle_path, input_path, output_path)`` -- entry 2 for files.
* ``profile(spark, path)`` -- entry 4: domains, ranges, row count.
* ``diagnose_splits(spark, root)`` -- class counts and majority baselines.

Command line: ``python -m casewise.workflow train --config config.yaml``.
"""

from __future__ import annotations

import argparse
import json
import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casewise.config import AppConfig, load_config
from casewise.functions.columns import resolve_column
from casewise.operators import metrics as M
from casewise.operators import profile as P
from casewise.operators import quality as Q
from casewise.operators import select as SL
from casewise.operators.sampling import stratified_split
from casewise.session import build_session, cut_lineage
from casewise.sources import sinks as SK
from casewise.sources.tables import read_cases

DEFAULT_MODELS = ["logreg", "random_forest", "extra_trees", "knn", "hgb"]


def _json(spark: SparkSession, obj: dict, path: str) -> None:
    """A report as one JSON document written by Spark."""
    spark.createDataFrame([(json.dumps(obj, default=str),)], "report string") \
        .coalesce(1).write.mode("overwrite").text(path)


def train(spark: SparkSession, cfg: AppConfig, models: list[str] | None = None, params: dict | None = None,
          id_col: str | None = None, resample: bool = True) -> dict:
    t = cfg.training
    root = cfg.artifacts.root_dir
    raw = read_cases(spark, cfg.dataset.csv_path, cfg.dataset.fmt)
    target = resolve_column(raw, t.target_column)
    if target is None:
        raise ValueError(f"no column matches the target {t.target_column!r}: the data have {raw.columns}")
    if id_col is None:
        id_col = resolve_column(raw, "case_id")
    if id_col is None:  # no id: a digest of the row, numbered among equal rows
        raw = raw.withColumn("__d", F.md5(F.to_json(F.struct(*raw.columns), {"ignoreNullFields": "false"})))
        same = F.row_number().over(Window.partitionBy("__d").orderBy("__d"))
        raw = cut_lineage(raw.withColumn("case_id", F.concat("__d", F.lit("-"), same.cast("string"))).drop("__d"))
        id_col = "case_id"
    else:
        repeats = raw.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        if not repeats.isEmpty():  # equal ids are told apart by number, so that ids are unique
            same = F.row_number().over(Window.partitionBy(id_col).orderBy(F.xxhash64(*raw.columns)))
            numbered = F.concat(F.col(id_col).cast("string"), F.when(F.col("__n") > 1, F.concat(F.lit("#"), F.col("__n").cast("string"))).otherwise(""))
            raw = cut_lineage(raw.withColumn("__n", same).withColumn(id_col, numbered).drop("__n"))
    # ingest: split stratified on the raw target, write raw / train / test
    split = cut_lineage(stratified_split(raw, target, id_col, t.test_size, t.random_state))
    SK.write_table(raw, f"{root}/data/raw", "parquet")
    SK.write_table(split, f"{root}/data/splits", "parquet", partition_by=["split"])
    train_df = split.where(F.col("split") == "train").drop("split")
    test_df = split.where(F.col("split") == "test").drop("split")
    # inferred schema as YAML (column metadata only)
    import yaml
    from casewise.functions.columns import is_numeric_type
    schema = {"columns": raw.columns,
              "dtypes": {f.name: f.dataType.simpleString() for f in raw.schema.fields},
              "numeric_columns": [f.name for f in raw.schema.fields if is_numeric_type(f.dataType)],
              "categorical_columns": [f.name for f in raw.schema.fields if not is_numeric_type(f.dataType)],
              "target_column": target}
    spark.createDataFrame([(yaml.safe_dump(schema, sort_keys=False),)], "yaml string").coalesce(1) \
        .write.mode("overwrite").text(f"{root}/validation/schema_inferred")
    # validate (raises on column drift, as the reference does)
    report = Q.validation_report(train_df.drop(id_col), test_df.drop(id_col), t.target_column,
                                 t.positive_class, t.negative_class, raise_on_failure=False)
    SK.write_report(report, f"{root}/validation/validation_report", "json")
    SK.write_report(P.missing_percent(train_df, test_df), f"{root}/validation/missing_report", "csv")
    if not report.first()["status"]:
        raise ValueError("Validation failed; see validation_report")
    # transform + select + refit + evaluate
    prep = SL.prepare(split.withColumnRenamed(target, "__target"), "__target", t.positive_class,
                      t.negative_class, t.test_size, t.random_state, t.as_of_year, t.feature_set,
                      id_col)
    sel = SL.train_select(prep, models or DEFAULT_MODELS, params, resample=resample, seed=t.random_state,
                          id_col=id_col)
    bundle = SL.Bundle(prep.preprocessor, sel.best, sel.threshold, t.positive_class, t.negative_class,
                       t.target_column)
    bundle.save(f"{root}/model")
    scored = cut_lineage(sel.best.score(prep.test).select("label", "score"))
    cells = M.confusion_matrix(scored.withColumn("pred", M.predict(F.col("score"), sel.threshold)),
                               "label", "pred").first()
    summary = {
        "best_model_name": sel.best.name, "best_threshold": sel.threshold,
        "models": [r.asDict() for r in sel.report.collect()],
        "test_metrics_thresholded": sel.test_metrics,
        "confusion_matrix": [[cells["tn"], cells["fp"]], [cells["fn"], cells["tp"]]],
    }
    _json(spark, summary, f"{root}/model_evaluation")
    return summary


def score(spark: SparkSession, bundle_path: str, input_path: str, output_path: str,
          fmt: str = "csv", norm: str | None = None) -> DataFrame:
    bundle = SL.Bundle.load(spark, bundle_path)
    rows = read_cases(spark, input_path, fmt)
    out = bundle.score(rows, norm=norm)
    keep = [c for c in ("case_id",) if c in out.columns] + ["score", "pred", "label_text", "threshold"]
    SK.write_table(out.select(*keep), output_path, "parquet")
    return spark.read.parquet(output_path)


def profile(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    from casewise.plans.q_scoring import meta_profile
    return meta_profile(read_cases(spark, path, fmt))


def diagnose_splits(spark: SparkSession, root: str, target: str) -> DataFrame:
    from casewise.plans.q_scoring import diagnose_split
    sp = spark.read.parquet(f"{root}/data/splits")
    return diagnose_split(sp, resolve_column(sp, target))


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="casewise")
    sub = ap.add_subparsers(dest="cmd", required=True)
    tr = sub.add_parser("train")
    tr.add_argument("--config", required=True)
    sc = sub.add_parser("score")
    sc.add_argument("--bundle", required=True)
    sc.add_argument("--input", required=True)
    sc.add_argument("--output", required=True)
    args = ap.parse_args(argv)
    spark = build_session()
    if args.cmd == "train":
        print(json.dumps(train(spark, load_config(args.config)), default=str, indent=2))
    else:
        score(spark, args.bundle, args.input, args.output).show(20, truncate=False)


if __name__ == "__main__":
    main()

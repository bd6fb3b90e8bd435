"""Training workflow (M10-M13, A6, G9): prepare, select by balanced accuracy,
refit, evaluate, persist and score.

The driver only loops over a handful of model fits and reads back metric
rows (19 thresholds per model); every data pass is a Spark job.
"""

from __future__ import annotations

import datetime as _dt
import itertools
import json
import random
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casewise.functions.columns import drop_columns, label_filter_map
from casewise.operators import boosting, forests, kernel_svc
from casewise.operators import encode as EN
from casewise.operators import metrics as M
from casewise.operators.binned import Bins, as_array, matrix, width_of
from casewise.operators.features import WageFeatureModel, WageFeatures, derive_basic
from casewise.operators.models import BOOSTERS, FORESTS, REFERENCE_DEFAULTS, FittedModel, fit_model
from casewise.operators.sampling import stratified_sample, stratified_split
from casewise.session import cut_lineage

# Column routing of the preprocessor (one-hot block, power block;
# every other numeric column is median-imputed and scaled).
CATEGORICAL = ["continent", "unit_of_wage", "region_of_employment", "education_of_employee",
               "has_job_experience", "requires_job_training", "full_time_position"]
POWER_CANDIDATES = ["company_age", "no_of_employees", "annual_wage", "wage_per_employee"]


@dataclass
class Preprocessor:
    wage: WageFeatureModel | None
    pipeline: PipelineModel
    as_of_year: int
    feature_set: str
    id_col: str = "case_id"

    def transform(self, df: DataFrame, clamp_age: bool = False) -> DataFrame:
        ids = df.withColumnRenamed(self.id_col, "__id") if self.id_col in df.columns else df
        base = derive_basic(ids, self.as_of_year, id_col=self.id_col, clamp=clamp_age)
        if self.feature_set == "engineered" and self.wage is not None:
            base = self.wage.transform(base)
        out = self.pipeline.transform(base)
        return out.withColumnRenamed("__id", self.id_col) if "__id" in out.columns else out


def _column_lists(df: DataFrame, feature_set: str):
    from casewise.functions.columns import is_numeric_type
    onehot = [c for c in CATEGORICAL if c in df.columns]
    power = [c for c in POWER_CANDIDATES if c in df.columns]
    numeric = [f.name for f in df.schema.fields
               if is_numeric_type(f.dataType) and f.name not in power and f.name not in ("label", "__id")]
    return onehot, power, numeric


def fit_preprocessor(train: DataFrame, as_of_year: int, feature_set: str = "engineered",
                     id_col: str = "case_id") -> Preprocessor:
    """Train-only statistics: group medians, imputers, Yeo-Johnson, scaling.

    ``feature_set='raw'`` routes only the columns present before feature
    engineering (what the reference's model ends up seeing);
    ``'engineered'`` also routes the derived wage features.
    """
    ids = train.withColumnRenamed(id_col, "__id")
    base = derive_basic(ids, as_of_year, id_col=id_col)
    wage = None
    if feature_set == "engineered":
        wage = WageFeatures().fit(base)
        routed = wage.transform(base)
    else:
        routed = base
    onehot, power, numeric = _column_lists(routed if feature_set == "engineered" else base, feature_set)
    pipe = EN.column_transformer(onehot, power, numeric).fit(routed)
    return Preprocessor(wage, pipe, as_of_year, feature_set, id_col)


@dataclass
class Prepared:
    train: DataFrame   # case_id, features, label
    test: DataFrame
    preprocessor: Preprocessor
    dropped: int = 0


def prepare(cases: DataFrame, target: str, positive: str, negative: str, test_size: float = 0.2,
            seed: int = 42, as_of_year: int = 2025, feature_set: str = "engineered",
            id_col: str = "case_id") -> Prepared:
    """Entry 1 up to the feature matrices: split raw rows (stratified on the
    raw target; a ``split`` column that ``cases`` already has is kept), filter/map
    labels, fit features on train only, transform both."""
    own = "split" not in cases.columns
    # the fits read a few columns each, many times: from columns in memory, else on local disk
    split = cut_lineage(stratified_split(cases, target, id_col, test_size, seed)).persist() if own else cases
    train = label_filter_map(split.where(F.col("split") == "train").drop("split"), target, positive, negative)
    test = label_filter_map(split.where(F.col("split") == "test").drop("split"), target, positive, negative)
    pre = fit_preprocessor(drop_columns(train, ["score"]), as_of_year, feature_set, id_col)
    keep = [id_col, "features", "label"]
    tr = cut_lineage(pre.transform(drop_columns(train, ["score"])).select(*keep))
    te = cut_lineage(pre.transform(drop_columns(test, ["score"])).select(*keep))
    if own:
        split.unpersist()
    return Prepared(tr, te, pre)


def resample_vectors(df: DataFrame, id_col: str = "case_id", seed: int = 42) -> DataFrame:
    """SMOTE+ENN on feature vectors, minority grown to the majority (train fold only)."""
    from casewise.operators.resample import smoteenn
    counts = {r["label"]: r["count"] for r in df.groupBy("label").count().collect()}
    if len(counts) < 2:
        return df
    minority = min(counts, key=lambda c: (counts[c], c))
    arr = df.select(F.col(id_col).alias("id"), vector_to_array("features").alias("vec"), "label")
    out = smoteenn(arr, "id", "vec", "label", minority, seed=seed)
    return cut_lineage(out.select(F.col("id").alias(id_col), array_to_vector("vec").alias("features"), "label"))


@dataclass
class Selection:
    report: DataFrame
    best: FittedModel
    threshold: float
    test_metrics: dict = field(default_factory=dict)


def tune_threshold(model: FittedModel, val: DataFrame) -> tuple[float, dict]:
    scored = model.score(val).select("label", "score")
    scored = cut_lineage(scored)
    best = M.best_threshold(M.threshold_sweep(scored, "label", "score")).first().asDict()
    best["roc_auc"] = M.roc_auc(scored, "label", "score").first()["roc_auc"]
    return float(best["threshold"]), best


def train_select(prep: Prepared, models: list[str], params: dict | None = None, resample: bool = True,
                 seed: int = 42, id_col: str = "case_id") -> Selection:
    """Fit each model on the (resampled once) inner train fold, tune its
    threshold on the validation fold, keep the best balanced accuracy (first
    wins ties), refit it on the whole (resampled) train, test once."""
    params = params or {}
    spark = prep.train.sparkSession
    inner = cut_lineage(stratified_split(prep.train, "label", id_col, 0.2, seed))
    tr = inner.where(F.col("split") == "train").drop("split")
    val = inner.where(F.col("split") == "test").drop("split")
    tr_fit = resample_vectors(tr, id_col, seed) if resample else tr
    rows, best = [], None
    for name in models:
        m = fit_model(name, tr_fit, params=params.get(name), seed=seed, id_col=id_col)
        thr, met = tune_threshold(m, val)
        rows.append((name, thr, met["balanced_accuracy"], met["accuracy"], met["f1"], met["precision"],
                     met["recall"], met["positive_rate"], met["roc_auc"], resample))
        if best is None or met["balanced_accuracy"] > best[2]:
            best = (name, thr, met["balanced_accuracy"])
    name, thr, _ = best
    full = resample_vectors(prep.train, id_col, seed) if resample else prep.train
    final = fit_model(name, full, params=params.get(name), seed=seed, id_col=id_col)
    test_scored = cut_lineage(final.score(prep.test).select("label", "score"))
    tm = M.metrics_at_threshold(test_scored, "label", "score", thr).first().asDict()
    report = spark.createDataFrame(
        [r + (r[0] == name,) for r in rows],
        "model string, threshold double, val_balanced_accuracy double, val_accuracy double, val_f1 double, "
        "val_precision double, val_recall double, val_positive_rate double, val_roc_auc double, "
        "resampled boolean, selected boolean")
    return Selection(report, final, thr, tm)


# The reference's random-search spaces, in the parameter names of the
# learners here ("all" and None: no limit; a booster's minimum child weight is a minimum of
# Hessian).  Nearest-neighbour search space: k in (3, 4, 5, 7, 9) x weights in (uniform, distance).
REFERENCE_GRIDS = {
    "xgboost": {"max_depth": [3, 5, 7, 9], "min_hessian": [1.0, 3.0, 5.0]},
    "random_forest": {"max_depth": [10, 12, None, 15, 20], "looks": ["sqrt", "log2", "all"],
                      "trees": [10, 50, 100, 200]},
}


def random_search(prep: Prepared, model: str = "random_forest", grid: dict | None = None, n_iter: int = 100, folds: int = 3,
                  seed: int = 42, id_col: str = "case_id") -> DataFrame:
    """(params, cv_accuracy) of up to ``n_iter`` seeded draws from ``grid`` (default: the grid of record).

    One binned matrix serves all draws and folds.  Boosters: all fits run side by side, a task each.
    Forests: trees are grown once per fold and number of features, every depth and forest size is read off
    them.  A matrix too large to be held is fitted point by point.
    """
    grid = grid or REFERENCE_GRIDS[model]
    points = [dict(zip(grid, v, strict=True)) for v in itertools.product(*grid.values())]
    if len(points) > n_iter:
        points = random.Random(seed).sample(points, n_iter)
    data = prep.train.withColumn("fold", F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(folds)).cast("int"))
    bins = Bins.fit(data, "features")
    m = matrix(data, "features", "label", id_col, bins, width_of(data, "features"), ["fold"])
    named = {json.dumps(p, sort_keys=True): p for p in points}
    if not m.held:
        rows = [(n, f, _accuracy(fit_model(model, data.where(F.col("fold") != f), params=p, seed=seed, id_col=id_col).score(
            data.where(F.col("fold") == f)))) for n, p in named.items() for f in range(folds)]
    elif model == "random_forest":
        pick = {k: sorted({p[k] for p in points}, key=lambda v: (v is None, v)) for k in ("looks", "max_depth", "trees")}
        got = forests.search(m, pick["looks"], pick["max_depth"], pick["trees"], folds, seed).collect()  # a row a point and fold
        by = {(r.looks, r.max_depth, r.trees, r.fold): r.accuracy for r in got}
        rows = [(n, f, by[p["looks"], p["max_depth"], p["trees"], f]) for n, p in named.items() for f in range(folds)]
    else:
        jobs = [(n, f) for n in named for f in range(folds)]
        options = [boosting.Options(**{"seed": seed, **REFERENCE_DEFAULTS[model], **named[n]}) for n, _ in jobs]
        fitted = boosting.fit_many(bins, m, options, [f for _, f in jobs])
        rows = []
        for f in range(folds):  # all models of a fold score it in one pass
            mine = [(n, mod) for (n, g), mod in zip(jobs, fitted, strict=True) if g == f]
            vec = as_array(data, "features")
            right = [F.avg(((mod.probability(vec) > 0.5).cast("int") == F.col("label")).cast("double")) for _, mod in mine]
            got = data.where(F.col("fold") == f).agg(*right).first()
            rows += [(n, f, a) for (n, _), a in zip(mine, got, strict=True)]
    frame = prep.train.sparkSession.createDataFrame(rows, "params string, fold int, accuracy double")
    return frame.groupBy("params").agg(F.avg("accuracy").alias("cv_accuracy"))


def _accuracy(scored: DataFrame) -> float:
    return scored.agg(F.avg(((F.col("score") > 0.5).cast("int") == F.col("label")).cast("double"))).first()[0]


def leaderboard(prep: Prepared, models: list[str], params: dict | None = None, seed: int = 42) -> DataFrame:
    """Fit every model on train; train and test metrics at 0.5; best test accuracy first."""
    params = params or {}
    rows = []
    for name in models:
        m = fit_model(name, prep.train, params=params.get(name), seed=seed)
        tr, te = (M.metrics_at_threshold(cut_lineage(m.score(d).select("label", "score")), "label", "score", 0.5).first()
                  for d in (prep.train, prep.test))
        rows.append((name, tr["accuracy"], tr["f1"], tr["roc_auc"], te["accuracy"], te["f1"], te["precision"],
                     te["recall"], te["roc_auc"]))
    spark = prep.train.sparkSession
    df = spark.createDataFrame(rows, "model string, train_accuracy double, train_f1 double, train_roc_auc double, "
                                     "test_accuracy double, test_f1 double, test_precision double, "
                                     "test_recall double, test_roc_auc double")
    return df.orderBy(F.desc("test_accuracy"), "model")


def learning_curve(prep: Prepared, model: str = "hgb", sizes=(1000, 3000, 6000, 12000), params=None,
                   seed: int = 42, id_col: str = "case_id") -> DataFrame:
    """For each size (those below n, then n): stratified subset, inner
    split, threshold on validation, refit on the subset, test once.
    Unknown names and ``logreg`` fall back to the default booster."""
    from casewise.operators.sampling import learning_curve_sizes
    if model not in ("hgb", "random_forest", "extra_trees", "knn"):
        model = "hgb"
    n = prep.train.count()
    rows = []
    for s in learning_curve_sizes(n, sizes):
        sub = cut_lineage(stratified_sample(prep.train, "label", id_col, s, seed))
        inner = cut_lineage(stratified_split(sub, "label", id_col, 0.2, seed))
        tr = inner.where(F.col("split") == "train").drop("split")
        val = inner.where(F.col("split") == "test").drop("split")
        m = fit_model(model, tr, params=params, seed=seed, id_col=id_col)
        thr, _ = tune_threshold(m, val)
        m = fit_model(model, sub, params=params, seed=seed, id_col=id_col)
        sc = cut_lineage(m.score(prep.test).select("label", "score"))
        met = M.metrics_at_threshold(sc, "label", "score", thr).first()
        rows.append((s, thr, met["accuracy"], met["balanced_accuracy"], met["roc_auc"]))
    return prep.train.sparkSession.createDataFrame(
        rows, "train_size long, threshold double, test_accuracy double, test_balanced_accuracy double, "
              "test_roc_auc double")


# --- A6 / G9 -------------------------------------------------------------------------
@dataclass
class Bundle:
    preprocessor: Preprocessor
    model: FittedModel
    threshold: float
    positive: str
    negative: str
    target: str
    created_at: str = ""

    def score(self, df: DataFrame, norm: str | None = None, clamp_age: bool = False) -> DataFrame:
        """Features -> score -> pred (score >= threshold) -> label text."""
        feats = self.preprocessor.transform(df, clamp_age=clamp_age)
        out = self.model.score(feats, norm)
        return out.withColumn("pred", (F.col("score") >= F.lit(self.threshold)).cast("int")) \
            .withColumn("label_text", F.when(F.col("pred") == 1, F.lit(self.positive)).otherwise(F.lit(self.negative))) \
            .withColumn("threshold", F.lit(self.threshold))

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        self.preprocessor.pipeline.write().overwrite().save(f"{path}/preprocessor")
        if self.preprocessor.wage is not None:
            self.preprocessor.wage.write().overwrite().save(f"{path}/wage_features")
        m = self.model
        if m.name in ("knn", "adaboost"):
            m.model.write().overwrite().save(f"{path}/model/stage")
            extra = {}
        elif m.name in FORESTS + BOOSTERS + ("kernel_svc",):
            m.model.save(f"{path}/model/trees")
            extra = {}
        else:
            m.model.write().overwrite().save(f"{path}/model/spark")
            extra = {"class": type(m.model).__name__}
        meta = {"created_at": self.created_at or _dt.datetime.now(_dt.timezone.utc).isoformat(),
                "model_name": m.name, "threshold": self.threshold, "pos_label": self.positive,
                "neg_label": self.negative, "target_column": self.target,
                "as_of_year": self.preprocessor.as_of_year, "feature_set": self.preprocessor.feature_set,
                "score_norm": m.score_norm, "extra": extra}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").json(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Bundle":
        from pyspark.ml import classification as C
        from casewise.operators.models import AdaBoostModel, KnnModel
        meta = json.loads(spark.read.json(f"{path}/meta").first()["meta"])
        pipe = PipelineModel.load(f"{path}/preprocessor")
        wage = None
        if meta["feature_set"] == "engineered":
            wage = WageFeatureModel.load(f"{path}/wage_features")
        pre = Preprocessor(wage, pipe, meta["as_of_year"], meta["feature_set"])
        name, extra = meta["model_name"], meta["extra"]
        if name in ("knn", "adaboost"):
            model = {"knn": KnnModel, "adaboost": AdaBoostModel}[name].load(f"{path}/model/stage")
        elif name in FORESTS + BOOSTERS + ("kernel_svc",):
            kind = {"kernel_svc": kernel_svc.KernelSvcModel}.get(name, forests.ForestModel if name in FORESTS else boosting.BoostedModel)
            model = kind.load(spark, f"{path}/model/trees")
        else:
            model = getattr(C, extra["class"]).load(f"{path}/model/spark")
        fm = FittedModel(name, model, score_norm=meta.get("score_norm", "minmax"))
        return cls(pre, fm, float(meta["threshold"]), meta["pos_label"], meta["neg_label"],
                   meta["target_column"], meta["created_at"])


# The nearest-neighbour search space (the index algorithm of the
# reference's space does not change exact results, so it is not a dimension).
KNN_GRID = {"k": [3, 4, 5, 7, 9], "weights": ["uniform", "distance"]}


def knn_search(prep: Prepared, ks=tuple(KNN_GRID["k"]), weights=tuple(KNN_GRID["weights"]), folds: int = 3,
               seed: int = 42, id_col: str = "case_id") -> DataFrame:
    """M11 for the nearest-neighbour model: k-fold CV accuracy of every (k,
    weights) point.  Per fold one exact KNN join at the largest k; every grid
    point is a sum per query and class over its own neighbours, all points side by side (ties
    between classes go to the smaller label)."""
    from casewise.operators.neighbors import knn_join
    data = prep.train.select(F.col(id_col).alias("id"), vector_to_array("features").alias("vec"),
                             "label", F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(folds)).alias("fold"))
    points = [(k, w) for k in ks for w in weights]
    lab = data.select(F.col("id").alias("rid"), F.col("label").alias("nlab"))
    truth = data.select(F.col("id").alias("qid"), F.col("label").alias("truth"))
    mine = Window.partitionBy("qid")  # max(ks) rows a query
    parts = []
    for f in range(folds):
        nb = knn_join(data.where(F.col("fold") == f), data.where(F.col("fold") != f), max(ks)).join(lab, "rid")
        nb = nb.withColumns({f"__near{k}": F.min(F.when(F.col("rank") <= k, F.col("dist"))).over(mine) for k in ks})

        def weight(k, w):
            if w == "uniform":
                return F.lit(1.0)
            return F.when(F.col(f"__near{k}") == 0, (F.col("dist") == 0).cast("double")).otherwise(F.lit(1.0) / F.col("dist"))
        per = nb.groupBy("qid", "nlab").agg(*[F.sum(F.when(F.col("rank") <= k, weight(k, w))).alias(f"s{i}") for i, (k, w) in enumerate(points)])
        # a class without a neighbour at this point is no candidate
        best = [F.max_by("nlab", F.struct(F.coalesce(F.col(f"s{i}"), F.lit(-1.0)), -F.col("nlab"))) for i in range(len(points))]
        pred = per.groupBy("qid").agg(*[F.when(F.max(f"s{i}").isNotNull(), c).alias(f"p{i}") for i, c in enumerate(best)])
        acc = pred.join(truth, "qid").agg(*[F.avg((F.col(f"p{i}") == F.col("truth")).cast("double")).alias(f"a{i}") for i in range(len(points))])
        row = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(w).alias("weights"), F.col(f"a{i}").alias("acc")) for i, (k, w) in enumerate(points)]))
        parts.append(acc.select(row.alias("g")).select("g.*").where("acc is not null"))
    allf = parts[0]
    for p_ in parts[1:]:
        allf = allf.unionByName(p_)
    return allf.groupBy("k", "weights").agg(F.avg("acc").alias("cv_accuracy"))

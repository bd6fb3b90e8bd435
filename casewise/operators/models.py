"""Model families (M1-M9) on Spark ML and the library's own tree learners, with one scoring interface.

``fit_model(name, df)`` returns a ``FittedModel`` whose ``score(df)`` adds a
``score`` column in [0, 1] for the positive class: the probability when the
model has one, else the margin min-max-scaled over the scored frame (batch)
or passed through a sigmoid (row-wise / streaming scoring).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import DecisionTreeClassifier, LinearSVC, LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewise.operators import adaboost, boosting, forests, kernel_svc
from casewise.operators import metrics as M
from casewise.operators.stages import TableStage

# Defaults of record of the reference's model families.
REFERENCE_DEFAULTS = {
    "logreg": {"maxIter": 4000, "C": 1.0, "balanced": True},
    "random_forest": {"trees": 800, "looks": "sqrt"},
    "extra_trees": {"trees": 1200, "looks": "sqrt", "bootstrap": False, "random_cuts": True},
    "knn": {"k": 9},
    # stops early above 10,000 rows, as the reference's booster does by default
    "hgb": {"max_depth": 4, "rate": 0.06, "rounds": 600},
    "decision_tree": {"maxDepth": 30},
    "gradient_boosting": {"max_depth": 3, "rate": 0.1, "rounds": 100, "max_leaves": None, "min_rows": 1, "min_hessian": 0.0,
                          "second_order": False, "stopping": False},
    "xgboost": {"max_depth": 6, "rate": 0.3, "rounds": 100, "max_leaves": None, "min_rows": 1, "min_hessian": 1.0, "penalty": 1.0,
                "stopping": False, "from_prior": False},
    "catboost": {"max_depth": 6, "rate": 0.03, "rounds": 1000, "symmetric": True, "min_rows": 1, "min_hessian": 0.0, "penalty": 3.0,
                 "stopping": False},
    "linear_svc": {"maxIter": 100},
    "kernel_svc": {"C": 1.0},
    "adaboost": {"rounds": 50},
}
FORESTS, BOOSTERS = ("random_forest", "extra_trees"), ("hgb", "gradient_boosting", "xgboost", "catboost")
MODEL_NAMES = list(REFERENCE_DEFAULTS)
# aliases used by the reference's reports / scripts
ALIASES = {"logreg_balanced": "logreg", "knn_9_distance": "knn"}


@dataclass
class FittedModel:
    name: str
    model: object
    features: str = "features"
    label: str = "label"
    score_norm: str = "minmax"
    extra: dict = field(default_factory=dict)

    def raw(self, df: DataFrame) -> DataFrame:
        """Adds ``score`` (probability) or ``__margin`` (margin-only models)."""
        if self.name == "knn":
            return self.model.score(df, self.features)
        if self.name in ("adaboost", "kernel_svc") or self.name in FORESTS + BOOSTERS:
            return self.model.transform(df)
        out = self.model.transform(df)
        if self.name == "linear_svc":
            return out.withColumn("__margin", vector_to_array("rawPrediction")[1]) \
                .drop("rawPrediction", "prediction")
        return out.withColumn("score", vector_to_array("probability")[1]) \
            .drop("rawPrediction", "probability", "prediction")

    def score(self, df: DataFrame, norm: str | None = None) -> DataFrame:
        out = self.raw(df)
        if "__margin" not in out.columns:
            return out
        norm = norm or self.score_norm
        if norm == "sigmoid":
            return out.withColumn("score", M.sigmoid("__margin")).drop("__margin")
        return M.minmax_normalise(out, "__margin", "score").drop("__margin")


def _weights(df: DataFrame, label: str, out: str = "__w") -> tuple[DataFrame, float]:
    from casewise.operators.resample import class_weights
    w = class_weights(df, label, out)
    return w, float(w.agg(F.sum(out)).first()[0])


def fit_model(name: str, df: DataFrame, features: str = "features", label: str = "label",
              params: dict | None = None, seed: int = 42, score_norm: str = "minmax",
              id_col: str = "case_id") -> FittedModel:
    name = ALIASES.get(name, name)
    p = dict(REFERENCE_DEFAULTS[name])
    p.update(params or {})
    if name == "logreg":
        train, wsum = (_weights(df, label) if p.get("balanced", True)
                       else (df.withColumn("__w", F.lit(1.0)), float(df.count())))
        est = LogisticRegression(featuresCol=features, labelCol=label, weightCol="__w",
                                 maxIter=int(p["maxIter"]), regParam=1.0 / (p["C"] * wsum),
                                 elasticNetParam=0.0, standardization=False)
        return FittedModel(name, est.fit(train), features, label, score_norm)
    if name in FORESTS:
        return FittedModel(name, forests.fit(df, forests.Options(**{"seed": seed, **p}), features, label, id_col), features, label, score_norm)
    if name in BOOSTERS:
        return FittedModel(name, boosting.fit(df, boosting.Options(**{"seed": seed, **p}), features, label, id_col), features, label, score_norm)
    if name == "decision_tree":
        est = DecisionTreeClassifier(featuresCol=features, labelCol=label, seed=seed,
                                     maxDepth=int(p.get("maxDepth", 30)))
        return FittedModel(name, est.fit(df), features, label, score_norm)
    if name == "linear_svc":
        est = LinearSVC(featuresCol=features, labelCol=label, maxIter=int(p["maxIter"]))
        return FittedModel(name, est.fit(df), features, label, score_norm)
    if name == "kernel_svc":
        return FittedModel(name, kernel_svc.fit(df, features=features, label=label, id_col=id_col, seed=seed, **p), features, label, score_norm)
    if name == "knn":
        return FittedModel(name, KnnClassifier(features, label, int(p["k"]), id_col).fit(df), features, label, score_norm)
    if name == "adaboost":
        return FittedModel(name, AdaBoost(features, label, int(p["rounds"]), seed).fit(df), features, label,
                           score_norm)
    raise ValueError(f"unknown model {name}")


# --- M4 as a model ----------------------------------------------------------------
class _KnnParams(HasFeaturesCol, HasLabelCol):
    k = Param(Params._dummy(), "k", "neighbours that vote", TypeConverters.toInt)
    idCol = Param(Params._dummy(), "idCol", "orders references at equal distance", TypeConverters.toString)

    def getK(self) -> int:
        return self.getOrDefault(self.k)


class KnnModel(Model, _KnnParams, TableStage):
    """Lazy learner: keeps the (population-scaled) training vectors, votes at scoring."""
    means = Param(Params._dummy(), "means", "means of the training vectors", TypeConverters.toListFloat)
    stds = Param(Params._dummy(), "stds", "population deviations (0 -> 1)", TypeConverters.toListFloat)

    def __init__(self, train: DataFrame | None = None, k: int = 9, means=(), stds=(), features: str = "features"):
        super().__init__()
        self.train = train
        self._set(k=k, means=list(means), stds=list(stds), featuresCol=features)

    def _tables(self):
        return {"train": self.train}

    def _restore(self, tables):
        self.train = tables["train"]

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.score(df, self.getFeaturesCol())

    @classmethod
    def learn(cls, df: DataFrame, features: str, label: str, k: int, id_col: str = "case_id") -> "KnnModel":
        """``id_col`` orders references at equal distance, so votes do not depend on the partitioning.

        ``df`` is read again at scoring, no copy is kept: callers cut the lineage of what is dear to compute."""
        arr = df.select(F.col(id_col).alias("id"), vector_to_array(features).alias("vec"), F.col(label).alias("label"))
        n = len(arr.first()["vec"])
        st = arr.select(*[F.col("vec")[i].alias(f"v{i}") for i in range(n)]).agg(
            *[F.avg(f"v{i}").alias(f"m{i}") for i in range(n)],
            *[F.stddev_pop(f"v{i}").alias(f"s{i}") for i in range(n)]).first()
        means = [float(st[f"m{i}"] or 0.0) for i in range(n)]
        stds = [float(st[f"s{i}"]) if st[f"s{i}"] else 1.0 for i in range(n)]
        return cls(cls._scale(arr, means, stds), k, means, stds, features)

    @staticmethod
    def _scale(df, means, stds):
        mu = F.array(*[F.lit(m) for m in means])
        sd = F.array(*[F.lit(s) for s in stds])
        return df.withColumn("vec", F.zip_with(F.zip_with("vec", mu, lambda a, b: a - b), sd,
                                               lambda a, b: a / b))

    def score(self, df: DataFrame, features: str) -> DataFrame:
        from casewise.operators.neighbors import knn_class_probability, knn_join
        # equal vectors have equal neighbours: they are searched once, whatever the rows' ids
        vec = vector_to_array(features)
        q = df.withColumn("__qid", F.md5(vec.cast("string")))
        once = q.groupBy("__qid").agg(F.first(vec).alias("vec"))
        qv = self._scale(once.select(F.col("__qid").alias("id"), "vec"), self.getOrDefault(self.means), self.getOrDefault(self.stds))
        refs = self.train.withColumn("id", F.col("id").cast("string"))
        prob = knn_class_probability(knn_join(qv, refs, self.getK()), refs.select("id", "label"))
        return q.join(prob.withColumnRenamed("qid", "__qid"), "__qid", "left").drop("__qid")


class KnnClassifier(Estimator, _KnnParams, DefaultParamsReadable, DefaultParamsWritable):
    """M4 as a Spark ML estimator."""

    def __init__(self, features: str = "features", label: str = "label", k: int = 9, id_col: str = "case_id"):
        super().__init__()
        self._set(featuresCol=features, labelCol=label, k=k, idCol=id_col)

    def _fit(self, df: DataFrame) -> KnnModel:
        m = KnnModel.learn(df, self.getFeaturesCol(), self.getLabelCol(), self.getK(), self.getOrDefault(self.idCol))
        return self._copyValues(m)


# --- M8 ---------------------------------------------------------------------------
class AdaBoostModel(Model, HasFeaturesCol, DefaultParamsReadable, DefaultParamsWritable):
    """One-cut trees and their votes, one entry a round in each list."""
    inputs = Param(Params._dummy(), "inputs", "feature that is cut", TypeConverters.toListInt)
    cuts = Param(Params._dummy(), "cuts", "last value on the left", TypeConverters.toListFloat)
    lefts = Param(Params._dummy(), "lefts", "class on the left", TypeConverters.toListInt)
    rights = Param(Params._dummy(), "rights", "class on the right", TypeConverters.toListInt)
    votes = Param(Params._dummy(), "votes", "weight of the vote", TypeConverters.toListFloat)

    def __init__(self, stumps=(), features: str = "features"):
        super().__init__()
        lists = zip(*stumps, strict=True) if stumps else [()] * 5
        names = ("inputs", "cuts", "lefts", "rights", "votes")
        self._set(featuresCol=features, **{n: list(v) for n, v in zip(names, lists, strict=True)})

    @property
    def stumps(self) -> list[tuple]:
        return list(zip(*(self.getOrDefault(p) for p in (self.inputs, self.cuts, self.lefts, self.rights, self.votes)), strict=True))

    def _transform(self, df: DataFrame) -> DataFrame:
        return adaboost.score(df, self.getFeaturesCol(), self.stumps)


class AdaBoost(Estimator, HasFeaturesCol, HasLabelCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """M8 as a Spark ML estimator."""
    rounds = Param(Params._dummy(), "rounds", "boosting rounds", TypeConverters.toInt)

    def __init__(self, features: str = "features", label: str = "label", rounds: int = 50, seed: int = 42):
        super().__init__()
        self._set(featuresCol=features, labelCol=label, rounds=rounds, seed=seed)

    def _fit(self, df: DataFrame) -> AdaBoostModel:
        features = self.getFeaturesCol()
        stumps = adaboost.fit(df, features, self.getLabelCol(), self.getOrDefault(self.rounds), self.getSeed())
        return self._copyValues(AdaBoostModel(stumps, features))

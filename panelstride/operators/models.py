"""Model fitting, scoring, selection and run records.

Preprocessing is fitted on the training split only (no leakage) and becomes a
``SQLTransformer`` stage of literal column expressions, so imputation, scaling,
assembly and the classifier travel together in one saveable ``PipelineModel``
and score inside whole-stage codegen. Medians are exact
(:func:`exact_quantiles`), the scale is the *population* standard deviation,
and a zero deviation divides by 1.

Logistic regression with ``C = 1`` and an L2 penalty maps to Spark's
``regParam = 1 / sum(weights)`` with ``standardization=False``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from math import ceil

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FEATURE_COLUMNS
from ..session import drop_tables_of, shared_table
from .forest_fit import grow_forest
from .stats import exact_quantiles, mean_std

LABEL = "target_outperform_20d"


def _lit_sql(x: float) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


# ------------------------------------------------------------ linear scorer


@dataclass(frozen=True)
class LinearScorer:
    """``sigmoid(intercept + sum(w * x))`` as a column expression (M9 for linear models)."""

    intercept: float
    weights: tuple[tuple[str, float], ...]
    digits: int | None = None

    def logit(self) -> Column:
        z = F.lit(float(self.intercept))
        for name, w in self.weights:
            z = z + F.lit(float(w)) * F.col(name)
        return z

    def probability(self) -> Column:
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-self.logit()))
        if self.digits is None:
            return p
        scale = float(10 ** self.digits)
        y = p * F.lit(scale)
        return F.signum(y) * F.round(F.abs(y), 0) / F.lit(scale)

    def to_table(self, spark: SparkSession) -> DataFrame:
        rows = [("(intercept)", float(self.intercept))] + [(n, float(w)) for n, w in self.weights]
        return spark.createDataFrame(rows, "feature string, weight double")

    @staticmethod
    def from_table(table: DataFrame, digits: int | None = None) -> "LinearScorer":
        """Coefficient table ``(feature, weight)`` -> scorer (bounded: one row per feature)."""
        rows = [(r["feature"], r["weight"]) for r in table.collect()]
        icpt = sum(w for f, w in rows if f == "(intercept)")
        return LinearScorer(icpt, tuple((f, w) for f, w in rows if f != "(intercept)"), digits)


def score(df: DataFrame, scorer: LinearScorer, threshold: float = 0.5,
          prob: str = "predicted_probability", cls: str = "predicted_class") -> DataFrame:
    """Probability of class 1 and the class (``p > threshold``)."""
    out = df.withColumn(prob, scorer.probability())
    return out.withColumn(cls, (F.col(prob) > F.lit(threshold)).cast("int"))


# ------------------------------------------------------------ preprocessing


@dataclass
class ImputeScale:
    """Train-fitted statistics; ``None`` entries mean the step is off."""

    features: tuple[str, ...]
    medians: dict[str, float] | None = None
    means: dict[str, float] | None = None
    stds: dict[str, float] | None = None

    def expressions(self) -> dict[str, str]:
        out = {}
        for f in self.features:
            e = f"`{f}`"
            if self.medians is not None and self.medians.get(f) is not None:
                e = f"coalesce({e}, {_lit_sql(self.medians[f])})"
            if self.means is not None:
                sd = self.stds.get(f) or 0.0
                sd = sd if sd > 0 else 1.0
                e = f"(({e} - {_lit_sql(self.means.get(f) or 0.0)}) / {_lit_sql(sd)})"
            out[f] = e
        return out

    def stage(self, suffix: str = "__in") -> SQLTransformer:
        cols = ", ".join(f"{e} AS `{f}{suffix}`" for f, e in self.expressions().items())
        return SQLTransformer(statement=f"SELECT *, {cols} FROM __THIS__")

    def apply(self, df: DataFrame) -> DataFrame:
        """Replace each feature by its imputed / scaled value."""
        return df.withColumns({f: F.expr(e) for f, e in self.expressions().items()})


def fit_impute_scale(train: DataFrame, features: Sequence[str] = FEATURE_COLUMNS,
                     impute: bool = False, scale: bool = True) -> ImputeScale:
    """Fit median imputation and/or standard scaling on ``train`` (M3, M4)."""
    model = ImputeScale(tuple(features))
    if impute:
        med = exact_quantiles(train, features, 0.5).collect()
        model.medians = {r["feature"]: r["value"] for r in med}
    if scale:
        base = model.apply(train) if impute else train
        stats = mean_std(base, features).collect()
        model.means = {r["feature"]: r["mean"] for r in stats}
        model.stds = {r["feature"]: r["std"] for r in stats}
    return model


# ------------------------------------------------------------ classifiers


@dataclass(frozen=True)
class Candidate:
    name: str
    kind: str  # "logistic" | "forest"
    impute: bool = False
    scale: bool = True
    balanced: bool = False
    trees: int = 100
    depth: int = 8
    min_leaf: int = 1
    max_iter: int = 1000
    seed: int = 42
    params: Mapping[str, object] = field(default_factory=dict)


NOTEBOOK_CANDIDATES = (
    Candidate("logistic_regression", "logistic"),
    Candidate("random_forest", "forest", scale=False, trees=100, depth=8),
)
LOCAL_CANDIDATES = (
    Candidate("Logistic Regression", "logistic", impute=True, balanced=True),
    Candidate("Random Forest", "forest", impute=True, scale=False, balanced=True, trees=200,
              depth=8, min_leaf=50),
)


def training_table(train: DataFrame, features: Sequence[str], label: str = LABEL,
                   order: Sequence[str] = ("ticker", "date")) -> DataFrame:
    """The training rows a learner needs, written once: in sorted ranges of entity and
    date, whose number grows with the rows. Iterations re-read this table. ``train`` is read
    twice (the ranges are sampled first), so it should be a written table."""
    keys = [c for c in order if c in train.columns]
    rows = train.select(*dict.fromkeys([*keys, *features]), F.col(label).cast("double").alias(label))
    if keys:
        rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return shared_table(rows, "train")


def fit_statistics(data: DataFrame, features: Sequence[str], label: str, impute: bool,
                   scale: bool, medians: Mapping[str, float] | None = None) -> tuple[ImputeScale, dict]:
    """Imputation and scaling, and the rows of each class (after the medians, where they
    are asked for; ``medians``: those of ``data``, where the caller has them). The classes are
    counted on their own: a pass over the label alone, where a rollup would give the wide
    aggregate every row twice."""
    model = ImputeScale(tuple(features))
    if impute and medians is not None:
        model.medians = dict(medians)
    elif impute:
        model.medians = {r["feature"]: r["value"] for r in exact_quantiles(data, features, 0.5).collect()}
    base = model.apply(data) if impute else data
    sums = [f(F.col(c).cast("double")).alias(f"{k}{i}") for i, c in enumerate(features)
            for k, f in (("m", F.avg), ("s", F.stddev_pop))] if scale else []
    if scale:
        total = base.agg(*sums).first()
        model.means = {c: total[f"m{i}"] for i, c in enumerate(features)}
        model.stds = {c: total[f"s{i}"] for i, c in enumerate(features)}
    rows = data.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()  # bounded: a row for each class
    return model, {r[label]: r["n"] for r in rows}


def balanced_weight(counts: Mapping, label: str = LABEL, name: str = "__w") -> Column:
    """``n / (k * n_class)`` as a literal ``when`` chain, from the rows of each class."""
    n, k = sum(counts.values()), len(counts)
    expr = F
    for cls, c in counts.items():
        expr = expr.when(F.col(label) == F.lit(cls), F.lit(n / (k * c)))
    return expr.alias(name)


def fit_candidate(train: DataFrame, cand: Candidate, features: Sequence[str] = FEATURE_COLUMNS,
                  label: str = LABEL) -> PipelineModel:
    """Fit preprocessing + classifier on ``train`` as one ``PipelineModel`` (M5, M6).
    Features missing from ``train`` are left out, as the script chain does."""
    features = [f for f in features if f in train.columns]
    data = training_table(train, features, label)
    model = fit_table(data, cand, features, label)
    drop_tables_of(data)
    return model


def forest_parts(rows: int) -> int:
    """Ranges that a forest's rows are dealt to. The table's own parts are about as many as
    the cluster has cores, and one more than that takes every pass of the fit twice as long;
    each part sends the sums of all nodes in every pass, so there are 48 of them until they
    hold 400,000 rows each."""
    return max(1, min(48, ceil(rows / 20_000)), ceil(rows / 400_000))


#: Node ids of all rows and trees, in bytes, up to which a forest's ``cacheNodeIds`` says that
#: they may be kept. The parameter goes into the model; the fit here sends rows down the trees
#: again in every pass, as bytes, and keeps none. The trees are the same.
NODE_ID_BYTES = 4 << 30


def fit_table(data: DataFrame, cand: Candidate, features: Sequence[str], label: str,
              statistics: tuple[ImputeScale, dict] | None = None,
              order: Sequence[str] = ("ticker", "date")) -> PipelineModel:
    """Fit on the rows of a :func:`training_table`; ``statistics``: their
    :func:`fit_statistics`, where the caller has them."""
    prep, counts = statistics or fit_statistics(data, features, label, cand.impute, cand.scale and cand.kind == "logistic")
    rows = sum(counts.values())
    inputs = [f"{f}__in" for f in features]
    stages = [prep.stage("__in"), VectorAssembler(inputCols=inputs, outputCol="__features",
                                                  handleInvalid="keep" if cand.impute else "error")]
    if cand.kind == "logistic":  # balanced weights sum up to the rows as well
        clf = LogisticRegression(featuresCol="__features", labelCol=label, regParam=1.0 / rows,
                                 elasticNetParam=0.0, standardization=False, maxIter=cand.max_iter,
                                 tol=1e-6, probabilityCol="__prob", rawPredictionCol="__raw",
                                 predictionCol="__pred")
    else:
        clf = RandomForestClassifier(featuresCol="__features", labelCol=label, numTrees=cand.trees,
                                     maxDepth=cand.depth, featureSubsetStrategy="sqrt",
                                     minInstancesPerNode=cand.min_leaf, seed=cand.seed,
                                     cacheNodeIds=4 * rows * cand.trees <= NODE_ID_BYTES,
                                     probabilityCol="__prob", rawPredictionCol="__raw",
                                     predictionCol="__pred")
    if cand.params:  # further parameters of the learner
        clf = clf.copy({clf.getParam(k): v for k, v in cand.params.items()})
    if cand.kind == "forest":
        weights = [rows / (len(counts) * counts[c]) if c in counts else 1.0 for c in range(int(max(counts, default=0)) + 1)]
        forest = grow_forest(stages[0].transform(data), clf, inputs, label, weights if cand.balanced else None,
                             [c for c in order if c in data.columns], forest_parts(rows), strict=not cand.impute)
        return PipelineModel([*stages, forest])
    if cand.balanced:
        clf.setWeightCol("__w")
    weighted = data.withColumn("__w", balanced_weight(counts, label)) if cand.balanced else data
    return Pipeline(stages=[*stages, clf]).fit(weighted)


def predict(model: PipelineModel, df: DataFrame, prob: str = "predicted_probability",
            cls: str = "predicted_class") -> DataFrame:
    """Class-1 probability and class from a fitted pipeline (M9)."""
    out = model.transform(df)
    out = out.withColumn(prob, vector_to_array("__prob")[1]).withColumn(cls, F.col("__pred").cast("int"))
    helper = [c for c in out.columns if c.startswith("__") or c.endswith("__in")]
    return out.drop(*helper)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# ------------------------------------------------------------ selection / records


def select_best(metrics: DataFrame, order: Sequence[str], tie: str = "first",
                model: str = "model", auc: str = "validation_roc_auc") -> DataFrame:
    """Best candidate by validation AUC (M8). ``tie="first"``: earlier candidate wins a
    tie (strict ``>``); ``tie="last"``: later one wins (``>=``)."""
    rank = F.array_position(F.array(*[F.lit(n) for n in order]), F.col(model))
    tiebreak = rank.asc() if tie == "first" else rank.desc()
    return metrics.orderBy(F.col(auc).desc_nulls_last(), tiebreak).limit(1)


def run_records(spark: SparkSession, name: str, params: Mapping[str, object],
                metrics: Mapping[str, float]) -> DataFrame:
    """Long run table ``(run, kind, key, value)``."""
    rows = [(name, "param", k, str(v)) for k, v in params.items()]
    rows += [(name, "metric", k, repr(float(v)) if v is not None else None) for k, v in metrics.items()]
    return spark.createDataFrame(rows, "run string, kind string, key string, value string")


def with_run_ids(runs: DataFrame) -> DataFrame:
    """Add ``run_id``, a digest of the run's name and all its parameters."""
    told = F.when(F.col("kind") == "param", F.to_json(F.struct("key", "value")))
    ids = runs.groupBy("run").agg(F.sha2(F.concat_ws("\n", F.col("run"), F.array_sort(F.collect_list(told))).cast("binary"), 256)
                                  .alias("run_id"))
    return runs.join(ids, "run")  # a few rows for each run


def record_runs(runs: DataFrame, path: str) -> DataFrame:
    """Add runs to the run table at ``path`` (M7, M13). A run lies in a partition of its
    own, named by its name and parameters, so a run that is recorded again (after a
    restart, say) takes its own place and no other. Returns ``run``, ``run_id``,
    ``replayed`` (was it there before?) and ``same_metrics`` (with the same values?)."""
    spark, named = runs.sparkSession, shared_table(with_run_ids(runs), "runs")
    before = shared_table(read_runs(spark, path), "runs_before")
    metric = F.when(F.col("kind") == "metric", F.to_json(F.struct("key", "value")))
    found, now = (df.groupBy("run", "run_id").agg(F.array_sort(F.collect_list(metric)).alias(name))
                  for df, name in ((before, "old"), (named, "new")))
    told = shared_table(now.join(found, ["run", "run_id"], "left").select(
        "run", "run_id", F.col("old").isNotNull().alias("replayed"), (F.col("old") == F.col("new")).alias("same_metrics")), "replays")
    (named.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path))
    return told


RUNS = "run string, kind string, key string, value string, run_id string"


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The run table; without rows where nothing has been recorded yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], RUNS)
    return spark.read.schema(RUNS).parquet(path)

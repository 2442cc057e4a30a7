"""Forests as tables, audits, Newton's method."""

import random

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from panelstride.operators import forest, newton

INPUTS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(7)
    data = []
    for _ in range(900):
        a, b, c = rnd.gauss(0, 1), rnd.choice([0.0, 1.0, 2.0]), rnd.random()
        data.append((a, b, c, int(a + b * c + rnd.gauss(0, 0.7) > 0.8)))
    return spark.createDataFrame(data, "a double, b double, c double, y int").repartition(3).cache()


def fitted(rows, **params):
    rf = RandomForestClassifier(featuresCol="f", labelCol="y", seed=3, **params)
    return Pipeline(stages=[VectorAssembler(inputCols=INPUTS, outputCol="f", handleInvalid="keep"), rf]).fit(rows)


@pytest.mark.parametrize("trees", [1, 12])
def test_scores_equal_the_model(spark, rows, trees):
    model = fitted(rows, numTrees=trees, maxDepth=6)
    nodes = forest.forest_nodes(spark, model)
    depth = forest.deepest(nodes)
    assert depth == max(t.depth for t in model.stages[-1].trees)
    odd = spark.createDataFrame([(None, 1.0, float("nan"), 0), (float("inf"), float("-inf"), 0.5, 1)], rows.schema)
    every = rows.unionByName(odd)
    got = forest.forest_score(model.transform(every), nodes, INPUTS, depth)
    got = got.where("a IS NOT NULL").select(vector_to_array("probability")[1].alias("p"), "prediction", "predicted_probability", "predicted_class").collect()
    assert len(got) == 901
    assert all(r.p == r.predicted_probability and r.prediction == r.predicted_class for r in got)


def test_a_tree_without_splits(spark, rows):
    model = fitted(rows.where("y = 1"), numTrees=2, maxDepth=3)
    nodes = forest.forest_nodes(spark, model)
    assert forest.deepest(nodes) == 0 and nodes.count() == 2
    got = forest.forest_score(rows, nodes, INPUTS, 0).select("predicted_probability", "predicted_class").distinct().collect()
    assert [tuple(r) for r in got] == [(1.0, 1)]


def test_audit_confirms_a_fit_and_finds_a_wrong_node(spark, rows):
    model = fitted(rows, numTrees=1, maxDepth=4, bootstrap=False, featureSubsetStrategy="all")
    nodes = forest.forest_nodes(spark, model)
    audit = forest.audit_forest(rows, nodes, INPUTS, 4, "y").collect()
    assert len(audit) == nodes.count()
    assert all(r.counts_agree and r.impurity_agrees and r.gain_agrees in (True, None) for r in audit)
    assert [r.is_best for r in audit if r.node == 0] == [True]
    # the root's threshold moved: its children's counts and its gain no longer hold
    moved = nodes.withColumn("threshold", F.when(F.col("node") == 0, F.col("threshold") + 1).otherwise(F.col("threshold")))
    bad = {r.node: r for r in forest.audit_forest(rows, moved, INPUTS, 4, "y").collect()}
    assert not bad[0].gain_agrees and not bad[0].is_best and not bad[1].counts_agree and bad[0].counts_agree


def test_split_gains_by_brute_force(spark, rows):
    thresholds = spark.createDataFrame([(0, -0.5), (0, 0.3), (1, 0.0), (1, 1.0), (2, 0.25)], "feature int, threshold double")
    data = [tuple(r) for r in rows.collect()]

    def gini(ys):
        p = sum(ys) / len(ys) if ys else 0
        return 1 - p * p - (1 - p) ** 2 if ys else 0

    for r in forest.split_gains(rows, thresholds, INPUTS, "y").collect():
        left = [d[3] for d in data if d[r.feature] <= r.threshold]
        right = [d[3] for d in data if d[r.feature] > r.threshold]
        n = len(data)
        want = gini([d[3] for d in data]) - len(left) / n * gini(left) - len(right) / n * gini(right)
        assert r.gain == pytest.approx(want, abs=1e-12)


@pytest.mark.parametrize("weighted", [False, True])
def test_newton_agrees_with_the_library(rows, weighted):
    df = rows.withColumn("w", F.when(F.col("y") == 1, 2.5).otherwise(0.5) if weighted else F.lit(1.0))
    total = df.agg(F.sum("w")).first()[0]
    lr = LogisticRegression(featuresCol="f", labelCol="y", weightCol="w", regParam=1.0 / total, elasticNetParam=0.0,
                            standardization=False, maxIter=500, tol=1e-14)
    model = Pipeline(stages=[VectorAssembler(inputCols=INPUTS, outputCol="f"), lr]).fit(df).stages[-1]
    fit = newton.fit_newton(df, INPUTS, "y", "w")
    assert np.allclose([*fit.weights, fit.intercept], [*model.coefficients.toArray(), model.intercept], rtol=0, atol=1e-6)
    assert max(map(abs, fit.gradient)) < 1e-7 and fit.iterations < 15


def test_newton_on_odd_rows(spark):
    schema = "a double, y int"
    one_class = spark.createDataFrame([(float(k), 1) for k in range(5)], schema)
    assert newton.fit_newton(one_class, ["a"], "y").intercept > 0
    some = spark.createDataFrame([(None, 1), (1.0, 1), (-1.0, 0), (1.0, None)], schema)
    fit = newton.fit_newton(some, ["a"], "y")
    assert fit.weights[0] > 0 and abs(fit.intercept) < 1e-9
    assert newton.fit_newton(some.where("a > 9"), ["a"], "y").weights == (0.0,)

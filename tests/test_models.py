"""Split, weights, fits and scores on a small separable table."""

import pytest
from pyspark.sql import functions as F

from deliverylens.plans import models
from deliverylens.plans.features import FEATURES


@pytest.fixture(scope="module")
def table(spark):
    late = (F.col("id") % 3 == 0).cast("int")
    noise = (F.xxhash64("id") % 7).cast("double")
    columns = [((F.lit(5.0) * late if i < 2 else F.lit(0.0)) + noise * (i + 1)).alias(f) for i, f in enumerate(FEATURES)]
    return spark.range(300).select(F.col("id").alias("release_id"), late.alias("is_delayed"), *columns)


def test_split_keeps_the_share_of_every_class(table):
    split = models.stratified_split(table, "release_id", "is_delayed")
    rows = {r.is_delayed: (r.n, r.k) for r in split.groupBy("is_delayed").agg(F.count("*").alias("n"), F.count_if("is_train").alias("k")).collect()}
    assert rows == {0: (200, 150), 1: (100, 75)}
    again = models.stratified_split(table.repartition(7), "release_id", "is_delayed")
    assert split.select("release_id", "is_train").exceptAll(again.select("release_id", "is_train")).count() == 0


def test_balanced_weights(table):
    rows = {r.is_delayed: r.w for r in models.balanced_weights(table, "is_delayed").groupBy("is_delayed").agg(F.max("weight").alias("w")).collect()}
    assert rows == {0: 300 / (2 * 200), 1: 300 / (2 * 100)}
    one = models.balanced_weights(table.filter("is_delayed = 1"), "is_delayed").first()
    assert one.weight == 1.0


def test_two_models_and_their_explanations(table):
    fitted = models.train_delay_models(table, ("Logistic Regression", "Random Forest"))
    rows = fitted.comparison().collect()
    assert [r.f1_score for r in rows] == sorted((r.f1_score for r in rows), reverse=True)
    assert all(0 <= r[c] <= 1 for r in rows for c in ("accuracy", "precision", "recall", "f1_score", "roc_auc"))
    assert fitted.best == rows[0].model
    for name in ("Logistic Regression", "Random Forest"):
        weights = fitted.importance(name).collect()
        assert {r.feature for r in weights} == set(FEATURES)
        assert all(r.importance >= 0 for r in weights)


def test_one_class_has_no_auc(spark):
    df = spark.createDataFrame([(1.0, 1.0, 0.9), (1.0, 0.0, 0.4)], "is_delayed double, prediction double, score double")
    scores = models.held_out_scores(df).first()
    assert scores.roc_auc is None and scores.recall == 0.5 and scores.precision == 1.0
    nothing = spark.createDataFrame([(0.0, 0.0, 0.1)], "is_delayed double, prediction double, score double")
    assert models.held_out_scores(nothing).first().f1_score == 0.0
    assert models.held_out_scores(df.limit(0)).first().accuracy == 0.0


def test_area_counts_ties_by_half(spark):
    rows = [(float(k % 3 == 0), float(k % 2), round((k * 37 % 11) / 11, 6)) for k in range(200)]
    df = spark.createDataFrame(rows, "is_delayed double, prediction double, score double")
    positive, negative = [s for y, _, s in rows if y], [s for y, _, s in rows if not y]
    wins = sum((p > n) + (p == n) / 2 for p in positive for n in negative)
    assert models.held_out_scores(df).first().roc_auc == round(wins / len(positive) / len(negative), 3)

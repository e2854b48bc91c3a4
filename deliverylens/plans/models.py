"""Release-delay classifiers: split, fit, compare, explain."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from deliverylens.functions.scalars import as_double, count_rows
from deliverylens.operators.ranking import hash_positions
from deliverylens.plans.features import FEATURES
from deliverylens.session import materialized

LABEL = "is_delayed"
MODELS = ("Logistic Regression", "Random Forest", "Gradient Boosting")


def stratified_split(df: DataFrame, key: str, label: str, train_share: float = 0.75, seed: int = 42) -> DataFrame:
    """Add ``is_train``: the same share of every class, by hash order."""
    placed = hash_positions(df, key, [label], seed)
    return placed.withColumn(
        "is_train", F.col("position") <= F.round(F.col("group_rows") * F.lit(train_share)).cast("bigint")
    ).drop("position", "group_rows")


def balanced_weights(train: DataFrame, label: str) -> DataFrame:
    """Add ``weight`` = rows / (classes * rows of the class)."""
    sizes = train.select(
        F.struct(count_rows().alias("n"), F.count_if(F.col(label) == 1).alias("ones"))
    ).scalar()
    n, ones = as_double(sizes["n"]), as_double(sizes["ones"])
    own = F.when(F.col(label) == 1, ones).otherwise(n - ones)
    classes = F.when((ones > 0) & (ones < n), F.lit(2.0)).otherwise(F.lit(1.0))
    return train.withColumn("weight", n / (classes * own))


def _estimator(name: str, train_rows: int, seed: int):
    common = {"featuresCol": "features", "labelCol": LABEL}
    if name == "Logistic Regression":
        # an L2 strength of 1 / rows equals a unit penalty on the summed loss
        return LogisticRegression(
            **{**common, "featuresCol": "scaled"},
            maxIter=1000,
            regParam=1.0 / train_rows,
            standardization=False,
            weightCol="weight",
        )
    if name == "Random Forest":
        return RandomForestClassifier(**common, numTrees=200, maxDepth=5, seed=seed, weightCol="weight")
    return GBTClassifier(**common, maxIter=150, maxDepth=3, stepSize=0.1, seed=seed)


def _without_summary(model, spark: SparkSession):
    """A fitted model without the record of its training. The record holds on to the session,
    which cannot be sent to tasks any more once a job has been observed."""
    if getattr(model, "hasSummary", False):
        model._java_obj.setSummary(spark._jvm.scala.Option.empty())
    return model


@dataclass
class DelayModels:
    """Fitted models with their held-out scores."""

    spark: SparkSession
    fitted: dict[str, object]
    scores: list[dict]

    @property
    def best(self) -> str:
        return min(self.scores, key=lambda s: (-s["f1_score"], s["model"]))["model"]

    def comparison(self) -> DataFrame:
        columns = ("model", "accuracy", "precision", "recall", "f1_score", "roc_auc")
        return _small_frame(self.spark, self.scores, columns).orderBy(F.desc("f1_score"), "model")

    def importance(self, name: str | None = None) -> DataFrame:
        """Tree importances, or absolute coefficients of the linear model."""
        model = self.fitted[name or self.best]
        weights = (
            model.featureImportances.toArray()
            if hasattr(model, "featureImportances")
            else [abs(c) for c in model.coefficients]
        )
        rows = [{"feature": f, "importance": float(w)} for f, w in zip(FEATURES, weights)]
        return _small_frame(self.spark, rows, ("feature", "importance")).orderBy(F.desc("importance"), "feature")


def _small_frame(spark: SparkSession, rows: list[dict], columns) -> DataFrame:
    structs = [
        F.struct(
            *[
                (F.lit(row[c]) if isinstance(row[c], str) else F.lit(row[c]).cast("double")).alias(c)
                for c in columns
            ]
        )
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


AUC_STEPS = 4096


def held_out_scores(predictions: DataFrame) -> DataFrame:
    """One row: accuracy, precision, recall, f1_score and exact roc_auc of predictions
    (label, ``prediction`` 0 or 1, ``score`` between 0 and 1), to three places.

    Ratios over nothing are 0; roc_auc is NULL when one class is missing. It is the share
    of (positive, negative) pairs with the higher score on the positive, ties counting
    half. Rows are counted per score; totals below a score come from at most 4,097 steps
    and, within a step, from its own scores, so no task orders all of them.
    """
    guess, truth = F.col("prediction") == 1, F.col(LABEL) == 1
    per_score = predictions.groupBy("score").agg(
        *[
            F.count_if(c).cast("double").alias(n)
            for n, c in (("tp", guess & truth), ("fp", guess & ~truth), ("fn", ~guess & truth), ("tn", ~guess & ~truth))
        ]
    )
    placed = per_score.withColumns(
        {"_step": F.floor(F.col("score") * AUC_STEPS), "_pos": F.col("tp") + F.col("fn"), "_neg": F.col("fp") + F.col("tn")}
    )
    before = Window.orderBy("_step").rowsBetween(Window.unboundedPreceding, -1)
    steps = placed.groupBy("_step").agg(F.sum("_neg").alias("_in_step")).select(
        "_step", F.coalesce(F.sum("_in_step").over(before), F.lit(0.0)).alias("_below")
    )
    within = Window.partitionBy("_step").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    wins = F.col("_pos") * (F.col("_below") + F.coalesce(F.sum("_neg").over(within), F.lit(0.0)) + F.col("_neg") / 2)
    total = (
        placed.join(steps, "_step")
        .withColumn("_wins", wins)
        .agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in ("tp", "fp", "fn", "tn", "_pos", "_neg", "_wins")])
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def ratio(a, b):
        return F.round(F.coalesce(a / F.nullif(b, F.lit(0.0)), F.lit(0.0)), 3)

    return total.select(
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        F.round(F.col("_wins") / F.nullif(F.col("_pos") * F.col("_neg"), F.lit(0.0)), 3).alias("roc_auc"),
    )


def train_delay_models(features: DataFrame, models=MODELS, seed: int = 42) -> DelayModels:
    """Fit the classifiers on 75 % of each class and score them on the rest.

    The split feature table is written once, so the many passes of the
    iterative learners never recompute the feature joins.
    """
    spark = features.sparkSession
    filled = features.select("release_id", F.col(LABEL).cast("double").alias(LABEL), *FEATURES).fillna(
        0, list(FEATURES)
    )
    kept = materialized(filled, "delay_features")
    table = materialized(stratified_split(kept, "release_id", LABEL, seed=seed), "delay_split")
    train = balanced_weights(table.filter("is_train"), LABEL)
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    assembled = assembler.transform(train)
    prepare = PipelineModel([assembler, scaler.fit(assembled)])
    train, test = prepare.transform(train), prepare.transform(table.filter("NOT is_train"))
    rows = train.count()

    fitted, scores = {}, []
    for name in models:
        model = _without_summary(_estimator(name, rows, seed).fit(train), spark)
        scored = model.transform(test).withColumn("score", vector_to_array("probability")[1])
        fitted[name] = model
        scores.append({"model": name, **held_out_scores(scored.select(LABEL, "prediction", "score")).first().asDict()})
    return DelayModels(spark, fitted, scores)

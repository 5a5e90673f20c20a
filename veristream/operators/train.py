"""Training and scoring of the TF-IDF classifier."""

from __future__ import annotations

import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from veristream import fixed_values as fv
from veristream.functions import grams, labels, scoring, text as tx
from veristream.operators import features
from veristream.session import scratch_path, spread
from veristream.sources import files


def prepare(df: DataFrame, text: str = "text", label: str = "final_label") -> DataFrame:
    """(text_clean, label_num) for training."""
    return df.filter(F.col(text).isNotNull()).select(
        tx.clean_train(F.col(text)).alias("text_clean"),
        labels.to_code(F.col(label)).alias("label_num"),
    )


def class_weights(df: DataFrame, label: str = "label_num") -> DataFrame:
    """(label, n, weight) with weight = rows / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    sums = counts.agg(F.sum("n").alias("rows"), F.count("*").alias("classes"))
    # One sub-result used twice would be read twice: carry both in one struct.
    both = sums.select(F.struct("rows", "classes").alias("s")).scalar()
    return counts.select(
        label, "n", (both["rows"] / (both["classes"] * F.col("n"))).alias("weight")
    )


def fit(
    df: DataFrame, n_max: int = fv.CLASSIFIER_FEATURES, max_iter: int = 1000, tol: float = 1e-4,
    partitions: int | None = None,
) -> PipelineModel:
    """Vectoriser and multinomial logistic regression from (text_clean, label_num).

    The penalty is ½|w|² against the summed weighted loss.  Balanced weights
    sum to the number of rows, and Spark minimises the mean loss, hence 1/n.
    ``partitions`` deals the rows anew first, for inputs of a few small files.
    """
    # Vectoriser and solver pass over the rows many times.  They are the caller's: balance or sample
    # them first where there are more than a model needs.
    df = spread(df.select("text_clean", "label_num"), partitions).persist()
    try:
        vectorizer = features.fit_vectorizer(df, n_max=n_max)
        weights = F.broadcast(class_weights(df).select("label_num", "weight"))  # a row per class
        rows = features.vectors(df, vectorizer).join(weights, "label_num")
        rows = rows.select("features", F.col("label_num").cast("double").alias("label"), "weight")
        n = df.count()
        rows = rows.persist()
        lr = LogisticRegression(
            family="multinomial",
            maxIter=max_iter,
            tol=tol,
            regParam=1.0 / max(n, 1),
            elasticNetParam=0.0,
            standardization=False,
            weightCol="weight",
        )
        model = lr.fit(rows)
        rows.unpersist()
    finally:
        df.unpersist()
    # A freshly fitted model holds on to its training table and session, and its scoring
    # functions would take both to the tasks; a stored one holds the coefficients only.
    path = scratch_path(df.sparkSession, "classifier")
    model.write().save(path)
    return PipelineModel(stages=[*vectorizer.stages, LogisticRegressionModel.load(path)])


def predict(df: DataFrame, model: PipelineModel, clean: str = "text_clean") -> DataFrame:
    """Adds ``prediction`` (class code) to rows with a cleaned text."""
    helpers = ["features", "rawPrediction", "probability"]
    return (
        model.transform(df.withColumn("text_clean", F.col(clean)))
        .drop(*helpers)
        .withColumn("prediction", F.col("prediction").cast("int"))
    )


def _scorer(model: PipelineModel) -> grams.Scorer | None:
    """What ``fit`` learnt, for the tasks; None if the stages are others than its."""
    of = lambda kind: [stage for stage in model.stages if isinstance(stage, kind)]
    found = [of(kind) for kind in (CountVectorizerModel, ElementwiseProduct, LogisticRegressionModel)]
    if any(len(f) != 1 for f in found) or len(model.stages) != 6:
        return None
    (words,), (scale,), (lr,) = found
    return grams.Scorer(words.vocabulary, scale.getScalingVec().toArray(), lr.coefficientMatrix.toArray(), lr.interceptVector.toArray())


def probabilities(df: DataFrame, model: PipelineModel, out: str = "_p") -> DataFrame:
    """Adds the class probabilities of ``text_clean`` by ``fit``'s model, words and pairs found as numbers on Arrow batches.

    The same as the pipeline's own ``transform`` gives, which makes an array of all words and pairs
    of every text; models of other stages go through that.
    """
    scorer = _scorer(model)
    if scorer is None:
        helpers = ["features", "rawPrediction", "probability", "prediction"]
        return model.transform(df).withColumn(out, vector_to_array("probability")).drop(*helpers)

    def probable(texts: pa.Array) -> pa.Array:
        return scorer.probabilities(texts)

    # Annotations are names only here; Spark looks at them.
    probable.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return df.withColumn(out, F.arrow_udf(probable, "array<double>")("text_clean"))


def score(df: DataFrame, model: PipelineModel | None, text: str = "text", out: str = "base") -> DataFrame:
    """Adds the class probabilities in percent; zeros without a model."""
    if model is None:
        return df.withColumn(out, scoring.zero_scores())
    scored = probabilities(df.withColumn("text_clean", tx.clean_serve(F.col(text))), model)
    parts = [
        F.round(F.coalesce(F.get("_p", F.lit(i)), F.lit(0.0)) * 100, 2)
        for i in range(len(fv.LABELS))
    ]
    return scored.withColumn(out, scoring.scores(*parts)).drop("text_clean", "_p")


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(spark: SparkSession, path: str) -> PipelineModel | None:
    """The saved model, or None where there is none."""
    return PipelineModel.load(path) if files.exists(spark, f"{path}/metadata") else None

"""Text to verdict: the main job, for batch tables and streams alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from veristream import fixed_values as fv
from veristream.functions import scoring, text as tx
from veristream.operators import train


def verdict(
    df: DataFrame,
    text: str = "text",
    model: PipelineModel | None = None,
    deep: DataFrame | None = None,
    key: str = "doc_id",
    hoax_words: Sequence[str] = fv.HOAX_WORDS,
    formal_words: Sequence[str] = fv.FORMAL_WORDS,
) -> DataFrame:
    """Adds the verdict columns to rows with a text.

    ``base`` scores come from a column of that name, else from ``model``, else
    are 0.  ``deep`` scores of an outside model come from a column, else from a
    table (key, deep), else are 0.
    """
    if "base" not in df.columns:
        df = train.score(df, model, text)
    if deep is not None:
        df = df.join(deep.select(key, "deep"), key, "left")
    elif "deep" not in df.columns:
        df = df.withColumn("deep", scoring.zero_scores())
    fused = scoring.fuse(df, text, "base", "deep", hoax_words, formal_words)
    return (
        fused.withColumns(
            {
                "recommendation": scoring.recommendation(F.col("label")),
                "scam_entities": tx.scam_entities(F.col(text)),
            }
        )
        .withColumnRenamed("deep", "indobert_scores")
        .withColumnRenamed("base", "baseline_scores")
    )


VERDICT_COLUMNS = [
    "label", "score", "all_scores", "indobert_scores", "baseline_scores", "recommendation",
    "scam_entities",
]

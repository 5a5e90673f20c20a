"""Message enrichment: pick the text, clean it, attach a verdict, wrap it up.

All steps are projections and filters, so the same code serves batch tables
and streams and never shuffles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from veristream import schemas
from veristream.functions import text as tx
from veristream.functions.planning import compute_once

Scorer = Callable[[DataFrame], DataFrame]


def select_text(df: DataFrame, value: str = "value") -> DataFrame:
    """Adds ``text`` and ``problem`` from a JSON message.

    ``message``, ``description``, ``title`` in this order, and ``text`` above
    all.  A field counts when its key is there, even if empty.  ``problem`` is
    'not json', 'no text' (chosen value is not a string) or null.
    """
    staged = compute_once(df, "_v", F.try_parse_json(value))

    def field(name: str) -> Column:
        return F.try_variant_get("_v", f"$.{name}", "variant")

    # A key with a null value is still a variant; only a missing key is null.
    staged = staged.withColumn(
        "_chosen",
        F.coalesce(field("text"), field("message"), field("description"), field("title")),
    )
    is_object = F.startswith(F.schema_of_variant("_v"), F.lit("OBJECT"))
    is_string = F.schema_of_variant("_chosen") == "STRING"
    chosen = F.try_variant_get("_chosen", "$", "string")
    return (
        staged.withColumn(
            "text",
            F.when(F.col("_chosen").isNull() & F.coalesce(is_object, F.lit(False)), F.lit(""))
            .when(is_string, chosen),
        )
        .withColumn(
            "problem",
            F.when(~F.coalesce(is_object, F.lit(False)), F.lit("not json"))
            .when(F.col("_chosen").isNotNull() & ~F.coalesce(is_string, F.lit(False)), F.lit("no text")),
        )
        .drop("_v", "_chosen")
    )


def clean_messages(df: DataFrame, value: str = "value") -> DataFrame:
    """``select_text`` plus cleaning of the chosen text."""
    return compute_once(select_text(df, value), "text", tx.strip_tags(F.col("text")))


def non_blank(df: DataFrame, column: str = "text") -> DataFrame:
    """Drop rows whose text is blank (or null)."""
    return df.filter(F.length(tx.strip(F.col(column))) > 0)


def dead_letters(df: DataFrame, value: str = "value") -> DataFrame:
    """Messages that give no text to analyse, with the reason.

    ``df`` is the output of ``clean_messages``.
    """
    reason = F.coalesce("problem", F.when(tx.strip(F.col("text")) == "", F.lit("blank text")))
    return df.withColumn("reason", reason).filter(F.col("reason").isNotNull()).select(
        *[c for c in ("topic",) if c in df.columns], value, "reason"
    )


def usable(df: DataFrame) -> DataFrame:
    """Messages with a text to analyse; the counterpart of ``dead_letters``."""
    return non_blank(df.filter(F.col("problem").isNull())).drop("problem")


def with_verdict(messages: DataFrame, scorer: Scorer | DataFrame, key: str = "id") -> DataFrame:
    """Attach a verdict: by a function of the rows, or from a verdict table."""
    if callable(scorer):
        return scorer(messages)
    return messages.join(scorer, key, "left")


_DEFAULTS = {
    "score": ("double", 0.0),
    "label": ("string", "Valid"),
    "reason": ("string", ""),
    "category": ("string", ""),
    "sentiment": ("string", ""),
    "is_sensational": ("boolean", False),
    "ai_generated_flag": ("boolean", False),
    "processing_time_ms": ("int", 0),
    "recommendation": ("string", ""),
}


def envelope(df: DataFrame, original: str = "value", topic: str = "topic", keep=()) -> DataFrame:
    """Original message, its topic and the analysis; missing fields get defaults."""
    fields = []
    for name, (kind, default) in _DEFAULTS.items():
        given = F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)
        fields.append(F.coalesce(given, F.lit(default).cast(kind)).alias(name))
    return df.select(
        *keep,
        F.col(original).alias("original_data"),
        F.col(topic).alias("source_topic"),
        F.struct(*fields).alias("analysis"),
    )


def envelope_json(df: DataFrame) -> DataFrame:
    """Envelopes as JSON ``value`` rows, the original embedded as an object."""
    return df.select(
        F.to_json(
            F.struct(
                F.try_parse_json("original_data").alias("original_data"),
                "source_topic",
                "analysis",
            )
        ).alias("value")
    )


def parse_envelope(df: DataFrame, value: str = "value", keep=()) -> DataFrame:
    """JSON envelopes back to ``ENVELOPE`` rows (original kept as JSON text)."""
    return df.select(*keep, F.from_json(value, schemas.ENVELOPE).alias("_e")).select(*keep, "_e.*")

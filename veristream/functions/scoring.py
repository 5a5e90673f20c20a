"""Scores of the four classes and the rules that combine them.

A score set is one struct column with a double per class.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from veristream import fixed_values as fv
from veristream.functions import text as tx


def scores(valid, hoaks, penipuan, netral) -> Column:
    """A score struct from four numbers or columns."""
    parts = zip(fv.LABELS, (valid, hoaks, penipuan, netral))
    return F.struct(
        *[(v if isinstance(v, Column) else F.lit(v)).cast("double").alias(k) for k, v in parts]
    )


def zero_scores() -> Column:
    return scores(0.0, 0.0, 0.0, 0.0)


def or_zero(c: Column) -> Column:
    """Missing score set, or missing class in it, counts as 0."""
    return scores(*[F.coalesce(c[k], F.lit(0.0)) for k in fv.LABELS])


def pct(part: Column, whole: Column) -> Column:
    """Share in percent, 2 digits, 0 when the whole is 0."""
    return F.round(part / F.greatest(whole, F.lit(1)) * 100, 2)


def clamp(c: Column, top: float = fv.SCORE_MAX) -> Column:
    return F.least(c, F.lit(top))


def argmax(s: Column) -> Column:
    """Class with the highest score; ties go to the earlier class."""
    best = F.greatest(*[s[k] for k in fv.LABELS])
    chain = None
    for name in fv.LABELS[:-1]:
        chain = (F if chain is None else chain).when(s[name] == best, F.lit(name))
    return chain.otherwise(F.lit(fv.LABELS[-1]))


def boost(base: Column, hoax: Column, formal: Column) -> Column:
    """Hoax word: Hoaks up; otherwise formal word: Valid up."""
    valid = F.when(~hoax & formal, base["Valid"] + fv.FORMAL_BOOST).otherwise(base["Valid"])
    hoaks = F.when(hoax, base["Hoaks"] + fv.HOAX_BOOST).otherwise(base["Hoaks"])
    return scores(valid, hoaks, base["Penipuan"], base["Netral"])


def fuse(
    df: DataFrame,
    text: str = "text",
    base: str = "base",
    deep: str = "deep",
    hoax_words: Sequence[str] = fv.HOAX_WORDS,
    formal_words: Sequence[str] = fv.FORMAL_WORDS,
    scam_above: float = fv.SCAM_OVERRIDE_ABOVE,
    keyword_above: float = fv.HOAX_KEYWORD_ABOVE,
    alone_above: float = fv.HOAX_ALONE_ABOVE,
) -> DataFrame:
    """Combine two score sets and the keyword rules into label and scores.

    Adds ``label``, ``score``, ``all_scores``; replaces ``base`` by its boosted
    form.  The rules are tried in order and compare strictly:

    1. outside model sure of a scam;
    2. hoax word, and boosted base agrees;
    3. boosted base alone sure of a hoax;
    4. otherwise the higher of both, per class.
    """
    staged = df.withColumns(
        {
            "_hoax": F.coalesce(tx.has_any(F.col(text), hoax_words), F.lit(False)),
            "_formal": F.coalesce(tx.has_any(F.col(text), formal_words), F.lit(False)),
        }
    )
    b0 = or_zero(F.col(base))
    staged = staged.withColumns(
        {base: boost(b0, F.col("_hoax"), F.col("_formal")), deep: or_zero(F.col(deep))}
    )
    b, d = F.col(base), F.col(deep)
    staged = staged.withColumn(
        "_rule",
        F.when(d["Penipuan"] > scam_above, 1)
        .when(F.col("_hoax") & (b["Hoaks"] > keyword_above), 2)
        .when(b["Hoaks"] > alone_above, 3)
        .otherwise(4),
    )
    rule = F.col("_rule")

    def final(first, second, third, name):
        value = (
            F.when(rule == 1, first)
            .when(rule == 2, second)
            .when(rule == 3, third)
            .otherwise(F.greatest(d[name], b[name]))
        )
        return F.round(value, 2)

    staged = staged.withColumn(
        "_raw",
        scores(
            final(d["Valid"], b["Valid"] * 0.2, b["Valid"], "Valid"),
            final(b["Hoaks"] * 0.3, b["Hoaks"], b["Hoaks"], "Hoaks"),
            final(d["Penipuan"], b["Penipuan"] * 0.3, d["Penipuan"] * 0.3, "Penipuan"),
            final(b["Netral"] * 0.2, b["Netral"] * 0.2, b["Netral"] * 0.2, "Netral"),
        ),
    )
    raw = F.col("_raw")
    # The winner is chosen before rounding.
    unrounded = scores(*[F.greatest(d[k], b[k]) for k in fv.LABELS])
    label = (
        F.when(rule == 1, F.lit("Penipuan"))
        .when(rule.isin(2, 3), F.lit("Hoaks"))
        .otherwise(argmax(unrounded))
    )
    staged = staged.withColumns(
        {"all_scores": scores(*[clamp(raw[k]) for k in fv.LABELS]), "label": label}
    )
    return staged.withColumn("score", score_of(F.col("all_scores"), F.col("label"))).drop(
        "_hoax", "_formal", "_rule", "_raw"
    )


def score_of(s: Column, label: Column, missing: float | None = None) -> Column:
    """Score of the named class; ``missing`` for names outside the classes."""
    out = F.lit(missing).cast("double")
    for name in reversed(fv.LABELS):
        out = F.when(label == name, s[name]).otherwise(out)
    return out


def recommendation(label: Column) -> Column:
    """Advice per class, '' for an unknown class."""
    out = None
    for name, advice in fv.RECOMMENDATIONS.items():
        out = (F if out is None else out).when(label == name, F.lit(advice))
    return out.otherwise(F.lit(""))


def indicator_rule(
    c: Column,
    words: Sequence[str] = fv.SCAM_INDICATOR_WORDS,
    at_least: int = fv.INDICATOR_HITS,
) -> Column:
    """Struct of indicators, classification, confidence and advice."""
    found = tx.hits(c, words)
    is_scam = F.size(found) >= at_least

    def pick(scam, review):
        return F.when(is_scam, F.lit(scam)).otherwise(F.lit(review))

    return F.struct(
        found.alias("indicators"),
        pick(fv.INDICATOR_SCAM[0], fv.INDICATOR_REVIEW[0]).alias("classification"),
        pick(fv.INDICATOR_SCAM[1], fv.INDICATOR_REVIEW[1]).alias("confidence"),
        pick(fv.INDICATOR_ADVICE["Scam"], fv.INDICATOR_ADVICE["Review"]).alias(
            "recommendation"
        ),
    )


def merge_phone(ocr_phone: Column, extracted: Column) -> Column:
    """Phone read from the picture if given, else the first one in the text."""
    return F.coalesce(tx.non_empty(ocr_phone), F.get(extracted, F.lit(0)))


def merge_ocr(df: DataFrame) -> DataFrame:
    """Verdict of a screenshot: ``df`` is ``verdict`` output with OCR columns.

    Needs ``kategori``, ``alasan``, ``entitas_penipu``, ``label``,
    ``all_scores`` and ``scam_entities``.  Only the picture reader's scam call
    overrides the text verdict; failed readings are dropped.
    """
    ocr_label = tx.capitalize(F.coalesce(F.col("kategori"), F.lit("VALID")))
    final = F.when(ocr_label == "Penipuan", ocr_label).otherwise(F.col("label"))
    return (
        df.filter(~F.startswith(F.col("text"), F.lit(fv.OCR_FAILURE_PREFIX)))
        .withColumns({"ocr_label": ocr_label, "hybrid_label": F.col("label"), "_final": final})
        .select(
            *[c for c in ("filename", "doc_id") if c in df.columns],
            F.col("text").alias("extracted_text"),
            F.col("_final").alias("label"),
            "ocr_label",
            "hybrid_label",
            score_of(F.col("all_scores"), F.col("_final"), fv.MISSING_SCORE).alias("score"),
            "all_scores",
            recommendation(F.col("_final")).alias("recommendation"),
            F.struct(
                merge_phone(
                    F.col("entitas_penipu.nomor_hp"), F.col("scam_entities.nomor_hp")
                ).alias("nomor_hp"),
                F.col("entitas_penipu.rekening").alias("rekening"),
            ).alias("scam_entities"),
            F.coalesce(F.col("alasan"), F.lit("")).alias("ocr_reason"),
        )
    )


def _emoji(label: Column) -> Column:
    out = None
    for name, sign in fv.LABEL_EMOJI.items():
        out = (F if out is None else out).when(label == name, F.lit(sign))
    return out.otherwise(F.lit(fv.UNKNOWN_EMOJI))


def render(df: DataFrame, out: str = "rendered") -> DataFrame:
    """Adds the text message for a verdict (no markup)."""
    label = F.coalesce(F.col("label"), F.lit(fv.UNKNOWN_LABEL))
    entity_lines = [
        F.when(
            F.size(F.coalesce(F.col(f"scam_entities.{name}"), F.array().cast("array<string>"))) > 0,
            F.concat(
                F.lit(f"  {title}: "), F.array_join(F.col(f"scam_entities.{name}"), ", ")
            ),
        )
        for title, name in fv.RENDER_ENTITIES
    ]
    any_entity = F.coalesce(*entity_lines).isNotNull()
    score_text = F.coalesce(F.col("score").cast("string"), F.lit("0"))
    message = F.concat_ws(
        "\n",
        F.concat(_emoji(label), F.lit(fv.RENDER_TITLE), F.upper(label)),
        F.concat(F.lit(fv.RENDER_SCORE), score_text, F.lit("%")),
        F.lit(""),
        F.lit(fv.RENDER_CLASSES),
        *[
            F.concat(
                F.lit(f"  - {name}: "), F.col(f"all_scores.{name}").cast("string"), F.lit("%")
            )
            for name in fv.LABELS
        ],
        F.when(any_entity, F.lit(fv.RENDER_FOUND)),
        *entity_lines,
        F.lit(""),
        F.concat(F.lit(fv.RENDER_REASON), F.coalesce(F.col("recommendation"), F.lit(""))),
    )
    return df.withColumn(out, message)


def render_screenshot(df: DataFrame, out: str = "rendered") -> DataFrame:
    """Adds the text message for a screenshot verdict, with the beginning of the text that was read."""
    label = F.coalesce(F.col("label"), F.lit(fv.UNKNOWN_LABEL))
    read = tx.strip(F.coalesce(F.col("extracted_text"), F.lit("")))
    preview = tx.ellipsis(read, fv.RENDER_PREVIEW_CHARS, fv.RENDER_PREVIEW_CHARS)
    message = F.concat_ws(
        "\n",
        F.concat(_emoji(label), F.lit(fv.RENDER_SCREENSHOT_TITLE), F.upper(label)),
        F.concat(F.lit(fv.RENDER_SCORE), F.col("score").cast("string"), F.lit("%")),
        F.lit(""),
        F.when(
            read != "",
            F.concat(F.lit(fv.RENDER_READ), F.lit('"'), preview, F.lit('"\n')),
        ),
        F.when(
            F.coalesce(F.col("ocr_reason"), F.lit("")) != "",
            F.concat(F.lit(fv.RENDER_OCR_REASON), F.col("ocr_reason"), F.lit("\n")),
        ),
        F.concat(F.lit(fv.RENDER_ADVICE), F.col("recommendation")),
    )
    return df.withColumn(out, message)

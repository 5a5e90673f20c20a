"""Raw documents to encoded training data: five stages, each a written table to the next.

Every stage works on all that its predecessor kept.  Toxic documents go; boilerplate lines go
but for their first place; of near copies one stays; sources are mixed to their weights,
documents repeated as the mix asks; what is left is encoded and decoded.

Nulls, empty texts, ties, repeated rows and very long texts are what each stage's module says; a
null or empty text is not toxic, has no lines, is near no other and takes nothing of the mix.
Rows that share a doc_id with unlike texts are documents of their own.  Columns besides those of
``documents`` are carried along; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veristream.llm import bpe, jaccard_join, line_dedup, mixing, toxicity
from veristream.llm.common import materialize
from veristream.llm.queries import bpe_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep(docs, toxicity.fit(docs, labels))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.keep(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.apply_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs, bpe_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: SQL can express neither the learnt lexicon nor the vocabulary.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

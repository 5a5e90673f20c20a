"""TF-IDF over unigrams and bigrams: as a long table, and as an ML pipeline.

Both use tokens of at least two characters, raw counts,
``idf = ln((1 + n) / (1 + df)) + 1``, unit length rows, and the terms with the
highest total counts as vocabulary.
"""

from __future__ import annotations

from functools import partial

import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    CountVectorizerModel, ElementwiseProduct, Normalizer, SQLTransformer,
)
from pyspark.ml.linalg import DenseVector, VectorUDT
from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from veristream import fixed_values as fv
from veristream.functions import grams
from veristream.functions.planning import compute_once, explode_rows



def tokens(clean: Column) -> Column:
    return F.filter(F.split(clean, " "), lambda t: F.length(t) > 1)


def _pairs(t: Column) -> Column:
    ahead = F.slice(t, F.lit(2), F.greatest(F.size(t) - 1, F.lit(0)))
    both = F.zip_with(
        F.slice(t, F.lit(1), F.greatest(F.size(t) - 1, F.lit(0))),
        ahead,
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
    return both


def terms(df: DataFrame, clean: str, out: str = "terms") -> DataFrame:
    """Adds the array of unigrams and bigrams of a cleaned text."""
    words = compute_once(df, "_t", tokens(F.col(clean)))
    return words.withColumn(out, F.concat("_t", _pairs(F.col("_t")))).drop("_t")


def term_stats(docs: DataFrame, clean: str, copies: str | None = None, **which) -> DataFrame:
    """(term, total, df) of cleaned texts' terms: all occurrences, and documents that hold the term.

    One pass and one shuffle keyed by term.  Occurrences never become rows: every task counts
    words and pairs as numbers, on Arrow batches, and gives the sums of a few megabytes of text
    at a time.  ``copies`` names a column telling how many equal documents a row stands for;
    ``which`` terms are counted, ``grams.partial_stats`` knows.
    """
    weight = F.lit(1) if copies is None else F.coalesce(F.col(copies), F.lit(0))
    rows = docs.select(weight.cast("bigint").alias("_w"), F.col(clean).cast("string").alias("_clean"))
    counts = rows.mapInArrow(partial(grams.partial_stats, **which), "term string, total bigint, df bigint")
    return counts.groupBy("term").agg(F.sum("total").alias("total"), F.sum("df").alias("df"))


def vocabulary(stats: DataFrame, n: int = fv.CLASSIFIER_FEATURES) -> DataFrame:
    """The ``n`` terms with the highest totals; ties in term order."""
    return stats.orderBy(F.col("total").desc(), "term").limit(n)


def top_terms(docs: DataFrame, clean: str, n: int) -> list[Row]:
    """The rows of ``vocabulary(term_stats(...), n)``, counting only pairs that can be among them.

    A pair is no commoner than either of its words, and comes after the first where it is as common.  So
    the first word of a pair that is wanted is one of the ``n`` first words, and the second is at least as
    common as the last of these.  Where too many are just as common, any second word will do.
    ``docs`` is read twice; at most ``3 * n`` rows come to the driver.
    """
    words = vocabulary(term_stats(docs, clean, pairs=False), 2 * n).collect()
    least = words[n - 1]["total"] if 0 < n <= len(words) else 0
    common = [r["term"] for r in words if r["total"] >= least]
    firsts, seconds = common[:n], common if len(common) < 2 * n else None
    pairs = vocabulary(term_stats(docs, clean, words=False, firsts=firsts, seconds=seconds), n).collect()
    return sorted(words + pairs, key=lambda r: (-r["total"], r["term"]))[:n]


def idf(stats: DataFrame, n_docs: Column) -> DataFrame:
    """Adds ``idf``; ``n_docs`` is the number of documents."""
    return stats.withColumn("idf", F.log((n_docs + 1) / (F.col("df") + 1)) + 1)


def count_docs(docs: DataFrame, copies: str | None = None) -> Column:
    """Number of documents as a scalar subquery."""
    if copies is None:
        return docs.agg(F.count("*").alias("n")).scalar()
    return docs.agg(F.coalesce(F.sum(copies), F.lit(0)).alias("n")).scalar()


def tfidf_long(
    docs: DataFrame, vocab: DataFrame, id: str, terms: str = "terms", n_terms: int = fv.CLASSIFIER_FEATURES
) -> DataFrame:
    """(id, term, df, weight) with unit length per id.

    Counting and normalising both group by id.  Documents that come
    partitioned by id (``repartition`` before the terms are made, so that texts
    and not terms are moved) need no other shuffle.  ``vocab`` has at most
    ``n_terms`` rows.
    """
    chosen = vocab.select("term", "df", "idf")
    exploded = explode_rows(docs, [id], F.col(terms), "term").join(chosen, "term")
    counted = exploded.groupBy(id, "term", "df", "idf").agg(F.count("*").alias("tf"))
    raw = counted.withColumn("_x", F.col("tf") * F.col("idf"))
    length = F.sqrt(F.sum(F.col("_x") * F.col("_x")).over(Window.partitionBy(id)))
    return raw.select(id, "term", "df", (F.col("_x") / length).alias("weight"))


def tfidf(
    docs: DataFrame, id: str, clean: str, n_max: int = fv.CLASSIFIER_FEATURES, partitions: int | None = None
) -> DataFrame:
    """Long TF-IDF of documents over their own vocabulary.

    ``partitions`` (``session.tasks_for``) bounds what one task counts and sorts, which is many times its texts.
    """
    # One shuffle of the short side (texts, not terms), shared by both uses.
    dealt = docs.select(id, clean).repartition(*([partitions] if partitions else []), id)
    prepared = terms(dealt, clean).drop(clean)
    vocab = idf(vocabulary(term_stats(dealt, clean), n_max), count_docs(docs))
    return tfidf_long(prepared, vocab, id, n_terms=n_max)


def fit_vectorizer(
    df: DataFrame, text: str = "text_clean", out: str = "features",
    n_max: int = fv.CLASSIFIER_FEATURES,
) -> PipelineModel:
    """A saved-and-loadable pipeline from cleaned text to TF-IDF vectors.

    The vocabulary is chosen on the driver, from at most ``3 * n_max`` terms.
    """
    stats = df.sparkSession.createDataFrame(top_terms(df, text, n_max), "term string, total bigint, df bigint")
    chosen = idf(stats, F.lit(df.count())).select("term", "idf").collect()
    scaling = DenseVector([row["idf"] for row in chosen])
    # A lateral view of one row makes its column once; else every later stage
    # that uses the column would compute it again.
    words = f"regexp_extract_all({text}, '[a-z0-9]{{2,}}', 0)"
    short = "greatest(size(_uni) - 1, 0)"
    pairs = f"zip_with(slice(_uni, 1, {short}), slice(_uni, 2, {short}), (a, b) -> concat(a, ' ', b))"
    return PipelineModel(stages=[
        SQLTransformer(
            statement=f"SELECT * EXCEPT (_uni) FROM __THIS__ LATERAL VIEW explode(array({words})) u AS _uni "
            f"LATERAL VIEW explode(array(concat(_uni, {pairs}))) t AS _terms"
        ),
        CountVectorizerModel.from_vocabulary(
            [row["term"] for row in chosen], inputCol="_terms", outputCol="_counts"
        ),
        ElementwiseProduct(scalingVec=scaling, inputCol="_counts", outputCol="_weighted"),
        Normalizer(p=2.0, inputCol="_weighted", outputCol="_unit"),
        SQLTransformer(
            statement="SELECT * EXCEPT (_terms, _counts, _weighted, _unit) FROM __THIS__ "
            f"LATERAL VIEW explode(array(_unit)) f AS {out}"
        ),
    ])


def vectors(df: DataFrame, vectorizer: PipelineModel, text: str = "text_clean", out: str = "features") -> DataFrame:
    """Adds the vectors that ``fit_vectorizer``'s pipeline makes, words and pairs found as numbers on Arrow batches."""
    words, scale = vectorizer.stages[1:3]
    made = grams.Vectors(words.vocabulary, scale.getScalingVec().toArray())

    def unit(texts: pa.Array) -> pa.Array:
        return made.vectors(texts)

    # Annotations are names only here; Spark looks at them.
    unit.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return df.withColumn(out, F.arrow_udf(unit, VectorUDT())(text))

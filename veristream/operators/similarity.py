"""Most similar verified hoaxes: cosine of TF-IDF rows, top k above a threshold.

The commonest few terms among the texts asked for are kept as a short dense array of every text,
whose product is cheap.  A text and an article meet by every other term that both have, and by a
common one only where the product of the common parts alone reaches the threshold; their products
are added up as they meet, in one pass, so that no pair is looked up again.  Texts are cleaned,
dealt by their key and turned to vectors once; where the index is small enough to be sent to the
tasks, that is their only shuffle.  No similar pair is lost.

The index keeps weights and common parts, bucketed by term, so that a saved one is never shuffled;
long posting lists are in several chunks.  Copies are handled once: equal cleaned texts, on either
side, are one row of the computation.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from veristream import fixed_values as fv
from veristream.functions import grams, text as tx
from veristream.functions.planning import compute_once, explode_rows
from veristream.operators import features
from veristream.session import materialize, spread, tasks_for

_SLACK = 1e-9  # rounding room of the sums, in favour of candidates
TIE_DIGITS = 9  # similarities equal to this many digits are ties
COMMON = 16  # commonest terms, kept dense
CHUNK = 10_000  # postings of a term in one chunk, about
BUCKETS = 64  # of a saved index


@dataclass(frozen=True)
class Index:
    """Postings by distinct text, vocabulary with its order, and the articles behind a text."""

    postings: DataFrame  # place (of the term), chunk, text_key, weight, slot, common
    vocabulary: DataFrame  # term, total, df, idf, place, slot, chunks
    articles: DataFrame  # id, text_key, title, url, category
    n_terms: int

    def save(self, path: str, buckets: int = BUCKETS) -> None:
        """Postings as a table bucketed by term (its place) and chunk; everything else beside it."""
        spark = self.postings.sparkSession
        name = f"veristream_index_{uuid.uuid4().hex}"
        (
            self.postings.repartition(buckets, "place", "chunk").write.mode("overwrite")
            .bucketBy(buckets, "place", "chunk").sortBy("place", "chunk")
            .option("path", f"{path}/postings").saveAsTable(name)
        )
        spark.sql(f"DROP TABLE {name}")  # the files stay
        self.vocabulary.write.mode("overwrite").parquet(f"{path}/vocabulary")
        self.articles.write.mode("overwrite").parquet(f"{path}/articles")
        facts = spark.range(1).select(F.lit(self.n_terms).alias("n_terms"), F.lit(buckets).alias("buckets"))
        facts.write.mode("overwrite").parquet(f"{path}/facts")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Index":
        """The index saved at ``path``; its postings keep their buckets."""
        read = lambda name: spark.read.parquet(f"{path}/{name}")
        facts = read("facts").first()
        name = f"veristream_index_{uuid.uuid4().hex}"
        columns = read("postings").schema.toDDL()
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (place, chunk) SORTED BY (place, chunk) "
            f"INTO {facts['buckets']} BUCKETS LOCATION '{path}/postings'"
        )
        return Index(spark.table(name), read("vocabulary"), read("articles"), facts["n_terms"])


def _text_key(clean: str = "_clean") -> Column:
    """128 bits of the cleaned text's digest."""
    return F.unhex(F.substring(F.sha2(clean, 256), 1, 32))


def _distinct_texts(df: DataFrame) -> DataFrame:
    """(text_key, _clean, copies), one row per cleaned text, dealt by text_key.

    Copies are reduced in every task before the shuffle.
    """
    return df.groupBy("text_key").agg(F.first("_clean").alias("_clean"), F.count("*").alias("copies"))


def _ordered(vocab: DataFrame, seen: Column) -> DataFrame:
    """Adds ``place`` (0 for the rarest), ``slot`` of the commonest and ``chunks``; a bounded table."""
    back = F.row_number().over(Window.orderBy(seen.desc(), "term")) - 1
    out = vocab.withColumn("_back", back)
    return out.select(
        "term", "total", "df", "idf", (-F.col("_back")).alias("place"),
        F.when(F.col("_back") < COMMON, F.col("_back")).alias("slot"), F.ceil(F.col("df") / CHUNK).cast("int").alias("chunks"),
    )


def _terms(vocab: DataFrame) -> grams.Terms:
    """The vocabulary for the tasks: as many rows as the index has terms, which its maker bounds."""
    rows = vocab.select("term", "place", "idf").collect()
    return grams.Terms([r["term"] for r in rows], [r["place"] for r in rows], [r["idf"] for r in rows])


def _ordered_among(vocab: DataFrame, texts: DataFrame) -> DataFrame:
    """The vocabulary in the order of rarity among cleaned texts (``_clean``)."""
    seen = texts.select("_clean").mapInArrow(_terms(vocab).seen, "place int, seen bigint")
    counts = vocab.join(seen.groupBy("place").agg(F.sum("seen").alias("_seen")), "place", "left")
    return materialize(_ordered(counts.drop("place", "slot", "chunks"), F.coalesce("_seen", F.lit(0))), "similarity-order")


def _counted(docs: DataFrame, vocab: DataFrame) -> DataFrame:
    """(text_key, term, tf) of vocabulary terms; ``docs`` come dealt by text_key."""
    rows = explode_rows(docs, ["text_key"], F.col("terms"), "term").join(vocab.select("term"), "term", "left_semi")
    return rows.groupBy("text_key", "term").agg(F.count("*").alias("tf"))


def _with_norms(counted: DataFrame, vocab: DataFrame) -> DataFrame:
    """Unit weights, and the weights of the common terms at hand in every row."""
    row = Window.partitionBy("text_key")
    raw = counted.join(vocab.select("term", "idf", "place", "slot", "chunks"), "term").withColumn("_x", F.col("tf") * F.col("idf"))
    unit = raw.withColumn("weight", F.col("_x") / F.sqrt(F.sum(F.col("_x") * F.col("_x")).over(row)))
    common = [F.coalesce(F.max(F.when(F.col("slot") == i, F.col("weight"))).over(row), F.lit(0.0)) for i in range(COMMON)]
    return unit.select("text_key", "place", "slot", "chunks", "weight", F.array(*common).alias("common"))


def _postings(counted: DataFrame, vocab: DataFrame) -> DataFrame:
    """The index side: every posting in a chunk of its term's list."""
    chunk = F.pmod(F.xxhash64("text_key"), F.col("chunks")).cast("int").alias("chunk")
    return _with_norms(counted, vocab).select("place", chunk, "text_key", "weight", "slot", "common")


def build_index(
    corpus: DataFrame, id: str = "id", n_terms: int = fv.SIMILARITY_FEATURES, partitions: int | None = None,
    background: DataFrame | None = None, texts: DataFrame | None = None,
) -> Index:
    """Index of articles with ``title`` and ``body_text``.

    Missing ``url`` and ``category`` columns count as ''.  Articles whose
    cleaned text is empty are left out.  ``background`` (term, df) tells how common terms are
    among the texts to be looked up; it decides the order and with it the work, not the result.
    ``texts``, cleaned ones in ``_clean``, stand for it: the index's own terms are counted in them.
    """
    blank = F.lit("")
    given = lambda c: F.coalesce(F.col(c), blank) if c in corpus.columns else blank
    joined = F.concat(given("title"), F.lit(" "), given("body_text"))
    articles = spread(corpus, partitions).select(
        F.col(id).alias("id"),
        given("title").alias("title"),
        given("url").alias("url"),
        given("category").alias("category"),
        joined.alias("_clean"),
    )
    articles = compute_once(articles, "_clean", tx.clean_similarity(F.col("_clean")))
    # Cleaned once, used for texts, statistics, weights and look-ups.
    articles = materialize(articles.filter(F.length("_clean") > 0).withColumn("text_key", _text_key()), "similarity-articles")
    distinct = _distinct_texts(articles)
    prepared = materialize(features.terms(distinct, "_clean"), "similarity-texts")
    chosen = features.idf(
        features.vocabulary(features.term_stats(prepared, "_clean", "copies"), n_terms), features.count_docs(prepared, "copies")
    )
    seen = F.col("df")
    if background is not None:
        chosen = chosen.join(background.select("term", F.col("df").alias("_seen")), "term", "left")
        seen = F.coalesce("_seen", F.lit(0))
    vocab = materialize(_ordered(chosen, seen), "similarity-vocabulary")
    if texts is not None:
        vocab = _ordered_among(vocab, texts)
    counted = _counted(prepared.drop("_clean").repartition("text_key"), vocab)
    return Index(materialize(_postings(counted, vocab), "similarity-postings"), vocab, articles.drop("_clean"), n_terms)


def _reordered(index: Index, asked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Postings and vocabulary in the order of rarity among the texts asked for."""
    vocab = _ordered_among(index.vocabulary, asked)
    # tf is known only up to the idf's factor and the length, and both cancel out.
    again = index.postings.select("text_key", "place", "weight").join(index.vocabulary.select("place", "term", F.col("idf").alias("_idf")), "place")
    return _postings(again.select("text_key", "term", (F.col("weight") / F.col("_idf")).alias("tf")), vocab), vocab


def _asked(texts: DataFrame, vocab: DataFrame, tasks: int) -> DataFrame:
    """The query side as ``_with_norms`` gives it, for (text_key, _clean); all of a text in one of ``tasks`` tasks."""
    terms = _terms(vocab)
    vectors = texts.mapInArrow(terms.weigh, "text_key binary, places array<int>, weights array<double>").repartition(tasks, "text_key")
    # The commonest terms have the highest places, 0, -1 and so on.
    weight_of = lambda i: F.coalesce(F.get("weights", F.array_position("places", F.lit(-i)).cast("int") - 1), F.lit(0.0))
    with_common = vectors.withColumn("common", F.array(*[weight_of(i) for i in range(COMMON)]))
    rows = with_common.select("text_key", "weights", "common", F.posexplode("places").alias("_i", "place")).select(
        "text_key", "place", F.get("weights", F.col("_i")).alias("weight"), "common"
    )
    long = F.broadcast(vocab.filter("chunks > 1").select("place", "chunks"))
    return rows.join(long, "place", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))


def _dot(left: str, right: str) -> Column:
    total = F.lit(0.0)
    for i in range(COMMON):
        total = total + F.col(left)[i] * F.col(right)[i]
    return total


def candidates(asked: DataFrame, postings: DataFrame, threshold: float) -> DataFrame:
    """(query_key, text_key, _sim): pairs of texts whose product reaches the threshold, rounding aside.

    ``asked`` are the query side's postings, in the same order of terms.
    """
    mine = explode_rows(
        asked, [F.col("text_key").alias("query_key"), "place", F.col("weight").alias("_w"), F.col("common").alias("_common")],
        F.sequence(F.lit(0), F.col("chunks") - 1), "chunk",
    )
    joined = mine.join(postings, ["place", "chunk"]).withColumn("_dot", _dot("_common", "common"))
    rare = F.col("slot").isNull()
    # The common terms' product is in every row; by it alone a pair is made only where it suffices.
    met = joined.filter(rare | (F.col("_dot") >= threshold - _SLACK))
    return (
        met.groupBy("query_key", "text_key")
        .agg((F.sum(F.when(rare, F.col("_w") * F.col("weight")).otherwise(0.0)) + F.max("_dot")).alias("_sim"))
        .filter(F.col("_sim") >= threshold - _SLACK)
    )


def _best(asked: DataFrame, index: Index, k: int, threshold: float, reorder: bool, tasks: int = 1) -> DataFrame:
    """(query_key, rank, id, title, url, category, _sim) for (text_key, _clean) rows."""
    if threshold <= 0:
        raise ValueError("threshold must be above 0")
    postings, vocab = index.postings, index.vocabulary
    if reorder:
        postings, vocab = _reordered(index, asked)
        postings = materialize(postings, "similarity-reordered")
    q = _asked(_distinct_texts(asked).select("text_key", "_clean"), vocab, tasks_for(asked, "_clean", tasks))
    similar = candidates(q, postings, threshold).filter(F.round("_sim", TIE_DIGITS) >= threshold)
    # Of articles with one text only the first k can be among the top k.
    same_text = Window.partitionBy("text_key").orderBy("id")
    firsts = (
        index.articles.withColumn("_r", F.row_number().over(same_text))
        .filter(F.col("_r") <= k)
        .drop("_r")
    )
    best = Window.partitionBy("query_key").orderBy(F.round("_sim", TIE_DIGITS).desc(), "id")
    return (
        similar.join(firsts, "text_key").drop("text_key")
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
    )


def topk(
    queries: DataFrame,
    index: Index,
    id: str = "id",
    text: str = "text",
    k: int = 1,
    threshold: float = fv.SIMILARITY_THRESHOLD,
    partitions: int | None = None,
    reorder: bool = True,
) -> DataFrame:
    """(query_id, rank, article_id, title, url, category, similarity).

    Up to ``k`` rows per query, similarity rounded to 4 digits, ties in order
    of the article id.  ``reorder`` takes the order of terms from the queries, which shuffles
    the index once and leaves fewest candidates; without it the index stays where it is.
    """
    texts = spread(queries.select(F.col(id).alias("query_id"), F.col(text).alias("_text")), partitions)
    cleaned = compute_once(texts, "_clean", tx.clean_similarity(F.col("_text"))).drop("_text")
    asked = materialize(cleaned.filter(F.length("_clean") > 0).withColumn("text_key", _text_key()), "similarity-asked")
    ranked = _best(asked.select("text_key", "_clean"), index, k, threshold, reorder, partitions or 1)
    return asked.select("query_id", F.col("text_key").alias("query_key")).join(ranked, "query_key").select(
        "query_id",
        "rank",
        F.col("id").alias("article_id"),
        "title",
        "url",
        "category",
        F.round("_sim", 4).alias("similarity"),
    )


def _in_words(similarity: Column, title: Column) -> Column:
    percent = F.round(F.round(similarity, 4) * 100, 1).cast("string")
    return F.when(similarity.isNotNull(), F.format_string(fv.REASON_MATCH, percent, title)).otherwise(F.lit(fv.REASON_NONE))


def with_reason(df: DataFrame, index: Index, text: str = "text", threshold: float = fv.SIMILARITY_THRESHOLD) -> DataFrame:
    """Adds ``reason`` to rows with a text, in batches small against the index (a stream's).

    Rows need no id: equal texts share one look-up.  The index is used as it is.
    """
    keyed = compute_once(df, "_clean", tx.clean_similarity(F.coalesce(F.col(text), F.lit("")))).withColumn("_key", _text_key())
    asked = keyed.filter(F.length("_clean") > 0).select(F.col("_key").alias("text_key"), "_clean")
    best = _best(asked, index, 1, threshold, reorder=False).select(F.col("query_key").alias("_key"), F.col("title").alias("_title"), "_sim")
    return keyed.join(best, "_key", "left").withColumn("reason", _in_words(F.col("_sim"), F.col("_title"))).drop("_key", "_clean", "_title", "_sim")


def reason(queries: DataFrame, matches: DataFrame, id: str = "id") -> DataFrame:
    """Adds ``reason``: the best match in words, or that there is none."""
    best = matches.filter("rank = 1").select(
        F.col("query_id").alias(id), F.col("title").alias("_title"), F.col("similarity").alias("_sim")
    )
    return (
        queries.join(best, id, "left").withColumn("reason", _in_words(F.col("_sim"), F.col("_title"))).drop("_title", "_sim")
    )

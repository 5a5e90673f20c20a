"""Mixing sources to target weights by weighted fair queueing.

Sources get weights 5, 2, 1, 5, ... by name and share the budget (150 % of all words) by
weight; no target exceeds twice its source's words, the excess goes to the others by weight.
Every source's documents are put in a fixed shuffled order, twice over.  A document's virtual
finish time is its source's words so far divided by the source's target.  All are sorted by
it, over the whole cluster, and cut where the budget is used up.

Null texts have size 0, a null source is one source, last.  A document of size 0 takes nothing;
an empty table gives an empty mix.  Repeated rows and ids are rows of their own; which of two
equal ones is taken makes no difference.  Texts of any length count whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from veristream.llm.common import WORD, materialize
from veristream.llm.prefix import running

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2


def targets(sizes: DataFrame) -> DataFrame:
    """rank, source, source_size and target per source, from (source, size) rows."""
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = running(
        total.withColumn("_null", F.col("source").isNull().cast("int")).withColumn("_one", F.lit(1)),
        None, ["_null", "source"], "_one", "sources",
    )
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.col("idx") - 1) % len(WEIGHTS) + 1).cast("int"))
    s = materialize(ranked.select((F.col("idx") - 1).alias("rank"), "source", "source_size", weight.cast("long").alias("weight")), "ranked")
    sums = s.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    budget, all_weight = SHARE * (sums["size"] or 0), sums["weight"] or 0
    # The sources that stop at their cap are those with the least cap per weight.
    cap = MOST * F.col("source_size")
    level = (cap / F.col("weight")).alias("level")
    by_level = running(s.select("*", level, cap.alias("cap")), None, ["level", "rank"], "cap", "caps").withColumnRenamed("cum", "caps").drop("idx")
    by_level = running(by_level, None, ["level", "rank"], "weight", "weights").withColumnRenamed("cum", "weights")
    rest = all_weight - F.col("weights") + F.col("weight")
    full = F.col("cap") * rest <= (F.lit(budget) - F.col("caps") + F.col("cap")) * F.col("weight")
    by_level = materialize(by_level.select("rank", "source", "source_size", "weight", "cap", full.alias("full")), "levels")
    stopped = by_level.where("full").agg(F.sum("cap").alias("cap"), F.sum("weight").alias("weight")).first()
    free = all_weight - (stopped["weight"] or 0)
    share = (F.lit(budget) - (stopped["cap"] or 0)) / F.lit(float(free or 1)) * F.col("weight")
    return by_level.select(
        "rank", "source", "source_size", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(share).alias("target")
    )


def size_of(text: str):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def mix(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, ``keep``, size, source_size, target and taken, from (doc_id, source, size, ``keep``) rows."""
    rows = materialize(rows.select("doc_id", "source", "size", *keep), "sizes")
    goal = materialize(targets(rows), "targets")
    t = goal.withColumnRenamed("source", "_source")
    joined = rows.join(t, rows["source"].eqNullSafe(t["_source"])).drop("_source", "source")
    shuffled = joined.withColumn("_h", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    placed = materialize(running(shuffled, "rank", ["_h", "doc_id", "size", *keep], "size", "placed"), "queue")
    finish = lambda turn: (F.col("source_size") * turn + F.col("cum")) / F.col("target")
    item = lambda turn: F.struct(finish(turn).alias("v"), "rank", F.lit(turn).alias("turn"), F.col("idx"))
    items = (
        placed.where((F.col("size") > 0) & (F.col("target") > 0))
        .select("size", F.explode(F.array(*[item(k) for k in range(MOST)])).alias("item")).select("size", "item.*")
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    queue = running(items.withColumnRenamed("idx", "place"), None, ["v", "rank", "turn", "place"], "size", "global")
    last = queue.where(F.col("cum") <= SHARE * total).agg(F.max(F.struct("v", "rank", "turn", "place")).alias("m")).first()["m"]
    if last is None:
        times = F.lit(0)
    else:
        end = F.struct(
            F.lit(last["v"]).cast("double").alias("v"), F.lit(last["rank"]).cast("long").alias("rank"),
            F.lit(last["turn"]).cast("int").alias("turn"), F.lit(last["place"]).cast("long").alias("idx"),
        )
        times = sum(F.when((F.col("size") > 0) & (item(k) <= end), 1).otherwise(0) for k in range(MOST))
    return placed.select("doc_id", *keep, "size", "source_size", "target", (F.col("size") * times).cast("long").alias("taken"))


def mix_documents(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken for every document."""
    return mix(docs.select("doc_id", "source", size_of("text").alias("size")))


def apply_mix(docs: DataFrame) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its columns."""
    marked = materialize(docs.withColumn("_mx_row", F.monotonically_increasing_id()), "rows")
    plan = mix(marked.select("doc_id", "source", size_of("text").alias("size"), "_mx_row"), ("_mx_row",))
    times = plan.where("taken > 0").select("_mx_row", (F.col("taken") / F.col("size")).cast("int").alias("_mx_times"))
    return marked.join(times, "_mx_row").select(
        *[F.col(f"`{c}`") for c in docs.columns], F.explode(F.sequence(F.lit(1), "_mx_times")).alias("_mx_copy")
    ).select(*[F.col(f"`{c}`") for c in docs.columns])


#: The same for DuckDB.
SQL = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS weight,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM d GROUP BY source
), t AS (SELECT 1.5::DOUBLE * sum(source_size) AS budget, sum(weight) AS w FROM s),
l AS (
  SELECT s.*, 2 * source_size AS cap, t.budget, t.w,
         sum(2 * source_size) OVER o - 2 * source_size AS caps, sum(weight) OVER o - weight AS weights
  FROM s, t WINDOW o AS (ORDER BY 2 * source_size / weight, rank ROWS UNBOUNDED PRECEDING)
), f AS (SELECT *, cap * (w - weights) <= (budget - caps) * weight AS is_full FROM l),
r AS (SELECT coalesce(sum(cap) FILTER (WHERE is_full), 0) AS c, coalesce(sum(weight) FILTER (WHERE is_full), 0) AS fw FROM f),
g AS (
  SELECT f.rank, f.source, f.source_size, f.budget,
         CASE WHEN is_full THEN cap::DOUBLE ELSE (f.budget - r.c) / greatest(f.w - r.fw, 1)::DOUBLE * f.weight END AS target
  FROM f, r
), q AS (
  SELECT d.doc_id, d.size, g.rank, g.source_size, g.target, g.budget,
         sum(d.size) OVER p AS cum, row_number() OVER p AS idx
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
  WINDOW p AS (PARTITION BY g.rank ORDER BY md5(coalesce(d.doc_id::VARCHAR, '')), d.doc_id, d.size ROWS UNBOUNDED PRECEDING)
), i AS (
  SELECT q.*, turn, (source_size * turn + cum)::DOUBLE / target AS v
  FROM q, (VALUES (0), (1)) AS e(turn) WHERE size > 0 AND target > 0
), c AS (
  SELECT rank, idx, sum(size) OVER (ORDER BY v, rank, turn, idx ROWS UNBOUNDED PRECEDING) <= budget AS taken FROM i
), n AS (SELECT rank, idx, count(*) FILTER (WHERE taken) AS times FROM c GROUP BY ALL)
SELECT q.doc_id, q.size, q.source_size::BIGINT AS source_size, q.target, (q.size * coalesce(n.times, 0))::BIGINT AS taken
FROM q LEFT JOIN n ON q.rank = n.rank AND q.idx = n.idx
"""

"""Cross-site boilerplate: lines that stand on many distinct sites, found with HyperLogLog.

A cheap count leaves only lines that occur often enough at all and on more than one site.
Per line hash, sketches of its sites are made in the tasks and merged by aggregation.  Lines
clearly above the threshold are boilerplate; those whose estimate is near it get an exact
distinct count.  Boilerplate stays at its first place (smallest doc_id, then text, source and
line number) and goes everywhere else.

Lines are the pieces between line feeds; lines of fewer than ``min_words`` words never go.  A
null text stays null; an empty one stays empty.  A null source is a site of its own.  Rows
equal in doc_id, source and text share their fate.  All columns of the input stay, with the
text replaced; names made here start with ``_ld_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from veristream.llm.common import SPACE, WORD, materialize

#: Sites from which a line is boilerplate.
SITES = 5
#: Estimates within this part of the threshold, and one at least, are counted exactly.
NEAR = 0.1


def _row_key() -> Column:
    part = lambda c: F.coalesce(F.concat(F.lit("s"), F.col(c).cast("string")), F.lit("n"))
    return F.md5(F.concat_ws("\x00", part("doc_id"), part("source"), part("text")))


def _lines(docs: DataFrame, min_words: int) -> DataFrame:
    site = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))
    enough = rf"^(?:[\x20\x09-\x0D]*{WORD}(?:{SPACE}|$)){{{min_words}}}"
    return (
        docs.where(F.col("text").isNotNull())
        .select("doc_id", _row_key().alias("key"), site.alias("site"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
        .where(F.col("line").rlike(enough))
        .select("doc_id", "key", "site", "pos", F.unhex(F.md5("line")).alias("hash"))
    )


def boilerplate(docs: DataFrame, sites: int = SITES, min_words: int = 5) -> tuple[DataFrame, DataFrame]:
    """(all lines that may be boilerplate, hash of those that are with their first place)."""
    lines = _lines(docs, min_words)
    often = (
        lines.groupBy("hash").agg(F.count("*").alias("n"), F.min("site").alias("a"), F.max("site").alias("b"))
        .where((F.col("n") >= sites) & ((F.col("a") != F.col("b")) | F.lit(sites <= 1))).select("hash")
    )
    some = materialize(lines.join(often, "hash", "left_semi"), "lines")
    # A line of a third of all documents is sketched in parts, which are merged.
    sketches = (
        some.groupBy("hash", (F.xxhash64("key") % 16).alias("part"))
        .agg(F.hll_sketch_agg("site", 12).alias("sketch"), F.min(F.struct("doc_id", "key", "pos")).alias("first"))
        .groupBy("hash").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n"), F.min("first").alias("first"))
    )
    margin = max(1, round(NEAR * sites))
    sketches = materialize(sketches.where(F.col("n") >= sites - margin), "sketches")
    near = sketches.where(F.col("n") <= sites + margin)
    exact = (
        some.join(near.select("hash"), "hash", "left_semi").select("hash", "site").distinct()
        .groupBy("hash").agg(F.count("*").alias("n")).where(F.col("n") >= sites)
    )
    sure = sketches.where(F.col("n") > sites + margin)
    return some, sure.select("hash", "first").unionByName(near.join(exact.select("hash"), "hash").select("hash", "first"))


def dedup(docs: DataFrame, sites: int = SITES, min_words: int = 5) -> DataFrame:
    """The documents without repeated boilerplate; ``_ld_lines`` and ``_ld_removed`` count lines."""
    some, bad = boilerplate(docs, sites, min_words)
    here = F.struct("doc_id", "key", "pos")
    gone = (
        some.join(bad, "hash").where(~here.eqNullSafe(F.col("first")))
        .groupBy(F.col("key").alias("_ld_key")).agg(F.array_sort(F.collect_set("pos")).alias("_ld_gone"))
    )
    lines = F.split("text", "\n", -1)
    left = F.transform(
        F.array_except(F.sequence(F.lit(0), F.size("_ld_all") - 1), F.col("_ld_gone")), lambda i: F.get("_ld_all", i)
    )
    marked = docs.withColumn("_ld_key", _row_key()).join(gone, "_ld_key", "left").withColumn("_ld_all", lines)
    text = F.when(F.col("_ld_gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    return marked.select(
        *[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns],
        F.greatest(F.coalesce(F.size("_ld_all"), F.lit(0)), F.lit(0)).cast("long").alias("_ld_lines"),
        F.greatest(F.coalesce(F.size("_ld_gone"), F.lit(0)), F.lit(0)).cast("long").alias("_ld_removed"),
    )


def keep(docs: DataFrame, sites: int = SITES, min_words: int = 5) -> DataFrame:
    """The documents without repeated boilerplate, in their own columns (``n_chars`` put right).

    Those that consisted of nothing else go; those that had no words before stay.
    """
    out = dedup(docs, sites, min_words).where((F.col("_ld_removed") == 0) | F.col("text").rlike(WORD))
    if "n_chars" in docs.columns:
        changed = F.when(F.col("_ld_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", changed)
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


#: The same for DuckDB, with exact counts.
SQL = rf"""
WITH l0 AS (
  SELECT doc_id, md5(concat_ws(chr(0), coalesce('s' || doc_id, 'n'), coalesce('s' || source, 'n'), coalesce('s' || text, 'n'))) AS key,
         coalesce('s' || source, 'n') AS site, string_split(text, chr(10)) AS lines
  FROM documents
), l AS (
  SELECT doc_id, key, site, generate_subscripts(lines, 1) - 1 AS pos, unnest(lines) AS line FROM l0
), h AS (
  SELECT line, min({{'d': doc_id, 'k': key, 'p': pos}}) AS first FROM l
  WHERE len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 5
  GROUP BY line HAVING count(DISTINCT site) >= {SITES}
), g AS (
  SELECT l.doc_id, l.key, l.pos, l.line, h.line IS NOT NULL AND (l.doc_id, l.key, l.pos) <> (h.first.d, h.first.k, h.first.p) AS gone
  FROM l LEFT JOIN h ON l.line = h.line
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
       coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text
FROM g GROUP BY doc_id, key
"""

"""Seeded, repeatable sampling: balancing, splitting, shuffling.

A class may hold most of the rows, so no class is ever ranked as one group, and
rows are not moved to be told apart.  Rows get a hash of their key.  Where a
part of a class ends is found by a histogram of the hashes' leading digits,
refined digit by digit inside the bucket that holds the end until that bucket
is small; then each row is compared with the hash found there.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import ROUND_CEILING, Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from veristream.session import materialize

STEP_DIGITS = 3  # digits added to the histogram at a time: 16**3 counts for each end looked for
SMALL = 20_000  # hashes of a bucket that are sorted as they are
HASH_DIGITS = 32
#: Rows of a class in a bucket that is ranked as one group, about.
RANKED = 4096


def seeded_hash(key: Column, seed: int) -> Column:
    return F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed}")))


def _digits(n: int) -> int:
    """Leading digits that cut ``n`` rows into buckets of about RANKED."""
    digits = 1
    while RANKED * 16**digits < n and digits < HASH_DIGITS:
        digits += 1
    return digits


def _nth_hashes(narrow: DataFrame, wanted: list[tuple[str | None, int, int]]) -> dict[tuple[str | None, int], str]:
    """The n-th hash of a class, for each (class, n, size of the class) with 1 <= n <= size.

    ``narrow`` has ``_l`` and ``_h``.  What comes to the driver are counts: 16**3 at most for each one
    looked for.  A key so frequent that its bucket never gets small is found by its whole hash.
    """
    spark = narrow.sparkSession
    state = {(label, n): ("", n, size) for label, n, size in wanted}  # prefix, position in it, rows in it
    schema = T.StructType([T.StructField("_q", narrow.schema["_l"].dataType), T.StructField("_p", T.StringType())])

    def within(some):
        rows = spark.createDataFrame(sorted({(k[0], state[k][0]) for k in some}, key=str), schema)
        # One row for each end looked for.
        return narrow.join(F.broadcast(rows), narrow["_l"].eqNullSafe(F.col("_q")) & F.startswith("_h", F.col("_p")))

    while large := [k for k, (prefix, _, n) in state.items() if n > SMALL and len(prefix) < HASH_DIGITS]:
        by_length: dict[int, list] = {}
        for k in large:
            by_length.setdefault(len(state[k][0]), []).append(k)
        for length, some in by_length.items():
            longer = F.substring("_h", 1, length + STEP_DIGITS)
            counts: dict[tuple, list] = {}
            for row in within(some).groupBy("_l", "_p", longer.alias("_b")).agg(F.count("*").alias("n")).collect():
                counts.setdefault((row["_l"], row["_p"]), []).append((row["_b"], row["n"]))
            for k in some:
                prefix, n, _ = state[k]
                for bucket, size in sorted(counts[k[0], prefix]):
                    if n <= size:
                        state[k] = (bucket, n, size)
                        break
                    n -= size
    out = {k: prefix for k, (prefix, _, _) in state.items() if len(prefix) >= HASH_DIGITS}
    rest = [k for k in state if k not in out]
    if rest:
        for row in within(rest).groupBy("_l", "_p").agg(F.sort_array(F.collect_list("_h")).alias("h")).collect():
            for k in rest:
                if (k[0], state[k][0]) == (row["_l"], row["_p"]):
                    out[k] = row["h"][state[k][1] - 1]
    return out


def _sizes(narrow: DataFrame) -> dict[str | None, int]:
    """Rows of each class; classes are few."""
    return {row["_l"]: row["n"] for row in narrow.groupBy("_l").agg(F.count("*").alias("n")).collect()}


def _narrow(df: DataFrame, label: str, key: str, seed: int) -> DataFrame:
    """Class and hash alone, made once."""
    return materialize(df.select(F.col(label).alias("_l"), seeded_hash(F.col(key), seed).alias("_h")), "hashes")


def positions(
    df: DataFrame, label: str, key: str, seed: int, limit: int | None = None, expected: int = RANKED * 16**2
) -> DataFrame:
    """Adds ``_pos`` (1, 2, ... in hash order within the label) and ``_size``.

    Keys must be unique; null labels are a class of their own.  With ``limit``, rows beyond that position are left
    out, and buckets that lie beyond it never reach the ranking.  ``expected``: rows of the largest class, about;
    a class is ranked in so many buckets that one has some thousand rows.
    """
    hashed = df.withColumn("_hash", seeded_hash(F.col(key), seed)).withColumn(
        "_bucket", F.substring("_hash", 1, _digits(expected))
    )
    histogram = hashed.groupBy(F.col(label).alias("_l"), F.col("_bucket").alias("_b")).agg(
        F.count("*").alias("_n")
    )
    per_label = Window.partitionBy("_l")
    before = per_label.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = histogram.select(
        "_l",
        "_b",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
        F.sum("_n").over(per_label).alias("_size"),
    )
    if limit is not None:
        starts = starts.filter(F.col("_start") < limit)
    placed = hashed.join(
        starts, hashed[label].eqNullSafe(starts["_l"]) & (hashed["_bucket"] == starts["_b"])
    )
    in_bucket = Window.partitionBy("_l", "_b").orderBy("_hash", key)
    ranked = placed.withColumn("_pos", F.col("_start") + F.row_number().over(in_bucket))
    if limit is not None:
        ranked = ranked.filter(F.col("_pos") <= limit)
    return ranked.drop("_hash", "_bucket", "_l", "_b", "_start")


def _draws(sizes: DataFrame, label: str, n: int, seed: int, chunk: int = 10_000) -> DataFrame:
    """How often each position of a small class is drawn in ``n`` draws."""
    chunks = sizes.withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit((n - 1) // chunk))))
    if n > chunk:
        chunks = chunks.repartition(label, "_c")
    last = F.least(F.col("_c") * chunk + chunk - 1, F.lit(n - 1))
    slots = chunks.withColumn("_i", F.explode(F.sequence(F.col("_c") * chunk, last)))
    digest = F.md5(F.concat(F.col(label), F.lit(":"), F.col("_i").cast("string"), F.lit(f":{seed}")))
    number = F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint")
    return (
        slots.select(label, (number % F.col("_size") + 1).alias("_pos"))
        .groupBy(label, "_pos")
        .agg(F.count("*").alias("_copies"))
    )


def balance(
    df: DataFrame, n: int, seed: int = 42, label: str = "final_label", key: str = "text"
) -> DataFrame:
    """Exactly ``n`` rows per label; rows without a label are left out.

    Larger classes are cut to the first ``n`` in hash order; smaller ones are
    filled by drawing with replacement.  Only rows that stay are moved.
    """
    given = df.filter(F.col(label).isNotNull())
    narrow = _narrow(given, label, key, seed)
    sizes = _sizes(narrow)
    ends = _nth_hashes(narrow, [(la, n, size) for la, size in sizes.items() if size > n])
    rows = [(la, ends.get((la, n), "g"), size) for la, size in sizes.items()]  # "g" comes after every hash
    schema = T.StructType([
        T.StructField(label, df.schema[label].dataType), T.StructField("_end", T.StringType()), T.StructField("_size", T.LongType())
    ])
    table = df.sparkSession.createDataFrame(rows, schema)
    inside = given.join(F.broadcast(table), label).filter(seeded_hash(F.col(key), seed) <= F.col("_end"))
    placed = positions(inside.drop("_end", "_size"), label, key, seed, limit=n, expected=n).drop("_size").join(
        F.broadcast(table.drop("_end")), label
    )
    draws = _draws(table.filter(F.col("_size") < n).select(label, "_size"), label, n, seed)
    copies = F.when(F.col("_size") >= n, F.lit(1)).otherwise(
        F.coalesce(F.col("_copies"), F.lit(0))
    )
    return (
        placed.join(draws, [label, "_pos"], "left")
        .withColumn("_copies", copies.cast("int"))
        .filter("_copies > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .select(*df.columns)
    )


def split(
    df: DataFrame,
    parts: Sequence[tuple[str, str]] = (("test", "0.2"), ("train", "0.8")),
    seed: int = 42,
    label: str = "final_label",
    key: str = "text",
    out: str = "part",
) -> DataFrame:
    """Stratified split: adds the name of the part a row belongs to.

    Within each label the first ``ceil(fraction * size)`` rows in hash order go
    to the first part, and so on with the running sum of fractions.  Null labels
    are a class of their own.  Rows of one key (or without one) stay together,
    in the part that the first of them falls in.  Rows are not moved: each is
    compared with the hashes at which the parts of its class end.
    """
    narrow = _narrow(df, label, key, seed)
    sizes = _sizes(narrow)
    running, places = Decimal(0), []
    for _, fraction in parts[:-1]:
        running += Decimal(str(fraction))
        places.append({la: int((running * size).to_integral_value(ROUND_CEILING)) for la, size in sizes.items()})
    ends = _nth_hashes(narrow, sorted({(la, p[la], sizes[la]) for p in places for la in sizes if 1 <= p[la] <= sizes[la]}, key=str))
    rows = [(la, [ends.get((la, p[la]), "" if p[la] < 1 else "g") for p in places]) for la in sizes]
    schema = T.StructType([T.StructField("_l", df.schema[label].dataType), T.StructField("_ends", T.ArrayType(T.StringType()))])
    table = F.broadcast(df.sparkSession.createDataFrame(rows, schema))  # a row per class
    hashed = seeded_hash(F.col(key), seed)
    chosen = None
    for i, (name, _) in enumerate(parts[:-1]):
        chosen = (F if chosen is None else chosen).when(hashed <= F.col("_ends")[i], F.lit(name))
    placed = df.join(table, df[label].eqNullSafe(F.col("_l")))
    return placed.withColumn(out, chosen.otherwise(F.lit(parts[-1][0]))).select(*df.columns, out)


def shuffle(df: DataFrame, seed: int = 42, key: str = "text") -> DataFrame:
    """All rows in a repeatable random order."""
    return df.orderBy(seeded_hash(F.col(key), seed), key)

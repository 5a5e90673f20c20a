"""Conversations as training texts in windows of a token budget.

Prefix sums of turn tokens choose turn-aligned spans: a conversation's budget, less its system
turn and the history, is halved, and turns that start in the same half-budget share a window.
A turn longer than that stands alone; so no window exceeds the budget but that of a turn that
alone does.  Every later window repeats the system turn (the first turn with role ``system``)
and as many of the last turns before it as fit ``history`` tokens and ``repeat`` turns; repeated
turns, and all but assistant turns, are masked.

The template: ``### <role>: <text></turn>`` and a line end.  Inside roles and texts a backslash is
put before each backslash and inside each control string, so that no control string stands in
them and ``unescape`` gives them back.

Turns are ordered by turn (null first), role, text.  Null roles and texts count as empty; rows
without conv_id are one conversation.  Repeated rows are turns of their own.  An empty table
gives no windows.  Other columns are not looked at.

Positions within a conversation are counted in two steps over ranges of rows, so a conversation
of any length is spread over tasks; only a window's own turns come together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from veristream.llm.common import WORD, materialize, shuffle_partitions

TURN_END = "</turn>"
TURN_START = "### "
BUDGET = 1024
HISTORY = 128
REPEAT = 2


def escape(c: Column) -> Column:
    doubled = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(doubled, F.lit(TURN_END), F.lit("<\\/turn>")), F.lit(TURN_START), F.lit("#\\## "))


def escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit(":"), F.lit("\\:"))


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def _positions(turns: DataFrame) -> DataFrame:
    """Adds place (from 1) and tokens before, within the conversation."""
    spark = turns.sparkSession
    order = ["turn", "role", "text"]
    # Four ranges per later partition: they spread evenly when dealt by hash.
    dealt = turns.repartitionByRange(4 * shuffle_partitions(spark), "conv_id", *order)
    dealt = materialize(dealt.withColumn("part", F.spark_partition_id()), "turns")
    w = Window.partitionBy("part", "conv_id").orderBy(*order)
    local = dealt.withColumns({
        "place": F.row_number().over(w),
        "before": F.coalesce(F.sum("tokens").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    })
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offset = dealt.groupBy("part", "conv_id").agg(F.count("*").alias("n"), F.sum("tokens").alias("t")).select(
        F.col("part").alias("_part"), F.col("conv_id").alias("_conv"),
        F.sum("n").over(earlier).alias("_n"), F.sum("t").over(earlier).alias("_t"),
    ).where(F.col("_n").isNotNull())
    joined = local.join(offset, (F.col("part") == F.col("_part")) & F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    return joined.select(
        "conv_id", "role", "text", "tokens",
        (F.col("place") + F.coalesce("_n", F.lit(0))).alias("place"), (F.col("before") + F.coalesce("_t", F.lit(0))).alias("before"),
    )


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, repeat: int = REPEAT) -> DataFrame:
    """conv_id, window (sortable), formatted, and per turn in it its span.

    ``spans``: array of (head: start of the turn, start and end of its text, fresh: not a
    repetition, loss: trained on), positions in code points from 0, ends exclusive.
    """
    turns = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("tokens", F.regexp_count("text", F.lit(WORD)).cast("long") + 4)
    placed = materialize(_positions(turns), "placed")
    system = placed.where(F.col("role") == "system").groupBy("conv_id").agg(
        F.min_by(F.struct("place", "role", "text", "tokens"), "place").alias("s")
    ).select(F.col("conv_id").alias("s_conv"), "s")
    with_system = placed.join(system, F.col("conv_id").eqNullSafe(F.col("s_conv")), "left").drop("s_conv")
    is_system = F.coalesce(F.col("place") == F.col("s.place"), F.lit(False))
    s_tokens = F.coalesce(F.col("s.tokens"), F.lit(0))
    half = F.greatest(F.floor((F.lit(budget - history) - s_tokens) / 2), F.lit(max(1, budget // 8)))
    start = F.col("before") - F.when(F.col("place") > F.col("s.place"), s_tokens).otherwise(0)
    bucket = F.when(is_system, F.lit(0)).otherwise(F.floor(start / half))
    alone = F.when(~is_system & (F.col("tokens") > half), F.col("place")).otherwise(F.lit(0))
    body = with_system.select(
        "conv_id", F.struct(bucket.cast("long").alias("bucket"), alone.cast("long").alias("alone")).alias("window"),
        "role", "text", "tokens", "place", is_system.alias("is_system"),
    )
    first = body.where(~F.col("is_system")).groupBy("conv_id", "window").agg(F.min("place").alias("first"))
    opening = first.groupBy("conv_id").agg(F.min("first").alias("open")).select(F.col("conv_id").alias("o_conv"), "open")
    later = first.join(opening, F.col("conv_id").eqNullSafe(F.col("o_conv"))).where("first > open").drop("o_conv", "open")
    # Whether a system turn's own window is this one: it is in bucket 0 with the turns that start there.
    later_system = later.join(system, F.col("conv_id").eqNullSafe(F.col("s_conv"))).where(
        ~((F.col("window.bucket") == 0) & (F.col("window.alone") == 0))
    ).select("conv_id", "window", "s.role", "s.text", F.lit(0).alias("rank"), F.col("s.place").alias("place"), F.lit(False).alias("fresh"))
    wanted = later.select(
        F.col("conv_id").alias("w_conv"), F.col("window").alias("w_window"),
        F.explode(F.transform(F.sequence(F.lit(1), F.lit(repeat)), lambda k: F.col("first") - k)).alias("w_place"),
    ).where("w_place >= 1")
    so_far = Window.partitionBy("w_conv", "w_window").orderBy(F.desc("place"))
    repeated = (
        wanted.join(body.where(~F.col("is_system")), F.col("conv_id").eqNullSafe(F.col("w_conv")) & (F.col("place") == F.col("w_place")))
        .withColumn("used", F.sum("tokens").over(so_far)).where(F.col("used") <= history)
        .select(F.col("w_conv").alias("conv_id"), F.col("w_window").alias("window"), "role", "text",
                F.lit(1).alias("rank"), "place", F.lit(False).alias("fresh"))
    )
    fresh = body.select("conv_id", "window", "role", "text", F.lit(2).alias("rank"), "place", F.lit(True).alias("fresh"))
    turn = F.struct(
        "rank", "place", "fresh", (F.col("fresh") & (F.col("role") == "assistant")).alias("loss"),
        F.concat(F.lit(TURN_START), escape_role(F.col("role")), F.lit(": ")).alias("head"), escape(F.col("text")).alias("body"),
    )
    rows = fresh.unionByName(later_system).unionByName(repeated).groupBy("conv_id", "window").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    end = F.lit(TURN_END + "\n")
    step = lambda acc, t: F.struct(
        (acc["at"] + F.length(t["head"]) + F.length(t["body"]) + len(TURN_END) + 1).alias("at"),
        F.concat(acc["spans"], F.array(F.struct(
            acc["at"].alias("head"), (acc["at"] + F.length(t["head"])).alias("start"),
            (acc["at"] + F.length(t["head"]) + F.length(t["body"])).alias("end"), t["fresh"].alias("fresh"), t["loss"].alias("loss"),
        ))).alias("spans"),
    )
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<head:int,start:int,end:int,fresh:boolean,loss:boolean>>").alias("spans"))
    return rows.select(
        "conv_id", "window", F.concat_ws("", F.transform("turns", lambda t: F.concat(t["head"], t["body"], end))).alias("formatted"),
        F.aggregate("turns", empty, step, lambda acc: acc["spans"]).alias("spans"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, digests and sizes, from the formatted windows alone."""
    cut = lambda a, b: F.substring("formatted", a + 1, b - a)
    role = lambda s: unescape(F.regexp_extract(cut(s["head"], s["start"]), r"(?s)^### (.*): $", 1))
    text = lambda s: unescape(cut(s["start"], s["end"]))
    fresh = F.filter("spans", lambda s: s["fresh"])
    trained = F.filter("spans", lambda s: s["loss"])
    part = formatted.select(
        "conv_id", "window", F.size(fresh).alias("n"), F.length("formatted").alias("chars"),
        F.concat_ws("", F.transform(fresh, lambda s: F.concat(role(s), F.lit("\n"), text(s), F.lit("\n")))).alias("said"),
        F.concat_ws("", F.transform(trained, text)).alias("loss"),
    )
    whole = part.groupBy("conv_id").agg(
        F.sum("n").cast("long").alias("n_turns"), F.sum("chars").cast("long").alias("formatted_chars"),
        F.array_sort(F.collect_list(F.struct("window", "said", "loss"))).alias("parts"),
    )
    joined = lambda c: F.concat_ws("", F.transform("parts", lambda p: p[c]))
    return whole.select(
        "conv_id", "n_turns", F.sha2(joined("said"), 256).alias("turns_sha256"), F.length(joined("loss")).cast("long").alias("loss_chars"),
        F.sha2(joined("loss"), 256).alias("loss_sha256"), "formatted_chars",
    )

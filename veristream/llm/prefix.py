"""Running totals over groups of any size.

Rows are dealt by range of (group, order), so that a group with a third of all rows spreads
over many tasks.  Every task totals its own rows; the totals of the tasks, a row per task and
group, are totalled in turn and added.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from veristream.llm.common import materialize, shuffle_partitions


def running(df: DataFrame, group: str | None, order: list[str], value: str, name: str = "running") -> DataFrame:
    """Adds the running total ``cum`` (this row included) and the position ``idx`` from 1.

    ``group`` and ``value`` are whole numbers without nulls.  ``order`` has to decide between
    any two rows that differ in something that matters.
    """
    spark = df.sparkSession
    group_of = F.col(group) if group else F.lit(0)
    keyed = df.withColumn("_g", group_of.cast("long"))
    schema = T.StructType([*keyed.schema, T.StructField("_pid", T.IntegerType()), T.StructField("cum", T.LongType()), T.StructField("idx", T.LongType())])
    arrow, columns = to_arrow_schema(schema), keyed.columns

    def run(batches):
        last, total, count, pid = None, 0, 0, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            g = batch.column("_g").to_numpy()
            v = batch.column(value).to_numpy().astype(np.int64)
            start = np.concatenate([[True], g[1:] != g[:-1]])
            start[0] = last is None or g[0] != last
            summed, ones = np.cumsum(v), np.arange(1, n + 1)
            at = np.maximum.accumulate(np.where(start, np.arange(n), -1))
            before_sum = np.where(at >= 0, summed[at] - v[at], -total)
            before_n = np.where(at >= 0, at, -count)
            cum, idx = summed - before_sum, ones - before_n
            last, total, count = g[-1], int(cum[-1]), int(idx[-1])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in columns], batch.column("_p"), pa.array(cum), pa.array(idx)], schema=arrow
            )

    dealt = keyed.repartitionByRange(shuffle_partitions(spark), "_g", *order).sortWithinPartitions("_g", *order)
    local = materialize(dealt.withColumn("_p", F.spark_partition_id()).mapInArrow(run, schema), name)
    before = Window.partitionBy("_g").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offset = local.groupBy("_g", "_pid").agg(F.max("cum").alias("t"), F.max("idx").alias("n")).select(
        "_g", "_pid", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("_t"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_n")
    ).where((F.col("_t") > 0) | (F.col("_n") > 0))
    return local.join(offset, ["_g", "_pid"], "left").select(
        *[F.col(f"`{c}`") for c in df.columns],
        (F.col("cum") + F.coalesce("_t", F.lit(0))).alias("cum"), (F.col("idx") + F.coalesce("_n", F.lit(0))).alias("idx"),
    )

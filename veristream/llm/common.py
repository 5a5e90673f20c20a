"""What the operators share: words, digests, bounded batches, the scratch folder."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from veristream.session import scratch_path

__all__ = ["WORD", "SPACE", "materialize", "table", "sha", "slices", "bites", "per_text", "shuffle_partitions", "words"]

#: A word is a run of anything but these.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
words = re.compile(WORD).findall

#: Characters of text that a task works on at a time.
CHARS = 2_000_000


def materialize(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder that the cluster names, and read back.

    Cuts the lineage so that lost executors cost no more than the tasks they ran.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(ids: list, texts: list, chars: int = CHARS) -> Iterator[tuple[list, list]]:
    """Runs of rows with at most ``chars`` characters in all; a longer text stands alone."""
    for a, b in _cuts([len(t) for t in texts], chars):
        yield ids[a:b], texts[a:b]


def _cuts(sizes: list[int], chars: int) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, n in enumerate(sizes):
        if i > start and size + n > chars:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(sizes):
        yield start, len(sizes)


def bites(batch: pa.RecordBatch, chars: int = CHARS) -> Iterator[tuple[list, list]]:
    """``slices`` of an Arrow batch of keys and texts (null: empty); the rest of it stays outside of Python's heap."""
    sizes = pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_pylist()
    for a, b in _cuts(sizes, chars):
        some = batch.slice(a, b - a)
        yield some.column(0).to_pylist(), [t or "" for t in some.column(1).to_pylist()]


def per_text(
    df: DataFrame, key: str, text: str, schema: str, work: Callable[[], Callable[[list, list], dict]],
    chars: int = CHARS,
) -> DataFrame:
    """Rows made from (key, text), text by text, in the tasks; no shuffle.

    ``work()`` is called once per task and gives a function from a list of keys
    and a list of texts (null: empty) to columns.  Only ``chars`` characters, or
    one text, are worked on at a time, whatever the size of Arrow's batches.
    """
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        step = work()
        for batch in batches:
            for some_keys, some in bites(batch, chars):
                columns = step(some_keys, some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], f.type) for f in out], schema=out
                )

    return df.select(F.col(key), F.col(text).cast("string")).mapInArrow(run, schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHash(dict):
    """64-bit hash of a word, remembered; forgets everything when it has grown to ``limit`` words."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: str | bytes) -> int:
        import xxhash

        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def runs(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` neighbours."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = mix64(hashes[:n] + np.uint64(width))
    for k in range(1, width):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n])
    return out

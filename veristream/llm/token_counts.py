"""Token counts of flat token files without an index.

A flat file is a row of token ids in which an end-of-document id closes every document.  It
is read as blocks that know nothing of documents.  In each block a vectorised search finds
the separators and gives the lengths of the pieces between them; a prefix scan over the
blocks' separator counts, in two levels, tells which document each piece belongs to, and the
pieces of a document are summed.

A file without separator is one open document; a last piece without separator counts as a
document when it has tokens.  Empty documents count, with 0 tokens.  Null or empty blocks
add nothing.  Blocks are told apart by (file, block); other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from veristream.llm.common import materialize, slices

#: Tokens in a block that is written here.
BLOCK = 1 << 18
#: Blocks of a file whose counts are added up together in the first level of the scan.
CHUNK = 1024


def scan_blocks(blocks: DataFrame, eod: int, dtype: str = "<u2") -> DataFrame:
    """file, block, and the lengths of the pieces between separators (one more than separators)."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):  # a block at a time; inside it, on arrays
                ids = np.frombuffer(batch.column(2)[i].as_py() or b"", dtype)
                edge = np.concatenate([[-1], np.flatnonzero(ids == eod), [len(ids)]])
                pieces = pa.array([np.diff(edge) - 1], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), pieces], names=["file", "block", "pieces"]
                )

    return blocks.select(F.col("file").cast("long"), F.col("block").cast("long"), "data").mapInArrow(
        run, "file long, block long, pieces array<long>"
    )


def count_tokens(blocks: DataFrame, eod: int, dtype: str = "<u2") -> DataFrame:
    """file, ordinal (from 0), n_tokens of every document in the files."""
    pieces = materialize(scan_blocks(blocks, eod, dtype), "pieces")
    seps = pieces.select(
        "file", "block", F.floor(F.col("block") / CHUNK).alias("chunk"), (F.size("pieces") - 1).cast("long").alias("n")
    )
    before = lambda *of: Window.partitionBy(*of).rowsBetween(Window.unboundedPreceding, -1)
    inside = seps.withColumn("inside", F.coalesce(F.sum("n").over(before("file", "chunk").orderBy("block")), F.lit(0)))
    chunks = seps.groupBy("file", "chunk").agg(F.sum("n").alias("n"))
    chunks = chunks.select(
        "file", "chunk", F.coalesce(F.sum("n").over(before("file").orderBy("chunk")), F.lit(0)).alias("outside")
    )
    first = inside.join(chunks, ["file", "chunk"]).select("file", "block", (F.col("inside") + F.col("outside")).alias("first"))
    parts = pieces.join(first, ["file", "block"]).select(
        "file", "first", (F.size("pieces") - 1).alias("last"), F.posexplode("pieces").alias("k", "n")
    )
    # A piece is closed when a separator of its block ends it.
    return (
        parts.groupBy("file", (F.col("first") + F.col("k")).alias("ordinal"))
        .agg(F.sum("n").alias("n_tokens"), F.max(F.col("k") < F.col("last")).alias("closed"))
        .where(F.col("closed") | (F.col("n_tokens") > 0)).select("file", "ordinal", "n_tokens")
    )


def read_ranks(path: str) -> dict[bytes, int]:
    import base64

    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


_ENCODERS: dict = {}


def write_flat(docs: DataFrame, ranks_path: str, pattern: str, eod: int, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Tokenised documents as flat files of 16-bit ids in blocks, one file per task, and which documents they hold.

    Returns (file, block, data) and (file, ordinal, doc_id).  The list of documents is kept apart;
    counting does not read it.  Null texts are empty documents.
    """
    context = docs.sparkSession.sparkContext
    ranks, name = context.broadcast(read_ranks(ranks_path)), f"{context.applicationId} {ranks_path}"
    kind = docs.schema["doc_id"].dataType.simpleString()
    id_type = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()

    def run(batches):
        if name not in _ENCODERS:
            import tiktoken

            _ENCODERS.clear()
            _ENCODERS[name] = tiktoken.Encoding("flat", pat_str=pattern, mergeable_ranks=ranks.value, special_tokens={})
        encode = _ENCODERS[name].encode_ordinary
        buffer, size, number, ordinal = [], 0, 0, 0

        def out(row, ids, first):
            return pa.RecordBatch.from_arrays(
                [pa.array([file]), pa.array([number if row is not None else None], pa.int64()), pa.array([row], pa.binary()),
                 pa.array([first], pa.int64()), pa.array([ids], pa.list_(id_type))],
                names=["file", "block", "data", "first", "ids"],
            )

        file = None
        for batch in batches:
            if not batch.num_rows:
                continue
            file = batch.column(2)[0].as_py()
            keys, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for some_keys, some in slices(keys, texts):
                for text in some:
                    ids = np.array([*encode(text), eod], "<u2")
                    buffer.append(ids)
                    size += len(ids)
                    while size >= block:
                        flat = np.concatenate(buffer)
                        yield out(flat[:block].tobytes(), None, None)
                        number += 1
                        buffer, size = [flat[block:]], size - block
                yield out(None, some_keys, ordinal)
                ordinal += len(some_keys)
        if size:
            yield out(np.concatenate(buffer).tobytes(), None, None)

    rows = docs.select("doc_id", "text", F.spark_partition_id().cast("long").alias("file")).mapInArrow(
        run, f"file long, block long, data binary, first long, ids array<{kind}>"
    )
    flat = materialize(rows, "flat", compression="zstd")
    order = flat.where(F.col("ids").isNotNull()).select("file", "first", F.posexplode("ids").alias("k", "doc_id"))
    return flat.where(F.col("data").isNotNull()).select("file", "block", "data"), order.select(
        "file", (F.col("first") + F.col("k")).alias("ordinal"), "doc_id"
    )


def count_documents(docs: DataFrame, ranks_path: str, pattern: str, eod: int = 50256, block: int = BLOCK) -> DataFrame:
    """doc_id and n_tokens (the separator not counted) of every document, by way of flat files."""
    blocks, order = write_flat(docs, ranks_path, pattern, eod, block)
    return order.join(count_tokens(blocks, eod), ["file", "ordinal"]).select("doc_id", "n_tokens")

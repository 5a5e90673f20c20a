"""CSV records with line breaks in quotes, from files that are read in blocks.

Spark deals a text file to tasks in blocks of bytes, cut at line ends.  Whether a line end also
ends a record hangs on whether a quoted field is open there, and so on all that went before.  A
line maps the state before it (in quotes or not) to the state after it; a block composes these
maps, and a scan over the blocks' maps, two flags for each block of a file, gives the state that
each block begins in.  With that, every task cuts its own blocks into records.  A record that
lies across blocks comes out in pieces, at most two a block, that are put together at the end.

The scan's rows come to the driver: some hundred bytes for each block, which is
``spark.sql.files.maxPartitionBytes`` of input.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

OPEN, MIDDLE, END, WHOLE = "open", "middle", "end", "whole"


def inside_after(line: str, inside: bool, sep: str = ",") -> bool:
    """Is a quoted field open at the end of the line, if it was (not) at its start?

    A quote opens a field only as its first character; two of them inside stand for one.
    """
    at = 0
    while True:
        if inside:
            at = line.find('"', at)
            while at >= 0 and line.startswith('"', at + 1):
                at = line.find('"', at + 2)
            if at < 0:
                return True
            inside = False
        else:
            while at < len(line) and line[at].isspace() and line[at] != sep:
                at += 1  # blanks before a quote are skipped
            if line.startswith('"', at):
                inside, at = True, at + 1
                continue
        at = line.find(sep, at)
        if at < 0:
            return False
        at += 1


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, start, value): lines with the block they begin in, blocks and lines in order within a task."""
    return spark.read.option("lineSep", "\n").text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value"
    )


def _blocks(batches) -> Iterator[tuple[str, int, Iterator[str]]]:
    """Consecutive lines of a block together; each block's lines have to be used up before the next."""
    def rows():
        for batch in batches:
            yield from zip(*(batch.column(k).to_pylist() for k in range(3)))

    source, ahead = rows(), [None]

    def following(key):
        while ahead[0] is not None and ahead[0][:2] == key:
            line = ahead[0][2]
            ahead[0] = next(source, None)
            yield line

    ahead[0] = next(source, None)
    while ahead[0] is not None:
        key = ahead[0][:2]
        block = following(key)
        yield *key, block
        for _ in block:
            pass


def _without_mark(line: str, first: bool) -> str:
    return line.removeprefix("\ufeff") if first else line


def _summaries(sep: str):
    def run(batches):
        for path, start, lines in _blocks(batches):
            state, header, done = [False, True], [], start > 0
            for k, line in enumerate(lines):
                line = _without_mark(line, not start and not k)
                if not done:
                    header.append(line)
                if '"' in line:
                    state = [inside_after(line, s, sep) for s in state]
                if not done and not state[0]:
                    if "\n".join(header).strip():
                        done = True
                    else:
                        header = []
            yield pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([start], pa.int64()), pa.array([state[0]]), pa.array([state[1]]), pa.array(["\n".join(header) if not start else None], pa.string())],
                names=["path", "start", "after_out", "after_in", "header"],
            )

    return run


def _cutter(inside_at: dict[str, dict[int, bool]], returns: set[str], sep: str):
    def run(batches):
        out: list[tuple[str, int, str, bool, str]] = []

        def flush():
            columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.string()))]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=["path", "start", "kind", "head", "value"])

        size = 0
        for path, start, lines in _blocks(batches):
            began = inside = inside_at[path][start]
            held: list[str] = []
            head = not start  # the first record of a file names the columns
            for k, line in enumerate(lines):
                line = _without_mark(line, not start and not k)
                held.append(line.removesuffix("\r") if path in returns else line)
                if '"' in line:
                    inside = inside_after(line, inside, sep)
                if inside:
                    continue
                text, held = "\n".join(held), []
                if began or text:
                    out.append((path, start, END if began else WHOLE, head, text))
                    size += len(text)
                    head = False
                began = False
                if size > 4_000_000 or len(out) >= 10_000:
                    yield flush()
                    size = 0
            if held:
                out.append((path, start, MIDDLE if began else OPEN, head, "\n".join(held)))
        if out:
            yield flush()

    return run


def _scan(summaries: list) -> dict[str, dict[int, bool]]:
    """The state each block begins in."""
    out: dict[str, dict[int, bool]] = {}
    inside, last = False, None
    for row in sorted(summaries, key=lambda r: (r["path"], r["start"])):
        if row["path"] != last:
            inside, last = False, row["path"]
        out.setdefault(row["path"], {})[row["start"]] = inside
        inside = row["after_in"] if inside else row["after_out"]
    return out


def read_records(spark: SparkSession, paths: Sequence[str] | str, sep: str = ",") -> tuple[dict[str, str], DataFrame]:
    """The header record of each file, and (path, value) for every other record."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = _lines(spark, paths)
    summaries = lines.mapInArrow(_summaries(sep), "path string, start long, after_out boolean, after_in boolean, header string").collect()
    headers = {r["path"]: r["header"] for r in summaries if r["start"] == 0}
    # A file whose header ends in carriage return and line feed has that line end throughout.
    returns = {path for path, header in headers.items() if header.endswith("\r")}
    return {p: h.replace("\r\n", "\n").removesuffix("\r") if p in returns else h for p, h in headers.items()}, cut(lines, _scan(summaries), returns, sep)


def cut(lines: DataFrame, inside_at: dict[str, dict[int, bool]], returns: set[str], sep: str = ",") -> DataFrame:
    """(path, value): records but the files' first, of lines whose blocks begin as told."""
    pieces = lines.mapInArrow(_cutter(inside_at, returns, sep), "path string, start long, kind string, head boolean, value string")
    whole = pieces.filter((F.col("kind") == WHOLE) & ~F.col("head")).select("path", "value")
    # An open piece starts a record, and what follows in the file up to its end belongs to it.
    split = pieces.filter(F.col("kind") != WHOLE).withColumn("_place", F.when(F.col("kind") == END, 0).otherwise(1))
    opened = Window.partitionBy("path").orderBy("start", "_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = split.withColumn("_record", F.count_if(F.col("kind") == OPEN).over(opened))
    joined = numbered.groupBy("path", "_record").agg(
        F.array_sort(F.collect_list(F.struct("start", "_place", "value"))).alias("_parts"), F.max("head").alias("_head")
    ).filter(~F.col("_head")).select("path", F.array_join(F.transform("_parts", lambda p: p["value"]), "\n").alias("value"))
    return whole.unionByName(joined)

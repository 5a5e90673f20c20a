"""Near copies among embeddings: spherical k-means cells, blocked cosine products inside them.

Equal vectors are put together first.  Centroids are fitted on a bounded sample; every vector
is then put in the cell of its nearest centroid, and is, as a visitor, compared in each cell of smaller
number whose border is within ``margin`` (distance to the plane between the two centroids).
Two vectors with the given cosine are at most sqrt(2 - 2 cos) apart, so the default margin of that size
(0.447 for 0.9) loses nothing.  Vectors of many dimensions then visit most cells, so cells are
coarse.  No vector is sent to the cells it visits: vectors are written once, in the order of their cells and
in blocks, and blocks meet in a Cartesian product, whose tasks read both sides' files.  Two blocks meet if
one has vectors that live in or visit a cell of the other, and only those are multiplied.  So disk grows with the
vectors; pairs compared grow with their square where cells prune nothing.

A product is first taken over the few directions that hold most of the vectors, in single precision, with
the norms of what they leave out: no cosine is above that.  Pairs that can reach the cosine are computed in full and
in double precision.  Components are formed over the links; one vector of each stays.

Vectors that are null, all zero, or hold a null or a number that isn't finite have no links.
Vectors of different length aren't compared.  Repeated rows are rows of their own, and so are rows
that share a vec_id with unlike vectors: each has its own vector's links and component.  A null id
has a null component.  Other columns are not read.  The input is read twice.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, FloatType

from veristream.llm.common import materialize
from veristream.llm.graph import components

COSINE = 0.9
#: Vectors that the centroids are fitted on, at most.
SAMPLE = 20_000
#: Cells at most; their centroids are sent to every task.
CELLS = 8192
#: Vectors in a cell, about.
CELL = 4096
#: Vectors in a block, and their bytes, at most.
BLOCK, BLOCK_BYTES = 16_384, 4_000_000
#: Vectors of either side that are multiplied at a time.
TILE = 1024
#: Bytes of vectors that a task reads of either side, about.
SIDE_BYTES = 16_000_000
#: Blocks that a task keeps ready.
READY = 8
#: Vectors of more dimensions are not turned.
TURNED = 2048
#: Links that a pair of blocks holds before they are folded to trees.
FOLD = 1_000_000


def _keyed(vectors: DataFrame) -> DataFrame:
    """vec_id, the vector's numbers as bytes and a digest that only depends on its direction (both null where it has none)."""
    kind = vectors.schema["embedding"].dataType
    single = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            offset, valid = lists.offsets.to_numpy(), lists.is_valid().to_numpy(zero_copy_only=False)
            values = lists.values.to_numpy(zero_copy_only=False)  # a null becomes NaN
            size = np.where(valid, np.diff(offset), 0)
            keys, raws = [None] * len(size), [None] * len(size)
            for d in np.unique(size[size > 0]):
                rows = np.flatnonzero(size == d)
                for some in np.array_split(rows, max(1, len(rows) * int(d) // 500_000)):
                    raw = values[offset[some][:, None] + np.arange(d)]
                    x = raw.astype(np.float64)
                    top = np.abs(x).max(1)
                    for k in np.flatnonzero(np.isfinite(x).all(1) & (top > 0)):
                        keys[some[k]], raws[some[k]] = hashlib.md5((x[k] / top[k] + 0.0).tobytes(), usedforsecurity=False).digest(), raw[k].tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(raws, pa.binary())], names=["vec_id", "key", "raw"])

    given = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<float>" if single else "array<double>"))
    return given.mapInArrow(run, "vec_id long, key binary, raw binary"), (4 if single else 8)


def _units(raw: bytes, d: int, width: int) -> np.ndarray:
    """Unit vectors, in double precision."""
    x = np.frombuffer(raw, np.float32 if width == 4 else np.float64).reshape(-1, d).astype(np.float64)
    x /= np.abs(x).max(1)[:, None]
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def safe_margin(cosine: float) -> float:
    """Distance of two unit vectors with the cosine, and a little for rounding."""
    return float(np.sqrt(max(2 - 2 * cosine, 0.0))) + 1e-6


def fit_cells(x: np.ndarray, cells: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means: unit centroids of unit vectors, from a fixed start."""
    centroids = x[np.random.default_rng(7).permutation(len(x))[:cells]].copy()
    for _ in range(rounds):
        cell = (x @ centroids.T).argmax(1)
        total = np.zeros_like(centroids)
        np.add.at(total, cell, x)
        size = np.linalg.norm(total, axis=1)
        centroids = np.where(size[:, None] > 1e-12, total / np.maximum(size, 1e-12)[:, None], centroids)
    return centroids


def fit_turn(x: np.ndarray, cosine: float) -> tuple[np.ndarray | None, int]:
    """A rotation that puts the directions that hold most first, and how many of them to multiply before all."""
    d = x.shape[1]
    if d > TURNED:
        return None, d
    turn = np.linalg.eigh(x.T @ x)[1][:, ::-1].copy()
    some = x[:512] @ turn
    pairs = np.triu_indices(len(some), 1)
    best, lead = float(d), d
    for k in range(0, d, max(1, d // 16)):
        rest = np.sqrt((some[:, k:] ** 2).sum(1))
        bound = (some[:, :k] @ some[:, :k].T + rest[:, None] * rest)[pairs]
        cost = k + 1 + 15_000 * float((bound >= cosine).mean()) if len(bound) else d  # a pair computed by itself costs as thousands of products
        if cost < best:
            best, lead = cost, k
    return turn, lead


def _lead(x: np.ndarray, turn: np.ndarray | None, lead: int) -> np.ndarray:
    """The leading directions and the norm of the rest: products of these are at least the cosines."""
    if lead == x.shape[1]:
        return x.astype(np.float32)
    y = x @ turn
    return np.concatenate([y[:, :lead], np.sqrt((y[:, lead:] ** 2).sum(1))[:, None]], 1).astype(np.float32)


def _gap(centroids: np.ndarray, cell: int) -> np.ndarray:
    # Rounding spoils the gaps of centroids that nearly coincide; a wider gap makes borders nearer, which loses nothing.
    return np.sqrt(np.maximum(2 - 2 * centroids @ centroids[cell], 1e-8))


def _place(heads: DataFrame, shared, width: int) -> DataFrame:
    """(dim, cell, rep, least, copies, raw): every vector in the cell of its nearest centroid."""

    def run(batches):
        cells = shared.value
        for batch in batches:
            raws = batch.column("raw").to_pylist()
            size = np.array([len(r) // width for r in raws], np.int64)
            home = np.empty(len(raws), np.int32)
            for d in np.unique(size):
                rows = np.flatnonzero(size == d)
                for some in np.array_split(rows, max(1, len(rows) // 2048)):
                    home[some] = (_units(b"".join([raws[i] for i in some]), int(d), width) @ cells[int(d)][0].T).argmax(1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(size.astype(np.int32)), pa.array(home), *(batch.column(c) for c in ("rep", "least", "copies", "raw"))],
                names=["dim", "cell", "rep", "least", "copies", "raw"],
            )

    return heads.select("rep", "least", "copies", "raw").mapInArrow(run, "dim int, cell int, rep long, least long, copies long, raw binary")


def _rows(d: int, width: int) -> int:
    return int(min(BLOCK, max(1, BLOCK_BYTES // (d * width))))


def _pack(placed: DataFrame, shared, margin: float, width: int) -> DataFrame:
    """Blocks of vectors that stand together: their cells, and these and the cells of smaller number that any of them visits."""

    def block(table: pa.Table) -> pa.RecordBatch:
        d, cell = table.column("dim")[0].as_py(), table.column("cell").to_numpy()
        raw, c = b"".join(table.column("raw").to_pylist()), shared.value[d][0]
        own, seen = np.unique(cell), np.zeros(len(c), bool)
        seen[own] = True
        gap = {int(h): _gap(c, h) for h in own}
        x = _units(raw, d, width)
        for h in own:
            some = x[cell == h]
            for part in np.array_split(some, max(1, len(some) // TILE)):
                near = part @ c[: h + 1].T
                seen[: h + 1] |= ((near[:, h : h + 1] - near) / gap[int(h)][: h + 1] <= margin).any(0)
        return pa.RecordBatch.from_arrays(
            [pa.array([d], pa.int32()), pa.array([own.tolist()], pa.list_(pa.int32())), pa.array([np.flatnonzero(seen).tolist()], pa.list_(pa.int32())),
             pa.array([cell.tobytes()], pa.binary()), *(pa.array([table.column(n).to_numpy().tobytes()], pa.binary()) for n in ("rep", "least", "copies")),
             pa.array([raw], pa.binary())],
            names=["dim", "cells", "visits", "cell", "rep", "least", "copies", "raw"],
        )

    def run(batches):
        held, n, dim = [], 0, None
        for batch in batches:
            size = batch.column("dim").to_numpy()
            at = 0
            while at < len(size):
                if held and dim != size[at]:
                    yield block(pa.Table.from_batches(held))
                    held, n = [], 0
                dim = size[at]
                same = len(size) if size[-1] == dim else at + int(np.argmax(size[at:] != dim))
                take = min(same - at, _rows(int(dim), width) - n)
                held.append(batch.slice(at, take))
                at, n = at + take, n + take
                if n == _rows(int(dim), width):
                    yield block(pa.Table.from_batches(held))
                    held, n = [], 0
        if held:
            yield block(pa.Table.from_batches(held))

    return placed.mapInArrow(
        run, "dim int, cells array<int>, visits array<int>, cell binary, rep binary, least binary, copies binary, raw binary"
    )


def _near(one: np.ndarray, two: np.ndarray, xa: np.ndarray, xb: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs with the cosine; ``one`` and ``two`` are what ``_lead`` makes of ``xa`` and ``xb``."""
    low = cosine - (one.shape[1] + 8) * 2.0**-23  # single precision is off by less
    can = (one @ two.T >= np.float32(low)).ravel()
    if np.count_nonzero(can) * 32 > len(can):
        return np.nonzero(xa @ xb.T >= cosine)
    whole = len(can) // 8 * 8  # hits are rare: found eight places at a time
    some = (np.flatnonzero(can[:whole].view(np.uint64))[:, None] * 8 + np.arange(8)).ravel()
    hit = np.concatenate([some[can[some]], whole + np.flatnonzero(can[whole:])])
    i, j = np.divmod(hit, len(xb))
    full = [np.einsum("ij,ij->i", xa[i[k : k + 4096]], xb[j[k : k + 4096]]) >= cosine for k in range(0, len(i), 4096)]
    ok = np.concatenate(full) if full else np.zeros(0, bool)
    return i[ok], j[ok]


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least number that each of ``n`` is linked to."""
    root = np.arange(n)
    while True:
        before, low = root, np.minimum(root[i], root[j])
        root = root.copy()
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if (root == before).all():
            return root


class _Block:
    """A block with its unit vectors."""

    def __init__(self, columns: dict, cells: dict, width: int):
        d = columns["dim"]
        self.centroids, turn, lead = cells[d]
        self.cell = np.frombuffer(columns["cell"], np.int32)
        self.rep, self.least, self.copies = (np.frombuffer(columns[c], np.int64) for c in ("rep", "least", "copies"))
        self.x = _units(columns["raw"], d, width)
        self.own = np.einsum("ij,ij->i", self.x, self.centroids[self.cell])
        self.lead = _lead(self.x, turn, lead)

    def compared_in(self, cell: int, margin: float) -> np.ndarray:
        """Places of the vectors that live in the cell, or in one of larger number and visit it."""
        border = (self.own - self.x @ self.centroids[cell]) / _gap(self.centroids, cell)[self.cell]
        return np.flatnonzero((self.cell == cell) | (self.cell > cell) & (border <= margin))


def _meet(a: _Block, b: _Block, cosine: float, margin: float) -> tuple:
    """Links of a block with one that stands behind it, or with itself: rep, least, gain and root of every linked vector."""
    shift = 0 if a is b else len(a.rep)
    rep, least, copies = (getattr(a, c) if a is b else np.concatenate([getattr(a, c), getattr(b, c)]) for c in ("rep", "least", "copies"))
    gain, held, n = np.zeros(len(rep), np.int64), [], 0
    starts = np.flatnonzero(np.diff(a.cell, prepend=-1))
    for start, end in zip(starts, [*starts[1:], len(a.cell)]):
        there = b.compared_in(a.cell[start], margin)
        if a is b:
            there = there[there >= start]
        lead, x = b.lead[there], b.x[there]
        for s in range(start, end, TILE):
            e = min(s + TILE, end)
            for t in range(0, len(there), TILE):
                i, j = _near(a.lead[s:e], lead[t : t + TILE], a.x[s:e], x[t : t + TILE], cosine)
                if not len(i):
                    continue
                i, j = i + s, there[t + j] + shift
                if a is b:  # each pair once
                    i, j = i[i < j], j[i < j]
                np.add.at(gain, i, copies[j])
                np.add.at(gain, j, copies[i])
                held.append((i, j))
                n += len(i)
                if n > FOLD:
                    root = _roots(len(rep), *map(np.concatenate, zip(*held)))
                    some = np.flatnonzero(root != np.arange(len(root)))
                    held, n = [(some, root[some])], 0
    if not held:
        return (rep[:0], least[:0], gain[:0], rep[:0])
    root, some = _roots(len(rep), *map(np.concatenate, zip(*held))), gain > 0
    return rep[some], least[some], gain[some], rep[root][some]


def _links(blocks: DataFrame, shared, cosine: float, margin: float, width: int, tasks: int) -> DataFrame:
    """(rep, least, gain, root): what each vector gains where two blocks meet, and a star for each group linked there."""
    parts = ["at", "dim", "cell", "rep", "least", "copies", "raw"]
    one, two = (blocks.coalesce(tasks).select(*[F.col(c).alias(side + c) for c in [*parts, of]]) for side, of in (("a_", "cells"), ("b_", "visits")))
    met = one.hint("shuffle_replicate_nl").join(
        two, (F.col("a_dim") == F.col("b_dim")) & (F.col("a_at") <= F.col("b_at")) & F.arrays_overlap("a_cells", "b_visits")
    )

    def run(batches):
        ready = {}

        def get(batch, k, side, keep):
            at = batch.column(f"{side}at")[k].as_py()
            if (found := ready.get(at)) is None:
                found = _Block({c: batch.column(side + c)[k].as_py() for c in parts}, shared.value, width)
                if len(ready) < keep:
                    ready[at] = found
            return at, found

        left = (None, None)
        for batch in batches:
            for k in range(batch.num_rows):
                if left[0] != batch.column("a_at")[k].as_py():
                    left = get(batch, k, "a_", 0)
                right = left if left[0] == batch.column("b_at")[k].as_py() else get(batch, k, "b_", READY)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in _meet(left[1], right[1], cosine, margin)], names=["rep", "least", "gain", "root"])

    return met.select(*[side + c for side in ("a_", "b_") for c in parts]).mapInArrow(run, "rep long, least long, gain long, root long")


def groups(
    vectors: DataFrame, cosine: float = COSINE, margin: float | None = None, sample: int = SAMPLE, cell: int = CELL
) -> DataFrame:
    """vec_id, n_links, component_id, kept for every vector; a ``margin`` below the default one can lose links."""
    margin = safe_margin(cosine) if margin is None else margin
    context = vectors.sparkSession.sparkContext
    keyed, width = _keyed(vectors)
    heads = materialize(
        keyed.where(F.col("key").isNotNull() & F.col("vec_id").isNotNull()).groupBy("key")
        .agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("raw").alias("raw"))
        .withColumn("rep", F.monotonically_increasing_id()), "heads",  # a number: two vectors may share an id
    )
    sizes = {r["d"]: r["n"] for r in heads.groupBy((F.length("raw") / width).cast("int").alias("d")).agg(F.count("*").alias("n")).collect()}
    chosen = heads.orderBy("key").limit(sample).select("raw").collect() if sizes else []
    cells = {}
    for d, n in sizes.items():
        x = _units(b"".join([r["raw"] for r in chosen if len(r["raw"]) == width * d]), d, width)
        x = x if len(x) else np.eye(1, d)
        cells[d] = (fit_cells(x, int(min(CELLS, len(x) / 8 + 1, np.ceil(n / cell)))), *fit_turn(x, cosine))
    shared = context.broadcast(cells)
    made = sum(-(-n // max(1, _rows(d, width) * 3 // 4)) for d, n in sizes.items())
    tasks = max(int(4 * context.defaultParallelism**0.5), sum(n * d * width for d, n in sizes.items()) // SIDE_BYTES)
    order = ["dim", "cell", "rep"]
    blocks = materialize(
        _pack(_place(heads, shared, width).repartitionByRange(max(1, made), *order).sortWithinPartitions(*order), shared, margin, width)
        .withColumn("at", F.monotonically_increasing_id()), "blocks",  # numbers in that order
    )
    links = materialize(_links(blocks, shared, cosine, margin, width, tasks), "links")
    label = components(links.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    linked = links.groupBy("rep").agg(F.sum("gain").alias("gain"), F.min("least").alias("least")).join(label, F.col("rep") == F.col("id"))
    smallest = linked.groupBy("component").agg(F.min("least").alias("c"))
    linked = linked.join(smallest, "component").select("rep", "gain", "c")
    node = heads.select("key", "rep", "least", "copies").join(linked, "rep", "left").select(
        "key", (F.col("copies") - 1 + F.coalesce("gain", F.lit(0))).alias("n"), F.coalesce("c", "least").alias("c")
    )
    out = keyed.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("key")).alias("key")).join(node, "key", "left")
    return out.select(
        "vec_id", F.coalesce("n", F.lit(0)).alias("n_links"), F.coalesce("c", "vec_id").alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))

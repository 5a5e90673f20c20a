"""How far apart the sources of a language are, and by which terms.

The matrix of groups (sources of a language) and kept terms is cut into column blocks by a hash
of the term and into row strips by a hash of the source; a task holds one block of one or two
strips.  There it is a quadtree over K x K quadrants, kept as one bitmap per level.  A pair of
groups is priced by walking the trees of both down together: where both quadrants are all zero,
the price of a term that neither has, times the width, is all there is to add; single rows with a
count are priced column by column.  Columns with the same pattern of groups lie side by side, so
zero quadrants are large.  The walk takes all pairs of rows of a level at once.

Everything is whole-number arithmetic.  Counts are added up in the tasks before they are
shuffled; a term of every document is one row for each task and group.

Nulls in text, lang and source count as empty strings.  A document is a row: repeated rows count
each, whatever their ids; no other column is read.  Texts of any length are cut between terms and
read whole.  Without documents there are no rows; a language without kept terms has pairs of value 0.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from veristream.llm.common import materialize

SCALE = 1_000_000_000
#: Documents of the language that a kept term is in, at least.
LEAST = 3
#: Terms listed for a group, at most.
TOP = 200
#: Sources in a strip and terms in a block, about.
STRIP, BLOCK = 48, 3600
#: Side of a quadrant's division.
K = 4
#: Bytes of text looked at together; distinct terms that a task adds up before it passes them on.
PIECE, HELD = 4_000_000, 400_000
#: Node pairs expanded together.
PAIRS = 200_000

_term = re.compile(rb"[a-z\x80-\xff]+")
_gap = re.compile(rb"[^a-z\x80-\xff]")


def _pieces(data: bytes):
    """The text in pieces that cut no term."""
    start = 0
    while start < len(data):
        stop = start + PIECE
        if stop < len(data):
            gap = _gap.search(data, stop)
            stop = gap.start() if gap else len(data)
        yield data[start:stop]
        start = stop


def counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): rows to be added up, from the tasks."""
    schema = to_arrow_schema(StructType.fromDDL("lang string, source string, term string, n long, docs long"))

    def run(batches):
        held: dict[tuple, tuple[Counter, Counter]] = {}
        fresh = 0

        def flush():
            for (lang, source), (n, docs_of) in held.items():
                terms = list(n)
                for a in range(0, len(terms), 50_000):
                    some = terms[a : a + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(lang, len(some)), pa.repeat(source, len(some)), pa.array(some, pa.binary()).cast(pa.string()),
                         pa.array([n[t] for t in some], pa.int64()), pa.array([docs_of[t] for t in some], pa.int64())], schema=schema,
                    )
            held.clear()

        for batch in batches:
            for text, lang, source in zip(*(batch.column(k).to_pylist() for k in range(3))):
                n, docs_of = held.setdefault((lang, source), (Counter(), Counter()))
                before, seen = len(n), set()
                for piece in _pieces((text or b"").lower()):  # of bytes: A-Z alone
                    terms = _term.findall(piece)
                    n.update(terms)
                    seen.update(terms)
                docs_of.update(seen)
                fresh += len(n) - before
                if fresh > HELD:
                    yield from flush()
                    fresh = 0
        yield from flush()

    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    return docs.select(F.col("text").cast("binary"), empty("lang"), empty("source")).mapInArrow(
        run, "lang string, source string, term string, n long, docs long"
    )


def share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 * (count + 1) / total), by long division, so that nothing overflows."""
    rest, out = count + 1, np.zeros(np.broadcast(count, total).shape, np.int64)
    out += rest // total
    rest = rest % total
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest = rest % total
    return out + 1


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _depth(n: int) -> int:
    """Divisions by K that bring ``n`` down to one."""
    k = 0
    while K**k < n:
        k += 1
    return k


class Tree:
    """Quadrants of a matrix that hold a count, level by level: the whole, its K x K quadrants, and
    so on; a side that has come down to single rows or columns is divided no further."""

    def __init__(self, held: np.ndarray, depth: int):
        deep = [_depth(n) for n in held.shape]
        side = lambda k: tuple(K ** min(k, d) for d in deep)
        full = np.zeros(side(depth), bool)
        full[: held.shape[0], : held.shape[1]] = held
        self.levels = [full]
        for k in range(depth - 1, -1, -1):
            r, c = side(k)
            full = full.reshape(r, full.shape[0] // r, c, full.shape[1] // c).any((1, 3))
            self.levels.insert(0, full)


def walk(one: Tree, two: Tree, sizes: tuple[int, int], width: int, same: bool, leaf) -> np.ndarray:
    """Columns that both rows of a pair have all zero, for each pair; ``leaf(a, b, c)`` gets the rest.

    ``a`` and ``b`` are rows, ``c`` columns.  With ``same`` only pairs a < b.
    """
    depth = len(one.levels) - 1
    zero = [np.zeros((one.levels[k].shape[0], two.levels[k].shape[0]), np.int64) for k in range(depth + 1)]

    def visit(k: int, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> None:
        held = one.levels[k][a, c] | two.levels[k][b, c]
        span = one.levels[-1].shape[1] // one.levels[k].shape[1]
        bare = ~held
        np.add.at(zero[k].reshape(-1), a[bare] * zero[k].shape[1] + b[bare], np.clip(width - c[bare] * span, 0, span))
        a, b, c = a[held], b[held], c[held]
        if k == depth:
            some = a < b if same else slice(None)
            leaf(a[some], b[some], c[some])
            return
        ra, rb = (t.levels[k + 1].shape[0] // t.levels[k].shape[0] for t in (one, two))
        rc = one.levels[k + 1].shape[1] // one.levels[k].shape[1]
        ia, ib, ic = (x.ravel() for x in np.meshgrid(np.arange(ra), np.arange(rb), np.arange(rc), indexing="ij"))
        step = max(1, PAIRS // len(ia))
        la, lb = (one.levels[-1].shape[0] // one.levels[k + 1].shape[0], two.levels[-1].shape[0] // two.levels[k + 1].shape[0])
        for at in range(0, len(a), step):
            na, nb, nc = ((x[at : at + step, None] * r + i).ravel() for x, r, i in ((a, ra, ia), (b, rb, ib), (c, rc, ic)))
            some = (na * la < sizes[0]) & (nb * lb < sizes[1]) & (nc * (span // rc) < width)
            if same:
                some &= na <= nb if la > 1 or lb > 1 else na < nb
            visit(k + 1, na[some], nb[some], nc[some])

    root = np.zeros(1, np.int64)
    visit(0, root, root, root)
    out = np.zeros(sizes, np.int64)
    for z in zero:
        ra, rb = one.levels[-1].shape[0] // z.shape[0], two.levels[-1].shape[0] // z.shape[1]
        out += np.repeat(np.repeat(z, ra, 0), rb, 1)[: sizes[0], : sizes[1]]
    return out


_OUT = "lang string, source string, item string, value long, part string, columns long, bare long"
_OUT_ARROW = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64()), ("part", pa.string()),
                        ("columns", pa.int64()), ("bare", pa.int64())])


def _block(table: pa.Table) -> pa.Table:
    """Pair prices of a block, both ways, and the leading terms of its groups."""
    schema = _OUT_ARROW
    lang, a, b = (table.column(c)[0].as_py() for c in ("lang", "a", "b"))
    head = table.filter(pc.is_null(table.column("term")))
    cells = table.filter(pc.is_valid(table.column("term")))
    kept, lang_total = head.column("kept")[0].as_py(), head.column("lang_total")[0].as_py()
    names, totals = [], []
    for k in sorted({a, b}):
        of = pc.equal(head.column("strip"), k)
        part = head.filter(of).sort_by("source")
        names.append(part.column("source").combine_chunks())
        totals.append(np.maximum(part.column("n").to_numpy() + kept, 1))  # without kept terms nothing is priced
    words = cells.column("term").combine_chunks().dictionary_encode()
    column, width = words.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(words.dictionary)
    strip, n = cells.column("strip").to_numpy(), cells.column("n").to_numpy()
    row = np.zeros(len(n), np.int64)
    for k, some in zip(sorted({a, b}), names):
        of = strip == k
        row[of] = pc.index_in(cells.column("source").filter(pa.array(of)), value_set=some).to_numpy()
    matrices = []
    for k, some in zip(sorted({a, b}), names):
        m = np.zeros((len(some), width), np.int64)
        of = strip == k
        m[row[of], column[of]] = n[of]
        matrices.append(m)
    pattern = np.packbits(np.concatenate([m > 0 for m in matrices]), axis=0)
    order = np.lexsort(pattern) if width else np.empty(0, np.int64)
    matrices = [m[:, order] for m in matrices]
    first, last = matrices[0], matrices[-1]
    p = [share(m, t[:, None]) for m, t in zip(matrices, totals)]
    bare = [share(np.zeros(1, np.int64), t) for t in totals]
    sizes = (len(first), len(last))
    there, back = np.zeros(sizes, np.int64), np.zeros(sizes, np.int64)

    def leaf(i, j, c):
        x, y = p[0][i, c], p[-1][j, c]
        pair, square = i * sizes[1] + j, (x - y) * (x - y)
        np.add.at(there.reshape(-1), pair, square // y)
        np.add.at(back.reshape(-1), pair, square // x)

    depth = max(_depth(n) for m in matrices for n in m.shape)
    trees = [Tree(m > 0, depth) for m in matrices]
    zero = walk(trees[0], trees[-1], sizes, width, a == b, leaf)
    bare_there, bare_back = price(bare[0][:, None], bare[-1][None, :]), price(bare[-1][None, :], bare[0][:, None])
    there += zero * bare_there
    back += zero * bare_back
    i, j = np.triu_indices(sizes[0], 1) if a == b else (x.ravel() for x in np.indices(sizes))
    one, two = names[0].take(pa.array(i)), names[-1].take(pa.array(j))
    out = [
        pa.Table.from_arrays(
            [pa.repeat(lang, len(i)), s, t, pa.array(v[i, j]), pa.repeat("pair", len(i)), pa.repeat(width, len(i)), pa.array(w[i, j])], schema=schema
        )
        for s, t, v, w in ((one, two, there, bare_there), (two, one, back, bare_back))
    ]
    if a == b and width:
        of_lang = np.zeros(width, np.int64)
        of_lang[column] = cells.column("total").to_numpy()
        q = share(of_lang[order], np.int64(lang_total + kept))
        text = words.dictionary.take(pa.array(order))
        for k, group in enumerate(first):
            at = np.flatnonzero((group > 0) & (p[0][k] > q))
            if not len(at):
                continue
            value = price(p[0][k][at], q[at])
            if len(at) > TOP:  # whatever ties with the last one stays
                enough = np.partition(value, len(value) - TOP)[-TOP]
                at, value = at[value >= enough], value[value >= enough]
            out.append(pa.Table.from_arrays(
                [pa.repeat(lang, len(at)), pa.repeat(names[0][k].as_py(), len(at)), text.take(pa.array(at)), pa.array(value),
                 pa.repeat("term", len(at)), pa.repeat(0, len(at)), pa.repeat(0, len(at))], schema=schema,
            ))
    return pa.concat_tables(out)


def matrix(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, total, first): counts of kept terms; ``total`` is that of the language,
    ``first`` marks one row of each term."""
    term = Window.partitionBy("lang", "term")
    added = counts(docs).repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return (
        added.withColumn("total", F.sum("n").over(term)).withColumn("in", F.sum("docs").over(term))
        .withColumn("first", F.min("source").over(term) == F.col("source"))
        .where(F.col("in") >= LEAST).select("lang", "source", "term", "n", "total", "first")
    )


def audit(docs: DataFrame, strip: int = STRIP, block: int = BLOCK) -> DataFrame:
    """lang, source, part, item, value, rank: pairs of sources, and the leading terms of each."""
    cells = materialize(matrix(docs), "matrix")
    langs = cells.groupBy("lang").agg(F.sum(F.col("first").cast("long")).alias("kept"), F.sum("n").alias("lang_total"))
    groups = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    sizes = materialize(groups.groupBy("lang").agg(F.ceil(F.count("*") / strip).alias("strips")).join(langs, "lang", "left").select(
        "lang", "strips", F.coalesce("kept", F.lit(0)).alias("kept"), F.coalesce("lang_total", F.lit(0)).alias("lang_total"),
        F.greatest(F.ceil(F.coalesce("kept", F.lit(0)) / block), F.lit(1)).alias("blocks"),
    ), "sizes")
    strip_of, block_of = F.pmod(F.xxhash64("source"), "strips").cast("int"), F.pmod(F.xxhash64("term"), "blocks").cast("int")
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    heads = groups.join(totals, ["lang", "source"], "left").join(sizes, "lang").select(
        "lang", "source", F.coalesce("n", F.lit(0)).alias("n"), "strips", "blocks", "kept", "lang_total", strip_of.alias("strip"),
        F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("total"), F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)).alias("block"),
    )
    given = cells.join(sizes, "lang").select(
        "lang", "source", "n", "strips", "blocks", "kept", "lang_total", strip_of.alias("strip"), "term", "total", block_of.alias("block")
    )
    dealt = heads.unionByName(given).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("strips").cast("int") - 1))).select(
        "lang", F.least("strip", "other").alias("a"), F.greatest("strip", "other").alias("b"), "block", "strip", "source", "n", "term", "total", "kept", "lang_total"
    )
    parts = dealt.groupBy("lang", "a", "b", "block").applyInArrow(_whole, _OUT)
    parts = materialize(parts, "prices")
    pairs = parts.where("part = 'pair'").groupBy("lang", "source", "item").agg(
        F.sum("value").alias("value"), F.sum("columns").alias("columns"), F.max("bare").alias("bare")
    ).join(sizes.select("lang", "kept"), "lang").select(
        "lang", "source", F.lit("pair").alias("part"), "item", (F.col("value") + (F.col("kept") - F.col("columns")) * F.col("bare")).alias("value")
    )
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    terms = parts.where("part = 'term'").select("lang", "source", "part", "item", "value", place).where(F.col("rank") <= TOP)
    return pairs.select("*", place).unionByName(terms)


def _whole(table: pa.Table) -> pa.Table:
    """A strip pair in which one strip has no sources (its hash met none) has no pairs."""
    head = table.filter(pc.is_null(table.column("term")))
    strips = set(head.column("strip").to_pylist())
    if {table.column("a")[0].as_py(), table.column("b")[0].as_py()} - strips:
        return _OUT_ARROW.empty_table()
    return _block(table)


SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), found AS (
  SELECT i, lang, source,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS total FROM found GROUP BY lang, term HAVING count(DISTINCT i) >= 3
), cells AS (
  SELECT lang, source, term, count(*) AS n FROM found JOIN kept USING (lang, term) GROUP BY lang, source, term
), grp AS (
  SELECT lang, source, coalesce(sum(n), 0) AS n FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN cells USING (lang, source) GROUP BY lang, source
), sums AS (
  SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang
), p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.n + s.v)::HUGEINT AS p,
    1 + (1000000000::HUGEINT * (k.total + 1)) // (s.n + s.v)::HUGEINT AS q
  FROM grp g JOIN sums s USING (lang) JOIN kept k USING (lang) LEFT JOIN cells c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(max(v.value), 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // y.p) AS value
    FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
  ) v ON v.lang = a.lang AND v.source = a.source AND v.item = b.source
  GROUP BY ALL
), ranked AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM p WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM ranked
) WHERE part = 'pair' OR rank <= 200
"""

"""Exact Jaccard self-join of documents by their word shingles, in a metric space of sets.

Sets are in a metric space under the Jaccard distance.  Every document is at distance 1 from
almost everything, so pivots only help where documents share something at all:

1. Regions.  With shingles ordered by rarity, two sets within the distance share one of their
   rarest ``n - ceil(t n) + 1`` shingles.  Documents sharing such a shingle are a region; shingles
   of one document only make none, and a document with enough of them has no partner.  Shingles
   that a 64th of all documents hold are last in the order and need not be gathered.
2. Pivots.  The smallest document of a region is its pivot.  Distances to the pivot are computed
   once per document and pivot.  Those within the distance are linked.
3. Recursion.  A region whose documents are all connected by now is done.  In the others, only
   documents of different components can still add anything; the triangle inequality leaves of
   them those whose distances to the pivot differ by no more than the distance asked for.  They get the
   next pivot, and so on; what is left in small regions is compared pair by pair.

Links between documents that are connected anyhow are not all enumerated, so a group of thousands
of near copies costs its size, not its square.

Words are as ``common.WORD``, A-Z lowered.  A text with fewer words than a shingle is one shingle;
one without words, or null, has an empty set and no links.  Documents with equal sets are linked.
Rows that share a doc_id count as linked; a null doc_id gets a null component.  Shingles are
64-bit hashes (44 to 60 bits of them when gathered, more with more
shuffle partitions).
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from veristream.llm.common import bites, materialize, mix64, per_text, runs, shuffle_partitions
from veristream.llm.graph import components

WIDTH = 5
#: Similarity in hundredths.
PERCENT = 80
#: A shingle that this part of all documents hold is not gathered.
COMMON = 64
#: Documents in a region up to which it isn't divided further.
SMALL = 64
#: Documents in a block of a larger one.
BLOCK = 256
#: In place of a part, for the numbers of common shingles: above all parts.
OFTEN = 1 << 22
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


#: A letter's number in the hash of a word (fixed values) and the factor from place to place.
_SOLID = ~np.isin(np.arange(256), [*range(9, 14), 32])
_LETTER = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTOR = 0x5851F42D4C957F2D
_BACK = pow(_FACTOR, -1, 1 << 64)
#: Bytes hashed at a time; a longer word stands alone.
SPAN = 1 << 18


@lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the factor and of its inverse, modulo 2^64."""
    up = np.full(n, _FACTOR, np.uint64), np.full(n, _BACK, np.uint64)
    for p in up:
        p[0] = 1
        np.cumprod(p, out=p)
    return up


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of each word, all words at once.

    The hash is the sum over the word's letters of their numbers times the factor to the power of their
    place, made from differences of running sums, scrambled together with the word's length.
    """
    code = np.frombuffer(text, np.uint8)
    edge = np.flatnonzero(np.diff(np.concatenate([[False], _SOLID[code], [False]])))
    start, stop = edge[::2], edge[1::2]
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(stop, start[i] + SPAN, "right")))
        a, b = start[i], stop[j - 1]
        up, down = _powers(1 << max(18, int(b - a).bit_length()))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_LETTER[code[a:b]] * up[: b - a])])
        out[i:j] = (total[stop[i:j] - a] - total[start[i:j] - a]) * down[start[i:j] - a]
        i = j
    return start, mix64(out + mix64((stop - start).astype(np.uint64)))


def shingles(texts: list[str], width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    if not texts:
        return []
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    begin = np.cumsum([0, *[len(r) + 1 for r in raw]])
    start, hashed = word_hashes(b" ".join(raw).translate(_LOWER))
    first = np.searchsorted(start, begin)  # the first word of each text
    n = np.diff(first)
    all_runs = runs(hashed, width)
    count = np.maximum(n - width + 1, 0)
    at = np.cumsum([0, *count])
    owner = np.repeat(np.arange(len(texts)), count)
    key = all_runs[np.arange(at[-1]) - at[owner] + first[owner]]
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        key[a:b].sort()
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    key, cut = key[new], np.searchsorted(owner[new], np.arange(len(texts) + 1)).tolist()
    out = [key[a:b] for a, b in zip(cut[:-1], cut[1:])]
    for i in np.flatnonzero((n > 0) & (n < width)).tolist():
        h = hashed[first[i] : first[i + 1]]
        out[i] = mix64(runs(h, len(h)) + np.uint64(len(h)))
    return out


def prefix_length(n: Column) -> Column:
    """How many of its rarest shingles a set of ``n`` has to show."""
    return n - F.floor((n * PERCENT + 99) / 100) + 1


def describe(docs: DataFrame) -> DataFrame:
    """doc_id, n (set size), digest of the set, and shingles common in the document's batch."""

    def work():
        def step(keys, texts):
            sets = shingles(texts)
            common = np.empty(0, np.uint64)
            if sets:
                key, count = np.unique(np.concatenate(sets), return_counts=True)
                often = count >= max(2, len(texts) / COMMON)
                common, count = key[often], count[often]
            first = [[] for _ in keys]
            if len(common):
                first[0] = [{"key": int(k), "n": int(c)} for k, c in zip(common.astype(np.int64), count)]
            return {
                "doc_id": keys, "n": [len(s) for s in sets],
                "digest": [hashlib.md5(s.tobytes()).digest() for s in sets], "common": first,
            }

        return step

    kind = docs.schema["doc_id"].dataType.simpleString()
    return per_text(docs, "doc_id", "text", f"doc_id {kind}, n long, digest binary, common array<struct<key long, n long>>", work)


def _gather(docs: DataFrame, common: np.ndarray, bits: int) -> DataFrame:
    """Shingles dealt into 2^bits parts by hash, as arrays: part, documents, and per shingle key and document.

    Common shingles go with their documents instead, each to the part of the document's bucket, by their number.
    """
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def packed(owner, key, doc, ids, width, often):
        """A row for each owner; everything is in order of owner."""
        cut = np.searchsorted(owner, np.arange((1 << bits) + 1)).tolist()
        for p, (x, y) in enumerate(zip(cut[:-1], cut[1:])):
            if x == y:
                continue
            seen, number = np.unique(doc[x:y], return_inverse=True)
            step = np.diff(key[x:y], prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8)[:, :width]
            # differences byte by byte: the high bytes are nearly all zero
            yield pa.RecordBatch.from_arrays(
                [pa.array([p], pa.int32()), pa.array([often]), pa.array([ids[seen].tobytes()], pa.binary()),
                 pa.array([np.ascontiguousarray(step.T).tobytes()], pa.binary()),
                 pa.array([number.astype("<u2").view(np.uint8).reshape(-1, 2).T.tobytes()], pa.binary())],
                names=["part", "often", "docs", "keys", "numbers"],
            )

    def run(batches):
        hot = shared.value
        for batch in batches:
            for some_ids, some in bites(batch, 4_000_000):
                for a in range(0, len(some_ids), 60_000):  # documents are numbered in 16 bits
                    sets = shingles(some[a : a + 60_000])
                    ids = np.array(some_ids[a : a + 60_000], np.int64)
                    key, doc = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
                    if len(hot):
                        at = np.minimum(np.searchsorted(hot, key), len(hot) - 1)
                        often = hot[at] == key
                        owner, number, of = _bucket(ids, 1 << bits)[doc[often]], at[often].astype(np.uint64), doc[often]
                        order = np.lexsort((number, owner))
                        yield from packed(owner[order], number[order], of[order], ids, 5, True)
                        key, doc = key[~often], doc[~often]
                    order = np.argsort(key)
                    key, doc = key[order], doc[order]
                    owner = (key >> np.uint64(64 - bits)).astype(np.int64)
                    yield from packed(owner, key >> np.uint64(24 - bits) & np.uint64((1 << 40) - 1), doc, ids, 5, False)

    return docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "part int, often boolean, docs binary, keys binary, numbers binary"
    )


def _bucket(doc: np.ndarray, buckets: int) -> np.ndarray:
    return (mix64(doc.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _shared(table: pa.Table) -> pa.Table:
    """Of one part, the shingles that two documents or more hold, with their number; by buckets of documents."""
    part, buckets = (table.column(c)[0].as_py() for c in ("part", "buckets"))
    often = table.column("often")
    common = _pairs(table.filter(often))
    key, doc = _pairs(table.filter(pc.invert(often)))
    order = np.argsort(key)
    key, doc = key[order], doc[order]
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    count = np.diff(np.concatenate([start, [len(key)]]))
    held = np.repeat(count, count)
    some = held > 1
    key, doc, held = key[some], doc[some], held[some]
    held = np.minimum(held, (1 << 32) - 2)
    rare = _by_bucket(part, key, doc, held, _bucket(doc, buckets))
    if not len(common[0]):
        return rare
    key, doc = common
    last = np.full(len(key), (1 << 32) - 1)
    order = np.argsort(key, kind="stable")
    return pa.concat_tables([rare, _by_bucket(OFTEN, key[order], doc[order], last, np.full(len(key), part))])


def _pairs(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys, docs = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for d, k, n in zip(*[table.column(c).to_pylist() for c in ("docs", "keys", "numbers")]):
        number = np.frombuffer(n, np.uint8).reshape(2, -1).T.copy().view("<u2").ravel()
        step = np.zeros((len(number), 8), np.uint8)
        step[:, :5] = np.frombuffer(k, np.uint8).reshape(5, -1).T
        keys.append(np.cumsum(step.view("<u8").ravel()))
        docs.append(np.frombuffer(d, np.int64)[number])
    return np.concatenate(keys), np.concatenate(docs)


def _by_bucket(part: int, key: np.ndarray, doc: np.ndarray, held: np.ndarray, bucket: np.ndarray) -> pa.Table:
    order = np.lexsort((doc, bucket))  # keys of a document stay in order
    key, doc, held, bucket = key[order], doc[order], held[order], bucket[order]
    first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (bucket[1:] != bucket[:-1])])) if len(doc) else np.empty(0, int)
    size = np.diff(first, append=len(doc))
    names, start = np.unique(bucket[first], return_index=True)
    stop = np.append(start[1:], len(first)).astype(int)
    at = np.append(first, len(doc))
    # bytes in planes, documents once each: a third of what plain numbers take on disk
    planes = lambda x, width, a, b: x[a:b].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    blobs = {c: [] for c in ("docs", "sizes", "keys", "held")}
    for a, b in zip(start, stop):
        x, y = at[a], at[b]
        blobs["docs"].append(doc[first[a:b]].tobytes())
        blobs["sizes"].append(size[a:b].astype("<i4").tobytes())
        blobs["keys"].append(planes(key, 5, x, y))
        blobs["held"].append(planes(held, 4, x, y))
    return pa.table({"bucket": pa.array(names.astype(np.int32)), "part": pa.array([part] * len(names), pa.int32()), **{c: pa.array(x, pa.binary()) for c, x in blobs.items()}})


def _per_document(table: pa.Table) -> pa.Table:
    """Of one bucket of documents, the shared shingles of each."""

    def number(blob: bytes, width: int) -> np.ndarray:
        wide = np.zeros((len(blob) // width, 8), np.uint8)
        wide[:, :width] = np.frombuffer(blob, np.uint8).reshape(width, -1).T
        return wide.view("<u8").ravel().astype(np.int64)

    column = lambda c: table.column(c).to_pylist()
    doc = np.concatenate([np.repeat(np.frombuffer(d, np.int64), np.frombuffer(n, "<i4")) for d, n in zip(column("docs"), column("sizes"))])
    key = np.concatenate([number(k, 5) | (p << 40) for p, k in zip(column("part"), column("keys"))])
    held = np.concatenate([number(h, 4) for h in column("held")])
    order = np.argsort(doc, kind="stable")
    key, doc, held = key[order], doc[order], held[order]
    start = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    offsets = pa.array(np.concatenate([start, [len(doc)]]).astype(np.int32))
    pairs = pa.StructArray.from_arrays([pa.array(held), pa.array(key)], names=["held", "key"])
    return pa.table({"doc_id": pa.array(doc[start]), "shared": pa.ListArray.from_arrays(offsets, pairs)})


def _similar(same: Column, n1: Column, n2: Column) -> Column:
    return 100 * same >= PERCENT * (n1 + n2 - same)


def _distances(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, na, nb and the size of the intersection, for distinct pairs of documents.

    Shingles that one document only holds are in no intersection, so the sets needn't have them.
    """
    left = pairs.join(sets.select(F.col("doc").alias("a"), F.col("n").alias("na"), F.col("keys").alias("ka")), "a")
    return left.join(sets.select(F.col("doc").alias("b"), F.col("n").alias("nb"), F.col("keys").alias("kb")), "b").where(
        (100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb"))
    ).select("a", "b", "na", "nb", F.size(F.array_intersect("ka", "kb")).cast("long").alias("same"))


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for every row."""
    spark = docs.sparkSession
    meta = materialize(describe(docs), "meta")
    total = meta.where("n > 0").count()
    # Common shingles: at most COMMON times the mean set size of them, whatever the number of documents.
    often = meta.select(F.explode("common").alias("c")).groupBy("c.key").agg(F.sum("c.n").alias("n"))
    hot = [r["key"] for r in often.where(F.col("n") >= max(64, total / COMMON)).select("key").collect()]
    common = np.sort(np.array(hot, np.int64).astype(np.uint64))
    bits = min(20, max(4, int(np.ceil(np.log2(shuffle_partitions(spark))))))
    gathered = _gather(docs, common, bits).withColumn("buckets", F.lit(1 << bits)).groupBy("part").applyInArrow(
        _shared, "bucket int, part int, docs binary, sizes binary, keys binary, held binary"
    )
    sets_of = gathered.groupBy("bucket").applyInArrow(_per_document, "doc_id long, shared array<struct<held long, key long>>")
    heads = meta.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("doc"), F.first("n").alias("n"))
    heads = materialize(heads, "heads")
    show = prefix_length(F.col("n"))
    rows = heads.join(sets_of, heads["doc"] == sets_of["doc_id"], "left").drop("doc_id")
    # Common shingles come last in the order.
    shared = F.array_sort(F.coalesce("shared", F.array().cast("array<struct<held:bigint,key:bigint>>")))
    rows = rows.select("doc", "n", shared.alias("shared")).withColumn(
        "shown", (show - (F.col("n") - F.size("shared"))).cast("int")
    ).where("shown > 0")
    sets = materialize(
        rows.select(
            F.col("doc").cast("long").alias("doc"), "n", F.transform("shared", lambda s: s["key"]).alias("keys"), "shown",
        ), "sets",
    )
    posted = sets.select("doc", F.explode(F.slice("keys", F.lit(1), F.col("shown"))).alias("key"))
    # Shingles with the same documents make one region.
    lists = posted.groupBy("key").agg(
        F.count("*").alias("size"), F.sum(F.xxhash64("doc") % (1 << 31)).alias("s"), F.bit_xor(F.xxhash64("doc", F.lit(1))).alias("x"),
        F.min("doc").alias("pivot"),
    ).where("size > 1")
    regions = lists.groupBy("size", "s", "x", "pivot").agg(F.min("key").alias("key")).select("key", "pivot", "size")
    member = materialize(posted.join(regions, "key"), "members")

    pairs = member.where("doc <> pivot").select(F.col("pivot").alias("a"), F.col("doc").alias("b")).distinct()
    known = materialize(_distances(pairs, sets), "distances")
    edges = known.where(_similar(F.col("same"), F.col("na"), F.col("nb"))).select("a", "b")
    label = materialize(components(edges), "labels")
    edges = materialize(edges.unionByName(_recurse(member, known, sets, label)), "links")
    label = components(edges)

    node = heads.select("digest", F.col("doc").cast("long").alias("id")).join(label, "id", "left").select(
        "digest", F.coalesce("component", "id").alias("component_id")
    )
    out = meta.select("doc_id", "n", "digest").join(node, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id").cast("long")).alias("component_id"),
    )
    return out


def keep(docs: DataFrame) -> DataFrame:
    """One document of each group: the one with the smallest doc_id, of several rows with it that with the
    smallest text.  Rows without doc_id all stay.

    Where rows share a doc_id and have unlike texts, each row is a document of its own: one goes only
    if its own text has a near copy that stays.
    """
    text = F.coalesce("text", F.lit(""))
    own = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min(F.xxhash64(text)).alias("least"), F.max(F.xxhash64(text)).alias("most")
    ).where("least <> most")
    if not own.isEmpty():
        return _keep_rows(docs, text)
    stay = groups(docs.select("doc_id", "text")).where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    rest = [c for c in docs.columns if c != "doc_id"]
    one = docs.join(stay, "doc_id", "left_semi").groupBy("doc_id").agg(
        F.min_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.coalesce("text", F.lit(""))).alias("row")
    )
    one = one.select(*[F.col("doc_id") if c == "doc_id" else F.col("row").getField(c).alias(c) for c in docs.columns])
    return one.unionByName(docs.where(F.col("doc_id").isNull()))


def _keep_rows(docs: DataFrame, text: Column) -> DataFrame:
    """``keep`` by numbers that the rows get in order of (doc_id, text)."""
    known = docs.where(F.col("doc_id").isNotNull()).select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"), text.alias("text")
    )
    dealt = known.repartitionByRange("id", "text").sortWithinPartitions("id", "text")
    numbered = materialize(dealt.withColumn("number", F.monotonically_increasing_id()), "numbered")
    found = groups(numbered.select(F.col("number").alias("doc_id"), "text"))
    stay = found.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("number"), F.col("n_shingles").alias("n"))
    rows = numbered.join(stay, "number")
    # Texts without words are in no group; of those that share a doc_id one is enough.
    bare = rows.where("n = 0").groupBy("id").agg(F.min("number").alias("number")).select("number")
    one = rows.where("n > 0").unionByName(rows.join(bare, "number", "left_semi"))
    one = one.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
    return one.unionByName(docs.where(F.col("doc_id").isNull()))


def _recurse(member: DataFrame, known: DataFrame, sets: DataFrame, label: DataFrame) -> DataFrame:
    """Links between components, from regions that still hold several."""
    ring = known.select(
        F.col("a").alias("pivot"), F.col("b").alias("doc"), (1 - F.col("same") / (F.col("na") + F.col("nb") - F.col("same"))).alias("d")
    )
    # (region, document, distance to its first pivot); pairs too unlike in size were not measured: null
    rest = member.where("doc <> pivot").join(ring, ["pivot", "doc"], "left").join(sets.select("doc", "n"), "doc").select("key", "doc", "n", "d")
    found = None
    for step in range(2):
        rest = rest.join(label.withColumnRenamed("id", "doc"), "doc", "left").withColumn("of", F.coalesce("component", "doc")).drop("component")
        several = rest.groupBy("key").agg(F.min("of").alias("lo"), F.max("of").alias("hi"), F.count("*").alias("size"), F.min("doc").alias("next")).where("lo < hi")
        rest = materialize(rest.join(several.select("key", "size", "next"), "key"), f"open{step}")
        small, large = rest.where(F.col("size") <= SMALL), rest.where(F.col("size") > SMALL)
        pairs = _near(small, small)
        if step == 0:
            pairs = pairs.unionByName(_near(large, large.where("doc = next")))
        links = _distances(pairs.distinct(), sets).where(_similar(F.col("same"), F.col("na"), F.col("nb"))).select("a", "b")
        if step == 1:
            return found.unionByName(links).unionByName(_blocks(large, sets))
        found = materialize(links, "found")
        rest = large.where("doc <> next").select("key", "doc", "n", "d")
        label = materialize(components(found.unionByName(label.select(F.col("id").alias("a"), F.col("component").alias("b")))), "more")


def _near(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs of a region that are in different components and that neither size nor triangle inequality rules out."""
    reach = 1 - PERCENT / 100 + 1e-9
    named = lambda df, k: df.select("key", *[F.col(c).alias(f"{c}_{k}") for c in ("doc", "n", "d", "of")])
    return named(left, 1).join(named(right, 2), "key").where(
        (F.col("of_1") != F.col("of_2")) & (100 * F.least("n_1", "n_2") >= PERCENT * F.greatest("n_1", "n_2"))
        & F.coalesce(F.abs(F.col("d_1") - F.col("d_2")) <= reach, F.lit(True))
    ).select(F.least("doc_1", "doc_2").alias("a"), F.greatest("doc_1", "doc_2").alias("b"))


def _blocks(large: DataFrame, sets: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links between components in regions of any size: blocks against blocks, on arrays."""
    parts = F.ceil(F.col("size") / block).cast("int")
    rows = large.withColumn("parts", parts).withColumn("mine", F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int"))
    rows = rows.join(sets.select("doc", "keys"), "doc")
    one = rows.select("key", F.col("mine").alias("i"), F.explode(F.sequence("mine", F.col("parts") - 1)).alias("j"), F.lit(1).alias("side"), "doc", "n", "of", "keys")
    two = rows.select("key", F.explode(F.sequence(F.lit(0), "mine")).alias("i"), F.col("mine").alias("j"), F.lit(2).alias("side"), "doc", "n", "of", "keys")

    def compare(table: pa.Table) -> pa.Table:
        col = {c: table.column(c).to_numpy() for c in ("side", "doc", "n", "of")}
        sets_ = [np.asarray(k, np.int64) for k in table.column("keys").to_pylist()]
        left, right = np.flatnonzero(col["side"] == 1), np.flatnonzero(col["side"] == 2)
        a, b = [], []
        if len(left) and len(right):
            flat = np.concatenate([sets_[i] for i in right])
            start = np.cumsum([0, *[len(sets_[i]) for i in right[:-1]]])
            names, flat = np.unique(flat, return_inverse=True)
            here = np.zeros(len(names) + 1, np.int32)
            n, of = col["n"][right], col["of"][right]
            for i in left:
                at = np.minimum(np.searchsorted(names, sets_[i]), len(names) - 1)
                at = at[names[at] == sets_[i]]
                here[at] = 1
                same = np.add.reduceat(here[flat], start)
                here[at] = 0
                linked = np.flatnonzero((100 * same >= PERCENT * (n + col["n"][i] - same)) & (of != col["of"][i]))
                _, first = np.unique(of[linked], return_index=True)  # one link to each component will do
                a += [int(col["doc"][i])] * len(first)
                b += col["doc"][right[linked[first]]].tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return one.unionByName(two).groupBy("key", "i", "j").applyInArrow(compare, "a long, b long")

"""The registry of scam identifiers: a keyed snapshot and a log of changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from veristream import fixed_values as fv
from veristream.functions import text as tx, times

FIELDS = [
    "identifier_type", "identifier_value", "owner_name", "source", "report_count",
    "status", "notes",
]
DEFAULTS = {"report_count": 1, "status": "active"}


def make_id(*natural_key: Column) -> Column:
    """Stable id: 'scam-' and the whole digest of the key, so that no two keys meet."""
    return F.concat(F.lit("scam-"), F.sha2(F.concat_ws("\x1f", *natural_key), 256))


def _was_set(name: str) -> Column:
    return F.array_contains("set_fields", name)


def fold(changes: DataFrame) -> DataFrame:
    """All changes of an id as one row.

    A field holds its last value wrapped in a struct (null struct: not set), so
    a set null differs from no change.  Plain aggregates: an id with very many
    changes is reduced in every task before the shuffle.
    """
    creates, updates = F.col("op") == "create", F.col("op") == "update"
    life = F.col("op").isin("create", "delete")

    def last(value: Column, where: Column) -> Column:
        return F.max_by(F.when(where, F.struct(value.alias("v"))), F.when(where, F.col("seq")))

    folded = []
    for name in FIELDS:
        given = F.col(f"row.{name}")
        if name in DEFAULTS:
            given = F.when(creates & ~_was_set(name), F.lit(DEFAULTS[name])).otherwise(given)
        folded.append(last(given, creates | (updates & _was_set(name))).alias(f"_{name}"))
    return changes.groupBy("id").agg(
        F.max_by(F.when(life, F.col("op")), F.when(life, F.col("seq"))).alias("_life"),
        last(F.col("at"), creates).alias("_created_at"),
        last(F.col("at"), creates | updates).alias("_updated_at"),
        *folded,
    )


def apply_changes(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """The snapshot after all changes: create, update of the set fields, delete.

    Changes are a small table next to the snapshot.  The snapshot is joined
    with them from its own side and only its id column is looked at for new
    ids, so it stays where it is while the changes are small enough to be
    broadcast.  Updates and deletes of unknown ids change nothing; see
    ``rejected``.
    """
    folded = fold(changes)

    def value(name: str, old: Column) -> Column:
        new = F.col(f"_{name}")
        return F.when(new.isNotNull(), new["v"]).otherwise(old).alias(name)

    columns = [*FIELDS, "created_at", "updated_at"]
    kept = (
        snapshot.join(folded, "id", "left")
        .filter(F.coalesce(F.col("_life") == "create", F.lit(True)))
        .select("id", *[value(c, F.col(c)) for c in columns])
    )
    created = folded.filter(F.col("_life") == "create")
    known = snapshot.select("id").join(created.select("id"), "id", "left_semi")
    none = F.lit(None)
    added = created.join(known, "id", "left_anti").select(
        "id", *[value(c, none) for c in columns]
    )
    return kept.unionByName(added)


def rejected(snapshot: DataFrame, changes: DataFrame, chunk: int = 100_000) -> DataFrame:
    """Updates and deletes of ids that were not there at that moment.

    Whether an id is there depends on its last create or delete before.  An id
    may have any number of changes, so they are cut into chunks of ``seq``:
    each chunk's last create or delete is carried to the next chunks, and rows
    are only ordered within their chunk.
    """
    life = F.when(F.col("op").isin("create", "delete"), F.col("op"))
    cut = changes.select("id", "seq", "op", life.alias("_life")).withColumn(
        "_chunk", F.floor(F.col("seq") / chunk)
    )
    ends = cut.groupBy("id", "_chunk").agg(
        F.max_by("_life", F.when(F.col("_life").isNotNull(), F.col("seq"))).alias("_end")
    )
    chunks = Window.partitionBy("id").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        "id", "_chunk", F.last("_end", ignorenulls=True).over(chunks).alias("_carried")
    )
    rows = (
        Window.partitionBy("id", "_chunk").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    )
    state = cut.withColumn("_before", F.last("_life", ignorenulls=True).over(rows)).join(
        carried, ["id", "_chunk"]
    )
    touched = changes.select("id").distinct()
    present = (
        snapshot.select("id").join(touched, "id", "left_semi").withColumn("_present", F.lit(True))
    )
    before = F.coalesce("_before", "_carried")
    there = F.when(before.isNotNull(), before == "create").otherwise(
        F.coalesce("_present", F.lit(False))
    )
    return (
        state.join(present, "id", "left")
        .filter((F.col("op") != "create") & ~there)
        .select(
            "id",
            "seq",
            "op",
            F.concat(F.lit("Scam record '"), F.col("id"), F.lit("' not found.")).alias("error"),
        )
    )


def lookup(snapshot: DataFrame, ids: DataFrame) -> DataFrame:
    """Records of the asked ids; unknown ids come with an error text."""
    wanted = ids.select("id")
    found = snapshot.join(wanted.distinct(), "id", "left_semi").withColumn("_found", F.lit(True))
    missing = F.concat(F.lit("Scam record '"), F.col("id"), F.lit("' not found."))
    return (
        wanted.join(found, "id", "left")
        .withColumn("error", F.when(F.col("_found").isNull(), missing))
        .drop("_found")
    )


def list_newest(df: DataFrame) -> DataFrame:
    return df.orderBy(F.col("created_at").desc(), "id")


def _status_text(status: Column) -> Column:
    lowered = F.lower(F.coalesce(status, F.lit("")))
    out = None
    for name, shown in fv.REGISTRY_STATUS_TEXT.items():
        out = (F if out is None else out).when(lowered == name, F.lit(shown))
    return out.otherwise(F.lit("Review"))


def display(df: DataFrame) -> DataFrame:
    """Registry rows as the dashboard shows them."""
    is_phone = F.contains(F.lower("identifier_type"), F.lit("phone"))
    return df.select(
        "id",
        F.when(is_phone, F.lit(fv.REGISTRY_TYPE_TEXT["phone"]))
        .otherwise(F.lit(fv.REGISTRY_TYPE_TEXT["other"]))
        .alias("type"),
        F.coalesce(tx.non_empty(F.col("identifier_value")), F.lit("-")).alias("value"),
        F.coalesce(tx.non_empty(F.col("owner_name")), F.lit(fv.REGISTRY_OWNER_DEFAULT)).alias("owner"),
        F.coalesce(tx.non_empty(F.col("source")), F.lit(fv.REGISTRY_SOURCE_DEFAULT)).alias("source"),
        F.coalesce("report_count", F.lit(0)).alias("reports"),
        _status_text(F.col("status")).alias("status"),
        F.date_format(times.parse_time(F.col("updated_at")), "HH:mm").alias("updated_at"),
    )


def kpis(df: DataFrame) -> DataFrame:
    """Active identifiers, reports in all, and identifiers to review."""
    shown = _status_text(F.col("status"))
    return df.agg(
        F.count_if(shown == "Aktif").alias("n_active"),
        F.coalesce(F.sum(F.coalesce("report_count", F.lit(0))), F.lit(0)).alias("n_reports"),
        F.count_if(shown == "Review").alias("n_review"),
    )

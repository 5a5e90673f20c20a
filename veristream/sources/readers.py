"""Batch readers.  Every reader takes a schema or keeps text as text, so no
data is read twice to guess types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from veristream import schemas
from veristream.functions.planning import compute_once
from veristream.functions.text import strip
from veristream.sources import files, records


def _parsed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """CSV records in ``value`` to the schema's columns; those that do not fit are skipped."""
    bad = "_corrupt_record"
    ddl = T.StructType([*schema.fields, T.StructField(bad, T.StringType())]).toDDL()
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}
    keep = [c for c in rows.columns if c != "value"]
    parsed = compute_once(rows, "_row", F.from_csv("value", ddl, options)).filter(F.col(f"_row.{bad}").isNull())
    return parsed.select(*keep, *[F.col(f"_row.`{f.name}`").alias(f.name) for f in schema])


def read_csv(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """UTF-8 CSV with a header; records that do not fit the schema are skipped.

    Fields may hold line breaks in quotes, and yet many tasks read a large file.
    """
    _, rows = records.read_records(spark, path)
    return _parsed(rows.drop("path"), schema)


def read_json_array(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """Files that hold one JSON array (or object) over many lines."""
    return spark.read.schema(schema).json(path, multiLine=True)


def parse_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """``value`` lines to the schema's columns plus ``_corrupt_record``."""
    withbad = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    parsed = F.from_json(
        "value", withbad, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    )
    return (
        lines.filter(strip(F.col("value")) != "")
        .withColumn("_parsed", parsed)
        .select("_parsed.*")
    )


def read_jsonl(
    spark: SparkSession, path, schema: T.StructType
) -> tuple[DataFrame, DataFrame]:
    """JSON lines as (good rows, bad lines); blank lines are skipped."""
    rows = parse_lines(spark.read.text(path), schema)
    good = rows.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
    bad = rows.filter(F.col("_corrupt_record").isNotNull()).select(
        F.col("_corrupt_record").alias("value")
    )
    return good, bad


def read_rss(spark: SparkSession, path) -> DataFrame:
    """Items of RSS files and entries of Atom files: link, title, description, published.

    ``summary`` wins over ``description``, and over an entry's ``content``, where there is one.
    An entry's link is its alternate one, or the first that doesn't say what it is.
    """
    text = lambda *c: F.coalesce(*c, F.lit(""))
    read = lambda tag, schema: spark.read.format("xml").option("rowTag", tag).schema(schema).load(path)
    items = read("item", schemas.RSS_ITEM).select(
        "link", text("title").alias("title"), text("summary", "description").alias("description"), text("pubDate").alias("published")
    )
    shown = F.filter("link", lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
    entries = read("entry", schemas.ATOM_ENTRY).select(
        F.get(shown, F.lit(0))["_href"].alias("link"), text("title").alias("title"),
        text("summary", "content").alias("description"), text("published", "updated").alias("published"),
    )
    return items.unionByName(entries)


def _as_text(df: DataFrame, prefix: str) -> DataFrame:
    tagged = df.withColumn("source", F.concat(F.lit(prefix), F.col("_metadata.file_name")))
    return tagged.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in tagged.columns])


def read_glob(spark: SparkSession, glob: str, fmt: str = "csv", prefix: str = "") -> DataFrame:
    """Many files with differing columns as one table of text columns.

    ``source`` is the prefix plus the file name.  Columns a file lacks are
    null.  CSV files are grouped by header, one scan per distinct header.
    """
    if fmt != "csv":
        reader = spark.read.format(fmt)
        if fmt in ("parquet", "orc"):
            reader = reader.option("mergeSchema", True)
        return _as_text(reader.load(glob), prefix)
    found = files.expand(spark, glob)
    if not found:
        raise FileNotFoundError(glob)
    headers, rows = records.read_records(spark, found)
    by_header: dict[str, list[str]] = {}
    for path, header in sorted(headers.items()):
        by_header.setdefault(header, []).append(path)
    out = None
    for header, paths in by_header.items():
        part = _parsed(rows.filter(F.col("path").isin(paths)), _text_columns(spark, header))
        name = F.url_decode(F.replace(F.element_at(F.split("path", "/"), -1), F.lit("+"), F.lit("%2B")))
        part = part.withColumn("source", F.concat(F.lit(prefix), name)).drop("path")
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return spark.createDataFrame([], "source string") if out is None else out  # nothing but empty files


def _text_columns(spark: SparkSession, header: str) -> T.StructType:
    """Columns of text, named by a header record."""
    names = spark.read.csv(spark.sparkContext.parallelize([header]), header=True, multiLine=True, escape='"').columns
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def first_existing(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType, fmt: str = "parquet", **options
) -> DataFrame:
    """The first path that is there, else an empty table of the schema."""
    for path in paths:
        if files.exists(spark, path):
            return spark.read.format(fmt).schema(schema).options(**options).load(path)
    return spark.createDataFrame([], schema)

"""File system questions asked on the driver, through Hadoop's API."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Is there at least one file for this path or glob?"""
    found = _fs(spark, path).globStatus(_path(spark, path))
    return found is not None and len(found) > 0


def expand(spark: SparkSession, glob: str) -> list[str]:
    """Paths matching a glob, sorted."""
    found = _fs(spark, glob).globStatus(_path(spark, glob)) or []
    return sorted(status.getPath().toString() for status in found)


def leaves(spark: SparkSession, glob: str) -> list[str]:
    """Data files at or below the paths matching a glob, sorted; hidden ones, and those of writers
    that have not finished, are left out."""
    out = []
    for path in expand(spark, glob):
        found = _fs(spark, path).listFiles(_path(spark, path), True)
        while found.hasNext():
            file = found.next().getPath().toString()
            below = file.removeprefix(path).strip("/").split("/") if file != path else [file.rsplit("/", 1)[1]]
            if not any(part.startswith(("_", ".")) for part in below):
                out.append(file)
    return sorted(out)


def delete(spark: SparkSession, file: str) -> None:
    """Delete one file."""
    _fs(spark, file).delete(_path(spark, file), False)


def first_line(spark: SparkSession, path: str) -> str:
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        reader = spark._jvm.java.io.BufferedReader(
            spark._jvm.java.io.InputStreamReader(stream, "UTF-8")
        )
        return (reader.readLine() or "").lstrip("\ufeff")
    finally:
        stream.close()

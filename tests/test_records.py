"""CSV in blocks: the same rows as one task reading each file, from many tasks."""

import csv
import random

import pytest
from pyspark.sql import functions as F, types as T

from veristream.sources import readers, records

SCHEMA = T.StructType([T.StructField("x", T.IntegerType()), T.StructField("y z", T.StringType()), T.StructField("t", T.StringType())])


def write(path, n, end, seed, header=("x", "y z", "t")):
    r = random.Random(seed)
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=end)
        w.writerow(header)
        for i in range(n):
            w.writerow([i, r.choice(["a", 'b "q" c', "", 'x 5 "', "é,ü"]), r.choice(["plain", "two\nlines", 'a\nb\n\nc "x"\n,', "long" * 40, '"', "", "x\n" * 30])])
        f.write(f'{end}{end}7,only two{end}')


@pytest.fixture
def blocks(spark):
    def size(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", n)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
        spark.conf.set("spark.sql.files.minPartitionNum", 1)

    yield size
    for name in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
        spark.conf.unset(f"spark.sql.files.{name}")


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_same_rows_from_more_tasks(spark, tmp_path, blocks, end):
    paths = [str(tmp_path / f"{k}.csv") for k in range(2)]
    for k, path in enumerate(paths):
        write(path, 250, end, k)
    plain = spark.read.csv(paths, schema=SCHEMA, header=True, multiLine=True, escape='"', mode="DROPMALFORMED")
    want = sorted(map(tuple, plain.collect()), key=str)
    assert len(want) == 500
    for n in (1 << 27, 4000, 900):
        blocks(n)
        df = readers.read_csv(spark, paths, SCHEMA)
        assert sorted(map(tuple, df.collect()), key=str) == want
        lines = records._lines(spark, paths)
        assert n > 4000 or lines.rdd.getNumPartitions() > 2 * len(paths)


def test_header_over_several_blocks_and_mark(spark, tmp_path, blocks):
    path = tmp_path / "h.csv"
    path.write_bytes(("\ufeff\n" + '"long ' + "name\n" * 40 + '",b\n1,2\n"a\n' + "z\n" * 200 + '",4').encode())
    blocks(64)
    headers, rows = records.read_records(spark, str(path))
    assert list(headers.values())[0].startswith('"long name')
    assert sorted(r["value"] for r in rows.collect()) == ['"a\n' + "z\n" * 200 + '",4', "1,2"]


def test_glob_of_files_with_other_columns(spark, tmp_path, blocks):
    write(tmp_path / "a b+c.csv", 30, "\n", 1)
    write(tmp_path / "d.csv", 20, "\r\n", 2, ("x", "w", "t"))
    blocks(500)
    df = readers.read_glob(spark, str(tmp_path / "*.csv"), prefix="f_")
    assert set(df.columns) == {"x", "y z", "w", "t", "source"}
    counts = {r["source"]: (r["n"], r["y"] > 0, r["w"] > 0) for r in df.groupBy("source").agg(F.count("*").alias("n"), F.count("y z").alias("y"), F.count("w").alias("w")).collect()}
    assert counts == {"f_a b+c.csv": (30, True, False), "f_d.csv": (20, False, True)}


@pytest.mark.parametrize("line,out,inside", [
    ("", False, True), ("a,b", False, True), ('"a', True, False), ('a"b', False, False), ('"a""', True, False), ('"a"",b', True, False),
    ('x,"', True, False), ('","', False, True), ('"",""', False, True), (' "a', True, False), ('a" ,"b', True, True),
])
def test_state_of_a_line(line, out, inside):
    assert (records.inside_after(line, False), records.inside_after(line, True)) == (out, inside)


def test_empty_files(spark, tmp_path):
    (tmp_path / "e.csv").write_text("")
    (tmp_path / "n.csv").write_text("\n\n")
    assert readers.read_glob(spark, str(tmp_path / "*.csv")).collect() == []
    (tmp_path / "h.csv").write_text("a,b\n")
    assert set(readers.read_glob(spark, str(tmp_path / "*.csv")).columns) == {"a", "b", "source"}

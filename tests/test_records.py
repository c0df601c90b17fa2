"""Delimited text with line breaks in quotes, cut at every kind of place."""

from __future__ import annotations

import csv
import random

import pytest
from pyspark.sql import types as T

from corpusmill.sources import delimited
from corpusmill.sources.records import ends_inside, read_records

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.StringType()), T.StructField("u", T.StringType())])


@pytest.fixture
def small_ranges(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", 64)
    spark.conf.set("spark.sql.files.openCostInBytes", 64)
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("line,outside,inside", [
    ("", False, True), ("a,b", False, True), ('"a', True, False), ('a,"b', True, False), ('"a"', False, False), ('"a""', True, False),
    ('5" disk,x', False, False), ('5" disk,"x', True, True), ('"a"b,"c', True, True), ('"a,""b"",c"', False, False), ('"",""', False, True),
])
def test_where_a_line_ends(line, outside, inside):
    assert (ends_inside(line, False, ","), ends_inside(line, True, ",")) == (outside, inside)


def _value(rng: random.Random) -> str:
    parts = ["a", "bc", '"', "\n", "\n\n", ",", " ", "é", '","', '"\n', "long " * 30]
    return "".join(rng.choice(parts) for _ in range(rng.randint(1, 8)))


@pytest.mark.parametrize("most", [1_000_000, 0])
@pytest.mark.parametrize("seed,end", [(1, "\n"), (2, "\r\n"), (3, "\n")])
def test_same_records_as_the_writer(spark, small_ranges, tmp_path, seed, end, most):
    rng = random.Random(seed)
    wanted = [[str(i), _value(rng), _value(rng)] for i in range(60)]
    for half in (0, 1):
        with open(tmp_path / f"{half}.csv", "w", newline="") as f:
            csv.writer(f, lineterminator=end).writerows([["id", "t", "u"], *wanted[half::2]])
    records = read_records(spark, str(tmp_path), ",", most)
    assert records.where("first").count() == 2
    found = [next(csv.reader([r["record"]], strict=True)) if "\n" not in r["record"] else next(csv.reader(r["record"].splitlines(True)))
             for r in records.where("not first").collect()]
    assert sorted(found) == sorted(wanted)


def test_same_rows_as_one_task(spark, small_ranges, tmp_path):
    rng = random.Random(7)
    rows = [(i, _value(rng) if i % 5 else None, "one value over very many ranges\n" * (200 if i == 20 else 1)) for i in range(50)]
    delimited.write_delimited(spark.createDataFrame(rows, SCHEMA).coalesce(1), str(tmp_path / "t"))
    one = delimited.read_tsv(spark, str(tmp_path / "t"), SCHEMA)
    many = delimited.read_tsv(spark, str(tmp_path / "t"), SCHEMA, ranges=True)
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, one.collect())) == sorted(rows)
    assert many.schema == one.schema


def test_odd_files(spark, small_ranges, tmp_path):
    (tmp_path / "t.csv").write_bytes('﻿\nid,t,u\n1,5" disk,"x"\n\n2,"a"b,null\n3,,"never\nclosed'.encode())
    found = delimited.read_csv(spark, str(tmp_path / "t.csv"), SCHEMA, ranges=True).orderBy("id").collect()
    assert [tuple(r) for r in found][:2] == [(1, '5" disk', "x"), (2, '"a"b', None)]
    (tmp_path / "empty.csv").write_text("")
    assert delimited.read_csv(spark, str(tmp_path / "empty.csv"), SCHEMA, ranges=True).collect() == []
    (tmp_path / "bad.csv").write_text("t,id,u\na,1,b\n")
    with pytest.raises(Exception, match="other columns"):
        delimited.read_csv(spark, str(tmp_path / "bad.csv"), SCHEMA, ranges=True).collect()


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,t,u\n" + '1,"two\nlines",x\n' * 50_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 100_000)
    try:
        found = delimited.read_csv(spark, str(tmp_path / "t.csv"), SCHEMA, ranges=True)
        assert found.where("t = 'two\\nlines' and u = 'x'").count() == 50_000
        assert found.select("id").rdd.getNumPartitions() >= 8
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")

"""Quoted exports read in byte ranges against Python's csv module."""

import csv
import io
import random

import pytest

from dialoom.sources import readers, records


@pytest.fixture
def small_ranges(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "97")
    yield
    spark.conf.set(key, before)


def written(path, rows, sep=",", ends="\r\n", bom=True):
    out = io.StringIO()
    csv.writer(out, delimiter=sep, lineterminator=ends).writerows(rows)
    path.write_bytes((("﻿" if bom else "") + out.getvalue()).encode())
    return out.getvalue()


def odd_rows(seed, n):
    rng = random.Random(seed)
    parts = ["", 'said "yes"', "two\nlines", "a,b\tc", "\n\n", '"', "雪山\r\n小火车", "plain", "x" * 150, '""\n"']
    return [["id", "text", "more"]] + [[str(k), "".join(rng.choice(parts) for _ in range(rng.randint(0, 4))), rng.choice(parts)] for k in range(n)]


@pytest.mark.parametrize("sep, ends, bom", [(",", "\r\n", True), ("\t", "\n", False)])
def test_ranges_equal_one_reader(spark, tmp_path, small_ranges, sep, ends, bom):
    rows = odd_rows(4, 300)
    written(tmp_path / "a.csv", rows, sep, ends, bom)
    assert records.lines(spark, str(tmp_path / "a.csv")).rdd.getNumPartitions() > 20
    got = sorted((r["source_row"], r["id"], r["text"] or "", r["more"] or "") for r in readers.raw_export(spark, str(tmp_path / "a.csv")).collect())
    assert got == [(k + 2, *r) for k, r in enumerate(rows[1:])]


def test_several_files_and_empty_lines(spark, tmp_path, small_ranges):
    for k in range(3):
        text = written(tmp_path / f"f{k}.csv", odd_rows(k, 40), ends="\n", bom=False)
        (tmp_path / f"f{k}.csv").write_text("\n" * k + text + "\n\n")
    rows = readers.raw_export(spark, str(tmp_path)).collect()
    assert sorted(r["source_row"] for r in rows) == sorted([*range(2, 42)] * 3)
    assert sorted((r["id"], r["text"] or "") for r in rows) == sorted((r[0], r[1]) for k in range(3) for r in odd_rows(k, 40)[1:])


def test_one_record_over_many_ranges(spark, tmp_path, small_ranges):
    long = "\n".join(f"line {k}" for k in range(200))
    written(tmp_path / "a.csv", [["id", "text"], ["1", long], ["2", "end"]])
    assert [(r["source_row"], r["text"]) for r in readers.raw_export(spark, str(tmp_path / "a.csv")).orderBy("source_row").collect()] == [(2, long), (3, "end")]


def test_no_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    with pytest.raises(ValueError, match="header"):
        readers.raw_export(spark, str(tmp_path / "a.csv"))

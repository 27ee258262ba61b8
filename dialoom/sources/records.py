"""Quoted text exports in parallel: one file is read by many tasks, and every record keeps its number in the file.

Spark's text reader cuts a file into byte ranges at line ends. Whether a line begins a record depends on the quotation marks before it, so
a first pass counts marks and record starts of each range, once as if it began outside a quoted field and once inside. From these few numbers
(one row for each range) follow the state and the record number at which each range begins, and a second pass puts lines together. Only a record
that crosses the end of its range meets the rest of its lines by a shuffle.

A quotation mark belongs to a quoted field or is doubled in one, as in RFC 4180; empty lines between records are none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MARK, BOM = '"', "﻿"
RECORDS = "file string, number long, piece long, crossing boolean, record string"
_RECORDS = pa.schema([("file", pa.string()), ("number", pa.int64()), ("piece", pa.int64()), ("crossing", pa.bool_()), ("record", pa.string())])


def lines(spark: SparkSession, path: str) -> DataFrame:
    """file, start (of the byte range) and the line, in the order of the file within a range."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))


def ranges_of(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.Array, np.ndarray, np.ndarray]]:
    """For each range in a batch: file, start, lines, whether each ends inside a field if the first begins outside, and whether it is empty."""
    files, starts = batch.column(0), batch.column(1).to_numpy()
    files = files.to_pylist()
    at = [k for k in range(batch.num_rows) if not k or starts[k] != starts[k - 1] or files[k] != files[k - 1]]
    for lo, hi in zip(at, [*at[1:], batch.num_rows], strict=True):
        part = batch.column(2).slice(lo, hi - lo)
        inside = np.cumsum(pc.count_substring(part, MARK).to_numpy(zero_copy_only=False)) % 2 == 1
        size = pc.binary_length(part).to_numpy(zero_copy_only=False)
        empty = (size == 0) | ((size == 1) & pc.equal(part, "\r").to_numpy(zero_copy_only=False))
        yield files[lo], int(starts[lo]), part, inside, empty


def begins(inside: np.ndarray, empty: np.ndarray, first: bool) -> tuple[np.ndarray, bool]:
    """Which lines begin a record if the range (or its part) begins inside a field or not, and how the last line ends."""
    ends = inside ^ first
    return ~np.append(first, ends[:-1]) & ~empty, bool(ends[-1])


def range_states(found: DataFrame) -> dict[tuple[str, int], tuple[bool, int]]:
    """For each range: whether it begins inside a field, and how many records began before it. One row for each range (some 128 MB) goes to the driver."""

    def count(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, seen = None, []
        for batch in incoming:
            for file, start, _, inside, empty in ranges_of(batch):
                if (file, start) != key:
                    if key:
                        yield out(key, seen)
                    key, seen = (file, start), [[False, 0], [True, 0]]
                for state in seen:
                    new, state[0] = begins(inside, empty, state[0])
                    state[1] += int(new.sum())
        if key:
            yield out(key, seen)

    def out(key: tuple, seen: list) -> pa.RecordBatch:
        values = [*key, seen[0][0], seen[0][1], seen[1][1]]
        return pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names=["file", "start", "turns", "outside", "inside"])

    states: dict[tuple[str, int], tuple[bool, int]] = {}
    file, within, before = None, False, 0
    for r in found.mapInArrow(count, "file string, start long, turns boolean, outside long, inside long").orderBy("file", "start").toLocalIterator():
        if r["file"] != file:
            file, within, before = r["file"], False, 0
        states[file, r["start"]] = within, before
        before += r["inside"] if within else r["outside"]
        within ^= r["turns"]
    return states


def records(spark: SparkSession, path: str) -> DataFrame:
    """file, number (1 for the first record of a file) and record (its text, line ends inside kept)."""
    found = lines(spark, path)
    states = spark.sparkContext.broadcast(range_states(found))

    def put_together(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, rows = None, [], []
        within, number, head = False, 0, False

        def close(last: bool) -> None:
            if held:
                rows.append((*key[:1], number, key[1], head or last, "\n".join(held)))
                held.clear()

        for batch in incoming:
            for file, start, part, inside, empty in ranges_of(batch):
                if (file, start) != key:
                    close(within)
                    key = (file, start)
                    within, number = states.value[key]
                    head = within
                new, after = begins(inside, empty, within)
                open_ = ~np.append(within, (inside ^ within)[:-1])
                for line, starts, outside in zip(part.to_pylist(), new.tolist(), open_.tolist(), strict=True):
                    if starts:
                        close(False)
                        number, head = number + 1, False
                    elif outside:  # an empty line between records
                        close(False)
                        continue
                    held.append(line)
                within = after
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_RECORDS)], schema=_RECORDS)
                rows = []
        close(within)
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_RECORDS)], schema=_RECORDS)

    pieces = found.mapInArrow(put_together, RECORDS)
    crossing = pieces.filter("crossing").groupBy("file", "number").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", "record"))), lambda p: p["record"]), "\n").alias("record"))
    whole = pieces.filter("not crossing").select("file", "number", "record").unionByName(crossing)
    first = (F.col("number") == 1) & F.col("record").startswith(BOM)
    return whole.withColumn("record", F.regexp_replace(F.when(first, F.substring("record", 2, (1 << 31) - 1)).otherwise(F.col("record")), r"\r$", ""))


def parsed(record: Column, columns: int, sep: str) -> Column:
    """The cells of a record as a struct c0, c1 ..., null where it has fewer."""
    return F.from_csv(record, ", ".join(f"c{k} string" for k in range(columns)), {"sep": sep, "escape": MARK, "multiLine": "true", "maxCharsPerColumn": "-1"})


def table(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """The records below the header as strings, with ``record_number`` (the header's is 1); the header is that of the first file, a tab in it means tabs."""
    found = records(spark, path)
    head = found.filter("number = 1").orderBy("file").limit(1).collect()
    if not head:
        raise ValueError(f"no header in {path}")
    text = head[0]["record"]
    sep = sep or ("\t" if "\t" in text else ",")
    wide = spark.range(1).select(parsed(F.lit(text), text.count(sep) + 1, sep).alias("h")).first()["h"]
    names = [n for n in wide if n is not None]
    rows = found.filter("number > 1").select(F.col("number").alias("record_number"), parsed(F.col("record"), len(names), sep).alias("r"))
    return rows.select("record_number", *[F.col("r")[f"c{k}"].alias(n) for k, n in enumerate(names)])

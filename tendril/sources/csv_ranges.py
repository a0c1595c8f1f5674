"""Quoted CSV files read by many tasks each.

Spark hands out byte ranges of a file, cut between lines. Whether a range begins inside a quoted cell depends on all that
came before it, so a first pass works out, for each range, how it would end if it began outside of quotes and how if
it began inside. Those pairs compose like sums, and composing them in file order gives each range's true beginning: for
well-formed files that is the parity of quotes so far, but it also holds where quotes stand inside unquoted cells. A
second pass parses the ranges on their own. A record that goes on over a range's end is left in fragments, which are put
together per file; as many as there are ranges, not rows. Ordinals come from the counts of the ranges before.
"""

from __future__ import annotations

import csv
import re
import sys
from collections.abc import Iterator
from itertools import groupby, islice

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tendril.sources.scratch import written

AT_ONCE = 5000  # records of a range that are held at a time
CELL_END = re.compile(rb"[,\r]")
LINE = re.compile(r"[^\r\n]*(?:\r\n?|\n)")

c = F.col


def still_quoted(line: bytes, quoted: bool) -> bool:
    """Whether a line that begins inside a quoted cell, or outside, ends inside one. Quotes open cells only at their
    beginning; doubled ones inside stay; what follows a closing one up to the next comma is unquoted."""
    at = 0
    while True:
        if quoted:
            at = line.find(b'"', at)
            if at < 0:
                return True
            if line[at + 1 : at + 2] == b'"':
                at += 2
                continue
            quoted = False
        elif line[at : at + 1] == b'"':
            quoted, at = True, at + 1
            continue
        end = CELL_END.search(line, at)
        if not end:
            return False
        at = end.end()


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """path, start (of the range) and line, bytes without their line feed, in a range's order."""
    return spark.read.option("lineSep", "\n").text(path).select(c("_metadata.file_path").alias("path"), c("_metadata.file_block_start").alias("start"), c("value").cast("binary").alias("line"))


def range_states(lines: DataFrame) -> DataFrame:
    """path, start and `quoted`: whether the range begins inside a quoted cell."""

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: dict[tuple, list[bool]] = {}
        for batch in batches:
            for own in pa.Table.from_batches([batch]).group_by(["path", "start"]).aggregate([]).to_pylist():
                at.setdefault((own["path"], own["start"]), [False, True])
            quotes = batch.filter(pc.is_valid(batch.column("line")))  # other lines end as they begin
            for path, start, line in zip(*(x.to_pylist() for x in quotes.columns), strict=True):
                both = at[path, start]
                a = still_quoted(line, both[0])
                both[:] = [a, a if both[0] == both[1] else still_quoted(line, both[1])]
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in at], pa.string()), pa.array([k[1] for k in at], pa.int64()), pa.array([v[0] for v in at.values()], pa.bool_()), pa.array([v[1] for v in at.values()], pa.bool_())], ["path", "start", "plain", "inside"])

    def compose(frame: pd.DataFrame) -> pd.DataFrame:
        frame, quoted, out = frame.sort_values("start"), False, []
        for plain, inside in zip(frame["plain"], frame["inside"], strict=True):
            out.append(quoted)
            quoted = inside if quoted else plain
        return frame.assign(quoted=out)[["path", "start", "quoted"]]

    quotes = F.when(F.instr(c("line").cast("string"), F.lit('"')) > 0, c("line"))
    pairs = lines.select("path", "start", quotes.alias("line")).mapInArrow(ends, "path string, start bigint, plain boolean, inside boolean")  # a row per range
    return pairs.groupBy("path").applyInPandas(compose, "path string, start bigint, quoted boolean")


def _parsed(lines: Iterator[str]) -> Iterator[list[str]]:
    csv.field_size_limit(sys.maxsize)
    return csv.reader(lines)


def _range_rows(file: str, start: int, quoted: bool, lines: Iterator[bytes]) -> Iterator[tuple]:
    """(path, start, nth, cells, fragment) of a range: first what ends an earlier record (nth is -1), then its records,
    then the beginning of one that goes on after it."""
    held: list[str] = []  # lines of a record that isn't over
    if quoted:
        for line in lines:
            held.append(line.decode(errors="replace") + "\n")
            quoted = b'"' not in line or still_quoted(line, True)
            if not quoted:
                break
        yield file, start, -1, None, "".join(held)
        held.clear()

    def whole() -> Iterator[str]:
        inside = False
        for line in lines:
            inside = inside if b'"' not in line else still_quoted(line, inside)
            held.append(line.decode(errors="replace") + "\n")
            if not inside:
                for text in held:
                    yield from LINE.findall(text) if "\r" in text[:-2] else (text,)
                held.clear()

    n = 0
    for row in _parsed(whole()):
        if row or start == n == 0:
            yield file, start, n, row, None
            n += 1
    if held:
        yield file, start, n, None, "".join(held)


def _joined(fragments: Iterator[tuple[str, int, int, str]]) -> Iterator[tuple]:
    """Records from (path, start, nth, fragment) in file order."""
    owner, texts = None, []

    def out() -> Iterator[tuple]:
        rows = (row for row in _parsed(iter(LINE.findall("".join(texts)))) if row)
        return ((*owner[:2], owner[2] + k, row, None) for k, row in enumerate(rows))

    for *place, text in fragments:
        if place[2] >= 0:  # a record's beginning; others go on with it
            if owner:
                yield from out()
            owner, texts = place, []
        texts.append(text)
    if owner:
        yield from out()


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    kinds = {"path": pa.string(), "start": pa.int64(), "nth": pa.int64(), "cells": pa.list_(pa.string()), "fragment": pa.string()}
    while held := list(islice(rows, AT_ONCE)):
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*held, strict=True), kinds.values(), strict=True)], list(kinds))


def records(spark: SparkSession, path: str) -> DataFrame:
    """CSV files -> path, ordinal (0 is the file's first record) and cells, an array: in the files' order, blank lines
    skipped but for a file's first. Files are UTF-8: a byte-order mark is dropped, undecodable bytes become U+FFFD; cells have
    any length. A quoted cell that a file never closes takes in all the rest, as it does for a sequential reader."""
    lines = _lines(spark, path)
    states = range_states(lines)
    here = lines.join(F.broadcast(states.where("quoted").select(c("path").alias("of"), c("start").alias("begins"))), (c("path") == c("of")) & (c("start") == c("begins")), "left")  # a row per range at most
    fields = "path string, start bigint, nth bigint, cells array<string>, fragment string"

    def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
        return (row for batch in batches for row in zip(*(batch.column(x).to_pylist() for x in names), strict=True))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for place, rows in groupby(rows_of(batches, "path", "start", "quoted", "line"), key=lambda r: r[:3]):
            yield from _batches(_range_rows(*place, (r[3] for r in rows)))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(_joined(rows_of(batches, "path", "start", "nth", "fragment")))

    pieces = written(here.select("path", "start", c("of").isNotNull().alias("quoted"), "line").mapInArrow(parse, fields), "csv-pieces")
    cut = pieces.where("fragment IS NOT NULL").repartition("path").sortWithinPartitions("path", "start", "nth")  # two rows per range at most
    whole = pieces.where("fragment IS NULL").union(cut.mapInArrow(join, fields)).select("path", "start", "nth", "cells")
    counts = whole.groupBy("path", "start").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = written(counts.select("path", "start", before.alias("before")), "csv-offsets")  # a row per range
    return whole.join(offsets, ["path", "start"]).select("path", (c("before") + c("nth")).alias("ordinal"), "cells")

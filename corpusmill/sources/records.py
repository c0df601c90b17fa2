"""Records of delimited text with line breaks inside quotes, read by many tasks to a file.

Lines are read from byte ranges, as of any text. Whether a range begins inside a quoted value is not known in its task, so
1. a task follows its lines from both beginnings, outside and inside, and sends one row: where each of them ends. Only lines
   with a quote are looked at;
2. the ranges of a file, put one after another, tell how each of them really begins;
3. a task puts the lines of its ranges together to records. What lies before the first end of a record, in a range that begins
   inside one, and after the last end is sent as a piece. Only pieces are shuffled, and meet by their record.

The ranges that cut a record are read once more for their pieces. All this costs a multiple of the CPU time of one plain scan, so
it pays for files much larger than what one task should read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.sources.staging import stage

# Beginnings are sent to every task up to this many ranges (128 TB in ranges of 128 MB, some 100 MB in the task); beyond, lines
# are shuffled by their range.
MAX_RANGES = 1_000_000

_WHOLE, _OPENING, _MIDDLE, _CLOSING = range(4)
_EMPTY = ("", "\r")
_MAPS = "file string, start long, from_outside boolean, from_inside boolean"
_MAP_NAMES = ["file", "start", "from_outside", "from_inside"]
_PARTS = "code long, part int, first boolean, record string"
_PART_NAMES = ["code", "part", "first", "record"]


def ends_inside(line: str, inside: bool, sep: str) -> bool:
    """Whether a line ends inside a quoted value, if it begins inside one or at a value.

    Only a value that begins with a quote is quoted; two quotes in it are one; what follows its end belongs to it up to ``sep``.
    """
    at = 0
    while True:
        if not inside:
            if not line.startswith('"', at):
                at = line.find(f'{sep}"', at)
                if at < 0:
                    return False
                at += len(sep)
            at += 1
        at = line.find('"', at)
        while at >= 0 and line.startswith('"', at + 1):
            at = line.find('"', at + 2)
        if at < 0:
            return True
        at = line.find(sep, at + 1)
        if at < 0:
            return False
        at += len(sep)
        inside = False


def _range_maps(sep: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Where each range ends, begun outside and inside; from its lines with a quote only, as others end as they begin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, outside, inside = None, False, True
        for batch in batches:
            done = []
            for file, start, line in zip(*(c.to_pylist() for c in batch.columns)):
                if (file, start) != here:
                    if here:
                        done.append((*here, outside, inside))
                    here, outside, inside = (file, start), False, True
                outside, inside = ends_inside(line, outside, sep), ends_inside(line, inside, sep)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=_MAP_NAMES)
        if here:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*here, outside, inside)], names=_MAP_NAMES)

    return run


class _Assembly:
    """Puts the lines of one range after another together to whole records, or to the pieces of records that the borders cut."""

    def __init__(self, sep: str, pieces: bool):
        self.sep, self.pieces, self.code = sep, pieces, -1
        self.held: list[str] = []
        self._clear()

    def _clear(self) -> None:
        self.codes, self.parts, self.firsts, self.records = [], [], [], []

    def _add(self, part: int, records: list[str]) -> None:
        if self.pieces == (part != _WHOLE):
            self.codes += [self.code] * len(records)
            self.parts += [part] * len(records)
            self.firsts += [False] * len(records)
            self.records += records
        if self.first:
            filled = next((i for i, r in enumerate(records) if r not in _EMPTY), None)
            if filled is not None:
                self.first = False
                if self.pieces == (part != _WHOLE):
                    self.firsts[filled - len(records)] = True

    def end_range(self) -> None:
        if self.held:
            self._add(_MIDDLE if self.cut else _OPENING, ["\n".join(self.held)])

    def begin_range(self, code: int) -> None:
        self.end_range()
        self.code, self.held = code, []
        self.inside = self.cut = code & 2 > 0
        self.first = code & 1 > 0

    def plain(self, lines: pa.Array) -> None:
        """Lines without a quote: more of the value that is open, or a record each."""
        if self.inside:
            self.held += lines.to_pylist()
        elif self.first or not self.pieces:
            self._add(_WHOLE, lines.to_pylist())

    def quoted(self, line: str) -> None:
        self.held.append(line)
        self.inside = ends_inside(line, self.inside, self.sep)
        if not self.inside:
            self._add(_CLOSING if self.cut else _WHOLE, ["\n".join(self.held)])
            self.held, self.cut = [], False

    def taken(self) -> Iterator[pa.RecordBatch]:
        if self.records:
            columns = [pa.array(self.codes, pa.int64()), pa.array(self.parts, pa.int32()), pa.array(self.firsts, pa.bool_()),
                       pa.array(self.records, pa.string())]
            self._clear()
            yield pa.RecordBatch.from_arrays(columns, names=_PART_NAMES)


def _assemble(sep: str, pieces: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _Assembly(sep, pieces)
        for batch in batches:
            codes, lines = batch.column(0).to_numpy(), batch.column(1)
            places = np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))
            quoted = dict(zip(places.tolist(), lines.take(pa.array(places)).to_pylist()))
            changes = np.flatnonzero(np.diff(codes, prepend=state.code))
            at = 0
            for stop in sorted({*changes.tolist(), *quoted, len(codes)}):
                if stop > at:
                    state.plain(lines.slice(at, stop - at))
                at = stop
                if stop < len(codes) and codes[stop] != state.code:
                    state.begin_range(int(codes[stop]))
                if stop in quoted:
                    state.quoted(quoted[stop])
                    at = stop + 1
            yield from state.taken()
        state.end_range()
        yield from state.taken()

    return run


def _beginnings(maps: DataFrame) -> DataFrame:
    """(file, start, code, cut): a range that ends alike from both beginnings decides, those after it keep or turn that."""
    ordered = Window.partitionBy("file").orderBy("start")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    turns = F.sum((F.col("from_outside") & ~F.col("from_inside")).cast("int")).over(ordered)
    decided = F.when(F.col("from_outside") == F.col("from_inside"), F.struct("from_outside", "turns"))
    outside = F.struct(F.lit(False).alias("from_outside"), F.lit(0).cast("long").alias("turns"))
    known = F.coalesce(F.last(decided, ignorenulls=True).over(before), outside)
    table = maps.withColumn("turns", turns).withColumns({"known": known, "turned": F.coalesce(F.lag("turns").over(ordered), F.lit(0))})
    table = table.withColumn("begins", F.col("known.from_outside") != ((F.col("turned") - F.col("known.turns")) % 2 == 1))
    ends = F.when(F.col("begins"), F.col("from_inside")).otherwise(F.col("from_outside"))
    # One number for a range, whether it begins inside, and whether it is the first of its file.
    code = F.monotonically_increasing_id() * 4 + F.col("begins").cast("int") * 2 + (F.col("start") == 0).cast("int")
    return table.select("file", "start", code.alias("code"), (F.col("begins") | ends).alias("cut"))


def _coded(lines: DataFrame, ranges: DataFrame, most: int) -> DataFrame:
    """(code, line) with the lines of each range in order in one task."""
    if ranges.count() <= most:
        return lines.join(F.broadcast(ranges), ["file", "start"]).select("code", "line")
    numbered = lines.withColumn("number", F.monotonically_increasing_id()).join(ranges, ["file", "start"])
    return numbered.repartition("code").sortWithinPartitions("code", "number").select("code", "line")


def read_records(spark: SparkSession, path: str, sep: str, most: int = MAX_RANGES) -> DataFrame:
    """(record, first) of all text files under ``path``: each record with its line breaks, without the one that ends it.

    ``first`` marks the first record of a file that is not empty. Lines end with a line feed, with or without a carriage return.
    Quotes that are never closed reach to the end of the file. Empty records are left out. The ranges are made when this
    is called, so files must not change before the result is read.
    """
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.make_valid_utf8("value").alias("line"))
    maps = lines.where(F.col("line").contains('"')).mapInArrow(_range_maps(sep), _MAPS)
    ends = lines.groupBy("file", "start").agg(F.lit(False).alias("from_outside"), F.lit(True).alias("from_inside"))
    maps = ends.unionByName(maps).groupBy("file", "start").agg(
        F.bool_or("from_outside").alias("from_outside"), F.bool_and("from_inside").alias("from_inside"))
    ranges = stage(_beginnings(maps), "ranges")
    whole = _coded(lines, ranges, most).mapInArrow(_assemble(sep, pieces=False), _PARTS)
    cut = ranges.where("cut")
    pieces = _coded(lines, cut, most).mapInArrow(_assemble(sep, pieces=True), _PARTS)
    pieces = pieces.join(F.broadcast(cut) if cut.count() <= most else cut, "code")

    # A closing piece comes before the opening one of its range.
    opens = F.col("part") == _OPENING
    in_file = Window.partitionBy("file").orderBy("start", opens).rowsBetween(Window.unboundedPreceding, 0)
    named = pieces.withColumn("number", F.sum(opens.cast("long")).over(in_file))
    joined = named.groupBy("file", "number").agg(
        F.sort_array(F.collect_list(F.struct("start", "record"))).alias("pieces"), F.max("first").alias("first"))
    joined = joined.select(F.concat_ws("\n", "pieces.record").alias("record"), "first")

    record = F.regexp_replace(F.when(F.col("first"), F.regexp_replace("record", "^\ufeff", "")).otherwise(F.col("record")), "\r\\z", "")
    found = whole.select("record", "first").unionByName(joined).withColumn("record", record)
    return found.where(F.length("record") > 0)


def parse_records(records: DataFrame, schema: T.StructType, sep: str, header: bool, options: dict) -> DataFrame:
    """The columns of ``schema``; the first record of each file must be its names if ``header``. A bad record fails the job."""
    options = {**{k: str(o) for k, o in options.items()}, "sep": sep, "multiLine": "true", "lineSep": "\n", "mode": "FAILFAST"}
    if header:
        names = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(schema))])
        found = F.from_csv("record", names.simpleString()[7:-1].replace(":", " "), options)
        same: Column = F.lit(True)
        for field, column in zip(schema, names):
            same = same & found[column.name].eqNullSafe(F.lit(field.name))
        wrong = F.raise_error(F.concat(F.lit("the header names other columns: "), F.col("record")))
        records = records.where(~F.col("first") | F.when(same, F.lit(False)).otherwise(wrong.cast("boolean")))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return records.select(F.from_csv("record", ddl, options).alias("row")).select("row.*")

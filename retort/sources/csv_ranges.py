"""CSV with quoted line breaks, read in parallel byte ranges (A1).

Spark's own CSV reader splits a file only where no value may hold a line break. Here a file is read as text, so
in many byte ranges, and the records are put together from physical lines. Whether a range begins inside a
quoted value cannot be known from the range alone:

1. A first scan walks each range under both assumptions at once and gives one row a range: the state at its end
   from either, and whether a record that begins in it is open there.
2. Per file, the ranges' effects are composed in order. An effect keeps the state, turns it over, or ends in one
   state whatever came before; so the state at a range's start is the last such end, turned over as often as the
   ranges after it do. That is a running window over one row a range.
3. A second scan of the same ranges, their states known, joins each record's lines in place. Only the pieces of
   a record that crosses a range's end are grouped, one or two a range.

Both scans must split files alike, so they read through a session of their own, whose split size is fixed (the
default follows the executors at hand). Records are parsed by Spark's CSV parser (``from_csv``).
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retort.session import scratch_path

#: Ranges of one read, small files and the rest of each apart: bounds the broadcast table of their states.
MOST_RANGES = 200_000
#: Bytes of a range, at most, while there are no more than MOST_RANGES.
RANGE_BYTES = 128 << 20
_CLOSE = re.compile(r'(?:[^"]++|"")*+"')


def ends_inside(line: str, inside: bool, opening: re.Pattern) -> bool:
    """Whether a quoted value is open at the end of the line. A quote opens a value only at its first letter, as
    in Spark's reader; within quotes two stand for one."""
    at = 0
    while True:
        if inside:
            m = _CLOSE.match(line, at)
            if not m:
                return True
            at = m.end()
        m = opening.search(line, at)
        if not m:
            return False
        at, inside = m.end(), True


class _Lexer:
    """What lines do to the state, for whole batches: only what stands around quotes matters, so the lexer runs once
    for each different outline of a batch's lines."""

    def __init__(self, sep: str):
        self.opening = re.compile(rf'(?:^|{re.escape(sep)})"')
        self.plain = rf'[^"]*[^"{re.escape(sep)}]'

    def effects(self, value: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """For each line the state it ends in from outside, and from inside."""
        end0, end1 = np.zeros(len(value), bool), np.ones(len(value), bool)
        at = np.flatnonzero(pc.match_substring(value, '"').to_numpy(zero_copy_only=False))
        if len(at):
            outline = pc.replace_substring_regex(value.take(pa.array(at)), self.plain, "x").dictionary_encode()
            different, code = outline.dictionary.to_pylist(), outline.indices.to_numpy(zero_copy_only=False)
            for state, end in ((False, end0), (True, end1)):
                end[at] = np.array([ends_inside(t, state, self.opening) for t in different])[code]
        return end0, end1


def _after(state: bool, end0: np.ndarray, end1: np.ndarray) -> np.ndarray:
    """The state after each line, from ``state`` before the first: the last line that ends in one state whatever came
    before, turned over by the lines after it that turn it over."""
    turns = np.cumsum(end0 & ~end1)
    fixed = np.maximum.accumulate(np.where(end0 == end1, np.arange(len(end0)), -1))
    since = turns - np.where(fixed >= 0, turns[fixed], 0)
    return np.where(fixed >= 0, end0[fixed], state) ^ (since % 2 == 1)


def _stretches(batches, columns):
    """(key, batch) for stretches of rows with the same (file, range); the rows of a range come in a row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        code = [batch.column(c).dictionary_encode().indices.to_numpy(zero_copy_only=False) for c in ("file", "range")]
        change = np.flatnonzero((np.diff(code[0]) != 0) | (np.diff(code[1]) != 0)) + 1
        for a, b in zip([0, *change.tolist()], [*change.tolist(), batch.num_rows]):
            part = batch.slice(a, b - a)
            yield tuple(part.column(c)[0].as_py() for c in columns), part


EFFECTS = "file string, range long, end0 boolean, end1 boolean, began0 boolean, began1 boolean, crlf boolean"


def _effects(lines: DataFrame, sep: str) -> DataFrame:
    """One row for each range and task: the state at its end from outside and inside, whether the record open there
    began in the range, and whether its first line ends in a carriage return."""
    def walk(batches):
        lexer, at, row = _Lexer(sep), None, None
        out = lambda r: pa.RecordBatch.from_arrays([pa.array([x]) for x in r], names=[c.split()[0] for c in EFFECTS.split(", ")])
        for key, part in _stretches(batches, ("file", "range")):
            value = part.column("value")
            if key != at:
                if at:
                    yield out((*at, *row))
                at, row = key, [False, True, False, False, value[0].as_py().endswith("\r")]
            effects = lexer.effects(value)
            for h in (0, 1):
                after = _after(row[h], *effects)
                row[2 + h] = bool(after[-1]) and (row[2 + h] or not row[h] or not after[:-1].all())
                row[h] = bool(after[-1])
        if at:
            yield out((*at, *row))

    return lines.mapInArrow(walk, EFFECTS)


def _states(effects: DataFrame) -> DataFrame:
    """(file, range, inside, from_range, crlf) of the ranges that don't begin a file: whether they begin inside quotes,
    in which range the record open there begins, and whether the file's lines end in both characters."""
    order = Window.partitionBy("file").orderBy("range")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # turned: how many ranges up to here turn the state over; fixed: a range that ends in one state, less the turns so far
    turns = F.when(F.expr("end0 and not end1"), 1).otherwise(0)
    ranges = effects.withColumn("crlf", F.first("crlf").over(order)).withColumn("turned", F.sum(turns).over(order))
    ranges = ranges.withColumn("fixed", F.expr("if(end0 = end1, cast(end0 as int) ^ cast(turned % 2 as int), null)"))
    so_far = F.coalesce(F.sum(turns).over(before), F.lit(0)) % 2
    state = F.coalesce(F.last("fixed", ignorenulls=True).over(before), F.lit(0)).bitwiseXOR(so_far.cast("int"))
    ranges = ranges.withColumn("inside", state == 1)
    began = F.when(F.when(F.col("inside"), F.col("began1")).otherwise(F.col("began0")), F.col("range"))
    ranges = ranges.withColumn("from_range", F.last(began, ignorenulls=True).over(before))
    return ranges.where("range > 0").select("file", "range", "inside", "from_range", "crlf")


RECORDS = "file string, range long, at long, piece boolean, head boolean, record string"


def _joined(lines: DataFrame, sep: str, header: bool) -> DataFrame:
    """The records of each range. Pieces of a record that crosses a range's end carry in ``at`` the range it begins in;
    ``head`` marks a file's first record."""
    names = [c.split()[0] for c in RECORDS.split(", ")]

    def walk(batches):
        lexer = _Lexer(sep)
        at, inside, start, crlf, head, open_lines = None, False, 0, False, False, []

        def rows(values, piece=False):
            nonlocal head
            n = len(values)
            first = [False] * n
            if head and n:
                first[0], head = True, False
            return pa.RecordBatch.from_arrays([pa.array([at[0]] * n, pa.string()), pa.array([at[1]] * n, pa.int64()), pa.array([start] * n, pa.int64()),
                                               pa.array([piece] * n, pa.bool_()), pa.array(first, pa.bool_()), values.cast(pa.string())], names=names)

        def text():
            return pa.array(["\n".join(open_lines)], pa.string())

        for key, part in _stretches(batches, ("file", "range", "inside", "from_range", "crlf")):
            value = part.column("value").cast(pa.string())
            if key[:2] != at:
                if open_lines:
                    yield rows(text(), piece=True)
                at, inside, crlf, open_lines = key[:2], bool(key[2]), bool(key[4]), []
                start = key[3] if inside else at[1]  # the range that the open record begins in
                if at[1] == 0:
                    crlf, head = value[0].as_py().endswith("\r"), header
                continued = inside  # whether the open record began in an earlier range
            if crlf:
                value = pc.replace_substring_regex(value, "\r$", "")
            after = _after(inside, *lexer.effects(value))
            begins = np.flatnonzero(~np.r_[inside, after[:-1]])
            first = int(begins[0]) if len(begins) else len(value)
            open_lines += value[:first].to_pylist()
            if open_lines and (len(begins) or not after[-1]):
                yield rows(text(), piece=continued)
                open_lines, continued, start = [], False, at[1]
            if len(begins):
                ends = np.r_[begins[1:], len(value)]
                if after[-1]:  # the last record goes on
                    open_lines = value[int(begins[-1]) :].to_pylist()
                    continued, start = False, at[1]
                    begins, ends = begins[:-1], ends[:-1]
                if len(begins):
                    lists = pa.ListArray.from_arrays(pa.array(np.r_[begins, ends[-1]], pa.int32()), value)
                    records = pc.replace_substring_regex(pc.binary_join(lists, "\n"), "\r$", "")
                    records = records.filter(pc.greater(pc.binary_length(records), 0))
                    if len(records):
                        yield rows(records)
            inside = bool(after[-1])
        if open_lines:
            yield rows(text(), piece=True)

    return lines.mapInArrow(walk, RECORDS)


def csv_records(spark: SparkSession, path, sep: str = ",", header: bool = True, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(file, record) of every CSV record of ``path`` (a file, folder or list), but for each file's first where that is a
    ``header``: the whole text of the record with the line breaks inside its quoted values. Records end at a line
    feed, or carriage return and line feed, outside quotes; blank ones are left out. In a file whose first line
    ends in both, breaks inside values become line feeds, as Spark's reader has them.

    The records are written once in the checkpoint folder. A file whose last quote is never closed has all
    that follows it as one record."""
    total = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0] or 0  # lists files, reads none
    pinned = spark.newSession()
    pinned.conf.set("spark.sql.files.maxPartitionBytes", str(max(range_bytes, total // MOST_RANGES)))
    pinned.conf.set("spark.sql.files.openCostInBytes", str(min(range_bytes, 4 << 20)))
    pinned.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    text = pinned.read.option("lineSep", "\n").text(path)
    lines = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"), "value")
    table = scratch_path(spark, "csv-effects")
    _effects(lines, sep).write.parquet(table)
    states = _states(pinned.read.schema(EFFECTS).parquet(table))
    known = lines.join(F.broadcast(states), ["file", "range"], "left")  # MOST_RANGES rows at most
    table = scratch_path(spark, "csv-records")
    _joined(known, sep, header).write.option("compression", "zstd").parquet(table)
    records = spark.read.schema(RECORDS).parquet(table)
    whole = records.where("not piece and not head").select("file", "record")
    # the pieces of one record
    pieces = records.where("piece").groupBy("file", "at").agg(F.array_sort(F.collect_list(F.struct("range", "record"))).alias("p"), F.bool_or("head").alias("head"))
    joined = pieces.where("not head").select("file", F.regexp_replace(F.array_join(F.col("p")["record"], "\n"), "\r$", "").alias("record"))
    return whole.unionByName(joined).where(F.length("record") > 0)


def read_csv(spark: SparkSession, path, sep: str = ",", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All columns of CSV files with a header, as strings, like Spark's reader with ``multiLine``, ``header`` and
    ``escape='"'``, in many tasks a file. Columns are named by the first file's header; each file's first
    record is its header. Rows are in no order. Fails where the path cannot be read or has no column."""
    options = {"sep": sep, "escape": '"', "multiLine": "true"}
    schema = spark.read.options(**options, header=True).csv(path).schema
    if not schema.fields:
        raise ValueError(f"{path} has no columns")
    ddl = ", ".join("`" + f.name.replace("`", "``") + "` STRING" for f in schema.fields)
    return csv_records(spark, path, sep, range_bytes=range_bytes).select(F.from_csv("record", ddl, options).alias("row")).select("row.*")

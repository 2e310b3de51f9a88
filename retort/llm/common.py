"""Helpers shared by the corpus operators: Arrow batches cut by bytes, intermediate tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retort.session import scratch_path

#: Python work goes over this many text bytes at a time, whatever the size of Spark's Arrow batches.
SLICE_BYTES = 8 << 20


def materialize(df: DataFrame, name: str, group_bytes: int | None = None) -> DataFrame:
    """Write ``df`` once as compressed Parquet in the shared folder that ``spark.checkpoint.dir`` names and
    read it back: cuts lineage in a way that outlives executors, and gives the planner the table's real
    size. Spark's own reader and writer do it, so any store will do. ``group_bytes``: of a row group, for rows
    of megabytes; Parquet's writer else looks at its buffers after a hundred rows only."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    if group_bytes:
        writer = writer.options(**{"parquet.block.size": group_bytes, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1})
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def byte_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows holding at most ``limit`` bytes of ``column`` (one row at least)."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start, base = 0, 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start, base = stop, int(ends[stop - 1])


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [t or "" for t in batch.column(column).to_pylist()]


def bytes_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def per_text(docs: DataFrame, schema: str, fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch] | pa.RecordBatch],
             columns: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """Run ``fn`` on byte-bounded slices of the named columns of ``docs`` (other columns are not read)."""
    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, "text"):
                out = fn(part)
                if isinstance(out, pa.RecordBatch):
                    yield out
                else:
                    yield from out

    return docs.select(*[F.col(c) for c in columns]).mapInArrow(run, schema)

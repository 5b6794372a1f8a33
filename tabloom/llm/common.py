"""Tables between steps, and groups of rows inside tasks."""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.session import scratch_path


#: Rows of a file, if the number of rows is known and each core has two files.
FILE_ROWS = 200_000


def kept(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Written once to the shared folder and read from there: lineage ends, executors may be lost.

    ``rows``: how many there are at most, if known. A small table is then written as fewer files than shuffle partitions.
    """
    path = scratch_path(df.sparkSession, name)
    if rows is not None:
        df = df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-rows // FILE_ROWS)))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def on_executors(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow(run, schema)``, with this package sent to the executors once a session."""
    sc = df.sparkSession.sparkContext
    if sc.applicationId not in _shipped:
        package, archive = os.path.dirname(os.path.dirname(os.path.abspath(__file__))), io.BytesIO()
        with zipfile.ZipFile(archive, "w") as z:
            for folder, _, names in os.walk(package):
                for path in (os.path.join(folder, n) for n in names if n.endswith(".py")):
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
        to = sc._jvm.org.apache.hadoop.fs.Path(f"{scratch_path(df.sparkSession, 'code')}/tabloom.zip")
        out = to.getFileSystem(sc._jsc.hadoopConfiguration()).create(to)
        out.write(archive.getvalue())
        out.close()
        sc.addPyFile(to.toString())
        _shipped.add(sc.applicationId)
    return df.mapInArrow(run, schema)


_owner: list = [None, None]


def claim(owner: str, clear: Callable[[], None]) -> None:
    """Called by a task that fills tables in its Python worker: the tables of another operator, which used the worker
    before, are emptied. Workers outlive stages, and their memory counts against the executor's."""
    if _owner[0] not in (None, owner):
        _owner[1]()
        pa.default_memory_pool().release_unused()
    _owner[:] = [owner, clear]


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that a task holds few texts as Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def coded(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Where each row's values begin (and the last ends), a code for every value, and the distinct values by code."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    values = lists.flatten().dictionary_encode()
    return offsets - offsets[0], values.indices.to_numpy(zero_copy_only=False).astype(np.int64), values.dictionary.to_pylist()


def spelt_out(parts: Sequence[bytes], codes: np.ndarray, kind=np.uint32) -> tuple[np.ndarray, np.ndarray]:
    """The numbers packed in ``parts``, in the order of ``codes``, and where those of each code begin (and the last end)."""
    numbers = np.frombuffer(b"".join(parts), kind)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // np.dtype(kind).itemsize
    own = sizes[codes]
    ends = np.cumsum(own)
    starts = (np.cumsum(sizes) - sizes)[codes]
    total = int(ends[-1]) if len(ends) else 0
    return numbers[np.repeat(starts - (ends - own), own) + np.arange(total)], np.concatenate([np.zeros(1, np.int64), ends])


def schema_with(df: DataFrame, without: Sequence[str], more: str) -> str:
    """The columns of ``df`` but some, and more, as a schema string."""
    held = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in without]
    return ", ".join([*held, more])


def blocked(df: DataFrame, keys: Sequence[str], member: Column, blocks: Column) -> DataFrame:
    """``df`` with ``block_a`` <= ``block_b``: each row once for every pair of blocks that its own block is part of.

    A group of one block stays as it is. Any two rows of a group meet in the pair of their blocks, so a group of any
    size is compared whole by tasks of two blocks each.
    """
    own = F.pmod(F.xxhash64(member), F.col("_blocks")).cast("int")
    spread = df.withColumn("_blocks", blocks.cast("int")).withColumn("_own", own)
    spread = spread.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return spread.select(
        *[c for c in df.columns], F.least("_own", "_other").alias("block_a"), F.greatest("_own", "_other").alias("block_b"),
    )


def groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Runs of whole groups from rows sorted by ``keys`` (integers): a table, and where each group starts and the end."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < 2000:
            continue
        table = pa.Table.from_batches(held)
        starts = _starts(table, keys)
        if len(starts) > 1:
            yield table.slice(0, int(starts[-1])), starts
            held = table.slice(int(starts[-1])).to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, np.append(_starts(table, keys), table.num_rows)


def _starts(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for k in keys:
        column = table.column(k).to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


class Forest:
    """Which members of a small group are linked; keeps only the links that join two parts."""

    def __init__(self, size: int):
        self.root = list(range(size))
        self.links: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        while self.root[x] != x:
            self.root[x] = self.root[self.root[x]]
            x = self.root[x]
        return x

    def link(self, a: int, b: int) -> None:
        p, q = self.find(a), self.find(b)
        if p != q:
            self.root[max(p, q)] = min(p, q)
            self.links.append((a, b))

"""Arrow batches of text as flat byte buffers, and tables that cut lineage.

Every operator of this subpackage that runs Python gets its rows through ``mapInArrow``. The helpers here cut the
batches into pieces of bounded size, whatever the number of rows in a batch, and expose the UTF-8 bytes of a text
column as one numpy array, so that the work is vectorised over many documents at once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that are worked on at once.
PIECE = 2_000_000
#: Rows and bytes that Spark puts into an Arrow batch for a Python worker.
BATCH_ROWS, BATCH_BYTES = 2_000, 16_000_000


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small: texts may be long, and a batch is held whole by a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets of its rows; a null row has no bytes."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if len(column) else np.zeros(0, np.uint8)
    return data, offsets - (offsets[0] if len(column) else 0)


def pieces(batches: Iterator[pa.RecordBatch], text: str, limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most ``limit`` bytes of text, or of one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = text_bytes(batch[text])[1][1:]
        first = 0
        while first < batch.num_rows:
            base = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(first, last - first)
            first = last


def word_spans(data: np.ndarray, offsets: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every run of bytes that ``space`` (256 booleans) does not hold; no run crosses rows."""
    n = len(data)
    solid = np.zeros(n + 2, np.bool_)
    solid[1:-1] = ~space[data]
    bounds = np.zeros(n + 1, np.bool_)
    bounds[offsets] = True
    starts = np.flatnonzero(solid[1:-1] & (~solid[:-2] | bounds[:n])) if n else np.zeros(0, np.int64)
    ends = np.flatnonzero(solid[1:-1] & (~solid[2:] | bounds[1:])) + 1 if n else np.zeros(0, np.int64)
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def stretches(*keys: np.ndarray) -> list[tuple[int, int]]:
    """Bounds of the runs of rows that agree in all of the sorted keys; none for no rows."""
    n = len(keys[0])
    if not n:
        return []
    new = np.zeros(n, np.bool_)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    first = np.flatnonzero(new)
    return list(zip(first.tolist(), [*first[1:].tolist(), n], strict=True))


#: The ASCII white space of the contracts: space, and tab to carriage return.
SPACE = np.zeros(256, np.bool_)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z; all other bytes stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_ODD = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_ODD, -1, 1 << 64)
_CODES = np.random.default_rng(20240607).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


#: Other codes, for ranges that 128 bits have to tell apart.
MORE_CODES = np.random.default_rng(20250131).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers whose output bits depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class RollingHash:
    """64-bit hashes of any byte ranges of one buffer, after one pass over it.

    Prefix sums of ``code[byte] * base ** position`` modulo 2 ** 64; the base is odd, so a range's sum is moved to
    position 0 by the inverse's power. A hash depends on the bytes of the range alone, in every process.
    """

    def __init__(self, data: np.ndarray, codes: np.ndarray = _CODES):
        n = len(data)
        terms = codes[data]
        terms *= _powers(_ODD, n)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(terms, out=self.sums[1:])
        self.back = _powers(_INVERSE, n + 1)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.back[starts]
        return mixed(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def window_hashes(items: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive item hashes, in order."""
    if len(items) < n:
        return np.zeros(0, np.uint64)
    factors = _powers(_ODD, n)
    out = np.zeros(len(items) - n + 1, np.uint64)
    for k in range(n):
        out += items[k : k + len(out)] * factors[k]
    return mixed(out)


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the one that the cluster shares; a machine-local default only where none is set."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        kept = spark.sparkContext.getCheckpointDir()
        if not kept:
            import tempfile

            if spark.sparkContext.master.split("[")[0] != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")

            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lattix-"))
            kept = spark.sparkContext.getCheckpointDir()
        top = kept
    return f"{top.rstrip('/')}/lattix-{uuid.uuid4().hex}"


def written(df: DataFrame, instead_of: DataFrame | None = None) -> DataFrame:
    """The frame, computed once and kept as a table in the shared folder: it survives the loss of any executor.

    The folder goes when the session ends; that of ``instead_of``, an earlier round that nothing needs any more, at once.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    df.write.parquet(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.deleteOnExit(path)
    if instead_of is not None:
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(instead_of.written_to), True)
    out = spark.read.schema(df.schema).parquet(folder)
    out.written_to = folder
    return out


def told_by(rows: DataFrame, named: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` joined with ``named``, a written table that has one row a key and in n how many rows hold it.

    Keys that hold a thousandth of all rows or more, of which there are at most a thousand, go to every task, so that
    no task gathers the rows of one; all others meet in a shuffle.
    """
    total = named.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = F.broadcast(named.where(F.col("n") * 1000 >= total))
    return rows.join(hot, keys).unionByName(rows.join(hot.select(*keys), keys, "left_anti").join(named, keys)).drop("n")


def mapped(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    bounded_batches(df.sparkSession)
    return df.mapInArrow(function, schema)

"""Helpers shared by the training-data operators.

Texts reach the Python workers as Arrow batches; `text_batches` cuts them into
blocks of a bounded number of bytes, so that the numpy arrays made from a block
stay small whatever the batch size or the corpus. A null text counts as empty.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketlens.session import ensure_checkpoint_dir

BLOCK_BYTES = 2 << 20
#: A batch ends at so many rows or bytes, which bounds the workers' and Spark's Arrow buffers.
ARROW_LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000,
                "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20}

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_rng = np.random.default_rng(20240229)
#: Random odd weights of the byte values, one row for each of two independent hashes.
BYTE_WEIGHTS = _rng.integers(1, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASES = _rng.integers(2**40, 2**62, 4, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- shared folder ---------------------------------------------------------

_scratch: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """This session's own folder below the shared checkpoint folder.

    It is dropped through Spark's file system layer when the driver ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = ensure_checkpoint_dir(spark) or tempfile.mkdtemp(prefix="marketlens-")
    app = spark.sparkContext.applicationId
    if app not in _scratch:
        _scratch[app] = f"{base.rstrip('/')}/marketlens-llm-{uuid.uuid4().hex}"
        atexit.register(_drop, spark, _scratch[app])
    return _scratch[app]


def _drop(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is None:  # already stopped
        return
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


#: Paths that `materialize` has written.
written: list[str] = []


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, and a
    lost executor loses nothing of it."""
    path = f"{scratch_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    written.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, paths: list[str]) -> None:
    """Drop tables of `materialize` that no result needs any more."""
    for path in paths:
        _drop(spark, path)
        written.remove(path)


def broadcast_if_small(df: DataFrame, max_rows: int = 50_000) -> DataFrame:
    """``df`` written out, and hinted for broadcast only if it has at most ``max_rows`` rows."""
    done = materialize(df, "side")
    return F.broadcast(done) if done.limit(max_rows + 1).count() <= max_rows else done


def ship(spark: SparkSession) -> None:
    """Give the executors this package, wherever the driver was started."""
    sc = spark.sparkContext
    if getattr(sc, "_marketlens_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="marketlens-ship-"), "marketlens_pkg.zip")
    with zipfile.ZipFile(path, "w") as z:
        for d, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.join("marketlens", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._marketlens_shipped = True


def out_schema(df: DataFrame, keep, more: str) -> StructType:
    """The ``keep`` columns of ``df`` as they are, and those of the DDL ``more``."""
    return StructType([df.schema[c] for c in keep] + StructType.fromDDL(more).fields)


def arrow_map(df: DataFrame, fn, schema: str | StructType) -> DataFrame:
    """`mapInArrow` with the package shipped and batches of few rows, so that a
    batch of long texts fits a worker."""
    spark = df.sparkSession
    ship(spark)
    for name, most in ARROW_LIMITS.items():
        now = spark.conf.get(name)
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(name, str(most))
    return df.mapInArrow(fn, schema)


# --- blocks of texts -------------------------------------------------------

@dataclass
class Block:
    """Some rows: ``data`` holds their UTF-8 bytes end to end, row r is
    ``data[offsets[r]:offsets[r + 1]]``; ``batch`` has the rows' other columns."""
    batch: pa.RecordBatch
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string or binary column, nulls as empty."""
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or
                              pa.types.is_large_string(column.type) else b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[
        column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def text_batches(batches: Iterator[pa.RecordBatch], text: str = "text",
                 limit: int = BLOCK_BYTES) -> Iterator[Block]:
    for batch in batches:
        data, offsets = utf8(batch.column(text))
        a, n = 0, batch.num_rows
        while a < n:
            b = int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1
            b = min(max(b, a + 1), n)
            yield Block(batch.slice(a, b - a), data[offsets[a]:offsets[b]],
                        offsets[a:b + 1] - offsets[a])
            a = b


# --- words and hashes ------------------------------------------------------

def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


#: Bytes of words: everything but blank, tab and the line breaks 0x0A-0x0D.
PLAIN_WORD = np.ones(256, bool)
PLAIN_WORD[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of words in benchmark matching: digits, letters, all of U+0080 and up.
ALNUM_WORD = np.zeros(256, bool)
ALNUM_WORD[0x30:0x3A] = ALNUM_WORD[0x41:0x5B] = ALNUM_WORD[0x61:0x7B] = ALNUM_WORD[0x80:] = True
#: Lower-cases A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
    """Start and end bytes of the words, and the word offsets of the rows."""
    flag = is_word[data]
    n = len(flag)
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = flag[:-1], flag[1:]
    inner = offsets[1:-1]
    before[inner[inner < n]] = False
    after[inner[inner > 0] - 1] = False
    starts = np.flatnonzero(flag & ~before)
    ends = np.flatnonzero(flag & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each word's bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lens = ends - starts
    first = np.cumsum(lens) - lens
    total = int(lens.sum())
    rel = np.arange(total) - np.repeat(first, lens)
    at = rel + np.repeat(starts, lens)
    powers = np.cumprod(np.full(int(lens.max()), BASES[seed], np.uint64))
    return mix(np.add.reduceat(BYTE_WEIGHTS[seed][data[at]] * powers[rel], first)
               + lens.astype(np.uint64))


def gram_hashes(h: np.ndarray, k: int, seed: int = 2) -> np.ndarray:
    """Hash of the k values from each position on (len(h) - k + 1 results)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * BASES[seed] + h[j:j + n]
    return mix(out)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of the w values from each position on."""
    size = 1
    while size * 2 <= w:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    if size < w:
        x = np.minimum(x[:len(x) - (w - size)], x[w - size:])
    return x


def sha256_of(parts: list[bytes]) -> str:
    import hashlib
    h = hashlib.sha256()
    for p in parts:
        h.update(p)
    return h.hexdigest()


def out_batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type)
         for f, c in ((f, columns[f.name]) for f in schema)], schema=schema)


def least_copy(df: DataFrame, key: str, order: str) -> DataFrame:
    """Smallest ``order`` of each ``key``, summed up before the shuffle (nulls last)."""
    return df.groupBy(key).agg(F.min(order).alias("first_id"), F.count(F.lit(1)).alias("copies"))

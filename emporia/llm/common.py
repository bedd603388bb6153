"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from emporia.session import checkpoint_root

WORD_SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read of shared files, and what
    stands above is computed once however often it is used.
    """
    path = f"{checkpoint_root(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path  # for ``discard``
    return out


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession, size: str = "8m") -> None:
    """Arrow batches of ``size`` from here on in the session: for stages that are executed after they are returned."""
    spark.conf.set(BATCH_BYTES, size)


@contextmanager
def small_batches(spark: SparkSession, size: str = "8m") -> Iterator[None]:
    """Arrow batches of ``size`` for the Python stages that run inside, so that a worker holds few long rows at once.

    Spark bounds a batch by bytes as well as by rows; the session's own setting is put back afterwards.
    """
    before = spark.conf.get(BATCH_BYTES)
    bound_batches(spark, size)
    try:
        yield
    finally:
        bound_batches(spark, before)


def trimmed(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` of a ``mapInPandas`` or ``mapInArrow`` stage whose worker gives freed memory back to the system.

    Workers live on from stage to stage; what an allocator keeps of one stage's batches counts against the
    executor during the next.  Memory is given back at the start, at most once a second, and at the end.
    """

    def out(batches: Iterator) -> Iterator:
        give_back()
        last = time.monotonic()
        for frame in run(batches):
            yield frame
            del frame
            if time.monotonic() - last > 1:
                give_back()
                last = time.monotonic()
        give_back()

    return out


def give_back() -> None:
    """Return the free memory of Arrow's pool and, where the C library can, of its heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---- rolling hashes over bytes (numpy, wrap-around 64-bit arithmetic) ----
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))


def splitmix(x: np.ndarray) -> np.ndarray:
    x = (x + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SYMBOL = splitmix(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, grown by doubling."""
    for k, base in enumerate((_BASE, _BASE_INV)):
        while len(_POWERS[k]) < n:
            p = _POWERS[k]
            _POWERS[k] = np.concatenate([p, p * (p[-1:] * base)])
    return _POWERS[0][:n], _POWERS[1][:n]


class RollingHash:
    """Polynomial prefix hashes of one byte string: any substring's hash in O(1)."""

    def __init__(self, data: bytes | np.ndarray):
        a = np.frombuffer(data, np.uint8) if isinstance(data, bytes) else data
        up, self._down = _powers(len(a) + 1)
        self.prefix = np.zeros(len(a) + 1, np.uint64)
        np.cumsum(_SYMBOL[a] * up[: len(a)], out=self.prefix[1:])

    def spans(self, start, end) -> np.ndarray:
        return splitmix((self.prefix[end] - self.prefix[start]) * self._down[start])

    def windows(self, k: int) -> np.ndarray:
        """Hash of every length-``k`` window."""
        n = len(self.prefix) - 1
        if n < k:
            return np.zeros(0, np.uint64)
        return splitmix((self.prefix[k:] - self.prefix[: n - k + 1]) * self._down[: n - k + 1])


# ---- words of a batch of texts, vectorised ----
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[65:91] = True
_IS_WORD[128:] = True


def batch_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, byte length, 64-bit hash) of every word of the texts, in order.

    Words are maximal runs of digits, ASCII letters (lower-cased) and bytes of
    non-ASCII characters: the same words as the regular expression
    ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` finds after lower-casing A-Z.
    """
    joined = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8) if texts else np.zeros(0, np.uint8)
    mask = np.zeros(len(joined) + 2, np.int8)
    mask[1:-1] = _IS_WORD[joined]
    edge = np.diff(mask)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    bounds = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, np.int64)
    rows = np.searchsorted(bounds, starts, side="right")
    # Hashes are taken per block of texts so that the power tables stay small.
    hashes = np.zeros(len(starts), np.uint64)
    folded = _FOLD[joined]
    step = 1 << 20
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + step, side="right")))
        a, b = starts[lo], ends[hi - 1]
        hashes[lo:hi] = RollingHash(folded[a:b]).spans(starts[lo:hi] - a, ends[lo:hi] - a)
        lo = hi
    return rows, ends - starts, hashes


def as_bytes(values) -> list[bytes]:
    return [b"" if v is None else v.encode("utf-8", "surrogatepass") for v in values]


def discard(df: DataFrame) -> None:
    """Delete the scratch table behind a frame that ``written`` returned, once nothing lazy reads it."""
    path = getattr(df, "_scratch", None)
    if path:
        spark = df.sparkSession
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # type: ignore[attr-defined]
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

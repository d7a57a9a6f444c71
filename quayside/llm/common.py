"""Shared helpers: Arrow batch size, storage under the shared folder, words.

A *word* is a run of bytes other than space and \\x09-\\x0D. ``bytes.split()``
cuts at exactly these six characters, so it is used wherever words are needed
as values; ``WordTable`` finds the same words as offsets in one numpy pass.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quayside.session import checkpoint_root

# Rows per Arrow batch sent to Python: bounds a worker's memory at ~256 texts.
ARROW_ROWS = 256
# Texts are worked on in slices of about this many bytes.
SLICE_BYTES = 1 << 20


def python_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Keep Arrow batches small, so that long texts do not add up in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (cuts the lineage)."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch],
              schema) -> DataFrame:
    """``mapInArrow`` of a function on one batch; empty results are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out.num_rows:
                    yield out
    python_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def map_groups(df: DataFrame, keys: list[str], fn: Callable[[pa.Table], pa.RecordBatch | None],
               schema: str) -> DataFrame:
    """Apply ``fn`` to the rows of each key, key after key within a task.

    For many small groups of bounded size: one Arrow stream per task instead
    of one Python call frame per group. ``keys`` are integer columns without
    nulls.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def finish():
            out = fn(pa.Table.from_batches(held))
            held.clear()
            return out

        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys], axis=1)
            cuts = (np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist()
            if last is not None and (key[0] != last).any():
                cuts.insert(0, 0)
            start = 0
            for cut in cuts:
                if cut > start:
                    held.append(batch.slice(start, cut - start))
                out = finish()
                if out is not None and out.num_rows:
                    yield out
                start = cut
            held.append(batch.slice(start))
            last = key[-1]
        if held:
            out = finish()
            if out is not None and out.num_rows:
                yield out

    python_batches(df.sparkSession)
    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def byte_view(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array, nulls as ""; offsets start at 0."""
    if col.null_count:
        col = col.fill_null("")
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int64, len(col) + 1, col.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def slices(col: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes of text (one row at least)."""
    n = len(col)
    if not n:
        return
    _, off = byte_view(col)
    start = 0
    while start < n:
        end = int(np.searchsorted(off, off[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), n)
        yield start, end
        start = end


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_codes(seed: int) -> np.ndarray:
    """A 64-bit code for each byte value, from a seeded generator."""
    return np.random.default_rng(seed).integers(0, 2**64, 256, dtype=np.uint64)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)   # odd, so invertible mod 2**64
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


class WordTable:
    """Words of a slice of texts, in order.

    ``start``/``end``: byte range of each word in ``data``; ``doc``: row of
    each word; ``first``: index of each row's first word (one entry more than
    rows); ``hash(lane)``: a 64-bit hash of each word, equal for equal words.
    """

    def __init__(self, col: pa.Array, table: np.ndarray | None = None):
        """``table``: a byte value for each byte value, applied first."""
        self.data, self.off = byte_view(col)
        if table is not None:
            self.data = table[self.data]
        n = len(self.data)
        word = ~_WHITE[self.data]
        edge = np.zeros(n + 1, bool)
        if n:
            edge[0] = word[0]
            edge[1:n] = word[1:] & ~word[:-1]
            cut = self.off[1:-1]
            cut = cut[cut < n]
            edge[cut] |= word[cut]
        self.start = np.flatnonzero(edge[:n])
        stop = np.zeros(n + 1, bool)
        if n:
            stop[1:n] = word[:-1] & ~word[1:]
            stop[n] = word[-1]
            cut = self.off[1:-1]
            cut = cut[cut > 0]
            stop[cut] |= word[cut - 1]
        self.end = np.flatnonzero(stop)
        self.first = np.searchsorted(self.start, self.off)
        self.doc = np.repeat(np.arange(len(self.off) - 1), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.start)

    def hash(self, lane: int = 0) -> np.ndarray:
        """Polynomial hash of the word's byte codes mod 2**64, then mixed."""
        n = len(self.data)
        if not n or not len(self.start):
            return np.zeros(len(self.start), np.uint64)
        base = _BASES[lane]
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(byte_codes(11 + lane)[self.data] * powers(base, n), out=total[1:])
        back = powers(pow(base, -1, 2**64), n)
        value = (total[self.end] - total[self.start]) * back[self.start]
        return mix64(value + (self.end - self.start).astype(np.uint64))


def rolling(word_hash: np.ndarray, width: int, lane: int = 0) -> np.ndarray:
    """Hash of each run of ``width`` consecutive entries (all rows together;
    the caller drops runs that cross a row's end)."""
    n = len(word_hash)
    if n < width:
        return np.zeros(0, np.uint64)
    base = _BASES[lane] ^ 0x5851F42D4C957F2C   # stays odd
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(word_hash * powers(base, n), out=total[1:])
    back = powers(pow(base, -1, 2**64), n)
    return mix64((total[width:] - total[:-width]) * back[:n - width + 1])

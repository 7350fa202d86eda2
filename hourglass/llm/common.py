"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.session import materialize

TEXT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(column: str, n: int) -> Column:
    """crc32 of a column as text, modulo n; null ids count as the text ''."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def import_path(spark: SparkSession) -> None:
    """Let Python workers import the package from a plain checkout (no effect where it is installed)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in parts:
        env["PYTHONPATH"] = os.pathsep.join([*parts, root])


def map_arrow(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    import_path(df.sparkSession)
    return df.mapInArrow(run, schema)


# --- Arrow texts as one byte buffer -------------------------------------------

def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, target: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``target`` bytes each; a longer text has its own."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + target, side="right")) - 1
        hi = min(n, max(lo + 1, hi))
        yield lo, hi
        lo = hi


def pieces(data: np.ndarray, offsets: np.ndarray, target: int, overlap: int):
    """(first document, bytes, offsets, place of the bytes in the first document): documents of about ``target``
    bytes together, and longer ones in pieces that overlap by ``overlap`` bytes."""
    for lo, hi in slices(offsets, target):
        start, end = int(offsets[lo]), int(offsets[hi])
        if hi - lo > 1 or end - start <= 2 * target:
            yield lo, data[start:end], offsets[lo:hi + 1] - start, 0
            continue
        for at in range(start, max(end - overlap, start + 1), target):
            part = data[at:min(at + target + overlap, end)]
            yield lo, part, np.array([0, len(part)]), at - start


# --- 64-bit hashes of substrings ----------------------------------------------

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15


def _tables(seed: int):
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser on uint64."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class SubstringHash:
    """Hash of any substring of a buffer in constant time.

    Prefix sums of ``table[byte] * base**i`` modulo 2**64; a difference of two sums
    times the inverse power does not depend on where the substring stands.
    """

    def __init__(self, seed: int):
        base = (_BASE + 2 * seed * 0x632BE59BD9B4E019) & _MASK | 1
        self.table, self.base, self.inverse = _tables(seed), base, pow(base, -1, 1 << 64)
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) < n:
            self.up, self.down = (_powers(b, n + n // 4) for b in (self.base, self.inverse))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.up[:len(data)], out=out[1:])
        return out

    def of(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((prefix[end] - prefix[start]) * self.down[start] + (end - start).astype(np.uint64))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0], k = 1, 1
    while k < n:
        m = min(k, n - k)
        out[k:k + m] = out[:m] * np.uint64(pow(base, k, 1 << 64))
        k += m
    return out


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32  # A-Z only
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
NON_LETTERS = np.zeros(256, bool)
NON_LETTERS[[*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True


def words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray):
    """(start, end, document) of every run of non-separator bytes; texts do not touch."""
    inside = ~separators[data]
    padded = np.zeros(len(inside) + 2, bool)
    padded[1:-1] = inside
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    starts = np.flatnonzero(inside & (~padded[:-2] | first[:-1]))
    ends = np.flatnonzero(inside & (~padded[2:] | first[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


# --- bitmap filter --------------------------------------------------------------

BITMAP_BITS = 1 << 25  # 4 MiB whatever the input: more keys only mean more false positives


def bitmap(keys: DataFrame, column: str) -> np.ndarray:
    """Fixed-size bitmap of a long column's values (bit = value modulo BITMAP_BITS).

    A superset filter for map-side pruning; an exact join always follows. The
    aggregate returns at most BITMAP_BITS / 32768 rows of 4 KiB to the driver.
    """
    bit = F.pmod(F.col(column), F.lit(BITMAP_BITS)) + 1  # Spark numbers positions from 1
    rows = (keys.filter(F.col(column).isNotNull()).groupBy(F.bitmap_bucket_number(bit).alias("b"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")).collect())
    out = np.zeros((BITMAP_BITS // 32768, 4096), np.uint8)
    for b, bits in rows:
        out[b - 1] = np.frombuffer(bytes(bits), np.uint8)
    return out.reshape(-1)


def in_bitmap(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each int64 key may be in the set."""
    at = np.mod(keys.astype(np.int64), BITMAP_BITS)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def bitmap_blocks(keys: DataFrame, column: str) -> DataFrame:
    """The same bitmap as a written table of at most BITMAP_BITS / 32768 rows: block, bits."""
    bit = F.pmod(F.col(column), F.lit(BITMAP_BITS)) + 1
    blocks = (keys.filter(F.col(column).isNotNull()).groupBy(F.bitmap_bucket_number(bit).alias("_block"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("_bits")))
    return materialize(blocks, "bitmap")


def known(rows: DataFrame, blocks: DataFrame, column: str, inside: bool = True) -> DataFrame:
    """Rows whose ``column`` may (or, inside=False, cannot) be among the keys of ``bitmap_blocks``.

    A broadcast join without Python: texts that are only passed on need no worker, so a stage that
    filters and then runs Python code keeps one worker a task, not two.
    """
    bit = F.pmod(F.col(column), F.lit(BITMAP_BITS)) + 1
    place = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))
    return (rows.withColumn("_block", F.bitmap_bucket_number(bit)).join(F.broadcast(blocks), "_block", "left")
            .filter(hit == inside).select(*[F.col(f"`{c}`") for c in rows.columns]))


# --- connected components --------------------------------------------------------

SMALL_EDGES = 1 << 15  # of no more edges the minima are broadcast: 65,536 rows of two longs at most


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of the undirected ``edges`` (a, b); root is the smallest node.

    Alternating large-star / small-star contraction, one written stage a round;
    minima are pre-aggregated, so a node of many links costs no single task. Where few edges are left,
    the minima are broadcast: a round shuffles three times instead of six, and the driver keeps
    account of half the tasks. The result is written, as callers use it several times.
    """
    e = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct(), f"{name}-edges")

    def state() -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    now, mark = state(), None
    while now != mark:
        mark, few = now, now[0] <= SMALL_EDGES
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (both.join(F.broadcast(low) if few else low, "a").filter("b > a")
                 .select(F.col("b").alias("a"), F.least("a", "m").alias("b")))
        large = large if few else large.distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(F.broadcast(low) if few else low, "a").filter("b <> m")
                 .select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        e = materialize(small, f"{name}-small")
        now = state()
    nodes = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return materialize(nodes.unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()), f"{name}-nodes")

"""Vectorised word handling over Arrow text columns, shared by the operators of this subpackage.

A batch of texts is one byte buffer with offsets; words, their spans and 64-bit
hashes come out of a handful of numpy passes, so Python never loops over words.
Everything here is row-local: it runs inside ``mapInArrow`` tasks on whatever
partitioning Spark chose, in chunks of bounded size.
"""

from __future__ import annotations

import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 20  # bytes of text handled at once (one text may be longer)
HASH_BYTES = 1 << 18  # bytes hashed at once
_BASE = 0x9E3779B97F4A7C15
_SPACES = b" \t\n\x0b\x0c\r"


def worker_store() -> dict:
    """Per-worker cache that outlives a task (workers are reused between tasks)."""
    module = sys.modules.setdefault("_tessel_worker_store", types.ModuleType("_tessel_worker_store"))
    return module.__dict__.setdefault("store", {})


def lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def space_table() -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(_SPACES)] = True
    return t


def alnum_separator_table() -> np.ndarray:
    """True for every byte that is not an ASCII letter or digit and not part of a multi-byte character."""
    t = np.ones(256, bool)
    for lo, hi in ((48, 58), (65, 91), (97, 123), (128, 256)):
        t[lo:hi] = False
    return t


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """Arrow string column -> (bytes, offsets); null counts as empty.  No copy of the text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with about ``limit`` bytes of text each, at least one row."""
    _, offsets = text_buffer(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), n)
        yield batch.slice(at, to - at)
        at = to


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    store = worker_store()
    if "powers" not in store or len(store["powers"][0]) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        both = []
        for base in (_BASE, inverse):
            steps = np.full(max(n, HASH_BYTES), base, np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps))
        store["powers"] = tuple(both)
    return store["powers"]


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (bijective), ``seed`` picking one of a family."""
    h = h + np.uint64(((2 * seed + 1) * 0xD6E8FEB86659FD93) & (2**64 - 1))
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray | None = None, prefix: int = 0,
          lower: bool = True, trim: bytes = b""):
    """Words of a batch of texts, A-Z lower-cased.

    Returns ``(hash uint64, start, end, first)``: ``start``/``end`` are byte positions in
    ``data`` and words ``first[i]:first[i + 1]`` belong to text ``i``.  With ``prefix``, the
    hashes are of each word's first ``prefix`` bytes.  With ``trim``, one byte of ``trim`` after an
    ASCII letter is cut off the end of a word (``data[end]`` is then that byte, not a gap).
    """
    separators = space_table() if separators is None else separators
    n = len(data)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), empty, empty, np.zeros(len(offsets), np.int64)
    gap = separators[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    edge[n] = True
    inside = ~gap
    begins = inside.copy()
    begins[1:] &= gap[:-1] | edge[1:n]
    finishes = inside
    finishes[:-1] &= gap[1:] | edge[1:n]
    start, end = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    first = np.searchsorted(start, offsets)
    if trim:
        tail = np.zeros(256, bool)
        tail[list(trim)] = True
        letter = np.zeros(256, bool)
        letter[65:91] = letter[97:123] = True
        end -= tail[data[end - 1]] & (end - start > 1) & letter[data[end - 2]]
    to = np.minimum(end, start + prefix) if prefix else end
    return mix(span_hashes(data, start, to, lower)), start, end, first


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """Polynomial hash (mod 2**64) of the bytes of ascending spans that do not overlap."""
    out = np.empty(len(start), np.uint64)
    table, i = lower_table() if lower else np.arange(256, dtype=np.uint8), 0
    while i < len(start):
        base = start[i]
        j = max(int(np.searchsorted(end, base + HASH_BYTES, side="right")), i + 1)
        power, inverse = _powers(int(end[j - 1] - base))
        terms = table[data[base : end[j - 1]]].astype(np.uint64)
        terms += np.uint64(1)
        terms *= power[: len(terms)]
        total = np.zeros(len(terms) + 1, np.uint64)
        np.cumsum(terms, out=total[1:])
        s, e = start[i:j] - base, end[i:j] - base
        out[i:j] = (total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64)
        i = j
    return out


def shingles(h: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` consecutive words inside each text -> (hashes, first); shorter texts have none."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    begin = np.zeros(len(first), np.int64)
    np.cumsum(counts, out=begin[1:])
    if len(h) < size:
        return np.zeros(0, np.uint64), begin
    x = np.zeros(len(h) - size + 1, np.uint64)
    for k in range(size):
        x *= np.uint64(_BASE)
        x += h[k : len(h) - size + 1 + k]
    x = mix(x, 7)
    keep = np.ones(len(x) + size - 1, bool)
    for k in range(1, size):  # starts whose window crosses the end of a text
        crossing = first[1:] - k
        keep[crossing[crossing >= first[:-1]]] = False
    return x[keep[: len(x)]] if len(x) else x, begin


def crc_remainder(column: str, modulus: int) -> Column:
    """``crc32(column as text) mod modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def crc(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())


def blocks_for(df: DataFrame, column: str, block_bytes: int) -> int:
    """How many blocks of about ``block_bytes`` the texts of ``df`` need (one narrow scan, one number)."""
    total = df.agg(F.sum(F.octet_length(column))).first()[0] or 0
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(least, 1 + total // (1 << 16)), -(-total // block_bytes))

"""Document fingerprints as invertible Bloom lookup sketches.

A text is cut into paragraphs: lines, and inside long lines runs of words that end
where a word's hash says so, so an edit moves no boundary but its own.  Every
paragraph's digest (numbered when it repeats) goes into one cell of each of three
sub-tables; a cell keeps count, sum of digests and sum of checks.  Two versions'
tables subtract cell by cell, which cancels what they share, and peeling cells that
hold a single digest recovers exactly the digests that differ.  A table too small
for the difference leaves cells over; the pair is then retried at twice the size
with other hashes until it decodes.  Likeness is ``1 - differing / all`` over the
paragraphs of both.

Successive documents are compared inside range partitions of ``doc_id``: each
partition also gets the first document of the next one (the last gets the first),
so one shuffle of the texts is enough and tasks hold a batch at a time.

Defined cases: a null text counts as empty; order is ``doc_id`` ascending, null ids
first, rows of one id by text; the only document is its own successor; two texts
without paragraphs are alike (1.0); an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessel.llm.words import mix, span_hashes, text_buffer, words

CELLS = 15  # cells of the published fingerprint and of the first attempt
RUN_WORDS = 6  # mean words of a run inside a line
TABLES = 3


def paragraphs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit keys of the paragraphs of each text -> ``(keys, first)``."""
    n = len(offsets) - 1
    if len(data) == 0:
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    h, start, _, _ = words(data, offsets, lower=False)
    lines = np.cumsum(data == 10, dtype=np.int64)
    starts = [offsets[:-1][np.diff(offsets) > 0]]
    if len(h):
        after = (h[:-1] % np.uint64(RUN_WORDS) == 0) | (lines[start[1:]] != lines[start[:-1]])
        starts.append(start[1:][after])
    begin = np.unique(np.concatenate(starts))
    end = np.append(begin[1:], len(data))
    digest = mix(span_hashes(data, begin, end), 3)
    doc = np.searchsorted(offsets, begin, side="right") - 1
    # repeats of a paragraph get numbers, so keys are distinct within a text
    order = np.lexsort((digest, doc))
    digest, doc = digest[order], doc[order]
    new = np.ones(len(digest), bool)
    new[1:] = (digest[1:] != digest[:-1]) | (doc[1:] != doc[:-1])
    at = np.arange(len(digest))
    number = at - np.maximum.accumulate(np.where(new, at, 0))
    keys = mix(digest + number.astype(np.uint64) * np.uint64(0xA24BAED4963EE407), 5)
    return keys, np.searchsorted(doc, np.arange(n + 1))


class Sketches:
    """Tables of many texts, ``cells`` each, in flat arrays."""

    def __init__(self, count: np.ndarray, key: np.ndarray, check: np.ndarray, cells: int, seed: int):
        self.count, self.key, self.check, self.cells, self.seed = count, key, check, cells, seed

    @staticmethod
    def places(keys: np.ndarray, text: np.ndarray, cells: int, seed: int) -> np.ndarray:
        """Cell of each key in each sub-table, ``TABLES x len(keys)``."""
        part = cells // TABLES
        slots = [(mix(keys, 11 + TABLES * seed + t) % np.uint64(part)).astype(np.int64) + t * part for t in range(TABLES)]
        return np.stack(slots) + text * cells

    @classmethod
    def build(cls, keys: np.ndarray, first: np.ndarray, cells: int, seed: int = 0) -> Sketches:
        n = len(first) - 1
        text = np.repeat(np.arange(n), np.diff(first))
        out = cls(np.zeros(n * cells, np.int64), np.zeros(n * cells, np.uint64), np.zeros(n * cells, np.uint64), cells, seed)
        check = mix(keys, 9)
        for at in cls.places(keys, text, cells, seed):
            np.add.at(out.count, at, 1)
            np.add.at(out.key, at, keys)
            np.add.at(out.check, at, check)
        return out

    def minus(self, other: Sketches) -> Sketches:
        return Sketches(
            self.count - other.count, self.key - other.key, self.check - other.check, self.cells, self.seed
        )

    def strings(self) -> list[str]:
        """Every text's table as base64 of (count int32, key uint64, check uint32) cells."""
        cell = np.dtype([("count", "<i4"), ("key", "<u8"), ("check", "<u4")])
        flat = np.zeros(len(self.count), cell)
        flat["count"], flat["key"] = self.count, self.key
        flat["check"] = (self.check & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        raw, size = flat.tobytes(), self.cells * cell.itemsize
        return [base64.b64encode(raw[i : i + size]).decode() for i in range(0, len(raw), size)]

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Recover a difference: ``(text, key, sign)`` of every digest, and which texts decoded."""
        found = []
        while True:
            single = np.flatnonzero(np.abs(self.count) == 1)
            sign = self.count[single]
            key = np.where(sign > 0, self.key[single], ~self.key[single] + np.uint64(1))
            check = mix(key, 9)
            pure = self.check[single] == np.where(sign > 0, check, ~check + np.uint64(1))
            single, sign, key, check = single[pure], sign[pure], key[pure], check[pure]
            if not len(single):
                break
            text = single // self.cells
            at = self.places(key, text, self.cells, self.seed)
            # a digest alone in several cells is taken from the first of them
            alone = np.zeros(len(self.count), bool)
            alone[single] = True
            take = np.ones(len(single), bool)
            for t in range(TABLES):
                earlier = (at[t] < single) & alone[at[t]]
                take &= ~(earlier & (self.key[at[t]] == self.key[single]) & (self.count[at[t]] == sign))
            text, key, sign, check = text[take], key[take], sign[take], check[take]
            for cells in at[:, take]:
                np.subtract.at(self.count, cells, sign)
                np.subtract.at(self.key, cells, np.where(sign > 0, key, ~key + np.uint64(1)))
                np.subtract.at(self.check, cells, np.where(sign > 0, check, ~check + np.uint64(1)))
            found.append((text, key, sign))
        left = (self.count != 0) | (self.key != 0) | (self.check != 0)
        decoded = ~left.reshape(-1, self.cells).any(axis=1) if self.cells else np.ones(0, bool)
        joined = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, k) for k in ("i8", "u8", "i8")]
        return (*joined, decoded)


def _pick(keys: np.ndarray, first: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of some of the texts."""
    size = first[which + 1] - first[which]
    begin = np.zeros(len(which) + 1, np.int64)
    np.cumsum(size, out=begin[1:])
    return keys[np.repeat(first[which] - begin[:-1], size) + np.arange(begin[-1])], begin


def differing(a: tuple, b: tuple, left: np.ndarray, right: np.ndarray, cells: int = CELLS) -> np.ndarray:
    """Number of digests that differ between text ``left[i]`` of ``a`` and ``right[i]`` of ``b``."""
    out = np.full(len(left), -1, np.int64)
    todo, seed = np.arange(len(left)), 0
    while len(todo):
        again = []
        step = max(1, (1 << 21) // cells)  # bounded work space
        for at in range(0, len(todo), step):
            some = todo[at : at + step]
            sketch = Sketches.build(*_pick(*a, left[some]), cells, seed)
            text, _, _, decoded = sketch.minus(Sketches.build(*_pick(*b, right[some]), cells, seed)).peel()
            out[some] = np.bincount(text, minlength=len(some))
            again.append(some[~decoded])
        todo, cells, seed = np.concatenate(again), 2 * cells, seed + 1
    return out


def _likeness(n: np.ndarray, d: np.ndarray) -> np.ndarray:
    return np.where(n == 0, 1.0, 1.0 - d / np.maximum(n, 1))


def compare_with_next(texts: list[str], cells: int = CELLS) -> dict:
    """Fingerprints of ``texts[:-1]``, their edited texts and likenesses; the last text only follows."""
    n = len(texts) - 1
    edited = []
    for t, following in zip(texts, texts[1:]):
        k = len(t) // 4
        edited.append(t[: len(t) - k] + following[:k])
    raw = [t.encode() for t in edited]
    own = paragraphs(*text_buffer(pa.array(texts, pa.large_string())))
    new = paragraphs(*text_buffer(pa.array(raw, pa.large_binary()).cast(pa.large_string())))
    at = np.arange(n)
    size, new_size = np.diff(own[1]), np.diff(new[1])
    return {
        "n_chars": np.array([len(t) for t in texts[:-1]], np.int64),
        "edited_sha256": [hashlib.sha256(r).hexdigest() for r in raw],
        "fingerprint": Sketches.build(*_pick(*own, at), cells).strings(),
        "edited_fingerprint": Sketches.build(*new, cells).strings(),
        "near_edited": _likeness(size[:-1] + new_size, differing(own, new, at, at, cells)),
        "near_next": _likeness(size[:-1] + size[1:], differing(own, own, at, at + 1, cells)),
    }


def _range_bucket(key: Column, bounds: list[int]) -> Column:
    """Number of ``bounds`` at or below ``key``, as a balanced tree of comparisons."""

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key < bounds[mid], tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return tree(0, len(bounds))


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` in range partitions of ``doc_id``, each sorted and followed by a row with
    ``_after`` 1: the first document after the partition."""
    spark = docs.sparkSession
    least = -(1 << 63)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(least)).alias("_key"),
    )
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = rows.agg(F.percentile_approx("_key", [i / n for i in range(1, n)] or [0.5], 10 * n)).first()[0]
    bounds = sorted(set(found or []))
    rows = rows.withColumn("_bucket", _range_bucket(F.col("_key"), bounds)).withColumn("_after", F.lit(0))
    # first key of every bucket: as many rows as there are partitions
    firsts = sorted((r["_bucket"], r["k"]) for r in rows.groupBy("_bucket").agg(F.min("_key").alias("k")).collect())
    before = [(k, firsts[i - 1][0]) for i, (_, k) in enumerate(firsts)]
    heads = spark.createDataFrame(before, "_key long, _before int")
    after = rows.join(F.broadcast(heads), "_key").select(
        "doc_id", "text", "_key", F.col("_before").alias("_bucket"), F.lit(1).alias("_after")
    )
    both = rows.unionByName(after).repartitionById(len(bounds) + 1, F.col("_bucket"))
    return both.sortWithinPartitions("_after", "_key", "text").select("doc_id", "text", "_after")


def compare(docs: DataFrame, cells: int = CELLS, batch_chars: int = 1 << 21) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``."""

    def run(batches):
        ids, texts, chars = [], [], 0

        def out():
            done = compare_with_next(texts, cells)
            return pa.record_batch({"doc_id": pa.array(ids[:-1], pa.int64()), **{k: pa.array(v) for k, v in done.items()}})

        over = False
        for batch in batches:
            for doc_id, text, after in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "_after"))):
                if over:  # more rows with the id of the following document
                    break
                ids.append(doc_id)
                texts.append(text)
                chars += len(text)
                over = bool(after)
                if len(texts) > 1 and (over or chars > batch_chars):
                    yield out()
                    ids, texts, chars = ids[-1:], texts[-1:], len(text)

    return with_next(docs).mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )

"""SimHash near-duplicates by covering locality-sensitive hashing.

Every whole text becomes a 64-bit fingerprint (majority of its shingle hashes,
bit by bit).  Distinct fingerprints are then put into ``2**(r + 1) - 1`` tables,
each keyed by the fingerprint under a structured bit mask: bit ``i`` carries a
vector ``m(i)`` of ``r + 1`` bits and table ``v`` keeps the bits with an odd
``<m(i), v>``.  The vectors of at most ``r`` differing bits leave some ``v``
orthogonal to all of them, so every pair within the radius meets in that table:
no pair is missed and no probability is involved.

A bucket with more than ``BUCKET`` distinct fingerprints is not compared pair by
pair: its members are covered again over the bits the mask left free (15 masks
over about 30 bits, then about 15).  The third level leaves at most 8 free bits,
hence 256 distinct fingerprints, so buckets are bounded however the data look and
the work stays proportional to the members.  Small buckets give the links of a
spanning forest instead of all pairs.

Defined cases: a null text counts as empty; texts without words have fingerprint
zero and are linked like any other; repeated rows share a fingerprint; a null
``doc_id`` is never a component's id unless the component has no other.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessel.llm.words import lower_table
from tessel.plans.components import edge_components
from tessel.plans.indexing import unused
from tessel.session import materialize

SHINGLE = 3
RADIUS = 3
SEED = 42
BUCKET = 256


def fingerprint(text: bytes, size: int = SHINGLE, lower: bytes = lower_table().tobytes()) -> int:
    """64-bit SimHash of one text over shingles of ``size`` lower-cased words."""
    w = text.translate(lower).split()  # bytes.split() splits at 0x20 and 0x09-0x0D
    if not w:
        return 0
    if len(w) < size:
        grams = [b" ".join(w)]
    else:
        grams = map(b" ".join, zip(*(w[k:] for k in range(size))))
    digest = functools.partial(xxhash.xxh64_intdigest, seed=SEED)
    h = np.fromiter(map(digest, grams), "<u8", max(1, len(w) - size + 1))
    bits = np.zeros(64, np.int64)
    for at in range(0, len(h), 8192):  # bounded work space for very long texts
        part = h[at : at + 8192].view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE, keys: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, fp bigint)`` and the bigint columns ``keys`` for every row; row-local, no shuffle."""

    def run(batches):
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "").cast(pa.large_binary())
            fps = np.fromiter((fingerprint(x.as_py(), size) for x in texts), np.uint64, len(texts))
            kept = {k: batch.column(k) for k in keys}
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "fp": pa.array(fps.view(np.int64)), **kept})

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, fp bigint" + "".join(f", {k} bigint" for k in keys)
    return docs.select("doc_id", "text", *keys).mapInArrow(run, schema)


def covering_masks(free: int, radius: int) -> list[int]:
    """For each table the mask of kept bits among ``free`` (a bit set)."""
    bits = [i for i in range(64) if free >> i & 1]
    top = (1 << (radius + 1)) - 1
    vector = {b: 1 + k % top for k, b in enumerate(bits)}  # every non-zero vector equally often
    return [sum(1 << b for b in bits if (vector[b] & v).bit_count() & 1) for v in range(1, top + 1)]


def mask_tree(radius: int, levels: int = 3) -> list[list[int]]:
    """Masks of every level; child ``15 * parent + v`` refines its parent's mask."""
    full, out = (1 << 64) - 1, [[0]]
    for _ in range(levels):
        out.append([m | k for m in out[-1] for k in covering_masks(full & ~m, radius)])
    return out[1:]


def forest(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """``(member, first member)`` of every group joined by steps of at most ``radius`` bits."""
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
    label = np.arange(len(fps))
    while True:
        new = np.where(near, label[None, :], len(fps)).min(axis=1)
        if (new == label).all():
            break
        label = new
    child = np.flatnonzero(label != np.arange(len(fps)))
    return fps[child], fps[label[child]]


def _bucket_links(batches, radius: int, last: bool, bucket: int):
    """Rows sorted by (mask, key): links of small buckets; members of larger ones pass through."""

    def out(a, b, mask):
        return pa.record_batch(
            {
                "a": pa.array(np.asarray(a, np.uint64).view(np.int64)),
                "b": pa.array(np.asarray(b, np.uint64).view(np.int64)),
                "mask": pa.array(np.asarray(mask, np.int32)),
            }
        )

    def finished(fps, mask, begin):
        """Complete groups ``begin[i]:begin[i + 1]``."""
        size = np.diff(begin)
        two = begin[:-1][size == 2]
        a, b = fps[two], fps[two + 1]
        near = np.bitwise_count(a ^ b) <= radius
        links, hot = [(a[near], b[near])], []
        for g in np.flatnonzero(size > 2):
            members = slice(begin[g], begin[g + 1])
            if size[g] <= bucket or last:
                links.append(forest(fps[members], radius))
            else:
                hot.append(members)
        la, lb = (np.concatenate(x) for x in zip(*links))
        yield out(la, lb, np.full(len(la), -1))
        for members in hot:
            yield out(fps[members], fps[members], mask[members])

    held = None  # the group that may go on in the next batch
    spilling = None  # (mask, key) of a large group already streaming through
    for batch in batches:
        mask = batch.column("mask").to_numpy()
        key = batch.column("key").to_numpy()
        fps = batch.column("fp").to_numpy().view(np.uint64)
        if spilling is not None:
            same = (mask == spilling[0]) & (key == spilling[1])
            n = len(same) if same.all() else int(np.argmin(same))
            if n:
                yield out(fps[:n], fps[:n], mask[:n])
            mask, key, fps = mask[n:], key[n:], fps[n:]
            if not len(fps):
                continue
            spilling = None
        if held is not None:
            mask, key, fps = (np.concatenate(x) for x in zip(held, (mask, key, fps)))
        if not len(fps):
            continue
        change = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
        begin = np.concatenate(([0], change))
        if len(begin) > 1:
            yield from finished(fps, mask, begin)
        held = (mask[begin[-1] :], key[begin[-1] :], fps[begin[-1] :])
        if len(held[2]) > bucket and not last:
            yield out(held[2], held[2], held[0])
            spilling, held = (int(held[0][0]), int(held[1][0])), None
    if held is not None and len(held[2]):
        yield from finished(held[2], held[0], np.array([0, len(held[2])]))


def fingerprint_links(fps: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """``(a, b)`` rows with the same components as the links of distinct ``fp`` within ``radius``."""
    tree = mask_tree(radius)
    fan = (1 << (radius + 1)) - 1
    members = fps.selectExpr("fp", "0 AS mask")
    links = None
    for level, masks in enumerate(tree):
        table = np.array(masks, np.uint64)
        last = level == len(tree) - 1

        def cover(batches, table=table):
            for batch in batches:
                fp = np.repeat(batch.column("fp").to_numpy().view(np.uint64), fan)
                child = (batch.column("mask").to_numpy().astype(np.int64)[:, None] * fan + np.arange(fan)).ravel()
                yield pa.record_batch(
                    {
                        "mask": pa.array(child.astype(np.int32)),
                        "key": pa.array((fp & table[child]).view(np.int64)),
                        "fp": pa.array(fp.view(np.int64)),
                    }
                )

        covered = members.mapInArrow(cover, "mask int, key bigint, fp bigint")
        # a fingerprint can reach one refined bucket only once: keys fix the kept bits
        grouped = covered.repartition("mask", "key").sortWithinPartitions("mask", "key", "fp")
        found, _ = materialize(
            grouped.mapInArrow(
                lambda it, last=last: _bucket_links(it, radius, last, bucket), "a bigint, b bigint, mask int"
            ),
            "covering",
        )
        linked = found.filter("mask = -1").select("a", "b")
        links = linked if links is None else links.unionByName(linked)
        members = found.filter("mask >= 0").selectExpr("a AS fp", "mask")
        if last or members.isEmpty():
            return links


def component_labels(reps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``reps`` (a row for each distinct ``fp``) with ``label``, the smallest ``fp`` reachable by links."""
    links = fingerprint_links(reps.select("fp"), radius)
    labels = edge_components(links.selectExpr("a AS src", "b AS dst")).withColumnRenamed("id", "fp")
    return reps.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp"))


def classes(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(fp, component_id)``: the smallest ``doc_id`` reachable by links, for every distinct ``fp``."""
    reps, _ = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "fingerprints")
    labelled = component_labels(reps, radius)
    least = labelled.groupBy("label").agg(F.min("rep").alias("component_id"))
    return labelled.join(least, "label").select("fp", "component_id")


def simhash_components(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``doc_id, fp, fingerprint (16 hex digits), component_id`` for every row of ``docs``."""
    fps, _ = materialize(fingerprints(docs, size), "simhash")
    return fps.join(classes(fps, radius), "fp").select(
        "doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of ``docs`` for each component: the row with its smallest ``doc_id`` (a null id
    only where the component has no other), of several the one whose text has the smallest hash.
    Rows are told apart by their columns, not by id: different texts without an id, or under one
    id, each stay.  All columns keep their values, whatever their names."""
    keys = unused(docs, "hash"), unused(docs, "row_hash")
    rank = unused(docs, "rank")
    hashes = F.xxhash64("text").alias(keys[0]), F.xxhash64(*docs.columns).alias(keys[1])
    texts = docs.select("*", *hashes)
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *keys)
    fps = fingerprints(texts, size, keys).groupBy("fp").agg(F.min(row).alias("row"))
    reps, _ = materialize(fps, "fingerprints")
    least = component_labels(reps, radius).groupBy("label").agg(F.min("row").alias("row"))
    kept = texts.join(least.select(*(F.col("row")[k].alias(k) for k in keys)), list(keys))
    # rows come back from the join partitioned and sorted by these keys; only repeats of a row share them
    repeat = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0)))
    return kept.withColumn(rank, repeat).filter(F.col(rank) == 1).select(*docs.columns)

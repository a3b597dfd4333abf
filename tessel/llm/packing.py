"""Bulk-synchronous best-fit packing of documents into fixed-capacity token sequences.

Documents become token runs (ids and an end id); only runs longer than the
capacity are cut, into capacity-sized pieces and a rest.  Packing goes in
supersteps from the longest pieces to the shortest.  In a superstep every piece
of one length looks for its successor, the smallest gap that holds it; pieces of
equal length and gaps of equal size are interchangeable, so conflicts over a gap
resolve by rank (the k-th piece takes the k-th gap), the filled gaps move to
their new size, and the sweep repeats until the length is placed, opening new
sequences only when no gap is left.

What the supersteps pass on is therefore a table of counts by length and of gap
runs by size: at most ``capacity`` classes, whatever the number of documents.
The rows themselves are only range-sorted by length (with ``doc_id`` and piece as
further keys, so that a length shared by a third of all rows is still spread over
tasks), ranked by partition offsets, and matched against the sorted runs with one
binary search a row.

Defined cases: a null or empty text is the end id alone; repeated rows are packed
each; an empty table packs into nothing; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessel.llm.tokens import encoded
from tessel.llm.words import crc
from tessel.plans.indexing import row_index, unused
from tessel.session import materialize

CAPACITY = 2048
END_ID = 0


def token_pieces(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32[, ids]`` for every piece; row-local, no shuffle."""

    def run(batches):
        for ids_of, ids, first, _ in encoded(batches, path, end_id=end_id):
            count = -(-np.diff(first) // capacity)
            doc = np.repeat(np.arange(len(count)), count)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            begin = first[doc] + piece * capacity
            length = np.minimum(first[doc + 1] - begin, capacity)
            wide = ids.astype("<u4")
            cuts = zip(begin.tolist(), (begin + length).tolist())
            columns = {
                "doc_id": ids_of.take(pa.array(doc)),
                "piece": pa.array(piece, pa.int32()),
                "start": pa.array(piece * capacity, pa.int64()),
                "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array([crc(wide[a:b]) for a, b in cuts], pa.int64()),
            }
            if with_ids:  # pieces follow each other without a gap
                to = pa.array(np.append(begin, len(ids)), pa.int32())
                columns["ids"] = pa.ListArray.from_arrays(to, pa.array(ids, pa.int32()))
            yield pa.record_batch(columns)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    return docs.select("doc_id", "text").mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))


def best_fit(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Supersteps over length classes -> runs ``(length, first rank, pieces, first sequence, offset)``.

    Ranks count the pieces of one length.  Runs come by length descending, then rank.
    """
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # (first sequence, sequences)
    open_gap = np.zeros(capacity + 1, bool)
    runs, sequences = [], 0

    def push(size: int, first: int, n: int) -> None:
        if size > 0 and n > 0:
            gaps[size].append((first, n))
            open_gap[size] = True

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            step = int(np.argmax(open_gap[length:]))
            if not open_gap[length + step]:  # no successor: open sequences for all that is left
                n = -(-left // (capacity // length))
                push(capacity, sequences, n)
                sequences += n
                continue
            gap = length + step
            first, n = gaps[gap].pop()
            taken = min(n, left)
            runs.append((length, rank, taken, first, capacity - gap))
            push(gap - length, first, taken)
            push(gap, first + taken, n - taken)
            open_gap[gap] = bool(gaps[gap])
            rank, left = rank + taken, left - taken
    return np.array(runs, np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with ``doc_id, piece, start, length``) plus ``sequence_id`` and ``offset``; other
    columns keep their values, columns called like these two are replaced."""
    # sorting by range reads its input twice: texts are encoded once, into small rows
    pieces, _ = materialize(pieces.drop("sequence_id", "offset"), "pieces")
    names, name = pieces.columns, unused(pieces, "rank")
    ranked = row_index(pieces, [-F.col("length"), "doc_id", "piece", "start"], name)
    counts = {r["length"]: r["n"] for r in ranked.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = best_fit(counts, capacity)  # at most `capacity` lengths were collected
    begin = np.cumsum(runs[:, 2]) - runs[:, 2]  # rank over all lengths at which a run begins

    def place(batches):
        for batch in batches:
            rank = batch.column(name).to_numpy()
            run = np.searchsorted(begin, rank, side="right") - 1
            sequence = runs[run, 3] + rank - begin[run]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(sequence), pa.array(runs[run, 4])],
                names=[*names, "sequence_id", "offset"],
            )

    kinds = T.StructType(list(pieces.schema.fields)).add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(place, kinds)


def packed_documents(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    return pack(token_pieces(docs, path, capacity, end_id, with_ids), capacity)

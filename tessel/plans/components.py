"""Connected components of an edge list by minimum hooking and contraction.

Every round hooks each vertex to the smallest vertex among itself and its
neighbours, flattens the resulting trees by pointer jumping, and contracts the
edges to the roots.  A vertex that no round merges is a local minimum whose
neighbours hooked to something smaller, so it hooks in the round after: at least
half of the vertices that still have edges vanish every two rounds, whatever the
order of ids, and jumping doubles its reach every step.  Both loops therefore end
after a logarithmic number of steps and neither has a cap.

All steps are aggregates with map-side combining (``min`` only) and equi-joins, so
a vertex with a third of all edges costs partial rows, never one neighbour list.
Each round's tables are written to the shared checkpoint folder and deleted when
the next round has replaced them: a lost executor recomputes one step.  Once
contraction has left at most ``SMALL`` edges (counted), one task solves the rest with
the same rule on arrays; a graph that small needs no rounds at all.
"""

from __future__ import annotations

import logging

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessel.session import discard, materialize

log = logging.getLogger(__name__)

SMALL = 200_000  # edges solved in one task (3 MB)


def solve(src: np.ndarray, dst: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every id of an edge list with the smallest id of its component."""
    ids, place = np.unique(np.concatenate([src, dst]), return_inverse=True)
    a, b = place[: len(src)], place[len(src) :]
    label = np.arange(len(ids))
    while True:
        up = label.copy()
        np.minimum.at(up, np.maximum(label[a], label[b]), np.minimum(label[a], label[b]))
        while (up[up] != up).any():
            up = up[up]
        if (up == label).all():
            return ids, ids[label]
        label = up


def _solved(batches):
    """mapInArrow body over the one partition holding a small edge list."""
    parts = [(b.column("src").to_numpy(), b.column("dst").to_numpy()) for b in batches]
    if sum(len(p[0]) for p in parts):
        ids, label = solve(*(np.concatenate(x) for x in zip(*parts)))
        yield pa.record_batch({"id": pa.array(ids), "label": pa.array(label)})


def _flatten(parents: DataFrame) -> tuple[DataFrame, str]:
    """Pointer jumping over ``(id, label)`` until every label is a root."""
    table, path = materialize(parents, "parents")
    while True:
        hop = table.selectExpr("id AS label", "label AS up")
        step, new = materialize(
            table.join(hop, "label").selectExpr("id", "up AS label", "up <> label AS moved"), "parents"
        )
        discard(parents.sparkSession, path)
        table, path = step.select("id", "label"), new
        if step.filter("moved").isEmpty():
            return table, path


def edge_components(edges: DataFrame) -> DataFrame:
    """``edges(src, dst)`` in either direction -> ``(id, label)`` for every id with an edge.

    ``label`` is the smallest id of the component.  Null ends and loops are ignored.
    """
    spark = edges.sparkSession
    links, path = materialize(
        edges.filter("src <> dst")
        .selectExpr("CAST(least(src, dst) AS BIGINT) AS src", "CAST(greatest(src, dst) AS BIGINT) AS dst")
        .distinct(),
        "links",
    )
    total, total_path = None, None
    while True:
        if links.count() <= SMALL:
            roots, roots_path = materialize(links.repartition(1).mapInArrow(_solved, "id long, label long"), "labels")
            if total is None:
                discard(spark, path)
                return roots
            up = roots.selectExpr("id AS label", "label AS up")
            joined = total.join(up, "label", "left").selectExpr("id", "coalesce(up, label) AS label")
            out, _ = materialize(joined, "labels")
            discard(spark, path, roots_path, total_path)
            return out
        both = links.unionByName(links.selectExpr("dst AS src", "src AS dst"))
        parents = both.groupBy("src").agg(F.min("dst").alias("m")).selectExpr("src AS id", "least(src, m) AS label")
        roots, roots_path = _flatten(parents)
        old = [path, roots_path]
        a = roots.selectExpr("id AS src", "label AS a")
        b = roots.selectExpr("id AS dst", "label AS b")
        contracted = (
            links.join(a, "src")
            .join(b, "dst")
            .filter("a <> b")
            .selectExpr("least(a, b) AS src", "greatest(a, b) AS dst")
            .distinct()
        )
        new_links, path = materialize(contracted, "links")
        if total is None:
            total, total_path = roots, old.pop()
        else:
            up = roots.selectExpr("id AS label", "label AS up")
            joined = total.join(up, "label", "left").selectExpr("id", "coalesce(up, label) AS label")
            old.append(total_path)
            total, total_path = materialize(joined, "labels")
        discard(spark, *old)
        links = new_links


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``nodes(id)``, ``edges(src, dst)`` (either direction) -> ``(id, label)`` for every node."""
    found = edge_components(edges)
    return nodes.select("id").join(found, "id", "left").selectExpr("id", "coalesce(label, id) AS label")

"""Embedding near-dedup with a random-projection tree forest.

Vectors of one label (and length) go down ``TREES`` trees. A node splits by the
sign of the projection on a random direction of its own (signs from the hash of
the node, so nothing has to be fitted or sent along). A vector closer than
``SPILL`` to the split goes down both sides. Trees of a label are as deep as its
size asks for; leaves above ``MAX_LEAF`` are split further in rounds. Within a
leaf all pairs are compared exactly in double precision, and only sums and links
to the smallest linked vector leave the leaf, not the pairs: a pair found in
several leaves is counted in the one with the smallest id, which both vectors'
leaf lists tell.

Equal vectors of a label are one node with a count. A leaf that ``ROUNDS`` rounds
do not bring below the limit (vectors closer to each other than splits can tell)
is compared in blocks of bounded size, all of them, by many tasks.

A pair at cosine 0.98 is parted by a split with probability 0.06 without spill;
at 5 levels 8 trees lose one pair in 10,000, at 17 levels one in 25.

Cases: null labels, null, zero or empty vectors and ones with null or
non-finite components link with nothing; vectors of different lengths do not
link; rows equal in vec_id, label and vector are one vector; several vectors of
one vec_id link each, and share a component; a row without vec_id links with
nothing, has a null component and is kept; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..staging import stage
from .links import components
from .textbytes import U, mix

THRESHOLD = 0.98
TREES = 8
LEAF = 400
MAX_LEAF = 1600
ROUNDS = 5
SPILL = 0.0125
_STEP = U(0x9E3779B97F4A7C15)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of unit length."""
    flat = column.flatten().cast(pa.float64()).to_numpy().reshape(-1, width)
    scale = np.abs(flat).max(axis=1, keepdims=True)
    flat = flat / scale
    return flat / np.sqrt((flat**2).sum(axis=1, keepdims=True))


def _directions(nodes: np.ndarray, width: int) -> np.ndarray:
    """A vector of signs for each node."""
    blocks = [mix(nodes + U(j + 1) * _STEP) for j in range(-(-width // 64))]
    bits = np.unpackbits(np.stack(blocks, axis=1).view(np.uint8), axis=1)[:, :width]
    return (bits.astype(np.float64) * 2 - 1) / np.sqrt(width)


def descend(vectors: np.ndarray, rows: np.ndarray, nodes: np.ndarray, levels: np.ndarray, spill: float) -> tuple[np.ndarray, np.ndarray]:
    """Leaves of rows that start at nodes and go down the given levels."""
    done_rows, done_nodes = [], []
    while len(rows):
        at_leaf = levels <= 0
        done_rows.append(rows[at_leaf])
        done_nodes.append(nodes[at_leaf])
        rows, nodes, levels = rows[~at_leaf], nodes[~at_leaf], levels[~at_leaf]
        if not len(rows):
            break
        each, which = np.unique(nodes, return_inverse=True)
        projected = np.einsum("ij,ij->i", vectors[rows], _directions(each, vectors.shape[1])[which])
        both = np.abs(projected) < spill
        side = np.concatenate([(projected >= 0), (projected[both] < 0)]).astype(np.uint64)
        rows, nodes, levels = (np.concatenate([x, x[both]]) for x in (rows, nodes, levels - 1))
        nodes = mix(nodes * U(2) + side + _STEP)
    if not done_rows:
        return rows, nodes
    return np.concatenate(done_rows), np.concatenate(done_nodes)


def _split(trees: int, spill: float):
    """(node, levels, starting nodes of all trees if node is null) -> leaves."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            widths = whole.column("width").to_numpy()
            for width in np.unique(widths):
                batch = whole.filter(pa.array(widths == width))
                ids = batch.column("vid").to_numpy()
                vectors = _matrix(batch.column("embedding"), int(width))
                node = batch.column("node").to_numpy().view(np.uint64)
                levels = batch.column("levels").to_numpy()
                n = len(ids)
                if trees:
                    rows = np.tile(np.arange(n), trees)
                    node = mix(np.tile(node, trees) + np.repeat(np.arange(1, trees + 1, dtype=np.uint64), n) * _STEP)
                    levels = np.tile(levels, trees)
                else:
                    rows = np.arange(n)
                rows, leaves = descend(vectors, rows, node, levels, spill)
                yield pa.RecordBatch.from_arrays([pa.array(leaves.view(np.int64)), pa.array(ids[rows])], names=["leaf", "vid"])

    return split


COMPARED = "vid long, root long, linked long"


def _compare(threshold: float):
    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        ids, copies, blocks = (group.column(c).to_numpy() for c in ("vid", "copies", "block"))
        leaf = group.column("leaf")[0].as_py()
        width = group.column("width")[0].as_py()
        vectors = _matrix(group.column("embedding").combine_chunks(), width)
        lists = group.column("leaves").to_pylist()
        longest = max(map(len, lists))
        # Leaves below this one, padded with numbers that differ from row to row.
        earlier = np.array([[x if x < leaf else -i for x in row] + [-i] * (longest - len(row)) for i, row in enumerate(lists)], np.int64)
        is_earlier = np.array([[x < leaf for x in row] + [False] * (longest - len(row)) for row in lists])
        apart = len(np.unique(blocks)) > 1
        linked = np.zeros(len(ids), np.int64)
        root = np.arange(len(ids))
        by_id = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[by_id] = np.arange(len(ids))
        links = []
        for lo in range(0, len(ids), 256):
            near = vectors[lo:lo + 256] @ vectors.T >= threshold
            a, b = np.nonzero(near)
            a = a + lo
            keep = (a < b) & (blocks[a] != blocks[b] if apart else True)
            a, b = a[keep], b[keep]
            seen = np.zeros(len(a), bool)
            for i in range(longest):
                mine, real = earlier[a, i], is_earlier[a, i]
                if real.any():
                    for j in range(longest):
                        seen |= real & is_earlier[b, j] & (mine == earlier[b, j])
            np.add.at(linked, a[~seen], copies[b[~seen]])
            np.add.at(linked, b[~seen], copies[a[~seen]])
            links.append((place[a], place[b]))
        a, b = (np.concatenate(x) for x in zip(*links))
        while len(a):
            low = np.minimum(root[a], root[b])
            new = root.copy()
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            new = new[new]
            if (new == root).all():
                break
            root = new
        return pa.table({"vid": ids, "root": ids[by_id[root[place]]], "linked": linked})

    return compare


def near_vectors(table: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, leaf: int = LEAF, max_leaf: int = MAX_LEAF) -> DataFrame:
    """vec_id, n_links, component_id, kept per row of ``table``."""
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    good = table.select("vec_id", "label", "embedding").filter(usable).withColumn("embedding", F.transform("embedding", lambda x: (x + F.lit(0.0)).cast("double")))
    same = stage(good.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count_distinct("vec_id").alias("copies")), "vectors")
    # A vec_id can stand for several vectors, so nodes are numbered by their content.
    nodes = stage(same.select(F.xxhash64("label", "embedding").alias("vid"), "rep", "copies", "label", F.size("embedding").alias("width"), "embedding"), "nodes")
    rows = good.select("vec_id", F.xxhash64("label", "embedding").alias("vid"))
    levels = F.greatest(F.ceil(F.log2(F.col("n") / leaf)), F.lit(0)).cast("long")
    groups = stage(nodes.groupBy("label", "width").agg(F.count(F.lit(1)).alias("n")), "labels")
    start = nodes.join(groups, ["label", "width"]).select("vid", "embedding", "width", F.xxhash64("label", "width").alias("node"), levels.alias("levels"))
    members = stage(start.mapInArrow(_split(trees, SPILL), "leaf long, vid long"), "leaves")
    for _ in range(ROUNDS):
        large = stage(members.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max_leaf), "large-leaves")
        if large.isEmpty():
            break
        again = members.join(large, "leaf").join(nodes, "vid").select("vid", "embedding", "width", F.col("leaf").alias("node"), levels.alias("levels"))
        members = stage(
            members.join(large, "leaf", "left_anti").unionByName(again.mapInArrow(_split(0, SPILL), "leaf long, vid long")).distinct(), "leaves")
    sizes = stage(members.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")), "leaf-sizes")
    lists = members.groupBy("vid").agg(F.sort_array(F.collect_set("leaf")).alias("leaves"))
    parts = F.ceil(F.col("n") / max_leaf).cast("int")
    own = F.pmod(F.col("vid"), parts).cast("int")
    shown = (
        nodes.select("vid", "copies", "width", "embedding").join(lists, "vid").join(members.join(sizes, "leaf"), "vid")
        .withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
        .select("vid", "copies", "width", "embedding", "leaves", "leaf", "block", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))
    )
    found = stage(shown.groupBy("leaf", "one", "two").applyInArrow(_compare(threshold), COMPARED), "compared")
    counts = found.groupBy("vid").agg(F.sum("linked").alias("linked")).join(nodes.select("vid", "copies"), "vid").select("vid", (F.col("linked") + F.col("copies") - 1).alias("n_links"))
    reps = nodes.select(F.col("vid").alias("root"), F.col("rep").alias("b"))
    links = (
        rows.join(nodes.select("vid", "rep"), "vid").select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))
        .unionByName(found.filter("vid <> root").join(reps, "root").join(nodes.select("vid", F.col("rep").alias("a")), "vid").select("a", "b"))
    )
    roots = components(links)
    answers = stage(rows.join(counts, "vid").select("vec_id", "vid", "n_links"), "vector-links")
    keyed = table.select("vec_id", F.when(usable, F.xxhash64("label", F.transform("embedding", lambda x: (x + F.lit(0.0)).cast("double")))).alias("vid"))
    return (
        keyed.join(answers.select("vid", F.col("vec_id").alias("_id"), "n_links").distinct(), (F.col("vec_id") == F.col("_id")) & keyed.vid.eqNullSafe(answers.vid), "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))
        .join(roots.withColumnRenamed("node", "vec_id"), "vec_id", "left")
        .select("vec_id", "n_links", F.coalesce("root", "vec_id").alias("component_id"))
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0),
l AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (SELECT a AS vec_id, a AS root FROM l UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.vec_id),
c AS (SELECT vec_id, min(root) AS root FROM r GROUP BY 1),
n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY 1)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, coalesce(c.root, e.vec_id) AS component_id, coalesce(c.root, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN c USING (vec_id) LEFT JOIN n USING (vec_id)
"""

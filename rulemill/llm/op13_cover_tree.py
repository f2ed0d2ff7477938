"""Vector code compression: product codebooks by Lloyd rounds over cover trees.

A vector becomes integers (``floor(SCALE * x)``), is cut into ``PARTS`` equal
parts, and each part is replaced by the number of its nearest codebook entry.
Codebooks are learned by Lloyd rounds over *all* vectors:

* Each task cuts its rows into blocks and builds one cover tree per block and
  part: a node's children are points of it, each covering what lies within half
  the node's radius; a node knows its centre, its radius and its range of
  points. Trees are written once and every round reads them.
* A round sends each tree's nodes past the codebook, level by level. Where the
  nearest entry stays nearest for every point within the radius (triangle
  inequality), the whole subtree is assigned and its sum is a difference of two
  cumulative sums. Other nodes hand over to their children; points of ambiguous
  leaves are compared exactly.
* Tasks return one row of counts and sums per part and entry; these are added
  up by Spark, and only codebooks (``ENTRIES`` rows a part) reach the driver.

Distances are exact integers; square roots are only used with a margin, to tell
which nodes are ambiguous, so the result does not depend on the trees or on how
rows are partitioned (nearest entry, ties to the lower number).

Input: ``vec_id``, ``embedding``, ``label``; other columns are ignored. Rows
whose vector is null or holds a null or non-finite component go. So do vectors
that cannot be cut like the others: those whose length is not the most frequent
length among positive multiples of ``PARTS`` (ties: the shorter). Null vec_ids
come last in the choice of the first codebook, equal ones are ordered by their
vectors; repeated rows are coded row by row. With fewer than ``ENTRIES`` vectors
there are as many entries as vectors. An empty table gives an empty result.
Long vectors make fewer rows a block, so a block's memory is bounded; a
component so large that squared distances pass 2**63 is an error, as ``error``
cannot hold it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..staging import stage

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Vectors per cover tree: distances between all of a tree's points are held once.
BLOCK = 1024
#: Components per block at most.
BLOCK_COMPONENTS = 1 << 21
#: Nodes of so many points are not split further.
LEAF = 8
_MARGIN = 1e-9
_FLOAT_EXACT = 1 << 53


def usable_vectors(vectors: DataFrame) -> DataFrame:
    """Rows whose vector is there and wholly finite: vec_id, embedding, label."""
    x = F.col("embedding")

    def bad(v: Column) -> Column:
        return v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))

    return vectors.select("vec_id", x, "label").filter(x.isNotNull() & ~F.exists(x, lambda v: F.coalesce(bad(v), F.lit(True))))


def _common_length(kept: DataFrame, parts: int) -> int:
    n = F.size("embedding")
    row = (
        kept.groupBy(n.alias("n")).count().filter((F.col("n") > 0) & (F.col("n") % parts == 0))
        .orderBy(F.col("count").desc(), "n").first()
    )
    return row.n if row else 0


def to_integers(flat: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``floor(SCALE * x)``, in a type whose squared distances are exact."""
    scaled = np.floor(flat.astype(np.float64) * SCALE).reshape(-1, width)
    largest = float(np.abs(scaled).max(initial=0))
    if width * (2 * largest) ** 2 >= 2.0 ** 63:
        raise ValueError(f"component {largest / SCALE} is too large for squared distances in a long")
    return scaled


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows: float64 while it holds them, else int64."""
    largest = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if a.shape[1] * (2 * float(largest)) ** 2 < _FLOAT_EXACT:
        return (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    a, b = a.astype(np.int64), b.astype(np.int64)
    found = np.zeros((len(a), len(b)), np.int64)
    for i in range(a.shape[1]):
        found += (a[:, i, None] - b[None, :, i]) ** 2
    return found


class CoverTree:
    """Points in tree order and nodes (centre, lo, hi, first child, children) with radii."""

    def __init__(self, points: np.ndarray, order: np.ndarray, nodes: np.ndarray, radii: np.ndarray):
        self.points, self.order, self.nodes, self.radii = points, order, nodes, radii

    @classmethod
    def build(cls, points: np.ndarray) -> CoverTree:
        far = np.sqrt(squared(points, points).astype(np.float64))
        order = np.arange(len(points))
        nodes, radii = [[0, 0, len(points), 0, 0]], []
        for node in nodes:  # grows while it is read: breadth first, so children stand together
            centre, lo, hi = node[:3]
            rest = order[lo:hi].copy()
            reach = far[centre, rest].max()
            radii.append(reach)
            if hi - lo <= LEAF or reach == 0:
                continue
            node[3] = len(nodes)
            # The centre covers first, so it is its own first child.
            near = far[centre, rest] <= reach / 2
            while True:
                group, rest = rest[near], rest[~near]
                nodes.append([centre, lo, lo + len(group), 0, 0])
                order[lo:lo + len(group)] = group
                lo += len(group)
                if not len(rest):
                    break
                centre = rest[0]
                near = far[centre, rest] <= reach / 2
            node[4] = len(nodes) - node[3]
        table = np.array(nodes, np.int32)
        place = np.empty(len(points), np.int32)
        place[order] = np.arange(len(points))
        table[:, 0] = place[table[:, 0]]
        return cls(points[order], order, table, np.array(radii))

    def assign(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(lo, hi, entry) of subtrees that go as a whole, (point, entry) of the others."""
        # Equal entries would tie everywhere; the first of them stands for all.
        _, first = np.unique(book, axis=0, return_index=True)
        first.sort()
        distinct = book[first]
        whole, leaves = [], []
        at = np.zeros(1, np.int64)
        while len(at):
            here, reach = self.nodes[at], self.radii[at]
            found = squared(self.points[here[:, 0]], distinct)
            best = found.argmin(1)
            if len(distinct) > 1:
                two = np.sqrt(np.partition(found, 1, axis=1)[:, :2].astype(np.float64))
                sure = (two[:, 0] + reach) * (1 + _MARGIN) < (two[:, 1] - reach) * (1 - _MARGIN)
            else:
                sure = np.ones(len(at), bool)
            whole.append(np.column_stack([here[sure, 1], here[sure, 2], first[best[sure]]]))
            here = here[~sure]
            leaf = here[:, 4] == 0
            leaves.append(_ranges(here[leaf, 1], here[leaf, 2] - here[leaf, 1]))
            at = _ranges(here[~leaf, 3], here[~leaf, 4])
        lo, hi, entry = np.concatenate(whole).T
        single = np.concatenate(leaves)
        nearest = first[squared(self.points[single], distinct).argmin(1)] if len(single) else single
        return lo, hi, entry, single, nearest

    def sums(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Points and their sum per entry."""
        lo, hi, entry, single, nearest = self.assign(book)
        points = self.points.astype(np.int64)
        upto = np.vstack([np.zeros((1, points.shape[1]), np.int64), points.cumsum(0)])
        counts, total = np.zeros(len(book), np.int64), np.zeros(book.shape, np.int64)
        np.add.at(counts, entry, hi - lo)
        np.add.at(total, entry, upto[hi] - upto[lo])
        np.add.at(counts, nearest, 1)
        np.add.at(total, nearest, points[single])
        return counts, total

    def codes(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of each point, in the order the points were given."""
        lo, hi, entry, single, nearest = self.assign(book)
        found = np.empty(len(self.points), np.int64)
        found[_ranges(lo, hi - lo)] = np.repeat(entry, hi - lo)
        found[single] = nearest
        error = ((self.points.astype(np.int64) - book.astype(np.int64)[found]) ** 2).sum(1)
        code, errors = np.empty_like(found), np.empty_like(error)
        code[self.order], errors[self.order] = found, error
        return code, errors


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges (start, start + size)."""
    ends = np.cumsum(sizes, dtype=np.int64)
    if not len(ends):
        return ends
    return np.arange(ends[-1]) + np.repeat(starts - ends + sizes, sizes)


_TREE = ("points", "order", "nodes", "radii")


def _packed(tree: CoverTree) -> tuple[bytes, ...]:
    small = np.abs(tree.points).max(initial=0) < 1 << 15
    return (
        tree.points.astype(np.int16 if small else np.int64).tobytes(), tree.order.astype(np.int32).tobytes(),
        tree.nodes.tobytes(), tree.radii.tobytes(),
    )


def _unpacked(row: dict, width: int) -> CoverTree:
    order = np.frombuffer(row["order"], np.int32)
    small = len(row["points"]) == 2 * width * len(order)
    points = np.frombuffer(row["points"], np.int16 if small else np.int64)
    return CoverTree(
        points.reshape(-1, width).astype(np.float64), order,
        np.frombuffer(row["nodes"], np.int32).reshape(-1, 5), np.frombuffer(row["radii"]),
    )


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """All rows of a task in tables of ``size`` rows, the last one smaller."""
    held, rows = [], 0
    for batch in batches:
        while len(batch):
            part = batch.slice(0, size - rows)
            held.append(part)
            rows += len(part)
            batch = batch.slice(len(part))
            if rows == size:
                yield pa.Table.from_batches(held)
                held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held)


def _plant(size: int, parts: int, width: int):
    """Blocks of rows -> one row per block: its ids, its labels, and a tree per part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, size):
            vectors = block["embedding"].combine_chunks()
            cut = to_integers(np.asarray(vectors.flatten()), width).reshape(len(block), parts, -1)
            trees = [_packed(CoverTree.build(np.ascontiguousarray(cut[:, p]))) for p in range(parts)]
            columns = {}
            for name in ("vec_id", "label"):
                values = block[name].combine_chunks()
                columns[name] = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            for i, name in enumerate(_TREE):
                columns[name] = pa.array([[tree[i] for tree in trees]], pa.list_(pa.binary()))
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _trees_of(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, list[CoverTree]]]:
    for i in range(len(batch)):
        packed = [batch[name][i].as_py() for name in _TREE]
        yield i, [_unpacked(dict(zip(_TREE, one)), width) for one in zip(*packed)]


def _round(trees: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """One Lloyd round: entries become the floored means of what they are nearest to."""
    parts, width = len(books), books[0].shape[1]
    sums = [f"s{i}" for i in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((parts, len(books[0])), np.int64)
        total = np.zeros((parts, *books[0].shape), np.int64)
        for batch in batches:
            for _, grown in _trees_of(batch, width):
                for p, tree in enumerate(grown):
                    n, s = tree.sums(books[p])
                    counts[p] += n
                    total[p] += s
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_pydict({
            "part": part.astype(np.int32), "entry": entry.astype(np.int32), "n": counts[part, entry],
            **{name: total[part, entry, i] for i, name in enumerate(sums)},
        })

    schema = "part int, entry int, n long, " + ", ".join(f"{s} long" for s in sums)
    added = (
        trees.select(*_TREE).mapInArrow(run, schema)
        .groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in sums])
    )
    found = [book.copy() for book in books]
    for row in added.collect():  # at most PARTS x ENTRIES rows
        found[row.part][row.entry] = [row[s] // row.n for s in sums]
    return found


def _codes(trees: DataFrame, books: list[np.ndarray], label: T.DataType) -> DataFrame:
    """vec_id, label, code, error of every vector."""
    width = books[0].shape[1]
    digits = np.array([f"{i:02x}" for i in range(len(books[0]))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, grown in _trees_of(batch, width):
                found = [tree.codes(book) for tree, book in zip(grown, books)]
                code = digits[found[0][0]]
                for more, _ in found[1:]:
                    code = np.char.add(code, digits[more])
                yield pa.RecordBatch.from_pydict({
                    "vec_id": batch["vec_id"][i].values, "label": batch["label"][i].values,
                    "code": pa.array(code.tolist(), pa.string()), "error": sum(e for _, e in found),
                })

    schema = T.StructType([
        T.StructField("vec_id", T.LongType()), T.StructField("label", label),
        T.StructField("code", T.StringType()), T.StructField("error", T.LongType()),
    ])
    return trees.mapInArrow(run, schema)


def _first_entries(kept: DataFrame, entries: int) -> np.ndarray:
    """The vectors of the smallest vec_ids, nulls last, equal ids by vector.

    Rows are first cut to ``entries`` in each of 512 shares of the ids, within
    map tasks already, so no task meets more than those.
    """
    order = [F.col("vec_id").asc_nulls_last(), F.col("embedding")]
    share = F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(512))
    rank = F.row_number().over(Window.partitionBy("_share").orderBy(*order))
    few = kept.withColumn("_share", share).withColumn("_rank", rank).filter(F.col("_rank") <= entries)
    rows = few.orderBy(*order).limit(entries).select("embedding").collect()
    return to_integers(np.array([x for r in rows for x in r.embedding], np.float64), len(rows[0].embedding))


def books_digest(books: list[np.ndarray]) -> str:
    flat = np.concatenate([book.reshape(-1) for book in books]).astype(np.int64)
    return hashlib.sha256(",".join(map(str, flat.tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK
) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every usable vector."""
    spark: SparkSession = vectors.sparkSession
    label = vectors.schema["label"].dataType
    kept = usable_vectors(vectors)
    length = _common_length(kept, parts)
    if not length:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    kept = kept.filter(F.size("embedding") == length).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
    start = _first_entries(kept, entries)
    books = [np.ascontiguousarray(b) for b in np.split(start, parts, axis=1)]
    size = max(LEAF, min(block, BLOCK_COMPONENTS // length))
    schema = T.StructType([
        T.StructField("vec_id", T.ArrayType(T.LongType())), T.StructField("label", T.ArrayType(label)),
        *[T.StructField(n, T.ArrayType(T.BinaryType())) for n in _TREE],
    ])
    trees = stage(kept.mapInArrow(_plant(size, parts, length), schema), "trees")
    for _ in range(rounds):
        books = _round(trees, books)
    coded = stage(_codes(trees, books, label), "codes")
    # Staged, so that adaptive execution can split a label that holds much of the table.
    by_label = stage(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    by_label = by_label.select(F.col("label").alias("_label"), "label_error")
    return (
        coded.join(by_label, F.col("label").eqNullSafe(F.col("_label")))
        .select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
    )


def _oracle(rounds: int = ROUNDS, entries: int = ENTRIES) -> str:
    """The same by comparing every part with every entry, for tables of equally long vectors."""
    square = "list_inner_product(t.x, t.x) + list_inner_product(b.x, b.x) - 2 * list_inner_product(t.x, b.x)"
    steps = []
    for i in range(rounds + 1):
        steps.append(
            f"near{i} AS MATERIALIZED (SELECT t.r, t.p, min(ROW(CAST({square} AS BIGINT), b.e)) AS m "
            f"FROM cut t JOIN book{i} b ON t.p = b.p GROUP BY t.r, t.p)"
        )
        if i < rounds:
            steps.append(
                f"mean{i} AS (SELECT p, e, list(y ORDER BY k) AS x FROM (SELECT t.p, n.m[2] AS e, k.k, floor(sum(t.x[k.k]) / count(*)) AS y "
                f"FROM cut t JOIN near{i} n ON t.r = n.r AND t.p = n.p, (SELECT unnest(range(1, w + 1)) AS k FROM width) k GROUP BY ALL) GROUP BY p, e)"
            )
            steps.append(
                f"book{i + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM book{i} b LEFT JOIN mean{i} m ON b.p = m.p AND b.e = m.e)"
            )
    last = rounds
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
width AS (SELECT max(len(v)) // {PARTS} AS w FROM kept),
cut AS MATERIALIZED (SELECT r, p, list_slice(v, p * w + 1, (p + 1) * w) AS x FROM kept, width, range({PARTS}) q(p)),
book0 AS MATERIALIZED (SELECT p, r - 1 AS e, x FROM cut WHERE r <= {entries}),
{", ".join(steps)},
digest AS (SELECT sha256(string_agg(array_to_string(list_transform(x, lambda y: CAST(y AS BIGINT)), ','), ',' ORDER BY p, e)) AS d FROM book{last}),
coded AS (SELECT r, string_agg(printf('%02x', m[2]), '' ORDER BY p) AS code, CAST(sum(m[1]) AS BIGINT) AS error FROM near{last} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, d AS codebooks_sha256
FROM kept JOIN coded USING (r), digest"""


ORACLE = _oracle()

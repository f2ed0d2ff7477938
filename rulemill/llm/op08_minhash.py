"""MinHash near-dedup with tensored banding.

``SIDE`` left keys and ``SIDE`` right keys are made of ``HALF`` minhashes each,
and table (i, j) is keyed by left key i and right key j: SIDE**2 tables of
2 * HALF minhashes for the price of 2 * SIDE * HALF minhash functions instead
of 2 * SIDE**2 * HALF. With SIDE = 8 and HALF = 2, 32 functions serve 64 tables
of 4; a pair of similarity s shares a table with probability
(1 - (1 - s**2)**8)**2, which is 0.9994 at s = 0.8.

Links are confirmed on the full shingle sets of the two texts. Only components
are asked for, so a bucket is not turned into all its pairs: sets equal by a
128-bit digest become one node first; then every node of a bucket is compared
with its leader, the node with the most company, and verified links merge
components; nodes of buckets that still span components are then compared in
block pairs of bounded size, by left key, from which only links that join
components come out. So leaders lose nothing.
Buckets are aggregates and equi-joins over written tables, which adaptive
execution splits where they are skewed.

Cases: a null or empty text, or one without words, has an empty set (0
shingles) and links with nothing; fewer than ``K`` words are one shingle; rows
of one doc_id are one document to links (any of their texts may link); a row
without doc_id keeps its count, links with nothing, has component_id null and
kept true; equal rows get equal answers; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..staging import stage
from .links import components
from .textbytes import SPACE, Slice, U, as_long, gram_hashes, mix, slices, words

K = 4
SIMILARITY = 80  # in 100
SIDE, HALF = 8, 2
#: Bytes of text on one side of a block pair.
BLOCK_BYTES = 1 << 20
_SEEDS = np.random.default_rng(8).integers(1, 1 << 63, 2 * SIDE * HALF, dtype=np.uint64) * U(2) + U(1)

SIGNED = "doc_id long, n_shingles long, d1 long, d2 long, lefts array<long>, rights array<long>"


# Sets


def shingle_sets(part: Slice, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    found = words(part, SPACE)
    hashes = found.hashes(part)
    grams = gram_hashes(hashes, k)
    sets = []
    for a, b in zip(found.first[:-1], found.first[1:]):
        if b - a >= k:
            sets.append(np.unique(grams[a:b - k + 1]))
        elif b > a:
            sets.append(gram_hashes(np.concatenate([hashes[a:b], np.full(1, b - a, np.uint64)]), int(b - a) + 1))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def minhashes(sets: list[np.ndarray], seeds: np.ndarray) -> np.ndarray:
    """Smallest hash of each non-empty set under each seed."""
    flat = np.concatenate(sets)
    at = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), len(seeds)), np.uint64)
    for j, seed in enumerate(seeds):
        value = (flat ^ (seed >> U(1))) * seed
        value ^= value >> U(31)
        value *= U(0xD6E8FEB86659FD93)
        out[:, j] = np.minimum.reduceat(value ^ (value >> U(32)), at)
    return out


def _sign(k: int, side: int, half: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for part in slices(batch.column("text")):
                sets = shingle_sets(part, k)
                sizes = np.array([len(s) for s in sets], np.int64)
                digests = np.zeros((len(sets), 2), np.int64)
                keys = np.zeros((len(sets), 2 * side), np.uint64)
                full = np.flatnonzero(sizes)
                if len(full):
                    some = [sets[i] for i in full]
                    digests[full] = [np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), "<i8") for s in some]
                    low = minhashes(some, _SEEDS[: 2 * side * half]).reshape(len(some), 2 * side, half)
                    joined = np.zeros((len(some), 2 * side), np.uint64)
                    for h in range(half):
                        joined = mix(joined ^ low[:, :, h])
                    keys[full] = joined

                def lists(block: np.ndarray) -> pa.Array:
                    return pa.FixedSizeListArray.from_arrays(pa.array(np.ascontiguousarray(block).view(np.int64).ravel()), side).cast(pa.list_(pa.int64()))

                yield pa.RecordBatch.from_arrays([
                    ids.slice(part.lo, part.hi - part.lo), pa.array(sizes), pa.array(digests[:, 0]), pa.array(digests[:, 1]),
                    lists(keys[:, :side]), lists(keys[:, side:]),
                ], names=["doc_id", "n_shingles", "d1", "d2", "lefts", "rights"])

    return sign


def signatures(docs: DataFrame, k: int = K, side: int = SIDE, half: int = HALF) -> DataFrame:
    """doc_id, n_shingles, digest of the set, left and right keys."""
    return docs.select("doc_id", "text").mapInArrow(_sign(k, side, half), SIGNED)


# Verification


def word_set(text: bytes, k: int) -> set:
    found = text.lower().split()
    if len(found) < k:
        return {tuple(found)} if found else set()
    return set(zip(*(found[i:] for i in range(k))))


def _verify(k: int, similarity: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[bytes | None, set] = (None, set())
        for batch in batches:
            a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            linked = np.zeros(len(a), bool)
            for i, (one, other) in enumerate(zip(batch.column("text_a"), batch.column("text_b"))):
                one, other = one.as_buffer().to_pybytes(), other.as_buffer().to_pybytes()
                if last[0] != other:
                    last = (other, word_set(other, k))
                mine = word_set(one, k)
                common = len(mine & last[1])
                linked[i] = common > 0 and 100 * common >= similarity * (len(mine) + len(last[1]) - common)
            yield pa.RecordBatch.from_arrays([pa.array(a[linked]), pa.array(b[linked])], names=["a", "b"])

    return verify


def confirmed(pairs: DataFrame, texts: DataFrame, k: int = K, similarity: int = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough."""
    one = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    other = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(other, "b").join(one, "a").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_verify(k, similarity), "a long, b long")


FOUND = "a long, b long"


def _compare(k: int, similarity: int):
    """Links that join components, between the two blocks of a pair or within one."""

    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        block, ids, roots = (group.column(c).to_numpy() for c in ("block", "doc_id", "root"))
        texts = group.column("text").combine_chunks()
        sets = [s for part in slices(texts) for s in shingle_sets(part, k)]
        size = np.array([len(s) for s in sets], np.int64)
        low, high = int(block.min()), int(block.max())
        stored, asking = np.flatnonzero(block == low), np.flatnonzero(block == high)
        owner = np.repeat(stored, size[stored])
        hashes = np.concatenate([np.zeros(0, np.uint64), *(sets[i] for i in stored)])
        order = np.argsort(hashes, kind="stable")
        hashes, owner = hashes[order], owner[order]
        joined = {r: r for r in roots.tolist()}

        def top(r: int) -> int:
            while joined[r] != r:
                joined[r] = r = joined[joined[r]]
            return r

        links = []
        for i in asking:
            lo, hi = (np.searchsorted(hashes, sets[i], side) for side in ("left", "right"))
            width = hi - lo
            at = np.repeat(lo - np.cumsum(width) + width, width) + np.arange(width.sum())
            common = np.bincount(owner[at], minlength=len(sets))
            near = (common > 0) & (roots != roots[i]) & (100 * common >= similarity * (size[i] + size - common))
            for j in np.flatnonzero(near):
                one, other = top(int(roots[i])), top(int(roots[j]))
                if one != other:
                    mine, theirs = (word_set(texts[int(x)].as_buffer().to_pybytes(), k) for x in (i, j))
                    same = len(mine & theirs)
                    if 100 * same >= similarity * (len(mine) + len(theirs) - same):
                        joined[one] = other
                        links.append((ids[i], ids[j]))
        return pa.table({c: pa.array([x[n] for x in links], pa.int64()) for n, c in enumerate("ab")})

    return compare


def block_links(members: DataFrame, k: int, similarity: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Links that join components within families: (family, root, doc_id, text).

    A family is compared in pairs of blocks of bounded size: one of any size is
    spread over tasks, and only links that join components leave a task.
    """
    sizes = stage(
        members.groupBy("family").agg(F.ceil(F.sum(F.octet_length("text") + 1) / block_bytes).cast("int").alias("n_blocks")), "families")
    cut = (
        members.join(sizes, "family").withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.col("n_blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
        .select("family", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "doc_id", "root", "text")
    )
    return cut.groupBy("family", "i", "j").applyInArrow(_compare(k, similarity), FOUND)


# Links


def near_links(docs: DataFrame, signed: DataFrame, k: int = K, similarity: int = SIMILARITY, side: int = SIDE) -> DataFrame:
    """Links (a, b) that connect every component of similar documents."""
    named = signed.filter("doc_id is not null and n_shingles > 0")
    firsts = stage(named.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep")), "sets")
    same = stage(
        named.join(firsts, ["d1", "d2"]).filter("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct(), "same-sets"
    )
    nodes = named.join(firsts, ["d1", "d2"]).filter("doc_id = rep").select("doc_id", "d1", "d2", "n_shingles", "lefts", "rights").dropDuplicates(["doc_id", "d1", "d2"])
    table = F.explode(F.flatten(F.transform(
        F.sequence(F.lit(0), F.lit(side - 1)),
        lambda i: F.transform(F.sequence(F.lit(0), F.lit(side - 1)), lambda j: F.struct(
            F.xxhash64(i, F.get("lefts", i)).alias("family"), F.xxhash64(i, j, F.get("lefts", i), F.get("rights", j)).alias("key"))),
    )))
    keyed = nodes.select(F.col("doc_id").alias("a"), "n_shingles", table.alias("t")).select("a", "n_shingles", "t.family", "t.key")
    shared = stage(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shared-keys")
    rows = stage(keyed.join(shared, "key"), "buckets")
    texts = stage(docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(rows.select(F.col("a").alias("doc_id")).distinct(), "doc_id").dropDuplicates(["doc_id", "text"]), "candidates")
    # The node with the most company leads a bucket: an original before its copies.
    company = stage(rows.groupBy("a", "n_shingles").agg(F.sum("n").alias("company")), "company")
    led = rows.select("key", "a").join(company, "a")
    leaders = stage(led.groupBy("key").agg(F.max(F.struct("company", "a", "n_shingles")).alias("lead")).select("key", F.col("lead.a").alias("b"), F.col("lead.n_shingles").alias("n_b")), "leaders")
    # Sets of too different sizes cannot be similar.
    fits = F.greatest("n_shingles", "n_b") * similarity <= F.least("n_shingles", "n_b") * 100
    pairs = stage(rows.join(leaders, "key").filter((F.col("a") != F.col("b")) & fits).select("a", "b").distinct(), "pairs")
    links = same.unionByName(stage(confirmed(pairs, texts, k, similarity), "near-links"))
    roots = stage(components(links), "roots")
    rooted = stage(rows.select("family", "key", "a").join(roots.select(F.col("node").alias("a"), "root"), "a", "left").withColumn("root", F.coalesce("root", "a")), "roots-in-buckets")
    still = stage(rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("key"), "open-keys")
    # Buckets of one left key are compared together: 8 groups hold what 64 tables do.
    members = stage(
        rooted.join(still, "key").select("family", "root", F.col("a").alias("doc_id")).distinct().join(texts, "doc_id"), "members")
    return links.unionByName(stage(block_links(members, k, similarity), "block-links"))


def near_duplicates(docs: DataFrame, k: int = K, similarity: int = SIMILARITY, side: int = SIDE, half: int = HALF) -> DataFrame:
    """doc_id, n_shingles, component_id, kept per row of ``docs``."""
    signed = stage(signatures(docs, k, side, half), "signatures")
    roots = stage(components(near_links(docs, signed, k, similarity, side)), "roots")
    return (
        signed.select("doc_id", "n_shingles").join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 3], ' ') for i in range(1, len(w) - 2)]) END AS g FROM w),
n AS (SELECT doc_id, CAST(len(g) AS BIGINT) AS n FROM s),
e AS MATERIALIZED (SELECT doc_id, unnest(g) AS g FROM s),
i AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.g = b.g AND a.doc_id > b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (
  SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
u AS MATERIALIZED (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT a AS doc_id, a AS root FROM u UNION SELECT u.b, r.root FROM r JOIN u ON u.a = r.doc_id),
c AS (SELECT doc_id, min(root) AS root FROM r GROUP BY 1)
SELECT n.doc_id, n.n AS n_shingles, coalesce(c.root, n.doc_id) AS component_id, coalesce(c.root, n.doc_id) = n.doc_id AS kept
FROM n LEFT JOIN c USING (doc_id)
"""

"""Exact substring dedup: every byte in a ``WINDOW``-byte string that starts twice.

The corpus is cut into pieces so that equal windows meet without moving the
corpus around for each byte:

1. A window's key is the smallest hash of its ``GRAM``-byte substrings, so equal
   windows have equal keys. Neighbouring windows whose smallest substring is the
   same one are a piece; each window is in exactly one. Only keys and digests of
   pieces are shuffled, and keys that occur once are dropped.
2. Pieces that are equal throughout are one string of the index, with a count;
   all windows of a piece that occurs twice are repeated.
3. Different pieces of one key are sent to one task, which builds a
   run-compressed Burrows-Wheeler transform with sampled run ends over bounded
   batches of keys (``rlbwt``) and streams matching statistics: windows with a
   match of ``WINDOW`` bytes elsewhere are marked. Windows do not overlap pieces,
   and neighbours share ``WINDOW`` - 1 bytes, so a window never matches itself.
4. A key with more than ``HOT_BYTES`` of different pieces (a very common line in
   ever new surroundings) would be a batch without bound. Its windows are
   grouped by their own 128-bit digest instead, which spreads them.

Marks go back to their documents, where overlapping ones are merged.

Cases: a null or empty text has no bytes; a text below ``WINDOW`` bytes keeps
all; rows are documents, so repeated rows of ``WINDOW`` bytes or more are
removed in full, each; a null doc_id is as good as any; a text of any length is
cut in its own task; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..staging import stage
from .rlbwt import RunLengthIndex
from .textbytes import Slice, U, prefix_sums, slices, window_hashes

WINDOW = 200
GRAM = 32
#: Bytes of pieces in one index.
BATCH_BYTES = 1 << 20
HOT_BYTES = 1 << 21

# A place is a long: start in the text (32 bits), windows (12), a check of the row (20).


def cut(part: Slice, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Pieces of a slice: key, row, start in the slice, number of windows."""
    none = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    offsets, n = part.offsets, len(part.data)
    if n < window:
        return none
    grams = window_hashes(prefix_sums(part.data), gram)
    width = window - gram + 1
    # The place of the smallest gram, the first of equals, from prefix and suffix minima of blocks.
    padded = np.full(-(-len(grams) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(grams)] = grams & U(0xFFFFFFFF00000000) | np.arange(len(grams), dtype=np.uint64)
    blocks = padded.reshape(-1, width)
    up = np.minimum.accumulate(blocks, axis=1).ravel()
    down = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    last = n - window + 1
    smallest = (np.minimum(down[:last], up[width - 1:width - 1 + last]) & U(0xFFFFFFFF)).astype(np.int64)
    # A window may not cross a row's end.
    long_rows = np.flatnonzero(np.diff(offsets) >= window)
    if not len(long_rows):
        return none
    inside = np.zeros(n + 1, np.int8)
    np.add.at(inside, offsets[long_rows], 1)
    np.add.at(inside, offsets[long_rows + 1] - window + 1, -1)
    valid = np.cumsum(inside[:last], dtype=np.int8) > 0
    new = np.ones(last, bool)
    new[1:] = smallest[1:] != smallest[:-1]
    new[offsets[long_rows]] = True
    starts = np.flatnonzero(new & valid)
    rows = np.searchsorted(offsets, starts, "right") - 1
    ends = np.minimum(np.append(starts[1:], n), offsets[rows + 1] - window + 1)
    return grams[smallest[starts]], rows, starts, ends - starts


def _place(starts: np.ndarray, counts: np.ndarray, checks: np.ndarray) -> np.ndarray:
    return starts << 32 | counts << 20 | checks


PIECES = "key long, digest long, h long, place long"


def _pieces(window: int, gram: int):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            h, c = (batch.column(x).to_numpy() for x in ("h", "c"))
            for part in slices(batch.column("text")):
                keys, rows, starts, counts = cut(part, window, gram)
                if not len(keys):
                    continue
                view = memoryview(np.ascontiguousarray(part.data))
                digests = np.fromiter((digest(view[a:b]) for a, b in zip(starts.tolist(), (starts + counts + window - 1).tolist())), np.uint64, len(starts))
                at = rows + part.lo
                place = _place(starts - part.offsets[rows], counts, c[at])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(digests.view(np.int64)), pa.array(h[at]), pa.array(place)],
                    names=["key", "digest", "h", "place"],
                )

    return pieces


PIECE_TEXTS = "key long, digest long, copies long, hot boolean, h long, place long, piece binary"


def _piece_texts(window: int):
    """The texts of the wanted pieces of each row."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "digest", "copies", "hot"]
        for batch in batches:
            wanted = batch.column("wanted")
            rows = np.repeat(np.arange(batch.num_rows), np.diff(wanted.offsets.to_numpy()))
            asked = pa.RecordBatch.from_struct_array(wanted.flatten())
            place = asked.column("place").to_numpy()
            # Rows that share a hash, not a text, are told apart by the check.
            right = np.flatnonzero((place & 0xFFFFF) == batch.column("c").to_numpy()[rows])
            rows, place, asked = rows[right], place[right], asked.take(pa.array(right))
            text = batch.column("text").cast(pa.large_binary())
            _, where, content = text.buffers()
            begins = np.frombuffer(where, np.int64)[text.offset + rows] + (place >> 32)
            ends = begins + (place >> 20 & 0xFFF) + window - 1
            view = memoryview(content)
            for lo in range(0, len(rows), 8192):
                some = slice(lo, lo + 8192)
                pieces = pa.array([view[a:b].tobytes() for a, b in zip(begins[some].tolist(), ends[some].tolist())], pa.binary())
                kept = asked.slice(lo, 8192)
                yield pa.RecordBatch.from_arrays(
                    [*(kept.column(n) for n in names), pa.array(batch.column("h").to_numpy()[rows[some]]), kept.column("place"), pieces],
                    names=[*names, "h", "place", "piece"],
                )

    return texts


MARKS = "h long, c int, first long, last long"


def _runs(marked: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], marked.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def _index(window: int):
    """Marks of once-occurring pieces, from indexes over batches of whole keys."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, key = 0, None

        def marks() -> pa.RecordBatch:
            built = RunLengthIndex([piece for *_, piece in held])
            matched = built.matching_statistics() >= window
            rows = []
            for start, (copies, h, place, piece) in zip(built.starts, held):
                if copies == 1:
                    begin, n = place >> 32, place >> 20 & 0xFFF
                    rows += [(h, place & 0xFFFFF, begin + a, begin + b - 1) for a, b in _runs(matched[start:start + n])]
            columns = list(zip(*rows)) or [(), (), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64()))], names=["h", "c", "first", "last"])

        for batch in batches:
            columns = [batch.column(x).to_pylist() for x in ("key", "copies", "h", "place", "piece")]
            for k, *row in zip(*columns):
                if k != key and size >= BATCH_BYTES:
                    yield marks()
                    held, size = [], 0
                key = k
                held.append(tuple(row))
                size += len(row[-1])
        if held:
            yield marks()

    return index


def _windows(window: int):
    """A row per window of hot pieces, by the digest of the window."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, copies, h, place in zip(*(batch.column(x).to_pylist() for x in ("piece", "copies", "h", "place"))):
                n = len(piece) - window + 1
                view = memoryview(piece)
                full = [xxhash.xxh3_128_intdigest(view[i:i + window]) for i in range(n)]
                signed = lambda x: x - (1 << 64) if x >> 63 else x
                yield pa.RecordBatch.from_arrays([
                    pa.array([signed(x >> 64) for x in full], pa.int64()), pa.array([signed(x & (1 << 64) - 1) for x in full], pa.int64()),
                    pa.array([copies] * n, pa.int64()), pa.array([h] * n, pa.int64()), pa.array([place & 0xFFFFF] * n, pa.int32()),
                    pa.array(range(place >> 32, (place >> 32) + n), pa.int64()),
                ], names=["w1", "w2", "copies", "h", "c", "first"])

    return windows


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<start: long, end: long>>"


def _remove(window: int):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            marks = batch.column("marks")
            offsets = marks.offsets.to_numpy()
            flat = pa.RecordBatch.from_struct_array(marks.values)
            first, last, check = (flat.column(n).to_numpy() for n in ("first", "last", "c"))
            lengths, removed, digests = [], [], []
            for i, (text, c) in enumerate(zip(batch.column("text"), batch.column("c").to_pylist())):
                data = memoryview(text.as_buffer()) if text.is_valid else memoryview(b"")
                lo, hi = (offsets[i], offsets[i + 1]) if marks[i].is_valid else (0, 0)
                begin, end = (x[lo:hi][check[lo:hi] == c] for x in (first, last))
                order = np.argsort(begin, kind="stable")
                begin, reach = begin[order], np.maximum.accumulate(end[order] + window)
                new = np.flatnonzero(np.concatenate([[True], begin[1:] > reach[:-1]])) if len(begin) else np.zeros(0, np.int64)
                spans = list(zip(begin[new].tolist(), reach[np.append(new[1:], len(begin)) - 1].tolist())) if len(begin) else []
                kept, at = hashlib.sha256(), 0
                for a, b in spans:
                    kept.update(data[at:a])
                    at = b
                kept.update(data[at:])
                lengths.append(len(data))
                removed.append([{"start": a, "end": b} for a, b in spans])
                digests.append(kept.hexdigest())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(lengths, pa.int64()), pa.array([sum(s["end"] - s["start"] for s in r) for r in removed], pa.int64()),
                pa.array([len(r) for r in removed], pa.int64()), pa.array(digests, pa.string()), pa.array(removed, span),
            ], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])

    return remove


def repeated_substrings(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed byte spans."""
    texts = docs.select(
        F.xxhash64("doc_id", "text").alias("h"), (F.xxhash64(F.lit("check"), "text", "doc_id").bitwiseAND(F.lit(0xFFFFF))).cast("int").alias("c"),
        "doc_id", F.col("text").cast("binary").alias("text"),
    )
    pieces = texts.select("h", "c", "text").mapInArrow(_pieces(window, gram), PIECES)
    shared = stage(pieces.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key"), "shared-keys")
    found = stage(pieces.join(shared, "key"), "shared-pieces")
    distinct = stage(
        found.groupBy("key", "digest").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("h", "place")).alias("at")).select("key", "digest", "copies", "at.h", "at.place"),
        "distinct-pieces",
    )
    size = F.shiftright("place", 20).bitwiseAND(F.lit(0xFFF)) + window - 1
    mixed = stage(
        distinct.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("bytes")).filter("n > 1").select("key", (F.col("bytes") > hot_bytes).alias("hot")),
        "mixed-keys",
    )
    wanted = (
        distinct.join(mixed, "key").groupBy("h")
        .agg(F.collect_list(F.struct("key", "digest", "copies", "hot", "place")).alias("wanted"))
    )
    shown = stage(texts.join(wanted, "h").mapInArrow(_piece_texts(window), PIECE_TEXTS), "piece-texts")
    from_index = (
        shown.filter(~F.col("hot")).select("key", "copies", "h", "place", "piece")
        .repartition("key").sortWithinPartitions("key")
        .mapInArrow(_index(window), MARKS)
    )
    place_marks = lambda rows: rows.select(
        "h", F.col("place").bitwiseAND(F.lit(0xFFFFF)).cast("int").alias("c"), F.shiftright("place", 32).alias("first"),
        (F.shiftright("place", 32) + F.shiftright("place", 20).bitwiseAND(F.lit(0xFFF)) - 1).alias("last"),
    )
    copied = place_marks(found.join(distinct.filter("copies > 1").select("key", "digest"), ["key", "digest"]))
    marks = from_index.unionByName(copied)
    if not mixed.filter("hot").isEmpty():
        windows = stage(shown.filter("hot").mapInArrow(_windows(window), "w1 long, w2 long, copies long, h long, c int, first long"), "hot-windows")
        twice = stage(windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("w1", "w2"), "repeated-windows")
        marks = marks.unionByName(windows.filter("copies = 1").join(twice, ["w1", "w2"]).select("h", "c", "first", F.col("first").alias("last")))
    by_row = marks.groupBy("h").agg(F.collect_list(F.struct("c", "first", "last")).alias("marks"))
    return texts.join(by_row, "h", "left").select("doc_id", "c", "text", "marks").mapInArrow(_remove(window), RESULT)


#: Every window by its digest; texts as hexadecimal digits, so that places are bytes.
ORACLE = """
WITH h AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
p AS MATERIALIZED (
  SELECT row, i, md5_number(substr(x, 2 * i + 1, 400)) AS d FROM (SELECT row, x, unnest(range(0, len(x) // 2 - 199)) AS i FROM h)),
m AS (SELECT row, i FROM p SEMI JOIN (SELECT d FROM p GROUP BY d HAVING count(*) > 1) USING (d)),
e AS (SELECT row, i, CASE WHEN i - lag(i) OVER (PARTITION BY row ORDER BY i) <= 200 THEN 0 ELSE 1 END AS new FROM m),
k AS (SELECT row, i, sum(new) OVER (PARTITION BY row ORDER BY i) AS island FROM e),
s AS (SELECT row, min(i) AS a, max(i) + 200 AS b FROM k GROUP BY row, island),
g AS (
  SELECT row, a, b, coalesce(lag(b) OVER (PARTITION BY row ORDER BY a), 0) AS z FROM s),
r AS (
  SELECT row, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last, string_agg(substr(x, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) AS kept
  FROM g JOIN h USING (row) GROUP BY row)
SELECT doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, '') || substr(x, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM h LEFT JOIN r USING (row)
"""

"""Token ids as directly addressable codes.

The ids of a run of documents are stored by levels: level 0 holds the lowest
``chunk_bits[0]`` bits of every id, a continuation bitmap says which ids have
more bits, and level 1 holds the next bits of just those, and so on. A rank
directory (set bits before each 512-bit block) turns a place in one level into
the place in the next, so any token is read by its number without decoding a
block (``Segment.token``).

File format: a Parquet table written by Spark, a row per segment of consecutive
documents. Columns: ``part`` (range partition), ``seq`` (segment in it),
``first`` (ids before it in its part), ``n_tokens``, ``doc_ids``, ``ends`` (ids
of the segment up to each document's end), ``payload``, ``bitmaps`` and
``ranks`` (little-endian bytes per level). Parts follow each other in ascending
doc_id order, so a global position is the part's base plus ``first``.

Cases: a null or empty text is just the end id; documents are ordered by doc_id
(null first), rows of one doc_id by the hash of their text; an empty table gives
an empty file set; other columns are ignored. A segment ends after
``SEGMENT_TOKENS`` ids; a longer document is a segment of its own.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..staging import stage
from .textbytes import SLICE_BYTES, slices

END_ID = 1
CHUNK_BITS = (8, 8, 16)
RANK_BLOCK = 512
SEGMENT_TOKENS = 1 << 19
#: Runs of text whose ids a worker keeps.
CACHED_WORDS = 600_000

FILES = ("part int, seq int, first long, n_tokens long, doc_ids array<long>, ends array<long>, "
         "payload array<binary>, bitmaps array<binary>, ranks array<binary>")


# Codes


def encode(ids: np.ndarray, chunk_bits: tuple = CHUNK_BITS) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """Payload, continuation bitmap and rank directory of each level."""
    rest = ids.astype(np.uint32)
    payload, bitmaps, ranks = [], [], []
    for level, bits in enumerate(chunk_bits):
        kind = f"<u{bits // 8}"
        payload.append(rest.astype(kind).tobytes())
        rest = rest >> np.uint32(bits)
        goes_on = rest > 0
        packed = np.packbits(goes_on, bitorder="little")
        counts = np.add.reduceat(goes_on, np.arange(0, len(goes_on), RANK_BLOCK)) if len(goes_on) else np.zeros(0, np.int64)
        bitmaps.append(packed.tobytes())
        ranks.append((np.cumsum(counts) - counts).astype("<u4").tobytes())
        rest = rest[goes_on]
        if not len(rest):
            break
    if len(rest):
        raise ValueError("an id has more bits than all levels hold")
    return payload, bitmaps, ranks


class Segment:
    """Read access to the codes of one segment."""

    def __init__(self, n: int, payload: list[bytes], bitmaps: list[bytes], ranks: list[bytes], chunk_bits: tuple = CHUNK_BITS):
        self.n, self.bits = n, chunk_bits
        self.payload = [np.frombuffer(p, f"<u{b // 8}") for p, b in zip(payload, chunk_bits)]
        self.bitmaps = [np.frombuffer(b, np.uint8) for b in bitmaps]
        self.ranks = [np.frombuffer(r, "<u4") for r in ranks]

    def token(self, i: int) -> int:
        """Id number ``i``: one chunk, one bit and one rank per level."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value, shift = 0, 0
        for level, bits in enumerate(self.bits):
            value |= int(self.payload[level][i]) << shift
            if not self.bitmaps[level][i >> 3] >> (i & 7) & 1:
                return value
            shift += bits
            block = i // RANK_BLOCK
            inside = self.bitmaps[level][block * RANK_BLOCK // 8:(i >> 3) + 1].copy()
            inside[-1] &= (1 << (i & 7)) - 1
            i = int(self.ranks[level][block]) + int(np.bitwise_count(inside).sum())
        return value

    def all(self) -> np.ndarray:
        """All ids in order, level by level from the last."""
        last = len(self.payload) - 1
        values = self.payload[last].astype(np.uint32)
        for level in range(last - 1, -1, -1):
            lower = self.payload[level].astype(np.uint32)
            more = np.flatnonzero(np.unpackbits(self.bitmaps[level], count=len(lower), bitorder="little"))
            lower[more] |= values << np.uint32(self.bits[level])
            values = lower
        return values.astype("<u4", copy=False)


# Tokens


def _byte_chars() -> list[str]:
    """The printable character that byte-level BPE writes for each byte."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


_BYTE_CHARS = _byte_chars()


class WordIds:
    """Ids of texts by the runs between blanks or line feeds.

    A tokenizer that drops white space and lower-cases, with pieces that never
    span it, gives a run the same ids whatever its neighbours. A run of ASCII
    and Latin letters is cut into the tokenizer's pieces here, and each distinct
    piece goes to the BPE model once, past the normaliser's and splitter's cost
    per call; other runs go through the whole tokenizer. Beyond ``CACHED_WORDS``
    runs and pieces, only those of the last slice stay in memory.

    ``PROBES`` check all this when the tokenizer is loaded; one that behaves
    otherwise (it keeps blanks, or case) encodes whole texts instead.
    """

    PROBES = ["Some plain Words, with a stop.", "UPPER lower\nÀÉß naïve, é.", "x,. 3.5 a's don't. \n (z) we'll, 12th", "antidisestablishmentarianism überfließend."]
    #: The splitter's pattern for lower-case Latin text.
    PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
    PLAIN = re.compile("[!-~ß-öø-ÿ]*")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.model = self.tokenizer.model
        self.as_bytes = {ord(c): "".join(_BYTE_CHARS[b] for b in c.encode()) for c in map(chr, range(256))}
        self.by_runs = False
        whole = self.ids(pa.array(self.PROBES))
        self.by_runs = True
        self.by_runs = all(map(np.array_equal, whole, self.ids(pa.array(self.PROBES))))

    def pieces(self, run: str) -> list[str] | None:
        """Pieces of a run; None where the tokenizer has to cut it."""
        low = run.lower()
        if self.PLAIN.fullmatch(low) and "<|" not in low:
            return self.PIECES.findall(low)
        return None

    def _learn(self, runs: list[str]) -> None:
        known, whole = self.known, []
        for run in runs:
            pieces = self.pieces(run)
            if pieces is None:
                whole.append(run)
                continue
            ids = b""
            for piece in pieces:
                code = known.get(piece)
                if code is None:
                    tokens = self.model.tokenize(piece if piece.isascii() else piece.translate(self.as_bytes))
                    code = known[piece] = struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])
                ids += code
            known[run] = ids
        for run, coded in zip(whole, self.tokenizer.encode_batch_fast(whole, add_special_tokens=False)):
            known[run] = np.array(coded.ids, "<u4").tobytes()

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts in a row, and the place where each text's ids end."""
        if not self.by_runs:
            whole = [e.ids for e in self.tokenizer.encode_batch_fast(texts.fill_null("").to_pylist(), add_special_tokens=False)]
            return np.array([i for ids in whole for i in ids], "<u4"), np.cumsum([len(ids) for ids in whole])
        split = pc.split_pattern(pc.replace_substring(texts.cast(pa.string()).fill_null(""), "\n", " "), " ")
        encoded = split.flatten().dictionary_encode()
        runs, at = encoded.dictionary.to_pylist(), encoded.indices.to_numpy()
        known = self.known
        self._learn([run for run in runs if run not in known])
        coded = [known[run] for run in runs]
        if len(known) > CACHED_WORDS:
            self.known = dict(zip(runs, coded))
        # Put the runs' ids in the order of the texts.
        size = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        begin = np.cumsum(size) - size
        ends = np.cumsum(size[at])
        take = np.repeat(begin[at] - ends + size[at], size[at]) + np.arange(ends[-1] if len(ends) else 0)
        borders = np.concatenate([[0], ends])[split.offsets.to_numpy()[1:] - split.offsets[0].as_py()]
        return np.frombuffer(b"".join(coded), "<u4")[take], borders


@lru_cache(maxsize=2)
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def _write_segments(path: str, chunk_bits: tuple):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("part", pa.int32()), ("seq", pa.int32()), ("first", pa.int64()), ("n_tokens", pa.int64()),
            ("doc_ids", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())),
            *((c, pa.list_(pa.binary())) for c in ("payload", "bitmaps", "ranks")),
        ])
        part, seq, first = TaskContext.get().partitionId(), 0, 0
        docs: list[int | None] = []
        ends: list[int] = []
        held: list[np.ndarray] = []

        def segment() -> pa.RecordBatch:
            ids = np.concatenate(held)
            row = [part, seq, first, len(ids), docs, ends, *encode(ids, chunk_bits)]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

        for batch in batches:
            for text_slice in slices(batch.column("text"), 4 * SLICE_BYTES):
                some = batch.slice(text_slice.lo, text_slice.hi - text_slice.lo)
                ids, stops = _word_ids(path).ids(some.column("text"))
                ids = np.insert(ids, stops, END_ID)
                stops = stops + np.arange(1, len(stops) + 1)
                names, at, used = some.column("doc_id").to_pylist(), 0, 0
                while at < len(names):
                    # As many documents as the segment has room for, one at least.
                    size = ends[-1] if ends else 0
                    fit = int(np.searchsorted(stops, used + SEGMENT_TOKENS - size, "right"))
                    if fit <= at:
                        if ends:
                            yield segment()
                            seq, first = seq + 1, first + ends[-1]
                            docs, ends, held = [], [], []
                            continue
                        fit = at + 1
                    docs += names[at:fit]
                    ends += (stops[at:fit] - used + size).tolist()
                    held.append(ids[used:stops[fit - 1]])
                    at, used = fit, int(stops[fit - 1])
        if held:
            yield segment()

    return write


def write_tokens(docs: DataFrame, tokenizer_path: str, chunk_bits: tuple = CHUNK_BITS) -> DataFrame:
    """Encode all texts and write the files; returns the written table."""
    ordered = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("_tie"))
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), "_tie")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_tie")
        .select("doc_id", "text")
    )
    return stage(ordered.mapInArrow(_write_segments(tokenizer_path, chunk_bits), FILES), "tokens")


def part_bases(files: DataFrame) -> DataFrame:
    """Ids before each part: one row per part, so one ordered task."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return (
        files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
        .select(F.col("part").alias("_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )


def _read_segments(chunk_bits: tuple):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids = Segment(row["n_tokens"], row["payload"], row["bitmaps"], row["ranks"], chunk_bits).all()
                starts = [0, *row["ends"][:-1]]
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["part"]] * len(starts), pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                    pa.array([row["first"] + s for s in starts], pa.int64()),
                    pa.array([e - s for s, e in zip(starts, row["ends"])], pa.int64()),
                    pa.array([zlib.crc32(ids[s:e].tobytes()) for s, e in zip(starts, row["ends"])], pa.int64()),
                ], names=["part", "doc_id", "local", "n_tokens", "ids_crc32"])

    return read


def read_documents(files: DataFrame, chunk_bits: tuple = CHUNK_BITS) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    rows = files.mapInArrow(_read_segments(chunk_bits), "part int, doc_id long, local long, n_tokens long, ids_crc32 long")
    return (
        rows.join(part_bases(files), F.col("part") == F.col("_part"))
        .select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")
    )


def token_at(files: DataFrame, positions: DataFrame, chunk_bits: tuple = CHUNK_BITS) -> DataFrame:
    """(position) -> position, token: only the segments asked for are touched."""
    placed = files.join(part_bases(files), F.col("part") == F.col("_part")).withColumn("begin", F.col("base") + F.col("first"))
    wanted = (
        placed.join(positions.select("position"), (F.col("position") >= F.col("begin")) & (F.col("position") < F.col("begin") + F.col("n_tokens")))
        .groupBy("part", "seq").agg(F.collect_set(F.col("position") - F.col("begin")).alias("local"), F.first("begin").alias("begin"))
        .join(files.select("part", "seq", "n_tokens", "payload", "bitmaps", "ranks"), ["part", "seq"])
    )

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                codes = Segment(row["n_tokens"], row["payload"], row["bitmaps"], row["ranks"], chunk_bits)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["begin"] + i for i in row["local"]], pa.int64()),
                    pa.array([codes.token(i) for i in row["local"]], pa.int64()),
                ], names=["position", "token"])

    return wanted.mapInArrow(look, "position long, token long")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def token_files(spark: SparkSession, docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    return read_documents(write_tokens(docs, tokenizer_path or default_tokenizer()))

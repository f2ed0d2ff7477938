"""Benchmark decontamination by template canonicalisation.

Numbers, names and units are replaced by typed placeholders: ``#`` a number
(also 1,200.5), ``@`` a run of capitalised words inside a sentence, ``%`` a unit
of measure. The remaining words are lower-cased. Windows of ``WINDOW`` words of
this template, widened until they hold ``MIN_LITERALS`` ordinary words, are
hashed and joined between documents and benchmark items. A capitalised word
that opens a sentence may be a name or not: both readings are cut, on the
item's side also with single words read the other way. Windows of plain words
are cut as well, so verbatim copies join whatever they consist of. Items below
``WINDOW`` words or ``MIN_LITERALS`` ordinary words are cut as a whole, and
documents at the few widths of such items.

What a document holds around its windows that join, as far as the longest item
reaches, is aligned with the item word by word: equal words and slots of the
same type line up, a name of any number of words with a name. Neighbouring
pieces of an alignment add up, so inserted, dropped and changed words only cost
what they cover; a piece counts from about three words on (``BREAK``). The item
is re-parameterised consistently if each slot value of the item always stands
for one value in the document.

A document is contaminated by an item if the aligned words are ``MIN_COVER`` of
the item's words, or ``MIN_RUN`` of them; words in an inconsistent slot do not
count as covered.

The corpus has far more windows than match. A bit map of the item windows of
fixed size (``FILTER_BITS`` bits with two places a window, whatever the number
of items) goes to every task and drops windows that cannot join; the equi-join
of hashes decides.

Not found: a changed copy without any window in common, also one where two
sentence openings of the document within one window need different readings.
Whole items with fewer than 2 ordinary words and below ``WINDOW`` words are
found re-parameterised only where they are the whole document.

Cases: null and empty texts match nothing; repeated rows each match, and equal
(doc_id, item_id) give one row; a row without doc_id or item_id is kept under
null; an empty table on either side gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..staging import stage
from .textbytes import LOWER, NOT_ALNUM, Slice, U, byte_table, mix, prefix_sums, slices, span_hashes, words

WINDOW = 5
MIN_COVER = 0.8
MIN_RUN = 20
MIN_LITERALS = 3
FILTER_BITS = 22
#: What a break of an alignment costs, in words.
BREAK = 2

#: Units of measure.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t lb lbs oz ml l s sec min h hr hrs hour hours day days week weeks month months year years "
    "meter meters metre metres kilometer kilometers mile miles foot feet inch inches gram grams kilogram kilograms "
    "liter liters litre litres pound pounds dollar dollars euro euros cent cents usd eur percent degree degrees"
).split()
_NUMBER, _NAME, _UNIT = (U(x) for x in (0x1111, 0x2222, 0x3333))
_SENTENCE = byte_table(b".!?:;\n\"")
_NUMBERS, _NAMES, _UNITS, _OPENS = 1, 2, 3, 4


def _template(part: Slice):
    """Words of a slice: spans, rows, kind per word (``_OPENS``: capitalised, opens a sentence), hash per word."""
    found = words(part, NOT_ALNUM)
    starts, ends, rows = found.starts, found.ends, found.rows
    n = len(starts)
    if not n:
        return starts, ends, rows, np.zeros(0, np.int8), np.zeros(0, np.uint64)
    first = part.data[starts]
    sums = prefix_sums(LOWER[part.data])
    hashes = span_hashes(sums, starts, ends)
    number = (first >= 0x30) & (first <= 0x39)
    stops = np.concatenate([[0], np.cumsum(_SENTENCE[part.data])])
    opens = np.ones(n, bool)
    opens[1:] = (stops[starts[1:]] > stops[ends[:-1]]) | (rows[1:] != rows[:-1])
    capital = (first >= 0x41) & (first <= 0x5A)
    unit = np.isin(hashes, _UNIT_HASHES) & ~capital
    kind = np.where(number, _NUMBERS, np.where(capital, np.where(opens, _OPENS, _NAMES), np.where(unit, _UNITS, 0))).astype(np.int8)
    # 1,200.5 is one number: the word after a point or comma inside it goes.
    joined = np.zeros(n, bool)
    close = number[1:] & number[:-1] & (starts[1:] == ends[:-1] + 1) & (rows[1:] == rows[:-1])
    joined[1:] = close & np.isin(part.data[ends[:-1].clip(max=len(part.data) - 1)], [0x2C, 0x2E])
    if joined.any():
        keep = ~joined
        last = np.append(np.flatnonzero(keep)[1:], n) - 1
        starts, ends, rows, kind = starts[keep], ends[last], rows[keep], kind[keep]
        hashes = span_hashes(sums, starts, ends)
    return starts, ends, rows, kind, hashes


_UNIT_HASHES = np.array([span_hashes(prefix_sums(np.frombuffer(u.encode(), np.uint8)), np.zeros(1, np.int64), np.full(1, len(u)))[0] for u in UNITS], np.uint64)

SEGMENTS = "seg long, id long, start int, n_words int, kinds array<tinyint>, tokens array<string>, pos array<int>, h array<long>"
FOUND = "doc_id long, item_id long, item_words int, covered_words long, cover double, doc_word int, slots long, changed_slots long, consistent boolean, reparameterised boolean"


class _Reading:
    """The words of a slice under one reading of its sentence openings (``names``: those read as names; None: plain words)."""

    def __init__(self, kind: np.ndarray, hashes: np.ndarray, rows: np.ndarray, names: np.ndarray | None):
        if names is None:
            self.at, self.kind, codes = np.arange(len(kind)), np.zeros(len(kind), np.int8), hashes ^ _PLAIN
        else:
            read = np.where(kind == _OPENS, np.where(names, _NAMES, 0), kind)
            keep = np.ones(len(kind), bool)
            keep[1:] = (kind[1:] != _NAMES) | (read[:-1] != _NAMES)
            self.at = np.flatnonzero(keep)
            self.kind = read[self.at]
            codes = np.where(self.kind == 0, hashes[self.at], _CODES[self.kind])
        self.plain, self.rows, n = names is None, rows[self.at], len(self.at)
        self.sums = prefix_sums(np.arange(n), mix(codes))
        self.literal = np.concatenate([[0], np.cumsum(self.kind == 0)])

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """(word, hash) of the windows with enough ordinary words."""
        n = len(self.at)
        begins = np.arange(n)
        ends = np.maximum(begins + WINDOW, np.searchsorted(self.literal, self.literal[:-1] + MIN_LITERALS))
        begins = begins[ends <= n]
        ends = ends[:len(ends)][ends <= n]
        same = self.rows[begins] == self.rows[ends - 1]
        begins, ends = begins[same], ends[same]
        return self.at[begins], span_hashes(self.sums, begins, ends)

    def of_width(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(word, hash) of the windows of a width that some item has as a whole."""
        begins = np.arange(max(len(self.at) - width + 1, 0))
        ends = begins + width
        begins, ends = (x[self.rows[begins] == self.rows[ends - 1]] for x in (begins, ends))
        n = self.literal[ends] - self.literal[begins]
        whole = (np.searchsorted(self.rows, self.rows[begins]) == begins) & (np.searchsorted(self.rows, self.rows[begins], "right") == ends)
        fits = (n >= (2 if width < WINDOW else 1)) | (whole & (n > 0)) | self.plain
        return self.at[begins[fits]], span_hashes(self.sums, begins[fits], ends[fits])


_PLAIN = U(0x4444)
_CODES = np.array([0, _NUMBER, _NAME, _UNIT], np.uint64)


def _item_places(kind, hashes, rows):
    """(pos, hash, width of a window that is the whole item or 0) of one item."""
    opens = kind == _OPENS
    flips = [np.zeros(len(kind), bool), opens]
    for i in np.flatnonzero(opens):
        one = np.zeros(len(kind), bool)
        one[i] = True
        flips += [one, opens & ~one]
    found = set()
    for names in [None, *flips]:
        reading = _Reading(kind, hashes, rows, names)
        at, h = reading.windows()
        found.update((int(i), int(x.view(np.int64)), 0) for i, x in zip(at, h))
        n = len(reading.at)
        if n < WINDOW or int(reading.literal[-1]) < MIN_LITERALS:
            x = span_hashes(reading.sums, np.zeros(1, np.int64), np.full(1, n))[0]
            if reading.literal[-1]:
                found.add((0, int(x.view(np.int64)), n))
    return found


def _segments(bits: np.ndarray | None, widths: list[int], margin: int):
    """Items: a row each. Documents (with a bit map): what stands ``margin`` words around windows that may join."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for part in slices(batch.column(1)):
                starts, ends, rows, kind, hashes = _template(part)
                if not len(starts):
                    continue
                first = np.searchsorted(rows, np.arange(part.hi - part.lo + 1))
                out = []
                if bits is None:
                    for row in np.flatnonzero(np.diff(first)):
                        a, b = int(first[row]), int(first[row + 1])
                        places = sorted(_item_places(kind[a:b], hashes[a:b], rows[a:b]))
                        out.append((row, a, b, [x[0] for x in places], [x[1] for x in places], [x[2] for x in places]))
                else:
                    seeds = []
                    for names in (None, np.zeros(len(kind), bool), kind == _OPENS):
                        reading = _Reading(kind, hashes, rows, names)
                        for at, h in [reading.windows(), *(reading.of_width(w) for w in widths)]:
                            hit = _has(bits, h)
                            seeds.append((at[hit], h[hit]))
                    at, h = (np.concatenate(x) for x in zip(*seeds))
                    order = np.argsort(at, kind="stable")
                    at, h = at[order], h[order].view(np.int64)
                    apart = np.flatnonzero((np.diff(at) > 2 * margin) | (np.diff(rows[at]) > 0)) + 1
                    for lo, hi in zip([0, *apart.tolist()], [*apart.tolist(), len(at)]):
                        if lo < hi:
                            row = int(rows[at[lo]])
                            a, b = max(int(at[lo]) - margin, int(first[row])), min(int(at[hi - 1]) + 2 * margin + WINDOW, int(first[row + 1]))
                            out.append((row, a, b, (at[lo:hi] - a).tolist(), h[lo:hi].tolist(), None))
                for row, a, b, pos, h, whole in out:
                    tokens = [LOWER[part.data[starts[j]:ends[j]]].tobytes().decode("utf-8", "replace") for j in range(a, b)]
                    id_, start = ids[part.lo + row], a - int(first[row])
                    seg = hashlib.md5(repr((id_, start, tokens, kind[a:b].tolist())).encode("utf-8", "replace")).digest()[:8]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([int.from_bytes(seg, "little", signed=True)], pa.int64()), pa.array([id_], pa.int64()), pa.array([start], pa.int32()),
                        pa.array([int(first[row + 1] - first[row])], pa.int32()), pa.array([kind[a:b].tolist()], pa.list_(pa.int8())),
                        pa.array([tokens], pa.list_(pa.string())), pa.array([pos], pa.list_(pa.int32())), pa.array([h], pa.list_(pa.int64())),
                        *([] if whole is None else [pa.array([whole], pa.list_(pa.int32()))]),
                    ], names=["seg", "id", "start", "n_words", "kinds", "tokens", "pos", "h", *([] if whole is None else ["whole"])])

    return cut


def _places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return hashes >> U(64 - FILTER_BITS), hashes & U((1 << FILTER_BITS) - 1)


def _has(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    one, two = ((bits[(at >> U(3)).astype(np.int64)] >> (at & U(7)).astype(np.uint8) & 1).astype(bool) for at in _places(hashes))
    return one & two


def filter_bits(windows: DataFrame) -> np.ndarray:
    """Bit map of the window hashes: a fixed 2**FILTER_BITS bits, put together by Spark."""
    place = F.explode(F.array(F.shiftrightunsigned("h", 64 - FILTER_BITS), F.col("h").bitwiseAND(F.lit((1 << FILTER_BITS) - 1)))).alias("p")
    words_ = windows.select(place).groupBy(F.floor(F.col("p") / 32).cast("int").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(p % 32 AS int))) AS v"))
    bits = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    for row in words_.toLocalIterator():
        bits[row.w] = row.v
    return bits.view(np.uint8)


def _collapsed(kinds, tokens):
    """Runs of names inside a sentence as one word each: kind, value, words, first word."""
    out: list[list] = []
    for i, (k, t) in enumerate(zip(kinds, tokens)):
        if k == _NAMES and out and out[-1][0] == _NAMES:
            out[-1][1] += " " + t
            out[-1][2] += 1
        else:
            out.append([k, t, 1, i])
    return out


def align(mine: list, theirs: list) -> list[tuple[int, int, int, int]]:
    """Best alignment of collapsed words: (i, number of words of mine, j, number of theirs), ascending."""
    n, m = len(mine), len(theirs)
    codes: dict = {}
    value = np.array([codes.setdefault(x[1], len(codes)) for x in theirs])
    kind = np.array([_NAMES if x[0] == _OPENS else x[0] for x in theirs])
    pair = np.zeros(m, bool)
    pair[1:] = [theirs[j - 1][0] == _OPENS and theirs[j][0] == _NAMES for j in range(1, m)]
    low = np.float32(-1e9)
    score = np.full((n + 2, m + 2), low, np.float32)  # [i + 2, j + 2]: mine[i] and theirs[j] end the alignment
    best = np.zeros((n + 2, m + 2), np.float32)  # of all pairs up to there

    def before(i, j0):
        """Best score that a pair after mine[i - 1] and theirs[j0 - 1 ...] goes on from."""
        return np.maximum(np.maximum(score[i + 1, 1 - j0:m + 1 - j0], best[i + 1, 1 - j0:m + 1 - j0] - BREAK), 0)

    for i in range(n):
        k = _NAMES if mine[i][0] == _OPENS else mine[i][0]
        same = value == codes.get(mine[i][1], -1)
        slot = (kind == k) & (k != 0)
        w = mine[i][2]
        row = np.where(same, w, np.where(slot, np.float32(0.9 * w), low)) + before(i, 0)
        if k == _NAMES:
            row = np.maximum(row, np.where(pair, np.float32(0.85 * w), low) + before(i, 1))
            if mine[i][0] == _NAMES and i and mine[i - 1][0] == _OPENS:
                row = np.maximum(row, np.where(slot, np.float32(0.85 * (w + 1)), low) + before(i - 1, 0))
        score[i + 2, 2:] = row
        best[i + 2, 2:] = np.maximum(best[i + 1, 2:], np.maximum.accumulate(np.maximum(row, 0)))
    at = int(score.argmax())
    i, j = divmod(at, m + 2)
    path = []
    while score[i, j] > 0:
        x, y, now = i - 2, j - 2, float(score[i, j])
        k, w = (_NAMES if mine[x][0] == _OPENS else mine[x][0]), mine[x][2]
        ways = [(1, 1, w if mine[x][1] == theirs[y][1] else 0.9 * w if k and kind[y] == k else None)]
        if k == _NAMES:
            ways.append((1, 2, 0.85 * w if pair[y] else None))
            ways.append((2, 1, 0.85 * (w + 1) if mine[x][0] == _NAMES and x and mine[x - 1][0] == _OPENS and kind[y] == k else None))
        for di, dj, gain in ways:
            if gain is not None:
                a, b = score[i - di, j - dj], best[i - di, j - dj] - BREAK
                if abs(gain + max(a, b, 0) - now) < 1e-2:
                    break
        path.append((x - di + 1, di, y - dj + 1, dj))
        i, j = i - di, j - dj
        if a >= max(b, 0):
            continue
        if b <= 0:
            break
        i, j = divmod(int(np.abs(score[:i + 1, :j + 1] - (b + BREAK)).argmin()), j + 1)
    return path[::-1]


def _figures(mine: list, theirs: list, n_words: int, start: int):
    path = align(mine, theirs)
    values: dict = {}
    for i, di, j, dj in path:
        parts, others = mine[i:i + di], theirs[j:j + dj]
        slot = any(x[0] for x in parts) and not (parts[0][0] == _OPENS and di == dj == 1 and parts[0][1] == others[0][1])
        entry = values.setdefault((slot, " ".join(x[1] for x in parts)), [0, set()])
        entry[0] += sum(x[2] for x in parts)
        entry[1].add(" ".join(x[1] for x in others))
    covered = sum(n for (slot, _), (n, their) in values.items() if not slot or len(their) == 1)
    slots = {k[1]: v[1] for k, v in values.items() if k[0]}
    broken = sum(len(v) > 1 for v in slots.values())
    changed = sum(v != {k} for k, v in slots.items())
    offset = start + theirs[path[0][2]][3] - mine[path[0][0]][3] if path else 0
    return covered, covered / n_words, offset, len(slots), changed, broken == 0, changed > 0


def _verify(min_cover: float, min_run: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                n, m, best = row["n_words"], len(row["dtokens"]), None
                mine = _collapsed(row["kinds"], row["tokens"])
                done = -1
                for p in sorted(row["dpos"]):
                    if p < done:
                        continue
                    a, b, done = max(p - n - 16, 0), min(p + 2 * n + 32, m), p + n + 16
                    got = _figures(mine, _collapsed(row["dkinds"][a:b], row["dtokens"][a:b]), n, row["start"] + a)
                    if best is None or (got[0], -got[2]) > (best[0], -best[2]):
                        best = got
                if best[1] >= min_cover or best[0] >= min_run:
                    out.append((row["doc_id"], row["item_id"], n, *best))
            if out:
                yield pa.RecordBatch.from_arrays([
                    pa.array(x, t) for x, t in zip(zip(*out), [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()])
                ], names=[x.split()[0] for x in FOUND.split(", ")])

    return verify


def contamination(docs: DataFrame, items: DataFrame, min_cover: float = MIN_COVER, min_run: int = MIN_RUN) -> DataFrame:
    """(doc_id, item_id) of contaminated documents, with the best alignment's figures."""
    asked = stage(items.select("item_id", "text").mapInArrow(_segments(None, [], 0), SEGMENTS + ", whole array<int>").dropDuplicates(["seg"]), "items")
    places = asked.select(F.col("seg").alias("item"), F.explode(F.arrays_zip("h", "whole")).alias("w")).select("item", "w.*").distinct()
    margin = asked.agg(F.max("n_words")).first()[0] or 0
    widths = sorted(r.whole for r in places.filter("whole > 0").select("whole").distinct().toLocalIterator())
    seen = stage(docs.select("doc_id", "text").mapInArrow(_segments(filter_bits(places), widths, margin), SEGMENTS), "doc-segments")
    seeds = seen.select("seg", F.explode(F.arrays_zip("pos", "h")).alias("w")).select("seg", F.col("w.pos").alias("p"), F.col("w.h").alias("h"))
    pairs = stage(
        seeds.join(places.select("item", "h").distinct(), "h").groupBy("seg", "item").agg(F.collect_set("p").alias("dpos")), "pairs",
    )
    found = (
        pairs.join(seen.select("seg", F.col("id").alias("doc_id"), "start", F.col("kinds").alias("dkinds"), F.col("tokens").alias("dtokens")).dropDuplicates(["seg"]), "seg")
        .join(asked.select(F.col("seg").alias("item"), F.col("id").alias("item_id"), "n_words", "kinds", "tokens"), "item")
        .select("doc_id", "item_id", "n_words", "kinds", "tokens", "start", "dkinds", "dtokens", "dpos")
        .mapInArrow(_verify(min_cover, min_run), FOUND)
    )
    names = [x.split()[0] for x in FOUND.split(", ")][3:]
    pick = F.max_by(F.struct(*names), F.struct("covered_words", F.negative("doc_word").alias("late")))
    return found.groupBy("doc_id", "item_id", "item_words").agg(pick.alias("b")).select("doc_id", "item_id", "item_words", "b.*")


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item; rows are told apart by their hash."""
    row = F.xxhash64("doc_id", "text")
    bad = stage(contamination(docs.select(row.alias("doc_id"), "text"), items).select(F.col("doc_id").alias("_row")).distinct(), "contaminated")
    return docs.join(bad, row == F.col("_row"), "left_anti").select(*docs.columns)

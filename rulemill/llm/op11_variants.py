"""Spelling variant grouping: sorted-list dynamic programming over word lists.

Words are counted over all documents. Two words are near if they differ by one
inserted, deleted or replaced code point. Near words are found in sorted lists:

* **Lists.** One edit lies in one half of the shorter word, so the other half is
  shared: a word goes to lists keyed by (length of the shorter word, half, text
  outside the half), as shorter and as longer word. A pair belongs to the list
  whose half holds its first difference, so it is found once. A list above
  ``LIST_WORDS`` is cut in the same way again: its zone is halved, the key
  grows. A zone of one code point cannot be cut; its list holds at most the
  letters and pairs of letters of the alphabet. So no key, however frequent,
  gathers an unbounded list, and every pair keeps its list.
* **Scan.** In a list, what stands in the zone is sorted, and the longest common
  prefixes (LCPs) of neighbours tell which rows of the edit matrix are shared:
  every distinct prefix gets one row per query, three cells wide (band of one
  edit). A row above one edit ends the whole range of words with that prefix.
  All queries and lists of a batch advance together, one column of code points
  per step.

A word's form is its near word of largest count, if that is ``RATIO`` times its
own; following forms to the last (pointer doubling, each form being ten times as
frequent as the one before) gives the root.

Cases: null and empty texts hold no words; a null doc_id counts as empty text
in the hash that picks the runs to shorten; repeated rows count again; a run may
be as long as its text; an empty table gives no words; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..staging import stage
from .op13_cover_tree import _ranges as ranges

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: One run in so many loses a code point.
SHORTENED = 31
MIN_LETTERS = 7
MIN_COUNT = 2
RATIO = 10
#: Words of a list that is scanned as it is.
LIST_WORDS = 4096
#: Code points of the lists that one task scans together.
BATCH_LETTERS = 1 << 19


def words(docs: DataFrame, min_letters: int = MIN_LETTERS) -> DataFrame:
    """One row per run, lower-cased, shortened where its hash says so, long enough."""
    run = F.col("run")
    size = F.length(run)
    hashed = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (F.col("h") % size).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, size))
    return (
        docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
        .filter(size >= min_letters)
        .select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))
        .select("run", hashed.alias("h"))
        .select(F.when(F.col("h") % SHORTENED == 0, shorter).otherwise(run).alias("word"))
        .filter(F.length("word") >= min_letters)
    )


def vocabulary(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n of the words with at least ``min_count`` occurrences."""
    return words(docs, min_letters).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def _placed(rows: DataFrame) -> DataFrame:
    """Adds the list's key and the text in the zone.

    ``m``: length of the list's shorter words; the zone is ``lo`` to ``hi`` in
    their positions, one more in a longer word.
    """
    word, lo, hi = F.col("word"), F.col("lo"), F.col("hi")
    size = F.length(word)
    tail = F.col("m") - hi
    before, after = F.substring(word, F.lit(1), lo), F.substring(word, size - tail + 1, tail)
    return rows.select(
        "word", "n", "m", "lo", "hi",
        F.substring(word, lo + 1, size - tail - lo).alias("zone"),
        # Two hashes of the text outside the zone: 128 bits tell lists apart.
        F.xxhash64("m", "lo", "hi", before, after).alias("key"),
        F.xxhash64(F.lit("second"), after, before, "hi", "lo", "m").alias("key2"),
    )


def _halves(rows: DataFrame) -> DataFrame:
    """Each row once for either half of its zone."""
    middle = F.floor((F.col("lo") + F.col("hi") + 1) / 2).cast("int")
    zones = F.array(F.struct(F.col("lo").alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), F.col("hi").alias("hi")))
    return _placed(rows.select("word", "n", "m", F.explode(zones).alias("z")).select("word", "n", "m", "z.lo", "z.hi"))


def word_lists(vocabulary: DataFrame, list_words: int = LIST_WORDS) -> DataFrame:
    """Words in lists of two words to ``list_words`` (zones of one code point: whatever they hold)."""
    size = F.length("word")
    whole = vocabulary.select("word", "n", F.explode(F.array(size, size - 1)).alias("m"))
    open_lists = _halves(whole.select("word", "n", "m", F.lit(0).alias("lo"), F.col("m").alias("hi")))
    done = None
    while True:
        open_lists = stage(open_lists, "lists")
        # Staged, so that adaptive execution can split a list that holds much of the table.
        sizes = stage(
            open_lists.groupBy("key", "key2").agg(F.count(F.lit(1)).alias("size"), F.max(F.col("hi") - F.col("lo")).alias("width"))
            .filter("size > 1"), "list-sizes")
        sized = open_lists.join(sizes, ["key", "key2"])
        large = (F.col("size") > list_words) & (F.col("width") > 1)
        small = sized.filter(~large).drop("size", "width")
        done = small if done is None else done.unionByName(small)
        if sizes.filter(large).isEmpty():
            return done
        open_lists = _halves(sized.filter(large).drop("size", "width"))


def _letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all rows and where each row starts (rows + 1 numbers)."""
    texts = column.to_pylist()
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32), np.append(0, np.cumsum(sizes))


def near_in_lists(letters: np.ndarray, starts: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, word, shared) of the pairs one edit apart in the same list.

    Rows are sorted by list and text. ``shared`` is the length of the common
    prefix. Edit-matrix rows are kept per query and distinct prefix: cells of
    the columns d-1, d, d+1 for a prefix of d code points, 2 standing for more
    than one edit.
    """
    n, sizes = len(lists), np.diff(starts)
    common = _common_prefixes(letters, starts, lists)
    first = np.append(True, lists[1:] != lists[:-1])
    firsts = np.flatnonzero(first)
    # Frontier: query, range of rows with the same prefix, the matrix row, how much of the prefix equals the query.
    query = np.arange(n)
    lo = firsts[np.cumsum(first) - 1]
    hi = np.append(firsts[1:], n)[np.cumsum(first) - 1]
    row = np.full((n, 3), 2, np.uint8)
    row[:, 1] = 0
    row[:, 2] = np.where(sizes > 0, 1, 2)
    shared = np.zeros(n, np.int64)
    found = []
    depth = 0
    while len(query):
        # Words that end here stand first in their range; there may be equal ones.
        column = sizes[query] - depth + 1
        ends = (sizes[lo] == depth) & (column >= 0) & (column <= 2)
        at = np.flatnonzero(ends)
        at = at[row[at, column[at]] == 1]
        if len(at):
            found.append(np.column_stack([query[at], lo[at], shared[at]]))
        # The next prefixes: starts of ranges whose LCP with their neighbour is below depth + 1.
        begins = np.flatnonzero((first | (common <= depth)) & (sizes > depth))
        a, b = np.searchsorted(begins, lo), np.searchsorted(begins, hi)
        count = b - a
        child = ranges(a, count)
        old, query, shared, top = np.repeat(row, count, axis=0), np.repeat(query, count), np.repeat(shared, count), np.repeat(hi, count)
        lo = begins[child]
        after = np.append(begins, n)[child + 1]
        hi = np.minimum(after, top)
        letter = letters[starts[lo] + depth]
        depth += 1
        row = np.full((len(query), 3), 2, np.uint8)
        size, base = sizes[query], starts[query]
        for k in range(3):
            j = depth - 1 + k  # column: so much of the query
            inside = j <= size
            best = np.full(len(query), 2, np.uint8)
            if j > 0:
                same = letters[np.minimum(base + j - 1, len(letters) - 1)] == letter
                best = np.where(inside, old[:, k] + ~same, 2)
            if k < 2:
                best = np.minimum(best, old[:, k + 1] + 1)
            if k:
                best = np.minimum(best, row[:, k - 1] + 1)
            row[:, k] = np.where(inside, np.minimum(best, 2), 2)
        shared = np.where((row[:, 1] == 0) & (shared == depth - 1), depth, shared)
        alive = row.min(axis=1) <= 1
        query, lo, hi, row, shared = query[alive], lo[alive], hi[alive], row[alive], shared[alive]
    pairs = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    return pairs[:, 0], pairs[:, 1], pairs[:, 2]


def _common_prefixes(letters: np.ndarray, starts: np.ndarray, lists: np.ndarray) -> np.ndarray:
    """LCP of each row with the row before it, 0 at the start of a list."""
    n, sizes = len(lists), np.diff(starts)
    common = np.zeros(n, np.int64)
    going = np.flatnonzero(lists[1:] == lists[:-1]) + 1
    depth = 0
    while len(going):
        going = going[(sizes[going] > depth) & (sizes[going - 1] > depth)]
        going = going[letters[starts[going] + depth] == letters[starts[going - 1] + depth]]
        common[going] += 1
        depth += 1
    return common


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of the lists in sorted rows; a list never ends inside what is scanned."""
    for table in _whole_lists(batches):
        key = np.asarray(table["key"].combine_chunks())
        key2 = np.asarray(table["key2"].combine_chunks())
        lists = np.cumsum(np.append(0, (key[1:] != key[:-1]) | (key2[1:] != key2[:-1])))
        letters, starts = _letters(table["zone"].combine_chunks())
        query, word, shared = near_in_lists(letters, starts, lists)
        m, lo, hi = (np.asarray(table[c].combine_chunks()) for c in ("m", "lo", "hi"))
        longer = np.diff(starts) > hi - lo
        # Two words of the longer length meet in a list of their own length; a
        # pair whose first difference lies behind the zone meets in another list.
        mine = ~(longer[query] & longer[word]) & ((shared < (hi - lo)[query]) | (hi == m)[query])
        query, word = query[mine], word[mine]
        yield pa.RecordBatch.from_pydict({
            "word": table["word"].take(query).combine_chunks(),
            "near": table["word"].take(word).combine_chunks(), "near_n": table["n"].take(word).combine_chunks(),
        })


def _whole_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held = []
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        if sum(b["zone"].nbytes for b in held) < BATCH_LETTERS:
            continue
        table = pa.Table.from_batches(held)
        key, key2 = np.asarray(table["key"].combine_chunks()), np.asarray(table["key2"].combine_chunks())
        borders = np.flatnonzero((key[1:] != key[:-1]) | (key2[1:] != key2[:-1])) + 1
        if len(borders):
            yield table.slice(0, borders[-1])
            held = table.slice(borders[-1]).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held)


def near_pairs(lists: DataFrame) -> DataFrame:
    """word, near, near_n: each pair of near words in both directions."""
    columns = ["word", "n", "m", "lo", "hi", "zone", "key", "key2"]
    return (
        lists.select(*columns).repartition("key", "key2").sortWithinPartitions("key", "key2", "zone")
        .mapInArrow(_scan, "word string, near string, near_n long")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form, by pointer doubling.

    Counts rise tenfold along forms, so a chain has at most 18 steps and five
    rounds follow it; they stop when nothing moves.
    """
    at = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = at.select(F.col("word").alias("_word"), F.col("root").alias("_next"))
        moved = stage(
            at.join(step, F.col("root") == F.col("_word"), "left")
            .select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "roots")
        if moved.filter("moved").isEmpty():
            return moved.select("word", "root")
        at = moved.select("word", "root")


def spelling_variants(
    docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, ratio: int = RATIO, list_words: int = LIST_WORDS
) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word."""
    known = stage(vocabulary(docs.select("doc_id", "text"), min_letters, min_count), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    near = stage(
        near_pairs(word_lists(known, list_words)).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best")), "near")
    found = stage(
        known.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(-F.col("best.less") >= ratio * F.col("n"), F.struct(F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))).alias("f"),
        ).select("word", "n", "n_near", "f.form", "f.form_n"), "forms")
    roots = _roots(found.filter("form is not null"))
    return found.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))

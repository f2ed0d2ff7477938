"""Line and paragraph dedup over the whole corpus.

A text is cut into units: lines (``\\n``), paragraphs (blank lines between) or
``sentence``: lines that are cut again behind ``.``, ``!`` and ``?`` before a
blank, so that a passage that begins inside a line is found too. Every such end
cuts, and every unit is compared.
A unit is normalised (lower case, runs of white space become one blank, ends
trimmed) and its 128-bit digest grouped globally. The occurrence first by
(doc_id, start) stays, every other one is removed. Spans keep their character
offsets in the original text, the line feed not included.

Every unit that is not blank is compared, however short: hard-wrapped passages
consist of short lines. ``min_words`` is for callers that want a floor.

``repeated_units`` reports every later occurrence. That deletes lone lines such
as "of." from texts that have nothing else in common, so ``repeated_passages``
keeps those whose *passage* is long enough: units that follow each other in a
text (blank ones aside) and are all later occurrences are one passage, be it a
line, a paragraph or more, and it goes if it has ``PASSAGE_WORDS`` words. With
``every`` the occurrences that stay count and are reported too, so that each text
holding a repeated passage has rows; ``removed`` tells which of them go.

A unit may be in any share of the documents: digests are counted with map-side
combining, and only units that occur twice or more go further. First occurrences
come from another such aggregate, are written, and join the occurrences in a plain
equi-join, which adaptive execution splits where it is skewed.

Cases: null and empty texts have no units; repeated rows are occurrences like
others (equal doc_id and start: one stays, ``copy`` tells them apart); a null
doc_id ranks last; a text of any length is cut in its task; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..staging import stage

MIN_WORDS = 1
#: Words of a passage of neighbouring repeated units that is removed.
PASSAGE_WORDS = 20
SEPARATORS = {"line": re.compile(r"\n"), "paragraph": re.compile(r"\n[ \t\r]*\n\s*"), "sentence": re.compile(r"\n|(?<=[.!?])(?=[ \t])")}
#: White space of the normalisation: the same bytes in every engine.
_BLANK = re.compile(r"[ \t\n\x0b\x0c\r]+")


def units(text: str, unit: str = "line", min_words: int = MIN_WORDS) -> Iterator[tuple[int, int, str]]:
    """(start, end, normalised text) of the units of ``min_words`` words or more."""
    start = 0
    ends = [(m.start(), m.end()) for m in SEPARATORS[unit].finditer(text)] + [(len(text), len(text))]
    for end, following in ends:
        normal = _BLANK.sub(" ", text[start:end].lower()).strip(" ")
        if normal.count(" ") + 1 >= min_words and normal:
            yield start, end, normal
        start = following


_UNITS = "doc_id long, start long, end long, digest binary, place long, words long, text_key long"


def _cut(unit: str, min_words: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                some = batch.slice(lo, 512)
                rows = [
                    (doc, start, end, hashlib.md5(normal.encode("utf-8", "surrogatepass")).digest(), place, normal.count(" ") + 1, key)
                    for doc, text, key in zip(*(some.column(c).to_pylist() for c in ("doc_id", "text", "text_key"))) if text
                    for place, (start, end, normal) in enumerate(units(text, unit, min_words))
                ]
                if rows:
                    columns = [pa.array(c, pa.binary() if i == 3 else pa.int64()) for i, c in enumerate(zip(*rows))]
                    yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _UNITS.split(", ")])

    return cut


def _occurrences(docs: DataFrame, unit: str, min_words: int, every: bool = False) -> DataFrame:
    """Every later occurrence with its place among the units of its text; with ``every`` the first ones too."""
    cut = stage(
        docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInArrow(_cut(unit, min_words), _UNITS), "units")
    often = stage(cut.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest"), "repeated-digests")
    found = stage(cut.join(often, "digest", "left_semi"), "repeated-units")
    # Counted before the join, by place: so a digest that holds much of the corpus
    # is only met in the join, which adaptive execution splits.
    places = found.groupBy("digest", "doc_id", "start", "end", "text_key").agg(
        F.count(F.lit(1)).alias("copies"), F.first("place").alias("place"), F.first("words").alias("words"))
    firsts = stage(
        found.groupBy("digest").agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "start", "text_key")).alias("_first"),
        ).filter("n > 1").select(
            "digest", "n", F.col("_first.doc_id").alias("kept_doc_id"), F.col("_first.start").alias("kept_start"), F.col("_first.text_key").alias("kept_key")),
        "first-units",
    )
    is_first = F.col("doc_id").eqNullSafe(F.col("kept_doc_id")) & (F.col("start") == F.col("kept_start")) & (F.col("text_key") == F.col("kept_key"))
    told = F.col("copies") if every else F.col("copies") - is_first.cast("long")
    return (
        places.join(firsts, "digest")
        .withColumn("copy", F.explode(F.when(told > 0, F.sequence(F.lit(1).cast("long"), told)).otherwise(F.array().cast("array<bigint>"))))
        .withColumn("removed", ~(is_first & (F.col("copy") == 1)) if every else F.lit(True))
        .withColumn("digest", F.lower(F.hex("digest")))
    )


_REPEATED = ["doc_id", "start", "end", "digest", "kept_doc_id", "kept_start", "n", "copy"]


def repeated_units(docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS) -> DataFrame:
    """A row per later occurrence: doc_id, start, end, digest, kept_doc_id, kept_start, n, copy."""
    return _occurrences(docs, unit, min_words).select(*_REPEATED)


def repeated_passages(docs: DataFrame, unit: str = "sentence", passage_words: int = PASSAGE_WORDS, every: bool = False) -> DataFrame:
    """The rows of ``repeated_units`` that stand in a passage of ``passage_words`` words, with its ``passage_words``.

    With ``every`` first occurrences are rows as well, not ``removed``.
    Passages end with their text, so a window never spans documents.
    """
    text = ["doc_id", "text_key", "copy"]
    run = F.col("place") - F.row_number().over(Window.partitionBy(*text).orderBy("place"))
    together = F.sum("words").over(Window.partitionBy(*text, "run"))
    return (
        _occurrences(docs, unit, 1, every).withColumn("run", run).withColumn("passage_words", together)
        .filter(F.col("passage_words") >= passage_words).select(*_REPEATED, "passage_words", *(["removed"] if every else []))
    )


def remove_units(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """``docs`` (doc_id unique) with ``text`` cut and ``removed_spans`` of the original."""
    if "removed" in removed.columns:
        removed = removed.filter("removed")
    spans = removed.groupBy("doc_id").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("removed_spans"))

    def kept(text, gone):
        """Text between the removed spans; each goes with the line feed after it."""
        feed = lambda end: (F.substring(text, (end + 1).cast("int"), F.lit(1)) == "\n").cast("long")
        ends = F.concat(F.array(F.lit(0).cast("long")), F.transform(gone, lambda s: s["end"] + feed(s["end"])))
        begins = F.concat(F.transform(gone, lambda s: s["start"]), F.array(F.length(text).cast("long")))
        pieces = F.transform(F.arrays_zip(ends.alias("a"), begins.alias("b")), lambda p: F.substring(text, (p["a"] + 1).cast("int"), F.greatest(p["b"] - p["a"], F.lit(0)).cast("int")))
        return F.array_join(pieces, "")

    return docs.join(spans, "doc_id", "left").withColumn(
        "text", F.when(F.col("removed_spans").isNull(), F.col("text")).otherwise(kept(F.col("text"), F.col("removed_spans")))
    )


ORACLE = rf"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS row FROM documents),
c AS (SELECT doc_id, row, string_split(regexp_replace(line, '([.!?])([ \t])', '\1' || chr(57344) || '\2', 'g'), chr(57344)) AS parts FROM l),
u AS (SELECT doc_id, row, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos, len(parts) AS last FROM c),
o AS (
  SELECT doc_id, line, coalesce(sum(length(line) + CAST(pos = last AS INT)) OVER (
    PARTITION BY doc_id ORDER BY row, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM u),
n AS (
  SELECT doc_id, CAST(start AS BIGINT) AS start, CAST(start + length(line) AS BIGINT) AS "end",
         trim(regexp_replace(lower(line), '[ \t\n\x0B\x0C\r]+', ' ', 'g'), ' ') AS normal FROM o),
d AS (
  SELECT doc_id, start, "end", md5(normal) AS digest, length(normal) - length(replace(normal, ' ', '')) + 1 AS words,
         row_number() OVER (PARTITION BY doc_id ORDER BY start) AS place
  FROM n WHERE normal <> ''),
f AS (
  SELECT digest, count(*) AS n, arg_min(doc_id, (doc_id, start)) AS kept_doc_id, arg_min(start, (doc_id, start)) AS kept_start
  FROM d GROUP BY digest HAVING count(*) > 1),
r AS (
  SELECT d.*, f.kept_doc_id, f.kept_start, f.n, place - row_number() OVER (PARTITION BY d.doc_id ORDER BY place) AS run
  FROM d JOIN f USING (digest)),
p AS (SELECT *, CAST(sum(words) OVER (PARTITION BY doc_id, run) AS BIGINT) AS passage_words FROM r)
SELECT doc_id, start, "end", digest, kept_doc_id, kept_start, n, CAST(1 AS BIGINT) AS copy, passage_words,
       NOT (doc_id = kept_doc_id AND start = kept_start) AS removed
FROM p WHERE passage_words >= {PASSAGE_WORDS}
"""

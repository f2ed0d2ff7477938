"""License scans by diagonal voting.

Words of a text are runs of letters, digits and non-ASCII (A-Z lower-cased).
All rolling ``GRAM``-word hashes of the corpus join the positions of the same
hashes in the license templates. A match votes for its diagonal (document
position minus template position); votes are aggregated by diagonal,
neighbouring diagonals (inserted or dropped words) are merged into spans, and a
span counts if the template positions that its grams cover, compared word by
word, make up ``MIN_COVER`` of the template.

A gram with a word that no template has cannot join, so it is not sent to the
join; that loses nothing. Templates are a fixed table (``TEMPLATES``), so the
join's small side has a fixed size.

Base phrases are looked up besides (all places of their words in a row) and
give their label whatever the votes say; the base label's score is 1.

Cases: a null or empty text has 0 words and no label; a row keeps its own
answer, repeated or not, with or without doc_id; texts are cut into bounded
slices and a long one is its own; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..staging import stage
from .textbytes import LOWER, NOT_ALNUM, Slice, slices, span_hashes, prefix_sums, words

GRAM = 3
MIN_COVER = 0.7
#: Diagonals this close belong to one span.
DRIFT = 3

#: Words of the base phrases and their labels.
BASE = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}

#: Public license notices, as text.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc0", "This work has been dedicated to the public domain under CC0 1.0 Universal"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]


def split_words(text: bytes) -> list[bytes]:
    """Words of one text, as bytes."""
    part = next(iter(slices(pa.array([text], pa.large_binary()))))
    found = words(part, NOT_ALNUM)
    return [LOWER[part.data[a:b]].tobytes() for a, b in zip(found.starts, found.ends)]


def template_words(templates: list = TEMPLATES) -> list[tuple[str, list[str]]]:
    return [(label, [w.decode() for w in split_words(text.encode())]) for label, text in templates]


def _known(texts: list[str]) -> np.ndarray:
    """Sorted hashes of single words."""
    return np.unique(np.array([_hash(w) for w in texts], np.uint64))


def _hash(word: str) -> np.uint64:
    data = np.frombuffer(word.encode(), np.uint8)
    return span_hashes(prefix_sums(data), np.zeros(1, np.int64), np.full(1, len(data)))[0]


def _within(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


SCANNED = ("row long, doc_id long, n_words long, n_base long, first_word long, last_word long, "
           "base_labels array<string>, grams array<struct<pos: long, gram: string>>")


def _scan(templates: list, gram: int):
    vocabulary = _known([w for _, ws in template_words(templates) for w in ws])
    phrases = [(np.array([_hash(w) for w in phrase], np.uint64), phrase, label) for phrase, label in BASE.items()]

    def base_places(part: Slice, found, hashes: np.ndarray) -> dict[int, list[tuple[int, str]]]:
        places: dict[int, list[tuple[int, str]]] = {}
        for wanted, phrase, label in phrases:
            n = len(hashes) - len(wanted) + 1
            if n <= 0:
                continue
            same = np.ones(n, bool)
            for i, value in enumerate(wanted):
                same &= hashes[i:i + n] == value
            for at in np.flatnonzero(same & (found.rows[:n] == found.rows[len(wanted) - 1:])):
                texts = tuple(LOWER[part.data[found.starts[j]:found.ends[j]]].tobytes().decode("utf-8", "replace") for j in range(at, at + len(wanted)))
                if texts == phrase:
                    row = int(found.rows[at])
                    places.setdefault(row, []).append((int(at - found.first[row]), label))
        return places

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
            ("last_word", pa.int64()), ("base_labels", pa.list_(pa.string())),
            ("grams", pa.list_(pa.struct([("pos", pa.int64()), ("gram", pa.string())]))),
        ])
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch.column("text")):
                found = words(part, NOT_ALNUM)
                hashes = found.hashes(part)
                n = part.hi - part.lo
                base = base_places(part, found, hashes)
                grams: dict[int, list[dict]] = {}
                known = _within(hashes, vocabulary)
                joins = np.ones(max(len(known) - gram + 1, 0), bool)
                for i in range(gram):
                    joins &= known[i:i + len(joins)]
                joins &= found.rows[:len(joins)] == found.rows[gram - 1:][:len(joins)]
                for at in np.flatnonzero(joins):
                    text = b" ".join(LOWER[part.data[found.starts[j]:found.ends[j]]].tobytes() for j in range(at, at + gram))
                    where = int(found.rows[at])
                    grams.setdefault(where, []).append({"pos": int(at - found.first[where]), "gram": text.decode("utf-8", "replace")})
                places = [[p for p, _ in base.get(i, [])] for i in range(n)]
                columns = [
                    range(row, row + n), batch.column("doc_id").slice(part.lo, n), np.diff(found.first), [len(p) for p in places],
                    [min(p, default=None) for p in places], [max(p, default=None) for p in places],
                    [sorted({label for _, label in base.get(i, [])}) for i in range(n)], [grams.get(i, []) for i in range(n)],
                ]
                row += n
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return scan


def template_grams(spark: SparkSession, templates: list = TEMPLATES, gram: int = GRAM) -> DataFrame:
    """(template, label, n, tpos, tgram): every gram position of every template."""
    rows = [
        (number, label, len(ws), at, " ".join(ws[at:at + gram]))
        for number, (label, ws) in enumerate(template_words(templates)) for at in range(len(ws) - gram + 1)
    ]
    return spark.createDataFrame(rows, "template int, label string, n int, tpos int, tgram string")


def spans(scanned: DataFrame, templates: list = TEMPLATES, gram: int = GRAM, min_cover: float = MIN_COVER, drift: int = DRIFT) -> DataFrame:
    """Verified spans: row, label, begin, end (words), votes, cover."""
    spark = scanned.sparkSession
    hits = (
        scanned.select("row", F.explode("grams").alias("g")).select("row", "g.pos", "g.gram")
        .join(template_grams(spark, templates, gram), F.xxhash64("gram") == F.xxhash64("tgram"))
        .filter("gram = tgram")
        .withColumn("diagonal", F.col("pos") - F.col("tpos"))
    )
    diagonals = hits.groupBy("row", "template", "label", "n", "diagonal").agg(
        F.count(F.lit(1)).alias("votes"), F.min("pos").alias("begin"), (F.max("pos") + gram).alias("end"), F.collect_set("tpos").alias("tposes"),
    )
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    new = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > drift, F.lit(True)).cast("int")
    merged = (
        diagonals.withColumn("new", new)
        .withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .groupBy("row", "template", "label", "n", "island")
        .agg(F.sum("votes").alias("votes"), F.min("begin").alias("begin"), F.max("end").alias("end"), F.array_distinct(F.flatten(F.collect_list("tposes"))).alias("tposes"))
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("tposes", lambda p: F.sequence(p, p + gram - 1)))))
    return (
        merged.withColumn("cover", covered / F.col("n"))
        .filter(F.col("cover") >= min_cover)
        .select("row", "label", "begin", "end", "votes", "cover")
    )


def license_scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    scanned = stage(docs.select("doc_id", "text").mapInArrow(_scan(TEMPLATES, GRAM), SCANNED), "licenses")
    found = spans(scanned).groupBy("row").agg(F.collect_set("label").alias("more"), F.max("cover").alias("cover"))
    none = F.array().cast("array<string>")
    return (
        scanned.drop("grams").join(found, "row", "left")
        .select(
            "doc_id", "n_words", "n_base", "first_word", "last_word",
            F.array_join("base_labels", ",").alias("base_labels"),
            F.array_join(F.array_sort(F.array_union("base_labels", F.coalesce("more", none))), ",").alias("labels"),
            F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("cover", F.lit(0.0))).alias("score"),
        )
    )


def oracle_sql(templates: list = TEMPLATES, drift: int = DRIFT, min_cover: float = MIN_COVER) -> str:
    """The scan as SQL, for grams of three words."""
    grams = ", ".join(
        f"({number}, '{label}', {len(ws)}, {at}, '{' '.join(ws[at:at + 3])}')"
        for number, (label, ws) in enumerate(template_words(templates)) for at in range(len(ws) - 2)
    )
    places = " UNION ALL ".join(
        f"SELECT row, unnest(list_filter(range(1, len(w) + 1), lambda i: {' AND '.join(f"w[i + {k}] = '{word}'" for k, word in enumerate(phrase))})) - 1 AS first, '{label}' AS label FROM w"
        for phrase, label in BASE.items()
    )
    return rf"""
WITH t(template, label, n, tpos, gram) AS (VALUES {grams}),
w AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (SELECT row, count(*) AS n_base, min(first) AS first_word, max(first) AS last_word, list(DISTINCT label) AS labels FROM ({places}) GROUP BY row),
g AS (SELECT row, i - 1 AS pos, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram FROM (SELECT row, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
h AS (SELECT row, template, label, n, tpos, pos - tpos AS diagonal FROM g JOIN t USING (gram)),
d AS (
  SELECT row, template, diagonal, CASE WHEN diagonal - lag(diagonal) OVER o <= {drift} THEN 0 ELSE 1 END AS new
  FROM (SELECT DISTINCT row, template, diagonal FROM h) WINDOW o AS (PARTITION BY row, template ORDER BY diagonal)),
i AS (SELECT row, template, diagonal, sum(new) OVER (PARTITION BY row, template ORDER BY diagonal) AS island FROM d),
c AS (
  SELECT row, label, count(DISTINCT p) / n AS cover
  FROM (SELECT row, template, label, n, island, unnest(range(tpos, tpos + 3)) AS p FROM h JOIN i USING (row, template, diagonal))
  GROUP BY row, template, label, n, island HAVING count(DISTINCT p) / n >= {min_cover}),
v AS (SELECT row, list(DISTINCT label) AS labels, max(cover) AS cover FROM c GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(b.labels, v.labels))), ','), '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(cover, 0) END AS score
FROM w LEFT JOIN b USING (row) LEFT JOIN v USING (row)
"""

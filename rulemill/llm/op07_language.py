"""Language ID by Bayesian evidence fusion.

The posterior of a language is the product of

* the text: multinomial likelihood of its letter trigrams, hashed into
  ``BUCKETS``, under models fitted on at most ``SAMPLE_PER_LANGUAGE`` labelled
  rows of each language (those with the smallest hash of doc_id); the sum of
  log-likelihoods is scaled to at most ``TEXT_WEIGHT`` trigrams, because
  neighbouring trigrams are not independent;
* the declared markup language (``lang=`` of ``<html>``), right with
  probability ``DECLARED_RIGHT``;
* a language code in the address (a path part or the last part of the host),
  right with probability ``ADDRESS_RIGHT``;
* the host's prior: counts of what its pages look like by the other evidence,
  smoothed towards the counts of its parent domain, that towards the suffix,
  that towards all pages, with ``SMOOTHING`` pages' weight at each level.

Every language that a labelled row names has a model, however rare: 128 KiB each
on the driver and in each Python worker, a quarter of a gigabyte for 2,000.

Prior counts are grouped aggregates of all rows, at each level of the address;
they are written and joined back, so a host with any share of the pages is a
skewed equi-join that adaptive execution splits.

A row is rejected (language ``und``) if it has fewer than ``MIN_TRIGRAMS``
letter trigrams and no other evidence, or if its posterior is below
``MIN_POSTERIOR``.

Cases: null or empty texts have the other evidence only; a null or unreadable
address has the empty host; unknown declared languages say nothing; rows are
judged one by one, so repeated rows agree; ties go to the first language by
code point; a text of any length is judged whole, in memory that grows with it; with no labelled rows at all every
row is ``und``; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..staging import stage
from .textbytes import LOWER, Slice, U, byte_table, mix, slices

BUCKETS = 1 << 15
SAMPLE_PER_LANGUAGE = 400
TEXT_WEIGHT = 60.0
DECLARED_RIGHT = 0.9
ADDRESS_RIGHT = 0.8
SMOOTHING = 20.0
MIN_TRIGRAMS = 5
MIN_POSTERIOR = 0.6
UNKNOWN = "und"

_LETTER = byte_table([*range(65, 91), *range(97, 123), *range(128, 256)])
_TAG = re.compile(rb"<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", re.S | re.I)


# Text model


def trigrams(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every trigram of letters; any other byte is a blank."""
    data = np.where(_LETTER[part.data], LOWER[part.data], np.uint8(32)).astype(np.uint64)
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = data[:-2] << U(16) | data[1:-1] << U(8) | data[2:]
    rows = np.repeat(np.arange(len(part.offsets) - 1), np.diff(part.offsets))
    real = (rows[2:] == rows[:-2]) & (data[1:-1] != 32)
    return (mix(code[real]) % U(BUCKETS)).astype(np.int64), rows[:-2][real]


def fit(samples: DataFrame) -> tuple[list[str], np.ndarray]:
    """(lang, text) of the bounded sample -> languages and log-probabilities per bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for part in slices(batch.column("text")):
                bucket, row = trigrams(part)
                names = langs[part.lo:part.hi]
                for lang in sorted(set(names)):
                    mine = np.array([n == lang for n in names])
                    counts = np.bincount(bucket[mine[row]], minlength=BUCKETS)
                    used = np.flatnonzero(counts)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int64()), pa.array(counts[used], pa.int64())], names=["lang", "bucket", "n"])

    # At most BUCKETS rows of each language, whatever the corpus holds.
    rows = samples.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow().to_pydict()
    languages = sorted(set(rows["lang"]))
    counts = np.full((len(languages), BUCKETS), 0.05)
    at = {lang: i for i, lang in enumerate(languages)}
    np.add.at(counts, ([at[lang] for lang in rows["lang"]], rows["bucket"]), rows["n"])
    return languages, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


def labelled_sample(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """A bounded sample of (lang, text): rows with the smallest hashes of doc_id."""
    known = docs.filter("lang is not null and lang <> '' and doc_id is not null and text is not null")
    # A hash below its language's share gives about twice the rows wanted; the rank cuts it.
    shares = stage(known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).select("lang", (F.lit(2.0 * per_language) / F.col("n")).alias("share")), "language-shares")
    place = (F.xxhash64("doc_id", F.lit("sample")).cast("double") / 2.0**64) + 0.5
    order = Window.partitionBy("lang").orderBy("place", "doc_id", F.xxhash64("text"))
    return (
        known.select("lang", "doc_id", "text").withColumn("place", place).join(shares, "lang").filter(F.col("place") <= F.col("share"))
        .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= per_language).select("lang", "text")
    )


def _likelihoods(languages: list[str], model: np.ndarray, html: bool):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text")):
                if html:
                    plain = pa.array([_TAG.sub(b" ", part.text(i)) for i in range(part.hi - part.lo)], pa.large_binary())
                    bare = next(slices(plain, 1 << 62))
                    part = Slice(part.lo, part.hi, bare.data, bare.offsets)
                n = part.hi - part.lo
                bucket, row = trigrams(part)
                found = np.bincount(row, minlength=n)
                weight = np.minimum(1.0, TEXT_WEIGHT / np.maximum(found, 1))
                scores = np.stack([np.bincount(row, model[i][bucket], minlength=n) for i in range(len(languages))], axis=1) if len(languages) else np.zeros((n, 0))
                scores *= weight[:, None]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * len(languages), pa.int32()), pa.array(scores.ravel()))
                kept = [batch.column(c).slice(part.lo, n) for c in batch.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.int64()), lists], names=[*(c for c in batch.schema.names if c != "text"), "n_trigrams", "likelihoods"])

    return score


# Evidence


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/:?#]*)", 1), F.lit("")))


def declared_of(html: Column) -> Column:
    """Two or three letters of the ``lang`` of the html tag."""
    return F.lower(F.regexp_extract(F.coalesce(html, F.lit("")), r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z]{2,3})""", 1))


def _normalised(logs: Column) -> Column:
    """Probabilities of log-weights."""
    weights = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(weights, lambda w: w / F.aggregate(weights, F.lit(0.0), lambda a, x: a + x))


def _said(code: Column, languages: list[str], right: float) -> Column:
    """Log-weights of a language code that is right with probability ``right``."""
    wrong = (1 - right) / max(len(languages) - 1, 1)
    known = code.isin(languages)
    return F.array(*[F.when(~known | code.isNull(), 0.0).when(code == lang, float(np.log(right))).otherwise(float(np.log(wrong))) for lang in languages])


def _sum(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def _host_priors(seen: DataFrame, n: int) -> DataFrame:
    """(host, p) -> (host, prior): counts by host, smoothed up the levels of the address."""
    p = [f"p{i}" for i in range(n)]
    total = sum((F.col(x) for x in p), F.lit(0.0))

    def smoothed(up) -> Column:
        return F.array(*[(F.col(x) + SMOOTHING * up(i)) / (total + SMOOTHING) for i, x in enumerate(p)]).alias("prior")

    host = F.col("host")
    hosts = stage(seen.groupBy("host").agg(*[F.sum(F.get("p", i)).alias(x) for i, x in enumerate(p)]), "host-counts").select(
        "*", F.substring_index(host, ".", -2).alias("parent"), F.substring_index(host, ".", -1).alias("suffix"))
    sums = [F.sum(x).alias(x) for x in p]
    parents = stage(hosts.groupBy("parent", "suffix").agg(*sums), "parent-counts")
    suffixes = stage(parents.groupBy("suffix").agg(*sums), "suffix-counts")
    # One row: the counts of all pages.
    every = [x or 0.0 for x in suffixes.agg(*sums).first()]
    top = [(x + SMOOTHING / n) / (sum(every) + SMOOTHING) for x in every]
    prior = suffixes.select("suffix", smoothed(lambda i: F.lit(top[i])))
    for table, key, upper in ((parents, "parent", "suffix"), (hosts, "host", "parent")):
        prior = table.join(prior, upper).select(key, smoothed(lambda i: F.get("prior", i)))
    return prior


def identify(rows: DataFrame, languages: list[str], model: np.ndarray, html: bool) -> DataFrame:
    """(id, text, host, declared, address) -> id, lang, posterior and the evidence."""
    n = len(languages)
    if not n:
        return rows.select("id", F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("posterior"), F.lit(UNKNOWN).alias("text_lang"), "declared", "address", "host")
    scored = stage(
        rows.select("id", "host", "declared", "address", "text")
        .mapInArrow(_likelihoods(languages, model, html), "id long, host string, declared string, address string, n_trigrams long, likelihoods array<double>"),
        "likelihoods",
    )
    own = _sum(_sum(F.col("likelihoods"), _said(F.col("declared"), languages, DECLARED_RIGHT)), _said(F.col("address"), languages, ADDRESS_RIGHT))
    seen = scored.withColumn("evidence", own).withColumn("p", _normalised(F.col("evidence")))
    priors = stage(_host_priors(seen, n), "host-priors")
    fused = _normalised(_sum(F.col("evidence"), F.transform("prior", lambda p: F.log(p))))
    best = F.array_max("posteriors")
    index = F.array_position("posteriors", best)
    name = lambda i: F.element_at(F.array(*[F.lit(x) for x in languages]), i.cast("int"))
    silent = (F.col("n_trigrams") < MIN_TRIGRAMS) & ~F.col("declared").isin(languages) & ~F.col("address").isin(languages)
    return (
        seen.join(priors, "host").withColumn("posteriors", fused)
        .select(
            "id",
            F.when(silent | (best < MIN_POSTERIOR), UNKNOWN).otherwise(name(index)).alias("lang"), best.alias("posterior"),
            F.when(F.col("n_trigrams") < MIN_TRIGRAMS, UNKNOWN).otherwise(name(F.array_position("likelihoods", F.array_max("likelihoods")))).alias("text_lang"),
            "declared", "address", "host",
        )
    )


def page_languages(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """Language of every page; the text models come from labelled documents."""
    languages, model = fit(labelled_sample(docs))
    host = host_of(F.col("url"))
    path = F.lower(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([A-Za-z]{2,3})(?:[/?#]|$)", 1))
    last = F.substring_index(host, ".", -1)
    rows = pages.select(
        F.col("page_id").alias("id"), F.col("html").alias("text"), host.alias("host"), declared_of(F.col("html")).alias("declared"),
        F.when(path.isin(languages), path).when(last.isin(languages), last).otherwise("").alias("address"),
    )
    return identify(rows, languages, model, html=True).withColumnRenamed("id", "page_id")


def document_languages(docs: DataFrame) -> DataFrame:
    """Language of every document: the lang column is the declaration, the source the host."""
    languages, model = fit(labelled_sample(docs))
    rows = docs.select(
        F.xxhash64("doc_id", "text").alias("id"), "text", F.coalesce("source", F.lit("")).alias("host"),
        F.coalesce("lang", F.lit("")).alias("declared"), F.lit("").alias("address"),
    )
    return identify(rows, languages, model, html=False)

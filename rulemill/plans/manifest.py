"""What a published version consists of, so that readers notice damage.

The manifest has a row per part file: ``part``, ``bytes``, ``lines``, ``digest``
and, the same in each, ``edition``: the digest of all parts in name order. It is
computed from what was written, not from what should have been.

A part's digest is the sum of hashes of its lines at their places. Places come
from line counts of the splits before, so they depend neither on how a reader
splits a file nor on one task seeing all of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..staging import drop_staged, stage, staged_mark

MANIFEST = "part string, bytes bigint, lines bigint, digest string, edition string"
_FOLDER = "_manifest"


class DamagedEdition(ValueError):
    """A published version is not what its manifest says."""


def numbered_parts(spark: SparkSession, path: str) -> DataFrame:
    """part, line_no, hash of every line of a folder of text files; line_no from 0 within its file."""
    read = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_name").alias("part"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("id"), F.xxhash64("value").alias("hash"),
    )
    rows = stage(read, "part-lines")
    before = Window.partitionBy("part").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = rows.groupBy("part", "split").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    bases = splits.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    return rows.join(bases, ["part", "split"]).select("part", (F.col("base") + F.col("id") - F.col("first")).alias("line_no"), "hash")


def describe(spark: SparkSession, path: str) -> DataFrame:
    """The manifest of a folder as it is now."""
    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_name").alias("part"), F.col("length").alias("bytes"))
    place = F.xxhash64("line_no", "hash").cast("decimal(38,0)")
    sums = numbered_parts(spark, path).groupBy("part").agg(F.count(F.lit(1)).alias("lines"), F.sum(place).cast("string").alias("digest"))
    parts = stage(
        files.join(sums, "part", "left")
        .select("part", "bytes", F.coalesce("lines", F.lit(0)).alias("lines"), F.coalesce("digest", F.lit("0")).alias("digest")),
        "parts",
    )
    # One short text per part file.
    each = F.transform(F.array_sort(F.collect_list(F.struct("part", "bytes", "lines", "digest"))), lambda p: F.to_json(p))
    whole = parts.agg(F.sha2(F.concat_ws("\n", each), 256).alias("edition")).first().edition
    return parts.withColumn("edition", F.lit(whole))


def write_manifest(spark: SparkSession, path: str) -> None:
    """Describe a version that has been written; it counts once this is done."""
    mark = staged_mark(spark)
    try:
        describe(spark, path).coalesce(1).write.mode("overwrite").json(f"{path}/{_FOLDER}")
    finally:
        drop_staged(spark, mark)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).json(f"{path}/{_FOLDER}")


def verify(spark: SparkSession, path: str) -> None:
    """Raise DamagedEdition unless every part is there and unchanged, and none was added."""
    mark = staged_mark(spark)
    try:
        said, found = read_manifest(spark, path), describe(spark, path)
        same = ["part", "bytes", "lines", "digest"]
        wrong = said.join(found, same, "left_anti").select("part").unionByName(found.join(said, same, "left_anti").select("part"))
        parts = [r.part for r in wrong.distinct().orderBy("part").limit(20).collect()]
        if parts:
            raise DamagedEdition(f"{path}: damaged, missing or unknown parts {parts}")
        # The rows agree, so they are complete if the digest over all of them does.
        if said.select("edition").exceptAll(found.select("edition")).count() or not said.count():
            raise DamagedEdition(f"{path}: the manifest itself is damaged")
    finally:
        drop_staged(spark, mark)


def read_verified(spark: SparkSession, path: str) -> DataFrame:
    """part, text of the lines of a version that has been verified; parts in name order are the edition."""
    verify(spark, path)
    return spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_name").alias("part"), F.col("value").alias("text"))

"""Reading landed list snapshots and cutting them into lines.

Landing layout: ``<path>/run_id=<id>/source=<name>/<file>``, one text file per
source and run. Which file counts is decided from names, times and sizes alone;
contents are then read by one reader, in splits, whatever the size of a file.

A line's place is (``chunk``, ``line_no``): the byte offset of its split in the
file, and a number that rises within the split. The numbers come from the read,
so the table of lines is written once and every step reads that.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .. import fixed
from ..functions.text import strip
from ..schema import CHUNK_LINES, SOURCE_COLS, chunk_of
from ..staging import stage

SNAPSHOT_FILES = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("source", T.StringType()),
])
#: What is known of a landed file without opening it.
FILE_COLS = ["path", "run_id", "source", "modificationTime", "length"]
_TEXT = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("source", T.StringType()),
])


def decode(content: Column) -> Column:
    """UTF-8 text; bad bytes become U+FFFD, a byte-order mark stays."""
    return F.make_valid_utf8(content.cast("string"))


def run_order(run_id: Column) -> Column:
    """Order of runs: numbers by value and before other names, those by text."""
    number = run_id.try_cast("decimal(38,0)")
    return F.struct(number.isNull().alias("named"), number.alias("number"), run_id.alias("name"))


def with_source(snapshots: DataFrame, sources: DataFrame) -> DataFrame:
    """Add priority, order and lite flag of each row's source; unknown and disabled ones go."""
    known = sources.filter(F.coalesce("enabled", F.lit(True))) if "enabled" in sources.columns else sources
    return snapshots.join(
        known.select(
            F.col("name").alias("source"), "priority", "source_ord",
            F.coalesce("lite", F.lit(False)).alias("lite"),
        ),
        "source",
    )


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Landed files by name, run, source, time and size; contents are not opened."""
    return (
        spark.read.format("binaryFile").schema(SNAPSHOT_FILES).load(path)
        .select(F.col("_metadata.file_path").alias("path"), *FILE_COLS[1:])
    )


def newest_files(files: DataFrame) -> DataFrame:
    """The newest file with content of each source: by run, then time, then name."""
    order = F.struct(run_order(F.col("run_id")).alias("run"), "modificationTime", "path")
    row = F.struct(*[c for c in files.columns if c != "source"])
    return (
        files.filter(F.col("length") > 0).groupBy("source")
        .agg(F.max_by(row, order).alias("n")).select("source", "n.*")
    )


def _opened(chosen: DataFrame) -> list[str]:
    """Paths of the chosen files as readers take them: at most one per source.

    File paths come URI-encoded, and readers expand wildcards in what they get.
    """
    wild = str.maketrans({c: "\\" + c for c in "{}[]*?\\"})
    return [unquote(r.path).translate(wild) for r in chosen.select("path").collect()]


def _read_chosen(spark: SparkSession, path: str, chosen: DataFrame, kind: str, schema: T.StructType) -> DataFrame:
    """Rows of the chosen files alone; no other landed file is listed or opened."""
    paths = _opened(chosen)
    if not paths:
        return spark.createDataFrame([], schema).withColumn("path", F.lit("")).withColumn("chunk", F.lit(0).cast("bigint"))
    return (
        spark.read.format(kind).schema(schema).option("basePath", path).load(paths)
        .select("*", F.col("_metadata.file_path").alias("path_"), F.col("_metadata.file_block_start").alias("chunk"))
        .drop("path").withColumnRenamed("path_", "path")
    )


def file_lines(spark: SparkSession, path: str, chosen: DataFrame) -> DataFrame:
    """Lines of the chosen (path) files: run_id, source, chunk, line_no, line.

    Only those files are opened: their paths, one per source, are given to the
    reader, so a refresh costs the same however long the landing history is.

    A byte-order mark at the start of a file is no part of its first line. A
    line of the reader can still hold separators other than CR and LF, so it is
    cut again before numbering.
    """
    return _read_chosen(spark, path, chosen, "text", _TEXT).select(
        "run_id", "source", "chunk", F.explode(F.split(F.make_valid_utf8("value"), fixed.PAT_LINES)).alias("line"))


def read_lists(spark: SparkSession, path: str, sources: DataFrame) -> DataFrame:
    """Newest snapshots with their whole text, one row per source."""
    newest = newest_files(list_files(spark, path))
    known = stage(with_source(newest, sources), "chosen")
    files = _read_chosen(spark, path, known, "binaryFile", SNAPSHOT_FILES).select("content", "path").join(known, "path")
    return files.withColumn("text", decode(F.col("content")))


def read_lines(spark: SparkSession, path: str, sources: DataFrame) -> DataFrame:
    """Numbered lines of each enabled source's newest snapshot."""
    chosen = stage(with_source(newest_files(list_files(spark, path)), sources), "chosen")
    lines = numbered(file_lines(spark, path, chosen))
    keep = ["run_id", *SOURCE_COLS, "lite", "chunk", "line_no", "line"]
    return with_source(stage(lines, "lines"), sources).select(*keep)


def numbered(lines: DataFrame) -> DataFrame:
    """``line_no`` rising within a split; to be written before it is used."""
    return lines.withColumn("line_no", F.monotonically_increasing_id())


def split_lines(text: Column) -> Column:
    """Lines of a text; a separator at its end starts no further line."""
    parts = F.split(text, fixed.PAT_LINES)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)


def list_lines(snapshots: DataFrame, chunk_lines: int = CHUNK_LINES) -> DataFrame:
    """One row per line of ``text``, numbered from 0 within its source."""
    carried = [c for c in snapshots.columns if c not in ("text", "content")]
    return (
        snapshots
        .select(*carried, F.posexplode(split_lines(F.col("text"))).alias("pos", "line"))
        .withColumn("line_no", F.col("pos").cast("bigint"))
        .withColumn("chunk", chunk_of(F.col("line_no"), chunk_lines))
        .drop("pos")
    )


def raw_rule_counts(lines: DataFrame) -> DataFrame:
    """Non-blank lines per source that start with neither ``!`` nor ``[``."""
    text = strip(F.col("line"))
    counted = (text != "") & ~text.startswith("!") & ~text.startswith("[")
    return (
        lines.groupBy("source")
        .agg(F.count_if(counted).cast("bigint").alias("rule_count"))
    )

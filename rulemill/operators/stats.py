"""Counts over rules, editions and published text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed
from ..functions.text import after, contains_any, strip
from .carry import carry


def _count(condition: Column, name: str) -> Column:
    return F.count_if(condition).cast("bigint").alias(name)


def edition_stats(edition: DataFrame) -> DataFrame:
    """One row: total, exceptions, blocks, elements. Headers do not count."""
    section = F.col("section")
    return edition.agg(
        _count(section != fixed.HEADER, "total_rules"),
        _count(section == fixed.EXCEPTION, "exception_rules"),
        _count(section == fixed.BLOCK, "block_rules"),
        _count(section == "element", "hide_rules"),
    )


def edition_source_counts(edition: DataFrame) -> DataFrame:
    """Surviving rules of each source, headers excluded."""
    return (
        edition.filter(F.col("section") != fixed.HEADER)
        .groupBy("source").agg(F.count(F.lit(1)).alias("rules"))
    )


def parsed_counts(rules: DataFrame) -> DataFrame:
    """Rules of each source before dedup, headers included."""
    return rules.groupBy("source").agg(F.count(F.lit(1)).alias("rule_count"))


def type_profile(rules: DataFrame) -> DataFrame:
    return rules.groupBy("source", "rule_type").agg(F.count(F.lit(1)).alias("rules"))


def reread_stats(lines: DataFrame) -> DataFrame:
    """Counts of published editions, recovered from their text.

    A line belongs to the last section marker above it, to block before the
    first. Lines starting with ``!`` or ``[`` do not count. ``stamp`` is the
    last modification line. ``lines``: edition, chunk, line_no, line.
    """
    text = F.col("text")
    mark = F.lit(None).cast("string")
    for prefix, section in reversed(fixed.MARK_PREFIXES):
        mark = F.when(text.startswith(prefix), section).otherwise(mark)
    is_stamp = text.startswith(fixed.STAMP_PREFIX)
    is_rule = (text != "") & ~text.startswith("!") & ~text.startswith("[")
    marked = (
        lines.withColumn("text", strip(F.col("line")))
        .select(
            "edition", "chunk", "line_no",
            mark.alias("mark"), is_rule.alias("is_rule"),
            F.when(is_stamp, strip(after(text, ":"))).alias("stamp"),
        )
        .filter(F.col("is_rule") | F.col("mark").isNotNull() | F.col("stamp").isNotNull())
    )
    placed = carry(marked, ["edition"], "mark", "section")
    rule, section = F.col("is_rule"), F.coalesce("section", F.lit("block"))
    place = F.struct("chunk", "line_no")
    return placed.groupBy("edition").agg(
        _count(rule, "total_rules"),
        _count(rule & (section == "exception"), "exception_rules"),
        _count(rule & (section == "block"), "block_rules"),
        _count(rule & (section == "element"), "hide_rules"),
        F.max_by("stamp", F.when(F.col("stamp").isNotNull(), place)).alias("stamp"),
    )


def quick_stats(lines: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rough profile of list files by looking at each line alone.

    It knows fewer separators than the parser, so the split differs from
    ``edition_stats``. ``lines``: file, line; ``sizes``: file, size_bytes. A file
    without lines counts zero.
    """
    text = strip(F.col("line"))
    counted = (text != "") & ~text.startswith("!") & ~text.startswith("[")
    exception = text.startswith("@@")
    element = ~exception & contains_any(text, ["##", "#@#", "#?#", "#%#"])
    counts = lines.groupBy("file").agg(
        _count(counted, "rules"),
        _count(counted & exception, "exception"),
        _count(counted & element, "hide"),
        _count(counted & ~exception & ~element, "block"),
    )
    zero = {c: 0 for c in ("rules", "exception", "hide", "block")}
    return sizes.join(counts, "file", "left").fillna(zero)

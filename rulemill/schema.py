"""Column names shared by all tables of the engine.

``lines``   source, priority, source_ord, chunk, line_no, line
``rules``   source, priority, source_ord, chunk, line_no, raw, rule_type, sep,
            domain, options, pattern, domains, parsed_key, normalized, section

Spark rows have no arrival order, so every table carries it: smaller
``priority`` wins, ties go to the earlier source (``source_ord``), then to the
earlier line. A line's place inside its source is the pair (``chunk``,
``line_no``): chunks are bounded runs of consecutive lines, which lets ordered
work be cut into pieces however long one list is.
"""

from pyspark.sql import Column, functions as F

from . import fixed

SOURCE_COLS = ["source", "priority", "source_ord"]
ORDER_KEY = ["priority", "source_ord", "chunk", "line_no"]

#: Lines per chunk where the reader, not a file split, decides.
CHUNK_LINES = 65536


def chunk_of(line_no: Column, size: int = CHUNK_LINES) -> Column:
    """Chunk number of a line numbered within its source."""
    return F.floor(line_no / F.lit(size)).cast("bigint")


def section_of(rule_type: Column) -> Column:
    """Dedup partition of a rule type: header, exception, block or element."""
    return (
        F.when(rule_type.isin(fixed.HEADER, fixed.EXCEPTION, fixed.BLOCK), rule_type)
        .otherwise(F.lit("element"))
    )


def section_rank(rule_type: Column) -> Column:
    """Place of a rule type in a published edition."""
    return (
        F.when(rule_type == fixed.HEADER, 0)
        .when(rule_type == fixed.EXCEPTION, 1)
        .when(rule_type == fixed.BLOCK, 2)
        .when(rule_type == fixed.HIDE_EXCEPTION, 3)
        .otherwise(4)
    )

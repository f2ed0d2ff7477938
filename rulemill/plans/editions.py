"""From lines to published editions."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import fixed
from ..operators.dedup import dedup_exact
from ..operators.parse import attach_comments, parse_rules
from ..operators.stats import edition_stats
from ..operators.subsume import dedup_subsumed
from ..schema import ORDER_KEY, section_rank
from .manifest import read_verified, write_manifest

MAX_RULE_LENGTH = 4000

#: Comments stand before their rule, in their own order.
TEXT_ORDER = ["part", *ORDER_KEY, "is_rule", "c_chunk", "c_line"]


#: What an edition needs of a rule, and what counts over one need.
EDITION_COLS = [*ORDER_KEY, "source", "raw", "rule_type", "section", "normalized", "domain"]
COUNT_COLS = ["source", "section"]


def merge_rules(
    rules: DataFrame, max_rule_length: int = MAX_RULE_LENGTH, columns: list[str] = EDITION_COLS
) -> DataFrame:
    """Exact dedup, subsumption dedup, then the length limit.

    The limit comes last: a rule that is too long still wins over its duplicates
    and still covers others before it goes. Only ``columns`` are kept; of the
    text just its length is needed.
    """
    exact = dedup_exact(rules.withColumn("raw_length", F.length("raw")))
    merged = dedup_subsumed(exact, [*columns, "raw_length"])
    return merged.filter(F.col("raw_length") <= max_rule_length).select(*columns)


def order_edition(rules: DataFrame) -> DataFrame:
    """Headers, exceptions, blocks, hide exceptions, other element rules."""
    return rules.withColumn("section_rank", section_rank(F.col("rule_type"))).orderBy(
        "section_rank", *ORDER_KEY
    )


def edition_rules(
    lines: DataFrame, lite: bool = False, max_rule_length: int = MAX_RULE_LENGTH
) -> DataFrame:
    """Rules of an edition with their rank, in no order and without comments.

    The lite edition is a merge of its own: filtering the full one would miss
    rules that a source outside the lite set had removed.
    """
    merged = merge_rules(parse_rules(lines.filter("lite") if lite else lines), max_rule_length)
    return merged.withColumn("section_rank", section_rank(F.col("rule_type")))


def build_edition(
    lines: DataFrame, lite: bool = False, max_rule_length: int = MAX_RULE_LENGTH
) -> DataFrame:
    """Edition of all sources, or of the lite ones, as ordered rules with comments."""
    chosen = lines.filter("lite") if lite else lines
    return attach_comments(edition_rules(lines, lite, max_rule_length), chosen).orderBy("section_rank", *ORDER_KEY)


def stamp_text(at: datetime) -> str:
    """A UTC time as the version stamp of an edition."""
    return (at + timedelta(hours=8)).strftime("%Y-%m-%dT%H:%M:%S CST")


def edition_text(
    edition: DataFrame,
    comments: DataFrame,
    summary: DataFrame,
    at: datetime,
    title: str = "Merged filter list",
    description: str = "Filter list merged from several upstream sources",
    homepage: str = "https://example.org/",
) -> DataFrame:
    """Text lines of an edition in order; ``text`` is what gets written.

    ``edition``: rules with ``section_rank``. ``comments``: ``comment_rows`` of
    its lines; those of rules that are gone are left out. ``summary``: source,
    rule_count, priority, source_ord.
    """
    none = F.lit(None)

    def row(part: int | Column, text: Column, c_line: Column = none) -> list[Column]:
        key = {"priority": "int", "source_ord": "int", "chunk": "bigint", "line_no": "bigint"}
        return [
            (F.lit(part) if isinstance(part, int) else part).cast("int").alias("part"),
            *[none.cast(kind).alias(n) for n, kind in key.items()],
            F.lit(0).alias("is_rule"), none.cast("bigint").alias("c_chunk"), c_line.cast("bigint").alias("c_line"),
            text.alias("text"),
        ]

    stamp = stamp_text(at)
    texts = {"title": title, "description": description, "homepage": homepage, "stamp": stamp}
    head = [
        *[F.lit(t.format(**texts)) for t in fixed.PREAMBLE],
        *[F.format_string(t, n) for n, t in fixed.PREAMBLE_COUNTS.items()],
        F.lit(fixed.PREAMBLE_SOURCES),
    ]
    preamble = (
        edition_stats(edition)
        .select(F.posexplode(F.array(*head)).alias("at", "text"))
        .select(*row(0, F.col("text"), F.col("at")))
    )
    listed = summary.select(
        *[c.cast("int").alias(n) for n, c in (("part", F.lit(1)), ("priority", F.col("priority")), ("source_ord", F.col("source_ord")))],
        none.cast("bigint").alias("chunk"), none.cast("bigint").alias("line_no"),
        F.lit(0).alias("is_rule"), none.cast("bigint").alias("c_chunk"), none.cast("bigint").alias("c_line"),
        F.format_string(fixed.PREAMBLE_SOURCE, "source", "rule_count", "priority").alias("text"),
    )
    closing = edition.sparkSession.range(1).select(*row(2, F.lit("!")))

    rank = F.col("section_rank")
    # part: 10 headers, 20 + 21 exceptions, 30 + 31 blocks, 40 element rules
    # behind their marker, of which 41 + 42 hide exceptions and 43 the rest.
    marks = (
        F.when(rank == 1, F.array(_mark(20, fixed.MARK_EXCEPTION)))
        .when(rank == 2, F.array(_mark(30, fixed.MARK_BLOCK)))
        .when(rank == 3, F.array(_mark(40, fixed.MARK_ELEMENT), _mark(41, fixed.MARK_HIDE_EXCEPTION)))
        .when(rank == 4, F.array(_mark(40, fixed.MARK_ELEMENT)))
    )
    markers = (
        edition.select("section_rank").distinct()
        .select(F.explode(marks).alias("m"))
        .select("m.*").distinct()
        .select(*row(F.col("part"), F.col("text")))
    )
    part = F.element_at(F.array(*[F.lit(p) for p in (10, 21, 31, 42, 43)]), rank + 1).alias("part")
    rules = edition.select(
        part, *ORDER_KEY, F.lit(1).alias("is_rule"), none.cast("bigint").alias("c_chunk"), none.cast("bigint").alias("c_line"),
        F.col("raw").alias("text"),
    )
    waiting = edition.select(part, "source", *ORDER_KEY).join(comments, ["source", "chunk", "line_no"]).select(
        "part", *ORDER_KEY, F.lit(0).alias("is_rule"), "c_chunk", "c_line", F.col("comment").alias("text"),
    )
    return (
        preamble.unionByName(listed).unionByName(closing)
        .unionByName(markers).unionByName(rules).unionByName(waiting)
        .orderBy(*TEXT_ORDER)
    )


def _mark(part: int, text: str) -> Column:
    return F.struct(F.lit(part).alias("part"), F.lit(text).alias("text"))


def publish(edition: DataFrame, text: DataFrame, path: str, version: str) -> bool:
    """Write the text of an edition as a new version; an empty edition writes nothing.

    A version is a folder of ``path`` and counts once its manifest is complete,
    so readers (``published_version``) see the old one until the last moment, and
    a failed write changes nothing. Part files are range-sorted: read in name
    order they are the edition.
    """
    if edition.isEmpty():
        return False
    text.select("text").write.mode("overwrite").text(f"{path}/{version}")
    write_manifest(edition.sparkSession, f"{path}/{version}")
    return True


def read_published(spark: SparkSession, path: str) -> DataFrame | None:
    """Lines (part, text) of the newest complete version, None if there is none.

    A version with a damaged, missing or added part raises ``DamagedEdition``.
    """
    newest = published_version(spark, path)
    return None if newest is None else read_verified(spark, newest)


def published_version(spark: SparkSession, path: str) -> str | None:
    """Folder of the newest complete version: the last by name."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = files.globStatus(jvm.org.apache.hadoop.fs.Path(root, "*/_manifest/_SUCCESS")) if files.exists(root) else []
    return max((str(f.getPath().getParent().getParent().toString()) for f in done), default=None)

"""Carry a value along ordered lines without one task per source."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..staging import stage

#: Chunks whose summaries one window orders.
SPAN = 1024


def _among(df: DataFrame, chosen: DataFrame) -> DataFrame:
    """Rows of ``df`` that agree with a row of ``chosen`` in its columns, NULLs included."""
    other = chosen.toDF(*[f"_{c}" for c in chosen.columns])
    agree = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in chosen.columns])
    return df.join(other, agree, "left_semi")


def carry(
    df: DataFrame,
    group: list[str],
    value: str,
    out: str,
    backwards: bool = False,
    keep: Column | None = None,
) -> DataFrame:
    """Last non-null ``value`` at or before each row in (chunk, line_no) order.

    ``backwards`` looks at or after the row instead; ``keep`` drops rows that are
    only needed as neighbours. Ordered work is cut by chunk, so a group of any
    length is spread over tasks: a window inside each chunk finds the value, and
    one summary row per chunk carries it over chunk borders. Summaries are ordered
    in spans of ``SPAN`` chunks, and one row per span connects those. With ``keep``
    only chunks that hold a kept row are ordered, and only their groups summarised.
    """
    line = F.col("line_no").desc() if backwards else F.col("line_no").asc()
    chunk = F.col("chunk").desc() if backwards else F.col("chunk").asc()
    pick = F.min_by if backwards else F.max_by

    inside = (
        Window.partitionBy(*group, "chunk").orderBy(line)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    if keep is None:
        near = there = df
    else:
        kept = stage(df.filter(keep).select(*group, "chunk").distinct(), "kept-chunks")
        near, there = _among(df, kept), _among(df, kept.select(*group).distinct())
    local = near.withColumn(out, F.last(value, ignorenulls=True).over(inside))
    if keep is not None:
        local = local.filter(keep)

    edge = pick(value, F.when(F.col(value).isNotNull(), F.col("line_no")))
    found = F.col("_edge").isNotNull()
    edges = (
        there.groupBy(*group, "chunk").agg(edge.alias("_edge"))
        .withColumn("_span", F.floor(F.col("chunk") / F.lit(SPAN)))
    )
    before = (Window.unboundedPreceding, -1)
    within = Window.partitionBy(*group, "_span").orderBy(chunk).rowsBetween(*before)
    # A chunk that is NULL is a span of its own.
    place = F.when(found, F.coalesce(F.col("chunk"), F.lit(0)))
    across = Window.partitionBy(*group).orderBy(F.col("_span").desc() if backwards else F.col("_span").asc()).rowsBetween(*before)
    spans = (
        edges.groupBy(*group, "_span").agg(pick("_edge", place).alias("_edge"))
        .select(*group, "_span", F.last("_edge", ignorenulls=True).over(across).alias("_far"))
        .filter(F.col("_far").isNotNull())
    )
    carried = (
        edges.withColumn("_near", F.last("_edge", ignorenulls=True).over(within))
        .join(spans, [*group, "_span"], "left")
        .withColumn("_carried", F.coalesce("_near", "_far"))
        .filter(F.col("_carried").isNotNull())
        .select(*group, "chunk", "_carried")
    )
    return (
        local.join(carried, [*group, "chunk"], "left")
        .withColumn(out, F.coalesce(out, "_carried"))
        .drop("_carried")
    )


def number_rows(df: DataFrame, order: list[Column], bucket: Column, out: str) -> DataFrame:
    """1-based position of each row under ``bucket`` then ``order``.

    ``bucket`` must be the leading part of the order and cut the rows into
    pieces of bounded size. Rows are numbered inside their bucket; a sum over
    one count per bucket gives the offset.
    """
    cut = df.withColumn("_bucket", bucket)
    sums = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
        .select("_bucket", F.coalesce(F.sum("_n").over(sums), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_bucket").orderBy(*order)
    return (
        cut.withColumn("_rank", F.row_number().over(inside))
        .join(offsets, "_bucket")
        .withColumn(out, (F.col("_rank") + F.col("_offset")).cast("bigint"))
        .drop("_bucket", "_rank", "_offset")
    )

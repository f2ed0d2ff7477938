"""Registry of sources: name, url, priority, lite, enabled, source_ord."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..operators.carry import number_rows


def active_sources(sources: DataFrame, lite: bool = False) -> DataFrame:
    """Enabled sources by priority, ties in registry order; ``lite`` keeps lite ones.

    A missing ``enabled`` means enabled, a missing ``lite`` means not lite. Two
    entries of one name would silently replace each other, so they are an error.
    """
    same_name = Window.partitionBy("name")
    repeated = F.count(F.lit(1)).over(same_name) > 1
    checked = (
        sources
        .withColumn("lite", F.coalesce("lite", F.lit(False)))
        .withColumn("enabled", F.coalesce("enabled", F.lit(True)))
        .filter("enabled")
        .withColumn(
            "name",
            F.when(
                repeated,
                F.raise_error(F.concat(F.lit("source listed twice: "), F.col("name"))),
            ).otherwise(F.col("name")),
        )
    )
    if lite:
        checked = checked.filter("lite")
    return checked.orderBy("priority", "source_ord")


def source_catalogue(sources: DataFrame, bucket_size: int = 10000) -> DataFrame:
    """All sources numbered: lite ones first, the others continue the count."""
    listed = sources.select(
        "name", "source_ord", F.coalesce("lite", F.lit(False)).alias("lite")
    )
    bucket = F.struct(
        (~F.col("lite")).alias("late"), F.floor(F.col("source_ord") / bucket_size).alias("part")
    )
    return number_rows(listed, [F.col("source_ord")], bucket, "number").select(
        "number", "name", "lite"
    )

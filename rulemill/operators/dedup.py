"""Exact dedup: one rule per section and canonical key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.domains import key_domain
from ..schema import ORDER_KEY

#: Identity of a rule after exact dedup. The hash leads so that sorting compares
#: a number first; the text behind it keeps the result exact.
RULE_ID = ["key_hash", "section", "normalized"]


def narrow(rules: DataFrame) -> DataFrame:
    """``rules`` for a shuffle: raw and domain are NULL where the canonical key tells them."""
    told = {"raw": F.col("normalized"), "domain": key_domain(F.col("normalized"))}
    return rules.withColumns({c: F.when(~F.col(c).eqNullSafe(t), F.col(c)) for c, t in told.items() if c in rules.columns})


def widen(rules: DataFrame) -> DataFrame:
    """Undoes ``narrow``."""
    told = {"raw": F.col("normalized"), "domain": key_domain(F.col("normalized"))}
    return rules.withColumns({c: F.coalesce(c, t) for c, t in told.items() if c in rules.columns})


def dedup_exact(rules: DataFrame) -> DataFrame:
    """First rule by (priority, source_ord, chunk, line_no) of each section and key.

    ``row_number = 1`` is planned as a group limit before the shuffle as well, so
    of a key with a billion copies each map task sends one.
    """
    first = Window.partitionBy(*RULE_ID).orderBy(*ORDER_KEY)
    return widen(
        narrow(rules)
        .withColumn("key_hash", F.xxhash64("section", "normalized"))
        .withColumn("_rank", F.row_number().over(first))
        .filter("_rank = 1")
        .drop("_rank")
    )


def duplicate_counts(rules: DataFrame) -> DataFrame:
    """Rules, distinct keys and removed duplicates of each section."""
    per_key = rules.groupBy("section", "normalized").agg(F.count(F.lit(1)).alias("copies"))
    return per_key.groupBy("section").agg(
        F.sum("copies").alias("rules"),
        F.count(F.lit(1)).alias("kept"),
        (F.sum("copies") - F.count(F.lit(1))).alias("removed"),
    )

"""Run-to-run change: deltas, edition differences, run log, retention."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window, functions as F


def run_deltas(history: DataFrame) -> DataFrame:
    """Net change against the previous run of the same edition; NULL on the first.

    ``history``: edition, run_ts, total_rules - one row per run.
    """
    previous = F.lag("total_rules").over(Window.partitionBy("edition").orderBy("run_ts"))
    gain = F.col("total_rules") - F.col("previous")
    known = F.col("previous").isNotNull()
    return (
        history.withColumn("previous", previous)
        .select(
            "edition", "run_ts", "total_rules",
            F.when(known, F.greatest(F.lit(0), gain)).cast("bigint").alias("added"),
            F.when(known, F.greatest(F.lit(0), -gain)).cast("bigint").alias("removed"),
        )
    )


def edition_diff(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Rules that came or went between two editions, by section and key."""
    key = ["section", "normalized"]
    return (
        current.join(previous, key, "left_anti").select(*key, "raw", F.lit("added").alias("change"))
        .unionByName(
            previous.join(current, key, "left_anti")
            .select(*key, "raw", F.lit("removed").alias("change"))
        )
    )


def run_log(summary: DataFrame, counts: DataFrame, key: tuple[str, ...] = ("source",)) -> DataFrame:
    """Sources by name with surviving rules and ``+`` (updated) or ``=``."""
    return (
        summary.join(counts, list(key), "left")
        .select(
            *key,
            F.coalesce("rules", F.lit(0)).cast("bigint").alias("rules"),
            F.when(F.col("status") == "updated", "+").otherwise("=").alias("mark"),
        )
        .orderBy(*key)
    )


def retain(history: DataFrame, now: datetime, days: int = 90) -> DataFrame:
    """Runs newer than ``now`` minus ``days``, newest first.

    ``run_ts`` may be text: ISO with an offset, ``Z`` or `` CST`` (+08:00). Rows
    without a date go, rows with an unreadable one stay. For a ``timestamp``
    column ``now`` has to carry its time zone; for one without zone it has none.
    """
    stamp = F.col("run_ts")
    if dict(history.dtypes)["run_ts"] == "string":
        text = F.regexp_replace(stamp, " CST$", "+08:00")
        parsed = F.try_to_timestamp(text)
        zone = "timestamp"
    else:
        parsed, zone = stamp, dict(history.dtypes)["run_ts"]
    if zone == "timestamp" and now.tzinfo is None:
        raise ValueError("now needs a time zone to be compared with points in time")
    limit = F.lit(now.isoformat(sep=" ")).cast(zone) - F.make_dt_interval(days=F.lit(days))
    return (
        history.withColumn("_at", parsed)
        .filter(stamp.isNotNull() & (F.col("_at").isNull() | (F.col("_at") > limit)))
        .orderBy(F.col("_at").desc_nulls_last())
        .drop("_at")
    )

"""Change detection and source state between runs.

``results``   source, token (from the fetch, may be empty), content, error
``state``     source, token

``key`` names the columns that identify a result; with a run in it, many runs
are compared at once, each with the state filed under its own key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.lists import run_order

SOURCE = ("source",)


def choose_token(strong: Column, weak: Column, previous: Column) -> Column:
    """First of the tokens that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(t, F.lit("")) for t in (strong, weak, previous)])


def detect_changes(results: DataFrame, state: DataFrame, key: tuple[str, ...] = SOURCE) -> DataFrame:
    """Adds ``changed``; a missing token is replaced by the hash of the content.

    Failed results are never changed. A source seen for the first time is.
    """
    old = state.select(*key, F.col("token").alias("old_token"))
    fresh = results.withColumn(
        "token",
        F.when(
            F.col("error").isNull(),
            F.coalesce(
                F.nullif("token", F.lit("")), F.sha2(F.col("content").cast("binary"), 256)
            ),
        ),
    )
    return (
        fresh.join(old, list(key), "left")
        .withColumn(
            "changed", F.col("error").isNull() & ~F.col("token").eqNullSafe(F.col("old_token"))
        )
        .drop("old_token")
    )


def upsert_state(state: DataFrame, results: DataFrame, key: tuple[str, ...] = SOURCE) -> DataFrame:
    """Successful results with a token replace it; all other tokens stay."""
    new = results.select(
        *key, F.when(F.col("error").isNull(), F.nullif("token", F.lit(""))).alias("new_token")
    )
    return (
        state.select(*key, "token").join(new, list(key), "full_outer")
        .select(*key, F.coalesce("new_token", "token").alias("token"))
        .filter(F.col("token").isNotNull())
    )


def usable(results: DataFrame) -> DataFrame:
    """Results that contribute rules: no error and some content."""
    return results.filter(F.col("error").isNull() & (F.length("content") > 0))


def last_good(snapshots: DataFrame, carry_forward: bool = True) -> DataFrame:
    """Newest usable snapshot of each source.

    Without ``carry_forward`` a source whose newest snapshot is not usable is
    left out, so its rules vanish from the editions until it changes again. The
    run is chosen without contents; those are looked up for the chosen ones.
    """
    order = run_order(F.col("run_id"))
    candidates = usable(snapshots) if carry_forward else snapshots
    newest = candidates.groupBy("source").agg(F.max(order).alias("_run")).select("source", F.col("_run.name").alias("run_id"))
    return usable(snapshots.select("source", "content", "error", "token", "run_id").join(newest, ["source", "run_id"], "left_semi"))


def source_status(results: DataFrame, parsed: DataFrame, key: tuple[str, ...] = SOURCE) -> DataFrame:
    """Rule count and status of every result.

    ``parsed`` holds (key, rule_count) of what was parsed; a failed or empty
    result counts 0 whatever it says.
    """
    empty = F.coalesce(F.length("content"), F.lit(0)) == 0
    failed = F.col("error").isNotNull()
    status = (
        F.when(failed, "error")
        .when(empty & F.col("changed"), "empty")
        .when(F.col("changed"), "updated")
        .otherwise("unchanged")
    )
    kept = [c for c in ("priority",) if c in results.columns]
    return results.join(parsed, list(key), "left").select(
        *key, *kept,
        F.when(failed | empty, 0).otherwise(F.coalesce("rule_count", F.lit(0)))
        .cast("bigint").alias("rule_count"),
        status.alias("status"),
    )


def changed_count(results: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Number of sources that changed without error; 0 means nothing to publish."""
    changed = F.col("changed") & F.col("error").isNull()
    return results.groupBy(*by).agg(F.count_if(changed).cast("bigint").alias("changed"))

"""Mixing sources to target weights along a time-varying curriculum (native).

Every source has a weight schedule over the training run t in [0, 1],

    w(t) = target * (1 + slope * (2 t - 1)),

whose integral is the source's target. The demand up to t is therefore
``target * ((1 - slope) t + slope t**2)``; inverting it turns a document's place
in its source's cumulative words into a training position, and documents are
range-sorted by position.

Targets: sources by code point (null last) weigh 5, 2, 1, repeating, and share
all words. A target stops at ``MAX_PASSES`` times its source's size; what is
over is shared again by weight. The level at which this ends is found in one
pass over the sources sorted by cap / weight.

Only DataFrame functions are used. A source may hold any share of the rows: its
order is the MD5 of the row, cut into 4,096 buckets, so running sums are taken
inside buckets and one row per bucket carries them on. Sums are over integers,
so reruns agree to the last bit.

Cases: a null or empty text has size 0 and is taken 0 times; rows equal in
doc_id, text and source are one item taken together, and share its words evenly;
a null source is a source; a null doc_id is kept; an empty table gives no rows;
extra columns are ignored by ``mix`` and carried by ``training_order``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..staging import stage

WEIGHTS = (5, 2, 1)
#: Heavy sources fade, light ones grow.
SLOPES = (-0.5, 0.0, 0.5)
MAX_PASSES = 3
WORD = r"[^\x20\x09-\x0D]+"
_BUCKET_DIGITS = 3


def _key() -> Column:
    """Order of a row inside its source."""
    return F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))).cast("binary"))


def _by_rank(values: tuple) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("rank") % len(values) + 1).cast("int"))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, slopes: tuple = SLOPES, max_passes: int = MAX_PASSES) -> DataFrame:
    """(source, source_size) -> those with weight, slope, target and goal (whole words).

    A source is a summary row, so its order is taken in one task.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = (
        sizes.withColumn("rank", F.row_number().over(by_name) - 1)
        .withColumn("weight", _by_rank(weights)).withColumn("slope", _by_rank(slopes).cast("double"))
        .withColumn("cap", F.col("source_size") * max_passes)
        .withColumn("ratio", F.col("cap").cast("double") / F.col("weight"))
    )
    filling = Window.orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(filling), F.lit(0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(filling), F.lit(0))
    levels = ranked.withColumn("level", left.cast("double") / open_weight.cast("double"))
    reached = F.when(F.col("ratio") >= F.col("level"), F.col("level"))
    return (
        levels.withColumn("level", F.min_by(reached, F.when(reached.isNotNull(), F.struct("ratio", "rank"))).over(everything))
        .withColumn("target", F.least(F.col("cap").cast("double"), F.coalesce(F.col("weight") * F.col("level"), F.col("cap").cast("double"))))
        .withColumn("goal", F.floor(F.col("target") + 0.5).cast("bigint"))
        .select("source", "source_size", "weight", "slope", "target", "goal")
    )


def position(share: Column, slope: Column) -> Column:
    """Time at which ``share`` of a source's target has been demanded."""
    linear = 1 - slope
    return F.when(slope == 0, share).otherwise((F.sqrt(linear * linear + 4 * slope * share) - linear) / (2 * slope))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, slopes: tuple = SLOPES, max_passes: int = MAX_PASSES) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, key, size, source_size, target,
    taken, copies (passes that take any of its words), position of the first."""
    sized = stage(docs.select("doc_id", "source", _key().alias("key"), F.regexp_count("text", F.lit(WORD)).cast("bigint").alias("size")).fillna(0, ["size"]), "mix-sizes")
    items = (
        sized.groupBy("source", "key", "doc_id", "size").agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("bucket", F.substring("key", 1, _BUCKET_DIGITS))
        .withColumn("words", F.col("size") * F.col("rows"))
    )
    buckets = stage(items.groupBy("source", "bucket").agg(F.sum("words").alias("words")), "mix-buckets")
    targets = source_targets(buckets.groupBy("source").agg(F.sum("words").alias("source_size")), weights, slopes, max_passes)
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        buckets.select("source", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
        .withColumnRenamed("source", "_source")
        .join(targets, F.col("_source").eqNullSafe(F.col("source"))).drop("_source")
    )
    inside = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    started = items.withColumn("start", F.coalesce(F.sum("words").over(inside), F.lit(0)))
    placed = (
        started.alias("i").join(bases.alias("b"), F.col("i.source").eqNullSafe(F.col("b.source")) & (F.col("i.bucket") == F.col("b.bucket")))
        .select("i.source", "i.key", "i.doc_id", "i.size", "rows", "words", (F.col("start") + F.col("base")).alias("start"), "source_size", "target", "goal", "slope")
    )
    full = F.when(F.col("source_size") > 0, F.floor(F.col("goal") / F.col("source_size"))).otherwise(0)
    rest = F.col("goal") - full * F.col("source_size")
    part = F.greatest(F.least(rest - F.col("start"), F.col("words")), F.lit(0))
    decided = placed.select(
        "source", "key", "doc_id", "size", "source_size", "target",
        F.floor((full * F.col("words") + part) / F.col("rows")).cast("bigint").alias("taken"),
        F.when(F.col("size") > 0, full + (part > 0).cast("bigint")).otherwise(0).cast("int").alias("copies"),
        F.when((F.col("size") > 0) & (F.col("start") < F.col("goal")), position(F.col("start") / F.col("goal"), F.col("slope"))).alias("position"),
        F.col("start"), "goal", "slope", "rows",
    )
    return decided.withColumn("_row", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int")))).drop("_row", "rows")


def mixed_rows(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The digest of ``mix``, range-sorted by position."""
    return (
        mix(docs).orderBy(F.col("position").asc_nulls_last(), "key")
        .select("doc_id", "size", "source_size", "target", "taken", "source", "position")
    )


def training_order(docs: DataFrame) -> DataFrame:
    """``docs`` as the mix takes them: a row per pass, sorted by training position."""
    passes = mix(docs).dropDuplicates(["source", "key", "doc_id"]).filter("copies > 0").select(
        F.col("key").alias("_key"), F.col("source").alias("_source"), F.col("doc_id").alias("_doc_id"),
        F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("_pass"), "start", "source_size", "goal", "slope",
    ).withColumn("_position", position((F.col("start") + F.col("_pass") * F.col("source_size")) / F.col("goal"), F.col("slope")))
    keyed = docs.withColumn("_key_of", _key())
    match = (F.col("_key_of") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_doc_id")) & F.col("source").eqNullSafe(F.col("_source"))
    return (
        keyed.join(passes.select("_key", "_source", "_doc_id", "_pass", "_position"), match)
        .orderBy("_position", "_key").select(*docs.columns)
    )


ORACLE = r"""
WITH s AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS key,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
  FROM documents),
z AS (SELECT source, sum(size) AS source_size FROM s GROUP BY source),
r AS (
  SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS rank FROM z),
w AS (
  SELECT *, [5, 2, 1][rank % 3 + 1] AS weight, [-0.5, 0.0, 0.5][rank % 3 + 1]::DOUBLE AS slope, source_size * 3 AS cap FROM r),
x AS (
  SELECT *, CAST(cap AS DOUBLE) / weight AS ratio FROM w),
l AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER f, 0) AS DOUBLE)
            / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER f, 0) AS DOUBLE) AS level
  FROM x WINDOW f AS (ORDER BY ratio, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT *, least(CAST(cap AS DOUBLE), weight * (SELECT level FROM l WHERE ratio >= level ORDER BY ratio, rank LIMIT 1)) AS target FROM l),
g AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS goal FROM t),
c AS (
  SELECT s.doc_id, s.size, s.source, g.source_size, g.target, g.goal, g.slope,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM s JOIN g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST((goal // source_size) * size + greatest(least(goal % source_size - start, size), 0) AS BIGINT) AS taken, source,
       CASE WHEN size > 0 AND start < goal THEN
         CASE WHEN slope = 0 THEN CAST(start AS DOUBLE) / goal
         ELSE (sqrt((1 - slope) * (1 - slope) + 4 * slope * (CAST(start AS DOUBLE) / goal)) - (1 - slope)) / (2 * slope) END END AS position
FROM c
"""

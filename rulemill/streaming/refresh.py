"""Scheduled refresh over newly landed list files.

The stream carries names, times and sizes of files only. A batch chooses the
newest file with content of each source and reads just those, in splits; only
sources whose content changed are parsed. Tables below ``root``, each with a
folder per batch:

``results``   source, path, run_id, token, error, changed of the files looked at
``rules``     candidates of the sources that changed, by source
``comments``  comments of the sources that changed, by source
``state``     source, token, run_id, parsed (batch of its rules), rule_count, raw_count
``members``   source, priority, source_ord, parsed of what an edition was merged from
``winners``   merged rules of an edition with their coverage
``status``    source, rule_count, status of every enabled source
``log``       edition, source, rules, mark: surviving rules of every source
``changes``   edition, section, normalized, raw, change: what came and went
``history``   edition, run_ts, total_rules, added, removed

An edition is merged from the winners of the batch before and from the sources
that differ since: other content, other place in the registry, new or gone
(``operators/incremental.py``). Every write is an overwrite that depends only on
the batch and on tables of earlier batches, so a batch can be run again after a
failure. Afterwards, rules and comments that neither this state nor the one
before refers to, and older states and winners, are deleted, so storage follows
the size of the lists, not the number of batches.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.history import edition_diff, run_deltas, run_log
from ..operators.incremental import CANDIDATE_COLS, WINNERS, candidates, edition_of, maintain
from ..operators.parse import comment_rows, parse_rules
from ..operators.refresh import changed_count, detect_changes, source_status, upsert_state
from ..operators.stats import edition_source_counts, edition_stats, parsed_counts
from ..plans.editions import MAX_RULE_LENGTH, edition_text, publish
from ..schema import section_rank
from ..sources.lists import FILE_COLS, SNAPSHOT_FILES, file_lines, newest_files, numbered, raw_rule_counts, run_order, with_source
from ..sources.registry import active_sources
from ..staging import drop_staged, stage, staged_mark

_STATE = "source string, token string, run_id string, parsed bigint, rule_count bigint, raw_count bigint"
_RESULTS = "source string, path string, run_id string, token string, content string, error string, changed boolean"
_RULES = (
    "chunk bigint, line_no bigint, raw string, rule_type string, section string, normalized string, domain string, "
    "key_hash bigint, raw_length int, key_domain string, usual boolean, source string, batch bigint"
)
_COMMENTS = "chunk bigint, line_no bigint, c_chunk bigint, c_line bigint, comment string, source string, batch bigint"
_MEMBERS = "source string, priority int, source_ord int, parsed bigint"
_HISTORY = "edition string, run_ts timestamp, total_rules bigint, batch bigint"
EDITIONS = ("lite", "full")


@dataclass(frozen=True)
class Options:
    """What a refresh may be told: the length limit of rules and the texts of the preamble."""

    max_rule_length: int = MAX_RULE_LENGTH
    title: str | None = None
    description: str | None = None
    homepage: str | None = None

    def texts(self) -> dict[str, str]:
        given = {"title": self.title, "description": self.description, "homepage": self.homepage}
        return {k: v for k, v in given.items() if v is not None}


def _before(spark: SparkSession, schema: str, table: str, batch: int) -> DataFrame:
    """Rows of the batches before ``batch``; empty at the start."""
    if not _batches(spark, table, batch):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(table).filter(F.col("batch") < batch)


def _state(spark: SparkSession, root: str, batch: int) -> DataFrame:
    if batch == 0:
        return spark.createDataFrame([], _STATE)
    return spark.read.schema(_STATE).parquet(f"{root}/state/batch={batch - 1}")


def _landed(spark: SparkSession, files: DataFrame, in_dir: str, state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Newest landed file of each source, if newer than what its lines are from, and its lines.

    The token is a sum of hashes of the file's lines at their places, so files
    are read in splits and never as one value.
    """
    known = state.select("source", F.col("run_id").alias("known_run"))
    chosen = stage(
        newest_files(files).join(known, "source", "left")
        .filter(F.col("known_run").isNull() | (run_order(F.col("run_id")) > run_order(F.col("known_run")))),
        "chosen",
    )
    lines = stage(numbered(file_lines(spark, in_dir, chosen)), "landed")
    bases = lines.groupBy("source", "chunk").agg(F.min("line_no").alias("base"))
    place = F.xxhash64("chunk", F.col("line_no") - F.col("base"), "line").cast("decimal(38,0)")
    tokens = lines.join(bases, ["source", "chunk"]).groupBy("source").agg(F.sum(place).cast("string").alias("token"))
    results = chosen.join(tokens, "source", "left").select(
        "source", "path", "run_id", F.coalesce("token", F.lit("empty")).alias("token"),
        F.lit("landed").alias("content"), F.lit(None).cast("string").alias("error"),
    )
    return results, lines


def apply_batch(
    files: DataFrame, batch: int, in_dir: str, registry: DataFrame, root: str, out: str, options: Options = Options()
) -> bool:
    """Take one batch of landed files over into the tables and publish both editions.

    Rules are kept per source: a source without a newer snapshot keeps its last
    good one. Returns whether an edition was published.
    """
    spark = files.sparkSession
    mark = staged_mark(spark)
    try:
        return _apply(spark, files, batch, in_dir, registry, root, out, options)
    finally:
        drop_staged(spark, mark)


def _apply(spark, files, batch, in_dir, registry, root, out, options) -> bool:
    sources = active_sources(registry)
    files = files.filter(F.col("length") > 0)
    state = _state(spark, root, batch)
    landed, landed_lines = _landed(spark, with_source(files, sources).select(*FILE_COLS), in_dir, state)
    detect_changes(landed, state).select(*_names(_RESULTS)).write.mode("overwrite").parquet(f"{root}/results/batch={batch}")
    results = spark.read.schema(_RESULTS).parquet(f"{root}/results/batch={batch}")
    changed = changed_count(results).first().changed > 0
    if changed:
        _parse(spark, landed_lines, results, sources, root, batch)
    _write_state(spark, state, results, landed_lines, root, batch, changed)
    if not changed:
        return False
    state = spark.read.schema(_STATE).parquet(f"{root}/state/batch={batch}")
    source_results = (
        sources.select(F.col("name").alias("source"), "priority").join(results, "source", "left")
        .withColumn("content", F.lit("kept")).withColumn("changed", F.coalesce("changed", F.lit(False)))
    )
    counts = state.select("source", "rule_count")
    source_status(source_results, counts).write.mode("overwrite").parquet(f"{root}/status/batch={batch}")
    summary = spark.read.parquet(f"{root}/status/batch={batch}").join(
        sources.select(F.col("name").alias("source"), "source_ord", "lite"), "source")
    at = datetime.now(timezone.utc)
    done, totals, logs, diffs = False, [], [], []
    for name in EDITIONS:
        chosen = F.col("lite") if name == "lite" else F.lit(True)
        members = (
            sources.filter(chosen).select(F.col("name").alias("source"), "priority", "source_ord")
            .join(state.filter("parsed is not null").select("source", "parsed"), "source").select(*_names(_MEMBERS))
        )
        previous = _winners(spark, root, name, batch)
        winners = _merge(spark, root, name, batch, members)
        edition = stage(edition_of(winners, options.max_rule_length).withColumn("section_rank", section_rank(F.col("rule_type"))), "edition")
        comments = _stored(spark, f"{root}/comments", _COMMENTS, _rows(members)).drop("batch")
        text = edition_text(edition, comments, summary.filter(chosen), at, **options.texts())
        if publish(edition, text, f"{out}/{name}", f"{batch:010d}"):
            done = True
            label = F.lit(name).alias("edition")
            totals.append(edition_stats(edition).select(label, F.lit(at).alias("run_ts"), "total_rules", F.lit(batch).cast("bigint").alias("batch")))
            logs.append(run_log(summary.filter(chosen), edition_source_counts(edition)).select(label, "*"))
            diffs.append(edition_diff(edition_of(previous, options.max_rule_length), edition).select(label, "*"))
    for table, parts in (("log", logs), ("changes", diffs)):
        if parts:
            reduce(DataFrame.unionByName, parts).write.mode("overwrite").parquet(f"{root}/{table}/batch={batch}")
    if totals:
        now = reduce(DataFrame.unionByName, totals)
        earlier = _before(spark, _HISTORY, f"{root}/history", batch)
        deltas = run_deltas(earlier.unionByName(now)).join(now.select("edition", "run_ts"), ["edition", "run_ts"], "left_semi")
        stage(deltas, "history").write.mode("overwrite").parquet(f"{root}/history/batch={batch}")
    _forget(spark, root, batch)
    return done


def _parse(spark, landed_lines, results, sources, root, batch) -> None:
    """Store rules and comments of the sources that changed; nothing else is parsed."""
    lines = with_source(landed_lines.join(results.filter("changed").select("source"), "source", "left_semi"), sources)
    candidates(parse_rules(lines)).write.mode("overwrite").partitionBy("source").parquet(f"{root}/rules/batch={batch}")
    comment_rows(lines).write.mode("overwrite").partitionBy("source").parquet(f"{root}/comments/batch={batch}")


def _write_state(spark, state, results, landed_lines, root, batch, changed) -> None:
    """Tokens, runs and, for what was parsed now, its batch and counts."""
    # The run is noted for unchanged files too, so that older ones stay out.
    runs = state.select("source", F.col("run_id").alias("old_run")).join(results.select("source", F.col("run_id").alias("new_run")), "source", "full_outer")
    tokens = upsert_state(state, results).join(runs.select("source", F.coalesce("new_run", "old_run").alias("run_id")), "source")
    now = results.filter("changed").select("source")
    if changed:
        parsed = spark.read.schema(_RULES).parquet(f"{root}/rules/batch={batch}") if _batches(spark, f"{root}/rules/batch={batch}", None, "source=") else spark.createDataFrame([], _RULES)
        now = now.join(parsed_counts(parsed), "source", "left").join(raw_rule_counts(landed_lines).withColumnRenamed("rule_count", "raw_count"), "source", "left")
    else:
        now = now.select("source", F.lit(None).cast("bigint").alias("rule_count"), F.lit(None).cast("bigint").alias("raw_count"))
    now = now.select("source", F.lit(batch).cast("bigint").alias("parsed"), *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("rule_count", "raw_count")])
    kept = state.select("source", "parsed", "rule_count", "raw_count").join(now.select("source"), "source", "left_anti")
    (
        tokens.join(kept.unionByName(now), "source", "left")
        .select(*_names(_STATE)).write.mode("overwrite").parquet(f"{root}/state/batch={batch}")
    )


def _rows(members: DataFrame) -> list[Row]:
    """Members on the driver: one row per source of the registry."""
    return members.collect()


def _stored(spark: SparkSession, table: str, schema: str, members: list[Row]) -> DataFrame:
    """Stored rows of the members, each from the batch that parsed it.

    Only folders of those batches are listed, and of them only the partitions of
    the sources asked for are read.
    """
    by_batch: dict[int, list[str]] = {}
    for m in members:
        by_batch.setdefault(m.parsed, []).append(m.source)
    paths = [f"{table}/batch={b}" for b in sorted(by_batch) if _batches(spark, f"{table}/batch={b}", None, "source=")]
    if not paths:
        return spark.createDataFrame([], schema)
    wanted = reduce(or_, [(F.col("batch") == b) & F.col("source").isin(names) for b, names in by_batch.items()])
    return spark.read.schema(schema).option("basePath", table).parquet(*paths).filter(wanted)


def _winners(spark: SparkSession, root: str, edition: str, batch: int) -> DataFrame:
    """Winners before the batch; empty at the start."""
    done = _batches(spark, f"{root}/winners/edition={edition}", batch)
    if not done:
        return spark.createDataFrame([], WINNERS)
    return spark.read.schema(WINNERS).parquet(f"{root}/winners/edition={edition}/batch={done[-1]}")


def _merge(spark: SparkSession, root: str, edition: str, batch: int, members: DataFrame) -> DataFrame:
    """Write members and winners of the batch from those of the batch before."""
    table = f"{root}/members/edition={edition}"
    members.write.mode("overwrite").parquet(f"{table}/batch={batch}")
    members = spark.read.schema(_MEMBERS).parquet(f"{table}/batch={batch}")
    # The winners' own batch: members of a batch that failed in between do not count.
    done = _batches(spark, f"{root}/winners/edition={edition}", batch)
    before = spark.read.schema(_MEMBERS).parquet(f"{table}/batch={done[-1]}") if done else spark.createDataFrame([], _MEMBERS)
    key = _names(_MEMBERS)
    gone = before.join(members, key, "left_anti")
    came, stayed = members.join(before, key, "left_anti"), members.join(before, key, "left_semi")

    def rules_of(part: DataFrame) -> DataFrame:
        stored = _stored(spark, f"{root}/rules", _RULES, _rows(part)).select(*CANDIDATE_COLS)
        return stored.join(part.select("source", "priority", "source_ord"), "source")

    merged = maintain(_winners(spark, root, edition, batch), gone, rules_of(stayed), rules_of(came))
    merged.write.mode("overwrite").parquet(f"{root}/winners/edition={edition}/batch={batch}")
    return spark.read.schema(WINNERS).parquet(f"{root}/winners/edition={edition}/batch={batch}")


def _forget(spark: SparkSession, root: str, batch: int) -> None:
    """Delete what neither this batch nor a second run of it can need."""
    reached: set[int] = {batch}
    for b in (batch - 1, batch):
        if _batches(spark, f"{root}/state", b + 1)[-1:] == [b]:
            reached |= {r.parsed for r in spark.read.schema(_STATE).parquet(f"{root}/state/batch={b}").select("parsed").distinct().collect()}
    for table in ("rules", "comments"):
        for b in _batches(spark, f"{root}/{table}", batch):
            if b not in reached:
                _delete(spark, f"{root}/{table}/batch={b}")
    for b in _batches(spark, f"{root}/state", batch - 1):
        _delete(spark, f"{root}/state/batch={b}")
    for name in EDITIONS:
        kept = _batches(spark, f"{root}/winners/edition={name}", batch)[-1:]
        for table in ("winners", "members"):
            for b in _batches(spark, f"{root}/{table}/edition={name}", batch):
                if b not in kept:
                    _delete(spark, f"{root}/{table}/edition={name}/batch={b}")


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def _files(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _delete(spark: SparkSession, path: str) -> None:
    place, files = _files(spark, path)
    files.delete(place, True)


def _batches(spark: SparkSession, table: str, before: int | None, prefix: str = "batch=") -> list:
    """Batches of a table that were written completely, ascending, below ``before``.

    With another prefix: the names of such folders.
    """
    place, files = _files(spark, table)
    if not files.exists(place):
        return []
    found = [f.getPath() for f in files.listStatus(place) if f.getPath().getName().startswith(prefix)]
    if prefix != "batch=":
        return sorted(p.getName() for p in found)
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    done = [int(p.getName()[len(prefix):]) for p in found if files.exists(jvm_path(p, "_SUCCESS"))]
    return sorted(b for b in done if before is None or b < before)


def refresh(
    spark: SparkSession, in_dir: str, checkpoint: str, sources: DataFrame, out: str, options: Options = Options()
) -> StreamingQuery:
    """Process what has landed since the last call, then stop. Run it from a timer."""
    landed = (
        spark.readStream.format("binaryFile").schema(SNAPSHOT_FILES).load(in_dir)
        .select(F.col("_metadata.file_path").alias("path"), *FILE_COLS[1:])
    )
    return (
        landed.writeStream
        .foreachBatch(
            lambda files, batch: apply_batch(files, batch, in_dir, sources, f"{checkpoint}/tables", out, options)
        )
        .option("checkpointLocation", f"{checkpoint}/stream")
        .trigger(availableNow=True)
        .start()
    )

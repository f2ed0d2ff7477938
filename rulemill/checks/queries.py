"""One query per operator, each over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import fixed
from ..functions.lines import inject_kind
from ..functions.normalize import has_match_case, key_separator, sort_domain_option, sort_sites, strip_www
from ..functions.options import option_tokens, options_text, options_valid
from ..operators import dedup, history, parse, refresh, stats, subsume
from ..plans import editions
from ..sources import lists, registry as reg
from ..staging import stage
from . import corpora as c

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Fixed publication time and "now" of the retention query: last day of ``events``.
AT = datetime(2024, 1, 30, 0, 0, 0)
KEEP_DAYS = 14


def query(f: Query) -> Query:
    """Register under the function's name; a ``_query`` ending avoids imported names."""
    QUERIES[f.__name__.removesuffix("_query")] = f
    return f


def _count(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def _joined(array: str | Column) -> Column:
    return F.array_join(array, "\n")


def _syntax_rules(spark: SparkSession, d: str) -> DataFrame:
    return parse.parse_rules(c.rule_lines(spark, d))


def _all_types(spark: SparkSession, d: str) -> DataFrame:
    return parse.type_rules(c.all_lines(spark, d))


def _all_rules(spark: SparkSession, d: str) -> DataFrame:
    return parse.parse_rules(c.all_lines(spark, d))


# Scans and sources


@query
def active_sources(spark, d):
    return reg.active_sources(c.registry(spark, d))


@query
def lite_sources(spark, d):
    return reg.active_sources(c.registry(spark, d), lite=True)


@query
def source_catalogue(spark, d):
    return reg.source_catalogue(c.registry(spark, d), bucket_size=16)


def _snapshots(spark, d):
    docs = c.table(spark, d, "documents")
    return docs.select(F.concat(F.lit("doc"), "doc_id").alias("source"), "text")


@query
def list_lines(spark, d):
    return lists.list_lines(_snapshots(spark, d), c.CHUNK)


@query
def raw_rule_counts(spark, d):
    return lists.raw_rule_counts(c.all_lines(spark, d))


# Incremental refresh: users are sources, a day is a run, no event is a failure.
# Every day is compared with the day before it.

RUN = ("run", "source")


def _days(spark, d) -> DataFrame:
    events = c.table(spark, d, "events")
    run = F.dayofmonth("ts").alias("run")
    source = F.concat(F.lit("user"), "user_id").alias("source")
    seen = events.groupBy(run, source).agg(
        F.min("props").alias("strong"), F.min("event_type").alias("weak"),
        F.max("event_type").alias("content"), F.count_if(F.col("value") > 10).alias("rule_count"),
    )
    days = [F.lit(row.run) for row in events.select(run).distinct().collect()]  # 31 at most
    asked = events.select(source).distinct().select("source", F.explode(F.array(*days)).alias("run"))
    ok = F.col("strong").isNotNull()
    return asked.join(seen, list(RUN), "left").select(
        *RUN,
        F.when(F.col("weak") == "click", "").otherwise(F.col("strong")).alias("strong"), "weak",
        F.when(F.col("weak") == "click", "").otherwise(F.col("strong")).alias("token"),
        F.when(F.col("content") == "view", "").otherwise(F.col("content")).alias("content"),
        "rule_count",
        F.when(~ok, "no answer").alias("error"),
    )


def _first_and_last(spark, d):
    return c.table(spark, d, "events").agg(F.min(F.dayofmonth("ts")).alias("first"), F.max(F.dayofmonth("ts")).alias("last")).first()


def _now(spark, d):
    return _days(spark, d).filter(F.col("run") > _first_and_last(spark, d).first)


def _old_state(spark, d):
    """Tokens of each day, filed under the day after."""
    before = _days(spark, d).filter("error is null and token <> ''").filter(F.col("run") < _first_and_last(spark, d).last)
    return before.select((F.col("run") + 1).alias("run"), "source", "token")


def _results(spark, d):
    return refresh.detect_changes(_now(spark, d), _old_state(spark, d), RUN)


@query
def changed_sources(spark, d):
    return _results(spark, d).select(*RUN, "token", "changed")


@query
def token_coalesce(spark, d):
    old = _old_state(spark, d).withColumnRenamed("token", "previous")
    return _now(spark, d).join(old, list(RUN), "left").select(
        *RUN,
        refresh.choose_token(F.col("strong"), F.col("weak"), F.col("previous")).alias("token"),
    )


@query
def state_upsert(spark, d):
    return refresh.upsert_state(_old_state(spark, d), _now(spark, d), RUN)


def _statuses(spark, d):
    return refresh.source_status(_results(spark, d).drop("rule_count"), _now(spark, d).select(*RUN, "rule_count"), RUN)


@query
def source_status(spark, d):
    return _statuses(spark, d)


@query
def changed_count(spark, d):
    return refresh.changed_count(_results(spark, d), ("run",))


@query
def usable_sources(spark, d):
    """Snapshot carried forward for each user over all days."""
    daily = (
        c.table(spark, d, "events")
        .groupBy(
            F.concat(F.lit("user"), "user_id").alias("source"),
            F.date_format("ts", "yyyy-MM-dd").alias("run_id"),
        )
        .agg(F.max("event_type").alias("top"), F.min("event_type").alias("low"), F.min("props").alias("token"))
    )
    snapshots = daily.select(
        "source", "run_id", "token",
        F.when(F.col("top") != "view", F.col("top")).otherwise("").alias("content"),
        F.when(F.col("low") == "purchase", "failed").alias("error"),
    )
    return refresh.last_good(snapshots).select("source", "run_id", "content")


# Parsing


@query
def line_kind(spark, d):
    kinds = parse.classify_lines(c.all_lines(spark, d))
    return kinds.groupBy("source", "kind").agg(_count("lines"))


def _of_kind(spark, d, kind):
    kinds = parse.classify_lines(c.rule_lines(spark, d))
    return kinds.filter(F.col("kind") == kind).select("source", "line_no", "text")


@query
def headers(spark, d):
    return _of_kind(spark, d, fixed.KIND_HEADER)


@query
def section_markers(spark, d):
    return _of_kind(spark, d, fixed.KIND_SECTION_MARKER)


@query
def hash_comments(spark, d):
    return _of_kind(spark, d, fixed.KIND_HASH_COMMENT)


@query
def hosts_rows(spark, d):
    hosts = F.col("raw").startswith("0.0.0.0") | F.col("raw").startswith("127.0.0.1")
    return _syntax_rules(spark, d).filter(hosts).select("source", "line_no", "raw", "domain")


@query
def rule_types(spark, d):
    return _all_types(spark, d).groupBy("source", "rule_type", "sep").agg(_count("rules"))


@query
def inject_kind_query(spark, d):
    injected = _syntax_rules(spark, d).filter(F.col("sep").isin("#%#", "#$#"))
    kind = F.when(F.col("sep") == "#%#", inject_kind(F.col("raw"), "#%#")).otherwise(
        inject_kind(F.col("raw"), "#$#")
    )
    return injected.select("source", "line_no", "raw", kind.alias("kind"))


def _with_options(spark, d):
    rules = _syntax_rules(spark, d).filter("sep = '' and instr(raw, '$') > 0 and section <> 'header'")
    return rules.withColumn("options_text", options_text(F.col("raw"))).withColumn(
        "tokens", option_tokens(F.col("options_text"))
    )


@query
def option_tokens_query(spark, d):
    return _with_options(spark, d).select("source", "line_no", "raw", _joined("tokens").alias("tokens"))


@query
def options_valid_query(spark, d):
    valid = options_valid(F.col("options_text"), F.col("tokens"))
    return _with_options(spark, d).select("source", "line_no", "raw", valid.alias("valid"))


@query
def rule_options(spark, d):
    entries = F.transform(
        F.map_entries("options"),
        lambda e: F.concat(e["key"], F.when(e["value"].isNull(), "").otherwise(F.concat(F.lit("="), e["value"]))),
    )
    return (
        _syntax_rules(spark, d).filter("section in ('block', 'exception')")
        .select("source", "line_no", "pattern", _joined(F.sort_array(entries)).alias("options"))
    )


@query
def option_usage(spark, d):
    return parse.option_usage(_syntax_rules(spark, d))


@query
def site_scope(spark, d):
    return (
        _syntax_rules(spark, d).filter("section = 'element'")
        .select("source", "line_no", "raw", _joined("domains").alias("sites"))
    )


@query
def rules_by_site(spark, d):
    return parse.rules_by_site(_all_rules(spark, d))


@query
def rule_domain(spark, d):
    return _all_rules(spark, d).groupBy("source", "domain").agg(_count("rules"))


@query
def rule_comments(spark, d):
    lines = c.rule_lines(spark, d)
    rules = parse.attach_comments(parse.parse_rules(lines), lines)
    return rules.select("source", "line_no", "raw", _joined("comments").alias("comments"))


@query
def parse_key(spark, d):
    return _syntax_rules(spark, d).select("source", "line_no", "raw", "parsed_key")


# Canonical keys


@query
def normalized(spark, d):
    return _all_rules(spark, d).groupBy("source", "normalized").agg(_count("rules"))


@query
def match_case_key(spark, d):
    return _with_options(spark, d).select(
        "source", "line_no", "raw", has_match_case(F.col("options_text")).alias("match_case"), "normalized"
    )


@query
def strip_www_query(spark, d):
    lines = c.rule_lines(spark, d).filter(F.contains("line", F.lit("www.")))
    return lines.select("source", "line_no", strip_www(F.col("line")).alias("line"))


@query
def sorted_sites(spark, d):
    rules = _syntax_rules(spark, d).filter("section = 'element'")
    key = sort_sites(F.col("raw"), key_separator(F.col("raw")))
    return rules.select("source", "line_no", "raw", key.alias("key"))


@query
def sorted_domain_option(spark, d):
    rules = _with_options(spark, d)
    return rules.select("source", "line_no", "raw", sort_domain_option(F.col("options_text")).alias("key"))


# Merge


@query
def priority_union(spark, d):
    rules = _syntax_rules(spark, d)
    return rules.orderBy("priority", "source_ord", "chunk", "line_no").select(
        "priority", "source_ord", "line_no", "source", "raw"
    )


@query
def sections(spark, d):
    return _all_types(spark, d).groupBy("section", "rule_type").agg(_count("rules"))


@query
def exact_dedup(spark, d):
    kept = dedup.dedup_exact(_all_rules(spark, d))
    return kept.select("section", "normalized", "raw", "source", "priority")


@query
def dup_counts(spark, d):
    return dedup.duplicate_counts(_all_rules(spark, d))


@query
def subset_dedup(spark, d):
    kept = subsume.dedup_subsumed(dedup.dedup_exact(_all_rules(spark, d)), ["section", "normalized", "raw", "source", "priority"])
    return kept.filter("section = 'block'").select("normalized", "raw", "source", "priority")


@query
def broader_pairs(spark, d):
    return subsume.covering_parents(dedup.dedup_exact(_all_rules(spark, d)), every=True)


@query
def final_keepers(spark, d):
    return subsume.final_keepers(dedup.dedup_exact(_all_rules(spark, d)))


@query
def subsumed_count(spark, d):
    return subsume.covered_rules(dedup.dedup_exact(_all_rules(spark, d)), ["section"]).agg(_count("removed"))


@query
def edition_order(spark, d):
    merged = editions.merge_rules(_syntax_rules(spark, d))
    return editions.order_edition(merged).select(
        F.col("section_rank").cast("int").alias("section_rank"), "priority", "source_ord", "line_no", "raw"
    )


@query
def length_filter(spark, d):
    merged = editions.merge_rules(_all_rules(spark, d), max_rule_length=120)
    return merged.select("section", "normalized", F.length("raw").alias("length"))


def _published(edition: DataFrame) -> DataFrame:
    return edition.select(
        "section", "source", "priority", "line_no", "raw", "normalized", _joined("comments").alias("comments")
    )


@query
def edition_lite(spark, d):
    return _published(editions.build_edition(c.all_lines(spark, d), lite=True))


@query
def edition_full(spark, d):
    return _published(editions.build_edition(c.all_lines(spark, d)))


# Statistics


@query
def edition_stats(spark, d):
    return stats.edition_stats(editions.merge_rules(_all_rules(spark, d), columns=editions.COUNT_COLS))


@query
def by_source(spark, d):
    return stats.edition_source_counts(editions.merge_rules(_all_rules(spark, d), columns=editions.COUNT_COLS))


@query
def source_summary(spark, d):
    rules = _all_types(spark, d)
    return rules.groupBy("source", "priority").agg(_count("rule_count"))


@query
def type_profile(spark, d):
    return stats.type_profile(_all_types(spark, d))


def _published_lines(spark, d):
    """Three made-up editions: a marker or stamp now and then, else a rule line."""
    n = F.col("page_id")
    mark = F.array(*[F.lit(m) for m in (
        fixed.MARK_EXCEPTION, fixed.MARK_BLOCK, fixed.MARK_ELEMENT, fixed.MARK_HIDE_EXCEPTION,
    )])
    line = (
        F.when(n % 17 == 5, F.element_at(mark, (F.floor(n / 17) % 4 + 1).cast("int")))
        .when(n % 23 == 7, F.concat(F.lit("! Last modified: run "), n))
        .when(n % 11 == 3, F.concat(F.lit("[$path=/x]"), "url"))
        .when(n % 11 == 4, F.concat(F.lit("! "), "url"))
        .otherwise(F.col("url"))
    )
    return c.table(spark, d, "pages").select(
        F.concat(F.lit("edition"), n % 3).alias("edition"),
        F.floor(n / c.CHUNK).alias("chunk"), n.alias("line_no"), line.alias("line"),
    )


@query
def reread_stats(spark, d):
    return stats.reread_stats(_published_lines(spark, d)).drop("stamp")


@query
def reread_stamp(spark, d):
    return stats.reread_stats(_published_lines(spark, d)).select("edition", "stamp")


@query
def file_stats(spark, d):
    docs = c.table(spark, d, "documents")
    sizes = docs.groupBy(F.col("source").alias("file")).agg(F.sum(F.octet_length("text")).alias("size_bytes"))
    lines = c.all_lines(spark, d).select(F.col("source").alias("file"), "line")
    return stats.quick_stats(lines, sizes)


# Publication and history


@query
def edition_text(spark, d):
    lines = c.all_lines(spark, d)
    rules = parse.type_rules(lines)
    edition = stage(editions.edition_rules(lines), "edition")
    summary = rules.groupBy("source", "priority", "source_ord").agg(_count("rule_count"))
    text = editions.edition_text(edition, parse.comment_rows(lines), summary, AT)
    return text.select("part", "priority", "source_ord", "line_no", "is_rule", "c_line", "text")


def _history(spark, d):
    day = F.date_trunc("day", F.col("ts").cast("timestamp_ntz")).cast("timestamp_ntz")
    return (
        c.table(spark, d, "events")
        .groupBy(F.col("event_type").alias("edition"), day.alias("run_ts"))
        .agg(_count("total_rules"))
    )


@query
def net_delta(spark, d):
    return history.run_deltas(_history(spark, d)).withColumn("run_ts", F.date_format("run_ts", "yyyy-MM-dd"))


@query
def edition_diff(spark, d):
    before = dedup.dedup_exact(_syntax_rules(spark, d).filter("line_no % 10 <> 3"))
    now = dedup.dedup_exact(_syntax_rules(spark, d).filter("line_no % 10 <> 7"))
    return history.edition_diff(before, now)


@query
def run_log(spark, d):
    counts = c.table(spark, d, "events").filter("event_type = 'click'").groupBy(
        F.dayofmonth("ts").alias("run"), F.concat(F.lit("user"), "user_id").alias("source")
    ).agg(_count("rules"))
    return history.run_log(_statuses(spark, d), counts, RUN)


@query
def history_retention(spark, d):
    kept = history.retain(_history(spark, d), AT, KEEP_DAYS)
    return kept.withColumn("run_ts", F.date_format("run_ts", "yyyy-MM-dd"))

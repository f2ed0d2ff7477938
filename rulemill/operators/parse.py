"""Lines -> typed rules, one projection; comments -> rules, one skinny window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed
from ..functions.domains import anchored_domain, extract_domain, site_scope
from ..functions.lines import hosts_raw, hosts_target, line_kind, rule_type_and_sep
from ..functions.normalize import add_normalized
from ..functions.options import (
    option_tokens, options_map, options_text, options_valid, pattern_text,
)
from ..functions.text import after, compute_once, strip
from ..schema import ORDER_KEY, section_of
from ..staging import stage
from .carry import carry



def classify_lines(lines: DataFrame) -> DataFrame:
    """Adds ``text`` (the stripped line) and ``kind``."""
    stripped = compute_once(lines, text=strip(F.col("line")))
    return compute_once(stripped, kind=line_kind(F.col("text")))


def type_rules(lines: DataFrame) -> DataFrame:
    """Rules with their text and type only: raw, rule_type, sep, section."""
    text, kind = F.col("text"), F.col("kind")
    is_rule = kind == fixed.KIND_RULE
    return compute_once(
        classify_lines(lines).filter(kind.isin(fixed.RULE_KINDS)),
        raw=F.when(kind == fixed.KIND_HOSTS, hosts_raw(text)).otherwise(text),
        _type=F.when(is_rule, rule_type_and_sep(text)),
    ).select(
        *lines.columns, "text", "kind", "raw",
        F.when(is_rule, F.col("_type.rule_type"))
        .when(kind == fixed.KIND_HEADER, fixed.HEADER)
        .otherwise(fixed.BLOCK).alias("rule_type"),
        F.coalesce("_type.sep", F.lit("")).alias("sep"),
    ).withColumn("section", section_of(F.col("rule_type")))


def parse_rules(lines: DataFrame) -> DataFrame:
    """One row per rule; narrow, no shuffle. Comments: see ``attach_comments``."""
    text, kind, raw = F.col("text"), F.col("kind"), F.col("raw")
    is_rule = kind == fixed.KIND_RULE
    is_network = is_rule & (F.col("sep") == "") & raw.contains("$")
    opened = compute_once(type_rules(lines), _options=F.when(is_network, options_text(raw)))
    split = compute_once(opened, _tokens=option_tokens(F.col("_options")))
    checked = compute_once(split, _valid=options_valid(F.col("_options"), F.col("_tokens")))
    patterned = compute_once(
        checked,
        pattern=F.when(kind == fixed.KIND_HEADER, "")
        .when(F.col("_valid"), pattern_text(raw))
        .otherwise(raw),
    )
    anchored = compute_once(patterned, _anchored=anchored_domain(F.col("pattern")))
    no_sites = F.array().cast("array<string>")
    no_options = F.create_map().cast("map<string,string>")
    # Steps that work through arrays come last, in projections that are pruned
    # when nobody asks for their columns.
    return (
        add_normalized(anchored, "raw")
        .select(
            *ORDER_KEY, *_carried(lines), "raw", "rule_type", "sep", "section", "pattern", "normalized",
            F.when(kind == fixed.KIND_HEADER, "")
            .when(kind == fixed.KIND_HOSTS, F.lower(hosts_target(text)))
            .otherwise(extract_domain(F.col("pattern"), F.col("_anchored"))).alias("domain"),
            F.when(is_rule & (F.col("sep") != ""), site_scope(text, F.col("sep")))
            .otherwise(no_sites).alias("domains"),
            F.when(F.col("_valid"), options_map(F.col("_tokens")))
            .otherwise(no_options).alias("options"),
        )
        .withColumn("parsed_key", parsed_key())
    )


def parsed_key() -> Column:
    """Key given while parsing: lower case, sites sorted when there are several."""
    sites = F.sort_array(F.transform("domains", F.lower))
    selector = F.lower(after(F.col("raw"), F.col("sep")))
    return F.when(
        F.size("domains") > 1, F.concat(F.array_join(sites, ","), F.col("sep"), selector)
    ).otherwise(F.lower("raw"))


def comment_rows(lines: DataFrame) -> DataFrame:
    """Comments with the rule they wait for: source, chunk, line_no of the rule,
    c_chunk, c_line, comment.

    A comment belongs to the next rule of its source, however many lines that
    are no rules lie between. Only places and comment texts are shuffled, never
    rule texts, and by (source, chunk), so a long list does not end up in one
    task; a block of any number of comments stays as many rows.
    """
    kind = F.col("kind")
    marked = (
        classify_lines(lines)
        .filter(kind.isin(*fixed.RULE_KINDS, fixed.KIND_COMMENT))
        .select("source", "chunk", "line_no", F.when(kind == fixed.KIND_COMMENT, F.col("text")).alias("comment"))
    )
    is_comment = F.col("comment").isNotNull()
    places = stage(marked, "places").withColumn("place", F.when(~is_comment, F.struct("chunk", "line_no")))
    located = carry(places, ["source"], "place", "target", backwards=True, keep=is_comment)
    return located.filter(F.col("target").isNotNull()).select(
        "source", F.col("target.chunk").alias("chunk"), F.col("target.line_no").alias("line_no"),
        F.col("chunk").alias("c_chunk"), F.col("line_no").alias("c_line"), "comment",
    )


def rule_comments(lines: DataFrame) -> DataFrame:
    """Comments of each rule as an array: source, chunk, line_no, comments."""
    ordered = F.sort_array(F.collect_list(F.struct("c_chunk", "c_line", "comment")))
    return (
        comment_rows(lines).groupBy("source", "chunk", "line_no").agg(ordered.alias("_waiting"))
        .select("source", "chunk", "line_no", F.transform("_waiting", lambda w: w["comment"]).alias("comments"))
    )


def attach_comments(rules: DataFrame, lines: DataFrame) -> DataFrame:
    """Rules with their ``comments``; call it on what is published, after dedup."""
    none = F.array().cast("array<string>")
    return rules.join(
        rule_comments(lines), ["source", "chunk", "line_no"], "left"
    ).withColumn("comments", F.coalesce("comments", none))


def explode_options(rules: DataFrame) -> DataFrame:
    """One row per rule and option; ``value`` is NULL for flags."""
    return rules.select(*ORDER_KEY, "raw", F.explode("options").alias("option", "value"))


def explode_sites(rules: DataFrame) -> DataFrame:
    return rules.select(*ORDER_KEY, "raw", "rule_type", F.explode("domains").alias("site"))


def option_usage(rules: DataFrame) -> DataFrame:
    return explode_options(rules).groupBy("option").agg(
        F.count(F.lit(1)).alias("rules"), F.count("value").alias("with_value")
    )


def rules_by_site(rules: DataFrame) -> DataFrame:
    return explode_sites(rules).groupBy("site").agg(F.count(F.lit(1)).alias("rules"))


def _carried(lines: DataFrame) -> list[str]:
    """Columns of the input that rules keep, e.g. source, run and lite flag."""
    return [c for c in lines.columns if c not in (*ORDER_KEY, "line")]

"""Canonical key of a rule: two rules with the same key are duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed
from .text import after, before, collapse_spaces, compute_once, strip


def has_match_case(options: Column) -> Column:
    """Is ``match-case`` one of the comma-separated option keys?"""
    return options.contains("match-case") & options.rlike(fixed.PAT_MATCH_CASE)


def strip_www(pattern: Column) -> Column:
    """Drop ``www.`` after any character other than a-z and 0-9, in one pass."""
    return F.when(
        pattern.contains("www."), F.regexp_replace(pattern, fixed.PAT_WWW, "$1")
    ).otherwise(pattern)


def key_separator(pattern: Column) -> Column:
    """First listed separator that the pattern contains, NULL if none."""
    chain = F.when(~pattern.contains("#") & ~pattern.contains("$$"), F.lit(None).cast("string"))
    for sep in fixed.KEY_SEPARATORS:
        chain = chain.when(pattern.contains(sep), sep)
    return chain


def sort_sites(pattern: Column, sep: Column) -> Column:
    """Sort the comma-separated sites before ``sep``, the ``key_separator``."""
    sites = before(pattern, sep)
    names = F.filter(F.transform(F.split(sites, ","), strip), lambda s: s != "")
    return F.when(
        sep.isNotNull() & sites.contains(","),
        F.concat(F.array_join(F.sort_array(names), ","), sep, after(pattern, sep)),
    ).otherwise(pattern)


def sort_domain_option(options: Column) -> Column:
    """Sort the ``|``-separated values of every ``domain=`` option."""

    def sorted_values(segment: Column) -> Column:
        values = after(segment, "domain=")
        ordered = F.array_join(F.sort_array(F.transform(F.split(values, "[|]"), strip)), "|")
        return F.when(
            values != "", F.concat(before(segment, "domain="), F.lit("domain="), ordered)
        ).otherwise(segment)

    segments = F.regexp_extract_all(options, F.lit(fixed.PAT_OPTION_SEGMENT), F.lit(0))
    return F.when(
        options.contains("domain="), F.array_join(F.transform(segments, sorted_values), "")
    ).otherwise(options)


def add_normalized(rules: DataFrame, text: str, out: str = "normalized") -> DataFrame:
    """Adds the canonical key of the stripped rule line in column ``text``.

    The key is built in steps, each a plain column for the next, so the long
    conditions run as compiled code and once per rule.
    """
    line = F.col(text)
    cut = compute_once(
        rules, _cut=F.when(line.contains("$") & key_separator(line).isNull(), F.instr(line, "$"))
    )
    parts = compute_once(
        cut,
        _pattern=F.when(F.col("_cut").isNull(), line)
        .otherwise(F.substring(line, F.lit(1), F.col("_cut") - 1)),
        _opts=F.when(F.col("_cut").isNull(), "")
        .otherwise(F.substring(line, F.col("_cut") + 1, F.length(line))),
    )
    pattern, options = F.col("_pattern"), F.col("_opts")
    cased = compute_once(
        parts, _cased=F.when(has_match_case(options), pattern).otherwise(F.lower(pattern))
    )
    even = compute_once(cased, _even=collapse_spaces(F.col("_cased")))
    bare = compute_once(even, _bare=strip_www(F.col("_even")))
    located = compute_once(
        bare, _ksep=F.when(F.col("_bare").contains(","), key_separator(F.col("_bare")))
    )
    key = F.when(F.col("_ksep").isNull(), F.col("_bare")).otherwise(
        sort_sites(F.col("_bare"), F.col("_ksep"))
    )
    tail = F.when(options == "", "").otherwise(
        F.concat(F.lit("$"), sort_domain_option(F.lower(options)))
    )
    return located.withColumn(out, F.concat(key, tail)).drop(
        "_cut", "_pattern", "_opts", "_cased", "_even", "_bare", "_ksep"
    )

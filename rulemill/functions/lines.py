"""Kinds of lines and types of rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import fixed
from .text import after, starts_with_any, strip, strip_left


def is_hash_comment(text: Column) -> Column:
    """``#`` comment of a hosts file, as opposed to a global element rule."""
    only_hashes = strip(F.translate(text, "#", "")) == ""
    return text.startswith("#") & (
        only_hashes | ~starts_with_any(text, fixed.ELEMENT_PREFIXES)
    )


def is_hosts_row(text: Column) -> Column:
    return starts_with_any(text, fixed.HOSTS_ADDRESSES) & text.rlike(fixed.PAT_HOSTS)


def line_kind(text: Column) -> Column:
    """Kind of a stripped line; the first matching test decides."""
    bang = (
        F.when(starts_with_any(text, fixed.HEADER_PREFIXES), fixed.KIND_HEADER)
        .when(text.startswith("! =") & text.endswith("="), fixed.KIND_SECTION_MARKER)
        .otherwise(fixed.KIND_COMMENT)
    )
    bracketed = text.startswith("[") & text.endswith("]") & (F.length(text) > 1)
    return (
        F.when(text == "", fixed.KIND_BLANK)
        .when(text.startswith("!"), bang)
        .when(bracketed, fixed.KIND_BLOCK_MARKER)
        .when(is_hash_comment(text), fixed.KIND_HASH_COMMENT)
        .when(is_hosts_row(text), fixed.KIND_HOSTS)
        .otherwise(fixed.KIND_RULE)
    )


def hosts_raw(text: Column) -> Column:
    """A hosts row without its trailing comment."""
    return strip(F.substring_index(text, " #", 1))


def hosts_target(text: Column) -> Column:
    rest = strip(F.regexp_extract(text, fixed.PAT_HOSTS, 1))
    return strip(F.substring_index(rest, " #", 1))


def inject_kind(text: Column, sep: str) -> Column:
    """Script or style, told apart by how the text after ``sep`` begins."""
    body = strip_left(after(text, sep))
    return (
        F.when(starts_with_any(body, fixed.SCRIPT_BODY_PREFIXES), fixed.SCRIPTLET)
        .otherwise(fixed.CSS_INJECT)
    )


def rule_type_and_sep(text: Column) -> Column:
    """struct(rule_type, sep) of a stripped rule line; sep is '' for network rules."""

    def typed(rule_type: Column | str, sep: str) -> Column:
        kind = F.lit(rule_type) if isinstance(rule_type, str) else rule_type
        return F.struct(kind.alias("rule_type"), F.lit(sep).alias("sep"))

    network = F.when(text.startswith("@@"), typed(fixed.EXCEPTION, "")).otherwise(
        typed(fixed.BLOCK, "")
    )
    # Most lines hold no separator at all: leave before testing thirteen of them.
    chain = F.when(~text.contains("#") & ~text.contains("$$"), network)
    for sep, rule_type in fixed.TYPE_SEPARATORS:
        chain = chain.when(text.contains(sep), typed(rule_type or inject_kind(text, sep), sep))
    return chain.otherwise(network)

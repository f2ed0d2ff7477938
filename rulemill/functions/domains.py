"""Domains and site scopes inside rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import fixed
from .lines import is_hosts_row
from .text import before, strip


def site_scope(text: Column, sep: Column) -> Column:
    """Sites before the separator of an element rule, order and ``~`` kept."""
    sites = F.transform(F.split(strip(before(text, sep)), ","), strip)
    return F.filter(sites, lambda s: s != "")


def anchored_domain(pattern: Column) -> Column:
    """Domain after the first ``||`` that has one; '' or NULL without."""
    return F.when(
        pattern.contains("||"), F.regexp_extract(pattern, fixed.PAT_ANCHORED_DOMAIN, 1)
    )


def extract_domain(pattern: Column, anchored: Column) -> Column:
    """Domain a pattern is about, '' if it names none.

    Tried in order: ``anchored`` (its ``anchored_domain``), the target of a hosts
    row, a dotted name at the start.
    """
    text = strip(pattern)
    bare = F.regexp_replace(text, r"^(?:@@)?(?:\|\|)?", "")
    return F.lower(
        F.when(anchored != "", anchored)
        .when(is_hosts_row(text), strip(F.regexp_extract(text, fixed.PAT_HOSTS, 1)))
        .otherwise(F.regexp_extract(bare, fixed.PAT_DOTTED_DOMAIN, 1))
    )


def key_domain(normalized: Column) -> Column:
    """Domain of two or more labels that a canonical key starts with, else ''."""
    clean = F.ltrim(normalized, F.lit("@"))
    return F.lower(F.regexp_extract(clean, fixed.PAT_KEY_DOMAIN, 1))


def label_count(domain: Column) -> Column:
    return F.length(domain) - F.length(F.translate(domain, ".", "")) + 1


def suffix_sizes(domain: Column, smallest: int) -> Column:
    """Label counts of the strict suffixes of a domain that have >= smallest labels.

    Only numbers are exploded; each suffix is cut from the domain afterwards, so
    a long domain never has all its suffixes in memory at once.
    """
    largest = label_count(domain) - 1
    return F.when(largest >= smallest, F.sequence(F.lit(smallest), largest))


def suffix(domain: Column, labels: Column) -> Column:
    return F.call_function("substring_index", domain, F.lit("."), -labels)

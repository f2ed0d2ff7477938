"""Small text helpers, all plain column expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed


def strip(c: Column) -> Column:
    """Remove Unicode white space at both ends (``trim`` alone knows only spaces)."""
    return F.btrim(c, F.lit(fixed.WHITESPACE))


def strip_left(c: Column) -> Column:
    return F.ltrim(c, F.lit(fixed.WHITESPACE))


def collapse_spaces(c: Column) -> Column:
    """White-space runs become one space; the tests spare most rules the rest."""
    return F.when(
        c.rlike(fixed.PAT_MAYBE_SPACE) & c.rlike(fixed.PAT_ODD_SPACE), F.regexp_replace(c, fixed.PAT_SPACE_RUN, " ")
    ).otherwise(c)


def before(c: Column, sep: str | Column) -> Column:
    """Text before the first ``sep``; the whole text when there is none."""
    pos = F.call_function("instr", c, _lit(sep))
    return F.when(pos > 0, F.substring(c, F.lit(1), pos - 1)).otherwise(c)


def after(c: Column, sep: str | Column) -> Column:
    """Text after the first ``sep``; empty when there is none."""
    pos = F.call_function("instr", c, _lit(sep))
    start = pos + F.char_length(_lit(sep))
    return F.when(pos > 0, F.substring(c, start, F.length(c))).otherwise(F.lit(""))


def starts_with_any(c: Column, prefixes: Iterable[str]) -> Column:
    return reduce(or_, [c.startswith(p) for p in prefixes])


def contains_any(c: Column, parts: Iterable[str]) -> Column:
    return reduce(or_, [c.contains(p) for p in parts])


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``.

    Inside a lambda an outer expression would be evaluated again per element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters and projections refer to but never inline.

    Catalyst copies a column's expression into every filter pushed below it, so a
    long ``when`` chain over a computed text is evaluated and compiled over and
    over. The output of a one-element generator stays a plain column, also above
    a union, whose branches would otherwise each compile the whole chain.
    """
    fields = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(fields)))


def _lit(v: str | Column) -> Column:
    return F.lit(v) if isinstance(v, str) else v

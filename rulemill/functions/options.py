"""Option lists of network rules: ``pattern$option,key=value,...``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import fixed
from .text import after, before, bind, strip


def option_tokens(options: Column) -> Column:
    """Split on commas, except escaped ones and those inside ``/regex/`` values.

    Empty tokens are not returned.
    """
    return F.regexp_extract_all(options, F.lit(fixed.PAT_OPTION), F.lit(0))


def options_valid(options: Column, tokens: Column) -> Column:
    """Is the text after ``$`` an option list? An empty text is, ``,`` is not.

    One token has to be a known name or have a non-blank key before ``=``; ``~``
    in front does not matter. Lines hold no line feed, so it can join tokens.
    """
    return (options == "") | F.array_join(tokens, "\n").rlike(fixed.PAT_VALID_TOKEN)


def options_map(tokens: Column) -> Column:
    """MAP<STRING,STRING>: flags map to NULL, the last of repeated keys wins.

    Sorting by (key, position) finds the last entry of each key in linear space
    and makes the result independent of ``spark.sql.mapKeyDedupPolicy``.
    """

    def entry(token: Column, position: Column) -> Column:
        part = strip(token)
        has_value = part.contains("=")
        return F.struct(
            F.when(has_value, strip(F.substring_index(part, "=", 1))).otherwise(part).alias("key"),
            position.alias("position"),
            F.when(has_value, after(part, "=")).alias("value"),
        )

    named = F.filter(tokens, lambda t: strip(t) != "")

    def last_per_key(entries: Column) -> Column:
        def is_last(e: Column, i: Column) -> Column:
            following = F.try_element_at(entries, (i + 2).cast("int"))
            return following.isNull() | (following["key"] != e["key"])

        return F.filter(entries, is_last)

    kept = bind(F.sort_array(F.transform(named, entry)), last_per_key)
    return F.map_from_entries(F.transform(kept, lambda e: F.struct(e["key"], e["value"])))


def options_text(text: Column) -> Column:
    """Text after the first ``$``; NULL when there is no ``$``."""
    return F.when(text.contains("$"), after(text, "$"))


def pattern_text(text: Column) -> Column:
    return before(text, "$")

"""Merged rules kept up to date from what changed, not merged anew.

``winners`` holds, for one edition, the first rule of each section and key with
its coverage: the columns of a rule, RULE_ID, ``raw_length``, ``key_domain``,
``usual`` and ``covered``. A change takes some sources out (their old rules go)
and brings rules in (of the same sources or others):

* **Winners.** Only keys of a winner that goes or of a rule that comes are
  decided again, among the winner that stays, the rules that come and, where the
  winner goes, the next ones of the sources that stay. The latter are a table of
  candidates by key hash: parsed rules, never parsed again.
* **Coverage.** Only parents that appeared or vanished matter. Rules whose domain
  has a changed parent's domain as a suffix, and new rules, are tested again,
  against the parents on their own suffixes alone: a new parent covers, a parent
  that is gone releases what no other parent covers. All other flags stay.

Every step is an equality join of a delta with a table, so Spark broadcasts the
delta while it is small and shuffles by key hash or domain when it is not. From
an empty table the same steps are a full merge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed
from ..functions.domains import suffix, suffix_sizes
from ..schema import ORDER_KEY
from ..staging import stage
from .dedup import RULE_ID, dedup_exact
from .subsume import COVERED_ID, covered_ids, with_keys

#: What a stored rule has besides its source's place in the registry.
CANDIDATE_COLS = [
    "source", "chunk", "line_no", "raw", "rule_type", "section", "normalized", "domain",
    "key_hash", "raw_length", "key_domain", "usual",
]
#: Columns of the table of winners.
WINNER_COLS = ["priority", "source_ord", *CANDIDATE_COLS, "covered"]
WINNERS = (
    "priority int, source_ord int, source string, chunk bigint, line_no bigint, raw string, rule_type string, section string, "
    "normalized string, domain string, key_hash bigint, raw_length int, key_domain string, usual boolean, covered boolean"
)
_PARENT_ID = [*RULE_ID, "domain"]


def candidates(rules: DataFrame) -> DataFrame:
    """Parsed rules with what merging needs, to be stored once per snapshot of a source."""
    keyed = rules.withColumn("key_hash", F.xxhash64("section", "normalized")).withColumn("raw_length", F.length("raw").cast("int"))
    return with_keys(keyed).select(*CANDIDATE_COLS)


def _can_cover() -> Column:
    return (F.col("section") == fixed.BLOCK) & (F.col("domain") != "") & (F.col("key_domain") != "")


def elect(winners: DataFrame, gone: DataFrame, standing: DataFrame, arriving: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(untouched winners, old rows of touched keys, new rows of touched keys).

    ``gone`` names the sources whose rules leave; ``standing`` and ``arriving``
    are candidates with ``priority`` and ``source_ord`` of the sources that stay
    and of those that come.
    """
    lost = winners.join(gone.select("source"), "source", "left_semi").select(*RULE_ID)
    touched = stage(lost.unionByName(arriving.select(*RULE_ID)).distinct(), "touched")
    old = stage(winners.join(touched, RULE_ID, "left_semi"), "old-winners")
    order = [*ORDER_KEY, *[c for c in CANDIDATE_COLS if c not in ORDER_KEY]]
    open_keys = stage(old.join(gone.select("source"), "source", "left_semi").select(*RULE_ID), "lost")
    contenders = arriving.select(*order).unionByName(old.join(gone.select("source"), "source", "left_anti").select(*order))
    if not open_keys.isEmpty():
        contenders = contenders.unionByName(standing.select(*order).join(open_keys, RULE_ID, "left_semi").select(*order))
    new = stage(dedup_exact(contenders).select(*order), "new-winners")
    return winners.join(touched, RULE_ID, "left_anti"), old, new


def _below(rules: DataFrame, domains: DataFrame) -> DataFrame:
    """COVERED_ID of the rules that have one of the domains above them."""
    # Top-level domains are asked for only if one of them changed.
    short = not domains.filter(~F.col("up").contains(".")).isEmpty()
    return (
        rules.select(*COVERED_ID, "domain", F.explode(suffix_sizes(F.col("domain"), 1 if short else 2)).alias("_n"))
        .withColumn("up", suffix(F.col("domain"), F.col("_n")))
        .join(domains, "up", "left_semi").select(*COVERED_ID).distinct()
    )


def maintain(winners: DataFrame, gone: DataFrame, standing: DataFrame, arriving: DataFrame) -> DataFrame:
    """Winners and their coverage after a change; see ``elect`` for the arguments."""
    untouched, old, new = elect(winners, gone, standing, arriving)
    was = old.select(*_PARENT_ID, F.col("covered").alias("was_covered"))
    fresh = new.join(was, _PARENT_ID, "left").withColumn("covered", F.col("was_covered")).drop("was_covered")
    moved = (
        new.filter(_can_cover()).join(was, _PARENT_ID, "left_anti").select(F.col("domain").alias("up"))
        .unionByName(old.filter(_can_cover()).join(new, _PARENT_ID, "left_anti").select(F.col("domain").alias("up")))
    )
    domains = stage(moved.distinct(), "changed-domains")
    merged = stage(untouched.select(*WINNER_COLS).unionByName(fresh.select(*WINNER_COLS)), "merged", partition_by=["section"])
    blocks = merged.filter(_can_cover())
    again = stage(
        _below(blocks, domains).unionByName(blocks.filter("covered is null").select(*COVERED_ID)).distinct(), "again")
    children = stage(blocks.join(again, COVERED_ID, "left_semi"), "children")
    above = stage(
        children.select("domain", F.explode(suffix_sizes(F.col("domain"), 1)).alias("_n"))
        .select(suffix(F.col("domain"), F.col("_n")).alias("domain")).distinct(), "above")
    parents = stage(blocks.join(above, "domain", "left_semi"), "parents")
    covered = covered_ids(parents, children).select(*COVERED_ID).distinct().withColumn("now", F.lit(True))
    tested = stage(again.join(covered, COVERED_ID, "left").withColumn("now", F.coalesce("now", F.lit(False))), "tested")
    return (
        merged.join(tested, COVERED_ID, "left")
        .withColumn("covered", F.coalesce("now", "covered", F.lit(False))).select(*WINNER_COLS)
    )


def edition_of(winners: DataFrame, max_rule_length: int) -> DataFrame:
    """Rules of the edition: not covered and, at last, not too long."""
    return winners.filter(~F.col("covered") & (F.col("raw_length") <= max_rule_length))

"""Rule lines derived from the driver's tables.

Each corpus exists twice, as a DataFrame here and as SQL in ``oracles.py``. All
have the ``lines`` schema plus ``lite``:

* ``page_lines``: a rule, comment or marker per page, all rule kinds.
* ``syntax_lines``: rarer syntax per page: options, injections, odd markers.
* ``document_lines``: the lines of every document, natural text and duplicates.
* ``bulk_lines``: a domain rule per order line, volume for dedup and coverage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import compute_once
from ..schema import chunk_of
from ..sources.lists import split_lines

COLS = ["source", "priority", "source_ord", "lite", "chunk", "line_no", "line"]
#: Small, so that order is carried over chunk borders even on test data.
CHUNK = 64


def table(spark: SparkSession, sf_dir: str, name: str, spread_by: str | None = None) -> DataFrame:
    """A driver table; ``spread_by`` deals its rows out by a key, so that the
    long steps behind it do not depend on how the file is cut; into as many
    partitions as their volume asks for, so that none has to be spilled."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.repartition(spread_by) if spread_by else df


def _finish(df: DataFrame) -> DataFrame:
    numbered = df.withColumn("line_no", F.col("line_no").cast("bigint"))
    if "chunk" not in df.columns:
        numbered = numbered.withColumn("chunk", chunk_of(F.col("line_no"), CHUNK))
    return (
        compute_once(numbered.withColumnRenamed("line", "_made"), line=F.col("_made"))
        .withColumn("lite", F.col("source_ord") % 3 == 0)
        .withColumn("priority", F.col("priority").cast("int"))
        .withColumn("source_ord", F.col("source_ord").cast("int"))
        .select(*COLS)
    )


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = F.regexp_extract("url", "^[a-z]+://([^/:?#]*)", 1)
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("n"),
        host.alias("host"),
        F.regexp_extract("url", "^[a-z]+://[^/?#]*([^?#]*)", 1).alias("path"),
        F.regexp_replace(host, r"^(www|blog|m)\.", "").alias("apex"),
    )


def _cases(bucket: str, texts: list[str]) -> Column:
    """Text number ``bucket`` of SQL expressions over n, host, path and apex."""
    branches = " ".join(f"WHEN {i} THEN concat({t})" for i, t in enumerate(texts))
    return F.expr(f"CASE {bucket} {branches} END")


PAGE_TEXT = [
    "'||', host, '^'",
    "'0.0.0.0 ', host",
    "'@@||', host, '^'",
    "host, '##.ad'",
    "'||', upper(host), path, '$script,domain=b.com|a.com'",
    "'||', apex, '^'",
    "'z.org,', host, '#@#.ad'",
    "'! note', n",
    "'||ads.', apex, '^$third-party'",
    "'  ||', host, '^  '",
]
SYNTAX_TEXT = [
    "'# hosts comment ', n",
    "'########'",
    "'! ===== section ', n, ' ====='",
    """host, "#%#//scriptlet('x', '", n, "')" """,
    "host, '#$# script:inject(', n, ')'",
    "host, '#$#body { margin: 0 }'",
    "host, '#@$?#div:has(.ad)'",
    "host, '##+js(abort, ', n, ')'",
    """host, '$$div[id="', n, '"]'""",
    "host, '#@$$div'",
    "'||', host, '^$permissions=autoplay=()', char(92), ', camera=(),script'",
    "'|http://', host, '/$/ads|'",
    "'||', host, '^$removeparam=x,~third-party,domain=z.com|a.com'",
    "'||www.', upper(host), '^$match-case,image'",
    "'127.0.0.1   ', host, '   # note ', n",
    "'! Expires: ', n % 7, ' days'",
    "'! Homepage: https://', host, '/'",
    "'! comment ', n",
    "'[Adblock Plus ', n, ']'",
    "'   '",
    "host, '#?#div:has(> .', n, ')'",
    "'z.org, ', host, ' ,~a.org#@#.x'",
    "'/banner/', n, '/*$script,script,image=1,image=2'",
    "'@@||', host, '^$,'",
    "'||www.', host, path, '^'",
    "'||x.www.', host, '/a/', n, '^'",
    "'||', host, '^$replace=/one(, two)?/three/i,media'",
    "'||', host, '^$removeparam=/p,q/,font'",
    "'||', host, '^$replace=/a', char(92), '/b,c/d/,ping'",
]


def page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n")
    source = (n % 5).cast("int")
    rules = _pages(spark, sf_dir).select(
        F.concat(F.lit("list"), source).alias("source"),
        (source + 1).alias("priority"), source.alias("source_ord"), n.alias("line_no"),
        _cases("floor(n / 5) % 10", PAGE_TEXT).alias("line"),
    )
    heads = (
        rules.select("source", "priority", "source_ord").distinct()
        .select("*", F.lit(-1).alias("line_no"), F.lit("! Title: List Collection").alias("line"))
    )
    return _finish(rules.unionByName(heads))


def syntax_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n")
    source = (F.floor(n / len(SYNTAX_TEXT)) % 4).cast("int")
    return _finish(
        _pages(spark, sf_dir).select(
            F.concat(F.lit("syntax"), source).alias("source"),
            (source + 2).alias("priority"), (source + 5).alias("source_ord"), n.alias("line_no"),
            _cases(f"n % {len(SYNTAX_TEXT)}", SYNTAX_TEXT).alias("line"),
        )
    )


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document is a chunk of its source; ``line_no`` counts in it."""
    number = F.regexp_extract("source", r"(\d+)$", 1).cast("int")
    return _finish(
        table(spark, sf_dir, "documents", "doc_id")
        .select("source", number.alias("number"), F.col("doc_id").alias("chunk"), F.posexplode(split_lines(F.col("text"))).alias("line_no", "line"))
        .select(
            "source", (F.col("number") + 1).alias("priority"), (F.col("number") + 9).alias("source_ord"), "chunk", "line_no", "line",
        )
    )


def bulk_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated (order, line) numbers only meet in rules that are equal throughout."""
    part = F.when(F.col("l_partkey") % 10 == 0, "").otherwise(
        F.concat(F.lit("p"), F.col("l_partkey"), F.lit("."))
    )
    zone = F.when(F.col("l_suppkey") % 3 == 0, ".example.com^").otherwise(".example.net^")
    turn = (F.col("l_linenumber") % 4).cast("int")
    return _finish(
        table(spark, sf_dir, "lineitem", "l_orderkey").select(
            F.concat(F.lit("bulk"), turn).alias("source"),
            (turn + 1).alias("priority"), (turn + 40).alias("source_ord"),
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line_no"),
            F.concat(F.lit("||"), part, F.lit("s"), F.col("l_suppkey"), zone).alias("line"),
        )
    )


def rule_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_lines(spark, sf_dir).unionByName(syntax_lines(spark, sf_dir))


def all_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        rule_lines(spark, sf_dir)
        .unionByName(document_lines(spark, sf_dir))
        .unionByName(bulk_lines(spark, sf_dir))
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry of sources: one entry per supplier."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"),
        F.concat(F.lit("https://lists.example/"), key, F.lit(".txt")).alias("url"),
        F.col("s_nationkey").alias("priority"),
        F.when(key % 4 != 0, F.col("s_acctbal") > 4000).alias("lite"),
        F.when(key % 5 != 0, key % 7 != 3).alias("enabled"),
        key.cast("int").alias("source_ord"),
    )

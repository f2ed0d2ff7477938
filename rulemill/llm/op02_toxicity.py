"""Toxicity scores by weak supervision.

1. Voters. Words and word beginnings (``PREFIXES`` letters) that stand out in
   toxic training texts form the lexicon: those whose log-likelihood ratio
   passes ``P_VALUE`` after correction for all tokens tried, the ``LEXICON`` with
   the largest ratios at most. That bound is the number of features of the
   classifier, whose matrix of ``TRAINING_ROWS`` rows is on the driver (34 MB);
   it is the same at every size of the corpus. A token is strong
   if ``STRONG`` of the texts with it are toxic. ``WORD_VOTERS`` voters share the
   strong words and ``PATTERN_VOTERS`` the strong beginnings, by rank, so each
   votes on its own evidence; further voters want several weak tokens, look at
   how densely the lexicon is hit, at addressed insults, and at shouting.
2. Label model. Every text of the corpus gets a vote pattern; patterns are
   counted by Spark (2**voters at most). A generative model of the class, the
   accuracy of each voter and the correlations is fitted to the counts by EM:
   voters whose votes are still correlated within a class are put in one block
   (of ``BLOCK`` at most) with a joint table, blocks are independent.
3. Classifier. A logistic regression on lexicon hits is trained on the model's
   posteriors of at most ``TRAINING_ROWS`` texts and scores every text.

Labels come only from rows whose crc32(doc_id) mod 3 is not 1, at most
``LABELLED_ROWS`` of them (smallest hashes). Both samples are first cut to a
share of the hashes that holds about twice the rows wanted, so the sort that
follows sees a bounded number of rows however many partitions there are. Labels, lang, source and doc_id are
no inputs of a score. Counts of vote patterns cover the whole corpus.

Cases: a null or empty text is scored like a text without hits; several labels
of one doc_id count as toxic if one says so; repeated rows get the same score
and count once among the training rows; a null doc_id has no label, is not held
out and is no training row; a text of any length is scored whole; without toxic training rows
every score is the base rate; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..staging import stage
from .textbytes import slices

LABELLED_ROWS = 12_000
TRAINING_ROWS = 20_000
LEXICON = 400
PREFIXES = (4, 5, 6, 7)
P_VALUE = 0.05
STRONG = 0.9
WORD_VOTERS, PATTERN_VOTERS = 4, 4
BLOCK = 3
THRESHOLD = 0.7

_WORD = re.compile(r"[^\W\d_]+")
_ADDRESSED = re.compile(r"\b(?:you|your|he|she|they|is|are)\b(?: an?| such an?| the)? (\w+)", re.I)
VOTERS = WORD_VOTERS + PATTERN_VOTERS + 5


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _place(purpose: str) -> Column:
    """A number from 0 to 1 by hash of doc_id."""
    return F.xxhash64("doc_id", F.lit(purpose)).cast("double") / 2.0**64 + 0.5


def lowest(rows: DataFrame, purpose: str, bound: int, value: Column) -> DataFrame:
    """doc_id and ``value`` of the ``bound`` ids with the smallest hashes.

    ``value``, an aggregate, makes one row of an id. Ids are counted first; a
    share of them goes on, twice the rows wanted, and only those are sorted.
    """
    known = rows.filter("doc_id is not null")
    ids = known.agg(F.approx_count_distinct("doc_id", 0.02)).first()[0]
    share = min(1.0, 2.0 * bound / max(ids, 1))
    few = known.withColumn("_place", _place(purpose)).filter(F.col("_place") <= share)
    one = few.groupBy("doc_id", "_place").agg(value.alias("value"))
    return one.orderBy("_place", "doc_id").limit(bound).select("doc_id", "value")


def tokens(text: str) -> set[str]:
    """Distinct words and marked word beginnings of a text."""
    found = set(_WORD.findall(text.lower()))
    return found | {w[:n] + "*" for w in found for n in PREFIXES if len(w) > n}


# Lexicon


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        toxic = batch.column("toxic").to_pylist()
        for part in slices(batch.column("text")):
            by_class = (Counter(), Counter())
            for i in range(part.hi - part.lo):
                by_class[toxic[part.lo + i]].update(tokens(part.text(i).decode("utf-8", "replace")))
            seen = list(by_class[0].keys() | by_class[1].keys())
            yield pa.RecordBatch.from_arrays([
                pa.array(seen, pa.string()), pa.array([by_class[1][t] for t in seen], pa.int64()), pa.array([by_class[0][t] for t in seen], pa.int64()),
            ], names=["token", "toxic", "clean"])


def lexicon(labelled: DataFrame) -> tuple[list[tuple[str, bool]], float]:
    """(text, toxic) of the bounded sample -> tokens by rank and if they are strong; share of toxic rows."""
    n = labelled.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    if not n.toxic or n.toxic == n.n:
        return [], (n.toxic + 0.5) / (n.n + 1)
    base = n.toxic / n.n
    counts = stage(
        labelled.mapInArrow(_count, "token string, toxic long, clean long").groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")),
        "token-counts",
    )
    tried = counts.count()
    seen = F.col("toxic") + F.col("clean")
    part = lambda x, share: F.when(x == 0, 0.0).otherwise(x * F.log(x / (seen * share)))
    ratio = part(F.col("toxic"), base) + part(F.col("clean"), 1 - base)
    best = (
        counts.withColumn("ratio", ratio)
        .filter((F.col("ratio") > math.log(tried / P_VALUE)) & (F.col("toxic") > F.col("clean")))
        .orderBy(F.desc("ratio"), "token").limit(LEXICON).select("token", (F.col("toxic") >= STRONG * seen).alias("strong")).collect()
    )
    return [(row.token, row.strong) for row in best], base


# Votes and features


FEATURES = "doc_id long, votes int, n_words long, strong long, weak long, hits array<int>, times array<int>"


def _features(lexicon_: list[tuple[str, bool]]):
    index = {token: i for i, (token, _) in enumerate(lexicon_)}
    strong = [is_strong for _, is_strong in lexicon_]
    voter: dict[int, int] = {}
    for pattern, voters, first in ((False, WORD_VOTERS, 0), (True, PATTERN_VOTERS, WORD_VOTERS)):
        for rank, i in enumerate(i for t, i in index.items() if strong[i] and t.endswith("*") == pattern):
            voter[i] = first + rank % voters
    starts = [(n, {t[:-1]: i for t, i in index.items() if t.endswith("*") and len(t) == n + 1}) for n in PREFIXES]
    full = {t: i for t, i in index.items() if not t.endswith("*")}
    extra = WORD_VOTERS + PATTERN_VOTERS

    def lookup(distinct: set[str]) -> dict[str, list[int]]:
        """Tokens of each word that has some."""
        found: dict[str, list[int]] = {w: [full[w]] for w in distinct & full.keys()}
        for n, known in starts:
            if known:
                for w in distinct:
                    at = known.get(w[:n]) if len(w) > n else None
                    if at is not None:
                        found.setdefault(w, []).append(at)
        return found

    def judge(text: str) -> tuple[int, int, int, int, list[int], list[int]]:
        found = _WORD.findall(text.lower())
        known = lookup(set(found))
        vote, totals, times = 0, [0, 0], Counter()
        if known:
            for w in found:
                if w in known:
                    totals[any(strong[i] for i in known[w])] += 1
                    times.update(known[w])
            for i in times:
                if i in voter:
                    vote |= 1 << voter[i]
            vote |= (totals[0] >= 2) << extra
            vote |= (totals[0] * 60 >= len(found) and totals[0] >= 2) << extra + 1
            vote |= (sum(totals) * 60 >= len(found)) << extra + 2
            vote |= any(m.lower() in known for m in _ADDRESSED.findall(text)) << extra + 3
        vote |= (text.count("!") * 40 > len(found) > 0) << extra + 4
        return vote, len(found), totals[1], totals[0], list(times), list(times.values())

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
        for batch in batches:
            for part in slices(batch.column("text")):
                rows = [judge(part.text(i).decode("utf-8", "replace")) for i in range(part.hi - part.lo)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(part.lo, len(rows)), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))],
                    names=["doc_id", "votes", "n_words", "strong", "weak", "hits", "times"],
                )

    return features


# Label model


def blocks_of(fired: np.ndarray, weight: np.ndarray, posterior: np.ndarray, size: int = BLOCK) -> list[list[int]]:
    """Voters that stay correlated within the classes, in blocks of bounded size."""
    residual = np.zeros((fired.shape[1],) * 2)
    for p in (posterior, 1 - posterior):
        w = weight * p
        if w.sum() > 0:
            mean = (w[:, None] * fired).sum(0) / w.sum()
            centred = fired - mean
            spread = np.sqrt((w[:, None] * centred**2).sum(0) / w.sum()) + 1e-9
            residual = np.maximum(residual, np.abs((centred * w[:, None]).T @ centred / w.sum()) / np.outer(spread, spread))
    blocks = [[j] for j in range(fired.shape[1])]
    pairs = sorted(((residual[a, b], a, b) for a in range(len(residual)) for b in range(a)), reverse=True)
    for strength, a, b in pairs:
        if strength < 0.1:
            break
        one, other = (next(x for x in blocks if v in x) for v in (a, b))
        if one is not other and len(one) + len(other) <= size:
            blocks.remove(other)
            one.extend(other)
    return blocks


def label_model(patterns: np.ndarray, counts: np.ndarray, known: np.ndarray, base: float, rounds: int = 60) -> np.ndarray:
    """Posterior of the toxic class of each vote pattern.

    ``known`` has labelled rows per pattern and class (clean, toxic); they start
    the model and weigh as prior counts, so classes keep their meaning.
    """
    fired = (patterns[:, None] >> np.arange(VOTERS) & 1).astype(float)
    weight = counts.astype(float)
    share = (known[:, 1] + base) / (known.sum(1) + 1)
    blocks = [[j] for j in range(VOTERS)]
    prior = base
    for turn in range(rounds):
        if turn == rounds // 2:
            blocks = blocks_of(fired, weight, share)
        log_odds = np.full(len(patterns), math.log(prior / (1 - prior)))
        for block in blocks:
            code = sum(((patterns >> v) & 1) << i for i, v in enumerate(block))
            tables = []
            for label, p in ((0, 1 - share), (1, share)):
                table = np.bincount(code, weight * p + known[:, label], minlength=1 << len(block)) + 0.5 / (1 << len(block))
                tables.append(np.log(table / table.sum()))
            log_odds += tables[1][code] - tables[0][code]
        share = 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))
        prior = float(np.clip((weight * share).sum() / weight.sum(), base / 4, min(base * 4, 0.5)))
    return share


# Classifier


def design(rows: dict, n: int) -> np.ndarray:
    """Votes, token counts and densities of some rows as a matrix."""
    votes, n_words, strong, weak = (np.asarray(rows[c]) for c in ("votes", "n_words", "strong", "weak"))
    x = np.zeros((len(votes), n + VOTERS + 4), np.float32)
    for i, (hits, times) in enumerate(zip(rows["hits"], rows["times"])):
        if len(hits):
            x[i, hits] = np.log1p(times)
    x[:, n:n + VOTERS] = votes[:, None] >> np.arange(VOTERS) & 1
    for j, total in ((-4, strong), (-2, weak)):
        x[:, j] = np.log1p(total)
        x[:, j + 1] = np.log1p(100 * total / np.maximum(n_words, 1))
    return x


def fit_linear(x: np.ndarray, y: np.ndarray, rounds: int = 400, ridge: float = 1e-4) -> np.ndarray:
    """Logistic regression on soft labels by accelerated gradient descent."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    # Step from the largest curvature a row can have.
    step = 4.0 / float((x**2).sum(1).max())
    w = np.zeros(x.shape[1])
    ahead = w.copy()
    for t in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30)))
        new = ahead - step * (x.T @ (p - y) / len(x) + ridge * ahead)
        ahead = new + t / (t + 3) * (new - w)
        w = new
    return w


def _scores(n: int, weights: np.ndarray):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                some = batch.slice(lo, 2000)
                z = design(some.to_pydict(), n) @ weights[:-1] + weights[-1]
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))), pa.float64())], names=["doc_id", "score"])

    return score


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    usable = labels.filter(F.col("toxic").isNotNull() & ~held_out())
    toxic = F.max((F.col("toxic") > 0).cast("int"))
    chosen = stage(lowest(usable.select("doc_id", "toxic"), "labelled", LABELLED_ROWS, toxic).withColumnRenamed("value", "toxic"), "labelled-ids")
    # At most LABELLED_ROWS narrow rows go to every task.
    labelled = stage(docs.select("doc_id", "text").filter("text is not null").join(F.broadcast(chosen), "doc_id").select("text", "toxic"), "labelled")
    names, base = lexicon(labelled)
    seen = stage(docs.select("doc_id", "text").mapInArrow(_features(names), FEATURES), "votes")

    def result(scored: DataFrame) -> DataFrame:
        return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

    if not names:
        return result(seen.withColumn("score", F.lit(base)))
    known = seen.join(F.broadcast(chosen), "doc_id", "left")
    table = known.groupBy("votes").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("toxic") == 0).alias("clean"), F.count_if(F.col("toxic") == 1).alias("toxic"),
    ).orderBy("votes").toPandas()
    patterns = table["votes"].to_numpy()
    posterior = label_model(patterns, table["n"].to_numpy(), table[["clean", "toxic"]].to_numpy(float), base)
    row = F.min(F.struct("votes", "n_words", "strong", "weak", "hits", "times"))
    sample = lowest(seen.filter(~held_out()), "training", TRAINING_ROWS, row).select("value.*").toArrow().to_pydict()
    x = design(sample, len(names))
    y = posterior[np.searchsorted(patterns, sample["votes"])]
    return result(seen.mapInArrow(_scores(len(names), fit_linear(x, y)), "doc_id long, score double"))

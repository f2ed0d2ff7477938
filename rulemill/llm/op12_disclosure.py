"""Personal data by pattern, and terms that give it away by co-occurrence.

**Base spans**: e-mail addresses, IP addresses, card numbers, phone numbers.
The patterns below match what the plain ones match, written so that a long text
takes linear time: loops that never need to give back are possessive, and a run
of characters is tried from its start only (or from the end of the match before).

**Disclosing terms** (information-theoretic sanitisation). A protected entity e
is a base value; a mention's context is the ``CONTEXT_WORDS`` words on either
side. Over the whole corpus, of N words,

    PMI(t; e) = log(n(t, e) N / (n(t) n(e)))     IC(e) = log(N / n(e))

PMI / IC is the share of an entity's information that the term alone gives: 1 if
the term never stands anywhere else. From ``DISCLOSE`` on a term is generalised
(replaced by the kind of the entity it points to), from ``REMOVE`` on it is
removed, wherever it stands, if at least ``EVIDENCE`` mentions show it.

All of it is DataFrame functions. Contexts grow with the mentions, never with
their pairs. Words are counted for terms of a context only: a bit map of hashed
terms (65,536 rows of 64 bits, whatever the data) is broadcast and leaves few
others; the joins behind it are exact. Texts are shuffled only for documents
that the same kind of bit map of document keys lets through.

Input: ``doc_id``, ``text``; other columns are ignored. Null and empty texts
hold nothing. Rows equal in doc_id and text have the same result, each its own
row. Offsets count code points. A term inside a base span is no span of its own.
Running sums and texts with many spans are put together in chunks of the square
root of their number. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import compute_once
from ..staging import stage

KINDS = ("email", "ip", "card", "phone", "term")
TERM_KIND = KINDS.index("term")
PATTERNS = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
#: What a text must hold to be worth matching.
SIGNS = ("@", ".", "", "+")

LETTER = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM_LETTERS = 3
CONTEXT_WORDS = 5
CONTEXT_CHARS = 100
EVIDENCE = 3
DISCLOSE = 0.95
REMOVE = 0.98
_SLOTS = 1 << 16

SPANS = "array<struct<kind: int, start: bigint, end: bigint, value: string, before: string, after: string>>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _chunks(values: Column) -> Column:
    """An array cut into arrays of the square root of its size."""
    n = F.size(values)
    c = F.greatest(F.ceil(F.sqrt(n)), F.lit(1)).cast("int")
    return _let(c, lambda c: F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(n / c).cast("int") - 1, F.lit(0))), lambda i: F.slice(values, i * c + 1, c)))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, v: a + v)


def running_sums(values: Column) -> Column:
    """Sum of each element and those before it."""

    def from_chunks(chunks: Column) -> Column:
        return _let(F.transform(chunks, _sum), lambda sums: F.flatten(F.transform(chunks, lambda chunk, i: _let(
            _sum(F.slice(sums, F.lit(1), i)),
            lambda base: F.transform(chunk, lambda _, j: base + _sum(F.slice(chunk, F.lit(1), j + 1)))))))

    return _let(values, lambda v: _let(_chunks(v), from_chunks))


def matches(text: Column, pattern: Column, kind: int) -> Column:
    """All matches as SPANS: the texts between them and the matches give the places."""

    def placed(pieces: Column, found: Column) -> Column:
        ends = running_sums(F.transform(found, lambda v, i: (F.length(F.get(pieces, i)) + F.length(v)).cast("bigint")))
        return _let(ends, lambda ends: F.transform(found, lambda v, i: F.struct(
            F.lit(kind).alias("kind"), (F.get(ends, i) - F.length(v)).alias("start"), F.get(ends, i).alias("end"), v.alias("value"),
            F.right(F.get(pieces, i), F.lit(CONTEXT_CHARS)).alias("before"), F.left(F.get(pieces, i + 1), F.lit(CONTEXT_CHARS)).alias("after"))))

    spans = _let(F.split(text, pattern, -1), lambda pieces: _let(
        F.regexp_extract_all(text, pattern, F.lit(0)), lambda found: placed(pieces, found)))
    return F.when(F.rlike(text, pattern), spans).otherwise(F.array()).cast(SPANS)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def step(total: Column, i: Column) -> Column:
        d = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def _valid(kind: int, value: Column) -> Column:
    if kind == 1:
        return F.forall(F.split(value, r"\."), lambda p: _let(
            F.ltrim(p, F.lit("0")), lambda q: (F.length(q) <= 3) & (F.coalesce(q.try_cast("int"), F.lit(0)) <= 255)))
    if kind == 2:
        return _let(_digits(value), lambda d: F.when(F.length(d).between(13, 19), _luhn(d)).otherwise(False))
    if kind == 3:
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, document key, base spans with their contexts, by kind and place."""
    text = F.coalesce("text", F.lit(""))

    def of_kind(kind: int) -> Column:
        found = F.filter(matches(text, F.lit(PATTERNS[kind]), kind), lambda s: _valid(kind, s["value"]))
        return F.when(F.contains(text, F.lit(SIGNS[kind])), found).otherwise(F.array().cast(SPANS))

    return docs.select("doc_id", *document_key(), F.concat(*[of_kind(k) for k in range(len(PATTERNS))]).alias("base"))


def document_key() -> list[Column]:
    """128 bits that tell rows of different doc_id or text apart."""
    text = F.coalesce("text", F.lit(""))
    return [F.xxhash64("doc_id", text).alias("key"), F.xxhash64(F.lit("second"), text, "doc_id").alias("key2")]


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(LETTER + "{" + str(TERM_LETTERS) + ",}"), F.lit(0))


def _context_terms(span: Column) -> Column:
    """Distinct words next to a mention; one that the context cuts is left out."""
    def whole(text: Column, cut_first: bool) -> Column:
        edge = f"^{LETTER}+" if cut_first else f"{LETTER}+$"
        return _terms(F.when(F.length(text) == CONTEXT_CHARS, F.regexp_replace(text, edge, "")).otherwise(text))

    before = _let(whole(span["before"], True), lambda w: F.slice(w, F.greatest(F.size(w) - CONTEXT_WORDS + 1, F.lit(1)), F.lit(CONTEXT_WORDS)))
    return F.array_distinct(F.concat(before, F.slice(whole(span["after"], False), 1, CONTEXT_WORDS)))


def mention_terms(base: DataFrame) -> DataFrame:
    """(entity, kind, term, n): mentions of an entity next to a term; the empty term counts all its mentions."""
    value = F.col("s.value")
    kind = F.col("s.kind")
    name = F.when(kind >= 2, _digits(value)).otherwise(F.translate(value, UPPER, LOWER))
    return (
        base.select(F.explode("base").alias("s"))
        .select(F.xxhash64(kind, name).alias("entity"), kind.alias("kind"), F.explode(F.concat(F.array(F.lit("")), _context_terms(F.col("s")))).alias("term"))
        .groupBy("entity", "kind", "term").agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= EVIDENCE)
    )


def _slot(hashed: Column) -> tuple[Column, Column]:
    return F.pmod(hashed, F.lit(_SLOTS)).cast("int"), F.pmod(F.shiftright(hashed, 16), F.lit(64)).cast("int")


def _bit_map(hashes: DataFrame) -> DataFrame:
    """A bit per hash: at most ``_SLOTS`` rows, so broadcasting it is bounded."""
    slot, bit = _slot(F.col("h"))
    return hashes.select(slot.alias("_slot"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("_bit")).groupBy("_slot").agg(F.bit_or("_bit").alias("_bits"))


def _marked(rows: DataFrame, hashed: Column, bits: DataFrame) -> DataFrame:
    """Adds ``_in``: can the row's hash be one of the bit map's?"""
    slot, bit = _slot(hashed)
    there = F.call_function("shiftright", F.coalesce("_bits", F.lit(0).cast("bigint")), bit).bitwiseAND(F.lit(1).cast("bigint")) == 1
    return rows.withColumn("_at", slot).join(F.broadcast(bits), F.col("_at") == F.col("_slot"), "left").withColumn("_in", there).drop("_at", "_slot", "_bits")


def disclosing_terms(docs: DataFrame, base: DataFrame) -> DataFrame:
    """(term, kind, share): terms that give at least ``DISCLOSE`` of an entity's information."""
    seen = stage(mention_terms(base), "mentions")
    candidates = stage(seen.filter("term <> ''").select("term").distinct(), "candidates")
    bits = stage(_bit_map(candidates.select(F.xxhash64("term").alias("h"))), "term-bits")
    said = docs.select(F.explode(_terms(F.col("text"))).alias("term"))
    # Words that are no candidate are counted together, for N.
    counted = stage(
        _marked(said, F.xxhash64("term"), bits).select(F.when(F.col("_in"), F.col("term")).alias("term"))
        .groupBy("term").agg(F.count(F.lit(1)).alias("n_term")), "term-counts")
    total = counted.agg(F.sum("n_term")).first()[0] or 0
    entities = stage(seen.filter("term = ''").select("entity", "kind", F.col("n").alias("n_entity")), "entities")
    both = seen.filter("term <> ''").join(counted, "term").join(entities, ["entity", "kind"])
    information = F.ln(F.lit(float(total)) / F.col("n_entity"))
    pmi = F.ln(F.least("n", "n_term") * F.lit(float(total)) / (F.col("n_term") * F.col("n_entity")))
    return (
        both.filter(F.col("n_entity") < total).withColumn("share", pmi / information)
        .filter(F.col("share") >= DISCLOSE)
        .groupBy("term").agg(F.max(F.struct("share", -F.col("kind"))).alias("best"))
        .select("term", (-F.col("best.col2")).alias("kind"), F.col("best.share").alias("share"))
    )


def term_spans(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(key, key2, found): places of the terms in the documents that hold any."""
    key = document_key()
    bits = stage(_bit_map(terms.select(F.xxhash64("term").alias("h"))), "disclosing-bits")
    said = docs.select(*key, F.explode(F.array_distinct(_terms(F.col("text")))).alias("term"))
    held = _marked(said, F.xxhash64("term"), bits).filter("_in").select("key", "key2", "term").join(terms, "term")
    hits = stage(held.groupBy("key", "key2").agg(F.collect_set(F.struct("term", "kind", "share")).alias("terms")), "hits")
    # Texts go on only if they can be among those hit.
    some = _marked(docs.select("text", *key), F.col("key"), stage(_bit_map(hits.select(F.col("key").alias("h"))), "hit-bits"))
    some = some.filter("_in").drop("_in").dropDuplicates(["key", "key2"]).join(hits, ["key", "key2"])
    pattern = F.concat(
        F.lit(f"(?<!{LETTER})(?:"), F.array_join(F.transform("terms", lambda t: t["term"]), "|"), F.lit(f")(?!{LETTER})"))
    listed = F.map_from_entries(F.transform("terms", lambda t: F.struct(t["term"], F.struct(t["kind"].alias("kind"), t["share"].alias("share")))))
    some = compute_once(some.select("key", "key2", "text", pattern.alias("pattern"), listed.alias("listed")), lowered=F.translate("text", UPPER, LOWER))
    return some.select("key", "key2", F.transform(matches(F.col("lowered"), F.col("pattern"), TERM_KIND), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.element_at("listed", s["value"])["kind"].alias("about"),
        F.element_at("listed", s["value"])["share"].alias("share"))).alias("found"))


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, key, key2 and ``spans`` (kind, start, end, about, share) of every row.

    ``about`` is the kind of the entity: for a term, of the one it discloses most
    of; ``share`` is null for base spans.
    """
    base = stage(base_spans(docs.select("doc_id", "text")), "base-spans")
    terms = stage(disclosing_terms(docs, base), "disclosing")
    found = stage(term_spans(docs.select("doc_id", "text"), terms), "term-spans")
    joined = base.join(found, ["key", "key2"], "left")
    plain = F.transform("base", lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("about"), F.lit(None).cast("double").alias("share")))
    free = F.filter(F.coalesce("found", F.array()), lambda t: ~F.exists("base", lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))
    added = F.transform(free, lambda t: F.struct(
        F.lit(TERM_KIND).alias("kind"), t["start"].alias("start"), t["end"].alias("end"), t["about"].alias("about"), t["share"].alias("share")))
    return joined.select("doc_id", "key", "key2", F.concat(plain, added).alias("spans"))


def _placeholder(span: Column) -> Column:
    name = F.element_at(F.array(*[F.lit(k) for k in KINDS]), span["about"] + 1)
    return (
        F.when(span["share"].isNull(), F.concat(F.lit("["), name, F.lit("]")))
        .when(span["share"] >= REMOVE, F.lit("")).otherwise(F.concat(F.lit("[~"), name, F.lit("]")))
    )


def sanitised(docs: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id, text with every span of ``personal_data`` replaced; overlapping spans become one."""
    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), _placeholder(s).alias("to"))))
    rows = docs.select("doc_id", "text", *document_key()).join(
        found.select("key", "key2", "spans").dropDuplicates(["key", "key2"]), ["key", "key2"], "left")
    rows = compute_once(rows, cut=_chunks(ordered))
    rows = compute_once(rows, upto=F.transform("cut", lambda chunk: F.coalesce(F.array_max(F.transform(chunk, lambda s: s["end"])), F.lit(0).cast("bigint"))))
    text = F.coalesce("text", F.lit(""))

    def chunk_text(chunk: Column, i: Column) -> Column:
        start = F.coalesce(F.array_max(F.slice("upto", F.lit(1), i)), F.lit(0).cast("bigint"))
        return _let(start, lambda start: _let(
            F.substring(text, (start + 1).cast("int"), F.greatest(F.get("upto", i) - start, F.lit(0)).cast("int")),
            lambda part: F.aggregate(
                chunk, F.struct(start.alias("at"), F.lit("").alias("out")),
                lambda a, s: F.struct(
                    F.greatest(a["at"], s["end"]).alias("at"),
                    F.when(s["start"] < a["at"], a["out"]).otherwise(
                        F.concat(a["out"], F.substring(part, (a["at"] - start + 1).cast("int"), (s["start"] - a["at"]).cast("int")), s["to"])).alias("out")),
                lambda a: a["out"])))

    last = F.coalesce(F.array_max("upto"), F.lit(0).cast("bigint"))
    done = F.concat(F.array_join(F.transform("cut", chunk_text), ""), F.substring(text, (last + 1).cast("int"), F.length(text)))
    return rows.select("doc_id", F.when(F.col("text").isNotNull(), done).alias("text"))


def _listing(spans: Column) -> Column:
    """kind:start:end by kind, then start, comma-joined."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))))
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.element_at(name, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(found: DataFrame) -> DataFrame:
    """doc_id, counts of base spans, digest of the base spans, all spans."""
    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{KINDS[kind]}")

    return found.select(
        "doc_id", *[count(k) for k in range(len(PATTERNS))],
        F.sha2(_listing(F.filter("spans", lambda s: s["kind"] != TERM_KIND)).cast("binary"), 256).alias("base_sha256"),
        _listing(F.col("spans")).alias("spans"),
    )

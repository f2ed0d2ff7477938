import random
import re

import pytest
from pyspark.sql import functions as F

from rulemill.operators import dedup, subsume
from rulemill.operators.carry import carry, number_rows
from rulemill.operators.parse import parse_rules
from rulemill.plans import editions

LABEL = r"[a-zA-Z0-9](?:[a-zA-Z0-9-]*[a-zA-Z0-9])?"


def first_by_priority(rows):
    best = {}
    for r in sorted(rows, key=lambda r: (r.priority, r.source_ord, r.chunk, r.line_no)):
        best.setdefault((r.section, r.normalized), r)
    return best


def key_domain(key):
    m = re.match(rf"\|*({LABEL}(?:\.{LABEL})+)", key.lstrip("@"))
    return m[1].lower() if m else ""


def covers(parent, child):
    """The definition, on (domain, key) pairs."""
    (p_domain, p), (c_domain, c) = parent, child
    p_name, c_name = key_domain(p), key_domain(c)
    if p == c or not p_name or not c_name or not c_domain.endswith("." + p_domain):
        return False
    p, c = p.lstrip("@"), c.lstrip("@")
    path = "||" in p and "||" in c and "^" in p[2:] and c[2:].startswith(p[2:].split("^")[0] + "/")
    return c_name.endswith("." + p_name) or path


def random_rules(seed, n):
    rnd = random.Random(seed)
    names = ["a", "b", "www", "ads", "x-1"]
    tails = ["example.com", "example.net", "co.uk", "com", "0.0.0.0", "0.0"]
    shapes = [
        "||{d}^", "||{d}^$script", "||{d}/{p}", "||{d}/{p}^", "{d}", "{d}/{p}^", "0.0.0.0 {d}", "127.0.0.1 {d}",
        "{d}||{e}^", "@||{d}^", "|www.|{d}^||{e}", "xx{d}^||{e}", "||{d}^$domain=a||b", "|||{d}^", "||{d}:80/{p}",
        "||WWW.{d}^$match-case", "||{D}/{p}^",
    ]

    def domain():
        return ".".join(rnd.choice(names) for _ in range(rnd.randint(0, 3))) or rnd.choice(names)

    out = []
    for _ in range(n):
        d, e = (f"{domain()}.{rnd.choice(tails)}" if rnd.random() < 0.8 else rnd.choice(tails) for _ in range(2))
        out.append(rnd.choice(shapes).format(d=d, e=e, D=d.upper(), p=rnd.choice(["p", "p/q", "q/", ""])))
    return "\n".join(out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_merge_against_brute_force(make_lines, seed):
    lines = make_lines({f"s{i}": (i % 2, random_rules(seed * 10 + i, 250)) for i in range(3)}, 16)
    rules = parse_rules(lines)
    rows = rules.collect()
    exact = dedup.dedup_exact(rules)
    best = first_by_priority(rows)
    same = {(r.section, r.normalized): (r.source, r.line_no) for r in exact.collect()}
    assert same == {k: (r.source, r.line_no) for k, r in best.items()}

    blocks = [r for (section, _), r in best.items() if section == "block" and r.domain]
    pairs = [(r.domain, r.normalized) for r in blocks]
    covered = {c[1] for c in pairs if any(covers(p, c) for p in pairs)}
    kept = {r.normalized for r in subsume.dedup_subsumed(exact).filter("section = 'block'").collect()}
    everything = {k for s, k in best if s == "block"}
    assert covered and kept == everything - covered
    assert {r.normalized for r in subsume.covered_rules(exact).collect()} == covered

    order = {r.normalized: (r.priority, r.source_ord, r.chunk, r.line_no) for r in blocks}
    want = {
        c[1]: min((-len(p[0]), order[p[1]], p[1]) for p in pairs if covers(p, c))[2]
        for c in pairs if c[1] in covered
    }
    got = {r.child: r.parent for r in subsume.covering_parents(exact).collect()}
    assert got == want


def test_broader_pair(spark):
    cases = [
        ("||shop.test^", "||cdn.eu.shop.test^", True),
        ("||shop.test^$image", "||shop.test/banner/7.gif$script", True),
        ("||shop.test^", "||workshop.test^", False),
        ("||shop.test/pixel", "||shop.test/pixel/2", False),
        ("||eu.shop.test^", "||shop.test^", False),
        ("@@||shop.test^", "@@||cdn.shop.test^", True),
        ("||a.com/x.js$script", "||b.a.com^", True),
        ("0.0.0.0 a.com", "0.0.0.0 b.a.com", False),
    ]
    df = spark.createDataFrame([c[:2] for c in cases], "p string, c string")
    got = [r[0] for r in df.select(subsume.is_broader(F.col("p"), F.col("c"))).collect()]
    assert got == [c[2] for c in cases]


def test_unusual_parent_on_a_top_level_domain(make_lines):
    """Only a parent that is named by one label makes rules ask for one."""
    odd = "|https://*.net/||net^"
    rules = "\n".join(["||net^", odd, "||x.y.net^", "||x.y.net/a", "||" + "a." * 4000 + "net^", "||q.org^"])
    exact = dedup.dedup_exact(parse_rules(make_lines({"s": (1, rules)})))
    rows = exact.collect()
    blocks = [(r.domain, r.normalized) for r in rows if r.domain]
    want = {c[1] for c in blocks if any(covers(p, c) for p in blocks)}
    assert {r.normalized for r in subsume.covered_rules(exact).collect()} == want


def test_merge_stages_only_what_is_asked_for(make_lines):
    exact = dedup.dedup_exact(parse_rules(make_lines({"s": (1, "||a.com^\n||b.a.com^\n")})))
    needed = {"key_hash", "normalized", "section", "domain", "key_domain", "usual"}
    assert set(subsume.prepare(exact, ["source"]).columns) == needed | {"source"}
    merged = editions.merge_rules(parse_rules(make_lines({"s": (1, "||a.com^\n||b.a.com^\n")})))
    assert merged.columns == editions.EDITION_COLS


def test_coverage_chain_is_one_pass(make_lines):
    lines = make_lines({"s": (1, "||c.b.a.com^\n||b.a.com^\n||a.com^\n||www.a.com/x^\n||a.com^$image\n")})
    kept = subsume.dedup_subsumed(dedup.dedup_exact(parse_rules(lines)))
    assert {r.raw for r in kept.collect()} == {"||a.com^", "||a.com^$image"}


def test_sections_and_counts(make_lines):
    lines = make_lines({
        "a": (2, "! Title: L\n||x.com^\n@@||x.com^\nx.com##.ad\n||X.com^\n"),
        "b": (1, "! Title: L\n||x.com^\n||y.x.com^\n"),
    })
    rules = parse_rules(lines)
    counts = {r.section: (r.rules, r.kept, r.removed) for r in dedup.duplicate_counts(rules).collect()}
    assert counts == {"header": (2, 1, 1), "block": (4, 2, 2), "exception": (1, 1, 0), "element": (1, 1, 0)}
    kept = dedup.dedup_exact(rules).filter("normalized = '||x.com^'").collect()
    assert [(r.source, r.raw) for r in kept] == [("b", "||x.com^")]


def test_hot_key_is_cut_before_the_shuffle(make_lines):
    plan = dedup.dedup_exact(parse_rules(make_lines({"s": (1, "||a.com^\n" * 50)})))
    text = plan._jdf.queryExecution().explainString(
        plan.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )
    assert "WindowGroupLimit" in text and text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_hot_parent_is_split_by_adaptive_execution(spark):
    """A parent with most of the rules below it: the probe side of the join is split."""
    rules = spark.range(0, 60000, 1, 8).select(
        F.lit("block").alias("section"),
        F.when(F.col("id") == 0, "||hot.example^")
        .when(F.col("id") % 20 == 1, F.concat(F.lit("||a."), "id", F.lit(".net^")))
        .otherwise(F.concat(F.lit("||n"), "id", F.lit(".hot.example^"))).alias("normalized"),
    ).withColumn("domain", F.expr("substring(normalized, 3, length(normalized) - 3)")).withColumn(
        "key_hash", F.xxhash64("section", "normalized")
    )
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        ready = subsume.prepare(rules)
        covered = subsume.covered_ids(ready)
        n = len(covered.select("key_hash").collect())
        plan = covered.select("key_hash")
        plan.collect()
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert n == rules.filter("domain like '%.hot.example'").count()
        assert "skew=true" in text.lower() or "skewed" in text.lower()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_carry_and_numbers_against_loops(spark):
    rnd = random.Random(5)
    rows = [(g, i // 4, i, rnd.choice([None, None, i])) for g in "ab" for i in range(40)]
    df = spark.createDataFrame(rows, "g string, chunk bigint, line_no bigint, v int")
    for backwards in (False, True):
        got = {(r.g, r.line_no): r.o for r in carry(df, ["g"], "v", "o", backwards).collect()}
        for g in "ab":
            seen = None
            ordered = [r for r in rows if r[0] == g]
            for r in reversed(ordered) if backwards else ordered:
                seen = r[3] if r[3] is not None else seen
                assert got[(g, r[2])] == seen
    numbered = number_rows(df, [F.col("line_no")], F.struct("g", "chunk"), "n")
    assert [r.n for r in numbered.orderBy("g", "line_no").collect()] == list(range(1, 81))


#: Source 0 is lite. Both lists hold ||cdn.test^ and the same scoped rule in another order.
PAIR = {
    "garden": (4, "! Expires: 2 days\n||cdn.test^\n! from the hedge\n\n||img.pond.test/frog.js\n"
                  "@@||pond.test/help^\nq.test,m.test##.weed\n||lily.pond.test^$image\n"),
    "kitchen": (2, "! Title: Kitchen\nm.test,q.test##.weed\n0.0.0.0 mould.test\n||pond.test^\n"
                   "! last words\n||cdn.test^\nm.test#@#.spoon\n@@||oven.test^\n||fork.test/tine/*\n"),
}


def test_edition_end_to_end(make_lines):
    edition = editions.build_edition(make_lines(PAIR)).collect()
    assert [r.raw for r in edition] == [
        "! Title: Kitchen", "! Expires: 2 days", "@@||oven.test^", "@@||pond.test/help^",
        "0.0.0.0 mould.test", "||pond.test^", "||cdn.test^", "||fork.test/tine/*", "m.test#@#.spoon", "m.test,q.test##.weed",
    ]
    kept = {r.raw: (r.source, r.comments) for r in edition}
    assert kept["||cdn.test^"] == ("kitchen", ["! last words"]) and kept["m.test,q.test##.weed"][0] == "kitchen"
    lite = editions.build_edition(make_lines(PAIR), lite=True).collect()
    assert [(r.raw, r.comments) for r in lite] == [
        ("! Expires: 2 days", []), ("@@||pond.test/help^", []), ("||cdn.test^", []),
        ("||img.pond.test/frog.js", ["! from the hedge"]), ("||lily.pond.test^$image", []), ("q.test,m.test##.weed", []),
    ]


def test_too_long_rules_cover_before_they_go(make_lines):
    long = "||a.com^$domain=" + "x" * 50
    lines = make_lines({"s": (1, f"{long}\n||b.a.com^\n||c.com^\n")})
    merged = editions.merge_rules(parse_rules(lines), max_rule_length=40).collect()
    assert [r.raw for r in merged] == ["||c.com^"]


@pytest.mark.parametrize("seed", [4, 5])
def test_keepers_end_in_the_edition(make_lines, seed):
    rules = dedup.dedup_exact(parse_rules(make_lines({"s": (1, random_rules(seed, 300)), "t": (1, random_rules(seed + 50, 300))}, 64)))
    parent = {r.child: r.parent for r in subsume.covering_parents(rules).collect()}
    kept = {r.normalized for r in subsume.dedup_subsumed(rules).filter("section = 'block'").collect()}
    got = subsume.final_keepers(rules).collect()
    assert len(got) == len(parent) and {r.child for r in got} == set(parent)
    for r in got:
        at, steps = r.child, 0
        while at in parent:
            at, steps = parent[at], steps + 1
        assert (r.parent, r.keeper, r.steps) == (parent[r.child], at, steps) and r.keeper in kept
    assert max(r.steps for r in got) > 1


def test_keeper_of_a_long_chain(make_lines):
    names = [".".join(f"n{i}" for i in range(n, 0, -1)) + ".com" for n in range(1, 12)]
    rules = dedup.dedup_exact(parse_rules(make_lines({"s": (1, "\n".join(f"||{name}^" for name in names))})))
    got = {r.child: (r.keeper, r.steps) for r in subsume.final_keepers(rules).collect()}
    assert got == {f"||{name}^": (f"||{names[0]}^", i) for i, name in enumerate(names) if i}


def test_no_keepers_without_coverage(make_lines):
    rules = dedup.dedup_exact(parse_rules(make_lines({"s": (1, "||a.com^\n||b.com^")})))
    assert subsume.final_keepers(rules).collect() == []


def test_only_parents_that_are_asked_for_are_staged(spark, monkeypatch):
    """Domains without rules below them never reach the tables of parents."""
    staged = {}

    def noted(df, name, partition_by=None):
        table = real(df, name, partition_by)
        staged.setdefault(name, []).append(table.count())
        return table

    real = subsume.stage
    monkeypatch.setattr(subsume, "stage", noted)
    names = [f"lone{i}.org" for i in range(50)] + ["top.com", "a.top.com", "b.a.top.com"]
    rows = [(1, 0, 0, i, f"||{n}^", f"||{n}^", n, "block", i) for i, n in enumerate(names)]
    rules = spark.createDataFrame(rows, "priority int, source_ord int, chunk long, line_no long, raw string, normalized string, domain string, section string, key_hash long")
    kept = {r.raw for r in subsume.dedup_subsumed(rules, ["raw"]).collect()}
    assert kept == {f"||{n}^" for n in names[:51]}
    assert staged["parents"] == [2]
    pairs = {(r.child, r.parent) for r in subsume.covering_parents(rules).collect()}
    assert pairs == {("||a.top.com^", "||top.com^"), ("||b.a.top.com^", "||a.top.com^")}
    assert staged["parents"] == [2, 2] and staged["paths"][-1] == 0


def test_values_are_carried_over_spans_of_chunks(spark, monkeypatch):
    monkeypatch.setattr("rulemill.operators.carry.SPAN", 3)
    rng = random.Random(5)
    rows = [(rng.choice("ab"), rng.randint(-4, 25), i, rng.choice([None] * 9 + [f"v{i}"]), rng.random() < 0.2) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, chunk long, line_no long, v string, k boolean").repartition(4)
    for backwards in (False, True):
        want, last = {}, {}
        for g, c, n, v, k in sorted(rows, key=lambda r: (r[1], r[2]), reverse=backwards):
            last[g] = v or last.get(g)
            want[n] = last[g]
        got = {r.line_no: r.o for r in carry(df, ["g"], "v", "o", backwards).collect()}
        some = {r.line_no: r.o for r in carry(df, ["g"], "v", "o", backwards, F.col("k")).collect()}
        assert got == want and some == {r[2]: want[r[2]] for r in rows if r[4]}


def test_narrow_rows_are_widened_again(spark):
    rows = [(raw, key, domain) for raw in ("||a.b^", "||A.b^", "") for key in ("||a.b^", "") for domain in ("a.b", "", "www.a.b")]
    rules = spark.createDataFrame(rows, "raw string, normalized string, domain string")
    thin = dedup.narrow(rules)
    assert sorted(map(tuple, dedup.widen(thin).collect())) == sorted(rows)
    assert thin.filter("raw is null").count() == 6 and thin.filter("domain is null").count() == 6


@pytest.mark.parametrize("seed", [6, 7])
def test_every_broader_pair_against_brute_force(make_lines, seed):
    """All parents of a rule, not only the nearest, each once."""
    rules = dedup.dedup_exact(parse_rules(make_lines({f"s{i}": (i, random_rules(seed * 10 + i, 200)) for i in range(2)}, 16)))
    blocks = [(r.domain, r.normalized) for r in rules.filter("section = 'block'").collect() if r.domain]
    want = sorted((c[1], p[1]) for c in blocks for p in blocks if covers(p, c))
    got = sorted(map(tuple, subsume.covering_parents(rules, every=True).collect()))
    assert got == want and len({c for c, _ in want}) < len(want)


def test_broader_pairs_holds_each_pair(spark, tmp_path):
    """Of ||a.b.s3.example.com^ and the rules above it no pair is left out."""
    from pyspark.sql.types import StructType

    from rulemill.checks.queries import QUERIES

    tables = {
        "pages": ("page_id long, url string, html string", [(n, u, "") for n, u in enumerate(
            ["https://a.b.s3.example.com/x"] * 5 + ["http://b.s3.example.com/"] * 25 + ["https://a.b.s3.example.com/x"] * 5)]),
        "documents": ("doc_id long, text string, lang string, source string, n_chars int", [(1, "||b.s3.example.com^", "de", "src1", 19)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int", [(1, 10, 3, 1)]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, StructType.fromDDL(schema)).write.parquet(f"{tmp_path}/{name}.parquet")
    pairs = sorted(map(tuple, QUERIES["broader_pairs"](spark, str(tmp_path)).collect()))
    assert ("||a.b.s3.example.com^", "||b.s3.example.com^") in pairs
    assert ("||a.b.s3.example.com^", "||s3.example.com^") in pairs and ("||b.s3.example.com^", "||s3.example.com^") in pairs
    assert len(pairs) == len(set(pairs))


def test_stored_rules_hold_each_text_once(spark, monkeypatch):
    """What the key tells is not stored, and every row comes back as it was, NULLs too."""
    tables = {}

    def noted(df, name, partition_by=None):
        tables[name] = real(df, name, partition_by)
        return tables[name]

    real = subsume.stage
    monkeypatch.setattr(subsume, "stage", noted)
    keys = ["||a.com^", "@||||b.a.com/x", "0.0.0.0 c.a.com", "||WWW.d.com^$match-case", "/banner/", "", "é||e.com^", "|é.f.com^", None]
    rows = [
        (i, key, raw, domain, section, h)
        for i, (key, raw, domain, section, h) in enumerate(
            (key, raw, domain, section, h)
            for key in keys for raw in (key, "||Other.org^", "", None) for domain in ("a.com", "WWW.d.com", "", None)
            for section in ("block", "element") for h in (None, 7)
        )
    ]
    plain = spark.createDataFrame(rows, "line_no long, normalized string, raw string, domain string, section string, h long")
    rules = plain.withColumn("key_hash", F.coalesce("h", F.xxhash64("section", "normalized"))).drop("h")
    ready = subsume.prepare(rules)
    want = subsume.with_keys(rules).select(ready.columns)
    assert sorted(map(str, ready.collect())) == sorted(map(str, want.collect()))
    stored = tables["exact"].filter("section = 'block' and normalized = '||a.com^' and line_no = 0").first()
    assert [stored[c] for c in ("raw", "domain", "key_domain", "key_hash")] == [None] * 4


@pytest.mark.parametrize("below, listed", [(3, "covered"), (40, "uncovered")])
@pytest.mark.parametrize("short_list", [0, 1000])
def test_rows_are_picked_by_the_shorter_list(make_lines, monkeypatch, below, listed, short_list):
    names = []

    def noted(df, name, partition_by=None):
        names.append(name)
        return real(df, name, partition_by)

    real = subsume.stage
    monkeypatch.setattr(subsume, "stage", noted)
    monkeypatch.setattr(subsume, "SHORT_LIST", short_list)
    rules = [f"||n{i}.top.com^$image" for i in range(below)] + ["||top.com^"] + [f"||Lone{i}.org^" for i in range(20)]
    exact = dedup.dedup_exact(parse_rules(make_lines({"s": (1, "\n".join([*rules, "@@||n1.top.com^"]))})))
    assert {r.raw for r in subsume.dedup_subsumed(exact).collect()} == {*rules[below:], "@@||n1.top.com^"}
    assert {r.raw for r in subsume.covered_rules(exact).collect()} == set(rules[:below])
    assert [n for n in names if n.endswith("covered")] == {"covered": ["covered"], "uncovered": ["covered", "uncovered"]}[listed] * 2


def test_coverage_shuffles_no_text_of_children(make_lines):
    """Rows are compared by their numbers, so a join of many children carries no rule text."""
    exact = dedup.dedup_exact(parse_rules(make_lines({"s": (1, "||a.com^\n||b.a.com^\n")})))
    thin = subsume._staged(exact, ["raw"])
    assert subsume.covered_ids(subsume._full(thin), ids=[subsume.ROW]).columns == [subsume.ROW]
    assert thin.select(subsume.ROW).distinct().count() == 2


def test_places_of_comments_are_stored_once(make_lines, monkeypatch):
    from rulemill.operators import parse

    stored = []

    def noted(df, name, partition_by=None):
        stored.append(df.columns)
        return real(df, name, partition_by)

    real = parse.stage
    monkeypatch.setattr(parse, "stage", noted)
    got = parse.rule_comments(make_lines({"s": (1, "! one\n\n! two\n||a.com^\n||b.com^\n! last\n")})).collect()
    assert [r.comments for r in got] == [["! one", "! two"]] and stored == [["source", "chunk", "line_no", "comment"]]

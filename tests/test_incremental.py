"""Pruned reading and editions kept up to date from changes."""

import random

import pytest
from pyspark.sql import functions as F

from rulemill.operators import incremental, subsume
from rulemill.operators.parse import parse_rules
from rulemill.plans.editions import merge_rules
from rulemill.sources import lists
from rulemill.staging import stage
from rulemill.streaming import refresh as streaming
from test_runs import land, lines_of, published, sources_of


def scanned_files(df):
    """Files that the scan itself reports after the query has run."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return leaf.metrics().get("numFiles").get().value()


def test_only_chosen_files_are_opened(spark, tmp_path):
    names = ["plain", "odd [x]{1}* 100%?"]
    for run in range(6):
        land(tmp_path, str(run), {n: f"||{i}-{run}.example.com^\n" for i, n in enumerate(names)})
    sources = sources_of(spark, [(n, i + 1, True, True) for i, n in enumerate(names)])
    chosen = lists.newest_files(lists.list_files(spark, str(tmp_path)))
    lines = lists.file_lines(spark, str(tmp_path), chosen)
    assert len(lines.inputFiles()) == 2 and scanned_files(lines) == 2
    assert {(r.source, r.run_id, r.line) for r in lines.collect() if r.line} == {
        (n, "5", f"||{i}-5.example.com^") for i, n in enumerate(names)
    }
    texts = lists.read_lists(spark, str(tmp_path), sources)
    assert {(r.source, r.text) for r in texts.collect()} == {(n, f"||{i}-5.example.com^\n") for i, n in enumerate(names)}
    nothing = lists.file_lines(spark, str(tmp_path), chosen.filter("source = 'none'"))
    assert nothing.collect() == [] and nothing.columns == lines.columns


HOSTS = ["a.com", "x.a.com", "y.x.a.com", "www.b.org", "b.org", "z.b.org", "c.co.uk", "q.c.co.uk", "0.0.0.0", "v.0.0.0.0"]


def random_list(rng):
    made = []
    for _ in range(rng.randint(0, 12)):
        host = rng.choice(HOSTS)
        made.append(rng.choice([
            f"||{host}^", f"||{host}/path", f"||{host}^$script", f"@@||{host}^", f"0.0.0.0 {host}", f"{host}##.ad", f"||{host.upper()}^",
            f"||sub.{host}^", f"||sub.{host}/a/b", "! note", host,
        ]))
    return "\n".join(made) + "\n"


WANTED = ["source", "priority", "source_ord", "chunk", "line_no", "raw", "section", "normalized", "domain"]


@pytest.mark.parametrize("seed", range(2))
def test_maintained_winners_equal_a_full_merge(spark, make_lines, seed):
    rng = random.Random(seed)
    texts = {f"s{i}": (rng.randint(1, 3), random_list(rng)) for i in range(5)}
    winners, before = spark.createDataFrame([], incremental.WINNERS), {}
    for _ in range(3):
        # Some lists change, one leaves or comes, priorities move.
        for name in rng.sample(sorted(texts), 2):
            texts[name] = (rng.choice([texts[name][0], rng.randint(1, 3)]), rng.choice([texts[name][1], random_list(rng)]))
        if rng.random() < 0.4:
            texts.pop(rng.choice(sorted(texts)))
        if rng.random() < 0.4:
            texts[f"n{rng.randint(0, 9)}"] = (rng.randint(1, 3), random_list(rng))
        rules = stage(parse_rules(make_lines(texts)), "all-rules")
        now = {n: (p, i, t) for i, (n, (p, t)) in enumerate(texts.items())}
        gone = [n for n in before if now.get(n) != before[n]]
        came = [n for n in now if before.get(n) != now[n]]
        kept = incremental.candidates(rules).join(rules.select("source", "priority", "source_ord").distinct(), "source")
        winners = stage(incremental.maintain(
            winners, spark.createDataFrame([(n,) for n in gone], "source string"),
            kept.filter(~F.col("source").isin(came)), kept.filter(F.col("source").isin(came))), "winners")
        got = incremental.edition_of(winners, 40).select(*WANTED).collect()
        want = merge_rules(rules, 40, WANTED).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want))
        before = now


def test_only_rules_below_changed_parents_are_tested(spark, make_lines, monkeypatch):
    def kept(texts):
        rules = parse_rules(make_lines(texts))
        return stage(incremental.candidates(rules).join(rules.select("source", "priority", "source_ord").distinct(), "source"), "kept")

    big = "\n".join(f"||h{i}.site{i % 7}.com^" for i in range(200)) + "\n||site1.com^\n"
    first = kept({"big": (1, big)})
    none = spark.createDataFrame([], "source string")
    winners = stage(incremental.maintain(spark.createDataFrame([], incremental.WINNERS), none, first.limit(0), first), "winners")
    assert winners.filter("covered").count() == 29
    tested = []

    def watch(rules, children):
        tested.append((sorted(r.domain for r in rules.collect()), children.count()))
        return subsume.covered_ids(rules, children)

    monkeypatch.setattr(incremental, "covered_ids", watch)
    arriving = kept({"big": (1, big), "small": (2, "||site2.com^\n||new.site1.com^\n")}).filter("source = 'small'")
    later = stage(incremental.maintain(winners, none, first, arriving), "winners")
    # The rules below site2.com, the new rules, and the one below new.site1.com: nothing else, against two parents.
    assert tested == [(["site1.com", "site2.com"], 29 + 2)]
    assert later.filter("covered").count() == 29 + 29 + 1


@pytest.fixture
def refreshing(spark, tmp_path):
    def go(rows, batch, options=streaming.Options()):
        files = lists.list_files(spark, str(tmp_path / "in"))
        return streaming.apply_batch(files, batch, str(tmp_path / "in"), sources_of(spark, rows), str(tmp_path / "t"), str(tmp_path / "out"), options)

    return lambda run, texts: land(tmp_path / "in", run, texts), go


def test_refresh_parses_only_what_changed(spark, tmp_path, refreshing, monkeypatch):
    add, go = refreshing
    rows = [(f"s{i}", i, i % 2 == 0, True) for i in range(20)]
    add("1", {n: f"! about {n}\n||{n}.com^\n||shared.com^\n" for n, *_ in rows})
    assert go(rows, 0)
    parsed = []

    def watch(lines):
        parsed.append(sorted(r.source for r in lines.select("source").distinct().collect()))
        return parse_rules(lines)

    monkeypatch.setattr(streaming, "parse_rules", watch)
    add("2", {"s3": "! again\n||s3.com^\n||x.s4.com^\n", "s5": f"! about s5\n||s5.com^\n||shared.com^\n"})
    assert go(rows, 1) and parsed == [["s3"]]
    full = published(tmp_path / "out" / "full")
    assert full == [f"||s{i}.com^" if i else line for i in range(20) for line in (["||s0.com^", "||shared.com^"] if i == 0 else [0])]
    assert "! again" in lines_of(tmp_path / "out" / "full") and "! about s3" not in lines_of(tmp_path / "out" / "full")
    table = lambda name, batch=1: spark.read.parquet(f"{tmp_path}/t/{name}/batch={batch}")
    assert {(r.source, r.rule_count, r.raw_count, r.parsed) for r in table("state").collect() if r.source in ("s3", "s5")} == {("s3", 2, 2, 1), ("s5", 2, 2, 0)}
    assert {(r.edition, r.source, r.rules, r.mark) for r in table("log").collect() if r.source in ("s0", "s3")} == {
        ("full", "s0", 2, "="), ("full", "s3", 1, "+"), ("lite", "s0", 2, "=")}
    assert table("changes").count() == 0
    # s4 is switched off: what it covered is released; s0 moves behind all others.
    rows[4], rows[0] = ("s4", 4, True, False), ("s0", 99, True, True)
    add("3", {"s7": "||s7.com^\n"})
    assert go(rows, 2, streaming.Options(max_rule_length=12, title="Own"))
    assert parsed == [["s3"], ["s7"]]
    full = published(tmp_path / "out" / "full")
    assert "||x.s4.com^" in full and "||s4.com^" not in full and "||shared.com^" not in full
    assert lines_of(tmp_path / "out" / "full")[1] == "! Title: Own"
    for name in ("full", "lite"):
        kept = lists.read_lines(spark, str(tmp_path / "in"), sources_of(spark, rows))
        rules = parse_rules(kept.filter("lite") if name == "lite" else kept)
        want = sorted(r.raw for r in merge_rules(rules, 12).collect())
        assert sorted(published(tmp_path / "out" / name)) == want
    # Storage does not follow the number of batches.
    stored = {p.name for t in ("state", "winners/edition=full", "members/edition=lite") for p in (tmp_path / "t" / t).iterdir() if p.is_dir()}
    assert stored == {"batch=1", "batch=2"}
    reached = {r.parsed for b in (1, 2) for r in table("state", b).collect()}
    assert {int(p.name[6:]) for p in (tmp_path / "t/rules").iterdir() if p.is_dir()} == reached

import pytest
from pyspark.sql import functions as F

from rulemill.functions.domains import anchored_domain, extract_domain
from rulemill.functions.normalize import add_normalized
from rulemill.functions.options import option_tokens, options_text
from rulemill.functions.text import strip
from rulemill.operators import parse
from rulemill.sources.lists import list_lines, raw_rule_counts

# line -> rule type, pattern, domain
RULES = [
    ("@@||example.com^", "exception", "@@||example.com^", "example.com"),
    ("@@||example.com^$document", "exception", "@@||example.com^", "example.com"),
    ("example.com##.ad", "hide", "example.com##.ad", "example.com"),
    ("##.ad", "hide", "##.ad", ""),
    ("||example.com/ads/*", "block", "||example.com/ads/*", "example.com"),
    ("||com^", "block", "||com^", "com"),
    ("example.com#@#.x", "hide-exception", "example.com#@#.x", "example.com"),
    ("example.com#@#^script:has-text(x)", "hide-exception", "example.com#@#^script:has-text(x)", "example.com"),
    ("example.com##^script", "hide", "example.com##^script", "example.com"),
    ("example.com#?#div:has(.ad)", "css-ext", "example.com#?#div:has(.ad)", "example.com"),
    ("example.com#@?#div", "css-ext", "example.com#@?#div", "example.com"),
    ("example.com##+js(abort, x)", "scriptlet", "example.com##+js(abort, x)", "example.com"),
    ("example.com#%#//scriptlet('x')", "scriptlet", "example.com#%#//scriptlet('x')", "example.com"),
    ("example.com#$#script:inject(x)", "scriptlet", "example.com#$#script:inject(x)", "example.com"),
    ("example.com#%# script(x)", "scriptlet", "example.com#%# script(x)", "example.com"),
    ("example.com#$#body { x }", "css-inject", "example.com#$#body { x }", "example.com"),
    ("example.com#%#.ad { x }", "css-inject", "example.com#%#.ad { x }", "example.com"),
    ("example.com#@$#.ad", "css-inject", "example.com#@$#.ad", "example.com"),
    ("example.com#@%#.ad", "css-inject", "example.com#@%#.ad", "example.com"),
    ("example.com#$?#style", "css-inject", "example.com#$?#style", "example.com"),
    ("example.com#@$?#div", "css-inject", "example.com#@$?#div", "example.com"),
    ("example.com$$div[a]", "html", "example.com$$div[a]", "example.com"),
    ("example.com#@$$div", "html-exception", "example.com#@$$div", "example.com"),
    ("127.0.0.1 Ad.Tracker.com   # note", "block", "127.0.0.1 Ad.Tracker.com", "ad.tracker.com"),
    ("0.0.0.0 #x", "block", "0.0.0.0", "#x"),
    ("0.0.0.0 a.com b.com", "block", "0.0.0.0 a.com b.com", "a.com b.com"),
    ("@@sub.example.com/x", "exception", "@@sub.example.com/x", "sub.example.com"),
    ("|http://example.com/$/ads|", "block", "|http://example.com/$/ads|", ""),
    ("||example.com^$,", "block", "||example.com^$,", "example.com"),
    ("||example.com^$", "block", "||example.com^", "example.com"),
    ("||example.com^$nonsense", "block", "||example.com^$nonsense", "example.com"),
    ("||example.com^$~script", "block", "||example.com^", "example.com"),
    ("||example.com^$=x", "block", "||example.com^$=x", "example.com"),
    ("||example.com^$ key=x", "block", "||example.com^", "example.com"),
    ("﻿[Adblock Plus]", "block", "﻿[Adblock Plus]", ""),
]


def test_rule_type_pattern_domain(make_lines):
    lines = make_lines({"s": (1, "\n".join(r[0] for r in RULES))})
    got = {
        r.line_no: (r.rule_type, r.pattern, r.domain)
        for r in parse.parse_rules(lines).collect()
    }
    assert [got[i] for i in range(len(RULES))] == [r[1:] for r in RULES]


OPTIONS = [
    ("||e.com^$font,ping,domain=~z.net|y.net,third-party",
     {"font": None, "ping": None, "domain": "~z.net|y.net", "third-party": None}),
    ("||e.com^$redirect=blank.mp4", {"redirect": "blank.mp4"}),
    ("||e.com^$replace=/one(, two)?/three/i,media", {"replace": "/one(, two)?/three/i", "media": None}),
    (r"||e.com^$replace=/a\/b,c/d/,font", {"replace": r"/a\/b,c/d/", "font": None}),
    ("||e.com^$removeparam=/^ref[0-9]{1,3}$/", {"removeparam": "/^ref[0-9]{1,3}$/"}),
    (r"||e.com^$header=via:x\, y\, z,ping", {"header": r"via:x\, y\, z", "ping": None}),
    ("||e.com^$ping,removeparam=/p,q/,font", {"ping": None, "removeparam": "/p,q/", "font": None}),
    ("||e.com^$replace=/never shut,font", {"replace": "/never shut,font"}),
    ("||e.com^$image=1,script,image=2", {"image": "2", "script": None}),
    ("||e.com^$ script , image = x", {"script": None, "image": " x"}),
    ("e.com##div[a=$script]", {}),
    ("||e.com^", {}),
]


def test_options(make_lines):
    lines = make_lines({"s": (1, "\n".join(o[0] for o in OPTIONS))})
    got = {r.line_no: r.options for r in parse.parse_rules(lines).collect()}
    assert [got[i] for i in range(len(OPTIONS))] == [o[1] for o in OPTIONS]


def test_long_options_and_domains_do_not_overflow(spark):
    long = ["||e.com^$" + r"\,a" * 60000, "||" + "a-" * 60000 + "b.com^", "||" + "a." * 60000 + "com^"]
    df = spark.createDataFrame([(t,) for t in long], "t string")
    t = F.col("t")
    rows = df.select(
        F.size(option_tokens(options_text(t))).alias("n"),
        F.length(extract_domain(t, anchored_domain(t))).alias("d"),
    ).collect()
    assert [r.n for r in rows][0] == 1
    assert [r.d for r in rows] == [5, 120005, 120003]


def test_line_kinds(make_lines):
    text = (
        "! Title: T\n! title: x\n! ===== s =====\n! =\n[Adblock Plus 2.0]\n[x] y\n########\n## \n# text\n##.ad\n"
        "\n   \n127.0.0.1\n127.0.0.1\tx\n[\n"
    )
    rows = parse.classify_lines(make_lines({"s": (1, text)})).orderBy("chunk", "line_no").collect()
    assert [r.kind for r in rows] == [
        "header", "comment", "section-marker", "section-marker", "block-marker", "rule", "hash-comment",
        "hash-comment", "hash-comment", "rule", "blank", "blank", "rule", "hosts", "rule",
    ]


def test_splitting_and_stripping_follow_unicode(spark):
    seps = ["\n", "\r", "\r\n", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", " ", " "]
    text = "".join(f"a{i}{s}" for i, s in enumerate(seps)) + "end"
    df = spark.createDataFrame([("s", text)], "source string, text string")
    got = [r.line for r in list_lines(df).orderBy("line_no").collect()]
    assert got == text.splitlines()
    for ending in ("", "\n", "a\n", "a\n\n", "\r\n\n a"):
        df = spark.createDataFrame([("s", ending)], "source string, text string")
        assert [r.line for r in list_lines(df).orderBy("line_no").collect()] == ending.splitlines()
    padded = ["  x　", "\x1cx y\x85", "  ", "﻿x"]
    df = spark.createDataFrame([(p,) for p in padded], "t string")
    assert [r[0] for r in df.select(strip(F.col("t"))).collect()] == [p.strip() for p in padded]


def test_raw_counts_include_hash_comments(make_lines):
    lines = make_lines({"s": (1, "! c\n[x\n\n# c\n||a.com^\n")})
    assert raw_rule_counts(lines).collect()[0].rule_count == 2


def test_comments_wait_for_the_next_rule(make_lines):
    text = (
        "! one\n\n# hash\n! ===== mark =====\n||a.com^\n! two\n! three\n@@||b.com^\n||c.com^\n"
        "! Version: 1\n[block]\n\n\n\n\n! four\n! Title: T\n! lost\n"
    )
    lines = make_lines({"s": (1, text), "t": (2, "||z.com^\n")})
    rules = parse.attach_comments(parse.parse_rules(lines), lines)
    assert {r.raw: r.comments for r in rules.collect()} == {
        "||a.com^": ["! one"], "@@||b.com^": ["! two", "! three"], "||c.com^": [],
        "! Title: T": ["! Version: 1", "! four"], "||z.com^": [],
    }


@pytest.mark.parametrize("chunk", [1, 2, 5, 1000])
def test_comments_do_not_depend_on_chunks(make_lines, chunk):
    text = "".join(f"! c{i}\n" if i % 7 or i % 3 else f"||r{i}.com^\n" for i in range(100))
    lines = make_lines({"s": (1, text)}, chunk)
    got = {r.line_no: r.comments for r in parse.attach_comments(parse.parse_rules(lines), lines).collect()}
    want, waiting = {}, []
    for i, line in enumerate(text.splitlines()):
        if line.startswith("!"):
            waiting.append(line)
        else:
            want[i], waiting = waiting, []
    assert got == want


def test_sites_and_parse_key(make_lines):
    rows = [
        ("foo.org,Example.com##.Sponsor", ["foo.org", "Example.com"], "example.com,foo.org##.sponsor"),
        ("example.com, ~foo.org,#@#.x", ["example.com", "~foo.org"], "example.com,~foo.org#@#.x"),
        ("a.com##+js(X, y)", ["a.com"], "a.com##+js(x, y)"),
        ("##.ad", [], "##.ad"),
        ("||a.com,b.com^", [], "||a.com,b.com^"),
    ]
    lines = make_lines({"s": (1, "\n".join(r[0] for r in rows))})
    got = {r.line_no: (r.domains, r.parsed_key) for r in parse.parse_rules(lines).collect()}
    assert [got[i] for i in range(len(rows))] == [r[1:] for r in rows]


KEYS = [
    ("  ||example.com^  ", "||example.com^"),
    ("\t||Example.COM^\t", "||example.com^"),
    ("a   b\tc", "a b c"),
    ("||www.example.com^", "||example.com^"),
    ("www.example.com", "www.example.com"),
    ("||www.www.a.com^", "||www.a.com^"),
    ("||x.www.a.com^", "||x.a.com^"),
    ("||e.com^$domain=z.com|a.com|m.com", "||e.com^$domain=a.com|m.com|z.com"),
    ("||e.com^$DOMAIN= B | a ,x,domain=d|c", "||e.com^$domain=a|b,x,domain=c|d"),
    ("||e.com^$domain=", "||e.com^$domain="),
    ("||Example.COM/Ads^$match-case", "||Example.COM/Ads^$match-case"),
    ("||Example.COM/Ads^$image, match-case ,x", "||Example.COM/Ads^$image, match-case ,x"),
    ("||Example.COM/Ads^$match-cases", "||example.com/ads^$match-cases"),
    ("||e.com^$", "||e.com^"),
    ("||e.com^$b,a", "||e.com^$b,a"),
    ("~foo.org, example.com#@#.x", "example.com,~foo.org#@#.x"),
    ("foo.org,example.com##+js(abort.js, x)", "example.com,foo.org##+js(abort.js, x)"),
    ("foo.org,example.com#@$#.ad { display: none; }", "example.com,foo.org#@$#.ad { display: none; }"),
    ("foo.org,example.com#@$$div", "example.com,foo.org#@$$div"),
    ("example.com##.ad", "example.com##.ad"),
    (r"/\D+x$/", r"/\d+x$/"),
    ("b,a#www.#x", "a,b##x"),
    ("", ""),
]


def test_canonical_keys(spark):
    df = spark.createDataFrame([(i, k[0]) for i, k in enumerate(KEYS)], "i int, t string")
    got = {r.i: r.k for r in add_normalized(df.withColumn("t", strip(F.col("t"))), "t", "k").collect()}
    assert [got[i] for i in range(len(KEYS))] == [k[1] for k in KEYS]


def test_canonical_key_is_idempotent(spark):
    df = spark.createDataFrame([("||www.Example.COM^$domain=z.com|a.com",)], "t string")
    once = add_normalized(df, "t", "k")
    assert add_normalized(once.select("k"), "k", "k2").filter("k <> k2").isEmpty()

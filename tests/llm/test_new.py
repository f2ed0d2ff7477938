"""Operators 11 to 13 against brute force."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from rulemill.llm import op10_lines, op11_variants, op12_disclosure, op13_cover_tree


def brute_codes(rows, parts=4, entries=256, rounds=4):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    lengths = [len(r[1]) for r in kept if len(r[1]) and len(r[1]) % parts == 0]
    if not lengths:
        return {}
    length = min(set(lengths), key=lambda n: (-lengths.count(n), n))
    kept = [r for r in kept if len(r[1]) == length]
    whole = [[math.floor(1024 * float(np.float32(x))) for x in r[1]] for r in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))[:entries]
    width = length // parts
    codes, errors, books = [[] for _ in kept], [0] * len(kept), []

    def nearest(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), i) for i, e in enumerate(book))

    for p in range(parts):
        cut = [v[p * width:(p + 1) * width] for v in whole]
        book = [cut[i] for i in order]
        for _ in range(rounds):
            groups = {}
            for v in cut:
                groups.setdefault(nearest(v, book)[1], []).append(v)
            for i, g in groups.items():
                book[i] = [sum(c) // len(g) for c in zip(*g)]
        for k, v in enumerate(cut):
            d, i = nearest(v, book)
            codes[k].append(f"{i:02x}")
            errors[k] += d
        books.append(book)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    by_label = {}
    for r, e in zip(kept, errors):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    return sorted(((r[0], "".join(c), e, by_label[r[2]], digest) for r, c, e in zip(kept, codes, errors)), key=repr)


VECTORS = "vec_id long, embedding array<float>, label int, _label string, points int"


def vectors_of(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], VECTORS)


@pytest.mark.parametrize("block, entries", [(16, 5), (1024, 20)])
def test_codes_equal_brute_force(spark, rng, block, entries):
    centres = [[rng.gauss(0, 3) for _ in range(8)] for _ in range(6)]
    rows = []
    for i in range(150):
        base, spread = rng.choice(centres), rng.choice([0, 0.01, 1])
        rows.append((i * 7 % 151, [x + rng.gauss(0, spread) for x in base], rng.choice([1, 2, None])))
    rows += [(5000, rows[0][1], 1)] * 3 + [(None, rows[1][1], None), (3, rows[2][1], 2)]
    rows += [(6000, None, 1), (6001, [1.0, None] * 4, 1), (6002, [float("nan")] * 8, 1), (6003, [float("inf")] * 8, 1), (6004, [], 1), (6005, [1.0] * 4, 1), (6006, [9000.0] * 8, None)]
    got = op13_cover_tree.compress(vectors_of(spark, rows).repartition(3), entries=entries, block=block)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_codes(rows, entries=entries)


def test_trees_cover_and_prune(rng):
    points = np.floor(np.array([[rng.gauss(c, 0.05) * 1024 for _ in range(4)] for c in range(5) for _ in range(60)]))
    tree = op13_cover_tree.CoverTree.build(points)
    far = np.sqrt(op13_cover_tree.squared(tree.points, tree.points))
    for (centre, lo, hi, first, n), reach in zip(tree.nodes, tree.radii):
        assert far[centre, lo:hi].max() == reach and lo <= centre < hi
        if n:
            below = tree.nodes[first:first + n]
            assert (below[0, 1], below[-1, 2]) == (lo, hi) and (below[1:, 1] == below[:-1, 2]).all()
    book = np.floor(np.array([[c * 1024.0] * 4 for c in range(5)]))
    lo, hi, entry, single, _ = tree.assign(book)
    assert len(lo) < 40 and not len(single) and (hi - lo).sum() == 300
    # Ties go to the lower number, also between equal entries.
    code, error = op13_cover_tree.CoverTree.build(np.zeros((3, 2))).codes(np.array([[9, 9], [1, 0], [0, 1], [1, 0]], float))
    assert code.tolist() == [1, 1, 1] and error.tolist() == [1, 1, 1]


def test_large_components_stay_exact():
    a = np.floor(np.array([[2.0 ** 29 + 1, -3.0], [2.0 ** 29, 5.0]]))
    assert op13_cover_tree.squared(a, a).tolist() == [[0, 65], [65, 0]]
    with pytest.raises(ValueError, match="too large"):
        op13_cover_tree.to_integers(np.array([2.0 ** 22, 0.0]), 2)


@pytest.mark.parametrize("rows", [[], [(1, None, 1), (2, [], None), (3, [1.0], 1)]])
def test_no_vector_left(spark, rows):
    assert op13_cover_tree.compress(vectors_of(spark, rows)).collect() == []


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def brute_variants(rows, least=7, ratio=10):
    n = {}
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] = n.get(run, 0) + 1
    n = {w: k for w, k in n.items() if len(w) >= least and k >= 2}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, n[w], len(near[w]), form[w], n.get(form[w]), root(w)) for w in n)


def variants(spark, documents, rows, **options):
    got = op11_variants.spelling_variants(documents(rows).repartition(3), **options)
    return sorted(map(tuple, got.select("word", "n", "n_near", "form", "form_n", "root").collect()))


@pytest.mark.parametrize("list_words", [3, 4096])
def test_variants_equal_brute_force(spark, documents, rng, list_words):
    stems = ["".join(rng.choice("abé") for _ in range(rng.randint(6, 11))) for _ in range(40)] + ["aaaaaaa" + "b" * k for k in range(6)]
    rows = []
    for i in range(60):
        run = []
        for _ in range(60):
            w = rng.choice(stems[:3]) if rng.random() < 0.4 else rng.choice(stems)
            if rng.random() < 0.3:
                p, kind = rng.randint(0, len(w)), rng.randint(0, 2)
                w = w[:p] + ("" if kind == 0 else rng.choice("abcÿ")) + w[p + (kind != 1):]
            run.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i // 2, rng.choice([" ", "-", "1", "\n", "漢"]).join(run)))
    rows += [(None, rows[0][1]), rows[1], (7, None), (8, ""), (9, "É"), (10, "a" * 50_000 + " " + "a" * 50_001), (11, "a" * 50_000 + " " + "a" * 50_001)]
    assert variants(spark, documents, rows, list_words=list_words) == brute_variants(rows)


def test_roots_follow_forms_to_the_last(spark, documents):
    chain = [("abcdefg", 3600), ("abcdefgh", 240), ("abcdefghi", 15)]
    rows = [(i, " ".join(w for w, k in chain if i < k)) for i in range(3600)]
    got = variants(spark, documents, rows)
    assert got == brute_variants(rows)
    assert {r[0]: r[5] for r in got}["abcdefghi"] == "abcdefg"


def test_no_words(spark, documents):
    assert variants(spark, documents, []) == [] == variants(spark, documents, [(1, None), (2, "short"), (3, "onlyonce")])


def test_scan_skips_ranges():
    """Rows of the edit matrix go to prefixes, not to pairs."""
    texts = sorted(a + b + c for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh")
    letters = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    query, word, shared = op11_variants.near_in_lists(letters, np.arange(0, 3 * len(texts) + 1, 3), np.zeros(len(texts), int))
    got = {(texts[q], texts[w], s) for q, w, s in zip(query, word, shared)}
    want = {(a, b, next(i for i in range(3) if a[i] != b[i])) for a in texts for b in texts if one_edit(a, b)}
    assert got == want and len(query) == len(want)


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]"


def luhn(digits):
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def brute_base(text):
    found = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((kind, m.start(), m.end(), m[0]))
    return found


def lowered(text):
    return "".join(c.lower() if c < "\x80" else c for c in text)


def brute_personal(rows):
    """Spans of each row, by the definitions."""
    kinds = list(op12_disclosure.KINDS)
    together, mentions, counts = {}, {}, {}
    for _, text in rows:
        text = text or ""
        for w in re.findall(TERM + "{3,}", lowered(text)):
            counts[w] = counts.get(w, 0) + 1
        spans = brute_base(text)
        for kind in PLAIN:
            # Contexts end at the same kind's neighbouring matches, valid or not.
            every = [m.span() for m in re.finditer(PLAIN[kind], text)]
            for _, start, end, value in (s for s in spans if s[0] == kind):
                i = every.index((start, end))
                before = text[(every[i - 1][1] if i else 0):start]
                after = text[end:(every[i + 1][0] if i + 1 < len(every) else len(text))]
                if len(before) >= 100:
                    before = re.sub("^" + TERM + "+", "", before[-100:])
                if len(after) >= 100:
                    after = re.sub(TERM + "+$", "", after[:100])
                name = re.sub("[^0-9]", "", value) if kind in ("card", "phone") else lowered(value)
                e = (kind, name)
                mentions[e] = mentions.get(e, 0) + 1
                near = re.findall(TERM + "{3,}", lowered(before))[-5:] + re.findall(TERM + "{3,}", lowered(after))[:5]
                for t in set(near):
                    together[t, e] = together.get((t, e), 0) + 1
    total, share = sum(counts.values()), {}
    for (t, e), n in together.items():
        if n >= 3 and mentions[e] < total:
            part = math.log(min(n, counts[t]) * total / (counts[t] * mentions[e])) / math.log(total / mentions[e])
            if part >= op12_disclosure.DISCLOSE:
                share[t] = max(share.get(t, (0, 0)), (part, -kinds.index(e[0])))
    result = []
    for doc_id, text in rows:
        base = brute_base(text)
        terms = [("term", m.start(), m.end()) for m in re.finditer(TERM + "+", lowered(text or "")) if m[0] in share]
        terms = [t for t in terms if not any(s[1] < t[2] and t[1] < s[2] for s in base)]
        listed = [f"{k}:{a}:{b}" for k, a, b, *_ in sorted(base + terms, key=lambda s: (kinds.index(s[0]), s[1]))]
        n = [sum(s[0] == k for s in base) for k in PLAIN]
        digest = hashlib.sha256(",".join(x for x in listed if not x.startswith("term")).encode()).hexdigest()
        result.append((doc_id, *n, digest, ",".join(listed)))
    return sorted(result, key=repr), share


def personal(spark, documents, rows):
    docs = documents(rows).repartition(3)
    found = op12_disclosure.personal_data(docs)
    return docs, found, sorted(map(tuple, op12_disclosure.digests(found).collect()), key=repr)


def test_patterns_equal_the_plain_ones(spark, documents, rng):
    rows = []
    for i in range(400):
        alphabet = rng.choice(["a.@_%é -", "12.56 ", "0123456789 -", "+12 ().-x", "a1@.-+ 😀\n_"])
        rows.append((i, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))))
    rows += [(1000, "_a@b.c_d@e.f.g_h@i"), (1001, "4111 1111-1111 1111 x 4111111111111112"), (1002, "1.2.3.4.5.6.7.8 256.1.1.1 001.0000255.0.0"), (1003, "+1 (523) 555-1055. +1-2")]
    rows += [(1004, "7" * 3000), (1005, "a" * 3000 + "@"), (1006, "x@" + "b." * 3000), (1007, "1 " * 3000), (1008, None), (1008, None), (None, "a@b.c"), (1009, "q@r.st " * 300)]
    got = personal(spark, documents, rows)[2]
    want = brute_personal(rows)[0]
    assert [r[:6] for r in got] == [r[:6] for r in want]


def test_patterns_take_linear_time(spark, documents):
    n = 300_000
    rows = [(1, "7" * n), (2, "a" * n + "@"), (3, "x@" + "b." * n), (4, "1 " * n), (5, "+1" + " " * n), (6, "a@b.c " * 20_000)]
    got = {r[0]: r[1:5] for r in personal(spark, documents, rows)[2]}
    assert got == {1: (0, 0, 0, 0), 2: (0, 0, 0, 0), 3: (1, 0, 0, 0), 4: (0, 0, 0, 0), 5: (0, 0, 0, 0), 6: (20_000, 0, 0, 0)}


def test_disclosing_terms_equal_brute_force(spark, documents, rng):
    common = ["the", "and", "for", "with", "from", "into", "über", "haus"]
    prose = lambda n: " ".join(rng.choice(common) for _ in range(n))
    rows = [(i, prose(80)) for i in range(30)]
    rows += [(100 + i, f"{prose(20)} Zaphod writes from Za.phod@mail.example.com, {prose(3)} Trillian {prose(30)}") for i in range(6)]
    rows += [(200 + i, f"{prose(20)} Marvin +1 (523) 555-1055 {prose(40)} {'Marvin' * (i == 0)}") for i in range(4)]
    rows += [(300, f"ZAPHOD's, xZaphod {prose(10)}"), (301, "only once 10.0.0.1 unique"), (302, None), (303, ""), rows[31], (None, rows[32][1])]
    docs, found, got = personal(spark, documents, rows)
    want, share = brute_personal(rows)
    assert got == want
    assert "zaphod" in share and "unique" not in share and "the" not in share
    texts = {r.doc_id: r.text for r in op12_disclosure.sanitised(docs, found).collect()}
    assert texts[302] is None and texts[303] == "" and texts[0] == rows[0][1]
    assert "@" not in texts[100] and "aphod" not in texts[100] and "[email]" in texts[100] and "xZaphod" in texts[300]
    assert "555" not in texts[201] and "[phone]" in texts[201]


def test_sanitised_text_with_many_and_overlapping_spans(spark, documents):
    text = "+1 4111 1111 1111 1111, a@b.c " * 500 + "tail"
    docs, found, _ = personal(spark, documents, [(1, text), (2, "none")])
    got = {r.doc_id: r.text for r in op12_disclosure.sanitised(docs, found).collect()}
    covered = np.zeros(len(text), bool)
    for _, start, end, _ in brute_base(text):
        covered[start:end] = True
    left = "".join(c for c, gone in zip(text, covered) if not gone)
    assert re.sub(r"\[[a-z]+\]", "", got[1]) == left and got[2] == "none"


def test_nothing_personal(spark, documents):
    assert personal(spark, documents, [])[2] == []


def test_disclosure_runs_no_python(spark, documents):
    found = op12_disclosure.digests(op12_disclosure.personal_data(documents([(1, "a@b.c")] * 4)))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_passages_equal_brute_force(documents, rng):
    lines = [" ".join(rng.choice("abcdefg") * 2 for _ in range(rng.choice([1, 3, 9, 25]))) for _ in range(30)]
    rows = []
    for i in range(40):
        start = rng.randint(0, 20)
        own = [f"own {i} {k}" for k in range(3)]
        rows.append((i, "\n".join(rng.choice([own[:1] + lines[start:start + 6] + [""] + own, own + [rng.choice(lines)] + own, lines[:2] + ["  "] + lines[2:5]]))))
    seen, want = set(), []
    for doc, text in rows:
        start, run = 0, []
        for line in [*text.split("\n"), None]:
            normal = None if line is None else " ".join(line.lower().split())
            if normal and normal in seen:
                run.append((doc, start, start + len(line), len(normal.split())))
            elif normal != "":
                total = sum(r[3] for r in run)
                want += [(*r[:3], total) for r in run] if total >= 12 else []
                run = []
                seen.add(normal)
            start += len(line or "") + 1
    got = op10_lines.repeated_passages(documents(rows).repartition(3), "line", 12).collect()
    assert sorted((r.doc_id, r.start, r.end, r.passage_words) for r in got) == sorted(want) and want
    # Sentences: a passage that begins and ends inside lines.
    shared = "Far over hills they went. And back again, all of them, with drums and pipes and banners! So it was told to us by the eldest one."
    inner = [(1, f"Own made. {shared} Mine."), (2, f"others made.  {shared} Theirs.\nof."), (3, "of.")]
    found = op10_lines.repeated_passages(documents(inner))
    assert {(r.doc_id, r.passage_words) for r in found.collect()} == {(2, len(shared.split()))}
    assert [r.text for r in op10_lines.remove_units(documents(inner), found).collect() if r.doc_id == 2] == ["others made. Theirs.\nof."]
    # A lone short line stays wherever it is repeated; a copied row goes as a whole, nulls and all.
    long = "\n".join(lines[:6])
    odd = documents([(1, "of."), (2, "of."), (3, "x\nof.\ny"), (None, long), (None, long), (None, None), (4, "")])
    assert {(r.doc_id, r.copy) for r in op10_lines.repeated_passages(odd).collect()} == {(None, 1)}
    assert op10_lines.repeated_passages(documents([])).collect() == []


def test_passages_cut_at_every_sentence(documents):
    """Sentences that end in any letter, a digit or a bracket are units; the copy that stays is reported."""
    shared = ["Six ships lay in the bay.", "They had come from far off (so it was said).", "Nobody knew how many were on board in 1903.", "Still more were to follow!"]
    rows = [(1, f"Own begin. {' '.join(shared)} Mine."), (2, f"Some other text\nand more of it. {' '.join(shared)} Theirs."), (3, "Nothing of that kind. Theirs.")]
    found = op10_lines.repeated_passages(documents(rows), every=True).collect()
    texts = dict(rows)
    assert {(r.doc_id, texts[r.doc_id][r.start:r.end].strip(), r.removed) for r in found} == {
        (1, s, False) for s in shared} | {(2, s, True) for s in shared} | {(2, "Theirs.", False)}
    cut = op10_lines.remove_units(documents(rows), op10_lines.repeated_passages(documents(rows), every=True)).collect()
    assert {r.doc_id: r.text for r in cut} == texts | {2: "Some other text\nand more of it. Theirs."}

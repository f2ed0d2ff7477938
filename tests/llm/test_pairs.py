"""Substring, unit, near-duplicate and vector operators against brute force."""

import hashlib
import math
from collections import Counter

import numpy as np

from rulemill.llm import links, op01_substrings, op06_forest, op08_minhash, op10_lines, rlbwt

from .conftest import VOCABULARY, prose


def test_run_length_index(rng):
    for _ in range(60):
        alphabet = rng.choice([b"ab", b"a", bytes(range(70, 90)), bytes([0, 255])])
        pieces = [bytes(rng.choice(alphabet) for _ in range(rng.randint(1, 25))) for _ in range(rng.randint(1, 5))]
        pieces.append(pieces[0] + b"z" + pieces[0])
        found = rlbwt.RunLengthIndex(pieces).matching_statistics()
        places = [(i, j) for i, p in enumerate(pieces) for j in range(len(p) + 1)]

        def common(a, b):
            one, other = pieces[a[0]][a[1]:], pieces[b[0]][b[1]:]
            return next((n for n, (x, y) in enumerate(zip(one, other)) if x != y), min(len(one), len(other)))

        assert found.tolist() == [max(common(a, b) for b in places if b != a) for a in places]


def repeated(rows, window):
    seen = Counter()
    for _, text in rows:
        data = (text or "").encode()
        seen.update(data[i:i + window] for i in range(len(data) - window + 1))
    out = Counter()
    for doc, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data) + 1)
        for i in range(len(data) - window + 1):
            if seen[data[i:i + window]] > 1:
                gone[i:i + window] = b"\1" * window
        spans = sum(1 for i in range(len(data)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[doc, len(data), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(data, gone) if not g)).hexdigest()] += 1
    return out


def test_substrings(documents, rng):
    rows = [(i, prose(rng, VOCABULARY[:7], rng.randint(0, 60))) for i in range(40)]
    shared = prose(rng, VOCABULARY, 30)
    rows += [(100 + i, rows[i][1][:40] + shared + rows[i + 1][1][5:30]) for i in range(15)]
    rows += [(200, None), (201, ""), (202, "a" * 500), (203, "ab" * 300), (204, "x" * 6000), (5, rows[5][1]), (None, rows[6][1]), (206, rows[7][1]), (206, rows[8][1])]
    for hot in (1 << 21, 60):
        got = op01_substrings.repeated_substrings(documents(rows), 20, 7, hot).collect()
        assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == repeated(rows, 20)
    assert op01_substrings.repeated_substrings(documents([])).collect() == []


def test_units(documents):
    line = " ".join(VOCABULARY[:25])
    rows = [(3, f"short\n{line}\nend"), (1, f"{line.upper()}  \nother"), (2, f"{line}\n{line}"), (2, f"{line}\n{line}"), (None, line), (4, None), (5, ""), (6, "short")]
    docs = documents(rows)
    got = op10_lines.repeated_units(docs, min_words=20).collect()
    assert sorted((r.doc_id or 0, r.start, r.end) for r in got) == sorted([
        (3, 6, 6 + len(line)), *[(2, 0, len(line)), (2, len(line) + 1, 2 * len(line) + 1)] * 2, (0, 0, len(line)),
    ])
    assert {(r.kept_doc_id, r.kept_start, r.n) for r in got} == {(1, 0, 7)}
    once = documents(rows[:3])
    cut = {r.doc_id: r.text for r in op10_lines.remove_units(once, op10_lines.repeated_units(once)).collect()}
    assert cut == {3: "short\nend", 1: rows[1][1], 2: ""}
    assert op10_lines.repeated_units(documents([])).collect() == []
    assert list(op10_lines.units("a b\n\nc d", "paragraph", 2)) == [(0, 3, "a b"), (5, 8, "c d")]


def test_short_units(documents):
    wrapped = [" ".join(VOCABULARY[i:i + 12]) for i in range(0, 60, 12)]
    rows = [(1, "\n".join([*wrapped, "own"])), (2, "\n".join(["other", *wrapped])), (3, "one two\n\n \nOther "), (4, "one  two\n\n \none two"), (5, "\n\n")]
    seen, want = set(), []
    for doc, text in rows:
        start = 0
        for line in text.split("\n"):
            normal = " ".join(line.lower().split())
            if normal in seen:
                want.append((doc, start, start + len(line)))
            elif normal:
                seen.add(normal)
            start += len(line) + 1
    found = op10_lines.repeated_units(documents(rows))
    assert sorted((r.doc_id, r.start, r.end) for r in found.collect()) == want and len(want) == 8
    cut = {r.doc_id: r.text for r in op10_lines.remove_units(documents(rows), found).collect()}
    assert cut[2] == "other\n" and cut[3] == "one two\n\n \n" and cut[4] == "\n \n" and cut[5] == "\n\n"


def smallest_reachable(nodes, pairs):
    root = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


def test_components(spark, rng):
    pairs = [(i, i + 1) for i in range(100, 130)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)]
    got = {r.node: r.root for r in links.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    root = smallest_reachable(linked, [p for p in pairs if p[0] != p[1]])
    assert got == root


def shingles(text, k=4):
    found = (text or "").encode().lower().split()
    return {tuple(found[i:i + k]) for i in range(len(found) - k + 1)} if len(found) >= k else ({tuple(found)} if found else set())


def near_rows(rng):
    rows = []
    for g in range(12):
        base = prose(rng, VOCABULARY, rng.randint(3, 80)).split()
        for c in range(rng.randint(1, 6)):
            words = list(base)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(VOCABULARY)
            rows.append((len(rows) * 3 + 7, " ".join(words)))
    return rows + [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "One  TWO"), (905, rows[0][1].upper()), (rows[1][0], rows[1][1]), (None, rows[0][1]), (906, "w " * 3000)]


def test_minhash(documents, rng):
    rows = near_rows(rng)
    sets = {d: shingles(t) for d, t in rows if d is not None}
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = smallest_reachable(sets, pairs)
    got = op08_minhash.near_duplicates(documents(rows)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == Counter(
        (d, len(shingles(t)), root[d] if d is not None else None, d is None or root[d] == d) for d, t in rows)
    assert op08_minhash.near_duplicates(documents([])).collect() == []


def test_block_links(spark, rng):
    """Families in blocks of a few texts join the components that all pairs join."""
    rows = [(i % 2, d % 5, d, t.encode()) for i, (d, t) in enumerate(near_rows(rng)) if d is not None and t]
    sets = {(f, r, d): shingles(t.decode()) for f, r, d, t in rows}
    pairs = {(x[2], y[2]) for x in sets for y in sets if x[0] == y[0] and x[1] != y[1] and sets[x] & sets[y] and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y])}
    members = spark.createDataFrame(rows, "family long, root long, doc_id long, text binary")
    for size in (1500, 1 << 20):
        got = {(r.a, r.b) for r in op08_minhash.block_links(members, 4, 80, size).collect()}
        assert pairs and got <= pairs
        merged = [smallest_reachable(range(5), [(a % 5, b % 5) for a, b in some]) for some in (got, pairs)]
        assert merged[0] == merged[1]


def test_minhash_hot_group(documents, rng):
    """Near copies of one text in ever new wording stay one group without all their pairs."""
    base = prose(rng, VOCABULARY, 60).split()
    rows = []
    for i in range(150):
        words = list(base)
        words[rng.randrange(60)] = f"w{i}"
        rows.append((i, " ".join(words)))
    got = op08_minhash.near_duplicates(documents(rows)).collect()
    assert {r.component_id for r in got} == {0}


def test_forest(spark, rng):
    make = np.random.default_rng(4)
    rows = []
    for c in range(30):
        centre = make.normal(size=16)
        for _ in range(rng.randint(1, 5)):
            rows.append((len(rows) * 2, c % 3, [float(x) for x in (centre + make.normal(size=16) * rng.choice([0.02, 0.12])).astype(np.float32)]))
    rows += [(1001, 0, None), (1003, 0, []), (1005, 0, [0.0] * 16), (1007, 0, [1.0, None] * 8), (1009, 0, [math.nan] * 16), (1011, 0, [math.inf] * 16), (1013, None, rows[0][2]),
             (1015, rows[0][1], rows[0][2]), (1017, rows[0][1], [2 * x for x in rows[0][2]]), (1019, 0, [1.0, 2.0]), (1021, 0, [2.0, 4.0]), (None, rows[0][1], rows[0][2])]
    good = [r for r in rows if r[0] is not None and r[1] is not None and r[2] and not any(x is None or not math.isfinite(x) for x in r[2]) and any(r[2])]

    def cosine(a, b):
        a, b = np.array(a), np.array(b)
        return a @ b / math.sqrt(a @ a) / math.sqrt(b @ b)

    pairs = [(a[0], b[0]) for a in good for b in good if a[0] < b[0] and a[1] == b[1] and len(a[2]) == len(b[2]) and cosine(a[2], b[2]) >= 0.98]
    assert len(pairs) > 40
    root = smallest_reachable([r[0] for r in rows], pairs)
    count = Counter(x for p in pairs for x in p)
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, label int, embedding array<float>, leaf int")
    want = Counter((d, count[d] if d is not None else 0, root[d], d is None or root[d] == d) for d, *_ in rows)
    got = op06_forest.near_vectors(table).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == want
    # Small leaves: every split may part a pair, spill and trees find most again, blocks count once.
    got = {r.vec_id: r for r in op06_forest.near_vectors(table, leaf=8, max_leaf=12).collect()}
    found = sum(r.n_links for r in got.values())
    assert 0.9 * 2 * len(pairs) <= found <= 2 * len(pairs)
    assert all(got[d].n_links <= count[d] for d in got if d is not None)
    assert op06_forest.near_vectors(table.limit(0)).collect() == []

"""Row-wise operators and the pipeline: brute force, round trips and accuracy."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rulemill.llm import op02_toxicity, op03_templates, op04_dac, op05_licenses, op07_language, op09_mixing
from rulemill.llm.textbytes import NOT_ALNUM, SPACE, slices, words

from .conftest import VOCABULARY, prose

ODD = [(900, None), (901, ""), (902, " \n\t"), (903, "x" * 20000), (904, "é" * 3000 + " end"), (None, "no name here"), (905, "twice"), (905, "twice")]


def test_words(rng):
    known: dict = {}
    texts = [None, "", "a b  c\nd", "É à a-B_c9"] + ["".join(rng.choice("ab \n\tcdéZ-9") for _ in range(rng.randint(0, 60))) for _ in range(200)]
    for limit in (40, 1 << 20):
        for part in slices(pa.array(texts), limit):
            for separators, pattern in ((SPACE, r"[^\x20\x09-\x0D]+"), (NOT_ALNUM, "[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
                found = words(part, separators)
                hashes = found.hashes(part)
                for row in range(part.hi - part.lo):
                    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in texts[part.lo + row] or "")
                    want = re.findall(pattern, text)
                    a, b = found.first[row:row + 2]
                    assert [part.data[x:y].tobytes().decode().lower() for x, y in zip(found.starts[a:b], found.ends[a:b])] == [w.lower() for w in want]
                    for w, h in zip(want, hashes[a:b]):
                        assert known.setdefault(w, h) == h
    assert len(set(map(int, known.values()))) == len(known)


def test_dac_round_trip():
    make = np.random.default_rng(1)
    for n in (0, 1, 511, 512, 513, 5000):
        ids = (make.integers(0, 1 << 32, n, dtype=np.uint64) >> make.integers(0, 32, n).astype(np.uint64)).astype(np.uint32)
        codes = op04_dac.Segment(n, *op04_dac.encode(ids))
        assert codes.all().tolist() == ids.tolist() if n else True
        assert [codes.token(i) for i in range(n)] == ids.tolist()
    with pytest.raises(IndexError):
        codes.token(5000)


def test_token_files(spark, documents, rng, monkeypatch):
    tokenizers = pytest.importorskip("tokenizers")
    pytest.importorskip("public_tokenizers")
    path = op04_dac.default_tokenizer()
    coder = tokenizers.Tokenizer.from_file(path)
    rows = [(i * 2, prose(rng, ["Some", "ÉÀ", "don't", "3.5,", "<|endoftext|>", " x", "über."], rng.randint(0, 50))) for i in range(80)] + ODD
    files = op04_dac.write_tokens(documents(rows).repartition(3), path)
    got = op04_dac.read_documents(files).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    want, position, stream = [], 0, []
    for doc, text in order:
        ids = coder.encode(text or "", add_special_tokens=False).ids + [1]
        want.append((doc, position, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        position += len(ids)
        stream += ids
    assert Counter((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == Counter(want)
    asked = spark.createDataFrame([(i,) for i in range(0, position, 37)], "position long")
    assert all(stream[r.position] == r.token for r in op04_dac.token_at(files, asked).collect())
    assert op04_dac.token_files(spark, documents([])).collect() == []
    other = __import__("public_tokenizers").path("byte_bpe_50k.json")
    assert not op04_dac.WordIds(other).by_runs


def test_licenses(documents):
    rows = ODD + [
        (1, "Code. Released under the MIT License. More MIT\nLICENSE, mit license"), (2, "This program is free software: you can redistribute it and or modify it, under the terms of the GNU General Public License"),
        (3, "Licensed under CC BY-NC 4.0."), (4, "mit licenses and apache"), (5, "Redistribution and use in source and also binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ]
    got = {(r.doc_id, r.n_words): r for r in op05_licenses.license_scan(documents(rows)).collect()}
    assert sum(1 for _ in got) == len(set(rows))
    by_id = {k[0]: r for k, r in got.items()}
    assert tuple(by_id[1])[1:] == (11, 3, 4, 9, "mit", "mit", 1.0)
    assert by_id[2].labels == "gpl" and by_id[3].labels == "cc-by-nc" and by_id[3].n_base == 0 and by_id[3].score == 1.0
    assert by_id[4].labels == "" and by_id[4].score == 0.0 and by_id[5].labels == "bsd"
    assert by_id[900].n_words == 0 and by_id[900].first_word is None
    assert op05_licenses.license_scan(documents([])).collect() == []


def test_templates(spark, documents):
    item = "Yesterday Zed bought 5 apples for 9 dollars and then gave Zed 4 more of them."
    items = spark.createDataFrame([(9, item), (10, None), (11, "Short one here and"), (None, "")], "item_id long, text string")
    rows = ODD + [
        (1, "Now hear: Yesterday Alice bought 7 apples for 3 dollars and then gave Alice 2 more of them. End."),
        (2, "Now hear: Yesterday Bob bought 1,200.5 apples for 3 dollars and then gave Carol 2 more of them. End."),
        (3, "apples for 9 dollars and then something else altogether happens to all of these words"), (4, f"xx {item} yy"), (4, f"xx {item} yy"), (5, "short one here, and"),
    ]
    got = {(r.doc_id, r.item_id): r for r in op03_templates.contamination(documents(rows), items).collect()}
    assert set(got) == {(1, 9), (2, 9), (4, 9), (5, 11)}
    assert got[1, 9].reparameterised and got[1, 9].consistent and got[1, 9].covered_words == 16
    assert not got[2, 9].consistent and got[2, 9].covered_words == 14
    assert not got[4, 9].reparameterised
    kept = [r.doc_id for r in op03_templates.decontaminate(documents(rows), items).collect()]
    assert Counter(kept) == Counter(r[0] for r in ODD + [(3,)])
    assert op03_templates.contamination(documents([]), items).collect() == []
    assert op03_templates.contamination(documents(rows), items.limit(0)).collect() == []


def found_items(spark, documents, items, rows):
    table = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in op03_templates.contamination(documents(rows), table).collect()}


def test_templates_slot_dense(spark, documents):
    items = ["Alice bought 3 kg and Bob bought 5 kg", "Compute 12 + 34 * 56 - 78 / 9"]
    got = found_items(spark, documents, items, [
        (1, f"xx yy. {items[0]}. zz"), (2, f"here: {items[1]} and more"), (3, "We saw that Carol bought 7 kg and Dan bought 2 kg there."),
        (4, "table 12 35 56 79 9 10 11"), (5, "Alice sold 3 kg"),
    ])
    assert set(got) == {(1, 0), (2, 1), (3, 0)}
    assert not got[1, 0].reparameterised and got[3, 0].reparameterised and got[3, 0].consistent and got[3, 0].cover == 1


def test_templates_sentence_names(spark, documents):
    items = ["Tom has 5 apples. Tom gives 2 to Ann. How many apples does Tom have?"]
    got = found_items(spark, documents, items, [
        (1, "Bob has 7 apples. Bob gives 3 to Sue. How many apples does Bob have?"), (2, "we ask: if Bob has 7 apples\nBob gives 3 to Sue. How many apples does Bob have?"),
        (3, "so Tom has 5 apples. Tom gives 2 to Ann. how many apples does Tom have?"), (4, "Bob has 7 pears. Sue eats 3 of Tom. How many pears are there?"),
    ])
    assert {k[0] for k in got} == {1, 2, 3}
    assert got[1, 0].covered_words == 15 and got[1, 0].consistent and got[1, 0].reparameterised


def test_templates_shifted(spark, documents, rng):
    order = rng.sample(VOCABULARY, 24)
    plain = " ".join(order)
    named = "yesterday Bob went from Paris to the river and then saw that Bob had lost the keys"
    inserted, dropped, changed = (" ".join([*order[:12], *x]) for x in (["new", *order[12:]], order[13:], ["new", *order[13:]]))
    got = found_items(spark, documents, [plain, named], [
        (1, f"aa {inserted} bb"), (2, dropped), (3, changed), (4, "yesterday Ann Lee Smith went from New York to the river and then saw that Ann Lee Smith had lost the keys"),
        (5, " ".join(order[:9])), (6, " ".join(order[:9] + ["zz"] * 5)),
    ])
    assert {k: r.covered_words for k, r in got.items()} == {(1, 0): 24, (2, 0): 23, (3, 0): 23, (4, 1): 17}
    assert got[4, 1].consistent and got[4, 1].reparameterised


def test_templates_short_items(spark, documents):
    items = ["Who painted Guernica?", "guernica", "Is 7 odd?"]
    got = found_items(spark, documents, items, [
        (1, "Then we ask: who painted Guernica? Some say otherwise, in a long text."), (2, "First of all, tell me who painted Guernica and when"),
        (3, "who painted the house"), (4, "Now is 9 odd? It is."),
    ])
    assert set(got) == {(1, 0), (1, 1), (2, 0), (2, 1), (4, 2)}


def test_toxicity_accuracy(spark, documents, rng):
    slurs = ["vilezor", "vilemak", "drosk"]
    rows, toxic = [], {}
    for i in range(600):
        bad = i % 6 == 0
        text = prose(rng, VOCABULARY, rng.randint(20, 60)).split()
        for _ in range(rng.randint(2, 4) if bad else 0):
            text[rng.randrange(len(text))] = rng.choice(slurs) + rng.choice(["", "."])
        rows.append((i, " ".join(text)))
        toxic[i] = int(bad)
    labels = spark.createDataFrame([(i, 1, t) for i, t in toxic.items()] + [(0, 0, 1), (5000, 0, 1), (None, 0, 1), (900, 0, None)], "doc_id long, quality int, toxic int")
    docs = documents(rows + ODD)
    got = op02_toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(rows) + len(ODD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got if r.doc_id is not None)
    judged = [(toxic[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in toxic]
    assert sum(a == b for a, b in judged) / len(judged) > 0.97 and sum(b for a, b in judged if a) / sum(a for a, _ in judged) > 0.9
    # Held-out labels are never read.
    other = labels.withColumn("toxic", F.when(op02_toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert {(r.doc_id, round(r.score, 9)) for r in op02_toxicity.toxicity(docs, other).collect()} == {(r.doc_id, round(r.score, 9)) for r in got}
    assert op02_toxicity.toxicity(documents([]), labels).collect() == []
    assert len(op02_toxicity.toxicity(docs, labels.limit(0)).collect()) == len(got)


def languages(rng):
    texts = {"en": ["the", "and", "with", "house", "thing", "other"], "de": ["und", "der", "nicht", "haus", "schön", "auch"], "fr": ["les", "avec", "maison", "être", "pour", "dans"]}
    return [(i, prose(rng, texts[lang], 40), lang, f"s{i % 4}") for i, lang in enumerate(list(texts) * 20)]


def test_language(spark, documents, rng):
    rows = languages(rng)
    docs = documents(rows + [(900, None, None, None), (901, "", "xx", "s1"), (902, "12 34", None, None)])
    html = "<html lang='{}'><script>the and with</script><p>{}</p></html>"
    pages = spark.createDataFrame([
        *[(i, f"https://{lang}.site.org/{lang}/x", html.format(lang, text)) for i, text, lang, _ in rows],
        (100, "https://de.site.org/x", html.format("en", rows[1][1])), (101, None, None), (102, "", "<p>1 2 3</p>"), (103, "https://de.site.org/", "<html><p>12</p></html>"), (100, "https://de.site.org/x", html.format("en", rows[1][1])),
    ], "page_id long, url string, html string")
    got = defaultdict(list)
    for r in op07_language.page_languages(pages, docs).collect():
        got[r.page_id].append(r)
    assert all(got[i][0].lang == lang for i, _, lang, _ in rows)
    assert [r.lang for r in got[100]] == ["de", "de"] and got[100][0].declared == "en"
    assert got[101][0].lang == got[102][0].lang == "und"
    assert op07_language.page_languages(pages.limit(0), docs).collect() == []
    assert {r.lang for r in op07_language.page_languages(pages, documents([])).collect()} == {"und"}
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs, "").collect()}
    assert kept == {r[0] for r in rows}


def filled(sizes, weights, most=3):
    """Targets by repeated resharing."""
    total, capped = sum(sizes), {}
    while True:
        left = total - sum(capped.values())
        open_ = [i for i in range(len(sizes)) if i not in capped]
        weight = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / weight > most * sizes[i]]
        if not over:
            return [capped.get(i, left * weights[i] / weight if weight else 0) for i in range(len(sizes))]
        capped |= {i: most * sizes[i] for i in over}


def test_mixing(documents, rng):
    rows = [(i, prose(rng, VOCABULARY, rng.randint(1, 30)), "en", s) for i, s in enumerate(["a"] * 5 + ["b"] * 60 + ["c"] * 3 + ["é"] * 20 + ["Z"] * 9)]
    rows += [(200, "one two", "en", None), (201, None, "en", "b"), (202, "", "en", "empty"), (None, "three words here", "en", "b"), rows[7], rows[7]]
    got = op09_mixing.mix(documents(rows)).collect()
    assert len(got) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    names = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    sizes = [sum(size(r[1]) for r in rows if r[3] == s) for s in names]
    targets = filled(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))])
    taken = Counter()
    for r in got:
        i = names.index(r.source)
        assert r.source_size == sizes[i] and abs(r.target - targets[i]) < 1e-6 and 0 <= r.taken <= 3 * r.size
        assert (r.position is None) == (r.taken == 0) and (r.position is None or 0 <= r.position < 1)
        taken[r.source] += r.taken
    assert all(abs(taken[s] - t) <= 4 for s, t in zip(names, targets))
    again = op09_mixing.mix(documents(rows[::-1]).repartition(5)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    order = op09_mixing.training_order(documents(rows)).collect()
    assert Counter(r.doc_id for r in order) == sum((Counter({r.doc_id: r.copies}) for r in got), Counter())
    assert op09_mixing.mix(documents([])).collect() == []


def test_position_inverts_demand(spark):
    for slope in op09_mixing.SLOPES:
        for row in spark.range(11).select(F.col("id") / 10, op09_mixing.position(F.col("id") / 10, F.lit(slope))).collect():
            assert abs((1 - slope) * row[1] + slope * row[1] ** 2 - row[0]) < 1e-9


def test_pipeline(spark, rng, tmp_path):
    pytest.importorskip("public_tokenizers")
    rows = [(*r, len(r[1])) for r in languages(rng)]
    rows += [(300, rows[0][1], "en", "s0", 1), (301, rows[1][1] + " extra", "de", "s0", 1), (302, None, None, None, None), (303, "", None, "s1", 0)]
    item = prose(rng, VOCABULARY, 25)
    rows += [(304, f"the and with house {item} thing other the and", "en", "s2", 1), (5, rows[5][1], "fr", "s1", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "mixing", "token_output"]
    kept = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = []
    for _, apply in corpus_pipeline.STAGES[:4]:
        kept = apply(spark, kept, str(tmp_path))
        assert kept.columns == docs.columns
        seen.append(Counter(r.doc_id for r in kept.collect()))
    assert 302 not in seen[0] and 303 not in seen[0] and {300, 301, 304} <= set(seen[0])
    assert not {300, 301} & set(seen[1]) and set(seen[1].values()) == {1} and {0, 1, 5, 304} <= set(seen[1])
    assert seen[2] == seen[1] - Counter([304])
    assert set(seen[3]) <= set(seen[2])
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in got) == seen[3]
    starts = sorted((r.start, r.n_tokens) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))


def test_near_dedup_tells_rows_apart(spark, documents, rng):
    one, two, three = (prose(rng, VOCABULARY, 40) for _ in range(3))
    rows = [(1, one), (1, two), (None, three), (None, three), (None, three), (2, one + " end"), (3, ""), (3, ""), (4, None), (None, None), (5, one, "de", "s")]
    docs = documents(rows)
    got = corpus_pipeline.near_dedup(spark, docs, "")
    assert got.columns == docs.columns
    want = Counter([(1, one), (1, two), (None, three), (3, ""), (4, None), (None, None)])
    assert Counter((r.doc_id, r.text) for r in got.collect()) == want
    assert corpus_pipeline.near_dedup(spark, documents([]), "").collect() == []


def test_every_language_is_sampled(documents):
    rows = [(i, f"text {i}", f"l{i % 300}") for i in range(900)] + [(1000 + i, "hot", "l0") for i in range(500)] + [(None, "x", "l1"), (2000, None, "l2"), (2001, "x", ""), (2002, "x", None)]
    got = Counter(r.lang for r in op07_language.labelled_sample(documents(rows), 100).collect())
    assert len(got) == 300 and got["l0"] == 100 and all(n == 3 for lang, n in got.items() if lang != "l0")


def test_lowest_sorts_a_bounded_share(spark):
    rows = spark.range(20000).select("id", F.col("id").alias("doc_id")).unionByName(spark.range(9000).select("id", F.lit(None).cast("long").alias("doc_id")))
    twice = rows.unionByName(rows)
    few = op02_toxicity.lowest(twice, "x", 300, F.max("id"))
    got = [(r.doc_id, r.value) for r in few.collect()]
    place = {r.doc_id: r.p for r in rows.filter("doc_id is not null").select("doc_id", op02_toxicity._place("x").alias("p")).collect()}
    assert got == [(i, i) for i in sorted(place, key=lambda i: (place[i], i))[:300]]
    assert len(op02_toxicity.lowest(rows, "x", 50000, F.max("id")).collect()) == 20000
    assert op02_toxicity.lowest(rows.limit(0), "x", 5, F.max("id")).collect() == []

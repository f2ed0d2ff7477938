from datetime import datetime, timezone
import glob
import os

import pytest
from pyspark.sql import functions as F

from rulemill import fixed
from rulemill.operators import history, refresh, stats
from rulemill.operators.parse import comment_rows, parse_rules, type_rules
from rulemill.plans import editions, manifest
from rulemill.sources import lists, registry
from rulemill.streaming.refresh import refresh as run_refresh

REGISTRY = "name string, url string, priority int, lite boolean, enabled boolean, source_ord int"


def sources_of(spark, rows):
    return spark.createDataFrame(
        [(n, f"http://x/{n}", p, lite, on, i) for i, (n, p, lite, on) in enumerate(rows)], REGISTRY
    )


def test_registry_order_defaults_and_lite(spark):
    sources = sources_of(spark, [
        ("c", 3, True, True), ("a", 1, None, None), ("off", 2, True, False), ("b", 1, False, True), ("d", 1, True, None),
    ])
    assert [r.name for r in registry.active_sources(sources).collect()] == ["a", "b", "d", "c"]
    assert [r.name for r in registry.active_sources(sources, lite=True).collect()] == ["d", "c"]
    numbered = registry.source_catalogue(sources, bucket_size=2).orderBy("number").collect()
    assert [(r.number, r.name) for r in numbered] == [(1, "c"), (2, "off"), (3, "d"), (4, "a"), (5, "b")]


def test_registry_rejects_repeated_names(spark):
    sources = sources_of(spark, [("a", 1, True, True), ("a", 2, True, True)])
    with pytest.raises(Exception, match="source listed twice"):
        registry.active_sources(sources).collect()


def land(root, run, texts):
    for name, data in texts.items():
        folder = root / f"run_id={run}" / f"source={name}"
        folder.mkdir(parents=True)
        (folder / "list.txt").write_bytes(data if isinstance(data, bytes) else data.encode())


def test_read_lists_decodes_and_joins(spark, tmp_path):
    land(tmp_path, "1", {"Fan's List": b"||a.com^\xff\n", "2024": "\ufeff[x]\n", "unknown": "||z.com^\n", "off": "||o.com^\n"})
    sources = sources_of(spark, [("2024", 2, True, True), ("Fan's List", 1, None, True), ("off", 1, None, False)])
    rows = {r.source: r for r in lists.read_lists(spark, str(tmp_path), sources).collect()}
    assert {k: (r.text, r.priority, r.lite, r.run_id) for k, r in rows.items()} == {
        "Fan's List": ("||a.com^\ufffd\n", 1, False, "1"), "2024": ("\ufeff[x]\n", 2, True, "1"),
    }


def test_split_files_give_the_same_rules(spark, tmp_path):
    text = "".join(f"! c{i}\n||r{i}.example.com^\x0b0.0.0.0 h{i}\r\n" for i in range(3000))
    land(tmp_path, "1", {"big": "\ufeff" + text, "small": "||x.com^\n"})
    sources = sources_of(spark, [("big", 1, True, True), ("small", 2, True, True)])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    found = []
    try:
        for size in ("7000", "20000", old):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = lists.read_lines(spark, str(tmp_path), sources)
            assert size == old or rows.filter("source = 'big'").select("chunk").distinct().count() > 3
            found.append([(r.raw, r.comments) for r in editions.build_edition(rows).collect()])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert found[0] == found[1] == found[2] and len(found[0]) == 6001
    assert found[0][0] == ("||r0.example.com^", ["! c0"])


def test_newest_usable_file_of_each_source(spark, tmp_path):
    sources = sources_of(spark, [("a", 1, True, True), ("b", 2, True, True), ("c", 3, True, True)])
    land(tmp_path, "9", {"a": "! c1\n||x.com^\n", "b": "||old.com^\n", "c": "||c9.com^\n"})
    land(tmp_path, "10", {"a": "! c2\n||y.com^\n", "b": ""})
    two = tmp_path / "run_id=9" / "source=c" / "second.txt"
    two.write_text("||c9b.com^\n")
    os.utime(two, (2_000_000_000, 2_000_000_000))
    edition = editions.build_edition(lists.read_lines(spark, str(tmp_path), sources)).collect()
    assert [(r.raw, r.comments) for r in edition] == [("||y.com^", ["! c2"]), ("||old.com^", []), ("||c9b.com^", [])]


def test_staging_needs_a_shared_folder(spark, monkeypatch):
    from rulemill import staging

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn", "spark.sql.warehouse.dir": "file:/tmp/w"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="share"):
        staging.work_dir(Session())
    mark = staging.staged_mark(spark)
    staged = staging.stage(spark.range(3), "kept")
    assert staged.count() == 3 and staging.drop_staged(spark, mark) == 1


def test_staging_leaves_no_shuffle_files(spark):
    """What was shuffled for a staged table does not stay on disk beside it."""
    from rulemill import staging

    def shuffled():
        files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    conf, before, mark = spark.conf.get(staging._CLEANUP), shuffled(), staging.staged_mark(spark)
    spark.range(1000).repartition(3, "id").write.format("noop").mode("overwrite").save()
    assert shuffled() - before
    before = shuffled()
    staged = staging.stage(spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count(), "kept")
    assert not shuffled() - before and spark.conf.get(staging._CLEANUP) == conf
    assert staged.count() == 7 and staging.drop_staged(spark, mark) == 1


def test_staged_folders_are_written_without_a_sort(spark):
    """Rows come grouped by nothing, in few folders; NULL and empty names come back as NULL, as always."""
    from rulemill import staging

    mark, old = staging.staged_mark(spark), spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    rows = [(i, s) for i in range(40) for s in ("block", "element", "x/y", "", None)] + [(i, f"s{i}") for i in range(30)]
    df = spark.createDataFrame(rows, "i int, section string")
    staged = staging.stage(df, "sections", partition_by=["section"])
    assert sorted((r.i, r.section or "") for r in staged.collect()) == sorted((i, s or "") for i, s in rows)
    assert staging.drop_staged(spark, mark) == 1
    with pytest.raises(RuntimeError), staging._writing(spark):
        assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) > 4
        raise RuntimeError
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == old


def results_of(spark, rows):
    return spark.createDataFrame(rows, "source string, token string, content string, error string")


def test_changes_and_state(spark):
    state = spark.createDataFrame(
        [("same", "t"), ("new", "old"), ("failed", "keep"), ("gone", "g")], "source string, token string"
    )
    results = results_of(spark, [
        ("same", "t", "x", None), ("new", "t2", "x", None), ("failed", "t3", None, "timeout"), ("first", "", "x", None),
    ])
    detected = refresh.detect_changes(results, state)
    assert {r.source: r.changed for r in detected.collect()} == {
        "same": False, "new": True, "failed": False, "first": True,
    }
    assert refresh.changed_count(detected).collect()[0].changed == 2
    again = refresh.upsert_state(state, detected)
    tokens = {r.source: r.token for r in again.collect()}
    first = tokens.pop("first")
    assert tokens == {"same": "t", "new": "t2", "failed": "keep", "gone": "g"} and len(first) == 64
    assert not refresh.detect_changes(results.filter("source = 'first'"), again).collect()[0].changed
    kept = refresh.upsert_state(state, results_of(spark, [("same", "", "x", None)]))
    assert {r.source: r.token for r in kept.collect()}["same"] == "t"


def test_status(spark):
    rows = results_of(spark, [
        ("err", "t", "x", "e"), ("empty", "t", "", None), ("idle", "t", "", None), ("up", "t", "x", None), ("old", "t", "x", None),
    ])
    state = spark.createDataFrame([("idle", "t"), ("old", "t")], "source string, token string")
    parsed = spark.createDataFrame([("up", 5), ("old", 4), ("err", 9)], "source string, rule_count long")
    got = refresh.source_status(refresh.detect_changes(rows, state), parsed)
    assert {r.source: (r.status, r.rule_count) for r in got.collect()} == {
        "err": ("error", 0), "empty": ("empty", 0), "idle": ("unchanged", 0), "up": ("updated", 5), "old": ("unchanged", 4),
    }
    counts = spark.createDataFrame([("up", 3)], "source string, rules long")
    assert [tuple(r) for r in history.run_log(got, counts).collect()] == [
        ("empty", 0, "="), ("err", 0, "="), ("idle", 0, "="), ("old", 0, "="), ("up", 3, "+"),
    ]


def test_last_good_snapshot(spark):
    rows = spark.createDataFrame(
        [("a", "1", "x", None), ("a", "2", "", None), ("b", "1", "y", None), ("b", "2", None, "e"), ("c", "2", "z", None)],
        "source string, run_id string, content string, error string",
    ).selectExpr("*", "'t' as token")
    assert {r.source: r.run_id for r in refresh.last_good(rows).collect()} == {"a": "1", "b": "1", "c": "2"}
    assert {r.source for r in refresh.last_good(rows, carry_forward=False).collect()} == {"c"}


def test_deltas_and_retention(spark):
    runs = [("full", "2024-01-01 00:00:00", 10), ("full", "2024-01-02 00:00:00", 7), ("full", "2024-01-03 00:00:00", 9)]
    df = spark.createDataFrame(runs, "edition string, run_ts string, total_rules long")
    typed = df.withColumn("run_ts", df.run_ts.cast("timestamp"))
    got = history.run_deltas(typed).orderBy("run_ts").collect()
    assert [(r.added, r.removed) for r in got] == [(None, None), (0, 3), (2, 0)]
    with pytest.raises(ValueError, match="time zone"):
        history.retain(typed, datetime(2024, 1, 4), 2)
    kept = history.retain(typed, datetime(2024, 1, 4, tzinfo=timezone.utc), 2).collect()
    assert [r.total_rules for r in kept] == [9]
    texts = spark.createDataFrame(
        [("a", "2024-01-03T07:59:00 CST"), ("b", "2024-01-03T08:01:00 CST"), ("c", "2024-01-03T00:00:00Z"),
         ("d", "2024-01-03T00:01:00Z"), ("e", "someday"), ("f", None)],
        "edition string, run_ts string",
    )
    kept = history.retain(texts, datetime(2024, 1, 4, tzinfo=timezone.utc), 1).collect()
    assert {r.edition for r in kept} == {"b", "d", "e"}


def test_edition_diff(spark, make_lines):
    old = parse_rules(make_lines({"s": (1, "||a.com^\n||b.com^\n")}))
    new = parse_rules(make_lines({"s": (1, "||B.com^\n||c.com^\n")}))
    assert {(r.raw, r.change) for r in history.edition_diff(old, new).collect()} == {
        ("||c.com^", "added"), ("||a.com^", "removed"),
    }


LIST = (
    "! Title: One\n@@||safe.com^\n! why\n||ads.com^\n||t.com^\na.com##.x\n! exc\na.com#@#.x\na.com##+js(y)\na.com$$div\n"
)


def test_published_text_reads_back(spark, make_lines, tmp_path):
    lines = make_lines({"s": (1, LIST)})
    edition = editions.build_edition(lines)
    summary = type_rules(lines).groupBy("source", "priority", "source_ord").count().withColumnRenamed("count", "rule_count")
    text = editions.edition_text(edition, comment_rows(lines), summary, datetime(2024, 1, 1, 20, 0))
    out = tmp_path / "out"
    assert editions.publish(edition, text, str(out), "0001")
    version = editions.published_version(spark, str(out))
    assert version.endswith("/0001")
    published = "".join(p.read_text(encoding="utf-8") for p in sorted((out / "0001").glob("part-*")))
    assert published.splitlines()[:2] == ["[AdBlock Plus 2.0]", "! Title: Merged filter list"]
    assert published[published.index("! Version"):] == "\n".join([
        "! Version: 2024-01-02T04:00:00 CST", "! Last modified: 2024-01-02T04:00:00 CST",
        "! Total rules: 7", "!   Exception rules: 1", "!   Block rules: 2", "!   Hide rules: 4",
        "! Sources:", "!   s: 8 rules (priority 1)", "!", "! Title: One",
        fixed.MARK_EXCEPTION, "@@||safe.com^", fixed.MARK_BLOCK, "! why", "||ads.com^", "||t.com^",
        fixed.MARK_ELEMENT, fixed.MARK_HIDE_EXCEPTION, "! exc", "a.com#@#.x",
        "a.com##.x", "a.com##+js(y)", "a.com$$div", "",
    ])
    again = lists.list_lines(spark.createDataFrame([("e", published)], "edition string, text string"), 4)
    stat = stats.edition_stats(edition).collect()[0].asDict()
    reread = stats.reread_stats(again).drop("edition").collect()[0].asDict()
    assert reread.pop("stamp") == "2024-01-02T04:00:00 CST" and reread == stat

    nothing = edition.filter("false")
    assert not editions.publish(nothing, text, str(out), "0002")
    assert editions.published_version(spark, str(out)) == version
    # A version without its success marker does not count.
    (out / "0003").mkdir()
    assert editions.published_version(spark, str(out)) == version
    assert editions.published_version(spark, str(tmp_path / "none")) is None


@pytest.fixture
def version(spark, tmp_path):
    """A published version of three parts and its folder; Spark then reads in splits of 4 KiB."""
    text = spark.range(0, 3000, 1, 3).select(F.format_string("||site%05d.com^", "id").alias("text"))
    assert editions.publish(text, text, str(tmp_path / "out"), "0001")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    yield tmp_path / "out" / "0001"
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_manifest_describes_what_was_written(spark, version):
    parts = sorted(version.glob("part-*"))
    said = {r.part: r for r in manifest.read_manifest(spark, str(version)).collect()}
    assert sorted(said) == [p.name for p in parts] and len({r.edition for r in said.values()}) == 1
    for p in parts:
        assert said[p.name].bytes == p.stat().st_size and said[p.name].lines == len(p.read_text().splitlines())
    # Written and verified with different splits: places of lines do not depend on them.
    manifest.verify(spark, str(version))
    got = [r.text for r in editions.read_published(spark, str(version.parent)).orderBy("part", "text").collect()]
    assert got == [f"||site{i:05d}.com^" for i in range(3000)]
    places = manifest.numbered_parts(spark, str(version)).groupBy("part").agg(F.count("*").alias("n"), F.countDistinct("line_no").alias("d"), F.max("line_no").alias("m"))
    assert all(r.n == r.d == r.m + 1 for r in places.collect())


@pytest.mark.parametrize("damage", ["missing", "cut", "swapped lines", "added", "exchanged", "manifest row"])
def test_damaged_version_is_refused(spark, version, damage):
    parts = sorted(version.glob("part-*"))
    for crc in version.glob(".part-*.crc"):
        crc.unlink()
    lines = parts[1].read_text().splitlines(keepends=True)
    if damage == "missing":
        parts[1].unlink()
    elif damage == "cut":
        parts[1].write_text("".join(lines[:-1]))
    elif damage == "swapped lines":
        parts[1].write_text("".join([*lines[:10], lines[11], lines[10], *lines[12:]]))
    elif damage == "added":
        (version / "part-99999-x.txt").write_text("||new.com^\n")
    elif damage == "exchanged":
        first = parts[0].read_text()
        parts[0].write_text("".join(lines))
        parts[1].write_text(first)
    else:
        (said,) = (version / "_manifest").glob("part-*")
        for crc in (version / "_manifest").glob(".*.crc"):
            crc.unlink()
        said.write_text("".join(said.read_text().splitlines(keepends=True)[1:]))
    with pytest.raises(manifest.DamagedEdition):
        editions.read_published(spark, str(version.parent))


def test_version_without_manifest_does_not_count(spark, tmp_path):
    text = spark.createDataFrame([("||a.com^",)], "text string")
    text.write.text(str(tmp_path / "0001"))
    assert editions.published_version(spark, str(tmp_path)) is None
    assert editions.read_published(spark, str(tmp_path)) is None


def test_reread_skips_bracket_rules_and_defaults_to_block(spark):
    text = f"||a.com^\n[$path=/x]a.com##.ad\n{fixed.MARK_HIDE_EXCEPTION}\na.com#@#.x\n"
    lines = lists.list_lines(spark.createDataFrame([("e", text)], "edition string, text string"), 1)
    row = stats.reread_stats(lines).collect()[0]
    assert (row.total_rules, row.block_rules, row.hide_rules, row.stamp) == (2, 1, 1, None)


def test_quick_profile_knows_fewer_separators(spark):
    rows = ["@@||a.com^", "a.com##.x", "a.com#%#x", "a.com$$x", "a.com#$#x", "! c", "[x", "", "@@a##b"]
    lines = spark.createDataFrame([("f", r) for r in rows], "file string, line string")
    sizes = spark.createDataFrame([("f", 99), ("none", 0)], "file string, size_bytes long")
    got = {r.file: (r.rules, r.size_bytes, r.exception, r.block, r.hide) for r in stats.quick_stats(lines, sizes).collect()}
    assert got == {"f": (6, 99, 2, 2, 2), "none": (0, 0, 0, 0, 0)}


def lines_of(folder):
    newest = max(p.parent for p in folder.glob("*/_SUCCESS"))
    return [line for p in sorted(newest.glob("part-*")) for line in p.read_text(encoding="utf-8").splitlines()]


def published(folder):
    return [line for line in lines_of(folder) if line and not line.startswith(("!", "["))]


@pytest.fixture
def refreshed(spark, tmp_path):
    """(land, go, out): land files, refresh once, look at the output."""

    def go(rows):
        query = run_refresh(spark, str(tmp_path / "in"), str(tmp_path / "cp"), sources_of(spark, rows), str(tmp_path / "out"))
        query.awaitTermination()
        assert query.exception() is None

    return lambda run, texts: land(tmp_path / "in", run, texts), go, tmp_path / "out"


def test_refresh_takes_new_files_and_keeps_the_rest(spark, tmp_path, refreshed):
    add, go, out = refreshed
    sources = [("one", 1, True, True), ("two", 2, False, True), ("off", 3, True, False), ("idle", 4, False, True), ("silent", 5, False, True)]
    add("8", {"one": "||a.com^\n||b.com^\n", "two": "||x.a.com^\n||c.com^\n", "off": "||disabled.com^\n", "idle": "! nothing yet\n"})
    go(sources)
    assert published(out / "full") == ["||a.com^", "||b.com^", "||c.com^"]
    assert published(out / "lite") == ["||a.com^", "||b.com^"]
    listed = [line for line in lines_of(out / "full") if "rules (priority" in line]
    assert listed == ["!   one: 2 rules (priority 1)", "!   two: 2 rules (priority 2)", "!   idle: 0 rules (priority 4)", "!   silent: 0 rules (priority 5)"]
    # The list shrinks, the other source brings nothing new; then an older run lands late.
    add("10", {"one": "||b.com^\n"})
    go(sources)
    assert published(out / "full") == ["||b.com^", "||x.a.com^", "||c.com^"]
    assert published(out / "lite") == ["||b.com^"]
    versions = sorted(glob.glob(f"{out}/full/*"))
    add("9", {"one": "||late.com^\n"})
    add("11", {"one": "||b.com^\n"})
    add("12", {"one": "", "two": ""})
    go(sources)
    assert sorted(glob.glob(f"{out}/full/*")) == versions
    # Order inside a list is part of its content; a source that is switched off goes.
    add("13", {"one": "||z.com^\n||b.com^\n"})
    go([("one", 1, True, True), ("two", 2, False, False)])
    assert published(out / "full") == ["||z.com^", "||b.com^"]
    kept = spark.read.parquet(str(tmp_path / "cp/tables/history")).filter("edition = 'full'").orderBy("run_ts").collect()
    assert [(r.total_rules, r.added, r.removed) for r in kept] == [(3, None, None), (3, 0, 0), (2, 0, 1)]
    status = {r.source: r.status for r in spark.read.parquet(glob.glob(f"{tmp_path}/cp/tables/status/batch=1")[0]).collect()}
    assert status == {"one": "updated", "two": "unchanged", "idle": "unchanged", "silent": "unchanged"}


def test_repeated_batch_and_metadata_only_stream(spark, tmp_path):
    from rulemill.streaming.refresh import apply_batch

    land(tmp_path / "in", "1", {"one": "||a.com^\n"})
    sources = sources_of(spark, [("one", 1, True, True)])
    files = lists.list_files(spark, str(tmp_path / "in"))
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]
    for _ in range(2):
        assert apply_batch(files, 0, str(tmp_path / "in"), sources, str(tmp_path / "t"), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "t/history")).filter("edition = 'full'").count() == 1
    assert published(tmp_path / "out" / "full") == ["||a.com^"]


def test_every_query_has_an_oracle():
    from rulemill.checks.oracles import ORACLES
    from rulemill.checks.queries import QUERIES

    assert set(QUERIES) == set(ORACLES)

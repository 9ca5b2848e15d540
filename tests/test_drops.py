"""CSV drops end to end: layouts, splits, quarantine, build, merge, daily run."""

import csv
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from obsledger.operators.dedupe import distinct_rows
from obsledger.operators.merge import Extent, anti_join, measure, merge, within
from obsledger.operators.sampling import uniform_sample
from obsledger.plans import on_tables
from obsledger.plans.build import EmptyListing, build
from obsledger.plans.daily import run_daily
from obsledger.plans.latest import latest
from obsledger.plans.observe import Rules, file_day_orders, observe
from obsledger.plans.report import freshness, needs_processing, watermark_of
from obsledger.plans.update import update, update_from
from obsledger.schema import FACT_SCHEMA, KEYS
from obsledger.session import run_session, session_with, shuffle_width
from obsledger.sinks.publish import adopt, export, publish, restore
from obsledger.sinks.reports import write_latest, write_needs, write_sample
from obsledger.sources.drops import plan_drops
from obsledger.sources.headers import read_head
from obsledger.sources.manifest import scan_drops, scan_objects, timestamp_literal
from obsledger.sources.needs import newest_needs, read_needs, resolve_keys
from obsledger.sources.table import ConflictingPublish, FactTable, parquet_modified, read_facts
from obsledger.sources.changes import ChangedFilesReader
from obsledger.streaming.drops import stream_rewrites, stream_updates

UTC = dt.timezone.utc
NOW = dt.datetime(2024, 8, 1, 12, 0, 0, tzinfo=UTC)
HEAD = "FATTID,FDAY,FMONTH,FYEAR,FHOUR,FMIN,FWINHR,FWINMIN"


def put(root, path, text, mtime=None, encoding="utf-8"):
    full = os.path.join(root, path)
    os.makedirs(os.path.dirname(full), exist_ok=True)
    data = text if isinstance(text, bytes) else text.encode(encoding)
    with open(full, "wb") as f:
        f.write(data)
    if mtime is not None:
        os.utime(full, (mtime.timestamp(), mtime.timestamp()))
    return full


def rows(df):
    return sorted(tuple(r) for r in df.select(*KEYS).collect())


def csv_lines(folder):
    """Lines of a one-file CSV sink."""
    parts = [p for p in os.listdir(folder) if p.startswith("part-")]
    assert len(parts) == 1
    with open(os.path.join(folder, parts[0]), newline="") as f:
        return list(csv.reader(f))


@pytest.fixture
def root(tmp_path):
    r = str(tmp_path / "export")
    put(r, "wait_times/wdw/a.csv",
        "entity_code,observed_at,submitted_posted_time,submitted_actual_time\n"
        "mk01,2024-07-01 10:00:00,30,25\nmk01,2024-07-01 10:05:00,,\n")
    put(r, "wait_times/wdw/b.CSV",
        " Observed_At ,x,SUBMITTED_POSTED_TIME, Entity_Code\n"
        "2024-07-01 10:00:00,q,30,MK01 \n2024-07-02 10:00:00,\"q,\"\"r\",7,MK02\n"
        "2024-07-02 11:00:00,q,7,MK02,oops\n")
    put(r, "wait_times/dlr/posted_only.csv",
        "entity_code,observed_at,submitted_posted_time\nDL01,2024-07-01 10:00:00,5\n")
    put(r, "wait_times/tdr/bad.csv", "entity,observed_at\nX,2024-07-01 10:00:00\n")
    put(r, "wait_times/tdr/empty.csv", "")
    put(r, "wait_times/tdr/notes.txt", "entity_code,observed_at,submitted_posted_time\nZ,2024-07-01 10:00:00,5\n")
    put(r, "fastpass_times/wdw/headered.csv",
        "extra,FWINMIN,fwinhr,FMIN,FHOUR,FYEAR,FMONTH,FDAY,FATTID\n"
        "e,0,11,15,10,2024,7,1,mk01\ne,0,11,15,10,2024,2,30,mk01\n")
    put(r, "fastpass_times/wdw/twice.csv",
        f"{HEAD}\nMK03,1,7,2024,10,0,11,0\nMK03,1,7,2024,10,0,12,0\n")
    put(r, "fastpass_times/wdw/twice_again.csv", f"{HEAD}\nMK03,1,7,2024,10,0,11,0\n")
    put(r, "fastpass_times/tdr/headerless.csv",
        "junk first line\nTD01,1,7,2024,1015,,2330,,more,fields\n")
    put(r, "fastpass_times/dlr/short_header.csv",
        "FATTID,FDAY,FMONTH,FYEAR,FHOUR,FWINHR\nDL02,1,7,2024,1015,1100\n")
    put(r, "fastpass_times/dlr/narrow.csv", "a,b,c,d,e\nDL03,1,7,2024,10\n")
    put(r, "fastpass_times/dlr/bytes[1].csv", b"FATTID,FDAY,FMONTH,FYEAR,FHOUR,FMIN,FWINHR,FWINMIN\nD\xffL,1,7,2024,10,0,11,0\n")
    return r


EXPECTED = sorted([
    ("MK01", "2024-07-01T10:00:00-04:00", "POSTED", 30),
    ("MK01", "2024-07-01T10:00:00-04:00", "ACTUAL", 25),
    ("MK02", "2024-07-02T10:00:00-04:00", "POSTED", 7),
    ("DL01", "2024-07-01T10:00:00-07:00", "POSTED", 5),
    ("MK01", "2024-07-01T10:15:00-04:00", "PRIORITY", 45),
    ("MK03", "2024-07-01T10:00:00-04:00", "PRIORITY", 120),
    ("MK03", "2024-07-01T10:00:00-04:00", "PRIORITY", 60),
    ("TD01", "2024-07-01T10:15:00+09:00", "PRIORITY", 795),
    ("DL02", "2024-07-01T10:15:00-07:00", "PRIORITY", 45),
    ("D�L", "2024-07-01T10:00:00-07:00", "PRIORITY", 60),
])


def test_build(spark, root, tmp_path):
    table = FactTable(str(tmp_path / "fact"))
    done = build(spark, root, table, run_ts=NOW, sample_path=str(tmp_path / "sample"))
    assert rows(table.read(spark)) == EXPECTED
    assert table.read(spark).schema == FACT_SCHEMA
    assert done.new_rows == len(EXPECTED) and done.collapsed_rows == 1
    assert done.commit.metrics["standby_files"] == 3
    assert done.commit.metrics["priority_files"] == 6
    problems = {os.path.basename(p): why for p, why in done.drops.rejected}
    # empty.csv is no problem: Spark's listing leaves files without bytes out
    assert problems == {"bad.csv": "missing columns", "narrow.csv": "too few columns"}
    assert sorted(map(tuple, done.rejected_files(spark).collect())) == sorted(done.drops.rejected)
    assert table.watermark(spark) == NOW - dt.timedelta(seconds=1)
    sample = csv_lines(tmp_path / "sample")
    assert sample[0] == KEYS and len(sample) == 1 + len(EXPECTED)
    files = os.listdir(table.segment_path(done.commit.run_id))
    assert any(f.endswith(".zstd.parquet") for f in files)
    assert done.commit.metrics["shifted_rows"] == done.commit.metrics["undated_rows"] == 1
    left = {r.reason: r for r in table.left_out(spark, done.commit.run_id).collect()}
    assert sorted(left) == ["shifted_rows", "undated_rows"]
    assert "MK02" in left["shifted_rows"].fields and left["shifted_rows"].file.lower().endswith(".csv")
    assert '"FDAY":"30"' in left["undated_rows"].fields and left["undated_rows"].family == "priority"


def test_properties_and_unknown_family(spark, root, tmp_path):
    table = FactTable(str(tmp_path / "fact"))
    build(spark, root, table, run_ts=NOW, properties=["dlr"])
    assert {r[0] for r in rows(table.read(spark))} == {"DL01", "DL02", "D�L"}
    stray = put(str(tmp_path), "other/x.csv", "a\n1\n")
    drops = plan_drops(spark, scan_objects(spark, stray))
    assert not drops.layouts and drops.rejected[0][1] == "unknown family"
    assert observe(spark, drops).rows.count() == 0


def test_zone_override(spark, root, tmp_path):
    table = FactTable(str(tmp_path / "fact"))
    build(spark, root, table, run_ts=NOW, properties=["dlr"], zones={"dlr": "America/Denver"})
    assert {r[1][-6:] for r in rows(table.read(spark))} == {"-06:00"}


def test_keep_last_over_splits(spark, tmp_path):
    """One file cut into many splits: the last row of the file wins."""
    r = str(tmp_path / "export")
    n, repeats = 400, 5
    lines = [HEAD] + [
        f"E{i},1,7,2024,10,0,{11 + k},{i % 60}" for k in range(repeats) for i in range(n)
    ]
    put(r, "fastpass_times/wdw/big.csv", "\n".join(lines) + "\n")
    put(r, "fastpass_times/wdw/small.csv", f"{HEAD}\nE1,1,7,2024,10,0,10,30\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3k")
    try:
        seen = observe(spark, plan_drops(spark, scan_drops(spark, r)))
        got = seen.rows.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    last = {f"E{i}": (10 + repeats) * 60 + i % 60 - 600 for i in range(n)}
    assert len(got) == n + 1
    assert sorted((x.entity_code, x.wait_time_minutes) for x in got) == sorted(
        [*last.items(), ("E1", 30)])


def test_multi_line_and_fold_rules(spark, tmp_path):
    r = str(tmp_path / "export")
    put(r, "wait_times/wdw/a.csv",
        'entity_code,observed_at,note,submitted_posted_time\nA,2024-11-03 01:30:00,"two\nlines",5\n')
    drops = plan_drops(spark, scan_drops(spark, r))
    for fold, at in (("earlier", "2024-11-03T01:30:00-04:00"), ("later", "2024-11-03T01:30:00-05:00")):
        got = observe(spark, drops, Rules(multi_line=True, fold=fold)).rows
        assert rows(got) == [("A", at, "POSTED", 5)]
    assert observe(spark, drops, Rules(multi_line=True, fold="null")).rows.count() == 0


def test_update_adds_only_new_rows(spark, root, tmp_path):
    table = FactTable(str(tmp_path / "fact"))
    first = build(spark, root, table, run_ts=NOW)
    again = update_from(spark, scan_drops(spark, root), table, listed_at=NOW)
    assert again.new_rows == 0 and again.commit.segments == first.commit.segments
    put(root, "wait_times/wdw/c.csv",
        "entity_code,observed_at,submitted_posted_time\nMK01,2024-07-01 10:00:00,30\n"
        "MK01,2024-07-03 10:00:00,31\nMK01,2024-07-03 10:00:00,31\n")
    later = NOW + dt.timedelta(days=1)
    done = update_from(spark, scan_drops(spark, root), table, listed_at=later,
                       sample_path=str(tmp_path / "s"))
    new = ("MK01", "2024-07-03T10:00:00-04:00", "POSTED", 31)
    assert done.new_rows == 1 and rows(table.read(spark)) == sorted([*EXPECTED, new])
    assert csv_lines(tmp_path / "s")[1:] == [[str(v) for v in new]]
    assert table.watermark(spark) == later - dt.timedelta(seconds=1)
    # the version before is still there, and can be published again
    assert rows(table.read(spark, version=2)) == EXPECTED
    restore(spark, table, 1, run_id="back", at=later)
    assert rows(table.read(spark)) == EXPECTED
    # the shuffled anti-join gives the same table as the broadcast one
    forced = update_from(spark, scan_drops(spark, root), table, listed_at=None, broadcast_bytes=0)
    assert forced.new_rows == 1 and rows(table.read(spark)) == sorted([*EXPECTED, new])
    assert table.watermark(spark) == NOW - dt.timedelta(seconds=1)


def test_build_equals_build_plus_merge(spark, root, tmp_path):
    files = scan_drops(spark, root)
    part = F.col("path").contains("/wdw/")
    table = FactTable(str(tmp_path / "fact"))
    assert update_from(spark, files.filter(part), table, listed_at=NOW).commit.version == 1
    update_from(spark, files.filter(~part), table, listed_at=NOW)
    assert rows(table.read(spark)) == EXPECTED


def test_merge_keeps_existing_copies(spark):
    a = ("A", "2024-01-01T00:00:00-05:00", "POSTED", 1)
    b = ("B", "2024-01-02T00:00:00-05:00", "POSTED", 1)
    existing = spark.createDataFrame([a, a], FACT_SCHEMA)
    new = spark.createDataFrame([a, b, b], FACT_SCHEMA)
    assert rows(merge(existing, new)) == [a, a, b]
    extent = measure(new)
    assert (extent.rows, extent.low, extent.high) == (3, a[1], b[1]) and extent.bytes > 0
    assert rows(merge(existing, new, extent=extent)) == [a, a, b]
    empty = existing.limit(0)
    assert rows(merge(empty, new)) == [a, b]
    assert rows(merge(existing, empty, extent=measure(empty))) == [a, a]
    plan = anti_join(new.distinct(), existing, extent=Extent(3, 10, a[1], b[1]))
    assert "BroadcastHashJoin" in plan._jdf.queryExecution().executedPlan().toString()


def test_unreadable_table_is_not_new(spark, root, tmp_path):
    table = FactTable(str(tmp_path / "fact"))
    os.makedirs(table.commit_path)
    with open(os.path.join(table.commit_path, "part-0.json"), "w") as f:
        f.write("not json\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        build(spark, root, table, run_ts=NOW)
    assert not os.path.exists(os.path.join(table.root, "segments"))


def test_conflicting_publish_is_seen(spark, tmp_path):
    table = FactTable(str(tmp_path / "fact"))
    def attempt(run, previous):
        return publish(spark, table, previous, run_id=run, kind="build", segments=[],
                       listed_at=None, published_at=NOW)

    first = attempt("one", None)
    for _ in range(2):
        with pytest.raises(ConflictingPublish):
            attempt("two", None)
    # the loser leaves the table as it was: readable, restorable, open for the next run
    assert table.commit(spark) == first and table.read(spark).count() == 0
    assert restore(spark, table, 1, run_id="back", at=NOW).version == 2
    assert attempt("three", table.commit(spark)).version == 3


def test_adopt_and_export_plain_parquet(spark, tmp_path):
    a = ("A", "2024-01-01T00:00:00-05:00", "POSTED", 1)
    plain = str(tmp_path / "plain.parquet")
    spark.createDataFrame([a, a], FACT_SCHEMA).coalesce(1).write.parquet(plain)
    assert parquet_modified(spark, plain).first()[0] is not None
    assert parquet_modified(spark, str(tmp_path / "none")).first()[0] is None
    table = FactTable(str(tmp_path / "fact"))
    adopt(spark, table, read_facts(spark, plain), run_id="r0", listed_at=None, at=NOW)
    export(spark, table, str(tmp_path / "out"))
    assert rows(read_facts(spark, str(tmp_path / "out"))) == [a, a]
    assert table.watermark(spark) is None


def test_needs_lists(spark, tmp_path):
    folder = str(tmp_path)
    assert newest_needs(spark, folder) is None
    put(folder, "needs_processing_20240101.csv", "s3_key,size_bytes\n a/b.csv ,1\n,2\n  ,3\n")
    put(folder, "needs_processing_20240102.csv/part-0.csv", "s3_key\n/abs/x.csv\ns3a://b/k.csv\n")
    newest = newest_needs(spark, folder)
    assert newest.endswith("needs_processing_20240102.csv")
    got = [r[0] for r in resolve_keys(read_needs(spark, newest), "/root/").collect()]
    assert got == ["/abs/x.csv", "s3a://b/k.csv"]
    old = read_needs(spark, f"{folder}/needs_processing_20240101.csv")
    assert [r[0] for r in resolve_keys(old, "/data/").collect()] == ["/data/a/b.csv"]
    put(folder, "bad.csv", "key\nx\n")
    with pytest.raises(ValueError, match="s3_key"):
        read_needs(spark, f"{folder}/bad.csv")


def hours_ago(h):
    return NOW - dt.timedelta(hours=h)


def test_freshness_tables(spark, tmp_path):
    r = str(tmp_path / "export")
    ages = {"current_a": 24, "current_b": 25, "current_c": 48, "CURRENT_d": 49,
            "current_test_e": 49, "old_f": 31 * 24, "old_g": 31 * 24 + 1}
    for name, age in ages.items():
        put(r, f"wait_times/wdw/{name}.csv", "x\n", hours_ago(age))
    mark = spark.createDataFrame([(0,)], "x int").select(timestamp_literal(hours_ago(48)))
    rep = freshness(scan_drops(spark, r), mark, NOW, zone="America/Toronto")
    recent = {os.path.basename(x.path)[:-4]: x for x in rep.recent.collect()}
    assert {k: v.staleness for k, v in recent.items()} == {
        "current_a": None, "current_b": "STALE", "current_c": "STALE",
        "CURRENT_d": "VERY_STALE", "current_test_e": None, "old_f": None}
    assert recent["current_a"].modified_local == "2024-07-31 08:00:00 EDT (UTC-04:00)"
    needs = [os.path.basename(x.path)[:-4] for x in rep.needs.collect()]
    assert needs == ["current_a", "current_b"]
    assert rep.days.first().days == 3
    assert rep.table.first().modified_local == "2024-07-30 08:00:00 EDT (UTC-04:00)"
    nothing = spark.createDataFrame([(None,)], "modified timestamp")
    assert needs_processing(scan_drops(spark, r), nothing, NOW).count() == 6
    assert len(freshness(scan_drops(spark, r), nothing, NOW, top=2).top.collect()) == 2
    write_needs(rep.needs, str(tmp_path / "needs.csv"), "America/Toronto")
    lines = csv_lines(tmp_path / "needs.csv")
    assert lines[0] == ["s3_key", "last_modified_utc", "last_modified_local", "size_bytes"]
    assert lines[1][1:] == ["2024-07-31T12:00:00+00:00", "2024-07-31 08:00:00 EDT (UTC-04:00)", "2"]


def test_latest_report(spark, tmp_path):
    facts = spark.createDataFrame(
        [("ak01", "2024-01-01T23:00:00-05:00", "POSTED", 1), ("AK01 ", " 2024-01-02T01:00:00-05:00", "POSTED", 1),
         ("B", "text", "POSTED", 1), ("B", "2024", "POSTED", 1), (None, "2024-01-01", "POSTED", 1)], FACT_SCHEMA)
    table = FactTable(str(tmp_path / "fact"))
    with pytest.raises(FileNotFoundError):
        latest(spark, table, str(tmp_path / "l"))
    adopt(spark, table, facts, run_id="r", listed_at=None, at=NOW)
    assert latest(spark, table, str(tmp_path / "l"))
    assert csv_lines(tmp_path / "l") == [
        ["entity_code", "latest_observation_date"], ["AK01", "2024-01-02"], ["B", "text"]]
    assert not latest(spark, table, str(tmp_path / "m"), needs=facts.limit(0))
    assert not os.path.exists(tmp_path / "m")
    from obsledger.operators.explore import latest_per_entity
    write_latest(latest_per_entity(facts.limit(0)), str(tmp_path / "e"))
    assert csv_lines(tmp_path / "e") == [["entity_code", "latest_observation_date"]]


def test_daily_run(spark, root, tmp_path):
    table = FactTable(str(tmp_path / "fact"))
    out = str(tmp_path / "out")
    now = dt.datetime.now(UTC) + dt.timedelta(seconds=5)
    day1 = run_daily(spark, root, table, out, run_ts=now, zone="America/Toronto")
    assert day1.update.new_rows == len(EXPECTED) and day1.latest_written
    assert rows(table.read(spark)) == EXPECTED
    assert newest_needs(spark, out).endswith(os.path.basename(day1.needs_path))
    assert read_needs(spark, day1.needs_path).count() == 11
    day2 = run_daily(spark, root, table, out, run_ts=now + dt.timedelta(seconds=30))
    assert day2.update is None and not day2.latest_written
    assert table.commit(spark).version == 1
    changed = put(root, "wait_times/wdw/a.csv",
                  "entity_code,observed_at,submitted_posted_time\nMK01,2024-07-09 10:00:00,1\n",
                  now + dt.timedelta(seconds=40))
    day3 = run_daily(spark, root, table, out, run_ts=now + dt.timedelta(seconds=60))
    assert [r[0] for r in read_needs(spark, day3.needs_path).collect()] == [f"file:{changed}"]
    assert day3.update.new_rows == 1 and table.read(spark).count() == len(EXPECTED) + 1


def test_files_that_could_not_be_opened_are_read_next_time(spark, root, tmp_path):
    table, out = FactTable(str(tmp_path / "fact")), str(tmp_path / "out")

    def failing(path, size):
        if path.endswith("posted_only.csv"):
            raise OSError("store is away")
        return read_head(path, size)

    now = dt.datetime.now(UTC) + dt.timedelta(seconds=5)
    first = run_daily(spark, root, table, out, run_ts=now, opener=failing)
    assert first.update.new_rows == len(EXPECTED) - 1
    stored = {os.path.basename(r.path): r.problem for r in table.quarantine(spark).collect()}
    assert stored == {"bad.csv": "missing columns", "narrow.csv": "too few columns",
                      "posted_only.csv": "unreadable: store is away"}
    second = run_daily(spark, root, table, out, run_ts=now + dt.timedelta(seconds=30))
    assert second.update.new_rows == 1 and rows(table.read(spark)) == EXPECTED
    assert run_daily(spark, root, table, out, run_ts=now + dt.timedelta(seconds=60)).update is None


def test_files_stay_open_over_other_publishes(spark, root, tmp_path):
    table, out = FactTable(str(tmp_path / "fact")), str(tmp_path / "out")

    def failing(path, size):
        if path.endswith("posted_only.csv"):
            raise OSError("store is away")
        return read_head(path, size)

    now = dt.datetime.now(UTC) + dt.timedelta(seconds=5)
    run_daily(spark, root, table, out, run_ts=now, opener=failing)
    other = spark.createDataFrame([(f"file:{root}/wait_times/wdw/a.csv",)], "path string")
    update_from(spark, other, table, listed_at=None)
    restore(spark, table, 1, run_id="back", at=now)
    adopt(spark, table, table.read(spark), run_id="taken", listed_at=table.watermark(spark), at=now)
    later = run_daily(spark, root, table, out, run_ts=now + dt.timedelta(seconds=30))
    assert later.update.new_rows == 1 and rows(table.read(spark)) == EXPECTED
    assert run_daily(spark, root, table, out, run_ts=now + dt.timedelta(seconds=60)).update is None


def test_files_that_a_stream_could_not_open_are_read_by_the_next_daily_run(spark, root, tmp_path):
    table, out = FactTable(str(tmp_path / "fact")), str(tmp_path / "out")

    def failing(path, size):
        if path.endswith("late.csv"):
            raise OSError("store is away")
        return read_head(path, size)

    now = dt.datetime.now(UTC) + dt.timedelta(seconds=5)
    run_daily(spark, root, table, out, run_ts=now)
    put(root, "wait_times/wdw/late.csv",
        "entity_code,observed_at,submitted_posted_time\nMK09,2024-07-09 10:00:00,1\n")
    stream_updates(spark, f"{root}/*/*", table, str(tmp_path / "check"), max_files=4, opener=failing).awaitTermination()
    later = run_daily(spark, root, table, out, run_ts=now + dt.timedelta(seconds=30))
    assert later.update.new_rows == 1 and table.unopened(spark).isEmpty()


def test_update_from_stored_list(spark, root, tmp_path):
    table = FactTable(str(tmp_path / "fact"))
    listed = put(str(tmp_path), "needs.csv", "s3_key\nwait_times/wdw/a.csv\nwait_times/wdw/gone.csv\n")
    done = update(spark, listed, root, table, listed_at=NOW)
    assert done.new_rows == 2
    assert [why.split(":")[0] for _, why in done.drops.rejected] == ["unreadable"]
    none = put(str(tmp_path), "none.csv", "s3_key\n")
    assert update(spark, none, root, table, listed_at=NOW) is None


def test_stream_of_drops(spark, root, tmp_path):
    table = FactTable(str(tmp_path / "fact"))
    check = str(tmp_path / "check")
    glob = f"{root}/*/*"
    stream_updates(spark, glob, table, check, max_files=4).awaitTermination()
    assert rows(table.read(spark)) == EXPECTED
    version = table.commit(spark).version
    assert version > 1 and table.watermark(spark) is None
    put(root, "wait_times/wdw/late.csv",
        "entity_code,observed_at,submitted_posted_time\nMK09,2024-07-09 10:00:00,1\n")
    stream_updates(spark, glob, table, check).awaitTermination()
    assert table.read(spark).count() == len(EXPECTED) + 1


def test_sample_is_exact_and_stable(spark):
    df = spark.range(10_000).select(
        F.concat(F.lit("E"), "id").alias("entity_code"), F.lit("t").alias("observed_at"),
        F.lit("POSTED").alias("wait_time_type"), F.col("id").alias("wait_time_minutes"))
    two = uniform_sample(df.repartition(2), 1000).collect()
    many = uniform_sample(df.repartition(200), 1000).collect()
    thinned = uniform_sample(df, 100, total_rows=10_000).collect()
    assert len(two) == 1000 and two == many and thinned == two[:100]
    wrong_count = uniform_sample(df, 100, total_rows=10**12).collect()
    assert wrong_count == two[:100]
    assert uniform_sample(df.limit(10), 1000).count() == 10
    mean = sum(r.wait_time_minutes for r in two) / 1000
    assert 4500 < mean < 5500
    assert uniform_sample(df, 1000, seed=7).collect() != two


def test_drops_without_rows(spark, tmp_path):
    """Header-only and all-unreadable drops: an empty version, metrics included."""
    r = str(tmp_path / "export")
    put(r, "fastpass_times/wdw/a.csv", f"{HEAD}\n")
    put(r, "fastpass_times/wdw/b.csv", f"{HEAD}\nX,30,2,2024,1,1,1,1\n")
    put(r, "wait_times/wdw/a.csv", "entity_code,observed_at,submitted_posted_time\n")
    table = FactTable(str(tmp_path / "fact"))
    done = build(spark, r, table, run_ts=NOW)
    assert done.new_rows == 0 and done.collapsed_rows == 0
    assert done.drops.files_per_family() == {"standby": 1, "priority": 2}
    assert table.read(spark).count() == 0
    again = update_from(spark, scan_drops(spark, r), table, listed_at=NOW,
                        sample_path=str(tmp_path / "s"))
    assert again.new_rows == 0 and csv_lines(tmp_path / "s") == [KEYS]


def test_a_missing_root_replaces_nothing(spark, root, tmp_path):
    table = FactTable(str(tmp_path / "fact"))
    build(spark, root, table, run_ts=NOW)
    with pytest.raises(EmptyListing):
        build(spark, str(tmp_path / "none"), table, run_ts=NOW)
    assert rows(table.read(spark)) == EXPECTED
    assert build(spark, str(tmp_path / "none"), table, run_ts=NOW, allow_empty=True).new_rows == 0
    odd = str(tmp_path / "x[1]")
    os.rename(root, odd)
    assert build(spark, odd, table, run_ts=NOW).new_rows == len(EXPECTED)


def test_equal_names_in_other_folders_and_layouts_stay_apart(spark, tmp_path):
    r = str(tmp_path / "export")
    put(r, "fastpass_times/wdw/2019/a.csv", f"{HEAD}\nMK01,1,7,2024,10,0,11,0\n")
    put(r, "fastpass_times/wdw/2020/a.csv", f"{HEAD},NEW\nMK01,1,7,2024,10,0,12,0,x\n")
    put(r, "fastpass_times/wdw/2021/a.csv", f"{HEAD}\nMK01,1,7,2024,10,0,12,30\n")
    table = FactTable(str(tmp_path / "fact"))
    done = build(spark, r, table, run_ts=NOW)
    assert sorted(x[3] for x in rows(table.read(spark))) == [60, 120, 150]
    assert done.collapsed_rows == 0


@pytest.mark.parametrize("first", [True, False])
def test_long_headers_are_read_whole(spark, tmp_path, first):
    r = str(tmp_path / "export")
    more, values = [f"column_{i:04}_{'x' * 40}" for i in range(500)], ["v"] * 500
    join = lambda a, b: ",".join([*a, *b] if first else [*b, *a])
    put(r, "wait_times/wdw/a.csv",
        join(["entity_code", "observed_at", "submitted_posted_time"], more) + "\n"
        + join(["MK01", "2024-07-01 10:00:00", "5"], values) + "\n")
    put(r, "fastpass_times/wdw/a.csv", join(HEAD.split(","), more) + "\n"
        + join("MK01,1,7,2024,10,0,11,0".split(","), values) + "\n")
    put(r, "fastpass_times/wdw/b.csv", "no header " * 3000 + "\nMK02,1,7,2024,10,0,11,0\n")
    drops = plan_drops(spark, scan_drops(spark, r))
    assert not drops.rejected
    assert sorted(x[3] for x in rows(observe(spark, drops).rows)) == [5, 60, 60]


def test_segments_have_disjoint_ranges_and_updates_read_few(spark, tmp_path):
    r = str(tmp_path / "export")
    lines = [f"E{i % 40},2024-{1 + i % 12:02}-{1 + i % 28:02} 10:00:00,{i % 50}" for i in range(4000)]
    put(r, "wait_times/wdw/a.csv", "entity_code,observed_at,submitted_posted_time\n" + "\n".join(lines) + "\n")
    small = session_with(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    table = FactTable(str(tmp_path / "fact"))
    done = build(small, r, table, run_ts=NOW)
    parts = read_facts(spark, table.segment_path(done.commit.run_id)).groupBy(F.input_file_name().alias("f"))
    ranges = sorted((x.low, x.high) for x in parts.agg(
        F.min("observed_at").alias("low"), F.max("observed_at").alias("high")).collect())
    assert len(ranges) > 4 and all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    new = spark.createDataFrame([("E1", "2024-03-04T09:00:00-05:00", "POSTED", 1),
                                 ("E1", "on 2024-03-04", "POSTED", 1)], FACT_SCHEMA)
    kept = within(table.read(spark), measure(new))
    assert {x.observed_at[:10] for x in kept.collect()} <= {"2024-03-04"}
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "2024-03-04" in plan.split("PushedFilters")[1]


def test_width_follows_the_input(spark):
    assert shuffle_width(100 << 40, 8) == 819_200 and shuffle_width(1, 8) == 8
    wide = run_session(spark, 100 << 30)
    assert wide.conf.get("spark.sql.shuffle.partitions") == "800"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    assert wide.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")


def test_widths_do_not_change_rows(spark, root):
    drops = plan_drops(spark, scan_drops(spark, root))
    for n in ("2", "500"):
        own = session_with(spark, {"spark.sql.shuffle.partitions": n})
        assert rows(distinct_rows(observe(own, drops).rows)) == EXPECTED


def test_stream_takes_rewritten_files_again(spark, tmp_path):
    r, table = str(tmp_path / "export"), FactTable(str(tmp_path / "fact"))
    head = "entity_code,observed_at,submitted_posted_time\n"
    line = "{},2024-07-01 10:00:00,{}\n".format

    def run():
        stream_rewrites(spark, r, table, str(tmp_path / "cp"), slack_seconds=0).awaitTermination()
        return sorted((e, m) for e, _, _, m in rows(table.read(spark)))

    put(r, "wait_times/wdw/current.csv", head + line("A", 1))
    put(r, "wait_times/wdw/old.CSV", head + line("B", 2))
    put(r, "wait_times/wdw/notes.txt", head + line("X", 9))
    assert run() == [("A", 1), ("B", 2)]
    put(r, "wait_times/wdw/current.csv", head + line("A", 1) + line("A", 3))
    assert run() == [("A", 1), ("A", 3), ("B", 2)]
    version = table.commit(spark).version
    assert run() == [("A", 1), ("A", 3), ("B", 2)] and table.commit(spark).version == version


def test_changed_files_are_cut_by_time_and_path(tmp_path):
    at = [NOW - dt.timedelta(seconds=s) for s in (50, 40, 40, 30)]
    for name, t in zip("abcd", at, strict=True):
        put(str(tmp_path), f"{name}.csv", name, mtime=t)
    reader = ChangedFilesReader(str(tmp_path), ".csv", 1)
    end = reader.latestOffset()
    read = lambda start: [os.path.basename(r[0]) for p in reader.partitions(start, end) for r in reader.read(p)]
    assert read(reader.initialOffset()) == ["a.csv", "b.csv", "c.csv", "d.csv"]
    b = {"time": int(at[1].timestamp() * 1e9), "path": str(tmp_path / "b.csv")}
    assert read(b) == ["c.csv", "d.csv"] and read(end) == []
    assert ChangedFilesReader(str(tmp_path / "none"), ".csv", 1).latestOffset() == reader.initialOffset()


def test_repeated_hour_by_the_order_of_a_file(spark, tmp_path):
    r = str(tmp_path / "export")
    times = ["00:50", "01:10", "01:50", "01:05", "01:40", "02:10"]
    lines = "".join(f"A,2024-11-03 {t}:00,{k}\n" for k, t in enumerate(times))
    put(r, "wait_times/wdw/a.csv", "entity_code,observed_at,submitted_posted_time\n" + lines)
    mixed = "".join(f"B,2024-11-03 {t}:00,{k}\n" for k, t in enumerate(["01:50", "01:10", "01:40", "01:20"]))
    put(r, "wait_times/wdw/b.csv", "entity_code,observed_at,submitted_posted_time\n" + mixed)
    priority = "".join(f"P,3,11,2024,{h},{m},{h},{m}\n" for h, m in ((1, 30), (1, 0), (2, 0)))
    put(r, "fastpass_times/wdw/p.csv", HEAD + "\n" + priority)
    got = rows(observe(spark, plan_drops(spark, scan_drops(spark, r)), Rules(fold="infer")).rows)
    offset = {(e, m if e != "P" else at[11:16]): at[19:] for e, at, _, m in got}
    assert [offset["A", k] for k in range(6)] == ["-04:00"] * 3 + ["-05:00"] * 3
    assert {offset["B", k] for k in range(4)} == {"-04:00"}
    assert [offset["P", t] for t in ("01:30", "01:00", "02:00")] == ["-04:00", "-05:00", "-05:00"]


def test_day_and_month_by_the_dates_of_a_file(spark, tmp_path):
    """One read of files of both orders: by days over 12, by the shorter span, and what is left open."""
    r = str(tmp_path / "export")
    head = "entity_code,observed_at,submitted_posted_time\n"
    files = {
        "day 100%.csv": ("D", ["13/02/2024 10:00:00", "05/02/2024 1:30 PM"]),
        "month.csv": ("M", ["02/13/2024 10:00:00", "02/05/2024 10:00:00"]),
        "short.csv": ("S", ["01/03/2024 10:00:00", "05-03-2024 10:00:00", "2024-03-06 10:00:00"]),
        "same.csv": ("E", ["03/04/2024 10:00:00", "", "no date"]),
        "both.csv": ("B", ["13/02/2024 10:00:00", "02/13/2024 10:00:00", "31/31/2024 10:00:00"]),
        "iso.csv": ("I", ["2024-02-03 10:00:00"]),
    }
    for name, (entity, times) in files.items():
        lines = "".join(f"{entity},{t},{k}\n" for k, t in enumerate(times))
        put(r, f"wait_times/wdw/{name}", head + lines)
    drops = plan_drops(spark, scan_drops(spark, r))
    found = {os.path.basename(x.file): (x.dates, x.day_order) for x in file_day_orders(spark, drops).collect()}
    assert found == {
        "day%20100%25.csv": (2, "day_first"),
        "month.csv": (2, "month_first"),
        "short.csv": (2, "day_first"),
        "same.csv": (1, "ambiguous"),
        "both.csv": (3, "mixed"),
    }
    seen = observe(spark, drops, Rules(day_order="infer"))
    assert seen.unclear == {"ambiguous": 1, "mixed": 1}
    got = {(e, m): at[:16] for e, at, _, m in rows(seen.rows)}
    assert got == {
        ("D", 0): "2024-02-13T10:00", ("D", 1): "2024-02-05T13:30",
        ("M", 0): "2024-02-13T10:00", ("M", 1): "2024-02-05T10:00",
        ("S", 0): "2024-03-01T10:00", ("S", 1): "2024-03-05T10:00", ("S", 2): "2024-03-06T10:00",
        ("E", 0): "2024-03-04T10:00", ("E", 2): "no date",
        ("B", 0): "13/02/2024 10:00", ("B", 1): "2024-02-13T10:00", ("B", 2): "31/31/2024 10:00",
        ("I", 0): "2024-02-03T10:00",
    }
    fixed = {(e, m): at[:10] for e, at, _, m in rows(observe(spark, drops, Rules(day_order="day_first")).rows)}
    assert fixed["S", 0] == "2024-03-01" and fixed["E", 0] == "2024-04-03" and fixed["M", 1] == "2024-05-02"
    with pytest.raises(ValueError):
        Rules(day_order="other")


def test_day_order_without_dates(spark, tmp_path):
    r = str(tmp_path / "export")
    put(r, "wait_times/wdw/none.csv", "entity_code,observed_at,submitted_posted_time\n")
    drops = plan_drops(spark, scan_drops(spark, r))
    seen = observe(spark, drops, Rules(day_order="infer"))
    assert rows(seen.rows) == [] and seen.unclear == {"ambiguous": 0, "mixed": 0}
    table = FactTable(str(tmp_path / "t"))
    metrics = build(spark, r, table, run_ts=NOW, rules=Rules(day_order="infer")).commit.metrics
    assert metrics["ambiguous_date_files"] == 0


def test_mixed_drops_are_written_straight_from_the_events(spark, tmp_path):
    """No drop is written only to be read back for another one, and each layout has its header."""
    on_tables.write_mixed_drops(spark, "/root/testdata/sf0.001", str(tmp_path))
    assert [p.name for p in tmp_path.iterdir()] == ["export"]
    found = {}
    for part in tmp_path.glob("export/*/wdw/*/part-*.csv"):
        found[f"{part.parts[-4]}/{part.parts[-2]}"] = part.read_text().splitlines()[0]
    assert found == {
        "wait_times/a": "entity_code,observed_at,submitted_posted_time",
        "wait_times/b": "note,Submitted_POSTED_time,OBSERVED_AT,Entity_Code",
        "fastpass_times/0": "FWINHR,FWINMIN,FATTID,FDAY,FMONTH,FYEAR,FHOUR,FMIN",
        "fastpass_times/1": "fmin,fhour,fyear,fmonth,fday,fattid,fwinmin,fwinhr",
        "fastpass_times/2": ",".join(f"field {i}" for i in range(8)),
    }


def test_report_of_one_file_is_sorted_by_many_tasks(spark, tmp_path):
    """The task that writes it holds no rows: no sort in its plan, and the whole report in order."""
    from obsledger.sinks.reports import _sorted_for_one_task

    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "7"}
    codes = F.concat(F.lit("E"), F.pmod(F.xxhash64("id"), F.lit(1_000_003)))
    made = session_with(spark, settings).range(0, 20_000, 1, 5).select(codes.alias("entity_code"))
    made = made.distinct().withColumn("latest_observation_date", F.lit("2024-01-01"))
    ordered = _sorted_for_one_task(made, [F.col("entity_code")])
    assert "Sort" not in ordered._jdf.queryExecution().executedPlan().toString()
    assert ordered.rdd.getNumPartitions() > 1
    write_latest(made, str(tmp_path / "report"))
    (part,) = (tmp_path / "report").glob("part-*.csv")
    lines = part.read_text().splitlines()
    assert lines[0] == "entity_code,latest_observation_date"
    assert len(lines) == made.count() + 1 and lines[1:] == sorted(lines[1:])

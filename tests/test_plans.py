"""Physical plans: what must (not) be in them."""

import re

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from obsledger.functions.timestamps import infer_second
from obsledger.operators.dedupe import distinct_rows, keep_last
from obsledger.operators.explore import entity_rows, latest_per_entity, newest_rows
from obsledger.operators.merge import Extent, anti_join, time_ranges, within
from obsledger.operators.sampling import uniform_sample
from obsledger.plans.observe import observe
from obsledger.plans import on_tables
from obsledger.schema import FACT_SCHEMA
from obsledger.session import TASK_BYTES, session_with, size_of, table_session
from obsledger.sources import headers
from obsledger.sources.drops import DropSet, Layout
from obsledger.sources.manifest import scan_objects
from obsledger.sources.table import read_facts

ROW = ("A", "2024-01-01T00:00:00-05:00", "POSTED", 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def facts(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "facts")
    spark.createDataFrame([ROW], FACT_SCHEMA).write.parquet(path)
    return read_facts(spark, path)


def test_latest_reads_two_columns_and_combines_before_it_sorts(facts):
    text = plan(latest_per_entity(facts))
    assert "ReadSchema: struct<entity_code:string,observed_at:string>" in text
    assert re.search(r"Generate[^\n]*\n\s*\+- HashAggregate[^\n]*\n\s*\+- Exchange[^\n]*\n\s*\+- HashAggregate", text)


def test_filters_reach_the_scan(spark, facts):
    assert "EqualTo(entity_code,MK25)" in plan(entity_rows(facts, "MK25"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    text = plan(within(facts, Extent(1, 1, "2024-01-01", "2024-01-02")))
    assert "GreaterThanOrEqual(observed_at,2024-01-01)" in text
    assert "LessThanOrEqual(observed_at,2024-01-02)" in text


def test_top_k_plans(facts):
    for df in (newest_rows(facts), uniform_sample(facts, 10)):
        assert "TakeOrderedAndProject" in plan(df)


def test_keep_last_and_distinct_combine_before_the_shuffle(facts):
    df = facts.withColumn("pos", F.monotonically_increasing_id())
    for out in (keep_last(df, ["entity_code", "observed_at"], "wait_time_minutes", "pos"),
                distinct_rows(facts)):
        text = plan(out)
        assert "SortAggregate" not in text
        assert re.search(r"HashAggregate[^\n]*\n\s*\+- Exchange hashpartitioning[^\n]*\n\s*\+- HashAggregate", text)


def test_small_merge_does_not_shuffle_the_table(facts):
    out = anti_join(distinct_rows(facts), facts, extent=Extent(1, 100, ROW[1], ROW[1]))
    text = plan(out)
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text
    # candidates: distinct (in both uses); shared rows: distinct. The table: none.
    shuffled = plan(anti_join(distinct_rows(facts), facts, extent=Extent(1, 1 << 40, ROW[1], ROW[1])))
    # one shuffle for each side, both combined before it, none for the join itself
    assert shuffled.count("Exchange hashpartitioning(entity_code") == 2
    assert shuffled.count("HashAggregate") == 4


def test_large_merge_broadcasts_no_table(facts):
    """The file is small, the measured extent is not: well-packed Parquet says little of the rows in it."""
    text = plan(anti_join(distinct_rows(facts), facts, extent=Extent(1, 1 << 40, ROW[1], ROW[1])))
    assert "Broadcast" not in text and "SortMergeJoin" in text


def test_listing_opens_no_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\n")
    text = plan(scan_objects(spark, str(tmp_path)))
    assert "content" not in text.split("ReadSchema")[1].split("\n")[0]


def test_normalisers_compile_and_stay_in_the_jvm(spark, tmp_path):
    """No Python operator, and every generated method within what HotSpot compiles."""
    root = tmp_path / "export"
    standby, priority = root / "wait_times/wdw/a.csv", root / "fastpass_times/dlr/b.csv"
    for path, text in ((standby, "entity_code,observed_at,submitted_posted_time,x\nA,2024-01-01,1,y\n"),
                       (priority, "FATTID,FDAY,FMONTH,FYEAR,FHOUR,FMIN,FWINHR,FWINMIN\nA,1,1,2024,1,1,2,1\n")):
        path.parent.mkdir(parents=True)
        path.write_text(text)
    drops = DropSet({
        Layout("standby", "America/New_York", "headered", (0, 1, 2, -1), 4): [str(standby)],
        Layout("priority", "America/Los_Angeles", "headered", tuple(range(8)), 8): [str(priority)],
    }, [])
    df = distinct_rows(observe(spark, drops).rows)
    assert len(df.collect()) == 2
    text = plan(df)
    assert not re.search(r"Python|Pandas|SortAggregate", text)
    assert "ReadSchema: struct<c0:string,c1:string,c2:string,extra_field:string>" in text
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    stages = debug.codegenStringSeq(df._jdf.queryExecution().executedPlan())
    sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    assert sizes and max(sizes) < 8000


def test_probe_needs_no_package_on_executors():
    pickled = cloudpickle.dumps(headers.describe)
    assert b"obsledger.schema" not in pickled
    shape = cloudpickle.loads(pickled)("standby", b"Entity_Code , OBSERVED_AT,b\n1,2,3\n")
    assert shape == ("headered", [0, 1, -1, -1], 3, None)


def test_days_in_a_row_share_a_range(spark):
    times = [f"2024-02-{d:02}T0{d % 9}:00:00-05:00" for d in (26, 27, 28, 29)] + ["2024-03-01T01:00:00-05:00"]
    times += ["2024-03-03T09:00:00-05:00", "2024-03-03T10:00:00-05:00", "odd text"]
    df = spark.createDataFrame([("A", t, "POSTED", 1) for t in times], FACT_SCHEMA)
    assert time_ranges(df) == ((times[0], times[4]), (times[5], times[6]), ("odd text", "odd text"))


def test_filters_on_repeated_hours_copy_no_zone_conversion(spark):
    rows = spark.createDataFrame([("a", 1, "2024-11-03 01:30:00")], "file string, place long, t string")
    rows = rows.select("file", "place", F.col("t").cast("timestamp_ntz").alias("l"))
    text = infer_second(rows, "l", "America/New_York", ["file"], "place")._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in text.splitlines() if re.match(r"[\s:+|-]*Filter", line)]
    assert filters and not any("utc_timestamp" in line for line in filters)


SHARES = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_aggregates_over_tables_give_a_task_a_fixed_share(spark):
    """Neither scan splits nor merged shuffle partitions grow with the table; the caller's session stays as it is."""
    wide = session_with(spark, dict.fromkeys(SHARES, "256m"))
    for made in (on_tables.all_facts, on_tables.priority_observations):
        used = made(wide, "/root/testdata/sf0.001").sparkSession.conf
        assert all(size_of(used.get(key)) <= TASK_BYTES for key in SHARES)
    assert all(wide.conf.get(key) == "256m" for key in SHARES)
    assert int(table_session(wide, 1 << 32).conf.get("spark.sql.shuffle.partitions")) >= (1 << 32) // TASK_BYTES
    small = session_with(spark, dict.fromkeys(SHARES, "1m"))
    assert all(table_session(small, 1 << 32).conf.get(key) == "1m" for key in SHARES)

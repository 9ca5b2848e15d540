"""Summaries kept over segments: equal to the whole table's, and made from new segments alone."""

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from obsledger.operators.explore import entities_between, latest_per_entity
from obsledger.operators.sampling import uniform_sample
from obsledger.plans import summaries
from obsledger.plans.summaries import ENTITIES_BY_DAY, LATEST, sample_summary, summarize
from obsledger.schema import FACT_SCHEMA
from obsledger.sinks.publish import UPDATE, publish, restore, write_facts
from obsledger.sources.table import FactTable

NOW = dt.datetime(2024, 8, 1, tzinfo=dt.timezone.utc)


def add(spark, table, run_id, rows):
    write_facts(spark.createDataFrame(rows, FACT_SCHEMA), table.segment_path(run_id))
    last = table.commit(spark)
    publish(spark, table, last, run_id=run_id, kind=UPDATE, listed_at=None, published_at=NOW,
            segments=[*(last.segments if last else []), run_id])


def facts(day, n, start=0):
    return [(f"E{i % 500}", f"2024-07-{day:02d}T10:{i % 60:02d}:00-04:00", "POSTED", i) for i in range(start, start + n)]


@pytest.fixture
def table(tmp_path):
    return FactTable(str(tmp_path / "fact"))


@pytest.fixture
def reads(monkeypatch):
    """Segments that each summary read."""
    seen, plain = [], summaries.read_facts

    def noted(spark, *paths):
        seen.append(sorted(p.rsplit("/", 1)[1] for p in paths))
        return plain(spark, *paths)

    monkeypatch.setattr(summaries, "read_facts", noted)
    return seen


def same(a, b):
    return sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_only_new_segments_are_read(spark, table, reads):
    for k, run in enumerate(["a", "b", "c"]):
        add(spark, table, run, facts(k + 1, 300, 200 * k))
        assert same(summarize(spark, table, LATEST), latest_per_entity(table.read(spark)))
    assert reads == [["a"], ["b"], ["c"]]
    assert summarize(spark, table, LATEST).count() == 500 and len(reads) == 3


def test_an_older_date_changes_nothing(spark, table):
    add(spark, table, "a", [("E1", "2024-07-05T10:00:00-04:00", "POSTED", 1)])
    summarize(spark, table, LATEST)
    add(spark, table, "b", [("e1 ", "2024-07-02T10:00:00-04:00", "POSTED", 1), (None, None, None, None)])
    assert summarize(spark, table, LATEST).collect() == [("E1", "2024-07-05")]


def test_a_restored_version_does_not_see_later_rows(spark, table, reads):
    add(spark, table, "a", facts(1, 50))
    summarize(spark, table, LATEST)
    add(spark, table, "b", facts(2, 50))
    summarize(spark, table, LATEST)
    restore(spark, table, 1, run_id="back", at=NOW)
    assert same(summarize(spark, table, LATEST), latest_per_entity(table.read(spark)))
    assert table.commit(spark).segments == ["a"] and reads == [["a"], ["b"]]


def test_rows_of_a_run_that_died_are_not_used(spark, table, reads):
    add(spark, table, "a", facts(1, 50))
    summarize(spark, table, LATEST)
    # Written, but never noted as stored.
    shutil.rmtree(f"{table.root}/summaries/latest/kept")
    add(spark, table, "b", facts(2, 50))
    assert same(summarize(spark, table, LATEST), latest_per_entity(table.read(spark)))
    assert reads == [["a"], ["a", "b"]]


def test_sample_of_parts_is_the_sample_of_the_whole(spark, table):
    kept = sample_summary(40, 7)
    for run, rows in [("a", facts(1, 500)), ("b", facts(1, 10, 495)), ("c", facts(2, 3000))]:
        add(spark, table, run, rows + rows[:3])
        assert same(summarize(spark, table, kept), uniform_sample(table.read(spark), 40, seed=7))
    other = sample_summary(40, 8)
    assert not same(summarize(spark, table, other), summarize(spark, table, kept))


def test_sketches_of_days_give_spans(spark, table):
    for day in (1, 2, 3):
        rows = [(f"E{i}", f"2024-07-0{day}T10:00:00-04:00", "POSTED", 1) for i in range(day * 4000, day * 4000 + 8000)]
        add(spark, table, f"r{day}", rows)
        sketches = summarize(spark, table, ENTITIES_BY_DAY)
    for first, last, exact in [("2024-07-01", "2024-07-01", 8000), ("2024-07-01", "2024-07-03", 16000), ("2025", "2026", 0)]:
        estimate = entities_between(sketches, first, last).first().entities
        assert abs(estimate - exact) <= 0.03 * exact
    assert sketches.agg(F.max(F.length("sketch"))).first()[0] < 8192


def test_empty_tables(spark, table):
    for summary in (LATEST, ENTITIES_BY_DAY, sample_summary()):
        assert summarize(spark, table, summary).count() == 0
    add(spark, table, "a", [])
    for summary in (LATEST, ENTITIES_BY_DAY, sample_summary()):
        assert summarize(spark, table, summary).count() == 0

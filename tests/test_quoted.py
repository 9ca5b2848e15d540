"""Records that run over lines: put together from ranges of bytes as Python's csv module reads whole files."""

import csv
import io
import os
import random

import pytest
from test_drops import NOW, put, rows

from obsledger.plans.build import build
from obsledger.plans.observe import Rules, observe
from obsledger.session import session_with
from obsledger.sources import quoted
from obsledger.sources.drops import _order_in_file, plan_drops
from obsledger.sources.manifest import scan_drops
from obsledger.sources.quoted import QuotedFiles, broken_files, problems_of
from obsledger.sources.table import FactTable


def small_splits(spark, size):
    return session_with(spark, {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "8"})


def random_csv(r, n):
    """Fields with quotes, commas, line breaks and literal quotes in unquoted fields."""
    lines = []
    for _ in range(n):
        fields = []
        for _ in range(r.randrange(1, 5)):
            if r.random() < 0.5:
                fields.append(r.choice(["", "a", '5" tall', 'x""y', "plain text", " lead", 'q"']))
            else:
                inner = "".join(r.choice(["a", ",", "\n", '""', "b c", "\n\n", ""]) for _ in range(r.randrange(6)))
                fields.append(f'"{inner}"' + r.choice(["", "", "tail", ' t"u']))
        lines.append(",".join(fields))
        if r.random() < 0.1:
            lines.append("")
    return "head,er\n" + "\n".join(lines) + "\n"


def csv_records(text):
    """The physical text of each record after the first, by Python's reader."""
    feed, taken = iter(text.split("\n")), []

    def watched():
        for line in feed:
            taken.append(line)
            yield line + "\n"

    out = []
    for row in csv.reader(watched()):
        if row:
            out.append("\n".join(taken))
        taken.clear()
    return out[1:]


@pytest.mark.parametrize("size", [16, 61, 4096])
def test_like_the_csv_module(spark, tmp_path, size):
    own, paths, expected = small_splits(spark, size), [], {}
    for seed in range(12):
        text = random_csv(random.Random(seed), 40)
        paths.append(put(str(tmp_path), f"f {seed}%.csv", text))
        expected[f"f {seed}%.csv"] = [x.removesuffix("\r") for x in csv_records(text)]
    found = QuotedFiles(own, paths, _order_in_file(own))
    assert found.problems() == {}
    got = {}
    for row in found.records().orderBy("file", "file_order").collect():
        got.setdefault(os.path.basename(quoted.plain_path(row.file)), []).append(row.record)
    assert got == {k: [x for x in v if x.strip(" \t\r")] for k, v in expected.items()}


def test_only_broken_files_are_found(spark, tmp_path):
    texts = {
        "plain.csv": "a,b\n1,2\n",
        "quotes.csv": 'a,b\n"1,""x""",5" tall\n"",""\n',
        "broken.csv": 'a,b\n"1\n2",3\n',
        "open.csv": 'a,b\n1,"2\n3,4\n',
        "odd, [x] 100%.csv": 'a,b\n"1\n2",3\n',
    }
    paths = [put(str(tmp_path), k, v) for k, v in texts.items()]
    broken = broken_files(spark, paths)
    assert {os.path.basename(p) for p in broken} == {"broken.csv", "open.csv", "odd, [x] 100%.csv"}
    problems = problems_of(spark, sorted(broken), _order_in_file(spark))
    assert {os.path.basename(p): why for p, why in problems.items()} == {"open.csv": quoted.UNCLOSED}
    assert broken_files(spark, []) == set() and problems_of(spark, [], _order_in_file(spark)) == {}


def test_long_records_are_set_aside(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(quoted, "MOST_BYTES", 200)
    text = 'a,b\n1,"x\n' + "y\n" * 200 + '",2\n3,4\n'
    path = put(str(tmp_path), "a.csv", text)
    assert problems_of(spark, [path], _order_in_file(spark)) == {path: quoted.TOO_LONG}


def test_false_rows_are_not_published(spark, tmp_path):
    """A record that read line by line would give an entity of its own."""
    root = str(tmp_path / "export")
    head = "entity_code,observed_at,submitted_posted_time\n"
    put(root, "wait_times/wdw/a.csv", head + '"MK\n2",2024-07-01 10:00:00,20\nMK1,2024-07-01 10:00:00,30\r\n')
    put(root, "wait_times/wdw/open.csv", head + 'MK3,2024-07-01 10:00:00,20\n"MK4,2024-07-01 10:00:00,30\n')
    put(root, "wait_times/wdw/plain.csv", head + "MK5,2024-07-01 10:00:00,5\n")
    put(root, "fastpass_times/wdw/b.csv",
        'NOTE,FATTID,FDAY,FMONTH,FYEAR,FHOUR,FMIN,FWINHR,FWINMIN\n'
        '"x\ny",E1,1,7,2024,10,0,10,30\n"z\n",E1,1,7,2024,10,0,10,40\nn,E2,1,7,2024,10,0,11,0\n"a\nb",E3,1,7,2024,10,0,11,0,9\n')
    facts = FactTable(str(tmp_path / "fact"))
    done = build(spark, root, facts, run_ts=NOW)
    at = "2024-07-01T10:00:00-04:00"
    assert rows(facts.read(spark)) == [
        ("E1", at, "PRIORITY", 40), ("E2", at, "PRIORITY", 60), ("MK\n2", at, "POSTED", 20),
        ("MK1", at, "POSTED", 30), ("MK5", at, "POSTED", 5),
    ]
    assert [(os.path.basename(p), why) for p, why in done.drops.rejected] == [("open.csv", quoted.UNCLOSED)]
    metrics = done.commit.metrics
    assert (metrics["collapsed_rows"], metrics["shifted_rows"], metrics["undated_rows"]) == (1, 1, 0)
    left = facts.left_out(spark, done.commit.run_id).collect()
    assert [(r.reason, "E3" in r.fields) for r in left] == [("shifted_rows", True)]
    # Files read whole by Spark's own reader give the same rows.
    drops = plan_drops(spark, scan_drops(spark, root), quoted_breaks=False)
    drops.layouts = {k: [p for p in v if "open" not in p] for k, v in drops.layouts.items()}
    whole = observe(spark, drops, Rules(multi_line=True)).rows
    assert rows(whole) == rows(facts.read(spark))


def test_random_file_reads_like_csv(spark, tmp_path):
    r = random.Random(5)
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    writer.writerow(["entity_code", "observed_at", "submitted_posted_time", "note"])
    expected = []
    for i in range(300):
        name = f"E{i}" + "".join(r.choice(["", "\n", ",", '"', " x"]) for _ in range(3)) + "z"
        note = "".join(r.choice(["n", "\n", ",", '"']) for _ in range(5))
        writer.writerow([name, "2024-07-01 10:00:00", i, note])
        expected.append((name.upper(), "2024-07-01T10:00:00-04:00", "POSTED", i))
    put(str(tmp_path), "export/wait_times/wdw/a.csv", out.getvalue())
    own = small_splits(spark, 128)
    drops = plan_drops(own, scan_drops(own, str(tmp_path / "export")))
    assert drops.broken and rows(observe(own, drops).rows) == sorted(expected)


def test_lines_are_written_once(spark, tmp_path, monkeypatch):
    """However many layouts, zones and passes read the files with records over lines."""
    root, made, head = str(tmp_path / "export"), [], "entity_code,observed_at,submitted_posted_time"
    for prop in ("wdw", "dlr", "tdr"):
        for k, names in enumerate((head, "note," + head)):
            put(root, f"wait_times/{prop}/{k}.csv", f'{names}\n' + "x," * k + f'"{prop}\n{k}",2024-07-01 10:00:00,2{k}\n')
    put(root, "wait_times/dlr/open.csv", head + '\n"a\nb",2024-07-01 10:00:00,1\n"c,2024-07-01 10:00:00,1\n')
    kept = QuotedFiles.__init__
    monkeypatch.setattr(QuotedFiles, "__init__", lambda self, *a, **k: (made.append(self), kept(self, *a, **k))[1])
    facts = FactTable(str(tmp_path / "fact"))
    build(spark, root, facts, run_ts=NOW, rules=Rules(day_order="infer"))
    found = sorted((e, m) for e, _, _, m in rows(facts.read(spark)))
    assert found == sorted((f"{p.upper()}\n{k}", 20 + k) for p in ("wdw", "dlr", "tdr") for k in (0, 1))
    assert len(made) == 1 and len(made[0].groups) == 6

import pytest
from pyspark.sql import functions as F

from obsledger.llm.on_corpus import RULES
from obsledger.llm.url_filters import Rule, judge_urls, reputation

URLS = [
    (1, "http://A.Example.ORG/es/1", "a.example.org", "/es/1", "example.org/es/", "block"),
    (2, "http://example.org/en/12?q=/es/", "example.org", "/en/12", "example.org/en/1", "block"),
    (3, "http://example.org/en/2#x", "example.org", "/en/2", "org/", "allow"),
    (4, "https://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
    (5, "https://x.com/fr/://y", "x.com", "/fr/://y", "com/fr/", "allow"),
    (6, "https://x.com/de/", "x.com", "/de/", "com/de/", "block"),
    (7, "https://x.com?de/", "x.com", "", None, None),
    (8, "x.com/de/", "", "", None, None),
    (9, None, "", "", None, None),
    (10, "", "", "", None, None),
    (11, "http://org", "org", "", None, None),
    (12, "a\nb://C.com/fr/\n#", "c.com", "/fr/\n", "com/fr/", "allow"),
    (12, "a\nb://C.com/fr/\n#", "c.com", "/fr/\n", "com/fr/", "allow"),
    (None, "http://É.com/de/", "É.com", "/de/", "com/de/", "block"),
]


def outcomes(spark, rows):
    return spark.createDataFrame(rows, "host string, good boolean")


def test_parts_and_rules(spark):
    pages = spark.createDataFrame([r[:2] for r in URLS], "page_id long, url string")
    pages = pages.withColumn("host", F.lit("old")).withColumn("name", F.lit("kept"))
    out = judge_urls(pages, outcomes(spark, []), RULES)
    assert "name" in out.columns
    got = [(r.page_id, r.url, r.host, r.path, r.rule, r.verdict if r.rule else None) for r in out.collect()]
    assert sorted(got, key=repr) == sorted(URLS, key=repr)


def test_longest_rule_wins(spark):
    pages = spark.createDataFrame([(1, "http://a.b.org/x/y")], "page_id long, url string")
    rules = [Rule("allow", "org", "/x/y"), Rule("block", "a.b.org", "/"), Rule("allow", "b.org", "/x")]
    assert judge_urls(pages, outcomes(spark, []), rules).first().rule == "a.b.org/"


def brute_reputation(rows, z=1.645):
    """Host, domain and suffix posteriors in plain Python."""
    names = {
        "suffix": lambda h: h.rsplit(".", 1)[-1],
        "domain": lambda h: ".".join(h.split(".")[-2:]),
        "host": lambda h: h,
    }
    above = {"suffix": lambda n: "", "domain": names["suffix"], "host": names["domain"]}
    k, n = sum(g for _, g in rows), len(rows)
    post = {("all", ""): (k + 1.0, n - k + 1.0)}
    upper = "all"
    for level, name in names.items():
        counts = {}
        for host, good in rows:
            a, b = counts.get(name(host), (0, 0))
            counts[name(host)] = (a + 1, b + good)
        mean = {x: post[upper, above[level](x)] for x in counts}
        mean = {x: a / (a + b) for x, (a, b) in mean.items()}
        pearson = sum((b - a * mean[x]) ** 2 / (a * mean[x] * (1 - mean[x])) for x, (a, b) in counts.items())
        more = sum(a - 1 for a, _ in counts.values())
        rho = min(0.99, max(0.001, (pearson - len(counts)) / more if more else 0.5))
        s = 1 / rho - 1
        for x, (a, b) in counts.items():
            post[level, x] = (b + mean[x] * s, a - b + (1 - mean[x]) * s)
        upper = level
    out = {}
    for key, (a, b) in post.items():
        m = a / (a + b)
        out[key] = (m, m - z * (m * (1 - m) / (a + b + 1)) ** 0.5)
    return out


def test_posteriors_like_brute_force(spark):
    rows = [(f"h{i % 7}.d{i % 3}.{'com' if i % 2 else 'org'}", i % 5 > 1 or i % 7 == 3) for i in range(200)]
    rows += [("bad.example.net", False)] * 30 + [("one.example.net", True), ("net", True), ("", False)]
    got = {(r.level, r.name): (r["mean"], r.bound) for r in reputation(outcomes(spark, rows)).collect()}
    expected = brute_reputation(rows)
    assert got.keys() == expected.keys()
    for key, value in expected.items():
        assert got[key] == pytest.approx(value)


def test_nearest_known_level_decides(spark):
    seen = [("bad.d.net", False)] * 60 + [("good.e.net", True)] * 60 + [("x.d.net", None), (None, True)]
    pages = spark.createDataFrame(
        [(1, "http://bad.d.net/"), (2, "http://other.d.net/"), (3, "http://good.e.net/"), (4, "http://z.zz/")],
        "page_id long, url string",
    )
    got = {r.page_id: (r.verdict, r.evidence) for r in judge_urls(pages, outcomes(spark, seen), []).collect()}
    assert got[1] == ("block", "host") and got[2] == ("block", "domain")
    assert got[3] == ("allow", "host") and got[4][1] == "all"


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert judge_urls(pages, outcomes(spark, []), RULES).count() == 0


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([r[:2] for r in URLS], "page_id long, url string")
    plan = judge_urls(pages, outcomes(spark, [("a", True)]), RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_owners_below_two_label_suffixes_are_told_apart(spark):
    seen = [("bad.co.uk:8080", False)] * 60 + [("www.good.co.uk", True)] * 60 + [("a.bad.github.io.", False)] * 60
    pages = spark.createDataFrame(
        [(1, "http://x.bad.co.uk/"), (2, "http://u:p@good.co.uk:443/"), (3, "http://new.co.uk"), (4, "http://BAD.CO.UK"),
         (5, "http://co.uk/"), (6, "http://bad.github.io:1")],
        "page_id long, url string",
    )
    out = judge_urls(pages, outcomes(spark, seen), [])
    got = {r.page_id: (r.host, r.verdict, r.evidence) for r in out.collect()}
    assert got[1] == ("x.bad.co.uk", "block", "domain") and got[4] == ("bad.co.uk", "block", "host")
    assert got[2] == ("u:p@good.co.uk:443", "allow", "domain")
    assert got[3][2] == got[5][2] == "suffix" and got[6] == ("bad.github.io:1", "block", "domain")
    one = judge_urls(pages, outcomes(spark, seen), [], suffixes=["b.c"])
    assert {r.evidence for r in one.where("page_id < 4").collect()} == {"domain"}
    names = {(r.level, r.name) for r in reputation(outcomes(spark, seen)).collect()}
    assert {("suffix", "co.uk"), ("suffix", "github.io"), ("domain", "bad.github.io"), ("host", "bad.co.uk")} <= names


def test_few_exchanges(spark):
    pages = spark.createDataFrame([r[:2] for r in URLS], "page_id long, url string")
    plan = judge_urls(pages, outcomes(spark, [("a", True)]), RULES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") < 30

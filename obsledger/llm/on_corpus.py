"""One query for each operator of this package, on the whole table it is meant for.

``QUERIES`` maps a name to the function, ``SQL`` to the statement that must give the same
rows, where SQL can say it. A query calls its operator and derives digests from what it returns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsledger.llm.bpe import decode, encode
from obsledger.llm.filter_audit import audit_filters
from obsledger.llm.fingerprints import fingerprint_edits
from obsledger.llm.hamming import top_k
from obsledger.llm.jaccard import jaccard_join
from obsledger.llm.line_dedup import drop_repeated_lines
from obsledger.llm.line_quality import fit_on_labels, held_out, score_documents
from obsledger.llm.mixing import mix_sources
from obsledger.llm.secret_scans import scan_secrets
from obsledger.llm.sharding import shard_documents
from obsledger.llm.suffix_dedup import drop_repeated_strings
from obsledger.llm.tables import read
from obsledger.llm.url_filters import Rule, host_of, judge_urls
from obsledger.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return register


@query("""
    WITH bits AS (SELECT vec_id, list_sum(list_transform(range(0, 64), lambda i:
                      CASE WHEN embedding[i + 1] > 0 THEN (1::HUGEINT << i) ELSE 0::HUGEINT END))::HUGEINT AS code
                  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
    near AS (SELECT q.vec_id AS query_id, v.vec_id, bit_count(xor(q.code, v.code))::BIGINT AS distance
             FROM bits q, bits v WHERE q.vec_id % 50 = 0),
    ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank,
                      vec_id, distance FROM near)
    SELECT query_id, rank, vec_id, distance FROM ranked WHERE rank <= 10""")
def op1_exact_top_k(spark, sf_dir):
    vectors = read(spark, sf_dir, "embeddings")
    found = top_k(vectors, vectors.where("vec_id % 50 = 0"), k=10, bits=64)
    return found.withColumnRenamed("id", "vec_id")


@query()
def op2_jaccard_join(spark, sf_dir):
    return jaccard_join(read(spark, sf_dir, "documents"))


@query()
def op3_fingerprints(spark, sf_dir):
    return fingerprint_edits(read(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


@query()
def op4_suffix_dedup(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_repeated_strings(docs).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query()
def op5_line_quality(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_on_labels(docs, read(spark, sf_dir, "labels"))
    return score_documents(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


@query("""
    WITH lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                          generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
    keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
    repeated AS (SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10
                 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
    judged AS (SELECT k.doc_id, k.pos, k.line, coalesce(k.doc_id <> r.first_doc, false) AS gone
               FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
    FROM judged GROUP BY doc_id""")
def op6_line_dedup(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_repeated_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


@query()
def op7_secret_scans(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    fixed = F.filter("secrets", lambda s: s["kind"] != "random")

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return scan_secrets(docs).select(
        "doc_id",
        *[count(k) for k in ("assign", "access", "hex")],
        F.sha2(listed(fixed), 256).alias("base_sha256"),
        listed(F.col("secrets")).alias("spans"),
    )


@query()
def op8_bpe(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return decode(encode(docs).drop("text")).select(
        "doc_id",
        "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


MIXED = """
    WITH sizes AS (SELECT source, sum(length(text))::DOUBLE AS size FROM documents GROUP BY source),
    rates AS (SELECT source, sum(size) OVER () * sqrt(size) / (SELECT sum(sqrt(size)) FROM sizes) / size AS rate
              FROM sizes),
    terms AS (SELECT source, j, exp(j * ln(rate) - rate - lgamma(j + 1)) AS p FROM rates, range(0, 100) t(j)),
    cdf AS (SELECT source, j, sum(p) OVER (PARTITION BY source ORDER BY j) AS c FROM terms),
    drawn AS (SELECT d.*, ('0x' || substr(md5(doc_id || ':1:1'), 1, 13))::BIGINT / 4503599627370496.0 AS u
              FROM documents d),
    counts AS (SELECT d.doc_id, (SELECT count(*) FROM cdf WHERE cdf.source = d.source AND cdf.c <= d.u) AS n
               FROM drawn d)
    SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, copy::INTEGER AS copy,
           ('0x' || substr(md5(d.doc_id || ':1:order:' || copy), 1, 13))::BIGINT / 4503599627370496.0 AS shuffle_key
    FROM documents d JOIN counts c USING (doc_id), range(1, c.n + 1) t(copy)"""


@query(MIXED)
def op9_mixing(spark, sf_dir):
    return mix_sources(read(spark, sf_dir, "documents"))


URLS = """
    WITH parts AS (SELECT page_id,
            translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's'),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path FROM pages),
    outcomes AS (SELECT host, count(*)::DOUBLE AS n, sum((quality = 1 AND toxic = 0)::INT)::DOUBLE AS k
                 FROM parts JOIN labels ON page_id = doc_id GROUP BY host),
    named AS (SELECT *, regexp_extract(host, '[^.]*$') AS suffix,
                     regexp_extract(host, '([^.]*[.])?[^.]*$') AS domain FROM outcomes),
    top AS (SELECT (coalesce(sum(k), 0) + 1.0) AS a, coalesce(sum(n) - sum(k), 0) + 1.0 AS b FROM named),
    s0 AS (SELECT suffix AS name, sum(n) AS n, sum(k) AS k, (SELECT a / (a + b) FROM top) AS m FROM named GROUP BY suffix),
    s1 AS (SELECT 1 / least(0.99, greatest(0.001, coalesce((sum(pow(k - n * m, 2) / (n * m * (1 - m))) - count(*))
                  / nullif(sum(n - 1), 0), 0.5))) - 1 AS s FROM s0),
    suffixes AS (SELECT name, k + m * s AS a, n - k + (1 - m) * s AS b FROM s0, s1),
    d0 AS (SELECT domain AS name, sum(n) AS n, sum(k) AS k, any_value(x.a / (x.a + x.b)) AS m
           FROM named JOIN suffixes x ON x.name = suffix GROUP BY domain),
    d1 AS (SELECT 1 / least(0.99, greatest(0.001, coalesce((sum(pow(k - n * m, 2) / (n * m * (1 - m))) - count(*))
                  / nullif(sum(n - 1), 0), 0.5))) - 1 AS s FROM d0),
    domains AS (SELECT name, k + m * s AS a, n - k + (1 - m) * s AS b FROM d0, d1),
    h0 AS (SELECT host AS name, n, k, x.a / (x.a + x.b) AS m FROM named JOIN domains x ON x.name = domain),
    h1 AS (SELECT 1 / least(0.99, greatest(0.001, coalesce((sum(pow(k - n * m, 2) / (n * m * (1 - m))) - count(*))
                  / nullif(sum(n - 1), 0), 0.5))) - 1 AS s FROM h0),
    hosts AS (SELECT name, k + m * s AS a, n - k + (1 - m) * s AS b FROM h0, h1),
    ruled AS (SELECT *, CASE
            WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
            WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
            WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
            WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
            WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule FROM parts),
    judged AS (SELECT r.*, coalesce(h.a, d.a, s.a, t.a) AS a, coalesce(h.b, d.b, s.b, t.b) AS b
        FROM ruled r CROSS JOIN top t
        LEFT JOIN hosts h ON h.name = host
        LEFT JOIN domains d ON d.name = regexp_extract(host, '([^.]*[.])?[^.]*$')
        LEFT JOIN suffixes s ON s.name = regexp_extract(host, '[^.]*$'))
    SELECT page_id, host, path, rule, CASE
        WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
        WHEN a / (a + b) - 1.645 * sqrt(a * b / pow(a + b, 2) / (a + b + 1)) >= 0.7 THEN 'allow' ELSE 'block' END AS verdict
    FROM judged"""


@query(URLS)
def op10_url_filters(spark, sf_dir):
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    labels = read(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good")
    )
    # A page's outcome is the label with its number.
    outcomes = pages.select("page_id", host_of(F.col("url")).alias("host")).join(labels, "page_id").select("host", "good")
    return judge_urls(pages, outcomes, RULES).select("page_id", "host", "path", "rule", "verdict")


@query()
def op11_whitening(spark, sf_dir):
    found = whiten(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    component = F.posexplode(F.arrays_zip("whitened", "explained")).alias("k", "c")
    return found.select("vec_id", "n", "deviation", "identity_error", component).select(
        "vec_id",
        (F.col("k") + 1).cast("int").alias("component"),
        "n",
        "deviation",
        "c.whitened",
        "c.explained",
        "identity_error",
    )


@query()
def op12_sharding(spark, sf_dir):
    return shard_documents(read(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


AUDIT = r"""
    WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
                          regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
    fails AS (SELECT doc_id, part, [len(words) < 100,
                  100 * len(list_distinct(words)) < 80 * len(words),
                  100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text),
                  regexp_matches(text, '[#$%&*|]'),
                  doc_id > min(doc_id) OVER (PARTITION BY text)] AS f FROM texts),
    judged AS (SELECT part, list_transform(f, lambda x: coalesce(x, false)) AS f,
                  list_sum(list_transform(f, lambda x: coalesce(x, false)::INT)) AS n_fails,
                  coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic
               FROM fails LEFT JOIN labels USING (doc_id)),
    cells AS (SELECT part, f, n_fails, good, toxic, count(*) AS n FROM judged GROUP BY ALL),
    letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 3, 4, 5]) AS i),
    orders AS (SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS o
               FROM letters a, letters b, letters c, letters d, letters e
               WHERE a.i <> b.i AND a.i <> c.i AND a.i <> d.i AND a.i <> e.i AND b.i <> c.i AND b.i <> d.i
                 AND b.i <> e.i AND c.i <> d.i AND c.i <> e.i AND d.i <> e.i),
    at_step AS (SELECT part, filter_order, step, o[step] AS letter, n, n_fails, good, toxic, f[o[step]] AS fails,
                       len(list_filter(o[1:step - 1], lambda k: f[k])) > 0 AS out
                FROM cells, orders, range(1, 6) t(step)),
    counted AS (SELECT part, filter_order, step::INTEGER AS step, letter,
            coalesce(sum(n) FILTER (NOT out AND NOT fails), 0)::BIGINT AS kept,
            coalesce(sum(n) FILTER (NOT out AND fails), 0)::BIGINT AS removed,
            coalesce(sum(n) FILTER (out AND fails), 0)::BIGINT AS redundant,
            coalesce(sum(n) FILTER (fails AND n_fails = 1), 0)::BIGINT AS unique_fails,
            coalesce(sum(n) FILTER (NOT out AND fails AND good), 0)::BIGINT AS good_lost,
            coalesce(sum(n) FILTER (NOT out AND fails AND toxic), 0)::BIGINT AS toxic_lost
        FROM at_step GROUP BY ALL)
    SELECT * EXCLUDE (letter), (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM counted"""


@query(AUDIT)
def op13_filter_audit(spark, sf_dir):
    return audit_filters(read(spark, sf_dir, "documents").select("doc_id", "text", "lang"), read(spark, sf_dir, "labels"))

import hashlib
import random
import re
import string

from helpers import documents, table
from pyspark.sql import functions as F

from obsledger.llm import on_corpus
from obsledger.llm.secret_scans import redact, scan_secrets

BASE = {
    "assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6),
    "access": (r"AKIA[A-Z0-9]+", 20),
    "hex": (r"[0-9a-f]+", 24),
}


def brute(text):
    found = []
    for kind, (pattern, least) in BASE.items():
        flags = re.ASCII | (re.IGNORECASE if kind == "assign" else 0)
        for m in re.finditer(pattern, text or "", flags):
            if len(m.group(2 if kind == "assign" else 0)) >= least:
                found.append((m.start(), list(BASE).index(kind), kind, m.end()))
    return [(k, a, b) for a, _, k, b in sorted(found)]


r = random.Random(4)
RANDOM = "".join(r.choice(string.ascii_letters + string.digits) for _ in range(40))
TEXTS = [
    None, "", "token=token=abcdefgh", "secret: token: abcdefgh", "PASSWD = 'x.y/z+1='", "apikey:abcde api_key=abcdef",
    "toKen=abcdef ſecret=abcdef", "AKIA" + "A" * 16 + " AKIA" + "B" * 15 + " xAKIAAKIA" + "C" * 12,
    "0" * 23 + "g" + "f" * 24 + "G" + "a" * 200_000, "é😀password=1234567 password\t=abcdefg", "Password  =  \"\"abcdefg",
    f"here {RANDOM} there", f"token={RANDOM}", hashlib.sha1(b"x").hexdigest().upper(),
    "6F9619FF-8B86-D011-B42D-00C04FC964FF", "internationalisation_of_words", "2024-01-02/2024-02-03_1234",
    "deadbeefdeadbeefdeadbeef secret=deadbeefdeadbeefdeadbeef",
]


def spans(df):
    return {r.doc_id: [tuple(s) for s in r.secrets] for r in df.collect()}


def test_base_spans_like_brute_force(spark):
    texts = TEXTS + table("documents").text.tolist()
    docs = documents(spark, list(enumerate(texts))).withColumn("secrets", F.lit("old")).withColumn("kind", F.lit(1))
    got = spans(scan_secrets(docs))
    for i, text in enumerate(texts):
        assert [s for s in got[i] if s[0] != "random"] == brute(text)


def test_random_strings_but_no_known_forms(spark):
    got = spans(scan_secrets(documents(spark, list(enumerate(TEXTS)))))
    by_random = {i for i, s in got.items() if any(k == "random" for k, _, _ in s)}
    assert by_random == {TEXTS.index(f"here {RANDOM} there")}
    assert ("random", 5, 45) in got[TEXTS.index(f"here {RANDOM} there")]


def test_query_digests(spark, tmp_path):
    documents(spark, list(enumerate(TEXTS))).write.parquet(str(tmp_path / "documents.parquet"))
    for row in on_corpus.QUERIES["op7_secret_scans"](spark, str(tmp_path)).collect():
        base = brute(TEXTS[row.doc_id])
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert row.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(sum(k == x for k, _, _ in base) for x in BASE)
        assert set(text.split(",")) - {""} <= set(row.spans.split(","))


def test_redaction(spark):
    rows = [(1, f"a token={RANDOM} b"), (2, "deadbeef" * 3), (3, None), (4, "clean 😀"), (5, "x secret=" + "ab12" * 6)]
    got = {r.doc_id: r.text for r in redact(scan_secrets(documents(spark, rows))).collect()}
    assert got == {1: "a <SECRET> b", 2: "<SECRET>", 3: None, 4: "clean 😀", 5: "x <SECRET>"}


def test_empty_table(spark):
    assert scan_secrets(documents(spark, [])).count() == 0


def test_random_strings_beside_words_and_fixed_spans(spark):
    words, keys = "/services/production/database/credentials/", random.Random(5)
    made = lambda alphabet, n: "".join(keys.choice(alphabet) for _ in range(n))
    mixed = [words + made(string.ascii_letters + string.digits, n) for n in (16, 20, 24, 32) for _ in range(20)]
    letters = [made(string.ascii_letters, 32) for _ in range(20)]
    plain = [words, "a_b_c_d_e_f_g_h_i_j_k_l", "-+" * 20, "org/apache/catalyst/expressions/GenerateUnsafeProjection"]
    glued = [made(string.ascii_letters + string.digits, 20) + "Z" + "deadbeef" * 3]
    texts = mixed + letters + plain + glued
    got = spans(scan_secrets(documents(spark, list(enumerate(texts)))))
    for i, text in enumerate(texts):
        found = [s for s in got[i] if s[0] == "random"]
        if text in plain:
            assert not found
        elif text in glued:
            assert found == [("random", 0, 21)]
        else:
            start = len(words) if text in mixed else 0
            assert any(a <= start and b == len(text) for _, a, b in found), text

"""Secret spans against Python's re, one live rule for query, SQL and redaction,
repositories in the verdict, linear patterns."""
import hashlib
import random
import re
import time

from test_llm_native import SECRETS, check
from test_llm_redaction import pem

from orderlens.llm import secrets

BASE = {"assign": r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        "access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]+"}
MORE = ["eyJ", ".", "-", "x", "eyJa.eyJb.c", "_eyJ1.eyJ2", pem(1), pem(2, nl="\\n"), pem(3, end=False), "-----END RSA PRIVATE KEY-----",
        "api-key: ", "0000", "xxxx", "1234567890"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def base_spans(text):
    out = []
    for place, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text, re.I | re.A if kind == "assign" else 0):
            if len(m[2] if kind == "assign" else m[0]) >= {"assign": 8, "access": 16, "hex": 32}[kind]:
                out.append((m.start(), place, f"{kind}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(out)]


def test_spans_against_re_and_sql(spark, duck):
    random.seed(21)
    rows = [(i, "".join(random.choice(SECRETS + MORE) for _ in range(random.randint(0, 12))), "en", f"s{i % 4}/r{i % 23}", 1)
            for i in range(800)]
    df = spark.createDataFrame(rows, DOCS)
    check(secrets.scan_secrets(df), duck, secrets.ORACLES["op7_scan_secrets"], rows)
    for r in secrets.scan_secrets(df).collect():
        text = rows[r.doc_id][1]
        base = base_spans(text)
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert [s for s in spans if s.split(":")[0] in BASE] == base
        jwt = [f"jwt:{m.start()}:{m.end()}" for m in re.finditer(secrets.PATTERNS["jwt"], text)]
        keys = [f"pem:{m.start()}:{m.end()}" for m in re.finditer(secrets.PATTERNS["pem"], text)]
        assert [s for s in spans if s.startswith("jwt")] == jwt and [s for s in spans if s.startswith("pem")] == keys


def test_one_live_rule(spark, duck):
    """What the query calls live is what redaction takes away."""
    filled = "a1b2c3d4e5f60000a7b8c9d0e1f2a3b4c5d6e7f8"  # random digits that hold 0000
    rows = [(1, f"x {pem(1)} y", "a/x"), (2, "token: k3J9x2Lq8w", "a/x"), (3, filled, "a/x"), (4, "password=k0000000000000b1", "a/x"),
            (5, "secret=example12Zq9", "a/x"), (6, "-----BEGIN RSA PRIVATE KEY----- alone", "a/x"), (7, "passwd=Zq7!", "a/x")]
    rows = [(i, t, "en", s, 1) for i, t, s in rows]
    df = spark.createDataFrame(rows, DOCS)
    out = secrets.scan_secrets(df)
    check(out, duck, secrets.ORACLES["op7_scan_secrets"], rows)
    got = {r.doc_id: r for r in out.collect()}
    assert [got[i].n_live for i in range(1, 8)] == [1, 1, 1, 0, 0, 0, 0]
    assert got[1].live_spans == f"pem:2:{len(pem(1)) + 2}"
    clean = {r.doc_id: r.text for r in secrets.redact_live(df).collect()}
    assert {i for i in got if clean[i] != rows[i - 1][1]} == {i for i in got if got[i].n_live}


def test_repositories_in_the_verdict(spark, duck):
    one, two, few = "Zx9kQ2mLp8Rt4Vw7", "Yk3nB6vHq1Ws5Ed8", "Hb5cT8uJw2Xz6Lm4"
    texts = ([(f"secret={one}", f"a/r{i}") for i in range(12)]  # one owner's, in many repositories
             + [(f"secret={two}", f"{'ab'[i % 2]}/r{i}") for i in range(10)]  # two owners, ten repositories
             + [(f"secret={few}", f"{'ab'[i % 2]}/r{i}") for i in range(9)])
    rows = [(i, t, "en", s, 1) for i, (t, s) in enumerate(texts)]
    out = secrets.scan_secrets(spark.createDataFrame(rows, DOCS))
    check(out, duck, secrets.ORACLES["op7_scan_secrets"], rows)
    got = {r.doc_id: (r.n_live, r.n_example, r.live_repositories) for r in out.collect()}
    assert got[0] == (1, 0, 12) and got[12] == (0, 1, 0) and got[22] == (1, 0, 9)


def test_long_runs_take_linear_time(spark):
    texts = ["eyJ" * 350000, "eyJa." * 200000, "eyJ-" * 250000 + ".eyJ", "eyJa.eyJ" * 120000, "AKIA" * 250000,
             "-----BEGIN " + "A" * 10 ** 6, "password" * 120000, "gho_" * 250000, "0123456789abcdef" * 60000]
    df = spark.createDataFrame([(i, t, "a/x") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    began = time.time()
    assert secrets.scan_secrets(df).count() == len(texts) and time.time() - began < 90


def test_many_spans_are_placed_in_parts(spark):
    random.seed(22)
    texts = ["é😀 ".join(f"AKIA{random.randint(10 ** 13, 10 ** 20)}" for _ in range(n)) for n in (127, 128, 129, 256, 257, 1000)]
    df = spark.createDataFrame([(i, t, "a/x") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    for r in secrets.scan_secrets(df).collect():
        assert [s for s in r.spans.split(",") if s.startswith("access")] == [
            f"access:{m.start()}:{m.end()}" for m in re.finditer(BASE["access"], texts[r.doc_id])]

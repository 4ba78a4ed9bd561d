"""Redaction of private keys with their bodies and of short assigned values."""
import base64
import hashlib

from orderlens.llm import secrets


def pem(seed, kind="RSA ", fields="", end=True, nl="\n"):
    body = base64.b64encode(b"".join(hashlib.sha256(f"{seed}{i}".encode()).digest() for i in range(30))).decode()
    lines = nl.join(body[i:i + 64] for i in range(0, len(body), 64))
    return f"-----BEGIN {kind}PRIVATE KEY-----{nl}{fields}{lines}" + (f"{nl}-----END {kind}PRIVATE KEY-----" if end else "")


def redacted(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return {r.doc_id: r.text for r in secrets.redact_live(df).collect()}


def test_private_keys(spark):
    shared, empty = pem("shared"), "-----BEGIN RSA PRIVATE KEY-----\n...\n-----END RSA PRIVATE KEY-----"
    fields = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0A1B\n\n"
    rows = [(1, f"a {pem(1)} b", "a/x"), (2, f"{pem(2)}\n{pem(3, fields=fields)}", "b/x"), (3, pem(4, nl="\\n"), "c/x"),
            (4, shared, "a/x"), (5, shared, "b/x"), (6, "é " + pem("shared", nl="\\n"), "c/x"), (7, empty, "d/x"),
            (8, "-----BEGIN RSA PRIVATE KEY----- is a header", "e/x"),
            (9, "-----BEGIN RSA PRIVATE KEY-----\n" + "- item\n" * 50000, "f/x")]
    got = redacted(spark, rows)
    assert got[1] == "a [SECRET] b" and got[2] == "[SECRET]\n[SECRET]" and got[3] == "[SECRET]"
    assert all(got[i] == text for i, text, _ in rows[3:])


def test_short_assigned_values(spark):
    rows = [(1, "password=Zx9kQ2mL!", "a/x"), (2, "token: k3J9x2Lq8w", "b/x"), (3, "secret=hunterhunter", "c/x"),
            (4, "secret=example12", "c/x"), *[(5 + i, "api_key=Qw7zR4tY9p", f"o{i}/x") for i in range(3)]]
    got = redacted(spark, rows)
    assert got[1] == "[SECRET]!" and got[2] == "[SECRET]"
    assert all(got[i] == text for i, text, _ in rows[2:])

"""Spans and links against a plain Python scan over all pairs; redaction; edge cases."""

import hashlib
import random
import re

from helpers import SF_SMALL, documents, save
from pyspark.sql import functions as F

from tripwise.llm import secrets as sc
from tripwise.llm.queries import QUERIES

ASSIGN = re.compile(r"""((?:(?i:password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def plain(text, scope=sc.SCOPE):
    text = text or ""
    base = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    base += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
    base += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if m.end() - m.start() >= 24]
    weak = [(m.start(), k, m.end()) for k, p in ((3, sc.KEYID), (4, sc.BLOB), (5, sc.ENDPOINT)) for m in re.finditer(p, text, re.A)]
    every, out = base + weak, list(base)
    for s, k, e in weak:
        if any(s < f and b < e for b, _, f in base):
            continue
        near = 0
        for b, c, f in every:
            if b - scope < e and f + scope > s:
                near |= sc.CLASS[c]
        if near & sc.NEEDS[k] == sc.NEEDS[k]:
            out.append((s, k, e))
    show = lambda spans: ",".join(f"{sc.KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))
    return (*[sum(k == i for _, k, _ in base) for i in range(3)], hashlib.sha256(show(base).encode()).hexdigest(), show(out))


def made(seed=4, n=150):
    rng = random.Random(seed)
    bits = ['password = "hunter22"', "TOKEN:abc", "secret=token:abcdefgh", "api_key: 'A/b+c_d.e=f-'", "ApiKey==", "AKIA" + "Q7" * 9,
            "AKIASHORT", "0123456789abcdef" * 3, "deadbeef" * 3, "deadbee" * 3, "username: admin", "client_id=app-7", "login = bob.b",
            "wJalrXUtnFEMIK7MDENGbPxRfiCYEXAMPLEKEY", "https://db.example.com:5432/x", "10.0.0.1:8080", "postgres://h/db", "é😀ü", "passwd"]
    return [rng.choice([" ", "\n"]).join(rng.choice(bits) if rng.random() < 0.3 else rng.choice(["lorem", "ipsum", "ä" * 90, "d"])
                                         for _ in range(rng.randint(1, 60))) for _ in range(n)]


def test_query_equals_a_plain_scan(spark, tmp_path):
    texts = made() + [None, "", "\n", "user: x1y " + "z " * 3000 + "secret=abcdef1", "AKIA" + "A" * 16 + " " + "aB3" * 10]
    rows = QUERIES["op4_secret_scans"](spark, save(documents(spark, texts), tmp_path)).collect()
    got = {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in rows}
    assert len(rows) == len(texts) and got == {i: plain(t) for i, t in enumerate(texts)}
    assert any(k in got[i][4] for i in got for k in ("keyid", "blob", "endpoint"))


def test_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = QUERIES["op4_secret_scans"](spark, SF_SMALL).collect()
    assert {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in rows} == {i: plain(t) for i, t in texts.items()}


def test_redaction(spark):
    texts = made(9, 60) + [None, ""]
    rows = sc.redact(documents(spark, texts).withColumn("kind", F.lit("clash"))).collect()
    assert len(rows) == len(texts) and rows[0].__fields__ == ["doc_id", "text", "lang", "source", "n_chars", "kind"]
    for r in rows:
        want, at = texts[r.doc_id], 0
        spans = sorted(tuple(map(int, s.split(":")[1:])) for s in plain(want)[4].split(",") if s)
        holes = []
        for s, e in spans:
            if holes and s <= holes[-1][1]:
                holes[-1][1] = max(e, holes[-1][1])
            else:
                holes.append([s, e])
        if holes:
            want = "".join(want[a:b] + "[SECRET]" for (_, a), (b, _) in zip([(0, 0), *holes], holes)) + want[holes[-1][1]:]
        assert r.text == want


def test_repeated_empty_and_long(spark, tmp_path):
    long = ("token=abcdef%d " * 4000) % tuple(range(4000))
    df = documents(spark, ["secret: abcdefg"] * 3 + [long, None], [1, 1, None, 2, 1]).withColumn("h1", F.lit("clash"))
    rows = QUERIES["op4_secret_scans"](spark, save(df, tmp_path / "a")).collect()
    assert sorted((r.n_assign, r.base_sha256) for r in rows) == sorted(plain(t)[0::3] for t in ["secret: abcdefg"] * 3 + [long, None])
    assert QUERIES["op4_secret_scans"](spark, save(df.limit(0), tmp_path / "e")).count() == 0


def test_redaction_keeps_columns_named_like_its_helpers(spark):
    docs = documents(spark, ["token = abcdefgh and more", "plain words", None])
    for c in ("h1", "h2", "holes", "__h1", "__holes"):
        docs = docs.withColumn(c, F.lit(f"of {c}"))
    rows = sc.redact(docs).orderBy("doc_id").collect()
    assert rows[0].__fields__ == docs.columns
    assert [r.text for r in rows] == ["[SECRET] and more", "plain words", None]
    assert all(r[c] == f"of {c}" for r in rows for c in ("h1", "h2", "holes", "__h1", "__holes"))

"""The trie against plain dictionaries of prefixes."""

import hashlib
import random
import re
import zlib

import duckdb
import pytest
from helpers import SF_MID, save
from pyspark.sql import functions as F

from tripwise.llm import prefix_trie as pt
from tripwise.llm.queries import ORACLE, QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = own.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])
        out[c] = base[:h] + turns[h:]
    return out


def plain_nodes(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    rows = []
    for p, of in members.items():
        sub = [q for q in members if q[:len(p)] == p]
        leaves = [q for q in sub if not any(len(x) == len(q) + 1 and x[:-1] == q for x in sub)]
        saved = sum((len(members[q]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) for q in sub if q)
        ends = ",".join(map(str, sorted(c for c in of if len(convs[c]) == len(p))))
        rows.append((min(of), len(p), min(members[p[:-1]]) if p else None, len(of),
                     sum(len(q) == len(p) + 1 for q in sub), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return rows


def random_turns(rng, n, longest, words=3):
    rows = []
    for c in rng.sample(range(-30, 4 * n), n):
        for t in range(rng.randint(1, longest)):
            text = " ".join(rng.choice(["a", "b c", "\n"]) for _ in range(rng.randint(0, words)))
            rows.append((c, rng.choice([t, t, t, None, 0]), rng.choice(["user", "user", None, ""]), rng.choice([text, text, None])))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("n, longest, words", [(60, 6, 1), (40, 25, 1), (150, 3, 3)])
def test_query_equals_plain_prefixes(spark, tmp_path, n, longest, words):
    rows = random_turns(random.Random(n), n, longest, words)
    df = frame(spark, rows).withColumn("place", F.lit("clash")).withColumn("path", F.lit(1)).withColumn("key", F.lit(2))
    got = QUERIES["op11_conversation_trie"](spark, save(df, tmp_path, "conversations")).collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain_nodes(plain_rebuilt(rows)), key=str)


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF_MID}/conversations.parquet'")
    want = con.execute(ORACLE["op11_conversation_trie"]).fetchall()
    got = QUERIES["op11_conversation_trie"](spark, SF_MID)
    assert got.columns == [d[0] for d in con.description]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_empty_table_null_ids_and_turnless_conversations(spark, tmp_path):
    run = QUERIES["op11_conversation_trie"]
    assert run(spark, save(frame(spark, []), tmp_path / "e", "conversations")).count() == 0
    rows = [(None, 0, "user", "lost"), *((c, 0, "user", "x") for c in range(21, 31))]  # conversation 20 is absent
    got = run(spark, save(frame(spark, rows), tmp_path / "t", "conversations")).collect()
    want = plain_nodes(plain_rebuilt(rows))
    assert any(r[1] == 0 and r[7] != hashlib.sha256(b"").hexdigest() for r in want)  # some have no turn left
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_fat_binary_search_finds_the_deepest_node():
    assert [pt.fattest(a, b) for a, b in [(0, 1), (0, 3), (4, 7), (5, 6), (3, 12), (8, 15)]] == [1, 2, 6, 6, 8, 12]
    rng = random.Random(2)

    def path(letters):
        key, keys = pt.ROOT, []
        for x in letters:
            key = hashlib.blake2b(key + x.encode(), digest_size=pt.KEY).digest()
            keys.append(key)
        return b"".join(keys)
    texts = ["".join(rng.choice("ab") for _ in range(rng.choice([0, 1, 3, 8, 30, 100]))) for _ in range(300)]
    texts += [t[:rng.randint(0, len(t))] + "c" * rng.randint(0, 40) for t in texts]
    trie = pt.ZFastTrie()
    for at in range(0, len(texts), 64):
        trie.insert_batch([(path(t), (1,) * len(t), 1, i) for i, t in enumerate(texts[at:at + 64], at)])
    held = {trie.path[i][:pt.KEY * trie.depth[i]] for i in range(len(trie))}
    assert len(held) == len(trie) == len(trie.handles) + 1
    for t in texts + ["".join(rng.choice("abc") for _ in range(50)) for _ in range(100)]:
        deepest = max(d for d in range(len(t) + 1) if path(t[:d]) in held)
        assert trie.depth[trie.locate(path(t))] == deepest
    got = {key: (n, least) for key, _, _, _, n, least in trie.expanded()}
    want = {}
    for i, t in enumerate(texts):
        for d in range(len(t) + 1):
            n, least = want.get(t[:d], (0, i))
            want[t[:d]] = n + 1, min(least, i)
    assert got == {(path(t)[-pt.KEY:] or pt.ROOT): v for t, v in want.items()}


def test_tries_begun_anew_and_pieces_of_ids_add_up(spark, monkeypatch):
    rng = random.Random(9)
    convs = {c: [("user", rng.choice("xy")) for _ in range(rng.randint(0, 5))] for c in range(300)}
    df = spark.createDataFrame([(c, [(hashlib.md5(repr(t).encode()).digest(), len(t[1].split())) for t in turns])
                                for c, turns in convs.items()], "conv_id long, turns array<struct<digest: binary, words: int>>")
    whole = sorted(plain_nodes(convs), key=str)
    monkeypatch.setattr(pt, "PER_TASK", 20)
    assert sorted(map(tuple, pt.trie(df, max_nodes=10).collect()), key=str) == whole
    members = pt.paths(df)
    few = {bytes(r.last): r.ends for r in pt.ends(members, piece=3).collect()}
    assert few == {bytes(r.last): r.ends for r in pt.ends(members).collect()}

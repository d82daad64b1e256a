"""Fingerprints against a plain Python version of the same selection; next documents; edge cases."""

import hashlib
import random
import re

import pytest
import xxhash
from helpers import SF_SMALL, documents, save

from tripwise.llm import order_minhash as om
from tripwise.llm.queries import QUERIES


def columns(rows):
    return {r.doc_id: r for r in rows}


def neighbours(texts):
    """Number of characters, edited text and next id of every document."""
    ids = sorted(texts)
    out = {}
    for i, j in zip(ids, [*ids[1:], ids[0]]):
        t, u = texts[i] or "", texts[j] or ""
        out[i] = (len(t), t[:len(t) - len(t) // 2] + u[:len(t) // 2], j)
    return out


@pytest.mark.parametrize("rows_per_bucket", [1000, 7])
def test_edited_texts_and_likeness(spark, tmp_path, monkeypatch, rows_per_bucket):
    monkeypatch.setattr(om, "ROWS_PER_BUCKET", rows_per_bucket)
    rng = random.Random(6)
    vocab = ["w%d" % i for i in range(300)] + ["é😀", "日本"]
    texts = {i * 7: " ".join(rng.choices(vocab, k=rng.choice([0, 1, 2, 3, 40, 300]))) for i in range(120)}
    texts |= {1: None, 2: "", 3: "x", 9: "same text here and there again", 10: "same text here and there again", 11: "again " * 500}
    rows = columns(QUERIES["op6_order_minhash"](spark, save(documents(spark, list(texts.values()), list(texts)), tmp_path)).collect())
    assert rows.keys() == texts.keys()
    prints = {}
    for i, (n, edited, j) in neighbours(texts).items():
        r = rows[i]
        assert r.n_chars == n and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = r.fingerprint, r.edited_fingerprint, rows[j].fingerprint
        same = lambda x, y: sum(x[k:k + 8] == y[k:k + 8] for k in range(0, 8 * om.SLOTS, 8)) / om.SLOTS
        assert len(a) == len(b) == 8 * om.SLOTS and r.near_edited == same(a, b) and r.near_next == same(a, c)
        for text, f in (((texts[i] or ""), a), (edited, b)):
            assert prints.setdefault(text, f) == f
    assert rows[9].near_next == 1 and rows[9].fingerprint == rows[10].fingerprint


def spark_hash(x, seed=42):
    """xxhash64 of a long or a string as the SQL function has it, signed."""
    raw = x.encode() if isinstance(x, str) else (x & (1 << 64) - 1).to_bytes(8, "little")
    h = xxhash.xxh64_intdigest(raw, seed)
    return h - (1 << 64) if h >> 63 else h


def chained(values):
    seed = 42
    for v in values:
        seed = spark_hash(v, seed & (1 << 64) - 1)
    return seed


def plain_sketch(text):
    words = re.findall(r"[^ \t\n\x0b\f\r]+", text or "") or [""]
    letters, k, whole = words, om.WORDS, " ".join(words)
    if len(words) < k or sum(map(len, words)) > om.LONG * len(words):
        letters, k = whole, om.CHARS
    hashes = [chained([whole])] if len(letters) < k else [chained(letters[i:i + k]) for i in range(len(letters) - k + 1)]
    seen, values = {}, []
    for i, h in enumerate(hashes):
        top = h >> 24
        k = seen[top] = seen.get(top, -1) + 1
        if k:  # later occurrences hash with their number (a 32-bit integer)
            raw = xxhash.xxh64_intdigest(k.to_bytes(4, "little"), spark_hash(top) & (1 << 64) - 1)
            h = raw - (1 << 64) if raw >> 63 else raw
        values.append((h >> 24, i))
    values.sort()
    out = []
    for slot in range(-om.SLOTS // 2, om.SLOTS // 2):
        j = next((j for j, (h, _) in enumerate(values) if h >> 35 >= slot), 0)
        pick = sorted({j, (j + 1) % len(values)}, key=lambda j: values[j][1])
        out.append(f"{chained([values[j][0] for j in pick]) & 0xFFFFFFFF:08x}")
    return "".join(out)


def test_selection_equals_a_plain_version(spark):
    rng = random.Random(1)
    texts = ["", "a", "a b", "a b c", "a b c a b c a b c", "x " * 200, "\n a b c d \t", "日本語" * 40, "é😀" * 3, "abcdefgh " + "x" * 90,
             ("w" * 40 + " ") * 5, ("w" * 20 + " " * 30) * 5, "x" * 5000] + [
        " ".join(rng.choices("abcdefg" if i % 2 else [f"v{k}" for k in range(500)], k=rng.randint(1, 200))) for i in range(60)]
    df = om.with_sketch(documents(spark, texts), "text", "f").select("doc_id", om.as_text("f").alias("f"))
    assert {r.doc_id: r.f for r in df.collect()} == {i: plain_sketch(t) for i, t in enumerate(texts)}


def test_likeness_falls_with_edits_and_with_moved_passages(spark):
    rng = random.Random(2)
    words = [f"v{rng.randrange(5000)}" for _ in range(2000)]
    half = [f"u{rng.randrange(5000)}" for _ in range(2000)]
    few = list(words)
    for i in range(0, 2000, 200):
        few[i] = "edited"
    cases = [words, few, words[1000:] + words[:1000], words[:1000] + half[:1000], half]
    rows = om.with_sketch(documents(spark, [" ".join(c) for c in cases]), "text", "f").orderBy("doc_id").select("f").collect()
    like = [sum(a == b for a, b in zip(rows[0].f, r.f)) / om.SLOTS for r in rows]
    assert like[0] == 1 and like[1] > 0.7 and like[1] > like[3] > like[4] == 0 and like[2] < 0.8


def test_white_space_around_and_between_words_changes_nothing(spark):
    texts = ["so it goes on and on", "\nso  it goes\ton and on", "so it goes on and on \r\n", "日本語の文", "\t日本語の文\n"]
    rows = om.with_sketch(documents(spark, texts), "text", "f").orderBy("doc_id").collect()
    assert rows[0].f == rows[1].f == rows[2].f != rows[3].f == rows[4].f


def test_an_edit_of_a_text_without_spaces_changes_a_part_only(spark):
    rng = random.Random(4)
    text = "".join(chr(0x4E00 + rng.randrange(2000)) for _ in range(300))
    edited = "".join("x" if i in (60, 150, 240) else c for i, c in enumerate(text))
    rows = om.with_sketch(documents(spark, [text, edited, text[::-1]]), "text", "f").orderBy("doc_id").collect()
    like = [sum(a == b for a, b in zip(rows[0].f, r.f)) / om.SLOTS for r in rows]
    assert like[0] == 1 > like[1] > 0.7 and like[2] < 0.2


def test_empty_single_repeated_and_null_ids(spark, tmp_path):
    q = QUERIES["op6_order_minhash"]
    assert q(spark, save(documents(spark, []), tmp_path / "e")).count() == 0
    one = q(spark, save(documents(spark, ["just one document"]), tmp_path / "1")).collect()
    assert [r.near_next for r in one] == [1.0]
    rows = q(spark, save(documents(spark, ["b b b", "a a a", "c c c", "b b b"], [4, 4, None, 4]), tmp_path / "r")).collect()
    assert len(rows) == 4
    # In order: null "c c c", then 4 "a a a", "b b b", "b b b"; two characters come from the next one.
    edited = ["c c" + "a ", "a a" + "b ", "b b" + "b ", "b b" + "c "]
    assert sorted(r.edited_sha256 for r in rows) == sorted(hashlib.sha256(e.encode()).hexdigest() for e in edited)


def test_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = columns(QUERIES["op6_order_minhash"](spark, SF_SMALL).collect())
    want = neighbours(texts)
    assert {i: (r.n_chars, r.edited_sha256) for i, r in rows.items()} == {
        i: (n, hashlib.sha256(e.encode()).hexdigest()) for i, (n, e, _) in want.items()}
    assert {i: r.fingerprint for i, r in rows.items()} == {i: plain_sketch(t) for i, t in texts.items()}

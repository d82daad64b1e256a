"""Packing, token files and the lexicon against the tokenizers library on whole texts."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import SF_SMALL, documents, save
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tripwise.llm import bpe_lexicon as bl
from tripwise.llm import common as cm
from tripwise.llm import huffman as hf
from tripwise.llm import packing as pk
from tripwise.llm.common import TokenMemo, tokenizer_path
from tripwise.llm.queries import QUERIES

WORD, BYTE = tokenizer_path("word_bpe_49k.json"), tokenizer_path("byte_bpe_50k.json")
ODD = [None, "", " ", "\n\n", "a", "Hello  World\n\n it's  \t done ", "<|endoftext|>", "x <|endoftext|>  y<|startoftext|>z",
       "ΑΣ ΣΑΣ ὈΔΥΣΣΕΎΣ", "é Å ﬁ ½ x² ١٢", "İstanbul ǅ", "\x1c\x1d a\x1eb", " a b　c\x85d", "日本語テキスト", "😀👩‍👩‍👧 🇩🇪",
       "don't WE'LL they'VE 'S", "1234567890", "$$$%%%---___", "​‍", "tab\tnew\r\nline", " ́x", "a" * 3000, "ab" * 500 + " " + "é" * 700,
       "trailing   ", "   leading", "End. End, END!? end;x x.,. $. é. É! <|ENDOFTEXT|>a. it's. 5. 's.", "x\n \n y", "<|endoftext", "|>", "ẞͅİ"]


def texts_of(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    rng = random.Random(8)
    texts = ODD + ["".join(rng.choice(" \n'<|>eéΣ1$日İ́ tofxEND") for _ in range(rng.randint(1, 60))) for _ in range(300)]
    ids = list(range(0, 3 * len(texts), 3))
    rng.shuffle(ids)
    return dict(zip(ids, texts)), save(documents(spark, texts, ids), tmp_path_factory.mktemp("odd"))


def library(path, texts):
    tok = Tokenizer.from_file(path)
    return {i: tok.encode(t or "", add_special_tokens=False).ids for i, t in texts.items()}, tok


@pytest.mark.parametrize("path,lead", [(WORD, False), (BYTE, True)])
def test_memo_equals_the_library(spark, odd, path, lead):
    texts = odd[0] | {-1 - i: t for i, t in texts_of(spark).items()}
    want, _ = library(path, texts)
    column = pa.array([*texts.values(), None, "cut off"])[:-2]
    for limit, work in ((800_000, 1 << 21), (50, 1), (50, 3000)):
        memo = TokenMemo(path, lead, "<u2", limit)
        memo.WORK = work
        for _ in range(2):
            assert {i: np.frombuffer(x, "<u2").tolist() for i, x in zip(texts, memo.ids(column))} == want
    tail = memo.ids(column[7:])
    assert [np.frombuffer(x, "<u2").tolist() for x in tail] == list(want.values())[7:]


def check_packing(rows, texts, capacity=2048):
    want, _ = library(WORD, texts)
    want = {i: ids + [1] for i, ids in want.items()}
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert by_doc.keys() == want.keys()
    for i, ps in by_doc.items():
        at = 0
        for p in sorted(ps, key=lambda p: p.start):
            assert p.start == at and 0 < p.length <= capacity and p.doc_tokens == len(want[i])
            assert p.ids_crc32 == zlib.crc32(np.array(want[i][at:at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(want[i])
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
    for s in sequences.values():
        at = 0
        for p in sorted(s, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
    return sum(map(len, want.values())), len(sequences)


def test_packing_keeps_large_ids_beside_null_ones(spark, tmp_path):
    big = (1 << 53) + 1
    save(documents(spark, ["some words", "more words here", None], [big, None, big + 2]), tmp_path)
    rows = QUERIES["op7_packing"](spark, str(tmp_path)).collect()
    assert sorted((r.doc_id for r in rows), key=str) == [big, big + 2, None]


@pytest.mark.parametrize("hot", [None, 7])
def test_rows_of_a_hot_id_are_dealt_into_ordered_buckets(spark, hot):
    ids = [hot if i % 3 == 0 else i for i in range(3000)]
    docs = documents(spark, [f"text {i}" for i in range(3000)], ids)
    dealt = cm.ordered_buckets(docs.select("doc_id", "text"), "doc_id", 50)
    sizes = dealt.groupBy("bucket").agg(F.count("*").alias("n"), F.min("okey").alias("a"), F.max("okey").alias("b")) \
        .orderBy("bucket").collect()
    assert sum(r.n for r in sizes) == 3000 and max(r.n for r in sizes) <= 200
    assert all(x.b <= y.a for x, y in zip(sizes, sizes[1:]))


def test_packing(spark, odd):
    texts = texts_of(spark)
    used, sequences = check_packing(QUERIES["op7_packing"](spark, SF_SMALL).collect(), texts)
    assert sequences <= 1.05 * used / 2048 + 1
    check_packing(QUERIES["op7_packing"](spark, odd[1]).collect(), odd[0])
    small = pk.pack(spark.read.parquet(f"{odd[1]}/documents.parquet"), WORD, 64, group=50).collect()
    check_packing(small, odd[0], 64)


def test_first_fit_decreasing_equals_a_plain_scan():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 3, 50, 300):
        lengths = rng.integers(1, 100, n)
        bins, offsets = pk.first_fit_decreasing(lengths, 100)
        free, want = [], {}
        for i in np.argsort(-lengths, kind="stable"):
            b = next((b for b, room in enumerate(free) if room >= lengths[i]), len(free))
            free += [100] if b == len(free) else []
            want[i] = (b, 100 - free[b])
            free[b] -= lengths[i]
        assert {i: (b, o) for i, (b, o) in enumerate(zip(bins, offsets))} == want


def check_file(rows, texts):
    want, _ = library(BYTE, texts)
    upto, expected = 0, {}
    for i in sorted(texts):
        ids = np.array(want[i] + [2], "<u4")
        expected[i] = (upto, len(ids), zlib.crc32(ids.tobytes()))
        upto += len(ids)
    assert len(rows) == len(texts) and {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rows} == expected


def test_token_file(spark, odd, monkeypatch):
    check_file(QUERIES["op9_huffman_tokens"](spark, SF_SMALL).collect(), texts_of(spark))
    monkeypatch.setattr(hf, "ROWS_PER_BUCKET", 40)
    check_file(QUERIES["op9_huffman_tokens"](spark, odd[1]).collect(), odd[0])


def cost(counts, lengths):
    return int((counts * lengths).sum())


def test_code_lengths_are_best():
    rng = np.random.default_rng(6)
    for n, limit in ((1, 16), (2, 1), (3, 2), (5, 3), (5, 4), (6, 3), (6, 5)):
        counts = rng.integers(1, 60, n) ** 2
        got = hf.code_lengths(counts, limit)
        assert n == 1 or sum(2.0 ** -k for k in got) == 1
        best = min(cost(counts, np.array(c)) for c in itertools.product(range(1, limit + 1), repeat=n) if sum(2.0 ** -k for k in c) <= 1)
        assert got.max() <= limit and cost(counts, got) == best
    with pytest.raises(ValueError):
        hf.code_lengths(np.ones(9), 3)


def test_bits_round_trip():
    rng = np.random.default_rng(7)
    for n in (0, 1, 255, 256, 257, 5000):
        ids = np.minimum(rng.geometric(0.01, n), 3000).astype("<u2")
        lengths = hf.code_lengths(np.bincount(ids, minlength=1 << 16))
        codes = hf.canonical_codes(lengths)
        bits, checkpoints = hf.pack_bits(ids, lengths, codes)
        text = "".join(f"{codes[i]:0{lengths[i]}b}" for i in ids)
        assert "".join(f"{b:08b}" for b in bits)[:len(text)] == text
        assert (hf.unpack_bits(bits, checkpoints, n, hf.decode_table(lengths, codes)) == ids).all()
        if n > 256:  # a lane begins at its own checkpoint
            at = int(np.frombuffer(checkpoints, "<u8")[1])
            assert at == sum(lengths[ids[:256]])


def check_lexicon(rows, texts):
    want, tok = library(WORD, texts)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expected = {i: (len(ids), digest(" ".join(map(str, ids))), digest(tok.decode(ids, skip_special_tokens=False))) for i, ids in want.items()}
    assert len(rows) == len(texts)
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == expected


def test_lexicon_query(spark, odd):
    check_lexicon(QUERIES["op10_bpe_lexicon"](spark, SF_SMALL).collect(), texts_of(spark))
    check_lexicon(QUERIES["op10_bpe_lexicon"](spark, odd[1]).collect(), odd[0])


def test_automaton_is_minimal_and_finds_its_words(tmp_path):
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("abé") for _ in range(rng.randint(1, 6))).encode() for _ in range(400)})
    outputs = [[rng.randrange(50_000) for _ in range(rng.randint(0, 4))] for _ in words]
    (tmp_path / "lexicon").write_bytes(bl.compile_lexicon(words, outputs))
    lexicon = bl.Lexicon.open(str(tmp_path / "lexicon"))
    assert lexicon.find(words) == outputs
    other = [b"", b"c", b"abc", "é".encode()[:1]] + [w + b"z" for w in words] + [w[:-1] for w in words if w[:-1] not in words]
    assert set(map(str, lexicon.find(other))) == {"None"}
    # As many states as there are different sets of endings.
    futures = {frozenset(w[n:] for w in words if w.startswith(p)) for p in {w[:n] for w in words for n in range(len(w) + 1)}
               for n in [len(p)]}
    assert len(lexicon.final) == len(futures)
    assert bl.Lexicon(bl.compile_lexicon([], [])).find([b"a"]) == [None]


def test_long_words_merge_like_short_ones():
    v = bl.Vocabulary(WORD)
    rng = random.Random(3)
    for _ in range(200):
        word = "".join(rng.choice("aeinrst") for _ in range(rng.randint(2, 60)))
        parts = [v.letters[b] for b in word.encode()]
        parts[-1] += v.suffix
        assert [v.ids[p] for p in v._merge_long(parts)] == v.merge(word)


def test_empty_and_repeated(spark, tmp_path):
    empty = save(documents(spark, []), tmp_path / "e")
    same = save(documents(spark, ["one two"] * 3 + [None, None], [5, 5, None, None, 7]), tmp_path / "r")
    for q in ("op7_packing", "op9_huffman_tokens", "op10_bpe_lexicon"):
        assert QUERIES[q](spark, empty).count() == 0
        assert QUERIES[q](spark, same).count() == 5
    starts = sorted((r.start, r.doc_id) for r in QUERIES["op9_huffman_tokens"](spark, same).collect())
    assert [s for s, _ in starts] == [0, 1, 4, 7, 10] and [d for _, d in starts] == [None, None, 5, 5, 7]


def test_seen_chunks_of_one_hash_are_told_apart():
    from tripwise.llm.common import SeenChunks
    seen = SeenChunks(2, np.dtype("<u2"))
    h, key = np.array([7, 5, 7], np.uint64), np.array([[1, 1], [2, 1], [3, 1]], np.uint64)
    seen.add(h, key, np.array([2, 1, 1]), np.array([10, 11, 20, 30], "<u2"))
    row = seen.find(h, key)
    assert row[0] >= 0 and row[1] >= 0 and row[2] == -1
    seen.add(h[2:], key[2:], np.array([1]), np.array([30], "<u2"))  # its hash is taken
    seen.add(np.array([6], np.uint64), np.array([[4, 1]], np.uint64), np.array([0]), np.array([], "<u2"))
    row = seen.find(np.append(h, np.uint64(6)), np.vstack([key, [[4, 1]]]).astype(np.uint64))
    assert [seen.flat[seen.at[r]:seen.at[r] + seen.n[r]].tolist() if r >= 0 else None for r in row] == [[10, 11], [20], None, []]


def test_frequent_words_are_the_ones_that_repeat_most(spark):
    docs = documents(spark, [" ".join(["often"] * 40 + ["some"] * 9), "Some once", None, ""] + ["a%s b%s" % (c, c) for c in "cdef"] * 2)
    assert sorted(bl.frequent_words(docs)) == sorted(["often", "some"] + [x + c for x in "ab" for c in "cdef"])
    assert sorted(bl.frequent_words(docs, 2)) == ["often", "some"]
    assert bl.frequent_words(docs, 1) == ["often"]
    some = bl.frequent_words(docs, 6)  # a share of the words of equal counts
    assert {"often", "some"} <= set(some) and len(some) < 10 and some == bl.frequent_words(docs, 6)
    assert bl.frequent_words(documents(spark, ["once"])) == []

"""Shared helpers: table access, scratch tables, ordered buckets, token memo, logistic fit."""

from __future__ import annotations

import re
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwise.session import scratch_path

#: Unicode White_Space, as the tokenizers library's patterns see it.  Python's own \s also holds U+001C..U+001F.
WHITE = "\t-\r \x85\xa0  -     　"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and return the written table.

    Cuts the lineage: a lost executor costs a re-read, not a second run.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each lengthened until no column of ``df`` has it."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
        taken.add(name.lower())
    return out


#: A key with more than this share of all rows is heavy, so there are at most as many heavy keys as its inverse.
HEAVY_SHARE, HEAVY_ROWS = 1 / 1000, 1000


def split_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", rows: int | None = None,
               heavy: DataFrame | None = None) -> DataFrame:
    """``left`` joined with ``right``, which has one row a key; rows of heavy keys stay where they are.

    Heavy keys of ``left`` (more than a thousandth of its rows, hence at most 1,000 of them)
    meet their rows of ``right`` by broadcast, the others by a join on the key, so no task gets a
    hot key's rows.  ``left`` is read twice: give what is cheap to read, its ``rows`` if known, and as
    ``heavy`` a table of the ``count`` of each key if there is one.
    """
    rows = left.count() if rows is None else rows
    bound = max(HEAVY_ROWS, int(rows * HEAVY_SHARE))
    if rows <= bound:
        return left.join(right, keys, how)
    counts = left.groupBy(*keys).count() if heavy is None else heavy
    heavy = written(counts.filter(F.col("count") > bound).select(*keys), "heavy")
    if heavy.isEmpty():
        return left.join(right, keys, how)
    few = F.broadcast(heavy)
    hot = left.join(few, keys, "left_semi").join(F.broadcast(right.join(few, keys, "left_semi")), keys, how)
    return left.join(few, keys, "left_anti").join(right, keys, how).unionByName(hot)


#: Most buckets of one order; their bounds are a literal of the plan.
MAX_BUCKETS = 16_384
FIRST = -(1 << 63)


def ordered_buckets(df: DataFrame, key: str, rows_per_bucket: int) -> DataFrame:
    """``df`` with ``okey`` (``key``, null as the smallest number) and ``bucket``, which ascends with it.

    The bounds are approximate quantiles: one pass with a bounded sketch, at most
    ``MAX_BUCKETS`` of them whatever the data.  Being part of the plan, they give a row
    the same bucket on every evaluation.  Rows of one key share a bucket, unless they are more than two
    buckets' worth (null may be): then they are cut once more, by ranges of a hash of the text.
    """
    from pyspark.ml.feature import Bucketizer
    n = df.count()
    parts = int(min(MAX_BUCKETS, max(1, -(-n // rows_per_bucket))))
    probs = [i / parts for i in range(1, parts)]
    bounds = df.select(F.col(key).cast("double").alias(key)).approxQuantile(key, probs, 0.2 / parts) if probs else []
    splits = [float("-inf"), *sorted(set(bounds)), float("inf")]
    df = df.withColumn("okey", F.coalesce(F.col(key).cast("long"), F.lit(FIRST)))
    if len(splits) == 2:
        return df.withColumn("bucket", F.lit(0))
    cut = Bucketizer(splits=splits, inputCol="__key", outputCol="__bucket")
    df = cut.transform(df.withColumn("__key", F.col("okey").cast("double"))) \
        .withColumn("bucket", F.col("__bucket").cast("int")).drop("__key", "__bucket")
    # One heavy key a bucket at most, as it spans two bounds: at most MAX_BUCKETS rows, and as many cuts in all.
    size = max(rows_per_bucket, n // MAX_BUCKETS)
    heavy = df.groupBy("bucket", "okey").count().filter(F.col("count") > 2 * size) \
        .groupBy("bucket").agg(F.max(F.struct("count", "okey")).alias("h")).collect()
    if not heavy:
        return df
    cuts = [(r.bucket, r.h.okey, -(-r.h["count"] // size)) for r in heavy]
    most = max(c[2] for c in cuts) + 2
    few = F.broadcast(df.sparkSession.createDataFrame(cuts, "bucket int, heavy long, cuts int"))
    share = F.shiftrightunsigned(F.xxhash64("text"), 33) / F.lit(float(1 << 31))
    part = F.when(F.col("okey") == F.col("heavy"), F.floor(share * F.col("cuts")).cast("int") + 1) \
        .when(F.col("okey") > F.col("heavy"), F.col("cuts") + 1).otherwise(0)
    return df.join(few, "bucket", "left").withColumn("bucket", F.col("bucket") * most + part).drop("heavy", "cuts")


def free_prefix(df: DataFrame, names: list[str]) -> str:
    """Underscores enough that no column of ``df`` is one of ``names`` after them."""
    taken, prefix = {c.lower() for c in df.columns}, "__"
    while any((prefix + name).lower() in taken for name in names):
        prefix += "_"
    return prefix


#: Masks of the first 0..8 bytes of a little-endian word; byte tables.
MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
BYTES = np.arange(256)
BLANK = np.isin(BYTES, [9, 10, 11, 12, 13, 32])
MAYBE_BLANK = np.isin(BYTES, [0xC2, 0xE1, 0xE2, 0xE3])  # first bytes of white space beyond ASCII
LOWER = np.where((BYTES >= 65) & (BYTES <= 90), BYTES + 32, BYTES).astype(np.uint8)
LETTER = (LOWER >= 97) & (LOWER <= 122)
MARK = np.isin(BYTES, list(b".,;:!?"))


def gathered(flat: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The slices flat[at[i]:at[i] + n[i]], one after another."""
    ends = np.cumsum(n)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(at - (ends - n), n)]


class SeenChunks:
    """Ids of chunks of at most ``ChunkMemo.KEY`` bytes: rows of a table in the order of the chunks' hashes.

    A row's key is the chunk itself and its length, so a find is exact; of different chunks with
    one hash the first is kept.
    """

    def __init__(self, width: int, dtype: np.dtype):
        self.hash, self.key = np.empty(0, np.uint64), np.empty((0, width), np.uint64)
        self.at, self.n, self.flat = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, dtype)

    def find(self, h: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Row of every chunk, or -1."""
        if not len(self.hash):
            return np.full(len(h), -1)
        row = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        row[(self.key[row] != key).any(axis=1)] = -1
        return row

    def add(self, h: np.ndarray, key: np.ndarray, n: np.ndarray, flat: np.ndarray) -> None:
        begin = len(self.flat) + np.cumsum(n) - n
        self.flat = np.concatenate([self.flat, flat])
        h, first = np.unique(h, return_index=True)
        place = np.searchsorted(self.hash, h)
        if len(self.hash):
            free = self.hash[np.minimum(place, len(self.hash) - 1)] != h
            h, first, place = h[free], first[free], place[free]
        self.hash, self.key = np.insert(self.hash, place, h), np.insert(self.key, place, key[first], axis=0)
        self.at, self.n = np.insert(self.at, place, begin[first]), np.insert(self.n, place, n[first])


class ChunkMemo:
    """Token ids of texts, remembered by chunk; ``encode`` of a subclass is asked for new chunks only.

    A text is cut where no token of the vocabularies used here spans the border: between
    a word and white space, and between a last letter and the sentence marks after it.
    ``lead`` is set for byte-level vocabularies, where a space belongs to the word after it and
    other white space is a chunk; without it white space is dropped and letters
    are lower-cased.  A batch of texts is cut in one go on its UTF-8 bytes, equal
    chunks are found by sorting, and only the different ones are looked up, all at once.  Two
    generations of about ``limit`` entries are kept: a full one replaces the older, so
    memory is bounded.
    """

    #: Bytes cut at once (one text at least); chunks of more bytes than KEY are looked up one by one.
    WORK, KEY = 1 << 20, 24

    def __init__(self, lead: bool, dtype: str, limit: int = 600_000):
        self.lead, self.dtype, self.limit = lead, np.dtype(dtype), limit
        self.young, self.older = self._table(), self._table()
        self.long: dict[bytes, bytes] = {}
        self.find = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+" if lead else f"[^{WHITE}]+").findall

    def encode(self, words: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def _table(self) -> SeenChunks:
        return SeenChunks(self.KEY // 8 + 1, self.dtype)

    def _flat(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each new chunk, and all their ids."""
        ids = self.encode([c.decode() for c in chunks])
        n = np.fromiter(map(len, ids), np.int64, len(ids))
        return n, np.fromiter(chain.from_iterable(ids), self.dtype, int(n.sum()))

    def _one_by_one(self, chunks: list[bytes]) -> list[bytes]:
        """Packed ids of chunks of any length."""
        if len(self.long) >= self.limit // 8:
            self.long = {}
        if new := list(set(chunks).difference(self.long)):
            n, flat = self._flat(new)
            ends = np.cumsum(n)
            self.long.update((c, flat[e - k:e].tobytes()) for c, e, k in zip(new, ends.tolist(), n.tolist()))
        return [self.long[c] for c in chunks]

    def _ids_of(self, data: bytes, begin: np.ndarray, size: np.ndarray, h: np.ndarray,
                key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the ids of different chunks begin, how many they are, and the array that holds them."""
        if len(self.young.hash) >= self.limit:
            self.young, self.older = self._table(), self.young
        young, older, short = self.young, self.older, size <= self.KEY
        at, n = np.empty(len(h), np.int64), np.empty(len(h), np.int64)
        row = young.find(h, key)
        hit = row >= 0
        at[hit], n[hit] = young.at[row[hit]], young.n[row[hit]]
        miss = np.flatnonzero(~hit & short)
        row = older.find(h[miss], key[miss])
        known, row = miss[row >= 0], row[row >= 0]
        at[known], n[known] = len(young.flat) + older.at[row], older.n[row]
        new = np.setdiff1d(miss, known, assume_unique=True)
        size_new, flat_new = self._flat([data[a:b] for a, b in zip(begin[new].tolist(), (begin + size)[new].tolist())])
        long = np.flatnonzero(~short)
        packed = self._one_by_one([data[a:b] for a, b in zip(begin[long].tolist(), (begin + size)[long].tolist())])
        size_long = np.fromiter(map(len, packed), np.int64, len(packed)) // self.dtype.itemsize
        rest, n_rest = np.concatenate([new, long]), np.concatenate([size_new, size_long])
        at[rest], n[rest] = len(young.flat) + len(older.flat) + np.cumsum(n_rest) - n_rest, n_rest
        flat = np.concatenate([young.flat, older.flat, flat_new, np.frombuffer(b"".join(packed), self.dtype)])
        if len(miss):
            young.add(h[miss], key[miss], n[miss], gathered(flat, at[miss], n[miss]))
        return at, n, flat

    def _cut(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of every chunk of the texts raw[at[i]:at[i + 1]], in order."""
        n = len(raw)
        blank, border = BLANK[raw], np.zeros(n + 1, bool)
        border[at] = True
        before, after = np.ones(n, bool), np.ones(n, bool)
        before[1:], after[:-1] = blank[:-1], blank[1:]
        begin = np.flatnonzero(~blank & (before | border[:n]))
        end = np.flatnonzero(~blank & (after | border[1:])) + 1
        new = border.copy()
        new[begin] = new[end] = True
        # Sentence marks after a letter: ASCII, or of two bytes from C3 (but the signs for times and divided by).
        marked = MARK[raw[end - 1]]
        mark = MARK[raw]
        core = np.maximum.accumulate(np.where(mark, -1, np.arange(n)))[end[marked] - 1] + 1  # where the marks begin
        core = core[core > begin[marked]]
        one, two = raw[core - 1], np.where(core > 1, raw[core - 2], 0)
        new[core[LETTER[one] | ((two == 0xC3) & (one != 0x97) & (one != 0xB7))]] = True
        if self.lead:
            inner = begin[~border[begin]]
            led = inner[blank[inner - 1]]
            new[led - 1] = True  # the last white space before a word: a space goes with it
            new[led[raw[led - 1] == 32]] = False
        first = np.flatnonzero(new[:n])
        last = np.append(first[1:], n)
        return (first, last) if self.lead else (first[keep := ~blank[first]], last[keep])

    def _different(self, raw: np.ndarray, begin: np.ndarray, size: np.ndarray) \
            -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """One chunk of each kind with its hash and its key (bytes and length), and every chunk's kind."""
        eight = np.lib.stride_tricks.sliding_window_view(np.concatenate([raw, np.zeros(self.KEY, np.uint8)]), 8)
        words = [eight[begin + k].view("<u8").ravel() & MASKS[np.clip(size - k, 0, 8)] for k in range(0, self.KEY, 8)]
        words[0] = np.where(size > self.KEY, begin.astype(np.uint64), words[0])  # long ones are kinds of their own
        h = size.astype(np.uint64)
        for w in words:
            h = (h ^ w) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        order = np.argsort(h)
        fresh = np.ones(len(h), bool)
        fresh[1:] = h[order[1:]] != h[order[:-1]]
        kind = np.empty(len(h), np.int64)
        kind[order] = np.cumsum(fresh) - 1
        shown = order[fresh]
        odd = size != size[shown[kind]]
        for w in words:
            odd |= w != w[shown[kind]]
        odd = np.flatnonzero(odd)  # equal hashes of different chunks
        kind[odd] = len(shown) + np.arange(len(odd))
        shown = np.concatenate([shown, odd])
        return shown, h[shown], np.stack([*(w[shown] for w in words), size[shown].astype(np.uint64)], axis=1), kind

    def _odd_texts(self, raw: np.ndarray, at: np.ndarray) -> list[int]:
        """Texts with white space beyond ASCII, or with what may be a special token, which is not lower-cased."""
        three = np.concatenate([raw, np.zeros(2, np.uint8)])
        p = np.flatnonzero(MAYBE_BLANK[raw])
        a, b, c = (three[p + k] for k in range(3))
        blank = ((a == 0xC2) & ((b == 0x85) | (b == 0xA0))) | ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) \
            | ((a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) \
            | ((a == 0xE2) & (b == 0x81) & (c == 0x9F)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
        q = np.flatnonzero(raw == 60)
        odd = np.concatenate([p[blank], q[three[q + 1] == 124]])  # <|
        return np.unique(np.searchsorted(at, odd, "right") - 1).tolist()

    def _batch(self, raw: np.ndarray, at: np.ndarray) -> list[bytes]:
        out = [b""] * (len(at) - 1)
        begin, end = self._cut(raw, at)
        if len(begin):
            cut = raw if self.lead else LOWER[raw]
            shown, h, key, kind = self._different(cut, begin, end - begin)
            place, size, flat = self._ids_of(cut.tobytes(), begin[shown], (end - begin)[shown], h, key)
            n = size[kind]
            ids = gathered(flat, place[kind], n).tobytes()
            ends = np.concatenate(([0], np.cumsum(n)))
            edge = (ends[np.searchsorted(begin, at)] * self.dtype.itemsize).tolist()
            out = [ids[a:b] for a, b in zip(edge, edge[1:])]
        for i in self._odd_texts(raw, at):
            text = raw[at[i]:at[i + 1]].tobytes().decode()
            out[i] = b"".join(self._one_by_one([c.encode() for c in self.find(text)]))
        return out

    def ids(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text of an Arrow string array as packed little-endian integers; null counts as empty."""
        texts = texts.cast(pa.large_string()).fill_null("")
        if not len(texts):
            return []
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        out, i = [], 0
        while i < len(texts):
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + self.WORK, "right")) - 1)
            out += self._batch(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            i = j
        return out


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else the next from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(0x100 + rest.index(b)) for b in range(256)]


def lower_case(text: str) -> str:
    """NFC and lower case character by character: a capital sigma has one lower case, whatever follows it."""
    return unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower()


class TokenMemo(ChunkMemo):
    """New chunks go to the tokenizers library: plain words to its model, all others through the whole of it."""

    def __init__(self, path: str, lead: bool, dtype: str, limit: int = 600_000):
        super().__init__(lead, dtype, limit)
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.letters = dict(enumerate(byte_letters()))

    def encode(self, words: list[str]) -> list[list[int]]:
        # The library gives a new wrapper of the model at each access.
        out, rest, model, letters, lead = [None] * len(words), [], self.tok.model.tokenize, self.letters, self.lead
        for i, w in enumerate(words):
            core = w[1:] if lead and w[0] == " " else w
            plain = w if lead or w.isascii() else lower_case(w)
            if core.isalpha() and (plain is w or plain.isalpha()):  # one pre-token
                if not w.isascii():
                    w = plain.encode().decode("latin-1").translate(letters)
                elif lead:
                    w = "\u0120" + core if core is not w else w  # the letter of a space
                else:
                    w = w.lower()
                out[i] = [t.id for t in model(w)]
            else:
                rest.append(i)
        for at in range(0, len(rest), 4096):
            part = rest[at:at + 4096]
            got = self.tok.encode([words[i] for i in part], is_pretokenized=True, add_special_tokens=False)
            ends = np.cumsum(np.bincount(got.word_ids, minlength=len(part))).tolist() if got.ids else [0] * len(part)
            ids = got.ids
            for i, a, b in zip(part, [0, *ends], ends):
                out[i] = ids[a:b]
        return out


_MEMOS: dict[tuple, TokenMemo] = {}


def token_memo(path: str, lead: bool, dtype: str) -> TokenMemo:
    """One memo per Python worker; workers are reused between tasks, so the memo stays warm."""
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    key = (path, lead, dtype)
    if key not in _MEMOS:
        _MEMOS[key] = TokenMemo(path, lead, dtype)
    return _MEMOS[key]


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def fit_logistic(rows: np.ndarray, cols: np.ndarray, vals: np.ndarray, y: np.ndarray, dim: int,
                 l2: float = 1e-4, steps: int = 300, rate: float = 0.1,
                 weight: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Logistic regression with soft labels on sparse rows (Adam on the full batch); weights and intercept."""
    n = len(y)
    w, b = np.zeros(dim), 0.0
    if n == 0:
        return w, b
    sw = np.ones(n) if weight is None else weight
    sw = sw / sw.sum()
    m, v, mb, vb = np.zeros(dim), np.zeros(dim), 0.0, 0.0
    prior = float(np.clip((sw * y).sum(), 1e-3, 1 - 1e-3))
    b = float(np.log(prior / (1 - prior)))  # the weighted share of ones
    for t in range(1, steps + 1):
        z = np.bincount(rows, weights=vals * w[cols], minlength=n) + b
        g = sw * (1 / (1 + np.exp(-np.clip(z, -35, 35))) - y)
        gw = np.bincount(cols, weights=vals * g[rows], minlength=dim) + l2 * w
        gb = g.sum()
        m, v = 0.9 * m + 0.1 * gw, 0.999 * v + 0.001 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        c1, c2 = 1 - 0.9 ** t, 1 - 0.999 ** t
        w = w - rate * (m / c1) / (np.sqrt(v / c2) + 1e-8)
        b = float(b - rate * (mb / c1) / (np.sqrt(vb / c2) + 1e-8))
    return w, b


def sample_share(df: DataFrame, keys: list[str], limit: int, n: int) -> DataFrame:
    """Rows whose keys hash below ``limit / n``: about ``limit`` rows, the same ones on every evaluation."""
    if n <= limit:
        return df
    return df.filter(F.pmod(F.xxhash64(*keys, F.lit("sample")), F.lit(1_000_000)) < F.lit(int(1_000_000 * limit / n)))

"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

The most frequent words of the corpus are compiled, with their ids as output, into the
minimal acyclic automaton over their UTF-8 bytes: states with equal futures are one state,
so words share prefixes and suffixes.  Each arc carries the number of words that come
before the words reached through it; summed along a path this numbers the words, and the number
leads to the word's ids.  The automaton is a flat file of sorted arcs.  The driver writes it
to the shared folder, Spark ships it to every executor (also to later ones), and workers
memory-map it.  Words outside the lexicon are merged exactly, pair by pair in rank order.

Words of a text: special tokens are cut out of the raw text, the rest is NFC-normalised and
lower-cased character by character and cut by the vocabulary's pattern.  Workers remember
chunks they have met (twice ``MEMO`` at most), so a chunk is normalised and cut once.

Defined cases: null text counts as empty: no ids and empty decoded text; the strings of
special tokens are special tokens, as in the library; a word of any length is merged in
O(n log n); repeated rows stay; an empty table gives an empty table; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwise.llm.common import WHITE, ChunkMemo, byte_letters, lower_case, written
from tripwise.session import checkpoint_root

#: Words in the lexicon, chunks that a worker remembers, and bands of word counts an octave.
LEXICON, MEMO, BANDS = 1 << 16, 400_000, 16
MAGIC = b"DAWG0001"


class Vocabulary:
    """Ids, merge ranks and cutting rules of a vocabulary file whose words end in a suffix."""

    def __init__(self, path: str):
        import regex
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.ids: dict[str, int] = spec["model"]["vocab"]
        self.suffix: str = spec["model"]["end_of_word_suffix"] or ""
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.rank = {(a, b): i for i, (a, b) in enumerate(merges)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        self.letters = byte_letters()
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        self.words = regex.compile(split.replace(r"\s", WHITE)).findall
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")").split

    def merge(self, word: str) -> list[int]:
        """Ids of a word by exact merging: the lowest-ranked pair first, the leftmost of equal ones."""
        parts = [self.letters[b] for b in word.encode("utf-8", "surrogatepass")]
        parts[-1] += self.suffix
        rank = self.rank
        if len(parts) > 64:
            parts = self._merge_long(parts)
        else:
            while len(parts) > 1:
                best, at = None, -1
                for i in range(len(parts) - 1):
                    r = rank.get((parts[i], parts[i + 1]))
                    if r is not None and (best is None or r < best):
                        best, at = r, i
                if best is None:
                    break
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ids[p] for p in parts if p in self.ids]

    def _merge_long(self, parts: list[str]) -> list[str]:
        """The same with a heap of pairs and linked neighbours."""
        rank, n = self.rank, len(parts)
        after, before, live = list(range(1, n + 1)), list(range(-1, n - 1)), list(parts)
        heap = [(rank[p], i, p) for i in range(n - 1) if (p := (parts[i], parts[i + 1])) in rank]
        heapq.heapify(heap)
        while heap:
            _, i, (a, b) = heapq.heappop(heap)
            j = after[i]
            if live[i] != a or j >= n or live[j] != b:
                continue  # one of the two has been merged since
            live[i], live[j] = a + b, ""
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (p := (live[x], live[y])) in rank:
                    heapq.heappush(heap, (rank[p], x, p))
        return [p for p in live if p]


def compile_lexicon(words: list[bytes], outputs: list[list[int]]) -> bytes:
    """Minimal acyclic automaton of sorted, distinct, non-empty words with their ids, as one flat file.

    Words are added in order; once a later word leaves a branch, the branch's states are
    final and are replaced by equal ones already registered.
    """
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple]] = []  # final, ((byte, state), ...)
    path: list[list] = [[False, []]]  # of the word added last: final, arcs to frozen states

    def freeze(down_to: int) -> None:
        while len(path) > down_to + 1:
            final, arcs = path.pop()
            key = (final, tuple(arcs))
            at = register.get(key)
            if at is None:
                at = register[key] = len(states)
                states.append(key)
            path[-1][1].append((last[len(path) - 1], at))

    last = b""
    for word in words:
        same = 0
        while same < len(last) and same < len(word) and last[same] == word[same]:
            same += 1
        freeze(same)
        path.extend([False, []] for _ in word[same:])
        path[-1][0] = True
        last = word
    freeze(0)
    root = len(states)
    states.append((path[0][0], tuple(path[0][1])))
    below: list[int] = []  # words below each state; arcs lead to states made earlier
    key, target, add = [], [], []
    for s, (final, arcs) in enumerate(states):
        n = int(final)
        for byte, to in arcs:
            key.append(s * 256 + byte)
            target.append(to)
            add.append(n)
            n += below[to]
        below.append(n)
    head = np.array([len(states), len(key), len(words), root], "<u8")
    ends = np.cumsum([0, *map(len, outputs)])
    flat = np.array([i for out in outputs for i in out], "<u4")
    return b"".join([MAGIC, head.tobytes(), np.array(key, "<u8").tobytes(), np.array(target, "<u4").tobytes(),
                     np.array(add, "<u4").tobytes(), np.array([f for f, _ in states], np.uint8).tobytes(),
                     bytes(-len(states) % 4), ends.astype("<u4").tobytes(), flat.tobytes()])


class Lexicon:
    """A compiled lexicon, read in place from a buffer (a memory-mapped file)."""

    def __init__(self, buffer):
        if bytes(buffer[:8]) != MAGIC:
            raise ValueError("not a lexicon")
        states, arcs, words, self.root = (int(x) for x in np.frombuffer(buffer, "<u8", 4, 8))
        at = 40
        self.key = np.frombuffer(buffer, "<u8", arcs, at)
        self.target = np.frombuffer(buffer, "<u4", arcs, at := at + 8 * arcs)
        self.add = np.frombuffer(buffer, "<u4", arcs, at := at + 4 * arcs)
        self.final = np.frombuffer(buffer, np.uint8, states, at := at + 4 * arcs)
        self.ends = np.frombuffer(buffer, "<u4", words + 1, at := at + states + -states % 4)
        self.flat = np.frombuffer(buffer, "<u4", -1, at + 4 * (words + 1))

    @classmethod
    def open(cls, path: str) -> "Lexicon":
        with open(path, "rb") as f:
            return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    def find(self, words: list[bytes]) -> list[list[int] | None]:
        """Ids of many words at once: all walk the automaton side by side, a byte a step."""
        if not words or not len(self.key):
            return [None] * len(words)
        size = np.array([len(w) for w in words])
        flat = np.frombuffer(b"".join(words), np.uint8)
        begin = np.cumsum(size) - size
        state, number = np.full(len(words), self.root, np.int64), np.zeros(len(words), np.int64)
        alive = np.arange(len(words))
        for step in range(int(size.max())):
            alive = alive[size[alive] > step]
            want = (state[alive] * 256 + flat[begin[alive] + step]).astype(np.uint64)
            arc = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
            hit = self.key[arc] == want
            state[alive[~hit]] = -1
            alive, arc = alive[hit], arc[hit]
            state[alive] = self.target[arc]
            number[alive] += self.add[arc]
            if not len(alive):
                break
        known = (state >= 0) & (self.final[np.maximum(state, 0)] == 1) & (size > 0)
        return [self.flat[self.ends[n]:self.ends[n + 1]].tolist() if k else None for n, k in zip(number.tolist(), known.tolist())]


class Coder(ChunkMemo):
    """Encodes and decodes in one worker: remembered chunks, then the lexicon, then exact merging."""

    def __init__(self, tokenizer: str, lexicon: Lexicon, limit: int = MEMO):
        super().__init__(False, "<u2", limit)
        self.vocabulary, self.lexicon = Vocabulary(tokenizer), lexicon
        top = max(self.vocabulary.tokens) + 1
        self.decimal, self.token = [str(i) for i in range(top)], [self.vocabulary.tokens.get(i, "") for i in range(top)]

    def encode(self, words: list[str]) -> list[list[int]]:
        """Ids of chunks: special tokens are cut out, the rest is normalised and cut into the vocabulary's words."""
        v, found = self.vocabulary, []
        for chunk in words:
            if chunk.isalpha() and chunk.isascii():
                found.append([chunk.lower()])
            elif "<|" in chunk:
                found.append([w for p in v.cut(chunk) for w in ([v.special[p]] if p in v.special else v.words(lower_case(p)))])
            else:
                found.append(v.words(lower_case(chunk)))
        new = list({w for parts in found for w in parts if isinstance(w, str)})
        ids = self.lexicon.find([w.encode() for w in new])
        known = {w: v.merge(w) if i is None else i for w, i in zip(new, ids)}
        return [known[p[0]] if len(p) == 1 and isinstance(p[0], str) else
                [i for w in p for i in (known[w] if isinstance(w, str) else [w])] for p in found]

    def texts(self, packed: bytes) -> tuple[int, str, str]:
        """Number of ids, decimal ids joined by spaces, and decoded text (no decoder is set: tokens joined by spaces)."""
        ids = np.frombuffer(packed, self.dtype).tolist()
        return len(ids), " ".join(map(self.decimal.__getitem__, ids)), " ".join(map(self.token.__getitem__, ids))


def frequent_words(docs: DataFrame, limit: int = LEXICON) -> list[str]:
    """About ``limit`` of the corpus's most frequent words that repeat; all documents are counted.

    Words fall into bands of like counts, ``BANDS`` an octave.  Whole bands are taken while they
    fit, and of the next one the share that fits, by the words' hashes: the driver gets the
    bands' sizes and the chosen words, however many partitions hold the counts.  A word left out costs a merge, never a result.
    """
    words = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("word"))
    counted = words.groupBy("word").count().filter("count > 1") \
        .select("word", F.floor(F.log2("count") * BANDS).cast("int").alias("band"))
    counted = written(counted, "word-counts")
    sizes = counted.groupBy("band").count().collect()  # 64 * BANDS rows at most
    room, lowest, share = limit, -1, 0.0
    for band, n in sorted(map(tuple, sizes), reverse=True):
        if n > room:
            lowest, share = band, room / n
            break
        room -= n
    dealt = F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    return [r.word for r in counted.filter((F.col("band") > lowest) | ((F.col("band") == lowest) & dealt)).select("word").collect()]


def ship_lexicon(docs: DataFrame, tokenizer: str, limit: int = LEXICON) -> str:
    """Compile the corpus's lexicon, write it to the shared folder and hand it to all executors; its name."""
    spark, v = docs.sparkSession, Vocabulary(tokenizer)
    words = sorted({lower_case(w) for w in frequent_words(docs, limit)}, key=lambda w: w.encode("utf-8", "surrogatepass"))
    words = [w for w in words if v.words(w) == [w]]
    data = compile_lexicon([w.encode("utf-8", "surrogatepass") for w in words], [v.merge(w) for w in words])
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    jvm, sc = spark._jvm, spark.sparkContext
    path = f"{checkpoint_root(spark).rstrip('/')}/{name}"
    place = jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(sc._jsc.hadoopConfiguration()).create(place)
    try:
        stream.write(bytearray(data))
    finally:
        stream.close()
    sc.addFile(path)
    return name


_CODERS: dict[tuple[str, str], Coder] = {}


def coder(tokenizer: str, name: str) -> Coder:
    """One coder per Python worker; the last one stays while its lexicon is in use."""
    if (tokenizer, name) not in _CODERS:
        _CODERS.clear()
        _CODERS[tokenizer, name] = Coder(tokenizer, Lexicon.open(SparkFiles.get(name)))
    return _CODERS[tokenizer, name]


def round_trip(docs: DataFrame, tokenizer: str, limit: int = LEXICON) -> DataFrame:
    """Per document: doc_id, n_tokens, and the SHA-256 of its decimal ids and of its decoded text."""
    name = ship_lexicon(docs, tokenizer, limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = coder(tokenizer, name)
        sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
        for batch in batches:
            got = [(n, sha(ids), sha(text)) for n, ids, text in map(work.texts, work.ids(batch.column(1)))]
            cols = list(zip(*got)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

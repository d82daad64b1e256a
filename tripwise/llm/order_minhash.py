"""Order MinHash fingerprints, in DataFrame operations only.

The letters are the words of a text (cut at white space), a k-mer is ``WORDS`` of them in a row.  A text with
fewer words than that, or with more than ``LONG`` characters a word (a script without spaces), has its
characters as letters, white space as one of them, and k-mers of ``CHARS``.
Each k-mer gets its occurrence number, so repeats count.  For each of ``SLOTS`` orders of
the hash values the ``PICK`` least occurrence-numbered k-mers are selected, put back into text
order, and hashed as a tuple.  Two texts agree in a slot about as often as they share k-mers in
the same order, so moved passages lower the likeness as edits do.

The orders are the rotations of the ring of hash values: order s counts upwards from the
s-th of ``SLOTS`` evenly spaced anchors.  One sort of a text's hashes then serves all orders,
instead of one pass over its k-mers for each.  All of it is row-local: arrays sorted and cut
by built-in functions, no k-mer is ever exploded or shuffled.

Defined cases: null text counts as empty; a text with fewer characters than a k-mer is one
k-mer, and one k-mer fills each slot alone; equal texts have equal fingerprints; texts that
differ only in their white space have equal ones too; beyond 2^24 words positions start
again.  The next document is that with the next larger doc_id (null first; equal ids by text,
if they are very many by ranges of its hash first),
after the last the first, which for a single row is itself.  Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripwise.llm.common import ordered_buckets

WORDS, PICK, SLOTS = 3, 2, 32
CHARS, LONG = 5, 32
WHITE = " \t\n\x0b\f\r"
POSITION = (1 << 24) - 1
SHIFT = 64 - 5  # a hash's slot is its upper 5 bits: SLOTS anchors
ROWS_PER_BUCKET = 1000


def with_sketch(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the array ``out`` of ``SLOTS`` tuple hashes of the column ``text``.

    Steps are columns of their own, so each is evaluated once a row.
    """
    g, v, at, words, chars = (f"__{out}_{x}" for x in ("kmers", "values", "starts", "words", "chars"))
    n, m = F.size(words), F.size(chars)
    df = df.withColumn(words, F.split(F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(WHITE)), r"\s+"))
    w, c = F.col(words), F.col(chars)
    few = (n < WORDS) | (F.length(text) > n * LONG) & (F.length(F.array_join(w, "")) > n * LONG)
    df = df.withColumn(chars, F.when(few, F.split(F.array_join(w, " "), "")))
    kmers = lambda x, n, k: F.transform(F.sequence(F.lit(0), F.greatest(n - k, F.lit(0))),
                                        lambda i: F.xxhash64(*[x[i + j] for j in range(k)]))
    df = df.withColumn(g, F.when(c.isNull(), kmers(w, n, WORDS)).when(m < CHARS, F.array(F.xxhash64(F.array_join(w, " "))))
                       .otherwise(kmers(c, m, CHARS)))

    def packed(h: Column, i: Column) -> Column:
        """Upper 40 bits of the hash, 24 bits of position: a number that sorts by hash."""
        return h.bitwiseAND(F.lit(~POSITION)).bitwiseOR(i.cast("long").bitwiseAND(F.lit(POSITION)))

    # Where a k-mer repeats, its later occurrences hash with their number.
    s, runs = f"__{out}_sorted", f"__{out}_runs"
    repeats = F.size(F.array_distinct(g)) < F.size(g)
    df = df.withColumn(s, F.when(repeats, F.sort_array(F.transform(g, packed))))
    sorted_, run = F.col(s), F.col(runs)
    of = lambda x: F.shiftright(x, 24)
    df = df.withColumn(runs, F.when(repeats, F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j: (j == 0) | (
        of(sorted_[j]) != of(sorted_[F.greatest(j - 1, F.lit(0))])))))
    numbered = F.flatten(F.transform(run, lambda a, r: F.transform(
        F.slice(s, a + 1, F.when(r + 1 < F.size(runs), run[F.least(r + 1, F.size(runs) - 1)]).otherwise(F.size(s)) - a),
        lambda x, k: F.when(k == 0, x).otherwise(packed(F.xxhash64(of(x), k), x)))))
    df = df.withColumn(v, F.when(repeats, F.sort_array(numbered)).otherwise(F.sort_array(F.transform(g, packed))))
    value = F.col(v)
    df = df.withColumn(at, F.filter(F.sequence(F.lit(0), F.size(v) - 1), lambda j: (j == 0) | (
        F.shiftright(value[j], SHIFT) != F.shiftright(value[F.greatest(j - 1, F.lit(0))], SHIFT))))

    def tuple_hash(j: Column) -> Column:
        a, b = value[j], value[(j + 1) % F.size(v)]
        place = lambda x: x.bitwiseAND(F.lit(POSITION))
        return F.when(F.size(v) == 1, F.xxhash64(of(a))).when(place(a) < place(b), F.xxhash64(of(a), of(b))) \
            .otherwise(F.xxhash64(of(b), of(a)))

    low = -(SLOTS // 2)
    df = df.withColumn(out, F.transform(F.sequence(F.lit(low), F.lit(low + SLOTS - 1)), lambda b: tuple_hash(
        F.coalesce(F.get(F.filter(at, lambda j: F.shiftright(value[j], SHIFT) >= b), F.lit(0)), F.lit(0))
    ).bitwiseAND(F.lit(0xFFFFFFFF))))
    return df.drop(words, chars, g, s, runs, v, at)


def as_text(sketch: Column | str) -> Column:
    """Fingerprint as text: eight hexadecimal digits a slot."""
    return F.array_join(F.transform(sketch, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def likeness(a: Column | str, b: Column | str) -> Column:
    """Share of the slots in which two sketches agree."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)) / F.lit(float(SLOTS))


def with_next(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, sketch) with the text and sketch of the next document.

    Documents are dealt into ordered buckets, and the window runs inside a bucket.  The
    first document of each bucket also visits the bucket before it, as its last row.
    """
    keyed = ordered_buckets(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "doc_id", ROWS_PER_BUCKET)
    heads = sorted(tuple(r) for r in keyed.groupBy("bucket").agg(F.min("okey").alias("okey")).collect())  # one row a bucket
    spark = docs.sparkSession
    before = [(k, b, prev) for (b, k), (prev, _) in zip(heads, [heads[-1], *heads[:-1]])] if heads else []
    goes = F.broadcast(spark.createDataFrame(before, "okey long, bucket int, goes int"))  # at most MAX_BUCKETS rows
    visits = keyed.join(goes, ["okey", "bucket"]).groupBy("goes").agg(F.min(F.struct("okey", "text", "doc_id")).alias("d")) \
        .select("d.doc_id", "d.text", "d.okey", F.col("goes").alias("bucket"), F.lit(True).alias("visits"))
    every = with_sketch(keyed.withColumn("visits", F.lit(False)).unionByName(visits), "text", "sketch")
    w = W.partitionBy("bucket").orderBy("visits", "okey", "text")
    return every.withColumns({"next_text": F.lead("text").over(w), "next_sketch": F.lead("sketch").over(w)}) \
        .filter(~F.col("visits")).drop("visits", "bucket", "okey")


def edited_copies(docs: DataFrame) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, whose second half is the next document's beginning."""
    near = with_next(docs)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    near = near.withColumns({"n_chars": n.cast("long"), "edited": F.concat(
        F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))})
    near = with_sketch(near.drop("next_text", "text"), "edited", "edited_sketch")
    return near.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text("sketch").alias("fingerprint"),
                       as_text("edited_sketch").alias("edited_fingerprint"),
                       likeness("sketch", "edited_sketch").alias("near_edited"), likeness("sketch", "next_sketch").alias("near_next"))

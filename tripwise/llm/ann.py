"""Approximate nearest neighbours by randomly rotated one-bit codes.

A vector is scaled to length 1, embedded into ``BITS`` dimensions and rotated at random; its code
is the signs, one bit a dimension, with one correction scalar: the inner product of the code
(as a unit vector) with the rotated vector.  The product of a query with the code, divided by the
scalar, estimates the cosine without bias, and the error is within
``EPSILON * sqrt((1 - f^2) / f^2 / (BITS - 1))`` for nearly all pairs.  That gives each pair an
interval.  A vector is reranked on the original numbers if its upper bound reaches the k-th largest
lower bound of the query.

Plan.  Equal vectors are one entry that knows its k + 1 smallest ids (nobody can need more), found
with a row limit inside the window, so a vector with a third of all rows shrinks before the
shuffle.  Entries and queries are dealt into blocks by hash; the grid of (query block, entry block)
is a co-group of codes, so a task holds one block of each, whatever the sizes.  The first pass sends k + 1
lower bounds a query and block, the second the entries of the block that a query has to see.  Only
those entries' vectors are then brought to the query block, each once, for the exact scores: vectors move with what the bounds
leave, codes (a bit a dimension) with the grid.

Defined cases: vectors that are null, zero, or hold nulls or non-finite numbers, and rows without an id
take no part, neither as queries; vectors are compared with those of the same length, each length in blocks of its
own; each different vector of an id is a candidate (and a query) by itself, equal rows are one; fewer rows than
k give all of them; scores are equal for equal vectors, and ties go to the smaller id; an empty table gives
an empty table; columns other than the id and the vector are not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripwise.llm.common import written

BITS, EPSILON, K, SEED = 512, 1.9, 5, 20
ENTRIES, QUERIES, TILE = 8192, 2048, 128  # rows of a block, queries of a block, queries at once


@lru_cache(maxsize=8)
def rotation(dim: int, bits: int = BITS, seed: int = SEED) -> np.ndarray:
    """Orthonormal columns: ``dim`` numbers into max(bits, dim) dimensions, as float32."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((max(bits, dim), dim)))
    return (q * np.sign(np.diag(r))).astype(np.float32)


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    flat = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten()
    x = flat.to_numpy(zero_copy_only=False).reshape(-1, dim)
    # By a power of two: exact, and no square overflows.
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0))[1][:, None])


def _units(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def codes_of(x: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign bits and correction scalars of the rows of ``x``."""
    y = _units(x).astype(np.float32) @ turn.T
    return np.packbits(y > 0, axis=1), (np.abs(y).sum(axis=1) / np.sqrt(np.float32(y.shape[1]))).astype(np.float32)


def bounds(queries: np.ndarray, signs: np.ndarray, f: np.ndarray, turn: np.ndarray, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the cosines of every query with every entry."""
    bits = signs.shape[1]
    y = _units(queries).astype(np.float32) @ turn.T
    estimate = y @ signs.T / (np.sqrt(np.float32(bits)) * f)
    error = epsilon * np.sqrt(np.maximum(0, 1 - f * f) / (f * f) / max(1, bits - 1)) + np.float32(1e-5)  # and rounding
    return estimate - error, estimate + error


def _signs(codes: pa.ChunkedArray, bits: int) -> np.ndarray:
    raw = np.frombuffer(b"".join(codes.to_pylist()), np.uint8).reshape(-1, -(-bits // 8))
    return np.unpackbits(raw, axis=1, count=bits).astype(np.float32) * 2 - 1


def usable(df: DataFrame) -> DataFrame:
    """(vec_id, vec as doubles) of the rows that take part, equal ones once."""
    x = F.col("embedding").cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)
    return df.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(fine) \
        .select(F.col("vec_id").cast("long"), x.alias("vec")).distinct()


def search(df: DataFrame, is_query: Column, k: int = K, bits: int = BITS, epsilon: float = EPSILON) -> DataFrame:
    """The ``k`` nearest found by cosine for every row of ``is_query``: query_id, rank, vec_id, score."""
    rows = written(usable(df).withColumn("h", F.xxhash64("vec")), "vectors")
    top = k + 1
    first = W.partitionBy("h", "vec").orderBy("vec_id")
    equal = rows.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= top) \
        .groupBy("h", "vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))

    def code(batches):
        for batch in batches:
            dims = batch.column(batch.schema.get_field_index("dim")).to_numpy()
            for dim in np.unique(dims).tolist():  # as a rule one
                part = batch.filter(pa.array(dims == dim))
                packed, f = codes_of(_matrix(part.column(part.schema.get_field_index("vec")), dim), rotation(dim, bits))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([p.tobytes() for p in packed], pa.binary()), pa.array(f)],
                    [*part.schema.names, "code", "f"])

    entries = equal.select(F.element_at("ids", 1).alias("least"), "ids", "h", "vec", F.size("vec").alias("dim"))
    entries = entries.mapInArrow(code, "least long, ids array<long>, h long, vec array<double>, dim int, code binary, f float")
    # A written number: unique, and the same whenever it is read again.
    entries = written(entries.withColumn("entry", F.monotonically_increasing_id()), "codes")
    asked = written(rows.filter(is_query).join(entries.select("h", "vec", "entry"), ["h", "vec"])
                    .select(F.col("vec_id").alias("query_id"), F.col("entry").alias("query")), "queries")
    queries = asked.select("query").distinct().join(entries.select(F.col("entry").alias("query"), "vec", "dim"), "query")
    queries = written(queries, "query-vectors")
    many = max(1, -(-entries.count() // ENTRIES)), max(1, -(-queries.count() // QUERIES))

    def grid(queries: DataFrame, entries: DataFrame):
        q = queries.withColumn("qb", F.pmod(F.xxhash64("query"), F.lit(many[1]))) \
            .withColumn("eb", F.explode(F.sequence(F.lit(0), F.lit(many[0] - 1)).cast("array<long>")))
        e = entries.withColumn("eb", F.pmod(F.xxhash64("entry"), F.lit(many[0]))) \
            .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(many[1] - 1)).cast("array<long>")))
        return q.groupBy("dim", "qb", "eb").cogroup(e.groupBy("dim", "qb", "eb"))

    def lower(q: pa.Table, e: pa.Table) -> pa.Table:
        out = []
        if q.num_rows and e.num_rows:
            dim = q["dim"][0].as_py()
            turn = rotation(dim, bits)
            x, signs, f = _matrix(q["vec"], dim), _signs(e["code"], len(turn)), e["f"].to_numpy()
            n = min(top, len(f))
            for at in range(0, len(x), TILE):
                low, _ = bounds(x[at:at + TILE], signs, f, turn, epsilon)
                out += np.partition(low, len(f) - n, axis=1)[:, len(f) - n:].tolist()
        return pa.table({"query": q["query"] if out else pa.array([], pa.int64()), "low": pa.array(out, pa.list_(pa.float32()))})

    lows = grid(queries, entries.select("entry", "dim", "code", "f")).applyInArrow(lower, "query long, low array<float>")
    least = F.get(F.sort_array(F.flatten(F.collect_list("low")), False), F.lit(top - 1))
    need = lows.groupBy("query").agg(F.coalesce(least, F.lit(-3.0).cast("float")).alias("need"))

    def sift(q: pa.Table, e: pa.Table) -> pa.Table:
        near, many_at = [], [0]
        if q.num_rows and e.num_rows:
            dim = q["dim"][0].as_py()
            turn = rotation(dim, bits)
            x, signs, f = _matrix(q["vec"], dim), _signs(e["code"], len(turn)), e["f"].to_numpy()
            ids, needs = e["entry"].to_numpy(), q["need"].to_numpy()
            for at in range(0, len(x), TILE):
                _, high = bounds(x[at:at + TILE], signs, f, turn, epsilon)
                for some in high >= needs[at:at + TILE, None]:
                    near.append(ids[some])
                    many_at.append(many_at[-1] + int(some.sum()))
        else:
            q = q.slice(0, 0)
        flat = pa.array(np.concatenate(near) if near else [], pa.int64())
        out = pa.table({"dim": q["dim"], "qb": q["qb"], "eb": q["eb"], "query": q["query"], "vec": q["vec"],
                        "near": pa.ListArray.from_arrays(pa.array(many_at, pa.int32()), flat)})
        return out.filter(np.diff(many_at) > 0)

    seen = grid(queries.join(need, "query"), entries.select("entry", "dim", "code", "f")) \
        .applyInArrow(sift, "dim int, qb long, eb long, query long, vec array<double>, near array<long>")
    seen = written(seen, "candidates")
    block = ["dim", "qb", "eb"]
    # Names of its own: both sides of the last grid come from ``seen``.
    shown = seen.select(*[F.col(c).alias(f"{c}_") for c in block], F.explode("near").alias("entry")).distinct() \
        .join(entries.select("entry", "least", "vec"), "entry")

    def rerank(q: pa.Table, e: pa.Table) -> pa.Table:
        who, what, score = [], [], []
        if q.num_rows:
            dim = q["dim"][0].as_py()
            e = e.sort_by("entry")
            least, ids, names = e["least"].to_numpy(), e["entry"].to_numpy(), q["query"].to_numpy()
            x, y = _matrix(q["vec"], dim), _matrix(e["vec"], dim)
            xn, yn = np.sqrt(np.einsum("ij,ij->i", x, x)), np.sqrt(np.einsum("ij,ij->i", y, y))
            near_of = q["near"].combine_chunks()
            for i in range(len(x)):
                near = np.searchsorted(ids, near_of[i].values.to_numpy())
                s = np.einsum("ij,j->i", y[near], x[i]) / (yn[near] * xn[i])
                best = np.lexsort((least[near], -s))[:top]
                who.append(np.full(len(best), names[i]))
                what += [ids[near][best], least[near][best]]
                score.append(s[best])
        cat = lambda parts, t: pa.array(np.concatenate(parts) if parts else [], t)
        return pa.table({"query": cat(who, pa.int64()), "entry": cat(what[0::2], pa.int64()), "least": cat(what[1::2], pa.int64()),
                         "score": cat(score, pa.float64())})

    near = seen.groupBy(*block).cogroup(shown.groupBy(*[f"{c}_" for c in block])) \
        .applyInArrow(rerank, "query long, entry long, least long, score double")
    by_query = W.partitionBy("query").orderBy(F.desc("score"), "least", "entry")
    near = near.withColumn("n", F.row_number().over(by_query)).filter(F.col("n") <= top)
    found = near.join(entries.select("entry", "ids"), "entry").select("query", "entry", "score", F.explode("ids").alias("vec_id"))
    found = found.withColumn("n", F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "vec_id", "entry"))) \
        .filter(F.col("n") <= top).drop("n")
    rank = F.row_number().over(W.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id", "entry"))
    return asked.join(found, "query").filter("not (vec_id = query_id and entry = query)").withColumn("rank", rank) \
        .filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

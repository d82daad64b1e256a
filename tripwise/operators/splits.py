"""Train / test splits and sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the id hash: a Mersenne prime modulus and a multiplier near
# modulus / golden ratio (Fibonacci hashing), so neighbouring ids spread out.
HASH_MODULUS = 2147483647
HASH_MULTIPLIER = 1327217884


def hash_fraction(id_col: Column, seed: int = 0) -> Column:
    """A value in [0, 1) from the id alone: same split under any partitioning,
    after a lost executor, and in any engine (plain BIGINT arithmetic)."""
    h = F.pmod(F.pmod(id_col, F.lit(HASH_MODULUS)) * F.lit(HASH_MULTIPLIER) + F.lit(seed), F.lit(HASH_MODULUS))
    return h.cast("double") / F.lit(float(HASH_MODULUS))


def hash_fraction_sql(id_col: str, seed: int = 0) -> str:
    positive = f"(({id_col} % {HASH_MODULUS}) + {HASH_MODULUS}) % {HASH_MODULUS}"  # ids may be negative
    return f"cast((({positive}) * {HASH_MULTIPLIER} + {seed}) % {HASH_MODULUS} as double) / {float(HASH_MODULUS)!r}"


def split_hash(df: DataFrame, id_col: str = "trip_id", train_fraction: float = 0.7,
               seed: int = 0) -> tuple[DataFrame, DataFrame]:
    f = hash_fraction(F.col(id_col), seed)
    return df.where(f < F.lit(train_fraction)), df.where(f >= F.lit(train_fraction))


def split_random(df: DataFrame, seed: int, weights=(0.7, 0.3)) -> tuple[DataFrame, DataFrame]:
    """``randomSplit`` with a seed (reproducible only for the same partitioning)."""
    a, b = df.randomSplit(list(weights), seed)
    return a, b


def sample_rows(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)

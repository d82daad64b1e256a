"""A training-data pipeline over ``documents``: filter, deduplicate, redact, pack.

Each stage is called with the session, the documents its predecessor kept, and the data
folder; it returns a DataFrame, which is written as Parquet and read again for the next
one.  All but the last return the columns they were given.

* ``toxicity``: documents scored 0.5 or more go.  The classifier learns from labelled
  documents among those given, except held-out ones.
* ``quality``: documents that the weakly supervised scorer rejects go.
* ``near_duplicates``: of each component of 4-word SimHash fingerprints that link at 4 bits or fewer, the
  row with the smallest doc_id stays (null last; the smallest text of it, should it repeat).
* ``secrets``: found secrets and linked credential parts are masked in the text.
* ``packing``: the rest is packed into sequences of at most 2,048 tokens, with the public word-level vocabulary.

No document goes unless a stage's decision says so; null and empty texts count as empty
documents, which the filters keep and near-duplicate removal reduces to one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripwise.llm import packing, quality, secrets, simhash, toxicity
from tripwise.llm.common import free_prefix, table, tokenizer_path
from tripwise.session import scratch_path, scratch_space, stored

#: SQL cannot express trained classifiers; the tests compare with a brute-force version.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    free = free_prefix(docs, ["held_out", "score", "predicted"])
    judged = toxicity.classify(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"), prefix=free)
    return judged.filter(f"{free}predicted = 0").select(*docs.columns)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    free = free_prefix(docs, ["votes", "posterior", "score", "predicted"])
    return quality.classify(docs, prefix=free).filter(f"{free}predicted = 1").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs, words=4, max_bits=4)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("quality", drop_low_quality), ("near_duplicates", drop_near_duplicates),
          ("secrets", mask_secrets), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``.  A stage's scratch tables go once its result is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        with scratch_space(spark):
            docs = stored(stage(spark, docs, sf_dir), f"stage-{name}", path)
    return STAGES[-1][1](spark, docs, sf_dir)

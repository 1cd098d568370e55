"""From raw documents to token ids: toxicity, exact and near deduplication, mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are
written as Parquet and read again as the next stage's ``docs``.  All stages but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartograph.llm import bpe, exact_dedup, minhash, mixing, toxicity
from cartograph.llm.common import small_batches, stage, table

VOCABULARY = "byte_bpe_50k.tiktoken"


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, does not predict toxic."""
    model = toxicity.fit(toxicity.labelled_sample(docs, table(spark, sf_dir, "labels")))
    return toxicity.drop_toxic(docs, model)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the largest id."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component: the one with the smallest id."""
    return minhash.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: a row for each piece of a document that a slot of the mix takes."""
    return mixing.mixed_documents(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every piece, with digests of the ids and of the bytes they decode to."""
    import public_tokenizers

    vocabulary = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    made = {"text", "ids", "decoded", "n_tokens", "ids_sha256", "decoded_sha256"}  # a column of such a name is replaced
    keep = [c for c in docs.columns if c.lower() not in made]
    coded = bpe.decode(bpe.encode(docs, *vocabulary, keep=keep), *vocabulary)
    return coded.select(*keep, "ids", F.size("ids").cast("long").alias("n_tokens"), bpe.ids_digest().alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def _in_small_batches(apply):
    """Sets the session's batches first: a stage's rows are written after it returns, so the setting stays."""

    @wraps(apply)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return apply(spark, docs, sf_dir)

    return run


STAGES = [(name, _in_small_batches(apply)) for name, apply in (
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_exact),
    ("minhash", drop_near),
    ("mixing", mix),
    ("bpe", tokenise),
)]

#: The classifier and the draws of the mixture have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the whole table of documents."""
    docs = table(spark, sf_dir, "documents")
    for _, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

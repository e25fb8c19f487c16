"""A training corpus from the documents: toxic ones and near copies out, benchmark passages out, mixed, as token ids."""

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tapflow.llm import decontamination, minhash, mixing, token_files, toxicity
from tapflow.llm.shared import recorded, remove, shared_folder, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
VOCABULARY = "byte_bpe_50k.json"
_last: list[str] = []


def _stage(step: Stage) -> Stage:
    """A stage whose tables in the shared folder are removed when the next one begins: its result is written by then."""

    @wraps(step)
    def staged(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        remove(spark, _last)
        with recorded() as paths:
            result = step(spark, docs, sf_dir)
        _last[:] = paths
        return result

    return staged


@_stage
def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the threshold of their language, by a model of those that have labels."""
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@_stage
def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return minhash.keep_one(docs)


@_stage
def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark passages don't make up a twentieth of."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


@_stage
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as there are, flattened over sources; a document drawn twice is there twice."""
    return mixing.mix(docs)


@_stage
def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the token files hold of each document: doc_id, start, n_tokens, ids_crc32."""
    folder = shared_folder(spark)
    token_files.write(docs, folder, public_tokenizers.path(VOCABULARY))
    return token_files.read(spark, folder)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("minhash_dedup", without_copies),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("token_files", token_ids),
]

#: A trained model takes part, so SQL can't express the rows; tests compare them with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = f"{shared_folder(spark)}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs

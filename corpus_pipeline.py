"""A corpus pipeline of five stages: quality, near copies, repeated passages, secrets, packing."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regionloom.llm import common, packing, quality_classifier, secret_scan, similar, suffix_dedup

#: No stage but the secret scan's base spans can be put into SQL.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels of the table ``labels``."""
    trees = quality_classifier.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_classifier.accepted(docs, trees)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents with a similarity of 0.8 or more, in shingles of five words, the one with the smallest doc_id, once."""
    return similar.without_similar(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the bytes that repeat; characters cut apart go, and n_chars is counted again."""
    return _counted(suffix_dedup.remove_repeats(docs), docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with secrets put out of sight, and n_chars counted again."""
    return _counted(secret_scan.redact(docs), docs)


def _counted(changed: DataFrame, docs: DataFrame) -> DataFrame:
    return changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", keep_good), ("near_copies", drop_near_copies), ("repeats", drop_repeats), ("secrets", redact_secrets), ("packing", pack)]


def _deleted(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``, each but the last written as Parquet and read again.

    The files go to a folder of this run in spark.checkpoint.dir (a temporary folder where that is unset, on one machine
    alone). A stage's files are deleted once the next stage is written; those that the last reads stay, as it is read later.
    """
    folder = f"{spark.sparkContext.getConf().get('spark.checkpoint.dir', None) or common.local_folder(spark)}/{uuid.uuid4().hex}"
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for k, (stage, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(path := f"{folder}/{k}_{stage}")
            if before:
                _deleted(spark, before)
            docs, before = spark.read.parquet(path), path
    return docs

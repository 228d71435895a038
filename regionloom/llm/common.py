"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that one numpy or Python pass over documents holds at a time.
BLOCK_BYTES = 4 << 20


def doc_view(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just ``doc_id`` (long) and ``text`` (null read as empty), whatever else the table carries."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def packed_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row`` (every column of ``df``), ``doc`` (long) and ``txt`` (null read as empty): no name of the table can clash with one used inside."""
    return df.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("txt"))


def unpacked(rows: DataFrame, columns: list[str], **replaced: Column) -> DataFrame:
    """The columns of ``row`` as they were, but for those replaced."""
    return rows.select(*(replaced[c].alias(c) if c in replaced else F.col("row").getField(c).alias(c) for c in columns))


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut, kept in the folder that executors share."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(sc.getConf().get("spark.checkpoint.dir", None) or local_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def local_folder(spark: SparkSession) -> str:
    """A temporary folder for a session on one machine; on a cluster spark.checkpoint.dir must be set."""
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="regionloom-")


def fold_of(id_col: Column | str, folds: int = 3) -> Column:
    """The fold of a row: crc32 of its id written as text, modulo ``folds``."""
    return F.crc32(F.coalesce(F.col(id_col) if isinstance(id_col, str) else id_col, F.lit(0)).cast("string").cast("binary")) % folds


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = BLOCK_BYTES, rows: int = 10_000) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of each hold about ``limit`` bytes, and one row at least and ``rows`` at most."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        ends = np.cumsum(np.diff(offsets_of(column)))
        first = 0
        while first < batch.num_rows:
            done = ends[first - 1] if first else 0
            last = min(batch.num_rows, first + rows, max(first + 1, int(np.searchsorted(ends, done + limit, "right"))))
            yield batch.slice(first, last - first)
            first = last


def offsets_of(column: pa.Array) -> np.ndarray:
    """Byte offsets of a string or binary column into its buffer."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    return np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column joined, and where each row starts and the last ends."""
    offsets = offsets_of(column)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """doc_id, text, label of about ``most`` of the labelled documents of the learning folds (crc32 of the id modulo 3 not 1).

    ``labels`` has doc_id and label; null ids and labels are dropped, of several labels of one id the least counts. Rows
    are taken by a hash of the id. Texts aren't shuffled: the sampled ids, a bounded number, are broadcast.
    """
    usable = labels.where("doc_id IS NOT NULL AND label IS NOT NULL").where(fold_of("doc_id") != 1).groupBy("doc_id").agg(F.min("label").alias("label"))
    share = most / max(1, usable.count())
    taken = usable.where(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1_000_000)) < share * 1_000_000)
    return docs.join(F.broadcast(taken), "doc_id")

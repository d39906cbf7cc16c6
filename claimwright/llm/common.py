"""Helpers that several operators of this folder share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from claimwright.session import shared_dir, ship

__all__ = ["PAIR", "WORD", "Memo", "carried", "crc_bucket", "folder", "map_batches", "pieces", "ship", "stored", "table", "whole_texts"]

#: Bits of an id where two of them make one key: ids are 32-bit numbers.
PAIR = 32
#: Word separators of the contracts: space and the five ASCII control spaces.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and the whole text (null: empty) under fixed names; other columns only as asked for."""
    return docs.select("doc_id", *more, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def carried(docs: DataFrame, *columns) -> DataFrame:
    """The columns asked for beside the whole row, which is held in one column, so that names cannot clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole_row"), *columns)


def folder(spark: SparkSession, label: str) -> str:
    """A new folder below the shared one that the cluster names in spark.checkpoint.dir."""
    return shared_dir(spark, "llm", label, uuid.uuid4().hex)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The same rows from a table written to the shared folder: cuts lineage, survives lost executors."""
    path = folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pieces(batch: pa.RecordBatch, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of at most ``size`` bytes, or one larger row; none of no rows."""
    if batch.num_rows > 1 and batch.nbytes > size:
        half = batch.num_rows // 2
        yield from pieces(batch.slice(0, half), size)
        yield from pieces(batch.slice(half), size)
    elif batch.num_rows:
        yield batch


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table], schema: str) -> DataFrame:
    """One Arrow batch in, one out, in pieces of a few megabytes: a task holds a piece's Python objects at a time,
    whatever the size of its partition and of the rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                out = function(piece)
                yield from out.to_batches() if isinstance(out, pa.Table) else [out]

    return df.mapInArrow(run, schema)


def crc_bucket(id_column: str, modulus: int):
    """crc32 of the id as text, modulo: the contracts' split into learning and held-out rows. A null id
    falls in no bucket that is learned from or held out (null)."""
    return F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(modulus))


class Memo(dict):
    """A bounded memo: a missing key is computed once; the memo is emptied when it is full."""

    def __init__(self, compute: Callable, entries: int = 300_000, longest: int = 100):
        super().__init__()
        self.compute, self.entries, self.longest = compute, entries, longest

    def __missing__(self, key):
        value = self.compute(key)
        if len(key) <= self.longest:
            if len(self) >= self.entries:
                self.clear()
            self[key] = value
        return value

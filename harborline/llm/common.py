"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.session import scratch

#: White space of the contracts, [\x20\x09-\x0D]; ``bytes.split()`` splits on exactly these.
BLANK = b" \t\n\x0b\x0c\r"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again.

    What follows does not compute it twice, and a lost executor cannot change it.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Most rows, and bytes, that go to a Python worker at once, with Spark's own defaults: rows with texts are long.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"),
    "spark.sql.execution.arrow.maxBytesPerBatch": ("64m", "16m"),
}


def text_of(df: DataFrame, column: str) -> Column:
    """The text column as string, NULL as the empty text.

    Limits the session's Arrow batches to ``BATCHES`` where they have Spark's defaults: ten thousand rows of text
    are held several times over, in the JVM and in the Python worker.
    """
    spark = df.sparkSession
    for name, (default, limit) in BATCHES.items():
        if spark.conf.get(name, default) == default:
            spark.conf.set(name, limit)
    return F.coalesce(df[column].cast("string"), F.lit(""))


def lists(offsets: list[int], columns: dict[str, pa.Array]) -> pa.ListArray:
    """A list of structs for each row, from flat columns and the place where each row's list begins (and the last ends)."""
    return pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(list(columns.values()), names=list(columns)))


def halves(digests: list[bytes]) -> dict[str, pa.Array]:
    """128-bit hashes as two columns."""
    both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
    return {"a": pa.array(both[:, 0]), "b": pa.array(both[:, 1])}


def fingerprint(text: Column) -> Column:
    """Two independent 64-bit hashes: tells texts apart at any size of the corpus."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns that an operator is about to add; Spark compares names without case."""
    taken = {n.lower() for n in names}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in taken])

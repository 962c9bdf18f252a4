"""Tables that are replaced at once: every version in a folder of its own, and an entry that says which one holds.

A write that fails leaves the table as it was, and readers never meet half a table. Entries are empty files whose names
hold a number and a version; making one is a single step in every file system Spark writes to. The greatest number holds.
One writer per table at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.sinks.tables import write_table

ENTRIES = "_versions"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, base: str) -> list[tuple[int, str]]:
    """(number, version) of each entry under ``base``, oldest first; empty where nothing was published."""
    folder = f"{base.rstrip('/')}/{ENTRIES}"
    files = _files(spark, folder)
    if not files.exists(_path(spark, folder)):
        return []
    names = [f.getPath().getName() for f in files.listStatus(_path(spark, folder))]
    return sorted((int(number), version) for number, _, version in (n.partition(".") for n in names) if number.isdigit())


def new_version(base: str) -> tuple[str, str]:
    """(version, its folder) of a version that nobody reads yet."""
    version = f"v-{uuid.uuid4().hex[:12]}"
    return version, f"{base.rstrip('/')}/{version}"


def hold(spark: SparkSession, base: str, version: str) -> None:
    """From now on ``version`` is what readers of ``base`` get."""
    found = versions(spark, base)
    entry = f"{base.rstrip('/')}/{ENTRIES}/{found[-1][0] + 1 if found else 1:012d}.{version}"
    if not _files(spark, entry).createNewFile(_path(spark, entry)):
        raise RuntimeError(f"another writer published to {base}")


def current(spark: SparkSession, base: str) -> str:
    """The folder of the version that holds."""
    found = versions(spark, base)
    if not found:
        raise FileNotFoundError(f"no version was published under {base}")
    return f"{base.rstrip('/')}/{found[-1][1]}"


def read_current(spark: SparkSession, base: str) -> DataFrame:
    """The table as it is now; a frame keeps its version when a later one is published."""
    return spark.read.parquet(current(spark, base))


def replace_table(df: DataFrame, base: str, partition_ts: str | None = None, files: int | None = None) -> str:
    """Replace the table under ``base``: written aside, then published. It may be read from the very table."""
    version, folder = new_version(base)
    write_table(df, folder, partition_ts=partition_ts, files=files)
    hold(df.sparkSession, base, version)
    return folder


def promote_in_place(spark: SparkSession, base: str, column: str, to: str = "double") -> str:
    """The table under ``base`` with one column in a wider type; readers go over to it when it is whole."""
    df = read_current(spark, base)
    return replace_table(df.withColumn(column, F.col(column).cast(to)), base)


def drop_old(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Remove all but the ``keep`` latest versions (their entries first) and return their names.

    Frames that were opened on a version that goes can no longer be read.
    """
    gone = versions(spark, base)[: -max(1, keep)]
    kept = {v for _, v in versions(spark, base)[-max(1, keep) :]}
    files = _files(spark, base)
    for number, version in gone:
        files.delete(_path(spark, f"{base.rstrip('/')}/{ENTRIES}/{number:012d}.{version}"), False)
        if version not in kept:
            files.delete(_path(spark, f"{base.rstrip('/')}/{version}"), True)
    return [v for _, v in gone]

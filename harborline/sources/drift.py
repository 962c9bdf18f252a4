"""Reading Parquet files whose schemas drifted apart."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Sequence
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, IntegerType, LongType, NullType, StructField, StructType

from harborline.sinks.tables import write_table
from harborline.sources.files import month_files, months_between

_WHOLE = (IntegerType, LongType)
_REAL = (FloatType, DoubleType)


class SchemaConflict(Exception):
    """Two files hold the same column in types that have no common type here."""


def _widen(name: str, a: DataType, b: DataType) -> DataType:
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return LongType()
    if isinstance(a, _WHOLE + _REAL) and isinstance(b, _WHOLE + _REAL):
        return DoubleType()
    raise SchemaConflict(f"{name}: {a.simpleString()} against {b.simpleString()}")


def widened(schemas: Iterable[StructType]) -> StructType:
    """All columns of all schemas, whole and real numbers meeting in double, everything nullable.

    Column names are matched without regard to case, the first spelling wins.
    """
    fields: dict[str, StructField] = {}
    for schema in schemas:
        for f in schema.fields:
            seen = fields.get(f.name.lower())
            kind = f.dataType if seen is None else _widen(f.name, seen.dataType, f.dataType)
            fields[f.name.lower()] = StructField(seen.name if seen else f.name, kind, True)
    return StructType(list(fields.values()))


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema`` in its types; a column the frame lacks is NULL."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[
        (F.col(have[f.name.lower()]) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def leaf_files(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The data files below the paths, without opening one."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    return [unquote(f) for f in listed.inputFiles()]


def _bare(path: str) -> str:
    return path.split(":", 1)[-1].strip("/")


def _qualified(spark: SparkSession, path: str) -> str:
    """A path with the store that a name without one stands for, as files are listed."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(there).toString()


def _root(file: str, roots: dict[str, str]) -> str | None:
    """The listed path that a file is or lies in, the innermost of several."""
    at = _bare(file)
    while at and at not in roots:
        at = at.rpartition("/")[0]
    return roots.get(at)


def _merged(reader: DataFrameReader, files: list[str]) -> list[tuple[StructType, list[str]]]:
    """Files that go together, and their common schema.

    Spark merges the schemas of many files in one job, in tasks, but refuses a column of several types. Then
    either half of the files is merged by itself, and so on. Types change from one load to the next, so files sorted
    by name are long runs of one type, and a run costs a few jobs, not a job per file.
    """
    try:
        return [(reader.option("mergeSchema", True).parquet(*files).schema, files)]
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE" not in str(error) or len(files) == 1:
            raise
    middle = len(files) // 2
    return _merged(reader, files[:middle]) + _merged(reader, files[middle:])


def _scans(spark: SparkSession, files: list[str], base: str | None) -> list[DataFrame]:
    """One scan per distinct schema; runs whose columns do not contradict each other share one."""
    reader = spark.read.option("basePath", base) if base else spark.read
    groups: list[tuple[dict[str, DataType], StructType, list[str]]] = []
    for schema, own in _merged(reader, files):
        kinds = {f.name.lower(): f.dataType for f in schema.fields}
        for known, whole, several in groups:
            if all(known.get(name, kind) == kind for name, kind in kinds.items()):
                for f in schema.fields:
                    if f.name.lower() not in known:
                        whole.add(f)
                known.update(kinds)
                several += own
                break
        else:
            groups.append((kinds, StructType(list(schema.fields)), list(own)))
    return [(spark.read.option("basePath", base) if base else spark.read).schema(schema).parquet(*own) for _, schema, own in groups]


def read_drifting(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Files of different schemas as one frame in the widened schema; a path is a file or a folder of files.

    Every file counts with its own schema, also where files of one folder differ. The plan has one scan per
    distinct schema at most, however many files.
    """
    groups: dict[str | None, list[str]] = defaultdict(list)
    order = {p: i for i, p in enumerate(dict.fromkeys(paths))}
    roots = {_bare(_qualified(spark, p)): p for p in order}
    root_of = {f: _root(f, roots) or paths[0] for f in leaf_files(spark, list(order))}
    for file in sorted(root_of, key=lambda f: (order[root_of[f]], f)):
        # a folder whose files lie in folders of their own has partition columns, which hang on its path
        root = root_of[file]
        below = file.partition(f"{_bare(root)}/")[2].rpartition("/")[0]
        groups[root if "=" in below else None].append(file)
    scans = [scan for base, files in groups.items() for scan in _scans(spark, files, base)]
    target = widened(scan.schema for scan in scans)
    return reduce(lambda a, b: a.unionByName(b), [conform(scan, target) for scan in scans])


def append_evolving(
    spark: SparkSession, rows: DataFrame, target: str, partition_ts: str | None = None, replace: bool = False,
) -> StructType:
    """Append ``rows`` to the Parquet table at ``target`` whose columns may differ, and return the table's schema.

    New columns are added, and a whole number meets a real one in double; older files keep what they hold and
    ``read_drifting`` reads all in the common schema, so no file is written again. Types without a common type
    raise SchemaConflict before anything is written. ``replace`` starts the table anew. With ``partition_ts``
    the table is laid out by day of that time.
    """
    exists = not replace
    if exists:
        try:
            held = read_drifting(spark, [target]).schema
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            exists = False
    part = f"{partition_ts}_day"
    if exists:
        kept = StructType([f for f in held.fields if f.name != part])
        rows = conform(rows, widened([kept, rows.schema]))
    write_table(rows, target, mode="append" if exists else "overwrite", partition_ts=partition_ts)
    return rows.schema


def read_months(
    spark: SparkSession, base: str, kinds: str | Sequence[str], start_year: int | None = None, end_year: int | None = None,
    months: Sequence[str] | None = None, pattern: str = "{kind}_tripdata_{ym}.parquet",
) -> DataFrame:
    """All months of a year range, or the listed ones, of one kind or several, as one frame."""
    if months is None:
        months = months_between(start_year, end_year)
    several = [kinds] if isinstance(kinds, str) else kinds
    return read_drifting(spark, [f for kind in several for f in month_files(base, kind, months, pattern)])

"""Readers for CSV, Parquet and JSON files, tables, seeds and month ranges."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Texts read as missing by the raw CSV load.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


# Zone-free times with a blank or a T between day and time, with or without fractions.
TIME_FORMAT = "yyyy-MM-dd[' ']['T']HH:mm:ss[.SSSSSS][.SSS]"


def read_raw_csv(
    spark: SparkSession, base: str, file: str, null_tokens: Sequence[str] = NULL_TOKENS, multi_line: bool = False
) -> DataFrame | None:
    """Every column as text, NULL for the null tokens; None when the file does not exist.

    ``multi_line`` allows line breaks inside quotes, at the price of one task per file.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    try:
        df = reader.csv(f"{base.rstrip('/')}/{file}")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    tokens = list(null_tokens)
    return df.select(*[F.when(~F.col(f"`{c}`").isin(tokens), F.col(f"`{c}`")).alias(c) for c in df.columns])


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None, infer: bool = False, lenient: bool = False,
    multi_line: bool = False, header: bool = True,
) -> DataFrame:
    """CSV, with a header unless told otherwise: typed by ``schema``, or inferred. Files ending in .gz are read as they are.

    Strict reading stops at a row that does not fit the schema. Lenient reading pads short rows with
    NULL. ``multi_line`` allows line breaks inside quotes, at the price of one task per file.
    """
    reader = spark.read.option("header", header).option("escape", '"').option("timestampNTZFormat", TIME_FORMAT)
    reader = reader.option("mode", "PERMISSIVE" if lenient or schema is None else "FAILFAST")
    reader = reader.option("multiLine", multi_line)
    if lenient:
        reader = reader.option("enforceSchema", True)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer or lenient).csv(path)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def read_json_rows(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """JSON files of one record per line, or of an array of records (``multi_line``), with an inferred schema.

    Only files of one record per line can be split between tasks.
    """
    return spark.read.option("multiLine", multi_line).json(path)


def read_json_records(
    spark: SparkSession, path: str, array_col: str, keep: Sequence[str], default: str = "N/A",
    multi_line: bool = False,
) -> DataFrame:
    """The records nested in ``array_col``, reduced to ``keep``; ``multi_line`` for one document over many lines.

    A record without one of the keys gets ``default``; a column where that may happen is text.
    """
    option = spark.read.option("multiLine", multi_line)
    rows = option.json(path).select(F.explode(array_col).alias("r")).select("r.*")
    columns = []
    for name in keep:
        if name not in rows.columns:
            columns.append(F.lit(default).alias(name))
        elif dict(rows.dtypes)[name] == "string":
            columns.append(F.coalesce(F.col(name), F.lit(default)).alias(name))
        else:
            columns.append(F.col(name))
    return rows.select(*columns)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_jdbc(spark: SparkSession, url: str, query: str, split: tuple[str, int, int, int] | None = None, **options):
    """A table or query over JDBC; ``split`` = (column, low, high, parts) reads it in parallel."""
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if split is None:
        return reader.option("query", query).load()
    column, low, high, parts = split
    reader = reader.option("dbtable", f"({query}) q").option("partitionColumn", column)
    return reader.option("lowerBound", low).option("upperBound", high).option("numPartitions", parts).load()


def read_seed(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A small reference CSV. Whether it is broadcast is left to Spark, which knows the file's size."""
    return read_csv(spark, path, schema=schema)


def month_files(
    base: str, kind: str, months: Iterable[str], pattern: str = "{kind}_tripdata_{ym}.parquet"
) -> list[str]:
    return [f"{base.rstrip('/')}/{pattern.format(kind=kind, ym=ym)}" for ym in months]


def months_between(start_year: int, end_year: int) -> list[str]:
    if end_year < start_year:
        raise ValueError("the end year lies before the start year")
    return [f"{y}-{m:02d}" for y in range(start_year, end_year + 1) for m in range(1, 13)]

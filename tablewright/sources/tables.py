"""Reading and writing tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablewright.functions.columns import nan_to_null

FORMATS = {"csv": "csv", "tsv": "csv", "json": "json", "orc": "orc", "parquet": "parquet"}


def format_of(path: str) -> str:
    return FORMATS.get(path.rstrip("/").rsplit(".", 1)[-1].lower(), "parquet")


def read_table(spark: SparkSession, path: str, fmt: str | None = None,
               schema: T.StructType | str | None = None, missing: str = "error",
               ) -> DataFrame | None:
    """Read CSV (with header), JSON, ORC or Parquet; empty CSV cells and NaN become NULL.

    Give a schema for large CSV files, inference reads them twice. ``missing='none'`` returns
    ``None`` for an absent path instead of failing.
    """
    fmt = fmt or format_of(path)
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.options(header=True, nullValue="", inferSchema=schema is None,
                                sep="\t" if path.endswith(".tsv") else ",")
    try:
        df = reader.load(path)
    except AnalysisException as error:
        if missing == "none" and error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return nan_to_null(df)


def write_table(df: DataFrame, path: str, fmt: str | None = None, mode: str = "overwrite",
                partition_by: list[str] | None = None) -> str:
    """Write a table; stages hand over Parquet unless the path names another format."""
    fmt = fmt or format_of(path)
    writer = df.write.format(fmt).mode(mode)
    if fmt == "csv":
        writer = writer.options(header=True, emptyValue="")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path

"""Codes for text labels: rank among the sorted distinct labels, missing counts as 'nan'."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.columns import col
from tablewright.functions.ranking import global_index


def as_label(value: Column) -> Column:
    return F.coalesce(value, F.lit("nan"))


def fit_codes(df: DataFrame, labels: dict[str, Column], allowed: dict[str, list[str]],
              ) -> dict[str, list[str]]:
    """Sorted labels in use, for columns whose possible labels are known in advance."""
    names = list(labels)
    wide = [F.max(as_label(labels[c]) == F.lit(x)) for c in names for x in [*allowed[c], "nan"]]
    row = list(df.agg(*[w.alias(f"a{i}") for i, w in enumerate(wide)]).first())
    out = {}
    for c in names:
        options = [*allowed[c], "nan"]
        used, row = row[:len(options)], row[len(options):]
        out[c] = sorted(x for x, u in zip(options, used) if u)
    return out


def label_table(df: DataFrame, column: str) -> DataFrame:
    """(label, code) of any text column, however many labels it has."""
    labels = df.select(as_label(col(column)).alias("label")).distinct()
    return global_index(labels, [F.col("label")], "code")


def label_encode(df: DataFrame, column: str, output: str | None = None) -> DataFrame:
    """Add the code of a text column; Spark broadcasts the label table only if it is small."""
    table = label_table(df, column)
    name = output or f"{column}_encoded"
    # missing text gets its code as a literal, so it does not meet in one task
    missing = table.filter("label = 'nan'").first()
    code = F.lit(None if missing is None else missing["code"]).cast("long")
    table = table.withColumnRenamed("label", "_label").withColumnRenamed("code", "_code")
    found = df.join(table, col(column) == F.col("_label"), "left")
    return found.withColumn(name, F.coalesce("_code", code)).drop("_label", "_code")

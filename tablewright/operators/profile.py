"""Table profile: counts, missing cells, outliers, descriptive statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.fixed_values import IQR_FACTOR
from tablewright.functions.columns import col, long_form, numeric_columns, one_row, text_columns
from tablewright.functions.quantiles import exact_quantiles
from tablewright.session import stage


def counts(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  F.lit(len(df.columns)).cast("bigint").alias("total_columns"))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of equal rows (NULL equals NULL).

    Copies are counted map-side first, so one row that makes up a third of the table reaches the
    shuffle once per task.
    """
    groups = df.groupBy(*[col(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_copies"))
    return groups.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"))


def column_types(df: DataFrame) -> DataFrame:
    """Column name, type and whether it counts as numeric or categorical."""
    numeric, text = set(numeric_columns(df)), set(text_columns(df))
    rows = [(i, f.name, f.dataType.simpleString(),
             "numeric" if f.name in numeric else "categorical" if f.name in text else "other")
            for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(
        rows, "position int, column_name string, data_type string, kind string")


def _share(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part * F.lit(100.0), whole), 2)


def _missing_wide(df: DataFrame) -> list[Column]:
    n = F.count(F.lit(1))
    out = []
    for i, c in enumerate(df.columns):
        missing = F.count_if(col(c).isNull())
        out += [missing.alias(f"missing_count_{i}"), _share(missing, n).alias(f"missing_pct_{i}")]
    return out


def missing(df: DataFrame) -> DataFrame:
    """Missing count and percentage of every column, in one aggregation."""
    return long_form(df.agg(*_missing_wide(df)), df.columns, ["missing_count", "missing_pct"])


def missing_table(df: DataFrame) -> DataFrame:
    return missing(df).filter(F.col("missing_count") > 0)


def missing_cells(df: DataFrame) -> Column:
    """Aggregate: number of missing cells in the whole table."""
    total = F.lit(0).cast("bigint")
    for c in df.columns:
        total = total + F.count_if(col(c).isNull())
    return total


def totals(df: DataFrame) -> DataFrame:
    """Shape, missing cells and duplicate rows from a single grouping of equal rows."""
    groups = df.groupBy(*[col(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_copies"))
    nulls = F.lit(0).cast("bigint")
    for c in df.columns:
        nulls = nulls + F.when(col(c).isNull(), 1).otherwise(0)
    return groups.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("total_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("total_columns"),
        F.coalesce(F.sum(nulls * F.col("_copies")), F.lit(0)).alias("missing_cells"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"))


def column_info(df: DataFrame) -> DataFrame:
    """Non-null count and type per column."""
    wide = df.agg(*[F.count(col(c)).alias(f"non_null_{i}") for i, c in enumerate(df.columns)],
                  *[F.lit(f.dataType.simpleString()).alias(f"data_type_{i}")
                    for i, f in enumerate(df.schema)])
    return long_form(wide, df.columns, ["non_null", "data_type"])


def iqr_bounds(df: DataFrame, columns: list[str], factor: float = IQR_FACTOR, kept: bool = False,
               ) -> dict[str, tuple[float, float] | None]:
    quartiles = exact_quantiles(df, columns, [0.25, 0.75], kept)
    out: dict[str, tuple[float, float] | None] = {}
    for c, (q1, q3) in quartiles.items():
        out[c] = None if q1 is None else (q1 - factor * (q3 - q1), q3 + factor * (q3 - q1))
    return out


def outside(column: str, bounds: tuple[float, float] | None) -> Column:
    """True only for values strictly outside the bounds; missing values are inside."""
    if bounds is None:
        return F.lit(False)
    value = col(column)
    return F.coalesce((value < F.lit(bounds[0])) | (value > F.lit(bounds[1])), F.lit(False))


def outliers(df: DataFrame, factor: float = IQR_FACTOR, kept: bool = False) -> DataFrame:
    """Count and percentage (of all rows) outside the interquartile fences, per numeric column.

    ``kept``: ``df`` is a table that is written already.
    """
    names = numeric_columns(df)
    df = df if kept else stage(df.select(*[col(c) for c in names]), "numbers")
    bounds = iqr_bounds(df, names, factor, kept=True)
    n = F.count(F.lit(1))
    wide = []
    for i, c in enumerate(names):
        hits = F.count_if(outside(c, bounds[c]))
        wide += [hits.alias(f"outlier_count_{i}"), _share(hits, n).alias(f"outlier_pct_{i}")]
    return long_form(df.agg(*wide), names, ["outlier_count", "outlier_pct"])


STATISTICS = ["n", "mean", "std", "min", "q25", "q50", "q75", "max"]


def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles of the numeric columns."""
    names = numeric_columns(df) if columns is None else columns
    df = stage(df.select(*[col(c) for c in names]), "numbers")
    quartiles = exact_quantiles(df, names, [0.25, 0.5, 0.75], kept=True)
    wide = []
    for i, c in enumerate(names):
        value = col(c).cast("double")
        q = [F.lit(x).cast("double") for x in quartiles[c]]
        parts = [F.count(value), F.avg(value), F.stddev_samp(value), F.min(value), *q, F.max(value)]
        wide += [p.alias(f"{s}_{i}") for s, p in zip(STATISTICS, parts)]
    return long_form(df.agg(*wide), names, STATISTICS)


def head(df: DataFrame, order_by: list[str], n: int = 10) -> DataFrame:
    return df.orderBy(*[col(c).asc_nulls_first() for c in order_by]).limit(n)


def quality(df: DataFrame) -> DataFrame:
    """Long-form profile: table totals, missing cells and outliers as (column, metric, value).

    The table is written once for its five or six passes.
    """
    df = stage(df, "profiled")
    whole = totals(df).select(F.inline(F.array(*[
        F.struct(F.lit(None).cast("string").alias("column_name"), F.lit(m).alias("metric"),
                 F.col(m).cast("double").alias("value"))
        for m in ("total_rows", "total_columns", "missing_cells", "duplicate_rows")])))
    parts = [whole]
    for table, fields in ((missing(df), ["missing_count", "missing_pct"]),
                          (outliers(df, kept=True), ["outlier_count", "outlier_pct"])):
        parts.append(table.select("column_name", F.inline(F.array(*[
            F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
            for m in fields]))))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def before_after(before: DataFrame, after: DataFrame) -> DataFrame:
    """The quality profile of two versions of a table, told apart by ``phase``."""
    return (quality(before).withColumn("phase", F.lit("before"))
            .unionByName(quality(after).withColumn("phase", F.lit("after"))))

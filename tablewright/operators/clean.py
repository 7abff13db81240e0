"""Repair of a table: missing values, duplicates, outliers, column types."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.fixed_values import IQR_FACTOR, SPARSE_SHARE, ZSCORE_LIMIT
from tablewright.functions.columns import (all_of, any_of, col, long_form, numeric_columns,
                                           one_row, text_columns)
from tablewright.functions.fences import sequential_fences, sequential_zscores
from tablewright.functions.quantiles import exact_quantiles
from tablewright.operators import neighbors
from tablewright.operators.profile import iqr_bounds, missing_cells, outside
from tablewright.session import stage

log = logging.getLogger(__name__)

FILL_STRATEGIES = ("mean", "median", "mode", "constant")
STRATEGIES = ("drop_rows", "drop_columns", *FILL_STRATEGIES, "knn")


# ---- missing values -------------------------------------------------------------------------

def drop_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.filter(all_of([col(c).isNotNull() for c in columns or df.columns]))


def drop_sparse_columns(df: DataFrame, share: float = SPARSE_SHARE,
                        columns: list[str] | None = None) -> DataFrame:
    """Drop columns whose share of missing values is above ``share``."""
    names = list(columns or df.columns)
    n, *nulls = one_row(df, [F.count(F.lit(1)), *[F.count_if(col(c).isNull()) for c in names]])
    sparse = {c for c, k in zip(names, nulls) if n and k / n > share}
    return df.select(*[col(c) for c in df.columns if c not in sparse])


def modes(df: DataFrame, columns: list[str]) -> dict[str, object]:
    """Most frequent value per column, the smallest one on ties; ``None`` without values.

    Value counts are built map-side in one shuffle for all columns of a type, so neither a
    frequent nor a high-cardinality column gathers in one task.
    """
    out: dict[str, object] = {c: None for c in columns}
    kinds: dict[T.DataType, list[str]] = {}
    for c in columns:
        kinds.setdefault(df.schema[c].dataType, []).append(c)
    for names in kinds.values():
        cells = df.select(F.inline(F.array(*[
            F.struct(F.lit(i).alias("c"), col(c).alias("v")) for i, c in enumerate(names)])))
        sizes = cells.filter("v is not null").groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
        best = sizes.groupBy("c").agg(F.min(F.struct(-F.col("n"), F.col("v"))).alias("b"))
        for row in best.select("c", "b.v").collect():
            out[names[row["c"]]] = row["v"]
    return out


def fit_fill(df: DataFrame, strategy: str = "mean", columns: list[str] | None = None,
             constant: float = 0.0) -> dict[str, object]:
    """Replacement value per column: the strategy for numbers, the mode (or 'Unknown') for text."""
    if strategy not in FILL_STRATEGIES:
        raise ValueError(f"unknown fill strategy: {strategy}")
    wanted = set(columns or df.columns)
    numbers = [c for c in numeric_columns(df) if c in wanted]
    texts = [c for c in text_columns(df) if c in wanted]
    if strategy == "mean":
        values = dict(zip(numbers, one_row(df, [F.avg(col(c)) for c in numbers])))
    elif strategy == "median":
        values = {c: v[0] for c, v in exact_quantiles(df, numbers, [0.5]).items()}
    elif strategy == "constant":
        values = {c: constant for c in numbers}
    else:
        values = modes(df, numbers)
    for c, v in modes(df, texts).items():
        values[c] = "Unknown" if v is None else v
    return values


def fill(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Replace missing cells; a filled number column becomes double."""
    numbers = set(numeric_columns(df))
    out = []
    for c in df.columns:
        v = values.get(c)
        if v is None:
            out.append(col(c))
        elif c in numbers:
            out.append(F.coalesce(col(c).cast("double"), F.lit(float(v))).alias(c))
        else:
            out.append(F.coalesce(col(c), F.lit(v)).alias(c))
    return df.select(*out)


def impute(df: DataFrame, strategy: str = "mean", columns: list[str] | None = None) -> DataFrame:
    """Any of the missing-value strategies on the given columns (all by default)."""
    if strategy == "drop_rows":
        return drop_rows(df, columns)
    if strategy == "drop_columns":
        return drop_sparse_columns(df, columns=columns)
    if strategy == "knn":
        return neighbors.knn_impute(df, columns=columns)
    return fill(df, fit_fill(df, strategy, columns))


def missing_report(before: DataFrame, after: DataFrame, strategy: str) -> DataFrame:
    """Missing cells before and after a repair."""
    zero = F.lit(0).cast("bigint")
    both = before.agg(missing_cells(before).alias("b"), zero.alias("a")).unionByName(
        after.agg(zero.alias("b"), missing_cells(after).alias("a")))
    return both.agg(F.sum("b").alias("missing_before"), F.sum("a").alias("missing_after")) \
        .withColumn("missing_removed", F.col("missing_before") - F.col("missing_after")) \
        .withColumn("strategy", F.lit(strategy))


# ---- duplicates -----------------------------------------------------------------------------

COPIES = "_copies"


def row_groups(df: DataFrame) -> DataFrame:
    """Distinct rows with their number of copies, written once for table, report and profile.

    Whole rows cross the network here and nowhere else; copies are counted map-side first.
    """
    return stage(df.groupBy(*[col(c) for c in df.columns]).agg(F.count(F.lit(1)).alias(COPIES)), "rows")


def distinct_rows(groups: DataFrame, keep: str | bool = "first") -> DataFrame:
    """What ``dedup`` keeps, from ``row_groups``."""
    if keep not in ("first", "last", False):
        raise ValueError(f"keep must be 'first', 'last' or False, not {keep!r}")
    return (groups.where(F.col(COPIES) == 1) if keep is False else groups).drop(COPIES)


def copies_report(groups: DataFrame, keep: str | bool = "first") -> DataFrame:
    """Duplicates found and removed, from ``row_groups``. All of them go whatever is kept."""
    found = F.coalesce(F.sum(F.col(COPIES) - 1), F.lit(0))
    return groups.agg(found.alias("duplicates_before"), found.alias("duplicates_removed")) \
        .withColumn("keep_strategy", F.lit(str(keep).lower()))


def dedup(df: DataFrame, keep: str | bool = "first") -> DataFrame:
    """Drop repeated rows; equal rows are interchangeable, so 'first' and 'last' agree.

    ``keep=False`` drops every row that has a copy.
    """
    if keep in ("first", "last"):
        return df.dropDuplicates()
    if keep is False:
        groups = df.groupBy(*[col(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_copies"))
        return groups.filter("_copies = 1").drop("_copies")
    raise ValueError(f"keep must be 'first', 'last' or False, not {keep!r}")


def duplicate_report(df: DataFrame, keep: str | bool = "first") -> DataFrame:
    """Duplicates found and removed. All of them go whatever is kept."""
    return copies_report(df.groupBy(*[col(c) for c in df.columns]).agg(F.count(F.lit(1)).alias(COPIES)), keep)


# ---- outliers -------------------------------------------------------------------------------

@dataclass
class OutlierRules:
    """Fitted row filter: per column the test that marks a row as an outlier, in filter order."""

    method: str
    factor: float
    tests: list[tuple[str, dict]] = field(default_factory=list)

    @staticmethod
    def _hit(column: str, test: dict) -> Column:
        if "bounds" in test:
            return outside(column, test["bounds"])
        z = F.abs((col(column) - F.lit(test["mean"])) / F.lit(test["std"]))
        return F.coalesce(z > F.lit(float(ZSCORE_LIMIT)), F.lit(False))

    def hits(self) -> list[tuple[str, Column]]:
        return [(c, self._hit(c, t)) for c, t in self.tests]

    def apply(self, df: DataFrame) -> DataFrame:
        return df.filter(all_of([~h for _, h in self.hits()]))

    def report(self, df: DataFrame) -> DataFrame:
        """Rows each column's test removes, after the tests before it."""
        hits = self.hits()
        wide = []
        for i, (_, h) in enumerate(hits):
            earlier = any_of([e for _, e in hits[:i]])
            removed = F.count_if(h & ~earlier) if self.sequential else F.count_if(h)
            wide.append(removed.alias(f"rows_removed_{i}"))
        steps = long_form(df.agg(*wide), [c for c, _ in hits], ["rows_removed"])
        return steps.withColumn("method", F.lit(self.method)) \
            .withColumn("factor", F.lit(float(self.factor)))

    sequential: bool = True


def fit_outliers(df: DataFrame, method: str = "iqr", columns: list[str] | None = None,
                 factor: float = IQR_FACTOR, sequential: bool = True) -> OutlierRules:
    """Fit the outlier filter; ``sequential`` takes each column's statistics from the survivors
    of the columns before it.

    All columns together take a few passes over the table, see ``functions.fences``.
    """
    names = [c for c in (columns or numeric_columns(df)) if c in df.columns]
    rules = OutlierRules(method, factor, sequential=sequential)
    if method == "iqr":
        bounds = (sequential_fences if sequential else iqr_bounds)(df, names, factor)
        rules.tests = [(c, {"bounds": bounds[c]}) for c in names]
    elif method == "zscore":
        if sequential:
            found = sequential_zscores(df, names, float(ZSCORE_LIMIT))
        else:
            flat = one_row(df, [f(col(c)) for c in names for f in (F.avg, F.stddev_pop)])
            found = {c: (m, s) for c, m, s in zip(names, flat[::2], flat[1::2]) if s}
        rules.tests = [(c, {"mean": m, "std": s}) for c, (m, s) in found.items()]
    else:
        raise ValueError(f"unknown outlier method: {method}")
    return rules


# ---- column types ---------------------------------------------------------------------------

# fixed values: type names accepted for expected types
TYPE_NAMES = {
    "int": "bigint", "int64": "bigint", "int32": "int", "float": "double", "float64": "double",
    "float32": "float", "str": "string", "object": "string", "bool": "boolean",
    "datetime64[ns]": "timestamp",
}


def _fails(df: DataFrame, targets: dict[str, str]) -> dict[str, int]:
    """Cells of each column that its target type cannot hold, from one aggregation."""
    checks = [F.count_if((F.trim(col(c).cast("string")) != "") & col(c).try_cast(t).isNull())
              for c, t in targets.items()]
    return dict(zip(targets, one_row(df, checks)))


def _retype(df: DataFrame, targets: dict[str, str]) -> DataFrame:
    return df.select(*[col(c).try_cast(targets[c]).alias(c) if c in targets else col(c)
                       for c in df.columns])


def auto_numeric(df: DataFrame) -> DataFrame:
    """Turn text columns into double where every cell is a number; leave the others alone."""
    fails = _fails(df, {c: "double" for c in text_columns(df)})
    return _retype(df, {c: "double" for c, n in fails.items() if n == 0})


def cast_types(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """Cast to the expected types; a column with an unfit cell stays as it is, with a warning."""
    targets = {c: TYPE_NAMES.get(t, t) for c, t in expected.items() if c in df.columns}
    fails = _fails(df, targets)
    for c, n in fails.items():
        if n:
            log.warning("%s keeps its type: %d cells do not fit %s", c, n, targets[c])
    return _retype(df, {c: t for c, t in targets.items() if not fails[c]})


def validate_types(df: DataFrame, expected: dict[str, str] | None = None) -> DataFrame:
    out = auto_numeric(df)
    return cast_types(out, expected) if expected else out
